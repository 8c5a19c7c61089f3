"""N-gram Jaccard join with count vectors and R-trees.

A document is the set of its distinct shingles. Shingles are hashed into groups; the group counts of
a set are a point, and two sets have at most the summed coordinate minima of their points in common.
Sets that may link differ in few shingles, so their points lie close by in L1 distance. The join goes
in these steps:

* Equal sets become one; only classes go on.
* The point's coordinates are cut into more ranges than a linked pair can have differing shingles, so
  a linked pair agrees on some whole range. Ranges are ordered by how much they hold, and a prefix
  filter keeps as many of the fullest ranges as are needed. Sizes are dealt into classes of a factor
  two, where a set also joins the next class if its partners reach there.
* Sets that share a range meet there. First each meets the range's smallest id; these pairs are
  verified, and what links becomes a component.
* Where a range still holds several components, an R-tree over the points finds the pairs of
  different components whose bound reaches what is needed: in larger ranges first those of the member in
  the middle, then, after another round of components, all others. They are verified too, so no link between two
  components is lost, and pairs inside one need no look. Ranges with very many members are dealt out
  in tiles, each pair of parts to a task.

Words are runs of characters other than ASCII white space, with A-Z lowered. A text with fewer words
than a shingle is one shingle of all its words. Null and empty texts have no shingles and link with
nothing. Rows that repeat an id count as one document with several texts. Rows without an id link
with nothing and have no component. Extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillgrain.llm.components import components
from tillgrain.llm.tables import query, table, unused, whole_text
from tillgrain.session import pin

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SLICE = 1 << 22
#: Groups within a range of coordinates, with a random weight each: a range's counts as one number.
RANGE_GROUPS = 256
#: Below this level a range's shingles count one by one; few of them in 256 groups would often agree.
GROUPED_LEVEL = 5
_RNG = np.random.default_rng(20240229)
WEIGHTS = _RNG.integers(0, 1 << 64, RANGE_GROUPS, dtype=np.uint64)
MIX = _RNG.integers(0, 1 << 64, 64, dtype=np.uint64) | np.uint64(1)
#: Members of a range that one task takes at once.
TILE = 4_096
FANOUT = 8
TREE_GROUPS = 64
#: The round of middle members is for ranges with more members; smaller ones go to the trees at once.
MIDDLE_FROM = 64
#: Pairs of one document that a task verifies with one copy of its text.
PART_PAIRS = 2_000
#: So many ids at most are sent to all executors.
BROADCAST_IDS = 250_000


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _word_hashes(text: str) -> np.ndarray:
    body = text.encode().translate(LOWER)
    parts, at = [], 0
    while at < len(body):
        end = at + SLICE
        # A slice ends at white space, so that no word is cut.
        while end < len(body) and body[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        words = body[at:end].split()
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def shingles(text: str, width: int) -> np.ndarray:
    """The sorted hashes of the text's shingles."""
    words = _word_hashes(text)
    if not len(words):
        return words
    width = min(width, len(words))
    count = len(words) - width + 1
    made = np.full(count, np.uint64(width))
    for i in range(width):
        made += words[i:i + count] * MIX[i]
        made = made ^ (made >> np.uint64(29))
    return np.unique(_mixed(made))


def _common(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


class Law:
    """When two sets of given sizes link: percent * union <= 100 * common."""

    def __init__(self, percent: int):
        self.percent = percent

    def least(self, a, b):
        """Fewest common shingles of linked sets of these sizes."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def most(self, a: int) -> int:
        """Largest size that links with size a."""
        return 100 * a // self.percent

    def differing(self, a: int, low: int, high: int) -> int:
        """Most shingles that a set of size a and a linked one of a size in the range may differ in."""
        low, high = max(low, -(-self.percent * a // 100), 1), min(high, self.most(a))
        if low > high:
            return -1
        b = np.arange(low, high + 1)
        need = self.least(a, b)
        ok = need <= np.minimum(a, b)
        return int((a + b - 2 * need)[ok].max()) if ok.any() else -1


@lru_cache(maxsize=64)
def _ranges(percent: int, level: int) -> int:
    """Into how many ranges the coordinates are cut for sizes from 2^level to below 2^(level+1)."""
    top = (2 << level) - 1
    most = max(Law(percent).differing(b, 1, b) for b in range(max(1 << level, top - 64), top + 1))
    return most + 2 + most // 4


@lru_cache(maxsize=1 << 16)
def _kept(percent: int, size: int, level: int) -> int:
    """How many ranges a set of that size keeps at that level; none if no partner is there."""
    law, own = Law(percent), size.bit_length() - 1
    if own == level:
        return law.differing(size, 1, (2 << level) - 1) + 1
    return law.differing(size, 1 << level, (2 << level) - 1) + 1


def range_keys(shingle_set: np.ndarray, percent: int) -> np.ndarray:
    """The keys under which a set is found, at its own level and, if partners reach it, the next. A set
    that links with none but equal ones has no keys, since equal sets are one class already."""
    size = len(shingle_set)
    own = size.bit_length() - 1
    made = []
    for level in (own, own + 1):
        keep = _kept(percent, size, level)
        if keep <= 1:
            continue
        ranges = _ranges(percent, level)
        place = ((shingle_set >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
        weight = (WEIGHTS[(shingle_set & np.uint64(RANGE_GROUPS - 1)).astype(np.intp)]
                  if level >= GROUPED_LEVEL else _mixed(shingle_set * MIX[11]))
        full, starts = np.unique(place, return_index=True)
        sums = np.zeros(ranges, np.uint64)
        sums[full.astype(np.intp)] = np.add.reduceat(weight, starts)
        counts = np.bincount(place.astype(np.intp), minlength=ranges)
        at = np.arange(ranges, dtype=np.uint64)
        keys = _mixed(_mixed(sums + counts.astype(np.uint64) * MIX[8])
                      + at * MIX[9] + np.uint64(level * int(MIX[10]) % (1 << 64)))
        made.append(keys[np.lexsort((keys, -counts))[:keep]])
    return np.concatenate(made) if made else np.empty(0, np.uint64)


def groups_of(size: int) -> int:
    """Two groups or more for every shingle, up to a bound, so that few shingles share one."""
    return int(min(256, max(16, 2 << size.bit_length())))


def point(shingle_set: np.ndarray, groups: int) -> np.ndarray:
    """Group counts; the number of groups is a power of two, and halves add up to fewer groups."""
    return np.bincount((shingle_set & np.uint64(groups - 1)).astype(np.intp), minlength=groups)


def packed(counts: np.ndarray) -> bytes:
    """A point as bytes: two counts a byte where all are below 16, else four bytes a count."""
    if counts.max(initial=0) < 16:
        half = counts.astype(np.uint8)
        return b"\0" + (half[0::2] | half[1::2] << 4).tobytes()
    return b"\1" + counts.astype("<u4").tobytes()


def unpacked(body) -> np.ndarray:
    if bytes(body[:1]) == b"\1":
        return np.frombuffer(body, "<u4", offset=1).astype(np.int64)
    half = np.frombuffer(body, np.uint8, offset=1)
    return np.stack([half & 15, half >> 4], axis=1).ravel().astype(np.int64)


def _folded(counts: np.ndarray, groups: int) -> np.ndarray:
    return counts.reshape(*counts.shape[:-1], -1, groups).sum(axis=-2)


class RTree:
    """Points packed into boxes level by level; a box keeps its coordinate maxima, smallest size and
    the one component of its points, if it is one."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
        # Boxes are held at fewer groups than the points: sums of coordinates bound as well.
        coarse = _folded(points, min(TREE_GROUPS, points.shape[1]))
        order = np.lexsort((*coarse.T[:3], sizes))
        self.order, self.points, self.sizes = order, points, sizes
        self.levels = [(coarse[order], sizes[order], labels[order])]
        while len(self.levels[-1][1]) > 1:
            top, small, label = self.levels[-1]
            starts = np.arange(0, len(small), FANOUT)
            low, high = np.minimum.reduceat(label, starts), np.maximum.reduceat(label, starts)
            # Labels are not negative; -1 marks a box of several.
            self.levels.append((np.maximum.reduceat(top, starts), np.minimum.reduceat(small, starts),
                                np.where(low == high, low, -1)))

    def pairs(self, law: Law) -> np.ndarray:
        """All that ``portions`` gives."""
        return np.concatenate([np.empty((0, 2), np.int64), *self.portions(law)])

    def portions(self, law: Law) -> Iterator[np.ndarray]:
        """Places of points in different components whose bound reaches what they need, some at a time.
        Pairs of boxes are opened depth first, so few of them are held at once."""
        step, some = np.arange(FANOUT), 1 << 12
        held = [(len(self.levels) - 1, np.zeros((1, 2), np.int64))]
        while held:
            level, at = held.pop()
            top, small, label = self.levels[level]
            i, j = at.T
            bound = np.minimum(top[i], top[j]).sum(axis=1)
            at = at[(bound >= law.least(small[i], small[j])) & ((label[i] != label[j]) | (label[i] < 0))]
            if level:
                below = len(self.levels[level - 1][1])
                a = (at[:, :1] * FANOUT + step)[:, :, None]
                b = (at[:, 1:] * FANOUT + step)[:, None, :]
                a, b = (x.ravel() for x in np.broadcast_arrays(a, b))
                ok = (a < below) & (b < below) & (a <= b if level > 1 else a < b)
                at = np.stack([a[ok], b[ok]], axis=1)
                held += [(level - 1, at[begin:begin + some]) for begin in range(0, len(at), some)]
                continue
            i, j = at = self.order[at].T
            bound = np.minimum(self.points[i], self.points[j]).sum(axis=1)
            found = at.T[(i != j) & (bound >= law.least(self.sizes[i], self.sizes[j]))]
            if len(found):
                yield found


def _middle_pairs(points: np.ndarray, sizes: np.ndarray, labels: np.ndarray, law: Law) -> np.ndarray:
    """The pairs of the member nearest to the middle."""
    middle = int(np.abs(points - np.median(points, axis=0)).sum(axis=1).argmin())
    bound = np.minimum(points, points[middle]).sum(axis=1)
    ok = (bound >= law.least(sizes, sizes[middle])) & (labels != labels[middle])
    others = np.flatnonzero(ok)
    return np.stack([np.full(len(others), middle), others], axis=1)


def prepare(docs: DataFrame, id: str, text: str, width: int, percent: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, marks, keys, points = [], [], [], []
            for body in batch.column(1):
                own = shingles(body.as_py(), width)
                sizes.append(len(own))
                marks.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                keys.append(range_keys(own, percent).view(np.int64) if len(own) else [])
                points.append(packed(point(own, groups_of(len(own)))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(marks, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(points, pa.binary())],
                ["doc_id", "n_shingles", "mark", "keys", "point"])

    return docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), whole_text(text).alias("text")
                       ).mapInArrow(work, "doc_id bigint, n_shingles bigint, mark binary, "
                                          "keys array<bigint>, point binary")


def _sent(ids: DataFrame, count: int) -> DataFrame:
    """Ids as one side of a join: sent to all executors up to a bound, else dealt out."""
    return F.broadcast(ids) if count <= BROADCAST_IDS else ids


def _texts(docs: DataFrame, id: str, text: str, wanted: DataFrame, count: int) -> DataFrame:
    """Texts of the wanted documents. A text is about half as large as the hashes of its shingles."""
    return (docs.select(F.col(f"`{id}`").cast("long").alias("rep"), whole_text(text).alias("text"))
            .join(_sent(wanted, count), "rep", "leftsemi"))


def _met(pairs: DataFrame, sides: DataFrame, column: str) -> DataFrame:
    """u, v and the column of both."""
    side = lambda end: sides.select(F.col("rep").alias(end),
                                    F.col(column).alias(f"{column}_{end}"))
    return pairs.join(side("u"), "u").join(side("v"), "v").select(
        "u", "v", f"{column}_u", f"{column}_v")


def _filtered(pairs: DataFrame, judge) -> DataFrame:
    """The pairs that the judge of two values accepts."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [judge(a.as_py(), b.as_py()) for a, b in zip(*batch.columns[2:])]
            kept = pa.RecordBatch.from_arrays(batch.columns[:2], ["u", "v"])
            yield kept.filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(work, "u bigint, v bigint")


def _reaching(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The pairs whose points' bound reaches what they need."""
    law = Law(percent)

    def reaches(first: bytes, second: bytes) -> bool:
        x, y = unpacked(first), unpacked(second)
        groups = min(len(x), len(y))
        common = int(np.minimum(_folded(x, groups), _folded(y, groups)).sum())
        return common >= law.least(int(x.sum()), int(y.sum()))

    return _filtered(_met(pairs, points, "point"), reaches)


def _verified(pairs: DataFrame, percent: int, width: int, texts_of) -> DataFrame:
    """The pairs that link, by the sets of their documents, whose texts ``texts_of`` finds by id.

    Pairs are dealt out by their smaller document, in parts where it has many. A part gets that
    document's text once, and its set is held while the others' texts pass by."""
    law = Law(percent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, a = None, None
        for batch in batches:
            keep = []
            for u, part, first, text in zip(*(batch.column(n) for n in (0, 2, 3, 4))):
                here = u.as_py(), part.as_py()
                if first.as_py():
                    own, a = here, shingles(text.as_py(), width)
                    keep.append(False)
                    continue
                b = shingles(text.as_py(), width)
                keep.append(own == here and _common(a, b) >= law.least(len(a), len(b)))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["u", "v"]).filter(
                pa.array(keep, pa.bool_()))

    near = pin(pairs)
    ids = pin(near.select(F.explode(F.array("u", "v")).alias("rep")).distinct())
    count = ids.count()
    if not count:
        return near
    texts = texts_of(ids, count)
    many = near.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / PART_PAIRS).cast("int").alias("parts"))
    tails = (near.join(many, "u").join(texts.withColumnRenamed("rep", "v"), "v")
             .select("u", "v", F.pmod(F.xxhash64("v"), "parts").cast("int").alias("part"),
                     F.lit(False).alias("first"), "text"))
    heads = (many.join(texts.withColumnRenamed("rep", "u"), "u")
             .select("u", F.col("u").alias("v"),
                     F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                     F.lit(True).alias("first"), "text"))
    tasks = int(near.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = (heads.unionByName(tails).repartition(tasks, "u", "part")
           .sortWithinPartitions("u", "part", F.desc("first"), "v"))
    return met.mapInArrow(work, "u bigint, v bigint")


def _tree_pairs(rows: DataFrame, percent: int, middle: bool) -> DataFrame:
    """Candidate pairs of different components within each tile of a range. ``rows``: key, part_a,
    part_b, part, rep, label, point; they come sorted by tile."""
    law = Law(percent)

    def solve(reps, labels, parts, points, tiled: bool) -> Iterator[np.ndarray]:
        groups = min(map(len, points))
        at = np.stack([_folded(p, groups).astype(np.int32) for p in points])
        sizes = at.sum(axis=1)
        _, small = np.unique(labels, return_inverse=True)
        if middle:
            yield reps[_middle_pairs(at, sizes, small, law)]
            return
        for found in RTree(at, sizes, small).portions(law):
            yield reps[found[parts[found[:, 0]] != parts[found[:, 1]]] if tiled else found]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        tile = None

        def close() -> Iterator[pa.RecordBatch]:
            if len(held) < 2:
                return
            reps, labels, parts, points = zip(*held)
            for found in solve(np.array(reps), np.array(labels), np.array(parts), points,
                               tile[1] != tile[2]):
                yield pa.RecordBatch.from_pydict({"u": pa.array(found.min(axis=1), pa.int64()),
                                                  "v": pa.array(found.max(axis=1), pa.int64())})

        for batch in batches:
            key, part_a, part_b, part, rep, label = (c.to_pylist() for c in batch.columns[:6])
            for n, body in enumerate(batch.column(6)):
                here = key[n], part_a[n], part_b[n]
                if here != tile:
                    yield from close()
                    held, tile = [], here
                held.append((rep[n], label[n], part[n], unpacked(body.as_py())))
        yield from close()

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(parts, "key", "part_a", "part_b")
            .sortWithinPartitions("key", "part_a", "part_b", "rep")
            .mapInArrow(work, "u bigint, v bigint").distinct())


def _open_rows(shared: DataFrame, roots: DataFrame, points: DataFrame, tile: int) -> DataFrame:
    """Members of ranges that hold several components, without the smallest member, which has met
    all the others. Where they are many, those outside of the largest component and those inside are
    dealt into parts of their own; a tile is a pair of parts, of which one at least is outside."""
    known = roots.withColumnRenamed("node", "rep")
    labelled = (shared.where("rep != least")
                .join(_sent(known, known.count()), "rep", "left")
                .withColumn("label", F.coalesce("root", "rep")).drop("root"))
    many = (labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
            .where("low != high").select("key"))
    largest = (labelled.where(F.col("members") > tile).groupBy("key", "label")
               .agg(F.count(F.lit(1)).alias("n"))
               .groupBy("key").agg(F.max(F.struct("n", "label")).alias("top")))
    rows = labelled.join(many.join(largest, "key", "left"), "key")
    inside = F.coalesce(F.col("label") == F.col("top.label"), F.lit(False))
    parts = lambda n: F.greatest(F.ceil(n / tile), F.lit(1)).cast("int")
    outer = parts(F.col("members") - F.coalesce("top.n", F.lit(0)))
    inner = F.when(F.col("top").isNull(), 0).otherwise(parts(F.col("top.n")))
    dealt = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    rows = rows.withColumn("part", F.when(inside, outer + dealt(inner)).otherwise(dealt(outer)))
    rows = rows.withColumn("other", F.explode(F.sequence(
        F.lit(0), F.when(inside, outer).otherwise(outer + inner) - 1)))
    # The point is joined last, on ids.
    return rows.join(points, "rep").select(
        "key", F.least("part", "other").alias("part_a"), F.greatest("part", "other").alias("part_b"),
        "part", "rep", "label", "point")


def link(docs: DataFrame, width: int = 4, percent: int = 85, id: str = "doc_id",
         text: str = "text", tile: int = TILE) -> DataFrame:
    """Per row its id, the size of its set, and the smallest id that links reach."""
    base = pin(prepare(docs, id, text, width, percent))
    slim = base.select("doc_id", "n_shingles", "mark")
    full = base.where("doc_id is not null and mark is not null")
    reps = full.groupBy("mark").agg(F.min("doc_id").alias("rep"))
    # Only classes go on: the other rows are taken out by their ids.
    copies = pin(full.select("doc_id", "mark").join(reps, "mark").where("doc_id != rep")
                 .select("doc_id", "mark").distinct())
    keyed = (full.join(_sent(copies, copies.count()), ["doc_id", "mark"], "leftanti")
             .select(F.col("doc_id").alias("rep"), F.col("n_shingles").cast("int").alias("size"),
                     F.explode("keys").alias("key")))
    same_key = Window.partitionBy("key")
    shared = pin(keyed.withColumns({"members": F.count("*").over(same_key),
                                    "first": F.min(F.struct("rep", "size")).over(same_key)})
                 .where("members > 1")
                 .select("key", "rep", "size", "members", F.col("first.rep").alias("least"),
                         F.col("first.size").alias("least_size")))
    points = base.where("mark is not null").select(F.col("doc_id").alias("rep"), "point")

    def verified(pairs: DataFrame) -> DataFrame:
        return _verified(pairs, percent, width,
                         lambda ids, count: _texts(docs, id, text, ids, count))

    # Sizes too far apart can't link.
    sizes_fit = f"{percent}L * (size + least_size) <= {100 + percent}L * least(size, least_size)"
    star = shared.where("rep != least").where(sizes_fit).select(
        F.col("least").alias("u"), F.col("rep").alias("v")).distinct()
    member = slim.join(reps, "mark", "left").select("doc_id", "n_shingles", "rep")
    # An id with several texts ties their classes together.
    several = (full.join(reps, "mark").groupBy("doc_id")
               .agg(F.min("rep").alias("v"), F.max("rep").alias("high")).where("v != high"))
    tied = (full.join(reps, "mark").join(several, "doc_id")
            .select(F.col("rep").alias("u"), "v").unionAll(
                several.select(F.col("doc_id").alias("u"), "v")))
    edges = verified(_reaching(star, points, percent)).unionAll(tied)
    roots = components(edges)
    # Pairs of the trees have met this bound already.
    for middle in (True, False):
        among = shared.where(F.col("members") > MIDDLE_FROM) if middle else shared
        rows = _open_rows(among, roots, points, tile)
        more = pin(verified(_tree_pairs(rows, percent, middle)))
        if more.isEmpty():
            continue
        roots = components(more.unionAll(roots.toDF("u", "v")))
    return (member.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
            .select("doc_id", "n_shingles",
                    F.coalesce("root", "rep", "doc_id").alias("component_id")))


def without_near_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that link, however far, to one with a smaller id; of rows that
    repeat an id the one with the least digest stays. Rows without an id stay."""
    marks = pin(link(docs, width, percent).where("doc_id is not null"))
    known = marks.groupBy("doc_id").agg(F.count("*").alias("_rows"),
                                        F.min("component_id").alias("_first"))
    gone = pin(known.where("_first < doc_id").select("doc_id"))
    twice = pin(known.where("_rows > 1 and _first = doc_id").select("doc_id"))
    left = docs.join(_sent(gone, gone.count()), "doc_id", "leftanti")
    if twice.isEmpty():
        return left
    place = unused("_place", docs)
    order = F.sha2(F.to_json(F.struct(*[f"`{c}`" for c in docs.columns])), 256)
    one = (left.join(twice, "doc_id", "leftsemi")
           .withColumn(place, F.row_number().over(Window.partitionBy("doc_id").orderBy(order)))
           .where(F.col(place) == 1).drop(place))
    return left.join(twice, "doc_id", "leftanti").unionByName(one)


@query("op4_jaccard_join")
def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return link(table(spark, folder, "documents"))
