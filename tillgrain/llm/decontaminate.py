"""Benchmark decontamination: pigeonhole edit matching.

Texts are compared as lower-case words of letters and digits, joined by single blanks. An item of m
characters may be changed by at most k = floor(rate * m) edits. It is split into k + 1 pieces; where
it stands with k edits or fewer, one piece stands unchanged. All pieces of all items are searched at
once (Aho-Corasick), and the text around a hit is verified with Myers' bit-parallel distance.

Items go to the executors in blocks of bounded size, one pass over the documents for each block.
Items shorter than ``min_chars`` are searched without edits and as whole words only. Null and empty texts
and items without any word match nothing; of the latter the number is logged, and ``item_counts`` gives it; rows that repeat a document or an item match each; empty tables give no matches. Rows
of the benchmark without an id are searched and reported with a null id.
"""

from __future__ import annotations

import logging
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf

from tillgrain.llm.tables import query, table, unused, whole_text
from tillgrain.session import pin

log = logging.getLogger(__name__)
RATE = 0.05
#: Characters from which an item may stand with edits.
MIN_CHARS = 24
#: Characters of the items that one pass over the documents takes along.
BLOCK_CHARS = 8_000_000
WORD = re.compile(r"[^\W_]+")


def normal(text: str) -> str:
    return " ".join(WORD.findall(text)).lower()


class Pattern:
    """Myers' bit-parallel search for one pattern, of any length."""

    def __init__(self, pattern: str):
        self.m = len(pattern)
        self.bits: dict[str, int] = defaultdict(int)
        for i, c in enumerate(pattern):
            self.bits[c] |= 1 << i
        self.bits = dict(self.bits)

    def best(self, text: str) -> tuple[int, int]:
        """Fewest edits between the pattern and any part of the text, and where the first such part
        ends."""
        mask, high = (1 << self.m) - 1, 1 << (self.m - 1)
        plus, minus, score = mask, 0, self.m
        least, end = score, 0
        get = self.bits.get
        for at, c in enumerate(text, 1):
            eq = get(c, 0)
            zero = (((eq & plus) + plus) ^ plus) | eq | minus
            up = minus | (~(zero | plus) & mask)
            down = plus & zero
            if up & high:
                score += 1
            elif down & high:
                score -= 1
            up = (up << 1) & mask
            down = (down << 1) & mask
            plus = down | (~(zero | up) & mask)
            minus = up & zero
            if score < least:
                least, end = score, at
        return least, end


class Items:
    """Pieces of a block of items, ready to search."""

    def __init__(self, items: tuple[tuple[int, str], ...], rate: float, min_chars: int):
        self.items = [(i, t, int(rate * len(t)) if len(t) >= min_chars else 0) for i, t in items if t]
        self.exact = {n for n, (_, t, _) in enumerate(self.items) if len(t) < min_chars}
        pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, (_, text, k) in enumerate(self.items):
            cuts = [len(text) * j // (k + 1) for j in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces[text[a:b]].append((n, a))
        self.tree = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.tree.add_word(piece, (len(piece), where))
        if pieces:
            self.tree.make_automaton()
        self.patterns: dict[int, tuple[Pattern, Pattern]] = {}

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """Item's number, start, end and edits of every place in a normal text."""
        if not self.items:
            return []
        windows: dict[int, list[list[int]]] = defaultdict(list)
        found = []
        for last, (length, where) in self.tree.iter(text):
            for n, offset in where:
                if n in self.exact:
                    a, b = last + 1 - length, last + 1
                    if text[a - 1:a] in ("", " ") and text[b:b + 1] in ("", " "):
                        found.append((n, a, b, 0))
                    continue
                _, item, k = self.items[n]
                start = last + 1 - length - offset
                span = [max(0, start - k), min(len(text), start + len(item) + k)]
                own = windows[n]
                if own and span[0] < own[-1][1] and span[1] > own[-1][0]:
                    own[-1] = [min(own[-1][0], span[0]), max(own[-1][1], span[1])]
                else:
                    own.append(span)
        return found + [(n, *place) for n, spans in windows.items() for a, b in _merged(spans)
                        for place in self._places(n, text, a, b)]

    def _places(self, n: int, text: str, a: int, b: int) -> Iterator[tuple[int, int, int]]:
        """The best place in the window, then what lies before and after it."""
        _, item, k = self.items[n]
        if n not in self.patterns:
            self.patterns[n] = Pattern(item), Pattern(item[::-1])
        forward, backward = self.patterns[n]
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if b - a < len(item) - k:
                continue
            edits, end = forward.best(text[a:b])
            if edits > k:
                continue
            _, back = backward.best(text[a:a + end][::-1])
            yield a + end - back, a + end, edits
            todo += [(a, a + end - back), (a + end, b)]


def _merged(spans: list[list[int]]) -> list[list[int]]:
    merged: list[list[int]] = []
    for span in sorted(spans):
        if merged and span[0] < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], span[1])
        else:
            merged.append(list(span))
    return merged


@lru_cache(maxsize=2)
def _ready(items: tuple, rate: float, min_chars: int) -> Items:
    return Items(items, rate, min_chars)


MATCH = pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
                   ("edits", pa.int32())])


def text_matches(text: str, items: Items) -> list[dict]:
    """Matches with their characters in the text as it stands."""
    spans = [m.span() for m in WORD.finditer(text)]
    words = [text[a:b].lower() for a, b in spans]
    found = items.find(" ".join(words))
    if not found:
        return []
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    made = []
    for n, a, b, edits in found:
        first = bisect_right(starts, a) - 1
        last = max(first, bisect_right(starts, b - 1) - 1)
        made.append({"item_id": items.items[n][0], "start": spans[first][0],
                     "end": spans[last][1], "edits": edits})
    return sorted(made, key=lambda x: (x["start"], x["end"], x["item_id"] is None, x["item_id"]))


def item_blocks(benchmark: DataFrame, id: str = "item_id", text: str = "text",
                block_chars: int = BLOCK_CHARS) -> Iterator[tuple[tuple[int, str], ...]]:
    """The items in blocks of about the given size, one of them on the driver at a time."""
    items = benchmark.select(F.col(f"`{id}`").cast("long").alias("item_id"),
                             whole_text(text).alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    bare = 0
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = part.orderBy("item_id", "text").collect()
        if rows:
            made = tuple((r["item_id"], normal(r["text"])) for r in rows)
            bare += sum(not t for _, t in made)
            yield made
    if bare:
        log.warning("%d items without any word are not searched", bare)


def item_counts(benchmark: DataFrame, id: str = "item_id", text: str = "text",
                min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> dict[str, int]:
    """How many items are searched with edits, how many exactly, and how many hold no word."""
    counts = Counter({"edits": 0, "exact": 0, "none": 0})
    for items in item_blocks(benchmark, id, text, block_chars):
        counts.update("none" if not t else "exact" if len(t) < min_chars else "edits"
                      for _, t in items)
    return dict(counts)


def add_matches(docs: DataFrame, items: tuple, text: str, into: str, rate: float,
                min_chars: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    @arrow_udf("array<struct<item_id:bigint,start:int,end:int,edits:int>>")
    def search(texts: pa.Array) -> pa.Array:
        ready = _ready(shared.value, rate, min_chars)
        return pa.array((text_matches(t.as_py() or "", ready) for t in texts), pa.list_(MATCH))

    return docs.withColumn(into, search(whole_text(text)))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
               rate: float = RATE, min_chars: int = MIN_CHARS,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row for every place of an item in a document: the ids, the characters from start to before
    end, and the edits. The same place may hold several items."""
    slim = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), whole_text(text).alias("text"))
    parts = []
    for items in item_blocks(benchmark, block_chars=block_chars):
        hits = add_matches(slim, items, "text", "found", rate, min_chars)
        parts.append(hits.where(F.size("found") > 0)
                     .select("doc_id", F.inline("found")))
        if len(parts) > 1:
            parts = [pin(parts[0].unionAll(parts[1]))]
    if not parts:
        return docs.sparkSession.createDataFrame(
            [], "doc_id bigint, item_id bigint, start int, end int, edits int")
    return parts[0]


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", rate: float = RATE,
                  min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents in which no item stands, as they are."""
    flag = unused("_leaks", docs)
    kept = docs
    for items in item_blocks(benchmark, block_chars=block_chars):
        kept = (add_matches(kept, items, text, flag, rate, min_chars)
                .where(F.size(flag) == 0).select(*[f"`{c}`" for c in docs.columns]))
    return kept


@query("op5_decontaminate")
def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
