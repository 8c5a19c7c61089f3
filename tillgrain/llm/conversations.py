"""Conversation structure repair by a cost DP and prefix-doubling path ranking.

A conversation's rows are read in the order of their turns and edited so that the initials of the
roles give an optional s and then pairs of u and a, or nothing: Keep, Rerole, Delete or Insert, at the
least cost, and among the cheapest edits with the audit, their initials, that is first in ASCII.

* Nodes are the places between rows, times four states of the role pattern. A row, with the inserts
  before it, is a matrix of costs between states; products of matrices by doubling (each place takes
  the product of twice as many rows as before) give each node's cost to the end.
* Arcs of a cheapest path are ranked by the least audit that begins with them, for audits of length
  1, 2, 4 and so on: the rank of the next length is that of the pair of ranks of the arc and of the best arc
  where its audit ends. Each arc points there; the pointers double with the lengths. A node's best arc is
  that of the lowest rank. A letter leads from a node to one other node only, since a state takes
  either a user or an assistant, so a pointer is the one end of its audit.
* The least path is read off the doubled pointers, every step at once by the bits of its number.

Long conversations are cut into pieces of bounded size along a distributed order of all rows. Costs
pass from piece to piece as matrices, chosen paths as the state that each entry state ends in, so a
chain holds a few numbers for each ``PIECE`` rows; what no piece holds is a whole conversation. Only the
digest of the repaired text, which SHA-256 defines byte after byte, streams a conversation through one
task, a batch of rows at a time.

Nulls in role or text read as one space. Rows of a turn are in the order of role and of their
text's MD5; equal rows are interchangeable and are held once with their number. Rows without a conversation id
are one conversation. An empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillgrain.llm.tables import query, table
from tillgrain.session import pin

PIECE = 4_096
#: Rows whose pieces are worked on at once.
BULK = 16_384
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
RER_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
#: States: nothing yet, after s, after u, after a; and where s, u and a lead (-1: nowhere).
STATES = 4
MOVES = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1)}
#: Where the one of user and assistant leads that a state takes.
TAKES = np.array([2, 2, 3, 2])
ACCEPTS = (0, 3)
FAR = 1 << 50
LETTERS = "DIKR"


# ---- damage

def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """conv_id, turn, role, text and how often the row stands there after the damage; a dropped row
    stays with zero."""
    said = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    way = F.crc32(F.concat(said(conv), F.lit(":"), said(turn)).cast("binary")) % 20
    return rows.select(F.col(f"`{conv}`").cast("long").alias("conv_id"),
                       F.col(f"`{turn}`").cast("long").alias("turn"), said(role).alias("role"),
                       said(text).alias("text"), way.alias("way")).select(
        "conv_id", "turn", F.when(F.col("way") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("way") == 1, "").when(F.col("way") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("way") == 0, 0).when(F.col("way") == 3, 2).otherwise(1).alias("copies"))


def _visible_end(text: Column) -> Column:
    """The last character that isn't white space, empty if there is none."""
    return F.substring(F.rtrim(text, F.lit(" \t\n\x0b\x0c\r")), -1, 1)


def grouped(rows: DataFrame) -> DataFrame:
    """Equal rows as one with their number; dropped rows only tell that there is a conversation. ``own``
    tells whether a row is blank (1), ends without a mark (3) or is whole (0)."""
    end = _visible_end(F.col("text"))
    there = F.col("copies") > 0
    own = (F.when(end == "", BLANK).when(end.isin(".", "!", "?"), 0).otherwise(TRUNCATED)).cast("int")
    return (rows.select(
        "conv_id", F.when(there, F.col("turn")).alias("turn"), F.when(there, F.col("role")).alias("role"),
        F.when(there, F.unhex(F.md5(F.col("text").cast("binary")))).alias("mark"),
        F.when(there, own).alias("own"), "copies")
        .groupBy("conv_id", "turn", "role", "mark", "own").agg(F.sum("copies").alias("copies")))


def faulty(groups: DataFrame) -> DataFrame:
    """The groups that are there, with the fault of their first row; the other ones of a group are
    blank or duplicates."""
    rows = groups.where("copies > 0")
    first = F.struct(F.col("turn").isNotNull().alias("has"), "turn")
    said_again = (rows.groupBy("conv_id", "role", "mark").agg(
        F.min(first).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1")
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("mark").alias("m"), "first"))
    same = (F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
            & (F.col("mark") == F.col("m")))
    late = F.col("first").isNotNull() & ~(F.col("turn").eqNullSafe(F.col("first.turn")))
    return rows.join(said_again, same, "left").select(
        "conv_id", "turn", "role", "mark", "copies",
        F.when(F.col("own") == BLANK, BLANK).when(late, DUPLICATE).otherwise(F.col("own"))
        .cast("int").alias("fault"))


# ---- costs

def insert_costs() -> np.ndarray:
    """Least cost of inserts that lead from state to state."""
    made = np.full((STATES, STATES), FAR, np.int64)
    for state in range(STATES):
        at, cost = state, 0
        for _ in range(STATES):
            made[state, at] = min(made[state, at], cost)
            at, cost = int(TAKES[at]), cost + INSERT_COST
    return made


INSERTS = insert_costs()
END = np.minimum(INSERTS[:, list(ACCEPTS)].min(axis=1), FAR)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus products of matrices, one by one."""
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(axis=-2), FAR)


def row_arcs(initial: np.ndarray, fault: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per row and state: the costs of Delete, Keep and Rerole, and where Keep leads. Copies beyond
    the first are deleted whatever the edit, right after it."""
    later = DELETE_COST * (copies - 1)
    forced = (fault == BLANK) | (fault == DUPLICATE)
    extra = np.where(fault == TRUNCATED, TRUNCATED_COST, 0) + later
    to = np.full((len(initial), STATES), -1, np.int64)
    for letter, moves in MOVES.items():
        to[initial == ord(letter)] = moves
    keep = np.where((to >= 0) & ~forced[:, None], extra[:, None], FAR)
    change = np.broadcast_to(np.where(forced, FAR, RER_COST + extra)[:, None], to.shape)
    drop = np.broadcast_to((DELETE_COST + later)[:, None], to.shape)
    return drop, keep, change, to


def row_matrices(arcs: tuple[np.ndarray, ...]) -> np.ndarray:
    """Costs between the states before and after each row, with the inserts before it."""
    drop, keep, change, to = arcs
    plain = np.full((len(drop), STATES, STATES), FAR, np.int64)
    at = np.arange(len(drop))
    for state in range(STATES):
        plain[:, state, state] = drop[:, state]
        target = int(TAKES[state])
        plain[:, state, target] = np.minimum(plain[:, state, target], change[:, state])
        kept = np.maximum(to[:, state], 0)
        plain[at, state, kept] = np.minimum(plain[at, state, kept], keep[:, state])
    return product(np.broadcast_to(INSERTS, plain.shape), plain)


def suffix_products(matrices: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """At each place the product up to the end of its run, by doubling. ``ends``: one past the run."""
    made, step, at = matrices.copy(), 1, np.arange(len(matrices))
    most = int((ends - at).max(initial=0))
    while step < most:
        more = np.flatnonzero(at + step < ends)
        made[more] = product(made[more], made[more + step])
        step *= 2
    return made


# ---- paths

def dense(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Ranks of pairs of ranks."""
    span = np.int64(second.max(initial=0) + 1)
    return np.unique(first.astype(np.int64) * span + second, return_inverse=True)[1].reshape(first.shape)


def least_paths(arcs: tuple[np.ndarray, ...], begins: np.ndarray, ends: np.ndarray, last: np.ndarray,
                after: np.ndarray, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each piece and entry state the letters of the least cheapest path, and where it leaves.

    Pieces are runs ``begins`` to ``ends`` of rows. ``after``: by piece and state the cost from its end on;
    ``last``: whether the conversation ends there, with inserts if needed. ``costs``: by row and state
    the cost from before the row on. Gives the letters as an object array by piece and entry state, and
    the state in which the piece is left."""
    drop, keep, change, to = arcs
    pieces = len(begins)
    # Nodes: every row's states, then the states at the end of every piece, then the end of all.
    rows, tail = len(drop), len(drop) * STATES
    over = tail + pieces * STATES
    state = np.tile(np.arange(STATES), rows)
    here = costs.ravel()
    following = np.empty(rows, np.int64)
    following[:] = (np.arange(rows) + 1) * STATES
    following[ends - 1] = tail + np.arange(pieces) * STATES
    value = np.concatenate([here, after.ravel(), [0]])
    base = np.repeat(following, STATES)
    own = np.repeat(np.arange(rows) * STATES, STATES)
    # Arcs by node and letter D, I, K, R; FAR marks those that are no part of a cheapest path.
    heads = np.full((over + 1, 4), over, np.int64)
    used = np.zeros((over + 1, 4), bool)
    for letter, (head, cost) in enumerate([
            (base + state, drop.ravel()), (own + TAKES[state], np.full(tail, INSERT_COST)),
            (base + np.maximum(to.ravel(), 0), keep.ravel()), (base + TAKES[state], change.ravel())]):
        ok = (here < FAR) & (cost < FAR) & (value[head] + cost == here)
        heads[:tail, letter], used[:tail, letter] = np.where(ok, head, over), ok
    # At a conversation's end inserts may follow; elsewhere the path leaves the piece.
    at_end = np.tile(np.arange(STATES), pieces)
    stop = np.repeat(last, STATES)
    ready = stop & np.isin(at_end, ACCEPTS)
    add = stop & ~ready
    heads[tail:over, 1] = np.where(add, tail + np.repeat(np.arange(pieces) * STATES, STATES)
                                   + TAKES[at_end], over)
    used[tail:over, 1] = add

    # Ranks: 0 where the path is over, else by letter; unused arcs come last.
    none = np.int64(5)
    rank = np.where(used, np.arange(1, 5), none)
    closed = ~used.any(axis=1)
    rank[closed, 0] = 0
    heads[closed] = np.arange(over + 1)[closed, None]
    target = heads
    longest = int((ends - begins).max(initial=0)) * 3 + 4
    length = 1
    while length < longest:
        best = rank.argmin(axis=1)
        node = target
        onward = rank[node, best[node]]
        rank = dense(rank, onward)
        target = target[node, best[node]]
        length *= 2
    best = rank.argmin(axis=1)

    # The chosen arcs as pointers, doubled again; a step's node follows from the bits of its number.
    nodes = np.arange(over + 1)
    step = heads[nodes, best]
    moved = step != nodes
    doubled = [step]
    count = moved.astype(np.int64)
    while (1 << len(doubled)) <= longest:
        reach = doubled[-1]
        count = count + count[reach]
        doubled.append(reach[reach])
    starts = (begins[:, None] * STATES + np.arange(STATES)).ravel()
    sizes = count[starts]
    place = np.repeat(starts, sizes)
    number = np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    for bit, reach in enumerate(doubled):
        on = (number >> bit) & 1 == 1
        place[on] = reach[place[on]]
    letters = np.frombuffer(LETTERS.encode(), np.uint8)[best[place]]
    cuts = np.cumsum(sizes)[:-1]
    words = np.empty(pieces * STATES, object)
    words[:] = np.split(letters, cuts)
    final = starts.copy()
    for bit, reach in enumerate(doubled):
        on = (sizes >> bit) & 1 == 1
        final[on] = reach[final[on]]
    left = np.where((final >= tail) & (final < over), (final - tail) % STATES, -1)
    return words.reshape(pieces, STATES), left.reshape(pieces, STATES)


def with_copies(letters: np.ndarray, copies: np.ndarray) -> bytes:
    """The audit of a piece: each row's letter is followed by the deletes of its further copies."""
    own = letters != ord("I")
    size = np.ones(len(letters), np.int64)
    size[own] = copies
    made = np.full(int(size.sum()), ord("D"), np.uint8)
    made[np.cumsum(size) - size] = letters
    return made.tobytes()


# ---- pieces

PLACE = ["conv_id", "turn", "role", "mark"]


def legal(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    s, u, a = (ord(c) for c in "sua")
    return (((before == s) & (after == u)) | ((before == u) & (after == a))
            | ((before == a) & (after == u)))


def pieces_of(rows: DataFrame, piece: int) -> DataFrame:
    """A row for each piece: where it begins, its counts, its rows packed, and its matrix."""
    schema = ("conv_id bigint, turn bigint, role string, mark binary, blank bigint, duplicate bigint, "
              "truncated bigint, illegal bigint, first int, last int, low bigint, high bigint, "
              "turns bigint, first_turn bigint, last_turn bigint, facts binary, matrix binary")

    def table_of(held: list[list], begins: list[int]) -> pa.RecordBatch:
        conv, turn, role, mark, copies, fault = held
        begins = np.array(begins)
        ends = np.append(begins[1:], len(conv))
        initial = np.array([(r.encode()[:1] or b"\0")[0] for r in role], np.uint8)
        copies, fault = np.array(copies, np.int64), np.array(fault, np.uint8)
        first = suffix_products(row_matrices(row_arcs(initial, fault, copies)),
                                np.repeat(ends, ends - begins))[begins]
        inner = np.ones(len(conv), bool)
        inner[begins] = False
        before = np.concatenate([[0], initial[:-1]])
        bad = copies - 1 + (inner & ~legal(before, initial))
        has = np.array([t is not None for t in turn])
        known = np.array([0 if t is None else t for t in turn], np.int64)
        new = has & ~(inner & np.concatenate([[False], has[:-1]])
                      & (np.concatenate([[0], known[:-1]]) == known))
        later = np.where(fault == BLANK, 0, np.where(fault == DUPLICATE, copies, copies - 1))
        sums = [np.add.reduceat(x.astype(np.int64), begins) for x in (
            np.where(fault == BLANK, copies, 0), later, fault == TRUNCATED, bad, new)]
        spans = [[t for t in turn[b:e] if t is not None] for b, e in zip(begins, ends)]
        at = lambda x, n: [x[k] for k in n]
        facts = [initial[b:e].tobytes() + fault[b:e].tobytes() + copies[b:e].tobytes()
                 for b, e in zip(begins, ends)]
        # Turns come in order, nulls first.
        return pa.RecordBatch.from_arrays([
            pa.array(at(conv, begins), pa.int64()), pa.array(at(turn, begins), pa.int64()),
            pa.array(at(role, begins), pa.string()), pa.array(at(mark, begins), pa.binary()),
            *[pa.array(x) for x in sums[:4]],
            pa.array(initial[begins].astype(np.int32)), pa.array(initial[ends - 1].astype(np.int32)),
            pa.array([x[0] if x else None for x in spans], pa.int64()),
            pa.array([x[-1] if x else None for x in spans], pa.int64()), pa.array(sums[4]),
            pa.array(at(turn, begins), pa.int64()), pa.array(at(turn, ends - 1), pa.int64()),
            pa.array(facts, pa.binary()), pa.array([m.tobytes() for m in first], pa.binary())],
            [f.split()[0] for f in schema.split(", ")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(6)]
        begins: list[int] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                count = len(held[0])
                if not begins or row[0] != held[0][-1] or count - begins[-1] >= piece:
                    if count >= BULK:
                        yield table_of(held, begins)
                        held, begins, count = [[] for _ in range(6)], [], 0
                    begins.append(count)
                for column, value in zip(held, row):
                    column.append(value)
        if begins:
            yield table_of(held, begins)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.select(*PLACE, "copies", "fault").repartitionByRange(parts, *PLACE)
            .sortWithinPartitions(*PLACE).mapInArrow(work, schema)
            .withColumn("at", F.monotonically_increasing_id()))


def chained(pieces: DataFrame) -> DataFrame:
    """For each piece the costs after it by state, the cheapest cost from it on in state 0, whether the
    conversation ends there, and what happens at the border to the piece before it. Runs through
    a conversation's pieces from the last to the first and holds one at a time."""
    schema = ("at bigint, after binary, cost bigint, last boolean, edge_illegal int, same_turn int")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        behind = None
        for batch in batches:
            made: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                conv, at, matrix, first, last, first_turn, last_turn = row
                matrix = np.frombuffer(matrix, np.int64).reshape(STATES, STATES)
                ends = behind is None or behind[0] != conv
                after = END if ends else behind[1]
                before = np.minimum((matrix + after[None, :]).min(axis=1), FAR)
                # The border belongs to the piece behind it.
                crossed = not ends and not legal(np.array([last]), np.array([behind[2]]))[0]
                same = not ends and last_turn is not None and last_turn == behind[3]
                made.append((at, after.tobytes(), int(before[0]), ends, int(crossed), int(same)))
                behind = conv, before, first, first_turn
            if made:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*made), (
                        pa.int64(), pa.binary(), pa.int64(), pa.bool_(), pa.int32(), pa.int32()))],
                    [f.split()[0] for f in schema.split(", ")])

    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (pieces.select("conv_id", "at", "matrix", "first", "last", "first_turn", "last_turn")
            .repartition(parts, "conv_id").sortWithinPartitions("conv_id", F.desc("at"))
            .mapInArrow(work, schema))


def path_choices(pieces: DataFrame) -> DataFrame:
    """The audit of every piece for each state in which it may be entered, and where it is left."""
    names = PLACE + ["at"]
    schema = "conv_id bigint, turn bigint, role string, mark binary, at bigint, " \
             "audits array<binary>, leaves array<int>"

    def solve(held: list[tuple]) -> pa.RecordBatch:
        facts = [np.frombuffer(row[5], np.uint8) for row in held]
        sizes = np.array([len(f) // 10 for f in facts])
        initial = np.concatenate([f[:n] for f, n in zip(facts, sizes)])
        fault = np.concatenate([f[n:2 * n] for f, n in zip(facts, sizes)])
        copies = np.concatenate([f[2 * n:].view(np.int64) for f, n in zip(facts, sizes)])
        ends = np.cumsum(sizes)
        begins = ends - sizes
        after = np.stack([np.frombuffer(row[6], np.int64) for row in held])
        arcs = row_arcs(initial, fault, copies)
        whole = suffix_products(row_matrices(arcs), np.repeat(ends, sizes))
        costs = np.minimum((whole + np.repeat(after, sizes, axis=0)[:, None, :]).min(axis=2), FAR)
        words, left = least_paths(arcs, begins, ends, np.array([row[7] for row in held]), after, costs)
        audits = [[with_copies(words[n, q], copies[b:e]) if left[n, q] >= 0 else b""
                   for q in range(STATES)] for n, (b, e) in enumerate(zip(begins, ends))]
        columns = list(zip(*held))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns[:5], (
                pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int64()))]
            + [pa.array(audits, pa.list_(pa.binary())), pa.array(left.tolist(), pa.list_(pa.int32()))],
            [f.split()[0] for f in schema.split(", ")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                rows += len(row[5]) // 10
                if rows >= BULK:
                    yield solve(held)
                    held, rows = [], 0
        if held:
            yield solve(held)

    return pieces.select(*names, "facts", "after", "last_piece").mapInArrow(work, schema)


def chosen(choices: DataFrame) -> DataFrame:
    """The audit of every piece, for the state in which the piece before it leaves."""
    schema = "conv_id bigint, turn bigint, role string, mark binary, audit binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            audits = []
            for conv, pieces, leaves in zip(*(batch.column(n).to_pylist() for n in (0, 5, 6))):
                state = before[1] if before and before[0] == conv else 0
                audits.append(pieces[state])
                before = conv, leaves[state]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(audits, pa.binary())],
                ["conv_id", "turn", "role", "mark", "audit"])

    parts = int(choices.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (choices.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "at")
            .mapInArrow(work, schema))


# ---- the repaired conversations

class Repair:
    """Reads a conversation's rows beside its audit and gives the lines that stay."""

    def __init__(self) -> None:
        self.state, self.letters, self.at = 0, b"", 0

    def more(self, letters: bytes) -> None:
        self.letters, self.at = self.letters[self.at:] + letters, 0

    def inserts(self) -> Iterator[str]:
        while self.at < len(self.letters) and self.letters[self.at] == ord("I"):
            self.at += 1
            yield self._taken() + ":"

    def row(self, role: str, text: str) -> Iterator[str]:
        yield from self.inserts()
        letter = chr(self.letters[self.at])
        self.at += 1
        if letter == "K":
            self.state = MOVES[role[0]][self.state]
            yield f"{role}:{text}"
        elif letter == "R":
            yield f"{self._taken()}:{text}"

    def _taken(self) -> str:
        self.state = int(TAKES[self.state])
        return "user" if self.state == 2 else "assistant"


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Per conversation the lines that the audit leaves, one after the other: conv_id, audit and the
    SHA-256 of the lines. ``rows`` as from ``damaged``."""
    schema = "conv_id bigint, audit string, repaired_sha256 string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: tuple | None = None
        made: list[tuple] = []

        def told(lines) -> None:
            for line in lines:
                if open_[4]:
                    open_[2].update(b"\n")
                open_[2].update(line.encode())
                open_[4].append(1) if not open_[4] else None

        def close() -> None:
            if open_ is not None:
                told(open_[1].inserts())
                made.append((open_[0], b"".join(open_[3]).decode(), open_[2].hexdigest()))

        for batch in batches:
            for conv, role, text, copies, audit in zip(*(batch.column(n).to_pylist() for n in range(5))):
                if open_ is None or open_[0] != conv:
                    close()
                    open_ = conv, Repair(), hashlib.sha256(), [], []
                if audit is not None:
                    open_[1].more(audit)
                    open_[3].append(audit)
                    continue
                for _ in range(copies):
                    told(open_[1].row(role, text))
            if made:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*made), (pa.int64(), pa.string(), pa.string()))],
                    ["conv_id", "audit", "repaired_sha256"])
                made = []
        close()
        if made:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*made), (pa.int64(), pa.string(), pa.string()))],
                ["conv_id", "audit", "repaired_sha256"])

    # A piece's audit comes right before its first row.
    said = (rows.where("copies > 0").withColumn("mark", F.unhex(F.md5(F.col("text").cast("binary"))))
            .select(*PLACE, F.lit(1).alias("kind"), "text", "copies", F.lit(None).cast("binary").alias("audit")))
    begins = audits.select(*PLACE, F.lit(0).alias("kind"), F.lit(None).cast("string").alias("text"),
                           F.lit(0).alias("copies"), "audit")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (said.unionByName(begins).repartition(parts, "conv_id").sortWithinPartitions(*PLACE, "kind")
            .select("conv_id", "role", "text", "copies", "audit").mapInArrow(work, schema))


def repair(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """Per conversation its counts, cost, audit and the digest of what is left. ``rows``: conv_id, turn,
    role, text, copies."""
    groups = pin(grouped(rows))
    pieces = pin(pieces_of(faulty(groups), piece))
    chain = pin(chained(pieces))
    linked = pieces.join(chain.withColumnRenamed("last", "last_piece"), "at")
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    counts = linked.groupBy("conv_id").agg(
        (F.max(wide("high")) - F.min(wide("low")) + 1 - F.sum("turns") + F.sum("same_turn")).alias("gaps"),
        F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"),
        F.sum("truncated").alias("truncated"),
        (F.sum("illegal") + F.sum("edge_illegal")).alias("illegal"),
        F.min_by("cost", "at").alias("cost"))
    audits = chosen(pin(path_choices(linked)))
    lines = repaired(rows, audits)
    all_ = groups.select("conv_id").distinct()
    same = lambda a, b: a["conv_id"].eqNullSafe(b["conv_id"])
    zero = lambda c: F.coalesce(counts[c], F.lit(0)).cast("long").alias(c)
    return (all_.join(counts, same(all_, counts), "left").join(lines, same(all_, lines), "left")
            .select(all_["conv_id"], *[zero(c) for c in (
                "gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                F.coalesce("audit", F.lit("")).alias("audit"),
                F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256))
                .alias("repaired_sha256")))


def _sql_options(state: int, takes: int, keeps: dict[str, int]) -> str:
    """The edits of a row in a state: cost, audit and lines up to the end."""
    option = lambda cost, letter, line, to: (
        f"{{'c': {cost} + v{to}.c, 'a': '{letter}' || v{to}.a, 'l': list_concat({line}, v{to}.l)}}")
    kept = " ".join(f"WHEN initial = '{i}' THEN {option('more', 'K', '[line]', to)}"
                    for i, to in keeps.items())
    name = "user" if takes == 2 else "assistant"
    return (f"list_min([{option(2, 'D', '[]::VARCHAR[]', state)}, "
            f"CASE WHEN forced THEN NULL {kept} END, CASE WHEN NOT forced THEN "
            f"""{option('1 + more', 'R', f"['{name}:' || text]", takes)} END]) AS w{state}""")


def _sql_inserts(state: int, *onward: int) -> str:
    """A state with inserts before the row."""
    name = {2: "user:", 3: "assistant:"}
    made = [f"w{state}"]
    for n in range(1, len(onward) + 1):
        said = ", ".join(f"'{name[to]}'" for to in onward[:n])
        to = onward[n - 1]
        made.append(f"{{'c': {5 * n} + w{to}.c, 'a': '{'I' * n}' || w{to}.a, 'l': list_concat([{said}], w{to}.l)}}")
    return f"list_min([{', '.join(made)}]) AS v{state}"


ORACLE = f"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
    lambda t, z: CASE WHEN t & 1 = 1 THEN xor(t >> 1, 3988292384) ELSE t >> 1 END) AS v
    FROM range(0, 256) r(i))),
ways AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295,
    list_reduce(list_prepend(4294967295, list_transform(string_split(
      coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
      lambda c: ascii(c)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS way
  FROM conversations, crc),
harmed AS (
  SELECT conv_id, turn, CASE WHEN way = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN way = 1 THEN '' WHEN way = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM ways, range(0, CASE way WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) r(i)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS spot,
    left(role, 1) AS initial, regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*\\z', 1) AS ends
  FROM harmed),
judged AS (
  SELECT *, CASE WHEN ends = '' THEN 1
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY spot) > 1 THEN 2
    WHEN ends NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY spot) AS before FROM placed),
steps AS (
  SELECT conv_id, spot, initial, text, role || ':' || text AS line, fault IN (1, 2) AS forced,
    CASE WHEN fault = 3 THEN 5 ELSE 0 END AS more FROM judged),
walk AS (
  SELECT conv_id, max(spot) + 1 AS spot, {{'c': 0, 'a': '', 'l': []::VARCHAR[]}} AS v0,
    {{'c': 10, 'a': 'II', 'l': ['user:', 'assistant:']}} AS v1,
    {{'c': 5, 'a': 'I', 'l': ['assistant:']}} AS v2, {{'c': 0, 'a': '', 'l': []::VARCHAR[]}} AS v3
  FROM steps GROUP BY conv_id
  UNION ALL
  SELECT conv_id, spot, {_sql_inserts(0, 2, 3)}, {_sql_inserts(1, 2, 3)}, {_sql_inserts(2, 3)},
    {_sql_inserts(3, 2)}
  FROM (SELECT s.conv_id, s.spot, {_sql_options(0, 2, {'s': 1, 'u': 2})}, {_sql_options(1, 2, {'u': 2})},
    {_sql_options(2, 3, {'a': 3})}, {_sql_options(3, 2, {'u': 2})}
    FROM walk w JOIN steps s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.spot = w.spot - 1)),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
    count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(v0.c, 0)::BIGINT AS cost, coalesce(v0.a, '') AS audit,
  sha256(coalesce(array_to_string(v0.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN (SELECT * FROM walk WHERE spot = 1) w ON w.conv_id IS NOT DISTINCT FROM a.conv_id"""


@query("op13_conversation_repair", ORACLE)
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair(damaged(table(spark, folder, "conversations")))
