"""Packing token sequences: dominance reduction by Martello and Toth, then best fit.

Documents are tokenized once, each task counting its pieces by length. The plan needs
only the number of pieces of each length (at most `capacity` numbers), so it is made on
the driver whatever the number of documents: sets of up to three pieces that provably
dominate all alternatives for one of them are fixed and leave the instance, and the
rest is packed by best fit, longest first, with equal sequences kept as one pattern and a
number. A piece finds its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.settle import settle
from faultline.llm.shipping import send_code
from faultline.llm.tokens import encode_all

CAPACITY = 2048


@dataclass(frozen=True)
class Pattern:
    """`number` sequences that each hold pieces of these lengths, in this order."""

    lengths: tuple[int, ...]
    number: int


def reduce_dominated(counts: np.ndarray, capacity: int) -> tuple[list[Pattern], np.ndarray]:
    """Fixes sets that dominate every other set with one of their pieces; whatever its length.

    Pieces that fill a sequence together come first: whatever an optimum holds beside one
    can change places with the other. Then every length j, longest first, looks for a set
    that dominates all sets with j. With k the longest other piece that fits beside it: {j}
    when nothing fits; {j, k} when at most one more piece could fit, or when at most two could
    and no such pair is longer than k; {j, k, b}, with b the longest piece beside both, when at
    most two could fit and every pair that fits has a piece up to b or is no longer than k. A
    fixed set leaves the instance as often as it can be formed, since fewer pieces allow fewer
    alternatives. Passes over the lengths go on until one fixes nothing. Returns the
    patterns and what is left.
    """
    left = counts.astype(np.int64).copy()
    held = [int(x) for x in np.flatnonzero(left)]
    fixed: list[Pattern] = []

    def take(*lengths: int) -> None:
        need = {x: lengths.count(x) for x in lengths}
        times = min(int(left[x]) // n for x, n in need.items())
        fixed.append(Pattern(lengths, times))
        for x, n in need.items():
            left[x] -= n * times
            if not left[x]:
                held.remove(x)

    for x in held[::-1]:
        y = capacity - x
        if y == 0:
            take(x)
        elif y <= x and left[y] > (x == y):
            take(x, y)
    again = True
    while again:
        again = False
        for j in held[::-1]:
            while left[j] and (dominating := _dominating(held, left, j, capacity - j)):
                take(*dominating)
                again = True
    return fixed, left


def _dominating(held: list[int], left: np.ndarray, j: int, room: int) -> tuple[int, ...]:
    """The set of up to three pieces that dominates all sets with j; () if there is none."""

    def longest(limit: int, *beside: int) -> int | None:
        for x in held[bisect_right(held, limit) - 1 :: -1] if held[0] <= limit else ():
            if left[x] > beside.count(x):
                return x
        return None

    def overfull(n: int) -> bool:
        """Whether even the n shortest pieces do not fit beside j."""
        total = 0
        for x in held:
            used = min(n, int(left[x]) - (x == j))
            total, n = total + used * x, n - used
            if not n or total > room:
                return total > room
        return True

    def best_pair(above: int) -> int:
        """The largest sum of two pieces beside j that fits, both longer than `above`; else 0."""
        pieces = held[bisect_right(held, above) : bisect_right(held, room)]
        best, low, high = 0, 0, len(pieces) - 1
        while low <= high:
            a, b = pieces[low], pieces[high]
            if left[a] <= (a == j):
                low += 1
            elif a + b > room or left[b] <= (b == j) + (a == b):
                high -= 1
            else:
                best, low = max(best, a + b), low + 1
        return best

    k = longest(room, j)
    if k is None:
        return (j,)
    if k == room or overfull(2):
        return (j, k)
    if not overfull(3):
        return ()
    if best_pair(0) <= k:
        return (j, k)
    b = longest(room - k, j, k)
    return (j, k, b) if b is not None and best_pair(b) <= k else ()


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best fit, longest pieces first, on counts: equal sequences are filled together."""
    open_by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []
    full: list[Pattern] = []

    def put(lengths: tuple[int, ...], number: int, room: int) -> None:
        if room == 0:
            full.append(Pattern(lengths, number))
            return
        if room not in open_by_room:
            open_by_room[room] = []
            insort(rooms, room)
        open_by_room[room].append((lengths, number))

    for x in (int(i) for i in np.flatnonzero(counts)[::-1]):
        waiting = int(counts[x])
        while waiting:
            at = bisect_left(rooms, x)
            if at == len(rooms):
                each = min(capacity // x, waiting)
                number = waiting // each
                put((x,) * each, number, capacity - each * x)
                waiting -= number * each
                continue
            room = rooms[at]
            lengths, number = open_by_room[room].pop()
            each = min(room // x, waiting)
            used = min(number, waiting // each)
            if number > used:
                open_by_room[room].append((lengths, number - used))
            if not open_by_room[room]:
                del open_by_room[room]
                rooms.pop(at)
            put(lengths + (x,) * each, used, room - each * x)
            waiting -= used * each
    rest = [Pattern(lengths, n) for group in open_by_room.values() for lengths, n in group]
    return full + rest


@dataclass(frozen=True)
class Plan:
    """Where the r-th piece of each length stands; arrays by length, then by first rank.

    The first `fixed` of the sequences come from the reduction.
    """

    patterns: list[Pattern]
    first: list[np.ndarray]
    sequence: list[np.ndarray]
    each: list[np.ndarray]
    offset: list[np.ndarray]
    sequences: int
    fixed: int

    def places(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces with these lengths and ranks."""
        sequence = np.zeros(len(lengths), np.int64)
        offset = np.zeros(len(lengths), np.int64)
        for x in np.unique(lengths):
            own = lengths == x
            at = np.searchsorted(self.first[x], ranks[own], side="right") - 1
            inside = ranks[own] - self.first[x][at]
            each = self.each[x][at]
            sequence[own] = self.sequence[x][at] + inside // each
            offset[own] = self.offset[x][at] + inside % each * x
        return sequence, offset


def make_plan(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """Patterns for all pieces, and the look-up from a piece's rank to its place."""
    fixed, left = reduce_dominated(counts, capacity)
    patterns = fixed + best_fit(left, capacity)
    used = np.zeros(capacity + 1, np.int64)
    tables: list[list[tuple[int, int, int, int]]] = [[] for _ in range(capacity + 1)]
    begin = 0
    for pattern in patterns:
        offset, at = 0, 0
        while at < len(pattern.lengths):
            x = pattern.lengths[at]
            each = 1
            while at + each < len(pattern.lengths) and pattern.lengths[at + each] == x:
                each += 1
            tables[x].append((int(used[x]), begin, each, offset))
            used[x] += each * pattern.number
            offset, at = offset + each * x, at + each
        begin += pattern.number
    columns = [np.array(t, np.int64).reshape(-1, 4).T for t in tables]
    return Plan(
        patterns,
        [c[0] for c in columns],
        [c[1] for c in columns],
        [c[2] for c in columns],
        [c[3] for c in columns],
        begin,
        sum(p.number for p in fixed),
    )


def cut_pieces(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids; only the first may be shorter."""
    head = n % capacity
    pieces = [(0, head)] if head else []
    return pieces + [(at, capacity) for at in range(head, n, capacity)]


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    *,
    end_id: int = 0,
    capacity: int = CAPACITY,
    blanks: bool = True,
    keep_ids: bool = False,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32, part, rank [, ids]) of every piece of every row.

    `part` is the task that made the piece and `rank` its number there among the pieces of
    its length, from 0. A null text has only the end id.
    """
    kind = docs.schema[key].dataType.simpleString()
    fields = [
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("part", pa.int64()),
        ("rank", pa.int64()),
    ]
    if keep_ids:
        fields.append(("ids", pa.list_(pa.int64())))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            owners, rows = [], []
            for i, ids in enumerate(encode_all(batch.column(1), tokenizer, blanks)):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for number, (start, length) in enumerate(cut_pieces(len(ids), capacity)):
                    own = ids[start : start + length]
                    row = [number, start, length, zlib.crc32(own.tobytes()), part, int(seen[length])]
                    rows.append([*row, own.astype(np.int64)] if keep_ids else row)
                    owners.append(i)
                    seen[length] += 1
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
            arrays = [pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)]
            owner = batch.column(0).take(pa.array(owners, pa.int64()))
            yield pa.RecordBatch.from_arrays([owner, *arrays], names=["key", *(n for n, _ in fields)])

    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long, part long, rank long"
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = rows.mapInArrow(pieces, schema + (", ids array<long>" if keep_ids else ""))
    return found.withColumnRenamed("key", key)


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    *,
    end_id: int = 0,
    capacity: int = CAPACITY,
    blanks: bool = True,
    keep_ids: bool = False,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset, fixed [, ids]) of every piece.

    Every row of `docs` is a document: its ids and then `end_id`, cut only when longer than
    `capacity`, into pieces of `capacity` after a first one that may be shorter. No
    sequence holds more than `capacity` ids, without gaps. Repeated rows are packed each; a
    null or empty text is the end id alone; an empty table has no sequences. Columns
    other than key and text are not read. `fixed` says that the reduction made the sequence.
    """
    send_code(docs.sparkSession)
    made = settle(
        token_pieces(
            docs, tokenizer, key, text, end_id=end_id, capacity=capacity, blanks=blanks, keep_ids=keep_ids
        )
    )
    by_part = settle(made.groupBy("part", "length").agg(F.count("*").alias("n")))
    # At most `capacity` rows, each a number of pieces.
    by_length = by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for row in by_length:
        counts[row["length"]] = row["n"]
    plan = make_plan(counts, capacity)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = by_part.select(
        "part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            lengths = batch.column(at("length")).to_numpy()
            sequence, offset = plan.places(lengths, batch.column(at("rank")).to_numpy())
            kept = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(at(n)) for n in kept),
                    pa.array(sequence),
                    pa.array(offset),
                    pa.array(sequence < plan.fixed),
                ],
                names=[*kept, "sequence_id", "offset", "fixed"],
            )

    ranked = made.join(before, ["part", "length"]).select(
        key,
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("rank") + F.col("before")).alias("rank"),
        *(["ids"] if keep_ids else []),
    )
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<long>" if keep_ids else ""
    return ranked.mapInArrow(place, schema + ", sequence_id long, offset long, fixed boolean")
