"""Best-fit packing of token sequences, after Martello-Toth dominance reduction.

Lengths are integers of at most ``capacity``, so an instance of any size is its histogram of at most
``capacity`` counts. The driver gets that histogram only, fixes item sets that provably dominate all
others (the reduction works on whole counts), best-fits what is left, and gets runs of equal bins.
Each piece then finds its bin by its rank among pieces of equal length; ranks are dealt in buckets of
places in the written table, so a length that a third of all pieces share, or equal rows, are not one
task's work.

Defined results: null text is empty and has only the end id; a very long text is cut in as many pieces as
it needs, all but the last of ``capacity``; equal rows are packed each on its own, and pieces of equal
length take any of the places for that length; an empty table gives an empty result; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import materialize, ranked, ship
from docloom.llm.tokens import encoder

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int = 1) -> DataFrame:
    """Each document's ids and ``end_id``, cut after every ``capacity`` ids: one row a piece, without ids."""
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary)
        for batch in batches:
            out: list[tuple] = []
            for doc, found in zip(batch.column(0).to_pylist(), tokens.batch(batch.column(1))):
                ids = np.append(found, np.uint32(end_id)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    out.append((doc, k, at, len(part), zlib.crc32(part.tobytes())))
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECE)


# --- the plan on the histogram ----------------------------------------------------------------------


class _Sizes:
    """A multiset of integer sizes with order."""

    def __init__(self, counts: dict[int, int]):
        self.n = {w: k for w, k in counts.items() if k > 0}
        self.order = sorted(self.n)

    def take(self, w: int, k: int) -> None:
        self.n[w] -= k
        if not self.n[w]:
            del self.n[w]
            self.order.pop(bisect_right(self.order, w) - 1)

    def largest(self, most: int, but: dict[int, int] | None = None) -> int:
        """The largest size of at most ``most`` with a free item beside those in ``but``; 0: none."""
        i = bisect_right(self.order, most) - 1
        while i >= 0:
            w = self.order[i]
            if self.n[w] > (but or {}).get(w, 0):
                return w
            i -= 1
        return 0

    def smallest(self, k: int, above: int, but: dict[int, int]) -> list[int]:
        """The ``k`` smallest free items of sizes over ``above``."""
        out: list[int] = []
        i = bisect_right(self.order, above)
        while i < len(self.order) and len(out) < k:
            w = self.order[i]
            out += [w] * min(k - len(out), self.n[w] - but.get(w, 0))
            i += 1
        return out


def _dominating(s: _Sizes, w: int, c: int) -> tuple[int, ...] | None:
    """The set of at most three items that dominates every feasible set with ``w``, if one is proved."""
    room, own = c - w, {w: 1}
    partner = s.largest(room, own)
    if not partner:
        return (w,)
    if partner == room:
        return (w, partner)
    least = s.smallest(3, 0, own)
    fit = sum(1 for k in range(1, len(least) + 1) if sum(least[:k]) <= room)
    if fit <= 1:
        return (w, partner)
    if fit == 2:
        best, x = (0, 0), partner
        while x and 2 * x > sum(best):  # the best pair has its larger item here
            held = {w: 1}
            held[x] = held.get(x, 0) + 1
            y = s.largest(min(x, room - x), held)
            if y and x + y > sum(best):
                best = (x, y)
            x = s.largest(x - 1, own)
        if partner >= sum(best):
            return (w, partner)
        held = {w: 1}
        held[partner] = held.get(partner, 0) + 1
        second = s.largest(room - partner, held)
        over = s.smallest(2, second, own)
        if second and (len(over) < 2 or sum(over) > room):
            return (w, partner, second)
    return None


def reduce_counts(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Permanently fixed bins as (sizes, times), and the counts that are left."""
    s, fixed, moved = _Sizes(counts), [], True
    while moved:
        moved = False
        for w in sorted(s.n, reverse=True):
            while w in s.n and (found := _dominating(s, w, capacity)):
                need = {x: found.count(x) for x in found}
                # Only a full bin, or an item alone, stays dominating while its copies go.
                times = min(s.n[x] // k for x, k in need.items()) if len(found) == 1 or sum(found) == capacity and len(found) == 2 else 1
                for x, k in need.items():
                    s.take(x, k * times)
                fixed.append((found, times))
                moved = True
    return fixed, s.n


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best fit, largest first, on whole counts: bins as ((size, times) ..., number of equal bins)."""
    rooms: list[int] = []  # rooms that occur, in order
    at: dict[int, list[list]] = {}  # room: [contents, number of bins]

    def put(room: int, contents: tuple, n: int) -> None:
        if room not in at:
            insort(rooms, room)
            at[room] = []
        at[room].append([contents, n])

    for w in sorted(counts, reverse=True):
        left = counts[w]
        i = bisect_right(rooms, w - 1)
        while left and i < len(rooms):
            room = rooms[i]
            groups, each = at[room], room // w  # a best-fit bin takes equal items until none fits
            while left and groups:
                contents, n = groups.pop()
                full = min(n, left // each)
                if full:
                    put(room - each * w, contents + ((w, each),), full)
                    left -= full * each
                if full < n:
                    rest = n - full
                    if left:
                        put(room - left * w, contents + ((w, left),), 1)
                        rest, left = rest - 1, 0
                    if rest:
                        groups.append([contents, rest])
                    if not left:
                        break
            if not groups:
                del at[room]
                rooms.remove(room)
            i = bisect_right(rooms, max(room, w - 1)) if left else i
        if left:
            each = capacity // w
            if left // each:
                put(capacity - each * w, ((w, each),), left // each)
            if left % each:
                put(capacity - left % each * w, ((w, left % each),), 1)
    return [(contents, n) for groups in at.values() for contents, n in groups if n]


def plan(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Runs of ranks (size, first rank, first sequence, items a bin, offset), by size and rank; number of sequences."""
    fixed, rest = reduce_counts(counts, capacity)
    bins = [(tuple((x, found.count(x)) for x in dict.fromkeys(found)), n) for found, n in fixed] + best_fit(rest, capacity)
    merged: dict[tuple, int] = {}
    for contents, n in bins:
        merged[contents] = merged.get(contents, 0) + n
    rows, used, base = [], dict.fromkeys(counts, 0), 0
    for contents, n in sorted(merged.items()):
        offset = 0
        for w, each in contents:
            rows.append((w, used[w], base, each, offset))
            used[w] += n * each
            offset += w * each
        base += n
    assert used == {w: k for w, k in counts.items()}, "every item has one place"
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5), base


def pack(lengths: DataFrame, capacity: int) -> DataFrame:
    """``lengths`` (a written table with ``length`` from 1 to ``capacity``) with sequence_id and offset."""
    spark = lengths.sparkSession
    ship(spark)
    counts = {r["length"]: r["count"] for r in lengths.groupBy("length").count().collect()}  # at most `capacity` rows
    runs, _ = plan(counts, capacity)
    sent = spark.sparkContext.broadcast(runs)  # at most a few runs for each of `capacity` sizes
    numbered = ranked(lengths, ["length"], [F.col("doc_id"), F.col("piece")], "_rank")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lengths.schema) + ", sequence_id long, offset long"

    names = list(lengths.columns)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, first, sequence, each, offset = (np.ascontiguousarray(x) for x in sent.value.T)
        keys = size << 44 | first
        for batch in batches:
            w = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            run = np.searchsorted(keys, w << 44 | rank, side="right") - 1
            k = rank - first[run]
            cols = [batch.column(c) for c in names]
            cols += [pa.array(sequence[run] + k // each[run]), pa.array(offset[run] + k % each[run] * w)]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "sequence_id", "offset"])

    return numbered.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Pieces of all documents with the sequence and the offset at which each stands."""
    return pack(materialize(pieces(docs, vocabulary, capacity, end_id), "pieces"), capacity)
