"""Training-order materialisation: token sequences in a keyed order, as fixed-stride binary shards.

1. The ids of all documents, each followed by an end id, are one stream in the order of files and of rows in files.
   Each task writes its parts of it once, as a table; where a part stands in the stream follows from the counts of
   the parts before it (one row for each task's part of a file goes to the driver). The stream is cut into sequences
   of ``length`` ids; only its last is filled up with the end id. So sequences do not depend on how Spark splits files.
2. A balanced Feistel network over the next even power of two, walked until it falls below the number of
   sequences, is a keyed permutation: every sequence gets one global slot, and the inverse finds it again.
3. Slots are range partitioned: shard s holds slots s * per_shard and on, in slot order, one file a shard.
   A record is ``length`` little-endian unsigned ids (2 bytes where the vocabulary allows, else 4) and one
   line feed, so the record of a slot starts at (slot % per_shard) * stride. Spark's own writer commits the
   files, so lost tasks are written again and any file system that Spark writes to will do.
4. Readers take whole shards in order, or any slot range: a run resumes from a slot alone.

Defined results: null text is empty and has its end id only; very long texts run over many sequences; repeated rows are
tokenised each (and ties in the order do not occur: rows have places); an empty table gives no shards and empty results;
other columns, whatever their names, are ignored. Tables that do not come from Parquet files are written first, in the
order of their partitions.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import MASK, materialize, mix64, positioned, ship, workspace
from docloom.llm.tokens import encoder


class Feistel:
    """A keyed permutation of 0 .. n - 1 with its inverse, over int64 arrays."""

    def __init__(self, n: int, key: int, rounds: int = 6):
        self.n, self.half = n, max(1, -(-max(1, n - 1).bit_length() // 2))
        self.low = np.uint64((1 << self.half) - 1)
        seeds = mix64(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key & MASK))
        self.keys = list(seeds)

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        shift = np.uint64(self.half)
        left, right = x >> shift, x & self.low
        if back:
            for k in reversed(self.keys):
                left, right = right ^ (mix64(left + k) & self.low), left
        else:
            for k in self.keys:
                left, right = right, left ^ (mix64(right + k) & self.low)
        return left << shift | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        out = self._once(np.asarray(x).astype(np.uint64), back)
        while (on := np.flatnonzero(out >= np.uint64(self.n))).size:
            out[on] = self._once(out[on], back)
        return out.astype(np.int64)

    def slot(self, sequence: np.ndarray) -> np.ndarray:
        return self._walk(sequence, False)

    def sequence(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, True)


@dataclass(frozen=True)
class Layout:
    """Everything a reader needs beside the shards."""

    sequences: int
    length: int
    width: int
    per_shard: int
    key: int

    @property
    def stride(self) -> int:
        return self.length * self.width + 1

    @property
    def shards(self) -> int:
        return -(-self.sequences // self.per_shard)

    def order(self) -> Feistel:
        return Feistel(max(1, self.sequences), self.key)


def streams(docs: DataFrame, vocabulary: str, length: int, end_id: int, width: int = 2) -> DataFrame:
    """file, first (row of the file that a task's part of it begins with), at (ids before in that part), n, ids.

    A row has ``length`` ids at most (little-endian, ``width`` bytes each).
    """
    ship(docs.sparkSession)
    kind = {2: "<u2", 4: "<u4"}[width]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary)
        file, first, after, at = None, 0, 0, 0
        held, size = [], 0

        def flush(everything: bool) -> pa.RecordBatch:
            nonlocal held, size, at
            stream = np.concatenate(held) if held else np.zeros(0, kind)
            n = len(stream) if everything else len(stream) // length * length
            raw = stream[:n].tobytes()
            out = [raw[i * width : (i + length) * width] for i in range(0, n, length)]
            ends = np.minimum(np.arange(length, n + length, length), n)
            begins = np.arange(0, n, length)
            columns = [pa.array([file] * len(out), pa.string()), pa.array([first] * len(out), pa.int64()), pa.array(at + begins, pa.int64()), pa.array(ends - begins, pa.int32()), pa.array(out, pa.binary())]
            held, size, at = [stream[n:]], size - n, at + n
            return pa.RecordBatch.from_arrays(columns, names=["file", "first", "at", "n", "ids"])

        for batch in batches:
            places = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for (name, row), ids in zip(places, tokens.batch(batch.column(2))):
                if name != file or row != after:  # another part of the files
                    yield flush(True)
                    file, first, at = name, row, 0
                if width == 2 and len(ids) and int(ids.max()) > 0xFFFF:
                    raise ValueError("ids over 65535 need a width of 4")
                held += [ids.astype(kind), np.full(1, end_id, kind)]
                size, after = size + len(ids) + 1, row + 1
                if size > 1 << 21:
                    yield flush(False)
        yield flush(True)

    placed, file, row = positioned(docs, by_path=True)
    return placed.select(file, row, "text").mapInArrow(cut, "file string, first long, at long, n int, ids binary")


def write_training_order(docs: DataFrame, path: str, vocabulary: str, length: int = 1024, end_id: int = 1, key: int = 2024, per_shard: int = 8192, width: int = 2) -> Layout:
    """Writes shards below ``path``/shards and the layout as JSON below ``path``/layout."""
    spark = docs.sparkSession
    table = materialize(streams(docs, vocabulary, length, end_id, width), "streams")
    parts = table.groupBy("file", "first").agg(F.sum("n").alias("n")).collect()  # a row for each task's part of a file
    base, total = {}, 0
    for r in sorted(parts, key=lambda r: (r["file"], r["first"])):
        base[r["file"], r["first"]], total = total, total + r["n"]
    layout = Layout(-(-total // length), length, width, per_shard, key)
    sent = spark.sparkContext.broadcast(base)  # as many numbers
    step = length * width

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A compressed parcel for each shard that a stretch of the stream has ids for: fewer and smaller rows to shuffle."""
        begins, order, pack = sent.value, layout.order(), zstandard.ZstdCompressor(level=3)

        def parcels(start: int, raw: bytes) -> Iterator[tuple[int, int, int, bytes]]:
            """shard, whole sequences, pieces of sequences, and their places and ids."""
            n = len(raw) // width
            head = min(n, -start % length)
            first, whole = (start + head) // length, (n - head) // length
            tail = n - head - whole * length
            pieces = [(start // length, start % length, 0, head)] * bool(head) + [(first + whole, 0, n - tail, tail)] * bool(tail)
            rows = np.frombuffer(raw, np.uint8, whole * step, head * width).reshape(whole, step)
            slots = order.slot(np.arange(first, first + whole))
            by = np.argsort(slots, kind="stable")
            shard = slots[by] // per_shard
            broken: dict[int, list[tuple[int, int, int, int]]] = {}
            for (_, offset, at, size), slot in zip(pieces, order.slot(np.array([p[0] for p in pieces], np.int64)).tolist()):
                broken.setdefault(slot // per_shard, []).append((slot % per_shard, offset, at, size))
            for s in sorted({*shard.tolist(), *broken}):
                some = by[np.searchsorted(shard, s) : np.searchsorted(shard, s, "right")]
                places = (slots[some] - s * per_shard).astype("<u4")
                more = broken.get(s, [])
                marks = np.array([(p, o, z) for p, o, _, z in more], "<u4")
                body = [places.tobytes(), rows[some].tobytes(), marks.tobytes(), *[raw[a * width : (a + z) * width] for _, _, a, z in more]]
                yield s, len(some), len(more), pack.compress(b"".join(body))

        for batch in batches:
            files, firsts, ids = (batch.column(i).to_pylist() for i in (0, 1, 4))
            sizes = batch.column(3).to_numpy().astype(np.int64)
            starts = np.array([begins[k] for k in zip(files, firsts)], np.int64) + batch.column(2).to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], starts[1:] != starts[:-1] + sizes[:-1]))).tolist() if len(starts) else []
            out = [p for i, j in zip(cuts, [*cuts[1:], len(starts)]) for p in parcels(int(starts[i]), b"".join(ids[i:j]))]
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.binary()))], names=["shard", "n", "m", "parcel"])

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole shards of at most ``per_shard`` records, from parcels in shard order."""
        unpack, now, body = zstandard.ZstdDecompressor(), None, None
        empty = np.full(length, end_id, {2: "<u2", 4: "<u4"}[width]).view(np.uint8)

        def done() -> pa.RecordBatch:
            if body is None:
                return pa.RecordBatch.from_arrays([pa.array([], pa.int32()), pa.array([], pa.binary())], names=["shard", "value"])
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([body.tobytes()[:-1]], pa.binary())], names=["shard", "value"])  # the writer ends the last record

        for batch in batches:
            for shard, n, m, parcel in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if shard != now:
                    yield done()
                    now = shard
                    body = np.full((min(per_shard, layout.sequences - shard * per_shard), layout.stride), 10, np.uint8)
                    body[:, :-1] = empty
                raw = unpack.decompress(parcel)
                body[np.frombuffer(raw, "<u4", n), :-1] = np.frombuffer(raw, np.uint8, n * step, 4 * n).reshape(n, step)
                at = n * (4 + step)
                marks = np.frombuffer(raw, "<u4", 3 * m, at).reshape(m, 3).tolist()
                at += 12 * m
                for place, offset, size in marks:
                    body[place, offset * width : (offset + size) * width] = np.frombuffer(raw, np.uint8, size * width, at)
                    at += size * width
        yield done()

    parcels = table.mapInArrow(deal, "shard int, n int, m int, parcel binary")
    dealt = parcels.repartitionById(max(1, layout.shards), "shard").sortWithinPartitions("shard")
    whole = dealt.mapInArrow(lay, "shard int, value binary")
    whole.select("shard", F.col("value").cast("string").alias("value")).write.partitionBy("shard").option("lineSep", "\n").text(f"{path}/shards")
    spark.createDataFrame([(json.dumps(asdict(layout)),)], "value string").coalesce(1).write.text(f"{path}/layout")
    return layout


def read_layout(spark: SparkSession, path: str) -> Layout:
    return Layout(**json.loads(spark.read.text(f"{path}/layout").first()["value"]))


def read_shards(spark: SparkSession, path: str, first_slot: int = 0, slots: int | None = None) -> DataFrame:
    """slot, sequence_id, shard, offset, ids of a range of slots (all, if not told), in slot order inside a shard."""
    ship(spark)
    layout = read_layout(spark, path)
    last = layout.sequences if slots is None else min(layout.sequences, first_slot + slots)
    schema = "slot long, sequence_id long, shard int, offset long, ids binary"
    if first_slot >= last:
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(f"{path}/shards")
    files = files.where((F.col("shard") >= first_slot // layout.per_shard) & (F.col("shard") <= (last - 1) // layout.per_shard))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, stride = layout.order(), layout.stride
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = memoryview(content.as_buffer())
                begin = shard * layout.per_shard
                if len(body) % stride or any(body[i] != 10 for i in range(stride - 1, len(body), stride)):
                    raise ValueError(f"shard {shard} is not whole records")
                slot = np.arange(max(begin, first_slot), min(begin + len(body) // stride, last))
                for at in range(0, len(slot), 2048):
                    some = slot[at : at + 2048]
                    places = (some - begin) * stride
                    ids = [bytes(body[p : p + stride - 1]) for p in places.tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(order.sequence(some)), pa.array(np.full(len(some), shard, np.int32)), pa.array(places), pa.array(ids, pa.binary())], names=["slot", "sequence_id", "shard", "offset", "ids"])

    return files.select(F.col("shard").cast("int"), "content").mapInArrow(records, schema)


def ordered_digests(docs: DataFrame, vocabulary: str, length: int = 1024, end_id: int = 1, key: int = 2024, per_shard: int = 8192) -> DataFrame:
    """Writes the training order of all documents and returns one digest row a sequence, from the bytes read back."""
    path = workspace(docs.sparkSession, "training-order")
    write_training_order(docs, path, vocabulary, length, end_id, key, per_shard)
    read = read_shards(docs.sparkSession, path)
    return read.select("slot", "sequence_id", "shard", "offset", (F.octet_length("ids") / 2).cast("int").alias("n_ids"), F.crc32("ids").alias("ids_crc32"))
