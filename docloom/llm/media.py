"""MPEG audio columns: payloads in Layer III frames, and a reader that resynchronises, checks and indexes.

Writer: an ID3v2.3 tag (with the payload's length), a Xing frame (frame count, bytes, seek table), then
silent, CRC-protected MPEG-1 Layer III mono frames at 32 kHz whose side information is zero; the payload
stands in their ancillary data. The last frame has the smallest bitrate that holds the rest, so the stream
has a variable bitrate. The media column depends on the payload alone.

Reader: skips tags, finds frame headers (after damage it looks on for a header that another header, a tag or
the end follows), reads Xing and VBRI tables, verifies Layer III checksums, and gives exact durations
(samples and rate) and the byte offset of every frame.

Defined results: null text is empty, and its payload 64 zero bytes; very long texts take as many frames as they need;
equal texts (ties, repeated rows) have equal media; null media and media without frames give zero frames and an empty
payload; an empty table gives an empty result; other columns are kept by ``decode_audio``, whatever their names (but
for those that it adds), and ignored by ``audio_digests``.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import materialize, ship

#: Fixed values of the format: kbit/s by (version 1, layer), (version 2, layer), rates of version 1.
KBITS = {
    (1, 1): [32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448],
    (1, 2): [32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384],
    (1, 3): [32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320],
    (2, 1): [32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256],
    (2, 2): [8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160],
    (2, 3): [8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160],
}
RATES = [44100, 48000, 32000]
OWNER = b"docloom\x00"


@dataclass(frozen=True)
class Header:
    """What four header bytes say."""

    version: int
    layer: int
    protected: bool
    kbits: int
    rate: int
    size: int
    channels: int
    samples: int
    side: int


@lru_cache(maxsize=4096)
def header(raw: bytes) -> Header | None:
    """A valid frame header, else None (free format and reserved values count as invalid)."""
    if len(raw) < 4 or raw[0] != 0xFF or raw[1] & 0xE0 != 0xE0:
        return None
    kind, layer, code, rate = raw[1] >> 3 & 3, 4 - (raw[1] >> 1 & 3), raw[2] >> 4, raw[2] >> 2 & 3
    if kind == 1 or layer == 4 or code in (0, 15) or rate == 3 or raw[3] & 3 == 2:
        return None
    version = 1 if kind == 3 else 2
    hertz = RATES[rate] >> {3: 0, 2: 1, 0: 2}[kind]
    kbits, pad, mono = KBITS[version, layer][code - 1], raw[2] >> 1 & 1, raw[3] >> 6 == 3
    samples = 384 if layer == 1 else 576 if layer == 3 and version == 2 else 1152
    size = (12 * kbits * 1000 // hertz + pad) * 4 if layer == 1 else samples // 8 * kbits * 1000 // hertz + pad
    side = ((17 if mono else 32) if version == 1 else (9 if mono else 17)) if layer == 3 else 0
    return Header(version, layer, not raw[1] & 1, kbits, hertz, size, 1 if mono else 2, samples, side)


@lru_cache(maxsize=4096)
def crc16(data: bytes) -> int:
    """The audio checksum: polynomial 0x8005, from 0xFFFF, high bit first."""
    value = 0xFFFF
    for byte in data:
        value ^= byte << 8
        for _ in range(8):
            value = (value << 1 ^ 0x8005 if value & 0x8000 else value << 1) & 0xFFFF
    return value


# --- writer -------------------------------------------------------------------------------------------

_SIDE, _RATE_CODE = 17, 2


def _head(code: int, protected: bool) -> bytes:
    return bytes([0xFF, 0xFA if protected else 0xFB, (code + 1) << 4 | _RATE_CODE << 2, 0xC0])


@lru_cache(maxsize=64)
def _prefix(code: int) -> bytes:
    """Header, checksum and zero side information of a silent protected frame."""
    head = _head(code, True)
    return head + struct.pack(">H", crc16(head[2:] + bytes(_SIDE))) + bytes(_SIDE)


_ROOM = [header(_head(c, True)).size - 6 - _SIDE for c in range(14)]


def _syncsafe(n: int) -> bytes:
    return bytes(n >> s & 127 for s in (21, 14, 7, 0))


def write_audio(payload: bytes) -> bytes:
    """One tagged variable-bitrate stream that carries ``payload``."""
    most = _ROOM[-1]
    frames = [_prefix(13) + payload[i : i + most] for i in range(0, len(payload) - most + 1, most)]
    if rest := len(payload) - len(frames) * most:
        code = next(c for c, room in enumerate(_ROOM) if room >= rest)
        frames.append(_prefix(code) + payload[len(payload) - rest :] + bytes(_ROOM[code] - rest))
    first = _head(4, False) + bytes(_SIDE)
    xing = header(first[:4]).size
    n, size = len(frames), xing + sum(map(len, frames))
    full = len(frames[0]) if frames else 0
    toc = bytes(min(255, (xing + (i * n // 100) * full) * 256 // size) for i in range(100))
    info = first + b"Xing" + struct.pack(">III", 7, n, size) + toc
    private = OWNER + struct.pack(">Q", len(payload))
    tag = b"PRIV" + struct.pack(">IH", len(private), 0) + private
    return b"".join([b"ID3\x03\x00\x00", _syncsafe(len(tag)), tag, info, bytes(xing - len(info)), *frames])


# --- reader -------------------------------------------------------------------------------------------


@dataclass
class Audio:
    """What a stream holds; offsets are byte positions of audio frames (without the table frame)."""

    payload: bytes = b""
    tags: dict[str, bytes] = field(default_factory=dict)
    offsets: list[int] = field(default_factory=list)
    rate: int = 0
    channels: int = 0
    samples: int = 0
    good: int = 0
    bad: int = 0
    unchecked: int = 0
    resyncs: int = 0
    kbits: int = 0
    table: str = ""
    table_frames: int = -1
    table_bytes: int = -1
    toc: bytes = b""


def _tags(data: bytes, at: int) -> tuple[dict[str, bytes], int]:
    """The frames of an ID3v2 tag at ``at`` and where it ends."""
    if data[at : at + 3] != b"ID3" or len(data) < at + 10:
        return {}, at
    size = 0
    for b in data[at + 6 : at + 10]:
        size = size << 7 | b & 127
    version, end, p, out = data[at + 3], at + 10 + size, at + 10, {}
    while p + 10 <= min(end, len(data)) and data[p]:
        n = data[p + 4 : p + 8]
        length = n[0] << 21 | n[1] << 14 | n[2] << 7 | n[3] if version >= 4 else int.from_bytes(n, "big")
        out[data[p : p + 4].decode("latin-1")] = data[p + 10 : p + 10 + length]
        p += 10 + length
    return out, end + (10 if data[at + 5] & 16 else 0)


def _follows(data: bytes, at: int, like: Header) -> bool:
    if at >= len(data) or data[at : at + 3] in (b"TAG", b"ID3"):
        return at <= len(data)
    h = header(data[at : at + 4])
    return h is not None and (h.layer, h.rate, h.version) == (like.layer, like.rate, like.version)


def _next_frame(data: bytes, at: int) -> tuple[int, Header] | None:
    """The first position from ``at`` that holds a header and a whole frame before another header, a tag or the end."""
    while (at := data.find(b"\xff", at)) >= 0:
        h = header(data[at : at + 4])
        if h and _follows(data, at + h.size, h):
            return at, h
        at += 1
    return None


def _table(out: Audio, frame: bytes, h: Header) -> bool:
    at = 4 + h.side
    if frame[at : at + 4] in (b"Xing", b"Info"):
        out.table, flags = frame[at : at + 4].decode(), int.from_bytes(frame[at + 4 : at + 8], "big")
        at += 8
        if flags & 1:
            out.table_frames, at = int.from_bytes(frame[at : at + 4], "big"), at + 4
        if flags & 2:
            out.table_bytes, at = int.from_bytes(frame[at : at + 4], "big"), at + 4
        if flags & 4:
            out.toc = frame[at : at + 100]
        return True
    if frame[36:40] == b"VBRI" and len(frame) >= 62:
        out.table = "VBRI"
        out.table_bytes, out.table_frames, entries, _, width = struct.unpack(">IIHHH", frame[46:60])
        out.toc = frame[62 : 62 + entries * width]
        return True
    return False


def read_audio(data: bytes) -> Audio:
    """Everything of a stream, whatever stands between its frames."""
    out = Audio()
    out.tags, at = _tags(data, 0)
    parts: list[bytes] = []
    first = True
    while at < len(data):
        if data[at : at + 3] == b"TAG" and at + 128 == len(data):
            break
        h = header(data[at : at + 4])
        if not h or at + h.size > len(data) or (out.rate and h.rate != out.rate):
            out.resyncs += 1
            if not (found := _next_frame(data, at + 1)):
                break
            at, h = found
        frame = data[at : at + h.size]
        out.rate, out.channels = h.rate, h.channels
        if not (first and _table(out, frame, h)):
            out.offsets.append(at)
            out.samples += h.samples
            out.kbits += h.kbits
            start = 4 + 2 * h.protected + h.side
            if h.protected and h.layer == 3:
                if crc16(frame[2:4] + frame[6:start]) == frame[4] << 8 | frame[5]:
                    out.good += 1
                else:
                    out.bad += 1
            else:
                out.unchecked += 1
            parts.append(frame[start:])
        first = False
        at += h.size
    own = out.tags.get("PRIV", b"")
    whole = b"".join(parts)
    out.payload = whole[: struct.unpack(">Q", own[len(OWNER) :])[0]] if own.startswith(OWNER) and len(own) == len(OWNER) + 8 else whole
    return out


# --- columns ------------------------------------------------------------------------------------------

_FEATURES = "payload binary, rate int, channels int, frames int, samples long, checked int, broken int, resyncs int, vbr_table string, vbr_frames int, vbr_bytes long, offsets array<long>, feature string"
_BATCH = 8 << 20


def pad(raw: bytes, unit: int = 64) -> bytes:
    """``raw`` with zero bytes up to a positive multiple of ``unit``."""
    return raw + bytes(max(unit, -(-len(raw) // unit) * unit) - len(raw))


def encode_audio(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_bytes (unpadded) and media (the stream that carries the padded UTF-8 text)."""
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, media = batch.column(0), [], []
            at = weight = 0
            for i, raw in enumerate(batch.column(1).cast(pa.binary())):
                body = raw.as_py() or b""
                sizes.append(len(body))
                media.append(write_audio(pad(body)))
                weight += len(media[-1])
                if weight >= _BATCH or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([keys.slice(at, len(sizes)), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], names=["key", "n_bytes", "media"])
                    at, weight, sizes, media = i + 1, 0, [], []

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"key {kind}, n_bytes long, media binary").withColumnRenamed("key", key)


def feature(a: Audio) -> str:
    """The features in one line: exact duration, checks, table agreement and a digest of the seek offsets."""
    seek = zlib.crc32(np.array(a.offsets, "<i8").tobytes())
    return f"mpeg layer=3 rate={a.rate} channels={a.channels} frames={len(a.offsets)} samples={a.samples} kbits={a.kbits} crc_ok={a.good} crc_bad={a.bad} resyncs={a.resyncs} table={a.table}:{a.table_frames}:{a.table_bytes} seek_crc32={seek}"


def decode_audio(media: DataFrame) -> DataFrame:
    """All columns of ``media`` (with a column media) and what the reader finds in the stored bytes."""
    ship(media.sparkSession)
    names = media.columns
    where = names.index("media")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in media.schema) + ", " + _FEATURES
    added = ["payload", "rate", "channels", "frames", "samples", "checked", "broken", "resyncs", "vbr_table", "vbr_frames", "vbr_bytes", "offsets", "feature"]
    kinds = [pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            at = weight = 0
            for i, raw in enumerate(batch.column(where)):
                a = read_audio(raw.as_py() or b"")
                rows.append((a.payload, a.rate, a.channels, len(a.offsets), a.samples, a.good, a.bad, a.resyncs, a.table, a.table_frames, a.table_bytes, a.offsets, feature(a)))
                weight += len(a.payload)
                if weight >= _BATCH or i + 1 == batch.num_rows:
                    part = batch.slice(at, len(rows))
                    yield pa.RecordBatch.from_arrays([*part.columns, *[pa.array(c, t) for c, t in zip(zip(*rows), kinds)]], names=[*names, *added])
                    at, weight, rows = i + 1, 0, []

    return media.mapInArrow(run, schema)


def audio_digests(docs: DataFrame) -> DataFrame:
    """The digest columns of the stored media of every text: media are written as a table and its bytes are read back."""
    stored = materialize(encode_audio(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), "media")
    read = decode_audio(stored)
    return read.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -64, 64)")).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )
