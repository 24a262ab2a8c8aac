"""Media columns: Matroska files in a binary column, and their packet tables.

`mux` lays bytes out as 8-bit PCM samples: one audio track, frames of 192 samples, laced into simple
blocks, clusters with their times, and cues. `packets` parses any Matroska bytes: variable-length element ids and
sizes (unknown sizes too), clusters, simple blocks and block groups, all four lacings, and cues. The byte range of
each packet refers to the column's bytes, so samples are read in place.

Nulls: a null text counts as empty and becomes one frame of blanks; null media bytes have no packets. Repeated
rows give equal media. A damaged file raises ValueError in `packets`; `packet_table` then has one row with
the error and no packet. Texts of any length are stored whole; an empty table gives an empty result; other columns of the
input may have any names.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, ship_package, text_or_empty

FRAME, RATE = 192, 8000
LACED_FRAMES, CLUSTER_BLOCKS = 16, 64

# Fixed values of the format: element ids
EBML, DOCTYPE, SEGMENT, INFO, TIMESTAMP_SCALE, DURATION, MUXING_APP, WRITING_APP = 0x1A45DFA3, 0x4282, 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID, DEFAULT_DURATION = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0x23E383
AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1
CUES, CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
_LEVEL_ONE = {SEGMENT, CLUSTER, CUES, TRACKS, INFO}
_LACINGS = ("none", "xiph", "fixed", "ebml")


def _size(n: int) -> bytes:
    """A size as a variable-length integer of the least length."""
    for k in range(1, 9):
        if n < (1 << (7 * k)) - 1:
            return (n | 1 << (7 * k)).to_bytes(k, "big")
    raise ValueError("too large for an element")


def element(number: int, body: bytes) -> bytes:
    return number.to_bytes((number.bit_length() + 7) // 8, "big") + _size(len(body)) + body


def _unsigned(number: int, value: int) -> bytes:
    return element(number, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def mux(samples: bytes, rate: int = RATE, frame: int = FRAME) -> bytes:
    """A Matroska file of the samples; their number is a multiple of `frame`."""
    frames = len(samples) // frame
    ms = frame * 1000 // rate
    info = element(INFO, _unsigned(TIMESTAMP_SCALE, 1_000_000) + element(MUXING_APP, b"saltmarsh") + element(WRITING_APP, b"saltmarsh") + element(DURATION, struct.pack(">d", float(frames * ms))))
    audio = element(AUDIO, element(SAMPLING_FREQUENCY, struct.pack(">d", float(rate))) + _unsigned(CHANNELS, 1) + _unsigned(BIT_DEPTH, 8))
    track = element(TRACKS, element(TRACK_ENTRY, _unsigned(TRACK_NUMBER, 1) + _unsigned(TRACK_UID, 1) + _unsigned(TRACK_TYPE, 2) + element(CODEC_ID, b"A_PCM/INT/LIT") + _unsigned(DEFAULT_DURATION, ms * 1_000_000) + audio))
    parts, place, cues = [info, track], len(info) + len(track), []
    step = LACED_FRAMES * CLUSTER_BLOCKS
    for first in range(0, frames, step):
        blocks = [_unsigned(TIMESTAMP, first * ms)]
        for at in range(first, min(first + step, frames), LACED_FRAMES):
            n = min(LACED_FRAMES, frames - at)
            head = b"\x81" + struct.pack(">hB", (at - first) * ms, 0x84 if n > 1 else 0x80) + (bytes([n - 1]) if n > 1 else b"")
            blocks.append(element(SIMPLE_BLOCK, head + samples[at * frame : (at + n) * frame]))
        cues.append(element(CUE_POINT, _unsigned(CUE_TIME, first * ms) + element(CUE_TRACK_POSITIONS, _unsigned(CUE_TRACK, 1) + _unsigned(CUE_CLUSTER_POSITION, place))))
        cluster = element(CLUSTER, b"".join(blocks))
        parts.append(cluster)
        place += len(cluster)
    parts.append(element(CUES, b"".join(cues)))
    return element(EBML, element(DOCTYPE, b"matroska")) + element(SEGMENT, b"".join(parts))


@dataclass
class Media:
    """What a file holds: packets (track, ms, offset, size, keyframe, lacing), tracks' codecs, cues (ms, track, offset of the cluster), clusters' offsets."""

    packets: list[tuple[int, int, int, int, bool, str]] = field(default_factory=list)
    codecs: dict[int, str] = field(default_factory=dict)
    cues: list[tuple[int, int, int]] = field(default_factory=list)
    clusters: list[int] = field(default_factory=list)
    durations: dict[int, int] = field(default_factory=dict)


def _vint(data: bytes, at: int, marker: bool) -> tuple[int, int]:
    """A variable-length integer and where it ends; with its marker bit for element ids."""
    if at >= len(data) or not data[at]:
        raise ValueError(f"no variable-length integer at {at}")
    n = 9 - data[at].bit_length()
    if at + n > len(data):
        raise ValueError(f"cut off at {at}")
    value = int.from_bytes(data[at : at + n], "big")
    return value if marker else value & (1 << 7 * n) - 1, at + n


def elements(data: bytes, at: int, end: int) -> Iterator[tuple[int, int, int, int]]:
    """Id, offset, begin and end of the content of each element between two places."""
    while at < end:
        number, after = _vint(data, at, True)
        size, begin = _vint(data, after, False)
        unknown = size == (1 << 7 * (begin - after)) - 1
        stop = begin + size
        if unknown:  # up to the next element of the same level or above
            stop = end
            if number == CLUSTER:
                for inner, place, _, inner_end in elements(data, begin, end):
                    if inner in _LEVEL_ONE:
                        stop = place
                        break
                    stop = inner_end
        if stop > end:
            raise ValueError(f"element {number:x} at {at} goes beyond its parent")
        yield number, at, begin, stop
        at = stop


def _number(data: bytes, begin: int, end: int) -> int:
    return int.from_bytes(data[begin:end], "big")


def _laces(data: bytes, at: int, end: int, lacing: int) -> list[tuple[int, int]]:
    """Offset and size of each frame of a block whose frames begin at `at`."""
    if not lacing:
        return [(at, end - at)]
    n = data[at] + 1
    at += 1
    if lacing == 2:
        each, rest = divmod(end - at, n)
        if rest:
            raise ValueError("fixed lacing of unequal frames")
        return [(at + i * each, each) for i in range(n)]
    sizes: list[int] = []
    for i in range(n - 1):
        if lacing == 1:
            size = 0
            while data[at] == 255:
                size, at = size + 255, at + 1
            size, at = size + data[at], at + 1
        elif not i:
            size, at = _vint(data, at, False)
        else:
            raw, after = _vint(data, at, False)
            size, at = sizes[-1] + raw - ((1 << 7 * (after - at) - 1) - 1), after
        sizes.append(size)
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("laced frames beyond their block")
    places, out = at, []
    for size in sizes:
        out.append((places, size))
        places += size
    return out


def packets(data: bytes | None) -> Media:
    """All packets, tracks and cues of a file; ValueError where its structure is broken."""
    found = Media()
    scale = 1_000_000
    for top, _, begin, end in elements(data or b"", 0, len(data or b"")):
        if top != SEGMENT:
            continue
        for number, place, a, b in elements(data, begin, end):
            if number == INFO:
                for k, _, x, y in elements(data, a, b):
                    scale = _number(data, x, y) if k == TIMESTAMP_SCALE else scale
            elif number == TRACKS:
                for _, _, x, y in elements(data, a, b):
                    own = {k: (p, q) for k, _, p, q in elements(data, x, y)}
                    track = _number(data, *own[TRACK_NUMBER])
                    found.codecs[track] = data[slice(*own[CODEC_ID])].decode("ascii", "replace")
                    found.durations[track] = _number(data, *own[DEFAULT_DURATION]) if DEFAULT_DURATION in own else 0
            elif number == CUES:
                for _, _, x, y in elements(data, a, b):
                    own = {k: (p, q) for k, _, p, q in elements(data, x, y)}
                    inner = {k: (p, q) for k, _, p, q in elements(data, *own[CUE_TRACK_POSITIONS])}
                    found.cues.append((_number(data, *own[CUE_TIME]) * scale // 1_000_000, _number(data, *inner[CUE_TRACK]), begin + _number(data, *inner[CUE_CLUSTER_POSITION])))
            elif number == CLUSTER:
                found.clusters.append(place)
                base = 0
                for k, _, x, y in elements(data, a, b):
                    if k == TIMESTAMP:
                        base = _number(data, x, y)
                    elif k == SIMPLE_BLOCK:
                        _block(data, x, y, base, scale, None, found)
                    elif k == BLOCK_GROUP:
                        inner = list(elements(data, x, y))
                        key = all(z[0] != 0xFB for z in inner)  # a block that refers to another is no key frame
                        for z, _, p, q in inner:
                            if z == BLOCK:
                                _block(data, p, q, base, scale, key, found)
    return found


def _block(data: bytes, at: int, end: int, base: int, scale: int, key: bool | None, found: Media) -> None:
    """The packets of a block; a simple block (key None) says itself whether it is a key frame."""
    track, at = _vint(data, at, False)
    relative, flags = struct.unpack_from(">hB", data, at)
    lacing = flags >> 1 & 3
    time, step = (base + relative) * scale // 1_000_000, found.durations.get(track, 0) // 1_000_000
    key = bool(flags & 0x80) if key is None else key
    name = _LACINGS[lacing]
    for i, (offset, size) in enumerate(_laces(data, at + 3, end, lacing)):
        found.packets.append((track, time + i * step, offset, size, key, name))


def text_payload(text: str | None) -> bytes:
    """UTF-8 with blanks up to a positive multiple of the frame."""
    raw = (text or "").encode("utf-8")
    return raw + b" " * (max(FRAME, -(-len(raw) // FRAME) * FRAME) - len(raw))


def media_column(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: each text stored as 8-bit samples of a Matroska file."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("doc_id"), text_or_empty(text).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "body"):
                texts = part.column("body").to_pylist()
                size = pa.compute.binary_length(part.column("body")).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), size, pa.array([mux(text_payload(t)) for t in texts], pa.binary())], ["doc_id", "n_bytes", "media"])

    return rows.mapInArrow(run, f"doc_id {docs.schema[id_column].dataType.simpleString()}, n_bytes long, media binary")


def packet_table(media: DataFrame, id_column: str = "doc_id", column: str = "media") -> DataFrame:
    """One row per packet: doc_id, packet, track, timestamp_ms, byte_offset, byte_size, keyframe, lacing, codec, error."""
    ship_package(media.sparkSession)
    rows = media.select(F.col(id_column).alias("doc_id"), F.col(column).alias("media"))
    names = ("packet", "track", "timestamp_ms", "byte_offset", "byte_size", "keyframe", "lacing", "codec", "error")
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data in enumerate(batch.column("media")):
                try:
                    got = packets(data.as_py())
                    out = [(n, *p, got.codecs.get(p[0]), None) for n, p in enumerate(got.packets)]
                except (ValueError, IndexError, KeyError, struct.error) as e:
                    out = [(None,) * 8 + (str(e),)]
                if out:
                    ids = pa.concat_arrays([batch.column("doc_id").slice(i, 1)] * len(out))
                    yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]], ["doc_id", *names])

    return rows.mapInArrow(run, f"doc_id {media.schema[id_column].dataType.simpleString()}, packet int, track int, timestamp_ms long, byte_offset long, byte_size long, keyframe boolean, lacing string, codec string, error string")


def sample_features(samples: bytes, media: Media) -> str:
    """Packets, duration, clusters, cues that point at clusters, and mean, peak, energy and mean crossings of the samples."""
    x = np.frombuffer(samples, np.uint8).astype(np.int64)
    mean = int(x.sum()) // max(1, len(x))
    side = x >= mean
    cued = sum(c[2] in set(media.clusters) for c in media.cues) if len(media.cues) < 50 else len({c[2] for c in media.cues} & set(media.clusters))
    last = max((p[1] for p in media.packets), default=0)
    step = media.durations.get(1, 0) // 1_000_000
    return f"packets={len(media.packets)};ms={last + step};clusters={len(media.clusters)};cues={cued};mean={mean};peak={int(x.max(initial=0))};energy={int((x * x).sum()) // max(1, len(x))};crossings={int((side[1:] != side[:-1]).sum())}"


def media_digest(media: DataFrame) -> DataFrame:
    """Per row of a `media_column`: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, from the stored bytes."""
    ship_package(media.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for value in batch.column("media"):
                data = value.as_py()
                got = packets(data)
                samples = b"".join(data[p[2] : p[2] + p[3]] for p in got.packets)
                out.append((len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(data), hashlib.sha256(data).hexdigest(), sample_features(samples, got)))
            cols = list(zip(*out, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return media.mapInArrow(run, f"doc_id {media.schema['doc_id'].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
