"""AVI motion-JPEG columns: lossless frames, RIFF index, shots and timed clips.

A payload is stored as 8-bit grey frames of 64 x 16 samples. Frames are lossless
JPEG (process 14, left predictor). Its Huffman table gives category s a code of
9 - s bits, so with the s bits that follow it every difference takes nine bits;
a whole document is coded and decoded in a few array passes.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .jpeg import decode_frame
from .textkernels import text_slices

WIDTH, HEIGHT = 64, 16
FRAME_SAMPLES = WIDTH * HEIGHT
#: Payloads are a positive multiple of so many bytes.
UNIT = 64
FRAMES_PER_SECOND = 25
#: Files that are read at once.
ROWS_AT_ONCE = 512
#: Frames that are coded or decoded at once.
FRAMES_AT_ONCE = 1024

HISTOGRAM_BINS = 32
#: A cut lies where the histogram difference is over the mean of the shot so far plus so many deviations, and over the floor.
CUT_DEVIATIONS = 3.0
CUT_FLOOR = 0.12
SHORTEST_SHOT = 2

# --- lossless JPEG frames -----------------------------------------------------


def _difference_codes() -> tuple[np.ndarray, np.ndarray]:
    """Nine-bit code of each difference (from -255), and back."""
    codes, back = np.zeros(511, dtype=np.uint16), np.zeros(512, dtype=np.int32)
    for d in range(-255, 256):
        s = abs(d).bit_length()
        prefix = ((1 << (8 - s)) - 1) << 1  # 8 - s ones, then a zero
        codes[d + 255] = prefix << s | (d if d >= 0 else d + (1 << s) - 1)
        back[codes[d + 255]] = d
    return codes, back


_CODES, _DIFFERENCES = _difference_codes()
_HUFFMAN = bytes([1] * 9 + [0] * 7) + bytes(range(8, -1, -1))


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


_HEAD = (
    b"\xff\xd8"
    + _segment(0xC4, b"\x00" + _HUFFMAN)
    + _segment(0xC3, struct.pack(">BHHBBBB", 8, HEIGHT, WIDTH, 1, 1, 0x11, 0))
    + _segment(0xDA, bytes([1, 1, 0, 1, 0, 0]))
)
_TAIL = b"\xff\xd9"


def encode_frames(samples: np.ndarray) -> list[bytes]:
    """JPEG files of frames (n x HEIGHT x WIDTH, 8 bits)."""
    x = samples.astype(np.int16)
    d = np.empty_like(x)
    d[:, :, 1:] = x[:, :, 1:] - x[:, :, :-1]
    d[:, 1:, 0] = x[:, 1:, 0] - x[:, :-1, 0]
    d[:, 0, 0] = x[:, 0, 0] - 128
    c = _CODES[d.reshape(-1, 8) + 255]
    packed = np.empty((len(c), 9), dtype=np.uint8)
    packed[:, 0] = c[:, 0] >> 1
    for k in range(1, 8):
        packed[:, k] = (c[:, k - 1] & ((1 << k) - 1)) << (8 - k) | c[:, k] >> (k + 1)
    packed[:, 8] = c[:, 7] & 0xFF
    flat = packed.reshape(len(samples), -1)
    full = flat == 0xFF
    stuffed = np.insert(flat.ravel(), np.flatnonzero(full) + 1, 0).tobytes()
    ends = np.cumsum(flat.shape[1] + full.sum(axis=1)).tolist()
    return [_HEAD + stuffed[a:b] + _TAIL for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def decode_frames(files: list[bytes]) -> list[np.ndarray]:
    """Grey samples (rows x columns) of JPEG files: at once where encode_frames made them, else one by one."""
    if not all(f.startswith(_HEAD) and f.endswith(_TAIL) for f in files):
        return [decode_frame(f) for f in files]
    stuffed = np.frombuffer(b"".join(f[len(_HEAD) : -len(_TAIL)] for f in files), dtype=np.uint8)
    keep = np.ones(len(stuffed), dtype=bool)
    after = np.flatnonzero(stuffed == 0xFF) + 1
    keep[after] = False
    b = stuffed[keep].reshape(-1, 9).astype(np.uint16)
    c = np.empty((len(b), 8), dtype=np.uint16)
    for k in range(8):
        c[:, k] = (b[:, k] & ((1 << (8 - k)) - 1)) << (k + 1) | b[:, k + 1] >> (7 - k)
    d = _DIFFERENCES[c].reshape(len(files), HEIGHT, WIDTH)
    d[:, 0, 0] += 128
    d[:, :, 0] = np.cumsum(d[:, :, 0], axis=1)
    return list(np.cumsum(d, axis=2).astype(np.uint8))


# --- RIFF ---------------------------------------------------------------------


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def _list(kind: bytes, body: bytes) -> bytes:
    return _chunk(b"LIST", kind + body)


def padded(raw: bytes) -> bytes:
    """The bytes, and zeros up to a positive multiple of UNIT."""
    return raw + b"\0" * (max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


def write_avi(payload: bytes) -> bytes:
    """An AVI file of a payload; its length stands in the INFO list, as the last frame is filled up with zeros."""
    n = max(1, -(-len(payload) // FRAME_SAMPLES))
    samples = np.zeros(n * FRAME_SAMPLES, dtype=np.uint8)
    samples[: len(payload)] = np.frombuffer(payload, dtype=np.uint8)
    samples = samples.reshape(n, HEIGHT, WIDTH)
    frames = [f for at in range(0, n, FRAMES_AT_ONCE) for f in encode_frames(samples[at : at + FRAMES_AT_ONCE])]
    largest = max(map(len, frames))
    avih = struct.pack("<14I", 1_000_000 // FRAMES_PER_SECOND, largest * FRAMES_PER_SECOND, 0, 0x10, n, 0, 1, largest, WIDTH, HEIGHT, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIiI4H", 0, 0, 0, 0, 1, FRAMES_PER_SECOND, 0, n, largest, -1, 0, 0, 0, WIDTH, HEIGHT)
    strf = struct.pack("<IiiHH4sIiiII", 40, WIDTH, HEIGHT, 1, 8, b"MJPG", FRAME_SAMPLES, 0, 0, 256, 0)
    head = _list(b"hdrl", _chunk(b"avih", avih) + _list(b"strl", _chunk(b"strh", strh) + _chunk(b"strf", strf)))
    info = _list(b"INFO", _chunk(b"ICMT", b"payload=%d\0" % len(payload)))
    at, index, chunks = 4, [], []
    for f in frames:
        index.append(b"00dc" + struct.pack("<III", 0x10, at, len(f)))
        chunks.append(_chunk(b"00dc", f))
        at += len(chunks[-1])
    body = b"AVI " + head + info + _list(b"movi", b"".join(chunks)) + _chunk(b"idx1", b"".join(index))
    return b"RIFF" + struct.pack("<I", len(body)) + body


def _chunks(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(name, start, end) of the chunks' bodies in data[at:end]."""
    while at + 8 <= end:
        size = struct.unpack_from("<I", data, at + 4)[0]
        if at + 8 + size > end:
            raise ValueError("a RIFF chunk is cut off")
        yield data[at : at + 4], at + 8, at + 8 + size
        at += 8 + size + (size & 1)


@dataclass
class Movie:
    """What an AVI file holds: its frame files by the index, frame rate, and the payload's length."""

    files: list[bytes]
    frame_us: int
    payload_bytes: int | None


def _is_frame(name: bytes) -> bool:
    return name[:2].isdigit() and name[2:] in (b"dc", b"db")


def _listed_frames(data: bytes, at: int, end: int) -> Iterator[bytes]:
    """Frame files in file order, those inside `rec ` lists too."""
    for name, a, b in _chunks(data, at, end):
        if name == b"LIST" and data[a : a + 4] == b"rec ":
            yield from _listed_frames(data, a + 4, b)
        elif _is_frame(name):
            yield data[a:b]


def _idx1_frames(data: bytes, index: bytes, movi: int) -> Iterator[bytes]:
    """Frame files by an idx1 index, whose offsets count from the movi list's name or, in some files, from the file's start."""
    rows = [(name, at) for name, _, at, _ in struct.iter_unpack("<4sIII", index) if _is_frame(name)]
    base = movi if any(data[movi + at : movi + at + 4] == name for name, at in rows[:1]) else 0
    for name, at in rows:
        if data[base + at : base + at + 4] != name:
            raise ValueError("the index points beside a frame")
        size = struct.unpack_from("<I", data, base + at + 4)[0]
        yield data[base + at + 8 : base + at + 8 + size]


def _open_dml_frames(data: bytes, super_index: bytes) -> Iterator[bytes]:
    """Frame files by an OpenDML super index: each of its entries is the place of a standard index of frame places."""
    for i in range(struct.unpack_from("<I", super_index, 4)[0]):
        at = struct.unpack_from("<Q", super_index, 24 + 16 * i)[0] + 8
        n, _, base = struct.unpack_from("<I4sQ", data, at + 4)
        for j in range(n):
            offset, size = struct.unpack_from("<II", data, at + 24 + 8 * j)
            yield data[base + offset : base + offset + (size & 0x7FFFFFFF)]


def read_avi(data: bytes) -> Movie:
    """Parse a RIFF AVI file. Frames are found by its OpenDML index, else by idx1, else in file order; there may be none."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    frame_us, length, movies, index, super_index = 1_000_000 // FRAMES_PER_SECOND, None, [], None, None
    for segment, first, last in _chunks(data, 0, len(data)):
        if segment != b"RIFF":
            continue
        for name, start, end in _chunks(data, first + 4, last):
            kind = data[start : start + 4] if name == b"LIST" else b""
            if kind == b"hdrl":
                for inner, a, b in _chunks(data, start + 4, end):
                    if inner == b"avih":
                        frame_us = struct.unpack_from("<I", data, a)[0]
                    elif inner == b"LIST" and data[a : a + 4] == b"strl":
                        parts = {n: data[x:y] for n, x, y in _chunks(data, a + 4, b)}
                        if parts.get(b"strh", b"")[:4] == b"vids" and super_index is None:
                            super_index = parts.get(b"indx")
            elif kind == b"INFO":
                for inner, a, b in _chunks(data, start + 4, end):
                    if inner == b"ICMT" and data[a:b].startswith(b"payload="):
                        length = int(data[a + 8 : b].rstrip(b"\0"))
            elif kind == b"movi":
                movies.append((start, end))
            elif name == b"idx1" and index is None:
                index = data[start:end]
    if super_index:
        files = list(_open_dml_frames(data, super_index))
    elif index is not None and len(movies) == 1:
        files = list(_idx1_frames(data, index, movies[0][0]))
    else:
        files = [f for start, end in movies for f in _listed_frames(data, start + 4, end)]
    return Movie(files, frame_us, length)


# --- shots --------------------------------------------------------------------


def shots(frames: list[np.ndarray]) -> list[tuple[int, int]]:
    """(first, end) frames of each shot, by adaptive differences of neighbouring histograms. Frames may differ in size; none give no shot."""
    n = len(frames)
    if not n:
        return []
    shift = 8 - (HISTOGRAM_BINS - 1).bit_length()
    sizes = np.array([f.size for f in frames])
    row = np.repeat(np.arange(n) * HISTOGRAM_BINS, sizes)
    bins = np.concatenate([f.ravel() for f in frames]) >> shift
    histogram = np.bincount(bins + row, minlength=n * HISTOGRAM_BINS).reshape(n, -1) / np.maximum(sizes, 1)[:, None]
    differences = np.abs(np.diff(histogram, axis=0)).sum(axis=1) / 2
    found, first, count, mean, spread = [], 0, 0, 0.0, 0.0
    for i, d in enumerate(differences.tolist(), start=1):
        limit = max(CUT_FLOOR, mean + CUT_DEVIATIONS * (spread / count) ** 0.5) if count >= SHORTEST_SHOT - 1 else np.inf
        if d > limit:
            found.append((first, i))
            first, count, mean, spread = i, 0, 0.0, 0.0
        else:
            count += 1
            step = d - mean
            mean += step / count
            spread += step * (d - mean)
    return [*found, (first, n)]


# --- columns --------------------------------------------------------------------


def store_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media: each text's UTF-8 bytes (null: none), padded, as an AVI file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, buf, offsets in text_slices(batch.column("text")):
                raw, at = buf.tobytes(), offsets.tolist()
                media = [write_avi(padded(raw[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)]
                ids = batch.column("doc_id").slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.diff(offsets), pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"]
                )

    schema = T.StructType([docs.schema["doc_id"]]).add("n_bytes", T.LongType()).add("media", T.BinaryType())
    return docs.select("doc_id", "text").mapInArrow(run, schema)


_CLIP = T.StructType().add("clip", T.IntegerType()).add("first_frame", T.IntegerType()).add("end_frame", T.IntegerType())
_CLIP = _CLIP.add("start_s", T.DoubleType()).add("end_s", T.DoubleType())


def read_media(media: DataFrame) -> DataFrame:
    """All columns but `media`, and what the stored bytes hold: payload, frames, clips (array of timed shots) and fault.

    Frames that were filled up lose the filling by the stored payload length; other
    AVI files of baseline or lossless frames give all grey samples, frame by frame,
    whatever their sizes. A file without frames has an empty payload and no clip.
    What cannot be read gives nulls and says why in `fault`, and does not stop the
    others; null media gives nulls without a fault.
    """
    added = T.StructType().add("payload", T.BinaryType()).add("frames", T.IntegerType()).add("clips", T.ArrayType(_CLIP)).add("fault", T.StringType())
    kept = [c for c in media.columns if c != "media" and c not in added.names]

    def one(data: bytes | None) -> tuple[bytes | None, int | None, list[dict] | None, str | None]:
        if data is None:
            return None, None, None, None
        try:
            movie = read_avi(data)
            frames = [f for i in range(0, len(movie.files), FRAMES_AT_ONCE) for f in decode_frames(movie.files[i : i + FRAMES_AT_ONCE])]
        except (ValueError, IndexError, KeyError, struct.error) as e:
            return None, None, None, f"{type(e).__name__}: {e}"
        seconds = movie.frame_us / 1e6
        clips = [
            {"clip": i, "first_frame": a, "end_frame": b, "start_s": round(a * seconds, 6), "end_s": round(b * seconds, 6)}
            for i, (a, b) in enumerate(shots(frames))
        ]
        return b"".join(f.tobytes() for f in frames)[: movie.payload_bytes], len(frames), clips, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.binary(), pa.int32(), pa.list_(pa.struct([(f.name, pa.float64() if f.name in ("start_s", "end_s") else pa.int32()) for f in _CLIP])), pa.string()]
        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                read = [one(d.as_py()) for d in part.column("media")]
                new = [pa.array([r[i] for r in read], kinds[i]) for i in range(len(kinds))]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *new], names=[*kept, *added.names])

    schema = T.StructType([*(media.schema[c] for c in kept), *added])
    return media.select(*kept, "media").mapInArrow(run, schema)


def clip_rows(read: DataFrame) -> DataFrame:
    """One row per timed clip of read_media()'s result: doc_id, clip, first_frame, end_frame, start_s, end_s."""
    return read.select("doc_id", F.inline("clips"))


def media_digests(docs: DataFrame) -> DataFrame:
    """One row per document: lengths, digests and features of its text stored as AVI and read back.

    The feature lists the timed clips that clip_rows() spreads into rows: number,
    first and end frame, start and end second. Null and empty texts have a payload of 64 zeros. Null ids and repeated rows
    pass through; an empty table gives no row.
    """
    stored = store_texts(docs).withColumn("media_bytes", F.octet_length("media").cast("long")).withColumn("media_sha256", F.sha2("media", 256))
    read = read_media(stored)
    clip = lambda c: F.format_string("%d:%d-%d@%.2f-%.2f", c["clip"], c["first_frame"], c["end_frame"], c["start_s"], c["end_s"])
    size = F.octet_length("payload")
    return read.select(
        "doc_id",
        "n_bytes",
        size.cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", size - UNIT + 1, F.lit(UNIT))).alias("tail_crc32"),
        "media_bytes",
        "media_sha256",
        F.concat(F.lit("frames="), F.col("frames"), F.lit(";clips="), F.array_join(F.transform("clips", clip), ",")).alias("feature"),
    )
