import hashlib
import struct
import zlib

import numpy as np
import pytest

from graphloom.llm import media as M
from graphloom.llm.queries import queries


def plain_decode(file):
    """A lossless JPEG frame, bit by bit, from its own Huffman table."""
    at, table, size = 2, {}, None
    while True:
        marker, length = file[at + 1], struct.unpack_from(">H", file, at + 2)[0]
        body = file[at + 4 : at + 2 + length]
        at += 2 + length
        if marker == 0xC4:
            code, values = 0, iter(body[17:])
            for bits, n in enumerate(body[1:17], start=1):
                for _ in range(n):
                    table[bits, code] = next(values)
                    code += 1
                code <<= 1
        elif marker == 0xC3:
            size = struct.unpack(">HH", body[1:5])
        elif marker == 0xDA:
            assert body[3] == 1  # left predictor
            break
    bits = "".join(f"{b:08b}" for b in file[at:-2].replace(b"\xff\x00", b"\xff"))
    out, p = np.zeros(size, dtype=int), 0
    for r in range(size[0]):
        for c in range(size[1]):
            n = 1
            while (n, int(bits[p : p + n], 2)) not in table:
                n += 1
            s = table[n, int(bits[p : p + n], 2)]
            p += n
            v = int(bits[p : p + s] or "0", 2)
            p += s
            d = v if not s or v >> (s - 1) else v - (1 << s) + 1
            out[r, c] = d + (out[r, c - 1] if c else out[r - 1, c] if r else 128)
    return out


def test_frames_are_lossless_jpeg():
    rng = np.random.default_rng(1)
    samples = rng.integers(0, 256, (3, M.HEIGHT, M.WIDTH), dtype=np.uint8)
    samples[1] = np.tile([0, 255], M.FRAME_SAMPLES // 2).reshape(M.HEIGHT, M.WIDTH)
    files = M.encode_frames(samples)
    assert np.array_equal(np.stack(M.decode_frames(files)), samples)
    for f, s in zip(files, samples):
        assert np.array_equal(plain_decode(f), s)


@pytest.mark.parametrize("n", [64, 128, 1024, 1088, 4096, 64 * 40000])
def test_avi_round_trip(n):
    payload = np.random.default_rng(n).integers(0, 256, n, dtype=np.uint8).tobytes()
    data = M.write_avi(payload)
    assert struct.unpack_from("<I", data, 4)[0] == len(data) - 8
    movie = M.read_avi(data)
    assert movie.payload_bytes == n and len(movie.files) == -(-n // 1024) and movie.frame_us == 40_000
    assert np.stack(M.decode_frames(movie.files)).tobytes()[:n] == payload
    no_index = data[: data.rindex(b"idx1")]
    assert M.read_avi(no_index[:4] + struct.pack("<I", len(no_index) - 8) + no_index[8:]).files == movie.files
    with pytest.raises(ValueError):
        M.read_avi(b"RIFFxxxxWAVE")


def test_shots_follow_histogram_changes():
    rng = np.random.default_rng(2)
    dark, light = rng.integers(20, 60, (7, M.HEIGHT, M.WIDTH)), rng.integers(150, 220, (5, M.HEIGHT, M.WIDTH))
    frames = np.concatenate([dark, light, dark]).astype(np.uint8)
    assert M.shots(frames) == [(0, 7), (7, 12), (12, 19)]
    assert M.shots(frames[:1]) == [(0, 1)]
    assert M.shots([]) == []


def riff(*chunks):
    body = b"AVI " + b"".join(chunks)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def frame(size, value):
    """A lossless frame of another size, with codes of one length: all differences after the first are 0."""
    rows, columns = size
    d = value - 128
    s = abs(d).bit_length()
    bits = f"{s:04b}" + (f"{d if d >= 0 else d + (1 << s) - 1:0{s}b}" if s else "") + "0000" * (rows * columns - 1)
    bits += "1" * (-len(bits) % 8)
    data = bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")
    table = bytes([0, 0, 0, 9, *[0] * 12]) + bytes(range(9))
    segment = lambda m, b: struct.pack(">BBH", 0xFF, m, len(b) + 2) + b
    return (
        b"\xff\xd8" + segment(0xC4, b"\x00" + table) + segment(0xC3, struct.pack(">BHHBBBB", 8, rows, columns, 1, 1, 0x11, 0))
        + segment(0xDA, bytes([1, 1, 0, 1, 0, 0])) + data + b"\xff\xd9"
    )


def test_indexes_of_all_kinds():
    files = [frame((4, 8), 10), frame((2, 3), 200)]
    chunks = [M._chunk(b"00dc", f) for f in files]
    movi = M._list(b"movi", b"".join(chunks))
    listed = M._list(b"movi", M._list(b"rec ", chunks[0] + M._chunk(b"01wb", b"abc")) + M._list(b"rec ", chunks[1]))
    starts = [4, 4 + len(chunks[0])]
    for base in (0, 12 + 8):  # from the movi list, and from the file's start
        index = b"".join(b"00dc" + struct.pack("<III", 16, base + s, len(f)) for s, f in zip(starts, files))
        assert M.read_avi(riff(movi, M._chunk(b"idx1", index))).files == files
    assert M.read_avi(riff(movi)).files == M.read_avi(riff(listed)).files == files
    beside = b"00dc" + struct.pack("<III", 16, 5, len(files[0]))
    with pytest.raises(ValueError):
        M.read_avi(riff(movi, M._chunk(b"idx1", beside)))
    # OpenDML: the second frame lies in a further RIFF segment
    strh = b"vidsMJPG" + b"\0" * 48
    head = lambda at: M._list(b"hdrl", M._list(b"strl", M._chunk(b"strh", strh) + M._chunk(b"indx", struct.pack("<HBBI4s3I", 4, 0, 0, 1, b"00dc", 0, 0, 0) + struct.pack("<QII", at, 32, 2))))
    first = riff(head(0), M._list(b"movi", chunks[0]))
    at = first.index(files[0])
    second = b"RIFF" + struct.pack("<I", 4 + len(M._list(b"movi", chunks[1]))) + b"AVIX" + M._list(b"movi", chunks[1])
    places = [at, len(first) + second.index(files[1])]
    standard = M._chunk(b"ix00", struct.pack("<HBBI4sQI", 2, 0, 1, 2, b"00dc", 0, 0) + b"".join(struct.pack("<II", p, len(f)) for p, f in zip(places, files)))
    whole = riff(head(len(first) + len(second)), M._list(b"movi", chunks[0])) + second + standard
    assert M.read_avi(whole).files == files


def test_files_of_others_and_broken_ones(spark):
    mixed = riff(M._list(b"movi", b"".join(M._chunk(b"00dc", f) for f in (frame((4, 8), 10), frame((2, 3), 200)))))
    rows = [(1, mixed), (2, riff(M._list(b"movi", b""))), (3, b"RIFF"), (4, None), (5, mixed[:-40]), (6, M.write_avi(b"x" * 64)), (7, riff(M._list(b"movi", M._chunk(b"00dc", b"no frame"))))]
    got = {r.doc_id: r for r in M.read_media(spark.createDataFrame(rows, "doc_id long, media binary")).collect()}
    assert got[1].payload == bytes([10] * 32 + [200] * 6) and got[1].frames == 2 and [(c.first_frame, c.end_frame) for c in got[1].clips] == [(0, 2)]
    assert (got[2].payload, got[2].frames, got[2].clips, got[2].fault) == (b"", 0, [], None)
    assert all(got[i].payload is None and got[i].clips is None and got[i].fault for i in (3, 5, 7))
    assert got[4].payload is None and got[4].fault is None
    assert got[6].payload == b"x" * 64 and got[6].fault is None


def test_query_on_a_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries()["op5_media"](spark, sf_dir).collect()}
    assert got.keys() == docs.keys()
    for d, text in docs.items():
        raw = text.encode()
        payload = raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
        media = M.write_avi(payload)
        wanted = (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest())
        assert got[d][1:7] == wanted
        clips = M.shots(list(np.frombuffer(payload + b"\0" * (-len(payload) % 1024), np.uint8).reshape(-1, M.HEIGHT, M.WIDTH)))
        told = ",".join(f"{i}:{a}-{b}@{a / 25:.2f}-{b / 25:.2f}" for i, (a, b) in enumerate(clips))
        assert got[d].feature == f"frames={clips[-1][1]};clips={told}"


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "é" * 3000)], "doc_id long, text string").selectExpr("*", "1 AS media", "2 AS payload")
    got = M.media_digests(docs).collect()
    assert sorted(r.payload_bytes for r in got) == [64, 64, 64, 6016]
    clips = M.clip_rows(M.read_media(M.store_texts(docs))).filter("doc_id = 2").orderBy("clip").collect()
    assert clips[0].start_s == 0 and clips[-1].end_frame == 6 and clips[-1].end_s == pytest.approx(0.24)
    assert M.media_digests(docs.limit(0)).count() == 0
