"""The general frame decoder against frames written by a plain encoder."""

import struct

import numpy as np
import pytest

from graphloom.llm import jpeg as J
from graphloom.llm import media as M


def segment(marker, body):
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


DC_TABLE = bytes([0, 0, 0, 12] + [0] * 12) + bytes(range(12))
AC_SYMBOLS = [0x00, 0xF0] + [r << 4 | s for r in range(16) for s in range(1, 11)]
AC_TABLE = bytes([0] * 7 + [len(AC_SYMBOLS)] + [0] * 8) + bytes(AC_SYMBOLS)


def number(v):
    v = int(v)
    s = abs(v).bit_length()
    return s, f"{v if v >= 0 else v + (1 << s) - 1:0{s}b}" if s else ""


def block_bits(coefficients, last):
    s, bits = number(coefficients[0] - last)
    out, run = f"{s:04b}" + bits, 0
    filled = np.flatnonzero(coefficients)
    for k in range(1, (filled[-1] if len(filled) else 0) + 1):
        if coefficients[k] == 0:
            run += 1
            continue
        while run > 15:
            out, run = out + f"{AC_SYMBOLS.index(0xF0):08b}", run - 16
        s, bits = number(int(coefficients[k]))
        out, run = out + f"{AC_SYMBOLS.index(run << 4 | s):08b}" + bits, 0
    return out if len(filled) and filled[-1] == 63 else out + f"{0:08b}"


def packed(bits):
    bits += "1" * (-len(bits) % 8)
    return bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")


def coefficients(plane, quantiser):
    """Quantised blocks of a plane of whole blocks, by the definition of the transform."""
    rows, columns = plane.shape[0] // 8, plane.shape[1] // 8
    u, x = np.arange(8)[:, None], np.arange(8)[None]
    c = np.cos((2 * x + 1) * u * np.pi / 16) / 2
    c[0] /= 2**0.5
    out = np.zeros((rows, columns, 64), dtype=int)
    for r in range(rows):
        for k in range(columns):
            f = c @ (plane[8 * r : 8 * r + 8, 8 * k : 8 * k + 8] - 128.0) @ c.T
            out[r, k] = [round(f[p] / q) for p, q in zip(J.ZIGZAG, quantiser)]
    return out


def frame(parts, rows, columns, quantiser, restart=0):
    """parts: (h, v, plane padded to whole units) of each component."""
    head = b"\xff\xd8" + segment(0xDB, b"\x00" + bytes(quantiser)) + segment(0xC4, b"\x00" + DC_TABLE) + segment(0xC4, b"\x10" + AC_TABLE)
    head += segment(0xC0, struct.pack(">BHHB", 8, rows, columns, len(parts)) + b"".join(bytes([i + 1, h << 4 | v, 0]) for i, (h, v, _) in enumerate(parts)))
    if restart:
        head += segment(0xDD, struct.pack(">H", restart))
    head += segment(0xDA, bytes([len(parts)]) + b"".join(bytes([i + 1, 0]) for i in range(len(parts))) + bytes([0, 63, 0]))
    blocks = [coefficients(p, quantiser) for _, _, p in parts]
    across, down = blocks[0].shape[1] // parts[0][0], blocks[0].shape[0] // parts[0][1]
    data, bits, last, n = b"", "", [0] * len(parts), 0
    for unit in range(across * down):
        if restart and unit and unit % restart == 0:
            data, bits, last, n = data + packed(bits) + bytes([0xFF, 0xD0 + n % 8]), "", [0] * len(parts), n + 1
        for i, (h, v, _) in enumerate(parts):
            for y in range(v):
                for x in range(h):
                    b = blocks[i][unit // across * v + y, unit % across * h + x]
                    bits += block_bits(b, last[i])
                    last[i] = b[0]
    return head + data + packed(bits) + b"\xff\xd9"


def smooth(rows, columns, seed):
    r, c = np.mgrid[:rows, :columns]
    return np.clip(128 + 60 * np.sin(r / (5 + seed)) + 50 * np.cos(c / (7 + seed)), 0, 255).round()


def test_zigzag():
    assert J.ZIGZAG[:6] == [(0, 0), (0, 1), (1, 0), (2, 0), (1, 1), (0, 2)] and J.ZIGZAG[-1] == (7, 7) and len(set(J.ZIGZAG)) == 64


@pytest.mark.parametrize("restart", [0, 2])
def test_grey_baseline(restart):
    plane = smooth(24, 40, 1)
    noisy = plane + np.random.default_rng(1).integers(-20, 20, plane.shape)
    for p in (plane, np.clip(noisy, 0, 255)):
        got = J.decode_frame(frame([(1, 1, p)], 21, 37, [1] * 64, restart))
        assert got.shape == (21, 37) and np.abs(got - p[:21, :37]).max() <= 2


def test_colour_with_subsampling_gives_the_luminance():
    luma, chroma = smooth(32, 48, 2), smooth(16, 24, 3)
    got = J.decode_frame(frame([(2, 2, luma), (1, 1, chroma), (1, 1, chroma)], 30, 45, [2] * 64, 3))
    assert got.shape == (30, 45) and np.abs(got - luma[:30, :45]).max() <= 6


@pytest.mark.parametrize("predictor", range(1, 8))
def test_lossless_predictors(predictor):
    x = np.random.default_rng(predictor).integers(0, 256, (5, 9))
    bits = ""
    for r in range(5):
        for c in range(9):
            a, b, d = x[r, c - 1] if c else 0, x[r - 1, c] if r else 0, x[r - 1, c - 1] if r and c else 0
            inner = [0, a, b, d, a + b - d, a + ((b - d) >> 1), b + ((a - d) >> 1), (a + b) >> 1][predictor]
            s, extra = number(int(x[r, c] - (128 if r == c == 0 else a if r == 0 else b if c == 0 else inner)))
            bits += f"{s:04b}" + extra
    file = b"\xff\xd8" + segment(0xC4, b"\x00" + DC_TABLE) + segment(0xC3, struct.pack(">BHHB", 8, 5, 9, 1) + bytes([1, 0x11, 0]))
    file += segment(0xDA, bytes([1, 1, 0, predictor, 0, 0])) + packed(bits) + b"\xff\xd9"
    assert np.array_equal(J.decode_frame(file), x)


def test_own_frames_and_foreign_ones_together():
    samples = np.random.default_rng(0).integers(0, 256, (2, M.HEIGHT, M.WIDTH), dtype=np.uint8)
    files = M.encode_frames(samples)
    assert np.array_equal(J.decode_frame(files[0]), samples[0])
    other = frame([(1, 1, smooth(16, 64, 1))], 16, 64, [1] * 64)
    both = M.decode_frames([files[1], other])
    assert [f.shape for f in both] == [(M.HEIGHT, M.WIDTH), (16, 64)] and np.array_equal(both[0], samples[1])


def test_broken_frames():
    good = frame([(1, 1, smooth(8, 8, 1))], 8, 8, [1] * 64)
    for bad in (b"", b"\xff\xd8", good[:30], good.replace(b"\xff\xc0", b"\xff\xc2"), b"no jpeg at all"):
        with pytest.raises((ValueError, KeyError, struct.error)):
            J.decode_frame(bad)
