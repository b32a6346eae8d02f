"""Single JPEG frames, as motion-JPEG holds them: baseline (process 1) and lossless (process 14).

The general decoder, for frames that other programs wrote; media.decode_frames
has a faster way for its own. Frames must carry their Huffman tables.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from itertools import product

import numpy as np

#: Places of the 64 coefficients in zigzag order, as (row, column): diagonals, walked up and down in turn.
ZIGZAG = sorted(product(range(8), range(8)), key=lambda p: (sum(p), p[sum(p) % 2 == 0]))
_RESTART = re.compile(rb"\xff[\xd0-\xd7]")
_ZIGZAG_FLAT = np.array([8 * r + c for r, c in ZIGZAG])
_COSINES = np.array([[np.cos((2 * x + 1) * u * np.pi / 16) * (0.5 if u else 0.125**0.5) for x in range(8)] for u in range(8)])


class _Bits:
    """The bits of an entropy-coded segment without its stuffing; past the end stand ones."""

    def __init__(self, data: bytes):
        plain = data.replace(b"\xff\x00", b"\xff") + b"\xff" * 8
        self.bits, self.at = np.unpackbits(np.frombuffer(plain, dtype=np.uint8)).tobytes(), 0

    def take(self, n: int) -> int:
        value = 0
        for bit in self.bits[self.at : self.at + n]:
            value = value << 1 | bit
        self.at += n
        if self.at > len(self.bits):
            raise ValueError("the frame's data is cut off")
        return value

    def symbol(self, table: dict[tuple[int, int], int]) -> int:
        code = 0
        for n in range(1, 17):
            code = code << 1 | self.take(1)
            if (n, code) in table:
                return table[n, code]
        raise ValueError("a code of no table")

    def number(self, size: int) -> int:
        """A signed value of a size category."""
        if size == 16:
            return 32768
        bits = self.take(size)
        return bits if not size or bits >> (size - 1) else bits - (1 << size) + 1


def _tables(body: bytes) -> Iterator[tuple[int, dict[tuple[int, int], int]]]:
    """(class and place, codes) of a table segment."""
    at = 0
    while at < len(body):
        counts, place, code, table = body[at + 1 : at + 17], body[at], 0, {}
        at += 17
        for n, count in enumerate(counts, start=1):
            for _ in range(count):
                table[n, code] = body[at]
                code, at = code + 1, at + 1
            code <<= 1
        yield place, table


def _segments(file: bytes) -> Iterator[tuple[int, bytes, int]]:
    """(marker, body, where it ends) up to the start of scan."""
    at = 2
    while at + 4 <= len(file):
        if file[at] != 0xFF:
            raise ValueError("a marker is missing")
        if file[at + 1] == 0xFF:
            at += 1
            continue
        length = struct.unpack_from(">H", file, at + 2)[0]
        yield file[at + 1], file[at + 4 : at + 2 + length], at + 2 + length
        at += 2 + length


def decode_frame(file: bytes) -> np.ndarray:
    """Grey values (rows x columns, 8 bits) of a frame: its only component, or its first, the luminance."""
    if file[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG frame")
    quantisers, huffman, frame, restart = {}, {}, None, 0
    for marker, body, end in _segments(file):
        if marker == 0xC4:
            huffman.update(_tables(body))
        elif marker == 0xDB:
            at = 0
            while at < len(body):
                wide = body[at] >> 4
                quantisers[body[at] & 15] = np.frombuffer(body, dtype=">u2" if wide else np.uint8, count=64, offset=at + 1).astype(np.int64)
                at += 65 + 64 * wide
        elif marker == 0xDD:
            restart = struct.unpack(">H", body)[0]
        elif marker in (0xC0, 0xC1, 0xC3):
            bits, rows, columns, n = struct.unpack_from(">BHHB", body)
            parts = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
            frame = (marker, bits, rows, columns, parts)
        elif 0xC2 <= marker <= 0xCF:
            raise ValueError("neither a baseline nor a lossless frame")
        elif marker == 0xDA:
            break
    else:
        raise ValueError("a frame without a scan")
    if frame is None or frame[1] != 8:
        raise ValueError("only frames of 8-bit samples are read")
    chosen = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
    stop = file.rfind(b"\xff\xd9")
    scan = file[end : stop if stop > end else len(file)]
    pieces = _RESTART.split(scan)
    if frame[0] == 0xC3:
        return _lossless(pieces, frame, huffman[chosen[frame[4][0][0]] >> 4], body[1 + 2 * body[0]])
    return _baseline(pieces, frame, restart, quantisers, huffman, chosen)


def _lossless(pieces: list[bytes], frame: tuple, table: dict, predictor: int) -> np.ndarray:
    _, _, rows, columns, parts = frame
    if len(parts) != 1 or len(pieces) != 1 or not 1 <= predictor <= 7:
        raise ValueError("only one component without restarts is read")
    bits = _Bits(pieces[0])
    out = np.zeros((rows, columns), dtype=np.int64)
    for r in range(rows):
        for c in range(columns):
            left, up, corner = (int(out[r, c - 1]) if c else 0), (int(out[r - 1, c]) if r else 0), (int(out[r - 1, c - 1]) if r and c else 0)
            if r == 0:
                guess = left if c else 128
            elif c == 0:
                guess = up
            else:
                guess = (0, left, up, corner, left + up - corner, left + ((up - corner) >> 1), up + ((left - corner) >> 1), (left + up) >> 1)[predictor]
            out[r, c] = (guess + bits.number(bits.symbol(table))) & 0xFFFF
    return out.astype(np.uint8)


def _baseline(pieces: list[bytes], frame: tuple, restart: int, quantisers: dict, huffman: dict, chosen: dict) -> np.ndarray:
    _, _, rows, columns, parts = frame
    if len(parts) == 1:
        parts = [(parts[0][0], 1, 1, parts[0][3])]
    most_h, most_v = max(p[1] for p in parts), max(p[2] for p in parts)
    across, down = -(-columns // (8 * most_h)), -(-rows // (8 * most_v))
    _, h, v, quantiser = parts[0]
    blocks = np.zeros((down * v, across * h, 64), dtype=np.int64)
    step = restart or across * down
    for number, piece in enumerate(pieces):
        bits, last = _Bits(piece), {p[0]: 0 for p in parts}
        for unit in range(number * step, min((number + 1) * step, across * down)):
            for i, (name, ph, pv, _) in enumerate(parts):
                dc, ac = huffman[chosen[name] >> 4], huffman[0x10 | chosen[name] & 15]
                for y, x in product(range(pv), range(ph)):
                    last[name] += bits.number(bits.symbol(dc))
                    block, k = [last[name], *[0] * 63], 1
                    while k < 64:
                        pair = bits.symbol(ac)
                        if pair == 0:
                            break
                        k += pair >> 4
                        if pair & 15:
                            if k > 63:
                                raise ValueError("a block of more than 64 coefficients")
                            block[k] = bits.number(pair & 15)
                        k += 1
                    if i == 0:
                        blocks[unit // across * v + y, unit % across * h + x] = block
    natural = np.zeros(blocks.shape, dtype=np.float64)
    natural[..., _ZIGZAG_FLAT] = blocks * quantisers[quantiser]
    pixels = _COSINES.T @ natural.reshape(*blocks.shape[:2], 8, 8) @ _COSINES + 128
    plane = pixels.transpose(0, 2, 1, 3).reshape(8 * blocks.shape[0], 8 * blocks.shape[1])
    plane = plane[: -(-rows * v // most_v), : -(-columns * h // most_h)]
    return np.clip(np.round(plane), 0, 255).astype(np.uint8)
