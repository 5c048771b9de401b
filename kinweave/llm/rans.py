"""Static range asymmetric numeral system (Duda 2013) with interleaved lanes, in numpy.

One block is coded on its own: its symbols fill a matrix of steps and lanes, and every lane keeps one 64-bit state that gives
off 32-bit words. States at regular steps are stored as checkpoints, so any segment of a block can be decoded alone, and a
checksum covers the payload.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

SCALE_BITS = 20
LOW = np.uint64(1 << 31)
LANES, SEGMENT = 2048, 128
HEADER = struct.Struct("<4sIIIQQQI")
MAGIC = b"RAN1"


def quantize(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum up to 2**SCALE_BITS, at least 1 for every symbol that occurs."""
    counts = counts.astype(np.float64)
    present = counts > 0
    free = (1 << SCALE_BITS) - int(present.sum())
    if free < 0:
        raise ValueError("more symbols than frequency slots")
    out = np.where(present, 1 + np.floor(counts * (free / max(counts.sum(), 1))), 0).astype(np.int64)
    if present.any():
        out[np.argmax(counts)] += (1 << SCALE_BITS) - out.sum()
    return out.astype(np.uint64)


class Coder:
    def __init__(self, freq: np.ndarray):
        self.freq = np.trim_zeros(freq.astype(np.uint64), "b")
        self.low = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        self.check = zlib.crc32(self.freq.tobytes())

    def encode(self, ids: np.ndarray, first: int) -> bytes:
        """One block; ``first`` is the place of its first id in the whole output."""
        n = len(ids)
        lanes = int(min(LANES, max(1, n // 64)))
        steps = -(-n // lanes)
        grid = np.full(steps * lanes, int(np.argmax(self.freq)), np.int64)
        grid[:n] = ids
        grid = grid.reshape(steps, lanes)
        x = np.full(lanes, LOW)
        words, written, marks = [], 0, []
        bits, shift = np.uint64(SCALE_BITS), np.uint64(63 - SCALE_BITS)
        for t in range(steps - 1, -1, -1):
            f = self.freq[grid[t]]
            over = np.flatnonzero(x >= f << shift)
            if len(over):
                words.append(x[over].astype(np.uint32))
                x[over] >>= np.uint64(32)
                written += len(over)
            q = x // f
            x = (q << bits) + (x - q * f) + self.low[grid[t]]
            if t % SEGMENT == 0:
                marks.append((written, x.copy()))
        marks.reverse()
        body = b"".join([
            np.array([m[0] for m in marks], "<u8").tobytes(), *[m[1].astype("<u8").tobytes() for m in marks],
            *[w.astype("<u4").tobytes() for w in words]])
        return HEADER.pack(MAGIC, lanes, SEGMENT, len(marks), n, first, written, self.check) + struct.pack("<I", zlib.crc32(body)) + body

    def decode(self, block: bytes, segments: range | None = None) -> tuple[np.ndarray, int]:
        """(ids of the wanted segments, of all by default; place of the block's first id in the whole output)."""
        magic, lanes, segment, n_marks, n, first, written, check = HEADER.unpack_from(block)
        (crc,) = struct.unpack_from("<I", block, HEADER.size)
        at = HEADER.size + 4
        if magic != MAGIC or check != self.check or zlib.crc32(memoryview(block)[at:]) != crc:
            raise ValueError("damaged block or another frequency table")
        upto = np.frombuffer(block, "<u8", n_marks, at)
        states = np.frombuffer(block, "<u8", n_marks * lanes, at + 8 * n_marks).reshape(n_marks, lanes)
        words = np.frombuffer(block, "<u4", written, at + 8 * n_marks * (1 + lanes))
        steps = -(-n // lanes)
        bits, mask = np.uint64(SCALE_BITS), np.uint64((1 << SCALE_BITS) - 1)
        out = []
        for k in range(n_marks) if segments is None else segments:
            x, pos, rows = states[k].copy(), int(upto[k]), min(segment, steps - k * segment)
            got = np.empty((rows, lanes), np.uint32)
            for t in range(rows):
                slot = x & mask
                s = self.symbol[slot]
                got[t] = s
                x = self.freq[s] * (x >> bits) + slot - self.low[s]
                few = np.flatnonzero(x < LOW)
                if len(few):
                    x[few] = (x[few] << np.uint64(32)) | words[pos - len(few):pos]
                    pos -= len(few)
            out.append(got.reshape(-1)[:max(0, n - k * segment * lanes)])
        return (np.concatenate(out) if out else np.zeros(0, np.uint32)), first
