"""Hashes of words and byte ranges, vectorised over the bytes of many texts.

A range's hash is its part of a running polynomial sum modulo 2^64 (random value
per byte, odd base), moved to a common start and scrambled with its length.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np

from occurra.llm.common import mix64

PIECE = 1 << 19  # bytes of text hashed at once

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = 1 << int(n).bit_length()
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, np.uint64(base))
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"], _powers["down"]


class Ranges:
    """Hashes of ranges of ``raw``."""

    def __init__(self, raw: bytes) -> None:
        self.raw, self.arr = raw, np.frombuffer(raw, np.uint8)
        up, self.down = _power(len(raw) + 1)
        sums = np.cumsum(_BYTE[self.arr] * up[: len(raw)], dtype=np.uint64)
        self.sums = np.concatenate([np.zeros(1, np.uint64), sums])

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sizes = ends - starts
        own = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        out = mix64(own + sizes.astype(np.uint64) * _STEP)
        for i in np.flatnonzero(sizes > 512):  # a polynomial is too weak for very long ranges
            part = self.raw[starts[i] : ends[i]]
            out[i] = int.from_bytes(hashlib.blake2b(part, digest_size=8).digest(), "little")
        return out


def hash_words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start offsets of the words of ``raw``, cut at ASCII white space."""
    gap = np.concatenate([[True], SPACE[np.frombuffer(raw, np.uint8)], [True]])
    turn = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = turn[::2], turn[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    return Ranges(raw).hash(starts, ends), starts


_CUT = re.compile(rb"[\x20\x09-\x0d]")


def pieces(raw: bytes) -> list[bytes]:
    """``raw`` in pieces of about ``PIECE`` bytes, cut after white space."""
    out, at = [], 0
    while at < len(raw):
        end = len(raw)
        if end - at > PIECE:
            gap = _CUT.search(raw, at + PIECE)
            end = gap.end() if gap else end
        out.append(raw[at:end])
        at = end
    return out


def long_words(raw: bytes) -> np.ndarray:
    """Word hashes of a text of any length, piece by piece."""
    got = [hash_words(p)[0] for p in pieces(raw)]
    return np.concatenate(got) if got else np.zeros(0, np.uint64)
