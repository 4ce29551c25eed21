"""Unsigned crc32 of many byte spans at once, as ``zlib.crc32`` has it."""

from __future__ import annotations

import zlib

import numpy as np

#: Longer spans are given to zlib one by one.
SHORT = 64


def _table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


TABLE = _table()


def crc_byte(crc: np.ndarray, byte: int) -> np.ndarray:
    """Checksums after one more byte, the same for all."""
    c = ~crc
    return ~(TABLE[(c ^ np.uint32(byte)) & np.uint32(255)] ^ (c >> np.uint32(8)))


def crc_spans(raw: np.ndarray, start: np.ndarray, end: np.ndarray, crc: np.ndarray | None = None) -> np.ndarray:
    """Checksum of each span of ``raw``, carried on from ``crc`` (from nothing: zeros)."""
    out = np.zeros(len(start), np.uint32) if crc is None else crc.astype(np.uint32)
    size = end - start
    order = np.argsort(-size, kind="stable")
    long = int(np.searchsorted(-size[order], -SHORT, "left"))  # the first so many are longer than SHORT
    for k in order[:long].tolist():
        out[k] = zlib.crc32(raw[start[k] : end[k]].tobytes(), int(out[k]))
    order = order[long:]
    c, at, falling = ~out[order], start[order], -size[order]
    for j in range(int(-falling[0]) if len(order) else 0):
        n = int(np.searchsorted(falling, -j, "left"))  # spans of more than j bytes
        x = c[:n]
        c[:n] = TABLE[(x ^ raw[at[:n] + j]) & np.uint32(255)] ^ (x >> np.uint32(8))
    out[order] = ~c
    return out
