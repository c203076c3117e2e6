"""Hashes of the words of many texts at once, on byte arrays.

Words are runs of ASCII letters (lower-cased) and digits and of all characters beyond ASCII.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def word_table() -> bytes:
    """Maps a byte to its lower-case form in a word, and to a blank outside words."""
    return bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


WORD_BYTES = word_table()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=_U) * _U(0xA0761D6478BD642F))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64; kept up to a few million, as far as they were asked for."""
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(1 << 19, 1 << (n - 1).bit_length())
        up, down = np.full(size, _BASE, _U), np.full(size, _INVERSE, _U)
        up[0] = down[0] = 1
        up, down = np.cumprod(up), np.cumprod(down)
        if size > 1 << 23:
            return up, down
        _POWERS.update(up=up, down=down)
    return _POWERS["up"], _POWERS["down"]


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums from which ``span_hash`` takes the hash of any byte range, and the inverse powers."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE_VALUES[data] * up[:len(data)], out=sums[1:])
    return sums, down


def span_hash(sums: np.ndarray, down: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(_U))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array with a zero byte after each, and where each starts (one more entry than texts)."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return np.frombuffer(b"\0".join(texts) + b"\0", np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts in order, and where each text's words start (one more entry than texts)."""
    if not texts:
        return np.zeros(0, _U), np.zeros(1, np.int64)
    data, at = joined([t.translate(WORD_BYTES) for t in texts])
    start, end = runs((data != 32) & (data != 0))
    sums, down = prefix_sums(data)
    return span_hash(sums, down, start, end), np.searchsorted(start, at)


def _cuts(lengths, size: int):
    first, total, i = 0, 0, -1
    for i, n in enumerate(lengths):
        if total and total + n > size:
            yield first, i
            first, total = i, 0
        total += n
    if first <= i:
        yield first, i + 1


def chunks(texts: list, size: int = 1 << 20):
    """Slices of ``texts`` of about ``size`` bytes; a longer text comes alone."""
    return _cuts(map(len, texts), size)


def slices(column: pa.Array, size: int = 1 << 18):
    """``first, end, texts`` for slices of a column of texts of about ``size`` bytes (UTF-8; a null text is empty).

    Only one slice at a time is held as Python objects, however many rows a batch has; a longer text comes alone.
    """
    data = column.cast(pa.large_binary())
    for a, b in _cuts(pc.fill_null(pc.binary_length(data), 0).to_numpy(zero_copy_only=False), size):
        yield a, b, [t or b"" for t in data.slice(a, b - a).to_pylist()]
