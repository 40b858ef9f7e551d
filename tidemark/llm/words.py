"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidemark.llm.common import SPACE

# Bytes handled together; a longer text is handled alone.
CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1


def _fold(separators: str, lower: bool = True) -> np.ndarray:
    """A byte table: 0 for separators, lower case for A-Z if asked, else the byte itself."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        upper = np.arange(ord("A"), ord("Z") + 1)
        table[upper] = upper + 32
    table[[ord(c) for c in separators]] = 0
    return table


PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
PLAIN = _fold(SPACE, lower=False)
TERMS = _fold(SPACE + PUNCTUATION)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(29))
    return values * np.uint64(0x94D049BB133111EB) ^ (values >> np.uint64(32))


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers: dict[str, np.ndarray] = {}


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < size:
        room = max(size, CHUNK)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            table = np.full(room, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table)
    return _powers["up"][:size], _powers["down"]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """One more entry than ``data``: entry i is a sum over the bytes before i."""
    up, _ = _power_tables(len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans; equal bytes have equal hashes wherever they stand."""
    _, down = _power_tables(len(sums))
    return mixed((sums[ends] - sums[starts]) * down[starts])


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) of runs of texts; NULL is empty.

    ``offsets`` has last - first + 1 entries and begins at 0.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    empty = buffers[2] is None or not buffers[2].size
    data = np.empty(0, np.uint8) if empty else np.frombuffer(buffers[2], np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        part = offsets[first : last + 1]
        yield first, last, data[part[0] : part[-1]], part - part[0]
        first = last


def words(
    data: np.ndarray, offsets: np.ndarray, table: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(folded bytes, starts, ends, text index) of all words; a word never crosses texts."""
    folded = table[data]
    inside = folded != 0
    heads = offsets[:-1][offsets[:-1] < len(data)]
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    if len(data):
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[heads] = False
        after[heads[heads > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    owner = np.searchsorted(offsets, starts, "right") - 1
    return folded, starts, ends, owner


def counts(values: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """Sums of ``values`` by text."""
    return np.bincount(owner, weights=values, minlength=size)


def sums_by_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums over the bytes of each text."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
