"""Random walks that turn edit distance over words into Hamming distance, and keys of their steps.

The embedding of Chakraborty, Goldenberg and Koucky: a walk stands on a word, writes it down and
moves on or stays by a random bit of (step, word). Two sequences that differ by few edits write
down the same words at most steps, since walks that fall out of step meet again by chance. A key
is a few sampled steps of one walk: bit-sampling LSH under the Hamming distance.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from tidemark.llm import words

# Least lengths of the classes of windows; a longer item is cut into pieces of at most PIECE words.
CLASSES = (1, 2, 3, 4, 6, 9, 13, 19, 28, 42)
PIECE = 63
SAMPLED = 3
KEYS = 8
MAX_REPEATS = 64
# Repeats and copies of the trials that the chance of a hit is measured on.
TRIED = 32
COPIES = 40
# Places that are walked together.
CHUNK = 1 << 13
END = np.uint64(0)


def length_class(length: int) -> int:
    return int(np.searchsorted(CLASSES, length, "right")) - 1


def pieces(length: int) -> list[tuple[int, int]]:
    """(first, last) of the parts of an item; a whole one where it has at most PIECE words.

    If an item has at most a share of edits, so has one of its parts.
    """
    parts = -(-length // PIECE)
    cuts = [length * i // parts for i in range(parts + 1)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def sampled_steps(repeat: int, kind: int) -> np.ndarray:
    """KEYS rows of SAMPLED steps among the two steps per word that a walk of the class takes."""
    rng = np.random.default_rng([repeat, kind])
    return np.sort(rng.integers(0, 2 * CLASSES[kind], (KEYS, SAMPLED)), axis=1)


def _factors(repeat: int, kind: int, backward: bool) -> np.ndarray:
    rng = np.random.default_rng([repeat, kind, 7 + backward])
    return rng.integers(0, 1 << 63, (KEYS, SAMPLED), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def laid_out(spans: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(line, heads): the spans with END before, between and after them, and where each begins."""
    sizes = np.array([len(s) for s in spans], np.int64)
    heads = np.cumsum(sizes + 1) - sizes
    line = np.full(int(sizes.sum()) + len(spans) + 1, END, np.uint64)
    for head, span in zip(heads.tolist(), spans, strict=True):
        line[head : head + len(span)] = span.view(np.uint64) | np.uint64(1)
    return line, heads


def walked(line: np.ndarray, repeat: int, n_steps: int, starts: np.ndarray) -> np.ndarray:
    """The word at each step (rows) of the walks that begin at ``starts`` (columns)."""
    at = starts.astype(np.int64)
    out = np.empty((n_steps, len(at)), np.uint64)
    for step in range(n_steps):
        if step % 64 == 0:
            salt = words.mixed(np.array([repeat * 1024 + step + 1], np.uint64))[0]
            # Nothing moves past the end of a span.
            moves = np.where(line == END, END, words.mixed(line ^ salt))
        out[step] = line[at]
        at = at + ((moves[at] >> np.uint64(step % 64)) & np.uint64(1)).astype(np.int64)
    return out


def keys(line: np.ndarray, starts: np.ndarray, repeat: int, kinds: list[int], backward: bool):
    """(kind, number, keys) of the walks from ``starts``; a key is 0 where a step is past the end.

    A backward walk reads the line from its other side; ``starts`` are places in it as given.
    """
    if backward:
        line, starts = line[::-1], len(line) - 1 - starts
    steps = walked(line, repeat, 2 * CLASSES[max(kinds)], starts)
    for kind in kinds:
        factors = _factors(repeat, kind, backward)
        for number, chosen in enumerate(sampled_steps(repeat, kind)):
            key = np.zeros(len(starts), np.uint64)
            for factor, step in zip(factors[number], chosen, strict=True):
                key += steps[step] * factor
            key ^= key >> np.uint64(32)
            # Steps are sorted, and a walk that has come to the end stays there.
            yield kind, number, np.where(steps[chosen[-1]] == END, END, key | np.uint64(1) << np.uint64(63))


def item_keys(items: list[np.ndarray], repeats: int) -> tuple[np.ndarray, np.ndarray]:
    """(item number, key) of both walks over every piece of every item."""
    owners, spans = [], []
    for number, item in enumerate(items):
        for first, last in pieces(len(item)):
            owners.append(number)
            spans.append(item[first:last])
    owner, found_owner, found = np.array(owners), [], []
    kinds = np.array([length_class(len(s)) for s in spans])
    for kind in np.unique(kinds).tolist():
        own = np.flatnonzero(kinds == kind)
        line, heads = laid_out([spans[i] for i in own])
        tails = heads + np.array([len(spans[i]) for i in own]) - 1
        for repeat in range(repeats):
            for backward, starts in ((False, heads), (True, tails)):
                for _, _, key in keys(line, starts, repeat, [kind], backward):
                    found_owner.append(owner[own][key != END])
                    found.append(key[key != END])
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(found_owner), np.concatenate(found)


@dataclass(frozen=True)
class Trial:
    """Hits of one placement of edits: by copy and repeat, whether any key agrees."""

    kind: int
    placement: str
    hits: np.ndarray


def _edit(item: np.ndarray, edits: int, placement: str, rng: np.random.Generator) -> np.ndarray:
    n = len(item)
    low = {"head": 0, "middle": (n - edits) // 2, "tail": n - edits}.get(placement)
    if placement == "even":
        places = (np.arange(edits) * n + n // 2) // max(edits, 1)
    elif placement == "random":
        places = rng.choice(n, edits, replace=False)
    else:
        places = np.arange(low, low + edits)
    kind = rng.integers(0, 3, n)
    if placement in ("head", "middle", "tail"):
        kind[:] = rng.integers(0, 2)
    out = []
    edited = set(places.tolist())
    for i, word in enumerate(item.tolist()):
        if i not in edited:
            out.append([word])
            continue
        new = int(rng.integers(1, 1 << 62))
        out.append([[new], [], [word, new]][kind[i]])
    return np.array([w for part in out for w in part], np.uint64)


def trials(kind: int, edits_of, copies: int, repeats: int) -> list[Trial]:
    """Copies of random items with all allowed edits in each placement, searched with ``repeats``."""
    rng = np.random.default_rng([11, kind])
    longest = CLASSES[kind + 1] - 1 if kind + 1 < len(CLASSES) else PIECE
    out = []
    for placement in ("head", "middle", "tail", "even", "random"):
        lengths = rng.integers(CLASSES[kind], longest + 1, copies)
        items = [rng.integers(1, 1 << 62, n, dtype=np.uint64) for n in lengths]
        texts = [_edit(item, edits_of(len(item)), placement, rng) for item in items]
        around = [rng.integers(1, 1 << 62, 4, dtype=np.uint64) for _ in texts]
        texts = [np.concatenate([a, t, a]) for a, t in zip(around, texts, strict=True)]
        line, heads = laid_out(items)
        tails = heads + lengths - 1
        other, other_heads = laid_out(texts)
        owner = np.repeat(np.arange(copies), [len(t) for t in texts])
        starts = np.flatnonzero(other != END)
        hits = np.zeros((copies, repeats), bool)
        for repeat in range(repeats):
            for backward, own in ((False, heads), (True, tails)):
                a = keys(line, own, repeat, [kind], backward)
                b = keys(other, starts, repeat, [kind], backward)
                for (_, _, item_key), (_, _, text_key) in zip(a, b, strict=True):
                    same = (text_key == item_key[owner]) & (text_key != END)
                    hits[owner[same], repeat] = True
        out.append(Trial(kind, placement, hits))
    return out


@lru_cache(maxsize=64)
def repeats_for(recall: float, similarity: float, kind: int) -> int:
    """Least repeats that find copies of the class with all allowed edits, at the worst placement,
    with at least the chance ``recall``; each copy's chance per repeat comes from trials."""
    found = trials(kind, lambda n: int((1 - similarity) * n + 1e-9), COPIES, TRIED)
    # One miss is added, so that no chance is taken for certain.
    chances = [t.hits.sum(axis=1) / (TRIED + 1) for t in found]
    for repeats in range(1, MAX_REPEATS):
        if 1 - max(((1 - c) ** repeats).mean() for c in chances) >= recall:
            return repeats
    raise ValueError(f"{MAX_REPEATS} repeats do not reach a recall of {recall}; 1 searches exactly")


def kinds_of(lengths: list[int]) -> list[int]:
    """The classes of all pieces of items of these lengths."""
    return sorted({length_class(b - a) for n in lengths for a, b in pieces(n)})
