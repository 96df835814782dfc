"""Per-word work inside tasks: chunks of texts, cached word values, n-gram hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

CHUNK_CHARS = 1_000_000
MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)


def chunks(texts: list, max_chars: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of at most ``max_chars`` characters (one text at least)."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > max_chars:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


class WordTable:
    """Rows of numbers per distinct word, computed once per task.

    ``compute`` maps a list of new words, of ``at_once`` at most, to an array with one row per word.
    The cache is emptied between chunks once it holds ``limit`` words, so
    memory stays bounded whatever the vocabulary.
    """

    def __init__(self, compute: Callable[[list[str]], np.ndarray], limit: int = 400_000, at_once: int | None = None):
        self.compute, self.limit, self.at_once = compute, limit, at_once
        self.index: dict = {}
        self.rows: np.ndarray | None = None
        self.used = 0

    def lookup(self, words: list) -> np.ndarray:
        """Row number of each word; new words are computed together."""
        if len(self.index) > self.limit:
            self.index, self.used = {}, 0
        new = list(set(words) - self.index.keys())
        step = self.at_once or max(len(new), 1)
        for at in range(0, len(new), step):
            some = new[at: at + step]
            values = self.compute(some)
            need = self.used + len(some)
            if self.rows is None or need > len(self.rows):
                grown = np.empty((max(2 * need, 65_536), *values.shape[1:]), values.dtype)
                if self.used:
                    grown[: self.used] = self.rows[: self.used]
                self.rows = grown
            self.rows[self.used: need] = values
            self.index.update(zip(some, range(self.used, need)))
            self.used = need
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))


def char_ngrams(words: list[str], sizes: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of ``<word>``: (bucket, index of the word) of every n-gram."""
    marked = [f"<{w}>" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(marked)), lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    at = np.arange(len(codes))
    out_b, out_w = [], []
    with np.errstate(over="ignore"):
        for n in sizes:
            if len(codes) < n:
                continue
            h = np.zeros(len(codes) - n + 1, np.uint64)
            for j in range(n):
                h = h * np.uint64(1_000_003) + codes[j: len(codes) - n + 1 + j]
            keep = at[: len(h)] + n <= ends[: len(h)]
            out_b.append(_mix(h[keep] + np.uint64(n << 56)) % np.uint64(buckets))
            out_w.append(owner[: len(h)][keep])
    if not out_b:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out_b).astype(np.int64), np.concatenate(out_w)


def _mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (shift, multiply), so that close inputs spread over all bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def windows(codes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` codes, from prefix sums of a polynomial modulo 2^64."""
    if len(codes) < width:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        up, down = powers(MULTIPLIER, len(codes)), powers(INVERSE, len(codes) - width + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * up, dtype=np.uint64)])
        return _mix((sums[width:] - sums[:-width]) * down + np.uint64(width))
