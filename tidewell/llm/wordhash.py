"""Vectorised 64-bit hashes of words and word shingles over batches of texts.

A word is a longest run of bytes other than space and 0x09-0x0D. Word hashes
are differences of one running polynomial sum over the whole batch, so the cost
is a few array passes a byte whatever the number of words. Sums are modulo
2**64 with a random value for each byte, and are mixed before use. The arrays
take some fifty bytes a byte of text, so a text of more than CHUNK_BYTES is
hashed in pieces of that size, whatever its length and that of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19


def chunks(texts: pa.Array, limit: int | None = None) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of binary texts of about ``limit`` bytes (a longer text comes alone), with the first one's index; a null is empty.

    Texts are taken out of the column run by run, so a batch is not there twice.
    """
    limit, start, total = limit or CHUNK_BYTES, 0, 0
    taken = lambda end: (start, [t or b"" for t in texts.slice(start, end - start).to_pylist()])
    for i, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if total and total + size > limit:
            yield taken(i)
            start, total = i, 0
        total += size + 1
    if start < len(texts):
        yield taken(len(texts))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def distinct(parts: Iterator[np.ndarray]) -> np.ndarray:
    """The sorted distinct values of many arrays; memory follows their number."""
    whole, held, waiting = np.zeros(0, np.uint64), [], 0
    for part in parts:
        held.append(np.unique(part))
        waiting += len(held[-1])
        if waiting > max(1 << 20, len(whole)):
            whole, held, waiting = np.unique(np.concatenate([whole, *held])), [], 0
    return np.unique(np.concatenate([whole, *held])) if held else whole


class WordHasher:
    """Hashes of the words of a run of texts; keeps its power tables between calls."""

    def __init__(self, lower_ascii: bool = True, seed: int = 7, breaks: bytes = b" \t\n\x0b\x0c\r"):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        if lower_ascii:
            self.values[65:91] = self.values[97:123]
        self.is_space = np.zeros(256, bool)
        self.is_space[list(breaks)] = True
        self.base = int(rng.integers(1 << 40, 1 << 62)) | 1
        self.power = self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            size = max(n, CHUNK_BYTES + 4096)
            inverse = pow(self.base, -1, 1 << 64)
            up, down = np.full(size, self.base, np.uint64), np.full(size, inverse, np.uint64)
            up[0] = down[0] = 1
            self.power, self.inverse = np.multiply.accumulate(up), np.multiply.accumulate(down)

    def _raw(self, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sum of each word from its start, not mixed; starts; ends) of the words in an array of bytes."""
        n = len(joined)
        self._powers(n)
        edge = np.diff(np.concatenate(([True], self.is_space[joined], [True])).view(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[joined] * self.power[:n], out=sums[1:])
        return (sums[ends] - sums[starts]) * self.inverse[starts], starts, ends

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash of each word, index of its text, words of each text)."""
        raw, starts, _ = self._raw(np.frombuffer(b"\n".join(texts) + b"\n", np.uint8))
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        bounds = np.searchsorted(starts, np.cumsum(sizes))
        counts = np.diff(np.concatenate(([0], bounds)))
        return mix(raw), np.repeat(np.arange(len(texts)), counts), counts

    def stream(self, text: bytes, limit: int | None = None) -> Iterator[np.ndarray]:
        """Hashes of the words of one text, in order, from pieces of ``limit`` bytes."""
        limit = limit or CHUNK_BYTES
        total = size = 0  # of a word that the pieces so far end in
        for at in range(0, len(text), limit):
            piece = np.frombuffer(text, np.uint8, min(limit, len(text) - at), at)
            raw, starts, ends = self._raw(piece)
            found = [np.zeros(0, np.uint64)]
            if size and (not len(starts) or starts[0]):
                found.append(mix(np.array([total], np.uint64)))
                total = size = 0
            if len(starts):
                if size:
                    raw[0] = (total + int(raw[0]) * pow(self.base, size, 1 << 64)) & (1 << 64) - 1
                open_ = ends[-1] == len(piece)
                size = (size if open_ and len(starts) == 1 else 0) + int(ends[-1] - starts[-1]) if open_ else 0
                total = int(raw[-1]) if open_ else 0
                found.append(mix(raw[:-1] if open_ else raw))
            yield np.concatenate(found)
        if size:
            yield mix(np.array([total], np.uint64))

    @staticmethod
    def _steps(k: int) -> list[np.uint64]:
        return [np.uint64(pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) | 1) for i in range(k)]

    def _runs(self, word: np.ndarray, k: int) -> np.ndarray:
        """Sums of every run of ``k`` words, not mixed."""
        n, total = len(word), np.zeros(len(word) - k + 1, np.uint64)
        for i, step in enumerate(self._steps(k)):
            total += mix(word[i : n - k + 1 + i] + step) * step
        return total

    def _short(self, word: np.ndarray) -> np.uint64:
        """The shingle of a whole sequence of few words."""
        total = int(len(word)) + sum(int(mix(word[i : i + 1] + step)[0]) * int(step) for i, step in enumerate(self._steps(len(word))))
        return mix(np.array([total & (1 << 64) - 1], np.uint64) ^ np.uint64(0x5851F42D4C957F2D))[0]

    def _long_text(self, text: bytes, k: int) -> np.ndarray:
        """The sorted distinct shingles of one text of any length; memory follows their number."""
        last = np.zeros(0, np.uint64)

        def runs() -> Iterator[np.ndarray]:
            nonlocal last
            for word in self.stream(text):
                last = np.concatenate((last, word))
                if len(last) >= k:
                    yield mix(self._runs(last, k))
                    last = last[len(last) - k + 1 :]

        whole = distinct(runs())
        return whole if len(whole) or not len(last) else np.array([self._short(last)], np.uint64)

    def shingles(self, texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
        """(sorted distinct shingle hashes, text by text; number of each text).

        A text of fewer than ``k`` words has its whole sequence as its one
        shingle, a text without words none.
        """
        if len(texts) == 1 and len(texts[0]) > CHUNK_BYTES:
            found = self._long_text(texts[0], k)
            return found, np.array([len(found)])
        word, text, counts = self.words(texts)
        found, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(word) >= k:
            total, last = self._runs(word, k), len(word) - k + 1
            whole = text[k - 1 :] == text[:last]
            found, owner = mix(total[whole]), text[:last][whole]
        short = np.flatnonzero((counts > 0) & (counts < k))
        if len(short):
            first = np.concatenate(([0], np.cumsum(counts)))
            extra = [self._short(word[first[t] : first[t + 1]]) for t in short]
            found = np.concatenate((found, np.array(extra, np.uint64)))
            owner = np.concatenate((owner, short))
        order = np.lexsort((found, owner))
        found, owner = found[order], owner[order]
        if len(found):
            new = np.concatenate(([True], (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])))
            found, owner = found[new], owner[new]
        return found, np.bincount(owner, minlength=len(texts))
