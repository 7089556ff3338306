"""A bidirectional FM-index over delimited words, searched for many patterns at a time in numpy.

The text is a ring: every word after a delimiter, the smallest symbol. Suffixes are rotations of the ring. One index is
over the ring, a second one over the ring read backwards; a pattern has an interval of ranks in each of both, and a
symbol can be put before or after the pattern with both kept up to date.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def rotations(text: np.ndarray, bits: int) -> np.ndarray:
    """The starts of all rotations in order: ranks of prefixes that double in length, from as many symbols as fit a long."""
    size, step = len(text), max(1, 60 // bits)
    key = np.zeros(size, dtype=np.int64)
    for k in range(step):
        key = key << bits | np.roll(text, -k)
    while True:
        order = np.argsort(key, kind="stable")
        fresh = np.diff(key[order], prepend=key[order[:1]]) != 0
        rank = np.empty(size, dtype=np.int64)
        rank[order] = np.cumsum(fresh)
        if rank[order[-1]] == size - 1 or step >= size:
            return order
        key = rank * size + np.roll(rank, -(step % size))
        step *= 2


class Index:
    """Ranks of one reading direction. The symbols before the rotations are kept as a matrix of bits by level."""

    def __init__(self, text: np.ndarray, bits: int):
        self.starts, self.bits = rotations(text, bits), bits
        before = text[self.starts - 1]
        self.first = np.searchsorted(np.sort(text), np.arange((1 << bits) + 1))  # where a symbol's rotations begin
        self.zeros = []
        for level in range(bits - 1, -1, -1):
            one = before >> level & 1
            self.zeros.append(np.concatenate(([0], np.cumsum(1 - one))))
            before = np.concatenate((before[one == 0], before[one == 1]))
        symbols = np.arange(1 << bits)
        self.begin, _, _ = self._down(np.zeros(len(symbols), np.int64), np.zeros(len(symbols), np.int64), symbols)

    def _down(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        less = np.zeros(len(low), dtype=np.int64)
        for level, zeros in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            one, a, b = (symbol >> level & 1).astype(bool), zeros[low], zeros[high]
            less += np.where(one, b - a, 0)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return low, high, less

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals with a symbol put before the pattern, and how many smaller symbols stand before it."""
        low, high, less = self._down(low, high, symbol)
        shift = self.first[symbol] - self.begin[symbol]
        return low + shift, high + shift, less

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, symbol, low, high) for every symbol that stands before a pattern."""
        which, symbol = np.arange(len(low)), np.zeros(len(low), dtype=np.int64)
        for zeros in self.zeros:
            a, b = zeros[low], zeros[high]
            low, high = np.concatenate((a, zeros[-1] + low - a)), np.concatenate((b, zeros[-1] + high - b))
            which, symbol = np.concatenate((which, which)), np.concatenate((symbol << 1, symbol << 1 | 1))
            some = low < high
            which, symbol, low, high = which[some], symbol[some], low[some], high[some]
        shift = self.first[symbol] - self.begin[symbol]
        return which, symbol, low + shift, high + shift


@dataclass
class Found:
    """Pairs of a query and a word of the index, both by number."""

    query: np.ndarray
    word: np.ndarray


class WordIndex:
    """Words, told apart and in code-point order, with both reading directions."""

    CHUNK = 16384  # queries at a time

    def __init__(self, words: list[str]):
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        self.alphabet, symbols = np.unique(points, return_inverse=True)
        self.bits = (len(self.alphabet) + 1).bit_length()  # one symbol at least is left for strange letters
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.heads = np.cumsum(lengths + 1) - lengths - 1  # the delimiter before each word
        self.text = np.zeros(len(points) + len(words), dtype=np.int64)
        self.text[np.arange(len(points)) + np.repeat(np.arange(len(words)), lengths) + 1] = symbols + 1
        self.lengths = lengths
        self.forward, self.backward = Index(self.text, self.bits), Index(self.text[::-1].copy(), self.bits)
        self.place = {w: k for k, w in enumerate(words)}

    def _symbols(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points; a strange one gets a symbol that no word has."""
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at + 1, (1 << self.bits) - 1).astype(np.int64)

    def near(self, queries: list[str], side: str) -> Found:
        """All words one error away from a query that keep its left half, or for ``side`` right its right half only.

        The left half has length // 2 code points. Words that keep both halves, with the error between them, count as
        left. Every pair is found once.
        """
        parts = [self._chunk(queries[k : k + self.CHUNK], side, k) for k in range(0, len(queries), self.CHUNK)]
        none = np.empty(0, np.int64)
        return Found(*(np.concatenate([none, *(p[k] for p in parts)]) for k in range(2)))

    def _chunk(self, queries: list[str], side: str, offset: int) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, queries), np.int64, len(queries))
        left = lengths // 2
        points = np.frombuffer("".join(queries if side == "left" else [q[::-1] for q in queries]).encode("utf-32-le"), "<u4")
        flat = np.append(self._symbols(points), 0) if len(points) else np.zeros(1, np.int64)
        base = np.cumsum(lengths) - lengths
        half = left if side == "left" else lengths - left
        first, second = (self.forward, self.backward) if side == "left" else (self.backward, self.forward)
        own = np.fromiter((self.place.get(q, -1) for q in queries), np.int64, len(queries))

        low, high = self._match_half(first, flat, base, half)
        query, low, high, step = self._one_error(second, flat, base, half, lengths, low, high, (own >= 0).astype(np.int64))
        query, low = self._to_the_end(second, flat, base, lengths, query, low, high, step)
        head = second.starts[low]
        if side == "left":  # positions in the ring read backwards: the word before the delimiter
            word = np.searchsorted(self.heads, len(self.text) - 1 - head) - 1
            word %= len(self.heads)
        else:
            word = np.searchsorted(self.heads, head)
            keeps = np.ones(len(word), dtype=bool)
            begin = base + lengths  # in the reversed queries the left half is read from the end
            for k in range(int(left[query].max(initial=0))):
                look = np.flatnonzero(keeps & (k < left[query]))
                keeps[look] = self.text[(self.heads[word[look]] + 1 + k) % len(self.text)] == flat[begin[query[look]] - 1 - k]
            query, word = query[~keeps], word[~keeps]
        return query + offset, word

    def _match_half(self, first: Index, flat: np.ndarray, base: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals, in the other direction, of the delimiter and the exact half, which is read towards the delimiter."""
        low, high = np.zeros(len(half), np.int64), np.full(len(half), len(self.text), np.int64)
        other = low.copy()
        for k in range(int(half.max(initial=-1)) + 1):
            at = np.flatnonzero((k <= half) & (low < high))
            if not len(at):
                break
            symbol = np.where(k < half[at], flat[base[at] + np.maximum(half[at] - 1 - k, 0)], 0)
            low[at], high[at], less = first.extend(low[at], high[at], symbol)
            other[at] += less
        return other, other + np.maximum(high - low, 0)

    def _one_error(
        self, index: Index, flat: np.ndarray, base: np.ndarray, half: np.ndarray, lengths: np.ndarray,
        low: np.ndarray, high: np.ndarray, own: np.ndarray,
    ) -> tuple[np.ndarray, ...]:
        """(query, low, high, next place) for every error at every place of the other half.

        In a run of equal symbols the last one is deleted and a further one is put at its end, so no edit has two
        forms. A query whose only word left is itself is done.
        """
        out: list[tuple[np.ndarray, ...]] = []
        query, place = np.arange(len(half)), half.copy()
        while True:
            some = high - low > own[query]
            query, place, low, high = query[some], place[some], low[some], high[some]
            if not len(query):
                break
            inside = place < lengths[query]
            symbol = np.where(inside, flat[np.minimum(base[query] + place, len(flat) - 1)], 0)
            after = np.where(place + 1 < lengths[query], flat[np.minimum(base[query] + place + 1, len(flat) - 1)], 0)
            which, c, a, b = index.branches(low, high)
            new = (c != 0) & (c != symbol[which])
            which, a, b = which[new], a[new], b[new]
            out.append((query[which], a, b, place[which]))  # one symbol more
            changed = inside[which]
            out.append((query[which[changed]], a[changed], b[changed], place[which[changed]] + 1))  # another symbol
            less = inside & (symbol != after)
            out.append((query[less], low[less], high[less], place[less] + 1))  # one symbol less
            query, place, low, high, symbol = (x[inside] for x in (query, place, low, high, symbol))
            low, high, _ = index.extend(low, high, symbol)
            place = place + 1
        none = np.empty(0, np.int64)
        return tuple(np.concatenate([none, *(o[k] for o in out)]) for k in range(4))

    def _to_the_end(
        self, index: Index, flat: np.ndarray, base: np.ndarray, lengths: np.ndarray,
        query: np.ndarray, low: np.ndarray, high: np.ndarray, place: np.ndarray,
    ) -> tuple[np.ndarray, np.ndarray]:
        """(query, rank) of all patterns that go on exactly up to and with the delimiter."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(query):
            inside = place < lengths[query]
            symbol = np.where(inside, flat[np.minimum(base[query] + place, len(flat) - 1)], 0)
            low, high, _ = index.extend(low, high, symbol)
            some = low < high
            done.append((query[some & ~inside], low[some & ~inside]))
            query, low, high, place = (x[some & inside] for x in (query, low, high, place + 1))
        none = np.empty(0, np.int64)
        return tuple(np.concatenate([none, *(d[k] for d in done)]) for k in range(2))
