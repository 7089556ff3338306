"""Recompression of word sequences: rounds that name runs and pairs by content.

A round first replaces each run of equal symbols by one symbol, then each pair of neighbours whose first symbol
is a *left* and whose second is a *right* one; a bit of the name, drawn anew in each round, tells the two. Names
are 64-bit hashes of what they replace, so equal content has equal names in all documents and no dictionary has to
travel between tasks.

For every symbol the words are known on which its existence depends: if those words stand in another place, so
does the symbol. A symbol whose dependencies lie inside a window is therefore *interior* to it, and occurs with
every occurrence of the window.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from lakelog.llm.buffers import mix

PAIR, RUN, SIDE = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


@dataclass
class Symbols:
    """Names with the words [start, end) they stand for and the words [low, high] they depend on."""

    name: np.ndarray
    start: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray
    row: np.ndarray

    def take(self, index: np.ndarray) -> Symbols:
        return Symbols(*(getattr(self, f)[index] for f in self.__dataclass_fields__))


def letters(names: np.ndarray, row: np.ndarray) -> Symbols:
    """One symbol for each word."""
    at = np.arange(len(names))
    return Symbols(names, at, at + 1, at.copy(), at.copy(), row)


def _runs(s: Symbols, word: np.ndarray) -> Symbols:
    """Maximal runs of equal symbols as one symbol each.

    That a symbol has no equal neighbour is seen from one word on either side, unless that word is also the one
    with which an equal neighbour would have to end or begin.
    """
    head = np.ones(len(s.name), dtype=bool)
    head[1:] = (s.name[1:] != s.name[:-1]) | (s.row[1:] != s.row[:-1])
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(s.name)) - 1
    count = (last - first + 1).astype(np.uint64)
    name = np.where(count > 1, mix(s.name[first] * RUN + count), s.name[first])
    low = np.minimum.reduceat(s.low, first)
    high = np.maximum.reduceat(s.high, first)
    start, end = s.start[first], s.end[last]
    inner = np.flatnonzero(s.row[first[1:]] == s.row[first[:-1]])  # groups with a right neighbour in their row
    side = end[inner]
    close = word[side - 1] == word[s.end[first[inner + 1]] - 1]  # left neighbour might end like the right one
    low_in = np.where(close, low[inner], side - 1)
    begin = word[side] == word[s.start[last[inner]]]
    high_in = np.where(begin, high[inner + 1], side)
    out_low, out_high = low.copy(), high.copy()
    edge = np.ones(len(first), dtype=bool)
    edge[inner + 1] = False
    out_low[inner + 1] = np.minimum(low[inner + 1], low_in)
    out_low[edge] = np.minimum(out_low[edge], start[edge] - 1)  # beyond the row: never interior
    edge = np.ones(len(first), dtype=bool)
    edge[inner] = False
    out_high[inner] = np.maximum(high[inner], high_in)
    out_high[edge] = np.maximum(out_high[edge], end[edge])
    return Symbols(name, start, end, out_low, out_high, s.row[first])


def _pairs(s: Symbols, turn: int) -> Symbols:
    """Left-right neighbours as one symbol each; others stay, which depends on the neighbour they might have had."""
    side = np.uint64(int(SIDE) * (turn + 1) % 2**64)
    left = (mix(s.name + side) & np.uint64(1)).astype(bool)
    same = s.row[1:] == s.row[:-1]
    joined = np.flatnonzero(left[:-1] & ~left[1:] & same)
    name, end, low, high = s.name.copy(), s.end.copy(), s.low.copy(), s.high.copy()
    name[joined] = mix(s.name[joined] * PAIR + s.name[joined + 1])
    end[joined] = s.end[joined + 1]
    single = np.ones(len(name), dtype=bool)
    single[joined] = single[joined + 1] = False
    to_right = np.flatnonzero(single[:-1] & left[:-1] & same)
    low[to_right] = np.minimum(low[to_right], s.low[to_right + 1])
    high[to_right] = np.maximum(high[to_right], s.high[to_right + 1])
    to_left = np.flatnonzero(single[1:] & ~left[1:] & same) + 1
    low[to_left] = np.minimum(low[to_left], s.low[to_left - 1])
    high[to_left] = np.maximum(high[to_left], s.high[to_left - 1])
    low[joined] = np.minimum(s.low[joined], s.low[joined + 1])
    high[joined] = np.maximum(s.high[joined], s.high[joined + 1])
    keep = np.ones(len(name), dtype=bool)
    keep[joined + 1] = False
    return Symbols(name[keep], s.start[keep], end[keep], low[keep], high[keep], s.row[keep])


def recompress(names: np.ndarray, row: np.ndarray, rounds: int) -> Symbols:
    """Symbols after some rounds over the words of rows that lie one after the other."""
    s = letters(names, row)
    for turn in range(rounds if len(names) else 0):
        s = _pairs(_runs(s, names), turn)
    return s
