"""Language-model scores from a probabilistic suffix tree, next to unigram scores of the corpus.

The tree reads the bytes of the lower-cased words, each followed by a space, and an end sign. Spark counts every
(context, next byte) of the training texts, with contexts of DEPTH bytes; shorter contexts are sums over longer
ones. A context can become a state if it stands LEAST times in the training texts, however many these are, and does
if its next-byte distribution diverges from that of its suffix, or a longer context does. Distributions are smoothed
by that of the suffix (Witten-Bell), and a byte is scored by the state that is the longest suffix of what came before.

The counts of contexts are a table dealt into buckets by the last TOP + 1 bytes, so a bucket holds all longer contexts
of its own. Only contexts of up to TOP bytes, of which the alphabet allows 65,536, are gathered and
broadcast. Blocks of documents ask the buckets for the probabilities of their distinct (context, byte) keys and for the
counts of their distinct words (see ``exchange``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelog.llm.buffers import LOWER, SPACE, WordHash, Words, pieces, text_bytes, words
from lakelog.llm.exchange import block_of, count_blocks, free_name, in_order, split, unpack

DEPTH = 6
TOP = 2  # contexts of so many bytes and less are on the driver; a bucket has all contexts with the same TOP + 1 bytes
SHARE = 0.0  # least share of a context among all bytes: none, or states would go as other texts are added
LEAST = 10  # least count of a context
END = 0x0A  # never inside a word
END_WORD = np.uint64(0x5851F42D4C957F2D)  # the name of the end among word hashes
MOST_PAIRS = 1 << 20  # distinct (context, byte) pairs that a counting task holds
COUNTED_AT_ONCE = 2 << 20  # bytes of text; each takes some 100 bytes of memory while it is counted
RESULT = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


# ---- bytes in context

def symbols(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """The byte string of each row, with DEPTH end signs before it and one behind, and the row borders."""
    rows = len(found.first) - 1
    length = found.ends - found.starts + 1
    before = np.concatenate(([0], np.cumsum(length)))
    size = before[found.first[1:]] - before[found.first[:-1]] + DEPTH + 1
    borders = np.concatenate(([0], np.cumsum(size)))
    out = np.full(borders[-1], END, dtype=np.uint8)
    begin = borders[:-1][found.rows()] + DEPTH + before[:-1] - before[found.first[:-1]][found.rows()]
    if rows and len(found):
        shift = np.repeat(begin - found.starts, length - 1)
        source = np.repeat(found.starts - (before[:-1] - np.arange(len(found))), length - 1) + np.arange(len(shift))
        out[source + shift] = found.data[source]
        out[begin + length - 1] = 0x20
    return out, borders


def keys(text: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each scored byte its context, latest byte first, and the byte itself, as 56 bits; and its row."""
    key = np.zeros(max(0, len(text) - DEPTH), dtype=np.uint64)
    for back in range(1, DEPTH + 1):
        key = key << np.uint64(8) | text[DEPTH - back : len(text) - back]
    key = key << np.uint64(8) | text[DEPTH:]
    scored = np.ones(len(text), dtype=bool)
    for k in range(DEPTH):
        scored[borders[:-1] + k] = False
    row = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
    return key[scored[DEPTH:]], row[scored]


MIX = 0x9E3779, 0x85EBCB  # odd
UNMIX = tuple(pow(m, -1, 1 << 24) for m in MIX)


def _stirred(key: np.ndarray, by: tuple[int, int]) -> np.ndarray:
    """Keys with a one-to-one mix of their highest 24 bits, the last three bytes of the context."""
    low, high = np.uint64(0xFFFFFF), key >> np.uint64(32)
    high = high * np.uint64(by[0]) & low
    high ^= high >> np.uint64(12)
    return (high * np.uint64(by[1]) & low) << np.uint64(32) | key & np.uint64(0xFFFFFFFF)


def mixed(key: np.ndarray) -> np.ndarray:
    """Names of keys in 64 bits, of which equal ranges are equal buckets; contexts that share three bytes are neighbours."""
    return _stirred(key, MIX) << np.uint64(8)


def unmixed(name: np.ndarray) -> np.ndarray:
    return _stirred(name >> np.uint64(8), UNMIX[::-1])


def pack(ordered: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as the planes of the bytes of their steps, which compress well."""
    step = np.diff(ordered, prepend=np.uint64(0))
    return step.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a new value begins in a sorted array, and how often it stands there."""
    head = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.empty(0, np.int64)
    return head, np.diff(np.append(head, len(ordered)))


# ---- the tree

@dataclass
class SuffixTree:
    """States in the order of ``depth``, the root first, and their smoothed distributions."""

    edges: np.ndarray  # borders in the space of contexts
    state_at: np.ndarray  # the deepest state between two borders
    parent: np.ndarray
    escape: np.ndarray  # log10 of the weight that a state gives its parent
    entry: np.ndarray  # sorted state << 8 | byte
    log_p: np.ndarray
    holding: np.ndarray  # contexts of TOP bytes of which a longer one is a state

    def log_prob(self, key: np.ndarray) -> np.ndarray:
        """log10 probability of the byte in its context for 56-bit keys, fast if they are sorted."""
        state = self.state_at[np.searchsorted(self.edges, key >> np.uint64(8), side="right") - 1]
        byte = (key & np.uint64(255)).astype(np.int64)
        out = np.zeros(len(key))
        open_ = np.arange(len(key))
        while len(open_):
            code = state << 8 | byte[open_]
            at = np.minimum(np.searchsorted(self.entry, code), len(self.entry) - 1)
            hit = self.entry[at] == code
            out[open_[hit]] += self.log_p[at[hit]]
            open_, state = open_[~hit], state[~hit]
            out[open_] += self.escape[state]
            out[open_[state == 0]] -= np.log10(256)  # below the root all bytes are alike
            open_, state = open_[state > 0], self.parent[state[state > 0]]
        return out

    def score(self, found: Words) -> np.ndarray:
        """log10 probability of each row."""
        out = np.zeros(len(found.first) - 1)
        text, borders = symbols(found)
        for low in range(0, len(out), 256):  # eight bits are left for the row
            high = min(low + 256, len(out))
            key, row = keys(text[borders[low] : borders[high]], borders[low : high + 1] - borders[low])
            ordered = np.sort(key << np.uint64(8) | row.astype(np.uint64))
            head, count = _runs(ordered)
            pair = ordered[head]
            new, times = _runs(pair >> np.uint64(8))
            value = np.repeat(self.log_prob(pair[new] >> np.uint64(8)), times)
            own = (pair & np.uint64(255)).astype(np.int64)
            out[low:high] = np.bincount(own, weights=value * count, minlength=high - low)
        return out


def build(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], held: np.ndarray | None = None) -> SuffixTree:
    """The tree from counts: for each context length the contexts, bytes and counts of frequent contexts.

    A context stays if its count times its divergence from its suffix exceeds the description length of its
    distribution, half a logarithm of the count for each byte, or if a longer one stays. ``held`` are contexts of
    TOP bytes that stay for longer ones that are not among ``levels``.
    """
    contexts, totals, starts, kept = [], [], [], []
    for d, (context, byte, count) in enumerate(levels):
        order = np.lexsort((byte, context))
        levels[d] = context, byte, count = context[order], byte[order], count[order].astype(float)
        head, _ = _runs(context)
        contexts.append(context[head])
        starts.append(head)
        totals.append(np.add.reduceat(count, head) if len(head) else np.empty(0))
        kept.append(np.zeros(len(head), dtype=bool))

    def group(d: int) -> np.ndarray:
        return np.repeat(np.arange(len(starts[d])), np.diff(np.append(starts[d], len(levels[d][0]))))

    up = [np.zeros(len(contexts[d]), np.int64) if d == 0 else np.searchsorted(contexts[d - 1], contexts[d] >> np.uint64(8))
          for d in range(len(levels))]
    if held is not None:
        kept[TOP] |= np.isin(contexts[TOP], held)
    for d in range(len(levels) - 1, 0, -1):
        if not len(contexts[d]):
            continue
        own = group(d)
        _, byte, count = levels[d]
        above = levels[d - 1][0] << np.uint64(8) | levels[d - 1][1].astype(np.uint64)
        mine = contexts[d - 1][up[d]][own] << np.uint64(8) | byte.astype(np.uint64)
        shorter = levels[d - 1][2][np.searchsorted(above, mine)] / totals[d - 1][up[d]][own]
        gain = np.add.reduceat(count * np.log(count / totals[d][own] / shorter), starts[d])
        seen = np.diff(np.append(starts[d], len(count)))
        kept[d] |= gain > 0.5 * seen * np.log(totals[d])
        kept[d - 1][up[d][kept[d]]] = True

    if len(kept[0]):
        kept[0][:] = True
    number, states = [], 0
    for d in range(len(levels)):
        number.append(np.where(kept[d], states + np.cumsum(kept[d]) - 1, -1))
        states += int(kept[d].sum())
    parent, escape = np.zeros(max(1, states), np.int64), np.zeros(max(1, states))
    entry, log_p, edges = [], [], [np.zeros(1, np.uint64)]
    previous: tuple[np.ndarray, np.ndarray] | None = None
    for d, (_, byte, count) in enumerate(levels):
        if not kept[d].any():
            break
        own = group(d)
        stays = kept[d][own]
        own, byte, count = own[stays], byte[stays].astype(np.int64), count[stays]
        state = number[d][own]
        seen = np.bincount(own, minlength=len(kept[d]))[own]
        if d:
            parent[number[d][kept[d]]] = number[d - 1][up[d][kept[d]]]
            code = parent[state] << 8 | byte
            below = previous[1][np.searchsorted(previous[0], code)]
        else:
            below = np.full(len(own), 1 / 256)
        p = (count + seen * below) / (totals[d][own] + seen)
        escape[state] = np.log10(seen / (totals[d][own] + seen))
        previous = (state << 8 | byte, p)
        entry.append(previous[0])
        log_p.append(np.log10(p))
        shift = np.uint64(8 * (DEPTH - d))
        first = contexts[d][kept[d]]
        edges += [first << shift, (first + np.uint64(1)) << shift]
    borders = np.unique(np.concatenate(edges))
    state_at = np.zeros(len(borders), dtype=np.int64)
    for d in range(1, len(levels)):
        shift = np.uint64(8 * (DEPTH - d))
        first = contexts[d][kept[d]]
        low, high = (np.searchsorted(borders, x << shift) for x in (first, first + np.uint64(1)))
        at = np.repeat(low - np.concatenate(([0], np.cumsum(high - low)[:-1])), high - low) + np.arange((high - low).sum())
        state_at[at] = np.repeat(number[d][kept[d]], high - low)
    holding = np.unique(contexts[TOP + 1][kept[TOP + 1]] >> np.uint64(8)) if len(levels) > TOP + 1 else np.empty(0, np.uint64)
    if not entry:  # nothing was learned: all bytes are alike
        return SuffixTree(borders, state_at, parent, escape, np.array([-1]), np.zeros(1), holding)
    return SuffixTree(borders, state_at, parent, escape, np.concatenate(entry), np.concatenate(log_p), holding)


# ---- counts of contexts, by bucket

COUNTED = "bucket int, keys binary, counts binary"
LEVELS = "bucket int, depth int, pairs binary, counts binary"


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    order = np.argsort(key, kind="stable")
    head, _ = _runs(key[order])
    return key[order][head], np.add.reduceat(n[order], head) if len(head) else np.empty(0, np.int64)


def _shorter(pair: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From counts of context << 8 | byte those with contexts that are one byte shorter."""
    return _summed(pair >> np.uint64(16) << np.uint64(8) | pair & np.uint64(255), n)


def _frequent(pair: np.ndarray, n: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose context stands at least ``bound`` times."""
    head, size = _runs(pair >> np.uint64(8))
    if not len(head):
        return pair, n
    stays = np.repeat(np.add.reduceat(n, head) >= bound, size)
    return pair[stays], n[stays]


def _level(pair: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return pair >> np.uint64(8), (pair & np.uint64(255)).astype(np.uint8), n


def _count(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, keys, counts): how often each byte follows each context of DEPTH bytes, in parts."""

    def parts(name: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        filled, borders = split(name, buckets)
        cut = [slice(borders[b], borders[b + 1]) for b in filled]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(filled, pa.int32()),
                pa.array([pack(name[c]) for c in cut], pa.binary()),
                pa.array([n[c].tobytes() for c in cut], pa.binary()),
            ],
            ["bucket", "keys", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_n = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            for piece in pieces(batch, "text", COUNTED_AT_ONCE):
                data, borders = text_bytes(piece.column("text"))
                key, _ = keys(*symbols(words(LOWER[data], borders, SPACE)))
                ordered = np.sort(mixed(key))
                head, n = _runs(ordered)
                held_key, held_n = _summed(np.concatenate((held_key, ordered[head])), np.concatenate((held_n, n)))
                if len(held_key) > MOST_PAIRS:
                    yield parts(held_key, held_n)
                    held_key, held_n = np.empty(0, np.uint64), np.empty(0, np.int64)
        yield parts(held_key, held_n)

    return docs.mapInArrow(run, COUNTED)


def _levels(least: int):
    """A function that sums the parts of a bucket: a row for each context length, TOP with parts of all its counts."""

    def run(rows: pa.Table) -> pa.Table:
        name = np.concatenate([unpacked(x) for x in rows.column("keys").to_pylist()])
        n, _ = unpack(rows.column("counts"), "<i8")
        name, n = _summed(name, n)
        pair = unmixed(name)
        made = []
        for d in range(DEPTH, TOP - 1, -1):
            if d < DEPTH:
                pair, n = _shorter(pair, n)
            else:
                pair, n = _summed(pair, n)
            own = _frequent(pair, n, least) if d > TOP else (pair, n)
            made.append((d, pack(own[0]), own[1].tobytes()))
        depth, packed, counts = zip(*made, strict=True)
        bucket = pa.array([rows.column("bucket")[0].as_py()] * len(made), pa.int32())
        return pa.table(
            {"bucket": bucket, "depth": pa.array(depth, pa.int32()), "pairs": pa.array(packed, pa.binary()), "counts": pa.array(counts, pa.binary())}
        )

    return run


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed, counts in zip(batch.column("pairs").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(unpacked(packed).astype(np.int64)), pa.array(np.frombuffer(counts, np.int64))], ["pair", "n"])


@dataclass
class Top:
    """What every bucket needs besides its own counts: those of contexts of up to TOP bytes, and which of these stay."""

    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    bound: float
    held: np.ndarray | None = None

    def tree(self, rows: pa.Table | pa.RecordBatch) -> SuffixTree:
        """The tree over ``rows`` of the table of levels, which hold whole buckets."""
        own = []
        for d in range(TOP + 1, DEPTH + 1):
            mine = rows.filter(pa.compute.equal(rows.column("depth"), d))
            found = [unpacked(x) for x in mine.column("pairs").to_pylist()]
            counts = [np.frombuffer(x, np.int64) for x in mine.column("counts").to_pylist()]
            pair, n = np.concatenate([np.empty(0, np.uint64), *found]), np.concatenate([np.empty(0, np.int64), *counts])
            own.append(_level(*_frequent(*_summed(pair, n), self.bound)))
        return build([*self.levels, *own], self.held)


@dataclass
class Model:
    """A fitted tree: a table of counts by bucket and context length, and the short contexts."""

    table: DataFrame
    buckets: int
    top: Top

    @cached_property
    def whole(self) -> SuffixTree:
        """All of the tree in the driver, for a look at a small one; ``score`` does without."""
        return self.top.tree(self.table.where(F.col("depth") > TOP).toArrow())

    @property
    def parent(self) -> np.ndarray:
        return self.whole.parent

    def log_prob(self, key: np.ndarray) -> np.ndarray:
        return self.whole.log_prob(key)

    def score(self, found: Words) -> np.ndarray:
        return self.whole.score(found)


def fit(docs: DataFrame, text_col: str = "text", share: float = SHARE, least: int = LEAST) -> Model:
    """Count all texts of ``docs`` and grow the tree; null texts are empty ones, and no rows give the uniform model."""
    from lakelog.llm.common import stored

    buckets = max(1, count_blocks(docs, text_col) // 3)
    counted = _count(docs.select(docs[f"`{text_col}`"].alias("text")), buckets)
    table = stored(counted.groupBy("bucket").applyInArrow(_levels(least), LEVELS), "byte-contexts")
    short = table.where(F.col("depth") == TOP).mapInArrow(_rows_of, "pair long, n long")
    rows = short.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pair, n = _summed(rows.column("pair").to_numpy().astype(np.uint64), rows.column("n").to_numpy())
    bound = max(least, share * int(n.sum()))
    levels = []
    for d in range(TOP, -1, -1):
        levels.append(_level(*(_frequent(pair, n, bound) if d else (pair, n))))
        pair, n = _shorter(pair, n)
    top = Top(levels[::-1], bound)
    shared = docs.sparkSession.sparkContext.broadcast(top)

    def holding(rows: pa.Table) -> pa.Table:
        return pa.table({"context": pa.array(shared.value.tree(rows).holding.astype(np.int64))})

    held = table.groupBy("bucket").applyInArrow(holding, "context long").distinct().toArrow()
    return Model(table, buckets, Top(top.levels, bound, held.column("context").to_numpy().astype(np.uint64)))


# ---- questions of blocks: counts of words, probabilities of bytes

ASKED = "bucket int, block int, keys binary, counts binary"
TOLD = "block int, bucket int, counts binary, tokens long, kinds long"


class Block:
    """Words and bytes of one block of documents; an end follows the words of each.

    Words ask the first ``buckets`` buckets, bytes the ``deep`` ones behind them.
    """

    def __init__(self, rows: pa.Table, text_col: str, train_col: str, order_col: str, buckets: int, deep: int):
        self.rows = in_order(rows, order_col, text_col)
        data, borders = text_bytes(self.rows.column(text_col))
        self.found = words(LOWER[data], borders, SPACE)
        count = len(self.found.first) - 1
        token = np.concatenate((WordHash(2)(self.found), np.full(count, END_WORD)))
        self.row = np.concatenate((self.found.rows(), np.arange(count)))
        self.keys, self.at = np.unique(token, return_inverse=True)
        self.train = self.rows.column(train_col).to_numpy().astype(bool)
        self.filled, self.borders = split(self.keys, buckets)
        self.buckets, self.deep = buckets, deep

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """The name of each (context, byte) in the texts, and its row."""
        key, row = keys(*symbols(self.found))
        return mixed(key), row

    def ask(self, block: int) -> pa.Table:
        n = np.bincount(self.at, weights=self.train[self.row], minlength=len(self.keys)).astype(np.int64)
        cut = [slice(self.borders[b], self.borders[b + 1]) for b in self.filled]
        name = np.sort(self.names()[0])
        name = name[_runs(name)[0]]
        filled, borders = split(name, self.deep)
        deep = [pack(name[borders[b] : borders[b + 1]]) for b in filled]
        return pa.table(
            {
                "bucket": pa.array(np.concatenate((self.filled, self.buckets + filled)), pa.int32()),
                "block": pa.array(np.full(len(cut) + len(deep), block), pa.int32()),
                "keys": pa.array([self.keys[c].tobytes() for c in cut] + deep, pa.binary()),
                "counts": pa.array([n[c].tobytes() for c in cut] + [None] * len(deep), pa.binary()),
            }
        )

    def scores(self, told: pa.Table) -> tuple[np.ndarray, np.ndarray, int, np.ndarray, np.ndarray]:
        """Tokens and known tokens of each row, the tokens of the corpus, base score and score of each row."""
        c = np.zeros(len(self.keys))
        total = kinds = 0
        named, own = self.names()
        name = np.sort(named)
        name = name[_runs(name)[0]]
        value, (_, borders) = np.zeros(len(name)), split(name, self.deep)
        for b, raw, n, v in zip(*(told.column(x).to_pylist() for x in ("bucket", "counts", "tokens", "kinds")), strict=True):
            if b < 0:
                total, kinds = n or 0, v or 0
            elif b >= self.buckets:
                value[borders[b - self.buckets] : borders[b - self.buckets + 1]] = np.frombuffer(raw, np.float32)
            else:
                c[self.borders[b] : self.borders[b + 1]] = np.frombuffer(raw, np.int64)
        rows = len(self.train)
        one = np.log10((c + 0.5) / (total + 0.5 * (kinds + 1)))
        sums = lambda x: np.bincount(self.row, weights=x[self.at], minlength=rows)
        score = np.zeros(rows)
        for low in range(0, rows, 256):  # the eight lowest bits of a name are free for the row
            a, b = np.searchsorted(own, (low, low + 256))
            ordered = np.sort(named[a:b] | (own[a:b] - low).astype(np.uint64))
            head, count = _runs(ordered)
            pair = ordered[head]
            new, times = _runs(pair >> np.uint64(8))
            one_of = np.repeat(value[np.searchsorted(name, pair[new] & ~np.uint64(255))], times)
            row = (pair & np.uint64(255)).astype(np.int64)
            score[low : low + 256] = np.bincount(row, weights=one_of * count, minlength=min(256, rows - low))
        return np.bincount(self.row, minlength=rows), sums(c > 0).astype(np.int64), total, sums(one), score


def _answer(rows: pa.Table) -> pa.Table:
    keys_, borders = unpack(rows.column("keys"), "<u8")
    n, _ = unpack(rows.column("counts"), "<i8")
    kinds, at = np.unique(keys_, return_inverse=True)
    c = np.bincount(at, weights=n, minlength=len(kinds)).astype(np.int64)
    own = np.zeros(rows.num_rows, np.int64)
    own[0] = 1  # the totals of a bucket stand in one of its rows
    return pa.table(
        {
            "block": rows.column("block"),
            "bucket": rows.column("bucket"),
            "counts": pa.array([c[at[a:b]].tobytes() for a, b in zip(borders[:-1], borders[1:], strict=True)], pa.binary()),
            "tokens": pa.array(own * c.sum()),
            "kinds": pa.array(own * (c > 0).sum()),
        }
    )


def _probabilities(rows: pa.Table, tree: SuffixTree) -> pa.Table:
    """The log10 probabilities of all keys that blocks ask for, in single precision on their way back."""
    asked = [unpacked(x) for x in rows.column("keys").to_pylist()]
    name = np.sort(np.concatenate(asked))
    name = name[_runs(name)[0]]
    value = tree.log_prob(unmixed(name)).astype(np.float32)
    return pa.table(
        {
            "block": rows.column("block"),
            "bucket": rows.column("bucket"),
            "counts": pa.array([value[np.searchsorted(name, own)].tobytes() for own in asked], pa.binary()),
            "tokens": pa.nulls(len(asked), pa.int64()),
            "kinds": pa.nulls(len(asked), pa.int64()),
        }
    )


def score(docs: DataFrame, tree: Model, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns of ``docs`` but the text, with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Tokens are the words (A-Z in lower case, cut at white space) and an end; word counts come from the rows for which
    ``train`` is true. ``base_score`` is the unigram score with half a count added, ``score`` the log10 probability
    of the text by the tree. A null text is empty: only the end is scored. Rows are counted and scored one by one,
    whatever their id. Words are told apart by 64-bit hashes. Columns of ``docs`` with the names of results are
    replaced.
    """
    kept = [f for f in docs.schema.fields if f.name not in (text_col, *RESULT)]
    docs = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text_col}`"), train.alias(free_name(docs, "train")))
    train_col, key = docs.columns[-1], free_name(docs, "block")
    blocks = count_blocks(docs, text_col)
    buckets = max(1, blocks // 3)
    dealt = docs.withColumn(train_col, F.coalesce(F.col(train_col), F.lit(False)))
    by_block = dealt.withColumn(key, block_of(docs, id_col, text_col, blocks)).groupBy(key)
    deep = tree.buckets
    shared = docs.sparkSession.sparkContext.broadcast(tree.top)

    def ask(rows: pa.Table) -> pa.Table:
        return Block(rows, text_col, train_col, id_col, buckets, deep).ask(rows.column(key)[0].as_py())

    def answer(rows: pa.Table, levels: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _nothing(told_schema)
        rows = rows.combine_chunks()
        if rows.column("bucket")[0].as_py() < buckets:
            return _answer(rows)
        return _probabilities(rows, shared.value.tree(levels))

    def totals(rows: pa.Table) -> pa.Table:
        if rows.column("bucket")[0].as_py() >= buckets:
            return pa.table({"tokens": pa.array([], pa.int64()), "kinds": pa.array([], pa.int64())})
        return _answer(rows).select(["tokens", "kinds"])

    def finish(rows: pa.Table, told: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _nothing(schema)
        block = Block(rows, text_col, train_col, id_col, buckets, deep)
        n, known, total, base, deep_score = block.scores(told)
        made = [pa.array(n), pa.array(known), pa.array(np.full(len(n), total)), pa.array(base)]
        return pa.Table.from_arrays(
            [*(block.rows.column(f.name) for f in kept), *made, pa.array(deep_score)],
            [f.name for f in schema],
        )

    told_schema = T.StructType.fromDDL(TOLD)
    asked = by_block.applyInArrow(ask, ASKED).groupBy("bucket")
    levels = tree.table.select((F.col("bucket") + buckets).alias("bucket"), "depth", "pairs", "counts").where(F.col("depth") > TOP)
    told = asked.cogroup(levels.groupBy("bucket")).applyInArrow(answer, TOLD)
    sums = asked.applyInArrow(totals, "tokens long, kinds long").agg(F.sum("tokens").alias("tokens"), F.sum("kinds").alias("kinds")).select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.lit(-1).alias("bucket"),
        F.lit(None).cast("binary").alias("counts"),
        "tokens",
        "kinds",
    )
    kinds = (T.LongType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType())
    schema = T.StructType([*kept, *(T.StructField(n, k) for n, k in zip(RESULT, kinds, strict=True))])
    return by_block.cogroup(told.unionByName(sums).groupBy("block")).applyInArrow(finish, schema)


def _nothing(schema: T.StructType) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema).empty_table()
