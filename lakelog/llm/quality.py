"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins. Cyclic boosting fits shallow trees to one feature after the other, and all trees of a
feature add up to one lookup table; the strongest pairs of features then get tables over their joint bins. The
score of a text is the logistic of a sum of table entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelog.llm.buffers import LOWER, SPACE, WordHash, pieces, text_bytes, words

FEATURES = (
    "log_bytes", "log_words", "word_length", "upper_share", "digit_share", "sign_share", "high_share", "space_share",
    "distinct_share", "top_share", "repeat_share", "line_length", "line_repeats", "short_share", "sign_end_share",
    "entropy",
)
BINS, COARSE = 32, 8
SAMPLE = 20_000  # bound of the labelled rows that are fitted
PIECE = 4 << 20


def _shares(flag: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """The share of true flags in each row."""
    sums = np.concatenate(([0], np.cumsum(flag)))[borders]
    return np.diff(sums) / np.maximum(np.diff(borders), 1)


def _distinct(hashes: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row how many different hashes it has, and how often the most frequent one occurs."""
    distinct, top = np.zeros(rows), np.zeros(rows)
    if len(hashes):
        order = np.lexsort((hashes, row))
        h, r = hashes[order], row[order]
        head = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (r[1:] != r[:-1]))))
        run = np.diff(np.append(head, len(h)))
        distinct = np.bincount(r[head], minlength=rows).astype(float)
        np.maximum.at(top, r[head], run)
    return distinct, top


def features(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES for each text; an empty or null text has zeros."""
    data, borders = text_bytes(texts)
    rows = len(texts)
    found = words(data, borders, SPACE)
    row, counts = found.rows(), np.diff(found.first)
    hashes = WordHash(7)(words(LOWER[data], borders, SPACE)) if len(found) else np.empty(0, np.uint64)
    length = (found.ends - found.starts).astype(float)
    sums = lambda x: np.bincount(row, weights=x, minlength=rows)[:rows] if len(row) else np.zeros(rows)
    per_word = np.maximum(counts, 1)
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    digit, high = (data >= 48) & (data <= 57), data >= 128
    blank = SPACE[data]
    sign = ~(upper | lower | digit | high | blank)
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    distinct, top = _distinct(hashes, row, rows)

    line = np.zeros(256, dtype=bool)
    line[10] = True
    lines = words(data, borders, line)
    line_count = np.diff(lines.first)
    line_distinct, _ = _distinct(WordHash(7)(lines) if len(lines) else np.empty(0, np.uint64), lines.rows(), rows)

    entropy = np.zeros(rows)
    for r in range(rows):
        n = np.bincount(data[borders[r] : borders[r + 1]], minlength=1)
        p = n[n > 0] / max(1, n.sum())
        entropy[r] = -(p * np.log2(p)).sum()
    size = np.diff(borders)
    upper_of = _shares(upper, borders) / np.maximum(_shares(upper | lower, borders), 1e-9)
    columns = (
        np.log1p(size), np.log1p(counts), sums(length) / per_word, upper_of, _shares(digit, borders),
        _shares(sign, borders), _shares(high, borders), _shares(blank, borders), distinct / per_word, top / per_word,
        sums(same) / per_word, np.log1p(size / np.maximum(line_count, 1)),
        1 - line_distinct / np.maximum(line_count, 1), sums(length <= 2) / per_word,
        sums(sign[found.ends - 1]) / per_word, entropy,
    )
    out = np.stack(columns, axis=1)
    out[size == 0] = 0
    return out


@dataclass
class AdditiveModel:
    """Bin borders and lookup tables of single features and of pairs."""

    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(self.cuts)], axis=1)

    def margin(self, b: np.ndarray) -> np.ndarray:
        out = np.full(len(b), self.base)
        for k, table in enumerate(self.tables):
            out += table[b[:, k]]
        for (i, j), table in self.pairs.items():
            out += table[b[:, i] * COARSE // BINS, b[:, j] * COARSE // BINS]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(self.bins(x))))


RIDGE, LEAST = 1.0, 5.0  # regularisation, and the least weight (sum of p(1-p)) of a leaf is LEAST / 20


def _leaf(g: np.ndarray, h: np.ndarray) -> float:
    return -g.sum() / (h.sum() + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray) -> int | None:
    """Where to cut a histogram in two, if that gains anything."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(gl):
        return None
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    gain[(hl < LEAST / 20) | (hr < LEAST / 20)] = -1
    best = int(gain.argmax())
    return best + 1 if gain[best] > 1e-9 else None


def _tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Leaf values of a shallow tree over the bins of one feature."""
    cut = _best_cut(g, h) if depth else None
    if cut is None:
        return np.full(len(g), _leaf(g, h))
    return np.concatenate((_tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)))


def _pair_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A cut along the first feature, and one along the second on either side."""
    out = np.empty_like(g)
    cut = _best_cut(g.sum(axis=1), h.sum(axis=1)) or len(g) // 2
    for part in (slice(None, cut), slice(cut, None)):
        out[part] = _tree(g[part].sum(axis=0), h[part].sum(axis=0), 1)
    return out


def _gain(table: np.ndarray, g: np.ndarray, h: np.ndarray) -> float:
    return float(-(table * g + table**2 * (h / 2)).sum())


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.15, most_pairs: int = 6) -> AdditiveModel:
    """Fit the model to features ``x`` and labels ``y`` (0 or 1)."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
    share = min(max(float(y.mean()) if len(y) else 0.5, 0.01), 0.99)
    model = AdditiveModel(float(np.log(share / (1 - share))), cuts, [np.zeros(BINS) for _ in cuts])
    if not len(y):
        return model
    b = model.bins(x)
    margin = model.margin(b)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for k in range(b.shape[1]):
            g, h = slopes()
            step = rate * _tree(*(np.bincount(b[:, k], weights=v, minlength=BINS) for v in (g, h)), 2)
            model.tables[k] += step
            margin += step[b[:, k]]
    coarse = b * COARSE // BINS

    def joint(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = coarse[:, i] * COARSE + coarse[:, j]
        g, h = (np.bincount(at, weights=v, minlength=COARSE**2).reshape(COARSE, COARSE) for v in slopes())
        return at, g, h

    strength = {}
    for i, j in combinations(range(b.shape[1]), 2):
        _, g, h = joint(i, j)
        strength[i, j] = _gain(_pair_tree(g, h), g, h)
    chosen = sorted(strength, key=strength.get, reverse=True)[:most_pairs]
    model.pairs = {p: np.zeros((COARSE, COARSE)) for p in chosen}
    for _ in range(rounds // 2):
        for p in chosen:
            at, g, h = joint(*p)
            step = rate * _pair_tree(g, h)
            model.pairs[p] += step
            margin += step.ravel()[at]
    return model


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample: int = SAMPLE,
) -> AdditiveModel:
    """Learn from ``labels`` (id, 0 or 1) of documents in ``docs``, at most ``sample`` of them, the first by a hash of the id.

    Labels that are null or belong to no document teach nothing. Equal labels of an id count once, different ones once
    each, and of several texts under one id one is learned from, so however often an id stands in either table, no more
    than ``sample`` rows are gathered. Without any label the score is one half everywhere.
    """
    known = labels.select(labels[f"`{id_col}`"].alias("id"), labels[f"`{label_col}`"].cast("double").alias("y"))
    known = known.where("id is not null and y in (0, 1)").distinct()
    order = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1 << 40))
    share = 1.25 * sample / max(sample, known.count())  # a few more, so that seldom less are left
    drawn = known.where(order < int(share * (1 << 40))).orderBy(order, "id", "y").limit(sample)
    texts = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text_col}`"].alias("text"))
    texts = texts.join(F.broadcast(drawn), "id").groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = describe(texts, keep_text=False).orderBy("id", "y").toArrow()
    x = np.array(rows.column("features").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    return boost(x, rows.column("y").to_numpy())


def _apply(docs: DataFrame, text_col: str, results: dict[str, T.DataType], keep_text: bool, compute) -> DataFrame:
    kept = [f for f in docs.schema.fields if f.name not in results and (keep_text or f.name != text_col)]
    schema = T.StructType([*kept, *(T.StructField(n, k) for n, k in results.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text_col, PIECE):
                made = compute(piece.column(text_col))
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(f.name) for f in kept), *made], [f.name for f in schema]
                )

    return docs.mapInArrow(run, schema)


def describe(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Columns of ``docs`` with ``features``, in the order of FEATURES."""
    return _apply(
        docs, text_col, {"features": T.ArrayType(T.DoubleType())}, keep_text,
        lambda texts: [pa.array(list(features(texts)), pa.list_(pa.float64()))],
    )


def score(docs: DataFrame, model: AdditiveModel, text_col: str = "text", cut: float = 0.3, keep_text: bool = True) -> DataFrame:
    """Columns of ``docs`` with ``score`` (0 to 1, higher is better) and ``predicted`` (1 if it is at least ``cut``).

    Whole texts are read; null and empty ones have a score as well. Rows are independent; columns of ``docs`` with
    the names of results are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(texts: pa.Array) -> list[pa.Array]:
        p = shared.value.score(features(texts))
        return [pa.array(p), pa.array((p >= cut).astype(np.int32))]

    return _apply(docs, text_col, {"score": T.DoubleType(), "predicted": T.IntegerType()}, keep_text, compute)
