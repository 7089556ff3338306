"""Language identification: averaged embeddings of hashed subwords under a linear softmax.

Subwords are the byte n-grams of a text in which A-Z is lower case and every ASCII byte that is no letter is a
word border. Averaging and the softmax layer are linear, so for prediction embeddings and weights are multiplied out
to one row of class scores for each bucket: a text's score is the mean of the rows of its subwords.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelog.llm.buffers import pieces, text_bytes

SIZES = (2, 3, 4)
BUCKETS = 1 << 15
DIMENSIONS = 16
DOCS_PER_LANG = 600  # bound of the distinct texts that are fitted; half of them calibrate
MOST_LANGS = 1000  # bound of the languages that are learned
PIECE = 2 << 20
UNKNOWN = "und"

BORDER = np.full(256, 0x20, dtype=np.uint8)
BORDER[0x61:0x7B] = np.arange(0x61, 0x7B)
BORDER[0x41:0x5B] = np.arange(0x61, 0x7B)
BORDER[0x80:] = np.arange(0x80, 0x100)
LETTER = regex.compile(r"\p{L}")


def subwords(data: np.ndarray, borders: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size the buckets of all n-grams and the row borders in them."""
    text = BORDER[data]
    blank = text == 0x20
    for size in SIZES:
        count = max(0, len(text) - size + 1)
        value = np.full(count, size, dtype=np.uint64)
        for k in range(size):
            value = value << np.uint64(8) | text[k : k + count]
        fits = np.ones(count, dtype=bool)
        for end in borders[1:-1]:  # n-grams that run into the next row
            fits[max(0, end - size + 1) : end] = False
        for k in range(size - 1):  # at most one border at either end
            fits &= ~(blank[k : k + count] & blank[k + 1 : k + 1 + count])
        at = np.flatnonzero(fits)
        bucket = (value[at] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 15)).astype(np.int64)
        yield bucket, np.searchsorted(at, borders)


def row_sums(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Sum of the values of each row; zero for rows without values."""
    out = np.zeros((len(borders) - 1, values.shape[1]))
    filled = np.flatnonzero(np.diff(borders))
    if len(filled):
        out[filled] = np.add.reduceat(values, borders[filled], axis=0, dtype=np.float64)
    return out


@dataclass
class LanguageModel:
    """Class scores per bucket, a temperature and the confidence below which a text is rejected."""

    labels: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """The label of each text and its calibrated probability; ``und`` and 0 without a letter."""
        data, borders = text_bytes(texts)
        sums, count = np.zeros((len(texts), len(self.labels))), np.zeros(len(texts))
        for bucket, own in subwords(data, borders):
            sums += row_sums(self.table[bucket], own)
            count += np.diff(own)
        p = softmax((sums / np.maximum(count, 1)[:, None] + self.bias) / self.temperature)
        best = p.argmax(axis=1)
        lettered = np.array([bool(t) and LETTER.search(t) is not None for t in texts.to_pylist()], dtype=bool)
        names = [self.labels[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
        return names, np.where(lettered, p[np.arange(len(best)), best], 0.0)


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _features(docs: DataFrame) -> DataFrame:
    """(lang, order, buckets, weights): the distinct buckets of a text and their shares, once a task for all its copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[str, int]] = set()
        for batch in batches:
            first = []
            for at, own in enumerate(zip(batch.column("lang").to_pylist(), batch.column("order").to_pylist(), strict=True)):
                if own not in met:
                    met.add(own)
                    first.append(at)
            batch = batch.take(pa.array(first, pa.int64()))
            for piece in pieces(batch, "text", PIECE):
                found = list(subwords(*text_bytes(piece.column("text"))))
                keys, shares = [], []
                for r in range(piece.num_rows):
                    own = np.concatenate([bucket[b[r] : b[r + 1]] for bucket, b in found])
                    key, n = np.unique(own, return_counts=True)
                    keys.append(key.astype(np.int32))
                    shares.append((n / max(1, n.sum())).astype(np.float32))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("lang"), piece.column("order"), pa.array(keys, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))],
                    ["lang", "order", "buckets", "weights"],
                )

    return docs.mapInArrow(run, "lang string, order long, buckets array<int>, weights array<float>")


def _sample(docs: DataFrame, per_lang: int) -> pa.Table:
    """At most ``per_lang`` distinct texts of each of the languages with most of them, by a hash of the text."""
    from lakelog.llm.common import stored

    texts = stored(docs.select("lang", "order").distinct(), "texts-by-language")
    counts = texts.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGS)
    share = F.least(F.lit(1.0), F.lit(1.25 * per_lang) / F.col("count"))  # a few more, so that seldom less are left
    drawn = texts.join(F.broadcast(counts), "lang").where(F.pmod(F.col("order"), F.lit(1 << 20)) < share * (1 << 20))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("order", F.lit(1 << 20)), "order"))
    drawn = drawn.withColumn("rank", rank).where(F.col("rank") <= per_lang).select("lang", "order")
    rows = docs.select("lang", "order", "text").join(F.broadcast(drawn), ["lang", "order"], "left_semi")
    return _features(rows).dropDuplicates(["lang", "order"]).orderBy("lang", "order").toArrow()


def fit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    per_lang: int = DOCS_PER_LANG,
    epochs: int = 8,
    rate: float = 4.0,
    reject: float = 0.002,
    seed: int = 1,
) -> LanguageModel:
    """Learn from the rows of ``docs`` whose language is not null, at most ``per_lang`` distinct texts of a language.

    Copies of a text teach as one, and the MOST_LANGS languages with most texts are learned.

    Half of the sample is fitted by stochastic gradient descent, the other half sets the temperature and the
    threshold: the ``reject`` quantile of the confidence of its right answers, and at most one half. Rows without
    text or letters teach nothing. Without any row there is one label, ``und``.
    """
    text, lang = docs[f"`{text_col}`"], docs[f"`{lang_col}`"].cast("string")
    usable = docs.select(lang.alias("lang"), text.alias("text"), F.xxhash64(text, lang).alias("order"))
    rows = _sample(usable.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")), per_lang)
    names = rows.column("lang").to_pylist()
    labels = sorted(set(names)) or [UNKNOWN]
    buckets = [np.array(x, dtype=np.int64) for x in rows.column("buckets").to_pylist()]
    weights = [np.array(x, dtype=np.float64) for x in rows.column("weights").to_pylist()]
    truth = np.array([labels.index(n) for n in names], dtype=np.int64)

    random = np.random.default_rng(seed)
    order = random.permutation(len(names))
    train, check = (order[: len(order) // 2 + 1], order[len(order) // 2 + 1 :])
    embed = random.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    weight = random.normal(0, 0.5, (DIMENSIONS, len(labels)))
    bias = np.zeros(len(labels))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for at in range(0, len(train), 16):
            batch = train[at : at + 16]
            hidden = np.stack([weights[i] @ embed[buckets[i]] for i in batch])
            slope = softmax(hidden @ weight + bias)
            slope[np.arange(len(batch)), truth[batch]] -= 1
            back = slope @ weight.T
            weight -= step / len(batch) * hidden.T @ slope
            bias -= 0.1 * step * slope.mean(axis=0)
            for i, pull in zip(batch, back, strict=True):  # the buckets of one text are distinct
                embed[buckets[i]] -= 10 * step * weights[i][:, None] * pull
    table = embed @ weight

    scores = np.array([weights[i] @ table[buckets[i]] + bias for i in check]).reshape(-1, len(labels))
    right = truth[check]
    loss = lambda t: -np.log(softmax(scores / t)[np.arange(len(right)), right] + 1e-12).mean()
    temperature = min((2.0**k for k in np.arange(-1, 4.1, 0.25)), key=loss) if len(check) else 1.0
    p = softmax(scores / temperature)
    sure = p.max(axis=1)[p.argmax(axis=1) == right] if len(check) else np.ones(0)
    threshold = min(0.5, float(np.quantile(sure, reject))) if len(sure) else 0.5
    return LanguageModel(labels, table.astype(np.float32), bias, float(temperature), threshold)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Columns of ``docs`` with ``lang_pred``, ``score`` and ``rejected``.

    Whole texts are read. A null text and one without a letter are ``und`` with score 0 and rejected; others have a
    learned label, rejected if the score is below the model's threshold. Rows are independent; columns of ``docs``
    with the names of results are replaced.
    """
    results = ("lang_pred", "score", "rejected")
    kept = [f for f in docs.schema.fields if f.name not in results and (keep_text or f.name != text_col)]
    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    schema = T.StructType([*kept, *(T.StructField(n, k) for n, k in zip(results, kinds, strict=True))])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for piece in pieces(batch, text_col, PIECE):
                names, score = own.predict(piece.column(text_col))
                out = [n == UNKNOWN or s < own.threshold for n, s in zip(names, score.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(f.name) for f in kept), pa.array(names), pa.array(score), pa.array(out)],
                    [f.name for f in schema],
                )

    return docs.mapInArrow(run, schema)


def bucket_of(id_col: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col) % parts
