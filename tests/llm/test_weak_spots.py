"""Cases that once lost results, time or memory."""

import random
import time

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakelog.llm import embedding_dedup, quality
from lakelog.llm.bpe import ByteBPE
from lakelog.llm.queries import op1_language_id


def test_links_among_nearly_equal_pivots(spark):
    """Pivots closer to each other than a cosine can tell: no link is lost."""
    pick = np.random.default_rng(7)
    for kind, width in (("double", 3e-9), ("double", 5e-9), ("float", 1e-7)):
        centre = pick.normal(size=16)
        near = centre / np.linalg.norm(centre) + pick.normal(size=(150, 16)) * width
        side = pick.normal(size=16)
        tilted = near[:100] + 0.39 * side / np.linalg.norm(side)  # about the threshold away from the others
        vectors = np.concatenate((near, tilted, pick.normal(size=(50, 16))))
        if kind == "float":
            vectors = vectors.astype(np.float32)
        df = spark.createDataFrame([(k, [float(x) for x in v], 1) for k, v in enumerate(vectors)],
                                   f"vec_id long, embedding array<{kind}>, label int")
        got = {x.vec_id: x.n_links for x in embedding_dedup.near_duplicates(df, cell=20).collect()}
        wide = vectors.astype(np.float64)
        unit = wide / np.linalg.norm(wide, axis=1, keepdims=True)
        cosine = unit @ unit.T
        np.fill_diagonal(cosine, 0)
        low, high = (cosine >= 0.93 + 1e-12).sum(axis=1), (cosine >= 0.93 - 1e-12).sum(axis=1)
        assert all(low[k] <= got[k] <= high[k] for k in range(len(vectors)))


def test_long_words_in_time():
    path = public_tokenizers.path("byte_bpe_50k.json")
    model, library, pick = ByteBPE(path), Tokenizer.from_file(path), random.Random(1)
    letters = lambda n, of: "".join(pick.choices(of, k=n))
    for word in (letters(1 << 20, "abcdefghijklmnopqrstuvwxyz"), "a" * 200_000, "the" * 50_000, letters(50_000, "ab")):
        start = time.process_time()
        ids = model.encode_words([word.encode(), b" of"])
        assert time.process_time() - start < 60
        assert ids[0] == library.encode(word, add_special_tokens=False).ids and ids[1] == model.encode_words([b" of"])[0]
    assert model.merge_long(b"hello") == model.merge(b"hello")


def test_quality_sample_is_bounded_under_repeated_ids(spark, monkeypatch):
    """An id with most labels and most documents is one row of the sample."""
    met = []
    monkeypatch.setattr(quality, "boost", lambda x, y: met.append((len(x), sorted(y))))
    docs = spark.range(3000).select(F.greatest(F.col("id") - 2900, F.lit(0)).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    quality.fit(docs, labels.unionByName(labels), sample=40)
    quality.fit(docs, labels, sample=1000)
    quality.fit(docs, labels.limit(0), sample=40)
    assert [n for n, _ in met] == [40, 100, 0]


def test_rows_without_id_are_not_held_out(spark, tmp_path):
    rows = [(1, "some english words here", "en"), (None, "some english words too", "en"), (2, "more of these", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert all(x.held_out in (True, False) for x in op1_language_id(spark, str(tmp_path)).collect())


def test_counting_contexts_holds_little_memory():
    """Two such tasks share the memory of an executor with its JVM."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from lakelog.llm import suffix_tree_lm

    class Docs:
        def mapInArrow(self, run, schema):  # noqa: N802
            return run

    letters = np.random.default_rng(5).integers(97, 123, 12_000_000, dtype=np.uint8)
    letters[::6] = 0x20
    text = letters.tobytes().decode()
    batch = pa.record_batch({"text": [text[k : k + 1000] for k in range(0, len(text), 1000)]})
    run = suffix_tree_lm._count(Docs(), 4)
    tracemalloc.start()
    n = sum(np.frombuffer(c, np.int64).sum() for part in run(iter([batch])) for c in part.column("counts").to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 12_000_000 and peak < 300 << 20
