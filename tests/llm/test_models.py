"""Trained operators: held-out accuracy, exact parts against plain Python, the odd cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakelog.llm import language_id, quality, suffix_tree_lm
from lakelog.llm.buffers import LOWER, SPACE, text_bytes, words
from tests.llm.brute import lower


def language(r, letters, count):
    words = ["".join(r.choice(letters) for _ in range(r.randint(2, 6))) for _ in range(50)]
    return [" ".join(r.choice(words) for _ in range(r.randint(3, 60))) for _ in range(count)]


def test_language_id(spark):
    r = random.Random(1)
    rows = [(t, "xx") for t in language(r, "abcdefgé", 150)] + [(t, "yy") for t in language(r, "ghijklmñ", 150)]
    r.shuffle(rows)
    odd = [(None, "xx"), ("", "yy"), ("123 .. \n", "xx"), ("a", None), ("ß" * 100_000, None)]
    docs = spark.createDataFrame([(k, t, g, 0.5) for k, (t, g) in enumerate(rows + odd)], "doc_id long, text string, lang string, score double")
    model = language_id.fit(docs.where("doc_id < 200 or doc_id >= 300"))
    found = language_id.identify(docs, model).collect()
    assert model.labels == ["xx", "yy"] and 0 < model.threshold <= 0.5
    held = [x for x in found if 200 <= x.doc_id < 300]
    assert sum(x.lang_pred == x.lang for x in held) >= 99 and not any(x.rejected for x in held if x.lang_pred == x.lang and x.score > 0.6)
    last = {x.doc_id - 300: x for x in found if x.doc_id >= 300}
    assert all(last[k].lang_pred == "und" and last[k].score == 0 and last[k].rejected for k in (0, 1, 2))
    assert last[3].lang_pred in model.labels and 0 <= last[4].score <= 1
    assert all(0 <= x.score <= 1 for x in found) and len(found) == 305


def test_language_id_without_labels(spark):
    docs = spark.createDataFrame([("a", None), (None, None)], "text string, lang string")
    found = language_id.identify(docs, language_id.fit(docs)).collect()
    assert [x.lang_pred for x in found] == ["und", "und"]
    assert language_id.identify(docs.limit(0), language_id.fit(docs.limit(0))).count() == 0


def test_copies_of_a_text_are_one_in_the_sample(spark):
    r = random.Random(7)
    texts = language(r, "abcdefg", 1000)
    rows = [(t, "xx") for t in texts + texts[:20] * 500] + [(t, "yy") for t in language(r, "ghijklm", 100)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    drawn = language_id._sample(docs.select("lang", "text", F.xxhash64("text", "lang").alias("order")), 300)
    found = Counter(drawn.column("lang").to_pylist())
    assert found["xx"] == 300 and found["yy"] == len({t for t, g in rows if g == "yy"})
    assert len(set(drawn.column("order").to_pylist())) == drawn.num_rows


def test_subwords_stay_in_their_row():
    data, edges = np.frombuffer(b"ab cd1efgh", np.uint8), np.array([0, 2, 2, 6, 10])
    together = list(language_id.subwords(data, edges))
    for k, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        alone = list(language_id.subwords(data[low:high], np.array([0, high - low])))
        for (bucket, borders), (own, _) in zip(together, alone, strict=True):
            assert bucket[borders[k] : borders[k + 1]].tolist() == own.tolist()


def test_quality(spark):
    r = random.Random(2)
    good = [" ".join("".join(r.choice("abcdef") for _ in range(r.randint(1, 8))) for _ in range(r.randint(5, 80))) for _ in range(150)]
    bad = [" ".join([r.choice("abc") * 3] * r.randint(5, 80)) for _ in range(75)] + ["#$% " * r.randint(1, 50) for _ in range(75)]
    rows = [(t, 1) for t in good] + [(t, 0) for t in bad]
    r.shuffle(rows)
    docs = spark.createDataFrame([(k, t, 7) for k, (t, _) in enumerate(rows)] + [(1000, None, 7), (1001, "", 7)], "doc_id long, text string, y int")
    labels = spark.createDataFrame([(k, y) for k, (_, y) in enumerate(rows)] + [(None, 1), (3, None), (9999, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels.where("doc_id < 200"))
    found = {x.doc_id: x for x in quality.score(docs, model).collect()}
    assert sum(found[k].predicted == rows[k][1] for k in range(200, 300)) >= 98
    assert found[1000].score == found[1001].score and 0 < found[1000].score < 1
    assert all(x.predicted == (x.score >= 0.3) for x in found.values()) and len(found) == 302


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.score(docs, quality.fit(docs, none)).first().score == pytest.approx(0.5)
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), none)).count() == 0


def test_pairs_learn_what_single_features_cannot():
    g = np.random.default_rng(1)
    x = g.uniform(-1, 1, (4000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality.boost(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


def base_scores(rows, train):
    cut = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), "\n"]
    count = Counter(w for (_, t), ok in zip(rows, train, strict=True) if ok for w in cut(t))
    n, v = sum(count.values()), len(count)
    for _, t in rows:
        w = cut(t)
        yield len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)


@pytest.mark.parametrize("block", [4 << 20, 300])
def test_language_model(spark, monkeypatch, block):
    from lakelog.llm import exchange

    monkeypatch.setattr(exchange.count_blocks, "__defaults__", (block,))
    r = random.Random(3)
    syllables = ["ab", "cde", "fa", "gig", "hu", "kl"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 5)))
    made = [" ".join(word() for _ in range(r.randint(3, 60))) for _ in range(120)]
    texts = [None, "", " \n", "one", *made, "word " * 20_000]
    rows = list(enumerate(texts)) + [(None, "abc def"), (4, texts[5])]
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id long, text string, block int, train int")
    train = F.col("doc_id") % 3 != 1
    tree = suffix_tree_lm.fit(docs.where(train))
    found = suffix_tree_lm.score(docs, tree, train)
    assert found.columns == ["doc_id", "block", "train", *suffix_tree_lm.RESULT]
    want = base_scores(rows, [k is not None and k % 3 != 1 for k, _ in rows])
    want = sorted(repr((k, a, b, c, round(d, 6))) for (k, _), (a, b, c, d) in zip(rows, want, strict=True))
    got = found.collect()
    assert sorted(repr((x.doc_id, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 6))) for x in got) == want
    assert all(x.score < 0 for x in got)


def test_contexts_help_on_held_out_texts(spark, sf_dir):
    """Against a tree of the root alone. Unigram scores of words are no measure on so little text: they
    give all unknown words, and each of them, the probability of one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    train = language_id.bucket_of("doc_id", 5) != 1
    held = [
        suffix_tree_lm.score(docs, suffix_tree_lm.fit(docs.where(train), share=share), train).where(~train)
        for share in (suffix_tree_lm.SHARE, 1.1)
    ]
    score, root = (rows.agg(F.sum("score")).first()[0] for rows in held)
    assert score > 0.75 * root


def test_tree_is_a_distribution_and_reads_longest_suffixes(spark):
    r = random.Random(4)
    text = " ".join(language(r, "abcd", 200))
    docs = spark.createDataFrame([(text,), ("zq zq",)], "text string")
    tree = suffix_tree_lm.fit(docs)
    assert len(tree.parent) > 50
    for context in ["\n" * 6, " abcda"[::-1], "zzzzzz", text[-6:].lower()]:
        key = int.from_bytes(context.encode()[::-1], "big") << 8
        p = 10 ** tree.log_prob(np.arange(key, key + 256, dtype=np.uint64))
        assert p.sum() == pytest.approx(1)
    # the score of a row is the sum over its bytes
    found = words(LOWER[(d := text_bytes(pa.array(["Ab  ba", None])))[0]], d[1], SPACE)
    by_byte = []
    for whole in (b"\n\n\n\n\n\nab ba \n", b"\n\n\n\n\n\n\n"):
        by_byte.append(sum(tree.log_prob(np.array([int.from_bytes(whole[i - 6 : i][::-1] + whole[i : i + 1], "big")], np.uint64))[0] for i in range(6, len(whole))))
    assert tree.score(found) == pytest.approx(by_byte)


def test_language_model_without_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    tree = suffix_tree_lm.fit(none)
    assert suffix_tree_lm.score(none, tree, F.lit(True)).count() == 0
    docs = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    got = suffix_tree_lm.score(docs, tree, F.lit(False)).first()
    assert got.n_known == 0 and got.train_tokens == 0 and got.score == pytest.approx(-4 * math.log10(256))


@pytest.mark.parametrize("others", [0, 12])
def test_states_of_a_small_source_stay_beside_other_texts(spark, others):
    """The words of the small source stand 30 times each, fewer than a share of 5e-6 of 12 MB."""
    r = random.Random(5)
    made = ["".join(r.choice("uvwxyz") for _ in range(9)) for _ in range(40)]
    own = made * 30
    r.shuffle(own)
    docs = spark.createDataFrame([(k, " ".join(own[k::10])) for k in range(10)], "doc_id long, text string")
    large = spark.range(100, 100 + others).select(F.col("id").alias("doc_id"), F.expr("repeat('abc dea ', 131072)").alias("text"))
    tree = suffix_tree_lm.fit(docs.unionByName(large))
    found = suffix_tree_lm.score(docs, tree, F.lit(True)).agg(F.sum("score")).first()[0]
    # six bytes tell the next one, so a word costs little more than the choice of the word and its first bytes
    assert found > -len(own) * 3.4


def test_blocks_are_told_what_the_whole_tree_says(spark, monkeypatch):
    from lakelog.llm import exchange

    monkeypatch.setattr(exchange.count_blocks, "__defaults__", (2000,))
    texts = language(random.Random(6), "abcdeé", 300)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tree = suffix_tree_lm.fit(docs.where("doc_id < 250"))
    assert tree.buckets > 5 and tree.table.select("bucket").distinct().count() > 5
    got = [x.score for x in suffix_tree_lm.score(docs, tree, F.lit(True)).orderBy("doc_id").collect()]
    data, borders = text_bytes(pa.array(texts))
    assert got == pytest.approx(tree.score(words(LOWER[data], borders, SPACE)).tolist(), rel=1e-6)
