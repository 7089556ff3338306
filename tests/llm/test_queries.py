"""Registered queries over the given tables, against SQL where there is some and plain Python elsewhere."""

import zlib

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from lakelog.llm import language_id
from lakelog.llm.oracles import ORACLES
from lakelog.llm.queries import QUERIES
from tests.compare import connect, same
from tests.llm import brute


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def documents(duck):
    return duck.sql("SELECT * FROM documents ORDER BY doc_id").fetchall()


def test_all_are_registered():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(QUERIES)
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, duck, name):
    same(QUERIES[name](spark, sf_dir).toPandas(), duck.sql(ORACLES[name]).df())


def remainder(own, parts):
    return zlib.crc32(str(own).encode()) % parts


def test_op1_on_held_out_documents(spark, sf_dir, documents):
    found = {x.doc_id: x for x in QUERIES["op1_language_id"](spark, sf_dir).collect()}
    assert len(found) == len(documents)
    assert all(found[d[0]].held_out == (remainder(d[0], 4) == 2) for d in documents)
    held = [found[d[0]].lang_pred == d[2] for d in documents if found[d[0]].held_out]
    assert sum(held) >= 0.97 * len(held)
    assert not any(x.rejected for x in found.values() if x.lang_pred != "und" and x.score > 0.5)


def test_op4_against_the_library(spark, sf_dir, documents):
    assert digests(QUERIES["op4_bpe"](spark, sf_dir)) == library_digests((d[0], d[1]) for d in documents)


def digests(found):
    return {x.doc_id: (x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in found.collect()}


def library_digests(rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = {}
    for own, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        out[own] = len(ids), brute.sha(",".join(map(str, ids))), brute.sha(decoded)
    return out


def test_op7_on_held_out_labels(spark, sf_dir, duck):
    found = {x.doc_id: x for x in QUERIES["op7_quality"](spark, sf_dir).collect()}
    labels = duck.sql("SELECT doc_id, quality FROM labels").fetchall()
    assert all(x.held_out == (remainder(own, 5) == 0) for own, x in found.items())
    held = [(found[own].score, y) for own, y in labels if found[own].held_out]
    good, bad = ([s for s, y in held if y == k] for k in (1, 0))
    assert sum(a > b for a in good for b in bad) >= 0.9 * len(good) * len(bad)


def test_op9_against_all_pairs(spark, sf_dir, documents):
    prints, roots = brute.simhash_components([(d[0], d[1]) for d in documents])
    found = {(x.doc_id, x.fingerprint, x.component_id) for x in QUERIES["op9_simhash_dedup"](spark, sf_dir).collect()}
    assert found == {(own, f"{fp:016x}", roots[own]) for own, fp in prints}


def test_op10_against_all_pairs(spark, sf_dir, duck):
    import numpy as np

    rows = duck.sql("SELECT vec_id, embedding, label FROM embeddings ORDER BY vec_id").fetchall()
    x = np.array([r[1] for r in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    linked = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    ids = [r[0] for r in rows]
    roots = brute.components(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(linked), strict=True)])
    found = {tuple(r) for r in QUERIES["op10_embedding_dedup"](spark, sf_dir).collect()}
    assert found == {(k, int(n), roots[k], k == roots[k]) for k, n in zip(ids, linked.sum(axis=1), strict=True)}


def test_pipeline_against_plain_python(spark, sf_dir, duck, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_dedup", "decontaminate", "bpe"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.fit(docs.where(language_id.bucket_of("doc_id", 4) != 2))
    rejected = {x.doc_id for x in language_id.identify(docs, model).where("rejected").collect()}
    rows = [(d[0], d[1]) for d in documents if d[0] not in rejected]
    assert len(rows) > 0.98 * len(documents)
    lines = brute.line_dedup(rows)
    rows = [(own, lines[own, text][2] if lines[own, text][1] else text) for own, text in rows]
    _, roots = brute.simhash_components(rows)
    rows = [(own, text) for own, text in rows if roots[own] == own]
    hits = brute.decontaminate(rows, duck.sql("SELECT item_id, text FROM benchmark").fetchall())
    rows = [row for row, (_, _, n_hit, _) in zip(rows, hits, strict=True) if not n_hit]
    assert digests(QUERIES["pipeline"](spark, sf_dir)) == library_digests(rows)


def test_stages_keep_the_columns_and_odd_rows(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    odd = [(1, None, "en", "s", None), (2, "", None, None, 0), (3, "one two three " * 50, "en", "s", 1), (None, "abc def", "en", None, 2),
           (5, "one two three " * 50, "en", "s", 1), (3, "one two three " * 50, "en", "s", 1)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, sf_dir)
            assert name == "bpe" or made.schema.names == schema.names
            assert made.count() <= len(rows)
