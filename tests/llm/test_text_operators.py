"""Line dedup, substring dedup, decontamination and BPE against plain Python, with the odd cases."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakelog.llm import bpe
from lakelog.llm.decontaminate import find_windows, remove_spans
from lakelog.llm.line_dedup import dedup_lines
from lakelog.llm.substring_dedup import remove_repeats
from tests.llm import brute

SCHEMA = "doc_id long, text string, lines string, block int, items string"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def table(spark, rows):
    return spark.createDataFrame([(own, text, "x", 1, "y") for own, text in rows], SCHEMA)


def odd_texts(seed, count=60):
    """Texts over few words: nulls, empties, runs, repeats inside and between documents, one long text."""
    r = random.Random(seed)
    words = ["a", "b", "cd", "Ab", "é", "x,", "the", "THE"]
    shared = [" ".join(r.choice(words) for _ in range(r.randint(9, 40))) for _ in range(6)]
    out = [None, "", " ", "\n", "a " * 50, "a " * 13, "a " * 14 + "b", "\t a\n\n a ", "ab " * 40]
    while len(out) < count:
        own = [r.choice([r.choice(shared), " ".join(r.choice(words) for _ in range(r.randint(0, 25)))]) for _ in range(r.randint(1, 5))]
        out.append(r.choice(["\n", " ", "\n\t", " \n"]).join(own))
    out.append(" ".join(r.choice(words) for _ in range(30_000)))
    return out


def odd_docs(seed):
    r = random.Random(seed)
    texts = odd_texts(seed)
    rows = [(r.randint(-5, 500), t) for t in texts]
    rows += [rows[20], (rows[21][0], texts[30]), (None, texts[31]), (None, texts[32]), (900, texts[33])]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("min_docs", [2, 3])
def test_line_dedup(spark, min_docs):
    rows = odd_docs(min_docs)
    want = brute.line_dedup(rows, 10, min_docs)
    got = dedup_lines(table(spark, rows), min_docs=min_docs).collect()
    assert len(got) == len(rows)
    assert got[0].asDict().keys() == {"doc_id", "text", "lines", "block", "items", "n_lines", "n_dropped", "kept"}
    for x in got:
        assert (x.n_lines, x.n_dropped, x.kept) == want[x.doc_id, x.text]


def test_line_keys_fold_ascii_only(spark):
    rows = [(1, "\x0b ÄBC defghij \r"), (2, "äbc DEFGHIJ"), (3, "ÄbC DEFghij"), (4, "short"), (5, "SHORT"), (6, "\xa0ÄBC defghij")]
    got = {x.doc_id: x.n_dropped for x in dedup_lines(table(spark, rows)).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 0, 5: 0, 6: 0}


def test_line_dedup_runs_no_python(spark):
    plan = dedup_lines(table(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("size,rounds", [(13, 3), (4, 2)])
def test_substring_dedup(spark, seed, size, rounds):
    rows = odd_docs(seed)
    got = remove_repeats(table(spark, rows), size=size, rounds=rounds)
    assert got.columns == ["doc_id", "lines", "block", "items", "n_words", "n_removed", "kept"]
    key = lambda x: (x[0] is None, x)
    got = sorted((tuple(x) for x in got.select("doc_id", "n_words", "n_removed", "kept").collect()), key=key)
    assert got == sorted(brute.substring_dedup(rows, size), key=key)


def test_substring_dedup_over_many_blocks(spark, monkeypatch):
    from lakelog.llm import exchange

    monkeypatch.setattr(exchange.count_blocks, "__defaults__", (400,))
    rows = odd_docs(7)
    got = remove_repeats(table(spark, rows))
    got = [tuple(x) for x in got.select("doc_id", "n_words", "n_removed", "kept").collect()]
    key = lambda x: (x[0] is None, x)
    assert sorted(got, key=key) == sorted(brute.substring_dedup(rows), key=key)


ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "Short item"), (3, "solo"), (4, None), (5, ""), (6, "..."), (None, "no name here"), (2, "Short item"),
    (10, "one two three four five six seven eight nine TEN"),
]


@pytest.mark.parametrize("slice_size", [100_000, 2])
def test_decontaminate(spark, slice_size):
    long = "x one two three four five six seven eight nine ten y eleven twelve "
    rows = [(1, long), (2, long.upper().replace(" ", "--")), (3, None), (4, ""), (5, "a short, ITEM; solo"), (5, "short"),
            (6, "two three four five six seven eight nine ten eleven twelve z"), (None, "no name here solo"), (7, "solos é")]
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    found = find_windows(table(spark, rows).withColumn("n_hit", F.lit(9)), items, slice_size=slice_size)
    got = sorted((repr(x.doc_id), x.n_words, x.n_hit, x["items"]) for x in found.collect())
    assert got == sorted((repr(a), b, c, d) for a, b, c, d in brute.decontaminate(rows, ITEMS))
    clean = {x.doc_id: x.text for x in remove_spans(found).collect()}
    assert clean[1] == "x  y eleven twelve " and clean[7] == "solos é" and clean[3] is None


def test_decontaminate_without_items(spark):
    none = spark.createDataFrame([], "item_id int, text string")
    got = find_windows(table(spark, [(1, "a b"), (2, None)]), none).collect()
    assert sorted((x.doc_id, x.n_words, x.n_hit, x["items"]) for x in got) == [(1, 2, 0, []), (2, 0, 0, [])]


def test_bpe_matches_the_library(spark):
    r = random.Random(4)
    pool = ["<|endoftext|>", "don't", "  ", "\n\n", "é", "中文", "🙂", "x" * 300, "1234", "\x1c", "\x85", "​", "'LL", "aaaaab", "\x00"]
    texts = [None, "", " ", *("".join(r.choice(pool) for _ in range(r.randint(1, 12))) for _ in range(300)), "word " * 50_000]
    rows = list(enumerate(texts))
    got = {x.doc_id: x for x in bpe.encode(table(spark, rows), VOCABULARY, round_trip=True).collect()}
    library = Tokenizer.from_file(VOCABULARY)
    for own, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert list(got[own].ids) == ids
        assert got[own].decoded == library.decode(ids, skip_special_tokens=False)
    tokens = spark.createDataFrame([(1, [255, 200]), (2, None), (3, [])], "k int, ids array<int>")
    assert [x.decoded for x in bpe.decode(tokens, VOCABULARY).orderBy("k").collect()] == [
        library.decode([255, 200], skip_special_tokens=False), None, ""]


def test_bpe_of_random_words():
    model = bpe.ByteBPE(VOCABULARY)
    library = Tokenizer.from_file(VOCABULARY)
    r = random.Random(5)
    words = ["".join(r.choice("etaoinshrdlu'") for _ in range(r.randint(1, 30))) for _ in range(3000)] + ["a" * k for k in range(1, 70)]
    parts = [bpe.regex.findall(bpe.PATTERN, w) for w in words]
    encoder = bpe.Encoder(model)
    assert list(encoder.encode(words)) == [x.ids for x in library.encode_batch(words, add_special_tokens=False)]
    assert model.encode_words([p.encode() for w in parts for p in w]) == model.merge_all([p.encode() for w in parts for p in w])


@pytest.mark.parametrize("run", [dedup_lines, remove_repeats, lambda d: bpe.encode(d, VOCABULARY, round_trip=True)])
def test_empty_tables(spark, run):
    assert run(table(spark, [])).count() == 0
