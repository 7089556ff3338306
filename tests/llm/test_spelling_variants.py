"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakelog.llm import spelling_variants
from lakelog.llm.fm_index import WordIndex
from lakelog.llm.queries import QUERIES
from lakelog.llm.spelling_variants import Shift, count_words, group


def one_error(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) >= len(b)) :] == b[k + (len(b) >= len(a)) :]


def count(docs, damage=None):
    out = Counter()
    for own, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{own}:{run}".encode())
            if damage and own is not None and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if w}


def grouped(words):
    """{word: (form, root, n, n_near, form_n)}; candidates are looked up, not compared pair by pair."""
    letters, form = sorted(set("".join(words))), {}
    for w, n in words.items():
        edits = {w[:k] + w[k + 1 :] for k in range(len(w))}
        edits |= {w[:k] + c + w[k + d :] for k in range(len(w) + 1) for c in letters for d in (0, 1)}
        near = [(-words[u], u) for u in (edits & words.keys()) - {w}]
        best = min(near, default=(0, None))
        form[w] = (best[1] if near and -best[0] >= 2 * n else None, len(near))
    out = {}
    for w, n in words.items():
        root = w
        while form[root][0] is not None:
            root = form[root][0]
        out[w] = (form[w][0], root, n, form[w][1], words.get(form[w][0]))
    return out


def rows(df):
    return {x.word: (x.form, x.root, x.n, x.n_near, x.form_n) for x in df.collect()}


def test_index_finds_all_pairs_once():
    pick = random.Random(5)
    for alphabet in ("ab", "abc", "abcdéÿ"):
        for size in (1, 10, 150):
            words = sorted({"".join(pick.choices(alphabet, k=pick.randint(2, 8))) for _ in range(size)})
            asking = [w for w in words if pick.random() < 0.7] + ["zzz", "abz", "azb"]
            index, got = WordIndex(words), []
            for side in ("left", "right"):
                found = index.near(asking, side)
                got += [(asking[q], words[w]) for q, w in zip(found.query, found.word, strict=True)]
            assert sorted(got) == sorted((a, b) for a in asking for b in words if one_error(a, b))


def test_index_with_very_long_words():
    words = sorted(["a" * 3000, "a" * 2999, "ab" * 1500, "ab" * 1499 + "b", "ab" * 700 + "b" + "ab" * 800, "short"])
    index = WordIndex(words)
    found = [index.near(words, side) for side in ("left", "right")]
    got = {(words[q], words[w]) for f in found for q, w in zip(f.query, f.word, strict=True)}
    assert got == {(a, b) for a in words for b in words if one_error(a, b)}


def test_checksums_join():
    shift, parts = Shift(), [(b"", b"x"), (b"12:", b"abc"), (b"\xff" * 9, b"q" * 64)]
    heads = np.array([zlib.crc32(a) for a, _ in parts], dtype=np.uint32)
    moved = shift(heads, np.array([len(b) for _, b in parts]))
    assert [int(m) ^ zlib.crc32(b) for m, (_, b) in zip(moved, parts, strict=True)] == [zlib.crc32(a + b) for a, b in parts]


DOCS = [
    (1, "Hello World hello, café naïve× ÉCOLE"), (1, "Hello again"), (2, None), (3, ""), (None, "hello there"),
    (4, "tab\tnew\nline 12ab34 Ābc 日本"), (5, "x" * 300 + " " + "y" * 70), (6, "A" * 5000), (7, "a b c d e f g h"),
]


@pytest.mark.parametrize("damage", [None, 1, 3, 97])
def test_counts(spark, damage):
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    assert {x.word: x.n for x in count_words(df, damage=damage).collect()} == count(DOCS, damage)


def test_counts_of_a_task_are_passed_on(spark, monkeypatch):
    monkeypatch.setattr(spelling_variants, "KEPT", 2)
    df = spark.createDataFrame(DOCS * 3, "doc_id long, text string")
    assert {x.word: x.n for x in count_words(df).collect()} == count(DOCS * 3)


@pytest.mark.parametrize(("shard", "asked"), [(1 << 18, 1 << 16), (40, 7)])
def test_groups(spark, monkeypatch, shard, asked):
    monkeypatch.setattr(spelling_variants, "SHARD", shard)
    monkeypatch.setattr(spelling_variants, "ASKED", asked)
    pick = random.Random(shard)
    words = {"".join(pick.choices("abc", k=pick.randint(2, 7))): pick.choice([3, 3, 6, 7, 15, 40, 90]) for _ in range(250)}
    words |= {"prefix" + a + b: 5 for a in "abcdef" for b in "uvwxyz"}  # many words with one half
    got = rows(group(spark.createDataFrame(list(words.items()), "word string, n int")))
    assert got == grouped(words)


def test_chains_ties_and_odd_rows(spark):
    data = [("aaaaa", 1), ("aaaab", 2), ("aaabb", 4), ("aabbb", 8), ("abbbb", 16), ("zzzzz", 1), ("yzzzz", 9), ("zzzzy", 9)]
    odd = [(None, 5), ("", 4), ("a", 9), ("later", None), ("nought", 0), ("\U0001f600\U0001f600", 5), ("\U0001f600", 9), ("abbbb", 4)]
    df = spark.createDataFrame(data + odd, "word string, n long")
    want = grouped({**dict(data), "abbbb": 20, "\U0001f600\U0001f600": 5})
    assert want["aaaaa"][:2] == ("aaaab", "abbbb") and want["zzzzz"][0] == "yzzzz"
    more = [F.lit("x").alias(c) for c in ("form", "root", "row", "shard", "side", "best", "n_near")]
    assert rows(group(df)) == want == rows(group(df.select("*", *more)))
    assert rows(group(df.limit(0))) == {}


def test_query(spark, sf_dir):
    docs = [(x.doc_id, x.text) for x in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    words = {w: n for w, n in count(docs, 97).items() if len(w) >= 5 and n >= 3}
    assert rows(QUERIES["op13_spelling_variants"](spark, sf_dir)) == grouped(words)
