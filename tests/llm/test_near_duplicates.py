"""SimHash and embedding near-dedup and components against brute force."""

import random

import numpy as np
import pytest

from lakelog.llm import embedding_dedup, simhash_dedup
from lakelog.llm.graph import components
from tests.llm import brute


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_lose_nothing(spark, bits):
    r = random.Random(bits)
    prints = {r.getrandbits(64) for _ in range(300)} | {0, 2**64 - 1, 3}
    for x in list(prints):
        for _ in range(3):
            for b in r.sample(range(64), r.randint(0, 4)):
                x ^= 1 << b
            prints.add(x)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    got = {frozenset(x) for x in map(tuple, simhash_dedup.links(spark.createDataFrame(signed, "fp long"), bits).collect())}
    values = [x for (x,) in signed]
    want = {frozenset((a, b)) for i, a in enumerate(values) for b in values[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= bits}
    assert got == want


def texts(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(r.randint(1, 6)))
    base = [" ".join(word() for _ in range(r.randint(1, 200))) for _ in range(30)]
    out = [None, "", " \n", "One", "one", "one Two", "x " * 5000]
    for t in base:
        w = t.split()
        out.append(t)
        for _ in range(3):
            v = list(w)
            for _ in range(r.randint(0, 2)):
                v[r.randrange(len(v))] = word()
            out.append("  ".join(v) if r.random() < 0.5 else " ".join(v).upper())
    return out


def test_simhash_dedup(spark):
    rows = [(k * 3 % 401, t) for k, t in enumerate(texts(1))] + [(None, "one"), (None, "nowhere else"), (5000, "one two")]
    docs = spark.createDataFrame([(a, t, 1) for a, t in rows], "doc_id long, text string, fp int")
    got = sorted(map(repr, map(tuple, simhash_dedup.near_duplicates(docs).collect())))
    prints, roots = brute.simhash_components(rows)
    by_print = {fp: roots[own] for own, fp in reversed(prints) if own is not None}
    want = [(a, f"{fp:016x}", by_print.get(fp)) for a, fp in prints]
    assert got == sorted(map(repr, want))


def test_simhash_dedup_with_repeated_ids(spark):
    rows = [(1, "a b c d e"), (1, "v w x y z"), (2, "v w x y z"), (3, "other words are here now")]
    got = simhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(x.doc_id, x.component_id) for x in got} == {(1, 1), (2, 1), (3, 3)}
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_dedup.near_duplicates(none).count() == 0


def test_components(spark):
    r = random.Random(3)
    chain = [(k, k + 1) for k in range(1000, 1080)]
    star = [(7, k) for k in range(2000, 2100)]
    loose = [(r.randrange(100), r.randrange(100)) for _ in range(40)]
    links = chain + star + loose + [(5, 5), (None, 3), (1079, 2099)]
    r.shuffle(links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long").repartition(7)).collect()))
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == brute.components({x for p in real for x in p}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(seed):
    g = np.random.default_rng(seed)
    base = g.normal(size=(40, 8))
    rows, own = [], 0
    for k, b in enumerate(base):
        for _ in range(4):
            v = b + g.normal(size=8) * g.choice([0, 0.1, 0.3])
            rows.append([own, v.astype(np.float32).tolist(), int(k % 3)])
            own += 1
    hot = base[0].astype(np.float32).tolist()
    rows += [[own + k, hot, 0] for k in range(30)]
    rows += [[900, (2 * base[0]).astype(np.float32).tolist(), 0], [901, None, 0], [902, [], 0], [903, [0.0] * 8, 0]]
    rows += [[904, [float("nan")] * 8, 0], [905, [None, 1.0], 0], [906, hot, None], [907, [1.0, 0.0], 0], [908, [2.0, 0.0], 0]]
    rows += [[909, [float("inf")] * 8, 1], [None, hot, 0], [3, hot, 1], [910, [1e-38] * 8, 5], [911, [3e38] * 8, 5]]
    return rows


@pytest.mark.parametrize("cell,block", [(2048, 2048), (5, 3)])
def test_embedding_dedup(spark, cell, block):
    rows = vectors(1)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(map(repr, map(tuple, embedding_dedup.near_duplicates(table, cell=cell, block=block).collect())))
    ok = [r for r in rows if r[0] is not None and r[2] is not None and r[1] and None not in r[1]]
    ok = [(k, np.array(v, dtype=np.float32).astype(float), c) for k, v, c in ok]
    ok = [(k, v, c) for k, v, c in ok if np.isfinite(v).all() and v.any()]
    unit = [(k, v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()), c) for k, v, c in ok]
    links = [
        (i, j)
        for i, (_, v, c) in enumerate(unit)
        for j, (_, w, d) in enumerate(unit)
        if i != j and c == d and len(v) == len(w) and v @ w >= 0.93
    ]
    roots = brute.components({k for k, _, _ in unit}, [(unit[i][0], unit[j][0]) for i, j in links])
    count = [sum(1 for i, _ in links if i == n) for n in range(len(unit))]
    want = [(k, n, roots[k], k == roots[k]) for (k, _, _), n in zip(unit, count, strict=True)]
    good = [u[0] for u in unit]
    for k, v, c in rows:
        fine = v and None not in v and c is not None and k is not None and np.isfinite(np.array(v, float)).all() and np.any(v)
        if not fine:
            want.append((k, 0, roots.get(k, k), None if k is None else roots.get(k, k) == k))
    assert len(good) + sum(1 for w in want[len(good):]) == len(rows)
    assert got == sorted(map(repr, want))


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<double>, label int")
    assert embedding_dedup.near_duplicates(none).count() == 0
