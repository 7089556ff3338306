"""Spelling variant grouping by bidirectional FM-index search schemes.

A word and a word that differs from it by one error have the same left half or the same right half. The vocabulary is
dealt into shards by hashes of halves: a word is entered under the halves that its near words could ask for, at most
two left and two right ones, and asks under its own two. A shard indexes its words with delimiters, matches the asked
half exactly, and goes on over the other half with one error (see ``fm_index``). Counts and the best near word leave a
shard, never its pairs.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelog.llm.buffers import LOWER, marked, pieces, text_bytes
from lakelog.llm.common import salted_join, stored
from lakelog.llm.fm_index import WordIndex

SHARD = 1 << 18  # code points of the words in an index
ASKED = 1 << 16  # words that ask one index in a task
PIECE = 8 << 20
KEPT = 200_000  # words that a counting task holds before it passes them on
SHORT = 64  # bytes of words whose checksums are joined by tables

# fixed value: letters of the contract are A-Z, a-z and U+00C0 to U+00FF, the last with this first byte in UTF-8
LEAD = 0xC3
LETTER = np.zeros(256, dtype=bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = LETTER[LEAD] = True


class Shift:
    """Moves checksums over so many bytes: crc32(a + b) is crc32(a), moved over len(b), xor crc32(b)."""

    def __init__(self) -> None:
        single = np.zeros(256, dtype=np.uint32)
        for b in range(256):
            c = b
            for _ in range(8):
                c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)  # the polynomial of zlib
            single[b] = c
        tables = [(np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)]
        for _ in range(SHORT):
            tables.append(single[tables[-1] & 0xFF] ^ tables[-1] >> np.uint32(8))
        self.tables = np.stack(tables).reshape(-1)  # [bytes moved, place of a byte, byte]

    def __call__(self, crc: np.ndarray, by: np.ndarray) -> np.ndarray:
        at = by.astype(np.int64) * 1024
        out = self.tables[at + (crc & 0xFF)]
        for k in (1, 2, 3):
            out = out ^ self.tables[at + 256 * k + (crc >> np.uint32(8 * k) & 0xFF)]
        return out


def _runs(column: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The row and the lower-cased letters of every run, in the order of the text."""
    data, borders = text_bytes(column)
    if not len(data):
        return np.empty(0, np.int64), pa.array([], pa.string()).dictionary_encode()
    inside = LETTER[data]
    inside[1:] |= data[:-1] == LEAD
    found = marked(data, borders, inside)
    ends = np.concatenate(([0], np.cumsum(found.ends - found.starts))).astype(np.int32)
    letters = pa.StringArray.from_buffers(len(found), pa.py_buffer(ends), pa.py_buffer(LOWER[data[inside]]))
    return found.rows(), letters.dictionary_encode()


def _count(damage: int | None):
    shift = Shift()

    def flush(held: Counter) -> pa.RecordBatch:
        kept = [(w, n) for w, n in held.items() if n and w]
        return pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for piece in pieces(batch, "text", PIECE):
                row, letters = _runs(piece.column("text"))
                words, code = letters.dictionary.to_pylist(), letters.indices.to_numpy()
                counts = np.bincount(code, minlength=len(words))
                if damage:
                    ids = piece.column("id").to_pylist()
                    head = np.array([zlib.crc32(f"{own}:".encode()) for own in ids], dtype=np.uint32)
                    tail = np.array([zlib.crc32(w.encode()) for w in words], dtype=np.uint32)
                    size = np.array([len(w.encode()) for w in words], dtype=np.int64)
                    short = size[code] <= SHORT
                    hashed = shift(head[row], np.where(short, size[code], 0)) ^ tail[code]
                    for k in np.flatnonzero(~short).tolist():
                        hashed[k] = zlib.crc32(words[code[k]].encode(), int(head[row[k]]))
                    named = np.array([own is not None for own in ids], dtype=bool)
                    hit = np.flatnonzero((hashed % np.uint32(damage) == 0) & named[row])
                    for c, h in zip(code[hit].tolist(), hashed[hit].tolist(), strict=True):
                        at = h % len(words[c])
                        held[words[c][:at] + words[c][at + 1 :]] += 1
                        counts[c] -= 1
                for w, n in zip(words, counts.tolist(), strict=True):
                    held[w] += n
                if len(held) > KEPT:
                    yield flush(held)
                    held = Counter()
        yield flush(held)

    return run


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int | None = None) -> DataFrame:
    """(word, n) of the maximal runs of letters A-Z, a-z, U+00C0 to U+00FF in all texts, A-Z lower-cased.

    With ``damage`` a run whose crc32 of ``<id>:<run>`` is divisible by it loses the code point at that checksum modulo
    the run's length first; rows without an id lose none. A null or empty text has no words, and a word that is empty
    after the loss is none. Rows that repeat an id count each.
    """
    narrow = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text_col}`"].alias("text"))
    found = narrow.mapInArrow(_count(damage), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _search(rows: pa.Table, asking: pa.Table) -> pa.Table:
    """Near words of the asking words in one index: how many, and the best of each."""
    rows = rows.sort_by("word")
    out: dict[str, list] = {"row": [], "found": [], "best_n": [], "best": []}
    if rows.num_rows and asking.num_rows:
        words, weight = rows.column("word").to_pylist(), rows.column("n").to_numpy()
        index = WordIndex(words)
        for side in ("left", "right"):
            own = asking.filter(pa.compute.equal(asking.column("side"), side)).sort_by("word")
            if not own.num_rows:
                continue
            pairs = index.near(own.column("word").to_pylist(), side)
            order = np.lexsort((pairs.word, -weight[pairs.word], pairs.query))
            query, word = pairs.query[order], pairs.word[order]
            heads = np.flatnonzero(np.diff(query, prepend=-1))
            out["row"] += own.column("row").to_numpy()[query[heads]].tolist()
            out["found"] += np.diff(np.append(heads, len(query))).tolist()
            out["best_n"] += weight[word[heads]].tolist()
            out["best"] += [words[w] for w in word[heads].tolist()]
    kinds = {"row": pa.int64(), "found": pa.int64(), "best_n": pa.int64(), "best": pa.string()}
    return pa.table({c: pa.array(out[c], k) for c, k in kinds.items()})


def _near(vocabulary: DataFrame) -> DataFrame:
    """(row, n_near, best) for every word of (row, word, n) that has a near one; best is (-n, word)."""
    size = F.length("word")
    total = vocabulary.agg(F.sum(size)).first()[0] or 0
    shards = max(1, -(-4 * total // SHARD))
    shard = lambda kind, half: F.pmod(F.xxhash64(F.lit(kind), half), F.lit(shards)).cast("int")
    left = lambda n: shard("left", F.left("word", F.floor(n / 2).cast("int")))
    right = lambda n: shard("right", F.right("word", F.ceil(n / 2).cast("int")))
    around: list[Column] = [f(size + d) for f in (left, right) for d in (-1, 0, 1)]
    entered = vocabulary.withColumn("shard", F.explode(F.array_distinct(F.array(*around))))
    asked = vocabulary.withColumn(
        "ask", F.explode(F.array(*(F.struct(F.lit(s).alias("side"), f(size).alias("shard")) for s, f in (("left", left), ("right", right)))))
    )
    asked = asked.select("row", "word", "ask.side", "ask.shard")

    blocks = entered.groupBy("shard").agg(F.ceil(F.sum(size + 1) / (2 * SHARD)).cast("int").alias("blocks"))
    groups = asked.groupBy("shard").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("groups"))
    shape = stored(blocks.join(groups, "shard"), "shards")
    part = lambda seed, of: F.pmod(F.xxhash64(F.lit(seed), "row"), F.col(of)).cast("int")
    each = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    unit = ["shard", "block", "group"]
    rows = salted_join(entered, shape, ["shard"], "row").withColumn("block", part(31, "blocks")).withColumn("group", each("groups"))
    asking = salted_join(asked, shape, ["shard"], "row").withColumn("group", part(32, "groups")).withColumn("block", each("blocks"))
    asking = asking.select(*unit, "row", "word", "side").toDF(*unit, "row", "word", "side")
    found = rows.select(*unit, "word", "n").groupBy(*unit).cogroup(asking.groupBy(*unit)).applyInArrow(
        _search, "row long, found long, best_n long, best string"
    )
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word")))
    return found.groupBy("row").agg(F.sum("found").alias("n_near"), best.alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): where the forms lead, by joining pointers that double in length."""
    known = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = known.toDF("root", "next")
        moved = stored(salted_join(known, ahead, ["root"], "word", "left"), "roots")
        if not moved.where("next is not null").limit(1).count():
            return known
        known = moved.select("word", F.coalesce("next", "root").alias("root"))


def group(words: DataFrame, word_col: str = "word", n_col: str = "n", ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word.

    ``words`` has one row for a word and its count. Two words are near if they differ by exactly one inserted, deleted or
    replaced code point. ``form`` is the near word of largest count, of equal ones the smallest in code-point order, if
    its count is ``ratio`` times the word's or more (``ratio`` above 1, counts above 0), else null; ``root`` is where
    forms lead, the word itself without one. Rows with a null word or count, a count below 1, and words
    of fewer than two code points, which have no halves, are left out; rows that repeat a word are one with their sum.
    An empty table gives no rows. Other columns do not matter. A word must fit into a task.
    """
    narrow = words.select(words[f"`{word_col}`"].alias("word"), words[f"`{n_col}`"].cast("long").alias("n"))
    narrow = narrow.where((F.length("word") >= 2) & (F.col("n") >= 1)).groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = stored(narrow.withColumn("row", F.monotonically_increasing_id()), "vocabulary")
    near = _near(vocabulary).toDF("row", "n_near", "best")
    best_n = -F.col("best.minus")
    fits = best_n >= ratio * F.col("n")
    judged = stored(
        vocabulary.join(near, "row", "left").select(
            "word",
            F.when(fits, F.col("best.word")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, best_n).alias("form_n"),
        ),
        "near-words",
    )
    roots = _roots(judged.where("form is not null")).toDF("word", "root")
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
