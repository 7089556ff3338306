"""Byte-level BPE by speculation and verification.

A greedy longest match proposes the tokens of each distinct word of a batch. The proposal is the BPE encoding if
and only if every two neighbours are compatible, that is if no merge across their border comes before the merges
that take the two border symbols away; this is checked for all pairs at once in numpy. Only words with an
incompatible pair are merged exactly. A word of LONG bytes or more is matched at all its bytes at once, and merged from a
heap if that has to be.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelog.llm.buffers import WordHash, mix, pieces

# fixed value: how the byte-level vocabulary splits text before its merges
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE = 200_000  # words whose tokens a worker remembers, a few hundred bytes each
PIECE = 4 << 20
LONG = 512  # bytes of a word from which it is handled by itself
NEVER = np.int64(1) << 40


def byte_alphabet() -> dict[str, int]:
    """The letters that vocabulary files use for bytes: printable ones for themselves, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Places:
    """Where each of some 64-bit keys stands; an open hash table that numpy can search for many keys at once."""

    def __init__(self, keys: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(len(keys) * 3).bit_length()))
        self.slots = np.full(1 << int(64 - self.shift), -1, dtype=np.int32)
        self.keys = keys
        for i, slot in enumerate(self._slot(keys).tolist()):
            while self.slots[slot] >= 0:
                slot = (slot + 1) % len(self.slots)
            self.slots[slot] = i

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for those that are not there."""
        out = np.full(len(keys), -1, dtype=np.int64)
        slot, open_ = self._slot(keys), np.arange(len(keys))
        while len(open_):
            place = self.slots[slot]
            hit = (place >= 0) & (self.keys[place] == keys[open_])
            out[open_[hit]] = place[hit]
            on = (place >= 0) & ~hit
            slot, open_ = (slot[on] + 1) % len(self.slots), open_[on]
        return out


class Spans:
    """Hashes of byte spans from prefix sums (see ``buffers.WordHash``)."""

    def __init__(self, longest: int):
        self.family = WordHash(4)
        self.longest = longest

    def sums(self, text: np.ndarray) -> np.ndarray:
        self.family.grow(len(text) + 1)
        out = np.zeros(len(text) + 1, dtype=np.uint64)
        np.cumsum(self.family.value[text] * self.family.power[: len(text)], out=out[1:])
        return out

    def span(self, sums: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        return mix((sums[at + size] - sums[at]) * self.family.inverse[at] + np.uint64(size))

    def whole(self, words: list[bytes]) -> np.ndarray:
        sums = self.sums(np.frombuffer(b"".join(words), np.uint8))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        out = np.empty(len(words), dtype=np.uint64)
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)
            out[own] = self.span(sums, ends[own] - size, size)
        return out


def _lists(token: np.ndarray, owner: np.ndarray, words: int) -> list[list[int]]:
    """The tokens of each word, from tokens in the order of their words."""
    ends = np.cumsum(np.bincount(owner, minlength=words)).tolist()
    flat = token.tolist()
    return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if words else []


class ByteBPE:
    """Vocabulary, merges and added tokens of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, alphabet = spec["model"], byte_alphabet()
        options = spec["pre_tokenizer"]
        if model["type"] != "BPE" or options["type"] != "ByteLevel" or options["add_prefix_space"] or spec["normalizer"]:
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        if any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec["added_tokens"]):
            raise ValueError("added tokens with conditions are not supported")
        size = 1 + max([*model["vocab"].values(), *self.added.values()])
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in model["vocab"].items():
            if token not in self.added:
                self.bytes_of[i] = bytes(alphabet[c] for c in token)
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.letter = np.array([model["vocab"][c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])])
        names = {b: i for i, b in enumerate(self.bytes_of) if b and i not in self.added.values()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.born = np.full(size, -1, dtype=np.int64)  # rank of the merge that makes a token, -1 for bytes
        self.left = np.arange(size, dtype=np.int64)
        self.right = np.arange(size, dtype=np.int64)
        for rank, pair in enumerate(model["merges"]):
            a, b = (model["vocab"][x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            made = names[self.bytes_of[a] + self.bytes_of[b]]
            if (a, b) in self.merges or self.born[made] >= 0:
                raise ValueError("merges that repeat a pair or a token are not supported")
            self.merges[a, b] = rank, made
            self.born[made], self.left[made], self.right[made] = rank, a, b
        self.pairs = Places(np.array([a * size + b for a, b in self.merges], dtype=np.uint64))
        self.ranks = np.array([rank for rank, _ in self.merges.values()], dtype=np.int64)
        self.results = np.array([made for _, made in self.merges.values()], dtype=np.int64)
        self.size = size
        self.lengths = np.fromiter(map(len, self.bytes_of), np.int64, size)
        spelled = list(names)
        own = self.merge_all(spelled)
        self.names = {b: names[b] for b, ids in zip(spelled, own, strict=True) if ids == [names[b]]}
        self.token_ids = np.fromiter(self.names.values(), np.int64)  # tokens that BPE itself can give
        self.hashing = Spans(max(map(len, self.names)))
        self.tokens = Places(self.hashing.whole(list(self.names)))
        self.longest = np.ones(1 << 16, dtype=np.int64)
        for b in self.names:
            if len(b) > 1:
                self.longest[b[0] << 8 | b[1]] = max(len(b), self.longest[b[0] << 8 | b[1]])

    def merge(self, word: bytes) -> list[int]:
        """The exact encoding of one word."""
        return self.merge_all([word])[0]

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """The exact encodings: in every word the merge of lowest rank first, from the left, all words in step."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        token = self.letter[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        done_token, done_owner = [], []
        rank, made = self._next(token, owner)
        while len(token):
            heads = np.flatnonzero(np.diff(owner, prepend=-1))
            least = np.minimum.reduceat(rank, heads)
            index = np.cumsum(np.diff(owner, prepend=-1) != 0) - 1
            at = np.flatnonzero((rank == least[index]) & (rank < NEVER))
            at = at[np.unique(index[at], return_index=True)[1]]  # the leftmost in each word
            token[at] = made[at]
            keep = (least < NEVER)[index]
            done_token.append(token[~keep])
            done_owner.append(owner[~keep])
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            token, owner, rank, made = token[keep], owner[keep], rank[keep], made[keep]
            at = moved[at]
            for places in (at, at[at > 0] - 1):
                rank[places], made[places] = self._next_at(token, owner, places)
        token, owner = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (done_token, done_owner))
        order = np.argsort(owner, kind="stable")
        return _lists(token[order], owner, len(words))

    def _next_at(self, token: np.ndarray, owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging the tokens at ``at`` with their right neighbours; NEVER if there is none."""
        after = np.minimum(at + 1, len(token) - 1)
        found = self.pairs.find((token[at] * self.size + token[after]).astype(np.uint64))
        fits = (found >= 0) & (owner[at] == owner[after]) & (after > at)
        return np.where(fits, self.ranks[found], NEVER), self.results[found]

    def _next(self, token: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._next_at(token, owner, np.arange(len(token)))

    def propose_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches of all words in step: (token, word) in the order of the text."""
        text = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        at = np.concatenate(([0], ends[:-1])) if len(words) else np.empty(0, np.int64)
        sums = self.hashing.sums(text)
        chosen = np.full(len(text), -1, dtype=np.int64)  # the token that begins at a byte
        second = np.zeros(len(text), dtype=np.int64)
        second[:-1] = text[1:]
        limit = np.minimum(self.longest[text.astype(np.int64) << 8 | second], np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(text)))
        limit = np.maximum(limit, 1)
        going = np.flatnonzero(at < ends)
        while len(going):
            here = at[going]
            token = np.full(len(here), -1, dtype=np.int64)
            for size in range(int(limit[here].max()), 0, -1):
                look = np.flatnonzero((token < 0) & (limit[here] >= size))
                found = self.tokens.find(self.hashing.span(sums, here[look], size))
                token[look] = np.where(found >= 0, self.token_ids[found], -1)
            chosen[here] = token
            at[going] = here + self.lengths[token]
            going = going[at[going] < ends[going]]
        places = np.flatnonzero(chosen >= 0)
        return chosen[places], np.searchsorted(ends, places, side="right")

    def propose_long(self, word: bytes) -> np.ndarray:
        """Greedy longest matches of one word: first at all its bytes at once, then along the path from the first."""
        text = np.frombuffer(word, np.uint8)
        sums = self.hashing.sums(text)
        second = np.append(text[1:], np.uint8(0))
        limit = np.minimum(self.longest[text.astype(np.int64) << 8 | second], len(text) - np.arange(len(text)))
        token = np.full(len(text), -1, dtype=np.int64)
        for size in range(int(limit.max()), 0, -1):
            look = np.flatnonzero((token < 0) & (limit >= size))
            found = self.tokens.find(self.hashing.span(sums, look, size))
            token[look] = np.where(found >= 0, self.token_ids[found], -1)
        ahead, path, at = (np.arange(len(text)) + self.lengths[token]).tolist(), [], 0
        while at < len(word):
            path.append(at)
            at = ahead[at]
        return token[np.array(path)]

    def merge_long(self, word: bytes) -> list[int]:
        """The exact encoding of one word, merges taken from a heap by rank and place."""
        ids = self.letter[np.frombuffer(word, np.uint8)].tolist()
        size, get = len(ids), self.merges.get
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(m[0], i) for i in range(size - 1) if (m := get((ids[i], ids[i + 1])))]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= size or (m := get((ids[i], ids[j]))) is None or m[0] != rank:
                continue  # one of the two has gone into another token since
            ids[i], ids[j] = m[1], -1
            k, b = after[j], before[i]
            after[i] = k
            if k < size:
                before[k] = i
                if m := get((ids[i], ids[k])):
                    heappush(heap, (m[0], i))
            if b >= 0 and (m := get((ids[b], ids[i]))):
                heappush(heap, (m[0], b))
        return [i for i in ids if i >= 0]

    def encode_long(self, word: bytes) -> list[int]:
        """The tokens of one long word, in time that grows about as its length."""
        flat = self.propose_long(word)
        if b"".join(map(self.bytes_of.__getitem__, flat.tolist())) != word:
            raise RuntimeError("two different spellings have one hash")
        return flat.tolist() if self.compatible(flat[:-1], flat[1:]).all() else self.merge_long(word)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE keeps the border between tokens ``a`` and ``b``, for all pairs at once.

        Goes back in time along the right edge of ``a`` and the left edge of ``b``: the younger of the two border
        symbols is undone (the right one of two of equal age, as merges run from the left), and a pair fails if
        its own merge would have come before either symbol was taken into a larger one.
        """
        good = np.ones(len(a), dtype=bool)
        x, y = a.astype(np.int64), b.astype(np.int64)
        taken_x, taken_y = np.full(len(a), NEVER), np.full(len(a), NEVER)
        open_ = np.arange(len(a))
        while len(open_):
            found = self.pairs.find((x * self.size + y).astype(np.uint64))
            rank = np.where(found >= 0, self.ranks[found], NEVER)
            fails = (rank < taken_x) & (rank <= taken_y) & (rank < NEVER)
            good[open_[fails]] = False
            bx, by = self.born[x], self.born[y]
            undo_x = bx > by
            taken_x, taken_y = np.where(undo_x, bx, taken_x), np.where(undo_x, taken_y, by)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
            more = ~fails & ((bx >= 0) | (by >= 0))
            x, y, taken_x, taken_y, open_ = x[more], y[more], taken_x[more], taken_y[more], open_[more]
        return good

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Token lists of the given words."""
        if any(len(w) >= LONG for w in words):
            short = iter(self.encode_words([w for w in words if len(w) < LONG]))
            return [self.encode_long(w) if len(w) >= LONG else next(short) for w in words]
        flat, owner = self.propose_all(words)
        if b"".join(map(self.bytes_of.__getitem__, flat.tolist())) != b"".join(words):
            raise RuntimeError("two different spellings have one hash")
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        good = self.compatible(flat[inside], flat[inside + 1])
        out = _lists(flat, owner, len(words))
        failed = np.unique(owner[inside[~good]]).tolist()
        for w, ids in zip(failed, self.merge_all([words[w] for w in failed]), strict=True):
            out[w] = ids
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of token ids; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class Encoder:
    """Encodes texts with one vocabulary, remembering the tokens of words it has met."""

    def __init__(self, model: ByteBPE):
        self.model = model
        self.find = regex.compile(PATTERN).findall
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(model.added, key=len, reverse=True))) + ")").split
        self.known: dict[str, list[int]] = {}

    def _cut(self, text: str) -> list[str]:
        """Words of a text; added tokens are words of their own."""
        if not any(token in text for token in self.model.added):
            return self.find(text)
        parts = self.split(text)
        return [w for k, part in enumerate(parts) for w in ([part] if k % 2 else self.find(part))]

    def encode(self, texts: list[str | None]) -> Iterator[list[int]]:
        cut = [self._cut(text or "") for text in texts]
        if len(self.known) > CACHE:
            self.known = {token: [i] for token, i in self.model.added.items()}
        self.known.update({token: [i] for token, i in self.model.added.items()})
        new = list(set().union(*cut) - self.known.keys())
        self.known.update(zip(new, self.model.encode_words([w.encode() for w in new]), strict=True))
        get = self.known.__getitem__
        for words in cut:
            yield list(chain.from_iterable(map(get, words)))


def encode(docs: DataFrame, path: str, text_col: str = "text", round_trip: bool = False, keep_text: bool = True) -> DataFrame:
    """Columns of ``docs`` with ``ids`` (array of int); with ``round_trip`` also ``decoded``, the text of the ids.

    ``path`` is a tokenizer file (JSON) of byte-level BPE kind, read on the driver; its added tokens are found in
    the text as the public library does. A null or empty text has no tokens and decodes to the empty text. Rows are
    independent, so repeated ids are nothing special. Columns of ``docs`` named ``ids`` or ``decoded`` are replaced.
    A worker remembers at most CACHE words and what a batch of PIECE bytes holds.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ByteBPE(path))
    names = ("ids", "decoded") if round_trip else ("ids",)
    kept = [f for f in docs.schema.fields if f.name not in names and (keep_text or f.name != text_col)]
    schema = T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if round_trip:
        schema = schema.add("decoded", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for piece in pieces(batch, text_col, PIECE):
                lengths, flat, decoded = [0], [], []
                for ids in encoder.encode(piece.column(text_col).to_pylist()):
                    lengths.append(lengths[-1] + len(ids))
                    flat.append(np.array(ids, dtype=np.int32))
                    if round_trip:
                        decoded.append(encoder.model.decode(ids))
                values = pa.array(np.concatenate(flat) if flat else np.empty(0, np.int32))
                columns = [*(piece.column(f.name) for f in kept), pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), values)]
                if round_trip:
                    columns.append(pa.array(decoded, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    return docs.mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """Columns of ``tokens`` with ``decoded``: the text of the ids; null ids give null, unknown ids fail."""
    shared = tokens.sparkSession.sparkContext.broadcast(ByteBPE(path))
    kept = [f for f in tokens.schema.fields if f.name != "decoded"]
    schema = T.StructType([*kept, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [None if ids is None else model.decode(ids) for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(texts, pa.string())], [f.name for f in schema]
            )

    return tokens.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of the round trip of every text, as ``encode`` defines it."""
    narrow = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    coded = encode(narrow, path, text_col, round_trip=True, keep_text=False)
    return coded.select(
        F.col(f"`{id_col}`"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
