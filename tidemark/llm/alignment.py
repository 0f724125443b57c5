"""Alignment of two tokenizers' tokens by merging their byte ends along a merge path.

Both tokenizers encode the same bytes, a space and the text. The ends of the A tokens and of the B
tokens are two sorted lists; diagonals of the merge grid, found by binary search, cut their merging
into pieces of PIECE steps that know nothing of one another and advance side by side. Each step emits
an overlap; where both lists have the same end, which may lie on the border of two pieces, a group of
tokens is closed. How many documents hold an id pair is counted over the whole table.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import byte_symbols
from tidemark.llm.frames import gather, kept, slices, text_bytes
from tidemark.llm.runs import Pieces, pieces

PIECE = 512
TEXT_AT_ONCE = 2 << 20
CACHED_PIECES = 400_000
COMMON_PAIRS = 1 << 19
PAIRS_AT_ONCE = 4 << 20


class Tokens:
    """The tokens of all texts of a batch: ids, byte ends in the batch, tokens before each text."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, first: np.ndarray):
        self.ids, self.ends, self.first = ids, ends, first


class Side:
    """A tokenizer that encodes pieces of a text independently; every distinct piece is encoded once."""

    def __init__(self, cut: Callable[[np.ndarray, np.ndarray], Pieces], encode: Callable[[list[str]], list[list[int]]], strings: list[bytes]):
        self.cut, self.encode, self.strings = cut, encode, strings
        self.lengths = np.array([len(s) for s in strings], np.int64)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.starts = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.sizes, self.exact = np.zeros(0, np.int32), np.zeros(0, bool)

    def _look_up(self, words: list[str]) -> np.ndarray:
        """Each word's place in starts, sizes and exact (its tokens' bytes are its own)."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > CACHED_PIECES:
            self._forget()
            new = words
        if new:
            ids, strings = self.encode(new), self.strings
            sizes = np.fromiter(map(len, ids), np.int32, len(ids))
            exact = np.fromiter((b"".join([strings[i] for i in own]) == w.encode("utf-8") for own, w in zip(ids, new)), bool, len(ids))
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
            self.sizes, self.exact = np.concatenate([self.sizes, sizes]), np.concatenate([self.exact, exact])
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))])
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def tokens(self, data: np.ndarray, offsets: np.ndarray) -> tuple[Tokens, np.ndarray]:
        """The tokens of all texts, and for each text whether its tokens' bytes are the text."""
        found = self.cut(data, offsets)
        place = self._look_up(found.words.to_pylist())[found.codes] if len(found.codes) else np.zeros(0, np.int64)
        ids = self.flat[gather(self.starts[place], self.sizes[place])].astype(np.int64)
        sums = np.concatenate([[0], np.cumsum(self.sizes[place])])
        wrong = np.concatenate([[0], np.cumsum(~self.exact[place])])
        exact = wrong[found.first[1:]] == wrong[found.first[:-1]]
        return Tokens(ids, np.cumsum(self.lengths[ids]), sums[found.first]), exact


@functools.cache
def byte_level_side(path: str) -> Side:
    """A byte-level BPE of the tokenizers library; strings of special tokens inside texts are plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(path)
    tool.no_truncation()
    tool.no_padding()
    tool.encode_special_tokens = True
    with open(path, encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    byte_of = {s: b for b, s in enumerate(byte_symbols())}
    strings = [b""] * (max(vocab.values(), default=-1) + 1)
    for entry, i in vocab.items():
        strings[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else b""

    def cut(data: np.ndarray, offsets: np.ndarray) -> Pieces:
        return pieces(data, offsets, join_space=True, single_numbers=False)

    def encode(words: list[str]) -> list[list[int]]:
        return [e.ids for e in tool.encode_batch_fast(words, add_special_tokens=False)]

    return Side(cut, encode, strings)


@functools.cache
def piece_side(path: str) -> Side:
    """A sentencepiece model, which puts a space before a text and cuts it at spaces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any("▁" in n.lstrip("▁") for n in names):
        raise ValueError("pieces of this vocabulary cross spaces, so texts can't be encoded by units")
    strings = [bytes([int(n[3:5], 16)]) if model.is_byte(i) else n.replace("▁", " ").encode("utf-8") for i, n in enumerate(names)]
    space = [model.piece_to_id("▁")]

    def cut(data: np.ndarray, offsets: np.ndarray) -> Pieces:
        blank = data == 0x20
        marks = np.zeros(len(data) + 1, bool)
        marks[offsets] = True
        marks[1 : len(data)] |= blank[1:] & ~blank[:-1]
        return Pieces(data, offsets, np.flatnonzero(marks[: len(data)]))

    def encode(units: list[str]) -> list[list[int]]:
        # the space that a unit starts with is the one the model adds; for an empty text it adds none
        return [ids if len(u) > 1 else space for u, ids in zip(units, model.encode([u[1:] for u in units], num_threads=1))]

    return Side(cut, encode, strings)


def merge_path(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge two strictly ascending lists, equal values of a first.

    For every merged element: how many of a and of b come before it, and whether it is one of a.
    Piece p merges the elements from p * piece on; a binary search along the diagonal i + j = p * piece
    says with how many of a it starts.
    """
    total = len(a) + len(b)
    at_a, at_b, from_a = np.zeros(total, np.int64), np.zeros(total, np.int64), np.zeros(total, bool)
    diagonals = np.arange(0, total, piece)
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        first = np.zeros(len(low), bool)
        first[open_] = a[middle[open_]] <= b[diagonals[open_] - 1 - middle[open_]]
        low = np.where(open_ & first, middle + 1, low)
        high = np.where(open_ & ~first, middle, high)
    i, j = low, diagonals - low
    a_end, b_end = np.append(a, np.iinfo(np.int64).max), np.append(b, np.iinfo(np.int64).max)
    for step in range(min(piece, total)):
        if diagonals[-1] + step >= total:  # the last piece may be shorter
            diagonals, i, j = diagonals[:-1], i[:-1], j[:-1]
            if not len(diagonals):
                break
        take = a_end[i] <= b_end[j]
        at = diagonals + step
        at_a[at], at_b[at], from_a[at] = i, j, take
        i, j = i + take, j + ~take
    return at_a, at_b, from_a


@functools.lru_cache(maxsize=2)
def _id_texts(count: int) -> pa.Array:
    """Every id in decimal with each of the three signs that can follow it."""
    return pa.array([f"{i}{sign}" for i in range(count) for sign in ",|;"], pa.string())


class Aligned:
    """The alignment of a batch's texts; texts whose tokens don't give back the text have no tokens."""

    def __init__(self, column: pa.Array, left: Side, right: Side, piece: int = PIECE):
        texts = column.cast(pa.large_string()).fill_null("")
        spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))
        present = pc.greater(pc.binary_length(texts), 0)
        data, offsets = text_bytes(pc.if_else(present, spaced, pa.scalar("", pa.large_string())))
        # wrong tokens of one text would shift the ends of those after it, so such texts go before the ends are merged
        a, exact_a = left.tokens(data, offsets)
        b, exact_b = right.tokens(data, offsets)
        good = exact_a & exact_b
        a, b = (_only(t, good, side) for t, side in ((a, left), (b, right)))
        at_a, at_b, from_a = merge_path(a.ends, b.ends, piece)
        before = np.maximum(at_a - 1, 0)
        # an end of b that is also the last end taken from a: both lists end here, so a group is closed
        both = ~from_a & (at_a > 0) & (a.ends[before] == b.ends[np.minimum(at_b, len(b.ends) - 1)]) if len(a.ends) else ~from_a
        links = from_a | ~both
        self.n_a, self.n_b = np.diff(a.first), np.diff(b.first)
        owner = np.repeat(np.arange(len(texts)), self.n_a)
        self.link_text, self.link_a, self.link_b = owner[at_a[links]], a.ids[at_a[links]], b.ids[at_b[links]]
        self.close_a, self.close_b = at_a[both], at_b[both] + 1
        self.n_groups = np.bincount(owner[self.close_a - 1], minlength=len(texts)).astype(np.int64)
        self.n_links = np.bincount(self.link_text, minlength=len(texts)).astype(np.int64)
        self.a, self.b, self.ids = a, b, max(len(left.strings), len(right.strings))

    def group_texts(self) -> list[bytes]:
        """For each text `a1,a2|b1;a3|b2,b3`: ids of A and B group by group."""
        n_a, n_b = len(self.a.ids), len(self.b.ids)
        i, j = np.arange(n_a), np.arange(n_b)
        group_a, group_b = (np.searchsorted(c, k, side="right") for c, k in ((self.close_a, i), (self.close_b, j)))
        place_a = i + np.concatenate([[0], self.close_b])[group_a]
        place_b = j + self.close_a[group_b]
        said = np.zeros(n_a + n_b, np.int64)
        said[place_a] = 3 * self.a.ids + (i + 1 == self.close_a[group_a])
        said[place_b] = 3 * self.b.ids + 2 * (j + 1 == self.close_b[group_b])
        data, offsets = text_bytes(_id_texts(self.ids).take(pa.array(said)))
        ends, data = offsets[self.a.first + self.b.first], data.tobytes()
        return [data[s : e - 1] if e > s else b"" for s, e in zip(ends[:-1], ends[1:])]


def _only(tokens: Tokens, good: np.ndarray, side: Side) -> Tokens:
    sizes = np.diff(tokens.first)
    if good.all():
        return tokens
    ids = tokens.ids[np.repeat(good, sizes)]
    return Tokens(ids, np.cumsum(side.lengths[ids]), np.concatenate([[0], np.cumsum(np.where(good, sizes, 0))]))


def alignments(docs: DataFrame, byte_level_path: str, piece_path: str, id: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """row, id, n_a, n_b, n_groups, n_links, groups, pairs (distinct, ascending), uses (links of each pair).

    groups is the text of `group_texts`, or its SHA-256 where digest is set (empty without tokens).
    A pair is the A id times a power of two plus the B id. Null and empty texts, and texts that the
    tokens of one side don't give back, have no tokens. Repeated rows and ids stay separate rows; an
    empty table gives an empty result; further columns of docs are not read.
    """
    shift, bits, kind, arrow = _pair_kind(byte_level_path, piece_path)

    def said(groups: bytes) -> str:
        return sha256(groups).hexdigest() if digest and groups else groups.decode("ascii")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = byte_level_side(byte_level_path), piece_side(piece_path)
        for batch in slices(batches, "text", TEXT_AT_ONCE):
            done = Aligned(batch.column(2), left, right)
            keys, uses = np.unique(done.link_text << bits | done.link_a << shift | done.link_b, return_counts=True)
            first = pa.array(np.searchsorted(keys >> bits, np.arange(batch.num_rows + 1)), pa.int32())
            values = (pa.array(keys & ((1 << bits) - 1), arrow), pa.array(uses, pa.int32()))
            pair_lists = [pa.ListArray.from_arrays(first, v) for v in values]
            numbers = [pa.array(n, pa.int64()) for n in (done.n_a, done.n_b, done.n_groups, done.n_links)]
            groups = pa.array(list(map(said, done.group_texts())), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *numbers, groups, *pair_lists],
                ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "uses"],
            )

    id_kind = docs.schema[id].dataType.simpleString()
    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"), F.col(text).alias("text"))
    columns = f"row long, id {id_kind}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<{kind}>, uses array<int>"
    return read.mapInArrow(run, columns)


def _pair_kind(byte_level_path: str, piece_path: str) -> tuple[int, int, str, pa.DataType]:
    """Bits of a B id and of a whole pair, and the smallest type that holds a pair."""
    bits_a, bits_b = (max(len(side.strings) - 1, 1).bit_length() for side in (byte_level_side(byte_level_path), piece_side(piece_path)))
    if bits_a + bits_b <= 31:
        return bits_b, bits_a + bits_b, "int", pa.int32()
    return bits_b, bits_a + bits_b, "long", pa.int64()


def pair_counts(aligned: DataFrame, shift: int) -> DataFrame:
    """pair, n (documents that hold it linked), best (no pair of its A id is in more documents).

    Tasks count what they read before anything is shuffled; the highest counts are one row for each
    id of A's vocabulary.
    """
    kind = aligned.schema["pairs"].dataType.elementType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n, pa.int64())], ["pair", "n"])

        for batch in batches:
            held.append(batch.column(0).flatten().to_numpy(zero_copy_only=False))
            size += len(held[-1])
            if size >= PAIRS_AT_ONCE:
                yield counted()
                held, size = [], 0
        if size:
            yield counted()

    partial = aligned.select("pairs").mapInArrow(count, f"pair {kind}, n long")
    counts = kept(partial.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    of_a = F.shiftright("pair", shift)
    highest = counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("highest"))
    return counts.join(highest, of_a == F.col("a")).select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def common_pairs(counts: DataFrame, most: int = COMMON_PAIRS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs in the most documents, at most `most`, ascending, with their counts and whether they are best.

    Counts are first counted by powers of two, so no more than `most` rows come to the driver.
    """
    power = F.floor(F.log2("n")).cast("int")
    sizes = sorted(counts.groupBy(power.alias("power")).agg(F.count("*").alias("pairs")).collect(), reverse=True)
    least, total = 64, 0
    for row in sizes:
        total += row.pairs
        if total > most:
            break
        least = row.power
    chosen = counts.where(power >= least).toArrow()
    pairs, n, best = (chosen.column(c).to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(pairs)
    return pairs[order], n[order], best[order].astype(bool)


def align(docs: DataFrame, byte_level_path: str, piece_path: str, id: str = "doc_id", text: str = "text", common: int = COMMON_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of docs.

    n_best counts links whose pair is in as many documents as any pair of its A id; count_sum adds up
    the documents of all links' pairs. Pairs in the most documents, at most `common` of them, go to
    every task (8 MB); all others are joined by a shuffle. Odd rows are treated as in `alignments`.
    """
    shift, _, kind, _ = _pair_kind(byte_level_path, piece_path)
    aligned = kept(alignments(docs, byte_level_path, piece_path, id, text, digest=True), "aligned")
    counts = kept(pair_counts(aligned, shift), "pairs")
    table = docs.sparkSession.sparkContext.broadcast(common_pairs(counts, common))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = table.value
        for batch in batches:
            *others, own_pairs, own_uses = batch.columns
            own, uses = (c.flatten().to_numpy(zero_copy_only=False) for c in (own_pairs, own_uses))
            ends = own_pairs.offsets.to_numpy() - own_pairs.offsets[0].as_py()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            place = np.searchsorted(pairs, own)
            place[place == len(pairs)] = 0
            known = pairs[place] == own if len(pairs) else np.zeros(len(own), bool)
            here = place[known]
            n_best = np.bincount(owner[known], weights=uses[known] * best[here], minlength=batch.num_rows).astype(np.int64)
            sums = np.zeros(len(own) + 1, np.int64)
            sums[1:][known] = uses[known] * n[here]
            rest = np.flatnonzero(~known)
            first = np.searchsorted(owner[rest], np.arange(batch.num_rows + 1))
            items = pa.StructArray.from_arrays([pa.array(own[rest]), pa.array(uses[rest])], ["pair", "uses"])
            added = [pa.array(n_best), pa.array(np.diff(np.cumsum(sums)[ends])), pa.ListArray.from_arrays(pa.array(first, pa.int32()), items)]
            yield pa.RecordBatch.from_arrays([*others, *added], [*batch.schema.names[:-2], "best_common", "sum_common", "rest"])

    columns = ", ".join(f"{c} {k}" for c, k in aligned.dtypes[:-2])
    found = aligned.mapInArrow(look_up, f"{columns}, best_common long, sum_common long, rest array<struct<pair: {kind}, uses: int>>")
    found = kept(found, "looked-up")
    rare = found.select("row", F.inline("rest")).join(counts, "pair").groupBy("row")
    rare = rare.agg(F.sum(F.when(F.col("best"), F.col("uses"))).alias("best_rare"), F.sum(F.col("uses") * F.col("n")).alias("sum_rare"))
    return found.join(rare, "row", "left").select(
        F.col("id").alias(id),
        *("n_a", "n_b", "n_groups", "n_links"),
        (F.col("best_common") + F.coalesce("best_rare", F.lit(0))).alias("n_best"),
        (F.col("sum_common") + F.coalesce("sum_rare", F.lit(0))).alias("count_sum"),
        F.col("groups").alias("groups_sha256"),
    )
