"""Token files: ids packed by Simple-8b into 64-bit words, in pages with an offset for every block of ids.

A word holds a selector in its top 4 bits and 60 bits of ids, the first id lowest. Selector k packs
COUNTS[k] ids of WIDTHS[k] bits; ESCAPE says that the next word is one id as it is. Blocks of BLOCK
ids are coded on their own, so that all blocks of a page are encoded and decoded together. A page is
a row of a Parquet dataset and holds whole documents.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import gather, new_path, slices, text_bytes
from tidemark.llm.near_dedup import BYTE_VALUES, mixed
from tidemark.llm.runs import pieces

BLOCK = 1024
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
COUNTS = 60 // WIDTHS
ESCAPE = 15
RARE = 1e-4
TEXT_AT_ONCE = 6 << 20
CACHED_PIECES = 1_000_000
WORDS_AT_ONCE = 4096
SMALL_BITS = 17
PAGE = "shard int, page int, doc_ids array<long>, doc_tokens array<long>, n_ids long, block_words array<int>, words binary"


def _width_classes(ids: np.ndarray) -> np.ndarray:
    """The place in WIDTHS of the smallest width that holds each id; len(WIDTHS) if none does."""
    if not len(ids) or int(ids.max()) >= 1 << SMALL_BITS:
        return np.searchsorted(np.uint64(1) << WIDTHS.astype(np.uint64), ids, side="right").astype(np.uint8)
    return _small_classes()[ids.astype(np.int64)]


@functools.cache
def _small_classes() -> np.ndarray:
    return np.searchsorted(1 << WIDTHS, np.arange(1 << SMALL_BITS), side="right").astype(np.uint8)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of all blocks, and how many words each block has. ids: unsigned 64-bit."""
    ids = np.asarray(ids, np.uint64)
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # ids beyond a block's end count as 0
    padded, needed = np.zeros((blocks, BLOCK + 60), np.uint64), np.zeros((blocks, BLOCK + 60), np.uint8)
    padded[:, :BLOCK].flat[: len(ids)] = ids
    needed[:, :BLOCK].flat[: len(ids)] = _width_classes(ids)
    sizes = np.full(blocks, BLOCK)
    sizes[-1] = len(ids) - (blocks - 1) * BLOCK
    # choice[b, i]: the selector of most ids that can start at i; column BLOCK stands for a block's end
    choice = np.full((blocks, BLOCK + 1), ESCAPE, np.uint8)
    for k in range(len(WIDTHS) - 1, -1, -1):
        fits = needed <= k
        # a selector that would hardly ever fit isn't looked for: the words stay right, with a few ids less in them
        if (np.count_nonzero(fits) / fits.size) ** COUNTS[k] < RARE:
            continue
        # by doubling: fits[i] for runs of 1, 2, 4, ... ids, then two overlapping runs make the full count
        run, width = fits, 1
        while 2 * width <= COUNTS[k]:
            run = run[:, : run.shape[1] - width] & run[:, width:]
            width *= 2
        rest = COUNTS[k] - width
        np.copyto(choice[:, :BLOCK], k, where=run[:, :BLOCK] & run[:, rest : rest + BLOCK])
    taken = np.append(COUNTS, [0] * (ESCAPE - len(COUNTS)) + [1])[choice].reshape(-1)
    starts = np.zeros(blocks * (BLOCK + 1), bool)
    at = np.arange(blocks) * (BLOCK + 1)
    ends = at + sizes
    while len(at):
        starts[at] = True
        at = at + taken[at]
        live = at < ends
        if not live.all():
            at, ends = at[live], ends[live]
    at = np.flatnonzero(starts)
    row, selector = at // (BLOCK + 1), choice.reshape(-1)[at]
    at = at + row * (padded.shape[1] - BLOCK - 1)  # the place of a word's first id among the padded ids
    padded = padded.reshape(-1)
    length = 1 + (selector == ESCAPE)
    place = np.cumsum(length) - length
    words = np.zeros(int(length.sum()), np.uint64)
    for k, (count, width) in enumerate(zip(COUNTS, WIDTHS)):
        own = np.flatnonzero(selector == k)
        if len(own):
            first, values = at[own], np.full(len(own), k << 60, np.uint64)
            for j in range(count):
                values |= padded[first + j] << np.uint64(j * width)
            words[place[own]] = values
    own = np.flatnonzero(selector == ESCAPE)
    words[place[own]] = np.uint64(ESCAPE << 60)
    words[place[own] + 1] = padded[at[own]]
    return words, np.bincount(row, weights=length, minlength=blocks).astype(np.int64)


def unpack(words: np.ndarray, block_words: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids of a page; a block's words begin where those of the blocks before it end."""
    words = np.asarray(words, np.uint64)
    if not n_ids:
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    # the word after an escape is no selector word; it may look like an escape itself
    for at in np.flatnonzero(selector == ESCAPE):
        if not raw[at]:
            raw[at + 1] = True
    escape = (selector == ESCAPE) & ~raw
    count = np.where(raw, 0, np.append(COUNTS, [0] * (ESCAPE - len(COUNTS)) + [1])[selector])
    block = np.repeat(np.arange(len(block_words)), block_words)
    before = np.cumsum(count) - count
    first = np.concatenate([[0], np.cumsum(block_words)])[:-1]
    place = block * BLOCK + before - before[first][block]
    out = np.zeros(len(block_words) * BLOCK + 60, np.uint64)
    for k, (n, width) in enumerate(zip(COUNTS, WIDTHS)):
        own = np.flatnonzero((selector == k) & ~raw)
        if len(own):
            shifts = np.arange(n, dtype=np.uint64) * np.uint64(width)
            values = (words[own][:, None] >> shifts) & np.uint64((1 << int(width)) - 1)
            to = place[own][:, None] + np.arange(n)
            inside = to < (block[own] + 1)[:, None] * BLOCK
            out[to[inside]] = values[inside]
    out[place[escape]] = words[np.flatnonzero(escape) + 1]
    return out[:n_ids]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; none is empty."""
    sizes = np.diff(offsets)
    powers = np.cumprod(np.full(int(sizes.max(initial=1)), 0x9E3779B97F4A7C15, np.uint64))
    place = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    return mixed(np.add.reduceat(BYTE_VALUES[data] * powers[place], offsets[:-1]))


class Encoder:
    """The library's ids of whole texts, each distinct pre-token being encoded once and kept for later texts.

    Words kept are found by their hashes, which are sorted, and then compared byte by byte. Of words of the same
    hash the last one is found; the others are encoded again whenever they come.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # sorted; which word has the hash
        self.text, self.text_ends = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _found(self, data: np.ndarray, offsets: np.ndarray, hashes: np.ndarray, order: np.ndarray) -> np.ndarray:
        """The number of each word, -1 where it isn't kept. order: of the hashes."""
        number = np.full(len(hashes), -1, np.int64)
        if not len(self.hashes):
            return number
        at = np.minimum(np.searchsorted(self.hashes, hashes[order]), len(self.hashes) - 1)
        met = self.hashes[at] == hashes[order]
        word, kept = order[met], self.numbers[at[met]].astype(np.int64)
        sizes = np.diff(offsets)[word]
        alike = sizes == self.text_ends[kept + 1] - self.text_ends[kept]
        word, kept, sizes = word[alike], kept[alike], sizes[alike]
        if len(word):
            same = data[gather(offsets[word], sizes)] == self.text[gather(self.text_ends[kept], sizes)]
            whole = np.logical_and.reduceat(same, np.cumsum(sizes) - sizes)
            number[word[whole]] = kept[whole]
        return number

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, sizes = [self.flat[:0]], [np.zeros(0, np.int64)]
        for first in range(0, len(words), WORDS_AT_ONCE):
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(words[first : first + WORDS_AT_ONCE], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat.append(np.fromiter(chain.from_iterable(ids), np.int32, int(sizes[-1].sum())))
        return np.concatenate(flat), np.concatenate(sizes)

    def _look_up(self, words: pa.Array) -> np.ndarray:
        """Each word's number: its ids are those from ends[number] to ends[number + 1] of flat."""
        data, offsets = text_bytes(words)
        hashes = word_hashes(data, offsets)
        order = np.argsort(hashes)
        number = self._found(data, offsets, hashes, order)
        new = order[number[order] < 0]
        if len(self.ends) + len(new) > CACHED_PIECES:
            self._forget()
            number[:], new = -1, order
        if len(new):
            number[new] = np.arange(len(new)) + len(self.ends) - 1
            ids, sizes = self._encode_words(words.take(pa.array(new)).to_pylist())
            lengths = np.diff(offsets)[new]
            self.text = np.concatenate([self.text, data[gather(offsets[new], lengths)]])
            self.text_ends = np.concatenate([self.text_ends, self.text_ends[-1] + np.cumsum(lengths)])
            self.flat = np.concatenate([self.flat, ids])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            at = np.searchsorted(self.hashes, hashes[new])
            self.hashes = np.insert(self.hashes, at, hashes[new])
            self.numbers = np.insert(self.numbers, at, number[new])
        return number

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has. Null counts as empty."""
        texts = column.cast(pa.large_string()).fill_null("")
        whole = np.zeros(len(texts), bool)
        for special in self.special:
            whole |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        if whole.any():
            data, offsets = text_bytes(pc.if_else(pa.array(whole), pa.scalar("", pa.large_string()), texts))
        else:
            data, offsets = text_bytes(texts)
        found = pieces(data, offsets, join_space=True, single_numbers=False)
        number = self._look_up(found.words)[found.codes] if len(found.codes) else np.zeros(0, np.int64)
        starts = self.ends[number]
        sizes = self.ends[number + 1] - starts
        out = self.flat[gather(starts, sizes)]
        sums = np.concatenate([[0], np.cumsum(sizes)])
        counts = sums[found.first[1:]] - sums[found.first[:-1]]
        if whole.any():  # texts that hold a special string are left to the library
            parts = np.split(out, np.cumsum(counts)[:-1])
            for at in np.flatnonzero(whole):
                parts[at] = np.array(self.tokenizer.encode(texts[int(at)].as_py(), add_special_tokens=False).ids, np.int32)
                counts[at] = len(parts[at])
            out = np.concatenate(parts)
        return out, counts


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id: str = "doc_id", text: str = "text"
) -> None:
    """Write the ids of all whole texts, in ascending order of id, each followed by end_id.

    Shard s holds smaller ids than shard s + 1. Null texts count as empty; rows that repeat an id
    stay, in order of their texts; a null id comes first. An empty table gives a dataset without pages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, shard, page = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text", TEXT_AT_ONCE):
            ids, counts = tool.encode(batch.column(1))
            ended = np.insert(ids, np.cumsum(counts), end_id)
            words, block_words = pack(ended)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([page], pa.int32()),
                    pa.array([batch.column(0).to_pylist()], pa.list_(pa.int64())),
                    pa.array([counts + 1], pa.list_(pa.int64())),
                    pa.array([len(ended)], pa.int64()),
                    pa.array([block_words], pa.list_(pa.int32())),
                    pa.array([words.astype("<u8").tobytes()], pa.binary()),
                ],
                ["shard", "page", "doc_ids", "doc_tokens", "n_ids", "block_words", "words"],
            )
            page += 1

    spark = docs.sparkSession
    read = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = read.repartitionByRange(shards, "id", F.xxhash64("text")).sortWithinPartitions("id", "text")
    ordered.mapInArrow(run, PAGE).write.parquet(path)


def read_token_files(spark, path: str, ids: bool = True) -> DataFrame:
    """doc_id, start (ids before the document), n_tokens, ids_crc32, and ids as little-endian unsigned 32-bit integers.

    ids: False leaves out that column, which needn't be handed to Spark then; ids_crc32 is of the ids read either way. start comes from the number of ids in the shards and pages before: a table of one row a page.
    """
    pages = spark.read.schema(PAGE).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = memoryview(unpack(np.frombuffer(row["words"], "<u8"), np.array(row["block_words"], np.int64), row["n_ids"]).astype("<u4").tobytes())
                counts = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(counts)
                bits = [data[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), counts.tolist())]
                n = len(counts)
                columns = [
                    pa.array([row["shard"]] * n, pa.int32()),
                    pa.array([row["page"]] * n, pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(ends - counts, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([zlib.crc32(b) for b in bits], pa.int64()),
                ]
                if ids:
                    columns.append(pa.array(map(bytes, bits), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["shard", "page", "doc_id", "within", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    sizes = pages.select("shard", "page", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    shards = shards.withColumn("before", F.sum("total").over(Window.orderBy("shard")) - F.col("total"))
    within = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("page")) - F.col("n_ids")
    starts = sizes.withColumn("page_start", within).join(shards, "shard").select("shard", "page", (F.col("page_start") + F.col("before")).alias("base"))
    docs = pages.mapInArrow(run, "shard int, page int, doc_id long, within long, n_tokens long, ids_crc32 long" + ", ids binary" * ids)
    start = (F.col("base") + F.col("within")).alias("start")
    return docs.join(starts, ["shard", "page"]).select("doc_id", start, "n_tokens", "ids_crc32", *["ids"] * ids)


def token_file_digest(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from token files just written."""
    path = new_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer_path, end_id)
    return read_token_files(docs.sparkSession, path, ids=False)
