"""Benchmark decontamination: Wu-Manber search for all windows of test items in documents.

Texts become lower-case words with one space around each, so that an occurrence of a window is an
occurrence of its string. The search looks at a block of characters where a window's first part
would end; a table says how far it may jump, and where it may not, the hash of that block selects
the few windows that are then compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.frames import gather, kept, slices, text_bytes

WINDOW = 10
ITEMS_AT_ONCE = 20_000
ITEM_BYTES_AT_ONCE = 16 << 20
TABLE_BITS = 18
LANE = 4096


def _word_bytes() -> np.ndarray:
    keep = np.zeros(256, bool)
    keep[0x30:0x3A] = keep[0x61:0x7B] = keep[0x80:] = True
    return keep


WORD = _word_bytes()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class Words:
    """The words of a batch of texts as one buffer: every text begins with a space, every word ends with one."""

    def __init__(self, column: pa.Array):
        data, offsets = text_bytes(column)
        data = LOWER[data]
        inside = WORD[data]
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        at_start = np.zeros(len(data) + 1, bool)
        at_start[offsets] = True
        starts |= inside & at_start[:-1]
        begin = np.flatnonzero(starts)
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        ends |= inside & at_start[1:]
        length = np.flatnonzero(ends) + 1 - begin
        self.first = np.searchsorted(begin, offsets)  # the first word of each text
        self.n_words = np.diff(self.first)
        texts = len(offsets) - 1
        owner = np.repeat(np.arange(texts), self.n_words)
        # a word's place: all words before it with their spaces, and a space for each text up to its own
        before = np.cumsum(length + 1) - (length + 1)
        self.begin = before + owner + 1
        self.buffer = np.full(int((length + 1).sum()) + texts, 0x20, np.uint8)
        if len(begin):
            self.buffer[gather(self.begin, length)] = data[gather(begin, length)]
        self.text_begin = np.concatenate([[0], np.cumsum(length + 1)])[self.first] + np.arange(texts + 1)
        self.length = length


def _block_hash(codes: np.ndarray, size: int) -> np.ndarray:
    """The hash of the block of `size` bytes that ends at each place, for places from size - 1 on."""
    value = np.zeros(len(codes) - size + 1, np.uint64)
    for k in range(size):
        value = value * np.uint64(0x100000001B3) + codes[k : len(codes) - size + 1 + k]
    return ((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


class Matcher:
    """Wu-Manber tables over windows of at least `shortest` bytes."""

    def __init__(self, windows: list[tuple[bytes, int, int]]):
        """windows: string with its spaces, number of words, item."""
        self.windows = windows
        self.shortest = min(len(w[0]) for w in windows)
        self.block = min(6, self.shortest)
        self.shift = np.full(1 << TABLE_BITS, self.shortest - self.block + 1, np.int32)
        buckets: dict[int, list[int]] = {}
        joined = np.frombuffer(b"".join(w[0][: self.shortest] for w in windows), np.uint8).reshape(len(windows), self.shortest)
        for end in range(self.block, self.shortest + 1):
            hashed = np.zeros(len(windows), np.uint64)
            for k in range(self.block):
                hashed = hashed * np.uint64(0x100000001B3) + joined[:, end - self.block + k]
            hashed = ((hashed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
            np.minimum.at(self.shift, hashed, self.shortest - end)
        for number, h in enumerate(hashed):
            buckets.setdefault(int(h), []).append(number)
        self.buckets = buckets

    def _hash_at(self, buffer: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = np.zeros(len(ends), np.uint64)
        for k in range(self.block):
            value = value * np.uint64(0x100000001B3) + buffer[ends - self.block + k]
        return ((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def search(self, buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places at which a window begins, and the window's number; lanes of the buffer are searched side by side."""
        ends = np.arange(self.shortest, len(buffer) + 1, LANE)
        stop = np.minimum(ends + LANE, len(buffer) + 1)
        stops_at, stops_hash = [], []
        while len(ends):
            hashed = self._hash_at(buffer, ends)
            jump = self.shift[hashed]
            stopped = jump == 0
            if stopped.any():
                stops_at.append(ends[stopped])
                stops_hash.append(hashed[stopped])
            ends = ends + np.maximum(jump, 1)
            live = ends < stop
            ends, stop = ends[live], stop[live]
        if not stops_at:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        text = buffer.tobytes()
        places, numbers = [], []
        for end, hashed in zip(np.concatenate(stops_at).tolist(), np.concatenate(stops_hash).tolist()):
            begin = end - self.shortest
            if text[begin] != 0x20:
                continue
            for number in self.buckets.get(hashed, ()):
                if text.startswith(self.windows[number][0], begin):
                    places.append(begin)
                    numbers.append(number)
        return np.array(places, np.int64), np.array(numbers, np.int64)


def item_windows(items: list[tuple[str | None, str | None]]) -> list[tuple[bytes, int, list[str | None]]]:
    """Each distinct window of the items: its string, its number of words and the items that hold it."""
    found: dict[bytes, tuple[int, set[str | None]]] = {}
    words = Words(pa.array([text for _, text in items], pa.large_string()))
    buffer = words.buffer.tobytes()
    for k, (item, _) in enumerate(items):
        first, last = int(words.first[k]), int(words.first[k + 1])
        size = min(WINDOW, last - first)
        if not size:
            continue
        for at in range(first, last - size + 1):
            end = at + size - 1
            window = buffer[words.begin[at] - 1 : words.begin[end] + words.length[end] + 1]
            found.setdefault(window, (size, set()))[1].add(item)
    return [(w, size, in_order(names)) for w, (size, names) in found.items()]


def in_order(names: set[str | None]) -> list[str | None]:
    """Sorted as strings, null first."""
    return sorted(names, key=lambda n: (n is not None, n or ""))


def matchers(items: list[tuple[str, str | None]]) -> list[tuple[Matcher, list[list[str]]]]:
    """Tables for long and for short windows, since the shortest window bounds every jump."""
    windows = item_windows(items)
    out = []
    for low, high in ((0, 8), (8, 24), (24, 48), (48, 1 << 62)):
        own = [w for w in windows if low <= len(w[0]) < high]
        if own:
            out.append((Matcher([(w, n, 0) for w, n, _ in own]), [names for _, _, names in own]))
    return out


def find(column: pa.Array, tables: list[tuple[Matcher, list[list[str]]]]) -> tuple[np.ndarray, list[np.ndarray], list[set[str]]]:
    """For each text: number of words, the numbers of the words that are hit, the items that occur."""
    words = Words(column)
    texts = len(words.n_words)
    hit = np.zeros(len(words.begin) + 1, np.int64)
    items: list[set[str]] = [set() for _ in range(texts)]
    for matcher, names in tables:
        places, numbers = matcher.search(words.buffer)
        if not len(places):
            continue
        first = np.searchsorted(words.begin, places + 1)
        size = np.array([matcher.windows[n][1] for n in numbers])
        np.add.at(hit, first, 1)
        np.add.at(hit, first + size, -1)
        owner = np.searchsorted(words.first, first, side="right") - 1
        for text, number in set(zip(owner.tolist(), numbers.tolist())):
            items[text].update(names[number])
    covered = np.cumsum(hit[:-1]) > 0
    return words.n_words, [covered[words.first[k] : words.first[k + 1]] for k in range(texts)], items


def benchmark_shards(benchmark: DataFrame, id: str, text: str) -> Iterator[tuple[list[tuple[str | None, str | None]], bool]]:
    """The items in groups of about ITEMS_AT_ONCE and ITEM_BYTES_AT_ONCE, one after the other, and whether more follow."""
    items = benchmark.select(F.col(id).cast("string").alias("id"), F.col(text).alias("text"))
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    shards = max(-(-size.n // ITEMS_AT_ONCE), -(-(size.bytes or 0) // ITEM_BYTES_AT_ONCE), 1)
    part = F.pmod(F.xxhash64("id", "text"), F.lit(shards))
    for k in range(shards):
        yield [tuple(r) for r in (items.where(part == k) if shards > 1 else items).collect()], k + 1 < shards


def contamination(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """doc_id, n_words, hits (array of word numbers), items (array of item ids, sorted as strings), for every row.

    A window is WINDOW consecutive words of an item, or all words of a shorter item. Null texts have
    no words, as have items of null text; an item id that occurs twice counts as one item, and so do
    all items without an id, as a null in items. Repeated rows stay; empty tables give no rows or no
    hits; further columns are not read. A large benchmark is searched for shard by shard, the results
    being written in between, so that the driver and a search hold one shard.
    """
    kind = docs.schema[id].dataType.simpleString()
    schema = f"id {kind}, text string, n_words long, hits array<int>, items array<string>"
    out = docs.select(
        F.col(id).alias("id"),
        F.col(text).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<int>").alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    for shard, more in benchmark_shards(benchmark, item_id, item_text):
        tables = docs.sparkSession.sparkContext.broadcast(matchers(shard))

        def run(batches: Iterator[pa.RecordBatch], tables=tables) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                n_words, covered, items = find(batch.column(1), tables.value)
                hits = [np.flatnonzero(c).astype(np.int32) for c in covered]
                for k in range(batch.num_rows):
                    if before := batch.column(3)[k].as_py():
                        hits[k] = np.union1d(hits[k], np.array(before, np.int32))
                    items[k].update(batch.column(4)[k].as_py())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(n_words, pa.int64()),
                        pa.array(hits, pa.list_(pa.int32())),
                        pa.array(list(map(in_order, items)), pa.list_(pa.string())),
                    ],
                    ["id", "text", "n_words", "hits", "items"],
                )

        out = out.mapInArrow(run, schema)
        if more:
            out = kept(out, "searched")
            tables.destroy()
    return out.drop("text").withColumnRenamed("id", id)


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = contamination(docs, benchmark)
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are, in whose texts no window of an item occurs."""
    out = docs
    at = docs.columns.index(text)
    for shard, more in benchmark_shards(benchmark, "item_id", "text"):
        tables = docs.sparkSession.sparkContext.broadcast(matchers(shard))

        def run(batches: Iterator[pa.RecordBatch], tables=tables) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, text):
                _, covered, _ = find(batch.column(at), tables.value)
                yield batch.filter(pa.array([not c.any() for c in covered], pa.bool_()))

        out = out.mapInArrow(run, T.StructType(docs.schema.fields))
        if more:
            out = kept(out, "searched")
            tables.destroy()
    return out
