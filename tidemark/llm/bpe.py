"""Byte-pair encoding by a heap of merge ranks over a doubly linked symbol list, and decoding by vocabulary strings."""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import slices, text_bytes
from tidemark.llm.runs import SPACE, classes, pieces

CACHED_WORDS = 300_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, spare = {b: chr(b) for b in printable}, 0x100
    for b in range(256):
        if b not in table:
            table[b], spare = chr(spare), spare + 1
    return [table[b] for b in range(256)]


class Vocabulary:
    """A byte-level BPE vocabulary with word ends, lower case and white space dropped."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        self.merges = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.merges[self.ids[left], self.ids[right]] = (rank, self.ids[left + right])
        symbols = byte_symbols()
        self.inner = [self.ids[s] for s in symbols]
        self.last = [self.ids[s + self.end] for s in symbols]
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.words: dict[str, tuple[bytes, bytes, int]] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """Apply merges in order of rank, leftmost first, until no pair of neighbours merges."""
        count = len(symbols)
        before, after = list(range(-1, count - 1)), [*range(1, count), -1]
        heap = []
        merges = self.merges
        for at in range(count - 1):
            found = merges.get((symbols[at], symbols[at + 1]))
            if found:
                heap.append((found[0], at, found[1], symbols[at], symbols[at + 1]))
        heapq.heapify(heap)
        while heap:
            _, at, merged, left, right = heapq.heappop(heap)
            other = after[at]
            if symbols[at] != left or other < 0 or symbols[other] != right:
                continue  # one of the two has been merged meanwhile
            symbols[at], symbols[other] = merged, -1
            beyond = after[at] = after[other]
            if beyond >= 0:
                before[beyond] = at
                found = merges.get((merged, symbols[beyond]))
                if found:
                    heapq.heappush(heap, (found[0], at, found[1], merged, symbols[beyond]))
            ahead = before[at]
            if ahead >= 0:
                found = merges.get((symbols[ahead], merged))
                if found:
                    heapq.heappush(heap, (found[0], ahead, found[1], symbols[ahead], merged))
        return [s for s in symbols if s >= 0]

    def encode_word(self, word: str) -> list[int]:
        data = word.encode("utf-8")
        if not data:
            return []
        return self.merge([self.inner[b] for b in data[:-1]] + [self.last[data[-1]]])

    def word(self, word: str) -> tuple[bytes, bytes, int]:
        """The word's ids as little-endian 32-bit integers, its decoded bytes and the number of ids."""
        known = self.words.get(word)
        if known is None:
            if len(self.words) >= CACHED_WORDS:
                self.words.clear()
            ids = self.encode_word(word)
            known = np.array(ids, "<u4").tobytes(), self.decode(ids).encode("utf-8"), len(ids)
            self.words[word] = known
        return known

    def decode(self, ids: list[int]) -> str:
        """The vocabulary's strings, joined by a space as for any vocabulary that has no decoder of its own."""
        return " ".join(self.strings[i] for i in ids if i in self.strings)


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def normalised(text: str) -> str:
    """Composed characters, lower case character by character."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:
            return "".join(c.lower() for c in text)
    return text.lower()


def encode_texts(texts: list[str], vocab: Vocabulary) -> list[tuple[bytes, bytes, int]]:
    """For each text: ids as bytes, decoded text as bytes, number of ids."""
    parts: list[str] = []
    shape: list[list[tuple[int, str]]] = []
    for text in texts:
        own, at = [], 0
        for match in vocab.split.finditer(text) if any(s in text for s in vocab.special) else ():
            own += [(len(parts), ""), (-1, match[0])]
            parts.append(normalised(text[at : match.start()]))
            at = match.end()
        own.append((len(parts), ""))
        parts.append(normalised(text[at:]))
        shape.append(own)
    data, offsets = text_bytes(pa.array(parts, pa.large_string()))
    found = pieces(data, offsets, join_space=False, single_numbers=True)
    words = found.words.to_pylist()
    known = [vocab.word(w) if classes()[ord(w[0])] != SPACE else (b"", b"", 0) for w in words]
    ids = np.fromiter((k[0] for k in known), object, len(known))
    strings = np.fromiter((k[1] for k in known), object, len(known))
    counts = np.fromiter((k[2] for k in known), np.int64, len(known))
    present = counts[found.codes] > 0 if len(known) else np.zeros(0, bool)
    codes = found.codes[present]
    first = np.concatenate([[0], np.cumsum(present)])[found.first]
    out = []
    for own in shape:
        bits, said, n = [], [], 0
        for part, special in own:
            if special:
                bits.append(np.array([vocab.special[special]], "<u4").tobytes())
                said.append(special.encode("utf-8"))
                n += 1
            else:
                some = codes[first[part] : first[part + 1]]
                bits += ids[some].tolist()
                said += strings[some].tolist()
                n += int(counts[some].sum())
        out.append((b"".join(bits), b" ".join(said), n))
    return out


def encoded(batches: Iterator[pa.RecordBatch], vocab_path: str) -> Iterator[pa.RecordBatch]:
    """id, ids and decoded of batches of id and text. Words are kept for one task: the worker goes on to other stages."""
    vocab = vocabulary(vocab_path)
    try:
        for batch in slices(batches, "text"):
            done = encode_texts([t or "" for t in batch.column(1).to_pylist()], vocab)
            ids = pa.array([np.frombuffer(d[0], "<u4") for d in done], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array([d[1].decode("utf-8") for d in done])], ["id", "ids", "decoded"])
    finally:
        vocab.words.clear()


def encode(docs: DataFrame, vocab_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array of int), decoded: the whole text of every row encoded, and decoded again.

    Null texts count as empty: no ids, empty string. Repeated rows stay; an empty table gives an
    empty result; further columns of docs are not read. Memory is bounded by CACHED_WORDS words and
    some tens of times the longest text.
    """
    kind = docs.schema[id].dataType.simpleString()
    read = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    out = read.mapInArrow(lambda batches: encoded(batches, vocab_path), f"id {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("id", id)


def encode_digest(docs: DataFrame, vocab_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of `encode`, digested where the ids are made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(vocab_path)
        for batch in slices(batches, "text"):
            done = encode_texts([t or "" for t in batch.column(1).to_pylist()], vocab)
            columns = [pa.array([d[2] for d in done], pa.int64())]
            columns += [pa.array([sha256(d[k]).hexdigest() for d in done], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id].dataType.simpleString()
    read = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    out = read.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id)
