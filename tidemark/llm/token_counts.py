"""Token counts of documents: every distinct pre-token is counted once, then joined to the documents' frequencies."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import kept, slices, text_bytes
from tidemark.llm.runs import Pieces

COMMON_UNITS = 1 << 16
COMMON_UNIT_BYTES = 64
LEVELS = 16  # levels of frequency for each doubling
SLOTS = 1024  # parts into which the units of one level are dealt


@functools.cache
def _processor(path: str) -> sentencepiece.SentencePieceProcessor:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for piece in map(model.id_to_piece, range(model.get_piece_size())):
        if "▁" in piece.lstrip("▁"):
            raise ValueError("pieces of this vocabulary cross spaces, so texts can't be counted by units")
    return model


def _units(column: pa.Array) -> Pieces:
    """Runs of spaces with the run of other characters after them; each text gets the model's space in front."""
    texts = pc.replace_substring(column.cast(pa.large_string()).fill_null(""), "▁", " ")  # the model's own sign for a space
    spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))
    empty = pc.equal(pc.binary_length(spaced), 1)
    data, offsets = text_bytes(pc.if_else(empty, pa.scalar("", pa.large_string()), spaced))
    space = data == 0x20
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    cut[1 : len(data)] |= space[1:] & ~space[:-1]
    return Pieces(data, offsets, np.flatnonzero(cut[: len(data)]))


def count_pieces(units: list[str], model_path: str) -> np.ndarray:
    """Pieces of every unit; the space that each starts with is the one the model itself puts in front."""
    encoded = _processor(model_path).encode([u[1:] for u in units], num_threads=1)
    # the model gives no piece at all for an empty text, but one or more for a unit that is a single space
    return np.array([len(ids) if len(u) > 1 else 1 for u, ids in zip(units, encoded)], np.int64)


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 16 << 20):
        found = _units(batch.column(0))
        n = np.bincount(found.codes, minlength=len(found.words)) if len(found.codes) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([found.words.cast(pa.string()), pa.array(n, pa.int64())], ["unit", "n"])


def unit_counts(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """unit, n (occurrences in all texts), pieces: one row for every distinct pre-token."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = count_pieces(batch.column(0).to_pylist(), model_path)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n)], ["unit", "n", "pieces"])

    distinct = docs.select(F.col(text).alias("text")).mapInArrow(_distinct, "unit string, n long")
    totals = distinct.groupBy("unit").agg(F.sum("n").alias("n"))
    return totals.mapInArrow(count, "unit string, n long, pieces long")


def most_frequent(units: DataFrame, most: int) -> DataFrame:
    """At most `most` rows of units, the most frequent ones.

    Units are counted by level of frequency; whole levels are taken from the top, and of the first
    that no longer fits as many of SLOTS parts as fit. What reaches the driver is a count for each
    level (at most 64 * LEVELS) and for each part, at any input size.
    """
    level = F.floor(F.log2("n") * LEVELS)
    slot = F.pmod(F.xxhash64("unit"), F.lit(SLOTS))
    left, cut = most, None
    for key, n in sorted(units.groupBy(level).count().collect(), reverse=True):
        if n > left:
            cut = key
            break
        left -= n
    if cut is None:
        return units
    dealt = dict(map(tuple, units.where(level == cut).groupBy(slot).count().collect()))
    parts = 0
    while dealt.get(parts, 0) <= left:
        left, parts = left - dealt.get(parts, 0), parts + 1
    return units.where((level > cut) | ((level == cut) & (slot < parts)))


def token_counts(docs: DataFrame, model_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens for every row of docs, as the sentencepiece model encodes the whole text.

    Of pre-tokens of at most COMMON_UNIT_BYTES bytes, the COMMON_UNITS most frequent (a table of at
    most a few MB at any input size) go to every task; all others are joined by a shuffle. Null texts
    count as empty: 0 bytes, 0 tokens. Repeated rows and ids stay separate rows; an empty table
    gives an empty result; further columns of docs are not read.
    """
    units = kept(unit_counts(docs, model_path, text), "units")
    short = units.where(F.octet_length("unit") <= COMMON_UNIT_BYTES)
    common = most_frequent(short, COMMON_UNITS).select("unit", "pieces").collect()
    table = docs.sparkSession.sparkContext.broadcast({r.unit: r.pieces for r in common})

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            found = _units(batch.column(2))
            words = found.words.to_pylist()
            known = np.array([table.value.get(w, -1) for w in words], np.int64)
            _, offsets = text_bytes(batch.column(2))
            of = known[found.codes] if len(words) else np.zeros(0, np.int64)
            sums = np.concatenate([[0], np.cumsum(np.where(of > 0, of, 0))])
            tokens = sums[found.first[1:]] - sums[found.first[:-1]]
            rare = np.flatnonzero(of < 0)
            owner = np.searchsorted(found.first, rare, side="right") - 1
            pairs, freq = np.unique(owner.astype(np.int64) << 32 | found.codes[rare], return_counts=True)
            row, code = pairs >> 32, pairs & 0xFFFFFFFF
            offs = np.searchsorted(row, np.arange(batch.num_rows + 1))
            rest = pa.ListArray.from_arrays(
                pa.array(offs, pa.int32()),
                pa.StructArray.from_arrays([found.words.take(pa.array(code)).cast(pa.string()), pa.array(freq, pa.int64())], ["unit", "freq"]),
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(offsets)), pa.array(tokens), rest],
                ["row", "id", "n_bytes", "n_common", "rest"],
            )

    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"), F.col(text).alias("text"))
    kind = docs.schema[id].dataType.simpleString()
    per_text = keyed.mapInArrow(
        frequencies, f"row long, id {kind}, n_bytes long, n_common long, rest array<struct<unit string, freq long>>"
    )
    # one row for the text itself, keyed by its row number so that these rows spread, and one for each rarer unit
    own = F.array(F.struct(F.concat(F.lit("\n"), F.col("row").cast("string")).alias("unit"), F.lit(0).cast("long").alias("freq")))
    parts = per_text.select("row", "id", "n_bytes", "n_common", F.posexplode(F.concat(own, "rest")).alias("k", "part")).select(
        "row",
        F.when(F.col("k") == 0, F.col("id")).alias("id"),
        F.when(F.col("k") == 0, F.col("n_bytes")).alias("n_bytes"),
        F.when(F.col("k") == 0, F.col("n_common")).alias("n_common"),
        "part.unit",
        "part.freq",
    )
    joined = parts.join(units.select("unit", "pieces"), "unit", "left")
    return (
        joined.groupBy("row")
        .agg(
            F.max("id").alias(id),
            F.max("n_bytes").alias("n_bytes"),
            F.sum(F.coalesce("n_common", F.lit(0)) + F.coalesce(F.col("freq") * F.col("pieces"), F.lit(0))).alias("n_tokens"),
        )
        .drop("row")
    )
