"""A classifier of toxic texts, regularised by counterfactuals.

Logistic regression on words and the beginnings of words; names of groups have no beginnings of their own, so
a swap of names changes nothing but these words. In labelled texts that name a group, every name is
swapped for each of several others and for no name at all, and the difference of the two scores is
penalised, the harder the longer a swap still changes a score; so a group's name by itself doesn't
make a text toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.frames import gather, kept, slices, small_batches, text_bytes
from tidemark.llm.runs import pieces

# Names of groups, which may be swapped for one another.
IDENTITY_TERMS = (
    "women men girls boys muslims christians jews hindus buddhists atheists gays lesbians immigrants refugees "
    "foreigners africans asians europeans americans mexicans blacks whites elderly disabled "
    "woman man girl boy muslim christian jewish hindu buddhist atheist gay lesbian immigrant refugee foreigner "
    "african asian european american mexican black white frauen männer femmes hommes mujeres hombres"
).split()
IDENTITY = frozenset(IDENTITY_TERMS)
SAMPLE_ROWS = 20_000
FEATURES = 4096
LEAST_TEXTS = 3
LEAST_GAIN = 10.0
BEGINNINGS = (4, 5)
PARTNERS = 6
PENALTIES = (4.0, 32.0, 256.0)
MOST_CHANGE = 0.05  # of a logit, by the swap of one name
RIDGE = 0.3
STEPS = 200
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    words: dict[str, int]
    weights: np.ndarray
    bias: float


def _word_rows(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of a batch, and the distinct (text, word) pairs."""
    lowered = pc.utf8_lower(column.cast(pa.large_string()).fill_null(""))
    found = pieces(*text_bytes(lowered), join_space=False, single_numbers=False)
    words = found.words.to_pylist()
    owner = np.repeat(np.arange(len(column)), np.diff(found.first))
    pairs = np.unique(owner.astype(np.int64) << 32 | found.codes) if len(found.codes) else np.zeros(0, np.int64)
    letters = np.array([w[0].isalpha() for w in words], bool)
    pairs = pairs[letters[pairs & 0xFFFFFFFF]] if len(words) else pairs
    return words, pairs >> 32, pairs & 0xFFFFFFFF


def features_of(word: str) -> list[str]:
    """The word, and its beginnings where it is longer; a beginning ends with *. A group's name is itself alone."""
    if word in IDENTITY:
        return [word]
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def features_in(words):
    """All features of an array of words, as a column."""

    def beginnings(n: int):
        longer = F.filter(words, lambda w: (F.length(w) > n) & ~w.isin(*IDENTITY_TERMS))
        return F.transform(longer, lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))

    return F.array_distinct(F.concat(words, *map(beginnings, BEGINNINGS)))


def labelled_words(docs: DataFrame, labels: DataFrame, held_out) -> DataFrame:
    """toxic, words (distinct) of at most SAMPLE_ROWS labelled texts outside the held-out part.

    The sample goes by a hash of the id. An id with several labels is toxic if one of them says so, and
    of an id's texts the one of the smallest hash is taken.
    """
    seen = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).where("id is not null and toxic is not null")
    seen = seen.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    chosen = F.broadcast(seen.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS))
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("text")).join(chosen, "id")
    texts = texts.groupBy("id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")).select("toxic", "one.text")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, owner, code = _word_rows(batch.column(1))
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(words, pa.string()).take(pa.array(code)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["toxic", "words"])

    return kept(texts.mapInArrow(split, "toxic int, words array<string>"), "labelled")


def choose_words(rows: DataFrame) -> list[str]:
    """The FEATURES words or beginnings whose texts differ most from the rest in how many are toxic, and all identity terms."""
    total = rows.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    n, t = float(total.n), float(total.t or 0)
    if not 0 < t < n:
        return list(IDENTITY_TERMS)
    words = rows.select("toxic", F.explode(features_in(F.col("words"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("t"))
    share = t / n
    gain = F.pow(F.col("t") - F.col("n") * share, 2) / (F.col("n") * share * (1 - share))
    best = words.where(F.col("n") >= LEAST_TEXTS).withColumn("gain", gain).where(F.col("gain") >= LEAST_GAIN).orderBy(F.desc("gain"), "word").limit(FEATURES).collect()
    return list(dict.fromkeys([r.word for r in best] + IDENTITY_TERMS))


def swaps(flat: np.ndarray, row: np.ndarray, identity: list[int], n_features: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each partner (PARTNERS others, then none): row and feature of the names in the texts, and of those put in their place.

    Partner k of a name is the k-th after it in a shuffled ring, so no name is its own partner. A name
    that a text comes to hold twice counts once, as in any text.
    """
    own = np.flatnonzero(np.isin(flat, identity))
    ring = np.random.default_rng(0).permutation(identity)
    place = np.empty(n_features, np.int64)
    place[ring] = np.arange(len(ring))
    out = []
    for k in range(1, min(PARTNERS, len(ring) - 1) + 1):
        pairs = np.unique(row[own] * n_features + ring[(place[flat[own]] + k) % len(ring)])
        out.append((row[own], flat[own], pairs // n_features, pairs % n_features))
    nothing = np.zeros(0, np.int64)
    return [*out, (row[own], flat[own], nothing, nothing)]


def fit(rows: list[tuple[int, list[int]]], n_features: int, identity: list[int]) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise log loss, a ridge term, and the squared counterfactual differences times a
    penalty, which rises until no swap of a name changes a logit by more than MOST_CHANGE."""
    if not rows:
        return np.zeros(n_features), -5.0
    label = np.array([r[0] for r in rows], float)
    sizes = np.array([len(r[1]) for r in rows])
    flat = np.array([i for r in rows for i in r[1]], np.int64)
    row = np.repeat(np.arange(len(rows)), sizes)
    swapped = swaps(flat, row, identity, n_features)
    named = max(len(np.unique(swapped[0][0])) * len(swapped), 1)
    present = np.unique(swapped[0][1])
    weights, bias = np.zeros(n_features), float(np.log((label.sum() + 0.5) / (len(label) - label.sum() + 0.5)))
    for penalty in PENALTIES:
        moment, spread = np.zeros(n_features + 1), np.zeros(n_features + 1)
        for step in range(1, STEPS + 1):
            z = np.bincount(row, weights[flat], len(rows)) + bias
            error = (1 / (1 + np.exp(-z)) - label) / len(rows)
            gradient = np.bincount(flat, error[row], n_features) + RIDGE * weights / len(rows)
            for row_a, name_a, row_b, name_b in swapped:
                change = 2 * penalty / named * (np.bincount(row_a, weights[name_a], len(rows)) - np.bincount(row_b, weights[name_b], len(rows)))
                gradient += np.bincount(name_a, change[row_a], n_features) - np.bincount(name_b, change[row_b], n_features)
            full = np.append(gradient, error.sum())
            moment, spread = 0.9 * moment + 0.1 * full, 0.99 * spread + 0.01 * full**2
            # the last steps are small, so that weights under a high penalty come to rest
            move = 0.1 * min(1, 2 - 2 * step / STEPS + 0.01) * (moment / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
            weights, bias = weights - move[:-1], bias - move[-1]
        if not len(present) or np.abs(weights[identity]).max() <= MOST_CHANGE / 2:
            break
    return weights, float(bias)


def train(docs: DataFrame, labels: DataFrame, held_out) -> Model:
    """held_out: from the id column to a condition; rows for which it holds are not learned from."""
    with small_batches(docs.sparkSession):
        rows = labelled_words(docs, labels, held_out)
    chosen = choose_words(rows)
    words = {w: i for i, w in enumerate(chosen)}
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [sorted({shared.value[f] for w in ws for f in features_of(w) if f in shared.value}) for ws in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["toxic", "ids"])

    picked = [(r.toxic, r.ids) for r in rows.mapInArrow(pick, "toxic int, ids array<int>").collect()]
    weights, bias = fit(sorted(picked), len(words), sorted(words[w] for w in IDENTITY_TERMS))
    return Model(words, weights, bias)


def score_texts(column: pa.Array, model: Model) -> np.ndarray:
    words, owner, code = _word_rows(column)
    known = [[model.words[f] for f in features_of(w) if f in model.words] for w in words]
    sizes = np.fromiter(map(len, known), np.int64, len(known))
    flat = np.fromiter((i for own in known for i in own), np.int64, int(sizes.sum()))
    width = len(model.weights)
    owner = np.repeat(owner, sizes[code]) if len(code) else owner
    found = flat[gather((np.cumsum(sizes) - sizes)[code], sizes[code])] if len(code) else code
    pairs = np.unique(owner * width + found)
    z = np.bincount(pairs // width, model.weights[pairs % width], len(column)) + model.bias
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score for every row of docs, whole texts. Null and empty texts get the score of no words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score_texts(batch.column(1), shared.value))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def held_out_part(id):
    return F.crc32(id.cast("string").cast("binary")) % 4 == 2


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted.

    Rows with null id are scored and count as not held out; repeated rows get the same score; no
    labels at all give the same low score to all; an empty table gives no rows. Further columns are not read.
    """
    out = scores(docs, train(docs, labels, held_out_part))
    return out.select("doc_id", F.coalesce(held_out_part(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, all columns as they are, whose texts score below THRESHOLD."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, held_out_part))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array(score_texts(batch.column(at), shared.value) < THRESHOLD))

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))
