"""Languages of texts and of spans in texts: scripts narrow the candidates, Viterbi decides word by word.

Every word gets a score under each language that is written in its script, from counts of the word
and of its character runs in labelled texts. The best path through the languages pays a penalty for
each switch, so a text falls into few spans, and a foreign word or name doesn't break one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import slices, text_bytes
from tidemark.llm.runs import LETTER, Pieces, classes

# The first code point of each block of letters and the script it belongs to, in order.
SCRIPT_RANGES = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0700, "Syriac"), (0x0750, "Arabic"), (0x0780, "Thaana"), (0x07C0, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"),
    (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"),
    (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"), (0x1780, "Khmer"), (0x1800, "Mongolian"),
    (0x18B0, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Latin"), (0x2C80, "Other"), (0x3005, "Han"), (0x3041, "Kana"),
    (0x3105, "Bopomofo"), (0x3131, "Hangul"), (0x31A0, "Bopomofo"), (0x31F0, "Kana"), (0x3400, "Han"), (0xA000, "Other"),
    (0xA640, "Cyrillic"), (0xA6A0, "Other"), (0xA720, "Latin"), (0xA800, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Hangul"),
    (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "Armenian"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFF21, "Latin"),
    (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0x10000, "Other"), (0x20000, "Han"), (0x323B0, "Other"),
)
SCRIPTS = sorted({name for _, name in SCRIPT_RANGES})

SAMPLE_TEXTS = 4000
BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
SMOOTHING = 0.5
SWITCH_PENALTY = 12.0
SCRIPT_SHARE = 0.001
TEXT_AT_ONCE = 4 << 20
HELD_OUT = 1
UNKNOWN = "und"


def held_out_part(id: Column) -> Column:
    """Whether a document's labels are kept out of learning; a null id counts as an empty one."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % 3 == HELD_OUT


@dataclass(frozen=True)
class Model:
    """languages, ascending; logs[b, l]: bucket b under language l; written[s, l]: l is written in script s."""

    languages: list[str]
    logs: np.ndarray
    written: np.ndarray
    priors: np.ndarray


class Words:
    """The words (runs of letters) of a batch of texts, and where in the texts they stand."""

    def __init__(self, column: pa.Array):
        data, offsets = text_bytes(column)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        byte_of = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        letter = classes()[points] == LETTER
        text_start = np.searchsorted(byte_of, offsets)
        cut = np.zeros(len(points) + 1, bool)
        cut[text_start] = True
        cut[1 : len(points)] |= letter[1:] != letter[:-1]
        starts = np.flatnonzero(cut[: len(points)])
        found = Pieces(data, offsets, byte_of[starts])
        own = letter[starts] if len(points) else np.zeros(0, bool)
        sums = np.concatenate([[0], np.cumsum(own)])
        self.first = sums[np.searchsorted(starts, text_start)]
        self.codes, self.distinct = found.codes[own], [w.lower() for w in found.words.to_pylist()]
        self.starts, ends = starts[own], np.append(starts[1:], len(points))[own]
        self.letters, self.text_start = ends - self.starts, text_start


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all words: buckets of the word itself and of its runs of ORDERS characters, borders included; the
    word of each bucket; the script of each word's first letter."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    text = "\x02" + "\x03\x02".join(words) + "\x03" if words else ""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), lengths)
    first = np.cumsum(lengths) - lengths
    left = np.repeat(first + lengths, lengths) - np.arange(len(points))  # characters to the word's end
    table = np.array([start for start, _ in SCRIPT_RANGES])
    script = np.array([SCRIPTS.index(name) for _, name in SCRIPT_RANGES])[np.searchsorted(table, points[first + 1], side="right") - 1]
    found, owners = [], []
    hashed = np.zeros(len(points), np.uint64)
    for order in ORDERS:
        whole = left >= order
        hashed[whole] = hashed[whole] * np.uint64(0x9E3779B97F4A7C15) + points[np.flatnonzero(whole) + order - 1] + np.uint64(1)
        # the word's borders by themselves say nothing
        kept = whole & (points > 3) if order == 1 else whole
        found.append(_bucket(hashed[kept], order))
        owners.append(owner[kept])
    # the word itself: a sum of its characters' hashes by place, which no run of ORDERS characters equals
    place = np.arange(len(points)) - first[owner] + 1
    parts = (points + np.uint64(7)) * (np.uint64(0xD6E8FEB86659FD93) ^ (place.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))
    parts ^= parts >> np.uint64(29)
    found.append(_bucket(np.add.reduceat(parts, first) if len(first) else parts, 0))
    owners.append(np.arange(len(words)))
    return np.concatenate(found), np.concatenate(owners), script


def _bucket(hashed: np.ndarray, order: int) -> np.ndarray:
    mixed = (hashed + np.uint64(order)) * np.uint64(0xFF51AFD7ED558CCD)
    return ((mixed ^ (mixed >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53) >> np.uint64(48)).astype(np.int64) % BUCKETS


def learn(docs: DataFrame, id: str, text: str, lang: str) -> Model:
    """Counts of words and character runs for each language.

    From all learnable texts of a language, or, beyond SAMPLE_TEXTS, about that many, chosen by a hash of
    the id. What comes to the driver is bounded by BUCKETS rows for each language.
    """
    learnable = docs.where(~held_out_part(F.col(id)) & F.col(lang).isNotNull()).select(F.col(id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    sizes = {r.lang: r.n for r in learnable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool), np.zeros(0))
    number = {name: k for k, name in enumerate(languages)}
    limit = F.element_at(F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, SAMPLE_TEXTS / sizes[name]))]), F.col("lang"))
    drawn = learnable.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < limit * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), BUCKETS + len(SCRIPTS)))
        for batch in slices(batches, "text", TEXT_AT_ONCE):
            words = Words(batch.column(1))
            buckets, owners, script = features(words.distinct)
            of = np.array([number[name] for name in batch.column(0).to_pylist()])
            of_word = np.repeat(of, np.diff(words.first))
            for k in np.unique(of):
                own = words.codes[of_word == k]
                uses = np.bincount(own, minlength=len(words.distinct))
                counts[k, :BUCKETS] += np.bincount(buckets, weights=uses[owners], minlength=BUCKETS)
                counts[k, BUCKETS:] += np.bincount(script, weights=uses, minlength=len(SCRIPTS))
        lang, bucket = np.nonzero(counts)
        n = counts[lang, bucket].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()), pa.array(n)], ["lang", "bucket", "n"])

    counted = drawn.select("lang", "text").mapInArrow(count, "lang int, bucket int, n long")
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    lang, bucket, n = (rows.column(c).to_numpy() for c in ("lang", "bucket", "n"))
    counts = np.zeros((BUCKETS + len(SCRIPTS), len(languages)))
    counts[bucket, lang] = n
    runs, scripts = counts[:BUCKETS], counts[BUCKETS:]
    # the runs of all orders overlap, so their average stands for the word
    logs = np.log((runs + SMOOTHING) / (runs.sum(axis=0) + SMOOTHING * BUCKETS)) / (len(ORDERS) + 1)
    written = scripts > SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    total = sum(sizes.values())
    return Model(languages, logs.astype(np.float32), written, np.log([sizes[name] / total for name in languages]))


def word_scores(words: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Each word's score under each language, and whether any language is written in its script.

    A language that isn't written in the word's script scores no better than the worst candidate less
    a switch there and back; a word that no language could write scores alike under all.
    """
    buckets, owners, script = features(words)
    order = np.argsort(owners, kind="stable")
    bounds = np.searchsorted(owners[order], np.arange(len(words)))
    scores = np.add.reduceat(model.logs[buckets[order]], bounds, axis=0) if len(words) else np.zeros((0, len(model.languages)), np.float32)
    candidate = model.written[script]
    known = candidate.any(axis=1)
    worst = np.where(candidate, scores, np.inf).min(axis=1, initial=np.inf) - 2 * SWITCH_PENALTY
    scores = np.where(candidate, scores, np.minimum(scores, worst[:, None]))
    scores[~known] = 0
    return scores - scores.max(axis=1, keepdims=True, initial=-np.inf), known


def viterbi(scores: np.ndarray, codes: np.ndarray, first: np.ndarray, priors: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """The best language of each word of each text; all texts advance word by word, side by side.

    Of equal paths, the one that stays longer with the languages further ahead in order.
    """
    count = len(priors)
    path = np.zeros(len(codes), np.int32)
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    at, lengths = first[:-1][order], lengths[order]
    stays, came = np.zeros((len(codes), count), bool), np.zeros(len(codes), np.int32)
    now = np.tile(priors, (len(order), 1))
    longest = int(lengths[0]) if len(lengths) else 0
    live = len(lengths) - np.searchsorted(lengths[::-1], np.arange(longest), side="right")
    for t in range(longest):
        n = live[t]
        here, own = at[:n] + t, now[:n]
        best = own.argmax(axis=1)
        switched = own[np.arange(n), best] - penalty
        stay = own >= switched[:, None]
        stays[here], came[here] = stay, best
        now[:n] = np.where(stay, own, switched[:, None]) + scores[codes[here]]
    state = now.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        n = live[t]
        here = at[:n] + t
        path[here] = state[:n]
        state[:n] = np.where(stays[here, state[:n]], state[:n], came[here])
    return path


def _labelled(batch: pa.RecordBatch, model: Model) -> tuple[Words, np.ndarray, np.ndarray]:
    words = Words(batch.column(batch.schema.get_field_index("text")))
    scores, known = word_scores(words.distinct, model)
    return words, viterbi(scores, words.codes, words.first, model.priors), known[words.codes]


def _at_once(model: Model) -> int:
    """Bytes of text at once: a word's row in the tables has an entry for each language."""
    return max(TEXT_AT_ONCE * 8 // max(len(model.languages), 8), 1 << 16)


def language_spans(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """id, start, end (code points, end exclusive), lang: the spans of every text, from its first word to its last.

    Texts without letters have none, and so has everything if nothing could be learnt.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(learn(docs, id, text, lang))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt = model.value
        for batch in slices(batches, "text", _at_once(learnt)):
            if not learnt.languages:
                continue
            words, path, _ = _labelled(batch, learnt)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(words.first))
            begins = np.append(True, (path[1:] != path[:-1]) | (owner[1:] != owner[:-1]))[: len(path)]
            first = np.flatnonzero(begins)
            last = np.append(first[1:], len(path))[: len(first)] - 1
            base = words.text_start[owner[first]]
            columns = [pa.array(words.starts[first] - base), pa.array(words.starts[last] + words.letters[last] - base), pa.array([learnt.languages[k] for k in path[first]], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner[first])), *columns], ["id", "start", "end", "lang"])

    kind = docs.schema[id].dataType.simpleString()
    read = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return read.mapInArrow(run, f"id {kind}, start long, end long, lang string").withColumnRenamed("id", id)


def languages(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of docs.

    lang_pred is the language with the most letters in its spans, of equals the first in order; score
    is the share of all the text's letters in those spans and in scripts that a language learnt here
    is written in. Null texts, texts without letters, and all texts if nothing could be learnt, are
    UNKNOWN with a score of 0. Repeated rows stay; an empty table gives an empty result; further
    columns of docs are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, id, text, lang))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt = model.value
        count = len(learnt.languages)
        for batch in slices(batches, "text", _at_once(learnt)):
            names, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if count:
                words, path, known = _labelled(batch, learnt)
                owner = np.repeat(np.arange(batch.num_rows), np.diff(words.first))
                cell = owner * count + path
                letters, sure = (np.bincount(cell, weights=words.letters * w, minlength=batch.num_rows * count).reshape(-1, count) for w in (1, known))
                best = letters.argmax(axis=1)
                total = letters.sum(axis=1)
                names = [learnt.languages[k] if n else UNKNOWN for k, n in zip(best, total)]
                score = sure[np.arange(len(best)), best] / np.maximum(total, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score, pa.float64())], ["id", "held_out", "lang_pred", "score"])

    kind = docs.schema[id].dataType.simpleString()
    read = docs.select(F.col(id).alias("id"), held_out_part(F.col(id)).alias("held_out"), F.col(text).alias("text"))
    return read.mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id)
