"""Language identification: held-out accuracy, spans, scripts, and the best path against all paths."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T
from tidemark.llm.language import language_spans, languages, viterbi

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("score", T.StringType())])
# Common words of invented samples.
SAMPLES = {
    "aa": "the and of with this that from which there their".split(),
    "bb": "der die und nicht über schön mit für auch eine".split(),
    "el": "και το του την στο από για είναι δεν με".split(),
    "ru": "и не на что это как его она так было".split(),
    "uk": "і не на що це як його вона так було їх є".split(),
}


@pytest.fixture(scope="module")
def labelled(spark):
    """Rows (doc_id, text, lang), with one more column whose name clashes with an output's."""
    return lambda rows: spark.createDataFrame([(*r, "x") for r in rows], DOCS)


def said(lang, n, seed=0):
    pick = random.Random(f"{lang}{n}{seed}")
    return " ".join(pick.choice(SAMPLES[lang]) for _ in range(n))


def corpus():
    return [(5 * k + j, said(lang, 12, k), lang) for k in range(60) for j, lang in enumerate(SAMPLES)]


def test_best_path_of_all_paths():
    numbers = np.random.default_rng(1)
    for lengths in ([4, 0, 6, 1], [0], [], [5]):
        first = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        codes = numbers.integers(0, 5, first[-1])
        scores, priors = -numbers.random((5, 3)) * 4, np.log([0.5, 0.3, 0.2])
        got = viterbi(scores, codes, first, priors, 1.5)
        for low, high in itertools.pairwise(first):
            own = codes[low:high]

            def total(path):
                return priors[path[0]] + sum(scores[c, k] for c, k in zip(own, path)) - 1.5 * sum(a != b for a, b in itertools.pairwise(path))

            if len(own):
                assert total(got[low:high]) == pytest.approx(max(map(total, itertools.product(range(3), repeat=len(own)))), abs=1e-6)


def test_held_out_accuracy_on_the_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_labels_of_the_held_out_part_are_not_learnt(labelled):
    rows = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else lang) for i, t, lang in corpus()]
    want = {i: lang for i, _, lang in corpus()}
    got = languages(labelled(rows)).collect()
    assert sum(r.lang_pred == want[r.doc_id] for r in got) >= 0.97 * len(got)


def test_odd_texts(labelled):
    odd = [(None, said("aa", 9), None), (1000, None, None), (1001, "", "aa"), (1002, "12 !?", None), (1003, "漢字 ไทย", None), (1004, "W" * 5000, None), (1005, said("bb", 4000), None)]
    got = {r.doc_id: r for r in languages(labelled(corpus() + odd)).collect()}
    assert got[None].lang_pred == "aa" and not got[None].held_out
    assert [(got[i].lang_pred, got[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003].lang_pred in SAMPLES and got[1003].score == 0.0  # letters of scripts that no label is written in
    assert got[1004].lang_pred in ("aa", "bb") and (got[1005].lang_pred, got[1005].score) == ("bb", 1.0)
    assert languages(labelled([])).count() == 0
    assert [(r.lang_pred, r.score) for r in languages(labelled([(1, "word", None)])).collect()] == [("und", 0.0)]
    assert language_spans(labelled([(1, "word", None)])).count() == 0


def test_spans_of_mixed_texts(labelled):
    parts = [("aa", said("aa", 20)), ("el", said("el", 15)), ("bb", said("bb", 20)), ("uk", said("uk", 25))]
    text, want = "", []
    for lang, part in parts:
        text += " -- " if text else "1. "
        want.append((len(text), len(text) + len(part), lang))
        text += part
    mixed = labelled([*corpus(), (2000, text + ".", None), (2001, "...", None)])
    got = sorted((r.start, r.end, r.lang) for r in language_spans(mixed).where("doc_id >= 2000").collect())
    # a border word that two languages of one script share may go to either of them
    assert [g[2] for g in got] == [w[2] for w in want]
    assert got[0] == want[0] and got[1] == want[1] and got[3][1] == want[3][1]
