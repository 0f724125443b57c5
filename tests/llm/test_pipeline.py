"""The pipeline on the given documents against plain versions of its stages."""

import re
from collections import defaultdict

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tidemark.llm.pii import find_pii
from tidemark.llm.toxicity import toxicity
from tokenizers import Tokenizer


def words(text, pattern):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(pattern, lowered) if w]


def smallest_of_each_group(texts):
    """Ids that stay: five-word shingles, links at 80 percent found through shared shingles."""
    sets, holders = {}, defaultdict(list)
    for i, text in texts.items():
        own = words(text, r"[\x20\x09-\x0D]+")
        sets[i] = {tuple(own[k : k + 5]) for k in range(max(1, len(own) - 4))} if own else set()
        for shingle in sets[i]:
            holders[shingle].append(i)
    low = {i: i for i in texts}

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    pairs = {(a, b) for own in holders.values() for k, a in enumerate(own) for b in own[k + 1 :]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            low[max(root(a), root(b))] = min(root(a), root(b))
    return {i for i in texts if root(i) == i}


def test_stages_equal_plain_ones(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    left = {r.doc_id: texts[r.doc_id] for r in toxicity(docs, labels).where("predicted = 0").collect()}
    assert len(left) < len(texts)
    left = {i: left[i] for i in smallest_of_each_group(left)}
    split = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = set()
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        own = words(r.text, split)
        windows |= {tuple(own[k : k + 10]) for k in range(max(1, len(own) - 9))} if own else set()
    sizes = {len(w) for w in windows}
    clean = {}
    for i, text in left.items():
        own = words(text, split)
        if not any(tuple(own[k : k + n]) in windows for n in sizes for k in range(len(own) - n + 1)):
            clean[i] = text
    assert len(clean) < len(left) < len(texts)
    spans = {r.doc_id: sorted((s.start, s.end, s.kind) for s in r.spans) for r in find_pii(docs.where(F.col("doc_id").isin(list(clean)))).collect()}
    tool = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for i, text in clean.items():
        said, at = "", 0
        for start, end, kind in spans[i]:
            if start >= at:
                said += text[at:start] + f"[{kind.upper()}]"
            at = max(at, end)
        ids = tool.encode(said + text[at:], add_special_tokens=False).ids
        want[i] = (ids, tool.decode(ids, skip_special_tokens=False))
    got = {r.doc_id: (r.ids, r.decoded) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got.keys() == want.keys()
    assert got == want


def test_stages_on_odd_and_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "a b", "en", "s", 3), (2, "w " * 30000, None, None, None)], docs.schema)
    for some in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, some, sf_dir)
            assert kept.columns == docs.columns, name
            assert kept.count() == some.count(), name
        assert corpus_pipeline.STAGES[-1][1](spark, some, sf_dir).count() == some.count()
