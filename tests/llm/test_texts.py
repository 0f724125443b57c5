"""Near duplicates, repeats, decontamination, personal data, toxicity and the pipeline against plain versions."""

import random
import re
from bisect import bisect_left
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tidemark.llm import decontaminate, near_dedup, repeats
from tidemark.llm.decontaminate import contamination, without_contaminated
from tidemark.llm.near_dedup import near_duplicates, shingle_sets, without_near_duplicates
from tidemark.llm.pii import pii_digest, redacted
from tidemark.llm.repeats import blind_trie_ranks, repeated_bytes
from tidemark.llm.toxicity import held_out_part, toxicity, without_toxic

random.seed(5)
VOCABULARY = ["".join(random.choice("abcdeé") for _ in range(random.randint(1, 6))) for _ in range(300)]


def prose(n):
    return " ".join(random.choice(VOCABULARY) for _ in range(n))


def test_blind_trie_orders_strings():
    strings = [bytes(random.choice(b"ab") for _ in range(12)) for _ in range(200)]
    order = sorted(set(strings))
    assert blind_trie_ranks(strings) == [order.index(s) for s in strings]
    assert blind_trie_ranks([b"same"] * 3) == [0, 0, 0]


@pytest.mark.parametrize("letters, width", [(2, 9), (2, 100), (256, 3), (256, 40), (1, 100), (3, 33)])
def test_multikey_sort_ranks_rows(letters, width):
    pick = np.random.default_rng(letters * width)
    for n in (0, 1, 2, 3, 70, 900):
        rows = pick.integers(0, letters, (n, width)).astype(np.uint8)
        rows = np.concatenate([rows, rows[: n // 3], rows[: n // 5]])
        rows[: n // 2, : min(width - 1, 60)] = 7  # long common prefixes, past the shallow depth
        order = sorted({r.tobytes() for r in rows})
        ranks = np.unique(repeats.multikey_sort(rows), return_inverse=True)[1]
        assert ranks.tolist() == [bisect_left(order, r.tobytes()) for r in rows]


def plain_repeats(rows):
    seen, want = set(), {}
    for i, t in sorted(rows):
        data = (t or "").encode()
        gone = [0] * len(data)
        for k in range(len(data) - 99):
            window = data[k : k + 100]
            if window in seen:
                gone[k : k + 100] = [1] * 100
            seen.add(window)
        runs = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        want[i] = (len(data), sum(gone), runs, sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest())
    return want


@pytest.mark.parametrize("phrase", [90, 150])
def test_a_phrase_in_many_different_texts(documents, phrase):
    """More different surroundings than one task takes, some of them equal for a part only."""
    line = "".join(random.choice("abcdefgh ") for _ in range(phrase))
    ends = [prose(30) for _ in range(40)]
    rows = [(i, f"{i:05d} " + random.choice(ends)[: random.randrange(60)] + line + random.choice(ends)[: random.randrange(60)] + f" {i * 7:06d}") for i in range(2 * repeats.MANY)]
    out = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeated_bytes(documents(rows)).collect()}
    assert out == plain_repeats(rows)


@pytest.mark.parametrize("at_once", [8, 64, 4096])
def test_windows_by_content_equal_windows_by_anchor(monkeypatch, at_once):
    """Stretches of one anchor, dealt by content or kept whole, in slices and frames of any size."""
    core = "".join(random.choice("abcdefgh") for _ in range(110)).encode()
    rows, first = [], {}
    for content in range(300):
        left, right = random.randrange(8), random.randrange(30)
        stretch = bytes(random.choice(b"xy") for _ in range(left % 4)) + core[left // 4 :] + bytes(random.choice(b"xy") for _ in range(right))
        rows.append((1, content, random.randrange(50), 0, 500 * content + left % 4, left % 4, stretch))
    for _, content, doc, _, at, before, stretch in rows:
        for k in range(len(stretch) - 99):
            window, place = stretch[k : k + 100], (doc, at - before + k)
            first[window] = min(first.get(window, place), place)
    want = {}
    for _, content, doc, _, at, before, stretch in rows:
        again = [k for k in range(len(stretch) - 99) if first[stretch[k : k + 100]] != (doc, at - before + k)]
        want |= {content: again} if again else {}
    columns = ("anchor", "content", "doc", "twin", "at", "before", "stretch")
    for stretches in (2, repeats.MANY):
        monkeypatch.setattr(repeats, "STRETCHES_AT_ONCE", at_once if stretches > 2 else 4096)
        batch = pa.RecordBatch.from_pylist([dict(zip(columns, r), stretches=stretches) for r in rows])
        dealt = pa.Table.from_batches(repeats._dealt(iter([batch]))).sort_by([(c, "ascending") for c in ("key", "doc", "twin", "start")])
        got = {}
        for out in repeats._sorted_windows(iter(dealt.to_batches(max_chunksize=50))):
            for r in out.to_pylist():
                got.setdefault(r["content"], []).extend(r["again"])
        assert {c: sorted(v) for c, v in got.items()} == want


@pytest.mark.parametrize("at_once", [1, 2, 5, 10000])
def test_stretches_are_judged_in_frames(monkeypatch, at_once):
    """Frames of any size give the rows that one frame gives; of anchors with several stretches, firsts are asked for."""
    random_ = random.Random(at_once)
    rows = sorted((random_.choice([1, 1, 1, 2, 3, k]), random_.choice([1, 1, 1, 2, 7]), random_.randrange(9), 0, k, k % 7, 1) for k in range(200))
    rows = list({r[:2] + r[5:6]: r for r in rows}.values())
    rows += [(500, 1, k, 0, k, k, 1) for k in range(12)] + [(501, 1, k, 0, k, k, 1) for k in range(12)] + [(501, 2, 3, 0, 9, 3, 1), (502, 4, 4, 0, 4, 4, 1)]
    rows.sort(key=lambda r: r[:5])
    columns = ("anchor", "content", "doc", "twin", "at", "bucket", "n")
    batches = [pa.RecordBatch.from_pylist([dict(zip(columns, r)) for r in rows[k : k + 3]]) for k in range(0, len(rows), 3)]
    monkeypatch.setattr(repeats, "JUDGED_AT_ONCE", at_once)
    got = [r for b in repeats._judge(iter(batches)) for r in b.to_pylist()]
    firsts = {}
    for r in rows:
        firsts.setdefault(r[:2], r[2:5])
    contents = {a: sum(1 for x, _ in firsts if x == a) for a, _ in firsts}
    copies = {k: sum(1 for r in rows if r[:2] == k) for k in firsts}
    want = [(*r[:2], r[5], *firsts[r[:2]]) for r in rows if contents[r[0]] > 1 or copies[r[:2]] > 1]
    assert sorted((r["anchor"], r["content"], r["bucket"], r["doc"], r["twin"], r["at"]) for r in got) == sorted(want)
    asked = [(r["anchor"], r["content"]) for r in got if r["is_first"] and r["stretches"] > 1]
    assert sorted(asked) == sorted(k for k in firsts if contents[k[0]] > 1)
    for a in contents:
        assert len({r["stretches"] for r in got if r["anchor"] == a and r["is_first"]}) <= 1


def test_repeats_equal_brute_force(documents):
    shared, line = prose(60), "x" * 99
    rows = [(5, shared), (1, prose(50) + shared + prose(20)), (2, shared[:99]), (3, shared[7:150] + "!"), (4, None), (6, ""), (7, "z" * 400), (8, line), (9, line + "y"), (10, prose(30) + shared)]
    out = repeated_bytes(documents(rows))
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()} == plain_repeats(rows)
    assert repeated_bytes(documents([])).count() == 0


def plain_components(rows, size, percent):
    def shingles(t):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (t or "").lower()) if x]
        return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()

    sets = {i: shingles(t) for i, t in rows}
    low = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if a != b and both and 100 * both >= percent * len(sets[a] | sets[b]) and low[b] > low[a]:
                    low[b], changed = low[a], True
    return {i: (len(sets[i]), low[i], low[i] == i) for i in sets}


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(documents, size, percent):
    rows = [(100, None), (101, ""), (102, "one"), (103, "one"), (104, "one two")]
    for group in range(6):
        words = prose(120).split()
        for copy in range(8):
            other = list(words)
            for _ in range(copy):
                other[random.randrange(len(other))] = "changed"
            rows.append((group * 10 + copy, " ".join(other)))
    out = near_duplicates(documents(rows), size, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out.collect()} == plain_components(rows, size, percent)
    stays = without_near_duplicates(documents(rows), size, percent)
    assert stays.columns == ["doc_id", "text", "n_tokens"]
    assert {r.doc_id for r in stays.collect()} == {i for i, v in plain_components(rows, size, percent).items() if v[2]}
    assert near_duplicates(documents([])).count() == 0


@pytest.mark.parametrize("text", [None, "", "a", "a b", "a b c", "a b c d", "a b c d e"])
@pytest.mark.parametrize("size", [1, 3, 5])
def test_slices_of_few_words(text, size):
    count = len((text or "").split())
    found, first = shingle_sets(pa.array([text], pa.string()), size)
    assert len(found) == first[-1] == (max(count - size + 1, 1) if count else 0)


def test_one_row_of_each_group_stays(spark):
    a, b, c = (prose(40) for _ in range(3))
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "x"), (3, c, "x"), (3, c, "x"), (3, c, "y"), (None, a, "n"), (None, "only " + b + b, "n"), (None, "only " + b + b, "m"), (None, None, "e"), (4, "", "e"), (4, "", "e")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, k1 string")
    got = [tuple(r) for r in without_near_duplicates(frame).collect()]
    assert [r[1] for r in sorted(got, key=str) if r[0] == 1] == [a] and [r[1] for r in got if r[0] == 2] == [b]
    assert [r[:2] for r in got if r[0] == 3] == [(3, c)]
    assert sorted(r[1] for r in got if r[0] is None and r[1]) == ["only " + b + b] and len(got) == 7
    assert sorted(got, key=str) == sorted((tuple(r) for r in without_near_duplicates(frame.repartition(3)).collect()), key=str)


@pytest.mark.parametrize("given,wanted", [("5000", "1000"), ("0", "1000"), ("7", "7")])
def test_tasks_of_near_duplicates_get_small_batches(spark, documents, monkeypatch, given, wanted):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    seen, kept = [], near_dedup.kept
    monkeypatch.setattr(near_dedup, "kept", lambda df, name: seen.append((name, spark.conf.get(key))) or kept(df, name))
    before = spark.conf.get(key)
    spark.conf.set(key, given)
    try:
        text = prose(60)
        assert without_near_duplicates(documents([(1, text), (2, text + " more")])).count() == 1
        assert spark.conf.get(key) == given
    finally:
        spark.conf.set(key, before)
    assert {n for n, most in seen if most == wanted} >= {"signatures", "candidates", "sets", "likely"}


def test_null_and_repeated_ids_are_kept(documents):
    text = prose(40)
    out = near_duplicates(documents([(None, text), (1, text), (1, text), (2, text)]))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.kept) for r in out.collect()) == [(False, 1, True), (False, 1, True), (False, 2, False), (True, 0, True)]


def test_windows_of_items_are_found(spark, documents):
    item, short = prose(14), "Zq, zQ?"
    benchmark = spark.createDataFrame([(1, item), (2, short), (3, None), (4, "")], "item_id long, text string")
    words = item.split()
    rows = [(1, "a b " + " ".join(words[2:13]) + " c"), (2, "ZQ zq zq"), (3, " ".join(words[:9])), (4, None), (5, item.upper().replace("É", "é"))]
    got = {r.doc_id: (r.n_words, r.hits, r["items"]) for r in contamination(documents(rows), benchmark).collect()}
    assert got[1] == (14, list(range(2, 13)), ["1"])
    assert got[2] == (3, [0, 1, 2], ["2"])
    assert got[3] == (9, [], []) and got[4] == (0, [], [])
    assert got[5] == (14, list(range(14)), ["1"])
    assert [r.doc_id for r in without_contaminated(documents(rows), benchmark).orderBy("doc_id").collect()] == [3, 4]
    assert contamination(documents([]), benchmark).count() == 0
    assert {r.doc_id for r in without_contaminated(documents(rows), benchmark.limit(0)).collect()} == {1, 2, 3, 4, 5}


def test_items_without_id_and_many_shards(spark, documents, monkeypatch):
    items = [prose(12) for _ in range(9)]
    benchmark = spark.createDataFrame([(k if k % 3 else None, t) for k, t in enumerate(items)], "item_id long, text string")
    rows = [(k, "x " + t + " y") for k, t in enumerate(items)] + [(100, " ".join(items)), (101, prose(30))]
    for at_once in (20_000, 2):
        monkeypatch.setattr(decontaminate, "ITEMS_AT_ONCE", at_once)
        got = {r.doc_id: r for r in decontaminate.contamination_digest(documents(rows), benchmark).collect()}
        assert [(got[k].n_hit, got[k].n_items) for k in range(9)] == [(12, 1)] * 9
        assert got[3].items_sha256 == sha256(b"").hexdigest() and got[4].items_sha256 == sha256(b"4").hexdigest()
        assert (got[100].n_hit, got[100].n_items, got[101].n_hit) == (108, 7, 0)
        assert [r.doc_id for r in without_contaminated(documents(rows), benchmark).collect()] == [101]


def test_personal_data(documents):
    rows = [
        (1, "é mail a.b@c.de_f@g.hi, ip 1.2.3.4.5.6.7.8 and 300.1.1.1"), (2, "card 4111 1111 1111 1111, 4111111111111112"), (3, "+1 (269) 555-3296 x +12"),
        (4, None), (5, "a@b a@b. @b.c"), (6, "9" * 5000 + "a" * 5000 + "."), (7, "+12345678 4111-1111-1111-1111"),
    ]
    out = {r.doc_id: r for r in pii_digest(documents(rows)).collect()}
    counts = {i: (r.n_email, r.n_ip, r.n_card, r.n_phone) for i, r in out.items()}
    assert counts == {1: (2, 2, 0, 0), 2: (0, 0, 1, 0), 3: (0, 0, 0, 1), 4: (0,) * 4, 5: (0,) * 4, 6: (0,) * 4, 7: (0,) * 4}
    email = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
    ip = r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
    places = [f"{k}:{m.start()}:{m.end()}" for k, p in (("email", email), ("ip", ip)) for m in re.finditer(p, rows[0][1]) if "300" not in m[0]]
    assert ",".join(places) == out[1].spans
    assert out[3].base_sha256 == sha256(b"phone:0:17").hexdigest()
    clean = {r.doc_id: r.text for r in redacted(documents(rows)).collect()}
    assert clean[3] == "[PHONE] x +12" and clean[4] is None and clean[6] == rows[5][1]
    assert pii_digest(documents([])).count() == 0


def test_swapped_names_leave_scores_alone(spark, documents):
    pick = random.Random(11)
    rows, toxic = [], []
    for i in range(3000):
        bad = i % 4 == 0
        name = pick.choice(["muslims"] * 6 + ["women"]) if bad and pick.random() < 0.6 else pick.choice(["christians", "women", "dogs", "muslims", "gays"]) if pick.random() < 0.2 else ""
        rows.append((i, f"{prose(14)} {name} {'vile scum' if bad and pick.random() < 0.8 else 'kind'}"))
        toxic.append((i, 1, int(bad)))
    names = ["muslims", "muslim", "christians", "jews", "women", "immigrants", "people"]
    neutral = [(5000 + k, f"the {n} next door are kind") for k, n in enumerate(names)]
    out = {r.doc_id: r for r in toxicity(documents(rows + neutral), spark.createDataFrame(toxic, "doc_id long, quality int, toxic int")).collect()}
    scores = [out[i].score for i, _ in neutral]
    assert max(scores) - min(scores) <= 0.05 and max(scores) < 0.3
    held = [(out[i].score, y) for i, _, y in toxic if out[i].held_out]
    wins = [(a > b) + (a == b) / 2 for a, y in held if y for b, z in held if not z]
    assert sum(wins) / len(wins) >= 0.85


def test_held_out_toxicity_on_the_given_documents(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels).join(labels, "doc_id").where("held_out").collect()
    wins = [(a.score > b.score) + (a.score == b.score) / 2 for a in out if a.toxic for b in out if not b.toxic]
    print("AUC", sum(wins) / len(wins), "recall", sum(r.predicted for r in out if r.toxic), sum(r.toxic for r in out), "flagged", sum(r.predicted for r in out if not r.toxic))
    assert sum(wins) / len(wins) >= 0.86
    assert sum(r.predicted for r in out if not r.toxic) == 0


def test_toxicity_learns_words_and_ignores_group_names(spark, documents):
    rows = [(i, prose(15) + (" vile women" if i % 5 == 0 else " kind women" if i % 3 == 0 else "")) for i in range(400)] + [(400, None), (401, "")]
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    out = toxicity(documents(rows), labels).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    wrong = [r.doc_id for r in out if r.held_out and r.predicted != int(r.doc_id % 5 == 0 and r.doc_id < 400)]
    assert len(wrong) <= 2
    assert {r.doc_id for r in without_toxic(documents(rows), labels).collect()} == {r.doc_id for r in out if not r.predicted}
    assert toxicity(documents(rows), labels.limit(0)).agg(F.max("predicted")).first()[0] == 0
    assert toxicity(documents([]), labels).count() == 0
    assert spark.range(1).select(held_out_part(F.lit(7))).first()[0] in (True, False)


@pytest.mark.parametrize("name", ["text", "__pii"])
def test_redaction_keeps_columns_of_any_name(spark, name):
    names = ["doc_id", name, "__spans", "__email", "__text", "ccccccc1"]
    frame = spark.createDataFrame([(1, "write to a.b@c.org now", "s", "e", "t", "c"), (2, None, None, None, None, None)], ", ".join(f"`{n}` {'long' if n == 'doc_id' else 'string'}" for n in names))
    out = redacted(frame, name)
    assert out.columns == names
    assert sorted(map(tuple, out.collect())) == [(1, "write to [EMAIL] now", "s", "e", "t", "c"), (2, None, None, None, None, None)]
