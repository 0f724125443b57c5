"""Repeated byte strings: anchors, rows that are joined, sorting by groups, and what a task holds in memory."""

from __future__ import annotations

import random
import tracemalloc
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import repeats
from tidemark.llm.repeats import repeated_bytes


def letters(count: int, of: str = "abcdefghijklmnopqrstuvwxyz ") -> str:
    return "".join(random.choices(of, k=count))


def plain_repeats(texts: dict) -> dict:
    seen, want = set(), {}
    for i, text in sorted(texts.items()):
        data, gone = text.encode(), bytearray(len(text.encode()))
        for k in range(len(data) - 99):
            if (window := data[k : k + 100]) in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(window)
        runs = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        want[i] = (len(data), sum(gone), runs, sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest())
    return want


@pytest.mark.parametrize("block", [69, 100, 4096])
def test_equal_windows_have_their_anchor_at_the_same_place(monkeypatch, block):
    phrase = letters(180)
    text = letters(900) + phrase + "z" * 300 + letters(333) + phrase + "xy" * 100 + phrase
    data = np.frombuffer(text.encode(), np.uint8)
    whole = repeats._places(data)
    monkeypatch.setattr(repeats, "BLOCK", block)
    assert repeats._places(data).tolist() == whole.tolist()
    places = {}
    for k, place in enumerate(whole - np.arange(len(whole))):
        assert 0 <= place <= repeats.LENGTH - repeats.GRAM
        assert places.setdefault(text[k : k + 100], place) == place
    assert len(places) < len(whole)


def test_texts_longer_than_a_slice_and_spans_at_their_ends(documents):
    phrase, long = letters(400), letters(repeats.AT_ONCE + 999)
    texts = {1: phrase + long, 2: long[-300:] + letters(200), 3: letters(99), 4: letters(50) + "é" + phrase[5:160] + "é" + long[1000:1201], 5: phrase, 6: phrase[:120] + "!" + phrase[:120]}
    texts |= {7: "", 8: letters(20) + long[repeats.AT_ONCE - 200 : repeats.AT_ONCE + 200], 9: "ab" * 300, 10: "b" + "ab" * 70}
    out = repeated_bytes(documents(list(texts.items()))).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out} == plain_repeats(texts)
    assert all(sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in out)


@pytest.mark.parametrize("clashes", [False, True])
def test_rows_are_joined_and_found_by_all_their_numbers(monkeypatch, clashes):
    if clashes:
        monkeypatch.setattr(repeats, "_code", lambda first, second: first.view(np.uint64) % np.uint64(3))
    rows = np.array([[random.choice([-5, 1, 2**62]), random.randrange(3), random.randrange(2), random.randrange(6), 0, k] for k in range(400)] + [[7, 7, 7, 7, 7, 7]])
    firsts, counts = {}, {}
    for row in rows.tolist():
        firsts[*row[:3]] = min(firsts.get((*row[:3],), row[3:]), row[3:])
        counts[*row[:3]] = counts.get((*row[:3],), 0) + 1
    joined = repeats._joined(np.ascontiguousarray(rows.T)).to_pylist()
    assert sorted((r["anchor"], r["content"], r["doc"], r["twin"], r["at"], r["n"]) for r in joined) == sorted((*k[:2], *v, counts[k]) for k, v in firsts.items())
    first, second = (np.ascontiguousarray(c) for c in np.unique(rows[:, :2], axis=0).T)
    known = repeats.Pairs(first, second)
    assert known.rows(first, second).tolist() == list(range(len(first)))
    assert known.rows(second + 100, first).tolist() == [-1] * len(first)
    assert repeats.Pairs(first[:0], second[:0]).rows(first, second).tolist() == [-1] * len(first)


def test_slices_of_texts_take_little_memory():
    texts = pa.array([letters(4000) for _ in range(1000)])
    list(repeats._stretches(texts.slice(0, 100)))
    tracemalloc.start()
    for _ in repeats._stretches(texts):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20


@pytest.mark.parametrize("anchors", [1, 1000])
def test_sorting_windows_takes_little_memory(anchors):
    """As many stretches as fit into one frame, each with all the windows it can have: 60 MB when every window was copied."""
    count = repeats.MANY - 96
    strings = sorted((k % anchors, k, (letters(68) + f"{'-' * 28}{k % anchors:04d}" + letters(68)).encode()) for k in range(count))
    key, doc, string = zip(*strings)
    one = pa.array(range(count + 1), pa.int32())
    column = lambda values: pa.array(values, pa.int64())
    lists = [pa.ListArray.from_arrays(one, column(doc)), pa.ListArray.from_arrays(one, pa.array([0] * count, pa.int32()))]
    zero = column([0] * count)
    batch = pa.RecordBatch.from_arrays([column(key), column(key), column(doc), zero, zero, pa.array(string, pa.binary()), *lists], repeats.DEALT)
    tracemalloc.start()
    rows = sum(out.num_rows for out in repeats._sorted_windows(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 0 and peak < 48 << 20
