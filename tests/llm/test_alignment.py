"""Alignment of two tokenizers against the libraries and plain loops."""

import random
from bisect import bisect_left
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tidemark.llm.alignment import align, alignments, merge_path
from tidemark.llm.bpe import byte_symbols
from tokenizers import Tokenizer

BYTES, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXTS = [
    None, "", " ", "   ", "\n", "it's we'll 's", " leading", "trailing ", "a  b\t\tc \n\n d ", "<|endoftext|>", "x<|endoftext|> y", "<s>a</s>",
    "▁a", "a▁ b", "é é Σας", "½²ⅷ 12 345", "漢字🙂​　x", "\x00a\x1c", "The the THE", "w" * 3000, "of the " * 2000, "Dup here", "Dup here",
    " ".join(random.Random(3).choice(["tion", "eauéx", "über", "and", "12"]) for _ in range(4000)),
]


def plain(rows):
    tool, model = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    tool.encode_special_tokens = True
    byte_of = {s: b for b, s in enumerate(byte_symbols())}
    links = []
    out = []
    for i, text in rows:
        ids_a = tool.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = model.encode(text) if text else []
        said_a = [bytes(byte_of[c] for c in tool.id_to_token(k)) for k in ids_a]
        said_b = [bytes([int(model.id_to_piece(k)[3:5], 16)]) if model.is_byte(k) else model.id_to_piece(k).replace("▁", " ").encode() for k in ids_b]
        if not text or not b"".join(said_a) == b"".join(said_b) == (" " + text).encode():
            ids_a, ids_b = [], []
        end_a, end_b = (np.cumsum([len(s) for s in said])[: len(ids)].tolist() if ids else [] for said, ids in ((said_a, ids_a), (said_b, ids_b)))
        both = sorted(set(end_a) & set(end_b))
        members = [([], []) for _ in both]
        for side, (ids, end) in enumerate(((ids_a, end_a), (ids_b, end_b))):
            for k, e in zip(ids, end):
                members[bisect_left(both, e)][side].append(str(k))
        groups = ["|".join(map(",".join, m)) for m in members]
        own, b = [], 0
        for k, (start, end) in enumerate(zip([0, *end_a], end_a)):
            while b < len(end_b) and end_b[b] <= start:
                b += 1
            at = b
            while at < len(end_b) and (end_b[at - 1] if at else 0) < end:
                own.append((ids_a[k], ids_b[at]))
                at += 1
        links.append(own)
        out.append([i, len(ids_a), len(ids_b), len(both), len(own), sha256(";".join(groups).encode()).hexdigest() if groups else ""])
    counts = Counter(p for own in links for p in set(own))
    highest = {}
    for (a, _), n in counts.items():
        highest[a] = max(n, highest.get(a, 0))
    return [(*row[:5], sum(counts[p] == highest[p[0]] for p in own), sum(counts[p] for p in own), row[5]) for row, own in zip(out, links)]


@pytest.mark.parametrize("common", [1 << 19, 40, 0])
def test_alignment_equals_plain_loops(documents, common):
    rows = [*enumerate(TEXTS), (None, "no id"), (3, "again")]
    got = [tuple(r) for r in align(documents(rows), BYTES, PIECES, common=common).collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)


def test_alignment_of_the_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, align(docs, BYTES, PIECES).collect())) == sorted(plain(rows))


@pytest.mark.parametrize("piece", [1, 2, 7, 512])
def test_pieces_of_the_merge_path_are_independent(piece):
    numbers = np.random.default_rng(piece)
    for size_a, size_b in ((0, 0), (0, 5), (9, 0), (40, 300), (300, 300)):
        a, b = (np.sort(numbers.choice(600, n, replace=False)) for n in (size_a, size_b))
        at_a, at_b, from_a = merge_path(a, b, piece)
        want = sorted([(v, 0, i) for i, v in enumerate(a)] + [(v, 1, j) for j, v in enumerate(b)])
        assert [(0 if f else 1, i if f else j) for i, j, f in zip(at_a, at_b, from_a)] == [w[1:] for w in want]
        assert all(i + j == k for k, (i, j) in enumerate(zip(at_a, at_b)))


def test_groups_as_text_and_empty_table(documents):
    got = alignments(documents([(1, "The the")]), BYTES, PIECES).first()
    assert got.n_groups == got.groups.count(";") + 1 and got.n_a == sum(g.split("|")[0].count(",") + 1 for g in got.groups.split(";"))
    assert align(documents([]), BYTES, PIECES).count() == 0
