"""Token counts, BPE and token files against the libraries, on odd texts."""

import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tidemark.llm.bpe import encode, encode_digest, encoded, vocabulary
from tidemark.llm import token_counts as counting
from tidemark.llm import token_files
from tidemark.llm.token_counts import most_frequent, token_counts
from tidemark.llm.frames import new_path
from tidemark.llm.token_files import Encoder, pack, read_token_files, token_file_digest, unpack, write_token_files
from tokenizers import Tokenizer

WORDS, BYTES, PIECES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXTS = [
    None, "", " ", "   ", "\n", "'", "it's we'll 's '' 've", " 's", "a  b\t\tc \n\n d ", "<|endoftext|>", "x<|endoftext|> y<|startoftext|>",
    "<s>a</s>", "▁a ▁", "é e\u0301 Σας İ ǅ", "½²ⅷ 12 345", "漢字🙂\u200b\u3000x", "\x1c a\x85b", "The the THE", "w" * 3000, "of the " * 2000, "Dup", "Dup",
]


@pytest.fixture(scope="module")
def docs(documents):
    return documents([*enumerate(TEXTS), (None, "no id"), (3, "again")])


def by_text(docs, out, *columns):
    """Results next to texts: ids of the fixture are unique except for 3 and null."""
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(tuple(r[c] for c in columns))
    return {i: sorted(v) for i, v in got.items()}, [(r.doc_id, r.text or "") for r in docs.collect()]


def expected(rows, function):
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(function(t))
    return {i: sorted(v) for i, v in want.items()}


def test_token_counts_equal_the_library(docs):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got, rows = by_text(docs, token_counts(docs, PIECES), "n_bytes", "n_tokens")
    assert got == expected(rows, lambda t: (len(t.encode()), len(model.encode(t))))


@pytest.mark.parametrize("common", [0, 3])
def test_units_that_are_not_common_are_joined(docs, monkeypatch, common):
    monkeypatch.setattr(counting, "COMMON_UNITS", common)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got, rows = by_text(docs, token_counts(docs, PIECES), "n_tokens")
    assert got == expected(rows, lambda t: (len(model.encode(t)),))


def test_most_frequent_units_fit_and_leave_no_more_frequent_one_out(spark):
    rows = [(f"u{k}", 1 << (k % 12)) for k in range(3000)]
    units = spark.createDataFrame(rows, "unit string, n long")
    for most in (0, 1, 100, 700, 2999, 3000, 9000):
        got = {r.unit: r.n for r in most_frequent(units, most).collect()}
        left = [n for u, n in rows if u not in got]
        assert len(got) <= most and (not got or not left or max(left) <= min(got.values()))
        assert len(got) >= min(most, len(rows)) - 20
    assert most_frequent(units.where("n < 0"), 5).count() == 0


def test_bpe_equals_the_library_and_decodes(docs):
    tool = Tokenizer.from_file(WORDS)

    def plain(t):
        ids = tool.encode(t, add_special_tokens=False).ids
        said = tool.decode(ids, skip_special_tokens=False)
        return len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(said.encode()).hexdigest()

    got, rows = by_text(docs, encode_digest(docs, WORDS), "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == expected(rows, plain)
    ids = {r.doc_id: r.ids for r in encode(docs, WORDS).collect() if r.doc_id is not None and r.doc_id > 3}
    assert all(ids[i] == tool.encode(TEXTS[i] or "", add_special_tokens=False).ids for i in ids)


def test_worker_keeps_no_words_of_a_task_that_is_over():
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS))), pa.array(TEXTS, pa.string())], ["id", "text"])
    tool, vocab = Tokenizer.from_file(WORDS), vocabulary(WORDS)
    running = encoded(iter([batch, batch]), WORDS)
    for _ in range(2):
        out = next(running)
        assert out["ids"].to_pylist() == [tool.encode(t or "", add_special_tokens=False).ids for t in TEXTS] and vocab.words
    assert not list(running) and not vocab.words


def test_stale_heap_entries_are_skipped():
    vocab = vocabulary(WORDS)
    tool = Tokenizer.from_file(WORDS)
    for word in ("aaaaaaa", "thethethe", "ininging", "abababab"):
        assert vocab.encode_word(word) == tool.encode(word, add_special_tokens=False).ids


@pytest.mark.parametrize("count", [0, 1, 59, 1023, 1024, 1025, 4000])
@pytest.mark.parametrize("high", [1, 2, 300, 50_000, 1 << 40, (1 << 64) - 1])
def test_simple8b_round_trip(count, high):
    ids = np.random.default_rng(count).integers(0, high, count, dtype=np.uint64, endpoint=True)
    words, block_words = pack(ids)
    assert (unpack(words, block_words, count) == ids).all()
    if high <= 300:
        assert len(words) <= count / 4 + 5


def test_token_files_hold_all_ids_in_order(docs):
    tool = Tokenizer.from_file(BYTES)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_file_digest(docs, BYTES, 2).collect()]
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for i, t in rows:
        ids = [*tool.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want


@pytest.mark.parametrize("hashes", [1, 3, (1 << 64) - 1])
@pytest.mark.parametrize("most", [5, 1_000_000])
def test_words_kept_are_found_whatever_their_hashes(monkeypatch, hashes, most):
    hashed = token_files.word_hashes
    monkeypatch.setattr(token_files, "word_hashes", lambda data, offsets: hashed(data, offsets) % np.uint64(hashes))
    monkeypatch.setattr(token_files, "CACHED_PIECES", most)
    tool, kept = Tokenizer.from_file(BYTES), Encoder(BYTES)
    for texts in (TEXTS, TEXTS[::-1], ["of the", "Dup new", "the of"], [None, ""], TEXTS):
        ids, counts = kept.encode(pa.array(texts, pa.string()))
        want = [tool.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


def test_words_kept_are_not_encoded_again():
    kept, calls = Encoder(BYTES), []

    class Counted:
        def encode_batch_fast(self, words, **options):
            calls.extend(words)
            return library.encode_batch_fast(words, **options)

    library, kept.tokenizer = kept.tokenizer, Counted()
    texts = pa.array([f"word{k} of {k}" for k in range(700)])
    first = kept.encode(texts)
    assert len(calls) == len(set(calls)) == len(kept.hashes)
    again = kept.encode(texts)
    assert len(calls) == len(set(calls)) and all((a == b).all() for a, b in zip(first, again))


def test_digest_of_token_files_needs_no_ids_in_spark(spark, docs):
    path = new_path(spark, "token-files")
    write_token_files(docs, path, BYTES, 2)
    whole, digest = read_token_files(spark, path), read_token_files(spark, path, ids=False)
    assert {(r.start, r.n_tokens, r.ids_crc32) for r in whole.collect()} == {(r.start, r.n_tokens, r.ids_crc32) for r in digest.collect()}
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens for r in whole.collect())
    plan = token_file_digest(docs, BYTES, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert ", ids_crc32#" in plan and ", ids#" not in plan


def test_empty_tables(documents):
    empty = documents([])
    assert token_counts(empty, PIECES).count() == encode_digest(empty, WORDS).count() == token_file_digest(empty, BYTES, 2).count() == 0
