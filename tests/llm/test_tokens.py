"""Token counts, the codec and packing against the tokenizer library."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_rows import base_rows, make, mixed, no_docs, odd_docs  # noqa: F401  fixtures

from plume.llm import bpe_codec, packing, token_counts
from plume.llm.bpe import merge_table

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def byte():
    return Tokenizer.from_file(BYTE)


def _noise(n):
    rng = random.Random(3)
    parts = ["abc", "  ", " ", "\n", "\n\n", "\t", "'s", "'S", "'re", "'", "l'l", "!!", "12", "é", "é", "İ", "Σας", "ΑΣ", "日本",
             "\U0001f600", "\x85", "\x1c", " ", "<|endoftext|>", "<|startoftext|>", "hello", "Words"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_counts_equal_the_library(spark, mixed, word):
    rows, docs = mixed
    got = Counter(tuple(r) for r in token_counts.token_counts(docs, WORD, 100).collect())
    want = Counter()
    for i, t, _, _ in rows:
        n = len(word.encode(t or "", add_special_tokens=False).ids)
        want[(i, len((t or "").encode()), n, n > 100)] += 1
    assert got == want


def test_counts_of_noise(word):
    texts = _noise(600)
    assert token_counts.count_texts(texts, WORD).tolist() == [len(e.ids) for e in word.encode_batch(texts, add_special_tokens=False)]


def test_prefix_table_counts_every_prefix(word):
    text = "the naturally'll don't 12 unbelievable!! words<|endoftext|> end"
    table = token_counts.prefix_table(text, WORD)
    assert table.text == text
    inside = range(text.index("<|") + 1, text.index("|>") + 2)  # a special string that is cut is ordinary text
    for k in range(len(text) + 1):
        if k not in inside:
            assert table.count(k) == len(word.encode(text[:k], add_special_tokens=False).ids), text[:k]


def _longest(text, budget, word):
    """By brute force: the longest beginning that the library gives at most ``budget`` tokens."""
    return max(n for n in range(len(text) + 1) if len(word.encode(text[:n], add_special_tokens=False).ids) <= budget)


@pytest.mark.parametrize("text", ["some words that will be cut for a budget of tokens", "unbelievabletherein" * 8, "they'll  don't we've 123 !!",
                                  "日本語のテキスト é naïve", "", "  ", "y" * 60])
def test_longest_within_budget(word, text):
    table = token_counts.prefix_table(text, WORD)
    for budget in range(15):
        n, want = table.longest_within(budget), _longest(text, budget, word)
        assert text[:n].rstrip() == text[:want].rstrip(), (text, budget)
        assert table.count(n) == len(word.encode(text[:n], add_special_tokens=False).ids) <= budget


def test_truncated_texts(spark, odd_docs, word):
    texts = Counter((r.doc_id, r.text) for r in odd_docs.collect())
    rows = token_counts.truncated(odd_docs, WORD, [0, 5, 1000]).collect()
    assert len(rows) == 3 * sum(texts.values())
    for r in rows:
        n = len(word.encode(r.text, add_special_tokens=False).ids)
        assert r.n_tokens == n <= r.budget and r.n_chars == len(r.text)
    assert {r.n_tokens for r in rows if r.doc_id == 900013} == {0, 5, 1000}  # one long run of letters is cut inside
    assert token_counts.truncated(odd_docs.limit(0), WORD, [3]).collect() == []


def test_codec_equals_the_library(spark, mixed, word):
    rows, docs = mixed
    got = Counter(tuple(r) for r in bpe_codec.codec(docs, WORD).collect())
    want = Counter()
    for i, t, _, _ in rows:
        ids = word.encode(t or "", add_special_tokens=False).ids
        back = word.decode(ids, skip_special_tokens=False)
        want[(i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())] += 1
    assert got == want


def test_codec_gives_ids_and_text(spark, odd_docs, word):
    for r in bpe_codec.codec(odd_docs, WORD, texts_too=True).collect():
        assert r.decoded == bpe_codec.decode_ids(r.ids, WORD) == word.decode(r.ids, skip_special_tokens=False)


def test_codec_of_noise(word):
    texts = _noise(600)
    assert bpe_codec.encode_ids(texts, WORD) == [e.ids for e in word.encode_batch(texts, add_special_tokens=False)]


def test_tree_and_prefixes_agree():
    table = merge_table(WORD)
    rng = random.Random(5)
    words = [bytes(rng.choice(b"abeinorst") for _ in range(rng.randint(1, 40))) for _ in range(300)] + [b"a" * 700, b"ab" * 300]
    for w, ids in zip(words, table.encode_many(words), strict=True):
        assert table.prefix_counts(w, every=False) == [len(ids)]
    w = b"unbelievabletherein"
    assert table.prefix_counts(w) == [len(x) for x in table.encode_many([w[:k] for k in range(1, len(w) + 1)])]


def _check_packing(rows, result, byte, capacity, end):
    want = Counter()
    for i, t, _, _ in rows:
        ids = byte.encode(t or "", add_special_tokens=False).ids + [end]
        first = (len(ids) - 1) % capacity + 1
        at = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(at, at[1:], strict=False)):
            want[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in result) == want
    bins = {}
    for r in result:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return bins


@pytest.mark.parametrize("group", [50_000, 40])
def test_packing(spark, mixed, byte, group):
    rows, docs = mixed
    result = packing.packed(docs, BYTE, 1024, 2, group_items=group).collect()
    bins = _check_packing(rows, result, byte, 1024, 2)
    total = sum(r.length for r in result)
    assert len(bins) <= -(-total // 1024) + (1 if group > 1000 else 3)


def test_packing_of_items_that_do_not_fit_together(spark, byte):
    docs = make(spark, [(i, " the" * 599, "en", "s") for i in range(90)])
    result = packing.packed(docs, BYTE, 1024, 2, group_items=20).collect()
    assert len({r.sequence_id for r in result}) == 90


def test_packing_merges_down_to_one_group(spark, byte):
    """Bins of 600 hardly merge, but each group's small ones still fit into them."""
    rng = random.Random(8)
    sizes = [599] * 400 + [rng.randint(20, 60) for _ in range(30)]
    rng.shuffle(sizes)
    rows = [(i, " the" * n, "en", "s") for i, n in enumerate(sizes)]
    for group in (10, 37, 50_000):
        result = packing.packed(make(spark, rows).repartition(4), BYTE, 1024, 2, group_items=group).collect()
        bins = _check_packing(rows, result, byte, 1024, 2)
        assert len(bins) == 400
    rows = [(i, " the" * rng.choice([150, 300, 450, 700]), "en", "s") for i in range(200)]
    fills = Counter()
    for r in packing.packed(make(spark, rows), BYTE, 1024, 2, group_items=7).collect():
        fills[r.sequence_id] += r.length
    assert sum(sorted(fills.values())[:2]) > 1024  # no two sequences fit together


def test_best_fit_prefers_the_fullest_bin():
    bins, offsets = packing.best_fit(np.array([7, 6, 3, 3, 1]), 10)
    assert bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 7, 6, 9]


def test_token_bytes_of_noise(byte):
    texts = _noise(600)
    got = [np.frombuffer(b, "<u4").tolist() for b in packing.token_bytes(texts, BYTE)]
    assert got == [e.ids for e in byte.encode_batch(texts, add_special_tokens=False)]


def test_no_documents(spark, no_docs):
    assert token_counts.token_counts(no_docs, WORD, 10).collect() == []
    assert bpe_codec.codec(no_docs, WORD).collect() == []
    assert packing.packed(no_docs, BYTE, 1024, 2).collect() == []


def _alike(a, b):
    """Two words that every polynomial hash modulo 2^64 with an odd base confuses."""
    one = a
    while len(one) < 1024:
        one += one.translate(str.maketrans(a + b, b + a))
    return one, one.translate(str.maketrans(a + b, b + a))


@pytest.mark.parametrize("letters", ["ab", "in", "th", "er", "日本"])
def test_words_that_share_a_hash(word, byte, letters):
    one, other = _alike(*letters)
    texts = [f"{one} {other}", f"{other} {one} {other}", f"x {one}", other]
    assert bpe_codec.encode_ids(texts, WORD) == [e.ids for e in word.encode_batch(texts, add_special_tokens=False)]
    assert token_counts.count_texts(texts, WORD).tolist() == [len(e.ids) for e in word.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u4").tolist() for b in packing.token_bytes(texts, BYTE)] \
        == [e.ids for e in byte.encode_batch(texts, add_special_tokens=False)]


def _byte_ids(texts):
    return [np.frombuffer(b, "<u4").tolist() for b in packing.token_bytes(texts, BYTE)]


def test_batches_whose_new_words_are_white_space(byte):
    packing._encoder.cache_clear()
    for texts in (["\n \n"], ["hello world"], ["hello  \n\n world"], ["\t\t", "", "   "], [""], ["hello"]):
        assert _byte_ids(texts) == [e.ids for e in byte.encode_batch(texts, add_special_tokens=False)]


def test_white_space_documents(spark, byte):
    rows = [(k, t, "en", "s") for k, t in enumerate(["\n \n", "  ", "\t", "", None, "hello world", "hello  \n\n world"])]
    for part in (rows[:1], rows):
        _check_packing(part, packing.packed(make(spark, part), BYTE, 8, 2).collect(), byte, 8, 2)


def test_many_small_batches(word, byte):
    texts = _noise(12_000)
    own, ids = [], []
    for k in range(0, len(texts), 3):
        own += _byte_ids(texts[k:k + 3])
        ids += bpe_codec.encode_ids(texts[k:k + 3], WORD)
    assert own == [e.ids for e in byte.encode_batch(texts, add_special_tokens=False)]
    assert ids == [e.ids for e in word.encode_batch(texts, add_special_tokens=False)]
