from __future__ import annotations

import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martsmith.llm import packing
from martsmith.llm.packing import VOCABULARY, WordEncoder, op2_packing, pack, shortest_pack_first, slots

from .conftest import SF, edge_texts


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(public_tokenizers.path(VOCABULARY), max_words=50)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab é.,!?'s \n\u0085\x1ćÉİΣ1"))), max_size=4))
def test_word_by_word_equals_whole_texts(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(VOCABULARY)) if not hasattr(test_word_by_word_equals_whole_texts, "t") else test_word_by_word_equals_whole_texts.t
    tokenizer.encode_special_tokens = True
    test_word_by_word_equals_whole_texts.t = tokenizer
    if not hasattr(test_word_by_word_equals_whole_texts, "e"):
        test_word_by_word_equals_whole_texts.e = WordEncoder(public_tokenizers.path(VOCABULARY), max_words=50)
    got = [np.frombuffer(x, "<u4").tolist() for x in test_word_by_word_equals_whole_texts.e.encode(texts)]
    assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_special_token_names_are_text(encoder, whole):
    texts = ["a <|endoftext|> b", "it's  x.y, (don't) été, naïve.", "GELDİ. İ, geldi̇! İİ.", "ŉ. ǰ, ß! ẞ. ﬁ.", None]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == whole(texts)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 5000), max_size=20))
def test_patterns_use_each_length_as_often_as_it_occurs(histogram):
    patterns = shortest_pack_first(histogram, 64)
    used = Counter()
    for packs, pattern in patterns:
        assert packs > 0 and sum(n * c for n, c in pattern) <= 64
        for n, c in pattern:
            used[n] += packs * c
    assert used == Counter(histogram)
    taken = defaultdict(list)
    for length, lo, hi, *_ in slots(patterns):
        taken[length].append((lo, hi))
    for length, runs in taken.items():
        assert [r[0] for r in runs] == [0, *(r[1] for r in runs[:-1])] and runs[-1][1] == histogram[length]


def check(rows, docs, whole, size=2048):
    """Each id in one piece, sequences gapless and within the size."""
    want = Counter()
    for (doc, text), ids in zip(docs, whole([t for _, t in docs]), strict=True):
        raw = np.asarray([*ids, 1], "<u4").tobytes()
        for s in range(0, len(raw) // 4, size):
            part = raw[4 * s:4 * (s + size)]
            want[doc, s, len(part) // 4, zlib.crc32(part), len(raw) // 4] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    inside = defaultdict(list)
    for r in rows:
        inside[r.sequence_id].append((r.offset, r.length))
    for parts in inside.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    return sum(n for _, _, n, _, _ in want.elements()), len(inside)


def test_query(spark, documents, whole):
    tokens, sequences = check(op2_packing(spark, SF).collect(), [(d["doc_id"], d["text"]) for d in documents], whole)
    assert sequences <= tokens // 2048 + 2


@pytest.mark.parametrize("shares", [1, 7, 4096])
def test_edge_cases(edge_docs, whole, shares):
    check(pack(edge_docs, size=64, shares=shares).collect(), edge_texts(), whole, 64)


def test_ids_travel_along(edge_docs):
    for r in pack(edge_docs, with_ids=True).collect():
        assert len(r.ids) == r.length and zlib.crc32(np.asarray(r.ids, "<u4").tobytes()) == r.ids_crc32


def test_empty(edge_docs):
    assert pack(edge_docs.limit(0)).count() == 0


def test_new_words_of_many_texts_are_encoded_together(whole):
    """One call of the tokenizer for the plain words of many texts, and none for each word with marks at its end."""
    texts = [f"{a}{b}ing {a}{b}ed&&& ({a}{b}er) {a}{b}est*** {a}{b}or!" for a in "abcdefghijklm" for b in "nopqrstuvwxyz"]
    own, calls = WordEncoder(public_tokenizers.path(VOCABULARY)), []
    encode = own._ids
    own._ids = lambda words: calls.append(len(words)) or encode(words)
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == whole(texts)
    assert len(calls) < 10 and sum(calls) < 2 * len(texts)  # "(aner" is a word of its own; no other is


def test_all_ascii_marks_end_words_alone(encoder, whole):
    texts = [stem + "".join(marks) for stem in ("word", "ab1", "\u00e9t\u00e9", "it's", "<|endoftext", "o'") for marks in
             [(m,) for m in string.punctuation] + [(m, "'") for m in string.punctuation] + [("'", m) for m in string.punctuation]]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == whole(texts)


def test_texts_are_taken_together_up_to_a_size(monkeypatch):
    monkeypatch.setattr(packing, "TOGETHER", 10)
    texts = ["12345", None, "12345", "1", "x" * 30, "", "12345678901", "1"]
    assert list(packing._together(texts)) == [["12345", None, "12345"], ["1"], ["x" * 30], ["", "12345678901"], ["1"]]
    assert list(packing._together([])) == []
