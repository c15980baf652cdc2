from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martsmith.llm.pairmaps import (
    VOCABULARY_A,
    VOCABULARY_B,
    Aligner,
    align,
    bitmaps,
    op11_pair_alignment,
    pairs,
    slots_in,
)

from .conftest import SF, counted, edge_texts, rng_words

A = Tokenizer.from_file(public_tokenizers.path(VOCABULARY_A))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(VOCABULARY_B))


def letters() -> dict[str, int]:
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + k): b for k, b in enumerate(rest)}}


LETTERS = letters()


def tokens(text):
    """[(id, bytes)] by A and by B of whole texts; None if the bytes don't agree with the text."""
    if not text:
        return None
    raw = (" " + text).encode()
    a = [(i, bytes(LETTERS[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in B.encode(text):
        p = B.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode()))
    if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
        return None
    return a, b


def grouped(text):
    """Groups [(ids of A, ids of B)] of a text."""
    both = tokens(text)
    if both is None:
        return None
    ends = []
    for side in both:
        at, out = 0, {}
        for i, x in side:
            at += len(x)
            out[at] = i
        ends.append(out)
    out, last = [], 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        out.append(([i for e, i in ends[0].items() if last < e <= cut], [i for e, i in ends[1].items() if last < e <= cut]))
        last = cut
    return out


def brute(rows):
    of = [grouped(t) for _, t in rows]
    links = [[(g[0][-1], g[1][-1]) for g in groups or []] for groups in of]
    count = Counter(x for own in links for x in own)
    best: dict = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for (i, t), groups, own in zip(rows, of, links, strict=True):
        if groups is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        told = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        a, b = tokens(t)
        out.append((i, len(a), len(b), len(groups), len(own), sum(count[x] == best[x[1]] for x in own), sum(count[x] for x in own),
                    hashlib.sha256(told.encode()).hexdigest()))
    return out, count, Counter(x for own in links for x in set(own)), best


@pytest.fixture(scope="module")
def aligner():
    return Aligner(public_tokenizers.path(VOCABULARY_A), public_tokenizers.path(VOCABULARY_B), max_units=50)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab é.,!?'s \n\t \x1c▁İ1  "))), max_size=4))
def test_units_equal_whole_texts(aligner, texts):
    for text, (n_a, n_b, codes, sha) in zip(texts, aligner.align(texts), strict=True):
        groups = grouped(text)
        want = [g[0][-1] * aligner.size_b + g[1][-1] for g in groups or []]
        told = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups or [])
        both = tokens(text) or ([], [])
        assert (n_a, n_b, codes.tolist(), sha) == (len(both[0]), len(both[1]), want, hashlib.sha256(told.encode()).hexdigest() if groups else "")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 79)), max_size=400))
def test_planes_hold_documents_and_multiplicities(links):
    codes, slots = np.array([c for c, _ in links], np.int64), np.array([s for _, s in links], np.int64)
    got: Counter = Counter()
    docs: dict = defaultdict(set)
    for plane, code, dense, bits in bitmaps(codes, slots, 80):
        for c, d, x in zip(code.tolist(), dense.tolist(), bits if isinstance(bits, list) else bits.to_pylist(), strict=True):
            assert len(x) <= 10
            for s in slots_in(d, x).tolist():
                got[c, s] += 1 if plane == 0 else 1 << (plane - 1)
                if plane == 0:
                    docs[c].add(s)
    assert got == Counter(links)
    assert all(docs[c] == {s for k, s in links if k == c} for c, _ in links)


def texts():
    return [*edge_texts()[:4], *edge_texts()[5:], (20, rng_words(9, 3_000)), (21, "a ▁ b"), (22, "x <s> <|endoftext|> </s> <0x41>"), (23, "the the the " * 60),
            (24, " leading"), (25, "trailing  "), (26, "tab\t and\n lines\r\n")]


@pytest.mark.parametrize(("links", "docs"), [(1 << 22, 1 << 16), (500, 3)])
def test_equals_brute_force(spark, links, docs):
    rows = texts()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, slot int, chunk int").repartition(3)
    want, count, n_docs, best = brute(rows)
    assert counted(align(df, chunk_links=links, chunk_docs=docs).collect()) == counted(want)
    assert counted(pairs(df, chunk_links=links, chunk_docs=docs).collect()) == counted(
        [(a, b, n_docs[a, b], n, n == best[b]) for (a, b), n in count.items()])


def test_query(spark, documents):
    got = op11_pair_alignment(spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert counted(got.collect()) == counted(brute([(d["doc_id"], d["text"]) for d in documents])[0])


def test_empty(edge_docs):
    assert align(edge_docs.limit(0)).count() == 0
    assert align(edge_docs.where("text is null")).collect()[0][1:] == (0, 0, 0, 0, 0, 0, "")
