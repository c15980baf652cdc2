from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from martsmith.llm.lattice import SPACE, VOCABULARY, Lattice, op6_lm_score, score_texts, words_of

from .conftest import SF, edge_texts


def spelled(lattice, word):
    """Sum over all ways to cut the word."""
    text, total = SPACE + word, 0.0
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        parts, at = [], 0
        for k, c in enumerate(cuts, 1):
            if c:
                parts.append(text[at:k])
                at = k
        parts.append(text[at:])
        if all(p in lattice.piece or len(p) == 1 for p in parts):
            total += math.exp(sum(lattice.piece[p] if p in lattice.piece else sum(lattice.byte[b] for b in p.encode()) for p in parts))
    return math.log(total)


def test_forward_recursion_sums_over_all_segmentations():
    lattice = Lattice({300: 50, 400: 9, 29871: 1000}, 3, public_tokenizers.path(VOCABULARY))
    for word in ("the", "hello", "été", "x☃y", "there,and", "a"):
        assert lattice.word(word) == pytest.approx(spelled(lattice, word), abs=1e-9)
    assert math.isfinite(lattice.word("ab" * 20_000))


def expected(lattice, word):
    """Expected pieces by trying all ways to cut the word."""
    text, ways = SPACE + word, []
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        parts, at = [], 0
        for k, c in enumerate([*cuts, 1], 1):
            if c:
                parts.append(text[at:k])
                at = k
        if all(p in lattice.piece or len(p) == 1 for p in parts):
            ids = [i for p in parts for i in ([lattice.id_of[p]] if p in lattice.piece else [lattice.byte_id[b] for b in p.encode()])]
            score = sum(lattice.piece[p] if p in lattice.piece else sum(lattice.byte[b] for b in p.encode()) for p in parts)
            ways.append((math.exp(score), ids))
    total, out = sum(w for w, _ in ways), Counter()
    for w, ids in ways:
        for i in ids:
            out[i] += w / total
    return out


def test_expected_pieces_are_those_of_all_segmentations():
    lattice = Lattice({300: 50, 400: 9, 29871: 1000}, 3, public_tokenizers.path(VOCABULARY))
    for word in ("the", "hello", "été", "x☃y", "there,and", "a"):
        got = [0.0] * lattice.size
        lattice.expect(word, 3, got)
        want = expected(lattice, word)
        assert {i: x for i, x in enumerate(got) if x} == pytest.approx({i: 3 * x for i, x in want.items()}, abs=1e-9)
    long = [0.0] * lattice.size
    lattice.expect("ab" * 20_000, 1, long)
    assert math.isfinite(sum(long))


def test_rounds_raise_the_likelihood_of_the_training_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    totals = [sum(r.score for r in score_texts(docs, F.lit(True), rounds=n).collect()) for n in (0, 1, 2)]
    assert totals[0] < totals[1] < totals[2]


def test_score_is_the_lattice_marginal(spark):
    """The brute force over all cuts, with the scores of one round estimated by the brute force too."""
    path = public_tokenizers.path(VOCABULARY)
    texts = [(1, "the cat the"), (2, "a théâtre"), (3, "Thé cat☃"), (4, None)]
    encoder = sentencepiece.SentencePieceProcessor(model_file=path)
    words = Counter(w.decode() for _, t in texts for w in words_of(t))
    first = Counter()
    for w, c in words.items():
        for i in encoder.encode(w):
            first[i] += c
    lattice, again = Lattice(first, 4, path), Counter()
    for w, c in words.items():
        for i, x in expected(lattice, w).items():
            again[i] += c * x
    lattice = Lattice(again, 4, path)
    for r in score_texts(spark.createDataFrame(texts, "doc_id long, text string"), F.lit(True)).collect():
        want = lattice.end + sum(spelled(lattice, w.decode()) for w in words_of(dict(texts)[r.doc_id]))
        assert r.score == pytest.approx(want / math.log(10), rel=1e-9)


@pytest.mark.parametrize("common", [2e-6, 0.01, 0.5])
def test_base_scores_and_counts(spark, documents, common):
    def held(i):
        return zlib.crc32(str(i).encode()) % 7 == 2

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in score_texts(docs, F.crc32(F.col("doc_id").cast("string")) % 7 != 2, common=common).collect()}
    counts, ends = Counter(), 0
    for d in documents:
        if not held(d["doc_id"]):
            counts.update(words_of(d["text"]))
            ends += 1
    total, kinds = sum(counts.values()) + ends, len(counts) + 1
    for d in documents:
        words, r = words_of(d["text"]), got[d["doc_id"]]
        want = sum(math.log10((c + 1) / (total + kinds + 1)) for c in [*(counts[w] for w in words), ends])
        assert r.base_score == pytest.approx(want, rel=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words) + 1, 1 + sum(counts[w] > 0 for w in words), total)
        assert r.score < 0 and math.isfinite(r.score)


def test_scores_do_not_depend_on_the_way_words_travel(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one, two = ({r.doc_id: r.score for r in score_texts(docs, F.lit(True), common=c).collect()} for c in (1e-9, 1.0))
    assert one == pytest.approx(two, rel=1e-9)


def test_text_of_the_corpus_is_likelier_than_scrambled_text(spark, documents):
    own = [(d["doc_id"], d["text"]) for d in documents[:60]]
    odd = [(1000 + i, " ".join(w[::-1] for w in t.split())) for i, t in own]
    frame = spark.createDataFrame(own + odd, "doc_id long, text string")
    got = {r.doc_id: r.score for r in score_texts(frame, F.col("doc_id") < 30).collect()}
    assert sum(got[i] > got[1000 + i] for i, _ in own) >= 58


def test_edge_cases(spark, edge_docs):
    got = score_texts(edge_docs, F.col("doc_id").isNotNull())
    rows = got.collect()
    assert len(rows) == len(edge_texts())
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == Counter((i, len((t or "").encode().lower().split()) + 1) for i, t in edge_texts())
    none = score_texts(edge_docs, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in none)
    assert score_texts(edge_docs.limit(0), F.lit(True)).count() == 0


def test_query(spark, documents):
    got = op6_lm_score(spark, SF).collect()
    assert {r.doc_id: r.held_out for r in got} == {d["doc_id"]: zlib.crc32(str(d["doc_id"]).encode()) % 7 == 2 for d in documents}
