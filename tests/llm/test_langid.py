from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest

from martsmith.llm import langid
from martsmith.llm.langid import Words, identified, label, learn, op8_language_id, predict, viterbi

from .conftest import edge_texts


def test_best_path_equals_brute_force():
    r = random.Random(1)
    for _ in range(400):
        n, k, penalty = r.randint(1, 7), r.randint(2, 3), r.choice([0.5, 2.0, 5.0])
        e = np.array([[-r.expovariate(0.4) for _ in range(k)] for _ in range(n)])
        e -= e.max(axis=1, keepdims=True)

        def score(path):
            return sum(e[t, x] for t, x in enumerate(path)) - penalty * sum(a != b for a, b in itertools.pairwise(path))

        best = max(map(score, itertools.product(range(k), repeat=n)))
        assert score(viterbi(e, penalty).tolist()) == pytest.approx(best)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op8_language_id(spark, sf).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held) > 0


def test_labels_of_held_out_rows_are_not_used(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from pyspark.sql import functions as F

    odd = docs.withColumn("lang", F.when(langid.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert "xx" not in learn(odd.where(~langid.held_out())).langs


def test_scripts_narrow_the_candidates_and_spans_are_labelled(spark):
    rows = [(i, "ru", "это просто русский текст о погоде и природе") for i in range(20)]
    rows += [(100 + i, "el", "αυτό είναι ένα ελληνικό κείμενο για τον καιρό") for i in range(20)]
    rows += [(200 + i, "en", "this is just some english text about the weather") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = learn(docs)
    mixed = "this is english text about the weather. Это русский текст о погоде и природе"
    new = spark.createDataFrame([(1, mixed), (2, "нет!"), (3, "12 .. 34"), (4, "καιρός"), (5, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in label(new, model, with_spans=True).collect()}
    assert [s.lang for s in got[1].spans] == ["en", "ru"]
    assert mixed[got[1].spans[0].first:got[1].spans[0].last] == "this is english text about the weather"
    assert (got[2].lang_pred, got[4].lang_pred, got[3].lang_pred, got[5].lang_pred) == ("ru", "el", "und", "und")
    assert 0.4 < got[1].score < 0.6 and got[3].score == 0
    assert sorted(r.doc_id for r in identified(new, model).collect()) == [1, 2, 4]


def test_slices_do_not_change_the_words(monkeypatch):
    r = random.Random(2)
    text = " ".join("".join(r.choice("abcdé") for _ in range(r.randint(1, 8))) for _ in range(2000))
    whole = Words(text)
    monkeypatch.setattr(langid, "SLICE", 500)
    parts = [Words(p) for _, p in langid._slices([text])]
    assert np.concatenate([p.word for p in parts]).tolist() == whole.word.tolist()
    assert np.concatenate([p.trigram for p in parts]).tolist() == whole.trigram.tolist()


def test_a_word_longer_than_a_slice_stays_whole(monkeypatch):
    monkeypatch.setattr(langid, "SLICE", 50)
    for text in ("ab " + "x" * 400 + " cd\nef", "x" * 400, "x" * 400 + "\n" + "y" * 99):
        parts = [p for _, p in langid._slices([text])]
        assert "".join(parts) == text and [w for p in parts for w in p.split()] == text.split()


def test_rows_without_an_id_are_sampled_too(spark):
    rows = [(None, "en", f"the cat number {k} sat on a mat") for k in range(3000)] + [(7, "de", f"die Katze {k} und der Hund") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    picked, count = [], langid.count_features
    try:
        langid.count_features = lambda sample: picked.append(sample.groupBy("lang").count().collect()) or count(sample)
        learn(docs, per_language=300)
    finally:
        langid.count_features = count
    assert {r.lang for r in picked[0]} == {"en", "de"} and all(200 < r["count"] < 400 for r in picked[0])


def test_edge_cases(spark, edge_docs):
    model = learn(edge_docs)
    got = predict(edge_docs, model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in edge_texts())
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in t or "")) for r, t in ((r, t) for r in got for i, t in edge_texts() if i == r.doc_id and i != 5 and i is not None))
    kept = identified(edge_docs, model)
    assert kept.columns == edge_docs.columns
    assert kept.count() == sum(any(c.isalpha() for c in t or "") for _, t in edge_texts())
    none = learn(edge_docs.limit(0))
    assert {r.lang_pred for r in predict(edge_docs, none).collect()} == {"und"}
    assert predict(edge_docs.limit(0), model).count() == 0


def test_texts_in_no_learnt_language_are_not_identified(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    model = learn(docs)
    r = random.Random(3)
    strange = [
        "ทุกคนเกิดมามีอิสระและเสมอภาคกันในศักดิ์ศรีและสิทธิ", "αυτό είναι ένα ελληνικό κείμενο για τον καιρό και τη φύση",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto",
        "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura che la diritta via era smarrita. Ahi quanto a dir qual "
        "era cosa dura esta selva selvaggia e aspra e forte che nel pensier rinnova la paura",
        " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(60))]
    strange.append(strange[4][:50] + "\n" + strange[2] * 20_000)  # in several slices
    rows = spark.createDataFrame([(-1 - i, None, t) for i, t in enumerate(strange)], docs.schema)
    kept = {x.doc_id for x in identified(docs.unionByName(rows), model).select("doc_id").collect()}
    assert kept == {x.doc_id for x in docs.collect() if any(c.isalpha() for c in x.text or "")}
