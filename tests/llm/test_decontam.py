from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from martsmith.llm.decontam import contamination, cut_contaminated, drop_contaminated, op1_decontamination

from .conftest import SF, rng_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, n=10):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        v = words(body)
        m = min(n, len(v))
        wins = {tuple(v[i:i + m]) for i in range(len(v) - m + 1)} if v else set()
        for i in range(len(w) - m + 1):
            if m and tuple(w[i:i + m]) in wins:
                hit.update(range(i, i + m))
                found.add(item)
    return len(w), len(hit), found


def items_text(found):
    return ",".join(sorted(str(i) for i in found if i is not None))


@pytest.fixture(scope="module")
def case(spark):
    a, b = rng_words(11, 30), rng_words(12, 14)
    items = [(1, a), (2, "Short ITEM"), (3, None), (4, "... "), (10, a.upper()), (None, b), (2, "Short ITEM"), (5, "été-1 été 2")]
    extra = {k: rng_words(100 + k, 20) for k in range(4)}
    w = a.split()
    docs = [(1, f"{extra[0]}, {a}; {extra[1]}"), (2, extra[2]), (3, None), (4, ""), (5, "a short, item! " + extra[3]), (6, " ".join(w[3:13])),
            (7, " ".join(w[3:12])), (8, b + " " + b), (1, f"{extra[0]}, {a}; {extra[1]}"), (1, "other text"), (None, a), (9, "ÉTÉ été 1 été 2 été"),
            (10, " ".join([rng_words(5, 20_000), a]))]
    return (spark.createDataFrame([(*d, 0, 0) for d in docs], "doc_id long, text string, words int, at int"),
            spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, len int"), docs, items)


@pytest.mark.parametrize("bound", [2_000_000, 1])
def test_equals_brute_force(case, bound):
    docs, bench, raw, items = case
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, items_text(r["items"])) for r in contamination(docs, bench, max_broadcast_rows=bound).collect())
    assert got == sorted((str(i), n, h, items_text(f)) for i, t in raw for n, h, f in [brute(t, items)])


def test_query_equals_brute_force(spark, documents):
    import pyarrow.parquet as pq

    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    got = {r.doc_id: r for r in op1_decontamination(spark, SF).collect()}
    for d in documents:
        n, h, found = brute(d["text"], items)
        r = got[d["doc_id"]]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, h, len(found), h > 0)
        assert r.items_sha256 == hashlib.sha256(items_text(found).encode()).hexdigest()


def test_documents_go_or_spans_are_cut(case):
    docs, bench, raw, items = case
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, t in raw if not brute(t, items)[1])
    clashing = docs.withColumns({c: F.lit(1) for c in ("hit_id", "hit_key", "hit_spans", "__hit_spans", "spans", "doc")})
    assert cut_contaminated(clashing, bench).columns == clashing.columns
    cut = cut_contaminated(clashing, bench).select(*docs.columns)
    assert cut.columns == docs.columns and cut.count() == len(raw)
    for r in cut.collect():
        assert not brute(r.text, items)[1]
    clean = {(i, t) for i, t in raw if not brute(t, items)[1]}
    assert clean <= {(r.doc_id, r.text) for r in cut.collect()}
    texts = [r.text for r in cut.where("doc_id = 1").collect()]
    assert any(t.startswith(rng_words(100, 20) + ", ") and t.endswith(rng_words(101, 20)) for t in texts)


def test_empty_tables(case):
    docs, bench, raw, _ = case
    assert contamination(docs.limit(0), bench).count() == 0
    got = contamination(docs, bench.limit(0))
    assert got.count() == len(raw) and got.agg(F.sum("n_hit")).first()[0] == 0


def test_edge_documents(edge_docs, case):
    assert contamination(edge_docs, case[1]).count() == edge_docs.count()
    assert drop_contaminated(edge_docs, case[1]).columns == edge_docs.columns
