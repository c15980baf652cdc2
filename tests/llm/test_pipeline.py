from __future__ import annotations

from collections import Counter

import pyarrow.parquet as pq

import corpus_pipeline
from martsmith.llm.common import staged

from .conftest import SF, edge_texts
from .test_decontam import brute as contaminated
from .test_linededup import brute as cut_lines
from .test_simhash import brute_components, brute_fingerprint


def test_stages_against_brute_force(spark):
    """Each stage's rows from its own input, on the whole small table."""
    bench = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        docs = staged(stage(spark, docs, SF), f"test-{name}")
        seen[name] = before, [r.asDict() for r in docs.collect()]
        if name != "packing":
            assert docs.columns == columns

    before, after = seen["language_id"]
    assert {d["doc_id"] for d in after} == {d["doc_id"] for d in before if any(c.isalpha() for c in d["text"] or "")}
    before, after = seen["line_dedup"]
    want = cut_lines([(d["source"], d["text"]) for d in before], 0.1, 1.96, copies_once=True)
    assert {d["doc_id"]: (d["text"], d["n_chars"]) for d in after} == {
        d["doc_id"]: (t, len(t) if n else d["n_chars"]) for d, (t, _, n) in zip(before, want, strict=True)}
    before, after = seen["simhash_dedup"]
    roots = brute_components([brute_fingerprint(d["text"]) for d in before])
    least = {}
    for d, r in zip(before, roots, strict=True):
        least[r] = min(d["doc_id"], least.get(r, d["doc_id"]))
    assert sorted(d["doc_id"] for d in after) == sorted(least.values())
    before, after = seen["decontamination"]
    assert {d["doc_id"] for d in after} == {d["doc_id"] for d in before if not contaminated(d["text"], bench)[1]}
    before, after = seen["packing"]
    assert {d["doc_id"] for d in after} == {d["doc_id"] for d in before}
    used = Counter()
    for d in after:
        used[d["sequence_id"]] += d["length"]
    assert max(used.values()) <= 2048


def test_edge_cases(spark, edge_docs, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "table", lambda s, d, n: edge_docs if n == "documents" else s.read.parquet(f"{d}/{n}.parquet"))
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} <= {i for i, _ in edge_texts()} and got
    empty = edge_docs.limit(0)
    monkeypatch.setattr(corpus_pipeline, "table", lambda s, d, n: empty if n == "documents" else s.read.parquet(f"{d}/{n}.parquet"))
    assert corpus_pipeline.run(spark, SF).count() == 0


def test_stub_pages_are_cut_and_copies_stay(spark):
    menu = "Home\nAbout\nCookies"
    rows = [(i, f"{menu}\nown line {i}") for i in range(30)] + [(100, menu), (101, "About\n\nHome")]
    rows += [(200 + i, "one article\nof two lines") for i in range(20)]
    docs = spark.createDataFrame([(i, t, "s", len(t)) for i, t in rows], "doc_id long, text string, source string, n_chars int")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.without_boilerplate(spark, docs, SF).collect()}
    assert got == {**{i: (f"own line {i}", len(f"own line {i}")) for i in range(30)}, 100: ("", 0), 101: ("", 0),
                   **{i: (t, len(t)) for i, t in rows if i >= 200}}
