from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from martsmith.llm.linededup import OP9_SQL, dedup_lines, host_of

from .conftest import edge_texts


SPACE = " \t\x0b\x0c\r"


def is_boilerplate(k, n, ratio, z):
    """By the lower end of Wilson's interval for k of n."""
    p = k / n
    low = (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    return k > 1 and low > ratio


def brute(rows, ratio, z, copies_once=False):
    """rows: (host, text) -> list of (text, n_lines, n_dropped)."""
    total, seen = Counter(), defaultdict(int)
    for host, text in set(rows) if copies_once else rows:
        total[host or ""] += 1
        for line in {x.strip(SPACE) for x in (text or "").split("\n")} - {""}:
            seen[host or "", line] += 1
    out = []
    for host, text in rows:
        if text is None:
            out.append((None, 0, 0))
            continue
        lines = text.split("\n")
        kept = [x for x in lines if not x.strip(SPACE) or not is_boilerplate(seen[host or "", x.strip(SPACE)], total[host or ""], ratio, z)]
        out.append(("\n".join(kept) if len(kept) < len(lines) else text, len(lines), len(lines) - len(kept)))
    return out


def pages():
    rows = []
    for k in range(60):
        host = ["a", "a", "b", None, ""][k % 5]
        rows.append((k, host, "\n".join([" Menu ", f"tab {k % 3}\t\r", f"line {k}", "", "Menu", f"half {k % 2}", f"rare {k % 20}", "x" * (k % 3)])))
    rows += [(60, "a", "Menu"), (61, "a", "Menu"), (62, "a", None), (63, "b", ""), (60, "a", "Menu"), (60, "a", "other"), (None, "b", "Menu\nq")]
    return rows


@pytest.mark.parametrize("bound", [500_000, 0])
@pytest.mark.parametrize(("ratio", "z"), [(0.1, 1.96), (0.2, 1.0)])
def test_equals_brute_force(spark, bound, ratio, z):
    rows = pages()
    docs = spark.createDataFrame([(*r, 0, 0, 0) for r in rows], "doc_id long, source string, text string, n_lines int, line int, host int")
    got = dedup_lines(docs, ratio=ratio, z=z, max_broadcast_rows=bound)
    assert got.columns == [*docs.columns, "_n_lines", "n_dropped"]
    want = brute([(h, t) for _, h, t in rows], ratio, z)
    assert Counter((r.doc_id, r.source, r.text, r._n_lines, r.n_dropped) for r in got.collect()) == Counter(
        (i, h, *w) for (i, h, _), w in zip(rows, want, strict=True))


def test_edge_cases(edge_docs):
    got = dedup_lines(edge_docs)
    assert got.count() == len(edge_texts())
    assert dedup_lines(edge_docs.limit(0)).count() == 0


def test_hosts_of_urls(spark):
    urls = spark.createDataFrame([("http://A.example.com/x?q",), (None,), ("no url",)], "url string")
    assert [r[0] for r in urls.select(host_of(F.col("url"))).collect()] == ["a.example.com", None, None]


def test_small_hosts_lose_their_menu(spark):
    """No host is too small but one of a single page; lines that end in a carriage return are the same lines."""
    rows = [(f"h{n}", f"Menu{chr(13) * (k % 2)}\npage {k} of {n}\n" + ("once" if k == 0 else "")) for n in (1, 2, 5, 9, 10) for k in range(n)]
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, source string, text string")
    for r in dedup_lines(docs).collect():
        assert ("Menu" in r.text) == (r.source == "h1") and "page" in r.text
        assert r.text.endswith("once") == ("page 0 " in r.text)


def test_threshold_by_host_size():
    assert [min(k for k in range(1, n + 1) if is_boilerplate(k, n, 0.1, 1.96)) for n in (2, 9, 100, 10_000)] == [2, 3, 16, 1059]


def test_repeated_ids_against_sql(spark, tmp_path):
    """Rows of one id, null ids and hosts: pages of their own in the SQL too."""
    import duckdb

    docs = spark.createDataFrame(pages(), "doc_id long, source string, text string")
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    got = dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))
    assert Counter(map(tuple, got.collect())) == Counter(con.execute(OP9_SQL).fetchall())
