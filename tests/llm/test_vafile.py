from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from martsmith.llm import vafile
from martsmith.llm.vafile import top_k

SCHEMA = "vec_id long, embedding array<float>, rank int, score int"


def brute(rows, k, query):
    import numpy as np

    usable = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in sorted((r for r in usable if query(r[0])), reverse=True):
        asked[i] = v
    out = []
    for q, v in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in usable if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("block,query_bytes,bits", [(4096, 1 << 24, 6), (5, 200, 2), (16, 400, 8)])
def test_equals_brute_force(spark, monkeypatch, block, query_bytes, bits):
    monkeypatch.setattr(vafile, "BLOCK", block)
    r = random.Random(block)
    rows = [(i, [r.gauss(0, 1) for _ in range(6)]) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(30)]  # ties
    rows += [(i, [0.5, -0.25]) for i in (400, 401, 402)]  # another length
    rows += [(500, None), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (502, [float("nan")] * 6), (503, [float("inf")] * 6), (None, [1.0] * 6), (504, []), (510, [])]
    rows += [rows[0], rows[7]]  # repeated
    data = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], SCHEMA)
    got = sorted(map(tuple, top_k(data, F.col("vec_id") % 10 == 0, k=7, query_bytes=query_bytes, bits=bits).collect()))
    assert got == brute(rows, 7, lambda i: i % 10 == 0)


def test_empty(spark):
    data = spark.createDataFrame([], SCHEMA)
    assert top_k(data, F.col("vec_id") % 10 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0], 0, 0)], SCHEMA)
    assert top_k(one, F.col("vec_id") % 10 == 0).count() == 0


@pytest.mark.parametrize("block", [4096, 7])
def test_large_components_take_part(spark, monkeypatch, block):
    monkeypatch.setattr(vafile, "BLOCK", block)
    r = random.Random(8)
    rows = [(i, [r.gauss(0, 1) for _ in range(6)]) for i in range(60)]
    rows += [(100 + i, [r.gauss(0, 10.0 ** r.randint(3, 6)) for _ in range(6)]) for i in range(60)]
    rows += [(200, [1e5] * 6), (201, [65536.0] + [0.0] * 5), (202, [1e5] * 6), (203, [-65536.0] * 6)]
    rows += [(300, [0.0, 0.0, 0.0, 0.0, 0.0, 1.0]), (301, [0.0, 0.0, 0.0, 0.0, 0.0, -3e38])]
    data = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], SCHEMA)
    every = brute(rows, 5, lambda i: True)
    over = {q for q, *_, s in every if abs(s) >= 1 << 63}
    held = {i for i, _ in rows} - over
    large = {i for i, v in rows if max(map(abs, v)) > 500_000}  # such scores need not fit a long
    assert len(held & large) > 5 and len(over) > 5 and {200, 201} <= held
    got = top_k(data, F.col("vec_id").isin(*held), k=5).collect()
    assert sorted(map(tuple, got)) == [x for x in every if x[0] in held]
    with pytest.raises(Exception, match="fits no long"):
        top_k(data, F.col("vec_id").isin(*over), k=5).collect()


def test_exact_scores_of_large_vectors():
    import numpy as np

    r = np.random.default_rng(9)
    q, x = r.normal(0, 1e20, (9, 5)), r.normal(0, 1e3, (40, 5))
    x[::3] = np.round(x[::3]) * 1e300
    x[1] = x[2] = x[0]
    own = np.zeros((9, 40), bool)
    own[4, 3] = True
    for j, (left, scores) in enumerate(vafile.wide_scores(q, x, own, 6)):
        every = {i: sum(vafile.integer(a) * vafile.integer(b) for a, b in zip(q[j].tolist(), x[i].tolist(), strict=True)) for i in range(40) if not own[j, i]}
        assert dict(zip(left.tolist(), scores, strict=True)).items() <= every.items()
        bar = sorted(every.values())[-6]
        assert {i for i, s in every.items() if s >= bar} <= set(left.tolist())


def test_an_unusable_row_of_a_query_id_takes_no_part(spark):
    """Null components sort first: such a row must not stand for its id."""
    nan, inf = float("nan"), float("inf")
    for bad in ([None, 1.0], [nan, 1.0], [-inf, 0.0], None):
        rows = [(100, bad), (100, [1.0, 2.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (200, bad)]
        data = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = top_k(data, F.col("vec_id") % 100 == 0).where("query_id = 100").collect()
        assert sorted(tuple(r) for r in got) == [(100, 1, 2, 2 * 1024 * 1024), (100, 2, 1, 1024 * 1024)]
