from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martsmith.llm.periodic import (
    is_run,
    merged,
    octaves,
    op12_periodic_runs,
    periodic_runs,
    solve,
    step_of,
    tiles,
    with_repeats,
    z_function,
)

from .conftest import SF, counted, edge_texts


def smallest_period(words) -> int:
    return next(q for q in range(1, len(words) + 1) if all(words[i] == words[i + q] for i in range(len(words) - q)))


def brute(words) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by trying all periods."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(24, 3 * q) and smallest_period(words[i:i + length]) == q:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = (text or "").encode().split()
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    return (doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else [None] * 4),
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def repeated(doc_id, text):
    """The text of the contract: every tenth document repeats a part of itself."""
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return text
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[i if i < a else a + (i - a) % p] for i in range(n)).decode()


@st.composite
def periodic_words(draw):
    out = []
    for _ in range(draw(st.integers(1, 5))):
        unit = draw(st.lists(st.integers(0, 3), min_size=1, max_size=draw(st.sampled_from([2, 9, 30]))))
        out += (unit * 40)[:draw(st.integers(0, 6 * len(unit) + 12))]
    return out


@settings(max_examples=400, deadline=None)
@given(periodic_words(), st.sampled_from([64, 128, 1024]))
def test_tiles_equal_brute_force(words, tile_words):
    ids = np.array(words, np.int32)
    want = [(s, n, q) for s, n, q in brute(words)]
    one = [(lo, hi - lo + q, q) for q, lo, hi in merged(solve(ids, 0, octaves(len(ids)))) if is_run(q, lo, hi)] if octaves(len(ids)) else []
    assert sorted(one) == sorted(want)
    if octaves(len(ids)):
        parts = [f for o, e, a, z, origin, w in tiles(ids, tile_words) for f in merged(solve(w, o, e, (a, z), origin))]
        assert sorted((lo, hi - lo + q, q) for q, lo, hi in merged(parts) if is_run(q, lo, hi)) == sorted(want)


def test_octaves_hold_all_periods():
    for n in [24, 25, 47, 48, 100, 4096, 99_999]:
        assert step_of(octaves(n)) > n // 3 >= 8 or octaves(n) == 1
        assert octaves(n) == 1 or step_of(octaves(n) - 1) <= n // 3


def test_z_function():
    assert z_function([1, 1, 2, 1, 1, 2, 1]) == [7, 1, 0, 4, 1, 0, 1]


def texts():
    r = random.Random(3)
    words = [f"w{k}" for k in range(40)]
    out = edge_texts()[:4] + edge_texts()[5:]
    for k in range(40):
        unit = [r.choice(words) for _ in range(r.choice([1, 2, 5, 8, 13, 60]))]
        out.append((100 + k, " ".join([*unit[:3], *((unit * 9)[:r.randint(1, 7 * len(unit))]), "x", *["a"] * r.randint(0, 40), *unit * 3])))
    out += [(200, "a " * 500), (201, "a\n" * 300 + "b " + "a b\t" * 200), (202, " ".join(words * 3) + " z"), (202, None), (202, "a " * 500)]
    return out


@pytest.mark.parametrize("tile_words", [64, 1 << 14])
def test_documents_equal_brute_force(spark, tile_words):
    rows = texts()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, row int, runs string").repartition(3)
    got = periodic_runs(docs, tile_words=tile_words, texts=True)
    want = [expected(*r) for r in rows]
    assert counted(got.selectExpr("doc_id", "size(runs)", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()) == counted(want)
    assert all(hashlib.sha256(r.collapsed.encode()).hexdigest() == r.collapsed_sha256 for r in got.collect())


def test_query(spark, documents):
    got = op12_periodic_runs(spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    small = [d for d in documents if len((d["text"] or "").split()) <= 1500]
    rows = {r.doc_id: tuple(r) for r in got.collect()}
    assert len(rows) == len(documents)
    for d in small:
        assert rows[d["doc_id"]] == expected(d["doc_id"], repeated(d["doc_id"], d["text"]))
    assert sum(r[1] > 0 for r in rows.values()) >= len(documents) // 20


def test_repeats(spark):
    rows = [(k, t) for k in range(60) for t in ["a b\tc  d e f g", "", None, " one"]] + [(None, "a b")]
    got = with_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert counted([tuple(r) for r in got]) == counted([(i, repeated(i, t)) for i, t in rows])


def test_one_word_a_hundred_thousand_times(spark):
    docs = spark.createDataFrame([(1, "a " * 100_000)], "doc_id long, text string")
    r = periodic_runs(docs, tile_words=1 << 12).first()
    assert (r.n_words, [tuple(x) for x in r.runs]) == (100_000, [(0, 100_000, 1)])


def test_empty(edge_docs):
    assert periodic_runs(edge_docs.limit(0)).count() == 0
