from __future__ import annotations

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from martsmith.llm.simhash import components, keep_one, linked, near_duplicates, one_per_group, op3_simhash, ring_masks, simhash

from .conftest import SF, edge_texts, rng_words


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps: list[int], max_bits: int = 2) -> list[int]:
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_is_the_majority_of_shingle_hashes(documents):
    for d in documents[:40]:
        assert simhash(d["text"]) == brute_fingerprint(d["text"])
    for _, text in edge_texts():
        if len(text or "") < 10_000:
            assert simhash(text) == brute_fingerprint(text)


def test_query_equals_brute_force(spark, documents):
    got = {r.doc_id: r for r in op3_simhash(spark, SF).collect()}
    ids, fps = [d["doc_id"] for d in documents], [brute_fingerprint(d["text"]) for d in documents]
    roots = brute_components(fps)
    least = {}
    for i, r in zip(ids, roots, strict=True):
        least[r] = min(i, least.get(r, i))
    assert {i: (f"{f:016x}", least[r]) for i, f, r in zip(ids, fps, roots, strict=True)} == {
        i: (r.fingerprint, r.component_id) for i, r in got.items()}
    assert len(got) == len(ids)


@pytest.mark.parametrize("bucket_bound", [1, 4, 1000])
@pytest.mark.parametrize("max_bits", [1, 2])
def test_links_of_crowded_fingerprints(spark, bucket_bound, max_bits):
    """Near fingerprints in numbers: pairs, crowded buckets, and both, have the same components."""
    r = random.Random(bucket_bound)
    fps = set()
    for _ in range(12):
        centre = r.getrandbits(64)
        fps.update(centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))) for _ in range(25))
    fps = sorted(fps)
    want = {}
    for f, root in zip(fps, brute_components(fps, max_bits), strict=True):
        want.setdefault(root, set()).add(signed(f))
    frame = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    found = {}
    for node, root in components(linked(frame, max_bits, bucket_bound=bucket_bound)).collect():
        found.setdefault(root, set()).add(node)
    known = {signed(f) for f in fps}
    groups = sorted(sorted(g & known) for g in found.values() if len(g & known) > 1)
    assert groups == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_ring_masks_cover_the_bits():
    for m in (3, 5, 7):
        for s, chain in enumerate(ring_masks(m)):
            assert chain[-1] == (1 << 64) - 1
            assert all(a & b == a for a, b in zip(chain, chain[1:], strict=False)), s


def test_every_close_pair_has_a_viable_chain():
    r = random.Random(5)
    masks = ring_masks(7)
    for _ in range(2000):
        diff = sum(1 << b for b in r.sample(range(64), r.randint(0, 2)))
        assert any(all(bin(diff & masks[s][n]).count("1") <= (n + 1) * 2 // 7 for n in range(7)) for s in range(7))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edge_cases(spark, edge_docs):
    got = near_duplicates(edge_docs)
    rows = got.collect()
    assert len(rows) == edge_docs.count()
    zero = {r.doc_id for r in rows if r.fp == 0}
    assert {1, 2, 3, None} <= zero
    assert {r.component_id for r in rows if r.fp == 0} == {1}
    kept = keep_one(edge_docs, got)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) == 1 and ids.count(1) == 1 and 2 not in ids and 7 not in ids
    empty = edge_docs.limit(0)
    assert near_duplicates(empty).count() == 0
    assert keep_one(empty, near_duplicates(empty)).count() == 0
    assert got.select(F.max("doc_id")).first()[0] == 9


def test_one_row_of_each_group_whatever_its_id(spark, edge_docs):
    a, b, c, d = (rng_words(i, 80) for i in range(11, 15))
    rows = [(3, a), (7, a), (7, b), (None, c), (None, c), (None, d), (9, d), (9, d), (3, rng_words(15, 80)), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in rows], "doc_id long, text string, key_1 int, fp int")
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    empty = [x for x in got if not x[1]]
    assert len(empty) == 1 and empty[0][0] is None
    assert sorted((x for x in got if x[1]), key=str) == sorted([(3, a), (7, b), (None, c), (9, d), rows[8]], key=str)
    ids = [r.doc_id for r in one_per_group(edge_docs).collect()]  # id 5 has two unrelated texts
    assert ids.count(5) == 2 and ids.count(1) == 1 and None not in ids and 2 not in ids and 7 not in ids
    assert one_per_group(edge_docs.limit(0)).count() == 0


def test_one_row_of_each_group_is_the_row_of_the_smallest_id(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = keep_one(docs, near_duplicates(docs)).collect()  # its ids are unique
    assert sorted(r.doc_id for r in one_per_group(docs).collect()) == sorted(r.doc_id for r in want)
