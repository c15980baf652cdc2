from __future__ import annotations

import random

import pyarrow.parquet as pq
import pytest

SF = "/root/testdata/sf0.001"
#: names that the operators use inside, as extra columns of the input
CLASHES = ["words", "hashes", "fp", "rep", "component_id", "lang_pred", "score", "n_lines", "n_dropped", "of_host", "drop_lines", "line",
           "hit", "text_key", "length", "rank", "w_hash", "_score", "pick", "start"]


def rng_words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijkl") for _ in range(r.randint(1, 9))) for _ in range(n))


def edge_texts() -> list[tuple]:
    """(doc_id, text): nulls, empty and blank texts, a very long one, ties and repeated rows."""
    same = rng_words(1, 60)
    return [(1, None), (2, ""), (3, " \n\t "), (None, same), (4, rng_words(2, 60_000)), (5, same), (5, same), (6, same + " end"),
            (7, same), (5, rng_words(3, 30)), (8, "İ É 😀 x́ ſ K " + same), (9, "?!... 12 34"), (None, None)]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Documents with the edge cases, and extra columns whose names clash."""
    rows = [(i, t, "en" if k % 2 else None, "s" if k % 3 else None, len(t or ""), *([k] * len(CLASHES))) for k, (i, t) in enumerate(edge_texts())]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in CLASHES)
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def documents():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


def counted(rows) -> dict:
    out: dict = {}
    for r in rows:
        out[tuple(r)] = out.get(tuple(r), 0) + 1
    return out
