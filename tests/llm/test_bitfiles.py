from __future__ import annotations

import glob
import mmap
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martsmith.llm import subwords
from martsmith.llm.bitfiles import (
    VOCABULARY,
    TokenFile,
    bits_for,
    file_bytes,
    op13_token_files,
    pack_bits,
    read_documents,
    read_range,
    unpack_bits,
    write_token_files,
)
from martsmith.llm.subwords import TextEncoder, units_of

from .conftest import SF, counted, edge_texts


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def encoder():
    return TextEncoder(public_tokenizers.path(VOCABULARY), max_units=40)


def whole(tokenizer, texts):
    return [np.array([*e.ids, 2], "<u4") for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab é.,!?'s \n\t \x1c▁İ1  "))), max_size=4))
def test_units_equal_whole_texts(tokenizer, encoder, texts):
    assert [x.tolist() for x in encoder.encode(texts)] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_every_character_at_a_cut(tokenizer, encoder):
    texts = [f"a{c} b{c}{c} {c}x '{c}  {c} y{c}" for c in map(chr, [*range(0x3100), *range(0xf900, 0x10000, 7)])]
    assert [x.tolist() for x in encoder.encode(texts)] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_units_make_the_text():
    for text in [" ", "  ", " a b", "  a  b ", " a\n b\tc \n"]:
        assert b"".join(b" " + u for u in units_of(text)).decode() == text


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 32), st.data())
def test_bits_round_trip(bits, data):
    ids = np.array(data.draw(st.lists(st.integers(0, 2**bits - 1), max_size=70)), np.uint32)
    raw = pack_bits(ids, bits)
    assert len(raw) == -(-len(ids) * bits // 8)
    first = data.draw(st.integers(0, len(ids)))
    count = data.draw(st.integers(0, len(ids) - first))
    assert unpack_bits(raw, bits, first, count).tolist() == ids[first:first + count].tolist()


@settings(max_examples=60, deadline=None)
@given(st.integers(5, 20), st.lists(st.tuples(st.one_of(st.none(), st.integers(-2**63, 2**63 - 1)), st.lists(st.integers(0, 31), min_size=1)), min_size=1, max_size=8), st.data())
def test_file_random_access(bits, docs, data):
    docs = [(d, np.array(ids, np.uint32)) for d, ids in docs]
    f = TokenFile(file_bytes(3, 4, docs, bits, block_ids=16) + b"\n")
    flat = np.concatenate([x for _, x in docs])
    assert (f.task, f.file, f.n_docs, f.n_ids, f.bits) == (3, 4, len(docs), len(flat), bits)
    assert [None if n else int(d) for d, n in zip(f.doc_ids, f.is_null, strict=True)] == [d for d, _ in docs]
    for k, (_, ids) in enumerate(docs):
        assert f.document(k).tolist() == ids.tolist()
    first = data.draw(st.integers(0, len(flat)))
    count = data.draw(st.integers(0, len(flat) - first))
    assert f.ids(first, count).tolist() == flat[first:first + count].tolist()
    with pytest.raises(IndexError):
        f.ids(len(flat), 1)


def test_least_bits():
    assert [bits_for(n) for n in (1, 2, 3, 256, 257, 32_000, 49_408, 50_257, 65_537)] == [1, 1, 2, 8, 9, 15, 16, 16, 17]


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def expected(tokenizer, rows):
    """(doc_id, start, n_tokens, crc) in order; rows of one id by the hash of their text."""
    key = {t: 42 if t is None else signed(xxhash.xxh64_intdigest(t.encode(), 42)) for _, t in rows}
    docs = sorted(((i is not None, i or 0, key[t], len(x), zlib.crc32(x.tobytes())) for (i, t), x in zip(rows, whole(tokenizer, [t for _, t in rows]), strict=True)))
    out, at = [], 0
    for known, i, _, n, crc in docs:
        out.append((i if known else None, at, n, crc))
        at += n
    return out


def test_query(spark, documents, tokenizer):
    got = op13_token_files(spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert counted(got.collect()) == counted(expected(tokenizer, [(d["doc_id"], d["text"]) for d in documents]))


@pytest.mark.parametrize("file_ids", [64, 5_000, 1 << 23])
def test_edge_cases(edge_docs, spark, tokenizer, tmp_path, file_ids):
    path = str(tmp_path / "ids")
    write_token_files(edge_docs, path, file_ids=file_ids, block_ids=64, task_bytes=100_000)
    rows = expected(tokenizer, edge_texts())
    assert counted(read_documents(spark, path).collect()) == counted(rows)
    files = [open(p, "rb") for p in glob.glob(path + "/*.txt")]  # noqa: SIM115
    maps = sorted((TokenFile(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)) for f in files), key=lambda f: (f.task, f.file))
    flat = np.concatenate([f.ids(0, f.n_ids) for f in maps])
    assert len(maps) > 1 or file_ids > 5_000
    assert [zlib.crc32(flat[s:s + n].astype("<u4").tobytes()) for _, s, n, _ in rows] == [r[3] for r in rows]
    for start, count in [(0, 10), (50, 5_000), (len(flat) - 3, 3), (7, 0)]:
        assert read_range(spark, path, start, count).tolist() == flat[start:start + count].tolist()


def test_other_width(edge_docs, spark, tmp_path):
    """An end id beyond 16 bits needs a 17th."""
    path = str(tmp_path / "ids")
    write_token_files(edge_docs, path, end_id=70_000)
    assert TokenFile(open(glob.glob(path + "/*.txt")[0], "rb").read()).bits == 17  # noqa: SIM115
    last = sum(r.n_tokens for r in read_documents(spark, path).collect()) - 1
    assert read_range(spark, path, last, 1).tolist() == [70_000]


def test_empty(edge_docs, spark, tmp_path):
    path = str(tmp_path / "ids")
    write_token_files(edge_docs.limit(0), path)
    assert read_documents(spark, path).count() == 0
    assert read_range(spark, path, 0, 0).tolist() == []


def test_units_are_looked_up_once_in_the_older_memory(tokenizer):
    """A unit that the older memory has is taken from there, by one look-up; so is the stem of a unit that it lacks."""
    class Counted(dict):
        asked: list = []

        def get(self, key, default=None):
            self.asked.append(key)
            return super().get(key, default)

        def __contains__(self, key):
            self.asked.append(key)
            return super().__contains__(key)

        def __getitem__(self, key):
            self.asked.append(key)
            return super().__getitem__(key)

    own = TextEncoder(public_tokenizers.path(VOCABULARY), max_units=10)
    list(own.encode(["one two three. four five, six seven"]))
    own._start()
    own.older = Counted(own.older[0]), *own.older[1:]
    texts = ["zero two three. five six! eight nine;", "one two ten"]
    got = own.encode(texts)
    assert [x.tolist() for x in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(Counted.asked) == len(set(Counted.asked)) == 9  # two, three., five, six!, eight, nine;, ten; six and nine


@given(st.lists(st.binary(max_size=4).map(lambda b: b.decode("latin-1").encode()) | st.sampled_from([b"", b"a", b"a\nb", b"a\n", b"\t", b" a", b"a b", b"\x1fa", b"a\x1f"])))
def test_joinable_units(units):
    assert subwords._joinable(units).tolist() == [subwords._joins(u) for u in units]
