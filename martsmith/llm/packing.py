"""Sequence packing by shortest-pack-first over the histogram of piece lengths.

1. Texts become token ids in Arrow batches. The tokenizer's rules never look across ASCII white
   space, so the words between are encoded once each and looked up after that (a bounded
   memory of words); the new words of many texts are encoded together. An end id closes each document. A document longer than a sequence is cut into
   full pieces and a rest.
2. The histogram of lengths (at most ``size`` rows) is all that reaches the driver. Lengths are placed
   longest first; those of one length go to the packs with most room, and what fits nowhere opens
   new packs of as many copies as fit. Only counts per pattern are kept, so the work does not
   depend on the number of documents.
3. Pieces of a length are numbered: spread over buckets by a hash of their content, counted per bucket,
   and summed up. A length that holds a third of all pieces has about a third of all
   buckets, whose number is bounded (``shares`` plus one per length).
4. A pattern's slots are ranges of ranks; a piece's rank gives its sequence and offset.

Null text is as empty text: the end id alone. Repeated rows are pieces of their own; so are rows with
a null id. Only the id and text columns are read. An empty table gives no rows.
"""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martsmith.llm.common import staged, table

VOCABULARY = "word_bpe_49k.json"
WORD_END = "</w>"
MARKS = string.punctuation.encode()
LATIN_END = "\u0250"
MAX_WORDS = 300_000  # words kept in a worker's memory, twice
MAX_WORD_BYTES = 64
TOGETHER = 1 << 17  # characters of texts whose new words are encoded together

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _ends_plain(stem: str) -> bool:
    """Whether the last letter is Latin and stays one letter in lower case: U+0130 becomes two characters, and the second joins
    the mark that follows."""
    return stem[-1].isalpha() and stem[-1] < LATIN_END and len(stem[-1].lower()) == 1


class WordEncoder:
    """Token ids (little-endian unsigned 32 bits) of texts, word by word.

    Words are lower-cased (A-Z) and cut at ASCII white space; final marks (ASCII punctuation) after a letter or digit are a
    token run of their own in any context. Unknown plain words are encoded many at a time: each of
    them ends in the only token that has the word-end suffix."""

    def __init__(self, path: str, max_words: int = MAX_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # a special token's name in a text is text
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith(WORD_END)]] = True
        self.known: dict[bytes, bytes] = {}  # of this generation
        self.older: dict[bytes, bytes] = {}
        self.max_words = max_words

    def _ids(self, words: list[bytes]) -> Iterator[bytes]:
        for e in self.tokenizer.encode_batch_fast([w.decode("utf-8") for w in words], add_special_tokens=False):
            yield np.asarray(e.ids, "<u4").tobytes()

    def _learn(self, words: set[bytes]) -> None:
        """All ``words`` are in ``known`` afterwards."""
        known, older, plain, other, marked = self.known, self.older, [], [], []
        queued = set()

        def need(word: bytes) -> None:
            if word in known or word in queued:
                return
            if word in older:
                known[word] = older[word]
                return
            queued.add(word)
            if not word.isalpha():  # of ASCII letters, that is
                text = word.decode("utf-8")
                latin = text.isalpha() and max(text) < LATIN_END and "\u0130" not in text
            else:
                latin = True
            (plain if latin and len(word) <= MAX_WORD_BYTES else other).append(word)

        for word in words:
            if word in older:
                known[word] = older[word]
                continue
            stem = word.rstrip(MARKS)
            if len(stem) < len(word) and stem and (stem.isascii() and stem[-1:].isalnum() or _ends_plain(stem.decode("utf-8"))):
                marked.append((word, stem))
                need(stem)
                need(word[len(stem):])
            else:
                need(word)
        for i in range(0, len(plain), 1000):
            part = plain[i:i + 1000]
            ids = np.frombuffer(next(self._ids([b" ".join(part)])), "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(part):
                raw, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
                known.update((w, raw[x:y]) for w, x, y in zip(part, cuts, cuts[1:], strict=False))
            else:
                other += part
        known.update(zip(other, self._ids(other), strict=True))
        known.update((word, known[stem] + known[word[len(stem):]]) for word, stem in marked)

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        for part in _together(texts):
            words = [text.encode("utf-8").lower().split() if text else [] for text in part]  # bytes: ASCII case and space only
            found = set().union(*words)
            if new := found.difference(self.known):
                if len(self.known) + len(new) > self.max_words:
                    self.known, self.older = {}, self.known
                    new = found
                self._learn(new)
            ids_of = self.known.__getitem__
            for own in words:
                yield b"".join(map(ids_of, own))


def _together(texts: list[str | None]) -> Iterator[list[str | None]]:
    """``texts`` in runs of ``TOGETHER`` characters, or one text that has more."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if held and held + n > TOGETHER:
            yield texts[first:i]
            first, held = i, 0
        held += n
    if first < len(texts):
        yield texts[first:]


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One per worker process, whatever tasks it runs."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 2048, end_id: int = 1,
           vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens), and with ``with_ids`` the ids as an array."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        end = np.asarray([end_id], "<u4").tobytes()
        for b in batches:
            out: list[tuple] = []
            for doc, ids in zip(b.column(0).to_pylist(), encoder.encode([t.as_py() for t in b.column(1)]), strict=True):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, size):
                    part = ids[4 * start: 4 * (start + size)]
                    out.append((doc, start, len(part) // 4, zlib.crc32(part), n, *([np.frombuffer(part, "<u4").astype(np.int32)] * with_ids)))
            cols = list(zip(*out, strict=True)) if out else [[]] * (5 + with_ids)
            types = [pa.int64()] * 5 + [pa.list_(pa.int32())] * with_ids
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: 5 + with_ids]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, PIECES + ", ids array<int>" * with_ids)


Pattern = tuple[tuple[int, int], ...]  # (length, copies), in the order of the pack


def shortest_pack_first(histogram: dict[int, int], size: int = 2048) -> list[tuple[int, Pattern]]:
    """(number of packs, pattern) for lengths 1 to ``size`` with their counts.

    Longest lengths first. Packs of one pattern form a class; the class with most room takes
    one piece per pack, or as many as bring it to the room of the next class. If no class has room,
    new packs open, filled with copies of the length."""
    classes: list[tuple[int, int, int, Pattern]] = []  # (-room, order, packs, pattern)
    done: list[tuple[int, Pattern]] = []
    order = 0

    def put(room: int, packs: int, pattern: Pattern) -> None:
        nonlocal order
        order += 1
        if room and packs:
            heappush(classes, (-room, order, packs, pattern))
        elif packs:
            done.append((packs, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if classes and -classes[0][0] >= length:
                room, _, packs, pattern = heappop(classes)
                room = -room
                below = -classes[0][0] if classes else 0
                copies = max(1, min((room - max(below, length)) // length + 1, left // packs))
                if left < packs:  # one piece each for some of the packs
                    put(room, packs - left, pattern)
                    packs = left
                put(room - copies * length, packs, (*pattern, (length, copies)))
                left -= packs * copies
            else:
                fit = size // length
                put(size - fit * length, left // fit, ((length, fit),))
                if rest := left % fit:
                    put(size - rest * length, 1, ((length, rest),))
                left = 0
    return done + [(packs, pattern) for _, _, packs, pattern in classes]


def slots(patterns: list[tuple[int, Pattern]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, copies, first sequence, offset) of every run of a pattern."""
    out, used, sequence = [], {}, 0
    for packs, pattern in patterns:
        offset = 0
        for length, copies in pattern:
            first = used.get(length, 0)
            used[length] = first + packs * copies
            out.append((length, first, used[length], copies, sequence, offset))
            offset += length * copies
        sequence += packs
    return out


def ranked(pieces: DataFrame, histogram: dict[int, int], shares: int = 4096) -> DataFrame:
    """``pieces`` with ``rank``: 0, 1, ... within each length, without a task that holds a whole length."""
    spark, total = pieces.sparkSession, max(1, sum(histogram.values()))
    keys = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    plan = F.broadcast(spark.createDataFrame(
        [(n, -(-count * shares // total)) for n, count in histogram.items()], "length long, buckets long"))
    same = pieces.groupBy(*keys, *[c for c in pieces.columns if c not in keys]).agg(F.count(F.lit(1)).alias("copies"))
    dealt = same.join(plan, "length").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), "buckets")).drop("buckets")
    offsets, before = [], {}
    for length, bucket, n in sorted(dealt.groupBy("length", "bucket").agg(F.sum("copies")).collect()):  # shares + one per length
        offsets.append((length, bucket, before.get(length, 0)))
        before[length] = before.get(length, 0) + n
    offsets = F.broadcast(spark.createDataFrame(offsets, "length long, bucket long, base long"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens").rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.withColumn("inside", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(offsets, ["length", "bucket"])
    return out.withColumn("nth", F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1))).select(
        *pieces.columns, (F.col("base") + F.col("inside") + F.col("nth")).alias("rank"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 2048, end_id: int = 1,
         vocabulary: str | None = None, shares: int = 4096, with_ids: bool = False) -> DataFrame:
    """The pieces of ``docs`` with ``sequence_id`` and ``offset``."""
    spark = docs.sparkSession
    cut = staged(pieces(docs, id_col, text_col, size, end_id, vocabulary, with_ids), "packing-pieces")
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # at most ``size`` rows
    runs = F.broadcast(spark.createDataFrame(
        slots(shortest_pack_first(histogram, size)),
        "of_length long, lo long, hi long, copies long, first_sequence long, base long"))
    at = F.col("rank") - F.col("lo")
    inner = F.pmod(at, F.col("copies"))
    return ranked(cut, histogram, shares).join(
        runs, (F.col("length") == F.col("of_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")),
    ).select(*cut.columns, (F.col("first_sequence") + ((at - inner) / F.col("copies")).cast("long")).alias("sequence_id"),
             (F.col("base") + inner * F.col("length")).alias("offset"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    return pack(table(spark, sf_dir, "documents"))
