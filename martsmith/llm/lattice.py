"""Language-model scores by a subword lattice.

The units are the pieces of an existing vocabulary (a public tokenizer's). Its file holds merge ranks, not
probabilities, so the pieces' scores are estimated here from the training texts: first from how the vocabulary's own
encoder cuts their words, then by expectation-maximisation over the lattice (``rounds``): every word spreads its count over all
its segmentations by their present probability, and the expected counts give the next scores. A word's
probability sums over all its segmentations into pieces: a forward recursion in log space over its
characters, where a character that is no piece is spelled in byte pieces. A text's probability is the product over its
words and one end token; nothing but the lattice's marginal enters it.

Words are counted by Spark (map-side counts, then a shuffle by word), and each different word of
the corpus goes through the recursion once. Words that make up ``common`` or more of all tokens, at most
1 / ``common`` of them, are sent to all tasks; a text's other words are joined
with the word table, and sums come back per text.

Null text is empty: the end token alone. Repeated rows get equal results, as many as there are; rows of
one id but different texts stay apart; a null id is as empty text for the split. Without
training rows all counts are 0 and the pieces equally likely. Other columns aren't read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import exp, log

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martsmith.llm.common import staged, table

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"  # begins a word in the vocabulary
HELD_WORDS = 300_000  # different words a task counts before it hands them on
LOG10 = log(10)


def words_of(text: str | None) -> list[bytes]:
    """Lower case (A-Z only), cut at ASCII white space."""
    return text.encode("utf-8").lower().split() if text else []


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c, n): each word of ``docs`` (text, train) with its count in training rows and in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            words = list(everywhere)
            return pa.RecordBatch.from_arrays([
                pa.array(words, pa.binary()), pa.array([train.get(w, 0) for w in words], pa.int64()),
                pa.array(list(everywhere.values()), pa.int64())], ["word", "c", "n"])

        train, everywhere = Counter(), Counter()
        for b in batches:
            for text, is_train in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                words = words_of(text.as_py())
                everywhere.update(words)
                if is_train:
                    train.update(words)
                if len(everywhere) > HELD_WORDS:
                    yield out()
                    train, everywhere = Counter(), Counter()
        yield out()

    return docs.select("text", "train").mapInArrow(run, "word binary, c long, n long").groupBy("word").agg(
        F.sum("c").alias("c"), F.sum("n").alias("n"))


def count_pieces(words: DataFrame, vocabulary: str) -> DataFrame:
    """(piece, n): ids of the vocabulary with the number of times they occur in the training tokens
    of ``words`` (word, c), as its own encoder cuts them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        total = np.zeros(encoder.get_piece_size())
        for b in batches:
            ids = encoder.encode([w.decode("utf-8") for w in b.column(0).to_pylist()], num_threads=1)
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter((i for x in ids for i in x), np.int64, int(sizes.sum()))
            total += np.bincount(flat, weights=np.repeat(b.column(1).to_numpy(), sizes), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["piece", "n"])

    return words.where("c > 0").select("word", "c").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))


def expect_pieces(words: DataFrame, lattice: Lattice) -> DataFrame:
    """(piece, n): the expected number of each piece in the training tokens of ``words`` (word, c), over all segmentations."""
    shared = words.sparkSession.sparkContext.broadcast(lattice)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0.0] * shared.value.size
        for b in batches:
            for w, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                shared.value.expect(w.decode("utf-8"), c, total)
        some = np.flatnonzero(np.array(total))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(np.array(total)[some])], ["piece", "n"])

    return words.where("c > 0").select("word", "c").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))


class Lattice:
    """Log-probabilities of pieces; ``word`` sums over a word's segmentations."""

    def __init__(self, counts: dict[int, float], ends: int, vocabulary: str) -> None:
        encoder = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        self.size = size = encoder.get_piece_size()
        total = log(sum(counts.values()) + ends + size + 1)  # one more of each piece, and of the end
        self.end = log(ends + 1) - total
        self.byte = [0.0] * 256
        self.byte_id = [0] * 256
        self.piece: dict[str, float] = {}
        self.id_of: dict[str, int] = {}
        for i in range(size):
            text, score = encoder.id_to_piece(i), log(counts.get(i, 0) + 1) - total
            if encoder.is_byte(i):
                self.byte[int(text[1:-1], 16)], self.byte_id[int(text[1:-1], 16)] = score, i
            elif not (encoder.is_control(i) or encoder.is_unknown(i)):
                self.piece[text], self.id_of[text] = score, i
        self.starts = {p[:n] for p in self.piece for n in range(1, len(p))}

    def word(self, word: str) -> float:
        """Natural log of the probability of the word, begun by a space."""
        text, piece, starts = SPACE + word, self.piece, self.starts
        n = len(text)
        into: list[list[float]] = [[] for _ in range(n + 1)]
        into[0].append(0.0)
        for i in range(n):
            paths = into[i]
            if len(paths) == 1:
                here = paths[0]
            else:
                top = max(paths)
                here = top + log(sum([exp(x - top) for x in paths]))
            into[i] = []
            end, part = i + 1, text[i]
            if part not in piece:
                into[end].append(here + sum(self.byte[b] for b in part.encode("utf-8")))
            while True:
                score = piece.get(part)
                if score is not None:
                    into[end].append(here + score)
                if end == n or part not in starts:
                    break
                end += 1
                part = text[i:end]
        top = max(into[n])
        return top + log(sum([exp(x - top) for x in into[n]]))


    def arcs(self, word: str) -> list[list[tuple[int, float, list[int]]]]:
        """From each character of the word, begun by a space: (end, log-probability, pieces) of the ways on."""
        text, piece, starts, out = SPACE + word, self.piece, self.starts, []
        n = len(text)
        for i in range(n):
            end, part, own = i + 1, text[i], []
            if part not in piece:
                spelled = part.encode("utf-8")
                own.append((end, sum(self.byte[b] for b in spelled), [self.byte_id[b] for b in spelled]))
            while True:
                score = piece.get(part)
                if score is not None:
                    own.append((end, score, [self.id_of[part]]))
                if end == n or part not in starts:
                    break
                end += 1
                part = text[i:end]
            out.append(own)
        return out

    def expect(self, word: str, times: int, into: list[float]) -> None:
        """Add ``times`` the expected number of each piece in the word to ``into``: backward sums in log space give the share of
        the ways on from each character, which are then followed from the start."""
        arcs = self.arcs(word)
        n = len(arcs)
        if all(len(own) == 1 for own in arcs):  # one way only
            i = 0
            while i < n:
                i, _, pieces = arcs[i][0]
                for p in pieces:
                    into[p] += times
            return
        ahead: list[float] = [0.0] * n + [0.0]  # log of the sum over all ways from a character to the end
        for i in range(n - 1, -1, -1):
            own = arcs[i]
            if len(own) == 1:
                ahead[i] = own[0][1] + ahead[own[0][0]]
            else:
                ways = [score + ahead[end] for end, score, _ in own]
                top = max(ways)
                ahead[i] = top + log(sum([exp(x - top) for x in ways]))
        there = [0.0] * (n + 1)  # probability that a segmentation cuts before a character
        there[0] = times
        for i in range(n):
            here = there[i]
            if here:
                for end, score, pieces in arcs[i]:
                    share = here * exp(score + ahead[end] - ahead[i])
                    there[end] += share
                    for p in pieces:
                        into[p] += share


def score_words(words: DataFrame, lattice: Lattice) -> DataFrame:
    """``words`` (word, c, n) with ``lattice``: log10 of the word's probability by its pieces."""
    shared = words.sparkSession.sparkContext.broadcast(lattice)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.word
        for b in batches:
            logs = [score(w.decode("utf-8")) / LOG10 for w in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(logs, pa.float64())], ["word", "c", "n", "lattice"])

    return words.select("word", "c", "n").mapInArrow(run, "word binary, c long, n long, lattice double")


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
                vocabulary: str | None = None, common: float = 2e-6, rounds: int = 1) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score): one row per row of ``docs``; ``train`` says
    which rows the counts come from, ``rounds`` how often the pieces' counts are estimated anew."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), train.alias("train"))
    words = staged(count_words(own), "lm-words")
    sums = words.agg(F.sum("c"), F.count_if(F.col("c") > 0), F.sum("n")).first()
    seen, kinds, everywhere = (x or 0 for x in sums)
    ends = own.where("train").count()
    tokens, kinds = seen + ends, kinds + (ends > 0)
    lattice = Lattice(dict(count_pieces(words, path).collect()), ends, path)  # at most the vocabulary's size
    for _ in range(rounds):
        lattice = Lattice(dict(expect_pieces(words, lattice).collect()), ends, path)
    scored = staged(score_words(words, lattice).select("word", "c", "n", F.col("lattice").alias("score")), "lm-scores")
    bound = max(2, common * everywhere)
    frequent = scored.where(F.col("n") >= bound).select("word", "c", "score").toArrow()  # at most 1 / common rows
    shared = docs.sparkSession.sparkContext.broadcast(dict(zip(
        frequent.column(0).to_pylist(),
        zip(np.log10(frequent.column(1).to_numpy() + 1.0).tolist(), frequent.column(2).to_pylist(), (frequent.column(1).to_numpy() > 0).tolist(), strict=True),
        strict=True)))
    end_base = float(np.log10(ends + 1))
    end_score = lattice.end / LOG10

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for b in batches:
            cols: list[list] = [[], [], [], [], [], []]
            for text in b.column(2):
                words = words_of(text.as_py())
                known, base, score, rare, counts = int(ends > 0), end_base, end_score, [], []
                for w, n in Counter(words).items():
                    v = frequent.get(w)
                    if v is None:
                        rare.append(w)
                        counts.append(n)
                    else:
                        base += n * v[0]
                        score += n * v[1]
                        known += n * v[2]
                for c, x in zip(cols, (len(words) + 1, known, base, score, rare, counts), strict=True):
                    c.append(x)
            types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))],
                ["doc_id", "text_key", "n_tokens", "n_known", "base", "score", "rare", "times"])

    keyed = own.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    texts = staged(keyed.mapInArrow(run, "doc_id long, text_key long, n_tokens long, n_known long, base double, score double, "
                                         "rare array<binary>, times array<int>"), "lm-texts")
    rare = texts.select("doc_id", "text_key", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "doc_id", "text_key", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    found = rare.join(scored.where(F.col("n") < bound).select("word", "c", F.col("score").alias("word_score")), "word").select(
        "doc_id", "text_key", F.lit(0).cast("long").alias("n_tokens"), F.when(F.col("c") > 0, F.col("times")).otherwise(0).cast("long").alias("n_known"),
        (F.col("times") * F.log10(F.col("c") + 1)).alias("base"), (F.col("times") * F.col("word_score")).alias("score"), F.lit(0).alias("row"))
    parts = texts.select("doc_id", "text_key", "n_tokens", "n_known", "base", "score", F.lit(1).alias("row")).union(found)
    whole = parts.groupBy("doc_id", "text_key").agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score", "row")])
    row = F.col("row")  # equal rows were added up
    n_tokens = (F.col("n_tokens") / row).cast("long")
    return whole.select(
        "doc_id", n_tokens.alias("n_tokens"), (F.col("n_known") / row).cast("long").alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") / row - n_tokens * F.log10(F.lit(float(tokens + kinds + 1)))).alias("base_score"),
        (F.col("score") / row).alias("score"), F.explode(F.array_repeat(F.lit(0), row.cast("int"))).alias("copy")).drop("copy")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document; counts from
    those whose crc32 of the id as text doesn't leave 2 when divided by 7."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    got = score_texts(table(spark, sf_dir, "documents"), ~held_out)
    return got.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
