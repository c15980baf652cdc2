"""Language labels: script ranges narrow the candidates, Viterbi labels spans of words.

A word is a run of letters, in lower case. Its script (that of its first letter) leaves the languages
seen with that script; its score for each is the log-likelihood of its character trigrams and of
the word itself under hashed, smoothed counts. Scores relative to the best language are bounded below, so
one odd word can't decide. A path through the words pays ``penalty`` for each change of language; the
best path labels the spans. The predicted language holds most letters; the score is its share of them.
All this compares the learnt languages with each other. Whether a text is in any of them at all is told apart by
``identified``: by letters in scripts that no language was learnt with, and by how far its words' trigrams lie
below those of the languages' own training words.

The counts are learnt from a bounded sample (``per_language`` documents of each language, by a hash of
their id, whole texts) and summed up by Spark; the driver gets at most 2 * 2**BITS counts per language.
Prediction is a single pass over whole texts, with numpy over Arrow batches; long texts go in slices.

Null text, or one without a letter: ``und`` with score 0. Without labelled rows, every text is ``und``.
Rows with a null id can be learnt from. Repeated rows get equal results; other columns aren't read.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martsmith.llm.common import fresh, table

BITS = 15
SIZE = 1 << BITS
SLICE = 1 << 20  # characters looked at together
FAR, FAR_SHORT, LEAST_SPREAD = 2.0, 4.0, 1.0

# First and last code points of scripts' letters (Unicode blocks).
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "ethiopic": [(0x1200, 0x139F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "han": [(0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F)],
}
N_SCRIPTS = len(SCRIPTS) + 1  # the last is any other

_TABLES: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    """[is a letter, script] by code point; made once per process."""
    if not _TABLES:
        letter = np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(sys.maxunicode + 1)), bool)
        script = np.full(sys.maxunicode + 1, N_SCRIPTS - 1, np.uint8)
        for k, ranges in enumerate(SCRIPTS.values()):
            for lo, hi in ranges:
                script[lo:hi + 1] = k
        _TABLES.extend([letter, script])
    return _TABLES


class Words:
    """The words of a string: hashed trigrams per letter, a hash, a script and a length per word."""

    def __init__(self, text: str) -> None:
        letter, script = _tables()
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        is_letter = letter[code]
        ring = np.zeros(len(code) + 2, np.uint32)  # 0 stands for all that is no letter
        ring[1:-1] = np.where(is_letter, code, 0)
        at = np.flatnonzero(is_letter)
        before, here, after = ring[at], ring[at + 1], ring[at + 2]
        mixed = before * np.uint32(0x9E3779B1) + here * np.uint32(0x85EBCA77) + after * np.uint32(0xC2B2AE3D)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        self.trigram = mixed >> np.uint32(32 - BITS)
        self.first = np.flatnonzero(before == 0)  # of each word, among the letters
        self.place = at[self.first]  # in the string
        self.length = np.diff(np.append(self.first, len(at)))
        turn = (np.arange(len(at)) - np.repeat(self.first, self.length)).astype(np.uint32) * np.uint32(2) + np.uint32(1)
        mixed = (here + turn * np.uint32(0x7FEB352D)) * (turn * np.uint32(0x846CA68B))
        mixed ^= mixed >> np.uint32(13)
        whole = np.add.reduceat(mixed, self.first, dtype=np.uint32) if len(at) else mixed
        whole = (whole ^ (whole >> np.uint32(16))) * np.uint32(0x45D9F3B)
        self.word = whole >> np.uint32(32 - BITS)
        self.script = script[here[self.first]]


def _slices(texts: list[str]) -> Iterator[tuple[list[int], str]]:
    """(indices, joined text) of about SLICE characters; a longer text comes in several, cut at spaces and line breaks alone: a word
    of more than SLICE characters stays whole."""
    held, size = [], 0
    for i, text in enumerate(texts):
        if size + len(text) > SLICE and held:
            yield held, "\n".join(texts[j] for j in held)
            held, size = [], 0
        if len(text) > SLICE:
            start = 0
            while start < len(text):
                end = len(text) if len(text) - start <= SLICE else max(text.rfind(" ", start, start + SLICE), text.rfind("\n", start, start + SLICE)) + 1
                if not end:
                    end = min([k + 1 for k in (text.find(" ", start + SLICE), text.find("\n", start + SLICE)) if k >= 0], default=len(text))
                yield [i], text[start:end]
                start = end
        else:
            held.append(i)
            size += len(text) + 1
    if held:
        yield held, "\n".join(texts[j] for j in held)


def count_features(docs: DataFrame) -> DataFrame:
    """(lang, feature, n) of ``docs`` (lang, text): trigrams from 0, words from SIZE, scripts from 2 * SIZE on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for _, part in _slices([(text.as_py() or "").lower()]):
                    w = Words(part)
                    total = sums.setdefault(lang, np.zeros(2 * SIZE + N_SCRIPTS, np.int64))
                    total[:SIZE] += np.bincount(w.trigram, minlength=SIZE)
                    total[SIZE:2 * SIZE] += np.bincount(w.word, minlength=SIZE)
                    total[2 * SIZE:] += np.bincount(w.script, minlength=N_SCRIPTS)
        for lang, total in sums.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some)), pa.array(some.astype(np.int32)), pa.array(total[some])], ["lang", "feature", "n"])

    each = docs.select("lang", "text").mapInArrow(run, "lang string, feature int, n long")
    return each.groupBy("lang", "feature").agg(F.sum("n").alias("n"))


class Model:
    """Log-likelihoods per feature and language, and the scripts each language is written in."""

    def __init__(self, counts: dict[str, np.ndarray], smoothing: float = 0.5, min_script: float = 0.01) -> None:
        self.langs = sorted(counts)
        full = np.stack([counts[x] for x in self.langs], axis=1).astype(np.float64) if counts else np.zeros((2 * SIZE + N_SCRIPTS, 0))

        def logs(part: np.ndarray) -> np.ndarray:
            return np.log((part + smoothing) / (part.sum(axis=0) + smoothing * len(part))).astype(np.float32)

        self.trigram, self.word, scripts = logs(full[:SIZE]), logs(full[SIZE:2 * SIZE]), full[2 * SIZE:]
        seen = scripts >= min_script * np.maximum(1, scripts.sum(axis=0))
        self.allowed = seen | ~seen.any(axis=1, keepdims=True)  # a script nobody was seen with excludes nobody
        self.learnt = seen.any(axis=1)
        share = full[:SIZE] / np.maximum(1, full[:SIZE].sum(axis=0))
        self.mean = (share * self.trigram).sum(axis=0)  # of a training letter's trigram, and its spread in nats
        self.spread = np.maximum(LEAST_SPREAD, np.sqrt((share * (self.trigram - self.mean) ** 2).sum(axis=0)))

    def scores(self, w: Words, floor: float) -> np.ndarray:
        """(words, languages): 0 for the best language, at least ``floor``; twice that for an excluded script."""
        e = np.add.reduceat(self.trigram[w.trigram], w.first, axis=0) / 3 + self.word[w.word]
        ok = self.allowed[w.script]
        e = np.where(ok, e, -np.inf)
        e -= e.max(axis=1, keepdims=True)
        return np.where(ok, np.maximum(e, floor), 2 * floor).astype(np.float32)

    def deviations(self, w: Words) -> np.ndarray:
        """(words, languages): the sum over a word's letters of the spreads by which their trigrams exceed the mean of
        the language's own training words; NaN for words of scripts that no language was learnt with."""
        d = (np.add.reduceat(self.trigram[w.trigram], w.first, axis=0) - w.length[:, None] * self.mean) / self.spread
        return np.where(self.learnt[w.script][:, None], d, np.nan).astype(np.float32)


def viterbi(e: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of each word. The path without changes is the best one, and no more is computed, if
    no run of words gains over half a penalty by any other language: k such runs need k - 1 changes
    or more and gain k / 2 penalties at most."""
    if e.shape[1] < 2 or not len(e):
        return np.zeros(len(e), np.int64)
    main = int(e.sum(axis=0, dtype=np.float64).argmax())
    gain = np.zeros((len(e) + 1, e.shape[1]))
    np.cumsum(e - e[:, main:main + 1], axis=0, dtype=np.float64, out=gain[1:])
    if (gain - np.minimum.accumulate(gain, axis=0)).max() <= penalty / 2:
        return np.full(len(e), main)
    n_lang = e.shape[1]
    back: list[list[int]] = []
    best = [0.0] * n_lang
    for row in e.tolist():
        top = max(range(n_lang), key=best.__getitem__)
        jump = best[top] - penalty
        back.append([k if best[k] >= jump else top for k in range(n_lang)])
        best = [max(b, jump) + x for b, x in zip(best, row, strict=True)]
    path, k = np.empty(len(e), np.int64), max(range(n_lang), key=best.__getitem__)
    for t in range(len(e) - 1, -1, -1):
        path[t] = k
        k = back[t][k]
    return path


def label_words(model: Model, texts: list[str], penalty: float, floor: float,
                with_known: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(place, length, language, deviation) of each text's words (the last without columns unless ``with_known``);
    places count in the lower-cased text. What is held at a time is the words of one slice, or of one long text."""
    long_one: list[tuple] = []  # what came before of a text in several slices
    base = 0
    for held, joined in _slices(texts):
        w = Words(joined)
        e = model.scores(w, floor) if len(w.first) and model.langs else np.zeros((len(w.first), len(model.langs)), np.float32)
        far = model.deviations(w) if with_known and e.size else np.zeros((len(w.first), 0), np.float32)
        if len(held) == 1:
            long_one.append((w.place + base, w.length, e, far))
            base += len(joined)
            if base == len(texts[held[0]]):
                # a slice without words has no columns of deviations
                place, length, e = (np.concatenate(x) for x in list(zip(*long_one, strict=True))[:3])
                far = [x[3] for x in long_one if x[3].size]
                long_one, base = [], 0
                yield place, length, viterbi(e, penalty), np.concatenate(far) if far else np.zeros((len(place), 0), np.float32)
            continue
        starts = np.cumsum([0, *(len(texts[i]) + 1 for i in held)])
        cuts = np.searchsorted(w.place, starts)
        for k in range(len(held)):
            lo, hi = cuts[k], cuts[k + 1]
            yield w.place[lo:hi] - starts[k], w.length[lo:hi], viterbi(e[lo:hi], penalty), far[lo:hi]


def share_known(length: np.ndarray, path: np.ndarray, far: np.ndarray, best: int) -> float:
    """The share of a text's letters that language ``best`` holds in scripts that were learnt; 0 if the text's words
    lie far below the training words of their languages: by over ``FAR`` spreads a letter, more in short texts."""
    own = far[np.arange(len(path)), path]
    there = ~np.isnan(own)
    n = int(length[there].sum())
    if not n or own[there].sum(dtype=np.float64) / n < -(FAR + FAR_SHORT / np.sqrt(n)):
        return 0.0
    return float(length[there & (path == best)].sum() / length.sum())


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 4000) -> Model:
    """A model of the labelled rows of ``docs``: a sample by a hash of id and text of about ``per_language`` documents of each language."""
    own = docs.where(F.col(lang_col).isNotNull()).select(
        # rows of one id, or without one, are told apart by their text
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("pick"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    many = own.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = many.select(F.col("lang").alias("of"), F.least(F.lit(1.0), per_language / F.col("n")).alias("share"))
    sample = own.join(F.broadcast(share), F.col("lang") == F.col("of")).where(F.pmod("pick", F.lit(1 << 20)) < F.col("share") * (1 << 20))
    counts: dict[str, np.ndarray] = {}
    got = count_features(sample).toArrow()
    for lang, feature, n in zip(got.column(0).to_pylist(), got.column(1).to_numpy(), got.column(2).to_numpy(), strict=True):
        counts.setdefault(lang, np.zeros(2 * SIZE + N_SCRIPTS, np.int64))[feature] = n
    return Model(counts)


def label(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, penalty: float = 12.0,
          floor: float = -6.0, with_spans: bool = False, with_known: bool = False) -> DataFrame:
    """The columns ``keep`` (all) of ``docs``, lang_pred and score, and with ``with_spans`` the spans: array of
    (first, last, lang), in characters of the lower-cased text, each from its first word to the end of its last,
    and with ``with_known`` the double known (see ``share_known``).
    One row per input row; names that ``docs`` has already get underscores before them."""
    keep = docs.columns if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)
    wanted = {"lang_pred": "string", "score": "double"}
    if with_spans:
        wanted["spans"] = "array<struct<first:long,last:long,lang:string>>"
    if with_known:
        wanted["known"] = "double"
    names = [fresh(keep, x) for x in wanted]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            langs, scores, spans, known = [], [], [], []
            for place, length, path, far in label_words(m, [(t.as_py() or "").lower() for t in b.column(0)], penalty, floor, with_known):
                if not len(path) or not m.langs:
                    langs.append("und")
                    scores.append(0.0)
                    spans.append([])
                    known.append(0.0)
                    continue
                held = np.bincount(path, weights=length, minlength=len(m.langs))
                best = int(held.argmax())
                langs.append(m.langs[best])
                scores.append(float(held[best] / held.sum()))
                if with_known:
                    known.append(share_known(length, path, far, best))
                if with_spans:
                    first = np.flatnonzero(np.diff(path, prepend=-1))
                    last = np.append(first[1:], len(path)) - 1
                    spans.append([{"first": int(place[x]), "last": int(place[y] + length[y]), "lang": m.langs[path[x]]} for x, y in zip(first, last, strict=True)])
            cols = [*b.columns[1:], pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            if with_spans:
                cols.append(pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("lang", pa.string())]))))
            if with_known:
                cols.append(pa.array(known, pa.float64()))
            yield pa.RecordBatch.from_arrays(cols, [*keep, *names])

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, T._parse_datatype_string(k)) for n, k in zip(names, wanted.values(), strict=True)])
    return docs.select(F.col(text_col).alias(fresh(keep, "text_in")), *keep).mapInArrow(run, schema)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, lang_pred, score): one row per input row."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return label(own, model, keep=["doc_id"], **options)


def identified(docs: DataFrame, model: Model, text_col: str = "text", min_score: float = 0.3) -> DataFrame:
    """The rows of ``docs`` in a learnt language: not ``und``, the language holds ``min_score`` of the letters, in scripts
    that were learnt, and the words don't lie far below the training words."""
    lang, score, known = (fresh(docs.columns, x) for x in ("lang_pred", "score", "known"))
    got = label(docs, model, text_col, with_known=True)
    return got.where((F.col(lang) != "und") & (F.col(score) >= min_score) & (F.col(known) >= min_score)).drop(lang, score, known)


def held_out(id_col: str = "doc_id", parts: int = 4, part: int = 2):
    """Whether crc32 of the id as text leaves ``part``; a null id is as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts == part


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learnt from those that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
