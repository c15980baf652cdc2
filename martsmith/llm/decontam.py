"""Benchmark decontamination: n-gram windows of test items found in training texts.

Words are lower-cased (A-Z only) runs of digits, letters a-z and all non-ASCII characters. An
item's windows are its runs of ``n`` words; an item of fewer words, but not none, is one window.
The windows' hashes go to every task (``max_broadcast_rows`` bounds them; a larger benchmark is
joined by shuffling instead). Each text is read once: word hashes, then one hash per window
position inside generated code, probed against the hash set; a hit counts only when the words
themselves are equal. Only hits and one marker row per text are shuffled, by text.

Built from DataFrame functions alone. Null text has no words; null item text has no window; a
null item id marks words but is no item. Repeated rows of ``docs`` give equal rows of
the result, as many as there are; rows of one id but different texts stay apart. An empty benchmark
hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martsmith.llm.common import fingerprint128, fresh, lower_az, table, text_split

SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return text_split(lower_az(text), SEPARATOR)


def _window_hash(hashes: Column, start: Column, length: Column, n: int) -> Column:
    """One hash of ``length`` word hashes from ``start`` on; null arguments leave a hash as it is."""
    return F.xxhash64(length, *[F.when(length > k, F.get(hashes, start + k)) for k in range(n)])


def windows(bench: DataFrame, n: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(w_hash, w_len, w_words, w_items): one row per different window."""
    items = bench.select(F.col(id_col).alias("item"), words_of(F.col(text_col)).alias("words")).where(F.size("words") > 0)
    items = items.withColumn("len", F.least(F.size("words"), F.lit(n))).withColumn(
        "hashes", F.transform("words", lambda w: F.xxhash64(w)))
    each = items.select("item", "words", "len", "hashes", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("len"))).alias("at"))
    return each.groupBy(
        _window_hash(F.col("hashes"), F.col("at"), F.col("len"), n).alias("w_hash"), F.col("len").alias("w_len"),
        F.slice("words", F.col("at") + 1, F.col("len")).alias("w_words"),
    ).agg(F.collect_set("item").alias("w_items"))


def contamination(docs: DataFrame, bench: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  bench_id: str = "item_id", bench_text: str = "text", max_broadcast_rows: int = 2_000_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key (128 bits that name the text), n_words, n_hit,
    spans (word ranges [first, last) that are hit, in order), items (sorted ids)."""
    wins = windows(bench, n, bench_id, bench_text)
    known = wins.agg(F.collect_set("w_len"), F.count(F.lit(1))).first()
    lengths, fits = sorted(known[0]), known[1] <= max_broadcast_rows  # n lengths at most
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).alias("doc_id"), F.array(*fingerprint128(text)).alias("text_key"), words_of(text).alias("words"))
    own = own.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    # length 0 is the marker row of a text
    places = own.select("*", F.explode(F.array(*map(F.lit, [0, *lengths]))).alias("len")).select("*", F.explode(
        F.when(F.col("len") <= F.size("words"), F.sequence(F.lit(0), F.when(F.col("len") > 0, F.size("words") - F.col("len")).otherwise(0)))
        .otherwise(F.array().cast("array<int>"))).alias("at"))
    places = places.withColumn("hash", _window_hash(F.col("hashes"), F.col("at"), F.col("len"), n))
    window = F.slice("words", F.col("at") + 1, F.col("len"))
    if not fits:  # rows that are shuffled carry their own window, not the text's words
        places = places.select("doc_id", "text_key", "len", "at", "hash", F.when(F.col("len") == 0, F.size("words")).alias("size"), window.alias("window"))
        window = F.col("window")
    else:
        places = places.withColumn("size", F.when(F.col("len") == 0, F.size("words")))
    # the hash alone is the join key (a primitive long); the words are compared on its few matches
    probed = places.join(F.broadcast(wins) if fits else wins, F.col("hash") == F.col("w_hash"), "left")
    same = (F.col("len") == F.col("w_len")) & (window == F.col("w_words"))
    found = probed.where((F.col("len") == 0) | (F.col("w_hash").isNotNull() & same)).select(
        "doc_id", "text_key", "size",
        F.when(F.col("len") > 0, F.struct("at", (F.col("at") + F.col("len")).alias("end"))).alias("hit"),
        F.when(F.col("len") > 0, F.col("w_items")).alias("w_items"))
    per = found.groupBy("doc_id", "text_key").agg(
        F.max("size").cast("long").alias("n_words"), F.count("size").cast("int").alias("copies"),
        F.array_sort(F.collect_set("hit")).alias("hits"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("w_items")))).alias("items"))
    empty = F.array().cast("array<struct<first:int,last:int>>")

    def merge(acc: Column, hit: Column) -> Column:
        """Ranges in order of their start; one that begins inside the last, or at its end, prolongs it."""
        last = F.get(acc, F.size(acc) - 1)
        joins = (F.size(acc) > 0) & (hit["at"] <= last["last"])
        return F.when(joins, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            last["first"].alias("first"), F.greatest(last["last"], hit["end"]).alias("last"))))).otherwise(
            F.concat(acc, F.array(F.struct(hit["at"].alias("first"), hit["end"].alias("last")))))

    per = per.withColumn("spans", F.aggregate("hits", empty, merge)).withColumn(
        "n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda s, r: s + r["last"] - r["first"]))
    return per.select("doc_id", "text_key", "n_words", "n_hit", "spans", "items", F.explode(
        F.array_repeat(F.lit(0), F.col("copies"))).alias("copy")).drop("copy")


def drop_contaminated(docs: DataFrame, bench: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose text has a hit; columns as they were."""
    hit = contamination(docs, bench, n, id_col, text_col, **options).where("n_hit > 0").select("doc_id", "text_key").distinct()
    own = F.array(*fingerprint128(F.coalesce(docs[text_col], F.lit(""))))
    return docs.join(hit, docs[id_col].eqNullSafe(hit["doc_id"]) & (own == hit["text_key"]), "left_anti")


def cut_contaminated(docs: DataFrame, bench: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the hit words (each with the separator after it) cut from the text; rows without a
    hit keep their text as it is."""
    hit_id, hit_key, hit_spans = (fresh(docs.columns, x) for x in ("hit_id", "hit_key", "hit_spans"))
    hit = contamination(docs, bench, n, id_col, text_col, **options).where("n_hit > 0").dropDuplicates(["doc_id", "text_key"]).select(
        F.col("doc_id").alias(hit_id), F.col("text_key").alias(hit_key), F.col("spans").alias(hit_spans))
    own = F.array(*fingerprint128(F.coalesce(docs[text_col], F.lit(""))))
    both = docs.join(hit, docs[id_col].eqNullSafe(hit[hit_id]) & (own == hit[hit_key]), "left")
    text = F.col(text_col)
    seps = F.split(text, WORD, -1)  # one more than there are words
    pieces = F.zip_with(text_split(text, SEPARATOR), F.slice(seps, 2, F.size(seps)), lambda w, s: F.concat(w, s))
    kept = F.filter(pieces, lambda p, i: ~F.exists(F.col(hit_spans), lambda r: (r["first"] <= i) & (i < r["last"])))
    cut = F.when(F.col(hit_spans).isNull(), text).otherwise(F.concat(F.get(seps, 0), F.array_join(kept, "")))
    return both.select(*[cut.alias(c) if c == text_col else docs[c] for c in docs.columns])


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    got = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.sort_array(F.transform("items", lambda i: i.cast("string"))), ",")
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP1_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[pos : pos + least(len(words), 10) - 1], ' ') AS w
  FROM (SELECT item_id, words, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS pos FROM items WHERE len(words) > 0)
), lengths AS (
  SELECT DISTINCT n FROM item_windows
), doc_windows AS (
  SELECT doc_id, n, pos, array_to_string(words[pos : pos + n - 1], ' ') AS w
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS pos FROM docs, lengths WHERE len(words) >= n)
), hits AS (
  SELECT d.doc_id, d.n, d.pos, i.item_id FROM doc_windows d JOIN item_windows i ON d.n = i.n AND d.w = i.w
), hit_words AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS word FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(w.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(w.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words w ON d.doc_id = w.doc_id LEFT JOIN hit_items i ON d.doc_id = i.doc_id
"""
