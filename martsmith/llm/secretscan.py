"""Secret scans: fixed patterns, and runs of encoded characters that pass a randomness battery.

Patterns give the base spans (assign, access, hex); they stay whatever the battery says. Further candidates are sought in
what the base spans leave: runs of ``MIN_RUN`` or more characters of the usual encodings with their padding, where an equals sign
before the end cuts (``name=value``), and the pieces of letters and digits that separators (``+ / - _``) leave of a run. From its
characters a candidate's encoding is inferred (hex, base32, base36, letters, base62, base64, base64url; numbers and
names with separators but without both cases have none). Under "random over that alphabet" three tests give p-values:

* chi-squared uniformity over the alphabet (Wilson-Hilferty): letter by letter if five or more of each are expected, else
  over cells of the alphabet that tell names and words from random letters: cases, digits, and the letters that are frequent in
  European languages;
* runs above and below the alphabet's middle (Wald-Wolfowitz, two-sided),
* serial correlation at lag 1 (two-sided).

Three times the smallest, at most 1, is the candidate's p. A candidate is reported as ``random`` if its p is over ``miss``, the share
of random strings that is missed in any case, and is not rejected by Benjamini-Hochberg at ``level`` either: power grows with length, so
that control is within length classes (each twice as long as the one before), over the candidates of all texts. It rejects up to ``level``
times the share of rejected candidates, so ``level`` is above ``miss``: among many names more is asked of a candidate. The ranks come
from a histogram of p-values (at most 301 bins per class, p rounded up to its bin's edge). A run is reported whole, or else by its
pieces. Letters of one case can't be told from a long word by so few characters and are tested from ``MIN_LETTERS`` on.

Built from DataFrame functions alone; texts are read once, candidates and spans are staged. Null text is
empty: no spans. Repeated rows get equal results; rows with a null id keep theirs. Other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martsmith.llm.common import fingerprint128, staged, table

# The patterns of the base spans.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 8  # characters of group 2 at least
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

KINDS = ["assign", "access", "hex", "random"]
MIN_RUN, MIN_LETTERS = 16, 32
RUN = r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_RUN
PIECE = r"[A-Za-z0-9]{%d,}" % MIN_RUN
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()

#: name, what a value looks like, alphabet; the first that fits is taken.
ENCODINGS = [
    ("hex", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", DIGITS + "abcdef"),
    ("hex_upper", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", UPPER + "234567"),
    ("base36", r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$", DIGITS + LOWER),
    ("base36_upper", r"^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+$", DIGITS + UPPER),
    ("lower", r"^[a-z]{%d,}$" % MIN_LETTERS, LOWER),
    ("upper", r"^[A-Z]{%d,}$" % MIN_LETTERS, UPPER),
    ("letters", r"^(?=.+[A-Z])(?=.*[a-z])[A-Za-z]+$", UPPER + LOWER),  # more than a capital at the start
    ("base62", r"^(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9]+$", DIGITS + UPPER + LOWER),
    ("base64", r"^(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", r"^(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
]

# The letters that are frequent in European languages, the next ones, and the rare ones.
FREQUENT, MIDDLE, RARE = "aeinorst", "cdhlmu", "jkqvwxyz"


def cell_of(char: str, one_case: bool) -> str:
    """The cell of a character, as a letter: finer among letters if the alphabet has one case only."""
    if not char.isalpha():
        return "n"
    low = char.lower()
    if one_case:
        return "f" if low in FREQUENT else "m" if low in MIDDLE else "r" if low in RARE else "o"
    frequent = "f" if low in FREQUENT else "o"
    return frequent.upper() if char.isupper() else frequent


def cells(alphabet: str) -> str:
    """The cells of an alphabet's characters, in its order."""
    one_case = not (any(c.isupper() for c in alphabet) and any(c.islower() for c in alphabet))
    return "".join(cell_of(c, one_case) for c in alphabet)


SPAN = "array<struct<start:int,kind:int,end:int>>"


def _matches(text: Column, pattern: str, values: Column, kind: int) -> Column:
    """Spans (start, kind, end) of all matches, whose texts are ``values``: the parts between
    them and the matches themselves add up to the positions."""
    lengths = F.arrays_zip(F.transform(F.split(text, pattern, -1), lambda x: F.length(x)).alias("gap"),
                           F.transform(values, lambda x: F.length(x)).alias("own"))
    first = F.struct(F.lit(0).alias("pos"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + x["own"]).alias("end"))
        return F.struct((start + x["own"]).alias("pos"), F.concat(acc["out"], F.array(span)).alias("out"))

    # the gap after the last match has no match of its own
    found = F.aggregate(F.slice(lengths, 1, F.size(values)), first, step, lambda acc: acc["out"])
    return F.when(F.size(values) > 0, found).otherwise(F.array().cast(SPAN))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, assign, access, hex, runs): spans of each kind, and the candidate runs with their value."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
    found = own.select("*", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"of_{k}") for k, p in patterns.items()])
    spans = {k: _matches(F.col("text"), p, F.col(f"of_{k}"), KINDS.index(k)) for k, p in patterns.items()}
    long_enough = F.transform(F.when(F.size("of_assign") > 0, F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))),
                              lambda x: F.length(x) >= ASSIGN_VALUE)
    assign = F.coalesce(F.filter(spans["assign"], lambda x, i: F.get(long_enough, i)), F.array().cast(SPAN))
    found = found.select("doc_id", "text", assign.alias("assign"), spans["access"].alias("access"), spans["hex"].alias("hex"))
    base = F.concat("assign", "access", "hex")
    blank = F.aggregate(base, F.col("text"), lambda t, s: F.overlay(
        t, F.repeat(F.lit(" "), s["end"] - s["start"]), s["start"] + 1, s["end"] - s["start"]))
    found = found.withColumn("left", F.when(F.size(base) > 0, blank).otherwise(F.col("text"))).withColumn(
        "of_runs", F.regexp_extract_all("left", F.lit(RUN), F.lit(0)))
    kind = KINDS.index("random")
    runs = F.transform(F.arrays_zip(_matches(F.col("left"), RUN, F.col("of_runs"), kind).alias("span"), F.col("of_runs").alias("value")), lambda x: F.struct(
        x["span"]["start"].alias("start"), x["span"]["end"].alias("end"), x["value"].alias("value")))
    return found.select("doc_id", F.array(*fingerprint128(F.col("text"))).alias("text_key"), "assign", "access", "hex", runs.alias("runs"))


def candidates_of(found: DataFrame) -> DataFrame:
    """(doc_id, text_key, run, part, start, end, value): each run (part 0) and, if separators part it, its pieces."""
    run = found.select("doc_id", "text_key", F.explode("runs").alias("r")).select("doc_id", "text_key", "r.*")
    run = run.withColumn("of_pieces", F.when(F.col("value").rlike("[+/_-]"), F.regexp_extract_all("value", F.lit(PIECE), F.lit(0))).otherwise(
        F.array().cast("array<string>")))
    piece = F.transform(F.arrays_zip(_matches(F.col("value"), PIECE, F.col("of_pieces"), 0).alias("span"), F.col("of_pieces").alias("own")), lambda x: F.struct(
        (F.col("start") + x["span"]["start"]).alias("start"), (F.col("start") + x["span"]["end"]).alias("end"), x["own"].alias("value")))
    parts = F.concat(F.array(F.struct("start", "end", "value")), piece)
    return run.select("doc_id", "text_key", F.col("start").alias("run"), F.posexplode(parts).alias("part", "p")).select(
        "doc_id", "text_key", "run", "part", "p.*")


def _upper_tail(z: Column) -> Column:
    """P(N(0, 1) > z), by the rational approximation of erfc with error below 1.5e-7 (Abramowitz and
    Stegun 7.1.26), and by its asymptotic form beyond 4."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    near = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * F.exp(-x * x) / 2
    far = F.exp(-x * x) / (2 * x * F.sqrt(F.lit(3.141592653589793)))
    tail = F.when(F.abs(z) > 4, far).otherwise(near)
    return F.when(z >= 0, tail).otherwise(1 - tail)


def battery(candidates: DataFrame) -> DataFrame:
    """``candidates`` (with ``value``) that have an encoding, with encoding, n, p_uniform, p_runs, p_serial and p."""
    body = F.regexp_replace("value", "=+$", "")
    encoding = F.coalesce(*[F.when(F.col("body").rlike(p), F.lit(k)) for k, (_, p, _) in enumerate(ENCODINGS)])
    c = candidates.withColumn("body", body).withColumn("code", encoding).where(F.col("code").isNotNull())
    alphabet = F.get(F.array(*[F.lit(a) for _, _, a in ENCODINGS]), F.col("code"))
    c = c.withColumns({"alphabet": alphabet, "n": F.length("body").cast("double")}).where(F.col("n") >= MIN_RUN)
    size = F.length("alphabet").cast("double")
    counts = F.transform(F.sequence(F.lit(1), F.length("alphabet")), lambda k: F.col("n") - F.length(
        F.replace(F.col("body"), F.substr(F.col("alphabet"), k, F.lit(1)), F.lit(""))))
    squares = F.aggregate(counts, F.lit(0.0), lambda s, k: s + k * k)
    # translate() needs constant tables: one per encoding
    sides = F.coalesce(*[F.when(F.col("code") == k, F.translate("body", a, "L" * (len(a) // 2) + "H" * (len(a) - len(a) // 2)))
                         for k, (_, _, a) in enumerate(ENCODINGS)])
    # each character's cell; a cell's share of the alphabet is what it is expected to have of the characters
    own_cells = F.coalesce(*[F.when(F.col("code") == k, F.translate("body", a, cells(a))) for k, (_, _, a) in enumerate(ENCODINGS)])
    shares = F.get(F.array(*[F.array(*[F.struct(F.lit(x).alias("cell"), F.lit(cells(a).count(x) / len(a)).alias("share")) for x in sorted(set(cells(a)))])
                             for _, _, a in ENCODINGS]), F.col("code"))
    c = c.withColumn("own_cells", own_cells)
    in_cells = F.aggregate(shares, F.lit(0.0), lambda s, x: s + F.pow(
        F.col("n") - F.length(F.replace(F.col("own_cells"), x["cell"], F.lit(""))) - F.col("n") * x["share"], F.lit(2.0)) / (F.col("n") * x["share"]))
    by_letter = F.col("n") >= 5 * size
    c = c.withColumns({"free": F.when(by_letter, size - 1).otherwise(F.size(shares) - 1).cast("double"),
                       "chi": F.when(by_letter, squares * size / F.col("n") - F.col("n")).otherwise(in_cells), "sides": sides})
    low = F.col("n") - F.length(F.replace(F.col("sides"), F.lit("L"), F.lit("")))
    c = c.withColumns({"low": low, "high": F.col("n") - low, "runs": F.length(
        F.regexp_replace(F.regexp_replace("sides", "L+", "L"), "H+", "H")).cast("double")})
    index = F.transform(F.sequence(F.lit(1), F.length("body")), lambda i: F.instr(
        F.col("alphabet"), F.substr(F.col("body"), i, F.lit(1))).cast("double"))
    zero = F.lit(0.0)
    sums = F.aggregate(index, F.struct(F.lit(-1.0).alias("last"), zero.alias("s"), zero.alias("q"), zero.alias("p"), zero.alias("first")), lambda a, x: F.struct(
        x.alias("last"), (a["s"] + x).alias("s"), (a["q"] + x * x).alias("q"),
        F.when(a["last"] < 0, a["p"]).otherwise(a["p"] + a["last"] * x).alias("p"),
        F.when(a["last"] < 0, x).otherwise(a["first"]).alias("first")))
    c = c.withColumn("sums", sums)
    n, m = F.col("n"), F.col("sums.s") / F.col("n")
    spread = F.col("sums.q") - n * m * m
    together = F.col("sums.p") - m * (2 * F.col("sums.s") - F.col("sums.first") - F.col("sums.last")) + (n - 1) * m * m
    cube = F.pow(F.greatest(F.col("chi"), zero) / F.col("free"), F.lit(1 / 3))
    uniform = _upper_tail((cube - (1 - 2 / (9 * F.col("free")))) / F.sqrt(2 / (9 * F.col("free"))))
    mean = 1 + 2 * F.col("low") * F.col("high") / n
    variance = (mean - 1) * (mean - 2) / (n - 1)
    by_runs = F.when(variance > 0, 2 * _upper_tail(F.abs(F.col("runs") - mean) / F.sqrt(variance))).otherwise(0.0)
    serial = F.when(spread > 0, 2 * _upper_tail(F.abs(together / spread + 1 / n) * F.sqrt(n))).otherwise(0.0)
    c = c.withColumns({"p_uniform": uniform, "p_runs": by_runs, "p_serial": serial})
    names = F.get(F.array(*[F.lit(k) for k, _, _ in ENCODINGS]), F.col("code"))
    return c.select(*candidates.columns, names.alias("encoding"), F.col("n").cast("int").alias("n"), "p_uniform", "p_runs", "p_serial",
                    F.least(F.lit(1.0), 3 * F.least("p_uniform", "p_runs", "p_serial")).alias("p"))


def not_rejected(tested: DataFrame, level: float = 0.01, miss: float = 0.0) -> DataFrame:
    """The rows of ``tested`` (n, p) with p above ``miss`` that Benjamini-Hochberg at ``level``, within length classes, doesn't
    reject."""
    bands = tested.withColumn("band", F.floor(F.log2(F.col("n") / MIN_RUN)).cast("int")).withColumn(
        "bin", F.floor(-10 * F.log10(F.greatest(F.col("p"), F.lit(1e-30)))).cast("int"))
    bins = bands.groupBy("band", "bin").agg(F.count(F.lit(1)).alias("k"))  # 301 per class at most
    down = Window.partitionBy("band").orderBy(F.desc("bin"))
    ranked = bins.select("band", "bin", F.sum("k").over(down).alias("rank"), F.sum("k").over(Window.partitionBy("band")).alias("m"))
    cut = ranked.where(F.pow(F.lit(10.0), -F.col("bin") / 10) <= level * F.col("rank") / F.col("m")).groupBy(
        F.col("band").alias("of_band")).agg(F.min("bin").alias("cut"))
    return bands.join(F.broadcast(cut), F.col("band") == F.col("of_band"), "left").where(
        (F.col("p") > miss) & (F.col("cut").isNull() | (F.col("bin") < F.col("cut")))).drop("band", "bin", "of_band", "cut")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", level: float = 0.05, miss: float = 0.01) -> DataFrame:
    """(doc_id, assign, access, hex, random): one row per row of ``docs``, spans (start, kind, end) of each kind."""
    if level <= miss:
        raise ValueError("level must be above miss: no p over miss would be rejected")
    found = staged(scan(docs, id_col, text_col), "secret-scan")
    tested = staged(battery(staged(candidates_of(found), "secret-candidates")), "secret-tests")  # read twice
    kept = not_rejected(tested, level, miss).groupBy(
        F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key")).agg(F.collect_set(F.struct("run", "part", "start", "end")).alias("parts"))
    # a run that is reported whole needs no pieces
    whole = F.transform(F.filter("parts", lambda x: x["part"] == 0), lambda x: x["run"])
    spans = F.transform(F.filter("parts", lambda x: (x["part"] == 0) | ~F.array_contains(whole, x["run"])), lambda x: F.struct(
        x["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), x["end"].alias("end")))
    kept = kept.select("of_id", "of_key", F.array_sort(spans).alias("random"))
    return found.join(kept, found["doc_id"].eqNullSafe(kept["of_id"]) & (found["text_key"] == kept["of_key"]), "left").select(
        "doc_id", "assign", "access", "hex", F.coalesce("random", F.array().cast(SPAN)).alias("random"))


def span_text(spans: Column) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random of every document."""
    got = find_secrets(table(spark, sf_dir, "documents"))
    return got.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(span_text(F.concat("assign", "access", "hex")), 256).alias("base_sha256"),
        span_text(F.concat("assign", "access", "hex", "random")).alias("spans"), F.size("random").cast("long").alias("n_random"))
