"""Secret scan: fixed forms, and strings that a character model holds for random.

Two Markov models of adjacent characters are trained from labelled samples: one
from the values that the fixed forms found, over a uniform prior (random strings),
one from the words that several documents share (ordinary identifiers). A run of token characters that no
fixed form covers is a secret when its log-likelihood ratio is high enough.

DataFrame expressions only. Positions come from the pieces between matches: both
``split`` and ``regexp_extract_all`` take leftmost matches that don't overlap.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The forms, in the order in which they are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Characters of a candidate; the model has a row for each, and one for the start.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WORD = r"[A-Za-z0-9+/_=-]{3,}"
#: A secret by the models: nats in all, and for each character.
MIN_LLR, MIN_MEAN = 12.0, 0.5
#: Training documents, about so many by a hash of doc_id: for words, and for secrets.
TRAIN_PLAIN, TRAIN_SECRET = 4000, 40_000
#: A word of so many of these documents is an ordinary one.
MIN_DOCS = 3
#: What a model's prior counts for beside the pairs that begin with a character.
RANDOM_WEIGHT, PLAIN_WEIGHT = 67.0, 10.0


def _found(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _placed(text: Column, pattern: str, found: Column, kind: int) -> Column:
    """array<struct<start, kind, stop, match>> of the matches, in code points."""
    gaps = F.split(text, pattern, -1)
    empty = F.expr("cast(array() as array<struct<start:int,kind:int,stop:int,match:string>>)")
    start = lambda acc, k: acc["at"] + F.length(F.get(gaps, k))

    def step(acc: Column, k: Column) -> Column:
        match = F.get(found, k)
        span = F.struct(start(acc, k).alias("start"), F.lit(kind).alias("kind"), (start(acc, k) + F.length(match)).alias("stop"), match.alias("match"))
        return F.struct((start(acc, k) + F.length(match)).alias("at"), F.concat(acc["all"], F.array(span)).alias("all"))

    first = F.struct(F.lit(0).alias("at"), empty.alias("all"))
    spans = F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), first, step, lambda acc: acc["all"])
    return F.when(F.size(found) > 0, spans).otherwise(empty)


def with_base(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``text``) and the spans of the fixed forms: assign, access, hex."""
    text = F.col("text")
    # A run of hex digits is taken whole, so asking for its length finds the same runs.
    rows = (rows.withColumn("assign", _found(text, ASSIGN))
            .withColumn("access", F.when(text.contains("AKIA"), _found(text, ACCESS)).otherwise(F.expr("cast(array() as array<string>)")))
            .withColumn("hex", _found(text, r"[0-9a-f]{24,}")))
    rows = (rows.withColumn("assign", _placed(text, ASSIGN, F.col("assign"), 0))
            .withColumn("access", _placed(text, ACCESS, F.col("access"), 1))
            .withColumn("hex", _placed(text, r"[0-9a-f]{24,}", F.col("hex"), 2)))
    value = lambda s: F.regexp_extract(s["match"], ASSIGN, 2)
    return (rows.withColumn("assign", F.filter("assign", lambda s: F.length(value(s)) >= LEAST["assign"]))
            .withColumn("access", F.filter("access", lambda s: s["stop"] - s["start"] >= LEAST["access"])))


def _pairs(words: DataFrame) -> DataFrame:
    """(a, b, n): adjacent characters of ``word``, ``times`` each; places in the alphabet, 0 the start."""
    codes = words.select("times", F.filter(F.transform(F.split("word", ""), lambda c: F.instr(F.lit(ALPHABET), c)), lambda k: k > 0).alias("codes"))
    pair = F.explode(F.zip_with(F.concat(F.array(F.lit(0)), "codes"), F.col("codes"), lambda a, b: F.struct(a.alias("a"), b.alias("b"))))
    return codes.select("times", pair.alias("p")).where("p.b is not null").groupBy("p.a", "p.b").agg(F.sum("times").alias("n"))


def train(docs: DataFrame) -> list[float]:
    """Log-likelihood ratios (random over ordinary) of each pair: row a, column b.

    At most (len(ALPHABET) + 1) ** 2 counts come to the driver.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = max(1, rows.count())
    place = F.pmod(F.xxhash64(F.lit("secrets"), "doc_id"), F.lit(total))
    secret = with_base(rows.where(place < TRAIN_SECRET))
    values = secret.select(F.explode(F.concat(
        F.transform("assign", lambda s: F.regexp_extract(s["match"], ASSIGN, 2)), F.transform("access", lambda s: s["match"]), F.transform("hex", lambda s: s["match"]))).alias("word"), F.lit(1).alias("times"))
    blank = F.col("text")
    for pattern in (ASSIGN, ACCESS, r"[0-9a-f]{24,}"):
        blank = F.regexp_replace(blank, pattern, " ")
    plain = rows.where(place < TRAIN_PLAIN).select(F.explode(F.array_distinct(F.regexp_extract_all(blank, F.lit(WORD), F.lit(0)))).alias("word"))
    plain = plain.groupBy("word").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") >= MIN_DOCS)
    k = len(ALPHABET) + 1
    tables = []
    for words, weight in ((values, RANDOM_WEIGHT), (plain, PLAIN_WEIGHT)):
        counts = [[0] * k for _ in range(k)]
        for a, b, n in _pairs(words).collect():
            counts[a][b] += n
        # Rare pairs lean on a prior: random strings are uniform, words have their own letters.
        ends = [0.5 + (words is plain) * sum(row[b] for row in counts) for b in range(k)]
        prior = [e / sum(ends[1:]) for e in ends]
        tables.append([[math.log((n + weight * p) / (sum(row) + weight)) for n, p in zip(row, prior, strict=True)] for row in counts])
    return [tables[0][a][b] - tables[1][a][b] for a in range(k) for b in range(k)]


def secret_spans(docs: DataFrame, ratios: list[float] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, text, assign, access, hex, markov (arrays of
    spans with start, kind, stop, match).

    Null text counts as empty; empty texts have no spans. Repeated rows get equal spans,
    a null doc_id is carried. A table without labelled secrets leaves the random model
    uniform; an empty table gives an empty result. Other columns are not read.
    """
    ratios = ratios if ratios is not None else train(docs)
    k = len(ALPHABET) + 1
    model = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")  # folded into one constant
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = with_base(rows).withColumn("markov", _found(F.col("text"), CANDIDATE))
    rows = rows.withColumn("markov", _placed(F.col("text"), CANDIDATE, F.col("markov"), 3))

    def ratio(span: Column) -> Column:
        codes = F.transform(F.split(span["match"], ""), lambda c: F.instr(F.lit(ALPHABET), c))
        step = lambda acc, c: F.when(c > 0, F.struct(c.alias("last"), (acc["sum"] + F.get(model, acc["last"] * k + c)).alias("sum"))).otherwise(acc)
        return F.aggregate(codes, F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum")), step, lambda acc: acc["sum"])

    base = F.concat("assign", "access", "hex")
    free = F.filter("markov", lambda s: s["match"].rlike("[A-Za-z]") & ~F.exists(base, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))
    rows = rows.withColumn("markov", free)
    rated = F.filter(F.transform("markov", lambda s: F.struct(s.alias("s"), ratio(s).alias("llr"))), lambda r: (r["llr"] >= MIN_LLR) & (r["llr"] >= MIN_MEAN * F.length(r["s"]["match"])))
    return rows.withColumn("markov", F.transform(rated, lambda r: r["s"]))


def _listed(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans; cases as in ``secret_spans``."""
    n = lambda c: F.size(c).cast("long").alias(f"n_{c}")
    return secret_spans(docs).select(
        "doc_id", n("assign"), n("access"), n("hex"),
        F.sha2(_listed(F.concat("assign", "access", "hex")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.concat("assign", "access", "hex", "markov")).alias("spans"), F.size("markov").cast("long").alias("n_markov"))
