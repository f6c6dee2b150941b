"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes good (1) or bad (0) on a document or abstains (null). Documents are counted
by vote pattern: with r rules at most 3**r rows, whatever the corpus size. On these counts
expectation-maximisation estimates each rule's accuracy on good and on bad documents and the
share of good ones (votes independent given the class), in SQL array functions over the one
row of patterns. A document's posterior probability of being good adds the log-likelihood
ratios of its votes, and replaces "all rules must pass".

Base counts (contract): words are runs of anything but ASCII white space. Repeated words
are found without any exchange: 64-bit hashes of the 3-word windows of one text are sorted
with their positions, so equal windows are neighbours.

Defined results. Null and empty texts have no words, fail the base rules and are not kept.
Repeated rows are judged alike. An empty table gives an empty result. Carried columns
travel in a struct, so names can't clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, column, cut, table

SPACES = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
ROUNDS = 15
PRIOR = 0.85
START = {"gg": 0.9, "gb": 0.02, "bg": 0.5, "bb": 0.4}
SMOOTH = 1.0


def ratio(a: str, b: str) -> Column:
    return F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))


def banded(x: Column, good: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(0)).when(good, F.lit(1))


def rules() -> dict[str, Column]:
    """Name -> vote (1 good, 0 bad, null abstains) over the columns of features()."""
    repeat, symbols, lines = ratio("n_repeat_words", "n_words"), ratio("n_symbols", "word_chars"), ratio("n_dup_lines", "n_lines")
    mean, shout, variety = ratio("word_chars", "n_words"), ratio("n_shouts", "n_words"), ratio("n_distinct", "n_words")
    marked, capitals, n = ratio("n_symbols", "n_words"), ratio("n_capitals", "word_chars"), F.col("n_words")
    return {
        "repeats": banded(repeat, repeat < 0.2, repeat > 0.4),
        "variety": F.when(n >= 30, banded(variety, variety > F.least(F.lit(0.35), 25.0 / n), variety < F.least(F.lit(0.2), 10.0 / n))),
        "symbols": banded(symbols, symbols < 0.02, symbols > 0.05),
        "marked_words": banded(marked, marked < 0.1, marked > 0.25),
        "shouting": banded(shout, shout < 0.05, shout > 0.2),
        "capitals": banded(capitals, capitals < 0.15, capitals > 0.4),
        "lines": banded(lines, lines < 0.1, (lines > 0.3) & (F.col("n_dup_lines") >= 4)),
        "word_length": banded(mean, mean.between(3.5, 9.0), (mean < 2.0) | (mean > 15.0)),
    }


def features(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """row, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the other counts
    that rules read. One projection after another, no exchange."""
    t = F.coalesce(column(text_col).cast("string"), F.lit(""))
    d = docs.select(carried(docs, carry), t.alias("t"))
    blank = F.translate("t", SPACES[:-1], " " * (len(SPACES) - 1))
    d = d.select(
        "row", F.array_remove(F.split(blank, " "), "").alias("w"),
        F.length(F.translate("t", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("t") - F.length(F.translate("t", "!", ""))).cast("long").alias("n_shouts"),
        (F.length("t") - F.length(F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_capitals"),
        F.filter(F.split("t", "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0).alias("lines"),
    )
    n = F.size("w")
    h = F.when(n >= 3, F.transform("w", lambda x: F.xxhash64(x)))
    d = d.select(
        "row", "word_chars", "n_symbols", "n_shouts", "n_capitals", n.cast("long").alias("n_words"), h.alias("h"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
    )
    m = F.size("h") - 2
    three = F.zip_with(F.zip_with(F.slice("h", F.lit(1), m), F.slice("h", F.lit(2), m), lambda a, b: F.xxhash64(a, b)), F.slice("h", F.lit(3), m), lambda a, b: F.xxhash64(a, b))
    rest = [c for c in d.columns if c != "h"]
    d = d.select(*rest, F.when(F.col("h").isNotNull(), three).alias("g"))
    twice = F.size(F.array_distinct("g")) < F.size("g")
    d = d.select(*rest, F.when(twice, F.array_sort(F.transform("g", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))).alias("s"))
    same = F.filter("s", lambda x, k: (F.get("s", k - 1)["x"] == x["x"]) | (F.get("s", k + 1)["x"] == x["x"]))
    d = d.select(*rest, F.sort_array(F.transform(same, lambda x: x["i"])).alias("p"))
    gaps = F.zip_with(F.slice("p", F.lit(1), F.size("p") - 1), F.slice("p", F.lit(2), F.size("p") - 1), lambda a, b: F.least(b - a, F.lit(3)))
    covered = F.when(F.size("p") > 0, F.aggregate(gaps, F.lit(3), lambda a, x: a + x)).otherwise(0)
    return d.select(*rest, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def estimates(votes: DataFrame, names: list[str]) -> DataFrame:
    """One row: prior (share of good documents) and, for each rule, the probabilities of a
    good and a bad vote on good documents (gg, gb) and on bad ones (bg, bb); the rest abstains."""
    patterns = votes.groupBy(*names).agg(F.count("*").cast("double").alias("n"))
    signs = F.array(*[F.when(F.col(c).isNull(), 0).otherwise(F.col(c) * 2 - 1) for c in names])
    one = patterns.agg(F.array_sort(F.collect_list(F.struct(signs.alias("v"), F.col("n").alias("n")))).alias("p"))

    def weight(v: Column, e: Column) -> Column:
        rest = F.log((1.0 - e["gg"] - e["gb"]) / (1.0 - e["bg"] - e["bb"]))
        return F.when(v > 0, F.log(e["gg"] / e["bg"])).when(v < 0, F.log(e["gb"] / e["bb"])).otherwise(rest)

    def expected(x: Column) -> Column:
        """Of a pattern's documents, how many are good and how many bad."""
        m = F.col("m")
        odds = F.aggregate(F.zip_with(x["v"], m["rules"], weight), F.log(m["prior"] / (1.0 - m["prior"])), lambda a, b: a + b)
        good = 1.0 / (1.0 + F.exp(-odds))
        return F.struct(x["v"].alias("v"), (x["n"] * good).alias("g"), (x["n"] * (1.0 - good)).alias("b"))

    def total(of: str) -> Column:
        return F.aggregate("post", F.lit(0.0), lambda a, x: a + x[of])

    def share(of: str, out_of: str, rule: Column, vote: int) -> Column:
        voted = F.aggregate("post", F.lit(0.0), lambda a, x: a + F.when(F.get(x["v"], rule) == vote, x[of]).otherwise(0.0))
        return (voted + SMOOTH) / (F.col(out_of) + 3 * SMOOTH)

    def rule_of(j: Column) -> Column:
        return F.struct(share("g", "good", j, 1).alias("gg"), share("g", "good", j, -1).alias("gb"), share("b", "bad", j, 1).alias("bg"), share("b", "bad", j, -1).alias("bb"))

    start = F.array(*[F.struct(*[F.lit(x).alias(k) for k, x in START.items()])] * len(names))
    prior = (F.col("good") + PRIOR) / (F.col("good") + F.col("bad") + 1.0)
    one = one.select("p", F.struct(F.lit(PRIOR).alias("prior"), start.alias("rules")).alias("m"))
    for _ in range(ROUNDS):
        one = one.select("p", F.transform("p", expected).alias("post"))
        one = one.select("p", "post", total("g").alias("good"), total("b").alias("bad"))
        rules_ = F.transform(F.sequence(F.lit(0), F.lit(len(names) - 1)), rule_of)
        one = one.select("p", F.struct(F.least(F.lit(0.99), F.greatest(F.lit(0.5), prior)).alias("prior"), rules_.alias("rules")).alias("m"))
    return one.select("m.prior", "m.rules")


def quality_rules(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row a document: row, the counts, base_failed, posterior (probability of good) and
    kept (false if base_failed, else posterior >= 0.5)."""
    counted = cut(features(docs, text_col, carry))
    votes = rules()
    counted = counted.withColumns({f"vote_{k}": v for k, v in votes.items()})
    names = [f"vote_{k}" for k in votes]
    fit = estimates(counted, names).first()  # one row: four numbers a rule, and the prior
    odds = F.lit(math.log(fit["prior"] / (1.0 - fit["prior"])))
    for c, e in zip(names, fit["rules"]):
        rest = math.log((1.0 - e["gg"] - e["gb"]) / (1.0 - e["bg"] - e["bb"]))
        odds = odds + F.when(F.col(c) == 1, math.log(e["gg"] / e["bg"])).when(F.col(c) == 0, math.log(e["gb"] / e["bb"])).otherwise(rest)
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    out = counted.withColumn("base_failed", failed).withColumn("posterior", 1.0 / (1.0 + F.exp(-odds)))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("posterior", 6).alias("posterior"))
