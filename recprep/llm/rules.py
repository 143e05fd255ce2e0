"""Quality rules as weak supervision: votes, accuracies by expectation-maximisation, posteriors.

Built-in column functions only; no Python runs on the executors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recprep.llm.common import SPACE, text_of
from recprep.session import materialize

WINDOW = 8  # words in a window of repeated text
SYMBOLS = "[#*$%&|<>]"


def _windows(words: Column) -> Column:
    """Hashes of all windows of WINDOW words, in order."""
    last = F.size(words) - WINDOW
    return F.when(
        last >= 0,
        F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(words, i + 1, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))


def _covered(pairs: Column) -> Column:
    """Words covered by windows that occur at least twice; pairs: sorted (hash, position)."""
    at = lambda i: F.get(pairs, i)["h"]
    again = F.filter(pairs, lambda x, i: (x["h"] == at(i - 1)) | (x["h"] == at(i + 1)))
    places = F.array_sort(F.transform(again, lambda x: x["i"]))
    total = F.aggregate(
        places,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    return total.cast("long")


def signals(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts over each whole text; null text has no words. Other columns are left out.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and n_lines (lines with a
    word), n_upper, n_letters, n_distinct (distinct words), n_long (words over 30 characters).
    """
    docs = df.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    # Empty strings at the ends of split() are no words.
    words = F.array_remove(F.split("text", SPACE), "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    cut = docs.withColumns({"words": words, "lines": lines})
    hashed = cut.withColumn("windows", _windows(F.col("words")))
    pairs = F.array_sort(
        F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.cast("int").alias("i")))
    )
    once = F.size(F.array_distinct("windows")) == F.size("windows")
    marked = hashed.withColumn("pairs", F.when(~once, pairs))
    chars = F.length(F.regexp_replace("text", SPACE, ""))
    return marked.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        chars.cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("pairs").isNull(), F.lit(0).cast("long")).otherwise(_covered(F.col("pairs"))).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.length("text") - F.length(F.regexp_replace("text", r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
        (F.length("text") - F.length(F.regexp_replace("text", r"\p{L}+", ""))).cast("long").alias("n_letters"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.size(F.filter("words", lambda w: F.length(w) > 30)).cast("long").alias("n_long"),
    )


def _rate(top: str, bottom: str) -> Column:
    return F.col(top) / F.greatest(F.col(bottom), F.lit(1))


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, good where ``good`` holds, else abstains."""

    name: str
    bad: Column
    good: Column


def default_rules() -> list[Rule]:
    """Thresholds as in common public rule sets for web text; between the two, a rule abstains."""
    symbols, mean = _rate("n_symbols", "n_words"), _rate("word_chars", "n_words")
    repeats, lines = _rate("n_repeat_words", "n_words"), _rate("n_dup_lines", "n_lines")
    upper, letters = _rate("n_upper", "n_letters"), _rate("n_letters", "word_chars")
    variety, many = _rate("n_distinct", "n_words"), F.col("n_words") >= 30
    return [
        Rule("symbols", symbols > 0.1, symbols < 0.01),
        Rule("many_symbols", symbols > 0.3, symbols < 0.1),
        Rule("word_length", (mean < 2.5) | (mean > 12), mean.between(3, 10)),
        Rule("repeats", repeats > 0.25, repeats == 0),
        Rule("lines", lines > 0.5, (lines == 0) & (F.col("n_lines") > 1)),
        Rule("capitals", upper > 0.4, upper < 0.2),
        Rule("letters", letters < 0.75, letters > 0.85),
        Rule("variety", many & (variety < 0.25), many & (variety > 0.4)),
    ]


def votes(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``vote``: one of 0 (bad), 1 (good), 2 (abstain) per rule, as base-3 digits of a long."""
    digit = [F.when(r.bad, 0).when(r.good, 1).otherwise(2) for r in rules]
    return df.withColumn("vote", sum((d * F.lit(3**i) for i, d in enumerate(digit)), F.lit(0)).cast("long"))


@dataclass(frozen=True)
class LabelModel:
    """Probability of a good document, and of each vote given good and given bad."""

    prior: float
    given_good: tuple[tuple[float, float, float], ...]
    given_bad: tuple[tuple[float, float, float], ...]

    def odds(self) -> list[float]:
        """Log-odds of good that each vote of each rule adds, rule by rule."""
        pairs = zip(self.given_good, self.given_bad)
        return [math.log(g / b) for good, bad in pairs for g, b in zip(good, bad)]

    def prior_odds(self) -> float:
        return math.log(self.prior / (1 - self.prior))


def ballots(vote: Column, n_rules: int) -> Column:
    """Per rule the index 3 * rule + digit of its vote."""
    digits = [F.pmod(F.floor(vote / 3**i), F.lit(3)).cast("int") + 3 * i for i in range(n_rules)]
    return F.array(*digits)


def posterior(ballot: Column, prior_odds: Column, odds: Column) -> Column:
    """Probability of good given the votes and the log-odds of a model."""
    total = F.aggregate(ballot, prior_odds, lambda acc, k: acc + F.get(odds, k))
    return 1 / (1 + F.exp(-total))


# What is believed of a rule before any data: shares of bad, good and no votes. A good document
# seldom fails a rule; a bad one fails some and passes most.
GOOD_VOTES = (0.005, 0.75, 0.245)
BAD_VOTES = (0.3, 0.6, 0.1)


def learn(patterns: DataFrame, n_rules: int, *, prior: float = 0.85, strength: float = 1.0, steps: int = 25) -> LabelModel:
    """Expectation-maximisation over the table of vote patterns (vote, n).

    Votes are independent given the class. The prior beliefs above are the start, and they
    count in each step like ``strength`` times the number of documents; that keeps the two
    classes from turning into, say, short and long texts, at every size of the table. The
    table has one row per pattern that occurs, at most 3 ** rules, whatever the number of
    documents; each step is one aggregate over it, in which the model is a one-row table. An
    empty table leaves the start values.
    """
    spark = patterns.sparkSession
    model = LabelModel(prior, (GOOD_VOTES,) * n_rules, (BAD_VOTES,) * n_rules)
    cast = patterns.withColumn("ballot", ballots(F.col("vote"), n_rules))
    for _ in range(steps):
        now = spark.createDataFrame([(model.prior_odds(), model.odds())], "prior_odds double, odds array<double>")
        expected = cast.crossJoin(F.broadcast(now)).select(
            "n", "ballot", (F.col("n") * posterior(F.col("ballot"), F.col("prior_odds"), F.col("odds"))).alias("good")
        )
        sums = {
            r["k"]: (float(r["n"]), float(r["good"]))
            for r in expected.select(F.explode("ballot").alias("k"), "n", "good")
            .groupBy("k").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).collect()
        }
        if not sums:
            return model
        new = _update(sums, n_rules, prior, strength)
        moved = max(abs(x - y) for x, y in zip(model.odds(), new.odds()))
        model = new
        if moved < 1e-4:
            break
    return model


def _update(sums: dict[int, tuple[float, float]], n_rules: int, prior: float, strength: float) -> LabelModel:
    """Shares of the expected counts and the prior beliefs."""
    seen = [[sums.get(3 * i + v, (0.0, 0.0)) for v in range(3)] for i in range(n_rules)]
    whole, good = (sum(pair[j] for pair in seen[0]) for j in (0, 1))
    weight = strength * whole

    def shares(counts: list[float], beliefs: tuple[float, ...], mass: float) -> tuple[float, ...]:
        return tuple((max(0.0, c) + weight * b) / (mass + weight) for c, b in zip(counts, beliefs))

    given_good = tuple(shares([g for _, g in rule], GOOD_VOTES, good) for rule in seen)
    given_bad = tuple(shares([n - g for n, g in rule], BAD_VOTES, whole - good) for rule in seen)
    return LabelModel((good + weight * prior) / (whole + weight), given_good, given_bad)


def quality_rules(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep_from: float = 0.5) -> DataFrame:
    """Signals, base_failed, posterior (probability of good) and kept, one row per document.

    base_failed: fewer than 20 words, or 100 * n_repeat_words > 30 * n_words. A document is
    kept if it does not fail the base and its posterior is at least ``keep_from``.

    Defined cases: null and empty texts have no words and fail the base; repeated rows are
    scored alike; an empty table gives an empty result; other columns are left out.
    """
    rules = default_rules()
    counted = materialize(votes(signals(df, id_col=id_col, text_col=text_col), rules))
    patterns = materialize(counted.groupBy("vote").agg(F.count(F.lit(1)).alias("n")))
    model = learn(patterns, len(rules))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (
        counted.withColumn("base_failed", failed)
        .withColumn("posterior", posterior(
            ballots(F.col("vote"), len(rules)), F.lit(model.prior_odds()), F.array(*map(F.lit, model.odds()))
        ))
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_from))
    )
