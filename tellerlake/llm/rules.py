"""Quality rules whose cutoffs carry a guarantee, in DataFrame functions only.

Each text gets measures that grow with damage, and each measure has levels: its
cutoffs, from lenient to strict. A text that exceeds a cutoff in use is rejected.
Which levels a stratum may use is decided on its labelled good documents that
pass the base rules, one trial a labelled id: of an id with several rows the
worst of each measure counts. A hash splits them into two halves.

The first half proposes: for each measure the strictest level at which it alone
rejects few. A measure that good documents exceed at every level is proposed none
and leaves the others their chance. The second half tests the proposal, in the
order in which all its levels grow together from the first on: each step by its
rejections k of n with the exact binomial tail P(Bin(n, ALPHA) <= k), until one
fails. Given the first half that order is fixed, so the chain needs no correction
for its steps, and the strata share DELTA: with probability 1 - DELTA no stratum
rejects, beyond the base rules, more than ALPHA of its good documents. A stratum
without enough labels passes no step and rejects nothing.

Strata are the languages, each by itself however many there are. Measures are
written down once; labels meet them as a few numbers a document, and texts are
never shuffled.

Defined results: a null or empty text has no words and fails the base rules;
null labels and ids are no labels, repeated labels are averaged; a null
language is a language; rows are returned as often as they occur, and other
columns play no part; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tellerlake.operators.joins import on_hot_key, written

ALPHA, DELTA = 0.05, 0.05
#: Cutoffs of each measure by level, lenient to strict.
LEVELS = {
    "symbols": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05),
    "repeated_lines": (0.9, 0.8, 0.7, 0.6, 0.55, 0.5, 0.45, 0.4),
    "repeated_words": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "capitals": (0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35),
    "word_length": (20.0, 18.0, 16.0, 14.0, 13.0, 12.0, 11.0, 10.0),
    "exclamations": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05),
}
N_LEVELS = 8
SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5
#: Terms of a binomial tail that are added one by one; the others enter by an upper bound.
TERMS = 20_000


def _pairs(array: Column) -> tuple[Column, Column]:
    """All but the first and all but the last element."""
    n = F.greatest(F.size(array) - 1, F.lit(0))
    return F.slice(array, F.lit(2), n), F.slice(array, F.lit(1), n)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with its counts.

    These are n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words, n_capitals and n_exclamations.

    Words in repeated windows: the windows' hashes are sorted with their places,
    equal neighbours give the places that count, and the gaps between those give
    the words covered. Each step is a projection, as a lambda would evaluate what
    it captures anew for every element.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split("__text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    first = docs.select(*kept, body.alias("__text")).select(
        *kept,
        F.transform(F.filter(F.split("__text", SPACE), lambda w: w != ""), lambda w: F.xxhash64(w)).alias("__words"),
        lines.alias("__lines"),
        F.length(F.regexp_replace("__text", SPACE, "")).cast("long").alias("word_chars"),
        *[
            F.regexp_count("__text", F.lit(p)).cast("long").alias(c)
            for c, p in (("n_symbols", "[#*$%&|<>]"), ("n_capitals", "[A-Z]"), ("n_exclamations", "!"))
        ],
    )
    counts = ["word_chars", "n_symbols", "n_capitals", "n_exclamations"]
    n = F.size("__words")
    shifted = [F.slice("__words", F.lit(k + 1), F.greatest(n - WINDOW + 1, F.lit(0))) for k in range(WINDOW)]
    second = first.select(
        *kept,
        *counts,
        n.cast("long").alias("n_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.transform(F.arrays_zip(*shifted), lambda z: F.xxhash64(z)).alias("__windows"),
    )
    counts += ["n_words", "n_lines", "n_dup_lines"]
    m = F.size("__windows")
    placed = F.sort_array(F.arrays_zip(F.col("__windows").alias("h"), F.sequence(F.lit(0), m - 1).alias("at")))
    third = second.select(*kept, *counts, F.when(F.size(F.array_distinct("__windows")) < m, placed).alias("__sorted"))
    later, earlier = _pairs(F.col("__sorted"))
    # Of equal neighbours both places count; a place that is named twice is kept once.
    equal = F.filter(F.arrays_zip(later.alias("b"), earlier.alias("a")), lambda z: z["a"]["h"] == z["b"]["h"])
    fourth = third.select(*kept, *counts, equal.alias("__equal"))
    places = F.concat(F.transform("__equal", lambda z: z["a"]["at"]), F.transform("__equal", lambda z: z["b"]["at"]))
    fifth = fourth.select(*kept, *counts, F.sort_array(F.array_distinct(places)).alias("__places"))
    later, earlier = _pairs(F.col("__places"))
    gaps = F.zip_with(later, earlier, lambda b, a: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(gaps, F.lit(WINDOW), lambda s, g: s + g)
    return fifth.select(*kept, *counts, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _shares() -> dict[str, Column]:
    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))

    return {
        "symbols": share("n_symbols", "word_chars"),
        "repeated_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "capitals": share("n_capitals", "word_chars"),
        "word_length": share("word_chars", "n_words"),
        "exclamations": share("n_exclamations", "word_chars"),
    }


PASSED = {name: f"passed_{name}" for name in LEVELS}


def levels_passed() -> dict[str, Column]:
    """For each measure the number of levels that the text stays within, counted from the lenient end."""
    shares = _shares()

    def passed(name: str) -> Column:
        return reduce(lambda a, b: a + b, [(shares[name] <= cutoff).cast("int") for cutoff in LEVELS[name]])

    return {column: passed(name) for name, column in PASSED.items()}


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1, by Stirling's series at x + 8."""
    y = x + 8
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return series - reduce(lambda a, b: a + b, [F.log(x + k) for k in range(8)])


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k): exact up to TERMS terms, beyond them an upper bound; 1 from k = n p on."""
    n, k = n.cast("double"), k.cast("double")
    top = F.exp(
        log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log(1 - p)
    )
    begin = F.struct(top.alias("term"), F.lit(0.0).alias("sum"), k.alias("j"), n.alias("n"))

    def add(s: Column, _: Column) -> Column:
        ratio = s["j"] * (1 - p) / ((s["n"] - s["j"] + 1) * p)
        term, total = s["term"] * ratio, s["sum"] + s["term"]
        return F.struct(term.alias("term"), total.alias("sum"), (s["j"] - 1).alias("j"), s["n"].alias("n"))

    def finish(s: Column) -> Column:
        # The next terms shrink at least as fast as this ratio.
        ratio = s["j"] * (1 - p) / ((s["n"] - s["j"] + 1) * p)
        return s["sum"] + F.when(s["j"] >= 0, s["term"] / (1 - ratio)).otherwise(0.0)

    steps = F.sequence(F.lit(0), F.least(k, F.lit(TERMS)).cast("int"))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.aggregate(steps, begin, add, finish))


def cutoffs(measured: DataFrame, labels: DataFrame, id: str = "doc_id", label: str = "quality") -> DataFrame:
    """(stratum, n_good, a column for each measure): the strictest levels that each stratum may use, 0 for none.

    ``n_good`` counts the labelled ids that were tried, of both halves.
    """
    known = labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{id}`").isNotNull())
    good = known.groupBy(F.col(f"`{id}`").alias("__labelled")).agg(F.avg(f"`{label}`").alias("__good")).where("__good >= 0.5")
    tried = measured.where(~base_failed()).join(good, on_hot_key(id, "__labelled"))
    held = tried.groupBy("stratum", "__labelled").agg(*[F.min(passed).alias(passed) for passed in PASSED.values()])
    half = F.pmod(F.xxhash64(F.lit("half"), "__labelled"), F.lit(2))
    held = held.select("stratum", half.alias("half"), *PASSED.values()).groupBy("stratum", "half", *PASSED.values())
    held = written(held.agg(F.count("*").alias("n")), "rules-held")
    levels = range(1, N_LEVELS + 1)

    def rejections(exceeds: list[Column]) -> Column:
        return F.array(*[F.sum(F.when(e, F.col("n")).otherwise(0)) for e in exceeds])

    first = F.when(F.col("half") == 0, F.col("n"))
    alone = [
        F.array(*[F.coalesce(F.sum(F.when(F.col(passed) < k, first)), F.lit(0)) for k in levels]).alias(name)
        for name, passed in PASSED.items()
    ]
    counted = held.groupBy("stratum").agg(F.sum("n").alias("n_good"), F.coalesce(F.sum(first), F.lit(0)).alias("n"), *alone)
    few = F.col("n") * (ALPHA / (2 * len(LEVELS)))
    proposed = counted.select(
        F.col("stratum").alias("__stratum"), "n_good", *[F.size(F.filter(name, lambda k: k <= few)).alias(name) for name in LEVELS]
    )
    proposed = written(proposed, "rules-proposed")
    strata = max(1, proposed.count())
    second = held.where("half = 1").join(proposed, on_hot_key("stratum", "__stratum"))
    exceeds = [
        reduce(lambda a, b: a | b, [F.col(passed) < F.least(F.col(name), F.lit(k)) for name, passed in PASSED.items()])
        for k in levels
    ]
    counts = second.groupBy("stratum").agg(F.sum("n").alias("n"), rejections(exceeds).alias("k"))
    # Strata times levels rows.
    tested = counts.select("stratum", "n", F.posexplode("k").alias("step", "k"))
    tested = tested.withColumn("passes", (binomial_tail(F.col("n"), F.col("k"), ALPHA) <= DELTA / strata).cast("int"))
    ordered = Window.partitionBy("stratum").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    chain = tested.withColumn("chain", F.min("passes").over(ordered))
    steps = chain.groupBy("stratum").agg(F.sum("chain").alias("steps"))
    allowed = proposed.join(steps, on_hot_key("__stratum", "stratum"), "left")
    granted = [F.least(F.col(name), F.coalesce("steps", F.lit(0))).cast("int").alias(name) for name in LEVELS]
    return allowed.select(F.col("__stratum").alias("stratum"), "n_good", *granted)


def judge(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", stratum: str = "lang", label: str = "quality"
) -> DataFrame:
    """Per row of ``docs``: its id, counts, ``base_failed`` and ``kept``."""
    columns = [F.col(f"`{id}`").alias(id), F.coalesce(F.col(f"`{stratum}`").cast("string"), F.lit("")).alias("stratum")]
    measured = measure(docs.select(*columns, F.col(f"`{text}`").alias("__body")), "__body")
    measured = written(measured.withColumns(levels_passed()), "rules-measured")
    allowed = cutoffs(measured, labels, id, label).withColumnRenamed("stratum", "__stratum").drop("n_good")
    judged = measured.join(written(allowed, "rules-cutoffs"), on_hot_key("stratum", "__stratum"), "left")
    within = [F.col(passed) >= F.coalesce(name, F.lit(0)) for name, passed in PASSED.items()]
    return judged.select(
        F.col(f"`{id}`"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        reduce(lambda a, b: a & b, within, ~base_failed()).alias("kept"),
    )
