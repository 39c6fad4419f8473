"""Quality rules with thresholds learned per language and source, DataFrame functions only.

Every text is measured once.  For each language and source a mergeable quantile sketch
of each metric is kept: counts in logarithmic buckets, each 2 % wide, so a quantile
is right to 1 % of its value, any two sketches merge by adding counts, and the result
doesn't depend on order or partitions.  A metric's threshold is its median plus several
distances of the lower quartile from it: the better half of a group sets it, so junk in
up to half of the documents doesn't lift it.  Sketches merged by language, and over
everything, give thresholds of these; a group's is drawn to its language's, and that to
the one of everything, as if by ``PRIOR_ROWS`` more documents.  Documents are then joined
with their group's thresholds.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CHARS, col, cut, join_small, let, text_of, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
GAMMA = 1.02
#: Distances of the lower quartile from the median that a value may lie above the median.
FENCE = 6.0
#: metric: (expression, least spread).  The least spread keeps a group without variation
#: from rejecting every document that differs from it at all.
METRICS = {
    "symbol_rate": ("n_symbols / n_words", 0.03),
    "dup_line_rate": ("n_dup_lines / n_lines", 0.07),
    "repeat_rate": ("n_repeat_words / n_words", 0.03),
    "word_length": ("word_chars / n_words", 0.2),
}
PRIOR_ROWS = 200
#: The bucket of values up to ZERO_BELOW, under all others.
ZERO_BELOW = 1e-6
ZERO_BUCKET = -1_000_000


def measures(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Windows are compared by 64-bit hashes of their words within one text.
    """
    starts = lambda w: F.when(
        F.size(w) >= WINDOW, F.sequence(F.lit(0), F.size(w) - WINDOW)
    ).otherwise(F.array().cast("array<int>"))
    hashes = lambda w: F.transform(
        starts(w), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
    )

    def covered(h: Column) -> Column:
        """Words under windows whose hash occurs again: gaps between their starts, 5 at most."""
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        again = lambda s: F.filter(
            F.transform(
                s,
                lambda x, i: F.when(
                    (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]), x["i"]
                ),
            ),
            lambda x: x.isNotNull(),
        )
        span = lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
            F.lit(0),
            lambda a, x: a + x,
        )
        return let(F.sort_array(let(pairs, again)), span)

    repeats = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))
    # Without its spaces at the ends a line is empty exactly if it has no word.
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(SPACE_CHARS))) > 0)
    line_counts = let(
        lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))
    )
    word_counts = let(
        words_of(text),
        lambda w: F.struct(F.size(w).cast("long").alias("n"), let(hashes(w), repeats).cast("long").alias("repeat")),
    )
    without = lambda chars: F.length(F.translate(text, chars, ""))
    return let(
        F.struct(word_counts.alias("w"), line_counts.alias("l")),
        lambda x: F.struct(
            x["w"]["n"].alias("n_words"),
            without(SPACE_CHARS).cast("long").alias("word_chars"),
            (F.length(text) - without(SYMBOLS)).cast("long").alias("n_symbols"),
            x["l"]["n"].alias("n_lines"),
            x["l"]["dup"].alias("n_dup_lines"),
            x["w"]["repeat"].alias("n_repeat_words"),
        ),
    )


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")


def metric(name: str) -> Column:
    """The metric's value, 0 where its divisor is 0."""
    over, under = METRICS[name][0].split(" / ")
    return F.when(F.col(under) > 0, F.col(over) / F.col(under)).otherwise(0.0)


def bucket(value: Column) -> Column:
    """The sketch bucket of a value of 0 or more: it ends at GAMMA to the bucket's power."""
    return F.when(value <= ZERO_BELOW, F.lit(ZERO_BUCKET)).otherwise(
        F.ceil(F.log(value) / F.lit(math.log(GAMMA))).cast("int")
    )


def bucket_end(b: Column) -> Column:
    return F.when(b == ZERO_BUCKET, F.lit(0.0)).otherwise(F.pow(F.lit(GAMMA), b))


def sketch(measured: DataFrame) -> DataFrame:
    """Counts by lang, source, metric and bucket of the documents that pass the base rules."""
    values = F.array(*[F.struct(F.lit(m).alias("metric"), bucket(metric(m)).alias("bucket")) for m in METRICS])
    return (
        measured.filter(~base_failed())
        .select("lang", "source", F.explode(values).alias("v"))
        .groupBy("lang", "source", "v.metric", "v.bucket")
        .agg(F.count("*").alias("n"))
    )


def thresholds(sketches: DataFrame, prior_rows: int = PRIOR_ROWS) -> DataFrame:
    """One row per lang and source: a threshold for each metric."""
    levels = {"own": ["lang", "source"], "wide": ["lang"], "all": []}
    fences = {}
    for level, keys in levels.items():
        merged = sketches.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
        group = Window.partitionBy(*keys, "metric")
        upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = merged.select("*", F.sum("n").over(upto).alias("upto"), F.sum("n").over(group).alias("rows"))
        quantile = lambda q: bucket_end(F.min(F.when(F.col("upto") >= q * F.col("rows"), F.col("bucket"))))  # noqa: E731, B023
        fence = lambda m: (
            F.first(F.when(F.col("metric") == m, F.col("mid") + FENCE * F.greatest(F.col("mid") - F.col("low"), F.lit(METRICS[m][1]))), True)
        )
        quartiles = ranked.groupBy(*keys, "metric").agg(quantile(0.25).alias("low"), quantile(0.5).alias("mid"), F.max("rows").alias("rows"))
        fences[level] = quartiles.groupBy(*keys).agg(
            F.max("rows").alias(f"{level}_rows"), F.struct(*[fence(m).alias(m) for m in METRICS]).alias(level)
        )
    named = fences["wide"].withColumnRenamed("lang", "wide_lang").withColumn("all", fences["all"].select("all").scalar())
    drawn = lambda n, own, to: (F.col(n) * own + prior_rows * to) / (F.col(n) + prior_rows)
    limit = lambda m: drawn("own_rows", F.col("own")[m], drawn("wide_rows", F.col("wide")[m], F.col("all")[m]))
    return (
        fences["own"]
        .join(named, F.col("lang").eqNullSafe(F.col("wide_lang")))
        .select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), F.struct(*[limit(m).alias(m) for m in METRICS]).alias("limits"))
    )


def judged(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """``measured`` with base_failed and kept; ``limits`` is a computed table."""
    same = F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source"))
    within = F.lit(True)
    for m in METRICS:
        within = within & (metric(m) <= F.col("limits")[m])
    return join_small(measured, limits, same, "left").select(
        *[measured[c] for c in measured.columns],
        base_failed().alias("base_failed"),
        (~base_failed() & F.coalesce(within, F.lit(True))).alias("kept"),
    )


def measure(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", keep: bool = False) -> DataFrame:
    """doc_id, lang, source and the measures; with ``keep`` the row as it came in ``doc``.

    A filter on measures would be pushed below this projection and measure the text again
    for each mention; the condition on a row's position, always true, keeps it above.
    """
    always = F.monotonically_increasing_id() >= 0
    return docs.select(
        *([F.struct("*").alias("doc")] if keep else []),
        col(id_col).alias("doc_id"),
        col(lang_col).cast("string").alias("lang"),
        col(source_col).cast("string").alias("source"),
        F.when(always, measures(text_of(text_col))).alias("m"),
    ).select(*(["doc"] if keep else []), "doc_id", "lang", "source", "m.*")


def judge(docs: DataFrame, **columns) -> DataFrame:
    """Every document's measures, base_failed and kept; texts are measured once.

    A null text counts as empty and fails the base rules, as every text under ten words
    does.  Null languages and sources are groups of their own.  Repeated rows are judged
    alike, ties lie on the kept side of a threshold, an empty table gives no rows.
    """
    measured = cut(measure(docs, **columns))
    return judged(measured, cut(thresholds(sketch(measured))))


def keep_good(docs: DataFrame, **columns) -> DataFrame:
    """The documents that are kept, columns unchanged.

    Texts are measured once and written beside their measures, which takes far less time
    than measuring them again after the thresholds are known; nothing of them is shuffled.
    """
    measured = cut(measure(docs, keep=True, **columns))
    limits = cut(thresholds(sketch(measured.drop("doc"))))
    return judged(measured, limits).filter("kept").select("doc.*")
