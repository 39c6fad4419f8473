"""Document quality by hierarchical empirical Bayes.

A document's own evidence is the log likelihood ratio of its binned features, learned from
labelled documents by counting.  Documents of one host, and of one path within it, share
their quality to a degree that the data tell: a host's rate is its documents' mean drawn
to the global rate, a path's is drawn to its host's, each with as many prior
observations as the spread between groups warrants (method of moments).  So a sparse site
stays near the prior and a large one speaks for itself.  A document's posterior adds its
evidence to the log odds of its path without itself.

All of it is grouped aggregation; only a few global numbers come to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, cut, join_small, text_of
from .quality_rules import measures

#: feature: (expression over the measures, bins' upper ends).
FEATURES = {
    "words": ("n_words", (9, 20, 50, 200, 1000)),
    "symbols": ("n_symbols / greatest(n_words, 1)", (0.02, 0.1, 0.3, 1.0)),
    "lines": ("n_dup_lines / greatest(n_lines, 1)", (0.0, 0.1, 0.3)),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", (0.0, 0.05, 0.2, 0.5)),
    "length": ("word_chars / greatest(n_words, 1)", (3.0, 4.0, 6.0, 8.0, 12.0)),
    "capitals": ("capitals / greatest(word_chars, 1)", (0.05, 0.2, 0.5)),
    "marks": ("marks / greatest(n_words, 1)", (0.1, 0.5, 1.0)),
}
SMOOTHING = 1.0
#: Features overlap; their summed evidence is scaled down.
EVIDENCE_WEIGHT = 0.7
#: Prior observations of a level, at the least and at the most.
STRENGTH = (2.0, 10_000.0)
EPSILON = 1e-6
THRESHOLD = 0.5


def features(docs: DataFrame, host: Column, path: Column, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, host, path, one bin per feature)."""
    text = text_of(text_col)
    capitals = F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}", ""))
    marks = F.length(text) - F.length(F.translate(text, "!?", ""))
    rows = docs.select(col(id_col).alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"), measures(text).alias("m"), capitals.alias("capitals"), marks.alias("marks"))
    rows = rows.select("doc_id", "host", "path", "m.*", "capitals", "marks")
    above = lambda e, ends: F.size(F.filter(F.array(*map(F.lit, ends)), lambda end: F.expr(e) > end))
    bins = [above(e, [float(end) for end in ends]).alias(f) for f, (e, ends) in FEATURES.items()]
    return rows.select("doc_id", "host", "path", *bins)


def likelihoods(found: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality") -> tuple[dict, float]:
    """{feature: [log likelihood ratio by bin]} and the share of good labels; a bounded table."""
    known = labels.select(col(id_col).alias("label_id"), col(label_col).cast("int").alias("good")).filter("label_id IS NOT NULL AND good IS NOT NULL").groupBy("label_id").agg(F.max("good").alias("good"))
    rows = found.join(known, F.col("doc_id") == F.col("label_id"))
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in FEATURES]))
    counts = rows.select("good", pairs.alias("p")).groupBy("p.feature", "p.bin", "good").count().collect()
    n = {(r["feature"], r["bin"], min(max(r["good"], 0), 1)): r["count"] for r in counts}
    import math

    total = {g: sum(c for (f, _, k), c in n.items() if f == "words" and k == g) for g in (0, 1)}
    table = {}
    for f, (_, ends) in FEATURES.items():
        bins = len(ends) + 1
        share = lambda b, g: (n.get((f, b, g), 0) + SMOOTHING) / (total[g] + SMOOTHING * bins)  # noqa: E731, B023
        table[f] = [math.log(share(b, 1) / share(b, 0)) for b in range(bins)]
    return table, (total[1] + 1) / (total[0] + total[1] + 2)


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(EPSILON)), F.lit(1 - EPSILON))
    return F.log(p / (1 - p))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def strength(groups: DataFrame, mean: float) -> float:
    """Prior observations by the method of moments, from (n, total) of each group.

    The groups' means vary by chance about mean (1 - mean) / n; what they vary beyond is
    the spread between groups, and the less there is, the stronger the prior.
    """
    rate = F.col("total") / F.col("n")
    row = groups.agg(F.sum(F.col("n") * (rate - mean) ** 2).alias("s"), F.sum("n").alias("n"), F.count("*").alias("g")).first()
    if not row["n"] or row["g"] < 2:
        return STRENGTH[1]
    inner = mean * (1 - mean)
    between = row["s"] / row["n"] - inner * row["g"] / row["n"]
    return min(max(inner / max(between, 1e-9) - 1, STRENGTH[0]), STRENGTH[1])


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(doc_id, host, path, evidence, host_quality, path_quality, quality, kept) of every row.

    path_quality leaves the document itself out, at both levels.  Null texts count as empty, null hosts
    and paths as groups of their own; repeated rows are each judged; without labels all
    evidence is 0 and the prior one half; an empty table gives no rows.
    """
    found = cut(features(docs, host, path, id_col=id_col, text_col=text_col))
    table, prior = likelihoods(found, labels, label_col=label_col)
    parts = [F.get(F.array(*[F.lit(x) for x in ratios]), F.col(f)) for f, ratios in table.items()]
    scored = found.select("doc_id", "host", "path", (F.lit(EVIDENCE_WEIGHT) * sum(parts, F.lit(0.0))).alias("evidence"))
    scored = cut(scored.withColumn("own", _sigmoid(_logit(F.lit(prior)) + F.col("evidence"))))

    # Totals are kept as decimals, so they don't depend on the order of addition.
    exact = F.sum(F.col("own").cast("decimal(18,12)")).cast("double")
    paths = cut(scored.groupBy("host", "path").agg(F.count("*").alias("n"), exact.alias("total")))
    hosts = cut(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(28,12)")).cast("double").alias("total")))
    whole = hosts.agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(28,12)")).cast("double").alias("total")).first()
    mean = whole["total"] / whole["n"] if whole["n"] else prior
    host_strength, path_strength = strength(hosts, mean), strength(paths, mean)
    host_rate = (F.col("total") + host_strength * mean) / (F.col("n") + host_strength)
    rates = hosts.select(F.col("host").alias("h_host"), F.col("n").alias("h_n"), F.col("total").alias("h_total"), host_rate.alias("host_quality"))
    groups = cut(paths.join(rates, F.col("host").eqNullSafe(F.col("h_host"))).select(F.col("host").alias("p_host"), F.col("path").alias("p_path"), "n", "total", "h_n", "h_total", "host_quality"))
    rows = join_small(scored, groups, F.col("host").eqNullSafe(F.col("p_host")) & F.col("path").eqNullSafe(F.col("p_path")))
    host_without = (F.col("h_total") - F.col("own") + host_strength * mean) / (F.col("h_n") - 1 + host_strength)
    without = (F.col("total") - F.col("own") + path_strength * host_without) / (F.col("n") - 1 + path_strength)
    quality = _sigmoid(_logit(F.col("path_quality")) + F.col("evidence"))
    judged = rows.withColumn("path_quality", without).withColumn("quality", quality)
    return judged.select("doc_id", "host", "path", "evidence", "host_quality", "path_quality", "quality", (F.col("quality") >= THRESHOLD).alias("kept"))


def url_levels(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL column: the host without a leading www., the path's first part."""
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), r"^www\.", "")
    return host, F.regexp_extract(rest, r"^[^/?#]*/([^/?#]*)", 1)
