"""Quality rules per document and verdicts per host, all in built-in functions.

A document fails by its own rules or by its host: failures are counted per host, the rates are
shrunk towards a beta prior fitted over all hosts, and a host whose shrunk rate is too high takes
its documents with it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup
from .common import WHITE, shared_table, text_or_empty

SYMBOLS = "#*$%&|<>"
WINDOW = 3
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rules:
    """Limits of a document, and the failure rate from which a host is rejected."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_host_rate: float = 0.5
    #: Bounds of the prior's weight, in documents: hosts that all agree would make it infinite.
    prior_weight: tuple[float, float] = (2.0, 1000.0)


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(WHITE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def _duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """Add the metrics of each text as long columns; a NULL text counts as empty.

    ``n_repeat_words`` counts words inside a window of three words that the text has twice or
    more, first ones included. Windows are compared by 64-bit hashes. Sorting the hashes with their
    places keeps a long text at n log n.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in METRICS]
    text = text_or_empty()
    split = docs.select(
        *columns,
        _words(text).alias("__w"),
        F.length(F.translate(text, WHITE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _duplicate_lines(text).alias("n_dup_lines"),
    )
    w, n = F.col("__w"), F.size("__w")
    windows = F.when(
        n >= WINDOW,
        F.array_sort(
            F.transform(
                F.sequence(F.lit(0), n - WINDOW),
                lambda i: F.struct(F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]).alias("h"), i.alias("p")),
            )
        ),
    ).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))
    hashed = split.withColumn("n_words", n.cast("long")).withColumn("__s", windows)
    s = F.col("__s")
    # Beside an end of the array there is no neighbour: NULL, which counts as unequal.
    again = F.filter(s, lambda x, k: x.h.eqNullSafe(F.get(s, k - 1).h) | x.h.eqNullSafe(F.get(s, k + 1).h))
    found = hashed.withColumn("__p", F.array_sort(F.transform(again, lambda x: x.p)))
    p = F.col("__p")
    covered = F.aggregate(
        F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return found.select(*columns, *[F.col(m) for m in METRICS[:-1]], covered.alias("n_repeat_words"))


def base_failed(rules: Rules) -> Column:
    return (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))


def host_rates(judged: DataFrame, host: str, rules: Rules) -> DataFrame:
    """Per host: documents, failures, and the failure rate shrunk towards all hosts' rates.

    The beta prior has the mean and variance of the hosts' own rates (method of moments).
    Documents without a host are in none. The prior is one row; hosts are never gathered.
    """
    hosts = (
        judged.filter(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("host"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    )
    rate = F.col("failed") / F.col("n")
    prior = hosts.agg(F.avg(rate).alias("mean"), F.var_pop(rate).alias("spread"))
    low, high = rules.prior_weight
    weight = F.when(F.col("spread") > 0, F.col("mean") * (1 - F.col("mean")) / F.col("spread") - 1).otherwise(F.lit(high))
    prior = prior.select("mean", F.greatest(F.lit(low), F.least(F.lit(high), weight)).alias("weight"))
    shrunk = (F.col("failed") + F.col("mean") * F.col("weight")) / (F.col("n") + F.col("weight"))
    # One row of two numbers beside every host.
    return hosts.crossJoin(F.broadcast(prior)).select("host", "n", "failed", shrunk.alias("host_rate"))


def judge(docs: DataFrame, host: str = "source", rules: Rules | None = None) -> DataFrame:
    """All columns of the documents, their metrics, ``base_failed``, ``host_rate`` and ``kept``.

    A NULL or empty text has no words and fails. A document without a host is judged by its own
    rules alone. Repeated rows are judged alike. Columns of the input named like a metric or a
    verdict are replaced.
    """
    rules = rules or Rules()
    out = ("base_failed", "host_rate", "kept")
    judged = measure(docs.drop(*out)).withColumn("base_failed", base_failed(rules))
    # Written once: the costly part is the metrics, and they are read for the hosts and the result.
    judged = shared_table(judged, "judged")
    rates = shared_table(host_rates(judged, host, rules), "hosts").select("host", "host_rate")
    joined = lookup(judged, rates, host, "host", ["host_rate"])
    kept = ~F.col("base_failed") & (F.coalesce("host_rate", F.lit(0.0)) <= rules.max_host_rate)
    return joined.withColumn("kept", kept)
