"""Mixing sources to target weights, in built-in functions.

Source shares of tokens are raised to an exponent between 0 and 1 and normalised. The exponent is
found by bisection; the weights are then realised as a stream of blocks, each of which has every
source in its weight, in an order that is a permutation of its own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import lookup
from .common import WORD, shared_table, text_or_empty

HALVINGS_PER_PASS = 4
PASSES = 5
_NO_SOURCE = "\x00none"  # rows without a source are a source of their own


@dataclass(frozen=True)
class Mixture:
    """``entropy`` is the least entropy of the weights as a share of the largest possible.

    ``repetition`` is how often the most repeated source may be shown for one showing of the least
    repeated. The exponent is the largest that meets the entropy, unless that breaks the limit on
    repetition; then the smallest that keeps it. ``tokens`` is the stream's budget; None takes the
    smallest that shows every document at least once.
    """

    entropy: float = 0.95
    repetition: float = 4.0
    tokens: int | None = None
    block_tokens: int = 1 << 20
    seed: str = "mix"


def count_tokens(text: Column) -> Column:
    """Words and one end mark, so that no document is free."""
    return (F.regexp_count(text, F.lit(WORD)) + 1).cast("long")


def _bisect(sources: DataFrame, score: list[Column], meets) -> tuple[float, float]:
    """Halve [0, 1] towards the border where ``meets`` changes; each pass looks at 15 exponents.

    Returns the ends of the last interval. ``meets`` is true for small exponents, false for large.
    """
    low, high = 0.0, 1.0
    steps = 2**HALVINGS_PER_PASS
    for _ in range(PASSES):
        points = [low + (high - low) * k / steps for k in range(1, steps)]
        row = sources.agg(*[f(a).alias(f"f{i}_{k}") for k, a in enumerate(points) for i, f in enumerate(score)]).first()
        ok = [meets(*[row[f"f{i}_{k}"] for i in range(len(score))]) for k in range(len(points))]
        first_not = ok.index(False) if False in ok else len(points)
        low, high = ([low, *points][first_not], [*points, high][first_not])
    return low, high


def exponent(sources: DataFrame, mix: Mixture) -> float:
    """The exponent for sources with a column ``share``, rounded to six digits."""
    p, n = F.col("share"), sources.count()
    if n < 2:
        return 1.0

    def entropy_ok(z: float, zl: float, a: float) -> bool:
        return math.log(z) - a * zl / z >= mix.entropy * math.log(n)

    scores = [lambda a: F.sum(F.pow(p, F.lit(a))), lambda a: F.sum(F.pow(p, F.lit(a)) * F.log(p)), lambda a: F.lit(a) + 0 * F.max(p)]
    by_entropy, _ = _bisect(sources, scores, entropy_ok)
    natural = sources.agg(F.sum(p * F.log(p)).alias("h"), F.max(p).alias("top"), F.min(p).alias("least")).first()
    if -natural["h"] >= mix.entropy * math.log(n):
        by_entropy = 1.0
    spread = math.log(natural["top"] / natural["least"])
    ratio = [lambda a: F.lit(1 - a) * F.log(F.max(p) / F.min(p))]
    _, by_limit = _bisect(sources, ratio, lambda r: r > math.log(mix.repetition))
    if spread <= math.log(mix.repetition):
        by_limit = 0.0
    return round(max(by_entropy, by_limit), 6)


def weigh(tokens: DataFrame, mix: Mixture) -> DataFrame:
    """Per source: ``tokens``, ``share``, ``weight`` (nine digits) and ``quota`` of the stream."""
    totals = tokens.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    everything = totals.agg(F.sum("tokens").alias("all"))
    # One row of one number beside every source.
    sources = shared_table(totals.crossJoin(F.broadcast(everything)).select("source", "tokens", (F.col("tokens") / F.col("all")).alias("share")), "sources")
    a = exponent(sources, mix)
    z = sources.agg(F.sum(F.pow("share", F.lit(a))).alias("z"))
    weighed = sources.crossJoin(F.broadcast(z)).select(
        "source", "tokens", "share", F.lit(a).alias("exponent"), F.round(F.pow("share", F.lit(a)) / F.col("z"), 9).alias("weight")
    )
    if mix.tokens is not None:
        return weighed.withColumn("quota", F.ceil(F.lit(mix.tokens) * F.col("weight")).cast("long"))
    most = weighed.agg(F.max(F.col("tokens") / F.col("weight")).alias("most"))
    quota = F.greatest("tokens", F.ceil(F.round(F.col("most") * F.col("weight"), 3)).cast("long"))
    return weighed.crossJoin(F.broadcast(most)).withColumn("quota", quota).drop("most")


def mixed(docs: DataFrame, mix: Mixture | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """The stream: ``block``, ``place`` in it, ``copy``, ``doc_id``, ``source``, ``tokens``.

    Documents of a source are put in the order of a digest; a source whose quota is larger than
    itself starts again, and the last showing stops at the quota (the document that crosses it is
    in). Each block takes an equal part of every quota and orders its documents by a digest of
    block and document. Prefix sums run within 4096 parts of a source, so a source with a third of
    all rows is spread.

    A NULL or empty text has one token, the end mark. Rows without a source form one source.
    Repeated rows are shown as often as they occur. An empty table gives no rows. ``carry`` names
    further columns to keep.
    """
    mix = mix or Mixture()
    digest = F.md5(F.concat_ws("|", F.lit(mix.seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit(_NO_SOURCE)).alias("source"),
        count_tokens(text_or_empty()).alias("tokens"), digest.alias("__key"), *[F.col(f"`{c}`").alias(f"__carry_{c}") for c in carry],
    )
    rows = shared_table(rows, "mix-rows")
    sources = shared_table(weigh(rows, mix), "mix-weights")
    total = sources.agg(F.sum("quota").alias("n")).first()["n"]
    blocks = max(1, -(-(total or 0) // mix.block_tokens))
    plan = sources.select("source", F.col("tokens").alias("__all"), "quota", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("quota") / F.lit(blocks))).alias("__part"))

    part = F.substring("__key", 1, 3)
    parts = rows.groupBy("source", part.alias("__bucket")).agg(F.sum("tokens").alias("__sum"))
    running = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("source", "__bucket", F.coalesce(F.sum("__sum").over(running), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("source", "__bucket").orderBy("__key", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rows.withColumn("__bucket", part)
        .withColumn("__inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
        .join(offsets, ["source", "__bucket"])
    )
    placed = lookup(placed, plan.withColumnRenamed("source", "__source"), "source", "__source", ["__all", "quota", "__part"])
    last = F.floor((F.col("quota") - 1) / F.col("__all")).cast("int")
    copies = placed.withColumn("copy", F.explode(F.sequence(F.lit(0), last)))
    at = F.col("copy").cast("long") * F.col("__all") + F.col("__offset") + F.col("__inside")
    shown = copies.withColumn("__at", at).filter(F.col("__at") < F.col("quota"))
    block = F.floor(F.col("__at") / F.col("__part")).cast("long")
    order = F.md5(F.concat_ws("|", F.lit(mix.seed), F.col("block").cast("string"), F.col("copy").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    # A block is bounded: its tokens, and at least one for each document.
    place = F.row_number().over(Window.partitionBy("block").orderBy("__order", "doc_id", "source", "__at"))
    return shown.withColumn("block", block).withColumn("__order", order).select(
        "block", place.alias("place"), "copy", "doc_id", F.nullif("source", F.lit(_NO_SOURCE)).alias("source"), "tokens",
        *[F.col(f"__carry_{c}").alias(c) for c in carry],
    )
