"""URL rules, and verdicts for the other hosts by propagation over links between hosts.

Hosts are linked by their pages' links and by their domains.

Trust spreads from trusted hosts along links, distrust from blocked hosts against them: who links to
a blocked host is suspect. Both are personalised PageRanks, each as a part of the rank that the host
would have if every host were a seed. A host whose distrust reaches the threshold and exceeds its
trust is blocked. Rules always win over the propagated verdict.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import fits_broadcast, lookup
from .common import shared_table

#: Measured size up to which a host graph is walked in one task.
GRAPH_BYTES = 64 * 1024 * 1024
_CODE = r"(?is)(<(?:script|style)\b[^>]*>).*?</(?:script|style)\s*>|<!--.*?-->"
_ATTRIBUTE = r"""(?i)[\s"'/]([a-z][\w:.-]*)\s*=\s*("[^"]*"|'[^']*'|[^\s"'<>]+)"""
_BASE = r"""(?i)<base\b[^>]*\bhref\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""
_ABSOLUTE = r"(?i)^(https?:)?//[^/]"
_URLS = ("href", "src", "action", "formaction", "cite", "data", "poster", "background", "longdesc", "xlink:href")
_LISTS = ("srcset", "imagesrcset", "ping")  # several addresses in one value


@dataclass(frozen=True)
class Propagation:
    """``threshold``: distrust, in [0, 1], from which a host is blocked, if it exceeds the trust. On a
    host without links they are its shares of blocked and allowed pages. ``kin``: weight of an edge
    between a host and its parent domain, a link being 1."""

    damping: float = 0.85
    rounds: int | None = None  # no limit
    tolerance: float = 1e-6
    threshold: float = 0.5
    kin: float = 0.25


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path), such as ``("block", "net", "/fr/")``."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """Per host the rules of the host and its parents, longest first: ``rules``.

    A host meets its rules by equality with one of its suffixes, never by comparison with all.
    """
    parts = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))
    suffixes = hosts.select("host", F.explode(suffix).alias("suffix"))
    own = rules.select(F.lower("host").alias("__of"), "path", "verdict").distinct()
    found = suffixes.join(own, F.col("suffix") == F.col("__of"))
    text = F.concat("__of", "path")
    one = F.struct((-F.length(text)).alias("order"), F.col("verdict").alias("verdict"), F.col("path").alias("path"), text.alias("rule"))
    return found.groupBy("host").agg(F.array_sort(F.collect_list(one)).alias("rules"))


def links(pages: DataFrame) -> DataFrame:
    """Host edges of the pages' links, each pair once with the number of links.

    Targets are the values of every attribute outside comments and script text: addresses with a
    host, also in lists (``srcset``) and in a refresh; relative ones lead to the page's own host, or
    to that of its ``base``.
    """
    html = F.coalesce("html", F.lit(""))
    clean = F.regexp_replace(html, _CODE, "$1")
    names, values = (F.regexp_extract_all(F.col("clean"), F.lit(_ATTRIBUTE), F.lit(k)) for k in (1, 2))
    rows = pages.select(host_of(F.col("url")).alias("src"), F.regexp_extract(html, _BASE, 1).alias("base"), clean.alias("clean"))
    # Most pages have relative links only.
    rows = rows.filter(F.col("src") != "").filter(F.contains("clean", F.lit("//"))).withColumn("pair", F.explode(F.arrays_zip(names.alias("name"), values.alias("value"))))
    rows = rows.select("src", "base", F.lower("pair.name").alias("name"), F.regexp_replace("pair.value", r"""^["']?\s*|\s*["']?$""", "").alias("value"))
    refresh = F.regexp_extract("value", r"""(?i)^[\d.]*\s*[;,]\s*url\s*=\s*['"]?([^'"\s]+)""", 1)
    targets = F.when(F.col("name").isin(*_LISTS), F.split("value", r"[\s,]+")).when(F.col("name") == "content", F.array(refresh)).otherwise(F.array("value"))
    rows = rows.filter("name not like 'xmlns%'").select("src", "base", "name", F.explode(targets).alias("target"))
    relative = (F.col("base") != "") & F.col("name").isin(*_URLS, *_LISTS) & ~F.col("target").rlike(r"(?i)^([a-z][a-z0-9+.-]*:|#|//|$)") & ~F.col("target").rlike(r"^\d+(\.\d+)?[wx]$")
    target = F.when(F.col("target").rlike(_ABSOLUTE), F.col("target")).when(relative, F.col("base"))
    full = F.when(F.startswith(target, F.lit("//")), F.concat(F.lit("http:"), target)).otherwise(target)
    rows = rows.select("src", host_of(full).alias("dst")).filter("src != dst and dst != ''")
    return rows.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def kin(hosts: DataFrame) -> DataFrame:
    """Edges between a host and its parent domain, both ways, up to a domain of two labels.

    Hosts of one domain are siblings over their parent, which need not have pages. Addresses in
    numbers have no parent.
    """
    parts = F.split("host", r"\.")
    named = hosts.select("host").filter(F.size(parts) > 2).filter(~F.col("host").rlike(r"^[\d.]+(:\d+)?$|\[|\.\."))
    chain = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))
    pair = F.explode(F.transform(F.sequence(F.lit(1), F.size(chain) - 1), lambda k: F.struct(F.get(chain, k - 1).alias("src"), F.get(chain, k).alias("dst"))))
    up = named.select(pair.alias("pair")).select("pair.src", "pair.dst").distinct()
    return up.union(up.select("dst", "src")).withColumn("n", F.lit(1).cast("long"))


def _walk(shares: DataFrame, start: DataFrame, config: Propagation) -> DataFrame:
    """``host`` and ``score``: the start, plus damping * share of the score of each ``src`` at its ``dst``.

    Rounds go on until one moves at most ``tolerance`` of the sum of all scores (or for ``rounds``).
    A graph of measured small size is one task; a larger one is a join and a sum per round, whose
    rows are written, so a lost executor repeats one round. Both give the same scores.
    """
    shares, start = shared_table(shares, "link-shares"), shared_table(start, "link-starts")
    if shares.isEmpty():
        return start
    rows = shares.union(start.select(F.col("host").alias("src"), F.lit(None).cast("string").alias("dst"), F.col("score").alias("share")))
    if fits_broadcast(rows, GRAPH_BYTES):
        damping, rounds, tolerance = config.damping, config.rounds, config.tolerance

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            all_rows = pd.concat(list(batches))
            codes, names = pd.factorize(pd.concat([all_rows["src"], all_rows["dst"]]))
            src, dst, share = codes[: len(all_rows)], codes[len(all_rows) :], all_rows["share"].to_numpy()
            edge = dst >= 0  # a start has no target
            change = np.bincount(src[~edge], share[~edge], minlength=len(names))
            src, dst, share, score, k = src[edge], dst[edge], share[edge], change, 0
            while k != rounds and change.sum() > tolerance * score.sum():
                change, k = damping * np.bincount(dst, change[src] * share, minlength=len(names)), k + 1
                score = score + change
            yield pd.DataFrame({"host": names, "score": score})

        return shared_table(rows.repartition(1).mapInPandas(run, "host string, score double"), "host-scores")
    state, k = start.withColumn("change", F.col("score")), 0
    while k != config.rounds:
        moved = shares.join(state.filter("change > 0"), shares["src"] == state["host"]).select(F.col("dst").alias("host"), (F.col("change") * F.col("share") * config.damping).alias("change"))
        both = state.select("host", "score", F.lit(0.0).alias("change")).union(moved.select("host", F.col("change").alias("score"), "change"))
        state, k = shared_table(both.groupBy("host").agg(F.sum("score").alias("score"), F.sum("change").alias("change")), "host-scores"), k + 1
        sums = state.agg(F.sum("change").alias("change"), F.sum("score").alias("score")).first()
        if (sums["change"] or 0) <= config.tolerance * (sums["score"] or 0):
            break
    return state.select("host", "score")


def personalised_rank(edges: DataFrame, seeds: DataFrame, config: Propagation) -> DataFrame:
    """``host`` and ``score``: random walks from the seeds that start over with 1 - damping.

    A seed starts with its ``mass``; a host's score is handed on in proportion to its links.
    """
    out = edges.groupBy("src").agg(F.sum("n").alias("out"))
    shares = edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("out")).alias("share"))
    return _walk(shares, seeds.select("host", ((1 - config.damping) * F.col("mass")).alias("score")), config)


def _received(edges: DataFrame, seeds: DataFrame, everyone: DataFrame, config: Propagation, name: str) -> DataFrame:
    """``host`` and ``name`` in [0, 1]: the seeds' part of the personalised rank of each host.

    What a host receives over its links from seeds is divided by what it would receive if every host
    were a seed, so the figure depends neither on the number of hosts nor on how many links lead to
    a seed. The host's own mass counts by 1 - damping, as a walk starts over; alone without links.
    """
    own = 1 - config.damping
    mine = personalised_rank(edges, seeds, config).withColumnRenamed("score", "mine")
    whole = personalised_rank(edges, everyone.select("host", F.lit(1.0).alias("mass")), config)
    rows = whole.join(mine, "host", "left").join(seeds.select("host", "mass"), "host", "left").fillna(0.0, ["mine", "mass"])
    linked = F.col("score") - own
    share = F.least(F.lit(1.0), (F.col("mine") - own * F.col("mass")) / linked)
    part = F.when(linked > config.tolerance, own * F.col("mass") + config.damping * share).otherwise(F.col("mass"))
    return rows.select("host", F.greatest(F.lit(0.0), part).alias(name))


def propagate(edges: DataFrame, trusted: DataFrame, blocked: DataFrame, config: Propagation) -> DataFrame:
    """``host``, ``trust``, ``distrust`` and ``blocked`` for hosts with an edge or a seed.

    Trust follows the links from trusted hosts, distrust goes against them from blocked hosts.
    """
    against = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    everyone = shared_table(edges.select(F.col("src").alias("host")).union(edges.select("dst")).union(trusted.select("host")).union(blocked.select("host")).distinct(), "hosts")
    trust = _received(edges, trusted, everyone, config, "trust")
    distrust = _received(against, blocked, everyone, config, "distrust")
    limit = (F.col("distrust") >= config.threshold) & (F.col("distrust") > F.col("trust"))
    return trust.join(distrust, "host").withColumn("blocked", limit)


def judge(pages: DataFrame, rules: DataFrame, config: Propagation | None = None) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, trust, distrust.

    The longest rule whose host is the page's or a parent of it and whose path begins the page's
    decides (of equally long ones, ``allow``). A host is a seed of trust by the share of its
    pages that rules allow, and of distrust by the share that they block. Other pages are blocked
    if their host is, else allowed. A NULL URL, or one without ``://``, has an empty host
    and path and is allowed. Repeated rows are judged alike; an empty table gives no rows.
    NULL or empty html has no links; html of any length is searched whole, one page at a time.
    """
    config = config or Propagation()
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    hosts = urls.select("host").distinct()
    edges = links(pages).union(kin(hosts).withColumn("n", F.col("n") * config.kin)).groupBy("src", "dst").agg(F.sum("n").alias("n"))
    edges = shared_table(edges, "links")
    known = shared_table(host_rules(hosts, rules).withColumnRenamed("host", "__host"), "host-rules")
    fit = F.try_element_at(F.filter("rules", lambda r: F.startswith("path", r.path)), F.lit(1))
    matched = lookup(urls, known, "host", "__host", ["rules"]).withColumn("fit", fit)
    matched = shared_table(matched.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("by_rule")), "matched")
    pages_of = matched.filter("host != ''").groupBy("host").agg(
        (F.count_if(F.col("by_rule") == "allow") / F.count(F.lit(1))).alias("allowed"), (F.count_if(F.col("by_rule") == "block") / F.count(F.lit(1))).alias("barred")
    )
    seeds = shared_table(pages_of, "seeds")
    trusted, barred = seeds.filter("allowed > 0").select("host", F.col("allowed").alias("mass")), seeds.filter("barred > 0").select("host", F.col("barred").alias("mass"))
    scores = shared_table(propagate(edges, trusted, barred, config).withColumnRenamed("host", "__host"), "scores")
    out = lookup(matched, scores, "host", "__host", ["trust", "distrust", "blocked"])
    verdict = F.coalesce("by_rule", F.when(F.coalesce("blocked", F.lit(False)), F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
