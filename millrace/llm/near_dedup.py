"""Near-duplicate documents: consistent weighted samples of TF-IDF shingles, banded and verified.

1. Texts with the same words are one node. The nodes that have a shingle are counted exactly, so
   copies of a text count once.
2. Each node gets samples of its shingles weighted by TF-IDF, and samples of its set of shingles.
   Two nodes agree in a sample with a probability equal to their (weighted) Jaccard similarity.
   Groups of samples are band keys.
3. Nodes that share a band key are compared on their texts: first each with a few hubs of its
   bucket, then, in buckets whose nodes are not yet in one class, block against block. A pair in
   one class already needs no comparison. Two texts are alike when their weighted or their plain
   similarity reaches the limit: near copies in large groups, whose shingles are frequent and light
   for that reason, are found by the plain one.
4. Classes are the components of verified links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup
from .common import drop_table, give_back, release, shared_table, text_or_empty
from .components import components
from .sketches import WordHashes, document_frequencies, hashed_words, shingles

_POOL_BITS = 16  # independent draws of (r, c, beta), shared by all samples
_TABLES = 64  # weights whose scores are kept for all draws
_OFTEN = 1_000  # shingles of a weight from which such a table is worth its making
BLOCK = 2_000  # nodes of a bucket compared at once
CHUNK = 8 << 20  # bytes of texts sampled together
PART = 12 << 20  # bytes of texts per part of the space of shingles, some 2 million shingles


@dataclass(frozen=True)
class NearDup:
    """A pair at the similarity limit shares a band with probability 1 - (1 - s**rows)**bands,
    0.9998 for the values here. There are as many bands of weighted samples as of plain ones."""

    words: int = 5
    similarity: float = 0.8
    bands: int = 12
    rows: int = 3
    #: Least share of equal samples for a block comparison to go on to the texts; a pair at the
    #: limit falls below with a probability of about one in ten thousand.
    agreement: float = 0.55

    @property
    def samples(self) -> int:
        return self.bands * self.rows


class Sampler:
    """Improved consistent weighted sampling (Ioffe 2010) with draws taken from a pool."""

    def __init__(self, samples: int):
        rng = np.random.Generator(np.random.PCG64(20_101_214))
        size = 1 << _POOL_BITS
        self._r, self._c = rng.gamma(2.0, 1.0, size), np.log(rng.gamma(2.0, 1.0, size))
        self._beta = rng.random(size)
        self._odd = rng.integers(0, 1 << 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

        self._tables: dict[float, np.ndarray] = {}
        self._uses: dict[float, int] = {}

    def _drawn(self, at: np.ndarray, log_s: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
        """Score and quantised weight of a weight at these draws."""
        r, beta = self._r[at], self._beta[at]
        t = np.floor(log_s / r + beta)
        return self._c[at] - r * (t - beta) - r, t

    def _table(self, weight: float, n: int) -> np.ndarray | None:
        """Scores of all draws of a weight that ``n`` more shingles have, if it is used often."""
        if (table := self._tables.get(weight)) is None:
            if len(self._uses) >= 100_000:
                self._uses.clear()
            self._uses[weight] = uses = self._uses.get(weight, 0) + n
            if uses < _OFTEN:
                return None
            if len(self._tables) >= _TABLES:
                self._tables.clear()
                self._uses.clear()
            table = self._tables[weight] = self._drawn(np.arange(len(self._r)), np.log(weight))[0].astype(np.float32)
        return table

    def __call__(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One 32-bit sample per function: the chosen shingle and its quantised weight."""
        return self.both(hashes, weights)[1]

    def both(self, hashes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Plain and weighted samples, one of 32 bits each per function.

        The plain sample of a set of shingles, all alike, is the least product of a hash and the
        function's odd factor; an odd factor keeps the low bits of different hashes apart. The upper
        bits of the same products are the draws of the weighted sample.
        """
        order = np.argsort(weights, kind="stable")
        hashes, weights = hashes[order], weights[order]
        log_s, n = np.log(weights), len(hashes)
        starts = [0, *(np.flatnonzero(weights[1:] != weights[:-1]) + 1).tolist()]
        # Frequent weights take their scores from a table, the others are worked out together.
        parts: list[tuple[np.ndarray | slice, np.ndarray | None]] = []
        rare = []
        for lo, hi in zip(starts, [*starts[1:], n]):
            table = self._table(weights[lo], hi - lo) if hi - lo >= 8 else None
            if table is None:
                rare.append(np.arange(lo, hi))
            else:
                parts.append((slice(lo, hi), table))
        if rare:
            parts.append((np.concatenate(rare), None))
        plain, weighted = np.empty(len(self._odd), np.uint64), np.empty(len(self._odd), np.uint32)
        step = max(1, 100_000 // n)
        for begin in range(0, len(plain), step):
            odd = self._odd[begin : begin + step, None]
            rows, least, best, k = np.arange(len(odd)), None, None, None
            for some, table in parts:
                with np.errstate(over="ignore"):
                    product = (hashes[some] * odd).astype("<u8", copy=False)
                at = product.view("<u2")[:, 3::4].astype(np.int64)  # the upper _POOL_BITS; a shift takes longer
                score = table.take(at) if table is not None else self._drawn(at, log_s[some])[0].astype(np.float32)
                own, low = np.argmin(score, axis=1), product.min(axis=1)
                score = score[rows, own]
                own = own + some.start if table is not None else some[own]
                if least is None:
                    least, best, k = low, score, own
                else:  # of equal scores the first in the order of weights
                    better = (score < best) | ((score == best) & (own < k))
                    least, best, k = np.minimum(least, low), np.where(better, score, best), np.where(better, own, k)
            with np.errstate(over="ignore"):
                at = (hashes[k] * odd[:, 0] >> np.uint64(64 - _POOL_BITS)).astype(np.int64)
                t = self._drawn(at, log_s[k])[1]
                mark = hashes[k] ^ (t.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            plain[begin : begin + step], weighted[begin : begin + step] = least, (mark >> np.uint64(32)).astype(np.uint32)
        return plain.astype(np.uint32), weighted


class Vector:
    """A text's distinct shingles, ascending, and their TF-IDF weights.

    ``counts`` holds the number of nodes that have each shingle (32-bit), or nothing if no other
    node has any of them.
    """

    def __init__(self, hashes: np.ndarray, times: np.ndarray, counts: bytes, nodes: int):
        self.hashes = hashes
        df = np.frombuffer(counts, np.uint32) if counts else np.ones(len(hashes))
        self.weights = times * (1 + np.log((nodes + 1) / (df + 1)))


def alike(a: Vector, b: Vector, limit: float) -> bool:
    """Whether the plain or the weighted similarity reaches the limit."""
    _, i, j = np.intersect1d(a.hashes, b.hashes, assume_unique=True, return_indices=True)
    if len(i) >= limit * (len(a.hashes) + len(b.hashes) - len(i)):
        return True
    least = np.minimum(a.weights[i], b.weights[j]).sum()
    return bool(least >= limit * (a.weights.sum() + b.weights.sum() - least))


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two (ascending hashes, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = np.minimum(a[1][i], b[1][j]).sum()
    most = a[1].sum() + b[1].sum() - least
    return float(least / most) if most else 0.0


def _digests(docs: DataFrame) -> DataFrame:
    """Per row a digest of its words (NULL without words) and the size of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests: list[bytes | None] = []
            sizes: list[int] = []
            for text in batch["text"].cast(pa.binary()).to_pylist():
                words = text.split()
                digests.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None)
                sizes.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["__h"], pa.array(digests, pa.binary()), pa.array(sizes, pa.int64())], ["doc_id", "__h", "digest", "size"]
            )
        give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("__h"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, __h long, digest binary, size long")


def _signed(texts: DataFrame, frequent: DataFrame, nodes: int, config: NearDup) -> DataFrame:
    """Per node its plain and its weighted samples, and the counts of its shingles.

    ``frequent`` holds, per chunk of texts, the shingles that several nodes have, with the counts.
    """

    def run(key: tuple, rows: pa.Table, found: pa.Table) -> pa.Table:
        sample = Sampler(config.samples)
        hashes = np.frombuffer(b"".join(found["hashes"].to_pylist()), np.uint64)
        order = np.argsort(hashes)
        hashes, times = hashes[order], np.frombuffer(b"".join(found["counts"].to_pylist()), np.uint32)[order]
        marks, counts = [], []
        for words in (w for part in rows["text"].chunks for w in hashed_words(part)):
            own, tf = shingles(words, config.words)
            df = np.ones(len(own), np.uint32)
            if len(hashes):
                at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                df = np.where(hashes[at] == own, times[at], df).astype(np.uint32)
            counts.append(df.tobytes() if (df > 1).any() else b"")
            vector = Vector(own, tf, counts[-1], nodes)
            marks.append(b"".join(x.tobytes() for x in sample.both(own, vector.weights)))
        give_back()
        return pa.table({"rep": rows["rep"], "digest": rows["digest"], "samples": pa.array(marks, pa.binary()), "counts": pa.array(counts, pa.binary())})

    both = texts.select("chunk", "rep", "digest", F.col("text").cast("binary").alias("text")).groupBy("chunk").cogroup(frequent.groupBy("chunk"))
    return both.applyInArrow(run, "rep long, digest binary, samples binary, counts binary")


def _verified(pairs: DataFrame, texts: DataFrame, nodes: int, config: NearDup) -> DataFrame:
    """Pairs (a, b) whose texts reach the similarity of their shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        last: tuple[bytes, Vector] | None = None

        def vector(text: bytes, counts: bytes) -> Vector:
            return Vector(*shingles(known.of(text.split()), config.words), counts, nodes)

        for batch in batches:
            ok = []
            x, y = (batch[c].cast(pa.binary()).to_pylist() for c in ("x", "y"))
            for s, t, m, n in zip(x, y, batch["m"].to_pylist(), batch["n"].to_pylist(), strict=True):
                if last is None or last[0] != s:
                    last = (s, vector(s, m))
                ok.append(alike(last[1], vector(t, n), config.similarity))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
        known, last = None, None
        give_back()

    x = texts.select(F.col("node").alias("a"), F.col("text").alias("x"), F.col("counts").alias("m"))
    y = texts.select(F.col("node").alias("b"), F.col("text").alias("y"), F.col("counts").alias("n"))
    kind = pairs.schema["a"].dataType.simpleString()
    return pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y", "m", "n").mapInArrow(run, f"a {kind}, b {kind}")


def _hub_pairs(buckets: DataFrame, labels: DataFrame | None, hub: Column) -> DataFrame:
    """Each node of a bucket with the bucket's hub, unless one class has both."""
    hubs = buckets.groupBy("band", "key").agg(hub.alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    pairs = buckets.join(hubs, ["band", "key"]).filter("node != hub")
    pairs = pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    if labels is None:
        return pairs
    left, right = labels.select(F.col("node").alias("a"), F.col("label").alias("la")), labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    return pairs.join(left, "a", "left").join(right, "b", "left").filter(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b")


def _block_links(buckets: DataFrame, texts: DataFrame, labels: DataFrame, nodes: int, config: NearDup) -> DataFrame:
    """Links between different classes in a bucket, block by block.

    Pairs whose samples agree well enough are compared on their texts at once, unless the links
    found before them in the block have joined their classes. So a block gives fewer links than it
    has classes, however many pairs of it are alike. A pair that agrees in several bands is compared
    in the first of them only: it lies in one bucket there, too.
    """
    placed = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = (
        placed.groupBy("band", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
        .filter("n > 2 and low != high")  # of two nodes one was the hub
        .select("band", "key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    members = placed.join(mixed, ["band", "key"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    members = members.join(texts.select("node", "samples"), "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select(
        "band", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "samples",
        F.col("node.rep").alias("rep"), F.col("node.digest").alias("digest"), F.xxhash64("label").alias("label"),
    )
    least = int(np.ceil(config.agreement * config.samples))

    def met(same: np.ndarray) -> np.ndarray:
        """Whether a pair shares one of the bands whose samples are compared here."""
        return same.reshape(len(same), same.shape[1] // config.rows, config.rows).all(axis=2).any(axis=1)

    def compared(group: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Each node of the left block, the nodes of the right one that agree with it, and the labels."""
        marks = np.frombuffer(b"".join(group["samples"]), np.uint32).reshape(len(group), 2, -1)  # plain and weighted
        band = int(group["band"].iloc[0])
        own = marks[:, band // config.bands]  # the samples that the band is made of
        block, i, j = group["block"].to_numpy(), int(group["i"].iloc[0]), int(group["j"].iloc[0])
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        by_sample = np.ascontiguousarray(own[right].T)  # counted sample by sample, along the nodes
        _, label = np.unique(group["label"].to_numpy(), return_inverse=True)  # joined classes get one label
        for n, x in enumerate(left):
            lo = n + 1 if i == j else 0
            other = np.flatnonzero(label[right[lo:]] != label[x]) + lo
            if 4 * len(other) < len(right) - lo:
                enough = (own[right[other]] == own[x]).sum(axis=1) >= least
            else:
                agree = np.add.reduce(by_sample[:, lo:] == own[x][:, None], axis=0, dtype=np.uint16)
                enough = agree[other - lo] >= least
            near = right[other[enough]]
            if len(near):
                same = own[near] == own[x]
                before = met(same[:, : band % config.bands * config.rows])
                if band >= config.bands:
                    plain = marks[near, 0] == marks[x, 0]
                    before |= met(plain) & (plain.sum(axis=1) >= least)
                near = near[~before]
            yield x, near, label

    def agreeing(group: pd.DataFrame) -> pd.DataFrame:
        seen = np.zeros(len(group), bool)
        for x, near, _ in compared(group):
            seen[near] = True
            seen[x] |= len(near) > 0
        return group[seen]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        rep, digest, text, counts = group["rep"].to_numpy(dtype=object), group["digest"].to_numpy(), group["text"].to_numpy(), group["counts"].to_numpy()
        known, vectors = WordHashes(), {}

        def vector(k: int) -> Vector:
            if k not in vectors:
                vectors[k] = Vector(*shingles(known.of(text[k].split()), config.words), counts[k], nodes)
            return vectors[k]

        out = []
        for x, near, label in compared(group):
            for y in near:
                if label[x] != label[y] and alike(vector(x), vector(y), config.similarity):
                    out.append((rep[x], digest[x], rep[y], digest[y]))
                    label[label == label[y]] = label[x]
        if len(vectors) > 500:  # after a large group; most are a few texts
            known, vectors = None, None
            give_back()
        return pd.DataFrame(out, columns=["ra", "da", "rb", "db"])

    # Texts move only for nodes that agree with one of another class.
    members = shared_table(members.groupBy("band", "key", "i", "j").applyInPandas(agreeing, members.schema), "agreeing")
    members = members.join(texts.select(F.col("node.digest").alias("digest"), "counts", F.col("text").cast("binary").alias("text")), "digest")
    found = members.groupBy("band", "key", "i", "j").applyInPandas(run, "ra long, da binary, rb long, db binary")
    node = lambda r, d: F.struct(F.col(r).alias("rep"), F.col(d).alias("digest"))
    return found.distinct().select(F.least(node("ra", "da"), node("rb", "db")).alias("a"), F.greatest(node("ra", "da"), node("rb", "db")).alias("b"))


def near_duplicates(docs: DataFrame, config: NearDup | None = None) -> DataFrame:
    """Per row: ``doc_id``, ``__h`` (hash of the text), ``class_id``, ``first``, ``similar``.

    ``class_id`` is the smallest ``doc_id`` of the class; ``first`` marks the row that stands for
    it (rows that repeat id and text are marked alike); ``similar`` tells classes with more than
    one text. A text without words (NULL, empty, white space) is like no other and is a class of
    its own. Texts with the same words are copies, however many there are. White space does not
    count, case does. An empty table gives no rows; other columns are not read.
    """
    config, spark = config or NearDup(), docs.sparkSession
    signed = shared_table(_digests(docs), "digests")

    some = signed.filter("digest is not null")
    # Id and text hash of one row, ids before NULL: the row that ``texts`` looks for below.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__h"))
    nodes = some.groupBy("digest").agg(least.alias("least"), F.max("size").alias("size"))
    nodes = shared_table(nodes.select(F.col("least.doc_id").alias("rep"), "digest", F.col("least.__h").alias("__wh"), "size"), "nodes")
    sizes = nodes.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    total, size = sizes["n"], sizes["bytes"] or 0

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("__h"), text_or_empty().alias("text"))
    texts = lookup(rows, nodes, "__h", "__wh", ["rep", "digest"], how="inner", right_bytes=64 * total)
    texts = texts.filter(F.col("doc_id").eqNullSafe(F.col("rep"))).select("rep", "digest", "text")
    # Rows that lie together are one chunk. The numbers are kept with the rows.
    together = 1 << max(0, int(np.log2(max(1.0, CHUNK / max(1.0, size / max(1, total))))))
    chunk = F.shiftright(F.monotonically_increasing_id(), int(np.log2(together)))
    texts = shared_table(texts.withColumn("chunk", chunk), "texts")
    if texts.count() > total:  # rows that repeat an id and a text
        texts = shared_table(texts.groupBy("digest").agg(F.first(F.struct("rep", "text", "chunk")).alias("x")).select("x.rep", "digest", "x.text", "x.chunk"), "texts")
    if (lost := total - texts.count()) != 0:
        raise RuntimeError(f"{lost} nodes have no text")
    parts = 1 << int(np.ceil(np.log2(max(1.0, size / PART))))
    frequent = shared_table(document_frequencies(texts, config.words, parts), "frequent")
    release(spark, pause=0.5)  # the shuffles of all shingles and of all texts do not lie on disk together
    sampled = shared_table(_signed(texts, frequent, total, config), "samples")
    drop_table(frequent)
    release(spark, pause=0.5)

    own = F.struct("rep", "digest")
    width = 4 * config.rows
    keys = [F.struct(F.lit(k).alias("band"), F.xxhash64(F.substring("samples", k * width + 1, width)).alias("key")) for k in range(2 * config.bands)]
    banded = sampled.select(own.alias("node"), F.explode(F.array(*keys)).alias("x")).select("node", "x.band", "x.key")
    # Keys that one node alone has are most of them; they are counted away before the nodes move.
    crowded = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    buckets = shared_table(banded.join(crowded, ["band", "key"]), "buckets")
    wanted = shared_table(buckets.select(F.col("node.digest").alias("__wanted")).distinct(), "wanted")
    n = wanted.count()
    found, signs = (lookup(t, wanted, "digest", "__wanted", [], how="inner", right_bytes=64 * n) for t in (texts, sampled.drop("rep")))
    wanted_texts = shared_table(found.join(signs, "digest").select(own.alias("node"), "text", "samples", "counts"), "wanted-texts")
    drop_table(texts)
    drop_table(sampled)
    texts = wanted_texts

    links, labels, tried = None, None, None
    hubs = [F.min("node"), F.max("node"), F.min_by("node", F.xxhash64("node"))]
    for step in [*hubs, None]:
        if step is None:
            if labels is None:
                break
            found = shared_table(_block_links(buckets, texts, labels, total, config), "links")
        else:
            pairs = _hub_pairs(buckets, labels, step)
            if tried is not None:
                pairs = pairs.join(tried, ["a", "b"], "left_anti")
            pairs = shared_table(pairs, "pairs")
            tried = pairs if tried is None else tried.union(pairs)
            found = shared_table(_verified(pairs, texts, total, config), "links")
        if links is not None and found.isEmpty():
            continue
        links = found if links is None else links.union(found)
        labels = shared_table(components(links), "labels")

    nodes_labelled = nodes.select("digest", "rep").withColumn("node", own).join(labels, "node", "left").select("digest", F.col("label.rep").alias("class_rep"), F.col("label").isNotNull().alias("similar"), F.coalesce(F.col("label") == F.col("node"), F.lit(True)).alias("leads"), "rep")
    classes = shared_table(nodes_labelled, "classes")
    drop_table(texts)
    out = signed.select("doc_id", "__h", "digest").join(classes, "digest", "left")
    release(spark)
    return out.select(
        "doc_id", "__h",
        F.when(F.col("digest").isNull(), F.col("doc_id")).when(F.col("similar"), F.col("class_rep")).otherwise(F.col("rep")).alias("class_id"),
        (F.col("digest").isNull() | (F.col("leads") & F.col("doc_id").eqNullSafe(F.col("rep")))).alias("first"),
        F.coalesce("similar", F.lit(False)).alias("similar"),
    )


def keep_one(docs: DataFrame, config: NearDup | None = None) -> DataFrame:
    """The documents with one row of each class: the one with the smallest id.

    Rows that repeat an id and a text stay once; texts without words all stay.
    """
    classes = near_duplicates(docs, config).filter("first")
    once = classes.groupBy(F.col("doc_id").alias("__id2"), F.col("__h").alias("__h2")).agg(F.count(F.lit(1)).alias("__times"))
    once = shared_table(once, "firsts")
    rows = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__h": F.xxhash64(text_or_empty())})
    kept = rows.join(once, (F.col("__h") == F.col("__h2")) & F.col("__id").eqNullSafe(F.col("__id2")))
    if not once.filter("__times > 1").isEmpty():  # else there are no repeated rows to tell apart
        empty = F.btrim(text_or_empty(), F.lit(" \t\n\x0b\x0c\r")) == ""
        alone = kept.filter(~empty).dropDuplicates(["__id", "__h"])
        kept = kept.filter(empty).unionByName(alone)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
