"""Prefix trie of conversations, by truncation peeling.

A conversation is a path of turns, each a 128-bit digest of role and text chained to those before it,
so that one value names a whole prefix. Peeling starts at the greatest depth: conversations that end
there are merged with the nodes that survived from below, each merged node is complete, its last turn
is stripped, and what is left is grouped again one level up. A node is found and summed in one step.

Two things keep the number of rounds and the rows of a round small. Equal conversations become one
entry with a count first. And an entry that is alone from some depth on (no other sequence shares that
prefix) has a tail without branches, whose nodes follow from the entry itself: the tail is peeled in
one step and the entry takes part from that depth on. A round is needed for each depth that two
different sequences share (twice that at most), not for each turn of the longest conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import lookup
from .common import shared_table, text_or_empty

#: Ids of one block of a node's members, which are joined to one text before the node's hash is taken.
ID_BLOCK = 1024
_CHAINED = "conv_id long, key binary, path array<binary>, upto array<long>"
_ENDED = "conv_id long, n long, ends string, path array<binary>, upto array<long>"
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def ordered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``steps``, its turns in order, each as digest and number of code points.

    Turns are ordered by ``turn`` (NULL first), then by role and text; NULL role or text is empty.
    Rows without a ``conv_id`` belong to no conversation. Rows are dealt out by ranges of conversation
    and turn, so one with very many turns is sorted in several tasks; only digests are gathered.
    """
    parts = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", text_or_empty("role").alias("role"), text_or_empty().alias("text")
    )
    sorted_parts = parts.repartitionByRange("conv_id", F.col("turn").asc_nulls_first()).sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text"
    )
    # Ranges are in order, and so are the ids: they place a turn among those of other tasks.
    steps = sorted_parts.select(
        "conv_id",
        F.monotonically_increasing_id().alias("at"),
        F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))).alias("digest"),
        F.length("text").cast("long").alias("chars"),
    )
    gathered = steps.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "digest", "chars"))).alias("steps"))
    return gathered.select("conv_id", F.transform("steps", lambda s: F.struct(s["digest"].alias("digest"), s["chars"].alias("chars"))).alias("steps"))


def with_shared_heads(conversations: DataFrame, group: int, most: int) -> DataFrame:
    """Each conversation with its first turns replaced by those of its group's first conversation.

    The group of ``c`` starts at ``c - c % group``; the number of turns taken from there, and left out
    of its own, is the unsigned crc32 of the decimal id modulo ``most + 1``.
    """
    c = F.col("conv_id")
    heads = conversations.filter(c % group == 0).select(c.alias("__base"), F.slice("steps", 1, most).alias("__head"))
    h = (F.crc32(c.cast("string").cast("binary")) % (most + 1)).cast("int")
    both = conversations.withColumn("__base", c - c % group).withColumn("__h", h).join(heads, "__base", "left")
    none = F.slice("steps", 1, 0)
    head = F.slice(F.coalesce("__head", none), F.lit(1), F.col("__h"))
    own = F.slice("steps", F.col("__h") + 1, F.size("steps") + 1)
    return both.select("conv_id", F.concat(head, own).alias("steps"))


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each prefix of a conversation, and the code points up to each turn."""
    for batch in batches:
        steps = batch.column("steps")
        keys, paths, sums = [], [], []
        for row in steps:
            path, upto, key, total = [], [], b"", 0
            for digest, chars in zip(row.values.field("digest").to_pylist(), row.values.field("chars").to_pylist()):
                key = hashlib.blake2b(key + digest, digest_size=16).digest()
                total += chars
                path.append(key)
                upto.append(total)
            keys.append(key)
            paths.append(path)
            sums.append(upto)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(keys, pa.binary()), pa.array(paths, pa.list_(pa.binary())), pa.array(sums, pa.list_(pa.int64()))],
            ["conv_id", "key", "path", "upto"],
        )


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per sequence, from blocks of its members in ascending order; only a hash is kept."""
    key, entry, digest = None, None, None
    out: list[tuple] = []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.binary()), pa.list_(pa.int64())]
        columns = zip(*rows) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv_id", "n", "ends", "path", "upto"])

    for batch in batches:
        for row in batch.to_pylist():
            if row["key"] != key:
                if entry is not None:
                    out.append((*entry[:2], digest.hexdigest(), *entry[2:]))
                key, digest = row["key"], hashlib.sha256()
                entry = [row["conv_id"], 0, row["path"], row["upto"]]
            else:
                digest.update(b",")
            entry[1] += row["n"]
            digest.update(row["ids"].encode())
        yield batch_of(out)
        out = []
    if entry is not None:
        yield batch_of([(*entry[:2], digest.hexdigest(), *entry[2:])])


def sequences(conversations: DataFrame) -> DataFrame:
    """Distinct sequences: smallest member, number of members, hash of their ids, path.

    Members are gathered by blocks of ``ID_BLOCK`` consecutive ids, so the rows of a sequence that a
    third of all conversations have are few when they meet, and they pass one after the other.
    """
    chained = conversations.mapInArrow(_chain, _CHAINED)
    blocks = chained.groupBy("key", F.floor(F.col("conv_id") / ID_BLOCK).alias("block")).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n"),
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"),
        F.first("path").alias("path"),
        F.first("upto").alias("upto"),
    )
    return blocks.repartition("key").sortWithinPartitions("key", "block").mapInArrow(_ended, _ENDED)


def _with_cut(ended: DataFrame) -> DataFrame:
    """The depth from which each sequence is alone, or its length: of depths 1, 2, 4 and so on."""
    depth = F.size("path")
    powers = F.filter(F.array(*[F.lit(1 << i) for i in range(30)]), lambda d: d <= depth)
    probes = ended.select("conv_id", F.explode(powers).alias("d"), "path").select("conv_id", "d", F.element_at("path", F.col("d")).alias("key"))
    alone = probes.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("conv_id").alias("conv_id"), F.min("d").alias("d")).filter("c = 1")
    cuts = alone.groupBy("conv_id").agg(F.min("d").alias("cut"))
    return ended.join(cuts, "conv_id", "left").withColumn("cut", F.coalesce("cut", depth))


def _at(array: str, depth: Column | int) -> Column:
    """Code points up to a depth; none up to depth 0."""
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.coalesce(F.get(array, depth - 1), F.lit(0).cast("long"))


def _tails(entries: DataFrame) -> DataFrame:
    """Nodes below the depth from which their sequence is alone."""
    depth, d = F.size("upto"), F.col("depth")
    below = entries.filter(F.col("cut") < depth).withColumn("depth", F.explode(F.sequence(F.col("cut") + 1, depth)))
    last = d == depth
    return below.select(
        "conv_id",
        "depth",
        F.col("conv_id").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(last, 0).otherwise(1).alias("n_children"),
        F.lit(1).alias("n_leaves"),
        ((F.col("n") - 1) * (_at("upto", depth) - _at("upto", d - 1))).alias("saved"),
        F.when(last, F.col("ends")).alias("ends"),
    )


def _entering(entries: DataFrame, depth: int) -> DataFrame:
    """Entries that take part from a depth on: they end there, or have their tail below."""
    size = F.size("upto")
    more = (size > depth).cast("long")
    return entries.filter(F.col("cut") == depth).select(
        "conv_id",
        F.col("n").alias("n_convs"),
        more.alias("n_children"),
        more.alias("n_leaves"),
        ((F.col("n") - 1) * (_at("upto", size) - _at("upto", depth))).alias("saved"),
        F.when(size == depth, F.col("ends")).alias("ends"),
        F.slice("path", 1, depth).alias("path"),
        F.slice("upto", 1, depth).alias("upto"),
    )


def _stripped(level: DataFrame, depth: int) -> DataFrame:
    """Complete nodes of the level below as parts of their parents at ``depth``."""
    return level.select(
        "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved", F.lit(None).cast("string").alias("ends"),
        F.slice("path", 1, depth).alias("path"), F.slice("upto", 1, depth).alias("upto"),
    )


def _root_key() -> Column:
    return F.lit("").cast("binary")


def _merged(parts: DataFrame, depth: int) -> DataFrame:
    """Parts with one prefix become its node."""
    grouped = parts.withColumn("key", F.element_at("path", depth) if depth else _root_key()).groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        F.max("ends").alias("ends"),
        F.first("path").alias("path"),
        F.first("upto").alias("upto"),
    )
    last_text = _at("upto", depth) - _at("upto", depth - 1)
    return grouped.withColumn("n_leaves", F.greatest("n_leaves", F.lit(1))).withColumn(
        "saved", F.col("saved") + (F.col("n_convs") - 1) * last_text
    )


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of ``conversations`` (``conv_id``, ``steps``).

    ``conv_id`` (smallest member) and ``depth`` name a node. A conversation without turns is a member
    of the root; without conversations there is no node. A node's ``ends`` is the hash of the ids that
    end there. Equal conversations, ties and very long texts or conversations need nothing special:
    a text counts with its length and digest alone.
    """
    ended = shared_table(sequences(conversations), "sequences")
    entries = shared_table(_with_cut(ended), "entries", partition_by="cut")
    deepest = entries.agg(F.max("cut")).first()[0]
    if deepest is None:
        deepest = 0
    levels, survivors = [], None
    for depth in range(deepest, -1, -1):
        here = _entering(entries, depth)
        parts = here if survivors is None else here.unionByName(_stripped(survivors, depth))
        survivors = shared_table(_merged(parts, depth), f"level-{depth}")
        parent = F.coalesce(F.get("path", F.lit(depth - 2)), _root_key()) if depth else F.lit(None).cast("binary")
        levels.append(survivors.select(
            "conv_id", F.lit(depth).alias("depth"), "n_convs", "n_children", "n_leaves", "saved", "ends", "key", parent.alias("parent")
        ))
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    # A key names its depth too: prefixes of different length have different digests.
    parents = nodes.filter("n_children > 0").select("key", F.col("conv_id").alias("parent_conv_id"))
    placed = lookup(nodes, parents, "parent", "key", ["parent_conv_id"])
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    return placed.select(*columns).unionByName(_tails(entries).select(*columns)).select(
        "conv_id",
        *[F.col(c).cast("long").alias(c) for c in ("depth", "parent_conv_id", "n_convs", "n_children", "n_leaves")],
        F.col("saved").cast("long").alias("saved_tokens"),
        F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256"),
    )


def rebuilt_trie(turns: DataFrame, group: int = 100, most: int = 5) -> DataFrame:
    """The trie of the conversations of a table of turns, rebuilt with their group's shared heads.

    Columns other than ``conv_id``, ``turn``, ``role`` and ``text`` are not read.
    """
    own = shared_table(ordered_turns(turns), "turns")
    return trie(with_shared_heads(own, group, most))
