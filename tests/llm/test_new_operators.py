"""Prefix trie, resharding and spelling variants against brute force on small tables."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import prefix_trie, resharding, spelling
from millrace.llm.queries import QUERIES
from millrace.storage import work_folder

TURNS = "conv_id long, turn long, role string, text string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# -- prefix trie ---------------------------------------------------------------------------------------


def brute_trie(rows) -> list[tuple]:
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [(r.decode(), t.decode()) for *_, r, t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - c % 100, [])[:h] + v[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, v in rebuilt.items():
        ends[v].append(c)
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = sum(saved[k] for k in children[node]) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    return sorted(
        (
            min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(children[n]), leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest(),
        )
        for n in members
    )


def trie_rows(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in df.select(*columns).collect())


def conversation_rows() -> list[tuple]:
    """Shared heads, copies, long and short ones, ties, NULLs, repeated rows, ids without a base."""
    rng = np.random.default_rng(5)
    rows = []
    for c in [*range(0, 230), *range(1_000_050, 1_000_060), 70_000]:
        n = int(rng.integers(1, 9))
        rows += [(c, t, "user" if t % 2 else "bot", f"t{rng.integers(0, 3)}é") for t in range(n)]
    for c in range(300, 340):  # copies
        rows += [(c, t, "user", f"same {t}") for t in range(7)]
    rows += [(400, t, "user", f"long {t}") for t in range(24)]
    rows += [(401, t, "user", f"long {t}") for t in range(24)]
    rows += [(402, t, "user", f"long {t}") for t in range(14)]
    rows += [(500, None, None, "first"), (500, 0, "", None), (500, 0, "b", "x"), (500, 0, "a", "y"), (500, 0, "a", "y")]
    rows += [(None, 0, "user", "nobody's"), (600, 3, "user", "z" * 100_000), (601, -4, "user", "🙂")]
    return rows


def test_trie_equals_brute_force(spark):
    rows = conversation_rows()
    df = spark.createDataFrame(rows, TURNS).withColumn("key", F.lit("x")).withColumn("depth", F.lit(1)).repartition(5)
    assert trie_rows(prefix_trie.rebuilt_trie(df)) == brute_trie(rows)


def test_trie_without_conversations(spark):
    assert prefix_trie.rebuilt_trie(spark.createDataFrame([], TURNS)).collect() == []
    assert prefix_trie.rebuilt_trie(spark.createDataFrame([(None, 0, "user", "x")], TURNS)).collect() == []


def test_trie_of_turnless_conversations(spark):
    gone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(gone, 0, "user", "lost, as there is no head to take its place")]
    assert trie_rows(prefix_trie.rebuilt_trie(spark.createDataFrame(rows, TURNS))) == brute_trie(rows)


def test_trie_of_many_equal_conversations(spark):
    """Members of more than one block of ids are hashed in order."""
    n = 2 * prefix_trie.ID_BLOCK + 5
    rows = [(c, t, "user", f"same {t}") for c in range(n) for t in range(3)]
    assert trie_rows(prefix_trie.rebuilt_trie(spark.createDataFrame(rows, TURNS))) == brute_trie(rows)


def test_a_long_conversation_takes_few_rounds(spark, monkeypatch):
    names = []
    real = prefix_trie.shared_table
    monkeypatch.setattr(prefix_trie, "shared_table", lambda df, name, **more: names.append(name) or real(df, name, **more))
    rows = [(1, t, "user", f"a{t}") for t in range(500)] + [(2, t, "user", f"b{t}") for t in range(500)]
    found = prefix_trie.rebuilt_trie(spark.createDataFrame(rows, TURNS))
    assert trie_rows(found) == brute_trie(rows)
    assert sum(n.startswith("level-") for n in names) <= 3


def test_registered_trie_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert trie_rows(QUERIES["op11_prefix_trie"](spark, "/root/testdata/sf0.001")) == brute_trie(rows)


# -- resharding ----------------------------------------------------------------------------------------


def cheapest(old, capacity, cost) -> int:
    """Least cost over all ways to send single units, by trying every order of the units."""
    units = [i for i in old for _ in range(old[i])]
    rooms = [j for j in capacity for _ in range(capacity[j])]
    return min(sum(cost(i, j) for i, j in zip(units, order)) for order in itertools.permutations(rooms))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=3), st.lists(st.integers(0, 9), min_size=16, max_size=16), st.integers(0, 10_000))
def test_transfers_cost_least(sizes, prices, seed):
    old = dict(enumerate(sizes))
    total = min(sum(sizes), 6)
    old = {i: min(n, 2) for i, n in old.items()}
    total = sum(old.values())
    rng = np.random.default_rng(seed)
    capacity = dict(enumerate(np.bincount(rng.integers(0, 4, total), minlength=4).tolist()))
    cost = lambda i, j: prices[4 * i + j]
    moves = resharding.transfers(old, capacity, cost)
    assert all(sum(n for (i, _), n in moves.items() if i == k) == old[k] for k in old)
    assert all(sum(n for (_, j), n in moves.items() if j == k) == capacity[k] for k in capacity)
    assert sum(n * cost(*p) for p, n in moves.items()) == cheapest(old, capacity, cost)


def test_the_fewest_bytes_move():
    old, capacity = {0: 700, 1: 100, 2: 400}, {0: 300, 1: 300, 2: 300, 3: 300}
    moves = resharding.transfers(old, capacity)
    assert sum(n for (i, j), n in moves.items() if i != j) == sum(max(0, old[i] - capacity[i]) for i in old)
    with pytest.raises(ValueError):
        resharding.transfers({0: 1}, {0: 2})


def shard_docs() -> list[tuple]:
    rng = np.random.default_rng(9)
    rows = [(i, "é" * int(rng.integers(0, 300)), "en", "s", 1) for i in range(3_000)]
    rows += [(5_000, "copy", "en", "s", 1)] * 1_500  # one key with a third of the rows
    return rows + [(None, "no id", "en", "s", 1)] * 40 + [(6_000, None, None, None, None), (6_001, "", "en", "s", 0), (6_002, "x" * 20_000, "en", "s", 1)]


def test_shards_are_even_and_whole(spark):
    rows = shard_docs()
    df = spark.createDataFrame(rows, DOCS).withColumn("shard", F.lit("mine")).withColumn("slot", F.lit(-1)).withColumn("key", F.lit(0))
    found = resharding.grow(df, 6, 8, resharding.Blocks(bytes=20_000)).collect()
    assert Counter((r["__row"]["doc_id"], r["__row"]["text"]) for r in found) == Counter((r[0], r[1]) for r in rows)
    assert all(r["__row"]["shard"] == "mine" and r["__row"]["slot"] == -1 for r in found)
    sizes, slots = Counter(), defaultdict(list)
    for r in found:
        assert r["__size"] == len((r["__row"]["text"] or "").encode()) + 1
        sizes[r["shard"]] += r["__size"]
        slots[r["shard"]].append(r["slot"])
    assert set(sizes) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) <= 50


def test_only_affected_rows_are_written(spark):
    rows = spark.createDataFrame([(i, "x" * (i % 97), "en", "s", 1) for i in range(6_000)], DOCS)
    old = resharding.write_sharded(rows, F.pmod(F.xxhash64("doc_id"), F.lit(6)), resharding.text_size(), resharding.Blocks(bytes=4_000))
    held = {r["__shard"]: r["n"] for r in old.blocks.groupBy("__shard").agg(F.sum("bytes").alias("n")).collect()}
    capacity = resharding.even(sum(held.values()), range(8))
    found = resharding.reshard(old, capacity)
    r = found.agg(F.sum(F.when(F.col("moved"), F.col("__size"))).alias("n"), F.count(F.lit(1)).alias("rows")).first()
    least = sum(max(0, held[i] - capacity[i]) for i in held)
    blocks_on_borders = 2 * 8 * 6_000
    assert r["rows"] == 6_000 and least <= r["n"] <= least + blocks_on_borders
    again = resharding.reshard(old, held).filter("moved").count()
    assert again == 0  # the same sizes: nothing moves


def test_fewer_shards(spark):
    rows = spark.createDataFrame([(i, "abc" * (i % 7), "en", "s", 1) for i in range(500)], DOCS)
    found = resharding.grow(rows, 5, 2).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max("slot").alias("m"), F.sum("__size").alias("s")).collect()
    assert {r["shard"] for r in found} == {0, 1} and all(r["m"] == r["n"] - 1 for r in found)
    assert abs(found[0]["s"] - found[1]["s"]) <= 2


def test_no_rows_no_shards(spark):
    assert resharding.grow(spark.createDataFrame([], DOCS), 6, 8).collect() == []


def test_registered_resharding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    found = QUERIES["op12_resharding"](spark, "/root/testdata/sf0.001").collect()
    want = Counter((d["doc_id"], len((d["text"] or "").encode()) + 1, zlib.crc32((d["text"] or "").encode())) for d in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == want
    sizes = Counter()
    for r in found:
        sizes[r["shard"]] += r["size"]
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= max(d["n_chars"] for d in docs)


# -- spelling variants ---------------------------------------------------------------------------------


def brute_words(rows) -> Counter:
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 97 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            n[low] += 1
    return Counter({w: k for w, k in n.items() if len(w) >= 5 and k >= 3})


def brute_near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(n) -> set[tuple]:
    form, near = {}, {}
    for w in n:
        near[w] = [x for x in n if brute_near(w, x)]
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root))
    return out


def variant_rows(df) -> set[tuple]:
    return {tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect()}


@settings(max_examples=300, deadline=None)
@given(st.text("abé", max_size=7), st.text("abé", max_size=7))
def test_near_and_verified(a, b):
    x, y = a.encode("latin-1"), b.encode("latin-1")
    assert spelling.near(x, y) == brute_near(a, b)
    got = spelling.verified(spelling._Letters([x]), np.array([0]), spelling._Letters([y]), np.array([0]))
    assert bool(got[0]) == brute_near(a, b)


def test_trie_reaches_all_within_the_budget():
    rng = np.random.default_rng(1)
    words = sorted({"".join(rng.choice(list("abcdefghéïø"), rng.integers(3, 7))).encode("latin-1") for _ in range(800)})
    counts = spelling.letter_counts(words)[:, spelling.TOP :]
    trie = spelling.CountTrie(counts)
    for q in counts[::37].tolist():
        for more, less in itertools.product((False, True), repeat=2):
            reached = {int(x) for leaf in trie.reach(q, more, less) for x in trie.leaves[leaf]}
            d = counts - np.array(q)
            ok = (np.maximum(d, 0).sum(1) <= more) & (np.maximum(-d, 0).sum(1) <= less)
            assert reached == set(np.flatnonzero(ok).tolist())


@pytest.mark.parametrize("subtree", [spelling.SUBTREE, 3])
def test_variants_equal_brute_force(spark, subtree):
    rng = np.random.default_rng(4)
    base = ["".join(rng.choice(list("abcdeé"), rng.integers(5, 8))) for _ in range(250)] + ["ab" * 40, "ab" * 40 + "c", "ab" * 39 + "cb"]
    words = Counter()
    for w in base:
        words[w] = int(rng.integers(3, 200))
        for _ in range(2):
            i = int(rng.integers(0, len(w)))
            v = [w[:i] + w[i + 1 :], w[:i] + "x" + w[i:], w[:i] + "z" + w[i + 1 :]][int(rng.integers(0, 3))]
            words.setdefault(v, int(rng.integers(3, 40)))
    chain = ["chainword", "chainwords", "chainwordsa", "chainwordsab", "chainwordsabc", "chainwordsabcd"]
    words |= {w: 3 * 3**k for k, w in enumerate(chain)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert variant_rows(spelling.variants(df, subtree=subtree)) == brute_variants(words)


def test_spelling_groups_of_documents(spark):
    rng = np.random.default_rng(2)
    pool = ["Hello", "hello", "hallo", "ÉTIONS", "étions", "Étions", "wörld×x", "letters", "lettters", "a", "bb"]
    rows = [(i, " ".join(rng.choice(pool, 40)) + "\n1digits2between3", "en", "s", 1) for i in range(150)]
    rows += [(None, "nobody nobody nobody", "en", "s", 1), (900, None, "en", "s", 1), (901, "", "en", "s", 1), (3, "hello " * 5_000, "en", "s", 1), (3, "hello " * 5_000, "en", "s", 1)]
    df = spark.createDataFrame(rows, DOCS).withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    assert variant_rows(spelling.spelling_groups(df)) == brute_variants(brute_words([r[:2] for r in rows]))
    assert spelling.spelling_groups(spark.createDataFrame([], DOCS)).collect() == []


def test_long_texts_are_counted_alike(spark, monkeypatch):
    text = "several words, Several WORDS again " * 30
    df = spark.createDataFrame([(1, text, "en", "s", 1)], DOCS)
    before = sorted(spelling.spelt_words(df).collect())
    count = spelling._counter(97, 5)
    import pyarrow as pa

    monkeypatch.setattr(spelling, "_LONG", 10)
    batch = pa.RecordBatch.from_pydict({"doc_id": ["1"], "text": [text]})
    after = Counter()
    for part in count(iter([batch])):
        after.update(dict(zip(part.column("word").to_pylist(), part.column("n").to_pylist())))
    assert {r["word"]: r["n"] for r in before} == {w: n for w, n in after.items() if n >= 3}


def test_registered_variants_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    n = brute_words([tuple(r) for r in docs])
    found = variant_rows(QUERIES["op13_spelling_variants"](spark, "/root/testdata/sf0.001"))
    assert {r[:2] for r in found} == set(n.items())
    by_length = defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    some = sorted(n)[::40]
    got = {r[0]: r for r in found}
    for w in some:
        near = [x for k in (-1, 0, 1) for x in by_length[len(w) + k] if brute_near(w, x)]
        assert got[w][2] == len(near)
        best = min(near, key=lambda x: (-n[x], x), default=None)
        assert got[w][3] == (best if best and n[best] >= 2 * n[w] else None)


def test_work_folder_is_shared(spark):
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


# -- pipeline ------------------------------------------------------------------------------------------


def test_stages_keep_columns_of_any_name(spark):
    import corpus_pipeline

    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 900, 80)), "en", f"s{i % 3}", 1) for i in range(60)] + [(90, None, "en", "s0", 0), (91, "short", None, None, None)]
    clashing = ("tokens", "copy", "block", "place", "kept", "n_words", "host_rate", "quota")
    docs = spark.createDataFrame(rows, DOCS)
    for c in clashing:
        docs = docs.withColumn(c, F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    judged = corpus_pipeline.quality_rules(spark, docs, "")
    shown = corpus_pipeline.mix_sources(spark, judged, "")
    assert judged.columns == shown.columns == docs.columns
    want = {i for i, text, *_ in rows if text and len(text.split()) >= 50}
    for frame in (judged, shown):
        found = frame.collect()
        assert {r["doc_id"] for r in found} == want
        assert all(r[c] == f"{c} of {r['doc_id']}" for r in found for c in clashing)
    assert len(judged.collect()) == len(want)
