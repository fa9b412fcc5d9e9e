"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

Letters fall into ``GROUPS`` groups, and a word is described by how often each group occurs in it. One
inserted letter is a surplus of one in one group, one deleted letter a deficit of one, a replaced
letter one of each (or neither, inside a group). So near words are found by descending a trie whose
levels are the successive groups: at each level the search follows its own count for free, one more
against the surplus, one less against the deficit. Words in the leaves it reaches are verified.

The first ``TOP`` levels of the trie are dealt over the cluster: a word lives in the subtree of its own
counts, and is sent as a query to each subtree its search can reach. Of the two directions of a pair
only one is searched. A subtree of more than ``SUBTREE`` words is split, and queries go to every part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import lookup
from .common import shared_table, text_or_empty

_RUN = re.compile("[A-Za-zÀ-ÿ]+")  # every letter is one byte in latin-1
GROUPS, TOP = 12, 4
SUBTREE = 20_000
_HELD = 400_000  # distinct words that a counting task holds before it hands them on
_LONG = 1 << 20
_WIDE = 48  # longer words are compared one pair at a time
_PAIRS = 200_000
_SPELLING = "word string, n long"
_PLACED = "key binary, query boolean, word string, n long, surplus boolean, deficit boolean, same boolean"
_FOUND = "a string, a_n long, b string, b_n long"


# -- words ---------------------------------------------------------------------------------------------


def misspelt(doc_id: str, run: str, every: int) -> str:
    """The lower-cased run, or without one letter when ``every`` divides the crc32 of document and run."""
    low = run.encode("latin-1").lower().decode("latin-1")
    h = zlib.crc32(f"{doc_id}:{low}".encode())
    if h % every:
        return low
    at = h % len(low)
    return low[:at] + low[at + 1 :]


def _counter(every: int, least: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for part in batches:
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
                text = text.as_py()
                found = _RUN.findall(text) if len(text) < _LONG else (m.group() for m in _RUN.finditer(text))
                for run, n in Counter(found).items():
                    word = misspelt(doc_id, run, every)
                    if len(word) >= least:
                        held[word] += n
                if len(held) >= _HELD:
                    yield batch()
                    held.clear()
        yield batch()

    return count


def spelt_words(docs: DataFrame, every: int = 97, least_letters: int = 5, least_count: int = 3) -> DataFrame:
    """``word`` and its count ``n`` over all whole texts, each word once.

    A NULL text has no words and a NULL ``doc_id`` counts as an empty one. Words are counted inside
    each task before they are shuffled, so a very frequent one is a row per task.
    """
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), text_or_empty().alias("text"))
    counts = texts.mapInArrow(_counter(every, least_letters), _SPELLING)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# -- the trie ------------------------------------------------------------------------------------------


def letter_counts(words: list[bytes]) -> np.ndarray:
    """How often each letter group occurs in each word, one row per word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer(b"".join(words), np.uint8).astype(np.int64) % GROUPS
    owner = np.repeat(np.arange(len(words)) * GROUPS, sizes)
    return np.bincount(owner + letters, minlength=len(words) * GROUPS).reshape(-1, GROUPS)


def _steps() -> list[tuple[np.ndarray, bool, bool]]:
    """Changes of the top counts that a search can make, one of each two opposite ones."""
    out = []
    for up in range(-1, TOP):
        for down in range(-1, TOP):
            if up == down and up >= 0:
                continue
            step = np.zeros(TOP, np.int64)
            if up >= 0:
                step[up] += 1
            if down >= 0:
                step[down] -= 1
            changed = np.flatnonzero(step)
            if not len(changed) or step[changed[0]] > 0:
                out.append((step, up < 0, down < 0))
    return out


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word in its own subtree, and as a query in each subtree its search can reach."""
    steps = _steps()
    for batch in batches:
        words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
        if not words:
            continue
        top = letter_counts(words)[:, :TOP]
        parts = []
        for step, surplus, deficit in [(np.zeros(TOP, np.int64), None, None), *steps]:
            goal = top + step
            at = np.flatnonzero((goal >= 0).all(axis=1))
            keys = [k.tobytes() for k in np.ascontiguousarray(goal[at], "<u4")]
            query = surplus is not None
            flags = [pa.array(np.full(len(at), x)) for x in (bool(surplus), bool(deficit), query and not step.any())]
            taken = batch.take(pa.array(at))
            parts.append(pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(np.full(len(at), query)), taken.column("word"), taken.column("n"), *flags],
                ["key", "query", "word", "n", "surplus", "deficit", "same"],
            ))
        yield from parts


class CountTrie:
    """Words by the successive counts of their letter groups, from level ``TOP`` on."""

    def __init__(self, counts: np.ndarray):
        vectors, leaf = np.unique(counts, axis=0, return_inverse=True)
        order = np.argsort(leaf, kind="stable")
        self.leaves = np.split(order, np.searchsorted(leaf[order], np.arange(1, len(vectors))))
        self.root: dict = {}
        for k, vector in enumerate(vectors.tolist()):
            node = self.root
            for count in vector[:-1]:
                node = node.setdefault(count, {})
            node[vector[-1]] = k

    def reach(self, counts: list[int], surplus: bool, deficit: bool) -> list[int]:
        """Leaves within the budget, depth first."""
        found, last = [], len(counts) - 1
        stack = [(self.root, 0, surplus, deficit)]
        while stack:
            node, level, more, less = stack.pop()
            own = counts[level]
            for count, up, down in ((own, more, less), (own + 1, False, less) if more else (-1, 0, 0), (own - 1, more, False) if less else (-1, 0, 0)):
                child = node.get(count)
                if child is None:
                    continue
                if level == last:
                    found.append(child)
                else:
                    stack.append((child, level + 1, up, down))
        return found


def near(a: bytes, b: bytes) -> bool:
    """Whether exactly one inserted, deleted or replaced letter leads from one word to the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, x in enumerate(a) if x != b[i]), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


class _Letters:
    """Words as rows of letters from the left and from the right, to compare many pairs at once."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.left = np.array([w[:_WIDE] for w in words], f"S{_WIDE}").view(np.uint8).reshape(-1, _WIDE)
        self.right = np.array([w[: -_WIDE - 1 : -1] for w in words], f"S{_WIDE}").view(np.uint8).reshape(-1, _WIDE)


def _common(a: np.ndarray, b: np.ndarray, least: np.ndarray) -> np.ndarray:
    """How many letters two words of at least ``least`` letters have in common from one end."""
    differs = a != b
    first = differs.argmax(axis=1)
    return np.minimum(np.where(differs[np.arange(len(a)), first], first, least), least)


def verified(a: _Letters, i: np.ndarray, b: _Letters, j: np.ndarray) -> np.ndarray:
    """Which pairs of words are near: prefix and suffix in common leave one letter at most."""
    la, lb = a.size[i], b.size[j]
    width = int(min(_WIDE, max(la.max(initial=0), lb.max(initial=0)) + 1))
    good = np.zeros(len(i), bool)
    for at in range(0, len(i), _PAIRS):
        part = slice(at, at + _PAIRS)
        x, y = i[part], j[part]
        least = np.minimum(la[part], lb[part])
        prefix = _common(a.left[x, :width], b.left[y, :width], least)
        suffix = _common(a.right[x, :width], b.right[y, :width], least)
        same = la[part] == lb[part]
        one = np.where(same, (prefix < least) & (prefix + suffix >= least - 1), (np.abs(la[part] - lb[part]) == 1) & (prefix + suffix >= least))
        good[part] = one
    for k in np.flatnonzero(np.maximum(la, lb) > _WIDE):
        good[k] = near(a.words[i[k]], b.words[j[k]])
    return good


class _Subtree:
    """One part of one subtree: its words, and the search for queries among them."""

    def __init__(self, words: list[str], n: list[int]):
        self.words, self.n = words, n
        self.letters = _Letters([w.encode("latin-1") for w in words])
        self.trie = CountTrie(letter_counts(self.letters.words)[:, TOP:])

    def search(self, words: list[str], n: list[int], surplus: list[bool], deficit: list[bool], same: list[bool]) -> Iterator[pa.RecordBatch]:
        asked = _Letters([w.encode("latin-1") for w in words])
        counts = letter_counts(asked.words)[:, TOP:].tolist()
        reached: dict[tuple, np.ndarray] = {}
        i, j, held = [], [], 0
        for k, query in enumerate(zip(map(tuple, counts), surplus, deficit)):
            hits = reached.get(query)
            if hits is None:
                leaves = self.trie.reach(list(query[0]), query[1], query[2])
                hits = reached[query] = np.concatenate([self.trie.leaves[x] for x in leaves]) if leaves else np.empty(0, np.int64)
            if len(hits):
                i.append(np.full(len(hits), k))
                j.append(hits)
                held += len(hits)
            if held and (held >= _PAIRS or k == len(words) - 1):
                yield self._pairs(words, n, same, asked, np.concatenate(i), np.concatenate(j))
                i, j, held = [], [], 0
        if held:
            yield self._pairs(words, n, same, asked, np.concatenate(i), np.concatenate(j))

    def _pairs(self, words, n, same, asked, i, j) -> pa.RecordBatch:
        ok = np.flatnonzero(verified(asked, i, self.letters, j))
        # Inside one subtree both words of a pair ask: take the pair once.
        kept = [(i[k], j[k]) for k in ok if not same[i[k]] or words[i[k]] < self.words[j[k]]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([words[x] for x, _ in kept], pa.string()),
                pa.array([n[x] for x, _ in kept], pa.int64()),
                pa.array([self.words[y] for _, y in kept], pa.string()),
                pa.array([self.n[y] for _, y in kept], pa.int64()),
            ],
            ["a", "a_n", "b", "b_n"],
        )


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by subtree and part, its words before its queries; one part in memory."""
    place, words, n, subtree = None, [], [], None
    for batch in batches:
        rows = {c: batch.column(c).to_pylist() for c in batch.schema.names}
        places = list(zip(rows["key"], rows["part"], rows["query"]))
        at = 0
        while at < len(places):
            end = at
            while end < len(places) and places[end] == places[at]:
                end += 1
            if places[at][:2] != place:
                place, words, n, subtree = places[at][:2], [], [], None
            if not places[at][2]:
                words += rows["word"][at:end]
                n += rows["n"][at:end]
            elif words:
                subtree = subtree or _Subtree(words, n)
                yield from subtree.search(*[rows[c][at:end] for c in ("word", "n", "surplus", "deficit", "same")])
            at = end


def near_words(words: DataFrame, subtree: int = SUBTREE) -> DataFrame:
    """Pairs of near words, each once: ``a``, ``a_n``, ``b``, ``b_n``."""
    placed = words.select("word", "n").mapInArrow(_place, _PLACED)
    crowded = placed.filter("NOT query").groupBy("key").count().filter(F.col("count") > subtree)
    crowded = crowded.select("key", F.ceil(F.col("count") / subtree).cast("int").alias("parts"))
    split = lookup(placed, crowded, "key", "key", ["parts"]).withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    dealt = split.withColumn("part", F.explode(F.when(F.col("query"), every).otherwise(own))).drop("parts")
    return dealt.repartition("key", "part").sortWithinPartitions("key", "part", "query").mapInArrow(_search, _FOUND)


# -- forms ---------------------------------------------------------------------------------------------


def _roots(links: DataFrame) -> DataFrame:
    """The last word that ``form`` leads to, by doubling the steps; counts at least double at each step."""
    roots = shared_table(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        following = roots.select(F.col("word").alias("_from"), F.col("root").alias("_next"))
        longer = shared_table(lookup(roots, following, "root", "_from", ["_next"]), "roots")
        if longer.filter("_next IS NOT NULL").isEmpty():
            return roots
        roots = longer.select("word", F.coalesce("_next", "root").alias("root"))


def variants(words: DataFrame, ratio: int = 2, subtree: int = SUBTREE) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root`` of each row of ``words`` (``word``, ``n``).

    A word's form is its most frequent near word (ties: the first in code-point order), if that is at
    least ``ratio`` times as frequent; the root is where forms lead. Words are distinct; their letters
    are those of latin-1.
    """
    pairs = near_words(words, subtree)
    sides = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
    )
    best = pairs.select(F.inline(sides)).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("order"), F.col("other"))).alias("best")
    )
    best_n = -F.col("best.order")
    led = F.coalesce(best_n >= ratio * F.col("n"), F.lit(False))
    formed = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(led, F.col("best.other")).alias("form"), F.when(led, best_n).alias("form_n"),
    )
    formed = shared_table(formed, "forms")
    roots = _roots(formed.filter("form IS NOT NULL"))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_groups(docs: DataFrame, every: int = 97, least_letters: int = 5, least_count: int = 3) -> DataFrame:
    """Spelling variants among the words of all texts.

    Repeated rows count again, NULL and empty texts have no words, an empty table has no rows, and
    columns other than ``doc_id`` and ``text`` are not read.
    """
    words = shared_table(spelt_words(docs, every, least_letters, least_count), "words")
    return variants(words)
