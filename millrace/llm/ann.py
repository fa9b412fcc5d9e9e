"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of several tables cuts space into cells by ``floor((a.x + b) / width)`` over a few Gaussian
projections. A query visits cells in the order of the estimated probability that a true neighbour
lies there, down to the probability at which the order has found the wanted share of neighbours.
Candidates of all tables are ranked by their exact inner products.

Vectors are scaled to one length by one more component before hashing (the norm that is missing to
the longest vector), which is zero in a query of that length, so that the largest inner product is
the smallest distance.

Nothing but vectors travels: cells of one group (those with the same first hashes) lie together,
neighbouring groups make a part, a query is sent once to each part that has a group which can hold a
cell likely enough for it, and there its probabilities are matched with the cells of the vectors.
A task holds a slice of the queries and reads the vectors of its part block by block, so that its
memory depends on neither the table nor the number of groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, shared_table

CHUNK = 16_384  # vectors that a part has at least
VALUES = 1 << 22  # components of the queries that a task holds
BLOCK, _FIRST = 8_192, 1_024  # vectors of a part compared at once; of its first block
SAMPLE = 4_096  # rows that the search is fitted on, whatever the size of the table
SLOTS = 8  # cell numbers of one hash; the outermost two are open
_CELL_ROWS, _CELL_BITS = 24, 1.8  # rows wanted in a cell; bits that one hash tells of a vector
_DRAWS = 256  # simulated neighbours for the order of cells
_SLICE = 256  # queries compared at once
_SCORES = 20_000  # pairs scored at once
_MEETING = ["t", "part", "chunk", "slice"]


@dataclass(frozen=True)
class Search:
    k: int = 20
    every: int = 20  # queries are the rows whose id is divisible by this
    tables: int = 2
    hashes: int | None = None  # from the number of rows, if not given
    width: float = 1.2  # of a cell, in units of the vectors' common length
    recall: float = 0.95  # wanted of the sample's queries
    seed: int = 9


@dataclass(frozen=True)
class Fitted:
    """Projections, the common length, the distance at which neighbours are expected, and the
    share of the simulated neighbours that the visited cells of a table have to hold."""

    dim: int
    length: float
    directions: np.ndarray  # tables x hashes x (dim + 1)
    offsets: np.ndarray  # tables x hashes
    width: float
    steps: np.ndarray  # draws x hashes: moves of a projection from a query to a neighbour
    radius: float
    share: float
    leading: int  # hashes that make a group


def usable(vector: Column) -> Column:
    """Not NULL, no NULL or non-finite component, and not the zero vector."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def vectors(table: DataFrame) -> DataFrame:
    """``vec_id`` and ``v`` (components as they are) of the rows that may take part."""
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    return rows.filter(F.col("vec_id").isNotNull() & usable(F.col("v")))


def fit(rows: DataFrame, config: Search, n: int, dim: int, length: float) -> Fitted:
    """The search for ``n`` rows, from at most SAMPLE of them.

    The sample's first neighbours stand for the table's ``k``: as many as its share of the rows. A
    pair's place in the order of a table is the share of simulated neighbours in cells at least as
    likely as the neighbour's own; the best place of all tables that the wanted share of pairs does
    not exceed is where the search stops.
    """
    # The rows with the smallest digests: a random sample that does not depend on partitions.
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toPandas()
    plain = _matrix(sample["v"], dim)
    x, asked = _lifted(plain, length), _query(plain[:_SLICE])
    hashes = config.hashes or int(np.clip(round(np.log2(max(n, 2) / _CELL_ROWS) / _CELL_BITS), 2, 16))
    leading = int(np.clip(np.ceil(np.log(max(n, 1) / (2 * CHUNK)) / np.log(2.5)), 0, hashes))
    rng = np.random.Generator(np.random.PCG64(config.seed))
    directions, offsets = rng.normal(size=(config.tables, hashes, dim + 1)), rng.uniform(0, config.width, (config.tables, hashes))
    steps = rng.normal(size=(_DRAWS, hashes))
    distance = np.maximum(0, 2 - 2 * asked @ x.T)
    distance[np.arange(len(asked)), np.arange(len(asked))] = np.inf
    of = int(np.clip(np.ceil(config.k * len(x) / n), 1, max(1, len(x) - 1)))
    near = np.argsort(distance, axis=1, kind="stable")[:, :of]
    if len(x) < 2:
        return Fitted(dim, length, directions, offsets, config.width, steps, 1.0, 1.0, leading)
    radius = max(float(np.median(np.sqrt(np.take_along_axis(distance, near, axis=1)))), 1e-3)
    fitted = Fitted(dim, length, directions, offsets, config.width, steps, radius, 1.0, leading)
    cell, place = _cells(x, fitted)[0], _cells(asked, fitted)[1]
    first = np.ones(near.shape)
    for t in range(config.tables):
        chance = log_chance(place[:, t], fitted)
        drawn = _drawn(chance, place[:, t], fitted)
        for i in range(len(asked)):
            own = chance[i][np.arange(hashes), cell[near[i], t]].sum(axis=1)
            before = 1 - np.searchsorted(np.sort(drawn[i]), own, side="right") / _DRAWS
            first[i] = np.minimum(first[i], before)
    share = float(np.quantile(first, config.recall, method="higher"))
    return Fitted(dim, length, directions, offsets, config.width, steps, radius, share, leading)


def _lifted(x: np.ndarray, length: float) -> np.ndarray:
    x = x / length
    return np.concatenate([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))[:, None]], axis=1)


def _query(x: np.ndarray) -> np.ndarray:
    """Queries at the vectors' common length; their own length does not change the order of scores."""
    return np.concatenate([x / np.sqrt((x * x).sum(axis=1))[:, None], np.zeros((len(x), 1))], axis=1)


def _slot(place: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(place), -SLOTS // 2, SLOTS // 2 - 1).astype(np.int64) + SLOTS // 2


def _cells(lifted: np.ndarray, fitted: Fitted) -> tuple[np.ndarray, np.ndarray]:
    """Cell numbers (0 to SLOTS - 1) and places on the scale of cells: rows x tables x hashes."""
    tables, hashes, size = fitted.directions.shape
    at = (lifted @ fitted.directions.reshape(-1, size).T).reshape(-1, tables, hashes)
    place = (at + fitted.offsets) / fitted.width
    return _slot(place), place


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    t = 1 / (1 + 0.3275911 * np.abs(x) / np.sqrt(2))
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return 0.5 * (1 + np.sign(x) * (1 - poly * np.exp(-x * x / 2)))


def log_chance(place: np.ndarray, fitted: Fitted) -> np.ndarray:
    """Per query and hash of one table, the logarithm of the probability of each cell number.

    A neighbour at the fitted distance moves a projection by a normal step.
    """
    edges = np.arange(1 - SLOTS // 2, SLOTS // 2)
    below = _normal_cdf((edges - place[..., None]) * (fitted.width / fitted.radius))
    ends = np.zeros((*place.shape, 1))
    return np.log(np.maximum(np.diff(np.concatenate([ends, below, ends + 1], axis=-1), axis=-1), 1e-9))


def _drawn(chance: np.ndarray, place: np.ndarray, fitted: Fitted) -> np.ndarray:
    """Log-probabilities of the cells of simulated neighbours: queries x draws."""
    out = np.zeros((len(place), len(fitted.steps)))
    for h in range(place.shape[1]):
        slot = _slot(place[:, h, None] + fitted.steps[:, h] * (fitted.radius / fitted.width))
        out += np.take_along_axis(chance[:, h], slot, axis=1)
    return out


def least_chance(chance: np.ndarray, place: np.ndarray, fitted: Fitted) -> np.ndarray:
    """Per query, the log-probability down to which cells of this table are visited."""
    rest = round((1 - fitted.share) * _DRAWS)  # draws that need not be reached
    if rest < 1:
        return np.full(len(place), -np.inf)
    return np.sort(_drawn(chance, place, fitted), axis=1)[:, rest - 1] - 1e-6


def groups(chance: np.ndarray, least: float, leading: int) -> np.ndarray:
    """Numbers of the groups that can hold a cell likely enough for one query.

    A group's bound is the chance of its own hashes and the best chance of all others.
    """
    best = chance.max(axis=1)
    bound, number = np.array([best.sum()]), np.zeros(1, np.int64)
    for h in range(leading):
        bound = (bound[:, None] + (chance[h] - best[h])).ravel()
        number = (number[:, None] * SLOTS + np.arange(SLOTS)).ravel()
        bound, number = bound[bound >= least], number[bound >= least]
    return number


def _group(cell: np.ndarray, leading: int) -> np.ndarray:
    number = np.zeros(len(cell), np.int64)
    for h in range(leading):
        number = number * SLOTS + cell[:, h]
    return number


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products in double precision, one component added after the other.

    ``q`` is one query or one for each row. The order of the sum does not depend on how many rows
    are scored together, so equal rows score alike in every meeting, and ties are settled by ids.
    """
    score = np.zeros(len(x))
    for k in range(x.shape[1]):
        score += q[..., k] * x[:, k]
    return score


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    return np.concatenate(column.to_numpy()).reshape(len(column), dim).astype(np.float64) if len(column) else np.empty((0, dim))


def search(table: DataFrame, config: Search | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's best, without the query itself.

    Vectors that are NULL, zero, or hold NULL or non-finite components take no part, nor do those
    of another length than most have. Rows that repeat an id count once, with the best score of
    them as a candidate and the vector that sorts first as a query. A query gets fewer rows only if
    there are fewer candidates: those whose cells hold too few are compared with all vectors, in
    blocks. An empty table gives no rows; other columns are not read.

    A part whose groups are too large for it, as with very many equal vectors, is dealt into chunks
    over tasks, and the part's queries meet each chunk. The queries are dealt into slices of VALUES
    components; each meeting of a slice and a chunk returns at most ``k`` rows for a query.
    """
    config, spark = config or Search(), table.sparkSession
    rows, out = vectors(table), "query_id long, rank int, vec_id long, score double"
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    most = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("length")).orderBy(F.col("n").desc(), "dim").first()
    if most is None:
        return spark.createDataFrame([], out)
    total, dim, length, k = int(most["n"]), int(most["dim"]), float(most["length"]), config.k
    rows = rows.filter(F.size("v") == dim)
    shared = spark.sparkContext.broadcast(vars(fit(rows, config, total, dim, length)))
    queries = rows.filter(F.col("vec_id") % config.every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    queries = shared_table(queries, "queries")
    per = max(CHUNK, min(total // 8, 4 * CHUNK), total // 64)  # vectors of a part

    def grouped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitted = Fitted(**shared.value)
        for frame in frames:
            cell, _ = _cells(_lifted(_matrix(frame["v"], dim), length), fitted)
            for t in range(cell.shape[1]):
                g, n = np.unique(_group(cell[:, t], fitted.leading), return_counts=True)
                yield pd.DataFrame({"t": np.full(len(g), t, np.int32), "g": g, "n": n})

    sizes = rows.select("v").mapInPandas(grouped, "t int, g long, n long").groupBy("t", "g").agg(F.sum("n").alias("n"))
    # At most 65 parts for a table of hashes, whatever the number of groups and rows.
    upto = Window.partitionBy("t").orderBy("g").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = sizes.withColumn("part", F.floor((F.sum("n").over(upto) - F.col("n")) / per).cast("int"))
    parts = sizes.groupBy("t", "part").agg(F.min("g").alias("g"), F.ceil(F.max("n") / per).cast("int").alias("chunks")).orderBy("t", "g").collect()
    bounds = [
        (np.array([r["g"] for r in parts if r["t"] == t], np.int64), np.array([r["chunks"] for r in parts if r["t"] == t], np.int32))
        for t in range(config.tables)
    ]

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitted = Fitted(**shared.value)
        for frame in frames:
            cell, _ = _cells(_lifted(_matrix(frame["v"], dim), length), fitted)
            for t, (first, chunks) in enumerate(bounds):
                part = np.searchsorted(first, _group(cell[:, t], fitted.leading), side="right") - 1
                yield pd.DataFrame({"t": np.full(len(frame), t, np.int32), "part": part.astype(np.int32), "chunks": chunks[part], "id": frame["vec_id"], "v": frame["v"]})

    def sent(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitted = Fitted(**shared.value)
        for frame in frames:
            for lo in range(0, len(frame), _SLICE):
                ids, v = frame["query_id"].to_numpy()[lo : lo + _SLICE], frame["v"].to_numpy()[lo : lo + _SLICE]
                _, place = _cells(_query(np.concatenate(v).reshape(len(v), dim).astype(np.float64)), fitted)
                for t, (first, chunks) in enumerate(bounds):
                    chance = log_chance(place[:, t], fitted)
                    least = least_chance(chance, place[:, t], fitted)
                    to = [np.unique(np.searchsorted(first, groups(c, b, fitted.leading), side="right") - 1) for c, b in zip(chance, least, strict=True)]
                    at, part = np.repeat(np.arange(len(v)), [len(p) for p in to]), np.concatenate(to)
                    at, part = at[part >= 0], part[part >= 0]  # no vector lies before the first group
                    yield pd.DataFrame({"t": np.full(len(at), t, np.int32), "part": part.astype(np.int32), "chunks": chunks[part], "id": ids[at], "least": least[at], "v": v[at]})

    kind = rows.schema["v"].dataType.simpleString()
    members = rows.mapInPandas(placed, f"t int, part int, chunks int, id long, v {kind}")
    visits = queries.mapInPandas(sent, f"t int, part int, chunks int, id long, least double, v {kind}")
    met = _met(visits, members, queries.count(), sum(r["chunks"] for r in parts), dim, k, length, shared)
    found = shared_table(_top(met, k), "found")
    short = queries.join(found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")), "query_id", "left").filter(F.coalesce("n", F.lit(0)) < min(k, total - 1)).drop("n")
    short = shared_table(short, "short")
    left = short.count()
    if left:
        # A stated set of queries against all rows, block by block.
        blocks = -(-total // per)
        everywhere = [F.lit(0).alias("t"), F.lit(0).alias("part"), F.lit(blocks).alias("chunks")]
        asked = short.select(*everywhere, F.col("query_id").alias("id"), F.lit(0.0).alias("least"), "v")
        again = _met(asked, rows.select(*everywhere, F.col("vec_id").alias("id"), "v"), left, blocks, dim, k, length)
        found = found.join(short.select("query_id"), "query_id", "left_anti").unionByName(_top(again, k))
    return found.select("query_id", "rank", "vec_id", "score")


def _met(visits: DataFrame, members: DataFrame, asked: int, chunks: int, dim: int, k: int, length: float, shared=None) -> DataFrame:
    """query_id, vec_id, score: the best of each meeting of a slice of the ``asked`` queries with a chunk of a part.

    ``shared`` has the search that says which cells a query visits; without it a query visits all.
    """
    slices = max(1, -(-asked * dim // VALUES))
    visits = visits.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    visits = visits.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int"))
    members = members.withColumn("chunk", F.pmod(F.xxhash64("id", "v"), F.col("chunks")).cast("int")).withColumn("least", F.lit(None).cast("double"))
    members = members.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))) if slices > 1 else F.lit(0))
    columns = [*_MEETING, "id", "least", "v"]
    both = visits.select(*columns).unionByName(members.select(*columns)).repartition(min(3 * chunks * slices, 5_000), *_MEETING)
    # Queries come first; vectors in the order of a digest, so that the first of them are like the rest.
    both = both.sortWithinPartitions(*_MEETING, F.col("least").isNull(), F.xxhash64("id"), "id")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _meetings(batches, dim, k, length, Fitted(**shared.value) if shared else None)

    return both.mapInArrow(meet, "query_id long, vec_id long, score double")


def _flat(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _meetings(batches: Iterator[pa.RecordBatch], dim: int, k: int, length: float, fitted: Fitted | None) -> Iterator[pa.RecordBatch]:
    at, asked, meeting = None, [], None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in _MEETING], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi == lo:
                continue
            if (key := keys[lo].tolist()) != at:
                if meeting is not None:
                    yield from meeting.rows()
                at, asked, meeting = key, [], None
            piece = batch.slice(lo, hi - lo)
            n = len(piece) - piece.column("least").null_count
            if n:
                asked.append(piece.slice(0, n))
            if n < len(piece) and asked:
                meeting = meeting or _Meeting(asked, dim, k, length, fitted, key[0])
                meeting.take(piece.column("id").slice(n).to_numpy(), _flat(piece.column("v").slice(n), dim))
    if meeting is not None:
        yield from meeting.rows()
    meeting = asked = None
    give_back()


class _Meeting:
    """Queries and the ``k`` best of the vectors they have met so far.

    Vectors are first compared in single precision, by an upper bound of the inner product; those
    that may be among the best are scored in double precision.
    """

    def __init__(self, asked: list[pa.RecordBatch], dim: int, k: int, length: float, fitted: Fitted | None, t: int):
        self.ids = np.concatenate([p.column("id").to_numpy() for p in asked])
        self.q = np.concatenate([_flat(p.column("v"), dim) for p in asked])
        self.k, self.length, self.fitted, self.t = k, length, fitted, t
        self.norm = np.sqrt(np.concatenate([np.square(p.astype(np.float64)).sum(axis=1) for p in self._slices(self.q)]))
        self.unit = np.ones((len(self.q), dim + 1), np.float32)
        self.unit[:, :-1] = np.concatenate([p / n[:, None] for p, n in zip(self._slices(self.q), self._slices(self.norm))])
        self.best = np.full((len(self.q), k), -np.inf)
        self.who = np.zeros((len(self.q), k), np.int64)
        self.begun = False
        if fitted is not None:
            self.least = np.concatenate([p.column("least").to_numpy() for p in asked]) - 1e-3
            places = (_cells(_query(p.astype(np.float64)), fitted)[1][:, t] for p in self._slices(self.q))
            self.chance = np.concatenate([log_chance(p, fitted).reshape(len(p), -1).astype(np.float32) for p in places])

    @staticmethod
    def _slices(x: np.ndarray) -> list[np.ndarray]:
        return [x[lo : lo + _SLICE] for lo in range(0, len(x), _SLICE)]

    def take(self, ids: np.ndarray, v: np.ndarray) -> None:
        lo = 0
        while lo < len(ids):
            hi = lo + (BLOCK if self.begun else _FIRST)
            self._block(ids[lo:hi], v[lo:hi].astype(np.float64))
            lo, self.begun = hi, True

    def _block(self, ids: np.ndarray, x: np.ndarray) -> None:
        some = _fewer_copies(ids, x, self.k)
        ids, x = ids[some], x[some]
        # Rounding of both vectors, of the products and of their sum, twice as much as it can be.
        error = (x.shape[1] + 8) * 2.0**-23 * np.sqrt((x * x).sum(axis=1)) / self.length + 1e-30
        upper = np.concatenate([x / self.length, error[:, None]], axis=1).astype(np.float32).T.copy()
        slack, cell, marks = 2.5 * float(error.max()), None, None
        if self.fitted is not None:
            cell = _cells(_lifted(x, self.length), self.fitted)[0][:, self.t] + np.arange(self.fitted.directions.shape[1]) * SLOTS
        for lo in range(0, len(self.q), _SLICE):
            own = self.ids[lo : lo + _SLICE]
            rough = self.unit[lo : lo + _SLICE] @ upper
            line = self.best[lo : lo + _SLICE, -1] / self.norm[lo : lo + _SLICE] / self.length
            line = np.nextafter(line.astype(np.float32), np.float32(-np.inf))
            hit = rough >= line[:, None]
            free = np.isneginf(line)
            if free.any():  # fewer than k so far: the k best of the cells visited, without the query itself
                at = np.flatnonzero(free)
                seen = own[at, None] != ids
                if cell is not None:
                    if marks is None:
                        kinds, of = np.unique(cell, axis=0, return_inverse=True)
                        marks = np.zeros((self.chance.shape[1], len(kinds)), np.float32)
                        marks[kinds.T, np.arange(len(kinds))] = 1
                    seen &= (self.chance[lo + at] @ marks >= self.least[lo + at, None])[:, of.ravel()]
                bound = np.where(seen, rough[at], -np.inf)
                if len(ids) > self.k:
                    seen &= bound >= np.partition(bound, len(ids) - self.k, axis=1)[:, [len(ids) - self.k]] - slack
                hit[at] = seen
            i, j = np.divmod(np.flatnonzero(hit.ravel()), len(ids))
            for a in range(0, len(i), _SCORES):
                self._merge(lo, i[a : a + _SCORES], j[a : a + _SCORES], own, free, ids, x, cell)

    def _merge(self, lo: int, i: np.ndarray, j: np.ndarray, own: np.ndarray, free: np.ndarray, ids: np.ndarray, x: np.ndarray, cell: np.ndarray | None) -> None:
        keep = own[i] != ids[j]
        if cell is not None:
            keep &= free[i] | (self.chance[(lo + i)[:, None], cell[j]].sum(axis=1) >= self.least[lo + i])
        i, j = i[keep], j[keep]
        if not len(i):
            return
        score = exact_scores(self.q[lo + i].astype(np.float64), x[j])
        touched = np.unique(i)
        old = self.best[lo + touched].ravel()
        held = old > -np.inf
        i = np.concatenate([i, np.repeat(touched, self.k)[held]])
        who, score = np.concatenate([ids[j], self.who[lo + touched].ravel()[held]]), np.concatenate([score, old[held]])
        order = np.lexsort((who, -score, i))
        i, who, score = i[order], who[order], score[order]
        n = np.bincount(i)
        rank = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        top = rank < self.k
        self.best[lo + i[top], rank[top]], self.who[lo + i[top], rank[top]] = score[top], who[top]

    def rows(self) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(self.ids), BLOCK):
            best = self.best[lo : lo + BLOCK]
            i, at = np.nonzero(best > -np.inf)
            yield pa.RecordBatch.from_arrays([pa.array(self.ids[lo + i]), pa.array(self.who[lo + i, at]), pa.array(best[i, at])], ["query_id", "vec_id", "score"])


def _fewer_copies(ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Rows without those that ``k + 1`` equal vectors with smaller ids precede: no query takes them."""
    order = np.argsort(ids, kind="stable")
    _, of, n = np.unique(x[order].view(np.dtype((np.void, x.itemsize * x.shape[1]))).ravel(), return_inverse=True, return_counts=True)
    if n.max() <= k + 1:
        return order
    by = np.argsort(of, kind="stable")
    rank = np.arange(len(by)) - np.repeat(np.cumsum(n) - n, n)
    return order[by[rank <= k]]


def _top(pairs: DataFrame, k: int) -> DataFrame:
    """Merge the rows of all meetings, in one shuffle. A pair found more than once counts once."""
    rows = pairs.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
