"""Index from a table's key to the partition that holds it, kept beside the table.

The base is split into buckets by a hash of the key; each bucket is sorted by key and carries a
Parquet bloom filter, so a few keys are found in a few row groups of their buckets. Changes are
appended as small sorted runs that stand before the base; when runs get many or large, they are
folded into the buckets they touch, and other buckets stay where they are. What a lookup reads
grows with the keys asked for and the recent changes, not with the table.

The versions that belong together are a small dictionary, the index's state. The table keeps it in
its own manifest, so table and index move in one commit; a run that died half way leaves versions
that no state names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import TableStore

BUCKET_ROWS = 1_000_000
MAX_RUNS = 16
RECENT_ROWS = 100_000  # recent changes may reach this, and this share of the base
RECENT_SHARE = 8
BUCKET, RUN = "bucket", "run"


class KeyIndex:
    """Where each key of a stored table is: one row of ``key`` and ``value`` per key."""

    def __init__(self, store: TableStore, table: str, key: str, value: str, bucket_rows: int = BUCKET_ROWS, max_runs: int = MAX_RUNS):
        self.store, self.key, self.value = store, key, value
        self.base, self.recent = f"{table}_keys", f"{table}_keys_recent"
        self.bucket_rows, self.max_runs = bucket_rows, max_runs
        # A filter per row group, of the size that so many keys need.
        self._options = {
            f"parquet.bloom.filter.enabled#{key}": "true",
            f"parquet.bloom.filter.expected.ndv#{key}": str(bucket_rows),
            "parquet.bloom.filter.adaptive.enabled": "true",
        }

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def _write_base(self, rows: DataFrame, buckets: int, keep=(), onto: int | None = None) -> tuple[int, int]:
        """Version and number of rows written; one file per bucket, sorted by key."""
        laid_out = rows.select(self.key, self.value, self._bucket(buckets).alias(BUCKET))
        laid_out = laid_out.repartition(buckets, BUCKET).sortWithinPartitions(BUCKET, self.key)
        version = self.store.write(laid_out, self.base, [BUCKET], None, keep, onto=onto, options=self._options)
        return version, self.store.manifest(self.base, version).counts.get("rows", 0)

    def _write_run(self, rows: DataFrame, run: int, keep=(), onto: int | None = None) -> tuple[int, int]:
        laid_out = rows.select(self.key, self.value, F.lit(run).alias(RUN)).sortWithinPartitions(self.key)
        version = self.store.write(laid_out, self.recent, [RUN], None, keep, onto=onto, options=self._options)
        return version, self.store.manifest(self.recent, version).counts.get("rows", 0)

    def build(self, rows: DataFrame, n_rows: int) -> dict:
        """An index of all rows of a table; ``n_rows`` sets the number of buckets."""
        buckets = 16
        while n_rows > buckets * self.bucket_rows:
            buckets *= 2
        base, written = self._write_base(rows, buckets)
        recent, _ = self._write_run(rows.limit(0), 0)
        return {"base": base, "recent": recent, "buckets": buckets, "base_rows": written, "recent_rows": 0, "runs": 0}

    def buckets_of(self, state: dict, keys: DataFrame) -> list[str]:
        """The buckets that these keys fall in; at most as many values as there are buckets."""
        return sorted(str(r[0]) for r in keys.select(self._bucket(state["buckets"])).distinct().collect())

    def find(self, state: dict, keys: DataFrame, small: bool, n_keys: int | None = None) -> DataFrame:
        """``key`` and current ``value`` of those of the ``keys`` that are in the table.

        ``small`` says that the keys may be broadcast. Up to as many keys as Spark pushes down as a
        list are handed to the scan as values, which then reads only row groups that may hold one.
        """
        asked = keys.select(self.key)
        base = self.store.read_partitions(self.base, self.buckets_of(state, asked), state["base"])
        parts = base.select(self.key, self.value, F.lit(0).alias(RUN))
        if state["runs"]:
            parts = parts.unionByName(self.store.read(self.recent, state["recent"]).select(self.key, self.value, RUN))
        pushed = int(self.store.spark.conf.get("spark.sql.parquet.pushdown.inFilterThreshold"))
        if n_keys is not None and n_keys <= pushed:
            parts = parts.filter(F.col(self.key).isin([r[0] for r in asked.collect()]))
        hits = parts.join(F.broadcast(asked) if small else asked, self.key, "left_semi")
        if not state["runs"]:  # the base alone has each key once
            return hits.select(self.key, self.value)
        return hits.groupBy(self.key).agg(F.max_by(self.value, RUN).alias(self.value))

    def add(self, state: dict, rows: DataFrame, n_rows: int = 0) -> dict:
        """The state after these keys got these values; one row per key.

        When ``n_rows`` says that they are too many for a run, they go straight into the base.
        """
        run = state["runs"] + 1
        if state["recent_rows"] + n_rows > RECENT_ROWS + state["base_rows"] // RECENT_SHARE:
            added = rows.select(self.key, self.value, F.lit(run).alias(RUN))
            recent = self.store.read(self.recent, state["recent"]).unionByName(added) if state["runs"] else added
            return self._folded({**state, "recent_rows": state["recent_rows"] + n_rows}, recent)
        kept = self.store.manifest(self.recent, state["recent"]).partitions
        recent, written = self._write_run(rows, run, kept, state["recent"])
        state = {**state, "recent": recent, "runs": run, "recent_rows": state["recent_rows"] + written}
        if run >= self.max_runs or state["recent_rows"] > RECENT_ROWS + state["base_rows"] // RECENT_SHARE:
            return self._folded(state, self.store.read(self.recent, recent))
        return state

    def _folded(self, state: dict, recent: DataFrame) -> dict:
        """Recent changes moved into the base; only buckets they touch are read and written."""
        rows = state["base_rows"] + state["recent_rows"]
        if rows > 4 * state["buckets"] * self.bucket_rows:  # outgrown: more buckets, all of them new
            everything = self._newest(self.store.read(self.base, state["base"]), recent)
            return self.build(everything, rows)
        touched = self.buckets_of(state, recent)
        merged = self._newest(self.store.read_partitions(self.base, touched, state["base"]), recent)
        others = [b for b in self.store.manifest(self.base, state["base"]).partitions if b not in touched]
        base, _ = self._write_base(merged, state["buckets"], others, state["base"])
        fresh, _ = self._write_run(recent.limit(0), 0)
        return {**state, "base": base, "recent": fresh, "runs": 0, "recent_rows": 0, "base_rows": rows}

    def _newest(self, base: DataFrame, recent: DataFrame) -> DataFrame:
        both = base.select(self.key, self.value, F.lit(0).alias(RUN)).unionByName(recent.select(self.key, self.value, RUN))
        return both.groupBy(self.key).agg(F.max_by(self.value, RUN).alias(self.value))
