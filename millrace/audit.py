"""Write, audit, publish: a version is checked before anybody can read it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from .operators.quality import run_checks
from .tables import TableStore


class AuditFailed(Exception):
    """A version was not published; ``mark`` names it, ``failures`` are the checks that failed."""

    def __init__(self, name: str, mark: str, failures: Sequence[Mapping]):
        self.name, self.mark, self.failures = name, mark, list(failures)
        text = ", ".join(f"{f['test']}({f['column']}): {f['failures']}" for f in self.failures)
        super().__init__(f"{name} was not published, as checks failed: {text}")


def write_checked(store: TableStore, df: DataFrame, name: str, checks: Sequence, extra: Mapping | None = None, **options) -> int:
    """Write ``df`` as the next version if it passes all checks.

    The rows are written first and checked as they would be read, carried-over partitions included.
    With a failure the version is kept aside with its failures (``store.rejected``), readers go on
    with the version before, and ``AuditFailed`` is raised. Only one count per check reaches the driver.
    """
    prepared = store.prepare(df, name, **options)
    failed = [r.asDict() for r in run_checks(store.read_prepared(prepared), checks).collect() if r["failures"]]
    if failed:
        raise AuditFailed(name, store.reject(prepared, failed), failed)
    return store.commit(prepared, extra)
