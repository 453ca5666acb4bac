"""Which epochs a sink has done, so that a replayed epoch reaches each sink once."""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.sql import DataFrame

from stormgauge.sinks.versions import Conflict, commit, forget, versions

KEPT = 5  # entries left in a ledger; only the newest counts


def once_per_epoch(
    sink: Callable[[DataFrame, int], None], ledger: str
) -> Callable[[DataFrame, int], None]:
    """``sink``, but an epoch it has finished before is passed over.

    If one of several sinks of a query fails, Spark runs the epoch again for all of them; each
    with a ledger folder of its own then goes on where it was.  A driver lost after the sink's
    last write and before the entry still repeats that one epoch.
    """

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        held = versions(spark, ledger)
        if held and epoch_id <= held[-1]:
            return
        sink(batch, epoch_id)
        with contextlib.suppress(Conflict):
            commit(spark, ledger, epoch_id, "")
        for old in held[: 1 - KEPT]:
            forget(spark, ledger, old)

    return write
