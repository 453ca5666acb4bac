"""Further run dates merged into the cleaned table, rewriting only the months they change."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stormgauge import session
from stormgauge.operators.cleaning import enrich_events, first_events, order_of_copies
from stormgauge.sinks.parquet import write_partitioned
from stormgauge.sources.files import read_events
from stormgauge.sources.schemas import EVENTS_CLEAN_PARTITIONS

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # folder name Spark gives a NULL partition value

Month = tuple[int | None, int | None]


def _in_months(months: set[Month]) -> Column:
    """Filter on the partition columns; events of unknown start lie in a month of NULLs."""
    tests = [
        F.col("event_year").eqNullSafe(F.lit(y)) & F.col("event_month").eqNullSafe(F.lit(m))
        for y, m in sorted(months, key=str)
    ]
    return reduce(Column.__or__, tests, F.lit(False))


def _months(rows: DataFrame) -> set[Month]:
    # a table has as many as its history has months, however many rows there are
    return {tuple(r) for r in rows.select(*EVENTS_CLEAN_PARTITIONS).distinct().collect()}


def _present() -> Column:
    """The months of the rows that pass; a month of NULLs counts as one."""
    return F.collect_set(F.struct(*EVENTS_CLEAN_PARTITIONS)).alias("months")


def _folder(target: str, month: Month) -> str:
    named = zip(EVENTS_CLEAN_PARTITIONS, month)
    return "/".join([target, *(f"{c}={NO_VALUE if v is None else v}" for c, v in named)])


def _is_table(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def refused_copies(new: DataFrame, held: DataFrame) -> DataFrame:
    """Ids of ``new`` that a row of ``held`` comes before, or equals, in the order of copies."""
    pairs = new.select("event_id", order_of_copies(new).alias("mine")).join(
        held.select("event_id", order_of_copies(held).alias("theirs")), "event_id"
    )
    return pairs.where(~(F.col("mine") < F.col("theirs"))).select("event_id").distinct()


def merge_events(spark: SparkSession, raw: DataFrame, target: str, work: str) -> set[Month]:
    """Clean ``raw`` into the table at ``target``; returns the months that were written.

    ``work`` is a fresh folder that all executors share; it is removed in the end.

    Run dates may come in any order, and one may come again: the table then holds what
    :func:`clean_events` makes of all their rows together.  Of several rows of an id the
    first stays; if a new one comes before the one held, the id moves to the new row's month.

    The table is its own index of ids: to find what changes, its ids and starts alone are
    read and joined to the new ids.  Whole rows are read only of months in which a start
    ties, or which change.  Months without a change keep their files.

    A run that fails while it writes may leave an id in two months, as its new month is
    written before the old one; running the same date again mends it.
    """
    try:
        first_events(raw).write.parquet(f"{work}/new")
        new = spark.read.parquet(f"{work}/new")
        if not _is_table(spark, target):
            made = enrich_events(new)
            write_partitioned(made, target)
            return _months(made)

        held = read_events(spark, target)
        starts = new.select("event_id", F.col("start_time_utc").alias("new_start"))
        met = held.select("event_id", "start_time_utc", *EVENTS_CLEAN_PARTITIONS).join(starts, "event_id")
        mine, theirs = F.struct("new_start"), F.struct("start_time_utc")  # so that NULL comes first
        met.select(
            "event_id",
            *EVENTS_CLEAN_PARTITIONS,
            (mine < theirs).alias("beaten"),
            F.col("new_start").eqNullSafe(F.col("start_time_utc")).alias("tied"),
        ).write.parquet(f"{work}/met")
        met = spark.read.parquet(f"{work}/met")

        tied = met.where("tied")
        ties = held.where(_in_months(_months(tied))).join(
            tied.select("event_id", *EVENTS_CLEAN_PARTITIONS).distinct(), "event_id", "left_semi"
        )
        refused = met.where(~F.col("beaten") & ~F.col("tied")).select("event_id").union(
            refused_copies(new, ties.select(*new.columns))
        )
        new.join(refused, "event_id", "left_anti").write.parquet(f"{work}/accepted")
        accepted = spark.read.parquet(f"{work}/accepted")

        # all months of ids with a beaten row, as a failed run may have left one in two
        beaten = met.where("beaten").select("event_id").distinct()
        changed = _months(enrich_events(accepted)) | _months(met.join(beaten, "event_id", "left_semi"))
        if not changed:
            return changed
        rows = held.where(_in_months(changed)).select(*new.columns).union(accepted)
        # the changed months are put in place when all of them are written, so they may be read till then
        seen = Observation()
        made = enrich_events(first_events(rows, typed=True)).observe(seen, _present())
        write_partitioned(made, target)
        for month in changed - {tuple(m) for m in seen.get["months"]}:
            session.remove_folder(spark, _folder(target, month))
        return changed
    finally:
        session.remove_folder(spark, work)
