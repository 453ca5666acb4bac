"""``events_clean`` to a curated table, written to JDBC or Parquet.

    spark-submit -m stormgauge.plans.publish exposure_hours_daily \\
        --input hdfs:///data/weather/clean/events_clean --parquet hdfs:///data/curated
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgauge.contracts import TABLES, Table, conform, require
from stormgauge.functions.weather import require_vocabulary
from stormgauge.operators.cooccurrence import cooccurrence_minutes_daily
from stormgauge.operators.exposure import exposure_hours_daily
from stormgauge.operators.peaks import peak_exposure_daily
from stormgauge.operators.seasons import (
    monthly_trend_by_type,
    night_storm_risk,
    winter_phenology,
    winter_workload_index,
)
from stormgauge.operators.sequences import risky_sequences
from stormgauge.operators.sessions import longest_episodes, winter_burstiness
from stormgauge.session import build_session, remove_folder, shared_folder
from stormgauge.sinks.jdbc import JdbcTarget, write_jdbc
from stormgauge.sinks.versions import write_snapshot
from stormgauge.sources.files import read_events


Months = tuple[str, str]
#: days behind a period that are read along; a result never needs all of them
AHEAD_DAYS = {"month": 3, "season": 60}


@dataclass(frozen=True)
class Job:
    """A curated table and the operator that builds it from the cleaned events.

    ``period`` names what a row belongs to: ``month`` (of ``dated``: a date or time column,
    or year and month) or ``season``; a table without one can only be built as a whole.
    ``history_days`` says how far before a period a row looks back at events, whatever
    their length; ``None`` is without limit, as for measures that go by earlier rows.
    """

    table: Table
    build: Callable[..., DataFrame]
    period: str | None = None
    dated: tuple[str, ...] = ()
    history_days: int | None = None
    #: whether types are paired, which needs a vocabulary of a bounded size
    pairs_types: bool = False

    def run(self, events: DataFrame, **parameters) -> DataFrame:
        return conform(self.build(events, **parameters), self.table)

    def staged(self, events: DataFrame, path: str, **parameters) -> DataFrame:
        """Compute once into ``path``, check what was written and return it.

        The check and the final write read the small staged result, so the events
        are scanned a single time and nothing is published that breaks a key.
        """
        self.run(events, **parameters).write.mode("overwrite").parquet(path)
        result = events.sparkSession.read.parquet(path)
        require(result, self.table)
        return result

    def with_period(self, result: DataFrame) -> DataFrame:
        """Adds ``period``: year and month as one number, or the year of the season."""
        if self.period == "season":
            return result.withColumn("period", F.col("season_year"))
        if len(self.dated) == 2:
            year, month = (F.col(c) for c in self.dated)
        else:
            year, month = F.year(self.dated[0]), F.month(self.dated[0])
        return result.withColumn("period", year * 100 + month)

    def periods(self, months: Months) -> list[int]:
        """The periods that a range of months touches."""
        (first_year, first_month), (last_year, last_month) = (_year_and_month(m) for m in months)
        touched = range(first_year * 12 + first_month - 1, last_year * 12 + last_month)
        parts = [(m // 12, m % 12 + 1) for m in touched]
        if self.period == "season":
            return sorted({year + (month == 12) for year, month in parts if month in (12, 1, 2)})
        return [year * 100 + month for year, month in parts]

    def events_for(self, events: DataFrame, months: Months) -> DataFrame:
        """All events a period's rows depend on: those that reach into it or its look-back."""
        periods = self.periods(months)
        if not periods:
            return events.where(F.lit(False))
        if self.period == "season":
            first, last = f"{periods[0] - 1}-12-01", f"{periods[-1]}-03-01"
        else:
            first = f"{periods[0] // 100}-{periods[0] % 100:02d}-01"
            last = f"{periods[-1] // 100}-{periods[-1] % 100:02d}-28"
        after = F.date_add(F.to_date(F.lit(last)), AHEAD_DAYS[self.period] + 4)
        found = events.where(F.col("local_start_ts") < after.cast("timestamp_ntz"))
        if self.history_days is None:
            return found
        before = F.date_sub(F.to_date(F.lit(first)), self.history_days).cast("timestamp_ntz")
        # an end may lie before its start; rows count from where either reaches
        return found.where((F.col("local_end_ts") >= before) | (F.col("local_start_ts") >= before))

    def partitions_for(self, events: DataFrame, months: Months) -> DataFrame:
        """Events without the partitions (UTC months) behind all that a period depends on.

        There is no bound the other way, as an event may run on for any time.
        """
        if not {"event_year", "event_month"} <= set(events.columns):
            return events
        last = max(12 * y + m for y, m in map(_year_and_month, months))
        ahead = last + 1 + (AHEAD_DAYS[self.period] + 34) // 28
        return events.where(F.col("event_year") * 12 + F.col("event_month") <= ahead)


def _year_and_month(text: str) -> tuple[int, int]:
    return int(text[:4]), int(text[5:7])


_JOBS = (
    # a row sums up to 89 days before its own
    Job(TABLES["exposure_hours_daily"], exposure_hours_daily, "month", ("event_date",), 89),
    # the longest of all time
    Job(TABLES["longest_episodes"], longest_episodes),
    Job(
        TABLES["cooccurrence_minutes_daily"],
        cooccurrence_minutes_daily,
        "month",
        ("event_date",),
        1,
        pairs_types=True,
    ),
    Job(TABLES["peak_exposure_3h_daily"], peak_exposure_daily, "month", ("event_date",), 1),
    # the change looks at the month before
    Job(TABLES["monthly_risk_trend_by_type"], monthly_trend_by_type, "month", ("year", "month"), 31),
    # changes and means by earlier rows, however long ago
    Job(TABLES["winter_workload_index"], winter_workload_index, "month", ("year", "month")),
    Job(TABLES["risky_sequences"], risky_sequences, "month", ("seq_start_ts",), 1),
    Job(TABLES["winter_burstiness"], winter_burstiness, "season"),
    Job(TABLES["night_thunderstorm_risk"], night_storm_risk, "month", ("year", "month")),
    Job(TABLES["winter_fenology"], winter_phenology, "season"),
)
JOBS = {job.table.name: job for job in _JOBS}


def publish(
    job: Job,
    events: DataFrame,
    staging: str,
    parquet: str | None = None,
    jdbc: Callable[[DataFrame], None] | None = None,
    months: Months | None = None,
    snapshots: bool = False,
    **parameters,
) -> None:
    """Build a table and write it to a folder, to a database, or both.

    Files lie in one folder per period.  With ``months`` the look-back is read, but only
    the rows of that range are written, and only their folders are replaced; a period
    that has no rows any more loses its folder.  With ``snapshots`` the files are a version of
    their own that readers see once it is whole.  The staged result is deleted at the end.
    """
    if months:
        if job.period is None:
            raise ValueError(f"{job.table.name} can only be built as a whole")
        if jdbc:
            raise ValueError("a period can only be replaced in files")
        if snapshots:
            raise ValueError("a snapshot is always of the whole table")
    spark = events.sparkSession
    if months:
        events = job.partitions_for(events, months)
    # two columns of the table; such events have no part in any measure
    unknown = events.where(F.col("local_start_ts").isNull() | F.col("local_end_ts").isNull()).count()
    if unknown:
        print(f"{job.table.name}: {unknown} events without a known start or end are left out")
    if job.pairs_types:
        require_vocabulary(events)
    source = job.events_for(events, months) if months else events
    try:
        result = job.staged(source, staging, **parameters)
        if jdbc:
            jdbc(result)
        if parquet and snapshots:
            write_snapshot(result, parquet)
        elif parquet and job.period is None:
            result.write.mode("overwrite").parquet(parquet)
        elif parquet:
            rows = job.with_period(result)
            wanted = job.periods(months) if months else None
            if months:
                rows = rows.where(F.col("period").isin(wanted))
            mode = "dynamic" if months else "static"
            rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(
                "period"
            ).parquet(parquet)
            if months:
                there = {r.period for r in rows.select("period").distinct().collect()}
                for period in set(wanted) - there:
                    remove_folder(spark, f"{parquet}/period={period}")
    finally:
        remove_folder(spark, staging)


def main(argv: list[str] | None = None) -> None:
    cli = argparse.ArgumentParser(description=__doc__)
    # Names of the job and its options, as other jobs call them.
    cli.add_argument("job", choices=sorted(JOBS))
    cli.add_argument("--input", required=True, help="path of events_clean")
    cli.add_argument(
        "--months", nargs=2, metavar="YYYY-MM", help="replace only the rows of these local months"
    )
    cli.add_argument("--parquet", help="write to a folder of this name under the given path")
    cli.add_argument("--snapshots", action="store_true", help="write each run as a version of its own")
    cli.add_argument("--jdbc-url")
    cli.add_argument("--dbtable")
    cli.add_argument("--dbuser")
    cli.add_argument("--dbpassword")
    cli.add_argument("--jdbc-mode", default="overwrite", choices=["overwrite", "append"])
    cli.add_argument("--gap-threshold-hours", type=float, help="winter_burstiness")
    cli.add_argument("--min-episode-hours", type=float, help="winter_burstiness")
    cli.add_argument("--winter-types", help="winter_fenology, comma separated")
    args = cli.parse_args(argv)
    if not (args.parquet or args.jdbc_url):
        cli.error("give --parquet or --jdbc-url, or both")
    job = JOBS[args.job]
    if args.months and (job.period is None or args.jdbc_url):
        cli.error("--months needs a table with periods and goes to files only")
    if args.snapshots and (args.months or not args.parquet):
        cli.error("--snapshots writes whole tables to files")

    spark = build_session(f"publish_{args.job}")
    target = JdbcTarget(
        args.jdbc_url, args.dbtable or f"curated.{args.job}", args.dbuser, args.dbpassword
    )
    publish(
        job,
        read_events(spark, args.input),
        shared_folder(spark, args.job),
        f"{args.parquet.rstrip('/')}/{args.job}" if args.parquet else None,
        (lambda rows: write_jdbc(rows, target, args.jdbc_mode, [job.table.place]))
        if args.jdbc_url
        else None,
        tuple(args.months) if args.months else None,
        snapshots=args.snapshots,
        **_parameters(args),
    )


def _parameters(args: argparse.Namespace) -> dict:
    parameters = {}
    if args.job == "winter_burstiness":
        if args.gap_threshold_hours is not None:
            parameters["gap_hours"] = args.gap_threshold_hours
        if args.min_episode_hours is not None:
            parameters["long_hours"] = args.min_episode_hours
    if args.job == "winter_fenology" and args.winter_types:
        parameters["winter_types"] = [t for t in args.winter_types.split(",") if t.strip()]
    return parameters


if __name__ == "__main__":
    main()
