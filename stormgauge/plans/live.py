"""Readings feed to a live table, as a keyed changelog or to JDBC.

    spark-submit -m stormgauge.plans.live weather_realtime_sliding \\
        --kafka broker1:9092 --changelog hdfs:///data/live/sliding \\
        --checkpoint hdfs:///data/live/_checkpoints/sliding
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stormgauge.contracts import TABLES, Table, conform
from stormgauge.functions.calendar import DAY_SECONDS, bucket_number
from stormgauge.session import build_session
from stormgauge.sinks.changelog import changelog_sink
from stormgauge.sinks.jdbc import JdbcTarget, append_sink, statement_runner, upsert_sink
from stormgauge.sinks.ledger import once_per_epoch
from stormgauge.sinks.ranged import RangedTable
from stormgauge.sources.files import read_airports
from stormgauge.sources.readings import (
    failed_messages,
    file_messages,
    good_readings,
    kafka_messages,
    route_readings,
)
from stormgauge.sources.schemas import READING_SCHEMA
from stormgauge.streaming import kpis
from stormgauge.streaming.late import Span, late_split_sink, on_time_stream
from stormgauge.streaming.runner import BatchSink, await_all, console_sink, start

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class LiveJob:
    """A live table and the KPI function that fills it."""

    table: Table
    build: Callable[..., DataFrame]
    span: Span

    def merged_table(self, spark: SparkSession, path: str) -> RangedTable:
        """The table merged on reading; a day of windows is a place."""
        start = next(f.name for f in self.table.schema if f.name.endswith("_start"))
        place = bucket_number(F.unix_seconds(start), DAY_SECONDS)
        return RangedTable(spark, path, self.table.key, place)

    @property
    def required(self) -> tuple[str, ...]:
        """Key columns of the table that come from the message itself."""
        fields = StructType.fromDDL(READING_SCHEMA).names
        return tuple(k for k in self.table.key if k in fields)

    def start(
        self,
        messages: DataFrame,
        airports: DataFrame | None,
        sinks: Sequence[BatchSink],
        checkpoint: str,
        available_now: bool = False,
    ) -> StreamingQuery:
        """Stream text messages through the KPI into the sinks, in update mode.

        A window is emitted again whenever it changes, so sinks must be keyed.  Messages
        that are no readings, or lack a key of the table, are left out here;
        :func:`start_dead_letters` keeps them.
        """

        return self.start_readings(self.good(messages), airports, sinks, checkpoint, available_now)

    def good(self, messages: DataFrame) -> DataFrame:
        """Parsed readings that have what the table's key needs."""
        return good_readings(route_readings(messages, required=self.required))

    def start_readings(
        self,
        readings: DataFrame,
        airports: DataFrame | None,
        sinks: Sequence[BatchSink],
        checkpoint: str,
        available_now: bool = False,
    ) -> StreamingQuery:
        """As :meth:`start`, for parsed readings."""

        def conforming(sink: BatchSink) -> BatchSink:
            return lambda batch, epoch: sink(conform(batch, self.table), epoch)

        result = self.build(readings, airports)
        return start(
            result,
            [conforming(s) for s in sinks],
            checkpoint,
            available_now=available_now,
            name=self.table.name,
        )


def start_dead_letters(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    required: Sequence[str] = ("airport_code",),
) -> StreamingQuery:
    """Append the text of messages that fail to a folder, by epoch; ``required`` as in routing."""
    return start(
        failed_messages(route_readings(messages, required=required)),
        [changelog_sink(path)],
        checkpoint,
        mode="append",
        available_now=available_now,
        name="dead_letters",
    )


# delay, width and slide as in the KPIs
_SLIDING = Span(900, 7200, 1800)

LIVE_JOBS = {
    name: LiveJob(TABLES[name], build, span)
    for name, (build, span) in {
        "weather_events_realtime": (kpis.tumbling_means, Span(600, 18000, 18000)),
        "weather_realtime_sliding": (kpis.sliding_kpis, _SLIDING),
        "weather_state_analytics": (kpis.state_volatility, Span(86400, 21600, 21600)),
        "weather_realtime_radiation": (kpis.radiation_kpis, _SLIDING),
        "weather_realtime_instability": (kpis.instability, _SLIDING),
    }.items()
}


def main(argv: list[str] | None = None) -> None:
    cli = argparse.ArgumentParser(description=__doc__)
    cli.add_argument("job", choices=sorted(LIVE_JOBS))
    source = cli.add_mutually_exclusive_group(required=True)
    source.add_argument("--kafka", metavar="SERVERS")
    source.add_argument("--folder", help="folder of JSON-line files")
    cli.add_argument("--topic", default="weather_raw")
    cli.add_argument("--starting-offsets", default="latest", help="where a new query begins")
    cli.add_argument("--offsets-per-batch", type=int, default=1_000_000)
    cli.add_argument("--files-per-batch", type=int, default=100)
    cli.add_argument("--dead-letters", help="folder of bad messages; default: beside the checkpoint")
    cli.add_argument("--late", metavar="FOLDER", help="keep readings that come too late there")
    cli.add_argument("--airports", help="airport dimension CSV")
    cli.add_argument("--checkpoint", required=True)
    cli.add_argument("--changelog", help="folder of the keyed changelog")
    cli.add_argument("--merged-table", metavar="FOLDER", help="keyed table merged when it is read")
    cli.add_argument("--jdbc-url")
    cli.add_argument("--dbtable")
    cli.add_argument("--dbuser")
    cli.add_argument("--dbpassword")
    cli.add_argument("--jdbc-mode", default="upsert", choices=["upsert", "append"])
    cli.add_argument("--console", action="store_true", help="also without another sink")
    cli.add_argument("--console-rows", type=int, default=20, help="rows shown of a micro-batch")
    cli.add_argument("--available-now", action="store_true", help="stop when caught up")
    args = cli.parse_args(argv)

    spark = build_session(f"live_{args.job}")
    # window state on local disk instead of the executors' heap
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    job = LIVE_JOBS[args.job]
    sinks: list[BatchSink] = []
    if args.changelog:
        sinks.append(changelog_sink(args.changelog))
    if args.merged_table:
        sinks.append(job.merged_table(spark, args.merged_table).add_epoch)
    if args.jdbc_url and args.jdbc_mode == "append":
        # every version of a window, for tables without a key
        ledger = f"{args.checkpoint.rstrip('/')}-appended"
        sinks.append(once_per_epoch(append_sink(_target(args)), ledger))
    elif args.jdbc_url:
        sinks.append(_database_sink(args, job))
    if args.console or not sinks:
        sinks.append(console_sink(args.console_rows))
    messages = (
        kafka_messages(
            spark, args.kafka, args.topic, args.starting_offsets, args.offsets_per_batch
        )
        if args.kafka
        else file_messages(spark, args.folder, args.files_per_batch)
    )
    airports = read_airports(spark, args.airports) if args.airports else None
    place = args.checkpoint.rstrip("/")
    dead_letters = start_dead_letters(
        messages,
        args.dead_letters or f"{place}-dead-letters",
        f"{place}-dead-letters-checkpoint",
        args.available_now,
        job.required,
    )
    if not args.late:
        query = job.start(messages, airports, sinks, args.checkpoint, args.available_now)
        await_all([query, dead_letters])
        return
    folder, readings = args.late.rstrip("/"), job.good(messages)
    split = start(
        readings,
        [late_split_sink(folder, job.span)],
        f"{place}-late-checkpoint",
        "append",
        args.available_now,
        name="late",
    )
    if args.available_now:
        await_all([split])  # only then is there all that the KPI shall read
    on_time = on_time_stream(spark, folder, readings.schema)
    query = job.start_readings(on_time, airports, sinks, args.checkpoint, args.available_now)
    await_all([query, dead_letters, split])


def _target(args: argparse.Namespace) -> JdbcTarget:
    table = args.dbtable or f"curated.{args.job}"
    return JdbcTarget(args.jdbc_url, table, args.dbuser, args.dbpassword)


def _database_sink(args: argparse.Namespace, job: LiveJob) -> BatchSink:
    """Staged upsert; the driver only sends the ``MERGE`` statement."""
    import psycopg2  # optional, only for this sink

    target = _target(args)
    dsn = args.jdbc_url.removeprefix("jdbc:")
    run = statement_runner(
        lambda: psycopg2.connect(dsn, user=args.dbuser, password=args.dbpassword)
    )
    return upsert_sink(target, replace(target, table=f"{target.table}_staging"), job.table.key, run)


if __name__ == "__main__":
    main()
