"""Raw CSV of a run date to the partitioned ``events_clean`` table.

    spark-submit -m stormgauge.plans.transform --run-date 2025-09-01 \\
        --raw-base hdfs:///data/weather/raw --out-base hdfs:///data/weather/clean
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from stormgauge.operators.cleaning import clean_events, rejected_events
from stormgauge.session import build_session, shared_folder
from stormgauge.sinks.merge import merge_events
from stormgauge.sinks.parquet import register_external_table, write_partitioned
from stormgauge.sources.files import dated_path, read_raw


def run(
    spark: SparkSession,
    run_date: str,
    raw_base: str,
    out_base: str,
    table: str | None = None,
    merge: bool = False,
) -> str:
    """Clean one landing folder; returns the path of the written table.

    Months in the folder are overwritten; with ``merge`` its events are merged into the
    table instead, as far as other run dates do not hold earlier copies of them.
    Rows that cannot become events go to ``events_rejected``, a folder per run date.
    """
    base = out_base.rstrip("/")
    target = f"{base}/events_clean"
    raw = read_raw(spark, dated_path(raw_base, run_date))
    rejected_events(raw).write.mode("overwrite").parquet(dated_path(f"{base}/events_rejected", run_date))
    if merge:
        merge_events(spark, raw, target, shared_folder(spark, "merge"))
    else:
        write_partitioned(clean_events(raw), target)
    if table:
        register_external_table(spark, table, target)
    return target


def main(argv: list[str] | None = None) -> None:
    cli = argparse.ArgumentParser(description=__doc__)
    cli.add_argument("--run-date", required=True)
    cli.add_argument("--raw-base", required=True)
    cli.add_argument("--out-base", required=True)
    cli.add_argument("--table", help="catalog table to create or refresh")
    cli.add_argument("--merge", action="store_true", help="keep the events of other run dates")
    args = cli.parse_args(argv)
    spark = build_session(f"transform_{args.run_date}")
    run(spark, args.run_date, args.raw_base, args.out_base, args.table, args.merge)


if __name__ == "__main__":
    main()
