"""JDBC output: full refresh, append, and staged upsert."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

POSTGRES_DRIVER = "org.postgresql.Driver"


@dataclass(frozen=True)
class JdbcTarget:
    """Where and how to write; ``distribute_by`` spreads the rows over connections."""

    url: str
    table: str
    user: str
    password: str = field(repr=False)
    driver: str = POSTGRES_DRIVER
    batch_size: int = 10_000
    connections: int | None = None
    truncate: bool = True

    def options(self) -> dict[str, str]:
        """Writer options.

        ``truncate`` makes an overwrite empty the table instead of dropping it, so
        the table keeps its keys and its distribution.
        """
        return {
            "url": self.url,
            "dbtable": self.table,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "batchsize": str(self.batch_size),
            "truncate": str(self.truncate).lower(),
        }


def write_jdbc(
    df: DataFrame, target: JdbcTarget, mode: str = "overwrite", distribute_by: Sequence[str] = ()
) -> None:
    """Write from the executors, grouped by the table's distribution key."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    placed(df, target, distribute_by).write.format("jdbc").options(**target.options()).mode(
        mode
    ).save()


def placed(df: DataFrame, target: JdbcTarget, distribute_by: Sequence[str]) -> DataFrame:
    """Rebalanced by the key, so one busy key may use several connections."""
    parts = [target.connections] if target.connections else []
    return df.hint("rebalance", *parts, *distribute_by) if distribute_by else df


def merge_statement(table: str, staging: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """Set-based upsert from a staging table, in standard ``MERGE`` syntax."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    updates = ", ".join(f"{c} = s.{c}" for c in columns if c not in keys)
    return (
        f"MERGE INTO {table} t USING {staging} s ON {on} "
        f"WHEN MATCHED THEN UPDATE SET {updates} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) "
        f"VALUES ({', '.join(f's.{c}' for c in columns)})"
    )


def append_sink(target: JdbcTarget) -> Callable[[DataFrame, int], None]:
    """Micro-batch sink that appends."""
    return lambda batch, _epoch: write_jdbc(batch, target, "append")


def statement_runner(connect: Callable[[], object]) -> Callable[[str], None]:
    """Runs single statements over DB-API connections made by ``connect``."""

    def execute(statement: str) -> None:
        connection = connect()
        try:
            connection.cursor().execute(statement)
            connection.commit()
        finally:
            connection.close()

    return execute


def upsert_sink(
    target: JdbcTarget,
    staging: JdbcTarget,
    keys: Sequence[str],
    execute: Callable[[str], None],
) -> Callable[[DataFrame, int], None]:
    """Micro-batch sink: executors fill the staging table, one ``MERGE`` applies it.

    ``execute`` runs a statement on the database.  Rows never pass the driver,
    and replaying a batch gives the same table.
    """

    def write(batch: DataFrame, _epoch: int) -> None:
        write_jdbc(batch, staging, "overwrite")
        execute(merge_statement(target.table, staging.table, keys, batch.columns))

    return write
