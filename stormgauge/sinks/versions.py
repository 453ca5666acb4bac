"""Versions of a table: a new one appears at once and whole, or not at all.

Below the table's folder lies ``_versions`` with one small file per version, whose text says
what the version consists of.  A version file is written under another name and then renamed,
which a file system does at once and for one writer only; it must be one whose rename does so
(HDFS and local disks do, bare object stores do not).
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from stormgauge.session import remove_folder

VERSIONS = "_versions"


class Conflict(RuntimeError):
    """Another writer made this version first."""


def _hadoop(spark: SparkSession, path: str):
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return fs, folder.getFileSystem(conf), fs.FileContext.getFileContext(folder.toUri(), conf)


def versions(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the versions that are kept, ascending."""
    fs, system, _ = _hadoop(spark, table)
    folder = fs.Path(f"{table}/{VERSIONS}")
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return sorted(int(name) for name in names if name.isdigit())


def commit(spark: SparkSession, table: str, version: int, text: str) -> None:
    """Make ``version``; raises :class:`Conflict` if there is one of that number already."""
    fs, system, context = _hadoop(spark, table)
    folder = f"{table}/{VERSIONS}"
    draft, final = fs.Path(f"{folder}/.{uuid.uuid4().hex}"), fs.Path(f"{folder}/{version:020d}")
    out = system.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not _renamed(spark, fs, context, draft, final):
        system.delete(draft, False)
        raise Conflict(f"{table} has a version {version}")


def _renamed(spark: SparkSession, fs, context, source, target) -> bool:
    none = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        context.rename(source, target, none)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def move_once(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder unless there is one at ``target``, which then stays; says whether it did."""
    fs, system, context = _hadoop(spark, target)
    ensure_folder(spark, target.rsplit("/", 1)[0])
    # a rename may replace an empty folder, and a written one never is empty
    if not system.exists(fs.Path(target)) and _renamed(spark, fs, context, fs.Path(source), fs.Path(target)):
        return True
    remove_folder(spark, source)
    return False


def ensure_folder(spark: SparkSession, path: str) -> None:
    fs, system, _ = _hadoop(spark, path)
    system.mkdirs(fs.Path(path))


def version_text(spark: SparkSession, table: str, version: int) -> str:
    """What was committed as ``version``."""
    fs, system, _ = _hadoop(spark, table)
    stream = system.open(fs.Path(f"{table}/{VERSIONS}/{version:020d}"))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def forget(spark: SparkSession, table: str, version: int) -> None:
    """Drop a version's file; what it points at is left alone."""
    remove_folder(spark, f"{table}/{VERSIONS}/{version:020d}")


def write_snapshot(df: DataFrame, table: str, keep: int = 2) -> int:
    """Publish ``df`` as the table's next version and return its number.

    Rows go to a folder of their own, and readers see them once all are written: a run that is
    cut off leaves the version before as it was.  The last ``keep`` versions stay readable,
    folders of older ones are deleted.  Of two writers at a time the later one raises.
    """
    spark = df.sparkSession
    if keep < 1:
        raise ValueError("the newest version cannot be dropped")
    held = versions(spark, table)
    folder = f"snapshot-{uuid.uuid4().hex}"
    number = held[-1] + 1 if held else 1
    try:
        df.write.parquet(f"{table}/{folder}")
        commit(spark, table, number, folder)
    except BaseException:
        remove_folder(spark, f"{table}/{folder}")
        raise
    for old in [*held, number][:-keep]:
        left = version_text(spark, table, old)
        forget(spark, table, old)
        remove_folder(spark, f"{table}/{left}")
    return number


def read_snapshot(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The newest version, or the one a reader has pinned by its number."""
    held = versions(spark, table)
    if not held or (version is not None and version not in held):
        raise ValueError(f"{table} has no version {'' if version is None else version}".rstrip())
    return spark.read.parquet(f"{table}/{version_text(spark, table, version or held[-1])}")
