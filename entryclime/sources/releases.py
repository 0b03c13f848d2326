"""Write, audit, publish: the tables of a run become visible together, and only after their checks.

A run stages its tables in a folder of its own. An audit looks at the staged files; if it passes, one entry is added to
the release log, and from then on readers find the new tables. If it fails, or the run dies, the log still names the
release before, whose tables are untouched.

    root/releases/<id>/<table>/...   the tables of one run, and manifest.json
    root/log/<number>                the id of a published release; the highest complete entry is the current one

An entry is created exclusively (a second publisher of the same number fails) and counts once its line is complete, so a
reader sees the old release or the new one, never a mixture. Readers that hold a release keep reading it: ``prune``
keeps the newest releases, and staged folders that are younger than its grace period.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from entryclime.operators import quality
from entryclime.sources import writers

Audit = Callable[[dict[str, DataFrame]], DataFrame]


class PublishConflict(RuntimeError):
    """Another run published while this one was staging."""


@dataclass(frozen=True)
class Release:
    """A published release: its number in the log, its tables' folders and their rows."""

    number: int
    id: str
    tables: dict[str, str]
    rows: dict[str, int]

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(self.tables[table])


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _text(spark: SparkSession, path: str) -> str:
    fs, p = _hadoop(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not exist."""
    fs, p = _hadoop(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _entries(spark: SparkSession, root: str) -> list[int]:
    fs, p = _hadoop(spark, f"{root}/log")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n) for n in names if n.isdigit())


def _release(spark: SparkSession, root: str, number: int) -> Release | None:
    line = _text(spark, f"{root}/log/{number:010d}")
    if not line.endswith("\n"):
        return None  # being written, or its writer died
    manifest = json.loads(_text(spark, f"{root}/releases/{line.strip()}/manifest.json"))
    return Release(number, line.strip(), manifest["tables"], manifest["rows"])


def history(spark: SparkSession, root: str) -> list[Release]:
    """All published releases, oldest first."""
    return [r for n in _entries(spark, root) if (r := _release(spark, root, n))]


def current(spark: SparkSession, root: str) -> Release | None:
    """The newest published release."""
    for number in reversed(_entries(spark, root)):
        if release := _release(spark, root, number):
            return release
    return None


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the newest release."""
    release = current(spark, root)
    if release is None:
        raise LookupError(f"nothing is published under {root}")
    return release.read(spark, table)


class Staging:
    """The tables of one run before they are published.

    ``carry`` takes over a table of the release before as it is, without copying it.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.before = current(spark, self.root)
        self.id = uuid.uuid4().hex
        self.tables: dict[str, str] = {}

    def write(self, table: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """Stage a table and read it back, so that later steps build on the files that will be published."""
        path = f"{self.root}/releases/{self.id}/{table}"
        writers.write_parquet(df, path, partition_by, mode="errorifexists")
        self.tables[table] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def carry(self, table: str) -> DataFrame:
        if self.before is None or table not in self.before.tables:
            raise LookupError(f"no published table {table} to carry over")
        self.tables[table] = self.before.tables[table]
        return self.before.read(self.spark, table)

    def publish(self, audit: Audit | None = None, min_rows: int = 1, least_share: float = 0.0) -> Release:
        """Audit the staged tables and make them the current release.

        Every table needs ``min_rows`` rows, and at least ``least_share`` of its rows in the release before. ``audit``
        gives further checks (``table_name, n_rows, passed``). Raises ``QualityCheckError`` if one fails and
        ``PublishConflict`` if another run has published since this one began; in both cases nothing changes for readers.
        """
        rows = quality.file_row_counts(self.spark, self.tables)
        old = self.before.rows if self.before else {}
        failed = {t: n for t, n in rows.items() if n < min_rows or n < least_share * old.get(t, 0)}
        if failed:
            raise quality.QualityCheckError("data quality check failed: " + ", ".join(
                f"{t} ({n} rows, {old.get(t, 0)} before)" for t, n in sorted(failed.items())))
        if audit is not None:
            quality.assert_quality(audit({t: self.spark.read.parquet(p) for t, p in self.tables.items()}))
        _create(self.spark, f"{self.root}/releases/{self.id}/manifest.json",
                json.dumps({"tables": self.tables, "rows": rows}))
        base = self.before.number if self.before else 0
        newest = current(self.spark, self.root)
        if newest is not None and newest.number > base:
            raise PublishConflict(f"release {newest.number} was published after release {base}")
        number = max([base, *_entries(self.spark, self.root)]) + 1
        try:
            _create(self.spark, f"{self.root}/log/{number:010d}", f"{self.id}\n")
        except Py4JJavaError as e:
            raise PublishConflict(f"release {number} is being published by another run") from e
        return Release(number, self.id, dict(self.tables), rows)


def prune(spark: SparkSession, root: str, keep: int = 2, grace_seconds: float = 86_400) -> list[str]:
    """Delete the folders that none of the ``keep`` newest releases uses and that are older than the grace period."""
    root = root.rstrip("/")
    used = {path for r in history(spark, root)[-keep:] for path in r.tables.values()}
    fs, p = _hadoop(spark, f"{root}/releases")
    gone = []
    for status in fs.listStatus(p) if fs.exists(p) else []:
        folder = f"{root}/releases/{status.getPath().getName()}"
        young = status.getModificationTime() / 1000 > time.time() - grace_seconds
        if not young and not any(path.startswith(f"{folder}/") for path in used):
            fs.delete(status.getPath(), True)
            gone.append(folder)
    return gone
