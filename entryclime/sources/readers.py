"""Readers: typed CSV / delimited / code-book / monthly parquet / staged JSON scans.

Every reader takes an explicit schema, so no inference pass runs over the
data and partition values such as ``"007"`` keep their string type.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from entryclime.functions import text
from entryclime.session import write_stage


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType, header: bool = True,
             sep: str = ",", drop: list[str] | None = None) -> DataFrame:
    """Headed (or headerless) CSV with a given schema; ``sep`` may be several characters."""
    df = spark.read.schema(schema).option("header", header).option("sep", sep).csv(path)
    return df.drop(*(drop or []))


BAD_RECORD = "_bad_record"


def read_csv_checked(spark: SparkSession, path: str | list[str], schema: StructType, header: bool = True,
                     sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Headed or headerless CSV as its good rows and a quarantine table ``(file, reason, record)`` of all other lines.

    A line is bad if it has too few or too many fields (reason ``fields``) or a field that is not of its type
    (``value``). The files are parsed once, into a stage that both results read, so good and bad rows add up to the
    lines. Separators inside quotes count as separators when the reason is told.
    """
    checked = StructType([*schema.fields, StructField(BAD_RECORD, StringType())])
    raw = (spark.read.schema(checked).option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", BAD_RECORD).csv(path))
    parsed = write_stage(raw.withColumn("_file", F.col("_metadata.file_path")), "checked_lines")
    fields = F.size(F.split(BAD_RECORD, f"\\Q{sep}\\E", -1))
    bad = parsed.where(F.col(BAD_RECORD).isNotNull()).select(
        F.col("_file").alias("file"), F.when(fields == len(schema), "value").otherwise("fields").alias("reason"),
        F.col(BAD_RECORD).alias("record"))
    return parsed.where(F.col(BAD_RECORD).isNull()).select(schema.names), bad


def read_code_book(spark: SparkSession, path: str, sep: str = "\t=\t",
                   key: str = "code", value: str = "value") -> DataFrame:
    """Headerless ``'KEY' = 'VALUE'`` lines -> (key, value) with quotes and blanks removed."""
    from entryclime.schemas import CODE_BOOK

    raw = read_csv(spark, path, CODE_BOOK, header=False, sep=sep)
    return raw.select(text.remove_quotes("code").alias(key), text.remove_quotes("value").alias(value))


def read_parquet(spark: SparkSession, path: str | list[str], schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    paths = [path] if isinstance(path, str) else path
    return reader.parquet(*paths)


def month_starts(first: str, last: str) -> list[_dt.date]:
    """First days of every month from ``first`` to ``last`` (ISO dates, inclusive)."""
    d = _dt.date.fromisoformat(first).replace(day=1)
    end = _dt.date.fromisoformat(last)
    out = []
    while d <= end:
        out.append(d)
        d = (d.replace(day=28) + _dt.timedelta(days=4)).replace(day=1)
    return out


def monthly_paths(root: str, months: list[_dt.date], template: str = "i94_{token}_sub.parquet") -> list[str]:
    """``root/i94_apr16_sub.parquet``-style paths for a list of months."""
    return [f"{root.rstrip('/')}/{template.format(token=m.strftime('%b%y').lower())}" for m in months]


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that exist, asked of their file system by the driver (one question per path)."""
    found = []
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            found.append(path)
    return found


def read_months(spark: SparkSession, root: str, first: str, last: str, schema: StructType,
                template: str = "i94_{token}_sub.parquet", skip_missing: bool = False) -> DataFrame:
    """All monthly raw files of a range in ONE scan; extra (drifting) columns are ignored.

    A month without a file is an error unless ``skip_missing`` says it has no rows.
    """
    paths = monthly_paths(root, month_starts(first, last), template)
    paths = existing(spark, paths) if skip_missing else paths
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def with_file_token(df: DataFrame, pattern: str, name: str, group: int = 1) -> DataFrame:
    """Add a column taken from each row's source file path (e.g. the month in the name)."""
    return df.withColumn(name, F.regexp_extract(F.col("_metadata.file_path"), pattern, group))


def staged_path(root: str, key: str, when: _dt.date) -> str:
    """``root/events/2024/01``-style path of a staging key such as ``events/{year}/{month:02d}``."""
    return f"{root.rstrip('/')}/{key.format(year=when.year, month=when.month, day=when.day)}"


def read_json_staged(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON objects with a given schema (the staging step of a warehouse copy)."""
    return spark.read.schema(schema).json(path)
