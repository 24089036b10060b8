"""Batch file sources."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table_path(base_dir: str, name: str) -> str:
    return os.path.join(base_dir, f"{name}.parquet")


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """A parquet table; projections and filters applied later reach the scan."""
    return spark.read.parquet(table_path(base_dir, name))


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path (any store that Spark reads), and the path in it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _file_system(spark, path)
    return fs.getFileStatus(hadoop).isDirectory()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _file_system(spark, path)
    return fs.exists(hadoop)


def read_lines(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    """Lines of text files as ``value: string`` (one row per line). Lines end with LF, CR LF or CR, or with ``line_sep`` only."""
    return spark.read.text(path, lineSep=line_sep)


def write_lines(lines: DataFrame, path: str) -> str:
    """Write a one-column table as a folder of text files, a line (LF) for each row; returns the path."""
    lines.write.text(path, lineSep="\n")
    return path


def parse_delimited(lines: DataFrame, schema: StructType, sep: str = ",",
                    value_col: str = "value") -> DataFrame:
    """Split each line on a literal one-character ``sep`` and cast field *i*
    to the *i*-th schema type. Extra fields are ignored and a missing field is
    NULL; a field that does not cast raises (ANSI), as ``parseInt`` would.
    No quoting rules: this is a plain split, not CSV.
    """
    esc = "\\" + sep if not sep.isalnum() else sep
    parts = F.split(F.col(value_col), esc)
    return lines.select(*[
        F.get(parts, i).cast(field.dataType).alias(field.name) for i, field in enumerate(schema.fields)
    ])
