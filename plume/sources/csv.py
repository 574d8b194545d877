"""A2: the clean CSV sink and its reader.

A line break inside a value would make a record span lines, and files of such records cannot
be split. So a backslash, line feed or carriage return in a value is written as ``\\\\``, ``\\n``
or ``\\r`` and read back as it was; quotes, commas and all other characters follow CSV.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plume import rules
from plume.schemas import CLEAN_SCHEMA
from plume.session import remove


def _encoded(c: str) -> Column:
    out = F.col(c)
    for raw, mark in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(raw), F.lit(mark))
    return out.alias(c)


def _decoded(c: str) -> Column:
    """Undo ``_encoded``. Between two escaped backslashes no mark is ambiguous, so the text is
    cut there, the other marks are read in each part, and the parts are joined by a backslash."""
    parts = F.transform(F.split(F.col(c), r"\\\\", -1), lambda x: F.replace(F.replace(
        x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.when(F.col(c).contains("\\"), F.array_join(parts, "\\")).otherwise(F.col(c)).alias(c)


def write_clean_csv(clean: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the five CSV columns with a header; a NULL becomes an empty cell.

    The output is a directory of part files (one per task), which is what lets
    the write scale out; readers take the directory as one table.
    """
    (clean.select(*[_encoded(c) for c in rules.CSV_COLUMNS])
     .write.mode(mode)
     .option("header", True)
     .option("emptyValue", "")
     .option("escape", '"')
     # keep values byte for byte (Spark trims them on write by default)
     .option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def read_clean_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read a clean CSV directory back with the declared all-text schema."""
    text = (spark.read.option("header", True)
            .option("mode", "FAILFAST")
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .schema(CLEAN_SCHEMA)
            .csv(path))
    return text.select(*[_decoded(c) for c in rules.CSV_COLUMNS])


def publish_clean_csv(clean: DataFrame, path: str) -> int:
    """Replace the export at ``path`` as a whole; the number of records written.

    The files are written beside it, counted as read back, and renamed into place; the former export
    stays until then, so a write that fails or is killed leaves it as it was. Between the two renames
    it is kept as ``<path>.former``, which the next publication puts back. Without any record nothing
    is written and the former export stays. One writer at a time; the file system renames folders.
    """
    spark, path = clean.sparkSession, path.rstrip("/")
    staged, former = f"{path}.staged-{uuid.uuid4().hex}", f"{path}.former"
    at, old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, former, staged))
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())

    def rename(a, b):
        if not fs.rename(a, b):
            raise OSError(f"cannot rename {a} to {b}")

    if not fs.exists(at) and fs.exists(old):
        rename(old, at)
    remove(spark, former)
    try:
        write_clean_csv(clean, staged, mode="error")
        n = read_clean_csv(spark, staged).count()
        if n:
            if fs.exists(at):
                rename(at, old)
            rename(new, at)
            remove(spark, former)
    finally:
        remove(spark, staged)
    return n
