"""Word rules shared by the operators, as column expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.session import scratch_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def lower_ascii(col: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def words(col: Column) -> Column:
    """The words of a text, an empty array for null."""
    return F.coalesce(F.regexp_extract_all(col, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def word_count(col: Column) -> Column:
    """How many words a text has, 0 for null."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder: later steps reread it, not its inputs."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
