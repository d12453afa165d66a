"""Keyword splitting: text to its distinct words."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.scalar import as_column

WORD = r"[\p{L}\p{N}]+"


def words(text: Column | str) -> Column:
    """Distinct lower-case words of a text; null stays null."""
    return F.array_distinct(F.regexp_extract_all(F.lower(as_column(text)), F.lit(WORD), F.lit(0)))


def dictionary_words(dictionary: Iterable[str]):
    """A column function for text without spaces: longest dictionary match first.

    A run of letters is cut into the longest known words from left to right; letters no
    word starts at stand alone, and runs of ASCII letters or digits stay together.
    """
    known = frozenset(w.lower() for w in dictionary)
    longest = max(map(len, known), default=1)

    def cut(run: str) -> list[str]:
        out, at = [], 0
        while at < len(run):
            end = at + 1
            if run[at].isascii():
                while end < len(run) and run[end].isascii():
                    end += 1
            else:
                for stop in range(min(len(run), at + longest), at + 1, -1):
                    if run[at:stop] in known:
                        end = stop
                        break
            out.append(run[at:end])
            at = end
        return out

    @F.pandas_udf("array<string>")
    def segment(runs: pd.Series) -> pd.Series:
        return runs.map(
            lambda rs: None if rs is None else list(dict.fromkeys(w for r in rs for w in cut(r)))
        )

    return lambda text: segment(words(text))


def split_keywords(df: DataFrame, text: str, out: str = "keyword", splitter=words) -> DataFrame:
    """Cross-apply the splitter: one row per distinct word, none for null or empty text."""
    return df.withColumn(out, F.explode(splitter(text)))
