"""Quality rules with thresholds that follow the data.

Each document gets a few signals.  Per language and source, mergeable quantile sketches of the
signals (Spark's quantile summaries, merged from partial ones) give the fences beyond which a
document is an outlier; documents and fences are then joined and filtered.  A small group knows little
of its tail, so its fences lean on those of its language, and these on those of all documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.text import SPACE, WORD, stored, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
SYMBOLS = r"[^#*$%&|<>]+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: A fence lies this many interquartile ranges above the upper quartile, and not below the upper tail's start.
REACH = 4.0
TAIL = 0.9
#: The fences of the next larger group count like so many rows of the group's own.
PRIOR_ROWS = 50
#: Symbols, repeated lines and repeated windows are rare events: their number must exceed what the fence
#: allows by so many of its standard errors, so a single repeated line of a short document is no fault.
ERRORS = 3.0
#: Means are sums of whole numbers, rates times this, so that they do not depend on the order of rows.
SCALE = 10**6
#: Rank error of a sketch is 1 / ACCURACY of the group's rows.
ACCURACY = 10_000


def _repeated_words(windows: Column, pairs: Column, starts: Column, window: int) -> tuple[Column, Column, Column]:
    none = F.array().cast("array<int>")
    sorted_pairs = F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    at = lambda i: F.get(pairs, i)["h"]
    same = lambda a, b: F.coalesce(a == b, F.lit(False))
    repeated = F.coalesce(F.sort_array(F.transform(
        F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), lambda i: same(at(i), at(i - 1)) | same(at(i), at(i + 1))),
        lambda i: F.get(pairs, i)["i"],
    )), none)
    covered = F.aggregate(
        F.transform(starts, lambda s, i: F.least(F.coalesce(F.get(starts, i + 1) - s, F.lit(window)), F.lit(window))),
        F.lit(0).cast("long"), lambda a, x: a + x,
    )
    return sorted_pairs, repeated, covered


def with_signals(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts `n_words`, `word_chars`, `n_symbols`, `n_dup_lines`, `n_repeat_words`, and `base_failed`.

    A word in a window of eight that occurs twice or more in the text counts as repeated.  Windows are
    compared by a 64-bit hash within their own document.  Null and empty texts have no words and fail.
    Columns of these names are replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    staged = docs.withColumn("_q_words", words(F.col(text)))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD))
    staged = staged.withColumns({
        "_q_lines": lines,
        "_q_windows": F.when(
            F.size("_q_words") >= WINDOW,
            F.transform(F.sequence(F.lit(1), F.size("_q_words") - (WINDOW - 1)),
                        lambda i: F.xxhash64(F.slice("_q_words", i, WINDOW))),
        ).otherwise(F.array().cast("array<bigint>")),
    })
    pairs, starts, covered = _repeated_words(
        F.col("_q_windows"), F.col("_q_pairs"), F.col("_q_starts"), WINDOW)
    staged = staged.withColumn("_q_pairs", pairs).withColumn("_q_starts", starts)
    staged = staged.withColumns({
        "n_words": F.size("_q_words").cast("long"),
        "word_chars": F.length(F.regexp_replace(body, SPACE, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(body, SYMBOLS, "")).cast("long"),
        "n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
        "n_repeat_words": covered,
        "_q_n_lines": F.size("_q_lines"),
    }).drop("_q_words", "_q_windows", "_q_pairs", "_q_starts", "_q_lines")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return staged.withColumn("base_failed", failed)


def _rates() -> dict[str, Column]:
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "symbol_share": share("n_symbols", "word_chars"), "long_words": share("word_chars", "n_words"),
        "dup_line_share": share("n_dup_lines", "_q_n_lines"), "repeat_share": share("n_repeat_words", "n_words"),
    }


def _events() -> dict[str, tuple[Column, Column]]:
    """Numbers of events and of chances for the rates that count rare events."""
    return {
        "symbol_share": (F.col("n_symbols"), F.col("word_chars")),
        "dup_line_share": (F.col("n_dup_lines"), F.col("_q_n_lines")),
        "repeat_share": (F.col("n_repeat_words") / WINDOW, F.col("n_words") / WINDOW),
    }


def fences(signals: DataFrame, keys: tuple[str, str], reach: float = REACH, accuracy: int = ACCURACY) -> DataFrame:
    """One row per pair of keys with the upper fence of each rate.

    A fence is the largest of: `reach` interquartile ranges above the upper quartile, the quantile `TAIL`, and the mean
    (where most documents have none of a signal, quantiles are 0 and say nothing).  Group, first key and all documents
    have fences of their own; the first leans on the second and that on the third as if these were `PRIOR_ROWS` rows more.
    The three come from one scan.  Only the fences of all documents, one row, come to the driver.
    """
    outer, inner = keys
    rates = signals.select(
        F.col(outer).alias(f"_f_{outer}"), F.col(inner).alias(f"_f_{inner}"), *(r.alias(n) for n, r in _rates().items()))
    low, high, tail = (lambda q: q[0]), (lambda q: q[1]), (lambda q: q[2])

    def own(name: str) -> Column:
        q = F.percentile_approx(name, [0.25, 0.75, TAIL], accuracy)
        mean = F.sum((F.col(name) * SCALE).cast("long")) / F.count(F.lit(1)) / SCALE
        return F.greatest(high(q) + reach * (high(q) - low(q)), tail(q), mean)

    def lean(name: str, on: Column) -> Column:
        return (F.col(f"_f_{name}") * F.col("_f_rows") + PRIOR_ROWS * on) / (F.col("_f_rows") + PRIOR_ROWS)

    # levels: 0 has both keys, 1 the first, 3 none
    levels = stored(rates.rollup(f"_f_{outer}", f"_f_{inner}").agg(
        F.grouping_id().alias("_f_level"), F.count(F.lit(1)).alias("_f_rows"), *(own(n).alias(f"_f_{n}") for n in _rates())), "levels")
    whole = levels.where("_f_level = 3").first()
    middle = levels.where("_f_level = 1").select(F.col(f"_f_{outer}").alias("_f_on"), *(
        lean(n, F.lit(whole[f"_f_{n}"] if whole else None).cast("double")).alias(f"_f_on_{n}") for n in _rates()))
    groups = levels.where("_f_level = 0")
    return groups.join(middle, F.col(f"_f_{outer}").eqNullSafe(F.col("_f_on"))).select(
        f"_f_{outer}", f"_f_{inner}", *(lean(n, F.col(f"_f_on_{n}")).alias(f"_f_{n}") for n in _rates()))


def verdicts(
    signals: DataFrame, bounds: DataFrame, keys: tuple[str, str] = ("lang", "source")
) -> DataFrame:
    """Add `kept` and `reasons` to rows that carry signals.

    `reasons` names what speaks against a row, comma-joined: `base` for the base rule, else rates beyond
    their group's fence; `kept` is true if there is none.  Columns of these names are replaced.
    """
    on = F.lit(True)
    for k in keys:
        on = on & signals[k].eqNullSafe(F.col(f"_f_{k}"))
    events, found = _events(), [F.when(F.col("base_failed"), F.lit("base"))]
    for name, rate in _rates().items():
        fence, (seen, chances) = F.col(f"_f_{name}"), events.get(name, (None, None))
        beyond = rate > fence if seen is None else seen - fence * chances > ERRORS * F.sqrt(seen)
        found.append(F.when(beyond, F.lit(name)))
    joined = signals.join(bounds, on, "left").withColumn("reasons", F.concat_ws(",", *found))
    return joined.withColumn("kept", F.col("reasons") == "").drop(*bounds.columns, "_q_n_lines")


def judge(signals: DataFrame, keys: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """`verdicts` against fences from the same rows; store the rows first, as they are read twice."""
    return verdicts(signals, fences(signals, keys), keys)


def filter_documents(docs: DataFrame, text: str = "text", keys: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """The documents that pass, with the columns they came with.

    Sketches cover all documents, those that fail the fixed rules too.  A null language or source is
    a group of its own.  Documents that are all alike pass, if they pass the base rule: nothing lies beyond its own fence.
    Repeated rows share one verdict; empty in, empty out.  Rows are stored with their signals, so each text is
    measured once.  The fences, one row per language and source, are stored, so that Spark knows their
    size: it broadcasts them if they are small, else it splits skewed groups.
    """
    kept_keys = {k: F.col(k).alias(f"_q_key_{i}") for i, k in enumerate(keys)}
    inner = docs.select(F.struct(*docs.columns).alias("_q_row"), F.col(text).alias("_q_text"), *kept_keys.values())
    signals = stored(with_signals(inner, "_q_text").drop("_q_text"), "signals")
    names = ("_q_key_0", "_q_key_1")
    out = verdicts(signals, stored(fences(signals, names), "fences"), names)
    return out.where("kept").select(*(F.col("_q_row")[c].alias(c) for c in docs.columns))
