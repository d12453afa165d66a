"""URL filtering by host and path rules.

Each URL is expanded into its host suffixes joined with its path prefixes, as lookups against a
blocklist by hash do it.  The expressions meet the rules in an equi-join on a short prefix of their
SHA-256; full digests are then compared, and the longest rule that fits decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.text import lower_ascii


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def expressions(host: Column, path: Column, max_labels: int, lengths: list[int]) -> Column:
    """Every host suffix of at most `max_labels` labels, joined with every path prefix of a given length."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(
        F.sequence(F.greatest(n - max_labels + 1, F.lit(1)), n),
        lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."),
    )
    prefixes = F.transform(
        F.filter(F.array(*(F.lit(x) for x in lengths)), lambda k: k <= F.length(path)),
        lambda k: F.substring(path, F.lit(1), k),
    )
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", prefix_digits: int = 8
) -> DataFrame:
    """Add `host`, `path`, `rule` and `verdict` to each page.

    `rules` holds `action` (allow or block), `host` and `path`; a rule fits its host and all its
    subdomains where the URL's path starts with the rule's.  The longest rule string wins, of equal
    rules a block.  Rules with a null or an empty host are ignored, a null path counts as empty.
    Only suffixes with as many labels as some rule has, and prefixes as long as some rule's path, are
    expanded: others can equal no rule.

    A null URL, or one without `://`, has an empty host and path and gets the default verdict.
    Repeated rows are judged alike and all stay; an empty table gives an empty result; without rules
    all get the default.  Columns of `pages` named like the four added ones are replaced.

    URLs are judged once per distinct host and path, so a URL repeated in a third of the rows costs
    one judgement.  Spark broadcasts the rules when it measures them as small enough, else it
    shuffles both sides by hash prefix and splits skewed ones.
    """
    rules = rules.where(F.coalesce(F.length("host"), F.lit(0)) > 0).select(
        F.col("action").alias("_u_action"), lower_ascii(F.col("host")).alias("_u_host"),
        F.coalesce("path", F.lit("")).alias("_u_path"),
    ).distinct()
    shapes = rules.groupBy(F.length("_u_path").alias("k")).agg(
        F.max(F.size(F.split("_u_host", r"\."))).alias("labels")
    ).collect()  # one row per length of a rule's path
    urls = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))}).drop("rule", "verdict")
    keyed = rules.select(
        "_u_action", F.concat("_u_host", "_u_path").alias("_u_rule"),
    ).withColumn("_u_full", F.sha2("_u_rule", 256)).withColumn(
        "_u_short", F.substring("_u_full", 1, prefix_digits))
    lookups = urls.select("host", "path").distinct().select(
        "host", "path",
        F.explode(expressions(
            F.col("host"), F.col("path"), max((s.labels for s in shapes), default=1),
            sorted(s.k for s in shapes) or [0])).alias("_u_expression"),
    ).select("host", "path", F.sha2("_u_expression", 256).alias("_u_digest"))
    lookups = lookups.withColumn("_u_short", F.substring("_u_digest", 1, prefix_digits))
    fits = lookups.join(keyed, "_u_short").where(F.col("_u_digest") == F.col("_u_full"))
    order = F.struct(F.length("_u_rule").alias("n"), (F.col("_u_action") == "block").alias("b"), "_u_rule", "_u_action")
    best = fits.groupBy("host", "path").agg(F.max(order).alias("_u_best"))
    return urls.join(best, ["host", "path"], "left").select(
        *(F.col(c) for c in urls.columns),
        F.col("_u_best._u_rule").alias("rule"),
        F.coalesce(F.col("_u_best._u_action"), F.lit(default)).alias("verdict"),
    )
