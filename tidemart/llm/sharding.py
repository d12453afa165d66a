"""Shards of near equal bytes by a k-d tree over document metadata.

All nodes of a level are split together.  A node is cut along the dimension in which its documents
spread widest, at the key up to which it holds its left shards' share of the bytes.  Those weighted
medians come from sums of bytes per key digit, one digit per round, so no node is ever sorted as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemart.llm.text import stored

#: Equal texts with more than this share of a shard's bytes may be parted, others never are.
LARGE_SHARE = 1 / 16
#: Bytes a document counts besides its text.
OVERHEAD = 16
#: Bits of a dimension's code; a key adds 21 bits of the text's hash and 22 of the document's.
CODE_BITS, TEXT_BITS, ROW_BITS = 20, 21, 22
DIGIT_BITS = 16
ROUNDS = 4
DIMENSIONS = ("source", "lang", "n_chars")


def with_size(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add `size`, UTF-8 bytes plus `OVERHEAD`, and `text_crc32`; a null text counts as empty."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({
        "size": F.octet_length(body).cast("long") + OVERHEAD, "text_crc32": F.crc32(F.encode(body, "UTF-8")).cast("long")})


def _codes(rows: DataFrame, dimensions: list[str]) -> dict[str, Column]:
    """Each dimension as a whole number of `CODE_BITS` bits: numbers scaled to their range, others hashed."""
    numbers = [d for d in dimensions if isinstance(rows.schema[d].dataType, T.NumericType)]
    ends = rows.agg(*(f(F.col(d).cast("double")).alias(f"{i}{n}") for i, d in enumerate(numbers)
                      for n, f in (("a", F.min), ("b", F.max)))).first() if numbers else None
    top = (1 << CODE_BITS) - 1
    codes = {}
    for d in dimensions:
        code = F.pmod(F.xxhash64(d), F.lit(top + 1))
        if d in numbers:
            a, b = ends[f"{numbers.index(d)}a"], ends[f"{numbers.index(d)}b"]
            code = F.floor((F.col(d).cast("double") - (a or 0.0)) / (((b or 0.0) - (a or 0.0)) or 1.0) * top)
        codes[d] = F.coalesce(F.when(F.col(d).isNotNull(), code), F.lit(0)).cast("long")
    return codes


def _key(code: Column) -> Column:
    return F.shiftleft(code, TEXT_BITS + ROW_BITS).bitwiseOR(F.col("_k_tie"))


def _down(rows: DataFrame, splits: DataFrame, keys: Column) -> DataFrame:
    """Move the rows of split nodes to their left or right child."""
    moved = rows.join(splits.select(F.col("lo").alias("s_lo"), F.col("n").alias("s_n"), "dim", "bound"),
                      (F.col("_k_lo") == F.col("s_lo")) & (F.col("_k_n") == F.col("s_n")), "left")
    left = F.element_at(keys, F.col("dim")) <= F.col("bound")
    half = F.floor(F.col("s_n") / 2).cast("int")
    return moved.withColumns({
        "_k_lo": F.when(F.col("dim").isNull() | left, F.col("_k_lo")).otherwise(F.col("_k_lo") + half),
        "_k_n": F.when(F.col("dim").isNull(), F.col("_k_n")).when(left, half).otherwise(F.col("_k_n") - half),
    }).drop("s_lo", "s_n", "dim", "bound")


def _splits(rows: DataFrame, codes: list[str], keys: Column) -> DataFrame:
    """`lo`, `n`, `dim` and `bound` of each node with more than one shard: keys up to `bound` go left."""
    open_ = rows.where(F.col("_k_n") > 1).select("_k_lo", "_k_n", "_k_size", "_k_tie", *codes)
    spread = F.array(*(
        F.struct((F.max(c) - F.min(c)).alias("w"), F.lit(-i).alias("i")) for i, c in enumerate(codes, 1)))
    nodes = stored(open_.groupBy(F.col("_k_lo").alias("lo"), F.col("_k_n").alias("n")).agg(
        F.sum("_k_size").cast("double").alias("total"), spread.alias("spread"),
    ).select("lo", "n", (-F.array_max("spread")["i"]).alias("dim"), F.lit(0).cast("long").alias("bound"),
             (F.col("total") * F.floor(F.col("n") / 2) / F.col("n")).alias("goal")), "nodes")
    for round_ in range(ROUNDS):
        shift = DIGIT_BITS * (ROUNDS - 1 - round_)
        met = open_.join(nodes, (F.col("_k_lo") == F.col("lo")) & (F.col("_k_n") == F.col("n")))
        key = F.element_at(keys, F.col("dim"))
        prefix = F.shiftrightunsigned(key, shift + DIGIT_BITS) if round_ else F.lit(0).cast("long")
        digit = F.shiftrightunsigned(key, shift).bitwiseAND((1 << DIGIT_BITS) - 1)
        # stored, so that bytes are summed by node and digit, not by node alone as the window asks
        sums = stored(met.where(prefix == F.col("bound")).groupBy(
            "lo", "n", "dim", "bound", "goal", digit.alias("digit")).agg(F.sum("_k_size").alias("b")), "digits")
        upto = F.sum("b").over(Window.partitionBy("lo").orderBy("digit").rowsBetween(Window.unboundedPreceding, 0))
        reached = sums.withColumn("upto", upto).groupBy("lo", "n", "dim", "bound", "goal").agg(
            F.min(F.when(F.col("upto") >= F.col("goal"), F.struct("digit", "upto", "b"))).alias("at"),
            F.max(F.struct("digit", "upto", "b")).alias("last"))
        at = F.coalesce("at", "last")
        before = at["upto"] - at["b"]
        bound = F.shiftleft("bound", DIGIT_BITS).bitwiseOR(at["digit"])
        if round_ == ROUNDS - 1:  # the last key goes to the side that comes nearer to the goal
            bound = bound - F.when(F.col("goal") - before < at["upto"] - F.col("goal"), 1).otherwise(0)
        nodes = stored(reached.select("lo", "n", "dim", bound.alias("bound"), (F.col("goal") - before).alias("goal")), "nodes")
    return nodes.select("lo", "n", "dim", "bound")


def assign(
    sized: DataFrame, shards: int | None = None, target_bytes: int | None = None, key: str = "doc_id",
    dimensions: tuple[str, ...] = DIMENSIONS,
) -> DataFrame:
    """Add `shard` and `slot` to documents that have `size` and `text_crc32`, by the law of equal bytes.

    The tree has `shards` leaves, or as many as hold `target_bytes` each.  A node of n shards is cut into
    one of n // 2 and one of the rest, at the same share of its bytes.  Equal texts (the same `size` and `text_crc32`)
    count with the metadata of the one of least key, and within one value of a dimension documents are ordered by a
    hash of the text, so equal texts share a shard.  Only texts whose copies come to more than `LARGE_SHARE` of a
    shard's bytes may be parted: they are ordered by a hash of the key besides.  So a value or a text that a third
    of the corpus has is cut like any other.  Shards differ by about half a `LARGE_SHARE`, or half a document, per
    cut; rows that are equal in every respect are never parted.

    Null metadata counts as the smallest code, a dimension the table does not have is skipped; with none,
    the hashes alone decide.  Slots number the rows of a shard from 0 by key (nulls first), checksum
    and size.  An empty table stays empty.  Columns named `shard` and `slot` are replaced, others may have any name.

    The rows are stored with their nodes once per level and read five times, so pass a narrow table;
    sums of a level are as small as its nodes times 65536 digits.
    """
    rows = sized.drop("shard", "slot")
    used = [d for d in dimensions if d in rows.columns]
    total = rows.agg(F.sum("size")).first()[0] or 0
    if shards is None:
        shards = max(1, -(-total // target_bytes))
    # the caller's columns travel as one, so none of theirs meets one of these
    codes = {f"_k_code{i}": c for i, c in enumerate(_codes(rows, used).values())} or {"_k_code0": F.lit(0).cast("long")}
    own = rows.select(F.struct(*rows.columns).alias("_k_row"), F.col(key).alias("_k_key"), F.col("size").cast("long").alias("_k_size"),
                      F.col("text_crc32").alias("_k_crc"), *(c.alias(name) for name, c in codes.items()))
    own = stored(own, "coded")
    # one row per text that has copies; stored, so that Spark knows its size and broadcasts it or splits a hot text's rows
    copied = stored(own.where(F.col("_k_crc").isNotNull()).groupBy("_k_crc", "_k_size").agg(
        F.min(F.struct(F.col("_k_key").isNull(), "_k_key", *codes)).alias("_g"), F.sum("_k_size").alias("_g_bytes"),
        F.count(F.lit(1)).alias("_g_n")).where("_g_n > 1").select(
        F.col("_k_crc").alias("_g_crc"), F.col("_k_size").alias("_g_size"), "_g_bytes", *(F.col("_g")[c].alias(f"_g{c}") for c in codes)), "copied")
    own = own.join(copied, (F.col("_k_crc") == F.col("_g_crc")) & (F.col("_k_size") == F.col("_g_size")), "left")
    low = lambda h, bits: h.bitwiseAND((1 << bits) - 1)
    large = F.coalesce("_g_bytes", "_k_size") > total / shards * LARGE_SHARE
    tie = F.shiftleft(low(F.xxhash64("_k_crc", "_k_size"), TEXT_BITS), ROW_BITS).bitwiseOR(
        F.when(large, low(F.xxhash64("_k_key", "_k_crc"), ROW_BITS)).otherwise(0))
    # stored with their nodes as columns: a constant node would turn the joins below into cross joins
    tree = stored(own.select("_k_row", "_k_key", "_k_size", "_k_crc", *(F.coalesce(f"_g{c}", c).alias(c) for c in codes),
                             tie.alias("_k_tie"), F.lit(0).alias("_k_lo"), F.lit(int(shards)).alias("_k_n")), "tree")
    keys = F.array(*(_key(F.col(c)) for c in codes))
    left = int(shards)
    while left > 1:
        tree = stored(_down(tree, _splits(tree, list(codes), keys), keys), "tree")
        left -= left // 2
    by = Window.partitionBy("_k_lo").orderBy("_k_key", "_k_crc", "_k_size")
    return tree.select(*(F.col("_k_row")[c].alias(c) for c in rows.columns), F.col("_k_lo").alias("shard"),
                       (F.row_number().over(by) - 1).cast("long").alias("slot"))


def shard_documents(docs: DataFrame, shards: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`doc_id`, `size`, `text_crc32`, `law`, `shard`, `slot` and `grown_shard` for each document."""
    names = list(dict.fromkeys([key, *(d for d in DIMENSIONS if d in docs.columns)]))
    narrow = with_size(docs.select(*names, F.col(text).alias("_k_text")), "_k_text").drop("_k_text")
    found = assign(narrow, shards, key=key)
    return found.select(key, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))
