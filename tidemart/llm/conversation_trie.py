"""The trie of conversation prefixes, built by halving depths.

Sequences of turns are cut at half their depth.  Each distinct cut prefix gets a name; the upper halves
make one trie, what follows a cut prefix makes a forest under its name, and both are cut again in
the same round, down to single turns.  Sequences that agree on a piece are one row from there on, and
what lies below a cut prefix is grafted on it: its row in the upper half carries the sums of all
that continue below.  So a trie of depth D takes log2(D) rounds, each one aggregation.

Turns are compared by MD5 of role and text, prefixes by MD5 of what they consist of.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.llm.text import stored, word_count

#: Turns of a conversation that are put side by side; longer conversations are sequences of such chunks.
CHUNK = 256
#: Ids that are written out together before they are hashed.
IDS = 4096
#: Marks the end of a sequence; no turn has an empty digest.
END = b""


def turns_in_order(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """`conv`, `pos` (from 0), `d` (digest of role and text) and `w` (words) for each turn, stored.

    Turns are ordered by `turn`, nulls first, ties by digest; null role and text are empty.  Rows without
    a conversation are left out.  Positions are counted in ranges of the sorted table, so a conversation
    with a third of all rows is spread; equal rows are told apart by a number that has no other use.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(empty(role)).cast("string"), F.lit(":"), empty(role), empty(text))))
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), digest.alias("d"), word_count(empty(text)).alias("w"))
    ranged = stored(
        rows.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange("conv", "turn", "d", "copy").withColumn(
            "run", F.spark_partition_id()), "turns")
    earlier = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("conv", "run").agg(F.count(F.lit(1)).alias("n")).select(
        "conv", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    within = Window.partitionBy("conv", "run").orderBy(F.col("turn").asc_nulls_first(), "d")
    return stored(ranged.join(starts, ["conv", "run"]).select(
        "conv", (F.col("start") + F.row_number().over(within) - 1).alias("pos"), "d", "w"), "turns")


def share_openings(turns: DataFrame, group: int = 20, longest: int = 4) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of conversation c - c % group.

    h is the CRC-32 of c in decimal, modulo `longest`.  All of them are taken if there are fewer, none if that
    conversation is absent; c's own turns follow after its first h.
    """
    base, h = F.col("conv") - F.col("conv") % group, F.crc32(F.col("conv").cast("string").cast("binary")) % longest
    openings = turns.where((F.col("conv") % group == 0) & (F.col("pos") < longest - 1))
    lengths = openings.groupBy(F.col("conv").alias("base")).agg(F.count(F.lit(1)).alias("there"))
    own = turns.where(F.col("pos") >= h).withColumn("base", base).join(lengths, "base", "left").select(
        "conv", (F.col("pos") - h + F.least(h, F.coalesce("there", F.lit(0)))).alias("pos"), "d", "w")
    wanted = turns.select("conv").distinct().select(F.col("conv").alias("c"), base.alias("base"), h.alias("h"))
    taken = wanted.join(openings, F.col("base") == F.col("conv")).where("pos < h").select(F.col("c").alias("conv"), "pos", "d", "w")
    return own.union(taken)


def _hex(symbols: Column) -> Column:
    return F.array_join(F.transform(symbols, lambda x: F.hex(x["d"])), ",")


def _words(symbols: Column) -> Column:
    return F.aggregate(symbols, F.lit(0).cast("long"), lambda total, x: total + x["w"])


def _halved(rows: DataFrame, width: int, weights: list[str]) -> DataFrame:
    """Cut pieces of up to `width` symbols, a power of two, down to single ones, adding up `weights`.

    A row is a piece: the `prefix` it continues, by name, that prefix's length `depth` and words `before`,
    its `symbols`, the smallest `conv` that has it, and the weights of all that do.
    """
    while width > 1:
        width //= 2
        upper = F.slice("symbols", 1, width)
        same = [F.col(c) for c in ("conv", *weights)]
        top = F.struct("prefix", "depth", "before", upper.alias("symbols"), *same)
        below = F.struct(
            F.md5(F.concat_ws("|", "prefix", _hex(upper))).alias("prefix"), (F.col("depth") + width).alias("depth"),
            (F.col("before") + _words(upper)).alias("before"), F.slice("symbols", width + 1, width).alias("symbols"), *same)
        parts = rows.select(F.inline(F.when(F.size("symbols") > width, F.array(top, below)).otherwise(F.array(top))))
        rows = stored(parts.groupBy("prefix", "depth", "before", "symbols").agg(
            F.min("conv").alias("conv"), *(F.sum(w).alias(w) for w in weights)), "pieces")
    return rows


def _width(symbols: DataFrame) -> int:
    """The smallest power of two that is no less than the longest sequence."""
    longest = symbols.agg(F.max(F.size("symbols"))).first()[0] or 1
    return 1 << (longest - 1).bit_length()


def _single(sequences: DataFrame, chunks: DataFrame, widths: tuple[int, int], weights: list[str]) -> DataFrame:
    """One row per prefix and next turn or end: `prefix`, `depth`, `before`, `d`, `w`, `conv` and `weights`."""
    start = sequences.select(F.lit("").alias("prefix"), F.lit(0).cast("long").alias("depth"),
                             F.lit(0).cast("long").alias("before"), "symbols", "conv", *weights)
    pieces = _halved(start, widths[0], weights).drop("symbols")
    own = chunks.select(F.col("conv").alias("c"), F.col("chunk"), "symbols")
    turns = pieces.join(own, (F.col("conv") == F.col("c")) & (F.col("depth") == F.col("chunk"))).withColumn(
        "depth", F.col("depth") * CHUNK).drop("c", "chunk")
    one = F.get("symbols", F.lit(0))
    return _halved(turns, widths[1], weights).withColumns({"d": one["d"], "w": one["w"]}).drop("symbols")


def _written(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids, written out in decimal, up to `IDS` of one sequence together."""
    key, ids = None, []

    def flush() -> Iterator[pa.RecordBatch]:
        if ids:
            yield pa.RecordBatch.from_pydict({"key": [key], "first": [ids[0]], "ids": [",".join(map(str, ids))]})
            ids.clear()

    for batch in batches:
        for k, conv in zip(batch.column("key").to_pylist(), batch.column("conv").to_pylist()):
            if k != key or len(ids) == IDS:
                yield from flush()
                key = k
            ids.append(conv)
    yield from flush()


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the written ids of each sequence, as they come by."""
    key, digest = None, None
    for batch in batches:
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if k != key:
                if digest:
                    yield pa.RecordBatch.from_pydict({"key": [key], "sha256": [digest.hexdigest()]})
                key, digest = k, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if digest:
        yield pa.RecordBatch.from_pydict({"key": [key], "sha256": [digest.hexdigest()]})


def id_digests(members: DataFrame) -> DataFrame:
    """`key` and `sha256` of the `conv` ids of each `key`, ascending, comma-joined.

    Ids are sorted in ranges and written out there, so a crowded key is shared by many tasks; only the
    hashing, which must read them in order, streams through one.
    """
    runs = members.repartitionByRange("key", "conv").sortWithinPartitions("key", "conv").mapInArrow(
        _written, "key string, first long, ids string")
    return runs.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "key string, sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """The nodes of the trie of all conversations, given by `conv`, `pos` (0, 1, ...), `d` and `w`.

    `conversations` lists each `conv` once, also those without turns; by default those of `turns`.  A node is the
    sequence of the first `depth` turns of its members.  Returns `conv_id` (the smallest member), `depth`,
    `parent_conv_id` (null at the root), `n_convs`, `n_children`, `n_leaves` (childless nodes at or
    below), `saved_tokens` (over the nodes at or below, (n_convs - 1) times the words of the last turn) and
    `ends_sha256` (of the ids that end here; of nothing if none does).  `conv_id` and `depth` are the key.

    Conversations with equal turns are one sequence from the start.  No conversations, no rows.

    Two passes are made.  The first counts members and names nodes by their smallest.  From it follows, for each
    conversation, where it leaves the paths of smaller ones: the words before that point are what it saves.  The
    second adds those up.  Every round is a stored table, so a lost executor costs at most a round.
    """
    if conversations is None:
        conversations = turns.select("conv").distinct()
    lengths = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("pos"))
    ends = conversations.select("conv").join(lengths, "conv", "left").select(
        "conv", F.coalesce("pos", F.lit(0)).cast("long").alias("pos"), F.lit(END).alias("d"), F.lit(0).cast("long").alias("w"))
    side_by_side = F.transform(F.sort_array(F.collect_list(F.struct("pos", "d", "w"))), lambda x: F.struct(x["d"], x["w"]))
    chunks = stored(turns.select("conv", "pos", "d", "w").union(ends).groupBy(
        "conv", F.floor(F.col("pos") / CHUNK).alias("chunk")).agg(side_by_side.alias("symbols")), "chunks")
    whole = chunks.select("conv", "chunk", F.unhex(F.md5(_hex(F.col("symbols")))).alias("d"), _words(F.col("symbols")).alias("w"))
    sequences = whole.groupBy("conv").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("chunk", "d", "w"))), lambda x: F.struct(x["d"], x["w"])).alias("symbols"))
    sequences = stored(sequences.withColumn("key", F.md5(_hex(F.col("symbols")))), "sequences")
    distinct = stored(sequences.groupBy("key", "symbols").agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")), "sequences")
    widths = _width(distinct), _width(chunks)

    found = stored(_single(distinct, chunks, widths, ["n"]), "single")
    on = F.col("d") != F.lit(END)
    nodes = found.groupBy("prefix", "depth").agg(
        F.min("conv").alias("conv"), F.sum("n").alias("n_convs"), F.count_if(on).alias("n_children"),
        F.min(F.when(~on, F.col("conv"))).alias("ends"))
    nodes = stored(nodes, "nodes")
    above = nodes.select("prefix", F.col("conv").alias("parent_conv"))
    arcs = found.where(on).join(above, "prefix").select(
        "conv", (F.col("depth") + 1).alias("depth"), "parent_conv", F.col("before").alias("path_words"))
    nodes = stored(nodes.join(arcs, ["conv", "depth"], "left").withColumn("path_words", F.coalesce("path_words", F.lit(0))), "nodes")
    # words of a conversation that the paths of smaller ones have too; for what never leaves them, all
    left = stored(nodes.groupBy("conv").agg(
        F.min_by("path_words", "depth").alias("shared"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf")), "left")

    words = _words(F.col("symbols"))
    weighed = distinct.join(left, "conv", "left").select("conv", "symbols", (
        F.coalesce("shared", words) + (F.col("n") - 1) * words).alias("shared"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    sums = _single(weighed, chunks, widths, ["shared", "leaf"]).groupBy("prefix").agg(
        F.sum("shared").alias("all_shared"), F.sum("leaf").alias("n_leaves"))
    digests = distinct.select("key", F.col("conv").alias("ends")).join(
        id_digests(sequences.select("key", "conv")), "key").drop("key")
    saved = F.col("all_shared") - F.col("shared") - (F.col("n_convs") - 1) * F.col("path_words")
    return nodes.join(sums, "prefix").join(left.select("conv", "shared"), "conv").join(digests, "ends", "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", saved.alias("saved_tokens"), F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
