"""Removal of lines that many documents share.

Distinct line hashes are dealt to shards.  Each shard holds a minimal perfect hash over its lines,
an array of fingerprints and an array of document counts, all addressed by the hash's index.  To look
a line up, a document's hash goes to its shard, which probes the arrays and answers with the hashes
of lines that are frequent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tidemart.llm.packs import put_up, unseal
from tidemart.llm.perfect_hash import PerfectHash, build, fingerprints
from tidemart.llm.text import stored

SPACES = b" \t\n\v\f\r"
MIN_DOCUMENTS = 10
#: Text per shard, in bytes; shards also follow the shuffle partitions.
SHARD_BYTES = 32 << 20

_ASKED = "shard int, pack long, keys binary, counts binary"
_INDEX = "shard int, lines long, level_sizes array<int>, level_bits binary, fingerprints binary, counts binary"
_FREQUENT = "pack long, frequent binary"


def line_keys(text: bytes, min_chars: int) -> tuple[list[bytes], list[int]]:
    """The lines of a text, and a 64-bit hash of each line's key; 0 for keys that are too short to count."""
    lines = text.split(b"\n")
    digest = xxhash.xxh3_64_intdigest
    keys = []
    for line in lines:
        key = line.strip(SPACES).lower()
        short = len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars
        keys.append(0 if short else digest(key) or 1)
    return lines, keys


def _ask(text: str, shards: int, min_chars: int):
    """The distinct lines of a pack, by shard, with the number of its documents that have each."""
    def ask(own: pa.Table) -> pa.Table:
        pack, docs = unseal(own)
        parts = []
        for body in docs.column(text).cast(pa.large_binary()).to_pylist():
            keys = set(line_keys(body or b"", min_chars)[1])
            keys.discard(0)
            parts.append(np.fromiter(keys, np.uint64, len(keys)))
        keys, counts = np.unique(np.concatenate(parts), return_counts=True)
        shard = (keys % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(shards + 1))
        found = np.flatnonzero(np.diff(cuts)).tolist()
        rows = [order[cuts[s]:cuts[s + 1]] for s in found]
        return pa.table({
            "shard": pa.array(found, pa.int32()), "pack": pa.array([pack] * len(found), pa.int64()),
            "keys": pa.array([keys[at].tobytes() for at in rows], pa.binary()),
            "counts": pa.array([counts[at].astype("<u4").tobytes() for at in rows], pa.binary())})
    return ask


def _index(shard: pa.Table) -> pa.Table:
    """The arrays of one shard; counts are as wide as its largest needs."""
    keys = np.concatenate([np.frombuffer(b, "<u8") for b in shard.column("keys").to_pylist()])
    counts = np.concatenate([np.frombuffer(b, "<u4") for b in shard.column("counts").to_pylist()])
    distinct, inverse = np.unique(keys, return_inverse=True)
    totals = np.bincount(inverse, counts, len(distinct)).astype(np.int64)
    sizes, bits = build(distinct)
    at = PerfectHash(sizes, bits).index(distinct)
    widest = np.min_scalar_type(totals.max(initial=0)).newbyteorder("<")
    marks, documents = np.empty(len(distinct), "<u2"), np.empty(len(distinct), widest)
    marks[at], documents[at] = fingerprints(distinct), totals
    return pa.table({
        "shard": pa.array([shard.column("shard")[0].as_py()], pa.int32()), "lines": pa.array([len(distinct)], pa.int64()),
        "level_sizes": pa.array([sizes], pa.list_(pa.int32())), "level_bits": pa.array([bits], pa.binary()),
        "fingerprints": pa.array([marks.tobytes()], pa.binary()), "counts": pa.array([documents.tobytes()], pa.binary())})


def _probe(min_documents: int):
    """Look the lines of all packs up in one shard; each pack is told which of its lines are frequent."""
    def probe(asked: pa.Table, index: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return pa.table({"pack": pa.array([], pa.int64()), "frequent": pa.array([], pa.binary())})
        row = index.slice(0, 1).to_pylist()[0]
        lookup = PerfectHash(row["level_sizes"], row["level_bits"])
        marks = np.frombuffer(row["fingerprints"], "<u2")
        counts = np.frombuffer(row["counts"], f"<u{len(row['counts']) // row['lines']}")
        blobs = asked.column("keys").to_pylist()
        keys = np.frombuffer(b"".join(blobs), "<u8")
        packs = np.repeat(asked.column("pack").to_numpy(), [len(b) // 8 for b in blobs])
        at = lookup.index(keys)
        frequent = (at >= 0) & (marks[at] == fingerprints(keys)) & (counts[at] >= min_documents)
        keys, packs = keys[frequent], packs[frequent]
        order = np.argsort(packs, kind="stable")
        keys, packs = keys[order], packs[order]
        own, starts = np.unique(packs, return_index=True)
        ends = np.append(starts[1:], len(packs))
        return pa.table({
            "pack": pa.array(own, pa.int64()),
            "frequent": pa.array([keys[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())})
    return probe


def _strip(text: str, names: list[str], min_chars: int):
    def strip(own: pa.Table, frequent: pa.Table) -> pa.Table:
        docs, known = unseal(own)[1], set()
        for blob in frequent.column("frequent").to_pylist():
            known.update(np.frombuffer(blob, "<u8").tolist())
        totals, drops, kept = [], [], []
        for body in docs.column(text).cast(pa.large_binary()).to_pylist():
            lines, keys = line_keys(body or b"", min_chars)
            left = [line for line, key in zip(lines, keys) if key not in known]
            totals.append(len(lines))
            drops.append(len(lines) - len(left))
            kept.append(None if body is None else b"\n".join(left).decode())
        added = {text: pa.array(kept, pa.string()), "n_lines": pa.array(totals, pa.int64()), "n_dropped": pa.array(drops, pa.int64())}
        return pa.table({name: added[name] if name in added else docs.column(name) for name in names})
    return strip


def build_index(asked: DataFrame) -> DataFrame:
    """One row per shard: levels of the perfect hash, fingerprints and document counts."""
    return asked.groupBy("shard").applyInArrow(_index, _INDEX)


def drop_frequent_lines(
    docs: DataFrame, text: str = "text", min_documents: int = MIN_DOCUMENTS, min_chars: int = 1,
) -> DataFrame:
    """Drop every line whose key is found in at least `min_documents` documents, in all of them.

    A line's key is the line without white space at both ends, A-Z lower-cased; keys under
    `min_chars` code points always stay.  The text becomes the remaining lines joined by newlines,
    and `n_lines` (before) and `n_dropped` are added.  A null text stays null, an empty one empty,
    both with one empty line; a text that loses all lines becomes empty.  A line repeated within a
    document counts once, repeated rows are documents of their own.  An empty table stays empty.
    Other columns pass through, those named like the added ones are replaced.

    Texts are not shuffled: documents are put up in packs, and a pack sends each of its lines once to
    the line's shard, so a line that is in every document costs one entry per pack.  Shards grow in
    number with the text, which bounds what one holds.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    shards = int(max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // SHARD_BYTES))
    rows = docs.drop("n_lines", "n_dropped")
    packs = put_up(rows)
    asked = stored(packs.groupBy("pack").applyInArrow(_ask(text, shards, min_chars), _ASKED), "lines")
    index = stored(build_index(asked), "line-index")
    frequent = asked.select("shard", "pack", "keys").groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(
        _probe(min_documents), _FREQUENT)
    schema = T.StructType([*rows.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return packs.groupBy("pack").cogroup(frequent.groupBy("pack")).applyInArrow(_strip(text, schema.names, min_chars), schema)
