"""Near-duplicates by SimHash fingerprints within a few bits of each other.

Multi-index hashing: a fingerprint's halves are two tables.  Two fingerprints at most three bits apart
agree in one half up to one bit, so each fingerprint is filed under its own halves and looked up under
all values within that small ball; full distances are checked where they meet.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemart.llm.components import roots
from tidemart.llm.grams import NON_SPACE, Words, pieces, small_batches, text_bytes
from tidemart.llm.text import stored

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BITS = 64
#: Fingerprints filed under one value of a segment, beyond which the value is split further.
CROWDED = 4000
#: Fingerprints compared with each other at once.
BLOCK = 1024

_LINKS = "u long, v long"


def _fingerprint(hashes: np.ndarray) -> int:
    """Bits that more than half the hashes have, as a signed number."""
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, name: str = "fingerprint") -> DataFrame:
    """Add the SimHash of each text as a signed 64-bit number, 0 for texts without words.

    Shingles are `shingle` consecutive words, repeats included, joined by spaces; a text with fewer
    words is one shingle.  Hashes are XXH64 of the UTF-8 bytes.  A column of that name is replaced.
    """
    small_batches(docs.sparkSession)
    rows = docs.drop(name)
    columns = rows.columns
    digest = xxhash.xxh64_intdigest

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, prints = text_bytes(batch.column(text)), []
            for a, b in pieces(bodies):
                words = Words(bodies[a:b], NON_SPACE)
                data = words.joined(0, len(words.starts))
                ends = np.cumsum(words.ends - words.starts + 1) - 1
                starts = (ends - (words.ends - words.starts)).tolist()
                ends = ends.tolist()
                for first, end in zip(words.first.tolist(), words.first[1:].tolist()):
                    if first == end:
                        prints.append(0)
                        continue
                    size = min(shingle, end - first)
                    hashes = [digest(data[s:e], SEED) for s, e in zip(
                        starts[first:end - size + 1], ends[first + size - 1:end])]
                    prints.append(_fingerprint(np.array(hashes, "<u8")))
            yield pa.RecordBatch.from_pydict(
                {c: batch.column(c) for c in columns} | {name: pa.array(prints, pa.int64())})

    return rows.mapInArrow(scan, T.StructType([*rows.schema.fields, T.StructField(name, T.LongType())]))


def _segment(print_: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(print_, start).bitwiseAND(F.lit((1 << width) - 1))


def _own_key(part: int, width: int) -> Column:
    return F.lit(part << width).cast("long") + _segment(F.col("p"), part * width, width)


def _entries(prints: DataFrame, max_bits: int, parts: int) -> DataFrame:
    """Each fingerprint under its own segment values (`home`) and under all within the ball around them."""
    width, radius = BITS // parts, max_bits // parts
    balls = [0]
    for _ in range(radius):
        balls = sorted({b ^ (1 << i) for b in balls for i in range(width)} | set(balls))
    ball = F.array(*(F.lit(b).cast("long") for b in balls))

    def around(part: int) -> Column:
        # the segment's number stands above its value
        own = _own_key(part, width)
        return F.transform(ball, lambda b: F.struct(own.bitwiseXOR(b).alias("key"), (b == 0).alias("home")))

    keyed = F.flatten(F.array(*(around(part) for part in range(parts))))
    return prints.select("p", F.explode(keyed).alias("e")).select(F.col("e.key").alias("key"), F.col("e.home").alias("home"), "p")


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of pairs within the distance, block by block."""
    for i in range(0, len(a), BLOCK):
        for j in range(0, len(b), BLOCK):
            x, y = np.nonzero(np.bitwise_count(a[i:i + BLOCK, None] ^ b[None, j:j + BLOCK]) <= max_bits)
            if len(x):
                yield x + i, y + j


def _spanning(home: np.ndarray, away: np.ndarray, max_bits: int) -> tuple[list[int], list[int]]:
    """Links that connect what lies within the distance of a filed fingerprint, one per member at most."""
    nodes = np.concatenate((home, away))
    parent = np.arange(len(nodes))

    def settle() -> None:
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                return
            parent[:] = up

    for x, y in _near(home, nodes, max_bits):
        while True:
            a, b = parent[x], parent[y]
            apart = a != b
            if not apart.any():
                break
            x, y, a, b = x[apart], y[apart], a[apart], b[apart]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            settle()
    own = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[parent[own]].view(np.int64).tolist(), nodes[own].view(np.int64).tolist()


def _meet(max_bits: int):
    """Compare the fingerprints under each key; rows come sorted by key."""
    def links(home: list[np.ndarray], away: list[np.ndarray]) -> tuple[list[int], list[int]]:
        h = np.concatenate(home)
        if len(h) + sum(map(len, away)) < 2:
            return [], []
        return _spanning(h.view(np.uint64), np.concatenate([*away, h[:0]]).view(np.uint64), max_bits)

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, home, away = None, [], []
        us: list[int] = []
        vs: list[int] = []
        for batch in batches:
            keys, homes, prints = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "home", "p"))
            if not len(keys):
                continue
            edges = np.flatnonzero(np.diff(keys)) + 1
            filed = np.concatenate(([0], np.cumsum(homes)))
            bounds = np.concatenate(([0], edges, [len(keys)]))
            # a group that lies inside the batch matters only if something is filed there and meets another
            alive = (filed[bounds[1:]] > filed[bounds[:-1]]) & (np.diff(bounds) > 1)
            alive[[0, -1]] = True
            for g in np.flatnonzero(alive).tolist():
                a, b = int(bounds[g]), int(bounds[g + 1])
                if keys[a] != key:
                    if home:
                        u, v = links(home, away)
                        us += u
                        vs += v
                    key, home, away = keys[a], [], []
                part, own = prints[a:b], homes[a:b]
                if own.any():
                    home.append(part[own])
                if not own.all():
                    away.append(part[~own])
            if len(us) > 10_000:
                yield pa.RecordBatch.from_pydict({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})
                us, vs = [], []
        if home:
            u, v = links(home, away)
            us += u
            vs += v
        yield pa.RecordBatch.from_pydict({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})
    return meet


def _split(max_bits: int, parts: int) -> Column:
    """The keys that stand for a crowded `key`: one for each piece of the bits outside its segment."""
    width = BITS // parts
    rest = BITS - width
    edges = [k * rest // (max_bits + 1) for k in range(max_bits + 2)]

    def pieces_beside(part: int) -> Column:
        # turned until the segment stands on top
        turn = (part + 1) * width % BITS
        p = F.shiftrightunsigned("p", turn).bitwiseOR(F.shiftleft("p", (BITS - turn) % BITS))
        return F.array(*(F.xxhash64(F.lit(k), "key", _segment(p, a, b - a)) for k, (a, b) in enumerate(zip(edges, edges[1:]))))

    # the segment's number stands above its value
    return F.coalesce(*(F.when(F.shiftright("key", width) == part, pieces_beside(part)) for part in range(parts)))


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, parts: int = 2) -> DataFrame:
    """Links `u`, `v` that connect the distinct fingerprints `p` exactly as all pairs within `max_bits` would.

    With `parts` segments, some segment of a near pair differs in at most `max_bits // parts` bits, so
    one of the two is filed where the other is looked up.  Where many meet, a spanning forest of the
    verified pairs is sent on instead of the pairs: one link per fingerprint there at most.

    No segment value holds more fingerprints than differ in the other bits; values under which more
    than `CROWDED` are filed are split by equal pieces of those other bits, of which a near pair
    shares at least one, so that no task compares a crowd as a whole.  Pieces of the segment itself
    would not split it, as all that are filed there share them.
    """
    entries, width = _entries(prints, max_bits, parts), BITS // parts
    filed = F.explode(F.array(*(_own_key(part, width) for part in range(parts))))
    crowds = stored(prints.select(filed.alias("c")).groupBy("c").count().where(F.col("count") > CROWDED), "crowds")
    if not crowds.isEmpty():
        # a crowd is met under its own value and under the values one bit off
        flips = F.array(*(F.lit(x).cast("long") for x in [0, *(1 << i for i in range(width))]))
        near = crowds.select("c", F.explode(flips).alias("f")).select(F.col("c").bitwiseXOR(F.col("f")).alias("c")).distinct()
        split = _split(max_bits, parts)
        keys = F.when(F.col("c").isNull(), F.array("key")).otherwise(split)
        entries = entries.join(near, entries["key"] == near["c"], "left").select(F.explode(keys).alias("key"), "home", "p")
    return entries.repartition("key").sortWithinPartitions("key").mapInArrow(_meet(max_bits), _LINKS)


def with_components(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, max_bits: int = MAX_BITS,
) -> DataFrame:
    """Add `fingerprint` (16 hex digits) and `component_id`, the smallest key reachable over near links.

    Null and empty texts have fingerprint zero and link like any other.  Documents of equal
    fingerprint meet once: only distinct fingerprints are compared.  Null keys are no candidates for
    the smallest; a component of null keys alone has a null id.  Repeated rows stay.  An empty table
    stays empty.  Columns of these names are replaced.

    The fingerprinted rows are read twice, once to link and once to join, so pass a narrow table.
    """
    rows = with_fingerprints(docs.drop("fingerprint", "component_id"), text, shingle, "_s_print")
    return joined_components(rows, component_map(rows, key, max_bits), key).drop("_s_root")


def component_map(rows: DataFrame, key: str = "doc_id", max_bits: int = MAX_BITS) -> DataFrame:
    """`p`, its component's `root` and `component_id`, for fingerprints that are shared or linked."""
    prints = stored(rows.groupBy(F.col("_s_print").alias("p")).agg(
        F.min(key).alias("least"), F.count(F.lit(1)).alias("n")), "fingerprints")
    stars = stored(roots(near_links(prints.select("p"), max_bits)), "components")
    linked = prints.join(stars, prints["p"] == stars["node"]).select("p", "least", "root")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    grouped = linked.join(least, "root").select("p", "root", "component_id")
    alone = prints.where(F.col("n") > 1).join(stars, prints["p"] == stars["node"], "left_anti")
    return grouped.union(alone.select("p", F.col("p").alias("root"), F.col("least").alias("component_id")))


def joined_components(rows: DataFrame, components: DataFrame, key: str = "doc_id") -> DataFrame:
    """Add `fingerprint`, `component_id` and `_s_root`; a fingerprint not in `components` is its own."""
    known = components.select(
        F.col("p").alias("_s_p"), F.col("root").alias("_s_star"), F.col("component_id").alias("_s_component"))
    joined = rows.join(known, rows["_s_print"] == known["_s_p"], "left")
    hex_ = F.lower(F.lpad(F.hex("_s_print"), 16, "0"))
    component = F.when(F.col("_s_p").isNotNull(), F.col("_s_component")).otherwise(F.col(key))
    return joined.select(*(F.col(c) for c in rows.columns if c != "_s_print"), hex_.alias("fingerprint"),
                         component.alias("component_id"), F.coalesce("_s_star", "_s_print").alias("_s_root"))


def keep_one(
    docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, max_bits: int = MAX_BITS,
) -> DataFrame:
    """One document of each component, with the columns it came with: that of the smallest key.

    Among rows that repeat a key the smallest hash of the text decides, of equal rows one stays; a
    null key comes last.  Fingerprints and decisions are made on a narrow table; texts are
    shuffled once, for the final join.
    """
    body = F.xxhash64(F.col(text).isNull(), F.col(text))
    narrow = docs.select(F.col(key).alias("_s_key"), F.col(text).alias("_s_text"), body.alias("_s_body"))
    prints = stored(with_fingerprints(narrow, "_s_text", shingle, "_s_print").drop("_s_text"), "prints")
    found = joined_components(prints, component_map(prints, "_s_key", max_bits), "_s_key")
    name = F.coalesce(F.col("_s_key").cast("string"), F.lit(""))
    first = F.min(F.struct(F.col("_s_key").isNull().alias("none"), F.col("_s_key"), name.alias("name"), F.col("_s_body")))
    kept = found.groupBy("_s_root").agg(first.alias("f")).select(
        F.col("f.none").alias("_s_none"), F.col("f.name").alias("_s_name"), F.col("f._s_body").alias("_s_body"))
    on = ["_s_none", "_s_name", "_s_body"]
    rows = docs.withColumns({
        "_s_none": F.col(key).isNull(), "_s_name": F.coalesce(F.col(key).cast("string"), F.lit("")), "_s_body": body})
    return rows.join(kept, on, "left_semi").dropDuplicates(on).select(*docs.columns)
