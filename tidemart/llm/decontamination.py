"""Removal of benchmark passages from documents.

The benchmark's windows of consecutive words are hashed into a set that is broadcast.  Each task
hashes its documents' windows, looks them up, compares the words of every match, and marks the words
of the confirmed ones.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemart.llm.grams import ALPHANUMERIC, Words, pieces, small_batches, text_bytes, window_hashes
from tidemart.llm.text import stored

WINDOW = 10
#: Benchmark text of one broadcast, in bytes; a larger benchmark takes several passes.
BLOCK_BYTES = 8 << 20
FILTER_BITS = 20

SPANS = T.ArrayType(T.StructType([
    T.StructField(name, T.LongType()) for name in ("first_word", "end_word", "start_byte", "end_byte")
]))
_SPANS_ARROW = pa.list_(pa.struct([(f.name, pa.int64()) for f in SPANS.elementType.fields]))
_ADDED = [T.StructField("n_words", T.LongType()), T.StructField("spans", SPANS),
          T.StructField("item_ids", T.ArrayType(T.StringType()))]


class Windows:
    """The windows of one block of benchmark items, by window size and hash.

    Items of fewer words than a window are one window of their own size; items without words have none.
    """

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        words = Words([text for _, text in items], ALPHANUMERIC)
        hashes = words.hashes()
        groups: dict[tuple[int, int], dict[bytes, set]] = {}
        for (item, _), first, end in zip(items, words.first, words.first[1:]):
            size = min(window, int(end - first))
            for k, h in enumerate(window_hashes(hashes[first:end], size) if size else ()):
                text = words.joined(first + k, first + k + size)
                groups.setdefault((size, int(h)), {}).setdefault(text, set()).add(item)
        self.found = {key: [(text, sorted(x for x in ids if x is not None)) for text, ids in texts.items()]
                      for key, texts in groups.items()}
        self.sizes = sorted({size for size, _ in groups})
        self.filters = {}
        for size in self.sizes:
            bits = np.zeros(1 << FILTER_BITS, bool)
            bits[[h >> (64 - FILTER_BITS) for s, h in groups if s == size]] = True
            known = np.array(sorted(h for s, h in groups if s == size), np.uint64)
            self.filters[size] = bits, known


def _marks(texts: list[bytes], earlier: list[tuple[list, list]], windows: Windows) -> Iterator[tuple[int, list, list]]:
    """Number of words, spans and item ids of each text, with what earlier blocks found."""
    words = Words(texts, ALPHANUMERIC)
    hashes = words.hashes()
    hit = np.zeros(len(hashes) + 1, bool)
    ids: list[set] = [set(x[1]) for x in earlier]
    for i, (spans, _) in enumerate(earlier):
        for s in spans:
            hit[words.first[i] + s["first_word"]:words.first[i] + s["end_word"]] = True
    for size in windows.sizes:
        h = window_hashes(hashes, size)
        bits, known = windows.filters[size]
        near = np.flatnonzero(bits[h >> np.uint64(64 - FILTER_BITS)])
        near = near[np.isin(h[near], known)]
        texts_of = np.searchsorted(words.first, near, "right") - 1
        inside = near + size <= words.first[texts_of + 1]
        for k, i in zip(near[inside].tolist(), texts_of[inside].tolist()):
            text = words.joined(k, k + size)
            for window, items in windows.found[size, int(h[k])]:
                if window == text:
                    hit[k:k + size] = True
                    ids[i].update(items)
    for i, (first, end) in enumerate(zip(words.first.tolist(), words.first[1:].tolist())):
        spans = []
        if hit[first:end].any():
            edges = np.flatnonzero(np.diff(hit[first:end].view(np.int8), prepend=np.int8(0), append=np.int8(0)))
            for a, b in edges.reshape(-1, 2).tolist():
                spans.append({
                    "first_word": a, "end_word": b,
                    "start_byte": int(words.starts[first + a] - words.at[i]),
                    "end_byte": int(words.ends[first + b - 1] - words.at[i])})
        yield end - first, spans, sorted(ids[i])


def _blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[list[tuple[str | None, bytes]]]:
    rows, total = [], 0
    for r in benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).toLocalIterator():
        body = (r.t or "").encode()
        if rows and total + len(body) > limit:
            yield rows
            rows, total = [], 0
        rows.append((r.i, body))
        total += len(body)
    yield rows


def find_passages(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Add `n_words`, `spans` and `item_ids` to each document.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased.  `spans` are the
    ranges of words that lie in some occurrence of a benchmark window, as word numbers and as bytes
    of the UTF-8 text; `item_ids` are the items with an occurring window, as sorted strings.

    A null or empty text has no words and no spans.  Items without words match nothing; an item
    with a null id marks words but has no id to list; repeated items count once.  Repeated documents
    are marked alike.  Empty tables give no rows and no marks.  Columns of these names are replaced.

    The benchmark reaches the tasks in blocks of at most `block_bytes` of text (one item may be larger),
    so what is broadcast has a fixed bound.  One block takes one pass without any shuffle; beyond
    that, each block is a pass over a stored table that carries the marks so far.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.drop(*(f.name for f in _ADDED))
    names, schema = rows.columns, T.StructType([*rows.schema.fields, *_ADDED])
    found = None
    for block in _blocks(benchmark, item, item_text, block_bytes):
        windows = spark.sparkContext.broadcast(Windows(block, window))

        def scan(batches: Iterable[pa.RecordBatch], windows=windows) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bodies = text_bytes(batch.column(text))
                carried = batch.schema.get_field_index("spans") >= 0
                for a, b in pieces(bodies):
                    part = batch.slice(a, b - a)
                    earlier = [([], [])] * (b - a)
                    if carried:
                        earlier = list(zip(part.column("spans").to_pylist(), part.column("item_ids").to_pylist()))
                    counts, spans, ids = zip(*_marks(bodies[a:b], earlier, windows.value))
                    columns = {name: part.column(name) for name in names}
                    yield pa.RecordBatch.from_pydict(columns | {
                        "n_words": pa.array(counts, pa.int64()), "spans": pa.array(spans, _SPANS_ARROW),
                        "item_ids": pa.array(ids, pa.list_(pa.string()))})

        source = rows if found is None else stored(found, "passages")
        found = source.mapInArrow(scan, schema)
    return found


def _wrapped(docs: DataFrame, text: str) -> DataFrame:
    """The text, and all other columns as one, so that none is replaced by a mark."""
    others = [c for c in docs.columns if c != text]
    return docs.select(F.col(text).alias("text"), *([F.struct(*others).alias("_d_row")] if others else []))


def _unwrapped(found: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    return found.select(*(F.col("text").alias(c) if c == text else F.col("_d_row")[c].alias(c) for c in docs.columns))


def drop_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents without any benchmark passage, with the columns they came with."""
    found = find_passages(_wrapped(docs, text), benchmark, **options)
    return _unwrapped(found.where(F.size("spans") == 0), docs, text)


def cut_passages(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All documents, without the text from the first to the last word of each span."""
    rows = _wrapped(docs, text)
    found, names = find_passages(rows, benchmark, **options), rows.columns

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column("text").cast(pa.large_binary()).to_pylist()
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                for s in reversed(spans):
                    bodies[i] = bodies[i][:s["start_byte"]] + bodies[i][s["end_byte"]:]
            texts = pa.array([None if x is None else x.decode() for x in bodies], pa.string())
            yield pa.RecordBatch.from_pydict({c: texts if c == "text" else batch.column(c) for c in names})

    return _unwrapped(found.mapInArrow(cut, rows.schema), docs, text)
