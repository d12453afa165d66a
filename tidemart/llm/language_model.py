"""Scoring of texts by a smoothed n-gram model that is as large as the corpus.

The model is a weighted backoff automaton.  Its states are the word sequences seen as histories in the
training texts; an arc reads a word with its smoothed log10 probability and leads to the longest suffix of
what was read that is a state; a failure arc leads to the state without the history's first word, at
the price of the history's log10 backoff weight.  A text is scored in one walk from left to right that
carries the state, takes failure arcs where there is no arc for the next word, and adds up.

Neither the counts nor the arcs fit into one task.  Texts are therefore put up in packs.  For each
order, from the highest down, a pack sends its distinct sequences to shards by hash, packed as sorted
differences; a shard adds up the counts over all packs and answers each pack with those it asked for.
A pack ends up with just the states and arcs that its own texts can take, and builds its part of the
automaton from them.

Words and sequences are compared by hashes, as wide as the corpus needs for one false match in
2 ** SPARE_BITS look-ups; so the counts of known tokens are exact but for that.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemart.llm.grams import NON_SPACE, Words, chain, small_batches, text_bytes
from tidemart.llm.text import stored
from tidemart.session import scratch_dir

ORDER = 3
#: Text of one pack, and of the corpus per shard, in bytes.
PACK_BYTES = 8 << 20
SHARD_BYTES = 16 << 20
SPARE_BITS = 24
#: Tokens of a text that one lane of a walk reads.
LANE = 256
# any two numbers that no word hashes to, but by chance
START, END = np.uint64(0x5354415254000001), np.uint64(0x454E440000000001)

_ASKED = "shard int, pack long, n int, keys binary, counts binary, followers binary"
_ANSWERS = "pack long, shard int, n int, counts binary, followers binary, owned binary, stats array<long>"


# ---- packed numbers ------------------------------------------------------------------------

def squeeze(numbers: np.ndarray) -> bytes:
    """Whole numbers as planes of bytes, lowest first, without planes that are all zero."""
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    while len(planes) and not planes[-1].any():
        planes = planes[:-1]
    return planes.tobytes()


def unsqueeze(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((8, n), np.uint8)
    planes = np.frombuffer(data, np.uint8).reshape(-1, n) if n else out
    out[:len(planes)] = planes
    return np.ascontiguousarray(out.T).view("<u8").reshape(-1)


# ---- packs ---------------------------------------------------------------------------------

def _packs(docs: DataFrame, key: str, text: str, held_out: Column, slots: int) -> DataFrame:
    """Consecutive texts by the pack, bucketed by pack so that later steps meet their answers in place."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("k"), F.coalesce(held_out, F.lit(False)).alias("h"), F.col(text).alias("t"))
    schema = T.StructType([
        T.StructField("pack", T.LongType()), T.StructField("ids", T.ArrayType(rows.schema["k"].dataType)),
        T.StructField("held", T.ArrayType(T.BooleanType())), T.StructField("sizes", T.ArrayType(T.LongType())),
        T.StructField("body", T.BinaryType()),
    ])

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, held, texts, total = TaskContext.get().partitionId() << 32, [], [], [], 0

        def emit() -> pa.RecordBatch:
            body = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([ids], pa.list_(kind)), pa.array([held], pa.list_(pa.bool_())),
                pa.array([list(map(len, texts))], pa.list_(pa.int64())), pa.array([body], pa.binary()),
            ], schema.names)

        for batch in batches:
            kind = batch.schema.field("k").type
            for k, h, t in zip(batch.column("k").to_pylist(), batch.column("h").to_pylist(), text_bytes(batch.column("t"))):
                if texts and total + len(t) > PACK_BYTES:
                    yield emit()
                    number, ids, held, texts, total = number + 1, [], [], [], 0
                ids.append(k)
                held.append(h)
                texts.append(t)
                total += len(t)
        if texts:
            yield emit()

    name = f"packs_{uuid.uuid4().hex}"
    rows.mapInArrow(gather, schema).write.bucketBy(slots, "pack").option("path", scratch_dir(docs.sparkSession, "packs")).option(
        "parquet.block.size", 16 << 20).saveAsTable(name)
    return docs.sparkSession.table(name)


class Pack:
    """The token sequences of a pack: each text is a start, its words and an end."""

    def __init__(self, row: dict, bits: int):
        self.ids, self.held = row["ids"], np.array(row["held"], bool)
        data, texts, at = zstandard.ZstdDecompressor().decompress(row["body"]) if sum(row["sizes"]) else b"", [], 0
        for size in row["sizes"]:
            texts.append(data[at:at + size])
            at += size
        words = Words(texts, NON_SPACE)
        lengths = words.counts() + 2
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.n_tokens = lengths - 1
        tokens = np.empty(self.ends[-1], np.uint64)
        inner = np.ones(len(tokens), bool)
        inner[self.starts] = inner[self.ends - 1] = False
        tokens[inner] = words.hashes()
        tokens[self.starts], tokens[self.ends - 1] = START, END
        self.tokens, self.bits = tokens, np.uint64(64 - bits)
        self.depth = np.arange(len(tokens)) - np.repeat(self.starts, lengths)
        self.training = np.repeat(~self.held, lengths)
        self.read = self.depth > 0
        self._levels: dict[int, tuple] = {}

    def level(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct sequences of n tokens; where each is found first; and for each position the number of
        the sequence that ends there, -1 where a text has just begun."""
        if n not in self._levels:
            h = self.tokens
            for k in range(1, n):
                longer = np.zeros_like(h)
                longer[k:] = chain(h[k - 1:-1], self.tokens[k:])
                h = longer
            ends = np.flatnonzero(self.depth >= n - 1)
            keys, first, inverse = np.unique(h[ends] >> self.bits, return_index=True, return_inverse=True)
            number = np.full(len(h), -1, np.int64)
            number[ends] = inverse
            self._levels[n] = keys, ends[first], number
        return self._levels[n]

    def followers(self, n: int, owned: np.ndarray) -> np.ndarray:
        """How many of the sequences of n + 1 tokens that this pack owns continue each of n tokens."""
        keys, _, number = self.level(n)
        _, found_at, _ = self.level(n + 1)
        return np.bincount(number[found_at[owned] - 1], minlength=len(keys))


# ---- counting ------------------------------------------------------------------------------

def _ask(pack: Pack, pack_id: int, n: int, shards: int, owned: np.ndarray | None) -> pa.Table:
    keys, _, number = pack.level(n)
    at = number[pack.training & (number >= 0)]
    counts = np.bincount(at, minlength=len(keys))
    followers = pack.followers(n, owned) if owned is not None else np.zeros(len(keys), np.int64)
    width = 64 - int(pack.bits)
    bounds = np.array([-(-(s << width) // shards) for s in range(1, shards)], np.uint64)
    cuts = np.concatenate(([0], np.searchsorted(keys, bounds), [len(keys)]))
    rows = []
    for s in np.flatnonzero(np.diff(cuts)).tolist():
        part = slice(cuts[s], cuts[s + 1])
        steps = np.diff(keys[part], prepend=np.uint64(0))
        rows.append((s, pack_id, len(steps), squeeze(steps), squeeze(counts[part]), squeeze(followers[part])))
    return _table(rows, _ASKED)


def _first_ask(n: int, bits: int, shards: int) -> Callable[[pa.Table], pa.Table]:
    def ask(own: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        return _ask(Pack(row, bits), row["pack"], n, shards, None)
    return ask


def _next_ask(n: int, bits: int, shards: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def ask(own: pa.Table, above: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        return _ask(Pack(row, bits), row["pack"], n, shards, _merged(above.to_pylist())[2])
    return ask


def _table(rows: list[tuple], ddl: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [part.strip().split(" ") for part in ddl.split(",")]
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.table([pa.array(list(c), kinds[kind]) for c, (_, kind) in zip(columns, fields)], [name for name, _ in fields])


def _answer(start_key: int | None) -> Callable[[pa.Table], pa.Table]:
    """Add up one shard's sequences over all packs; the first pack that trains on one owns it."""
    def answer(asked: pa.Table) -> pa.Table:
        messages = sorted(asked.to_pylist(), key=lambda m: m["pack"])
        keys = np.concatenate([np.cumsum(unsqueeze(m["keys"], m["n"]), dtype=np.uint64) for m in messages])
        counts = np.concatenate([unsqueeze(m["counts"], m["n"]) for m in messages]).astype(np.int64)
        followers = np.concatenate([unsqueeze(m["followers"], m["n"]) for m in messages]).astype(np.int64)
        distinct, inverse = np.unique(keys, return_inverse=True)
        totals = np.bincount(inverse, counts, len(distinct)).astype(np.int64)
        continued = np.bincount(inverse, followers, len(distinct)).astype(np.int64)
        trained = np.flatnonzero(counts)
        owned = np.zeros(len(keys), bool)
        owned[trained[np.unique(keys[trained], return_index=True)[1]]] = True
        words = totals if start_key is None else totals[distinct != np.uint64(start_key)]
        stats = [int(words.sum()), int((words > 0).sum()), int((words == 1).sum()), int((words == 2).sum())]
        rows = [(-1, messages[0]["shard"], 0, b"", b"", b"", stats)]
        at = 0
        for m in messages:
            part = slice(at, at + m["n"])
            at += m["n"]
            rows.append((m["pack"], m["shard"], m["n"], squeeze(totals[inverse[part]]),
                         squeeze(continued[inverse[part]]), np.packbits(owned[part]).tobytes(), None))
        return _table(rows, _ANSWERS)
    return answer


def _merged(answers: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A pack's counts, followers and owned marks of one order, in the order of its keys."""
    answers = sorted(answers, key=lambda m: m["shard"])
    joined = lambda parts: np.concatenate([np.empty(0, np.int64), *parts]).astype(np.int64)  # a pack may have no sequences
    return (
        joined(unsqueeze(m["counts"], m["n"]) for m in answers), joined(unsqueeze(m["followers"], m["n"]) for m in answers),
        joined(np.unpackbits(np.frombuffer(m["owned"], np.uint8), count=m["n"]) for m in answers).astype(bool),
    )


# ---- scoring -------------------------------------------------------------------------------

class Smoothing:
    """Totals and absolute discounts by order, from the numbers of sequences seen once and twice."""

    def __init__(self, stats: dict[int, list[int]]):
        self.tokens, self.words = stats[1][0], stats[1][1]
        self.discounts = {n: once / (once + 2 * twice) if once and twice else 0.5 for n, (_, _, once, twice) in stats.items()}


class Automaton:
    """The states and arcs that the texts of a pack can take.

    Every distinct sequence of the pack has a number, orders one after the other, 0 being the empty one.  A
    sequence that was a history in training is a state; one that was seen at all is the arc from the state
    of its words but the last.  By number: `log_p` of the arc (NaN: none) and the state `to` which it
    leads, and of a state the `length`, the failure arc `fails_to` and its weight `log_back`.
    """

    def __init__(self, pack: Pack, levels: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], model: Smoothing):
        self.order, size, bases = max(levels), 1, {}
        for n in range(1, self.order + 1):
            bases[n], size = size, size + len(levels[n][0])
        self.to, self.fails_to, self.length = np.zeros(size, np.int32), np.zeros(size, np.int32), np.zeros(size, np.int8)
        self.log_back, p = np.zeros(size), np.full(size, np.nan)
        self.is_state = np.zeros(size, bool)
        #: The sequence of n + 1 tokens that ends at each position, 0 where the text is too short for it.
        self.ending = np.zeros((self.order, len(pack.tokens)), np.int32)
        total = max(model.tokens, 1)
        self.is_state[0] = True
        for n in range(1, self.order + 1):
            counts, followers, _ = levels[n]
            _, found_at, number = pack.level(n)
            own = slice(bases[n], bases[n] + len(counts))
            self.ending[n - 1] = np.where(number >= 0, number + bases[n], 0)
            shorter = self.ending[n - 2][found_at] if n > 1 else np.zeros(len(counts), np.int32)
            d = model.discounts[n]
            if n == 1:
                # what was discounted is the unknown word's, which any word not seen in training is
                unknown = max(d * model.words, 0.0) / total if model.tokens else 1.0
                p[own] = np.where(counts > 0, (counts - d) / total, unknown)
            else:
                history = self.ending[n - 2][found_at - 1]
                seen = np.maximum(histories[history - bases[n - 1]], 1)
                inherited = 10.0 ** self.log_back[history] * p[shorter]
                p[own] = np.where(counts > 0, (counts - d) / seen + inherited, np.nan)
            if n < self.order:
                state, above = counts > 0, model.discounts[n + 1]
                self.is_state[own] = state
                self.length[own] = n
                self.fails_to[own] = self.to[shorter]
                with np.errstate(divide="ignore"):
                    self.log_back[own] = np.log10(np.where(state, above * followers / np.maximum(counts, 1), 1.0))
                self.to[own] = np.where(state, np.arange(own.start, own.stop), self.to[shorter])
            else:
                self.to[own] = self.to[shorter]
            histories = counts
        self.log_p = np.log10(p)

    def state_after(self, at: np.ndarray) -> np.ndarray:
        """The state that has read a text up to each position: the longest suffix that is one."""
        state = np.zeros(len(at), np.int32)
        for n in range(1, self.order):
            longer = self.ending[n - 1][at]
            state = np.where((longer > 0) & self.is_state[longer], longer, state)
        return state

    def walk(self, pack: Pack) -> np.ndarray:
        """The log10 probability of each text.

        Texts are read side by side, a word of each at a time, in lanes of `LANE` words; a lane that begins inside
        a text starts in the state in which the lane before it ends.
        """
        lanes = -(-pack.n_tokens // LANE)
        text = np.repeat(np.arange(len(lanes)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        first = pack.starts[text] + 1 + nth * LANE
        left = np.minimum(pack.n_tokens[text] - nth * LANE, LANE)
        longest_first = np.argsort(-left, kind="stable")
        text, first, left = text[longest_first], first[longest_first], left[longest_first]
        state, score = self.state_after(first - 1), np.zeros(len(text))
        active = np.searchsorted(-left, -np.arange(LANE), side="left")  # lanes with more than so many words
        for step in range(LANE):
            n = int(active[step])
            if not n:
                break
            now, at = state[:n], first[:n] + step
            arc = self.ending[self.length[now], at]
            missing = np.flatnonzero(np.isnan(self.log_p[arc]))
            while len(missing):
                score[missing] += self.log_back[now[missing]]
                now[missing] = self.fails_to[now[missing]]
                arc[missing] = self.ending[self.length[now[missing]], at[missing]]
                missing = missing[np.isnan(self.log_p[arc[missing]])]
            score[:n] += self.log_p[arc]
            now[:] = self.to[arc]
        return np.bincount(text, score, len(lanes))


def _scores(pack: Pack, levels: dict[int, tuple], model: Smoothing) -> list[np.ndarray]:
    c = levels[1][0][pack.level(1)[2]]
    base = np.log10((c + 0.5) / (model.tokens + 0.5 * (model.words + 1)))
    base[~pack.read] = 0.0
    known = (c > 0) & pack.read
    add = lambda x: np.add.reduceat(x, pack.starts)
    return [add(known.astype(np.int64)), add(base), Automaton(pack, levels, model).walk(pack)]


def score_documents(
    docs: DataFrame, held_out: Column, text: str = "text", key: str = "doc_id", order: int = ORDER,
) -> DataFrame:
    """Score every text by a model learnt from those that `held_out` does not exclude.

    Returns `key`, `held_out`, `n_tokens`, `n_known` (tokens seen in training), `train_tokens`,
    `base_score` (add-half unigrams) and `score`, both as log10 of the text's probability.  Tokens are the words
    between white space, A-Z lower-cased, and one end.  Sequences up to `order` tokens are smoothed by
    interpolated absolute discounting; all unknown words together are one word of the model.

    A null or empty text is just an end.  A null `held_out` counts as training; a null key passes through.
    Repeated rows are trained on and scored one by one.  Without training texts every token is
    unknown, with probability 1 for both scores.  An empty table gives no rows.  Other columns are dropped.

    Counts are over all training texts, unpruned.  A sequence costs one entry per pack and order, however
    often it occurs there, and entries are dealt by hash, so neither a hot word nor a hot history
    burdens one task.  Texts are not shuffled: packs are stored once, in buckets, and their answers
    come to them.  Every round is a stored table, so a lost executor costs at most the round under way.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = int(max(2 * slots, total // SHARD_BYTES))
    bits = min(64, int(total + 1).bit_length() + SPARE_BITS)
    packs = _packs(docs, key, text, held_out, slots)
    start_key = int(START) >> (64 - bits)
    answers: dict[int, DataFrame] = {}
    stats: dict[int, list[int]] = {}
    for n in range(order, 0, -1):
        if n == order:
            asked = packs.groupBy("pack").applyInArrow(_first_ask(n, bits, shards), _ASKED)
        else:
            above = answers[n + 1].where("pack >= 0").drop("stats")
            asked = packs.groupBy("pack").cogroup(above.groupBy("pack")).applyInArrow(_next_ask(n, bits, shards), _ASKED)
        answers[n] = stored(asked.groupBy("shard").applyInArrow(_answer(start_key if n == 1 else None), _ANSWERS), f"order-{n}")
        sums = answers[n].where("pack < 0").agg(*(F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)) for i in range(4))).first()
        stats[n] = list(sums)
    model = Smoothing(stats)
    schema = T.StructType([
        T.StructField(key, docs.schema[key].dataType), T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
    ])

    def score(own: pa.Table, replies: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        pack = Pack(row, bits)
        by_level: dict[int, list[dict]] = {n: [] for n in stats}
        for m in replies.to_pylist():
            by_level[m["level"]].append(m)
        known, base, scores = _scores(pack, {n: _merged(m) for n, m in by_level.items()}, model)
        return pa.table([
            own.column("ids").combine_chunks().flatten(), pa.array(pack.held), pa.array(pack.n_tokens), pa.array(known),
            pa.array(np.full(len(known), model.tokens, np.int64)), pa.array(base), pa.array(scores),
        ], schema.names)

    everything = reduce(DataFrame.union, (
        a.where("pack >= 0").drop("stats").withColumn("level", F.lit(n)) for n, a in answers.items()))
    return packs.groupBy("pack").cogroup(everything.groupBy("pack")).applyInArrow(score, schema)


def fifth_held_out(key: str = "doc_id", remainder: int = 1) -> Column:
    """Documents whose key, as text, has a CRC-32 with this remainder by five."""
    return F.crc32(F.col(key).cast("string")) % 5 == remainder
