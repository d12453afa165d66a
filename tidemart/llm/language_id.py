"""Language identification: words first, character n-grams where a word is unknown.

A model has, per language, the log frequencies of words and of character n-grams.  A word that some
language knows is scored by its log frequencies; any other falls back to its longest n-grams that some
language knows, from `LONGEST` letters down to one.  A text's score is the mean over its words.

The model is fitted on a bounded sample of labelled rows: about `TRAIN_BYTES` of text per language,
drawn by a hash of the rows, and of it the `ENTRIES` most frequent words and n-grams of each length per
language.  So the model is as large for any corpus, and is broadcast; every text is judged as a whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemart.llm.grams import small_batches
from tidemart.llm.text import stored

#: Letters of the longest n-grams.
LONGEST = 5
#: Text the model is fitted on, in bytes per language, as expected over the draw.
TRAIN_BYTES = 2 << 20
#: Words per language, and n-grams per length and language, that the model holds at most.
ENTRIES = 50_000
UNDETERMINED = "und"
#: Longer texts are cut into words piece by piece.
WHOLE_CHARS = 1 << 18
#: Scores of unknown words that a task keeps at hand; more than the words of a piece.
CACHED = 1 << 18

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_COUNTS = "word string, lang string, count long"


def word_pieces(text: str) -> Iterator[list[str]]:
    """The lower-cased words (a letter, then letters and marks) of a text, in lists of bounded length."""
    if len(text) <= WHOLE_CHARS:
        yield WORD.findall(text.lower())
        return
    found = (m.group().lower() for m in WORD.finditer(text))
    while piece := list(islice(found, WHOLE_CHARS // 2)):
        yield piece


def ngrams(word: str, n: int) -> list[str]:
    """The n-grams of a word between two blanks; a lone blank is none."""
    padded = f" {word} " if n > 1 else word
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each batch, counted per language."""
    for batch in batches:
        counts: Counter = Counter()
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            for piece in word_pieces(text):
                counts.update(zip(piece, repeat(lang)))
        if counts:
            word, lang = zip(*counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(word), pa.array(lang), pa.array(counts.values(), pa.int64())], ["word", "lang", "count"])


def _grams(words: DataFrame) -> DataFrame:
    """Words (as n = 0) and their n-grams, the same as `ngrams` gives, counted per language."""
    def cut(n: int) -> Column:
        whole = F.concat(F.lit(" "), "word", F.lit(" ")) if n > 1 else F.col("word")
        return F.when(F.length(whole) >= n, F.transform(
            F.sequence(F.lit(1), F.length(whole) - n + 1),
            lambda i: F.struct(F.lit(n).alias("n"), F.substring(whole, i, F.lit(n)).alias("gram"))))

    none = F.array().cast("array<struct<n:int,gram:string>>")
    grams = words.select(F.explode(F.concat(*(F.coalesce(cut(n), none) for n in range(1, LONGEST + 1)))).alias("g"), "lang", "count")
    return words.select(F.lit(0).alias("n"), F.col("word").alias("gram"), "lang", "count").union(
        grams.groupBy("g.n", "g.gram", "lang").agg(F.sum("count").alias("count")))


class Model:
    """Log frequencies by language.  `words` and `grams` give rows of `logs`; row 0 is that of no evidence."""

    def __init__(self, languages: list[str], first: int, totals: dict[tuple[int, str], int],
                 counts: list[tuple[int, str, str, int]]):
        self.languages, self.first = languages, first
        place = {lang: i for i, lang in enumerate(languages)}
        most = {n: max(totals.get((n, lang), 0) for lang in languages) for n in range(LONGEST + 1)} if languages else {}
        self.words: dict[str, int] = {}
        self.grams: dict[str, int] = {}
        entries = []
        for n, gram, lang, count in counts:
            rows = self.grams if n else self.words
            at = rows.get(gram)
            if at is None:
                at = rows[gram] = len(entries) + 1
                # where a language lacks the entry, half an occurrence among the most that any has
                entries.append(np.full(len(languages), np.log10(0.5 / most[n]), np.float64))
            entries[at - 1][place[lang]] = np.log10(count / totals[n, lang])
        self.logs = np.array([np.zeros(len(languages)), *entries])


def fit(docs: DataFrame, train: Column, text: str = "text", lang: str = "lang", train_bytes: int = TRAIN_BYTES) -> Model:
    """A model of the rows that `train` keeps and whose text and language are not null.

    A language of more than `train_bytes` of text is drawn from: a row stays if a hash of its text and
    language, as a share of all hashes, is below train_bytes over the language's bytes, so copies
    stay or go together.  What is collected is bounded by `ENTRIES` per language and length.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"),
                       F.coalesce(train, F.lit(False)).alias("train")).where("train and text is not null and lang is not null")
    sizes = {r["lang"]: r["bytes"] for r in rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], 0, {}, [])
    share = F.element_at(F.create_map(*(
        F.lit(x) for name in languages for x in (name, train_bytes / max(sizes[name], 1)))), F.col("lang"))
    unit = F.shiftrightunsigned(F.xxhash64("text", "lang"), 11) / float(1 << 53)
    words = stored(rows.where(unit < share).select("text", "lang").mapInArrow(_counted, _COUNTS).groupBy("word", "lang").agg(
        F.sum("count").alias("count")), "words")
    counts = stored(_grams(words), "grams")
    totals = {(r["n"], r["lang"]): r["total"] for r in counts.groupBy("n", "lang").agg(F.sum("count").alias("total")).collect()}
    rank = F.row_number().over(Window.partitionBy("n", "lang").orderBy(F.desc("count"), "gram"))
    kept = counts.withColumn("rank", rank).where(F.col("rank") <= ENTRIES).select("n", "gram", "lang", "count").toArrow()
    learnt = [name for name in languages if (0, name) in totals]
    first = max(range(len(learnt)), key=lambda i: sizes[learnt[i]], default=0)
    return Model(learnt, first, totals, sorted(zip(*(kept.column(c).to_pylist() for c in kept.column_names))))


class Lookup(dict):
    """The rows of known words; those of other words are made when first asked for."""

    def __init__(self, model: Model, room: int):
        super().__init__(model.words)
        self.model, self.logs = model, np.concatenate((model.logs, np.zeros((room, len(model.languages)))))
        self.free = len(model.logs)

    def __missing__(self, word: str) -> int:
        """The row of a word that no language knows: the mean over its longest n-grams that one does."""
        at = 0
        for n in range(LONGEST, 0, -1):
            known = [row for gram in ngrams(word, n) if (row := self.model.grams.get(gram))]
            if known:
                at = self.free
                self.logs[at] = self.model.logs[known].mean(axis=0)
                self.free += 1
                break
        self[word] = at
        return at


class Scorer:
    """Judges texts; what it finds out about unknown words is kept at hand, up to `room` of them."""

    def __init__(self, model: Model, room: int = CACHED):
        self.model, self.room, self.rows = model, room, Lookup(model, room)

    def add_up(self, words: list[str]) -> tuple[np.ndarray, int]:
        """The sum of log frequencies over words, and how many of them say anything."""
        if len(self.rows) - len(self.model.words) + len(words) > self.room:
            self.rows = Lookup(self.model, self.room)
        at = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        return self.rows.logs[at].sum(axis=0), int(np.count_nonzero(at))

    def judge(self, text: str | None) -> tuple[str, float]:
        """The language, and the share it has of the languages' mean likelihoods per word."""
        total, heard, letters = np.zeros(len(self.model.languages)), 0, False
        for piece in word_pieces(text or ""):
            if piece:
                letters = True
                if self.model.languages:
                    sums, n = self.add_up(piece)
                    total, heard = total + sums, heard + n
        if not letters or not self.model.languages:
            return UNDETERMINED, 0.0
        if not heard:
            return self.model.languages[self.model.first], 1.0 / len(total)
        likely = 10.0 ** ((total - total.max()) / heard)
        best = int(likely.argmax())
        return self.model.languages[best], float(likely[best] / likely.sum())


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add `lang_pred` and `score` (0 to 1) to each row; columns of these names are replaced.

    A text that is null or has no letter is `und` with score 0, and so is every text under a model
    without languages.  Where no word says anything, not even by its letters, the language with the
    most training text is given, with an even share.  Ties go to the language that sorts first.  Rows
    are judged one by one, so repeated rows agree; an empty table stays empty.  Nothing is shuffled.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(*(c for c in docs.columns if c not in ("lang_pred", "score")))
    shared = spark.sparkContext.broadcast(model)
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.judge(t) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                schema.names)

    return rows.mapInArrow(judge, schema)


def quarter_held_out(key: str = "doc_id", remainder: int = 2) -> Column:
    """Documents whose key, as text, has a CRC-32 with this remainder by four; a null key trains."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == remainder, F.lit(False))
