"""Token counts of texts as a given tokenizer makes them, mostly without running its merges.

Beforehand, every vocabulary string that can stand alone is encoded; those that give exactly one
token form the whole-token table.  Texts are then cut into pre-tokens; those in the table count one
each, and only the others go through the tokenizer's merges.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from tidemart.llm.grams import small_batches

#: Pre-tokens with counted merges that a task remembers; it forgets all beyond that.
REMEMBERED = 200_000
# fixed pre-token pattern of the vocabulary
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
#: Texts of these characters alone are cut here; composition, case and classes leave no doubt about them.
PLAIN = r"[\t\n\r\x20-\x7E\xA1-\xAC\xAE-\u012F\u0131-\u024F\u2010-\u2027\u2030-\u205E\u20AC]*+"
SPECIAL = "<|"


def load(definition: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def whole_tokens(definition: str, word_end: str = "</w>") -> frozenset[str]:
    """The strings that the tokenizer encodes as exactly one token when they stand alone.

    Candidates are the vocabulary's entries that end a word; each is encoded, and those that its
    normalisation changes, or that give more than one token, are left out.
    """
    tokenizer = load(definition)
    letters, found = _byte_letters(), []
    for entry in tokenizer.get_vocab(with_added_tokens=False):
        if entry.endswith(word_end):
            try:
                text = bytes(letters[c] for c in entry[:-len(word_end)]).decode()
            except (KeyError, UnicodeDecodeError):
                continue
            if text and tokenizer.normalizer.normalize_str(text) == text:
                found.append(text)
    encoded = tokenizer.encode_batch(found, add_special_tokens=False)
    return frozenset(t for t, e in zip(found, encoded) if len(e.ids) == 1)


class Counter:
    """Counts tokens of texts in one task."""

    def __init__(self, definition: str, whole: frozenset[str]):
        self.tokenizer, self.whole = load(definition), whole
        self.pre_tokens, self.plain = regex.compile(PRE_TOKEN).findall, regex.compile(PLAIN).fullmatch
        self.known: dict[str, int] = dict.fromkeys(whole, 1)

    def count(self, texts: list[str | None]) -> list[int]:
        """Texts with special strings or doubtful characters are encoded as a whole."""
        cut: list[list[str] | None] = []
        for text in texts:
            if not text:
                cut.append([])
            elif SPECIAL not in text and self.plain(text):
                cut.append(self.pre_tokens(text.lower()))
            else:
                cut.append(None)
        rest = [t for t, parts in zip(texts, cut) if parts is None]
        whole = iter([len(e.ids) for e in self.tokenizer.encode_batch(rest, add_special_tokens=False)] if rest else ())
        if len(self.known) > len(self.whole) + REMEMBERED:
            self.known = dict.fromkeys(self.whole, 1)
        unknown = list(set().union(*(p for p in cut if p)).difference(self.known))
        for i in range(0, len(unknown), 1000):
            part = unknown[i:i + 1000]
            encoded = self.tokenizer.encode_batch(part, add_special_tokens=False)
            self.known.update(zip(part, [len(e.ids) for e in encoded]))
        cost = self.known.__getitem__
        return [next(whole) if parts is None else sum(map(cost, parts)) for parts in cut]


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """Add `n_tokens`, the tokens of the whole text without begin, end or added special tokens.

    `vocabulary` is the path of a tokenizer definition that the driver can read: a byte-level BPE with
    word ends over the pre-tokens of `PRE_TOKEN`.  The definition and the whole-token table are
    broadcast; both are as large as the vocabulary, whatever the corpus.  Null and empty texts
    have 0 tokens; special strings inside a text count as the library takes them by default.  Rows
    keep their order and all columns, one named `n_tokens` is replaced; an empty table stays empty.
    One scan, no shuffle.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(vocabulary, encoding="utf-8") as file:
        definition = file.read()
    shared = spark.sparkContext.broadcast((definition, whole_tokens(definition)))
    rows = docs.drop("n_tokens")
    columns = rows.columns

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(*shared.value)
        for batch in batches:
            counts: list[int] = []
            column = batch.column(text)
            for i in range(0, len(column), 200):
                counts += counter.count(pc.cast(column.slice(i, 200), pa.large_string()).to_pylist())
            yield pa.RecordBatch.from_pydict(
                {c: batch.column(c) for c in columns} | {"n_tokens": pa.array(counts, pa.int64())})

    return rows.mapInArrow(scan, T.StructType([*rows.schema.fields, T.StructField("n_tokens", T.LongType())]))


def with_limit(counted: DataFrame, limit: int) -> DataFrame:
    """Add `over_limit` to counted documents."""
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
