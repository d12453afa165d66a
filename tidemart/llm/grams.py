"""Words of many texts at once: byte spans, 64-bit hashes and window hashes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

#: Texts are taken together up to this many bytes.
PIECE_BYTES = 4 << 20
#: Longer words are hashed one by one.
LONG_WORD = 256
#: Rows of texts handed to a Python task at once, at most.
ARROW_ROWS = 1000

# fixed odd multipliers of the bit mixer
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first:last + 1] = True
    return table


#: Everything but space and 09-0D.
NON_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Digits, a-z and every character beyond ASCII, for texts that are lower-cased already.
ALPHANUMERIC = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def small_batches(spark) -> None:
    """Hand texts to Python in batches of at most `ARROW_ROWS` rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def pieces(texts: list[bytes], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts come to about `limit` bytes; a longer text is alone in its range."""
    first = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > limit:
            yield first, i
            first, total = i, 0
        total += len(t)
    if first < len(texts):
        yield first, len(texts)


class Words:
    """The words of some texts, A-Z lower-cased.

    `starts` and `ends` are byte positions in `data`, `first` the number of the first word of each
    text and, at its end, the number of all words; `at` is where each text begins in `data`.
    """

    def __init__(self, texts: list[bytes], inside: np.ndarray):
        self.data = b"\n".join(texts).lower() + b"\n"
        self.buffer = np.frombuffer(self.data, np.uint8)
        marks = np.diff(inside[self.buffer].view(np.int8), prepend=np.int8(0))
        self.starts, self.ends = np.flatnonzero(marks == 1), np.flatnonzero(marks == -1)
        self.at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)))
        self.first = np.searchsorted(self.starts, self.at)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, from its bytes taken eight at a time and its length."""
        starts, lengths = self.starts, self.ends - self.starts
        padded = np.concatenate((self.buffer, np.zeros(8, np.uint8)))
        eights = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        h = lengths.astype(np.uint64) * _M2
        live = np.flatnonzero(lengths <= LONG_WORD)
        offset = 0
        while len(live):
            left = np.minimum(lengths[live] - offset, 8).astype(np.uint64)
            block = eights[starts[live] + offset] & (~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * left))
            h[live] = mix(h[live] ^ block)
            offset += 8
            live = live[lengths[live] > offset]
        for i in np.flatnonzero(lengths > LONG_WORD):
            word = self.data[self.starts[i]:self.ends[i]]
            h[i] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return h

    def joined(self, first: int, end: int) -> bytes:
        """Words `first` to `end - 1`, a space between each two."""
        return b" ".join([self.data[s:e] for s, e in zip(self.starts[first:end], self.ends[first:end])])


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of a word sequence made longer by one word."""
    return mix(left * _M1 + right)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each `size` consecutive words, by first word; empty if there are fewer."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = words[:n]
    for k in range(1, size):
        h = chain(h, words[k:n + k])
    return h
