"""The prefix trie against a plain one."""

import hashlib
import random
import zlib

import pytest

from tidemart.llm import conversation_trie as trie
from tidemart.llm import queries

WORDS = lambda text: len(text.split())  # noqa: E731  the tests' texts have no other spaces


def plain_rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, hashlib.md5(f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()).digest()))
    out = {}
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - int(conv / 20) * 20  # the sign of the remainder is that of conv
        out[conv] = [t[1:] for t in own.get(conv - base, [])[:h] + own[conv][h:]]
    return out


def plain_trie(sequences):
    members = {}
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    totals = {}
    for path in sorted(members, key=len, reverse=True):
        below = [totals[c] for c in children.get(path, [])]
        saved = (len(members[path]) - 1) * WORDS(path[-1][1]) if path else 0
        totals[path] = saved + sum(b[0] for b in below), sum(b[1] for b in below) or 1
    out = set()
    for path, own in members.items():
        ends = sorted(c for c in own if len(sequences[c]) == len(path))
        out.add((min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(children.get(path, [])),
                 totals[path][1], totals[path][0], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def make(spark, rows):
    return spark.createDataFrame([(*r, "mark", "mark", "mark") for r in rows],
                                 "conv_id long, turn long, role string, text string, pos string, d string, run string")


def built(spark, rows):
    turns = trie.turns_in_order(make(spark, rows))
    nodes = trie.prefix_trie(trie.share_openings(turns), turns.select("conv").distinct())
    got = [tuple(r) for r in nodes.collect()]
    assert len(got) == len(set(got))
    return set(got)


def conversations(seed, n, longest):
    rng, rows = random.Random(seed), []
    for conv in rng.sample(range(-50, 400), n):
        for turn in range(rng.randrange(1, longest)):
            rows.append((conv, rng.choice([turn, turn, None]), rng.choice(["user", "bot", None]),
                         rng.choice(["hi", "hi there", "", None, "a b c", "a b c"])))
    return rows


@pytest.mark.parametrize("seed,longest", [(1, 3), (2, 6), (3, 12)])
def test_same_as_the_plain_trie(spark, seed, longest):
    rows = conversations(seed, 60, longest)
    assert built(spark, rows) == plain_trie(plain_rebuilt(rows))


def test_long_conversations_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 4)
    monkeypatch.setattr(trie, "IDS", 3)
    rows = [(conv, turn, "user", "same words") for conv in range(20, 38) for turn in range(30)]
    rows += [(conv, turn, "user", "same words" if turn < conv - 100 else f"own {conv}") for conv in range(101, 115) for turn in range(20)]
    rows += conversations(4, 20, 25)
    assert built(spark, rows) == plain_trie(plain_rebuilt(rows))


def test_turnless_and_copied_conversations(spark):
    # conversations of fewer own turns than they would skip, without a base, are turnless; repeated rows are turns
    rows = [(c, 0, "user", "one two") for c in range(200, 260)] + [(c, 0, "user", "one two") for c in (205, 206, 207)]
    rows += [(None, 0, "user", "nobody")]
    want = plain_trie(plain_rebuilt(rows))
    assert any(x[1] == 0 for x in want)
    assert built(spark, rows) == want


def test_no_conversations(spark):
    assert built(spark, []) == set()
    assert built(spark, [(None, 1, "user", "x")]) == set()


def test_query_equals_the_plain_trie(spark, tmp_path):
    rows = conversations(9, 40, 8)
    make(spark, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {tuple(r) for r in queries.op12_prefix_trie(spark, str(tmp_path)).collect()}
    assert got == plain_trie(plain_rebuilt(rows))
