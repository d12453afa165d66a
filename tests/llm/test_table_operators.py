"""Operators that deal rows: mixing, sharding, near-duplicates, archives."""

import gzip
import random
from collections import defaultdict

import brute
import pytest
from llm_tables import make_docs
from pyspark.sql import functions as F

from tidemart.llm import components, mixing, sharding, simhash, warc

WEIGHTS = (5, 2, 1)


def mixed(docs):
    return mixing.assign(mixing.with_size(docs))


def test_mix_meets_targets(spark, docs, corpus):
    rows = mixed(docs).collect()
    sizes = defaultdict(int)
    for _, t, _, s in corpus:
        sizes[s] += len(brute.words(t))
    ranked = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = brute.targets(sizes, {s: WEIGHTS[i % 3] for i, s in enumerate(ranked)})
    assert len(rows) == len(corpus)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        assert int(r["size"]) == len(brute.words(r.text)) and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 and r.taken == len(r.positions) * int(r["size"]) <= 3 * int(r["size"])
        assert all(0 <= p <= 1 for p in r.positions) and list(r.positions) == sorted(r.positions)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], int(r["size"]))
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    again = mixed(docs).collect()
    order = lambda rs: sorted((str(r.doc_id), r.taken, tuple(r.positions)) for r in rs)
    assert order(rows) == order(again)


def test_training_order_follows_the_schedules(spark):
    rows = [(i, "w " * 10, "en", "abc"[i % 3]) for i in range(900)]
    order = mixing.training_order(mixed(make_docs(spark, rows)))
    seen = order.select("source", "position").collect()
    assert [r.position for r in seen] == sorted(r.position for r in seen)
    early = [r.source for r in seen if r.position < 0.25]
    late = [r.source for r in seen if r.position > 0.75]
    # a falls from 7.5 to 2.5, c rises from 0.5 to 1.5
    assert early.count("a") > 1.5 * late.count("a") and late.count("c") > 1.5 * early.count("c")
    assert abs(early.count("b") - late.count("b")) <= 4


def test_positions_invert_the_integral(spark):
    knots = F.array(*(F.struct(F.lit(t).alias("t"), F.lit(w).alias("w")) for t, w in ((0.0, 0.0), (0.25, 2.0), (0.75, 2.0), (1.0, 0.0))))
    for demand, time in ((0.0, 0.0), (0.25, 0.25), (0.75, 0.5), (1.25, 0.75), (1.5, 1.0)):
        got = spark.range(1).select(mixing.position_at(mixing._segments(knots), F.lit(demand))).first()[0]
        assert abs(got - time) < 1e-9


def test_mix_of_nothing(spark, no_docs):
    assert mixed(no_docs).count() == 0
    empty = mixed(make_docs(spark, [(1, None, "en", "a"), (2, "", "en", None)])).collect()
    assert [r.taken for r in empty] == [0, 0] and [r.target for r in empty] == [0.0, 0.0]


@pytest.mark.parametrize("shards", [1, 7])
def test_shards_are_near_equal(docs, corpus, shards):
    rows = sharding.shard_documents(docs, shards).collect()
    check_shards(rows, shards, corpus)


def check_shards(rows, shards, corpus):
    import zlib
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in corpus)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in rows) == want
    slots, loads = defaultdict(list), defaultdict(int)
    for r in rows:
        slots[r.shard].append(r.slot)
        loads[r.shard] += r["size"]
    assert set(slots) <= set(range(shards)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    biggest, mean = max(w[1] for w in want), sum(w[1] for w in want) / shards
    assert all(abs(loads[s] - mean) <= 2 * biggest for s in range(shards))


def test_a_hot_source_of_copies_is_split(spark):
    rows = [(i, "the same text", "en", "hot") for i in range(2000)] + [(5000 + i, f"text {i}", "de", f"s{i}") for i in range(1000)]
    got = sharding.shard_documents(make_docs(spark, rows), 8).collect()
    loads = defaultdict(int)
    for r in got:
        loads[r.shard] += r["size"]
    assert len(loads) == 8 and max(loads.values()) < 1.05 * min(loads.values())


def plain_tree(rows, shards, large):
    """(size, codes, tie) to shards by plain recursion: cut along the widest code at the weighted median."""
    out = {}

    def cut(own, lo, n):
        if n == 1 or not own:
            out.update((i, lo) for i, *_ in own)
            return
        widths = [max(c) - min(c) for c in zip(*(codes for _, _, codes, _ in own))]
        dim = widths.index(max(widths))
        by_key = defaultdict(int)
        for _, size, codes, tie in own:
            by_key[codes[dim] << 43 | tie] += size
        goal, upto, bound = sum(size for _, size, *_ in own) * (n // 2) / n, 0, None
        for k in sorted(by_key):
            upto += by_key[k]
            bound = k
            if upto >= goal:
                if goal - (upto - by_key[k]) < upto - goal:
                    bound = k - 1
                break
        left = [r for r in own if r[2][dim] << 43 | r[3] <= bound]
        cut(left, lo, n // 2)
        cut([r for r in own if r[2][dim] << 43 | r[3] > bound], lo + n // 2, n - n // 2)

    cut(rows, 0, shards)
    return out


def test_shards_equal_a_plain_tree_and_keep_copies_together(spark):
    rng = random.Random(5)
    texts = [f"text {i} " + "word " * rng.randrange(40) for i in range(300)]
    rows = [(i, texts[rng.randrange(300)] if i % 3 else texts[i % 40], rng.choice("abc"), rng.choice("xyz")) for i in range(1200)]
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    sized = sharding.with_size(docs)
    got = {r.doc_id: r for r in sharding.assign(sized, 7).collect()}
    # codes and hashes from Spark, the tree by plain recursion
    codes = sharding._codes(sized, list(sharding.DIMENSIONS))
    hashes = {r.doc_id: r for r in sized.select("doc_id", "size", "text", *(c.alias(f"c{i}") for i, c in enumerate(codes.values())),
              F.xxhash64("text_crc32", "size").alias("t"), F.xxhash64("doc_id", "text_crc32").alias("r")).collect()}
    groups = defaultdict(list)
    for r in hashes.values():
        groups[r.text].append(r)
    limit = sum(r["size"] for r in hashes.values()) / 7 * sharding.LARGE_SHARE
    low, rows = (lambda h, bits: h & ((1 << bits) - 1)), []
    for own in groups.values():
        least, big = min(own, key=lambda r: r.doc_id), sum(r["size"] for r in own) > limit
        rows += [(r.doc_id, r["size"], (least.c0, least.c1, least.c2), low(r.t, 21) << 22 | (low(r.r, 22) if big else 0)) for r in own]
        if not big:
            assert len({got[r.doc_id].shard for r in own}) == 1
    want = plain_tree(rows, 7, limit)
    assert {i: r.shard for i, r in got.items()} == want


@pytest.mark.parametrize("assign", [sharding.assign, mixing.assign])
def test_any_column_names(spark, docs, assign):
    names = "n dim bound lo goal total spread digit upto b weight knots source_size2 level run t_size".split()
    sized = (sharding if assign is sharding.assign else mixing).with_size(docs)
    named = sized.withColumns({c: F.lit("mark") for c in names})
    args = (4,) if assign is sharding.assign else ()
    found = assign(named, *args)
    assert {tuple(r) for r in found.select(*names).collect()} == {("mark",) * len(names)} and found.count() == docs.count()


def test_a_key_of_many_rows_is_spread(spark):
    # a third of the rows have no key, another third share one
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id")).alias("doc_id"),
        F.lit("s").alias("source"), (F.col("id") % 11 + 1).alias("size"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mixed = mixing.assign(rows).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(mixed) == 3000 and sum(r.taken for r in mixed) == sum(r["size"] for r in mixed)


def test_shards_of_nothing_and_of_a_target(spark, docs, no_docs):
    assert sharding.shard_documents(no_docs, 5).count() == 0
    sized = sharding.with_size(docs)
    total = sized.agg(F.sum("size")).first()[0]
    assert sharding.assign(sized, target_bytes=total // 4 + 1, dimensions=()).select("shard").distinct().count() == 4


def test_components_equal_brute_force(docs, no_docs, corpus):
    prints = [brute.fingerprint(t) for _, t, *_ in corpus]
    roots = brute.components(prints)
    least = {}
    for (i, *_), r in zip(corpus, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    found = simhash.with_components(docs)
    got = sorted((str(x.doc_id), x.fingerprint, str(x.component_id)) for x in found.collect())
    assert got == sorted((str(i), f"{p:016x}", str(least.get(r))) for (i, *_), p, r in zip(corpus, prints, roots))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(least.get(r)) for r in set(roots))
    assert simhash.with_components(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0


@pytest.mark.parametrize("crowded", [2, 4000])
def test_links_connect_like_all_pairs(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = random.Random(2)
    prints = {rng.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1, 1 << 63}
    for p in list(prints)[:60]:  # chains, and crowds that share a half
        for _ in range(8):
            prints.add(p ^ sum(1 << rng.randrange(32, 64) for _ in range(2)))
            p ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            prints.add(p)
    prints = sorted(prints)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    links = simhash.near_links(spark.createDataFrame([(signed(p),) for p in prints], "p long"))
    stars = {r.node: r.root for r in components.roots(links).collect()}
    groups, want = defaultdict(set), defaultdict(set)
    for p, r in zip(prints, brute.components(prints)):
        groups[stars.get(signed(p), signed(p))].add(p)
        want[r].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("half", [0, 32])
def test_a_crowd_is_spread(spark, monkeypatch, half):
    def sizes(max_bits):
        def meet(batches):
            import numpy as np
            import pyarrow as pa
            keys, n = np.unique(np.concatenate([np.empty(0, np.int64), *(b.column("key").to_numpy() for b in batches)]), return_counts=True)
            yield pa.RecordBatch.from_pydict({"u": pa.array(keys, pa.int64()), "v": pa.array(n, pa.int64())})
        return meet

    monkeypatch.setattr(simhash, "_meet", sizes)
    monkeypatch.setattr(simhash, "CROWDED", 100)
    rng = random.Random(4)
    shared = rng.getrandbits(32) << 32 - half
    prints = {shared | rng.getrandbits(32) << half for _ in range(600)}
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    met = simhash.near_links(spark.createDataFrame([(signed(p),) for p in prints], "p long"))
    assert met.agg(F.max("v")).first()[0] < 50


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(200)] + [(5, 5), (None, 3), (300, 301), (300, 301)]
    got = {r.node: r.root for r in components.roots(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 300: 300, 301: 300}
    assert components.roots(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.fixture(scope="module")
def pages(spark):
    long_ = "<p>" + "é" * 600 + "</p>"
    rows = [(1, "http://www.a.org/x?q=1", long_), (2, "http://a.org/", long_), (9, "http://b.net/y z", long_), (3, None, None),
            (4, "http://a.org/", ""), (5, "no scheme", "<b>"), (6, "http://a.org/é\nb", "short\r\n\r\nbody"), (7, "http://a.org/", "x" * 200_000),
            (8, "http://c.d/", "short\r\n\r\nbody"), (9, "http://b.net/y z", long_), (None, "http://n.u/ll", long_)]
    rows += [(100 + i, f"http://h{i % 5}.example.com/p/{i}", f"page {i} " * 200) for i in range(800)]
    return spark.createDataFrame([(*r, "x", "x") for r in rows], "page_id long, url string, html string, key string, record string")


def test_archives_round_trip(spark, pages):
    folder = warc.archive_folder(spark)
    directory = warc.write_archives(pages, folder)
    got = sorted((str(r.page_id), r.payload_bytes, r.record_type, str(r.refers_to), r.payload) for r in
                 warc.look_up(directory, folder, pages).collect())
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    largest = defaultdict(int)
    for i, body in rows:
        if len(body) >= warc.REVISIT_BYTES:
            largest[body] = max(largest[body], i or 0)
    want = []
    for i, body in rows:
        again = body in largest and i != largest[body]
        want.append((str(i), len(body), "revisit" if again else "response", str(largest[body] if again else None), None if again else body))
    assert got == sorted(want, key=lambda r: (*r[:4], r[4] or b"")) or sorted(got, key=str) == sorted(want, key=str)
    entries = directory.orderBy("archive", "offset").collect()
    assert sum(e.captures for e in entries) == len(rows) and all(e.captures <= warc.BLOCK_CAPTURES for e in entries)


def test_single_look_ups(spark, pages):
    folder = warc.archive_folder(spark)
    directory = warc.write_archives(pages, folder, archive_bytes=20_000)
    ask = lambda *urls: warc.look_up(directory, folder, spark.createDataFrame([(u,) for u in urls], "url string"), chunk_bytes=150)
    assert sorted(r.page_id for r in ask("http://a.org/", "http://a.org/", "http://none.org/").collect()) == [2, 4, 7]
    assert ask("http://h1.example.com/p/1").first().payload == ("page 1 " * 200).encode()
    assert ask("zzz://zz").count() == 0
    name = directory.first().archive
    with open(f"{folder.removeprefix('file://')}/{name}", "rb") as file:
        assert gzip.decompress(file.read()).startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_archive_of_nothing(spark, pages):
    folder = warc.archive_folder(spark)
    directory = warc.write_archives(pages.limit(0), folder)
    assert directory.count() == 0 and warc.look_up(directory, folder, pages).count() == 0
