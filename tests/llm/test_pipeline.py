"""The pipeline against a plain version of its stages, and the queries against their SQL."""

import os
from collections import defaultdict

import brute
import pytest
from llm_tables import make_docs
from test_table_operators import WEIGHTS, check_shards

import __spark_entry__ as entry
import corpus_pipeline
from check import compare, connect
from tidemart.llm import queries
from tidemart.llm.text import stored

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_stages_equal_brute_force(spark, corpus, tmp_path, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "SHARDS", 6)
    bench = [(1, " ".join(corpus[20][1].split()[:40])), (2, "nothing that occurs")]
    make_docs(spark, corpus).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    folder, docs = str(tmp_path), spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, rows = docs.columns, list(corpus)
    seen = lambda df: sorted((str(r.doc_id), str(r.text)) for r in df.collect())
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]

    def run(name):
        out = stored(stages[name](spark, docs, folder), name)
        assert name == "sharding" or out.columns == columns
        return out

    kept = brute.quality_kept([(t, lang, s) for _, t, lang, s in rows])
    rows = [r for r, k in zip(rows, kept) if k]
    docs = run("quality")
    assert seen(docs) == sorted((str(i), str(t)) for i, t, *_ in rows)

    roots = brute.components([brute.fingerprint(t) for _, t, *_ in rows])
    groups = defaultdict(list)
    for r, root in zip(rows, roots):
        groups[root].append(r)
    rows = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    docs = run("near_duplicates")
    assert seen(docs) == sorted((str(i), str(t)) for i, t, *_ in rows)

    rows = [r for r in rows if brute.passages(r[1], bench, 10)[1] == 0]
    docs = run("decontamination")
    assert seen(docs) == sorted((str(i), str(t)) for i, t, *_ in rows)

    sizes, largest = defaultdict(int), defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(brute.words(t))
        largest[s] = max(largest[s], len(brute.words(t)))
    want = brute.targets(sizes, {s: WEIGHTS[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))})
    docs = run("mixing")
    copies = docs.collect()
    by_id, taken, count = {r[0]: r for r in rows}, defaultdict(int), defaultdict(int)
    for r in copies:
        assert by_id[r.doc_id][1] == r.text
        taken[r.source] += len(brute.words(r.text))
        count[r.doc_id] += 1
    assert max(count.values()) <= 3 and all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)

    check_shards(run("sharding").collect(), corpus_pipeline.SHARDS, [(r.doc_id, r.text) for r in copies])
    assert corpus_pipeline.run(spark, folder).count() == len(copies)


def test_registered_names():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert {*names, "pipeline"} <= set(entry.queries()) and set(queries.oracle_sql()) <= set(names)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables are missing")
@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_sql(spark, name):
    verdict = compare(spark, connect(FOLDER), FOLDER, name, queries.queries()[name], queries.oracle_sql()[name])
    assert verdict.startswith("ok"), verdict
