"""The pipeline stage by stage, the registered queries against SQL, and plan rules."""

import hashlib
import re
from collections import Counter, defaultdict
from pathlib import Path

import pytest

import __spark_entry__
import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.oracle_check import duck, rows_of
from vintagecast.llm import mixing, oracle, queries

SPACE = re.compile("[\x20\x09-\x0d]")


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_sql(spark, name):
    frame = queries.QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in frame.collect()]
    done = duck(SF_SMALL).execute(oracle.SQL[name])
    columns = [c[0] for c in done.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, got) == rows_of(columns, done.fetchall())


def test_every_operator_is_registered_once():
    numbers = Counter(re.match(r"op(\d+)_", k)[1] for k in queries.QUERIES)
    assert numbers == {str(i): 1 for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(oracle.SQL) <= set(__spark_entry__.oracle_sql())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = spark.createDataFrame([(10**6, "", "en", "src0", 0), (10**6 + 1, None, None, None, None), (10**6 + 2, "12 !!", "en", "s", 5)], docs.schema)
    docs = docs.unionByName(extra)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "ngram_join", "mixing", "packing"]
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    def step(name, frame):
        out = stages[name](spark, frame, SF_SMALL)
        return corpus_pipeline.staged(out, name)

    known = step("language_id", docs)
    assert known.columns == columns
    rows = {r["doc_id"]: r for r in docs.collect()}
    left = {r["doc_id"]: r for r in known.collect()}
    assert set(rows) - set(left) == {10**6, 10**6 + 1, 10**6 + 2} and all(left[d] == rows[d] for d in left)

    single = step("exact_dedup", known)
    groups = defaultdict(list)
    for d, r in left.items():
        groups[hashlib.sha256(SPACE.sub("", r["text"]).encode()).digest()].append((-len(r["text"]), d))
    kept = {min(g)[1] for g in groups.values()}
    assert single.columns == columns and sorted(r["doc_id"] for r in single.collect()) == sorted(kept)

    from tests.llm.test_sets import brute_components

    apart = step("ngram_join", single)
    want = brute_components([(d, rows[d]["text"]) for d in kept])
    assert apart.columns == columns and sorted(r["doc_id"] for r in apart.collect()) == sorted(set(want.values()))

    mixed = step("mixing", apart)
    times = {r["doc_id"]: r["times"] for r in mixing.mix(apart).collect()}
    assert mixed.columns == columns and Counter(r["doc_id"] for r in mixed.collect()) == Counter({d: n for d, n in times.items() if n})

    packed = step("packing", mixed).collect()
    totals = Counter()
    for r in packed:
        totals[r["doc_id"]] += r["length"]
    tokens = {r["doc_id"]: r["doc_tokens"] for r in packed}
    assert totals == Counter({d: tokens[d] * times[d] for d in tokens}) and set(tokens) == {d for d, n in times.items() if n}


def test_run_is_the_stages_in_a_row(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} == set(out.columns) and out.count() > 0


def test_stages_of_no_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)


def test_sources_keep_the_rules():
    folder = Path(queries.__file__).parent
    for path in [*folder.glob("*.py"), Path(corpus_pipeline.__file__)]:
        source = path.read_text()
        assert "localCheckpoint" not in source and "crossJoin" not in source and ".rdd" not in source
        assert "ImportError" not in source

