"""The registered queries and the pipeline over the small tables."""

import zlib
from pathlib import Path

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from areastats.llm.queries import QUERIES, SQL
from brute import base_spans, components, line_dedup, plain_search, shingles
from check import difference, oracle

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def rows(spark, name):
    return QUERIES[name](spark, FOLDER).collect()


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER).toPandas(), oracle(FOLDER, SQL[name])) is None


def test_personal_data(spark, texts):
    out = rows(spark, "op2_disclosure")
    assert len(out) == len(texts)
    for r in out:
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(texts[r.doc_id] or ""))
        assert r.spans.startswith(base) and r.spans[len(base) :].count(":") == 2 * r.n_term


def test_shards(spark, texts):
    out = rows(spark, "op4_rendezvous_shards")
    assert all(r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) and r.grown_shard in (r.shard, 24) for r in out)
    assert len({(r.shard, r.slot) for r in out}) == len(texts)


def linked(sets):
    return lambda i, j: bool(sets[i]) and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])


def test_jaccard_groups(spark, texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    want = components(texts, linked(sets))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows(spark, "op7_jaccard_join")} == {
        i: (len(sets[i]), want[i]) for i in texts
    }


def test_leaks_are_those_of_a_plain_search(spark, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = plain_search([(i, t) for i, t in texts.items() if t], items)
    got = {(r.doc_id, r.item_id): (r.n_equal, r.n_tokens, r.doc_start, r.doc_end) for r in rows(spark, "op5_spaced_seeds")}
    assert got == want and want


def test_pieces_come_back(spark, texts):
    out = rows(spark, "op3_unigram_pieces")
    assert all(r.round_trip and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in out if texts[r.doc_id] is not None)


def test_pipeline_against_its_stages_in_plain_python(spark, texts):
    names = ["quality", "line dedup", "Jaccard", "decontamination", "SentencePiece"]
    assert [any(n in stage for stage, _ in corpus_pipeline.STAGES) for n in names] == [True] * 5
    out = corpus_pipeline.run(spark, FOLDER).collect()
    good = {r.doc_id for r in rows(spark, "op1_neighbour_quality") if r.predicted}
    kept = line_dedup([(i, t) for i, t in texts.items() if i in good])
    left = {i: new for (i, old), new in kept.items() if new or not old}
    sets = {i: shingles(t) for i, t in left.items()}
    first = components(left, linked(sets))
    left = {i: t for i, t in left.items() if first[i] == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    leaks = {i for i, _ in plain_search([(i, t) for i, t in left.items() if t], items)}
    result = {r.doc_id: r.text for r in out}
    assert set(result) == set(left) - leaks and leaks
    assert all(result[i] == left[i] and r.n_tokens == len(r.ids) for r in out for i in [r.doc_id])


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, documents.limit(0), FOLDER)
        assert out.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == documents.columns, name
    assert set(documents.columns) <= set(out.columns)


def test_the_library_stands_without_this_part():
    for path in Path("areastats").rglob("*.py"):
        if "llm" not in path.parts:
            assert "areastats.llm" not in path.read_text(), path
