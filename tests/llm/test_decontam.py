import random
import re

import pytest
from pyspark.sql import functions as F

from brute import docs, plain_search  # noqa: F401
from areastats.llm import decontam
from areastats.llm.decontam import MASKS, find_leaks, remove_leaking

ITEMS = "item_id long, text string"
random.seed(9)
WORDS = [f"w{i}" for i in range(3000)]
ITEM = [random.choice(WORDS) for _ in range(40)]


def leaks(spark, docs, benchmark, **options):
    items = spark.createDataFrame(benchmark, ITEMS)
    return {(r.doc_id, r.item_id): r for r in find_leaks(docs, items, **options).collect()}


def noise(n):
    return [random.choice(WORDS) for _ in range(n)]


def test_exact_changed_and_cut_passages(spark, docs):
    every_sixth = [("sub" if i % 6 == 5 else w) for i, w in enumerate(ITEM)]
    every_other = [("sub" if i % 2 else w) for i, w in enumerate(ITEM)]
    rows = [
        (1, " ".join(noise(50) + ITEM + noise(50))),
        (2, " ".join(ITEM).upper().replace(" ", ", \n")),
        (3, " ".join(noise(9) + every_sixth)),
        (4, " ".join(ITEM[10:30])),
        (5, " ".join(noise(300))),
        (6, " ".join(every_other)),
        (7, " ".join(ITEM[:8] + noise(5))),
        (8, None),
        (9, ""),
        (None, " ".join(ITEM)),
    ]
    out = leaks(spark, docs(rows, h=1, b="x", mask=2), [(70, " ".join(ITEM)), (71, " ".join(noise(30)))])
    assert set(out) == {(i, 70) for i in (1, 2, 3, 4, None)}
    assert (out[1, 70].n_equal, out[1, 70].doc_start, out[1, 70].doc_end) == (40, 50, 90)
    assert out[3, 70].n_equal >= 30 and out[4, 70].n_tokens == 20
    kept = remove_leaking(docs(rows, h=1), spark.createDataFrame([(70, " ".join(ITEM))], ITEMS))
    assert sorted(r.doc_id for r in kept.collect()) == [5, 6, 7, 8, 9] and kept.columns == ["doc_id", "text", "h"]


def test_changes_closer_than_any_run_of_equal_tokens(spark, docs):
    """Every fifth token replaced: no five tokens in a row are left, yet a mask fits."""
    changed = ["sub" if i % 5 == 4 else w for i, w in enumerate(ITEM)]
    assert any("1" not in {m[i] for i in range(k, len(m), 5)} for m in MASKS for k in range(5))
    assert (1, 1) in leaks(spark, docs([(1, " ".join(changed))]), [(1, " ".join(ITEM))])


def test_short_repeated_and_missing_items(spark, docs):
    items = [(9, "Alpha beta"), (3, "alpha, BETA!"), (4, ""), (5, None), (6, "the"), (8, " ".join(ITEM)), (2, " ".join(ITEM))]
    rows = [(1, "x alpha beta y"), (2, "alpha y beta"), (3, "The end"), (4, " ".join(ITEM * 3))]
    out = leaks(spark, docs(rows), items)
    assert set(out) == {(1, 3), (3, 6), (4, 2)} and out[4, 2].doc_start == 0


def test_blocks_do_not_change_the_result(spark, docs):
    items = [(i, " ".join(noise(20))) for i in range(30)]
    rows = [(i, " ".join(noise(30) + t.split())) for i, t in items]
    whole = leaks(spark, docs(rows), items)
    assert set(whole) == {(i, i) for i in range(30)}
    assert set(leaks(spark, docs(rows), items, block_tokens=100)) == set(whole)


@pytest.mark.parametrize("rows, items", [([], [(1, "a b")]), ([(1, "a b")], []), ([], [])])
def test_empty_tables(spark, docs, rows, items):
    assert leaks(spark, docs(rows), items) == {}


def test_repeated_words_and_long_texts(spark, docs):
    rows = [(1, "to " * 20_000), (1, "to " * 20_000), (2, " ".join(noise(20_000)))]
    out = leaks(spark, docs(rows), [(1, "to " * 30)])
    assert set(out) == {(1, 1)} and out[1, 1].n_equal == 30 and out[1, 1].doc_start == 0


@pytest.mark.parametrize("before", [16, 40])
def test_an_item_that_opens_with_a_run_of_one_token(spark, docs, before):
    item = ["0"] * 15 + ITEM[:30]
    out = leaks(spark, docs([(1, " ".join(["0"] * before + ITEM[:30]))]), [(1, " ".join(item))])
    leak = out[1, 1]
    assert (leak.n_equal, leak.n_tokens, leak.doc_start, leak.doc_end) == (45, 45, before - 15, before + 30)


@pytest.mark.parametrize("block_tokens", [500_000, 10])
def test_equals_a_plain_search(spark, docs, block_tokens):
    random.seed(4)
    few = [f"t{i}" for i in range(4)]

    def mixed(n):
        return [random.choice(few if random.random() < 0.5 else WORDS) for _ in range(n)]

    items = [(i, mixed(random.choice([1, 3, 11, 12, 30, 60]))) for i in range(25)]
    rows = []
    for i in range(60):
        text = mixed(random.choice([5, 40, 120]))
        for _ in range(3):
            part = list(random.choice(items)[1])
            part = [random.choice(few) if random.random() < 0.1 else w for w in part[random.randrange(3) :]]
            at = random.randrange(len(text) + 1)
            text[at:at] = part + [random.choice(part or few)] * random.choice([0, 0, 20])
        rows.append((i, " ".join(text)))
    items = [(i, " ".join(t)) for i, t in items]
    want = plain_search(rows, items)
    got = leaks(spark, docs(rows), items, block_tokens=block_tokens)
    assert {k: (r.n_equal, r.n_tokens, r.doc_start, r.doc_end) for k, r in got.items()} == want and len(want) > 80


def test_the_window_loop_is_compiled(spark, docs, capsys):
    """The JVM interprets methods above 8,000 bytes for ever."""
    found = find_leaks(docs([(1, " ".join(ITEM))]), spark.createDataFrame([(1, " ".join(ITEM))], ITEMS))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found.explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert len(sizes) > 3 and max(sizes) < 7500


@pytest.mark.parametrize("block_tokens", [500_000, 10])
def test_a_long_text_full_of_hits_fits_in_memory(spark, docs, block_tokens):
    """65,000 hits in a text of 30,000 tokens: with the text beside each hit they are 17 GB."""
    out = leaks(spark, docs([(1, " ".join(ITEM * 750)), (2, "x")]), [(7, " ".join(ITEM))], block_tokens=block_tokens)
    assert {k: (r.n_equal, r.n_tokens, r.doc_start, r.doc_end) for k, r in out.items()} == {(1, 7): (40, 40, 0, 40)}


def explained(spark, capsys, found):
    """The plan, and the size of the largest generated method; the JVM interprets those above 8,000 bytes."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found.explain()
        plan = capsys.readouterr().out
        found.explain("codegen")
        return plan, max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def rows_and_seeds(spark, docs):
    rows = decontam.narrow(docs([(1, " ".join(ITEM))]), "doc_id", "text").select("doc_id", decontam.token_hashes(F.col("text")).alias("h"))
    items = decontam.benchmark_items(spark.createDataFrame([(1, " ".join(ITEM))], ITEMS), "item_id", "text")
    return rows, decontam._seeds(items, MASKS)


def test_one_generated_loop_from_the_windows_to_the_grouping(spark, docs, capsys):
    """Between two loops all hits of a text would be kept in memory."""
    plan, size = explained(spark, capsys, decontam._offsets(*rows_and_seeds(spark, docs), MASKS))
    loops = {re.search(rf"\*\((\d+)\) {node}", plan)[1] for node in ("Generate explode", "BroadcastHashJoin")}
    assert loops == {re.findall(r"\*\((\d+)\) HashAggregate\(keys=\[doc_id", plan)[-1]} and size < 7500


def test_the_loop_that_asks_the_bitmap_is_compiled(spark, docs, capsys):
    rows, seeds = rows_and_seeds(spark, docs)
    looked = decontam.windows(rows.withColumn("runs", decontam._runs("h", MASKS)), "h", MASKS, "doc_id", "h", "runs")
    looked = looked.where(~decontam._shifted(F.col("pos"), MASKS)).select("doc_id", "pos", "key")
    plan, size = explained(spark, capsys, decontam.possible(looked, "key", seeds.select("key")))
    assert "Generate explode" in plan and size < 7500
