"""Sharding by rendezvous hashing: laws, slots, odd rows."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cloudcost.llm import queries, sharding
from tests.llm.test_llm import SMALL, no_docs, odd_docs


def places(df):
    return {r.doc_id: r.shard for r in df.collect()}


def test_weights_and_growth_move_only_what_they_must(spark):
    keys = spark.range(20000).withColumnRenamed("id", "doc_id")
    old = places(sharding.assign(keys, {0: 1, 1: 2, 2: 5}))
    counts = Counter(old.values())
    assert all(abs(counts[s] / 20000 - w / 8) < 0.02 for s, w in ((0, 1), (1, 2), (2, 5)))
    grown = places(sharding.assign(keys, {0: 1, 1: 2, 2: 5, 7: 2}))
    assert all(grown[k] in (old[k], 7) for k in old) and abs(Counter(grown.values())[7] / 20000 - 0.2) < 0.02
    shrunk = places(sharding.assign(keys, {1: 2, 2: 5}))
    assert all(shrunk[k] == old[k] for k in old if old[k] != 0)
    heavier = places(sharding.assign(keys, {0: 1, 1: 4, 2: 5}))
    assert all(heavier[k] == old[k] or heavier[k] == 1 for k in old) and heavier != old
    gone = sharding.moved(keys, sharding.even(8), sharding.even(9))
    assert {r.new_shard for r in gone.collect()} == {8} and abs(gone.count() / 20000 - 1 / 9) < 0.02
    assert set(places(sharding.assign(keys, {0: 1, 1: 0, 2: 5})).values()) == {0, 2}
    with pytest.raises(ValueError):
        sharding.assign(keys, {0: 0})


@pytest.mark.parametrize("chunk_rows", [sharding.CHUNK_ROWS, 7])
def test_slots_are_gapless_and_sizes_are_bytes(spark, chunk_rows):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").unionByName(
        odd_docs(spark).select("doc_id", "text", "lang", "source", F.col("n_chars")))
    got = sharding.manifest(docs, sharding.even(8), sharding.even(9), chunk_rows=chunk_rows).collect()
    want = sorted(((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect()), key=str)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=str) == want
    for s in range(8):
        own = sorted(r.slot for r in got if r.shard == s)
        assert own == list(range(len(own)))
    by_key = {}
    for r in got:
        assert by_key.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
        assert r.grown_shard in (r.shard, 8)


def test_slots_do_not_depend_on_chunks_or_partitions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    one = sorted(map(tuple, sharding.manifest(docs, sharding.even(3)).collect()))
    assert one == sorted(map(tuple, sharding.manifest(docs.repartition(7), sharding.even(3), chunk_rows=5).collect()))
    assert {r[-1] for r in one} == {None}


def test_a_hot_repeated_row_is_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE", 10)
    docs = spark.range(300).select(F.when(F.col("id") < 95, 5).otherwise(F.col("id")).alias("doc_id"),
                                   F.when(F.col("id") >= 95, F.col("id").cast("string")).alias("text"))
    got = sharding.manifest(docs, sharding.even(2), chunk_rows=20).collect()
    hot = sorted(r.slot for r in got if r.doc_id == 5)
    assert len(hot) == 95 and len({r.shard for r in got if r.doc_id == 5}) == 1 and hot[-1] - hot[0] > 95  # not one run
    for s in range(2):
        own = sorted(r.slot for r in got if r.shard == s)
        assert own == list(range(len(own)))


def test_odd_tables(spark):
    odd = odd_docs(spark).withColumn("shard", F.lit("x")).withColumn("size", F.lit(1)).withColumn("k2", F.lit(1))
    out = sharding.assign(odd, sharding.even(4))
    assert out.columns == odd.columns and out.count() == 13
    got = sharding.manifest(odd, sharding.even(4))
    assert got.columns == ["doc_id", "size", "text_crc32", "shard", "slot", "grown_shard"] and got.count() == 13
    assert {(r["size"], r.text_crc32) for r in got.collect() if r.doc_id in (3, 4)} == {(1, 0)}
    assert sharding.manifest(no_docs(spark), sharding.even(4)).count() == 0
    assert sharding.manifest(odd, {0: 1}).filter("shard <> 0").count() == 0


def test_written_shards_hold_all_records(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    sharding.write_shards(docs, sharding.even(4), f"{tmp_path}/s")
    back = spark.read.parquet(f"{tmp_path}/s")
    assert sorted(map(str, back.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))
    assert places(back) == places(sharding.assign(docs, sharding.even(4)))


def test_native_plan_and_no_text_in_the_shuffle(spark):
    plan = queries.op11_rendezvous_shards(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    assert not any("text#" in x for x in plan.splitlines() if "Exchange" in x)
