import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import sharding as sh
from tests.llm.conftest import edge_rows, sorted_rows


def brute_flow_cost(supply, capacity):
    """Fewest bytes moved: all that cannot stay in its own shard."""
    stay = sum(min(s, capacity[i]) for i, s in enumerate(supply) if i < len(capacity))
    return sum(supply) - stay


@pytest.mark.parametrize("seed", range(20))
def test_flow_is_feasible_and_cheapest(seed):
    rng = random.Random(seed)
    supply = [rng.randrange(50) for _ in range(rng.randrange(1, 6))]
    n = rng.randrange(1, 8)
    capacity = sh.equal_capacities(sum(supply) + rng.randrange(3), n)
    rng.shuffle(capacity)
    flow = sh.min_cost_flow(supply, capacity)
    assert [sum(r) for r in flow] == supply
    assert all(sum(r[j] for r in flow) <= capacity[j] for j in range(n))
    moved = sum(x for i, r in enumerate(flow) for j, x in enumerate(r) if i != j)
    assert moved == brute_flow_cost(supply, capacity)


def test_flow_refuses_too_little_room():
    with pytest.raises(ValueError):
        sh.min_cost_flow([5], [2, 2])


def test_blocks_fill_shards_evenly_and_mostly_stay():
    rng = random.Random(1)
    blocks = [(i * 3 // 600, rng.randrange(1, 1000)) for i in range(600)]
    total = sum(s for _, s in blocks)
    capacity = sh.equal_capacities(total, 5)
    supply = [sum(s for o, s in blocks if o == k) for k in range(3)]
    flow = sh.min_cost_flow(supply, capacity)
    new = sh.assign_blocks(blocks, flow, capacity)
    held = [sum(s for (_, s), j in zip(blocks, new) if j == k) for k in range(5)]
    assert max(held) - min(held) <= 10
    moved = sum(s for (o, s), j in zip(blocks, new) if o != j)
    assert moved <= brute_flow_cost(supply, capacity) * 1.02


def check(docs, rows, shards=8):
    out, plan = sh.reshard(docs, shards)
    got = out.collect()
    assert len(got) == len(rows)
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=repr) == want
    slots, by_text = defaultdict(list), defaultdict(set)
    for r in got:
        assert 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
        by_text[r["text_crc32"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return got, by_text, plan


def test_edges(edge_docs, clash_docs, empty_docs):
    got, by_text, _ = check(edge_docs, edge_rows())
    assert len({r["shard"] for r in got if r["size"] == 1}) == 1  # null and empty texts are equal texts
    assert sorted_rows(sh.reshard(clash_docs, 8)[0]) == sorted((tuple(r) for r in got), key=repr)
    assert sh.reshard(empty_docs, 8)[0].count() == 0


def test_bytes_are_near_equal_and_copies_stay_together(spark):
    rng = random.Random(3)
    rows = [(i, "w" * rng.randrange(1, 400) + str(i % 700)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got, by_text, _ = check(docs, rows)
    assert all(len(s) == 1 for s in by_text.values())
    held = defaultdict(int)
    for r in got:
        held[r["shard"]] += r["size"]
    mean = sum(held.values()) / 8
    assert max(held.values()) - min(held.values()) < 0.02 * mean


def test_a_text_above_a_shard_is_divided(spark):
    rows = [(i, "hot text") for i in range(2000)] + [(10_000 + i, f"other {i}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got, by_text, _ = check(docs, rows)
    held = defaultdict(int)
    for r in got:
        held[r["shard"]] += r["size"]
    mean = sum(held.values()) / 8
    assert max(held.values()) - min(held.values()) < 0.1 * mean
    assert sum(len(s) > 1 for s in by_text.values()) == 1


def test_rewritten_files_hold_the_affected_rows(spark, clash_docs, tmp_path):
    placed, plan = sh.reshard(clash_docs, 8)
    touched = sh.rewrite_layout(clash_docs, plan, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert set(clash_docs.columns) < set(back.columns) and "shard_" in back.columns
    want = placed.filter(F.col("shard").isin(touched)).select("doc_id", "shard")
    assert sorted_rows(back.select("doc_id", F.col("shard_").alias("shard"))) == sorted_rows(want)


def test_nothing_moves_when_shards_and_capacities_stay(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(400)], "doc_id long, text string")
    sizes = {r["old_shard"]: r["b"] for r in sh.reshard(docs, 6)[0].groupBy("old_shard")
             .agg(F.sum("size").alias("b")).collect()}
    placed, plan = sh.reshard(docs, 6, capacities=[sizes.get(k, 0) for k in range(6)])
    assert placed.filter("shard <> old_shard").count() == 0 and plan.affected == []


def test_copies_beside_a_hot_text_stay_together(spark):
    rows = [(i, "hot text") for i in range(4000)] + [(10_000 + i, f"other {i % 2000}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    placed, plan = sh.reshard(docs, 8, blocks=256)
    split = placed.groupBy("text_crc32").agg(F.countDistinct("shard").alias("n")).filter("n > 1")
    assert len(plan.divided) == 1 and len(plan.hot) == 1 and split.count() == 1
    held = [r["b"] for r in placed.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert max(held) - min(held) < 0.1 * sum(held) / 8


def test_a_block_of_many_texts_is_divided_by_text(spark):
    rows = [(i, f"text {i % 300}") for i in range(1500)]
    placed, plan = sh.reshard(spark.createDataFrame(rows, "doc_id long, text string"), 8, blocks=2)
    assert plan.divided and not plan.hot
    assert placed.groupBy("text_crc32").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count() == 0
