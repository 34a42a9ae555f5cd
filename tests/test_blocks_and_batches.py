"""Shards, manifests, lookups and batch plans."""

import pytest
from pyspark.sql import functions as F

from corpusblocks.operators import batches as bat
from corpusblocks.operators import blocks as blk
from corpusblocks.sources import artifacts, shards
from corpusblocks.operators import bpe

SPLITS = {"train": 23, "val": 5}
PER_SHARD = 4


@pytest.fixture(scope="module")
def blocks(spark):
    rows = [
        (split, b, b // PER_SHARD, b % PER_SHARD, [b, b + 1, b + 2, n])
        for split, n in SPLITS.items() for b in range(n)
    ]
    return spark.createDataFrame(
        rows, "split string, block_id long, shard_id long, local_index long, tokens array<int>")


def test_write_and_read_shards(spark, blocks, tmp_path):
    path = str(tmp_path / "packed")
    shards.write_shards(blocks, path)
    back = shards.read_shards(spark, path)
    assert back.select(*blocks.columns).exceptAll(blocks).isEmpty() and back.count() == blocks.count()
    # Many shards share a folder and a file, in order.
    assert len(list((tmp_path / "packed").glob("split=*/shard_group=0/*.parquet"))) == 2
    assert shards.read_shards(spark, path, "val").count() == 5
    plan = shards.read_shards(spark, path, "val")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    with pytest.raises(FileNotFoundError):
        shards.read_shards(spark, path, "test")
    # A shorter run leaves nothing of the longer one behind.
    shards.write_shards(blocks.where("block_id < 4 and split = 'train'"), path)
    assert shards.read_shards(spark, path).count() == 4
    shards.write_shards(blocks.where("split = 'val'"), path, keep_others=True)
    assert shards.read_shards(spark, path).count() == 9


def test_manifests(blocks):
    per_shard = {(r["split"], r["shard"]): r["blocks"] for r in blk.shard_manifest(blocks).collect()}
    assert per_shard["train", "train_00005"] == 3 and per_shard["val", "val_00001"] == 1 and len(per_shard) == 8
    per_split = {r["split"]: (r["blocks"], r["seq_len"], r["shards"]) for r in blk.split_manifest(blocks).collect()}
    assert per_split == {"train": (23, 4, 6), "val": (5, 4, 2)}


def test_consistency_checks(spark, blocks):
    blk.require_consistent(blocks)
    odd = spark.createDataFrame([("val", 9, 2, 1, [1, 2])], blocks.schema)
    with pytest.raises(ValueError):
        blk.require_consistent(blocks.unionByName(odd))


def test_locate_on_uneven_shards(spark, blocks):
    uneven = blocks.withColumn("shard_id", F.expr("cast(sqrt(block_id) as bigint)"))
    offsets = blk.shard_offsets(uneven)
    starts = {(r["split"], r["shard_id"]): (r["start"], r["end"]) for r in offsets.collect()}
    assert starts["train", 0] == (0, 1) and starts["train", 4] == (16, 23)
    asked = [("train", i) for i in (-1, 0, 3, 16, 22, 23, 10**9)] + [("val", 4), ("val", 5)]
    requests = spark.createDataFrame(asked, "split string, block_index long")
    for cell in (1, 3, 1000):
        found = {(r["split"], r["block_index"]): (r["shard_id"], r["local_index"]) for r in blk.locate(requests, offsets, cell=cell).collect()}
        for split, i in asked:
            inside = 0 <= i < SPLITS[split]
            want = next(((s, i - a) for (sp, s), (a, b) in starts.items() if sp == split and a <= i < b), (None, None))
            assert found[split, i] == want and (want[0] is not None) == inside
    with pytest.raises(IndexError):
        blk.require_located(blk.locate(requests, offsets))


def test_fetch_returns_a_row_per_request(spark, blocks):
    requests = spark.createDataFrame([("train", 3), ("train", 3), ("val", 3), ("val", 99)], "split string, block_index long")
    got = sorted((r["split"], r["tokens"][0], r["tokens"][3]) for r in blk.fetch(requests, blocks).collect())
    assert got == [("train", 3, 23), ("train", 3, 23), ("val", 3, 5)]
    located = blk.locate(requests, blk.shard_offsets(blocks))
    again = sorted((r["split"], r["tokens"][0], r["tokens"][3]) for r in blk.fetch(located, blocks).collect())
    assert again == got


def test_fetch_names_the_folders_it_reads(spark, tmp_path):
    rows = [(s, s, 0, [s, s + 1], "train") for s in (0, 1, 5_000, 10_000)]
    stored = spark.createDataFrame(rows, "shard_id long, block_id long, local_index long, tokens array<int>, split string")
    shards.write_shards(stored, str(tmp_path / "packed"))
    packed = shards.read_shards(spark, str(tmp_path / "packed"))
    asked = [("train", 0, 0), ("train", 10_000, 0), ("train", 10_000, 7), ("train", None, None)]
    requests = spark.createDataFrame(asked, "split string, shard_id long, local_index long")
    got = blk.fetch(requests, packed)
    assert sorted(r["tokens"] for r in got.collect()) == [[0, 1], [10_000, 10_001]]
    folders, near = blk.asked_shards(requests)
    read = {r[0] for r in packed.where(folders).select("shard_id").collect()}
    assert read == {0, 1, 10_000}
    assert {r[0] for r in packed.where(folders & near).select("shard_id").collect()} == {0, 10_000}
    plan = got._jdf.queryExecution().explainString(got.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    filters = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "shard_group" in filters and "IN (0,9)" in filters
    wide = blk.asked_shards(requests, folders=1)
    assert {r[0] for r in packed.where(wide[0] & wide[1]).select("shard_id").collect()} == {0, 1, 5_000, 10_000}
    assert blk.fetch(requests.where("shard_id is null"), packed).count() == 0


def test_batch_size():
    assert bat.batch_size(256) == 32 and bat.batch_size(10_000) == 1
    assert bat.batch_size(256, size=7) == 7 and bat.batch_size(256, size=0) == 32
    assert bat.batch_size(256, target_tokens=1000) == 3


def plan_rows(plan):
    return [tuple(r) for r in plan.orderBy("split", "batch_no", "slot").collect()]


def test_batches_cover_an_epoch_once(blocks):
    keep = bat.batch_plan(blocks, 4, drop_last=False)
    rows = plan_rows(keep)
    assert sorted((r[0], r[4]) for r in rows) == sorted((s, b) for s, n in SPLITS.items() for b in range(n))
    dropped = plan_rows(bat.batch_plan(blocks, 4))
    assert dropped == [r for r in rows if r[2] < SPLITS[r[0]] // 4]
    again = plan_rows(bat.batch_plan(blocks.repartition(7), 4, drop_last=False))
    assert rows == again
    order = lambda rs: [r[4] for r in rs if r[0] == "train"]
    assert order(rows) != list(range(23))
    assert order(rows) != order(plan_rows(bat.batch_plan(blocks, 4, epoch=1, drop_last=False)))
    assert order(rows) != order(plan_rows(bat.batch_plan(blocks, 4, seed=1, drop_last=False)))


def test_batches_in_order_with_a_limit(blocks):
    rows = plan_rows(bat.batch_plan(blocks, 4, shuffle=False, drop_last=False, splits=["val"], max_batches=1))
    assert [r[4] for r in rows] == [0, 1, 2, 3] and {r[0] for r in rows} == {"val"}


def test_batch_contents(blocks):
    plan = bat.batch_plan(blocks, 4, drop_last=False)
    got = {(r["split"], r["batch_no"]): r["rows"] for r in bat.batches(plan, blocks).collect()}
    for split, _, batch_no, slot, block_id in plan_rows(plan):
        assert got[split, batch_no][slot][0] == block_id
    assert len(got["train", 5]) == 3


def test_training_pairs(spark, blocks):
    short = spark.createDataFrame([("val", 9, 2, 1, [1])], blocks.schema)
    rows = blk.training_pairs(blocks.unionByName(short)).collect()
    assert len(rows) == 28 and all(r["inputs"][1:] == r["targets"][:-1] for r in rows)
    assert blk.next_token_rows(blocks).count() == 28 * 3


def test_tokenizer_artifacts(spark, tmp_path):
    merges = [("a", "b", 3), ("ab", "c", 1)]
    vocab = bpe.vocabulary(spark, [("▁", 3), ("a", 2), ('"', 1)], merges)
    prefix = str(tmp_path / "tok")
    artifacts.write_tokenizer(vocab, merges, prefix)
    assert artifacts.read_merges(spark, prefix) == merges
    assert artifacts.read_vocabulary(spark, prefix).exceptAll(vocab).isEmpty()
    assert artifacts.special_ids(spark, f"{prefix}.meta.json") == {"pad": 0, "unk": 1, "bos": 2, "eos": 3, "vocab_size": 265}
    broken = tmp_path / "broken.json"
    broken.write_text('{"special_tokens": {\n"PAD": {"token": "[PAD]", "id": 0}}}')
    with pytest.raises(KeyError):
        artifacts.special_ids(spark, str(broken))
