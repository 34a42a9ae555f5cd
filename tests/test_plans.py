"""Shapes of physical plans: pruned scans, no cross joins, no surplus shuffles."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from corpusblocks.operators import batches as bat
from corpusblocks.operators import blocks as blk
from corpusblocks.operators import bpe, likelihood, packing
from corpusblocks.plans import catalog, corpus
from corpusblocks.sources import documents, shards


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def shuffles(df):
    tree = plan_of(df).split("\n\n")[0]
    return sum("Exchange (" in line and "Broadcast" not in line for line in tree.split("\n"))


@pytest.fixture(scope="module")
def packed(spark):
    examples, trained = catalog._examples(spark, "/root/testdata/sf0.001")
    blocks = packing.pack_blocks(examples, documents.document_order(examples), 256, 64)
    return examples, blocks, trained


def test_document_scan_reads_two_columns(spark, sf_dir):
    plan = plan_of(corpus.split_lines(documents.read_documents(spark, sf_dir)))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    ids = plan_of(catalog.split_assignment(spark, sf_dir))
    assert "ReadSchema: struct<doc_id:bigint>" in ids


def test_word_counts_shuffle_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert shuffles(bpe.word_counts(corpus.split_lines(docs))) == 1


def test_packing_shuffles_ids_twice_and_the_write_adds_none(packed):
    _, blocks, _ = packed
    plan = plan_of(blocks)
    # One exchange of ids by bucket, one of pieces by run of shards; the others carry bucket totals.
    assert plan.count("REPARTITION_BY_COL") == 1
    assert shuffles(blocks) == 7
    layout = blocks.withColumn("shard_group", shards.shard_group(F.col("shard_id")))
    layout = layout.sortWithinPartitions("split", "shard_group", "shard_id", "block_id")
    assert shuffles(layout) == shuffles(blocks)


def test_fetch_scans_the_asked_shards_only(spark, packed, tmp_path):
    _, blocks, _ = packed
    shards.write_shards(blocks, str(tmp_path / "packed"))
    stored = shards.read_shards(spark, str(tmp_path / "packed"))
    asked = spark.createDataFrame([("train", 70), ("train", 130)], "split string, block_index long")
    located = blk.locate(asked, blk.shard_offsets(stored), cell=64)
    plan = plan_of(blk.fetch(located, stored))
    assert any("shard_group" in part.split("\n")[0] for part in plan.split("PartitionFilters")[1:])
    assert "GreaterThanOrEqual(shard_id,1), LessThanOrEqual(shard_id,2)" in plan


def test_run_logs_are_aggregated_by_hash(spark, sf_dir):
    for query in (catalog.best_checkpoint, catalog.last_checkpoint, catalog.checkpoint_records):
        plan = plan_of(query(spark, sf_dir))
        assert "SortAggregate" not in plan


def test_score_vectors_need_no_shuffle(spark, sf_dir):
    for query in (catalog.log_softmax, catalog.softmax, catalog.top_k_filter, catalog.top_p_filter, catalog.greedy_choice):
        assert shuffles(query(spark, sf_dir)) == 0


def test_batch_plan_reads_ids_only(spark, packed, tmp_path):
    _, blocks, _ = packed
    shards.write_shards(blocks, str(tmp_path / "p"))
    stored = shards.read_shards(spark, str(tmp_path / "p"))
    plan = plan_of(bat.batch_plan(stored, 32))
    assert "tokens" not in plan
    assert "tokens" not in plan_of(blk.split_manifest(stored, 256))
    assert "tokens" not in plan_of(blk.shard_offsets(stored))
    head = plan_of(bat.first_blocks(stored, 32, 2))
    assert "PushedFilters: [IsNotNull(block_id), LessThan(block_id,64)]" in head


def test_no_cross_joins(spark, packed, tmp_path):
    examples, blocks, trained = packed
    counts = likelihood.neighbour_counts(blocks)
    requests = spark.range(10).select(F.lit("train").alias("split"), F.col("id").alias("block_index"))
    plans = [
        blocks, bat.batch_plan(blocks, 32), blk.locate(requests, blk.shard_offsets(blocks)),
        likelihood.evaluate(blocks, counts, trained.size), likelihood.next_token_model(counts, trained.size),
        likelihood.context_model(counts, trained.size).table,
    ]
    # A split that is fixed turns the join on it into a constant one.
    shards.write_shards(blocks, str(tmp_path / "packed"))
    train = shards.read_shards(spark, str(tmp_path / "packed"), "train")
    plans += [bat.batch_plan(train, 32), bat.batches(bat.batch_plan(train, 32), train)]
    for df in plans:
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
