"""The whole way from documents to batches, and queries against their SQL."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check_oracles import compare, connect
from corpusblocks.operators import batches as bat
from corpusblocks.operators import codec
from corpusblocks.plans import catalog, corpus
from corpusblocks.sources import documents, shards

COMPARED = [
    "short_block_pairs", "text_corpus_blocks", "split_scan", "block_fetch", "batch_sizes", "best_checkpoint",
    "corpus_lines", "split_assignment", "character_coverage", "bpe_merges", "encode_merges", "decode_lines",
    "split_token_yield", "packed_blocks", "block_lookup", "batch_contents", "loss_per_split", "sampling_distribution",
    "categorical_draw", "sampled_continuation", "perplexity_improvements", "runlog_sink",
]


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), sf_dir, name).startswith("ok")


def test_every_query_is_described():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) - set(entry.oracle_sql()) == {"unigram_vocabulary"}


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r["split"] for r in rows} <= {"train", "val", "test"} and sum(r["examples"] for r in rows) == 1829


def test_tokenizer_of_a_vocabulary_size(spark, sf_dir):
    lines = corpus.split_lines(documents.read_documents(spark, sf_dir))
    trained = corpus.train_tokenizer(corpus.training_lines(lines), vocab_size=420)
    assert trained.size == trained.vocab.count() == 420
    ids = {r["piece"]: r["token_id"] for r in trained.vocab.collect()}
    assert [ids[p] for p in ("[PAD]", "[UNK]", "[BOS]", "[EOS]")] == [0, 1, 2, 3]
    text = "Seven grey herons waited by the lock, and none of them was in a hurry."
    df = spark.createDataFrame([(text,)], "line string")
    encoded = df.withColumn("ids", codec.encoder(trained.tokenizer)(F.col("line")))
    assert codec.decode_ids(encoded, trained.vocab).first()["text"] == text


def test_first_batch_holds_the_token_budget(spark, sf_dir, tmp_path):
    blocks, _ = catalog._packed(spark, sf_dir)
    shards.write_shards(blocks, str(tmp_path / "packed"))
    train = shards.read_shards(spark, str(tmp_path / "packed"), "train")
    assert [r[0] for r in train.select(F.size("tokens")).distinct().collect()] == [256]
    plan = bat.batch_plan(train, bat.batch_size(256), splits=["train"], max_batches=1)
    (batch,) = bat.batches(plan, train).collect()
    assert len(batch["rows"]) == 8192 // 256 and {len(r) for r in batch["rows"]} == {256}
    # Every example begins with 2 and ends with 3.
    edges = blocks.groupBy("split").agg(
        F.sum(F.size(F.filter("tokens", lambda x: x == 2))).alias("begins"),
        F.sum(F.size(F.filter("tokens", lambda x: x == 3))).alias("ends"),
    )
    assert all(0 <= r["begins"] - r["ends"] <= 1 for r in edges.collect())
