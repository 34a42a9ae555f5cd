"""Queries over the standard tables, one per capability."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusblocks.functions import ids as idf
from corpusblocks.functions import vectors as vec
from corpusblocks.functions.seeded import bucket, uniform
from corpusblocks.operators import batches as bat
from corpusblocks.operators import blocks as blk
from corpusblocks.operators import bpe, codec, generation, likelihood, packing, unigram
from corpusblocks.operators import runlog as log_ops
from corpusblocks.plans import corpus
from corpusblocks.session import kept_path, materialize, scratch_path, spread
from corpusblocks.sources import artifacts, shards, text_files
from corpusblocks.sources import documents as docs_src
from corpusblocks.sources import runlog as log_src

# Parameters shared by the queries and their SQL counterparts.
SEED = 42
SEQ_LEN = 256
BLOCKS_PER_SHARD = 1024
VOCAB_SIZE = 1024
COVERAGE = 0.98
EPOCH = 1
MAX_BATCHES, EVAL_BATCHES = 50, 2
CONTEXT = 64
SMOOTHING = 1.0
TEMPERATURE, TOP_K, TOP_P, PENALTY = 0.9, 40, 0.95, 1.05
EVAL_EVERY, SAVE_EVERY = 200, 500
NEW_TOKENS, SAMPLED_TOKENS = 120, 5
CONFIG = {"k": 0, "n_layers": 7, "dropout": 0.5}
LEARNING_RATE = 3e-4


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return docs_src.read_documents(spark, sf)


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.split_lines(_docs(spark, sf), SEED)


def _characters(lines: DataFrame, coverage: float = 1.0) -> corpus.TrainedTokenizer:
    """A tokenizer without merges."""
    return corpus.train_tokenizer(corpus.training_lines(lines), merges=0, coverage=coverage)


def _tokenizer(spark: SparkSession, sf: str, **options) -> corpus.TrainedTokenizer:
    """The tokenizer of the corpus, trained to the full vocabulary once and loaded from where it is stored."""
    name = "-".join(["tokenizer", *[f"{k}={v}" for k, v in sorted(options.items())]]).replace("[", "").replace("]", "")
    prefix = kept_path(spark, spark.read.parquet(f"{sf}/documents.parquet"), name)
    lines = corpus.training_lines(_lines(spark, sf))
    return corpus.stored_tokenizer(lines, prefix, vocab_size=VOCAB_SIZE, **options)


def _examples(spark: SparkSession, sf: str) -> tuple[DataFrame, corpus.TrainedTokenizer]:
    trained = _tokenizer(spark, sf)
    return corpus.encode_corpus(_lines(spark, sf), trained.tokenizer), trained


def _packed(spark: SparkSession, sf: str) -> tuple[DataFrame, corpus.TrainedTokenizer]:
    examples, trained = _examples(spark, sf)
    order = docs_src.document_order(examples)
    return corpus.corpus_blocks(examples, order, SEQ_LEN, BLOCKS_PER_SHARD), trained


def _stored(spark: SparkSession, sf: str) -> tuple[DataFrame, corpus.TrainedTokenizer]:
    """Packed blocks as a reader finds them: written by shard."""
    blocks, trained = _packed(spark, sf)
    path = scratch_path(spark, "packed")
    shards.write_shards(blocks, path)
    return shards.read_shards(spark, path), trained


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    """``(ctx_id, logits, target_id)`` from the embeddings table."""
    return spark.read.parquet(f"{sf}/embeddings.parquet").select(
        F.col("vec_id").alias("ctx_id"),
        F.col("embedding").cast("array<double>").alias("logits"),
        F.col("label").alias("target_id"),
    )


def _log(spark: SparkSession, sf: str) -> DataFrame:
    """A run log from the events table: user = run, event = step, value = perplexity."""
    return spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("user_id").alias("run_id"), (F.col("event_id") + 1).alias("step"),
        F.log("value").alias("loss"), F.col("value").alias("perplexity"),
        ((F.col("event_id") + 1) * bat.TARGET_BATCH_TOKENS).alias("tokens"),
    )


def _run_config():
    """The configuration of a run as JSON; fields left out take their defaults."""
    return F.to_json(F.struct(
        (64 * (1 + F.col("run_id") % 4)).alias("seq_len"), (32 * (1 + F.col("run_id") % 3)).alias("d_model"),
        F.when(F.col("run_id") % 2 == 0, 0.1).alias("dropout"),
    ))


def _long(scores: DataFrame, vector: str, name: str, digits: int = 6) -> DataFrame:
    rows = scores.select("ctx_id", F.posexplode(vector).alias("token_id", "v"))
    return rows.select("ctx_id", "token_id", F.round("v", digits).alias(name))


# Sources, splits, projections

def corpus_lines(spark, sf):
    return _lines(spark, sf).select("doc_id", "line_no", "line")


def split_assignment(spark, sf):
    docs = docs_src.assign_splits(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id"), seed=SEED)
    return docs.select(
        "doc_id", bucket(SEED, F.col("doc_id"), buckets=docs_src.SPLIT_BUCKETS).alias("bucket"), "split"
    )


def example_markers(spark, sf):
    examples, _ = _examples(spark, sf)
    ids = F.col("ids")
    return examples.select(
        "doc_id", "line_no", F.size(ids).alias("n_ids"),
        F.element_at(ids, 1).alias("first_id"), F.element_at(ids, -1).alias("last_id"),
        F.size(idf.without_markers(ids)).alias("n_text_ids"),
    )


def prompt_contexts(spark, sf):
    trained = _tokenizer(spark, sf)
    prompts = _prompts(spark, sf)
    encoded = codec.encode_lines(prompts, trained.tokenizer, "text")
    prefixed = encoded.withColumn("ids", idf.prompt_prefix(F.col("ids")))
    context = idf.last_ids(F.col("ids"), CONTEXT)
    return prefixed.select(
        "conv_id", "turn", F.size("ids").alias("n_ids"), F.size(context).alias("n_context"),
        idf.fingerprint(context).alias("context"),
    )


def _prompts(spark, sf):
    prompts = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "text")
    return spread(prompts, "conv_id", "turn")


def training_pairs(spark, sf):
    blocks, _ = _packed(spark, sf)
    return blk.training_pairs(blocks).select(
        "split", "block_id", F.size("inputs").alias("n"),
        idf.fingerprint(F.col("inputs")).alias("inputs"), idf.fingerprint(F.col("targets")).alias("targets"),
    )


def short_block_pairs(spark, sf):
    """Blocks and the pairs made of them, for blocks of one id beside full ones."""
    examples, _ = _examples(spark, sf)
    order = docs_src.document_order(examples)
    found = None
    for seq_len in (1, SEQ_LEN):
        blocks = corpus.corpus_blocks(examples, order, seq_len, BLOCKS_PER_SHARD)
        made = blocks.groupBy("split").agg(F.count("*").alias("blocks"))
        pairs = blk.training_pairs(blocks).groupBy("split").agg(F.count("*").alias("pairs"))
        rows = made.join(pairs, "split", "left").select(
            F.lit(seq_len).alias("seq_len"), "split", "blocks", F.coalesce("pairs", F.lit(0)).alias("pairs")
        )
        rows = materialize(rows, "pairs")  # what one length has shuffled is gone before the next
        found = rows if found is None else found.unionByName(rows)
    return found


def text_corpus_blocks(spark, sf):
    """Blocks of the corpus after a detour through text files, with a stray file beside them."""
    lines = _lines(spark, sf)
    path = scratch_path(spark, "corpus.v1")
    text_files.write_text_corpus(lines, path, ["doc_id", "line_no"])
    spark.range(3).select(F.lit("not of the corpus").alias("line")).write.text(f"{path}/notes.txt")
    stored = text_files.read_text_corpus(spark, path)
    examples = corpus.encode_corpus(stored, _tokenizer(spark, sf).tokenizer)
    blocks = corpus.corpus_blocks(examples, text_files.text_order(examples), SEQ_LEN, BLOCKS_PER_SHARD)
    return blocks.select(
        "split", "block_id", "shard_id", "local_index", idf.fingerprint(F.col("tokens")).alias("tokens")
    )


def split_scan(spark, sf):
    """Blocks of the one split that a reader asks for."""
    blocks, _ = _packed(spark, sf)
    path = scratch_path(spark, "packed")
    shards.write_shards(blocks, path)
    return shards.read_shards(spark, path, "val").select(
        "split", "block_id", "shard_id", idf.fingerprint(F.col("tokens")).alias("tokens")
    )


def marker_free_blocks(spark, sf):
    blocks, _ = _packed(spark, sf)
    kept = idf.without_markers(F.col("tokens"))
    return blocks.select(
        "split", "block_id", F.size(kept).alias("n"), idf.fingerprint(kept).alias("ids")
    )


# Tokenizer

def word_frequencies(spark, sf):
    return bpe.word_counts(corpus.training_lines(_lines(spark, sf)))


def symbol_pairs(spark, sf):
    words = bpe.word_counts(corpus.training_lines(_lines(spark, sf)))
    return bpe.pair_counts(bpe.symbol_table(words))


def bpe_merges(spark, sf):
    """Learned anew, whatever is stored."""
    lines = corpus.training_lines(_lines(spark, sf))
    return bpe.merges_table(spark, corpus.train_tokenizer(lines, vocab_size=VOCAB_SIZE).merges)


def character_coverage(spark, sf):
    words = bpe.word_counts(corpus.training_lines(_lines(spark, sf)))
    return bpe.covered_alphabet(words, COVERAGE)


def vocabulary_characters(spark, sf):
    return _characters(_lines(spark, sf)).vocab


def vocabulary_merges(spark, sf):
    return _tokenizer(spark, sf).vocab


def _encoded_report(encoded):
    return encoded.select(
        "doc_id", "line_no", F.size("ids").alias("n_ids"), idf.fingerprint(F.col("ids")).alias("ids")
    )


def encode_characters(spark, sf):
    lines = _lines(spark, sf)
    return _encoded_report(codec.encode_lines(lines, _characters(lines).tokenizer))


def encode_merges(spark, sf):
    lines = _lines(spark, sf)
    return _encoded_report(codec.encode_lines(lines, _tokenizer(spark, sf).tokenizer))


def encode_byte_fallback(spark, sf):
    lines = _lines(spark, sf)
    trained = _characters(lines, COVERAGE)
    return _encoded_report(codec.encode_lines(lines, trained.tokenizer))


def decode_lines(spark, sf):
    lines = _lines(spark, sf)
    trained = _tokenizer(spark, sf)
    encoded = packing.wrap_examples(codec.encode_lines(lines, trained.tokenizer))
    return codec.decode_ids(encoded, trained.vocab).select("doc_id", "line_no", "text")


def decode_blocks(spark, sf):
    blocks, trained = _packed(spark, sf)
    text = codec.decode_ids(blocks, trained.vocab, "tokens")
    return text.select("split", "block_id", F.md5("text").alias("text"))


def piece_lookup(spark, sf):
    lines = _lines(spark, sf)
    words = bpe.word_counts(lines).select(F.col("word").alias("piece"))
    vocab = _tokenizer(spark, sf).vocab
    return codec.piece_ids(words, vocab)


def id_lookup(spark, sf):
    vocab = _tokenizer(spark, sf).vocab
    rows = spark.read.parquet(f"{sf}/events.parquet").select(
        "event_id", F.col("event_id").cast("int").alias("token_id")
    )
    return codec.id_pieces(rows, vocab)


def roundtrip_audit(spark, sf):
    lines = _lines(spark, sf)
    trained = _tokenizer(spark, sf)
    encoded = lines.withColumn("ids", codec.line_ids(F.col("line"), trained.tokenizer))
    decoded = codec.decode_ids(encoded, trained.vocab)
    same = F.trim("line") == F.trim("text")
    return decoded.groupBy("split").agg(
        F.count("*").alias("lines"), F.count_if(~same).alias("differing")
    )


def unigram_expected_counts(spark, sf):
    """One expectation step over all words, from all repeated substrings."""
    words = bpe.word_counts(corpus.training_lines(_lines(spark, sf)))
    words = materialize(spread(words, "word"), "words")
    pieces = unigram.initial_pieces(words)
    expected = unigram.expected_counts(words, pieces.scores, unknown=pieces.unknown, few=pieces.few)
    return expected.select("piece", F.round("expected", 3).alias("expected"))


def unigram_vocabulary(spark, sf):
    return _tokenizer(spark, sf, model_type="unigram").vocab


def unigram_roundtrip(spark, sf):
    lines = _lines(spark, sf)
    trained = _tokenizer(spark, sf, model_type="unigram")
    encoded = codec.encode_lines(lines, trained.tokenizer)
    return codec.decode_ids(encoded, trained.vocab).select("doc_id", "line_no", "text")


def tokenizer_metadata(spark, sf):
    # The order in which reserved tokens are listed does not change their ids.
    trained = _tokenizer(spark, sf)
    specials = bpe.special_tokens("[EOS],UNK,[BOS],[PAD],[EOS]")
    learned = trained.vocab.where("kind IN ('merge', 'char')").orderBy("token_id").select("piece", "kind", "freq").collect()
    prefix = scratch_path(spark, "tokenizer")
    artifacts.write_tokenizer(
        bpe.vocabulary_table(spark, [tuple(r) for r in learned], specials), trained.merges, prefix
    )
    found = artifacts.special_ids(spark, f"{prefix}.meta.json")
    stored = artifacts.read_vocabulary(spark, prefix)
    return stored.agg(
        *[F.lit(found[name]).alias(f"{name}_id") for name in ("pad", "unk", "bos", "eos")],
        F.lit(found["vocab_size"]).alias("vocab_size"),
        F.count("*").alias("stored_pieces"),
        F.lit(len(artifacts.read_merges(spark, prefix))).alias("stored_merges"),
    )


# Packing and shards

def _token_yield(lines, trained):
    # Lengths are read once, so the encoded examples need not be stored.
    encoded = codec.encode_lines(lines, trained.tokenizer)
    return packing.packing_totals(packing.wrap_examples(encoded), SEQ_LEN)


def split_token_yield(spark, sf):
    lines = _lines(spark, sf)
    return _token_yield(lines, _characters(lines))


def merged_token_yield(spark, sf):
    return _token_yield(_lines(spark, sf), _tokenizer(spark, sf))


def packed_blocks(spark, sf):
    blocks, _ = _packed(spark, sf)
    return blocks.select(
        "split", "block_id", "shard_id", "local_index", idf.fingerprint(F.col("tokens")).alias("tokens")
    )


def shard_sink(spark, sf):
    blocks, _ = _stored(spark, sf)
    return blocks.groupBy("split", "shard_id").agg(
        F.count("*").alias("blocks"),
        F.min("block_id").alias("first_block"),
        F.max("local_index").alias("last_local_index"),
        F.sum(F.aggregate("tokens", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("id_sum"),
    )


def shard_manifest(spark, sf):
    blocks, _ = _stored(spark, sf)
    path = scratch_path(spark, "index")
    shards.write_manifest(blk.shard_manifest(blocks, SEQ_LEN), path)
    return shards.read_manifest(spark, path)


def split_manifest(spark, sf):
    blocks, _ = _stored(spark, sf)
    return blk.token_manifest(blocks)


def shard_checks(spark, sf):
    return blk.shard_checks(_packed(spark, sf)[0])


# Block access and batches

def shard_offsets(spark, sf):
    blocks, _ = _stored(spark, sf)
    return blk.shard_offsets(blocks)


def _requests(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet").select(
        F.lit("train").alias("split"), F.col("event_id").alias("block_index")
    )


def block_lookup(spark, sf):
    blocks, _ = _stored(spark, sf)
    return blk.locate(_requests(spark, sf), blk.shard_offsets(blocks), cell=BLOCKS_PER_SHARD)


def block_fetch(spark, sf):
    blocks, _ = _stored(spark, sf)
    located = blk.locate(_requests(spark, sf), blk.shard_offsets(blocks), cell=BLOCKS_PER_SHARD)
    found = blk.fetch(materialize(located, "located"), blocks)
    return found.select("split", "block_index", idf.fingerprint(F.col("tokens")).alias("tokens"))


def shuffled_order(spark, sf):
    blocks, _ = _stored(spark, sf)
    return bat.shuffled_positions(blocks, SEED, EPOCH)


def batch_sizes(spark, sf):
    blocks, _ = _packed(spark, sf)
    return blk.split_manifest(blocks).select(
        "split", "seq_len", bat.batch_size_of(F.col("seq_len")).alias("batch_size")
    )


def batch_plan(spark, sf):
    blocks, _ = _stored(spark, sf)
    return bat.batch_plan(blocks, bat.batch_size(SEQ_LEN), epoch=EPOCH, seed=SEED)


def evaluation_batches(spark, sf):
    blocks, _ = _stored(spark, sf)
    return bat.batch_plan(
        blocks, bat.batch_size(SEQ_LEN), shuffle=False, drop_last=False, max_batches=MAX_BATCHES
    )


def batch_contents(spark, sf):
    blocks, _ = _stored(spark, sf)
    plan = bat.batch_plan(blocks, bat.batch_size(SEQ_LEN), epoch=EPOCH, seed=SEED)
    rows = bat.batches(plan, blocks)
    return rows.select(
        "split", "epoch", "batch_no", F.size("rows").alias("blocks"),
        idf.fingerprint(F.flatten("rows")).alias("tokens"),
    )


# Likelihood

def next_token_counts(spark, sf):
    return likelihood.neighbour_counts(_packed(spark, sf)[0], ["split"])


def _trained_counts(blocks):
    train = blocks.where(F.col("split") == "train")
    return materialize(likelihood.neighbour_counts(train), "neighbours")


def next_token_model(spark, sf):
    blocks, trained = _packed(spark, sf)
    counts = _trained_counts(blocks)
    model = likelihood.next_token_model(counts, trained.size, SMOOTHING)
    return model.withColumn("p", F.round("p", 9))


def _rounded_loss(metrics):
    return metrics.withColumn("loss", F.round("loss", 6)).withColumn("perplexity", F.round("perplexity", 4))


def loss_per_split(spark, sf):
    blocks, trained = _stored(spark, sf)
    counts = _trained_counts(blocks)
    return _rounded_loss(likelihood.evaluate(blocks, counts, trained.size, SMOOTHING))


def evaluation_loss(spark, sf):
    blocks, trained = _stored(spark, sf)
    counts = _trained_counts(blocks)
    head = bat.first_blocks(blocks, bat.batch_size(SEQ_LEN), EVAL_BATCHES)
    return _rounded_loss(likelihood.evaluate(head, counts, trained.size, SMOOTHING))


def loss_per_document(spark, sf):
    examples, trained = _examples(spark, sf)
    examples = examples.withColumnRenamed("ids", "tokens")
    counts = _trained_counts(examples)
    metrics = likelihood.evaluate(examples, counts, trained.size, SMOOTHING, by=["doc_id"], few_groups=False)
    return _rounded_loss(metrics)


def log_softmax(spark, sf):
    scores = _scores(spark, sf).withColumn("v", vec.log_softmax(F.col("logits")))
    return _long(scores, "v", "log_p")


def target_nll(spark, sf):
    nll = vec.negative_log_likelihood(F.col("logits"), F.col("target_id"))
    return _scores(spark, sf).select("ctx_id", "target_id", F.round(nll, 6).alias("nll"))


def vector_loss(spark, sf):
    return _rounded_loss(likelihood.vector_loss(_scores(spark, sf)))


# Sampling

def temperature_scaling(spark, sf):
    scores = _scores(spark, sf).withColumn("v", vec.temperature(F.col("logits"), TEMPERATURE))
    return _long(scores, "v", "logit")


def _with_history(spark, sf):
    """Score vectors with ids generated before: the labels of eight neighbouring vectors."""
    scores = _scores(spark, sf).withColumn("g", F.call_function("div", F.col("ctx_id"), F.lit(8)))
    # A set of labels is as small as the label alphabet, whatever the group holds.
    history = scores.groupBy("g").agg(F.collect_set("target_id").alias("generated"))
    return scores.join(history, "g")


def repetition_penalty(spark, sf):
    v = vec.repetition_penalty(F.col("logits"), F.col("generated"), PENALTY)
    return _long(_with_history(spark, sf).withColumn("v", v), "v", "logit")


def softmax(spark, sf):
    return _long(_scores(spark, sf).withColumn("v", vec.softmax(F.col("logits"))), "v", "p")


def _kept(scores):
    rows = scores.select("ctx_id", F.posexplode("v").alias("token_id", "p"))
    return rows.where(F.col("p") > 0).select("ctx_id", "token_id", F.round("p", 6).alias("p"))


def top_k_filter(spark, sf):
    probs = vec.with_let(vec.softmax(F.col("logits")), lambda v: vec.top_k(v, TOP_K))
    return _kept(_scores(spark, sf).withColumn("v", probs))


def top_p_filter(spark, sf):
    probs = vec.with_let(vec.softmax(F.col("logits")), lambda v: vec.top_p(v, 0.8))
    return _kept(_scores(spark, sf).withColumn("v", probs))


def _sampled(spark, sf):
    probs = vec.sampling_distribution(
        F.col("logits"), F.col("generated"), t=TEMPERATURE, k=TOP_K, p=TOP_P, penalty=PENALTY
    )
    return _with_history(spark, sf).withColumn("v", probs)


def sampling_distribution(spark, sf):
    return _kept(_sampled(spark, sf))


def categorical_draw(spark, sf):
    u = uniform(SEED, F.lit(0), F.col("ctx_id"))
    return _sampled(spark, sf).select("ctx_id", vec.draw(F.col("v"), u).alias("token_id"))


def _generation_input(spark, sf):
    """Prompts of the conversations and the counts of all contexts."""
    blocks, trained = _packed(spark, sf)
    vectors = likelihood.context_model(_trained_counts(blocks), trained.size, SMOOTHING)
    prompts = codec.encode_lines(_prompts(spark, sf), trained.tokenizer, "text")
    prompts = prompts.withColumn("ids", idf.prompt_prefix(F.col("ids")))
    return generation.prompt_context(prompts, SEQ_LEN), vectors, trained


def greedy_continuation(spark, sf):
    prompts, vectors, trained = _generation_input(spark, sf)
    rows = generation.continue_greedy(prompts, vectors, NEW_TOKENS)
    text = codec.decode_ids(rows, trained.vocab, "generated")
    return text.select("conv_id", "turn", F.array_join("generated", ",").alias("generated"), "text")


def sampled_continuation(spark, sf):
    prompts, vectors, trained = _generation_input(spark, sf)
    rows = generation.continue_sampled(
        prompts, vectors, SAMPLED_TOKENS, ["conv_id", "turn"],
        t=TEMPERATURE, k=TOP_K, p=TOP_P, penalty=PENALTY, seed=SEED,
    )
    return rows.select("conv_id", "turn", F.array_join("generated", ",").alias("generated"))


def greedy_choice(spark, sf):
    return _scores(spark, sf).select("ctx_id", vec.argmax(F.col("logits")).alias("token_id"))


# Run logs

def evaluation_rows(spark, sf):
    return log_ops.evaluation_rows(_log(spark, sf), EVAL_EVERY).select("run_id", "step", "perplexity")


def save_rows(spark, sf):
    return log_ops.save_rows(_log(spark, sf), SAVE_EVERY).select("run_id", "step", "perplexity")


def perplexity_improvements(spark, sf):
    rows = log_ops.improvements(_log(spark, sf))
    return rows.select("run_id", "step", "perplexity", "previous_best")


def best_checkpoint(spark, sf):
    return log_ops.best_rows(_log(spark, sf)).select("run_id", "step", "perplexity")


def last_checkpoint(spark, sf):
    return log_ops.last_rows(_log(spark, sf)).select("run_id", "step", "perplexity")


def _records(spark, sf):
    return log_ops.checkpoint_records(
        _log(spark, sf), EVAL_EVERY, SAVE_EVERY, config=_run_config(), learning_rate=LEARNING_RATE
    )


def checkpoint_records(spark, sf):
    """The records with what they nest, as a reader of the written documents finds them."""
    path = scratch_path(spark, "records")
    log_src.write_records(_records(spark, sf), path)
    records = log_src.read_records(spark, path)
    return records.select(
        "kind", "run_id", "step", F.round("val.loss", 6).alias("val_loss"), F.col("val.perplexity").alias("val_perplexity"),
        F.col("val.tokens").alias("val_tokens"), F.col("config.seq_len").alias("seq_len"),
        F.col("config.dropout").alias("dropout"), "learning_rate",
    )


def _stored_log(spark, sf):
    """The log and its checkpoint records as a reader finds them."""
    path = scratch_path(spark, "runlog")
    log_src.append_runlog(log_ops.evaluation_rows(_log(spark, sf), EVAL_EVERY), path)
    log_src.append_runlog(_records(spark, sf), path)
    return log_src.read_runlog(spark, path)


def runlog_sink(spark, sf):
    return _stored_log(spark, sf).groupBy("run_id").agg(
        F.count("*").alias("records"), F.count("kind").alias("checkpoints"),
        F.max("step").alias("last_step"), F.count("config").alias("with_config"),
        F.round(F.sum("learning_rate"), 6).alias("learning_rates"),
    )


def checkpoint_configs(spark, sf):
    """Model configurations of the stored records, absent fields filled in."""
    records = _stored_log(spark, sf).where(F.col("kind").isNotNull())
    fields = log_src.with_defaults(F.col("config"), log_src.CONFIG_DEFAULTS)
    return records.select("kind", "run_id", "step", *fields)


def config_defaults(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    return events.select("event_id", *log_src.with_defaults(F.col("props"), CONFIG))


QUERIES = {
    f.__name__: f
    for f in [
        corpus_lines, split_assignment, example_markers, prompt_contexts, training_pairs,
        short_block_pairs, text_corpus_blocks, split_scan,
        marker_free_blocks, word_frequencies, symbol_pairs, bpe_merges, character_coverage,
        vocabulary_characters, vocabulary_merges, encode_characters, encode_merges,
        encode_byte_fallback, decode_lines, decode_blocks, piece_lookup, id_lookup,
        roundtrip_audit, unigram_expected_counts, unigram_vocabulary, unigram_roundtrip, tokenizer_metadata, split_token_yield, merged_token_yield,
        packed_blocks, shard_sink, shard_manifest, split_manifest, shard_checks, shard_offsets,
        block_lookup, block_fetch, shuffled_order, batch_sizes, batch_plan, evaluation_batches,
        batch_contents, next_token_counts, next_token_model, loss_per_split, evaluation_loss, loss_per_document,
        log_softmax, target_nll, vector_loss, temperature_scaling, repetition_penalty, softmax,
        top_k_filter, top_p_filter, sampling_distribution, categorical_draw, greedy_choice, greedy_continuation, sampled_continuation,
        evaluation_rows, save_rows, perplexity_improvements, best_checkpoint, last_checkpoint,
        checkpoint_records, runlog_sink, checkpoint_configs, config_defaults,
    ]
}
