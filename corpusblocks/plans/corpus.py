"""From documents to packed blocks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusblocks.operators import bpe, codec, packing, unigram
from corpusblocks.operators.prefix import Order
from corpusblocks.session import materialize
from corpusblocks.sources import artifacts
from corpusblocks.sources import documents as docs_src


@dataclass(frozen=True)
class TrainedTokenizer:
    merges: list[tuple[str, str, int]]
    vocab: DataFrame
    size: int
    tokenizer: codec.Tokenizer | unigram.UnigramTokenizer


def train_tokenizer(
    lines: DataFrame,
    merges: int | None = None,
    vocab_size: int = 1024,
    coverage: float = 1.0,
    special_tokens: str = "[PAD],[BOS],[EOS],[UNK]",
    model_type: str = "bpe",
    seed_size: int | None = None,
) -> TrainedTokenizer:
    """Learn a vocabulary from the ``line`` column of a training split.

    ``merges`` fixes the number of merges; otherwise as many are learned as fit
    ``vocab_size`` beside reserved tokens, byte pieces and alphabet. The
    ``unigram`` model starts from all repeated substrings instead, or from the best ``seed_size``.
    """
    specials = bpe.special_tokens(special_tokens)
    spark = lines.sparkSession
    words = bpe.word_counts(lines)
    if model_type == "unigram":
        pieces = unigram.learn_unigram(words, vocab_size - bpe.FIRST_LEARNED_ID, coverage, seed_size)
        vocab = bpe.vocabulary_table(spark, [(p, "piece", 0) for p, _ in pieces], specials)
        tokenizer = unigram.UnigramTokenizer.of(pieces, bpe.FIRST_LEARNED_ID)
        return TrainedTokenizer([], vocab, bpe.FIRST_LEARNED_ID + len(pieces), tokenizer)
    if model_type != "bpe":
        raise ValueError(f"model_type must be 'bpe' or 'unigram', got {model_type!r}")
    if merges != 0 or coverage < 1:
        words = materialize(words, "words")  # read again below
    # One row per distinct character: bounded by Unicode.
    alphabet = [(r["ch"], r["freq"]) for r in bpe.covered_alphabet(words, coverage).orderBy("position").collect()]
    uncovered = None
    if coverage < 1:
        every = {r["ch"] for r in bpe.character_counts(words).select("ch").collect()}
        uncovered = sorted(every - {ch for ch, _ in alphabet})
    if merges is None:
        room = vocab_size - bpe.FIRST_LEARNED_ID - len(alphabet)
        if room < 0:
            raise ValueError(
                f"vocab_size {vocab_size} is too small: {bpe.FIRST_LEARNED_ID} reserved and byte "
                f"pieces and {len(alphabet)} characters are needed"
            )
        learned = bpe.learn_merges(words, uncovered=uncovered, pieces=room)
    else:
        learned = bpe.learn_merges(words, merges, uncovered) if merges else []
    vocab = bpe.vocabulary(spark, alphabet, learned, specials)
    size = bpe.FIRST_LEARNED_ID + len(bpe.merged_pieces(learned)) + len(alphabet)
    return TrainedTokenizer(learned, vocab, size, codec.Tokenizer.of(learned, vocab))


def stored_tokenizer(lines: DataFrame, prefix: str, **options) -> TrainedTokenizer:
    """The tokenizer kept under ``prefix``, learned from ``lines`` and written there if there is none yet."""
    spark = lines.sparkSession
    meta = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{prefix}.meta.json/_SUCCESS")
    if not meta.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(meta):
        trained = train_tokenizer(lines, **options)
        scores = getattr(trained.tokenizer, "scores", None)
        artifacts.write_tokenizer(trained.vocab, trained.merges, prefix, scores)
    tokenizer = artifacts.load_tokenizer(spark, prefix)
    merges = artifacts.read_merges(spark, prefix) if isinstance(tokenizer, codec.Tokenizer) else []
    size = artifacts.special_ids(spark, f"{prefix}.meta.json")["vocab_size"]
    return TrainedTokenizer(merges, artifacts.read_vocabulary(spark, prefix), size, tokenizer)


def split_lines(docs: DataFrame, seed: int = 42) -> DataFrame:
    """``(doc_id, split, line_no, line)`` of a document table."""
    return docs_src.document_lines(docs_src.assign_splits(docs, seed=seed))


def encode_corpus(lines: DataFrame, tokenizer: codec.Tokenizer) -> DataFrame:
    """Encoded examples with markers, written once since packing reads them twice."""
    return materialize(packing.wrap_examples(codec.encode_lines(lines, tokenizer)), "examples")


def corpus_blocks(
    examples: DataFrame,
    order: Order,
    seq_len: int = packing.SEQ_LEN,
    blocks_per_shard: int = packing.BLOCKS_PER_SHARD,
) -> DataFrame:
    return packing.pack_blocks(examples, order, seq_len, blocks_per_shard)


def training_lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("split") == "train")
