"""Tokenizer artifacts: vocabulary and merge tables, and a metadata document."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusblocks.operators.bpe import RESERVED, merges_table
from corpusblocks.operators.codec import Tokenizer
from corpusblocks.operators.unigram import UnigramTokenizer

# Fixed value: fields of the metadata document.
META_SCHEMA = (
    "model_file string, vocab_file string, vocab_size int, special_tokens struct<"
    + ", ".join(f"{name}: struct<token: string, id: int>" for name in RESERVED)
    + ">"
)


def metadata(vocab: DataFrame, model_file: str, vocab_file: str) -> DataFrame:
    """One row ``(model_file, vocab_file, vocab_size, special_tokens)`` from a vocabulary."""
    def entry(name: str, token_id: int):
        piece = F.max(F.when(F.col("token_id") == token_id, F.col("piece")))
        return F.struct(piece.alias("token"), F.lit(token_id).alias("id")).alias(name)

    return vocab.agg(
        F.lit(model_file).alias("model_file"),
        F.lit(vocab_file).alias("vocab_file"),
        F.count("*").cast("int").alias("vocab_size"),
        F.struct(*[entry(name, i) for name, i in RESERVED.items()]).alias("special_tokens"),
    )


def write_tokenizer(
    vocab: DataFrame,
    merges: Sequence[tuple],
    prefix: str,
    scores: Mapping[str, float] | None = None,
) -> None:
    """Write ``<prefix>.vocab``, the model (Parquet) and ``<prefix>.meta.json``.

    The model is ``<prefix>.merges``, or ``<prefix>.scores`` when piece scores are given.
    """
    spark = vocab.sparkSession
    vocab.coalesce(1).write.mode("overwrite").parquet(f"{prefix}.vocab")
    if scores is None:
        model_file, model = f"{prefix}.merges", merges_table(spark, list(merges))
    else:
        model_file, model = f"{prefix}.scores", spark.createDataFrame(pa.table({
            "piece": pa.array(list(scores), pa.string()),
            "score": pa.array(list(scores.values()), pa.float64()),
        }))
    model.coalesce(1).write.mode("overwrite").parquet(model_file)
    meta = metadata(vocab, model_file, f"{prefix}.vocab")
    meta.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(f"{prefix}.meta.json")


def load_tokenizer(spark: SparkSession, prefix: str) -> Tokenizer | UnigramTokenizer:
    """The tokenizer written under a prefix, of either model."""
    vocab = read_vocabulary(spark, prefix)
    pieces = vocab.where(F.col("kind") == "piece").select("piece", "token_id").collect()
    if not pieces:
        return Tokenizer.of(read_merges(spark, prefix), vocab)
    scores = {r["piece"]: r["score"] for r in spark.read.parquet(f"{prefix}.scores").collect()}
    return UnigramTokenizer(scores, {r["piece"]: r["token_id"] for r in pieces})


def read_vocabulary(spark: SparkSession, prefix: str) -> DataFrame:
    return spark.read.parquet(f"{prefix}.vocab")


def read_merges(spark: SparkSession, prefix: str) -> list[tuple[str, str, int]]:
    """The merge list in order; as short as the vocabulary."""
    rows = spark.read.parquet(f"{prefix}.merges").orderBy("rank").collect()
    return [(r["left"], r["right"], r["freq"]) for r in rows]


def special_ids(spark: SparkSession, meta_path: str) -> dict[str, int | None]:
    """The four reserved ids and the vocabulary size of a metadata document.

    A missing reserved token is an error; a missing size is not.
    """
    raw = spark.read.text(meta_path, wholetext=True)
    row = raw.select(F.from_json("value", META_SCHEMA).alias("m")).select(
        *[F.col(f"m.special_tokens.{name}.id").alias(name.lower()) for name in RESERVED],
        F.col("m.vocab_size").alias("vocab_size"),
    ).first()
    found = row.asDict() if row else {}
    missing = [name for name in RESERVED if found.get(name.lower()) is None]
    if missing:
        raise KeyError(f"special tokens without an id in {meta_path}: {missing}")
    return found
