"""Spelling variants of frequent words by asymmetric q-chunks.

Two words are near when one inserted, deleted or replaced code point turns one into the
other. The shorter word of a pair (either, at equal lengths) contributes two disjoint
chunks, its halves; the other contributes its positional grams of the same sizes. One
edit leaves a half whole, and the other word holds that half at a place shifted by one at
most, so the two meet at one of two keys: an equal beginning, or an equal end after the
shift. A pair whose beginning is whole meets there only, hence no pair is found twice.

What remains of the pair, between the whole parts, has the same edit. Keys that many
words share (a common beginning) are therefore not joined but cut again: the remainder
is halved as the word was, and so on. A key ends up as a word with one place left open,
which no more words can fill than there are letters, so the pairs that are compared stay
near the pairs that exist, however many words begin alike. No key is dropped or capped.

Every candidate pair is verified. Null texts hold no words, an empty table gives no rows,
repeated rows count again, and a null ``doc_id`` is spelled as an empty text. All of it is
DataFrame functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusblocks.llm.common import table
from corpusblocks.session import join_lookup, materialize

#: Letters of a word, its least length in code points and its least number of occurrences.
LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: One occurrence in so many loses a letter, by the hash of document and word.
MISSPELT = 31
#: A form is so many times as frequent as the word it stands for.
RATIO = 10
#: Pairs of chunks and grams that a key may hold before its words are cut again.
PAIRS = 1024


def written_words(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_LENGTH) -> DataFrame:
    """``(word, n)``: words of at least ``least`` code points as the documents spell them.

    Shorter runs cannot become such words, so the pattern passes over them.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    found = docs.select(F.col(key).cast("string").alias("k"), F.explode(runs).alias("run"))
    found = found.select("k", F.translate("run", upper, lower).alias("run"))
    h = F.crc32(F.concat(F.coalesce("k", F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = F.pmod(h, F.length("run").cast("long")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.pmod(h, F.lit(MISSPELT)) == 0, cut).otherwise(F.col("run"))
    return found.select(word.alias("word")).where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))


def _part(begin: Column, end: Column) -> Column:
    """The code points of ``word`` from ``begin`` up to ``end``, counted from 0."""
    return F.substring(F.col("word"), begin + 1, end - begin)


def _halved(rows: DataFrame) -> DataFrame:
    """Two rows for each: its remainder ``[s, e)`` without the first half, or without the second.

    ``m`` is the length of the chunk side, ``d`` by how much ``word`` is longer. Rows whose
    remainder would be negative cannot hold the edit and go.
    """
    h = F.col("s") + F.call_function("div", F.col("e") - F.col("s"), F.lit(2)).cast("int")
    cuts = F.array(
        F.struct(h.alias("s"), F.col("e").alias("e")),
        F.struct(F.col("s").alias("s"), h.alias("e")),
    )
    kept = [c for c in rows.columns if c not in ("s", "e", "key")]
    cut = rows.select(*kept, F.inline(cuts)).where(F.col("e") - F.col("s") + F.col("d") >= 0)
    whole = F.concat_ws(
        ":", "m", "s", "e", _part(F.lit(0), F.col("s")), _part(F.col("e") + F.col("d"), F.col("m") + F.col("d"))
    )
    return cut.withColumn("key", whole)


def near_pairs(words: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """``(a, b, a_n, b_n)``: every pair of ``words(word, n)`` one edit apart, once."""
    length = F.length("word")
    side = lambda d: words.select(
        "word", "n", F.lit(d).alias("d"), (length - d).alias("m"), F.lit(0).alias("s"), (length - d).alias("e")
    )
    chunks, grams = side(0), side(0).unionByName(side(1)).where("m > 0")
    found = []
    while True:
        chunks, grams = _halved(chunks), _halved(grams)
        sizes = chunks.groupBy("key").agg(F.count("*").alias("c"), F.lit(0).cast("long").alias("g"))
        sizes = sizes.unionByName(grams.groupBy("key").agg(F.lit(0).cast("long").alias("c"), F.count("*").alias("g")))
        sizes = sizes.groupBy("key").agg(F.sum("c").alias("c"), F.sum("g").alias("g")).where("c > 0 and g > 0")
        crowded = materialize(sizes.where(F.col("c") * F.col("g") > pairs).select("key"), "crowded")
        # A remainder of one code point cannot be cut any further: such keys are as full as the alphabet allows.
        again = chunks.where("e - s > 1"), grams.where("e - s > 1")
        hot_chunks, hot_grams = (materialize(join_lookup(x, crowded, ["key"]), "remainders") for x in again)
        rest = crowded.withColumn("hot", F.lit(True))
        calm = [join_lookup(x, rest, ["key"], "left").where("hot is null or e - s <= 1") for x in (chunks, grams)]
        found.append(materialize(_verified(*calm), "near"))
        if hot_chunks.isEmpty() or hot_grams.isEmpty():
            return reduce(DataFrame.unionByName, found)
        chunks, grams = hot_chunks, hot_grams


def _verified(chunks: DataFrame, grams: DataFrame) -> DataFrame:
    left = chunks.select("key", F.col("word").alias("a"), F.col("n").alias("a_n"), "m", "e")
    right = grams.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"), "d")
    met = left.join(right, "key").where((F.col("d") > 0) | (F.col("a") < F.col("b")))
    # Pairs that are equal up to a cut belong to the half behind it.
    whole = F.substring(F.col("a"), F.lit(1), F.col("e")) == F.substring(F.col("b"), F.lit(1), F.col("e"))
    met = met.where((F.col("e") == F.col("m")) | ~whole)
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "b", "a_n", "b_n")


def variant_forms(words: DataFrame, ratio: int = RATIO, pairs: int = PAIRS) -> DataFrame:
    """``words(word, n)`` with ``form``, ``form_n``, ``n_near`` and ``root``.

    ``form`` is the most frequent near word (ties: the smallest), if it is ``ratio`` times as
    frequent; ``root`` follows forms to the last one, ``word`` itself without any.
    """
    words = materialize(words.select("word", "n"), "words")
    found = near_pairs(words, pairs)
    both = found.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(
        found.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best")
    )
    taken = -F.col("best.minus") >= ratio * F.col("n")
    formed = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best.near")).alias("form"), F.when(taken, -F.col("best.minus")).alias("form_n"),
    )
    return _rooted(materialize(formed, "forms"))


def _rooted(formed: DataFrame) -> DataFrame:
    """Add ``root`` by doubling: every round follows twice as many forms.

    Counts grow by the ratio along a path, so a few rounds reach the end of all.
    """
    links = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        links = materialize(
            join_lookup(links, ahead, ["root"], "left").select(
                "word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")
            ),
            "roots",
        )
        if links.where("moved").isEmpty():
            break
        links = links.drop("moved")
    rooted = formed.join(links.select("word", "root"), "word", "left")
    return rooted.withColumn("root", F.coalesce("root", "word"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near-word counts, forms and roots."""
    words = written_words(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return variant_forms(words.where(F.col("n") >= LEAST_COUNT)).select("word", "form", "root", "n", "n_near", "form_n")
