"""Merge learning against a plain one-at-a-time learner."""

import random
from collections import Counter

import pytest

from corpusblocks.operators import bpe
from corpusblocks.plans import corpus


def merge(symbols, left, right):
    out, i = [], 0
    while i < len(symbols):
        if i + 1 < len(symbols) and symbols[i] == left and symbols[i + 1] == right:
            out.append(left + right)
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    return out


def count_pairs(table):
    pairs = Counter()
    for symbols, freq in table:
        for pair in zip(symbols, symbols[1:]):
            pairs[pair] += freq
    return sorted(((l, r, n) for (l, r), n in pairs.items()), key=lambda p: (-p[2], p[0], p[1]))


def one_at_a_time(words, count):
    table, merges = [(list(w), f) for w, f in words.items()], []
    while len(merges) < count:
        ranked = count_pairs(table)
        if not ranked:
            break
        left, right, n = ranked[0]
        merges.append((left, right, n))
        table = [(merge(s, left, right), f) for s, f in table]
    return merges


def in_batches(words, count, top):
    table, merges, built, rounds = [(list(w), f) for w, f in words.items()], [], set(), 0
    while len(merges) < count:
        ranked = count_pairs(table)
        if not ranked:
            break
        batch = bpe.independent_batch(ranked[:top], built, count - len(merges), len(ranked) < top)
        for left, right, _ in batch:
            table = [(merge(s, left, right), f) for s, f in table]
        built |= {left + right for left, right, _ in batch}
        merges += batch
        rounds += 1
    return merges, rounds


@pytest.mark.parametrize("block", range(4))
def test_batches_equal_sequential_merges_on_random_corpora(block):
    for seed in range(block * 400, block * 400 + 400):
        rng = random.Random(seed)
        letters = "abcdefgh"[: rng.randint(1, 8)]
        words = {
            "".join(rng.choice(letters) for _ in range(rng.randint(1, 12))): rng.choice([1, 1, 2, 3, rng.randint(1, 40)])
            for _ in range(rng.randint(1, 60))
        }
        count, top = rng.randint(1, 40), rng.choice([2, 5, 20, 500])
        assert in_batches(words, count, top)[0] == one_at_a_time(words, count), seed


def test_batches_save_rounds():
    rng = random.Random(1)
    words = {
        "".join(rng.choices("etaoinshrdlu", weights=range(12, 0, -1), k=rng.randint(2, 9))): rng.randint(1, 900)
        for _ in range(3000)
    }
    merges, rounds = in_batches(words, 60, 200)
    assert merges == one_at_a_time(words, 60)
    assert rounds < 45


def test_overlapping_pairs_merge_left_to_right(spark):
    words = spark.createDataFrame([("aaaaa", 3), ("baa", 2)], "word string, freq long")
    assert bpe.learn_merges(words, 3) == one_at_a_time({"aaaaa": 3, "baa": 2}, 3)


def test_spark_learner_equals_sequential(spark):
    rng = random.Random(7)
    words = {"▁" + "".join(rng.choice("abcdeé😀") for _ in range(rng.randint(1, 9))): rng.randint(1, 30) for _ in range(300)}
    table = spark.createDataFrame(list(words.items()), "word string, freq long").repartition(5)
    assert bpe.learn_merges(table, 60) == one_at_a_time(words, 60)


@pytest.mark.parametrize("top", [1, 4, 30])
def test_few_counts_kept_are_enough(spark, top):
    """Pairs left out are counted again when the kept ones no longer tell which is best."""
    rng = random.Random(top)
    words = {"▁" + "".join(rng.choice("abcab\"\\'é") for _ in range(rng.randint(1, 7))): rng.randint(1, 5) for _ in range(80)}
    table = spark.createDataFrame(list(words.items()), "word string, freq long")
    assert bpe.learn_merges(table, 25, top_pairs=top) == one_at_a_time(words, 25)


def test_until_so_many_pieces(spark):
    """Strings that two merges spell count once."""
    words = {"▁abc": 9, "▁bc": 8, "▁ab": 30, "▁aabc": 7, "cabcab": 5, "bcabc": 6}
    table = spark.createDataFrame(list(words.items()), "word string, freq long")
    merges = bpe.learn_merges(table, pieces=9)
    assert merges == one_at_a_time(words, len(merges)) and len(bpe.merged_pieces(merges)) == 9


def test_index_with_several_shelves(spark, monkeypatch):
    monkeypatch.setattr(bpe, "SHELF_ROWS", 40)
    monkeypatch.setattr(bpe, "MERGES_PER_CUT", 10)
    rng = random.Random(3)
    words = {"▁" + "".join(rng.choice("abcde") for _ in range(rng.randint(2, 8))): rng.randint(1, 50) for _ in range(60)}
    table = spark.createDataFrame(list(words.items()), "word string, freq long")
    assert bpe.learn_merges(table, 30) == one_at_a_time(words, 30)


def test_words_are_stored_once(spark, monkeypatch):
    """What learning writes and every round reads is one number per character, not a word per symbol boundary."""
    written = []

    def keep(df, name, by=()):
        written.append(df.cache())
        return written[-1]

    monkeypatch.setattr(bpe, "materialize", keep)
    monkeypatch.setattr(bpe, "MERGES_PER_CUT", 5)
    rng = random.Random(5)
    words = {"▁" + "".join(rng.choice("abcde") for _ in range(rng.randint(4, 12))): rng.randint(1, 50) for _ in range(200)}
    table = spark.createDataFrame(list(words.items()), "word string, freq long")
    assert bpe.learn_merges(table, 12) == one_at_a_time(words, 12)
    characters = sum(map(len, words)) + len(words)
    for df in written:
        assert df.selectExpr("sum(length(symbols))").first()[0] <= 4 * characters
        assert df.selectExpr("sum(length(freqs))").first()[0] <= 8 * len(words)
        df.unpersist()


def test_equal_symbols_merge_by_vectors_as_one_at_a_time(spark):
    """Runs of one symbol, of any length, and words side by side that end and begin with it."""
    words = {"a" * n: n for n in range(1, 12)} | {"b" + "a" * n + "b": 3 for n in range(1, 9)}
    table = spark.createDataFrame(list(words.items()), "word string, freq long").coalesce(1)
    assert bpe.learn_merges(table, 12) == one_at_a_time(words, 12)


def test_learning_stops_when_pairs_run_out(spark):
    words = spark.createDataFrame([("ab", 2)], "word string, freq long")
    assert bpe.learn_merges(words, 10) == [("a", "b", 2)]
    assert bpe.learn_merges(words.limit(0), 10) == []


def test_uncovered_characters_take_part_in_no_pair(spark):
    words = spark.createDataFrame([("axb", 5), ("ab", 1)], "word string, freq long")
    assert bpe.learn_merges(words, 5, uncovered=["x"]) == [("a", "b", 1)]


def test_special_tokens():
    names = {"PAD": "[PAD]", "UNK": "[UNK]", "BOS": "[BOS]", "EOS": "[EOS]"}
    assert bpe.special_tokens() == names
    assert bpe.special_tokens("EOS, [BOS],UNK,,PAD,PAD") == names
    for wrong in ("[PAD],[BOS],[EOS]", "[PAD],[BOS],[EOS],[UNK],[SEP]", ""):
        with pytest.raises(ValueError):
            bpe.special_tokens(wrong)


def lines_of(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "line string")


def test_vocabulary_layout(spark):
    trained = corpus.train_tokenizer(lines_of(spark, ["aab aab", "ab b"]), vocab_size=265)
    rows = {r["token_id"]: r["piece"] for r in trained.vocab.collect()}
    assert [rows[i] for i in range(4)] == ["[PAD]", "[UNK]", "[BOS]", "[EOS]"]
    assert rows[4] == "<0x00>" and rows[259] == "<0xFF>"
    assert sorted(rows) == list(range(265)) and trained.size == 265
    assert {rows[262], rows[263], rows[264]} == {"a", "b", "▁"}
    assert rows[260] == "ab"


def test_vocabulary_too_small_or_exhausted(spark):
    with pytest.raises(ValueError):
        corpus.train_tokenizer(lines_of(spark, ["abc"]), vocab_size=262)
    assert corpus.train_tokenizer(lines_of(spark, ["ab"]), vocab_size=1000).size == 260 + 3 + 2


def test_character_coverage_prefix(spark):
    words = spark.createDataFrame([("aaaaab", 1), ("bbc", 1), ("d", 1)], "word string, freq long")
    ranked = lambda c: [r["ch"] for r in bpe.covered_alphabet(words, c).orderBy("position").collect()]
    assert ranked(1.0) == ["a", "b", "c", "d"]
    assert ranked(0.8) == ["a", "b"]
    assert ranked(0.81) == ["a", "b", "c"]
