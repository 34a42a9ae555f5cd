"""Unigram fitting against enumeration of all segmentations."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from corpusblocks import session
from corpusblocks.operators import bpe, codec, unigram
from corpusblocks.plans import corpus
from corpusblocks.sources import artifacts


def segmentations(word):
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        pieces, start = [], 0
        for i, cut in enumerate(cuts, 1):
            if cut:
                pieces.append(word[start:i])
                start = i
        yield [*pieces, word[start:]]


def scored(word, scores, unknown):
    for pieces in segmentations(word):
        each = [scores.get(p, unknown if len(p) == 1 else None) for p in pieces]
        if None not in each:
            yield pieces, sum(each)


def test_expectations_and_best_segmentation_by_enumeration():
    rng = random.Random(2)
    for _ in range(60):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 8)))
        scores = {p: rng.uniform(-6, -1) for p in {word[i:j] for i in range(len(word)) for j in range(i + 1, len(word) + 1)} if len(p) == 1 and p != "c" or rng.random() < 0.5 and len(p) > 1}
        unknown = unigram._unknown_score(scores)
        every = list(scored(word, scores, unknown))
        total = sum(math.exp(s) for _, s in every)
        want = {}
        for pieces, s in every:
            for p in pieces:
                want[p] = want.get(p, 0) + math.exp(s) / total
        got, log_total = unigram.word_expectations(word, scores, unknown)
        assert log_total == pytest.approx(math.log(total))
        assert {p: pytest.approx(n) for p, n in want.items()} == dict(got)
        pieces, best = unigram.best_pieces(word, scores, unknown)
        assert best == pytest.approx(max(s for _, s in every)) and "".join(pieces) == word


def test_seeds(spark):
    words = spark.createDataFrame([("abab", 3), ("b", 9), ("xy", 1)], "word string, freq long")
    assert {r[0]: r[1] for r in unigram.seed_pieces(words).collect()} == {"ab": 6, "ba": 3, "aba": 3, "bab": 3, "abab": 3}
    assert [r[0] for r in unigram.seed_pieces(words, limit=1).collect()] == ["ab"]
    assert {r[0] for r in unigram.seed_pieces(words, max_length=2).collect()} == {"ab", "ba"}


def test_training_encoding_and_round_trip(spark):
    rng = random.Random(4)
    stems = ["the", "cat", "sing", "ing", "ed", "walk", "é", "talk"]
    texts = [" ".join("".join(rng.choices(stems, k=rng.randint(1, 3))) for _ in range(6)) for _ in range(200)]
    lines = spark.createDataFrame([(t,) for t in texts], "line string")
    trained = corpus.train_tokenizer(lines, vocab_size=300, model_type="unigram", seed_size=200)
    assert trained.size == 300 == trained.vocab.count()
    pieces = {r["piece"] for r in trained.vocab.where("kind = 'piece'").collect()}
    assert {"ing", "walk"} <= {p.replace("▁", "") for p in pieces} and set("".join(texts)) - {" "} <= pieces
    df = spark.createDataFrame([(t,) for t in [*texts, "unseen ñ 😀 word"]], "line string")
    encoded = df.withColumn("ids", codec.encoder(trained.tokenizer)(F.col("line")))
    back = codec.decode_ids(encoded, trained.vocab)
    assert back.where("line <> text").isEmpty()
    longest = encoded.where(F.col("line").startswith("unseen")).first()["ids"]
    assert 4 + "ñ".encode()[0] in longest
    mean = encoded.limit(200).agg(F.avg(F.size("ids") / F.length("line"))).first()[0]
    assert mean < 0.5


def test_tokenizers_survive_writing_and_loading(spark, tmp_path):
    lines = spark.createDataFrame([("abab cab",), ("bab é",)], "line string")
    for model_type in ("bpe", "unigram"):
        trained = corpus.train_tokenizer(lines, vocab_size=268, model_type=model_type, seed_size=20)
        prefix = str(tmp_path / model_type)
        scores = getattr(trained.tokenizer, "scores", None)
        artifacts.write_tokenizer(trained.vocab, trained.merges, prefix, scores)
        assert artifacts.load_tokenizer(spark, prefix) == trained.tokenizer
        assert artifacts.special_ids(spark, f"{prefix}.meta.json")["vocab_size"] == trained.size


def test_expected_counts_do_not_depend_on_partitions(spark):
    words = spark.createDataFrame([("aab", 2), ("ab", 5), ("b", 1)], "word string, freq long")
    scores = spark.createDataFrame([("a", -1.0), ("b", -1.5), ("ab", -2.0), ("aa", -3.0)], "piece string, score double")
    one = {r[0]: r[1] for r in unigram.expected_counts(words.coalesce(1), scores).collect()}
    many = {r[0]: r[1] for r in unigram.expected_counts(words.repartition(3), scores).collect()}
    assert one.keys() == many.keys() and all(one[p] == pytest.approx(many[p]) for p in one)


def test_lattices_equal_the_plain_walk(spark):
    """Expected counts in the row against the walk of one word, with unknown characters and one long word."""
    rng = random.Random(6)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randint(1, 20))): rng.randint(1, 9) for _ in range(120)}
    words |= {"ab" * 400: 2, "x": 3}
    whole = "".join(words)
    scores = {c: rng.uniform(-4, -1) for c in "abé"}
    while len(scores) < 60:
        i = rng.randrange(len(whole) - 6)
        scores[whole[i: i + rng.randint(2, 6)]] = rng.uniform(-9, -3)
    unknown = min(scores.values()) - unigram.UNKNOWN_PENALTY
    want = {}
    for word, freq in words.items():
        for piece, n in unigram.word_expectations(word, scores, unknown)[0].items():
            if piece in scores:
                want[piece] = want.get(piece, 0) + freq * n
    frame = spark.createDataFrame(list(words.items()), "word string, freq long").repartition(4)
    table = spark.createDataFrame(list(scores.items()), "piece string, score double")
    got = {r[0]: r[1] for r in unigram.expected_counts(frame, table).collect()}
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p]) for p in got)


def test_substrings_are_joined_once_without_salted_copies(spark, monkeypatch):
    """Scores that are too many for a broadcast: the same counts, substrings cross by piece once."""
    monkeypatch.setattr(session, "holds_at_most", lambda df, rows: False)
    monkeypatch.setattr(unigram, "holds_at_most", lambda df, rows: False, raising=False)
    scores = {"a": -1.0, "b": -1.5, "ab": -2.0, "ba": -3.0, "abab": -4.0}
    words = {"abab": 3, "bacab": 2, "b": 4}
    want = {}
    for word, freq in words.items():
        for piece, n in unigram.word_expectations(word, scores, -20.0)[0].items():
            want[piece] = want.get(piece, 0) + freq * n
    frame = spark.createDataFrame(list(words.items()), "word string, freq long")
    table = spark.createDataFrame(list(scores.items()), "piece string, score double")
    found = unigram.expected_counts(frame, table, unknown=-20.0)
    assert {r[0]: r[1] for r in found.collect()} == {p: pytest.approx(n) for p, n in want.items() if p in scores}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in plan and "LeftSemi, (piece" in plan and plan.count("LeftSemi") == 1


def test_many_words_are_counted_in_parts(spark, monkeypatch):
    """Substrings of many words are shuffled a part at a time, with the same seeds and expected counts."""
    rng = random.Random(9)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 9))): rng.randint(1, 4) for _ in range(50)}
    frame = spark.createDataFrame(list(words.items()), "word string, freq long")

    def found():
        pieces = unigram.initial_pieces(frame)
        counts = unigram.expected_counts(frame, pieces.scores, unknown=pieces.unknown)
        return [{r[0]: r[1] for r in rows.collect()} for rows in (pieces.counts, counts)]

    whole = found()
    written = []
    write = unigram.materialize
    monkeypatch.setattr(unigram, "materialize", lambda df, name: written.append(name) or write(df, name))
    monkeypatch.setattr(unigram, "PART_WORDS", 20)
    pieces, counts = found()
    assert written.count("part") == 6
    assert pieces == whole[0] and counts == {p: pytest.approx(n) for p, n in whole[1].items()}


def test_pruning_keeps_what_costs_most(spark):
    rng = random.Random(8)
    counts = {c: rng.randint(100, 900) for c in "abc"}
    while len(counts) < 40:
        counts.setdefault("".join(rng.choice("abc") for _ in range(rng.randint(2, 6))), rng.randint(1, 60))
    table = unigram.Pieces.of(spark.createDataFrame(list(counts.items()), "piece string, n long"))
    scores = {p: math.log(n) - math.log(sum(counts.values())) for p, n in counts.items()}
    assert {r["piece"]: pytest.approx(r["score"]) for r in table.scores.collect()} == scores
    assert (table.size, table.chars) == (40, 3) and table.unknown == pytest.approx(min(scores.values()) - 10)
    loss = {p: round(n * (scores[p] - unigram.best_pieces(p, scores, table.unknown, without=p)[1]), 6) for p, n in counts.items() if len(p) > 1}
    want = set("abc") | set(sorted(loss, key=lambda p: (-loss[p], p))[:12])
    assert {r["piece"] for r in unigram._pruned(table, 15).counts.collect()} == want


@pytest.mark.parametrize("options", [{}, {"coverage": 0.9, "seed_size": 60}])
def test_fitting_by_vectors_equals_fitting_in_tables(spark, monkeypatch, options):
    """Fits over shelves write no arcs, and find the pieces and scores of the joins of arcs."""
    rng = random.Random(12)
    stems = ["abc", "ab", "ca", "é😀", "ñ", "bcab"]
    words = {"".join(rng.choices(stems, k=rng.randint(1, 4))): rng.randint(1, 9) for _ in range(60)} | {"ab" * 40: 2, "x": 1}
    frame = spark.createDataFrame(list(words.items()), "word string, freq long")
    written = []
    write = unigram.materialize
    monkeypatch.setattr(unigram, "materialize", lambda df, name: written.append(name) or write(df, name))
    found = unigram.learn_unigram(frame, 20, **options)
    assert "lattices" in written and "arcs" not in written
    monkeypatch.setattr(unigram, "VECTOR_PIECES", 0)
    want = dict(unigram.learn_unigram(frame, 20, **options))
    assert "arcs" in written
    assert dict(found) == {p: pytest.approx(s) for p, s in want.items()}


def test_too_many_characters(spark):
    words = spark.createDataFrame([("abcdef", 2)], "word string, freq long")
    with pytest.raises(ValueError):
        unigram.learn_unigram(words, 3)
    with pytest.raises(ValueError):
        corpus.train_tokenizer(spark.createDataFrame([("a",)], "line string"), model_type="words")


def test_vocabulary_table_order(spark):
    rows = bpe.vocabulary_table(spark, [("x", "piece", 0)]).where("token_id >= 260").collect()
    assert [(r["token_id"], r["piece"]) for r in rows] == [(260, "x")]
