"""Unigram vocabulary: pieces with probabilities, fitted by expectation maximisation.

As with merges, all work runs on the table of distinct words. Words become lattices: one
row per word, with the pieces that end at each of its places. Forward and backward sums
walk the lattice inside the row, expected counts are summed by piece, and the pieces, from
all repeated substrings on, are a table until they are few enough for vectors (``lattices.py``).
Nothing is cut but by the rules of fitting; the driver sees sizes, totals and, in the end,
one count of each piece.
"""

from __future__ import annotations

import math
from array import array
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusblocks.functions.ids import FIRST_BYTE_ID
from corpusblocks.operators.bpe import covered_alphabet
from corpusblocks.operators.lattices import Tree, fitted, shelved, thinned
from corpusblocks.session import BROADCAST_ROWS, discard, holds_at_most, join_lookup, materialize, task_count

MAX_PIECE = 16
SUB_ITERATIONS = 2
SHRINK = 0.75
# Pieces expected less often than this are dropped; characters stay.
MIN_EXPECTED = 0.5
# Score of an unknown character below the rarest piece.
UNKNOWN_PENALTY = 10.0
# Pieces of which the driver and every task hold some numbers: 8 bytes each go to a task at every step.
VECTOR_PIECES = 6_000_000
# Words whose substrings are shuffled at once, in all tasks together.
PART_WORDS = 2_000_000
# Words whose lattices one task reads, if that makes more tasks than there are cores.
TASK_WORDS = 200_000


def seed_pieces(words: DataFrame, limit: int | None = None, max_length: int = MAX_PIECE) -> DataFrame:
    """``(piece, freq)``: repeated substrings of two characters and more; the best by freq × length under a limit."""
    n = F.length("word")
    starts = F.sequence(F.lit(1), n - 1)
    pieces = F.flatten(F.transform(starts, lambda i: F.transform(
        F.sequence(F.lit(2), F.least(F.lit(max_length), n - i + 1)),
        lambda size: F.col("word").substr(i, size),
    )))
    spans = words.where(n > 1).select(F.explode(pieces).alias("piece"), "freq")
    count = lambda part: part.groupBy("piece").agg(F.sum("freq").alias("freq")).where(F.col("freq") > 1)
    counted = _by_parts(spans, "piece", _parts(words), count)
    if limit is None:
        return counted
    return counted.orderBy(F.desc(F.col("freq") * F.length("piece")), "piece").limit(limit)


def _parts(words: DataFrame) -> int:
    return max(1, -(-words.count() // PART_WORDS))


def _by_parts(rows: DataFrame, key: str, parts: int, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``make`` of the rows of some keys at a time, all together.

    The parts are written one after another, so that shuffle files of one lie on the disks at a time.
    """
    if parts == 1:
        return make(rows)
    part_of = F.pmod(F.xxhash64(key), F.lit(parts))
    return reduce(DataFrame.unionByName, [materialize(make(rows.where(part_of == part)), "part") for part in range(parts)])


def _arcs(word: str, scores: dict[str, float], unknown: float):
    """``(start, end, score)`` of all pieces inside a word, by end; every character has one."""
    longest = MAX_PIECE
    for end in range(1, len(word) + 1):
        single = scores.get(word[end - 1])
        yield end - 1, end, unknown if single is None else single
        for start in range(max(0, end - longest), end - 1):
            score = scores.get(word[start:end])
            if score is not None:
                yield start, end, score


def _unknown_score(scores: dict[str, float]) -> float:
    return min(scores.values(), default=0.0) - UNKNOWN_PENALTY


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a)) if b > -math.inf else a


def word_expectations(word: str, scores: dict[str, float], unknown: float) -> tuple[dict[str, float], float]:
    """Expected count of every piece over all segmentations of a word, and its log-likelihood."""
    arcs = list(_arcs(word, scores, unknown))
    forward = [0.0] + [-math.inf] * len(word)
    for start, end, score in arcs:
        forward[end] = _log_add(forward[end], forward[start] + score)
    backward = [-math.inf] * len(word) + [0.0]
    for start, end, score in reversed(arcs):
        backward[start] = _log_add(backward[start], backward[end] + score)
    total = forward[-1]
    expected: dict[str, float] = defaultdict(float)
    for start, end, score in arcs:
        expected[word[start:end]] += math.exp(forward[start] + score + backward[end] - total)
    return expected, total


def best_pieces(word: str, scores: dict[str, float], unknown: float, without: str | None = None) -> tuple[list[str], float]:
    """The most probable segmentation and its score; the fewest characters first among equals."""
    best = [0.0] + [-math.inf] * len(word)
    back = [0] * (len(word) + 1)
    for start, end, score in _arcs(word, scores, unknown):
        if without is not None and end - start == len(without) and word[start:end] == without:
            continue
        if best[start] + score > best[end]:
            best[end], back[end] = best[start] + score, start
    pieces, end = [], len(word)
    while end:
        pieces.append(word[back[end]:end])
        end = back[end]
    return pieces[::-1], best[-1]


def _spans(words: DataFrame) -> DataFrame:
    """``(word, freq, start, end, piece)``: all substrings of up to ``MAX_PIECE`` characters inside every word."""
    spans = """flatten(transform(sequence(0, length(word) - 1), i -> transform(
      sequence(1, least({0}, length(word) - i)), n -> struct(i AS start, i + n AS end, substr(word, i + 1, n) AS piece))))"""
    return words.where(F.length("word") > 0).selectExpr("word", "freq", f"inline({spans.format(MAX_PIECE)})")


def lattice_arcs(words: DataFrame, pieces: DataFrame, whole: bool = True) -> DataFrame:
    """``(word, freq, start, end, piece)``: pieces inside every word; every character is one.

    Without ``whole`` a word is no arc of its own lattice, unless it is a single character.
    """
    spread = _spans(words)
    if not whole:
        spread = spread.where("end - start < length(word) OR length(word) = 1")
    long = spread.where("end - start > 1").join(pieces.select("piece"), "piece", "left_semi")
    return long.select(*spread.columns).unionByName(spread.where("end - start = 1"))


def lattices(arcs: DataFrame, scores: DataFrame, unknown: float, few: bool = False) -> DataFrame:
    """``(word, freq, ends)``: one row per word, with the scored arcs that end at each place.

    Characters without a score have the unknown one; longer arcs without one are left out. ``few``
    says that the scores are known to be few enough for a broadcast. An arc carries no piece: it lies in the word.
    """
    # Characters are few and in every word: apart from the rest they cannot crowd a task. A longer piece
    # is one of many arcs of a word, so its share of all arcs is small and the join needs no salted copies.
    singles, longs = (scores.where(c).select("piece", "score") for c in ("length(piece) = 1", "length(piece) > 1"))
    longs = F.broadcast(longs) if few or holds_at_most(longs, BROADCAST_ROWS) else longs
    kept = ("word", "freq", "start", "end", "score")
    scored = arcs.where("end - start > 1").join(longs, "piece").select(*kept)
    # One row per character: bounded by Unicode.
    single = join_lookup(arcs.where("end - start = 1"), singles, ["piece"], "left", bounded=True)
    scored = scored.unionByName(single.withColumn("score", F.coalesce("score", F.lit(unknown))).select(*kept))
    # One exchange by word serves both groupings.
    by_end = scored.repartition("word").groupBy("word", "freq", "end").agg(
        F.sort_array(F.collect_list(F.struct("start", "score"))).alias("arcs")
    )
    return by_end.groupBy("word", "freq").agg(F.sort_array(F.collect_list(F.struct("end", "arcs"))).alias("ends"))


_LOG_SUM = "transform(array({0}), v -> array_max(v) + ln(aggregate(v, 0D, (t, x) -> t + exp(x - array_max(v)))))[0]"


def _forward(combine: str) -> str:
    """SQL of an array over the places of a lattice: what ``combine`` makes of all ways from the start to a place."""
    into = combine.format("transform(e.arcs, x -> f[x.start] + x.score)")
    return f"aggregate(ends, array(0D), (f, e) -> concat(f, array({into})))"


@dataclass(frozen=True)
class Pieces:
    """A written table ``(piece, n)`` of expected counts, and what one look at it says."""

    counts: DataFrame
    total: float
    least: float
    size: int
    chars: int

    @staticmethod
    def of(counts: DataFrame) -> "Pieces":
        counts = materialize(counts.select("piece", F.col("n").cast("double").alias("n")), "pieces")
        found = counts.agg(
            F.sum("n"), F.min("n"), F.count("*"), F.count_if(F.length("piece") == 1)
        ).first()
        return Pieces(counts, found[0] or 1.0, found[1] or 1.0, found[2], found[3])

    @property
    def scores(self) -> DataFrame:
        """``(piece, n, score)``: log-probabilities."""
        return self.counts.select("piece", "n", (F.log("n") - math.log(self.total)).alias("score"))

    @property
    def unknown(self) -> float:
        return math.log(self.least) - math.log(self.total) - UNKNOWN_PENALTY

    @property
    def few(self) -> bool:
        return self.size <= BROADCAST_ROWS


def expected_counts(
    words: DataFrame, scores: DataFrame, arcs: DataFrame | None = None, unknown: float | None = None, few: bool = False
) -> DataFrame:
    """``(piece, expected)`` of ``scores(piece, score)`` over all segmentations of all words.

    ``arcs`` of the words, the score of ``unknown`` characters and whether scores are ``few`` may be known already.
    """
    if unknown is None:
        unknown = (scores.agg(F.min("score")).first()[0] or 0.0) - UNKNOWN_PENALTY
    if arcs is None:
        # Substrings without a score go as they are scored, in one exchange.
        parts = _parts(words)
        made = _by_parts(words, "word", parts, lambda part: expected_counts(part, scores, _spans(part), unknown, few))
        return made if parts == 1 else made.groupBy("piece").agg(F.sum("expected").alias("expected"))
    # The arcs that start at a place are found by turning the lattice over.
    turned = """transform(sequence(0, size(ends) - 1), i -> flatten(transform(
      slice(ends, i + 1, least({0}, size(ends) - i)), e -> transform(filter(e.arcs, x -> x.start = i),
        x -> struct(e.end AS end, x.score AS score)))))""".format(MAX_PIECE)
    backward = "aggregate(reverse(starts), array(0D), (b, s) -> concat(array({0}), b))".format(
        _LOG_SUM.format("transform(s, x -> x.score + b[x.end - (size(ends) - size(b)) - 1])")
    )
    walked = lattices(arcs, scores, unknown, few).selectExpr(
        "word", "freq", "ends", f"{turned} AS starts", f"{_forward(_LOG_SUM)} AS f"
    )
    walked = walked.selectExpr("word", "freq", "ends", "f", f"{backward} AS b")
    shares = """flatten(transform(ends, e -> transform(e.arcs,
      x -> struct(substr(word, x.start + 1, e.end - x.start) AS piece, freq * exp(f[x.start] + x.score + b[e.end] - f[size(ends)]) AS expected))))"""
    summed = walked.selectExpr(f"inline({shares})").groupBy("piece").agg(F.sum("expected").alias("expected"))
    return summed.join(scores.select("piece"), "piece", "left_semi")


def _fitted(words: DataFrame, arcs: DataFrame, pieces: Pieces) -> Pieces:
    """One expectation and maximisation step; pieces expected too rarely go, characters stay."""
    expected = expected_counts(words, pieces.scores, arcs, pieces.unknown, pieces.few)
    counts = pieces.counts.select("piece").join(expected, "piece", "left")
    counts = counts.select("piece", F.round("expected", 6).alias("n"))
    kept = counts.where((F.col("n") >= MIN_EXPECTED) | (F.length("piece") == 1))
    return Pieces.of(kept.select("piece", F.greatest(F.coalesce("n", F.lit(0.0)), F.lit(MIN_EXPECTED)).alias("n")))


def _pruned(pieces: Pieces, size: int) -> Pieces:
    """The characters and the pieces whose loss would cost most likelihood, ``size`` in all."""
    long = pieces.scores.where(F.length("piece") > 1).withColumnRenamed("piece", "word")
    arcs = lattice_arcs(long.select("word", F.lit(1).alias("freq")), pieces.counts, whole=False)
    best = lattices(arcs, pieces.scores, pieces.unknown, pieces.few)
    best = best.selectExpr("word", f"{_forward('array_max({0})')}[size(ends)] AS best")
    loss = F.round(F.col("n") * (F.col("score") - F.col("best")), 6).alias("loss")
    ranked = long.join(best, "word").select(F.col("word").alias("piece"), "n", loss)
    kept = ranked.orderBy(F.desc("loss"), "piece").limit(max(0, size - pieces.chars)).select("piece", "n")
    return Pieces.of(pieces.counts.where(F.length("piece") == 1).unionByName(kept))


def initial_pieces(words: DataFrame, coverage: float = 1.0, seed_size: int | None = None) -> Pieces:
    """Covered characters and all repeated substrings of them, by frequency."""
    chars = covered_alphabet(words, coverage).select(F.col("ch").alias("piece"), F.col("freq").alias("n"))
    seeds = seed_pieces(words, seed_size).select("piece", F.col("freq").alias("n"))
    if coverage < 1:
        # A seed with an uncovered character could never be read as known text.
        letters = seeds.select("piece", F.explode(F.array_distinct(F.split("piece", ""))).alias("ch"))
        bad = letters.join(F.broadcast(chars.select(F.col("piece").alias("ch"))), "ch", "left_anti")
        seeds = seeds.join(bad.select("piece").distinct(), "piece", "left_anti")
    return Pieces.of(chars.unionByName(seeds))


def _numbered(pieces: Pieces, closed: bool) -> tuple[Tree, np.ndarray] | None:
    """The tree and the counts of the pieces and their substrings; None when they are too many for vectors."""
    if pieces.size > VECTOR_PIECES:
        return None
    nodes = pieces.counts
    if not closed:
        parts = _spans(nodes.selectExpr("piece AS word", "1 AS freq")).select("piece").distinct()
        nodes = materialize(parts.join(nodes, "piece", "left").select("piece", F.coalesce("n", F.lit(0.0)).alias("n")), "nodes")
        if not holds_at_most(nodes, VECTOR_PIECES):
            return None
    last = F.ascii(F.substring("piece", -1, 1))  # its code point
    rows = nodes.orderBy("piece").select(F.length("piece").cast("byte"), last, "n").toArrow()
    lengths, codes, n = (c.to_numpy() for c in rows.columns)
    return Tree.of(lengths, codes), n


def _fitted_by_vectors(words: DataFrame, tree: Tree, counts: np.ndarray, size: int) -> list[tuple[str, float]]:
    """All that is left of fitting, over lattices on shelves."""
    tasks = max(task_count(words.sparkSession), words.count() // TASK_WORDS)
    words = words.repartition(tasks, "word").sortWithinPartitions("word")

    def thin(shelves: DataFrame, alive: np.ndarray) -> DataFrame:
        made = materialize(thinned(shelves, alive), "lattices")
        discard(shelves)
        return made

    shelve = lambda tree, alive: materialize(shelved(words, tree.levels, alive), "lattices")
    return fitted(shelve, thin, tree, counts, size, SUB_ITERATIONS, SHRINK, MIN_EXPECTED, UNKNOWN_PENALTY)


def learn_unigram(
    words: DataFrame, size: int, coverage: float = 1.0, seed_size: int | None = None
) -> list[tuple[str, float]]:
    """``size`` pieces with log-probabilities, best first; all covered characters are among them.

    Fitting starts from all repeated substrings (``seed_size`` of them, if given), drops a
    quarter of the pieces between two fits, and ends in written tables, so a lost executor
    costs one step. Once the pieces are ``VECTOR_PIECES`` at most, the driver keeps one count of
    each and lattices are walked by vectors (``lattices.py``); until then all stays in tables.
    """
    words = words.repartition(task_count(words.sparkSession), "word")
    words = materialize(words.select("word", "freq"), "words")
    pieces = initial_pieces(words, coverage, seed_size)
    if pieces.chars > size:
        raise ValueError(f"{size} pieces cannot hold {pieces.chars} characters")
    # All repeated substrings have their own substrings among them.
    numbered, arcs = _numbered(pieces, closed=seed_size is None), None
    while numbered is None:
        arcs = materialize(lattice_arcs(words, pieces.counts), "arcs") if arcs is None else arcs
        for _ in range(SUB_ITERATIONS):
            pieces = _fitted(words, arcs, pieces)
        if pieces.size <= size:
            found = [(r["piece"], r["score"]) for r in pieces.scores.collect()]
            break
        pieces = _pruned(pieces, max(size, int(pieces.size * SHRINK)))
        # What is gone from the pieces is gone from the lattices.
        stay = F.broadcast(pieces.counts.select("piece")) if pieces.few else pieces.counts.select("piece")
        long = arcs.where("end - start > 1").join(stay, "piece", "left_semi").select(*arcs.columns)
        arcs = materialize(long.unionByName(arcs.where("end - start = 1")), "arcs")
        numbered = _numbered(pieces, closed=False)
    else:
        found = _fitted_by_vectors(words, *numbered, size)
    return sorted(found, key=lambda e: (-e[1], e[0]))


@dataclass(frozen=True)
class UnigramTokenizer:
    """Piece scores and ids; both are as small as the vocabulary."""

    scores: dict[str, float]
    ids: dict[str, int]

    @staticmethod
    def of(pieces: list[tuple[str, float]], first_id: int) -> "UnigramTokenizer":
        return UnigramTokenizer(dict(pieces), {p: first_id + i for i, (p, _) in enumerate(pieces)})

    def segmenter(self):
        """Function from a marked word to the ids of its most probable segmentation."""
        unknown = _unknown_score(self.scores)

        def segment(word: str) -> array:
            out = array("i")
            for piece in best_pieces(word, self.scores, unknown)[0]:
                known = self.ids.get(piece)
                if known is None:
                    out.extend(FIRST_BYTE_ID + b for b in piece.encode("utf-8"))
                else:
                    out.append(known)
            return out

        return segment
