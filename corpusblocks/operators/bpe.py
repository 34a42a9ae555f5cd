"""Byte-pair vocabulary learning on the table of distinct words.

All counting runs on distinct words weighted by frequency. ``symbol_table`` shows a word as
a string in which every symbol stands between two spaces (`` ▁  t  h  e ``).

Learning keeps a standing count of the pairs, and the words on shelves: rows of a table that
hold the symbols of some thousand words as one run of numbers, so that a task compares and
merges them by vectors. A merge changes the words that hold its pair only; what they lose
and gain is added to the standing count. Nothing else is counted again.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusblocks.functions import text as tx
from corpusblocks.functions.ids import BOS_ID, EOS_ID, FIRST_BYTE_ID, PAD_ID, UNK_ID
from corpusblocks.session import materialize, task_count

# Names of the reserved tokens and the form of a byte piece.
RESERVED = {"PAD": PAD_ID, "UNK": UNK_ID, "BOS": BOS_ID, "EOS": EOS_ID}
BYTE_PIECE = "<0x%02X>"
N_BYTES = 256
FIRST_LEARNED_ID = FIRST_BYTE_ID + N_BYTES

# Pairs of which the driver keeps the counts; the others are known to be rarer.
TOP_PAIRS = 50_000
# Merges foreseen in a round, and merges replayed on the fly before the words are written again.
MERGES_PER_ROUND = 64
MERGES_PER_CUT = 64
# Words of a shelf.
SHELF_ROWS = 10_000

# A character is its code point, a string made by merging one of the numbers from here on;
# two of either kind fit 64 bits. Negative numbers take part in no pair.
_FIRST_MADE = 0x110000
_HALF = 31
_WORD_END, _UNCOVERED = -1, -2


def special_tokens(names: str = "[PAD],[BOS],[EOS],[UNK]") -> dict[str, str]:
    """Check the reserved tokens of a comma-separated list and name their pieces.

    Brackets are optional, order is free and repeats are harmless; any other set
    of names is refused.
    """
    given = {part.strip().strip("[]") for part in names.split(",")} - {""}
    if given != set(RESERVED):
        raise ValueError(f"the reserved names are {sorted(RESERVED)}; this list names {sorted(given)}")
    return {name: f"[{name}]" for name in RESERVED}


def word_counts(lines: DataFrame, line: str = "line") -> DataFrame:
    """``(word, freq)`` over marked words; counted map-side, so hot words are cheap."""
    return (
        lines.select(F.explode(tx.words(F.col(line))).alias("w")).where(F.col("w") != "")
        .groupBy("w").agg(F.count("*").alias("freq"))
        .select(F.concat(F.lit(tx.WORD_MARK), "w").alias("word"), "freq")
    )


def character_counts(words: DataFrame) -> DataFrame:
    """``(ch, freq)`` over all words, from the distinct-word table."""
    return (
        words.select(F.explode(tx.characters(F.col("word"))).alias("ch"), "freq")
        .groupBy("ch").agg(F.sum("freq").alias("freq"))
    )


def covered_alphabet(words: DataFrame, coverage: float = 1.0) -> DataFrame:
    """``(ch, freq, position)``: the most frequent characters reaching ``coverage``.

    The shortest prefix of the ranking whose share of all characters is at least
    ``coverage``. The ranking window runs over one row per distinct character,
    which Unicode bounds at about 1.1 million however large the corpus is.
    """
    chars = character_counts(words)
    rank = W.orderBy(F.desc("freq"), F.asc("ch"))
    whole = W.partitionBy()
    ranked = chars.select(
        "ch", "freq",
        (F.row_number().over(rank) - 1).alias("position"),
        F.sum("freq").over(rank.rowsBetween(W.unboundedPreceding, -1)).alias("_before"),
        F.sum("freq").over(whole).alias("_all"),
    )
    kept = F.coalesce("_before", F.lit(0)) < F.lit(float(coverage)) * F.col("_all")
    return ranked.where(kept).select("ch", "freq", "position")


def _symbols_of(word: Column, uncovered: list[str] | None) -> Column:
    # An uncovered character becomes an empty symbol: it takes part in no pair.
    chars = tx.characters(word)
    if uncovered is not None:
        chars = F.transform(chars, lambda c: F.when(c.isin(uncovered), "").otherwise(c))
    return F.array_join(F.transform(chars, lambda c: F.concat(F.lit(" "), c, F.lit(" "))), "")


def symbol_table(words: DataFrame, uncovered: list[str] | None = None) -> DataFrame:
    """``(symbols, freq)``: words as delimited character sequences."""
    return words.select(_symbols_of(F.col("word"), uncovered).alias("symbols"), "freq")


def pair_counts(symbols: DataFrame) -> DataFrame:
    """``(left, right, freq)``: how often two symbols are neighbours, weighted."""
    inner = F.col("symbols").substr(F.lit(2), F.length("symbols") - 2)
    # Splitting at a single character needs no regular expression.
    parts = F.split(F.replace(inner, F.lit("  "), F.lit(" ")), " ")
    split = symbols.select(parts.alias("s"), "freq")
    neighbours = F.arrays_zip(
        F.slice("s", F.lit(1), F.size("s") - 1), F.slice("s", F.lit(2), F.size("s") - 1)
    )
    pairs = split.select(F.inline(neighbours), "freq").toDF("left", "right", "freq")
    return (
        pairs.where((F.col("left") != "") & (F.col("right") != ""))
        .groupBy("left", "right").agg(F.sum("freq").alias("freq"))
    )


def independent_batch(
    ranked: list[tuple[str, str, int]], built: set[str], limit: int, complete: bool
) -> list[tuple[str, str, int]]:
    """The merges that one-at-a-time learning would do next, as far as one count shows.

    ``ranked`` are the best pairs by (freq desc, left, right); ``complete`` says
    that no pair is missing below them. Pairs of equal frequency are taken
    together, and only while no symbol stands left in one taken pair and right in
    another and no pair spells a string that exists or is being built. Then two
    taken pairs never compete for a symbol, so no merge changes the count of
    another; and a pair new after merging (a, b) is at most as frequent as some
    (x, a) or (b, y), which cannot be among the taken, so it ranks below them
    all. When the first group already fails, its best pair alone is certain.
    """
    groups: dict[int, list[tuple[str, str, int]]] = {}
    for pair in ranked:
        groups.setdefault(pair[2], []).append(pair)
    levels = list(groups.values())
    if not complete:
        levels.pop()  # the end of the ranking may cut this group
    taken: list[tuple[str, str, int]] = []
    lefts: set[str] = set()
    rights: set[str] = set()
    spelled: set[str] = set(built)
    for level in levels:
        lefts |= {left for left, _, _ in level}
        rights |= {right for _, right, _ in level}
        strings = {left + right for left, right, _ in level}
        if lefts & rights or len(strings) < len(level) or spelled & strings:
            break
        taken += level
        spelled |= strings
    return (taken or ranked[:1])[:limit]


class StandingCounts:
    """Counts of the most frequent pairs; every pair left out has at most ``floor``.

    Counts of pairs only fall, but for pairs of a symbol just made, whose counts arrive
    whole. So a pair left out stays below the floor, and the best pair is known as
    long as its count is above. What is kept is bounded by ``TOP_PAIRS`` and by what
    merges add, whatever the corpus.
    """

    def __init__(self, ranked: list[tuple[str, str, int]], limit: int):
        self.floor = ranked[limit][2] if len(ranked) > limit else 0
        self.counts = {(left, right): freq for left, right, freq in ranked[:limit]}
        self.heap = [(-freq, pair) for pair, freq in self.counts.items()]
        heapq.heapify(self.heap)
        self.fresh = True

    def best(self) -> tuple[str, str] | None:
        """The pair to merge next; None when the counts kept cannot tell."""
        while self.heap and self.counts.get(self.heap[0][1]) != -self.heap[0][0]:
            heapq.heappop(self.heap)
        if not self.heap or not (self.fresh or -self.heap[0][0] > self.floor):
            return None
        return self.heap[0][1]

    def add(self, changes: dict[tuple[str, str], int]) -> None:
        self.fresh = False
        for pair, change in changes.items():
            freq = self.counts.get(pair, 0) + change
            if pair in self.counts and freq <= 0:
                del self.counts[pair]
            elif pair in self.counts or freq > self.floor:
                self.counts[pair] = freq
                heapq.heappush(self.heap, (-freq, pair))

    def foresee(self, steps: int, window: int = 400) -> list[tuple[str, str]]:
        """The merges that probably come next, the first of them certainly.

        Pairs that share a symbol with a merge are taken to follow it in proportion.
        A wrong guess costs the steps behind it, nothing else.
        """
        seen: dict[str, float] = defaultdict(float)
        ends: dict[str, float] = defaultdict(float)
        for (left, right), freq in self.counts.items():
            seen[left] += freq
            ends[right] += freq
        total = {x: max(seen[x], ends[x], 1.0) for x in seen.keys() | ends.keys()}
        likely = dict(heapq.nsmallest(window, self.counts.items(), key=lambda e: (-e[1], e[0])))
        found: list[tuple[str, str]] = []
        while likely and len(found) < steps:
            a, b = pair = min(likely, key=lambda p: (-likely[p], p))
            freq = likely.pop(pair)
            found.append(pair)
            made = a + b
            for (x, y), n in list(likely.items()):
                if y == a:
                    likely[x, y], likely[x, made] = n * (1 - freq / total[a]), n * freq / total[a]
                elif x == b:
                    likely[x, y], likely[made, y] = n * (1 - freq / total[b]), n * freq / total[b]
            total[made] = max(freq, 1.0)
            total[a], total[b] = max(total[a] - freq, freq, 1.0), max(total[b] - freq, freq, 1.0)
        return found


class _Names:
    """Numbers of symbols, and the strings that they stand for."""

    def __init__(self):
        self.made: list[str] = []
        self.numbers: dict[str, int] = {}

    def number(self, symbol: str) -> int:
        if len(symbol) == 1:
            return ord(symbol)
        if symbol not in self.numbers:
            self.numbers[symbol] = _FIRST_MADE + len(self.made)
            self.made.append(symbol)
        return self.numbers[symbol]

    def steps(self, merges: list[tuple[str, str]]) -> list[tuple[int, int, int]]:
        return [(self.number(left), self.number(right), self.number(left + right)) for left, right in merges]


def _named(made: list[str], number: int) -> str:
    return chr(number) if number < _FIRST_MADE else made[number - _FIRST_MADE]


def _shelves(words: DataFrame, uncovered: list[str] | None) -> DataFrame:
    """``(symbols, freqs)``: words in runs of ``SHELF_ROWS``, a word's characters followed by an end mark."""
    size = SHELF_ROWS
    outside = np.array(sorted(map(ord, uncovered or [])), np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                part = batch.slice(start, size)
                # Words hold no spaces, so a space can stand for the end.
                text = "".join(f"{word} " for word in part.column(0).to_pylist())
                symbols = np.frombuffer(text.encode("utf-32-le"), np.int32).copy()
                ends = symbols == 32
                if len(outside):
                    symbols[np.isin(symbols, outside)] = _UNCOVERED
                symbols[ends] = _WORD_END
                freqs = np.array(part.column(1).to_pylist(), np.int64)
                yield _shelf(*_with_pairs(symbols, freqs))

    return words.mapInArrow(run, "symbols binary, freqs binary")


def _shelf(symbols: np.ndarray, freqs: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([symbols.tobytes()], pa.binary()), pa.array([freqs.tobytes()], pa.binary())], names=["symbols", "freqs"]
    )


def _read(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for symbols, freqs in zip(batch.column(0), batch.column(1)):
        yield np.frombuffer(symbols.as_buffer(), np.int32), np.frombuffer(freqs.as_buffer(), np.int64)


def _words_with(at: np.ndarray, symbols: np.ndarray, freqs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of a shelf that have one of the places ``at``."""
    ends = symbols == _WORD_END
    word = np.cumsum(ends) - ends
    kept = np.zeros(len(freqs), bool)
    kept[word[at]] = True
    return symbols[kept[word]], freqs[kept]


def _with_pairs(symbols: np.ndarray, freqs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of a shelf in which two symbols are neighbours."""
    return _words_with(np.flatnonzero((symbols[:-1] >= 0) & (symbols[1:] >= 0)), symbols, freqs)


def _pair_finder(steps: list[tuple[int, int, int]]) -> Callable[[np.ndarray], np.ndarray]:
    """Function that finds the places of a shelf where a pair of some step stands."""
    pairs = np.unique(np.array([(a << _HALF) | b for a, b, _ in steps], np.int64))
    # Negative numbers look at the end, where nothing is set.
    left, right = (np.zeros(max(max(step) for step in steps) + 3, bool) for _ in range(2))
    left[[a for a, _, _ in steps]] = True
    right[[b for _, b, _ in steps]] = True

    def find(symbols: np.ndarray) -> np.ndarray:
        top = len(left) - 1
        small = np.minimum(symbols, top)
        at = np.flatnonzero(left[small[:-1]] & right[small[1:]])
        code = (symbols[at].astype(np.int64) << _HALF) | symbols[at + 1]
        return at[pairs[np.minimum(np.searchsorted(pairs, code), len(pairs) - 1)] == code]

    return find


def _places(symbols: np.ndarray, left: int, right: int) -> np.ndarray:
    """Where a merge applies: left to right, without overlaps."""
    at = np.flatnonzero(symbols[:-1] == left)
    at = at[symbols[at + 1] == right]
    if left == right and len(at) > 1:
        run = np.concatenate([[0], np.cumsum(np.diff(at) != 1)])
        first = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1])
        at = at[(at - at[first][run]) % 2 == 0]
    return at


def _merged(symbols: np.ndarray, of: np.ndarray, at: np.ndarray, made: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols after a merge, and ``of`` (what belongs to each of them) likewise."""
    symbols = symbols.copy()
    symbols[at] = made
    kept = np.ones(len(symbols), bool)
    kept[at + 1] = False
    return symbols[kept], of[kept]


def _replayed(symbols: np.ndarray, of: np.ndarray, steps: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    for left, right, made in steps:
        at = _places(symbols, left, right)
        if len(at):
            symbols, of = _merged(symbols, of, at, made)
    return symbols, of


def _freq_of(symbols: np.ndarray, freqs: np.ndarray) -> np.ndarray:
    """The frequency of its word, for every symbol."""
    ends = symbols == _WORD_END
    return freqs[np.cumsum(ends) - ends]


def _pairs_at(symbols: np.ndarray, freq: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the pairs that start ``at`` some places, and their frequencies."""
    at = at[(symbols[at] >= 0) & (symbols[at + 1] >= 0)]
    return (symbols[at].astype(np.int64) << _HALF) | symbols[at + 1], freq[at]


def _around(at: np.ndarray, to: int, n: int) -> np.ndarray:
    """Places from one before ``at`` to ``to`` behind that can start a pair, each once."""
    near = np.unique(np.concatenate([at + k for k in range(-1, to + 1)]))
    return near[(near >= 0) & (near < n - 1)]


def _summed(codes: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and the sums of their values."""
    code, value = np.concatenate(codes), np.concatenate(values)
    order = np.argsort(code, kind="stable")
    code, value = code[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))[: len(code)]
    return code[first], np.add.reduceat(value, first) if len(first) else value


def _ranked_pairs(shelves: DataFrame, pending: list[tuple[int, int, int]], made: list[str], limit: int) -> list[tuple]:
    """The best pairs after the pending merges, as ``(left, right, freq)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, values = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for symbols, freqs in _read(batch):
                symbols, freq = _replayed(symbols, _freq_of(symbols, freqs), pending)
                code, value = _summed(*([x] for x in _pairs_at(symbols, freq, np.arange(max(0, len(symbols) - 1)))))
                codes.append(code)
                values.append(value)
            code, value = _summed(codes, values)
            sides = ([_named(made, n) for n in side.tolist()] for side in (code >> _HALF, code & (1 << _HALF) - 1))
            yield pa.RecordBatch.from_arrays([*(pa.array(side, pa.string()) for side in sides), pa.array(value)], names=["left", "right", "freq"])

    counted = shelves.mapInArrow(run, "left string, right string, freq long").groupBy("left", "right").agg(F.sum("freq").alias("freq"))
    return [tuple(r) for r in counted.orderBy(F.desc("freq"), "left", "right").limit(limit).collect()]


def _changes(
    shelves: DataFrame, pending: list[tuple[int, int, int]], plan: list[tuple[int, int, int]], made: list[str]
) -> list[dict[tuple[str, str], int]]:
    """By step of the plan, what every pair gains or loses.

    A word that any step changes holds the pair of some step already before the first; the
    others are left aside.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, find_planned = _pair_finder(pending + plan), _pair_finder(plan)
        for batch in batches:
            codes = [[np.empty(0, np.int64)] for _ in plan]
            values = [[np.empty(0, np.int64)] for _ in plan]
            for symbols, freqs in _read(batch):
                symbols, freqs = _words_with(find(symbols), symbols, freqs)
                symbols, _ = _replayed(symbols, symbols, pending)
                symbols, freqs = _words_with(find_planned(symbols), symbols, freqs)
                freq = _freq_of(symbols, freqs)
                for step, (left, right, new) in enumerate(plan):
                    at = _places(symbols, left, right)
                    if not len(at):
                        continue
                    code, value = _pairs_at(symbols, freq, _around(at, 1, len(symbols)))
                    symbols, freq = _merged(symbols, freq, at, new)
                    after, gained = _pairs_at(symbols, freq, _around(at - np.arange(len(at)), 0, len(symbols)))
                    code, value = _summed([code, after], [-value, gained])
                    codes[step].append(code)
                    values[step].append(value)
            for step in range(len(plan)):
                code, value = _summed(codes[step], values[step])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(code), step, np.int32)), pa.array((code >> _HALF).astype(np.int32)),
                    pa.array((code & (1 << _HALF) - 1).astype(np.int32)), pa.array(value),
                ], names=["step", "left", "right", "n"])

    changed = shelves.mapInArrow(run, "step int, left int, right int, n long")
    rows = changed.groupBy("step", "left", "right").agg(F.sum("n").alias("n")).where("n <> 0").collect()
    changes: list[dict[tuple[str, str], int]] = [{} for _ in plan]
    for step, left, right, n in rows:
        changes[step][_named(made, left), _named(made, right)] = n
    return changes


def _rewritten(shelves: DataFrame, pending: list[tuple[int, int, int]]) -> DataFrame:
    """The shelves after the pending merges, without the words that have become a single symbol."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for symbols, freqs in _read(batch):
                symbols, _ = _replayed(symbols, symbols, pending)
                yield _shelf(*_with_pairs(symbols, freqs))

    return materialize(shelves.mapInArrow(run, shelves.schema), "shelves")


def learn_merges(
    words: DataFrame,
    count: int | None = None,
    uncovered: list[str] | None = None,
    top_pairs: int = TOP_PAIRS,
    pieces: int | None = None,
) -> list[tuple[str, str, int]]:
    """The first merges as ``(left, right, freq)``: ``count`` of them, or as many as make ``pieces`` new strings.

    Fewer, if pairs run out. The best pair by (frequency descending, left, right) is merged
    each time. A round is one Spark job over the shelves: it says step by step how the
    merges foreseen change the counts, and the driver takes the steps as long as each was
    the best one at its turn. The shelves are written again after some merges, without the
    words that have become a single symbol, which bounds the replaying and what a lost
    executor costs.
    """
    spark = words.sparkSession
    spaced = words.select("word", F.col("freq").cast("long").alias("freq")).repartition(task_count(spark), "word")
    shelves = materialize(_shelves(spaced, uncovered), "shelves")
    names = _Names()
    merges: list[tuple[str, str, int]] = []
    built: set[str] = set()
    pending: list[tuple[str, str]] = []

    def wanted() -> bool:
        return (count is None or len(merges) < count) and (pieces is None or len(built) < pieces)

    standing, ahead = None, 4
    while wanted():
        if standing is None:
            ranked = _ranked_pairs(shelves, names.steps(pending), names.made, top_pairs + 1)
            if not ranked:
                break
            standing = StandingCounts(ranked, top_pairs)
        if standing.best() is None:
            if not standing.floor:
                break
            standing = None
            continue
        plan = standing.foresee(ahead)
        done = len(merges)
        for pair, change in zip(plan, _changes(shelves, names.steps(pending), names.steps(plan), names.made)):
            if not wanted() or standing.best() != pair:
                break
            merges.append((*pair, standing.counts[pair]))
            pending.append(pair)
            standing.add(change)
            made = "".join(pair)
            if made in built or len(made) == 1:
                # The string existed before, so pairs left out may have gained.
                standing = None
                break
            built.add(made)
        # As many steps as pay: twice what the last round could take.
        ahead = min(MERGES_PER_ROUND, 2 * (len(merges) - done))
        if len(pending) >= MERGES_PER_CUT:
            shelves = _rewritten(shelves, names.steps(pending))
            pending = []
    return merges


def merges_table(spark: SparkSession, merges: list[tuple[str, str, int]]) -> DataFrame:
    """``(rank, left, right, freq)``."""
    left, right, freq = ([m[i] for m in merges] for i in range(3))
    return spark.createDataFrame(pa.table({
        "rank": pa.array(range(len(merges)), pa.int32()), "left": pa.array(left, pa.string()),
        "right": pa.array(right, pa.string()), "freq": pa.array(freq, pa.int64()),
    }))


def merged_pieces(merges: list[tuple[str, str, int]]) -> list[tuple[str, int]]:
    """Distinct strings built by a merge list, in order of first appearance."""
    pieces: dict[str, int] = {}
    for left, right, freq in merges:
        pieces.setdefault(left + right, freq)
    return list(pieces.items())


def vocabulary(
    spark: SparkSession,
    alphabet: list[tuple[str, int]],
    merges: list[tuple[str, str, int]] = (),
    specials: dict[str, str] | None = None,
) -> DataFrame:
    """``(token_id, piece, kind, freq)``.

    Ids: reserved tokens, then the 256 byte pieces, then merges by rank, then
    the alphabet by falling frequency. ``alphabet`` and ``merges`` are as small
    as the vocabulary, so the table is built on the driver.
    """
    learned = [
        *((piece, "merge", freq) for piece, freq in merged_pieces(list(merges))),
        *((ch, "char", freq) for ch, freq in alphabet),
    ]
    return vocabulary_table(spark, learned, specials)


def vocabulary_table(
    spark: SparkSession, learned: list[tuple[str, str, int]], specials: dict[str, str] | None = None
) -> DataFrame:
    """Vocabulary of reserved tokens, byte pieces and ``(piece, kind, freq)`` entries in id order."""
    specials = specials or special_tokens()
    entries = [
        *((specials[name], "special", 0) for name in sorted(RESERVED, key=RESERVED.get)),
        *((BYTE_PIECE % b, "byte", 0) for b in range(N_BYTES)),
        *learned,
    ]
    piece, kind, freq = zip(*entries)
    return spark.createDataFrame(pa.table({
        "token_id": pa.array(range(len(entries)), pa.int32()),
        "piece": pa.array(piece), "kind": pa.array(kind), "freq": pa.array(freq, pa.int64()),
    }))
