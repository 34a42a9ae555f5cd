"""Unigram fitting by vectors: pieces as numbers, lattices of words on shelves.

While numbers of all pieces fit one place, a piece is its position in the order of strings.
Substrings of pieces are pieces too, so what is known of a piece is its length, its last
character, the piece without that (its parent) and the piece without its first character
(its link); no string leaves its table. Lattices are written once, some thousand words to a
row, and walked in tasks for all words of a row at once: only the scores go to the tasks, and
only expected counts come back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_SHELF = "lengths binary, freqs binary, counts binary, sizes binary, ids binary"
_TYPES = (np.int32, np.float64, np.uint8, np.uint8, np.int32)
#: Bits of a code point.
_CODE = 21
#: Partial sums that come to the driver as they are.
DIRECT_ROWS = 1_000_000


def _found(level: tuple[np.ndarray, np.ndarray], parent: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Pieces of one length by parent and last character; -1 for none."""
    keys, ids = level
    if not len(keys):
        return np.full(len(parent), -1, np.int32)
    wanted = (parent.astype(np.int64) + 1 << _CODE) | code
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, ids[at], np.int32(-1))


@dataclass(frozen=True)
class Tree:
    """Pieces by number. ``levels`` has, by length, sorted keys of parent and last character, and the pieces."""

    lengths: np.ndarray
    codes: np.ndarray
    parents: np.ndarray
    links: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def of(lengths: np.ndarray, codes: np.ndarray) -> "Tree":
        """The tree of pieces in the order of strings, among which are all their substrings."""
        parents, links = np.full((2, len(lengths)), -1, np.int32)
        levels: list[tuple[np.ndarray, np.ndarray]] = []
        for length in range(1, int(lengths.max(initial=0)) + 1):
            ids = np.flatnonzero(lengths == length).astype(np.int32)
            if levels:
                above = levels[-1][1]
                parents[ids] = above[np.searchsorted(above, ids) - 1]
                links[ids] = _found(levels[-1], links[parents[ids]], codes[ids])
            levels.append(((parents[ids].astype(np.int64) + 1 << _CODE) | codes[ids], ids))
        return Tree(lengths, codes, parents, links, levels)

    def piece(self, number: int) -> str:
        chars = []
        while number >= 0:
            chars.append(chr(self.codes[number]))
            number = int(self.parents[number])
        return "".join(reversed(chars))

    def best_without(self, scores: np.ndarray) -> np.ndarray:
        """Score of the best segmentation of every piece with a score without the piece itself.

        The best segmentation ends in a suffix, and what is left of it is a prefix, a piece of the tree.
        """
        wanted = scores > -np.inf
        for _, ids in reversed(self.levels[1:]):
            wanted[self.parents[ids[wanted[ids]]]] = True
        best, whole = np.full(len(scores), -np.inf), scores.copy()
        for _, ids in self.levels[1:]:
            ids = ids[wanted[ids]]
            suffixes, found = [self.links[ids]], np.full(len(ids), -np.inf)
            while len(ids) and self.links[suffixes[-1][0]] >= 0:
                suffixes.append(self.links[suffixes[-1]])
            prefix = self.parents[ids]
            for suffix in reversed(suffixes):
                np.maximum(found, whole[prefix] + scores[suffix], out=found)
                prefix = self.parents[prefix]
            best[ids] = found
            whole[ids] = np.maximum(scores[ids], found)
        return best


def _row(arrays: list[np.ndarray]) -> pa.RecordBatch:
    blobs = [pa.array([a.astype(t, copy=False).tobytes()], pa.binary()) for a, t in zip(arrays, _TYPES)]
    return pa.RecordBatch.from_arrays(blobs, names=[field.split()[0] for field in _SHELF.split(", ")])


def _rows(batch: pa.RecordBatch) -> Iterator[list[np.ndarray]]:
    for k in range(batch.num_rows):
        yield [np.frombuffer(batch.column(c)[k].as_buffer(), t) for c, t in enumerate(_TYPES)]


def shelved(words: DataFrame, levels: list[tuple[np.ndarray, np.ndarray]], alive: np.ndarray) -> DataFrame:
    """One row for each batch of ``words(word, freq)``: their lengths and frequencies, and their arcs.

    ``counts`` says how many arcs start at a character; an arc is its size and its piece, -1 for an unknown character.
    """
    sent = words.sparkSession.sparkContext.broadcast((levels, alive))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, alive = sent.value
        for batch in batches:
            listed = [w or "" for w in batch.column(0).to_pylist()]
            codes = np.frombuffer("".join(listed).encode("utf-32-le"), "<u4").astype(np.int64)
            lengths = np.array([len(w) for w in listed], np.int32)
            ends = np.repeat(np.cumsum(lengths), lengths)
            at, node = np.arange(len(codes), dtype=np.int32), np.full(len(codes), -1, np.int32)
            starts, sizes, ids = [], [], []
            for size, level in enumerate(levels or [(np.empty(0, np.int64),) * 2], 1):
                inside = at + size <= ends[at]
                at, node = at[inside], node[inside]
                node = _found(level, node, codes[at + size - 1])
                kept = np.ones(len(at), bool) if size == 1 else (node >= 0) & alive[node]
                starts.append(at[kept])
                ids.append(node[kept])
                sizes.append(np.full(len(starts[-1]), size, np.uint8))
                at, node = at[node >= 0], node[node >= 0]
            order = np.argsort(np.concatenate(starts), kind="stable")
            counts = np.bincount(np.concatenate(starts), minlength=len(codes))
            freqs = batch.column(1).to_numpy(zero_copy_only=False)
            yield _row([lengths, freqs, counts, np.concatenate(sizes)[order], np.concatenate(ids)[order]])

    return words.select("word", "freq").mapInArrow(run, _SHELF)


def thinned(shelves: DataFrame, alive: np.ndarray) -> DataFrame:
    """The shelves without the arcs of pieces that are gone; characters stay."""
    sent = shelves.sparkSession.sparkContext.broadcast(alive)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lengths, freqs, counts, sizes, ids in _rows(batch):
                kept = (sizes == 1) | sent.value[ids]
                of = np.repeat(np.arange(len(counts)), counts)[kept]
                yield _row([lengths, freqs, np.bincount(of, minlength=len(counts)), sizes[kept], ids[kept]])

    return shelves.mapInArrow(run, shelves.schema)


def _log_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Logarithm of the sum of the exponentials of each run of values that starts at ``first``."""
    top = np.maximum.reduceat(values, first)
    sizes = np.diff(first, append=len(values))
    return top + np.log(np.add.reduceat(np.exp(values - np.repeat(top, sizes)), first))


def _walk(at: np.ndarray, near: np.ndarray, far: np.ndarray, score: np.ndarray, sums: np.ndarray, ahead: bool) -> None:
    """Fill ``sums`` of the places ``far`` from those of the places ``near``, all arcs ``at`` one position at a time."""
    small = at.astype(np.uint16) if at.max(initial=0) < 2**16 else at  # sorted by digits
    order = np.argsort(small, kind="stable")
    near, far, score = near[order], far[order], score[order]
    ends = np.cumsum(np.bincount(at))
    positions = range(len(ends)) if ahead else range(len(ends) - 1, -1, -1)
    for k in positions:
        part = slice(ends[k - 1] if k else 0, ends[k])
        to = far[part]
        if len(to):
            first = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            sums[to[first]] = _log_sums(sums[near[part]] + score[part], first)


def _expect(row: list[np.ndarray], scores: np.ndarray, into: np.ndarray) -> None:
    """Add the expected counts of the pieces in the words of a shelf; the last score is that of unknown characters."""
    lengths, freqs, counts, sizes, ids = row
    word = np.repeat(np.arange(len(lengths)), lengths)
    position = np.arange(len(counts)) - (np.cumsum(lengths) - lengths)[word]
    start = np.repeat(np.arange(len(counts)), counts)
    # A word has one place more than characters.
    low, word = start + word[start], word[start]
    high, position, score = low + sizes, position[start], scores[ids]
    ends = np.cumsum(lengths + 1) - 1
    forward, backward = np.full((2, int(np.sum(lengths + 1))), -np.inf)
    forward[ends - lengths] = 0
    backward[ends] = 0
    _walk(position + sizes, low, high, score, forward, True)
    _walk(position, high, low, score, backward, False)
    shares = freqs[word] * np.exp(forward[low] + score + backward[high] - forward[ends[word]])
    known = ids >= 0
    np.add.at(into, ids[known], shares[known])


def expected(shelves: DataFrame, scores: np.ndarray, unknown: float, tasks: int) -> np.ndarray:
    """Expected count of every piece over all segmentations of all words on the shelves, which ``tasks`` tasks read."""
    sent = shelves.sparkSession.sparkContext.broadcast(np.append(scores, unknown))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(sent.value) - 1)
        for batch in batches:
            for row in _rows(batch):
                _expect(row, sent.value, found)
        ids = np.flatnonzero(found)
        for at in range(0, len(ids), 2**20):
            part = ids[at: at + 2**20]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(found[part])], names=["id", "n"])

    sums = shelves.mapInArrow(run, "id int, n double")
    if np.count_nonzero(scores > -np.inf) * tasks > DIRECT_ROWS:
        sums = sums.groupBy("id").agg({"n": "sum"})
    made = sums.toArrow()
    sent.destroy()
    return np.bincount(made.column(0).to_numpy(), made.column(1).to_numpy(), len(scores))


def fitted(
    shelve: Callable[[Tree, np.ndarray], DataFrame], thin: Callable[[DataFrame, np.ndarray], DataFrame],
    tree: Tree, counts: np.ndarray, size: int, steps: int, shrink: float, least: float, penalty: float,
) -> list[tuple[str, float]]:
    """Pieces and scores after expectation, maximisation and pruning down to ``size`` pieces.

    ``counts`` are 0 for what is in the tree but no piece. ``shelve`` writes the lattices once the first
    scores are known, ``thin`` writes them again whenever half of the pieces have gone.
    """
    n, single = counts, tree.lengths == 1

    def scored() -> tuple[np.ndarray, float]:
        alive = n > 0
        total, low = (n.sum(), n[alive].min()) if alive.any() else (1.0, 1.0)
        with np.errstate(divide="ignore"):
            return np.log(n) - np.log(total), np.log(low) - np.log(total) - penalty

    shelves = shelve(tree, n > 0)
    stored, tasks = np.count_nonzero(n), shelves.rdd.getNumPartitions()
    while True:
        for _ in range(steps):
            found = np.round(expected(shelves, *scored(), tasks), 6)
            n = np.where((n > 0) & ((found >= least) | single), np.maximum(found, least), 0.0)
        scores, _ = scored()
        left = np.count_nonzero(n)
        if left <= size:
            break
        long = np.flatnonzero((n > 0) & ~single)
        loss = np.round(n[long] * (scores[long] - tree.best_without(scores)[long]), 6)
        target = max(size, int(left * shrink)) - np.count_nonzero(n[single])
        n[long[np.argsort(-loss, kind="stable")[max(0, target):]]] = 0.0
        if np.count_nonzero(n) * 2 <= stored:
            shelves = thin(shelves, n > 0)
            stored, tasks = np.count_nonzero(n), shelves.rdd.getNumPartitions()
    return [(tree.piece(i), float(scores[i])) for i in np.flatnonzero(n).tolist()]
