"""Language identification by cross-parsing entropy.

For every language a suffix automaton is built over a sample of its labelled text. A
text is parsed against each automaton from left to right into longest matches: a phrase
runs as long as the automaton has it and ends with the first character it has not. The
fewer phrases, the better the language explains the text. The count is normalised by
the phrases' cost, the logarithm of the automaton's text, over the number of characters;
the language with the least bits per character wins, ties going to the smaller name.

Texts are parsed in pieces of ``PIECE`` characters, all pieces of a batch side by side;
a phrase also ends where its piece does, alike for every language.

The sample is bounded: at most ``SAMPLE_DOCS`` documents per language, the ones with the
smallest hashes of their keys, and ``SAMPLE_CHARS`` characters of each from a place the
hash names. The whole texts are what is predicted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusblocks.llm.common import add_columns, fold_of, held, packed, table, whole_text

#: Bounds of what is learned from, per language.
SAMPLE_DOCS = 128
SAMPLE_CHARS = 320
PIECE = 512
#: Pieces parsed side by side.
LANES = 4_096
UNDETERMINED = "und"
FOLDS = 5
#: ``accepted`` rejects a document whose best language needs more bits per character: no language explains it.
MAX_BITS = 7.0

LETTER = r"\p{L}"


class SuffixAutomaton:
    """All substrings of a text of small integers; arcs ``[state, symbol] -> state`` (0: none).

    Most states have one arc, kept as its symbol and target; only the others have a row in a table.
    """

    def __init__(self, text: list[int], symbols: int):
        move: list[dict[int, int]] = [{}, {}]
        link, length, last = [0, 0], [0, 0], 1
        for c in text:
            new = len(move)
            move.append({})
            link.append(1)
            length.append(length[last] + 1)
            p, last = last, new
            while p and c not in move[p]:
                move[p][c] = new
                p = link[p]
            if p:
                q = move[p][c]
                if length[q] != length[p] + 1:
                    clone = len(move)
                    move.append(dict(move[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    link[q] = clone
                    while p and move[p].get(c) == q:
                        move[p][c] = clone
                        p = link[p]
                    q = clone
                link[new] = q
        several = [state for state, arcs in enumerate(move) if len(arcs) > 1]
        self.row = np.zeros(len(move), np.int32)  # row 0 is empty
        self.row[several] = np.arange(1, len(several) + 1)
        self.table = np.zeros((len(several) + 1, symbols), np.int32)
        self.symbol = np.full(len(move), -1, np.int32)
        self.target = np.zeros(len(move), np.int32)
        for state, arcs in enumerate(move):
            if len(arcs) == 1:
                ((self.symbol[state], self.target[state]),) = arcs.items()
            elif arcs:
                self.table[self.row[state], list(arcs)] = list(arcs.values())


class Model:
    """Automata of all languages in one table; symbol 0 is any character no sample has."""

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        self.languages = [name for name, _ in samples]
        alphabet = sorted({ord(c) for _, text in samples for c in text})
        self.codes = np.zeros(max(alphabet, default=0) + 2, np.int32)
        self.codes[alphabet] = np.arange(1, len(alphabet) + 1)
        self.symbols = len(alphabet) + 1
        parts, self.starts, base, rows = [], [], 0, 0
        for _, text in samples:
            own = SuffixAutomaton([int(self.codes[ord(c)]) for c in text], self.symbols)
            for targets in (own.table, own.target):
                targets[targets > 0] += base
            own.row += rows
            parts.append((own.row, own.symbol, own.target, own.table))
            self.starts.append(base + 1)
            base += len(own.row)
            rows += len(own.table)
        if parts:
            self.row, self.symbol, self.target, table = (np.concatenate(x) for x in zip(*parts))
            self.table = table.ravel()
        self.cost = np.log2([max(2, len(text)) for _, text in samples])

    def encode(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return self.codes[np.minimum(points, len(self.codes) - 1)]

    def parse(self, pieces: list[np.ndarray]) -> np.ndarray:
        """Phrases of every piece by every language."""
        order = sorted(range(len(pieces)), key=lambda i: -len(pieces[i]))
        lengths = np.array([len(pieces[i]) for i in order])
        steps = np.zeros((int(lengths[0]), len(pieces)), np.int32)
        for lane, i in enumerate(order):
            steps[: lengths[lane], lane] = pieces[i]
        starts = np.array(self.starts, np.int32)[:, None]
        state = np.repeat(starts, len(pieces), axis=1)
        phrases = np.zeros(state.shape, np.int64)
        active = np.searchsorted(-lengths, -np.arange(len(steps)), side="left")  # lanes longer than the step
        for step, lanes in enumerate(active):
            now = state[:, :lanes]
            code = steps[step, :lanes]
            several = self.table[self.row[now] * self.symbols + code]
            following = np.where(self.symbol[now] == code, self.target[now], several)
            ended = following == 0
            phrases[:, :lanes] += ended
            state[:, :lanes] = np.where(ended, starts, following)
        phrases += state != starts  # phrases cut off at the end of a piece
        out = np.zeros((len(pieces), len(self.languages)), np.int64)
        out[order] = phrases.T
        return out

    def bits(self, texts: list[str]) -> np.ndarray:
        """Bits per character of every text by every language."""
        pieces, owner = [], []
        total = np.zeros((len(texts), len(self.languages)))
        for i, text in enumerate(texts):
            codes = self.encode(text)
            for k in range(0, len(codes), PIECE):
                pieces.append(codes[k : k + PIECE])
                owner.append(i)
            if len(pieces) >= LANES or i == len(texts) - 1:
                for k in range(0, len(pieces), LANES):
                    np.add.at(total, owner[k : k + LANES], self.parse(pieces[k : k + LANES]))
                pieces, owner = [], []
        sizes = np.array([max(1, len(t)) for t in texts])[:, None]
        return total * self.cost / sizes


def _model(samples: tuple[tuple[str, str], ...]) -> Model:
    return held(Model, samples)


def folded(column: str = "text") -> Column:
    """Lower case, runs of white space as one blank."""
    return F.regexp_replace(F.lower(whole_text(column)), r"\s+", " ")


def samples(labelled: DataFrame, key: str = "doc_id", column: str = "text", label: str = "lang") -> DataFrame:
    """``(label, sample)`` per language, from the bounded choice the module names.

    Keys are dealt by hash into as many cells per language as documents may be chosen,
    and the smallest hash of each cell is taken: counting and choosing are partial
    before the shuffle, however many rows one language has.
    """
    rows = labelled.where(F.col(label).isNotNull() & whole_text(column).rlike(LETTER))
    hashed = F.xxhash64(F.col(key).cast("string"))
    cell = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(1)), F.lit(SAMPLE_DOCS))
    rows = rows.select(F.col(label).alias("_label"), hashed.alias("_hash"), cell.alias("_cell"), F.col(column).alias("_text"))
    chosen = rows.groupBy("_label", "_cell").agg(F.min("_hash").alias("_hash"))
    text = folded("_text")
    start = F.pmod(F.col("_hash"), F.greatest(F.length(text) - SAMPLE_CHARS + 1, F.lit(1)))
    picked = rows.join(F.broadcast(chosen), ["_label", "_cell", "_hash"]).select(
        "_label", "_cell", F.substring(text, (start + 1).cast("int"), F.lit(SAMPLE_CHARS)).alias("_part")
    )
    one = picked.groupBy("_label", "_cell").agg(F.min("_part").alias("_part"))  # rows with equal keys count once
    return one.groupBy(F.col("_label").alias(label)).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_cell", "_part"))), lambda x: x["_part"]), " ")
        .alias("sample")
    )


def learn(labelled: DataFrame, key: str = "doc_id", column: str = "text", label: str = "lang") -> tuple:
    """The samples as a tuple of ``(language, text)``, at most ``SAMPLE_DOCS * SAMPLE_CHARS`` characters each."""
    rows = samples(labelled, key, column, label).collect()
    return tuple(sorted((r[0], r[1]) for r in rows))


def predict(df: DataFrame, model: tuple, column: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row, from the whole text alone.

    The score is the runner-up's share of the bits of the best two: 0.5 if they explain
    the text alike, 1 if there is no other language. Texts that are null or have no
    letter, and all texts where nothing was learned, get ``und`` with score 0. ``bits``
    is what the winner needs per character.
    """
    text = folded(column)
    shown = F.when(text.rlike(LETTER), text)
    rows = df.withColumn("_folded", shown)

    def compute(batch: pa.Table) -> dict[str, list]:
        fitted = _model(model)
        texts = [t or "" for t in batch.column(0).to_pylist()]
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        least = np.zeros(len(texts))
        if fitted.languages and texts:
            bits = fitted.bits(texts)
            best = bits.argmin(1)
            least = bits.min(1)
            others = np.where(np.arange(bits.shape[1]) == best[:, None], np.inf, bits).min(1)
            for i, t in enumerate(texts):
                if t:
                    names[i] = fitted.languages[best[i]]
                    scores[i] = float(others[i] / (others[i] + least[i])) if np.isfinite(others[i]) else 1.0
        return {"lang_pred": names, "score": scores, "bits": least.tolist()}

    return add_columns(rows, ["_folded"], "lang_pred string, score double, bits double", compute).drop("_folded")


def accepted(df: DataFrame, model: tuple, column: str = "text", most: float = MAX_BITS) -> DataFrame:
    """The rows whose language can be told, with their own columns: not ``und``, and explained well enough."""
    kept = predict(packed(df, _text=F.col(column)), model, "_text")
    kept = kept.where((F.col("lang_pred") != UNDETERMINED) & (F.col("bits") <= most))
    return kept.select("_row.*")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; four fifths of the documents teach."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = fold_of("doc_id", FOLDS) == 0
    model = learn(docs.where(~held))
    found = predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "bits")
