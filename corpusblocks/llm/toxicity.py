"""Toxicity by a weighted lexicon, matched after folding disguised letters.

Texts are folded: lower case, compatibility forms, look-alike letters of other scripts to
Latin ones, digits and signs that stand for letters to those letters. The lexicon holds
word beginnings and whole words (which end in a blank) with a log-odds weight; one
Aho-Corasick automaton finds them all. A hit counts only at the start of a word, and not
inside an exception phrase (the hit's word with the word before or after it). The sum
of weights, per hundred words of the text, is turned into a probability by a
non-decreasing step function.

Lexicon, exception phrases and step function are learned from labelled rows: at most
``LEARN_ROWS`` of them, the ones with the smallest hashes of their keys. Every text is
scored whole.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusblocks.llm.common import add_columns, fold_of, table
from corpusblocks.session import materialize

#: Bound of the labelled rows that are learned from.
LEARN_ROWS = 40_000
FOLDS, HELD = 4, 2
THRESHOLD = 0.3
#: A lexicon entry: lengths of word beginnings, least documents and share of toxic documents, least precision.
BEGINNINGS = range(3, 8)
LEAST_DOCS, LEAST_SHARE, LEAST_PRECISION = 4, 0.01, 0.8
#: Clean documents that make a phrase an exception.
EXCEPTION_DOCS = 3
STEPS = 32

# Letters that look like Latin ones, and digits and signs used for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ї": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "α": "a", "ε": "e", "ι": "i",
    "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i",
}
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "|": "i", "€": "e"}

# "1" stands for i and l alike, so l is folded to i on both sides.
_FOLD = str.maketrans(LOOKALIKES | STAND_INS | {"l": "i"})
_MARK = re.compile(r"(?<=\w)[!](?=\w)")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if "!" in text:
        text = _MARK.sub("i", text)
    return text.translate(_FOLD)


@dataclass(frozen=True)
class Lexicon:
    """Weights by term, exception phrases, and the steps of the score."""

    weights: tuple[tuple[str, float], ...]
    exceptions: frozenset[str] = frozenset()
    limits: tuple[float, ...] = ()
    chances: tuple[float, ...] = field(default=(0.0,))


class Matcher:
    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.exceptions = lexicon.exceptions
        self.automaton = ahocorasick.Automaton()
        for term, weight in lexicon.weights:
            self.automaton.add_word(term.rstrip(" "), (term, weight))
        if lexicon.weights:
            self.automaton.make_automaton()
        self.empty = not lexicon.weights

    def hits(self, text: str) -> Iterator[tuple[float, str, str, str]]:
        """Weight, word, and the words before and after it, of every hit in a folded text."""
        if self.empty:
            return
        for last, (term, weight) in self.automaton.iter(text):
            begin = last + 1 - len(term.rstrip(" "))
            if begin and text[begin - 1].isalpha():
                continue
            word = _WORD.match(text, begin)
            if word is None or (term[-1] == " " and word.end() != last + 1):
                continue
            before = _WORD.findall(text[max(0, begin - 40) : begin])
            after = _WORD.search(text[word.end() : word.end() + 40])
            yield weight, word[0], before[-1] if before else "", after[0] if after else ""

    def load(self, text: str) -> float:
        """Weight per hundred words of a folded text, without excepted hits."""
        total = 0.0
        for weight, word, before, after in self.hits(text):
            if f"{before} {word}" not in self.exceptions and f"{word} {after}" not in self.exceptions:
                total += weight
        return 100.0 * total / max(1, text.count(" ") + text.count("\n") + 1) if total else 0.0


@lru_cache(maxsize=4)
def _matcher(lexicon: Lexicon) -> Matcher:
    return Matcher(lexicon)


def terms_of(text: str) -> set[str]:
    """Word beginnings and whole words of a folded text."""
    words = set(_WORD.findall(text))
    return {w[:n] for w in words for n in BEGINNINGS if len(w) >= n} | {w + " " for w in words}


def _counted(rows: DataFrame, keys_of) -> DataFrame:
    """Documents per key and label: ``(term, toxic, clean)`` from ``rows(text, toxic)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[toxic].update(keys_of(fold(text or "")))
            terms = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in counts[::-1])],
                names=["term", "toxic", "clean"],
            )

    found = rows.select("text", "toxic").mapInArrow(run, "term string, toxic long, clean long")
    return found.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose(counts: dict[str, tuple[int, int]], toxic_docs: int, clean_docs: int) -> tuple[tuple[str, float], ...]:
    """Terms of high precision with their log-odds; of nested ones the longest that covers as many."""

    def precise(term: str) -> bool:
        t, c = counts[term]
        return t >= LEAST_PRECISION * (t + c * max(1.0, toxic_docs / max(1, clean_docs)))

    chosen: dict[str, float] = {}
    extended: dict[str, list[str]] = {}
    for term in counts:
        extended.setdefault(term.rstrip(" ") if term[-1] == " " else term[:-1], []).append(term)
    for term in sorted(counts, key=lambda x: (len(x), x)):
        t, c = counts[term]
        if not precise(term) or any(term[:n] in chosen for n in range(1, len(term))):
            continue
        if any(counts[x][0] >= 0.95 * t for x in extended.get(term, [])):
            continue
        odds = ((t + 0.5) / (toxic_docs + 1)) / ((c + 0.5) / (clean_docs + 1))
        if odds > 1:
            chosen[term] = log(odds)
    return tuple(sorted(chosen.items()))


def steps(loads: list[tuple[float, int, int]], toxic_docs: int, clean_docs: int) -> tuple[tuple, tuple]:
    """A non-decreasing chance of label 1 by load, from sorted ``(least load, toxic, clean)`` bins.

    Each bin is drawn towards the overall share by one document; neighbours out of order are pooled.
    """
    share = toxic_docs / max(1, toxic_docs + clean_docs)
    pools: list[list[float]] = []
    for low, t, c in loads:
        pools.append([low, t + share, t + c + 1.0])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            _, t1, n1 = pools.pop()
            pools[-1][1] += t1
            pools[-1][2] += n1
    return tuple(p[0] for p in pools[1:]), tuple(p[1] / p[2] for p in pools) or (share,)


def learn(docs: DataFrame, labels: DataFrame, rows: int = LEARN_ROWS) -> Lexicon:
    """The lexicon from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``; labels disagreeing count as toxic.

    No labelled rows give an empty lexicon and score 0 for every text.
    """
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
    marked = marked.agg(F.max("toxic").cast("int").alias("toxic"))
    total = marked.count()
    if total > rows:
        least = int(2**63 * (2 * 0.98 * rows / total - 1))
        marked = marked.where(F.xxhash64("doc_id") < least)
    # At most LEARN_ROWS rows of two numbers: bounded, so they are sent to the texts.
    sample = materialize(docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id").select("text", "toxic"), "labelled")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic_docs, clean_docs = sizes.get(1, 0), sizes.get(0, 0)
    least_docs = max(LEAST_DOCS, LEAST_SHARE * toxic_docs)
    often = _counted(sample.where("toxic = 1"), terms_of).where(F.col("toxic") >= least_docs)
    wanted = {r["term"]: r["toxic"] for r in often.collect()}
    clean = _counted(sample.where("toxic = 0"), lambda text: terms_of(text) & wanted.keys()).collect()
    counts = {t: (n, 0) for t, n in wanted.items()} | {r["term"]: (wanted[r["term"]], r["clean"]) for r in clean}
    weights = choose(counts, toxic_docs, clean_docs)

    def phrases(text: str) -> set[str]:
        found = _matcher(Lexicon(weights)).hits(text)
        return {p for _, word, before, after in found for p in (f"{before} {word}", f"{word} {after}") if p.strip() != word}

    excepted = _counted(sample, phrases).where(
        (F.col("clean") >= EXCEPTION_DOCS) & (F.col("clean") >= 9 * F.col("toxic"))
    )
    lexicon = Lexicon(weights, frozenset(r["term"] for r in excepted.collect()))
    loads = _loads(sample, lexicon, "load").withColumn(
        "_bin", F.when(F.col("load") > 0, F.least(F.lit(STEPS), F.floor(4 * F.log2(1 + F.col("load"))) + 1)).otherwise(0)
    )
    bins = loads.groupBy("_bin").agg(
        F.min("load").alias("low"), F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")
    ).collect()
    limits, chances = steps(sorted((r["low"], r["t"], r["c"]) for r in bins), toxic_docs, clean_docs)
    return Lexicon(weights, lexicon.exceptions, limits, chances if bins else (0.0,))


def _loads(df: DataFrame, lexicon: Lexicon, out: str, column: str = "text") -> DataFrame:
    def compute(batch: pa.Table) -> dict[str, list]:
        matcher = _matcher(lexicon)
        return {out: [matcher.load(fold(t.as_py() or "")) for t in batch.column(0)]}

    return add_columns(df, [column], f"{out} double", compute)


def score(df: DataFrame, lexicon: Lexicon, column: str = "text", out: str = "score") -> DataFrame:
    """Add the chance, 0 to 1, that a text is toxic; null and empty texts score as texts without hits."""

    def compute(batch: pa.Table) -> dict[str, list]:
        matcher = _matcher(lexicon)
        loads = (matcher.load(fold(t.as_py() or "")) for t in batch.column(0))
        return {out: [lexicon.chances[bisect_right(lexicon.limits, x)] for x in loads]}

    return add_columns(df, [column], f"{out} double", compute)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; three quarters of the labelled rows teach."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    lexicon = learn(docs, labels.where(fold_of("doc_id", FOLDS) != HELD))
    scored = score(docs, lexicon)
    return scored.select(
        "doc_id", (fold_of("doc_id", FOLDS) == HELD).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
