"""Personal data by candidate generation and gradient boosting.

Four kinds are looked for: e-mail addresses, IP addresses, card numbers and phone
numbers. The strict pattern of a kind gives its *base* spans. Looser generators propose
many more spans, which overlap each other and the base ones: addresses whose signs are
spelled out, digit groups with any of the usual signs between them. Boosted trees judge
every proposal by its format (grouping, signs, lengths) and its context
(neighbouring characters, what stands before it, other digits near by), and a proposal that
keeps the rules of its kind is selected when its calibrated chance reaches the threshold. Of overlapping
selections the likeliest stays, and none replaces or touches a base span.

Nobody has marked personal data in the corpus, so the trees learn from the strict patterns
themselves: base spans are positive, proposals that break a rule of their kind (checksum,
parts, number of digits, no domain) are negative, and proposals that only look different
teach nothing; they are what the trees are for. Whether the rules hold and the signs that the
strict pattern demands are no features: they would tell the label, and nothing else would be learned. One document in three is held out to calibrate.

The trees come from MLlib, fitted on the spans of all documents, and travel as arrays;
learning reads all whole texts in one narrow pass, scoring in another.

Spans are counted in code points, the end exclusive. Null and empty texts have none, an
empty table gives no rows, and where the texts lack positives or negatives no span is
added. Repeated rows get the same spans. The time per text grows with its length only.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusblocks.llm.common import add_columns, table
from corpusblocks.session import materialize

KINDS = ("email", "ip", "card", "phone")
#: Share of documents that are held out, and positives a kind needs in them.
HELD_OUT = 3
LEAST_POSITIVE = 20
#: Chance from which a proposal is selected.
CHANCE = 0.9
ROUNDS, DEPTH, STEP = 20, 4, 0.3
BINS = 50

# The strict patterns, written so that no place of a text is tried twice.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_HINT = re.compile(r"[0-9@]|dot")
# Digits with at most two signs between neighbours; a sign spelled out in an address.
_CLUMP = re.compile(r"[0-9](?:[ ().\-/]{0,2}[0-9])+")
_SPELLED = re.compile(r"(?: dot |\(dot\)|\[dot\]| \(dot\) | \[dot\] )([A-Za-z]{2,24})(?![A-Za-z])")
_NAMED = re.compile(r"([A-Za-z0-9._%+-]{1,64})(?: at |\(at\)|\[at\]| \(at\) | \[at\] |@)([A-Za-z0-9-]{1,64})\Z")
_HANDLE = re.compile(r"@([A-Za-z0-9-]{1,64})")

FEATURES = 21


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        value = int(c) << (k & 1)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the strict patterns, leftmost and without overlaps per kind, sorted."""
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((start, 0, end))
        else:
            end = max(end, at)  # no later address reaches back over this sign
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def proposals(text: str) -> list[tuple[int, int, int, int]]:
    """``(start, kind, end, sound)`` of the loose generators.

    ``sound`` is 1 where the rules of the kind hold, 0 where one is broken.
    """
    found = []
    for m in _CLUMP.finditer(text):
        start, end = m.span()
        digits = _digits(m[0])
        n, groups = len(digits), re.split("[^0-9]+", m[0])
        if len(groups) == 4 and set(m[0]) <= set("0123456789."):
            parts = all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or 0) <= 255 for g in groups)
            found.append((start, 1, end, int(parts)))
        if 12 <= n <= 22:
            found.append((start, 2, end, int(14 <= n <= 19 and luhn(digits))))
        if 7 <= n <= 18:
            opened = start - 1 if text[start - 1: start] == "(" else start
            # A country code stands before a sign; what is dialled at home ends in groups of three or four.
            found.append((opened, 3, end, int(10 <= n <= 15 and len(groups) >= 3 and len(groups[-1]) in (3, 4))))
    for m in _SPELLED.finditer(text):
        before = _NAMED.search(text[max(0, m.start() - 140): m.start()])
        if before:
            found.append((m.start() - (before.end() - before.start()), 0, m.end(), 1))
    for m in _HANDLE.finditer(text):
        start = m.start()
        while start > 0 and m.start() - start < 64 and _LOCAL.match(text, start - 1):
            start -= 1
        dotted = _DOMAIN.match(text, m.start() + 1)
        if not dotted or start < m.start():
            found.append((start, 0, dotted.end() if dotted else m.end(), int(bool(dotted))))
    return found


def _sort_of(c: str) -> float:
    """Class of a neighbouring character, ordered from open to closed."""
    if not c or c.isspace():
        return 0.0
    if c in ".,;:!?)]}|":
        return 1.0
    if c in "([{<":
        return 2.0
    if c in "\"'=`":
        return 3.0
    if c.isdigit():
        return 5.0
    return 6.0 if c.isalpha() else 4.0


def features(text: str, start: int, kind: int, end: int, sound: int = 1) -> list[float]:
    """Format and context of a proposal; ``sound``, a leading plus sign and the spelling of signs are left out."""
    span = text[start:end]
    digits = _digits(span)
    groups = [len(g) for g in re.findall("[0-9]+", span)]
    letters = sum(map(str.isalpha, span))
    words = text[max(0, start - 24): start].replace("+", "").split()
    around = text[max(0, start - 40): start] + text[end: end + 40]
    tail = (groups + [0, 0])[:2] if kind != 3 else (groups[-2:] + [0, 0])[:2]
    open_at = start - 1 if text[start - 1: start] == "+" else start
    return [
        float(kind), float(min(len(span), 80)), float(len(digits)), float(len(groups)),
        float(max(groups, default=0)), float(min(groups, default=0)), float(tail[0]), float(tail[1]),
        float(len(set(digits))), float(digits[:1] or -1), float(span.count("-")), float(span.count(" ")),
        float(span.count(".")), float("(" in span), letters / max(1, len(span)),
        _sort_of(text[open_at - 1: open_at]) if open_at else 0.0, _sort_of(text[end: end + 1]),
        float(len(words[-1]) if words else 0), float(bool(words) and words[-1][-1:] in ":=#"),
        float(sum(map(str.isdigit, around))), float(sum(map(str.isalpha, around))),
    ]


@dataclass(frozen=True)
class Judge:
    """Boosted trees as arrays, the calibrated chance of each bin of scores, by kind.

    A tree is ``(feature, threshold, left, right, value)``; a leaf has feature -1.
    """

    trees: tuple = ()
    weights: tuple = ()
    chances: dict[int, tuple[tuple, tuple]] = field(default_factory=dict)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Score between 0 and 1 of every row of features."""
        margin = np.zeros(len(rows))
        for (feature, threshold, left, right, value), weight in zip(self.trees, self.weights):
            node = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                f = feature[node]
                down = np.where(rows[np.arange(len(rows)), np.maximum(f, 0)] <= threshold[node], left[node], right[node])
                node = np.where(f < 0, node, down)
            margin += weight * value[node]
        return 1 / (1 + np.exp(-2 * margin))

    def chance(self, kind: int, score: float) -> float:
        if kind not in self.chances:
            return 0.0
        limits, chances = self.chances[kind]
        return chances[max(0, bisect_right(limits, score) - 1)]


def _parsed(lines: list[str]) -> tuple:
    """Arrays of one tree from the lines in which MLlib describes it."""
    nodes: list[list] = []

    def read(at: int) -> tuple[int, int]:
        own = len(nodes)
        nodes.append([-1, 0.0, 0, 0, 0.0])
        line = lines[at].strip()
        if line.startswith("Predict:"):
            nodes[own][4] = float(line.split(":")[1])
            return own, at + 1
        place, limit = re.match(r"If \(feature (\d+) <= ([^)]+)\)", line).groups()
        nodes[own][:2] = int(place), float(limit)
        nodes[own][2], at = read(at + 1)
        nodes[own][3], at = read(at + 1)  # behind the line of the other case
        return own, at

    read(0)
    kinds = (np.int64, float, np.int64, np.int64, float)
    return tuple(np.array(column, kind) for column, kind in zip(zip(*nodes), kinds))


def pooled(bins: list[tuple[float, int, int]]) -> tuple[tuple, tuple]:
    """Chances that do not fall with the score, from sorted ``(least score, positive, all)`` bins."""
    pools: list[list[float]] = []
    for low, positive, n in bins:
        pools.append([low, positive, n])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            _, p, m = pools.pop()
            pools[-1][1] += p
            pools[-1][2] += m
    return tuple(p[0] for p in pools), tuple(p[1] / (p[2] + 1) for p in pools)


def _training_rows(docs: DataFrame) -> DataFrame:
    """``(kind, label, part, x)`` of base spans and of proposals that break a rule."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"kind": [], "label": [], "part": [], "x": []}
            for text, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text or not _HINT.search(text):
                    continue
                strict = base_spans(text)
                rows = [(s, k, e, 1) for s, k, e in strict]
                taken = _Taken(strict)
                rows += [(s, k, e, 0) for s, k, e, sound in proposals(text) if not sound and not taken.meets(s, e)]
                for s, k, e, label in rows:
                    out["kind"].append(k)
                    out["label"].append(float(label))
                    out["part"].append(part)
                    out["x"].append(features(text, s, k, e))
            yield pa.RecordBatch.from_arrays([
                pa.array(out["kind"], pa.int32()), pa.array(out["label"], pa.float64()),
                pa.array(out["part"], pa.int32()), pa.array(out["x"], pa.list_(pa.float64())),
            ], names=list(out))

    return docs.mapInArrow(run, "kind int, label double, part int, x array<double>")


class _Taken:
    """Spans that do not overlap within a kind, for asking whether another one meets any."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts, self.ends = [], []
        for start, _, end in spans:
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        k = bisect_right(self.ends, start)
        return k < len(self.starts) and self.starts[k] < end


def learn(docs: DataFrame) -> Judge:
    """The judge from all documents of ``docs(text)``; their text decides which are held out."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    key = F.xxhash64(F.coalesce("text", F.lit("")))
    part = F.pmod(F.xxhash64(key), F.lit(HELD_OUT)).cast("int")
    rows = materialize(_training_rows(docs.select("text", part.alias("part"))), "candidates")
    fitted = rows.where("part > 0")
    sizes = {r["label"]: r["n"] for r in fitted.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Judge()
    model = GBTClassifier(
        featuresCol="v", labelCol="label", maxIter=ROUNDS, maxDepth=DEPTH, stepSize=STEP, seed=13, maxBins=64
    ).fit(fitted.select("label", array_to_vector("x").alias("v")))
    trees = tuple(_parsed(t.toDebugString.splitlines()[1:]) for t in model.trees)
    judge = Judge(trees, tuple(model.treeWeights))
    held = rows.where("part = 0").select("kind", "label", array_to_vector("x").alias("v"))
    score = vector_to_array("probability")[1]
    binned = model.transform(held).groupBy("kind", F.floor(score * BINS).alias("bin")).agg(
        F.min(score).alias("low"), F.sum("label").cast("long").alias("positive"), F.count("*").alias("n")
    )
    bins: dict[int, list] = {}
    for r in sorted(binned.collect()):
        bins.setdefault(r["kind"], []).append((r["low"], r["positive"], r["n"]))
    chances = {k: pooled(b) for k, b in bins.items() if sum(p for _, p, _ in b) >= LEAST_POSITIVE}
    return Judge(judge.trees, judge.weights, chances)


def added_spans(text: str, strict: list[tuple[int, int, int]], judge: Judge, least: float = CHANCE) -> list[tuple[int, int, int]]:
    """Proposals that the judge selects beside the base spans, likeliest first where they overlap."""
    taken = _Taken(strict)
    open_to = [p[:3] for p in proposals(text) if p[3] and not taken.meets(p[0], p[2])] if judge.chances else []
    if not open_to:
        return []
    scores = judge.scores(np.array([features(text, *p) for p in open_to]))
    ranked = sorted(
        (-c, p[0], p[1], p[2]) for p, s in zip(open_to, scores.tolist()) if (c := judge.chance(p[1], s)) >= least
    )
    # A proposal overlaps a bounded number of others, those of its own digits or sign.
    chosen: list[tuple[int, int, int]] = []
    cells: dict[int, list[tuple[int, int]]] = {}
    for _, start, kind, end in ranked:
        own = range(start // 64, (end - 1) // 64 + 1)
        if not any(s < end and start < e for cell in own for s, e in cells.get(cell, ())):
            chosen.append((start, kind, end))
            for cell in own:
                cells.setdefault(cell, []).append((start, end))
    return chosen


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def find(docs: DataFrame, judge: Judge, column: str = "text") -> DataFrame:
    """Add ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (base spans), ``base_sha256`` and all ``spans``."""
    nothing = hashlib.sha256(b"").hexdigest()

    def compute(batch: pa.Table) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
        for text in batch.column(0).to_pylist():
            strict = base_spans(text) if text and _HINT.search(text) else []
            more = added_spans(text, strict, judge) if text and _HINT.search(text) else []
            for k, kind in enumerate(KINDS):
                out[f"n_{kind}"].append(sum(s[1] == k for s in strict))
            out["base_sha256"].append(hashlib.sha256(_listed(strict).encode()).hexdigest() if strict else nothing)
            out["spans"].append(_listed(sorted(strict + more)))
        return out

    return add_columns(
        docs, [column], "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string", compute
    )


def redacted(text: str, spans: str) -> str:
    """The text with every listed span replaced by its kind; overlapping spans are replaced together."""
    out, at = [], 0
    for kind, start, end in (s.split(":") for s in spans.split(",") if s):
        if int(start) >= at:
            out += [text[at: int(start)], f"[{kind}]"]
        at = max(at, int(end))
    return "".join(out) + text[at:]


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document; what is learned comes from the texts alone."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, learn(docs.select("text")))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
