"""Spelling variants against all deletions of all words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from corpusblocks.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def written(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += len(run) >= 7
    return {w: n for w, n in counts.items() if n >= 2}


def plain(counts):
    open_at, near = defaultdict(set), defaultdict(set)
    for w in counts:
        for k in range(len(w)):
            open_at[w[:k], w[k + 1:]].add(w)
            if (v := w[:k] + w[k + 1:]) in counts:
                near[w].add(v)
                near[v].add(w)
    for group in open_at.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 10 * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items())


def result(frame):
    return sorted(tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("which", ["folder", "sf"])
def test_op12_equals_all_deletions(spark, folder, sf_dir, which):
    path = folder if which == "folder" else sf_dir
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    assert result(spelling.op12_spelling_variants(spark, path)) == plain(written(rows))


@pytest.mark.parametrize("pairs", [0, 3, 1024])
def test_crowded_keys_are_cut_again(spark, pairs):
    """Thousands of words that begin or end alike; with few pairs allowed, every level is reached."""
    rng = random.Random(5)
    counts = {}
    for _ in range(700):
        word = rng.choice(["inter", "überaus", "a" * 30]) + "".join(rng.choice("abé") for _ in range(rng.randint(2, 7)))
        counts[word + rng.choice(["", "ing", "aaaa"])] = rng.choice([2, 3, 25, 400, 5000, 10**6])
    counts = {w: n for w, n in counts.items() if len(w) >= 7}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert result(spelling.variant_forms(words, pairs=pairs)) == plain(counts)


def test_pairs_are_found_once(spark):
    words = spark.createDataFrame([("aaaaaaa", 2), ("aaaaaaaa", 2), ("aaaaaaab", 2), ("baaaaaa", 2)], "word string, n long")
    pairs = [frozenset(r[:2]) for r in spelling.near_pairs(words).collect()]
    assert len(pairs) == len(set(pairs)) == 4


def test_short_words_and_one_letter_remainders(spark):
    counts = {"a": 2, "b": 3, "ab": 40, "ba": 2, "abc": 500, "é": 2, "éa": 30}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert result(spelling.variant_forms(words)) == plain(counts)
