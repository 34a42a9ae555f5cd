"""Personal data: strict spans against the plain patterns, trees against MLlib, selection on planted spans."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from corpusblocks.llm import personal
from corpusblocks.llm.personal import KINDS, luhn

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = "".join(c for c in m[0] if c in "0123456789")
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == 3 and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), kind, m.end()))
    return sorted(found)


def card(rng, valid=True):
    body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(body + c for c in "0123456789" if luhn(body + c) == valid)


def test_strict_spans_equal_the_patterns():
    rng = random.Random(13)
    pieces = ["a", "B7", "@", "@x.y", ".", "-", " ", "+", "+1", "(", ")", "12", "255", "256", "0", "9.9", "é", "٣", "日", "\n", "%", "_"]
    for _ in range(20_000):
        text = "".join(rng.choice([*pieces, card(rng), "+1 (614) 555-8001", "1.2.3.4", "a.b@c.de"]) for _ in range(rng.randint(0, 14)))
        assert personal.base_spans(text) == plain(text), text


@pytest.mark.parametrize("text", ["a" * 200_000, "1" * 200_000, "a@" * 50_000, "1.2.3." * 40_000, "+1(((" * 40_000, "a." * 90_000 + "@", " at x dot " * 20_000])
def test_time_grows_with_the_length(text):
    start = time.perf_counter()
    strict = personal.base_spans(text)
    for p in personal.proposals(text)[:100]:
        personal.features(text, *p)
    assert time.perf_counter() - start < 5 and isinstance(strict, list)


@pytest.mark.parametrize("which", ["folder", "sf"])
def test_op13_base(spark, folder, sf_dir, which):
    path = folder if which == "folder" else sf_dir
    expected = []
    for r in spark.read.parquet(f"{path}/documents.parquet").collect():
        spans = plain(r["text"] or "")
        listed = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
        counts = [sum(k == i for _, k, _ in spans) for i in range(4)]
        expected.append((r["doc_id"], *counts, hashlib.sha256(listed.encode()).hexdigest(), set(listed.split(","))))
    got = personal.op13_personal_data(spark, path).collect()
    assert sorted(map(repr, (tuple(r)[:6] for r in got))) == sorted(map(repr, (e[:6] for e in expected)))
    by_digest = {e[:6]: e[6] for e in expected}
    for r in got:
        assert by_digest[tuple(r)[:6]] <= set(r["spans"].split(","))


@pytest.fixture(scope="module")
def planted(spark):
    """Texts with strict spans, decoys, and spans that only look different."""
    rng = random.Random(4)
    words = "the harbour keeper counted seven boats and wrote them down again before noon".split()
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    phone = lambda: f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    rows = []
    for i in range(3000):
        span, kind = rng.choice([
            (f"+1 {phone()}", "phone"), (f"{rng.choice(words)}.{i % 90}@mail{i % 9}.example.com", "email"),
            (card(rng), "card"), (card(rng, False), ""), (".".join(str(rng.randint(0, 255)) for _ in range(4)), "ip"),
            (f"{rng.randint(300, 999)}.1.400.7", ""), (f"order {rng.randint(10**6, 10**9)}", ""), (f"@{rng.choice(words)}", ""),
        ])
        rows.append((i, f"{say(9)} {span} {say(7)}.", kind))
    return spark.createDataFrame(rows, "doc_id long, text string, kind string"), phone


def test_judge_learns_from_the_texts(spark, planted):
    docs, phone = planted
    judge = personal.learn(docs)
    rows = [(i, f"they called {phone()} again before noon.") for i in range(50)]
    rows += [(100 + i, f"the order 12345{i:02d} was 17 of 30 boats, 2024-05-{i % 28 + 1:02d}.") for i in range(50)]
    rows += [(200, None), (201, ""), (202, "call +1 (614) 555-8001")]
    found = {r["doc_id"]: r for r in personal.find(spark.createDataFrame(rows, "doc_id long, text string"), judge).collect()}
    assert np.mean(["phone" in found[i]["spans"] for i in range(50)]) > 0.9
    assert np.mean([found[100 + i]["spans"] == "" for i in range(50)]) > 0.95
    assert found[200]["spans"] == found[201]["spans"] == "" and found[202]["spans"] == "phone:5:22"
    clean = personal.find(docs.where("kind = ''"), judge).collect()
    assert np.mean([r["spans"] == "" for r in clean]) > 0.95


def test_what_is_learned_decides(spark, planted):
    """The label is no feature: sound proposals of one kind are told apart by what the texts teach."""
    docs, _ = planted
    judge = personal.learn(docs)
    assert len({int(f) for tree in judge.trees for f in tree[0] if f >= 0}) > 1
    text = "they called (614) 555-8001 again"
    proposal = next(p for p in personal.proposals(text) if p[1] == 3)
    assert personal.features(text, *proposal[:3], 0) == personal.features(text, *proposal[:3], 1)
    # Broken proposals are never selected, whatever the trees say of their looks.
    broken = "the 300.1.400.7 again"
    sure = personal.Judge(judge.trees, judge.weights, {k: ((0.0,), (1.0,)) for k in range(4)})
    assert personal.added_spans(broken, [], sure) == []


def test_all_documents_are_learned_from(spark, monkeypatch):
    """However many documents there are, none is left out of the training rows."""
    seen = []
    training_rows = personal._training_rows
    monkeypatch.setattr(personal, "_training_rows", lambda docs: seen.append(docs.count()) or training_rows(docs))
    personal.learn(spark.range(45_000).selectExpr("concat('boat ', id) AS text"))
    assert seen == [45_000]


def test_exported_trees_equal_mllib(spark, planted):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = personal._training_rows(planted[0].selectExpr("text", "1 AS part")).coalesce(1).persist()
    frame = rows.select("label", "x", array_to_vector("x").alias("v"))
    model = GBTClassifier(featuresCol="v", labelCol="label", maxIter=5, maxDepth=personal.DEPTH, seed=1).fit(frame)
    judge = personal.Judge(
        tuple(personal._parsed(t.toDebugString.splitlines()[1:]) for t in model.trees), tuple(model.treeWeights)
    )
    wanted = model.transform(frame).select("x", vector_to_array("probability")[1].alias("p")).collect()
    assert judge.scores(np.array([r["x"] for r in wanted])) == pytest.approx([r["p"] for r in wanted], abs=1e-9)
    rows.unpersist()


def test_no_positives_add_nothing(spark):
    docs = spark.createDataFrame([(1, "no data here 12")], "doc_id long, text string")
    assert personal.learn(docs) == personal.Judge()
    assert personal.find(docs, personal.Judge()).first()["spans"] == ""


def test_redacted():
    assert personal.redacted("call +1 (614) 555-8001 or a@b.cd now", "phone:5:22,email:26:32") == "call [phone] or [email] now"
    assert personal.redacted("x", "") == "x"
