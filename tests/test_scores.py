"""Likelihood, sampling, generation and run logs against NumPy and plain Python."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusblocks.functions import vectors as vec
from corpusblocks.operators import generation, likelihood
from corpusblocks.operators import runlog as log_ops
from corpusblocks.session import join_lookup
from corpusblocks.sources import runlog as log_src


def distribution(logits, generated=(), t=1.0, k=0, p=1.0, penalty=1.0):
    x = np.array(logits, float)
    x = x / max(1e-6, t) if t > 0 else x
    if penalty > 1:
        for i in set(generated):
            x[i] /= penalty
    q = np.exp(x - x.max())
    q /= q.sum()
    order = sorted(range(len(q)), key=lambda i: (-q[i], i))
    keep = set(order[:k]) if 0 < k < len(q) else set(order)
    q = np.array([q[i] if i in keep else 0.0 for i in range(len(q))])
    if p < 1:
        order, mass, kept = sorted(range(len(q)), key=lambda i: (-q[i], i)), 0.0, set()
        for i in order:
            if kept and mass >= p:
                break
            kept.add(i)
            mass += q[i]
        q = np.array([q[i] if i in kept else 0.0 for i in range(len(q))])
    return q / q.sum() if q.sum() > 0 else np.full(len(q), 1 / len(q))


CASES = [
    dict(), dict(t=0.5), dict(t=0), dict(t=-1), dict(k=1), dict(k=5), dict(k=20), dict(k=99), dict(p=0.0), dict(p=0.6),
    dict(p=1.0), dict(k=6, p=0.5), dict(penalty=1.3), dict(penalty=0.5), dict(t=0.9, k=8, p=0.7, penalty=1.2),
]


@pytest.mark.parametrize("case", CASES, ids=str)
def test_sampling_distribution(spark, case):
    rng = random.Random(str(case))
    rows = [(i, [rng.choice([rng.gauss(0, 3), -1.0, 2.0]) for _ in range(20)], rng.sample(range(20), rng.randint(0, 6))) for i in range(40)]
    df = spark.createDataFrame(rows, "i int, x array<double>, g array<int>")
    got = df.select("i", vec.sampling_distribution(F.col("x"), F.col("g"), **case).alias("q")).collect()
    for r in got:
        want = distribution(rows[r["i"]][1], rows[r["i"]][2], **case)
        assert np.allclose(r["q"], want, atol=1e-12) and abs(sum(r["q"]) - 1) < 1e-9


def test_ties_keep_the_smallest_ids_and_no_mass_means_uniform(spark):
    df = spark.createDataFrame([([0.25] * 4, [0.0, 0.0])], "p array<double>, z array<double>")
    row = df.select(vec.top_k(F.col("p"), 2), vec.top_p(F.col("p"), 0.5), vec.renormalise(F.col("z"))).first()
    assert list(row) == [[0.25, 0.25, 0, 0], [0.25, 0.25, 0, 0], [0.5, 0.5]]


def test_draw_and_argmax(spark):
    df = spark.createDataFrame([([0.5, 0.0, 0.5],)], "p array<double>")
    draws = df.select(*[vec.draw(F.col("p"), F.lit(u)) for u in (0.0, 0.49, 0.5, 0.99, 1.0)], vec.argmax(F.col("p"))).first()
    assert list(draws) == [0, 0, 2, 2, 2, 0]


def test_losses_of_vectors(spark):
    rng = random.Random(5)
    rows = [([rng.gauss(0, 40) for _ in range(9)], rng.randrange(9)) for _ in range(50)]
    df = spark.createDataFrame(rows, "logits array<double>, target_id int")
    nll = [float(np.logaddexp.reduce(x) - x[t]) for x, t in rows]
    r = likelihood.vector_loss(df).first()
    assert r["tokens"] == 50 and math.isclose(r["loss"], np.mean(nll)) and math.isclose(r["perplexity"], math.exp(np.mean(nll)))
    empty = likelihood.vector_loss(df.limit(0)).first()
    assert math.isnan(empty["loss"]) and math.isnan(empty["perplexity"]) and empty["tokens"] == 0
    logs = df.select("logits", vec.log_softmax(F.col("logits")).alias("l"), vec.softmax(F.col("logits")).alias("s")).collect()
    for row in logs:
        want = np.array(row["logits"]) - np.logaddexp.reduce(row["logits"])
        assert np.allclose(row["l"], want) and np.allclose(row["s"], np.exp(want))


SIZE = 6


def model_of(blocks, k=1.0):
    n, c, u, total = {}, {}, {}, 0
    for tokens in blocks:
        for a, b in zip(tokens, tokens[1:]):
            n[a, b] = n.get((a, b), 0) + 1
            c[a] = c.get(a, 0) + 1
            u[b] = u.get(b, 0) + 1
            total += 1
    p1 = lambda b: (u.get(b, 0) + 1) / (total + SIZE)
    return lambda a, b: (n.get((a, b), 0) + k * p1(b)) / (c.get(a, 0) + k)


@pytest.fixture(scope="module")
def token_blocks(spark):
    rng = random.Random(11)
    rows = [("train" if i % 3 else "val", i, [rng.choice([0, 1, 1, 2, 4, 5]) for _ in range(rng.randint(1, 9))]) for i in range(60)]
    return rows, spark.createDataFrame(rows, "split string, block_id long, tokens array<int>")


def test_next_token_model_and_perplexity(spark, token_blocks):
    rows, df = token_blocks
    prob = model_of([t for s, _, t in rows if s == "train"])
    counts = likelihood.neighbour_counts(df.where("split = 'train'"))
    for r in likelihood.next_token_model(counts, SIZE).collect():
        assert math.isclose(r["p"], prob(r["input_id"], r["target_id"]))
    assert sum(prob(1, b) for b in range(SIZE)) == pytest.approx(1)
    for few in (True, False):
        got = {r["split"]: r for r in likelihood.evaluate(df, counts, SIZE, few_groups=few).collect()}
        for split in ("train", "val"):
            nll = [-math.log(prob(a, b)) for s, _, t in rows if s == split for a, b in zip(t, t[1:])]
            assert got[split]["tokens"] == len(nll)
            assert math.isclose(got[split]["loss"], np.mean(nll)) and math.isclose(got[split]["perplexity"], math.exp(np.mean(nll)))
    vectors = vectors_of(spark, likelihood.context_model(counts, SIZE))
    assert sorted(vectors) == list(range(SIZE))
    for a, v in vectors.items():
        assert np.allclose(np.exp(v), [prob(a, b) for b in range(SIZE)])


def vectors_of(spark, model):
    """Score vectors of all contexts, seen or not."""
    every = spark.range(SIZE).select(F.col("id").cast("int").alias("input_id")).join(model.table, "input_id", "left")
    return {r[0]: r[1] for r in every.select("input_id", model.logits(F.col("c"), F.col("by_target"))).collect()}


def hash_uniform(*parts):
    import hashlib
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 2**52


@pytest.mark.parametrize("penalty", [1.0, 1.4])
def test_generation(spark, token_blocks, penalty):
    rows, df = token_blocks
    counts = likelihood.neighbour_counts(df.where("split = 'train'"))
    # Token 3 ends a text; make it likely after token 4.
    counts = counts.where("input_id <> 4 or target_id <> 3").unionByName(
        spark.createDataFrame([(4, 3, 10_000)], "input_id int, target_id int, n long")
    )
    model = likelihood.context_model(counts, SIZE)
    table = vectors_of(spark, model)
    prompts = [(i, [2, i % SIZE]) for i in range(30)]
    pdf = spark.createDataFrame(prompts, "i long, ids array<int>")
    settings = dict(t=0.9, k=4, p=0.9, penalty=penalty)
    sampled = {r["i"]: r["generated"] for r in generation.continue_sampled(pdf, model, 10, ["i"], seed=9, **settings).collect()}
    greedy = {r["i"]: r["generated"] for r in generation.continue_greedy(pdf, model, 10).collect()}
    for i, ids in prompts:
        last, out = ids[-1], []
        for step in range(10):
            q = distribution(table[last], out, **settings)
            cdf, u = np.cumsum(q), hash_uniform(9, step, i)
            last = int(np.argmax(cdf > u))
            if last == 3:
                break
            out.append(last)
        assert sampled[i] == out
        last, out = ids[-1], []
        for _ in range(10):
            last = int(np.argmax(table[last]))
            if last == 3:
                break
            out.append(last)
        assert greedy[i] == out


@pytest.mark.parametrize("settings", [
    {"t": 0.9, "k": 4, "p": 0.9, "penalty": 1.4}, {"t": 0.0, "k": 0, "p": 0.5}, {"t": 1.0, "k": SIZE, "p": 1.0}, {"k": 3},
])
def test_sampling_in_one_pass_equals_joins(spark, token_blocks, monkeypatch, settings):
    """Few counts: no table is written but the contexts, and the tokens are those of a join for every token."""
    counts = likelihood.neighbour_counts(token_blocks[1].where("split = 'train'")).where("input_id <> 5")
    model = likelihood.context_model(counts, SIZE)
    prompts = [(i % 20, [2, i % SIZE]) for i in range(40)] + [(None, [7]), (41, None), (42, [10**6])]
    pdf = spark.createDataFrame(prompts, "i long, ids array<int>")
    written = []
    write = generation.materialize
    monkeypatch.setattr(generation, "materialize", lambda df, name: written.append(name) or write(df, name))
    one = generation.continue_sampled(pdf, model, 6, ["i"], seed=3, **settings)
    assert sorted(map(repr, one.collect())) and written == ["contexts"]
    monkeypatch.setattr(generation, "BROADCAST_PAIRS", -1)
    many = generation.continue_sampled(pdf, model, 6, ["i"], seed=3, **settings)
    assert one.schema == many.schema
    assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect()))


def test_lookup_join_is_the_same_with_salted_keys(spark):
    left = spark.range(500).selectExpr("id", "if(id % 3 = 0, 0, id % 40) as k")
    right = spark.range(30).selectExpr("id as k", "id * 2 as v")
    for how in ("inner", "left"):
        small = join_lookup(left, right, ["k"], how)
        salted = join_lookup(left, right, ["k"], how, max_rows=5)
        plain = left.join(right, ["k"], how)
        for other in (small, salted):
            assert sorted(map(tuple, other.select("id", "k", "v").collect())) == sorted(map(tuple, plain.select("id", "k", "v").collect()))


def test_runlog(spark, tmp_path):
    nan = float("nan")
    rows = [(1, 1, 9.0), (1, 2, nan), (1, 3, 7.0), (1, 4, 7.0), (1, 5, 8.0), (1, 6, 6.5), (2, 1, nan), (2, 2, 3.0), (2, 7, 4.0)]
    log = spark.createDataFrame(rows, "run_id long, step long, perplexity double")
    pick = lambda df: sorted((r["run_id"], r["step"]) for r in df.collect())
    assert pick(log_ops.evaluation_rows(log, 3)) == [(1, 1), (1, 3), (1, 6), (2, 1)]
    assert pick(log_ops.save_rows(log, 4)) == [(1, 4), (1, 6), (2, 7)]
    assert pick(log_ops.improvements(log)) == [(1, 1), (1, 3), (1, 6), (2, 2)]
    assert pick(log_ops.best_rows(log)) == [(1, 6), (2, 2)]
    assert pick(log_ops.best_rows(log.where("step < 6"))) == [(1, 3), (2, 2)]
    assert pick(log_ops.last_rows(log)) == [(1, 6), (2, 7)]
    path = str(tmp_path / "log")
    log_src.append_runlog(log_ops.last_rows(log), path)
    log_src.append_runlog(log_ops.best_rows(log), path)
    back = log_src.read_runlog(spark, path)
    assert back.columns == log_src.RUNLOG_SCHEMA.fieldNames() and back.count() == 4


def test_configs(spark, tmp_path):
    (tmp_path / "best.json").write_text(json.dumps({"step": 3, "config": {"seq_len": 64, "dropout": 0.1}}, indent=2))
    row = log_src.read_checkpoint_configs(spark, str(tmp_path / "best.json")).first().asDict()
    assert row == {"vocab_size": 1024, "seq_len": 64, "d_model": 128, "n_layers": 7, "n_heads": 4, "dropout": 0.1}
    (tmp_path / "none.json").write_text("not json")
    assert log_src.read_checkpoint_configs(spark, str(tmp_path / "none.json")).first().asDict() == log_src.CONFIG_DEFAULTS
