"""What operators leave behind on the shared scratch folder."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from corpusblocks.llm import graph, line_dedup, mixing, simhash
from corpusblocks.session import materialize, scratch_path


def stored(spark):
    return {p.name for p in Path(scratch_path(spark, "x")).parents[1].glob("*")}


def left_behind(spark, make):
    """How many tables are there more when ``make`` has returned, and its rows."""
    before = stored(spark)
    made = make()
    return len(stored(spark) - before), made.collect()


def test_line_deduplication_leaves_the_tables_that_its_result_reads(spark, docs):
    n, rows = left_behind(spark, lambda: line_dedup.without_repeated_lines(docs))
    assert n == 1 and rows
    n, rows = left_behind(spark, lambda: line_dedup.line_classes(docs))
    assert n <= 3 and rows


def test_other_stages_leave_the_tables_that_their_results_read(spark, docs):
    n, rows = left_behind(spark, lambda: simhash.one_per_group(docs))
    assert n == 1 and rows
    n, rows = left_behind(spark, lambda: mixing.mixed_documents(docs))
    assert n == 1 and rows


def test_tables_of_others_stay(spark, docs):
    mine = materialize(docs, "mine")
    result = line_dedup.without_repeated_lines(mine)
    assert mine.count() == docs.count() and result.count() > 0


def test_known_components_are_carried_on(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(i, i + 1) for i in range(400, 460)]
    more = [(rng.randrange(500), rng.randrange(500)) for _ in range(60)] + [(900, 901), (7, 7)]
    one, two = (spark.createDataFrame(x, "a long, b long") for x in (links, more))
    known = graph.connected_components(one)
    got = {tuple(r) for r in graph.connected_components(two, known).collect()}
    whole = {tuple(r) for r in graph.connected_components(one.unionByName(two)).collect()}
    assert got == whole
    nothing = two.where(F.lit(False))
    assert {tuple(r) for r in graph.connected_components(nothing, known).collect()} == {tuple(r) for r in known.collect()}
