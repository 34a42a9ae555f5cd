"""Secret scans with an incremental ledger of blobs.

Every version of every text is addressed by the digest of its content. The ledger is a
table of what has been scanned: one row per blob, rule and rule version, with the spans
found. A scan takes only the pairs of blob and rule version that the ledger does not
hold, each blob once however many paths hold it, appends its findings, and joins all
findings of the current rules back to the paths.

Spans are counted in code points, the end exclusive. Spark's expressions give the
matches of a pattern but not their places, so the text is also split by the pattern: the
lengths of what stands between the matches and of the matches add up to the places.

Null texts are scanned as empty ones. Everything is DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusblocks.llm.common import table, whole_text
from corpusblocks.session import join_lookup, materialize


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches count when group ``group`` has ``least`` characters.

    ``hints`` are strings of which a text must hold one, in lower case, for the pattern to
    match at all: texts without are not searched. ``base`` marks the kinds of the contract.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    version: int = 1
    hints: tuple[str, ...] = ()
    base: bool = True


# The patterns of the three base kinds, then what is scanned for besides.
# Where every run of a class is taken whole, its least length is part of the pattern.
RULES = (
    Rule(
        "assign",
        "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2, least=8, hints=("passw", "secret", "token", "api"),
    ),
    Rule("access", "AKIA[A-Z0-9]{12,}", hints=("akia",)),
    Rule("hex", "[0-9a-f]{32,}"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", hints=("private key-----",), base=False),
    Rule("hub", "gh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), base=False),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}", hints=("eyj",), base=False),
)

SPAN = "array<struct<start: bigint, end: bigint>>"
LEDGER = "blob string, kind string, version int, spans " + SPAN


def spans(rule: Rule, column: str, lowered: str) -> Column:
    """Places of a rule's matches in a text column; null where there are none."""
    text = F.col(column)
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else matches
    between = F.split(text, rule.pattern, -1)
    # Piece i, then match i: where match i starts is what all pieces up to i and all matches before it hold.
    parts = F.arrays_zip(
        F.transform(F.slice(between, 1, F.size(matches)), F.length).alias("gap"),
        F.transform(matches, F.length).alias("size"), F.transform(values, F.length).alias("value"),
    )
    nothing = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPAN).alias("found"))

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + part["size"]
        span = F.struct(start.alias("start"), end.alias("end"))
        found = F.when(part["value"] >= rule.least, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    found = F.aggregate(parts, nothing, step, lambda state: state["found"])
    possible = text.rlike(rule.pattern)
    if rule.hints:
        hinted = reduce(lambda a, b: a | b, [F.contains(F.col(lowered), F.lit(h)) for h in rule.hints])
        possible = hinted & possible
    return F.when(possible, found)


def scan(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings of ``blobs(blob, text)``: one row per blob and rule that has any."""
    rows = blobs.withColumn("_lowered", F.lower("text"))
    found = F.array(*[
        F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), spans(r, "text", "_lowered").alias("spans"))
        for r in rules
    ])
    rows = rows.select("blob", F.explode(F.filter(found, lambda x: F.size(x["spans"]) > 0)).alias("_found"))
    return rows.select("blob", "_found.*")


def update_ledger(
    paths: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, key: str = "doc_id",
    column: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Scan what ``ledger`` lacks of ``paths(key, text)``: the grown ledger and ``(key, blob)`` of every path.

    A ledger row without spans says that the pair was scanned and held nothing.
    """
    spark = paths.sparkSession
    texts = paths.select(F.col(key).alias("_key"), whole_text(column).alias("text"))
    addressed = texts.withColumn("blob", F.sha2("text", 256))
    where = materialize(addressed.select(F.col("_key").alias(key), "blob"), "paths")
    blobs = materialize(where.groupBy("blob").agg(F.min(key).alias("_key")), "blobs")
    grown = []
    if ledger is None:
        ledger = spark.createDataFrame([], LEDGER)
    known = ledger.select("blob", "kind", "version").distinct()
    for version_rules, unseen in _unseen(blobs, known, rules):
        # One path of a blob carries its text to the scan; the small side is hashed, the texts are not sorted.
        chosen = unseen.select("blob", F.coalesce("_key", F.lit(-1)).alias("_key")).withColumnRenamed("blob", "_wanted")
        text = texts.withColumn("_key", F.coalesce("_key", F.lit(-1)))
        joined = text.join(chosen.hint("shuffle_hash"), "_key").where(F.sha2("text", 256) == F.col("_wanted"))
        found = scan(joined.select(F.col("_wanted").alias("blob"), "text"), version_rules)
        found = materialize(found.distinct(), "findings")
        scanned = unseen.select("blob", F.explode(F.array(*[
            F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in version_rules
        ])).alias("_pair")).select("blob", "_pair.*")
        grown.append(scanned.join(found, ["blob", "kind", "version"], "left").select("blob", "kind", "version", "spans"))
    for part in grown:
        ledger = ledger.unionByName(part)
    return ledger, where


def _unseen(blobs: DataFrame, known: DataFrame, rules: tuple[Rule, ...]) -> list[tuple[tuple[Rule, ...], DataFrame]]:
    """Rules grouped by which blobs they have not seen, with these blobs."""
    if known.isEmpty():
        return [(rules, blobs)]
    return [
        ((r,), blobs.join(known.where((F.col("kind") == r.kind) & (F.col("version") == r.version)), "blob", "left_anti"))
        for r in rules
    ]


def findings(ledger: DataFrame, where: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All findings of the current rules at every path: the columns of ``where`` and ``spans`` by kind (a map)."""
    current = reduce(lambda a, b: a | b, [(F.col("kind") == r.kind) & (F.col("version") == r.version) for r in rules])
    held = ledger.where(current & (F.size("spans") > 0)).groupBy("blob").agg(
        F.map_from_entries(F.collect_list(F.struct("kind", "spans"))).alias("spans")
    )
    held = materialize(held, "held")
    return join_lookup(where, held, ["blob"], "left")


def spans_text(found: Column, rules: tuple[Rule, ...]) -> Column:
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    empty = F.array().cast(SPAN)

    def listed(place: int, kind: str) -> Column:
        def entry(s: Column) -> Column:
            text = F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))
            return F.struct(s["start"].alias("start"), F.lit(place).alias("place"), text.alias("t"))

        return F.transform(F.coalesce(F.try_element_at(found, F.lit(kind)), empty), entry)

    lists = [listed(i, r.kind) for i, r in enumerate(rules)]
    return F.array_join(F.transform(F.array_sort(F.concat(*lists)), lambda x: x["t"]), ",")


def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; the ledger starts empty."""
    ledger, where = update_ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = findings(ledger, where)
    base = tuple(r for r in RULES if r.base)
    numbers = [
        F.coalesce(F.array_size(F.try_element_at("spans", F.lit(r.kind))), F.lit(0)).cast("long").alias(f"n_{r.kind}")
        for r in base
    ]
    return found.select(
        "doc_id", *numbers,
        F.sha2(spans_text(F.col("spans"), base), 256).alias("base_sha256"),
        spans_text(F.col("spans"), RULES).alias("spans"),
    )
