"""Lines, splits, encoding and packing against plain Python models."""

import random

import pytest
from pyspark.sql import functions as F

from corpusblocks.functions import ids as idf
from corpusblocks.functions import text as tx
from corpusblocks.operators import bpe, codec, packing
from corpusblocks.operators.prefix import Order, dense_levels, exclusive_prefix
from corpusblocks.plans import corpus
from corpusblocks.sources import documents, text_files

WILD = ["  a  b ", "\t x　", "", "   ", "\x1c\x1dq\x85", "​z​", "a\tb", "é😀 ▁", "\xa0 \n".strip("\n")]


def py_lines(text):
    out = []
    for i, raw in enumerate(text.replace("\r\n", "\n").replace("\r", "\n").split("\n")):
        if raw.strip():
            out.append((i, raw.strip()))
    return out


def test_strip_equals_python_on_every_code_point(spark):
    points = [c for c in range(1, 0x3100) if c not in (0x0A, 0x0D)]
    rows = [(c, f"{chr(c)}{chr(c)}x{chr(c)}y{chr(c)}") for c in points]
    df = spark.createDataFrame(rows, "c int, s string")
    got = {r["c"]: r["t"] for r in df.select("c", tx.strip(F.col("s")).alias("t")).collect()}
    assert got == {c: s.strip() for c, s in rows}


def test_document_lines(spark):
    texts = ["a\r\nb\rc\n\n d \n", "\n\r\n", "one", "\n".join(WILD), "x\r\r\ny"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(r) for r in documents.document_lines(docs).orderBy("doc_id", "line_no").collect()]
    assert got == [(d, i, line) for d, t in enumerate(texts) for i, line in py_lines(t)]


def test_text_files(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    train = "first\r\n\n  second \rthird\n"
    (folder / "train.txt").write_bytes(train.encode())
    (folder / "val.txt").write_text("v one\n", encoding="utf-8")
    (folder / "notes.txt").write_text("ignored\n", encoding="utf-8")
    rows = text_files.read_text_corpus(spark, str(folder)).orderBy("split", "block_start", "line_no").collect()
    assert [(r["split"], r["line"]) for r in rows] == [
        ("train", "first"), ("train", "second"), ("train", "third"), ("val", "v one")]
    single = text_files.read_text_corpus(spark, str(folder / "notes.txt")).collect()
    assert [(r["split"], r["line"]) for r in single] == [("notes", "ignored")]
    only = text_files.read_text_corpus(spark, str(folder), splits=["val", " test "]).collect()
    assert [r["split"] for r in only] == ["val"]


def test_text_files_pack_in_file_order_over_many_blocks(spark, tmp_path):
    lines = [f"line {i} " + "abc " * (i % 7) for i in range(3000)]
    (tmp_path / "train.txt").write_text("\n".join(lines), encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = text_files.read_text_corpus(spark, str(tmp_path))
        assert rows.select("block_start").distinct().count() > 5
        trained = corpus.train_tokenizer(rows, merges=5)
        examples = corpus.encode_corpus(rows, trained.tokenizer)
        blocks = packing.pack_blocks(examples, text_files.text_order(rows), 32, 10)
        got = [r["tokens"] for r in blocks.orderBy("block_id").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    segment = codec.segmenter(trained.tokenizer)
    stream = [t for line in lines for t in wrapped(segment, line.strip())]
    assert got == greedy(stream, 32)


def wrapped(segment, line):
    return [2, *(t for w in line.split(" ") if w for t in segment(tx.WORD_MARK + w)), 3]


def greedy(stream, n):
    buffer, out = [], []
    for token in stream:
        buffer.append(token)
        if len(buffer) == n:
            out.append(buffer)
            buffer = []
    return out


def test_split_is_a_function_of_the_key_and_near_the_ratios(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    split = documents.assign_splits(ids)
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert abs(counts["train"] - 19_600) < 120 and abs(counts["val"] - 200) < 60 and abs(counts["test"] - 200) < 60
    again = documents.assign_splits(ids.repartition(7))
    assert split.exceptAll(again).isEmpty()
    assert not split.exceptAll(documents.assign_splits(ids, seed=1)).isEmpty()
    even = documents.assign_splits(ids, train=0.5, val=0.5)
    assert even.where("split = 'test'").isEmpty()


@pytest.mark.parametrize("agg", ["sum", "min"])
@pytest.mark.parametrize("spread", ["dense", "sparse", "negative"])
def test_exclusive_prefix(spark, agg, spread):
    rng = random.Random(spread)
    keys = {
        "dense": range(5000),
        "sparse": sorted(rng.sample(range(1 << 62), 500)) + [*range(300)],
        "negative": range(-3000, 3000, 3),
    }[spread]
    # One group holds nearly all rows.
    rows = [("hot" if rng.random() < 0.9 else "cold", k, rng.randint(1, 1000)) for k in dict.fromkeys(keys)]
    df = spark.createDataFrame(rows, "g string, k long, v long").repartition(6)
    order = Order(("g",), ("k",), dense_levels(df, "k", first_bits=6))
    got = {(r["g"], r["k"]): r["o"] for r in exclusive_prefix(df, order, F.col("v"), "o", agg).collect()}
    want, state = {}, {}
    for g, k, v in sorted(rows, key=lambda r: r[1]):
        seen = state.setdefault(g, [])
        want[g, k] = sum(seen) if agg == "sum" else min(seen, default=None)
        seen.append(v)
        if agg == "min":
            state[g] = [min(seen)]
    assert got == want


@pytest.mark.parametrize("seed", range(3))
def test_packing_equals_greedy_filling(spark, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice(["train", "train", "val"]), d, i, [rng.randint(0, 999) for _ in range(rng.choice([1, 2, 5, 8, 100]))])
        for d in range(120) for i in range(rng.randint(0, 3))
    ]
    df = spark.createDataFrame(rows, "split string, doc_id long, line_no int, ids array<int>").repartition(1 + 3 * seed)
    for n, per_shard in ((8, 4), (64, 1)):
        blocks = packing.pack_blocks(df, documents.document_order(df), n, per_shard)
        got = {}
        for r in blocks.orderBy("split", "block_id").collect():
            mine = got.setdefault(r["split"], [])
            assert r["block_id"] == len(mine) == r["shard_id"] * per_shard + r["local_index"]
            mine.append(r["tokens"])
        for split in ("train", "val"):
            stream = [t for s, _, _, ids in sorted(rows, key=lambda r: r[1:3]) if s == split for t in ids]
            assert got.get(split, []) == greedy(stream, n)
        totals = {r["split"]: r for r in packing.packing_totals(df, n).collect()}
        for split, r in totals.items():
            assert r["blocks"] == len(got.get(split, [])) and r["tokens"] == r["blocks"] * n + r["dropped_tokens"]


def test_one_example_longer_than_many_blocks_and_an_exact_fit(spark):
    rows = [("train", 0, 0, list(range(1000))), ("train", 1, 0, list(range(24)))]
    df = spark.createDataFrame(rows, "split string, doc_id long, line_no int, ids array<int>")
    blocks = packing.pack_blocks(df, documents.document_order(df), 256, 2)
    assert [r["tokens"] for r in blocks.orderBy("block_id").collect()] == greedy([*range(1000), *range(24)], 256)
    assert blocks.count() == 4
    assert packing.pack_blocks(df, documents.document_order(df), 2000).isEmpty()


def test_short_blocks_cross_by_shard_not_one_by_one(spark):
    """What is shuffled by runs of shards does not grow with the number of blocks."""
    df = spark.createDataFrame([("train", 0, 0, list(range(50)))], "split string, doc_id long, line_no int, ids array<int>")
    blocks = packing.pack_blocks(df, documents.document_order(df), 1, 20)
    assert [r["tokens"] for r in blocks.orderBy("block_id").collect()] == [[i] for i in range(50)]
    shipped = blocks._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1]
    assert "shard_id" in shipped and "block_id" not in shipped


def test_empty_corpus(spark):
    df = spark.createDataFrame([], "split string, doc_id long, line_no int, ids array<int>")
    assert packing.pack_blocks(df, documents.document_order(df)).isEmpty()
    assert packing.packing_totals(df).isEmpty()


def test_encode_equals_replaying_merges_and_decodes_back(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeéß😀") for _ in range(rng.randint(1, 7))) for _ in range(200)]
    words += ["abcab" * 40, "é" * 130]  # beyond the length that is cached
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 12))) for _ in range(150)]
    lines = spark.createDataFrame([(t,) for t in texts], "line string")
    trained = corpus.train_tokenizer(lines, merges=80)
    unseen = [*texts, "zebra ñ\t[EOS] x  y", "▁"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(unseen)], "i int, line string").repartition(3)
    encoded = df.withColumn("ids", codec.encoder(trained.tokenizer)(F.col("line")))
    decoded = {r["i"]: r for r in codec.decode_ids(encoded, trained.vocab).collect()}
    ids = trained.tokenizer.ids
    for i, text in enumerate(unseen):
        want = []
        for word in filter(None, text.split(" ")):
            s = "".join(f" {ch} " for ch in tx.WORD_MARK + word)
            for left, right in trained.tokenizer.merges:
                s = s.replace(f" {left}  {right} ", f" {left}{right} ")
            for symbol in s[1:-1].split("  "):
                want += [ids[symbol]] if symbol in ids else [4 + b for b in symbol.encode()]
        assert decoded[i]["ids"] == want
        assert decoded[i]["text"].strip() == " ".join(filter(None, text.split(" "))).replace("▁", " ").strip()


def test_decode_drops_markers_keeps_unknown_and_survives_bad_bytes(spark):
    vocab = bpe.vocabulary(spark, [("▁", 3), ("a", 2)])
    df = spark.createDataFrame([(1, [2, 260, 261, 1, 3, 0]), (2, [4 + 0xC3, 261]), (3, []), (4, [4 + 0xC3, 4 + 0xA9])], "i int, ids array<int>")
    got = {r["i"]: r["text"] for r in codec.decode_ids(df, vocab).collect()}
    assert got == {1: "a ⁇ ", 2: "�a", 3: "", 4: "é"}


def test_piece_and_id_lookup(spark):
    vocab = bpe.vocabulary(spark, [("▁", 3), ("a", 2)])
    pieces = spark.createDataFrame([("a",), ("[BOS]",), ("zz",)], "piece string")
    assert {r[0]: r[1] for r in codec.piece_ids(pieces, vocab).collect()} == {"a": 261, "[BOS]": 2, "zz": 1}
    ids = spark.createDataFrame([(3,), (14,), (999,)], "token_id int")
    assert {r[0]: r[1] for r in codec.id_pieces(ids, vocab).collect()} == {3: "[EOS]", 14: "<0x0A>", 999: None}
    assert codec.vocab_size(vocab).first()[0] == 262


def test_id_expressions(spark):
    df = spark.createDataFrame([([5, 6, 7, 8],), ([9],), ([],)], "t array<int>")
    t = F.col("t")
    rows = df.select(idf.inputs(t), idf.targets(t), idf.last_ids(t, 2), idf.wrap(t), idf.without_markers(idf.wrap(t))).collect()
    assert [list(r) for r in rows] == [
        [[5, 6, 7], [6, 7, 8], [7, 8], [2, 5, 6, 7, 8, 3], [5, 6, 7, 8]],
        [[], [], [9], [2, 9, 3], [9]],
        [[], [], [], [2, 3], []],
    ]
    widths = spark.createDataFrame([(65535,), (65536,)], "m int").select(idf.id_width(F.col("m")))
    assert [r[0] for r in widths.collect()] == ["uint16", "uint32"]
    utf8 = spark.createDataFrame([("é😀",)], "c string").select(codec.utf8_ids(F.col("c"))).first()[0]
    assert utf8 == [4 + b for b in "é😀".encode()]


def test_folders_and_files_are_told_by_the_file_system(spark, tmp_path):
    folder = tmp_path / "v1.0"
    folder.mkdir()
    (folder / "train.txt").write_text("one\ntwo\n")
    (folder / "notes.txt").write_text("stray\n")
    rows = text_files.read_text_corpus(spark, str(folder)).collect()
    assert [(r["split"], r["line"]) for r in rows] == [("train", "one"), ("train", "two")]
    (tmp_path / "train").write_text("only\n")
    assert [(r["split"], r["line"]) for r in text_files.read_text_corpus(spark, str(tmp_path / "train")).collect()] == [
        ("train", "only")
    ]
    with pytest.raises(FileNotFoundError):
        text_files.read_text_corpus(spark, str(tmp_path / "absent"))
    (tmp_path / "none").mkdir()
    assert text_files.read_text_corpus(spark, str(tmp_path / "none")).collect() == []


def test_a_long_document_is_split_into_buckets(spark):
    lines = spark.range(100_000).select(
        F.lit("train").alias("split"), F.lit(7).cast("long").alias("doc_id"), F.col("id").cast("int").alias("line_no"),
        F.array(F.lit(1)).alias("ids"),
    )
    order = documents.document_order(lines)
    assert lines.groupBy(order.levels[0]).count().agg(F.max("count")).first()[0] <= 4096
    offsets = packing.token_offsets(lines, order)
    assert offsets.where(F.col("first_token") != F.col("line_no")).count() == 0


def test_scratch_is_shared_and_released(spark):
    import os

    from corpusblocks.session import materialize, release, scratch_root

    assert scratch_root(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    written = materialize(spark.range(3), "three")
    (file,) = [f for f in written.inputFiles() if f.endswith(".parquet")][:1]
    assert os.path.exists(file.removeprefix("file://"))
    # Other tests keep their tables below the same folder: only its name is checked here.
    assert f"corpusblocks-{spark.sparkContext.applicationId}" in file and callable(release)


def test_character_ids_equal_the_segmenter(spark):
    """Encoding without merges is an expression: no Python node, and the ids of the plain segmenter."""
    from corpusblocks.operators import codec

    ids = {c: 260 + i for i, c in enumerate("▁abcé😀" + chr(0xF0104) + "$\\")}
    tokenizer = codec.Tokenizer((), ids)
    segment = tokenizer.segmenter()
    texts = ["", "  ", "abc", "a  b   c", "é😀 b", "xyz", "a x b日", chr(0xF0104), chr(0xF0105) + "a", "a\tb", "▁ ▁a", "$a\\ $", "a" * 3000]
    frame = spark.createDataFrame([(t,) for t in [*texts, None]], "line string")
    encoded = frame.withColumn("ids", codec.line_ids(F.col("line"), tokenizer))
    assert "Python" not in encoded._jdf.queryExecution().toString()
    for r in encoded.collect():
        want = [i for w in (r["line"] or "").split(" ") if w for i in segment("▁" + w)]
        assert r["ids"] == want, r["line"]
