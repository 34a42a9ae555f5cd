"""Alignment of two tokenizers against a plain version over all links."""

import hashlib
import os
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

from corpusblocks.llm import alignment


def plain(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    byte_of = alignment._byte_level()
    a_bytes = [bytes(byte_of[c] for c in a.id_to_token(i) or "" if c in byte_of) for i in range(a.get_vocab_size())]

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    texts, counts = [], Counter()
    for _, text in rows:
        wanted = (" " + (text or "")).encode()
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        if b"".join(map(a_bytes.__getitem__, x)) != wanted or b"".join(map(b_bytes, y)) != wanted:
            x, y = [], []
        i = j = at_a = at_b = 0
        groups, links = [], []
        while i < len(x):
            own = ([x[i]], [y[j]])
            at_a, at_b = at_a + len(a_bytes[x[i]]), at_b + len(b_bytes(y[j]))
            while at_a != at_b:
                if at_a < at_b:
                    i += 1
                    at_a += len(a_bytes[x[i]])
                    own[0].append(x[i])
                else:
                    j += 1
                    at_b += len(b_bytes(y[j]))
                    own[1].append(y[j])
            groups.append("|".join(",".join(map(str, side)) for side in own))
            links.append((x[i], y[j]))
            i, j = i + 1, j + 1
        counts.update(links)
        texts.append((len(x), len(y), groups, links))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for (key, _), (n_a, n_b, groups, links) in zip(rows, texts):
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        best = sum(counts[p] == most[p[1]] for p in links)
        out.append((key, n_a, n_b, len(groups), len(links), best, sum(counts[p] for p in links), digest))
    return out, counts, Counter(p for _, _, _, links in texts for p in set(links))


ODD = [
    (21, "tabs\tand  runs of   spaces \n\n and a trailing one "), (22, "▁ stands for a space"), (23, "a▁b"),
    (24, "日本語のテキスト 😀 é   　x"), (25, "<|endoftext|> <s> </s> <unk> <0x41>"), (26, " "), (27, "\x00\x01 nul"),
    (28, "x" * 5000), (29, "the the the the the " * 40), (29, "the the the the the " * 40),
]


@pytest.fixture(params=["folder", "sf", "odd"])
def documents(request, spark, folder, sf_dir):
    if request.param == "odd":
        return spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)
    path = folder if request.param == "folder" else sf_dir
    return spark.read.parquet(f"{path}/documents.parquet")


def test_documents_and_pairs(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    expected, counts, holders = plain(rows)
    paths = tuple(P.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))
    index = alignment.inverted_index(documents, paths)
    got = [tuple(r) for r in alignment.aligned_documents(index).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    pairs = alignment.pair_counts(index).collect()
    assert {(r["a"], r["b"]): r["links"] for r in pairs} == counts
    assert {(r["a"], r["b"]): r["documents"] for r in pairs} == holders


def test_planes_hold_lists_and_bitmaps():
    rng = np.random.default_rng(3)
    pair = np.repeat([7, 9, 11], [1, alignment.DENSE, 900])
    place = np.concatenate([np.sort(rng.choice(alignment.BLOCK, n, replace=False)) for n in (1, alignment.DENSE, 900)])
    count = rng.integers(1, 70, len(pair))
    back = Counter()
    for digit, pairs, found, population in alignment.planes(pair, place, count):
        row, at = alignment.members(found)
        assert np.bincount(row, minlength=len(pairs)).tolist() == population.tolist()
        for r, p in zip(row, at):
            back[int(pairs[r]), int(p)] += 1 << max(0, digit)
    assert back == Counter(dict(zip(zip(pair.tolist(), place.tolist()), count.tolist())))


def test_blocks_end_early_without_losing_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    paths = tuple(P.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))
    whole, cut = (alignment.inverted_index(docs, paths, n) for n in (alignment.BLOCK_POSTINGS, 1))
    assert cut.select("block").distinct().count() >= whole.select("block").distinct().count()
    results = [sorted(map(tuple, alignment.aligned_documents(i).collect())) for i in (whole, cut)]
    assert results[0] == results[1] and len(results[0]) == 60
