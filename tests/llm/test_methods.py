"""The methods behind the operators, on small made cases."""

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusblocks.llm import bpe_automaton, fingerprints, graph, language_id, mixing, neighbours, secrets, simhash
from corpusblocks.llm import token_counts, toxicity


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab", min_size=1, max_size=14), st.lists(st.integers(0, 10**6), max_size=9))
def test_automaton_is_merging_by_rank(word, picks):
    labels, merges = ["a", "b"], []
    for pick in picks:
        u, v = pick % len(labels), pick // len(labels) % len(labels)
        if labels[u] + labels[v] not in labels:
            labels.append(labels[u] + labels[v])
            merges.append((u, v, len(labels) - 1))
    ids = [labels.index(c) for c in word]
    ranks = {(u, v): (rank, made) for rank, (u, v, made) in enumerate(merges)}
    while pairs := [(ranks[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]:
        (_, made), i = min(pairs)
        ids[i : i + 2] = [made]
    assert bpe_automaton.MergeAutomaton(labels, merges).run(word) == ids


TEXTS = [
    "", " ", "a" * 5000, "x \x1c y\x1fz　w", "ΣΑΣ İI ﬁ ½²Ⅻ don't WE'LL", "日本語 テキスト\n\n 😀😀 <|startoftext|><|endoftext|>a",
    "é ẛ̣ Å", "tabs\t\tand\r\nlines  " * 300, "noblanks" * 900, "1234567890" * 200,
]


def test_word_tokenizer_is_the_library():
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    library, own, decoder = Tokenizer.from_file(path), bpe_automaton.load(path), bpe_automaton.load_decoder(path)
    for text in TEXTS:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == ids
        assert decoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_round_trip_is_encoding_then_decoding(spark, docs):
    path = P.path("word_bpe_49k.json")
    apart = bpe_automaton.decode(bpe_automaton.encode(docs.select("text"), path), path)
    together = bpe_automaton.round_trip(docs.select("text"), path)
    assert sorted(apart.collect(), key=repr) == sorted(together.select(*apart.columns).collect(), key=repr)


@pytest.mark.parametrize("chunk, overlap", [(16_384, 256), (200, 8), (31, 1)])
@pytest.mark.parametrize("ranks", [None, "byte_bpe_50k.tiktoken"])
def test_spliced_counts_are_whole_counts(chunk, overlap, ranks):
    encoder = token_counts.load(P.path("byte_bpe_50k.json"), ranks and P.path(ranks))
    for text in TEXTS:
        whole = len(encoder.tokenizer.encode(text, add_special_tokens=False).ids)
        assert token_counts.splice_count(encoder, text, chunk, overlap) == whole


def test_fingerprints_are_homomorphic():
    a, b = "one paragraph of some length\nanother paragraph here", "a third paragraph, longer than both"
    both = fingerprints.fingerprint(a + "\n" + b)
    assert np.array_equal(both, fingerprints.combine(fingerprints.fingerprint(a), fingerprints.fingerprint(b)))
    assert np.array_equal(both, fingerprints.fingerprint(b + "\n" + a))
    assert np.array_equal(fingerprints.combine(both, fingerprints.fingerprint(b), -1), fingerprints.fingerprint(a))
    assert fingerprints.likeness(both, fingerprints.fingerprint("other words altogether, none shared")) < 0.4
    assert fingerprints.to_text(both) != fingerprints.to_text(fingerprints.fingerprint(a + b))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abc", max_size=40), st.text(alphabet="abcd", max_size=60))
def test_phrases_are_longest_matches(sample, text):
    model = language_id.Model((("x", sample),))
    at = phrases = 0
    while at < len(text):
        size = 0
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        at += size + 1
        phrases += 1
    assert model.parse([model.encode(text)])[0, 0] == phrases if text else True


def test_languages_are_told_without_samples_of_others(spark, docs):
    assert {r["lang_pred"] for r in language_id.predict(docs, ()).collect()} == {"und"}


def test_folding_and_lexicon():
    assert toxicity.fold("1D10T") == toxicity.fold("idiot") == toxicity.fold("іdіоt")
    lexicon = toxicity.Lexicon((("idi", 2.0), ("trash ", 1.0)), frozenset({"trash can"}))
    matcher = toxicity.Matcher(lexicon)
    assert matcher.load("an idiot") == 100.0 and matcher.load("the trash can") == 0.0
    assert matcher.load("trashy") == 0.0 and matcher.load("rigid id") == 0.0 and matcher.load("") == 0.0


def test_steps_never_fall():
    limits, chances = toxicity.steps([(0.0, 1, 99), (1.0, 9, 1), (2.0, 3, 7), (3.0, 9, 0)], 22, 107)
    assert list(chances) == sorted(chances) and len(limits) == len(chances) - 1


def test_ledger_scans_new_pairs_only(spark, docs):
    ledger, where = secrets.update_ledger(docs)
    blobs = where.select("blob").distinct().count()
    assert ledger.count() == blobs * len(secrets.RULES)
    more = docs.where("doc_id <= 3").unionByName(spark.createDataFrame([(99, "token = abcdefghij", None, None, 1)], docs.schema))
    grown, again = secrets.update_ledger(more, ledger)
    assert grown.count() == (blobs + 1) * len(secrets.RULES) == grown.select("blob", "kind", "version").distinct().count()
    found = {r["doc_id"]: r["spans"] for r in secrets.findings(grown, again).collect()}
    assert [(s["start"], s["end"]) for s in found[99]["assign"]] == [(0, 18)] and found[1] is None
    newer = (secrets.Rule("assign", "abc", version=2), *secrets.RULES[1:])
    last, where = secrets.update_ledger(more, grown, newer)
    assert last.count() == grown.count() + where.select("blob").distinct().count()
    assert [(s["start"], s["end"]) for s in {
        r["doc_id"]: r["spans"] for r in secrets.findings(last, where, newer).collect()
    }[99]["assign"]] == [(8, 11)]


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=40), st.integers(0, 3))
def test_tree_links_span_the_groups(keys, radius):
    keys = sorted(keys | {k ^ 5 for k in list(keys)[:10]})
    tree = simhash.BKTree(radius)
    group = {k: k for k in keys}
    truth = dict(group)

    def root(g, k):
        while g[k] != k:
            k = g[k]
        return k

    for key in keys:
        for other in tree.add(key):
            assert (key ^ other).bit_count() <= radius
            group[root(group, key)] = root(group, other)
    for a in keys:
        for b in keys:
            if (a ^ b).bit_count() <= radius:
                truth[root(truth, a)] = root(truth, b)
    assert all((root(group, a) == root(group, b)) == (root(truth, a) == root(truth, b)) for a in keys for b in keys)


def test_large_shards_are_dealt_again(spark):
    base = 0x0123456789ABCDEF
    values = sorted({base ^ (1 << a) ^ (1 << b) for a in range(0, 60, 3) for b in range(1, 60, 3)})
    prints = spark.createDataFrame([(v - 2**64 if v >> 63 else v,) for v in values], "fingerprint long")
    found = {}
    for limit in (4, 10_000):
        links = simhash.fingerprint_links(prints, shard=limit)
        found[limit] = {(r["node"], r["component"]) for r in graph.connected_components(links).collect()}
    assert found[4] == found[10_000]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = dict(graph.connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {k: 100 for k in range(100, 140)}


def test_targets_stop_and_share_again(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), (None, 100), ("c", 0)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    assert got["a"] == 20.0 and got["c"] == 0.0 and sum(got.values()) == pytest.approx(315)
    assert got[None] == pytest.approx(200.0) and got["b"] == pytest.approx(95.0)


def test_graph_recall_on_clusters():
    random = np.random.default_rng(3)
    centres = random.normal(size=(20, 24))
    vectors = centres[random.integers(0, 20, 3000)] + random.normal(size=(3000, 24)) * random.uniform(0.3, 2, (3000, 1))
    points = neighbours._lifted(vectors)
    graph_, entries = neighbours.build(points)
    queries = vectors[::30]
    lifted = np.concatenate([queries / np.linalg.norm(queries, axis=1, keepdims=True), np.zeros((100, 1))], 1)
    found, _ = neighbours._beam(points, graph_, lifted.astype(np.float32), entries, neighbours.QUERY_BEAM)
    truth = np.argsort(-(queries @ vectors.T), 1)[:, :20]
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(truth, found)]) >= 0.95
