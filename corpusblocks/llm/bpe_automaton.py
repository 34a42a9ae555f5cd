"""BPE encoding and decoding by a merge automaton.

The merges are compiled, in rank order, into a deterministic automaton over tokens.
It starts as one state with a loop for every base symbol, and every merge
``(u, v) -> uv`` adds one gadget: all arcs ``u`` now lead to a copy of their target
without the arc ``v``, and every state with an arc ``u`` gets an arc ``uv`` to where
``u v`` led. What the automaton accepts at the end are exactly the token sequences the
merges produce. A gadget copies a state's arcs, so tens of thousands of them would
not fit a table of all arcs; a state is therefore kept as what its gadget changed
against the state it was copied from, and an arc that has been looked up stays in a
transition table.

All arcs with one label lead to one state, so states are named by the token that leads
to them. A word is run from left to right along the labels that stand in it, with the
longest first, to the one path that the automaton accepts. Decoding emits the labels
of the arcs.

Words repeat, so their ids are kept in a table of at most ``WORDS`` entries per worker.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusblocks.llm.common import add_columns, held, table

#: Entries of the table of words a worker keeps, and of looked-up arcs.
WORDS = 180_000
ARCS = 200_000
#: Words longer than this are not kept.
LONG = 64

# The word pattern and the white space of the vocabulary file.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
WORD_END = "</w>"
#: What ``str.split`` takes for white space and the vocabulary does not.
SEPARATORS = "\x1c\x1d\x1e\x1f"

START = -1
#: No token, and a token still to be looked up.
NONE, LOOK = -1, -2


def _byte_letters() -> dict[str, int]:
    """The letters that stand for the 256 bytes in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others follow from U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class MergeAutomaton:
    """Token automaton of a merge list.

    ``labels`` holds every token as a string of base symbols, ``merges`` the pairs of
    token ids by rank with the id each makes.
    """

    def __init__(self, labels: list[str], merges: list[tuple[int, int, int]]):
        self.lengths = [len(label) for label in labels]
        self.born = [-1] * len(labels)  # rank of the gadget that made the token's arc; -1: base symbol
        self.left = [START] * len(labels)
        self.right = [START] * len(labels)  # the state a token's state was copied from
        self.cut: dict[tuple[int, int], int] = {}  # (state, arc): rank of the gadget that removed it
        self.table: dict[int, bool] = {}
        self.final = len(merges)
        for rank, (u, v, made) in enumerate(merges):
            if made != u and made != v and self.born[made] < 0 and len(labels[made]) > 1:
                self._gadget(rank, u, v, made)
        self.tokens = {label: token for token, label in enumerate(labels) if label and self._live(token)}
        self.shorter = [NONE] * len(labels)  # the longest other token at the start of the token's label
        for label, token in self.tokens.items():
            starts = (self.tokens.get(label[:k]) for k in range(len(label) - 1, 0, -1))
            self.shorter[token] = next((t for t in starts if t is not None), NONE)
        self.reach: dict[str, int] = {}  # the longest label by its first three symbols
        for label in self.tokens:
            self.reach[label[:3]] = max(self.reach.get(label[:3], 0), len(label))

    def _gadget(self, rank: int, u: int, v: int, made: int) -> None:
        if not (self._live(u) and self._live(v) and self._has(u, v, rank)):
            return  # the pair never stands side by side: the merge is dead
        self.cut[(u, v)] = rank
        self.born[made], self.left[made], self.right[made] = rank, u, v

    def _live(self, token: int) -> bool:
        return self.lengths[token] == 1 or self.born[token] >= 0

    def _has(self, state: int, token: int, rank: int) -> bool:
        """Whether ``state`` has the arc ``token`` once the gadgets below ``rank`` are in place."""
        born, cut = self.born, self.cut
        while state != START:
            if cut.get((state, token), rank) < rank:
                return False
            made, copied = born[token], born[state]
            if made < 0 and copied < 0:
                return True
            if made >= copied:  # the arc came with the state's own or a later gadget, which asked for the arc of its left part
                token, rank = self.left[token], made + 1
            else:  # the state is a copy that was taken when the arc was there
                state, rank = self.right[state], copied
        return True

    def arc(self, state: int, token: int) -> bool:
        key = (state << 32) + token
        found = self.table.get(key)
        if found is None:
            if len(self.table) >= ARCS:
                self.table.clear()
            found = self.table[key] = self._has(state, token, self.final)
        return found

    def run(self, word: str) -> list[int]:
        """Ids of the accepting path of a word of base symbols.

        Long labels are tried first, and shorter ones only when the path behind a longer one ended. There
        is one accepting path, so a place and state from which the end was not reached are never tried again.
        """
        tokens, table, reach, size = self.tokens.get, self.table.get, self.reach.get, len(word)
        lengths, shorter = self.lengths, self.shorter
        path: list[int] = []
        dead: set[tuple[int, int]] = set()
        place, state, token = 0, START, LOOK
        while place < size:
            if token == LOOK:
                end = min(size, place + reach(word[place : place + 3], 2))
                token = tokens(word[place:end])
                while token is None:
                    end -= 1
                    token = tokens(word[place:end]) if end > place else NONE
            while token != NONE:
                led = True if state == START else table((state << 32) + token)
                if led is None:
                    led = self.arc(state, token)
                if led and not (dead and (place + lengths[token], token) in dead):
                    break
                token = shorter[token]
            if token != NONE:
                path.append(token)
                place, state, token = place + lengths[token], token, LOOK
            else:
                dead.add((place, state))
                last = path.pop()
                place, state, token = place - lengths[last], path[-1] if path else START, shorter[last]
        return path


class Recent:
    """Values by key, the least recently used half dropped when ``most`` keys are held."""

    def __init__(self, most: int):
        self.half = most // 2
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, key: str) -> bytes | None:
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> None:
        if len(key) <= LONG:
            if len(self.new) >= self.half:
                self.old, self.new = self.new, {}
            self.new[key] = value


class WordTokenizer:
    """Encoder and decoder of a vocabulary with word ends, lower-case words and white space dropped."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = spec["model"]["vocab"]
        self.tokens = [""] * (max(max(vocabulary.values()), *(t["id"] for t in spec["added_tokens"])) + 1)
        for token, i in vocabulary.items():
            self.tokens[i] = token
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.tokens[i] = token
        letters = _byte_letters()

        def symbols(token: str) -> str:
            ended = token.endswith(WORD_END)
            body = [letters[c] for c in (token[: -len(WORD_END)] if ended else token)]
            if ended and body:
                body[-1] += 256
            return "".join(map(chr, body))

        ordinary = [t if t not in self.special else None for t in self.tokens]
        labels = [symbols(t) if t is not None else "" for i, t in enumerate(ordinary)]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.automaton = MergeAutomaton(
            labels, [(vocabulary[u], vocabulary[v], vocabulary[u + v]) for u, v in merges]
        )
        self.words = regex.compile(WORD_PATTERN)
        self.blank = regex.compile(r"\p{White_Space}+")
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.pieces = Recent(WORDS)  # ids, four bytes each, of what stands between white space
        self.paths = Recent(WORDS // 4)  # and of a word of the pattern

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece without white space."""
        ids = self.pieces.get(piece)
        if ids is not None:
            return ids
        if piece.isascii() and piece.isalpha():  # one word of the pattern
            ids = self.paths.get(piece) or self._word(piece)
        else:
            ids = b"".join([self.paths.get(word) or self._word(word) for word in self.words.findall(piece)])
        self.pieces.put(piece, ids)
        return ids

    def _word(self, word: str) -> bytes:
        """Ids of a word of the pattern."""
        raw = word if word.isascii() else word.encode("utf-8").decode("latin-1")
        path = array("i", self.automaton.run(raw[:-1] + chr(ord(raw[-1]) + 256))).tobytes()
        self.paths.put(word, path)
        return path

    def _plain(self, text: str) -> bytes:
        # Lower-casing goes character by character: no special form for a sigma at the end of a word.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        found = self.blank.split(text) if any(c in text for c in SEPARATORS) else text.split()
        known = self.pieces.new.get
        return b"".join([known(p) or self._piece(p) for p in found])

    def encode(self, text: str) -> np.ndarray:
        if self.specials is None or "<" not in text:
            return np.frombuffer(self._plain(text), np.int32)
        parts = self.specials.split(text)
        ids = [np.int32(self.special[p]).tobytes() if i % 2 else self._plain(p) for i, p in enumerate(parts)]
        return np.frombuffer(b"".join(ids), np.int32)


class WordDecoder:
    """Arc labels by id; a vocabulary file without a decoder joins them by a space."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        labels = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: sys.intern(token) for token, i in labels.items()}

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


def load(path: str) -> WordTokenizer:
    return held(WordTokenizer, path)


@lru_cache(maxsize=2)
def load_decoder(path: str) -> WordDecoder:
    return WordDecoder(path)


def encode(df: DataFrame, path: str, column: str = "text", out: str = "ids") -> DataFrame:
    """Add the token ids of each whole text; null and empty texts get no ids."""

    def compute(batch: pa.Table) -> dict[str, pa.Array]:
        tokenizer = load(path)
        parts = [tokenizer.encode(text.as_py() or "") for text in batch.column(0)]
        offsets = np.cumsum([0, *map(len, parts)], dtype=np.int32)
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        return {out: pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))}

    return add_columns(df, [column], f"{out} array<int>", compute)


def decode(df: DataFrame, path: str, column: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text that ids stand for; no ids (or null) give the empty text."""

    def compute(batch: pa.Table) -> dict[str, list]:
        decoder = load_decoder(path)
        rows = (ids.values.to_numpy().tolist() if ids.is_valid else [] for ids in batch.column(0))
        return {out: [decoder.decode(ids) for ids in rows]}

    return add_columns(df, [column], f"{out} string", compute)


def round_trip(
    df: DataFrame, path: str, column: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``encode`` and then ``decode`` of its ids, in one pass: half as many workers hold a vocabulary."""

    def compute(batch: pa.Table) -> dict[str, pa.Array | list]:
        tokenizer, decoder = load(path), load_decoder(path)
        parts = [tokenizer.encode(text.as_py() or "") for text in batch.column(0)]
        offsets = np.cumsum([0, *map(len, parts)], dtype=np.int32)
        values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        return {
            ids: pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
            decoded: [decoder.decode(part.tolist()) for part in parts],
        }

    return add_columns(df, [column], f"{ids} array<int>, {decoded} string", compute)


def ids_text(column: str = "ids") -> Column:
    """Decimal ids joined by one space."""
    return F.array_join(F.col(column).cast("array<string>"), " ")


def op1_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = round_trip(docs, path)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids_text(), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
