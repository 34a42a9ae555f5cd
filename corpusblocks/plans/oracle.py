"""SQL statements with the results of the catalog queries, for an independent engine (DuckDB)."""

from __future__ import annotations

from corpusblocks.plans import catalog as c

# Stated here again, so that the operators' own values are checked.
_TARGET_BATCH_TOKENS = 8192
_BATCH = max(1, _TARGET_BATCH_TOKENS // c.SEQ_LEN)

_SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_MARK = "▁"

_LINES = rf"""
docs AS (
  SELECT doc_id, text, CAST('0x' || substr(md5('{c.SEED}:' || doc_id), 1, 8) AS BIGINT) % 10000 AS bucket
  FROM documents),
split_docs AS (
  SELECT *, CASE WHEN bucket < 9800 THEN 'train' WHEN bucket < 9900 THEN 'val' ELSE 'test' END AS split
  FROM docs),
raw_lines AS (
  SELECT doc_id, split, unnest(a) AS raw, unnest(range(len(a))) AS line_no
  FROM (SELECT doc_id, split, string_split_regex(text, '\r\n|\r|\n') AS a FROM split_docs)),
lines AS MATERIALIZED (
  SELECT doc_id, split, CAST(line_no AS INT) AS line_no, line
  FROM (SELECT doc_id, split, line_no,
          regexp_replace(raw, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g') AS line FROM raw_lines)
  WHERE line <> '')"""



def _words(prompts: bool = False) -> str:
    """Distinct words with their frequency in the training split; words of prompts take no part in training."""
    asked = f"""
  UNION ALL SELECT '{_MARK}' || w, 'prompt' FROM (SELECT unnest(string_split(text, ' ')) AS w FROM conversations) WHERE w <> ''"""
    return f"""
occurrences AS (
  SELECT '{_MARK}' || w AS word, split FROM (SELECT split, unnest(string_split(line, ' ')) AS w FROM lines)
  WHERE w <> ''{asked if prompts else ''}),
words AS MATERIALIZED (
  SELECT word, CAST(count(*) FILTER (split = 'train') AS BIGINT) AS freq FROM occurrences GROUP BY word),
chars AS MATERIALIZED (
  SELECT ch, CAST(sum(freq) AS BIGINT) AS freq
  FROM (SELECT unnest(regexp_extract_all(word, '(?s).')) AS ch, freq FROM words WHERE freq > 0) GROUP BY ch)"""


_WORDS = _words()


def _alphabet(coverage: float) -> str:
    return f"""
ranked AS (
  SELECT ch, freq, row_number() OVER (ORDER BY freq DESC, ch) - 1 AS position,
    coalesce(sum(freq) OVER (ORDER BY freq DESC, ch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_,
    sum(freq) OVER () AS all_ FROM chars),
alphabet AS MATERIALIZED (
  SELECT ch, freq, CAST(position AS INT) AS position FROM ranked WHERE before_ < {coverage} * all_)"""


def _pairs(table: str) -> str:
    return f"""SELECT l, r, CAST(sum(freq) AS BIGINT) AS freq FROM (
    SELECT unnest(a[1:len(a) - 1]) AS l, unnest(a[2:]) AS r, freq
    FROM (SELECT string_split(s[2:length(s) - 1], '  ') AS a, freq FROM {table} WHERE freq > 0)
    WHERE len(a) > 1) GROUP BY l, r"""


def _chain(size: int = 0) -> str:
    """All merges that fit a vocabulary of ``size`` beside alphabet, bytes and reserved tokens, one a step.

    Each step counts the pairs of all words again and merges the best one. No string is
    taken to be spelled by two merges, as none is in the given tables.
    """
    start = """
w0 AS MATERIALIZED (
  SELECT word, freq, array_to_string(
    list_transform(regexp_extract_all(word, '(?s).'), lambda x: ' ' || x || ' '), '') AS s FROM words)"""
    if not size:
        return start + """,
merges AS MATERIALIZED (SELECT 0 AS rank, '' AS l, '' AS r, 0::BIGINT AS freq WHERE false),
segmented AS (SELECT word, s FROM w0)"""
    return start + f""",
step AS (
  SELECT 0 AS i, word, freq, s, NULL::VARCHAR AS l, NULL::VARCHAR AS r, 0::BIGINT AS f FROM w0
  UNION ALL
  (WITH best AS ({_pairs("(SELECT s, freq FROM step WHERE word IS NOT NULL AND contains(s, '  '))")}
      ORDER BY freq DESC, l, r LIMIT 1),
    here AS (SELECT max(i) AS i FROM step WHERE word IS NOT NULL)
   SELECT i + 1, word, step.freq, replace(s, ' ' || best.l || '  ' || best.r || ' ', ' ' || best.l || best.r || ' '), NULL, NULL, 0
   FROM step, best WHERE i < {size} - 260 - (SELECT count(*) FROM alphabet) AND word IS NOT NULL AND contains(s, '  ')
   UNION ALL
   SELECT i, NULL, NULL, NULL, l, r, freq FROM best, here WHERE i < {size} - 260 - (SELECT count(*) FROM alphabet))),
merges AS MATERIALIZED (
  SELECT CAST(i AS INT) AS rank, l, r, f AS freq FROM step WHERE word IS NULL),
segmented AS (SELECT word, arg_max(s, i) AS s FROM step WHERE word IS NOT NULL GROUP BY word)"""


_VOCAB = """
pieces AS (
  SELECT piece, freq, row_number() OVER (ORDER BY rank) - 1 AS i
  FROM (SELECT l || r AS piece, arg_min(freq, rank) AS freq, min(rank) AS rank FROM merges GROUP BY 1)),
vocab AS MATERIALIZED (
  SELECT * FROM (VALUES (0, '[PAD]', 'special', 0::BIGINT), (1, '[UNK]', 'special', 0::BIGINT),
    (2, '[BOS]', 'special', 0::BIGINT), (3, '[EOS]', 'special', 0::BIGINT)) t(token_id, piece, kind, freq)
  UNION ALL
  SELECT CAST(i + 4 AS INT), '<0x' || lpad(upper(to_hex(i)), 2, '0') || '>', 'byte', 0::BIGINT FROM range(256) r(i)
  UNION ALL SELECT CAST(260 + i AS INT), piece, 'merge', freq FROM pieces
  UNION ALL
  SELECT CAST(260 + (SELECT count(*) FROM pieces) + position AS INT), ch, 'char', freq FROM alphabet)"""

_BYTES = "list_transform(range(0, len(hex(encode({0}))) // 2), lambda i: CAST('0x' || hex(encode({0}))[2*i+1:2*i+2] AS INT) + 4)"

_ENCODE = f"""
symbol_rows AS (
  SELECT word, unnest(a) AS sym, unnest(range(len(a))) AS pos
  FROM (SELECT word, string_split(s[2:length(s) - 1], '  ') AS a FROM segmented)),
symbol_ids AS (
  SELECT sym, coalesce(CASE WHEN token_id IS NULL THEN NULL ELSE [token_id] END, {_BYTES.format('sym')}) AS ids
  FROM (SELECT DISTINCT sym FROM symbol_rows) LEFT JOIN
    (SELECT piece, token_id FROM vocab WHERE kind IN ('merge', 'char')) ON piece = sym),
word_ids AS MATERIALIZED (
  SELECT word, flatten(list(ids ORDER BY pos)) AS ids FROM symbol_rows JOIN symbol_ids USING (sym) GROUP BY word),
line_words AS (
  SELECT doc_id, line_no, split, '{_MARK}' || w AS word, ord
  FROM (SELECT doc_id, line_no, split, unnest(a) AS w, unnest(range(len(a))) AS ord
        FROM (SELECT *, string_split(line, ' ') AS a FROM lines)) WHERE w <> ''),
encoded AS MATERIALIZED (
  SELECT doc_id, line_no, any_value(split) AS split, flatten(list(ids ORDER BY ord)) AS ids
  FROM line_words JOIN word_ids USING (word) GROUP BY doc_id, line_no),
examples AS MATERIALIZED (
  SELECT doc_id, line_no, split, list_concat(list_concat([2], ids), [3]) AS ids FROM encoded)"""

_BLOCKS = f"""
placed AS (
  SELECT split, ids, coalesce(sum(len(ids)) OVER (PARTITION BY split ORDER BY doc_id, line_no
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_off FROM examples),
stream AS (
  SELECT split, unnest(ids) AS id, CAST(first_off AS BIGINT) + unnest(range(len(ids))) AS off FROM placed),
blocks AS MATERIALIZED (
  SELECT split, off // {c.SEQ_LEN} AS block_id, off // {c.SEQ_LEN} // {c.BLOCKS_PER_SHARD} AS shard_id,
    off // {c.SEQ_LEN} % {c.BLOCKS_PER_SHARD} AS local_index, list(id ORDER BY off) AS tokens
  FROM stream GROUP BY ALL HAVING count(*) = {c.SEQ_LEN})"""

_SHARDS = """
shard_counts AS (SELECT split, shard_id, count(*) AS blocks FROM blocks GROUP BY ALL),
offsets AS (
  SELECT split, shard_id, blocks, CAST(coalesce(sum(blocks) OVER (PARTITION BY split ORDER BY shard_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM shard_counts),
requests AS (SELECT 'train' AS split, event_id AS block_index FROM events)"""

_ORDERED = f"""
positions AS (
  SELECT split, block_id, row_number() OVER (PARTITION BY split ORDER BY
    CAST('0x' || substr(md5('{c.SEED}:{c.EPOCH}:' || block_id), 1, 15) AS BIGINT), block_id) - 1 AS position,
    count(*) OVER (PARTITION BY split) AS n FROM blocks),
plan AS (
  SELECT split, {c.EPOCH} AS epoch, position // {_BATCH} AS batch_no,
    CAST(position % {_BATCH} AS INT) AS slot, block_id
  FROM positions WHERE position // {_BATCH} < n // {_BATCH})"""


def _model(source: str, ids: str, by: str) -> str:
    """Counts of the training split as a model, and pair counts per group."""
    k = c.SMOOTHING
    return f"""
pair_rows AS (
  SELECT {by} AS g, split, unnest({ids}[1:len({ids}) - 1]) AS a, unnest({ids}[2:]) AS b FROM {source}),
pair_groups AS MATERIALIZED (SELECT g, split, a, b, count(*) AS n FROM pair_rows GROUP BY ALL),
bigrams AS MATERIALIZED (
  SELECT a, b, CAST(sum(n) AS BIGINT) AS n FROM pair_groups WHERE split = 'train' GROUP BY a, b),
contexts AS (SELECT a, sum(n) AS c FROM bigrams GROUP BY a),
sizes AS (SELECT (SELECT count(*) FROM vocab) AS v, (SELECT sum(n) FROM bigrams) AS total),
unigrams AS (
  SELECT token_id AS b, (coalesce(c, 0) + 1)::DOUBLE / (total + v) AS p1
  FROM vocab LEFT JOIN (SELECT b, sum(n) AS c FROM bigrams GROUP BY b) u ON u.b = token_id, sizes),
nll AS (
  SELECT g, split, p.n, -ln((coalesce(m.n, 0) + {k} * p1) / (coalesce(x.c, 0) + {k})) AS nll
  FROM pair_groups p LEFT JOIN bigrams m USING (a, b) LEFT JOIN contexts x USING (a) JOIN unigrams USING (b))"""


_SCORES = """
scores AS (
  SELECT vec_id AS ctx_id, label AS target_id, unnest(range(len(embedding)))::INT AS token_id,
    unnest(embedding)::DOUBLE AS logit FROM embeddings),
lse AS (
  SELECT ctx_id, m + ln(sum(exp(logit - m))) AS z
  FROM scores JOIN (SELECT ctx_id, max(logit) AS m FROM scores GROUP BY ctx_id) USING (ctx_id) GROUP BY ctx_id, m),
log_p AS (SELECT ctx_id, target_id, token_id, logit, logit - z AS lp FROM scores JOIN lse USING (ctx_id)),
history AS (SELECT DISTINCT ctx_id // 8 AS g, target_id AS token_id, true AS seen FROM scores)"""


def _filters(logit: str, k: int | None, p: float | None) -> str:
    """Softmax of an expression over the scores, then top-k and top-p as windows."""
    top_k = f"rk <= {k}" if k else "true"
    top_p = f"(rk = 1 OR before_ < {p})" if p else "true"
    return f"""
adjusted AS (
  SELECT ctx_id, s.token_id, {logit} AS x
  FROM scores s LEFT JOIN history h ON h.g = ctx_id // 8 AND h.token_id = s.token_id),
weights AS (SELECT ctx_id, token_id, exp(x - max(x) OVER (PARTITION BY ctx_id)) AS w FROM adjusted),
probs AS (SELECT ctx_id, token_id, w / sum(w) OVER (PARTITION BY ctx_id) AS p FROM weights),
ranked_p AS (SELECT *, row_number() OVER (PARTITION BY ctx_id ORDER BY p DESC, token_id) AS rk FROM probs),
by_k AS (SELECT ctx_id, token_id, rk, CASE WHEN {top_k} THEN p ELSE 0 END AS p FROM ranked_p),
by_p AS (
  SELECT *, coalesce(sum(p) OVER (PARTITION BY ctx_id ORDER BY rk
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_ FROM by_k),
kept AS (SELECT ctx_id, token_id, p FROM by_p WHERE {top_p} AND p > 0),
normed AS (SELECT ctx_id, token_id, p / sum(p) OVER (PARTITION BY ctx_id) AS p FROM kept)"""


_FULL_FILTER = _filters(
    f"logit / {c.TEMPERATURE} / CASE WHEN seen THEN {c.PENALTY} ELSE 1 END", c.TOP_K, c.TOP_P
)

_PROMPTS = f"""
prompt_words AS (
  SELECT conv_id, turn, '{_MARK}' || w AS word, ord
  FROM (SELECT conv_id, turn, unnest(a) AS w, unnest(range(len(a))) AS ord
        FROM (SELECT conv_id, turn, string_split(text, ' ') AS a FROM conversations)) WHERE w <> ''),
prompts AS MATERIALIZED (
  SELECT conv_id, turn, list_concat([2], coalesce(flatten(list(ids ORDER BY ord) FILTER (ids IS NOT NULL)), [])) AS ids
  FROM conversations LEFT JOIN prompt_words USING (conv_id, turn) LEFT JOIN word_ids USING (word) GROUP BY conv_id, turn)"""

_DENSE = f"""
dense AS MATERIALIZED (
  SELECT t.token_id AS a, u.b, ln((coalesce(m.n, 0) + {c.SMOOTHING} * p1) / (coalesce(x.c, 0) + {c.SMOOTHING})) AS logit
  FROM vocab t CROSS JOIN unigrams u LEFT JOIN bigrams m ON m.a = t.token_id AND m.b = u.b LEFT JOIN contexts x ON x.a = t.token_id),
best AS MATERIALIZED (
  SELECT a, b FROM dense QUALIFY row_number() OVER (PARTITION BY a ORDER BY logit DESC, b) = 1),
s0 AS (SELECT conv_id, turn, ids[-1] AS last, CAST([] AS INT[]) AS gen, false AS done FROM prompts)"""


def _next_state(i: int, choice: str) -> str:
    return f"""
s{i + 1} AS MATERIALIZED (
  SELECT conv_id, turn, CASE WHEN ended THEN last ELSE b END AS last,
    CASE WHEN ended THEN gen ELSE list_append(gen, b) END AS gen, ended AS done
  FROM (SELECT s.*, b, done OR b = 3 AS ended FROM s{i} s {choice}))"""


def _greedy_rounds(rounds: int) -> str:
    return f"""
greedy AS (
  SELECT conv_id, turn, 0 AS i, last, gen, done FROM s0
  UNION ALL
  SELECT conv_id, turn, i + 1, CASE WHEN b = 3 THEN last ELSE b END, CASE WHEN b = 3 THEN gen ELSE list_append(gen, b) END, b = 3
  FROM greedy JOIN best ON a = last WHERE i < {rounds} AND NOT done),
continued AS (SELECT conv_id, turn, arg_max(gen, i) AS gen FROM greedy GROUP BY conv_id, turn)"""


def _sampled_rounds(rounds: int, top_p: float) -> str:
    parts = []
    for i in range(rounds):
        over = "OVER (PARTITION BY conv_id, turn"
        parts.append(f"""
a{i} AS (
  SELECT conv_id, turn, b, logit / {c.TEMPERATURE} / CASE WHEN list_contains(gen, b) THEN {c.PENALTY} ELSE 1 END AS x
  FROM s{i} JOIN dense ON a = last WHERE NOT done),
b{i} AS (SELECT conv_id, turn, b, exp(x - max(x) {over})) AS w FROM a{i}),
c{i} AS (SELECT conv_id, turn, b, w / sum(w) {over}) AS p FROM b{i}),
d{i} AS (SELECT *, row_number() {over} ORDER BY p DESC, b) AS rk FROM c{i}),
e{i} AS (
  SELECT conv_id, turn, b, p, rk, coalesce(sum(p) {over} ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_
  FROM d{i} WHERE rk <= {c.TOP_K}),
f{i} AS (SELECT conv_id, turn, b, p / sum(p) {over}) AS p FROM e{i} WHERE rk = 1 OR before_ < {top_p}),
g{i} AS (
  SELECT conv_id, turn, b, sum(p) {over} ORDER BY b) AS cdf,
    CAST('0x' || substr(md5('{c.SEED}:{i}:' || conv_id || ':' || turn), 1, 13) AS BIGINT) / 4503599627370496.0 AS u FROM f{i}),
h{i} AS MATERIALIZED (
  SELECT conv_id, turn, coalesce(min(b) FILTER (cdf > u), max(b)) AS b FROM g{i} GROUP BY conv_id, turn)""")
        parts.append(_next_state(i, f"LEFT JOIN h{i} USING (conv_id, turn)"))
    return ",".join(parts)


_LOG = """
runlog AS (SELECT user_id AS run_id, event_id + 1 AS step, value AS perplexity FROM events)"""
_RUN_CONFIG = """1024::BIGINT AS vocab_size, 64 * (1 + run_id % 4) AS seq_len, 32 * (1 + run_id % 3) AS d_model,
  7::BIGINT AS n_layers, 4::BIGINT AS n_heads, CASE WHEN run_id % 2 = 0 THEN 0.1 ELSE 0 END::DOUBLE AS dropout"""

_RECORDS = f"""
records AS (
  SELECT 'best' AS kind, * FROM (SELECT * FROM runlog WHERE step % {c.EVAL_EVERY} = 0 OR step = 1)
  QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY perplexity, step) = 1
  UNION ALL
  SELECT 'last' AS kind, * FROM runlog QUALIFY step = max(step) OVER (PARTITION BY run_id)
  UNION ALL
  SELECT 'summary' AS kind, run_id, max(step) AS step, NULL AS perplexity FROM runlog GROUP BY run_id)"""


def _with(select: str, *ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(ctes) + "\n" + select


def _fp(ids: str) -> str:
    return f"md5(array_to_string({ids}, ','))"


def _trained(size: int = c.VOCAB_SIZE, coverage: float = 1.0, prompts: bool = False) -> list[str]:
    return [_LINES, _words(prompts), _alphabet(coverage), _chain(size), _VOCAB]


_CODED = [*_trained(), _ENCODE]
_CHARACTERS = [*_trained(0), _ENCODE]
_PACKED = [*_CODED, _BLOCKS]
_ASKED = [*_trained(prompts=True), _ENCODE]
_ENCODED_REPORT = f"SELECT doc_id, line_no, CAST(len(ids) AS INT) AS n_ids, {_fp('ids')} AS ids FROM encoded"
_YIELD = f"""SELECT split, count(*) AS examples, CAST(sum(len(ids)) AS BIGINT) AS tokens,
  CAST(sum(len(ids)) AS BIGINT) // {c.SEQ_LEN} AS blocks, CAST(sum(len(ids)) AS BIGINT) % {c.SEQ_LEN} AS dropped_tokens
FROM examples GROUP BY split"""
# Forward and backward sums as one row per word that grows by a place a step; every character is a piece.
_LATTICE = """
trained_words AS (SELECT word, freq, length(word) AS n FROM words WHERE freq > 0),
spans AS MATERIALIZED (
  SELECT word, i AS start, i + unnest(range(1, least(16, n - i) + 1)) AS stop
  FROM (SELECT word, n, unnest(range(n)) AS i FROM trained_words)),
counted AS (
  SELECT substr(word, CAST(start + 1 AS BIGINT), CAST(stop - start AS BIGINT)) AS piece, sum(freq) AS n
  FROM spans JOIN trained_words USING (word) GROUP BY 1 HAVING sum(freq) > 1 OR length(piece) = 1),
priors AS MATERIALIZED (SELECT piece, n::DOUBLE / (SELECT sum(n) FROM counted) AS p FROM counted),
arcs AS MATERIALIZED (
  SELECT word, start, stop, piece, p FROM spans
  JOIN priors ON piece = substr(word, CAST(start + 1 AS BIGINT), CAST(stop - start AS BIGINT))),
into_place AS MATERIALIZED (SELECT word, stop AS at, list(start + 1) AS froms, list(p) AS ps FROM arcs GROUP BY ALL),
out_of_place AS MATERIALIZED (
  SELECT word, n - start AS at, list(n - stop + 1) AS froms, list(p) AS ps FROM arcs JOIN trained_words USING (word) GROUP BY ALL),
ahead AS (
  SELECT word, 0 AS at, [1::DOUBLE] AS f FROM trained_words
  UNION ALL
  SELECT word, p.at, list_append(f, list_sum(list_transform(froms, lambda x, i: f[x] * ps[i])))
  FROM ahead a JOIN into_place p USING (word) WHERE p.at = a.at + 1),
back AS (
  SELECT word, 0 AS at, [1::DOUBLE] AS f FROM trained_words
  UNION ALL
  SELECT word, p.at, list_append(f, list_sum(list_transform(froms, lambda x, i: f[x] * ps[i])))
  FROM back a JOIN out_of_place p USING (word) WHERE p.at = a.at + 1),
sums AS (
  SELECT word, freq, n, a.f AS f, b.f AS b FROM trained_words
  JOIN ahead a USING (word) JOIN back b USING (word) WHERE a.at = n AND b.at = n),
expectations AS (
  SELECT piece, sum(freq * f[start + 1] * p * b[n - stop + 1] / f[n + 1]) AS expected
  FROM arcs JOIN sums USING (word) GROUP BY piece)"""
_SINGLE_SPACED = "regexp_replace(line, ' +', ' ', 'g')"
_LOSS = "round(sum(nll * n) / sum(n), 6) AS loss, round(exp(sum(nll * n) / sum(n)), 4) AS perplexity, CAST(sum(n) AS BIGINT) AS tokens"
_SPECIAL = {"[PAD]": 0, "[UNK]": 1, "[BOS]": 2, "[EOS]": 3}
_KEPT = "SELECT ctx_id, token_id, round(p, 6) AS p FROM {0}"


def oracle_sql() -> dict[str, str]:
    return {
        "corpus_lines": _with("SELECT doc_id, line_no, line FROM lines", _LINES),
        "split_assignment": _with("SELECT doc_id, bucket, split FROM split_docs", _LINES),
        "example_markers": _with(
            "SELECT doc_id, line_no, CAST(len(ids) AS INT) AS n_ids, ids[1] AS first_id, ids[-1] AS last_id, "
            "CAST(len(list_filter(ids, lambda x: x NOT IN (0, 2, 3))) AS INT) AS n_text_ids FROM examples", *_CODED),
        "prompt_contexts": _with(f"""
SELECT conv_id, turn, CAST(len(ids) AS INT) AS n_ids, CAST(least(len(ids), {c.CONTEXT}) AS INT) AS n_context,
  {_fp(f'ids[greatest(len(ids) - {c.CONTEXT} + 1, 1):]')} AS context FROM prompts""", *_ASKED, _PROMPTS),
        "training_pairs": _with(
            f"SELECT split, block_id, {c.SEQ_LEN - 1} AS n, {_fp('tokens[1:len(tokens) - 1]')} AS inputs, "
            f"{_fp('tokens[2:]')} AS targets FROM blocks", *_PACKED),
        "short_block_pairs": _with(
            "SELECT CAST(1 AS INT) AS seq_len, split, CAST(sum(len(ids)) AS BIGINT) AS blocks, CAST(0 AS BIGINT) AS pairs "
            f"FROM examples GROUP BY split UNION ALL SELECT CAST({c.SEQ_LEN} AS INT), split, count(*), count(*) "
            "FROM blocks GROUP BY split", *_PACKED),
        "text_corpus_blocks": _with(
            f"SELECT split, block_id, shard_id, local_index, {_fp('tokens')} AS tokens FROM blocks", *_PACKED),
        "split_scan": _with(
            f"SELECT split, block_id, shard_id, {_fp('tokens')} AS tokens FROM blocks WHERE split = 'val'", *_PACKED),
        "marker_free_blocks": _with(
            f"SELECT split, block_id, CAST(len(k) AS INT) AS n, {_fp('k')} AS ids FROM (SELECT *, "
            "list_filter(tokens, lambda x: x NOT IN (0, 2, 3)) AS k FROM blocks)", *_PACKED),
        "word_frequencies": _with("SELECT word, freq FROM words WHERE freq > 0", _LINES, _WORDS),
        "symbol_pairs": _with(
            f'SELECT l AS "left", r AS "right", freq FROM ({_pairs("w0")})', _LINES, _WORDS, _chain(0)),
        "bpe_merges": _with(
            'SELECT rank, l AS "left", r AS "right", freq FROM merges', *_trained()[:-1]),
        "character_coverage": _with(
            "SELECT ch, freq, position FROM alphabet", _LINES, _WORDS, _alphabet(c.COVERAGE)),
        "vocabulary_characters": _with("SELECT * FROM vocab", *_trained(0)),
        "vocabulary_merges": _with("SELECT * FROM vocab", *_trained()),
        "encode_characters": _with(_ENCODED_REPORT, *_CHARACTERS),
        "encode_merges": _with(_ENCODED_REPORT, *_CODED),
        "encode_byte_fallback": _with(_ENCODED_REPORT, *_trained(0, c.COVERAGE), _ENCODE),
        "decode_lines": _with(
            f"SELECT doc_id, line_no, replace({_SINGLE_SPACED}, '{_MARK}', ' ') AS text FROM lines", _LINES),
        "unigram_expected_counts": _with(
            "SELECT piece, round(expected, 3) AS expected FROM expectations", _LINES, _WORDS, _LATTICE),
        "unigram_roundtrip": _with(
            f"SELECT doc_id, line_no, replace({_SINGLE_SPACED}, '{_MARK}', ' ') AS text FROM lines", _LINES),
        "decode_blocks": _with(f"""
SELECT split, block_id, md5(regexp_replace(array_to_string(list_transform(
    list_filter(tokens, lambda x: x NOT IN (0, 2, 3)), lambda x: surface[x + 1]), ''), '^ ', '')) AS text
FROM blocks, (SELECT list(replace(piece, '{_MARK}', ' ') ORDER BY token_id) AS surface FROM vocab)""", *_PACKED),
        "piece_lookup": _with(
            "SELECT word AS piece, coalesce(token_id, 1) AS token_id FROM words LEFT JOIN vocab ON piece = word",
            *_trained()),
        "id_lookup": _with(
            "SELECT event_id, CAST(event_id AS INT) AS token_id, piece FROM events LEFT JOIN vocab ON token_id = event_id",
            *_trained()),
        "roundtrip_audit": _with(
            f"SELECT split, count(*) AS lines, count(*) FILTER (line <> replace({_SINGLE_SPACED}, '{_MARK}', ' ')) AS differing "
            "FROM lines GROUP BY split", _LINES),
        "tokenizer_metadata": _with(
            "SELECT " + ", ".join(f"CAST({i} AS INT) AS {t[1:-1].lower()}_id" for t, i in _SPECIAL.items())
            + ", CAST((SELECT count(*) FROM vocab) AS INT) AS vocab_size, (SELECT count(*) FROM vocab) AS stored_pieces, "
            f"CAST((SELECT count(*) FROM merges) AS INT) AS stored_merges", *_trained()),
        "split_token_yield": _with(_YIELD, *_CHARACTERS),
        "merged_token_yield": _with(_YIELD, *_CODED),
        "packed_blocks": _with(
            f"SELECT split, block_id, shard_id, local_index, {_fp('tokens')} AS tokens FROM blocks", *_PACKED),
        "shard_sink": _with(
            "SELECT split, shard_id, count(*) AS blocks, min(block_id) AS first_block, max(local_index) AS last_local_index, "
            "CAST(sum(list_sum(tokens)) AS BIGINT) AS id_sum FROM blocks GROUP BY split, shard_id", *_PACKED),
        "shard_manifest": _with(
            "SELECT split, shard_id, split || '_' || lpad(CAST(shard_id AS VARCHAR), 5, '0') AS shard, "
            "count(*) AS blocks, CAST(max(len(tokens)) AS INT) AS seq_len FROM blocks GROUP BY split, shard_id", *_PACKED),
        "split_manifest": _with(
            "SELECT split, count(*) AS blocks, CAST(max(len(tokens)) AS INT) AS seq_len, count(DISTINCT shard_id) AS shards, "
            "max(list_max(tokens)) AS max_token_id, CASE WHEN max(list_max(tokens)) <= 65535 THEN 'uint16' ELSE 'uint32' END "
            "AS id_width FROM blocks GROUP BY split", *_PACKED),
        "shard_checks": _with(
            "SELECT split, CAST(min(len(tokens)) AS INT) AS min_seq_len, CAST(max(len(tokens)) AS INT) AS max_seq_len, "
            "min(list_min(tokens)) AS min_token_id, max(list_max(tokens)) AS max_token_id, "
            "min(len(tokens)) = max(len(tokens)) AND min(list_min(tokens)) >= 0 AS consistent FROM blocks GROUP BY split",
            *_PACKED),
        "shard_offsets": _with(
            'SELECT split, shard_id, blocks, start, start + blocks AS "end" FROM offsets', *_PACKED, _SHARDS),
        "block_lookup": _with(
            "SELECT r.split, block_index, shard_id, block_index - start AS local_index FROM requests r LEFT JOIN offsets o "
            "ON o.split = r.split AND block_index >= start AND block_index < start + blocks", *_PACKED, _SHARDS),
        "block_fetch": _with(
            f"SELECT r.split, block_index, {_fp('tokens')} AS tokens FROM requests r JOIN blocks b "
            "ON b.split = r.split AND block_id = block_index", *_PACKED, _SHARDS),
        "shuffled_order": _with("SELECT split, block_id, position FROM positions", *_PACKED, _ORDERED),
        "batch_sizes": _with(
            "SELECT split, CAST(max(len(tokens)) AS INT) AS seq_len, "
            f"greatest(1, {_TARGET_BATCH_TOKENS} // max(len(tokens))) AS batch_size FROM blocks GROUP BY split", *_PACKED),
        "batch_plan": _with("SELECT * FROM plan", *_PACKED, _ORDERED),
        "evaluation_batches": _with(
            f"SELECT split, 0 AS epoch, block_id // {_BATCH} AS batch_no, "
            f"CAST(block_id % {_BATCH} AS INT) AS slot, block_id FROM blocks "
            f"WHERE block_id // {_BATCH} < {c.MAX_BATCHES}", *_PACKED),
        "batch_contents": _with(
            f"SELECT split, epoch, batch_no, CAST(count(*) AS INT) AS blocks, {_fp('flatten(list(tokens ORDER BY slot))')} "
            "AS tokens FROM plan JOIN blocks USING (split, block_id) GROUP BY split, epoch, batch_no", *_PACKED, _ORDERED),
        "next_token_counts": _with(
            "SELECT split, a AS input_id, b AS target_id, n FROM pair_groups", *_PACKED, _model("blocks", "tokens", "split")),
        "next_token_model": _with(
            f"SELECT a AS input_id, b AS target_id, n, round((n + {c.SMOOTHING} * p1) / (c + {c.SMOOTHING}), 9) AS p "
            "FROM bigrams JOIN contexts USING (a) JOIN unigrams USING (b)", *_PACKED, _model("blocks", "tokens", "split")),
        "loss_per_split": _with(
            f"SELECT g AS split, {_LOSS} FROM nll GROUP BY g", *_PACKED, _model("blocks", "tokens", "split")),
        "evaluation_loss": _with(
            f"SELECT g AS split, {_LOSS} FROM head_nll GROUP BY g", *_PACKED, _model("blocks", "tokens", "split"), f"""
head_rows AS (
  SELECT split AS g, unnest(tokens[1:len(tokens) - 1]) AS a, unnest(tokens[2:]) AS b
  FROM blocks WHERE block_id < {c.EVAL_BATCHES * _BATCH}),
head_nll AS (
  SELECT g, p.n, -ln((coalesce(m.n, 0) + {c.SMOOTHING} * p1) / (coalesce(x.c, 0) + {c.SMOOTHING})) AS nll
  FROM (SELECT g, a, b, count(*) AS n FROM head_rows GROUP BY ALL) p
  LEFT JOIN bigrams m USING (a, b) LEFT JOIN contexts x USING (a) JOIN unigrams USING (b))"""),
        "loss_per_document": _with(
            f"SELECT g AS doc_id, {_LOSS} FROM nll GROUP BY g", *_CODED, _model("examples", "ids", "doc_id")),
        "log_softmax": _with("SELECT ctx_id, token_id, round(lp, 6) AS log_p FROM log_p", _SCORES),
        "target_nll": _with(
            "SELECT ctx_id, target_id, round(-lp, 6) AS nll FROM log_p WHERE token_id = target_id", _SCORES),
        "vector_loss": _with(
            "SELECT round(avg(-lp), 6) AS loss, round(exp(avg(-lp)), 4) AS perplexity, count(*) AS tokens "
            "FROM log_p WHERE token_id = target_id", _SCORES),
        "temperature_scaling": _with(
            f"SELECT ctx_id, token_id, round(logit / {c.TEMPERATURE}, 6) AS logit FROM scores", _SCORES),
        "repetition_penalty": _with(
            f"SELECT ctx_id, s.token_id, round(CASE WHEN seen THEN logit / {c.PENALTY} ELSE logit END, 6) AS logit "
            "FROM scores s LEFT JOIN history h ON h.g = ctx_id // 8 AND h.token_id = s.token_id", _SCORES),
        "softmax": _with(_KEPT.format("probs"), _SCORES, _filters("logit", None, None)),
        "top_k_filter": _with(_KEPT.format("kept"), _SCORES, _filters("logit", c.TOP_K, None)),
        "top_p_filter": _with(_KEPT.format("kept"), _SCORES, _filters("logit", None, 0.8)),
        "sampling_distribution": _with(_KEPT.format("normed"), _SCORES, _FULL_FILTER),
        "categorical_draw": _with(f"""
SELECT ctx_id, coalesce(min(token_id) FILTER (cdf > u), max(token_id)) AS token_id
FROM (SELECT ctx_id, token_id, sum(p) OVER (PARTITION BY ctx_id ORDER BY token_id) AS cdf,
        CAST('0x' || substr(md5('{c.SEED}:0:' || ctx_id), 1, 13) AS BIGINT) / 4503599627370496.0 AS u FROM normed)
GROUP BY ctx_id""", _SCORES, _FULL_FILTER),
        "greedy_continuation": _with(f"""
SELECT conv_id, turn, array_to_string(gen, ',') AS generated,
  regexp_replace(replace(array_to_string(list_transform(list_filter(gen, lambda x: x NOT IN (0, 2, 3)),
    lambda x: surface[x + 1]), ''), '{_MARK}', ' '), '^ ', '') AS text
FROM continued, (SELECT list(piece ORDER BY token_id) AS surface FROM vocab)""",
            *_ASKED, _BLOCKS, _model("blocks", "tokens", "split"), _PROMPTS, _DENSE, _greedy_rounds(c.NEW_TOKENS)),
        "sampled_continuation": _with(
            f"SELECT conv_id, turn, array_to_string(gen, ',') AS generated FROM s{c.SAMPLED_TOKENS}",
            *_ASKED, _BLOCKS, _model("blocks", "tokens", "split"), _PROMPTS, _DENSE, _sampled_rounds(c.SAMPLED_TOKENS, c.TOP_P)),
        "greedy_choice": _with(
            "SELECT ctx_id, token_id FROM scores QUALIFY row_number() OVER (PARTITION BY ctx_id ORDER BY logit DESC, token_id) = 1",
            _SCORES),
        "evaluation_rows": _with(
            f"SELECT * FROM runlog WHERE step % {c.EVAL_EVERY} = 0 OR step = 1", _LOG),
        "save_rows": _with(
            f"SELECT * FROM runlog QUALIFY step % {c.SAVE_EVERY} = 0 OR step = max(step) OVER (PARTITION BY run_id)", _LOG),
        "perplexity_improvements": _with("""
SELECT * FROM (SELECT *, min(perplexity) OVER (PARTITION BY run_id ORDER BY step
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_best FROM runlog)
WHERE previous_best IS NULL OR perplexity < previous_best""", _LOG),
        "best_checkpoint": _with(
            "SELECT * FROM runlog QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY perplexity, step) = 1", _LOG),
        "last_checkpoint": _with(
            "SELECT * FROM runlog QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY step DESC) = 1", _LOG),
        "checkpoint_records": _with(f"""
SELECT kind, run_id, step, CASE WHEN kind = 'best' THEN round(ln(perplexity), 6) END AS val_loss,
  CASE WHEN kind = 'best' THEN perplexity END AS val_perplexity,
  CASE WHEN kind = 'best' THEN step * {_TARGET_BATCH_TOKENS} END AS val_tokens, seq_len, dropout,
  CASE WHEN kind = 'last' THEN {c.LEARNING_RATE}::DOUBLE END AS learning_rate
FROM (SELECT *, {_RUN_CONFIG} FROM records)""", _LOG, _RECORDS),
        "runlog_sink": _with(f"""
SELECT run_id, count(*) AS records, count(kind) AS checkpoints, max(step) AS last_step, count(kind) AS with_config,
  round(sum(CASE WHEN kind = 'last' THEN {c.LEARNING_RATE}::DOUBLE END), 6) AS learning_rates
FROM (SELECT kind, run_id, step FROM records
  UNION ALL SELECT NULL, run_id, step FROM runlog WHERE step % {c.EVAL_EVERY} = 0 OR step = 1) GROUP BY run_id""",
            _LOG, _RECORDS),
        "checkpoint_configs": _with(
            f"SELECT kind, run_id, step, {_RUN_CONFIG} FROM records", _LOG, _RECORDS),
        "config_defaults": "SELECT event_id, " + ", ".join(
            f"coalesce(CAST(json_extract_string(props, '$.{name}') AS "
            f"{'DOUBLE' if isinstance(value, float) else 'BIGINT'}), {value}) AS {name}"
            for name, value in c.CONFIG.items()) + " FROM events",
    }
