"""SQL for the registered queries, written for DuckDB over the same tables and independent of the Spark code."""

from __future__ import annotations

from shardloom.plans import fixture as fx

ORACLE: dict[str, str] = {}

SPECIAL = r"<unk>|<s>|</s>|<pad>|<\|user\|>|<\|assistant\|>|<\|system\|>"
LITERALS = ["<unk>", "<s>", "</s>", "<pad>", "<|user|>", "<|assistant|>", "<|system|>"]

BYTE_IDS = """list_transform(range(256), lambda b: CASE WHEN b BETWEEN 33 AND 126 THEN b - 26
  WHEN b BETWEEN 161 AND 172 THEN b - 60 WHEN b BETWEEN 174 AND 255 THEN b - 61 WHEN b <= 32 THEN b + 195
  WHEN b BETWEEN 127 AND 160 THEN b + 101 ELSE 262 END)"""
BYTE_ID = """CASE WHEN h BETWEEN '21' AND '7E' THEN CAST('0x' || h AS INTEGER) - 26
  WHEN h BETWEEN 'A1' AND 'AC' THEN CAST('0x' || h AS INTEGER) - 60
  WHEN h >= 'AE' THEN CAST('0x' || h AS INTEGER) - 61 WHEN h <= '20' THEN CAST('0x' || h AS INTEGER) + 195
  WHEN h BETWEEN '7F' AND 'A0' THEN CAST('0x' || h AS INTEGER) + 101 ELSE 262 END"""

RAW = """raw AS (
  SELECT 'text' AS mix_source, 0 AS source_ord, doc_id AS ord, text FROM documents
  UNION ALL SELECT 'code', 1, doc_id, text FROM documents WHERE lang = 'fr'
  UNION ALL SELECT 'chat', 2, conv_id, coalesce(string_agg('<|' || coalesce(role, 'user') || '|>' || chr(10)
      || coalesce(text, ''), chr(10) ORDER BY turn)
      FILTER (WHERE coalesce(role, 'user') IN ('user', 'assistant', 'system')), '')
    FROM conversations GROUP BY conv_id)"""
DOCS = RAW + ", docs AS (SELECT * FROM raw WHERE length(trim(text)) >= 20)"
SAMPLE = RAW + ", docs AS (SELECT * FROM raw WHERE length(trim(text)) > 20)"
COUNTED = DOCS + f""", counted AS (
  SELECT mix_source, source_ord, ord, CAST(strlen(regexp_replace(text, '{SPECIAL}', '~', 'g')) + 2 AS BIGINT) AS n_tokens,
    CASE WHEN CAST('0x' || substr(md5('{fx.SEED}:' || mix_source || ':' || ord), 1, 8) AS BIGINT)
      < {fx.VAL_FRACTION} * 4294967296 THEN 'val' ELSE 'train' END AS split
  FROM docs)"""
BUDGETS = """mixture(mix_source, source_ord, weight) AS (VALUES ('text', 0, 60.0), ('code', 1, 25.0), ('chat', 2, 15.0)),
budgets AS (SELECT mix_source, source_ord, CAST(weight AS DOUBLE) / (SELECT sum(weight) FROM mixture) AS share,
  CAST(floor(%d * (CAST(weight AS DOUBLE) / (SELECT sum(weight) FROM mixture))) AS BIGINT) AS budget FROM mixture)""" % fx.MAX_TOKENS
CUT = COUNTED + ", " + BUDGETS + """, cut AS (
  SELECT c.* FROM (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY mix_source ORDER BY ord
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM counted) c
  JOIN budgets b USING (mix_source) WHERE c.before < b.budget)"""


def offset(src: str, name: str) -> str:
    """Positions and shards of the parallel fill over a relation."""
    return f"""{name} AS (SELECT *, CAST(floor(start_tok / {fx.SHARD_SIZE}) AS BIGINT) AS shard FROM (
      SELECT *, CAST(coalesce(sum(n_tokens) OVER (PARTITION BY mix_source, split ORDER BY ord
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_tok FROM {src}))"""


def totals(src: str, name: str) -> str:
    return f"""{name} AS (SELECT mix_source, source_ord, split, shard, CAST(sum(n_tokens) AS BIGINT) AS num_tokens,
      count(*) AS n_docs, min(ord) AS min_ord, max(ord) AS max_ord FROM {src} GROUP BY ALL)"""


def numbering(src: str, name: str) -> str:
    """Run-wide shard numbers: full shards by closing document, then tails, train first."""
    return f"""{name} AS (SELECT *, CAST(row_number() OVER (ORDER BY source_ord,
      CASE WHEN is_tail THEN 1 ELSE 0 END,
      CASE WHEN is_tail THEN CASE split WHEN 'train' THEN 0 ELSE 1 END ELSE max_ord END) - 1
      AS INTEGER) AS shard_idx FROM (SELECT *, num_tokens < {fx.SHARD_SIZE}
        AND shard = max(shard) OVER (PARTITION BY mix_source, split) AS is_tail FROM {src}))"""


OFFSET = COUNTED + ", " + offset("counted", "placed") + ", " + totals("placed", "totals")
NUMBERED = OFFSET + ", " + numbering("totals", "numbered")
NAME = "printf('%s_%s_shard_%04d.bin', mix_source, split, shard_idx)"
ENTRIES = NUMBERED + f", entries AS (SELECT {NAME} AS path, num_tokens, shard_idx, mix_source AS source, split FROM numbered)"

GREEDY = COUNTED + f""", g AS (SELECT *, row_number() OVER (PARTITION BY mix_source, split ORDER BY ord) AS rn FROM counted),
fill AS (
  SELECT mix_source, source_ord, split, ord, n_tokens, rn, CAST(0 AS BIGINT) AS shard, n_tokens AS held FROM g WHERE rn = 1
  UNION ALL
  SELECT g.mix_source, g.source_ord, g.split, g.ord, g.n_tokens, g.rn,
    CASE WHEN f.held >= {fx.SHARD_SIZE} THEN f.shard + 1 ELSE f.shard END,
    CASE WHEN f.held >= {fx.SHARD_SIZE} THEN g.n_tokens ELSE f.held + g.n_tokens END
  FROM fill f JOIN g ON g.mix_source = f.mix_source AND g.split = f.split AND g.rn = f.rn + 1)"""

# Special literals become one private code point each, so that a hex dump cut at byte borders finds them.
MARKED = "text"
for _i, _t in enumerate(LITERALS):
    MARKED = f"replace({MARKED}, '{_t}', chr({0xE000 + _i}))"
IDS = f"""list_transform(regexp_extract_all(hex(encode({MARKED})), 'EE808[0-6]|..'),
  lambda h: CASE WHEN length(h) = 6 THEN CAST('0x' || h AS INTEGER) - 15630464
    ELSE {BYTE_ID} END)"""
PLAIN_IDS = f"""list_transform(regexp_extract_all(hex(encode(text)), '..'),
  lambda h: {BYTE_ID})"""
LUT = f"lut AS (SELECT {BYTE_IDS} AS ids)"
FRAMED = NUMBERED + f""", {LUT}, framed AS (SELECT p.*, n.shard_idx, list_concat([1], {IDS}, [2]) AS ids
  FROM placed p JOIN docs USING (mix_source, ord) JOIN numbered n USING (mix_source, split, shard))"""

# Words: RE2 has no look-ahead, so the last blank before a word is cut off by a control character first.
CUT_WORDS = r"regexp_replace(text, '(\s+)(\s[^\s\x{E000}-\x{E006}])', '\1' || chr(1) || '\2', 'g')"
WORD = (r"""'[\x{E000}-\x{E006}]|''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+"""
        r"""| ?[^\s\p{L}\p{N}\x01\x{E000}-\x{E006}]+|\s+'""")
WORDS = f"regexp_extract_all({CUT_WORDS}, {WORD})"

# A word as a run of five-digit ids, each between two blanks of its own; a merge is one plain replacement.
SYMBOLS = f"""' ' || array_to_string(list_transform(regexp_extract_all(hex(encode(word)), '..'),
  lambda h: lpad(CAST({BYTE_ID} AS VARCHAR), 5, '0')), '  ') || ' '"""


def pairs_of(state: str) -> str:
    return f"""SELECT l[i] AS a, l[i + 1] AS b, sum(freq) AS n FROM (
      SELECT l, freq, unnest(range(1, len(l))) AS i FROM (SELECT string_split(trim(sym), '  ') AS l, freq FROM {state}))
      GROUP BY ALL"""


TRAIN = SAMPLE + f""", {LUT}, wc AS MATERIALIZED (SELECT word, count(*) AS freq FROM (SELECT unnest({WORDS}) AS word FROM docs) GROUP BY word),
s0 AS MATERIALIZED (SELECT {SYMBOLS} AS sym, freq FROM wc)"""
# One recursion learns the merges and spells all words, those of the corpus outside the sample with frequency 0. A row
# with a negative key is a merge; the other rows are the words, which every round replaces.
LEARN = TRAIN + f""", corpus AS (SELECT mix_source, ord, {MARKED} AS text FROM raw WHERE length(trim(text)) >= 20),
pieces AS MATERIALIZED (SELECT mix_source, ord, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT mix_source, ord, {WORDS} AS w FROM corpus)),
spelled AS MATERIALIZED (SELECT row_number() OVER (ORDER BY word) AS w, word, {SYMBOLS} AS sym, freq FROM (
  SELECT word, CAST(max(freq) AS HUGEINT) AS freq FROM (SELECT word, freq FROM wc UNION ALL SELECT DISTINCT word, 0 FROM pieces) GROUP BY word)),
learned(w, k, sym, freq, a, b) USING KEY (w) AS (
  SELECT CAST(w AS BIGINT), 0, sym, freq, '', '' FROM spelled
  UNION
  (WITH best AS (SELECT a, b FROM ({pairs_of("(SELECT * FROM learned WHERE w > 0)")}) ORDER BY n DESC, a, b LIMIT 1),
   now AS (SELECT l.*, best.a AS x, best.b AS y FROM learned l, best WHERE w > 0 AND k < {{MERGES}})
   SELECT w, k + 1, replace(sym, ' ' || x || '  ' || y || ' ', ' ' || printf('%05d', 263 + k) || ' '), freq, '', '' FROM now
   UNION ALL SELECT -1 - k, k + 1, '', 0, x, y FROM (SELECT DISTINCT k, x, y FROM now))),
merges AS (SELECT k - 1 AS rank, CAST(a AS INTEGER) AS left_id, CAST(b AS INTEGER) AS right_id, 262 + k AS new_id FROM learned WHERE w < 0)"""
MERGED = LEARN.replace("{MERGES}", str(fx.MERGES))
BPE = MERGED + """, dict AS MATERIALIZED (SELECT word, CASE WHEN length(word) = 1 AND ascii(word) BETWEEN 57344 AND 57350
    THEN CAST(ascii(word) - 57344 AS VARCHAR)
    ELSE array_to_string(list_transform(string_split(trim(l.sym), '  '), lambda s: CAST(CAST(s AS INTEGER) AS VARCHAR)), ' ') END AS ids
  FROM spelled JOIN learned l USING (w)),
encoded AS (SELECT mix_source, ord, string_agg(ids, ' ' ORDER BY pos) AS ids FROM pieces JOIN dict USING (word) GROUP BY ALL)"""

LANES = NUMBERED + f""", starts AS (SELECT mix_source, split, shard, min(start_tok) AS shard_start FROM placed GROUP BY ALL),
listed AS (SELECT n.*, shard_start, row_number() OVER (PARTITION BY split ORDER BY shard_idx) - 1 AS pos
  FROM numbered n JOIN starts USING (mix_source, split, shard)),
laned AS (SELECT *, CAST(pos % {fx.RANKS} AS INTEGER) AS rank, CAST((pos // {fx.RANKS}) % {fx.WORKERS} AS INTEGER) AS worker FROM listed)"""


def order_by_hash(epoch: str) -> str:
    return f"""(PARTITION BY {'epoch, ' if epoch == 'epoch' else ''}split, rank, worker
      ORDER BY md5(({fx.SEED} + worker) || ':' || {epoch} || ':' || pos), pos"""


STREAMS = LANES + f""", streams AS (SELECT *, row_number() OVER {order_by_hash("0")}) - 1 AS read_pos,
  coalesce(sum(num_tokens) OVER {order_by_hash("0")} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stream_off FROM laned)"""
PACKED = STREAMS + f""", {LUT}, toks AS (
  SELECT split, rank, worker, CAST(base + i AS BIGINT) AS p, id FROM (
    SELECT s.split, rank, worker, stream_off + start_tok - shard_start AS base, unnest(ids) AS id,
      generate_subscripts(ids, 1) - 1 AS i
    FROM (SELECT p.*, list_concat([1], {IDS}, [2]) AS ids FROM placed p JOIN docs USING (mix_source, ord)) q
    JOIN streams s USING (mix_source, split, shard))),
seqs AS (SELECT split, rank, worker, p // {fx.SEQ_LEN} AS seq_idx, list(id ORDER BY p) AS ids FROM toks
  GROUP BY ALL HAVING count(*) = {fx.SEQ_LEN}),
full_seqs AS (SELECT *, count(*) OVER (PARTITION BY split, rank, worker) AS n_seq, seq_idx // {fx.BATCH} AS batch_id FROM seqs)"""

STEPS = """steps AS (SELECT event_type AS run_id, CAST(user_id % 4 AS INTEGER) AS rank, event_id AS step, value / 100 AS step_time,
  value * (event_id % 10) / 1000 AS data_wait, 1024 + (event_id % 7) * 128 AS tokens, value / 20 AS loss,
  value / 40 AS grad_norm, 8 + (user_id % 10) / 10 AS gpu_mem FROM events)"""
INTERVALS = STEPS + """, iv AS (SELECT run_id, CAST(floor((step - 1) / 100) AS BIGINT) AS interval, max(step) AS last_step,
  CAST(sum(tokens) AS BIGINT) AS tokens, sum(tokens) / sum(step_time) AS tokens_per_sec, avg(data_wait) * 1000 AS data_wait_ms,
  arg_max(loss, step) AS loss, exp(least(arg_max(loss, step), 20)) AS perplexity, arg_max(grad_norm, step) AS grad_norm,
  arg_max(gpu_mem, step) AS gpu_mem FROM steps WHERE step >= 1 GROUP BY ALL)"""
FLOPS = 13 * (6 * 1280 * 1280 + 6 * 1280 * 3456)

BIGRAMS = COUNTED + f""", {LUT}, enc AS (SELECT c.mix_source, c.split, list_concat([1], {IDS}, [2]) AS ids
  FROM counted c JOIN docs USING (mix_source, ord)),
big AS MATERIALIZED (SELECT mix_source, split, prev, next, count(*) AS n FROM (
  SELECT mix_source, split, unnest(ids[:-2]) AS prev, unnest(ids[2:]) AS next FROM enc) GROUP BY ALL)"""
NUCLEUS = BIGRAMS + """, sc AS (SELECT prev AS context, next AS token, ln(sum(n)) / 0.8 AS s FROM big GROUP BY ALL),
tk AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY context ORDER BY s DESC) AS rk FROM sc) WHERE rk <= 5),
ex AS (SELECT context, token, s, exp(s - max(s) OVER (PARTITION BY context)) AS e FROM tk),
ms AS (SELECT *, coalesce(sum(e) OVER (PARTITION BY context ORDER BY s DESC, token
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(e) OVER (PARTITION BY context) AS mass FROM ex),
cand AS (SELECT context, token, e / sum(e) OVER (PARTITION BY context) AS prob FROM ms WHERE mass <= 0.9)"""


def add(name: str, body: str, ctes: str = "") -> None:
    ORACLE[name] = (f"WITH RECURSIVE {ctes} " if ctes else "") + body


add("scan_source", "SELECT doc_id AS ord, text, lang FROM documents")
add("read_mixture", "SELECT mix_source, source_ord, ord, md5(text) AS text_md5 FROM raw", RAW)
add("failed_sources", """SELECT mix_source, count(*) AS n_docs, 'ok' AS state FROM raw GROUP BY mix_source
  UNION ALL SELECT 'broken', 0, 'failed' UNION ALL SELECT 'corrupt', 0, 'failed'""", RAW)
add("read_keyless", "SELECT row_number() OVER () - 1 AS ord, md5(text) AS text_md5 FROM documents")
add("read_string_key", "SELECT dense_rank() OVER (ORDER BY url NULLS FIRST) - 1 AS ord, md5(coalesce(html, '')) AS text_md5 FROM pages")
add("filter_lang", "SELECT doc_id AS ord, lang, length(text) AS n_chars FROM documents WHERE lang = 'fr'")
add("project_text", "SELECT doc_id AS ord, coalesce(text, '') AS text FROM documents")
add("render_chat", "SELECT ord, text FROM raw WHERE mix_source = 'chat'", RAW)
add("min_length", "SELECT mix_source, ord, length(text) AS n_chars FROM docs", DOCS)
add("min_length_strict", "SELECT mix_source, ord, length(text) AS n_chars FROM docs", SAMPLE)
add("source_estimate", """SELECT coalesce(mix_source, '__total__') AS mix_source, CAST(sum(n) AS BIGINT) AS n_samples,
    round(sum(chars) / sum(n), 6) AS avg_chars, CAST(sum(floor(chars * 0.25)) AS BIGINT) AS est_tokens,
    CASE WHEN grouping(mix_source) = 0 THEN max(head) END AS first_text
  FROM (SELECT mix_source, count(*) AS n, sum(length(text)) AS chars, arg_min(left(text, 100), ord) AS head
    FROM (SELECT *, row_number() OVER (PARTITION BY mix_source ORDER BY ord) AS rn FROM docs) WHERE rn <= 10000
    GROUP BY mix_source) GROUP BY GROUPING SETS ((mix_source), ())""", SAMPLE)
add("tokenizer_sample", """SELECT mix_source, ord, length(text) AS n_chars FROM (SELECT *, row_number() OVER
    (PARTITION BY mix_source ORDER BY ord) AS rn FROM docs)
  WHERE rn <= CASE mix_source WHEN 'text' THEN 500 WHEN 'chat' THEN 50 ELSE 0 END""", SAMPLE)
add("pretokenize", f"""SELECT mix_source, ord, CAST(len(w) AS INTEGER) AS n_words, md5(array_to_string(w, chr(1))) AS words_md5
  FROM (SELECT mix_source, ord, {WORDS} AS w FROM docs)""", DOCS)
add("word_counts", "SELECT word, freq FROM wc", TRAIN)
add("pair_counts", f"""SELECT CAST(a AS INTEGER) AS left_id, CAST(b AS INTEGER) AS right_id, CAST(n AS BIGINT) AS n
  FROM ({pairs_of('s0')})""", TRAIN)
add("byte_vocab", """SELECT v.id, token_hex, is_special, CAST(coalesce(n, 0) AS BIGINT) AS n_used FROM (
    SELECT i AS id, hex(encode(t)) AS token_hex, true AS is_special FROM (SELECT unnest(%s) AS t, unnest(range(7)) AS i)
    UNION ALL SELECT unnest(ids), unnest(list_transform(range(256), lambda b: printf('%%02X', b))), false FROM lut) v
  LEFT JOIN (SELECT CAST(s AS INTEGER) AS id, sum(freq) AS n FROM (
    SELECT unnest(string_split(trim(sym), '  ')) AS s, freq FROM s0) GROUP BY 1) u USING (id)""" % LITERALS, TRAIN)
add("bpe_merges", "SELECT CAST(rank AS INTEGER) AS rank, left_id, right_id, CAST(new_id AS INTEGER) AS new_id FROM merges", LEARN.replace("{MERGES}", str(fx.LEARNED)))
add("vocab", """SELECT CAST(id AS INTEGER) AS id, token_hex, is_special FROM base UNION ALL
  SELECT CAST(parts.id AS INTEGER), string_agg(token_hex, '' ORDER BY place), false FROM parts JOIN base ON part = base.id GROUP BY parts.id""", MERGED + """,
base AS (SELECT i AS id, hex(encode(t)) AS token_hex, true AS is_special FROM (SELECT unnest(%s) AS t, unnest(range(7)) AS i)
  UNION ALL SELECT unnest(ids), unnest(list_transform(range(256), lambda b: printf('%%02X', b))), false FROM lut),
open_parts AS (SELECT new_id AS id, new_id AS part, [0] AS place FROM merges
  UNION ALL SELECT o.id, CASE WHEN s = 0 THEN left_id ELSE right_id END, list_append(o.place, s)
    FROM open_parts o JOIN merges m ON o.part = m.new_id, (SELECT unnest([0, 1]) AS s)),
parts AS (SELECT * FROM open_parts WHERE part < 263)""" % LITERALS)
add("encode_bytes", f"""SELECT mix_source, ord, CAST(len(i) AS INTEGER) AS n_ids, array_to_string(i, ' ') AS ids
  FROM (SELECT mix_source, ord, {IDS} AS i FROM docs)""", DOCS + ", " + LUT)
add("encode_special", f"""SELECT mix_source, ord, len(a) AS n_special, len(b) AS n_plain,
    md5(array_to_string(a, ' ')) AS special_md5, md5(array_to_string(b, ' ')) AS plain_md5
  FROM (SELECT mix_source, ord, {IDS} AS a, {PLAIN_IDS} AS b FROM docs)""", DOCS + ", " + LUT)
add("frame_docs", """SELECT mix_source, ord, n_tokens, ids[1] AS first_id, ids[-1] AS last_id,
    md5(array_to_string(ids, ' ')) AS ids_md5 FROM framed""", FRAMED)
for _q in ("encode_bpe", "encode_bpe_in_place"):
    add(_q, """SELECT mix_source, ord, CAST(len(string_split(ids, ' ')) AS INTEGER) AS n_ids, ids FROM encoded""", BPE)
add("decode_ids", """SELECT e.mix_source, e.ord, len(string_split(e.ids, ' ')) + 2 AS n_tokens,
    '<s>' || r.text || '</s>' AS decoded FROM encoded e JOIN raw r USING (mix_source, ord)""", BPE)
add("roundtrip", "SELECT mix_source, count(*) AS n_docs, 0 AS n_mismatch FROM docs GROUP BY mix_source", DOCS)
add("fertility", """SELECT mix_source, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS n_chars,
    CAST(sum(n_tokens) AS BIGINT) AS n_tokens, CAST(floor(sum(length(text)) * 0.25) AS BIGINT) AS est_tokens,
    round(sum(n_tokens) / sum(length(text)), 6) AS tokens_per_char FROM docs JOIN counted USING (mix_source, ord)
  GROUP BY mix_source""", COUNTED)
add("train_val_split", "SELECT mix_source, ord, split FROM counted", COUNTED)
add("budgets", """SELECT mix_source, round(share, 6) AS share, budget, CAST(coalesce(sum(n_tokens), 0) AS BIGINT) AS available
  FROM budgets LEFT JOIN counted USING (mix_source) GROUP BY ALL""", COUNTED + ", " + BUDGETS)
add("budget_cut", "SELECT mix_source, ord, split, n_tokens FROM cut", CUT)
add("split_totals", """SELECT mix_source, split, count(*) AS n_docs, CAST(sum(n_tokens) AS BIGINT) AS n_tokens
  FROM counted GROUP BY ALL""", COUNTED)
add("shards_greedy", "SELECT mix_source, split, ord, shard FROM fill", GREEDY)
add("shards_offset", "SELECT mix_source, split, ord, start_tok, shard FROM placed", OFFSET)
add("shard_totals", "SELECT mix_source, split, shard, num_tokens, n_docs, min_ord, max_ord FROM totals", OFFSET)
add("shard_numbering", "SELECT mix_source, split, shard, shard_idx, num_tokens FROM numbered",
    GREEDY + ", " + totals("fill", "totals") + ", " + numbering("totals", "numbered"))
add("manifest_versions", """SELECT version, path, num_tokens, CAST(sum(n) OVER (ORDER BY version RANGE UNBOUNDED PRECEDING) AS BIGINT) AS total FROM (
  SELECT CASE source WHEN 'text' THEN 0 WHEN 'code' THEN 1 ELSE 2 END AS version, path, num_tokens, num_tokens AS n FROM entries)""", ENTRIES)
add("stream_shards", """SELECT mix_source, split, shard, shard_idx, num_tokens, n_docs, min_ord, max_ord FROM numbered
  WHERE mix_source = 'text'""", GREEDY + ", " + totals("fill", "totals") + ", " + numbering("totals", "numbered"))
add("stream_stalls", f"""SELECT run_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_ts, strftime(until, '%Y-%m-%d %H:%M:%S') AS silent_from, best, best_step, n_seen
  FROM (SELECT CAST(user_id AS VARCHAR) AS run_id, ts, ts + INTERVAL {fx.SILENT_SECONDS} SECOND AS until, lead(ts) OVER w AS later, max(ts) OVER () AS newest,
    min(value) OVER w AS best, arg_min(event_id, value) OVER w AS best_step, count(*) OVER w AS n_seen
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE coalesce(later >= until, newest >= until)""")
add("shard_table", """SELECT mix_source, split, shard_idx, ord, n_tokens, md5(array_to_string(ids, ' ')) AS ids_md5
  FROM framed""", FRAMED)
add("export_bin", "SELECT path, num_tokens, shard_idx, source, split FROM entries", ENTRIES)
add("discover_shards", "SELECT path, num_tokens, shard_idx, source, split FROM entries", ENTRIES)
add("read_shards", """SELECT mix_source AS source, split, shard_idx, CAST(sum(len(ids)) AS BIGINT) AS num_tokens,
    CAST(sum(list_sum(ids)) AS BIGINT) AS id_sum FROM framed GROUP BY ALL""", FRAMED)
add("ingest_status", f"SELECT count(*) AS n_files, count(*) * {fx.SHARD_SIZE} AS est_tokens, 'ACTIVE' AS state FROM entries", ENTRIES)
add("parse_shard_name", "SELECT path AS name, source, split, shard_idx FROM entries", ENTRIES)
add("manifest", "SELECT split, path, num_tokens, shard_idx, source FROM entries", ENTRIES)
add("require_shards", """SELECT split, count(*) AS n_shards, CAST(sum(num_tokens) AS BIGINT) AS n_tokens
  FROM entries GROUP BY split""", ENTRIES)
add("resync_manifest", """SELECT 263 AS vocab_size, max(num_tokens) FILTER (WHERE split = 'train') AS shard_size, 'uint16' AS dtype,
    CAST(sum(num_tokens) FILTER (WHERE split = 'train') AS BIGINT) AS total_train_tokens,
    CAST(sum(num_tokens) FILTER (WHERE split = 'val') AS BIGINT) AS total_val_tokens,
    round(sum(num_tokens) FILTER (WHERE split = 'val') / sum(num_tokens), 6) AS val_fraction,
    string_agg(path, ',' ORDER BY shard_idx) FILTER (WHERE split = 'train') AS train_paths,
    string_agg(path, ',' ORDER BY shard_idx) FILTER (WHERE split = 'val') AS val_paths FROM entries""", ENTRIES)
add("select_split", """SELECT split, path, num_tokens FROM entries WHERE split = CASE WHEN EXISTS (
    SELECT 1 FROM entries WHERE split = 'val') THEN 'val' ELSE 'train' END""", ENTRIES)
add("manifest_drift", f"""SELECT coalesce(a.name, b.name) AS name, a.num_tokens AS listed_tokens, b.num_tokens AS disk_tokens,
    CASE WHEN b.name IS NULL THEN 'missing_on_disk' WHEN a.name IS NULL THEN 'not_in_manifest'
      WHEN a.num_tokens <> b.num_tokens THEN 'size_mismatch' ELSE 'both' END AS status
  FROM (SELECT {NAME} AS name, num_tokens FROM early_numbered) a
  FULL JOIN (SELECT {NAME} AS name, num_tokens FROM numbered) b ON a.name = b.name""",
    CUT + ", " + ", ".join([offset("counted", "placed"), totals("placed", "totals"), numbering("totals", "numbered"),
                            offset("cut", "early"), totals("early", "early_totals"),
                            numbering("early_totals", "early_numbered")]))
add("size_report", """SELECT mix_source, split, CAST(sum(num_tokens) AS BIGINT) AS n_tokens,
    CAST(sum(num_tokens) * 2 AS BIGINT) AS n_bytes, round(sum(num_tokens) * 2 * 1.2::DOUBLE, 1) AS bytes_needed,
    round(sum(num_tokens) * 2 * 1.2::DOUBLE * 1.5::DOUBLE, 1) AS bytes_headroom FROM totals GROUP BY ALL""", OFFSET)
_step = fx.BATCH * fx.SEQ_LEN
add("mixture_report", f"""SELECT mix_source, round(share * 100, 4) AS target_pct,
    round(train_tokens / sum(train_tokens) OVER () * 100, 4) AS achieved_pct,
    round((train_tokens / sum(train_tokens) OVER () - share) * 100, 4) AS delta_pct, budget, n_docs,
    n_tokens, train_tokens, n_tokens < budget AS exhausted,
    round({fx.MAX_TOKENS // _step * _step} / sum(train_tokens) OVER (), 6) AS run_epochs
  FROM (SELECT mix_source, share, budget, count(ord) AS n_docs, CAST(coalesce(sum(n_tokens), 0) AS BIGINT) AS n_tokens,
      CAST(coalesce(sum(n_tokens) FILTER (WHERE split = 'train'), 0) AS BIGINT) AS train_tokens
    FROM budgets LEFT JOIN cut USING (mix_source) GROUP BY ALL)""", CUT)
add("progress", """SELECT mix_source, n_samples, n_tokens, greatest(budget - n_tokens, 0) AS remaining, 820000.0::DOUBLE AS rate,
    round(n_tokens / 820000.0::DOUBLE, 6) AS elapsed_seconds, round(greatest(budget - n_tokens, 0) / 820000.0::DOUBLE, 6) AS eta_seconds FROM (
    SELECT mix_source, row_number() OVER w AS n_samples, CAST(sum(n_tokens) OVER w AS BIGINT) AS n_tokens FROM counted
    WINDOW w AS (PARTITION BY mix_source ORDER BY ord)) JOIN budgets USING (mix_source) WHERE n_samples % 50 = 0""",
    COUNTED + ", " + BUDGETS)
add("corpus_overview", """SELECT mix_source, split, n_docs, n_tokens, n_shards, round(share * 100, 4) AS target_pct,
    round(n_tokens / sum(n_tokens) OVER (PARTITION BY split) * 100, 4) AS achieved_pct
  FROM (SELECT mix_source, split, count(*) AS n_docs, CAST(sum(n_tokens) AS BIGINT) AS n_tokens,
    count(DISTINCT shard) AS n_shards FROM placed GROUP BY ALL) JOIN budgets USING (mix_source)""",
    CUT + ", " + offset("cut", "placed"))
_listed = NUMBERED + ", listed AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY shard_idx) - 1 AS pos FROM numbered)"
add("worker_assign", f"SELECT split, shard_idx, pos, CAST(pos % {fx.WORKERS} AS INTEGER) AS worker FROM listed", _listed)
add("rank_assign", "SELECT split, shard_idx, pos, rank, worker FROM laned", LANES)
add("shuffle_shards", """SELECT split, rank, worker, shard_idx, CAST(read_pos AS INTEGER) AS read_pos,
    CAST(stream_off AS BIGINT) AS stream_off FROM streams""", STREAMS)
add("epochs", f"""SELECT CAST(epoch AS INTEGER) AS epoch, split, rank, worker, shard_idx,
    CAST(row_number() OVER {order_by_hash('epoch')}) - 1 AS INTEGER) AS read_pos
  FROM (SELECT *, unnest([0, 1]) AS epoch FROM laned)""", LANES)
add("sequence_count", f"""SELECT split, CAST(sum(num_tokens) AS BIGINT) AS n_tokens,
    CAST(sum(num_tokens) // {fx.SEQ_LEN} AS BIGINT) AS n_sequences,
    CAST(sum(num_tokens) // {fx.SEQ_LEN} // {fx.RANKS} AS BIGINT) AS n_per_rank FROM numbered GROUP BY split""", NUMBERED)
add("pack_sequences", """SELECT split, rank, worker, seq_idx, md5(array_to_string(ids, ' ')) AS ids_md5 FROM seqs""", PACKED)
add("pack_from_files", "SELECT split, rank, worker, seq_idx, md5(array_to_string(ids, ' ')) AS ids_md5 FROM seqs", PACKED)
_bpe_counted = BPE + f""", counted AS (SELECT mix_source, source_ord, e.ord, CAST(len(string_split(ids, ' ')) + 2 AS BIGINT) AS n_tokens,
    CASE WHEN CAST('0x' || substr(md5('{fx.SEED}:' || mix_source || ':' || e.ord), 1, 8) AS BIGINT)
      < {fx.VAL_FRACTION} * 4294967296 THEN 'val' ELSE 'train' END AS split,
    3 + list_sum(list_transform(string_split(ids, ' '), lambda s: CAST(s AS BIGINT))) AS id_sum
  FROM encoded e JOIN raw r USING (mix_source, ord))"""
add("pipeline_shards", f"""SELECT split, {NAME} AS path, num_tokens, shard_idx, mix_source AS source, CAST(id_sum AS BIGINT) AS id_sum FROM numbered
  JOIN (SELECT mix_source, split, shard, sum(id_sum) AS id_sum FROM fill JOIN counted USING (mix_source, split, ord) GROUP BY ALL)
  USING (mix_source, split, shard)""", _bpe_counted + GREEDY[len(COUNTED):] + ", " + totals("fill", "totals") + ", " + numbering("totals", "numbered"))
add("next_token_pairs", """SELECT split, rank, worker, seq_idx, ids[1] AS first_id, ids[2] AS first_label,
    true AS last_unlabelled, md5(array_to_string(ids[2:], ' ')) AS labels_md5 FROM seqs""", PACKED)
_batched = f"WHERE (batch_id + 1) * {fx.BATCH} <= n_seq"
add("batches", f"SELECT split, rank, worker, batch_id, seq_idx FROM full_seqs {_batched}", PACKED)
add("val_cap", f"""SELECT rank, worker, batch_id, seq_idx, max_batches FROM full_seqs, (SELECT CAST(greatest(1, least(
    coalesce(sum(num_tokens) FILTER (WHERE split = 'val'), 0) // {fx.BATCH * fx.SEQ_LEN}, 500)) AS BIGINT) AS max_batches
    FROM numbered) c {_batched} AND split = 'val' AND batch_id < max_batches""", PACKED)
add("weighted_loss", """SELECT run_id, round(sum(loss * tokens) / sum(tokens), 6) AS loss FROM steps GROUP BY run_id""", STEPS)
add("perplexity", """SELECT run_id, step, round(exp(least(loss, 20)), 2) AS ppl_capped, loss >= 20 AS ppl_infinite,
    CASE WHEN loss < 20 THEN round(exp(loss), 2) END AS ppl FROM steps""", STEPS)
add("rank_mean_loss", """SELECT run_id, count(*) AS n_ranks, round(avg(l), 6) AS mean_loss, round(sum(lt) / sum(t), 6) AS weighted_loss,
    round(exp(arg_min(l, rank)), 6) AS perplexity FROM (SELECT run_id, rank, sum(loss * tokens) / sum(tokens) AS l,
    sum(loss * tokens) AS lt, sum(tokens) AS t FROM steps GROUP BY ALL) GROUP BY run_id""", STEPS)
add("bench_summary", f"""SELECT run_id, count(*) AS n_steps, round(avg(step_time) * 1000, 6) AS step_time_ms,
    round(avg(data_wait) * 1000, 6) AS data_wait_ms, round(avg(data_wait) / avg(step_time) * 100, 6) AS data_wait_pct,
    round(sum(tokens) / sum(step_time), 6) AS tokens_per_sec, round(max(gpu_mem), 6) AS peak_mem_gb,
    round(sum(tokens) / sum(step_time) * {FLOPS} / 82.6e12 * 100, 6) AS mfu_pct FROM steps WHERE step >= 20 GROUP BY run_id""", STEPS)
add("mfu", f"""SELECT run_id, device, peak, round(sum(tokens) / sum(step_time) * {FLOPS} / (peak * 1e12) * 100, 6) AS mfu_pct
  FROM (SELECT *, ['NVIDIA H100 80GB', 'NVIDIA A100-SXM4', 'NVIDIA GeForce RTX 4090', 'Other'][rank + 1] AS device,
    CAST([989.0, 312.0, 82.6, 82.6][rank + 1] AS DOUBLE) AS peak FROM steps) GROUP BY run_id, device, peak""", STEPS)
_cols = {"tokens_per_sec": 4, "data_wait_ms": 9, "loss": 0, "perplexity": 2, "grad_norm": 0, "gpu_mem": 0}
add("interval_metrics", "SELECT run_id, interval, last_step, tokens, " + ", ".join(f"round({c}, {p}) AS {c}" if p else c for c, p in _cols.items())
    + " FROM iv", INTERVALS)
_tags = {"train/loss": "loss", "train/perplexity": "perplexity", "train/grad_norm": "grad_norm",
         "train/tokens_per_sec": "tokens_per_sec", "system/gpu_mem_allocated": "gpu_mem",
         "system/dataloader_wait_ms": "data_wait_ms"}
add("metrics_long", " UNION ALL ".join(
    f"SELECT run_id, '{t}' AS tag, last_step AS step, round({c}, {_cols[c]}) AS value FROM iv" if _cols[c] else
    f"SELECT run_id, '{t}' AS tag, last_step AS step, {c} AS value FROM iv" for t, c in _tags.items()), INTERVALS)
add("run_health", """SELECT run_id, n_steps, zero_loss, zero_grad, round(early, 6) AS early_loss, round(late, 6) AS final_loss,
    late < early - 0.01 AS loss_falls, first > 0.1 AS starts_high, round(first - ln(32768), 6) AS first_minus_ln_vocab,
    NOT zero_loss AND NOT zero_grad AND late < early - 0.01 AND first > 0.1 AS healthy
  FROM (SELECT run_id, count(*) AS n_steps, coalesce(bool_or(loss = 0) FILTER (WHERE i > 50), false) AS zero_loss,
      coalesce(bool_or(grad_norm = 0) FILTER (WHERE i > 50), false) AS zero_grad,
      avg(loss) FILTER (WHERE i BETWEEN 50 AND 59) AS early, avg(loss) FILTER (WHERE back <= 10) AS late,
      arg_min(loss, i) AS first
    FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step) - 1 AS i,
      row_number() OVER (PARTITION BY run_id ORDER BY step DESC) AS back FROM steps) GROUP BY run_id)""", STEPS)
add("rolling_step_time", """SELECT run_id, step, step_time, round(avg(step_time) OVER (PARTITION BY run_id
    ORDER BY step ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 12) AS mean_step_time FROM steps""", STEPS)
add("best_checkpoints", """SELECT run_id, step, loss AS val_loss, b AS best_before FROM (
    SELECT *, min(loss) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b
    FROM steps) WHERE b IS NULL OR loss < b""", STEPS)
add("retention_plan", """SELECT user_id AS run_id, 'runs/' || user_id || '/' || printf('checkpoint_step_%07d.pt', event_id) AS path,
    event_id AS step FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
    FROM events WHERE value >= 5) WHERE rn > 3""")
_days = """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS tag, count(*) AS n, round(sum(value), 4) AS total
  FROM events {} GROUP BY ALL"""
add("metrics_by_day", _days.format(""))
add("stream_metrics", _days.format("WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"))
add("bigram_perplexity", """SELECT mix_source, CAST(sum(n) AS BIGINT) AS n_tokens, round(sum(n * l) / sum(n), 6) AS loss,
    round(exp(least(sum(n * l) / sum(n), 20)), 6) AS perplexity
  FROM (SELECT v.mix_source, v.n, -ln((coalesce(f.c, 0) + 1) / (coalesce(x.c, 0) + 263.0::DOUBLE)) AS l
    FROM big v LEFT JOIN (SELECT prev, next, sum(n) AS c FROM big WHERE split = 'train' GROUP BY ALL) f USING (prev, next)
    LEFT JOIN (SELECT prev, sum(n) AS c FROM big WHERE split = 'train' GROUP BY ALL) x ON v.prev = x.prev
    WHERE v.split = 'val') GROUP BY mix_source""", BIGRAMS)
add("topk_nucleus", "SELECT context, token, round(prob, 6) AS prob FROM cand", NUCLEUS)
add("sample_next", """SELECT context, arg_max(token, ln(prob) - ln(-ln((CAST('0x' || substr(md5('7:' || context || ':' || token), 1, 8)
    AS BIGINT) + 0.5) / 4294967296))) AS token FROM cand GROUP BY context""", NUCLEUS)
add("stream_ingest", f"""SELECT doc_id AS ord, CAST(strlen(regexp_replace(text, '{SPECIAL}', '~', 'g')) + 2 AS BIGINT) AS n_tokens
  FROM documents WHERE length(trim(text)) >= 20""")
add("stream_manifest", "SELECT split, path, num_tokens, shard_idx, source FROM entries", ENTRIES)
add("stream_best", """SELECT event_type AS run_id, min(value) AS best, arg_min(event_id, (value, event_id)) AS best_step,
    count(*) AS n_seen, false AS stalled FROM events GROUP BY event_type""")
