"""SQL of the queries that SQL can express, written for DuckDB over the same tables."""

from __future__ import annotations

from shardloom.llm.centroids import CENTROIDS, DIM, ROUNDS
from shardloom.llm.centroids import SCALE as KMEANS_SCALE
from shardloom.llm.centroids import SEED as KMEANS_SEED
from shardloom.llm.common import LOWER, UPPER
from shardloom.llm.decontaminate import WINDOW
from shardloom.llm.pareto_mix import FACTOR, MOST_COPIES, SEED, WEIGHTS
from shardloom.llm.resample import BUCKETS, DRAWN_PERCENT, LEAST_WORDS
from shardloom.llm.resample import SEED as RESAMPLE_SEED
from shardloom.llm.secret_ledger import BASE_RULES, RULES
from shardloom.llm.topk import SCALE as TOPK_SCALE
from shardloom.llm.topk import TOP
from shardloom.llm.url_templates import FAN, MERGE_Z, PRIOR, REJECT, SMOOTHING, SUPPORT
from shardloom.llm.url_templates import RULES as URL_RULES
from shardloom.llm.warc import LEAST_BYTES

ORACLE: dict[str, str] = {}


def folded(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{UPPER}', '{LOWER}')"


ORACLE["op6_exact_dedup"] = f"""WITH n AS (SELECT doc_id, {folded('text')} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)"""

ORACLE["op8_warc"] = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS h, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p WHERE n >= {LEAST_BYTES} GROUP BY h)
SELECT page_id, n AS payload_bytes, sha256(p.h) AS payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.h = f.h"""

_letters = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE["op5_benchmark_decontamination"] = f"""WITH d AS (SELECT doc_id, {_letters.format(folded('text'))} AS w FROM documents),
i AS (SELECT item_id, {_letters.format(folded('text'))} AS w FROM benchmark),
windows AS MATERIALIZED (SELECT DISTINCT item_id, k, array_to_string(w[pos:pos + k - 1], ' ') AS words FROM (
  SELECT item_id, w, least(len(w), {WINDOW}) AS k, unnest(range(1, greatest(1, len(w) - {WINDOW - 1}) + 1)) AS pos FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM windows),
runs AS (SELECT doc_id, k, pos, array_to_string(w[pos:pos + k - 1], ' ') AS words FROM (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS pos FROM d, sizes WHERE len(w) >= k)),
met AS MATERIALIZED (SELECT doc_id, item_id, r.k, pos FROM runs r JOIN windows v ON r.k = v.k AND r.words = v.words),
hits AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(pos, pos + k)) FROM met) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits h USING (doc_id) LEFT JOIN named USING (doc_id)"""


def _found(place: int, rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    judged = f"regexp_extract_all(text, '{pattern}', {rule.group})"
    return f"""SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, pos,
      length(gaps[pos]) AS gap, length(found[pos]) AS size, length(judged[pos]) AS judged, {rule.least} AS least
    FROM (SELECT *, unnest(range(1, len(found) + 1)) AS pos FROM (
      SELECT doc_id, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}', 0) AS found, {judged} AS judged
      FROM documents WHERE regexp_matches(text, '{pattern}')))"""


_base = ", ".join(f"'{r.kind}'" for r in BASE_RULES)
ORACLE["op9_secret_scan"] = f"""WITH f AS ({' UNION ALL '.join(_found(i, r) for i, r in enumerate(RULES))}),
ends AS (SELECT *, CAST(sum(gap + size) OVER (PARTITION BY doc_id, place ORDER BY pos) AS BIGINT) AS e FROM f),
spans AS (SELECT doc_id, kind, place, e - size AS s, kind || ':' || (e - size) || ':' || e AS span FROM ends WHERE judged >= least),
per AS (SELECT doc_id, {', '.join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)},
  string_agg(span, ',' ORDER BY s, place) FILTER (WHERE kind IN ({_base})) AS base, string_agg(span, ',' ORDER BY s, place) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, {', '.join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)}, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans FROM documents d LEFT JOIN per USING (doc_id)"""

_weights = "[" + ", ".join(map(str, WEIGHTS)) + "]"
ORACLE["op10_mix_sources"] = f"""WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
  (CAST(CAST('0x' || substr(md5('{SEED}:' || doc_id), 1, 12) AS BIGINT) AS DOUBLE) + 0.5) / 281474976710656 AS u FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, {_weights}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS w, source_size * {MOST_COPIES} AS cap FROM s),
k AS (SELECT *, row_number() OVER o AS k, CAST(sum(source_size) OVER () AS DOUBLE) * {float(FACTOR)}::DOUBLE AS everything,
  coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
  sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_left
  FROM w WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / w, source NULLS LAST)),
l AS (SELECT *, (everything - before) / CAST(w_left AS DOUBLE) AS level FROM k),
stop AS (SELECT k, level FROM l WHERE level * w <= cap ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN l.k < stop.k THEN CAST(cap AS DOUBLE) ELSE least(CAST(cap AS DOUBLE), stop.level * w) END AS target FROM l, stop),
p AS (SELECT *, CAST(floor(r) AS BIGINT) AS whole, r - floor(r) AS inclusion, target - floor(r) * source_size AS rest
  FROM (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS r FROM t)),
o AS (SELECT *, u / (1 - u) / (1 / CAST(length(bin(size)) AS DOUBLE)) AS rank FROM d),
run AS (SELECT d.*, p.source_size, p.target, whole, inclusion, rest,
  sum(size) OVER (PARTITION BY d.source ORDER BY rank, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM o d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
gap AS (SELECT *, inclusion > 0 AND upto <= rest AS taken_first, rest - max(CASE WHEN upto <= rest THEN upto ELSE 0 END) OVER (PARTITION BY source) AS missing FROM run),
fill AS (SELECT *, row_number() OVER (PARTITION BY source, NOT taken_first AND inclusion > 0 AND size > 0 AND abs(size - missing) < missing
  ORDER BY abs(size - missing), rank, doc_id) = 1 AND NOT taken_first AND inclusion > 0 AND size > 0 AND abs(size - missing) < missing AS taken_last FROM gap)
SELECT doc_id, size, source_size, target, CAST((whole + CASE WHEN taken_first OR taken_last THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM fill"""

_url = r"'(?s)^.*?://([^/?#]*)([^?#]*)'"
_by_length = sorted(URL_RULES, key=lambda r: -len(r.name))
_fits = {r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in _by_length}


def _first_rule(value) -> str:
    return "CASE " + " ".join(f"WHEN {_fits[r]} THEN {value(r)}" for r in _by_length) + " END"


#: Rounds of wildcards that the statement below spells out; the given tables need one.
_ROUNDS = 3


def _wildcards(k: int) -> str:
    """Templates after one more round: rare children of wide branch points become one wildcard."""
    literal = "tpl[i] <> '*' AND NOT starts_with(tpl[i], '{')"
    return f"""n{k} AS MATERIALIZED (SELECT r, host, n, tpl, i, tpl[i] AS child, tpl[1:i - 1] AS above, {literal} AS plain
  FROM (SELECT *, unnest(range(1, len(tpl) + 1)) AS i FROM t{k})),
wide{k} AS MATERIALIZED (SELECT host, above FROM (SELECT host, above, child, sum(n) AS n FROM n{k} WHERE plain GROUP BY ALL) GROUP BY ALL
  HAVING count(*) >= {FAN} AND sum(n) < count(*) * {SUPPORT}),
t{k + 1} AS MATERIALIZED (SELECT t.r, t.host, t.segs, t.n, t.labelled, t.bad, g.tpl FROM t{k} t JOIN (
  SELECT r, list(CASE WHEN plain AND w.host IS NOT NULL THEN '*' ELSE child END ORDER BY i) AS tpl FROM n{k} x
  LEFT JOIN wide{k} w ON x.host = w.host AND x.above = w.above GROUP BY r) g USING (r))"""


_taken = "list_reduce(list(struct_pack(n := n, b := b) ORDER BY i), lambda s, x: struct_pack(n := 0::DOUBLE, b := (x.b + %s * s.b) / (x.n + %s)), %s).b"
_from = lambda start: _taken % (SMOOTHING, SMOOTHING, f"struct_pack(n := 0::DOUBLE, b := {start})")
ORACLE["op7_url_filter"] = f"""WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), {_url}, 1), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(coalesce(url, ''), {_url}, 2) AS path FROM pages),
ruled AS MATERIALIZED (SELECT *, {_first_rule(lambda r: f"'{r.name}'")} AS rule, {_first_rule(lambda r: f"'{r.verdict}'")} AS ruled,
  string_split(regexp_replace(path, '^/', ''), '/') AS parts FROM u),
formed AS MATERIALIZED (SELECT page_id, host, path, rule, ruled, CASE ruled WHEN 'block' THEN 1 WHEN 'allow' THEN 0 END AS bad,
  list_transform(parts, lambda s: CASE WHEN regexp_full_match(s, '[0-9]+') THEN '{{n}}'
    WHEN regexp_full_match(s, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN '{{date}}'
    WHEN regexp_full_match(s, '[0-9]+\\.[A-Za-z0-9]{{1,5}}') THEN '{{n}}.' || string_split(s, '.')[-1]
    WHEN regexp_matches(s, '[0-9]') AND regexp_full_match(s, '[0-9A-Fa-f-]{{8,}}') THEN '{{x}}' ELSE s END) AS segs FROM ruled),
t0 AS MATERIALIZED (SELECT row_number() OVER () AS r, *, segs AS tpl FROM (
  SELECT host, segs, count(*) AS n, count(bad) AS labelled, coalesce(sum(bad), 0) AS bad FROM formed GROUP BY host, segs)),
{', '.join(_wildcards(k) for k in range(_ROUNDS))},
hosts AS (SELECT host, string_split(host, '.') AS parts, sum(labelled) AS n, sum(bad) AS b FROM t{_ROUNDS} GROUP BY host),
levels AS MATERIALIZED (SELECT host, n, b, i, array_to_string(parts[len(parts) - i + 1:], '.') AS domain FROM (
  SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM hosts)),
domains AS (SELECT domain, sum(n)::DOUBLE AS n, sum(b)::DOUBLE AS b FROM levels GROUP BY domain HAVING sum(n) > 0),
bases AS MATERIALIZED (SELECT host, {_from(f'{PRIOR}::DOUBLE')} AS base FROM (
  SELECT host, i, d.n, d.b FROM levels l JOIN domains d USING (domain)) GROUP BY host),
steps AS MATERIALIZED (SELECT r, host, labelled, bad, i, tpl[1:i] AS node, tpl[1:i - 1] AS above FROM (
  SELECT *, unnest(range(1, len(tpl) + 1)) AS i FROM t{_ROUNDS})),
nodes AS MATERIALIZED (SELECT host, node, above, sum(labelled)::DOUBLE AS n, sum(bad)::DOUBLE AS b FROM steps GROUP BY ALL HAVING sum(labelled) > 0),
judged AS MATERIALIZED (SELECT *, abs(b / n - p) > {MERGE_Z} * sqrt(p * (1 - p) / n + 1e-9::DOUBLE) AS apart FROM (
  SELECT *, sum(b) OVER (PARTITION BY host, above) / sum(n) OVER (PARTITION BY host, above) AS p FROM nodes)),
stand AS MATERIALIZED (SELECT host, node, CASE WHEN apart THEN n ELSE sum(n) FILTER (WHERE NOT apart) OVER w END AS n,
  CASE WHEN apart THEN b ELSE sum(b) FILTER (WHERE NOT apart) OVER w END AS b FROM judged WINDOW w AS (PARTITION BY host, above)),
shares AS MATERIALIZED (SELECT r, {_from('any_value(base)')} AS share FROM (
  SELECT r, i, s.n, s.b, coalesce(base, {PRIOR}::DOUBLE) AS base FROM steps x JOIN stand s ON x.host = s.host AND x.node = s.node
  LEFT JOIN bases ON bases.host = x.host) GROUP BY r)
SELECT page_id, f.host, path, rule, coalesce(ruled, CASE WHEN coalesce(share, base, {PRIOR}) >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict
FROM formed f JOIN t0 ON f.host = t0.host AND f.segs = t0.segs LEFT JOIN shares USING (r) LEFT JOIN bases ON bases.host = f.host"""



def _crc_table() -> str:
    """The table of the reflected CRC-32, from its polynomial."""
    out = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return "[" + ", ".join(map(str, out)) + "]"


def _runs(text: str, source: str, key: str) -> str:
    """Words, and all runs of one to three of them, of every text, numbered."""
    two, three = ("list_transform(range(1, len(w){}), lambda i: {})".format(less, " || ' ' || ".join(f"w[i + {k}]" for k in range(n)))
                  for less, n in (("", 2), (" - 1", 3)))
    return f"SELECT r, {key}, w, list_concat(w, {two}, {three}) AS f FROM (SELECT row_number() OVER () AS r, {key}, {_letters.format(folded(text))} AS w FROM {source})"


_ln = "floor(1000 * ln({}))"
ORACLE["op11_target_resampling"] = f"""WITH d AS MATERIALIZED ({_runs('text', 'documents', 'doc_id')}),
i AS ({_runs('text', 'benchmark', 'item_id')}),
df AS MATERIALIZED (SELECT r, f, count(*) AS n FROM (SELECT r, unnest(f) AS f FROM d) GROUP BY r, f),
tf AS MATERIALIZED (SELECT f, count(*) AS n FROM (SELECT unnest(f) AS f FROM i) GROUP BY f),
h AS (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM df UNION SELECT f FROM tf)),
b AS MATERIALIZED (SELECT f, xor(4294967295::BIGINT, list_reduce(
    list_transform(range(1, len(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS INTEGER)),
    lambda c, v: xor(({_crc_table()})[(xor(c, v) & 255) + 1], c >> 8), 4294967295::BIGINT)) % {BUCKETS} AS bucket FROM h),
s AS (SELECT bucket, sum(n) AS n FROM df JOIN b USING (f) GROUP BY bucket), t AS (SELECT bucket, sum(n) AS n FROM tf JOIN b USING (f) GROUP BY bucket),
sizes AS (SELECT coalesce((SELECT sum(n) FROM s), 0) AS sn, coalesce((SELECT sum(n) FROM t), 0) AS tn),
g AS (SELECT bucket, CAST({_ln.format(f'(coalesce(t.n, 0) + 1)::DOUBLE * (sn + {BUCKETS})::DOUBLE / ((s.n + 1)::DOUBLE * (tn + {BUCKETS})::DOUBLE)')} AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), sizes),
w AS (SELECT r, sum(n * gain) AS weight FROM df JOIN b USING (f) JOIN g USING (bucket) GROUP BY r),
scored AS (SELECT d.r, doc_id, CAST(len(d.f) AS BIGINT) AS n_features, len(w) AS n_words, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
  CAST('0x' || substr(sha256('{RESAMPLE_SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN w ON d.r = w.r),
final AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM scored),
placed AS (SELECT *, count(*) FILTER (WHERE n_words >= {LEAST_WORDS}) OVER () AS n,
  row_number() OVER (PARTITION BY n_words >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS p FROM final)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= {LEAST_WORDS} AND p <= {DRAWN_PERCENT} * n // 100 THEN p END AS rank FROM placed"""

_whole = "[CAST(floor({}::DOUBLE * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding]"
_fine = "embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0"
ORACLE["op12_topk_search"] = f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, {_whole.format(TOPK_SCALE)} AS v FROM embeddings WHERE {_fine}),
p AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= {TOP}"""


def _clusters() -> str:
    steps = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, {_whole.format(KMEANS_SCALE)} AS v FROM embeddings WHERE len(embedding) = {DIM} AND {_fine}),
x AS MATERIALIZED (SELECT r, unnest(v) AS x, unnest(range({DIM})) AS d FROM v),
c0 AS MATERIALIZED (SELECT c, unnest(v) AS x, unnest(range({DIM})) AS d FROM (
  SELECT row_number() OVER (ORDER BY sha256('{KMEANS_SEED}:' || vec_id)) - 1 AS c, v FROM v) WHERE c < {CENTROIDS})"""]
    for k in range(ROUNDS + 1):
        steps.append(f"""a{k} AS MATERIALIZED (SELECT r, arg_min(c, s * {CENTROIDS} + c) AS c, min(s) AS distance FROM (
  SELECT x.r, c{k}.c, sum((x.x - c{k}.x) * (x.x - c{k}.x)) AS s FROM x JOIN c{k} USING (d) GROUP BY x.r, c{k}.c) GROUP BY r)""")
        if k < ROUNDS:
            steps.append(f"""c{k + 1} AS MATERIALIZED (SELECT c{k}.c, c{k}.d, coalesce(m.x, c{k}.x) AS x FROM c{k} LEFT JOIN (
  SELECT a{k}.c, x.d, CAST((sum(x.x) - (sum(x.x) % count(*) + count(*)) % count(*)) // count(*) AS BIGINT) AS x FROM x JOIN a{k} USING (r) GROUP BY a{k}.c, x.d) m
  ON m.c = c{k}.c AND m.d = c{k}.d)""")
    return f"""WITH {', '.join(steps)},
named AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS h FROM c{ROUNDS} GROUP BY c)
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, h AS centroid_sha256 FROM a{ROUNDS} a JOIN v USING (r) JOIN named ON named.c = a.c"""


ORACLE["op13_centroid_clustering"] = _clusters()
