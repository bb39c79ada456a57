"""DuckDB SQL for the queries of this folder that SQL can express."""

OP1 = r"""
WITH p AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM pages),
q AS (
  SELECT *, CASE
      WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
    END AS rule
  FROM p),
r AS (
  SELECT *, CASE WHEN rule IS NOT NULL THEN NULL
      WHEN regexp_matches(low, '^[^:/?#]*://([^/?#]*\.)?health\.gov([^a-z0-9_.%-]|$)') THEN '||health.gov^'
      WHEN regexp_matches(low, '(?s)free.*download.*crack') THEN '*free*download*crack*'
      WHEN regexp_matches(low, 'cheap-pills\.') THEN 'cheap-pills.'
      WHEN regexp_matches(low, '/wp-login([^a-z0-9_.%-]|$)') THEN '/wp-login^'
      WHEN contains(low, '/adserver/') THEN '/adserver/'
      WHEN regexp_matches(low, '^[^:/?#]*://([^/?#]*\.)?casino\.') THEN '||casino.'
      WHEN regexp_matches(low, '/tracker([^a-z0-9_.%-]|$)') THEN '/tracker^'
      WHEN contains(low, '.casino.') THEN '.casino.'
      WHEN contains(low, '/banner/') THEN '/banner/'
      WHEN contains(low, '-casino.') THEN '-casino.'
      WHEN regexp_matches(low, '/viagra([^a-z0-9_.%-]|$)') THEN '/viagra^'
      WHEN regexp_matches(low, '^[^:/?#]*://([^/?#]*\.)?ads\.') THEN '||ads.'
      WHEN regexp_matches(low, '/porn([^a-z0-9_.%-]|$)') THEN '/porn^'
    END AS pattern_rule
  FROM q)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN pattern_rule IS NULL OR pattern_rule = '||health.gov^' THEN 'allow'
            ELSE 'block' END AS verdict,
       pattern_rule
FROM r
"""

OP10 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT rid, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
win AS (
  SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT rid, g FROM win GROUP BY ALL HAVING count(*) > 1),
cov AS (
  SELECT rid, count(DISTINCT j) AS n FROM (
    SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM win JOIN rep USING (rid, g)) GROUP BY rid),
ln AS (
  SELECT rid, source, text, raw,
         trim(regexp_replace(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM (SELECT rid, source, text, unnest(string_split(text, chr(10))) AS raw FROM d)),
dup AS (
  SELECT rid, count(*) - count(DISTINCT raw) AS n FROM ln WHERE norm <> '' GROUP BY rid),
hosts AS (SELECT source, count(DISTINCT text) AS host_docs FROM documents GROUP BY source),
often AS (
  SELECT ln.source, norm, count(DISTINCT text) AS n_docs, any_value(host_docs) AS host_docs
  FROM ln JOIN hosts ON ln.source IS NOT DISTINCT FROM hosts.source
  WHERE norm <> '' GROUP BY ln.source, norm),
lost AS (
  SELECT rid, sum(len(string_split(ln.norm, ' '))) AS n
  FROM ln JOIN often ON ln.source IS NOT DISTINCT FROM often.source AND ln.norm = often.norm
  WHERE n_docs > 20 AND (n_docs > 0.02 * host_docs OR n_docs > 1000) GROUP BY rid),
b AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words,
         list_sum(list_transform(ws, lambda x: length(x)))::BIGINT AS wc,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
         coalesce(lost.n, 0)::BIGINT AS n_removed_words
  FROM d JOIN w USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN lost USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, coalesce(wc, 0)::BIGINT AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
       base_failed, n_removed_words,
       NOT base_failed AND NOT (n_removed_words > 0 AND (n_removed_words > 0.7 * n_words
                                OR n_words - n_removed_words < 20)) AS kept
FROM f
"""

OP7 = r"""
WITH h AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
m AS (SELECT body, max(page_id) AS best FROM h GROUP BY body)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(hex, 1 + 5 * (k // 4), 5))::INT >> (15 - 5 * (k % 4))) & 31)::INT, 1)),
           'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM best THEN NULL ELSE best END AS refers_to
FROM h JOIN m USING (body)
"""

OP8 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
win AS (
  SELECT rid, doc_id, i, array_to_string(ws[i:i + 49], ' ') AS g
  FROM (SELECT rid, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d)),
low AS (SELECT g, min(doc_id) AS low FROM win GROUP BY g),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 50)) AS j FROM win JOIN low USING (g) WHERE low < doc_id),
k AS (
  SELECT rid, count(*) AS n, list(j) AS js FROM gone GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN n IS NULL THEN ws
                                   ELSE list_where(ws, list_transform(range(1, len(ws) + 1),
                                        lambda x: NOT list_contains(js, x))) END, ' ')) AS kept_sha256
FROM d LEFT JOIN k USING (rid)
"""

OP9 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents),
win AS (
  SELECT rid, i, b[i:i + 199] AS g
  FROM (SELECT rid, b, unnest(range(1, octet_length(b) - 198)) AS i FROM d)),
rep AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
hit AS (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS prev FROM win JOIN rep USING (g)),
isl AS (
  SELECT rid, i, sum(CASE WHEN prev IS NULL OR i > prev + 200 THEN 1 ELSE 0 END)
                 OVER (PARTITION BY rid ORDER BY i) AS k FROM hit),
span AS (SELECT rid, k, min(i) AS s, max(i) + 199 AS e FROM isl GROUP BY rid, k),
gap AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY s), 0) AS prev_e FROM span),
r AS (
  SELECT rid, sum(e - s + 1)::BIGINT AS n_removed, count(*) AS n_spans, max(e) AS last_e,
         string_agg(substr(hex(b), 2 * prev_e + 1, 2 * (s - 1 - prev_e)), '' ORDER BY s) AS head
  FROM gap JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(CASE WHEN head IS NULL THEN b ELSE unhex(head || substr(hex(b), 2 * last_e + 1)) END) AS kept_sha256
FROM d LEFT JOIN r USING (rid)
"""

#: Unsigned CRC-32 of an ASCII string {s}, bit by bit: a byte, then eight steps marked by -1.
CRC32 = r"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({s}, ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"""

OP11 = r"""
WITH t AS (
  SELECT conv_id, k, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(k)) AS p
  FROM (SELECT conv_id, turn, strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS k,
               length(coalesce(text, '')) AS chars
        FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, """ + CRC32.format(s="conv_id::VARCHAR") + r""" % 6 AS h
      FROM t GROUP BY conv_id),
own AS (
  SELECT c.conv_id, 0 AS part, p, k, chars FROM c JOIN t ON t.conv_id = c.base AND p <= h
  UNION ALL SELECT c.conv_id, 1, p, k, chars FROM c JOIN t ON t.conv_id = c.conv_id AND p > h),
path AS (
  SELECT conv_id, chars, list(k) OVER w AS pre, count(*) OVER w AS j
  FROM own WINDOW w AS (PARTITION BY conv_id ORDER BY part, p)
  UNION ALL SELECT conv_id, 0, [], 0 FROM c),
node AS (
  SELECT pre, j, max(chars) AS chars, min(conv_id) AS low, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (j = n), '')) AS ends_sha256
  FROM path JOIN (SELECT conv_id, max(j) AS n FROM path GROUP BY conv_id) USING (conv_id) GROUP BY pre, j),
kids AS (SELECT pre[1:j - 1] AS up, count(*) AS n_children FROM node WHERE j > 0 GROUP BY up),
sub AS (
  SELECT pre[1:d] AS up, sum((n_children IS NULL)::INT) AS n_leaves, sum((n_convs - 1) * chars) AS saved
  FROM (SELECT node.*, n_children, unnest(range(0, j + 1)) AS d FROM node LEFT JOIN kids ON kids.up = pre) GROUP BY ALL)
SELECT node.low AS conv_id, node.j::BIGINT AS depth, parent.low AS parent_conv_id, node.n_convs::BIGINT AS n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
       node.ends_sha256
FROM node JOIN sub ON sub.up = node.pre LEFT JOIN kids ON kids.up = node.pre
LEFT JOIN node AS parent ON node.j > 0 AND parent.pre = node.pre[1:node.j - 1]
"""


def _tree(name: str, levels: int) -> str:
    """CTEs <name>1.. (nodes) and <name>s0.. (siblings) above <name>0 (g, pos, n, d), for 16 ** levels leaves."""
    out = []
    for k in range(levels):
        out.append(f"""
{name}s{k} AS (
  SELECT g, pos, n, coalesce(string_agg(d, '') OVER (PARTITION BY g, pos // 16 ORDER BY pos
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(d, '') OVER (PARTITION BY g, pos // 16 ORDER BY pos
                       ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k}),
{name}{k + 1} AS (
  SELECT g, pos // 16 AS pos, (n + 15) // 16 AS n,
         CASE WHEN n = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d
  FROM {name}{k} GROUP BY ALL),""")
    return "".join(out).replace("GROUP BY ALL", "GROUP BY g, pos // 16, n")


def _walk(name: str, levels: int, digest: str, place: str, group: str) -> tuple[str, str, str]:
    """(joins, proof, folded digest) of a leaf up the tree."""
    joins, proof = "", []
    for k in range(levels):
        x = f"{name}s{k}"
        joins += f"\n  JOIN {x} ON {x}.g = {group} AND {x}.pos = {place} // {16 ** k}"
        proof += [f"{x}.l", f"{x}.r"]
        digest = f"CASE WHEN {x}.n = 1 THEN {digest} ELSE sha256({x}.l || {digest} || {x}.r) END"
    return joins, " || ".join(proof), digest


def _op12(in_source: int = 3, over_sources: int = 2) -> str:
    """Up to 16 ** in_source documents in a source and 16 ** over_sources sources."""
    enc = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    fields = [enc(c) for c in ("doc_id", "source", "lang", "n_chars")]
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = f"sha256({' || '.join([*fields, enc('text')])})"
    other = f"sha256({' || '.join([*fields, enc(low)])})"
    crc = CRC32.format(s="coalesce(doc_id, 0)::VARCHAR")
    joins, proof, end = _walk("a", in_source, "f0", "x.pos", "x.g")
    top_joins, top_proof, top_end = _walk("b", over_sources, "y.end_", "y.rank", "0")
    return f"""
WITH x0 AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, {leaf} AS d,
         CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN {other} END AS other
  FROM documents),
x AS (
  SELECT doc_id, g, d, coalesce(other, d) AS f0, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS pos,
         count(*) OVER (PARTITION BY g) AS n
  FROM x0),
a0 AS (SELECT g, pos, n, d FROM x),{_tree("a", in_source)}
src AS (SELECT g AS name, d, row_number() OVER (ORDER BY g) - 1 AS rank, count(*) OVER () AS n FROM a{in_source}),
b0 AS (SELECT 0 AS g, rank AS pos, n, d FROM src),{_tree("b", over_sources)}
y AS (
  SELECT x.doc_id, x.d AS leaf, src.d AS subroot, src.rank, {proof} AS proof, {end} AS end_
  FROM x JOIN src ON src.name = x.g{joins}),
z AS (
  SELECT y.doc_id, y.leaf, y.subroot, y.proof || {top_proof} AS proof, {top_end} AS folded_root FROM y{top_joins})
SELECT doc_id, leaf, subroot, root.d AS root, sha256(proof) AS proof_sha256, folded_root, folded_root = root.d AS verified
FROM z, b{over_sources} AS root
"""


OP12 = _op12()

ORACLES = {"op9_suffix_array_dedup": OP9, "op8_substring_dedup": OP8, "op7_warc": OP7, "op1_url_filters": OP1,
           "op10_quality_rules": OP10, "op11_prefix_trie": OP11, "op12_merkle_manifest": OP12}
