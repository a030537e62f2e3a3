"""DuckDB SQL for the training-data queries that SQL can express on whole tables."""

from __future__ import annotations

from zlib import crc32

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

REPEATS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM d WHERE length(h) >= 200)),
f AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
g AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS opens FROM f),
r AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g) GROUP BY doc_id, run),
p AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM r),
k AS (SELECT p.doc_id, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept, CAST(sum(b - a) AS BIGINT) AS gone, count(*) AS spans
  FROM p JOIN d USING (doc_id) GROUP BY p.doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)"""

_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, {5 * i + 1}, 5) AS BIGINT) >> {15 - 5 * j}) & 31 AS INTEGER) + 1, 1)" for i in range(8) for j in range(4))

WARC = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(encode(coalesce(html, ''))) AS h FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY b) AS largest FROM p)
SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM largest THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id IS DISTINCT FROM largest THEN largest END AS refers_to FROM m"""

NEAR_DEDUP = rf"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, x FROM (SELECT doc_id, unnest(CASE WHEN len(w) >= 3 THEN [array_to_string(w[i : i + 2], ' ') FOR i IN range(1, len(w) - 1)] WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM t)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, t.doc_id = m.component_id AS kept
FROM t LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id) m USING (doc_id)"""



def _byte_remainder(b: int) -> int:
    """The entry of a crc32 table: what one byte adds, read off zlib's crc of it."""
    return crc32(bytes([b ^ 0xFF])) ^ 0xFFFFFFFF ^ 0x00FFFFFF


_TABLE = "[" + ", ".join(f"{_byte_remainder(b)}::BIGINT" for b in range(256)) + "]"


def _crc32(number: str) -> str:
    """crc32 of a number's decimal text."""
    bytes_ = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {bytes_}), lambda a, b: xor(a >> 8, {_TABLE}[xor(a & 255, b) + 1])), 4294967295)"


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR) END"


def _tree(name: str, levels: int) -> str:
    """CTEs of the levels of trees by source: name_k (source, i, h, n of the level, l and r: the siblings on either side)."""
    out = []
    for k in range(levels + 1):
        if k:
            out.append(f"{name}_{k}x AS (SELECT source, i // 16 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {name}_{k - 1} WHERE n > 1 GROUP BY source, i // 16)")
        side = "coalesce(string_agg(h, '') OVER (PARTITION BY source, i // 16 ORDER BY i ROWS BETWEEN {}), '')"
        before, after = side.format("UNBOUNDED PRECEDING AND 1 PRECEDING"), side.format("1 FOLLOWING AND UNBOUNDED FOLLOWING")
        out.append(f"{name}_{k} AS (SELECT *, count(*) OVER (PARTITION BY source) AS n, {before} AS l, {after} AS r FROM {name}_{k}x)")
    return ",\n".join(out)


def _climb(name: str, levels: int, source: str, place: str) -> tuple[str, str]:
    """(joins, siblings) of a node's way up to its tree's root."""
    joins = " ".join(f"LEFT JOIN {name}_{k} {name}{k} ON {name}{k}.source IS NOT DISTINCT FROM {source} AND {name}{k}.i = {place} // {16**k} AND {name}{k}.n > 1" for k in range(levels + 1))
    return joins, " || ".join(f"coalesce({name}{k}.l || {name}{k}.r, '')" for k in range(levels + 1))


_LEVELS, _SOURCE_LEVELS = 4, 2
_DOC_JOINS, _DOC_SIBLINGS = _climb("t", _LEVELS, "d.source", "d.i")
_SRC_JOINS, _SRC_SIBLINGS = _climb("s", _SOURCE_LEVELS, "''", "p.i")


def _steps(name: str, levels: int, start: str, end: str) -> str:
    """CTEs that fold step by step, so that no digest is spelled twice."""
    out, before = [], start
    for k in range(levels + 1):
        out.append(f"{end}{k} AS (SELECT * EXCLUDE (h), CASE WHEN {name}{k}l IS NULL THEN h ELSE sha256({name}{k}l || h || {name}{k}r) END AS h FROM {before})")
        before = f"{end}{k}"
    return ",\n".join(out)


#: Trees of up to 16**4 rows a source and 16**2 sources.
MERKLE = f"""
WITH d0 AS (SELECT doc_id, source, text, sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', 'text'))}) AS leaf,
  sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars'))} || {_field("translate(text, '" + _UPPER + "', '" + _LOWER + "')")}) AS low FROM documents),
d AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, CASE WHEN {_crc32('doc_id')} % 5 = 0 THEN low ELSE leaf END AS h FROM d0),
t_0x AS (SELECT source, i, leaf AS h FROM d),
{_tree('t', _LEVELS)},
p AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM ({' UNION ALL '.join(f'SELECT source, h FROM t_{k} WHERE n = 1' for k in range(_LEVELS + 1))})),
s_0x AS (SELECT '' AS source, i, subroot AS h FROM p),
{_tree('s', _SOURCE_LEVELS)},
r AS ({' UNION ALL '.join(f'SELECT h AS root FROM s_{k} WHERE n = 1' for k in range(_SOURCE_LEVELS + 1))}),
q AS (SELECT p.source, p.subroot, {_SRC_SIBLINGS} AS above, {', '.join(f's{k}.l AS s{k}l, s{k}.r AS s{k}r' for k in range(_SOURCE_LEVELS + 1))} FROM p {_SRC_JOINS}),
e AS (SELECT d.doc_id, d.leaf, q.subroot, sha256({_DOC_SIBLINGS} || q.above) AS proof_sha256, d.h, {', '.join(f't{k}.l AS t{k}l, t{k}.r AS t{k}r' for k in range(_LEVELS + 1))},
  {', '.join(f'q.s{k}l, q.s{k}r' for k in range(_SOURCE_LEVELS + 1))} FROM d JOIN q ON q.source IS NOT DISTINCT FROM d.source {_DOC_JOINS}),
{_steps('t', _LEVELS, 'e', 'f')},
{_steps('s', _SOURCE_LEVELS, f'f{_LEVELS}', 'g')}
SELECT doc_id, leaf, subroot, root, proof_sha256, h AS folded_root, h = root AS verified FROM g{_SOURCE_LEVELS}, r"""

TRIE = f"""
WITH t AS (SELECT conv_id, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS h, length(coalesce(text, '')) AS n, turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, h, n, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, h) - 1 AS p FROM t),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32('conv_id')} % 6 AS k FROM (SELECT DISTINCT conv_id FROM t)),
b AS (SELECT c.conv_id, o.h, o.n, o.p, 0 AS own FROM c JOIN o ON o.conv_id = c.base AND o.p < c.k UNION ALL SELECT c.conv_id, o.h, o.n, o.p, 1 FROM c JOIN o USING (conv_id) WHERE o.p >= c.k),
l AS (SELECT conv_id, list(h ORDER BY own, p) AS hs, list(n ORDER BY own, p) AS ns FROM b GROUP BY conv_id),
a AS (SELECT c.conv_id, coalesce(hs, []) AS hs, coalesce(ns, []) AS ns FROM c LEFT JOIN l USING (conv_id)),
m AS (SELECT conv_id, d AS depth, hs[1:d] AS path, ns[d] AS size, len(hs) = d AS ends FROM (SELECT *, unnest(range(0, len(hs) + 1)) AS d FROM a)),
g AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(max(size), 0) AS size, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY depth, path),
k AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY ALL),
x AS (SELECT path[1:d] AS path, d AS depth, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
  FROM (SELECT g.*, k.n_children, unnest(range(0, g.depth + 1)) AS d FROM g LEFT JOIN k ON k.path = g.path AND k.depth = g.depth) GROUP BY ALL)
SELECT g.conv_id, g.depth, u.conv_id AS parent_conv_id, g.n_convs, coalesce(k.n_children, 0) AS n_children, CAST(x.n_leaves AS BIGINT) AS n_leaves, CAST(x.saved_tokens AS BIGINT) AS saved_tokens, g.ends_sha256
FROM g JOIN x ON x.path = g.path AND x.depth = g.depth LEFT JOIN k ON k.path = g.path AND k.depth = g.depth LEFT JOIN g u ON u.depth = g.depth - 1 AND u.path = g.path[1:g.depth - 1]"""

ORACLE_SQL = {"op11_merkle_manifest": MERKLE, "op12_conversation_trie": TRIE, "op1_suffix_repeats": REPEATS, "op5_warc_round_trip": WARC, "op6_minhash_near_dedup": NEAR_DEDUP}
