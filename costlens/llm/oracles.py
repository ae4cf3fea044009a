"""SQL for DuckDB of the queries that SQL can express on whole tables."""

from __future__ import annotations

WORDS = r"list_filter(string_split_regex({0}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

#: Pairs of sets meet at a word of both prefixes, by rarity; then lengths and the whole sets decide.
LINES_SQL = f"""WITH lines AS (
  SELECT doc_id, CAST(unnest(range(len(l))) AS BIGINT) AS line, unnest(l) AS t FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), held AS (
  SELECT doc_id, line, list_sort(list_distinct({WORDS.format('t')})) AS s FROM lines
), sets AS (
  SELECT s, row_number() OVER (ORDER BY s) AS id, len(s) AS n, min({{'d': doc_id, 'l': line}}) AS place FROM held WHERE len(s) > 0 GROUP BY s
), each AS (
  SELECT id, n, unnest(s) AS w FROM sets
), counted AS (
  SELECT id, n, w, count(*) OVER (PARTITION BY w) AS c FROM each
), prefix AS (
  SELECT id, n, w FROM counted QUALIFY row_number() OVER (PARTITION BY id ORDER BY c, w) <= n - CAST(ceil(n * 4 / 5.0) AS BIGINT) + 1
), met AS (
  SELECT DISTINCT a.id AS a, b.id AS b FROM prefix a JOIN prefix b ON a.w = b.w AND a.id < b.id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
), near AS (
  SELECT m.a, m.b FROM met m JOIN sets x ON x.id = m.a JOIN sets y ON y.id = m.b
  WHERE 5 * len(list_intersect(x.s, y.s)) >= 4 * (x.n + y.n - len(list_intersect(x.s, y.s)))
), both_ways AS (
  SELECT a, b FROM near UNION ALL SELECT b, a FROM near
), linked AS (
  SELECT s.id, s.s, least(any_value(s.place), coalesce(min(o.place), any_value(s.place))) AS least_place, count(o.id) AS links
  FROM sets s LEFT JOIN both_ways e ON e.a = s.id LEFT JOIN sets o ON o.id = e.b GROUP BY s.id, s.s
), hit AS (
  SELECT h.doc_id, h.line, k.id, k.links, k.least_place, k.least_place < {{'d': h.doc_id, 'l': h.line}} AS gone FROM held h LEFT JOIN linked k ON k.s = h.s
), links AS (
  SELECT doc_id, sum(links) AS n_links FROM (SELECT DISTINCT doc_id, id, links FROM hit WHERE id IS NOT NULL) GROUP BY doc_id
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed, least(doc_id, coalesce(min(least_place.d) FILTER (WHERE gone), doc_id)) AS class_id,
  CAST(coalesce(any_value(n_links), 0) AS BIGINT) AS n_links, coalesce(string_agg(line::VARCHAR, ',' ORDER BY line) FILTER (WHERE gone), '') AS removed,
  coalesce(string_agg(least_place.d::VARCHAR || ':' || least_place.l::VARCHAR, ',' ORDER BY line) FILTER (WHERE gone), '') AS matches
FROM hit LEFT JOIN links USING (doc_id) GROUP BY doc_id"""

#: Bytes as pairs of hexadecimal digits; a start is covered if its 100 bytes were met before, runs are starts at most 100 apart.
SUFFIX_SQL = """WITH texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, encode(coalesce(text, '')) AS raw FROM documents
), starts AS (
  SELECT doc_id, unnest(range(len(h) // 2 - 99)) AS s, raw FROM texts WHERE len(h) >= 200
), seen AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY md5(raw[s + 1 : s + 100]) ORDER BY doc_id, s) AS k FROM starts
), covered AS (
  SELECT doc_id, s, s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS gap FROM seen WHERE k > 1
), runs AS (
  SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM (SELECT *, sum(CASE WHEN gap <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS r FROM covered) GROUP BY doc_id, r
), edges AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM runs
), kept AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last, string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
  FROM edges JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head || substring(h, 2 * last + 1), h))) AS kept_sha256 FROM texts LEFT JOIN kept USING (doc_id)"""

#: A turn is written as "### role:", its text, and "</turn>", each with a line break; controls in texts take one character more.
CHAT_SQL = r"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(15 + length(replace(replace(replace(role, '\', '\\'), '#', '\h'), chr(10), '\n'))
    + length(replace(replace(replace(text, '\', '\\'), '#', '\h'), '</turn>', '\l/turn>'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""

#: CRC-32 of a decimal number's ASCII digits, bit by bit.
CRC32 = (
    "xor(list_reduce(list_concat([4294967295], list_transform(string_split({0}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), "
    "lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda y, i: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295)"
)
FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"


def leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: Nodes level by level, each with its neighbours in its run; ways climb one level a step, first to the subroot, then to the root.
MERKLE_SQL = f"""WITH RECURSIVE rows_ AS (
  SELECT doc_id, source, {leaf_sql('text')} AS leaf, CASE WHEN {CRC32.format('doc_id')} % 2 = 0 THEN {leaf_sql("replace(text, chr(10), '')")} END AS changed FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s FROM rows_
), nodes AS (
  SELECT s, 0 AS level, i, n, leaf AS h FROM placed
  UNION ALL SELECT s, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY s, level, i // 3, n
), tops AS (
  SELECT 0 AS level, s AS i, (SELECT max(s) + 1 FROM placed) AS n, h FROM nodes WHERE n = 1
  UNION ALL SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, i // 3, n
), run AS (
  SELECT s, level, i, n, string_agg(h, '' ORDER BY i) OVER (PARTITION BY s, level, i // 3 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
    string_agg(h, '' ORDER BY i) OVER (PARTITION BY s, level, i // 3 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r FROM nodes
  UNION ALL SELECT -1, level, i, n, string_agg(h, '' ORDER BY i) OVER (PARTITION BY level, i // 3 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    string_agg(h, '' ORDER BY i) OVER (PARTITION BY level, i // 3 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) FROM tops
), ways AS (
  SELECT doc_id, s AS own, s, leaf AS first, 0 AS level, i, n, coalesce(changed, leaf) AS h, '' AS proof FROM placed
  UNION ALL
  SELECT w.doc_id, w.own, CASE WHEN w.n > 1 THEN w.s ELSE -1 END, w.first, CASE WHEN w.n > 1 THEN w.level + 1 ELSE 0 END, CASE WHEN w.n > 1 THEN w.i // 3 ELSE w.own END,
    CASE WHEN w.n > 1 THEN (w.n + 2) // 3 ELSE (SELECT max(s) + 1 FROM placed) END,
    CASE WHEN w.n > 1 THEN sha256(coalesce(r.l, '') || w.h || coalesce(r.r, '')) ELSE w.h END, CASE WHEN w.n > 1 THEN w.proof || coalesce(r.l, '') || coalesce(r.r, '') ELSE w.proof END
  FROM ways w JOIN run r ON r.s = w.s AND r.level = w.level AND r.i = w.i WHERE w.n > 1 OR w.s >= 0
), root AS (
  SELECT h FROM tops WHERE n = 1
)
SELECT w.doc_id, w.first AS leaf, b.h AS subroot, root.h AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root, w.h = root.h AS verified, CAST(length(w.proof) // 64 AS BIGINT) AS n_siblings
FROM ways w JOIN nodes b ON b.s = w.own AND b.n = 1, root WHERE w.s = -1 AND w.n = 1"""


#: A prefix is known by its turns' digests one after another; subtrees are summed over each node's ancestors.
TRIE_SQL = f"""WITH turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) - 1 AS i,
    md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS t, length(coalesce(text, '')) AS size FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, c - c % 100 AS base, {CRC32.format('c')} % 6 AS h FROM (SELECT DISTINCT c FROM turns)
), built AS (
  SELECT v.c, 0 AS own, t.i, t.t, t.size FROM convs v JOIN turns t ON t.c = v.base AND t.i < v.h
  UNION ALL SELECT v.c, 1, t.i, t.t, t.size FROM convs v JOIN turns t ON t.c = v.c AND t.i >= v.h
), seq AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, i) AS d, string_agg(t, '') OVER (PARTITION BY c ORDER BY own, i ROWS UNBOUNDED PRECEDING) AS key, size FROM built
  UNION ALL SELECT c, 0, '', 0 FROM convs
), nodes AS (
  SELECT key, d, min(c) AS conv, count(*) AS n, any_value(size) AS size FROM seq GROUP BY key, d
), linked AS (
  SELECT n.*, q.key AS up, q.conv AS up_conv FROM nodes n LEFT JOIN seq p ON p.c = n.conv AND p.d = n.d - 1 LEFT JOIN nodes q ON q.key = p.key
), families AS (
  SELECT up, count(*) AS k FROM linked WHERE up IS NOT NULL GROUP BY up
), sums AS (
  SELECT s.key, count(*) FILTER (WHERE f.k IS NULL) AS leaves, sum((n.n - 1) * n.size) AS saved FROM nodes n JOIN seq s ON s.c = n.conv AND s.d <= n.d LEFT JOIN families f ON f.up = n.key GROUP BY s.key
), ends AS (
  SELECT key, string_agg(c::VARCHAR, ',' ORDER BY c) AS listed FROM (SELECT c, arg_max(key, d) AS key FROM seq GROUP BY c) GROUP BY key
)
SELECT l.conv AS conv_id, l.d AS depth, l.up_conv AS parent_conv_id, l.n AS n_convs, coalesce(f.k, 0) AS n_children, s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.listed, '')) AS ends_sha256
FROM linked l JOIN sums s ON s.key = l.key LEFT JOIN families f ON f.up = l.key LEFT JOIN ends e ON e.key = l.key"""


ORACLE_SQL = {"op1_line_dedup": LINES_SQL, "op2_suffix_dedup": SUFFIX_SQL, "op10_chat_formatting": CHAT_SQL, "op11_merkle_manifest": MERKLE_SQL, "op13_prefix_trie": TRIE_SQL}
