"""DuckDB SQL for the queries that SQL can express."""

# The white space and letters of the contracts, as SQL.
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"

OP1 = f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, trim({_LOWER.format("line")}, {_WHITE}) AS k FROM lines
), shared AS (
  SELECT k FROM keyed WHERE length(k) > 0 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT keyed.*, shared.k IS NOT NULL AS gone FROM keyed LEFT JOIN shared ON keyed.k = shared.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP2 = rf"""
WITH parts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^.!?\n]*[.!?\n][.!?\x20\x09-\x0D]*|[^.!?\n]+') AS p FROM documents
), s AS (
  SELECT doc_id, generate_subscripts(p, 1) AS pos, unnest(p) AS part FROM parts
), keyed AS (
  SELECT doc_id, pos, part, {_WORDS.format(_LOWER.format("part"))} AS w FROM s
), counted AS (
  SELECT *, sum(len(w)) OVER (PARTITION BY doc_id ORDER BY pos) AS upto, array_to_string(w, ' ') AS k FROM keyed
), ends AS (
  SELECT a.doc_id, a.pos AS i, min(b.pos) AS j
  FROM counted a JOIN counted b ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos + 1 AND a.pos + 200
   AND b.upto - a.upto + len(a.w) >= 20
  GROUP BY ALL
), run AS (
  SELECT e.doc_id, e.i, e.j, string_agg(c.k, chr(10) ORDER BY c.pos) AS r
  FROM ends e JOIN counted c ON c.doc_id = e.doc_id AND c.pos BETWEEN e.i AND e.j GROUP BY ALL
), later AS (
  SELECT doc_id, i, j FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY doc_id, i) AS turn FROM run) WHERE turn > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, j + 1)) AS pos FROM later
), marked AS (
  SELECT s.*, gone.pos IS NOT NULL AS out FROM s LEFT JOIN gone USING (doc_id, pos)
), edges AS (
  SELECT *, out AND NOT coalesce(lag(out) OVER (PARTITION BY doc_id ORDER BY pos), false) AS begins FROM marked
)
SELECT d.doc_id, count(pos) AS n_sentences, count(pos) FILTER (WHERE out) AS n_removed,
       count(pos) FILTER (WHERE begins) AS n_spans,
       sha256(coalesce(string_agg(part, '' ORDER BY pos) FILTER (WHERE NOT out), '')) AS kept_sha256
FROM documents d LEFT JOIN edges USING (doc_id) GROUP BY d.doc_id
"""

OP8 = rf"""
WITH sized AS (
  SELECT doc_id, source, len({_WORDS.format("text")}) AS size, md5(coalesce(CAST(doc_id AS varchar), '')) AS turn FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size)::DOUBLE AS cap,
         [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER before, 0)) /
            (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM sources
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size,
         coalesce(least(cap, weight * max(level) FILTER (WHERE level * weight <= cap) OVER ()), cap) AS target
  FROM levels
), placed AS (
  SELECT sized.*, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS wanted,
         coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY turn, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized JOIN targets t ON sized.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE size * (wanted // source_size) + greatest(least(start + size, wanted % source_size) - start, 0)
       END::BIGINT AS taken
FROM placed
"""

# CRC-32 of a text of ASCII letters, bit by bit; the constant is its polynomial.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::UBIGINT, [ascii(ch)::UBIGINT FOR ch IN string_split({}, '')]),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0::UBIGINT FOR i IN range(8)]),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)), 4294967295::UBIGINT)"""

_SPOT = _CRC32.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")

# Tops of the stack: 0 nothing yet, 1 a system turn, 2 a user's turn, 3 a whole pair.
OP13 = f"""
WITH RECURSIVE spotted AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_SPOT} % 20 AS spot FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN spot = 4 THEN 'user' ELSE role END AS role,
         CASE spot WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM spotted, (VALUES (1), (2)) AS c(copy) WHERE spot <> 0 AND (copy = 1 OR spot = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         rtrim(text, {_WHITE}) AS bare
  FROM damaged
), seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth,
         lag(role) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM placed
), judged AS (
  SELECT conv_id, turn, role, text, pos, left(role, 1) AS initial, left(before, 1) || left(role, 1) AS pair,
         CASE WHEN bare = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
              WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM seen
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS last_pos
  FROM judged GROUP BY conv_id
), inserts(top, onto, cost, edits, turns) AS (
  VALUES (0, 0, 0, '', []::VARCHAR[]), (0, 2, 2, 'I', ['user:']), (0, 3, 4, 'II', ['user:', 'assistant:']),
         (1, 1, 0, '', []), (1, 2, 2, 'I', ['user:']), (1, 3, 4, 'II', ['user:', 'assistant:']),
         (2, 2, 0, '', []), (2, 3, 2, 'I', ['assistant:']), (3, 3, 0, '', []), (3, 2, 2, 'I', ['user:'])
), shifts(top, initial, onto) AS (
  VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), edits AS (
  SELECT conv_id, pos, t.top, s.onto, CASE WHEN s.initial = j.initial THEN 0 ELSE 2 END + (fault = 'truncated')::INT AS cost,
         CASE WHEN s.initial = j.initial THEN 'K' ELSE 'R' END AS edit,
         [CASE WHEN s.initial = j.initial THEN role WHEN s.initial = 'u' THEN 'user' ELSE 'assistant' END || ':' || text] AS kept
  FROM judged j, (VALUES (0), (1), (2), (3)) AS t(top) JOIN shifts s ON s.top = t.top
  WHERE fault NOT IN ('blank', 'duplicate') AND (s.initial = j.initial OR s.initial <> 's')
  UNION ALL
  SELECT conv_id, pos, top, top, 3, 'D', [] FROM judged, (VALUES (0), (1), (2), (3)) AS t(top)
), paths AS (
  SELECT conv_id, 0::BIGINT AS pos, 0 AS top, {{'cost': 0::BIGINT, 'audit': '', 'kept': []::VARCHAR[]}} AS best FROM counted
  UNION ALL
  SELECT p.conv_id, p.pos + 1 AS pos, e.onto AS top,
         min({{'cost': p.best.cost + i.cost + e.cost, 'audit': p.best.audit || i.edits || e.edit,
               'kept': list_concat(list_concat(p.best.kept, i.turns), e.kept)}})
  FROM paths p JOIN inserts i ON i.top = p.top
  JOIN edits e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.pos = p.pos + 1 AND e.top = i.onto
  GROUP BY p.conv_id, p.pos + 1, e.onto
), repaired AS (
  SELECT p.conv_id, min({{'cost': p.best.cost + i.cost, 'audit': p.best.audit || i.edits, 'kept': list_concat(p.best.kept, i.turns)}}) AS best
  FROM paths p JOIN counted c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.last_pos = p.pos
  JOIN inserts i ON i.top = p.top AND i.onto IN (0, 3) GROUP BY p.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(r.best.cost, 0)::BIGINT AS cost,
       coalesce(r.best.audit, '') AS audit, sha256(coalesce(array_to_string(r.best.kept, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""

def _hashed(*columns: str) -> str:
    """The leaf of a row, as SQL."""
    return "sha256(" + " || ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in columns) + ")"


# Level k of a tree holds the hashes of each two neighbours of level k - 1; the languages' roots are the leaves of the last tree.
OP12 = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, coalesce('+' || lang, '') AS tree, {_hashed("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {_CRC32.format("coalesce(doc_id, 0)::VARCHAR")} % 7 = 0
              THEN {_hashed("doc_id", "source", "lang", "(n_chars + 1)", "text")} END AS tampered
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS total
  FROM rows
), nodes AS (
  SELECT tree, 0 AS level, place, total, leaf AS digest FROM leaves
  UNION ALL
  SELECT tree, level + 1 AS level, place // 2 AS place, (total + 1) // 2 AS total, sha256(string_agg(digest, '' ORDER BY place))
  FROM nodes WHERE total > 1 GROUP BY tree, level + 1, place // 2, (total + 1) // 2
), subroots AS (
  SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS total FROM nodes WHERE total = 1
), upper_nodes AS (
  SELECT 0 AS level, place, total, digest FROM subroots
  UNION ALL
  SELECT level + 1 AS level, place // 2 AS place, (total + 1) // 2 AS total, sha256(string_agg(digest, '' ORDER BY place))
  FROM upper_nodes WHERE total > 1 GROUP BY level + 1, place // 2, (total + 1) // 2
), climb AS (
  SELECT doc_id, tree, leaf, place, total, 0 AS level, coalesce(tampered, leaf) AS folded, '' AS proof FROM leaves
  UNION ALL
  SELECT c.doc_id, c.tree, c.leaf, c.place // 2 AS place, (c.total + 1) // 2 AS total, c.level + 1 AS level,
         sha256(CASE WHEN c.place % 2 = 1 THEN s.digest || c.folded ELSE c.folded || coalesce(s.digest, '') END) AS folded,
         c.proof || coalesce(s.digest, '') AS proof
  FROM climb c LEFT JOIN nodes s
    ON s.tree = c.tree AND s.level = c.level AND s.place = c.place + 1 - 2 * (c.place % 2)
  WHERE c.total > 1
), climbed AS (
  SELECT c.doc_id, c.leaf, s.digest AS subroot, s.place, s.total, c.folded, c.proof
  FROM climb c JOIN subroots s ON s.tree = c.tree WHERE c.total = 1
), onward AS (
  SELECT doc_id, leaf, subroot, place, total, 0 AS level, folded, proof FROM climbed
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, c.place // 2 AS place, (c.total + 1) // 2 AS total, c.level + 1 AS level,
         sha256(CASE WHEN c.place % 2 = 1 THEN s.digest || c.folded ELSE c.folded || coalesce(s.digest, '') END) AS folded,
         c.proof || coalesce(s.digest, '') AS proof
  FROM onward c LEFT JOIN upper_nodes s ON s.level = c.level AND s.place = c.place + 1 - 2 * (c.place % 2)
  WHERE c.total > 1
), root AS (
  SELECT digest AS root FROM upper_nodes WHERE total = 1
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM onward, root WHERE total = 1
"""

ORACLE = {"op1_line_dedup": OP1, "op2_substring_dedup": OP2, "op8_mixing": OP8, "op12_merkle_manifest": OP12, "op13_conversation_repair": OP13}
