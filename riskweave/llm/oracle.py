"""DuckDB SQL for the corpus queries that SQL can express; tests hold the others against brute force."""

_TURN = """'<|im_start|>' || regexp_replace(coalesce(role, 'unknown'), '<\\|(im_start|im_end)\\|>', '< |\\1|>', 'g') || chr(10)
    || regexp_replace(coalesce(text, ''), '<\\|(im_start|im_end)\\|>', '< |\\1|>', 'g') || '<|im_end|>' || chr(10)"""

STATEMENTS: dict[str, str] = {
    "op9_maximal_conversations": f"""
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
logs AS (
  SELECT conv_id, count(*) AS n, list(struct_pack(r := role, t := text) ORDER BY turn NULLS FIRST, role, text) AS l,
    string_agg({_TURN}, '' ORDER BY turn NULLS FIRST, role, text) AS rendered
  FROM turns GROUP BY conv_id
),
different AS (
  SELECT l, n, min(conv_id) AS conv_id, count(*) AS n_copies, min_by(rendered, conv_id) AS rendered FROM logs GROUP BY l, n
),
shorter AS (SELECT DISTINCT l[1:k] AS l FROM (SELECT l, unnest(range(1, n)) AS k FROM different))
SELECT conv_id, n AS n_turns, n_copies, rendered FROM different d
WHERE NOT EXISTS (SELECT 1 FROM shorter s WHERE s.l = d.l)""",
    "op13_line_runs": """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS place FROM split),
keyed AS (
  SELECT doc_id, place, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
),
repeated AS (
  SELECT k, max(doc_id) AS holder FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
),
marked AS (
  SELECT keyed.*, repeated.k IS NOT NULL AND keyed.doc_id <> holder AS gone FROM keyed LEFT JOIN repeated USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
}
