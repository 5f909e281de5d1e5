"""SQL for DuckDB of the queries that SQL can express."""

from __future__ import annotations

from gaugeworks.llm.chat import END, REPLY, START
from gaugeworks.llm.collocations import AT_LEAST, COVERED, SCALE, TOP
from gaugeworks.llm.merkle import FAN, FIELDS, LOWER, UPPER

#: Levels the SQL unrolls: 16 million rows of a language, 512 languages.
TREE_LEVELS, ROOT_LEVELS = 8, 3

TOP_K = """
WITH whole AS (
    SELECT row_number() OVER () AS own, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
    SELECT q.own, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON c.own <> q.own
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


# --- Merkle manifest ------------------------------------------------------------------

_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(id) + 1), lambda i: CAST(ascii(substr(id, i, 1)) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
        lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)))"""


def _leaf(text: str) -> str:
    cells = [text if name == "text" else name for name in FIELDS]
    cells = [f"coalesce(strlen(CAST({cell} AS VARCHAR)) || ':' || CAST({cell} AS VARCHAR), '-')" for cell in cells]
    return f"sha256({' || '.join(cells)})"


def _levels(name: str, levels: int) -> str:
    """From ``name0(tree, pos, n, digest)``: siblings of each node per level, and the next level's nodes."""
    run = f"(PARTITION BY tree, pos // {FAN} ORDER BY pos ROWS BETWEEN"
    parts = []
    for level in range(levels):
        parts.append(f"""{name}{level}_sides AS (
    SELECT *, coalesce(string_agg(digest, '') OVER {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lefts,
        coalesce(string_agg(digest, '') OVER {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rights
    FROM {name}{level}
), {name}{level + 1} AS (
    SELECT tree, pos // {FAN} AS pos, (any_value(n) + {FAN - 1}) // {FAN} AS n,
        CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE any_value(digest) END AS digest
    FROM {name}{level} GROUP BY tree, pos // {FAN}
)""")
    return ",\n".join(parts)


def _climb(name: str, levels: int, start: str, tree: str, pos: str) -> tuple[str, str]:
    """Folds ``now`` and gathers ``proof`` along the levels of ``name``."""
    parts, last = [], start
    for level in range(levels):
        step = f"{start}_{name}{level}"
        parts.append(f"""{step} AS (
    SELECT d.* REPLACE (
        CASE WHEN s.n > 1 THEN sha256(s.lefts || d.now || s.rights) ELSE d.now END AS now,
        CASE WHEN s.n > 1 THEN d.proof || s.lefts || s.rights ELSE d.proof END AS proof)
    FROM {last} d JOIN {name}{level}_sides s ON s.tree = d.{tree} AND s.pos = d.{pos} // {FAN**level}
)""")
        last = step
    return ",\n".join(parts), last


def merkle_sql() -> str:
    in_tree, after_tree = _climb("t", TREE_LEVELS, "d", "tree", "pos")
    in_roots, after_roots = _climb("r", ROOT_LEVELS, "e", "top", "top_pos")
    return f"""
WITH cells AS (
    SELECT *, CAST(doc_id AS VARCHAR) AS id, CASE WHEN lang IS NULL THEN '0' ELSE '1' || lang END AS tree FROM documents
), leaves AS (
    SELECT doc_id, tree, {_leaf("text")} AS leaf,
        CASE WHEN id IS NOT NULL AND {_CRC} % 3 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")}
             ELSE {_leaf("text")} END AS now
    FROM cells
), d AS (
    SELECT *, '' AS proof, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY tree) AS n
    FROM leaves
), t0 AS (SELECT tree, pos, n, leaf AS digest FROM d),
{_levels("t", TREE_LEVELS)},
{in_tree},
subroots AS (
    SELECT tree AS lang_tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM t{TREE_LEVELS}
), r0 AS (SELECT '' AS tree, pos, n, digest FROM subroots),
{_levels("r", ROOT_LEVELS)},
e AS (
    SELECT d.*, s.digest AS subroot, s.pos AS top_pos, '' AS top FROM {after_tree} d JOIN subroots s ON s.lang_tree = d.tree
),
{in_roots}
SELECT doc_id, leaf, subroot, root.digest AS root, sha256(proof) AS proof_sha256, now AS folded_root,
    now = root.digest AS verified
FROM {after_roots}, r{ROOT_LEVELS} root
"""


# --- phrases --------------------------------------------------------------------------

PHRASES = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(text, '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
), spoken AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
    SELECT lang, 1 AS size, unnest(w) AS gram FROM spoken
    UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM spoken
    UNION ALL
    SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    FROM spoken
), f AS (
    SELECT lang, size, gram, count(*) AS f FROM grams GROUP BY ALL
), sizes AS (
    SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang
), candidates AS (
    SELECT lang, size, gram, f AS a, string_split(gram, ' ') AS w FROM f WHERE size > 1 AND f >= {AT_LEAST}
), cuts AS (
    SELECT lang, size, gram, a, 1 AS k, w[1] AS left_part, array_to_string(w[2:], ' ') AS right_part FROM candidates
    UNION ALL
    SELECT lang, size, gram, a, 2, w[1] || ' ' || w[2], w[3] FROM candidates WHERE size = 3
), scored AS (
    SELECT c.*, lf.f AS l, rf.f AS r,
        CAST(CAST({SCALE} AS HUGEINT) * a * a // (CAST(lf.f AS HUGEINT) * rf.f) AS BIGINT) AS score
    FROM cuts c JOIN f lf ON lf.lang = c.lang AND lf.gram = c.left_part JOIN f rf ON rf.lang = c.lang AND rf.gram = c.right_part
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1
), covering AS (
    SELECT lang, w[1] || ' ' || w[2] AS gram, a FROM candidates WHERE size = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM candidates WHERE size = 3
), longest AS (
    SELECT lang, gram, max(a) AS longer FROM covering GROUP BY ALL
), kept AS (
    SELECT s.* FROM lowest s LEFT JOIN longest c USING (lang, gram)
    WHERE c.longer IS NULL OR 100 * c.longer < {COVERED} * s.a
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, gram) AS rank FROM kept
)
SELECT lang, rank, gram AS phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= {TOP}
"""


# --- chat -----------------------------------------------------------------------------


def chat_sql() -> str:
    marks = r"'<\\*/?s>|\[\\*/?INST\]'"
    frame = len(START) + 1 + len(END)
    role_size = f"length(role) + 2 * len(regexp_extract_all(role, {marks})) + len(regexp_extract_all(role, '[\\\\\\n]'))"
    return f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, '{REPLY}', '</s>[INST] ok [/INST]'
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
        count(*) OVER (PARTITION BY conv_id) AS n_turns,
        {frame} + {role_size} + length(text) + len(regexp_extract_all(text, {marks})) AS size
    FROM turns
), ended AS (
    SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY pos) AS ends FROM ordered
)
SELECT conv_id, any_value(n_turns) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = '{REPLY}'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = '{REPLY}'), '')) AS loss_sha256,
    CAST(sum(ends) FILTER (role = '{REPLY}' OR pos = n_turns) AS BIGINT) AS formatted_chars
FROM ended GROUP BY conv_id
"""
