"""DuckDB SQL for op13: runs as ordered lists, joined level by level."""

# A language of 8^LEVELS rows, and 8^TOP_LEVELS languages, are the most the SQL covers.
LEVELS, TOP_LEVELS = 8, 4

_ENCODED = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_ENCODED.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _step(crc: str) -> str:
    """Eight bits of CRC-32 (reflected, polynomial EDB88320)."""
    return f"list_reduce([{crc}] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"


_BYTES = "list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ord(substr(doc_id::VARCHAR, i, 1))::BIGINT)"
_CRC = f"xor(list_reduce([4294967295::BIGINT] || {_BYTES}, lambda crc, b: {_step('xor(crc, b)')}), 4294967295)"


def _up(prefix: str, levels: int) -> str:
    """{prefix}0 (tree, idx, n, h) upwards; {prefix}r{k} are the runs of level k."""
    out = []
    for k in range(levels):
        out.append(
            f"{prefix}r{k} AS (SELECT tree, idx // 8 AS parent, any_value((n + 7) // 8) AS n, list(h ORDER BY idx) AS run "
            f"FROM {prefix}{k} WHERE n > 1 GROUP BY tree, idx // 8)"
        )
        out.append(f"{prefix}{k + 1} AS (SELECT tree, parent AS idx, n, sha256(array_to_string(run, '')) AS h FROM {prefix}r{k})")
    tops = " UNION ALL ".join(f"SELECT tree, h FROM {prefix}{k} WHERE n = 1" for k in range(levels + 1))
    return ",\n".join([*out, f"{prefix}_tops AS ({tops})"])


def _fold(start: str, prefix: str, levels: int, out: str) -> str:
    """{out}{levels}: rows of {start} (tree, idx, proof, folded, ...) after all levels of their tree."""
    parts, last = [], start
    for k in range(levels):
        left, right = f"array_to_string(run[1:(pos // {8**k}) % 8], '')", f"array_to_string(run[(pos // {8**k}) % 8 + 2:], '')"
        parts.append(
            f"{out}{k + 1} AS (SELECT s.* REPLACE (CASE WHEN run IS NULL THEN proof ELSE proof || {left} || {right} END AS proof, "
            f"CASE WHEN run IS NULL THEN folded ELSE sha256({left} || folded || {right}) END AS folded) "
            f"FROM {last} s LEFT JOIN {prefix}r{k} r ON r.tree = s.in_tree AND r.parent = s.pos // {8 ** (k + 1)})"
        )
        last = f"{out}{k + 1}"
    return ",\n".join(parts)


OP13 = f"""
WITH leaves AS (
  SELECT doc_id, lang, {_leaf('text')} AS leaf,
         CASE WHEN {_CRC} % 3 = 0 THEN {_leaf(_LOWERED)} ELSE {_leaf('text')} END AS found FROM documents),
placed AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
                  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
                  count(*) OVER (PARTITION BY lang) AS n FROM leaves),
a0 AS (SELECT tree, idx, n, leaf AS h FROM placed),
{_up('a', LEVELS)},
b0 AS (SELECT 0 AS tree, tree AS idx, count(*) OVER () AS n, h FROM a_tops),
{_up('b', TOP_LEVELS)},
start AS (SELECT doc_id, leaf, tree, tree AS in_tree, idx AS pos, '' AS proof, found AS folded FROM placed),
{_fold('start', 'a', LEVELS, 'f')},
half AS (SELECT * REPLACE (0 AS in_tree, tree AS pos) FROM f{LEVELS}),
{_fold('half', 'b', TOP_LEVELS, 'g')}
SELECT doc_id, leaf, a_tops.h AS subroot, b_tops.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = b_tops.h AS verified
FROM g{TOP_LEVELS} g JOIN a_tops ON g.tree = a_tops.tree CROSS JOIN b_tops
"""
