"""SQL statements of the queries that SQL can express."""

from __future__ import annotations

from tickfold.llm import templates

#: The tokens of ``templates.DEEPER``, from 1.
DEEPER = (f"tokens[{templates.LEADING + 1}]", "tokens[-1]", "tokens[len(tokens) // 2 + 1]")


def _levels() -> str:
    """Per level of a leaf the seeds of its branches, the lines that join them, and the pool of lines left for the next."""
    out = []
    for k in range(len(DEEPER) + 1):
        after = DEEPER[k] if k < len(DEEPER) else "''"
        out.append(f"""seeds{k} AS (
    SELECT leaf, place, first(mask ORDER BY docs DESC, mask) AS seed, first(tokens ORDER BY docs DESC, mask) AS seed_tokens
    FROM pool{k} GROUP BY leaf, place
), joined{k} AS MATERIALIZED (
    SELECT leaf, mask, seed FROM pool{k} JOIN seeds{k} USING (leaf, place)
    WHERE mask <> seed
        AND len(list_filter(list_zip(tokens, seed_tokens), lambda p: p[1] = p[2])) >= {templates.AGREEMENT} * len(tokens)
), pool{k + 1} AS MATERIALIZED (
    SELECT leaf, mask, tokens, docs, {after} AS place
    FROM pool{k} ANTI JOIN (SELECT leaf, mask FROM joined{k} UNION SELECT leaf, seed FROM joined{k}) USING (leaf, mask)
),""")
    return "\n".join(out)


LINE_DEDUP = f"""
WITH lines AS (
    SELECT doc_id, pos, tokens, len(tokens) AS n, array_to_string(tokens, ' ') AS mask,
        len(tokens) || ' ' || array_to_string(list_slice(tokens, 1, {templates.LEADING}), ' ') AS leaf
    FROM (
        SELECT doc_id, generate_subscripts(parts, 1) AS pos,
            unnest(list_transform(parts, lambda line: list_transform(
                list_filter(string_split_regex(line, '[\\x20\\x09-\\x0D]+'), lambda t: t <> ''),
                lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END))) AS tokens
        FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL)
    )
), worded AS (SELECT * FROM lines WHERE n > 0),
masks AS (
    SELECT leaf, mask, any_value(tokens) AS tokens, count(DISTINCT doc_id) AS docs FROM worded GROUP BY leaf, mask
), pool0 AS (SELECT *, '' AS place FROM masks),
{_levels()}
mapped AS (
    SELECT leaf, mask, coalesce(j.seed, mask) AS template
    FROM masks LEFT JOIN ({" UNION ALL ".join(f"FROM joined{k}" for k in range(len(DEEPER) + 1))}) j USING (leaf, mask)
), grouped AS (SELECT * FROM worded JOIN mapped USING (leaf, mask)),
recurring AS (
    SELECT leaf, template, min(doc_id) AS first FROM grouped GROUP BY leaf, template
    HAVING count(DISTINCT doc_id) >= CASE WHEN max(n) >= {templates.LONG_TOKENS}
        THEN {templates.LONG_DOCS} ELSE {templates.SHORT_DOCS} END
), whole AS (
    -- a document with the text of an earlier one stands for that one
    SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS holder FROM documents WHERE text IS NOT NULL
), marked AS (
    SELECT g.*, coalesce(r.first <> w.holder, false) AS gone
    FROM grouped g JOIN whole w USING (doc_id) LEFT JOIN recurring r USING (leaf, template)
), verdict AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_drop FROM marked GROUP BY doc_id
), kept AS (
    SELECT doc_id, list(pos) FILTER (gone) AS gone FROM marked SEMI JOIN (SELECT doc_id FROM verdict WHERE n_drop > 0) USING (doc_id)
    GROUP BY doc_id
)
SELECT d.doc_id,
    CASE WHEN k.gone IS NULL THEN d.text ELSE array_to_string(list_transform(
        list_filter(list_zip(string_split(d.text, chr(10)), generate_series(1, len(string_split(d.text, chr(10))))),
            lambda p: NOT list_contains(k.gone, p[2])), lambda p: p[1]), chr(10)) END AS text,
    coalesce(v.n_lines, 0) AS n_lines, CAST(coalesce(v.n_drop, 0) AS BIGINT) AS n_dropped
FROM documents d LEFT JOIN verdict v USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

#: crc32 of the decimal text ``id``: bits of each byte folded from the low end (fixed polynomial and start value).
CRC32 = """xor(list_reduce(list_transform(string_split(id, ''), lambda c: ascii(c)::UBIGINT), lambda crc, byte:
    list_reduce(list_transform(range(8), lambda k: 0::UBIGINT), lambda x, k:
        CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END, xor(crc, byte)), 4294967295::UBIGINT), 4294967295::UBIGINT)"""

FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


MERKLE = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, lang, {_leaf("text")} AS leaf,
        CASE WHEN (coalesce({CRC32}, 0) % 3) = 0 THEN {_leaf("low")} ELSE {_leaf("text")} END AS shown
    FROM (SELECT *, CAST(doc_id AS VARCHAR) AS id,
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents)
), leaves AS (
    SELECT doc_id, leaf, shown, coalesce('=' || lang, '') AS tree, row_number() OVER (
        PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n
    FROM docs
), inner_nodes AS (
    SELECT tree, 0 AS level, idx, n, leaf AS hash FROM leaves
    UNION ALL
    SELECT tree, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY idx)) FROM inner_nodes
    WHERE n > 1 GROUP BY tree, level, idx // 8, n
), tops AS (
    SELECT tree AS below, hash AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx, count(*) OVER () AS n
    FROM inner_nodes WHERE n = 1
), top_nodes AS (
    SELECT '^' AS tree, 0 AS level, idx, n, subroot AS hash FROM tops
    UNION ALL
    SELECT tree, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY idx)) FROM top_nodes
    WHERE n > 1 GROUP BY tree, level, idx // 8, n
), beside AS (
    SELECT tree, level, idx, n, hash,
        coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
        coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM (FROM inner_nodes UNION ALL FROM top_nodes)
    WINDOW run AS (PARTITION BY tree, level, idx // 8 ORDER BY idx)
), climbed AS (
    SELECT doc_id, leaf, shown AS folded, tree, tree AS own, idx AS place, 0 AS level, idx, '' AS proof FROM leaves
    UNION ALL
    SELECT c.doc_id, c.leaf, CASE WHEN b.n = 1 THEN c.folded ELSE sha256(b.before || c.folded || b.after) END,
        CASE WHEN b.n = 1 THEN '^' ELSE c.tree END, c.own, c.place, CASE WHEN b.n = 1 THEN 0 ELSE c.level + 1 END,
        CASE WHEN b.n = 1 THEN t.idx ELSE c.idx // 8 END,
        CASE WHEN b.n = 1 THEN c.proof ELSE c.proof || b.before || b.after END
    FROM climbed c JOIN beside b ON b.tree = c.tree AND b.level = c.level AND b.idx = c.idx JOIN tops t ON t.below = c.own
    WHERE b.n > 1 OR c.tree <> '^'
)
SELECT c.doc_id, c.leaf, t.subroot, r.hash AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = r.hash AS verified
FROM climbed c JOIN top_nodes r ON r.n = 1 AND c.tree = '^' AND c.level = r.level JOIN tops t ON t.below = c.own
"""

FIM = """
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS units
    FROM documents
), drawn AS (
    SELECT doc_id, text, units, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
        CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM units
), cut AS (
    SELECT doc_id, text, n,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
            WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
        array_to_string(units[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS prefix,
        array_to_string(units[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS middle,
        array_to_string(units[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS suffix
    FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM cut
"""

STATEMENTS: dict[str, str] = {"op4_line_dedup": LINE_DEDUP, "op11_merkle": MERKLE, "op12_fim": FIM}
