"""The SQL of the queries that SQL can state, by plain means: all pairs, all levels, all matches."""

from weftwork.llm.ledger import RULES

HARD_NEGATIVES = """
WITH rows AS (
  SELECT vec_id::BIGINT AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.id AS anchor, a.label = c.label AS same, c.id AS id, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM rows a JOIN rows c ON a.id <> c.id WHERE a.id % 100 = 0),
positives AS (
  SELECT * FROM (SELECT anchor, id, score, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS place FROM pairs WHERE same)
  WHERE place <= 5),
found AS (
  SELECT p.anchor, p.id AS positive, p.score AS positive_score, n.id, n.score,
         row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id) AS rank
  FROM positives p JOIN pairs n ON p.anchor = n.anchor
  WHERE NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor AS anchor_id, positive AS positive_id, rank::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM found WHERE rank <= 10
"""

_CRC32 = """xor(4294967295::UBIGINT, list_reduce(
  list_prepend(4294967295::UBIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::UBIGINT)),
  lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[],
    lambda x, step: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))))"""


def _levels(name: str, count: int) -> str:
    """From the nodes ``{name}_0 (k, i, n, h)`` the runs and nodes of all levels; groups of one node stay as they are."""
    parts = []
    for j in range(count):
        parts.append(f"{name}_runs_{j} AS (SELECT k, i // 8 AS u, (any_value(n) + 7) // 8 AS m, list(h ORDER BY i) AS run FROM {name}_{j} WHERE n > 1 GROUP BY k, i // 8)")
        parts.append(
            f"{name}_{j + 1} AS (SELECT k, u AS i, m AS n, sha256(array_to_string(run, '')) AS h FROM {name}_runs_{j} "
            f"UNION ALL SELECT k, i, n, h FROM {name}_{j} WHERE n = 1)"
        )
    return ",\n".join(parts)


def _climb(source: str, name: str, tree: str, count: int) -> str:
    """Rows ``(k, i, proof, f)`` taken up a tree: the siblings behind the proof, the folded hash in ``f``."""
    parts = [f"{name}_0 AS (SELECT * FROM {source})"]
    for j in range(count):
        left, right = "array_to_string(r.run[:p.i % 8], '')", "array_to_string(r.run[p.i % 8 + 2:], '')"
        parts.append(
            f"{name}_{j + 1} AS (SELECT p.* REPLACE (p.i // 8 AS i, CASE WHEN r.run IS NULL THEN proof ELSE proof || {left} || {right} END AS proof, "
            f"CASE WHEN r.run IS NULL THEN f ELSE sha256({left} || f || {right}) END AS f) "
            f"FROM {name}_{j} p LEFT JOIN {tree}_runs_{j} r ON p.k = r.k AND p.i // 8 = r.u)"
        )
    return ",\n".join(parts)


def merkle_manifest(levels: int = 8, top_levels: int = 3) -> str:
    """Trees of up to ``8 ** levels`` leaves in up to ``8 ** top_levels`` groups."""
    measured = lambda c, size: f"coalesce({size} || ':' || {c}, '-')"
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR"]
    head = " || ".join(measured(c, f"strlen({c})") for c in fields)
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH rows AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS lang_key, {head} AS head, text,
         CASE WHEN {_CRC32.format("doc_id::VARCHAR")} % 3 = 0 THEN {lower} ELSE text END AS changed
  FROM documents),
hashed AS (
  SELECT doc_id, lang_key AS k, sha256(head || {measured("text", "strlen(text)")}) AS leaf, sha256(head || {measured("changed", "strlen(changed)")}) AS f
  FROM rows),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf, f) - 1 AS i, count(*) OVER (PARTITION BY k) AS n FROM hashed),
tree_0 AS (SELECT k, i, n, leaf AS h FROM placed),
{_levels("tree", levels)},
subroots AS (SELECT k AS name, h, row_number() OVER (ORDER BY encode(k)) - 1 AS i, count(*) OVER () AS n FROM tree_{levels}),
top_0 AS (SELECT '' AS k, i, n, h FROM subroots),
{_levels("top", top_levels)},
leaves AS (SELECT doc_id, leaf, k, i, '' AS proof, f FROM placed),
{_climb("leaves", "low", "tree", levels)},
at_subroot AS (SELECT doc_id, leaf, s.h AS subroot, '' AS k, s.i, proof, f FROM low_{levels} JOIN subroots s ON low_{levels}.k = s.name),
{_climb("at_subroot", "high", "top", top_levels)}
SELECT p.doc_id, p.leaf, p.subroot, t.h AS root, sha256(p.proof) AS proof_sha256, p.f AS folded_root, p.f = t.h AS verified
FROM high_{top_levels} p JOIN top_{top_levels} t ON p.k = t.k
"""


def _either_case(pattern: str) -> str:
    """A pattern in which letters stand in either case, for engines that would take other letters for them too."""
    words = "(password|passwd|secret|token|api_?key)"
    spelled = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)
    return pattern.replace("(?i)", "").replace(words, spelled)


def secret_scan() -> str:
    kinds = []
    for k, rule in enumerate(RULES):
        pattern = "'" + _either_case(rule.pattern).replace("'", "''") + "'"
        kinds.append(f"""
  SELECT row, {k} AS rule, '{rule.kind}' AS kind, regexp_split_to_array(text, {pattern}) AS gaps,
         regexp_extract_all(text, {pattern}, 0) AS hits, regexp_extract_all(text, {pattern}, {rule.group}) AS parts, {rule.least} AS least
  FROM texts""")
    return f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
scanned AS ({" UNION ALL ".join(kinds)}),
numbered AS (SELECT *, unnest(range(1, len(hits) + 1)) AS j FROM scanned WHERE len(hits) > 0),
spans AS (
  SELECT row, rule, kind, list_sum(list_transform(gaps[:j], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[:j - 1], lambda h: length(h))), 0) AS start,
         length(hits[j]) AS size
  FROM numbered WHERE length(parts[j]) >= least),
found AS (
  SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start::BIGINT || ':' || (start + size)::BIGINT, ',' ORDER BY start, rule) AS spans
  FROM spans GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN found USING (row)
"""
