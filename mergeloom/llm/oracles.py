"""DuckDB forms of the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from . import chat_format, secret_scan

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def ascii_lower(column: str) -> str:
    return f"translate({column}, '{UPPER}', '{LOWER}')"


def embeddings(cosine: float) -> str:
    """Links by all pairs of a label, components by reachability."""
    return f"""WITH RECURSIVE ok AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
unit AS (SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS u FROM ok),
links AS MATERIALIZED (SELECT a.vec_id AS x, b.vec_id AS y FROM unit a JOIN unit b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.u) = len(b.u)
  WHERE list_inner_product(a.u, b.u) >= {cosine}),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON least.x = e.vec_id LEFT JOIN counts ON counts.x = e.vec_id"""


def urls(block: list[str], allow: list[str]) -> str:
    """Every rule tried on every page."""
    rows = ", ".join(f"({quoted(r)}, {quoted(r[:r.index('/')])}, {quoted(r[r.index('/'):])}, {'true' if r in block else 'false'})"
                     for r in sorted({*block, *allow}))
    return f"""WITH rules AS (SELECT * FROM (VALUES {rows}) t(rule, rh, rp, blocks)),
rest AS (SELECT page_id, url, coalesce(contains(url, '://'), false) AS has, substr(url, instr(url, '://') + 3) AS rest FROM pages),
parts AS (SELECT page_id, CASE WHEN has THEN {ascii_lower("regexp_extract(rest, '^[^/?#]*')")} ELSE '' END AS host,
  CASE WHEN has THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM rest),
best AS (SELECT page_id, arg_max(rule, (length(rule), blocks, length(rh))) AS rule, arg_max(blocks, (length(rule), blocks, length(rh))) AS blocks
  FROM parts JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT page_id, host, path, rule, CASE WHEN blocks THEN 'block' ELSE 'allow' END AS verdict FROM parts LEFT JOIN best USING (page_id)"""


def chat() -> str:
    """Turns strung together; the formatted length from the template's marks and the escapes."""
    marks = quoted("|".join(["\\\\", *(m.replace("[", "\\[").replace("]", "\\]") for m in chat_format.CONTROL)]))
    size = lambda c: f"length({c}) + len(regexp_extract_all({c}, {marks}))"
    said = quoted("</s>[INST] ok [/INST]")
    return f"""WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', {said}), (-7, 1, 'assistant', {said})) t(conv_id, turn, role, text)),
joined AS (SELECT conv_id, count(*) AS n, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
  coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
  sum({size("text")} + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 15 WHEN 'assistant' THEN 4 ELSE 24 + {size("role")} END) AS chars
  FROM rows GROUP BY conv_id)
SELECT conv_id, CAST(n AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM joined"""


def _found(pattern: str, kind: int, passes: str) -> str:
    """Spans of one kind: starts from the pieces between matches."""
    p = quoted(pattern)
    return (f"SELECT doc_id, {kind} AS kind, s, s + length(m[i]) AS e FROM (SELECT doc_id, m, i, "
            f"CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s "
            f"FROM (SELECT doc_id, regexp_extract_all(t, {p}) AS m, string_split_regex(t, {p}) AS p FROM texts) x, "
            f"unnest(generate_series(1, len(m))) AS g(i)) WHERE {passes}")


def secrets(reach: int) -> str:
    """All spans of all documents, weak ones confirmed by a join on distance."""
    S = secret_scan
    near = lambda a, b, gap: f"{a}.doc_id = {b}.doc_id AND {a}.s <= {b}.e + {gap} AND {a}.e >= {b}.s - {gap}"
    names = " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(S.KINDS))
    spelled = f"string_agg(CASE kind {names} END || ':' || s || ':' || e, ',' ORDER BY s, kind, e)"
    mixed = " AND ".join(f"regexp_matches(m[i], '{c}')" for c in ("[A-Z]", "[a-z]", "[0-9]"))
    return f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS MATERIALIZED ({_found(S.ASSIGN, 0, f"length(regexp_extract(m[i], {quoted(S.ASSIGN)}, 1)) >= {S.MIN_ASSIGN}")}
  UNION ALL {_found(S.ACCESS, 1, f"length(m[i]) >= {S.MIN_ACCESS}")} UNION ALL {_found(S.HEX, 2, f"length(m[i]) >= {S.MIN_HEX}")}),
weak AS MATERIALIZED ({_found(S.WEAK_SECRET, 3, mixed + " AND NOT starts_with(m[i], 'AKIA')")}),
ends AS MATERIALIZED ({_found(S.ENDPOINT, 4, "true")}),
secret AS (SELECT * FROM weak w WHERE EXISTS (SELECT 1 FROM base a WHERE a.kind = 1 AND {near("w", "a", reach)})
  AND NOT EXISTS (SELECT 1 FROM base b WHERE b.kind < 2 AND {near("w", "b", -1)})),
sure AS (SELECT * FROM base WHERE kind = 0 UNION ALL SELECT * FROM secret),
point AS (SELECT * FROM ends x WHERE EXISTS (SELECT 1 FROM base a WHERE a.kind = 1 AND {near("x", "a", reach)})
  AND EXISTS (SELECT 1 FROM sure y WHERE {near("x", "y", reach)})),
based AS (SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n0, count(*) FILTER (WHERE kind = 1) AS n1, count(*) FILTER (WHERE kind = 2) AS n2,
  {spelled} AS said FROM base GROUP BY doc_id),
every AS (SELECT doc_id, {spelled} AS spans FROM (SELECT * FROM base UNION ALL SELECT * FROM secret UNION ALL SELECT * FROM point) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_assign, CAST(coalesce(n1, 0) AS BIGINT) AS n_access, CAST(coalesce(n2, 0) AS BIGINT) AS n_hex,
  sha256(coalesce(said, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents d LEFT JOIN based USING (doc_id) LEFT JOIN every USING (doc_id)"""


def decontamination(n: int) -> str:
    """Windows of words of both sides joined as strings."""
    words = f"regexp_extract_all({ascii_lower('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""WITH iw AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark),
windows AS MATERIALIZED (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS said
  FROM (SELECT item, w, least(len(w), {n}) AS k FROM iw WHERE len(w) > 0) t, unnest(generate_series(1, len(w) - k + 1)) AS g(i)),
dw AS MATERIALIZED (SELECT doc_id, coalesce({words}, []) AS w FROM documents),
places AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS said FROM dw, (SELECT DISTINCT k FROM windows) ks,
  unnest(generate_series(1, len(w) - k + 1)) AS g(i)),
hits AS MATERIALIZED (SELECT doc_id, p.k, i, item FROM places p JOIN windows USING (k, said)),
hit_words AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS pos FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS said FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items.said, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit_words h USING (doc_id) LEFT JOIN items USING (doc_id)"""


def filters(letters: str) -> str:
    """Every order applied to the parts' masks, each filter's removals counted where the masks before it pass."""
    blanks = quoted("[\\x20\\x09-\\x0D]+")
    orders = " UNION ALL ".join(f"SELECT '{c}' AS f, {1 << i} AS bit" for i, c in enumerate(letters))
    names = [f"l{i}" for i in range(len(letters))]
    apart = " AND ".join(f"{a}.f <> {b}.f" for i, a in enumerate(names) for b in names[:i])
    return f"""WITH docs AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, list_filter(string_split_regex(t, {blanks}), lambda x: x <> '') AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM docs),
known AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
masks AS MATERIALIZED (SELECT part, CASE WHEN len(w) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask,
  count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM words LEFT JOIN known USING (doc_id) GROUP BY part, mask),
letters AS ({orders}),
orders AS (SELECT {" || ".join(f"{n}.f" for n in names)} AS filter_order, [{", ".join(f"{n}.bit" for n in names)}] AS bits
  FROM {", ".join(f"letters {n}" for n in names)} WHERE {apart}),
steps AS (SELECT filter_order, i AS step, bits[i] AS bit, CAST(coalesce(list_sum(bits[1:i - 1]), 0) AS INTEGER) AS earlier
  FROM orders, unnest(generate_series(1, {len(letters)})) AS g(i)),
counted AS (SELECT part, filter_order, step, bit, sum(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN mask & earlier <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
  sum(CASE WHEN mask & earlier = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM masks, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM counted"""


def codes(parts: int, entries: int, rounds: int, scale: int) -> str:
    """Lloyd's rounds written out: each compares every part with every entry."""
    def nearest(book: str) -> str:
        return f"""SELECT vec_id, p.part, arg_min(entry, (d, entry)) AS entry, min(d) AS d, any_value(x) AS x FROM (SELECT vec_id, p.part, entry, p.x,
  CAST(list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, e.x) + list_inner_product(e.x, e.x) AS BIGINT) AS d
  FROM pieces p JOIN {book} e ON p.part = e.part) p GROUP BY vec_id, p.part"""

    steps, book = [], "book0"
    for r in range(1, rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED ({nearest(book)}),
means{r} AS (SELECT part, entry, list(m ORDER BY i) AS x FROM (SELECT part, entry, i, CAST((s - ((s % n) + n) % n) // n AS DOUBLE) AS m FROM
  (SELECT part, entry, i, CAST(sum(CAST(x[i] AS BIGINT)) AS BIGINT) AS s, count(*) AS n FROM near{r}, unnest(generate_series(1, len(x))) AS g(i) GROUP BY part, entry, i)) GROUP BY part, entry),
book{r} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM {book} b LEFT JOIN means{r} m ON b.part = m.part AND b.entry = m.entry)""")
        book = f"book{r}"
    return f"""WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS MATERIALIZED (SELECT vec_id, part, v[part * len(v) // {parts} + 1:(part + 1) * len(v) // {parts}] AS x FROM kept, unnest(generate_series(0, {parts - 1})) AS g(part)),
book0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM pieces
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries})),
{", ".join(steps)},
last AS MATERIALIZED ({nearest(book)}),
coded AS (SELECT vec_id, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM last GROUP BY vec_id),
said AS (SELECT sha256(string_agg(array_to_string(list_transform(x, lambda v: CAST(CAST(v AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM {book})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), said"""
