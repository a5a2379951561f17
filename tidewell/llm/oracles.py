"""SQL, in DuckDB's dialect, for the corpus queries that SQL can express."""

from __future__ import annotations

from tidewell.llm import quality_rules, secrets

WORD = r"[^\x20\x09-\x0D]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _spans_of(rule: secrets.Rule) -> str:
    p = _quoted(rule.pattern)
    kept = f"length(g[i]) >= {rule.least}" if rule.least else "true"
    # A match starts after the pieces up to its own and the matches before it.
    return f"""
    SELECT doc_id, k, {_quoted(rule.kind)} AS kind, s AS b, s + length(m[i]) AS e FROM (
      SELECT *, {secrets.RULES.index(rule)} AS k, (list_sum([length(x) for x in gaps[:i]]) + coalesce(list_sum([length(x) for x in m[:i - 1]]), 0))::BIGINT AS s
      FROM (SELECT doc_id, unnest(range(1, len(m) + 1)) AS i, m, g, gaps FROM (
        SELECT doc_id, regexp_extract_all(text, {p}) AS m, regexp_extract_all(text, {p}, {rule.group}) AS g, string_split_regex(text, {p}) AS gaps
        FROM documents WHERE regexp_matches(text, {p}))))
    WHERE {kept}"""


def secret_scans() -> str:
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secrets.BASE)
    listed = "string_agg(concat(kind, ':', b, ':', e), ',' ORDER BY b, k, e)"
    return f"""
    WITH spans AS ({' UNION ALL '.join(map(_spans_of, secrets.RULES))}),
    by_doc AS (SELECT doc_id, {counts}, {listed} FILTER (kind IN {secrets.BASE}) AS base, {listed} AS spans FROM spans GROUP BY doc_id)
    SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in secrets.BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents LEFT JOIN by_doc USING (doc_id)"""


def quality_verdicts() -> str:
    """Quartiles of whole bins, by sorting every row's bin."""
    w = quality_rules.WINDOW
    binned = lambda over, under, bins: f"({over} * {bins}) // {under}"
    quartile = lambda at, q: f"list_sort(list({at}) FILTER (n_words > 0))[(({q} * count(*) FILTER (n_words > 0) + 3) // 4)::BIGINT]"
    bounds = ", ".join(f"{quartile(binned(*of), q)} AS {rule}_{q}" for rule, *of, _, _ in quality_rules.RULES for q in (1, 3))
    passes = " AND ".join(
        f"({binned(*of)} <= {rule}_3 + greatest({rule}_3 - {rule}_1, {least}) * {quality_rules.REACH}"
        + (f" AND {binned(*of)} >= {rule}_1 - greatest({rule}_3 - {rule}_1, {least}) * {quality_rules.REACH}" if both else "")
        + ")"
        for rule, *of, least, both in quality_rules.RULES
    )
    return rf"""
    WITH texts AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
    tokens AS (SELECT doc_id, lang, source, text, regexp_extract_all(text, '{WORD}') AS words,
        [x for x in string_split(text, chr(10)) if regexp_matches(x, '{WORD}')] AS lines FROM texts),
    places AS (SELECT doc_id, p, array_to_string(words[p:p + {w - 1}], ' ') AS win
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - {w - 2})) AS p FROM tokens WHERE len(words) >= {w})),
    twice AS (SELECT doc_id, p FROM places QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
    covered AS (SELECT doc_id, sum(least({w}, coalesce(next - p, {w})))::BIGINT AS n
        FROM (SELECT doc_id, p, lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS next FROM twice) GROUP BY doc_id),
    counts AS (SELECT t.doc_id, lang, source, len(words)::BIGINT AS n_words, coalesce(list_sum([length(x) for x in words]), 0)::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
        FROM tokens t LEFT JOIN covered USING (doc_id)),
    bounds AS (SELECT lang AS l, source AS s, {bounds} FROM counts GROUP BY lang, source),
    judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
        FROM counts JOIN bounds ON lang IS NOT DISTINCT FROM l AND source IS NOT DISTINCT FROM s)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {passes} AS kept FROM judged"""


def warc_records(least: int) -> str:
    return f"""
    WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    rows AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
        CASE WHEN strlen(html) >= {least} THEN max(page_id) OVER (PARTITION BY html) END AS first FROM payloads)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to FROM rows"""


def similar_documents(k: int, num: int, den: int) -> str:
    """All pairs that share a shingle, and what they reach: for small tables."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
    WITH RECURSIVE tokens AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{WORD}') AS w FROM documents),
    shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {k} THEN [array_to_string(w[i:i + {k - 1}], ' ') FOR i IN range(1, len(w) - {k - 2})] WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM tokens),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id != b.doc_id GROUP BY ALL),
    links AS (SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE {den} * c >= {num} * (a.n + b.n - c)),
    reached AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x)
    SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(y) AS component_id
    FROM documents d JOIN reached ON x = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id"""
