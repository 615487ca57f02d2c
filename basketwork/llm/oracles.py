"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

QUALITY = r"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), lines AS (
  SELECT rid, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM base)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), judged AS (
  SELECT rid, line, len(array_to_string(w, '')) AS chars,
    len(regexp_extract_all(line, '[#*$%&|<>]')) * 3 > len(w) OR len(regexp_extract_all(line, '[|<>]')) * 5 > len(w)
    OR len(line) <= 80 AND regexp_matches(line, '(?i)accept (all )?cookies|enable javascript|terms (of|and) (use|service|conditions)|privacy policy|all rights reserved|sign (in|up) (to|for)|log ?in to|subscribe to (our|the)|click here|read more|skip to content|share on (facebook|twitter|linkedin)|lorem ipsum')
    OR len(w) >= 4 AND 2 * len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) > len(w) AS fails
  FROM lines
), per_doc AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines, coalesce(sum(chars) FILTER (fails), 0) AS lost
  FROM judged GROUP BY rid
), windows AS (
  SELECT rid, i, w[i : i + 4] AS win FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM base)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM windows) WHERE n > 1
), repeated AS (
  SELECT rid, sum(least(5, coalesce(next - i, 5))) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS next FROM twice) GROUP BY rid
), figures AS (
  SELECT doc_id, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM base LEFT JOIN per_doc USING (rid) LEFT JOIN repeated r USING (rid)
), failed AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM figures
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND 100 * lost <= 30 * word_chars AS kept
FROM failed
"""

SHARDING = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(octet_length(encode(text)), 0) AS n_bytes,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 15))::BIGINT AS bits
  FROM documents
), lines AS (
  SELECT *, bits >> (60 - depth) AS prefix FROM (SELECT *, unnest(range(0, 41)) AS depth FROM d)
), fits AS (
  SELECT rid, depth FROM lines JOIN (
    SELECT depth, prefix FROM lines GROUP BY ALL HAVING sum(n_bytes) <= 67108864 OR count(*) = 1
  ) USING (depth, prefix)
)
SELECT doc_id, n_bytes::BIGINT AS n_bytes, 's' || substr(lpad(bin(bits), 60, '0'), 1, min(depth)::INT) AS shard_id,
  min(depth)::INT AS shard_depth
FROM d JOIN fits USING (rid) GROUP BY rid, doc_id, n_bytes, bits
"""


def _mixing(rounds: int = 40, fills: int = 20, keep: float = 0.5) -> str:
    """Proportional fitting within the cells' tokens, with one common table expression for each step."""
    dimensions = ("source", "lang", "topic")
    steps, last = [], "start"
    for i in range(rounds):
        for d in dimensions:
            name = f"w{i}_{d}"
            steps.append(
                f"{name} AS MATERIALIZED (SELECT c.* EXCLUDE (w), least(w * (goal / sum(least(w, tokens)) OVER (PARTITION BY c._{d})), tokens * 1e6) AS w"
                f" FROM {last} c JOIN target_{d} t ON c._{d} = t.v)"
            )
            last = name
    # shares of the target, then `fills` times: values that have too little are kept whole, the rest goes to the others
    free, left = "sum(share) FILTER (WHERE NOT short) OVER ()", f"({keep} * sum(supply) OVER () - coalesce(sum(supply) FILTER (WHERE short) OVER (), 0))"
    target_steps = []
    for d in dimensions:
        target_steps.append(
            f"fill_{d}_0 AS MATERIALIZED (SELECT v, t AS supply, pow(t, 0.5) / sum(pow(t, 0.5)) OVER () AS share, FALSE AS short"
            f" FROM (SELECT _{d} AS v, sum(tokens)::DOUBLE AS t FROM cells GROUP BY 1))"
        )
        for i in range(fills):
            target_steps.append(
                f"fill_{d}_{i + 1} AS MATERIALIZED (SELECT v, supply, share, short OR coalesce(share * ({left} / {free}) > supply, FALSE) AS short FROM fill_{d}_{i})"
            )
        target_steps.append(f"target_{d} AS MATERIALIZED (SELECT v, CASE WHEN short THEN supply ELSE share * ({left} / {free}) END AS goal FROM fill_{d}_{fills})")
    targets = ", ".join(target_steps)
    return f"""
WITH rows_ AS MATERIALIZED (
  SELECT doc_id, source, lang, coalesce('=' || source, '-') AS _source, coalesce('=' || lang, '-') AS _lang,
    '=' || CASE WHEN regexp_matches(coalesce(text, ''), '[Ll]icense') THEN 'licensed'
      WHEN regexp_matches(coalesce(text, ''), '\\|.*\\|') THEN 'tables'
      WHEN regexp_matches(coalesce(text, ''), '@[a-z0-9-]+[.]') THEN 'contacts'
      WHEN regexp_matches(coalesce(text, ''), '[0-9]{{4}}') THEN 'figures' ELSE 'prose' END AS _topic,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, text, '')), 1, 15))::BIGINT / pow(2, 60) AS draw
  FROM documents
), cells AS MATERIALIZED (SELECT _source, _lang, _topic, sum(tokens) AS tokens FROM rows_ GROUP BY ALL HAVING sum(tokens) > 0),
{targets}, start AS (SELECT *, tokens::DOUBLE AS w FROM cells), {", ".join(steps)},
rates AS (SELECT _source, _lang, _topic, round(least(w, tokens) / tokens, 6) AS rate FROM {last})
SELECT doc_id, source, lang, substr(_topic, 2) AS topic, tokens::BIGINT AS n_tokens,
  CASE WHEN tokens > 0 THEN rate ELSE 0 END AS probability, draw < CASE WHEN tokens > 0 THEN rate ELSE 0 END AS selected
FROM rows_ LEFT JOIN rates USING (_source, _lang, _topic)
"""


ARCHIVE = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
records AS (
  SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest,
    CASE WHEN strlen(payload) >= 100 THEN min(page_id) OVER (PARTITION BY payload) END AS first
  FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  nullif(first, page_id)::BIGINT AS refers_to
FROM records
"""

ORACLES = {"op5_sharding": SHARDING, "op6_mixing": _mixing(), "op9_quality_rules": QUALITY, "op12_web_archive": ARCHIVE}
