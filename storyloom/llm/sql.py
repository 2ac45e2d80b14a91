"""DuckDB SQL for the training-data queries that SQL can express over whole tables."""

from __future__ import annotations

OP9 = r"""
WITH body AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(</article>|$)', 1) AS h FROM pages
), bare AS (
  SELECT page_id, url, regexp_replace(regexp_replace(h, '</?(b|a)( [^>]*)?>', '', 'g'), '<[^>]*>', ' ', 'g') AS t FROM body
), plain AS (
  SELECT page_id, url, trim(regexp_replace(
    replace(replace(replace(replace(t, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM bare
)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM plain
"""


OP12 = r"""
WITH letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE b.x <> a.x AND c.x NOT IN (a.x, b.x) AND d.x NOT IN (a.x, b.x, c.x) AND e.x NOT IN (a.x, b.x, c.x, d.x)
), steps AS (SELECT filter_order, i AS step, substr(filter_order, i, 1) AS f, substr(filter_order, 1, i - 1) AS earlier FROM orders, range(1, 6) r(i)),
t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT text AS k, min(doc_id) AS least FROM t GROUP BY text),
flags AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
docs AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN t.doc_id > least THEN 'E' ELSE '' END AS fails
  FROM t JOIN firsts ON text = k LEFT JOIN flags ON t.doc_id = flags.doc_id
), cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM docs GROUP BY part, fails),
marked AS (
  SELECT part, filter_order, step, f, n, good, toxic, contains(fails, f) AS failed, fails = f AS only_f,
    length(translate(fails, earlier, '')) < length(fails) AS gone
  FROM cells, steps
), counts AS (
  SELECT part, filter_order, step, f, sum(CASE WHEN NOT failed AND NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN failed AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN failed AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN only_f THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN failed AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN failed AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM marked GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counts
"""


def op8(shards: int, size: int) -> str:
    from storyloom.llm.sharding import lookup_table

    slots = ",".join(map(str, lookup_table(shards, size)))
    return f"""
WITH t AS (SELECT string_split('{slots}', ',') AS slots),
k AS (SELECT doc_id, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT) % {size} AS slot FROM documents)
SELECT doc_id, slot, CAST(slots[slot + 1] AS BIGINT) AS shard FROM k, t
"""


def oracle_sql() -> dict[str, str]:
    from storyloom.llm.queries import SHARDS, SLOTS

    return {"op8_sharding": op8(SHARDS, SLOTS), "op9_html_text": OP9, "op12_filter_audit": OP12}
