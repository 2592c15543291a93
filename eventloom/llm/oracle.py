"""DuckDB SQL for queries whose results SQL can express."""

from __future__ import annotations

import itertools

from eventloom.llm.license_scan import RUN, SHARE, templates
from eventloom.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _template_values() -> str:
    rows = [
        f"({i}, '{label}', {str(base).lower()}, {words!r})" for i, label, base, words in templates()
    ]
    return ",\n    ".join(rows)


LICENSE_SCAN = rf"""
WITH template(template, label, base, words) AS (VALUES
    {_template_values()}
),
doc AS (
  SELECT row_number() OVER () AS rid, doc_id,
         [x for x in string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> ''] AS words
  FROM documents
),
spot AS (SELECT rid, words, unnest(range(len(words))) AS pos FROM doc),
place AS (
  SELECT *, least({RUN}, len(words)) AS k, len(words) AS size
  FROM (SELECT *, unnest(range(len(words))) AS place FROM template)
),
hit AS (
  SELECT s.rid, p.template, p.label, p.base, p.size, p.k, s.pos, p.place
  FROM spot s JOIN place p ON s.words[s.pos + 1] = p.words[p.place + 1] AND s.words[s.pos + 2] = p.words[p.place + 2]
  WHERE p.place + p.k <= p.size AND (p.k = 2 OR s.words[s.pos + 3] = p.words[p.place + 3])
),
vote AS (
  SELECT rid, template, label, base, size, k, pos - place AS diagonal, min(pos) AS low, max(pos + k) AS high
  FROM hit GROUP BY ALL
),
stepped AS (
  SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal) AS apart FROM vote
),
numbered AS (
  SELECT *, sum(CASE WHEN base OR apart IS NULL OR apart > size // 4 THEN 1 ELSE 0 END)
              OVER (PARTITION BY rid, template ORDER BY diagonal) AS cluster
  FROM stepped
),
held AS (
  SELECT rid, template, cluster, count(DISTINCT word) AS held
  FROM (SELECT h.rid, h.template, n.cluster, unnest(range(h.place, h.place + h.k)) AS word
        FROM hit h JOIN numbered n ON n.rid = h.rid AND n.template = h.template AND n.diagonal = h.pos - h.place)
  GROUP BY ALL
),
span AS (
  SELECT rid, template, label, base, size, cluster, min(low) AS low, max(high) AS high
  FROM numbered GROUP BY ALL
),
judged AS (
  SELECT *, CASE WHEN base THEN held = size
                 ELSE held / size >= {SHARE} AND high - low <= size + size // 2 END AS found
  FROM span JOIN held USING (rid, template, cluster)
)
SELECT doc_id, any_value(len(words))::BIGINT AS n_words,
       count(*) FILTER (WHERE base AND found)::BIGINT AS n_base,
       min(low) FILTER (WHERE base AND found)::BIGINT AS first_word,
       max(low) FILTER (WHERE base AND found)::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE base AND found)), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE found)), ','), '') AS labels,
       coalesce(max(held / greatest(size, high - low)), 0.0)::DOUBLE AS score
FROM doc LEFT JOIN judged USING (rid)
GROUP BY rid, doc_id
"""


def _vector_codes(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The rounds written out one after another."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label,
         [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
cell AS MATERIALIZED (
  SELECT rid, (i // (n // {parts}))::INT AS part, i % (n // {parts}) AS c, q[i + 1] AS v
  FROM (SELECT rid, q, len(q) AS n, unnest(range(len(q))) AS i FROM kept)
),
book0 AS MATERIALIZED (
  SELECT part, e, c, v
  FROM cell JOIN (SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {entries}) USING (rid)
)"""]
    for k in range(rounds + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (
  SELECT rid, part, min(d * 256 + e) % 256 AS e, min(d * 256 + e) // 256 AS d
  FROM (SELECT rid, part, e, sum((cell.v - book{k}.v) * (cell.v - book{k}.v)) AS d
        FROM cell JOIN book{k} USING (part, c) GROUP BY ALL)
  GROUP BY rid, part
)""")
        if k < rounds:
            steps.append(f"""
book{k + 1} AS MATERIALIZED (
  SELECT part, e, c, CASE WHEN n IS NULL THEN v ELSE (s - (s % n + n) % n) // n END AS v
  FROM book{k} LEFT JOIN (
    SELECT part, e, c, sum(v) AS s, count(*) AS n FROM cell JOIN near{k} USING (rid, part) GROUP BY ALL
  ) USING (part, e, c)
)""")
    return f"""
WITH {",".join(steps)},
coded AS (
  SELECT rid, string_agg(printf('%02x', e::INT), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM near{rounds} GROUP BY rid
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, e, c)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (rid)
"""


VECTOR_CODES = _vector_codes()


def _filter_audit() -> str:
    orders = ", ".join(f"('{''.join(order)}')" for order in itertools.permutations("ABCDE"))
    return rf"""
WITH doc AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         [x for x in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] AS words
  FROM documents
),
good AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS mask
  FROM doc LEFT JOIN good USING (doc_id)
),
grouped AS (SELECT part, mask, good, toxic, count(*) AS n FROM failed GROUP BY ALL),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before
  FROM (VALUES {orders}) o(filter_order), (VALUES (1), (2), (3), (4), (5)) s(step)
),
judged AS (
  SELECT part, filter_order, step, f, n, good, toxic, mask, contains(mask, f) AS fails,
         translate(mask, before, '') <> mask AS gone
  FROM grouped, steps
),
sums AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN fails AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN mask = f THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN fails AND NOT gone THEN n * good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN fails AND NOT gone THEN n * toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM sums
"""


FILTER_AUDIT = _filter_audit()
