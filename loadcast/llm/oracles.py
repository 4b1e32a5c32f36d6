"""SQL for the registered queries that SQL can express, as plain as it can be."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"[^\x20\x09-\x0D]+"
_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(table: str, key: str, text: str, pattern: str) -> str:
    # Each row for itself: an id may be repeated or missing.
    return f"SELECT row_number() OVER () AS r, {key}, coalesce(regexp_extract_all({text}, '{pattern}'), []) AS w FROM {table}"


CONTAMINATION = f"""
WITH docs AS ({_words("documents", "doc_id", _LOWER, _PLAIN)}),
items AS ({_words("benchmark", "item_id", _LOWER, _PLAIN)}),
windows AS (
  SELECT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS passage
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
places AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS passage
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows))),
hits AS (SELECT places.r, item_id, places.n, i FROM places JOIN windows USING (passage, n)),
covered AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hits) GROUP BY 1),
found AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN found USING (r)"""

JACCARD = f"""
WITH RECURSIVE docs AS ({_words("documents", "doc_id", _LOWER, _SPACED)}),
shingles AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY 1),
pairs AS (
  SELECT a.r AS a, b.r AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b
  WHERE 100 * common >= 85 * (x.n + y.n - common)),
reach AS (SELECT r AS a, r AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
lowest AS (SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN docs ON docs.r = reach.b GROUP BY 1)
SELECT docs.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM docs LEFT JOIN sizes USING (r) JOIN lowest USING (r)"""

LINES = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
rows_ AS (
  SELECT r, source, i, l[i] AS line
  FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i
        FROM (SELECT r, source, string_split(text, chr(10)) AS l FROM docs WHERE text IS NOT NULL))),
boilerplate AS (
  SELECT line FROM rows_ WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1 HAVING count(DISTINCT source) >= 10),
kept AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text
  FROM (SELECT *, line IN (SELECT line FROM boilerplate) AS gone FROM rows_) GROUP BY 1)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
  length(kept.text) AS kept_chars, sha256(kept.text) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)"""

MIXING = """
WITH RECURSIVE docs AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS k, coalesce(md5(CAST(doc_id AS VARCHAR)), '') AS d FROM documents),
ranked AS (SELECT doc_id, source, k, row_number() OVER (PARTITION BY k ORDER BY d, doc_id) - 1 AS r FROM docs),
sources AS (SELECT k, count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS w FROM docs GROUP BY 1),
common AS (SELECT list_reduce(list(w), lambda a, b: gcd(a, b)) AS g, CAST(sum(w) AS BIGINT) AS total FROM sources),
quotas AS (
  SELECT k, n, CAST(w // g AS BIGINT) AS quota, total // g AS period, row_number() OVER (ORDER BY w, k) - 1 AS i
  FROM sources, common),
lists AS (SELECT list(quota ORDER BY i) AS q, any_value(period) AS period FROM quotas),
slots AS (
  SELECT CAST(0 AS BIGINT) AS t, CAST(-1 AS BIGINT) AS pick, list_transform(q, lambda x: CAST(0 AS BIGINT)) AS done, q, period FROM lists
  UNION ALL
  SELECT t + 1, pick_now, list_transform(done, lambda x, j: x + CASE WHEN j - 1 = pick_now THEN 1 ELSE 0 END), q, period
  FROM (
    SELECT *, list_min(list_filter(list_transform(range(len(q)), lambda i:
        CASE WHEN done[i + 1] < q[i + 1] AND (done[i + 1] * period) // q[i + 1] <= t
        THEN (((done[i + 1] + 1) * period + q[i + 1] - 1) // q[i + 1]) * 1000000 + i END), lambda x: x IS NOT NULL)) % 1000000 AS pick_now
    FROM slots WHERE t < period)),
turns AS (SELECT pick AS i, t - 1 AS pos, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS turn FROM slots WHERE t > 0),
plan AS (SELECT k, n, period, quota, turn, pos FROM quotas JOIN turns USING (i)),
ends AS (SELECT min((((n + 15) // 16) // quota) * period + pos) AS runs_out FROM plan WHERE turn = ((n + 15) // 16) % quota)
SELECT doc_id, source, r // 16 AS block, CAST(((r // 16) // quota) * period + pos AS BIGINT) AS slot, r % 16 AS in_block,
  ((r // 16) // quota) * period + pos < runs_out AS on_target
FROM ranked JOIN plan ON plan.k = ranked.k AND turn = (r // 16) % quota, ends"""

REPEATS = f"""
WITH docs AS ({_words("documents", "doc_id", "text", _SPACED)}),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS passage
  FROM (SELECT *, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35)),
repeated AS (SELECT passage FROM windows GROUP BY 1 HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS k FROM windows JOIN repeated USING (passage)),
each AS (SELECT r, k, w[k] AS word FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS k FROM docs)),
kept AS (
  SELECT r, count(gone.k) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY k) FILTER (gone.k IS NULL), '') AS text
  FROM each LEFT JOIN gone USING (r, k) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)"""

def _codes(rounds: int = 6, parts: int = 8, entries: int = 16) -> str:
    """Rounds of assignment and floored means, one after the other."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x
  FROM (SELECT *, unnest(range({parts})) AS p FROM kept)),
b0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c
  FROM cut WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries}))"""
    ]
    near = """SELECT vec_id, label, p, x, min({{'d': d, 'e': e}}) AS m
  FROM (SELECT *, list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS d
        FROM cut JOIN b{0} USING (p)) GROUP BY 1, 2, 3, 4"""
    for i in range(rounds):
        steps.append(
            f"""n{i} AS MATERIALIZED ({near.format(i)}),
s{i} AS (
  SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY k) AS c
  FROM (SELECT p, m.e AS e, k, CAST(sum(x[k]) AS BIGINT) AS s, count(*) AS n
        FROM (SELECT *, unnest(range(1, len(x) + 1)) AS k FROM n{i}) GROUP BY 1, 2, 3) GROUP BY 1, 2),
b{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(s{i}.c, b{i}.c) AS c FROM b{i} LEFT JOIN s{i} USING (p, e))"""
        )
    steps.append(
        f"""last AS MATERIALIZED ({near.format(rounds)}),
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM last GROUP BY 1, 2),
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})"""
    )
    return f"""WITH {", ".join(steps)}
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded, book"""


ORACLES: dict[str, str] = {
    "op2_decontamination": CONTAMINATION,
    "op6_jaccard_join": JACCARD,
    "op8_line_dedup": LINES,
    "op9_pfair_mixing": MIXING,
    "op10_substring_dedup": REPEATS,
    "op12_vector_codes": _codes(),
}
