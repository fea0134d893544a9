"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return (rf"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


def decontamination(documents: str = "documents", benchmark: str = "benchmark") -> str:
    """Every window of every item against every run of as many words."""
    return f"""
WITH item AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_words('text')} AS w FROM {benchmark}),
win AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[s : s + 9], ' ') AS gram
        FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS s FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
doc AS (SELECT doc_id, {_words('text')} AS w FROM {documents}),
run AS (SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS gram
        FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
              FROM doc JOIN sizes ON len(w) >= n)),
hit AS (SELECT doc_id, run.n, s, item FROM run JOIN win ON run.n = win.n AND run.gram = win.gram),
place AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM hit GROUP BY doc_id),
tok AS (SELECT doc_id, w, unnest(w) AS term, generate_subscripts(w, 1) - 1 AS pos FROM doc),
seen AS (SELECT term, count(*) AS n FROM tok GROUP BY term),
gram AS (SELECT gram, string_split(gram, ' ') AS words FROM win WHERE n > 1 GROUP BY gram),
part AS (SELECT gram, words, unnest(words) AS term, generate_subscripts(words, 1) - 1 AS off FROM gram),
rare AS (SELECT * FROM (SELECT part.*, row_number() OVER (PARTITION BY gram ORDER BY coalesce(n, 0), off, part.term) AS r
                        FROM part LEFT JOIN seen ON part.term = seen.term) WHERE r <= 2),
head AS (SELECT doc_id, gram, words, pos - off AS s, w[greatest(1, pos - 8) : pos + 10] AS near,
                pos >= off AND w[pos - off + 1 : pos - off + len(words)] = words AS exact
         FROM tok JOIN rare ON tok.term = rare.term),
close_ AS (SELECT DISTINCT doc_id, gram, s FROM head WHERE NOT exact
           AND len(list_intersect(list_distinct(near), list_distinct(words))) >= 0.8::DOUBLE * len(list_distinct(words))),
nears AS (SELECT doc_id, count(*) AS n_near FROM close_ GROUP BY doc_id),
near_named AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS near_items
               FROM close_ JOIN win ON close_.gram = win.gram GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(array_to_string(coalesce(items, []), ',')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near,
       sha256(array_to_string(coalesce(near_items, []), ',')) AS near_items_sha256
FROM doc LEFT JOIN place USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN nears USING (doc_id)
LEFT JOIN near_named USING (doc_id)"""


def repeated_bytes(documents: str = "documents") -> str:
    """Every string of 100 bytes of every document, as hex."""
    return f"""
WITH doc AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM {documents}),
hexed AS (SELECT doc_id, hex(b) AS h, octet_length(b) AS n FROM doc),
place AS (SELECT doc_id, n, h, unnest(range(n)) AS p FROM hexed),
start AS (SELECT doc_id, p, substring(h, 2 * p + 1, 2) AS byte,
                 CASE WHEN p + 100 <= n THEN substring(h, 2 * p + 1, 200) END AS s FROM place),
earlier AS (SELECT doc_id, p, byte, s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1 AS again
            FROM start),
gone AS (SELECT doc_id, p, byte, coalesce(max(CASE WHEN again THEN p END) OVER (
             PARTITION BY doc_id ORDER BY p) > p - 100, false) AS gone FROM earlier),
edge AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS head FROM gone),
sums AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (head) AS n_spans,
                string_agg(byte, '' ORDER BY p) FILTER (NOT gone) AS kept FROM edge GROUP BY doc_id)
SELECT hexed.doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM hexed LEFT JOIN sums USING (doc_id)"""


def filter_audit(documents: str = "documents", labels: str = "labels") -> str:
    """All 120 orders, each step by step over all documents' failures."""
    return f"""
WITH text AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM {documents}),
word AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first_id FROM text),
label AS (SELECT doc_id AS label_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
          FROM {labels} GROUP BY doc_id),
doc AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
               CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
               || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
               || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
               || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
               || CASE WHEN first_id < doc_id THEN 'E' ELSE '' END AS failed
        FROM word LEFT JOIN label ON doc_id = label_id),
combo AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM doc GROUP BY part, failed),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letter a, letter b, letter c, letter d, letter e
           WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before
          FROM orders, (SELECT unnest(generate_series(1, 5)) AS step)),
cell AS (SELECT *, contains(failed, f) AS hit,
                len(list_intersect(string_split(failed, ''), string_split(before, ''))) > 0
                AND failed <> '' AND before <> '' AS gone FROM combo, steps),
report AS (SELECT part, filter_order, step, f,
                  CAST(coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0) AS BIGINT) AS kept,
                  CAST(coalesce(sum(n) FILTER (hit AND NOT gone), 0) AS BIGINT) AS removed,
                  CAST(coalesce(sum(n) FILTER (hit AND gone), 0) AS BIGINT) AS redundant,
                  CAST(coalesce(sum(n) FILTER (failed = f), 0) AS BIGINT) AS unique_fails,
                  CAST(coalesce(sum(good) FILTER (hit AND NOT gone), 0) AS BIGINT) AS good_lost,
                  CAST(coalesce(sum(toxic) FILTER (hit AND NOT gone), 0) AS BIGINT) AS toxic_lost
           FROM cell GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM report"""


def vector_codes(embeddings: str = "embeddings", rounds: int = 2) -> str:
    """Every part against every entry, in each round."""
    width = "(SELECT len(v) // 16 FROM whole ORDER BY vec_id, v LIMIT 1)"
    sql = f"""
WITH whole AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
               FROM {embeddings} WHERE embedding IS NOT NULL
               AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
piece AS (SELECT vec_id, label, p, v[p * {width} + 1 : (p + 1) * {width}] AS x
          FROM whole, (SELECT unnest(range(16)) AS p)),
seed AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM whole ORDER BY vec_id LIMIT 64),
book0 AS (SELECT p, e, x AS c FROM piece JOIN seed USING (vec_id)),"""
    for r in range(rounds + 1):
        sql += f"""
near{r} AS (SELECT vec_id, label, piece.p, x, min(struct_pack(
                d := CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), e := e)) AS best
          FROM piece JOIN book{r} ON piece.p = book{r}.p GROUP BY vec_id, label, piece.p, x),"""
        if r < rounds:
            sql += f"""
mean{r} AS (SELECT p, e, list(CAST(floor(total / n) AS BIGINT) ORDER BY j) AS c
          FROM (SELECT p, best.e AS e, j, count(*) AS n, sum(x[j]) AS total
                FROM near{r}, (SELECT unnest(range(1, {width} + 1)) AS j) GROUP BY p, best.e, j) GROUP BY p, e),
book{r + 1} AS (SELECT book{r}.p, book{r}.e, coalesce(mean{r}.c, book{r}.c) AS c
          FROM book{r} LEFT JOIN mean{r} ON book{r}.p = mean{r}.p AND book{r}.e = mean{r}.e),"""
    return sql + f"""
coded AS (SELECT vec_id, label, string_agg(printf('%02x', CAST(best.e AS INT)), '' ORDER BY p) AS code,
                 CAST(sum(best.d) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM coded"""


def oracle() -> dict[str, str]:
    return {"op1_suffix_dedup": repeated_bytes(), "op2_positional_index": decontamination(),
            "op11_filter_audit": filter_audit(), "op12_cover_codes": vector_codes()}
