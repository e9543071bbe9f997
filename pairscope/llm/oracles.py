"""DuckDB SQL for the registered queries that SQL can express.

The parameters (seeds, shard counts, thresholds) are stated here again as
literals; nothing is taken from the operators.
"""

from __future__ import annotations

#: CRC-32 of a text's UTF-8 bytes, from the reversed polynomial 0xEDB88320: a
#: table of 256 remainders, then one step per byte of the hexadecimal form.
CRC_CTES = """
crc_steps AS (
  SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS rem
  FROM (SELECT unnest(range(256)) AS b)),
crc_table AS (SELECT list(rem ORDER BY b) AS t FROM crc_steps)
"""


def crc_sql(text: str) -> str:
    """The checksum of the SQL expression ``text``, given ``t`` of crc_table."""
    digits = f"hex({text})"
    return (f"xor(4294967295, list_reduce(list_transform(range(length({digits}) // 2), "
            f"lambda i: CAST('0x' || substr({digits}, 2 * i + 1, 2) AS BIGINT)), "
            f"lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT))")


def op2_sql() -> str:
    words = "regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]+')"
    shingles = ("unnest(list_distinct(list_transform(range(len(words) - w + 1), "
                "lambda i: array_to_string(words[i + 1: i + w], ' ')))) AS shingle")
    return f"""
WITH doc_words AS (SELECT DISTINCT doc_id AS id, text, {words} AS words FROM documents),
item_words AS (SELECT DISTINCT id, words, least(len(words), 5) AS w
               FROM (SELECT item_id AS id, {words} AS words FROM benchmark) WHERE len(words) > 0),
widths AS (SELECT DISTINCT w FROM item_words),
doc_shingles AS (SELECT id, w, {shingles} FROM doc_words, widths WHERE len(words) >= w),
item_shingles AS (SELECT id, w, {shingles} FROM item_words),
sizes AS (SELECT id, count(*) AS n FROM item_shingles GROUP BY id),
shared AS (
  SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared
  FROM doc_shingles d JOIN item_shingles i USING (shingle, w) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n AS n_item, n_shared::DOUBLE / n AS containment
FROM shared JOIN sizes ON item_id = id WHERE n_shared >= ceil(0.8 * n - 1e-9)
"""


def feistel_sql(n: str, value: str, a: str, b: str, seed: int) -> tuple[str, str]:
    """Eight rounds over columns l, r; returns the select lists' text for a recursive step."""
    prime = 2147483647
    multipliers = (48271, 69621, 40692, 39373, 16807, 62089911, 742938285, 950706376)
    left, right = f"({value} // {b})", f"({value} % {b})"
    steps = []
    for i, m in enumerate(multipliers):
        key = (seed * 1000003 + i * 7919 + 12345) % prime
        half = "r" if i % 2 == 0 else "l"
        f = f"(((({half} + {key}) % {prime}) * (({half} + {key}) % {prime}) % {prime} * {m} + {key}) % {prime})"
        steps.append(f"(l + {f}) % {a} AS l, r" if i % 2 == 0 else f"l, (r + {f}) % {b} AS r")
    return f"{left} AS l, {right} AS r", steps


def op5_sql() -> str:
    start, steps = feistel_sql("n", "x", "a", "b", 7)
    inner = f"SELECT row_number, n, a, b, {start} FROM walk WHERE x >= n OR step = 0"
    for s in steps:
        inner = f"SELECT row_number, n, a, b, {s} FROM ({inner})"
    inner = inner.replace("SELECT row_number, n, a, b,", "SELECT row_number, n, a, b, step,")
    return f"""
WITH RECURSIVE {CRC_CTES},
docs AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT + 1 AS size, {crc_sql("coalesce(text, '')")} AS text_crc32,
         text
  FROM documents, crc_table),
bucketed AS (
  SELECT doc_id, size, text_crc32,
         {crc_sql("concat(coalesce(CAST(doc_id AS VARCHAR), ''), '/', text_crc32, '/', size)")} % 4096 AS bucket
  FROM docs, crc_table),
numbered AS (
  SELECT doc_id, size, text_crc32, count(*) OVER () AS n,
         row_number() OVER (ORDER BY bucket, doc_id NULLS FIRST, text_crc32, size) - 1 AS row_number
  FROM bucketed),
sides AS (
  SELECT row_number, n, CAST(ceil(sqrt(n)) AS BIGINT) AS a FROM numbered),
walk AS (
  SELECT row_number, row_number AS x, n, a, (n + a - 1) // a AS b, 0 AS step FROM sides
  UNION ALL
  SELECT row_number, l * b + r AS x, n, a, b, step + 1 AS step FROM ({inner})),
permuted AS (SELECT row_number, x FROM walk WHERE step > 0 AND x < n)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(x % 16 AS INTEGER) AS shard, x // 16 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard, row_number
FROM numbered JOIN permuted USING (row_number)
"""


def op6_sql() -> str:
    return """
WITH sizes AS (
  SELECT source, sum(coalesce(strlen(text), 0) + 1) AS size FROM documents GROUP BY source),
rates AS (
  SELECT source, (1.0::DOUBLE / count(*) OVER ()) * (sum(size) OVER ())::DOUBLE / size::DOUBLE AS rate FROM sizes),
seeded AS (
  SELECT doc_id, d.source, rate,
         concat_ws(':', '11', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, ''))) AS key
  FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
parts AS (
  SELECT doc_id, source, key, i,
         CASE WHEN i < ceil(rate / 8) THEN 8.0 ELSE rate - 8.0 * (greatest(ceil(rate / 8), 1) - 1) END AS mean,
         CAST('0x' || substr(md5(concat(key, ':', i)), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
  FROM seeded, LATERAL (SELECT unnest(range(1, CAST(greatest(ceil(rate / 8), 1) AS BIGINT) + 1)) AS i)),
terms AS (SELECT k FROM (SELECT unnest(range(0, 61)) AS k)),
cdf AS (
  SELECT mean, k, sum(exp(-mean) * pow(mean, k) / gamma(k + 1)) OVER (PARTITION BY mean ORDER BY k) AS c
  FROM (SELECT DISTINCT mean FROM parts), terms),
drawn AS (
  SELECT doc_id, source, key, i, count(*) FILTER (WHERE u >= c) AS n
  FROM parts JOIN cdf USING (mean) GROUP BY doc_id, source, key, i),
counts AS (SELECT doc_id, source, key, CAST(sum(n) AS BIGINT) AS n FROM drawn GROUP BY doc_id, source, key)
SELECT doc_id, source, CAST(copy AS BIGINT) AS copy, md5(concat(key, '/', copy)) AS shuffle_key
FROM counts, LATERAL (SELECT unnest(range(1, n + 1)) AS copy)
"""


def op10_sql() -> str:
    return """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


def op11_sql() -> str:
    near = """near{r} AS MATERIALIZED (
  SELECT vec_id, label, pos, w, part, m.d AS d, m.entry AS entry FROM (
    SELECT vec_id, label, p.pos, w, part, min({{'d': CAST(list_inner_product(part, part) + list_inner_product(c, c)
             - 2 * list_inner_product(part, c) AS BIGINT), 'entry': entry}}) AS m
    FROM parts p JOIN book{r} b ON p.pos = b.pos GROUP BY vec_id, label, p.pos, w, part))"""
    book = """book{n} AS MATERIALIZED (
  SELECT b.pos, b.entry, coalesce(m.c, b.c) AS c
  FROM book{r} b LEFT JOIN (
    SELECT pos, entry, list(CAST(floor(s / n) AS DOUBLE) ORDER BY i) AS c FROM (
      SELECT pos, entry, i, sum(part[i]) AS s, count(*) AS n
      FROM near{r}, LATERAL (SELECT unnest(range(1, w + 1)) AS i) GROUP BY pos, entry, i)
    GROUP BY pos, entry) m ON b.pos = m.pos AND b.entry = m.entry)"""
    rounds = ",\n".join(near.format(r=r) + ",\n" + book.format(r=r, n=r + 1) for r in range(4))
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, label, pos, len(v) // 4 AS w, v[pos * (len(v) // 4) + 1: (pos + 1) * (len(v) // 4)] AS part
  FROM kept, LATERAL (SELECT unnest(range(4)) AS pos)),
book0 AS MATERIALIZED (
  SELECT pos, row_number() OVER (PARTITION BY pos ORDER BY vec_id) - 1 AS entry, part AS c FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256)),
{rounds},
{near.format(r=4)},
coded AS (
  SELECT vec_id, label, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY pos) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near4 GROUP BY vec_id, label),
digest AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY pos, entry, i)) AS h
  FROM (SELECT pos, entry, unnest(c) AS x, unnest(range(len(c))) AS i FROM book4))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM coded, digest
"""


def op13_sql() -> str:
    return """
WITH docs AS (
  SELECT doc_id, coalesce(CAST(source AS VARCHAR), '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
failing AS (
  SELECT doc_id, part, list_filter([
    CASE WHEN len(words) < 200 THEN 'A' END,
    CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' END,
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END], lambda f: f IS NOT NULL) AS fails
  FROM docs),
marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM failing LEFT JOIN marks USING (doc_id) GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS fs
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
  SELECT fs, step, fs[step] AS f, fs[1: step - 1] AS earlier, fs[1: step] AS so_far
  FROM orders, LATERAL (SELECT unnest(range(1, 6)) AS step)),
counts AS (
  SELECT part, array_to_string(fs, '') AS filter_order, step, f,
    coalesce(sum(n) FILTER (WHERE NOT list_has_any(fails, so_far)), 0) AS kept,
    coalesce(sum(n) FILTER (WHERE list_contains(fails, f) AND NOT list_has_any(fails, earlier)), 0) AS removed,
    coalesce(sum(n) FILTER (WHERE list_contains(fails, f) AND list_has_any(fails, earlier)), 0) AS redundant,
    coalesce(sum(n) FILTER (WHERE list_contains(fails, f) AND len(fails) = 1), 0) AS unique_fails,
    coalesce(sum(good) FILTER (WHERE list_contains(fails, f) AND NOT list_has_any(fails, earlier)), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE list_contains(fails, f) AND NOT list_has_any(fails, earlier)), 0) AS toxic_lost
  FROM masks, steps GROUP BY part, fs, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counts
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": op2_sql(), "op5_feistel_shards": op5_sql(), "op6_poisson_mix": op6_sql(),
            "op10_exact_dedup": op10_sql(), "op11_vector_codes": op11_sql(), "op13_filter_audit": op13_sql()}
