"""DuckDB SQL with the results of the queries that SQL can express."""

DECONTAMINATION = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s + 1 : s + n], ' ') AS k
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS s FROM b WHERE len(w) > 0)),
pos AS (
  SELECT doc_id, n, s, array_to_string(w[s + 1 : s + n], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, s, pos.n, item_id FROM pos JOIN win ON pos.n = win.n AND pos.k = win.k),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS list FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

#: CRC-32 byte by byte; the walk of the jump hash as a recursion, modulo 2^64.
SHARDING = """
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
docs AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (
  SELECT doc_id, (n + 1)::BIGINT AS size,
         xor(list_reduce([4294967295] || list_transform(range(n), lambda k: ('0x' || substr(h, 2 * k + 1, 2))::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM docs, crc_table),
walk AS (
  SELECT doc_id, shards, -1::BIGINT AS b, 0::BIGINT AS j, ((doc_id::HUGEINT + 18446744073709551616) % 18446744073709551616)::UHUGEINT AS key
  FROM (SELECT DISTINCT doc_id FROM documents), (VALUES (8), (9)) AS v(shards)
  UNION ALL
  SELECT doc_id, shards, j, floor((j + 1)::DOUBLE * 2147483648.0 / ((k2 // 8589934592)::DOUBLE + 1))::BIGINT, k2
  FROM (SELECT *, (key * 2862933555777941757 + 1) % 18446744073709551616 AS k2 FROM walk WHERE j < shards)),
placed AS (SELECT doc_id, max(b) FILTER (shards = 8) AS shard, max(b) FILTER (shards = 9) AS grown FROM walk GROUP BY doc_id),
keyed AS (
  SELECT *, ((((doc_id::UHUGEINT * 2862933555777941757 + 1) % 18446744073709551616) // 1099511627776)::BIGINT + text_crc32) % 4096 AS bucket
  FROM sized JOIN placed USING (doc_id))
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id, text_crc32, size) - 1 AS slot, grown::INTEGER AS grown_shard
FROM keyed
"""


def licences(templates: dict[str, str], threshold: float) -> str:
    """Dice coefficients of every window of a text with every template of its size.

    The k-th occurrence of a bigram that a template has m times counts for the starts after
    the (k - m)-th, as long as the window holds it.
    """
    rows = ", ".join("({}, {})".format(*("'" + x.replace("'", "''") + "'" for x in item)) for item in templates.items())
    low = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH t AS (SELECT name, w, len(w) - 1 AS s FROM (SELECT name, {low.format("line")} AS w FROM (VALUES {rows}) AS v(name, line)) WHERE len(w) > 1),
d AS (SELECT row_number() OVER () AS part, doc_id, {low.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT name, g, count(*) AS m FROM (SELECT name, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS g FROM t) GROUP BY ALL),
a AS (
  SELECT part, p, w[p + 1] || ' ' || w[p + 2] AS g FROM (SELECT part, w, unnest(range(0, len(w) - 1)) AS p FROM d)),
ranked AS (SELECT part, p, g, row_number() OVER (PARTITION BY part, g ORDER BY p) AS k FROM a WHERE g IN (SELECT g FROM b)),
occurs AS (
  SELECT ranked.part, name, ranked.p, coalesce(before.p, -1) AS q
  FROM ranked JOIN b USING (g) LEFT JOIN ranked AS before ON before.part = ranked.part AND before.g = b.g AND before.k = ranked.k - b.m),
sized AS (
  SELECT part, name, p, q, len(d.w) - 1 AS n, s, least(s, len(d.w) - 1) AS width FROM occurs JOIN d USING (part) JOIN t USING (name)),
starts AS (
  SELECT part, name, width + s AS total, unnest(range(greatest(p - width + 1, q + 1, 0), least(p, n - width) + 1)) AS start FROM sized),
hits AS (
  SELECT part, name, start, 2 * count(*) / any_value(total) AS dice FROM starts GROUP BY part, name, start
  HAVING 2 * count(*) >= {threshold} * any_value(total) - 1e-9),
marked AS (SELECT *, coalesce(lag(start) OVER (PARTITION BY part, name ORDER BY start), -2) <> start - 1 AS begins FROM hits),
named AS (SELECT part, name, max(dice) AS dice, count(*) FILTER (begins) AS spans FROM marked GROUP BY part, name),
best AS (
  SELECT part, sum(spans) AS n_matches, first(name ORDER BY dice DESC, name) AS licence, max(dice) AS dice, string_agg(name, ',' ORDER BY name) AS licences
  FROM named GROUP BY part)
SELECT d.doc_id, coalesce(n_matches, 0)::BIGINT AS n_matches, licence, coalesce(dice, 0)::DOUBLE AS dice, coalesce(licences, '') AS licences
FROM d LEFT JOIN best USING (part)
"""
