"""DuckDB SQL for the queries that SQL can express."""

from strandloom.llm.reputation import SECOND

_CRC_TABLE = "(SELECT list(list_reduce([n::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) FROM range(256) r(n))"

_OP2 = f"""
WITH raw AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), tab AS (SELECT {_CRC_TABLE} AS tab),
b AS (SELECT doc_id, strlen(t) + 1 AS size, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: ('0x' || h)::BIGINT) AS b FROM raw),
c AS (SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda s, x: xor(s >> 8, tab[xor(s & 255, x) + 1])), 4294967295) AS text_crc32 FROM b, tab),
p AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS LAST, size, text_crc32 ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total FROM c),
s AS (SELECT *, least(15, ((2 * before + size) * 16) // (2 * total))::INT AS shard FROM p)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY before, doc_id) - 1 AS slot, NULL::INT AS grown_shard FROM s"""


def _level(counts: str, key: str, parent: str | None, up: str | None) -> str:
    """CTEs {key}_m, {key}_s and {key}_r: rates of a level shrunk towards the level above."""
    mean = f"{key}_m AS (SELECT c.*, (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM {counts}) AS m FROM {counts} c)" if parent is None else f"{key}_m AS (SELECT c.*, p.a / (p.a + p.b) AS m, p.a + p.b AS p FROM {counts} c JOIN {parent} p ON p.{up} = c.{up})"
    return f"""{mean},
{key}_x AS (SELECT sum(n * pow(bad / n - m, 2)) AS ss, sum(m * (1 - m)) AS noise, sum((n - 1) * m * (1 - m)) AS room FROM {key}_m WHERE n > 1),
{key}_s AS (SELECT round(CASE WHEN room > 0 THEN greatest(1.0, least(1000.0, 1 / greatest((ss - noise) / room, 0.000001::DOUBLE) - 1)) ELSE 1 END, 6) AS s FROM {key}_x),
{key}_t AS (SELECT {key}_m.*, {"s" if parent is None else "p * s / (p + s + 1) AS s"} FROM {key}_m, {key}_s),
{key}_r AS (SELECT *, bad + m * s AS a, n - bad + (1 - m) * s AS b FROM {key}_t)"""


_SECOND = "|".join(SECOND)

_OP4 = rf"""
WITH parts AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', ['h', 'p']) AS x FROM pages),
u AS (SELECT page_id, translate(x.h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, x.p AS path FROM parts),
marks AS (SELECT doc_id, count(*) AS n, sum((coalesce(quality = 0, false) OR coalesce(toxic = 1, false))::INT) AS bad FROM labels GROUP BY doc_id),
sites AS (SELECT regexp_replace(regexp_replace(host, '(?s)^.*@', ''), ':[0-9]*\z', '') AS host, coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad FROM u LEFT JOIN marks ON doc_id = page_id GROUP BY 1),
ends AS (SELECT *, regexp_matches(host, '^\[.*\]\z|^[0-9]{{1,3}}(\.[0-9]{{1,3}}){{3}}\z') AS address, CASE WHEN regexp_matches(host, '(?:^|\.)(?:{_SECOND})\.[a-z]{{2}}\z') THEN array_to_string(string_split(host, '.')[-2:], '.') ELSE string_split(host, '.')[-1] END AS last FROM sites),
hosts AS (SELECT host, CASE WHEN address THEN host ELSE array_to_string(string_split(host, '.')[-(len(string_split(last, '.')) + 1):], '.') END AS domain, CASE WHEN address THEN '' ELSE last END AS suffix, n, bad FROM ends),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY 1, 2), suffixes AS (SELECT suffix, sum((n > 0)::INT)::DOUBLE AS n, sum(CASE WHEN n > 0 THEN bad / n ELSE 0 END) AS bad FROM domains GROUP BY 1),
{_level("suffixes", "suffix", None, None)}, {_level("domains", "domain", "suffix_r", "suffix")}, {_level("hosts", "host", "domain_r", "domain")},
known AS (SELECT host, a / (a + b) - 1.645::DOUBLE * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.2::DOUBLE AS bad FROM host_r),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (SELECT page_id, host, path, max({{'n': length(h || p), 'rule': h || p, 'verdict': verdict}}) AS r FROM (SELECT DISTINCT page_id, host, path FROM u) d JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL)
SELECT u.page_id, u.host, u.path, f.r.rule AS rule, coalesce(f.r.verdict, CASE WHEN k.bad THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN fits f ON f.page_id IS NOT DISTINCT FROM u.page_id AND f.host = u.host AND f.path = u.path LEFT JOIN known k ON k.host = regexp_replace(regexp_replace(u.host, '(?s)^.*@', ''), ':[0-9]*\z', '')"""

_OP6 = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5('17/' || coalesce(doc_id::VARCHAR, '')) AS mixed FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][(row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1] AS weight, source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *, cap / weight AS ratio, sum(source_size) OVER () * 1.5::DOUBLE AS budget,
  coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_,
  sum(weight) OVER (ORDER BY cap / weight, source IS NULL, encode(source) ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w),
v AS (SELECT *, (budget - full_) / rest AS level FROM l),
g AS (SELECT source, source_size, weight, least(cap, coalesce((SELECT min({'r': ratio, 'l': level}) FROM v WHERE ratio >= level).l, (SELECT max(ratio) FROM v)) * weight) AS target FROM v),
r AS (SELECT d.*, source_size, weight, target, sum(size) OVER (PARTITION BY d.source ORDER BY mixed ROWS UNBOUNDED PRECEDING) - size AS before FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
t AS (SELECT doc_id, size, mixed, e AS epoch, (e * source_size + before + size) / weight AS finish FROM r, range(2) x(e) WHERE size > 0),
q AS (SELECT *, row_number() OVER o AS place, sum(size) OVER (o ROWS UNBOUNDED PRECEDING) - size AS spent FROM t WINDOW o AS (ORDER BY finish, mixed, epoch)),
z AS (SELECT max(place) AS last FROM q WHERE spent + size / 2 <= (SELECT sum(target) FROM g)),
c AS (SELECT mixed, count(*) FILTER (place <= (SELECT last FROM z)) AS copies FROM q GROUP BY mixed)
SELECT r.doc_id, r.size::BIGINT AS size, source_size, target, (coalesce(copies, 0) * r.size)::BIGINT AS taken FROM r LEFT JOIN c USING (mixed)"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP8 = rf"""
WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark), d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
places AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS pos FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[pos:pos + n - 1], ' ') AS g FROM places),
grams AS (SELECT doc_id, n, pos, array_to_string(w[pos:pos + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS pos FROM d, (SELECT DISTINCT n FROM win))),
met AS (SELECT doc_id, item_id, pos, grams.n FROM grams JOIN win ON win.g = grams.g AND win.n = grams.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM met) GROUP BY doc_id),
own AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM met) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN own USING (doc_id)"""

ORACLES: dict[str, str] = {"op2_shards": _OP2, "op4_reputation": _OP4, "op6_mixing": _OP6, "op8_decontamination": _OP8}
