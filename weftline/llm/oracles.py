"""DuckDB SQL for those of the queries that SQL can express."""

from __future__ import annotations

from math import ceil

from .licenses import BLOCK, CONTAINMENT, PHRASES, TEMPLATES
from .lines import BASE, LEAST, MEAN, WINDOW
from .repeats import LENGTH
from .sharding import BUCKET_ROWS

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _op6() -> str:
    places, base = [], []
    for phrase, label in PHRASES.items():
        words = phrase.split()
        test = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(words, 1))
        places.append(f"list_filter(range(0, len(w)), lambda i: {test})")
        base.append((f"p{len(base)}", label))
    lists = ", ".join(f"{p} AS p{k}" for k, p in enumerate(places))
    both = "list_concat(" * (len(base) - 1) + "p0" + "".join(f", p{k})" for k in range(1, len(base)))
    words = ", ".join(f"({k}, '{x}')" for k, text in enumerate(TEMPLATES) for x in sorted(set(text.split())))
    rules = ", ".join(f"({k}, {ceil(CONTAINMENT * len(set(text.split())) - 1e-9)}, {ceil(BLOCK * len(text.split()))}, {float(len(set(text.split())))}, '{label}')" for k, (text, label) in enumerate(TEMPLATES.items()))
    labels = ", ".join([f"CASE WHEN len({p}) > 0 THEN '{label}' END" for p, label in base])
    join = "array_to_string(list_sort(list_distinct(list_filter({}, lambda x: x IS NOT NULL))), ',')"
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, {_LOWER.format("coalesce(text, '')")} AS t FROM documents),
w AS MATERIALIZED (SELECT r, doc_id, {_WORDS.format('t')} AS w FROM t),
template(k, word) AS (VALUES {words}), rule(k, need, length, size, label) AS (VALUES {rules}),
each AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM w),
shared AS MATERIALIZED (SELECT r, k, i, word FROM each JOIN template USING (word)),
enough AS (SELECT r, k, need, length, size, label FROM shared JOIN rule USING (k) GROUP BY r, k, need, length, size, label HAVING count(DISTINCT word) >= need),
likely AS MATERIALIZED (SELECT r, k, i, word, need, length, size, label FROM shared JOIN enough USING (r, k)),
counted AS (SELECT a.r, a.k, a.i, a.need, a.size, a.label, count(DISTINCT b.word) AS n FROM likely a JOIN likely b ON a.r = b.r AND a.k = b.k AND b.i <= a.i AND b.i > a.i - a.length GROUP BY ALL),
found AS (SELECT r, list(DISTINCT label) AS more, max(n / size) AS best FROM counted WHERE n >= need GROUP BY r),
p AS (SELECT r, doc_id, len(w) AS n_words, {lists} FROM w),
s AS (SELECT p.*, {both} AS b, coalesce(more, []) AS more, coalesce(best, 0.0) AS best FROM p LEFT JOIN found USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(b) AS BIGINT) AS n_base, CAST(list_min(b) AS BIGINT) AS first_word, CAST(list_max(b) AS BIGINT) AS last_word,
  {join.format('[' + labels + ']')} AS base_labels, {join.format('list_concat([' + labels + '], more)')} AS labels, CAST(CASE WHEN len(b) > 0 THEN 1.0 ELSE best END AS DOUBLE) AS score
FROM s"""


def _op1(n_shards: int = 24, seed: int = 7) -> str:
    """CRC-32 by its table, then one global rank where the operator sums over buckets."""
    return f"""
WITH RECURSIVE steps(i, c, k) AS (SELECT i, i, 0 FROM range(256) AS r(i) UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
bytes AS (SELECT doc_id, source, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS b FROM documents),
d AS (SELECT doc_id, source, CAST(len(b) + 8 AS BIGINT) AS size, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS BIGINT) AS text_crc32 FROM bytes, crc),
u AS (SELECT *, CAST('0x' || substr(md5('{seed}|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || text_crc32 || '|' || size), 1, 15) AS BIGINT) AS u, greatest(1, (count(*) OVER () + {BUCKET_ROWS - 1}) // {BUCKET_ROWS}) AS n_buckets, count(*) OVER () AS total FROM d),
f AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY u % n_buckets, u, doc_id NULLS FIRST, size, text_crc32) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY source) AS f FROM u),
p AS (SELECT *, row_number() OVER (ORDER BY f, source NULLS LAST) - 1 AS pos FROM f),
s AS (SELECT *, pos * {n_shards} // total AS shard FROM p)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard, CAST(pos - (shard * total + {n_shards - 1}) // {n_shards} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s"""


def _op3(piece: int = 512) -> str:
    """Every string of the length, counted as a whole; in hex, cut from pieces of a text so that no cut scans all of it."""
    n = LENGTH
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
pieces AS (SELECT r, c, substr(h, 2 * c + 1, {2 * (piece + n - 1)}) AS x FROM (SELECT r, h, unnest(range(0, length(h) // 2, {piece})) AS c FROM d)),
strings AS (SELECT r, c + j AS i, md5(substr(x, 2 * j + 1, {2 * n})) AS m FROM (SELECT r, c, x, unnest(range(0, least({piece}, length(x) // 2 - {n - 1}))) AS j FROM pieces)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY m) AS n FROM strings) WHERE n > 1),
islands AS (SELECT r, i, sum(CASE WHEN i - before <= {n} THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS k FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM again)),
spans AS MATERIALIZED (SELECT r, k, min(i) AS a, max(i) + {n} AS b FROM islands GROUP BY r, k),
gaps AS (SELECT r, k, coalesce(lag(b) OVER (PARTITION BY r ORDER BY k), 0) AS a, a AS b FROM spans UNION ALL SELECT r, max(k) + 1, max(b), NULL FROM spans GROUP BY r),
kept AS (SELECT g.r, string_agg(substr(h, 2 * a + 1, CASE WHEN b IS NULL THEN length(h) ELSE 2 * (b - a) END), '' ORDER BY k) AS h FROM gaps g JOIN d USING (r) GROUP BY g.r),
sums AS (SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed FROM spans GROUP BY r)
SELECT doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN sums USING (r) LEFT JOIN kept USING (r)"""


def _op4() -> str:
    """Boundaries by window functions: of lines in a row that may end a chunk every second one does, for chunks have two lines at least."""
    assert (WINDOW, LEAST) == (2, 2)
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT r, unnest(range(0, len(l))) AS i, unnest(l) AS x FROM d),
hashed AS (SELECT r, i, CAST(CAST('0x' || substr(md5(x), 1, 15) AS BIGINT) AS HUGEINT) AS h FROM lines),
rolled AS (SELECT r, i, ((h + coalesce(lag(h) OVER (PARTITION BY r ORDER BY i), 0) * {BASE}) % 18446744073709551616) // 8589934592 % {MEAN} = 0 AS may FROM hashed),
runs AS (SELECT r, i, i - row_number() OVER (PARTITION BY r ORDER BY i) AS run FROM rolled WHERE may),
nth AS (SELECT r, i, row_number() OVER (PARTITION BY r, run ORDER BY i) AS n, min(i) OVER (PARTITION BY r, run) AS first FROM runs),
ends AS (SELECT r, i + 1 AS e FROM nth WHERE n % 2 = CASE WHEN first = 0 THEN 0 ELSE 1 END UNION SELECT r, len(l) FROM d),
cut AS (SELECT r, coalesce(lag(e) OVER (PARTITION BY r ORDER BY e), 0) AS a, e AS b, row_number() OVER (PARTITION BY r ORDER BY e) - 1 AS k, count(*) OVER (PARTITION BY r) AS n_chunks FROM ends),
chunks AS MATERIALIZED (SELECT r, doc_id, k, a, b, n_chunks, k = n_chunks - 1 AS last, array_to_string(l[a + 1:b], chr(10)) || CASE WHEN k = n_chunks - 1 THEN '' ELSE chr(10) END AS x FROM cut JOIN d USING (r)),
units AS (SELECT r, doc_id, k, k AS k0, k AS k1, x FROM chunks WHERE b - a >= {LEAST}
  UNION ALL SELECT y.r, y.doc_id, y.n_chunks, z.k, y.k, z.x || y.x FROM chunks y JOIN chunks z ON y.r = z.r AND z.k = y.k - 1 WHERE y.last AND y.b - y.a < {LEAST}),
bodies AS (SELECT r, doc_id, k, k0, k1, CASE WHEN ends_with(x, chr(10)) THEN left(x, length(x) - 1) ELSE x END AS body FROM units),
ranked AS (SELECT r, k0, k1, row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS FIRST, r, k) AS n FROM bodies),
gone AS (SELECT DISTINCT r, unnest([k0, k1]) AS k FROM ranked WHERE n > 1),
marked AS (SELECT c.r, c.doc_id, c.k, c.a, c.b, c.n_chunks, c.x, g.k IS NOT NULL AS gone FROM chunks c LEFT JOIN gone g ON c.r = g.r AND c.k = g.k)
SELECT doc_id, CAST(max(b) AS BIGINT) AS n_lines, CAST(max(n_chunks) AS BIGINT) AS n_chunks, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS removed_chunks, CAST(coalesce(sum(b - a) FILTER (WHERE gone), 0) AS BIGINT) AS removed_lines,
  CAST(octet_length(encode(coalesce(string_agg(x, '' ORDER BY k) FILTER (WHERE NOT gone), ''))) AS BIGINT) AS kept_bytes, sha256(coalesce(string_agg(x, '' ORDER BY k) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id"""


def oracle_sql() -> dict[str, str]:
    return {"op1_interleaved_shards": _op1(), "op3_repeated_bytes": _op3(), "op4_line_chunks": _op4(), "op6_licenses": _op6()}
