"""The operators that SQL can express, as DuckDB queries over a table (or earlier CTE) of documents."""

from __future__ import annotations

from sluiceway.llm import mixing, packing, quality
from sluiceway.llm.text import DUCKDB_LOWER, DUCKDB_WORDS

WORDS, LOWER = DUCKDB_WORDS.format("text"), DUCKDB_LOWER.format("text")


def near_sql(table: str = "documents", p: str = "nd") -> tuple[str, str]:
    """CTEs and the name of the one with (doc_id, n_shingles, component_id): every pair by shared shingles."""
    ctes = f"""
{p}_w AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws FROM {table}),
{p}_x AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)] END AS sh FROM {p}_w),
{p}_s AS (SELECT DISTINCT doc_id, unnest(sh) AS s FROM {p}_x),
{p}_n AS (SELECT doc_id, count(*) AS n FROM {p}_s GROUP BY doc_id),
{p}_c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM {p}_s a JOIN {p}_s b ON a.s = b.s AND a.doc_id < b.doc_id
    GROUP BY ALL),
{p}_l AS (SELECT a, b FROM {p}_c JOIN {p}_n x ON x.doc_id = a JOIN {p}_n y ON y.doc_id = b
    WHERE 100 * c >= 75 * (x.n + y.n - c)),
{p}_e AS (SELECT a, b FROM {p}_l UNION SELECT b, a FROM {p}_l),
{p}_r AS (SELECT a AS d, a AS r FROM {p}_e UNION SELECT {p}_e.b, {p}_r.r FROM {p}_r JOIN {p}_e ON {p}_e.a = {p}_r.d),
{p}_g AS (SELECT d, min(r) AS g FROM {p}_r GROUP BY d),
{p}_out AS (SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(g, w.doc_id)::BIGINT AS component_id
    FROM {p}_w w LEFT JOIN {p}_n ON {p}_n.doc_id = w.doc_id LEFT JOIN {p}_g ON d = w.doc_id)"""
    return ctes, f"{p}_out"


def exact_sql(table: str = "documents") -> str:
    return f"""SELECT doc_id, max(doc_id) OVER (PARTITION BY t)::BIGINT AS keep_id,
  count(*) OVER (PARTITION BY t)::BIGINT AS group_size, doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
  sha256(t) AS text_sha256 FROM (SELECT doc_id, {LOWER} AS t FROM {table})"""


def mixing_sql(table: str = "documents", p: str = "mx") -> tuple[str, str]:
    """CTEs and the name of the plan: (doc_id, source, n_tokens, full_epochs, copies, block)."""
    grid = "SELECT min(a) AS a FROM (SELECT {lo} + i * {step} AS a FROM range(0, 1001) t(i)){frm} WHERE {fit}"
    fit = f"pow(least / most, a - 1) <= {mixing.MAX_REPEATS}"
    seed = mixing.SEED
    ctes = f"""
{p}_t AS (SELECT doc_id, source, len({WORDS})::BIGINT AS n_tokens FROM {table}),
{p}_s AS (SELECT source, sum(n_tokens)::BIGINT AS tokens, count(*) AS c, sum(sum(n_tokens)) OVER ()::BIGINT AS total
    FROM {p}_t GROUP BY source),
{p}_m AS (SELECT min(tokens / total) AS least, max(tokens / total) AS most FROM {p}_s WHERE tokens > 0),
{p}_a1 AS ({grid.format(lo="0", step="0.001", frm=f", {p}_m", fit=fit)}),
{p}_a2 AS (SELECT min(x) AS a FROM (SELECT greatest(a1.a - 0.001, 0) + i * 0.000001 AS x FROM {p}_a1 a1, range(0, 1001) t(i)), {p}_m
    WHERE {fit.replace("a - 1", "x - 1")}),
{p}_a3 AS (SELECT min(x) AS a FROM (SELECT greatest(a2.a - 0.000001, 0) + i * 0.000000001 AS x FROM {p}_a2 a2, range(0, 1001) t(i)),
    {p}_m WHERE {fit.replace("a - 1", "x - 1")}),
{p}_a AS (SELECT round(a::DOUBLE, 6) AS a FROM {p}_a3),
{p}_z AS (SELECT sum(pow(tokens / total, a)) AS z FROM {p}_s, {p}_a WHERE tokens > 0),
{p}_q AS (SELECT *, CASE WHEN tokens = 0 THEN 1 ELSE floor(target / tokens + 1e-9) END::BIGINT AS full_epochs FROM (
    SELECT source, tokens, c, (total * z / pow(most, a - 1)) * pow(tokens / total, a) / z AS target
    FROM {p}_s, {p}_a, {p}_z, {p}_m)),
{p}_p AS (SELECT t.doc_id, t.source, n_tokens, full_epochs,
    CASE WHEN tokens = 0 THEN 0 ELSE greatest(floor(target - full_epochs * tokens + 1e-3), 0) END::BIGINT AS part,
    ('0x' || substr(md5('{seed}|' || coalesce(t.doc_id::VARCHAR, '')), 1, 15))::BIGINT % ceil(c / {mixing.BLOCK_ROWS})::BIGINT AS block,
    md5(full_epochs || '|{seed}|' || coalesce(t.doc_id::VARCHAR, '')) AS doc_key
    FROM {p}_t t JOIN {p}_q q ON t.source IS NOT DISTINCT FROM q.source),
{p}_b AS (SELECT source, block, sum(n_tokens) AS k, any_value(part) AS part,
    md5(concat_ws('|', '{seed}', any_value(full_epochs)::VARCHAR, source, block::VARCHAR)) AS block_key
    FROM {p}_p GROUP BY source, block),
{p}_l AS (SELECT source, block, part - coalesce(sum(k) OVER (PARTITION BY source ORDER BY block_key
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remain FROM {p}_b),
{p}_out AS (SELECT d.doc_id, d.source, n_tokens, full_epochs, full_epochs + CASE WHEN remain > 0 AND
    sum(n_tokens) OVER (PARTITION BY d.source, d.block ORDER BY doc_key) <= remain THEN 1 ELSE 0 END AS copies, d.block
    FROM {p}_p d JOIN {p}_l l ON d.source IS NOT DISTINCT FROM l.source AND d.block = l.block)"""
    return ctes, f"{p}_out"


def order_sql(plan: str) -> str:
    seed = mixing.SEED
    return f"""SELECT doc_id, source, n_tokens, epoch, block,
  md5(concat_ws('|', '{seed}', epoch::VARCHAR, source, block::VARCHAR)) || '-' ||
  md5(epoch || '|{seed}|' || coalesce(doc_id::VARCHAR, '')) AS place
  FROM (SELECT *, unnest(range(0, copies)) AS epoch FROM {plan} WHERE copies > 0)"""


def packing_sql(table: str = "documents", p: str = "pk") -> tuple[str, str]:
    """CTEs and the name of (doc_id, n_tokens, bucket_length, batch, slot)."""
    bits = packing.PRECISION_BITS
    layers = [
        f"{p}_f1 AS (SELECT j, len * total AS f, 0::BIGINT AS cut FROM {p}_h UNION ALL SELECT 0, 0, 0)",
    ]
    for k in range(2, packing.BUCKETS + 1):
        layers.append(
            f"{p}_f{k} AS (SELECT h.j, min(f.f + h.len * (h.total - g.total)) AS f, "
            f"arg_min(f.j, (f.f + h.len * (h.total - g.total), f.j))::BIGINT AS cut FROM {p}_h h JOIN {p}_f{k - 1} f ON f.j < h.j "
            f"JOIN {p}_g g ON g.j = f.j GROUP BY h.j UNION ALL SELECT 0, 0, 0)"
        )
    path = [f"{p}_p{packing.BUCKETS} AS (SELECT max(j) AS j FROM {p}_h)"]
    for k in range(packing.BUCKETS - 1, 0, -1):
        path.append(f"{p}_p{k} AS (SELECT f.cut AS j FROM {p}_f{k + 1} f JOIN {p}_p{k + 1} q ON f.j = q.j)")
    bounds = " UNION ".join(f"SELECT j FROM {p}_p{k}" for k in range(1, packing.BUCKETS + 1))
    place = "coalesce(doc_id::VARCHAR, '') || '|' || n_tokens"
    ctes = f"""
{p}_t AS (SELECT *, ceil(n_tokens / unit)::BIGINT * unit AS length FROM (
    SELECT *, (1::BIGINT << greatest(length(bin(n_tokens)) - {bits + 1}, 0)) AS unit FROM (
    SELECT doc_id, len({WORDS})::BIGINT AS n_tokens FROM {table}))),
{p}_h AS (SELECT length AS len, count(*) AS c, sum(count(*)) OVER (ORDER BY length)::BIGINT AS total,
    row_number() OVER (ORDER BY length) AS j FROM {p}_t GROUP BY length),
{p}_g AS (SELECT j, total FROM {p}_h UNION ALL SELECT 0, 0),
{", ".join(layers)},
{", ".join(path)},
{p}_b AS (SELECT len FROM {p}_h WHERE j IN ({bounds})),
{p}_k AS (SELECT doc_id, n_tokens, (SELECT min(len) FROM {p}_b WHERE len >= length) AS bucket_length,
    md5({place}) AS key FROM {p}_t),
{p}_c AS (SELECT *, ('0x' || substr(key, 1, 15))::BIGINT % ceil(count(*) OVER (PARTITION BY bucket_length) / {packing.CHUNK_ROWS})::BIGINT
    AS chunk FROM {p}_k),
{p}_o AS (SELECT *, row_number() OVER (PARTITION BY bucket_length ORDER BY chunk, key) - 1 AS pos,
    greatest(1, {packing.BATCH_TOKENS} // greatest(1, bucket_length)) AS capacity FROM {p}_c),
{p}_out AS (SELECT doc_id, n_tokens, bucket_length, (pos // capacity)::BIGINT AS batch, (pos % capacity)::BIGINT AS slot FROM {p}_o)"""
    return ctes, f"{p}_out"


def _pipeline() -> str:
    near, near_out = near_sql("s2")
    mix, mix_out = mixing_sql("s3")
    pack, pack_out = packing_sql("s4")
    return f"""WITH RECURSIVE
s1 AS (SELECT doc_id, text, source FROM ({quality.oracle_query("documents", "doc_id, text, source")}) WHERE kept),
s2 AS (SELECT d.* FROM s1 d JOIN ({exact_sql("s1")}) e ON d.doc_id = e.doc_id WHERE kept),
{near},
s3 AS (SELECT d.* FROM s2 d JOIN {near_out} n ON d.doc_id = n.doc_id WHERE component_id = d.doc_id),
{mix},
s4 AS (SELECT doc_id, text FROM (SELECT d.*, unnest(range(0, copies)) AS copy FROM s3 d JOIN {mix_out} m ON d.doc_id = m.doc_id)),
{pack}
SELECT * FROM {pack_out}"""


def warc_sql(table: str = "pages") -> str:
    """The archive's rows; base 32 is read off the hex digest, five hex digits to four letters."""
    letters = ", ".join(
        f"(('0x' || substr(x, {5 * k + 1}, 5))::BIGINT >> {shift}) & 31" for k in range(8) for shift in (15, 10, 5, 0)
    )
    return f"""SELECT page_id, size::BIGINT AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v + 1)::INT, 1) FOR v IN [{letters}]], '') AS payload_digest,
  CASE WHEN last IS NULL OR last IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN last IS DISTINCT FROM page_id THEN last END AS refers_to
FROM (SELECT page_id, strlen(h) AS size, sha1(h) AS x, max(page_id) OVER (PARTITION BY h)::BIGINT AS last
  FROM (SELECT page_id, coalesce(html, '') AS h FROM {table}))"""


NEAR_SQL = "WITH RECURSIVE {0} SELECT *, component_id = doc_id AS kept FROM {1}".format(*near_sql())
MIXING_SQL = "WITH {0} {1}".format(mixing_sql()[0], order_sql(mixing_sql()[1]))
PACKING_SQL = "WITH {0} SELECT * FROM {1}".format(*packing_sql())
EXACT_SQL = exact_sql()
WARC_SQL = warc_sql()
QUALITY_SQL = quality.oracle_query()
PIPELINE_SQL = _pipeline()
