"""The queries of this package, with SQL where SQL can say the same."""

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm import merkle, mixing, neardup, packing, quality, recipes, repair, repeats, sharding, templates, topk, vectors, warczip
from skyloom.tables import table

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def add(build):
        QUERIES[build.__name__] = build
        if oracle:
            ORACLES[build.__name__] = oracle
        return build

    return add


TOKENIZER = os.environ.get("SKYLOOM_TOKENIZER") or public_tokenizers.path("word_bpe_49k.json")

MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'b' ELSE 'a' || source END AS src,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT src, CAST(sum(size) AS BIGINT) AS s FROM d GROUP BY src),
w AS (SELECT src, s, ([5.0, 2.0, 1.0])[CAST((row_number() OVER (ORDER BY src) - 1) % 3 AS INTEGER) + 1] AS w FROM s),
o AS (SELECT src, s, CAST(w AS DOUBLE) AS w, row_number() OVER (ORDER BY 2.0 * s / w, src) AS i,
             CAST(sum(s) OVER () AS DOUBLE) * 1.5 AS total, sum(CAST(w AS DOUBLE)) OVER () AS weights,
             coalesce(CAST(2 * sum(s) OVER (ORDER BY 2.0 * s / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0.0) AS used,
             coalesce(sum(CAST(w AS DOUBLE)) OVER (ORDER BY 2.0 * s / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS gone
      FROM w),
l AS (SELECT (total - used) / (weights - gone) AS level FROM o WHERE 2.0 * s >= (total - used) / (weights - gone) * w ORDER BY i LIMIT 1),
t AS (SELECT src, s, least(2.0 * s, (SELECT level FROM l) * w) AS target FROM o),
e AS (SELECT src, s, target, CASE WHEN s > 0 THEN CAST(floor(target / s) AS BIGINT) ELSE 0 END AS epochs FROM t),
p AS (SELECT d.*, e.s, e.target, e.epochs, CAST(floor(e.target) AS BIGINT) - e.epochs * e.s AS rest,
             coalesce(sum(d.size) OVER (PARTITION BY d.src ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN e ON d.src = e.src)
SELECT doc_id, size, s AS source_size, target, CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM p
"""


@query(MIX_SQL)
def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op3_virtual_slot_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents"))


@query()
def op8_best_two_fit(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), TOKENIZER)


@query()
def op4_multi_index_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), 3, (85, 100))


TOP_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query(TOP_SQL)
def op9_pivot_top_k(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return topk.search(rows, rows.where("vec_id % 50 = 0"))


@query()
def op10_spherical_cells(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


@query()
def op5_naive_bayes_support_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT h, max(page_id) AS first FROM p GROUP BY h)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST((CAST('0x' || substr(p.h, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p JOIN m ON p.h = m.h
"""


@query(WARC_SQL)
def op6_zip_archives(spark: SparkSession, folder: str) -> DataFrame:
    read = warczip.round_trip(table(spark, folder, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


TEMPLATE_SQL = r"""
WITH d AS (SELECT doc_id, text, row_number() OVER (PARTITION BY doc_id, text) AS nth FROM documents),
raw AS (SELECT DISTINCT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS raw FROM d WHERE nth = 1),
l AS (SELECT DISTINCT doc_id, text, trim(regexp_replace(regexp_replace(raw, '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line FROM raw),
k AS (SELECT doc_id, text, line, CASE WHEN line = '' THEN [] ELSE string_split(line, ' ') END AS t FROM l),
j AS (SELECT *, len(t) AS n, array_to_string(t[1:3], ' ') AS lead FROM k WHERE len(t) >= 3),
leaf AS (SELECT n, lead FROM j GROUP BY n, lead HAVING count(*) >= 10),
o AS (SELECT j.* FROM j SEMI JOIN leaf ON j.n = leaf.n AND j.lead = leaf.lead),
s AS (SELECT n, lead, line, t, count(*) AS c FROM o GROUP BY ALL),
a AS (SELECT n, lead, line, c, unnest(t) AS token, unnest(range(1, CAST(n AS BIGINT) + 1)) AS pos FROM s),
f AS (SELECT n, lead, pos, token FROM a GROUP BY ALL HAVING sum(c) >= 10),
g AS (SELECT a.n, a.lead, a.line, list(CASE WHEN f.token IS NULL THEN '<*>' ELSE a.token END ORDER BY a.pos) AS template
      FROM a LEFT JOIN f ON a.n = f.n AND a.lead = f.lead AND a.pos = f.pos AND a.token = f.token GROUP BY a.n, a.lead, a.line),
h AS (SELECT * FROM g WHERE 2 * len(list_filter(template, lambda x: x = '<*>')) <= n),
i AS (SELECT o.doc_id, o.text, o.line, o.n, h.template FROM o JOIN h ON o.line = h.line),
r1 AS (SELECT template FROM (SELECT DISTINCT doc_id, text, template FROM i) GROUP BY template HAVING count(*) >= 10),
w AS (SELECT doc_id, text, sum(len(t)) AS every FROM k GROUP BY ALL),
y AS (SELECT i.doc_id, i.text, sum(i.n) AS same FROM i SEMI JOIN r1 ON i.template = r1.template GROUP BY ALL),
z AS (SELECT y.doc_id, y.text FROM y JOIN w ON y.doc_id IS NOT DISTINCT FROM w.doc_id AND y.text = w.text WHERE 2 * y.same > w.every),
q AS (SELECT i.* FROM i ANTI JOIN z ON i.doc_id IS NOT DISTINCT FROM z.doc_id AND i.text = z.text),
r2 AS (SELECT template FROM (SELECT DISTINCT doc_id, text, template FROM q) GROUP BY template HAVING count(*) >= 10),
x AS (SELECT q.doc_id, q.text, list(DISTINCT q.line) AS gone FROM q SEMI JOIN r2 ON q.template = r2.template GROUP BY ALL),
e AS (SELECT documents.doc_id, documents.text, string_split(coalesce(documents.text, ''), chr(10)) AS raws, coalesce(x.gone, []) AS gone
      FROM documents LEFT JOIN x ON documents.doc_id IS NOT DISTINCT FROM x.doc_id AND documents.text = x.text),
b AS (SELECT doc_id, text, raws, list_filter(raws, lambda u: NOT list_contains(gone,
        trim(regexp_replace(regexp_replace(u, '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' '))) AS kept FROM e)
SELECT doc_id, CAST(CASE WHEN coalesce(text, '') = '' THEN 0 ELSE len(raws) END AS BIGINT) AS n_lines,
       CAST(len(raws) - len(kept) AS BIGINT) AS n_dropped, md5(array_to_string(kept, chr(10))) AS kept_md5
FROM b
"""


@query(TEMPLATE_SQL)
def op7_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    rows = templates.without_recurring_lines(table(spark, folder, "documents"))
    return rows.select("row.doc_id", "n_lines", "n_dropped", F.md5(F.coalesce("kept_text", F.lit(""))).alias("kept_md5"))


@query()
def op2_prefix_free_repeats(spark: SparkSession, folder: str) -> DataFrame:
    rows = repeats.without_repeats(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query()
def op11_midstate_manifest(spark: SparkSession, folder: str) -> DataFrame:
    changed = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    offered = F.when(changed, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = merkle.manifest(table(spark, folder, "documents"), offered)
    names = {"leaf": "leaf", "subroot": "subroot", "root": "root", "proof_sha256": "proof", "folded_root": "folded"}
    digests = [F.lower(F.hex(column)).alias(name) for name, column in names.items()]
    return rows.select("doc_id", *digests, (F.col("folded") == F.col("root")).alias("verified"))


@query()
def op12_ranked_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return repair.repairs(repair.damaged(conversations), conversations)


RECIPE_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size,
       (doc_id IS NOT DISTINCT FROM keep_id) AND row_number() OVER (PARTITION BY n.t, doc_id) = 1 AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
"""


@query(RECIPE_SQL)
def op13_chunk_recipes(spark: SparkSession, folder: str) -> DataFrame:
    return recipes.duplicates(table(spark, folder, "documents"))
