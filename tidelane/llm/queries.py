"""The queries of the thirteen operators, each over its whole table, with the SQL of those that SQL can express."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelane.llm import classlm, clusters, decontaminate, infill, langid, lines, neardup, order, pieces, pii, quality, urls, warc
from tidelane.llm.frames import find_package, written
from tidelane.session import new_folder

#: The model file's path on every executor.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None):
    def add(query):
        @functools.wraps(query)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            find_package(spark)
            return query(spark, sf_dir)

        QUERIES[query.__name__] = run
        if sql is not None:
            ORACLES[query.__name__] = sql
        return run

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@register()
def op1_class_scores(spark, sf_dir):
    """Base and class-model log10 probabilities of all texts, trained on those whose crc32(doc_id) mod 7 is not 2."""
    training = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    docs = read(spark, sf_dir, "documents")
    scored = classlm.score(docs, F.coalesce(training, F.lit(True)), ["doc_id"])
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


@register()
def op2_piece_dropout(spark, sf_dir):
    """Piece ids of all texts at a dropout rate of 0.1, and whether decoding gives the text back."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = pieces.encode(docs, PIECE_MODEL, "found").drop("text")
    return found.select("doc_id", "found.n_tokens", "found.ids", "found.lossless")


@register()
def op3_contamination(spark, sf_dir):
    """What of each document is in windows of 13 words of benchmark items."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, read(spark, sf_dir, "benchmark"), "found")
    return found.select(
        "doc_id", "found.n_words", decontaminate.n_hit("found").alias("n_hit"), F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("found.items"), ","), 256).alias("items_sha256"), decontaminate.contaminated("found").alias("contaminated"),
    )


@register()
def op4_personal_data(spark, sf_dir):
    """Personal data in each document."""
    return pii.digest(read(spark, sf_dir, "documents"), ["doc_id"])


@register()
def op5_training_order(spark, sf_dir):
    """All documents, as UTF-8 byte ids, in shards in training order; a row for each sequence read back."""
    docs = read(spark, sf_dir, "documents").select(F.col("text").cast("binary").alias("tokens"))
    path = new_folder(spark, "order")
    order.write_order(docs, path)
    return order.read_order(spark, path).select("slot", "shard", "byte_offset", "n_tokens", "crc32")


# The table holds no dates and no lists: both are derived from its rows, by digests that both engines compute alike.
_NUMBER = "CAST(conv(substr(md5(concat('key', key)), 1, 6), 16, 10) AS INT)"


def _entries(pages: DataFrame) -> DataFrame:
    """Entries for hosts, parent domains and paths that occur: added, in part removed, in part added once more."""
    keys = urls.with_keys(pages.select("url"), "url", "key").select("key").where("key LIKE '%.%'").distinct()
    keyed = keys.withColumn("n", F.expr(_NUMBER)).where("n % 3 = 0").withColumn("list", F.expr("element_at(array('ads', 'adult', 'malware', 'spam'), CAST(n % 4 AS INT) + 1)"))
    steps = F.expr("filter(array(struct('add' AS action, n % 400 AS day), struct('remove' AS action, 400 + n % 300 AS day), struct('add' AS action, 700 + n % 200 AS day)), (s, i) -> i <= n % 4)")
    return keyed.select("list", "key", F.inline(steps)).select("list", "key", "action", F.expr("date_add(DATE '2023-01-01', CAST(day AS INT))").alias("day"))


@register(
    """
    WITH p AS (SELECT DISTINCT page_id, url, CAST(DATE '2023-01-01' + CAST(page_id % 1000 AS INTEGER) AS DATE) AS fetched,
        regexp_replace(lower(url), '^[a-z][a-z0-9+.-]*://|[?#].*$', '', 'g') AS rest FROM pages),
    h AS (SELECT *, regexp_replace(regexp_replace(string_split(rest, '/')[1], '^.*@', ''), '\\.?(:[0-9]*)?$', '') AS host FROM p),
    s AS (SELECT *, string_split(host, '.') AS labels, list_filter(string_split(rest, '/')[2:], lambda x: x <> '') AS steps FROM h WHERE host <> ''),
    k AS (SELECT DISTINCT page_id, url, fetched, unnest(list_concat(
        list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.')),
        list_transform(range(1, len(steps) + 1), lambda i: host || '/' || array_to_string(steps[:i], '/')))) AS key FROM s),
    n AS (SELECT key, CAST(('0x' || substr(md5('key' || key), 1, 6)) AS INTEGER) AS n FROM (SELECT DISTINCT key FROM k WHERE key LIKE '%.%')),
    e AS (SELECT list_extract(['ads', 'adult', 'malware', 'spam'], n % 4 + 1) AS list, key,
            DATE '2023-01-01' + n % 400 AS since, CASE WHEN n % 4 >= 1 THEN DATE '2023-01-01' + (400 + n % 300) END AS until FROM n WHERE n % 3 = 0
        UNION ALL SELECT list_extract(['ads', 'adult', 'malware', 'spam'], n % 4 + 1), key, DATE '2023-01-01' + (700 + n % 200), NULL FROM n WHERE n % 3 = 0 AND n % 4 >= 2),
    f AS (SELECT page_id, url, count(*) AS n, string_agg(DISTINCT list, ',' ORDER BY list) AS lists
        FROM k JOIN e USING (key) WHERE since <= fetched AND (until IS NULL OR fetched < until) GROUP BY page_id, url)
    SELECT p.page_id, p.url, p.fetched, coalesce(f.n, 0) AS n_entries, coalesce(f.lists, '') AS lists, f.n IS NOT NULL AS blocked
    FROM p LEFT JOIN f ON p.page_id = f.page_id AND p.url = f.url
    """
)
def op6_listed_urls(spark, sf_dir):
    """Every page with the lists that held its URL on the day of its fetch."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url").withColumn("fetched", F.expr("date_add(DATE '2023-01-01', CAST(page_id % 1000 AS INT))"))
    return urls.listed(pages, _entries(pages))


@register(
    """
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, coalesce(source, '') AS site FROM documents),
    l AS (SELECT r, site, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM d),
    t AS (SELECT site, count(*) AS total FROM d GROUP BY site),
    b AS (SELECT site, line FROM (SELECT DISTINCT r, site, line, total FROM l JOIN t USING (site) WHERE trim(line) <> '') GROUP BY site, line
        HAVING count(*) >= 5 AND count(*) > 0.1 * any_value(total)),
    k AS (SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE b.line IS NOT NULL) AS n_dropped,
        coalesce(string_agg(l.line, chr(10) ORDER BY place) FILTER (WHERE b.line IS NULL), '') AS text
        FROM l LEFT JOIN b ON l.site = b.site AND l.line = b.line GROUP BY r)
    SELECT doc_id, CASE WHEN d.text IS NOT NULL THEN k.text END AS text, n_lines, n_dropped FROM d JOIN k USING (r)
    """
)
def op7_site_lines(spark, sf_dir):
    """All documents without the lines that more than a tenth of their source's documents hold."""
    out = lines.drop_boilerplate(read(spark, sf_dir, "documents"), "found")
    return out.select("doc_id", "text", "found.n_lines", "found.n_dropped")


@register()
def op8_quality_rules(spark, sf_dir):
    """Counts, base rules and the verdict of the calibrated rules for each document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    measured = written(quality.measure(docs, "m").drop("text"), "measures")
    cutoffs = quality.calibrate(measured, read(spark, sf_dir, "labels"), "m")
    failed, rules = quality.base_failed("m"), quality.failed_rules(cutoffs, "m")
    return measured.select(
        "doc_id", *(f"m.{c}" for c in quality.COUNTS), failed.alias("base_failed"), (~failed & (F.size(rules) == 0)).alias("kept"), F.array_join(rules, ",").alias("failed_rules")
    )


@register()
def op9_zstd_archives(spark, sf_dir):
    """A WARC record for each page, written to archives and read back."""
    path = new_folder(spark, "archives")
    warc.write_archives(read(spark, sf_dir, "pages"), path)
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^urn:page:(-?[0-9]+)$', 1) AS BIGINT)")
    return warc.read_archives(spark, path).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"), "error"
    )


@register()
def op10_near_duplicates(spark, sf_dir):
    """The near-duplicate class of each document."""
    return neardup.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "class_id")


def _clusters_sql(rounds: int = 10) -> str:
    """All rounds in a row, one comparison of all vectors with all centroids each."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, c, dist FROM (SELECT r, c, sum((x - m) * (x - m)) AS dist FROM e JOIN c{i} USING (d) GROUP BY r, c)
            QUALIFY row_number() OVER (PARTITION BY r ORDER BY dist, c) = 1)""")
        if i < rounds:
            steps.append(f"""s{i} AS (SELECT c, d, sum(x) AS s, count(*) AS n FROM a{i} JOIN e USING (r) GROUP BY c, d),
                c{i + 1} AS MATERIALIZED (SELECT c, d, coalesce((s - ((s % n) + n) % n) // n, m) AS m FROM c{i} LEFT JOIN s{i} USING (c, d))""")
    return f"""
    WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
        e AS MATERIALIZED (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM v),
        c0 AS MATERIALIZED (SELECT c, unnest(v) AS m, generate_subscripts(v, 1) AS d FROM (SELECT v, row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c FROM v) WHERE c < 8),
        {", ".join(steps)},
        h AS (SELECT c, sha256(string_agg(CAST(m AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
    SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance, CAST(sum(dist) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
        CAST(sum(dist) OVER () AS BIGINT) AS inertia, centroid_sha256
    FROM a{rounds} JOIN v USING (r) JOIN h USING (c)
    """


@register(_clusters_sql())
def op11_drift_clusters(spark, sf_dir):
    """The cluster of each vector after ten rounds, exact, with squared distances and inertia."""
    return clusters.cluster_vectors(read(spark, sf_dir, "embeddings"))


@register(
    """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS lines FROM d),
    k AS (SELECT *, len(lines) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(lines) + 1) AS k1, CAST('0x' || h[9:16] AS BIGINT) % (len(lines) + 1) AS k2,
        CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM u),
    p AS (SELECT doc_id, t, n, array_to_string(lines[:least(k1, k2)], '') AS pre, array_to_string(lines[least(k1, k2) + 1:greatest(k1, k2)], '') AS mid,
        array_to_string(lines[greatest(k1, k2) + 1:], '') AS suf,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM k)
    SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
        sha256(t) AS restored_sha256 FROM p
    """
)
def op12_fill_in_middle(spark, sf_dir):
    """All documents rearranged by lines, and restored from what was written."""
    made = infill.fill_in_middle(read(spark, sf_dir, "documents").select("doc_id", "text"), "made").select("doc_id", "made.*")
    back = infill.restored(made, "output", "form", "restored")
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


@register()
def op13_language(spark, sf_dir):
    """The language of each document, learned from the labels of those whose crc32(doc_id) mod 4 is not 2."""
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    found = langid.identify(docs.select("doc_id", "text"), langid.learn(docs, ~held_out), "found")
    return found.select("doc_id", held_out.alias("held_out"), F.col("found.lang").alias("lang_pred"), "found.score", "found.margin", "found.accepted")
