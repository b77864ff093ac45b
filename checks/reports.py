"""Reports on the ledger, and checks of messages and texts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks.ledgers import LEDGER_SQL, ledger
from checks import expected
from checks.registry import pick, pick_sql, read, register
from tidelane.functions import text
from tidelane.operators import monitor

_DURATION = """
    CASE WHEN us = 0 THEN '0s' WHEN us < 1000 THEN us || 'µs'
         WHEN us < 1000000 THEN (us // 1000) || CASE WHEN us % 1000 > 0
              THEN '.' || rtrim(lpad(CAST(us % 1000 AS VARCHAR), 3, '0'), '0') ELSE '' END || 'ms'
         ELSE CASE WHEN us >= 3600000000 THEN (us // 3600000000) || 'h' ELSE '' END
           || CASE WHEN us >= 60000000 THEN (us // 60000000 % 60) || 'm' ELSE '' END
           || (us // 1000000 % 60) || CASE WHEN us % 1000000 > 0
              THEN '.' || rtrim(lpad(CAST(us % 1000000 AS VARCHAR), 6, '0'), '0') ELSE '' END || 's' END
"""


@register(f"""
    WITH l AS ({LEDGER_SQL}), f AS (
        SELECT table_name, strftime("at", '%Y-%m-%d') AS run_id, duration_us AS us, error FROM l WHERE event = 'failed'
    )
    SELECT run_id, table_name, 'Table: ' || table_name || chr(10) || '  Duration: ' || {_DURATION} || chr(10)
           || '  Error: ' || regexp_replace(error, '[^ ]*://[^ ]*', '[REDACTED]') AS report
    FROM f
    UNION ALL SELECT run_id, NULL, 'Total failed tables: ' || count(*) FROM f GROUP BY run_id
""")
def failure_report(spark, sf_dir):
    results = ledger(spark, sf_dir).where("event <> 'started'").select(
        F.date_format("at", "yyyy-MM-dd").alias("run_id"), "table_name", (F.col("event") == "completed").alias("success"),
        "duration_us", "error",
    )
    return monitor.failure_report(results)


@register(f"SELECT o_orderkey, {_DURATION} AS took FROM (SELECT o_orderkey, CAST(pow(10, o_orderkey % 10) AS BIGINT) * o_custkey AS us FROM orders)")
def readable_duration(spark, sf_dir):
    took = F.pow(F.lit(10), F.col("o_orderkey") % 10).cast("bigint") * F.col("o_custkey")
    return read(spark, sf_dir, "orders").select("o_orderkey", text.format_duration(took).alias("took"))


@register(f"""
    WITH l AS ({LEDGER_SQL}), g AS (
        SELECT connection, table_name, "at",
               lag("at") OVER (PARTITION BY connection, table_name ORDER BY "at", run_id) AS gap_from
        FROM l WHERE event = 'completed'
    )
    SELECT connection, table_name, gap_from, "at" AS gap_to, epoch_us("at") - epoch_us(gap_from) AS gap_us
    FROM g WHERE epoch_us("at") - epoch_us(gap_from) > 86400000000
""")
def sync_gap(spark, sf_dir):
    return monitor.sync_gaps(ledger(spark, sf_dir), 43_200)


@register(f"""
    SELECT connection, table_name, max("at") AS last_completed FROM ({LEDGER_SQL}) WHERE event = 'completed'
    GROUP BY 1, 2 HAVING TIMESTAMP '2024-01-31 00:00:00' - max("at") > INTERVAL 1 DAY
""")
def overdue_tables(spark, sf_dir):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return monitor.overdue_tables(ledger(spark, sf_dir), 43_200, now)


# Every way a URL can stand in a message: bare, in quotes, at either end, twice, or not at all.
_MESSAGE = """
    CASE page_id % 6
        WHEN 0 THEN concat('dial ', url, ' failed') WHEN 1 THEN concat('"', url, '" refused, then ', url)
        WHEN 2 THEN url WHEN 3 THEN concat('cannot parse ', chr(39), url, chr(39))
        WHEN 4 THEN concat('no host in ', replace(url, '://', ':'))
        ELSE concat(html, ' ', url, ' ', html) END
"""


@register(rf"""
    SELECT page_id, regexp_replace(message, '[^ "'']*?://[^ "'']*', '[REDACTED]') AS message
    FROM (SELECT page_id, {_MESSAGE} AS message FROM pages)
""")
def redact_urls(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", F.expr(_MESSAGE).alias("message"))
    return pages.select("page_id", text.redact_urls(F.col("message")).alias("message"))


_WORDS = [
    "Authentication failed for", "PERMISSION DENIED on", "access denied:", "invalid credentials in", "Unauthorized",
    "403 Forbidden", "incompatible schema in", "incompatible type of", "connection refused by", "Connection reset by",
    "i/o timeout at", "context deadline exceeded", "temporary failure in", "429 too many requests", "rate limit hit",
    "Quota exceeded", "service unavailable", "server busy", "broken pipe", "unexpected EOF", "timeout: unauthorized",
    "no such table", "", "disk full",
]
@register(f"""
    SELECT doc_id, CASE WHEN regexp_matches(e, '{expected.FATAL}') THEN 'fatal'
           WHEN regexp_matches(e, '{expected.RETRYABLE}') THEN 'retryable' ELSE 'other' END AS class
    FROM (SELECT doc_id, lower(text || ' ' || {pick_sql(_WORDS, 'doc_id')}) AS e FROM documents)
""")
def classify_error(spark, sf_dir):
    message = F.concat("text", F.lit(" "), pick(_WORDS, "doc_id"))
    return read(spark, sf_dir, "documents").select("doc_id", text.classify_error(message).alias("class"))


_SETTINGS = """
    concat(text, CASE lang
        WHEN 'en' THEN concat(chr(10), 'password: ', source, chr(10), '  slack_webhook: ${HOOK}', chr(10))
        WHEN 'fr' THEN concat(chr(10), '# password: x', chr(10), chr(9), 'credentials_file:  /etc/', source, chr(13), chr(10))
        WHEN 'de' THEN concat(chr(10), 'password:', chr(10), 'slack_webhook:y', chr(10), 'my password: z')
        ELSE '' END)
"""


@register(f"""
    WITH t AS (SELECT doc_id, unnest(string_split({_SETTINGS}, chr(10))) AS raw,
                      generate_subscripts(string_split({_SETTINGS}, chr(10)), 1) AS n FROM documents),
    l AS (SELECT doc_id, n, regexp_extract(trim(raw, concat(' ', chr(9), chr(13))),
          '^(password|slack_webhook|credentials_file):[ \\t\\r]*(.+)$', ['field', 'val']) AS m FROM t)
    SELECT doc_id, CAST(n AS INTEGER) AS line_no, m.field AS field FROM l
    WHERE m.field <> '' AND NOT contains(m.val, '${{')
""")
def literal_credential_scan(spark, sf_dir):
    texts = spark.sql(f"SELECT doc_id, {_SETTINGS} AS text FROM {{documents}}".replace("${HOOK}", "${{HOOK}}"),
                      documents=read(spark, sf_dir, "documents"))
    return monitor.literal_credential_scan(texts, "doc_id")


@register(f"""
    SELECT day AS run_id, CAST(count(*) FILTER (event = 'completed') AS BIGINT) AS succeeded,
           CAST(count(*) FILTER (event = 'failed') AS BIGINT) AS failed,
           CAST(coalesce(sum(rows) FILTER (event = 'completed'), 0) AS BIGINT) AS rows_synced,
           CAST(sum(duration_us) AS BIGINT) AS total_us, max(duration_us) AS longest_us,
           max(CASE event WHEN 'failed' THEN 1 ELSE 0 END) AS exit_code
    FROM (SELECT *, strftime("at", '%Y-%m-%d') AS day FROM ({LEDGER_SQL})) WHERE event <> 'started' GROUP BY day
""")
def run_summary(spark, sf_dir):
    return monitor.run_summary(ledger(spark, sf_dir).withColumn("run_id", F.date_format("at", "yyyy-MM-dd")))


@register(f"""
    SELECT run_id, table_name, event = 'completed' AS success, duration_us, error FROM ({LEDGER_SQL})
    WHERE event <> 'started'
    QUALIFY row_number() OVER (PARTITION BY connection, table_name ORDER BY "at" DESC, run_id DESC) = 1
""")
def latest_attempt(spark, sf_dir):
    return monitor.latest_attempt(ledger(spark, sf_dir))
