"""Queries of log lines, errors and monitoring, over the table of events."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainloom.functions import messages as fn
from chainloom.operators import errors as op
from chainloom.plans.register import query
from chainloom.sources import ledger

# Lines of a log, as they occur; the number of the user is added at the end.
LINES = (
    "[12:00:01] Error 1452: foreign key constraint fails for tx", "[WARNING] failed to find existing transaction", "Warning: Historical reference of epoch", "SLOW SQL on table txes took",
    "ChainSync failed with status", "[ERROR] BlockFetch stopped at", "deadlock seen in worker", "dial tcp: connection refused by node", "read timeout after", "Duplicate entry in batch",
    "failed to process block", "[12:00:09] all is well with peer", "Error 9007: Write conflict in region", "packets.go:122: unexpected seq nr: got 7 want 3", "[mysql] connection.go:10 busy buffer",
    "Pool metadata fetch failed for", "Handshake Failed with version mismatch", "too many connections from", "unknown constraint on row", "Error: bad transaction in mempool",
)
_SQL_LINES = "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in LINES) + "]"
_LOG = f"""WITH log AS (SELECT event_id, ts, user_id, event_type, value, {_SQL_LINES}[event_id % {len(LINES)} + 1] AS text, {_SQL_LINES}[event_id % {len(LINES)} + 1] || ' ' || user_id AS line FROM events)
"""


def _log(spark, sf_dir):
    text = F.element_at(F.array(*map(F.lit, LINES)), (F.col("event_id") % len(LINES) + 1).cast("int"))
    events = ledger.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return events.withColumn("text", text).withColumn("line", F.concat_ws(" ", "text", "user_id"))


def _any(column: str, parts) -> str:
    return "(" + " OR ".join(f"contains({column}, '" + p.replace("'", "''") + "')" for p in parts) + ")"


@query(_LOG + """SELECT event_id, CASE WHEN instr(line, '] ') > 0 THEN substr(line, instr(line, '] ') + 2) ELSE line END AS message,
  string_split(r, '|')[1] AS kind, string_split(r, '|')[2] AS component, string_split(r, '|')[3] AS operation FROM (SELECT *, CASE
  WHEN contains(line, 'Error 1452') OR contains(line, 'foreign key constraint') THEN 'Constraint|Database|ForeignKey'
  WHEN contains(line, 'Error 1062') OR contains(line, 'Duplicate entry') THEN NULL
  WHEN contains(line, 'SLOW SQL') OR contains(line, 'slow query') THEN 'Slow Query|Database|SlowQuery'
  WHEN contains(line, 'failed to process') THEN 'Processing|Processor|ProcessBlock'
  WHEN (contains(line, 'Warning:') OR contains(line, '[WARNING]')) AND contains(line, 'failed to find existing transaction') THEN 'Warning|Transaction|Lookup'
  WHEN (contains(line, 'Warning:') OR contains(line, '[WARNING]')) AND contains(line, 'Historical reference') THEN 'Warning|Transaction|HistoricalRef'
  WHEN contains(line, 'Warning:') OR contains(line, '[WARNING]') THEN 'Warning|General|Warning'
  WHEN contains(line, 'Error:') OR contains(line, '[ERROR]') OR contains(line, 'failed') THEN 'Processing|' || CASE WHEN contains(line, 'BlockFetch') THEN 'BlockFetch|Fetch'
    WHEN contains(line, 'ChainSync') THEN 'ChainSync|Sync' WHEN contains(line, 'connection') THEN 'Network|Connection' WHEN contains(line, 'transaction') THEN 'Transaction|Process'
    WHEN contains(line, 'block') THEN 'Block|Process' ELSE 'General|Error' END
  WHEN contains(line, 'constraint') THEN 'Constraint|Database|Constraint' WHEN contains(line, 'deadlock') THEN 'Database|Database|Deadlock'
  WHEN contains(line, 'connection refused') OR contains(line, 'connection reset') THEN 'Network|Network|Connection'
  WHEN contains(line, 'timeout') THEN 'Network|Network|Timeout' END AS r FROM log) WHERE r IS NOT NULL""")
def log_parse(spark, sf_dir):
    rows = _log(spark, sf_dir).withColumn("r", fn.parse_log(F.col("line"))).where("r is not null")
    return rows.select("event_id", fn.without_stamp(F.col("line")).alias("message"), "r.kind", "r.component", "r.operation")


@query(_LOG + f"SELECT text, count(*) AS n, {_any('text', fn.RETRYABLE)} AS retryable, {_any('lower(text)', fn.NON_CRITICAL)} AS non_critical FROM log GROUP BY text")
def retryable_errors(spark, sf_dir):
    rows = _log(spark, sf_dir).groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    return rows.select("text", "n", fn.is_retryable(F.col("text")).alias("retryable"), fn.is_non_critical(F.col("text")).alias("non_critical"))


@query(_LOG + f"""SELECT event_type, count(*) AS kept FROM log WHERE NOT ({_any('line', fn.NOISE)} OR (event_type = 'error' AND contains(line, 'metadata')))
GROUP BY event_type""")
def error_noise_filter(spark, sf_dir):
    kind = F.when(F.col("event_type") == "error", "Processing").otherwise("Other")
    rows = _log(spark, sf_dir).where(~fn.is_noise(kind, F.lit("Node"), F.lit("Read"), F.col("line")))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("kept"))


@query(_LOG + """SELECT text, count(*) AS n, CASE WHEN contains(text, 'foreign key') OR contains(text, 'duplicate') OR contains(text, 'constraint') THEN 'Constraint'
 WHEN contains(text, 'connection') OR contains(text, 'timeout') THEN 'Network' WHEN contains(text, 'validation') THEN 'Validation' ELSE 'Processing' END AS kind FROM log GROUP BY text""")
def processor_error_kinds(spark, sf_dir):
    return _log(spark, sf_dir).groupBy("text").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", fn.error_kind(F.col("text")))


@query(_LOG + """, low AS (SELECT event_id, line, lower(line) AS l FROM log) SELECT event_id, CASE WHEN contains(l, 'packets.go') THEN 'MySQL.Packets' WHEN contains(l, 'connection.go') THEN 'MySQL.Connection'
 WHEN contains(l, 'connection refused') OR contains(l, 'timeout') THEN 'MySQL.Network' WHEN contains(l, 'too many connections') THEN 'MySQL.Connection' WHEN contains(l, 'deadlock') THEN 'MySQL.Transaction' ELSE 'MySQL' END AS component,
 CASE WHEN contains(l, 'packets.go') THEN 'Packet sequence mismatch: got 7 want 3' WHEN contains(l, 'connection.go') THEN 'Connection buffer busy - possible protocol desync'
 WHEN contains(l, 'connection refused') THEN 'Connection refused by MySQL server' WHEN contains(l, 'read timeout') THEN 'Read timeout exceeded' WHEN contains(l, 'timeout') THEN 'Connection timeout'
 WHEN contains(l, 'too many connections') THEN 'Maximum connection limit reached' WHEN contains(l, 'deadlock') THEN 'Transaction deadlock detected' ELSE line END AS message FROM low""")
def driver_log_classes(spark, sf_dir):
    return _log(spark, sf_dir).withColumn("d", fn.driver_error(F.col("line"))).select("event_id", "d.component", "d.message")


@query(_LOG + """SELECT event_type AS kind, text AS message, count(*) AS count, min(ts) AS first_seen, max(ts) AS last_seen, arg_max(event_id, (ts, event_id)) AS last_details
FROM log GROUP BY 1, 2""")
def error_dedup(spark, sf_dir):
    rows = _log(spark, sf_dir).select(F.col("event_type").alias("kind"), F.col("text").alias("message"), "ts", F.col("event_id").alias("details"))
    return op.deduplicated(rows, ["kind", "message"])


@query(_LOG + """, d AS (SELECT event_type AS kind, text, count(*) AS c FROM log GROUP BY 1, 2) SELECT kind, CAST(sum(c) AS BIGINT) AS errors, count(*) AS distinct_errors,
CAST(sum(sum(c)) OVER () AS BIGINT) AS all_errors, CAST(sum(c) AS DOUBLE) / CAST(sum(sum(c)) OVER () AS DOUBLE) AS share FROM d GROUP BY kind""")
def error_stats(spark, sf_dir):
    return op.statistics(error_dedup(spark, sf_dir), "kind")


@query(_LOG + """, s AS (SELECT event_id, ts, CASE event_type WHEN 'error' THEN 'CRITICAL' WHEN 'purchase' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END AS severity FROM log)
SELECT event_id, ts, severity, row_number() OVER (ORDER BY CASE severity WHEN 'CRITICAL' THEN 0 WHEN 'ERROR' THEN 1 WHEN 'WARNING' THEN 2 ELSE 3 END, ts DESC, event_id) AS number FROM s
ORDER BY number LIMIT 5000""")
def error_report(spark, sf_dir):
    kind = F.col("event_type")
    severity = F.when(kind == "error", "CRITICAL").when(kind == "purchase", "ERROR").when(kind == "signup", "WARNING").otherwise("INFO")
    return op.report(_log(spark, sf_dir).select("event_id", "ts", severity.alias("severity")), "severity", "ts", "event_id", 5000)


@query("""SELECT event_id, ts FROM (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS n FROM events) WHERE n > greatest(1, (SELECT count(*) // 10 FROM events))""", views=False)
def eviction(spark, sf_dir):
    return op.evict_oldest(ledger.table(spark, sf_dir, "events").select("event_id", "ts"), "ts", "event_id")


@query("SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 24 HOUR", views=False)
def recent_errors(spark, sf_dir):
    return op.newer_than(ledger.table(spark, sf_dir, "events").select("event_id", "ts"), "ts", "24 HOURS")


@query("""WITH e AS (SELECT event_type, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS before_ FROM events)
SELECT event_type, before_ AS gap_start, ts AS gap_end, date_diff('microsecond', before_, ts) AS gap_us FROM e WHERE date_diff('microsecond', before_, ts) > 3600000000""", views=False)
def stall_gaps(spark, sf_dir):
    return op.gaps(ledger.table(spark, sf_dir, "events").select("event_type", "ts"), "ts", "event_type", 3600)


@query("""SELECT time_bucket(INTERVAL 3 SECOND, ts) AS start, count(*) AS events, count(*) / 3.0e0 AS per_second FROM events GROUP BY 1""", views=False)
def block_rate_window(spark, sf_dir):
    rows = ledger.table(spark, sf_dir, "events").groupBy(F.window("ts", "3 seconds").alias("w")).agg(F.count(F.lit(1)).alias("events"))
    return rows.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "events", (F.col("events") / F.lit(3.0)).alias("per_second"))


@query("""SELECT key, count(*) AS entries, count(DISTINCT tx_hash) AS txes FROM tx_metadata GROUP BY key""")
def metadata_stats(spark, sf_dir):
    return ledger.tx_metadata(spark, sf_dir).groupBy("key").agg(F.count(F.lit(1)).alias("entries"), F.countDistinct("tx_hash").alias("txes"))


@query("""SELECT tx_hash AS key, count(*) AS entries FROM tx_metadata GROUP BY 1 ORDER BY entries DESC, key LIMIT 10""")
def metadata_top_keys(spark, sf_dir):
    return ledger.tx_metadata(spark, sf_dir).groupBy(F.col("tx_hash").alias("key")).agg(F.count(F.lit(1)).alias("entries")).orderBy(F.desc("entries"), "key").limit(10)


@query("SELECT event_id, tx_hash, key FROM tx_metadata WHERE key IN ('click', 'purchase')")
def metadata_label_filter(spark, sf_dir):
    labels = ["click", "purchase"]  # an empty list of labels lets all pass
    return ledger.tx_metadata(spark, sf_dir).where(F.col("key").isin(labels) if labels else F.lit(True)).select("event_id", "tx_hash", "key")


@query("SELECT event_id, CAST(json_extract(json, '$.k') AS BIGINT) AS k, json_type(json, '$.k') = 'UBIGINT' AS is_number, json_extract_string(json, '$.missing') AS missing FROM tx_metadata")
def metadata_json_extract(spark, sf_dir):
    rows = ledger.tx_metadata(spark, sf_dir)
    return rows.select("event_id", F.get_json_object("json", "$.k").cast("long").alias("k"), F.get_json_object("json", "$.k").rlike(r"^\d+$").alias("is_number"), F.get_json_object("json", "$.missing").alias("missing"))


@query("""SELECT event_type AS type, count(*) AS scripts, (SELECT count(*) FROM events WHERE value > 50) AS redeemers FROM events GROUP BY 1""", views=False)
def script_stats(spark, sf_dir):
    events = ledger.table(spark, sf_dir, "events")
    redeemers = F.broadcast(events.where("value > 50").agg(F.count(F.lit(1)).alias("redeemers")))
    return events.groupBy(F.col("event_type").alias("type")).agg(F.count(F.lit(1)).alias("scripts")).crossJoin(redeemers)


_STATEMENT = "'SELECT * FROM `' || p_brand || '` WHERE x = ' || p_partkey || repeat(' AND y', p_size * 4)"


@query(f"""WITH s AS (SELECT p_partkey, {_STATEMENT} AS q FROM part) SELECT p_partkey, 'SELECT' AS operation, regexp_extract(q, 'FROM `(.*?)`', 1) AS table_name,
CASE WHEN length(q) > 500 THEN substr(q, 1, 500) || '...' ELSE q END AS short FROM s""", views=False)
def sql_trace(spark, sf_dir):
    parts = ledger.table(spark, sf_dir, "part")
    text = F.concat(F.lit("SELECT * FROM `"), "p_brand", F.lit("` WHERE x = "), F.col("p_partkey").cast("string"), F.expr("repeat(' AND y', p_size * 4)"))
    return parts.select("p_partkey", fn.sql_operation(text).alias("operation"), fn.sql_table(text).alias("table_name"), fn.shorten(text).alias("short"))
