"""Queries of the static dimensions: parameters and tuning of eras, protocol versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from chainloom.functions import slots
from chainloom.plans.register import query
from chainloom.sources import ledger, parameters

_EPOCHS = "WITH e AS (SELECT DISTINCT epoch_no - 100 AS epoch_no FROM blocks)"
_ERA = "CASE " + " ".join(f"WHEN epoch_no >= {s} THEN '{n}'" for n, s in reversed(slots.ERA_EPOCHS)) + " END"


def _epochs(spark, sf_dir):
    return ledger.blocks(spark, sf_dir).select((F.col("epoch_no") - 100).alias("epoch_no")).distinct()


@query(_EPOCHS + f", p(era, key_deposit, pool_deposit, n_opt, rho, tau, protocol_major, max_block_size) AS (VALUES {', '.join(str((p['era'], p['key_deposit'], p['pool_deposit'], p['n_opt'])) [:-1] + f', {p['rho']!r}::DOUBLE, {p['tau']!r}::DOUBLE, {p['protocol_major']}, {p['max_block_size']})' for p in parameters.ERA_PARAMETERS)}) SELECT e.epoch_no, p.era, CAST(key_deposit AS BIGINT) AS key_deposit, CAST(pool_deposit AS BIGINT) AS pool_deposit, CAST(n_opt AS BIGINT) AS n_opt, rho, tau, CAST(protocol_major AS BIGINT) AS protocol_major, CAST(max_block_size AS BIGINT) AS max_block_size FROM e JOIN p ON p.era = {_ERA}")
def era_params(spark, sf_dir):
    """Parameters of each epoch: a range join with a dimension of seven rows, then an equi-join by era."""
    eras = F.broadcast(slots.era_dimension(spark))
    rows = _epochs(spark, sf_dir).join(eras, (F.col("epoch_no") >= F.col("first_epoch")) & (F.col("end_epoch").isNull() | (F.col("epoch_no") < F.col("end_epoch"))))
    held = F.broadcast(parameters.era_parameters(spark))
    return rows.join(held, "era").select("epoch_no", "era", "key_deposit", "pool_deposit", "n_opt", "rho", "tau", "protocol_major", "max_block_size")


@query(_EPOCHS + f", t(first_epoch, name, workers, tx_batch) AS (VALUES {', '.join(str(t[:4]) for t in slots.TUNING)}) SELECT e.epoch_no, t.name, CAST(t.workers AS BIGINT) AS workers, least(greatest(t.workers * 2, 8), 24)::BIGINT AS clamped, CAST(t.tx_batch AS BIGINT) AS tx_batch FROM e JOIN t ON t.first_epoch = (SELECT max(first_epoch) FROM t t2 WHERE t2.first_epoch <= e.epoch_no)")
def era_tuning(spark, sf_dir):
    """Workers and batches of each epoch's bucket, and twice the workers between 8 and 24."""
    names = [t[1] for t in slots.TUNING]
    rows = spark.createDataFrame([(n, t[2], t[3]) for n, t in zip(names, slots.TUNING, strict=True)], "name string, workers long, tx_batch long")
    found = _epochs(spark, sf_dir).withColumn("name", slots.tuning_bucket(F.col("epoch_no"))).join(F.broadcast(rows), "name")
    return found.select("epoch_no", "name", "workers", F.least(F.greatest(F.col("workers") * 2, F.lit(8)), F.lit(24)).cast("long").alias("clamped"), "tx_batch")


@query("""SELECT l_linenumber AS block_type, count(*) AS n, CASE l_linenumber WHEN 0 THEN 'Byron' WHEN 1 THEN 'Byron' WHEN 2 THEN 'Shelley' WHEN 3 THEN 'Allegra' WHEN 4 THEN 'Mary'
 WHEN 5 THEN 'Alonzo' WHEN 6 THEN 'Babbage' WHEN 7 THEN 'Conway' ELSE 'Unknown' END AS era,
 CASE l_linenumber WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 4 WHEN 5 THEN 6 WHEN 6 THEN 8 WHEN 7 THEN 9 END AS protocol_major FROM lineitem GROUP BY 1""", views=False)
def block_type_eras(spark, sf_dir):
    rows = ledger.table(spark, sf_dir, "lineitem").groupBy(F.col("l_linenumber").alias("block_type")).agg(F.count(F.lit(1)).alias("n"))
    major = F.create_map(*[F.lit(x) for name, major, _ in slots.PROTOCOLS for x in (name, major)])
    return rows.withColumn("era", slots.era_of_block_type(F.col("block_type"))).withColumn("protocol_major", F.try_element_at(major, F.col("era")))


@query("""WITH a AS (SELECT DISTINCT l_linenumber AS attempt FROM lineitem) SELECT attempt, CAST(least(100 * pow(2e0, attempt), 5000e0) AS BIGINT) AS pause_ms,
CAST(least(5 * pow(2e0, attempt - 1), 120e0) AS BIGINT) AS reconnect_s, CAST(5 * attempt AS BIGINT) AS refetch_s FROM a""", views=False)
def backoff_schedule(spark, sf_dir):
    attempt = F.col("attempt")
    rows = ledger.table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("attempt")).distinct()
    return rows.select("attempt", slots.backoff_ms(attempt).alias("pause_ms"), slots.reconnect_seconds(attempt).alias("reconnect_s"), (attempt * 5).cast("long").alias("refetch_s"))
