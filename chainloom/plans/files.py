"""Queries of write semantics, content keys, addresses, validators, off-chain documents and nested blocks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chainloom import folders
from chainloom.functions import checks, hashes, votes
from chainloom.operators import existence, offchain, shred, sinks
from chainloom.plans.register import query
from chainloom.sources import blocks as nested
from chainloom.sources import ledger

_LINE = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_quantity > 25, {_LINE}) AS n FROM lineitem) WHERE n = 1""", views=False)
def insert_ignore(spark, sf_dir):
    """A table of small lines, and a batch of large ones of which only new keys are added."""
    items = ledger.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long").alias("quantity"), "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    keys = ["l_orderkey", "l_linenumber"]
    held = sinks.first_of_key(items.where("l_quantity <= 25"), keys)
    added = sinks.insert_ignore(held, items.where("l_quantity > 25"), keys)
    return held.unionByName(added).select(*keys, "l_partkey", "l_suppkey", "quantity")


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_quantity > 25, {_LINE}) AS n FROM lineitem) WHERE n = 1""", views=False)
def insert_by_filter(spark, sf_dir):
    """The same batch with a filter of the stored keys beside the table: keys that it does not know need no look-up."""
    items = ledger.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long").alias("quantity"), "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    keys = ["l_orderkey", "l_linenumber"]
    where = folders.new(spark, "filtered")
    sinks.first_of_key(items.where("l_quantity <= 25"), keys).write.parquet(f"{where}/table")
    held = spark.read.schema(items.schema).parquet(f"{where}/table")
    bits = existence.bits_for(held.count())
    existence.build(held, keys, bits).write.parquet(f"{where}/filter")
    added = existence.insert_ignore(held, items.where("l_quantity > 25"), keys, spark.read.schema("page long, bits binary").parquet(f"{where}/filter"), bits)
    return held.unionByName(added).select(*keys, "l_partkey", "l_suppkey", "quantity")


@query("""SELECT s_suppkey AS pool, CASE WHEN s_suppkey % 3 = 0 THEN -1 ELSE CAST(round(s_acctbal * 100) AS BIGINT) END AS balance FROM supplier UNION ALL SELECT -5, -1""", views=False)
def upsert_replace(spark, sf_dir):
    held = ledger.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pool"), ledger.cents("s_acctbal").alias("balance"))
    fresh = held.where("pool % 3 = 0").select("pool").unionByName(spark.range(1).select((F.col("id") - 5).alias("pool"))).withColumn("balance", F.lit(-1).cast("long"))
    return sinks.upsert_replace(held, fresh, ["pool"])


@query("SELECT DISTINCT l_suppkey AS pool FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0)", views=False)
def get_or_create_dim(spark, sf_dir):
    held = ledger.table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("pool"))
    return sinks.get_or_create(held, ledger.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("pool")), "pool")


@query("SELECT s_suppkey AS pool, CASE WHEN s_suppkey % 4 = 1 THEN 'new' ELSE s_name END AS name FROM supplier", views=False)
def update_one_column(spark, sf_dir):
    held = ledger.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pool"), F.col("s_name").alias("name"))
    return sinks.update_column(held, held.where("pool % 4 = 1").withColumn("name", F.lit("new")), ["pool"], "name")


_BACK = 180_000_000


@query(f"""WITH b AS (SELECT * FROM blocks WHERE slot_no <= {_BACK}), t AS (SELECT * FROM txes WHERE slot_no IN (SELECT slot_no FROM b))
SELECT 'blocks' AS name, count(*) AS n FROM b UNION ALL SELECT 'txes', count(*) FROM t UNION ALL SELECT 'tx_outs', count(*) FROM tx_outs WHERE tx_hash IN (SELECT tx_hash FROM t)
UNION ALL SELECT 'tx_ins', count(*) FROM tx_ins WHERE tx_in_hash IN (SELECT tx_hash FROM t) UNION ALL SELECT 'withdrawals', count(*) FROM withdrawals WHERE tx_hash IN (SELECT tx_hash FROM t)""")
def rollback_delete(spark, sf_dir):
    items = ledger.table(spark, sf_dir, "lineitem")
    tables = {"blocks": ledger.blocks(spark, sf_dir), "txes": ledger.txes(spark, sf_dir), "tx_outs": items.select(F.col("l_orderkey").alias("tx_hash")), "tx_ins": items.where("l_returnflag = 'R'").select((F.col("l_orderkey") + 1).alias("tx_in_hash")), "withdrawals": ledger.withdrawals(spark, sf_dir)}
    out = None
    for name, rows in sinks.rollback(tables, _BACK).items():
        one = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("""WITH f AS (SELECT DISTINCT doc_id FROM labels), e AS (SELECT user_id AS doc_id, count(*) // 20 AS retry_count FROM events GROUP BY 1)
SELECT d.doc_id, coalesce(e.retry_count, 0) AS retry_count FROM documents d LEFT JOIN e USING (doc_id) WHERE d.doc_id NOT IN (SELECT doc_id FROM f) AND coalesce(e.retry_count, 0) < 3
ORDER BY doc_id LIMIT 100""", views=False)
def unfetched_queue(spark, sf_dir):
    failures = ledger.table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("doc_id")).agg(F.floor(F.count(F.lit(1)) / 20).cast("long").alias("retry_count"))
    refs = ledger.table(spark, sf_dir, "documents").select("doc_id")
    return offchain.unfetched(refs, ledger.table(spark, sf_dir, "labels"), failures, "doc_id")


@query("""SELECT doc_id, sha256(text) AS hash, sha256(text) = CASE WHEN doc_id % 3 = 0 THEN sha256('other') ELSE sha256(text) END AS valid FROM documents""", views=False)
def content_hash_verify(spark, sf_dir):
    docs = ledger.table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("hash", F.sha2("text", 256)).withColumn("expected", F.when(F.col("doc_id") % 3 == 0, F.sha2(F.lit("other"), 256)).otherwise(F.upper("hash")))
    return offchain.verified(docs, "text", "expected").select("doc_id", "hash", "valid")


_HASH32 = "unhex(lpad(to_hex(o_orderkey), 64, '0'))"


@query(f"""SELECT o_orderkey AS tx_hash, sha256({_HASH32} || encode('spend') || unhex(lpad(to_hex(o_custkey), 8, '0'))) AS redeemer, sha256({_HASH32} || unhex(lpad(to_hex(o_custkey), 8, '0'))) AS action,
sha256(encode('http://x/' || o_custkey) || {_HASH32}) AS anchor, sha256(unhex(lpad(to_hex(o_custkey), 16, '0')) || {_HASH32}) AS checkpoint, sha256({_HASH32} || {_HASH32}) AS witness FROM orders""", views=False)
def composite_keys(spark, sf_dir):
    rows = ledger.table(spark, sf_dir, "orders")
    tx, index = nested.tx_hash(F.col("o_orderkey")), F.col("o_custkey")
    url = F.concat(F.lit("http://x/"), index.cast("string"))
    return rows.select(F.col("o_orderkey").alias("tx_hash"), hashes.redeemer_key(tx, F.lit("spend"), index).alias("redeemer"), hashes.action_key(tx, index).alias("action"), hashes.anchor_key(url, tx).alias("anchor"), hashes.checkpoint_key(index, tx).alias("checkpoint"), hashes.witness_key(tx, tx).alias("witness"))


_RAW = "sha256(text) || sha256(text || 'x')"


@query(f"""WITH a AS (SELECT doc_id, text, upper({_RAW}) AS h FROM documents) SELECT doc_id, substr(h, 3, 56) AS payment, CASE WHEN substr(h, 1, 1) <= '7' THEN substr(h, 59, 56) END AS stake,
CAST(strpos('0123456789ABCDEF', substr(h, 2, 1)) - 1 AS INTEGER) AS network, substr(h, 73, 56) AS reward, 'stake1' || lower(substr(h, 3, 56)) AS stake_text,
CASE WHEN length(text) > 2048 THEN 'byron_hash_' || sha256(text) ELSE text END AS address FROM a""", views=False)
def address_normalise(spark, sf_dir):
    docs = ledger.table(spark, sf_dir, "documents")
    raw = F.unhex(F.concat(F.sha2("text", 256), F.sha2(F.concat("text", F.lit("x")), 256)))
    named = hashes.normal_address(F.col("text"), F.encode("text", "UTF-8"), F.lit(0))
    return docs.select("doc_id", F.hex(hashes.payment_credential(raw)).alias("payment"), F.hex(hashes.stake_credential(raw)).alias("stake"), hashes.network_id(raw).alias("network"), F.hex(hashes.reward_account_hash(raw)).alias("reward"), hashes.stake_address_text(hashes.payment_credential(raw)).alias("stake_text"), named.alias("address"))


@query("""WITH u AS (SELECT c_custkey, to_hex(c_custkey + 4096) || CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '.' || hex(encode(c_name)) END AS unit FROM customer)
SELECT c_custkey, split_part(unit, '.', 1) AS policy, split_part(unit, '.', 2) AS name, decode(unhex(split_part(unit, '.', 2))) AS text FROM u""", views=False)
def hex_split(spark, sf_dir):
    unit = F.concat(F.hex(F.col("c_custkey") + 4096), F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.concat(F.lit("."), F.hex(F.encode("c_name", "UTF-8")))))
    policy, name = hashes.split_unit(unit)
    return ledger.table(spark, sf_dir, "customer").select("c_custkey", policy.alias("policy"), name.alias("name"), F.decode(F.unhex(name), "UTF-8").alias("text"))


@query("""SELECT doc_id, CASE WHEN u >= 9223372036854775808 THEN CAST(18446744073709551616 - u AS BIGINT) ELSE CAST(u AS BIGINT) END AS id,
CAST(list_reduce(list_prepend(0::HUGEINT, list_transform(range(1, length(lang) + 1), lambda i: unicode(substr(lang, CAST(i AS BIGINT), 1))::HUGEINT)), lambda h, c: (h * 31 + c) % 18446744073709551616) AS BIGINT) AS key
FROM (SELECT doc_id, lang, CAST('0x' || substr(sha256(text), 1, 16) AS UBIGINT)::HUGEINT AS u FROM documents)""", views=False)
def numeric_ids(spark, sf_dir):
    docs = ledger.table(spark, sf_dir, "documents")
    return docs.select("doc_id", hashes.pseudo_id(F.sha2("text", 256)).alias("id"), hashes.text_key(F.col("lang")).cast("long").alias("key"))


@query("""SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'scheme not allowed' WHEN page_id % 4 = 1 THEN 'missing host' END AS url, CASE WHEN strlen(html) > 16384 THEN 'metadata over the limit' END AS metadata,
CASE WHEN page_id % 9 = 0 THEN 'nothing to withdraw' WHEN page_id % 9 = 1 THEN 'more than there is' END AS withdrawal,
CASE WHEN page_id % 3 = 0 THEN 'a policy has 28 bytes' WHEN page_id % 5 = 0 THEN 'a name has 32 bytes at most' END AS asset FROM pages""", views=False)
def validators(spark, sf_dir):
    page = F.col("page_id")
    url = F.when(page % 4 == 0, F.concat(F.lit("ftp"), F.expr("substr(url, 5)"))).when(page % 4 == 1, "http:///nowhere").otherwise(F.col("url"))
    amount = F.when(page % 9 == 0, F.lit(0)).when(page % 9 == 1, F.lit(checks.MOST_LOVELACE + 1)).otherwise(page)
    policy = F.unhex(F.expr("repeat('ab', if(page_id % 3 = 0, 27, 28))"))
    name = F.unhex(F.expr("repeat('cd', if(page_id % 5 = 0, 33, 32))"))
    return ledger.table(spark, sf_dir, "pages").select("page_id", checks.url(url).alias("url"), checks.metadata(F.col("html")).alias("metadata"), checks.withdrawal(amount).alias("withdrawal"), checks.asset(policy, name).alias("asset"))


@query("""SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS number, CASE turn % 6 WHEN 0 THEN 'ConstitutionalCommittee' WHEN 1 THEN 'ConstitutionalCommittee' WHEN 2 THEN 'DRep'
WHEN 3 THEN 'DRep' WHEN 4 THEN 'SPO' ELSE 'Unknown' END AS role, CASE turn % 4 WHEN 0 THEN 'No' WHEN 1 THEN 'Yes' WHEN 2 THEN 'Abstain' ELSE 'Unknown' END AS vote FROM conversations""", views=False)
def vote_index(spark, sf_dir):
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).cast("long")
    return ledger.table(spark, sf_dir, "conversations").select("conv_id", "turn", number.alias("number"), votes.voter_role(F.col("turn") % 6).alias("role"), votes.vote_choice(F.col("turn") % 4).alias("vote"))


@query("""SELECT conv_id, turn, 'Vote' AS type, 'en' AS language, text AS title, role AS author, CASE WHEN turn % 2 = 0 THEN NULL ELSE 'other context' END AS reason FROM conversations""", views=False)
def governance_json(spark, sf_dir):
    """Documents written as JSON and parsed again: fields, the first author, and the validator's reason."""
    rows = ledger.table(spark, sf_dir, "conversations")
    context = F.when(F.col("turn") % 2 == 0, checks.CONTEXT).otherwise("http://elsewhere")
    json = F.to_json(F.struct(F.struct(context.alias("CIP119"), F.lit("en").alias("@language")).alias("@context"), F.lit("Vote").alias("@type"), F.array(F.struct(F.col("role").alias("name"))).alias("authors"), F.struct(F.col("text").alias("title")).alias("body")))
    docs = rows.select(F.struct("conv_id", "turn").alias("id"), json.alias("json"), checks.governance(json).alias("reason"))
    parsed = offchain.governance_documents(docs, "json", "id")
    authors = parsed["authors"].where("n = 0").select("id", F.col("name").alias("author"))
    return parsed["documents"].join(authors, "id").join(docs.select("id", "reason"), "id").select("id.conv_id", "id.turn", "type", "language", "title", "author", "reason")


def _number(hash_: str) -> F.Column:
    """An order's key out of its transaction's hash."""
    return F.conv(F.hex(hash_), 16, 10).cast("long")


@query("SELECT tx_hash, idx, CAST(address AS VARCHAR) AS address, value FROM tx_outs WHERE tx_hash IN (SELECT tx_hash FROM txes)")
def shred_outputs(spark, sf_dir):
    """Outputs of nested blocks, flat again."""
    rows = shred.outputs(nested.stored_opened(spark, sf_dir))
    return rows.select(_number("tx_hash").alias("tx_hash"), F.col("index").cast("long").alias("idx"), "address", "value")


@query("SELECT tx_in_hash, tx_out_hash, tx_out_index FROM tx_ins WHERE tx_in_hash IN (SELECT tx_hash FROM txes)")
def shred_inputs(spark, sf_dir):
    rows = shred.inputs(nested.stored_opened(spark, sf_dir))
    return rows.select(_number("tx_in_hash").alias("tx_in_hash"), _number("tx_out_hash").alias("tx_out_hash"), F.col("tx_out_index").cast("long").alias("tx_out_index"))


@query("SELECT tx_hash, CAST(addr AS VARCHAR) AS addr, amount FROM withdrawals")
def shred_withdrawals(spark, sf_dir):
    """Withdrawals of all blocks, those of the first era too, which the ledger's own table leaves out."""
    rows = nested.stored_opened(spark, sf_dir, items=False)
    return rows.select(_number("tx_hash").alias("tx_hash"), F.explode("tx_withdrawals").alias("addr", "amount"))


@query()
def blake2b_ids(spark, sf_dir):
    data = F.encode("text", "UTF-8")
    return ledger.table(spark, sf_dir, "documents").select("doc_id", F.hex(hashes.blake2b_256(data)).alias("datum_hash"), F.hex(hashes.blake2b_224(data)).alias("script_hash"))


@query()
def asset_fingerprint(spark, sf_dir):
    policy = F.substring(F.unhex(F.sha2(F.col("p_brand"), 256)), 1, 28)
    return ledger.table(spark, sf_dir, "part").select("p_partkey", hashes.asset_fingerprint(policy, F.encode("p_name", "UTF-8")).alias("fingerprint"))


@query("""SELECT lower(lpad(to_hex(l_orderkey), 64, '0')) AS tx_hash, l_linenumber - 1 AS index, l_partkey AS asset, count(*) AS n FROM lineitem
WHERE l_linenumber = 1 AND l_orderkey IN (SELECT o_orderkey FROM orders) AND l_orderkey % 4 = 0 AND l_orderkey // 64 % 8 >= 6 GROUP BY ALL""", views=False)
def collateral_assets(spark, sf_dir):
    """Assets of collateral outputs, each looked up before it is written; lines are the claims."""
    claims = ledger.table(spark, sf_dir, "lineitem").select(nested.tx_hash(F.col("l_orderkey")).alias("tx_hash"), (F.col("l_linenumber") - 1).alias("index"), F.col("l_partkey").alias("asset"))
    outputs = shred.collateral_outputs(nested.stored_opened(spark, sf_dir, items=False))
    found = shred.collateral_assets(claims, outputs).groupBy("tx_hash", "index", "asset").agg(F.count(F.lit(1)).alias("n"))
    return found.withColumn("tx_hash", F.lower(F.hex("tx_hash")))


@query("SELECT p_partkey AS id, substr(p_name, 1, 5) AS ticker, p_brand AS name, CAST(NULL AS VARCHAR) AS description, 'http://part/' || p_partkey AS homepage FROM part", views=False)
def pool_documents(spark, sf_dir):
    """Off-chain documents of pools, here of parts: the ticker cut to five bytes, and the other fields."""
    parts = ledger.table(spark, sf_dir, "part")
    json = F.to_json(F.struct(F.col("p_name").alias("ticker"), F.col("p_brand").alias("name"), F.concat(F.lit("http://part/"), F.col("p_partkey")).alias("homepage")))
    return offchain.pool_documents(parts.select(F.col("p_partkey").alias("id"), json.alias("json")), "json", "id")
