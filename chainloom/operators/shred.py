"""Nested blocks to flat tables, one projection for each table.

Every table starts from the same nested rows, and each reads only the fields it needs: Parquet prunes the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chainloom.functions import hashes, slots, votes

# Fixed: certificate types by number.
REGISTRATION, DEREGISTRATION, DELEGATION, POOL_REGISTRATION, POOL_RETIREMENT, GENESIS, MOVE_REWARDS, REGISTRATION_2, DEREGISTRATION_2 = range(9)
VOTE_DELEGATION, STAKE_VOTE, STAKE_REGISTRATION, VOTE_REGISTRATION, STAKE_VOTE_REGISTRATION, COMMITTEE_HOT, COMMITTEE_RESIGN, DREP_REGISTRATION, DREP_DEREGISTRATION, DREP_UPDATE = range(9, 19)
# Fixed: the block type from which on a part of a transaction exists.
SHELLEY, MARY, ALONZO, BABBAGE, CONWAY = 2, 4, 5, 6, 7
DELEGATION_LAG = 2


def _positive(x: Column) -> Column:
    return F.when(x > 0, x)


def blocks(raw: DataFrame) -> DataFrame:
    return raw.select("hash", hashes.previous_hash(F.col("prev_hash")).alias("previous_hash"), F.col("slot").alias("slot_no"), "block_no", slots.epoch_of_slot(F.col("slot")).alias("epoch_no"), slots.time_of_slot(F.col("slot")).alias("time"), hashes.slot_leader(F.col("hash"), F.col("issuer_vkey")).alias("slot_leader_hash"), F.coalesce(F.size("txs"), F.lit(0)).alias("tx_count"), F.col("body_size").alias("size"), "block_type", slots.era_of_block_type(F.col("block_type")).alias("era"), "vrf_key")


def transactions(raw: DataFrame) -> DataFrame:
    """Transactions with their place in the block; a validity end only where a transaction has one."""
    rows = _opened(raw).withColumnRenamed("slot", "slot_no")
    out_sum = F.when(F.size("tx.outputs") > 0, F.aggregate("tx.outputs", F.lit(0).cast("long"), lambda s, o: s + o["amount"]))
    late = F.col("block_type") >= ALONZO
    return rows.select(F.col("tx.hash").alias("tx_hash"), "block_hash", "slot_no", "block_type", "block_index", F.col("tx.size").alias("size"), _positive(F.col("tx.fee")).alias("fee"), out_sum.alias("out_sum"), F.when(F.col("block_type") >= SHELLEY, _positive(F.col("tx.ttl"))).alias("invalid_hereafter"), F.when(F.col("block_type") > SHELLEY, _positive(F.col("tx.validity_start"))).alias("invalid_before"), F.when(late, F.coalesce("tx.is_valid", F.lit(True))).otherwise(True).alias("valid_contract"), F.when(late, _positive(F.col("tx.total_collateral"))).alias("total_collateral"), F.when(F.col("block_type") >= CONWAY, _positive(F.col("tx.donation"))).alias("treasury_donation"))


def flat(raw: DataFrame) -> DataFrame:
    """One row for each transaction with its fields as columns of their own: where many tables are made of one reading of
    the blocks, they are made of this, kept, and each reads the columns that it needs."""
    rows = _opened(raw)
    return rows.select("block_hash", "slot", "block_type", "block_index", *(F.col(f"tx.{f.name}").alias(f"tx_{f.name}") for f in rows.schema["tx"].dataType))


def _opened(raw: DataFrame) -> DataFrame:
    """block_hash, slot, block_type, block_index and tx of each transaction of blocks or of what ``flat`` made of them."""
    if "txs" in raw.columns:
        return raw.select(F.col("hash").alias("block_hash"), "slot", "block_type", F.posexplode("txs").alias("block_index", "tx"))
    fields = [c for c in raw.columns if c.startswith("tx_")]
    return raw.select("block_hash", "slot", "block_type", "block_index", F.struct(*(F.col(c).alias(c[3:]) for c in fields)).alias("tx"))


def _txs(raw: DataFrame, since: int = 0) -> DataFrame:
    return _opened(raw.where(F.col("block_type") >= since)).select("slot", "block_type", F.col("tx.hash").alias("tx_hash"), "tx")


def _inputs(raw: DataFrame, field: str, since: int = 0) -> DataFrame:
    rows = _txs(raw, since).select(F.col("tx_hash").alias("tx_in_hash"), F.posexplode(f"tx.{field}").alias("tx_in_index", "i"))
    return rows.select("tx_in_hash", "tx_in_index", F.col("i.tx_hash").alias("tx_out_hash"), F.col("i.index").alias("tx_out_index"))


def inputs(raw: DataFrame) -> DataFrame:
    return _inputs(raw, "inputs")


def _once(rows: DataFrame) -> DataFrame:
    """Each input of a transaction once, at the first of its places."""
    return rows.groupBy("tx_in_hash", "tx_out_hash", "tx_out_index").agg(F.min("tx_in_index").alias("tx_in_index")).select(*rows.columns)


def collateral_inputs(raw: DataFrame) -> DataFrame:
    return _once(_inputs(raw, "collateral", ALONZO))


def reference_inputs(raw: DataFrame) -> DataFrame:
    return _once(_inputs(raw, "reference_inputs", BABBAGE))


def outputs(raw: DataFrame) -> DataFrame:
    rows = _txs(raw).select("tx_hash", F.posexplode("tx.outputs").alias("index", "o"))
    raw_address = F.col("o.address_raw")
    datum = F.col("o.inline_datum")
    return rows.select("tx_hash", "index", hashes.normal_address(F.col("o.address"), raw_address, F.col("index")).alias("address"), raw_address.alias("address_raw"), F.col("o.amount").alias("value"), hashes.payment_credential(raw_address).alias("payment_cred"), hashes.stake_credential(raw_address).alias("stake_address_hash"), F.coalesce("o.datum_hash", hashes.blake2b_256(datum)).alias("data_hash"))


def output_assets(raw: DataFrame) -> DataFrame:
    """Quantities by output, policy and name: a map of maps exploded twice."""
    rows = _txs(raw, MARY).select("tx_hash", F.posexplode("tx.outputs").alias("tx_index", "o")).select("tx_hash", "tx_index", F.explode("o.assets").alias("policy", "names"))
    return rows.select("tx_hash", "tx_index", F.unhex("policy").alias("policy"), F.explode("names").alias("name", "quantity")).select("tx_hash", "tx_index", "policy", F.unhex("name").alias("name"), "quantity").where("quantity > 0")


def mints(raw: DataFrame) -> DataFrame:
    """Minted (positive) and burnt (negative) quantities of "policy.name" units."""
    rows = _txs(raw, MARY).select("tx_hash", F.explode("tx.mint").alias("unit", "quantity"))
    policy, name = hashes.split_unit(F.col("unit"))
    return rows.select("tx_hash", F.unhex(policy).alias("policy"), F.unhex(name).alias("name"), "quantity")


def multi_assets(raw: DataFrame) -> DataFrame:
    """Each asset ever sent or minted once, with its fingerprint."""
    seen = output_assets(raw).select("policy", "name").unionByName(mints(raw).select("policy", "name")).distinct()
    return seen.withColumn("fingerprint", hashes.asset_fingerprint("policy", "name"))


def metadata(raw: DataFrame, labels: list[int] | None = None) -> DataFrame:
    """Metadata entries; with labels, those only."""
    rows = _txs(raw).select("tx_hash", F.explode("tx.metadata").alias("key", "json"))
    return rows.where(F.col("key").isin(labels)) if labels else rows


def collateral_outputs(raw: DataFrame) -> DataFrame:
    rows = _txs(raw, BABBAGE).where("tx.collateral_return is not null").select("tx_hash", F.lit(0).alias("index"), F.col("tx.collateral_return").alias("o"))
    return rows.select("tx_hash", "index", hashes.collateral_address(F.col("o.address"), F.col("o.address_raw")).alias("address"), F.col("o.address_raw").alias("address_raw"), F.col("o.amount").alias("value"))


def collateral_assets(assets: DataFrame, outputs: DataFrame) -> DataFrame:
    """Asset rows (tx_hash, index, ...) to be written for collateral outputs: those whose output is there."""
    return assets.join(outputs.select("tx_hash", "index"), ["tx_hash", "index"], "left_semi")


def required_signers(raw: DataFrame) -> DataFrame:
    return _txs(raw, ALONZO).select("tx_hash", F.posexplode("tx.required_signers").alias("signer_index", "signer_hash"))


def scripts(raw: DataFrame) -> DataFrame:
    """Each witness script once, under BLAKE2b-224 of its bytes."""
    rows = _txs(raw).select("tx_hash", F.explode("tx.scripts").alias("s")).select(hashes.blake2b_224("s.bytes").alias("hash"), "tx_hash", F.col("s.type").alias("type"), F.col("s.bytes").alias("bytes"))
    first = Window.partitionBy("hash").orderBy("tx_hash", "type")
    return rows.withColumn("n", F.row_number().over(first)).where("n = 1").drop("n")


def datums(raw: DataFrame) -> DataFrame:
    """Witness and inline datums, each once, under BLAKE2b-256 of its bytes."""
    witness = _txs(raw, ALONZO).select("tx_hash", F.explode("tx.datums").alias("bytes"))
    inline = _txs(raw, BABBAGE).select("tx_hash", F.explode("tx.outputs").alias("o")).select("tx_hash", F.col("o.inline_datum").alias("bytes"))
    return witness.unionByName(inline).where("bytes is not null").groupBy("bytes").agg(F.min("tx_hash").alias("tx_hash")).select(hashes.blake2b_256("bytes").alias("hash"), "tx_hash", "bytes")


def redeemers(raw: DataFrame) -> DataFrame:
    rows = _txs(raw, ALONZO).select("tx_hash", F.explode("tx.redeemers").alias("r"))
    purpose = votes.redeemer_purpose(F.col("r.tag"))
    return rows.select(hashes.redeemer_key(F.col("tx_hash"), purpose, F.col("r.index")).alias("hash"), "tx_hash", purpose.alias("purpose"), F.col("r.index").alias("index"), hashes.blake2b_256("r.data").alias("data_hash"), F.col("r.mem").alias("unit_mem"), F.col("r.steps").alias("unit_steps"))


def withdrawals(raw: DataFrame) -> DataFrame:
    return _txs(raw, SHELLEY).select("tx_hash", F.explode("tx.withdrawals").alias("addr", "amount")).where("amount > 0")


def _certificates(raw: DataFrame, *types: int) -> DataFrame:
    rows = _txs(raw, SHELLEY).select("slot", "tx_hash", F.posexplode("tx.certificates").alias("cert_index", "c"))
    return rows.where(F.col("c.type").isin(*types))


def stake_registrations(raw: DataFrame) -> DataFrame:
    return _certificates(raw, REGISTRATION, REGISTRATION_2, STAKE_REGISTRATION, VOTE_REGISTRATION, STAKE_VOTE_REGISTRATION).select("tx_hash", "cert_index", F.col("c.credential").alias("addr_hash"), slots.epoch_of_slot(F.col("slot")).alias("epoch_no"))


def stake_deregistrations(raw: DataFrame) -> DataFrame:
    return _certificates(raw, DEREGISTRATION, DEREGISTRATION_2).select("tx_hash", "cert_index", F.col("c.credential").alias("addr_hash"), slots.epoch_of_slot(F.col("slot")).alias("epoch_no"))


def delegations(raw: DataFrame) -> DataFrame:
    """Delegations to pools, in force two epochs later."""
    rows = _certificates(raw, DELEGATION, STAKE_VOTE, STAKE_REGISTRATION, STAKE_VOTE_REGISTRATION)
    return rows.select("tx_hash", "cert_index", F.col("c.credential").alias("addr_hash"), F.col("c.pool").alias("pool_hash"), F.col("slot").alias("slot_no"), (slots.epoch_of_slot(F.col("slot")) + DELEGATION_LAG).alias("active_epoch_no"))


def pool_updates(raw: DataFrame) -> DataFrame:
    rows = _certificates(raw, POOL_REGISTRATION)
    return rows.select("tx_hash", "cert_index", F.col("c.pool").alias("pool_hash"), F.col("c.pledge").alias("pledge"), F.col("c.cost").alias("fixed_cost"), F.col("c.margin").alias("margin"), hashes.reward_account_hash(F.col("c.reward_account")).alias("reward_addr_hash"), F.col("c.metadata_hash").alias("meta_hash"), (slots.epoch_of_slot(F.col("slot")) + DELEGATION_LAG).alias("active_epoch_no"))


def pool_owners(raw: DataFrame) -> DataFrame:
    return _certificates(raw, POOL_REGISTRATION).select("tx_hash", "cert_index", F.col("c.pool").alias("pool_hash"), F.posexplode("c.owners").alias("owner_index", "addr_hash"))


def pool_relays(raw: DataFrame) -> DataFrame:
    """Relays by kind: 0 an address, 1 a host with a port, 2 a host whose record names the port."""
    rows = _certificates(raw, POOL_REGISTRATION).select("tx_hash", "cert_index", F.posexplode("c.relays").alias("relay_index", "r"))
    return rows.select("tx_hash", "cert_index", "relay_index", F.when(F.col("r.type") == 0, F.col("r.ipv4")).alias("ipv4"), F.when(F.col("r.type") == 0, F.col("r.ipv6")).alias("ipv6"), F.when(F.col("r.type") == 1, F.col("r.hostname")).alias("dns_name"), F.when(F.col("r.type") == 2, F.col("r.hostname")).alias("dns_srv_name"), F.when(F.col("r.type") != 2, F.col("r.port")).alias("port"))


def pool_metadata_refs(raw: DataFrame) -> DataFrame:
    rows = _certificates(raw, POOL_REGISTRATION).where("c.metadata_hash is not null")
    return rows.groupBy(F.col("c.metadata_hash").alias("hash")).agg(F.min(F.struct("slot", "tx_hash", "c.pool", "c.metadata_url")).alias("m")).select("hash", F.col("m.pool").alias("pool_hash"), F.col("m.metadata_url").alias("url"), F.col("m.tx_hash").alias("registered_tx_hash"))


def pool_retirements(raw: DataFrame) -> DataFrame:
    return _certificates(raw, POOL_RETIREMENT).select("tx_hash", "cert_index", F.col("c.pool").alias("pool_hash"), F.col("c.epoch").alias("retiring_epoch"))


def pot_transfers(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Moves between pots, out of the treasury (source 2) and out of the reserves."""
    rows = _certificates(raw, MOVE_REWARDS).where("c.other_pot > 0").select("tx_hash", "cert_index", F.col("c.pot").alias("pot"), F.col("c.other_pot").alias("amount"))
    return rows.where("pot = 2").drop("pot"), rows.where("pot <> 2").drop("pot")


def drep_certificates(raw: DataFrame) -> DataFrame:
    """Registrations, updates (deposit null) and deregistrations (deposit negative) of representatives."""
    rows = _certificates(raw, DREP_REGISTRATION, DREP_DEREGISTRATION, DREP_UPDATE)
    deposit = F.when(F.col("c.type") == DREP_REGISTRATION, F.col("c.deposit")).when(F.col("c.type") == DREP_DEREGISTRATION, -F.col("c.deposit"))
    return rows.select("tx_hash", "cert_index", F.col("c.credential").alias("drep_hash"), deposit.alias("deposit"), F.when(F.col("c.anchor_url").isNotNull(), hashes.anchor_key(F.col("c.anchor_url"), F.col("c.anchor_hash"))).alias("voting_anchor_hash"))


def drep_delegations(raw: DataFrame) -> DataFrame:
    """Votes delegated to a representative; abstaining and lack of confidence have no hash."""
    rows = _certificates(raw, VOTE_DELEGATION, STAKE_VOTE, VOTE_REGISTRATION, STAKE_VOTE_REGISTRATION)
    hash_ = F.when(F.coalesce("c.drep", F.lit("")).isin("abstain", "no_confidence"), F.lit(None)).otherwise(F.col("c.drep_hash"))
    return rows.select("tx_hash", "cert_index", F.col("c.credential").alias("addr_hash"), F.coalesce("c.drep", F.lit("key")).alias("view"), hash_.alias("drep_hash"))


def committee_certificates(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Authorised hot keys, and resignations."""
    hot = _certificates(raw, COMMITTEE_HOT).select("tx_hash", "cert_index", F.col("c.credential").alias("cold_key"), F.col("c.hot").alias("hot_key"))
    gone = _certificates(raw, COMMITTEE_RESIGN).select("tx_hash", "cert_index", F.col("c.credential").alias("cold_key"), F.when(F.col("c.anchor_url").isNotNull(), hashes.anchor_key(F.col("c.anchor_url"), F.col("c.anchor_hash"))).alias("voting_anchor_hash"))
    return hot, gone


def voting_procedures(raw: DataFrame) -> DataFrame:
    """Votes, numbered from 1 within a transaction, with the voter in the column of its role."""
    rows = _txs(raw, CONWAY).select("tx_hash", F.posexplode("tx.votes").alias("n", "v"))
    role = votes.voter_role(F.col("v.voter_type"))
    number = F.row_number().over(Window.partitionBy("tx_hash").orderBy("n"))
    voter = lambda name: F.when(role == name, F.col("v.voter"))
    return rows.select("tx_hash", number.alias("index"), role.alias("voter_role"), voter("ConstitutionalCommittee").alias("committee_voter"), voter("DRep").alias("drep_voter"), voter("SPO").alias("pool_voter"), hashes.action_key(F.col("v.action_tx"), F.col("v.action_index")).alias("gov_action_hash"), votes.vote_choice(F.col("v.vote")).alias("vote"), F.when(F.col("v.anchor_url").isNotNull(), hashes.anchor_key(F.col("v.anchor_url"), F.col("v.anchor_hash"))).alias("voting_anchor_hash"))


def _proposals(raw: DataFrame) -> DataFrame:
    rows = _txs(raw, CONWAY).select("slot", "tx_hash", F.posexplode("tx.proposals").alias("index", "p"))
    return rows.withColumn("hash", hashes.action_key(F.col("tx_hash"), F.col("index")))


def proposals(raw: DataFrame) -> DataFrame:
    return _proposals(raw).select("hash", "tx_hash", "index", F.col("p.type").alias("type"), F.col("p.deposit").alias("deposit"), F.col("p.previous_tx").alias("prev_gov_action_tx_hash"), F.col("p.previous_index").alias("prev_gov_action_index"), F.when(F.col("p.anchor_url").isNotNull(), hashes.anchor_key(F.col("p.anchor_url"), F.col("p.anchor_hash"))).alias("voting_anchor_hash"))


def parameter_proposals(raw: DataFrame) -> DataFrame:
    rows = _proposals(raw).where("p.type = 'ParameterChange'").select("hash", F.explode("p.parameters").alias("parameter", "value"))
    return rows


def treasury_withdrawals(raw: DataFrame) -> DataFrame:
    return _proposals(raw).where("p.type = 'TreasuryWithdrawal'").select(F.col("hash").alias("gov_action_hash"), F.explode("p.withdrawals").alias("addr", "amount"))


def committee_members(raw: DataFrame) -> DataFrame:
    """Members of proposed committees, from the proposal's epoch on."""
    return _proposals(raw).where("p.type = 'UpdateCommittee'").select(F.col("hash").alias("gov_action_hash"), slots.epoch_of_slot(F.col("slot")).alias("from_epoch"), F.explode("p.members").alias("member", "until_epoch"))


def committees(raw: DataFrame, quorum: float = 0.67) -> DataFrame:
    rows = _proposals(raw).where("p.type = 'UpdateCommittee'").withColumn("quorum", F.coalesce("p.quorum", F.lit(quorum)))
    return rows.select(hashes.committee_key(F.unhex("hash"), "quorum").alias("hash"), F.col("hash").alias("gov_action_hash"), "quorum")


def constitutions(raw: DataFrame) -> DataFrame:
    rows = _proposals(raw).where("p.type = 'NewConstitution'")
    anchor = F.when(F.col("p.anchor_url").isNotNull(), hashes.anchor_key(F.col("p.anchor_url"), F.col("p.anchor_hash")))
    return rows.select(hashes.constitution_key(F.unhex("hash"), F.unhex(anchor), F.col("p.script_hash")).alias("hash"), F.col("hash").alias("gov_action_hash"), anchor.alias("voting_anchor_hash"), F.col("p.script_hash").alias("script_hash"))


def voting_anchors(raw: DataFrame) -> DataFrame:
    """Each anchor of votes, proposals and certificates once."""
    anchor = lambda c: (F.col(f"{c}.anchor_url").alias("url"), F.col(f"{c}.anchor_hash").alias("data_hash"))
    txs = _txs(raw, SHELLEY)
    found = None
    for field in ("votes", "proposals", "certificates"):
        part = txs.select(F.explode(f"tx.{field}").alias("x")).select(*anchor("x"))
        found = part if found is None else found.unionByName(part)
    return found.where("url is not null").distinct().withColumn("hash", hashes.anchor_key(F.col("url"), F.col("data_hash")))


TABLES = {
    "blocks": blocks, "txes": transactions, "tx_ins": inputs, "tx_outs": outputs, "ma_tx_outs": output_assets, "ma_tx_mints": mints, "multi_assets": multi_assets, "tx_metadata": metadata,
    "collateral_tx_ins": collateral_inputs, "reference_tx_ins": reference_inputs, "collateral_tx_outs": collateral_outputs, "required_signers": required_signers, "scripts": scripts, "data": datums,
    "redeemers": redeemers, "withdrawals": withdrawals, "stake_registrations": stake_registrations, "stake_deregistrations": stake_deregistrations, "delegations": delegations,
    "pool_updates": pool_updates, "pool_owners": pool_owners, "pool_relays": pool_relays, "pool_metadata_refs": pool_metadata_refs, "pool_retires": pool_retirements,
    "drep_certificates": drep_certificates, "delegation_votes": drep_delegations, "voting_procedures": voting_procedures, "gov_action_proposals": proposals, "param_proposals": parameter_proposals,
    "treasury_withdrawals": treasury_withdrawals, "committee_members": committee_members, "committees": committees, "constitutions": constitutions, "voting_anchors": voting_anchors,
}


#: Tables that are made together with another one, by the name that asks for both.
PARTS = {"committee_deregistrations": "committee_registrations", "reserves": "treasuries"}


def shred(raw: DataFrame, only: set[str] | None = None, labels: list[int] | None = None, opened: DataFrame | None = None) -> dict[str, DataFrame]:
    """All tables of the blocks, or those named; a table that is not asked for is not planned at all.

    ``opened`` is what ``flat`` has made of the same blocks, if that is kept: then only ``blocks`` reads them again.
    """
    out = {"blocks": blocks(raw)} if only is None or "blocks" in only else {}
    raw = raw if opened is None else opened
    out |= {name: build(raw) for name, build in TABLES.items() if (only is None or name in only) and name not in ("tx_metadata", "blocks")}
    if only is None or "tx_metadata" in only:
        out["tx_metadata"] = metadata(raw, labels)
    if only is None or "committee_registrations" in only:
        out["committee_registrations"], out["committee_deregistrations"] = committee_certificates(raw)
    if only is None or "treasuries" in only:
        out["treasuries"], out["reserves"] = pot_transfers(raw)
    return out
