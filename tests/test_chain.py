import datetime
import hashlib
import struct
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from chainloom.functions import checks, hashes, messages, slots
from chainloom.operators import shred, sinks, utxo
from chainloom.sources import blocks as nested


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


@pytest.mark.parametrize("slot, epoch, time", [(0, 0, "2017-09-23 21:44:51"), (21600, 1, None), (4492799, 207, None), (4492800, 208, "2020-07-29 21:44:51"), (4924800, 209, None)])
def test_epoch_and_time_of_slot(spark, slot, epoch, time):
    s = F.lit(slot).cast("long")
    row = one(spark, e=slots.epoch_of_slot(s), t=slots.time_of_slot(s))
    assert row["e"] == epoch
    if time:
        assert row["t"] == datetime.datetime.fromisoformat(time)


@pytest.mark.parametrize("epoch, era", [(100, "byron"), (210, "shelley"), (240, "allegra"), (260, "mary"), (300, "alonzo"), (370, "babbage"), (490, "babbage"), (491, "conway")])
def test_era_of_epoch(spark, epoch, era):
    assert one(spark, e=slots.era_of_epoch(F.lit(epoch)))["e"] == era


def test_backoff(spark):
    got = [r[0] for r in spark.range(8).select(slots.backoff_ms(F.col("id"))).collect()]
    assert got == [100, 200, 400, 800, 1600, 3200, 5000, 5000]


@pytest.mark.parametrize("message, retried", [("driver: bad connection", True), ("read timeout", True), ("Error 1213: x", True), ("Deadlock", False), ("syntax error", False), ("Write conflict", True), (None, False)])
def test_retryable(spark, message, retried):
    assert one(spark, r=messages.is_retryable(F.lit(message).cast("string")))["r"] == retried


def test_content_keys(spark):
    tx, other = bytes(range(32)), bytes(28)
    row = one(spark, r=hashes.redeemer_key(F.lit(tx), F.lit("spend"), F.lit(258)), a=hashes.action_key(F.lit(tx), F.lit(1)), c=hashes.checkpoint_key(F.lit(300).cast("long"), F.lit(tx)), k=hashes.constitution_key(F.lit(tx), F.lit(None).cast("binary"), F.lit(other)), q=hashes.committee_key(F.lit(tx), F.lit(0.67)), b=F.hex(hashes.blake2b_224(F.lit(tx))))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert row["r"] == sha(tx + b"spend" + b"\0\0\1\2") and row["a"] == sha(tx + b"\0\0\0\1") and row["c"] == sha(struct.pack(">Q", 300) + tx)
    assert row["k"] == sha(tx + other) and row["q"] == sha(tx + struct.pack("<d", 0.67)) and row["b"] == hashlib.blake2b(tx, digest_size=28).hexdigest().upper()


def test_published_asset_fingerprint(spark):
    policy = bytes.fromhex("7eae28af2208be856f7a119668ae52a49b73725e326dc16579dcc373")
    assert one(spark, f=hashes.asset_fingerprint(F.lit(policy), F.lit(b"")))["f"] == "asset1rjklcrnsdzqp65wjgrg55sy9723kw09mlgvlc3"


def test_addresses(spark):
    raw, long = bytes([0x01, *range(1, 57)]), "x" * 2049
    row = one(spark, p=hashes.payment_credential(F.lit(raw)), s=hashes.stake_credential(F.lit(raw)), none=hashes.stake_credential(F.lit(bytes([0x81] * 57))), n=hashes.network_id(F.lit(raw)), a=hashes.normal_address(F.lit(long), F.lit(raw), F.lit(3)), h=hashes.normal_address(F.lit(long), F.lit(raw * 30), F.lit(3)), lost=hashes.normal_address(F.lit(None).cast("string"), F.lit(None).cast("binary"), F.lit(3)), z=hashes.previous_hash(F.lit(bytes(32))))
    assert bytes(row["p"]) == raw[1:29] and bytes(row["s"]) == raw[29:57] and row["none"] is None and row["n"] == 1
    assert row["a"] == "byron_long_" + raw.hex() and row["h"] == "byron_hash_" + hashlib.sha256(raw * 30).hexdigest() and row["lost"] == "invalid_address_3" and row["z"] is None


def test_validators(spark):
    good = '{"@context": {"CIP119": "%s"}, "@type": "x"}' % checks.CONTEXT
    row = one(spark, a=checks.governance(F.lit(good)), b=checks.governance(F.lit("{}")), c=checks.url(F.lit("ipfs://x")), d=checks.url(F.lit("https:///x")), e=checks.withdrawal(F.lit(0)))
    assert row["a"] is None and row["b"] == "no context" and row["c"] == "scheme not allowed" and row["d"] == "missing host" and row["e"] == "nothing to withdraw"


def h(n):
    return bytes([n] * 32)


def chain(spark):
    tx = {
        "hash": h(1), "fee": 1_000_000, "ttl": 0, "inputs": [(h(9), 0), (h(9), 1), (h(8), 0)], "outputs": [("a1", None, 1_000_000, None, None, {"aa" * 28: {"01": Decimal(5)}}), ("a2", None, 2_000_000, None, b"datum", None), ("a3", None, 3_000_000, None, None, None)],
        "metadata": {Decimal(721): '"NFT metadata"', Decimal(5): '"x"'}, "mint": {"bb" * 28 + ".02": -7}, "required_signers": [b"k" * 28], "scripts": [("plutusV2", b"s"), ("native", b"s")], "datums": [b"datum"], "redeemers": [(0, 1, b"r", 10, 20)],
        "withdrawals": {"stake1": 77}, "collateral": [(h(9), 2), (h(9), 2)], "reference_inputs": [(h(7), 0)],
    }
    names = ["hash", "size", "fee", "ttl", "validity_start", "is_valid", "total_collateral", "donation", "inputs", "outputs", "collateral", "reference_inputs", "collateral_return", "required_signers", "mint", "metadata", "certificates", "withdrawals", "scripts", "datums", "redeemers", "votes", "proposals"]
    cert = lambda kind, **more: tuple({"type": kind, **more}.get(k) for k in ("type", "credential", "pool", "epoch", "pledge", "cost", "margin", "reward_account", "owners", "relays", "metadata_url", "metadata_hash", "drep", "drep_hash", "hot", "anchor_url", "anchor_hash", "deposit", "pot", "other_pot"))
    tx["certificates"] = [cert(0, credential=b"c" * 28), cert(2, credential=b"c" * 28, pool=b"p" * 28), cert(3, pool=b"p" * 28, pledge=10**9, cost=340_000_000, margin=0.01, reward_account=b"\xe1" + b"r" * 28, owners=[b"o" * 28], relays=[(0, "1.2.3.4", None, None, 3001), (2, None, None, "srv.example", 5)], metadata_url="http://m", metadata_hash=h(3)), cert(4, pool=b"p" * 28, epoch=300), cert(9, credential=b"c" * 28, drep="abstain", drep_hash=b"d" * 28), cert(999)]
    tx["votes"] = [(2, b"d" * 28, h(5), 0, 1, "http://v", h(6)), (4, b"p" * 28, h(5), 0, 2, None, None)]
    proposal = lambda kind, **more: tuple({"type": kind, **more}.get(k) for k in ("type", "deposit", "anchor_url", "anchor_hash", "withdrawals", "members", "script_hash", "quorum", "parameters", "previous_tx", "previous_index"))
    tx["proposals"] = [proposal("TreasuryWithdrawal", deposit=5, withdrawals={"stake1": 9}), proposal("UpdateCommittee", members={"m": 600}), proposal("NewConstitution", anchor_url="http://v", anchor_hash=h(6))]
    rows = [(h(100), bytes(32), 5_000_000, 200_000, 7, None, 10, None, [tuple(tx.get(n) for n in names)]), (h(101), h(100), 5_000_020, 200_001, 0, b"i" * 32, 10, None, [])]
    return spark.createDataFrame(rows, nested.BLOCK)


def test_every_table_of_a_nested_block(spark):
    t = shred.shred(chain(spark))
    count = {name: frame.count() for name, frame in t.items()}
    expected = {"blocks": 2, "txes": 1, "tx_ins": 3, "tx_outs": 3, "ma_tx_outs": 1, "ma_tx_mints": 1, "multi_assets": 2, "tx_metadata": 2, "collateral_tx_ins": 1, "reference_tx_ins": 1, "collateral_tx_outs": 0, "required_signers": 1, "scripts": 1, "data": 1, "redeemers": 1, "withdrawals": 1, "stake_registrations": 1, "stake_deregistrations": 0, "delegations": 1, "pool_updates": 1, "pool_owners": 1, "pool_relays": 2, "pool_metadata_refs": 1, "pool_retires": 1, "drep_certificates": 0, "delegation_votes": 1, "voting_procedures": 2, "gov_action_proposals": 3, "param_proposals": 0, "treasury_withdrawals": 1, "committee_members": 1, "committees": 1, "constitutions": 1, "voting_anchors": 1, "committee_registrations": 0, "committee_deregistrations": 0, "treasuries": 0, "reserves": 0}
    assert count == expected
    tx = t["txes"].first()
    assert tx["fee"] == 1_000_000 and tx["out_sum"] == 6_000_000 and tx["invalid_hereafter"] is None
    assert [r["value"] for r in t["tx_outs"].orderBy("index").collect()] == [1_000_000, 2_000_000, 3_000_000]
    assert t["delegations"].first()["active_epoch_no"] == 211 and t["delegation_votes"].first()["drep_hash"] is None
    pool = t["pool_updates"].first()
    assert (pool["pledge"], pool["fixed_cost"], pool["margin"], bytes(pool["reward_addr_hash"])) == (10**9, 340_000_000, 0.01, b"r" * 28)
    assert [(r["index"], r["voter_role"], r["vote"]) for r in t["voting_procedures"].orderBy("index").collect()] == [(1, "DRep", "Yes"), (2, "SPO", "Abstain")]
    assert bytes(t["data"].first()["hash"]) == hashlib.blake2b(b"datum", digest_size=32).digest()
    assert {r["ipv4"] or r["dns_srv_name"] for r in t["pool_relays"].collect()} == {"1.2.3.4", "srv.example"}
    assert t["blocks"].where("slot_no = 5000000").first()["previous_hash"] is None


def test_labels_and_components_can_be_chosen(spark):
    t = shred.shred(chain(spark), only={"tx_metadata"}, labels=[721])
    assert list(t) == ["tx_metadata"] and [int(r["key"]) for r in t["tx_metadata"].collect()] == [721]


def test_writes_are_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "x"), (3, "z"), (3, "y"), (3, "y")], "k int, v string")
    added = sinks.insert_ignore(target, batch, ["k"])
    assert sorted(map(tuple, added.collect())) == [(3, "y")]
    again = sinks.insert_ignore(target.unionByName(added), batch, ["k"])
    assert again.count() == 0
    state = sinks.upsert_replace(target, batch, ["k"])
    assert sorted(map(tuple, state.collect())) == [(1, "a"), (2, "x"), (3, "y")] == sorted(map(tuple, sinks.upsert_replace(state, batch, ["k"]).collect()))


def test_rollback_follows_the_chain(spark):
    blocks = spark.createDataFrame([(10,), (20,)], "slot_no long")
    txes = spark.createDataFrame([(1, 10), (2, 20)], "tx_hash long, slot_no long")
    outs = spark.createDataFrame([(1, 5), (2, 6)], "tx_hash long, value long")
    left = sinks.rollback({"blocks": blocks, "txes": txes, "tx_outs": outs}, 15)
    assert [r["value"] for r in left["tx_outs"].collect()] == [5]


def test_utxo_changes_add_up(spark):
    outs = spark.createDataFrame([(1, 0, 7, 10), (2, 0, 8, 4)], "tx_hash long, idx long, address long, value long")
    ins = spark.createDataFrame([(2, 1, 0)], "tx_in_hash long, tx_out_hash long, tx_out_index long")
    txes = spark.createDataFrame([(1, 1), (2, 2)], "tx_hash long, epoch_no long")
    rows = utxo.changes_by_epoch(outs, ins, txes).orderBy("epoch_no").collect()
    assert [r["utxo_value"] for r in rows] == [10, 4]
    assert [r["value"] for r in utxo.unspent(outs, ins).collect()] == [4]


def test_tables_of_opened_blocks_are_the_same(spark):
    raw = chain(spark)
    opened = shred.flat(raw).persist()
    plain, again = shred.shred(raw), shred.shred(raw, opened=opened)
    assert list(plain) == list(again)
    for name in plain:
        assert plain[name].columns == again[name].columns
        assert sorted(map(str, plain[name].collect())) == sorted(map(str, again[name].collect())), name
    opened.unpersist()
