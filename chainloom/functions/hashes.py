"""Content hashes, credentials and addresses."""

from __future__ import annotations

import hashlib
import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

LONGEST_ADDRESS, LONGEST_COLLATERAL = 2048, 100


def big_endian(x: Column, size: int) -> Column:
    """A non-negative integer as bytes, most significant first."""
    return F.unhex(F.lpad(F.hex(x), 2 * size, "0"))


def content_key(*parts: Column) -> Column:
    """SHA-256 over the bytes of the parts that are not null, one after another."""
    return F.sha2(F.concat(*[F.coalesce(p, F.lit(b"")) for p in parts]), 256)


def redeemer_key(tx_hash: Column, purpose: Column, index: Column) -> Column:
    return content_key(tx_hash, F.encode(purpose, "UTF-8"), big_endian(index, 4))


def witness_key(tx_hash: Column, key_hash: Column) -> Column:
    return content_key(tx_hash, key_hash)


def action_key(tx_hash: Column, index: Column) -> Column:
    return content_key(tx_hash, big_endian(index, 4))


def anchor_key(url: Column, data_hash: Column) -> Column:
    return content_key(F.encode(url, "UTF-8"), data_hash)


def constitution_key(action: Column, anchor: Column, script: Column) -> Column:
    return content_key(action, anchor, script)


def author_key(vote_data: Column, name: Column, witness: Column) -> Column:
    return content_key(vote_data, F.encode(name, "UTF-8"), witness)


def checkpoint_key(slot: Column, block_hash: Column) -> Column:
    return content_key(big_endian(slot, 8), block_hash)


def committee_key(action: Column, quorum: Column) -> Column:
    """SHA-256 over an action's hash and its quorum as a little-endian double, which no built-in function gives."""

    def digest(action: pd.Series, quorum: pd.Series) -> pd.Series:
        return pd.Series([None if a is None else hashlib.sha256(bytes(a) + struct.pack("<d", q)).hexdigest() for a, q in zip(action, quorum, strict=True)])

    return F.pandas_udf(digest, "string")(action, quorum)


def blake2b(data: Column, size: int) -> Column:
    """BLAKE2b with a digest of ``size`` bytes, which Spark lacks."""

    def digest(data: pd.Series) -> pd.Series:
        return pd.Series([None if d is None else hashlib.blake2b(bytes(d), digest_size=size).digest() for d in data])

    return F.pandas_udf(digest, "binary")(data)


def blake2b_224(data: Column) -> Column:
    return blake2b(data, 28)


def blake2b_256(data: Column) -> Column:
    return blake2b(data, 32)


_BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"


def bech32(prefix: str, data: bytes) -> str:
    """BIP-173 encoding of bytes under a prefix."""
    bits = "".join(f"{b:08b}" for b in data)
    bits += "0" * (-len(bits) % 5)
    values = [int(bits[k : k + 5], 2) for k in range(0, len(bits), 5)]
    check = 1
    for v in [*(ord(c) >> 5 for c in prefix), 0, *(ord(c) & 31 for c in prefix), *values, *[0] * 6]:
        top = check >> 25
        check = (check & 0x1FFFFFF) << 5 ^ v
        for k, g in enumerate((0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)):
            check ^= g if top >> k & 1 else 0
    check ^= 1
    return prefix + "1" + "".join(_BECH32[v] for v in [*values, *(check >> 5 * (5 - k) & 31 for k in range(6))])


def asset_fingerprint(policy: Column, name: Column) -> Column:
    """CIP-14: BLAKE2b-160 over policy and name, in bech32 under "asset"."""

    def encode(policy: pd.Series, name: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else bech32("asset", hashlib.blake2b(bytes(p) + bytes(n or b""), digest_size=20).digest()) for p, n in zip(policy, name, strict=True)])

    return F.pandas_udf(encode, "string")(policy, name)


def payment_credential(raw: Column) -> Column:
    return F.when(F.length(raw) >= 29, F.substring(raw, 2, 28))


def _first_byte(raw: Column) -> Column:
    return F.conv(F.hex(F.substring(raw, 1, 1)), 16, 10).cast("int")


def stake_credential(raw: Column) -> Column:
    """Bytes 29 to 56 of base addresses, whose first four bits are 7 at most."""
    return F.when((F.length(raw) >= 57) & (F.shiftright(_first_byte(raw), 4) <= 7), F.substring(raw, 30, 28))


def network_id(raw: Column) -> Column:
    return _first_byte(raw).bitwiseAND(15)


def reward_account_hash(raw: Column) -> Column:
    return F.when(F.length(raw) >= 28, F.substring(raw, -28, 28))


def normal_address(address: Column, raw: Column, index: Column) -> Column:
    """An address that fits its column: its text, else its bytes in hex, else their hash; without either its place."""
    in_hex = F.concat(F.lit("byron_long_"), F.lower(F.hex(raw)))
    short = F.when(F.length(in_hex) <= LONGEST_ADDRESS, in_hex).otherwise(F.concat(F.lit("byron_hash_"), F.sha2(raw, 256)))
    long = F.coalesce(short, F.concat(F.lit("byron_toolong_"), F.length(address).cast("string"), F.lit("_"), index.cast("string")))
    lost = F.coalesce(F.concat(F.lit("byron_raw_"), F.lower(F.hex(raw))), F.concat(F.lit("invalid_address_"), index.cast("string")))
    return F.when(address.isNull(), lost).when(F.length(address) > LONGEST_ADDRESS, long).otherwise(address)


def collateral_address(address: Column, raw: Column) -> Column:
    return F.when(F.length(address) > LONGEST_COLLATERAL, F.concat(F.lit("byron_h_"), F.substring(F.sha2(raw, 256), 1, 16))).otherwise(address)


def previous_hash(hash_: Column) -> Column:
    """Null for a hash of zeros."""
    return F.when(F.hex(hash_).rlike("[^0]"), hash_)


def slot_leader(block_hash: Column, issuer: Column) -> Column:
    return F.substring(F.coalesce(issuer, block_hash), 1, 28)


def pseudo_id(hash_hex: Column) -> Column:
    """The first eight bytes as a signed number, without its sign; 0 for an empty hash."""
    signed = F.conv(F.substring(hash_hex, 1, 16), 16, -10).cast("long")
    return F.when(hash_hex == "", F.lit(0).cast("long")).otherwise(F.abs(signed))


def text_key(text: Column) -> Column:
    """h = 31 h + c over code points, modulo 2^64; a decimal, since Spark has no unsigned numbers."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    kind = "decimal(20,0)"
    return F.aggregate(chars, F.lit(0).cast(kind), lambda h, c: ((h * 31 + F.ascii(c)) % F.lit("18446744073709551616").cast("decimal(38,0)")).cast(kind))


def stake_address_text(credential: Column) -> Column:
    return F.concat(F.lit("stake1"), F.lower(F.hex(credential)))


def split_unit(unit: Column) -> tuple[Column, Column]:
    """Policy and name, both in hex, of "policy.name"; no name if there is no dot."""
    parts = F.split(unit, r"\.", 2)
    return F.get(parts, 0), F.coalesce(F.get(parts, 1), F.lit(""))
