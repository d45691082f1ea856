"""Validators: the reason why a value is refused, or null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed bounds and names.
POLICY_BYTES, NAME_BYTES, METADATA_BYTES, MOST_LOVELACE, BODY_BYTES = 28, 32, 16384, 45_000_000_000_000_000, 10 << 20
SCHEMES = ("http", "https")
CONTEXT = "https://github.com/cardano-foundation/CIPs/blob/master/CIP-0119/CIP-0119.jsonld"


def asset(policy: Column, name: Column) -> Column:
    return F.when(F.length(policy) != POLICY_BYTES, "a policy has 28 bytes").when(F.length(name) > NAME_BYTES, "a name has 32 bytes at most")


def withdrawal(amount: Column) -> Column:
    return F.when(amount <= 0, "nothing to withdraw").when(amount > MOST_LOVELACE, "more than there is")


def metadata(json: Column) -> Column:
    return F.when(F.octet_length(json) > METADATA_BYTES, "metadata over the limit")


def url(text: Column) -> Column:
    scheme = F.regexp_extract(text, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    host = F.regexp_extract(text, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)
    return F.when(~F.lower(scheme).isin(*SCHEMES), "scheme not allowed").when(host == "", "missing host")


def governance(json: Column) -> Column:
    """CIP-119 documents have a context that names it, and a type."""
    field = lambda path: F.get_json_object(json, path)
    return F.when(field("$['@context']").isNull(), "no context").when(field("$['@type']").isNull(), "no type").when(F.coalesce(field("$['@context'].CIP119"), F.lit("")) != CONTEXT, "other context")
