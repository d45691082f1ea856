"""Governance enumerations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed codes.
VOTER_ROLES = {0: "ConstitutionalCommittee", 1: "ConstitutionalCommittee", 2: "DRep", 3: "DRep", 4: "SPO"}
CHOICES = {0: "No", 1: "Yes", 2: "Abstain"}
PURPOSES = {0: "spend", 1: "mint", 2: "cert", 3: "reward"}


def _named(code: Column, names: dict[int, str]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(table, code.cast("int")), F.lit("Unknown"))


def voter_role(code: Column) -> Column:
    return _named(code, VOTER_ROLES)


def vote_choice(code: Column) -> Column:
    return _named(code, CHOICES)


def redeemer_purpose(code: Column) -> Column:
    return _named(code, PURPOSES)
