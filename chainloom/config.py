"""Settings of an ingestion run: TOML file, environment overrides, validation, and what follows from them."""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass, field, fields
from pathlib import Path

from chainloom.functions.slots import TUNING

PREFIX = "CHAINLOOM_"
MODES = ("auto", "manual", "aggressive", "conservative")


@dataclass
class Components:
    """Which parts of the blocks become tables; no labels means all labels."""

    transactions: bool = True
    blocks: bool = True
    metadata: bool = True
    assets: bool = True
    minting: bool = True
    utxos: bool = True
    inputs: bool = True
    outputs: bool = True
    certificates: bool = True
    governance: bool = True
    withdrawals: bool = True
    scripts: bool = True
    collateral: bool = True
    wallet_connections: bool = False
    metadata_labels: list[int] = field(default_factory=list)

    def tables(self) -> set[str]:
        """Names of the tables that these parts need."""
        groups = {
            "transactions": {"txes", "required_signers"}, "blocks": {"blocks"}, "metadata": {"tx_metadata"}, "assets": {"ma_tx_outs", "multi_assets"}, "minting": {"ma_tx_mints"},
            "utxos": {"tx_ins", "tx_outs"}, "inputs": {"tx_ins", "reference_tx_ins"}, "outputs": {"tx_outs"},
            "certificates": {"stake_registrations", "stake_deregistrations", "delegations", "pool_updates", "pool_owners", "pool_relays", "pool_metadata_refs", "pool_retires", "treasuries"},
            "governance": {"drep_certificates", "delegation_votes", "voting_procedures", "gov_action_proposals", "param_proposals", "treasury_withdrawals", "committee_members", "committees", "constitutions", "voting_anchors", "committee_registrations"},
            "withdrawals": {"withdrawals"}, "scripts": {"scripts", "data", "redeemers"}, "collateral": {"collateral_tx_ins", "collateral_tx_outs"}, "wallet_connections": {"tx_ins", "tx_outs", "txes"},
        }
        return set().union(*(names for part, names in groups.items() if getattr(self, part)))


@dataclass
class Performance:
    """Limits of a run; zeros stand for the defaults below."""

    mode: str = "auto"
    max_workers: int = 16
    max_connections: int = 0
    max_batch: int = 5000
    max_queue: int = 100000
    manual_workers: int = 8
    manual_batch: int = 1000
    manual_queue: int = 10000
    manual_fetch_range: int = 2000

    def active(self, epoch: int) -> dict[str, int]:
        """Workers, connections, batch, queue and fetch range in force at an epoch."""
        connections = self.max_connections or 4 * self.max_workers
        if self.mode == "aggressive":
            return {"workers": self.max_workers, "connections": connections, "batch": self.max_batch, "queue": self.max_queue, "fetch_range": self.max_batch}
        if self.mode == "conservative":
            return {"workers": max(4, self.max_workers // 4), "connections": max(16, connections // 4), "batch": max(100, self.max_batch // 10), "queue": max(1000, self.max_queue // 10), "fetch_range": 500}
        if self.mode == "manual":
            workers, batch, queue, fetch = self.manual_workers, self.manual_batch, self.manual_queue, self.manual_fetch_range
        else:
            bucket = [t for t in TUNING if t[0] <= epoch][-1]
            workers, batch, queue, fetch = bucket[2], bucket[4], bucket[9], bucket[8]
        workers = min(workers, self.max_workers)
        return {"workers": workers, "connections": min(4 * workers, connections), "batch": min(batch, self.max_batch), "queue": min(queue, self.max_queue), "fetch_range": fetch}


@dataclass
class Rewards:
    treasury_tax: float = 0.2
    monetary_expansion: float = 0.003
    optimal_pool_count: int = 500


@dataclass
class Settings:
    """``source`` and ``target`` are folders or table paths that Spark can open."""

    source: str = ""
    target: str = ""
    starting_position: str = "latest"
    components: Components = field(default_factory=Components)
    performance: Performance = field(default_factory=Performance)
    rewards: Rewards = field(default_factory=Rewards)

    def check(self) -> Settings:
        if not self.source or not self.target:
            raise ValueError("source and target are required")
        if self.performance.mode not in MODES:
            raise ValueError(f"mode must be one of {', '.join(MODES)}")
        if self.performance.max_workers <= 0 or self.performance.manual_workers <= 0:
            raise ValueError("workers must be positive")
        if self.starting_position not in ("latest", "origin"):
            raise ValueError("starting_position must be latest or origin")
        if not 0 <= self.rewards.treasury_tax <= 1:
            raise ValueError("treasury_tax must lie between 0 and 1")
        return self


def _convert(text: str, like: object) -> object:
    if isinstance(like, bool):
        return text.strip().lower() in ("1", "true", "yes", "on")
    if isinstance(like, list):
        return [int(x) for x in text.split(",") if x.strip()]
    return type(like)(text)


def load(path: str | None = None, environment: dict[str, str] | None = None) -> Settings:
    """Defaults, then the file where there is one, then variables named CHAINLOOM_<SECTION>_<NAME>."""
    environment = dict(os.environ) if environment is None else environment
    settings = Settings()
    given = tomllib.loads(Path(path).read_text()) if path and Path(path).exists() else {}
    for f in fields(Settings):
        part = getattr(settings, f.name)
        if hasattr(part, "__dataclass_fields__"):
            for g in fields(part):
                if g.name in given.get(f.name, {}):
                    setattr(part, g.name, given[f.name][g.name])
                if (text := environment.get(f"{PREFIX}{f.name}_{g.name}".upper())) is not None:
                    setattr(part, g.name, _convert(text, getattr(part, g.name)))
        else:
            value = environment.get(f"{PREFIX}{f.name}".upper(), given.get(f.name, part))
            setattr(settings, f.name, value)
    return settings.check()
