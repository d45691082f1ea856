"""Protocol parameters of each era."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The parameters that an era's epochs start with.
_COMMON = {"min_fee_a": 44, "min_fee_b": 155381, "max_tx_size": 16384, "max_bh_size": 1100, "max_epoch": 18}
_STAKE = {"key_deposit": 2000000, "pool_deposit": 500000000, "a0": 0.3, "rho": 0.003, "tau": 0.2, "decentralisation": 0.0, "price_mem": 0.0577, "price_step": 0.0000721}
_SCRIPTS = {"collateral_percent": 150, "max_collateral_inputs": 3, "max_tx_ex_mem": 14000000, "max_tx_ex_steps": 10000000000, "max_block_ex_mem": 62000000, "max_block_ex_steps": 20000000000}
_PLAIN = {"collateral_percent": 0, "max_collateral_inputs": 0}
_VOTES = {"drep_deposit": 500000000, "gov_action_deposit": 100000000, "committee_min_size": 7, "committee_max_term_length": 146, "gov_action_lifetime": 6, "drep_activity": 20}
ERA_PARAMETERS = [
    _COMMON | {"era": "byron", "max_block_size": 65536, "key_deposit": 0, "pool_deposit": 0, "min_pool_cost": 0, "n_opt": 0, "a0": 0.0, "rho": 0.0, "tau": 0.0, "decentralisation": 1.0, "protocol_major": 1, "min_utxo": 0},
    _COMMON | _STAKE | _PLAIN | {"era": "shelley", "max_block_size": 65536, "min_pool_cost": 340000000, "n_opt": 150, "protocol_major": 2, "min_utxo": 1000000},
    _COMMON | _STAKE | _PLAIN | {"era": "allegra", "max_block_size": 65536, "min_pool_cost": 340000000, "n_opt": 500, "protocol_major": 3, "min_utxo": 1000000},
    _COMMON | _STAKE | _PLAIN | {"era": "mary", "max_block_size": 65536, "min_pool_cost": 340000000, "n_opt": 500, "protocol_major": 4, "min_utxo": 1000000},
    _COMMON | _STAKE | _SCRIPTS | {"era": "alonzo", "max_block_size": 90112, "min_pool_cost": 340000000, "n_opt": 500, "protocol_major": 5, "min_utxo": 34482, "coins_per_utxo_size": 34482},
    _COMMON | _STAKE | _SCRIPTS | {"era": "babbage", "max_block_size": 90112, "min_pool_cost": 170000000, "n_opt": 500, "protocol_major": 7, "min_utxo": 0, "coins_per_utxo_size": 4310, "max_val_size": 5000},
    _COMMON | _STAKE | _SCRIPTS | _VOTES | {"era": "conway", "max_block_size": 90112, "min_pool_cost": 170000000, "n_opt": 500, "protocol_major": 9, "min_utxo": 0, "coins_per_utxo_size": 4310, "max_val_size": 5000},
]
_DOUBLES = {"a0", "rho", "tau", "decentralisation", "price_mem", "price_step"}


def era_parameters(spark: SparkSession) -> DataFrame:
    """One row for each era; parameters that an era does not have are null."""
    names = ["era", *dict.fromkeys(k for p in ERA_PARAMETERS for k in p if k != "era")]
    schema = ", ".join(f"{n} {'string' if n == 'era' else 'double' if n in _DOUBLES else 'long'}" for n in names)
    return spark.createDataFrame([tuple(p.get(n) for n in names) for p in ERA_PARAMETERS], schema)
