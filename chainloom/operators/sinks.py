"""Write semantics over immutable tables: insert-ignore, upserts, get-or-create, rollback and purge.

Each takes the stored table and a batch and returns the table's next state or the rows to append; nothing is written
in place, so that a repeated batch leaves the same state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_of_key(batch: DataFrame, keys: list[str], order: list | None = None) -> DataFrame:
    """One row for each key: the first in a total order, by default that of all other columns."""
    order = order or [c for c in batch.columns if c not in keys]
    if not order:
        return batch.distinct()
    return batch.withColumn("rank__", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("rank__ = 1").drop("rank__")


def insert_ignore(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a batch to append: one for each key that the table does not hold yet."""
    return first_of_key(batch, keys).join(target.select(*keys), keys, "left_anti")


def upsert_replace(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The table with the batch's rows in place of those with the same key."""
    fresh = first_of_key(batch, keys)
    return target.join(fresh.select(*keys), keys, "left_anti").select(*target.columns).unionByName(fresh)


def get_or_create(dimension: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Keys in ``rows`` that the dimension lacks."""
    return rows.select(key).where(F.col(key).isNotNull()).distinct().join(dimension.select(key), key, "left_anti")


def update_column(target: DataFrame, changes: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The table with a column's values taken from the changes where these have the key."""
    new = first_of_key(changes.select(*keys, F.col(column).alias("new__")), keys)
    return target.join(new, keys, "left").withColumn(column, F.coalesce("new__", column)).select(*target.columns)


def rolled_back(blocks: DataFrame, slot: int) -> DataFrame:
    """Blocks that a rollback to a slot leaves."""
    return blocks.where(F.col("slot_no") <= slot)


def cascade(child: DataFrame, parents: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows of a child table whose parent is still there."""
    return child.join(parents.select(F.col(parent_key or key).alias(key)), key, "left_semi")


def rollback(tables: dict[str, DataFrame], slot: int) -> dict[str, DataFrame]:
    """All tables of the chain after a rollback: blocks by slot, transactions by block, their rows by transaction."""
    out = dict(tables)
    out["blocks"] = rolled_back(tables["blocks"], slot)
    out["txes"] = cascade(tables["txes"], out["blocks"], "slot_no")
    for name, frame in tables.items():
        key = next((k for k in ("tx_hash", "tx_in_hash") if k in frame.columns), None)
        if name not in ("blocks", "txes") and key:
            out[name] = cascade(frame, out["txes"], key, "tx_hash")
    return out


def purge(child: DataFrame, doomed: DataFrame, key: str) -> DataFrame:
    """Rows of a table that refer to none of the doomed keys."""
    return child.join(doomed.select(key).distinct(), key, "left_anti")
