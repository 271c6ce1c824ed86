"""S-5: seeds — small, hand-maintained reference lists.

``read_seed_csv`` reads a maintained CSV with its declared schema; the packaged
lists below are the reference's own seed rows.  Both are bounded by
construction (a curated list), so joins may broadcast them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow import schemas

# The reference's seed rows, in its order --------------------------
TAX_EXEMPT_ITEMS = [
    (13190, "Old school bond", "bond"),
    (1755, "Chisel", "tool"),
    (5325, "Gardening trowel", "tool"),
    (1785, "Glassblowing pipe", "tool"),
    (2347, "Hammer", "tool"),
    (1733, "Needle", "tool"),
    (233, "Pestle and mortar", "tool"),
    (5341, "Rake", "tool"),
    (8794, "Saw", "tool"),
    (5329, "Secateurs", "tool"),
    (5343, "Seed dibber", "tool"),
    (1735, "Shears", "tool"),
    (952, "Spade", "tool"),
    (5331, "Watering can", "tool"),
]
BUY_LIMIT_OVERRIDES = [
    (13190, 1, "Old school bond", "GE allows only 1 bond per buy offer; /mapping reports 100"),
]
# ----------------------------------------------------------------------------------


def read_seed_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def tax_exempt_items(spark: SparkSession, path: str | None = None) -> DataFrame:
    if path is not None:
        return read_seed_csv(spark, path, schemas.TAX_EXEMPT_SEED)
    return F.broadcast(spark.createDataFrame(TAX_EXEMPT_ITEMS, schemas.TAX_EXEMPT_SEED))


def buy_limit_overrides(spark: SparkSession, path: str | None = None) -> DataFrame:
    if path is not None:
        return read_seed_csv(spark, path, schemas.BUY_LIMIT_OVERRIDE_SEED)
    return F.broadcast(spark.createDataFrame(BUY_LIMIT_OVERRIDES, schemas.BUY_LIMIT_OVERRIDE_SEED))
