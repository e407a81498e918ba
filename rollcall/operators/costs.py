"""Usage and cost sums. Amounts are summed as integers of a millionth and divided once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Prices in USD.
SYNC_HOUR, BATCH_HOUR = 0.18, 0.09
TOKEN_PRICES = {"large": (1.50, 9.00), "small": (0.25, 1.50)}


def sum_maps(rows: DataFrame, group: list[str], usage: str) -> DataFrame:
    """Key-wise sum of a map column over each group, as rows (group, key, total)."""
    flat = rows.select(*group, F.explode(usage).alias("key", "value"))
    return flat.groupBy(*group, "key").agg(F.sum("value").alias("total"))


def total_if_all(value: Column) -> Column:
    """Sum of a group, null if any of its values is null."""
    return F.when(F.count("*") == F.count(value), F.sum(value))


def hour_rate(mode: Column) -> Column:
    """A missing mode is a batch run; an unknown one is billed as sync."""
    return F.when(mode.isNull() | (mode == "batch"), F.lit(BATCH_HOUR)).otherwise(F.lit(SYNC_HOUR))


def meeting_cost(seconds: Column, mode: Column, *parts: Column) -> Column:
    """Speech hours at the mode's rate and the other stages' costs, to 6 decimals."""
    total = F.coalesce(seconds / 3600 * hour_rate(mode), F.lit(0.0))
    for p in parts:
        total = total + F.coalesce(p, F.lit(0.0))
    return F.round(total, 6)


def token_cost(prompt: Column, output: Column, reasoning: Column, cached: Column, price_in: float, price_out: float, price_cached: float) -> Column:
    fresh = F.greatest(prompt - F.coalesce(cached, F.lit(0)), F.lit(0))
    paid = fresh * price_in + F.coalesce(cached, F.lit(0)) * price_cached + (output + F.coalesce(reasoning, F.lit(0))) * price_out
    return paid / 1_000_000


def price_of(models: DataFrame, prices: DataFrame) -> DataFrame:
    """``models`` (model) with the price row (prefix, ...) whose prefix is longest; joined by the equality of
    prefixes, of which a model has as many as characters."""
    each = models.select("model").distinct()
    heads = each.select("model", F.explode(F.transform(F.sequence(F.lit(0), F.length("model")), lambda n: F.substr("model", F.lit(1), n))).alias("prefix"))
    found = heads.join(prices, "prefix").groupBy("model").agg(F.max_by(F.struct(*prices.columns), F.length("prefix")).alias("p"))
    return each.join(found, "model", "left").select("model", "p.*")
