"""Business rules of the source system as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order states, tiers and the source's rounding steps.
NEXT_STATUS = {"placed": "confirmed", "confirmed": "shipped", "shipped": "delivered"}
CANCELLABLE = ("placed", "confirmed")
TIERS = ("bronze", "silver", "gold")


def next_status(status: Column) -> Column:
    """The one state after ``status``; NULL for a final state."""
    out = F.lit(None).cast("string")
    for now, then in NEXT_STATUS.items():
        out = F.when(status == now, then).otherwise(out)
    return out


def can_cancel(status: Column) -> Column:
    return status.isin(*CANCELLABLE)


def allocate(requested: Column, on_hand: Column) -> Column:
    """What can be delivered: never below zero nor above the stock."""
    return F.greatest(F.lit(0), F.least(requested, on_hand))


def changed_price(price: Column, pct: Column) -> Column:
    """Price changed by a percentage, half-up to cents, at least 1.00."""
    factor = F.lit(1).cast("decimal(12,2)") + pct.cast("decimal(7,4)") / F.lit(100)
    return F.greatest(F.round(price.cast("decimal(12,2)") * factor, 2), F.lit("1.00").cast("decimal(12,2)")).cast("decimal(12,2)")


def changed_credit_limit(limit: Column, pct: Column) -> Column:
    """Limit changed by a percentage, half-even to whole thousands, at least 1,000."""
    scaled = limit.cast("decimal(12,2)") * (F.lit(1).cast("decimal(12,2)") + pct.cast("decimal(7,4)") / F.lit(100)) / F.lit(1000)
    return F.greatest(F.bround(scaled, 0) * 1000, F.lit(1000)).cast("decimal(12,2)")


def tier_step(tier: Column, up: Column) -> Column:
    """One tier up or down; the ends can only move inwards."""
    tiers = F.array(*map(F.lit, TIERS))
    at = F.array_position(tiers, tier).cast("int")
    step = F.when(at == 1, 1).when(at == len(TIERS), -1).otherwise(F.when(up, 1).otherwise(-1))
    return F.when(at > 0, F.element_at(tiers, F.when(at > 0, at + step).otherwise(1)))


def case_quantity(quantity: Column, divisor: Column) -> Column:
    """Cases instead of single units: a whole part, at least one."""
    return F.greatest(F.lit(1), F.floor(quantity / divisor)).cast("int")


def case_price(single: Column, units: Column) -> Column:
    """A case costs 95 % of its units, half-even to whole units of money."""
    return F.bround(single.cast("decimal(12,2)") * units * F.lit("0.95").cast("decimal(3,2)"), 0).cast("decimal(12,2)")


def weighted_rank(weight: Column, seed: int) -> Column:
    """Ascending order of this value is a weighted sample without replacement."""
    return -F.log(F.greatest(F.rand(seed), F.lit(1e-300))) / weight
