"""Ordered business rules as `when` chains; the first matching branch wins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


# Thresholds of the segment, activity, revenue and validity rules.
@dataclass(frozen=True)
class SegmentThresholds:
    vip_transactions: int = 200_000
    vip_logins: int = 5
    vip_portfolio: int = 500_000
    premium_transactions: int = 100_000
    premium_logins: int = 10
    premium_activities: int = 20
    standard_transactions: int = 50_000


@dataclass(frozen=True)
class ActivityThresholds:
    vip_logins: int = 5
    premium_logins: int = 10
    standard_logins: int = 5


@dataclass(frozen=True)
class RevenueTiers:
    top_above: int = 1_000_000
    top_factor: float = 1.5
    high_above: int = 500_000
    high_factor: float = 1.2
    low_below: int = 50_000
    low_factor: float = 0.7


@dataclass(frozen=True)
class Validity:
    long_up_to_priority: int = 2
    long_days: int = 30
    medium_up_to_priority: int = 3
    medium_days: int = 14
    short_days: int = 7


def segment(
    transactions: Column,
    logins: Column,
    activities: Column,
    portfolio: Column,
    t: SegmentThresholds = SegmentThresholds(),
) -> Column:
    vip = ((transactions >= t.vip_transactions) & (logins >= t.vip_logins)) | (portfolio >= t.vip_portfolio)
    premium = (transactions >= t.premium_transactions) | (
        (logins >= t.premium_logins) & (activities >= t.premium_activities)
    )
    return (
        F.when(vip, "VIP")
        .when(premium, "Premium")
        .when(transactions >= t.standard_transactions, "Standard")
        .otherwise("Basic")
    )


def combined_segment(
    seg: Column, logins: Column, transaction_count: Column, t: ActivityThresholds = ActivityThresholds()
) -> Column:
    rule = None
    for name, needed in (
        ("VIP", t.vip_logins),
        ("Premium", t.premium_logins),
        ("Standard", t.standard_logins),
    ):
        label = F.when(logins >= needed, f"{name} Active").otherwise(f"{name} Passive")
        rule = F.when(seg == name, label) if rule is None else rule.when(seg == name, label)
    return rule.when(transaction_count > 0, "Transaction Only").otherwise("Low Engagement")


def priority(seg: Column) -> Column:
    return F.when(seg == "VIP", 1).when(seg == "Premium", 2).when(seg == "Standard", 3).otherwise(4)


def expected_revenue(base: Column, total_value: Column, t: RevenueTiers = RevenueTiers()) -> Column:
    """Base revenue scaled by the client's total; fractions are cut off, not rounded.

    A total that is not a number is in no tier. (Spark orders NaN above all numbers.)
    """

    def scaled(factor: float) -> Column:
        return (base * F.lit(factor)).cast("bigint")

    return (
        F.when(F.isnan(total_value), base.cast("bigint"))
        .when(total_value > t.top_above, scaled(t.top_factor))
        .when(total_value > t.high_above, scaled(t.high_factor))
        .when(total_value < t.low_below, scaled(t.low_factor))
        .otherwise(base.cast("bigint"))
    )


def days_valid(priority_level: Column, v: Validity = Validity()) -> Column:
    return (
        F.when(priority_level <= v.long_up_to_priority, v.long_days)
        .when(priority_level <= v.medium_up_to_priority, v.medium_days)
        .otherwise(v.short_days)
    )
