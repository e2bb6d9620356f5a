from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import rules
from ..functions.ids import offer_id
from .ordinal import with_global_ordinal
from .segmentation import client_order


class Template(NamedTuple):
    combined_segment: str
    position: int
    offer_type: str
    offer_description: str
    base_revenue: int
    offer_priority: int


# Offers per combined segment, in the order they are made.
TEMPLATES: tuple[Template, ...] = (
    Template("VIP Active", 1, "Premium Investment Advisory", "Персональный инвестиционный консультант", 50000, 1),
    Template("VIP Active", 2, "Exclusive Private Banking", "VIP банковское обслуживание", 30000, 1),
    Template("VIP Active", 3, "Luxury Credit Card", "Премиальная кредитная карта без лимита", 25000, 2),
    Template("VIP Passive", 1, "Investment Portfolio Review", "Анализ и оптимизация портфеля", 35000, 1),
    Template("VIP Passive", 2, "Premium Savings Account", "Депозит под повышенный процент", 20000, 2),
    Template("VIP Passive", 3, "VIP Insurance Package", "Комплексная страховая программа", 15000, 2),
    Template("Premium Active", 1, "Advanced Trading Platform", "Профессиональная торговая платформа", 20000, 2),
    Template("Premium Active", 2, "Investment Consultation", "Консультация по инвестициям", 15000, 2),
    Template("Premium Active", 3, "Premium Credit Limit", "Увеличенный кредитный лимит", 10000, 3),
    Template("Premium Passive", 1, "Balanced Investment Fund", "Сбалансированный инвестиционный фонд", 12000, 2),
    Template("Premium Passive", 2, "High-Yield Deposit", "Высокодоходный депозит", 8000, 3),
    Template("Premium Passive", 3, "Premium Debit Card", "Премиальная дебетовая карта", 5000, 3),
    Template("Standard Active", 1, "Trading Mobile App", "Мобильное приложение для торговли", 8000, 3),
    Template("Standard Active", 2, "Investment Education", "Обучающие курсы по инвестициям", 5000, 3),
    Template("Standard Active", 3, "Cashback Credit Card", "Кредитная карта с кэшбэком", 3000, 4),
    Template("Standard Passive", 1, "Starter Investment Package", "Стартовый инвестиционный пакет", 5000, 4),
    Template("Standard Passive", 2, "Savings Account Plus", "Накопительный счет с бонусами", 3000, 4),
    Template("Standard Passive", 3, "Basic Insurance", "Базовая страховая программа", 2000, 4),
    Template("Transaction Only", 1, "Investment Starter Guide", "Руководство по началу инвестирования", 3000, 4),
    Template("Transaction Only", 2, "No-Fee Account", "Счет без комиссий", 2000, 4),
    Template("Transaction Only", 3, "Financial Planning Tool", "Инструмент финансового планирования", 1000, 5),
    Template("Low Engagement", 1, "Welcome Bonus", "Приветственный бонус", 1000, 5),
    Template("Low Engagement", 2, "Basic Banking Package", "Базовый банковский пакет", 500, 5),
    Template("Low Engagement", 3, "Mobile Banking App", "Мобильное банковское приложение", 200, 5),
)
DEFAULT_SEGMENT = "Low Engagement"

OFFER_COLUMNS = [
    "client_id",
    "client_name",
    "portfolio_segment",
    "transaction_segment",
    "combined_segment",
    "offer_type",
    "offer_description",
    "expected_revenue",
    "priority_level",
    "offer_priority",
    "days_valid",
    "total_portfolio_value",
]


def templates_of(segment: Column, templates: Sequence[Template] = TEMPLATES) -> Column:
    """Array of the templates of a segment, in order; the default segment's if it has none.

    The arrays are constants of the plan, so the lookup needs no join.
    """
    by_segment: dict[str, list[Template]] = {}
    for t in sorted(templates, key=lambda t: t.position):
        by_segment.setdefault(t.combined_segment, []).append(t)

    def constant(group: list[Template]) -> Column:
        fields = Template._fields[1:]
        # `place` is the template's place among those of its segment, from 0.
        return F.array(
            *[F.struct(F.lit(n).alias("place"), *[F.lit(getattr(t, f)).alias(f) for f in fields]) for n, t in enumerate(group)]
        )

    found = F.when(F.lit(False), constant(by_segment[DEFAULT_SEGMENT]))
    for name, group in by_segment.items():
        found = found.when(segment == name, constant(group))
    return found.otherwise(constant(by_segment[DEFAULT_SEGMENT]))


def expand_offers(
    clients: DataFrame,
    templates: Sequence[Template] = TEMPLATES,
    tiers: rules.RevenueTiers = rules.RevenueTiers(),
    validity: rules.Validity = rules.Validity(),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Every client x the templates of its combined segment, in template order; no shuffle.

    A segment without templates takes those of the default segment and keeps its own label.
    """
    value = F.coalesce(F.col("total_value"), F.lit(0.0)).cast("double")
    return (
        clients.withColumn("total_portfolio_value", value)
        .select("*", F.inline(templates_of(F.col("combined_segment"), templates)))
        .withColumns(
            {
                "expected_revenue": rules.expected_revenue(
                    F.col("base_revenue"), F.col("total_portfolio_value"), tiers
                ),
                "days_valid": rules.days_valid(F.col("priority_level"), validity),
            }
        )
        .select(*OFFER_COLUMNS, *keep)
    )


def offers_with_ids(clients: DataFrame, templates: Sequence[Template] = TEMPLATES, **options) -> DataFrame:
    """Offers with the id that depends on the offer's place in the whole run.

    Clients are numbered, not offers: offer n of client c is number `offers of the clients before c + n`. The
    numbers of offers are added up over the clients in their order, whether all have equally many or not,
    so the sort and what it stages hold clients only.

    The sort runs, and its rows are staged, when this is called.
    """
    per_client = _offers_per_client(templates)
    weight = F.size(templates_of(F.col("combined_segment"), templates)) if per_client is None else None
    numbered = with_global_ordinal(clients, client_order(), "client_ordinal", weight)
    offers = expand_offers(numbered, templates, keep=("client_ordinal", "place"), **options)
    ordinal = (F.col("client_ordinal") - 1) * (per_client or 1) + F.col("place") + 1
    return offers.select(
        offer_id(F.col("client_id"), F.col("offer_type"), ordinal).alias("offer_id"), *OFFER_COLUMNS
    )


def _offers_per_client(templates: Sequence[Template]) -> int | None:
    """Templates of every segment, if all have equally many."""
    counts: dict[str, int] = {}
    for t in templates:
        counts[t.combined_segment] = counts.get(t.combined_segment, 0) + 1
    return next(iter(counts.values())) if len(set(counts.values())) == 1 else None
