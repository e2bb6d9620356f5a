"""Per-client aggregates kept up by changes instead of being computed from all facts again.

Partial aggregates are held per client and day of the fact. A change is a row with a sign: 1 for one that has
come, -1 for one that has been replaced. Counts and exact sums of the changes are added to the partials. A
maximum only ever grows by what comes; where the largest value of a client's day was replaced by smaller ones, the
cell is marked stale, and only its rows are read again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import money
from ..schemas import ENTITIES, Entity, struct

CELL = ["client_id", "day"]


@dataclass(frozen=True)
class Measures:
    """What is added up of a fact: name -> expression over its columns."""

    amounts: Mapping[str, str] = field(default_factory=dict)
    numbers: Mapping[str, str] = field(default_factory=dict)
    flags: Mapping[str, str] = field(default_factory=dict)
    largest: Mapping[str, str] = field(default_factory=dict)

    @property
    def added(self) -> list[str]:
        """Columns of a partial that are added."""
        summed = [*self.amounts, *self.numbers]
        return ["n", *[f"sum_{m}" for m in summed], *[f"having_{m}" for m in summed], *[f"flag_{m}" for m in self.flags]]

    @property
    def schema(self):
        kinds = {f"sum_{m}": money.AMOUNT for m in self.amounts}
        added = [f"{c} {kinds.get(c, 'bigint')}" for c in self.added]
        return struct(", ".join(["client_id string", "day date", *added, *[f"max_{m} double" for m in self.largest]]))


MEASURES = {
    "bank_transactions": Measures(amounts={"amount": "amount"}, largest={"amount": "amount"}),
    "client_logins": Measures(flags={"success": "success"}),
    "client_activities": Measures(numbers={c: c for c in ("duration_minutes", "page_views")}),
    "payments": Measures(amounts={"amount": "amount"}),
    "portfolios": Measures(amounts={"value": "quantity * current_price"}),
}


def day_of(entity: Entity) -> Column:
    return F.col(entity.newest_by).cast("date").alias("day")


def partials(changes: DataFrame, entity: Entity) -> DataFrame:
    """The changes of an entity (its columns and `sign`) added up per client and day.

    added_* and removed_* are the largest values that have come and gone.
    """
    m, sign = MEASURES[entity.name], F.col("sign").cast("bigint")
    signed = lambda c: F.when(F.col("sign") > 0, c).otherwise(-c)
    sums = {name: signed(money.exact(F.expr(e))) for name, e in m.amounts.items()}
    sums |= {name: signed(F.expr(e).cast("bigint")) for name, e in m.numbers.items()}
    values = {**m.amounts, **m.numbers}
    measured = [
        F.sum(sign).alias("n"),
        *[F.sum(c).alias(f"sum_{name}") for name, c in sums.items()],
        *[F.sum(F.when(F.expr(e).isNotNull(), sign).otherwise(0)).alias(f"having_{name}") for name, e in values.items()],
        *[F.sum(F.when(F.expr(e), sign).otherwise(0)).alias(f"flag_{name}") for name, e in m.flags.items()],
    ]
    for name, e in m.largest.items():
        measured.append(F.max(F.when(F.col("sign") > 0, F.expr(e))).alias(f"added_{name}"))
        measured.append(F.max(F.when(F.col("sign") < 0, F.expr(e))).alias(f"removed_{name}"))
    return changes.groupBy("client_id", day_of(entity)).agg(*measured)


def updated(
    held: DataFrame, delta: DataFrame, entity: Entity, also: list[str] | None = None, parts: int | None = None
) -> DataFrame:
    """Partials with a delta added, and `stale` where the largest value has to be found again.

    `also` are further columns of the key, as the bucket of a cell; with `parts` the rows are dealt by them to so
    many partitions, and stay there. Cells without rows are left out.
    """
    m, key = MEASURES[entity.name], [*(also or []), *CELL]
    both = held.unionByName(delta, allowMissingColumns=True)
    if parts:
        both = both.repartition(parts, *also)
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast(m.schema[c].dataType).alias(c) for c in m.added]
    found = both.groupBy(*key).agg(
        *sums, *[F.max(f"{kind}_{name}").alias(f"{kind}_{name}") for name in m.largest for kind in ("max", "added", "removed")]
    )
    stale = F.lit(False)
    for name in m.largest:
        old, came, gone = (F.col(f"{kind}_{name}") for kind in ("max", "added", "removed"))
        stale = stale | F.coalesce((gone >= F.coalesce(old, gone)) & (came.isNull() | (came < gone)), F.lit(False))
    largest = {f"max_{name}": F.greatest(f"max_{name}", f"added_{name}") for name in m.largest}
    return found.where("n <> 0").withColumns({"stale": stale, **largest}).select(*key, *m.schema.names[2:], "stale")


def with_largest(cells: DataFrame, rows: DataFrame, entity: Entity) -> DataFrame:
    """Stale cells with their largest values taken from the entity's rows."""
    m = MEASURES[entity.name]
    wanted = cells.where("stale").select(*[F.col(c).alias(f"cell_{c}") for c in CELL])
    rows = rows.select("client_id", day_of(entity), *[F.expr(e).alias(f"new_{name}") for name, e in m.largest.items()])
    same = lambda c: F.col(c).eqNullSafe(F.col(f"cell_{c}"))
    rows = rows.join(wanted, same("client_id") & same("day"), "left_semi")
    found = rows.groupBy(*[F.col(c).alias(f"cell_{c}") for c in CELL]).agg(*[F.max(f"new_{n}").alias(f"new_{n}") for n in m.largest])
    joined = cells.join(found, same("client_id") & same("day") & F.col("stale"), "left")
    return joined.withColumns(
        {f"max_{n}": F.when(F.col("stale"), F.col(f"new_{n}")).otherwise(F.col(f"max_{n}")) for n in m.largest}
    ).select(*cells.columns)


def _total(name: str) -> Column:
    return F.when(F.sum(f"having_{name}") > 0, F.sum(f"sum_{name}"))


def _amount(name: str) -> Column:
    return _total(name).cast("double")


# What each fact's aggregate has, by the name that the plain aggregate gives it.
BY_CLIENT: dict[str, dict[str, Callable[[], Column]]] = {
    "bank_transactions": {
        "transaction_count": lambda: F.sum("n"),
        "total_transaction_amount": lambda: _amount("amount"),
        "avg_transaction_amount": lambda: _amount("amount") / F.nullif(F.sum("having_amount"), F.lit(0)),
        "max_transaction_amount": lambda: F.max("max_amount"),
    },
    "client_logins": {"login_count": lambda: F.sum("n"), "successful_logins": lambda: F.sum("flag_success")},
    "client_activities": {
        "activity_count": lambda: F.sum("n"),
        "total_activity_minutes": lambda: _total("duration_minutes"),
        "total_page_views": lambda: _total("page_views"),
    },
    "payments": {"payment_count": lambda: F.sum("n"), "total_payment_amount": lambda: _amount("amount")},
    "portfolios": {"portfolio_count": lambda: F.sum("n"), "portfolio_value": lambda: _amount("value")},
}


def by_client(held: DataFrame, entity: Entity) -> DataFrame:
    """The per-client aggregate of an entity from its partials, as `aggregates.BY_ENTITY` gives it."""
    return held.groupBy("client_id").agg(*[make().alias(name) for name, make in BY_CLIENT[entity.name].items()])


FACTS = [ENTITIES[name] for name in MEASURES]
