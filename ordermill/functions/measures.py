"""KPI measures in two steps: sums and counts per group, then the figures made from them.

All KPI tables share the first step, so one table of sums and counts can serve them all. Columns that a
KPI table does not use are pruned by Spark.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums of Silver columns taken over delivered orders only.
DELIVERED_SUMS = ("delivery_days_actual", "delivery_days_estimated", "delivery_delay_days")
PLAIN_SUMS = ("payment_value", "review_score", "freight_ratio", *DELIVERED_SUMS)


# Floating-point measures of Silver as exact numbers: a decimal wide enough, or whole units of the given decimal, which
# are summed much faster.
EXACT = {"freight_ratio": "decimal(30,15)"}
UNITS = {"review_score": Decimal("0.000001")}
# Sums that are null where these counts are zero.
COUNTED = {"delivered": "status_n", "canceled": "status_n"}
COUNTED |= {f"{n}_sum": f"{n}_n" for n in (*PLAIN_SUMS, *[f"delivered_{n}" for n in DELIVERED_SUMS])}


def totals(exact: bool = False, sign: str | None = None) -> list[Column]:
    """Aggregates over Silver: `orders`, `rows`, flag totals, and `<x>_sum` / `<x>_n` per measure.

    `exact` sums floating-point measures as exact numbers (a ratio beyond 15 digits before the point does not count), so that
    rows can be taken out of a sum again, and adds `status_n`, the rows with a status. `sign` names a column of 1 and -1
    that tells rows to add from rows to take out.
    """
    delivered, late = F.col("is_delivered"), F.col("is_late_delivery")

    def signed(value: Column) -> Column:
        return value if sign is None else F.when(F.col(sign) < 0, -value).otherwise(value)

    def number(condition: Column) -> Column:
        if sign is None:
            return F.count(F.when(condition, 1))
        return F.coalesce(F.sum(F.when(condition, F.col(sign).cast("long"))), F.lit(0).cast("long"))

    out = [
        (F.count(F.lit(1)) if sign is None else F.sum(F.col(sign).cast("long"))).alias("rows"),
        number(F.col("order_id").isNotNull()).alias("orders"),
        F.sum(signed(delivered.cast("int"))).alias("delivered"),
        F.sum(signed(F.col("is_canceled").cast("int"))).alias("canceled"),
        # A delivered order whose delay is unknown is not late, so it counts as on time.
        F.sum(signed(F.when(delivered & ~late, 1).otherwise(0))).alias("on_time"),
        F.sum(signed(late.cast("int"))).alias("late"),
    ]
    if exact:
        out.append(number(delivered.isNotNull()).alias("status_n"))

    def source(name: str) -> Column:
        if exact and name in UNITS:
            return F.round(F.col(name).cast("double") / float(UNITS[name])).try_cast("long")
        return F.col(name).try_cast(EXACT[name]) if exact and name in EXACT else F.col(name)

    sources = {n: source(n) for n in PLAIN_SUMS}
    sources |= {f"delivered_{n}": F.when(delivered, F.col(n)) for n in DELIVERED_SUMS}
    for name, value in sources.items():
        total = F.sum(signed(value))
        if exact and name in UNITS:
            total = (total * F.lit(UNITS[name])).cast("decimal(38,6)")
        out += [total.alias(f"{name}_sum"), number(value.isNotNull()).alias(f"{name}_n")]
    return out


def ratio(part: Column, whole: Column) -> Column:
    """Null instead of an error when `whole` is zero or null."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    part, whole = (F.col(x) if isinstance(x, str) else x for x in (part, whole))
    return F.round(ratio(part, whole) * 100, digits)


def otif_pct() -> Column:
    return percent("on_time", "delivered")


def average(name: str, digits: int) -> Column:
    """Exact sum first, one division in double last; null when there is nothing to average."""
    return F.round(ratio(F.col(f"{name}_sum"), F.col(f"{name}_n")), digits)


def average_delivered(name: str, digits: int = 1) -> Column:
    return average(f"delivered_{name}", digits)


def money_total(name: str = "payment_value") -> Column:
    return F.round(F.col(f"{name}_sum").cast("double"), 2)


def weighted_mean(value: str, weight: str) -> Column:
    """Sum of v*w over sum of w; a missing value adds 0 but keeps its weight; 0 when nothing weighs."""
    v, w = F.coalesce(F.col(value), F.lit(0.0)), F.col(weight)
    return F.coalesce(F.try_divide(F.sum(v * w), F.sum(w)), F.lit(0.0))
