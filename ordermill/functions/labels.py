"""Display text for months, money and categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names of the monthly chart.
MONTH_NAMES = ["Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep", "Oct", "Nov", "Dic"]

# Category display names. Codes that are not listed show as they are.
CATEGORY_NAMES = {
    "health_beauty": "Health & Beauty",
    "watches_gifts": "Watches & Gifts",
    "bed_bath_table": "Bed Bath Table",
    "sports_leisure": "Sports & Leisure",
    "computers_accessories": "Computers & Acc",
    "furniture_decor": "Furniture & Decor",
    "housewares": "Housewares",
    "cool_stuff": "Cool Stuff",
    "auto": "Auto",
    "garden_tools": "Garden Tools",
    "toys": "Toys",
    "telephony": "Telephony",
    "perfumery": "Perfumery",
    "baby": "Baby",
    "electronics": "Electronics",
}

# Codes of the regions drawn on the map.
REGION_CODES = [
    "AM", "PA", "AP", "RR", "AC", "RO", "MT", "TO", "MA", "PI", "CE", "RN", "PB",
    "PE", "AL", "SE", "BA", "GO", "DF", "MG", "ES", "SP", "RJ", "PR", "SC", "RS",
]


def month_label(month: Column) -> Column:
    """`2017-01` to `Ene-17`; null when the text holds no month number from 1 to 12."""
    number = month.substr(6, 2).try_cast("int")
    name = F.get(F.array(*[F.lit(m) for m in MONTH_NAMES]), number - 1)
    return F.concat(name, F.lit("-"), month.substr(3, 2))


def compact_money(amount: Column, sign: str = "R$") -> Column:
    """`R$1.4M`, `R$292K`, `R$590`, rounding half up; null stays null."""
    text = (
        F.when(amount >= 1e6, F.format_string("%.1fM", amount / 1e6))
        .when(amount >= 1e3, F.format_string("%.0fK", amount / 1e3))
        .when(amount.isNotNull(), F.format_string("%.0f", amount))
    )
    return F.concat(F.lit(sign), text)


def category_label(code: Column) -> Column:
    pairs = [F.lit(text) for pair in CATEGORY_NAMES.items() for text in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), code), code)
