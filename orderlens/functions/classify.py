"""Column expressions that put a row into a class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .money import col, dec, ratio

# Cause codes and their labels.
CAUSE_LABELS = {
    1: "sold below product cost",
    2: "shipping eats the margin",
    3: "marketplace cost over 25%",
    4: "payment cost over 10%",
    5: "other / mixed",
}
OTHER_CAUSE = 5

# Display names of destination countries.
COUNTRY_NAMES = {
    "DE": "Niemcy", "FR": "Francja", "IT": "Wlochy", "ES": "Hiszpania", "NL": "Holandia",
    "BE": "Belgia", "PL": "Polska", "SE": "Szwecja", "AT": "Austria", "IE": "Irlandia",
    "GB": "W.Brytania", "UK": "W.Brytania", "DK": "Dania", "FI": "Finlandia",
    "PT": "Portugalia", "LU": "Luksemburg", "CZ": "Czechy", "MT": "Malta", "CY": "Cypr",
    "GR": "Grecja", "HU": "Wegry", "RO": "Rumunia", "SK": "Slowacja", "SI": "Slowenia",
    "HR": "Chorwacja", "BG": "Bulgaria", "EE": "Estonia", "LT": "Litwa", "LV": "Lotwa",
    "NO": "Norwegia", "CH": "Szwajcaria",
}


def loss_cause(
    total: str = "fOrderTotal",
    product: str = "ProductCost",
    shipping: str = "ShippingCost",
    marketplace: str = "MarketplaceCost",
    payment: str = "PaymentCost",
    *,
    max_marketplace: float = 0.25,
    max_payment: float = 0.10,
) -> Column:
    """Cause code 1-5 of a losing order; the first test that holds decides.

    A NULL cost makes its test unknown, and the next test is tried. An order
    without revenue has no ratios, so it never lands in 3 or 4.
    """
    return (
        F.when(col(total) < col(product), 1)
        .when(col(shipping) > col(total) - col(product), 2)
        .when(ratio(marketplace, total) > dec(max_marketplace), 3)
        .when(ratio(payment, total) > dec(max_payment), 4)
        .otherwise(OTHER_CAUSE)
    )


def label(code: Column, names: dict[int, str] | dict[str, str]) -> Column:
    """Name of a code from a fixed dictionary, as an expression rather than a join."""
    entries = [F.lit(x) for pair in names.items() for x in pair]
    return F.create_map(*entries)[code]


def cause_label(code: Column) -> Column:
    return label(code, CAUSE_LABELS)


def country_name(code: Column | str, names: dict[str, str] = COUNTRY_NAMES) -> Column:
    c = col(code)
    return F.coalesce(label(c, names), c, F.lit("??"))


def first_match(
    rules: Sequence[tuple[Column, object]], default: object = None
) -> Column:
    """Value of the first rule whose condition holds."""
    chain = None
    for condition, value in rules:
        result = value if isinstance(value, Column) else F.lit(value)
        chain = F.when(condition, result) if chain is None else chain.when(condition, result)
    if chain is None:
        return F.lit(default)
    return chain.otherwise(default if isinstance(default, Column) else F.lit(default))


def upper_band(value: Column, edges: Sequence[tuple[float, str]], last: str) -> Column:
    """Label of the first edge the value does not exceed; NULL falls to the last."""
    return first_match([(value <= dec(edge), name) for edge, name in edges], last)


def any_like(value: Column, patterns: Sequence[str]) -> Column:
    cond = F.lit(False)
    for pattern in patterns:
        cond = cond | value.like(pattern)
    return cond


def extract(value: Column | str, pattern: str, group: int = 1) -> Column:
    """Regex group, NULL (not '') when the pattern is absent."""
    return F.nullif(F.regexp_extract(col(value), pattern, group), F.lit(""))
