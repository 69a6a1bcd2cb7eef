"""Row filters shared by the money reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import When, since, ts

CANCELLED = 40


def not_cancelled(status: str = "OrderStatusId") -> Column:
    return F.col(status) != CANCELLED


def settled() -> Column:
    """Money counts only for orders that are not cancelled and fully calculated."""
    return not_cancelled() & F.col("IsDoneCalculating")


def settled_orders(order_profit: DataFrame, as_of: When, days: int) -> DataFrame:
    return order_profit.where(since(F.col("OrderCreatedOnUtc"), as_of, days) & settled())


def losing_orders(order_profit: DataFrame, as_of: When, days: int, below: float = 0) -> DataFrame:
    """Settled orders of the window whose unrounded profit is below ``below``."""
    return settled_orders(order_profit, as_of, days).where(F.col("Profit_Actual") < below)


def known_tags(tags: DataFrame, as_of: When, *tag_ids: int) -> DataFrame:
    """The tags that stood on orders at the moment ``as_of``, if given only those of some kinds.

    Every report that looks at tags goes through here, so that a replay of a past moment sees no tag that was set
    later. A tag without a time is not known to have stood there.
    """
    known = tags.where(F.col("CreatedOnUtc") <= ts(as_of))
    return known.where(F.col("TagId").isin(*tag_ids)) if tag_ids else known


def tagged_orders(tags: DataFrame, as_of: When, *tag_ids: int) -> DataFrame:
    """Distinct order ids that carried one of the tags at ``as_of``.

    Reduced to keys before any join, so repeated tags never multiply rows and an
    order with very many tags weighs as much as one with a single tag.
    """
    return known_tags(tags, as_of, *tag_ids).select("CustomerOrderId").distinct()


def with_flag(df: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
    """Adds a boolean: is the row's key in the (distinct) key set?"""
    flagged = keys.withColumn(name, F.lit(True))
    return df.join(flagged, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))
