"""Bot traffic from a request log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import first_match
from ..functions.money import pct, rounded, share
from ..functions.time import When, ts

# Bots and the pattern of their user agent.
BOT_PATTERNS = (
    ("Googlebot", "%Googlebot/2.1%"),
    ("Googlebot-Image", "%Googlebot-Image%"),
    ("Googlebot-Video", "%Googlebot-Video%"),
    ("Google-Extended", "%Google-Extended%"),
    ("GoogleOther", "%GoogleOther%"),
    ("AdsBot-Google", "%AdsBot-Google%"),
    ("Storebot-Google", "%Storebot-Google%"),
    ("bingbot", "%bingbot%"),
    ("YandexBot", "%YandexBot%"),
    ("Applebot", "%Applebot%"),
    ("ClaudeBot", "%ClaudeBot%"),
    ("GPTBot", "%GPTBot%"),
    ("OAI-SearchBot", "%OAI-SearchBot%"),
    ("PerplexityBot", "%PerplexityBot%"),
    ("Amazonbot", "%Amazonbot%"),
    ("Bytespider", "%Bytespider%"),
    ("AhrefsBot", "%AhrefsBot%"),
    ("SemrushBot", "%SemrushBot%"),
    ("DataForSeoBot", "%DataForSeoBot%"),
    ("facebookexternalhit", "%facebookexternalhit%"),
)
ALL_TRAFFIC = "__ALL__"
EXACT_TOTAL = "__EXACT__"
# Cache states that mean the request went to the origin.
ORIGIN_STATES = ("miss", "expired", "dynamic", "none", "bypass", "revalidated")


def bot_label(agent: Column, patterns: Sequence[tuple[str, str]] = BOT_PATTERNS) -> Column:
    """Name of the bot, NULL for other visitors. The patterns exclude each other."""
    return first_match([(agent.like(pattern), name) for name, pattern in patterns])


def bot_classify(requests: DataFrame) -> DataFrame:
    return requests.withColumn("bot", bot_label(F.col("user_agent")))


def _collected(at: When | None) -> Column:
    moment = F.lit(None).cast("timestamp") if at is None else ts(at)
    return moment.alias("collected_at")


def crawl_daily(requests: DataFrame, *, collected_at: When | None = None) -> DataFrame:
    """Requests per day, zone, bot, edge status and cache state, and for all traffic.

    The all-traffic rows are made from the counted groups, so the log is read and
    shuffled once. ``collected_at`` is the moment the log was taken, which tells a
    day that was still running from a whole one; null if unknown.
    """
    counted = bot_classify(requests).groupBy(
        F.col("ts").cast("date").alias("data_date"), "zone", "bot", "edge_status", "cache_status"
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("bytes").alias("b"),
        F.sum(F.col("origin_ms").cast("decimal(18,4)")).alias("ms"),
        F.count("origin_ms").alias("ms_n"),
    )
    labels = F.array_compact(F.array(F.lit(ALL_TRAFFIC), F.col("bot")))
    return (
        counted.withColumn("bot", F.explode(labels))
        .groupBy("data_date", "zone", "bot", "edge_status", "cache_status")
        .agg(
            F.sum("n").cast("bigint").alias("requests"),
            F.sum("b").cast("bigint").alias("bytes"),
            rounded(F.try_divide(F.sum("ms"), F.sum("ms_n")), 4).alias("avg_origin_ms"),
        )
        .select("*", _collected(collected_at))
    )


def is_bot(bot: str = "bot") -> Column:
    return ~F.col(bot).startswith("__")


def origin_share(crawl: DataFrame, states: Sequence[str] = ORIGIN_STATES) -> DataFrame:
    """Per zone and bot: requests, those that reached the origin, and their share."""
    to_origin = F.sum(F.when(F.col("cache_status").isin(*states), F.col("requests")).otherwise(0))
    return (
        crawl.where(is_bot())
        .groupBy("zone", "bot")
        .agg(
            F.sum("requests").cast("bigint").alias("requests"),
            to_origin.cast("bigint").alias("to_origin"),
            pct(to_origin, F.sum("requests"), 2).alias("origin_pct"),
        )
    )


def exact_rows(exact_daily: DataFrame, *, collected_at: When | None = None) -> DataFrame:
    """Unsampled daily totals in the shape of :func:`crawl_daily`."""
    empty = lambda kind: F.lit(None).cast(kind)
    return exact_daily.select(
        "data_date",
        "zone",
        F.lit(EXACT_TOTAL).alias("bot"),
        empty("int").alias("edge_status"),
        empty("string").alias("cache_status"),
        "requests",
        empty("bigint").alias("bytes"),
        empty("double").alias("avg_origin_ms"),
        _collected(collected_at),
    )


def sampled_calibration(crawl: DataFrame, exact_daily: DataFrame) -> DataFrame:
    """Scales sampled bot counts of a (day, zone) to its exact total.

    The sampling error differs by zone, so each zone has its own factor. The
    share inside the sample is reported too; it needs no scaling.
    """
    by_bot = crawl.groupBy("data_date", "zone", "bot").agg(F.sum("requests").alias("sampled"))
    totals = by_bot.where(F.col("bot") == ALL_TRAFFIC).select(
        "data_date", "zone", F.col("sampled").alias("sampled_total")
    )
    exact = exact_daily.select("data_date", "zone", F.col("requests").alias("exact_total"))
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    scaled = F.try_divide(whole("sampled") * whole("exact_total"), whole("sampled_total"))
    return (
        by_bot.where(is_bot())
        .join(totals, ["data_date", "zone"])
        .join(exact, ["data_date", "zone"], "left")
        .select(
            "data_date",
            "zone",
            "bot",
            F.col("sampled").cast("bigint").alias("sampled"),
            share("exact_total", "sampled_total", 4).alias("factor"),
            rounded(scaled, 1).alias("scaled"),
            pct("sampled", "sampled_total", 2).alias("share_pct"),
        )
    )
