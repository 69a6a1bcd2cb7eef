"""Every operator with its settings for the star-schema data set.

Windows span the whole history, so each report reads its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import TableContract, registry_frame
from ..operators import baskets, cohorts, cost, crawl, fulfilment, ingest, loss, trust, variance
from ..sources.entities import Entities
from ..sources.scratch import shared_folder, staged
from .checks import Check, CheckResults, run_checks, typed

AS_OF = "2001-08-02"
START = "1995-01-01"
HISTORY = 2500
EVENTS_AS_OF = "2024-01-31"
EVENT_DAYS = 60
MARKET = "BUILDING"
RETAILER = "R0"
SUPPLIER_NOTE = r"request to (.+)$"
WATCH = (cost.Watch("Promo parts", "sku", "PROMO%"), cost.Watch("Returns", "service", "R"))
BANDS = ((0.5, "a"), (1.5, "b"), (2.5, "c"), (4.0, "d"))
RULES = (
    ("Customer#00000001%", None, "key account"),
    (None, "BUILDING%", "construction"),
    ("%7", "%1-URGENT", "express"),
    (None, "%3-MEDIUM", "standard"),
)

Report = Callable[[Entities], DataFrame]
REPORTS: dict[str, Report] = {}


def report(fn: Report) -> Report:
    REPORTS[fn.__name__] = fn
    return fn


# -- losses ------------------------------------------------------------------


@report
def loss_cause(e):
    return loss.classified_orders(e.order_profit).select(
        F.col("CustomerOrderId").alias("order_id"), "cause", "cause_label"
    )


@report
def loss_topk(e):
    return loss.loss_topk(e.order_profit, as_of=AS_OF, days=HISTORY)


@report
def loss_topk_large(e):
    return loss.loss_topk_large(e.order_profit, as_of=AS_OF, days=HISTORY)


@report
def threshold_sweep(e):
    return loss.threshold_sweep(
        e.order_profit, as_of=AS_OF, days=HISTORY, thresholds=(-50, -100, -1000, -10000, -50000)
    )


@report
def loss_patterns(e):
    return loss.loss_patterns(e.order_profit, as_of=AS_OF, days=HISTORY)


@report
def loss_by_tag(e):
    return loss.loss_by_tag(e.order_profit, e.order_profit_tag, as_of=AS_OF, days=HISTORY)


@report
def tag_cooccurrence(e):
    return loss.tag_cooccurrence(e.order_profit, e.order_profit_tag, as_of=AS_OF, days=HISTORY, replay=False)


@report
def loss_structure(e):
    return loss.loss_structure(
        e.order_profit, e.order_profit_tag, as_of=AS_OF, days=HISTORY, report_day=2
    )


@report
def loss_by_plan(e):
    return loss.loss_by_plan(e.order_profit, e.order_profit_tag, as_of=AS_OF, days=HISTORY)


@report
def zero_revenue_shipments(e):
    return loss.zero_revenue_shipments(e.order_profit, as_of=AS_OF, days=HISTORY, min_orders=1)


@report
def unprofitable_destinations(e):
    """Silent where every country earns over all its orders, as in this data set."""
    return loss.unprofitable_destinations(e.order_profit, as_of=AS_OF, days=HISTORY, min_orders=5)


@report
def unprofitable_destinations_small_orders(e):
    """Here small orders lose everywhere."""
    return loss.unprofitable_destinations(
        e.order_profit, as_of=AS_OF, days=HISTORY, min_orders=5, below=60000
    )


@report
def loss_bands(e):
    return loss.loss_bands(e.order_profit, as_of=AS_OF, days=HISTORY)


@report
def loss_cost_shares(e):
    return loss.loss_cost_shares(e.order_profit, as_of=AS_OF, days=HISTORY)


@report
def weekly_losses(e):
    return loss.weekly_losses(e.order_profit, e.order_profit_tag, as_of=AS_OF, days=HISTORY)


@report
def problem_products(e):
    return loss.problem_products(e.order_profit, e.order_item_profit, as_of=AS_OF, days=HISTORY)


@report
def item_loss_cause(e):
    return loss.item_loss_cause(e.order_item_profit)


# -- variance ----------------------------------------------------------------


@report
def pricing_drift(e):
    return variance.pricing_drift(e.order_profit, e.shipping_cost, as_of=AS_OF, days=HISTORY)


@report
def shipping_drift_patterns(e):
    return variance.shipping_drift_patterns(e.order_profit, e.shipping_cost, as_of=AS_OF, days=HISTORY)


@report
def shipping_estimate_outliers(e):
    return variance.shipping_estimate_outliers(
        e.order_profit, e.shipping_cost, as_of=AS_OF, days=HISTORY, min_deviation=0.15
    )


@report
def marketplace_cost_outliers(e):
    return variance.marketplace_cost_outliers(
        e.order_profit, e.marketplace_cost, as_of=AS_OF, days=HISTORY
    )


@report
def cost_breakdown(e):
    return variance.cost_breakdown(e.order_profit, e.shipping_cost, e.payment_cost, e.marketplace_cost)


@report
def order_summary(e):
    return variance.order_summary(e.order_profit)


@report
def order_tags(e):
    return variance.order_tags(e.order_profit_tag)


@report
def profit_revisions(e):
    return variance.profit_revisions(e.order_profit_revision)


@report
def price_history(e):
    return variance.price_history(e.price_offer, as_of="2001-11-05", days=HISTORY, k=20)


@report
def product_shipment_methods(e):
    return variance.product_shipment_methods(e.product_method, e.shipment_method)


@report
def driver_means(e):
    return variance.driver_means(e.order_profit, e.order_profit_tag, as_of=AS_OF, days=HISTORY)


# -- fulfilment --------------------------------------------------------------


@report
def fulfilment_weekly(e):
    return fulfilment.fulfilment_weekly(e.order_header, first=START, as_of=AS_OF)


@report
def tag_share_weekly(e):
    return fulfilment.tag_share_weekly(e.order_profit, e.order_profit_tag, first=START, as_of=AS_OF)


@report
def upgrade_counterfactual(e):
    return fulfilment.upgrade_counterfactual(
        e.order_profit, e.shipping_cost, e.order_profit_tag, as_of=AS_OF, days=HISTORY,
        cheap=("AF%",), min_cheap=5, min_orders=2, bands=BANDS,
    )


@report
def promise_window(e):
    return fulfilment.promise_window(e.order_profit, e.order_profit_tag, first=START)


@report
def tag_base_rate(e):
    return fulfilment.tag_base_rate(
        e.order_profit, e.order_profit_tag, as_of=AS_OF, days=HISTORY,
        pattern=SUPPLIER_NOTE, min_orders=10, replay=False, stage=lambda rows: staged(rows, "base-rate"),
    )


@report
def tag_base_rate_monthly(e):
    return fulfilment.tag_base_rate_monthly(
        e.order_profit, e.order_profit_tag, as_of=AS_OF, days=HISTORY
    )


@report
def tag_base_rate_by_market(e):
    return fulfilment.tag_base_rate_by_market(
        e.order_profit, e.order_profit_tag, as_of=AS_OF, days=HISTORY
    )


@report
def upgrade_vs_base(e):
    return fulfilment.upgrade_vs_base(e.order_fulfilment, e.order_profit_tag, first=START, until=AS_OF)


@report
def deadline_source_monthly(e):
    return fulfilment.deadline_source_monthly(
        e.order_fulfilment, e.order_profit_tag, first=START, until=AS_OF
    )


@report
def supplier_upgrade_rate(e):
    return fulfilment.supplier_upgrade_rate(
        e.order_fulfilment, e.order_profit_tag, first=START, until=AS_OF, min_orders=20
    )


# -- cohorts -----------------------------------------------------------------


@report
def pilot_propagation(e):
    return cohorts.pilot_propagation(
        e.offer_settings, e.price_offer, e.buy_box_current, e.our_offers_current,
        e.order_profit, e.order_item_profit, as_of=AS_OF, market=MARKET, group="pilot",
        our_retailer=RETAILER, sales_market="BUILD%", days=HISTORY,
    )


@report
def sale_cohort_profitability(e):
    return cohorts.sale_cohort_profitability(
        e.sale_cohort, e.price_offer, e.buy_box_nested, e.order_profit, e.order_item_profit,
        sale_start="1999-01-01", baseline_days=1461,
    )


@report
def ab_diff_in_diff(e):
    return cohorts.ab_diff_in_diff(
        e.cohort, e.order_profit, e.order_item_profit, e.buy_box_current,
        baseline_start=START, test_start="1999-01-01", as_of=AS_OF, market=MARKET,
        our_retailer=RETAILER,
    )


@report
def cohort_exposure_bands(e):
    return cohorts.cohort_exposure_bands(e.cohort, e.supplier_stock, e.own_stock, supplier_id=4)


@report
def feed_format_sentinel(e):
    return cohorts.feed_format_sentinel(e.supplier_stock)


@report
def cohort_vs_rest(e):
    return cohorts.cohort_vs_rest(
        e.order_profit, e.order_item_profit, e.listed, e.order_header,
        baseline_start=START, baseline_end="1998-01-01", as_of=AS_OF, recent_days=700,
    )


@report
def coverage_diff(e):
    return cohorts.coverage_diff(
        e.order_header.withColumnRenamed("Id", "CustomerOrderId"),
        e.order_profit_tag,
        ["CustomerOrderId"],
        placeholder=F.col("OrderStatusId") == 40,
    )


@report
def latest_per_key(e):
    return cohorts.latest_per_key(
        e.price_offer, ["OurEan"], ["LastUpdatedOnUtc", "Id"], ["Id", "SKU", "Price", "LastUpdatedOnUtc"]
    ).select("OurEan", "Id", "SKU", F.col("Price").cast("double").alias("price"), "LastUpdatedOnUtc")


# -- baskets and events --------------------------------------------------------


def _relative(e: Entities) -> DataFrame:
    return baskets.relative_price(
        e.basket_item, e.order_header, e.shop_price, as_of=AS_OF, days=HISTORY, period="month",
        stage=lambda lines: staged(lines, "baskets"),
    )


@report
def relative_price(e):
    return _relative(e).withColumn("rel", F.col("rel").cast("double"))


@report
def bundle_attribution(e):
    return baskets.bundle_attribution(
        staged(_relative(e), "relative"), e.bundle, e.bundle_component
    )


@report
def event_funnel(e):
    return baskets.event_funnel(e.web_event, as_of=EVENTS_AS_OF, days=EVENT_DAYS)


@report
def event_param(e):
    return baskets.event_params(e.web_event, ["k", "page_location", "absent"])


@report
def missing_pairs(e):
    return baskets.missing_pairs(e.supplier_feed, e.replacement, min_suppliers=1)


@report
def rule_categorise(e):
    return baskets.rule_categorise(e.invoice, RULES).withColumn("amount", F.col("amount").cast("double"))


@report
def category_totals(e):
    return baskets.category_totals(baskets.rule_categorise(e.invoice, RULES))


@report
def key_correction_coverage(e):
    offered = e.price_offer.select(F.col("BookstoreId").alias("market"), F.col("SKU").alias("code"))
    own = e.shop_price.select(F.col("Ean").alias("code"))
    correction = e.price_offer.where("SKU <> OurEan AND NOT IsBlocked").select(
        F.col("SKU").alias("code"), F.col("OurEan").alias("own_code")
    )
    return baskets.key_correction_coverage(offered, own, correction, by=["market"])


# -- billing and crawl ---------------------------------------------------------


@report
def net_cost(e):
    return cost.net_cost(e.billing).withColumn("net", F.col("net").cast("double"))


@report
def monthly_cost_report(e):
    return cost.monthly_cost_report(e.billing, as_of="2001-08-15", watch=WATCH, tax_service="A")


@report
def monthly_cost_report_untaxed(e):
    return cost.monthly_cost_report(e.billing, as_of="2000-03-03", watch=WATCH)


@report
def bot_classify(e):
    return (
        crawl.bot_classify(e.request_log)
        .groupBy("bot", "user_agent")
        .agg(F.count(F.lit(1)).alias("requests"))
    )


@report
def crawl_daily(e):
    return crawl.crawl_daily(e.request_log, collected_at=EVENTS_AS_OF)


@report
def origin_share(e):
    return crawl.origin_share(crawl.crawl_daily(e.request_log))


def _exact(e: Entities) -> DataFrame:
    return e.request_log.groupBy(F.col("ts").cast("date").alias("data_date"), "zone").agg(
        F.count(F.lit(1)).alias("requests")
    )


@report
def crawl_exact_rows(e):
    return crawl.exact_rows(_exact(e), collected_at=EVENTS_AS_OF)


@report
def sampled_calibration(e):
    """The sampled feed misses every failed lookup, unevenly over bots and zones."""
    sampled = crawl.crawl_daily(e.request_log.where("edge_status <> 404"))
    return crawl.sampled_calibration(sampled, _exact(e))


# -- trust ---------------------------------------------------------------------


def _watched(e: Entities) -> dict[str, trust.Watched]:
    return {
        "order_header": trust.Watched(e.order_header, ["Id"], "LastUpdateDateUtc"),
        "order_item_profit": trust.Watched(e.order_item_profit, ["Id"], "LastUpdateOnUtc"),
        "order_profit_tag": trust.Watched(e.order_profit_tag, ["Id"], "CreatedOnUtc"),
        "price_offer": trust.Watched(e.price_offer, ["Id"], "LastUpdatedOnUtc"),
        "orders": trust.Watched(e.t["orders"], ["o_orderkey"], "o_orderdate"),
        "events": trust.Watched(e.t["events"], ["event_id"], "ts"),
    }


@report
def mirror_health(e):
    return trust.mirror_health(_watched(e), as_of="2001-11-04 06:00:00", rarely_changed=["orders"])


def _catalog(e: Entities) -> DataFrame:
    return trust.catalog_stats(
        {
            **{name: (w.frame, w.watermark) for name, w in _watched(e).items()},
            "lineitem": (e.t["lineitem"], "l_shipdate"),
            "lineitem_staging": (e.t["lineitem"], "l_shipdate"),
            "crawl_daily": (e.t["events"], "ts"),
        },
        as_of="2001-11-10",
    )


@report
def catalog_stats(e):
    return _catalog(e)


CONTRACTS = (
    TableContract("orders", "shop.dbo.orders", ("o_orderkey",), "o_orderdate", max_age_days=9999),
    TableContract("lineitem", "shop.dbo.lineitem", (), "l_shipdate", max_age_days=2),
    TableContract("order_header", "shop.dbo.order_header", ("Id",), "LastUpdateDateUtc", max_age_days=30),
    TableContract("order_item_profit", "shop.dbo.order_item", ("Id",), "LastUpdateOnUtc", max_age_days=60),
    TableContract("price_offer", "shop.dbo.price_offer", ("Id",), "LastUpdatedOnUtc", max_age_days=60),
    TableContract("shipment_method", "shop.dbo.shipment_method", ("Id",), None),
    TableContract("shipment_price", "shop.dbo.shipment_price", ("Id",), None),
)


@report
def registry_reconcile(e):
    return trust.registry_reconcile(
        registry_frame(e.t.spark, CONTRACTS), _catalog(e), documented=["crawl_daily"]
    )


@report
def coverage_vs_expected(e):
    return trust.coverage_vs_expected(e.report_landing, as_of="2024-02-03")


@report
def silence_alarm(e):
    return trust.silence_alarm(e.t["events"], "ts", as_of="2024-02-10", source="events")


@report
def source_target_reconcile(e):
    target = e.order_header.where("OrderStatusId <> 40").withColumn(
        "BillingName", F.left("BillingName", F.lit(15))
    )
    return trust.source_target_reconcile(
        e.order_header, target, key=["Id"], watermark="LastUpdateDateUtc",
        columns=["IdBookstore", "ShippedDateUtc", "BillingName", "BillingEmail"],
    )


@report
def column_footprint(e):
    return trust.column_footprint(e.t["documents"])


@report
def severity(e):
    found = loss.problem_products(e.order_profit, e.order_item_profit, as_of=AS_OF, days=HISTORY)
    return trust.severity(found, trust.rules_for("problem_products")).select(
        "ean", "losses", "total_loss", "severity"
    )


@report
def watermark_profile(e):
    profiles = [
        trust.watermark_profile(e.t["orders"], "o_orderdate", as_of=AS_OF, table="orders", placeholder=START),
        trust.watermark_profile(e.order_header, "ShippedDateUtc", as_of=AS_OF, table="order_header"),
        trust.watermark_profile(e.t["events"], "ts", as_of="2024-01-30", table="events"),
    ]
    return profiles[0].unionByName(profiles[1]).unionByName(profiles[2])


def check_list(e: Entities) -> list[Check]:
    """The checks of a daily run; the last two are silent and broken on purpose."""
    return [
        Check(
            "loss_topk", lambda: loss_topk(e), "worst losing orders", order_by=("loss", "order_id"),
            link_column="order_id", link_template="https://panel.example/order?id={}",
        ),
        Check("loss_patterns", lambda: loss_patterns(e), "losses per cause", order_by=("cause",)),
        Check("loss_by_tag", lambda: loss_by_tag(e), "losses per tag", order_by=("tag",)),
        Check("silence_alarm", lambda: silence_alarm(e), "are events still arriving?", True),
        Check(
            "no_silence",
            lambda: trust.silence_alarm(e.t["events"], "ts", as_of=EVENTS_AS_OF, source="events"),
            "nothing to say", True,
        ),
        Check("broken", lambda: e.order_profit.select("no_such_column"), "fails"),
    ]


def _checked(e: Entities) -> CheckResults:
    return run_checks(e.t.spark, check_list(e))


@report
def run_checks_rows(e):
    """The rows of all checks; of each payload the fields that the checks share, read back with their types."""
    fields = "order_id bigint, cause int, tag int, orders bigint, loss double, markets string, example string"
    return typed(_checked(e).rows, fields)


@report
def run_checks_summary(e):
    return _checked(e).summary.select(
        "check", "rows", "silent", F.col("error").isNotNull().alias("failed")
    )


# -- ingestion -------------------------------------------------------------------

HEADER = TableContract(
    "order_header", "shop.dbo.order_header", ("Id",), "LastUpdateDateUtc",
    partition_by="CreatedOnUtc", granularity="MONTH", cluster_by=("IdBookstore",),
    exclude=("BillingName",), mask={"BillingEmail": "email_domain"},
)
SPLIT = "LastUpdateDateUtc < TIMESTAMP '2000-01-01'"


def _stored(e: Entities) -> DataFrame:
    """What an earlier run has stored: rows changed before 2000."""
    return e.order_header.where(SPLIT)


@report
def high_watermark(e):
    return ingest.high_watermark(_stored(e), "LastUpdateDateUtc")


@report
def delta_extract(e):
    mark = ingest.stored_mark(_stored(e), "LastUpdateDateUtc")
    return ingest.delta_extract(e.order_header, "LastUpdateDateUtc", mark).select(
        "Id", "IdBookstore", "LastUpdateDateUtc"
    )


@report
def key_chunks(e):
    return ingest.key_chunks(e.t["orders"], "o_orderkey", size=1000)


@report
def apply_contract(e):
    contract = TableContract("order_header", key=("Id",), exclude=("BillingEmail",))
    return ingest.apply_contract(e.order_header, contract, {"OrderStatusId": "string", "CreatedOnUtc": "date"})


@report
def mask_pii(e):
    masked = ingest.mask_pii(e.order_header, {"BillingName": "xxx", "BillingEmail": "email_domain"})
    return masked.select("Id", "BillingName", "BillingEmail")


ITEM = ["Id", "EAN", "Quantity", "LastUpdateOnUtc"]


@report
def dedup_latest(e):
    return ingest.dedup_latest(e.order_item_profit.select(*ITEM), ["Id"], "LastUpdateOnUtc")


@report
def merge_upsert(e):
    """Items of the first years, then a delta of repriced and new items."""
    items = e.order_item_profit.select(*ITEM)
    target = ingest.dedup_latest(items.where("LastUpdateOnUtc < TIMESTAMP '2000-01-01'"), ["Id"], "LastUpdateOnUtc")
    delta = items.where("LastUpdateOnUtc >= TIMESTAMP '1999-07-01'").withColumn("Quantity", F.col("Quantity") + 100)
    return ingest.merge_upsert(target, delta, ["Id"], "LastUpdateOnUtc")


def _per_partition(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col(ingest.PART).cast("string").alias("partition")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("Id").alias("keys"),
        F.count("BillingEmail").alias("emails"),
    )


@report
def full_reload(e):
    spark = e.t.spark
    path = shared_folder(spark, "reload")
    ingest.full_reload(e.order_header, HEADER, path)
    ingest.full_reload(_stored(e), HEADER, path)
    return _per_partition(ingest.read_layout(spark, path))


@report
def write_layout(e):
    path = shared_folder(e.t.spark, "layout")
    ingest.write_layout(e.order_header, HEADER, path)
    return _per_partition(ingest.read_layout(e.t.spark, path))


@report
def replace_days(e):
    """All days, then the second half again: nothing is doubled."""
    path = shared_folder(e.t.spark, "days")
    daily = crawl.crawl_daily(e.request_log)
    ingest.replace_days(daily, path, sort=["zone", "bot"])
    ingest.replace_days(daily.where("data_date >= DATE '2024-01-15'"), path, sort=["zone", "bot"])
    return e.t.spark.read.parquet(path).groupBy(F.col("data_date").cast("date").alias("data_date")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("requests").cast("bigint").alias("requests")
    )


@report
def sync_table(e):
    """An initial load, then a delta in which old orders changed market and month."""
    spark = e.t.spark
    root = shared_folder(spark, "sync")
    ingest.sync_table(HEADER, _stored(e), root)
    moved = e.order_header.withColumn(
        "CreatedOnUtc",
        F.when(F.col("IdBookstore") == "BUILDING", F.add_months("CreatedOnUtc", 1).cast("timestamp")).otherwise(
            F.col("CreatedOnUtc")
        ),
    ).withColumn(
        "LastUpdateDateUtc",
        F.when(F.col("IdBookstore") == "BUILDING", F.lit("2001-09-01").cast("timestamp")).otherwise(
            F.col("LastUpdateDateUtc")
        ),
    )
    ingest.sync_table(HEADER, moved, root)
    return _per_partition(ingest.read_layout(spark, f"{root}/{HEADER.target}"))


@report
def sync_all(e):
    root = shared_folder(e.t.spark, "sync-all")
    orders = TableContract("orders", "shop.dbo.orders", ("o_orderkey",), "o_orderdate", partition_by="o_orderdate", granularity="YEAR")
    typo = TableContract("customer", "shop.dbo.customer", ("c_custkey",), mask={"c_nmae": "xxx"})
    lines = TableContract("lineitem", "shop.dbo.lineitem")
    first = ingest.sync_all([(orders, e.t["orders"]), (typo, e.t["customer"]), (lines, e.t["lineitem"])], root)
    again = ingest.sync_all([(orders, e.t["orders"])], root)
    return first.unionByName(again).select(
        "target", "mode", "rows", F.col("error").isNotNull().alias("failed")
    )

