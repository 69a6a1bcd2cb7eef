"""The expected answer of every registered query, as one SQL statement each.

The statements follow the plain meaning of a report (row-level joins, ranking
windows, all pairs), not the way Spark computes it.
"""

from __future__ import annotations

from .entities import AS_OF, with_entities


def r(x: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def avg(x: str, digits: int = 2) -> str:
    return r(f"CAST(sum({x}) AS DOUBLE) / count({x})", digits)


def quot(a: str, b: str, digits: int = 2) -> str:
    return r(f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)", digits)


def pct(a: str, b: str, digits: int = 1) -> str:
    return r(f"100 * CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)", digits)


def n(cond: str | None = None) -> str:
    return f"count(*) FILTER (WHERE {cond})" if cond else "count(*)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def markets(limit: int, table: str, key: str) -> str:
    """Scalar: the first market names of the group, by name."""
    return (
        f"(SELECT string_agg(mk, ',' ORDER BY mk) FROM (SELECT DISTINCT x.IdBookstore AS mk FROM {table} x "
        f"WHERE x.{key} = g.{key} ORDER BY mk LIMIT {limit}))"
    )


def rank_at(p: str, value: str) -> str:
    return f"min(CASE WHEN rn >= greatest(1, ceil({p} * cnt)) THEN {value} END)"


SQL: dict[str, str] = {}

# -- losses ------------------------------------------------------------------

CAUSE = """CASE WHEN fOrderTotal < ProductCost THEN 1 WHEN ShippingCost > fOrderTotal - ProductCost THEN 2
    WHEN fOrderTotal <> 0 AND CAST(MarketplaceCost AS DOUBLE) / CAST(nullif(fOrderTotal, 0) AS DOUBLE) > 0.25 THEN 3
    WHEN fOrderTotal <> 0 AND CAST(PaymentCost AS DOUBLE) / CAST(nullif(fOrderTotal, 0) AS DOUBLE) > 0.10 THEN 4
    ELSE 5 END"""

SQL["loss_cause"] = f"""
SELECT CustomerOrderId AS order_id, c.cause, cause_label
FROM (SELECT *, {CAUSE} AS cause FROM order_profit) c JOIN cause_names ON c.cause = cause_names.cause"""


def topk(below: str, significance: str) -> str:
    return f"""
SELECT CustomerOrderId AS order_id, IdBookstore AS market, coalesce(ShippingCountryIso2, '??') AS country,
       strftime(OrderCreatedOnUtc, '%m-%d %H:%M') AS created, NumOfItems AS items,
       {r('fOrderTotal')} AS order_value, {r('Profit_Actual')} AS loss, {r('ProfitMargin', 1)} AS margin_pct,
       losses.cause, cause_label
FROM losses JOIN cause_names ON losses.cause = cause_names.cause
WHERE Profit_Actual < {below} AND (losses.cause <> 5 OR round(Profit_Actual, 2) <= {significance})
ORDER BY Profit_Actual, CustomerOrderId LIMIT 15"""


SQL["loss_topk"] = topk("0", "-10")
SQL["loss_topk_large"] = topk("-100", "-100")

SQL["threshold_sweep"] = f"""
SELECT CAST(t AS DOUBLE) AS threshold, {n('Profit_Actual < t')} AS orders,
       {quot(n('Profit_Actual < t'), '2500', 1)} AS orders_per_day,
       {pct('coalesce(sum(Profit_Actual) FILTER (WHERE Profit_Actual < t), 0)', 'sum(Profit_Actual)')} AS loss_pct
FROM losses, (VALUES (-50), (-100), (-1000), (-10000), (-50000)) v(t) GROUP BY t"""

SQL["loss_patterns"] = f"""
SELECT g.cause, any_value(cause_label) AS cause_label, count(*) AS orders, {r('sum(Profit_Actual)')} AS loss,
       {avg('Profit_Actual')} AS avg_loss, {r('min(Profit_Actual)')} AS worst_loss,
       {markets(6, 'losses', 'cause')} AS markets
FROM losses g JOIN cause_names c ON g.cause = c.cause GROUP BY g.cause"""

SQL["loss_by_tag"] = f"""
WITH noted AS (
  SELECT CustomerOrderId, Profit_Actual, IdBookstore, TagId AS tag, Note,
         row_number() OVER (PARTITION BY CustomerOrderId, TagId ORDER BY CreatedOnUtc DESC, Id DESC, Note DESC) AS rn
  FROM losses JOIN known_tags USING (CustomerOrderId)),
pairs AS (SELECT * FROM noted WHERE rn = 1)
SELECT g.tag, count(*) AS orders, {r('sum(Profit_Actual)')} AS loss, {avg('Profit_Actual')} AS avg_loss,
       {markets(4, 'pairs', 'tag')} AS markets, left(min(Note), 80) AS example
FROM pairs g GROUP BY g.tag HAVING count(*) >= 3"""

SQL["tag_cooccurrence"] = f"""
SELECT TagId AS tag, count(DISTINCT CustomerOrderId) AS losing_orders, {r('sum(Profit_Actual)')} AS loss_per_tag_row,
       left(min(Note), 90) AS example, min(Source) AS source
FROM losses JOIN order_profit_tag USING (CustomerOrderId) GROUP BY TagId"""

SQL["loss_structure"] = f"""
WITH classed AS (
  SELECT Profit_Actual, CASE
      WHEN fOrderTotal <= 0 THEN '1. replacement shipment (no revenue)'
      WHEN EXISTS (SELECT 1 FROM known_tags t WHERE t.CustomerOrderId = o.CustomerOrderId AND TagId = 22) THEN '2. return'
      WHEN EXISTS (SELECT 1 FROM known_tags t WHERE t.CustomerOrderId = o.CustomerOrderId AND TagId = 33) THEN '3. aged stock sold off'
      WHEN Profit_Estimated <= 0 THEN '4. loss already in the plan' ELSE '5. execution error' END AS loss_class
  FROM losses o)
SELECT loss_class, count(*) AS orders, {r('sum(Profit_Actual)', 0)} AS loss, {avg('Profit_Actual')} AS avg_loss,
       {pct('sum(Profit_Actual)', '(SELECT sum(Profit_Actual) FROM classed)')} AS loss_pct
FROM classed GROUP BY loss_class"""

SQL["loss_by_plan"] = f"""
SELECT CustomerOrderId AS order_id, cause,
       coalesce((SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT CAST(TagId AS VARCHAR) AS x
          FROM known_tags t WHERE t.CustomerOrderId = o.CustomerOrderId
            AND TagId IN (1, 10, 13, 16, 17, 21, 24, 35, 37, 38))), '-') AS tags,
       IdBookstore AS market, coalesce(ShippingCountryIso2, '??') AS country, {r('fOrderTotal')} AS order_value,
       {r('ProductCost')} AS product_cost, {r('ShippingCost')} AS shipping_cost, {r('Profit_Actual')} AS loss
FROM losses o
WHERE fOrderTotal > 0 AND Profit_Estimated <= 0 AND abs(Profit_Actual - Profit_Estimated) <= 3 AND cause <> 5
  AND NOT EXISTS (SELECT 1 FROM known_tags t WHERE t.CustomerOrderId = o.CustomerOrderId AND TagId IN (22, 33))
ORDER BY Profit_Actual, CustomerOrderId LIMIT 12"""

SQL["zero_revenue_shipments"] = f"""
SELECT IdBookstore AS market, coalesce(ShippingCountryIso2, '??') AS country, count(*) AS shipments,
       {r('sum(Profit_Actual)', 0)} AS cost, {avg('Profit_Actual')} AS avg_cost,
       {avg('ShippingCost')} AS avg_shipping, {avg('ProductCost')} AS avg_product
FROM losses WHERE fOrderTotal <= 0 GROUP BY ALL"""

UNPROFITABLE = f"""
SELECT coalesce(ShippingCountryIso2, '??') AS country, count(*) AS orders,
       {pct(n('Profit_Actual < 0'), n())} AS loss_pct, {r('sum(Profit_Actual)', 0)} AS result,
       {avg('Profit_Actual')} AS avg_per_order, {n('Profit_Actual < 0 AND Profit_Estimated <= 0')} AS planned_losses,
       {n('Profit_Actual < 0')} AS losses
FROM settled WHERE {{where}}
GROUP BY 1 HAVING count(*) >= 5 AND round(sum(Profit_Actual), 0) < 0"""
SQL["unprofitable_destinations"] = UNPROFITABLE.format(where="true")
SQL["unprofitable_destinations_small_orders"] = UNPROFITABLE.format(where="fOrderTotal < 60000")

SQL["loss_bands"] = f"""
WITH banded AS (SELECT *, CASE WHEN Profit_Actual > -2 THEN 'a) 0 to -2' WHEN Profit_Actual > -5 THEN 'b) -2 to -5'
    WHEN Profit_Actual > -10 THEN 'c) -5 to -10' WHEN Profit_Actual > -25 THEN 'd) -10 to -25' ELSE 'e) below -25' END AS band
  FROM losses WHERE cause = 5)
SELECT band, count(*) AS orders, {r('sum(Profit_Actual)')} AS loss,
       {pct('sum(Profit_Actual)', '(SELECT sum(Profit_Actual) FROM banded)')} AS loss_pct,
       {avg('fOrderTotal')} AS avg_order_value
FROM banded GROUP BY band"""


def mean_share(cost: str) -> str:
    return r(f"100 * avg(CAST({cost} AS DOUBLE) / CAST(nullif(fOrderTotal, 0) AS DOUBLE))", 1)


SQL["loss_cost_shares"] = f"""
SELECT cause, count(*) AS orders, {r('sum(Profit_Actual)')} AS loss, {mean_share('ProductCost')} AS product_pct,
       {mean_share('ShippingCost')} AS shipping_pct, {mean_share('MarketplaceCost')} AS marketplace_pct,
       {mean_share('PaymentCost')} AS payment_pct, {mean_share('(HandlingCost + PackagingCost)')} AS handling_pct,
       {avg('fOrderTotal')} AS avg_order_value, {avg('Profit_Actual')} AS avg_loss
FROM losses GROUP BY cause"""

SQL["weekly_losses"] = f"""
SELECT CustomerOrderId AS order_id, IdBookstore AS market, CAST(OrderCreatedOnUtc AS DATE) AS ordered_on,
       {r('Profit_Actual')} AS profit, {r('fOrderTotal')} AS order_value,
       {pct('abs(Profit_Actual)', 'fOrderTotal')} AS loss_pct,
       CASE WHEN EXISTS (SELECT 1 FROM known_tags t WHERE t.CustomerOrderId = o.CustomerOrderId)
            THEN 'tagged' ELSE 'none' END AS tags
FROM order_profit o WHERE OrderStatusId <> 40 AND Profit_Actual < 0
ORDER BY Profit_Actual, CustomerOrderId LIMIT 15"""

ITEM_CAUSE = """CASE WHEN UnitPurchasePriceNet >= UnitSalesPriceNet THEN 'purchase price too high'
    WHEN OrderCostMinusShippingChargeForUnit > UnitSalesPriceNet - UnitPurchasePriceNet THEN 'indirect costs'
    WHEN ShippingChargePlnNettoForUnit > UnitSalesPriceNet - UnitPurchasePriceNet THEN 'shipping costs'
    ELSE '{other}' END"""

PROBLEMS = f"""
SELECT EAN AS ean, count(*) AS losses, {avg('ItemProfit')} AS avg_loss, {r('sum(ItemProfit)')} AS total_loss,
       {avg('UnitSalesPriceNet')} AS avg_sale_price, {avg('UnitPurchasePriceNet')} AS avg_purchase_price,
       arg_max(main_cause, (LastUpdateOnUtc, Id, main_cause)) AS main_cause
FROM (SELECT *, {ITEM_CAUSE.format(other='other')} AS main_cause FROM order_item_profit)
JOIN order_profit USING (CustomerOrderId)
WHERE OrderStatusId <> 40 AND ItemProfit < 0 GROUP BY EAN HAVING count(*) >= 3"""

SQL["problem_products"] = PROBLEMS

SQL["item_loss_cause"] = f"""
SELECT CustomerOrderId AS order_id, EAN AS ean, Quantity AS quantity, {r('UnitSalesPriceNet')} AS sale_price,
       {r('UnitPurchasePriceNet')} AS purchase_price, {r('ItemProfit')} AS item_profit,
       {r('OrderCostMinusShippingChargeForUnit')} AS indirect_cost,
       {r('ShippingChargePlnNettoForUnit')} AS shipping_cost, {ITEM_CAUSE.format(other='mixed')} AS main_cause,
       {r('UnitPurchasePriceNet_OfferTime')} AS purchase_price_at_offer,
       {r('UnitPurchasePriceNet - UnitPurchasePriceNet_OfferTime')} AS purchase_price_change
FROM order_item_profit"""

# -- variance ----------------------------------------------------------------

EST = "ShippingCostTotal_EstimatedPreShipments"
OVER_PRODUCT = "(ProductCost - ProductCost_Estimated)"
OVER_SHIPPING = f"(coalesce(fShippingCostTotal, 0) - coalesce({EST}, 0))"

SQL["pricing_drift"] = f"""
SELECT CASE WHEN Profit_Actual < 0 THEN 'losing' ELSE 'profitable' END AS result, count(*) AS orders,
       {r('sum(Profit_Actual)')} AS net_profit, {r(f'sum({OVER_PRODUCT})')} AS product_over_estimate,
       {r(f'sum({OVER_SHIPPING})')} AS shipping_over_estimate, {n(f'{OVER_PRODUCT} > 5')} AS orders_product_over,
       {n(f'{OVER_SHIPPING} > 5')} AS orders_shipping_over
FROM settled LEFT JOIN shipping_cost USING (CustomerOrderId) GROUP BY 1"""

SQL["shipping_drift_patterns"] = f"""
SELECT ShipmentMethodName AS method, ShippingCompany AS carrier, count(*) AS orders,
       {r(f'sum({OVER_SHIPPING})')} AS drift, {avg(OVER_SHIPPING)} AS avg_drift, {avg(EST)} AS avg_estimate,
       {avg('fShippingCostTotal')} AS avg_actual, {quot('sum(fShippingCostTotal)', f'sum({EST})')} AS multiple,
       {n(f'{OVER_SHIPPING} > 5')} AS orders_over, {n('Profit_Actual < 0')} AS losing_orders
FROM settled JOIN shipping_cost USING (CustomerOrderId) GROUP BY 1, 2 HAVING count(*) >= 5"""

SQL["shipping_estimate_outliers"] = f"""
SELECT CustomerOrderId AS order_id, {r(EST)} AS estimate, {r('fShippingCostTotal')} AS actual,
       {r(f'fShippingCostTotal - {EST}')} AS difference, {pct(f'fShippingCostTotal - {EST}', EST)} AS difference_pct,
       {r('Profit_Actual')} AS profit
FROM shipping_cost JOIN order_profit USING (CustomerOrderId)
WHERE OrderStatusId <> 40 AND {EST} > 0
  AND CAST(abs(fShippingCostTotal - {EST}) AS DOUBLE) / CAST({EST} AS DOUBLE) > 0.15
ORDER BY abs(fShippingCostTotal - {EST}) DESC, CustomerOrderId LIMIT 20"""

SQL["marketplace_cost_outliers"] = f"""
SELECT CustomerOrderId AS order_id, IdBookstore AS market, {r('fOrderTotal')} AS order_value,
       {r('fMarketplaceCost')} AS marketplace_cost, {pct('fMarketplaceCost', 'fOrderTotal')} AS marketplace_pct,
       {r('ReferralFee_Actual')} AS referral_fee, {r('ClosingFees_Actual')} AS closing_fee,
       {r('Profit_Actual')} AS profit, CASE WHEN part > 0.20 THEN 'critical' ELSE 'raised' END AS grade
FROM (SELECT *, CAST(fMarketplaceCost AS DOUBLE) / CAST(nullif(fOrderTotal, 0) AS DOUBLE) AS part
      FROM order_profit JOIN marketplace_cost USING (CustomerOrderId))
WHERE OrderStatusId <> 40 AND part > 0.17
ORDER BY CAST(part AS DECIMAL(18,8)) DESC, CustomerOrderId LIMIT 20"""

SQL["cost_breakdown"] = f"""
SELECT CustomerOrderId AS order_id, {r('fOrderTotal')} AS revenue, {r('Profit_Actual')} AS profit,
       {r('coalesce(fShippingCostTotal, 0)')} AS shipping_cost, {r('coalesce(fPaymentCost, 0)')} AS payment_cost,
       {r('coalesce(fMarketplaceCost, 0)')} AS marketplace_cost, {r('HandlingCost + PackagingCost')} AS handling_cost,
       {r('coalesce(fShippingCostTotal, 0) + coalesce(fPaymentCost, 0) + coalesce(fMarketplaceCost, 0) + HandlingCost + PackagingCost')} AS indirect_cost
FROM order_profit LEFT JOIN shipping_cost USING (CustomerOrderId) LEFT JOIN payment_cost USING (CustomerOrderId)
LEFT JOIN marketplace_cost USING (CustomerOrderId)"""

SQL["order_summary"] = f"""
SELECT CustomerOrderId AS order_id, IdBookstore AS market, CAST(OrderCreatedOnUtc AS DATE) AS ordered_on,
       {r('Profit_Actual')} AS profit, {r('fOrderTotal')} AS order_value,
       {pct('abs(Profit_Actual)', 'fOrderTotal')} AS loss_pct, OrderStatusId AS status,
       CAST(LastUpdatedOnUtc AS DATE) AS updated_on
FROM order_profit WHERE OrderStatusId <> 40"""

SQL["order_tags"] = """
SELECT CustomerOrderId AS order_id, Source AS source, 'tag ' || TagId AS description, CreatedOnUtc AS created
FROM order_profit_tag"""

SQL["profit_revisions"] = f"""
SELECT CustomerOrderId AS order_id, DeletedOnUtc AS changed, {r('Profit_Actual')} AS profit,
       {r('Profit_Actual - lag(Profit_Actual) OVER (PARTITION BY CustomerOrderId ORDER BY DeletedOnUtc NULLS FIRST, Profit_Actual NULLS FIRST, Notes NULLS FIRST)')} AS profit_change,
       Notes AS notes
FROM order_profit_revision"""

SQL["price_history"] = f"""
SELECT OurEan AS ean, CreatedOnUtc AS offered, BookstoreId AS market, {r('Price')} AS price,
       {r('PriceMin')} AS min_price, LastSubmittedOnUtc AS submitted, LastUpdatedOnUtc AS updated
FROM price_offer WHERE CreatedOnUtc >= TIMESTAMP '2001-11-05' - INTERVAL 2500 DAY
QUALIFY row_number() OVER (PARTITION BY OurEan ORDER BY CreatedOnUtc DESC, Id) <= 20"""

SQL["product_shipment_methods"] = """
SELECT CAST(p AS VARCHAR) AS ean, s + 5 AS method_id, s_name AS method, lower(s_name) AS friendly_name,
       s_suppkey % 2 = 0 AS trackable, s_suppkey % 5 = 0 AS consolidated, CAST(s_nationkey AS VARCHAR) AS region,
       first_day AS mapped
FROM supplied LEFT JOIN supplier ON s_suppkey = s + 5"""

HAS = "EXISTS (SELECT 1 FROM known_tags t WHERE t.CustomerOrderId = o.CustomerOrderId AND t.TagId = {tag})"

SQL["driver_means"] = f"""
SELECT CASE WHEN {HAS.format(tag=35)} THEN 'tagged' ELSE 'base' END AS cohort, count(*) AS orders,
       {avg('fOrderTotal')} AS avg_revenue, {avg('ProductCost')} AS avg_product, {avg('MarketplaceCost')} AS avg_marketplace,
       {avg('ShippingCost')} AS avg_shipping, {avg('Profit_Estimated')} AS avg_estimated_profit,
       {avg('Profit_Actual')} AS avg_profit, {avg('OrderWeight', 3)} AS avg_weight
FROM settled o GROUP BY 1"""

# -- fulfilment --------------------------------------------------------------

SQL["fulfilment_weekly"] = f"""
WITH shipped AS (
  SELECT CAST(date_trunc('week', CreatedOnUtc) AS DATE) AS week, date_sub('hour', PaidDateUtc, ShippedDateUtc) AS h
  FROM order_header WHERE CreatedOnUtc < {AS_OF} - INTERVAL 5 DAY AND OrderStatusId <> 40
    AND ShippedDateUtc IS NOT NULL AND PaidDateUtc IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY week ORDER BY h) AS rn, count(*) OVER (PARTITION BY week) AS cnt FROM shipped)
SELECT week, count(*) AS orders, CAST({rank_at('0.5', 'h')} AS DOUBLE) AS median_hours,
       CAST({rank_at('0.9', 'h')} AS DOUBLE) AS p90_hours, {pct(n('h > 48'), n())} AS late_pct
FROM ranked GROUP BY week"""

SQL["tag_share_weekly"] = f"""
WITH o2 AS (SELECT CAST(date_trunc('week', OrderCreatedOnUtc) AS DATE) AS week, {HAS.format(tag=38)} AS hit
  FROM settled o WHERE OrderCreatedOnUtc < {AS_OF} - INTERVAL 5 DAY)
SELECT week, count(*) AS orders, {n('hit')} AS tagged, {pct(n('hit'), n(), 2)} AS tagged_pct FROM o2 GROUP BY week"""

SQL["upgrade_counterfactual"] = f"""
WITH dane AS (
  SELECT s.ShippingCountryIso2 AS country, ShipmentMethodName AS method, fShippingCostTotal AS cost,
         CASE WHEN OrderWeight <= 0.5 THEN 'a' WHEN OrderWeight <= 1.5 THEN 'b' WHEN OrderWeight <= 2.5 THEN 'c'
              WHEN OrderWeight <= 4 THEN 'd' ELSE 'e' END AS band, {HAS.format(tag=38)} AS up
  FROM settled o JOIN shipping_cost s USING (CustomerOrderId) WHERE OrderWeight > 0),
cheap AS (SELECT country, band, avg(CAST(cost AS DOUBLE)) AS mean, count(*) AS cnt FROM dane
          WHERE NOT up AND method LIKE 'AF%' GROUP BY 1, 2)
SELECT method, count(*) AS orders, {avg('cost')} AS avg_cost, {r('avg(mean)')} AS counterfactual,
       {r('avg(CAST(cost AS DOUBLE) - mean)')} AS surcharge, {r('sum(CAST(cost AS DOUBLE) - mean)', 0)} AS surcharge_total
FROM dane JOIN cheap USING (country, band) WHERE up AND method NOT LIKE 'AF%' AND cnt >= 5
GROUP BY method HAVING count(*) >= 2"""

SQL["promise_window"] = f"""
WITH hours AS (
  SELECT strftime(OrderCreatedOnUtc, '%Y-%m') AS month,
         date_sub('hour', OrderCreatedOnUtc, strptime(nullif(regexp_extract(Note,
           '\\((\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}})Z\\)', 1), ''), '%Y-%m-%d %H:%M:%S')) AS h
  FROM order_profit_tag JOIN settled USING (CustomerOrderId) WHERE TagId = 38),
ranked AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY h) AS rn, count(*) OVER (PARTITION BY month) AS cnt FROM hours)
SELECT month, count(*) AS orders, CAST({rank_at('0.5', 'h')} AS DOUBLE) AS median_hours,
       CAST({rank_at('0.1', 'h')} AS DOUBLE) AS p10_hours
FROM ranked GROUP BY month"""

SQL["tag_base_rate"] = f"""
WITH req AS (SELECT DISTINCT CustomerOrderId, trim(nullif(regexp_extract(Note, 'request to (.+)$', 1), '')) AS supplier
             FROM order_profit_tag WHERE TagId = 35),
o2 AS (SELECT Profit_Actual AS p, coalesce(supplier, '(base)') AS supplier FROM settled LEFT JOIN req USING (CustomerOrderId)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY supplier ORDER BY p) AS rn, count(*) OVER (PARTITION BY supplier) AS cnt FROM o2)
SELECT supplier, count(*) AS orders, {pct(n('p < 0'), n())} AS loss_pct, {avg('p')} AS avg_profit,
       {r(rank_at('0.5', 'p'))} AS median_profit, {r('sum(p) FILTER (WHERE p < 0)', 0)} AS loss, {r('sum(p)', 0)} AS net_result
FROM ranked GROUP BY supplier HAVING count(*) >= 10"""

BASE_RATE = f"SELECT *, {HAS.format(tag=35)} AS hit FROM settled o"
HIT_PCT = pct(n("hit AND Profit_Actual < 0"), n("hit"))
BASE_PCT = pct(n("NOT hit AND Profit_Actual < 0"), n("NOT hit"))


RATIO = quot(
    f"{n('hit AND Profit_Actual < 0')} * {n('NOT hit')}", f"{n('hit')} * {n('NOT hit AND Profit_Actual < 0')}", 1
)

SQL["tag_base_rate_monthly"] = f"""
SELECT strftime(OrderCreatedOnUtc, '%Y-%m') AS month, {n('hit')} AS tagged_orders, {HIT_PCT} AS tagged_loss_pct,
       {BASE_PCT} AS base_loss_pct, {RATIO} AS ratio,
       {r("CAST(sum(Profit_Actual) FILTER (WHERE hit) AS DOUBLE) / nullif(count(*) FILTER (WHERE hit), 0)")} AS tagged_avg_profit
FROM ({BASE_RATE}) GROUP BY 1"""

SQL["tag_base_rate_by_market"] = f"""
SELECT IdBookstore AS market, {n('hit')} AS tagged_orders, {HIT_PCT} AS tagged_loss_pct, {BASE_PCT} AS base_loss_pct
FROM ({BASE_RATE}) GROUP BY 1"""

FULFILLED = f"SELECT *, {HAS.format(tag=38)} AS up FROM order_fulfilment o WHERE ORDER_CREATED < {AS_OF}"

SQL["upgrade_vs_base"] = f"""
SELECT CASE WHEN up THEN 'upgraded' ELSE 'base' END AS cohort, count(*) AS orders,
       {pct('count(GOODS_ORDERED)', n())} AS purchase_pct, {avg('goods', 1)} AS goods_hours, {avg('packing', 1)} AS packing_hours,
       {avg('late', 1)} AS late_hours, {pct(n('late > 0'), n())} AS shipped_late_pct,
       {pct(n('NOT on_time'), 'count(on_time)')} AS delivered_late_pct
FROM ({FULFILLED}) GROUP BY 1"""

SQL["deadline_source_monthly"] = f"""
SELECT strftime(ORDER_CREATED, '%Y-%m') AS month, coalesce(ShipDeadlineSource, '(none)') AS deadline_source,
       count(*) AS orders, {n('up')} AS upgraded
FROM ({FULFILLED}) GROUP BY 1, 2"""

SQL["supplier_upgrade_rate"] = f"""
SELECT left(whole_name, 22) AS supplier, count(*) AS orders, {n('up')} AS upgraded, {pct(n('up'), n())} AS upgraded_pct,
       {avg('goods', 1)} AS goods_hours, {pct(n('late > 0'), n())} AS shipped_late_pct
FROM (SELECT *, supplier AS whole_name FROM ({FULFILLED})) WHERE GOODS_ORDERED IS NOT NULL
GROUP BY whole_name HAVING count(*) >= 20 ORDER BY upgraded_pct DESC, whole_name LIMIT 20"""

# -- cohorts -----------------------------------------------------------------

SQL["pilot_propagation"] = f"""
WITH sold AS (SELECT EAN, sum(Quantity) AS units, sum(ItemProfit) AS profit
  FROM order_item_profit JOIN order_profit USING (CustomerOrderId)
  WHERE OrderStatusId <> 40 AND IdBookstore LIKE 'BUILD%' GROUP BY EAN),
j AS (
  SELECT s.OurEan, round(s.Price, 2) AS forced, RetailerId AS rid, FulfilmentMethod AS f, BestOfferPrice AS best,
         HasOffer AS has, LastCheckedUtc AS checked, units, profit,
         (SELECT Price FROM price_offer o WHERE o.SKU = s.OurEan ORDER BY LastUpdatedOnUtc DESC, Id DESC LIMIT 1) AS po,
         (SELECT PriceMin FROM price_offer o WHERE o.SKU = s.OurEan ORDER BY LastUpdatedOnUtc DESC, Id DESC LIMIT 1) AS po_min,
         (SELECT min(BundlePrice) FROM our_offers_current l WHERE l.Ean = s.OurEan) AS live
  FROM offer_settings s JOIN buy_box_current b ON b.Ean = s.OurEan LEFT JOIN sold ON sold.EAN = s.OurEan
  WHERE s.BookstoreId = 'BUILDING' AND TestGroupName = 'pilot' AND fIsActive = 1
    AND EXISTS (SELECT 1 FROM price_offer o WHERE o.OurEan = s.OurEan AND NOT IsBlocked AND Quantity > 0))
SELECT count(*) AS pilot_products, {n("rid = 'R0'")} AS buy_box_ours,
       {n("rid <> 'R0' AND f = 'FBR'")} AS competitor_fbr, {n("rid <> 'R0' AND f = 'FBB'")} AS competitor_fbb,
       {n('rid IS NULL OR NOT has')} AS no_snapshot, {n('abs(po - forced) < 0.01')} AS forced_in_offer,
       {n('abs(live - forced) < 0.02')} AS forced_in_live_offer, {n("rid <> 'R0' AND best < forced")} AS competitor_undercut,
       {n("rid <> 'R0' AND has AND best < forced AND best - 0.02 >= po_min")} AS re_undercut_feasible,
       {n('units > 0')} AS products_sold, {big('coalesce(sum(units), 0)')} AS units,
       {r('coalesce(sum(profit), 0)', 0)} AS profit, {n("rid = 'R0' AND coalesce(units, 0) = 0")} AS buy_box_without_sales,
       strftime(max(checked), '%Y-%m-%d %H:%M') AS last_check
FROM j"""

SQL["sale_cohort_profitability"] = f"""
WITH lines AS (
  SELECT IdBookstore AS market, EAN, CustomerOrderId, Quantity AS q, ItemProfit AS p, UnitSalesPriceNet * Quantity AS rev,
         OrderCreatedOnUtc >= TIMESTAMP '1999-01-01' AS sale
  FROM order_item_profit JOIN order_profit USING (CustomerOrderId)
  WHERE OrderStatusId <> 40 AND OrderCreatedOnUtc >= TIMESTAMP '1999-01-01' - INTERVAL 1461 DAY),
sold AS (SELECT market, EAN, count(DISTINCT CustomerOrderId) FILTER (WHERE sale) AS so, sum(q) FILTER (WHERE sale) AS sq,
    sum(p) FILTER (WHERE sale) AS sp, sum(rev) FILTER (WHERE sale) AS sr, sum(q) FILTER (WHERE NOT sale) AS bq,
    sum(p) FILTER (WHERE NOT sale) AS bp, sum(rev) FILTER (WHERE NOT sale) AS br FROM lines GROUP BY 1, 2),
k AS (SELECT c.*, CAST(our_price - sale_price AS DOUBLE) / our_price AS disc,
        EXISTS (SELECT 1 FROM price_offer o WHERE o.SKU = c.sku AND o.BookstoreId = c.market AND Asin IS NOT NULL) AS seen
      FROM sale_cohort c)
SELECT k.market, count(*) AS skus, {n('seen AND p % 6 <> 0 AND p % 4 = 0')} AS buy_box_wins,
       {pct(n('seen AND p % 6 <> 0 AND p % 4 = 0'), n('seen'))} AS buy_box_win_pct,
       {r('100 * avg(disc)', 1)} AS avg_discount_pct, {big('coalesce(sum(so), 0)')} AS sale_orders,
       {big('coalesce(sum(sq), 0)')} AS sale_units, {r('coalesce(sum(sp), 0)')} AS sale_profit,
       {pct('sum(sp)', 'sum(sr)')} AS sale_margin_pct, {big('coalesce(sum(bq), 0)')} AS baseline_units,
       {r('coalesce(sum(bp), 0)')} AS baseline_profit, {pct('sum(bp)', 'sum(br)')} AS baseline_margin_pct
FROM k LEFT JOIN sold ON sold.market = k.market AND sold.EAN = k.sku GROUP BY k.market"""

SQL["ab_diff_in_diff"] = f"""
WITH lines AS (SELECT EAN, Quantity AS q, ItemProfit AS p, UnitSalesPriceNet * Quantity AS rev,
    OrderCreatedOnUtc >= TIMESTAMP '1999-01-01' AS test
  FROM order_item_profit JOIN order_profit USING (CustomerOrderId) WHERE OrderStatusId <> 40 AND IdBookstore = 'BUILDING'),
g AS (SELECT grp, count(DISTINCT c.EAN) AS products, sum(q) FILTER (WHERE test) AS tq, sum(p) FILTER (WHERE test) AS tp,
    sum(rev) FILTER (WHERE test) AS tr, sum(q) FILTER (WHERE NOT test) AS bq, sum(p) FILTER (WHERE NOT test) AS bp,
    count(DISTINCT b.Ean) FILTER (WHERE MarketplaceId = 'BUILDING' AND HasOffer AND RetailerId = 'R0') AS held
  FROM cohort c LEFT JOIN lines ON lines.EAN = c.EAN LEFT JOIN buy_box_current b ON b.Ean = c.EAN GROUP BY grp),
d AS (SELECT *, date_diff('day', DATE '1999-01-01', DATE '2001-08-02') AS td, date_diff('day', DATE '1995-01-01', DATE '1999-01-01') AS bd FROM g),
x AS (SELECT *, 100 * (CAST(tp AS DOUBLE) / td) / (CAST(bp AS DOUBLE) / bd) - 100 AS change FROM d)
SELECT CASE WHEN grp = 1 THEN 'test' ELSE 'control' END AS cohort, products, {quot('bq', 'bd')} AS units_per_day_baseline,
       {quot('tq', 'td')} AS units_per_day_test, {quot('bp', 'bd')} AS profit_per_day_baseline,
       {quot('tp', 'td')} AS profit_per_day_test, {r('change', 1)} AS profit_change_pct, {pct('tp', 'tr')} AS margin_pct,
       held AS buy_boxes_held, {big('tq')} AS test_units,
       {r('(SELECT change FROM x WHERE grp = 1) - (SELECT change FROM x WHERE grp = 0)', 1)} AS did_pct
FROM x"""

SQL["feed_format_sentinel"] = """
SELECT SupplierId AS supplier_id, count(DISTINCT stock) AS distinct_values FROM supplier_stock WHERE stock > 0 GROUP BY 1"""

SQL["cohort_exposure_bands"] = f"""
WITH st AS (SELECT c.EAN, coalesce((SELECT max(stock) FROM supplier_stock s WHERE s.EAN = c.EAN AND SupplierId = 4), 0) AS st,
    own_stock, coalesce(demand_label IN ('>10', '>50'), false) AS wanted FROM cohort c)
SELECT CASE WHEN st <= 0 THEN '0. none at the supplier' WHEN st = 1 THEN '1. exactly 1' WHEN st = 2 THEN '2. 2'
         WHEN st <= 5 THEN '3. 3-5' WHEN st <= 20 THEN '4. 6-20' ELSE '5. 21+' END AS supplier_stock,
       count(*) AS products, {n('own_stock > 0')} AS exposed, {pct(n('own_stock > 0'), n())} AS exposed_pct,
       {n('wanted')} AS with_demand, {n('wanted AND own_stock = 0')} AS with_demand_not_exposed,
       (SELECT count(DISTINCT stock) FROM supplier_stock WHERE SupplierId = 4 AND stock > 0) AS feed_distinct_values
FROM st GROUP BY 1"""

SQL["cohort_vs_rest"] = f"""
WITH w AS (SELECT *, CASE WHEN OrderCreatedOnUtc < TIMESTAMP '1998-01-01' THEN 'A. baseline'
    WHEN OrderCreatedOnUtc >= {AS_OF} - INTERVAL 700 DAY THEN 'C. recent' ELSE 'B. earlier' END AS period FROM order_profit),
l AS (SELECT w.period, CASE WHEN p_type = 'PROMO' THEN '1. listed' ELSE '2. rest' END AS cohort, w.OrderStatusId <> 40 AS ok,
    w.OrderStatusId <> 40 AND IsDoneCalculating AS closed, IsDoneCalculating AS done, Quantity AS q, ItemProfit AS p,
    UnitSalesPriceNet * Quantity AS rev, ShippedDateUtc, date_sub('hour', PaidDateUtc, ShippedDateUtc) AS h,
    CASE w.period WHEN 'A. baseline' THEN 1096 WHEN 'C. recent' THEN 700
         ELSE date_diff('day', DATE '1998-01-01', DATE '2001-08-02' - 700) END AS days
  FROM w JOIN order_item_profit i USING (CustomerOrderId) JOIN part ON CAST(p_partkey AS VARCHAR) = i.EAN
  LEFT JOIN order_header h ON h.Id = w.CustomerOrderId)
SELECT period, cohort, count(*) AS items, {quot('sum(q) FILTER (WHERE ok)', 'any_value(days)', 1)} AS units_per_day,
       {quot('sum(p) FILTER (WHERE closed)', 'any_value(days)')} AS profit_per_day,
       {pct('sum(p) FILTER (WHERE closed)', 'sum(rev) FILTER (WHERE closed)', 2)} AS margin_pct,
       {pct(n('done'), n())} AS closed_pct, {pct(n('NOT ok'), n(), 2)} AS cancelled_pct,
       {pct('count(ShippedDateUtc)', n())} AS shipped_pct, {r('avg(h / 24.0)')} AS avg_days_to_ship
FROM l GROUP BY 1, 2"""

SQL["coverage_diff"] = f"""
WITH s AS (SELECT Id, OrderStatusId, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = Id) AS there FROM order_header)
SELECT {n('there')} AS in_both, {n('NOT there')} AS only_left,
       (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey NOT IN (SELECT Id FROM order_header)) AS only_right,
       {n('NOT there AND OrderStatusId = 40')} AS only_left_placeholder
FROM s"""

SQL["latest_per_key"] = """
SELECT OurEan, Id, SKU, CAST(Price AS DOUBLE) AS price, LastUpdatedOnUtc FROM price_offer
QUALIFY row_number() OVER (PARTITION BY OurEan ORDER BY LastUpdatedOnUtc DESC, Id DESC) = 1"""

# -- baskets and events --------------------------------------------------------

RELATIVE = """
lines AS (
  SELECT CustomerOrderId AS order_id, EAN AS ean, CAST(date_trunc('month', CreatedOnUtc) AS DATE) AS period,
         CAST(CAST(UnitSalesPriceNet AS DOUBLE) / CAST(list_price AS DOUBLE) AS DECIMAL(18,8)) AS ratio
  FROM basket_item JOIN order_header ON Id = CustomerOrderId WHERE OrderStatusId <> 40),
medians AS (SELECT period, quantile_cont(CAST(ratio AS DOUBLE), 0.5) AS med FROM lines GROUP BY period),
rel AS (SELECT order_id, ean, period, CAST(CAST(ratio AS DOUBLE) / med AS DECIMAL(18,6)) AS rel FROM lines JOIN medians USING (period))"""

SQL["relative_price"] = f"WITH {RELATIVE} SELECT order_id, ean, period, CAST(rel AS DOUBLE) AS rel FROM rel"

SQL["bundle_attribution"] = f"""
WITH {RELATIVE},
pairs AS (SELECT Id AS b, min(CAST(p_partkey AS VARCHAR)) AS e1, max(CAST(p_partkey AS VARCHAR)) AS e2
  FROM bundle JOIN part ON p_partkey // 2 = Id WHERE SellySetId IS NOT NULL AND Visible GROUP BY Id HAVING count(*) = 2),
hits AS (SELECT b, r1.order_id, r1.rel BETWEEN 0.86 AND 0.94 AND r2.rel BETWEEN 0.86 AND 0.94 AS off,
    EXISTS (SELECT 1 FROM rel x WHERE x.order_id = r1.order_id AND x.ean NOT IN (e1, e2) AND x.rel > 0.97) AS contrast
  FROM pairs JOIN rel r1 ON r1.ean = e1 JOIN rel r2 ON r2.ean = e2 AND r2.order_id = r1.order_id)
SELECT '1. funnel' AS section, CAST(NULL AS BIGINT) AS orders, CAST(NULL AS BIGINT) AS bundles, count(*) AS defined,
       count(SellySetId) AS synced, {n('Visible')} AS visible FROM bundle
UNION ALL SELECT '2. sold through the bundle', count(DISTINCT order_id), count(DISTINCT b), NULL, NULL, NULL FROM hits WHERE off AND contrast
UNION ALL SELECT '3. discounted pair without contrast', count(DISTINCT order_id), count(DISTINCT b), NULL, NULL, NULL FROM hits WHERE off AND NOT contrast
UNION ALL SELECT '4. pair at full price', count(DISTINCT order_id), count(DISTINCT b), NULL, NULL, NULL FROM hits WHERE NOT off"""


def users(event: str) -> str:
    return f"count(DISTINCT user_id) FILTER (WHERE event_name = '{event}')"


def events(event: str) -> str:
    return n(f"event_name = '{event}'")


SQL["event_funnel"] = f"""
SELECT '1. clicks on the bundle block' AS metric, {events('nudge_click')} AS events, {users('nudge_click')} AS users, CAST(NULL AS DOUBLE) AS value FROM web_event
UNION ALL SELECT '2. product views', {events('view_item')}, {users('view_item')}, NULL FROM web_event
UNION ALL SELECT '3. added to cart', {events('add_to_cart')}, NULL, NULL FROM web_event
UNION ALL SELECT '4. purchases', {events('purchase')}, NULL, NULL FROM web_event
UNION ALL SELECT '5. clicks per 1000 views', NULL, NULL, {quot('1000 * ' + events('nudge_click'), events('view_item'))} FROM web_event
UNION ALL SELECT '6. bundle page views', {n("event_name = 'page_view' AND lower(page) LIKE '%zestaw%'")}, NULL, NULL FROM web_event"""

SQL["event_param"] = """
SELECT event_name, 'k' AS param, count(k) AS events, count(DISTINCT k) AS distinct_values FROM web_event GROUP BY 1
UNION ALL SELECT event_name, 'page_location', count(page), count(DISTINCT page) FROM web_event GROUP BY 1
UNION ALL SELECT event_name, 'absent', 0, 0 FROM web_event GROUP BY 1"""

SQL["missing_pairs"] = """
WITH codes AS (SELECT isbn13, own_ean AS ean, min(name) AS name, min(autor) AS autor, min(wydawnictwo) AS house,
        count(DISTINCT SupplierId) AS sup FROM supplier_feed
    WHERE length(isbn13) = 13 AND own_ean NOT IN ('-1', '') GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY isbn13 ORDER BY sup DESC, ean) AS rk FROM codes)
SELECT a.isbn13, a.ean AS code_a, b.ean AS code_b, left(a.name, 60) AS title, a.autor AS author, a.house AS publisher,
       least(a.sup, b.sup) AS confirmations
FROM ranked a JOIN ranked b ON a.isbn13 = b.isbn13 AND a.ean < b.ean
WHERE NOT EXISTS (SELECT 1 FROM replacement x WHERE (x.EAN = a.ean AND x.ReplacementEAN = b.ean)
                                                 OR (x.EAN = b.ean AND x.ReplacementEAN = a.ean))
ORDER BY confirmations DESC, a.isbn13, greatest(a.rk, b.rk), least(a.rk, b.rk) LIMIT 200"""

CATEGORY = """CASE WHEN counterparty LIKE 'Customer#00000001%' THEN 'key account' WHEN text LIKE 'BUILDING%' THEN 'construction'
    WHEN counterparty LIKE '%7' AND text LIKE '%1-URGENT' THEN 'express' WHEN text LIKE '%3-MEDIUM' THEN 'standard'
    ELSE 'uncategorised' END"""

SQL["rule_categorise"] = f"""
SELECT InvoiceId, NumerFaktury, counterparty, CAST(amount AS DOUBLE) AS amount, {CATEGORY} AS category FROM invoice"""
SQL["category_totals"] = f"""
SELECT {CATEGORY} AS category, count(*) AS invoices, {r('sum(amount)')} AS amount FROM invoice GROUP BY 1"""

SQL["key_correction_coverage"] = f"""
WITH o AS (SELECT DISTINCT BookstoreId AS market, SKU, OurEan, IsBlocked FROM price_offer)
SELECT market, count(*) AS codes, {n('SKU = OurEan')} AS mapped_plain,
       {n('SKU = OurEan OR NOT IsBlocked')} AS mapped_corrected, {pct(n('SKU = OurEan'), n())} AS plain_pct,
       {pct(n('SKU = OurEan OR NOT IsBlocked'), n())} AS corrected_pct
FROM o GROUP BY market"""

# -- billing and crawl ---------------------------------------------------------

SQL["net_cost"] = "SELECT month, service, sku, CAST(net AS DOUBLE) AS net FROM net_cost"


def cost_report(now: str, before: str, year: str, tax: str, watch: list[tuple[str, str, str]]) -> str:
    at = lambda month, where="true": f"(SELECT sum(net) FROM net_cost WHERE month = '{month}' AND {where})"
    gross = lambda month: (
        f"(SELECT CASE WHEN coalesce(sum(net) FILTER (WHERE service = '{tax}'), 0) > 0 THEN sum(net) "
        f"ELSE CAST(sum(net) FILTER (WHERE service <> '{tax}') * 1.23 AS DECIMAL(28,4)) END FROM net_cost WHERE month = '{month}')"
    )
    change = lambda a, b: pct(f"({a}) - ({b})", b, 0)
    parts = [
        f"""SELECT '1. total with tax' AS section, '{now}' AS item, {r(gross(now), 0)} AS cost, {r(gross(before), 0)} AS previous,
            {change(gross(now), gross(before))} AS change_pct, {change(gross(now), gross(year))} AS year_change_pct""",
        f"""SELECT * FROM (SELECT '2. top services' AS section, service AS item, {r('a', 0)} AS cost, {r('b', 0)} AS previous,
            {change('a', 'b')} AS change_pct, CAST(NULL AS DOUBLE) AS year_change_pct
            FROM (SELECT service, sum(net) FILTER (WHERE month = '{now}') AS a, sum(net) FILTER (WHERE month = '{before}') AS b
                  FROM net_cost WHERE service <> '{tax}' GROUP BY service) WHERE a IS NOT NULL ORDER BY a DESC, service LIMIT 5)""",
    ]
    for label, column, pattern in watch:
        a, b = at(now, f"{column} LIKE '{pattern}'"), at(before, f"{column} LIKE '{pattern}'")
        parts.append(
            f"SELECT '3. watched', '{label}', {r(a, 0)}, {r(b, 0)}, {change(a, b)}, CAST(NULL AS DOUBLE)"
        )
    return "\nUNION ALL ".join(parts)


WATCH = [("Promo parts", "sku", "PROMO%"), ("Returns", "service", "R")]
SQL["monthly_cost_report"] = cost_report("200107", "200106", "200007", "A", WATCH)
SQL["monthly_cost_report_untaxed"] = cost_report("200002", "200001", "199902", "Invoice", WATCH)

SQL["bot_classify"] = "SELECT bot, user_agent, count(*) AS requests FROM bot_request GROUP BY 1, 2"

CRAWL = f"""SELECT data_date, zone, b AS bot, edge_status, cache_status, count(*) AS requests, {big('sum(bytes)')} AS bytes,
       {r("CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) / count(value)", 4)} AS avg_origin_ms
FROM (SELECT *, '__ALL__' AS b FROM bot_request UNION ALL SELECT *, bot AS b FROM bot_request WHERE bot IS NOT NULL)
GROUP BY 1, 2, 3, 4, 5"""

SQL["crawl_daily"] = f"SELECT *, TIMESTAMP '2024-01-31' AS collected_at FROM ({CRAWL})"
ORIGIN = "cache_status IN ('miss', 'expired', 'dynamic', 'none', 'bypass', 'revalidated')"
SQL["origin_share"] = f"""
SELECT zone, bot, count(*) AS requests, {n(ORIGIN)} AS to_origin, {pct(n(ORIGIN), n(), 2)} AS origin_pct
FROM bot_request WHERE bot IS NOT NULL GROUP BY 1, 2"""

SQL["crawl_exact_rows"] = """
SELECT data_date, zone, '__EXACT__' AS bot, CAST(NULL AS INT) AS edge_status, CAST(NULL AS VARCHAR) AS cache_status,
       count(*) AS requests, CAST(NULL AS BIGINT) AS bytes, CAST(NULL AS DOUBLE) AS avg_origin_ms,
       TIMESTAMP '2024-01-31' AS collected_at
FROM bot_request GROUP BY 1, 2"""

SQL["sampled_calibration"] = f"""
WITH t AS (SELECT data_date, zone, count(*) AS exact, {n('edge_status <> 404')} AS sampled FROM bot_request GROUP BY 1, 2),
b AS (SELECT data_date, zone, bot, count(*) AS c FROM bot_request WHERE bot IS NOT NULL AND edge_status <> 404 GROUP BY 1, 2, 3)
SELECT data_date, zone, bot, c AS sampled, {quot('exact', 't.sampled', 4)} AS factor, {quot('c * exact', 't.sampled', 1)} AS scaled,
       {pct('c', 't.sampled', 2)} AS share_pct
FROM b JOIN t USING (data_date, zone)"""

# -- trust ---------------------------------------------------------------------


def health(name: str, table: str, key: str, column: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, count(*) AS cnt, count(*) - count(DISTINCT {key}) AS dup, "
        f"date_sub('hour', max({column}), TIMESTAMP '2001-11-04 06:00:00') AS age FROM {table}"
    )


WATCHED = [
    ("order_header", "order_header", "Id", "LastUpdateDateUtc"),
    ("order_item_profit", "order_item_profit", "Id", "LastUpdateOnUtc"),
    ("order_profit_tag", "order_profit_tag", "Id", "CreatedOnUtc"),
    ("price_offer", "price_offer", "Id", "LastUpdatedOnUtc"),
    ("orders", "orders", "o_orderkey", "o_orderdate"),
    ("events", "events", "event_id", "ts"),
]
SQL["mirror_health"] = f"""
WITH f AS ({' UNION ALL '.join(health(*w) for w in WATCHED)})
SELECT table_name, cnt AS "rows", dup AS duplicate_keys, age AS age_hours,
       CASE WHEN dup > 0 AND age > 12 THEN 'duplicates and stale' WHEN dup > 0 THEN 'duplicate keys' ELSE 'stale' END AS status
FROM f WHERE dup > 0 OR (age > 12 AND table_name <> 'orders')"""


def stats(name: str, table: str, column: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, CAST(max({column}) AS DATE) AS modified, "
        f"date_diff('day', CAST(max({column}) AS DATE), DATE '2001-11-10') AS age_days, count(*) AS \"rows\" FROM {table}"
    )


CATALOG = " UNION ALL ".join(
    [stats(a, t, c) for a, t, _, c in WATCHED]
    + [stats("lineitem", "lineitem", "l_shipdate"), stats("lineitem_staging", "lineitem", "l_shipdate"),
       stats("crawl_daily", "events", "ts")]
)
SQL["catalog_stats"] = CATALOG

REGISTRY = """(VALUES ('orders', 'shop.dbo.orders', 'o_orderdate', 9999), ('lineitem', 'shop.dbo.lineitem', 'l_shipdate', 2),
  ('order_header', 'shop.dbo.order_header', 'LastUpdateDateUtc', 30),
  ('order_item_profit', 'shop.dbo.order_item', 'LastUpdateOnUtc', 60),
  ('price_offer', 'shop.dbo.price_offer', 'LastUpdatedOnUtc', 60), ('shipment_method', 'shop.dbo.shipment_method', NULL, 2),
  ('shipment_price', 'shop.dbo.shipment_price', NULL, 2)) AS reg(target, source, watermark, max_age_days)"""

SQL["registry_reconcile"] = f"""
WITH cat AS (SELECT * FROM ({CATALOG}) WHERE table_name NOT LIKE '%_staging')
SELECT 1 AS severity_order, target AS table_name, 'missing' AS problem, CAST(NULL AS DATE) AS modified,
       CAST(NULL AS BIGINT) AS age_days, CAST(NULL AS BIGINT) AS "rows", CAST(NULL AS BIGINT) AS max_age_days, source
FROM {REGISTRY} WHERE target NOT IN (SELECT table_name FROM cat)
UNION ALL SELECT 2, target, 'stale', modified, age_days, "rows", CAST(max_age_days AS BIGINT), source
FROM {REGISTRY} JOIN cat ON table_name = target WHERE age_days > max_age_days
UNION ALL SELECT 3, table_name, 'not registered', modified, age_days, "rows", NULL, NULL
FROM cat WHERE table_name NOT IN (SELECT target FROM {REGISTRY}) AND table_name <> 'crawl_daily'"""

SQL["coverage_vs_expected"] = """
WITH eu AS (SELECT unnest(['AZ-DE','AZ-UK','AZ-FR','AZ-IT','AZ-ES','AZ-NL','AZ-BE','AZ-SE','AZ-PL','AZ-IE']) AS market),
expected AS (
  SELECT 'GET_V2_SELLER_PERFORMANCE_REPORT' AS report, market, 2 AS days FROM eu
  UNION ALL SELECT 'GET_V2_SELLER_PERFORMANCE_REPORT', unnest(['AZ-US','AZ-CA','AZ-AU']), 2
  UNION ALL SELECT 'GET_SELLER_FEEDBACK_DATA', market, 2 FROM eu
  UNION ALL SELECT 'GET_FLAT_FILE_RETURNS_DATA_BY_RETURN_DATE', unnest(['AZ-DE','AZ-UK','AZ-FR','AZ-IT','AZ-ES']), 4),
landed2 AS (
  SELECT report, label AS market, landed, status, content FROM report_landing
  UNION ALL SELECT report, market, landed, status, content FROM report_landing JOIN eu ON label = 'EU'
  UNION ALL SELECT report, unnest(['AZ-US', 'AZ-CA']), landed, status, content FROM report_landing WHERE label = 'NA'),
have AS (SELECT report, market,
    max(landed) FILTER (WHERE status IN ('LANDED', 'EMPTY') OR (status IS NULL AND content > 0)) AS last,
    count(*) FILTER (WHERE status IN ('LANDED', 'EMPTY') OR (status IS NULL AND content > 0)) AS good,
    count(*) FILTER (WHERE status = 'FAILED') AS bad FROM landed2 GROUP BY 1, 2)
SELECT report, market, last AS last_success, date_diff('day', last, DATE '2024-02-03') AS days_ago,
       coalesce(good, 0) AS successes, coalesce(bad, 0) AS failures,
       CASE WHEN last IS NULL THEN '1. never' WHEN date_diff('day', last, DATE '2024-02-03') > days * 3 THEN '2. dead' ELSE '3. late' END AS state
FROM expected LEFT JOIN have USING (report, market)
WHERE last IS NULL OR date_diff('day', last, DATE '2024-02-03') > days"""

SQL["silence_alarm"] = """
SELECT 'events' AS source, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS last_event,
       date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-10') AS silent_days, count(*) AS events_total
FROM events HAVING date_diff('day', CAST(max(ts) AS DATE), DATE '2024-02-10') > 4"""

MEASURES = {
    "rows": "count(*)",
    "distinct_keys": "count(DISTINCT Id)",
    "max_time": "epoch(max(LastUpdateDateUtc))",
    "IdBookstore: non_null": "count(IdBookstore)",
    "IdBookstore: length": "sum(length(IdBookstore))",
    "ShippedDateUtc: non_null": "count(ShippedDateUtc)",
    "BillingName: non_null": "count(BillingName)",
    "BillingName: length": "sum(length(BillingName))",
    "BillingEmail: non_null": "count(BillingEmail)",
    "BillingEmail: length": "sum(length(BillingEmail))",
}


def measured(table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS measure, CAST({expr} AS BIGINT) AS v FROM {table}" for name, expr in MEASURES.items()
    )


SQL["source_target_reconcile"] = f"""
WITH tgt AS (SELECT * REPLACE (left(BillingName, 15) AS BillingName) FROM order_header WHERE OrderStatusId <> 40),
s AS ({measured('order_header')}), t AS ({measured('tgt')})
SELECT measure, s.v AS source_value, t.v AS target_value, s.v - t.v AS difference FROM s JOIN t USING (measure)"""

SQL["column_footprint"] = f"""
WITH s AS (
  SELECT 'doc_id' AS column_name, 8 * count(doc_id) AS b FROM documents
  UNION ALL SELECT 'text', sum(strlen(text)) FROM documents UNION ALL SELECT 'lang', sum(strlen(lang)) FROM documents
  UNION ALL SELECT 'source', sum(strlen(source)) FROM documents UNION ALL SELECT 'n_chars', 8 * count(n_chars) FROM documents)
SELECT column_name, {big('b')} AS bytes, {pct('b', '(SELECT sum(b) FROM s)', 2)} AS share_pct FROM s"""

SQL["severity"] = f"""
SELECT ean, losses, total_loss, CASE WHEN total_loss < -200 OR losses >= 10 THEN 'critical'
       WHEN losses >= 5 THEN 'warning' ELSE 'info' END AS severity FROM ({PROBLEMS})"""


def profile(table: str, column: str, placeholder: str, as_of: str) -> str:
    on = n(f"CAST({column} AS DATE) = DATE '{placeholder}'")
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS "rows", {n(f'{column} IS NULL')} AS nulls,
       CAST(max({column}) AS DATE) AS newest, {pct(on, n(), 2)} AS placeholder_pct,
       count(DISTINCT CAST({column} AS DATE)) AS distinct_days,
       {n(f"{column} BETWEEN TIMESTAMP '{as_of}' - INTERVAL 1 DAY AND TIMESTAMP '{as_of}'")} AS changed_last_day FROM {table}"""


SQL["watermark_profile"] = " UNION ALL ".join(
    [
        profile("orders", "o_orderdate", "1995-01-01", "2001-08-02"),
        profile("order_header", "ShippedDateUtc", "1977-06-14", "2001-08-02"),
        profile("events", "ts", "1977-06-14", "2024-01-30"),
    ]
)

SQL["run_checks_rows"] = f"""
SELECT 'loss_topk' AS "check", row_number() OVER (ORDER BY loss, order_id) AS row_no, order_id, cause,
       NULL AS tag, NULL AS orders, loss, NULL AS markets, NULL AS example,
       'https://panel.example/order?id=' || order_id AS link FROM ({SQL['loss_topk']})
UNION ALL SELECT 'loss_patterns', row_number() OVER (ORDER BY cause), NULL, cause, NULL, orders, loss, markets, NULL, NULL
  FROM ({SQL['loss_patterns']})
UNION ALL SELECT 'loss_by_tag', row_number() OVER (ORDER BY tag), NULL, NULL, tag, orders, loss, markets, example, NULL
  FROM ({SQL['loss_by_tag']})
UNION ALL SELECT 'silence_alarm', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL"""

SQL["run_checks_summary"] = f"""
SELECT 'loss_topk' AS "check", (SELECT count(*) FROM ({SQL['loss_topk']})) AS "rows", false AS silent, false AS failed
UNION ALL SELECT 'loss_patterns', (SELECT count(*) FROM ({SQL['loss_patterns']})), false, false
UNION ALL SELECT 'loss_by_tag', (SELECT count(*) FROM (SELECT TagId FROM losses JOIN known_tags USING (CustomerOrderId)
    GROUP BY TagId HAVING count(DISTINCT CustomerOrderId) >= 3)), false, false
UNION ALL SELECT 'silence_alarm', 1, false, false UNION ALL SELECT 'no_silence', 0, true, false
UNION ALL SELECT 'broken', NULL, false, true"""

# -- ingestion -------------------------------------------------------------------

STORED = "LastUpdateDateUtc < TIMESTAMP '2000-01-01'"
SQL["high_watermark"] = f"""
SELECT max(LastUpdateDateUtc) - INTERVAL 10 MINUTE AS mark FROM order_header WHERE {STORED}"""
SQL["delta_extract"] = f"""
SELECT Id, IdBookstore, LastUpdateDateUtc FROM order_header WHERE LastUpdateDateUtc >=
  (SELECT max(LastUpdateDateUtc) - INTERVAL 10 MINUTE FROM order_header WHERE {STORED})"""
SQL["key_chunks"] = """
WITH lim AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
win AS (SELECT lo, unnest(range(lo, hi + 1, 1000)) AS first_key FROM lim)
SELECT (first_key - lo) // 1000 AS chunk, first_key, first_key + 999 AS last_key,
       (SELECT count(*) FROM orders WHERE o_orderkey BETWEEN first_key AND first_key + 999) AS "rows"
FROM win"""
SQL["apply_contract"] = """
SELECT Id, IdBookstore, CAST(OrderStatusId AS VARCHAR) AS OrderStatusId, CAST(CreatedOnUtc AS DATE) AS CreatedOnUtc,
       PaidDateUtc, ShippedDateUtc, LastUpdateDateUtc, BillingName FROM order_header"""
MAIL = "CASE WHEN strpos(BillingEmail, '@') > 0 THEN 'xxx' || substr(BillingEmail, strpos(BillingEmail, '@')) WHEN BillingEmail IS NOT NULL THEN 'xxx' END"
SQL["mask_pii"] = f"SELECT Id, 'xxx' AS BillingName, {MAIL} AS BillingEmail FROM order_header"

DEDUP = """SELECT Id, EAN, Quantity, LastUpdateOnUtc FROM {t}
QUALIFY row_number() OVER (PARTITION BY Id ORDER BY LastUpdateOnUtc DESC, EAN DESC, Quantity DESC) = 1"""
SQL["dedup_latest"] = DEDUP.format(t="order_item_profit")
SQL["merge_upsert"] = f"""
WITH old AS ({DEDUP.format(t="(SELECT * FROM order_item_profit WHERE LastUpdateOnUtc < TIMESTAMP '2000-01-01')")}),
new AS ({DEDUP.format(t="(SELECT * REPLACE (Quantity + 100 AS Quantity) FROM order_item_profit WHERE LastUpdateOnUtc >= TIMESTAMP '1999-07-01')")})
SELECT * FROM new UNION ALL SELECT * FROM old WHERE Id NOT IN (SELECT Id FROM new)"""


def per_partition(table: str, created: str = "CreatedOnUtc") -> str:
    return f"""SELECT CAST(CAST(date_trunc('month', {created}) AS DATE) AS VARCHAR) AS "partition", count(*) AS "rows",
       count(DISTINCT Id) AS keys, count(BillingEmail) AS emails FROM {table} GROUP BY 1"""


SQL["full_reload"] = per_partition(f"(SELECT * FROM order_header WHERE {STORED})")
SQL["write_layout"] = per_partition("order_header")
SQL["sync_table"] = per_partition(
    "order_header", "CASE WHEN IdBookstore = 'BUILDING' THEN CreatedOnUtc + INTERVAL 1 MONTH ELSE CreatedOnUtc END"
)
SQL["replace_days"] = f"""
SELECT data_date, count(*) AS "rows", {big('sum(requests)')} AS requests FROM ({CRAWL}) GROUP BY 1"""
SQL["sync_all"] = """
SELECT 'orders' AS target, 'reload' AS mode, count(*) AS "rows", false AS failed FROM orders
UNION ALL SELECT 'customer', NULL, NULL, true
UNION ALL SELECT 'lineitem', 'reload', count(*), false FROM lineitem
UNION ALL SELECT 'orders', 'merge', count(*), false FROM orders
  WHERE o_orderdate >= (SELECT max(o_orderdate) - INTERVAL 10 MINUTE FROM orders)"""

ORACLE = {name: with_entities(text) for name, text in SQL.items()}
