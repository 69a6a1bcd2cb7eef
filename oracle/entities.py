"""Entity definitions in SQL, as common table expressions.

The formulas are those of FIXTURES.md, written independently of the Spark code.
Divisions go through DECIMAL(28,10), because the division itself yields a double.
"""

from __future__ import annotations

import re


def m(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,4))"


def div(a: str, b: str) -> str:
    return f"CAST(CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) AS DECIMAL(28,10))"


EXT, DISC, TAX, QTY = (m(c) for c in ("l_extendedprice", "l_discount", "l_tax", "l_quantity"))
RETAIL, SIZE = m("p_retailprice"), m("p_size")
MARKET_OF = "(['AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY'])[CAST({k} % 5 AS INT) + 1]"


def market_of(k: str) -> str:
    return MARKET_OF.format(k=k)


AGENTS = (
    "['Googlebot/2.1','Googlebot-Image/1.0','Googlebot-Video/1.0','Google-Extended','GoogleOther',"
    "'AdsBot-Google','Storebot-Google','bingbot/2.0','YandexBot/3.0','Applebot/0.1','ClaudeBot/1.0',"
    "'GPTBot/1.1','OAI-SearchBot/1.0','PerplexityBot/1.0','Amazonbot/0.1','Bytespider','AhrefsBot/7.0',"
    "'SemrushBot/7','DataForSeoBot/1.0','facebookexternalhit/1.1','Firefox/128.0','Chrome/127.0',"
    "'Safari/605.1','Edg/126.0']"
)

#: The moment at which all reports look at the data.
AS_OF = "TIMESTAMP '2001-08-02'"

ENTITIES: dict[str, str] = {
    "order_sums": f"""
        SELECT l_orderkey, count(*) AS items,
               {m(f"sum({m(f'{EXT} * (1 - {DISC})')})")} AS net,
               {m(f"sum({m(f'{QTY} * {RETAIL}')})")} AS goods,
               {m(f"sum({m(f'{QTY} * {SIZE}')})")} AS volume,
               {m(f"sum({m(f'{EXT} * {TAX}')})")} AS taxes,
               min(l_returnflag || l_linestatus) AS method, min(l_returnflag) AS carrier
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""",
    "order_total": f"""
        SELECT s.*, o.*, c_mktsegment, n_name,
               CASE WHEN o_orderkey % 97 = 0 THEN {m('0')} ELSE net END AS total,
               {m('0.9 * goods')} AS product, {m('4 * volume')} AS shipping
        FROM order_sums s JOIN orders o ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "order_fees": f"""
        SELECT *, CASE WHEN total = 0 THEN {m('0')} ELSE {m(m('0.20 * total') + ' + taxes')} END AS fee,
               {m('total * (0.02 + (o_orderkey % 11) * 0.011)')} AS payment
        FROM order_total""",
    "order_profit": f"""
        SELECT o_orderkey AS CustomerOrderId, c_mktsegment AS IdBookstore, n_name AS ShippingCountryIso2,
               o_orderdate AS OrderCreatedOnUtc,
               CASE WHEN o_orderstatus = 'P' THEN 40 ELSE 30 END AS OrderStatusId,
               o_orderpriority <> '4-NOT SPECIFIED' AS IsDoneCalculating, items AS NumOfItems,
               {m('volume * 0.001')} AS OrderWeight, total AS fOrderTotal, product AS ProductCost,
               {m('product - (o_orderkey % 5 - 2) * 4')} AS ProductCost_Estimated,
               shipping AS ShippingCost, fee AS MarketplaceCost, payment AS PaymentCost,
               {m('5 * items')} AS HandlingCost, {m('2 * items')} AS PackagingCost,
               {m('total - product - shipping - fee - payment')} AS Profit_Actual,
               {m('total - product - shipping - fee - payment + (o_orderkey % 7 - 3) * 2')} AS Profit_Estimated,
               {m(div('100 * (total - product - shipping - fee - payment)', 'nullif(total, 0)'))} AS ProfitMargin,
               o_orderdate AS LastUpdatedOnUtc
        FROM order_fees""",
    "settled": """
        SELECT * FROM order_profit
        WHERE OrderCreatedOnUtc >= TIMESTAMP '1995-01-01' - INTERVAL 36 DAY
          AND OrderStatusId <> 40 AND IsDoneCalculating""",
    "losses": f"""
        SELECT *, CASE
            WHEN fOrderTotal < ProductCost THEN 1
            WHEN ShippingCost > fOrderTotal - ProductCost THEN 2
            WHEN {div('MarketplaceCost', 'nullif(fOrderTotal, 0)')} > 0.25 THEN 3
            WHEN {div('PaymentCost', 'nullif(fOrderTotal, 0)')} > 0.10 THEN 4 ELSE 5 END AS cause
        FROM settled WHERE Profit_Actual < 0""",
    "cause_names": """
        SELECT * FROM (VALUES (1, 'sold below product cost'), (2, 'shipping eats the margin'),
            (3, 'marketplace cost over 25%'), (4, 'payment cost over 10%'), (5, 'other / mixed'))
            AS v(cause, cause_label)""",
    "item_base": f"""
        SELECT l.*, p_size, p_retailprice,
               {m(m(div(EXT, QTY)) + f' * (1 - {DISC})')} AS sale,
               {m(f'0.9 * {RETAIL}')} AS purchase, {m(f'4 * {SIZE}')} AS ship
        FROM lineitem l JOIN part ON l_partkey = p_partkey""",
    "order_item_profit": f"""
        SELECT l_orderkey * 8 + l_linenumber AS Id, l_orderkey AS CustomerOrderId,
               CAST(l_partkey AS VARCHAR) AS EAN, CAST(l_quantity AS INT) AS Quantity,
               {m(f"{QTY} * (sale - purchase - {m(f'sale * (0.20 + {TAX})')} - ship)")} AS ItemProfit,
               sale AS UnitSalesPriceNet, purchase AS UnitPurchasePriceNet,
               {m('purchase - l_suppkey % 3')} AS UnitPurchasePriceNet_OfferTime,
               {m(f'sale * (0.20 + {TAX})')} AS OrderCostMinusShippingChargeForUnit,
               ship AS ShippingChargePlnNettoForUnit, l_shipdate AS LastUpdateOnUtc
        FROM item_base""",
    "order_profit_tag": """
        SELECT *, CASE TagId
                 WHEN 35 THEN 'request to Supplier#' || lpad(CAST(supp AS VARCHAR), 9, '0')
                 WHEN 38 THEN 'ship by (' || strftime(CreatedOnUtc, '%Y-%m-%d %H:%M:%S') || 'Z)'
                 ELSE 'tag ' || TagId || ' on line ' || line END AS Note
        FROM (SELECT l_orderkey * 8 + l_linenumber AS Id, l_orderkey AS CustomerOrderId,
                     ([1,10,13,16,22,24,33,35,38,43])[CAST((l_linenumber + l_suppkey) % 10 AS INT) + 1] AS TagId,
                     l_suppkey AS supp, l_linenumber AS line, l_returnflag AS Source, l_shipdate AS CreatedOnUtc
              FROM lineitem)""",
    "known_tags": f"SELECT * FROM order_profit_tag WHERE CreatedOnUtc <= {AS_OF}",
    "order_profit_revision": f"""
        SELECT l_orderkey AS CustomerOrderId, {m(f'{EXT} * (1 - {DISC})')} AS Profit_Actual,
               l_returnflag || l_linestatus AS Notes,
               l_shipdate + to_seconds(l_partkey) AS DeletedOnUtc
        FROM lineitem""",
    "shipping_cost": f"""
        SELECT o_orderkey AS CustomerOrderId, shipping AS fShippingCostTotal,
               {m('shipping * (0.85 + (o_orderkey % 9) * 0.05)')} AS ShippingCostTotal_EstimatedPreShipments,
               method AS ShipmentMethodName, carrier AS ShippingCompany, n_name AS ShippingCountryIso2
        FROM order_total""",
    "marketplace_cost": f"""
        SELECT CustomerOrderId, MarketplaceCost AS fMarketplaceCost,
               {m('0.20 * fOrderTotal')} AS ReferralFee_Actual,
               {m('MarketplaceCost - ' + m('0.20 * fOrderTotal'))} AS ClosingFees_Actual
        FROM order_profit WHERE IsDoneCalculating""",
    "payment_cost": """
        SELECT CustomerOrderId, PaymentCost AS fPaymentCost FROM order_profit WHERE OrderStatusId <> 40""",
    "order_header": """
        SELECT *, coalesce(ShippedDateUtc, PaidDateUtc) AS LastUpdateDateUtc FROM (
          SELECT o_orderkey AS Id, c_mktsegment AS IdBookstore,
               CASE WHEN o_orderstatus = 'P' THEN 40 ELSE 30 END AS OrderStatusId,
               o_orderdate AS CreatedOnUtc, o_orderdate + to_hours(o_orderkey % 24) AS PaidDateUtc,
               CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate + to_hours(o_orderkey % 24 + c_custkey % 120)
                    + INTERVAL 30 MINUTE END AS ShippedDateUtc,
               c_name AS BillingName,
               CASE WHEN c_custkey % 20 = 0 THEN NULL
                    WHEN c_custkey % 33 = 0 THEN lower(replace(c_name, '#', '.'))
                    ELSE lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example' END
                 AS BillingEmail
          FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "order_fulfilment": """
        SELECT o_orderkey AS CustomerOrderId, o_orderdate AS ORDER_CREATED,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate + to_hours(o_custkey % 24) END AS GOODS_ORDERED,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 72 + 0.5 END AS goods,
               o_custkey % 30 AS packing, o_orderkey % 50 - 35 AS late,
               CASE WHEN o_orderkey % 4 <> 0 THEN first_s ELSE last_s END AS supplier,
               CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 5 <> 0 END AS on_time,
               CASE o_orderkey % 3 WHEN 1 THEN 'carrier' WHEN 2 THEN 'market' END AS ShipDeadlineSource
        FROM orders JOIN (SELECT l_orderkey,
                            'Supplier#' || lpad(CAST(min(l_suppkey) AS VARCHAR), 9, '0') AS first_s,
                            'Supplier#' || lpad(CAST(max(l_suppkey) AS VARCHAR), 9, '0') AS last_s
                          FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
    "supplied": """
        SELECT l_partkey AS p, l_suppkey AS s, min(l_shipdate) AS first_day, max(l_shipdate) AS last_day,
               any_value(p_retailprice) AS p_retailprice
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
    "price_offer": f"""
        SELECT p * 1000000 + s AS Id, {market_of('p')} AS BookstoreId, CAST(p AS VARCHAR) AS OurEan,
               CAST(p AS VARCHAR) || CASE WHEN s % 2 = 0 THEN '' ELSE '-U' END AS SKU,
               CASE WHEN s % 3 <> 0 THEN 'B' || p END AS Asin,
               {m(RETAIL + ' + (s % 5) * 0.5')} AS Price, {m(RETAIL + ' * 0.9')} AS PriceMin,
               s % 4 AS Quantity, p % 7 = 0 AS IsBlocked, first_day AS CreatedOnUtc,
               last_day AS LastSubmittedOnUtc, last_day AS LastUpdatedOnUtc
        FROM supplied""",
    "offer_settings": f"""
        SELECT CAST(p_partkey AS VARCHAR) AS OurEan, {market_of('p_partkey')} AS BookstoreId,
               CASE WHEN p_partkey % 3 = 0 THEN 'pilot' ELSE 'standard' END AS TestGroupName,
               {m(RETAIL + ' + 0.5')} AS Price, CASE WHEN p_partkey % 4 <> 3 THEN 1 ELSE 0 END AS fIsActive
        FROM part""",
    "buy_box_current": f"""
        SELECT CAST(p_partkey AS VARCHAR) AS Ean, {market_of('p_partkey')} AS MarketplaceId,
               CASE WHEN p_partkey % 11 <> 0 THEN 'R' || (p_partkey % 4) END AS RetailerId,
               CASE WHEN p_partkey % 2 = 0 THEN 'FBR' ELSE 'FBB' END AS FulfilmentMethod,
               {m(RETAIL + ' + (p_partkey % 5) * 0.25')} AS BestOfferPrice, p_partkey % 13 <> 0 AS HasOffer,
               TIMESTAMP '2001-08-01 00:00:00' + to_minutes(p_partkey % 1440) AS LastCheckedUtc
        FROM part""",
    "our_offers_current": f"""
        SELECT CAST(p AS VARCHAR) AS Ean, {market_of('p')} AS MarketplaceId,
               {m(RETAIL + ' + (s % 3) * 0.5')} AS BundlePrice FROM supplied""",
    "sale_cohort": f"""
        SELECT {market_of('p_partkey')} AS market, p_partkey AS p, CAST(p_partkey AS VARCHAR) AS sku,
               {RETAIL} AS our_price, {m(RETAIL + ' * (0.95 - (p_partkey % 3) * 0.05)')} AS sale_price
        FROM part""",
    "supplier_stock": """
        SELECT p * 1000000 + s AS Id, CAST(p AS VARCHAR) AS EAN, s % 10 AS SupplierId,
               (p * s) % 30 - 1 AS stock, last_day AS LastUpdated FROM supplied""",
    "cohort": """
        SELECT CAST(p_partkey AS VARCHAR) AS EAN, p_partkey % 2 AS grp,
               CASE p_partkey % 4 WHEN 0 THEN '>10' WHEN 1 THEN '>50' WHEN 2 THEN '0' END AS demand_label,
               (p_partkey * 7) % 5 - 1 AS own_stock
        FROM part""",
    "basket_item": f"""
        SELECT l_orderkey AS CustomerOrderId, CAST(l_partkey AS VARCHAR) AS EAN,
               {m(f"{m('any_value(p_retailprice)')} * (1 - 2 * {m('min(l_discount)')})")} AS UnitSalesPriceNet,
               {m('any_value(p_retailprice)')} AS list_price
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey, l_partkey""",
    "bundle": """
        SELECT DISTINCT p_partkey // 2 AS Id, CASE WHEN (p_partkey // 2) % 10 <> 0 THEN p_partkey // 2 END AS SellySetId,
               (p_partkey // 2) % 3 <> 0 AS Visible FROM part""",
    "supplier_feed": """
        SELECT doc_id AS Id, left(md5(text), 13) AS isbn13,
               CASE WHEN doc_id % 50 = 0 THEN '-1' ELSE CAST(doc_id % 211 AS VARCHAR) END AS own_ean,
               lang || ':' || doc_id AS name, CASE WHEN doc_id % 9 <> 0 THEN lang END AS autor,
               'house ' || (doc_id % 7) AS wydawnictwo, source AS SupplierId FROM documents""",
    "replacement": """
        SELECT own_ean AS EAN, first_ean AS ReplacementEAN
        FROM supplier_feed JOIN (SELECT isbn13, min(own_ean) AS first_ean FROM supplier_feed
                                 WHERE own_ean <> '-1' GROUP BY isbn13) USING (isbn13)
        WHERE own_ean <> '-1' AND own_ean <> first_ean AND CAST(own_ean AS INT) % 2 = 0""",
    "web_event": """
        SELECT event_id, ts, user_id, CASE event_type WHEN 'click' THEN 'nudge_click' WHEN 'view' THEN 'view_item'
                 WHEN 'purchase' THEN 'purchase' WHEN 'signup' THEN 'add_to_cart'
                 WHEN 'error' THEN 'page_view' END AS event_name,
               json_extract_string(props, '$.k') AS k,
               'https://s.example/' || CASE WHEN event_id % 5 = 0 THEN 'Zestaw' ELSE 'karta' END AS page
        FROM events""",
    "request_log": f"""
        SELECT *, 'zone' || (user_id % 4) AS zone, ({AGENTS})[CAST(user_id % 24 AS INT) + 1] AS user_agent,
               CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 301 WHEN 'purchase' THEN 200
                    WHEN 'signup' THEN 404 WHEN 'error' THEN 500 END AS edge_status,
               (['hit','miss','expired','dynamic','none','bypass','revalidated','stale'])
                    [CAST(event_id % 8 AS INT) + 1] AS cache_status,
               CAST({m('value')} * 1000 AS BIGINT) AS bytes
        FROM events""",
    "bot_request": """
        SELECT *, CAST(ts AS DATE) AS data_date, CASE user_id % 24
                 WHEN 0 THEN 'Googlebot' WHEN 1 THEN 'Googlebot-Image' WHEN 2 THEN 'Googlebot-Video'
                 WHEN 3 THEN 'Google-Extended' WHEN 4 THEN 'GoogleOther' WHEN 5 THEN 'AdsBot-Google'
                 WHEN 6 THEN 'Storebot-Google' WHEN 7 THEN 'bingbot' WHEN 8 THEN 'YandexBot'
                 WHEN 9 THEN 'Applebot' WHEN 10 THEN 'ClaudeBot' WHEN 11 THEN 'GPTBot'
                 WHEN 12 THEN 'OAI-SearchBot' WHEN 13 THEN 'PerplexityBot' WHEN 14 THEN 'Amazonbot'
                 WHEN 15 THEN 'Bytespider' WHEN 16 THEN 'AhrefsBot' WHEN 17 THEN 'SemrushBot'
                 WHEN 18 THEN 'DataForSeoBot' WHEN 19 THEN 'facebookexternalhit' END AS bot
        FROM request_log""",
    "report_landing": f"""
        SELECT CASE event_type WHEN 'view' THEN 'GET_V2_SELLER_PERFORMANCE_REPORT'
                 WHEN 'signup' THEN 'GET_V2_SELLER_PERFORMANCE_REPORT'
                 WHEN 'click' THEN 'GET_SELLER_FEEDBACK_DATA' WHEN 'error' THEN 'GET_SELLER_FEEDBACK_DATA'
                 WHEN 'purchase' THEN 'GET_FLAT_FILE_RETURNS_DATA_BY_RETURN_DATE' END AS report,
               (['AZ-DE','AZ-UK','AZ-FR','AZ-IT','AZ-ES','AZ-NL','AZ-BE','AZ-SE','AZ-PL','AZ-US','EU','NA'])
                 [CAST(user_id % 12 AS INT) + 1] AS label,
               CAST(ts AS DATE) AS landed,
               CASE event_id % 5 WHEN 0 THEN 'LANDED' WHEN 1 THEN 'EMPTY' WHEN 2 THEN 'FAILED' END AS status,
               CASE WHEN event_id % 5 = 4 THEN 0 ELSE CAST({m('value')} * 100 AS BIGINT) END AS content
        FROM events""",
    "billing": f"""
        SELECT strftime(l_shipdate, '%Y%m') AS month, l_returnflag AS service, p_type AS sku,
               {EXT} AS cost,
               CASE WHEN l_linenumber = 1 THEN 0
                    ELSE {m(f'-{EXT} * {DISC}')} + {m(f'-{EXT} * {TAX}')} END AS credit
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "net_cost": """
        SELECT month, service, sku, sum(cost) + sum(credit) AS net FROM billing GROUP BY 1, 2, 3""",
    "invoice": f"""
        SELECT o_orderkey AS InvoiceId, 'FV/' || o_orderkey AS NumerFaktury, c_name AS counterparty,
               c_mktsegment || ' ' || o_orderpriority AS text, {m('o_totalprice')} AS amount
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 9 <> 0""",
}


def with_entities(query: str) -> str:
    """The query with every entity it names, in dependency order, as CTEs."""
    found: list[str] = []

    def need(text: str) -> None:
        for name, body in ENTITIES.items():
            if name not in found and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                need(body)
                if name not in found:
                    found.append(name)

    need(query)
    if not found:
        return query
    ctes = ",\n".join(f"{name} AS ({ENTITIES[name]})" for name in found)
    stripped = query.strip()
    if stripped[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{stripped[5:]}"
    return f"WITH {ctes}\n{stripped}"
