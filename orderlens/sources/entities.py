"""Order entities derived from star-schema tables.

The operators take entities (order_profit, shipping_cost, ...); this adapter
supplies them where only orders, line items, parts and events exist. The columns
and rules are those of FIXTURES.md, written as SQL expressions. Joins carry no
hints: the optimizer broadcasts a side by its measured size and splits skewed
partitions. Every amount is cast back to DECIMAL(18,4) after each step.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Tables

# Fixed values of the derivation.
TAGS = (1, 10, 13, 16, 22, 24, 33, 35, 38, 43)
MARKETS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
CACHE_STATES = ("hit", "miss", "expired", "dynamic", "none", "bypass", "revalidated", "stale")
AGENTS = (
    "Googlebot/2.1", "Googlebot-Image/1.0", "Googlebot-Video/1.0", "Google-Extended",
    "GoogleOther", "AdsBot-Google", "Storebot-Google", "bingbot/2.0", "YandexBot/3.0",
    "Applebot/0.1", "ClaudeBot/1.0", "GPTBot/1.1", "OAI-SearchBot/1.0", "PerplexityBot/1.0",
    "Amazonbot/0.1", "Bytespider", "AhrefsBot/7.0", "SemrushBot/7", "DataForSeoBot/1.0",
    "facebookexternalhit/1.1", "Firefox/128.0", "Chrome/127.0", "Safari/605.1", "Edg/126.0",
)
REPORTS = {
    "view": "GET_V2_SELLER_PERFORMANCE_REPORT",
    "click": "GET_SELLER_FEEDBACK_DATA",
    "purchase": "GET_FLAT_FILE_RETURNS_DATA_BY_RETURN_DATE",
    "signup": "GET_V2_SELLER_PERFORMANCE_REPORT",
    "error": "GET_SELLER_FEEDBACK_DATA",
}
LABELS = (
    "AZ-DE", "AZ-UK", "AZ-FR", "AZ-IT", "AZ-ES", "AZ-NL", "AZ-BE", "AZ-SE", "AZ-PL", "AZ-US",
    "EU", "NA",
)
EDGE_STATUS = {"view": 200, "click": 301, "purchase": 200, "signup": 404, "error": 500}
WEB_EVENTS = {
    "click": "nudge_click",
    "view": "view_item",
    "purchase": "purchase",
    "signup": "add_to_cart",
    "error": "page_view",
}


def money(expr: str) -> str:
    return f"cast({expr} AS decimal(18,4))"


def quoted(value: str | int | None) -> str:
    if value is None:
        return "cast(NULL AS string)"
    return f"'{value}'" if isinstance(value, str) else str(value)


def pick(values: tuple, index: str) -> str:
    """Element of a short literal list by a zero-based index."""
    return f"element_at(array({', '.join(map(quoted, values))}), cast({index} AS int) + 1)"


def lookup(names: dict, key: str) -> str:
    entries = ", ".join(quoted(x) for pair in names.items() for x in pair)
    return f"element_at(map({entries}), {key})"


def market_of(part_key: str) -> str:
    return pick(MARKETS, f"{part_key} % 5")


RETAIL, SIZE = money("p_retailprice"), money("p_size")
TAG = pick(TAGS, "(l_linenumber + l_suppkey) % 10")


# Line amounts are exact integers in units of 0.0001 until an entity shows them:
# prices, rates and quantities have two decimals, so their products have four.
# Long arithmetic per line is several times faster than decimals of 38 digits.
def cents(column: str) -> str:
    return f"cast(rint({column} * 100) AS bigint)"


def amount(units: str) -> str:
    """A count of 0.0001 units as DECIMAL(18,4)."""
    return money(f"cast({units} AS decimal(18,0)) * 0.0001")


def divided(units: str, by: str) -> str:
    """Non-negative units divided and rounded half up."""
    return f"((2 * ({units}) + {by}) div (2 * {by}))"


EXT, DISC, TAX = cents("l_extendedprice"), cents("l_discount"), cents("l_tax")
QTY, LIST = cents("l_quantity"), cents("p_retailprice")
NET = f"{EXT} * (100 - {DISC})"


class Entities:
    """Entity frames over one directory of tables. Nothing is computed until used."""

    def __init__(self, tables: Tables):
        self.t = tables

    # -- line level ---------------------------------------------------------

    @cached_property
    def _lines(self) -> DataFrame:
        """Line items with the price and size of their part."""
        part = self.t["part"].select("p_partkey", "p_retailprice", "p_size")
        return self.t["lineitem"].join(part, F.expr("l_partkey = p_partkey"))

    @cached_property
    def _order_sums(self) -> DataFrame:
        """One row per order, summed before any join on the order key.

        The smallest flag pair is taken as a number, which keeps the aggregation
        a hash aggregation.
        """
        return self._lines.groupBy("l_orderkey").agg(
            F.expr("count(*) AS items"),
            F.expr(f"sum({NET}) AS net"),
            F.expr(f"sum({QTY} * {LIST}) AS goods"),
            F.expr(f"sum({QTY} * p_size * 100) AS volume"),
            F.expr(f"sum({EXT} * {TAX}) AS taxes"),
            F.expr("min(ascii(l_returnflag) * 256 + ascii(l_linestatus)) AS flags"),
        )

    @cached_property
    def _costed(self) -> DataFrame:
        """Orders with every cost line in units, before they are cut into entities."""
        fee = f"{divided('total * 2', '10')} + taxes"
        return (
            self._order_sums.join(self.t["orders"], F.expr("l_orderkey = o_orderkey"))
            .join(self.t["customer"], F.expr("o_custkey = c_custkey"))
            .join(self.t["nation"], F.expr("c_nationkey = n_nationkey"))
            .selectExpr(
                "*",
                "if(o_orderkey % 97 = 0, 0L, net) AS total",
                f"{divided('goods * 9', '10')} AS product",
                "4 * volume AS shipping",
                f"if(total = 0, 0L, {fee}) AS market_fee",
                f"{divided('total * (20 + o_orderkey % 11 * 11)', '1000')} AS payment",
                "total - product - shipping - market_fee - payment AS profit",
            )
        )

    @cached_property
    def order_profit(self) -> DataFrame:
        return self._costed.selectExpr(
            "o_orderkey AS CustomerOrderId",
            "c_mktsegment AS IdBookstore",
            "n_name AS ShippingCountryIso2",
            "o_orderdate AS OrderCreatedOnUtc",
            "if(o_orderstatus = 'P', 40, 30) AS OrderStatusId",
            "o_orderpriority <> '4-NOT SPECIFIED' AS IsDoneCalculating",
            "items AS NumOfItems",
            f"{amount(divided('volume', '1000'))} AS OrderWeight",
            f"{amount('total')} AS fOrderTotal",
            f"{amount('product')} AS ProductCost",
            f"{amount('product - (o_orderkey % 5 - 2) * 40000')} AS ProductCost_Estimated",
            f"{amount('shipping')} AS ShippingCost",
            f"{amount('market_fee')} AS MarketplaceCost",
            f"{amount('payment')} AS PaymentCost",
            f"{money('5 * items')} AS HandlingCost",
            f"{money('2 * items')} AS PackagingCost",
            f"{amount('profit')} AS Profit_Actual",
            f"{amount('profit + (o_orderkey % 7 - 3) * 20000')} AS Profit_Estimated",
            f"{money('try_divide(cast(100 * profit AS decimal(20,0)), cast(total AS decimal(18,0)))')} AS ProfitMargin",
            "o_orderdate AS LastUpdatedOnUtc",
        )

    @cached_property
    def order_item_profit(self) -> DataFrame:
        unit = divided(f"{EXT} * 10000", "qty")
        priced = self._lines.selectExpr(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            "l_quantity",
            "l_shipdate",
            f"{QTY} AS qty",
            f"{divided(f'{unit} * (100 - {DISC})', '100')} AS sale",
            f"{LIST} * 90 AS purchase",
            f"{divided(f'sale * (20 + {TAX})', '100')} AS indirect",
            "p_size * 40000L AS ship",
        )
        return priced.selectExpr(
            "l_orderkey * 8 + l_linenumber AS Id",
            "l_orderkey AS CustomerOrderId",
            "cast(l_partkey AS string) AS EAN",
            "cast(l_quantity AS int) AS Quantity",
            f"{amount('cast(l_quantity AS bigint) * (sale - purchase - indirect - ship)')} AS ItemProfit",
            f"{amount('sale')} AS UnitSalesPriceNet",
            f"{amount('purchase')} AS UnitPurchasePriceNet",
            f"{amount('purchase - l_suppkey % 3 * 10000')} AS UnitPurchasePriceNet_OfferTime",
            f"{amount('indirect')} AS OrderCostMinusShippingChargeForUnit",
            f"{amount('ship')} AS ShippingChargePlnNettoForUnit",
            "l_shipdate AS LastUpdateOnUtc",
        )

    @cached_property
    def order_profit_tag(self) -> DataFrame:
        return self.t["lineitem"].selectExpr(
            "l_orderkey * 8 + l_linenumber AS Id",
            "l_orderkey AS CustomerOrderId",
            f"{TAG} AS TagId",
            f"""CASE {TAG}
                WHEN 35 THEN format_string('request to Supplier#%09d', l_suppkey)
                WHEN 38 THEN format_string('ship by (%sZ)', date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss'))
                ELSE format_string('tag %d on line %d', {TAG}, l_linenumber) END AS Note""",
            "l_returnflag AS Source",
            f"format_string('tag %d', {TAG}) AS Description",
            "l_shipdate AS CreatedOnUtc",
        )

    @cached_property
    def order_profit_revision(self) -> DataFrame:
        return self.t["lineitem"].selectExpr(
            "l_orderkey AS CustomerOrderId",
            f"{amount(NET)} AS Profit_Actual",
            "l_returnflag || l_linestatus AS Notes",
            "date_trunc('year', l_shipdate) AS CreatedOnUtc",
            "l_shipdate + make_dt_interval(0, 0, 0, l_partkey) AS DeletedOnUtc",
        )

    # -- order level --------------------------------------------------------

    @cached_property
    def shipping_cost(self) -> DataFrame:
        return self._costed.selectExpr(
            "o_orderkey AS CustomerOrderId",
            f"{amount('shipping')} AS fShippingCostTotal",
            f"{amount(divided('shipping * (85 + o_orderkey % 9 * 5)', '100'))} AS ShippingCostTotal_EstimatedPreShipments",
            "char(flags div 256) || char(flags % 256) AS ShipmentMethodName",
            "char(flags div 256) AS ShippingCompany",
            "n_name AS ShippingCountryIso2",
            "o_orderdate AS LastUpdatedOnUtc",
        )

    @cached_property
    def marketplace_cost(self) -> DataFrame:
        """Orders under calculation have no row yet."""
        referral = money("0.20 * fOrderTotal")
        return self.order_profit.where("IsDoneCalculating").selectExpr(
            "CustomerOrderId",
            "MarketplaceCost AS fMarketplaceCost",
            f"{referral} AS ReferralFee_Actual",
            f"{money(f'MarketplaceCost - {referral}')} AS ClosingFees_Actual",
        )

    @cached_property
    def payment_cost(self) -> DataFrame:
        """Cancelled orders have no row."""
        return self.order_profit.where("OrderStatusId <> 40").selectExpr(
            "CustomerOrderId", "PaymentCost AS fPaymentCost"
        )

    @cached_property
    def order_header(self) -> DataFrame:
        return (
            self.t["orders"]
            .join(self.t["customer"], F.expr("o_custkey = c_custkey"))
            .selectExpr(
                "o_orderkey AS Id",
                "c_mktsegment AS IdBookstore",
                "if(o_orderstatus = 'P', 40, 30) AS OrderStatusId",
                "o_orderdate AS CreatedOnUtc",
                "o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 AS int)) AS PaidDateUtc",
                """if(o_orderkey % 10 <> 0,
                      PaidDateUtc + make_dt_interval(0, cast(c_custkey % 120 AS int), 30),
                      NULL) AS ShippedDateUtc""",
                "coalesce(ShippedDateUtc, PaidDateUtc) AS LastUpdateDateUtc",
                "c_name AS BillingName",
                """CASE WHEN c_custkey % 20 = 0 THEN NULL
                        WHEN c_custkey % 33 = 0 THEN lower(replace(c_name, '#', '.'))
                        ELSE lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example'
                   END AS BillingEmail""",
            )
        )

    @cached_property
    def order_fulfilment(self) -> DataFrame:
        sums = self.t["lineitem"].groupBy("l_orderkey").agg(
            F.expr("min(l_suppkey) AS first_s"), F.expr("max(l_suppkey) AS last_s")
        )
        return (
            self.t["orders"]
            .join(sums, F.expr("o_orderkey = l_orderkey"))
            .selectExpr(
                "o_orderkey AS CustomerOrderId",
                "o_orderdate AS ORDER_CREATED",
                """if(o_orderkey % 3 <> 0,
                      o_orderdate + make_dt_interval(0, cast(o_custkey % 24 AS int)), NULL) AS GOODS_ORDERED""",
                "if(o_orderkey % 3 <> 0, cast(o_orderkey % 72 AS double) + 0.5D, NULL) AS GOODS_RECEIVED_duration",
                "cast(o_custkey % 30 AS double) AS PACKING_duration",
                "cast(o_orderkey % 50 - 35 AS double) AS Hours_late_shipped",
                """if(o_orderkey % 4 <> 0, format_string('Supplier#%09d', first_s), NULL)
                   AS GOODS_RECEIVED_supplier""",
                "format_string('Supplier#%09d', last_s) AS GOODS_ORDERED_supplier",
                "if(o_orderkey % 6 <> 0, o_orderkey % 5 <> 0, NULL) AS IsReceivedOnTime",
                f"{pick((None, 'carrier', 'market'), 'o_orderkey % 3')} AS ShipDeadlineSource",
            )
        )

    # -- offers, stock, cohorts ----------------------------------------------

    @cached_property
    def _supplied(self) -> DataFrame:
        """(part, supplier) pairs with the first and last day they were shipped."""
        return (
            self.t["lineitem"]
            .groupBy("l_partkey", "l_suppkey")
            .agg(F.expr("min(l_shipdate) AS first_day"), F.expr("max(l_shipdate) AS last_day"))
            .join(self.t["part"].select("p_partkey", "p_retailprice"), F.expr("l_partkey = p_partkey"))
            .selectExpr("l_partkey AS p", "l_suppkey AS s", "first_day", "last_day", "p_retailprice")
        )

    @cached_property
    def price_offer(self) -> DataFrame:
        return self._supplied.selectExpr(
            "p * 1000000 + s AS Id",
            f"{market_of('p')} AS BookstoreId",
            "cast(p AS string) AS OurEan",
            "if(s % 2 = 0, cast(p AS string), cast(p AS string) || '-U') AS SKU",
            "if(s % 3 <> 0, 'B' || cast(p AS string), NULL) AS Asin",
            f"{money(f'{RETAIL} + (s % 5) * 0.5')} AS Price",
            f"{money(f'{RETAIL} * 0.9')} AS PriceMin",
            "cast(s % 4 AS int) AS Quantity",
            "p % 7 = 0 AS IsBlocked",
            "first_day AS CreatedOnUtc",
            "last_day AS LastSubmittedOnUtc",
            "last_day AS LastUpdatedOnUtc",
        )

    @cached_property
    def offer_settings(self) -> DataFrame:
        return self.t["part"].selectExpr(
            "p_partkey AS Id",
            "cast(p_partkey AS string) AS OurEan",
            f"{market_of('p_partkey')} AS BookstoreId",
            "if(p_partkey % 3 = 0, 'pilot', 'standard') AS TestGroupName",
            f"{money(f'{RETAIL} + 0.5')} AS Price",
            "if(p_partkey % 4 <> 3, 1, 0) AS fIsActive",
        )

    @cached_property
    def buy_box_current(self) -> DataFrame:
        return self.t["part"].selectExpr(
            "cast(p_partkey AS string) AS Ean",
            f"{market_of('p_partkey')} AS MarketplaceId",
            "if(p_partkey % 11 <> 0, 'R' || cast(p_partkey % 4 AS string), NULL) AS RetailerId",
            "if(p_partkey % 2 = 0, 'FBR', 'FBB') AS FulfilmentMethod",
            f"{money(f'{RETAIL} + (p_partkey % 5) * 0.25')} AS BestOfferPrice",
            "p_partkey % 13 <> 0 AS HasOffer",
            """TIMESTAMP '2001-08-01 00:00:00' + make_dt_interval(0, 0, cast(p_partkey % 1440 AS int))
               AS LastCheckedUtc""",
        )

    @cached_property
    def our_offers_current(self) -> DataFrame:
        return self._supplied.selectExpr(
            "cast(p AS string) AS Ean",
            f"{market_of('p')} AS MarketplaceId",
            f"{money(f'{RETAIL} + (s % 3) * 0.5')} AS BundlePrice",
        )

    @cached_property
    def buy_box_nested(self) -> DataFrame:
        return self.t["part"].selectExpr(
            "'B' || cast(p_partkey AS string) AS ASIN",
            f"{market_of('p_partkey')} AS MarketplaceID",
            f"""slice(array(named_struct('IsBuyBoxWinner', p_partkey % 4 = 0, 'Price', {RETAIL}),
                            named_struct('IsBuyBoxWinner', false, 'Price', {money(f'{RETAIL} + 1')})),
                      1, if(p_partkey % 6 = 0, 0, 2)) AS OurOffer""",
        )

    @cached_property
    def sale_cohort(self) -> DataFrame:
        return self.t["part"].selectExpr(
            f"{market_of('p_partkey')} AS market",
            f"{market_of('p_partkey')} AS marketplace_id",
            "cast(p_partkey AS string) AS sku",
            f"{RETAIL} AS our_price",
            f"{money(f'{RETAIL} * (0.95 - cast(p_partkey % 3 AS int) * 0.05)')} AS sale_price",
        )

    @cached_property
    def supplier_stock(self) -> DataFrame:
        return self._supplied.selectExpr(
            "p * 1000000 + s AS Id",
            "cast(p AS string) AS EAN",
            "s % 10 AS SupplierId",
            "cast((p * s) % 30 - 1 AS int) AS iloscDostepna",
            "last_day AS LastUpdated",
        )

    @cached_property
    def own_stock(self) -> DataFrame:
        return self.t["part"].selectExpr(
            "cast(p_partkey AS string) AS EAN",
            "cast((p_partkey * 7) % 5 - 1 AS int) AS fAll_StockQuantity",
        )

    @cached_property
    def cohort(self) -> DataFrame:
        return self.t["part"].selectExpr(
            "cast(p_partkey AS string) AS EAN",
            "cast(p_partkey % 2 AS int) AS grp",
            f"{pick(('>10', '>50', '0', None), 'p_partkey % 4')} AS demand_label",
        )

    @cached_property
    def listed(self) -> DataFrame:
        """The supplier's list: parts of one type."""
        return self.t["part"].where("p_type = 'PROMO'").selectExpr("cast(p_partkey AS string) AS EAN")

    @cached_property
    def shipment_method(self) -> DataFrame:
        return self.t["supplier"].selectExpr(
            "s_suppkey AS Id",
            "s_name AS ShipmentMethodName",
            "lower(s_name) AS ShipmentMethodFriendlyName",
            "s_suppkey % 2 = 0 AS isTrackable",
            "s_suppkey % 5 = 0 AS isConsolidated",
            "cast(s_nationkey AS string) AS AllowedRegion",
        )

    @cached_property
    def product_method(self) -> DataFrame:
        """Every supplier of a part ships it; suppliers beyond the list have no method."""
        return self._supplied.selectExpr(
            "cast(p AS string) AS EAN", "s + 5 AS ShipmentMethodId", "first_day AS CreatedOnUtc"
        )

    # -- baskets, feeds, events ------------------------------------------------

    @cached_property
    def basket_item(self) -> DataFrame:
        """One line per (order, product), at a price lowered by twice the discount."""
        cheapest = self.t["lineitem"].groupBy("l_orderkey", "l_partkey").agg(
            F.expr("min(l_discount) AS d")
        )
        part = self.t["part"].select("p_partkey", "p_retailprice")
        return cheapest.join(part, F.expr("l_partkey = p_partkey")).selectExpr(
            "l_orderkey AS CustomerOrderId",
            "cast(l_partkey AS string) AS EAN",
            f"{amount(LIST + ' * (100 - 2 * ' + cents('d') + ')')} AS UnitSalesPriceNet",
        )

    @cached_property
    def shop_price(self) -> DataFrame:
        return self.t["part"].selectExpr("cast(p_partkey AS string) AS Ean", f"{RETAIL} AS Price")

    @cached_property
    def bundle(self) -> DataFrame:
        return (
            self.t["part"]
            .selectExpr("p_partkey div 2 AS Id")
            .distinct()
            .selectExpr("Id", "if(Id % 10 <> 0, Id, NULL) AS SellySetId", "Id % 3 <> 0 AS Visible")
        )

    @cached_property
    def bundle_component(self) -> DataFrame:
        return self.t["part"].selectExpr(
            "p_partkey div 2 AS BundleId", "cast(p_partkey AS string) AS Ean", "1 AS Quantity"
        )

    @cached_property
    def supplier_feed(self) -> DataFrame:
        return self.t["documents"].selectExpr(
            "doc_id AS Id",
            "left(md5(cast(text AS binary)), 13) AS isbn13",
            "if(doc_id % 50 = 0, '-1', cast(doc_id % 211 AS string)) AS own_ean",
            "concat_ws(':', lang, cast(doc_id AS string)) AS name",
            "if(doc_id % 9 = 0, NULL, lang) AS autor",
            "concat('house ', cast(doc_id % 7 AS string)) AS wydawnictwo",
            "source AS SupplierId",
        )

    @cached_property
    def replacement(self) -> DataFrame:
        """Even codes are already paired with the smallest code of their ISBN."""
        feed = self.supplier_feed.where("own_ean <> '-1'")
        first = feed.groupBy("isbn13").agg(F.expr("min(own_ean) AS first_ean"))
        return (
            feed.join(first, "isbn13")
            .where("own_ean <> first_ean AND cast(own_ean AS int) % 2 = 0")
            .selectExpr("own_ean AS EAN", "first_ean AS ReplacementEAN", "0 AS Type")
        )

    @cached_property
    def web_event(self) -> DataFrame:
        return self.t["events"].selectExpr(
            f"{lookup(WEB_EVENTS, 'event_type')} AS event_name",
            "user_id AS user_pseudo_id",
            "ts",
            """array(named_struct('key', 'k', 'value', get_json_object(props, '$.k')),
                     named_struct('key', 'page_location', 'value',
                                  'https://s.example/' || if(event_id % 5 = 0, 'Zestaw', 'karta')))
               AS event_params""",
        )

    @cached_property
    def request_log(self) -> DataFrame:
        return self.t["events"].selectExpr(
            "ts",
            "'zone' || cast(user_id % 4 AS string) AS zone",
            f"{pick(AGENTS, 'user_id % 24')} AS user_agent",
            f"{lookup(EDGE_STATUS, 'event_type')} AS edge_status",
            f"{pick(CACHE_STATES, 'event_id % 8')} AS cache_status",
            f"cast({money('value')} * 1000 AS bigint) AS bytes",
            "value AS origin_ms",
        )

    @cached_property
    def report_landing(self) -> DataFrame:
        return self.t["events"].selectExpr(
            f"{lookup(REPORTS, 'event_type')} AS reportType",
            f"{pick(LABELS, 'user_id % 12')} AS market",
            "ts AS fetchedOnUtc",
            f"{pick(('LANDED', 'EMPTY', 'FAILED', None, None), 'event_id % 5')} AS status",
            f"if(event_id % 5 = 4, 0L, cast({money('value')} * 100 AS bigint)) AS contentBytes",
        )

    @cached_property
    def billing(self) -> DataFrame:
        credit = lambda rate: f"named_struct('amount', {amount(f'-{EXT} * {rate}')})"
        part = self.t["part"].select("p_partkey", "p_type")
        return self.t["lineitem"].join(part, F.expr("l_partkey = p_partkey")).selectExpr(
            "named_struct('month', date_format(l_shipdate, 'yyyyMM')) AS invoice",
            "named_struct('description', l_returnflag) AS service",
            "named_struct('description', p_type) AS sku",
            f"{money('l_extendedprice')} AS cost",
            f"slice(array({credit(DISC)}, {credit(TAX)}), 1, if(l_linenumber = 1, 0, 2)) AS credits",
            "cast(l_shipdate AS date) AS usage_day",
        )

    @cached_property
    def invoice(self) -> DataFrame:
        """Cost invoices: orders, with the customer as counterparty."""
        return (
            self.t["orders"]
            .join(self.t["customer"], F.expr("o_custkey = c_custkey"))
            .selectExpr(
                "o_orderkey AS InvoiceId",
                "format_string('FV/%d', o_orderkey) || if(o_orderkey % 9 = 0, '/W', '') AS NumerFaktury",
                "c_name AS counterparty",
                "concat_ws(' ', c_mktsegment, o_orderpriority) AS text",
                f"{money('o_totalprice')} AS amount",
            )
        )
