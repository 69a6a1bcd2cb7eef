"""Baskets, web events and catalogue matching."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import first_match
from ..functions.money import dec, pct, row_count, share
from ..functions.quantiles import exact_quantiles
from ..functions.time import When, days_before, since, to_datetime, ts
from .filters import not_cancelled


# Sentinel keys that mean "no link".
NO_CODE = ("-1", "")
CART_EVENTS = ("add_to_cart",)


def relative_price(
    items: DataFrame,
    order_header: DataFrame,
    shop_price: DataFrame,
    *,
    as_of: When,
    days: int = 30,
    market: str | None = None,
    period: str = "day",
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Unit price over list price, divided by the period's median of that ratio.

    The median removes exchange rate and tax. It is found per period from
    counted values and joined back, instead of a window that would hold a whole
    period in one task. The joined lines are read three times (twice for the
    median); ``stage`` may store them in between. ``market`` is a LIKE pattern.
    """
    orders = order_header.where(since(F.col("CreatedOnUtc"), as_of, days) & not_cancelled())
    if market is not None:
        orders = orders.where(F.col("IdBookstore").like(market))
    orders = orders.select(
        F.col("Id").alias("CustomerOrderId"), F.date_trunc(period, "CreatedOnUtc").cast("date").alias("period")
    )
    priced = shop_price.where(F.col("Price") > 0).select(F.col("Ean").alias("EAN"), "Price")
    lines = (
        items.where(F.col("UnitSalesPriceNet") > 0)
        .select("CustomerOrderId", "EAN", "UnitSalesPriceNet")
        .join(orders, "CustomerOrderId")
        .join(priced, "EAN")
        .select(
            "CustomerOrderId",
            "EAN",
            "period",
            (F.col("UnitSalesPriceNet") / F.col("Price")).cast("decimal(18,8)").alias("ratio"),
        )
    )
    if stage is not None:
        lines = stage(lines)
    median = exact_quantiles(lines, ["period"], "ratio", {"median": 0.5}, interpolate=True)
    return lines.join(median, "period").select(
        F.col("CustomerOrderId").alias("order_id"),
        F.col("EAN").alias("ean"),
        "period",
        F.try_divide(F.col("ratio"), F.col("median")).cast("decimal(18,6)").alias("rel"),
    )


def bundle_hits(
    relative: DataFrame,
    bundle: DataFrame,
    component: DataFrame,
    *,
    low: float = 0.86,
    high: float = 0.94,
    full: float = 0.97,
) -> DataFrame:
    """Orders that hold both products of a visible two-product bundle.

    ``discounted`` and ``at_full_price`` say whether some pair of lines was inside
    the discount band, or not; ``contrast`` whether another product of the order
    was sold at full price. Lines are matched to bundles product by product and
    folded per (order, bundle); no pairs of lines are formed.
    """
    pairs = (
        component.join(
            bundle.where(F.col("SellySetId").isNotNull() & F.col("Visible")).select(
                F.col("Id").alias("BundleId")
            ),
            "BundleId",
        )
        .groupBy("BundleId")
        .agg(F.min("Ean").alias("ean1"), F.max("Ean").alias("ean2"), row_count().alias("parts"))
        .where(F.col("parts") == 2)
    )
    members = pairs.select(
        "BundleId",
        "ean1",
        "ean2",
        F.inline(
            F.array(
                F.struct(F.lit(1).alias("slot"), F.col("ean1").alias("ean")),
                F.struct(F.lit(2).alias("slot"), F.col("ean2").alias("ean")),
            )
        ),
    )
    lines = relative.withColumns(
        {
            "in_band": F.col("rel").between(dec(low), dec(high)),
            "is_full": F.when(F.col("rel") > dec(full), 1).otherwise(0),
        }
    )
    full_lines = lines.groupBy("order_id").agg(F.sum("is_full").alias("order_full"))
    slot = lambda n: F.col("slot") == n
    some = lambda cond: F.coalesce(F.bool_or(cond), F.lit(False))
    found = (
        lines.join(members, "ean")
        .groupBy("order_id", F.col("BundleId").alias("bundle_id"))
        .agg(
            some(slot(1)).alias("has1"),
            some(slot(2)).alias("has2"),
            some(slot(1) & F.col("in_band")).alias("off1"),
            some(slot(2) & F.col("in_band")).alias("off2"),
            some(slot(1) & ~F.col("in_band")).alias("not1"),
            some(slot(2) & ~F.col("in_band")).alias("not2"),
            # Once per line: a bundle of one product twice meets each line in both slots.
            F.sum(F.when(slot(1) | (F.col("ean1") != F.col("ean2")), F.col("is_full")).otherwise(0)).alias("pair_full"),
        )
        .where(F.col("has1") & F.col("has2"))
    )
    return found.join(full_lines, "order_id").select(
        "order_id",
        "bundle_id",
        (F.col("off1") & F.col("off2")).alias("discounted"),
        (F.col("not1") | F.col("not2")).alias("at_full_price"),
        (F.col("order_full") > F.col("pair_full")).alias("contrast"),
    )


def bundle_attribution(
    relative: DataFrame,
    bundle: DataFrame,
    component: DataFrame,
    *,
    low: float = 0.86,
    high: float = 0.94,
    full: float = 0.97,
) -> DataFrame:
    """Funnel of bundle definitions, then orders and bundles per kind of evidence."""
    funnel = bundle.agg(
        row_count().alias("defined"), F.count("SellySetId").alias("synced"), F.count_if("Visible").alias("visible")
    ).select(
        F.lit("1. funnel").alias("section"),
        F.lit(None).cast("bigint").alias("orders"),
        F.lit(None).cast("bigint").alias("bundles"),
        "defined",
        "synced",
        "visible",
    )
    hits = bundle_hits(relative, bundle, component, low=low, high=high, full=full)
    off, contrast = F.col("discounted"), F.col("contrast")
    kinds = (
        ("2. sold through the bundle", off & contrast),
        ("3. discounted pair without contrast", off & ~contrast),
        ("4. pair at full price", F.col("at_full_price")),
    )
    # Each hit stands for its order and for its bundle; their flags are folded before they are counted.
    flags = hits.select("order_id", "bundle_id", *[cond.alias(f"_f{i}") for i, (_, cond) in enumerate(kinds)])
    sides = [F.struct(F.lit(k).alias("_side"), F.col(k).cast("string").alias("_id")) for k in ("order_id", "bundle_id")]
    folded = (
        flags.select(F.explode(F.array(*sides)).alias("_s"), *[f"_f{i}" for i in range(len(kinds))])
        .groupBy("_s._side", "_s._id")
        .agg(*[F.bool_or(f"_f{i}").alias(f"_f{i}") for i in range(len(kinds))])
    )
    counts = folded.agg(
        *[
            F.count_if(F.col(f"_f{i}") & (F.col("_side") == key)).alias(f"{key}_{i}")
            for i in range(len(kinds))
            for key in ("order_id", "bundle_id")
        ]
    )
    sections = counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("section"),
                        F.col(f"order_id_{i}").alias("orders"),
                        F.col(f"bundle_id_{i}").alias("bundles"),
                    )
                    for i, (name, _) in enumerate(kinds)
                ]
            )
        )
    )
    return funnel.unionByName(sections, allowMissingColumns=True)


def event_param(params: Column | str, key: str) -> Column:
    """Value of a key in an array of key/value structs; the first one wins."""
    p = F.col(params) if isinstance(params, str) else params
    return F.get(F.filter(p, lambda x: x["key"] == key), F.lit(0))["value"]


def event_params(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per event name and parameter: events that carry it, and its distinct values."""
    pairs = F.array(
        *[F.struct(F.lit(k).alias("param"), event_param("event_params", k).alias("value")) for k in keys]
    )
    return (
        events.select("event_name", F.inline(pairs))
        .groupBy("event_name", "param")
        .agg(F.count("value").alias("events"), F.count_distinct("value").alias("distinct_values"))
    )


def event_funnel(
    events: DataFrame,
    *,
    as_of: When,
    days: int = 7,
    url_pattern: str = "zestaw",
    cart_events: Sequence[str] = CART_EVENTS,
) -> DataFrame:
    """Clicks on the bundle block beside the traffic of the whole shop.

    Events are folded per user first, so distinct users are plain counts and a
    very active user is one row. A shop with its own cart events adds them to
    ``cart_events``.
    """
    name = F.col("event_name")
    url = F.lower(event_param("event_params", "page_location"))
    today = to_datetime(as_of).date()
    seen = events.where(
        (F.col("ts") >= ts(days_before(today, days))) & (F.col("ts") < ts(days_before(today, -1)))
    )
    per_user = seen.groupBy("user_pseudo_id").agg(
        F.count_if(name == "nudge_click").alias("clicks"),
        F.count_if(name == "view_item").alias("views"),
        F.count_if(name.isin(*cart_events)).alias("carts"),
        F.count_if(name == "purchase").alias("purchases"),
        F.count_if((name == "page_view") & url.rlike(url_pattern)).alias("pages"),
    )
    known = F.col("user_pseudo_id").isNotNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    sums = per_user.agg(
        total("clicks").alias("clicks"),
        F.count_if(known & (F.col("clicks") > 0)).alias("click_users"),
        total("views").alias("views"),
        F.count_if(known & (F.col("views") > 0)).alias("view_users"),
        total("carts").alias("carts"),
        total("purchases").alias("purchases"),
        total("pages").alias("pages"),
    )
    none = F.lit(None)
    row = lambda metric, events, users, value: F.struct(
        F.lit(metric).alias("metric"),
        events.cast("bigint").alias("events"),
        users.cast("bigint").alias("users"),
        value.cast("double").alias("value"),
    )
    return sums.select(
        F.inline(
            F.array(
                row("1. clicks on the bundle block", F.col("clicks"), F.col("click_users"), none),
                row("2. product views", F.col("views"), F.col("view_users"), none),
                row("3. added to cart", F.col("carts"), none, none),
                row("4. purchases", F.col("purchases"), none, none),
                row("5. clicks per 1000 views", none, none, share(F.col("clicks") * 1000, "views")),
                row("6. bundle page views", F.col("pages"), none, none),
            )
        )
    )


def missing_pairs(
    feed: DataFrame,
    replacement: DataFrame,
    *,
    min_suppliers: int = 2,
    k: int = 200,
    spread: int = 256,
) -> DataFrame:
    """The k best confirmed pairs of codes that share an ISBN and are not linked yet.

    A pair is confirmed by the suppliers of its weaker code. Codes of one ISBN are
    ranked by suppliers, then code; a pair is as strong as its later code, so the
    best pairs lie among the first codes. With L links touching the ISBN, the
    first J codes with J(J-1)/2 >= k + L must hold k unlinked pairs, if there are
    that many at all. Only those codes are paired: the number of pairs formed
    grows with k and the links, not with the square of the group. Ranking runs in
    ``spread`` slices per ISBN before it runs per ISBN.

    Title, author and publisher (``name``, ``autor``, ``wydawnictwo``) are the
    smallest that the feed gives for the first code of a pair, null where it gives
    none or has no such column.
    """
    usable = feed.where(
        (F.length("isbn13") == 13) & F.col("own_ean").isNotNull() & ~F.col("own_ean").isin(*NO_CODE)
    )
    codes = (
        usable.groupBy("isbn13", "own_ean")
        .agg(F.count_distinct("SupplierId").alias("suppliers"))
        .where(F.col("suppliers") >= min_suppliers)
    )
    a, b = F.least("EAN", "ReplacementEAN"), F.greatest("EAN", "ReplacementEAN")
    linked = (
        replacement.where(F.col("EAN").isNotNull() & F.col("ReplacementEAN").isNotNull())
        .select(a.alias("low"), b.alias("high"))
        .distinct()
    )
    degree = linked.groupBy(F.col("low").alias("own_ean")).agg(row_count().alias("links"))
    # Links are counted at their smaller code: a bound on those inside the group.
    need = (
        codes.join(degree, "own_ean", "left")
        .groupBy("isbn13")
        .agg(row_count().alias("codes"), F.coalesce(F.sum("links"), F.lit(0)).alias("links"))
        .where(F.col("codes") > 1)
        .select(
            "isbn13",
            (F.ceil((1 + F.sqrt(1 + 8.0 * (F.lit(k) + F.col("links")))) / 2) + 1).alias("first_codes"),
        )
    )
    order = (F.col("suppliers").desc(), F.col("own_ean"))
    slice_rank = F.row_number().over(Window.partitionBy("isbn13", "slice").orderBy(*order))
    group_rank = F.row_number().over(Window.partitionBy("isbn13").orderBy(*order))
    # The explicit repartition matters: rows that arrive hashed by ISBN would
    # otherwise count as clustered by (ISBN, slice) and stay in one task.
    leading = (
        codes.join(need, "isbn13")
        .withColumn("slice", F.pmod(F.xxhash64("own_ean"), F.lit(spread)))
        .repartition("isbn13", "slice")
        .withColumn("r", slice_rank)
        .where(F.col("r") <= F.col("first_codes"))
        .withColumn("r", group_rank)
        .where(F.col("r") <= F.col("first_codes"))
        .select("isbn13", "own_ean", "suppliers", "r")
    )
    first = leading.select("isbn13", F.col("own_ean").alias("e1"), F.col("r").alias("r1"))
    later = leading.select(
        "isbn13",
        F.col("own_ean").alias("e2"),
        F.col("r").alias("r2"),
        F.col("suppliers").alias("confirmations"),
    )
    pairs = (
        first.join(later, "isbn13")
        .where(F.col("r1") < F.col("r2"))
        .withColumns({"low": F.least("e1", "e2"), "high": F.greatest("e1", "e2")})
    )
    best = (
        pairs.join(linked, ["low", "high"], "left_anti")
        .orderBy(F.col("confirmations").desc(), "isbn13", "r2", "r1")
        .limit(k)
        .select("isbn13", F.col("low").alias("code_a"), F.col("high").alias("code_b"), "confirmations")
    )
    # Descriptions are looked up for the k pairs only, not carried through the
    # shuffles; the pairs of one code, at most k, meet its feed rows as one list.
    listed = best.groupBy("isbn13", "code_a").agg(
        F.collect_list(F.struct("code_b", F.col("confirmations").cast("bigint").alias("confirmations"))).alias("pairs")
    )
    given = lambda c: F.col(c) if c in feed.columns else F.lit(None).cast("string").alias(c)
    described = usable.select("isbn13", F.col("own_ean").alias("code_a"), "name", given("autor"), given("wydawnictwo"))
    return (
        described.join(listed, ["isbn13", "code_a"])
        .groupBy("isbn13", "code_a")
        .agg(
            F.left(F.min("name"), F.lit(60)).alias("title"),
            F.min("autor").alias("author"),
            F.min("wydawnictwo").alias("publisher"),
            F.first("pairs").alias("pairs"),
        )
        .select("isbn13", "code_a", "title", "author", "publisher", F.inline("pairs"))
        .select("isbn13", "code_a", "code_b", "title", "author", "publisher", "confirmations")
    )


def rule_categorise(
    invoices: DataFrame,
    rules: Sequence[tuple[str | None, str | None, str]],
    *,
    default: str = "uncategorised",
    correction_suffix: str = "/W",
) -> DataFrame:
    """Category of an invoice by the first rule that fits.

    A rule is (counterparty pattern, text pattern, category) with LIKE patterns;
    None matches anything. Rules are configuration, so they are compiled into one
    expression and invoices are read once, without a pattern join. Correction
    invoices (number ending in the suffix) are dropped, those without a number
    stay, repeated ids are kept once.
    """
    def fits(who: str | None, what: str | None) -> Column:
        cond = F.lit(True)
        if who is not None:
            cond = cond & F.col("counterparty").like(who)
        if what is not None:
            cond = cond & F.col("text").like(what)
        return cond

    category = first_match([(fits(who, what), name) for who, what, name in rules], default)
    correction = F.coalesce(F.col("NumerFaktury").endswith(correction_suffix), F.lit(False))
    kept = invoices.where(~correction)
    return (
        kept.groupBy("InvoiceId")
        .agg(F.max(F.struct("NumerFaktury", "counterparty", "text", "amount")).alias("i"))
        .select("InvoiceId", "i.*")
        .select("InvoiceId", "NumerFaktury", "counterparty", "amount", category.alias("category"))
    )


def category_totals(categorised: DataFrame) -> DataFrame:
    return categorised.groupBy("category").agg(
        row_count().alias("invoices"), F.round(F.sum("amount"), 2).cast("double").alias("amount")
    )


def key_correction_coverage(
    offered: DataFrame, own_codes: DataFrame, correction: DataFrame, *, by: Sequence[str] = ()
) -> DataFrame:
    """Share of supplier codes that map to own codes, without and with the correction map.

    ``offered`` and ``own_codes`` have a column ``code``; ``correction`` maps
    ``code`` to ``own_code``. Codes are reduced to distinct keys before the joins.
    """
    codes = offered.where(F.col("code").isNotNull()).select(*by, "code").distinct()
    own = own_codes.select(F.col("code").alias("own")).where(F.col("own").isNotNull()).distinct()
    fixed = correction.groupBy("code").agg(F.min("own_code").alias("own_code"))
    mapped = codes.join(fixed, "code", "left").withColumn("best", F.coalesce("own_code", "code"))
    direct = own.select(F.col("own").alias("code"), F.lit(True).alias("plain"))
    through = own.select(F.col("own").alias("best"), F.lit(True).alias("corrected"))
    joined = mapped.join(direct, "code", "left").join(through, "best", "left")
    return joined.groupBy(*by).agg(
        row_count().alias("codes"),
        F.count("plain").alias("mapped_plain"),
        F.count("corrected").alias("mapped_corrected"),
        pct(F.count("plain"), row_count()).alias("plain_pct"),
        pct(F.count("corrected"), row_count()).alias("corrected_pct"),
    )
