"""Named dimensions, facts, metrics and filters over the sales, customer and product views, and the query over them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import dates
from ledgerlake.functions.money import guarded_ratio, percent_change
from ledgerlake.operators.joins import assert_unique

Frame = Callable[[Sequence[str]], DataFrame]  # columns wanted -> view with at least these


@dataclass(frozen=True)
class Dimension:
    column: str
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Fact:
    column: str
    aggregation: str  # sum or avg
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Parts:
    """An aggregate taken apart: sums over rows and numbers of distinct values, and how they make the result. Sums of parts
    of the rows add up, so an aggregate can be made for many overlapping sets of rows in one pass, or from stored parts."""

    sums: tuple[Callable[[Column], Column], ...] = ()  # reporting day -> what a row adds
    distinct: tuple[str, ...] = ()
    combine: Callable[[Sequence[Column], Sequence[Column]], Column] = lambda sums, counts: (*sums, *counts)[0]


@dataclass(frozen=True)
class Metric:
    columns: tuple[str, ...]
    build: Callable[[Column], Column]  # reporting day -> aggregate
    synonyms: tuple[str, ...] = ()
    parts: Parts | None = None


@dataclass(frozen=True)
class Filter:
    """A predicate: a test of one column, or the days a time dimension may have."""

    column: str
    test: Callable[[Column], Column] | None = None
    synonyms: tuple[str, ...] = ()
    bounds: Callable[[Column], dates.Bounds] | None = None  # reporting day -> range

    def build(self, as_of: Column) -> Column:
        column = F.col(self.column)
        return self.test(column) if self.bounds is None else dates.within(column, self.bounds(as_of))


@dataclass(frozen=True)
class Entity:
    name: str
    key: tuple[str, ...]
    dimensions: dict[str, Dimension]
    time_dimensions: dict[str, Dimension] = field(default_factory=dict)
    facts: dict[str, Fact] = field(default_factory=dict)
    metrics: dict[str, Metric] = field(default_factory=dict)
    filters: dict[str, Filter] = field(default_factory=dict)


@dataclass(frozen=True)
class Relationship:
    """Many rows of ``left`` to one row of ``right``."""

    name: str
    left: str
    right: str
    columns: tuple[str, ...]


def _dimensions(*rows: tuple[str, list[str]]) -> dict[str, Dimension]:
    return {name: Dimension(name, tuple(synonyms)) for name, synonyms in rows}


# Dimension names and synonyms of the sales view.
SALES_DIMENSIONS = _dimensions(
    ("category", ["product category", "category name", "product type", "product line", "department", "product group"]),
    ("color", ["product color", "color variant", "colour", "color option", "product colour"]),
    ("size", ["product size", "size variant", "size option", "dog size", "product sizing"]),
    ("product_sku", ["sku", "product code", "item number", "article number", "product id"]),
    ("product_name", ["item name", "product description", "product title", "item description", "product"]),
    ("ean13", ["barcode", "ean", "product barcode", "ean code", "gtin"]),
    ("prestashop_match_status",
     ["match status", "data quality", "enrichment status", "product match", "prestashop enrichment"]),
    ("customer_id", ["customer number", "client id", "account id", "cust id", "customer code"]),
    ("customer_name", ["customer", "client name", "account name", "buyer", "client", "company name"]),
    ("customer_segment", ["customer type", "segment", "channel", "business type", "sales channel"]),
    ("customer_country",
     ["billing country", "customer nation", "account country", "registered country"]),
    ("customer_city", ["customer location", "city", "town", "customer town"]),
    ("delivery_country",
     ["country", "shipping country", "destination country", "sales country", "ship to country"]),
    ("market", ["market type", "domestic or international", "market segment", "sales market"]),
    ("invoice_id", ["invoice number", "order number", "order id", "invoice num", "booking number"]),
    ("line_id", ["line number", "invoice line", "line item", "line seq"]),
    ("invoice_currency", ["currency", "transaction currency", "invoice curr", "original currency"]),
)
SALES_TIME = _dimensions(
    ("sale_date", ["date", "invoice date", "order date", "transaction date", "booking date", "sales date"]),
)

# Facts with default aggregation and synonyms.
SALES_FACTS = {
    "line_revenue_dkk": Fact("line_revenue_dkk", "sum", (
        "revenue", "sales", "total sales", "sales amount", "net sales", "turnover")),
    "line_cost_dkk": Fact("line_cost_dkk", "sum", ("cost", "cogs", "total cost", "cost of goods")),
    "line_profit_dkk": Fact("line_profit_dkk", "sum", (
        "profit", "gross profit", "margin amount", "contribution", "earnings")),
    "product_revenue_dkk": Fact("product_revenue_dkk", "sum", (
        "product sales only", "merchandise sales", "goods revenue", "product only revenue")),
    "quantity_sold": Fact("quantity_sold", "sum", ("quantity", "units sold", "volume", "units", "pieces sold", "qty")),
    "unit_price_dkk": Fact("unit_price_dkk", "avg", (
        "unit price", "price per unit", "selling price", "item price", "unit selling price")),
    "unit_cost_dkk": Fact("unit_cost_dkk", "avg", ("unit cost", "cost per unit", "cogs per unit", "item cost")),
}


def _value(column: str) -> Callable[[Column], Column]:
    return lambda _: F.col(column)


def _sum(column: str, *synonyms: str) -> Metric:
    return Metric((column,), lambda _: F.sum(column), synonyms, Parts((_value(column),)))


def _distinct(column: str, *synonyms: str) -> Metric:
    return Metric((column,), lambda _: F.countDistinct(column), synonyms, Parts(distinct=(column,)))


def _margin(*synonyms: str) -> Metric:
    def share(profit: Column, revenue: Column) -> Column:
        return guarded_ratio(profit, revenue) * 100

    columns = ("line_profit_dkk", "line_revenue_dkk")
    return Metric(columns, lambda _: share(*map(F.sum, columns)), synonyms,
                  Parts(tuple(map(_value, columns)), combine=lambda sums, _: share(*sums)))


def order_value() -> Column:
    return guarded_ratio(F.sum("line_revenue_dkk"), F.countDistinct("invoice_id").cast("double"))


def _order_value(*synonyms: str) -> Metric:
    return Metric(("line_revenue_dkk", "invoice_id"), lambda _: order_value(), synonyms, Parts(
        (_value("line_revenue_dkk"),), ("invoice_id",), lambda sums, counts: guarded_ratio(sums[0], counts[0].cast("double"))))


def _growth(period: Callable[[Column, int], dates.Bounds], *synonyms: str) -> Metric:
    def within(offset: int) -> Callable[[Column], Column]:
        return lambda as_of: F.when(dates.within(F.col("sale_date"), period(as_of, offset)), F.col("line_revenue_dkk")).otherwise(0.0)

    def build(as_of: Column) -> Column:
        return percent_change(F.sum(within(0)(as_of)), F.sum(within(-1)(as_of)))

    return Metric(("sale_date", "line_revenue_dkk"), build, synonyms,
                  Parts((within(0), within(-1)), combine=lambda sums, _: percent_change(*sums)))


# Metric names and synonyms.
SALES_METRICS = {
    "total_revenue": _sum("line_revenue_dkk", "total sales", "sum of revenue", "total turnover", "gross revenue"),
    "total_profit": _sum("line_profit_dkk", "total gross profit", "sum of profit", "total earnings"),
    "profit_margin_pct": _margin("profit margin", "margin percentage", "gross margin", "margin pct"),
    "average_order_value": _order_value(
        "aov", "avg order value", "average invoice value", "average basket", "mean order value"),
    "total_orders": _distinct("invoice_id", "order count", "invoice count", "number of orders", "total invoices"),
    "total_customers": _distinct(
        "customer_id", "customer count", "unique customers", "number of customers", "distinct customers"),
    "total_units": _sum("quantity_sold", "units sold", "total quantity", "total volume", "pieces sold"),
    "revenue_growth_yoy_pct": _growth(
        dates.year_of, "year over year growth", "yoy growth", "annual growth", "yearly growth"),
    "revenue_growth_mom_pct": _growth(dates.month_of, "month over month growth", "mom growth", "monthly growth"),
}


def _equals(column: str, value: str | bool, *synonyms: str) -> Filter:
    return Filter(column, lambda c: c == F.lit(value), synonyms)


def _among(column: str, values: list[str], *synonyms: str) -> Filter:
    return Filter(column, lambda c: c.isin(*values), synonyms)


def _last_days(days: int, *synonyms: str) -> Filter:
    return Filter("sale_date", synonyms=synonyms, bounds=lambda as_of: dates.last_days(as_of, days))


def _period(period: Callable[[Column, int], dates.Bounds], offset: int, *synonyms: str) -> Filter:
    return Filter("sale_date", synonyms=synonyms, bounds=lambda as_of: period(as_of, offset))


# Filter names, synonyms, windows and value lists.
SALES_FILTERS = {
    "matched_products": _equals("prestashop_match_status", "Matched", "prestashop matched", "enriched products",
                                "matched only", "prestashop enriched"),
    "product_sales_only": _equals("prestashop_match_status", "Matched", "exclude adjustments", "products only",
                                  "no freight", "no discounts"),
    "current_year": _period(dates.year_of, 0, "this year", "year to date", "ytd", "current fiscal year"),
    "last_year": _period(dates.year_of, -1, "previous year", "prior year", "last fiscal year"),
    "last_week": _last_days(7, "past week", "previous week", "past 7 days"),
    "last_month": _last_days(30, "past month", "previous month", "past 30 days", "last 30 days"),
    "last_quarter": _last_days(90, "past quarter", "previous quarter", "last 90 days", "past 90 days"),
    "b2b_only": _equals("customer_segment", "B2B", "business customers only", "wholesale only", "b2b segment",
                        "business sales"),
    "b2c_only": _equals("customer_segment", "B2C", "consumer sales only", "direct sales only", "b2c segment",
                        "retail sales"),
    "this_month": _period(dates.month_of, 0, "current month", "month to date", "mtd", "this month to date"),
    "last_month_complete": _period(dates.month_of, -1, "previous month complete", "prior month", "last full month",
                                   "previous calendar month"),
    "this_quarter": _period(dates.quarter_of, 0, "current quarter", "quarter to date", "qtd", "this quarter to date"),
    "last_quarter_complete": _period(dates.quarter_of, -1, "previous quarter complete", "prior quarter",
                                     "last full quarter", "previous calendar quarter"),
    "top_categories": _among("category", ["Harnesses", "Leads", "Collars"], "main categories", "core products",
                             "primary categories", "key products"),
    "scandinavia": _among("delivery_country", ["Denmark", "Norway", "Sweden"], "nordic countries",
                          "scandinavian countries", "nordic region", "scandinavia region"),
    "dach_region": _among("delivery_country", ["Germany", "Austria", "Switzerland"], "dach",
                          "german speaking countries", "dach countries"),
    "western_europe": _among("delivery_country", ["France", "United Kingdom", "Netherlands", "Belgium", "Luxembourg"],
                             "western europe region", "west europe", "western european countries"),
}

SALES = Entity("sales", ("invoice_id", "line_id"), SALES_DIMENSIONS, SALES_TIME, SALES_FACTS, SALES_METRICS,
               SALES_FILTERS)
CUSTOMER = Entity("customer", ("customer_id",), _dimensions(
    ("customer_id", ["customer number", "client id", "account id", "cust id"]),
    ("customer_name", ["customer", "client name", "account name", "company name"]),
    ("customer_segment", ["customer type", "segment", "business type"]),
    ("customer_country", ["country", "nation", "registered country"]),
    ("customer_city", ["city", "location", "town"]),
    ("email_address", ["email", "contact email", "customer email"]),
    ("preferred_currency", ["currency", "default currency"]),
))
PRODUCT = Entity("product", ("product_sku",), _dimensions(
    ("product_sku", ["sku", "product code", "item number", "article number"]),
    ("product_name", ["item name", "product description", "product title"]),
    ("category_name", ["category", "product category", "product group"]),
    ("size", ["product size", "size variant", "size option"]),
    ("color", ["product color", "color variant", "colour"]),
    ("ean13", ["barcode", "ean", "gtin"]),
    ("is_active", ["active", "product active", "is available"]),
    ("variant_id", ["combination id", "prestashop variant id"]),
), _dimensions(("last_updated_date", ["last modified", "updated date", "last update"])), {
    "price_impact": Fact("price_impact", "avg", ("variant price adjustment", "price modifier")),
}, filters={
    "active_products": _equals("is_active", True, "active only", "available products", "current products"),
})
ENTITIES = {e.name: e for e in (SALES, CUSTOMER, PRODUCT)}
RELATIONSHIPS = (
    Relationship("sales_to_customer", "sales", "customer", ("customer_id",)),
    Relationship("sales_to_product", "sales", "product", ("product_sku",)),
)


def _bit(column: str, n: int) -> Column:
    return F.col(column).bitwiseAND(F.lit(1 << n)) != 0


def _counts(key: str, bits: int) -> Column:
    """Numbers of known values with each bit, from rows of one value each."""
    return F.array(*[F.count_if(F.col(key).isNotNull() & _bit("_bits", n)) for n in range(bits)]).alias(f"_c{key}")


def _find(items: dict, name: str):
    """Item by its name, else by synonym; case, spaces and underscores do not matter."""
    wanted = name.strip().lower().replace("_", " ")
    for key, item in items.items():
        if key.replace("_", " ") == wanted:
            return key, item
    for key, item in items.items():
        if wanted in item.synonyms:
            return key, item
    return None


class UnknownNameError(KeyError):
    """A dimension, metric or filter the entity does not have."""


@dataclass(frozen=True)
class _Selected:
    column: Column
    alias: str
    source: str


class SemanticModel:
    """Queries by name over entity views.

    ``frames`` gives, per entity, a function from the needed columns to a view having them; the sales view uses that
    to leave out lookups a question does not need. ``month_partition`` names the month column of a sales view stored
    by month: date ranges then also cut its partitions. ``prepare`` is told the date ranges of a question on sales before the view
    is read (rows outside all of them are not needed; none: every day), so that a store can add months it lacks.
    """

    def __init__(self, frames: dict[str, Frame], check_keys: bool = True, month_partition: str | None = None,
                 prepare: Callable[[list[dates.Bounds]], object] | None = None):
        self.frames = frames
        self.check_keys = check_keys
        self.month_partition = month_partition
        self.prepare = prepare

    def query(
        self, entity: str = "sales", dims: Iterable[str | tuple[str, str]] = (), metrics: Iterable[str] = (),
        filters: Iterable[str] = (), order_by: Sequence[tuple[str, str]] = (), limit: int | None = None,
        as_of: dt.date | str | None = None, where: Sequence[tuple[str, Callable[[Column], Column]]] = (),
        period: dates.Bounds | None = None,
    ) -> DataFrame:
        """Metrics by dimensions.

        A dimension is a name, a (time dimension, grain) pair, or ``entity.name`` for a related entity. A metric is a
        metric name or a fact name, which takes the fact's default aggregation. ``where`` adds predicates on a
        dimension as (name, test), ``period`` a range on the sale date. ``order_by`` names result columns with "asc"
        or "desc".
        """
        home = ENTITIES[entity]
        day = dates.as_of_date(as_of)
        selected = [self._dimension(home, d) for d in dims]
        own = [s for s in selected if s.source == home.name]
        related = [s for s in selected if s.source != home.name]
        measures = [self._measure(home, m, day) for m in metrics]
        tests = [self._filter(home, f) for f in filters]
        if period is not None:
            tests.append(Filter("sale_date", bounds=lambda _: period))
        tests += [Filter(self._own_column(home, name), test) for name, test in where]

        columns = {c for _, cs, _ in measures for c in cs} | {f.column for f in tests}
        columns |= {self._own_column(home, d) for d in dims} - {None}
        for s in related:
            columns |= set(self._relationship(home, s.source).columns)
        self._prepare(home, [f.bounds(day) for f in tests if f.bounds is not None])
        rows = self._rows(home, columns, tests, day)
        for source in {s.source for s in related}:
            rows = self._join(rows, home, source, [s for s in related if s.source == source])

        named = [s.column.alias(s.alias) for s in own] + [F.col(f"_{s.source}_{s.alias}").alias(s.alias) for s in related]
        if measures:
            result = rows.groupBy(*named).agg(*[build.alias(name) for name, _, build in measures])
        else:
            result = rows.select(*named).distinct()
        if order_by:
            result = result.orderBy(*[F.desc_nulls_last(c) if way == "desc" else F.asc_nulls_last(c)
                                      for c, way in order_by])
        return result if limit is None else result.limit(limit)

    def by_filter(
        self, filters: Sequence[str], metrics: Sequence[str], entity: str = "sales", as_of: dt.date | str | None = None,
    ) -> DataFrame:
        """Metrics per named filter in one pass over the view; a filter nothing passes has no row.

        The view is cut to rows passing any filter first, which reaches the scan when all are date ranges. No row is
        copied for a second filter: each carries a bit per filter it passes, and the few totals are dealt out at the end.
        """
        home, day = ENTITIES[entity], dates.as_of_date(as_of)
        tests = {name: self._filter(home, name) for name in filters}
        found = [self._parts(home, m) for m in metrics]
        columns = {c for _, cs, _ in found for c in cs} | {f.column for f in tests.values()}
        passes = [f.build(day) for f in tests.values()]
        ranges = [f.bounds(day) for f in tests.values() if f.bounds is not None]
        months = self.month_partition if home.name == "sales" and len(ranges) == len(tests) else None
        self._prepare(home, ranges if len(ranges) == len(tests) else [])
        rows = self._rows(home, columns | ({months} if months else set()), [], day).filter(reduce(or_, passes))
        if months:
            rows = rows.filter(reduce(or_, (dates.within_month(F.col(months), r) for r in ranges)))
        # One bit per filter. Sums are kept per filter; distinct values are counted once per value, by the bits of its rows.
        bits = reduce(lambda a, b: a.bitwiseOR(b), (F.when(p, F.lit(1 << n)).otherwise(F.lit(0)).cast("bigint") for n, p in enumerate(passes)))
        terms = [term for _, _, parts in found for term in parts.sums]
        ids = list(dict.fromkeys(c for _, _, parts in found for c in parts.distinct))
        rows = rows.select(bits.alias("_bits"), *[term(day).alias(f"_t{t}") for t, term in enumerate(terms)], *[F.col(c).alias(f"_d{d}") for d, c in enumerate(ids)])
        named = {f"_n{n}": F.count_if(_bit("_bits", n)) for n in range(len(passes))}
        named |= {f"_s{t}_{n}": F.sum(F.when(_bit("_bits", n), F.col(f"_t{t}"))) for t in range(len(terms)) for n in range(len(passes))}
        keys = [f"_d{d}" for d in range(len(ids))]
        totals = rows.groupBy(*keys).agg(F.bit_or("_bits").alias("_bits"), *[c.alias(name) for name, c in named.items()])
        sums = totals.agg(*[F.sum(name).alias(name) for name in named], *([_counts("_d0", len(passes))] if len(ids) == 1 else []))
        for key in keys if len(keys) > 1 else []:
            per_value = totals.groupBy(key).agg(F.bit_or("_bits").alias("_bits"))
            sums = sums.withColumn(f"_c{key}", per_value.agg(_counts(key, len(passes))).scalar())
        results = []
        for n, name in enumerate(tests):
            at, values = 0, []
            for metric, _, parts in found:
                own = [F.col(f"_s{at + t}_{n}") for t in range(len(parts.sums))]
                at += len(parts.sums)
                counts = [F.col(f"_c_d{ids.index(c)}")[n] for c in parts.distinct]
                values.append(parts.combine(own, counts).alias(metric))
            results.append(F.struct(F.lit(name).alias("filter_name"), F.col(f"_n{n}").alias("_rows"), *values))
        return sums.select(F.inline(F.array(*results))).where("_rows > 0").drop("_rows")

    def _prepare(self, home: Entity, ranges: list[dates.Bounds]) -> None:
        if home.name == "sales" and self.prepare is not None:
            self.prepare(ranges)

    def _rows(self, home: Entity, columns: set[str], tests: list[Filter], day: Column) -> DataFrame:
        ranges = [f for f in tests if f.bounds is not None]
        by_month = home.name == "sales" and self.month_partition is not None and ranges
        rows = self.frames[home.name](sorted(columns | ({self.month_partition} if by_month else set())))
        for f in tests:
            rows = rows.filter(f.build(day))
        if by_month:
            for f in ranges:
                rows = rows.filter(dates.within_month(F.col(self.month_partition), f.bounds(day)))
        return rows

    def _dimension(self, home: Entity, dim: str | tuple[str, str]) -> _Selected:
        name, grain = dim if isinstance(dim, tuple) else (dim, None)
        if "." in name:
            other, name = name.split(".", 1)
            self._relationship(home, other)
            home = ENTITIES[other]
        if grain is not None:
            found = _find(home.time_dimensions, name)
            if found is None:
                raise UnknownNameError(f"{home.name} has no time dimension {name!r}")
            return _Selected(dates.truncate(F.col(found[1].column), grain), f"{found[0]}_{grain}", home.name)
        found = _find(home.dimensions, name) or _find(home.time_dimensions, name)
        if found is None:
            raise UnknownNameError(f"{home.name} has no dimension {name!r}")
        return _Selected(F.col(found[1].column), found[0], home.name)

    def _own_column(self, home: Entity, dim: str | tuple[str, str]) -> str | None:
        """Column behind a dimension of the entity itself, None for a related one."""
        name = dim[0] if isinstance(dim, tuple) else dim
        if "." in name:
            return None
        found = _find(home.dimensions, name) or _find(home.time_dimensions, name)
        if found is None:
            raise UnknownNameError(f"{home.name} has no dimension {name!r}")
        return found[1].column

    def _measure(self, home: Entity, name: str, day: Column) -> tuple[str, tuple[str, ...], Column]:
        found = _find(home.metrics, name)
        if found is not None:
            return found[0], found[1].columns, found[1].build(day)
        found = _find(home.facts, name)
        if found is None:
            raise UnknownNameError(f"{home.name} has no metric or fact {name!r}")
        aggregate = F.sum if found[1].aggregation == "sum" else F.avg
        return found[0], (found[1].column,), aggregate(found[1].column)

    def _parts(self, home: Entity, name: str) -> tuple[str, tuple[str, ...], Parts]:
        found = _find(home.metrics, name)
        if found is not None:
            return found[0], found[1].columns, found[1].parts
        key, columns, _ = self._measure(home, name, F.lit(None))
        value = _value(columns[0])
        if _find(home.facts, name)[1].aggregation == "sum":
            return key, columns, Parts((value,))
        known = lambda day: F.when(value(day).isNotNull(), 1.0)
        return key, columns, Parts((value, known), combine=lambda sums, _: guarded_ratio(*sums))

    def _filter(self, home: Entity, name: str) -> Filter:
        found = _find(home.filters, name)
        if found is None:
            raise UnknownNameError(f"{home.name} has no filter {name!r}")
        return found[1]

    def _relationship(self, home: Entity, other: str) -> Relationship:
        for relationship in RELATIONSHIPS:
            if relationship.left == home.name and relationship.right == other:
                return relationship
        raise UnknownNameError(f"{home.name} is not related to {other!r}")

    def _join(self, rows: DataFrame, home: Entity, source: str, wanted: list[_Selected]) -> DataFrame:
        keys = self._relationship(home, source).columns
        entity = ENTITIES[source]
        columns = {c.column for c in [*entity.dimensions.values(), *entity.time_dimensions.values()]}
        view = self.frames[source](sorted(columns))
        if self.check_keys:
            assert_unique(view, keys)
        side = view.select(*[F.col(k).alias(f"_{source}_key_{k}") for k in keys],
                           *[s.column.alias(f"_{source}_{s.alias}") for s in wanted])
        match = [F.col(k) == F.col(f"_{source}_key_{k}") for k in keys]
        return rows.join(side, match, "left")
