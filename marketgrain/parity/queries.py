"""Every analysis wired to the test tables: name -> (spark, folder) -> frame."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketgrain.errors import IngestError, PublishError
from marketgrain.functions import cleaning, labels, money, typing_rules
from marketgrain.operators import calendar, joins
from marketgrain.operators.summary import materialized
from marketgrain.parity.roles import (
    AS_OF,
    HORIZON,
    MIN_CATEGORIES,
    POS,
    SCOPES,
    SIMILAR_FROM,
    TARGET_CLASS,
    TARGET_NAME,
    TARGET_PRODUCT,
    Tables,
)
from marketgrain.plans import (
    affinity,
    contract,
    forecast,
    overlay,
    privacy,
    profile,
    quality,
    sales,
    scopes,
    segments,
    sketches,
    weekdays,
)
from marketgrain.session import scratch_dir
from marketgrain.sources import contents, csv_files, inference, publish, sinks, tables
from marketgrain.sources.tables import role

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a builder under its own name."""
    REGISTRY[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
    return build


def _pos():
    return F.col("channel") == POS


def _day_text(frame: DataFrame, column: str = "day") -> DataFrame:
    return frame.withColumn(column, F.date_format(column, "yyyy-MM-dd"))


# --- table profile -----------------------------------------------------------


@query
def overview(t: Tables) -> DataFrame:
    return profile.overview(t.orders())


@query
def null_profile(t: Tables) -> DataFrame:
    return profile.null_profile(t.labelled_documents())


@query
def nulls_by_dim(t: Tables) -> DataFrame:
    return profile.nulls_by(t.labelled_documents(), "lang", "quality")


@query
def rule_checks(t: Tables) -> DataFrame:
    return profile.rule_checks(t.full_orders(), profile.order_rules())


@query
def rule_checks_strict(t: Tables) -> DataFrame:
    rules = profile.order_rules(strict=True)
    return profile.rule_checks(t.full_orders(), {"total_differs": rules["total_differs"]})


@query
def dup_keys(t: Tables) -> DataFrame:
    keys = {
        "order_line": ["l_orderkey", "l_linenumber"],
        "order": ["l_orderkey"],
        "order_part": ["l_orderkey", "l_partkey"],
    }
    return profile.duplicate_report(t.raw("lineitem"), keys)


@query
def id_gaps(t: Tables) -> DataFrame:
    parts = {"orders": "o_orderkey", "lineitem": "l_partkey", "labels": "doc_id"}
    frames = [
        profile.id_gaps(t.raw(name), key).withColumn("table_name", F.lit(name))
        for name, key in parts.items()
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query
def id_gap_ranges(t: Tables) -> DataFrame:
    """The unused numbers themselves, as runs."""
    parts = {"orders": "o_orderkey", "lineitem": "l_partkey", "labels": "doc_id"}
    frames = [
        profile.id_gap_ranges(t.raw(name), key).withColumn("table_name", F.lit(name))
        for name, key in parts.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def _rounded(frame: DataFrame, columns: list[str], digits: int) -> DataFrame:
    return frame.withColumns({c: F.round(c, digits) for c in columns})


FENCES = ["q1", "median", "q3", "lower_fence", "upper_fence"]


@query
def tukey(t: Tables) -> DataFrame:
    return _rounded(profile.tukey(t.orders(), "total"), FENCES, 4)


@query
def tukey_events(t: Tables) -> DataFrame:
    return _rounded(profile.tukey(t.raw("events"), "value"), FENCES, 4)


@query
def tukey_discount(t: Tables) -> DataFrame:
    """A narrow range with few values."""
    return _rounded(profile.tukey(t.raw("lineitem"), "l_discount"), FENCES, 4)


@query
def tukey_moments(t: Tables) -> DataFrame:
    """Large numbers close to one another: order dates as seconds."""
    moments = t.raw("orders").select(F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("seconds"))
    return _rounded(profile.tukey(moments, "seconds"), FENCES, 4)


@query
def by_status(t: Tables) -> DataFrame:
    return profile.by_dimension(t.orders(), "status")


# --- customers ---------------------------------------------------------------


def _context(t: Tables) -> DataFrame:
    return segments.item_context(t.items(), t.products(), unmatched="drop", validate=None)


def _bought(t: Tables) -> DataFrame:
    return segments.purchases(_context(t), t.orders())


def _stored_bought(t: Tables) -> DataFrame:
    """For analyses that read the purchases twice."""
    return materialized(_bought(t), "purchases")


def _metrics(
    t: Tables, population: str = "ordering", bought: DataFrame | None = None
) -> DataFrame:
    known = _bought(t) if bought is None else bought
    return segments.customer_metrics(t.orders(), known, t.customers(), population)


def _elite(
    t: Tables, population: str = "ordering", bought: DataFrame | None = None
) -> DataFrame:
    return segments.elite(_metrics(t, population, bought), MIN_CATEGORIES)


@query
def elite_customers(t: Tables) -> DataFrame:
    return segments.elite_report(_elite(t))


@query
def elite_leader(t: Tables) -> DataFrame:
    bought = _stored_bought(t)
    units = segments.category_units(segments.of_elite(bought, _elite(t, bought=bought)))
    return segments.leading_categories(units)


@query
def elite_totals(t: Tables) -> DataFrame:
    bought = _stored_bought(t)
    return segments.elite_totals(t.orders(), bought, _elite(t, bought=bought))


@query
def customer_metrics(t: Tables) -> DataFrame:
    shown = _metrics(t, "registered")
    return shown.select(
        "customer_id",
        F.col("revenue").cast("double").alias("revenue"),
        F.col("frequency").cast("bigint").alias("frequency"),
        money.display(F.col("ticket")).alias("average_ticket"),
        F.col("diversity").cast("bigint").alias("diversity"),
    )


@query
def diversity_histogram(t: Tables) -> DataFrame:
    return segments.diversity_histogram(_metrics(t, "registered"))


@query
def eligibility(t: Tables) -> DataFrame:
    return segments.eligibility(_metrics(t, "registered"), MIN_CATEGORIES)


@query
def eligibility_of_buyers(t: Tables) -> DataFrame:
    metrics = segments.customer_metrics(
        t.orders(), _bought(t), population="with_orders", valued_only=True
    )
    return segments.eligibility(metrics, MIN_CATEGORIES + 2)


@query
def buyers_by_scope(t: Tables) -> DataFrame:
    """Distinct customers of months and channels: exact, and whether the merged daily
    sketches, read instead of the orders, are within three hundredths of that."""
    orders = t.orders()
    summary = materialized(sketches.daily(orders, "customer_id", "channel"), "daily-sketches")
    exact = F.count_distinct("customer_id").alias("customers")
    month = calendar.as_month("placed_at").alias("month")
    scopes_of = {
        "all": (orders.agg(exact).select(F.lit("all").alias("label"), "customers"), sketches.merged(summary).withColumn("label", F.lit("all"))),
        "channel": (
            orders.groupBy(F.col("channel").alias("label")).agg(exact),
            sketches.merged(summary, F.col("channel").alias("label")),
        ),
        "month": (
            orders.groupBy(month).agg(exact).select(labels.month_text(F.col("month")).alias("label"), "customers"),
            sketches.merged(summary, calendar.as_month("day").alias("month")).withColumn("label", labels.month_text(F.col("month"))),
        ),
    }
    close = F.abs(F.col("estimate") - F.col("customers")) <= F.greatest(F.lit(1), 0.03 * F.col("customers"))
    parts = [
        counted.join(found.select("label", "estimate"), "label").select(F.lit(name).alias("scope"), "label", "customers", close.alias("is_close"))
        for name, (counted, found) in scopes_of.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def category_share(t: Tables) -> DataFrame:
    bought = _stored_bought(t)
    chosen = _elite(t, "registered", bought)
    return segments.category_share(segments.category_units(segments.of_elite(bought, chosen)))


@query
def category_by_name(t: Tables) -> DataFrame:
    by_product = segments.purchases(_context(t), t.orders(), "product_id")
    units = segments.category_units(segments.of_elite(by_product, _elite(t, "with_orders")))
    names = t.products().select(
        F.col("product_id").alias("category_id"), F.col("product_name").alias("category")
    )
    return segments.category_units_by_name(units, names, 6)


@query
def elite_anonymous(t: Tables) -> DataFrame:
    return segments.anonymous_report(_elite(t, "with_orders"), "Cliente elite")


# --- calendar ----------------------------------------------------------------


def _base(t: Tables) -> DataFrame:
    return sales.sales_base(t.orders(), "status", "channel")


@query
def calendar_sales(t: Tables) -> DataFrame:
    filled = weekdays.calendar_sales(_base(t), _pos())
    return _day_text(filled).withColumn("sales", F.col("sales").cast("double"))


@query
def weekday_mean(t: Tables) -> DataFrame:
    return weekdays.weekday_mean(_base(t), _pos()).drop("mean_recorded", "zero_sales_days")


@query
def weekday_mean_naive_vs_full(t: Tables) -> DataFrame:
    report = weekdays.weekday_mean(_base(t), _pos())
    return report.select("iso_weekday", "mean_sales", "mean_recorded", "zero_sales_days")


@query
def weekday_by_segment(t: Tables) -> DataFrame:
    orders = t.orders().join(t.customers(), "customer_id").join(t.nations(), "nation_id")
    base = sales.sales_base(orders, "nation", "channel")
    filled = weekdays.segment_calendar_sales(base, "nation", t.nations(), _pos())
    means = weekdays.weekday_means(filled, "nation")
    return weekdays.weekday_report(means, "nation").drop("weekday")


@query
def weekday_scope(t: Tables) -> DataFrame:
    return scopes.weekday_by_scope(_base(t), SCOPES, _pos()).drop("weekday")


@query
def reconciliation(t: Tables) -> DataFrame:
    return weekdays.reconcile_calendar(t.orders(), _base(t), _pos())


@query
def events_weekday(t: Tables) -> DataFrame:
    events = t.raw("events").select(
        F.col("ts").alias("placed_at"), F.col("event_type"), money.money("value").alias("total")
    )
    base = sales.sales_base(events, "event_type")
    return weekdays.weekday_mean(base, F.col("event_type") == "purchase", "en")


# --- sales -------------------------------------------------------------------


@query
def monthly_sales(t: Tables) -> DataFrame:
    return sales.monthly(_base(t))


@query
def monthly_recorded(t: Tables) -> DataFrame:
    base = sales.sales_base(t.orders().where(_pos()), "status", "channel")
    return sales.monthly(base, zero_months=False)


@query
def breakdown_status(t: Tables) -> DataFrame:
    return sales.breakdown(_base(t), "status")


@query
def breakdown_channel(t: Tables) -> DataFrame:
    return sales.breakdown(_base(t), "channel", order="revenue")


@query
def crosstab(t: Tables) -> DataFrame:
    customers = t.customers().join(t.nations(), "nation_id")
    return sales.crosstab(t.orders(), "channel", customers, "customer_id", "nation")


# --- demand ------------------------------------------------------------------


def _first_month(t: Tables):
    return calendar.span(t.orders(), "placed_at").select("first_day").scalar()


def _unified(t: Tables) -> DataFrame:
    known = forecast.unified_items(t.items(), t.products(), t.orders(), TARGET_NAME)
    return known.where(F.col("placed_at") < F.lit(HORIZON.cutoff))


def _series(t: Tables) -> DataFrame:
    return forecast.monthly_units(_unified(t), _first_month(t), F.lit(HORIZON.test_end))


def _marked(t: Tables) -> DataFrame:
    return forecast.split(_series(t), HORIZON)


def _all_sold(t: Tables) -> DataFrame:
    dated = _context(t).join(t.orders().select("order_id", "placed_at"), "order_id")
    kept = dated.where(F.col("placed_at") < F.lit(HORIZON.cutoff))
    return kept.withColumn("month", calendar.as_month("placed_at"))


def _all_marked(t: Tables, key: str) -> DataFrame:
    series = forecast.monthly_units(
        _all_sold(t), _first_month(t), F.lit(HORIZON.test_end), [key], t.products()
    )
    return forecast.split(series, HORIZON, [key])


@query
def unified_items(t: Tables) -> DataFrame:
    return _unified(t).select(
        "order_id",
        "product_id",
        "product_name",
        "status",
        "channel",
        "quantity",
        F.date_format("placed_at", "yyyy-MM-dd").alias("placed_on"),
        labels.month_text(F.col("month")).alias("month"),
    )


@query
def monthly_units(t: Tables) -> DataFrame:
    return sinks.monthly_with_period(_series(t), HORIZON).drop("period")


@query
def monthly_units_all(t: Tables) -> DataFrame:
    series = forecast.monthly_units(
        _all_sold(t), _first_month(t), F.lit(HORIZON.test_end), ["product_name"], t.products()
    )
    return sinks.monthly_with_period(series, HORIZON, ["product_name"])


@query
def exported_monthly(t: Tables) -> DataFrame:
    """The target's months with their period as written to CSV, read back as text."""
    path = scratch_dir(t.spark, "monthly")
    sinks.write_csv(sinks.monthly_with_period(_series(t), HORIZON), path)
    return t.spark.read.option("header", True).csv(path)


@query
def exported_items(t: Tables) -> DataFrame:
    """The unified items as written to CSV, read back as text."""
    path = scratch_dir(t.spark, "items")
    sinks.write_csv(unified_items(t), path)
    return t.spark.read.option("header", True).csv(path)


@query
def train_test_split(t: Tables) -> DataFrame:
    return _marked(t).select(labels.month_text(F.col("month")).alias("month"), "units", "period")


@query
def walk_forward(t: Tables) -> DataFrame:
    return forecast.report(forecast.walk_forward(_marked(t), HORIZON))


@query
def walk_forward_all(t: Tables) -> DataFrame:
    made = forecast.walk_forward(_all_marked(t, "product_id"), HORIZON, ["product_id"])
    return forecast.report(made, ["product_id"])


def _six(frame: DataFrame) -> DataFrame:
    return _rounded(frame, ["mae", "predicted_total", "shortfall"], 6)


@query
def forecast_summary(t: Tables) -> DataFrame:
    return _six(forecast.summary(forecast.walk_forward(_marked(t), HORIZON)))


@query
def forecast_summary_all(t: Tables) -> DataFrame:
    made = forecast.walk_forward(_all_marked(t, "product_name"), HORIZON, ["product_name"])
    return _six(forecast.summary(made, ["product_name"]))


@query
def forecast_rounded_mae(t: Tables) -> DataFrame:
    mae = forecast.rounded_mae(forecast.walk_forward(_marked(t), HORIZON))
    return _rounded(mae, ["mae"], 6)


@query
def forecast_frozen(t: Tables) -> DataFrame:
    return forecast.report(forecast.frozen(_marked(t), HORIZON))


@query
def forecast_recursive(t: Tables) -> DataFrame:
    return forecast.report(forecast.recursive(_marked(t), HORIZON))


@query
def forecast_recursive_all(t: Tables) -> DataFrame:
    made = forecast.recursive(_all_marked(t, "product_name"), HORIZON, ["product_name"])
    return forecast.report(made, ["product_name"])


@query
def forecast_frozen_all(t: Tables) -> DataFrame:
    made = forecast.frozen(_all_marked(t, "product_name"), HORIZON, ["product_name"])
    return forecast.report(made, ["product_name"])


@query
def forecast_seasonal(t: Tables) -> DataFrame:
    return forecast.report(forecast.seasonal(_marked(t), HORIZON))


@query
def forecast_seasonal_all(t: Tables) -> DataFrame:
    made = forecast.seasonal(_all_marked(t, "product_name"), HORIZON, ["product_name"])
    return forecast.report(made, ["product_name"])


@query
def dataset_profile(t: Tables) -> DataFrame:
    return forecast.dataset_profile(_unified(t), _marked(t), HORIZON, "product_id")


# --- affinity ----------------------------------------------------------------


def _links(t: Tables) -> DataFrame:
    return affinity.interactions(t.items(), t.orders(), unmatched="drop", validate=None)


@query
def interactions(t: Tables) -> DataFrame:
    return affinity.interactions(t.items(), t.orders())


@query
def pair_cosine(t: Tables) -> DataFrame:
    return affinity.pair_cosine(materialized(_links(t), "interactions"))


@query
def similar_pairs(t: Tables) -> DataFrame:
    """Only pairs from a stated cosine on, found without counting the others."""
    links = materialized(_links(t), "interactions")
    return affinity.pair_cosine(links, min_cosine=SIMILAR_FROM)


@query
def most_similar(t: Tables) -> DataFrame:
    found = affinity.most_similar(materialized(_links(t), "interactions"), 3)
    return _rounded(found, ["similarity"], 8)


@query
def wide_similarity(t: Tables) -> DataFrame:
    """The whole matrix of similarities in blocks of fifty columns."""
    links = materialized(_links(t), "interactions")
    similar = affinity.mirrored(affinity.pair_cosine(links, both=True), links, both=True)
    return affinity.wide_blocks(similar, "product_a", "product_b", "similarity")


@query
def similar_items(t: Tables) -> DataFrame:
    ranked = affinity.similar_products(_links(t), t.products(), TARGET_PRODUCT)
    return _rounded(
        ranked.select(
            "rank",
            "product_id",
            "product_name",
            "similarity",
            "common_customers",
            "product_customers",
            "target_customers",
        ),
        ["similarity"],
        8,
    )


@query
def similarity_to_target(t: Tables) -> DataFrame:
    scored = affinity.similarity_to(_links(t), t.products(), TARGET_PRODUCT)
    return scored.select("product_id", "common_customers", "product_customers", "similarity")


@query
def class_position(t: Tables) -> DataFrame:
    member = F.col("product_name").like(TARGET_CLASS)
    found = affinity.class_position(_links(t), t.products(), TARGET_PRODUCT, member)
    return _rounded(found, ["similarity"], 8)


# --- quality -----------------------------------------------------------------


def _edges(t: Tables) -> list[quality.Edge]:
    chain = {
        "items_orders": ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        "items_products": ("lineitem", "l_partkey", "part", "p_partkey"),
        "items_suppliers": ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        "orders_customers": ("orders", "o_custkey", "customer", "c_custkey"),
        "customers_nations": ("customer", "c_nationkey", "nation", "n_nationkey"),
        "nations_regions": ("nation", "n_regionkey", "region", "r_regionkey"),
    }
    return [
        quality.Edge(name, t.raw(child), child_key, t.raw(parent), parent_key)
        for name, (child, child_key, parent, parent_key) in chain.items()
    ]


def _loose_edges(t: Tables) -> list[quality.Edge]:
    """References that do dangle in the test tables."""
    loose = {
        "documents_labels": ("documents", "doc_id", "labels", "doc_id"),
        "events_customers": ("events", "event_id", "customer", "c_custkey"),
        "items_suppliers_as_products": ("lineitem", "l_partkey", "supplier", "s_suppkey"),
    }
    return [
        quality.Edge(name, t.raw(child), child_key, t.raw(parent), parent_key)
        for name, (child, child_key, parent, parent_key) in loose.items()
    ]


KEYS = {
    "orders": "o_orderkey",
    "customer": "c_custkey",
    "part": "p_partkey",
    "supplier": "s_suppkey",
    "nation": "n_nationkey",
    "region": "r_regionkey",
}
CORE = ["placed_at", "status", "channel", "total"]


@query
def orphans(t: Tables) -> DataFrame:
    return quality.orphan_report(_edges(t) + _loose_edges(t))


@query
def key_report(t: Tables) -> DataFrame:
    keyed = {name: (t.raw(name), key) for name, key in KEYS.items()}
    keyed["lineitem"] = (t.raw("lineitem"), "l_orderkey")
    return quality.key_report(keyed)


def _inventory(t: Tables) -> DataFrame:
    return contract.inventory({name: t.raw(name) for name in [*KEYS, "lineitem", "events"]})


def _checks(t: Tables, published: DataFrame) -> DataFrame:
    return quality.quality_checks(
        t.full_orders(),
        {name: (t.raw(name), key) for name, key in KEYS.items()},
        _edges(t),
        CORE,
        _inventory(t),
        [*KEYS, "lineitem"],
        published,
    )


@query
def quality_report(t: Tables) -> DataFrame:
    return Sections(t).checks()


@query
def source_list(t: Tables) -> DataFrame:
    return quality.source_list(_inventory(t), [*KEYS, "lineitem"])


@query
def cutoff_report(t: Tables) -> DataFrame:
    return quality.cutoff_report(t.full_orders(), AS_OF, ["F", "P"], ["order_id", "customer_id"])


@query
def text_hygiene(t: Tables) -> DataFrame:
    return quality.text_hygiene(t.raw("documents"), ["text", "lang", "source"])


@query
def text_hygiene_pieces(t: Tables) -> DataFrame:
    """The same over the pieces of all texts and pages, which do have blanks."""
    texts = t.raw("documents").select(
        F.lit("sentence").alias("kind"), F.explode(F.split("text", "[.]")).alias("piece")
    )
    pages = t.raw("pages").select(
        F.lit("markup").alias("kind"), F.explode(F.split("html", "[<>]")).alias("piece")
    )
    return quality.text_hygiene(texts.unionByName(pages), ["kind", "piece"])


@query
def privacy_gate(t: Tables) -> DataFrame:
    return privacy.report(
        {
            "documents": t.raw("documents"),
            "conversations": t.raw("conversations"),
            "customer_metrics": _metrics(t),
            "elite": segments.anonymous_report(_elite(t), "Cliente elite"),
        }
    )


# --- scopes ------------------------------------------------------------------


def _bought_by_status(t: Tables) -> DataFrame:
    return segments.purchases(_context(t), t.orders(), by=["status"])


def _scope_elite(t: Tables, bought: DataFrame) -> DataFrame:
    return scopes.elite_by_scope(t.orders(), bought, SCOPES, MIN_CATEGORIES // 2)


@query
def scope_sensitivity(t: Tables) -> DataFrame:
    return scopes.elite_report(_scope_elite(t, _bought_by_status(t)))


@query
def scope_leader(t: Tables) -> DataFrame:
    bought = materialized(_bought_by_status(t), "purchases")
    return scopes.leader_by_scope(bought, _scope_elite(t, bought), SCOPES)


# --- publication -------------------------------------------------------------


class Sections:
    """The published sections over one set of tables, built when asked for.

    ``stored`` writes the daily sales, the purchases, the customers' metrics and
    the elite once and derives the sections from them; worth it when more than one
    section reads them."""

    def __init__(self, t: Tables, stored: bool = False) -> None:
        self.t = t
        self.keep = materialized if stored else lambda frame, _: frame

    @cached_property
    def base(self) -> DataFrame:
        return self.keep(_base(self.t), "daily-sales")

    @cached_property
    def bought(self) -> DataFrame:
        return self.keep(_bought(self.t), "purchases")

    def take(self, *names: str) -> dict[str, DataFrame]:
        return {name: getattr(self, name)() for name in names}

    @cached_property
    def metrics(self) -> DataFrame:
        return self.keep(_metrics(self.t, "registered", self.bought), "metrics")

    @cached_property
    def chosen(self) -> DataFrame:
        return self.keep(segments.elite(self.metrics, MIN_CATEGORIES), "elite")

    def cards(self) -> DataFrame:
        t = self.t
        return contract.cards(self.base, t.customers(), t.products(), self.eligibility())

    def insights(self) -> DataFrame:
        parts = self.eligibility(), self.elite_categories(), self.weekdays(), self.forecast_summary()
        return contract.insights(*parts)

    def metadata(self) -> DataFrame:
        return contract.metadata(self.base, _inventory(self.t))

    def monthly(self) -> DataFrame:
        return sales.monthly(self.base)

    def statuses(self) -> DataFrame:
        return sales.breakdown(self.base, "status")

    def channels(self) -> DataFrame:
        return sales.breakdown(self.base, "channel")

    def elite(self) -> DataFrame:
        return segments.anonymous_report(self.chosen, "Cliente elite")

    def eligibility(self) -> DataFrame:
        return segments.eligibility(self.metrics, MIN_CATEGORIES)

    def category_distribution(self) -> DataFrame:
        return segments.diversity_histogram(self.metrics)

    def elite_categories(self) -> DataFrame:
        units = segments.category_units(segments.of_elite(self.bought, self.chosen))
        return segments.category_share(units).withColumnRenamed("category_id", "category")

    def weekdays(self) -> DataFrame:
        return weekdays.weekday_mean(self.base, _pos())

    def forecast(self) -> DataFrame:
        return walk_forward(self.t)

    def forecast_summary(self) -> DataFrame:
        return forecast_summary(self.t)

    def recommendations(self) -> DataFrame:
        return similar_items(self.t)

    def checks(self) -> DataFrame:
        published = privacy.report({"elite": self.elite()})
        return _checks(self.t, privacy.findings(published))

    def sources(self) -> DataFrame:
        return source_list(self.t)


@query
def cards(t: Tables) -> DataFrame:
    return Sections(t).cards()


@query
def insights(t: Tables) -> DataFrame:
    return Sections(t, stored=True).insights()


@query
def metadata(t: Tables) -> DataFrame:
    return Sections(t).metadata()


@query
def view_numbers(t: Tables) -> DataFrame:
    s = Sections(t, stored=True)
    return contract.view_numbers(s.channels(), s.statuses(), s.weekdays(), s.checks())


def _view(t: Tables, view: str) -> DataFrame:
    return sinks.view_export(Sections(t, stored=True).take(*sinks.view_sections(view)), view)


@query
def tidy_overview(t: Tables) -> DataFrame:
    return _view(t, "overview")


@query
def tidy_customers(t: Tables) -> DataFrame:
    return _view(t, "customers")


@query
def tidy_operations(t: Tables) -> DataFrame:
    return _view(t, "operations")


@query
def tidy_models(t: Tables) -> DataFrame:
    return _view(t, "models")


@query
def exported_forecast(t: Tables) -> DataFrame:
    """The forecast as written to CSV, read back as text."""
    path = scratch_dir(t.spark, "forecast")
    digits = {"prediction": 6, "absolute_error": 6}
    sinks.write_csv(walk_forward(t), path, digits)
    return t.spark.read.option("header", True).csv(path)


@query
def exported_similarity(t: Tables) -> DataFrame:
    """Similarities to the target as written to CSV, read back as text."""
    path = scratch_dir(t.spark, "similarity")
    scored = similarity_to_target(t).select("product_id", "similarity")
    sinks.write_csv(scored, path, {"similarity": 8})
    return t.spark.read.option("header", True).csv(path)


@query
def exported_view(t: Tables) -> DataFrame:
    """A view export as its physical lines: separators, quoting, line ends."""
    path = scratch_dir(t.spark, "view")
    sinks.write_view(tidy_customers(t), path)
    return t.spark.read.option("lineSep", "\r\n").text(path).withColumnRenamed("value", "line")


@query
def exported_views(t: Tables) -> DataFrame:
    """All four views as written, with the mark of UTF-8: their lines, and the first
    bytes of each file on its header line."""
    parts = []
    sections = Sections(t, stored=True)
    for view in sinks.VIEWS:
        path = scratch_dir(t.spark, f"view-{view}")
        sinks.write_view(sinks.view_export(sections.take(*sinks.view_sections(view)), view), path, mark=True)
        # read as bytes: a text scan would drop the mark
        content = t.spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
        lines = F.split(F.decode("content", "utf-8"), "\r\n")
        parts.append(content.select(F.lit(view).alias("view"), F.explode(lines).alias("line")).where("line <> ''"))
    every = reduce(DataFrame.unionByName, parts)
    first = F.col("line").startswith("\ufeff")
    return every.select("view", F.ltrim("line", F.lit("\ufeff")).alias("line"), first.alias("is_marked"))


@query
def overlay_document(t: Tables) -> DataFrame:
    """A document written and read again: its cards over recomputed ones, which
    stand beside the sizes of the tables, that it does not hold."""
    path = scratch_dir(t.spark, "document")
    s = Sections(t, stored=True)
    doc = contract.document(t.spark, {"executive": {"cards": contract.as_list(s.cards(), ["position"])}})
    contract.as_json(doc).coalesce(1).write.text(path)
    recomputed = s.cards().select("id", (F.col("value") + F.lit(1.0)).alias("value"))
    sizes = _inventory(t).select(F.col("table_name").alias("id"), F.col("rows").cast("double").alias("value"))
    base = recomputed.unionByName(sizes)
    found = overlay.published_sections(t.spark, path, doc.schema)
    published = found.select(F.inline("executive.cards")).select("id", "value")
    return overlay.overlay_values(base, published, ["id"], ["value"])


def stored_sections(t: Tables) -> dict[str, DataFrame]:
    """Every section written once; the checks judge what the others hold."""
    s = Sections(t, stored=True)
    names = (
        "metadata", "cards", "insights", "monthly", "statuses", "channels", "elite", "eligibility", "category_distribution",
        "elite_categories", "weekdays", "forecast_summary", "forecast", "recommendations", "sources",
    )
    kept = {name: materialized(getattr(s, name)(), f"section-{name}") for name in names}
    found = privacy.findings(privacy.report(kept))
    return kept | {"checks": materialized(_checks(t, found), "section-checks")}


def assembled(t: Tables, s: dict[str, DataFrame]) -> DataFrame:
    rows, one = contract.as_list, contract.as_object
    return contract.document(
        t.spark,
        {
            "metadata": {"source": one(s["metadata"])},
            "executive": {
                "cards": rows(s["cards"], ["position"]),
                "insights": rows(s["insights"], ["position"]),
            },
            "sales": {
                "monthly": rows(s["monthly"], ["month"]),
                "statuses": rows(s["statuses"], ["status"]),
                "channels": rows(s["channels"], ["channel"]),
            },
            "customers": {
                "elite": rows(s["elite"], ["rank"]),
                "eligibility": one(s["eligibility"]),
                "category_distribution": rows(s["category_distribution"], ["diversity"]),
                "elite_categories": rows(s["elite_categories"], ["rank"]),
            },
            "operations": {
                "weekdays": rows(s["weekdays"], ["iso_weekday"]),
                "forecast": one(s["forecast_summary"]),
                "forecast_series": rows(s["forecast"], ["month"]),
                "recommendations": rows(s["recommendations"], ["rank"]),
            },
            "quality": {
                "checks": rows(s["checks"], ["check"]),
                "sources": rows(s["sources"], ["table_name"]),
            },
        },
    )


def published_document(t: Tables) -> DataFrame:
    return assembled(t, stored_sections(t))


@query
def json_contract(t: Tables) -> DataFrame:
    """The document through its gates, written, read again and walked: all its values."""
    sections = stored_sections(t)
    path = scratch_dir(t.spark, "contract")
    sinks.write_document(assembled(t, sections), path, sections["checks"])
    written = t.spark.read.option("wholetext", True).text(path).withColumnRenamed("value", "document")
    return privacy.leaves(written).select("path", "kind", "text", "number")


@query
def json_contract_monthly(t: Tables) -> DataFrame:
    """The monthly section as a reader of the JSON document gets it."""
    doc = published_document(t)
    parsed = contract.as_json(doc).select(F.from_json("document", doc.schema).alias("d"))
    return parsed.select(F.inline("d.sales.monthly"))


@query
def json_contract_sizes(t: Tables) -> DataFrame:
    """Entries per list of the JSON document."""
    doc = published_document(t)
    parsed = contract.as_json(doc).select(F.from_json("document", doc.schema).alias("d"))
    lists = [
        "executive.cards",
        "sales.monthly",
        "sales.statuses",
        "sales.channels",
        "customers.elite",
        "customers.category_distribution",
        "customers.elite_categories",
        "operations.weekdays",
        "operations.forecast_series",
        "operations.recommendations",
        "quality.checks",
        "quality.sources",
    ]
    sizes = [
        F.struct(F.lit(name).alias("section"), F.size(f"d.{name}").alias("entries"))
        for name in lists
    ]
    return parsed.select(F.inline(F.array(*sizes)))


@query
def overlay_monthly(t: Tables) -> DataFrame:
    """Lines and value by month of shipping laid over orders by month of ordering:
    the first months have orders only, the last ones only what was shipped then."""
    base = sales.monthly(_base(t)).select("month", "orders", "revenue")
    shipped = role(
        t.raw("lineitem"), placed_at="l_shipdate", status="l_linestatus", total="l_extendedprice"
    )
    facts = sales.sales_base(shipped.withColumn("total", money.money("total")), "status")
    published = sales.monthly(facts, zero_months=False).select("month", "orders", "revenue")
    return overlay.overlay_values(base, published, ["month"], ["orders", "revenue"])


@query
def overlay_sections(t: Tables) -> DataFrame:
    """Status sections recomputed, channel section taken from a publication, which
    has the value of the lines for that of the orders."""
    shape = lambda frame, name: frame.select(
        F.lit(name).alias("section"), F.col(frame.columns[0]).alias("label"), "orders", "revenue"
    )
    base = shape(sales.breakdown(_base(t), "status"), "statuses").unionByName(
        shape(sales.breakdown(_base(t), "channel"), "channels")
    )
    priced = sales.sales_base(t.full_orders().withColumn("total", F.col("subtotal")), "channel")
    return overlay.overlay_sections(base, shape(sales.breakdown(priced, "channel"), "channels"))


# --- cleaning ----------------------------------------------------------------


@query
def locale_decimal(t: Tables) -> DataFrame:
    """Order totals written in the local style, read back and summed."""
    written = t.orders().select(
        "order_id",
        F.concat(
            F.lit("R$ "),
            F.translate(F.format_number(F.col("total"), 2), ",.", ".,"),
        ).alias("amount"),
    )
    read = cleaning.cleaned_numbers(written, "amount", default=0)
    return read.select("order_id", "amount", "amount_number", "amount_rejected")


@query
def locale_decimal_props(t: Tables) -> DataFrame:
    """A number inside a JSON text, read through the same cleaning."""
    texts = t.raw("events").select(
        "event_id", F.get_json_object("props", "$.k").alias("amount")
    )
    return cleaning.cleaned_numbers(texts, "amount").drop("amount")


@query
def alias_coalesce(t: Tables) -> DataFrame:
    """Two publications with different field names brought to one shape."""
    older = sales.breakdown(_base(t), "status").select(
        F.col("status").alias("label"),
        F.col("revenue").alias("recordedValue"),
        F.col("orders").alias("orderCount"),
    )
    newer = sales.breakdown(_base(t), "channel").select(
        F.col("channel").alias("Name"),
        F.col("revenue").alias("Total"),
        F.col("orders").alias("ORDERS"),
    )
    shaped = [
        cleaning.normalized(frame, ["category", "value"], ["orders"]) for frame in (older, newer)
    ]
    return shaped[0].unionByName(shaped[1])


@query
def checked_join(t: Tables) -> DataFrame:
    """Lines per nation through guarded lookups."""
    lines = t.items().select("order_id", "quantity")
    dated = joins.checked_join(
        lines, t.orders().select("order_id", "customer_id"), "order_id", name="orders"
    )
    placed = joins.checked_join(dated, t.customers(), "customer_id", name="customers")
    named = joins.checked_join(placed, t.nations(), "nation_id", name="nations")
    return named.groupBy("nation").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").cast("bigint").alias("units")
    )


# --- intake ------------------------------------------------------------------

PROFILED = ["orders", "lineitem", "part", "customer", "events", "documents", "conversations"]


def _as_text(frame: DataFrame) -> DataFrame:
    return frame.select(*[F.col(c).cast("string").alias(c) for c in frame.columns])


@query
def type_profile(t: Tables) -> DataFrame:
    """Inferred types of every column, read as text."""
    found = [inference.profile(_as_text(t.raw(name)), name, is_scan=True) for name in PROFILED]
    return reduce(DataFrame.unionByName, found).drop("whole_digits", "fraction_digits")


def _altered(t: Tables) -> DataFrame:
    """Order dates and totals as text, in shapes that depend on the key."""
    moment = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    key = F.pmod("o_orderkey", F.lit(8))
    text = (
        F.when(key == 0, F.concat(moment, F.lit("-03")))
        .when(key == 1, F.concat(moment, F.lit(",5")))
        .when(key == 2, F.concat(F.lit(" "), day))
        .when(key == 3, F.substring(day, 1, 4))
        .when(key == 4, F.lit("t"))
        .when(key == 5, F.lit(""))
        .when(key == 6, F.concat(moment, F.lit("+0530")))
        .otherwise(day)
    )
    return t.raw("orders").select("o_orderkey", text.alias("shown"))


@query
def value_kinds(t: Tables) -> DataFrame:
    """What kind each text shows, odd ones included."""
    kind = typing_rules.resolve(typing_rules.kind_of(F.col("shown")))
    return _altered(t).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("texts"))


@query
def quarantined_values(t: Tables) -> DataFrame:
    """Where texts do not fit a timestamp column, without the texts."""
    schema = T.StructType([T.StructField("shown", T.TimestampNTZType())])
    return inference.quarantine(_altered(t), schema, ["o_orderkey"])


def _csv_drop(t: Tables, names: list[str]) -> str:
    """The tables as a folder of CSV tables below the shared scratch folder."""
    folder = scratch_dir(t.spark, "drop")
    for name in names:
        (
            t.raw(name)
            .write.option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(f"{folder}/{name}.csv")
        )
    return folder


@query
def csv_type_profile(t: Tables) -> DataFrame:
    """The types found again after a way through CSV, line breaks included."""
    tables = csv_files.inspect(t.spark, _csv_drop(t, PROFILED))
    rows = [
        (p.table, p.position, p.name, p.type_name, p.non_empty)
        for table in tables
        for p in table.profiles
    ]
    shape = "table_name string, position int, column_name string, type_name string, non_empty bigint"
    return t.spark.createDataFrame(rows, shape)


@query
def csv_inventory(t: Tables) -> DataFrame:
    folder = _csv_drop(t, ["nation", "documents"])
    return csv_files.inventory(t.spark, csv_files.inspect(t.spark, folder))


@query
def csv_load_reconcile(t: Tables) -> DataFrame:
    """CSV drop loaded, verified and published; rows on both sides."""
    folder = _csv_drop(t, ["orders", "lineitem", "customer", "documents"])
    return publish.load_folder(t.spark, folder, scratch_dir(t.spark, "published"))


def _write_lines(
    frame: DataFrame, header: str, fields: list, path: str, encoding: str = "UTF-8"
) -> None:
    """Lines as they are: neither the separator nor the quote of the writer occurs."""
    (
        frame.select(F.concat_ws(",", *fields).alias(header))
        .write.mode("append")
        .options(header=True, sep="\u0001", quote="\u0002", encoding=encoding)
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


@query
def intake_guards(t: Tables) -> DataFrame:
    """What the intake refuses of drops made from the customers, and how many records and
    columns without a type it finds in the others."""
    customers, names = t.raw("customer"), ["c_custkey", "c_name", "c_nationkey", "c_acctbal"]
    fields = [F.col(c).cast("string") for c in names]
    seen = []

    def attempt(name: str, header: list[str], *, values=fields, frame=customers, later=None, **options) -> None:
        folder = scratch_dir(t.spark, "intake")
        write = lambda: _write_lines(frame, ",".join(header), values, f"{folder}/t.csv", **options)
        write()
        refused, rows, untyped = False, 0, 0
        try:
            (table,) = tables = csv_files.inspect(t.spark, folder)
            if later:
                write()
            csv_files.unchanged(t.spark, folder, tables)
            rows = table.rows
            untyped = sum(isinstance(f.dataType, T.StringType) for f in table.schema)
        except IngestError:
            refused = True
        seen.append((len(seen) + 1, name, refused, rows, untyped))

    def renamed(name: str) -> list[str]:
        return [names[0], name, *names[2:]]

    longest = "é" * 31 + "e"
    accented = [fields[0], F.lit("é"), *fields[2:]]
    attempt("sound", names)
    attempt("blank name", renamed(" "))
    attempt("control character", renamed("c\u0003name"))
    attempt("63 bytes", renamed(longest))
    attempt("64 bytes", renamed(longest + "e"))
    attempt("repeated name", renamed(names[0]))
    attempt("accents", names, values=accented)
    attempt("broken UTF-8", names, values=accented, encoding="ISO-8859-1")
    attempt("header only", names, frame=customers.where("c_custkey < 0"))
    attempt("narrow records", names, values=fields[:3])
    attempt("wide records", names, values=[*fields, F.lit("")])
    opened = F.when(F.col("c_custkey") == 1, '"').otherwise(fields[1])
    attempt("open quote", names, values=[fields[0], opened, *fields[2:]])
    attempt("codes by name", ["tax_id", "c_name", "Nation_KEY", "c_acctbal"])
    attempt("leading zeros", names, values=[F.concat(F.lit("-0"), fields[0]), *fields[1:]])
    attempt("changed meanwhile", names, later=True)
    return t.spark.createDataFrame(seen, "position int, attempt string, refused boolean, rows bigint, untyped int")


@query
def code_columns(t: Tables) -> DataFrame:
    """Types of columns that are codes by name, by an own list or by leading zeros."""
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    shown = t.raw("customer").select(
        key.alias("c_custkey"),
        key.alias("Customer_CODE"),
        key.alias("barcode"),
        nation.alias("Phone"),
        nation.alias("phones"),
        nation.alias("nation_ref"),
        F.lpad(key, 19, "0").alias("padded"),
        F.concat(F.lit("+0"), key).alias("signed"),
        F.concat(F.lit("0."), key).alias("fraction"),
    )
    found = inference.profile(shown, "customer", ["nation_ref"], is_scan=True)
    return found.select("position", "column_name", "type_name", "non_empty")


@query
def emitted_schema(t: Tables) -> DataFrame:
    """The text of the schema that a drop leads to."""
    folder = scratch_dir(t.spark, "schema")
    parts = {
        "region": t.raw("region").select("r_regionkey", "r_name"),
        "orders": t.raw("orders").select("o_orderkey", "o_orderstatus", "o_orderdate"),
        "odd `names`": t.raw("labels").select(F.col("doc_id").alias("a`b"), F.col("toxic").alias("c d")),
    }
    for name, frame in parts.items():
        frame.write.option("header", True).csv(f"{folder}/{name}.csv")
    found = csv_files.schemas(csv_files.inspect(t.spark, folder))
    texts = inference.all_ddl(found).rstrip("\n").split("\n\n")
    return t.spark.createDataFrame(list(enumerate(texts, 1)), "position int, ddl string")


@query
def strict_moments(t: Tables) -> DataFrame:
    """Texts that are moments without a zone, and the keys of the others."""
    good, rejected = tables.quarantine_moments(_altered(t), "shown", ["o_orderkey"])
    read = good.select(
        "o_orderkey",
        F.date_format("shown", "yyyy-MM-dd HH:mm:ss.SSS").alias("moment"),
        F.lit(None).cast("string").alias("rejected_column"),
    )
    return read.unionByName(rejected, allowMissingColumns=True)


@query
def csv_content_reconcile(t: Tables) -> DataFrame:
    """The same drop by its values: sums of hashes per column and of whole records, from
    the text of the drop and from the published tables."""
    names = ["orders", "lineitem", "customer", "documents"]
    folder, target = _csv_drop(t, names), scratch_dir(t.spark, "published")
    tables = csv_files.inspect(t.spark, folder)
    publish.load_tables(t.spark, folder, tables, target)
    found = [
        contents.compare(
            csv_files.read_text(t.spark, table),
            publish.open_table(t.spark, target, table.name),
            table.schema,
        ).withColumn("table_name", F.lit(table.name))
        for table in tables
    ]
    return reduce(DataFrame.unionByName, found)


@query
def bad_records(t: Tables) -> DataFrame:
    """Places of records that do not fit, in a drop with faults that depend on the key.

    Files hold the keys in order, so that the number of a record leads back to its key."""
    folder = scratch_dir(t.spark, "faulty")
    fault = F.pmod("o_orderkey", F.lit(50))
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    fields = [
        F.col("o_orderkey").cast("string"),
        F.when(fault == 2, F.lit('"1, ""urgent"""')).otherwise(F.col("o_orderpriority")),
        F.when(fault.isin(3, 4), "n/a").when(fault == 5, "").otherwise(price),
        F.when(fault == 0, F.lit(None)).when(fault.isin(4, 6), " 1995-01-01").otherwise(day),
        F.when(fault == 1, "more"),
    ]
    header = "o_orderkey,o_orderpriority,o_totalprice,o_orderdate"
    ordered = t.raw("orders").repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey")
    _write_lines(ordered, header, fields, f"{folder}/orders.csv")
    declared = T.StructType.fromDDL(
        "o_orderkey bigint, o_orderpriority string, o_totalprice decimal(18,2), o_orderdate date"
    )
    (table,) = csv_files.examine(t.spark, folder)
    in_order = Window.partitionBy("file").orderBy("o_orderkey")
    keys = (
        t.spark.read.text(f"{folder}/orders.csv")
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.split_part("value", F.lit(","), F.lit(1)).try_cast("bigint").alias("o_orderkey"),
        )
        .where(F.col("o_orderkey").isNotNull())
        .select("file", "o_orderkey", (F.row_number().over(in_order) + 1).alias("record"))
    )
    return csv_files.bad_records(t.spark, table, declared).join(keys, ["file", "record"], "left").select(
        "table_name", "o_orderkey", "found", "expected", "column_name", "expected_type"
    )


@query
def publish_guards(t: Tables) -> DataFrame:
    """What each guard of a publication refuses, and what readers see afterwards."""
    target = scratch_dir(t.spark, "guarded")
    orders, customers = t.raw("orders"), t.raw("customer")
    urgent = orders.where("o_orderpriority = '1-URGENT'")
    seen = []

    def attempt(name: str, tables: dict[str, DataFrame], **options) -> None:
        try:
            publish.publish(t.spark, tables, target, **options)
            refused = False
        except PublishError:
            refused = True
        now = publish.current(t.spark, target)
        seen.append((len(seen) + 1, name, refused, *(now[n].rows if n in now else 0 for n in ("orders", "customer"))))

    def rival() -> None:
        publish.publish(t.spark, {"customer": customers}, target, replace=True)

    attempt("first", {"orders": orders})
    attempt("filled", {"orders": urgent})
    attempt("other columns", {"orders": orders.select(*reversed(orders.columns))}, replace=True)
    attempt("unknown table", {"customer": customers})
    attempt("wrong rows", {"orders": urgent}, replace=True, expected_rows={"orders": -1})
    attempt("new table", {"customer": customers.where("c_acctbal > 0")}, expected_columns={"customer": customers.columns})
    attempt("overtaken", {"orders": urgent}, replace=True, recheck=rival)
    attempt("replaced", {"orders": urgent}, replace=True)
    return t.spark.createDataFrame(seen, "position int, attempt string, refused boolean, orders bigint, customers bigint")


@query
def csv_published_tables(t: Tables) -> DataFrame:
    """Figures from tables that went through CSV, inference and publication."""
    target = scratch_dir(t.spark, "published")
    publish.load_folder(t.spark, _csv_drop(t, ["orders", "customer"]), target)
    orders = publish.open_table(t.spark, target, "orders")
    customers = publish.open_table(t.spark, target, "customer")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(money.money("o_totalprice")).cast("double").alias("revenue"),
            F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("latest"),
        )
    )


@query
def csv_published_texts(t: Tables) -> DataFrame:
    """Texts with quotes, commas and line breaks survive unchanged."""
    target = scratch_dir(t.spark, "published")
    publish.load_folder(t.spark, _csv_drop(t, ["documents"]), target)
    texts = publish.open_table(t.spark, target, "documents")
    return texts.select(
        "doc_id", F.md5(F.col("text")).alias("digest"), F.length("text").alias("characters")
    )
