"""Every query by name, over the sample tables of a folder.

Results are shown with plain types: decimals as doubles, timestamps without a
zone, and without the stamps of the run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions.dates import latest, within_dates, within_preset
from tallyloom.models import forecast, per_series, recommend, segments
from tallyloom.operators import facts, kpi, kpi_state, merge, metrics, periods, rfm
from tallyloom.operators.clean import clean_categories, clean_order_reviews
from tallyloom.operators.tables import RetailTables
from tallyloom.plans import dashboard, sql, views
from tallyloom.session import apply_runtime_defaults, cut_lineage, ensure_checkpoint_dir
from tallyloom.sinks import exports, managed
from tallyloom.sinks.runlog import log_run
from tallyloom.sinks.tables import write_parquet
from tallyloom.sources import sample
from tallyloom.sources.files import scan_csv
from tallyloom.sources.rejects import land_csv
from tallyloom.sources.schemas import raw_schema

Query = Callable[[SparkSession, str], DataFrame]

STAMPS = ("computed_at", "generated_at", "assigned_at")
SHOWN_AS = {"timestamp": "timestamp_ntz", "smallint": "int", "float": "double"}


def present(df: DataFrame) -> DataFrame:
    shown = []
    for name, kind in df.dtypes:
        if name in STAMPS:
            continue
        target = "double" if kind.startswith("decimal") else SHOWN_AS.get(kind)
        shown.append(F.col(name).cast(target).alias(name) if target else F.col(name))
    return df.select(*shown)


class Sample:
    """The cleaned tables of one folder and the frames several queries start from."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.tables = RetailTables.from_raw(
            {name: partial(build, spark, folder) for name, build in sample.RAW_TABLES.items()}
        )

    def orders(self, payments: bool = False) -> DataFrame:
        return facts.order_facts(self.tables, payments=payments, lean=True)

    def features(self) -> DataFrame:
        return rfm.rfm_features(self.orders(payments=True))

    def snapshots(self) -> DataFrame:
        return kpi.kpi_snapshots(self.orders())

    def reviewed_lines(self, **dimensions: bool) -> DataFrame:
        return facts.sales_lines(self.tables, reviews=True, lean=True, **dimensions)

    def product_metrics(self) -> DataFrame:
        return metrics.product_metrics(self.reviewed_lines())

    def category_metrics(self) -> DataFrame:
        return metrics.category_metrics(self.reviewed_lines(products=True))

    def paid(self) -> DataFrame:
        tables = self.tables
        return views.paid_orders(tables.orders, tables.customers, tables.order_payments)

    def monthly(self) -> DataFrame:
        return views.revenue_monthly(self.paid())

    def recent(self) -> DataFrame:
        tables = self.tables
        payments = sample.raw_order_payments(self.spark, self.folder)
        return views.recent_orders(
            tables.orders, tables.customers, payments, payments_are_raw=True
        )

    def top_products(self) -> DataFrame:
        tables = self.tables
        return views.top_products(self.product_metrics(), tables.products, tables.categories)

    def channels(self) -> DataFrame:
        return views.channel_performance(self.tables.order_payments)

    def forecasts(self) -> DataFrame:
        return sample.daily_forecasts(self.spark, self.folder)

    def described_orders(self) -> DataFrame:
        tables = self.tables
        return views.described_orders(tables.orders, tables.customers, tables.order_payments)

    def monthly_with_forecast(self) -> DataFrame:
        return dashboard.monthly_with_forecast(self.monthly(), self.forecasts())

    def whole_trend(self) -> DataFrame:
        return dashboard.monthly_with_forecast(self.monthly(), self.forecasts(), months=None)

    def last_sale(self):
        return latest(facts.sold_orders(self.tables.orders), "order_purchase_timestamp")

    def interactions(self) -> DataFrame:
        return recommend.interactions(facts.bought_products(self.tables))

    def model_latest(self) -> DataFrame:
        return views.model_latest(sample.model_run_log(self.spark, self.folder))

    def daily(self) -> DataFrame:
        return forecast.daily_series(facts.order_facts(self.tables, customers=False, lean=True))

    # Stand-ins for model output, so that what reads it can be checked exactly.

    def segments_by_rule(self, features: DataFrame | None = None) -> DataFrame:
        """Segments by purchase count instead of a fitted model."""
        features = self.features() if features is None else features
        frequency = F.col("frequency")
        label = (
            F.when(frequency >= 12, "VIP")
            .when(frequency >= 9, "Loyal")
            .when(frequency >= 6, "At Risk")
            .otherwise("New")
        )
        return features.select(
            "customer_unique_id",
            F.lit(0).cast("short").alias("cluster_id"),
            label.alias("segment_label"),
            F.lit(0.0).alias("distance_to_centroid"),
        )

    def clusters_by_rule(self) -> DataFrame:
        # Both sides start from the same sums, so the orders are read once.
        features = self.features()
        return views.customer_clusters(features, self.segments_by_rule(features))

    def most_bought(self) -> DataFrame:
        """Each customer's ten most bought products, in two runs by customer parity."""
        by_rating = Window.partitionBy("customer_unique_id").orderBy(
            F.col("rating").desc(), "product_id"
        )
        run = F.when(F.col("customer_unique_id") % 2 == 0, "2020-01-01").otherwise("2020-01-02")
        return (
            self.interactions()
            .withColumn("rank", F.row_number().over(by_rating))
            .filter(F.col("rank") <= 10)
            .select(
                "customer_unique_id",
                "product_id",
                F.col("rank").cast("short").alias("rank"),
                F.col("rating").alias("score"),
                run.cast("timestamp").alias("generated_at"),
            )
        )

    def shown_recommendations(self, recommendations: DataFrame) -> DataFrame:
        tables = self.tables
        return views.top_recommendations(
            recommendations, tables.products, tables.categories, self.product_metrics()
        )

    # Fitted models.

    def fitted_clusters(self) -> tuple[DataFrame, DataFrame]:
        """Features, written once for the many passes over them, and their segments."""
        features = cut_lineage(self.features())
        return features, segments.assign_segments(segments.fit_segments(features), features)

    def segment_model(self) -> segments.SegmentModel:
        return segments.fit_segments(cut_lineage(self.features()))

    def fitted_segments(self) -> DataFrame:
        return self.fitted_clusters()[1]

    def fitted_recommender(self, evaluate: bool = False) -> recommend.Recommender:
        return recommend.fit_recommender(self.interactions(), evaluate=evaluate)

    def forecast_run(self, kind: str, **settings) -> forecast.ForecastRun:
        return forecast.run_forecast(self.daily(), kind=kind, **settings)


def _cleaned(name: str) -> Callable[[Sample], DataFrame]:
    return lambda s: getattr(s.tables, name)


def _categories_cleaned(s: Sample) -> DataFrame:
    return clean_categories(sample.raw_categories(s.spark, s.folder))


def _enriched(s: Sample) -> DataFrame:
    return facts.enrich_products(s.tables.products, s.tables.categories)


def _customer_measure(*columns: str) -> Callable[[Sample], DataFrame]:
    return lambda s: kpi.customer_kpis(s.orders()).select("snapshot_date", *columns)


def _customer_base(s: Sample) -> DataFrame:
    return s.orders().select(
        F.col("purchase_date").alias("day"), "customer_unique_id", "order_id"
    )


def _alerts(s: Sample, limit: int | None = 5) -> DataFrame:
    return dashboard.inventory_alerts(s.top_products(), s.last_sale(), limit)


def _recent_in_range(s: Sample) -> DataFrame:
    window = within_preset(
        F.col("order_purchase_timestamp"),
        "Last 7 Days",
        latest(s.tables.orders, "order_purchase_timestamp"),
    )
    return dashboard.recent_order_rows(s.described_orders(), window=window, limit=None)


def _orders_between(s: Sample) -> DataFrame:
    bought = F.col("order_purchase_timestamp")
    return s.tables.orders.filter(within_dates(bought, "1996-03-01", "1996-03-31")).select(
        "order_id", "order_status", "order_purchase_timestamp"
    )


def _split_features(s: Sample) -> DataFrame:
    features = forecast.forecast_features(forecast.fill_gaps(s.daily()))
    marked = forecast.mark_holdout(features)
    return marked.withColumn("roll_mean_7", F.round("roll_mean_7", 4))


def _forecast_features(s: Sample) -> DataFrame:
    features = forecast.forecast_features(forecast.fill_gaps(s.daily()))
    return features.withColumn("roll_mean_7", F.round("roll_mean_7", 4))


def _standardized(s: Sample) -> DataFrame:
    scaled = segments.standardized_features(s.features())
    return scaled.withColumns(
        {c: F.round(c, 6) for c in scaled.columns if c.endswith("_z")}
    )


def _upsert_inputs(s: Sample) -> tuple[DataFrame, DataFrame]:
    """Product prices by the catalogue, and what the lines of open orders say."""
    prices = sample.read_table(s.spark, s.folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
    )
    seen = sample.read_table(s.spark, s.folder, "lineitem").filter("l_linestatus = 'O'")
    updates = seen.groupBy((F.col("l_partkey") * 2).alias("product_id")).agg(
        F.max("l_linenumber").alias("size"),
        F.max(F.col("l_extendedprice").cast("decimal(12,2)")).alias("price"),
    )
    return prices, updates


def _upserted(columns: list[str] | None) -> Callable[[Sample], DataFrame]:
    return lambda s: merge.upsert(*_upsert_inputs(s), ["product_id"], columns)


def _forecast_upsert(s: Sample) -> DataFrame:
    """Yesterday's forecasts replaced and extended by a run shifted by a week."""
    current = s.forecasts()
    fresh = current.select(
        F.date_add("forecast_date", 7).alias("forecast_date"),
        (F.col("predicted_revenue") + 1).alias("predicted_revenue"),
        "lower_bound",
        "upper_bound",
        F.lit("rerun").alias("model_name"),
    )
    return merge.upsert(current, fresh, ["forecast_date"])


def _nan_to_null(s: Sample) -> DataFrame:
    events = sample.read_table(s.spark, s.folder, "events")
    broken = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return merge.nan_to_null(events.select("event_id", broken.alias("value")))


def _precision_given(s: Sample) -> DataFrame:
    holdout = recommend.split_interactions(s.interactions()).filter(F.col("part") == "holdout")
    return recommend.precision_at_k(s.most_bought(), holdout, 10)


def _als_quality(s: Sample) -> DataFrame:
    fitted = s.fitted_recommender(evaluate=True)
    # The metrics of a run over the whole interactions, next to its input size.
    return fitted.bought.agg(F.count("*").alias("interactions")).select(
        "interactions",
        F.lit(fitted.rmse).alias("rmse"),
        F.lit(fitted.precision_at_k).alias("precision_at_k"),
    )


def _workbench(range_name: str) -> Callable[[Sample], DataFrame]:
    def build(s: Sample) -> DataFrame:
        totals = dashboard.workbench_kpis(
            s.whole_trend(),
            views.segment_distribution(s.segments_by_rule()),
            kpi.kpi_summary(s.snapshots()),
            range_name,
        )
        return totals.withColumns({c: F.round(c, 2) for c in ("revenue", "predicted_revenue")})

    return build


def _period_cards(range_name: str) -> Callable[[Sample], DataFrame]:
    return lambda s: dashboard.period_cards(
        s.monthly(), kpi.kpi_summary(s.snapshots()), range_name
    )


def _scaled_trend(range_name: str) -> Callable[[Sample], DataFrame]:
    def build(s: Sample) -> DataFrame:
        scaled = dashboard.trend_scaled_proxy(
            s.whole_trend(),
            dashboard.category_rows(s.category_metrics(), limit=None),
            category="Promo Goods",
            region="Brazil — South",
            range_name=range_name,
        )
        return scaled.withColumns({c: F.round(c, 4) for c in ("actual", "predicted")})

    return build


def _filtered_trend(s: Sample) -> DataFrame:
    lines = facts.sales_lines(s.tables, customers=True, products=True)
    return dashboard.trend_filtered(lines, category="Promo Goods", state="ASIA")


def _fresh_folder(s: Sample, name: str) -> str:
    """A new folder in the shared checkpoint folder, so runs never meet."""
    return f"{ensure_checkpoint_dir(s.spark)}/{name}-{uuid.uuid4().hex}"


def _reviews_from_csv(s: Sample) -> DataFrame:
    """Raw reviews landed as CSV files, scanned back and cleaned.

    Documents give the comments, so that quotes and line ends are scanned.
    """
    raw = sample.raw_order_reviews(s.spark, s.folder)
    comments = sample.read_table(s.spark, s.folder, "documents").select(
        F.col("doc_id").alias("review_id"),
        F.concat(F.lit('says "'), "lang", F.lit('", or not')).alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
    )
    columns = raw.columns
    raw = (
        raw.drop("review_comment_title", "review_comment_message")
        .join(comments, "review_id", "left")
        .select(*columns)
    )
    folder = _fresh_folder(s, "reviews-csv")
    raw.write.options(
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(folder)
    return clean_order_reviews(scan_csv(s.spark, folder, raw.schema, multi_line=True))


def _rejected_rows(s: Sample) -> DataFrame:
    """Raw items as lines of text, some of them broken, and what is rejected of them and why."""
    items = sample.raw_order_items(s.spark, s.folder)
    key, fields = F.col("order_id"), [F.col(c).cast("string") for c in items.columns]
    short = F.concat_ws(",", *fields[:-1])
    no_number = F.concat_ws(",", *fields[:5], F.lit("n/a"), fields[6])
    no_key = F.concat(F.lit(","), F.concat_ws(",", *fields[1:]))
    line = (
        F.when(key % 97 == 0, no_number)
        .when(key % 89 == 0, short)
        .when(key % 83 == 0, no_key)
        .otherwise(F.concat_ws(",", *fields))
    )
    folder = _fresh_folder(s, "item-lines")
    items.select(line.alias("value")).write.text(folder)
    landed = land_csv(
        s.spark, folder, raw_schema("order_items"), _fresh_folder(s, "items"), ["order_id"], header=False
    )
    return landed.rejected


def _inferred_profile(s: Sample) -> DataFrame:
    """Raw payments landed as CSV: the types that a scan without schema finds, and counts."""
    folder = _fresh_folder(s, "payments-csv")
    sample.raw_order_payments(s.spark, s.folder).write.option("header", True).csv(folder)
    scanned = scan_csv(s.spark, folder)
    kinds = F.create_map(*(F.lit(x) for pair in scanned.dtypes for x in pair))
    return merge.table_profile(scanned).select(
        "column_name", F.element_at(kinds, F.col("column_name")).alias("inferred"), "row_count", "null_count"
    )


def _scanned_texts(s: Sample, folder: str, names: list[str]) -> DataFrame:
    """A CSV export read back as text, empty fields as empty strings."""
    scanned = scan_csv(s.spark, folder, ", ".join(f"`{n}` string" for n in names))
    return scanned.select(*(F.coalesce(n, F.lit("")).alias(n) for n in names))


def _exported_customers(s: Sample) -> DataFrame:
    folder = _fresh_folder(s, "customers-csv")
    exports.export_customers(dashboard.customer_rows(s.clusters_by_rule(), engagement="High"), folder)
    return _scanned_texts(s, folder, list(exports.CUSTOMER_HEADERS))


def _exported_trend(s: Sample) -> DataFrame:
    folder = _fresh_folder(s, "trend-csv")
    exports.export_trend(s.monthly_with_forecast(), folder)
    return _scanned_texts(s, folder, ["month_label", "revenue", "predicted"])


def _exported_categories(s: Sample) -> DataFrame:
    """The categories of a workbench export, read back from its JSON."""
    folder = _fresh_folder(s, "workbench")
    rows = dashboard.category_rows(s.category_metrics())
    kpis, trend = kpi.kpi_summary(s.snapshots()), s.monthly_with_forecast()
    exports.export_workbench(s.spark, folder, kpis, trend, rows, {"region": "All Regions"})
    return s.spark.read.schema(rows.schema).json(f"{folder}/category_performance")


def _exported_forecast(s: Sample) -> DataFrame:
    """The forecast of an insights export, read back from its JSON."""
    folder = _fresh_folder(s, "insights")
    cards = dashboard.model_cards(s.model_latest())
    shares = dashboard.segment_rows(views.segment_distribution(s.segments_by_rule()))
    exports.export_insights(s.spark, folder, cards, shares, dashboard.forecast_summary(s.forecasts()))
    schema = "model string, horizon_days long, predicted_total double, lower_bound double, upper_bound double"
    return s.spark.read.schema(schema).json(f"{folder}/forecast_summary")


def _logged_runs(s: Sample) -> DataFrame:
    """The newest metrics of a log that was appended to in two runs."""
    folder, rows = _fresh_folder(s, "runs"), sample.model_run_log(s.spark, s.folder)
    for half in (0, 1):
        log_run(rows.filter(F.col("run_id") % 2 == half), folder)
    return views.model_latest(s.spark.read.parquet(folder))


def _upserted_in_place(s: Sample) -> DataFrame:
    """The same merge on a managed table, of which only the touched files are rewritten."""
    prices, updates = _upsert_inputs(s)
    root = _fresh_folder(s, "prices")
    managed.create_table(prices, root, ["product_id"])
    managed.upsert_table(updates, root)
    return managed.read_table(s.spark, root, prices)


def _kpi_in_batches(s: Sample) -> DataFrame:
    """Snapshots after a first load without every fourth order, and a batch.

    Orders that are canceled were not yet at the first load; the batch brings the
    orders that were missing and takes those back that turned canceled.
    """
    tables, gone = s.tables, F.col("order_status").isin("canceled", "unavailable")
    early = tables.orders.filter(F.col("order_id") % 4 != 0)
    late = tables.orders.filter(F.col("order_id") % 4 == 0)
    as_sold = F.when(gone, "processing").otherwise(F.col("order_status"))

    def order_facts(orders: DataFrame) -> DataFrame:
        named = {"orders": orders, "customers": tables.customers, "order_items": tables.order_items}
        return facts.order_facts(RetailTables(named.__getitem__))

    state = kpi_state.initial_state(order_facts(early.withColumn("order_status", as_sold)))
    state = kpi_state.KpiState(cut_lineage(state.days), cut_lineage(state.events))
    turned = early.filter(gone).withColumn("order_status", as_sold)
    return kpi_state.apply_batch(state, order_facts(late), order_facts(turned)).snapshots()


def _distinct_customers(s: Sample) -> DataFrame:
    bitmaps = cut_lineage(periods.daily_bitmaps(s.orders()))
    parts = [
        periods.distinct_trailing(bitmaps, days).withColumn("days", F.lit(days)) for days in (7, 30, 90)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _in_sql(statement: str) -> Callable[[Sample], DataFrame]:
    def build(s: Sample) -> DataFrame:
        sql.register(s.spark, s.tables)
        return s.spark.sql(statement)

    return build


def _snapshots_from_fact_table(s: Sample) -> DataFrame:
    """KPI snapshots read from a fact table written by month."""
    master = write_parquet(
        facts.master_facts(s.tables),
        _fresh_folder(s, "master-facts"),
        partition_by=["purchase_month"],
        rebalance=False,
    )
    return kpi.kpi_snapshots(facts.orders_from_lines(facts.sold_lines(master)))


def _fitted_clusters(s: Sample) -> DataFrame:
    return views.customer_clusters(*s.fitted_clusters())


def _forecast_by_category(s: Sample) -> DataFrame:
    lines = facts.sales_lines(s.tables, products=True)
    daily = forecast.daily_series(lines, series=F.col("category"))
    return forecast.run_forecast(daily, kind="linreg").forecasts


def _by_seller(s: Sample) -> per_series.SeriesForecasts:
    lines = facts.sales_lines(s.tables, lean=True)
    return per_series.forecast_each(
        forecast.daily_series(lines, series=F.col("seller_id").cast("string"))
    )


def _quality_by_seller(s: Sample) -> DataFrame:
    quality = _by_seller(s).quality
    return quality.withColumns({"rmse": F.round("rmse", 4), "r2": F.round("r2", 6)})


def _segment_centroids(s: Sample) -> DataFrame:
    rows = segments.centroid_rows(s.spark, s.segment_model())
    return rows.withColumns({c: F.round(c, 6) for c, kind in rows.dtypes if kind == "double"})


def _segment_silhouette(s: Sample) -> DataFrame:
    features = cut_lineage(s.features())
    model = segments.fit_segments(features)
    return features.agg(F.count("*").alias("customers")).withColumn(
        "silhouette", F.round(F.lit(model.silhouette), 6)
    )


# Invariants of fitted models, which SQL can state from the tables alone.


def _segments_check(s: Sample) -> DataFrame:
    person = F.col("customer_unique_id")
    return s.fitted_segments().agg(
        F.count_distinct(person).alias("customers"),
        (F.count("*") - F.count_distinct(person)).alias("repeated"),
        F.count_if(F.col("segment_label").isNull()).alias("without_label"),
        F.count_if(~(F.col("distance_to_centroid") >= 0)).alias("bad_distances"),
    )


def _recommendations_check(s: Sample) -> DataFrame:
    """Lists without seen products: sizes, ranks, known products and repeats."""
    fitted = s.fitted_recommender()
    bought = fitted.bought
    rows = cut_lineage(recommend.recommend_all(fitted, exclude_seen=bought))
    products = bought.select("product_id").distinct().withColumn("known", F.lit(1))
    seen = bought.select("customer_unique_id", "product_id").withColumn("seen", F.lit(1))
    lists = rows.groupBy("customer_unique_id").agg(
        F.count("*").alias("size"),
        F.max("rank").alias("last"),
        F.count_distinct("product_id").alias("products"),
    )
    marked = rows.join(products, "product_id", "left").join(
        seen, ["customer_unique_id", "product_id"], "left"
    )
    pairs = marked.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("known").isNull()).alias("unknown_products"),
        F.count("seen").alias("already_bought"),
    )
    counts = lists.agg(
        F.count("*").alias("customers"),
        F.count_if(F.col("size") != F.col("last")).alias("rank_gaps"),
        F.count_if(F.col("size") != F.col("products")).alias("repeats"),
    )
    # Two frames of one row each.
    return pairs.withColumn("one", F.lit(1)).join(counts.withColumn("one", F.lit(1)), "one").drop("one")


def _shown_check(s: Sample) -> DataFrame:
    """Lists with their descriptions, and the tabs above them: sizes and what may not happen."""
    shown = cut_lineage(_shown_recommendations(s))
    tabs = dashboard.recommendation_tabs(shown).agg(
        F.count("*").alias("tabs"),
        F.count_if(F.col("category").isNull()).alias("tabs_without_name"),
    )
    counts = shown.agg(
        F.count("*").alias("rows"),
        F.count_distinct("customer_unique_id").alias("customers"),
        F.max("rank").cast("int").alias("last_rank"),
        F.count_if(F.col("total_revenue").isNull()).alias("without_revenue"),
    )
    # Two frames of one row each.
    return counts.withColumn("one", F.lit(1)).join(tabs.withColumn("one", F.lit(1)), "one").drop("one")


def _forecast_check(s: Sample) -> DataFrame:
    value, low, high = (F.col(c) for c in ("predicted_revenue", "lower_bound", "upper_bound"))
    return s.forecast_run("linreg").forecasts.groupBy("series").agg(
        F.min("forecast_date").alias("first_day"),
        F.max("forecast_date").alias("last_day"),
        F.count_distinct("forecast_date").alias("days"),
        F.count_if(~((low <= high) & (value <= high) & (low >= 0))).alias("bad_bands"),
    )


def _recommendations(s: Sample) -> DataFrame:
    return recommend.recommend_all(s.fitted_recommender())


def _shown_recommendations(s: Sample) -> DataFrame:
    # The view reads them twice, for the latest run and for its rows.
    return s.shown_recommendations(cut_lineage(_recommendations(s)))


BUILDERS: dict[str, Callable[[Sample], DataFrame]] = {
    # cleaned tables
    "clean_categories": _categories_cleaned,
    "clean_customers": _cleaned("customers"),
    "clean_sellers": _cleaned("sellers"),
    "clean_products": _cleaned("products"),
    "clean_orders": _cleaned("orders"),
    "clean_order_items": _cleaned("order_items"),
    "clean_order_payments": _cleaned("order_payments"),
    "clean_order_reviews": _cleaned("order_reviews"),
    "categories_augmented": _cleaned("categories"),
    "reviews_from_csv": _reviews_from_csv,
    "rejected_rows": _rejected_rows,
    "inferred_profile": _inferred_profile,
    # facts
    "snapshots_from_fact_table": _snapshots_from_fact_table,
    "payments_per_order": lambda s: facts.payments_per_order(s.tables.order_payments),
    "reviews_per_order": lambda s: facts.reviews_per_order(s.tables.order_reviews),
    "products_enriched": _enriched,
    "master_facts": lambda s: facts.master_facts(s.tables),
    # customers and KPIs
    "rfm_features": Sample.features,
    "revenue_daily": lambda s: kpi.revenue_daily(facts.order_facts(s.tables, customers=False)),
    "customer_base": _customer_base,
    "customers_to_date": _customer_measure("total_customers"),
    "customers_active_30d": _customer_measure("active_customers"),
    "repeat_rate": _customer_measure("repeat_rate"),
    "kpi_snapshots": Sample.snapshots,
    "kpi_in_batches": _kpi_in_batches,
    "distinct_customers_period": _distinct_customers,
    "distinct_customers_month": lambda s: periods.distinct_by_period(
        periods.daily_bitmaps(s.orders()), F.trunc("day", "month")
    ),
    "kpi_deltas": lambda s: kpi.kpi_deltas(s.snapshots()),
    "kpi_summary": lambda s: kpi.kpi_summary(s.snapshots()),
    "kpi_cards": lambda s: dashboard.kpi_cards(kpi.kpi_summary(s.snapshots())),
    # products and categories
    "product_metrics": Sample.product_metrics,
    "category_metrics": Sample.category_metrics,
    "category_performance": lambda s: views.category_performance(
        s.reviewed_lines(products=True)
    ),
    "category_rows": lambda s: dashboard.category_rows(s.category_metrics()),
    "category_search": lambda s: dashboard.category_rows(s.category_metrics(), search="good"),
    "spending_top": lambda s: dashboard.spending_top(s.category_metrics()),
    "top_products": Sample.top_products,
    "top_product_rows": lambda s: dashboard.top_product_rows(s.top_products(), limit=10),
    "product_search": lambda s: dashboard.top_product_rows(
        s.top_products(), limit=10, search="promo"
    ),
    "inventory_alerts": _alerts,
    "inventory_alerts_all": lambda s: _alerts(s, None),
    "alert_counts": lambda s: dashboard.alert_counts(_alerts(s, None)),
    # revenue over time
    "revenue_monthly": Sample.monthly,
    "revenue_daily_7d": lambda s: views.revenue_daily_7d(s.paid()),
    "daily_bars": lambda s: dashboard.daily_bars(views.revenue_daily_7d(s.paid())),
    "monthly_actuals": lambda s: dashboard.monthly_actuals(s.monthly()),
    "monthly_with_forecast": Sample.monthly_with_forecast,
    "period_kpis": lambda s: dashboard.period_totals(s.monthly(), "Last 3 Months"),
    "period_cards": _period_cards("Last 12 Months"),
    "period_cards_all_time": _period_cards("All Time"),
    "workbench_kpis": _workbench("Last 6 Months"),
    "workbench_kpis_all_time": _workbench("All Time"),
    "historical_estimate": lambda s: dashboard.historical_estimate(s.monthly(), "Last 6 Months"),
    "historical_estimate_all_time": lambda s: dashboard.historical_estimate(s.monthly()),
    "trend_scaled_proxy": _scaled_trend("Last 6 Months"),
    "trend_scaled_proxy_all_time": _scaled_trend("All Time"),
    "trend_filtered": _filtered_trend,
    # orders and channels
    "recent_orders": Sample.recent,
    "recent_order_rows": lambda s: dashboard.recent_order_rows(s.recent()),
    "recent_order_search": lambda s: dashboard.recent_order_rows(
        s.described_orders(), search="CANCEL"
    ),
    "recent_order_range": _recent_in_range,
    "orders_between": _orders_between,
    "channel_performance": Sample.channels,
    "channel_rows": lambda s: dashboard.channel_rows(s.channels()),
    "channel_count": lambda s: dashboard.channel_count(s.channels()),
    "activity_heatmap": lambda s: dashboard.activity_heatmap(s.tables.orders),
    "activity_heatmap_newest": lambda s: dashboard.activity_heatmap(s.tables.orders, newest=5000),
    # views and parameter queries as SQL text
    "sql_months_of_revenue": _in_sql("SELECT * FROM months_of_revenue(6)"),
    "sql_best_products": _in_sql("SELECT * FROM best_products(10, 'Promo')"),
    "sql_orders_of_period": _in_sql(
        "SELECT * FROM orders_of_period(DATE '1996-03-01', DATE '1996-03-31')"
    ),
    "sql_channel_performance": _in_sql("SELECT * FROM v_channel_performance"),
    # writes as results, and the model log
    "upsert_merge": _upserted(None),
    "upsert_in_place": _upserted_in_place,
    "upsert_subset": _upserted(["price"]),
    "upsert_ignore": _upserted([]),
    "upsert_forecast": _forecast_upsert,
    "exported_customers": _exported_customers,
    "exported_trend": _exported_trend,
    "exported_categories": _exported_categories,
    "exported_forecast": _exported_forecast,
    "logged_runs": _logged_runs,
    "nan_to_null": _nan_to_null,
    "table_profile": lambda s: merge.table_profile(s.tables.products),
    "model_latest": Sample.model_latest,
    "model_cards": lambda s: dashboard.model_cards(s.model_latest()),
    "model_count": lambda s: dashboard.model_count(s.model_latest()),
    # model inputs and evaluation
    "interactions": Sample.interactions,
    "eligible_users": lambda s: recommend.eligible_users(s.interactions(), 5),
    "interaction_split": lambda s: recommend.split_interactions(s.interactions()),
    "precision_given": _precision_given,
    "standardized_features": _standardized,
    "daily_series": lambda s: forecast.fill_gaps(s.daily()),
    "forecast_features": _forecast_features,
    "forecast_split": _split_features,
    "forecast_by_month": lambda s: dashboard.forecast_by_month(s.forecasts()),
    "forecast_totals": lambda s: dashboard.forecast_summary(s.forecasts()),
    # readers of model output, on rule-made output
    "clusters_by_rule": Sample.clusters_by_rule,
    "segment_shares_by_rule": lambda s: views.segment_distribution(s.segments_by_rule()),
    "segment_rows_by_rule": lambda s: dashboard.segment_rows(
        views.segment_distribution(s.segments_by_rule())
    ),
    "segment_total_by_rule": lambda s: dashboard.segment_total(
        views.segment_distribution(s.segments_by_rule())
    ),
    "customer_rows_by_rule": lambda s: dashboard.customer_rows(
        s.clusters_by_rule(), engagement="High"
    ),
    "customer_rows_new": lambda s: dashboard.customer_rows(s.clusters_by_rule(), segment="New"),
    "cluster_scatter_by_rule": lambda s: dashboard.cluster_scatter(s.clusters_by_rule()),
    "cluster_scatter_hashed": lambda s: dashboard.cluster_scatter(
        s.clusters_by_rule(), by_hash=True
    ),
    "recommendations_most_bought": lambda s: s.shown_recommendations(s.most_bought()),
    "customer_picks_most_bought": lambda s: dashboard.customer_recommendations(
        s.shown_recommendations(s.most_bought())
    ),
    "recommendation_tabs_most_bought": lambda s: dashboard.recommendation_tabs(
        s.shown_recommendations(s.most_bought())
    ),
    # invariants of fitted models
    "customer_segments_check": _segments_check,
    "recommendations_check": _recommendations_check,
    "top_recommendations_check": _shown_check,
    "sales_forecast_check": _forecast_check,
    # fitted models
    "customer_segments": Sample.fitted_segments,
    "segment_centroids": _segment_centroids,
    "segment_silhouette": _segment_silhouette,
    "segment_distribution": lambda s: views.segment_distribution(s.fitted_segments()),
    "customer_table": lambda s: dashboard.customer_rows(_fitted_clusters(s)),
    "cluster_scatter": lambda s: dashboard.cluster_scatter(_fitted_clusters(s)),
    "recommendations": _recommendations,
    "top_recommendations": _shown_recommendations,
    "recommendation_tabs": lambda s: dashboard.recommendation_tabs(_shown_recommendations(s)),
    "precision_at_k": _als_quality,
    "sales_forecast": lambda s: s.forecast_run("linreg").forecasts,
    "sales_forecast_by_category": _forecast_by_category,
    "sales_forecast_by_seller": lambda s: _by_seller(s).forecasts,
    "forecast_quality_by_seller": _quality_by_seller,
    "sales_forecast_forest": lambda s: s.forecast_run("randomforest").forecasts,
    "forecast_summary": lambda s: dashboard.forecast_summary(s.forecast_run("linreg").forecasts),
}

# MLlib's fits depend on row layout, so these are checked by invariants and not by SQL.
MODEL_QUERIES = frozenset(
    {
        "customer_segments_check",
        "recommendations_check",
        "top_recommendations_check",
        "sales_forecast_check",
        "recommendations",
        "top_recommendations",
        "recommendation_tabs",
        "precision_at_k",
        "sales_forecast",
        "sales_forecast_by_category",
        "sales_forecast_forest",
        "forecast_summary",
    }
)


def _query(build: Callable[[Sample], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return present(build(Sample(apply_runtime_defaults(spark), folder)))

    return run


def all_queries() -> dict[str, Query]:
    return {name: _query(build) for name, build in BUILDERS.items()}
