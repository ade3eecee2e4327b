"""The registered queries: each takes a session and the folder of the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import analytics, clean, distinct, flat, gold, quality, report
from ledgerloom.operators.rank import global_rank, sketched_quantiles
from ledgerloom.plans import batch, incremental, ingest
from ledgerloom.session import pin_time_zone
from ledgerloom.sources import bronze, manifest, tables
from ledgerloom.sources.staging import fresh_folder, remove_folder
from ledgerloom.streaming import order_events
from ledgerloom.testbed.bronze_views import AS_OF, SPREAD_DAYS, raw, raw_by_day, table

Query = Callable[[SparkSession, str], DataFrame]

DAY = AS_OF.isoformat()
FIRST_DAY = AS_OF - timedelta(days=SPREAD_DAYS - 1)
MOVED = "cast(order_id as bigint) % 20 = 7"  # orders that a late version moves to another date
NATIONS = [f"NATION_{number}" for number in range(25)]
MARKETS = ["Automobile", "Building", "Furniture", "Household", "Machinery"]


def _silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return clean.silver(name, raw(spark, sf_dir, name), DAY)


def _silver_query(name: str) -> Query:
    columns = [*schemas.ENTITY_TYPES[name], *schemas.DERIVED_TYPES[name], "job_date", "date_partition"]
    return lambda spark, sf_dir: _silver(spark, sf_dir, name).select(*columns)


def _quarantine_query(name: str) -> Query:
    return lambda spark, sf_dir: clean.quarantine(name, raw(spark, sf_dir, name))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_revenue_summary(_silver(spark, sf_dir, "orders"),
                                      _silver(spark, sf_dir, "order_items"), DAY)


def _rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.customer_rfm(_silver(spark, sf_dir, "orders"), _silver(spark, sf_dir, "customers"), DAY)


def _rfm_sketched_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the quartiles of a sketch over the customer scores lie within a rank error of 0.05, from the ranks of all rows."""
    names, points = ["frequency", "monetary", "recency_days"], [0.25, 0.5, 0.75]
    scores = _rfm(spark, sf_dir).select(*names)
    found = sketched_quantiles(scores, names, points).select(F.struct("*").alias("found"))
    checks = []
    for name in names:
        for at, point in enumerate(points):
            value = F.col(f"found.{name}")[at]
            below, upto = (F.avg(F.when(test, 1.0).otherwise(0.0)) for test in (F.col(name) < value, F.col(name) <= value))
            checks.append(F.struct(F.lit(name).alias("score"), F.lit(point).alias("part"),
                                   ((below <= point + 0.05) & (upto >= point - 0.05)).alias("within")))
    # one row of nine bounds
    return scores.withColumn("found", found.scalar()).agg(F.array(*checks).alias("checks")).select(F.inline("checks"))


def _unique_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether distinct customers per country over all days, merged from sketches per day, come within 5 % of the exact count."""
    orders, customers = _silver(spark, sf_dir, "orders"), _silver(spark, sf_dir, "customers")
    merged = distinct.unique_customers(distinct.customer_sketches(orders, customers), "country")
    exact = (orders.filter("status <> 'cancelled' and customer_id is not null").select("customer_id").distinct()
             .join(customers.select("customer_id", "country"), "customer_id", "left").groupBy("country").agg(F.count(F.lit(1)).alias("exact")))
    return (exact.join(merged.withColumnRenamed("country", "merged_country"), F.col("country").eqNullSafe(F.col("merged_country")), "left")
            .select("country", "exact", (F.abs(F.col("unique_customers") - F.col("exact")) <= F.col("exact") * 0.05).alias("within")))


def _performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.product_performance(_silver(spark, sf_dir, "order_items"), _silver(spark, sf_dir, "orders"),
                                    _silver(spark, sf_dir, "products"), DAY)


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.geo_revenue(_silver(spark, sf_dir, "orders"), _silver(spark, sf_dir, "customers"), DAY)


def _funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.order_status_funnel(_silver(spark, sf_dir, "orders"), DAY)


def _gold_query(build: Query, name: str) -> Query:
    return lambda spark, sf_dir: build(spark, sf_dir).drop("updated_at").select(
        *[column for column in schemas.GOLD_TYPES[name] if column != "updated_at"])


# In the raw views a row with an earlier update time counts as arrived earlier.
ARRIVAL = {"orders": ["updated_at"], "customers": [], "products": [], "order_items": []}


def _flat(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return flat.flat_clean(name, raw(spark, sf_dir, name), ARRIVAL[name])


def _flat_query(name: str) -> Query:
    return lambda spark, sf_dir: _flat(spark, sf_dir, name)


def _flat_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat.flat_daily_revenue(_flat(spark, sf_dir, "orders"))


def _flat_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat.flat_geo_revenue(_flat(spark, sf_dir, "orders"), _flat(spark, sf_dir, "customers"))


def _flat_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat.flat_order_funnel(_flat(spark, sf_dir, "orders"))


def _orders_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.silver("orders", raw_by_day(spark, sf_dir, "orders"), None)


def _dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the typed rows before any is rejected, so the planted defects show."""
    typed = {name: clean.typed(name, raw(spark, sf_dir, name)) for name in schemas.ENTITIES}
    return quality.dq_summary(typed, MARKETS, NATIONS)


def _dq_orphan_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _silver(spark, sf_dir, "order_items").select("item_id", "order_id", "product_id")
    return quality.orphans(items, _silver(spark, sf_dir, "orders"), "order_id").select(
        "item_id", "order_id", "product_id")


def _dq_duplicate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_values(raw(spark, sf_dir, "orders"), "order_id")


def _dq_line_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _silver(spark, sf_dir, "order_items")
    return quality.violations(items, quality.line_total_off()).select(
        "item_id", "quantity", "unit_price", "discount", "line_total", "line_total_recalc")


def _global_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line ranked by price and by quantity."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    return global_rank(lines, {"rank_by_price": "l_extendedprice", "rank_by_quantity": "l_quantity"})


def _land_by_day(spark: SparkSession, sf_dir: str, root: str) -> None:
    for name in schemas.ENTITIES:
        bronze.land_csv_days(raw_by_day(spark, sf_dir, name), root, name, "date_partition")


def _bronze_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw orders written as text files by date and read back."""
    root = fresh_folder(spark, "landing")
    bronze.land_csv_days(raw_by_day(spark, sf_dir, "orders"), root, "orders", "date_partition")
    return bronze.read_days(spark, root, "orders", FIRST_DAY, AS_OF)


def _land_mixed_headers(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Raw orders by date in files of three layouts: as declared, reversed, and reversed with one column more and one less."""
    rows = raw_by_day(spark, sf_dir, "orders")
    names = list(schemas.ENTITY_TYPES["orders"])
    layouts = [names, names[::-1], ["comment", *[name for name in names[::-1] if name != "promo_code"]]]
    kind = F.expr("cast(order_id as bigint) % 3")
    for at, layout in enumerate(layouts):
        part = rows.filter(kind == at).withColumn("comment", F.lit("a, b")).select(*layout, F.col("date_partition").alias("dt"))
        (bronze.write_text(part.hint("rebalance", "dt")).mode("append").partitionBy("dt").csv(f"{root}/bronze/orders"))


def _mixed_headers_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean orders per date over a range whose files differ in their headers."""
    root = fresh_folder(spark, "headers")
    _land_mixed_headers(spark, sf_dir, root)
    orders = clean.silver("orders", bronze.read_days(spark, root, "orders", FIRST_DAY, AS_OF), None)
    return orders.drop("processed_at")


def _rejected_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected orders and products of a run with the text they came with."""
    root = fresh_folder(spark, "rejected")
    parts = []
    for name, amount in (("orders", "total"), ("products", "price")):
        bronze.land_csv(raw(spark, sf_dir, name), root, name, AS_OF)
        rows = clean.cleaned(name, bronze.read_day(spark, root, name, AS_OF), DAY)
        tables.write_cleaned(rows, root, name, [AS_OF])
        parts.append(tables.read_rejected(spark, root, name).select(
            F.lit(name).alias("table_name"), F.col(schemas.KEYS[name]).alias("key"), "reject_reason",
            F.col(amount).alias("amount"), F.col(f"raw.{amount}").alias("amount_text")))
    return parts[0].unionByName(parts[1])


def _backfill_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_folder(spark, "backfill")
    _land_by_day(spark, sf_dir, root)
    batch.run_range(spark, root, root, FIRST_DAY, AS_OF)
    written = None
    for name in schemas.ENTITIES:
        rows = (tables.read_silver(spark, root, name).groupBy("date_partition")
                .agg(F.count(F.lit(1)).alias("row_count"))
                .select(F.lit(name).alias("table_name"), "date_partition", "row_count"))
        written = rows if written is None else written.unionByName(rows)
    return written


def _gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily revenue after a last day that brings new orders and later versions of old ones, some of them on another order date."""
    root = fresh_folder(spark, "incremental")
    _land_by_day(spark, sf_dir, root)
    batch.run_range(spark, root, root, FIRST_DAY, AS_OF - timedelta(days=1))
    for name in schemas.ENTITIES:  # text that is cleaned already; only the last day is read again
        for back in range(1, SPREAD_DAYS):
            remove_folder(spark, f"{root}/bronze/{name}/dt={AS_OF - timedelta(days=back)}")
    incremental.rebuild_dates(spark, root, root, tables.read_silver(spark, root, "orders"), DAY)
    moved = raw(spark, sf_dir, "orders").filter(MOVED).withColumns({
        "created_at": F.expr("cast(date_add(cast(created_at as date), 3) as string)"),
        "updated_at": F.expr("cast(cast(updated_at as timestamp) + interval 200 hours as string)")})
    bronze.write_text(moved).mode("append").csv(f"{root}/bronze/orders/{bronze.day_folder(AS_OF)}")
    incremental.refresh(spark, root, root, [AS_OF], lambda: batch.run_silver(spark, root, root, AS_OF), DAY)
    return tables.read_gold(spark, root, "daily_revenue_summary").drop("updated_at", "date_partition")


def _run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_folder(spark, "run")
    for name in schemas.ENTITIES:
        bronze.land_csv(raw(spark, sf_dir, name), root, name, AS_OF)
    counts = batch.run_silver(spark, root, root, AS_OF)
    remove_folder(spark, f"{root}/bronze")  # text that is cleaned already
    return counts.unionByName(batch.run_gold(spark, root, root, AS_OF))


def _run_flat_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_folder(spark, "flat")
    for name in schemas.ENTITIES:
        bronze.land_csv(raw(spark, sf_dir, name), root, name, AS_OF)
    counts = batch.run_flat_clean(spark, root, root, AS_OF)
    return counts.unionByName(batch.run_flat_gold(spark, root, root, AS_OF))


def _catalog_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily table written, declared in the catalog and queried by name."""
    root = fresh_folder(spark, "catalog")
    name = "daily_revenue_summary"
    tables.write_gold(_daily(spark, sf_dir), root, name)
    database = f"retail_gold_{root.rsplit('-', 1)[-1]}"  # of this run alone
    tables.create_database(spark, database, "Business tables", f"{root}/gold")
    tables.create_table(spark, database, name, schemas.GOLD_TYPES[name],
                        schemas.GOLD_LAYOUT[name][0], f"{root}/gold/{name}")
    columns = [column for column in schemas.GOLD_TYPES[name] if column != "updated_at"]
    return spark.table(f"{database}.{name}").select(*columns)


# What is asked of every table of the catalog: some of its partitions.
ASKED = {
    "daily_revenue_summary": "order_date between date '1996-02-01' and date '1996-03-31'",
    "customer_rfm": f"date_partition = '{DAY}'",
    "product_performance": "category like 'P%'",
    "geo_revenue": "order_date between date '1999-12-15' and date '2000-01-14'",
    "order_status_funnel": "order_date < date '1995-02-01'",
    "orders": f"date_partition >= '{AS_OF - timedelta(days=6)}'",
}


def _catalog_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of some partitions of the six tables, queried by name, and the number of partition folders whose files were read for them."""
    root = fresh_folder(spark, "published")
    run = root.rsplit("-", 1)[-1]  # databases of this run alone
    gold_base, silver_base = f"retail_gold_{run}", f"retail_silver_{run}"
    tables.create_database(spark, gold_base, "Business tables", f"{root}/gold")
    tables.create_database(spark, silver_base, "Clean tables", f"{root}/silver")
    for name, built in {"daily_revenue_summary": _daily, "customer_rfm": _rfm, "product_performance": _performance,
                        "geo_revenue": _geo, "order_status_funnel": _funnel}.items():
        tables.publish_gold(built(spark, sf_dir), root, name, gold_base)
    days = [AS_OF - timedelta(days=back) for back in range(SPREAD_DAYS)]
    tables.publish_cleaned(clean.cleaned("orders", raw_by_day(spark, sf_dir, "orders"), None), root, "orders", days, silver_base)
    result = None
    for name, asked in ASKED.items():
        rows = spark.table(f"{silver_base if name == 'orders' else gold_base}.{name}").where(asked)
        folders = {path.rsplit("/", 2)[-2] for path in rows.inputFiles()}  # after pruning
        counted = rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(folders)).cast("bigint").alias("partitions_read"))
        result = counted if result is None else result.unionByName(counted)
    return result


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_folder(spark, "files")
    _land_by_day(spark, sf_dir, root)
    return manifest.file_manifest(spark, root)


def _ingest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table, date and status of the files; their number and size depend on the cluster."""
    return (_manifest(spark, sf_dir).groupBy("table_name", "ingest_date", "ext", "status")
            .agg(F.count_if(F.col("size_bytes") == 0).alias("empty_files")))


def _ingest_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean orders after two runs by the manifest: all dates but the last, then the last beside files that are not accepted."""
    root = fresh_folder(spark, "ingest")
    rows = raw_by_day(spark, sf_dir, "orders")
    for part in (rows.filter(F.col("date_partition") < DAY), rows.filter(F.col("date_partition") == DAY)):
        bronze.land_csv_days(part, root, "orders", "date_partition")
        bronze.land_csv_days(part, root, "returns", "date_partition")
        (part.select("order_id", F.col("date_partition").alias("dt")).hint("rebalance", "dt")
         .write.mode("append").partitionBy("dt").text(f"{root}/bronze/orders"))
        ingest.ingest(spark, root, root, f"{root}/manifest")
    return tables.read_silver(spark, root, "orders").drop("processed_at")


# Keys of files as events name them, one per order, with all kinds that occur.
EVENT_KEYS = """
case o_orderkey % 7 when 0 then concat('inbox/', cast(o_orderkey as string), '.csv')
  when 1 then concat('bronze/returns/dt=', replace(cast(cast(o_orderdate as date) as string), '-', '/'), '/', cast(o_orderkey as string), '.csv')
  when 2 then concat('bronze/orders/dt=', cast(cast(o_orderdate as date) as string), '/notes+', cast(o_orderkey as string), '.txt')
  when 3 then concat('bronze/customers/dt%3D', cast(cast(o_orderdate as date) as string), '/a%20b.json')
  when 4 then concat('bronze/products/dt=', cast(cast(o_orderdate as date) as string), '/part-', cast(o_orderkey as string), '.parquet')
  else concat('bronze/orders/dt=', cast(cast(o_orderdate as date) as string), '/part-', cast(o_orderkey as string), '.csv') end"""
EVENT_BYTES = "cast(o_orderkey % 4096 * 1024 + o_custkey as bigint)"


def _file_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "orders").selectExpr(f"{EVENT_KEYS} as key", f"{EVENT_BYTES} as size_bytes")
    return manifest.classify_events(events, "key")


def _ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.ingest_summary(_file_events(spark, sf_dir))


def _ingest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.ingest_totals(_file_events(spark, sf_dir))


def _stream(spark: SparkSession, sf_dir: str) -> str:
    root = fresh_folder(spark, "stream")
    bronze.land_json(raw(spark, sf_dir, "orders"), f"{root}/events")
    order_events.stream_silver_orders(spark, f"{root}/events", f"{root}/target", f"{root}/checkpoint",
                                      DAY).awaitTermination()
    return root


def _stream_silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stream(spark, sf_dir)
    return order_events.read_streamed_orders(spark, f"{root}/target").drop("processed_at")


def _stream_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events over all batches; their split into batches depends on the files."""
    root = _stream(spark, sf_dir)
    return order_events.read_batch_counts(spark, f"{root}/target").agg(
        F.sum("received").alias("received"), F.sum("failed").alias("failed"), F.sum("sent").alias("sent"))


def _stream_merged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders streamed in two runs with a merge after each, and all events of the first run delivered again before the second."""
    root = fresh_folder(spark, "merged")
    orders = raw(spark, sf_dir, "orders")
    later = F.expr("cast(order_id as bigint) % 2 = 1")
    for part in (orders.filter(~later), orders.filter(~later).unionByName(orders.filter(later))):
        bronze.land_json(part, f"{root}/events")
        order_events.stream_silver_orders(spark, f"{root}/events", f"{root}/target", f"{root}/checkpoint", DAY).awaitTermination()
        order_events.merge_batches(spark, f"{root}/target")
    return order_events.read_streamed_orders(spark, f"{root}/target").drop("processed_at")


def _stream_bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_folder(spark, "stream")
    bronze.land_json(raw(spark, sf_dir, "orders"), f"{root}/events")
    order_events.stream_to_bronze(spark, f"{root}/events", f"{root}/bronze",
                                  f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/bronze").select(*schemas.ENTITY_TYPES["orders"])


BROKEN_LINE = "cast(order_id as bigint) % 89 = 0"  # orders whose line in the event files breaks off


def _json_sink(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Counts and target of a stream into JSON files, from lines some of which break off."""
    root = fresh_folder(spark, "sink")
    orders = raw(spark, sf_dir, "orders")
    line = F.to_json(F.struct(*orders.columns))
    (orders.select(F.when(F.expr(BROKEN_LINE), F.substring(line, 1, 25)).otherwise(line).alias("value"))
     .repartition(6).write.text(f"{root}/events"))
    counts = order_events.stream_to_json(spark, f"{root}/events", f"{root}/json", f"{root}/checkpoint", 500, files_per_batch=2)
    return counts, f"{root}/json"


def _stream_json_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events over all batches as the stream counted them, beside those in the files; the split into batches depends on the files."""
    counts, target = _json_sink(spark, sf_dir)
    stored = order_events.read_json_events(spark, target).agg(F.count(F.lit(1)).alias("stored"))
    lines = order_events.read_json_events(spark, target, order_events.FAILED).agg(F.count(F.lit(1)).alias("stored_lines"))
    totals = counts.agg(*(F.sum(name).alias(name) for name in ("received", "failed", "sent")))
    return totals.select("*", stored.scalar().alias("stored"), lines.scalar().alias("stored_lines"))


def _stream_json_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events.read_json_events(spark, _json_sink(spark, sf_dir)[1])


QUERIES: dict[str, Query] = {
    **{f"silver_{name}": _silver_query(name) for name in schemas.ENTITIES},
    **{f"quarantine_{name}": _quarantine_query(name) for name in schemas.ENTITIES},
    "gold_daily_revenue": _gold_query(_daily, "daily_revenue_summary"),
    "gold_customer_rfm": _gold_query(_rfm, "customer_rfm"),
    "rfm_sketched_quartiles": _rfm_sketched_quartiles,
    "unique_customers": _unique_customers,
    "gold_product_performance": _gold_query(_performance, "product_performance"),
    "gold_geo_revenue": _gold_query(_geo, "geo_revenue"),
    "gold_order_funnel": _gold_query(_funnel, "order_status_funnel"),
    **{f"flat_clean_{name}": _flat_query(name) for name in schemas.ENTITIES},
    "flat_daily_revenue": _flat_daily,
    "flat_geo_revenue": _flat_geo,
    "flat_order_funnel": _flat_funnel,
    "revenue_overview": lambda spark, sf_dir: analytics.revenue_overview(_daily(spark, sf_dir), AS_OF),
    "revenue_by_channel": lambda spark, sf_dir: analytics.revenue_by_channel(_daily(spark, sf_dir), AS_OF),
    "wow_growth": lambda spark, sf_dir: analytics.wow_growth(_daily(spark, sf_dir), AS_OF),
    "top_products": lambda spark, sf_dir: analytics.top_products(_performance(spark, sf_dir)),
    "low_stock_alert": lambda spark, sf_dir: analytics.low_stock_alert(_performance(spark, sf_dir)),
    "segment_distribution": lambda spark, sf_dir: analytics.segment_distribution(_rfm(spark, sf_dir)),
    "top_countries": lambda spark, sf_dir: analytics.top_countries(_geo(spark, sf_dir), AS_OF),
    "funnel_share": lambda spark, sf_dir: analytics.funnel_share(_funnel(spark, sf_dir), AS_OF),
    "champions": lambda spark, sf_dir: analytics.champions(_rfm(spark, sf_dir)),
    "silver_quality": lambda spark, sf_dir: analytics.silver_quality(_orders_by_day(spark, sf_dir), AS_OF),
    "latest_daily_revenue": lambda spark, sf_dir: analytics.latest_daily_revenue(
        _gold_query(_daily, "daily_revenue_summary")(spark, sf_dir)),
    "report_channels": lambda spark, sf_dir: report.report_channels(_flat_daily(spark, sf_dir)),
    "report_countries": lambda spark, sf_dir: report.report_countries(_flat_geo(spark, sf_dir)),
    "report_funnel": lambda spark, sf_dir: report.report_funnel(_flat_funnel(spark, sf_dir)),
    "report_summary": lambda spark, sf_dir: report.report_summary(_flat_daily(spark, sf_dir),
                                                                  _flat_geo(spark, sf_dir)),
    "dq_summary": _dq_summary,
    "dq_orphan_items": _dq_orphan_items,
    "dq_duplicate_orders": _dq_duplicate_orders,
    "dq_line_total": _dq_line_total,
    "global_rank": _global_rank,
    "bronze_round_trip": _bronze_round_trip,
    "ingest_manifest": _ingest_manifest,
    "ingest_summary": _ingest_summary,
    "ingest_totals": _ingest_totals,
    "ingest_new_files": _ingest_new_files,
    "mixed_headers_range": _mixed_headers_range,
    "rejected_text": _rejected_text,
    "backfill_range": _backfill_range,
    "gold_incremental": _gold_incremental,
    "run_summary": _run_summary,
    "run_flat_summary": _run_flat_summary,
    "catalog_daily_revenue": _catalog_daily_revenue,
    "catalog_pruned": _catalog_pruned,
    "stream_silver_orders": _stream_silver_orders,
    "stream_merged_orders": _stream_merged_orders,
    "stream_batch_counts": _stream_batch_counts,
    "stream_bronze_orders": _stream_bronze_orders,
    "stream_json_counts": _stream_json_counts,
    "stream_json_orders": _stream_json_orders,
}


def registered() -> dict[str, Query]:
    """All queries, run with dates taken in UTC."""
    def pinned(query: Query) -> Query:
        return lambda spark, sf_dir: query(pin_time_zone(spark), sf_dir)
    return {name: pinned(query) for name, query in QUERIES.items()}
