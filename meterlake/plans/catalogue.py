"""The registered queries, by inventory ID."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions import measures, scalars, wide
from meterlake.operators import anomaly, clean, filters, quality
from meterlake.operators.charts import fitted_histogram
from meterlake.plans import charts, dashboard, load, notebook, statements, views
from meterlake.schema import CRITICAL, FLAGS, HEALTHY, RAW_COLUMNS, WARNING
from meterlake.session import fresh_path
from meterlake.sinks import discovery, merging, tables
from meterlake.sources import deliveries, demo, files, paths
from meterlake.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
_WRITTEN: dict[tuple, str] = {}
_OPENED: dict[str, DataFrame] = {}
_LOCK = RLock()
_SOURCES = ("events", "customer", "nation", "region")


def _once(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]) -> str:
    """Path of data written once per session and input into the shared folder.

    The sources' sizes and times are part of the key, so changed data is never
    served from an older load.
    """
    stamps = tuple(paths.stamp(spark, f"{sf_dir}/{name}.parquet") for name in _SOURCES)
    key = (spark.sparkContext.applicationId, label, sf_dir, stamps)
    with _LOCK:
        if key not in _WRITTEN or not paths.exists(spark, _WRITTEN[key]):
            path = fresh_path(spark, label)
            write(path)
            _WRITTEN[key] = path
        return _WRITTEN[key]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demo.raw_readings(spark, sf_dir)


def _load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean(raw(spark, sf_dir), demo.SOURCE_ORDER)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed table of ``sf_dir``: loaded once, then read by every query."""
    path = _readings_path(spark, sf_dir)
    if path not in _OPENED:
        _OPENED[path] = files.read_processed(spark, path)
    return _OPENED[path]


def _readings_path(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "readings", lambda p: tables.write_partitioned(_load(spark, sf_dir), p))


def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The meter-day rollup that all views can read, written once."""

    def write(path: str) -> None:
        views.meter_day_rollup(readings(spark, sf_dir)).write.parquet(path)

    return spark.read.parquet(_once(spark, sf_dir, "rollup", write))


def raw_csv(spark: SparkSession, sf_dir: str) -> str:
    """Path of the raw readings as CSV files."""

    def write(path: str) -> None:
        text = demo.as_text(raw(spark, sf_dir)).select(*RAW_COLUMNS)
        text.write.option("header", True).csv(path)

    return _once(spark, sf_dir, "raw_csv", write)


def raw_parquet(spark: SparkSession, sf_dir: str) -> str:
    return _once(
        spark, sf_dir, "raw_parquet", lambda p: raw(spark, sf_dir).select(*RAW_COLUMNS).write.parquet(p)
    )


#: Headers of four deliveries: complete, short, reordered, and with a column that nobody expects.
FORMS = {
    "a_complete": RAW_COLUMNS,
    "b_short": tuple(name for name in RAW_COLUMNS if name not in ("rssi", "firmware_version", "signal_issue")),
    "c_reordered": ("voltage", *reversed(RAW_COLUMNS[3:]), "timestamp", "meter_id"),
    "d_extended": ("tariff", *RAW_COLUMNS, "batch_no"),
}


def mixed_csv(spark: SparkSession, sf_dir: str) -> str:
    """Path of the raw readings as deliveries whose headers differ, a quarter of the events each."""

    def write(path: str) -> None:
        text = demo.as_text(raw(spark, sf_dir))
        extra = {"tariff": F.lit("night"), "batch_no": F.col("event_id")}
        for i, (form, columns) in enumerate(FORMS.items()):
            part = text.where(F.col("event_id").cast("long") % 4 == i).withColumns(extra).select(*columns)
            part.write.option("header", True).csv(f"{path}/{form}")

    return _once(spark, sf_dir, "mixed_csv", write)


def query(name: str):
    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return register


def over_readings(name: str, build: Callable[..., DataFrame], /, **options) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(readings(spark, sf_dir), **options)


def over_raw(name: str, build: Callable[..., DataFrame], /, **options) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(raw(spark, sf_dir), **options)


# Sources, sinks, catalog.


@query("s01_csv_scan")
def _(spark, sf_dir):
    return clean.clean(files.read_csv(spark, raw_csv(spark, sf_dir)))


@query("s01_several_headers")
def _(spark, sf_dir):
    """Files that are complete, short, reordered and extended, in one delivery."""
    return clean.clean(deliveries.read_delivery(spark, mixed_csv(spark, sf_dir)))


@query("s02_csv_sniffed")
def _(spark, sf_dir):
    return clean.clean(files.read_csv(spark, raw_csv(spark, sf_dir), sniff=True))


@query("s02_sniffed_types")
def _(spark, sf_dir):
    """Likely types of text cells, some of which are faulty, from one pass."""
    return quality.sniffed_types(demo.faulty_text(raw(spark, sf_dir)).select(*RAW_COLUMNS))


@query("s03_parquet_scan")
def _(spark, sf_dir):
    return clean.clean(files.read_parquet(spark, raw_parquet(spark, sf_dir)))


@query("s04_source_choice")
def _(spark, sf_dir):
    csv = raw_csv(spark, sf_dir)
    return clean.clean(files.read_readings(spark, parquet=f"{csv}-absent", csv=csv))


@query("s05_missing_columns")
def _(spark, sf_dir):
    partial = raw(spark, sf_dir).drop("rssi", "firmware_version", "signal_issue")
    return clean.clean(partial, demo.SOURCE_ORDER)


def _registered(spark: SparkSession, sf_dir: str, name: str) -> str:
    tables.register_table(spark, name, _readings_path(spark, sf_dir))
    return name


@query("s06_catalog_scan")
def _(spark, sf_dir):
    name = _registered(spark, sf_dir, "meterlake_s06")
    return views.fleet_summary(files.read_table(spark, name))


@query("s07_partitioned_sink")
def _(spark, sf_dir):
    return readings(spark, sf_dir)


@query("s08_rebuild")
def _(spark, sf_dir):
    base = fresh_path(spark, "s08")
    loaded = readings(spark, sf_dir)
    first = loaded.filter(F.col("day") <= "10")
    tables.rebuild_table(first, "meterlake_s08", base)
    return quality.load_summary(tables.rebuild_table(loaded, "meterlake_s08", base))


@query("s09_partition_overwrite")
def _(spark, sf_dir):
    path = fresh_path(spark, "s09")
    loaded = readings(spark, sf_dir)
    tables.write_partitioned(loaded, path)
    doubled = filters.in_dates(loaded, "2024-01-05", "2024-01-06").withColumn(
        "consumption_kwh", F.col("consumption_kwh") * 2
    )
    tables.write_partitioned(doubled, path)
    return statements.daily_totals(files.read_processed(spark, path))


@query("s09_merge_same_day")
def _(spark, sf_dir):
    """Two deliveries of the same days, each with part of the rows, merged one after the other."""
    path = fresh_path(spark, "s09m")
    delivered = files.read_csv(spark, raw_csv(spark, sf_dir))
    part = F.pmod(F.hash(*delivered.columns), F.lit(3)) == 0
    for number, rows in enumerate((delivered.filter(part), delivered.filter(~part))):
        merging.merge_delivery(rows, f"{path}/table", f"{path}/staging", number)
    paths.delete(spark, f"{path}/staging")
    return files.read_processed(spark, f"{path}/table")


@query("s10_catalog_partitions")
def _(spark, sf_dir):
    name = _registered(spark, sf_dir, "meterlake_s10")
    return spark.table(name).groupBy("year", "month", "day").agg(F.count("*").alias("readings"))


@query("s11_discovery")
def _(spark, sf_dir):
    path = fresh_path(spark, "s11")
    loaded = readings(spark, sf_dir)
    old = filters.in_dates(loaded, date_to="2024-01-15")
    new = filters.in_dates(loaded, date_from="2024-01-16").withColumn("tariff", F.col("voltage") * 0 + 2)
    for part in (old, new):
        part.write.mode("append").partitionBy("year", "month", "day").parquet(path)
    found = tables.discover_table(spark, "meterlake_s11", path)
    return found.groupBy("day").agg(F.count("*").alias("readings"), F.count("tariff").alias("with_tariff"))


def _discovered(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The raw zone, discovered delivery by delivery, and then all again."""
    zone, catalogue = mixed_csv(spark, sf_dir), fresh_path(spark, "s11c")
    for seen in (f"{zone}/a_complete", f"{zone}/b_short", zone, zone):
        found = discovery.discover_zone(spark, zone, catalogue, only=seen)
    return zone, found


@query("s11_raw_zone_log")
def _(spark, sf_dir):
    """Columns that came and went, with the readings of the delivery that brought the change."""
    zone, catalogue = _discovered(spark, sf_dir)
    per_file = deliveries.header_report(spark, zone).select("file", "readings")
    readings_of = per_file.join(catalogue.select("file", "delivery").distinct(), "file").groupBy("delivery")
    return discovery.column_log(catalogue).join(readings_of.agg(F.sum("readings").alias("readings")), "delivery")


@query("s11_raw_zone_versions")
def _(spark, sf_dir):
    zone, catalogue = _discovered(spark, sf_dir)
    cells = discovery.read_zone(spark, zone, catalogue).agg(F.count("tariff").alias("with_tariff"), F.count("rssi").alias("with_rssi"))
    found = cells.first()
    versions = discovery.schema_versions(catalogue).select("version", "delivery", "known_columns")
    return versions.withColumns({name: F.lit(found[name]).cast("long") for name in ("with_tariff", "with_rssi")})


@query("s12_full_refresh")
def _(spark, sf_dir):
    table = tables.save_full(readings(spark, sf_dir), "meterlake_s12", fresh_path(spark, "s12"))
    return views.health_by_status(table)


@query("s13_view_registry")
def _(spark, sf_dir):
    names = views.register_views(rollup(spark, sf_dir), prefix="s13_")
    counts = (
        spark.table(name).agg(F.count("*").alias("row_count")).select(F.lit(name[4:]).alias("view_name"), "row_count")
        for name in names
    )
    return reduce(DataFrame.unionByName, counts)


over_readings("s14_fixed_projection", clean.project)


@query("s15_schema_preview")
def _(spark, sf_dir):
    """The whole raw table with the schema applied, as the preview writes it."""
    raw_path = raw_parquet(spark, sf_dir)
    spark.sql("DROP TABLE IF EXISTS meterlake_s15_raw")
    spark.catalog.createTable("meterlake_s15_raw", path=raw_path, source="parquet")
    mapped = load.preview(spark, "meterlake_s15_raw", fresh_path(spark, "s15"))
    return mapped.groupBy("battery_status", "firmware_version").agg(
        F.count("*").alias("readings"), F.count("timestamp").alias("timed"), F.min("voltage").alias("lowest_voltage")
    )


over_readings("s16_load_summary", quality.load_summary)


@query("s17_arriving_files")
def _(spark, sf_dir):
    source, base = raw_csv(spark, sf_dir), fresh_path(spark, "s17")
    stream = ingest.ingest(
        ingest.arriving_csv(spark, source), f"{base}/table", f"{base}/checkpoint"
    )
    stream.awaitTermination()
    return files.read_processed(spark, f"{base}/table")


@query("s18_materialised_views")
def _(spark, sf_dir):
    """Rows of every extract after a refresh over an older one."""
    base = fresh_path(spark, "s18")
    views.materialise_views(readings(spark, sf_dir).filter(F.col("day") <= "10"), base)
    written = views.materialise_views(readings(spark, sf_dir), base)
    counts = (
        spark.read.parquet(path).agg(F.count("*").alias("row_count")).select(F.lit(name).alias("view_name"), "row_count")
        for name, path in written.items()
    )
    return reduce(DataFrame.unionByName, counts)


@query("s18_incremental_refresh")
def _(spark, sf_dir):
    """Daily consumption from extracts that were refreshed after two days of the table had changed."""
    base = fresh_path(spark, "s18i")
    loaded = readings(spark, sf_dir)
    tables.write_partitioned(loaded, f"{base}/table", balance=False)  # a copy, clustered by day already
    views.refresh_views(files.read_processed(spark, f"{base}/table"), f"{base}/extracts")
    doubled = filters.in_dates(loaded, "2024-01-05", "2024-01-06").withColumn("consumption_kwh", F.col("consumption_kwh") * 2)
    tables.write_partitioned(doubled, f"{base}/table", balance=False)
    views.refresh_views(files.read_processed(spark, f"{base}/table"), f"{base}/extracts")
    return views.extract(spark, f"{base}/extracts", "daily_consumption")


# Cleaning, predicates, scalars.


@query("p01_null_fill")
def _(spark, sf_dir):
    filled = clean.conform(raw(spark, sf_dir), keep=demo.SOURCE_ORDER)
    return filled.drop("health_status")


@query("p01b_null_fill_labels_only")
def _(spark, sf_dir):
    filled = clean.conform(raw(spark, sf_dir), fill_numeric=False, keep=demo.SOURCE_ORDER)
    return filled.select(*demo.SOURCE_ORDER, "meter_id", "voltage", "signal_issue", "firmware_version")


@query("p02_cast_projection")
def _(spark, sf_dir):
    typed = clean.conform(demo.faulty_text(raw(spark, sf_dir)), keep=demo.SOURCE_ORDER)
    return typed.drop("health_status")


@query("p03_parse_time")
def _(spark, sf_dir):
    text = demo.faulty_text(raw(spark, sf_dir))
    return text.select(
        *demo.SOURCE_ORDER,
        scalars.parse("timestamp", "timestamp").alias("timestamp"),
        scalars.parse("last_communication_time", "timestamp").alias("last_communication_time"),
    )


@query("p04_drop_incomplete")
def _(spark, sf_dir):
    kept = clean.drop_incomplete(clean.conform(raw(spark, sf_dir)))
    return kept.groupBy("meter_id").agg(F.count("*").alias("readings"))


@query("p05_dedupe")
def _(spark, sf_dir):
    kept = clean.dedupe(clean.drop_incomplete(clean.conform(raw(spark, sf_dir), keep=demo.SOURCE_ORDER)), demo.SOURCE_ORDER)
    return kept.select("meter_id", "timestamp", "consumption_kwh", *demo.SOURCE_ORDER)


@query("p06_dedupe_by_content")
def _(spark, sf_dir):
    kept = clean.dedupe(clean.drop_incomplete(clean.conform(raw(spark, sf_dir)).drop("health_status")))
    return kept.select("meter_id", "timestamp", "voltage", "rssi", "consumption_kwh")


over_readings(
    "p07_lag_elapsed",
    lambda df: df.select("meter_id", "timestamp", scalars.lag_minutes().alias("lag_minutes")),
)
over_readings(
    "p08_lag_boundary",
    lambda df: df.select("meter_id", "timestamp", scalars.lag_minutes(mode="boundary").alias("lag_minutes")),
)
over_readings(
    "p09_issue_count",
    lambda df: df.groupBy(scalars.issue_count().alias("issue_count")).agg(F.count("*").alias("readings")),
)
over_readings(
    "p10_health_status",
    lambda df: df.groupBy("issue_count", scalars.health_status().alias("health_status")).agg(
        F.count("*").alias("readings")
    ),
)
over_readings("p11_event_date", lambda df: df.select("meter_id", "timestamp", F.to_date("timestamp").alias("event_date")))
over_readings(
    "p12_calendar_keys",
    lambda df: df.select(
        "meter_id",
        "timestamp",
        F.year("timestamp").alias("year"),
        scalars.two_digits(F.month("timestamp")).alias("month"),
        scalars.two_digits(F.dayofmonth("timestamp")).alias("day"),
    ),
)
over_readings(
    "p13_flag_filter",
    lambda df: df.filter("signal_issue").select("meter_id", "timestamp", "rssi"),
)
over_readings(
    "p14_label_filter",
    lambda df: df.filter(F.col("health_status") == WARNING).select("meter_id", "timestamp", "issue_count"),
)
over_readings(
    "p15_offline_threshold",
    lambda df: df.groupBy("state").agg(F.count_if(scalars.offline()).alias("offline_readings")),
)
over_readings(
    "p16_partition_filter",
    lambda df: filters.in_partition(df, 2024, 1, 15).groupBy("year", "month", "day", "state").agg(F.count("*").alias("readings")),
)
over_readings(
    "p17_dashboard_filters",
    lambda df: filters.apply_filters(
        df,
        date_from="2024-01-05",
        date_to="2024-01-20",
        state=["ASIA", "EUROPE", "AFRICA"],
        district=[f"NATION_{n}" for n in range(0, 20)],
        discom=[f"DISCOM-{n}" for n in range(8)],
        firmware_version=["FW-2.0.0", "FW-2.1.0", "FW-2.3.0", "Unknown"],
        health_status=[HEALTHY, WARNING],
    ),
)


def _flagged(*columns: str) -> Callable[[DataFrame], DataFrame]:
    def build(df: DataFrame) -> DataFrame:
        return filters.with_flags(df).groupBy(*columns).agg(F.count("*").alias("readings"))

    return build


over_readings("p18_unhealthy_flag", _flagged("health_status", "unhealthy_flag"))
over_readings("p19_offline_flag", _flagged("comm_issue", "offline_flag"))
over_readings("p20_low_battery_flag", _flagged("battery_status", "low_battery_flag"))
over_readings("p21_signal_quality", _flagged("rssi", "signal_quality"))
over_readings(
    "p22_constant_label",
    lambda df: df.agg(F.lit("All readings").alias("label"), F.count("*").alias("readings")),
)

# Aggregation and ordering.

over_readings("a01_count", lambda df: df.agg(F.count("*").alias("readings")))
over_readings("a02_count_distinct", lambda df: statements.meters_by(df, "feeder_id"))
@query("a05_wide_sums")
def _(spark, sf_dir):
    """Sums in which values cancel that are too far apart for doubles."""
    small = (F.col("battery_pct") * 0.25, F.col("issue_count") / float(1 << 20))
    values = F.array(*(F.lit(v) for v in (1e300, 1e13 + 0.5, -1e300, -1e13)), *small)
    return wide.wide_sums(readings(spark, sf_dir).select("district", F.explode(values).alias("v")), ["district"], "v")


@query("a02_sketched_meters")
def _(spark, sf_dir):
    """Meters of each area and status, exact and from merged sketches of the days."""
    loaded = readings(spark, sf_dir)
    sketches = measures.sketch_rollup(loaded)
    exact = views.geographic_health(loaded).select(*views.AREA, "health_status", "meters")
    estimated = views.geographic_health(sketches, approx=True).select(*views.AREA, "health_status", F.col("meters").alias("estimate"))
    close = F.abs(F.col("estimate") - F.col("meters")) <= F.greatest(F.lit(1.0), F.col("meters") * 0.03)
    return exact.join(estimated, [*views.AREA, "health_status"]).withColumn("is_close", close).drop("estimate")


over_readings(
    "a03_count_if", lambda df: df.agg(*(F.count_if(flag).alias(flag) for flag in FLAGS))
)
over_readings(
    "a04_conditional_sum",
    lambda df: df.groupBy("discom").agg(
        *(F.sum(F.when(F.col(flag), 1).otherwise(0)).alias(flag) for flag in FLAGS)
    ),
)
over_readings(
    "a05_sum",
    lambda df: measures.components(df).groupBy("district").agg(
        measures.total("consumption_kwh").alias("consumption_kwh"), measures.total("issue_count").alias("issues")
    ),
)
over_readings(
    "a06_avg",
    lambda df: measures.components(df).groupBy("district").agg(
        *(measures.mean(name).alias(f"average_{name}") for name in ("voltage", "current", "power_factor", "rssi", "battery_pct"))
    ),
)
over_readings("a07_min", lambda df: df.groupBy("district").agg(F.min("rssi").alias("worst_rssi"), F.min("voltage").alias("lowest_voltage")))
over_readings(
    "a08_time_bounds",
    lambda df: df.groupBy("meter_id").agg(
        F.max("timestamp").alias("last_seen_at"),
        F.min("event_date").alias("first_day"),
        F.max("event_date").alias("last_day"),
    ),
)
over_readings(
    "a09_rounding",
    lambda df: measures.components(df).groupBy("meter_id").agg(
        measures.rounded_mean("voltage", 2).alias("voltage_2"), measures.rounded_mean("power_factor", 3).alias("power_factor_3")
    ),
)
over_readings(
    "a10_row_percentage",
    lambda df: measures.components(df).groupBy("feeder_id").agg(
        measures.pct_of_rows(F.col("health_status") == CRITICAL).alias("critical_pct")
    ),
)
over_readings(
    "a11_global",
    lambda df: measures.components(df).agg(
        measures.row_count().alias("readings"), measures.meters().alias("meters"), measures.total("consumption_kwh").alias("consumption_kwh")
    ),
)
over_readings(
    "a12_five_keys",
    lambda df: df.groupBy("meter_id", "state", "district", "discom", "feeder_id").agg(F.count("*").alias("readings")),
)
over_readings(
    "a13_reaggregation",
    lambda df: views.feeder_risk(df).groupBy("discom").agg(
        F.sum("meters").alias("feeder_meters"), F.min("average_rssi").alias("lowest_average_rssi"), F.sum("total_issues").alias("total_issues")
    ),
)
over_readings(
    "a14_ordering",
    lambda df: df.groupBy("district", "battery_status").agg(F.count("*").alias("readings")).orderBy("district", F.desc("readings"), "battery_status"),
)
over_readings("a15_top_k", statements.biggest_consumers, k=25)
over_readings("a16_labelled_counts", views.issue_mix)
over_readings(
    "a17_row_number",
    lambda df: clean.dedupe(df.select("meter_id", "timestamp", "event_date", "rssi")).groupBy("event_date").agg(F.count("*").alias("readings")),
)

# Views.

for _n, (_name, _build) in enumerate(views.VIEWS.items(), start=1):
    over_readings(f"v{_n:02d}_{_name}", _build)

# Statements.

_STATEMENTS = (
    ("fleet_summary", views.fleet_summary),
    ("meters_by_status", statements.meters_by_status),
    ("communication_totals", statements.communication_totals),
    ("signal_by_state", statements.signal_by_state),
    ("electrical_totals", statements.electrical_totals),
    ("electrical_hotspots", statements.electrical_hotspots),
    ("battery_by_status", statements.battery_by_status),
    ("low_battery_devices", statements.low_battery_devices),
    ("daily_totals", statements.daily_totals),
    ("monthly_totals", statements.monthly_totals),
    ("biggest_consumers", statements.biggest_consumers),
    ("consumption_by_discom", statements.consumption_by_discom),
    ("status_by_state", statements.status_by_state),
    ("status_by_district", statements.status_by_district),
    ("status_by_discom", statements.status_by_discom),
    ("meters_by_firmware", statements.meters_by_firmware),
    ("firmware_health", statements.firmware_health),
)
for _n, (_name, _build) in enumerate(_STATEMENTS, start=1):
    over_readings(f"q{_n:02d}_{_name}", _build)

# Notebook.

_NOTEBOOK = (
    ("fleet_summary", views.fleet_summary),
    ("health_split", notebook.health_split),
    ("weakest_states", notebook.weakest_states),
    ("electrical_by_state", notebook.electrical_by_state),
    ("battery_by_status", notebook.battery_by_status),
    ("consumption_trend", notebook.consumption_trend),
    ("firmware_issues", notebook.firmware_issues),
    ("leading_consumers", notebook.leading_consumers),
    ("warning_districts", notebook.warning_districts),
)
for _n, (_name, _build) in enumerate(_NOTEBOOK, start=1):
    over_readings(f"n{_n:02d}_{_name}", _build)
over_readings("n03x_weakest_states_exact", notebook.exact_weakest_states)
over_readings("n04x_electrical_by_state_exact", notebook.exact_electrical_by_state)
over_readings("n05x_battery_by_status_exact", notebook.exact_battery_by_status)
over_readings("n07x_firmware_issues_exact", notebook.exact_firmware_issues)

# Charts.

for _n, (_name, _chart) in enumerate(charts.CHARTS.items(), start=1):
    over_readings(f"c{_n:02d}_{_name}", _chart.query)

# Deployed visuals.

over_readings("d01_total_meters", dashboard.total_meters)
over_readings("d02_average_voltage", dashboard.kpi, measure="voltage")
over_readings("d03_average_rssi", dashboard.kpi, measure="rssi")
over_readings("d04_average_battery", dashboard.kpi, measure="battery_pct")
over_readings("d05_average_kwh", dashboard.kpi, measure="consumption_kwh", digits=3)
over_readings("d06_fleet_health", statements.meters_by_status)
over_readings("d07_state_health", statements.status_by_state)
over_readings("d08_consumption_by_discom", statements.consumption_by_discom)
over_readings("d09_battery_status", statements.battery_by_status)
over_readings("d10_fleet_table", dashboard.fleet_table)
over_readings("d11_firmware", statements.meters_by_firmware)
over_readings("d12_district_health", statements.status_by_district)
over_readings("d13_voltage_by_state", dashboard.mean_by, key="state", measure="voltage")
over_readings("d14_rssi_by_discom", dashboard.mean_by, key="discom", measure="rssi")
over_readings("d15_consumption_by_feeder", dashboard.ranked_consumption, key="feeder_id")
over_readings(
    "d16_device_details",
    dashboard.device_details,
    date_from="2024-01-08",
    date_to="2024-01-21",
    state=["AMERICA", "ASIA"],
    health_status=[WARNING, CRITICAL],
)

# Specified visuals.

over_readings("e01_total_meters", dashboard.total_meters)
over_readings("e02_healthy_meters", dashboard.status_meters, status=HEALTHY)
over_readings("e03_warning_meters", dashboard.status_meters, status=WARNING)
over_readings("e04_critical_meters", dashboard.status_meters, status=CRITICAL)
over_readings("e02_04_meters_with_status", dashboard.meters_with_status)
over_readings("e05_average_voltage", dashboard.kpi, measure="voltage")
over_readings("e06_average_rssi", dashboard.kpi, measure="rssi")
over_readings("e07_average_battery", dashboard.kpi, measure="battery_pct")
over_readings("e08_average_kwh", dashboard.kpi, measure="consumption_kwh", digits=3)
over_readings("e09_health_donut", statements.meters_by_status)
over_readings("e10_health_trend", dashboard.health_trend)
over_readings("e11_fleet_table", dashboard.fleet_table)
over_readings("e12_state_health", statements.status_by_state)
over_readings("e13_district_heatmap", dashboard.status_heatmap)
QUERIES["e14_discom_comparison"] = lambda spark, sf_dir: dashboard.meters_with_status(
    readings(spark, sf_dir), "discom"
)
over_readings("e15_rssi_distribution", dashboard.distribution, column="rssi")
over_readings(
    "e16_comm_issues_by_state", dashboard.flag_by, key="state", flag="comm_issue", name="communication_issues"
)
over_readings(
    "e16_comm_issues_by_discom", dashboard.flag_by, key="discom", flag="comm_issue", name="communication_issues"
)
over_readings("e17_signal_quality", dashboard.signal_quality_histogram)
over_readings("e18_worst_signal_devices", dashboard.worst_signal_devices)
for _column in ("voltage", "current", "power_factor", "battery_pct"):
    over_readings(f"e19_fitted_bins_{_column}", fitted_histogram, column=_column)
over_readings("e19_voltage_distribution", dashboard.distribution, column="voltage")
over_readings("e20_power_factor_distribution", dashboard.distribution, column="power_factor")
over_readings(
    "e21_voltage_issues_by_state", dashboard.flag_by, key="state", flag="voltage_issue", name="voltage_violations"
)
over_readings("e22_current_distribution", dashboard.distribution, column="current")
over_readings("e23_electrical_devices", dashboard.electrical_devices)
over_readings("e24_battery_distribution", dashboard.distribution, column="battery_pct")
over_readings("e25_low_battery_devices", statements.low_battery_devices)
over_readings("e26_battery_by_firmware", dashboard.mean_by, key="firmware_version", measure="battery_pct")
over_readings("e27_consumption_by_state", dashboard.ranked_consumption, key="state")
over_readings("e28_top_feeders", dashboard.ranked_consumption, key="feeder_id", k=dashboard.TOP_FEEDERS)
over_readings("e29_top_districts", dashboard.ranked_consumption, key="district")
over_readings(
    "e30_firmware_health",
    lambda df: statements.meters_by(df, "firmware_version", "health_status").orderBy("firmware_version", "health_status"),
)
over_readings("e31_firmware_issue_table", dashboard.firmware_issue_table)

# Data quality.

over_raw("k01_shape", lambda df: quality.shape(df.select(*RAW_COLUMNS)))
over_raw("k02_required_fields", lambda df: quality.null_counts(df.drop("rssi", "discom")))
over_raw("k03_null_counts", quality.null_counts)
over_raw("k04_duplicates", lambda df: quality.identity_profile(df).select("row_count", "duplicate_rows"))
over_raw("k05_unique_meters", lambda df: quality.identity_profile(df).select("unique_meters"))
over_raw("k06_time_range", lambda df: quality.identity_profile(df).select("first_reading_at", "last_reading_at"))
over_raw("k07_numeric_ranges", quality.numeric_ranges)
over_readings("k08_category_counts", quality.category_counts)
over_raw("k09_issue_rates", quality.issue_rates)
over_raw("k10_verdict_raw", quality.verdict)
over_readings(
    "k10_verdict_processed",
    lambda df: quality.verdict(df, [name for name in quality.REQUIRED_FIELDS if name != "last_communication_time"]),
)


@query("k11_expected_counts")
def _(spark, sf_dir):
    """Rows and meters of the table beside what the raw delivery says they must be."""
    expected = quality.load_losses(raw(spark, sf_dir)).select(F.col("kept_rows").alias("expected_rows"))
    found = quality.identity_profile(readings(spark, sf_dir)).select("row_count", "unique_meters")
    both = found.unionByName(expected, allowMissingColumns=True)
    return both.agg(*(F.max(name).alias(name) for name in both.columns)).withColumn(
        "as_expected", F.col("row_count") == F.col("expected_rows")
    )


@query("k12_view_presence")
def _(spark, sf_dir):
    names = views.register_views(rollup(spark, sf_dir), prefix="k12_")
    quality.assert_views(spark, names)
    counts = (
        spark.table(name).agg(F.count("*").alias("row_count")).select(F.lit(name[4:]).alias("view_name"), "row_count")
        for name in names
    )
    return reduce(DataFrame.unionByName, counts)


over_readings("k13_status_counts", lambda df: views.health_by_status(df).select("health_status", "readings"))
over_readings("k14_range_violations", quality.range_violations)
over_raw("k15_duplicate_readings", quality.duplicate_readings)
over_raw("k15_missing_timestamps", quality.missing_timestamps)
over_raw("k15_load_losses", quality.load_losses)


@query("k16_schema_drift")
def _(spark, sf_dir):
    delivered = raw(spark, sf_dir).drop("rssi")
    reordered = delivered.select("timestamp", "meter_id", *RAW_COLUMNS[2:8], *RAW_COLUMNS[9:], F.col("event_id").alias("batch_no"))
    return quality.drift_report(reordered)


@query("k16_delivery_headers")
def _(spark, sf_dir):
    """One line a delivery and kind of header: what it lacks, adds or moves."""
    report = deliveries.header_report(spark, mixed_csv(spark, sf_dir))
    kinds = report.withColumn("delivery", F.element_at(F.split("file", "/"), -2)).groupBy("delivery", "missing", "unexpected", "twice", "moved", "readable")
    return kinds.agg(F.sum("readings").alias("readings"))


@query("k16_unparseable_cells")
def _(spark, sf_dir):
    return quality.unparseable_counts(demo.faulty_text(raw(spark, sf_dir)))


@query("k16_declared_status")
def _(spark, sf_dir):
    """Deliveries that declare every voltage issue critical, against the derived status."""
    declared = raw(spark, sf_dir).withColumn(
        "health_status", F.when(F.col("voltage_issue"), CRITICAL).otherwise(HEALTHY)
    )
    return quality.declared_mismatches(declared)


@query("k17_reconcile")
def _(spark, sf_dir):
    """Communication health under the two lag definitions: the rows that differ."""
    loaded = readings(spark, sf_dir)
    boundary = loaded.withColumn("communication_lag_minutes", scalars.lag_minutes(mode="boundary"))
    return quality.row_differences(views.communication_health(loaded), views.communication_health(boundary))


@query("k17_reconcile_by_day")
def _(spark, sf_dir):
    """A table against its own later state, in which two days have changed: the readings of those days alone differ."""
    loaded = readings(spark, sf_dir)
    path = fresh_path(spark, "k17")
    tables.write_partitioned(loaded, path)
    doubled = filters.in_dates(loaded, "2024-01-05", "2024-01-06").withColumn("consumption_kwh", F.col("consumption_kwh") * 2)
    tables.write_partitioned(doubled, path)
    found = quality.partition_differences(loaded, files.read_processed(spark, path))
    return found.groupBy("event_date").agg(F.sum("left_rows").alias("before"), F.sum("right_rows").alias("after"))


# Named future analytics.

over_readings("x01_rolling_outliers", anomaly.rolling_outliers, window=12, threshold=2.5)
over_readings(
    "x02_alert_severity",
    lambda df: anomaly.with_severity(df).groupBy("health_status", "severity").agg(F.count("*").alias("readings")),
)


@query("x03_row_level_access")
def _(spark, sf_dir):
    """What the manager of one district sees: the whole of its state."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    grants = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("principal"), F.col("r_name").alias("state")
    )
    visible = filters.restrict(readings(spark, sf_dir), grants, "NATION_7")
    return visible.groupBy("state", "district").agg(F.count("*").alias("readings"))


@query("x03_levels")
def _(spark, sf_dir):
    """Grants on a state, a district, a discom and a discom of one district, less a denied district."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    rules = (
        ("n_nationkey = 1", "r_name", "NULL", "NULL", False),
        ("n_nationkey IN (2, 7)", "NULL", "n_name", "NULL", False),
        ("n_nationkey = 3", "NULL", "NULL", "concat('DISCOM-', n_nationkey % 10)", False),
        ("n_nationkey = 14", "r_name", "n_name", "concat('DISCOM-', n_nationkey % 10)", False),
        ("n_nationkey = 11", "NULL", "n_name", "NULL", True),
    )
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    grants = reduce(
        DataFrame.unionByName,
        (
            places.where(where).selectExpr(
                "'planner' AS principal",
                *(f"CAST({value} AS string) AS {level}" for value, level in zip(values, filters.AREA_LEVELS)),
                f"{str(denied).lower()} AS denied",
            )
            for where, *values, denied in rules
        ),
    )
    visible = filters.restrict_levels(readings(spark, sf_dir), grants, "planner")
    return visible.groupBy("state", "district", "discom").agg(F.count("*").alias("readings"))


over_readings(
    "x04_feeder_outliers",
    lambda df: anomaly.group_outliers(
        views.feeder_risk(df).select("feeder_id", "state", "district", "discom", "total_consumption_kwh"),
        "discom",
        "total_consumption_kwh",
        threshold=2.0,
    ),
)
QUERIES["x05_voltage_bands"] = lambda spark, sf_dir: anomaly.voltage_bands(readings(spark, sf_dir), "state", "district")
