from pathlib import Path

import pytest
from making import raw, records, scanned_partitions
from pyspark.sql import functions as F

from meterlake.__main__ import main
from meterlake.operators.clean import clean
from meterlake.operators.quality import assert_counts, assert_views
from meterlake.plans import views
from meterlake.plans.load import load, preview
from meterlake.sinks import merging, tables
from meterlake.sources import files


def day(n, **cells):
    return {"meter_id": f"M{n}", "timestamp": f"2024-03-{n:02d} 10:00:00", **cells}


@pytest.fixture
def cleaned(spark):
    return clean(raw(spark, *(day(n) for n in range(1, 6))))


def test_round_trip_keeps_types_and_zeros(spark, cleaned, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitioned(cleaned, path)
    back = files.read_processed(spark, path)
    assert back.dtypes == cleaned.dtypes
    assert records(back) == records(cleaned)
    assert (Path(path) / "year=2024" / "month=03" / "day=05").is_dir()
    assert any(p.name.endswith(".snappy.parquet") for p in Path(path).rglob("*.parquet"))


def test_rerun_is_idempotent_and_leaves_other_days(spark, cleaned, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        tables.write_partitioned(cleaned, path)
    assert records(files.read_processed(spark, path)) == records(cleaned)
    changed = clean(raw(spark, day(2, voltage="1")))
    tables.write_partitioned(changed, path)
    after = files.read_processed(spark, path)
    assert after.count() == 5 and after.filter("day = '02'").first().voltage == 1.0
    tables.write_partitioned(changed, path, mode="rebuild")
    assert files.read_processed(spark, path).count() == 1


def test_a_small_day_is_one_file(spark, tmp_path):
    rows = [day(1, meter_id=f"M{n}") for n in range(200)]
    path = str(tmp_path / "t")
    tables.write_partitioned(clean(raw(spark, *rows).repartition(8)), path)
    assert len(list(Path(path).rglob("*.parquet"))) == 1


def test_catalog_load_and_rebuild(spark, cleaned, tmp_path):
    loaded = tables.load_table(cleaned, "t_load", str(tmp_path / "a"))
    assert loaded.filter("month = '03' AND day = '04'").count() == 1
    tables.load_table(clean(raw(spark, day(9))), "t_load", str(tmp_path / "a"))
    assert spark.table("t_load").count() == 6
    rebuilt = tables.rebuild_table(clean(raw(spark, day(1))), "t_load", str(tmp_path / "b"))
    assert rebuilt.count() == 1
    assert files.read_processed(spark, str(tmp_path / "a")).count() == 6
    # A later load goes where the rebuilt table lives now.
    tables.load_table(clean(raw(spark, day(2))), "t_load", str(tmp_path / "a"))
    assert spark.table("t_load").count() == 2
    assert files.read_processed(spark, tables.table_location(spark, "t_load")).count() == 2
    assert not spark.catalog.tableExists("t_load__next")


def test_qualified_table_name(spark, cleaned, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_db LOCATION '%s'" % (tmp_path / "db"))
    tables.load_table(cleaned, "t_db.readings", str(tmp_path / "a"))
    assert files.read_table(spark, "t_db.readings").count() == 5
    tables.rebuild_table(cleaned.limit(3), "t_db.readings", str(tmp_path / "b"))
    assert spark.table("t_db.readings").count() == 3


def test_failed_rebuild_keeps_the_old_table(spark, cleaned, tmp_path):
    tables.load_table(cleaned, "t_keep", str(tmp_path / "a"))
    broken = cleaned.withColumn("voltage", F.expr("raise_error('no')").cast("double"))
    with pytest.raises(Exception, match="no"):
        tables.rebuild_table(broken, "t_keep", str(tmp_path / "b"))
    assert spark.table("t_keep").count() == 5


def test_discovery_merges_new_columns(spark, cleaned, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitioned(cleaned.filter("day < '03'"), path)
    more = cleaned.filter("day >= '03'").selectExpr("*", "'night' AS tariff")
    more.write.mode("append").partitionBy("year", "month", "day").parquet(path)
    found = tables.discover_table(spark, "t_found", path)
    assert "tariff" in found.columns and found.count() == 5 and found.filter("tariff = 'night'").count() == 3
    assert dict(found.dtypes)["month"] == "string"


def test_full_refresh(spark, cleaned, tmp_path):
    path = str(tmp_path / "t")
    tables.save_full(cleaned, "t_full", path)
    assert tables.save_full(cleaned.limit(2), "t_full", path).count() == 2


def test_source_choice(spark, cleaned, tmp_path):
    csv, parquet = str(tmp_path / "csv"), str(tmp_path / "parquet")
    with pytest.raises(FileNotFoundError):
        files.read_readings(spark, parquet, csv)
    raw(spark, day(1), day(2, voltage=None, rssi="?")).write.option("header", True).csv(csv)
    from_csv = clean(files.read_readings(spark, parquet, csv))
    assert [(r.voltage, r.rssi) for r in from_csv.orderBy("day").collect()] == [(230.5, -70.0), (0.0, None)]
    raw(spark, day(1)).write.parquet(parquet)
    assert files.read_readings(spark, parquet, csv).count() == 1


def test_csv_columns_go_by_name(spark, tmp_path):
    csv = str(tmp_path / "csv")
    source = raw(spark, day(1)).selectExpr("'extra' AS note", "*")
    source.select("note", *reversed(source.columns[1:])).write.option("header", True).csv(csv)
    assert records(clean(files.read_csv(spark, csv))) == records(clean(raw(spark, day(1))))


def test_csv_files_with_different_headers_are_an_error(spark, tmp_path):
    csv = str(tmp_path / "csv")
    source = raw(spark, day(1))
    source.coalesce(1).write.option("header", True).csv(csv)
    source.select(*reversed(source.columns)).coalesce(1).write.mode("append").option("header", True).csv(csv)
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, csv).collect()


def test_load_preview_and_checks(spark, tmp_path):
    csv = str(tmp_path / "csv")
    raw(spark, day(1), day(1), day(2, timestamp=None)).write.option("header", True).csv(csv)
    summary = load(spark, str(tmp_path / "t"), csv=csv, table="t_cli", extracts=str(tmp_path / "x")).first()
    assert (summary.row_count, summary.meters) == (1, 1)
    assert views.extract(spark, str(tmp_path / "x"), "fleet_summary").first().total_meters == 1
    main(["--csv", csv, "--target", str(tmp_path / "u"), "--rebuild"])
    assert files.read_processed(spark, str(tmp_path / "u")).count() == 1
    files.read_csv(spark, csv).createOrReplaceTempView("t_raw")
    assert preview(spark, "t_raw", str(tmp_path / "p"), rows=2).count() == 2
    assert_counts(spark.table("t_cli"), 1, 1)
    with pytest.raises(AssertionError, match="expected 2 rows"):
        assert_counts(spark.table("t_cli"), 2, 1)
    assert_views(spark, ["t_raw"])
    with pytest.raises(AssertionError, match="t_none"):
        assert_views(spark, ["t_raw", "t_none"])
    with pytest.raises(LookupError):
        files.read_table(spark, "t_none")


def test_deliveries_of_one_day_add_up(spark, tmp_path):
    parts = [str(tmp_path / name) for name in ("a", "b")]
    raw(spark, day(1, meter_id="M1"), day(1, meter_id="M2")).write.option("header", True).csv(parts[0])
    raw(spark, day(1, meter_id="M3"), day(1, meter_id="M1")).write.option("header", True).csv(parts[1])
    for target, table in ((str(tmp_path / "t"), None), (str(tmp_path / "u"), "t_merged")):
        for part in parts:
            summary = load(spark, target, csv=part, table=table).first()
        assert (summary.row_count, summary.meters) == (3, 3)
        assert load(spark, target, csv=parts[1], table=table, replace_days=True).first().meters == 2
        assert load(spark, target, csv=parts[0], table=table, rebuild=True).first().meters == 2
    assert not [p.name for p in tmp_path.iterdir() if "__" in p.name]


def month(spark, path):
    tables.write_partitioned(clean(raw(spark, *(day(n) for n in range(1, 31)))), path)
    return files.read_processed(spark, path)


@pytest.mark.parametrize("days", [(17,), (3, 28)])
def test_merge_reads_only_the_days_it_touches(spark, tmp_path, days):
    """One day, two days far apart, and days that the table does not have."""
    stored = month(spark, str(tmp_path / "t"))
    fresh = clean(raw(spark, *(day(n, meter_id="new") for n in days), day(31)))
    fresh.write.parquet(str(tmp_path / "fresh"))
    fresh = spark.read.parquet(str(tmp_path / "fresh")).filter("day <> '31'" if 17 in days else "true")
    old = merging.stored_on_days_of(fresh, stored, str(tmp_path / "days"))
    assert scanned_partitions(old.select("meter_id")) == len(days)
    assert old.count() == len(days)


def test_merge_of_nothing_reads_nothing(spark, tmp_path):
    stored = month(spark, str(tmp_path / "t"))
    fresh = files.read_processed(spark, str(tmp_path / "t")).limit(0)
    assert merging.stored_on_days_of(fresh, stored, str(tmp_path / "days")).count() == 0


class Died(Exception):
    pass


@pytest.mark.parametrize("at, repeat", [(1, True), (2, False), (3, True)])
def test_load_killed_between_two_steps_is_finished_by_the_next(spark, tmp_path, monkeypatch, at, repeat):
    """Died before, in and after the replacement of days; then the same delivery comes again, or another one."""
    target, names = str(tmp_path / "t"), ("a", "b", "c")
    for name, rows in zip(names, ([day(1), day(2)], [day(2, meter_id="late"), day(3)], [day(1, meter_id="other"), day(3)])):
        raw(spark, *rows).coalesce(1).write.option("header", True).csv(str(tmp_path / name))
    load(spark, target, csv=str(tmp_path / "a"))
    calls = []
    write = tables.write_partitioned

    def dying(df, path, *rest, **options):
        calls.append(path)
        if len(calls) == at:
            if at == 2:  # a day is gone and its new files are not there yet
                import shutil

                shutil.rmtree(Path(path) / "year=2024" / "month=03" / "day=02")
            raise Died
        write(df, path, *rest, **options)
        if at == 3 and len(calls) == 2:
            raise Died

    with monkeypatch.context() as patch:
        patch.setattr(merging, "write_partitioned", dying)
        with pytest.raises(Died):
            load(spark, target, csv=str(tmp_path / "b"))
    left = [("b", "c"), ("c",)][not repeat and at > 1]
    for name in left if at > 1 else ("b", "c"):
        load(spark, target, csv=str(tmp_path / name))
    together = files.read_csv(spark, [str(tmp_path / name) for name in names])
    assert records(files.read_processed(spark, target)) == records(clean(together))
    assert not list(tmp_path.glob("t__merge-*"))
