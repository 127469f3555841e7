"""Deliveries whose headers differ, discovery over them, versions of folders, and incremental extracts."""

import pytest
from making import GOOD, SF_SMALL, raw, records, scanned_partitions
from pyspark.sql import functions as F

from meterlake.operators import filters
from meterlake.operators.clean import clean
from meterlake.plans import catalogue, views
from meterlake.schema import RAW_COLUMNS
from meterlake.sinks import discovery, tables, versions
from meterlake.sources import deliveries, demo, files, paths
from meterlake.streaming import ingest


def put(folder, name, header, *rows, end="\n"):
    folder.mkdir(exist_ok=True, parents=True)
    lines = [",".join(header), *(",".join(row.get(c.strip('"').lower(), "x") or "" for c in header) for row in rows)]
    (folder / name).write_text(end.join(lines) + end, encoding="utf-8")


def row(meter, **cells):
    return {**GOOD, "meter_id": meter, **cells}


def test_files_are_read_by_their_own_header(spark, tmp_path):
    zone = tmp_path / "zone"
    put(zone, "a.csv", RAW_COLUMNS, row("A1"), row("A2", voltage=None))
    put(zone, "b.csv", [f'"{c.upper()}"' for c in reversed(RAW_COLUMNS)], row("B1"), end="\r\n")
    put(zone / "deep", "c.csv", ["﻿note", *(c for c in RAW_COLUMNS if c not in ("rssi", "comm_issue"))], row("C1"))
    put(zone, "d.csv", RAW_COLUMNS)
    (zone / "e.csv").write_text("")
    (zone / "f.csv").write_text("\n\n" + ",".join(RAW_COLUMNS) + "\n\n")
    got = clean(deliveries.read_delivery(spark, str(zone)))
    want = clean(raw(spark, row("A1"), row("A2", voltage=None), row("B1"), row("C1", rssi=None, comm_issue=None)))
    assert records(got) == records(want)
    report = {r.file.rsplit("/", 1)[1]: r for r in deliveries.header_report(spark, str(zone)).collect()}
    assert sorted(report) == ["a.csv", "b.csv", "c.csv", "d.csv", "f.csv"]
    assert report["c.csv"].missing == "rssi,comm_issue" and report["c.csv"].unexpected == "note" and not report["c.csv"].moved
    assert report["b.csv"].moved and report["b.csv"].readings == 1 and report["d.csv"].readings == 0


def test_unreadable_headers_name_the_file(spark, tmp_path):
    put(tmp_path / "a", "late.csv", [c for c in RAW_COLUMNS if c != "timestamp"], row("A"))
    put(tmp_path / "b", "double.csv", [*RAW_COLUMNS, "Voltage"], row("A"))
    for folder, match in (("a", "timestamp in .*late.csv"), ("b", "voltage, in .*double.csv")):
        with pytest.raises(ValueError, match=match):
            deliveries.read_delivery(spark, str(tmp_path / folder))
        assert not deliveries.header_report(spark, str(tmp_path / folder)).first().readable


def test_a_large_file_in_parts_has_one_header(spark, tmp_path):
    put(tmp_path / "z", "a.csv", RAW_COLUMNS, *(row(f"M{i}") for i in range(400)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        (found,) = deliveries.header_report(spark, str(tmp_path / "z")).collect()
        assert found.readable and not found.missing and found.readings == 400
        assert deliveries.read_delivery(spark, str(tmp_path / "z")).count() == 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_packed_files_and_long_headers(spark, tmp_path):
    import gzip

    put(tmp_path / "z", "a.csv", [*RAW_COLUMNS, *(f"more_{i}" for i in range(20_000))], row("A1"))
    text = (tmp_path / "z" / "a.csv").read_bytes()
    (tmp_path / "z" / "b.csv.gz").write_bytes(gzip.compress(text.replace(b"A1", b"B1")))
    (tmp_path / "z" / "a.csv").write_bytes(b"\n" * 100_000 + text.rstrip(b"\n"))
    found = deliveries.headers(spark, deliveries.delivered_files(spark, str(tmp_path / "z")))
    assert [deliveries.columns_of(h)[-1] for h in found.values()] == ["more_19999"] * 2
    assert deliveries.header_report(spark, str(tmp_path / "z")).where("readable and readings = 1").count() == 2


def test_arriving_files_may_differ_in_their_headers(spark, tmp_path):
    zone = tmp_path / "zone"
    put(zone, "a.csv", RAW_COLUMNS, row("A1"))
    put(zone, "b.csv", [*reversed(RAW_COLUMNS), "tariff"], row("B1"))
    put(zone, "c.csv", [c for c in RAW_COLUMNS if c != "rssi"], row("C1"))
    stream = ingest.ingest(ingest.arriving_csv(spark, str(zone), max_files=2), str(tmp_path / "t"), str(tmp_path / "c"))
    stream.awaitTermination()
    got = files.read_processed(spark, str(tmp_path / "t"))
    assert records(got) == records(clean(raw(spark, row("A1"), row("B1"), row("C1", rssi=None))))


def test_discovery_in_any_order_and_again(spark, tmp_path):
    zone = tmp_path / "zone"
    put(zone / "d1", "x.csv", ["a", "b", "c"], {})
    put(zone / "d2", "x.csv", ["a", "c"], {})
    put(zone / "d2", "y.csv", ["A", "d"], {})
    put(zone / "d3", "x.csv", ["b", "a"], {"b": "1"})
    log = {
        ("d1", "a", "appeared"), ("d1", "b", "appeared"), ("d1", "c", "appeared"), ("d2", "b", "vanished"), ("d2", "d", "appeared"),
        ("d3", "b", "returned"), ("d3", "c", "vanished"), ("d3", "d", "vanished"),
    }
    for i, order in enumerate((("d1", "d2", "d3"), ("d3", "d1", "d2"))):
        catalogue = str(tmp_path / f"c{i}")
        for part in (*order, order[0]):
            found = discovery.discover_zone(spark, str(zone), catalogue, only=f"{zone}/{part}")
        again = discovery.discover_zone(spark, str(zone), catalogue)
        assert again.count() == found.count() == 9
        assert {tuple(r) for r in discovery.column_log(again).collect()} == log
        versions_ = discovery.schema_versions(again).orderBy("version").collect()
        assert [(r.delivery, r.columns, r.known_columns) for r in versions_] == [("d1", "a,b,c", 3), ("d2", "a,c,d", 4), ("d3", "a,b", 4)]
        cells = discovery.read_zone(spark, str(zone), again)
        assert cells.columns == ["a", "b", "c", "d"] and cells.count() == 4 and cells.where("b = '1'").count() == 1


class Died(Exception):
    pass


@pytest.mark.parametrize("at", ["write", "write_text", "move", "read_text"])
def test_a_version_that_dies_is_never_seen(spark, tmp_path, monkeypatch, at):
    base = str(tmp_path / "t")
    write = lambda n: lambda path: spark.range(n).coalesce(1).write.parquet(path)
    spark.range(9).write.parquet(base)
    versions.publish(spark, base, write(1))
    versions.publish(spark, base, write(2))

    def dies(*_):
        raise Died

    with monkeypatch.context() as patch, pytest.raises(Died):
        if at != "write":
            patch.setattr(versions, at, dies)
        versions.publish(spark, base, dies if at == "write" else write(3))
        versions.retire(spark, base, keep=1)  # dies after the old marker is gone
    seen = spark.read.parquet(versions.resolve(spark, base)).count()
    assert seen == (3 if at == "read_text" else 2)
    versions.publish(spark, base, write(5))
    versions.retire(spark, base, keep=1)
    assert spark.read.parquet(versions.resolve(spark, base)).count() == 5
    assert len(paths.siblings(spark, f"{base}/_versions/v")) == 1 and not list((tmp_path / "t").glob("*.parquet"))


def days(spark, path, numbers, **cells):
    rows = (row(f"M{n % 3}", timestamp=f"2024-03-{n:02d} 10:0{k}:00", **cells) for n in numbers for k in range(2))
    tables.write_partitioned(clean(raw(spark, *rows)), path)
    return files.read_processed(spark, path)


def test_refresh_reads_changed_days_and_equals_a_full_one(spark, tmp_path, monkeypatch):
    path, base = str(tmp_path / "t"), str(tmp_path / "x")
    rolled = []
    whole = views.meter_day_rollup
    monkeypatch.setattr(views, "meter_day_rollup", lambda df: rolled.append(scanned_partitions(df.select("meter_id"))) or whole(df))
    steps = [(range(1, 11), {}), ((4,), {"voltage": "1", "state": "S2"}), ((2, 11), {"comm_issue": "true"}), ((), {})]
    for numbers, cells in steps:
        df = days(spark, path, numbers, **cells) if numbers else files.read_processed(spark, path)
        written = views.refresh_views(df, base)
        for name in ("fleet_summary", "daily_consumption", "top_consumers", "geographic_health"):
            assert records(views.extract(spark, base, name)) == records(views.VIEWS[name](df)), name
    assert rolled == [10, 1, 2]
    assert written == views.refresh_views(df, base)  # nothing changed, nothing written
    paths.delete(spark, f"{path}/year=2024/month=03/day=07")
    df = files.read_processed(spark, path)
    views.refresh_views(df, base)
    assert records(views.extract(spark, base, "daily_consumption")) == records(views.daily_consumption(df))


def test_refresh_that_dies_is_repeated(spark, tmp_path, monkeypatch):
    path, base = str(tmp_path / "t"), str(tmp_path / "x")
    views.refresh_views(days(spark, path, range(1, 4)), base)
    before = records(views.extract(spark, base, "fleet_summary"))
    df = days(spark, path, (2,), voltage="5")
    with monkeypatch.context() as patch, pytest.raises(Exception, match="broken"):
        patch.setitem(views.VIEWS, "feeder_risk", lambda df: df.select(F.raise_error(F.lit("broken")).cast("int").alias("x")))
        views.refresh_views(df, base)
    assert records(views.extract(spark, base, "fleet_summary")) == before
    views.refresh_views(df, base)
    assert records(views.extract(spark, base, "fleet_summary")) == records(views.fleet_summary(df)) != before


def test_grants_on_several_levels(spark):
    areas = [(s, d, c) for s in ("S1", "S2", None) for d in ("D1", "D2", None) for c in ("C1", "C2")]
    df = spark.createDataFrame([(*a, i) for i, a in enumerate(areas)] * 2, "state string, district string, discom string, n int")
    cases = {
        "state": [("S1", None, None, None)],
        "mixed": [("S1", "D1", None, False), (None, None, "C2", False), (None, "D2", "C1", True)],
        "all": [(None, None, None, False)],
        "all but": [(None, None, None, False), ("S2", None, None, True), (None, None, "C1", True)],
        "none": [("S1", None, None, False), (None, None, None, True)],
        "twice": [("S1", None, None, False), ("S1", None, None, False), (None, "D1", None, False)],
        "nothing": [],
    }
    rows = [(who, *grant) for who, grants in cases.items() for grant in grants]
    grants = spark.createDataFrame(rows, "principal string, state string, district string, discom string, denied boolean")

    def covers(grant, area):
        return all(g is None or g == a for g, a in zip(grant, area))

    for who, rules in cases.items():
        seen = sorted(r.n for r in filters.restrict_levels(df, grants, who).collect())
        want = [i for i, a in enumerate(areas) if any(covers(g, a) for g in rules if not g[3]) and not any(covers(g, a) for g in rules if g[3])]
        assert seen == sorted(want * 2), who


def test_sketches_err_as_little_as_they_say(spark):
    from meterlake.functions import measures

    df = clean(raw(spark, row("M")))
    many = df.crossJoin(spark.range(60_000)).withColumn("meter_id", F.col("id").cast("string")).withColumn(
        "event_date", F.expr("date_add(event_date, CAST(id % 5 AS int))")
    ).drop("id")
    sketches = measures.sketch_rollup(many).cache()
    assert sketches.count() == 5
    for source in (many, sketches):
        estimate = views.fleet_summary(source, approx=True).first().total_meters
        assert abs(estimate - 60_000) <= 60_000 * 3 * 1.04 / 2 ** (measures.LG_REGISTERS / 2)
    assert views.fleet_summary(sketches, approx=True).first().healthy == 60_000


def test_a_delivery_is_written_by_as_many_tasks_as_its_readings_need(spark, monkeypatch):
    """Deliveries of several files have the log, report and readings of deliveries of one."""
    found = {}
    for parts in (1, 3):
        monkeypatch.setattr(catalogue, "_WRITTEN", {})
        monkeypatch.setattr(catalogue, "raw", lambda spark, sf_dir: demo.raw_readings(spark, sf_dir).repartition(parts, "event_id"))
        path = catalogue.mixed_csv(spark, SF_SMALL)
        assert len(deliveries.delivered_files(spark, path)) == 4 * parts
        names = "s01_several_headers", "k16_delivery_headers", "s11_raw_zone_log", "s11_raw_zone_versions"
        dfs = [catalogue.QUERIES[name](spark, SF_SMALL) for name in names]
        found[parts] = [sorted(map(repr, df.select(*sorted(df.columns)).collect())) for df in dfs]
    assert found[3] == found[1]
