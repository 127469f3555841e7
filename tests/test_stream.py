from pathlib import Path

import pytest
from making import raw, records

from meterlake.operators.clean import clean
from meterlake.sources.files import read_processed
from meterlake.streaming import ingest
from meterlake.streaming.ingest import arriving_csv, merge_batch


def deliver(df, folder: Path, name: str):
    """Drop one CSV file into the landing folder."""
    df.coalesce(1).write.option("header", True).csv(str(folder.parent / f"made-{name}"))
    (part,) = (folder.parent / f"made-{name}").glob("part-*.csv")
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.csv").write_bytes(part.read_bytes())


def rows(*numbers, **cells):
    return [{"meter_id": f"M{n}", "timestamp": f"2024-03-{1 + n % 5:02d} 10:00:00", **cells} for n in numbers]


@pytest.fixture
def landing(tmp_path):
    return tmp_path / "landing"


def run(spark, landing, tmp_path, **options):
    query = ingest.ingest(
        arriving_csv(spark, str(landing), **options), str(tmp_path / "table"), str(tmp_path / "checkpoint")
    )
    query.awaitTermination()
    return read_processed(spark, str(tmp_path / "table"))


def test_stream_equals_batch_and_restart_adds_nothing(spark, landing, tmp_path):
    deliveries = [
        rows(1, 2, 3, 4) + rows(1, voltage="9"),
        rows(2, 3, voltage="7", meter_id=None) + rows(5, timestamp="garbage"),
        rows(1, voltage="8") + rows(6, 7),
    ]
    deliver(raw(spark, *deliveries[0]), landing, "a")
    deliver(raw(spark, *deliveries[1]), landing, "b")
    run(spark, landing, tmp_path, max_files=1)
    deliver(raw(spark, *deliveries[2]), landing, "c")
    table = run(spark, landing, tmp_path, max_files=1)
    expected = records(clean(raw(spark, *(row for part in deliveries for row in part))))
    assert records(table) == expected
    assert records(run(spark, landing, tmp_path)) == expected


def test_replayed_batch_changes_nothing(spark, tmp_path):
    target, staging = str(tmp_path / "table"), str(tmp_path / "staging")
    merge_batch(raw(spark, *rows(1, 2, 3)), 0, target, staging)
    merge_batch(raw(spark, *rows(3, 4)), 1, target, staging)
    before = records(read_processed(spark, target))
    merge_batch(raw(spark, *rows(3, 4)), 1, target, staging)
    assert records(read_processed(spark, target)) == before and len(before) == 4


def test_replay_after_a_lost_partition_restores_it(spark, tmp_path):
    """The job died after a day was removed and before its new files were in place."""
    import shutil

    target, staging = str(tmp_path / "table"), str(tmp_path / "staging")
    merge_batch(raw(spark, *rows(1, 2)), 0, target, staging)
    merge_batch(raw(spark, *rows(1, 2, voltage="1")), 1, target, staging)
    before = records(read_processed(spark, target))
    shutil.rmtree(Path(target) / "year=2024" / "month=03" / "day=02")
    merge_batch(raw(spark, *rows(1, 2, voltage="1")), 1, target, staging)
    assert records(read_processed(spark, target)) == before


def test_many_touched_days(spark, tmp_path):
    target, staging = str(tmp_path / "table"), str(tmp_path / "staging")
    merge_batch(raw(spark, *rows(1, 2, 3, 4)), 0, target, staging)
    merge_batch(raw(spark, *rows(6, 7)), 1, target, staging)
    assert records(read_processed(spark, target)) == records(clean(raw(spark, *rows(1, 2, 3, 4, 6, 7))))


def test_empty_batch(spark, tmp_path):
    target, staging = str(tmp_path / "table"), str(tmp_path / "staging")
    merge_batch(raw(spark, *rows(1)), 0, target, staging)
    merge_batch(raw(spark, *rows(1)).filter("false"), 1, target, staging)
    assert read_processed(spark, target).count() == 1
