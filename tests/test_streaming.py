import pytest
from pyspark.sql import functions as F

from tallywell.streaming import arrivals

SCHEMA = "id bigint, submitted_at timestamp, label string"


def land(spark, folder, rows):
    """One more file in the folder, which is one more micro-batch."""
    df = spark.createDataFrame(rows, "id bigint, t string, label string")
    df.select("id", F.col("t").cast("timestamp").alias("submitted_at"), "label").coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, build):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    return arrivals.run_available(build(stream), str(tmp_path / "out"), str(tmp_path / "checkpoint"))


FIRST = [(1, "2024-01-10 00:00:00", "a"), (2, "2024-01-10 01:00:00", "b"), (1, "2024-01-10 00:30:00", "a")]
SECOND = [(2, "2024-01-10 01:10:00", "b"), (3, "2024-01-20 00:00:00", "a")]
THIRD = [(4, "2024-01-01 00:00:00", "late"), (5, "2024-01-20 01:00:00", "a"), (3, "2024-01-20 02:00:00", "a")]


def test_duplicates_and_late_rows_are_dropped(spark, tmp_path):
    seen = set()
    for rows in (FIRST, SECOND, THIRD):
        land(spark, str(tmp_path / "in"), rows)
        out = run(spark, tmp_path, lambda s: arrivals.dedupe(s, "1 day"))
        ids = sorted(r.id for r in out.collect())
        assert len(ids) == len(set(ids)) and seen <= set(ids)
        seen = set(ids)
    assert seen == {1, 2, 3, 5}


@pytest.mark.parametrize("salts", [0, 8])
def test_an_id_sent_very_often_comes_out_once(spark, tmp_path, salts):
    land(spark, str(tmp_path / "in"), [(1, "2024-01-10 00:00:00", "a")] * 500 + FIRST[1:2])
    out = run(spark, tmp_path, lambda s: arrivals.dedupe(s, "1 day", salts=salts))
    assert sorted(r.id for r in out.collect()) == [1, 2]


def test_tally_gives_closed_windows_only(spark, tmp_path):
    for rows in (FIRST, SECOND, THIRD):
        land(spark, str(tmp_path / "in"), rows)
    out = run(spark, tmp_path, lambda s: arrivals.tally(arrivals.dedupe(s, "1 day"), "label"))
    got = sorted((str(r.window_start), r.label, r.n) for r in out.collect())
    # Windows start on Thursdays. The one from 18 January is still open at the last watermark.
    assert got == [("2024-01-04 00:00:00", "a", 1), ("2024-01-04 00:00:00", "b", 1)]


def test_tally_with_its_own_watermark(spark, tmp_path):
    land(spark, str(tmp_path / "in"), FIRST)
    land(spark, str(tmp_path / "in"), SECOND)
    out = run(spark, tmp_path, lambda s: arrivals.tally(s, "label", "1 day", delay="1 hour"))
    assert sorted((str(r.window_start), r.label, r.n) for r in out.collect()) == [
        ("2024-01-10 00:00:00", "a", 2), ("2024-01-10 00:00:00", "b", 2)]
