"""Compaction of prediction files: same rows as the scan, bounded number of files, months replaced whole."""
import datetime as dt
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ridegrid.sources import compact as CP
from ridegrid.sources import lake as L

KEYS = ["pickup_location_id", "year", "month", "day", "hour"]


def land(base, loc, when, rides, name="prediction.csv"):
    folder = Path(base) / f"pickup_location_id={loc}" / f"year={when.year}/month={when.month}/day={when.day}/hour={when.hour}"
    folder.mkdir(parents=True, exist_ok=True)
    lines = "".join(f"{when:%Y-%m-%d %H:%M:%S},{r}\n" for r in rides)
    (folder / name).write_text("prediction_datetime,predicted_rides\n" + lines)


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("predictions"))
    for loc in (4, 43, 132):
        for i in range(0, 60):
            land(path, loc, dt.datetime(2023, 12, 30) + dt.timedelta(hours=i), [i % 5])
    land(path, 43, dt.datetime(2024, 1, 1, 12), list(range(3000)))  # one file beyond the target
    land(path, 4, dt.datetime(2024, 1, 1, 13), [])  # header only
    land(path, "n_a", dt.datetime(2024, 1, 1, 1), [77])
    land(path, 4, dt.datetime(2024, 1, 1, 2), [99], "other.csv")
    return path


def rows(df):
    return sorted(tuple(r) for r in df.select("predicted_rides", *KEYS, "prediction_datetime").collect())


def parquet(out):
    return [p for p in Path(out).rglob("*.parquet")]


def test_equals_the_scan(spark, base, tmp_path):
    out = CP.compact_predictions(spark, base, str(tmp_path / "one"))
    got, scan = CP.read_compacted(spark, out), L.read_predictions(spark, base)
    assert got.columns == scan.columns and [f.dataType for f in got.schema] == [f.dataType for f in scan.schema]
    assert rows(got) == rows(scan) and got.count() > 3000
    assert len(parquet(out)) == 2  # a file a month, of 182 files


def test_files_are_bounded_and_large_files_divided(spark, base, tmp_path):
    size = sum(os.path.getsize(p) for p in Path(base).rglob("prediction.csv") if "n_a" not in str(p))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")  # so that the large file is read in splits
    try:
        target = 16 << 10
        out = CP.compact_predictions(spark, base, str(tmp_path / "many"), target_bytes=target)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert rows(CP.read_compacted(spark, out)) == rows(L.read_predictions(spark, base))
    january = len([p for p in parquet(out) if "year=2024" in str(p)])
    assert 4 <= january and len(parquet(out)) <= size // target + 2
    # bins follow location and time: the ranges of a month's files meet at most at their ends
    spans = (spark.read.parquet(out).where("year = 2024").groupBy(F.col("_metadata.file_path"))
             .agg(F.min(F.struct("pickup_location_id", "day", "hour")).alias("a"),
                  F.max(F.struct("pickup_location_id", "day", "hour")).alias("z")).orderBy("a", "z").collect())
    assert all(tuple(x["z"]) <= tuple(y["a"]) for x, y in zip(spans, spans[1:], strict=False))


def test_years_and_replacement(spark, base, tmp_path):
    out = str(tmp_path / "years")
    CP.compact_predictions(spark, base, out)
    again = str(tmp_path / "later")
    land(again, 4, dt.datetime(2024, 1, 9, 5), [1, 2])
    CP.compact_predictions(spark, again, out)
    got = CP.read_compacted(spark, out)
    assert got.where("year = 2024").count() == 2 and got.where("year = 2023").count() == 144
    only = CP.compact_predictions(spark, base, str(tmp_path / "only"), years=[2023])
    assert rows(CP.read_compacted(spark, only)) == rows(L.read_predictions(spark, base, [2023]))
    assert rows(CP.read_compacted(spark, out, [2023])) == rows(L.read_predictions(spark, base, [2023]))


def test_places_lay_files_end_to_end(spark, base):
    at = CP.file_places(CP.staged_rows(spark, base)).collect()
    seen = {}
    for r in sorted(at, key=lambda r: (r["year"], r["month"], r["pickup_location_id"], r["day"], r["hour"])):
        month = (r["year"], r["month"])
        assert r["_start"] == seen.get(month, 0)
        seen[month] = seen.get(month, 0) + r["_bytes"]
    assert len(seen) == 2


def test_without_files_nothing_is_written(spark, base, tmp_path):
    out = str(tmp_path / "none")
    CP.compact_predictions(spark, base, out, file_glob="absent.csv")
    assert not os.path.exists(out)
