"""Compaction: bins by size, what is due, passes that are lost, and which files are opened."""

from datetime import date, datetime

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorloom.operators import compaction
from sensorloom.operators.archive import write_archive
from sensorloom.operators.compaction import CompactedArchive, binned, due_bins, pack_sizes
from sensorloom.operators.routing import decode_readings
from sensorloom.streaming.consumers import start_archive

ROWS = "location string, date date, n int, event_time timestamp"


def rows_of(spark, *cells):
    """n-th row of (location, day) cells."""
    rows = [(loc, date(2024, 1, day), n, datetime(2024, 1, day, 5)) for n, (loc, day) in enumerate(cells)]
    return spark.createDataFrame(rows, ROWS)


@given(st.lists(st.integers(1, 150), max_size=40))
def test_bins(sizes):
    bins = pack_sizes(sizes, 100)
    held = {b: [s for s, own in zip(sizes, bins) if own == b] for b in set(bins)}
    assert all(sum(own) <= 100 or len(own) == 1 for own in held.values())
    # First fit: no two bins could be one that is at most half full each.
    assert sum(1 for own in held.values() if sum(own) <= 50) <= 1
    assert set(bins) == set(range(len(held)))


def test_what_is_due(spark):
    day = datetime(2024, 1, 1)
    files = [("a1", "f", 60, day), ("a2", "f", 30, day), ("b1", "g", 5, day), ("b2", "g", 5, day.replace(day=2)),
             ("c", "h", 20, day), ("full", "f", 90, day)]
    frame = spark.createDataFrame(files, "path string, folder string, bytes long, modified timestamp")
    bins = binned(frame, 100)
    now = F.lit(datetime(2024, 1, 1, 0, 0, 30))
    got = {r.path for r in due_bins(bins, 75, now, "1 minute").collect()}
    assert got == {"a1", "a2"}  # enough bytes; the full file is left alone
    later = F.lit(datetime(2024, 1, 1, 0, 1))
    got = {r.path for r in due_bins(bins, 75, later, "1 minute").collect()}
    assert got == {"a1", "a2", "b1", "b2"}  # old enough; one file alone is never due


CELLS = [("San Diego", 1), ("a/b: 50%+{x}", 1), ("Dallas", 2), (None, 2)]


def test_passes(spark, tmp_path):
    """Folders with several files become one file each; others, and lost passes, change nothing."""
    archive = CompactedArchive(str(tmp_path))
    for part in (CELLS, CELLS[:3], CELLS[:2]):
        write_archive(rows_of(spark, *part), archive.fresh)
    before = sorted(archive.read(spark).collect(), key=str)
    assert len(before) == 9 and archive.files(spark).count() == 9
    assert {r.location for r in before} == {loc for loc, _ in CELLS}
    # A pass that was lost before it was published.
    spark.range(5).write.parquet(f"{archive.path}/_staged/pass=0/rows")
    assert archive.compact(spark) == 3
    assert sorted(archive.read(spark).collect(), key=str) == before
    assert archive.files(spark).count() == 4
    assert archive.replaced(spark).count() == 8
    assert archive.compact(spark) == 0
    write_archive(rows_of(spark, ("Dallas", 2)), archive.fresh)
    assert archive.compact(spark) == 1 and archive.last_pass(spark) == 1
    assert archive.files(spark).count() == 4 and archive.read(spark).count() == 10


def test_files_of_target_size(spark, tmp_path):
    """A target that takes two of the files: eight files become four."""
    archive = CompactedArchive(str(tmp_path))
    for _ in range(8):
        write_archive(rows_of(spark, *[("A", 1)] * 50), archive.fresh)
    size = archive.files(spark).first().bytes
    assert archive.compact(spark, target_bytes=round(2.4 * size)) == 4
    assert archive.read(spark).count() == 400
    assert archive.files(spark).count() == 4


def test_a_pass_has_a_limit_and_the_next_takes_the_rest(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(compaction, "BINS_PER_PASS", 2)
    archive = CompactedArchive(str(tmp_path))
    cells = [(name, 1) for name in "ABCDE"]
    for _ in range(2):
        write_archive(rows_of(spark, *cells), archive.fresh)
    assert [archive.compact(spark) for _ in range(4)] == [2, 2, 1, 0]
    assert archive.read(spark).count() == 10 and archive.files(spark).count() == 5


def test_other_folders_are_not_opened(spark, tmp_path):
    archive = CompactedArchive(str(tmp_path))
    for _ in range(2):
        write_archive(rows_of(spark, ("A", 1), ("A", 2), ("B", 1)), archive.fresh)
    write_archive(rows_of(spark, ("C", 3)), archive.fresh)
    archive.compact(spark)
    opened = archive.read(spark, since="2024-01-01", until="2024-01-01", locations=["A"])
    assert len(opened.inputFiles()) == 1 and "location=A/date=2024-01-01" in opened.inputFiles()[0]
    assert opened.count() == 2
    # The folder with one file was not rewritten.
    assert not any("location=C" in r.path for r in archive.replaced(spark).collect())
    assert sum("/fresh/location=C" in r.path for r in archive.files(spark).collect()) == 1
    assert archive.read(spark, since="2025-01-01").collect() == []


def test_files_of_a_stream(spark, tmp_path):
    """The archive stream writes to ``fresh``; only what its log has committed is compacted."""
    root = str(tmp_path)
    message = (
        '{"Location":"A","Date_Time":"2024-01-01 00:00:0%d","Temperature_C":1.0,"Humidity_pct":1.0,'
        '"Precipitation_mm":0.0,"Wind_Speed_kmh":0.0,"retry":0}'
    )
    archive = CompactedArchive(f"{root}/archive")
    for n in range(3):
        made = spark.createDataFrame([(message % n,)], "value string")
        made.write.mode("append").parquet(f"{root}/in")
        readings = decode_readings(spark.readStream.schema("value string").parquet(f"{root}/in"))
        start_archive(readings, archive.fresh, f"{root}/cp", trigger={"availableNow": True}).awaitTermination()
    assert archive.files(spark).count() == 3
    assert archive.compact(spark) == 1
    rows = archive.read(spark).collect()
    assert len(rows) == 3 and archive.files(spark).count() == 1
    assert {(r.location, r.date) for r in rows} == {("A", date(2024, 1, 1))}


@pytest.mark.parametrize("least,older,made", [(1, "10 days", 1), (1 << 30, "10 days", 0), (1 << 30, "0 seconds", 1)])
def test_flush_by_size_or_age(spark, tmp_path, least, older, made):
    archive = CompactedArchive(str(tmp_path))
    for _ in range(2):
        write_archive(rows_of(spark, ("A", 1)), archive.fresh)
    assert archive.compact(spark, least_bytes=least, older_than=older) == made
