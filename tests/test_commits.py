"""Refreshes that appear whole: killed runs, vanished categories, re-runs, carried tables."""

import datetime as dt

import pytest

from equitrace.sources import commits

MONTH, BEFORE = dt.date(2024, 12, 1), dt.date(2024, 11, 1)
SCHEMA = "brand string, category string, value double"
OLD = [("a", "01", 1.0), ("b", "X", 2.0), ("c", None, None)]
NEW = [("a", "01", 5.0)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def panel(spark, root, refresh=MONTH):
    return commits.read_table(spark, root, "data_prep", "panel", refresh)


@pytest.fixture
def root(spark, frame, tmp_path):
    """One committed refresh with a panel and a sheet."""
    first = commits.Attempt(spark, str(tmp_path), MONTH)
    first.write(frame(OLD, SCHEMA), "data_prep", "panel")
    first.write(frame([("m", 0.5)], "metric string, weight double"), "pillar_creation", "weights_sheet", ())
    first.commit()
    return str(tmp_path)


def test_round_trip_keeps_order_and_types(spark, root):
    """A category named 01 stays text; nulls stay nulls; columns stay in their order."""
    got = panel(spark, root)
    assert got.dtypes == [("brand", "string"), ("category", "string"), ("value", "double")]
    assert rows(got) == rows(spark.createDataFrame(OLD, SCHEMA))


def test_killed_run_changes_nothing(spark, root, frame):
    killed = commits.Attempt(spark, root, MONTH)
    written = killed.write(frame(NEW, SCHEMA), "data_prep", "panel")
    assert rows(written) == NEW
    assert rows(panel(spark, root)) == rows(frame(OLD, SCHEMA))
    killed.discard()
    assert rows(panel(spark, root)) == rows(frame(OLD, SCHEMA))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{root}/data_prep/panel/refresh_date=2024-12-01/attempt={killed.name}")


def test_vanished_category_is_gone_after_a_rerun(spark, root, frame):
    rerun = commits.Attempt(spark, root, MONTH)
    rerun.write(frame(NEW, SCHEMA), "data_prep", "panel")
    rerun.commit()
    assert rows(panel(spark, root)) == NEW
    # what the run did not write is no part of it
    with pytest.raises(LookupError, match="weights_sheet"):
        commits.read_table(spark, root, "pillar_creation", "weights_sheet", MONTH)
    with pytest.raises(ValueError, match="committed"):
        rerun.discard()
    assert rows(panel(spark, root)) == NEW


def test_tables_carried_over(spark, root, frame):
    rerun = commits.Attempt(spark, root, MONTH)
    rerun.write(frame(NEW, SCHEMA), "data_prep", "panel")
    rerun.commit(carry_over=True)
    assert rows(panel(spark, root)) == NEW
    assert rows(commits.read_table(spark, root, "pillar_creation", "weights_sheet", MONTH)) == [("m", 0.5)]
    assert commits.current(spark, root, MONTH)["seq"] == 2


def test_refreshes_stand_side_by_side(spark, root, frame):
    other = commits.Attempt(spark, root, BEFORE)
    other.write(frame(NEW, SCHEMA), "data_prep", "panel")
    with pytest.raises(LookupError, match="2024-11-01"):
        panel(spark, root, BEFORE)
    other.commit()
    assert rows(panel(spark, root, BEFORE)) == NEW
    assert rows(panel(spark, root)) == rows(frame(OLD, SCHEMA))


def test_a_table_of_no_rows(spark, root, frame):
    rerun = commits.Attempt(spark, root, MONTH)
    rerun.write(frame([], SCHEMA), "data_prep", "panel")
    rerun.commit()
    assert panel(spark, root).columns == ["brand", "category", "value"] and rows(panel(spark, root)) == []


def test_only_the_committed_folder_is_read(spark, root):
    name = commits.current(spark, root, MONTH)["attempt"]
    assert all(f"attempt={name}" in f for f in panel(spark, root).inputFiles())


def test_wrong_uses(spark, root, frame):
    attempt = commits.Attempt(spark, root, MONTH)
    with pytest.raises(ValueError, match="unknown stage"):
        attempt.write(frame(NEW, SCHEMA), "nowhere", "panel")
    attempt.write(frame(NEW, SCHEMA), "data_prep", "panel")
    with pytest.raises(ValueError, match="already written"):
        attempt.write(frame(NEW, SCHEMA), "data_prep", "panel")
