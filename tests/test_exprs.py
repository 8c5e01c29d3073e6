import datetime as dt

from pyspark.sql import functions as F

from equitrace.functions import exprs


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_ratio_never_fails(spark):
    for a, b in ((1.0, 0.0), (0.0, 0.0), (None, 1.0), (1.0, None)):
        assert one(spark, exprs.ratio(F.lit(a).cast("double"), F.lit(b).cast("double"))) is None
    assert one(spark, exprs.ratio(F.lit(1.0), F.lit(4.0))) == 0.25


def test_half_even(spark):
    got = [one(spark, exprs.half_even(F.lit(v), n)) for v, n in ((2.5, 0), (3.5, 0), (2.675, 2), (-2.5, 0))]
    assert got == [2.0, 4.0, 2.68, -2.0]


def test_num_turns_text_and_nan_into_null(spark):
    assert one(spark, exprs.num(F.lit("12.5"))) == 12.5
    assert one(spark, exprs.num(F.lit("n/a"))) is None
    assert one(spark, exprs.num(F.lit(float("nan")))) is None


def test_clip_keeps_null_and_missing_bounds(spark):
    d = lambda v: F.lit(v).cast("double")
    assert one(spark, exprs.clip(d(None), d(0.0), d(1.0))) is None
    assert one(spark, exprs.clip(d(5.0), d(0.0), d(1.0))) == 1.0
    assert one(spark, exprs.clip(d(-5.0), d(0.0), d(None))) == 0.0
    assert one(spark, exprs.clip(d(5.0), d(None), d(None))) == 5.0


def test_mean_of_present(spark):
    d = lambda v: F.lit(v).cast("double")
    assert one(spark, exprs.mean_of_present(d(0.2), d(0.4))) == (0.2 + 0.4) / 2
    assert one(spark, exprs.mean_of_present(d(None), d(0.4))) == 0.4
    assert one(spark, exprs.mean_of_present(d(None), d(None))) is None


def test_names(spark):
    assert one(spark, exprs.clean_name(F.lit("Web Panel - Net Value"))) == "web_panel_net_value"
    assert one(spark, exprs.title_case(F.lit("brand perceptions 1st-choice"))) == "Brand Perceptions 1St-Choice"
    assert one(spark, exprs.with_suffix(F.lit("loyalty"))) == "loyalty_pillar"
    assert one(spark, exprs.with_suffix(F.lit("loyalty_pillar"))) == "loyalty_pillar"
    assert one(spark, exprs.without_suffix(F.lit("loyalty_pillar"))) == "loyalty"


def test_percent_text(spark):
    assert one(spark, exprs.percent_text(F.lit(12.25))) == "12.2%"
    assert one(spark, exprs.percent_text(F.lit(-7.0))) == "-7.0%"


def test_periods(spark):
    for day, saturday in ((1, 6), (6, 6), (7, 13)):
        d = F.lit(dt.date(2024, 1, day))
        assert one(spark, exprs.week_ending(d)) == dt.date(2024, 1, saturday)
    assert one(spark, exprs.month_start(F.lit(dt.date(2024, 2, 29)))) == dt.date(2024, 2, 1)
