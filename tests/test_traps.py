"""Hand-made frames, one per trap."""

import datetime as dt

from pyspark.sql import functions as F

from equitrace import schemas
from equitrace.functions.grouping import one_per_key
from equitrace.operators import harmonise, importance, prepare, sales, scorecard, scores, stats, validate, weights
from equitrace.sources import io
from equitrace.spec import RefreshSpec

D = [dt.date(2024, 1, 1) + dt.timedelta(days=7 * k) for k in range(40)]
PANEL = schemas.PANEL_LONG


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_zero_old_value_is_flagged_not_divided(frame):
    matched = frame(
        [("A", 0.0, 2.0), ("B", 0.0, 0.0), ("C", 4.0, 5.0), ("D", 0.0, -1.0), ("E", None, 1.0)],
        "label string, value_old double, value_new double",
    )
    got = validate.percent_difference(matched).withColumn("bad", validate.deviates(5.0, "difference_pct"))
    assert rows(got, "label", "difference_pct", "from_zero", "bad") == [
        ("A", None, True, True), ("B", None, False, False), ("C", 25.0, False, True),
        ("D", None, True, True), ("E", None, False, False),
    ]
    text = got.where("bad").withColumn("t", validate.deviation_text("difference_pct"))
    assert rows(text, "label", "t") == [("A", "inf%"), ("C", "25.0%"), ("D", "-inf%")]


def test_refresh_against_itself_has_no_deviation(frame):
    panel = frame([("A", "X", D[k], "m", float(k)) for k in range(5)], PANEL)
    same = validate.percent_difference(validate.match_refreshes(*validate.common_frame(panel, panel)))
    assert same.where(validate.deviates(5.0, "difference_pct")).count() == 0


def test_common_frame_cuts_both_sides(frame):
    old = frame([("A", "X", d, "m", 1.0) for d in D[:6]], PANEL)
    new = frame([("A", "X", d, "m", 1.0) for d in D[2:9]], PANEL)
    a, b = validate.common_frame(old, new)
    assert [r.date for r in a.orderBy("date").collect()] == D[2:6]
    assert [r.date for r in b.orderBy("date").collect()] == D[2:6]


def test_duplicate_dictionary_rows_do_not_fan_out(frame):
    panel = frame([("A", "X", D[0], "m", 1.0)], PANEL)
    dictionary = frame([("X", "m", "Y")] * 2, "category string, var string, select_flag string")
    brands = frame([("A", "X")] * 2, schemas.BRAND_LIST)
    tagged = validate.tag_scope(panel, dictionary, brands)
    assert rows(tagged, "brand", "idv_list", "brand_list") == [("A", "Y", "Y")]


def test_one_per_key_keeps_one_row(frame):
    df = frame([("a", 2), ("a", 1), ("b", 3)], "k string, v int")
    assert rows(one_per_key(df, ["k"]), "k", "v") == [("a", 1), ("b", 3)]


def spec(**kw):
    return RefreshSpec(categories=("X",), high_null_categories=("X",), **kw)


def test_all_null_metric_is_dropped_even_at_ninety_percent(frame):
    panel = frame(
        [("A", "X", D[k], "empty", None) for k in range(10)]
        + [("A", "X", D[k], "one", 1.0 if k == 0 else None) for k in range(10)],
        PANEL,
    )
    stats_ = prepare.level_stats(prepare.levels(panel))
    kept = prepare.dense_enough(stats_, spec())
    assert {r["var"] for r in kept.collect()} == {"one"}
    assert {r["var"] for r in prepare.dense_enough(stats_, RefreshSpec()).collect()} == set()


def test_scalers_on_a_constant_metric(frame):
    panel = frame(
        [("A", "X", D[k], "flat", 3.0) for k in range(4)] + [("A", "X", D[k], "up", float(k)) for k in range(4)],
        PANEL,
    )
    filled = prepare.impute(prepare.drop_sparse(prepare.levels(panel), RefreshSpec()))
    flat = F.col("var") == "flat"
    for scaler in (prepare.scale_minmax, prepare.scale_zscore):
        assert {r["value"] for r in scaler(filled).where(flat).collect()} == {0.0}
    low_high = [r["value"] for r in prepare.scale_minmax(filled).where(~flat & (F.col("scope") == "brand")).orderBy("date").collect()]
    assert low_high[0] == 0.0 and low_high[-1] == 1.0


def test_zscore_after_imputation_is_standard(frame):
    values = [1.0, None, 3.0, 8.0, None, 2.0]
    panel = frame([("A", "X", D[k], "m", v) for k, v in enumerate(values)], PANEL)
    z = prepare.scale_zscore(prepare.impute(prepare.drop_sparse(prepare.levels(panel), RefreshSpec())))
    mean, sd = z.where("scope = 'brand'").agg(F.avg("value"), F.stddev_pop("value")).first()
    assert abs(mean) < 1e-12 and abs(sd - 1.0) < 1e-12


def test_cap_is_idempotent(frame):
    df = frame([("m", v, 0.0, 1.0) for v in (-1.0, 0.5, 2.0, None)], "var string, value double, min double, max double")
    once = prepare.cap(df)
    assert rows(once, F.coalesce("value", F.lit(-9.0))) == rows(prepare.cap(once), F.coalesce("value", F.lit(-9.0)))


def test_rollup_adds_a_pseudo_brand_and_keeps_the_quirk(frame):
    cols = "vendor string, brand string, category string, date date, s_dollars double, acv_num double, acv_den double, acv_selling_wt double"
    weekly = frame(
        [("V", "V", "X", D[0], 5.0, 1.0, 5.0, 0.2), ("V", "sub", "X", D[0], 7.0, 1.0, 7.0, 0.1),
         ("W", "other", "X", D[0], 1.0, 1.0, 1.0, 1.0)],
        cols,
    )
    got = rows(sales.vendor_rollup(weekly, "V"), "vendor", "brand", "s_dollars", F.col("acv_selling_wt").isNull())
    assert got == [("V", "V", 12.0, True), ("V", "sub", 7.0, False), ("W", "other", 1.0, False)]


def test_inverse_rules(frame):
    panel = frame(
        [("A", "X", D[0], "a", 0.4), ("A", "X", D[0], "b", None), ("A", "X", D[1], "a", None), ("A", "X", D[1], "b", None)],
        PANEL,
    )
    rules = frame([("sub", "a", "1", "not_a"), ("add", None, "a+b", "ab")], schemas.INVERSE_RULES)
    got = harmonise.inverse_metrics(panel, rules).where("var in ('not_a', 'ab')")
    assert rows(got, "date", "var", F.coalesce("value", F.lit(-1.0))) == [
        (D[0], "ab", 0.4), (D[0], "not_a", 0.6), (D[1], "ab", 0.0), (D[1], "not_a", -1.0),
    ]


def test_shares_with_an_empty_group(frame):
    panel = frame([("A", "X", D[0], "search_searchvolume", 0.0), ("B", "X", D[0], "search_searchvolume", 0.0)], PANEL)
    got = harmonise.share_metrics(panel).where("var like '%_share'")
    assert [r["value"] for r in got.collect()] == [None, None]


def test_unpivot_keeps_nulls(frame):
    wide = frame([("A", "X", D[0], 1.0, None)], "brand string, category string, date date, m double, n double")
    assert harmonise.unpivot_metrics(wide).count() == 2
    assert harmonise.unpivot_metrics(wide, exclude=["n"]).count() == 1


def test_trend_needs_a_full_window(frame):
    values = [1.0, 1.0, None, 1.0, 1.0, 1.0, 1.0]
    points = frame([("A", "X", D[k], "p", v) for k, v in enumerate(values)], "brand string, category string, date date, pillar string, score double")
    got = scores.trends(points, 3).orderBy("date").collect()
    assert [r["trend_past"] for r in got] == [None, None, None, None, None, 1.0, 1.0]
    assert [r["trend_past_future"] for r in got] == [None, None, None, None, 1.0, 1.0, None]
    short = scores.trends(points.limit(1), 13).collect()
    assert short[0]["trend_past"] is None


def test_pillar_without_metrics_scores_zero(frame):
    pooled = frame([("A", "X", D[0], "m", 0.5), ("A", "X", D[0], "n", None)], PANEL)
    sheet = frame(
        [("X", "p_pillar", "M", 0.6), ("X", "p_pillar", "n", 0.4), ("X", "q_pillar", "gone", 1.0)], schemas.WEIGHTS_SHEET
    )
    assert rows(scores.pillar_scores(pooled, sheet), "pillar", "score") == [("p_pillar", 0.3), ("q_pillar", 0.0)]


def test_metric_known_to_one_source_only(frame):
    merged = frame(
        [("p_pillar", "a", 1.0, 0.5), ("p_pillar", "b", 3.0, None), ("p_pillar", "c", None, -0.5)],
        "pillar string, var string, attribution double, est_std double",
    )
    got = dict(rows(weights.metric_weights(merged, ["pillar"]), "var", "weight"))
    assert got == {"a": (0.25 + 0.5) / 2, "b": 0.75, "c": 0.5}


def test_correlation_of_a_constant_is_null(frame):
    df = frame([("A", "X", "m", 1.0, float(k)) for k in range(5)], "brand string, category string, var string, value double, dv double")
    assert stats.dv_correlation(df).first()["corr"] is None


def test_counter_intuitive_filter_works_both_ways(frame):
    found = frame(
        [("A", "X", "up", -0.5), ("A", "X", "down", 0.5), ("A", "X", "fine", -0.2)],
        "brand string, category string, var string, corr double",
    )
    signs = frame([("X", "up", "P"), ("X", "down", "N"), ("X", "fine", "P")], "category string, var string, expected_sign string")
    assert rows(stats.drop_counter_intuitive(found, signs), "var") == [("fine",)]


def test_folds_partition_the_training_rows(frame):
    df = frame([("A", "X", "m", D[k], 1.0) for k in range(29)], "brand string, category string, var string, date date, dv double")
    keys = ["brand", "category", "var"]
    split = stats.folds(stats.split_at_random(df, keys), keys, 4)
    sizes = {r["fold"]: r["n"] for r in split.groupBy("fold").agg(F.count("*").alias("n")).collect()}
    assert sizes == {None: 6, 1: 6, 2: 6, 3: 6, 4: 5}


def test_half_missing_feature_stays_in_importance(frame):
    cols = "brand string, category string, date date, var string, value double"
    def half(name, missing):
        return [("A", "X", D[k], name, None if k < missing else float(k)) for k in range(10)]

    got = importance.importance_rows(frame(half("kept", 5) + half("gone", 6), cols))
    assert {r["var"] for r in got.collect()} == {"kept"}
    assert got.count() == 7 and got.where("value is null").count() == 0


def test_price_class_null_and_unmapped_differ(frame):
    mapping = frame([("A", "X", None), ("B", "X", "Premium")], schemas.PRICE_CLASS)
    assert rows(scorecard.price_classes(mapping), "brand", "price_class") == [("A", "#NA"), ("B", "Premium")]


def test_unweighted_metrics_are_not_published(frame):
    df = frame([("Metric", None), ("Metric", 0.5), ("Pillar", None)], "metric_type string, weight double")
    assert rows(scorecard.drop_unweighted(df), "metric_type") == [("Metric",), ("Pillar",)]


def test_load_and_clean(frame):
    df = frame([("2024", "3", "2024-03-09T00:00:00", 1)], "Year_RT string, Month_RT string, seen string, junk int")
    got = io.iso_date(io.load_and_clean(df, drop_cols=["junk", "absent"], year_col="Year_RT", month_col="Month_RT"), "seen")
    assert got.first().asDict() == {
        "Year_RT": "2024", "Month_RT": "3", "seen": dt.date(2024, 3, 9), "date": dt.date(2024, 3, 1),
    }
