"""Every registered query on the smallest data folder: result, plan, and the same in SQL."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF_DIR
from tools.check_queries import rows_of

# fits in Python workers or pyspark.ml; nothing else may leave the JVM
PYTHON_QUERIES = {
    "m1_pooled_factors", "m1_three_metric_factor", "m2_category_factors", "m4_positive_ridge", "m4_ridge_coefficients",
    "m7_linear_attribution", "m8_selection_table", "m9_result_rows", "e4_learn",
}
MAY_BE_EMPTY = {"t17_select_by_correlation", "v15_added_brands", "v9_deviations"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
PYTHON_QUERIES = {*PYTHON_QUERIES, "t19_explained_variance", "t19_key_components"}


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON_QUERIES:
        assert "EvalPython" not in plan and "InPandas" not in plan
    columns, got = rows_of(df.columns, [tuple(x) for x in df.collect()])
    assert got or name in MAY_BE_EMPTY
    if name in oracle_sql():
        rel = duck.execute(oracle_sql()[name])
        want_columns, want = rows_of([d[0] for d in rel.description], rel.fetchall())
        assert columns == want_columns
        assert got == want


def test_entry_without_the_corpus_operators():
    """The other queries stay when the corpus operators and their pipeline are not there."""
    code = (
        "import sys; sys.modules['corpus_pipeline'] = sys.modules['equitrace.llm'] = None; "
        "import __spark_entry__ as e; assert 'c11_scorecard_summary' in e.queries() and 'pipeline' not in e.queries()"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).parent.parent)


def test_workers_find_the_library_from_another_folder(tmp_path):
    """Fits run in Python workers that import the library, wherever the session was started."""
    root = Path(__file__).parent.parent
    code = (
        f"import sys; sys.path.insert(0, {str(root)!r}); from equitrace.session import local_session; "
        f"import __spark_entry__ as e; s = local_session('far', 2); "
        f"assert e.queries()['m4_ridge_coefficients'](s, {SF_DIR!r}).count() > 0"
    )
    env = {**os.environ, "PYTHONPATH": ""}
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, env=env, timeout=600)


def test_keys_match():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "scaled_scores" in df.columns
