"""Every query with SQL against DuckDB over the same files; the others must give rows."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from catalog import CATALOG, comparing
from tabquorum.plans.comparison import fit_groups

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
# Whole grids of up to 450 fits: below they run with one point and two folds.
GRIDS = {"leaderboard", "cv_bagging", "cv_boosting", "cv_gbm", "cv_stacking"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return str(value)
    return f"{value:.10g}"


@pytest.mark.parametrize("name", sorted(n for n, q in CATALOG.items() if q.sql is not None))
def test_query_matches_sql(spark, duck, sf_dir, name):
    frame = entry_points.queries()[name](spark, sf_dir)
    result = duck.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    order = [columns.index(c) for c in frame.columns]
    expected = sorted([cell(row[i]) for i in order] for row in result.fetchall())
    assert sorted([cell(v) for v in row] for row in frame.collect()) == expected
    assert expected


@pytest.mark.parametrize("name", sorted(n for n, q in CATALOG.items() if q.sql is None and n not in GRIDS))
def test_query_gives_rows(spark, sf_dir, name):
    assert entry_points.queries()[name](spark, sf_dir).count() > 0


def test_every_learner_of_the_comparison_is_fitted(spark, sf_dir):
    entrants = {name: (estimator, grid[:1]) for name, (estimator, grid) in comparing.seven_learners().items()}
    assert sum(len(grid) for _, grid in comparing.seven_learners().values()) == 40
    comparison, board = comparing.compared(spark, sf_dir, entrants, 2, "accuracy")
    rows = board.collect()
    assert {r.Model for r in rows} == set(entrants) and all(0.5 < r.Score <= 1 for r in rows)
    assert [r.Score for r in rows] == sorted((r.Score for r in rows), reverse=True)
    assert comparison.fits == 3 * 7 and comparison.points(spark).where("is_best").count() == 7


@pytest.mark.parametrize("kind,points,fits", [("bagging", 18, 90), ("boosting", 3, 15), ("gbm", 4, 10), ("stacking", 1, 5)])
def test_ensemble_grids(spark, sf_dir, kind, points, fits):
    estimator, grid, metric = comparing.ensemble_grids()[kind]
    assert len(grid) == points and 5 * len(fit_groups(estimator, grid)) == fits
    comparison, _ = comparing.compared(spark, sf_dir, {kind: (estimator, grid[-1:])}, 2, metric)
    row = comparison.points(spark).first()
    assert row.is_best and 0.5 < row.metric <= 1 and row.folds == 2


def test_entry(spark):
    row = entry_points.entry(spark).first()
    assert row.n > 0 and row.accuracy > 0.6


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_every_query_is_registered():
    assert set(CATALOG) <= set(entry_points.queries())
    assert {n for n, q in CATALOG.items() if q.sql is not None} <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name,exchanges", [
    ("drop_and_literal", 0), ("band_four", 0), ("regex_title", 0), ("split_hash_70_30", 0),
    ("assemble_vector", 0), ("vote_majority", 0), ("global_mean", 1), ("describe_typed", 1),
    ("correlation", 1), ("param_grid_scores", 1), ("predicate_text", 1), ("metric_f1", 3),
    ("group_mean_events", 2)])
def test_plans_shuffle_no_more_than_needed(spark, sf_dir, name, exchanges):
    plan = plan_of(entry_points.queries()[name](spark, sf_dir))
    assert plan.count("Exchange ") + plan.count("Exchange(") <= exchanges, plan
    assert "PythonUDF" not in plan and "ArrowEval" not in plan and "BatchEval" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_predicate_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(entry_points.queries()["predicate_text"](spark, sf_dir))
    assert "GreaterThan(o_totalprice,79100" in plan and "LessThanOrEqual(o_totalprice,144540" in plan
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in plan
