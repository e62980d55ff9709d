import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from terrace import registry
from terrace.operators import models
from terrace.registry import series as registered
from tests.conftest import SMALL

N = 300


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(N, 4)) * [1, 5, 0.3, 2]
    y = x @ [1, -0.2, 3, 0] + rng.normal(size=N) * 0.3 + 4
    rows = [(i, float(b), Vectors.dense(a)) for i, (a, b) in enumerate(zip(x, y))]
    return x - x.mean(0), y - y.mean(), spark.createDataFrame(
        rows, ["id", "y", "features"])


def descend(x, y, l1, l2):
    """Coordinate descent on half the mean squared residual plus both penalties."""
    w = np.zeros(x.shape[1])
    for _ in range(2000):
        for j in range(len(w)):
            rho = x[:, j] @ (y - x @ w + x[:, j] * w[j]) / N
            w[j] = np.sign(rho) * max(abs(rho) - l1, 0) / (x[:, j] @ x[:, j] / N + l2)
    return w


def test_linear_models_meet_their_objectives(data):
    x, y, df = data
    closed = np.linalg.solve(x.T @ x + 20 * np.eye(4), x.T @ y)
    assert np.allclose(models.ridge(df, "y", 20.0).fit(df).coefficients.toArray(), closed, atol=1e-6)
    assert np.allclose(models.lasso(df, "y", 0.3).fit(df).coefficients.toArray(),
                       descend(x, y, 0.3, 0), atol=1e-4)
    assert np.allclose(models.elastic_net(df, "y", 0.3, 0.5).fit(df).coefficients.toArray(),
                       descend(x, y, 0.15, 0.15), atol=1e-4)


def test_metrics(frame):
    df = frame("y double, prediction double", (1.0, 2.0), (2.0, 2.0), (4.0, 3.0), (5.0, 5.0))
    r = models.regression_metrics(df, "y").first()
    assert r.n == 4 and r.mae == pytest.approx(0.5) and r.rmse == pytest.approx(0.5 ** 0.5)
    assert r.r2 == pytest.approx(1 - 2 / 10) and r.mape == pytest.approx(100 * (1 + 0.25) / 4)
    assert r.accuracy == pytest.approx(100 - r.mape)


def test_leaderboard(frame):
    board = models.leaderboard(frame("model string, accuracy double", ("a", 95.0), ("b", 96.0)))
    assert [(r.place, r.model, r.beats_baseline) for r in board.collect()] == [
        (1, "b", True), (2, "a", False)]


def test_scaler_and_importance(spark, frame):
    df = frame("a double, b double, y double",
               *[(float(i), float(i % 3), 2.0 * i) for i in range(60)])
    fitted = models.scaler(["a", "b"]).fit(df)
    table = {r.feature: r for r in models.scaling_table(fitted, spark, ["a", "b"]).collect()}
    assert table["a"].mean == pytest.approx(29.5)
    assert table["a"].deviation == pytest.approx(np.std(range(60), ddof=1))
    forest = models.random_forest("y", trees=5, depth=4).fit(fitted.transform(df))
    top = models.feature_importance(forest, spark, ["a", "b"], k=1).collect()
    assert [r.feature for r in top] == ["a"]


def test_registered_trees_have_full_size(spark):
    forest, boosted = registered._forest(None), registered._boosted(None)
    assert (forest.getNumTrees(), forest.getMaxDepth()) == (200, 10)
    assert (boosted.getMaxIter(), boosted.getMaxDepth()) == (200, 5)


def test_fits_take_as_many_tasks_as_their_rows_ask_for(spark, monkeypatch):
    seen, rows_of = [], spark.range(0, 90, 1, 50)

    class Counting:
        def fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), rows.count()))
    registered._fitted(rows_of, lambda _: Counting())
    monkeypatch.setattr(models, "ROWS_PER_TASK", 40)
    registered._fitted(rows_of, lambda _: Counting())
    assert seen == [(1, 90), (3, 90)]
    assert models.gathered(rows_of.filter("id < 0")).rdd.getNumPartitions() == 1


def test_stacking_beats_its_weak_part_and_folds_are_stable(data):
    _, _, df = data
    train, test = df.filter("id < 200"), df.filter("id >= 200")
    stacked = models.stack(train, test, "y", ["id"], {
        "linear": models.ridge(train, "y"),
        "weak": models.random_forest("y", trees=1, depth=1)}, folds=3)
    assert stacked.count() == test.count()
    good = models.regression_metrics(stacked, "y").first().r2
    weak = models.regression_metrics(
        models.random_forest("y", trees=1, depth=1).fit(train).transform(test), "y").first().r2
    assert good > 0.8 > weak
    fold = models.fold_of(["id"], 3)
    assert rows(df.select("id", fold)) == rows(df.repartition(7).select("id", fold))
    assert df.select(fold.alias("f")).agg(F.count_distinct("f")).first()[0] == 3


def test_a_stack_goes_on_where_it_was(data, tmp_path, monkeypatch):
    _, _, df = data
    train, test, store = df.filter("id < 200"), df.filter("id >= 200"), str(tmp_path / "stack")
    fitted, whole = [], models._step

    def step(rest, scored, ids, name, estimator, place):
        run = whole(rest, scored, ids, name, estimator, place)

        def counted():
            if place.endswith("/1") and not fitted.count("late"):
                raise RuntimeError("the driver is gone")
            before = models.exists(rest.sparkSession, place)
            run()
            fitted.append(before)
        return counted
    monkeypatch.setattr(models, "_step", step)
    build = lambda: models.stack(train, test, "y", ["id"], {"a": models.ridge(train, "y"), "b": models.ridge(
        train, "y", 50.0)}, folds=3, store=store, workers=3)
    with pytest.raises(RuntimeError):
        build()
    assert fitted == [False] * 6
    fitted[:] = ["late"]
    first = rows(build().select("id", F.round("prediction", 9)))
    assert sorted(fitted[1:]) == [False] * 2 + [True] * 6
    monkeypatch.undo()
    again = models.stack(train, test, "y", ["id"], {"a": models.ridge(train, "y"), "b": models.ridge(train, "y", 50.0)}, folds=3)
    assert rows(again.select("id", F.round("prediction", 9))) == first


def test_registered_models_on_the_small_tables(spark):
    """All registered fits once: each beats the constant, and the leaderboard has them in order."""
    def run(name):
        return registry.runnable(name)(spark, SMALL).collect()
    board = run("ml_leaderboard_models")
    assert [r.place for r in board] == list(range(1, 7))
    accuracy = {r.model: r.accuracy for r in board}
    assert list(accuracy.values()) == sorted(accuracy.values(), reverse=True)
    assert accuracy["stacked"] >= accuracy["boosted"] > 90 and accuracy["random_forest"] > 90
    assert {r.model: round(r.accuracy, 6) for r in run("ml_linear_models")} == {
        m: round(accuracy[m], 6) for m in ("ridge", "lasso", "elastic_net")}
    # a forest draws its rows by partition, so another layout of the rows gives other trees
    assert abs(run("ml_random_forest")[0].accuracy - accuracy["random_forest"]) < 0.5
    top = run("ml_feature_importance")
    assert len(top) == 15 and top[0].feature == "sound_level"


def rows(df):
    return sorted(tuple(r) for r in df.collect())
