"""Split, preprocessing, fit and metrics against plain numpy on small data."""

import math
import statistics

import numpy as np
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tidemark.functions.fixed_values import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from tidemark.functions.statistics import DIGITS, exact_medians, most_frequent, ordered_digit, rank_auc
from tidemark.operators import churn_model

FEATURES = (
    "account_id bigint, " + ", ".join(f"{name} double" for name in NUMERIC_FEATURES) + ", "
    + ", ".join(f"{name} string" for name in CATEGORICAL_FEATURES) + ", churned int"
)


def training_rows(n=400, seed=7):
    rng = np.random.default_rng(seed)
    data = []
    for i in range(n):
        numeric = rng.normal(size=len(NUMERIC_FEATURES)) * np.arange(1, len(NUMERIC_FEATURES) + 1)
        numeric = [float(x) for x in numeric]
        label = int(numeric[0] + 0.2 * numeric[1] + rng.normal() > 0.8)
        if i % 17 == 0:
            numeric[1] = None
        text = [str(rng.choice(["x", "y", "z"])), str(rng.choice(["s", "l"])), None if i % 23 == 0 else "north"]
        data.append((i, *numeric, *text, label))
    return data


def newton(x, y, weight, ridge=1.0):
    """Minimise ridge/2 |w|^2 + sum of weighted log losses; free intercept."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([ridge] * x.shape[1] + [0.0])
    w = np.zeros(x1.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-x1 @ w))
        gradient = x1.T @ (weight * (p - y)) + penalty @ w
        hessian = (x1 * (weight * p * (1 - p))[:, None]).T @ x1 + penalty
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-12:
            break
    return w


def prepared(data):
    """The preprocessing once more, in numpy."""
    numeric = np.array([[np.nan if v is None else v for v in row[1:12]] for row in data], dtype=float)
    numeric = np.where(np.isnan(numeric), np.nanmedian(numeric, axis=0), numeric)
    scaled = (numeric - numeric.mean(axis=0)) / numeric.std(axis=0)
    blocks = [scaled]
    for position in (12, 13, 14):
        values = [row[position] for row in data]
        present = [v for v in values if v is not None]
        mode = min(set(present), key=lambda v: (-present.count(v), v))
        values = [mode if v is None else v for v in values]
        blocks.append(np.array([[float(v == c) for c in sorted(set(values))] for v in values]))
    return np.hstack(blocks)


@pytest.fixture(scope="module")
def fitted(spark):
    data = training_rows()
    train = spark.createDataFrame(data, FEATURES)
    return data, train, churn_model.churn_fit(train)


def test_fit_equals_newton(fitted):
    data, _, model = fitted
    x, y = prepared(data), np.array([row[-1] for row in data], dtype=float)
    counts = np.bincount(y.astype(int))
    weight = np.where(y == 1, len(y) / (2 * counts[1]), len(y) / (2 * counts[0]))
    expected = newton(x, y, weight)
    regression = model.stages[-1]
    assert np.allclose(regression.coefficients.toArray(), expected[:-1], atol=1e-5)
    assert regression.intercept == pytest.approx(expected[-1], abs=1e-5)


def test_scores_survive_saving(spark, fitted, tmp_path):
    data, train, model = fitted
    x = prepared(data)
    regression = model.stages[-1]
    expected = 1 / (1 + np.exp(-(x @ regression.coefficients.toArray() + regression.intercept)))
    scored = rows(churn_model.churn_score(model, train.drop("churned")), "account_id", "churn_probability")
    assert np.allclose([p for _, p in scored], expected, atol=1e-9)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert rows(churn_model.churn_score(again, train), "account_id", "churn_probability") == scored


def test_unseen_category_scores(spark, fitted):
    _, train, model = fitted
    strange = train.limit(1).withColumn("industry", F.lit("never seen"))
    coded = model.transform(strange).select("onehot_industry").first()[0]
    assert coded.size == 3 and coded.numNonzeros() == 0
    assert 0 < churn_model.churn_score(model, strange).first()["churn_probability"] < 1


def test_constant_and_empty_columns(spark):
    frame = spark.createDataFrame([(1.0, None), (1.0, None)], "a double, b double")
    assert exact_medians(frame, ["a", "b"]) == {"a": 1.0, "b": None}
    assert churn_model.fit_standardize(frame, ["a"]) == ({"a": 1.0}, {"a": 1.0})


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.one_of(st.none(), st.integers(-3, 3).map(float), st.floats(-1e6, 1e6)), min_size=1, max_size=40),
    rows_in_order=st.sampled_from([0, 5, 65_536]),
)
def test_medians(spark, values, rows_in_order):
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    present = [v for v in values if v is not None]
    expected = statistics.median(present) if present else None
    assert exact_medians(frame, ["x"], rows_in_order) == {"x": pytest.approx(expected) if present else None}


def test_medians_with_a_value_holding_a_third(spark):
    frame = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") / 7).alias("x"), (F.col("id") % 10).alias("y")
    )
    values = sorted(5.0 if i % 3 == 0 else i / 7 for i in range(30_000))
    assert exact_medians(frame, ["x", "y"]) == {"x": pytest.approx(statistics.median(values)), "y": 4.5}


@pytest.mark.parametrize("rows_in_order", [0, 65_536])
def test_medians_of_hard_columns(spark, rows_in_order):
    power = 2.0**40
    columns = {
        "equal": [7.25] * 8,
        "close": [1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 2), 1.0, math.nextafter(1.0, 0), 1.0, 3.0, 3.0],
        "far": [-1e308, -5e-324, 0.0, 5e-324, 1e-300, 1e300, 1e308, float("inf")],
        "minus": [-float("inf"), -1e308, -power, math.nextafter(-power, 0), -3.0, -2.0, -1.0, None],
        "missing": [None, float("nan")] * 4,
    }
    frame = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{name} double" for name in columns))
    found = exact_medians(frame, columns, rows_in_order)
    expected = {name: statistics.median(v for v in values if v is not None) for name, values in columns.items() if name != "missing"}
    assert found == expected | {"missing": None}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(allow_nan=False), min_size=1, max_size=60))
def test_digits_keep_the_order_of_doubles(spark, values):
    near = [math.nextafter(2.0**k, way) for k in (-1074, -1022, -3, 0, 1, 29, 1023) for way in (0.0, float("inf"))]
    values = sorted({*values, *near, *(-v for v in near), 0.0})
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    digits = frame.select("x", F.array(*[ordered_digit(F.col("x"), n) for n in range(1, DIGITS + 1)]).alias("d")).collect()
    by_digits = sorted(digits, key=lambda row: row["d"])
    assert [row["x"] for row in by_digits] == values
    assert len({tuple(row["d"]) for row in digits}) == len(values)


def test_most_frequent_prefers_the_smallest(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,), ("c",)], "x string")
    assert most_frequent(frame, ["x"]) == {"x": "a"}


@pytest.mark.parametrize("n, positives", [(10, 5), (11, 3), (103, 29), (1000, 333)])
def test_split_sizes(spark, n, positives):
    frame = spark.range(n).select(
        F.col("id").alias("account_id"), F.when(F.col("id") < positives, 1).otherwise(0).alias("churned")
    )
    split = churn_model.stratified_split(frame)
    counts = {row["churned"]: row["n"] for row in split.filter("is_train").groupBy("churned").agg(F.count("*").alias("n")).collect()}
    n_train = n - math.ceil(n / 5)
    assert sum(counts.values()) == n_train and split.count() == n
    for label, size in ((1, positives), (0, n - positives)):
        assert abs(counts[label] - n_train * size / n) < 1
    assert rows(split) == rows(churn_model.stratified_split(frame.repartition(5)))
    assert rows(split) != rows(churn_model.stratified_split(frame, seed=43))


def brute_auc(data):
    pairs = [(a, b) for a, x in data if x == 1 for b, y in data if y == 0]
    return None if not (pairs := [(a > b) + (a == b) / 2 for (a, b) in pairs]) else sum(pairs) / len(pairs)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9]) | st.floats(0, 1), st.integers(0, 1)), min_size=1, max_size=30), per_slice=st.sampled_from([1, 3, 500_000]))
def test_auc(spark, data, per_slice):
    frame = spark.createDataFrame(data, "churn_probability double, churned int")
    value = rank_auc(frame, "churned", "churn_probability", per_slice).first()["roc_auc"]
    expected = brute_auc(data)
    assert value is None if expected is None else value == pytest.approx(expected)


def test_auc_with_one_hot_score(spark):
    frame = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") / 3000).alias("churn_probability"),
        (F.col("id") % 2).cast("int").alias("churned"),
    )
    data = [(0.5 if i % 3 == 0 else i / 3000, i % 2) for i in range(3000)]
    order = sorted(data)
    ranks = {}
    for place, (score, _) in enumerate(order, start=1):
        ranks.setdefault(score, []).append(place)
    total = sum(sum(ranks[s]) / len(ranks[s]) for s, y in data if y == 1)
    expected = (total - 1500 * 1501 / 2) / (1500 * 1500)
    assert rank_auc(frame, "churned", "churn_probability").first()["roc_auc"] == pytest.approx(expected)


def test_metrics(spark):
    data = [(0.9, 1), (0.8, 1), (0.5, 1), (0.6, 0), (0.2, 0), (0.1, 0), (0.3, None)]
    frame = spark.createDataFrame(data, "churn_probability double, churned int")
    values = dict(rows(churn_model.churn_metrics(frame)))
    assert values == {
        "accuracy": pytest.approx(4 / 6), "precision": pytest.approx(2 / 3), "recall": pytest.approx(2 / 3),
        "roc_auc": pytest.approx(8 / 9),
    }
    report = {row["class"]: row for row in churn_model.classification_report(frame).collect()}
    assert report["0"]["support"] == 3 and report["weighted avg"]["support"] == 6
    assert report["macro avg"]["f1_score"] == pytest.approx(2 / 3)
    never = frame.withColumn("churn_probability", F.lit(0.1))
    assert dict(rows(churn_model.churn_metrics(never)))["precision"] == 0.0
