"""Churn model: split, preprocessing, logistic regression, scoring, metrics.

Preprocessing parameters are a few numbers per feature; they become constants
of a ``SQLTransformer``, so the fitted model is an ordinary, saveable
``PipelineModel`` that scores inside whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.fixed_values import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from tidemark.functions.statistics import exact_medians, most_frequent, rank_auc
from tidemark.session import cut_lineage

ROWS_PER_SLICE = 100_000


# ---- split --------------------------------------------------------------------


def stratified_split(
    df: DataFrame, label: str = "churned", key: str = "account_id", test_share: float = 0.20, seed: int = 42
) -> DataFrame:
    """Add ``is_train``: an exact, repeatable split that keeps label shares.

    Rows of a label are ordered by a hash of seed and key, and the first ones
    train.  The test part holds ceil(n * share) rows; labels get their floor
    of the training rows, and leftovers go to the largest remainders.

    A label may hold most rows, so its order is cut into slices of the hash, as
    many as the rows call for (counting them runs a job): slice sizes give each
    row's position without sorting a label in one task.
    """
    rows, digits = df.count(), 2
    while rows > ROWS_PER_SLICE * 16**digits:
        digits += 1
    order_key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    keyed = df.filter(F.col(label).isNotNull()).withColumns(
        {"_order": order_key, "_slice": F.substring(order_key, 1, digits)}
    )
    slices = keyed.groupBy(label, "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    by_label = Window.partitionBy(label)
    slices = slices.withColumns(
        {
            "_before": F.sum("_rows").over(by_label.orderBy("_slice")) - F.col("_rows"),
            "_label_rows": F.sum("_rows").over(by_label).cast("decimal(20,0)"),
        }
    )
    wide = "decimal(20,0)"
    labels = slices.groupBy(label).agg(F.max("_label_rows").alias("_label_rows"))  # one row per label
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("_label_rows").over(everything).cast(wide)
    labels = labels.withColumn("_all", total).withColumn(
        "_train", (F.col("_all") - F.ceil(F.col("_all") * F.lit(str(test_share)).cast("decimal(6,4)"))).cast(wide)
    )
    labels = labels.selectExpr(
        label,
        "_train",
        "cast(_train * _label_rows div _all as decimal(20,0)) as _floor",
        "_train * _label_rows % _all as _remainder",
    )
    by_remainder = Window.partitionBy(F.lit(0)).orderBy(F.col("_remainder").desc(), F.col(label))
    spare = F.col("_train") - F.sum("_floor").over(everything)
    quota = labels.select(
        label,
        (F.col("_floor") + F.when(F.row_number().over(by_remainder) <= spare, 1).otherwise(0)).alias("_quota"),
    )
    slices = slices.join(quota, label).select(label, "_slice", "_before", "_quota")
    position = F.col("_before") + F.row_number().over(Window.partitionBy(label, "_slice").orderBy("_order", key))
    return (
        keyed.join(slices, [label, "_slice"])
        .withColumn("is_train", position <= F.col("_quota"))
        .select(*df.columns, "is_train")
    )


# ---- preprocessing --------------------------------------------------------------


@dataclass(frozen=True)
class Preprocessing:
    """Fitted fill values and scales, a few numbers per feature."""

    medians: dict
    modes: dict
    means: dict
    deviations: dict


def fit_impute(train: DataFrame, numeric=NUMERIC_FEATURES, categorical=CATEGORICAL_FEATURES) -> tuple[dict, dict]:
    """(exact medians, most frequent values) of the training rows."""
    return exact_medians(train, numeric), most_frequent(train, categorical)


def impute(df: DataFrame, medians: dict, modes: dict) -> DataFrame:
    filled = {name: F.coalesce(F.col(name).cast("double"), F.lit(value)) for name, value in medians.items()}
    filled |= {name: F.coalesce(F.col(name), F.lit(value)) for name, value in modes.items()}
    return df.withColumns(filled)


def fit_standardize(imputed: DataFrame, numeric=NUMERIC_FEATURES) -> tuple[dict, dict]:
    """(means, population deviations) in one pass; a constant column scales by 1."""
    row = imputed.agg(
        *[F.avg(name).alias(f"mean_{name}") for name in numeric],
        *[F.stddev_pop(name).alias(f"dev_{name}") for name in numeric],
    ).first()
    means = {name: row[f"mean_{name}"] for name in numeric}
    deviations = {name: row[f"dev_{name}"] or 1.0 for name in numeric}
    return means, deviations


def standardize(df: DataFrame, means: dict, deviations: dict) -> DataFrame:
    return df.withColumns(
        {name: (F.col(name).cast("double") - means[name]) / deviations[name] for name in means}
    )


def fit_preprocessing(train: DataFrame) -> Preprocessing:
    medians, modes = fit_impute(train)
    # A column without any value carries no signal: a constant stands in.
    medians = {name: 0.0 if value is None else value for name, value in medians.items()}
    means, deviations = fit_standardize(impute(train, medians, modes))
    return Preprocessing(medians, modes, means, deviations)


def _scaling_stage(fitted: Preprocessing) -> SQLTransformer:
    def number(value) -> str:
        return f"{float(value)!r}D"

    scaled = [
        f"(coalesce(double({name}), {number(fitted.medians[name])}) - {number(fitted.means[name])})"
        f" / {number(fitted.deviations[name])} AS scaled_{name}"
        for name in NUMERIC_FEATURES
    ]
    filled = []
    for name in CATEGORICAL_FEATURES:
        literal = str(fitted.modes[name]).replace("\\", "\\\\").replace("'", "\\'")
        filled.append(f"coalesce({name}, '{literal}') AS filled_{name}")
    return SQLTransformer(statement=f"SELECT *, {', '.join(scaled + filled)} FROM __THIS__")


def fit_one_hot(train: DataFrame, columns=CATEGORICAL_FEATURES, prefix: str = "") -> PipelineModel:
    """Indicators per training category in alphabetical order; a category not
    seen in training gets all zeros."""
    inputs = [f"{prefix}{name}" for name in columns]
    indexes = [f"index_{name}" for name in columns]
    indexer = StringIndexer(
        inputCols=inputs, outputCols=indexes, handleInvalid="keep", stringOrderType="alphabetAsc"
    ).fit(train)
    # "keep" adds an index for unseen values and dropLast drops its indicator.
    encoder = OneHotEncoder(
        inputCols=indexes, outputCols=[f"onehot_{name}" for name in columns], dropLast=True
    ).fit(indexer.transform(train))
    return PipelineModel(stages=[indexer, encoder])


# ---- model ------------------------------------------------------------------------


def churn_fit(train: DataFrame, label: str = "churned", iterations: int = 2000) -> PipelineModel:
    """L2 logistic regression with balanced class weights over all features.

    The training rows are materialised once, since every fitting pass reads
    them.  Balanced weights sum to n, so a unit penalty on the summed loss is
    ``regParam = 1 / n`` on Spark's averaged loss.
    """
    train = cut_lineage(train.filter(F.col(label).isNotNull()))
    scaling = _scaling_stage(fit_preprocessing(train))
    prepared = scaling.transform(train)
    one_hot = fit_one_hot(prepared, prefix="filled_")
    assembler = VectorAssembler(
        inputCols=[f"scaled_{name}" for name in NUMERIC_FEATURES] + [f"onehot_{name}" for name in CATEGORICAL_FEATURES],
        outputCol="features",
    )
    class_rows = {row[label]: row["count"] for row in train.groupBy(label).count().collect()}  # two rows
    n = sum(class_rows.values())
    weight = F.lit(None).cast("double")
    for value, rows in class_rows.items():
        weight = F.when(F.col(label) == value, n / (len(class_rows) * rows)).otherwise(weight)
    regression = LogisticRegression(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        regParam=1.0 / n,
        elasticNetParam=0.0,
        standardization=False,
        maxIter=iterations,
        tol=1e-9,
    )
    points = assembler.transform(one_hot.transform(prepared)).select(
        "features", F.col(label).cast("double").alias("label"), weight.alias("weight")
    )
    fitted = regression.fit(points)
    # The summary holds the training rows and the session; with it the model cannot
    # be sent to tasks once the session has observed counts.
    fitted._java_obj.setSummary(train.sparkSession._jvm.scala.Option.empty())
    return PipelineModel(stages=[scaling, *one_hot.stages, assembler, fitted])


def churn_score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Probability of churn per account; keeps the label when there is one."""
    kept = [name for name in ("account_id", "churned") if name in features.columns]
    return model.transform(features).select(
        *kept, vector_to_array("probability")[1].alias("churn_probability")
    )


def _dot(coefficients: list[float]) -> Column:
    weights = F.array(*map(F.lit, coefficients))
    return F.aggregate(F.zip_with("x", weights, lambda x, w: x * w), F.lit(0.0), lambda total, each: total + each)


def score_gaps(model: PipelineModel, features: DataFrame) -> DataFrame:
    """(account_id, gap): how far a score is from the logistic of the coefficients
    the model publishes, in six decimals."""
    fitted = model.stages[-1]
    scored = model.transform(features).select(
        "account_id", vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p")
    )
    logistic = 1 / (1 + F.exp(-(F.lit(float(fitted.intercept)) + _dot(fitted.coefficients.toArray().tolist()))))
    return scored.select("account_id", F.round(F.abs(F.col("p") - logistic), 6).alias("gap"))


def loss_gradients(model: PipelineModel, train: DataFrame, label: str = "churned") -> DataFrame:
    """(feature_no, gradient): slope of the penalised loss at the fitted coefficients,
    the intercept last, in four decimals; zero at the optimum."""
    train = train.filter(F.col(label).isNotNull())
    class_rows = {row[label]: row["count"] for row in train.groupBy(label).count().collect()}  # two rows
    n = sum(class_rows.values())
    weight = F.lit(None).cast("double")
    for value, rows in class_rows.items():
        weight = F.when(F.col(label) == value, n / (len(class_rows) * rows)).otherwise(weight)
    coefficients = model.stages[-1].coefficients.toArray().tolist()
    points = model.transform(train).select(
        F.concat(vector_to_array("features"), F.array(F.lit(1.0))).alias("x"),
        (weight * (vector_to_array("probability")[1] - F.col(label))).alias("error"),
    )
    penalty = F.element_at(F.array(*map(F.lit, [*coefficients, 0.0])), (F.col("feature_no") + 1).cast("int"))
    return (
        points.select("error", F.posexplode("x").alias("feature_no", "value"))
        .groupBy(F.col("feature_no").cast("bigint").alias("feature_no"))
        .agg(F.sum(F.col("error") * F.col("value")).alias("slope"))
        .select("feature_no", F.round(F.abs((F.col("slope") + penalty) / n), 4).alias("gradient"))
    )


# ---- metrics -----------------------------------------------------------------------


def _confusion(scored: DataFrame, label: str) -> DataFrame:
    actual = F.col(label) == 1
    predicted = F.col("churn_probability") > 0.5
    return scored.filter(F.col(label).isNotNull()).agg(
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(~actual & ~predicted).alias("tn"),
    )


def _ratio(part, whole):
    return F.coalesce(part / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0))


def churn_metrics(scored: DataFrame, label: str = "churned") -> DataFrame:
    """Accuracy, precision, recall and area under the curve, long format."""
    tp, fp, fn, tn = (F.col(name) for name in ("tp", "fp", "fn", "tn"))
    rates = _confusion(scored, label).select(
        F.inline(
            F.array(
                F.struct(F.lit("accuracy").alias("metric"), _ratio(tp + tn, tp + tn + fp + fn).alias("value")),
                F.struct(F.lit("precision").alias("metric"), _ratio(tp, tp + fp).alias("value")),
                F.struct(F.lit("recall").alias("metric"), _ratio(tp, tp + fn).alias("value")),
            )
        )
    )
    auc = rank_auc(scored, label, "churn_probability").select(
        F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value")
    )
    return rates.unionByName(auc)


def classification_report(scored: DataFrame, label: str = "churned") -> DataFrame:
    """Precision, recall, F1 and support per class, with both averages."""
    classes = _confusion(scored, label).select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("0").alias("class"), F.col("tn").alias("hit"),
                    (F.col("tn") + F.col("fn")).alias("called"), (F.col("tn") + F.col("fp")).alias("support"),
                ),
                F.struct(
                    F.lit("1").alias("class"), F.col("tp").alias("hit"),
                    (F.col("tp") + F.col("fp")).alias("called"), (F.col("tp") + F.col("fn")).alias("support"),
                ),
            )
        )
    )
    precision, recall = _ratio(F.col("hit"), F.col("called")), _ratio(F.col("hit"), F.col("support"))
    rated = classes.select("class", precision.alias("precision"), recall.alias("recall"), "support")
    both = F.col("precision") + F.col("recall")
    rated = rated.withColumn("f1_score", _ratio(2 * F.col("precision") * F.col("recall"), both))
    scores = ("precision", "recall", "f1_score")
    macro = rated.agg(
        F.lit("macro avg").alias("class"),
        *[F.avg(name).alias(name) for name in scores],
        F.sum("support").alias("support"),
    )
    weighted = rated.agg(
        F.lit("weighted avg").alias("class"),
        *[_ratio(F.sum(F.col(name) * F.col("support")), F.sum("support")).alias(name) for name in scores],
        F.sum("support").alias("support"),
    )
    columns = ["class", *scores, "support"]
    return rated.select(*columns).unionByName(macro.select(*columns)).unionByName(weighted.select(*columns))
