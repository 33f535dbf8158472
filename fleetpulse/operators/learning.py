"""Splitting, scaling, training, evaluation and persistence of failure classifiers."""

import json
import math
import os

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from fleetpulse.functions.ordered import grouped_running_totals, running_totals
from fleetpulse.operators import trees
from fleetpulse.schema import FEATURE_COLUMNS
from fleetpulse.session import settle

# Settings of the three classifiers.
KINDS = ["boosted", "forest", "logistic"]
ROUNDS = 200
DEPTH = 6
LEARNING_RATE = 0.1
LOGISTIC_ITERATIONS = 1000
LOGISTIC_TOLERANCE = 1e-5
LOGISTIC_PENALTY = 1.0
SEED = 42
PART_BYTES = 256 * 1024 * 1024  # of a training partition as the trees keep it


def unit_hash(seed: int, *columns: str) -> Column:
    """A number in [0, 1) that depends on the columns' values only."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *columns))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 2.0**32


def with_split(
    df: DataFrame, by: str = "drive", test: float = 0.2, validation: float = 0.1, seed: int = SEED
) -> DataFrame:
    """Add ``split``: train, validation or test.

    A hash assigns the rows, so nothing is shuffled and reruns agree. A class keeps its
    share on average only; ``with_stratified_split`` keeps it exactly. ``by='drive'`` puts all rows of a drive on one side; ``by='row'`` lets one
    drive fall on several. ``validation`` is a share of what ``test`` leaves.
    """
    keys = {"drive": ["serial_number"], "row": ["serial_number", "date"]}[by]
    u = unit_hash(seed, *keys)
    return df.withColumn(
        "split",
        F.when(u < test, "test").when(u < test + (1 - test) * validation, "validation").otherwise("train"),
    )


DIGITS = 4  # hex digits of a digest that one histogram looks at


def smallest_digests(df: DataFrame, group: str, digest: str, counts: dict[object, list[int]]) -> dict[tuple[object, int], str]:
    """The k-th smallest ``digest`` of a group, for the ``counts`` k of each group.

    A histogram over the first digits finds the bucket that holds the k-th one, a histogram
    of that bucket the next digits, until a bucket has one row; no row is sorted, and at
    most one row per group and k comes to the driver each time.
    """
    spark = df.sparkSession
    open_, found = [(g, k, "", k) for g, ks in counts.items() for k in ks if k > 0], {}
    kind = df.schema[group].dataType.simpleString()
    length = 0
    while open_:
        length += DIGITS
        wanted = spark.createDataFrame(open_, f"_group {kind}, _k long, _prefix string, _rest long")
        met = df.join(F.broadcast(wanted), (F.col(group) == F.col("_group")) & F.startswith(F.col(digest), F.col("_prefix")))
        buckets = met.groupBy("_group", "_k", "_rest", F.left(digest, F.lit(length)).alias("_bucket")).agg(
            F.count("*").alias("_n"), F.min(digest).alias("_least")
        )
        upto = F.sum("_n").over(W.partitionBy("_group", "_k").orderBy("_bucket"))
        rows = buckets.withColumn("_upto", upto).where((F.col("_upto") >= F.col("_rest")) & (F.col("_upto") - F.col("_n") < F.col("_rest"))).collect()
        open_ = []
        for r in rows:
            if r._n == 1 or len(r._bucket) == len(r._least):
                found[r._group, r._k] = r._least
            else:
                open_.append((r._group, r._k, r._bucket, r._rest - (r._upto - r._n)))
    return found


def with_stratified_split(
    df: DataFrame, by: str = "drive", test: float = 0.2, validation: float = 0.1, seed: int = SEED
) -> DataFrame:
    """Add ``split``: train, validation or test, each with its share of either label, exact to one.

    ``by='row'`` splits the rows of each label; ``by='drive'`` splits the drives that have a
    positive row and those that have none, and their rows go with them. Of each class the
    least seeded digests are the test part, the next the validation part, which is a share
    of what ``test`` leaves; halves are rounded up. Reruns agree, whatever the order of rows.
    Rows that share their key and label are counted each and fall on one side together.
    """
    keys = {"drive": ["serial_number"], "row": ["serial_number", "date"]}[by]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *keys)).alias("digest")
    if by == "drive":
        units = df.groupBy(*keys).agg(F.max("label").alias("class")).select("class", digest, *keys)
    else:
        units = df.select(F.col("label").alias("class"), digest, *keys)
    units = settle(units, "split-units")
    counts = {}
    for r in units.groupBy("class").agg(F.count("*").alias("n")).collect():
        tested = math.floor(r.n * test + 0.5)
        counts[r["class"]] = [tested, tested + math.floor((r.n - tested) * validation + 0.5)]
    edges = smallest_digests(units, "class", "digest", counts)

    def upto(place: int) -> Column:
        """Whether the digest is among the first ones of its class."""
        out = F.lit(False)
        for c, ks in counts.items():
            if (c, ks[place]) in edges:
                out = F.when(F.col("class") == c, F.col("digest") <= edges[c, ks[place]]).otherwise(out)
        return out

    split = F.when(upto(0), "test").when(upto(1), "validation").otherwise("train").alias("split")
    if by == "row":
        return df.withColumns({"class": F.col("label"), "digest": digest}).select(*df.columns, split)
    return df.join(units.select(*keys, split), keys)


def split_gains(df: DataFrame, columns: list[str] = FEATURE_COLUMNS) -> DataFrame:
    """The best single threshold of every input: Gini gain, threshold and place, the highest gain first.

    Rows collapse to class counts per (input, value) in one pass over all inputs; running
    totals along the values give both sides of every threshold. ``value <= threshold`` goes
    left; of equal gains, to 12 places, the least threshold counts. Inputs with a single
    value have no threshold and are left out.
    """
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    histogram = df.select("label", F.inline(F.array(*cells))).groupBy("feature", "value").agg(
        F.count_if(F.col("label") == 1).alias("positives"), F.count_if(F.col("label") == 0).alias("negatives")
    )
    ranked = grouped_running_totals(histogram, "feature", "value", ["positives", "negatives"])
    whole = ranked.groupBy(F.col("feature").alias("f")).agg(F.sum("positives").alias("p"), F.sum("negatives").alias("n"))

    def impurity(p: Column, n: Column) -> Column:
        return 1 - F.pow(p / (p + n), 2) - F.pow(n / (p + n), 2)

    p, n = (F.col(c).cast("double") for c in ("p", "n"))
    left_p, left_n = (F.col(c).cast("double") for c in ("positives_upto", "negatives_upto"))
    right_p, right_n = p - left_p, n - left_n
    gain = impurity(p, n) - (left_p + left_n) / (p + n) * impurity(left_p, left_n) - (right_p + right_n) / (p + n) * impurity(right_p, right_n)
    cuts = ranked.join(whole, F.col("feature") == F.col("f")).where(right_p + right_n > 0)
    best = cuts.groupBy("feature").agg(F.max(F.struct(F.round(gain, 12).alias("gain"), (-F.col("value")).alias("low"))).alias("best"))
    place = F.row_number().over(W.orderBy(F.desc("best.gain"), "feature"))
    return best.select("feature", (-F.col("best.low")).alias("threshold"), F.col("best.gain").alias("gain"), place.alias("place")).orderBy("place")


def scaler_statistics(df: DataFrame, columns: list[str] = FEATURE_COLUMNS) -> DataFrame:
    """Mean and population deviation of every column, from one pass."""
    wide = df.agg(*[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("mean", F.avg), ("std", F.stddev_pop))])
    lines = [
        F.struct(F.lit(c).alias("feature"), F.col(f"{c}_mean").alias("mean"), F.col(f"{c}_std").alias("std"))
        for c in columns
    ]
    return wide.select(F.inline(F.array(*lines)))


def class_weights(df: DataFrame) -> DataFrame:
    """Samples and balanced weight per class: all samples over classes times its own."""
    counts = df.groupBy("label").agg(F.count("*").alias("samples"))
    total = counts.agg(F.sum("samples")).scalar()
    classes = counts.agg(F.count("*")).scalar()
    return counts.withColumn("weight", total.cast("double") / (classes * F.col("samples")))


def positive_weight(df: DataFrame) -> DataFrame:
    """Negatives per positive."""
    return df.agg(
        F.try_divide(
            F.count_if(F.col("label") == 0).cast("double"), F.count_if(F.col("label") == 1).cast("double")
        ).alias("scale_pos_weight")
    )


def weighted(df: DataFrame, kind: str) -> DataFrame:
    """Add ``weight``: balanced classes for the logistic model, weighted positives for trees.

    The weight table is broadcast: a label is 0 or 1, so it has two rows at most.
    """
    if kind == "logistic":
        weights = class_weights(df).select("label", "weight")
        return df.join(F.broadcast(weights), "label")
    scale = positive_weight(df).scalar()
    return df.withColumn("weight", F.when(F.col("label") == 1, scale).otherwise(F.lit(1.0)))


def classifier(kind: str, samples: int, rounds: int = ROUNDS, seed: int = SEED):
    """An unfitted classifier; the logistic penalty is per data set, so it is spread over ``samples``."""
    settings = dict(featuresCol="features", labelCol="label", weightCol="weight")
    if kind == "boosted":
        return GBTClassifier(maxIter=rounds, maxDepth=DEPTH, stepSize=LEARNING_RATE, seed=seed, **settings)
    if kind == "forest":
        return RandomForestClassifier(numTrees=rounds, maxDepth=DEPTH, seed=seed, **settings)
    if kind == "logistic":
        return LogisticRegression(
            maxIter=LOGISTIC_ITERATIONS, tol=LOGISTIC_TOLERANCE, regParam=LOGISTIC_PENALTY / samples,
            standardization=False, **settings,
        )
    raise ValueError(f"unknown classifier {kind!r}")


def training_parts(kind: str, samples: int, inputs: int, rounds: int) -> int:
    """Partitions that keep what a task holds of the samples within ``PART_BYTES``.

    Trees keep every row in memory with its bins, and a forest with a count for each of its trees.
    """
    row = 16 * inputs + (4 * rounds if kind == "forest" else 0)
    return math.ceil(samples * row / PART_BYTES)


def train(
    df: DataFrame, kind: str = "boosted", columns: list[str] = FEATURE_COLUMNS, rounds: int = ROUNDS
) -> PipelineModel:
    """Fit scaler and classifier on a training matrix."""
    samples = df.count()
    parts = training_parts(kind, samples, len(columns), rounds)
    if parts > df.sparkSession.sparkContext.defaultParallelism:  # a stored matrix is read in so many at least
        df = df.repartition(parts)
    scaler = [
        VectorAssembler(inputCols=columns, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
    ]
    estimator, table = classifier(kind, samples, rounds), weighted(df, kind)
    if kind == "logistic":
        return Pipeline(stages=[*scaler, estimator]).fit(table)
    scaling = Pipeline(stages=scaler).fit(table)
    return PipelineModel([*scaling.stages, trees.fit(estimator, scaling.transform(table))])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add predicted class and probability of failure."""
    kept = [c for c in df.columns]
    return model.transform(df).select(
        *kept, F.col("prediction").cast("int").alias("prediction"), vector_to_array("probability")[1].alias("probability")
    )


def confusion(df: DataFrame) -> DataFrame:
    """Counts of true and false positives and negatives, in one row."""
    label, guess = F.col("label"), F.col("prediction")
    return df.agg(
        F.count_if((label == 1) & (guess == 1)).alias("tp"),
        F.count_if((label == 0) & (guess == 1)).alias("fp"),
        F.count_if((label == 0) & (guess == 0)).alias("tn"),
        F.count_if((label == 1) & (guess == 0)).alias("fn"),
    )


def classification_metrics(df: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1; 0 where undefined."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    return confusion(df).select(
        ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def roc_auc(df: DataFrame, score: str = "probability") -> DataFrame:
    """Exact area under the ROC curve, ties counted half; NULL with a single class.

    Rows collapse to one per distinct score first; their running totals are computed
    in even score slices.
    """
    histogram = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col("label") == 1).alias("positives"), F.count_if(F.col("label") == 0).alias("negatives")
    )
    ranked = running_totals(histogram, "score", ["negatives"])
    below = F.col("negatives_upto") - F.col("negatives") / 2
    positives, negatives = F.sum("positives").cast("double"), F.sum("negatives").cast("double")
    return ranked.agg(
        F.try_divide(F.sum(F.col("positives") * below), positives * negatives).alias("roc_auc")
    )


def evaluate(df: DataFrame) -> DataFrame:
    """All five metrics of a predicted frame in one row."""
    return classification_metrics(df).withColumn("roc_auc", roc_auc(df).scalar())


def feature_importance(model: PipelineModel, columns: list[str] = FEATURE_COLUMNS) -> DataFrame:
    """Importance per input, highest first: impurity gain for trees, size of the coefficient else."""
    fitted = model.stages[-1]
    values = fitted.featureImportances if hasattr(fitted, "featureImportances") else fitted.coefficients
    rows = [(name, abs(float(v))) for name, v in zip(columns, values.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def best_model(comparison: DataFrame) -> DataFrame:
    """The row with the highest ROC AUC."""
    return comparison.orderBy(F.desc_nulls_last("roc_auc"), "model").limit(1)


def save_bundle(model: PipelineModel, path: str, kind: str, metrics: DataFrame, columns: list[str]) -> None:
    """Store a fitted pipeline with its kind, metrics and input names."""
    model.write().overwrite().save(os.path.join(path, "pipeline"))
    info = metrics.select(
        F.lit(kind).alias("model_type"),
        F.to_json(F.struct(*metrics.columns)).alias("metrics"),
        F.array(*[F.lit(c) for c in columns]).alias("feature_names"),
    )
    info.write.mode("overwrite").json(os.path.join(path, "info"))


def load_bundle(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    """A stored pipeline and its description."""
    schema = "model_type string, metrics string, feature_names array<string>"
    info = spark.read.schema(schema).json(os.path.join(path, "info")).first().asDict()
    info["metrics"] = json.loads(info["metrics"])
    return PipelineModel.load(os.path.join(path, "pipeline")), info


def model_info(model: PipelineModel, info: dict, top: int = 10) -> DataFrame:
    """Kind, number of inputs, metrics and the ``top`` inputs of a stored model."""
    ranked = feature_importance(model, info["feature_names"]).limit(top)
    return ranked.select(
        F.lit(info["model_type"]).alias("model_type"),
        F.lit(len(info["feature_names"])).alias("feature_count"),
        *[F.lit(value).cast("double").alias(name) for name, value in info["metrics"].items()],
        "feature",
        "importance",
    )
