"""Training, saving, scoring and evaluating tree models as Spark ML pipelines."""
from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IndexToString, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import columns_of, dtypes, is_numeric, q, quoted
from ..session import local_table, shared_dir, small_table, written
from . import boosting, forest
from .columns import label_index
from .profile import long_values
from .ranking import number_rows
from .sampling import stratified_split

MAX_CATEGORIES = 100_000
TRAINING_PARTITIONS = 32
TRAINING_ROWS = 1 << 19


@dataclass
class TrainedModel:
    """A fitted pipeline with the features it expects and the labels behind its indices.

    ``codes`` has a table (value, code) per text feature and the number of its values; ``boosted`` the trees of a boosted
    model, whose pipeline ends with the features.
    """
    pipeline: PipelineModel
    features: list[str]
    text_features: list[str]
    labels: list[str]
    label_col: str
    codes: dict[str, tuple[DataFrame, int]] = field(default_factory=dict)
    boosted: boosting.Boosted | None = None

    @property
    def classifier(self):
        return self.pipeline.stages[-2]


def label_mapping(df: DataFrame, label_col: str = "label") -> DataFrame:
    """``(label, label_index)``: positions among the sorted distinct labels."""
    return label_index(df, label_col).withColumnRenamed("_label", "label")


def encode_features(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replaces text columns by the position of each value among the sorted distinct values; NULL stays NULL.

    The values of all columns are fetched in one job if a sketch says that they are few, and become broadcast tables;
    the values of other columns are ranked and joined.
    """
    columns, order = columns_of(df, "string") if columns is None else columns, df.columns
    if not columns:
        return df
    rough = df.agg(*[F.approx_count_distinct(q(c)) for c in columns]).first()
    few = [c for c, n in zip(columns, rough) if n <= MAX_CATEGORIES // len(columns)]
    texts: dict[str, list[str]] = {}
    if few:
        _, rows = small_table(long_values(df, few).where(q("value").isNotNull()).distinct(), 2 * MAX_CATEGORIES)
        for r in rows or ():
            texts.setdefault(r["column"], []).append(r["value"])
        if rows is not None:
            texts.update({c: [] for c in few if c not in texts})
    for c in columns:
        if c in texts:
            codes = [(v, i) for i, v in enumerate(sorted(texts[c], key=lambda v: v.encode()))]
            codes = F.broadcast(local_table(df.sparkSession, codes, "_value string, _code bigint"))
        else:
            values = df.where(q(c).isNotNull()).select(q(c).alias("_value")).distinct()
            codes = number_rows(values, (), "_value", out="_rn").select("_value", (q("_rn") - 1).alias("_code"))
        df = df.join(codes, q(c) == q("_value"), "left").drop("_value", c).withColumnRenamed("_code", c)
    return df.select(*[q(c) for c in order])


def _prepared(df: DataFrame, features: list[str], text: list[str]) -> list[Column]:
    """The features as the pipeline takes them: numbers as doubles, text as it is."""
    return [q(c).cast("string").alias(c) if c in text else q(c).cast("double").alias(c) for c in features]


def _fills(training: DataFrame, numeric: list[str]) -> list[float]:
    """For each number a value below all of its values: where missing values go, so that trees can tell them apart."""
    if not numeric:
        return []
    lows = training.agg(*[F.min(F.when(F.abs(q(c)) < float("inf"), q(c))).alias(f"l{i}") for i, c in enumerate(numeric)]).first()
    return [-1.0 if low is None else low - max(1.0, abs(low)) for low in lows]


def _value_codes(df: DataFrame, c: str) -> tuple[DataFrame, int]:
    """(value, code) for the distinct values of a text feature, in order, and their number.

    A table of few values is broadcast where it is joined; others are ranked in parallel and written to the shared folder.
    """
    values = df.where(q(c).isNotNull()).select(q(c).cast("string").alias("value")).distinct()
    _, rows = small_table(values, MAX_CATEGORIES)
    if rows is not None:
        codes = [(v, float(i)) for i, v in enumerate(sorted((r[0] for r in rows), key=lambda v: v.encode()))]
        return F.broadcast(local_table(df.sparkSession, codes, "value string, code double")), len(codes)
    ranked = number_rows(values, (), "value", out="_rn").select("value", (q("_rn") - 1).cast("double").alias("code"))
    table = written(ranked, "codes")
    return table, table.count()


def _with_codes(df: DataFrame, codes: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    """Text features as numbers; missing and unknown values get the number behind the last."""
    for c, (table, n) in codes.items():
        named = table.select(q("value").alias("_value"), q("code").alias("_code"))
        df = df.join(named, q(c) == q("_value"), "left").withColumn(c, F.coalesce(q("_code"), F.lit(float(n)))).drop("_value", "_code")
    return df


def _training_partitions(n: int) -> int:
    """The number of partitions for ``n`` rows: it follows from the rows alone, and a partition stays small."""
    return max(TRAINING_PARTITIONS, -(-n // TRAINING_ROWS))


def _fit(df: DataFrame, label_col: str, features: list[str] | None, fit, spread: bool = True) -> TrainedModel:
    """Prepares the features and the labels of a table, and gives them to ``fit(training, model)``, if asked with equal rows together."""
    types = dtypes(df)
    features = [c for c in (features or df.columns) if c != label_col]
    text = [c for c in features if not is_numeric(types[c])]
    labelled = df.where(q(label_col).isNotNull())
    table = label_index(labelled, label_col, "_target")
    labels = [r["_label"] for r in table.orderBy("_target").collect()]
    training = (labelled.select(*_prepared(labelled, features, text), q(label_col).cast("string").alias("_label"))
                .join(table, "_label").drop("_label").withColumn("_target", q("_target").cast("double")))
    codes = {c: _value_codes(labelled, c) for c in text}
    training = _with_codes(training, codes)
    if spread:
        columns = [q(c) for c in training.columns]
        training = training.repartition(_training_partitions(labelled.count()), F.xxhash64(*columns)).sortWithinPartitions(*columns)
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return fit(training, TrainedModel(None, features, text, labels, label_col, codes))


def _filled(model: TrainedModel, replacements: list[str]) -> list:
    """The stages that fill missing values of each feature and put all of them together."""
    names = [f"_filled{i}" for i in range(len(model.features))]
    values = [f"coalesce({quoted(c)}, {r}) AS {n}" for c, r, n in zip(model.features, replacements, names)]
    return [SQLTransformer(statement="SELECT *, " + ", ".join(values) + " FROM __THIS__"),
            VectorAssembler(inputCols=names, outputCol="_features", handleInvalid="keep")]


def train_forest(df: DataFrame, label_col: str = "label", features: list[str] | None = None, trees: int = 100, depth: int = 10,
                 seed: int = 42) -> TrainedModel:
    """Random forest. Missing numbers become a value below all others; infinities must be repaired before. Text features
    become the positions of their values, of which there may be any number."""
    def fit(training: DataFrame, model: TrainedModel) -> TrainedModel:
        spark, numeric = training.sparkSession, [c for c in model.features if c not in model.text_features]
        table = written(training.select(*[F.nanvl(q(c), F.lit(None).cast("double")).alias(c) for c in model.features], "_target"), "training")
        lows = dict(zip(numeric, _fills(table, numeric)))
        filled = table.select(*[F.coalesce(q(c), F.lit(lows.get(c, 0.0))).alias(f"_filled{i}") for i, c in enumerate(model.features)], "_target")
        grown, cuts = forest.train(filled, filled.columns[:-1], "_target", len(model.labels), trees, depth, seed)
        columns = {"featuresCol": "_features", "labelCol": "_target", "predictionCol": "_prediction", "probabilityCol": "_probability", "rawPredictionCol": "_raw"}
        stages = [*_filled(model, [f"CAST({lows.get(c, 0.0)!r} AS DOUBLE)" for c in model.features]),
                  forest.as_model(spark, grown, cuts, len(model.labels), depth, seed, columns),
                  IndexToString(inputCol="_prediction", outputCol="predicted_label", labels=model.labels)]
        model.pipeline = PipelineModel(stages)
        return model

    return _fit(df, label_col, features, fit, spread=False)


def train_boosted(df: DataFrame, label_col: str = "label", features: list[str] | None = None, rounds: int = 100, depth: int = 6,
                  step: float = 0.3) -> TrainedModel:
    """Gradient-boosted trees for any number of labels in one model (see ``boosting``). A missing value goes to the side of
    each split that suits it; infinities are values. Text features as in :func:`train_forest`."""
    def fit(training: DataFrame, model: TrainedModel) -> TrainedModel:
        model.pipeline = Pipeline(stages=_filled(model, ["CAST('NaN' AS DOUBLE)"] * len(model.features))).fit(training)
        rows = model.pipeline.transform(training).select(vector_to_array("_features").alias("values"), q("_target").cast("int").alias("target"))
        model.boosted = boosting.train(rows, len(model.labels), len(model.features), rounds, depth, step)
        return model

    return _fit(df, label_col, features, fit)


def with_boosted(model: TrainedModel, df: DataFrame) -> DataFrame:
    """The prepared rows with ``_raw``, the score of each label, ``_prediction`` and ``predicted_label``."""
    trees = model.boosted  # travels with the function, which Spark broadcasts where it is large

    @F.pandas_udf("array<double>")
    def scores(values: pd.Series) -> pd.Series:
        return pd.Series(list(trees.scores(np.stack(values.to_numpy())))) if len(values) else pd.Series([], dtype=object)

    scored = df.withColumn("_raw", scores(vector_to_array("_features")))
    best = F.array_position("_raw", F.array_max("_raw")).cast("int")
    return scored.withColumn("_prediction", (best - 1).cast("double")).withColumn("predicted_label", F.get(F.array(*[F.lit(c) for c in model.labels]), best - 1))


def train_and_hold_out(df: DataFrame, train, label_col: str = "label", key=None, ratio: float = 0.8, seed: int = 42, **options
                       ) -> tuple[TrainedModel, DataFrame]:
    """Trains on a stratified part and scores the rest: ``(model, scored test rows)``."""
    split = stratified_split(df, ratio, label_col, key, seed, out="_split")
    model = train(split.where(q("_split") == "train").drop("_split"), label_col, **options)
    return model, score_batch(model, split.where(q("_split") == "test").drop("_split"))


def save_model(model: TrainedModel, path: str) -> str:
    """Writes the pipeline and, beside it, its features and labels, the labels also as a mapping text, the codes of text
    features, and the trees of a boosted model."""
    spark = SparkSession.active()
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    for i, c in enumerate(model.text_features):
        model.codes[c][0].write.mode("overwrite").parquet(f"{path}/codes/{i}")
    if model.boosted:
        model.boosted.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
    about = [(model.label_col, model.features, model.text_features, model.labels, model.boosted is not None)]
    (local_table(spark, about, "label_col string, features array<string>, text_features array<string>, labels array<string>, boosted boolean")
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/about"))
    write_mapping(model.labels, f"{path}/mapping")
    return path


def load_model(path: str) -> TrainedModel:
    read = SparkSession.active().read
    about = read.parquet(f"{path}/about").first()
    codes = {}
    for i, c in enumerate(about["text_features"]):
        table = read.parquet(f"{path}/codes/{i}")
        small, rows = small_table(table, MAX_CATEGORIES)
        codes[c] = (small, len(rows)) if rows is not None else (table, table.count())
    boosted = boosting.Boosted.of_table(read.parquet(f"{path}/trees"), len(about["labels"])) if about["boosted"] else None
    return TrainedModel(PipelineModel.load(f"{path}/pipeline"), list(about["features"]), list(about["text_features"]),
                        list(about["labels"]), about["label_col"], codes, boosted)


def mapping_lines(labels: list[str]) -> list[str]:
    """The label mapping as text. Fixed format: a title, a rule of 40 signs, then the label padded to 30 and its index."""
    return ["Label Encoding Mapping:", "=" * 40, *[f"{c:<30}: {i}" for i, c in enumerate(labels)]]


def write_mapping(labels: list[str], path: str) -> str:
    lines = local_table(SparkSession.active(), [(line,) for line in mapping_lines(labels)], "value string")
    lines.coalesce(1).write.mode("overwrite").text(path)
    return path


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """``(label, label_index)`` from a mapping text; lines without an index are skipped."""
    parts = F.regexp_extract("value", r"^(.*?)\s*:\s*(\d+)\s*$", 1), F.regexp_extract("value", r"^(.*?)\s*:\s*(\d+)\s*$", 2)
    return (spark.read.text(path).where(q("value").rlike(r":\s*\d+\s*$"))
            .select(F.trim(parts[0]).alias("label"), parts[1].cast("int").alias("label_index")))


def feature_importance(model: TrainedModel) -> DataFrame:
    """``(feature, importance_pct)``, largest first: the forest's impurity importance, or the mean gain of boosted splits."""
    found = model.boosted.importance(len(model.features)) if model.boosted else model.classifier.featureImportances.toArray()
    rows = [(c, 100 * float(x)) for c, x in zip(model.features, found)]
    return local_table(SparkSession.active(), rows, "feature string, importance_pct double").orderBy(F.desc("importance_pct"), "feature")


def prune_features(df: DataFrame, importance: DataFrame, threshold_pct: float = 0.1) -> DataFrame:
    """Drops the features below the threshold from the original table."""
    weak = {r["feature"] for r in importance.where(q("importance_pct") < threshold_pct).collect()}
    return df.select(*[q(c) for c in df.columns if c not in weak])


def _assembled(model: TrainedModel, df: DataFrame) -> DataFrame:
    """The rows with the pipeline's columns; features the table lacks are 0, others are taken along untouched."""
    carried = {c: f"_carry{i}" for i, c in enumerate(df.columns)}
    have = set(df.columns)
    inputs = [(q(c) if c in have else F.lit(0)).cast("string" if c in model.text_features else "double").alias(c) for c in model.features]
    coded = _with_codes(df.select(*inputs, *[q(c).alias(n) for c, n in carried.items()]), model.codes)
    numbers = [F.nanvl(q(c), F.lit(None).cast("double")).alias(c) for c in model.features]
    prepared = model.pipeline.transform(coded.select(*numbers, *carried.values()))
    return with_boosted(model, prepared) if model.boosted else prepared


def score_batch(model: TrainedModel, df: DataFrame) -> DataFrame:
    """The table with ``predicted_label``; features are found by name, and the encoders are those of the training."""
    scored = _assembled(model, df)
    return scored.select(*[q(f"_carry{i}").alias(c) for i, c in enumerate(df.columns)], "predicted_label")


def map_labels(df: DataFrame, mapping: DataFrame, label_col: str = "label", out: str = "label_index") -> DataFrame:
    """Adds the index of the label by a table ``(label, label_index)``; -1 for unknown labels."""
    known = mapping.select(q("label").alias("_known"), q("label_index").alias("_index"))
    return df.join(known, q(label_col) == q("_known"), "left").withColumn(out, F.coalesce(q("_index"), F.lit(-1))).drop("_known", "_index")


def prediction_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("predicted_label").agg(F.count(F.lit(1)).alias("n"))


def evaluation_guard(df: DataFrame, labels: list[str], label_col: str = "label") -> DataFrame:
    """One row: rows, rows whose label the model does not know, and whether evaluation makes sense."""
    if label_col not in df.columns:
        return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", q("n_rows").alias("n_unknown"), F.lit(False).alias("can_evaluate"))
    unknown = ~F.coalesce(q(label_col).cast("string").isin(labels), F.lit(False))
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(unknown).alias("n_unknown"))
    return counted.withColumn("can_evaluate", q("n_unknown") == 0)


def evaluate(scored: DataFrame, labels: list[str], label_col: str = "label") -> tuple[DataFrame, DataFrame] | None:
    """``(confusion matrix, classification report)``, or None if a label is missing or unknown."""
    if not evaluation_guard(scored, labels, label_col).first()["can_evaluate"]:
        return None
    return confusion_matrix(scored, labels, label_col), classification_report(scored, labels, label_col)


def _cells(scored: DataFrame, label_col: str, prediction_col: str) -> DataFrame:
    return (scored.groupBy(q(label_col).cast("string").alias("actual"), q(prediction_col).cast("string").alias("predicted"))
            .agg(F.count(F.lit(1)).alias("n")))


def confusion_matrix(scored: DataFrame, labels: list[str], label_col: str = "label", prediction_col: str = "predicted_label") -> DataFrame:
    """One row per actual label with one column ``pred_<label>`` per label, in the given order; zeros are filled in."""
    cells = _cells(scored, label_col, prediction_col)
    wide = cells.groupBy("actual").agg(*[F.sum(F.when(q("predicted") == c, q("n")).otherwise(0)).alias(f"pred_{c}") for c in labels])
    rows = local_table(scored.sparkSession, [(i, c) for i, c in enumerate(labels)], "_i int, actual string")
    return rows.join(wide, "actual", "left").orderBy("_i").select("actual", *[F.coalesce(q(f"pred_{c}"), F.lit(0)).alias(f"pred_{c}") for c in labels])


def classification_report(scored: DataFrame, labels: list[str], label_col: str = "label", prediction_col: str = "predicted_label") -> DataFrame:
    """Precision, recall, F1 and support per label, then accuracy, macro and weighted means; 0 where nothing can be divided."""
    cells = _cells(scored, label_col, prediction_col)
    hit = F.when(q("actual") == q("predicted"), q("n")).otherwise(0)
    sides = cells.select(F.inline(F.array(F.struct(q("actual").alias("label"), q("n").alias("actual_n"), F.lit(0).cast("bigint").alias("pred_n"), hit.alias("tp")),
                                          F.struct(q("predicted").alias("label"), F.lit(0).cast("bigint").alias("actual_n"), q("n").alias("pred_n"), F.lit(0).cast("bigint").alias("tp")))))
    rows = local_table(scored.sparkSession, [(c,) for c in labels], "label string")
    zero = F.lit(0.0)
    per = rows.join(sides.groupBy("label").agg(F.sum("actual_n").alias("support"), F.sum("pred_n").alias("pred_n"), F.sum("tp").alias("tp")), "label", "left").fillna(0)
    per = (per.withColumn("precision", F.coalesce(F.try_divide("tp", "pred_n"), zero)).withColumn("recall", F.coalesce(F.try_divide("tp", "support"), zero))
           .withColumn("f1", F.coalesce(F.try_divide(2 * q("precision") * q("recall"), q("precision") + q("recall")), zero)))
    total = F.sum("support")
    mean = lambda c: F.coalesce(F.try_divide(F.sum(q(c) * q("support")), total), zero)
    accuracy = F.coalesce(F.try_divide(F.sum("tp"), total), zero)
    totals = per.agg(accuracy.alias("acc"), *[F.avg(c).alias(f"m_{c}") for c in ("precision", "recall", "f1")],
                     *[mean(c).alias(f"w_{c}") for c in ("precision", "recall", "f1")], total.alias("support"))
    line = lambda name, p, r, f: F.struct(F.lit(name).alias("label"), q(p).alias("precision"), q(r).alias("recall"), q(f).alias("f1"), q("support"))
    summary = totals.select(F.inline(F.array(line("accuracy", "acc", "acc", "acc"), line("macro avg", "m_precision", "m_recall", "m_f1"),
                                             line("weighted avg", "w_precision", "w_recall", "w_f1"))))
    return per.select("label", "precision", "recall", "f1", "support").unionByName(summary)
