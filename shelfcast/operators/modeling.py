"""Demand model on ``pyspark.ml``.

The original wraps a gradient-boosted tree library with time-ordered
categorical statistics and an overfitting detector.  Here:

* categoricals: every string column -> ordered target statistics (M15),
  computed with a running window over dates, whatever its number of values;
  columns that the caller declares ``indexed`` -> ``StringIndexer``
  (categorical metadata for the trees);
* missing numeric values -> a sentinel below the column minimum (Spark trees
  do not take nulls);
* ``GBTRegressor`` with squared loss; patience-based early stopping from
  ``evaluateEachIteration`` on the validation set keeps the first trees up to the
  best count (no second fit), or growth itself ends when patience runs out: the
  same trees one by one on a stored prediction column;
* explanation: SHAP values and interactions of every row (``operators/shap.py``),
  and split-gain, permutation and partial-dependence tables.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.operators import shap
from shelfcast.operators.evaluation import time_split
from shelfcast.session import drop_scratch, materialize, scratch_dir

# The overfitting detector's patience.
OD_WAIT = 40


def ordered_target_statistics(df: DataFrame, cat_col: str, target: str = "qty", date_col: str = "date",
                              prior=None, a: float = 1.0, use_rows=None, out_col: str | None = None
                              ) -> DataFrame:
    """M15 table: per (category, date), ``(sum(y) + a * prior) / (count + a)``
    over the rows of that category with a strictly earlier date (same-day
    rows excluded), re-aimed from the published ordered target statistics.

    Pre-aggregated to one row per (category, date) before the running
    window, so a hot category's window holds one row per date, not one per
    line.  ``use_rows`` (a boolean Column) limits which rows contribute
    (e.g. training rows only); ``prior`` defaults to their mean target.
    """
    out_col = out_col or f"{cat_col}_te"
    use = use_rows if use_rows is not None else F.lit(True)
    y = F.when(use, F.col(target).cast("double"))
    if prior is None:
        prior = df.agg(F.avg(y)).scalar()
    daily = df.groupBy(cat_col, date_col).agg(F.sum(y).alias("_sy"), F.count(y).alias("_n"))
    w = Window.partitionBy(cat_col).orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1)
    return daily.select(
        cat_col, date_col,
        ((F.coalesce(F.sum("_sy").over(w), F.lit(0.0)) + F.lit(a) * prior)
         / (F.coalesce(F.sum("_n").over(w), F.lit(0)) + F.lit(a))).alias(out_col))


def ordered_target_encoding(df: DataFrame, cat_col: str, target: str = "qty", date_col: str = "date",
                            prior=None, a: float = 1.0, use_rows=None, out_col: str | None = None
                            ) -> DataFrame:
    """Join the ordered statistics back to the rows as ``<cat>_te``."""
    enc = ordered_target_statistics(df, cat_col, target, date_col, prior, a, use_rows, out_col)
    return df.join(enc, [cat_col, date_col], "left")


@dataclass
class FeaturePlan:
    """How each input column enters the feature vector."""
    numeric: list[str]
    indexed: list[str]          # declared: string columns -> StringIndexer
    encoded: list[str]          # all other string columns -> ordered target statistics
    sentinels: dict[str, float] = field(default_factory=dict)

    def vector_inputs(self) -> list[str]:
        return self.numeric + [f"{c}_idx" for c in self.indexed] + [f"{c}_te" for c in self.encoded]


def plan_features(train: DataFrame, label: str = "qty", date_col: str = "date",
                  exclude: tuple[str, ...] = (), indexed: tuple[str, ...] = ()) -> FeaturePlan:
    """M1: string columns are categorical; the caller's ``indexed`` says which get an index.

    The treatment never depends on the data's size.  Sentinels (for missing numbers)
    come from ``train``, the training rows, in one aggregate.
    """
    dtypes = dict(train.dtypes)
    cols = [c for c in train.columns if c not in (label, date_col, *exclude)]
    strings = [c for c in cols if dtypes[c] == "string"]
    numeric = [c for c in cols if c not in strings and dtypes[c] not in ("date", "timestamp")]
    row = train.agg(*[F.min(c).cast("double").alias(c) for c in numeric]).first() if numeric else None
    sentinels = {c: (row[c] - 1.0 if row[c] is not None else -1.0) for c in numeric}
    return FeaturePlan(numeric, [c for c in strings if c in indexed], [c for c in strings if c not in indexed], sentinels)


def prepare_categoricals(df: DataFrame, columns: list[str]) -> tuple[DataFrame, PipelineModel]:
    """M1: cast to string and index (unseen values -> an extra index)."""
    df = df.withColumns({c: F.col(c).cast("string") for c in columns})
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in columns]
    model = Pipeline(stages=stages).fit(df)
    return model.transform(df), model


def patience_stop(val_errors: list[float], od_wait: int = OD_WAIT) -> int:
    """M5: 0-based best iteration under the 'Iter' overfitting detector: stop
    once ``od_wait`` iterations pass without a new minimum; keep the best."""
    best, best_i = math.inf, 0
    for i, e in enumerate(val_errors):
        if e < best:
            best, best_i = e, i
        elif i - best_i >= od_wait:
            break
    return best_i


def ensemble(trees: list[DecisionTreeRegressionModel], weights: list[float], **params) -> GBTRegressionModel:
    """A boosted model of the given trees and their weights; ``params`` are its column names."""
    spark = SparkSession.active()
    jvm, new_array = spark._jvm, spark.sparkContext._gateway.new_array
    own, factors = new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees)), new_array(jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights, strict=True)):
        own[i], factors[i] = tree._java_obj, float(weight)
    uid = f"GBTRegressor_{uuid.uuid4().hex[:12]}"
    model = GBTRegressionModel._from_java(jvm.org.apache.spark.ml.regression.GBTRegressionModel(uid, own, factors, trees[0].numFeatures))
    model._set(**params)
    model._transfer_params_to_java()
    return model


class DemandModel:
    """Train/evaluate a boosted-tree demand regressor on a time split."""

    def __init__(self, name: str, params: dict):
        self.name = name
        self.params = dict(params)

    # -- data ---------------------------------------------------------------
    def set_data(self, df: DataFrame, horizon: str, label: str = "qty", date_col: str = "date",
                 weight_col: str | None = None, exclude: tuple[str, ...] = (), indexed: tuple[str, ...] = (),
                 categorical: tuple[str, ...] = ("product_type", "time_series_type")):
        """M2/M3: split by date; everything fitted is fitted on the training side only.

        ``categorical`` columns (the cluster labels, object-typed in the
        original) are cast to text so they are treated as categories.
        Weights travel with their rows (the original passed the unsplit
        weight vector to both sides)."""
        self.horizon = horizon
        self._names(label, date_col, weight_col)
        self.categorical = tuple(c for c in categorical if c in df.columns)
        train, val = time_split(self._texts(df), horizon, date_col)
        self.feature_plan = plan = plan_features(train, label, date_col, (*exclude, *([weight_col] if weight_col else [])), indexed)
        # what a category's rows sum to on each training date; encodings are running sums of it
        y = F.col(label).cast("double")
        self.prior = train.agg(F.avg(y)).first()[0]
        self.encodings = {c: materialize(train.groupBy(c, date_col).agg(F.sum(y).alias("_sy"), F.count(y).alias("_n")), f"encoding-{c}")
                          for c in plan.encoded}
        stages = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in plan.indexed]
        stages.append(VectorAssembler(inputCols=plan.vector_inputs(), outputCol="features", handleInvalid="keep"))
        self.prep = Pipeline(stages=stages).fit(self._encoded(train))
        return self.set_data_pool(self.transform_features(train), self.transform_features(val), label, date_col, weight_col)

    def _names(self, label: str, date_col: str, weight_col: str | None) -> None:
        self.label, self.date_col, self.weight_col = label, date_col, weight_col

    def _texts(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.col(c).cast("string") for c in self.categorical if c in df.columns}) if self.categorical else df

    def _encoded(self, df: DataFrame) -> DataFrame:
        """``df`` with ``<cat>_te`` and without missing numbers.

        A row's statistic is over the category's training rows of strictly earlier
        dates, so rows after training see all of them; an unseen category (or no
        earlier row) gets the prior.
        """
        for c, daily in self.encodings.items():
            asked = df.select(c, self.date_col).distinct().withColumns({"_sy": F.lit(0.0), "_n": F.lit(0).cast("long")})
            both = daily.unionByName(asked).groupBy(c, self.date_col).agg(F.sum("_sy").alias("_sy"), F.sum("_n").alias("_n"))
            w = Window.partitionBy(c).orderBy(self.date_col).rowsBetween(Window.unboundedPreceding, -1)
            value = ((F.coalesce(F.sum("_sy").over(w), F.lit(0.0)) + F.lit(self.prior))
                     / (F.coalesce(F.sum("_n").over(w), F.lit(0)) + F.lit(1.0)))
            table = both.select(F.col(c).alias("_c"), F.col(self.date_col).alias("_d"), value.alias(f"{c}_te"))
            df = df.join(table, df[c].eqNullSafe(table["_c"]) & df[self.date_col].eqNullSafe(table["_d"]), "left").drop("_c", "_d")
        return df.fillna(self.feature_plan.sentinels) if self.feature_plan.sentinels else df

    def transform_features(self, df: DataFrame) -> DataFrame:
        """M8: demand rows with the fitted encodings, sentinels and ``features``, ready to be scored."""
        return self.prep.transform(self._encoded(self._texts(df)))

    def set_data_pool(self, train: DataFrame, val: DataFrame, label: str = "qty", date_col: str = "date",
                      weight_col: str | None = None):
        """Ready training and validation sets with ``features``, label, date and weight columns.

        Works on its own, without :meth:`set_data`.  Both sets are read by the fit, by
        each iteration's evaluation, by a refit and by the result tables, so they are
        written to the shared checkpoint folder; nothing stays cached.
        """
        self._names(label, date_col, weight_col)
        self.train, self.val = materialize(train, f"{self.name}-train"), materialize(val, f"{self.name}-validation")
        return self

    # -- model --------------------------------------------------------------
    def _regressor(self, iterations: int) -> GBTRegressor:
        p = self.params
        kw = dict(featuresCol="features", labelCol=self.label, lossType=self._loss(),
                  maxIter=int(iterations), maxDepth=int(p.get("max_depth", 6)),
                  stepSize=float(p.get("learning_rate", 0.1)), seed=int(p.get("seed", 42)),
                  maxBins=int(p.get("max_bins", 32)))
        if self.weight_col:
            kw["weightCol"] = self.weight_col
        return GBTRegressor(**kw)

    def learn(self, early_stopping: bool = True, grow: str = "budget", chunk: int = 10):
        """M4/M5/M6: fit, read the per-iteration curves, stop by patience.

        ``grow="budget"`` fits the whole budget in one ``GBTRegressor`` and keeps its first trees
        up to the best count: they are the model that a shorter fit gives, so nothing is fitted twice.
        ``grow="patience"`` grows the same kind of trees in runs of ``chunk`` and ends once
        ``od_wait`` trees have brought no better validation error, so at most best + od_wait + chunk
        trees are grown whatever the budget; the curve ends with them.
        """
        if grow not in ("budget", "patience"):
            raise ValueError(f"grow is 'budget' or 'patience', not {grow!r}")
        iters, wait = int(self.params.get("iterations", 100)), int(self.params.get("od_wait", OD_WAIT))
        if grow == "patience":
            trees, weights = self._grow(iters, wait, chunk)
        else:
            model = self._regressor(iters).fit(self.train)
            # The curves (and the stopping rule) follow eval_metric: RMSE -> root of
            # the mean squared error per iteration, MAE -> mean absolute error.
            tr = model.evaluateEachIteration(self.train, self._per_iteration())
            va = model.evaluateEachIteration(self.val, self._per_iteration())
            self.curve = [(i, self._metric(a), self._metric(b)) for i, (a, b) in enumerate(zip(tr, va))]
            trees, weights = model.trees, model.treeWeights
        self.trees_grown = len(trees)
        self.best_iteration = patience_stop([c[2] for c in self.curve], wait)
        self.tree_count = self.best_iteration + 1 if early_stopping else len(trees)
        if grow == "budget" and self.tree_count == len(trees):
            self.model = model
        else:
            names = {"labelCol": self.label, "lossType": self._loss()} | ({"weightCol": self.weight_col} if self.weight_col else {})
            self.model = ensemble(trees[:self.tree_count], weights[:self.tree_count], **names)
        return self

    def _loss(self) -> str:
        return {"RMSE": "squared", "MAE": "absolute"}.get(self.params.get("loss", "RMSE"), "squared")

    def _per_iteration(self) -> str:
        return "absolute" if self.params.get("eval_metric", self.params.get("loss", "RMSE")) == "MAE" else "squared"

    def _metric(self, error: float) -> float:
        return error if self._per_iteration() == "absolute" else math.sqrt(error)

    def _grow(self, iters: int, wait: int, chunk: int) -> tuple[list[DecisionTreeRegressionModel], list[float]]:
        """Trees and weights, grown by gradient boosting until patience or the budget ends; sets ``curve``.

        As in ``GBTRegressor``, the first tree fits the label and counts in full, each later one
        fits the loss's negative gradient and counts by the learning rate.  The prediction so far is
        a column of the training and validation tables, which are written anew after each run of
        ``chunk`` trees (the write also sums the errors of its iterations) and the old ones removed.
        """
        spark, p = self.train.sparkSession, self.params
        y, step = F.col(self.label).cast("double"), float(p.get("learning_rate", 0.1))
        weight = F.col(self.weight_col) if self.weight_col else F.lit(1.0)
        gradient = {"squared": lambda f: 2.0 * (y - f), "absolute": lambda f: F.when(y < f, -1.0).otherwise(1.0)}[self._loss()]
        error = {"squared": lambda f: F.pow(y - f, 2), "absolute": lambda f: F.abs(y - f)}[self._per_iteration()]
        learner = DecisionTreeRegressor(labelCol="_target", predictionCol="_tree", maxDepth=int(p.get("max_depth", 6)),
                                        maxBins=int(p.get("max_bins", 32)), seed=int(p.get("seed", 42)))
        if self.weight_col:
            learner.setWeightCol(self.weight_col)
        keep = ["features", self.label, *([self.weight_col] if self.weight_col else [])]
        sides = {"train": self.train.select(*keep).withColumn("_f", F.lit(0.0)), "val": self.val.select(*keep).withColumn("_f", F.lit(0.0))}
        paths: dict[str, str] = {}
        trees, weights, self.curve = [], [], []
        while len(trees) < iters:
            new = []
            after = sides["train"].withColumn("_f0", F.col("_f"))
            for i in range(1, min(chunk, iters - len(trees)) + 1):
                target = gradient(F.col(f"_f{i - 1}")) if trees or new else y
                tree = learner.fit(after.withColumn("_target", target))
                weights.append(step if trees or new else 1.0)
                new.append(tree)
                after = self._add_tree(after, tree, weights[-1], i)
            n = len(new)
            errors = {}
            for side, df in sides.items():
                for i, tree in enumerate(new, 1):
                    df = self._add_tree(df if i > 1 else df.withColumn("_f0", F.col("_f")), tree, weights[len(trees) + i - 1], i)
                seen, path = Observation(), scratch_dir(spark, f"{self.name}-boost-{side}")
                sums = [F.sum(weight * error(F.col(f"_f{i}"))).alias(f"e{i}") for i in range(1, n + 1)]
                df.observe(seen, F.sum(weight).alias("w"), *sums).select(*keep, F.col(f"_f{n}").alias("_f")).write.parquet(path)
                errors[side] = [seen.get[f"e{i}"] / seen.get["w"] if seen.get["w"] else math.inf for i in range(1, n + 1)]
                sides[side] = spark.read.parquet(path)
                if side in paths:
                    drop_scratch(spark, paths[side])
                paths[side] = path
            for a, b in zip(errors["train"], errors["val"], strict=True):
                self.curve.append((len(self.curve), self._metric(a), self._metric(b)))
            trees += new
            if len(trees) - 1 - patience_stop([c[2] for c in self.curve], wait) >= wait:
                break
        for path in paths.values():
            drop_scratch(spark, path)
        return trees, weights

    @staticmethod
    def _add_tree(df: DataFrame, tree: DecisionTreeRegressionModel, weight: float, i: int) -> DataFrame:
        return tree.transform(df).withColumn(f"_f{i}", F.col(f"_f{i - 1}") + weight * F.col("_tree")).drop("_tree")

    def learning_curve(self) -> DataFrame:
        """M6: (iter, train_rmse, val_rmse), one row per boosting iteration
        (the columns hold MAE when ``eval_metric`` is MAE)."""
        spark = self.train.sparkSession
        return spark.createDataFrame(self.curve, "iter int, train_rmse double, val_rmse double")

    def write_training_log(self, directory: str) -> None:
        """M6 log files: ``learn_error`` and ``test_error`` tables (iter, RMSE),
        tab separated with a header, under ``directory`` (the original logs
        into a folder named after the model)."""
        from shelfcast.sources.files import write_table
        curve = self.learning_curve()
        for side, col in (("learn_error", "train_rmse"), ("test_error", "val_rmse")):
            write_table(curve.select("iter", F.col(col).alias("RMSE")).coalesce(1),
                        f"{directory}/{side}")

    def predict(self, df: DataFrame) -> DataFrame:
        """M8: add ``prediction`` to demand rows, raw or already with ``features``."""
        return self.model.transform(df if "features" in df.columns else self.transform_features(df))

    def score(self) -> float:
        """M7: R^2 on the validation set."""
        ev = RegressionEvaluator(labelCol=self.label, predictionCol="prediction", metricName="r2")
        return ev.evaluate(self.predict(self.val))

    def get_val_results(self) -> DataFrame:
        """M9: target, prediction, absolute error, month, squared error."""
        p = self.predict(self.val)
        err = F.abs(F.col(self.label) - F.col("prediction"))
        return p.select(F.col(self.label), "prediction", err.alias("error"),
                        F.month(self.date_col).alias("month"), F.pow(err, 2).alias("squared_error"))

    def get_monthly_rmse(self) -> DataFrame:
        """M11."""
        return self.get_val_results().groupBy("month").agg(F.sqrt(F.avg("squared_error")).alias("rmse"))

    # -- explanation --------------------------------------------------------
    def feature_names(self) -> list[str]:
        """The features in the order of the vector."""
        return self.feature_plan.vector_inputs()

    def shap_values(self, df: DataFrame | None = None) -> DataFrame:
        """Rows (the validation rows by default; raw or with ``features``) with ``prediction``,
        ``shap_base`` and ``shap``, an array in the order of :meth:`feature_names`; a row's values and
        the base sum to its prediction."""
        rows, base = shap.explain(self.model, self.predict(self.val if df is None else df), len(self.feature_names()))
        return rows.withColumn("shap_base", F.lit(base))

    def shap_summary(self, df: DataFrame | None = None) -> DataFrame:
        """M13, kind "dot": (feature, feature_value, shap), a row for each feature of each row."""
        each = F.posexplode(F.arrays_zip(vector_to_array("features").alias("feature_value"), F.col("shap")))
        names = F.array(*[F.lit(n) for n in self.feature_names()])
        return self.shap_values(df).select(each.alias("at", "pair")).select(F.get(names, F.col("at")).alias("feature"), "pair.*")

    def shap_importance(self, df: DataFrame | None = None) -> DataFrame:
        """M13, kind "bar": (feature, mean_abs_shap), the mean absolute SHAP value over the rows."""
        return self.shap_summary(df).groupBy("feature").agg(F.avg(F.abs("shap")).alias("mean_abs_shap"))

    def shap_interactions(self, feature: str, df: DataFrame | None = None) -> DataFrame:
        """Rows with ``shap``, here the interactions of ``feature`` with each feature (its main effect at
        its own place), which sum to its SHAP value."""
        names = self.feature_names()
        rows = self.val if df is None else df
        return shap.explain(self.model, self.predict(rows), len(names), interact=names.index(feature))[0]

    def shap_dependence(self, feature1: str, feature2: str | None = None, df: DataFrame | None = None) -> DataFrame:
        """(feature_value, shap, partner, partner_value, interaction), a row for each row.

        ``partner`` is ``feature2`` or, by default, the feature whose interaction with ``feature1`` is the
        strongest: the largest mean absolute value over the rows, the first of equal ones.
        """
        names = self.feature_names()
        own, x = names.index(feature1), vector_to_array("features")
        rows = materialize(self.shap_interactions(feature1, df).select(x.alias("x"), F.col("shap").alias("with")), "shap-dependence")
        if feature2 is None:
            size = rows.agg(*[F.avg(F.abs(F.get("with", F.lit(i)))).alias(str(i)) for i in range(len(names))]).first()
            feature2 = names[max((i for i in range(len(names)) if i != own), key=lambda i: (size[str(i)] or 0.0, -i))]
        other = names.index(feature2)
        return rows.select(F.get("x", F.lit(own)).alias("feature_value"), F.aggregate("with", F.lit(0.0), lambda a, v: a + v).alias("shap"),
                           F.lit(feature2).alias("partner"), F.get("x", F.lit(other)).alias("partner_value"),
                           F.get("with", F.lit(other)).alias("interaction"))

    def feature_importance(self, rows_per_bucket: int = 100_000, seed: int = 7) -> DataFrame:
        """M13 beside the SHAP tables: split-gain importance plus
        permutation importance (validation RMSE increase when one feature's
        values are shuffled between rows)."""
        names = self.feature_plan.vector_inputs()
        gain = self.model.featureImportances.toArray().tolist()
        base = self._rmse(self.val)
        rows = []
        raw_val = self.val.drop("features")
        assembler = [s for s in self.prep.stages if isinstance(s, VectorAssembler)][0]
        for name, g in zip(names, gain):
            shuffled = assembler.transform(permute_column(raw_val, name, rows_per_bucket, seed))
            rows.append((name, float(g), self._rmse(shuffled) - base))
        spark = self.val.sparkSession
        return spark.createDataFrame(rows, "feature string, gain_importance double, permutation_delta_rmse double")

    def feature_dependence(self, feature1: str, feature2: str | None = None, points: int = 10) -> DataFrame:
        """M14 beside the SHAP tables: partial dependence, the
        mean prediction over the validation rows with ``feature1`` (and
        ``feature2``) set to each grid value.  Grids are quantiles, so their
        size is the ``points`` parameter, not the data: each validation row is
        scored ``points`` (squared, for two features) times, on the map side,
        and only sums are shuffled."""
        raw_val = self.val.drop("features")
        assembler = [s for s in self.prep.stages if isinstance(s, VectorAssembler)][0]
        d = raw_val
        keys = []
        for f in [feature1] + ([feature2] if feature2 else []):
            probs = [i / (points - 1) for i in range(points)]
            grid = sorted(set(raw_val.agg(F.percentile_approx(f, probs)).first()[0]))
            d = d.withColumn(f, F.explode(F.array(*[F.lit(float(g)) for g in grid])))
            keys.append(f)
        pred = self.model.transform(assembler.transform(d))
        return pred.groupBy(*keys).agg(F.avg("prediction").alias("mean_prediction"),
                                       F.count(F.lit(1)).alias("n_rows"))

    def _rmse(self, df: DataFrame) -> float:
        ev = RegressionEvaluator(labelCol=self.label, predictionCol="prediction", metricName="rmse")
        return ev.evaluate(self.model.transform(df))


def permute_column(df: DataFrame, col: str, rows_per_bucket: int = 100_000, seed: int = 7) -> DataFrame:
    """Shuffle one column's values between rows, distributed.

    Rows go to random buckets, as many as keep about ``rows_per_bucket`` rows in each
    whatever the data's size, and inside a bucket (in random order) every row takes the
    value of the row before; the first takes the last row's, an aggregate per bucket.
    """
    n_buckets = max(1, math.ceil(df.count() / rows_per_bucket))
    d = df.withColumns({"_b": (F.rand(seed) * n_buckets).cast("int"), "_r": F.rand(seed + 1)})
    last = d.groupBy("_b").agg(F.max_by(F.struct(F.col(col).alias("v")), "_r").alias("_last"))
    before = F.lag(F.struct(F.col(col).alias("v")), 1).over(Window.partitionBy("_b").orderBy("_r"))
    shifted = d.withColumn("_before", before).join(last, "_b")
    return shifted.withColumn(col, F.coalesce("_before", "_last")["v"]).drop("_b", "_r", "_before", "_last")
