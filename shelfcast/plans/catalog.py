"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables through the retail view and runs over
all of their rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.operators import accuracy as A
from shelfcast.operators import cleaning as C
from shelfcast.operators import clustering as K
from shelfcast.operators import evaluation as EV
from shelfcast.operators import features as FT
from shelfcast.operators import matching as M
from shelfcast.operators import modeling as MD
from shelfcast.plans.cleaning import RULES, clean_stage_frames, cleaning_audit
from shelfcast.plans.demand import demand_table, prepare_demand
from shelfcast.session import materialize, scratch_dir
from shelfcast.sources.files import (RAW_SCHEMA, read_scored, read_text_table, read_transactions, union_parts,
                                     write_table)
from shelfcast.sources.retail_view import retail_transactions
from shelfcast.streaming import run_item_accuracy

LINE_COLS = ["invoice_id", "stock_code", "description", "qty", "invoice_timestamp", "unit_price",
             "customer_id", "country", "invoice_date"]
CLEAN_COLS = list(C.CLEAN_COLUMNS)
ORDER = "row_order"


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retail view under the raw file's column names, timestamps as text."""
    v = retail_transactions(spark, sf_dir)
    inv = {v_: k for k, v_ in C.RAW_TO_WORKING.items()}
    cols = [F.col(c).alias(inv[c]) for c in ["invoice_id", "stock_code", "description", "qty"]]
    cols += [F.date_format("invoice_timestamp", "yyyy-MM-dd HH:mm:ss").alias("InvoiceDate"),
             F.col("unit_price").alias("Price"), F.col("customer_id").alias("Customer ID"),
             F.col("country").alias("Country"), F.col(ORDER)]
    return v.select(*cols)


def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines, written once: netting reads them three times, and the view is a join of five tables."""
    return materialize(raw_lines(spark, sf_dir), "raw-lines")


def stage(spark: SparkSession, sf_dir: str, rule: str) -> DataFrame:
    """The lines after ``rule``; later rules are neither planned nor run."""
    many = RULES.index(rule) >= RULES.index("net_cancellations")
    return clean_stage_frames((landed_lines if many else raw_lines)(spark, sf_dir), ORDER, until=rule)[-1][1]


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, sf_dir, "finalize_columns")


def _stage(name: str, cols: list[str]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        return stage(spark, sf_dir, name).select(*cols)
    run.__name__ = name
    return run


def q_cancellation_pairs(spark, sf_dir):
    lines = clean_stage_frames(landed_lines(spark, sf_dir), ORDER, until="drop_adjustments")[-1][1]
    return M.cancellation_pairs(lines, ORDER, cut="parquet")


def q_odd_code_fragments(spark, sf_dir):
    return M.odd_code_fragments(stage(spark, sf_dir, "drop_cancelled"))


def q_inconsistent_descriptions(spark, sf_dir):
    return C.inconsistent_descriptions(stage(spark, sf_dir, "upper_code"))


def q_description_modes(spark, sf_dir):
    return C.description_modes(stage(spark, sf_dir, "upper_code"))


def q_cleaning_audit(spark, sf_dir):
    return cleaning_audit(landed_lines(spark, sf_dir), ORDER).select(
        F.col("step").cast("int").alias("step"), "rule", "rows_out")


def _lines(spark, sf_dir):
    return FT.feature_lines(clean(spark, sf_dir), ORDER)


def q_reorder_columns(spark, sf_dir):
    return FT.reorder_columns(clean(spark, sf_dir)).drop(ORDER)


def q_date_parts(spark, sf_dir):
    return FT.add_date_parts(clean(spark, sf_dir)).select(
        "stock_code", "date", "day", "day_of_week", "day_of_year", "week", "month", "year")


def q_price_stats(spark, sf_dir):
    return FT.price_stats(clean(spark, sf_dir), ORDER)


def q_description_len(spark, sf_dir):
    return FT.add_description_len(clean(spark, sf_dir)).select("stock_code", "description", "description_len")


def q_monthly_invoices(spark, sf_dir):
    return FT.monthly_invoices(FT.add_date_parts(clean(spark, sf_dir)))


def q_monthly_invoices_by_stock(spark, sf_dir):
    return FT.monthly_invoices_by_stock(FT.add_date_parts(clean(spark, sf_dir)))


def q_invoice_lag_month(spark, sf_dir):
    return FT.invoice_lag_month(FT.add_date_parts(clean(spark, sf_dir)))


def q_invoice_lag_month_stock(spark, sf_dir):
    return FT.invoice_lag_month_stock(FT.add_date_parts(clean(spark, sf_dir)))


def q_demand_daily(spark, sf_dir):
    return demand_table(clean(spark, sf_dir), "day", ORDER)


def q_demand_weekly(spark, sf_dir):
    return demand_table(clean(spark, sf_dir), "week", ORDER)


def q_demand_daily_keep_null_lags(spark, sf_dir):
    return demand_table(clean(spark, sf_dir), "day", ORDER, keep_null_lags=True)


def q_qty_lags_group_key(spark, sf_dir):
    return demand_table(clean(spark, sf_dir), "day", ORDER, lag_order="group_key")


STAGE_COLUMNS = {
    "parse_dates": LINE_COLS,
    "normalize_text": LINE_COLS,
    "deduplicate": LINE_COLS,
    "flag_cancelled": LINE_COLS + ["is_cancelled"],
    "drop_adjustments": LINE_COLS + ["is_cancelled"],
    "net_cancellations": LINE_COLS + ["is_cancelled"],
    "drop_cancelled": LINE_COLS,
    "drop_odd_codes": LINE_COLS,
    "upper_code": LINE_COLS,
    "canonical_description": LINE_COLS,
    "valid_description": LINE_COLS,
    "positive_qty": LINE_COLS,
    "drop_multipacks": LINE_COLS,
    "trim_qty": LINE_COLS,
    "positive_price": LINE_COLS,
    "trim_price": LINE_COLS,
}


def cleaning_feature_queries() -> dict[str, Callable]:
    q: dict[str, Callable] = {k: _stage(k, cols) for k, cols in STAGE_COLUMNS.items()}
    q["clean_transactions"] = _stage("finalize_columns", CLEAN_COLS)
    q.update({
        "cancellation_pairs": q_cancellation_pairs,
        "odd_code_fragments": q_odd_code_fragments,
        "inconsistent_descriptions": q_inconsistent_descriptions,
        "description_modes": q_description_modes,
        "cleaning_audit": q_cleaning_audit,
        "reorder_columns": q_reorder_columns,
        "date_parts": q_date_parts,
        "price_stats": q_price_stats,
        "description_len": q_description_len,
        "monthly_invoices": q_monthly_invoices,
        "monthly_invoices_by_stock": q_monthly_invoices_by_stock,
        "invoice_lag_month": q_invoice_lag_month,
        "invoice_lag_month_stock": q_invoice_lag_month_stock,
        "demand_daily": q_demand_daily,
        "demand_weekly": q_demand_weekly,
        "demand_daily_keep_null_lags": q_demand_daily_keep_null_lags,
        "qty_lags_group_key": q_qty_lags_group_key,
    })
    return q


# ---------------------------------------------------------------- accuracy

# Fixed parameter of the registered evaluation queries: first validation day.
HORIZON = "2000-01-01"


def rounded(df: DataFrame, cols: list[str], places: int = 6) -> DataFrame:
    """Round aggregated doubles so both engines hash the same text."""
    return df.withColumns({c: F.round(c, places) for c in cols})


def scored(spark, sf_dir):
    return A.naive_forecast(q_demand_daily(spark, sf_dir), HORIZON)


def q_scored_predictions(spark, sf_dir):
    return scored(spark, sf_dir)


def q_item_bias(spark, sf_dir):
    return rounded(A.item_bias(scored(spark, sf_dir)), ["bias"])


def q_item_rmse(spark, sf_dir):
    return rounded(A.item_rmse(scored(spark, sf_dir)), ["rmse"])


def q_item_accuracy(spark, sf_dir):
    return rounded(A.item_accuracy(scored(spark, sf_dir)), ["bias", "rmse"])


def q_item_lookup(spark, sf_dir):
    s = scored(spark, sf_dir)
    first_item = s.agg(F.min("stock_code")).scalar()
    return rounded(A.item_lookup(A.item_accuracy(s), first_item), ["bias", "rmse"])


def q_time_split(spark, sf_dir):
    return EV.split_summary(q_demand_daily(spark, sf_dir), HORIZON)


def _results(spark, sf_dir):
    return EV.validation_results(scored(spark, sf_dir))


def q_validation_results(spark, sf_dir):
    return _results(spark, sf_dir)


def q_median_abs_error(spark, sf_dir):
    return EV.median_abs_error(_results(spark, sf_dir))


def q_monthly_rmse(spark, sf_dir):
    return rounded(EV.monthly_rmse(_results(spark, sf_dir)), ["rmse"])


def q_error_histogram(spark, sf_dir):
    return rounded(EV.error_histogram(_results(spark, sf_dir)), ["lower", "upper"])


def q_score_r2(spark, sf_dir):
    return rounded(EV.r2_score(scored(spark, sf_dir)), ["r2"])


def q_read_scored(spark, sf_dir):
    """S4 round trip: write the scored table as ';' text, read it back typed."""
    path = scratch_dir(spark, "scored")
    s = scored(spark, sf_dir).withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    write_table(s, path, sep=";")
    return read_scored(spark, path).withColumn("date", F.to_date("date"))


def accuracy_queries() -> dict[str, Callable]:
    return {
        "scored_predictions": q_scored_predictions,
        "item_bias": q_item_bias,
        "item_rmse": q_item_rmse,
        "item_accuracy": q_item_accuracy,
        "item_lookup": q_item_lookup,
        "time_split": q_time_split,
        "validation_results": q_validation_results,
        "median_abs_error": q_median_abs_error,
        "monthly_rmse": q_monthly_rmse,
        "error_histogram": q_error_histogram,
        "score_r2": q_score_r2,
        "read_scored": q_read_scored,
    }



# -------------------------------------------------------------- clustering

PROFILE = list(K.PROFILE_COLUMNS)


def q_product_profile(spark, sf_dir):
    return rounded(K.product_profile(q_demand_daily(spark, sf_dir)), ["qty_avg"])


def _profile(spark, sf_dir):
    return materialize(K.product_profile(q_demand_daily(spark, sf_dir)), "profile")


def q_boxcox(spark, sf_dir):
    return rounded(K.boxcox_lambdas(_profile(spark, sf_dir)), ["lmbda", "llf"], 4)


def q_standardize(spark, sf_dir):
    prof = _profile(spark, sf_dir)
    lam = K.boxcox_lambdas(prof)
    z = K.standardize(K.apply_boxcox(prof, lam))
    return rounded(z.select("stock_code", *PROFILE), PROFILE, 4)


def q_series_matrix(spark, sf_dir):
    return K.series_matrix(q_demand_daily(spark, sf_dir))


def q_series_zscore(spark, sf_dir):
    return rounded(K.series_zscore(q_demand_daily(spark, sf_dir)),
                   ["series_mean", "series_std", "zero_z"])


def _labelled(df: DataFrame, label: str, n: int):
    """Whether the label is one of ``n`` and the same on all rows of its stock."""
    w = Window.partitionBy("stock_code")
    one = F.min(label).over(w) == F.max(label).over(w)
    return F.coalesce(F.col(label).between(0, n - 1) & one, F.lit(False))


def q_select_k(spark, sf_dir):
    """K4: the tried k with the silhouette's validity (its value depends on the fitted model)."""
    scores = K.select_k(K.scaled_profile(q_demand_daily(spark, sf_dir)), max_clusters=10)
    return scores.select("k", F.col("silhouette").between(-1, 1).alias("valid"))


def q_item_cluster(spark, sf_dir):
    """K5/K9: every stock with whether it has one label in range."""
    labels = K.item_clusters(q_demand_daily(spark, sf_dir), max_clusters=10)
    return labels.select("stock_code", _labelled(labels, "product_type", 10).alias("valid"))


def q_series_cluster(spark, sf_dir):
    labels = K.series_clusters(q_demand_daily(spark, sf_dir), max_cluster=3)
    return labels.select("stock_code", _labelled(labels, "time_series_type", 3).alias("valid"))


def _checked_demand(spark, sf_dir, level):
    """The model table with its labels replaced by their validity."""
    d = prepare_demand(clean(spark, sf_dir), level, ORDER)
    return d.withColumns({"product_type": _labelled(d, "product_type", 10), "time_series_type": _labelled(d, "time_series_type", 3)})


def q_prepare_demand(spark, sf_dir):
    return _checked_demand(spark, sf_dir, "day")


def q_prepare_demand_weekly(spark, sf_dir):
    return _checked_demand(spark, sf_dir, "week")


def q_series_merges(spark, sf_dir):
    """K8 hierarchy: the Ward merges of the stocks' series."""
    return rounded(K.series_merges(q_demand_daily(spark, sf_dir)), ["height"])


def q_series_merge_totals(spark, sf_dir):
    """K8 hierarchy: half the squared heights sum to the squared deviations of all series from their mean.

    Given per series and degree of freedom, so that it is of the size of one.
    """
    demand = materialize(q_demand_daily(spark, sf_dir), "demand")
    freedom = F.lit(float(demand.agg(F.count_distinct("date")).first()[0] - 1))
    total = F.sum(F.pow("height", 2)) / 2 / ((F.count("*") + 1) * freedom)
    return K.series_merges(demand).agg(F.count("*").alias("n_merges"), F.max("size").alias("n_series"), F.round(total, 6).alias("spread"))


def q_series_cluster_ward(spark, sf_dir):
    """K8: the stocks with whether the cut Ward hierarchy gives each one of at most three groups."""
    labels = K.series_clusters(q_demand_daily(spark, sf_dir), 3, method="ward")
    return labels.select("stock_code", F.col("time_series_type").between(0, 2).alias("valid"))


def q_select_k_euclidean(spark, sf_dir):
    """K4 by the original's distance: the numbers of clusters with whether their silhouette is one."""
    feats = K.scaled_profile(q_demand_daily(spark, sf_dir))
    return K.select_k(feats, 10, distance="euclidean").select("k", F.col("silhouette").between(-1, 1).alias("valid"))


def cluster_queries() -> dict[str, Callable]:
    return {
        "product_profile": q_product_profile,
        "boxcox": q_boxcox,
        "standardize": q_standardize,
        "series_matrix": q_series_matrix,
        "series_zscore": q_series_zscore,
        "select_k": q_select_k,
        "select_k_euclidean": q_select_k_euclidean,
        "item_cluster": q_item_cluster,
        "series_cluster": q_series_cluster,
        "series_merges": q_series_merges,
        "series_merge_totals": q_series_merge_totals,
        "series_cluster_ward": q_series_cluster_ward,
        "prepare_demand": q_prepare_demand,
        "prepare_demand_weekly": q_prepare_demand_weekly,
    }



# ------------------------------------------------------------------- model

# Fixed parameters of the registered model queries: a budget beyond the detector's
# patience of 40 iterations, so that it can stop.
MODEL_PARAMS = {"loss": "RMSE", "seed": 42, "iterations": 60, "max_depth": 4,
                "eval_metric": "RMSE", "learning_rate": 0.3}

_models: dict[tuple, MD.DemandModel] = {}


def _demand_frozen(spark, sf_dir):
    return materialize(q_demand_daily(spark, sf_dir), "demand")


def _fitted(spark, sf_dir, weight: bool = False) -> MD.DemandModel:
    """The fitted model of a folder, fitted once per application and shared by the model queries."""
    key = (spark.sparkContext.applicationId, sf_dir, weight)
    if key not in _models:
        d = _demand_frozen(spark, sf_dir)
        if weight:
            d = d.withColumn("weight", (F.col("peak_season") + 1).cast("double"))
        m = MD.DemandModel("demand", MODEL_PARAMS)
        m.demand = d
        m.set_data(d, HORIZON, weight_col="weight" if weight else None)
        _models[key] = m.learn()
    return _models[key]


def _finite(c: str):
    return F.coalesce(F.abs(F.col(c)) < float("inf"), F.lit(False))


def _curve(m: MD.DemandModel) -> DataFrame:
    """Iterations with whether the training error did not rise."""
    before = F.lag("train_rmse").over(Window.orderBy("iter"))  # one row per iteration
    falls = F.coalesce(F.col("train_rmse") <= before + 1e-9, F.lit(True)) & _finite("val_rmse")
    return m.learning_curve().select("iter", falls.alias("valid"))


def q_ordered_target_encoding(spark, sf_dir):
    d = q_demand_daily(spark, sf_dir)
    return rounded(MD.ordered_target_statistics(d, "stock_code"), ["stock_code_te"])


def q_prepare_categoricals(spark, sf_dir):
    """M1: the country column indexed by frequency, then name."""
    out, _ = MD.prepare_categoricals(clean(spark, sf_dir).select("country"), ["country"])
    return out


def _beats_mean(m: MD.DemandModel):
    """Whether the kept trees' training RMSE is no worse than that of predicting the mean."""
    spread = m.train.agg(F.stddev_pop(m.label)).first()[0]
    return F.lit(m.curve[m.best_iteration][1] <= spread + 1e-9)


def q_fit_demand_model(spark, sf_dir):
    """M4/M9: the validation rows with whether prediction and errors are finite and the fit beats the mean."""
    m = _fitted(spark, sf_dir)
    res = m.get_val_results()
    return res.select("qty", "month", (_finite("prediction") & _finite("squared_error") & _beats_mean(m)).alias("valid"))


def q_early_stopping(spark, sf_dir):
    """M5: whether the kept tree count is the best iteration's, within the budget, and is what the model has."""
    m = _fitted(spark, sf_dir)
    best = min(m.curve[:m.best_iteration + MD.OD_WAIT], key=lambda c: c[2])[0]
    kept = m.tree_count == m.model.getNumTrees == best + 1 <= MODEL_PARAMS["iterations"]
    return spark.createDataFrame([(m.best_iteration == best and kept,)], "valid boolean")


def q_patience_growth(spark, sf_dir):
    """M5: growth that ends by patience: no more trees than best + patience + one run, and a curve that is the model's."""
    m = _fitted(spark, sf_dir)
    g = MD.DemandModel("growth", {**MODEL_PARAMS, "iterations": 40, "od_wait": 6})
    g.set_data_pool(m.train, m.val, label="qty", date_col="date").learn(grow="patience", chunk=5)
    few = g.trees_grown <= min(40, g.best_iteration + 1 + 6 + 5) and g.model.getNumTrees == g.best_iteration + 1
    own = [e ** 0.5 for e in g.model.evaluateEachIteration(g.val, "squared")]
    same = max(abs(a - c[2]) for a, c in zip(own, g.curve)) <= 1e-9
    return spark.createDataFrame([(few and same,)], "valid boolean")


def q_shap_values(spark, sf_dir):
    """The validation rows with whether their SHAP values and the base sum to the prediction."""
    total = F.aggregate("shap", F.col("shap_base"), lambda a, v: a + v)
    off = F.abs(total - F.col("prediction")) <= 1e-9 * F.greatest(F.lit(1.0), F.abs("prediction"))
    return _fitted(spark, sf_dir).shap_values().select("stock_code", "date", "price", "description", F.coalesce(off, F.lit(False)).alias("valid"))


def q_shap_importance(spark, sf_dir):
    """The features with whether their mean absolute SHAP value is finite and 0 just where no split uses the feature."""
    m = _fitted(spark, sf_dir)
    used = spark.createDataFrame([(n, bool(g > 0)) for n, g in zip(m.feature_names(), m.model.featureImportances.toArray())], "feature string, used boolean")
    right = _finite("mean_abs_shap") & ((F.col("mean_abs_shap") > 0) == F.col("used"))
    return m.shap_importance().join(F.broadcast(used), "feature").select("feature", right.alias("valid"))


def q_shap_dependence(spark, sf_dir):
    """Price against its SHAP value and the strongest partner's interaction, a row for each validation row."""
    dep = _fitted(spark, sf_dir).shap_dependence("price")
    right = _finite("shap") & _finite("interaction") & _finite("partner_value") & (F.col("partner") != "price")
    return dep.select(F.col("feature_value").alias("price"), right.alias("valid"))


def q_patience_rule(spark, sf_dir):
    """M5: the overfitting detector over an error curve, the RMSE of each date of the scored forecast."""
    daily = scored(spark, sf_dir).groupBy("date").agg(F.sqrt(F.avg(F.pow(F.col("predictions") - F.col("qty"), 2))).alias("error"))
    curve = daily.select((F.row_number().over(Window.orderBy("date")) - 1).alias("iter"), F.round("error", 6).alias("error"))
    return EV.patience_rule(curve, MD.OD_WAIT)


def q_learning_curve(spark, sf_dir):
    return _curve(_fitted(spark, sf_dir))


def q_predict(spark, sf_dir):
    """M8: raw demand rows on and after the horizon, scored through the public method."""
    m = _fitted(spark, sf_dir)
    rows = m.demand.where(F.col("date") >= F.lit(HORIZON).cast("date"))
    return m.predict(rows).select("stock_code", "date", "price", "description", _finite("prediction").alias("valid"))


def q_model_score(spark, sf_dir):
    """M7: whether the score is one less the residual over the total sum of squares."""
    m = _fitted(spark, sf_dir)
    own = F.lit(1.0) - F.sum(F.pow(F.col("qty") - F.col("prediction"), 2)) / (F.var_pop("qty") * F.count("qty"))
    return m.get_val_results().agg((F.abs(own - F.lit(float(m.score()))) <= 1e-9).alias("valid"))


def q_model_monthly_rmse(spark, sf_dir):
    return _fitted(spark, sf_dir).get_monthly_rmse().select("month", (F.col("rmse") >= 0).alias("valid"))


def q_sample_weight(spark, sf_dir):
    m = _fitted(spark, sf_dir, weight=True)
    return m.predict(m.val).select("stock_code", "date", "weight", _finite("prediction").alias("valid"))


def q_set_data_pool(spark, sf_dir):
    """Ready sets given to a new model by its public methods alone."""
    m = _fitted(spark, sf_dir)
    pool = MD.DemandModel("pool", {**MODEL_PARAMS, "iterations": 10})
    return _curve(pool.set_data_pool(m.train, m.val, label="qty", date_col="date").learn())


def q_feature_importance(spark, sf_dir):
    """The features with whether both importances are finite."""
    imp = _fitted(spark, sf_dir).feature_importance()
    return imp.select("feature", (_finite("gain_importance") & _finite("permutation_delta_rmse")).alias("valid"))


def q_feature_dependence(spark, sf_dir):
    """The rows scored for each grid cell, over all cells."""
    dep = _fitted(spark, sf_dir).feature_dependence("price", "qty_lag1d", points=5)
    return dep.groupBy("n_rows").agg(F.every(_finite("mean_prediction")).alias("valid"))


def model_queries() -> dict[str, Callable]:
    return {
        "ordered_target_encoding": q_ordered_target_encoding,
        "prepare_categoricals": q_prepare_categoricals,
        "fit_demand_model": q_fit_demand_model,
        "early_stopping": q_early_stopping,
        "patience_growth": q_patience_growth,
        "patience_rule": q_patience_rule,
        "learning_curve": q_learning_curve,
        "predict": q_predict,
        "model_score": q_model_score,
        "model_monthly_rmse": q_model_monthly_rmse,
        "sample_weight": q_sample_weight,
        "set_data_pool": q_set_data_pool,
        "feature_importance": q_feature_importance,
        "feature_dependence": q_feature_dependence,
        "shap_values": q_shap_values,
        "shap_importance": q_shap_importance,
        "shap_dependence": q_shap_dependence,
    }



# ------------------------------------------------------ sources and stream

RAW_NAMES = [f.name for f in RAW_SCHEMA.fields]


def _awkward(df: DataFrame, column: str, qty: str) -> DataFrame:
    """Quotes, a tab, a semicolon and blanks in the text of every seventh quantity."""
    text = F.concat(F.col(column), F.lit(' 12" "RULER"\t; '))
    return df.withColumn(column, F.when(F.col(qty) % 7 == 0, text).otherwise(F.col(column)))


def q_read_transactions(spark, sf_dir):
    """S1 round trip: the raw view as an ISO-8859-1 TSV, read back typed."""
    path = scratch_dir(spark, "raw-tsv")
    write_table(_awkward(raw_lines(spark, sf_dir).select(*RAW_NAMES), "Description", "Quantity"), path, encoding="ISO-8859-1")
    return read_transactions(spark, path).select(*RAW_NAMES)


def q_union_parts(spark, sf_dir):
    """Two text parts (the second without Country), stacked by name."""
    raw = _awkward(raw_lines(spark, sf_dir).select(*RAW_NAMES), "Description", "Quantity")
    year = F.substring("InvoiceDate", 1, 4).cast("int")
    p1, p2 = scratch_dir(spark, "part1"), scratch_dir(spark, "part2")
    write_table(raw.where(year < 1998), p1, sep=",")
    write_table(raw.where(year >= 1998).drop("Country"), p2, sep=",")
    u = union_parts(spark, [p1, p2], sep=",", order_col=None)
    return u.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields])


def q_write_table(spark, sf_dir):
    """S3 round trip of the clean lines."""
    path = scratch_dir(spark, "clean-tsv")
    write_table(_awkward(clean(spark, sf_dir).select(*CLEAN_COLS), "description", "qty"), path)
    schema = ("invoice_id string, stock_code string, description string, qty int, price double, "
              "customer_id string, country string, date date")
    return read_text_table(spark, path, schema=schema)


def q_item_accuracy_stream(spark, sf_dir):
    """The accuracy table over scored files ingested by a stream."""
    src, ledger = scratch_dir(spark, "scored-stream"), scratch_dir(spark, "scored-ledger")
    s = scored(spark, sf_dir).withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    write_table(s, src, sep=";")
    return rounded(run_item_accuracy(spark, src, ledger), ["bias", "rmse"])


def source_queries() -> dict[str, Callable]:
    return {
        "read_transactions": q_read_transactions,
        "union_parts": q_union_parts,
        "write_table": q_write_table,
        "item_accuracy_stream": q_item_accuracy_stream,
    }



# ------------------------------------------------- single-rule entry points
def q_rename_columns(spark, sf_dir):
    """Raw header names -> working names (timestamps still text)."""
    return C.rename_columns(raw_lines(spark, sf_dir)).drop(ORDER)


def q_peak_season(spark, sf_dir):
    """F10 on the demand table."""
    return q_demand_daily(spark, sf_dir).select("stock_code", "date", "month", "peak_season")


def q_qty_lags(spark, sf_dir):
    """F11 (chronological order) on the demand table."""
    return q_demand_daily(spark, sf_dir).select(
        "stock_code", "description", "price", "date", "month", "year", "qty",
        *[f"qty_lag{n}d" for n in FT.QTY_LAGS])


def q_bias_message(spark, sf_dir):
    """A3: the message per item from the sign of its bias."""
    return A.item_accuracy(scored(spark, sf_dir)).select("item", "message")


def q_clean_transactions_landed(spark, sf_dir):
    """Clean lines via the landing step (long order key): same rows as
    ``clean_transactions``, hash aggregates downstream."""
    from shelfcast.plans.cleaning import clean_transactions
    from shelfcast.sources.files import land_transactions
    landed = land_transactions(raw_lines(spark, sf_dir), ORDER)
    return clean_transactions(landed, ORDER).select(*CLEAN_COLS)


def single_rule_queries() -> dict[str, Callable]:
    return {"rename_columns": q_rename_columns, "peak_season": q_peak_season,
            "qty_lags": q_qty_lags, "bias_message": q_bias_message,
            "clean_transactions_landed": q_clean_transactions_landed}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query, by key."""
    q: dict[str, Callable] = {}
    for group in (cleaning_feature_queries, single_rule_queries, accuracy_queries, cluster_queries,
                  model_queries, source_queries):
        q.update(group())
    return q
