import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import modeling as MD


def test_patience_stop():
    errs = [5, 4, 3, 3.5, 3.2] + [3.1] * 50
    assert MD.patience_stop(errs, od_wait=40) == 2
    assert MD.patience_stop([3, 2, 1], od_wait=40) == 2


def test_ordered_target_statistics_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(str(rng.integers(0, 3)), dt.date(2010, 1, 1) + dt.timedelta(days=int(rng.integers(0, 6))),
             int(rng.integers(1, 20))) for _ in range(60)]
    df = spark.createDataFrame(rows, "cat string, date date, qty int")
    got = {(r.cat, r.date): r.cat_te for r in MD.ordered_target_statistics(df, "cat").collect()}
    pdf = pd.DataFrame(rows, columns=["cat", "date", "qty"])
    prior = pdf.qty.mean()
    for (c, d), v in got.items():
        prev = pdf[(pdf.cat == c) & (pdf.date < d)].qty
        assert v == pytest.approx((prev.sum() + prior) / (len(prev) + 1))


def test_permute_column_keeps_values(spark):
    df = spark.range(200).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    p = MD.permute_column(df, "v", rows_per_bucket=25)
    assert sorted(r.v for r in p.collect()) == sorted(r.v for r in df.collect())
    assert p.where(F.col("v") != F.col("k") * 3).count() > 100


@pytest.fixture(scope="module")
def fitted(spark, clean_small):
    from shelfcast.plans.demand import demand_table
    from shelfcast.session import materialize
    d = materialize(demand_table(clean_small, "day"), "test-model")
    m = MD.DemandModel("t", {"loss": "RMSE", "seed": 42, "iterations": 8, "max_depth": 3,
                             "learning_rate": 0.3})
    return m.set_data(d, "2000-01-01").learn()


def test_model_beats_mean_on_train(fitted):
    train_rmse = fitted.curve[-1][1]
    std = fitted.train.agg(F.stddev_pop("qty")).first()[0]
    assert train_rmse < std


def test_model_tables(fitted):
    assert fitted.learning_curve().count() == 8
    assert 1 <= fitted.tree_count <= 8
    res = fitted.get_val_results()
    assert res.count() == fitted.val.count()
    assert set(res.columns) == {"qty", "prediction", "error", "month", "squared_error"}
    imp = fitted.feature_importance(rows_per_bucket=200)
    assert imp.count() == len(fitted.feature_plan.vector_inputs())
    dep = fitted.feature_dependence("price", points=4)
    assert dep.count() <= 4


def _sales(spark, n_codes, days=60):
    rng = np.random.default_rng(4)
    rows = [(f"c{i % n_codes}", dt.date(2010, 1, 1) + dt.timedelta(days=d), int(rng.integers(1, 9)) + i % 5, float(i % 7))
            for d in range(days) for i in range(n_codes)]
    return spark.createDataFrame(rows, "stock_code string, date date, qty int, price double")


@pytest.mark.parametrize("n_codes", [20, 40])
def test_treatment_does_not_depend_on_the_number_of_codes(spark, n_codes):
    df = _sales(spark, n_codes, 5)
    assert MD.plan_features(df).encoded == ["stock_code"] and MD.plan_features(df).indexed == []
    assert MD.plan_features(df, indexed=("stock_code",)).indexed == ["stock_code"]


def test_statistics_come_from_training_rows_only(spark):
    df = _sales(spark, 4)
    later = df.withColumn("price", F.when(F.col("date") >= "2010-02-20", -100.0).otherwise(F.col("price")))
    m = MD.DemandModel("s", {"iterations": 2, "max_depth": 2}).set_data(later, "2010-02-20")
    assert m.feature_plan.sentinels["price"] == -1.0 and "date" not in m.feature_plan.vector_inputs()


def test_scoring_raw_rows_and_unseen_codes(spark, fitted):
    raw = fitted.val.select(*[c for c in fitted.val.columns if c not in ("features", "stock_code_te", "description_te")])
    a = fitted.predict(raw).select("stock_code", "date", "price", "description", "prediction")
    b = fitted.predict(fitted.val).select("stock_code", "date", "price", "description", "prediction")
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()
    new = fitted.transform_features(raw.limit(3).withColumn("stock_code", F.lit("never seen"))).collect()
    assert [r.stock_code_te for r in new] == [pytest.approx(fitted.prior)] * 3


def test_encoding_equals_ordered_statistics(spark):
    df = _sales(spark, 6)
    m = MD.DemandModel("e", {"iterations": 2, "max_depth": 2}).set_data(df, "2010-02-15")
    use = F.col("date") < "2010-02-15"
    want = {(r.stock_code, r.date): r.stock_code_te for r in MD.ordered_target_statistics(df, "stock_code", use_rows=use).collect()}
    for r in m.train.unionByName(m.val).select("stock_code", "date", "stock_code_te").distinct().collect():
        assert r.stock_code_te == pytest.approx(want[(r.stock_code, r.date)])


def test_pool_works_alone_and_stops_early(spark, fitted):
    # patience of 2 on a shrinking validation gain: the fit keeps fewer trees than its budget
    pool = MD.DemandModel("p", {"iterations": 25, "max_depth": 5, "learning_rate": 0.9, "od_wait": 2})
    pool.set_data_pool(fitted.train, fitted.val, label="qty", date_col="date").learn()
    assert pool.tree_count == pool.best_iteration + 1 < 25 and pool.model.getNumTrees == pool.tree_count
    assert pool.score() <= 1.0 and pool.learning_curve().count() == 25


def test_patience_rule_equals_patience_stop(spark):
    from shelfcast.operators.evaluation import patience_rule
    rng = np.random.default_rng(6)
    for errs in (list(rng.random(60).round(2)), [5, 4, 3] + [3.5] * 50, [1.0], list(range(30, 0, -1))):
        df = spark.createDataFrame([(i, float(e)) for i, e in enumerate(errs)], "iter int, error double")
        rows = sorted(patience_rule(df, 5).collect())
        run = [r for r in rows if r.running]
        assert run[-1].best_step == MD.patience_stop([float(e) for e in errs], 5)
        assert [r.iter for r in run] == list(range(len(run)))


def test_training_log_files(spark, fitted):
    from shelfcast.session import scratch_dir
    d = scratch_dir(spark, "t-log")
    fitted.write_training_log(d)
    learn = spark.read.option("sep", "\t").option("header", True).csv(f"{d}/learn_error")
    assert learn.columns == ["iter", "RMSE"] and learn.count() == 8


def _pool(fitted, **params):
    m = MD.DemandModel("g", {"max_depth": 3, "learning_rate": 0.3, "seed": 42, **params})
    return m.set_data_pool(fitted.train, fitted.val, label="qty", date_col="date", weight_col=params.get("weight"))


@pytest.mark.parametrize("loss", ["RMSE", "MAE"])
def test_growth_by_patience_ends_soon_and_its_curve_is_the_models(spark, fitted, loss):
    m = _pool(fitted, iterations=60, od_wait=4, loss=loss, learning_rate=0.9).learn(grow="patience", chunk=3)
    assert m.trees_grown == len(m.curve) <= m.best_iteration + 1 + 4 + 3 < 60
    assert m.best_iteration == MD.patience_stop([c[2] for c in m.curve], 4) and m.model.getNumTrees == m.tree_count == m.best_iteration + 1
    per, fix = ("squared", math.sqrt) if loss == "RMSE" else ("absolute", float)
    every = _pool(fitted, iterations=60, od_wait=4, loss=loss, learning_rate=0.9).learn(grow="patience", chunk=3, early_stopping=False)
    for side, at in ((m.train, 1), (m.val, 2)):
        want = [fix(e) for e in every.model.evaluateEachIteration(side, per)]
        assert [c[at] for c in every.curve] == pytest.approx(want, abs=1e-9)
        assert [c[at] for c in m.curve] == pytest.approx(want, abs=1e-9)


def test_trees_grown_one_by_one_are_those_of_one_fit(spark, fitted):
    one = _pool(fitted, iterations=5).learn(early_stopping=False)
    by_one = _pool(fitted, iterations=5).learn(early_stopping=False, grow="patience", chunk=2)
    assert by_one.trees_grown == 5 and by_one.model.treeWeights == one.model.treeWeights
    assert [c[1] for c in by_one.curve] == pytest.approx([c[1] for c in one.curve], rel=1e-3)
    assert by_one.curve[0] == pytest.approx(one.curve[0], abs=1e-9)


def test_first_trees_are_the_model_of_a_shorter_fit(spark, fitted):
    whole = _pool(fitted, iterations=25, max_depth=5, learning_rate=0.9, od_wait=2).learn()
    assert whole.trees_grown == 25 and whole.tree_count < 25
    short = whole._regressor(whole.tree_count).fit(whole.train)
    a, b = (x.transform(whole.val).agg(F.sum("prediction"), F.sum(F.pow("prediction", 2))).first() for x in (whole.model, short))
    assert list(a) == pytest.approx(list(b), rel=1e-12)
    assert whole.model.featureImportances.toArray().sum() == pytest.approx(1.0)


def test_growth_with_weights_and_scratch(spark, fitted):
    from shelfcast import session
    train, val = (d.withColumn("w", (F.col("month") % 3 + 1).cast("double")) for d in (fitted.train, fitted.val))
    m = MD.DemandModel("w", {"max_depth": 2, "iterations": 4, "learning_rate": 0.5}).set_data_pool(train, val, weight_col="w")
    before = len(session._written[spark.sparkContext.applicationId])
    m.learn(grow="patience", chunk=2, early_stopping=False)
    assert len(session._written[spark.sparkContext.applicationId]) == before  # the stored columns are gone
    want = [math.sqrt(e) for e in m.model.evaluateEachIteration(m.val, "squared")]
    assert [c[2] for c in m.curve] == pytest.approx(want, abs=1e-9)
    with pytest.raises(ValueError):
        m.learn(grow="other")


def test_shap_tables(spark, fitted):
    total = F.aggregate("shap", F.lit(0.0), lambda a, v: a + v)
    values = fitted.shap_values()
    assert values.count() == fitted.val.count()
    assert values.agg(F.max(F.abs(total + F.col("shap_base") - F.col("prediction")))).first()[0] < 1e-9
    names = fitted.feature_names()
    bar = {r.feature: r.mean_abs_shap for r in fitted.shap_importance().collect()}
    want = values.select(*[F.avg(F.abs(F.col("shap")[i])).alias(f"f{i}") for i in range(len(names))]).first()
    assert bar == {n: pytest.approx(w, abs=1e-9) for n, w in zip(names, want)} and max(bar.values()) > 0
    dots = fitted.shap_summary()
    assert dots.columns == ["feature", "feature_value", "shap"] and dots.count() == values.count() * len(names)
    dep = fitted.shap_dependence("price")
    row = dep.first()
    with_price = fitted.shap_interactions("price")
    strength = with_price.select(*[F.avg(F.abs(F.col("shap")[i])).alias(n) for i, n in enumerate(names)]).first().asDict()
    del strength["price"]
    assert row.partner == max(strength, key=strength.get) and dep.count() == values.count()
    both = dep.agg(F.sum("shap"), F.sum("feature_value")).first()
    at = names.index("price")
    assert list(both) == pytest.approx(list(values.agg(F.sum(F.col("shap")[at]), F.sum("price")).first()), rel=1e-9)
    named = fitted.shap_dependence("price", "qty_lag1d").first()
    assert named.partner == "qty_lag1d"
