"""Product segmentation.

* by price/volume profile: Box-Cox -> standardise -> k-means, k by silhouette;
* by shape of the sales history: z-scored daily series -> bisecting k-means
  (a top-down hierarchy on the same squared-error goal as Ward linkage, which
  needs all pairwise distances on one machine).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.silhouette import euclidean_silhouettes
from shelfcast.operators.hierarchy import BLOCK, cut_merges, ward_merges
from shelfcast.session import materialize

PROFILE_COLUMNS = ("price_mode", "price_median", "price_last", "qty_avg", "qty_median")


def product_profile(demand: DataFrame) -> DataFrame:
    """K1: per stock, its price statistics and mean / median demand.

    The price statistics are constant per stock, so ``max`` picks them; the
    median keeps a value->count map per stock and merges partial maps.
    """
    return demand.groupBy("stock_code").agg(
        F.max("price_mode").alias("price_mode"), F.max("price_median").alias("price_median"),
        F.max("price_last").alias("price_last"), F.avg("qty").alias("qty_avg"),
        F.median("qty").alias("qty_median"))


def _long(profile: DataFrame, cols) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in cols])
    return profile.select("stock_code", F.explode(pairs).alias("p")).select("stock_code", "p.feature", "p.x")


def _boxcox(x, lam):
    return F.when(lam == 0, F.ln(x)).otherwise((F.pow(x, lam) - 1) / lam)


def mean_logs(profile: DataFrame, cols) -> dict[str, float]:
    """Mean logarithm of the columns that Box-Cox can be fitted to: positive, with some variance."""
    rows = _long(profile, cols).groupBy("feature").agg(F.avg(F.ln("x")).alias("m"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
    return {r["feature"]: r["m"] for r in rows if r["lo"] is not None and 0 < r["lo"] < r["hi"]}


def boxcox_llf(profile: DataFrame, cols, grids: dict[str, list[float]], logs: dict[str, float] | None = None) -> DataFrame:
    """Box-Cox log-likelihood for every lambda of each column's grid, as (feature, lmbda, llf).

    llf = (lambda - 1) * sum(ln x) - n/2 * ln(var_pop(boxcox(x, lambda))).  Values are
    divided by their geometric mean first, which moves the logarithm's sum into a
    constant and keeps powers within range for large lambdas.  All columns and
    lambdas are one aggregate; the grids are short lists, exploded next to each
    value on the map side.
    """
    logs = logs if logs is not None else mean_logs(profile, cols)
    grid = F.create_map(*[v for c in cols for v in (F.lit(c), F.array(*[F.lit(float(g)) for g in grids.get(c, [])]).cast("array<double>"))])
    mean = F.create_map(*[v for c in cols for v in (F.lit(c), F.lit(logs.get(c)).cast("double"))])
    rows = _long(profile, cols).select("feature", (F.col("x") / F.exp(mean[F.col("feature")])).alias("x"), F.explode(grid[F.col("feature")]).alias("lmbda"))
    agg = rows.groupBy("feature", "lmbda").agg(F.var_pop(_boxcox(F.col("x"), F.col("lmbda"))).alias("v"), F.count(F.lit(1)).alias("n"))
    llf = -F.col("n") / 2 * F.ln("v") - F.col("n") * mean[F.col("feature")]
    return agg.select("feature", "lmbda", llf.alias("llf"))


#: The first grid: STEPS steps of FIRST_STEP to both sides of 0; each next one takes steps twice as long.
FIRST_STEP, STEPS, REFINE = 0.05, 60, 20


def ring(k: int) -> list[float]:
    """Lambdas of ring ``k``: ring 0 is -3 .. 3, ring k goes on from the edge of ring k - 1 to twice that."""
    step, edge = FIRST_STEP * 2.0 ** max(0, k - 1), FIRST_STEP * STEPS * 2.0 ** max(0, k - 1)
    if k == 0:
        return [FIRST_STEP * i for i in range(-STEPS, STEPS + 1)]
    return [sign * (edge + step * i) for sign in (-1, 1) for i in range(1, STEPS + 1)]


def boxcox_lambdas(profile: DataFrame, cols=PROFILE_COLUMNS) -> DataFrame:
    """K2: maximum-likelihood lambda per column, as (feature, lmbda, llf).

    The likelihood has one top.  The search widens ring by ring, without bound, for
    the columns whose best lambda is the edge of what was searched; then one finer
    grid divides the steps on both sides of the best by REFINE.  The original uses
    Brent's method; lambda here is exact to a twentieth of the ring's step.  A column
    without variance or with values that aren't positive gets lambda = 1.  Each round is one aggregate for
    all columns; the driver sees one row per column and round.
    """
    best: dict[str, tuple[float, float, float]] = {}  # feature -> (llf, lambda, step)
    logs = mean_logs(profile, cols)
    open_, k = [c for c in cols if c in logs], 0
    while open_:
        grid = ring(k)
        step = FIRST_STEP * 2.0 ** max(0, k - 1)
        for r in _best(boxcox_llf(profile, open_, {c: grid for c in open_}, logs)).collect():
            if r["lmbda"] is not None and (r["feature"] not in best or r["llf"] > best[r["feature"]][0]):
                best[r["feature"]] = (r["llf"], r["lmbda"], step)
        edge = max(grid)
        open_ = [c for c in open_ if c in best and abs(best[c][1]) == edge]
        k += 1
    if best:
        grids = {c: [lam + step * i / REFINE for i in range(-REFINE, REFINE + 1)] for c, (_, lam, step) in best.items()}
        for r in _best(boxcox_llf(profile, list(best), grids, logs)).collect():
            if r["lmbda"] is not None:
                best[r["feature"]] = (r["llf"], r["lmbda"], best[r["feature"]][2])
    rows = [(c, float(best[c][1]) if c in best else 1.0, float(best[c][0]) if c in best else None) for c in cols]
    return profile.sparkSession.createDataFrame(rows, "feature string, lmbda double, llf double")


def _best(llf: DataFrame) -> DataFrame:
    good = F.col("llf").isNotNull() & ~F.isnan("llf") & (F.abs("llf") < float("inf"))
    # of equal likelihoods the lambda nearest to 0, then the larger one
    top = F.max(F.when(good, F.struct("llf", (-F.abs("lmbda")).alias("near"), "lmbda")))
    return llf.groupBy("feature").agg(top.alias("b")).select("feature", "b.lmbda", "b.llf")


def apply_boxcox(profile: DataFrame, lambdas, cols=PROFILE_COLUMNS) -> DataFrame:
    """Transform each column with its lambda.

    ``lambdas`` is either the (feature, lmbda) table, used as one scalar
    struct subquery, or a dict of at most one number per feature.
    """
    if isinstance(lambdas, dict):
        return profile.withColumns({c: _boxcox(F.col(c).cast("double"), F.lit(float(lambdas[c])))
                                    for c in cols})
    lam = lambdas.agg(F.struct(*[F.max(F.when(F.col("feature") == c, F.col("lmbda"))).alias(c)
                                  for c in cols])).scalar()
    return profile.withColumns({c: _boxcox(F.col(c).cast("double"), lam[c]) for c in cols})


def standardize(df: DataFrame, cols=PROFILE_COLUMNS) -> DataFrame:
    """K3: zero mean, unit population deviation (a zero deviation divides by 1).

    Means and deviations are taken of the distances from the column's minimum: a Box-Cox column can vary
    in its tenth digit only, and sums of the values themselves would depend on their order there.
    """
    least = df.agg(F.struct(*[F.min(c).alias(c) for c in cols])).scalar()
    above = df.withColumns({c: F.col(c) - least[c] for c in cols})
    stats = above.agg(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c)
                                 for c in cols])).scalar()
    out = {}
    for c in cols:
        s = stats[c]["s"]
        out[c] = (F.col(c) - stats[c]["m"]) / F.when(s == 0, F.lit(1.0)).otherwise(s)
    return above.withColumns(out)


def scaled_profile(demand: DataFrame, cols=PROFILE_COLUMNS,
                   materialize_as: str | None = "parquet") -> DataFrame:
    """K1 -> K2 -> K3 with a ``features`` vector column.

    The profile (one row per stock) is read by every grid pass, both scalar
    statistics and each k-means fit, so it is materialized once.
    """
    prof = materialize(product_profile(demand), "profile", materialize_as)
    # One lambda per feature: fetched once and applied as literals.
    lam = {r["feature"]: r["lmbda"] for r in boxcox_lambdas(prof, cols).collect()}
    z = materialize(standardize(apply_boxcox(prof, lam, cols), cols), "scaled", materialize_as)
    return VectorAssembler(inputCols=list(cols), outputCol="features").transform(z)


def select_k(features: DataFrame, max_clusters: int = 10, seed: int = 42,
             features_col: str = "features", parallelism: int = 8, distance: str = "squaredEuclidean") -> DataFrame:
    """K4: silhouette for k = 2..max_clusters, as a (k, silhouette) table.

    ``distance="euclidean"`` is the original's silhouette, exact and quadratic in the rows (stocks), see
    :func:`euclidean_silhouettes`; Spark's own, ``"squaredEuclidean"``, is linear, and its
    best k can differ.  The input is
    persisted once; the fits for different k are independent jobs and are
    submitted concurrently (``parallelism`` driver threads), so small inputs
    do not leave the cluster idle between short jobs.  Fewer rows than clusters are
    an error, never fewer clusters.
    """
    if max_clusters < 2:
        raise ValueError(f"a sweep needs k from 2 on; max_clusters is {max_clusters}")
    if distance not in ("squaredEuclidean", "euclidean"):
        raise ValueError(f"distance is 'squaredEuclidean' or 'euclidean', not {distance!r}")
    data = features.select(features_col).persist()
    try:
        if (n := data.limit(max_clusters).count()) < max_clusters:
            raise ValueError(f"{n} rows can't form up to {max_clusters} clusters; lower max_clusters")
        def fit(k: int):
            return KMeans(k=k, seed=seed, featuresCol=features_col, predictionCol=f"_k{k}").fit(data)

        def score(k: int) -> tuple[int, float]:
            own = ClusteringEvaluator(featuresCol=features_col, predictionCol=f"_k{k}", metricName="silhouette")
            return k, float(own.evaluate(fit(k).transform(data)))

        ks = list(range(2, max_clusters + 1))
        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(ks)))) as pool:
            if distance == "euclidean":
                labelled = data
                for model in pool.map(fit, ks):
                    labelled = model.transform(labelled)
                points = labelled.select(F.col(features_col).alias("features"), F.array(*[F.col(f"_k{k}") for k in ks]).alias("labels"))
                return materialize(euclidean_silhouettes(points, ks), "silhouettes")
            scores = list(pool.map(score, ks))
    finally:
        data.unpersist()
    return features.sparkSession.createDataFrame(scores, "k int, silhouette double")


def best_k(scores: DataFrame) -> int:
    """Arg-max of the silhouette, the smallest k on ties."""
    return scores.orderBy(F.desc("silhouette"), "k").first()["k"]


def item_clusters(demand: DataFrame, max_clusters: int = 10, seed: int = 42,
                  materialize_as: str | None = "parquet") -> DataFrame:
    """K5 labels: (stock_code, product_type)."""
    feats = scaled_profile(demand, materialize_as=materialize_as)
    feats = feats.persist()
    try:
        k = best_k(select_k(feats, max_clusters, seed))
        model = KMeans(k=k, seed=seed).fit(feats)
        labels = model.transform(feats).select("stock_code", F.col("prediction").alias("product_type"))
        return _freeze(labels)
    finally:
        feats.unpersist()


def _freeze(df: DataFrame) -> DataFrame:
    """Labels depend on a fitted model; keep them stable across re-evaluation
    by materializing them in the shared checkpoint folder."""
    return materialize(df, "labels")


def item_cluster(demand: DataFrame, max_clusters: int = 10, seed: int = 42, **kw) -> DataFrame:
    """K5: add ``product_type`` to the demand table (join on stock)."""
    labels = item_clusters(demand, max_clusters, seed, **kw)
    return demand.join(labels, "stock_code", "left")


def series_matrix(demand: DataFrame) -> DataFrame:
    """K6: the date x stock quantity matrix in sparse long form
    (stock_code, date, qty); absent cells are zero."""
    return demand.groupBy("stock_code", "date").agg(F.sum("qty").alias("qty"))


def series_stats(demand: DataFrame) -> DataFrame:
    """K7: per stock, z-score parameters of its series over *all* dates of the
    table (zero days included without being stored): sample deviation."""
    cells = series_matrix(demand)
    # One number (the pivot's date count), fetched once: as a scalar subquery
    # it would be re-evaluated for each of its four references.
    n = F.lit(float(demand.agg(F.count_distinct("date")).first()[0]))
    s = cells.groupBy("stock_code").agg(F.sum("qty").cast("double").alias("s1"),
                                        F.sum(F.pow("qty", 2)).alias("s2"))
    mean = F.col("s1") / n
    var = F.try_divide(F.col("s2") - F.col("s1") * F.col("s1") / n, n - 1)
    return s.select("stock_code", n.cast("int").alias("n_dates"), mean.alias("series_mean"),
                    F.sqrt(var).alias("series_std"))


def series_zscore(demand: DataFrame) -> DataFrame:
    """K7 table: stats plus the z value of a zero day."""
    st = series_stats(demand)
    zero = F.try_divide(-F.col("series_mean"), F.col("series_std"))
    return st.withColumn("zero_z", zero)


def series_vectors(demand: DataFrame) -> DataFrame:
    """Dense z-scored series per stock as a vector (constant series -> zeros).

    Dates are numbered by a window over the distinct dates (bounded by the
    calendar, hence also safe to broadcast); each stock collects at most one
    entry per date.
    """
    dates = demand.select("date").distinct()
    dates = dates.select("date", (F.row_number().over(Window.orderBy("date")) - 1).alias("i"))
    cells = series_matrix(demand).join(F.broadcast(dates), "date").join(series_stats(demand), "stock_code")
    flat = F.col("series_std").isNull() | (F.col("series_std") == 0)
    z = lambda q: F.when(flat, F.lit(0.0)).otherwise((q - F.col("series_mean")) / F.col("series_std"))
    seen = cells.select("stock_code", "n_dates", z(F.lit(0.0)).alias("zero"), F.struct("i", z(F.col("qty").cast("double")).alias("z")).alias("cell"))
    row = seen.groupBy("stock_code", "n_dates", "zero").agg(F.array_sort(F.collect_list("cell")).alias("cells"))
    # one pass over the sorted cells: before each, the zero days since the one before
    zeros = lambda n, zero: F.array_repeat(zero, F.greatest(n, F.lit(0)))
    padded = F.transform("cells", lambda c, k: F.concat(
        zeros(c["i"] - F.when(k == 0, F.lit(0)).otherwise(F.get(F.col("cells"), k - 1)["i"] + 1), F.col("zero")), F.array(c["z"])))
    tail = zeros(F.col("n_dates") - 1 - F.element_at("cells", -1)["i"], F.col("zero"))
    return row.select("stock_code", array_to_vector(F.concat(F.flatten(padded), tail)).alias("features"))


def _narrow(demand: DataFrame, materialize_as: str | None) -> DataFrame:
    """The (stock, date, qty) input of the series operators; they read it four times (cells, dates, statistics, date count)."""
    return materialize(demand.select("stock_code", "date", "qty"), "series", materialize_as)


def series_merges(demand: DataFrame, block: int = BLOCK, materialize_as: str | None = "parquet") -> DataFrame:
    """K8 hierarchy: the Ward merges (a, b, height, size) of the z-scored series, see :func:`ward_merges`.

    Exact, so quadratic in the number of stocks (not in the lines).
    """
    return ward_merges(series_vectors(_narrow(demand, materialize_as)), block)


def series_clusters(demand: DataFrame, max_cluster: int = 3, seed: int = 42,
                    materialize_as: str | None = "parquet", method: str = "bisecting") -> DataFrame:
    """K8 labels: (stock_code, time_series_type), 0-based.

    ``method="ward"`` cuts the exact Ward hierarchy, as the original does; ``"bisecting"`` splits top-down
    on the same squared-error goal, in time linear in the stocks.
    """
    if method not in ("bisecting", "ward"):
        raise ValueError(f"method is 'bisecting' or 'ward', not {method!r}")
    narrow = _narrow(demand, materialize_as)
    if method == "ward":
        labels = cut_merges(ward_merges(series_vectors(narrow)), narrow, max_cluster)
        return _freeze(labels.withColumnRenamed("cluster", "time_series_type"))
    vec = series_vectors(narrow).persist()
    try:
        k = max(1, min(max_cluster, vec.limit(max_cluster).count()))  # at most max_cluster, as in the original
        model = BisectingKMeans(k=k, seed=seed).fit(vec)
        labels = model.transform(vec).select("stock_code",
                                             F.col("prediction").alias("time_series_type"))
        return _freeze(labels)
    finally:
        vec.unpersist()


def series_cluster(demand: DataFrame, max_cluster: int = 3, seed: int = 42, method: str = "bisecting") -> DataFrame:
    """K8: add ``time_series_type`` to the demand table."""
    return demand.join(series_clusters(demand, max_cluster, seed, method=method), "stock_code", "left")
