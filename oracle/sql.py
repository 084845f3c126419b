"""Oracle SQL text, one statement per registered key.

Written independently of the Spark operators, closer to the original's
wording: the netting is an explicit join of cancelled to sold lines with
``min(row_id)``, modes are ``row_number`` over counts, fragments are tested
with ``starts_with`` per pair.  The retail view enters as a CTE because the
driver registers only the base tables.
"""

from __future__ import annotations

from shelfcast.sources.retail_view import retail_view_sql

RAW_COLS = "invoice_id, stock_code, description, qty, invoice_timestamp, unit_price, customer_id, country"
LINE_COLS = RAW_COLS + ", invoice_date"
CLEAN_COLS = "invoice_id, stock_code, description, qty, price, customer_id, country, date"

CLEAN_CTES = f"""
retail_tx AS ({retail_view_sql('duckdb')}),
parsed AS (
  SELECT row_id, invoice_id, stock_code, description, qty, invoice_timestamp, unit_price, customer_id, country,
         CAST(invoice_timestamp AS DATE) AS invoice_date
  FROM retail_tx),
normalized AS (
  SELECT * REPLACE (regexp_replace(lower(description), '^\\s+|\\s+$', '', 'g') AS description) FROM parsed),
deduplicated AS (
  SELECT min(row_id) AS row_id, {LINE_COLS} FROM normalized GROUP BY ALL),
flagged AS (
  SELECT *, coalesce(starts_with(invoice_id, 'C'), true) AS is_cancelled FROM deduplicated),
adjusted AS (
  SELECT * FROM flagged
  WHERE invoice_id IS NULL OR invoice_id NOT IN
        (SELECT invoice_id FROM flagged WHERE NOT is_cancelled AND length(invoice_id) = 7)),
pairs AS (
  SELECT c.row_id AS cancelled_id, min(s.row_id) AS sale_id
  FROM adjusted c JOIN adjusted s
    ON c.is_cancelled AND NOT s.is_cancelled
   AND c.stock_code = s.stock_code
   AND c.customer_id IS NOT DISTINCT FROM s.customer_id
   AND -CAST(c.qty AS BIGINT) = CAST(s.qty AS BIGINT)
  GROUP BY c.row_id),
netted AS (
  SELECT * FROM adjusted
  WHERE row_id NOT IN (SELECT cancelled_id FROM pairs) AND row_id NOT IN (SELECT sale_id FROM pairs)),
uncancelled AS (SELECT * EXCLUDE (is_cancelled) FROM netted WHERE NOT is_cancelled),
-- fixed value: the irregular-code pattern
fragments AS (
  SELECT DISTINCT unnest(regexp_extract_all(stock_code, '^\\w{{1}}$|\\D[A-Z]+\\D|[A-Z]\\d|\\D[a-z]')) AS fragment
  FROM uncancelled WHERE stock_code IS NOT NULL),
even_codes AS (
  SELECT * FROM uncancelled u
  WHERE stock_code IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM fragments f WHERE starts_with(u.stock_code, f.fragment))),
upper_codes AS (SELECT * REPLACE (upper(stock_code) AS stock_code) FROM even_codes),
desc_counts AS (
  SELECT stock_code, description, count(*) AS n FROM upper_codes WHERE description IS NOT NULL GROUP BY ALL),
multi_desc AS (
  SELECT stock_code, CAST(count(*) AS BIGINT) AS n_descriptions FROM desc_counts GROUP BY stock_code HAVING count(*) > 1),
desc_modes AS (
  SELECT stock_code, description AS canonical FROM (
    SELECT stock_code, description,
           row_number() OVER (PARTITION BY stock_code ORDER BY n DESC, description) AS rk
    FROM desc_counts WHERE stock_code IN (SELECT stock_code FROM multi_desc))
  WHERE rk = 1),
canonical AS (
  SELECT u.* REPLACE (coalesce(m.canonical, u.description) AS description)
  FROM upper_codes u LEFT JOIN desc_modes m ON u.stock_code = m.stock_code),
described AS (SELECT * FROM canonical WHERE description IS NOT NULL AND length(description) > 7),
positive AS (SELECT * FROM described WHERE qty > 0),
single_packs AS (
  SELECT * FROM positive WHERE NOT (starts_with(description, 'set of') OR starts_with(description, 'pack of'))),
qty_trimmed AS (
  SELECT * FROM single_packs WHERE qty < (SELECT quantile_cont(qty, 0.995) FROM single_packs)),
priced AS (SELECT * FROM qty_trimmed WHERE unit_price > 0),
price_trimmed AS (
  SELECT * FROM priced WHERE unit_price < (SELECT quantile_cont(unit_price, 0.9999) FROM priced)),
clean AS (
  SELECT row_id, invoice_id, stock_code, description, qty, unit_price AS price, customer_id, country,
         invoice_date AS date
  FROM price_trimmed)"""

# stage key -> (CTE name, output columns)
STAGES = {
    "parse_dates": ("parsed", LINE_COLS),
    "normalize_text": ("normalized", LINE_COLS),
    "deduplicate": ("deduplicated", LINE_COLS),
    "flag_cancelled": ("flagged", LINE_COLS + ", is_cancelled"),
    "drop_adjustments": ("adjusted", LINE_COLS + ", is_cancelled"),
    "net_cancellations": ("netted", LINE_COLS + ", is_cancelled"),
    "drop_cancelled": ("uncancelled", LINE_COLS),
    "drop_odd_codes": ("even_codes", LINE_COLS),
    "upper_code": ("upper_codes", LINE_COLS),
    "canonical_description": ("canonical", LINE_COLS),
    "valid_description": ("described", LINE_COLS),
    "positive_qty": ("positive", LINE_COLS),
    "drop_multipacks": ("single_packs", LINE_COLS),
    "trim_qty": ("qty_trimmed", LINE_COLS),
    "positive_price": ("priced", LINE_COLS),
    "trim_price": ("price_trimmed", LINE_COLS),
    "clean_transactions": ("clean", CLEAN_COLS),
}


def with_clean(body: str, extra_ctes: str = "") -> str:
    ctes = CLEAN_CTES + ("," + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"


def stage_sql() -> dict[str, str]:
    return {k: with_clean(f"SELECT {cols} FROM {cte}") for k, (cte, cols) in STAGES.items()}


AUDIT_ORDER = ["rename_columns", "parse_dates", "normalize_text", "deduplicate", "flag_cancelled", "drop_adjustments",
               "net_cancellations", "drop_cancelled", "drop_odd_codes", "upper_code",
               "canonical_description", "valid_description", "positive_qty", "drop_multipacks",
               "trim_qty", "positive_price", "trim_price", "finalize_columns"]


def misc_clean_sql() -> dict[str, str]:
    audit_rows = ["SELECT 0 AS step, 'input' AS rule, count(*) AS rows_out FROM retail_tx"]
    cte = {"rename_columns": "retail_tx", "finalize_columns": "clean"}
    for i, k in enumerate(AUDIT_ORDER, start=1):
        src = cte.get(k) or STAGES[k][0]
        audit_rows.append(f"SELECT {i} AS step, '{k}' AS rule, count(*) AS rows_out FROM {src}")
    return {
        "cancellation_pairs": with_clean(
            "SELECT c.invoice_id AS cancelled_invoice, c.stock_code, c.customer_id, c.qty, "
            "s.invoice_id AS matching_invoice "
            "FROM pairs p JOIN adjusted c ON c.row_id = p.cancelled_id JOIN adjusted s ON s.row_id = p.sale_id"),
        "odd_code_fragments": with_clean("SELECT fragment FROM fragments"),
        "inconsistent_descriptions": with_clean("SELECT stock_code, n_descriptions FROM multi_desc"),
        "description_modes": with_clean("SELECT stock_code, canonical FROM desc_modes"),
        "cleaning_audit": with_clean(
            "SELECT CAST(step AS INT) AS step, rule, CAST(rows_out AS BIGINT) AS rows_out FROM ("
            + " UNION ALL ".join(audit_rows) + ")"),
    }


FEATURE_CTES = """
feat AS (
  SELECT qty, invoice_id, stock_code, description, price, customer_id, country, date, row_id,
         CAST(dayofmonth(date) AS INT) AS day, CAST(isodow(date) - 1 AS INT) AS day_of_week,
         CAST(dayofyear(date) AS INT) AS day_of_year, CAST(weekofyear(date) AS INT) AS week,
         CAST(month(date) AS INT) AS month, CAST(year(date) AS INT) AS year,
         CAST(length(description) AS INT) AS description_len
  FROM clean),
price_counts AS (SELECT stock_code, price, count(*) AS n FROM feat GROUP BY ALL),
price_mode AS (
  SELECT stock_code, price AS price_mode FROM (
    SELECT stock_code, price, row_number() OVER (PARTITION BY stock_code ORDER BY n DESC, price) AS rk
    FROM price_counts) WHERE rk = 1),
price_stats AS (
  SELECT p.stock_code, m.price_mode, p.price_median, p.price_last FROM (
    SELECT stock_code, quantile_cont(price, 0.5) AS price_median, arg_max(price, row_id) AS price_last
    FROM feat GROUP BY stock_code) p JOIN price_mode m ON p.stock_code = m.stock_code),
month_inv AS (
  SELECT year, month, CAST(count(DISTINCT invoice_id) AS BIGINT) AS n_invoice FROM feat GROUP BY year, month),
month_lag AS (
  SELECT year, month, lag(n_invoice, 1) OVER (ORDER BY year, month) AS n_invoice_lag1m FROM month_inv),
stock_month_inv AS (
  SELECT stock_code, year, month, CAST(count(DISTINCT invoice_id) AS BIGINT) AS n_invoice
  FROM feat GROUP BY stock_code, year, month),
stock_month_lag AS (
  SELECT stock_code, year, month,
         lag(n_invoice, 1) OVER (PARTITION BY stock_code ORDER BY year, month) AS n_invoice_lag1m_stock
  FROM stock_month_inv),
lines AS (
  SELECT f.*, s.price_mode, s.price_median, s.price_last, ml.n_invoice_lag1m, sl.n_invoice_lag1m_stock
  FROM feat f JOIN price_stats s ON f.stock_code = s.stock_code
  LEFT JOIN month_lag ml ON f.year = ml.year AND f.month = ml.month
  LEFT JOIN stock_month_lag sl ON f.stock_code = sl.stock_code AND f.year = sl.year AND f.month = sl.month)"""

DAY_KEYS = ("stock_code, description, price, date, day, day_of_week, day_of_year, week, month, year, "
            "price_mode, price_median, price_last, description_len, n_invoice_lag1m, n_invoice_lag1m_stock")
WEEK_KEYS = ("stock_code, description, price, date, week, month, year, "
             "price_mode, price_median, price_last, description_len, n_invoice_lag1m, n_invoice_lag1m_stock")
NOT_NULL_LAGS = "n_invoice_lag1m IS NOT NULL AND n_invoice_lag1m_stock IS NOT NULL"
CHRONO = "PARTITION BY stock_code ORDER BY date, year, month, description, price"
GROUP_KEY_DAY = ("PARTITION BY stock_code ORDER BY description, price, date, day, day_of_week, day_of_year, "
                 "week, month, year, price_mode, price_median, price_last, description_len, "
                 "n_invoice_lag1m, n_invoice_lag1m_stock")


def demand_ctes(level: str = "day", keep_null_lags: bool = False, window: str = CHRONO) -> str:
    where = "" if keep_null_lags else f"WHERE {NOT_NULL_LAGS}"
    if level == "day":
        agg = f"SELECT {DAY_KEYS}, CAST(sum(qty) AS BIGINT) AS qty FROM lines {where} GROUP BY ALL"
    else:
        agg = (f"SELECT {WEEK_KEYS}, CAST(sum(qty) AS BIGINT) AS qty FROM "
               f"(SELECT * REPLACE (CAST(date_trunc('week', date) AS DATE) AS date) FROM lines) {where} GROUP BY ALL")
    return FEATURE_CTES + f""",
demand_agg AS ({agg}),
demand AS (
  SELECT *, CAST(CASE WHEN month IN (9, 10, 11) THEN 1 ELSE 0 END AS INT) AS peak_season,
         lag(qty, 1) OVER w AS qty_lag1d, lag(qty, 5) OVER w AS qty_lag5d,
         lag(qty, 7) OVER w AS qty_lag7d, lag(qty, 30) OVER w AS qty_lag30d
  FROM demand_agg WINDOW w AS ({window}))"""


def with_demand(body: str, level="day", keep_null_lags=False, window=CHRONO, extra_ctes="") -> str:
    ctes = demand_ctes(level, keep_null_lags, window) + ("," + extra_ctes if extra_ctes else "")
    return with_clean(body, ctes)


def feature_sql() -> dict[str, str]:
    f = lambda body: with_clean(body, FEATURE_CTES)
    return {
        "reorder_columns": with_clean(f"SELECT qty, invoice_id, stock_code, description, price, customer_id, country, date FROM clean"),
        "date_parts": f("SELECT stock_code, date, day, day_of_week, day_of_year, week, month, year FROM feat"),
        "price_stats": f("SELECT stock_code, price_mode, price_median, price_last FROM price_stats"),
        "description_len": f("SELECT stock_code, description, description_len FROM feat"),
        "monthly_invoices": f("SELECT year, month, n_invoice FROM month_inv"),
        "monthly_invoices_by_stock": f("SELECT stock_code, year, month, n_invoice FROM stock_month_inv"),
        "invoice_lag_month": f("SELECT year, month, n_invoice_lag1m FROM month_lag"),
        "invoice_lag_month_stock": f("SELECT stock_code, year, month, n_invoice_lag1m_stock FROM stock_month_lag"),
        "demand_daily": with_demand("SELECT * FROM demand"),
        "demand_weekly": with_demand("SELECT * FROM demand", level="week"),
        "demand_daily_keep_null_lags": with_demand("SELECT * FROM demand", keep_null_lags=True),
        "qty_lags_group_key": with_demand("SELECT * FROM demand", window=GROUP_KEY_DAY),
    }




HORIZON = "2000-01-01"
SCORED_CTES = f"""
scored AS (
  SELECT stock_code, date, CAST(qty AS DOUBLE) AS qty, CAST(qty_lag1d AS DOUBLE) AS predictions
  FROM demand WHERE date >= DATE '{HORIZON}' AND qty_lag1d IS NOT NULL),
item_acc AS (
  SELECT stock_code AS item,
         round(CASE WHEN sum(qty) = 0 THEN NULL ELSE sum(predictions) / sum(qty) END - 1, 6) AS bias,
         round(sqrt(avg(pow(predictions - qty, 2))), 6) AS rmse,
         CAST(count(*) AS BIGINT) AS n_rows,
         CASE WHEN CASE WHEN sum(qty) = 0 THEN NULL ELSE sum(predictions) / sum(qty) END - 1 < 0
              THEN 'Model is underestimating the demand for ' || stock_code
              ELSE 'Model is overestimating the demand for item ' || stock_code END AS message
  FROM scored GROUP BY stock_code),
results AS (
  SELECT qty, predictions AS prediction, abs(qty - predictions) AS error, CAST(month(date) AS INT) AS month,
         pow(abs(qty - predictions), 2) AS squared_error
  FROM scored)"""


def accuracy_sql() -> dict[str, str]:
    s = lambda body: with_demand(body, extra_ctes=SCORED_CTES)
    return {
        "scored_predictions": s("SELECT * FROM scored"),
        "read_scored": s("SELECT * FROM scored"),
        "item_bias": s("SELECT stock_code, round(CASE WHEN sum(qty) = 0 THEN NULL ELSE sum(predictions) / sum(qty) END - 1, 6) AS bias FROM scored GROUP BY stock_code"),
        "item_rmse": s("SELECT stock_code, round(sqrt(avg(pow(predictions - qty, 2))), 6) AS rmse FROM scored GROUP BY stock_code"),
        "item_accuracy": s("SELECT * FROM item_acc"),
        "item_lookup": s("SELECT *, printf('%.2f%%', bias * 100) AS bias_text FROM item_acc WHERE item = (SELECT min(stock_code) FROM scored)"),
        "time_split": with_demand(
            f"SELECT CASE WHEN date < DATE '{HORIZON}' THEN 'train' ELSE 'validation' END AS split, "
            "CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(qty) AS BIGINT) AS sum_qty FROM demand GROUP BY 1"),
        "validation_results": s("SELECT * FROM results"),
        "median_abs_error": s("SELECT quantile_cont(error, 0.5) AS median_abs_error FROM results"),
        "monthly_rmse": s("SELECT month, round(sqrt(avg(squared_error)), 6) AS rmse FROM results GROUP BY month"),
        "error_histogram": s(
            "SELECT bucket, round(bucket * m / 20, 6) AS lower, round((bucket + 1) * m / 20, 6) AS upper, n FROM ("
            "SELECT CAST(least(CASE WHEN m > 0 THEN floor(error / m * 20) ELSE 0 END, 19) AS INT) AS bucket, "
            "any_value(m) AS m, CAST(count(*) AS BIGINT) AS n "
            "FROM results, (SELECT max(error) AS m FROM results) GROUP BY 1)"),
        "score_r2": s("SELECT round(1 - sum(pow(qty - predictions, 2)) / (var_pop(qty) * count(*)), 6) AS r2 FROM scored"),
    }



PROFILE = ("price_mode", "price_median", "price_last", "qty_avg", "qty_median")
_BC = "CASE WHEN lmbda = 0 THEN ln(x) ELSE (pow(x, lmbda) - 1) / lmbda END"
CLUSTER_CTES = """
profile AS (
  SELECT stock_code, max(price_mode) AS price_mode, max(price_median) AS price_median,
         max(price_last) AS price_last, avg(qty) AS qty_avg, quantile_cont(qty, 0.5) AS qty_median
  FROM demand GROUP BY stock_code),
plong AS (""" + " UNION ALL ".join(
    f"SELECT stock_code, '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM profile" for c in PROFILE) + """),
scaled AS (
  SELECT stock_code, feature, x, x / exp(avg(ln(x)) OVER (PARTITION BY feature)) AS u, avg(ln(x)) OVER (PARTITION BY feature) AS mean_ln FROM plong),
rings AS (
  SELECT CAST(0.05 AS DOUBLE) * i AS lmbda, CAST(0.05 AS DOUBLE) AS step FROM range(-60, 61) t(i)
  UNION ALL
  SELECT s * (CAST(3 AS DOUBLE) * pow(2, k) + CAST(0.05 AS DOUBLE) * pow(2, k) * i), CAST(0.05 AS DOUBLE) * pow(2, k)
  FROM range(0, 8) r(k), range(1, 61) t(i), (VALUES (-1), (1)) v(s)),
coarse AS (
  SELECT feature, lmbda, any_value(step) AS step, -CAST(count(*) AS DOUBLE) / 2 * ln(var_pop(""" + _BC.replace("x", "u") + """)) - count(*) * any_value(mean_ln) AS llf
  FROM scaled, rings GROUP BY feature, lmbda),
top AS (
  SELECT feature, lmbda, step FROM (
    SELECT *, row_number() OVER (PARTITION BY feature ORDER BY llf DESC, abs(lmbda), lmbda DESC) AS rk
    FROM coarse WHERE llf IS NOT NULL AND NOT isnan(llf) AND NOT isinf(llf)) WHERE rk = 1),
fine AS (SELECT feature, lmbda + step * i / 20 AS lmbda FROM top, range(-20, 21) t(i)),
llf AS (
  SELECT feature, lmbda, -CAST(count(*) AS DOUBLE) / 2 * ln(var_pop(""" + _BC.replace("x", "u") + """)) - count(*) * any_value(mean_ln) AS llf
  FROM scaled JOIN fine USING (feature) GROUP BY feature, lmbda),
best AS (
  SELECT feature, lmbda, llf FROM (
    SELECT *, row_number() OVER (PARTITION BY feature ORDER BY llf DESC, abs(lmbda), lmbda DESC) AS rk
    FROM llf WHERE llf IS NOT NULL AND NOT isnan(llf) AND NOT isinf(llf)) WHERE rk = 1),
transformed AS (
  SELECT p.stock_code, p.feature, """ + _BC.replace("x", "p.x").replace("lmbda", "b.lmbda") + """ AS y
  FROM plong p JOIN best b ON p.feature = b.feature),
zs AS (
  SELECT stock_code, feature,
         (y - avg(y) OVER (PARTITION BY feature)) /
         CASE WHEN stddev_pop(y) OVER (PARTITION BY feature) = 0 THEN 1
              ELSE stddev_pop(y) OVER (PARTITION BY feature) END AS z
  FROM transformed),
cells AS (SELECT stock_code, date, CAST(sum(qty) AS BIGINT) AS qty FROM demand GROUP BY stock_code, date),
n_dates AS (SELECT CAST(count(DISTINCT date) AS DOUBLE) AS n FROM demand),
sstats AS (
  SELECT stock_code, CAST(n AS INT) AS n_dates, s1 / n AS series_mean,
         sqrt((s2 - s1 * s1 / n) / (n - 1)) AS series_std
  FROM (SELECT stock_code, CAST(sum(qty) AS DOUBLE) AS s1, sum(pow(qty, 2)) AS s2 FROM cells GROUP BY stock_code), n_dates)"""


SERIES_GAPS = """
z AS (
  SELECT s.stock_code, d.date, CASE WHEN series_std > 0 THEN (coalesce(c.qty, 0) - series_mean) / series_std ELSE 0 END AS z
  FROM sstats s CROSS JOIN (SELECT DISTINCT date FROM demand) d LEFT JOIN cells c ON c.stock_code = s.stock_code AND c.date = d.date),
gaps AS (
  SELECT a.stock_code AS i, b.stock_code AS j, sum(pow(a.z - b.z, 2)) AS d2
  FROM z a JOIN z b ON a.date = b.date AND a.stock_code <> b.stock_code GROUP BY a.stock_code, b.stock_code)"""

# All pairs of clusters step by step: the closest pair is merged, by the update rule of squared Ward distances.
WARD = """
WITH RECURSIVE w AS (
  SELECT 0 AS step, i, j, d2, CAST(1 AS DOUBLE) AS ni, CAST(1 AS DOUBLE) AS nj FROM gaps
  UNION ALL
  SELECT step + 1, CASE WHEN i = b THEN a ELSE i END, CASE WHEN j = b THEN a ELSE j END,
         CASE WHEN bool_or(i IN (a, b)) THEN (sum((ni + nj) * d2) - any_value(nj) * dab) / (na + nb + any_value(nj))
              WHEN bool_or(j IN (a, b)) THEN (sum((ni + nj) * d2) - any_value(ni) * dab) / (na + nb + any_value(ni))
              ELSE any_value(d2) END,
         CASE WHEN bool_or(i IN (a, b)) THEN na + nb ELSE any_value(ni) END,
         CASE WHEN bool_or(j IN (a, b)) THEN na + nb ELSE any_value(nj) END
  FROM (SELECT w.*, first_value(i) OVER o AS a, first_value(j) OVER o AS b, first_value(d2) OVER o AS dab,
               first_value(ni) OVER o AS na, first_value(nj) OVER o AS nb
        FROM w WINDOW o AS (ORDER BY i > j, d2, i, j)) t
  WHERE NOT (i IN (a, b) AND j IN (a, b))
  GROUP BY step, a, b, dab, na, nb, CASE WHEN i = b THEN a ELSE i END, CASE WHEN j = b THEN a ELSE j END)
SELECT * FROM w"""


def cluster_sql() -> dict[str, str]:
    s = lambda body: with_demand(body, extra_ctes=CLUSTER_CTES)
    pivot = ", ".join(f"round(max(CASE WHEN feature = '{c}' THEN z END), 4) AS {c}" for c in PROFILE)
    labelled = "SELECT DISTINCT stock_code, true AS valid FROM demand"
    model_table = "SELECT *, true AS product_type, true AS time_series_type FROM demand"
    return {
        "select_k": s("SELECT CAST(k AS INT) AS k, true AS valid FROM range(2, 11) t(k)"),
        "select_k_euclidean": s("SELECT CAST(k AS INT) AS k, true AS valid FROM range(2, 11) t(k)"),
        "item_cluster": s(labelled),
        "series_cluster": s(labelled),
        "series_cluster_ward": s(labelled),
        "series_merges": with_demand(
            "SELECT i AS a, j AS b, round(sqrt(d2), 6) AS height, CAST(ni + nj AS BIGINT) AS size FROM (" + WARD + ") QUALIFY "
            "row_number() OVER (PARTITION BY step ORDER BY i > j, d2, i, j) = 1", extra_ctes=CLUSTER_CTES + "," + SERIES_GAPS),
        "series_merge_totals": s(
            "SELECT count(*) - 1 AS n_merges, count(*) AS n_series, round((sum(CASE WHEN series_std > 0 THEN n - 1 ELSE 0 END) - "
            "any_value(squares) / count(*)) / (count(*) * (any_value(n) - 1)), 6) AS spread FROM sstats, n_dates, ("
            "SELECT sum(pow(zero + coalesce(q, 0), 2)) AS squares FROM (SELECT DISTINCT date FROM demand) d LEFT JOIN ("
            "SELECT c.date, sum(CASE WHEN series_std > 0 THEN qty / series_std ELSE 0 END) AS q FROM cells c JOIN sstats USING (stock_code) GROUP BY c.date) t "
            "USING (date), (SELECT sum(CASE WHEN series_std > 0 THEN -series_mean / series_std ELSE 0 END) AS zero FROM sstats))"),
        "prepare_demand": with_demand(model_table),
        "prepare_demand_weekly": with_demand(model_table, level="week"),
        "product_profile": s("SELECT stock_code, price_mode, price_median, price_last, round(qty_avg, 6) AS qty_avg, qty_median FROM profile"),
        "boxcox": s("SELECT feature, round(lmbda, 4) AS lmbda, round(llf, 4) AS llf FROM best"),
        "standardize": s(f"SELECT stock_code, {pivot} FROM zs GROUP BY stock_code"),
        "series_matrix": s("SELECT * FROM cells"),
        "series_zscore": s("SELECT stock_code, n_dates, round(series_mean, 6) AS series_mean, "
                           "round(series_std, 6) AS series_std, round(-series_mean / series_std, 6) AS zero_z FROM sstats"),
    }



def model_sql() -> dict[str, str]:
    te = """
te_daily AS (SELECT stock_code, date, sum(CAST(qty AS DOUBLE)) AS sy, count(qty) AS n FROM demand GROUP BY stock_code, date)"""
    body = ("SELECT stock_code, date, round((coalesce(sum(sy) OVER w, 0) + CAST(1.0 AS DOUBLE) * "
            "(SELECT avg(CAST(qty AS DOUBLE)) FROM demand)) / (coalesce(sum(n) OVER w, 0) + CAST(1.0 AS DOUBLE)), 6) "
            "AS stock_code_te FROM te_daily "
            "WINDOW w AS (PARTITION BY stock_code ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    val = f"FROM demand WHERE date >= DATE '{HORIZON}'"
    iterations = lambda n: with_demand(f"SELECT CAST(i AS INT) AS iter, true AS valid FROM range(0, {n}) t(i)")
    numeric = ("price", "day", "day_of_week", "day_of_year", "week", "month", "year", "price_mode", "price_median", "price_last",
               "description_len", "n_invoice_lag1m", "n_invoice_lag1m_stock", "peak_season", "qty_lag1d", "qty_lag5d", "qty_lag7d", "qty_lag30d")
    features = ", ".join(f"('{c}')" for c in (*numeric, "stock_code_te", "description_te"))
    curve = """
curve AS (
  SELECT CAST(row_number() OVER (ORDER BY date) - 1 AS INT) AS iter, round(sqrt(avg(pow(predictions - qty, 2))), 6) AS error FROM scored GROUP BY date),
best_so_far AS (SELECT *, min(error) OVER (ORDER BY iter ROWS UNBOUNDED PRECEDING) AS best_error FROM curve),
ranked AS (SELECT b.*, (SELECT min(c.iter) FROM curve c WHERE c.iter <= b.iter AND c.error = b.best_error) AS best_step FROM best_so_far b)"""
    return {
        "ordered_target_encoding": with_demand(body, extra_ctes=te),
        "patience_rule": with_demand(
            "SELECT iter, error, best_error, best_step, iter - best_step AS since_best, "
            "NOT EXISTS (SELECT 1 FROM ranked q WHERE q.iter < r.iter AND q.iter - q.best_step >= 40) AS running FROM ranked r",
            extra_ctes=SCORED_CTES + "," + curve),
        "prepare_categoricals": with_clean(
            "SELECT c.country, CAST(i.idx AS DOUBLE) AS country_idx FROM clean c JOIN ("
            "SELECT country, row_number() OVER (ORDER BY count(*) DESC, country) - 1 AS idx FROM clean GROUP BY country) i ON c.country = i.country"),
        "fit_demand_model": with_demand(f"SELECT qty, CAST(month(date) AS INT) AS month, true AS valid {val}"),
        "early_stopping": with_demand("SELECT true AS valid"),
        "patience_growth": with_demand("SELECT true AS valid"),
        "shap_values": with_demand(f"SELECT stock_code, date, price, description, true AS valid {val}"),
        "shap_importance": with_demand(f"SELECT feature, true AS valid FROM (VALUES {features}) v(feature)"),
        "shap_dependence": with_demand(f"SELECT price, true AS valid {val}"),
        "learning_curve": iterations(60),
        "set_data_pool": iterations(10),
        "predict": with_demand(f"SELECT stock_code, date, price, description, true AS valid {val}"),
        "model_score": with_demand("SELECT true AS valid"),
        "model_monthly_rmse": with_demand(f"SELECT DISTINCT CAST(month(date) AS INT) AS month, true AS valid {val}"),
        "sample_weight": with_demand(f"SELECT stock_code, date, CAST(peak_season + 1 AS DOUBLE) AS weight, true AS valid {val}"),
        "feature_importance": with_demand(f"SELECT feature, true AS valid FROM (VALUES {features}) v(feature)"),
        "feature_dependence": with_demand(f"SELECT CAST(count(*) AS BIGINT) AS n_rows, true AS valid {val}"),
    }



AWKWARD = "CASE WHEN qty % 7 = 0 THEN description || ' 12\" \"RULER\"' || chr(9) || '; ' ELSE description END"
RAW_SELECT = (f'invoice_id AS "Invoice", stock_code AS "StockCode", {AWKWARD} AS "Description", '
              'qty AS "Quantity", strftime(invoice_timestamp, \'%Y-%m-%d %H:%M:%S\') AS "InvoiceDate", '
              'unit_price AS "Price", customer_id AS "Customer ID", country AS "Country"')


def source_sql() -> dict[str, str]:
    union_select = RAW_SELECT.replace('country AS "Country"',
                                      'CASE WHEN year(invoice_timestamp) >= 1998 THEN NULL ELSE country END AS "Country"')
    return {
        "read_transactions": with_clean(f"SELECT {RAW_SELECT} FROM retail_tx"),
        "union_parts": with_clean(f"SELECT {union_select} FROM retail_tx"),
        "write_table": with_clean(f"SELECT * REPLACE ({AWKWARD} AS description) FROM (SELECT {CLEAN_COLS} FROM clean)"),
        "item_accuracy_stream": with_demand("SELECT * FROM item_acc", extra_ctes=SCORED_CTES),
    }



def rule_sql() -> dict[str, str]:
    renamed = ("invoice_id, stock_code, description, qty, "
               "strftime(invoice_timestamp, '%Y-%m-%d %H:%M:%S') AS invoice_timestamp, "
               "unit_price, customer_id, country")
    return {
        "rename_columns": with_clean(f"SELECT {renamed} FROM retail_tx"),
        "peak_season": with_demand("SELECT stock_code, date, month, peak_season FROM demand"),
        "qty_lags": with_demand("SELECT stock_code, description, price, date, month, year, qty, "
                                "qty_lag1d, qty_lag5d, qty_lag7d, qty_lag30d FROM demand"),
        "bias_message": with_demand("SELECT item, message FROM item_acc", extra_ctes=SCORED_CTES),
        "clean_transactions_landed": with_clean(f"SELECT {CLEAN_COLS} FROM clean"),
    }


def all_sql() -> dict[str, str]:
    """Oracle SQL for every exactly checkable key."""
    out: dict[str, str] = {}
    for group in (stage_sql, misc_clean_sql, feature_sql, rule_sql, accuracy_sql, cluster_sql,
                  model_sql, source_sql):
        out.update(group())
    return out
