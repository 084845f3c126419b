"""The distributed netting rule against a row-at-a-time reading of the original."""

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfcast.operators import cleaning as C
from shelfcast.operators import matching as M
from shelfcast.plans.catalog import raw_lines


def brute_force_netting(pdf: pd.DataFrame) -> set:
    """Each cancelled line, in file order, takes the first sale (file order)
    with the same stock, customer (missing == missing) and opposite quantity;
    both go.  Several cancels may take the same sale."""
    pdf = pdf.sort_values("row_order")
    first_sale = {}
    for r in pdf[~pdf.is_cancelled].itertuples():
        key = (r.stock_code, None if pd.isna(r.customer_id) else r.customer_id, int(r.qty))
        first_sale.setdefault(key, r.row_order)
    drop = set()
    for r in pdf[pdf.is_cancelled].itertuples():
        key = (r.stock_code, None if pd.isna(r.customer_id) else r.customer_id, -int(r.qty))
        if key in first_sale:
            drop.update([r.row_order, first_sale[key]])
    return set(pdf.row_order) - drop


def test_netting_equals_brute_force(spark):
    frames = C.flag_cancelled(C.deduplicate(C.parse_dates(C.rename_columns(raw_lines(spark, SF_SMALL)))))
    d = C.drop_adjustments(frames)
    # A flat integer rank of the struct order (test-only global window) keeps the pandas side simple.
    d = d.withColumn("row_order", F.dense_rank().over(Window.orderBy("row_order")))
    pdf = d.select("stock_code", "customer_id", "qty", "is_cancelled", "row_order").toPandas()
    want = brute_force_netting(pdf)
    got = {r.row_order for r in M.net_cancellations(d).select("row_order").collect()}
    assert got == want
