"""Property tests: random small inputs against direct Python readings."""

import datetime as dt
import re

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfcast.operators import cleaning as C
from shelfcast.operators import matching as M
from test_netting_brute_force import brute_force_netting

TS = dt.datetime(2010, 12, 1, 8, 26)
SCHEMA = ("invoice_id string, stock_code string, description string, qty int, "
          "invoice_timestamp timestamp, unit_price double, customer_id string, country string, "
          "row_order bigint")

line = st.tuples(st.booleans(), st.sampled_from(["S1", "S2"]), st.sampled_from(["c1", "c2", None]),
                 st.integers(-3, 3))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(line, min_size=1, max_size=25))
def test_netting_matches_direct_reading(spark, lines):
    rows = [((f"C{i}" if canc else f"{i}"), code, "jumbo bag red", q, TS, 1.0, cust, "UK", i)
            for i, (canc, code, cust, q) in enumerate(lines)]
    d = C.flag_cancelled(spark.createDataFrame(rows, SCHEMA))
    got = {r.row_order for r in M.net_cancellations(d).select("row_order").collect()}
    pdf = pd.DataFrame([(code, cust, q, canc, i) for i, (canc, code, cust, q) in enumerate(lines)],
                       columns=["stock_code", "customer_id", "qty", "is_cancelled", "row_order"])
    assert got == brute_force_netting(pdf)


# The original's pattern, applied with Python's re (str patterns are Unicode-aware).
# Fixed value: the irregular-code pattern, as Python writes it.
PY_PATTERN = re.compile(r"^\w{1}$|\D[A-Z]+\D|[A-Z]\d|\D[a-z]")
code = st.text(alphabet="AZaz09_ -é", min_size=1, max_size=6)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(code, min_size=1, max_size=12))
def test_fragments_and_prefix_drop_match_python_re(spark, codes):
    df = spark.createDataFrame([(c,) for c in codes], "stock_code string")
    frags = {f for c in codes for f in PY_PATTERN.findall(c)}
    assert {r.fragment for r in M.odd_code_fragments(df).collect()} == frags
    kept = sorted(r.stock_code for r in M.drop_odd_codes(df).collect())
    assert kept == sorted(c for c in codes if not c.startswith(tuple(frags)))
