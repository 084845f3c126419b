"""The retail-shaped view over the driver's TPC-H-like tables.

The surveyed project ships no data, so tests and registered queries read a
view that turns ``lineitem``/``orders``/... into invoice lines on which every
cleaning rule fires (returns, adjustment invoices, odd codes, case variants,
multipack and short descriptions, zero and extreme prices, null customers,
exact duplicates).  The same SELECT runs on Spark SQL and DuckDB.

File order is represented two ways:

* Spark: ``row_order``, a struct (order date, order key, place among the order's
  lines), the place being the dense rank by the other ordering columns.  Structs
  compare field by field, so ``min``/``max_by`` over it give "first"/"last" in file
  order without any global numbering (a global ``row_number`` would run in
  one task), and three fields go through the later shuffles instead of thirteen.
* DuckDB oracle: ``row_id = row_number() OVER (ORDER BY <same columns>)``.

Rows that tie on the ordering columns are equal in every column, so the two
forms agree on every result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# The ordering columns that stand in for input-file order.
ORDER_COLUMNS = ("o_orderdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                 "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                 "l_linestatus", "l_shipdate", "dup")

# The body of the view (everything after the order column).
_VIEW_BODY = """
 CASE WHEN l_returnflag='R' THEN 'C' WHEN l_discount >= 0.095 THEN 'A' ELSE '' END || lpad(CAST(l_orderkey AS STRING),6,'0') AS invoice_id,
 CASE l_partkey % 50 WHEN 0 THEN 'POST' WHEN 1 THEN 'M' WHEN 2 THEN 'M_'||CAST(l_partkey AS STRING) WHEN 3 THEN 'gift_0001_20'
   ELSE lpad(CAST(l_partkey % 60 AS STRING),5,'0') || CASE WHEN l_partkey % 120 < 60 THEN 'A' ELSE 'a' END END AS stock_code,
 CASE WHEN l_partkey % 60 = 7 THEN 'SET OF '||p_name WHEN l_partkey % 60 = 8 THEN ' Red Rod ' WHEN l_linenumber=7 AND l_quantity<5 THEN NULL
   WHEN l_linenumber % 2 = 0 THEN '  '||upper(p_name) ELSE p_name||' ' END AS description,
 CAST(CASE WHEN l_returnflag='R' THEN -l_quantity WHEN l_quantity=13 AND l_linestatus='F' THEN -l_quantity ELSE l_quantity END AS INT) AS qty,
 CAST(o_orderdate AS TIMESTAMP) AS invoice_timestamp,
 CAST(CASE WHEN l_quantity=1 AND l_linenumber=7 THEN 0 WHEN l_orderkey % 1000 = 7 THEN 999 ELSE 2 + (l_partkey % 60) % 7 + (l_linenumber % 3)*0.25 END AS DOUBLE) AS unit_price,
 CASE WHEN o_custkey % 25 = 0 THEN NULL ELSE CAST(o_custkey % 25 AS STRING) END AS customer_id,
 n_name AS country
FROM (SELECT *, 0 AS dup FROM {lineitem} UNION ALL SELECT *, 1 AS dup FROM {lineitem} WHERE l_orderkey % 50 = 0)
JOIN {orders} ON l_orderkey=o_orderkey JOIN {customer} ON o_custkey=c_custkey JOIN {nation} ON c_nationkey=n_nationkey JOIN {part} ON l_partkey=p_partkey
"""


# What Spark reads the view's columns from.  Lines get their place in the shuffle that
# brings them to their order; customers and nations meet the orders, which are fewer than the lines.
_SPARK_FROM = """
FROM (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_discount, l_returnflag, l_linestatus,
             dense_rank() OVER (PARTITION BY l_orderkey ORDER BY {place}) AS n_line
      FROM (SELECT *, 0 AS dup FROM {lineitem} UNION ALL SELECT *, 1 AS dup FROM {lineitem} WHERE l_orderkey % 50 = 0)
      WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL)
JOIN (SELECT o_orderkey, o_custkey, o_orderdate, n_name
      FROM {orders} JOIN {customer} ON o_custkey=c_custkey JOIN {nation} ON c_nationkey=n_nationkey) ON l_orderkey=o_orderkey
JOIN {part} ON l_partkey=p_partkey
"""


def retail_view_sql(engine: str = "duckdb") -> str:
    """The view as SQL text.  ``duckdb``: plain table names and ``row_id``."""
    order = ", ".join(ORDER_COLUMNS)
    if engine == "duckdb":
        head = f"SELECT row_number() OVER (ORDER BY {order}) AS row_id,"
        body = _VIEW_BODY.format(lineitem="lineitem", orders="orders", customer="customer",
                                 nation="nation", part="part")
        return head + body
    columns = _VIEW_BODY.partition("\nFROM ")[0]
    place = ", ".join(c for c in ORDER_COLUMNS if c not in ("o_orderdate", "l_orderkey"))
    return "SELECT struct(o_orderdate, l_orderkey, n_line) AS row_order," + columns + _SPARK_FROM.replace("{place}", place)


#: Parts up to which keys and names are broadcast (about 100 bytes each, so up to 200 MB); with more, the
#: lines go through one more shuffle for them.
PART_ROWS = 2_000_000


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def retail_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retail view as a Spark DataFrame: 8 typed columns + ``row_order``."""
    t = load_tables(spark, sf_dir, ("lineitem", "orders", "customer", "nation", "part"))
    part = t["part"].select("p_partkey", "p_name")
    t["part"] = F.broadcast(part) if part.count() <= PART_ROWS else part
    return spark.sql(retail_view_sql("spark"), **t)
