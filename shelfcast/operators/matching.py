"""Relational matching rules of the cleaning stage.

* C7  ``net_cancellations``: drop each cancelled line that has a matching sale
  and, once, the first such sale.
* C7b ``cancellation_pairs``: the cancelled -> first matching sale table.
* C9  ``odd_code_fragments``: irregular pieces found inside stock codes.
* C10 ``drop_odd_codes``: drop lines whose code starts with any fragment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.session import small_side


def _match_qty(df: DataFrame) -> Column:
    # A cancellation of -5 looks for a sale of +5; a sale keeps its own sign.
    # bigint first: negating INT_MIN overflows under ANSI.
    q = F.col("qty").cast("bigint")
    return F.when(F.col("is_cancelled"), -q).otherwise(q)


def _key_cond(left: str, right: str, df: DataFrame) -> Column:
    # Null customers match each other (the original compares the text 'nan'):
    # null-safe equality, still planned as an equi-join key.
    return ((F.col(f"{left}.stock_code") == F.col(f"{right}.stock_code"))
            & F.col(f"{left}.customer_id").eqNullSafe(F.col(f"{right}.customer_id"))
            & (F.col(f"{left}.match_qty") == F.col(f"{right}.match_qty")))


def _lead(df: DataFrame, order_col: str) -> Column:
    # The leading field of the order where it is a number or a time (a hash aggregate takes its
    # minimum); else a constant, which every row shares.
    lead, kind = F.col(order_col), df.schema[order_col].dataType
    if isinstance(kind, T.StructType):
        lead, kind = lead[kind.fields[0].name], kind.fields[0].dataType
    plain = isinstance(kind, (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType))
    return lead if plain else F.lit(None).cast("int")


def _match_groups(df: DataFrame, order_col: str, cut: str | None = None) -> DataFrame:
    """One row per (stock, customer, matched qty) that has both a cancellation
    and a sale: the first sale's order and invoice.

    Two steps, both pre-aggregated map-side so a hot key (one product bought
    by anonymous customers in units of one, say) collapses before the
    shuffle: (1) a hash aggregate of the has-cancel / has-sale flags over all
    lines, with the least leading field of the sales' order; (2) the first sale, a
    struct minimum (sort-based aggregate), only over the sales of matched keys
    with that leading field, so the sort never sees the whole input.
    With ``cut`` the matched keys and the groups are written (see
    :func:`~shelfcast.session.small_side`), so lines aren't shuffled for few of them.
    """
    keyed = df.select("stock_code", "customer_id", _match_qty(df).alias("match_qty"),
                      "is_cancelled", F.col(order_col).alias("o"), F.col("invoice_id").alias("inv"),
                      _lead(df, order_col).alias("lead"))
    sale = ~F.col("is_cancelled")
    flags = (keyed.groupBy("stock_code", "customer_id", "match_qty")
             .agg(F.max(F.col("is_cancelled").cast("int")).alias("has_cancel"),
                  F.max(sale.cast("int")).alias("has_sale"),
                  F.max((sale & F.col("lead").isNull()).cast("int")).alias("null_lead"),
                  F.min(F.when(sale, F.col("lead"))).alias("lead"))
             .where((F.col("has_cancel") == 1) & (F.col("has_sale") == 1))
             .select("stock_code", "customer_id", "match_qty", F.when(F.col("null_lead") == 0, F.col("lead")).alias("lead")))
    flags = small_side(flags, "match-keys", cut)
    sales = keyed.where(~F.col("is_cancelled")).alias("s")
    matched_sales = sales.join(flags.alias("k"), _key_cond("s", "k", df) & F.col("s.lead").eqNullSafe(F.col("k.lead")), "left_semi")
    first = (matched_sales.groupBy("stock_code", "customer_id", "match_qty")
             .agg(F.min(F.struct("o", "inv")).alias("first_sale")))
    first = first.select("stock_code", "customer_id", "match_qty",
                         F.col("first_sale.o").alias("first_sale_order"),
                         F.col("first_sale.inv").alias("matching_invoice"))
    return small_side(first, "match-groups", cut)


def _join_groups(df: DataFrame, groups: DataFrame, how: str) -> DataFrame:
    d = df.withColumn("_match_qty", _match_qty(df)).alias("d")
    g = groups.alias("g")
    cond = ((F.col("d.stock_code") == F.col("g.stock_code"))
            & F.col("d.customer_id").eqNullSafe(F.col("g.customer_id"))
            & (F.col("d._match_qty") == F.col("g.match_qty")))
    return d.join(g, cond, how)


def net_cancellations(df: DataFrame, order_col: str = "row_order",
                      candidates: DataFrame | None = None, cut: str | None = None) -> DataFrame:
    """Drop every cancelled line with a matching sale (same stock, same
    customer, opposite quantity) and the first matching sale of each group.

    Several cancellations may point at one sale: all of them go, that sale
    goes once.  There is no time test.  Unmatched cancellations stay (a later
    rule drops them).  Needs ``is_cancelled`` and ``order_col``.

    ``candidates`` may supply the lines *before* duplicate removal: exact
    copies share their key, flag and invoice, and the copy kept is the first
    one, so the match groups are the same; computing them there lets the
    group-by read the source directly instead of a second copy of the
    de-duplication shuffle.  ``cut`` as in ``_match_groups``.
    """
    groups = _match_groups(candidates if candidates is not None else df, order_col, cut)
    joined = _join_groups(df, groups, "left")
    matched = F.col("g.match_qty").isNotNull()
    drop = matched & (F.col("d.is_cancelled")
                      | (F.col(f"d.{order_col}") == F.col("g.first_sale_order")))
    return joined.where(~drop).select(*[F.col(f"d.`{c}`") for c in df.columns])


def cancellation_pairs(df: DataFrame, order_col: str = "row_order", cut: str | None = None) -> DataFrame:
    """Each matched cancelled line with its first matching sale's invoice."""
    groups = _match_groups(df, order_col, cut)
    return (_join_groups(df.where(F.col("is_cancelled")), groups, "inner")
            .select(F.col("d.invoice_id").alias("cancelled_invoice"),
                    F.col("d.stock_code").alias("stock_code"),
                    F.col("d.customer_id").alias("customer_id"),
                    F.col("d.qty").alias("qty"),
                    F.col("g.matching_invoice").alias("matching_invoice")))


# The irregular-code pattern.  ``(?U)`` gives Java the Unicode
# character classes that Python's ``re`` uses for str patterns.
ODD_CODE_PATTERN = r"(?U)^\w{1}$|\D[A-Z]+\D|[A-Z]\d|\D[a-z]"


def odd_code_fragments(df: DataFrame, code_col: str = "stock_code") -> DataFrame:
    """Distinct regex pieces found in the codes (not whole codes).

    Works on distinct codes first, so the regex runs once per code, not once
    per line.  Null codes are ignored.
    """
    codes = df.select(F.col(code_col).alias("code")).where(F.col("code").isNotNull()).distinct()
    return (codes.select(F.explode(F.regexp_extract_all("code", F.lit(ODD_CODE_PATTERN), 0))
                         .alias("fragment"))
            .distinct())


def drop_odd_codes(df: DataFrame, code_col: str = "stock_code", cut: str | None = None) -> DataFrame:
    """Drop lines whose code starts with any fragment of C9 (and null codes).

    A prefix test against a set is a theta join; here it becomes equi-joins:
    every prefix of each *distinct* code is exploded (codes are short), the
    prefixes are semi-joined to the fragments, and the resulting bad codes are
    anti-joined back.  AQE broadcasts the bad-code set when its runtime size
    is small and falls back to a shuffle join otherwise; with ``cut`` the set is written
    first and the lines aren't shuffled for a small one.
    """
    frags = odd_code_fragments(df, code_col)
    codes = df.select(F.col(code_col).alias("code")).where(F.col("code").isNotNull()).distinct()
    prefixes = codes.select("code", F.explode(F.sequence(F.lit(1), F.length("code"))).alias("n"))
    prefixes = prefixes.select("code", F.substring(F.col("code"), F.lit(1), F.col("n")).alias("fragment"))
    bad = small_side(prefixes.join(frags, "fragment", "left_semi").select("code").distinct(), "odd-codes", cut)
    kept = df.where(F.col(code_col).isNotNull())
    return kept.join(bad, kept[code_col] == bad["code"], "left_anti")
