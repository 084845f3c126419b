"""``clean_transactions``: the cleaning rules chained in the original order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shelfcast.functions import starts_with_any
from shelfcast.operators import cleaning as C
from shelfcast.operators import matching as M
from shelfcast.session import materialize


RULES = ("rename_columns", "parse_dates", "normalize_text", "deduplicate", "flag_cancelled", "drop_adjustments",
         "net_cancellations", "drop_cancelled", "drop_odd_codes", "upper_code", "canonical_description", "valid_description",
         "positive_qty", "drop_multipacks", "trim_qty", "positive_price", "trim_price", "finalize_columns")


def clean_stage_frames(df: DataFrame, order_col: str = "row_order", qty_quantile: float = 0.995,
                       price_quantile: float = 0.9999, approx: bool = False,
                       materialize_as: str | None = "parquet", until: str | None = None,
                       audit: Audit | None = None) -> list[tuple[str, DataFrame]]:
    """Apply the rules in order, up to and with ``until``; return (rule, output) for each.

    With ``audit``, rows are counted on the way, see :func:`audited_clean`.

    Two lineage cuts (``materialize_as``): after the cancelled lines are gone
    (the frame the code and description rules read three times) and before
    the quantile trims (read by both quantiles and the main branch).
    Without them Catalyst pushes each later filter into every branch, the
    branches stop being identical, and shuffles are no longer shared.  Rules
    before a cut write no lines; the small tables that netting, odd codes and descriptions join
    are written, so that no lines are shuffled for them.  From netting on ``df`` is read three
    times; where reading it costs shuffles, land it first.
    """
    if until is not None and until not in RULES:
        raise ValueError(f"unknown cleaning rule {until!r}")
    out: list[tuple[str, DataFrame]] = []
    raw = C.normalize_text(C.parse_dates(C.rename_columns(df)))

    def net(d):
        # the match groups come from the lines before duplicates go: the same groups, read from the source
        return M.net_cancellations(d, order_col, candidates=C.drop_adjustments(C.flag_cancelled(raw)), cut=materialize_as)

    rules = {
        "rename_columns": C.rename_columns, "parse_dates": C.parse_dates, "normalize_text": C.normalize_text,
        "deduplicate": lambda d: C.deduplicate(d, order_col), "flag_cancelled": C.flag_cancelled,
        "drop_adjustments": C.drop_adjustments, "net_cancellations": net,
        "drop_cancelled": C.drop_cancelled,
        "drop_odd_codes": lambda d: M.drop_odd_codes(d, cut=materialize_as), "upper_code": C.upper_code,
        "canonical_description": lambda d: C.canonical_description(d, cut=materialize_as),
        "valid_description": C.valid_description, "positive_qty": C.positive_qty,
        "drop_multipacks": C.drop_multipacks,
        "trim_qty": lambda d: C.trim_qty(d, qty_quantile, approx), "positive_price": C.positive_price,
        "trim_price": lambda d: C.trim_price(d, price_quantile, approx), "finalize_columns": lambda d: C.finalize_columns(d, order_col),
    }
    cuts = {"drop_cancelled": "clean-a", "drop_multipacks": "clean-b"}
    d = df
    for name in RULES:
        d = rules[name](d)
        if audit is not None:
            d = audit.watch(name, d)
        if name in cuts:
            d = materialize(d, cuts[name], materialize_as)
        out.append((name, d))
        if name == until:
            break
    return out


def clean_transactions(df: DataFrame, order_col: str = "row_order", qty_quantile: float = 0.995,
                       price_quantile: float = 0.9999, approx: bool = False,
                       materialize_as: str | None = "parquet") -> DataFrame:
    """Raw (or already renamed) invoice lines -> clean lines.

    Output columns: invoice_id, stock_code, description, qty, price,
    customer_id, country, date, and ``order_col`` (kept for the last-price
    feature; drop it when not needed).
    """
    return clean_stage_frames(df, order_col, qty_quantile, price_quantile, approx,
                              materialize_as)[-1][1]


class Audit:
    """Counts the rows that rules let through while the tables are written, by observed metrics.

    Row filters that follow each other are counted at one place, with a condition for each, so a place is
    needed only after a rule that joins or aggregates.
    """

    def __init__(self) -> None:
        true = F.lit(True)
        described = F.col("description").isNotNull() & (F.length("description") > C.MIN_DESCRIPTION_LEN)
        sold = described & (F.col("qty") > 0)
        single = sold & ~starts_with_any(F.col("description"), C.MULTIPACK_PREFIXES)
        length_7 = F.col("is_cancelled") | F.coalesce(F.length("invoice_id") != 7, true)
        # rule after which rows are counted -> rules and conditions on those rows
        self.places = {
            "normalize_text": [("input", true), ("rename_columns", true), ("parse_dates", true), ("normalize_text", true)],
            "flag_cancelled": [("deduplicate", true), ("flag_cancelled", true), ("drop_adjustments", length_7)],
            "net_cancellations": [("net_cancellations", true), ("drop_cancelled", ~F.col("is_cancelled"))],
            "canonical_description": [("drop_odd_codes", true), ("upper_code", true), ("canonical_description", true),
                                      ("valid_description", described), ("positive_qty", sold), ("drop_multipacks", single)],
            "trim_qty": [("trim_qty", true), ("positive_price", F.col("unit_price") > 0)],
            "finalize_columns": [("trim_price", true), ("finalize_columns", true)],
        }
        self.seen: dict[str, Observation] = {}

    def watch(self, rule: str, df: DataFrame) -> DataFrame:
        if rule not in self.places:
            return df
        self.seen[rule] = Observation()
        return df.observe(self.seen[rule], *[F.count(F.when(cond, 1)).alias(name) for name, cond in self.places[rule]])

    def rows(self) -> list[tuple[int, str, int]]:
        """(step, rule, rows_out); waits for the writes."""
        counts = {name: n for seen in self.seen.values() for name, n in seen.get.items()}
        return [(i, name, counts[name]) for i, name in enumerate(("input", *RULES))]


def audited_clean(df: DataFrame, order_col: str = "row_order", **kw) -> tuple[DataFrame, DataFrame]:
    """The clean lines, written, and the audit of how they came about: (step, rule, rows_out).

    The counts are metrics of the same writes that cut the lineage (and of the last one, of the result), so
    nothing is read a second time for them.
    """
    audit = Audit()
    clean = clean_stage_frames(df, order_col, audit=audit, **kw)[-1][1]
    clean = materialize(clean, "clean")
    return clean, df.sparkSession.createDataFrame(audit.rows(), "step int, rule string, rows_out long")


def cleaning_audit(df: DataFrame, order_col: str = "row_order", **kw) -> DataFrame:
    """C20: rows left after each rule, as a table (step, rule, rows_out).

    The original prints one overall count; a per-rule table is the distributed form.
    """
    return audited_clean(df, order_col, **kw)[1]
