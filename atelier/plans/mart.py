"""Mart rows (C8-C11): the intended mart, the literal result sets, and the
full and incremental refresh as DataFrame functions (no I/O here; see
``atelier.plans.refresh`` for the versioned writes).

Intended meaning (SURVEY §3.4), used by ``intended_mart`` / ``incremental_mart``:
- one row per (customer, month) (D4): ties for the top craftsman go to the
  smallest id, ties for the top category to the greatest name;
- top craftsman per customer over all of the customer's orders, top category
  per (customer, month) ranked by order count (D5, D6);
- an affected customer has every month recomputed from the whole fact (D2),
  and all of that customer's rows are replaced (D3, D1).

Literal meaning, used by ``literal_results``: the reference's insert and
update result sets, computed from the change delta alone, with the LEFT JOIN
fan-out applied as a multiplicity and the category ranked by name. The
update results name every craftsman tied at the top, one row each (D4), so a
customer-month has as many rows as its customer has tied craftsmen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.functions.conform import conform
from atelier.operators.delta import affected_customers
from atelier.operators.keys import assign_ids_counted
from atelier.operators.measures import (
    category_counts,
    craftsman_counts,
    finish_measures,
    month_measures,
    order_grain,
)
from atelier.operators.ranking import (
    top_category_by_count,
    top_category_literal,
    top_craftsman_one,
    top_craftsman_ties,
)
from atelier.operators.star import counted_orders, customer_attributes, order_rows
from atelier.schemas import MART, MART_BUSINESS_COLS
from atelier.session import materialize

CUSTOMER_MONTH = ["customer_id", "report_period"]
MART_ID_ORDER = ["report_period", "customer_id"]


def intended_mart(star: dict[str, DataFrame], customers: DataFrame | None = None) -> DataFrame:
    """Mart business columns for all customers, or for ``customers`` only.

    The level-1 grain is written once to the shared checkpoint folder: the
    three rollups then read it instead of each scanning and joining the fact
    again, and a lost executor re-reads it rather than recomputing the fact
    join.
    """
    fo = counted_orders(star["f_order"])
    if customers is not None:
        fo = fo.join(customers.select("customer_id"), "customer_id", "left_semi")
    rows = order_rows(fo, star["d_craftsman"], star["d_product"])
    return mart_of_grain(materialize(order_grain(rows), "grain"), star["d_customer"])


def mart_of_grain(grain: DataFrame, d_customer: DataFrame) -> DataFrame:
    """Mart business columns from the level-1 grain, which is read three times.

    Categories are counted and ranked where the grain's rows lie by customer and month, as the measures do, so
    the two are joined in place and customers' attributes are added after the last shuffle of the months.
    """
    measures = finish_measures(month_measures(grain, CUSTOMER_MONTH))
    top_craft = top_craftsman_one(craftsman_counts(grain))
    by_month = grain.repartition(*CUSTOMER_MONTH)
    top_cat = top_category_by_count(category_counts(by_month, CUSTOMER_MONTH), CUSTOMER_MONTH)
    out = (
        measures.join(top_cat, CUSTOMER_MONTH, "left")
        .join(customer_attributes(d_customer), "customer_id")
        .join(top_craft, "customer_id")
    )
    return out.select(*MART_BUSINESS_COLS)


def with_mart_ids_counted(rows: DataFrame, base: int = 0) -> tuple[DataFrame, int]:
    """Identity ids in report-period order (O1 folded into K1)."""
    with_ids, max_id = assign_ids_counted(rows, MART_ID_ORDER, "id", base=base)
    return with_ids.select("id", *MART_BUSINESS_COLS), max_id


def with_mart_ids(rows: DataFrame, base: int = 0) -> DataFrame:
    return with_mart_ids_counted(rows, base)[0]


def full_mart_counted(star: dict[str, DataFrame]) -> tuple[DataFrame, int]:
    """Full refresh: every customer-month, ids 1..n, and n."""
    return with_mart_ids_counted(intended_mart(star))


def full_mart(star: dict[str, DataFrame]) -> DataFrame:
    """Full refresh: every customer-month, ids 1..n."""
    return full_mart_counted(star)[0]


def incremental_mart(
    prev_mart: DataFrame,
    star: dict[str, DataFrame],
    watermark,
    affected: DataFrame | None = None,
    base_id: int | None = None,
) -> DataFrame:
    """``incremental_mart_counted`` without the largest id."""
    return incremental_mart_counted(prev_mart, star, watermark, affected, base_id)[0]


def incremental_mart_counted(
    prev_mart: DataFrame,
    star: dict[str, DataFrame],
    watermark,
    affected: DataFrame | None = None,
    base_id: int | None = None,
) -> tuple[DataFrame, int]:
    """Incremental refresh: replace every row of each affected customer.

    Rows of unaffected customers are kept as they are. Recomputed rows keep
    the id of the same (customer, month) where it existed; new months get
    ids after the current maximum (``base_id``, read from the table's commit
    log by the job). Equals ``full_mart`` on the business columns whenever
    ``prev_mart`` was right for the unaffected customers.
    """
    if affected is None:
        affected = materialize(affected_customers(star, watermark), "affected")
    affected = affected.select("customer_id")
    return replace_customers(prev_mart, intended_mart(star, affected), affected, base_id)


def replace_customers(
    prev_mart: DataFrame, recomputed: DataFrame, affected: DataFrame, base_id: int | None = None
) -> tuple[DataFrame, int]:
    """``prev_mart`` with the rows of the affected customers replaced by ``recomputed``, and the largest id."""
    if base_id is None:
        base_id = prev_mart.agg(F.max("id").alias("m")).first()["m"]
    kept = prev_mart.join(affected, "customer_id", "left_anti")
    renewed, max_id = with_known_ids(recomputed, prev_mart.join(affected, "customer_id", "left_semi"), base_id or 0)
    return kept.select("id", *MART_BUSINESS_COLS).unionByName(renewed), max_id


def with_known_ids(recomputed: DataFrame, earlier: DataFrame, base_id: int) -> tuple[DataFrame, int]:
    """``recomputed`` with the ids that ``earlier`` has for the same (customer, month); new months get ids after ``base_id``."""
    old_ids = earlier.select("id", *CUSTOMER_MONTH)
    matched = materialize(recomputed.join(old_ids, CUSTOMER_MONTH, "left"), "recomputed")
    cols = ["id", *MART_BUSINESS_COLS]
    out = matched.filter(F.col("id").isNotNull()).select(*cols)
    new = matched.filter(F.col("id").isNull()).drop("id")
    if new.isEmpty():
        return out, base_id
    fresh, max_id = assign_ids_counted(new, MART_ID_ORDER, "id", base=base_id)
    return out.unionByName(fresh.select(*cols)), max_id


def literal_results(delta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The reference's insert-result and update-result sets (C11, literal).

    ``delta`` is ``delta_literal`` / ``delta_pruned`` output. Returns
    (rows for customers new to the mart, rows for existing customers).
    """
    attrs = [
        "exist_customer_id",
        "mart_row_multiplicity",
        "customer_name",
        "customer_address",
        "customer_birthday",
        "customer_email",
    ]
    # Written once: the three rollups read it instead of each scanning the delta.
    grain = materialize(order_grain(delta, extra_keys=attrs), "literal-grain")
    keys = CUSTOMER_MONTH + attrs
    measures = finish_measures(
        month_measures(grain, keys), multiplicity=F.col("mart_row_multiplicity")
    )
    top_craft = top_craftsman_ties(craftsman_counts(grain)).drop("craftsman_count")
    top_cat = top_category_literal(category_counts(grain, ["customer_id"]))
    joined = measures.join(top_craft, "customer_id").join(top_cat, "customer_id")
    is_new = F.col("exist_customer_id").isNull()
    insert_rows = joined.filter(is_new).select(*MART_BUSINESS_COLS)
    update_rows = joined.filter(~is_new).select(*MART_BUSINESS_COLS)
    return insert_rows, update_rows


def stored_mart(mart: DataFrame) -> DataFrame:
    """The mart in its DDL types (decimal price and median), for writing."""
    return conform(mart, MART)
