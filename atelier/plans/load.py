"""Load job: sources -> star schema.

Order of work, as in the reference script:

1. consolidate the four sources into the staging set (distinct union);
   it is written once to the shared checkpoint folder, since all four merges
   read it;
2. merge the three dimensions on their natural keys (independent; each is
   committed as a new table version);
3. resolve the staging rows to the new dimension ids by natural key (J4);
4. merge the orders on (product, craftsman, customer, created date).

The dimensions are laid out by natural-key bucket and merged without a shuffle of the
table (``sources.clustered``). The fact is laid out by created month. The created date is part of the
order key, so a source row can only match orders of its own month: the merge
reads only the months the source touches, and the commit rewrites only
those months, keeping every other month's folder of the previous version.
"""

from __future__ import annotations

import contextlib
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.operators.consolidate import consolidate_sources, dimension_rows
from atelier.operators.upsert import merge_clustered, merge_upsert, merge_upsert_counted
from atelier.schemas import (
    CRAFTSMAN_KEY,
    CRAFTSMAN_SET,
    CUSTOMER_KEY,
    CUSTOMER_SET,
    D_CRAFTSMAN,
    D_CUSTOMER,
    D_PRODUCT,
    F_ORDER,
    ORDER_KEY,
    ORDER_SET,
    PRICE,
    PRODUCT_KEY,
    PRODUCT_SET,
)
from atelier.functions.conform import exact
from atelier.functions.dates import month_key
from atelier.session import materialize, scratch_dir, scratch_scope
from atelier.sources.clustered import Clustering, clustered_rows, keyed
from atelier.sources.star import check_stamp, commit_star, manifests, star_commits
from atelier.sources.tables import NEWEST, commit_of_version, commit_version, partition_paths, partition_value, read_paths, write_stage

ORDER_MONTH = "order_created_month"


def order_partition():
    """Folder layout of the fact: one folder per created month."""
    return (ORDER_MONTH, month_key("order_created_date"))


def commit_orders(
    df: DataFrame, root: str, max_id: int, months: list[str] | None = None, base=NEWEST, clustering: Clustering | None = None, placed: bool = False
) -> int:
    """Commit an f_order version; with ``months`` only those months are replaced. The other parameters: see ``commit_version``."""
    return commit_version(
        df, root, F_ORDER, max_id=max_id, partition=order_partition(), replace_partitions=months, base=base, exclusive=base is NEWEST,
        clustering=clustering, placed=placed,
    )

CRAFTSMAN_ATTRS = ["craftsman_name", "craftsman_address", "craftsman_birthday", "craftsman_email"]
PRODUCT_ATTRS = ["product_name", "product_description", "product_type", "product_price"]
CUSTOMER_ATTRS = ["customer_name", "customer_address", "customer_birthday", "customer_email"]

DIMENSIONS = {
    "d_craftsman": (D_CRAFTSMAN, "craftsman_id", CRAFTSMAN_ATTRS, CRAFTSMAN_KEY, CRAFTSMAN_SET),
    "d_product": (D_PRODUCT, "product_id", PRODUCT_ATTRS, PRODUCT_KEY, PRODUCT_SET),
    "d_customer": (D_CUSTOMER, "customer_id", CUSTOMER_ATTRS, CUSTOMER_KEY, CUSTOMER_SET),
}


def merge_dimension(
    target: DataFrame, stage: DataFrame, name: str, as_of, base_id: int | None = None
) -> DataFrame:
    """M1-M3: MERGE one dimension from the distinct staging attributes."""
    return merge_dimension_counted(target, stage, name, as_of, base_id)[0]


def merge_dimension_counted(
    target: DataFrame, stage: DataFrame, name: str, as_of, base_id: int | None = None
) -> tuple[DataFrame, int]:
    _, id_col, attrs, key, set_cols = DIMENSIONS[name]
    return merge_upsert_counted(
        target, dimension_rows(stage, attrs), key, set_cols, as_of, id_col, base_id=base_id
    )


#: What the lookups take of a stage.
LOOKUP_COLS = [*PRODUCT_KEY, *CUSTOMER_KEY, *CRAFTSMAN_KEY, "order_created_date", "order_completion_date", "order_status"]


def fact_key_lookup(stage: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Staging rows resolved to surrogate ids by natural key (inner joins).

    A NULL in a natural key drops the row; a duplicated natural key in a
    dimension multiplies it (the quality checks report both). Products come first and craftsmen last:
    each join leaves its key behind, and the widest needn't be shuffled for the others.
    """
    dc = dims["d_craftsman"].select("craftsman_id", *CRAFTSMAN_KEY)
    du = dims["d_customer"].select("customer_id", *CUSTOMER_KEY)
    dp = dims["d_product"].select("product_id", *PRODUCT_KEY)
    src = stage.drop("craftsman_id", "customer_id", "product_id")
    return (
        src.join(dp, PRODUCT_KEY)
        .join(du, CUSTOMER_KEY)
        .join(dc, CRAFTSMAN_KEY)
        .select(
            "product_id",
            "craftsman_id",
            "customer_id",
            "order_created_date",
            "order_completion_date",
            "order_status",
        )
    )


def merge_orders(
    f_order: DataFrame,
    stage: DataFrame,
    dims: dict[str, DataFrame],
    as_of,
    base_id: int | None = None,
) -> DataFrame:
    """M4: MERGE the orders resolved by ``fact_key_lookup``."""
    return merge_upsert(
        f_order, fact_key_lookup(stage, dims), ORDER_KEY, ORDER_SET, as_of, "order_id", base_id=base_id
    )


@dataclass(frozen=True)
class Modes:
    """How a load merges: ``on_conflict`` is 'error' or 'latest', see ``upsert.merge_upsert``; the reference's way is the default."""

    on_conflict: str = "error"
    only_if_changed: bool = False


#: Buckets by natural key of each dimension, and within each month of the fact (0: the fact isn't laid out by
#: key, and its touched months are shuffled). Size them so that a bucket fits a task.
DIMENSION_BUCKETS_CONF = "spark.atelier.dimension.buckets"
ORDER_BUCKETS_CONF = "spark.atelier.order.buckets"
DEFAULT_DIMENSION_BUCKETS = 16


@contextlib.contextmanager
def _target(spark: SparkSession, folders: list[dict], schema, clustering: Clustering):
    """The target's rows in these folders, without an exchange to come where they lie by the key; None if there are none."""
    if not any(f["rows"] for f in folders):
        yield None
    elif clustering.holds(folders):
        with clustered_rows(spark, folders, schema, clustering) as rows:
            yield rows
    else:
        yield read_paths(spark, [f["path"] for f in folders], schema)


def load_dimension(
    spark: SparkSession, stage: DataFrame, dwh_root: str, name: str, as_of, base: dict | None, modes: Modes = Modes()
) -> int:
    """M1-M3 for one dimension: merge with the version of ``base`` and commit the next.

    The table lies in folders by bucket of the natural key. The merge reads the buckets that the source's keys
    fall into, without an exchange, and writes these anew; the folders of all others stay.
    """
    schema, id_col, attrs, key, set_cols = DIMENSIONS[name]
    root = f"{dwh_root}/{name}"
    clustering = Clustering(tuple(key), int(spark.conf.get(DIMENSION_BUCKETS_CONF, str(DEFAULT_DIMENSION_BUCKETS))))
    column, bucket = clustering.partition
    folders = (base or {}).get("folders", [])
    kept_layout = clustering.holds(folders)
    # At most a value for each bucket.
    typed = stage.select(*[F.col(k).cast(schema[k].dataType).alias(k) for k in key])
    touched = [str(r[0]) for r in typed.where(keyed(key)).select(bucket).distinct().collect()] if kept_layout else None
    read = [f for f in folders if touched is None or partition_value(f["path"], column) in touched]
    with _target(spark, read, schema, clustering) as target:
        merged, max_id = merge_clustered(
            target, dimension_rows(stage, attrs), key, set_cols, as_of, id_col, schema, (base or {}).get("max_id") or 0, clustering.buckets,
            on_conflict=modes.on_conflict, only_if_changed=modes.only_if_changed,
        )
        return commit_version(
            merged, root, schema, max_id=max_id, base=base, exclusive=False, partition=clustering.partition, replace_partitions=touched,
            clustering=clustering, placed=kept_layout,
        )


def run_load(spark: SparkSession, sources: dict[str, DataFrame], dwh_root: str, as_of, modes: Modes = Modes()) -> dict[str, int]:
    """Run the whole load; returns the committed version per table.

    The three dimension merges are independent, so they are submitted as
    concurrent Spark jobs from three driver threads; the order merge waits
    for all of them (it resolves keys against the new dimension versions).

    Every table is read at the version that the newest manifest names, and the new
    manifest is committed last. Until then readers see the previous load whole. A
    failed load can be repeated with the same ``as_of``: the versions it
    has committed are behind no manifest, so the repetition neither reads nor extends
    them. Of two loads at once one commits, the other raises ``CommitConflict``.
    """
    number = (manifests(spark, dwh_root) or [0])[-1] + 1
    check_stamp(spark, dwh_root, as_of)
    base = star_commits(spark, dwh_root, number - 1) if number > 1 else None
    with scratch_scope(spark):
        consolidated = exact(consolidate_sources(sources), "product_price", PRICE)
        stage = write_stage(consolidated, scratch_dir(spark, "tmp-sources"))
        with ThreadPoolExecutor(max_workers=len(DIMENSIONS)) as pool:
            futures = {
                name: pool.submit(copy_context().run, load_dimension, spark, stage, dwh_root, name, as_of, (base or {}).get(name), modes)
                for name in DIMENSIONS
            }
            named = {name: f.result() for name, f in futures.items()}
        dims = {
            name: read_paths(spark, commit_of_version(spark, f"{dwh_root}/{name}", v)["paths"], DIMENSIONS[name][0])
            for name, v in named.items()
        }
        named["f_order"] = load_orders(
            spark, stage, dims, f"{dwh_root}/f_order", as_of, (base or {}).get("f_order"), modes
        )
        commit_star(spark, dwh_root, as_of, named, number)
    return named


def load_orders(
    spark: SparkSession, stage: DataFrame, dims: dict[str, DataFrame], root: str, as_of, base: dict | None, modes: Modes = Modes(),
    buckets: int | None = None,
) -> int:
    """M4 on the month-partitioned fact: read, merge and rewrite touched months only.

    With a number of ``buckets``, by default the session's, the files of a month lie by the order key, and its rows
    aren't shuffled.
    """
    lookup = materialize(fact_key_lookup(stage, dims), "order-lookup")
    months = [r[0] for r in lookup.select(month_key("order_created_date")).distinct().collect()]
    base_id = (base or {}).get("max_id") or 0
    how = {"on_conflict": modes.on_conflict, "only_if_changed": modes.only_if_changed}
    if buckets is None:
        buckets = int(spark.conf.get(ORDER_BUCKETS_CONF, "0"))
    if not buckets:
        target = read_paths(spark, partition_paths(base, ORDER_MONTH, months), F_ORDER)
        merged, max_id = merge_upsert_counted(target, lookup, ORDER_KEY, ORDER_SET, as_of, "order_id", base_id=base_id, **how)
        return commit_orders(merged, root, max_id, months, base)
    clustering = Clustering(tuple(ORDER_KEY), buckets)
    months = [m for m in months if m is not None]  # orders without a date match nothing: theirs is only added to
    paths = set(partition_paths(base, ORDER_MONTH, months))
    folders = [f for f in (base or {}).get("folders", []) if f["path"] in paths]
    with _target(spark, folders, F_ORDER, clustering) as target:
        merged, max_id = merge_clustered(target, lookup, ORDER_KEY, ORDER_SET, as_of, "order_id", F_ORDER, base_id, buckets, **how)
        return commit_orders(merged, root, max_id, months, base, clustering, placed=clustering.holds(folders))
