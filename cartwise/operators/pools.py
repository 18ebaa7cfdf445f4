"""Candidate pools of the training table: bounded arrays, worked out per category set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise import config
from cartwise.functions.joins import SHARES, sized_lookup
from cartwise.operators.candidates import cap_key, first_n
from cartwise.session import broadcast_limit, materialize, stored_bytes

ATTRIBUTES = ("brand", "age_group", "category")


def category_set() -> Column:
    """The sorted categories a customer bought from; the key of its candidate pool."""
    return F.array_sort(F.map_keys("category_rows")).alias("category_set")


def category_lists(items: DataFrame, cap: int | None, cap_mode: str = "id") -> DataFrame:
    """One row per category, stored: ``entries``, its first ``cap`` items in order, and
    ``marks``, the entries at places 1, 2, 4, ... each with the number of entries since the
    last mark."""
    catalogue = items.select("item_id", *ATTRIBUTES).where(F.col("item_id").isNotNull())
    # The sort key first, so that entries compare by (key, id).
    entry = F.struct(cap_key(cap_mode).alias("key"), "item_id", *ATTRIBUTES)
    first = first_n(
        catalogue.where(F.col("category").isNotNull()).withColumn("entry", entry),
        ["category"],
        ["entry"],
        cap,
    )
    lists = first.groupBy("category").agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    # A place is a power of two if it shares no bit with the place before.
    marks = """transform(
        filter(sequence(1, size(entries)), p -> (p & (p - 1)) = 0),
        p -> struct(entries[p - 1].key AS key, entries[p - 1].item_id AS item_id, p - p div 2 AS n))"""
    return materialize(lists.withColumn("marks", F.expr(marks)), "category-lists")


def merged_lists(sets: DataFrame, lists: DataFrame, cap: int | None) -> DataFrame:
    """(set_id, category_pool): the first ``cap`` entries of the categories of each set.

    A threshold merge in two steps. The marks of a set's categories, in order, say how many
    entries lie at or before a mark at least; the first mark that ``cap`` entries are known
    to reach is the set's limit. Only entries up to it are fetched. A category has less than
    twice as many of them as its marks told, so that a set fetches fewer than 4 x ``cap``
    entries, however many categories it has, in place of ``cap`` for each.
    ``sets`` is (set_id, category_set).
    """
    members = sets.select("set_id", F.explode("category_set").alias("category"))
    if cap is None:
        limits = sets.withColumn("limit", F.lit(None).cast(_place_type(lists)))
    else:
        marked = sized_lookup(members, lists, ["category"], ["set_id"], "inner")
        limit = f"""aggregate(
            array_sort(flatten(collect_list(marks))),
            struct(0L AS n, cast(null AS {_place_type(lists)}) AS limit),
            (told, m) -> if(told.n >= {cap}, told, struct(told.n + m.n AS n, struct(m.key AS key, m.item_id AS item_id) AS limit)),
            told -> if(told.n >= {cap}, told.limit, null))"""
        limits = marked.groupBy("set_id").agg(F.expr(limit).alias("limit"))
        limits = sets.join(limits, "set_id")
    wanted = limits.select("set_id", "limit", F.explode("category_set").alias("category"))
    fetched = sized_lookup(wanted, lists, ["category"], ["set_id"], "inner")
    near = F.expr("filter(entries, e -> limit IS NULL OR struct(e.key AS key, e.item_id AS item_id) <= limit)")
    pool = F.array_sort(F.flatten(F.collect_list("near")))
    return (
        fetched.select("set_id", near.alias("near"))
        .where(F.size("near") > 0)
        .groupBy("set_id")
        .agg((pool if cap is None else F.slice(pool, 1, cap)).alias("category_pool"))
    )


def _place_type(lists: DataFrame) -> str:
    entry = lists.schema["entries"].dataType.elementType
    key, item = (entry[c].dataType.simpleString() for c in ("key", "item_id"))
    return f"struct<key:{key},item_id:{item}>"


def category_set_pools(
    customers: DataFrame,
    dimension: DataFrame,
    items: DataFrame,
    top_n: int = config.TOP_K_POPULAR_ITEMS,
    cap: int | None = config.MAX_CANDIDATES_PER_USER,
    cap_mode: str = "id",
) -> DataFrame:
    """One row per distinct ``category_set`` of ``customers``, given the counted items
    of the history (``dimension``) and the catalogue:

    ``category_pool``  the first ``cap`` items of the set's categories (None: all), in order;
    ``pool_end``       the last entry of that pool;
    ``top_items``      the ``top_n`` popular items, the same on every row;
    ``customers``      how many customers have the set.

    Customers with the same categories share a pool, so the work is by sets instead of
    customers x catalogue. Each category is cut to ``cap`` items first: an item beyond its
    own category's first ``cap`` cannot be among the first ``cap`` of a union. A set's
    pool is merged from its categories' lists up to a limit (:func:`merged_lists`). Every
    array holds at most ``cap`` or ``top_n`` entries. Written to the shared folder, the
    table has a known size, from which its lookup is chosen (:func:`with_pools`).
    """
    lists = category_lists(items, cap, cap_mode)
    # The set is a long key: members of a set carry a number in its place.
    sets = customers.groupBy("category_set").agg(F.count(F.lit(1)).alias("customers"))
    sets = materialize(sets.withColumn("set_id", F.monotonically_increasing_id()), "category-sets")
    pools = merged_lists(sets.select("set_id", "category_set"), lists, cap)
    last = F.element_at("category_pool", -1)
    entry = F.struct(cap_key(cap_mode).alias("key"), "item_id", *ATTRIBUTES)
    top = (
        dimension.where(F.col("item_id").isNotNull())
        .orderBy(F.desc("popularity"), "item_id")
        .limit(top_n)
        .agg(F.sort_array(F.collect_list(entry)).alias("top_items"))
    )
    keyed = sets.join(pools, "set_id", "left").select(
        "category_set",
        "customers",
        "category_pool",
        F.when(F.col("category_pool").isNotNull(), F.struct(last["key"].alias("key"), last["item_id"].alias("item_id"))).alias("pool_end"),
        top.scalar().alias("top_items"),
    )
    return materialize(keyed, "category-pools")


def with_pools(
    customers: DataFrame, pools: DataFrame, columns: list[str], partitions: int | None = None
) -> DataFrame:
    """Customers with ``columns`` of their set's pool. A set that many customers have is
    divided over tasks where the pools are too many to be sent to all."""
    total = pools.agg(F.sum("customers")).scalar()
    hot = pools.where(F.col("customers") * SHARES > total).select("category_set")
    table = pools.select("category_set", *columns)
    table._stored_at = pools._stored_at
    return sized_lookup(
        customers, table, ["category_set"], ["customer_id"], "inner", hot=hot, partitions=partitions
    )


def is_sent(pools: DataFrame) -> bool:
    """Whether :func:`with_pools` sends the pools to the customers, which leaves these where they are."""
    return stored_bytes(pools) <= broadcast_limit(pools.sparkSession)


def _in_pool(category: Column, key: Column, item_id: Column) -> Column:
    """Pool membership without searching the pool: it holds the items of the
    customer's categories up to its last entry."""
    own = F.try_element_at(F.col("category_rows"), category).isNotNull()
    place = F.struct(key.alias("key"), item_id.alias("item_id"))
    return F.coalesce(own & (place <= F.col("pool_end")), F.lit(False))


def top_item_ids(pools: DataFrame) -> Column:
    """The popular items as one array value, the same for every customer."""
    return pools.select("top_items.item_id").limit(1).scalar()


def is_generated(top_ids: Column, cap_mode: str = "id") -> Column:
    """Whether a row (item columns next to the customer's ``category_rows`` and
    ``pool_end``) is a generated candidate. Popular items go to customers with
    history only."""
    popular = F.col("category_rows").isNotNull() & F.array_contains(top_ids, F.col("item_id"))
    in_pool = _in_pool(F.col("category"), cap_key(cap_mode), F.col("item_id"))
    return F.coalesce(popular, F.lit(False)) | in_pool


def unfold_pools(pools: DataFrame, keep: list[str]) -> DataFrame:
    """One row per generated pair: the ``keep`` columns and the item's attributes.

    A popular item that is also in the pool is listed once. A narrow step: the
    pairs are made where the customer row is.
    """
    entries = F.when(F.col("category_pool").isNull(), F.col("top_items")).otherwise(
        F.concat("top_items", "category_pool")
    )
    # The outer form keeps the optimizer from evaluating the array a second time
    # for a "not empty" filter; the null row of an empty array is dropped below.
    flat = pools.select(
        *keep,
        *[c for c in ("category_rows", "pool_end") if c not in keep],
        F.size("top_items").alias("__tops"),
        F.posexplode_outer(entries).alias("__place", "__e"),
    )
    in_pool = _in_pool(F.col("__e.category"), F.col("__e.key"), F.col("__e.item_id"))
    listed_again = (F.col("__place") < F.col("__tops")) & in_pool
    return flat.where(F.col("__e.item_id").isNotNull() & ~listed_again).select(
        *keep, "__e.item_id", *[f"__e.{a}" for a in ATTRIBUTES]
    )
