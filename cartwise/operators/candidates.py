"""Candidate generation: who could be offered what.

Ties are broken by id everywhere, so every result is repeatable.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartwise import config
from cartwise.functions.expressions import seeded_key
from cartwise.functions.joins import grid_join, sized_lookup
from cartwise.operators.windows import lookback_window
from cartwise.session import materialize

TOP_CATEGORIES = 3


def cap_key(cap_mode: str) -> Column:
    """What a cap per group keeps first: lowest ids, or a seeded sample of the ids."""
    if cap_mode == "id":
        return F.col("item_id")
    if cap_mode == "hash":
        return seeded_key(F.col("item_id"), config.RANDOM_STATE)
    raise ValueError(f"Unknown cap mode: {cap_mode}")


def first_n(df: DataFrame, group: list[str], order: list, n: int | None) -> DataFrame:
    """Rows ``<= n`` per group, all if n is None. Spark keeps only n rows per group and
    task before the shuffle, so a hot group sends n rows per task, not all of them."""
    if n is None:
        return df
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


# --- co-occurrence ----------------------------------------------------------


def build_item_cooccurrence(
    transactions: DataFrame, key_cols: list[str], block_items: int = 1000
) -> DataFrame:
    """Baskets in which two items occur together: ``itemA < itemB``, ``cooc_count``.

    Each basket joins itself on its key, the inequality carried in the join, and
    pairs are counted map-side. A basket of more than ``block_items`` distinct
    items is cut into hash blocks and joined block by block, so its pairs are
    made by many tasks instead of one; every pair is still made exactly once.
    """
    baskets = (
        transactions.select(*key_cols, "item_id")
        .dropna(subset=[*key_cols, "item_id"])
        .distinct()
    )
    large = (
        baskets.groupBy(*key_cols)
        .agg(F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > block_items)
        .withColumn("__blocks", F.ceil(F.col("__n") / F.lit(block_items)).cast("int"))
        .drop("__n")
    )
    small_baskets = baskets.join(large, key_cols, "left_anti")
    left = small_baskets.withColumnRenamed("item_id", "itemA")
    right = small_baskets.withColumnRenamed("item_id", "itemB")
    pairs = left.join(right, key_cols).where("itemA < itemB").select("itemA", "itemB")

    # Block pairs (i, j), i <= j: an item of block b takes part in the pairs that
    # contain b, on the low side, the high side, or both.
    blocked = baskets.join(large, key_cols).withColumn(
        "__b", F.pmod(F.xxhash64("item_id"), F.col("__blocks")).cast("int")
    )
    others = F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))
    sides = blocked.withColumn("__o", others).select(
        *key_cols,
        F.col("item_id"),
        "__b",
        F.least("__b", "__o").alias("__i"),
        F.greatest("__b", "__o").alias("__j"),
    )
    low = sides.where("__b = __i").withColumnRenamed("item_id", "x").drop("__b")
    high = sides.where("__b = __j").withColumnRenamed("item_id", "y").drop("__b")
    block_pairs = (
        low.join(high, [*key_cols, "__i", "__j"])
        .where("__i < __j or x < y")
        .select(F.least("x", "y").alias("itemA"), F.greatest("x", "y").alias("itemB"))
    )
    return (
        pairs.unionByName(block_pairs)
        .groupBy("itemA", "itemB")
        .agg(F.count(F.lit(1)).alias("cooc_count"))
    )


def strongest_pairs(cooccurrence: DataFrame, n: int) -> DataFrame:
    """The ``n`` pairs seen together most often."""
    return cooccurrence.orderBy(F.desc("cooc_count"), "itemA", "itemB").limit(n)


def generate_candidates_from_cooc(
    customer_hist_items: DataFrame,
    cooccurrence: DataFrame,
    topn_per_customer: int = config.MAX_CANDIDATES_PER_USER,
    rank_by: str = "count",
) -> DataFrame:
    """Items that occur together with what a customer bought, best ``topn`` each.

    Both directions of a pair are laid out once, so one join serves them. The
    join is the multiplicative step (buyers of an item times its neighbours): an
    item that many bought or that has many neighbours is cut on both sides into
    the cells of a grid. Bought items are not removed here.
    ``rank_by="id"`` takes the lowest ids instead of the highest total counts.
    """
    if rank_by not in ("count", "id"):
        raise ValueError(f"Unknown ranking: {rank_by}")
    both_ways = F.array(
        F.struct(F.col("itemA").alias("item_id"), F.col("itemB").alias("candidate")),
        F.struct(F.col("itemB").alias("item_id"), F.col("itemA").alias("candidate")),
    )
    # Both sides are read twice, for their sizes and for the join.
    bought = materialize(customer_hist_items.select("customer_id", "item_id"), "bought")
    pairs = materialize(cooccurrence.select("itemA", "itemB", "cooc_count"), "cooccurrence")
    totals = (
        grid_join(
            bought,
            pairs.select("cooc_count", F.inline(both_ways)),
            "item_id",
            ["customer_id"],
            ["candidate"],
        )
        .groupBy("customer_id", "candidate")
        .agg(F.sum("cooc_count").alias("total"))
    )
    order = [F.desc("total"), F.asc("candidate")] if rank_by == "count" else [F.asc("candidate")]
    return first_n(totals, ["customer_id"], order, topn_per_customer).select(
        "customer_id", F.col("candidate").alias("item_id")
    )


# --- look-back strategies ---------------------------------------------------


def popular_items(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` items with the most rows."""
    return (
        rows.where(F.col("item_id").isNotNull())
        .groupBy("item_id")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.desc("n_rows"), "item_id")
        .limit(n)
    )


def _third(budget: int | None) -> int | None:
    return None if budget is None else budget // 3


def _item_list(rows: DataFrame) -> Column:
    """The ids of a table of bounded size as one array value. Attaching the value
    to every customer takes neither a join nor a shuffle."""
    return rows.agg(F.sort_array(F.collect_list("item_id"))).scalar()


def user_history_candidates(
    transactions: DataFrame,
    observation_date: datetime,
    lookback_days: int,
    max_candidates: int | None,
    cap_mode: str = "id",
) -> DataFrame:
    """Pairs bought in the look-back window, at most ``max_candidates`` per customer (None: all)."""
    pairs = (
        lookback_window(transactions, observation_date, lookback_days)
        .select("customer_id", "item_id")
        .where(F.col("item_id").isNotNull())
        .distinct()
    )
    return first_n(pairs, ["customer_id"], [cap_key(cap_mode), "item_id"], max_candidates)


def popular_candidates(
    transactions: DataFrame,
    users: DataFrame,
    observation_date: datetime,
    lookback_days: int,
    max_candidates: int,
) -> DataFrame:
    """The most bought items of the look-back window for every customer."""
    top = popular_items(
        lookback_window(transactions, observation_date, lookback_days), max_candidates
    )
    return users.select("customer_id", F.explode(_item_list(top)).alias("item_id"))


def _category_lists(
    transactions: DataFrame,
    items: DataFrame,
    observation_date: datetime,
    lookback_days: int,
    max_candidates: int | None,
    rank_by: str,
    top_categories: int | None = TOP_CATEGORIES,
) -> DataFrame:
    """Per (customer, favourite category): the popular items of that category.

    At most ``top_categories`` rows per customer (None: all its categories) and
    ``max_candidates // 3`` ids per row (None: all items bought in the category).
    The lists are one stored table, sent to where the customers are if it is small;
    otherwise customers are looked up split, as most may have one favourite.
    """
    if rank_by not in ("count", "id"):
        raise ValueError(f"Unknown ranking: {rank_by}")
    window = lookback_window(transactions, observation_date, lookback_days).select(
        "customer_id", "item_id"
    )
    # Counting (customer, item) first lets both counts below start from
    # combined rows.
    bought = (
        window.groupBy("customer_id", "item_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(items.select("item_id", "category"), "item_id")
        .where(F.col("category").isNotNull())
    )
    by_customer = bought.groupBy("customer_id", "category").agg(F.sum("n").alias("n"))
    by_item = bought.groupBy("category", "item_id").agg(F.sum("n").alias("n"))
    count_first = [F.desc("n")] if rank_by == "count" else []
    favourites = first_n(
        by_customer, ["customer_id"], [*count_first, F.asc("category")], top_categories
    )
    best_items = (
        first_n(by_item, ["category"], [*count_first, F.asc("item_id")], _third(max_candidates))
        .groupBy("category")
        .agg(F.collect_list("item_id").alias("category_items"))
    )
    return sized_lookup(
        favourites.select("customer_id", "category"),
        materialize(best_items, "category-items"),
        ["category"],
        ["customer_id"],
        "inner",
    )


def category_candidates(
    transactions: DataFrame,
    items: DataFrame,
    observation_date: datetime,
    lookback_days: int,
    max_candidates: int | None,
    rank_by: str = "count",
    top_categories: int | None = TOP_CATEGORIES,
) -> DataFrame:
    """Popular items of each customer's favourite categories, three unless told otherwise.

    Three categories of ``max_candidates // 3`` items never exceed
    ``max_candidates``, so no further cap is needed: it could not bind.
    """
    lists = _category_lists(
        transactions, items, observation_date, lookback_days, max_candidates, rank_by, top_categories
    )
    return lists.select("customer_id", F.explode("category_items").alias("item_id"))


def hybrid_candidates(
    transactions: DataFrame,
    items: DataFrame,
    users: DataFrame,
    observation_date: datetime,
    lookback_days: int,
    max_candidates: int | None,
    cap_mode: str = "id",
    rank_by: str = "count",
    top_categories: int | None = TOP_CATEGORIES,
) -> DataFrame:
    """Union of the three strategies, each with a third of the budget (None: no limit but
    for popular items, which every customer would get).

    The three parts are brought together as arrays per customer, each of at most
    ``max_candidates // 3`` ids, so duplicates go without shuffling the pairs.
    The thirds add up to no more than ``max_candidates``.
    """
    third = _third(max_candidates)
    history = (
        user_history_candidates(transactions, observation_date, lookback_days, third, cap_mode)
        .groupBy("customer_id")
        .agg(F.collect_list("item_id").alias("ids"))
    )
    categories = (
        _category_lists(
            transactions, items, observation_date, lookback_days, third, rank_by, top_categories
        )
        .groupBy("customer_id")
        .agg(F.flatten(F.collect_list("category_items")).alias("ids"))
    )
    window = lookback_window(transactions, observation_date, lookback_days)
    top = popular_items(window, config.TOP_K_POPULAR_ITEMS if third is None else third)
    popular = users.select("customer_id").distinct().withColumn("ids", _item_list(top))
    merged = (
        popular.withColumnRenamed("ids", "p")
        .join(history.withColumnRenamed("ids", "h"), "customer_id", "full")
        .join(categories.withColumnRenamed("ids", "c"), "customer_id", "full")
    )
    none = F.array().cast("array<bigint>")
    parts = [F.coalesce(F.col(c), none) for c in "phc"]
    return merged.select(
        "customer_id", F.explode(F.array_distinct(F.concat(*parts))).alias("item_id")
    )


def generate_candidates(
    transactions: DataFrame,
    items: DataFrame,
    users: DataFrame,
    observation_date: datetime,
    strategy: str = "hybrid",
    lookback_days: int = config.DEFAULT_LOOKBACK_DAYS,
    max_candidates_per_user: int | None = 100,
    cap_mode: str = "id",
    rank_by: str = "count",
    top_categories: int | None = TOP_CATEGORIES,
) -> DataFrame:
    """Candidates by strategy: user_history, popular_items, category_based or hybrid.

    ``max_candidates_per_user`` is the budget, None for no limit (popular items need one);
    ``cap_mode`` chooses what a cap keeps of a customer's history (``id``, ``hash``), ``rank_by``
    what it keeps of a category (``count``, ``id``), ``top_categories`` the favourites looked at.
    """
    window = (observation_date, lookback_days, max_candidates_per_user)
    match strategy:
        case "user_history":
            return user_history_candidates(transactions, *window, cap_mode)
        case "popular_items":
            if max_candidates_per_user is None:
                raise ValueError("popular_items needs max_candidates_per_user")
            return popular_candidates(transactions, users, *window)
        case "category_based":
            return category_candidates(transactions, items, *window, rank_by, top_categories)
        case "hybrid":
            return hybrid_candidates(
                transactions, items, users, *window, cap_mode, rank_by, top_categories
            )
    raise ValueError(f"Unknown strategy: {strategy}")


def filter_already_purchased(
    candidates: DataFrame,
    transactions: DataFrame,
    observation_date: datetime,
    lookback_days: int = config.RECENT_PURCHASE_DAYS,
) -> DataFrame:
    """Candidates without the pairs bought in the look-back window."""
    recent = (
        lookback_window(transactions, observation_date, lookback_days)
        .select("customer_id", "item_id")
        .distinct()
    )
    return candidates.join(recent, ["customer_id", "item_id"], "left_anti")
