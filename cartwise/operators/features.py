"""Customer features, candidate features and the training table.

One row per customer (the *profile*) holds everything the features need: the
behavioural figures X4..X13 and three small maps, attribute value -> number of
purchases. The profile comes from one aggregation of the history.
Candidate pairs never shuffle for their features: they are unfolded from arrays
of at most ``top_n + cap`` entries on the profile row, and X1..X3 are lookups in
its maps. Given pairs move to their customers once, those that were made by
customer not at all; for the full table and labels others are packed as lists.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise import config
from cartwise.functions.expressions import ts, whole_days
from cartwise.functions.joins import hot_keys, lookup_join
from cartwise.operators.pools import (
    ATTRIBUTES,
    category_set,
    category_set_pools,
    is_generated,
    is_sent,
    top_item_ids,
    unfold_pools,
    with_pools,
)
from cartwise.operators.windows import time_window
from cartwise.session import broadcast_limit, fan_out_partitions, materialize, materialize_by, stored_bytes
from cartwise.sources.schemas import TS_COL

POOL_COLUMNS = ["category_pool", "pool_end", "top_items"]
#: Items in one list of given pairs.
LIST = 4096
#: Pairs that one partition of a table dealt by customer aims at: so many are sorted in memory.
PAIRS_PER_PART = 1_000_000
#: Items above 1/FREQUENT of the pairs, fewer than this, are sent where the catalogue is too large.
FREQUENT = 10_000
POWER_USER_MORE_THAN = 13
NEW_CUSTOMER_FEWER_THAN = 3

# What a customer's rows are counted by; each is one grouping set.
_TIME = TS_COL
ALL_GROUPINGS = (*ATTRIBUTES, _TIME)


# --- customer level ---------------------------------------------------------


def item_dimension(hist: DataFrame, items: DataFrame) -> DataFrame:
    """Items of the history with their row count and attributes, written once.

    It is as large as the catalogue. Being a stored table it has a known size:
    Spark broadcasts it to the history if it is small and otherwise shuffles,
    and never has to shuffle the history just to find out.
    """
    counts = hist.groupBy("item_id").agg(F.count(F.lit(1)).alias("popularity"))
    return materialize(
        counts.join(items.select("item_id", *ATTRIBUTES), "item_id", "left"), "item-dimension"
    )


def customer_activity(hist: DataFrame) -> DataFrame:
    """Per customer: rows, distinct purchase times, last time, rows per weekday.

    The one distinct count is planned as a second level keyed on (customer,
    time), so a customer with very many rows is combined before and spread over
    the shuffle.
    """
    by_day = ", ".join(f"count_if(weekday({TS_COL}) = {d})" for d in range(7))
    return hist.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(TS_COL).alias("n_times"),
        F.max(TS_COL).alias("last_time"),
        F.expr(f"array({by_day})").alias("weekday_rows"),
    )


def customer_profile(
    hist: DataFrame, dimension: DataFrame, groupings: tuple[str, ...] = ALL_GROUPINGS
) -> DataFrame:
    """One row per customer: counts by brand, age group, category and purchase time,
    and the figures that follow from them.

    The groupings are the sets of one ``GROUPING SETS`` aggregate: the history is
    read and joined to the items once, and combined map-side before its only
    large shuffle. A null attribute is a group of its own for the ratios and
    diversities, and absent from the lookup maps because null never equals a
    candidate's attribute. The maps hold one entry per distinct attribute value,
    however many rows a customer has. ``dimension`` is the item table, or
    :func:`item_dimension` where the mean popularity is wanted.
    """
    attributes = [g for g in groupings if g != _TIME]
    weighted = "popularity" in dimension.columns
    looked_up = ["popularity"] if weighted else []
    rows = hist.select("customer_id", "item_id", *[g for g in groupings if g == _TIME]).join(
        dimension.select("item_id", *attributes, *looked_up), "item_id", "left"
    )
    counted = [F.grouping_id().alias("grouping"), F.count(F.lit(1)).alias("n")]
    if weighted:
        counted.append(F.sum(F.col("popularity").cast("double")).alias("popularity"))
    counts = rows.groupingSets(
        [["customer_id", g] for g in groupings], "customer_id", *groupings
    ).agg(*counted)

    def of(grouping: str) -> str:
        # grouping_id() has a bit set for every grouping column left out of a set.
        place = len(groupings) - 1 - groupings.index(grouping)
        return f"grouping = {(1 << len(groupings)) - 1 - (1 << place)}"

    every_row = of(groupings[0])
    figures = {"n_rows": f"sum(CASE WHEN {every_row} THEN n END)"}
    if weighted:
        figures["popularity_sum"] = f"sum(CASE WHEN {every_row} THEN popularity END)"
    for a in attributes:
        entry = f"CASE WHEN {of(a)} AND {a} IS NOT NULL THEN struct({a}, n) END"
        figures[f"{a}_rows"] = f"map_from_entries(collect_list({entry}))"
        figures[f"n_{a}"] = f"count_if({of(a)})"
        figures[f"top_{a}_rows"] = f"max(CASE WHEN {of(a)} THEN n END)"
    if _TIME in groupings:
        on_day = f"CASE WHEN {of(_TIME)} AND weekday({_TIME}) = {{}} THEN n ELSE 0 END"
        by_day = ", ".join(f"sum({on_day.format(d)})" for d in range(7))
        figures["n_times"] = f"count_if({of(_TIME)})"
        figures["last_time"] = f"max(CASE WHEN {of(_TIME)} THEN {_TIME} END)"
        figures["weekday_rows"] = f"array({by_day})"
    aggregates = [F.expr(sql).alias(name) for name, sql in figures.items()]
    return counts.groupBy("customer_id").agg(*aggregates)


def _x4(end_hist: datetime) -> Column:
    return whole_days(F.col("last_time"), ts(end_hist)).alias("X4_days_since_last_purchase")


def _rows_per_time() -> Column:
    return F.col("n_rows") / F.greatest(F.col("n_times"), F.lit(1))


def _x5() -> Column:
    return _rows_per_time().alias("X5_purchase_frequency")


def _x6() -> Column:
    return (F.col("n_rows") > POWER_USER_MORE_THAN).cast("int").alias("X6_is_power_user")


def _x7() -> Column:
    return _rows_per_time().alias("X7_avg_items_per_purchase")


def _x8() -> Column:
    return (F.col("top_brand_rows") / F.col("n_rows")).alias("X8_top_brand_ratio")


def _x9() -> Column:
    return F.col("n_brand").alias("X9_brand_diversity")


def _x10() -> Column:
    return (F.col("n_category") / F.col("n_rows")).alias("X10_category_diversity_score")


def _x11() -> Column:
    # The first weekday that reaches the maximum, hence the lower day on ties.
    best = F.array_max("weekday_rows")
    return F.array_position("weekday_rows", best).cast("int").alias("X11_purchase_day_mode")


def _x12() -> Column:
    return (F.col("n_rows") < NEW_CUSTOMER_FEWER_THAN).cast("int").alias("X12_is_new_customer")


def _x13() -> Column:
    mean = F.col("popularity_sum") / F.col("n_rows")
    return F.coalesce(mean, F.lit(0.0)).alias("X13_avg_item_popularity")


def recency_features(hist: DataFrame, end_hist: datetime) -> DataFrame:
    """X4: whole days from the last purchase to the end of the history window."""
    return customer_activity(hist).select("customer_id", _x4(end_hist))


def frequency_features(hist: DataFrame) -> DataFrame:
    """X5 (rows per distinct purchase time) and X6 (more than 13 rows)."""
    return customer_activity(hist).select("customer_id", _x5(), _x6())


def monetary_features(hist: DataFrame) -> DataFrame:
    """X7. The same formula as X5, hence collinear with it."""
    return customer_activity(hist).select("customer_id", _x7())


def brand_loyalty_features(hist: DataFrame, items: DataFrame) -> DataFrame:
    """X8 (share of the most bought brand) and X9 (number of brands)."""
    return customer_profile(hist, items, ("brand",)).select("customer_id", _x8(), _x9())


def category_diversity_features(hist: DataFrame, items: DataFrame) -> DataFrame:
    """X10: number of categories over rows."""
    return customer_profile(hist, items, ("category",)).select("customer_id", _x10())


def temporal_features(hist: DataFrame) -> DataFrame:
    """X11: the ISO weekday with the most rows."""
    return customer_activity(hist).select("customer_id", _x11())


def new_customer_features(hist: DataFrame) -> DataFrame:
    """X12 alone (fewer than 3 rows): a count by customer, without the items."""
    return customer_activity(hist).select("customer_id", _x12())


def cold_start_features(hist: DataFrame, items: DataFrame) -> DataFrame:
    """X12 (fewer than 3 rows) and X13 (mean popularity of the bought items)."""
    profile = customer_profile(hist, item_dimension(hist, items), ("category",))
    return profile.select("customer_id", _x12(), _x13())


def profile_features(end_hist: datetime) -> list[Column]:
    """X4..X13 as columns over :func:`customer_profile`."""
    return [
        _x4(end_hist),
        _x5(),
        _x6(),
        _x7(),
        _x8(),
        _x9(),
        _x10(),
        _x11(),
        _x12(),
        _x13(),
    ]


def customer_features(hist: DataFrame, items: DataFrame, end_hist: datetime) -> DataFrame:
    """One row per customer with X4..X13."""
    profile = customer_profile(hist, item_dimension(hist, items))
    return profile.select("customer_id", *profile_features(end_hist))


# --- pair level -------------------------------------------------------------


def match_features() -> list[Column]:
    """X1..X3: how often the customer bought the candidate's brand, age group, category."""
    names = config.FEATURE_COLUMNS[:3]
    return [
        F.coalesce(F.try_element_at(F.col(f"{a}_rows"), F.col(a)), F.lit(0)).cast("long").alias(x)
        for a, x in zip(ATTRIBUTES, names, strict=True)
    ]


def _zero_filled(features: list[str]) -> list[Column]:
    return [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in features]


def _blocks(*tables: DataFrame) -> int:
    """Into how many parts each customer's items are cut, so that a list has about LIST
    entries at most: one part, unless some customer has more rows than that."""
    most = [
        t.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] for t in tables
    ]
    return -(-max(n or 1 for n in most) // LIST)


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("block")


def pack_pairs(pairs: DataFrame, blocks: int) -> DataFrame:
    """``(customer_id, block, pairs)``: a customer's pairs as one list of rows, each with all
    other columns of ``pairs``. The one exchange that given pairs take."""
    rest = [c for c in pairs.columns if c != "customer_id"]
    return (
        pairs.select("customer_id", _block(blocks), F.struct(*rest).alias("pair"))
        .groupBy("customer_id", "block")
        .agg(F.collect_list("pair").alias("pairs"))
    )


def _with_attributes(pairs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Pairs with their items' attributes, or the pairs as they are and a table of items that
    is small enough to be sent to where the pairs will be. A hot item is split over tasks."""
    table = materialize(items.select("item_id", *ATTRIBUTES).where(F.col("item_id").isNotNull()), "items")
    if stored_bytes(table) <= broadcast_limit(pairs.sparkSession):
        return pairs, F.broadcast(table)
    return lookup_join(pairs, table, ["item_id"], ["customer_id"]), None


def unpack_pairs(packed: DataFrame, keep: list[str], sent: DataFrame | None = None) -> DataFrame:
    """One row per pair again, where its customer is, with the attributes of ``sent``."""
    flat = packed.select("customer_id", *keep, F.inline("pairs"))
    return flat if sent is None else flat.join(sent, "item_id", "left")


def _by_customer(candidates: DataFrame) -> bool:
    return getattr(candidates, "_dealt_by", ("",))[0] == "customer_id"


def _stored_pairs(candidates: DataFrame, columns: list[str]) -> DataFrame:
    """The pairs stored: by customer, and so unmoved, if they were made by customer."""
    pairs = candidates.select(*columns)
    if not _by_customer(candidates):
        return materialize(pairs, "pairs")
    dealt = candidates._dealt_by
    stored = materialize_by(pairs, "pairs", *dealt)
    stored._dealt_by = dealt
    return stored


def _at_customers(rows: DataFrame, customers: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of the stored ``pairs`` with their customer's columns (one row per customer).

    Pairs that lie by customer stay there: a part has a bounded number of them, hence of
    customers, and those meet it in memory. Other rows move once, hot customers split.
    """
    if _by_customer(rows):
        return rows.join(customers.hint("shuffle_hash"), "customer_id", "left")
    hot = materialize(hot_keys(pairs, ["customer_id"]), "hot-customers")
    return lookup_join(rows, customers, ["customer_id"], ["item_id"], hot=hot)


def candidate_features(candidates: DataFrame, hist: DataFrame, items: DataFrame) -> DataFrame:
    """X1..X3 for given pairs.

    Pairs are stored and meet the customer's maps, where a small item table is sent to them.
    Of a larger one the rows of frequent items are sent, fewer than FREQUENT; only pairs of
    the other items are looked up by item, and then meet the maps.
    """
    affinity = materialize(
        customer_profile(hist, items, ATTRIBUTES).select(
            "customer_id", *[f"{a}_rows" for a in ATTRIBUTES]
        ),
        "affinity",
    )
    pairs = _stored_pairs(candidates, ["customer_id", "item_id"])
    table = materialize(items.select("item_id", *ATTRIBUTES).where(F.col("item_id").isNotNull()), "items")
    counted = ["customer_id", "item_id", *match_features()]
    met = _at_customers(pairs, affinity, pairs)
    if stored_bytes(table) <= broadcast_limit(pairs.sparkSession):
        return met.join(F.broadcast(table), "item_id", "left").select(*counted)
    often = materialize(
        hot_keys(pairs, ["item_id"], FREQUENT).select("item_id").where(F.col("item_id").isNotNull()),
        "frequent-items",
    )
    sent = materialize(table.join(F.broadcast(often), "item_id", "right"), "sent-items")
    others = lookup_join(
        pairs.join(F.broadcast(often), "item_id", "left_anti"), table, ["item_id"], ["customer_id"], hot=often
    )
    return (
        met.join(F.broadcast(sent), "item_id")
        .select(*counted)
        .unionByName(_at_customers(others, affinity, pairs).select(*counted))
    )


def labels(recent: DataFrame) -> DataFrame:
    """Y = 1 for every distinct pair bought in the label window."""
    return recent.select("customer_id", "item_id").distinct().withColumn("Y", F.lit(1))


def _bought_lists(recent: DataFrame, blocks: int) -> DataFrame:
    """``(customer_id, block, bought)``: the items bought in the label window."""
    return (
        recent.select("customer_id", "item_id", _block(blocks))
        .groupBy("customer_id", "block")
        .agg(F.collect_set("item_id").alias("bought"))
    )


def _is_bought() -> Column:
    return F.coalesce(F.array_contains("bought", F.col("item_id")), F.lit(False)).cast("int").alias("Y")


def label_candidates(candidates: DataFrame, recent: DataFrame) -> DataFrame:
    """Candidates with Y, 0 where the pair was not bought.

    A pair is looked for in its customer's list of bought items: the pairs move once, packed
    by customer, and are never exchanged on the pair. Those made by customer do not move,
    unless some list of bought items has to be cut.
    """
    pairs = _stored_pairs(candidates, candidates.columns)
    if _by_customer(pairs) and _blocks(recent) == 1:
        met = _at_customers(pairs, _bought_lists(recent, 1).drop("block"), pairs)
        return met.select(*candidates.columns, _is_bought())
    blocks = _blocks(pairs, recent)
    packed = pack_pairs(pairs, blocks).join(_bought_lists(recent, blocks), ["customer_id", "block"], "left")
    return unpack_pairs(packed, ["bought"]).select(*candidates.columns, _is_bought())


def _features_of_given_pairs(
    candidates: DataFrame, hist: DataFrame, recent: DataFrame, items: DataFrame, end_hist: datetime
) -> DataFrame:
    lookups = [f"{a}_rows" for a in ATTRIBUTES]
    figures = list(config.FEATURE_COLUMNS[3:])
    profile = customer_profile(hist, item_dimension(hist, items)).select(
        "customer_id", *lookups, *profile_features(end_hist)
    )
    pairs = materialize(candidates.select("customer_id", "item_id"), "pairs")
    blocks = _blocks(pairs, recent)
    found, sent = _with_attributes(pairs, items)
    packed = (
        pack_pairs(found, blocks)
        .join(_bought_lists(recent, blocks), ["customer_id", "block"], "left")
        .join(profile, "customer_id", "left")
    )
    return unpack_pairs(packed, ["bought", *lookups, *figures], sent).select(
        "customer_id", "item_id", *match_features(), *_zero_filled(figures), _is_bought()
    )


def _features_of_generated_pairs(
    hist: DataFrame,
    recent: DataFrame,
    items: DataFrame,
    end_hist: datetime,
    include_positives: bool,
    cap_mode: str,
    top_n: int,
    max_per_customer: int | None,
    by_customer: bool,
) -> DataFrame:
    # One row per customer, read three times below: for the category sets, the
    # label window's pairs and the fan-out. Written once, it is computed once.
    lookups = [f"{a}_rows" for a in ATTRIBUTES]
    figures = list(config.FEATURE_COLUMNS[3:])
    dimension = item_dimension(hist, items)
    profile = materialize(
        customer_profile(hist, dimension).select(
            "customer_id", category_set(), *lookups, *profile_features(end_hist)
        ),
        "profile",
    )
    pools = category_set_pools(profile, dimension, items, top_n, max_per_customer, cap_mode)
    bought = _bought_pairs(recent, items, profile, pools, cap_mode)
    # At most top_n + cap entries per customer: only generated pairs are listed.
    hits = (
        bought.where("generated")
        .groupBy("customer_id")
        .agg(F.collect_list("item_id").alias("bought_items"))
    )
    if by_customer:
        # Dealt after the join, which may choose another number of partitions.
        tasks = parts_by_pairs(pools)
        spread = profile.join(hits, "customer_id", "left").repartition(tasks, "customer_id")
    else:
        tasks = fan_out_partitions(profile)
        spread = profile.repartition(tasks, "customer_id").join(hits, "customer_id", "left")
    customers = with_pools(spread, pools, POOL_COLUMNS, tasks)
    if by_customer and not is_sent(pools):
        # The lookup has dealt the customers by their sets.
        customers = customers.repartition(tasks, "customer_id")
    bought_flag = F.coalesce(F.array_contains("bought_items", F.col("item_id")), F.lit(False))
    columns = [*match_features(), *_zero_filled(figures)]
    kept = ["customer_id", *lookups, *figures, "bought_items"]
    generated = unfold_pools(customers, kept).select(
        "customer_id", "item_id", *columns, bought_flag.cast("int").alias("Y")
    )
    if include_positives:
        extra = bought.where(~F.col("generated")).select(
            "customer_id", "item_id", *columns, F.lit(1).alias("Y")
        )
        generated = generated.unionByName(extra.repartition(tasks, "customer_id") if by_customer else extra)
    if by_customer:
        generated._dealt_by = ("customer_id", tasks)
    return generated


def parts_by_pairs(pools: DataFrame) -> int:
    """Partitions for all generated pairs, of about PAIRS_PER_PART each, and no fewer than
    keep the cores busy. Sizes of files say little here: a customer's figures repeat on all
    its pairs and are stored once, but are sorted pair by pair."""
    listed = F.greatest(F.size("category_pool"), F.lit(0)) + F.greatest(F.size("top_items"), F.lit(0))
    pairs = pools.agg(F.sum(F.col("customers") * listed)).first()[0] or 0
    return max(2 * pools.sparkSession.sparkContext.defaultParallelism, -(-pairs // PAIRS_PER_PART))


def _bought_pairs(
    recent: DataFrame, items: DataFrame, customers: DataFrame, pools: DataFrame, cap_mode: str
) -> DataFrame:
    """Distinct pairs of the label window with their item's attributes, their
    customer's columns (null without history) and whether they are generated
    candidates anyway."""
    known = with_pools(customers, pools, ["pool_end"])
    return (
        recent.select("customer_id", "item_id")
        .distinct()
        .join(items.select("item_id", *ATTRIBUTES), "item_id", "left")
        .join(known, "customer_id", "left")
        .withColumn("generated", is_generated(top_item_ids(pools), cap_mode))
    )


def training_candidates(
    hist: DataFrame,
    recent: DataFrame,
    items: DataFrame,
    include_positives: bool = True,
    cap_mode: str = "id",
    top_n: int = config.TOP_K_POPULAR_ITEMS,
    max_per_customer: int | None = config.MAX_CANDIDATES_PER_USER,
    by_customer: bool = False,
) -> DataFrame:
    """Distinct pairs from three sources: bought in the label window; the ``top_n`` most
    popular items for every customer with history; up to ``max_per_customer`` items per
    customer (None: all) that share a category with the customer's history. These two are the
    candidate budget; ``cap_mode`` says which items it keeps.

    With ``by_customer`` the customers are dealt out before their pairs are made, as in
    :func:`build_feature_label_table`: ``candidate_features`` leaves such pairs in place."""
    dimension = item_dimension(hist, items)
    bought_from = customer_profile(hist, dimension.drop("popularity"), ("category",))
    customers = materialize(
        bought_from.select("customer_id", "category_rows", category_set()), "category-sets"
    )
    pools = category_set_pools(customers, dimension, items, top_n, max_per_customer, cap_mode)
    tasks = parts_by_pairs(pools) if by_customer else fan_out_partitions(customers)
    rows = with_pools(customers.repartition(tasks, "customer_id"), pools, POOL_COLUMNS, tasks)
    if by_customer and not is_sent(pools):
        # The lookup has dealt the customers by their sets.
        rows = rows.repartition(tasks, "customer_id")
    pairs = unfold_pools(rows, ["customer_id"]).select("customer_id", "item_id")
    if include_positives:
        extra = _bought_pairs(recent, items, customers, pools, cap_mode).where(~F.col("generated"))
        extra = extra.select("customer_id", "item_id")
        pairs = pairs.unionByName(extra.repartition(tasks, "customer_id") if by_customer else extra)
    if by_customer:
        pairs._dealt_by = ("customer_id", tasks)
    return pairs


def build_feature_label_table(
    transactions: DataFrame,
    items: DataFrame,
    users: DataFrame | None,
    begin_hist: datetime,
    end_hist: datetime,
    begin_recent: datetime,
    end_recent: datetime,
    candidates: DataFrame | None = None,
    include_positives: bool = True,
    cap_mode: str = "id",
    top_n: int = config.TOP_K_POPULAR_ITEMS,
    max_per_customer: int | None = config.MAX_CANDIDATES_PER_USER,
    by_customer: bool = False,
) -> DataFrame:
    """X1..X13 and Y per (customer, item) pair.

    Features come from ``[begin_hist, end_hist)``, labels from ``[begin_recent,
    end_recent)``. Without ``candidates`` the pairs of
    :func:`training_candidates` are used; with
    ``include_positives=False`` the label window adds no pairs of its own, which
    is what honest offline scoring needs. A customer without history has 0 in
    X4..X13. ``items`` must hold one row per item (see ``clean_items``);
    ``users`` carries no feature and is accepted for call compatibility.

    With ``by_customer`` the customers are dealt out before their pairs are made, so many to a
    partition that it has about PAIRS_PER_PART pairs: ``artifacts.features_cache`` stores such
    a table as it is, without moving the pairs. (Given pairs are stored as any other table.)
    """
    hist = time_window(transactions, begin_hist, end_hist)
    recent = time_window(transactions, begin_recent, end_recent)
    if candidates is not None:
        return _features_of_given_pairs(candidates, hist, recent, items, end_hist)
    return _features_of_generated_pairs(
        hist, recent, items, end_hist, include_positives, cap_mode, top_n, max_per_customer, by_customer
    )


def feature_subset(table: DataFrame, n_features: int) -> DataFrame:
    """The key, label and one of the ablation sets (3, 5, 9, 10 or 13 features)."""
    if n_features not in config.FEATURE_SETS:
        raise ValueError(f"No feature set of size {n_features}")
    return table.select(
        "customer_id", "item_id", *config.FEATURE_SETS[n_features], config.LABEL_COLUMN
    )


def ground_truth_from_label(table: DataFrame) -> DataFrame:
    """Positive pairs of a feature table."""
    return table.where(F.col(config.LABEL_COLUMN) == 1).select("customer_id", "item_id")


def class_balance(table: DataFrame, n_features: int = len(config.FEATURE_COLUMNS)) -> DataFrame:
    """Samples, features, positives and positive share in percent."""
    y = F.col(config.LABEL_COLUMN)
    return table.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.lit(n_features).cast("long").alias("n_features"),
        F.coalesce(F.sum(y), F.lit(0)).alias("n_positive"),
        (F.avg(y) * 100).alias("positive_pct"),
    )
