"""Equi-joins that divide hot keys over tasks.

A key is hot above 1/``SHARES`` of the rows (or of the output), so there are fewer than
``SHARES`` hot keys for each measure: their list is small by construction and may be
broadcast. Nothing is dropped or sampled; a key that is not hot takes the ordinary join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.session import broadcast_limit, fan_out_partitions, materialize, stored_bytes

SHARES = 1000
#: Rows of one output task that a multiplying join aims at.
ROWS_PER_TASK = 5_000_000


def _same(a: str, b: str, keys: list[str], names: list[str], null_safe: bool = True) -> Column:
    """Equality of the keys of ``a`` and the columns ``names`` of ``b``."""
    both = F.lit(True)
    for key, name in zip(keys, names, strict=True):
        x, y = F.col(f"{a}.{key}"), F.col(f"{b}.{name}")
        both = both & (x.eqNullSafe(y) if null_safe else x == y)
    return both


def hot_keys(rows: DataFrame, keys: list[str], shares: int = SHARES) -> DataFrame:
    """The keys (nulls are values) that more than 1/``shares`` of the rows have, and ``__n``."""
    total = rows.agg(F.count(F.lit(1))).scalar()
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return counts.where(F.col("__n") * shares > total)


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    spread_by: list[str],
    how: str = "left",
    null_safe: bool = False,
    hot: DataFrame | None = None,
    shares: int = SHARES,
    partitions: int | None = None,
) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row for each key.

    The table's rows of hot keys are broadcast, fewer than ``shares`` of them. Rows of a
    hot key have their values from there and are dealt over all tasks of the shuffled
    join by a hash of ``spread_by`` (which should tell rows of one key apart), where they
    meet nothing. ``rows`` is read twice, once for its keys only; it should be stored.
    ``hot`` may give the hot keys where they are known. With ``null_safe`` a null key
    meets a null key; without, it meets nothing, and is dealt out in the same way.
    ``partitions`` states their number after the join, for a step that makes far more of
    each row; otherwise it follows the sizes.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"Unknown kind of lookup: {how}")
    values = [c for c in table.columns if c not in keys]
    hot = F.broadcast((hot_keys(rows, keys, shares) if hot is None else hot).select(*keys, F.lit(1).alias("__hot")))
    names = [f"__key{i}" for i in range(len(keys))]
    keyed = table.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.struct(F.lit(1).alias("__found"), *values).alias("__row"))
    if not null_safe:
        keyed = keyed.dropna(subset=names)
    sent = keyed.alias("t").join(hot.alias("h"), _same("h", "t", keys, names)).select(*names, F.col("__row").alias("__sent"))
    marked = (
        rows.alias("l")
        .join(F.broadcast(hot).alias("h"), _same("l", "h", keys, keys), "left")
        .select("l.*", F.col("h.__hot").alias("__hot"))
        .alias("l")
        .join(F.broadcast(sent).alias("t"), _same("l", "t", keys, names), "left")
        .select("l.*", "t.__sent")
        .withColumn("__salt", F.when(F.col("__hot") == 1, F.xxhash64(*spread_by)).otherwise(F.lit(0).cast("long")))
    )
    if not null_safe:
        # A null key meets nothing: it may go anywhere.
        null = F.lit(False)
        for k in keys:
            null = null | F.col(k).isNull()
        marked = marked.withColumn("__salt", F.when(null, F.xxhash64(*spread_by)).otherwise(F.col("__salt")))
    if partitions is not None:
        marked = marked.repartition(partitions, *keys, "__salt")
    out = (
        marked.alias("l")
        .join(
            # Always 0, but no constant: with one, the salt would be no key of the join.
            keyed.withColumn("__none", F.pmod(F.xxhash64(*names), F.lit(1))).alias("t"),
            _same("l", "t", keys, names, null_safe) & (F.col("l.__salt") == F.col("t.__none")),
            "left",
        )
        .withColumn("__row", F.coalesce("__sent", "__row"))
    )
    if how == "inner":
        out = out.where(F.col("__row.__found") == 1)
    return out.select(*[f"l.{c}" for c in rows.columns], *[F.col(f"__row.{v}").alias(v) for v in values])


def sized_lookup(
    rows: DataFrame,
    stored: DataFrame,
    keys: list[str],
    spread_by: list[str],
    how: str = "left",
    hot: DataFrame | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``rows`` with the columns of a table that :func:`~cartwise.session.materialize` stored.

    One row for each key. The table is sent to all tasks if its files are within the
    session's limit for broadcasts, which leaves ``rows`` where they are, and is looked up
    by :func:`lookup_join` otherwise, in ``partitions`` tasks if stated.
    """
    if stored_bytes(stored) <= broadcast_limit(rows.sparkSession):
        values = [c for c in stored.columns if c not in keys]
        return rows.join(F.broadcast(stored), keys, how).select(*rows.columns, *values)
    if hot is None and not hasattr(rows, "_stored_at"):
        rows = materialize(rows, "looked-up")
    return lookup_join(rows, stored, keys, spread_by, how, hot=hot, partitions=partitions)


def grid_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_by: list[str],
    right_by: list[str],
    shares: int = SHARES,
) -> DataFrame:
    """Inner join of two tables that both repeat the key, hot keys cut into a grid.

    The rows that a key makes are its left rows x its right rows. A key above 1/``shares``
    of all output, of the left or of the right rows gets a grid of p x q cells: its left
    rows are cut into p parts by a hash of ``left_by``, its right rows into q by
    ``right_by``, and a part is repeated only along its own line of the grid. p : q is as
    the two sides' rows, which copies least. Null keys meet nothing.
    """
    sizes = [df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(n)) for df, n in ((left, "__l"), (right, "__r"))]
    sizes = materialize(sizes[0].join(sizes[1], key), "join-sizes")
    made = F.col("__l").cast("double") * F.col("__r")
    whole = sizes.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("double") for c in (made, F.col("__l"), F.col("__r"))]).first()
    cells = F.greatest(*[F.ceil(c / max(total / shares, 1.0)) for c, total in zip((made, F.col("__l"), F.col("__r")), whole, strict=True)])
    cut = lambda rows, parts: F.greatest(F.lit(1), F.least(F.col(rows), parts.cast("long"))).cast("int")
    hot = (
        sizes.withColumn("__cells", cells)
        .where("__cells > 1")
        .withColumn("__p", cut("__l", F.round(F.sqrt(F.col("__cells") * F.col("__l") / F.col("__r")))))
        .withColumn("__q", cut("__r", F.ceil(F.col("__cells") / F.col("__p"))))
        .select(key, "__p", "__q")
    )
    p, q = (F.coalesce(c, F.lit(1)) for c in ("__p", "__q"))
    part = lambda by, n: F.pmod(F.xxhash64(*by), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    a = left.join(F.broadcast(hot), key, "left").withColumn("__i", part(left_by, p)).withColumn("__j", every(q))
    b = right.join(F.broadcast(hot), key, "left").withColumn("__j", part(right_by, q)).withColumn("__i", every(p))
    # By the rows that come out, as the two inputs are far smaller.
    n = max(fan_out_partitions(left), int(whole[0] // ROWS_PER_TASK) + 1)
    a, b = (df.drop("__p", "__q").where(F.col(key).isNotNull()).repartition(n, key, "__i", "__j") for df in (a, b))
    return a.join(b, [key, "__i", "__j"]).drop("__i", "__j")
