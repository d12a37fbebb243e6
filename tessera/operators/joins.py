"""Join helpers: parallelism of small inputs and pairs inside and across groups.

No side is broadcast by hand: materialised tables carry their file sizes and
shuffled ones their runtime sizes, so Catalyst and adaptive execution
broadcast what is below ``spark.sql.autoBroadcastJoinThreshold`` in bytes and
shuffle the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def known_rows(df: DataFrame) -> int | None:
    """The row count recorded when ``df`` was materialised, if any."""
    return getattr(df, "_tessera_rows", None)


def ensure_parallelism(df: DataFrame, key: str, factor: int = 2) -> DataFrame:
    """Spread a compute-heavy, byte-light input over all task slots.

    A few-megabyte text table can arrive as one Parquet split although each
    row costs milliseconds of CPU (shingling, MinHash). When the input has
    fewer files than the cluster's default parallelism it is hash
    partitioned by ``key`` (deterministic under task retries). Only the file
    listing is consulted, so no job runs; inputs of many files, and inputs
    that are larger than a split per slot, are left as they are.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= slots:
        return df
    return df.repartition(slots * factor, key)


# Members per side of one grid cell in ``pairs_within_groups``.
PAIR_CELL = 2048


def pairs_within_groups(df: DataFrame, group_cols: list[str], member_col: str,
                        carry: list[str] | None = None, cell: int = PAIR_CELL,
                        max_group: int | None = None) -> DataFrame:
    """``(group..., first, second[, c_1, c_2 ...])``: member pairs inside each group, first < second.

    A group of m members yields m (m - 1) / 2 rows from m input rows, so a
    hot group is invisible to byte-based skew detection while its output can
    swamp one task. Groups are salted on a grid: with B = ceil(m / cell)
    buckets, member x goes to bucket h(x) mod B; left rows are replicated over
    the B right buckets and right rows over the B left buckets, and each cell
    (i, j) is a separate join key. Every pair meets in exactly one cell, no
    cell yields more than about ``cell``^2 rows, and groups of at most
    ``cell`` members keep one cell. Group sizes come from a partial + final
    count; singleton groups drop out before the join. ``carry`` columns of
    each member are returned as ``<c>_1`` and ``<c>_2``.

    ``max_group`` is a proven upper bound of the group sizes (e.g. the item
    vocabulary for baskets); without it, or when it doesn't settle the
    question, one narrow aggregation measures the largest group. When every group fits one cell, the plain equi self-join is
    planned instead (one exchange, reused by both sides).
    """
    carry = carry or []
    if max_group is None or max_group > cell:
        max_group = (df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_m"))
                     .agg(F.max("_m").alias("_mx")).first()["_mx"]) or 0
    if max_group <= cell:
        left = df.select(*group_cols, F.col(member_col).alias("first"), *[F.col(c).alias(f"{c}_1") for c in carry])
        right = df.select(*group_cols, F.col(member_col).alias("second"),
                          *[F.col(c).alias(f"{c}_2") for c in carry])
        return (left.join(right, group_cols).filter(F.col("first") < F.col("second"))
                .select(*group_cols, "first", "second", *[f"{c}_{k}" for c in carry for k in (1, 2)]))
    sizes = (df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_m"))
             .filter(F.col("_m") > 1)
             .select(*group_cols, F.ceil(F.col("_m") / F.lit(cell)).cast("int").alias("_b")))
    m = df.join(sizes, group_cols)
    bucket = F.pmod(F.xxhash64(member_col), F.col("_b").cast("long")).cast("int")
    cells = F.sequence(F.lit(0), F.col("_b") - 1)
    left = m.select(*group_cols, F.col(member_col).alias("first"),
                    *[F.col(c).alias(f"{c}_1") for c in carry], bucket.alias("_i"), F.explode(cells).alias("_j"))
    right = m.select(*group_cols, F.col(member_col).alias("second"),
                     *[F.col(c).alias(f"{c}_2") for c in carry], bucket.alias("_j"), F.explode(cells).alias("_i"))
    return (left.join(right, [*group_cols, "_i", "_j"]).filter(F.col("first") < F.col("second"))
            .select(*group_cols, "first", "second", *[f"{c}_{k}" for c in carry for k in (1, 2)]))


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], largest: int, cell: int = PAIR_CELL) -> DataFrame:
    """Inner equi-join on ``keys`` of two sides whose groups may both be large.

    ``largest`` bounds the rows of a group on either side. Up to ``cell`` rows
    it is a plain join; beyond, both sides are counted per key, a group of l
    and r rows is dealt to ceil(l / cell) x ceil(r / cell) cells by the hash
    of its rows, and every row goes to the cells of its own row or column, so
    each pair of rows meets once and a cell makes about ``cell``^2 rows.
    """
    if largest <= cell:
        return left.join(right, keys)
    sizes = (left.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(cell)).cast("int").alias("_l"))
             .join(right.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(cell)).cast("int").alias("_r")), keys))
    own = lambda df, n: F.pmod(F.xxhash64(*df.columns), F.col(n).cast("long")).cast("int")
    other = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = left.join(sizes, keys).select(*left.columns, own(left, "_l").alias("_i"), other("_r").alias("_j"))
    b = right.join(sizes, keys).select(*right.columns, own(right, "_r").alias("_j"), other("_l").alias("_i"))
    return a.join(b, [*keys, "_i", "_j"]).drop("_i", "_j")


def pairs_across_groups(group_pairs: DataFrame, members: DataFrame, group_col: str, member_col: str,
                        cell: int = PAIR_CELL, max_group: int | None = None) -> DataFrame:
    """``(first, second, <values>, _x1, _x2)``: every member combination of each group pair.

    ``group_pairs`` has ``first`` and ``second`` group ids plus value columns;
    ``members`` maps ``group_col`` to ``member_col``. A pair of groups with m1
    and m2 members yields m1 * m2 rows. When every group has at most ``cell``
    members (``max_group``, measured if not given) this is two equi-joins;
    otherwise each group is cut into B = ceil(m / cell) hash buckets, the pair
    rows are replicated over the bucket indices of both sides, and each cell
    (pair, i, j) is one join key, so no task yields more than ~``cell``^2 rows.
    """
    values = [c for c in group_pairs.columns if c not in ("first", "second")]
    sizes = members.groupBy(group_col).agg(F.count(F.lit(1)).alias("_m"))
    if max_group is None:
        max_group = sizes.agg(F.max("_m").alias("_mx")).first()["_mx"] or 0
    m1 = members.select(F.col(group_col).alias("first"), F.col(member_col).alias("_x1"))
    m2 = members.select(F.col(group_col).alias("second"), F.col(member_col).alias("_x2"))
    if max_group <= cell:
        return group_pairs.join(m1, "first").join(m2, "second").select("first", "second", *values, "_x1", "_x2")
    buckets = sizes.select(group_col, F.ceil(F.col("_m") / F.lit(cell)).cast("int").alias("_b"))
    placed = (members.join(buckets, group_col)
              .select(group_col, member_col,
                      F.pmod(F.xxhash64(member_col), F.col("_b").cast("long")).cast("int").alias("_c")))
    gp = (group_pairs
          .join(buckets.select(F.col(group_col).alias("first"), F.col("_b").alias("_b1")), "first")
          .join(buckets.select(F.col(group_col).alias("second"), F.col("_b").alias("_b2")), "second"))
    span = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (gp.select("first", "second", *values, "_b2", span("_b1").alias("_i"))
            .join(placed.select(F.col(group_col).alias("first"), F.col(member_col).alias("_x1"),
                                F.col("_c").alias("_i")), ["first", "_i"])
            .select("first", "second", *values, "_x1", "_i", span("_b2").alias("_j")))
    right = (gp.select("first", "second", "_b1", span("_b2").alias("_j"))
             .join(placed.select(F.col(group_col).alias("second"), F.col(member_col).alias("_x2"),
                                 F.col("_c").alias("_j")), ["second", "_j"])
             .select("first", "second", "_x2", "_j", span("_b1").alias("_i")))
    return left.join(right, ["first", "second", "_i", "_j"]).select("first", "second", *values, "_x1", "_x2")
