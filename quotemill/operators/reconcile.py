"""Comparison with a reference feed."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotemill.operators.scan import occurrence_number, split_hot

# Compared fields; times are compared to the second.
FIELDS = (
    "security_id", "tick_second", "action", "buy_order_no", "sell_order_no", "price", "qty",
    "money", "bs_flag",
)


def reconcile(
    decoded: DataFrame, reference: DataFrame, *, key, fields=FIELDS, block, order, hot: bool | None = None
) -> DataFrame:
    """Full comparison by key; rows with equal keys pair in order. Rows with a null in the key pair with none.

    status: match, error (fields differ), miss (decoded only), ref_remain (reference only). Both sides
    cross the network once, together: rows of a key are numbered and paired where they meet. Keys too
    large for a task (``hot``, see ``scan.split_hot``) are numbered by blocks and joined by key and number.
    """
    key, fields = list(key), list(fields)
    columns = list(dict.fromkeys([*key, *fields, *block, *order]))
    both = decoded.select(*columns, F.lit(True).alias("_decoded")).unionByName(
        reference.select(*columns, F.lit(False).alias("_decoded"))
    )
    if hot is None:
        ordinary, large = split_hot(both, key)
    else:
        ordinary, large = (None, both) if hot else (both, None)
    found = [f(rows, key, fields, block, order) for f, rows in ((_paired, ordinary), (_joined, large)) if rows is not None]
    same = reduce(
        lambda a, b: a & b, [F.col(f"decoded.{f}").eqNullSafe(F.col(f"reference.{f}")) for f in fields]
    )
    return reduce(DataFrame.unionByName, found).withColumn(
        "status",
        F.when(F.col("reference").isNull(), "miss")
        .when(F.col("decoded").isNull(), "ref_remain")
        .when(same, "match")
        .otherwise("error"),
    )


def _paired(rows, key, fields, block, order):
    w = Window.partitionBy(*key, "_decoded").orderBy(*order)
    here = rows.repartition(*key).withColumn("occurrence", F.row_number().over(w).cast("long"))
    # the side tells rows without a whole key apart, which so pair with none
    alone = F.when(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key]), F.col("_decoded"))
    content = F.struct(*fields)
    sides = [F.any_value(F.when(c, content), True).alias(n) for n, c in (("decoded", F.col("_decoded")), ("reference", ~F.col("_decoded")))]
    return here.groupBy(*key, "occurrence", alone.alias("_alone")).agg(*sides).drop("_alone")


def _joined(rows, key, fields, block, order):
    def side(wanted, name):
        numbered = occurrence_number(rows.filter(wanted), keys=key, block=block, order=order, hot=True)
        return numbered.select(*key, "occurrence", F.struct(*fields).alias(name))

    return side(F.col("_decoded"), "decoded").join(
        side(~F.col("_decoded"), "reference"), [*key, "occurrence"], "full_outer"
    )


def reconcile_summary(result: DataFrame) -> DataFrame:
    """Counts; the reference side of an error also counts as remaining."""

    def n(*states):
        return F.count_if(F.col("status").isin(*states))

    return result.agg(
        n("match").alias("matches"),
        n("error").alias("errors"),
        n("miss").alias("miss"),
        n("ref_remain", "error").alias("ref_remain"),
        n("match", "error", "miss").alias("decoded"),
        n("match", "error", "ref_remain").alias("reference"),
    )


def key_difference(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """Keys of ``a`` that ``b`` lacks, with their row count. Grouped first, so keys are unique."""
    counted = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return counted.join(b.select(*keys).distinct(), list(keys), "left_anti")


def key_set_diff(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    left = key_difference(a, b, keys).withColumn("side", F.lit("left"))
    right = key_difference(b, a, keys).withColumn("side", F.lit("right"))
    return left.unionByName(right)


def positional_match(a: DataFrame, b: DataFrame, fields, *, index="frame_idx") -> DataFrame:
    """Rows at the same index on both sides, with a flag per comparison."""
    left = a.select(index, F.struct(*fields).alias("left"))
    right = b.select(index, F.struct(*fields).alias("right"))
    return left.join(right, index).withColumn("same", F.col("left").eqNullSafe(F.col("right")))


def time_diff_histogram(
    a: DataFrame, b: DataFrame, *, id: str, ta: str, tb: str, order, n: int = 5
) -> DataFrame:
    """Differences ta - tb per id, where b gives its last time per id; the n most frequent."""
    at = F.struct(*order) if len(order) > 1 else F.col(order[0])
    last = b.groupBy(id).agg(F.max_by(tb, at).alias("_tb"))
    # Grouped before the join, so an id with very many rows joins once per distinct time.
    times = a.groupBy(id, ta).agg(F.count(F.lit(1)).alias("_n"))
    diff = times.join(last, id).select((F.col(ta) - F.col("_tb")).alias("diff"), "_n")
    counts = diff.groupBy("diff").agg(F.sum("_n").alias("count"))
    return counts.orderBy(F.col("count").desc(), "diff").limit(n)


def concat(*frames: DataFrame) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y), frames)
