"""Hot keys: per-key aggregation by map-side combining, and joins that split hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def combine_by_key(df: DataFrame, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Per-key totals of algebraic aggregates without a hot task.

    Every input partition folds its rows into one bounded hash table of mergeable key states
    (Spark's partial HashAggregate, which falls back to a spilling sort when the table is full);
    only one compact state per key and partition is shuffled. A key holding most rows therefore
    reaches its final task as one state per partition. ``aggs`` must be algebraic aggregates with
    states of fixed width (sum, count, min and max of numbers, bit_or ...), so that they hash.
    """
    return df.groupBy(*keys).agg(*aggs)


def hot_key_totals(
    relations: DataFrame,
    record_key: str,
    fields: list[str],
    weight: str,
) -> DataFrame:
    """Number of records and sum of ``weight`` for every value of each of ``fields``.

    Rows (field_name, entity_id, n_records, sum_weight, n_all, weight_all), the last two being the number of all
    records and their weight. Repeated rows of a record (equal in key, fields and weight) count once; a record
    written with different contents counts once for each. Rows without a record key are no records. Null is no
    key: it gives no row but counts in n_all. A null weight adds nothing; a key with only null weights has sum
    0. An empty table gives no rows. Other columns are never read.

    One shuffle of the records (hash-combined; the record key is close to unique, so it is even), one of the
    key states. The totals read the same exchange of key states as the keys do, as long as both sum_weight and
    weight_all are kept or both are dropped.
    """
    src = relations.select(
        F.col(record_key).alias("_rec"), F.col(weight).cast("long").alias("_w"),
        *[F.col(f).cast("string").alias(f"_f{i}") for i, f in enumerate(fields)],
    ).filter(F.col("_rec").isNotNull())
    one = src.distinct()
    long = one.select(
        F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"_f{i}").alias("entity_id")) for i, f in enumerate(fields)])).alias("_k"),
        "_w",
    ).select("_k.field_name", "_k.entity_id", "_w")
    # n_keyed is 0 for the null key: a filter on it stays above the aggregate, so that both uses below read one exchange
    per_key = combine_by_key(
        long, ["field_name", "entity_id"],
        [F.count(F.lit(1)).alias("n_records"), F.count("entity_id").alias("n_keyed"), F.sum("_w").alias("_sum")],
    )
    # One row per field: bounded by the number of fields, so this side may be broadcast.
    n_all = per_key.groupBy("field_name").agg(
        F.sum(F.greatest("n_records", "n_keyed")).alias("n_all"), F.coalesce(F.sum("_sum"), F.lit(0)).cast("long").alias("weight_all")
    )
    return (
        per_key.filter(F.col("n_keyed") > 0)
        .join(F.broadcast(n_all), "field_name")
        .select("field_name", "entity_id", "n_records", F.coalesce("_sum", F.lit(0)).cast("long").alias("sum_weight"), "n_all", "weight_all")
    )


def hot_keys(totals: DataFrame, one_in: int = 40) -> DataFrame:
    """Keys of ``hot_key_totals`` holding more than one in ``one_in`` of all records."""
    return totals.filter(F.col("n_records") * F.lit(one_in) > F.col("n_all"))


def hot_salts(big: DataFrame, on: list[str], tasks: int | None = None, rows: Column | None = None) -> list[tuple]:
    """(key values..., salts) of the keys of ``big`` that hold more than a task's even share of its rows. Where counts are at
    hand, ``rows`` is the number of rows that a row of ``big`` stands for.

    With ``tasks`` tasks (unless given, twice the cores) an even share is rows / tasks; a key of n rows gets
    n / share salts, rounded up. At most ``tasks`` keys can exceed the share, which bounds this list and what is
    broadcast of it, and all salts together are at most twice ``tasks``, however many rows there are.
    One pass over the key columns, combined before its shuffle."""
    tasks = tasks or 2 * big.sparkSession.sparkContext.defaultParallelism
    seen = Observation()
    counts = big.groupBy(*on).agg(F.sum(F.lit(1) if rows is None else rows).alias("_n")).observe(seen, F.sum("_n").alias("all"))
    top = counts.orderBy(F.desc("_n")).limit(tasks).collect()
    total = seen.get["all"] or 0
    return [(*r[:-1], -(-r[-1] * tasks // total)) for r in top if (r[-1] or 0) * tasks > total and None not in r[:-1]]


def salted_join(
    big: DataFrame, small: DataFrame, on: list[str], spread: Column, how: str = "inner", hot: list[tuple] | None = None
) -> DataFrame:
    """Equi-join of a skewed ``big`` side with a side of few rows per key, hot keys split.

    The keys of ``big`` are counted first by ``hot_salts``, unless the caller has done that (``hot``). Only keys found hot are salted: their rows of ``big`` get
    a salt from the hash of ``spread`` (a record id, so a re-run of a lost task gives the same salt) and
    their rows of ``small`` are repeated once per salt; every other row is written once. ``how`` may be inner,
    left, left_semi or left_anti. Null keys match nothing. Apart from ``on`` the sides must not share column names.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how} would repeat unmatched rows of the salted side")
    hot = hot_salts(big.select(*on), on) if hot is None else hot
    if not hot:
        return big.join(small, on, how)
    salt, salts = "_salt", "_salts"
    while {salt, salts} & {*big.columns, *small.columns}:
        salt, salts = salt + "_", salts + "_"
    kinds = [(c, t) for c, t in big.select(*on).dtypes]
    listed = big.sparkSession.createDataFrame(hot, ", ".join(f"`{c}` {t}" for c, t in [*kinds, (salts, "long")]))

    def with_salts(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(listed), on, "left")  # at most as many rows as tasks

    b = with_salts(big).withColumn(salt, F.coalesce(F.pmod(F.xxhash64(spread), F.col(salts)), F.lit(0)).cast("int")).drop(salts)
    s = with_salts(small).withColumn(salt, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(salts), F.lit(1)).cast("int") - 1))).drop(salts)
    return b.join(s, [*on, salt], how).drop(salt)
