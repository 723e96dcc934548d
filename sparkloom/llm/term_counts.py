"""Frequency of every distinct value or term, with marks for the too rare and the too common."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _runs(df: DataFrame, arrays: list[str]) -> DataFrame:
    """Adds ``<a>_at`` for each sorted array: the places where a run of equal terms begins."""

    def begins(a: str) -> Column:
        return F.filter(F.transform(a, lambda x, i: F.when((i == 0) | (x != F.get(F.col(a), i - 1)), i)), lambda i: i.isNotNull())

    return df.withColumns({f"{a}_at": begins(a) for a in arrays})


def record_counts(field: str, a: str) -> Column:
    """Array of (field_name, term, n) of one record: every distinct term once with its occurrences in the record, and one
    (field_name, NULL, 0) that stands for the record itself."""
    at = F.col(f"{a}_at")
    counts = F.transform(at, lambda b, i: F.struct(
        F.lit(field).alias("field_name"), F.get(F.col(a), b).alias("term"), (F.coalesce(F.get(at, i + 1), F.size(a)) - b).cast("long").alias("n")
    ))
    record = F.struct(F.lit(field).alias("field_name"), F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"))
    return F.concat(counts, F.array(record))


def term_counts(
    records: DataFrame,
    record_key: str,
    terms: dict[str, Column],
    rare_below: int = 3,
    common_one_in: int = 25,
) -> DataFrame:
    """Occurrences and holding records of every distinct term of every field.

    Rows (field_name, term, n_mentions, n_records, mark); mark is ``rare`` if fewer than ``rare_below``
    records hold the term, ``common`` if more than one in ``common_one_in`` of all records do, else null.
    ``terms`` maps a field name to an array column of strings.

    Repeated rows of a record (equal in key and terms) count once, removed by hash; a record written with different
    terms counts once for each writing. Each record then emits its distinct terms with their counts in it, found as
    runs of its sorted terms; both totals are combined by hash in every task before the shuffle on (field_name, term),
    so a term held by a third of the records costs one state per task. The number of all records comes from a marker of
    every record and field and is read from the same exchange.

    A null term is none; the empty string is one. Records without terms (null or empty array) count among
    all records. A null record key is no record. No records give no rows. Other columns are not read.
    """
    arrays = [f"_t{i}" for i in range(len(terms))]
    slim = records.select(F.col(record_key).alias("_key"), *[c.alias(a) for a, c in zip(arrays, terms.values())])
    one = slim.filter(F.col("_key").isNotNull()).distinct()
    clean = one.select(*[
        F.array_sort(F.filter(F.coalesce(F.col(a), F.array().cast("array<string>")), lambda x: x.isNotNull())).alias(a) for a in arrays
    ])
    emitted = _runs(clean, arrays).select(F.explode(F.concat(*[record_counts(f, a) for f, a in zip(terms, arrays)])).alias("x")).select("x.*")
    counted = emitted.groupBy("field_name", "term").agg(F.sum("n").alias("n_mentions"), F.count(F.lit(1)).alias("n_records"))
    # Markers have no mentions: filters on that sum stay above the aggregate, so both sides below read one exchange.
    # One row per field; a field count bounds this side.
    n_all = counted.filter(F.col("n_mentions") == 0).select("field_name", F.col("n_records").alias("n_all"))
    mark = F.when(F.col("n_records") < rare_below, "rare").when(
        F.col("n_records") * F.lit(common_one_in) > F.col("n_all"), "common"
    )
    return (
        counted.filter(F.col("n_mentions") > 0)
        .join(F.broadcast(n_all), "field_name")
        .select("field_name", "term", "n_mentions", "n_records", mark.alias("mark"))
    )
