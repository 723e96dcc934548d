"""References to records that do not exist, are deleted, or are made later."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkloom.operators.bloom import FILTER_BYTES, with_membership
from sparkloom.operators.skew import hot_salts, salted_join

#: Life spans of a key that one row of the exact join holds, on average; a key with more has several rows.
SPANS_PER_ROW = 64


def life_spans(parents: DataFrame, parent_key: str, created_col: str, deleted_col: str | None, per_row: int = SPANS_PER_ROW) -> DataFrame:
    """Rows (ref, _spans, _rows): the distinct life spans of every key in arrays of bounded length; ``_rows`` is the number
    of rows of the key, 1 for all keys but those of very many versions."""
    p = (
        parents.select(
            F.col(parent_key).alias("ref"), F.col(created_col).alias("p_created"),
            (F.col(deleted_col) if deleted_col else F.lit(None).cast("timestamp_ntz")).alias("p_deleted"),
        )
        .filter(F.col("ref").isNotNull())
        .distinct()
    )
    n = F.count(F.lit(1)).over(W.partitionBy("ref"))
    dealt = p.withColumn("_rows", F.ceil(n / F.lit(per_row))).withColumn("_row", F.pmod(F.xxhash64("p_created", "p_deleted"), F.col("_rows")))
    return dealt.groupBy("ref", "_rows", "_row").agg(F.collect_list(F.struct("p_created", "p_deleted")).alias("_spans")).drop("_row")


def orphan_references(
    refs: DataFrame,
    row_key: str,
    ref_col: str,
    made_col: str,
    parents: DataFrame,
    parent_key: str,
    created_col: str,
    deleted_col: str | None,
    filter_bytes: int = FILTER_BYTES,
    spans_per_row: int = SPANS_PER_ROW,
) -> DataFrame:
    """References of ``refs.ref_col`` that name no record living at the time ``refs.made_col``.

    Rows (row_id, ref, period, reason); reason is ``missing`` (no record has that key), ``later``
    (only records made after the reference) or ``deleted``. A record lives from created_col on until,
    not including, deleted_col.

    1. A Bloom filter of the parent keys, sized by the number of parent rows, is broadcast (in slices of the keys if it
       would exceed ``filter_bytes``); a reference it denies is a proven orphan and needs no join. 2. Only
       filter-positive references meet the parents' life spans in an exact join on the key, hot keys split.

    Null references and rows without a row key give no case. A reference without a time has period null
    and counts as orphan only if the key is missing (nothing can be said about before and after).
    A record without a creation time counts as always made. Repeated rows of one reference give one case.
    Empty references give no rows; with empty parents every reference is missing.
    """
    r = refs.select(
        F.col(row_key).alias("row_id"), F.col(ref_col).alias("ref"), F.col(made_col).alias("made")
    ).filter(F.col("row_id").isNotNull() & F.col("ref").isNotNull())
    keys = parents.select(F.col(parent_key).alias("ref"))
    # rows of all versions bound the number of keys; the count comes from the files' footers
    probed = with_membership(r, ["ref"], keys, ["ref"], keys.count(), "_maybe", filter_bytes)
    spans = life_spans(parents, parent_key, created_col, deleted_col, spans_per_row)
    denied = probed.filter(~F.col("_maybe")).select("row_id", "ref", "made", F.lit(None).cast(spans.schema["_spans"].dataType).alias("_spans"), F.lit(None).cast("long").alias("_rows"))
    # the keys of all references are counted, not of the positive ones: the same bound, and no filter is probed for it
    positive = salted_join(probed.filter("_maybe").drop("_maybe"), spans, ["ref"], F.col("row_id"), "left", hot_salts(r, ["ref"]))
    joined = denied.unionByName(positive.select("row_id", "ref", "made", "_spans", "_rows"))
    begun = lambda s: F.coalesce(s["p_created"] <= F.col("made"), s["p_created"].isNull() | F.col("made").isNull())
    flagged = joined.select(
        "row_id", "ref", "made", F.coalesce("_rows", F.lit(1)).alias("_rows"), F.col("_spans").isNotNull().alias("_there"),
        F.coalesce(F.exists("_spans", begun), F.lit(False)).alias("_begun"),
        F.coalesce(F.exists("_spans", lambda s: begun(s) & F.coalesce(s["p_deleted"] > F.col("made"), F.lit(True))), F.lit(False)).alias("_alive"),
    )
    # what one row settles as alive is out; the others, and the few keys of several rows, are folded by reference
    cases = (
        flagged.filter(~F.col("_alive") | (F.col("_rows") > 1))
        .groupBy("row_id", "ref", "made").agg(*[F.max(c).alias(c) for c in ("_there", "_begun", "_alive")])
        .filter(~F.col("_alive"))
    )
    reason = F.when(~F.col("_there"), "missing").when(~F.col("_begun"), "later").otherwise("deleted")
    return cases.select("row_id", "ref", F.date_format("made", "yyyy-MM").alias("period"), reason.alias("reason")).distinct()
