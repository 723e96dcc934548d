"""Raw relation records as one row per mention, with explicit order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.ids import stable_id
from sparkloom.functions.text import sanitize_endpoint


def one_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the first in ``order``; rows without a key go. Repeated rows must be equal in ``order``
    only where they are equal altogether."""
    rest = [c for c in df.columns if c != key]
    o = F.struct(*[F.col(c) for c in order])
    return (
        df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), o).alias("_r")).select(key, "_r.*")
    )


def mentions(raw: DataFrame) -> DataFrame:
    """One row per relation of a raw record, in order (unit_seq, rel_ord). Repeated records count once."""
    one = one_per_key(
        raw.select("semantic_unit_id", "document_id", "document_title", "source_path", "source_ref", "unit_seq", "relations"),
        "semantic_unit_id", ["unit_seq", "document_id"],
    )
    return one.select("*", F.posexplode("relations").alias("rel_ord", "r")).select(
        "semantic_unit_id", "document_id", "document_title", "source_path", "source_ref", "unit_seq", "rel_ord",
        "r.relation_mention_id", "r.subject", "r.predicate", "r.object",
    )


def endpoints(m: DataFrame) -> DataFrame:
    """Subjects and objects as rows (name, role), subject before object in end_ord."""
    return m.select(
        "*",
        F.explode(F.array(
            F.struct(F.lit("subject").alias("role"), F.lit(0).alias("end_ord"), F.col("subject").alias("name")),
            F.struct(F.lit("object").alias("role"), F.lit(1).alias("end_ord"), F.col("object").alias("name")),
        )).alias("e"),
    ).select(*m.columns, "e.role", "e.end_ord", "e.name")


def sanitize_records(raw: DataFrame) -> DataFrame:
    """Raw records with cleaned endpoints: the cross product of the cleaned subjects and objects of every triple,
    the first of equal triples in a unit kept, mention ids made anew. Records keep all other columns; a record may
    be left without relations. Null subjects, predicates and objects drop their triple."""
    crossed = F.flatten(F.transform(
        F.col("relations"),
        lambda r: F.flatten(F.transform(
            F.coalesce(sanitize_endpoint(r["subject"]), F.array().cast("array<string>")),
            lambda s: F.transform(
                F.coalesce(sanitize_endpoint(r["object"]), F.array().cast("array<string>")),
                lambda o: F.struct(s.alias("subject"), r["predicate"].alias("predicate"), o.alias("object")),
            ),
        )),
    ))
    kept = F.array_distinct(F.filter(crossed, lambda t: t["predicate"].isNotNull()))
    with_ids = F.transform(
        kept,
        lambda t: F.struct(
            stable_id("raw_svo_mention", F.col("semantic_unit_id"), t["subject"], t["predicate"], t["object"]).alias("relation_mention_id"),
            t["subject"].alias("subject"), t["predicate"].alias("predicate"), t["object"].alias("object"),
        ),
    )
    return raw.withColumn("relations", with_ids)


def coverage(units: DataFrame, records: DataFrame, key: str = "semantic_unit_id") -> DataFrame:
    """One row of counts: missing, extra and doubled keys of ``records`` against ``units``."""
    u = units.select(F.col(key)).groupBy(key).agg(F.count(F.lit(1)).alias("n_units"))
    r = records.select(F.col(key)).groupBy(key).agg(F.count(F.lit(1)).alias("n_records"))
    j = u.join(r, key, "full_outer")
    return j.agg(
        F.count_if(F.col("n_records").isNull()).alias("missing"), F.count_if(F.col("n_units").isNull()).alias("extra"),
        F.count_if(F.col("n_units") > 1).alias("doubled_units"), F.count_if(F.col("n_records") > 1).alias("doubled_records"),
    )


def align(units: DataFrame, records: DataFrame) -> DataFrame:
    """Records in the order of their units; raises unless every unit has exactly one record and no record is extra."""
    c = coverage(units, records).first()
    if any(c):
        raise ValueError(f"coverage mismatch: {c.asDict()}")
    seq = units.select("semantic_unit_id", F.col("unit_seq").alias("_seq"))
    return records.join(seq, "semantic_unit_id").orderBy("_seq").drop("_seq")


def pending(units: DataFrame, done: DataFrame, key: str = "semantic_unit_id") -> DataFrame:
    """Units that a resumed run still has to do."""
    return units.join(done.select(key).distinct(), key, "left_anti")
