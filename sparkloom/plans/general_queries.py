"""Queries of the general problems 1 (hot keys) and 5 (orphan references), with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.operators.orphans import orphan_references
from sparkloom.operators.skew import hot_key_totals, hot_keys
from sparkloom.runtime import table

KEY_FIELDS = ["source_entity_id", "target_entity_id"]


def p1_key_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations and evidence of every source and target entity, beside those of all."""
    return hot_key_totals(table(spark, sf_dir, "relation"), "relation_id", KEY_FIELDS, "evidence_count")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities holding more than 1 in 40 of all relations."""
    totals = hot_key_totals(table(spark, sf_dir, "relation"), "relation_id", KEY_FIELDS, "evidence_count")
    return hot_keys(totals).select("field_name", "entity_id")


_P1_ONE = """one AS (SELECT DISTINCT relation_id, source_entity_id AS s, target_entity_id AS t, evidence_count AS w
  FROM relation WHERE relation_id IS NOT NULL),
keys AS (SELECT 'source_entity_id' AS field_name, s AS entity_id, w FROM one
  UNION ALL SELECT 'target_entity_id', t, w FROM one)"""

P1_SQL = {
    "p1_key_totals": f"""WITH {_P1_ONE}
SELECT field_name, entity_id, count(*)::BIGINT AS n_records, coalesce(sum(w), 0)::BIGINT AS sum_weight,
  (SELECT count(*) FROM one)::BIGINT AS n_all, (SELECT sum(w) FROM one)::BIGINT AS weight_all
FROM keys WHERE entity_id IS NOT NULL GROUP BY field_name, entity_id""",
    "p1_found": f"""WITH {_P1_ONE}
SELECT field_name, entity_id FROM keys WHERE entity_id IS NOT NULL GROUP BY field_name, entity_id
HAVING count(*) * 40 > (SELECT count(*) FROM one)""",
}

#: (table, field, record key, parent table, parent key)
REFERENCES = [
    ("relation", "relation_type_id", "relation_id", "relation_type", "relation_type_id"),
    ("relation", "source_entity_id", "relation_id", "entity", "entity_id"),
    ("evidence", "semantic_unit_id", "relation_mention_id", "semantic_units", "semantic_unit_id"),
]


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        orphan_references(
            table(spark, sf_dir, t), key, field, "created_at", table(spark, sf_dir, parent), pkey, "created_at", "deleted_at"
        ).select(F.lit(t).alias("table_name"), F.lit(field).alias("field_name"), "row_id", "ref", "period", "reason")
        for t, field, key, parent, pkey in REFERENCES
    ]
    return reduce(DataFrame.unionByName, parts)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every orphan reference."""
    return _orphans(spark, sf_dir).select("table_name", "field_name", "row_id", "period").distinct()


def p5_orphans_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans per table, field, month and reason."""
    return _orphans(spark, sf_dir).groupBy("table_name", "field_name", "period", "reason").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("ref").alias("n_refs")
    )


def _p5_sql() -> str:
    parts = []
    for t, field, key, parent, pkey in REFERENCES:
        parts.append(f"""SELECT DISTINCT '{t}' AS table_name, '{field}' AS field_name, r.{key} AS row_id, r.{field} AS ref,
  strftime(r.created_at, '%Y-%m') AS period,
  CASE WHEN NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pkey} = r.{field}) THEN 'missing'
       WHEN NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pkey} = r.{field} AND p.created_at <= r.created_at) THEN 'later'
       ELSE 'deleted' END AS reason
FROM {t} r WHERE r.{field} IS NOT NULL AND r.{key} IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM {parent} p WHERE p.{pkey} = r.{field} AND p.created_at <= r.created_at
  AND (p.deleted_at IS NULL OR p.deleted_at > r.created_at))""")
    return "\nUNION ALL\n".join(parts)


P5_SQL = {
    "p5_found": f"SELECT DISTINCT table_name, field_name, row_id, period FROM ({_p5_sql()})",
    "p5_orphans_by_month": f"""SELECT table_name, field_name, period, reason, count(*)::BIGINT AS n_rows,
  count(DISTINCT ref)::BIGINT AS n_refs FROM ({_p5_sql()}) GROUP BY ALL""",
}

QUERIES = {
    "p1_found": p1_found,
    "p1_key_totals": p1_key_totals,
    "p5_found": p5_found,
    "p5_orphans_by_month": p5_orphans_by_month,
}
SQL = {**P1_SQL, **P5_SQL}
