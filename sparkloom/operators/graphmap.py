"""Mapping of raw mentions onto a property graph."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.ids import stable_id
from sparkloom.functions.text import resolve_self_reference, trim_all
from sparkloom.functions.typing_rules import entity_type
from sparkloom.operators.dictionary import SAMPLES, order_aliases, samples_by_name
from sparkloom.operators.mentions import endpoints
from sparkloom.operators.skew import salted_join


class UnmappedRelationError(ValueError):
    """Predicates that neither the dictionary nor an override resolves."""


@dataclass
class GraphBundle:
    """The lazy record tables of one load."""

    documents: DataFrame
    entities: DataFrame
    relation_types: DataFrame
    relations: DataFrame
    evidence: DataFrame
    entity_mapping: DataFrame
    relation_mapping: DataFrame
    unmapped_entities: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def resolve_endpoints(ends: DataFrame, entity_index: DataFrame) -> DataFrame:
    """Endpoint rows with raw_name, resolved_name, method, entity_id, canonical_name and mapping_status.

    entity_index: name, id, canonical_name. A name the dictionary lacks becomes an entity of its own. Null and blank
    names give no row. The index holds one row per name and is joined salted, as few names hold many mentions."""
    r = ends.filter(F.col("name").isNotNull() & (trim_all(F.col("name")) != "")).withColumn("raw_name", trim_all(F.col("name")))
    r = r.withColumn("_res", resolve_self_reference(F.col("raw_name"), F.coalesce("document_title", F.lit(""))))
    r = r.withColumn("resolved_name", F.col("_res.name")).withColumn("method", F.col("_res.method")).drop("_res", "name")
    ix = entity_index.select(F.col("name").alias("resolved_name"), F.col("id").alias("_id"), F.col("canonical_name").alias("_canon"))
    j = salted_join(r, ix, ["resolved_name"], F.col("relation_mention_id"), "left")
    own = F.col("method") == "current_document_self_reference"
    return j.select(
        *r.columns,
        F.coalesce("_id", stable_id("entity", F.col("resolved_name"))).alias("entity_id"),
        F.coalesce("_canon", "resolved_name").alias("canonical_name"),
        F.col("_id").isNotNull().alias("dictionary_match"),
        F.when(own, F.col("method")).when(F.col("_id").isNull(), "new_raw_entity")
        .when(F.col("raw_name") == F.col("_canon"), "dictionary_canonical").otherwise("dictionary_alias").alias("mapping_status"),
    )


def unmapped_predicates(m: DataFrame, relation_index: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Distinct predicates without a relation type."""
    known = relation_index.select(F.col("name").alias("predicate"))
    if overrides is not None:
        known = known.unionByName(overrides.select(F.col("raw_predicate").alias("predicate")))
    p = m.select(trim_all(F.col("predicate")).alias("predicate")).filter(F.col("predicate").isNotNull()).distinct()
    return p.join(known.distinct(), "predicate", "left_anti")


def invalid_overrides(overrides: DataFrame, relation_dictionary: DataFrame) -> DataFrame:
    """Overrides of unknown relation types, and predicates with several."""
    unknown = overrides.join(relation_dictionary.select("relation_type_id").distinct(), "relation_type_id", "left_anti").select("raw_predicate")
    several = overrides.groupBy("raw_predicate").agg(F.count_distinct("relation_type_id").alias("n")).filter("n > 1").select("raw_predicate")
    return unknown.unionByName(several).distinct()


def map_relations(m: DataFrame, relation_index: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Mentions with relation_type_id and its mapping_status; unresolved ones are left out.

    A name that the index repeats has its smallest id, so no mention is doubled. Few predicates hold many mentions: index and
    overrides are one side of one salted join."""
    ix = relation_index.select(F.col("name").alias("_p"), F.col("id").alias("_rid"), F.lit(None).cast("string").alias("_oid"))
    if overrides is not None:
        ix = ix.unionByName(overrides.select(F.col("raw_predicate").alias("_p"), F.lit(None).cast("string").alias("_rid"), F.col("relation_type_id").alias("_oid")))
    ix = ix.filter(F.col("_p").isNotNull()).groupBy("_p").agg(F.min("_rid").alias("_rid"), F.min("_oid").alias("_oid"))
    j = salted_join(m.withColumn("_p", trim_all(F.col("predicate"))), ix, ["_p"], F.col("relation_mention_id"), "left")
    return j.select(
        *m.columns, F.col("_p").alias("raw_predicate"), F.coalesce("_rid", "_oid").alias("relation_type_id"),
        F.when(F.col("_rid").isNotNull(), "dictionary_alias").otherwise("forced_dictionary_mapping").alias("relation_mapping_status"),
    ).filter(F.col("relation_type_id").isNotNull())


def map_to_graph(
    m: DataFrame, entity_index: DataFrame, relation_index: DataFrame, relation_dictionary: DataFrame,
    overrides: DataFrame | None = None, strict: bool = True,
) -> GraphBundle:
    """Graph records of the mentions (see ``operators.mentions.mentions``).

    Edges are grouped by (source, relation type, target); their evidence stays a long table. Nothing is collected but,
    with ``strict``, up to five offending predicates: an unmapped predicate or an invalid override then raises."""
    if strict:
        if overrides is not None and (bad := invalid_overrides(overrides, relation_dictionary).limit(5).collect()):
            raise ValueError(f"invalid overrides: {[r[0] for r in bad]}")
        if bad := unmapped_predicates(m, relation_index, overrides).orderBy("predicate").limit(5).collect():
            raise UnmappedRelationError(f"unmapped predicates: {[r[0] for r in bad]}")
    mapped = map_relations(m, relation_index, overrides)
    ends = resolve_endpoints(endpoints(mapped), entity_index)
    # one row per mention again: subject and object side by side, keyed by the mention's place
    place = ["semantic_unit_id", "rel_ord"]
    side = lambda role, pre: F.max(F.when(F.col("role") == role, F.struct("entity_id", "canonical_name", "raw_name"))).alias(pre)
    keep = ["document_id", "source_ref", "unit_seq", "relation_mention_id", "raw_predicate", "relation_type_id", "relation_mapping_status"]
    triples = ends.groupBy(*place).agg(
        side("subject", "s"), side("object", "t"), *[F.any_value(c).alias(c) for c in keep]
    ).filter(F.col("s").isNotNull() & F.col("t").isNotNull())
    edge_key = [F.col("s.entity_id"), F.col("relation_type_id"), F.col("t.entity_id")]
    evidence = triples.select(
        stable_id("relation", *edge_key).alias("relation_id"), F.col("s.entity_id").alias("source_entity_id"), F.col("s.canonical_name").alias("source_name"),
        "relation_type_id", F.col("t.entity_id").alias("target_entity_id"), F.col("t.canonical_name").alias("target_name"),
        "relation_mention_id", "semantic_unit_id", "document_id", "source_ref", F.col("s.raw_name").alias("raw_subject"), "raw_predicate", F.col("t.raw_name").alias("raw_object"), "relation_mapping_status",
    )
    relations = evidence.groupBy("relation_id", "source_entity_id", "relation_type_id", "target_entity_id").agg(
        F.min("source_name").alias("source_name"), F.min("target_name").alias("target_name"), F.count(F.lit(1)).alias("evidence_count")
    )
    return GraphBundle(
        documents=m.filter(F.col("document_id").isNotNull()).groupBy("document_id").agg(
            F.min_by("document_title", F.struct("unit_seq", "semantic_unit_id", "rel_ord")).alias("document_title"),
            F.min_by("source_path", F.struct("unit_seq", "semantic_unit_id", "rel_ord")).alias("source_path")),
        entities=entity_records(ends),
        relation_types=relation_dictionary.join(evidence.select("relation_type_id").distinct(), "relation_type_id", "left_semi"),
        relations=relations,
        evidence=evidence,
        entity_mapping=ends.groupBy("raw_name", "resolved_name", "entity_id", "canonical_name", "mapping_status").agg(F.count(F.lit(1)).alias("mention_count")),
        relation_mapping=evidence.groupBy("raw_predicate", "relation_type_id", F.col("relation_mapping_status").alias("mapping_status")).agg(F.count(F.lit(1)).alias("mention_count")),
        unmapped_entities=unmapped_entities(ends),
    )


def entity_records(ends: DataFrame) -> DataFrame:
    """Entities with mention counts and aliases: the canonical name always, counted where the surface equals it or
    where the document named itself; any other surface with its mentions."""
    own = F.col("method") == "current_document_self_reference"
    surface = F.when(own, F.col("canonical_name")).otherwise(F.col("raw_name"))
    per = ends.groupBy("entity_id", "canonical_name", "dictionary_match", surface.alias("name")).agg(F.count(F.lit(1)).alias("n"))
    canon = per.select("entity_id", "canonical_name", "dictionary_match", F.col("canonical_name").alias("name"), F.lit(0).cast("long").alias("n")).distinct()
    aliases = per.unionByName(canon).groupBy("entity_id", "canonical_name", "dictionary_match", "name").agg(F.sum("n").alias("n"))
    out = aliases.groupBy("entity_id", "canonical_name", "dictionary_match").agg(
        F.sum("n").cast("long").alias("mention_count"),
        # distinct surfaces of one entity
        F.collect_list(F.struct("name", F.col("n").alias("mention_count"), (F.col("name") == F.col("canonical_name")).alias("is_canonical"))).alias("aliases"),
    )
    typed = out.withColumn("aliases", order_aliases(F.col("aliases")))
    t = entity_type(F.col("canonical_name"), F.transform(F.col("aliases"), lambda a: a["name"]))
    return typed.withColumn("entity_type", t["entity_type"])


def unmapped_entities(ends: DataFrame, limit: int = SAMPLES) -> DataFrame:
    """Names the dictionary lacks: mentions and samples of up to ``limit`` units."""
    new = ends.filter(~F.col("dictionary_match")).select(
        F.col("resolved_name").alias("name"), "entity_id", "semantic_unit_id", "document_id", "unit_seq", "rel_ord", "end_ord")
    counts = new.groupBy("name", "entity_id").agg(F.count(F.lit(1)).alias("mention_count"))
    s = samples_by_name(new, "name", "semantic_unit_id", ["document_id", "semantic_unit_id"], ["unit_seq", "rel_ord", "end_ord"], limit)
    return counts.join(s, "name")
