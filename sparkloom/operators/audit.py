"""Audits: each gives one row of named counts and a verdict, computed on the cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.ids import stable_id
from sparkloom.functions.text import (
    GENERIC_ENDPOINTS, LEGAL_QUALIFIER, LISTED_ACTIONS, LISTING, NUMERIC_CONSTRAINT, SELF_REFERENCES, is_discardable, is_uuid, resolve_self_reference, trim_all,
)
from sparkloom.functions.typing_rules import ENTITY_TYPES
from sparkloom.operators.dictionary import alias_conflicts, alias_rows
from sparkloom.operators.mentions import coverage, endpoints, mentions

#: Fields that a raw record takes over from its unit, where it has them.
SOURCE_FIELDS = ("document_id", "document_title", "source_path", "source_ref", "context_text", "unit_text", "unit_kind")
#: Most relation types of a release.
RELATION_TYPES = 100


def doubled(df: DataFrame, key: str) -> DataFrame:
    """Keys that stand in more than one distinct row."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    p = parent.select(F.col(parent_key).alias(key)).filter(F.col(key).isNotNull()).distinct()
    return child.filter(F.col(key).isNotNull()).join(p, key, "left_anti")


def missing_and_extra(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(missing, extra): distinct keys of ``a`` that ``b`` lacks and the other way round."""
    j = a.select(key).distinct().withColumn("_a", F.lit(1)).join(b.select(key).distinct().withColumn("_b", F.lit(1)), key, "full_outer")
    return j.agg(F.count_if(F.col("_b").isNull()).alias("missing"), F.count_if(F.col("_a").isNull()).alias("extra"))


def side_by_side(*frames: DataFrame, **counts: DataFrame) -> DataFrame:
    """One row from one-row frames, of several named columns each or of one column named here, and passed: whether all are 0.

    The frames are tagged and pivoted by an aggregate, so no join of single rows is needed."""
    rows, names = None, []
    for df in [*frames, *[df.toDF(name) for name, df in counts.items()]]:
        names += df.columns
        part = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("long").alias("n")) for c in df.columns])).alias("x")).select("x.*")
        rows = part if rows is None else rows.unionByName(part)
    out = rows.agg(*[F.coalesce(F.max(F.when(F.col("name") == c, F.col("n"))), F.lit(0)).alias(c) for c in names])
    total = sum((F.col(c) for c in names), F.lit(0))
    return out.withColumn("passed", total == 0)


def flaws(df: DataFrame, **tests: Column) -> DataFrame:
    """One row with the number of rows that fail each test, in one pass."""
    return df.agg(*[F.count_if(t).alias(n) for n, t in tests.items()])


def count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def conflicting(df: DataFrame, key: str, content: list[str]) -> DataFrame:
    """Keys whose rows differ in ``content``; repeated rows are none."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(F.struct(*content)).alias("n")).filter("n > 1")


def blank(c: str) -> Column:
    return F.col(c).isNull() | (trim_all(F.col(c)) == "")


def missing_reference(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of ``child`` whose reference is null or has no record."""
    p = parent.select(F.col(parent_key).alias(key)).filter(F.col(key).isNotNull()).distinct()
    return child.join(p, key, "left_anti")


def malformed(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct().agg(F.count_if(~F.coalesce(is_uuid(F.col(key)), F.lit(False))))


def _raw_flaws(raw: DataFrame) -> DataFrame:
    return flaws(
        mentions(raw), malformed_ids=~F.coalesce(is_uuid(F.col("relation_mention_id")), F.lit(False)),
        blank_subjects=blank("subject"), blank_predicates=blank("predicate"), blank_objects=blank("object"))


def _raw_checks(units: DataFrame, raw: DataFrame) -> dict[str, DataFrame]:
    m = mentions(raw)
    return dict(
        units_without_record=count(units.select("semantic_unit_id").distinct().join(raw.select("semantic_unit_id").distinct(), "semantic_unit_id", "left_anti")),
        records_without_unit=count(raw.select("semantic_unit_id").distinct().join(units.select("semantic_unit_id").distinct(), "semantic_unit_id", "left_anti")),
        doubled_mentions=count(doubled(m, "relation_mention_id")),
    )


def audit_raw(units: DataFrame, raw: DataFrame) -> DataFrame:
    """Coverage of raw records by units, form and uniqueness of mention ids, blank endpoints and predicates.

    Its verdict covers these checks only; ``audit_raw_release`` has them all. Quality counters: ``raw_quality``.
    Repeated rows count once."""
    return side_by_side(_raw_flaws(raw), **_raw_checks(units, raw))


def audit_raw_release(units: DataFrame, raw: DataFrame) -> DataFrame:
    """All hard checks of raw records: those of ``audit_raw``; one content per unit and per record; the fields taken over
    from the unit unchanged (SOURCE_FIELDS, as far as both tables have them) and its place kept; a list of relations in
    every record; ids recomputed from the whole triples; triples unique within a record."""
    both = [c for c in SOURCE_FIELDS if c in units.columns and c in raw.columns]
    held = [*[c for c in SOURCE_FIELDS if c in raw.columns], "unit_seq"]
    side = lambda df, name: df.filter(F.col("semantic_unit_id").isNotNull()).select("semantic_unit_id", F.struct(*both).alias(name), F.col("unit_seq").alias(f"{name}_seq")).distinct()
    pairs = side(units, "u").join(side(raw, "r"), "semantic_unit_id").groupBy("semantic_unit_id").agg(
        F.bool_and(F.col("u").eqNullSafe(F.col("r"))).alias("same"), F.bool_and(F.col("u_seq").eqNullSafe(F.col("r_seq"))).alias("placed"))
    whole = mentions(raw).filter(~blank("subject") & ~blank("predicate") & ~blank("object"))
    triple = ["semantic_unit_id", "subject", "predicate", "object"]
    return side_by_side(
        _raw_flaws(raw), **_raw_checks(units, raw),
        conflicting_units=count(conflicting(units, "semantic_unit_id", [*[c for c in SOURCE_FIELDS if c in units.columns], "unit_seq"])),
        conflicting_records=count(conflicting(raw, "semantic_unit_id", [*held, "relations"])),
        changed_sources=pairs.agg(F.count_if(~F.col("same"))), moved_records=pairs.agg(F.count_if(~F.col("placed"))),
        records_without_list=count(raw.filter(F.col("relations").isNull()).select("semantic_unit_id").distinct()),
        wrong_ids=whole.agg(F.count_if(~F.col("relation_mention_id").eqNullSafe(stable_id("raw_svo_mention", *[F.col(c) for c in triple])))),
        doubled_triples=whole.groupBy(*triple).agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.sum("n")),
    )


def raw_quality(raw: DataFrame, units: DataFrame) -> DataFrame:
    """(name, n) of mentions that deserve a look: general or quantity endpoints, loops, quantities, citations as qualifiers
    and enumerations inside, leaf items whose relation holds nothing of their own text; and units without relations."""
    m = mentions(raw)
    empty = raw.groupBy("semantic_unit_id").agg(F.max(F.coalesce(F.size("relations"), F.lit(0))).alias("n"))
    ends = ("subject", "object")
    both = lambda test: sum((F.count_if(test(F.col(c))) for c in ends), F.lit(0))
    q = m.agg(
        F.count(F.lit(1)).alias("n_mentions"),
        F.count_if(is_discardable(trim_all(F.col("subject")))).alias("n_discardable_subjects"),
        F.count_if(is_discardable(trim_all(F.col("object")))).alias("n_discardable_objects"),
        F.count_if(trim_all(F.col("subject")) == trim_all(F.col("object"))).alias("n_loops"),
    )
    whole = m.filter(~blank("subject") & ~blank("predicate") & ~blank("object"))
    w = whole.agg(
        both(lambda c: c.rlike(NUMERIC_CONSTRAINT)).alias("n_numeric_constraints"), both(lambda c: c.rlike(LEGAL_QUALIFIER)).alias("n_legal_qualifiers"),
        both(lambda c: trim_all(c).isin(GENERIC_ENDPOINTS)).alias("n_generic_endpoints"),
        (both(lambda c: c.rlike(LISTING)) + F.count_if(F.col("predicate").rlike(LISTING) | F.col("predicate").contains(LISTED_ACTIONS))).alias("n_enumerations"),
    )
    leaf = units.groupBy("semantic_unit_id").agg(F.min(F.struct("unit_kind", "unit_text")).alias("u")).filter("u.unit_kind = 'terminal_item'")
    text = F.coalesce(F.col("u.unit_text"), F.lit(""))
    foreign = ~(text.contains(F.col("subject")) | text.contains(F.col("predicate")) | text.contains(F.col("object")))
    c = whole.join(leaf, "semantic_unit_id").agg(F.count_if(foreign).alias("n_context_only_relations"))
    e = empty.agg(F.count_if(F.col("n") <= 0).alias("n_units_without_relations"))
    out = None
    for df in (q, w, c, e):
        part = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("n")) for n in df.columns])).alias("x")).select("x.*")
        out = part if out is None else out.unionByName(part)
    return out


def _one_entity(entities: DataFrame) -> DataFrame:
    return entities.groupBy("entity_id").agg(F.min("canonical_name").alias("canonical_name"), F.min("entity_type").alias("entity_type"), F.min("mention_count").alias("mention_count"), F.min("aliases").alias("aliases"))


def _dictionary_flaws(entities: DataFrame, **more: Column) -> DataFrame:
    tests = dict(
        wrong_ids=F.col("entity_id") != stable_id("entity", F.col("canonical_name")),
        unknown_types=~F.coalesce(F.col("entity_type").isin(ENTITY_TYPES), F.lit(False)),
        not_led_by_canonical=~F.coalesce(F.get(F.col("aliases"), F.lit(0))["name"] == F.col("canonical_name"), F.lit(False)),
        not_mentioned=F.coalesce("mention_count", F.lit(0)) < 1,
    )
    return flaws(_one_entity(entities), **{**tests, **more})


def _dictionary_checks(entities: DataFrame) -> dict[str, DataFrame]:
    one = _one_entity(entities)
    return dict(doubled_names=count(doubled(one, "canonical_name")), alias_conflicts=count(alias_conflicts(one, "entity_id")))


def audit_dictionary(entities: DataFrame) -> DataFrame:
    """Checks of an entity dictionary alone: ids recomputed, names unique, types known, aliases led by the canonical name,
    counts positive, no alias of two entities. ``audit_dictionary_release`` has those of a whole release."""
    return side_by_side(_dictionary_flaws(entities), **_dictionary_checks(entities))


def audit_dictionary_release(entities: DataFrame, relation_types: DataFrame, raw: DataFrame, expected_types: int = 98) -> DataFrame:
    """All checks of a release: those of ``audit_dictionary``; ids without name or in rows that differ; no scope fields, no alias by which a document names itself, no name that is a
    quantity; the relation types' ids, names, aliases and number; every raw name and predicate found.

    Types without an aliases column have no leading alias. Null and blank raw names are ``audit_raw``'s."""
    bare = F.array().cast("array<struct<name:string,mention_count:long>>")
    types = relation_types
    for c, default in (("aliases", bare), ("mention_count", F.lit(0).cast("long"))):
        types = types if c in types.columns else types.withColumn(c, default)
    t = types.groupBy("relation_type_id").agg(*[F.min(c).alias(c) for c in ("canonical_name", "mention_count", "aliases")])
    e = entities.groupBy("entity_id").agg(*[F.min(c).alias(c) for c in ("canonical_name", "mention_count", "aliases")])
    m = mentions(raw)
    ends = endpoints(m).filter(~blank("name")).select(resolve_self_reference(F.col("name"), F.coalesce("document_title", F.lit("")))["name"].alias("name")).distinct()
    predicates = m.filter(~blank("predicate")).select(trim_all(F.col("predicate")).alias("name")).distinct()
    own = e.select(F.explode("aliases").alias("a")).filter(F.col("a.name").isin(SELF_REFERENCES)).select("a.name").distinct()
    scoped = int("scope" in entities.columns) + int("scope" in entities.schema["aliases"].dataType.elementType.names)
    n = t.agg(F.count(F.lit(1)).alias("n"))
    stable = lambda kind, key: ~F.col(key).eqNullSafe(stable_id(kind, F.col("canonical_name")))
    return side_by_side(
        _dictionary_flaws(entities, wrong_ids=stable("entity", "entity_id"), numeric_names=trim_all(F.col("canonical_name")).rlike(rf"\A(?:{NUMERIC_CONSTRAINT})\z")),
        flaws(t, wrong_type_ids=stable("relation_type", "relation_type_id"),
              types_not_led_by_canonical=~F.coalesce(F.get(F.col("aliases"), F.lit(0))["name"] == F.col("canonical_name"), F.lit(False))),
        **_dictionary_checks(entities),
        conflicting_ids=count(conflicting(entities, "entity_id", ["canonical_name", "entity_type", "mention_count", "aliases"])),
        scope_fields=n.select(F.lit(scoped)),
        self_reference_aliases=count(own),
        conflicting_type_ids=count(conflicting(types, "relation_type_id", ["canonical_name", "mention_count", "aliases"])),
        doubled_type_names=count(doubled(t, "canonical_name")),
        type_alias_conflicts=count(alias_conflicts(t, "relation_type_id")),
        unmapped_names=count(ends.join(alias_rows(e, "entity_id").select("name").distinct(), "name", "left_anti")),
        unmapped_predicates=count(predicates.join(alias_rows(t, "relation_type_id").select("name").distinct(), "name", "left_anti")),
        types_unexpected=n.select(F.abs(F.col("n") - expected_types)),
        types_too_many=n.select(F.greatest(F.col("n") - RELATION_TYPES, F.lit(0))),
    )


def _graph_checks(relations: DataFrame, evidence: DataFrame, entities: DataFrame, relation_types: DataFrame) -> dict[str, DataFrame]:
    e = evidence.select("relation_mention_id", "relation_id").distinct()
    r = relations.groupBy("relation_id").agg(*[F.max(c).alias(c) for c in ("source_entity_id", "target_entity_id", "relation_type_id", "evidence_count")])
    seen = e.groupBy("relation_id").agg(F.count(F.lit(1)).alias("n"))
    return dict(
        source_orphans=count(orphans(r, "source_entity_id", entities, "entity_id")),
        target_orphans=count(orphans(r, "target_entity_id", entities, "entity_id")),
        type_orphans=count(orphans(r, "relation_type_id", relation_types, "relation_type_id")),
        evidence_orphans=count(orphans(e, "relation_id", r, "relation_id")),
        wrong_counts=r.join(seen, "relation_id", "left").agg(F.count_if(~F.col("evidence_count").eqNullSafe(F.coalesce("n", F.lit(0))))),
        doubled_mentions=count(doubled(e, "relation_mention_id")),
    )


def audit_graph(relations: DataFrame, evidence: DataFrame, entities: DataFrame, relation_types: DataFrame) -> DataFrame:
    """References between the four graph tables, evidence counts and uniqueness of mentions; null references are not
    counted. ``audit_graph_release`` has the checks of a whole load."""
    return side_by_side(**_graph_checks(relations, evidence, entities, relation_types))


def audit_graph_release(relations: DataFrame, evidence: DataFrame, entities: DataFrame, relation_types: DataFrame, units: DataFrame, documents: DataFrame,
                        raw: DataFrame | None = None) -> DataFrame:
    """All checks of a load's tables: those of ``audit_graph``; null references; ids malformed or in rows that differ;
    entity types; units with their document and source; evidence with its unit and at that unit's place; with ``raw``, its
    records, one content a unit, and the same mentions on both sides. The files of other stores are not read."""
    shown = evidence.select("relation_mention_id", "relation_id", "semantic_unit_id", "document_id", "source_ref").distinct()
    u = units.select("semantic_unit_id", "document_id", "source_ref", "context_text", "unit_text", "unit_kind").distinct()
    at = u.filter(F.col("semantic_unit_id").isNotNull()).select("semantic_unit_id", F.struct("document_id", "source_ref").alias("at")).distinct()
    here = F.col("e_at").eqNullSafe(F.col("at"))
    placed = shown.withColumn("e_at", F.struct("document_id", "source_ref")).join(at, "semantic_unit_id").groupBy("relation_mention_id", "relation_id", "semantic_unit_id", "e_at").agg(F.bool_or(here).alias("here"))
    distinct_ids = lambda df, cols: count(df.filter(F.greatest(*[F.col(c).isNull().cast("int") for c in cols]) == 1).select("relation_id").distinct())
    more = dict(
        null_references=distinct_ids(relations, ["source_entity_id", "target_entity_id", "relation_type_id"]),
        malformed_entity_ids=malformed(entities, "entity_id"), malformed_type_ids=malformed(relation_types, "relation_type_id"), malformed_relation_ids=malformed(relations, "relation_id"),
        conflicting_entities=count(conflicting(entities, "entity_id", ["canonical_name", "entity_type"])),
        conflicting_types=count(conflicting(relation_types, "relation_type_id", [c for c in ("canonical_name", "polarity") if c in relation_types.columns])),
        conflicting_relations=count(conflicting(relations, "relation_id", ["source_entity_id", "relation_type_id", "target_entity_id"])),
        unknown_entity_types=count(entities.filter(~F.coalesce(F.col("entity_type").isin(ENTITY_TYPES), F.lit(False))).select("entity_id").distinct()),
        conflicting_units=count(conflicting(u, "semantic_unit_id", [c for c in u.columns if c != "semantic_unit_id"])),
        units_without_document=count(missing_reference(u.select("semantic_unit_id", "document_id").distinct(), "document_id", documents, "document_id")),
        units_without_source=count(u.filter(F.col("source_ref").isNull() | F.col("context_text").isNull() | blank("unit_text") | blank("unit_kind")).select("semantic_unit_id").distinct()),
        evidence_without_unit=count(missing_reference(shown, "semantic_unit_id", units, "semantic_unit_id")),
        misplaced_evidence=placed.agg(F.count_if(~F.col("here"))),
    )
    if raw is not None:
        made, used = mentions(raw).select("relation_mention_id"), evidence.select("relation_mention_id")
        ids = missing_and_extra(made, used, "relation_mention_id")
        more |= dict(
            units_without_record=count(missing_reference(u.select("semantic_unit_id").distinct(), "semantic_unit_id", raw, "semantic_unit_id")),
            conflicting_records=count(conflicting(raw, "semantic_unit_id", ["document_id", "source_ref", "relations"])),
            mentions_without_evidence=ids.select("missing"), evidence_without_mention=ids.select("extra"),
        )
    return side_by_side(**_graph_checks(relations, evidence, entities, relation_types), **more)


def audit_contexts(units: DataFrame, resolved: DataFrame) -> DataFrame:
    """Resolved units against their source: coverage, unchanged sources, known resolution types, no empty text."""
    u = units.groupBy("semantic_unit_id").agg(F.min("unit_text").alias("t"), F.min("context_text").alias("c"))
    r = resolved.groupBy("semantic_unit_id").agg(F.min("unit_text").alias("rt"), F.min("context_text").alias("rc"), F.min("resolved_text").alias("x"), F.min("resolution_type").alias("k"))
    j = u.join(r, "semantic_unit_id")
    return side_by_side(
        missing=missing_and_extra(u, r, "semantic_unit_id").select("missing"), extra=missing_and_extra(u, r, "semantic_unit_id").select("extra"),
        changed_sources=j.agg(F.count_if(~(F.col("t").eqNullSafe(F.col("rt")) & F.col("c").eqNullSafe(F.col("rc"))))),
        unknown_types=j.agg(F.count_if(~F.coalesce(F.col("k").isin("UNRESOLVED", "COPIED", "CONTEXT_INHERITED"), F.lit(False)))),
        empty_texts=j.agg(F.count_if((F.col("k") != "UNRESOLVED") & (F.coalesce(trim_all(F.col("x")), F.lit("")) == ""))),
    )


def audit_surface_lists(listed: DataFrame, ends: DataFrame) -> DataFrame:
    """A surface list (name, mention_count, semantic_unit_id) against the endpoints it was made of: every name once, with its
    number of mentions and a unit that holds it."""
    e = ends.filter(F.col("name").isNotNull())
    own = e.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    j = listed.select("name", "mention_count").join(own, "name")
    held = listed.select("name", "semantic_unit_id").join(e.select("name", "semantic_unit_id").distinct(), ["name", "semantic_unit_id"], "left_anti")
    return side_by_side(
        missing=missing_and_extra(own, listed, "name").select("missing"), extra=missing_and_extra(own, listed, "name").select("extra"),
        doubled=count(doubled(listed, "name")), wrong_counts=j.agg(F.count_if(F.col("mention_count") != F.col("n"))), foreign_evidence=count(held),
    )


def audit_closed_dictionary(closed: DataFrame, source: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """A closed relation dictionary against its sources and taxonomy: names of the taxonomy only, ids recomputed, unique, all
    mentions kept."""
    names = taxonomy.select(F.explode(F.array("positive_name", "negative_name")).alias("canonical_name")).distinct()
    kept = mentions_preserved(source, closed)
    return side_by_side(
        outside_taxonomy=count(closed.join(names, "canonical_name", "left_anti")),
        wrong_ids=closed.agg(F.count_if(F.col("relation_type_id") != stable_id("relation_type", F.col("canonical_name")))),
        doubled_ids=count(doubled(closed, "relation_type_id")),
        lost_mentions=kept.select((F.coalesce("n_before", F.lit(0)) - F.coalesce("n_after", F.lit(0))).alias("n")),
    )


def audit_types(entities: DataFrame) -> DataFrame:
    """Every entity type with its number of entities, types without any as 0, unknown and null ones as UNKNOWN."""
    spark = entities.sparkSession
    known = spark.createDataFrame([(t,) for t in [*ENTITY_TYPES, "UNKNOWN"]], "entity_type string")
    one = entities.groupBy("entity_id").agg(F.min("entity_type").alias("t"))
    c = one.groupBy(F.when(F.col("t").isin(ENTITY_TYPES), F.col("t")).otherwise("UNKNOWN").alias("entity_type")).agg(F.count(F.lit(1)).alias("n"))
    return known.join(c, "entity_type", "left").select("entity_type", F.coalesce("n", F.lit(0)).alias("n_entities"))


def mentions_preserved(before: DataFrame, after: DataFrame, column: str = "mention_count") -> DataFrame:
    """One row: the sums of both sides and whether they agree."""
    rows = before.agg(F.sum(column).alias("n")).withColumn("s", F.lit("before")).unionByName(after.agg(F.sum(column).alias("n")).withColumn("s", F.lit("after")))
    out = rows.agg(F.max(F.when(F.col("s") == "before", F.col("n"))).alias("n_before"), F.max(F.when(F.col("s") == "after", F.col("n"))).alias("n_after"))
    return out.withColumn("passed", F.col("n_before").eqNullSafe(F.col("n_after")))


__all__ = ["audit_closed_dictionary", "audit_contexts", "audit_dictionary", "audit_dictionary_release", "audit_graph", "audit_graph_release", "audit_raw", "audit_raw_release", "audit_surface_lists", "audit_types", "coverage", "mentions_preserved", "missing_and_extra", "raw_quality"]
