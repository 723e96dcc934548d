"""Dictionaries of entities and relation types: candidates, grouping, aliases, conflicts, closed taxonomies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkloom.functions.ids import stable_id
from sparkloom.functions.text import infer_polarity, looks_mojibake, trim_all

SAMPLES = 5


class DictionaryConflictError(ValueError):
    """One name belongs to several ids."""


def samples_by_name(rows: DataFrame, name: str, per: str, sample: list[str], order: list[str], limit: int = SAMPLES) -> DataFrame:
    """(name, samples): the first occurrences in the ``limit`` first distinct ``per`` of each name, in order.

    Occurrences are first folded per (name, per) by an algebraic minimum, so the window ranks distinct units only;
    its rank filter is pushed below the shuffle by the planner."""
    o = F.struct(*[F.col(c) for c in order])
    firsts = rows.groupBy(name, per).agg(F.min(F.struct(o.alias("o"), *[F.col(c).alias(f"s_{c}") for c in sample])).alias("f"))
    ranked = firsts.withColumn("rn", F.row_number().over(W.partitionBy(name).orderBy("f.o", per))).filter(F.col("rn") <= limit)
    # at most ``limit`` elements a name
    ordered = F.array_sort(F.collect_list(F.struct("rn", *[F.col(f"f.s_{c}").alias(c) for c in sample])))
    return ranked.groupBy(name).agg(F.transform(ordered, lambda x: F.struct(*[x[c].alias(c) for c in sample])).alias("samples"))


def candidates(rows: DataFrame, kind: str, limit: int = SAMPLES) -> DataFrame:
    """Candidate dictionary of exact surfaces: id, name, mention_count and samples.

    ``rows``: name, semantic_unit_id, document_id, unit_seq, rel_ord, end_ord. Null names are none."""
    r = rows.filter(F.col("name").isNotNull())
    counts = r.groupBy("name").agg(F.count(F.lit(1)).alias("mention_count"))
    s = samples_by_name(r, "name", "semantic_unit_id", ["document_id", "semantic_unit_id"], ["unit_seq", "rel_ord", "end_ord"], limit)
    return counts.join(s, "name").select(stable_id(kind, F.col("name")).alias("candidate_id"), "name", "mention_count", "samples")


def surface_lists(ends: DataFrame) -> DataFrame:
    """(name, semantic_unit_id, document_title, roles, mention_count): first evidence, roles as first seen."""
    e = ends.filter(F.col("name").isNotNull())
    o = F.struct("unit_seq", "rel_ord", "end_ord")
    roles = e.groupBy("name", "role").agg(F.min(o).alias("o"), F.count(F.lit(1)).alias("n"),
                                          F.min(F.struct(o.alias("o"), "semantic_unit_id", "document_title")).alias("f"))
    return roles.groupBy("name").agg(
        F.min("f").alias("f"), F.transform(F.array_sort(F.collect_list(F.struct("o", "role"))), lambda x: x["role"]).alias("roles"),
        F.sum("n").cast("long").alias("mention_count"),
    ).select("name", "f.semantic_unit_id", "f.document_title", "roles", "mention_count")


def alias_rows(dictionary: DataFrame, id_col: str) -> DataFrame:
    """(name, id, alias_count, is_canonical, entity_count, canonical_name): canonical names and aliases as rows."""
    canon = dictionary.select(F.trim("canonical_name").alias("name"), F.col(id_col).alias("id"), "canonical_name", "mention_count", F.lit(None).cast("long").alias("alias_count"))
    ali = dictionary.select(F.explode("aliases").alias("a"), id_col, "canonical_name", "mention_count").select(
        F.trim("a.name").alias("name"), F.col(id_col).alias("id"), "canonical_name", "mention_count", F.col("a.mention_count").alias("alias_count")
    )
    rows = canon.unionByName(ali).filter(F.col("name").isNotNull() & (F.col("name") != ""))
    return rows.groupBy("name", "id").agg(
        F.min("canonical_name").alias("canonical_name"), F.max("mention_count").alias("entity_count"),
        F.max(F.coalesce("alias_count", F.lit(0))).alias("alias_count"),
    ).withColumn("is_canonical", F.col("name") == F.trim("canonical_name"))


def alias_conflicts(dictionary: DataFrame, id_col: str) -> DataFrame:
    """Names that belong to more than one id."""
    return alias_rows(dictionary, id_col).groupBy("name").agg(F.count_distinct("id").alias("n_ids"), F.min("id").alias("first_id")).filter("n_ids > 1")


def alias_winners(dictionary: DataFrame, id_col: str) -> DataFrame:
    """(name, id): each name with one owner: its own canonical entry first, then the higher alias count, the
    higher entity count, the smaller canonical name and id. A min over structs, so no window is needed."""
    rank = F.struct(
        (~F.col("is_canonical")).alias("a"), (-F.col("alias_count")).alias("b"), (-F.col("entity_count")).alias("c"),
        F.col("canonical_name").alias("d"), F.col("id").alias("id"),
    )
    return alias_rows(dictionary, id_col).groupBy("name").agg(F.min(rank).alias("w")).select("name", F.col("w.id").alias("id"), F.col("w.d").alias("canonical_name"))


def alias_index(dictionary: DataFrame, id_col: str) -> DataFrame:
    """(name, id) of a dictionary without conflicts; raises DictionaryConflictError otherwise."""
    bad = alias_conflicts(dictionary, id_col).orderBy("name").limit(5).collect()
    if bad:
        raise DictionaryConflictError(f"names with several ids: {[r['name'] for r in bad]}")
    return alias_rows(dictionary, id_col).select("name", "id", "canonical_name")


def direct_alias_map(dictionary: DataFrame, id_col: str, keep_zero: bool) -> DataFrame:
    """(alias, canonical_name, id, mention_count) of a dictionary; entity maps keep aliases without mentions,
    relation maps do not."""
    a = dictionary.select(F.explode("aliases").alias("a"), "canonical_name", id_col).select(
        F.col("a.name").alias("alias"), "canonical_name", F.col(id_col).alias("id"), F.col("a.mention_count").alias("mention_count")
    )
    return a if keep_zero else a.filter("mention_count > 0")


def order_aliases(aliases: Column) -> Column:
    """Canonical first, then by count downwards and name."""
    key = F.transform(aliases, lambda a: F.struct((~a["is_canonical"]).alias("k"), (-a["mention_count"]).alias("c"), a["name"].alias("name")))
    return F.transform(F.array_sort(key), lambda a: F.struct(a["name"].alias("name"), (-a["c"]).alias("mention_count"), (~a["k"]).alias("is_canonical")))


def clustered_dictionary(entities: DataFrame, mapping: DataFrame, overrides: DataFrame | None = None, limit: int = SAMPLES) -> DataFrame:
    """Entities merged by canonical name.

    entities: name (or canonical_name), mention_count and, where known, aliases and samples. mapping: source_name,
    canonical_name. overrides: alias, canonical_name; an override beats the mapping, the mapping beats the name itself.
    Aliases of a source move with it; its own name keeps what they leave of its mentions, 0 at least. Override aliases
    without mentions are added with count 0 and belong to no other entity. Any other alias of several entities goes to the
    one it is the canonical name of, else to that of the higher alias count, entity count and smaller name. An entity counts
    all mentions of its sources, those of an alias it lost too. Columns: entity_id, canonical_name, mention_count, aliases
    (canonical first, always present) and, where given, samples, ``limit`` at most, by source name and their own order."""
    src = entities if "name" in entities.columns else entities.withColumnRenamed("canonical_name", "name")
    extra = [c for c in ("aliases", "samples") if c in src.columns]
    src = src.select("name", "mention_count", *extra).join(mapping.select(F.col("source_name").alias("name"), F.col("canonical_name").alias("m")), "name", "left")
    if overrides is not None:
        src = src.join(overrides.select(F.col("alias").alias("name"), F.col("canonical_name").alias("o")), "name", "left")
    else:
        src = src.withColumn("o", F.lit(None).cast("string"))
    src = src.withColumn("canonical_name", F.coalesce("o", "m", "name"))
    zero = F.lit(0).cast("long")
    if "aliases" in extra:
        told = F.aggregate(F.coalesce("aliases", F.array().cast(src.schema["aliases"].dataType)), zero, lambda n, x: n + F.coalesce(x["mention_count"], zero))
        rows = src.select("canonical_name", F.col("name").alias("alias"), F.greatest(F.col("mention_count") - told, zero).alias("mention_count"))
        moved = src.select("canonical_name", F.explode("aliases").alias("a")).select("canonical_name", F.trim("a.name").alias("alias"), F.coalesce("a.mention_count", zero).alias("mention_count"))
        rows = rows.unionByName(moved.filter(F.col("alias") != ""))
    else:
        rows = src.select("canonical_name", F.col("name").alias("alias"), "mention_count")
    totals = src.select("canonical_name", "mention_count")
    if overrides is not None:
        own = overrides.select("alias", F.col("canonical_name").alias("o")).distinct()
        rows = rows.join(own, "alias", "left").filter(F.col("o").isNull() | (F.col("o") == F.col("canonical_name"))).select("canonical_name", "alias", "mention_count")
        rows = rows.unionByName(overrides.select("canonical_name", "alias", zero.alias("mention_count")))
        totals = totals.unionByName(overrides.select("canonical_name", zero.alias("mention_count")))
    totals = totals.groupBy("canonical_name").agg(F.sum("mention_count").cast("long").alias("total"))
    canon = totals.select("canonical_name", F.col("canonical_name").alias("alias"), zero.alias("mention_count"))
    per = rows.unionByName(canon).groupBy("canonical_name", "alias").agg(F.sum("mention_count").cast("long").alias("mention_count")).join(totals, "canonical_name")
    claim = F.struct((F.col("canonical_name") != F.col("alias")).alias("a"), (-F.col("mention_count")).alias("b"), (-F.col("total")).alias("c"), F.col("canonical_name").alias("d"))
    won = per.withColumn("w", F.min(claim).over(W.partitionBy("alias"))).filter(F.col("w.d") == F.col("canonical_name"))
    out = _merge_aliases(won.select("canonical_name", "alias", "mention_count"), "entity", "entity_id").join(totals, "canonical_name")
    out = out.select("entity_id", "canonical_name", F.col("total").alias("mention_count"), "aliases")
    if "samples" not in extra:
        return out
    shown = samples_by_name(src.select("canonical_name", "name", F.posexplode("samples").alias("i", "s")), "canonical_name", "s", ["s"], ["name", "i"], limit)
    none = F.array().cast(src.schema["samples"].dataType)
    return out.join(shown, "canonical_name", "left").select(*out.columns, F.coalesce(F.transform("samples", lambda x: x["s"]), none).alias("samples"))


def _merge_aliases(per: DataFrame, kind: str, id_col: str) -> DataFrame:
    grouped = per.groupBy("canonical_name").agg(
        F.sum("mention_count").cast("long").alias("mention_count"),
        F.collect_list(F.struct(F.col("alias").alias("name"), "mention_count", (F.col("alias") == F.col("canonical_name")).alias("is_canonical"))).alias("aliases"),
    )
    return grouped.select(stable_id(kind, F.col("canonical_name")).alias(id_col), "canonical_name", "mention_count", order_aliases(F.col("aliases")).alias("aliases"))


class UnmappedSourceError(ValueError):
    """Source relation types that the closed mapping leaves out."""


def closed_relation_dictionary(relations: DataFrame, mapping: DataFrame, taxonomy: DataFrame, strict: bool = False) -> DataFrame:
    """Source relation types summed into the closed taxonomy.

    relations: canonical_name, polarity, mention_count and, where known, aliases (else a source is its own only alias).
    mapping: source_canonical_name, source_polarity, family_id. taxonomy: family_id, positive_name, negative_name. Sources
    without a mapping into the taxonomy (``unmapped_relations``) are in no family; with ``strict`` they raise. Aliases are
    merged by name, the canonical one first and always present. Both polarities of a name are told apart."""
    if strict and (bad := unmapped_relations(relations, mapping, taxonomy).orderBy("canonical_name", "polarity").limit(5).collect()):
        raise UnmappedSourceError(f"relation types without a family: {[(r['canonical_name'], r['polarity']) for r in bad]}")
    m = mapping.select(F.col("source_canonical_name").alias("canonical_name"), F.col("source_polarity").alias("polarity"), "family_id")
    j = relations.join(m, ["canonical_name", "polarity"]).join(taxonomy, "family_id")
    target = F.when(F.col("polarity") == "POSITIVE", F.col("positive_name")).otherwise(F.col("negative_name"))
    j = j.withColumn("target_name", target)
    key = ["target_name", "polarity", "family_id"]
    totals = j.groupBy(*key).agg(F.sum("mention_count").cast("long").alias("mention_count"), F.count(F.lit(1)).alias("source_relation_type_count"))
    if "aliases" in relations.columns:
        named = j.select(*key, F.explode("aliases").alias("a")).select(*key, F.col("a.name").alias("name"), F.coalesce("a.mention_count", F.lit(0)).cast("long").alias("n"))
        named = named.filter(trim_all(F.col("name")) != "")
    else:
        named = j.select(*key, F.col("canonical_name").alias("name"), F.col("mention_count").cast("long").alias("n"))
    canon = totals.select(*key, F.col("target_name").alias("name"), F.lit(0).cast("long").alias("n"))
    per = named.unionByName(canon).groupBy(*key, "name").agg(F.sum("n").cast("long").alias("n"))
    # distinct surfaces of one type
    aliases = per.groupBy(*key).agg(F.collect_list(F.struct("name", F.col("n").alias("mention_count"), (F.col("name") == F.col("target_name")).alias("is_canonical"))).alias("aliases"))
    return totals.join(aliases, key).select(
        stable_id("relation_type", F.col("target_name")).alias("relation_type_id"), F.col("target_name").alias("canonical_name"), "polarity", "family_id",
        "mention_count", "source_relation_type_count", order_aliases(F.col("aliases")).alias("aliases"))


def unmapped_relations(relations: DataFrame, mapping: DataFrame, taxonomy: DataFrame | None = None) -> DataFrame:
    """Source relation types without a mapping or, with a taxonomy, without one into its families and a name there."""
    m = mapping.select(F.col("source_canonical_name").alias("canonical_name"), F.col("source_polarity").alias("polarity"), "family_id").distinct()
    if taxonomy is not None:
        target = F.when(F.col("polarity") == "POSITIVE", F.col("positive_name")).otherwise(F.col("negative_name"))
        m = m.join(taxonomy.select("family_id", "positive_name", "negative_name"), "family_id").filter(target.isNotNull())
    return relations.join(m.select("canonical_name", "polarity").distinct(), ["canonical_name", "polarity"], "left_anti")


def predicate_counts(m: DataFrame) -> DataFrame:
    """(canonical_name, polarity, mention_count) of every distinct predicate, polarity by its negation cue."""
    return m.filter(F.col("predicate").isNotNull()).groupBy(F.col("predicate").alias("canonical_name")).agg(
        F.count(F.lit(1)).alias("mention_count")
    ).withColumn("polarity", infer_polarity(F.col("canonical_name")))


def first_pass(m: DataFrame, relation_map: DataFrame) -> DataFrame:
    """Edges of exact entity names and mapped predicates: (subject, canonical_name, polarity, object, evidence_count).

    relation_map: alias, canonical_name, polarity; predicates without a mapping stand for themselves. A mapping whose
    polarity contradicts its name's negation cue falls back to the raw predicate."""
    ok = relation_map.filter(infer_polarity(F.col("canonical_name")) == F.col("polarity"))
    j = m.join(ok.select(F.col("alias").alias("predicate"), F.col("canonical_name").alias("c"), F.col("polarity").alias("p")), "predicate", "left")
    return j.select(
        trim_all(F.col("subject")).alias("subject"), F.coalesce("c", "predicate").alias("canonical_name"),
        F.coalesce("p", infer_polarity(F.col("predicate"))).alias("polarity"), trim_all(F.col("object")).alias("object"),
    ).dropna().groupBy("subject", "canonical_name", "polarity", "object").agg(F.count(F.lit(1)).alias("evidence_count"))


def seeded_mapping(names: DataFrame, seeds: DataFrame) -> DataFrame:
    """(name, canonical_name, normalization_status) from earlier dictionaries.

    seeds: alias, canonical_name. A name that is itself a seed's canonical name keeps it; an alias of one canonical
    name takes it; an alias of several stays as it is, as does a name no seed knows. Seeds whose canonical name looks
    wrongly decoded lend it to no alias."""
    own = seeds.select(trim_all(F.col("canonical_name")).alias("name")).filter(F.col("name") != "").distinct()
    sound = seeds.select(trim_all(F.col("alias")).alias("alias"), trim_all(F.col("canonical_name")).alias("c")).filter((F.col("c") != "") & ~looks_mojibake(F.col("c")))
    pairs = sound.filter(F.col("alias") != "").unionByName(sound.select(F.col("c").alias("alias"), "c"))
    per = pairs.groupBy("alias").agg(F.count_distinct("c").alias("n"), F.min("c").alias("target"))
    j = names.select("name").distinct().join(per.withColumnRenamed("alias", "name"), "name", "left").join(own.withColumn("is_canonical", F.lit(True)), "name", "left")
    known = F.coalesce("is_canonical", F.lit(False))
    return j.select(
        "name",
        F.when(known, F.col("name")).when(F.col("n") == 1, F.col("target")).otherwise(F.col("name")).alias("canonical_name"),
        F.when(known, "seed_exact_canonical").when(F.col("n") == 1, "seed_unique_alias")
        .when(F.col("n") > 1, "fallback_source_name_ambiguous_seed_alias").otherwise("fallback_source_name_no_seed_match").alias("normalization_status"),
    )


def refreshed_counts(seeds: DataFrame, observed: DataFrame) -> DataFrame:
    """Alias counts of a seed relation dictionary set anew: (canonical_name, alias, mention_count), seeds without
    observations kept with 0, observed predicates no seed knows as their own canonical name.

    seeds: alias, canonical_name; observed: canonical_name (the predicate), mention_count."""
    o = observed.select(F.col("canonical_name").alias("alias"), "mention_count")
    return seeds.select("alias", "canonical_name").distinct().join(o, "alias", "full_outer").select(
        F.coalesce("canonical_name", "alias").alias("canonical_name"), "alias", F.coalesce("mention_count", F.lit(0)).alias("mention_count")
    )


def merge_first_wins(shards: list[DataFrame], key: str, order: list[str]) -> DataFrame:
    """Concatenated shards, the first row of each key kept: earlier shards first, then ``order``."""
    out = None
    for i, s in enumerate(shards):
        part = s.withColumn("_shard", F.lit(i))
        out = part if out is None else out.unionByName(part)
    rest = [c for c in out.columns if c not in (key, "_shard")]
    return out.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct("_shard", *order)).alias("r")).select(key, "r.*")


def merge_last_wins(older: DataFrame, newer: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Union of two tables of equal columns, the newer row of a key kept; within one table the last in ``order``."""
    both = older.withColumn("_newer", F.lit(0)).unionByName(newer.withColumn("_newer", F.lit(1))).filter(F.col(key).isNotNull())
    rest = [c for c in both.columns if c not in (key, "_newer")]
    return both.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("_newer", *order)).alias("r")).select(key, "r.*")


def evidence_samples(ends: DataFrame, units: DataFrame, limit: int = 3, excerpt: int = 500) -> DataFrame:
    """(name, samples): excerpts of the first ``limit`` distinct units of each name, as context for a model's prompt.

    ends: name, semantic_unit_id, document_id, unit_seq, rel_ord, end_ord. The texts are joined for the chosen units only."""
    e = ends.filter(F.col("name").isNotNull())
    picked = samples_by_name(e, "name", "semantic_unit_id", ["semantic_unit_id"], ["unit_seq", "rel_ord", "end_ord"], limit)
    rows = picked.select("name", F.posexplode("samples").alias("i", "s")).select("name", "i", "s.semantic_unit_id")
    text = units.groupBy("semantic_unit_id").agg(F.max(F.struct("unit_text", "context_text")).alias("t"))
    j = rows.join(text, "semantic_unit_id", "left")
    cut = lambda c: F.substring(F.coalesce(c, F.lit("")), 1, excerpt)
    one = F.struct("i", "semantic_unit_id", cut(F.col("t.context_text")).alias("context_text"), cut(F.col("t.unit_text")).alias("unit_text"))
    return j.groupBy("name").agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x.dropFields("i")).alias("samples"))
