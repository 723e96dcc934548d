"""Mappings proposed by a model: distinct values in numbered batches, answers validated and joined back, fallbacks explicit."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.clients import CompletionClient, complete
from sparkloom.functions.text import acceptable_canonical, guard_contextual, infer_polarity, needs_context, strip_fence, trim_all
from sparkloom.functions.typing_rules import ENTITY_TYPES, guard_direction
from sparkloom.sources.sinks import numbered

Factory = Callable[[], CompletionClient]


def batches(rows: DataFrame, order: list[str], size: int) -> DataFrame:
    """(batch, rows): the rows in order, ``size`` to a batch; numbered without a single-task window."""
    n = numbered(rows, order, "_no").withColumn("batch", F.floor((F.col("_no") - 1) / size).cast("long"))
    cols = [c for c in rows.columns]
    # at most ``size`` rows a batch
    return n.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("_no", *cols))).alias("rows")).select(
        "batch", F.transform("rows", lambda r: F.struct(*[r[c].alias(c) for c in cols])).alias("rows"))


def ask(rows: DataFrame, order: list[str], size: int, prompt: str, wrap: Callable[[Column], Column], answer: str, items: str, factory: Factory, label: str, made: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(items, errors): one call a batch; ``made`` gives the batches if the caller has made them. ``wrap`` makes the payload of the rows, ``answer`` is the schema of an item and
    ``items`` the name of the answer's array. Items are distinct per batch; errors name the batch."""
    b = batches(rows, order, size) if made is None else made
    payload = F.to_json(wrap(F.col("rows")), {"ignoreNullFields": "false"})
    got = complete(b.withColumn("_prompt", F.concat(F.lit(prompt + "\n\n입력:\n"), payload)), "batch", "_prompt", factory, label)
    parsed = got.withColumn("_items", F.from_json(strip_fence(F.col("response")), f"STRUCT<`{items}`: ARRAY<{answer}>>")[items])
    good = parsed.filter(F.col("_items").isNotNull()).select("batch", F.explode("_items").alias("x")).select("batch", "x.*").distinct()
    bad = parsed.filter(F.col("_items").isNull()).select("batch", F.coalesce("error", F.lit(f"answer without an array {items}")).alias("error"))
    return good, bad


def relation_mapping(predicates: DataFrame, prompt: str, factory: Factory, size: int = 50) -> tuple[DataFrame, DataFrame]:
    """(mapping, errors) of distinct predicates: alias, canonical_name, polarity, normalization_status.

    predicates: (canonical_name, mention_count[, samples]). A proposal whose polarity contradicts its name falls back to the raw
    predicate, as does a predicate without a proposal."""
    rows = predicates.select(F.col("canonical_name").alias("alias"), F.col("mention_count").alias("count"), *[c for c in ("samples",) if c in predicates.columns])
    src = rows.withColumn("_desc", -F.col("count"))
    items, bad = ask(src, ["_desc", "alias"], size, prompt, lambda r: F.transform(r, lambda x: x.dropFields("_desc")), "STRUCT<alias: STRING, canonical_name: STRING, polarity: STRING>", "items", factory, "relation-mapping")
    ok = items.filter((trim_all(F.col("canonical_name")) != "") & F.col("polarity").isin("POSITIVE", "NEGATIVE")).groupBy("alias").agg(F.min(F.struct(trim_all(F.col("canonical_name")).alias("c"), F.col("polarity").alias("p"))).alias("m"))
    j = rows.select("alias").join(ok, "alias", "left")
    sound = infer_polarity(F.col("m.c")) == F.col("m.p")
    return j.select(
        "alias", F.when(sound, F.col("m.c")).otherwise(F.col("alias")).alias("canonical_name"),
        F.when(sound, F.col("m.p")).otherwise(infer_polarity(F.col("alias"))).alias("polarity"),
        F.when(sound, "llm_proposed").when(F.col("m").isNotNull(), "fallback_raw_invalid_proposal").otherwise("fallback_raw_missing_proposal").alias("normalization_status"),
    ), bad


def entity_mapping(names: DataFrame, prompt: str, factory: Factory, size: int = 100) -> tuple[DataFrame, DataFrame]:
    """(mapping, errors) of distinct names alone: name, canonical_name, normalization_status."""
    rows = names.select(F.col("name").alias("alias")).filter(F.col("alias").isNotNull()).distinct()
    items, bad = ask(rows, ["alias"], size, prompt, lambda r: r, "STRUCT<alias: STRING, canonical_name: STRING>", "items", factory, "entity-mapping")
    ok = items.filter(trim_all(F.col("canonical_name")) != "").groupBy("alias").agg(F.min(trim_all(F.col("canonical_name"))).alias("c"))
    return rows.join(ok, "alias", "left").select(F.col("alias").alias("name"), F.coalesce("c", "alias").alias("canonical_name"),
                                                 F.when(F.col("c").isNotNull(), "llm_proposed").otherwise("fallback_raw_missing_proposal").alias("normalization_status")), bad


def contextual_targets(entities: DataFrame, lexical_key: Column) -> tuple[DataFrame, DataFrame]:
    """(asked, kept): names with cues of context or lexical twins, and the rest, which map to themselves."""
    twins = entities.withColumn("_k", lexical_key).groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    j = entities.withColumn("_k", lexical_key).join(twins, "_k")
    pick = needs_context(F.col("canonical_name")) | (F.col("_n") > 1)
    return j.filter(pick).drop("_k", "_n"), j.filter(~pick).drop("_k", "_n")


def contextual_mapping(entities: DataFrame, prompt: str, factory: Factory, size: int = 20, guarded: bool = True) -> tuple[DataFrame, DataFrame]:
    """(mapping, errors) of names with their evidence: source_entity_id, source_canonical_name, canonical_name, normalization_status.

    entities: entity_id, canonical_name[, samples]. Proposals that erase a name into a general word are refused; with
    ``guarded`` the citation guards follow. Names without a proposal keep themselves."""
    rows = entities.select(F.col("entity_id").alias("source_entity_id"), F.col("canonical_name").alias("source_canonical_name"), *[c for c in ("samples",) if c in entities.columns])
    items, bad = ask(rows, ["source_canonical_name", "source_entity_id"], size, prompt, lambda r: r, "STRUCT<source_entity_id: STRING, canonical_name: STRING>", "items", factory, "contextual-mapping")
    one = items.filter(F.col("canonical_name").isNotNull()).groupBy("source_entity_id").agg(F.min("canonical_name").alias("c"))
    j = rows.select("source_entity_id", "source_canonical_name").join(one, "source_entity_id", "left")
    good = acceptable_canonical(F.col("source_canonical_name"), F.col("c"))
    j = j.withColumn("canonical_name", F.when(good, trim_all(F.col("c"))).otherwise(F.col("source_canonical_name")))
    j = j.withColumn("normalization_status", F.when(good, "llm_canonical_name").when(F.col("c").isNotNull(), "fallback_rejected_proposal").otherwise("fallback_source_name"))
    if guarded:
        g = guard_contextual(F.col("source_canonical_name"), F.col("canonical_name"), F.col("normalization_status"))
        j = j.withColumn("_g", g).withColumn("canonical_name", F.col("_g.canonical_name")).withColumn("normalization_status", F.col("_g.normalization_status"))
    return j.select("source_entity_id", "source_canonical_name", "canonical_name", "normalization_status"), bad


def rekey_by_name(entities: DataFrame, prior: DataFrame) -> DataFrame:
    """Earlier model decisions for the same source name under new ids; the last decision of a name (by ``seq``) counts."""
    p = prior.filter(F.col("normalization_status").startswith("llm_") & acceptable_canonical(F.col("source_canonical_name"), F.col("canonical_name")))
    last = p.groupBy(trim_all(F.col("source_canonical_name")).alias("source_canonical_name")).agg(F.max_by("canonical_name", "seq").alias("canonical_name"))
    e = entities.select(F.col("entity_id").alias("source_entity_id"), trim_all(F.col("canonical_name")).alias("source_canonical_name"))
    return e.join(last, "source_canonical_name").select("source_entity_id", "source_canonical_name", "canonical_name", F.lit("llm_canonical_name_rekeyed").alias("normalization_status"))


def entity_types(entities: DataFrame, prompt: str, factory: Factory, size: int = 50) -> tuple[DataFrame, DataFrame]:
    """(types, errors): entity_id, entity_type. A batch counts only if it answers every entity with one known type."""
    rows = entities.select("entity_id", "canonical_name", F.slice(F.transform("aliases", lambda a: a["name"]), 1, 10).alias("aliases"))
    made = batches(rows, ["entity_id"], size)
    items, bad = ask(rows, ["entity_id"], size, prompt, lambda r: F.struct(r.alias("entities")), "STRUCT<entity_id: STRING, entity_type: STRING>", "entities", factory, "entity-types", made)
    want = made.select("batch", F.explode("rows.entity_id").alias("entity_id"))
    known = items.filter(F.col("entity_type").isin(ENTITY_TYPES))
    one = known.groupBy("batch", "entity_id").agg(F.count_distinct("entity_type").alias("n"), F.min("entity_type").alias("entity_type"))
    j = want.join(one, ["batch", "entity_id"], "left")
    broken = j.groupBy("batch").agg(F.bool_and(F.coalesce(F.col("n") == 1, F.lit(False))).alias("whole")).filter(~F.col("whole")).select("batch")
    types = j.join(broken, "batch", "left_anti").select("entity_id", "entity_type")
    return types, bad.unionByName(broken.join(bad.select("batch"), "batch", "left_anti").select("batch", F.lit("batch not answered in full").alias("error")))


def merge_types(rules: DataFrame, answered: DataFrame) -> DataFrame:
    """Rule types, replaced by answered ones only where the rules found none."""
    a = answered.select("entity_id", F.col("entity_type").alias("_a"))
    j = rules.join(a, "entity_id", "left")
    other = F.col("entity_type") == "OTHER"
    return j.withColumn("method", F.when(other & F.col("_a").isNotNull(), "llm").otherwise(F.col("method"))).withColumn("entity_type", F.when(other, F.coalesce("_a", "entity_type")).otherwise(F.col("entity_type"))).drop("_a")


def closed_mapping(relations: DataFrame, taxonomy: DataFrame, prompt: str, factory: Factory, size: int = 50) -> tuple[DataFrame, DataFrame]:
    """(mapping, errors) of relation types to families, keyed by name and polarity, direction guard applied.

    relations: relation_type_id, canonical_name, polarity, mention_count. taxonomy (small): family_id, positive_name, negative_name,
    description. The batch number of a source that its answer left out is an error."""
    rows = relations.select(F.col("canonical_name").alias("source_canonical_name"), F.col("polarity").alias("source_polarity"), "mention_count")
    tax = json.dumps([r.asDict() for r in taxonomy.orderBy("family_id").collect()], ensure_ascii=False)
    items, bad = ask(rows, ["source_canonical_name", "source_polarity"], size, f"{prompt}\n\n분류체계:\n{tax}", lambda r: r, "STRUCT<source_canonical_name: STRING, family_id: STRING>", "items", factory, "closed-mapping")
    one = items.groupBy("source_canonical_name").agg(F.min("family_id").alias("family_id"))
    j = rows.join(one, "source_canonical_name", "left").join(taxonomy.select("family_id", "positive_name", "negative_name"), "family_id", "left")
    done = j.filter(F.col("positive_name").isNotNull()).select(
        "source_canonical_name", "source_polarity", F.col("family_id").alias("target_family_id"),
        F.when(F.col("source_polarity") == "POSITIVE", F.col("positive_name")).otherwise(F.col("negative_name")).alias("target_canonical_name"),
        "mention_count", F.lit("llm_closed_taxonomy").alias("mapping_status"))
    lost = j.filter(F.col("positive_name").isNull()).select(F.lit(None).cast("long").alias("batch"), F.concat(F.lit("no family: "), "source_canonical_name").alias("error"))
    return guard_direction(done, taxonomy), bad.unionByName(lost)


def forced_overrides(predicates: DataFrame, relation_dictionary: DataFrame, prompt: str, factory: Factory, size: int = 50) -> tuple[DataFrame, DataFrame]:
    """(overrides, errors): raw_predicate, relation_type_id of a closed dictionary; there is no free fallback, what has no
    entry is an error."""
    rows = predicates.select(trim_all(F.col("predicate")).alias("raw_predicate")).filter(F.col("raw_predicate") != "").distinct()
    entries = json.dumps([r.asDict() for r in relation_dictionary.select("relation_type_id", "canonical_name", "polarity").distinct().orderBy("canonical_name", "relation_type_id").collect()], ensure_ascii=False)
    items, bad = ask(rows, ["raw_predicate"], size, f"{prompt}\n\n사전:\n{entries}", lambda r: F.struct(F.transform(r, lambda x: x["raw_predicate"]).alias("raw_predicates")), "STRUCT<raw_predicate: STRING, relation_type_id: STRING>", "items", factory, "forced-overrides")
    known = items.join(relation_dictionary.select("relation_type_id").distinct(), "relation_type_id", "left_semi").groupBy("raw_predicate").agg(F.count_distinct("relation_type_id").alias("n"), F.min("relation_type_id").alias("relation_type_id"))
    j = rows.join(known, "raw_predicate", "left")
    good = F.coalesce(F.col("n") == 1, F.lit(False))
    return j.filter(good).select("raw_predicate", "relation_type_id"), bad.unionByName(j.filter(~good).select(F.lit(None).cast("long").alias("batch"), F.concat(F.lit("no single entry: "), "raw_predicate").alias("error")))


def taxonomy(relations: DataFrame, prompt: str, client: CompletionClient, families: int = 45, size: int = 160, attempts: int = 3) -> list[dict[str, str]]:
    """Polarity-paired families of all relation types: partial inventories are summarised, then consolidated.

    Orchestrated on the driver, as each step is one model call; inventories are read batch by batch."""
    if not 1 <= families <= 50:
        raise ValueError("families must lie in 1..50")
    line = F.concat_ws(" | ", "canonical_name", "polarity", F.col("mention_count").cast("string"))
    b = batches(relations.withColumn("_d", -F.col("mention_count")).select("_d", "canonical_name", "polarity", "mention_count", line.alias("line")), ["_d", "canonical_name", "polarity"], size)
    parts = [_families(prompt, [r["line"] for r in row["rows"]], client, min(30, families), attempts) for row in b.orderBy("batch").toLocalIterator()]
    if len(parts) <= 1:
        return parts[0][:families] if parts else []
    lines = [f"{f['positive_name']} | {f['negative_name']} | {f['description']}" for p in parts for f in p]
    return _families(prompt + "\n후보를 하나의 분류로 합친다.", lines, client, families, attempts)


def _families(prompt: str, inventory: list[str], client: CompletionClient, most: int, attempts: int) -> list[dict[str, str]]:
    error: Exception | None = None
    for _ in range(attempts):
        try:
            got = json.loads(client.complete(f"{prompt}\n최대 {most}개\n\n입력:\n" + "\n".join(inventory)))["items"]
            rows = [{k: str(x[k]).strip() for k in ("positive_name", "negative_name", "description")} for x in got]
            names = [r["positive_name"] for r in rows], [r["negative_name"] for r in rows]
            if not 0 < len(rows) <= most or any(len(set(n)) < len(n) or "" in n for n in names):
                raise ValueError("families are missing, too many or named alike")
            return [{"family_id": f"R{i:03d}", **r} for i, r in enumerate(rows, 1)]
        except (ValueError, KeyError, TypeError) as e:
            error = e
    raise RuntimeError(f"no valid taxonomy in {attempts} attempts") from error


def fallback_records(raw: DataFrame, mapping: DataFrame) -> DataFrame:
    """Raw records reduced to relations whose predicate fell back, for another attempt; records left empty go."""
    bad = mapping.filter(F.col("normalization_status").startswith("fallback")).select(F.col("alias").alias("_p")).distinct()
    r = raw.select("semantic_unit_id", F.posexplode("relations").alias("_i", "r"))
    kept = r.join(bad, F.col("r.predicate") == F.col("_p"), "left_semi").groupBy("semantic_unit_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "r"))), lambda x: x["r"]).alias("_kept"))
    return raw.join(kept, "semantic_unit_id").withColumn("relations", F.col("_kept")).drop("_kept")


def slice_units(units: DataFrame, offset: int = 0, limit: int | None = None) -> DataFrame:
    """A slice of the units in order (the feature of a resumed or partial run)."""
    out = units.orderBy("unit_seq", "semantic_unit_id")
    out = out.offset(offset) if offset else out
    return out.limit(limit) if limit is not None else out


__all__ = ["ask", "batches", "closed_mapping", "contextual_mapping", "contextual_targets", "entity_mapping", "entity_types", "fallback_records", "forced_overrides", "merge_types", "rekey_by_name", "relation_mapping", "slice_units", "taxonomy"]
