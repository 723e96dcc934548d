"""Facades: dictionary build, graph build, search and document ingest over the operators."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.clients import CompletionClient, EmbeddingClient, embed, extract_relations
from sparkloom.functions.ids import stable_id
from sparkloom.functions.text import citation_keys, query_terms_of
from sparkloom.operators import dictionary, graphmap, paths, retrieval
from sparkloom.operators.mentions import endpoints, mentions, sanitize_records
from sparkloom.operators.search_index import SearchIndex, best_edges, evidence_of, prepare_search
from sparkloom.operators.search_index import candidates as retrieve
from sparkloom.operators.segment import segment
from sparkloom.sources import sinks
from sparkloom.sources.readers import read_markdown


@dataclass
class GraphStore:
    """Tables that a search reads."""

    entities: DataFrame
    edges: DataFrame
    evidence: DataFrame
    units: DataFrame
    documents: DataFrame
    entity_vectors: DataFrame | None = None
    relation_vectors: DataFrame | None = None


def prepare(store: GraphStore) -> SearchIndex:
    """The tables of a store written for many searches."""
    return prepare_search(store.entities, store.edges, store.evidence, store.units, store.documents, store.entity_vectors, store.relation_vectors)


def search(spark: SparkSession, store: GraphStore | SearchIndex, question: str, bounds: paths.SearchBounds, top: int = 8, top_relations: int = 20,
           embedder: Callable[[], EmbeddingClient] | None = None, budget: paths.TimeBudget | None = None, diagnostics: dict | None = None) -> dict[str, DataFrame]:
    """Candidates, paths with evidence, and the evidence rows of one question.

    Keyword (and, with vectors and an embedder, vector) ranks of entities, by canonical names and aliases, and of relations, by the
    words and the terms without particles of the question, are fused; relation candidates lend their endpoints as seeds; paths are
    generated within the bounds; evidence is looked up for the pool of paths only. A plain store is prepared first; give a
    prepared one to ask several questions. All lists that the driver holds are bounded by the bounds. ``diagnostics``, if
    given, receives the hops, the bounds that the budget cut, and whether it ran out (``status`` ``timeout``: the result then holds what
    was found so far)."""
    index = store if isinstance(store, SearchIndex) else prepare(store)
    question = question.strip()
    terms = [t.lower() for t in query_terms_of(question)]
    asked = list(dict.fromkeys(re.findall("[0-9A-Za-z가-힣]+", question.lower())))
    named, related = retrieve(index, question, asked, terms, top * 2, top_relations * 2)
    names = dict(named)
    edges = {r["relation_id"]: r for r in related}
    lists, relation_lists = {"keyword": [e for e, _ in named]}, {"keyword": list(edges)}
    qv = embed(spark.createDataFrame([(0, question)], "query_id long, text string"), "query_id", "text", embedder) if embedder is not None else None

    def nearest(vectors: DataFrame, key: str, most: int) -> list[str]:
        return [r["doc"] for r in retrieval.nearest(vectors, key, "embedding", qv, most).orderBy("rank").collect()]

    if index.entity_vectors is not None and qv is not None:
        lists["vector"] = nearest(index.entity_vectors, "entity_id", top * 2)
        if missing := [e for e in lists["vector"] if e not in names]:
            names |= {r["entity_id"]: r["canonical_name"] for r in index.names.filter(F.col("entity_id").isin(missing)).collect()}
    if index.relation_vectors is not None and qv is not None:
        relation_lists["vector"] = nearest(index.relation_vectors, "relation_id", top_relations * 2)
        if missing := [r for r in relation_lists["vector"] if r not in edges]:
            edges |= {r["relation_id"]: r.asDict() for r in index.edges.filter(F.col("relation_id").isin(missing)).collect()}
    entities = [(e, names[e], s, by, rank) for e, s, by, rank in retrieval.fuse_lists(lists, top) if e in names]
    relations = [(edges[r], s, by, rank) for r, s, by, rank in retrieval.fuse_lists(relation_lists, top_relations) if r in edges]
    seeds = retrieval.merge_seeds([(e, n, s) for e, n, s, _, _ in entities], [(e, s) for e, s, _, _ in relations])
    most = max((s for _, _, s in seeds), default=1.0) or 1.0
    top_rel = max((s for _, s, _, _ in relations), default=1.0) or 1.0
    preferred = [e for e, _, _, _ in relations]
    trace = paths.SearchTrace()
    made = paths.walk_paths(
        [(e, n, s / most) for e, n, s in seeds], lambda ends, per: best_edges(index, ends, per, preferred), question, bounds,
        {e["relation_id"]: s / top_rel for e, s, _, _ in relations}, trace, budget)
    if budget:
        bounds = replace(bounds, paths=budget.limit(bounds.paths, "paths"), evidence=budget.limit(bounds.evidence, "evidence"))
    pool = paths.reserve_preferred(paths.score_paths(made, question), [e["relation_id"] for e in preferred], bounds.paths * 3)
    attached = evidence_of(index, sorted({r for p in pool for r in p.relation_ids}), bounds.evidence)
    ranked = paths.rank_by_evidence(pool, attached, question, bounds.paths)
    if diagnostics is not None:
        out_of_time = bool(budget and budget.used() >= 1)
        diagnostics |= {"status": "timeout" if out_of_time else "ok", "hops": trace.hops, "cut": budget.notes if budget else [], "pool": len(pool)}
    kinds = dict(index.evidence.dtypes)
    columns = ["relation_id", "relation_mention_id", "semantic_unit_id", "document_id", "document_title", "source_ref", "context_text", "unit_text", "raw_subject", "raw_predicate", "raw_object", "evidence_rank"]
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in columns)
    return {
        "candidates": spark.createDataFrame(entities, "entity_id string, name string, score double, matched_by array<string>, rank long"),
        "relations": spark.createDataFrame(
            [(e["relation_id"], e["source_entity_id"], e["source_name"], e["target_entity_id"], e["target_name"], s, by, rank) for e, s, by, rank in relations],
            "relation_id string, source_entity_id string, source_name string, target_entity_id string, target_name string, score double, matched_by array<string>, ord long"),
        "paths": spark.createDataFrame(
            [(p.relation_ids, p.entity_ids, p.entity_names, p.type_names, p.hops, p.score, d, t, i) for i, (p, d, t) in enumerate(ranked, 1)],
            "relation_ids array<string>, entity_ids array<string>, entity_names array<string>, type_names array<string>, hops int, score double, document_ids array<string>, document_titles array<string>, rank long"),
        "evidence": spark.createDataFrame([tuple(e[c] for c in columns) for e in attached], schema),
    }


def grounded_answer(result: dict[str, DataFrame], paths_used: int = 5, items: int = 15) -> tuple[str, list[dict]]:
    """Text of the best paths with numbered evidence, and that evidence; both of bounded size."""
    best = result["paths"].filter(F.col("rank") <= paths_used)
    rows = best.orderBy("rank").collect()
    ids = best.select("rank", F.posexplode("relation_ids").alias("i", "relation_id"))
    ev = ids.join(result["evidence"], "relation_id").groupBy("relation_mention_id").agg(
        F.min(F.struct("rank", "i", "evidence_rank")).alias("o"), *[F.any_value(c).alias(c) for c in ("document_title", "unit_text", "relation_id")])
    kept = ev.orderBy("o", "relation_mention_id").limit(items).collect()
    lines = [f"{r['rank']}. " + " → ".join(r["entity_names"]) for r in rows]
    cited = [{"key": f"E{n}", **e.asDict()} for n, e in enumerate(kept, 1)]
    lines += [f"[{e['key']}] {e['document_title'] or ''}: {e['unit_text'] or ''}" for e in cited]
    return ("\n".join(lines) if rows else "근거 경로를 찾지 못했습니다."), cited


def written_answer(spark: SparkSession, question: str, result: dict[str, DataFrame], client: CompletionClient) -> tuple[str, str]:
    """(answer, status): a model's answer if it cites only given evidence, else the plain grounded answer."""
    plain, cited = grounded_answer(result)
    if not cited:
        return plain, "no_evidence"
    try:
        answer = client.complete(f"{question}\n\n{plain}")
    except Exception:  # noqa: BLE001
        return plain, "client_failed"
    keys = spark.createDataFrame([(answer,)], "a string").select(citation_keys(F.col("a"))).first()[0]
    if not keys or set(keys) - {c["key"] for c in cited} or len(answer) > 6000:
        return plain, "invalid_citations"
    return answer, "written"


def evaluate_question(question: dict, ranked: DataFrame) -> str | None:
    """How a search answers a discovered question: ``exact_relations``, ``same_entities_alternative_relations`` or not at all."""
    wanted = F.array(*[F.lit(x) for x in question["expected_relation_ids"]])
    ends = F.array(*[F.lit(question[k]) for k in ("start_id", "middle_id", "end_id")])
    rows = ranked.filter(F.size("document_ids") >= 2).agg(
        F.bool_or(F.size(F.array_except(wanted, F.col("relation_ids"))) == 0).alias("exact"),
        F.bool_or(F.size(F.array_except(ends, F.col("entity_ids"))) == 0).alias("ends")).first()
    return "exact_relations" if rows["exact"] else "same_entities_alternative_relations" if rows["ends"] else None


class DictionaryBuild:
    """Raw mentions to dictionaries."""

    def __init__(self, raw: DataFrame):
        self.mentions = mentions(raw)

    def candidates(self) -> tuple[DataFrame, DataFrame]:
        p = self.mentions.select(F.col("predicate").alias("name"), "semantic_unit_id", "document_id", "unit_seq", "rel_ord", F.lit(0).alias("end_ord"))
        return dictionary.candidates(endpoints(self.mentions), "entity_candidate"), dictionary.candidates(p, "relation_type_candidate")

    def entities(self, mapping: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
        return dictionary.clustered_dictionary(self.candidates()[0].select("name", "mention_count", "samples"), mapping, overrides)

    def renormalized(self, entities: DataFrame, mapping: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
        """Second pass over a clustered dictionary. mapping: source_canonical_name, canonical_name."""
        return dictionary.clustered_dictionary(entities, mapping.select(F.col("source_canonical_name").alias("source_name"), "canonical_name"), overrides)

    def relations(self, mapping: DataFrame, taxonomy: DataFrame) -> DataFrame:
        """The closed dictionary; raises if a predicate has no family."""
        return dictionary.closed_relation_dictionary(dictionary.predicate_counts(self.mentions), mapping, taxonomy, strict=True)


def ingest(spark: SparkSession, source: str, target: str, factory: Callable[[], CompletionClient], entity_index: DataFrame, relation_dictionary: DataFrame,
           overrides: DataFrame | None = None, units: DataFrame | None = None) -> graphmap.GraphBundle:
    """Markdown documents to graph load files: segment, extract, clean, map, write, with a manifest.

    Fails closed: extraction errors and unmapped predicates raise before anything is written."""
    docs = read_markdown(spark, source)
    units = segment(docs, "source_path", "text") if units is None else units
    good, bad = extract_relations(units, factory)
    if n := bad.count():
        raise ValueError(f"{n} units could not be extracted")
    raw = units.join(good, "semantic_unit_id")
    ids = F.transform("relations", lambda r: F.struct(stable_id("raw_svo_mention", F.col("semantic_unit_id"), r["subject"], r["predicate"], r["object"]).alias("relation_mention_id"), r["subject"].alias("subject"), r["predicate"].alias("predicate"), r["object"].alias("object")))
    clean = sanitize_records(raw.withColumn("relations", ids))
    index = relation_dictionary.select(F.col("canonical_name").alias("name"), F.col("relation_type_id").alias("id"), "canonical_name")
    bundle = graphmap.map_to_graph(mentions(clean), entity_index, index, relation_dictionary, overrides)
    tables = {"document": bundle.documents, "semantic_unit": units, "entity": bundle.entities, "relation_type": bundle.relation_types, "relation": bundle.relations, "relation_evidence": bundle.evidence}
    sinks.write_rdb(tables, f"{target}/rdb")
    sinks.write_property_graph(bundle.entities, bundle.relations, f"{target}/graph")
    sinks.write_bulk(bundle.entities.select("entity_id", "canonical_name", "entity_type", "mention_count"), "entity_id", "entities", f"{target}/search")
    sinks.write_manifest(spark, target)
    return bundle
