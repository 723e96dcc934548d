"""Bounded multi-hop path search over edges, late evidence, ranking, and discovery of cross-document questions."""

from __future__ import annotations

import functools
import hashlib
import math
import time
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkloom.functions.text import compact_of, search_terms_of, strength_of

# Cues by which a question asks for the actor, the target, a way through.
ACTOR_CUES = ["누가", "주체", "어느 기관", "어떤 기관"]
TARGET_CUES = ["무엇을", "누구에게", "대상", "어떤 조치"]
VIA_CUE = "거쳐"
# Names too poor for a question, and for its middle.
POOR_NAMES = "것 경우 자 법 영 규정 사항 업무 내용 방법 필요 조치".split()
POOR_MIDDLES = [*POOR_NAMES, *"기준 세부사항 절차 범위 대상 사유 자료 정보 요건".split()]
EDGE = ["relation_id", "source_entity_id", "source_name", "relation_type_id", "relation_type_name", "target_entity_id", "target_name", "evidence_count"]
MAX_EDGES = 5000


def with_type_names(relations: DataFrame, relation_types: DataFrame) -> DataFrame:
    """Edges with the name of their type; edges without a type or an end are none. Repeated edges count once."""
    t = relation_types.groupBy("relation_type_id").agg(F.min("canonical_name").alias("relation_type_name"))
    one = relations.groupBy("relation_id").agg(*[F.max(c).alias(c) for c in ("source_entity_id", "source_name", "relation_type_id", "target_entity_id", "target_name", "evidence_count")])
    return one.dropna(subset=["source_entity_id", "target_entity_id"]).join(t, "relation_type_id").select(*EDGE)


def incident(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges at each frontier entity, a self-loop once: two equi-joins, not one join on either end."""
    f = frontier.select("entity_id").distinct()
    at_source = edges.join(f.withColumnRenamed("entity_id", "source_entity_id"), "source_entity_id").select(F.col("source_entity_id").alias("frontier_id"), *EDGE)
    at_target = edges.filter("source_entity_id <> target_entity_id").join(f.withColumnRenamed("entity_id", "target_entity_id"), "target_entity_id").select(F.col("target_entity_id").alias("frontier_id"), *EDGE)
    return at_source.unionByName(at_target)


def neighbors(frontier: DataFrame, edges: DataFrame, per_entity: int, preferred: list[str] | None = None) -> DataFrame:
    """The ``per_entity`` edges of each frontier entity: preferred first, then by evidence, then by id.

    The rank filter becomes a group limit before the shuffle, so a hub sends only its best edges per task."""
    pref = F.col("relation_id").isin(preferred) if preferred else F.lit(False)
    order = [F.desc("preferred"), F.desc("evidence_count"), F.col("relation_id")]
    ranked = incident(frontier, edges).withColumn("preferred", pref).withColumn(
        "neighbor_rank", F.row_number().over(W.partitionBy("frontier_id").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("neighbor_rank") <= per_entity)


def expand(frontier: DataFrame, edges: DataFrame, per_entity: int, max_edges: int, preferred: list[str] | None = None) -> DataFrame:
    """Distinct edges around the frontier, the best ``max_edges`` of those within the per-entity bound."""
    n = neighbors(frontier, edges, per_entity, preferred)
    one = n.groupBy(*EDGE, "preferred").agg(F.min("neighbor_rank").alias("neighbor_rank"))
    return one.orderBy(F.desc("preferred"), F.desc("evidence_count"), "relation_id").limit(max_edges)


def edge_relevance(query: str, edge: dict, branching: int, current: str, relation_score: float, strength: Callable[[str | None], float]) -> float:
    """Score of stepping over an edge from the current entity; sums to nine digits. ``strength`` is that of a name in the query."""
    s = relation_score + 0.35 * strength(edge["source_name"]) + 0.35 * strength(edge["target_name"]) + 0.25 * strength(edge["relation_type_name"])
    s += min(0.2, math.log1p(edge["evidence_count"] or 0) / 20) - min(0.22, math.log1p(max(branching - 1, 0)) / 18)
    if current == edge["target_entity_id"] and any(c in query for c in ACTOR_CUES):
        s += 0.15
    if current == edge["source_entity_id"] and any(c in query for c in TARGET_CUES):
        s += 0.15
    return round(s, 9)


@dataclass
class SearchBounds:
    """Bounds of one search; all of them are features of it, none depends on the data."""

    hops: int = 3
    per_entity: int = 50
    beam: int = 160
    paths: int = 50
    evidence: int = 3

    def __post_init__(self) -> None:
        if not 1 <= self.hops <= 3:
            raise ValueError("hops must be 1 to 3")
        if min(self.per_entity, self.beam, self.paths, self.evidence) < 1:
            raise ValueError("bounds must be positive")


class TimeBudget:
    """Shrinks limits as a deadline nears: to a half from 67 % of the time on, to a quarter from 84 % on, 1 at least."""

    def __init__(self, seconds: float, clock: Callable[[], float] = time.monotonic):
        self._clock, self.started, self.seconds = clock, clock(), seconds
        self.notes: list[str] = []

    def used(self) -> float:
        return (self._clock() - self.started) / self.seconds if self.seconds else 1.0

    def limit(self, base: int, label: str) -> int:
        used = self.used()
        value = max(1, int(base * (0.25 if used >= 0.84 else 0.5 if used >= 0.67 else 1.0)))
        note = f"{label}:{base}->{value}"
        if value < base and note not in self.notes:
            self.notes.append(note)
        return value


@dataclass
class SearchTrace:
    hops: list[dict] = field(default_factory=list)


STATE = "entity_ids array<string>, entity_names array<string>, relation_ids array<string>, type_names array<string>, score double"


@dataclass
class Path:
    """A simple path with its score."""

    entity_ids: list[str]
    entity_names: list[str]
    relation_ids: list[str]
    type_names: list[str]
    score: float

    @property
    def hops(self) -> int:
        return len(self.relation_ids)

    @property
    def order(self) -> tuple:
        return (-self.score, self.hops, self.entity_ids, self.relation_ids)


#: The best edges of each of some entities: (entities, bound for each) -> (entity, edge with the EDGE columns, preferred).
Lookup = Callable[[list[str], int], list[tuple[str, object, bool]]]


def walk_paths(seeds: list[tuple[str, str, float]], lookup: Lookup, query: str, bounds: SearchBounds, scores: dict[str, float], trace: SearchTrace | None = None, budget: TimeBudget | None = None) -> list[Path]:
    """All generated simple paths of a beam search from the seeds (entity_id, name, score of 1 at most).

    Each hop looks up the best edges of the beam's end entities, ranks those at every state by relevance, and continues
    with the ``beam`` best states; all paths stay eligible for the ranking. At most beam * per_entity edges and as many paths
    of a hop pass through the driver, whatever the size of the graph. A ``budget`` shrinks the bounds as its time runs out
    and ends the search between hops when none is left."""
    limit_by = budget.limit if budget else (lambda base, label: base)
    kept = [Path([e], [n], [], [], float(s)) for e, n, s in sorted(seeds, key=lambda x: (-x[2], x[0]))[: bounds.beam]]
    generated: list[Path] = []
    asked = compact_of(query)
    strength = functools.cache(lambda name: strength_of(name, asked))
    for hop in range(1, bounds.hops + 1):
        ends = sorted({p.entity_ids[-1] for p in kept})
        if not ends or (budget and budget.used() >= 1):
            break
        per_entity, beam = limit_by(bounds.per_entity, f"hop_{hop}_neighbors"), limit_by(bounds.beam, f"hop_{hop}_beam")
        limit = max(1, min(MAX_EDGES, len(ends) * per_entity * 2))
        edges = {e["relation_id"]: (not preferred, e["evidence_count"] is None, -(e["evidence_count"] or 0), e["relation_id"], e) for _, e, preferred in lookup(ends, per_entity)}
        # a self-loop stands twice in its entity's adjacency, and is then passed over as a revisit
        near: dict[str, list] = {e: [] for e in ends}
        for *_, e in sorted(edges.values(), key=lambda x: x[:4])[:limit]:
            for cur, other, name in ((e["source_entity_id"], e["target_entity_id"], e["target_name"]), (e["target_entity_id"], e["source_entity_id"], e["source_name"])):
                if cur in near:
                    near[cur].append((e, other, name))
        steps = {
            cur: sorted(((-edge_relevance(query, e, len(at), cur, scores.get(e["relation_id"], 0.0), strength), e["relation_id"], other, name, e["relation_type_name"]) for e, other, name in at), key=lambda x: x[:3])[:per_entity]
            for cur, at in near.items()
        }
        made = [
            Path([*p.entity_ids, other], [*p.entity_names, name], [*p.relation_ids, rel], [*p.type_names, kind], round(p.score - less / hop, 9))
            for p in kept for less, rel, other, name, kind in steps[p.entity_ids[-1]] if other not in p.entity_ids
        ]
        generated += made
        kept = sorted(made, key=lambda p: (-p.score, p.entity_ids, p.relation_ids))[:beam]
        if trace is not None:
            trace.hops.append({"hop": hop, "frontier_entities": len(ends), "query_edge_limit": limit, "generated_paths": len(made), "retained_paths": len(kept)})
    return generated


def find_paths(seeds: DataFrame | list, edges: DataFrame, query: str, bounds: SearchBounds, relation_scores: DataFrame | dict[str, float] | None = None, trace: SearchTrace | None = None, budget: TimeBudget | None = None) -> DataFrame:
    """``walk_paths`` over a table of edges: (entity_ids, entity_names, relation_ids, type_names, score, hops).

    seeds: rows (entity_id, name, score); relation_scores: relation_id -> score of preferred relations
    (rows relation_id, rscore). One job a hop."""
    spark = edges.sparkSession
    if isinstance(relation_scores, DataFrame):
        relation_scores = {r["relation_id"]: r["rscore"] for r in relation_scores.orderBy(F.desc("rscore"), "relation_id").limit(MAX_EDGES).collect()}
    scores = relation_scores or {}
    preferred = sorted(scores, key=lambda r: (-scores[r], r))[:MAX_EDGES]
    if isinstance(seeds, DataFrame):
        seeds = [(r["entity_id"], r["name"], r["score"]) for r in seeds.orderBy(F.desc("score"), "entity_id").limit(bounds.beam).collect()]

    def lookup(ends: list[str], per_entity: int):
        frontier = spark.createDataFrame([(e,) for e in ends], "entity_id string")
        return [(r["frontier_id"], r.asDict(), r["preferred"]) for r in neighbors(frontier, edges, per_entity, preferred).collect()]

    made = walk_paths(seeds, lookup, query, bounds, scores, trace, budget)
    return spark.createDataFrame([(p.entity_ids, p.entity_names, p.relation_ids, p.type_names, p.score, p.hops) for p in made], STATE + ", hops int")


def score_paths(paths: list[Path], query: str) -> list[Path]:
    """Paths with their score by length and by the names the query holds, one per (entities, relations)."""
    best: dict[tuple, Path] = {}
    named = functools.cache(lambda n: n in query)
    for p in paths:
        names = {n.strip(" ") for n in p.entity_names if n and len(n.strip(" ")) >= 2}
        matched = sum(map(named, names))
        boost = matched * 0.18 + (0.45 if VIA_CUE in query and p.hops >= 2 and names and matched == len(names) else 0.0)
        q = replace(p, score=round(p.score / (1.0 + 0.7 * p.hops) + boost, 9))
        key = (tuple(p.entity_ids), tuple(p.relation_ids))
        if key not in best or q.score > best[key].score:
            best[key] = q
    return list(best.values())


def reserve_preferred(paths: list[Path], preferred: list[str], limit: int) -> list[Path]:
    """The pool for ranking: the best path of each preferred relation first, in their order, filled up by score. Paths over the
    same relations count once."""
    place = {r: i for i, r in enumerate(preferred)}
    best: dict[str, Path] = {}
    for p in paths:
        for r in p.relation_ids:
            if r in place and (r not in best or p.order < best[r].order):
                best[r] = p
    held: dict[int, int] = {}
    for r, p in best.items():
        held[id(p)] = min(held.get(id(p), len(place)), place[r])
    one: dict[tuple, tuple] = {}
    for p in paths:
        rank = (held.get(id(p), len(place)), -p.score, p.hops, p.entity_ids)
        key = tuple(p.relation_ids)
        if key not in one or rank < one[key][0]:
            one[key] = (rank, p)
    return [p for _, p in sorted(one.values(), key=lambda x: x[0])[:limit]]


def attach_evidence(relation_ids: DataFrame, evidence: DataFrame, units: DataFrame, documents: DataFrame, per_relation: int) -> DataFrame:
    """Evidence of the given relations: first per document, then the first ``per_relation`` by document title.

    Joined only for the relations asked for (late). Repeated rows count once; evidence without a unit or document is
    none. Columns: relation_id, relation_mention_id, semantic_unit_id, document_id, document_title, source_ref,
    context_text, unit_text, raw_subject, raw_predicate, raw_object, evidence_rank."""
    wanted = relation_ids.select("relation_id").distinct()
    e = evidence.join(wanted, "relation_id", "left_semi").dropDuplicates(["relation_mention_id", "relation_id"])
    u = units.join(e.select("semantic_unit_id").distinct(), "semantic_unit_id", "left_semi").groupBy("semantic_unit_id").agg(
        F.min(F.struct("document_id", "source_ref", "context_text", "unit_text")).alias("u"))
    d = documents.groupBy("document_id").agg(F.min("document_title").alias("document_title"))
    j = e.select("relation_id", "relation_mention_id", "semantic_unit_id", "raw_subject", "raw_predicate", "raw_object").join(u, "semantic_unit_id")
    j = j.select("*", "u.document_id", "u.source_ref", "u.context_text", "u.unit_text").drop("u").join(d, "document_id")
    ref = F.concat_ws("|", "source_ref.article", F.coalesce(F.col("source_ref.paragraph").cast("string"), F.lit("")), F.array_join("source_ref.item_path", "/"))
    j = j.withColumn("ref_text", ref)
    per_doc = W.partitionBy("relation_id", "document_id").orderBy("ref_text", "relation_mention_id")
    first = j.withColumn("_d", F.row_number().over(per_doc)).filter("_d = 1").drop("_d")
    per_rel = W.partitionBy("relation_id").orderBy(F.col("document_title").asc_nulls_first(), "ref_text", "relation_mention_id")
    return first.withColumn("evidence_rank", F.row_number().over(per_rel).cast("long")).filter(F.col("evidence_rank") <= per_relation)


def rank_by_evidence(pool: list[Path], attached: list[dict], query: str, limit: int) -> list[tuple[Path, list[str], list[str]]]:
    """(path with its final score, document ids, document titles) of the best paths: evidence that holds terms of the query and
    titles the query names add to the score."""
    q = compact_of(query)
    terms = [compact_of(t) for t in search_terms_of(query)]
    cover: dict[str, float] = {}
    title: dict[str, float] = {}
    docs: dict[str, set[str]] = {}
    titles: dict[str, set[str]] = {}
    for e in attached:
        r = e["relation_id"]
        text = compact_of(" ".join(e[c] or "" for c in ("document_title", "context_text", "unit_text", "raw_subject", "raw_predicate", "raw_object")))
        if terms:
            cover[r] = max(cover.get(r, 0.0), sum(t in text for t in terms) / len(terms))
            title[r] = max(title.get(r, 0.0), strength_of(e["document_title"], q))
        docs.setdefault(r, set()).add(e["document_id"])
        if e["document_title"] is not None:
            titles.setdefault(r, set()).add(e["document_title"])
    out = []
    for p in pool:
        score = p.score + 0.55 * max((cover.get(r, 0.0) for r in p.relation_ids), default=0.0) + 0.35 * max((title.get(r, 0.0) for r in p.relation_ids), default=0.0)
        own = sorted(set().union(*[docs.get(r, set()) for r in p.relation_ids]))
        out.append((replace(p, score=round(score, 6)), own, sorted(set().union(*[titles.get(r, set()) for r in p.relation_ids]))))
    out.sort(key=lambda x: (-x[0].score, -len(x[1]), x[0].hops, x[0].relation_ids, x[0].entity_ids))
    return out[:limit]


def quality_name(name: Column) -> Column:
    n = F.trim(name)
    return (F.length(n).between(2, 60)) & ~n.isin(POOR_NAMES) & ~n.contains("�") & ~n.rlike(r"\A\d+\z") & ~n.rlike(r"\A제?\d+(?:조|항|호|목)")


def cross_document_candidates(edges: DataFrame, evidence: DataFrame, least_degree: int = 2, most_degree: int = 80, keep: int = 30) -> DataFrame:
    """Two edges meeting in a middle entity with evidence from different documents, scored.

    Middles of too few or too many edges are out (hubs ask nothing definite); of the rest the ``keep`` edges of most
    evidence are paired, so a middle gives at most keep*(keep-1)/2 pairs. evidence: relation_id, document_id. doc_a and doc_b
    are the first documents, by id, of the left and of the right edge that differ: the left edge's first one with the right
    edge's first other, else the left edge's second with the right edge's only one."""
    each = evidence.filter(F.col("document_id").isNotNull() & F.col("relation_id").isNotNull()).select("relation_id", "document_id").distinct()
    first = each.groupBy("relation_id").agg(F.min("document_id").alias("doc_1"), F.max("document_id").alias("_last"))
    # the second is looked for only where there are two
    several = first.filter(F.col("doc_1") < F.col("_last")).select("relation_id", "doc_1")
    second = each.join(several, "relation_id").filter(F.col("document_id") > F.col("doc_1")).groupBy("relation_id").agg(F.min("document_id").alias("doc_2"))
    docs = first.drop("_last").join(second, "relation_id", "left")
    e = edges.join(docs, "relation_id")
    ends = e.select("*", F.explode(F.array(
        F.struct(F.col("source_entity_id").alias("mid"), F.col("source_name").alias("mid_name"), F.col("target_entity_id").alias("far"), F.col("target_name").alias("far_name")),
        F.struct(F.col("target_entity_id").alias("mid"), F.col("target_name").alias("mid_name"), F.col("source_entity_id").alias("far"), F.col("source_name").alias("far_name")),
    )).alias("x")).select("relation_id", "relation_type_name", "evidence_count", "doc_1", "doc_2", "x.*")
    ends = ends.filter(quality_name(F.col("mid_name")) & ~F.col("mid_name").isin(POOR_MIDDLES))
    degree = ends.groupBy("mid").agg(F.count(F.lit(1)).alias("degree")).filter(F.col("degree").between(least_degree, most_degree))
    ranked = ends.join(degree, "mid").withColumn("rn", F.row_number().over(W.partitionBy("mid").orderBy(F.desc("evidence_count"), "relation_id", "far"))).filter(F.col("rn") <= keep)
    ranked = ranked.filter(quality_name(F.col("far_name")))
    left, right = ranked.alias("l"), ranked.alias("r")
    apart = F.col("l.doc_1") != F.col("r.doc_1")
    pairs = left.join(right, (F.col("l.mid") == F.col("r.mid")) & (F.col("l.rn") < F.col("r.rn")) & (F.col("l.far") != F.col("r.far")) & (apart | F.col("r.doc_2").isNotNull() | F.col("l.doc_2").isNotNull()))
    doc_a = F.when(apart | F.col("r.doc_2").isNotNull(), F.col("l.doc_1")).otherwise(F.col("l.doc_2"))
    doc_b = F.when(apart, F.col("r.doc_1")).otherwise(F.coalesce("r.doc_2", "r.doc_1"))
    words = F.size(F.array_distinct(F.array("l.far_name", "l.mid_name", "r.far_name", "l.relation_type_name", "r.relation_type_name")))
    score = F.round(2.0 + F.log1p("l.evidence_count") + F.log1p("r.evidence_count") + words * 0.15 - F.log1p("l.degree") * 0.3, 6)
    return pairs.select(
        F.col("l.mid").alias("middle_id"), F.col("l.mid_name").alias("middle_name"), F.col("l.far").alias("start_id"), F.col("l.far_name").alias("start_name"),
        F.col("r.far").alias("end_id"), F.col("r.far_name").alias("end_name"), F.col("l.relation_id").alias("left_relation_id"), F.col("r.relation_id").alias("right_relation_id"),
        doc_a.alias("doc_a"), doc_b.alias("doc_b"), score.alias("score"))


def select_questions(found: DataFrame, count: int = 10) -> list[dict]:
    """Greedy choice of diverse questions: middles, relation pairs and endpoint pairs once, a document pair twice at most.

    A middle is used once, so its best pairs suffice: they are ranked on the cluster and read in order, as far as
    needed, by the driver."""
    w = W.partitionBy("middle_id").orderBy(F.desc("score"), "left_relation_id", "right_relation_id")
    rows = found.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= 435).drop("_n").orderBy(F.desc("score"), "middle_id", "left_relation_id", "right_relation_id")
    chosen: list[dict] = []
    mids, rels, ends, docs = set(), set(), set(), {}
    for r in rows.toLocalIterator():
        rel = tuple(sorted((r.left_relation_id, r.right_relation_id)))
        end = tuple(sorted((r.start_id, r.end_id)))
        pair = tuple(sorted((r.doc_a, r.doc_b)))
        if r.middle_id in mids or rel in rels or end in ends or docs.get(pair, 0) >= 2:
            continue
        mids.add(r.middle_id), rels.add(rel), ends.add(end)
        docs[pair] = docs.get(pair, 0) + 1
        question = f"‘{r.start_name}’와 ‘{r.end_name}’는 ‘{r.middle_name}’를 거쳐 어떻게 연결되며, 각 연결의 근거 법령은 무엇인가?"
        number = f"crossdoc-{len(chosen) + 1:02d}-{hashlib.sha256('|'.join(rel).encode()).hexdigest()[:10]}"
        chosen.append({**r.asDict(), "question_id": number, "question": question, "expected_relation_ids": rel})
        if len(chosen) == count:
            break
    return chosen


def graph_payload(paths: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of ranked paths (with rank) and candidate entities (entity_id, name, rank) for drawing."""
    on_path = paths.select("rank", F.posexplode(F.arrays_zip("entity_ids", "entity_names")).alias("level", "x")).select(
        F.col("x.entity_ids").alias("id"), F.col("x.entity_names").alias("name"), F.col("rank").alias("path_rank"), "level", F.lit(False).alias("c"), F.lit(None).cast("long").alias("candidate_rank"))
    cand = candidates.select(F.col("entity_id").alias("id"), "name", F.lit(None).cast("long").alias("path_rank"), F.lit(0).alias("level"), F.lit(True).alias("c"), F.col("rank").alias("candidate_rank"))
    nodes = on_path.unionByName(cand).groupBy("id").agg(
        F.min("name").alias("name"), F.bool_or("c").alias("is_candidate"), F.bool_or(F.col("path_rank").isNotNull()).alias("on_path"),
        F.min("path_rank").alias("path_rank"), F.min("candidate_rank").alias("candidate_rank"), F.min("level").alias("level"))
    links = paths.select("rank", F.posexplode("relation_ids").alias("i", "relation_id"), "entity_ids", "type_names").select(
        "relation_id", F.get("entity_ids", F.col("i")).alias("from_id"), F.get("entity_ids", F.col("i") + 1).alias("to_id"), F.get("type_names", F.col("i")).alias("label"), "rank", "i")
    edges = links.groupBy("relation_id").agg(F.min_by(F.struct("from_id", "to_id", "label"), F.struct("rank", "i")).alias("e"), F.min("rank").alias("path_rank"), F.min("i").alias("level"))
    return nodes, edges.select("relation_id", "e.from_id", "e.to_id", "e.label", "path_rank", "level")
