"""Tables prepared once for many searches: names, edges with term statistics, the best edges of every entity, ranked evidence."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkloom.operators.paths import EDGE
from sparkloom.operators.retrieval import EQUAL, INSIDE, K1, RELATION_FIELDS, WHOLE, B, entity_names, words
from sparkloom.runtime import materialise

#: Edges of an entity and pieces of evidence of a relation that are prepared; searches may ask for as many.
PREPARED_EDGES, PREPARED_EVIDENCE = 200, 20
#: Rows of one hash bucket of the best edges and of the evidence, as an average: a lookup reads the buckets of its keys only.
ROWS_PER_BUCKET = 500_000


@dataclass
class SearchIndex:
    """What a search reads: ``names`` (entity_id, name in lower case, canonical_name), ``edges`` (with the words of their name
    fields), ``held`` (field, word, n: edges holding the word), ``best`` (end_id, neighbor_rank and the edge, bucketed by end_id),
    ``evidence`` (ranked, without texts, bucketed by relation_id), ``units`` (texts, bucketed by semantic_unit_id), numbers of
    buckets, and of each name field the number of edges that have it and its mean words."""

    names: DataFrame
    edges: DataFrame
    held: DataFrame
    best: DataFrame
    evidence: DataFrame
    units: DataFrame
    buckets: dict[str, int]
    stats: dict[str, tuple[int, float]]
    entity_vectors: DataFrame | None = None
    relation_vectors: DataFrame | None = None


def _bucketed(df: DataFrame, key: str, label: str) -> tuple[DataFrame, int]:
    """``df`` written in folders by the hash of its key, and their number."""
    flat = materialise(df, label + "-rows")
    n = max(1, -(-flat.count() // ROWS_PER_BUCKET))
    if n == 1:
        return flat, 1
    by = F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    return materialise(flat.withColumn("_bucket", by).repartition(n, "_bucket"), label, partition="_bucket"), n


def _text(value: str) -> str:
    """A literal of Spark's SQL. Expressions of many literals are parsed from one text: building them one by one takes longer."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def among(df: DataFrame, key: str, keys: list[str], buckets: int) -> DataFrame:
    """Rows of a bucketed table whose key is one of a bounded list; other buckets are not read."""
    out = df.filter(f"{key} IN ({', '.join(map(_text, keys))})")
    if buckets > 1:
        spark = df.sparkSession
        numbers = spark.createDataFrame([(k,) for k in keys], "k string").select(F.pmod(F.xxhash64("k"), F.lit(buckets)).cast("int")).distinct().collect()
        out = out.filter(F.col("_bucket").isin([r[0] for r in numbers])).drop("_bucket")
    return out


def prepare_search(entities: DataFrame, edges: DataFrame, evidence: DataFrame, units: DataFrame, documents: DataFrame,
                   entity_vectors: DataFrame | None = None, relation_vectors: DataFrame | None = None) -> SearchIndex:
    """Writes the tables of a SearchIndex to the shared folder.

    A hub keeps its PREPARED_EDGES best edges, a relation its PREPARED_EVIDENCE first pieces, one a document: the rank filters
    become limits in every task before the shuffle, so no key is hot. Repeated rows count once; edges without an end,
    evidence without a unit or document are none."""
    canon = entities.select("entity_id", F.col("canonical_name").alias("canonical_name"))
    names = entity_names(entities).filter(F.col("entity_id").isNotNull() & F.col("name").isNotNull()).select("entity_id", F.lower("name").alias("name")).distinct()
    names = materialise(names.join(canon.groupBy("entity_id").agg(F.min("canonical_name").alias("canonical_name")), "entity_id"), "search-names")
    kept = materialise(edges.select(*EDGE).distinct().select(*EDGE, *[words(F.col(f)).alias(f"w_{f}") for f in RELATION_FIELDS]), "search-edges")
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.array_distinct(f"w_{f}").alias("w")) for f in RELATION_FIELDS]))
    held = materialise(
        kept.select(each.alias("x")).select("x.field", F.explode("x.w").alias("word")).groupBy("field", "word").agg(F.count(F.lit(1)).alias("n")), "search-held")
    row = kept.agg(*[F.count(f).alias(f"n_{f}") for f in RELATION_FIELDS], *[F.avg(F.when(F.col(f).isNotNull(), F.size(f"w_{f}"))).alias(f"m_{f}") for f in RELATION_FIELDS]).first()
    stats = {f: (row[f"n_{f}"], row[f"m_{f}"] or 1.0) for f in RELATION_FIELDS}
    ends = kept.select(F.col("source_entity_id").alias("end_id"), *EDGE).unionByName(
        kept.filter("source_entity_id <> target_entity_id").select(F.col("target_entity_id").alias("end_id"), *EDGE))
    order = W.partitionBy("end_id").orderBy(F.desc("evidence_count"), "relation_id")
    best = ends.withColumn("neighbor_rank", F.row_number().over(order).cast("long")).filter(F.col("neighbor_rank") <= PREPARED_EDGES)
    best, n_best = _bucketed(best, "end_id", "search-best")
    text = materialise(
        units.filter(F.col("semantic_unit_id").isNotNull()).groupBy("semantic_unit_id").agg(F.min(F.struct("document_id", "source_ref", "context_text", "unit_text")).alias("u")).select("semantic_unit_id", "u.*"),
        "search-units-once")
    d = documents.groupBy("document_id").agg(F.min("document_title").alias("document_title"))
    ref = F.concat_ws("|", "source_ref.article", F.coalesce(F.col("source_ref.paragraph").cast("string"), F.lit("")), F.array_join("source_ref.item_path", "/"))
    e = evidence.select("relation_id", "relation_mention_id", "semantic_unit_id", "raw_subject", "raw_predicate", "raw_object").dropDuplicates(["relation_mention_id", "relation_id"])
    j = e.join(text.select("semantic_unit_id", "document_id", "source_ref"), "semantic_unit_id").join(d, "document_id").withColumn("ref_text", ref)
    per_doc = W.partitionBy("relation_id", "document_id").orderBy("ref_text", "relation_mention_id")
    first = j.withColumn("_d", F.row_number().over(per_doc)).filter("_d = 1").drop("_d")
    per_rel = W.partitionBy("relation_id").orderBy(F.col("document_title").asc_nulls_first(), "ref_text", "relation_mention_id")
    ranked = first.withColumn("evidence_rank", F.row_number().over(per_rel).cast("long")).filter(F.col("evidence_rank") <= PREPARED_EVIDENCE)
    ranked, n_evidence = _bucketed(ranked, "relation_id", "search-evidence")
    text, n_units = _bucketed(text.select("semantic_unit_id", "context_text", "unit_text"), "semantic_unit_id", "search-units")
    return SearchIndex(names, kept, held, best, ranked, text, {"best": n_best, "evidence": n_evidence, "units": n_units}, stats, entity_vectors, relation_vectors)


def find_names(index: SearchIndex, question: str, terms: list[str], top: int) -> list[tuple[str, str]]:
    """(entity_id, canonical_name) of the best ``top`` entities: the boosts of ``retrieval.keyword_names`` in one scan of the names.
    The question's terms are few, so they are literals of one expression."""
    s = f"CASE WHEN name = {_text(question.lower())} THEN {WHOLE} ELSE 0D END" + "".join(_inside("name", t) for t in terms)
    hit = index.names.selectExpr("entity_id", "canonical_name", f"{s} AS s").filter("s > 0").groupBy("entity_id").agg(F.max("s").alias("s"), F.min("canonical_name").alias("canonical_name"))
    return [(r["entity_id"], r["canonical_name"]) for r in hit.orderBy(F.desc("s"), "entity_id").limit(top).collect()]


def _inside(name: str, term: str) -> str:
    t = _text(term)
    return f" + CASE WHEN {name} = {t} THEN {INSIDE + EQUAL} WHEN contains({name}, {t}) THEN {INSIDE} ELSE 0D END"


def _holding(index: SearchIndex, asked: list[str]) -> dict[tuple[str, str], int]:
    """How many edges hold each word in each name field."""
    if not asked:
        return {}
    return {(r["field"], r["word"]): r["n"] for r in index.held.filter(f"word IN ({', '.join(map(_text, asked))})").collect()}


def find_relations(index: SearchIndex, asked: list[str], terms: list[str], held: dict[tuple[str, str], int], top: int) -> list[dict]:
    """The best ``top`` edges (EDGE columns and score): the scores of ``retrieval.keyword_relations`` as one expression in one scan."""
    best, inside = [], ""
    for f, boost in RELATION_FIELDS.items():
        n, mean = index.stats[f]
        s = "0D"
        for t in asked:
            if df := held.get((f, t), 0):
                tf = f"size(filter(w_{f}, x -> x = {_text(t)}))"
                weight = math.log1p((n - df + 0.5) / (df + 0.5))
                s += f" + {weight!r}D * ({tf} * {K1 + 1!r}D) / ({tf} + {K1!r}D * ({1 - B!r}D + {B!r}D * size(w_{f}) / {mean!r}D))"
        best.append(f"coalesce(bround({s}, 6), 0D) * {boost!r}D")
        inside += "".join(_inside(f"lower({f})", t) for t in terms)
    score = f"round(greatest({', '.join(best)}){inside}, 6)"
    found = index.edges.selectExpr(*EDGE, f"{score} AS score").filter("score > 0").orderBy(F.desc("score"), "relation_id").limit(top)
    return [r.asDict() for r in found.collect()]


def candidates(index: SearchIndex, question: str, asked: list[str], terms: list[str], top: int, top_relations: int) -> tuple[list[tuple[str, str]], list]:
    """``find_names`` and ``find_relations``; the names are looked up while the words are counted."""
    with ThreadPoolExecutor(1) as pool:
        names = pool.submit(find_names, index, question, terms, top)
        held = _holding(index, asked)
        relations = find_relations(index, asked, terms, held, top_relations)
        return names.result(), relations


def best_edges(index: SearchIndex, ends: list[str], per_entity: int, preferred: list) -> list[tuple[str, object, bool]]:
    """(end, edge, preferred) of the ``per_entity`` best edges of each end: preferred ones first, which the caller knows (with EDGE
    columns), then by evidence, then by id. One scan without a shuffle."""
    if per_entity > PREPARED_EDGES:
        raise ValueError(f"an entity has {PREPARED_EDGES} prepared edges")
    found: dict[str, list] = {e: [] for e in ends}
    mine = {r["relation_id"] for r in preferred}
    for r in preferred:
        for e in {r["source_entity_id"], r["target_entity_id"]} & found.keys():
            found[e].append((r, True))
    for r in among(index.best, "end_id", ends, index.buckets["best"]).filter(F.col("neighbor_rank") <= per_entity).collect():
        r = r.asDict()
        if r["relation_id"] not in mine:
            found[r["end_id"]].append((r, False))
    out = []
    for e, rows in found.items():
        rows.sort(key=lambda x: (not x[1], x[0]["evidence_count"] is None, -(x[0]["evidence_count"] or 0), x[0]["relation_id"]))
        out += [(e, r, p) for r, p in rows[:per_entity]]
    return out


def evidence_of(index: SearchIndex, relation_ids: list[str], per_relation: int) -> list[dict]:
    """The first ``per_relation`` pieces of evidence of a bounded list of relations, with the texts of their units: late, and two
    lookups without a shuffle."""
    if per_relation > PREPARED_EVIDENCE:
        raise ValueError(f"a relation has {PREPARED_EVIDENCE} prepared pieces of evidence")
    if not relation_ids:
        return []
    rows = [r.asDict() for r in among(index.evidence, "relation_id", relation_ids, index.buckets["evidence"]).filter(F.col("evidence_rank") <= per_relation).collect()]
    units = sorted({r["semantic_unit_id"] for r in rows})
    text = {r["semantic_unit_id"]: r for r in among(index.units, "semantic_unit_id", units, index.buckets["units"]).collect()} if units else {}
    for r in rows:
        u = text[r["semantic_unit_id"]]
        r["context_text"], r["unit_text"] = u["context_text"], u["unit_text"]
    return rows
