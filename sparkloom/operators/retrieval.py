"""Hybrid retrieval: BM25 keyword ranking, exact nearest vectors, reciprocal-rank fusion, seeds."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkloom.functions.text import query_terms

K1, B = 1.2, 0.75
#: Rank constant of the fusion.
RRF = 60
#: Query vectors that one broadcast block holds.
VECTORS_PER_BLOCK = 1024
#: Keyword queries of one block; their words and weights are broadcast.
QUERIES_PER_BLOCK = 512
#: Boosts of a whole-name match, a term equal to the name and a term inside it.
WHOLE, EQUAL, INSIDE = 8.0, 10.0, 2.0
#: Boosts of the BM25 scores of a relation's names, of which the best counts.
RELATION_FIELDS = {"source_name": 3.0, "target_name": 3.0, "relation_type_name": 2.0}
_WORDS = r"[0-9A-Za-z가-힣]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORDS), F.lit(0))


def bm25(docs: DataFrame, key: str, text: str, queries: DataFrame, top: int | None) -> DataFrame:
    """(query_id, doc, score, rank): the ``top`` documents of each query by BM25 over lower-case words; with None, every
    document that holds a word, as (query_id, doc, score).

    queries: (query_id, text), used in blocks of bounded size. One pass counts how many documents hold each query word
    (combined in every task); in a second pass every task scores its documents against the block and keeps ``top`` a query,
    so neither the words of documents nor their scores are shuffled, and a word held by most documents is no hot key. Ties go
    to the smaller key. Null texts match nothing; repeated queries count once."""
    spark = docs.sparkSession
    d = docs.filter(F.col(text).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("doc"), words(F.col(text)).alias("w"))
    kind = d.schema["doc"].dataType.simpleString()
    empty = spark.createDataFrame([], f"query_id long, doc {kind}, score double, rank long")
    stats = d.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("w")).alias("mean")).first()
    if not stats["n"]:
        return empty
    asked = queries.select("query_id", F.array_distinct(words(F.col("text"))).alias("terms")).filter(F.col("terms").isNotNull()).distinct().orderBy("query_id").toLocalIterator()
    out = None
    while block := list(itertools.islice(asked, QUERIES_PER_BLOCK)):
        terms = sorted({t for q in block for t in q["terms"]})
        held = d.select(F.explode(F.array_distinct("w")).alias("term")).join(F.broadcast(spark.createDataFrame([(t,) for t in terms], "term string")), "term", "left_semi")
        df = {r["term"]: r["n"] for r in held.groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
        at = {t: i for i, t in enumerate(terms)}
        weight = np.zeros((len(terms), len(block)))
        for j, q in enumerate(block):
            for t in q["terms"]:
                n = df.get(t, 0)
                weight[at[t], j] = math.log1p((stats["n"] - n + 0.5) / (n + 0.5))
        shared = spark.sparkContext.broadcast(([q["query_id"] for q in block], at, weight, stats["mean"] or 1.0))
        part = d.mapInPandas(_score_block(shared, top), f"query_id long, doc {kind}, score double")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return empty
    if top is None:
        return out
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "doc"))
    return out.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)


def _score_block(shared, top: int | None):
    def run(batches):
        ids, at, weight, mean = shared.value
        for pdf in batches:
            scores = np.zeros((len(pdf), len(ids)))
            for i, ws in enumerate(pdf["w"]):
                tf: dict[int, int] = {}
                for w in ws:
                    t = at.get(w)
                    if t is not None:
                        tf[t] = tf.get(t, 0) + 1
                if tf:
                    rows = sorted(tf)
                    n = np.array([tf[t] for t in rows], dtype=np.float64)
                    scores[i] = (n * (K1 + 1) / (n + K1 * (1 - B + B * len(ws) / mean))) @ weight[rows]
            scores = np.round(scores, 6)
            docs = pdf["doc"].to_numpy()
            out = []
            for j, q in enumerate(ids):
                col = scores[:, j]
                hit = np.flatnonzero(col > 0)
                if top is not None and len(hit) > top:  # with all that tie at the last place
                    hit = hit[col[hit] >= np.partition(col[hit], len(hit) - top)[len(hit) - top]]
                out.extend((q, docs[i], col[i]) for i in sorted(hit, key=lambda i: (-col[i], docs[i]))[:top])
            yield pd.DataFrame(out, columns=["query_id", "doc", "score"])

    return run


def _terms_inside(names: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, doc, name, s) of every query term inside a name, with the boosts of INSIDE and EQUAL. names: doc, name in lower
    case. Candidates come from shared two-character grams, so no name meets every query."""
    grams = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda i: F.substr(c, i, F.lit(2))))
    t = queries.select("query_id", F.explode(F.transform(query_terms(F.col("text")), F.lower)).alias("term"))
    # a term inside a name shares the term's first gram with it
    tg = t.withColumn("g", F.substr("term", F.lit(1), F.lit(2)))
    hit = names.withColumn("g", F.explode(grams(F.col("name")))).join(tg, "g").filter(F.col("name").contains(F.col("term")))
    return hit.select("query_id", "doc", "name", (F.lit(INSIDE) + F.when(F.col("name") == F.col("term"), EQUAL).otherwise(0.0)).alias("s"))


def keyword_names(names: DataFrame, key: str, name: str, queries: DataFrame, top: int) -> DataFrame:
    """(query_id, doc, score, rank) of names by boosts: the whole query equal to the name, a query term equal to it,
    a query term inside it. Of several names of a key the best counts."""
    n = names.filter(F.col(name).isNotNull()).select(F.col(key).alias("doc"), F.lower(F.col(name)).alias("name")).distinct()
    q = queries.select("query_id", F.lower("text").alias("name"))
    whole = n.join(q, "name").select("query_id", "doc", "name", F.lit(WHOLE).alias("s"))
    each = _terms_inside(n, queries).unionByName(whole).groupBy("query_id", "doc", "name").agg(F.sum("s").alias("s"))
    score = each.groupBy("query_id", "doc").agg(F.max("s").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "doc"))
    return score.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)


def entity_names(entities: DataFrame) -> DataFrame:
    """(entity_id, name): the canonical name and, where there are aliases, each of them."""
    canon = entities.select("entity_id", F.col("canonical_name").alias("name"))
    if "aliases" not in entities.columns:
        return canon
    return canon.unionByName(entities.select("entity_id", F.explode("aliases").alias("a")).select("entity_id", F.col("a.name").alias("name")))


def keyword_relations(edges: DataFrame, queries: DataFrame, top: int) -> DataFrame:
    """(query_id, doc, score, rank) of relations: the best boosted BM25 score of the source, target and type name, and for
    each of the three names the boosts of the query terms equal to it and inside it.

    Terms have lost their particles, words of BM25 have not. Every relation is scored by both before the cut at ``top``.
    Repeated edges count once; null names match nothing; ties go to the smaller id."""
    ranked = None
    for field, boost in RELATION_FIELDS.items():
        part = bm25(edges, "relation_id", field, queries, None).select("query_id", "doc", (F.col("score") * boost).alias("s"))
        ranked = part if ranked is None else ranked.unionByName(part)
    best = ranked.groupBy("query_id", "doc").agg(F.max("s").alias("s"))
    fields = F.array(*[F.struct(F.lit(i).alias("i"), F.lower(F.col(c)).alias("name")) for i, c in enumerate(RELATION_FIELDS)])
    names = edges.select(F.col("relation_id").alias("doc"), F.explode(fields).alias("f")).select("doc", "f.i", "f.name").filter(F.col("doc").isNotNull() & F.col("name").isNotNull()).distinct()
    score = best.unionByName(_terms_inside(names, queries).drop("name")).groupBy("query_id", "doc").agg(F.round(F.sum("s"), 6).alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "doc"))
    return score.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)


def normalise(vector: Column, digits: int = 8) -> Column:
    """Unit length, rounded; null for a zero vector or one with a value that is no number."""
    v = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | F.abs(x).eqNullSafe(F.lit(float("inf")))) | (norm == 0)
    return F.when(~bad, F.transform(v, lambda x: F.bround(x / norm, digits)))


def nearest(vectors: DataFrame, key: str, vector: str, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, doc, score, rank): the k vectors of greatest cosine for each query vector, exactly.

    queries: (query_id, vector). Query vectors are broadcast in blocks of bounded size; every partition multiplies
    its vectors with the block and keeps k a query, so k rows a query and partition are shuffled. Zero, null and
    differently sized vectors match nothing. Ties go to the smaller key."""
    spark = vectors.sparkSession
    rows = queries.select("query_id", F.col(vector).alias("v")).filter(F.col("v").isNotNull()).toLocalIterator()
    base = vectors.select(F.col(key).alias("doc"), F.col(vector).alias("v")).filter(F.col("v").isNotNull())
    kind = base.schema["doc"].dataType.simpleString()
    out = None
    while block := list(itertools.islice(rows, VECTORS_PER_BLOCK)):
        shared = spark.sparkContext.broadcast(([r[0] for r in block], np.asarray([r[1] for r in block], dtype=np.float64)))
        part = base.mapInPandas(_top_block(shared, k), f"query_id long, doc {kind}, score double")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return base.select(F.lit(None).cast("long").alias("query_id"), "doc", F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("rank")).limit(0)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "doc"))
    return out.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= k)


def _top_block(shared, k: int):
    def run(batches):
        ids, q = shared.value
        norm = np.linalg.norm(q, axis=1)
        q = q[norm > 0] / norm[norm > 0][:, None]
        ids = np.asarray(ids)[norm > 0]
        for pdf in batches:
            keep = [i for i, v in enumerate(pdf["v"]) if len(v) == q.shape[1]]
            if not keep or not len(ids):
                continue
            m = np.asarray([pdf["v"].iloc[i] for i in keep], dtype=np.float64)
            n = np.linalg.norm(m, axis=1)
            docs = pdf["doc"].to_numpy()[keep][n > 0]
            s = np.round((m[n > 0] / n[n > 0][:, None]) @ q.T, 9)
            order = np.lexsort((np.broadcast_to(docs[:, None], s.shape), -s), axis=0)[:k]
            yield pd.DataFrame({
                "query_id": np.broadcast_to(ids, order.shape).ravel(), "doc": docs[order].ravel(),
                "score": np.take_along_axis(s, order, axis=0).ravel(),
            })

    return run


def fuse(ranked: dict[str, DataFrame], top: int) -> DataFrame:
    """(query_id, doc, score, matched_by, rank): ranked lists (query_id, doc, rank) fused by reciprocal rank."""
    rows = None
    for i, (label, df) in enumerate(ranked.items()):
        part = df.select("query_id", "doc", "rank", F.lit(i).alias("i"), F.lit(label).alias("label"))
        rows = part if rows is None else rows.unionByName(part)
    fused = rows.groupBy("query_id", "doc").agg(
        F.round(F.sum(F.lit(1.0) / (F.lit(RRF) + F.col("rank"))), 9).alias("score"),
        # at most one entry per list
        F.transform(F.array_sort(F.collect_list(F.struct("i", "label"))), lambda x: x["label"]).alias("matched_by"),
    )
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "doc"))
    return fused.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)


def fuse_lists(ranked: dict[str, list[str]], top: int) -> list[tuple[str, float, list[str], int]]:
    """``fuse`` of short ranked lists of one query on the driver: (doc, score, matched_by, rank)."""
    score: dict[str, float] = {}
    by: dict[str, list[str]] = {}
    for label, docs in ranked.items():
        for rank, doc in enumerate(docs, 1):
            score[doc] = score.get(doc, 0.0) + 1.0 / (RRF + rank)
            by.setdefault(doc, []).append(label)
    order = sorted(score, key=lambda d: (-round(score[d], 9), d))[:top]
    return [(d, round(score[d], 9), by[d], i) for i, d in enumerate(order, 1)]


def merge_seeds(entities: list[tuple[str, str, float]], relations: list[tuple[object, float]]) -> list[tuple[str, str, float]]:
    """(entity_id, name, score): entity candidates, and endpoints of relation candidates (edge, score) at 0.8 of the relation's
    score; the higher score counts, and the candidate's name before the endpoint's."""
    out: dict[str, tuple[str, float]] = {e: (n, s) for e, n, s in entities if e is not None}
    ends: dict[str, tuple[str, float]] = {}
    for edge, s in relations:
        for e, n in ((edge["source_entity_id"], edge["source_name"]), (edge["target_entity_id"], edge["target_name"])):
            if e is not None:
                name, best = ends.get(e, (n, 0.0))
                ends[e] = (min(name, n) if name and n else name or n, max(best, s * 0.8))
    for e, (n, s) in ends.items():
        out[e] = (out[e][0], max(out[e][1], s)) if e in out else (n, s)
    return [(e, n, s) for e, (n, s) in out.items()]
