"""Queries of the graph engine's own operators over whole tables, with their SQL where SQL can state them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.functions.ids import stable_id, stable_id_sql
from sparkloom.functions.typing_rules import entity_type, surface_type, surface_type_sql
from sparkloom.operators import audit, dictionary, graphmap, paths, retrieval
from sparkloom.operators.mentions import endpoints, mentions, one_per_key, pending, sanitize_records
from sparkloom.operators.segment import segment
from sparkloom.runtime import table
from sparkloom.sources.sinks import bulk_lines, numbered

#: Neighbours and paths that the bounded queries keep.
PER_ENTITY, TOP = 10, 10
QUESTION = "보건의료운영준칙은 미르전력수급연구재단을 거쳐 가람해양기상협력센터와 어떻게 연결되는가?"

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# -- tables as the operators take them --------------------------------------------------------------

_UNITS = "SELECT semantic_unit_id, any_value(document_id) AS document_id, any_value(document_title) AS document_title, any_value(source_path) AS source_path, any_value(source_ref) AS source_ref, any_value(unit_seq) AS unit_seq, any_value(relations) AS relations FROM raw_svo GROUP BY semantic_unit_id"
_M = f"""u AS ({_UNITS}),
m AS (SELECT semantic_unit_id, document_id, document_title, source_path, source_ref, unit_seq, i - 1 AS rel_ord, r.relation_mention_id AS relation_mention_id,
  r.subject AS subject, r.predicate AS predicate, r.object AS object FROM (SELECT *, relations[i] AS r FROM (SELECT *, unnest(range(1, len(relations) + 1)) AS i FROM u)))"""
_ENDS = f"""{_M}, ends AS (SELECT *, 'subject' AS role, 0 AS end_ord, subject AS name FROM m UNION ALL SELECT *, 'object', 1, object FROM m)"""
_REL = "rel AS (SELECT relation_id, max(source_entity_id) AS source_entity_id, max(source_name) AS source_name, max(relation_type_id) AS relation_type_id, max(target_entity_id) AS target_entity_id, max(target_name) AS target_name, max(evidence_count) AS evidence_count FROM relation GROUP BY relation_id)"
_EDGES = f"{_REL}, edges AS (SELECT r.*, t.canonical_name AS relation_type_name FROM rel r JOIN relation_type t USING (relation_type_id) WHERE source_entity_id IS NOT NULL AND target_entity_id IS NOT NULL)"
_ENT = "ent AS (SELECT entity_id, min(canonical_name) AS canonical_name, min(entity_type) AS entity_type, min(mention_count) AS mention_count, min(aliases) AS aliases FROM entity GROUP BY entity_id)"


def _mentions(spark: SparkSession, d: str) -> DataFrame:
    return mentions(table(spark, d, "raw_svo"))


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return paths.with_type_names(table(spark, d, "relation"), table(spark, d, "relation_type"))


def _entity(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "entity")
    return e.groupBy("entity_id").agg(*[F.min(c).alias(c) for c in ("canonical_name", "entity_type", "mention_count", "aliases")])


def _seeds(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "entity_reference").select(F.col("ref_id").alias("entity_id"), F.col("canonical_name").alias("name"))


def _taxonomy(spark: SparkSession, d: str) -> DataFrame:
    rt = table(spark, d, "relation_type")
    name = lambda p: F.max(F.when(F.col("polarity") == p, F.col("canonical_name")))
    return rt.groupBy("family_id").agg(name("POSITIVE").alias("positive_name"), name("NEGATIVE").alias("negative_name"))


# -- ids and star graphs ----------------------------------------------------------------------------


@query(f"SELECT DISTINCT entity_id, canonical_name, {stable_id_sql('entity', 'canonical_name')} AS own_id FROM entity WHERE canonical_name IS NOT NULL")
def stable_ids(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "entity").filter(F.col("canonical_name").isNotNull())
    return e.select("entity_id", "canonical_name", stable_id("entity", F.col("canonical_name")).alias("own_id")).distinct()


_STAR = f"""SELECT {stable_id_sql('relation', 'l_suppkey', "'supplies'", 'l_partkey')} AS relation_id, l_suppkey AS source_id, l_partkey AS target_id,
  count(*)::BIGINT AS evidence_count, count(DISTINCT l_orderkey)::BIGINT AS n_documents FROM lineitem GROUP BY l_suppkey, l_partkey"""


@query(_STAR)
def star_edges(spark: SparkSession, d: str) -> DataFrame:
    """(supplier)-[supplies]->(part), a line item being one mention and its order the document."""
    e = table(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("evidence_count"), F.count_distinct("l_orderkey").alias("n_documents"))
    return e.select(stable_id("relation", F.col("l_suppkey"), F.lit("supplies"), F.col("l_partkey")).alias("relation_id"),
                    F.col("l_suppkey").alias("source_id"), F.col("l_partkey").alias("target_id"), "evidence_count", "n_documents")


@query(f"""SELECT relation_id, source_id, target_id, evidence_count, rank FROM (SELECT *, row_number() OVER (PARTITION BY source_id
  ORDER BY evidence_count DESC, relation_id) AS rank FROM ({_STAR})) WHERE rank <= {TOP}""")
def star_neighbors(spark: SparkSession, d: str) -> DataFrame:
    """The best edges of every supplier (the flagship: aggregate, id, window, bound)."""
    w = W.partitionBy("source_id").orderBy(F.desc("evidence_count"), "relation_id")
    ranked = star_edges(spark, d).withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= TOP)
    return ranked.select("relation_id", "source_id", "target_id", "evidence_count", "rank")


@query("""SELECT user_id, event_type, json_extract_string(props, '$.k')::BIGINT AS k, count(*)::BIGINT AS evidence_count,
  count(DISTINCT date_trunc('day', ts))::BIGINT AS n_days, min(event_id) AS first_event FROM events GROUP BY ALL""")
def event_edges(spark: SparkSession, d: str) -> DataFrame:
    """(user)-[event_type]->(k), the day being the document."""
    e = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    return e.groupBy("user_id", "event_type", "k").agg(F.count(F.lit(1)).alias("evidence_count"), F.count_distinct(F.to_date("ts")).alias("n_days"), F.min("event_id").alias("first_event"))


# -- segmentation -----------------------------------------------------------------------------------


@query()
def segment_units(spark: SparkSession, d: str) -> DataFrame:
    """Articles, paragraphs and leaf items of every document."""
    return segment(table(spark, d, "documents"), "doc_id", "text")


@query("""WITH l AS (SELECT doc_id, i, t[i] AS line FROM (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS i FROM (
    SELECT doc_id, string_split_regex(text, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]') AS t FROM documents WHERE text IS NOT NULL AND text <> ''))),
s AS (SELECT *, min(CASE WHEN regexp_matches(line, '^#{1,6}\\s+부칙(?:\\s|$|\\()') THEN i END) OVER (PARTITION BY doc_id) AS stop FROM l)
SELECT doc_id, count(*)::BIGINT AS n_articles FROM s WHERE (stop IS NULL OR i < stop)
  AND regexp_matches(line, '^#{1,6}\\s+제\\s*\\d+(?:\\s*의\\s*\\d+)?\\s*조') GROUP BY doc_id""")
def article_counts(spark: SparkSession, d: str) -> DataFrame:
    """Article headings of every document before its supplementary provisions."""
    from sparkloom.operators.segment import ARTICLE, SUPPLEMENT, text_lines

    lines = text_lines(table(spark, d, "documents"), "doc_id", "text")
    stop = F.min(F.when(F.col("line").rlike(SUPPLEMENT), F.col("line_no"))).over(W.partitionBy("doc"))
    x = lines.withColumn("_s", stop).filter((F.col("_s").isNull() | (F.col("line_no") < F.col("_s"))) & F.col("line").rlike(ARTICLE))
    return x.groupBy(F.col("doc").alias("doc_id")).agg(F.count(F.lit(1)).alias("n_articles"))


@query("SELECT sha256(text) AS digest, count(*)::BIGINT AS n_copies, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1")
def document_digests(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").filter(F.col("text").isNotNull())
    return t.groupBy(F.sha2("text", 256).alias("digest")).agg(F.count(F.lit(1)).alias("n_copies"), F.min("doc_id").alias("first_doc"))


# -- mentions and dictionaries ----------------------------------------------------------------------


@query(f"""WITH {_ENDS}, f AS (SELECT name, semantic_unit_id, min(ROW(unit_seq, rel_ord, end_ord)) AS o FROM ends WHERE name IS NOT NULL GROUP BY ALL),
k AS (SELECT name, semantic_unit_id, row_number() OVER (PARTITION BY name ORDER BY o, semantic_unit_id) AS rn FROM f)
SELECT {stable_id_sql('entity_candidate', 'name')} AS candidate_id, name, (SELECT count(*) FROM ends e WHERE e.name = g.name)::BIGINT AS mention_count, sample_units FROM (
  SELECT name, list(semantic_unit_id ORDER BY rn) AS sample_units FROM k WHERE rn <= 5 GROUP BY name) g""")
def entity_candidates(spark: SparkSession, d: str) -> DataFrame:
    c = dictionary.candidates(endpoints(_mentions(spark, d)), "entity_candidate")
    return c.select("candidate_id", "name", "mention_count", F.transform("samples", lambda s: s["semantic_unit_id"]).alias("sample_units"))


@query(f"""WITH {_ENDS}, r AS (SELECT name, role, min(ROW(unit_seq, rel_ord, end_ord)) AS o, count(*) AS n,
    min(ROW(unit_seq, rel_ord, end_ord, semantic_unit_id)) AS f FROM ends WHERE name IS NOT NULL GROUP BY ALL)
SELECT name, list(role ORDER BY o) AS roles, sum(n)::BIGINT AS mention_count FROM r GROUP BY name""")
def surface_lists(spark: SparkSession, d: str) -> DataFrame:
    return dictionary.surface_lists(endpoints(_mentions(spark, d))).select("name", "roles", "mention_count")


@query(f"""WITH {_M} SELECT predicate AS canonical_name, count(*)::BIGINT AS mention_count,
  CASE WHEN regexp_matches(predicate, '{T.NEGATIVE_CUE}') THEN 'NEGATIVE' ELSE 'POSITIVE' END AS polarity FROM m WHERE predicate IS NOT NULL GROUP BY predicate""")
def relation_polarity(spark: SparkSession, d: str) -> DataFrame:
    return dictionary.predicate_counts(_mentions(spark, d))


_ROWS = f"""{_ENT}, a0 AS (SELECT trim(canonical_name, ' ') AS name, entity_id AS id, canonical_name, mention_count, NULL::BIGINT AS alias_count FROM ent
  UNION ALL SELECT trim(a.name, ' '), entity_id, canonical_name, mention_count, a.mention_count FROM (SELECT unnest(aliases) AS a, entity_id, canonical_name, mention_count FROM ent)),
al AS (SELECT name, id, min(canonical_name) AS canonical_name, max(mention_count) AS entity_count, max(coalesce(alias_count, 0)) AS alias_count FROM a0 WHERE name IS NOT NULL AND name <> '' GROUP BY name, id)"""


@query(f"WITH {_ROWS} SELECT name, count(DISTINCT id)::BIGINT AS n_ids, min(id) AS first_id FROM al GROUP BY name HAVING count(DISTINCT id) > 1")
def alias_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return dictionary.alias_conflicts(_entity(spark, d), "entity_id")


@query(f"""WITH {_ROWS} SELECT name, id, canonical_name FROM (SELECT *, row_number() OVER (PARTITION BY name
  ORDER BY name <> trim(canonical_name, ' '), alias_count DESC, entity_count DESC, canonical_name, id) AS rn FROM al) WHERE rn = 1""")
def alias_winners(spark: SparkSession, d: str) -> DataFrame:
    return dictionary.alias_winners(_entity(spark, d), "entity_id")


_WIN = f"""{_ROWS}, win AS (SELECT name, id, canonical_name FROM (SELECT *, row_number() OVER (PARTITION BY name
  ORDER BY name <> trim(canonical_name, ' '), alias_count DESC, entity_count DESC, canonical_name, id) AS rn FROM al) WHERE rn = 1)"""


@query(f"""WITH {_ROWS.replace("ent AS", "ent AS", 1)}, u AS (SELECT unnest(aliases) AS a, canonical_name, entity_id FROM ent)
SELECT a.name AS alias, canonical_name, entity_id AS id, a.mention_count AS mention_count FROM u""")
def entity_alias_map(spark: SparkSession, d: str) -> DataFrame:
    return dictionary.direct_alias_map(_entity(spark, d), "entity_id", keep_zero=True)


@query(f"""WITH {_ENDS}, {_WIN}, names AS (SELECT name, count(*) AS n FROM ends WHERE name IS NOT NULL GROUP BY name),
mp AS (SELECT n.name AS alias, coalesce(w.canonical_name, n.name) AS canonical_name, n.n FROM names n LEFT JOIN win w ON w.name = n.name),
per AS (SELECT canonical_name, alias, sum(n) AS n FROM (SELECT * FROM mp UNION ALL SELECT DISTINCT canonical_name, canonical_name, 0 FROM mp) GROUP BY ALL)
SELECT {stable_id_sql('entity', 'canonical_name')} AS entity_id, canonical_name, sum(n)::BIGINT AS mention_count, count(*)::BIGINT AS n_aliases,
  first(alias ORDER BY alias <> canonical_name, n DESC, alias) AS first_alias FROM per GROUP BY canonical_name""")
def clustered_entities(spark: SparkSession, d: str) -> DataFrame:
    """All surfaces merged by the aliases of the entity dictionary."""
    names = dictionary.candidates(endpoints(_mentions(spark, d)), "entity_candidate").select("name", "mention_count")
    mapping = dictionary.alias_winners(_entity(spark, d), "entity_id").select(F.col("name").alias("source_name"), "canonical_name")
    c = dictionary.clustered_dictionary(names, mapping)
    return c.select("entity_id", "canonical_name", "mention_count", F.size("aliases").cast("long").alias("n_aliases"), F.get("aliases", F.lit(0))["name"].alias("first_alias"))


_SEED = f"{_ENT}, seeds AS (SELECT DISTINCT a.name AS alias, canonical_name FROM (SELECT unnest(aliases) AS a, canonical_name FROM ent))"


@query(f"""WITH {_ENDS}, {_SEED}, own AS (SELECT DISTINCT canonical_name FROM seeds),
pr AS (SELECT alias, canonical_name AS c FROM seeds UNION SELECT canonical_name, canonical_name FROM seeds),
per AS (SELECT alias, count(DISTINCT c) AS n, min(c) AS target FROM pr WHERE NOT regexp_matches(c, '[\\x{{00C0}}-\\x{{024F}}\\x{{FFFD}}]') GROUP BY alias),
names AS (SELECT DISTINCT name FROM ends WHERE name IS NOT NULL)
SELECT n.name, CASE WHEN o.canonical_name IS NOT NULL THEN n.name WHEN p.n = 1 THEN p.target ELSE n.name END AS canonical_name,
  CASE WHEN o.canonical_name IS NOT NULL THEN 'seed_exact_canonical' WHEN p.n = 1 THEN 'seed_unique_alias' WHEN p.n > 1 THEN 'fallback_source_name_ambiguous_seed_alias'
    ELSE 'fallback_source_name_no_seed_match' END AS normalization_status
FROM names n LEFT JOIN per p ON p.alias = n.name LEFT JOIN own o ON o.canonical_name = n.name""")
def seeded_entity_mapping(spark: SparkSession, d: str) -> DataFrame:
    names = endpoints(_mentions(spark, d)).select("name").filter(F.col("name").isNotNull())
    seeds = _entity(spark, d).select(F.explode("aliases").alias("a"), "canonical_name").select(F.col("a.name").alias("alias"), "canonical_name").distinct()
    return dictionary.seeded_mapping(names, seeds)


@query(f"""WITH {_M}, p AS (SELECT predicate AS alias, count(*) AS n FROM m WHERE predicate IS NOT NULL GROUP BY 1),
s AS (SELECT DISTINCT canonical_name AS alias, canonical_name FROM relation_type)
SELECT coalesce(s.canonical_name, p.alias) AS canonical_name, coalesce(s.alias, p.alias) AS alias, coalesce(p.n, 0)::BIGINT AS mention_count FROM s FULL OUTER JOIN p ON s.alias = p.alias""")
def refreshed_relation_counts(spark: SparkSession, d: str) -> DataFrame:
    seeds = table(spark, d, "relation_type").select(F.col("canonical_name").alias("alias"), "canonical_name")
    return dictionary.refreshed_counts(seeds, dictionary.predicate_counts(_mentions(spark, d)))


@query(f"""WITH {_M}, p AS (SELECT predicate, count(*) AS n, CASE WHEN regexp_matches(predicate, '{T.NEGATIVE_CUE}') THEN 'NEGATIVE' ELSE 'POSITIVE' END AS polarity FROM m WHERE predicate IS NOT NULL GROUP BY predicate),
t AS (SELECT family_id, max(CASE WHEN polarity = 'POSITIVE' THEN canonical_name END) AS pos, max(CASE WHEN polarity = 'NEGATIVE' THEN canonical_name END) AS neg FROM relation_type GROUP BY family_id),
x AS (SELECT CASE WHEN p.polarity = 'POSITIVE' THEN t.pos ELSE t.neg END AS canonical_name, p.polarity, r.family_id, p.n FROM p JOIN relation_type r ON r.canonical_name = p.predicate AND r.polarity = p.polarity JOIN t ON t.family_id = r.family_id)
SELECT {stable_id_sql('relation_type', 'canonical_name')} AS relation_type_id, canonical_name, polarity, family_id, sum(n)::BIGINT AS mention_count, count(*)::BIGINT AS source_relation_type_count FROM x GROUP BY canonical_name, polarity, family_id""")
def closed_relation_rollup(spark: SparkSession, d: str) -> DataFrame:
    rt = table(spark, d, "relation_type")
    mapping = rt.select(F.col("canonical_name").alias("source_canonical_name"), F.col("polarity").alias("source_polarity"), "family_id").distinct()
    c = dictionary.closed_relation_dictionary(dictionary.predicate_counts(_mentions(spark, d)), mapping, _taxonomy(spark, d))
    return c.select("relation_type_id", "canonical_name", "polarity", "family_id", "mention_count", "source_relation_type_count")


@query(f"""WITH {_M}, p AS (SELECT predicate AS canonical_name, count(*)::BIGINT AS mention_count, CASE WHEN regexp_matches(predicate, '{T.NEGATIVE_CUE}') THEN 'NEGATIVE' ELSE 'POSITIVE' END AS polarity FROM m WHERE predicate IS NOT NULL GROUP BY predicate)
SELECT canonical_name, polarity, mention_count FROM p WHERE NOT EXISTS (SELECT 1 FROM relation_type r WHERE r.canonical_name = p.canonical_name AND r.polarity = p.polarity AND EXISTS (
  SELECT 1 FROM relation_type t WHERE t.family_id = r.family_id AND t.polarity = p.polarity))""")
def closed_relation_unmapped(spark: SparkSession, d: str) -> DataFrame:
    """Predicates that closed_relation_rollup leaves out, with their mentions."""
    rt = table(spark, d, "relation_type")
    mapping = rt.select(F.col("canonical_name").alias("source_canonical_name"), F.col("polarity").alias("source_polarity"), "family_id").distinct()
    return dictionary.unmapped_relations(dictionary.predicate_counts(_mentions(spark, d)), mapping, _taxonomy(spark, d)).select("canonical_name", "polarity", "mention_count")


@query(f"""WITH {_M}, k AS (SELECT canonical_name, polarity FROM relation_type WHERE polarity = CASE WHEN regexp_matches(canonical_name, '{T.NEGATIVE_CUE}') THEN 'NEGATIVE' ELSE 'POSITIVE' END)
SELECT regexp_replace(subject, '^\\s+|\\s+$', '', 'g') AS subject, predicate AS canonical_name, coalesce(k.polarity, CASE WHEN regexp_matches(predicate, '{T.NEGATIVE_CUE}') THEN 'NEGATIVE' ELSE 'POSITIVE' END) AS polarity,
  regexp_replace(object, '^\\s+|\\s+$', '', 'g') AS object, count(*)::BIGINT AS evidence_count FROM m LEFT JOIN k ON k.canonical_name = m.predicate
WHERE subject IS NOT NULL AND predicate IS NOT NULL AND object IS NOT NULL GROUP BY 1, 2, 3, 4""".replace("\\s", "[\\s\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"))
def first_pass_edges(spark: SparkSession, d: str) -> DataFrame:
    rt = table(spark, d, "relation_type").select(F.col("canonical_name").alias("alias"), "canonical_name", "polarity")
    return dictionary.first_pass(_mentions(spark, d), rt)


@query("""SELECT entity_id, canonical_name, entity_type, mention_count, updated_at FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY s, updated_at, canonical_name) AS rn FROM (
  SELECT *, 0 AS s FROM entity WHERE deleted_at IS NOT NULL UNION ALL SELECT *, 1 FROM entity)) WHERE rn = 1""")
def merge_first_wins(spark: SparkSession, d: str) -> DataFrame:
    """Two shards of entities, deleted ones first; the first row of a key stays."""
    e = table(spark, d, "entity").select("entity_id", "canonical_name", "entity_type", "mention_count", "updated_at", "deleted_at")
    return dictionary.merge_first_wins([e.filter("deleted_at IS NOT NULL"), e], "entity_id", ["updated_at", "canonical_name"]).select(
        "entity_id", "canonical_name", "entity_type", "mention_count", "updated_at")


@query()
def lexical_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Entity names that differ in spaces, quotes and width only."""
    e = _entity(spark, d).select("entity_id", "canonical_name", T.lexical_key(F.col("canonical_name")).alias("lexical_key"))
    n = F.count(F.lit(1)).over(W.partitionBy("lexical_key"))
    return e.withColumn("n_names", n).filter("n_names > 1")


@query(f"""WITH {_ENDS} SELECT DISTINCT name, (length(name) >= 12 OR regexp_matches(name, '{T.CONTEXT_CUE[4:]}')) AS needs_context FROM ends WHERE name IS NOT NULL""".replace("\\s", "[\\s\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]").replace("\\d", "\\pN"))
def contextual_candidates(spark: SparkSession, d: str) -> DataFrame:
    n = endpoints(_mentions(spark, d)).select("name").filter(F.col("name").isNotNull()).distinct()
    return n.withColumn("needs_context", T.needs_context(F.col("name")))


@query(f"WITH {_ENT} SELECT entity_id, canonical_name, {surface_type_sql('canonical_name')} AS rule_type FROM ent")
def entity_rule_types(spark: SparkSession, d: str) -> DataFrame:
    """Type of every canonical name by rule."""
    return _entity(spark, d).select("entity_id", "canonical_name", surface_type(F.col("canonical_name")).alias("rule_type"))


@query(f"""WITH {_ENT}, x AS (SELECT entity_id, canonical_name, {surface_type_sql('canonical_name')} AS own,
  list_filter(list_transform(list_filter(aliases, lambda a: a.name IS NOT NULL), lambda a: {surface_type_sql('a.name')}), lambda t: t IS NOT NULL)[1] AS other FROM ent)
SELECT entity_id, canonical_name, coalesce(own, other, 'OTHER') AS entity_type, CASE WHEN own IS NOT NULL THEN 'canonical_rule' WHEN other IS NOT NULL THEN 'alias_rule' ELSE 'fallback_other' END AS method FROM x""")
def entity_types(spark: SparkSession, d: str) -> DataFrame:
    t = entity_type(F.col("canonical_name"), F.transform("aliases", lambda a: a["name"]))
    return _entity(spark, d).select("entity_id", "canonical_name", t["entity_type"].alias("entity_type"), t["method"].alias("method"))


@query(f"""WITH {_ENT}, k AS (SELECT unnest(['ORGANIZATION','PERSON','LEGAL_INSTRUMENT','CONCEPT','OTHER','UNKNOWN']) AS entity_type),
c AS (SELECT CASE WHEN entity_type IN ('ORGANIZATION','PERSON','LEGAL_INSTRUMENT','CONCEPT','OTHER') THEN entity_type ELSE 'UNKNOWN' END AS entity_type, count(*) AS n FROM ent GROUP BY 1)
SELECT k.entity_type, coalesce(n, 0)::BIGINT AS n_entities FROM k LEFT JOIN c USING (entity_type)""")
def entity_type_histogram(spark: SparkSession, d: str) -> DataFrame:
    return audit.audit_types(table(spark, d, "entity"))


@query("SELECT unit_kind, resolution_type, count(DISTINCT semantic_unit_id)::BIGINT AS n_units FROM semantic_units GROUP BY ALL")
def resolution_histogram(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "semantic_units").groupBy("unit_kind", "resolution_type").agg(F.count_distinct("semantic_unit_id").alias("n_units"))


# -- cleaning ---------------------------------------------------------------------------------------


@query()
def sanitized_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Mentions after the endpoint rules, enumerations split."""
    clean = sanitize_records(table(spark, d, "raw_svo"))
    return mentions(clean).select("semantic_unit_id", "rel_ord", "relation_mention_id", "subject", "predicate", "object")


@query(f"""WITH {_ENDS} SELECT role, name IN ({', '.join(repr(x) for x in T.GENERIC_ENDPOINTS)}) AS is_generic,
  regexp_matches(name, '{T.PURE_CONDITION[4:].replace(chr(92) + 'A', '^').replace(chr(92) + 'z', '$')}') AS is_quantity, count(*)::BIGINT AS n FROM ends WHERE name IS NOT NULL GROUP BY ALL""")
def discardable_endpoints(spark: SparkSession, d: str) -> DataFrame:
    e = endpoints(_mentions(spark, d)).filter(F.col("name").isNotNull())
    return e.groupBy("role", F.col("name").isin(T.GENERIC_ENDPOINTS).alias("is_generic"), F.col("name").rlike(T.PURE_CONDITION).alias("is_quantity")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_ENDS} SELECT CASE WHEN name IN ({', '.join(repr(x) for x in T.SELF_REFERENCES)}) THEN 'current_document_self_reference' ELSE 'exact_surface' END AS method,
  role, count(*)::BIGINT AS n FROM ends WHERE name IS NOT NULL GROUP BY ALL""")
def self_references(spark: SparkSession, d: str) -> DataFrame:
    e = endpoints(_mentions(spark, d)).filter(F.col("name").isNotNull())
    r = T.resolve_self_reference(F.col("name"), F.col("document_title"))
    return e.groupBy(r["method"].alias("method"), "role").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT DISTINCT source_ref.article AS article, concat_ws(' ', nullif(source_ref.article, ''), '제' || source_ref.paragraph::VARCHAR || '항',
  nullif(array_to_string(source_ref.item_path, '-'), '')) AS ref_text FROM evidence WHERE source_ref IS NOT NULL""")
def source_ref_texts(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "evidence").filter(F.col("source_ref").isNotNull())
    return e.select(F.col("source_ref.article").alias("article"), T.source_ref_text(F.col("source_ref")).alias("ref_text")).distinct()


@query()
def parsed_responses(spark: SparkSession, d: str) -> DataFrame:
    """Relations parsed from every model answer; null for an answer without any object."""
    r = table(spark, d, "model_responses")
    return r.select("response_id", "semantic_unit_id", T.parse_relations(F.col("response_text")).alias("relations"))


def _terms_sql(text: str, particles: list[str], stop: list[str], most: int) -> str:
    bare = f"list_transform(regexp_extract_all({text}, '[0-9A-Za-z가-힣]+'), lambda w: regexp_replace(w, '^(.{{2,}}?)(?:{'|'.join(particles)})$', '\\1'))"
    kept = f"list_filter({bare}, lambda w: length(w) >= 2 AND w NOT IN ({', '.join(repr(x) for x in stop)}))"
    return f"list_filter({kept}, lambda w, i: list_position({kept}, w) = i)[1:{most}]"


_RETRIEVAL_TERMS = _terms_sql("text", T.QUERY_PARTICLES, T.QUERY_STOP_WORDS, T.QUERY_TERMS)


@query(f"""SELECT item_id, {_RETRIEVAL_TERMS} AS retrieval_terms, {_terms_sql("lower(text)", T.SEARCH_PARTICLES, T.SEARCH_STOP_WORDS, T.SEARCH_TERMS)} AS ranking_terms FROM benchmark""")
def query_terms(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "benchmark")
    return b.select("item_id", T.query_terms(F.col("text")).alias("retrieval_terms"), T.search_terms(F.col("text")).alias("ranking_terms"))


# -- graph mapping ----------------------------------------------------------------------------------


def _bundle(spark: SparkSession, d: str) -> graphmap.GraphBundle:
    """The graph of all mentions with a predicate: predicates beyond the relation types are types of their own."""
    rt = table(spark, d, "relation_type").select("relation_type_id", "canonical_name", "polarity").distinct()
    m = _mentions(spark, d).filter(T.trim_all(F.col("predicate")) != "")
    own = m.select(T.trim_all(F.col("predicate")).alias("canonical_name")).distinct().join(rt.select("canonical_name").distinct(), "canonical_name", "left_anti")
    types = rt.unionByName(own.select(stable_id("relation_type", F.col("canonical_name")).alias("relation_type_id"), "canonical_name", T.infer_polarity(F.col("canonical_name")).alias("polarity")))
    index = types.select(F.col("canonical_name").alias("name"), F.col("relation_type_id").alias("id"), "canonical_name")
    return graphmap.map_to_graph(m, dictionary.alias_winners(_entity(spark, d), "entity_id"), index, types)


_SP = "[\\s\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
_TRIM = lambda c: f"regexp_replace({c}, '^{_SP}+|{_SP}+$', '', 'g')"
_MAP = f"""{_M}, {_WIN}, mp AS (SELECT *, {_TRIM('predicate')} AS p FROM m WHERE {_TRIM('predicate')} <> ''),
mm AS (SELECT mp.*, coalesce(t.relation_type_id, {stable_id_sql('relation_type', 'p')}) AS relation_type_id FROM mp LEFT JOIN relation_type t ON t.canonical_name = p),
e0 AS (SELECT *, 'subject' AS role, {_TRIM('subject')} AS raw_name FROM mm UNION ALL SELECT *, 'object', {_TRIM('object')} FROM mm),
e1 AS (SELECT *, CASE WHEN raw_name IN ({', '.join(repr(x) for x in T.SELF_REFERENCES)}) THEN {_TRIM("coalesce(document_title, '')")} ELSE raw_name END AS resolved,
  raw_name IN ({', '.join(repr(x) for x in T.SELF_REFERENCES)}) AS own FROM e0 WHERE raw_name <> ''),
e2 AS (SELECT e1.*, coalesce(w.id, {stable_id_sql('entity', 'resolved')}) AS entity_id, coalesce(w.canonical_name, resolved) AS canonical_name,
  CASE WHEN own THEN 'current_document_self_reference' WHEN w.id IS NULL THEN 'new_raw_entity' WHEN raw_name = w.canonical_name THEN 'dictionary_canonical' ELSE 'dictionary_alias' END AS mapping_status
  FROM e1 LEFT JOIN win w ON w.name = e1.resolved),
tr AS (SELECT s.entity_id AS source_entity_id, s.relation_type_id, o.entity_id AS target_entity_id, s.semantic_unit_id, s.rel_ord, s.relation_mention_id, s.p AS raw_predicate
  FROM (SELECT * FROM e2 WHERE role = 'subject') s JOIN (SELECT * FROM e2 WHERE role = 'object') o USING (semantic_unit_id, rel_ord))"""


@query(f"""WITH {_MAP} SELECT {stable_id_sql('relation', 'source_entity_id', 'relation_type_id', 'target_entity_id')} AS relation_id, source_entity_id, relation_type_id, target_entity_id, count(*)::BIGINT AS evidence_count
FROM tr GROUP BY source_entity_id, relation_type_id, target_entity_id""")
def graph_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges of all mentions with a predicate."""
    return _bundle(spark, d).relations.select("relation_id", "source_entity_id", "relation_type_id", "target_entity_id", "evidence_count")


@query(f"WITH {_MAP} SELECT raw_name, resolved AS resolved_name, entity_id, canonical_name, mapping_status, count(*)::BIGINT AS mention_count FROM e2 GROUP BY ALL")
def entity_mapping_status(spark: SparkSession, d: str) -> DataFrame:
    return _bundle(spark, d).entity_mapping


@query(f"WITH {_MAP} SELECT raw_predicate, relation_type_id, 'dictionary_alias' AS mapping_status, count(*)::BIGINT AS mention_count FROM tr GROUP BY ALL")
def relation_mapping_status(spark: SparkSession, d: str) -> DataFrame:
    return _bundle(spark, d).relation_mapping


@query(f"WITH {_MAP} SELECT entity_id, count(*)::BIGINT AS mention_count FROM e2 GROUP BY entity_id")
def entity_load_counts(spark: SparkSession, d: str) -> DataFrame:
    return _bundle(spark, d).entities.select("entity_id", "mention_count")


@query()
def graph_entities(spark: SparkSession, d: str) -> DataFrame:
    return _bundle(spark, d).entities


@query()
def unmapped_entities(spark: SparkSession, d: str) -> DataFrame:
    return _bundle(spark, d).unmapped_entities


@query(f"WITH {_M} SELECT count(*) > 0 AS refused FROM m WHERE predicate IS NOT NULL AND {_TRIM('predicate')} NOT IN (SELECT canonical_name FROM relation_type)")
def mapping_fails_closed(spark: SparkSession, d: str) -> DataFrame:
    """Whether mapping by the relation types alone is refused, as it is if any predicate is none of them."""
    rt = table(spark, d, "relation_type")
    index = rt.select(F.col("canonical_name").alias("name"), F.col("relation_type_id").alias("id"), "canonical_name")
    try:
        graphmap.map_to_graph(_mentions(spark, d), dictionary.alias_winners(_entity(spark, d), "entity_id"), index, rt)
        refused = False
    except graphmap.UnmappedRelationError:
        refused = True
    return spark.createDataFrame([(refused,)], "refused boolean")


@query(f"WITH {_M} SELECT DISTINCT {_TRIM('predicate')} AS predicate FROM m WHERE predicate IS NOT NULL AND {_TRIM('predicate')} NOT IN (SELECT canonical_name FROM relation_type)")
def unmapped_predicates(spark: SparkSession, d: str) -> DataFrame:
    index = table(spark, d, "relation_type").select(F.col("canonical_name").alias("name"))
    return graphmap.unmapped_predicates(_mentions(spark, d), index)


@query("SELECT DISTINCT semantic_unit_id FROM semantic_units WHERE semantic_unit_id NOT IN (SELECT semantic_unit_id FROM raw_svo WHERE semantic_unit_id IS NOT NULL)")
def resume_pending(spark: SparkSession, d: str) -> DataFrame:
    return pending(table(spark, d, "semantic_units").select("semantic_unit_id").distinct(), table(spark, d, "raw_svo"))


# -- audits -----------------------------------------------------------------------------------------


_BLANK = lambda c: f"count(*) FILTER ({c} IS NULL OR {_TRIM(c)} = '')"


@query(f"""WITH {_M}, x AS (SELECT
  (SELECT count(DISTINCT semantic_unit_id) FROM semantic_units WHERE semantic_unit_id NOT IN (SELECT semantic_unit_id FROM raw_svo WHERE semantic_unit_id IS NOT NULL)) AS units_without_record,
  (SELECT count(DISTINCT semantic_unit_id) FROM raw_svo WHERE semantic_unit_id NOT IN (SELECT semantic_unit_id FROM semantic_units WHERE semantic_unit_id IS NOT NULL)) AS records_without_unit,
  (SELECT count(*) FROM (SELECT relation_mention_id FROM m GROUP BY 1 HAVING count(*) > 1)) AS doubled_mentions,
  (SELECT count(*) FILTER (NOT coalesce(regexp_matches(relation_mention_id, '^[0-9a-f]{{8}}-[0-9a-f]{{4}}-[1-5][0-9a-f]{{3}}-[89ab][0-9a-f]{{3}}-[0-9a-f]{{12}}$'), false)) FROM m) AS malformed_ids,
  (SELECT {_BLANK('subject')} FROM m) AS blank_subjects, (SELECT {_BLANK('predicate')} FROM m) AS blank_predicates, (SELECT {_BLANK('object')} FROM m) AS blank_objects)
SELECT *, units_without_record + records_without_unit + doubled_mentions + malformed_ids + blank_subjects + blank_predicates + blank_objects = 0 AS passed FROM x""")
def audit_raw(spark: SparkSession, d: str) -> DataFrame:
    return audit.audit_raw(table(spark, d, "semantic_units"), table(spark, d, "raw_svo"))


@query()
def raw_quality(spark: SparkSession, d: str) -> DataFrame:
    return audit.raw_quality(table(spark, d, "raw_svo"), table(spark, d, "semantic_units"))


@query()
def audit_raw_release(spark: SparkSession, d: str) -> DataFrame:
    return audit.audit_raw_release(table(spark, d, "semantic_units"), table(spark, d, "raw_svo"))


@query()
def audit_dictionary_release(spark: SparkSession, d: str) -> DataFrame:
    return audit.audit_dictionary_release(table(spark, d, "entity"), table(spark, d, "relation_type"), table(spark, d, "raw_svo"))


@query()
def audit_graph_release(spark: SparkSession, d: str) -> DataFrame:
    t = [table(spark, d, n) for n in ("relation", "evidence", "entity", "relation_type", "semantic_units", "source_document", "raw_svo")]
    return audit.audit_graph_release(*t)


@query(f"""WITH {_ROWS}, x AS (SELECT
  (SELECT count(*) FROM ent WHERE entity_id <> {stable_id_sql('entity', 'canonical_name')}) AS wrong_ids,
  (SELECT count(*) FROM (SELECT canonical_name FROM ent WHERE canonical_name IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS doubled_names,
  (SELECT count(*) FROM ent WHERE coalesce(entity_type, '') NOT IN ('ORGANIZATION','PERSON','LEGAL_INSTRUMENT','CONCEPT','OTHER')) AS unknown_types,
  (SELECT count(*) FROM ent WHERE NOT coalesce(aliases[1].name = canonical_name, false)) AS not_led_by_canonical,
  (SELECT count(*) FROM ent WHERE coalesce(mention_count, 0) < 1) AS not_mentioned,
  (SELECT count(*) FROM (SELECT name FROM al GROUP BY name HAVING count(DISTINCT id) > 1)) AS alias_conflicts)
SELECT *, wrong_ids + doubled_names + unknown_types + not_led_by_canonical + not_mentioned + alias_conflicts = 0 AS passed FROM x""")
def audit_dictionary(spark: SparkSession, d: str) -> DataFrame:
    return audit.audit_dictionary(table(spark, d, "entity"))


@query(f"""WITH {_REL}, e AS (SELECT DISTINCT relation_mention_id, relation_id FROM evidence), n AS (SELECT relation_id, count(*) AS n FROM e GROUP BY 1), x AS (SELECT
  (SELECT count(*) FROM rel WHERE source_entity_id NOT IN (SELECT entity_id FROM entity)) AS source_orphans,
  (SELECT count(*) FROM rel WHERE target_entity_id NOT IN (SELECT entity_id FROM entity)) AS target_orphans,
  (SELECT count(*) FROM rel WHERE relation_type_id NOT IN (SELECT relation_type_id FROM relation_type)) AS type_orphans,
  (SELECT count(*) FROM e WHERE relation_id NOT IN (SELECT relation_id FROM rel)) AS evidence_orphans,
  (SELECT count(*) FROM rel LEFT JOIN n USING (relation_id) WHERE evidence_count IS DISTINCT FROM coalesce(n, 0)) AS wrong_counts,
  (SELECT count(*) FROM (SELECT relation_mention_id FROM e WHERE relation_mention_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS doubled_mentions)
SELECT *, source_orphans + target_orphans + type_orphans + evidence_orphans + wrong_counts + doubled_mentions = 0 AS passed FROM x""")
def audit_graph(spark: SparkSession, d: str) -> DataFrame:
    return audit.audit_graph(table(spark, d, "relation"), table(spark, d, "evidence"), table(spark, d, "entity"), table(spark, d, "relation_type"))


# -- retrieval and paths ----------------------------------------------------------------------------


def _unit_texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "semantic_units").groupBy("semantic_unit_id").agg(F.min("unit_text").alias("unit_text"))


def _questions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text").distinct()


def _bm25_sql(docs: str) -> str:
    return f"""WITH d AS (SELECT doc, w, len(w) AS len FROM (SELECT doc, regexp_extract_all(lower(t), '[0-9A-Za-z가-힣]+') AS w FROM ({docs}) WHERE t IS NOT NULL)),
st AS (SELECT count(*)::DOUBLE AS n, avg(len) AS mean FROM d),
q AS (SELECT DISTINCT item_id AS query_id, unnest(regexp_extract_all(lower(text), '[0-9A-Za-z가-힣]+')) AS term FROM benchmark),
tf AS (SELECT term, doc, len, count(*)::DOUBLE AS tf FROM (SELECT doc, len, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, count(*)::DOUBLE AS df FROM tf GROUP BY term),
s AS (SELECT query_id, doc, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))), 6) AS score FROM tf JOIN df USING (term) JOIN q USING (term), st GROUP BY query_id, doc)
SELECT query_id, doc, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc) AS rank FROM s) WHERE rank <= {TOP}"""


@query(_bm25_sql("SELECT semantic_unit_id AS doc, min(unit_text) AS t FROM semantic_units GROUP BY 1"))
def keyword_rank(spark: SparkSession, d: str) -> DataFrame:
    """Best units of every test item by BM25."""
    return retrieval.bm25(_unit_texts(spark, d), "semantic_unit_id", "unit_text", _questions(spark, d), TOP).select("query_id", "doc", "rank")


_KNN = f"""SELECT query_id, doc, rank FROM (SELECT q.vec_id AS query_id, v.vec_id AS doc, row_number() OVER (PARTITION BY q.vec_id
  ORDER BY round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 9) DESC, v.vec_id) AS rank FROM embeddings v, embeddings q WHERE q.vec_id % 50 = 0) WHERE rank <= {TOP}"""


def _knn(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings").select("vec_id", "embedding")
    return retrieval.nearest(v, "vec_id", "embedding", v.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id"), TOP)


@query(_KNN)
def vector_knn(spark: SparkSession, d: str) -> DataFrame:
    """Nearest vectors of every vector whose id is divisible by 50."""
    return _knn(spark, d).select("query_id", "doc", "rank")


_KW_DOCS = _bm25_sql("SELECT doc_id AS doc, text AS t FROM documents")


@query(f"""WITH k AS ({_KW_DOCS}), v AS ({_KNN}), f AS (SELECT query_id, doc, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score, list(label ORDER BY i) AS matched_by
  FROM (SELECT *, 0 AS i, 'keyword' AS label FROM k UNION ALL SELECT *, 1, 'vector' FROM v) GROUP BY query_id, doc)
SELECT query_id, doc, matched_by, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc) AS rank FROM f) WHERE rank <= {TOP}""")
def rrf_hybrid(spark: SparkSession, d: str) -> DataFrame:
    """Keyword ranks of documents and ranks of vectors fused by query number and id."""
    kw = retrieval.bm25(table(spark, d, "documents"), "doc_id", "text", _questions(spark, d), TOP)
    return retrieval.fuse({"keyword": kw, "vector": _knn(spark, d)}, TOP).select("query_id", "doc", "matched_by", "rank")


@query(f"""WITH {_ENT}, n AS (SELECT DISTINCT entity_id AS doc, lower(n) AS name FROM (SELECT entity_id, canonical_name AS n FROM ent UNION ALL SELECT entity_id, unnest(aliases).name FROM ent) WHERE n IS NOT NULL),
q AS (SELECT DISTINCT item_id AS query_id, text FROM benchmark UNION ALL SELECT 0, '{QUESTION}'),
t AS (SELECT query_id, unnest(list_transform({_RETRIEVAL_TERMS}, lambda w: lower(w))) AS term FROM q),
s AS (SELECT query_id, doc, name, {retrieval.INSIDE} + CASE WHEN name = term THEN {retrieval.EQUAL} ELSE 0 END AS s FROM n JOIN t ON contains(name, term)
  UNION ALL SELECT query_id, doc, name, {retrieval.WHOLE} FROM n JOIN q ON lower(text) = name),
m AS (SELECT query_id, doc, max(s)::DOUBLE AS score FROM (SELECT query_id, doc, name, sum(s) AS s FROM s GROUP BY ALL) GROUP BY query_id, doc)
SELECT query_id, doc, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc) AS rank FROM m) WHERE rank <= {TOP}""")
def name_search(spark: SparkSession, d: str) -> DataFrame:
    """Entities whose names hold terms of the test items."""
    e = retrieval.entity_names(_entity(spark, d))
    q = _questions(spark, d).unionByName(spark.createDataFrame([(0, QUESTION)], "query_id long, text string"))
    return retrieval.keyword_names(e, "entity_id", "name", q, TOP)


_NEIGH = f"""{_EDGES}, f AS (SELECT DISTINCT ref_id AS entity_id FROM entity_reference),
inc AS (SELECT f.entity_id AS frontier_id, e.* FROM edges e JOIN f ON f.entity_id = e.source_entity_id UNION ALL
  SELECT f.entity_id, e.* FROM edges e JOIN f ON f.entity_id = e.target_entity_id WHERE e.source_entity_id <> e.target_entity_id),
nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY frontier_id ORDER BY evidence_count DESC, relation_id) AS neighbor_rank FROM inc) WHERE neighbor_rank <= {PER_ENTITY})"""


@query(f"WITH {_NEIGH} SELECT frontier_id, relation_id, source_entity_id, target_entity_id, relation_type_name, evidence_count, neighbor_rank FROM nb")
def neighbors_bounded(spark: SparkSession, d: str) -> DataFrame:
    """Best edges around every reference entity."""
    return paths.neighbors(_seeds(spark, d), _edges(spark, d), PER_ENTITY).select(
        "frontier_id", "relation_id", "source_entity_id", "target_entity_id", "relation_type_name", "evidence_count", "neighbor_rank")


@query(f"""WITH {_NEIGH} SELECT relation_id, min(neighbor_rank) AS neighbor_rank, any_value(evidence_count) AS evidence_count FROM nb GROUP BY relation_id
ORDER BY any_value(evidence_count) DESC, relation_id LIMIT {paths.MAX_EDGES}""")
def expand_bounded(spark: SparkSession, d: str) -> DataFrame:
    return paths.expand(_seeds(spark, d), _edges(spark, d), PER_ENTITY, paths.MAX_EDGES).select("relation_id", "neighbor_rank", "evidence_count")


_STEP = """SELECT frontier_id AS cur, CASE WHEN source_entity_id = frontier_id THEN target_entity_id ELSE source_entity_id END AS other, relation_id FROM"""


@query(f"""WITH {_NEIGH}, a AS ({_STEP} nb), f2 AS (SELECT DISTINCT other AS entity_id FROM a),
inc2 AS (SELECT f2.entity_id AS frontier_id, e.* FROM edges e JOIN f2 ON f2.entity_id = e.source_entity_id UNION ALL
  SELECT f2.entity_id, e.* FROM edges e JOIN f2 ON f2.entity_id = e.target_entity_id WHERE e.source_entity_id <> e.target_entity_id),
b AS ({_STEP} (SELECT *, row_number() OVER (PARTITION BY frontier_id ORDER BY evidence_count DESC, relation_id) AS rn FROM inc2) WHERE rn <= {PER_ENTITY})
SELECT a.cur AS start_id, a.other AS middle_id, b.other AS end_id, a.relation_id AS first_relation, b.relation_id AS second_relation
FROM a JOIN b ON a.other = b.cur WHERE a.cur <> a.other AND b.other <> b.cur AND b.other <> a.cur""")
def two_hop_paths(spark: SparkSession, d: str) -> DataFrame:
    """Simple two-hop paths from the reference entities over the best edges of each entity on the way."""
    edges = _edges(spark, d)

    def steps(frontier: DataFrame) -> DataFrame:
        other = F.when(F.col("source_entity_id") == F.col("frontier_id"), F.col("target_entity_id")).otherwise(F.col("source_entity_id"))
        return paths.neighbors(frontier, edges, PER_ENTITY).select(F.col("frontier_id").alias("cur"), other.alias("other"), "relation_id")

    a = steps(_seeds(spark, d)).select(F.col("cur").alias("start_id"), F.col("other").alias("middle_id"), F.col("relation_id").alias("first_relation"))
    b = steps(a.select(F.col("middle_id").alias("entity_id"))).select(F.col("cur").alias("middle_id"), F.col("other").alias("end_id"), F.col("relation_id").alias("second_relation"))
    return a.join(b, "middle_id").filter("start_id <> middle_id AND end_id <> middle_id AND end_id <> start_id").select("start_id", "middle_id", "end_id", "first_relation", "second_relation")


@query(f"""WITH e AS (SELECT relation_id, relation_mention_id, any_value(semantic_unit_id) AS semantic_unit_id FROM evidence GROUP BY ALL),
u AS (SELECT semantic_unit_id, min(ROW(document_id, source_ref)) AS x FROM semantic_units GROUP BY 1),
dd AS (SELECT document_id, min(document_title) AS document_title FROM source_document GROUP BY 1),
j AS (SELECT e.relation_id, e.relation_mention_id, s.document_id, dd.document_title, concat_ws('|', s.source_ref.article, coalesce(s.source_ref.paragraph::VARCHAR, ''), array_to_string(s.source_ref.item_path, '/')) AS ref_text
  FROM e JOIN (SELECT semantic_unit_id, min(document_id) AS document_id, min(source_ref) AS source_ref FROM semantic_units GROUP BY 1) s USING (semantic_unit_id) JOIN dd ON dd.document_id = s.document_id
  WHERE e.relation_id IN (SELECT relation_id FROM relation)),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY relation_id, document_id ORDER BY ref_text, relation_mention_id) AS dn FROM j) WHERE dn = 1)
SELECT relation_id, relation_mention_id, document_id, evidence_rank FROM (SELECT *, row_number() OVER (PARTITION BY relation_id ORDER BY document_title NULLS FIRST, ref_text, relation_mention_id) AS evidence_rank FROM f) WHERE evidence_rank <= 3""")
def edge_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Up to three pieces of evidence of every relation, one per document."""
    a = paths.attach_evidence(table(spark, d, "relation"), table(spark, d, "evidence"), table(spark, d, "semantic_units"), table(spark, d, "source_document"), 3)
    return a.select("relation_id", "relation_mention_id", "document_id", "evidence_rank")


#: Prepared search tables by application and folder: they outlive one question.
_PREPARED: dict = {}


def search_tables(spark: SparkSession, d: str):
    """The tables of ``d`` prepared for searching, once a session."""
    from sparkloom.pipeline import GraphStore, prepare

    key = (spark.sparkContext.applicationId, d)
    if key not in _PREPARED:
        _PREPARED[key] = prepare(GraphStore(_entity(spark, d), _edges(spark, d), table(spark, d, "evidence"), table(spark, d, "semantic_units"), table(spark, d, "source_document")))
    return _PREPARED[key]


@query(f"""WITH {_EDGES},
x AS (SELECT source_entity_id AS id, relation_id FROM edges UNION SELECT target_entity_id, relation_id FROM edges)
SELECT 'best' AS part, sum(least(n, 200))::BIGINT AS n_rows FROM (SELECT id, count(*) AS n FROM x GROUP BY 1)
UNION ALL SELECT 'edges', count(*) FROM edges
UNION ALL SELECT 'names', count(*) FROM (SELECT DISTINCT entity_id, lower(n) FROM (SELECT entity_id, canonical_name AS n FROM entity UNION ALL SELECT entity_id, unnest(aliases).name FROM entity) WHERE n IS NOT NULL)
UNION ALL SELECT 'units', count(DISTINCT semantic_unit_id) FROM semantic_units""")
def search_index(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the tables prepared for searching."""
    index = search_tables(spark, d)
    parts = [("best", index.best), ("edges", index.edges), ("names", index.names), ("units", index.units)]
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("part"), "n_rows") for name, df in parts])


def run_search(spark: SparkSession, d: str, question: str, bounds: paths.SearchBounds | None = None) -> dict[str, DataFrame]:
    """The whole search of one question: candidates, paths, evidence, ranking."""
    from sparkloom.pipeline import search

    return search(spark, search_tables(spark, d), question, bounds or paths.SearchBounds())


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS number FROM orders")
def order_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Orders numbered by date without a single-task window."""
    return numbered(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], "number").select("o_orderkey", "number")


@query()
def search_paths(spark: SparkSession, d: str) -> DataFrame:
    """Ranked paths of one question: three hops, beam, late evidence, rerank."""
    return run_search(spark, d, QUESTION)["paths"].select("rank", "entity_names", "relation_ids", "hops", "score", "document_ids")


@query()
def search_payload(spark: SparkSession, d: str) -> DataFrame:
    """Nodes to draw for the same question."""
    r = run_search(spark, d, QUESTION)
    return paths.graph_payload(r["paths"], r["candidates"])[0]


def _quality_sql(n: str) -> str:
    t = f"trim({n}, ' ')"
    poor = ", ".join(repr(x) for x in paths.POOR_NAMES)
    return f"(length({t}) BETWEEN 2 AND 60 AND {t} NOT IN ({poor}) AND NOT contains({t}, '\ufffd') AND NOT regexp_matches({t}, '^[0-9]+$') AND NOT regexp_matches({t}, '^제?[0-9]+(?:조|항|호|목)'))"


_PAIR = "list_transform(l_docs, lambda a: [a, list_filter(r_docs, lambda b: b <> a)[1]])"


@query(f"""WITH {_EDGES}, ev AS (SELECT DISTINCT relation_id, document_id FROM evidence WHERE relation_id IS NOT NULL AND document_id IS NOT NULL),
f AS (SELECT relation_id, list_sort(list(document_id)) AS docs FROM ev GROUP BY 1),
x AS (SELECT relation_id, relation_type_name, evidence_count, docs, source_entity_id AS mid, source_name AS mid_name, target_entity_id AS far, target_name AS far_name FROM edges JOIN f USING (relation_id)
  UNION ALL SELECT relation_id, relation_type_name, evidence_count, docs, target_entity_id, target_name, source_entity_id, source_name FROM edges JOIN f USING (relation_id)),
g AS (SELECT *, count(*) OVER (PARTITION BY mid) AS degree, row_number() OVER (PARTITION BY mid ORDER BY evidence_count DESC, relation_id, far) AS rn FROM x
  WHERE {_quality_sql('mid_name')} AND mid_name NOT IN ({', '.join(repr(x) for x in paths.POOR_MIDDLES)})),
r AS (SELECT * FROM g WHERE degree BETWEEN 2 AND 80 AND rn <= 30 AND {_quality_sql('far_name')}),
p AS (SELECT l.mid, l.mid_name, l.far AS l_far, l.far_name AS l_name, l.relation_id AS l_rel, l.docs AS l_docs, l.evidence_count AS l_n, l.relation_type_name AS l_type, l.degree,
  r.far AS r_far, r.far_name AS r_name, r.relation_id AS r_rel, r.docs AS r_docs, r.evidence_count AS r_n, r.relation_type_name AS r_type
  FROM r l JOIN r r ON l.mid = r.mid AND l.rn < r.rn AND l.far <> r.far),
o AS (SELECT *, list_filter({_PAIR}, lambda x: x[2] IS NOT NULL)[1] AS two FROM p)
SELECT mid AS middle_id, mid_name AS middle_name, l_far AS start_id, l_name AS start_name, r_far AS end_id, r_name AS end_name, l_rel AS left_relation_id, r_rel AS right_relation_id,
  two[1] AS doc_a, two[2] AS doc_b, round(2.0 + ln(1 + l_n) + ln(1 + r_n) + len(list_distinct([l_name, mid_name, r_name, l_type, r_type])) * 0.15 - ln(1 + degree) * 0.3, 6) AS score FROM o WHERE two IS NOT NULL""")
def cross_document_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of edges through a middle entity with evidence in different documents."""
    ev = table(spark, d, "evidence").select("relation_id", "document_id")
    return paths.cross_document_candidates(_edges(spark, d), ev)


# -- sinks ------------------------------------------------------------------------------------------


@query("""SELECT 'document' AS table_name, count(DISTINCT document_id)::BIGINT AS n FROM source_document UNION ALL SELECT 'semantic_unit', count(DISTINCT semantic_unit_id) FROM semantic_units
UNION ALL SELECT 'entity', count(DISTINCT entity_id) FROM entity UNION ALL SELECT 'relation', count(DISTINCT relation_id) FROM relation UNION ALL SELECT 'relation_evidence', count(DISTINCT relation_mention_id) FROM evidence""")
def rdb_export_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the relational load files, one per key."""
    out = None
    for name, source, key in (("document", "source_document", "document_id"), ("semantic_unit", "semantic_units", "semantic_unit_id"), ("entity", "entity", "entity_id"),
                              ("relation", "relation", "relation_id"), ("relation_evidence", "evidence", "relation_mention_id")):
        part = one_per_key(table(spark, d, source), key, [key]).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query(f"""WITH {_ENT} SELECT entity_id, row_number() OVER (ORDER BY canonical_name, entity_id) AS node_number FROM ent""")
def vertex_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Consecutive vertex numbers of the property-graph files."""
    return numbered(_entity(spark, d).select("entity_id", "canonical_name"), ["canonical_name", "entity_id"]).select("entity_id", "node_number")


@query(f"""WITH {_ENT} SELECT entity_id AS key, 0 AS part, json_object('index', json_object('_index', 'entities', '_id', entity_id))::VARCHAR AS line FROM ent
UNION ALL SELECT entity_id, 1, json_object('canonical_name', canonical_name, 'entity_id', entity_id, 'entity_type', entity_type, 'mention_count', mention_count)::VARCHAR FROM ent""")
def bulk_ndjson_lines(spark: SparkSession, d: str) -> DataFrame:
    e = _entity(spark, d).select("entity_id", "canonical_name", "entity_type", "mention_count")
    return bulk_lines(e, "entity_id", "entities")
