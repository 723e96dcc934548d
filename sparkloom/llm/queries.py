"""Queries of the training-data problems 2, 3, 4, 6, 7, 8, 9 and 10, and the SQL of those that SQL can express."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.canonical_map import look_up_values, map_to_list
from sparkloom.llm.format_dupes import canonical_key, copies, duplicate_ledger, with_single_relation
from sparkloom.llm.leaks import find_leaks
from sparkloom.llm.lookalikes import look_matches, match_vocabulary, table_form
from sparkloom.llm.split_text import LIMIT, OVERLAP, split_texts
from sparkloom.llm.stuffing import stuffed_pages
from sparkloom.llm.term_counts import term_counts
from sparkloom.llm.tokenize import encode
from sparkloom.operators.bloom import with_membership
from sparkloom.operators.skew import hot_salts, salted_join
from sparkloom.runtime import materialise, table


# -- 2: frequency of every distinct value ---------------------------------------------------------


def p2_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions and units of every distinct predicate and subject."""
    terms = {"predicate": F.col("relations.predicate"), "subject": F.col("relations.subject")}
    return term_counts(table(spark, sf_dir, "raw_svo"), "semantic_unit_id", terms)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms too rare or too common."""
    return p2_term_counts(spark, sf_dir).filter(F.col("mark").isNotNull()).select("field_name", "term", "mark")


_P2 = """units AS (SELECT semantic_unit_id, any_value(relations) AS relations FROM raw_svo GROUP BY 1),
m AS (SELECT semantic_unit_id, unnest(relations) AS r FROM units),
t AS (SELECT semantic_unit_id, 'predicate' AS field_name, r.predicate AS term FROM m
  UNION ALL SELECT semantic_unit_id, 'subject', r.subject FROM m),
c AS (SELECT field_name, term, count(*)::BIGINT AS n_mentions, count(DISTINCT semantic_unit_id)::BIGINT AS n_records
  FROM t WHERE term IS NOT NULL GROUP BY 1, 2),
x AS (SELECT *, CASE WHEN n_records < 3 THEN 'rare'
  WHEN n_records * 25 > (SELECT count(*) FROM units) THEN 'common' END AS mark FROM c)"""


# -- 3: visually identical text -------------------------------------------------------------------


def _mention_fields(spark: SparkSession, sf_dir: str, fields: list[str]) -> DataFrame:
    """(row_id, field_name, name) of the mentions in raw_svo; repeated rows are still there."""
    m = table(spark, sf_dir, "raw_svo").select(F.explode("relations").alias("r"))
    return m.select(
        F.col("r.relation_mention_id").alias("row_id"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"r.{f}").alias("name")) for f in fields])).alias("x"),
    ).select("row_id", "x.field_name", "x.name").filter(F.col("name").isNotNull())


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "entity").select("entity_id", F.col("canonical_name").alias("name"), "mention_count")
        .filter(F.col("name").isNotNull()).groupBy("entity_id", "name").agg(F.max("mention_count").alias("mention_count"))
    )


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, n_vocab, n_typed): every distinct text that is an entity's name, a subject or an object."""
    vocab = _entities(spark, sf_dir).select(
        "name", F.greatest(F.coalesce("mention_count", F.lit(0)), F.lit(1)).alias("n_vocab"), F.lit(0).cast("long").alias("n_typed"))
    zero, one = F.lit(0).cast("long").alias("n_vocab"), F.lit(1).cast("long").alias("n_typed")
    typed = _mention_fields(spark, sf_dir, ["subject", "object"]).select("name", zero, one)
    names = vocab.unionByName(typed).groupBy("name").agg(F.max("n_vocab").alias("n_vocab"), F.sum("n_typed").alias("n_typed"))
    return materialise(names, "names")  # read several times


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities whose names look the same, and fields that look like an entity's name but are not equal to it.

    Only the few mentions whose text may be one of the unequal names (by a Bloom filter of these) are shuffled."""
    names = _names(spark, sf_dir)
    ents = _entities(spark, sf_dir).select("entity_id", "name")
    to_entity = look_matches(names).select("name", "spelling").join(ents.select(F.col("name").alias("spelling"), "entity_id"), "spelling")
    to_entity = materialise(to_entity, "look-alike-entities")
    pairs = (
        ents.withColumnRenamed("entity_id", "row_id").join(to_entity, "name")
        .filter(F.col("row_id") < F.col("entity_id"))
        .select(F.lit("canonical_name").alias("field_name"), "row_id", "entity_id")
    )
    unequal = to_entity.filter(F.col("name") != F.col("spelling")).select("name", "entity_id")
    counts = names.join(unequal.select("name").distinct(), "name", "left_semi")
    typed = with_membership(_mention_fields(spark, sf_dir, ["subject", "object"]), ["name"], unequal, ["name"], unequal.count(), "_maybe")
    fields = salted_join(typed.filter("_maybe").drop("_maybe"), unequal, ["name"], F.col("row_id"), hot=hot_salts(counts, ["name"], rows=F.col("n_typed")))
    return pairs.unionByName(fields.select("field_name", "row_id", "entity_id")).distinct()


def p3_consistent_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct stored name with its one consistent form."""
    return match_vocabulary(_names(spark, sf_dir)).groupBy("name").agg(
        F.min("canonical").alias("canonical"), F.count("spelling").alias("n_spellings")
    )


def _seen(column: str) -> str:
    """SQL for the table form of a column: the characters whose form is one other character are translated, invisible ones and
    white space by class, and marks composed and put in order."""
    one = [(c, f) for o in range(0x80, 0x30000) if not 0xD800 <= o < 0xE000 and not (c := chr(o)).isspace() and len(f := table_form(c)) == 1 and f != unicodedata.normalize("NFC", c)]
    gone = "".join(c for o in range(0x10000) if not 0xD800 <= o < 0xE000 and not (c := chr(o)).isspace() and table_form(c) == "" and o)
    gone += "".join(chr(o) for o in (*range(0xE0001, 0xE0080), *range(0xE0100, 0xE01F0)))
    blank = "".join(chr(o) for o in range(0x3001) if chr(o).isspace() and o != 0x20)
    other, plain = "".join(c for c, _ in one), "".join(f for _, f in one)
    return f"nfc_normalize(translate(nfc_normalize(translate(translate({column}, '{gone}', ''), '{blank}', '{' ' * len(blank)}')), '{other.replace(chr(39), chr(39) * 2)}', '{plain.replace(chr(39), chr(39) * 2)}'))"


def _p3_sql() -> str:
    return f"""WITH e AS (SELECT DISTINCT entity_id, canonical_name AS name, {_seen('canonical_name')} AS form FROM entity WHERE canonical_name IS NOT NULL),
m AS (SELECT r.relation_mention_id AS row_id, r.subject AS s, r.object AS o FROM (SELECT unnest(relations) AS r FROM raw_svo)),
f AS (SELECT row_id, 'subject' AS field_name, s AS name FROM m UNION ALL SELECT row_id, 'object', o FROM m),
n AS (SELECT name, {_seen('name')} AS form FROM (SELECT DISTINCT name FROM f WHERE name IS NOT NULL))
SELECT 'canonical_name' AS field_name, a.entity_id AS row_id, b.entity_id FROM e a JOIN e b ON a.form = b.form AND a.entity_id < b.entity_id
UNION SELECT f.field_name, f.row_id, e.entity_id FROM f JOIN n ON f.name = n.name JOIN e ON n.form = e.form AND n.name <> e.name"""


# -- 4: freely typed values and the list ----------------------------------------------------------


def _lists(spark: SparkSession, sf_dir: str) -> list[tuple[list[str], DataFrame, str]]:
    verbs = table(spark, sf_dir, "relation_type").select(F.col("relation_type_id").alias("ref_id"), "canonical_name").distinct()
    names = table(spark, sf_dir, "entity_reference").select("ref_id", "canonical_name").distinct()
    return [(["predicate"], verbs, "verb"), (["subject", "object"], names, "name")]


def _typed_values(spark: SparkSession, sf_dir: str, fields: list[str], entries: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(mentions of values that are not themselves entries, the distinct such values with their numbers, entries with their
    frequency among the values)."""
    values = _mention_fields(spark, sf_dir, fields)
    used = materialise(values.groupBy("name").agg(F.count(F.lit(1)).alias("n")), "value-counts")
    listed = entries.select(F.col("canonical_name").alias("name")).distinct()
    ranked = entries.join(used, entries["canonical_name"] == used["name"], "left").select("ref_id", "canonical_name", F.col("n").alias("frequency"))
    return values.join(listed, "name", "left_anti"), used.join(listed, "name", "left_anti"), ranked


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that are a misspelt or otherwise written form of a list entry."""
    parts = []
    for fields, entries, kind in _lists(spark, sf_dir):
        own, counts, ranked = _typed_values(spark, sf_dir, fields, entries)
        parts.append(map_to_list(own, "name", "row_id", ranked, kind, counts=counts))
    hit = reduce(DataFrame.unionByName, parts)
    return hit.select(F.col("row_id").alias("relation_mention_id"), "field_name", "ref_id").distinct()


def p4_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that mean no entry, with their number of mentions."""
    parts = []
    for fields, entries, kind in _lists(spark, sf_dir):
        own, counts, ranked = _typed_values(spark, sf_dir, fields, entries)
        n = own.distinct().groupBy("field_name", "name").agg(F.count(F.lit(1)).alias("n_mentions"))
        miss = look_up_values(counts, ranked, kind).filter(F.col("ref_id").isNull()).select("name")
        parts.append(n.join(miss, "name").select("field_name", "name", "n_mentions"))
    return reduce(DataFrame.unionByName, parts)


# -- 6: oversized items ---------------------------------------------------------------------------


def p6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered pieces of unit_text and context_text."""
    return split_texts(table(spark, sf_dir, "semantic_units"), "semantic_unit_id", ["unit_text", "context_text"], "updated_at")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that were cut."""
    return (
        p6_pieces(spark, sf_dir).filter((F.col("piece_no") == 2))
        .select(F.col("row_id").alias("semantic_unit_id"), "field_name").distinct()
    )


def p6_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pieces of every text must add up to: the whole text again (by its digest), each within the limit and beginning
    with the end of the one before. One text's pieces meet in one row."""
    p = p6_pieces(spark, sf_dir).groupBy("row_id", "field_name").agg(
        F.array_sort(F.collect_list(F.struct("piece_no", "n_pieces", "start_at", "piece"))).alias("p"))
    text = F.array_join(F.transform("p", lambda x, i: F.when(i == 0, x["piece"]).otherwise(F.substr(x["piece"], F.lit(OVERLAP + 1)))), "")
    joined = F.forall(F.transform("p", lambda x, i: F.when(i == 0, F.lit(True)).otherwise(F.startswith(x["piece"], F.right(F.get(F.col("p"), i - 1)["piece"], F.lit(OVERLAP))))), lambda ok: ok)
    counted = F.forall(F.transform("p", lambda x, i: (x["piece_no"] == i + 1) & (x["n_pieces"] == F.size("p")) & (F.length(x["piece"]) <= LIMIT)), lambda ok: ok)
    return p.select(F.col("row_id").alias("semantic_unit_id"), "field_name", F.length(text).cast("long").alias("n_chars"), F.md5(text).alias("digest"), (joined & counted).alias("sound"))


# -- 7: duplicates hidden by formatting -----------------------------------------------------------


def _ledger(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    slim = table(spark, sf_dir, "model_responses").select("response_id", "semantic_unit_id", "received_at", "response_text")
    r = with_single_relation(slim, "response_text", "r")
    keyed = r.select(
        "response_id", F.year("received_at").alias("batch"),
        canonical_key(F.col("semantic_unit_id"), [F.col("r.subject"), F.col("r.predicate"), F.col("r.object")]).alias("key"),
    )
    return duplicate_ledger(keyed, "key", "response_id", F.col("batch"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of a relation with the response that is kept."""
    return copies(*_ledger(spark, sf_dir))


def p7_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each relation once: its earliest response and its number of copies."""
    return _ledger(spark, sf_dir)[0].select(F.col("first_id").alias("keep_id"), "copies")


_P7 = r"""b AS (SELECT response_id, semantic_unit_id,
  regexp_replace(response_text, '\A\s*```[A-Za-z0-9_-]*\s*((?s:.*?))\s*```\s*\z', '\1') AS j FROM model_responses),
v AS (SELECT response_id, semantic_unit_id, CASE WHEN json_valid(j) THEN j END AS j FROM b),
o AS (SELECT * FROM v WHERE j IS NOT NULL AND json_array_length(j, '$.relations') = 1),
f AS (SELECT response_id, semantic_unit_id,
  regexp_replace(lower(json_extract_string(j, '$.relations[0].subject')), '[^\p{L}\p{N}]', '', 'g') AS s,
  regexp_replace(lower(json_extract_string(j, '$.relations[0].predicate')), '[^\p{L}\p{N}]', '', 'g') AS p,
  regexp_replace(lower(json_extract_string(j, '$.relations[0].object')), '[^\p{L}\p{N}]', '', 'g') AS o FROM o),
g AS (SELECT response_id, min(response_id) OVER w AS keep_id, count(*) OVER w AS copies FROM f
  WHERE s IS NOT NULL AND p IS NOT NULL AND o IS NOT NULL WINDOW w AS (PARTITION BY semantic_unit_id, s, p, o))"""


# -- 8: token ids ---------------------------------------------------------------------------------


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encode(table(spark, sf_dir, "documents"), "doc_id", "text")


# -- 9: leaked test items -------------------------------------------------------------------------


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the test items that leaked into them."""
    return find_leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text")


def p9_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaked items with the number of documents holding them."""
    return p9_found(spark, sf_dir).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_documents"))


_P9 = r"""SELECT DISTINCT d.doc_id, r.item_id FROM (
  SELECT doc_id, unnest(list_transform(range(1, length(t) - 58), lambda i: substring(t, i, 60))) AS g FROM (
    SELECT doc_id, regexp_replace(lower(text), '[^\p{L}\p{N}]', '', 'g') AS t FROM documents) WHERE length(t) >= 60) d
JOIN (SELECT item_id, unnest(list_transform(range(1, length(t) - 58), lambda i: substring(t, i, 60))) AS g FROM (
    SELECT item_id, regexp_replace(lower(text), '[^\p{L}\p{N}]', '', 'g') AS t FROM benchmark) WHERE length(t) >= 60) r
  ON d.g = r.g"""


# -- 10: keyword-stuffed pages --------------------------------------------------------------------


def p10_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of link, tag and menu words of every document."""
    return stuffed_pages(table(spark, sf_dir, "documents"), "doc_id", "text")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which more than half is not prose."""
    return p10_shares(spark, sf_dir).filter("stuffed").select("doc_id").distinct()


QUERIES = {
    "p2_found": p2_found,
    "p2_term_counts": p2_term_counts,
    "p3_found": p3_found,
    "p3_consistent_forms": p3_consistent_forms,
    "p4_found": p4_found,
    "p4_unmatched": p4_unmatched,
    "p6_found": p6_found,
    "p6_pieces": p6_pieces,
    "p6_restored": p6_restored,
    "p7_found": p7_found,
    "p7_ledger": p7_ledger,
    "p8_ids": p8_ids,
    "p9_found": p9_found,
    "p9_items": p9_items,
    "p10_found": p10_found,
    "p10_shares": p10_shares,
}
SQL = {
    "p2_found": f"WITH {_P2} SELECT field_name, term, mark FROM x WHERE mark IS NOT NULL",
    "p2_term_counts": f"WITH {_P2} SELECT * FROM x",
    "p3_found": _p3_sql(),
    "p6_found": f"""SELECT DISTINCT semantic_unit_id, f AS field_name FROM (
  SELECT semantic_unit_id, 'unit_text' AS f, unit_text AS t FROM semantic_units
  UNION ALL SELECT semantic_unit_id, 'context_text', context_text FROM semantic_units) WHERE length(t) > {LIMIT}""",
    "p6_restored": """WITH one AS (SELECT semantic_unit_id, max(ROW(updated_at, unit_text, context_text)) AS r FROM semantic_units WHERE semantic_unit_id IS NOT NULL GROUP BY 1),
t AS (SELECT semantic_unit_id, 'unit_text' AS field_name, r[2] AS t FROM one UNION ALL SELECT semantic_unit_id, 'context_text', r[3] FROM one)
SELECT semantic_unit_id, field_name, length(t)::BIGINT AS n_chars, md5(t) AS digest, true AS sound FROM t WHERE t IS NOT NULL""",
    "p7_found": f"WITH {_P7} SELECT keep_id, response_id AS copy_id FROM g WHERE response_id <> keep_id",
    "p9_found": _P9,
    "p9_items": f"SELECT item_id, count(*)::BIGINT AS n_documents FROM ({_P9}) GROUP BY item_id",
    "p7_ledger": f"WITH {_P7} SELECT keep_id, max(copies)::BIGINT AS copies FROM g GROUP BY keep_id",
}
