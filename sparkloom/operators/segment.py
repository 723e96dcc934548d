"""Structured text cut into addressable units: articles, paragraphs, leaf items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkloom.functions.ids import stable_id
from sparkloom.functions.text import trim_all

# Headings, markers and metadata keys of the documents.
ARTICLE = r"(?U)\A#{1,6}\s+(제\s*\d+(?:\s*의\s*\d+)?\s*조(?:\s*의\s*\d+)?)\s*(.*)\z"
SUPPLEMENT = r"(?U)\A#{1,6}\s+부칙(?:\s|\z|\()"
PARAGRAPH = r"(?U)\A\*\*([①-⑳])\*\*\s*(.*)\z"
ITEM = r"(?U)\A([ \t]*)(\d+|[가나다라마바사아자차카타파하])\\?\.\s+(.*)\z"
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"
TITLE_KEY, ID_KEYS, SOURCE_KEY = "제목", ["법령MST", "법령ID"], "출처"
LINE_BREAK = "\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085  ]"


def text_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, line_no, line) of every document. Whole texts are shuffled by document, before they are cut, so that all
    later windows need no shuffle; repeated rows of a document count once. A trailing line break makes no further
    line; null and empty texts have no lines."""
    one = docs.filter(F.col(key).isNotNull() & F.col(text).isNotNull() & (F.col(text) != "")).groupBy(F.col(key).alias("doc")).agg(F.min(text).alias("_text"))
    body = F.regexp_replace("_text", f"(?:{LINE_BREAK})\\z", "")
    return one.select("doc", F.posexplode(F.split(body, LINE_BREAK)).alias("line_no", "line"))


def _meta(found: Column, name: str) -> Column:
    return F.try_element_at(F.filter(found, lambda x: x["k"] == name), F.lit(-1))["v"]


def front_matter(lines: DataFrame) -> DataFrame:
    """(doc, body_from, title, official_id, source): the block between --- lines at the start, of lines ``key: value``.

    Without a block the title is the first ``# `` heading. What is missing is null."""
    w = W.partitionBy("doc")
    opens = F.max(F.when(F.col("line_no") == 0, trim_all(F.col("line")) == "---")).over(w)
    close = F.min(F.when((F.col("line_no") > 0) & (trim_all(F.col("line")) == "---"), F.col("line_no"))).over(w)
    x = lines.withColumn("_close", F.when(opens, close))
    inside = (F.col("line_no") > 0) & (F.col("line_no") < F.col("_close")) & F.col("line").contains(":") & ~F.col("line").rlike(r"\A[ -]")
    pair = F.struct(
        "line_no", trim_all(F.split(F.col("line"), ":", 2)[0]).alias("k"),
        F.regexp_replace(trim_all(F.split(F.col("line"), ":", 2)[1]), r"""\A['"]+|['"]+\z""", "").alias("v"),
    )
    heading = F.when(F.col("_close").isNull() & F.col("line").startswith("# "), F.struct("line_no", trim_all(F.substr(F.col("line"), F.lit(3))).alias("t")))
    doc = x.groupBy("doc").agg(
        F.max("_close").alias("_close"), F.array_sort(F.collect_list(F.when(inside, pair))).alias("_m"), F.min(heading).alias("_h")
    )
    ident = F.coalesce(*[F.nullif(_meta(F.col("_m"), k), F.lit("")) for k in ID_KEYS])
    return doc.select(
        "doc", F.coalesce(F.col("_close") + 1, F.lit(0)).alias("body_from"),
        F.coalesce(_meta(F.col("_m"), TITLE_KEY), F.col("_h.t")).alias("title"), ident.alias("official_id"),
        F.nullif(_meta(F.col("_m"), SOURCE_KEY), F.lit("")).alias("source"),
    )


def document_identity(official_id: Column, source: Column, title: Column, path: Column) -> Column:
    """Official id with title, else the source, else path with title."""
    return F.coalesce(F.concat(F.lit("official:"), official_id, F.lit(":"), title), F.concat(F.lit("source:"), source), F.concat(F.lit("path:"), path, F.lit(":"), title))


def _joined(order: str, text: str) -> Column:
    """Non-blank lines, trimmed, joined in order."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), trim_all(F.col(text)).alias("t"))))
    return F.array_join(F.transform(F.filter(parts, lambda x: x["t"] != ""), lambda x: x["t"]), "\n")


def segment(docs: DataFrame, key: str, text: str, path: Column | None = None, fallback_title: Column | None = None) -> DataFrame:
    """Semantic units of structured documents.

    Columns: doc (the key), semantic_unit_id, document_id, document_title, source_path, source_ref, context_text,
    unit_text, unit_kind, governing_text, unit_seq (order within the document). Text before the first article and from
    the supplementary provisions on gives no unit; documents without articles give none. One shuffle, by document;
    every window lies within a document."""
    path = F.col(key).cast("string") if path is None else path
    fallback = F.col(key).cast("string") if fallback_title is None else fallback_title
    lines = text_lines(docs, key, text)
    doc = docs.filter(F.col(text).isNotNull()).groupBy(F.col(key).alias("doc")).agg(F.min(path).alias("source_path"), F.min(fallback).alias("_fallback"))
    meta = front_matter(lines).join(doc, "doc").withColumn("document_title", F.coalesce("title", "_fallback"))
    ident = document_identity(F.col("official_id"), F.col("source"), F.col("document_title"), F.col("source_path"))
    meta = meta.select("doc", "body_from", "document_title", "source_path", stable_id("document", ident).alias("document_id"))

    w = W.partitionBy("doc")
    run = w.orderBy("line_no")
    x = lines.join(meta.select("doc", "body_from"), "doc").filter(F.col("line_no") >= F.col("body_from"))
    x = x.withColumn("_end", F.min(F.when(F.col("line").rlike(SUPPLEMENT), F.col("line_no"))).over(w)).filter(F.col("_end").isNull() | (F.col("line_no") < F.col("_end")))
    is_article = F.col("line").rlike(ARTICLE)
    x = x.withColumn("art", F.sum(is_article.cast("int")).over(run)).filter(F.col("art") > 0)
    heads = F.max(F.when(is_article, F.struct(F.regexp_replace(F.regexp_extract("line", ARTICLE, 1), r"(?U)\s+", "").alias("article"), trim_all(F.col("line")).alias("heading")))).over(W.partitionBy("doc", "art"))
    x = x.withColumn("_head", heads).filter(~F.col("line").startswith("#"))
    in_art = W.partitionBy("doc", "art").orderBy("line_no")
    is_par = F.col("line").rlike(PARAGRAPH)
    x = x.withColumn("par", F.sum(is_par.cast("int")).over(in_art))
    x = x.withColumn("_num", F.max(F.when(is_par, F.instr(F.lit(CIRCLED), F.regexp_extract("line", PARAGRAPH, 1)))).over(W.partitionBy("doc", "art", "par")))
    x = x.withColumn("_item", ~is_par & F.col("line").rlike(ITEM))
    x = x.withColumn("it", F.sum(F.col("_item").cast("int")).over(W.partitionBy("doc", "art", "par").orderBy("line_no")))
    body = F.when(is_par, F.regexp_extract("line", PARAGRAPH, 2)).when(F.col("_item"), F.regexp_extract("line", ITEM, 3)).otherwise(F.col("line"))
    x = x.withColumn("_t", body)
    spaces = F.regexp_extract("line", ITEM, 1)
    items = x.groupBy("doc", "art", "par", "it").agg(
        F.max("_head").alias("_head"), F.max("_num").alias("paragraph"), F.min("line_no").alias("unit_seq"), _joined("line_no", "_t").alias("t"),
        F.max(F.when(F.col("_item"), F.struct(F.length(F.replace(spaces, F.lit("\t"), F.lit("  "))).alias("indent"), F.regexp_extract("line", ITEM, 2).alias("marker")))).alias("_i"),
    )
    # a paragraph's items as one list; going through it once keeps the open ancestors as a stack, every one less indented than all after it
    node = "array<struct<it:bigint,indent:int,marker:string,t:string>>"
    rows = F.array_sort(F.collect_list(F.struct("it", "_head", "paragraph", "unit_seq", "t", "_i")))
    listed = items.groupBy("doc", "art", "par").agg(rows.alias("_rows"))
    none = F.array().cast(node)
    state = F.struct(none.alias("open"), F.array().cast(f"array<{node}>").alias("ups"))

    def step(acc: Column, n: Column) -> Column:
        own = F.struct(n["it"].alias("it"), n["_i"]["indent"].alias("indent"), n["_i"]["marker"].alias("marker"), n["t"].alias("t"))
        up = F.when(n["it"] > 0, F.filter(acc["open"], lambda o: o["indent"] < n["_i"]["indent"])).otherwise(none)
        opened = F.when(n["it"] > 0, F.concat(up, F.array(own))).otherwise(acc["open"])
        return F.struct(opened.cast(node).alias("open"), F.concat(acc["ups"], F.array(up.cast(node))).cast(f"array<{node}>").alias("ups"))

    listed = listed.withColumn("_ups", F.aggregate("_rows", state, step)["ups"])
    y = listed.select("doc", "art", "par", "_rows", "_ups", F.posexplode("_rows").alias("_at", "_r")).select(
        "doc", "art", "par", "_r.*", F.get("_ups", F.col("_at")).alias("_up"), F.get("_rows", F.col("_at") + 1)["_i"]["indent"].alias("_next"),
        F.element_at("_rows", -1)["it"].alias("n_items"), F.when(F.col("_rows")[0]["it"] == 0, F.col("_rows")[0]["t"]).alias("_intro"))
    leaf = (F.col("it") > 0) & (F.col("_next").isNull() | (F.col("_next") <= F.col("_i.indent"))) & (F.col("t") != "")
    alone = (F.col("n_items") == 0) & (F.col("t") != "")
    y = y.filter(leaf | alone).withColumn("_up", F.when(leaf, F.col("_up")).otherwise(none))
    up_text = F.filter(F.transform("_up", lambda n: n["t"]), lambda t: t != "")
    intro = F.nullif(F.coalesce("_intro", F.lit("")), F.lit(""))
    governing = F.when(leaf, F.concat_ws("\n", intro, F.nullif(F.array_join(up_text, "\n"), F.lit("")))).otherwise("")
    numbered = F.concat(F.col("_head.article"), F.lit(" 제"), F.col("paragraph").cast("string"), F.lit("항"))
    item_path = F.when(leaf, F.concat(F.transform("_up", lambda n: n["marker"]), F.array(F.col("_i.marker")))).otherwise(F.array().cast("array<string>"))
    kind = F.when(leaf, "terminal_item").otherwise("paragraph")
    u = y.join(meta, "doc").select(
        "doc", "document_id", "document_title", "source_path",
        F.struct(F.col("_head.article").alias("article"), F.col("paragraph").cast("int").alias("paragraph"), item_path.alias("item_path")).alias("source_ref"),
        F.concat_ws("\n", F.col("_head.heading"), numbered, F.when(leaf, F.nullif(governing, F.lit("")))).alias("context_text"),
        F.col("t").alias("unit_text"), kind.alias("unit_kind"), governing.alias("governing_text"), F.col("unit_seq").cast("long").alias("unit_seq"),
    )
    uid = stable_id(
        "semantic_unit", F.col("document_id"), F.col("source_ref.article"), F.coalesce(F.col("source_ref.paragraph").cast("string"), F.lit("article_body")),
        F.array_join("source_ref.item_path", "/"), F.col("unit_kind"), F.col("unit_text"),
    )
    return u.withColumn("semantic_unit_id", uid)
