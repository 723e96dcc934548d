"""Sinks: JSON lines, relational CSV with its SQL, property-graph CSV, search-index bulk files, manifests."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkloom.runtime import full_path, materialise, path_exists, read_text, replace_path, write_text

#: Rows of one output file.
ROWS_PER_FILE = 1_000_000

# Columns of the relational tables, in load order.
RDB_TABLES = {
    "document": ["document_id", "document_title", "source_path"],
    "semantic_unit": ["semantic_unit_id", "document_id", "source_ref", "context_text", "unit_text", "unit_kind"],
    "entity": ["entity_id", "canonical_name", "entity_type", "mention_count", "aliases"],
    "relation_type": ["relation_type_id", "canonical_name", "polarity"],
    "relation": ["relation_id", "source_entity_id", "relation_type_id", "target_entity_id", "source_name", "target_name", "evidence_count"],
    "relation_evidence": ["relation_mention_id", "relation_id", "semantic_unit_id", "document_id", "source_ref", "raw_subject", "raw_predicate", "raw_object"],
}
_JSON_COLUMNS = {"source_ref", "aliases"}
_TYPES = {"mention_count": "bigint", "evidence_count": "bigint", "source_ref": "jsonb", "aliases": "jsonb"}


def write_jsonl(df: DataFrame, path: str, leading: list[str] | None = None, overwrite: bool = False, append: bool = False) -> None:
    """JSON lines, keys sorted or led by ``leading``; an existing target is refused unless told otherwise."""
    head = leading or []
    order = [*head, *sorted(c for c in df.columns if c not in head)]
    mode = "append" if append else "overwrite" if overwrite else "errorifexists"
    df.select(*order).write.option("ignoreNullFields", False).option("maxRecordsPerFile", ROWS_PER_FILE).mode(mode).json(path)


def _flat(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as text: structs and arrays as JSON, null as the empty string."""
    kinds = dict(df.dtypes)

    def text(c: str) -> Column:
        if c not in kinds:
            return F.lit("")
        x = F.to_json(c) if kinds[c].startswith(("struct", "array", "map")) else F.col(c).cast("string")
        return F.coalesce(x, F.lit(""))

    return df.select(*[text(c).alias(c) for c in columns])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and doubled quotes."""
    df.write.option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").option("maxRecordsPerFile", ROWS_PER_FILE).mode("errorifexists").csv(path)


def write_rdb(tables: dict[str, DataFrame], folder: str, schema: str = "graph") -> list[str]:
    """The relational load files and the SQL that loads them; the names written."""
    for name, columns in RDB_TABLES.items():
        if name in tables:
            write_csv(_flat(tables[name], columns), f"{folder}/{name}")
    spark = next(iter(tables.values())).sparkSession
    write_text(spark, f"{folder}/schema.sql", rdb_schema(schema))
    write_text(spark, f"{folder}/load.sql", rdb_load(schema, [t for t in RDB_TABLES if t in tables]))
    return [t for t in RDB_TABLES if t in tables]


def rdb_schema(schema: str = "graph") -> str:
    """DDL of the tables: first column the key, ids as uuid, counts positive."""
    out = [f"CREATE SCHEMA IF NOT EXISTS {schema};"]
    for name, columns in RDB_TABLES.items():
        cols = []
        for c in columns:
            kind = _TYPES.get(c, "uuid" if c.endswith("_id") else "text")
            check = f" CHECK ({c} > 0)" if c == "evidence_count" else ""
            cols.append(f"  {c} {kind}{' PRIMARY KEY' if c == columns[0] else ''}{check}")
        out.append(f"CREATE TABLE IF NOT EXISTS {schema}.{name} (\n" + ",\n".join(cols) + "\n);")
    return "\n".join(out) + "\n"


def rdb_load(schema: str, names: list[str]) -> str:
    """Staging, COPY and upsert of every table in one transaction."""
    out = ["BEGIN;"]
    for name in names:
        columns = RDB_TABLES[name]
        stage = f"stage_{name}"
        out.append(f"CREATE TEMP TABLE {stage} ({', '.join(c + ' text' for c in columns)}) ON COMMIT DROP;")
        out.append(f"\\copy {stage} FROM PROGRAM 'cat {name}/*.csv' CSV HEADER")
        casts = ", ".join(f"NULLIF({c}, '')::{_TYPES.get(c, 'uuid' if c.endswith('_id') else 'text')}" for c in columns)
        sets = ", ".join(f"{c} = EXCLUDED.{c}" for c in columns[1:])
        out.append(f"INSERT INTO {schema}.{name} ({', '.join(columns)}) SELECT {casts} FROM {stage}\n  ON CONFLICT ({columns[0]}) DO UPDATE SET {sets};")
    return "\n".join([*out, "COMMIT;"]) + "\n"


def numbered(df: DataFrame, order: list[str], out: str = "node_number", parts: int | None = None) -> DataFrame:
    """Consecutive numbers from 1 in order, without a single-task window. The order must tell all rows apart.

    Rows are dealt to ranges and written with their range to the shared folder: the bounds of ranges are sampled, and would
    be others when computed again. They are then numbered within each range and shifted by the sizes of the ranges before (as
    many rows as ranges on the driver; unless given, four a core and 64 at least)."""
    parts = parts or max(64, 4 * df.sparkSession.sparkContext.defaultParallelism)
    part, inner, shift_by = (f"_numbered_{x}_{out}" for x in ("part", "inner", "shift"))
    ranged = materialise(df.repartitionByRange(parts, *order).withColumn(part, F.spark_partition_id()), "numbered")
    shift, total = [], 0
    for r in ranged.groupBy(part).agg(F.count(F.lit(1)).alias("n")).orderBy(part).collect():
        shift.append((r[part], total))
        total += r["n"]
    table = df.sparkSession.createDataFrame(shift or [(0, 0)], f"{part} int, {shift_by} long")
    inside = ranged.withColumn(inner, F.row_number().over(W.partitionBy(part).orderBy(*order)))
    return inside.join(F.broadcast(table), part).withColumn(out, (F.col(inner) + F.col(shift_by)).cast("long")).drop(part, inner, shift_by)


def write_property_graph(entities: DataFrame, relations: DataFrame, folder: str) -> None:
    """Vertex files by entity type and edge files by relation type, vertices numbered by (name, id)."""
    v = numbered(entities.select("entity_id", "canonical_name", "entity_type"), ["canonical_name", "entity_id"])
    v.select("node_number", "entity_id", "canonical_name", F.coalesce("entity_type", F.lit("OTHER")).alias("label")).write.partitionBy("label").option("header", True).option("escape", '"').mode("errorifexists").csv(f"{folder}/vertices")
    ids = v.select("entity_id", "node_number")
    e = relations.join(ids.select(F.col("entity_id").alias("source_entity_id"), F.col("node_number").alias("from_number")), "source_entity_id")
    e = e.join(ids.select(F.col("entity_id").alias("target_entity_id"), F.col("node_number").alias("to_number")), "target_entity_id")
    e.select("relation_id", "from_number", "to_number", "evidence_count", F.col("relation_type_id").alias("label")).write.partitionBy("label").option("header", True).mode("errorifexists").csv(f"{folder}/edges")


def bulk_lines(df: DataFrame, key: str, index: str) -> DataFrame:
    """(key, part, line): the action line and the document line of every row of a search-index bulk file."""
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"), F.col(key).alias("_id")).alias("index")))
    doc = F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"})
    return df.select(F.col(key).alias("key"), F.posexplode(F.array(action, doc)).alias("part", "line"))


def write_bulk(df: DataFrame, key: str, index: str, path: str) -> None:
    """Bulk files: each file holds whole pairs of lines."""
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"), F.col(key).alias("_id")).alias("index")))
    doc = F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"})
    df.select(F.concat(action, F.lit("\n"), doc).alias("value")).write.mode("errorifexists").text(path)


def index_mapping(text_fields: list[str], keyword_fields: list[str], dimension: int | None = None) -> dict:
    """Strict mapping of a search index: texts with a keyword subfield, keywords, and an optional vector."""
    props: dict = {f: {"type": "text", "fields": {"keyword": {"type": "keyword", "ignore_above": 1024}}} for f in text_fields}
    props |= {f: {"type": "keyword"} for f in keyword_fields}
    if dimension:
        props["embedding"] = {"type": "knn_vector", "dimension": dimension, "method": {"name": "hnsw", "engine": "lucene", "space_type": "cosinesimil", "parameters": {"ef_construction": 100, "m": 16}}}
    return {"settings": {"index": {"knn": bool(dimension)}}, "mappings": {"dynamic": "strict", "properties": props}}


def _hashes(spark: SparkSession, folder: str) -> list[dict]:
    """Path, size and SHA-256 (upper case) of every file below a folder, hashed on the cluster; one small row a file."""
    base = full_path(spark, folder).rstrip("/") + "/"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    rows = files.select("path", "length", F.upper(F.sha2("content", 256)).alias("sha256")).collect()
    found = [{"path": r["path"].removeprefix(base), "bytes": r["length"], "sha256": r["sha256"]} for r in rows]
    return sorted((f for f in found if not f["path"].split("/")[-1].startswith(("manifest.json", ".", "_"))), key=lambda f: f["path"])


def write_manifest(spark: SparkSession, folder: str, extra: dict | None = None) -> dict:
    """manifest.json of a folder on any file system: every file (2 GB at most) with its size and SHA-256 in upper case."""
    out = {"files": _hashes(spark, folder), **(extra or {})}
    write_text(spark, f"{folder}/manifest.json", json.dumps(out, ensure_ascii=False, indent=2, sort_keys=True))
    return out


def write_search(result: dict[str, DataFrame], question: str, answer: str, nodes: DataFrame, edges: DataFrame, folder: str) -> dict:
    """Artifacts of one search: candidates, ranked paths, evidence, answer.md, graph.json, manifest.

    All of them are bounded by the search's bounds. An existing folder is refused."""
    spark = nodes.sparkSession
    if path_exists(spark, folder):
        raise FileExistsError(folder)

    def rows(df: DataFrame, *order: str) -> list[dict]:
        return [r.asDict(recursive=True) for r in df.orderBy(*order).collect()]

    def put(name: str, value: object) -> None:
        write_text(spark, f"{folder}/{name}", json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True, default=str))

    put("entity_candidates.json", rows(result["candidates"], "rank"))
    put("relation_candidates.json", rows(result["relations"], "ord"))
    put("ranked_paths.json", rows(result["paths"], "rank"))
    put("evidence.json", rows(result["evidence"], "relation_id", "evidence_rank"))
    put("graph.json", {"nodes": rows(nodes, "id"), "edges": rows(edges, "relation_id")})
    write_text(spark, f"{folder}/answer.md", f"# {question}\n\n{answer}\n")
    return write_manifest(spark, folder, {"question": question})


def write_questions(spark: SparkSession, rows: list[dict], folder: str) -> dict:
    """Artifacts of discovered questions (a bounded list of rows with question_id, question, answer and found_by): questions.jsonl, one
    Markdown file a question, and the manifest with how many were found and whether all were. An existing folder is refused."""
    if path_exists(spark, folder):
        raise FileExistsError(folder)
    write_text(spark, f"{folder}/questions.jsonl", "".join(json.dumps(r, ensure_ascii=False, sort_keys=True, default=str) + "\n" for r in rows))
    for r in rows:
        write_text(spark, f"{folder}/answers/{r['question_id']}.md", f"# {r['question']}\n\n{r['answer']}\n")
    found = sum(r["found_by"] is not None for r in rows)
    return write_manifest(spark, folder, {"question_count": len(rows), "expected_path_found_count": found, "passed": bool(rows) and found == len(rows)})


def verify_manifest(spark: SparkSession, folder: str) -> list[str]:
    """What differs between a folder and its manifest: missing, changed and unlisted files."""
    listed = {f["path"]: f for f in json.loads(read_text(spark, f"{folder}/manifest.json"))["files"]}
    there = {f["path"]: f for f in _hashes(spark, folder)}
    out = [f"missing {n}" for n in listed if n not in there] + [f"unlisted {n}" for n in there if n not in listed]
    out += [f"changed {n}" for n in listed if n in there and there[n]["sha256"] != listed[n]["sha256"]]
    return sorted(out)


def publish(spark: SparkSession, root: str, version: str) -> str:
    """Makes a written version the current one by replacing the pointer file in one step; the folder it names."""
    target = f"{root}/{version}"
    if differences := verify_manifest(spark, target):
        raise ValueError(f"version {version} differs from its manifest: {differences[:5]}")
    write_text(spark, f"{root}/.current.new", version)
    replace_path(spark, f"{root}/.current.new", f"{root}/current")
    return target


def current(spark: SparkSession, root: str) -> str:
    return f"{root}/{read_text(spark, f'{root}/current').strip()}"
