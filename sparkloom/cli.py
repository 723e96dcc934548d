"""Command line: python -m sparkloom.cli COMMAND --help. Tables are JSON lines or parquet, by their ending."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.clients import HttpCompletion, extract_relations, resolve_contexts
from sparkloom.functions.text import lexical_key
from sparkloom.operators import audit, dictionary, mentions, paths, proposals
from sparkloom.operators.segment import segment
from sparkloom.pipeline import DictionaryBuild, GraphStore, evaluate_question, grounded_answer, ingest, prepare, search
from sparkloom.runtime import session, ship_package
from sparkloom.server import make_server
from sparkloom.sources import sinks
from sparkloom.sources.readers import load_environment, load_prompt, read_markdown, read_overrides


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path) if path.rstrip("/").endswith((".jsonl", ".json")) else spark.read.parquet(path)


def save(df: DataFrame, path: str, overwrite: bool) -> None:
    if path.rstrip("/").endswith((".jsonl", ".json")):
        sinks.write_jsonl(df, path, overwrite=overwrite)
    else:
        df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def verdict(df: DataFrame) -> int:
    """Prints an audit's row; 1 unless it passed."""
    row = df.first().asDict()
    print(json.dumps(row, ensure_ascii=False))
    return 0 if row.get("passed", True) else 1


def run(a: argparse.Namespace, spark: SparkSession) -> int:  # noqa: C901
    get = lambda name: load(spark, getattr(a, name))
    put = lambda df: save(df, a.output, a.overwrite)
    client = lambda: HttpCompletion(a.endpoint, a.model)
    prompt = load_prompt(a.prompts, a.prompt) if getattr(a, "prompt", None) else ""

    def proposed(result: tuple[DataFrame, DataFrame]) -> int:
        put(result[0])
        n = result[1].count()
        print(json.dumps({"failed": n}))
        return int(n > 0)

    match a.command:
        case "segment":
            put(segment(read_markdown(spark, a.input), "source_path", "text").drop("doc"))
        case "resolve-context":
            put(get("input").drop("resolved_text", "resolution_type").join(resolve_contexts(get("input"), client), "semantic_unit_id"))
        case "audit-context":
            return verdict(audit.audit_contexts(get("input"), get("second")))
        case "extract":
            units = proposals.slice_units(get("input"), a.offset, a.limit)
            return proposed(extract_relations(mentions.pending(units, get("second")) if a.second else units, client))
        case "align-svo":
            put(mentions.align(get("input"), get("second")))
        case "sanitize-svo":
            put(mentions.sanitize_records(get("input")))
        case "audit-svo":
            return verdict(audit.audit_raw_release(get("input"), get("second")))
        case "candidates":
            put(DictionaryBuild(get("input")).candidates()[0])
        case "surface-lists":
            put(dictionary.surface_lists(mentions.endpoints(mentions.mentions(get("input")))))
        case "normalize-relation-surfaces":
            return proposed(proposals.relation_mapping(dictionary.predicate_counts(mentions.mentions(get("input"))), prompt, client))
        case "normalize":
            put(dictionary.first_pass(mentions.mentions(get("input")), get("second")))
        case "merge-jsonl":
            put(dictionary.merge_first_wins([load(spark, p) for p in a.shards], a.key, [a.key]))
        case "seed-entity-map":
            put(dictionary.seeded_mapping(get("input"), get("second")))
        case "refresh-relations":
            put(dictionary.refreshed_counts(get("second"), dictionary.predicate_counts(mentions.mentions(get("input")))))
        case "cluster-entities":
            over = read_overrides(spark, a.overrides) if a.overrides else None
            put(DictionaryBuild(get("input")).entities(get("second"), over))
        case "renormalize-entities":
            asked, _ = proposals.contextual_targets(get("input"), lexical_key(F.col("canonical_name")))
            return proposed(proposals.contextual_mapping(asked, prompt, client))
        case "classify-entity-types":
            return proposed(proposals.entity_types(get("input"), prompt, client))
        case "compress-relations":
            return proposed(proposals.closed_mapping(get("input"), get("second"), prompt, client))
        case "build-entity-map":
            put(dictionary.direct_alias_map(get("input"), "entity_id", keep_zero=True))
        case "build-relation-map":
            put(dictionary.direct_alias_map(get("input"), "relation_type_id", keep_zero=False))
        case "audit-candidates":
            return verdict(audit.audit_surface_lists(get("input"), mentions.endpoints(mentions.mentions(get("second")))))
        case "audit":
            return verdict(audit.audit_graph_release(*[load(spark, f"{a.input}/{n}.parquet") for n in ("relation", "evidence", "entity", "relation_type", "semantic_units", "source_document", "raw_svo")]))
        case "audit-dictionaries":
            return verdict(audit.audit_dictionary_release(get("input"), get("second"), get("third"), a.expected_types))
        case "build-load-files":
            tables = {t: load(spark, f"{a.input}/{t}.parquet") for t in a.tables}
            print(json.dumps(sinks.write_rdb(tables, a.output)))
        case "document-ingest":
            units = segment(read_markdown(spark, a.input), "source_path", "text")
            bundle = ingest(spark, a.input, a.output, client, dictionary.alias_index(get("second"), "entity_id"), get("third"), units=units)
            return verdict(audit.audit_graph_release(bundle.relations, bundle.evidence, bundle.entities, bundle.relation_types, units, bundle.documents))
        case "search-query" | "search-cross-document-qa" | "search-web":
            t = {n: load(spark, f"{a.input}/{n}.parquet") for n in ("entity", "relation", "relation_type", "evidence", "semantic_units", "source_document")}
            edges = paths.with_type_names(t["relation"], t["relation_type"])
            store = prepare(GraphStore(t["entity"].groupBy("entity_id").agg(F.min("canonical_name").alias("canonical_name"), F.min("aliases").alias("aliases")), edges, t["evidence"], t["semantic_units"], t["source_document"]))
            bounds = paths.SearchBounds(a.hops)

            def ask(question: str) -> dict:
                return search(spark, store, question, bounds, budget=paths.TimeBudget(a.seconds) if a.seconds else None)

            if a.command == "search-web":

                def answer(question: str) -> dict:
                    result = ask(question)
                    text, cited = grounded_answer(result)
                    return {"answer": text, "evidence": cited, "paths": [r.asDict() for r in result["paths"].orderBy("rank").collect()]}

                make_server(answer, port=a.port).serve_forever()
            elif a.command == "search-query":
                result = ask(a.query)
                text = grounded_answer(result)[0]
                if a.artifacts:
                    sinks.write_search(result, a.query, text, *paths.graph_payload(result["paths"], result["candidates"]), a.artifacts)
                print(text)
            else:
                chosen = paths.select_questions(paths.cross_document_candidates(edges, t["evidence"]), a.count)
                rows = []
                for q in chosen:
                    result = ask(q["question"])
                    rows.append({**q, "answer": grounded_answer(result)[0], "found_by": evaluate_question(q, result["paths"])})
                found = [r["found_by"] for r in rows]
                if a.artifacts:
                    sinks.write_questions(spark, rows, a.artifacts)
                print(json.dumps({"questions": len(chosen), "answered": sum(x is not None for x in found)}))
                return int(len(chosen) < a.count or None in found)
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sparkloom", description=__doc__)
    p.add_argument("--env-file")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, second: bool | None = None, model: bool = False, output: bool = True) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        c.add_argument("--input", required=True)
        if output:
            c.add_argument("--output", required=True)
            c.add_argument("--overwrite", action="store_true")
        if second is not None:
            c.add_argument("--second", required=second)
        if model:
            c.add_argument("--endpoint", default="http://127.0.0.1:8000/v1/chat/completions")
            c.add_argument("--model", default="local")
            c.add_argument("--prompts", default="prompts")
            c.add_argument("--prompt")
        return c

    for name in ("segment", "sanitize-svo", "candidates", "surface-lists", "build-entity-map", "build-relation-map"):
        add(name)
    for name in ("align-svo", "normalize", "seed-entity-map", "refresh-relations"):
        add(name, True)
    add("cluster-entities", True).add_argument("--overrides")
    for name in ("audit-context", "audit-svo", "audit-candidates"):
        add(name, True, output=False)
    add("audit", output=False)
    c = add("audit-dictionaries", True, output=False)
    c.add_argument("--third", required=True)
    c.add_argument("--expected-types", type=int, default=98)
    for name in ("resolve-context", "normalize-relation-surfaces", "renormalize-entities", "classify-entity-types"):
        add(name, model=True)
    add("compress-relations", True, True)
    c = add("extract", False, True)
    c.add_argument("--offset", type=int, default=0)
    c.add_argument("--limit", type=int)
    c = sub.add_parser("merge-jsonl")
    c.add_argument("shards", nargs="+")
    c.add_argument("--key", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--overwrite", action="store_true")
    c = add("build-load-files")
    c.add_argument("--tables", nargs="+", default=list(sinks.RDB_TABLES))
    add("document-ingest", True, True).add_argument("--third", required=True)
    for name in ("search-query", "search-cross-document-qa", "search-web"):
        c = add(name, output=False)
        c.add_argument("--hops", type=int, default=3)
        c.add_argument("--query", required=name == "search-query")
        c.add_argument("--count", type=int, default=10)
        c.add_argument("--port", type=int, default=8765)
        c.add_argument("--seconds", type=float, help="time budget of one search")
        c.add_argument("--artifacts", help="folder for the results of a query or of the questions")
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.env_file:
        load_environment(a.env_file)
    spark = SparkSession.getActiveSession() or session("sparkloom-cli")
    ship_package(spark)
    return run(a, spark)


if __name__ == "__main__":
    sys.exit(main())
