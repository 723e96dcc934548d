import json
import re

import pytest
from pyspark.sql import functions as F

from sparkloom.cli import main
from sparkloom.clients import StubCompletion
from sparkloom.functions.text import lexical_key
from sparkloom.operators import proposals as P
from sparkloom.operators.paths import TimeBudget
from sparkloom.pipeline import evaluate_question


def payload(prompt):
    return json.loads(prompt.split("입력:\n", 1)[1])


def stub(f):
    return lambda: StubCompletion(lambda p: json.dumps(f(payload(p)), ensure_ascii=False))


def test_batches_are_numbered_in_order(spark):
    rows = spark.range(23).withColumn("k", -F.col("id"))
    got = [[r.id for r in b["rows"]] for b in P.batches(rows, ["k"], 5).orderBy("batch").collect()]
    assert got == [list(range(22, -1, -1))[i : i + 5] for i in range(0, 23, 5)]


def test_relation_mapping(spark):
    p = spark.createDataFrame([("한다", 3), ("하지 않다", 2), ("정한다", 1), ("모름", 1)], "canonical_name string, mention_count long")
    answer = {"한다": ("하다", "POSITIVE"), "하지 않다": ("하다", "NEGATIVE"), "정한다": ("정하다", "POSITIVE")}
    m, bad = P.relation_mapping(p, "", stub(lambda x: {"items": [{"alias": i["alias"], "canonical_name": answer[i["alias"]][0], "polarity": answer[i["alias"]][1]} for i in x if i["alias"] in answer]}), 2)
    assert {r.alias: (r.canonical_name, r.polarity, r.normalization_status) for r in m.collect()} == {
        "한다": ("하다", "POSITIVE", "llm_proposed"), "정한다": ("정하다", "POSITIVE", "llm_proposed"),
        "하지 않다": ("하지 않다", "NEGATIVE", "fallback_raw_invalid_proposal"), "모름": ("모름", "POSITIVE", "fallback_raw_missing_proposal")}
    assert bad.count() == 0
    m, bad = P.relation_mapping(p, "", lambda: StubCompletion(lambda q: "nonsense"), 2)
    assert bad.count() == 2 and m.filter("normalization_status like 'fallback%'").count() == 4
    raw = spark.createDataFrame([("u1", [("m1", "a", "한다", "b"), ("m2", "a", "x", "b")]), ("u2", [("m3", "a", "x", "b")])], "semantic_unit_id string, relations array<struct<id:string,subject:string,predicate:string,object:string>>")
    assert [(r.semantic_unit_id, [x.id for x in r.relations]) for r in P.fallback_records(raw, m).collect()] == [("u1", ["m1"])]


def test_entity_passes(spark):
    e = spark.createDataFrame([("e1", "건축사법에 따른 공사감리"), ("e2", "위원회"), ("e3", "위 원회"), ("e4", "회사")], "entity_id string, canonical_name string")
    asked, kept = P.contextual_targets(e, lexical_key(F.col("canonical_name")))
    assert {r.entity_id for r in asked.collect()} == {"e1", "e2", "e3"} and [r.entity_id for r in kept.collect()] == ["e4"]
    names = {"e1": "건축사법 제1조", "e2": "사항"}
    m, _ = P.contextual_mapping(asked, "", stub(lambda x: {"items": [{"source_entity_id": i["source_entity_id"], "canonical_name": names[i["source_entity_id"]]} for i in x if i["source_entity_id"] in names]}))
    assert {r.source_entity_id: (r.canonical_name, r.normalization_status) for r in m.collect()} == {
        "e1": ("공사감리", "rule_qualified_endpoint_not_law"), "e2": ("위원회", "fallback_rejected_proposal"), "e3": ("위 원회", "fallback_source_name")}
    prior = spark.createDataFrame([("회사", "법인", "llm_x", 1), ("회사", "기업", "llm_x", 2), ("위원회", "사항", "llm_x", 3)], "source_canonical_name string, canonical_name string, normalization_status string, seq int")
    assert [(r.source_entity_id, r.canonical_name) for r in P.rekey_by_name(e, prior).collect()] == [("e4", "기업")]
    n, _ = P.entity_mapping(e.select(F.col("canonical_name").alias("name")), "", stub(lambda x: {"items": [{"alias": i["alias"], "canonical_name": i["alias"] + "!"} for i in x]}), 2)
    assert all(r.canonical_name == r.name + "!" for r in n.collect())


def test_types_count_only_by_whole_batches(spark):
    e = spark.createDataFrame([(f"e{i}", f"n{i}", []) for i in range(4)], "entity_id string, canonical_name string, aliases array<struct<name:string>>")
    t, bad = P.entity_types(e, "", stub(lambda x: {"entities": [{"entity_id": i["entity_id"], "entity_type": "PERSON" if i["entity_id"] != "e3" else "PLANET"} for i in x["entities"]]}), 2)
    assert {r.entity_id for r in t.collect()} == {"e0", "e1"} and bad.count() == 1
    rules = spark.createDataFrame([("e0", "OTHER", "fallback_other"), ("e1", "CONCEPT", "canonical_rule")], "entity_id string, entity_type string, method string")
    assert {r.entity_id: (r.entity_type, r.method) for r in P.merge_types(rules, t).collect()} == {"e0": ("PERSON", "llm"), "e1": ("CONCEPT", "canonical_rule")}


def test_closed_mapping_overrides_and_taxonomy(spark):
    rel = spark.createDataFrame([("1", "철회하다", "POSITIVE", 2), ("2", "철회하지 않다", "NEGATIVE", 1), ("3", "남다", "POSITIVE", 1)], "relation_type_id string, canonical_name string, polarity string, mention_count long")
    tax = spark.createDataFrame([("R1", "승인하다", "승인하지 않다", ""), ("R2", "취소하다", "취소하지 않다", "")], "family_id string, positive_name string, negative_name string, description string")
    m, bad = P.closed_mapping(rel, tax, "", stub(lambda x: {"items": [{"source_canonical_name": i["source_canonical_name"], "family_id": "R1"} for i in x if i["source_canonical_name"] != "남다"]}))
    assert {r.source_canonical_name: r.target_canonical_name for r in m.collect()} == {"철회하다": "취소하다", "철회하지 않다": "승인하지 않다"} and bad.count() == 1
    over, bad = P.forced_overrides(rel.select(F.col("canonical_name").alias("predicate")), rel, "", stub(lambda x: {"items": [{"raw_predicate": p, "relation_type_id": "1" if "철회" in p else "99"} for p in x["raw_predicates"]]}))
    assert over.count() == 2 and bad.count() == 1
    calls = []

    def families(p):
        calls.append(p)
        return "broken" if len(calls) == 1 else json.dumps({"items": [{"positive_name": f"가{len(calls)}", "negative_name": f"나{len(calls)}", "description": "d"}]})

    assert P.taxonomy(rel, "p", StubCompletion(families), 5, 2)[0]["family_id"] == "R001" and len(calls) == 4
    with pytest.raises(RuntimeError):
        P.taxonomy(rel, "p", StubCompletion(lambda p: "{}"), 5, 2)


def test_time_budget():
    now = [0.0]
    b = TimeBudget(100, lambda: now[0])
    assert b.limit(50, "x") == 50
    now[0] = 70
    assert b.limit(50, "x") == 25 == b.limit(50, "x")
    now[0] = 90
    assert b.limit(50, "x") == 12 and b.limit(2, "y") == 1 and len(b.notes) == 3


def test_evaluation(spark):
    q = {"expected_relation_ids": ("r1", "r2"), "start_id": "a", "middle_id": "b", "end_id": "c"}
    rows = lambda rel, ents, docs: spark.createDataFrame([(rel, ents, docs)], "relation_ids array<string>, entity_ids array<string>, document_ids array<string>")
    assert evaluate_question(q, rows(["r1", "r2", "r3"], ["a"], ["1", "2"])) == "exact_relations"
    assert evaluate_question(q, rows(["r9"], ["a", "b", "c"], ["1", "2"])) == "same_entities_alternative_relations"
    assert evaluate_question(q, rows(["r1", "r2"], ["a", "b", "c"], ["1"])) is None


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs/a.md").write_text("# 규정\n##### 제1조(목적)\n가람원은 보고한다.\n")
    assert main(["segment", "--input", str(tmp_path / "docs"), "--output", str(tmp_path / "units.jsonl")]) == 0
    units = spark.read.json(str(tmp_path / "units.jsonl"))
    assert [r.unit_text for r in units.collect()] == ["가람원은 보고한다."]
    (tmp_path / "s1.jsonl").write_text('{"k":"a","v":1}\n')
    (tmp_path / "s2.jsonl").write_text('{"k":"a","v":2}\n{"k":"b","v":3}\n')
    assert main(["merge-jsonl", str(tmp_path / "s1.jsonl"), str(tmp_path / "s2.jsonl"), "--key", "k", "--output", str(tmp_path / "m.parquet")]) == 0
    assert {(r.k, r.v) for r in spark.read.parquet(str(tmp_path / "m.parquet")).collect()} == {("a", 1), ("b", 3)}
    sf = "/root/testdata/sf0.001"
    assert main(["audit-svo", "--input", f"{sf}/semantic_units.parquet", "--second", f"{sf}/raw_svo.parquet"]) == 1
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["units_without_record"] >= 0
    assert main(["audit", "--input", sf]) == 1
    assert main(["surface-lists", "--input", f"{sf}/raw_svo.parquet", "--output", str(tmp_path / "l.parquet")]) == 0
    assert main(["audit-candidates", "--input", str(tmp_path / "l.parquet"), "--second", f"{sf}/raw_svo.parquet"]) == 0
    assert main(["search-query", "--input", sf, "--query", "보건의료운영준칙", "--hops", "1"]) == 0
    assert re.search(r"^1\. ", capsys.readouterr().out, re.M)
