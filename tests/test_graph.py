import collections
import json
import math
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from sparkloom.clients import HashEmbedding, StubCompletion, check_loopback, embed, extract_relations, resolve_contexts
from sparkloom.functions.ids import stable_id
from sparkloom.operators import audit, dictionary, graphmap, paths, retrieval
from sparkloom.operators.mentions import align, coverage, endpoints, mentions, sanitize_records
from sparkloom.pipeline import DictionaryBuild, GraphStore, grounded_answer, ingest, prepare, search, written_answer
from sparkloom.sources import readers, sinks
from sparkloom.streaming.ingest import ingest_stream

REF = "struct<article:string,paragraph:int,item_path:array<string>>"
RAW = f"semantic_unit_id string, document_id string, document_title string, source_path string, source_ref {REF}, unit_seq long, relations array<struct<relation_mention_id:string,subject:string,predicate:string,object:string>>"


def raw(spark, units):
    rows = [(f"u{i}", f"d{i % 2}", f"제목{i % 2}", "", ("제1조", None, []), i, [(f"m{i}-{k}", *t) for k, t in enumerate(ts)]) for i, ts in enumerate(units)]
    return spark.createDataFrame([*rows, rows[0]], RAW)


UNITS = [[("가람", "한다", "나무"), ("가람", "한다", "나무")], [("이 법", "하지 않다", "가람이")], [], [(None, "한다", "x"), (" ", "한다", "x"), ("y", "모르다", "x")]]
RELATIONS = [("r1", "한다", "POSITIVE"), ("r2", "하지 않다", "NEGATIVE")]


def graph_inputs(spark):
    entities = spark.createDataFrame([("e1", "가람", 5, [("가람", 4, True), ("가람이", 1, False)])], "entity_id string, canonical_name string, mention_count long, aliases array<struct<name:string,mention_count:long,is_canonical:boolean>>")
    rt = spark.createDataFrame(RELATIONS, "relation_type_id string, canonical_name string, polarity string")
    index = rt.select(F.col("canonical_name").alias("name"), F.col("relation_type_id").alias("id"), "canonical_name")
    return dictionary.alias_index(entities, "entity_id"), index, rt, entities


def test_mapping(spark):
    ix, rix, rt, _ = graph_inputs(spark)
    m = mentions(raw(spark, UNITS))
    assert m.count() == 6
    with pytest.raises(graphmap.UnmappedRelationError, match="모르다"):
        graphmap.map_to_graph(m, ix, rix, rt)
    over = spark.createDataFrame([("모르다", "r1")], "raw_predicate string, relation_type_id string")
    b = graphmap.map_to_graph(m, ix, rix, rt, over)
    edges = {(r.source_name, r.relation_type_id, r.target_name): r.evidence_count for r in b.relations.collect()}
    assert edges == {("가람", "r1", "나무"): 2, ("제목1", "r2", "가람"): 1, ("y", "r1", "x"): 1}
    ents = {r.canonical_name: (r.mention_count, [(a.name, a.mention_count, a.is_canonical) for a in r.aliases]) for r in b.entities.collect()}
    assert ents["가람"] == (3, [("가람", 2, True), ("가람이", 1, False)]) and ents["제목1"] == (1, [("제목1", 1, True)])
    status = {(r.raw_name, r.mapping_status): r.mention_count for r in b.entity_mapping.collect()}
    assert status["이 법", "current_document_self_reference"] == 1 and status["가람이", "dictionary_alias"] == 1 and status["나무", "new_raw_entity"] == 2
    assert {r.raw_predicate: r.mapping_status for r in b.relation_mapping.collect()}["모르다"] == "forced_dictionary_mapping"
    with pytest.raises(ValueError, match="invalid overrides"):
        graphmap.map_to_graph(m, ix, rix, rt, spark.createDataFrame([("모르다", "zz")], over.schema))


def test_repeated_index_names_double_no_mention(spark):
    m = spark.createDataFrame([("m1", "한다"), ("m2", " 한다"), ("m3", "간다"), ("m4", None)], "relation_mention_id string, predicate string")
    index = spark.createDataFrame([("한다", "b"), ("한다", "a"), (None, "c")], "name string, id string")
    forced = spark.createDataFrame([("간다", "z"), ("한다", "y")], "raw_predicate string, relation_type_id string")
    got = {(r.relation_mention_id, r.relation_type_id, r.relation_mapping_status) for r in graphmap.map_relations(m, index, forced).collect()}
    assert got == {("m1", "a", "dictionary_alias"), ("m2", "a", "dictionary_alias"), ("m3", "z", "forced_dictionary_mapping")}


def test_alias_conflicts(spark):
    *_, entities = graph_inputs(spark)
    twice = entities.unionByName(spark.createDataFrame([("e2", "나람", 9, [("가람", 9, False), ("가람이", 3, False)])], entities.schema))
    with pytest.raises(dictionary.DictionaryConflictError):
        dictionary.alias_index(twice, "entity_id")
    win = {r["name"]: r["id"] for r in dictionary.alias_winners(twice, "entity_id").collect()}
    assert win == {"가람": "e1", "가람이": "e2", "나람": "e2"}


def test_coverage_and_alignment(spark):
    r = raw(spark, UNITS)
    units = r.select("semantic_unit_id", "unit_seq").distinct()
    one = r.dropDuplicates(["semantic_unit_id"])
    assert [x.semantic_unit_id for x in align(units, one).collect()] == ["u0", "u1", "u2", "u3"]
    assert coverage(units, r).first().doubled_records == 1
    with pytest.raises(ValueError):
        align(units.limit(2), one)


def test_sanitized_records(spark):
    r = raw(spark, [[("위원회 또는 회사", "한다", "보고서, 장부"), ("회사", "한다", "장부"), ("1년", "한다", "장부"), (None, "한다", "x")]])
    got = mentions(sanitize_records(r)).orderBy("rel_ord").collect()
    assert [(x.subject, x.object) for x in got] == [("위원회", "보고서"), ("위원회", "장부"), ("회사", "보고서"), ("회사", "장부")]
    assert len({x.relation_mention_id for x in got}) == 4


def test_candidates_keep_first_samples(spark):
    units = [[("가", "p", "나")]] * 9
    c = {r["name"]: r for r in dictionary.candidates(endpoints(mentions(raw(spark, units))), "entity_candidate", 3).collect()}
    assert c["가"].mention_count == 9 and [s.semantic_unit_id for s in c["가"].samples] == ["u0", "u1", "u2"]


def test_clustering_keeps_mentions(spark):
    names = spark.createDataFrame([("a1", 3), ("a2", 2), ("b", 1)], "name string, mention_count long")
    mapping = spark.createDataFrame([("a1", "A"), ("a2", "A"), ("b", "B")], "source_name string, canonical_name string")
    over = spark.createDataFrame([("a2", "B"), ("new", "B")], "alias string, canonical_name string")
    d = dictionary.clustered_dictionary(names, mapping, over)
    got = {r.canonical_name: (r.mention_count, [(a.name, a.mention_count) for a in r.aliases]) for r in d.collect()}
    assert got == {"A": (3, [("A", 0), ("a1", 3)]), "B": (3, [("B", 0), ("a2", 2), ("b", 1), ("new", 0)])}
    assert audit.mentions_preserved(names, d).first().passed


def test_second_clustering_keeps_aliases(spark):
    first = DictionaryBuild(raw(spark, [[("가", "p", "가가")], [("가가", "p", "나")], [("다", "p", "다다")]])).entities(
        spark.createDataFrame([("가가", "가"), ("다다", "다")], "source_name string, canonical_name string"))
    shown = lambda d: {r.canonical_name: (r.mention_count, [(a.name, a.mention_count) for a in r.aliases], [s.semantic_unit_id for s in r.samples]) for r in d.collect()}
    assert shown(first) == {"가": (3, [("가", 1), ("가가", 2)], ["u0", "u1"]), "나": (1, [("나", 1)], ["u1"]), "다": (2, [("다", 1), ("다다", 1)], ["u2"])}
    second = DictionaryBuild(raw(spark, [[]])).renormalized(first, spark.createDataFrame([("가", "라"), ("나", "라")], "source_canonical_name string, canonical_name string"))
    assert shown(second) == {"라": (4, [("라", 0), ("가가", 2), ("가", 1), ("나", 1)], ["u0", "u1"]), "다": (2, [("다", 1), ("다다", 1)], ["u2"])}
    assert audit.mentions_preserved(first, second).first().passed
    # what the aliases leave, aliases of several entities, overrides
    rows = [("가", 5, [("가", 1), ("공", 2), ("나", 9)]), ("나", 3, [("공", 3), ("새", 1)]), ("다", 1, [("공", 3)])]
    e = spark.createDataFrame(rows, "name string, mention_count long, aliases array<struct<name:string,mention_count:long>>")
    d = dictionary.clustered_dictionary(e, spark.createDataFrame([], "source_name string, canonical_name string"), spark.createDataFrame([("새", "다")], "alias string, canonical_name string"))
    got = {r.canonical_name: (r.mention_count, [(a.name, a.mention_count) for a in r.aliases]) for r in d.collect()}
    assert got == {"가": (5, [("가", 1)]), "나": (3, [("나", 0), ("공", 3)]), "다": (1, [("다", 0), ("새", 0)])}
    assert not dictionary.alias_conflicts(d.withColumn("id", F.col("entity_id")), "id").count()


def test_audits_fail_where_they_should(spark):
    ok = spark.createDataFrame([("가람", "CONCEPT", 1, [("가람", 1, True)])], "canonical_name string, entity_type string, mention_count long, aliases array<struct<name:string,mention_count:long,is_canonical:boolean>>").withColumn("entity_id", stable_id("entity", F.col("canonical_name")))
    assert audit.audit_dictionary(ok).first().passed
    for change, check in ((("entity_type", F.lit("X")), "unknown_types"), (("mention_count", F.lit(0).cast("long")), "not_mentioned"), (("entity_id", F.lit("x")), "wrong_ids"), (("aliases", F.reverse(F.array_append("aliases", F.col("aliases")[0].withField("name", F.lit("z"))))), "not_led_by_canonical")):
        r = audit.audit_dictionary(ok.withColumn(*change)).first()
        assert r[check] == 1 and not r.passed
    u = spark.createDataFrame([("u1", "t", "c", "t", "COPIED"), ("u2", "t", "c", "", "CONTEXT_INHERITED")], "semantic_unit_id string, unit_text string, context_text string, resolved_text string, resolution_type string")
    r = audit.audit_contexts(u, u).first()
    assert r.empty_texts == 1 and not r.passed and audit.audit_contexts(u.limit(1), u.limit(1)).first().passed


def test_audits_of_lists_and_closed_dictionaries(spark):
    ends = endpoints(mentions(raw(spark, UNITS)))
    listed = dictionary.surface_lists(ends)
    assert audit.audit_surface_lists(listed, ends).first().passed
    r = audit.audit_surface_lists(listed.withColumn("mention_count", F.lit(99)).filter("name <> 'x'").withColumn("semantic_unit_id", F.lit("u9")), ends).first()
    assert r.missing == 1 and r.wrong_counts == r.foreign_evidence == listed.count() - 1 and not r.passed
    tax = spark.createDataFrame([("R1", "하다", "하지 않다")], "family_id string, positive_name string, negative_name string")
    src = spark.createDataFrame([("한다", "POSITIVE", 3), ("한다아", "POSITIVE", 2), ("않다", "NEGATIVE", 1)], "canonical_name string, polarity string, mention_count long")
    mp = src.select(F.col("canonical_name").alias("source_canonical_name"), F.col("polarity").alias("source_polarity"), F.lit("R1").alias("family_id"))
    closed = dictionary.closed_relation_dictionary(src, mp, tax)
    assert audit.audit_closed_dictionary(closed, src, tax).first().passed
    assert dictionary.unmapped_relations(src, mp.limit(2)).count() == 1
    r = audit.audit_closed_dictionary(dictionary.closed_relation_dictionary(src, mp.limit(2), tax), src, tax).first()
    assert r.lost_mentions > 0 and not r.passed


def test_closed_dictionary_keeps_aliases(spark):
    tax = spark.createDataFrame([("R1", "하다", "하지 않다"), ("R2", "되다", None)], "family_id string, positive_name string, negative_name string")
    alias = "aliases array<struct<name:string,mention_count:long>>"
    src = spark.createDataFrame([("한다", "POSITIVE", 3, [("한다", 2), ("함", 1)]), ("하다", "POSITIVE", 2, [("함", 2), (" ", 0)]), ("않다", "NEGATIVE", 1, None)], "canonical_name string, polarity string, mention_count long, " + alias)
    mp = src.select(F.col("canonical_name").alias("source_canonical_name"), F.col("polarity").alias("source_polarity"), F.lit("R1").alias("family_id"))
    closed = dictionary.closed_relation_dictionary(src, mp, tax, strict=True)
    got = {r.canonical_name: (r.mention_count, r.source_relation_type_count, [tuple(a) for a in r.aliases]) for r in closed.collect()}
    assert got == {"하다": (5, 2, [("하다", 0, True), ("함", 3, False), ("한다", 2, False)]), "하지 않다": (1, 1, [("하지 않다", 0, True)])}
    assert {(r.alias, r.canonical_name, r.mention_count) for r in dictionary.direct_alias_map(closed, "relation_type_id", keep_zero=False).collect()} == {("함", "하다", 3), ("한다", "하다", 2)}
    bare = {r.canonical_name: [(a.name, a.mention_count) for a in r.aliases] for r in dictionary.closed_relation_dictionary(src.drop("aliases"), mp, tax).collect()}
    assert bare == {"하다": [("하다", 2), ("한다", 3)], "하지 않다": [("하지 않다", 0), ("않다", 1)]}
    for lacking in (mp.filter("source_canonical_name <> '한다'"), mp.withColumn("family_id", F.lit("R9")), mp.withColumn("family_id", F.lit("R2"))):
        with pytest.raises(dictionary.UnmappedSourceError):
            dictionary.closed_relation_dictionary(src, lacking, tax, strict=True)
    with pytest.raises(dictionary.UnmappedSourceError):
        DictionaryBuild(raw(spark, UNITS)).relations(mp, tax)


def release(spark):
    """Tables of one document that pass every audit."""
    ref = ("제1조", 1, [])
    unit = "semantic_unit_id string, document_id string, document_title string, source_path string, source_ref " + REF + ", context_text string, unit_text string, unit_kind string, unit_seq long"
    units = spark.createDataFrame([("u1", "d1", "문서", "p", ref, "c", "가람은 나무를 한다", "terminal_item", 0)], unit)
    raw = units.select("semantic_unit_id", "document_id", "document_title", "source_path", "source_ref", "unit_kind", "unit_seq", F.array(F.struct(
        stable_id("raw_svo_mention", F.lit("u1"), F.lit("가람"), F.lit("한다"), F.lit("나무")).alias("relation_mention_id"), F.lit("가람").alias("subject"), F.lit("한다").alias("predicate"), F.lit("나무").alias("object"))).alias("relations"))
    alias = "aliases array<struct<name:string,mention_count:long,is_canonical:boolean>>"
    ents = spark.createDataFrame([(n, "CONCEPT", 1, [(n, 1, True)]) for n in ("가람", "나무")], "canonical_name string, entity_type string, mention_count long, " + alias).withColumn("entity_id", stable_id("entity", F.col("canonical_name")))
    types = spark.createDataFrame([("한다", "POSITIVE", 1, [("한다", 1, True)])], "canonical_name string, polarity string, mention_count long, " + alias).withColumn("relation_type_id", stable_id("relation_type", F.col("canonical_name")))
    index = types.select(F.col("canonical_name").alias("name"), F.col("relation_type_id").alias("id"), "canonical_name")
    b = graphmap.map_to_graph(mentions(raw), dictionary.alias_index(ents, "entity_id"), index, types)
    return units, raw, ents, types, b


def failing(row):
    return {k for k, v in row.asDict().items() if v and k != "passed"}


def changed(raw, **fields):
    r = F.col("relations")[0]
    for k, v in fields.items():
        r = r.withField(k, F.lit(v))
    return raw.withColumn("relations", F.array(r))


def test_whole_raw_audit(spark):
    units, raw, *_ = release(spark)
    assert audit.audit_raw_release(units.unionByName(units), raw).first().passed
    for bad, checks in (
        (raw.withColumn("document_title", F.lit("x")), {"changed_sources"}), (raw.withColumn("unit_seq", F.lit(5).cast("long")), {"moved_records"}),
        (raw.withColumn("relations", F.lit(None).cast(raw.schema["relations"].dataType)), {"records_without_list"}),
        (changed(raw, object="물"), {"wrong_ids"}), (raw.withColumn("relations", F.concat("relations", "relations")), {"doubled_triples", "doubled_mentions"}),
        (raw.unionByName(raw.withColumn("relations", F.slice("relations", 1, 0))), {"conflicting_records"}),
    ):
        row = audit.audit_raw_release(units, bad).first()
        assert failing(row) == checks and not row.passed
    assert failing(audit.audit_raw_release(units.unionByName(units.withColumn("unit_text", F.lit("z"))), raw).first()) == {"conflicting_units"}
    counts = lambda r: {x["name"]: x.n for x in audit.raw_quality(r, units).collect() if x.n}
    assert counts(raw) == {"n_mentions": 1}
    assert counts(changed(raw, subject="환경법에 따른 각서", predicate="내거나 받는다", object="3년 이내, 사항")) == {
        "n_mentions": 1, "n_legal_qualifiers": 1, "n_numeric_constraints": 1, "n_enumerations": 2, "n_context_only_relations": 1}
    assert counts(changed(raw, object=" 사항 "))["n_generic_endpoints"] == 1


def test_whole_dictionary_audit(spark):
    _, raw, ents, types, _ = release(spark)
    whole = lambda e=ents, t=types, r=raw, n=1: failing(audit.audit_dictionary_release(e, t, r, n).first())
    assert whole() == set() and audit.audit_dictionary_release(ents, types, raw, 1).first().passed
    one = lambda name: [(name, 1, True)]
    other = spark.createDataFrame([("3년 이내", "CONCEPT", 1, one("3년 이내") + [("이 법", 1, False)])], "canonical_name string, entity_type string, mention_count long, aliases array<struct<name:string,mention_count:long,is_canonical:boolean>>").withColumn("entity_id", stable_id("entity", F.col("canonical_name")))
    assert whole(e=ents.unionByName(other)) == {"numeric_names", "self_reference_aliases"}
    assert whole(e=ents.withColumn("scope", F.lit("x"))) == {"scope_fields"}
    assert whole(e=ents.unionByName(ents.withColumn("mention_count", F.lit(9).cast("long")))) == {"conflicting_ids"}
    assert whole(r=changed(raw, subject="없음", predicate="모르다")) == {"unmapped_names", "unmapped_predicates"} and whole(n=98) == {"types_unexpected"}
    assert whole(t=types.drop("aliases")) == {"types_not_led_by_canonical"}
    assert whole(t=types.withColumn("relation_type_id", F.lit("x"))) == {"wrong_type_ids"}
    assert whole(t=types.unionByName(types.withColumn("relation_type_id", F.lit("x"))), n=2) == {"wrong_type_ids", "doubled_type_names", "type_alias_conflicts"}
    assert whole(t=types.unionByName(types.withColumn("mention_count", F.lit(9).cast("long")))) == {"conflicting_type_ids"}
    many = spark.range(100).select(F.col("id").cast("string").alias("canonical_name"), F.lit("POSITIVE").alias("polarity"), F.lit(1).cast("long").alias("mention_count"))
    many = many.withColumn("aliases", F.array(F.struct(F.col("canonical_name").alias("name"), F.lit(1).cast("long").alias("mention_count"), F.lit(True).alias("is_canonical")))).withColumn("relation_type_id", stable_id("relation_type", F.col("canonical_name")))
    assert whole(t=types.unionByName(many), n=101) == {"types_too_many"}


def test_whole_graph_audit(spark):
    units, raw, _, _, b = release(spark)

    def whole(relations=b.relations, evidence=b.evidence, entities=b.entities, types=b.relation_types, units=units, documents=b.documents, raw=raw):
        return failing(audit.audit_graph_release(relations, evidence, entities, types, units, documents, raw).first())

    no = F.lit(None).cast("string")
    assert whole() == set() and whole(raw=None) == set()
    assert whole(relations=b.relations.withColumn("target_entity_id", no)) == {"null_references"}
    assert whole(relations=b.relations.unionByName(b.relations.withColumn("source_entity_id", F.col("target_entity_id")))) == {"conflicting_relations"}
    assert whole(entities=b.entities.withColumn("entity_type", F.lit("X"))) == {"unknown_entity_types"}
    assert whole(entities=b.entities.unionByName(b.entities.withColumn("canonical_name", F.lit("x")))) == {"conflicting_entities"}
    assert whole(types=b.relation_types.unionByName(b.relation_types.withColumn("polarity", F.lit("NEGATIVE")))) == {"conflicting_types"}
    assert whole(types=b.relation_types.withColumn("relation_type_id", F.lit("x"))) == {"malformed_type_ids", "type_orphans"}
    assert whole(entities=b.entities.withColumn("entity_id", F.lit("x"))) >= {"malformed_entity_ids"}
    assert whole(relations=b.relations.withColumn("relation_id", F.lit("x"))) >= {"malformed_relation_ids"}
    assert whole(documents=b.documents.limit(0)) == {"units_without_document"} and whole(units=units.withColumn("unit_kind", no)) == {"units_without_source"}
    assert whole(units=units.unionByName(units.withColumn("unit_text", F.lit("z")))) == {"conflicting_units"}
    assert whole(evidence=b.evidence.withColumn("semantic_unit_id", no)) == {"evidence_without_unit"}
    assert whole(evidence=b.evidence.withColumn("source_ref", F.col("source_ref").withField("article", F.lit("제9조")))) == {"misplaced_evidence"}
    assert whole(evidence=b.evidence.withColumn("relation_mention_id", F.lit("x"))) == {"mentions_without_evidence", "evidence_without_mention"}
    assert whole(raw=raw.limit(0)) == {"units_without_record", "evidence_without_mention"}
    assert whole(raw=raw.unionByName(raw.withColumn("document_id", F.lit("d0")))) == {"conflicting_records"}


EDGES = "relation_id string, source_entity_id string, source_name string, relation_type_id string, relation_type_name string, target_entity_id string, target_name string, evidence_count long"


def random_edges(rng, n_nodes=14, n_edges=45):
    out = []
    for i in range(n_edges):
        a, b = rng.randrange(n_nodes), rng.randrange(n_nodes)
        out.append((f"r{i:02d}", f"e{a}", f"이름{a}", "t", rng.choice(["한다", "정한다"]), f"e{b}", f"이름{b}", rng.randrange(1, 9)))
    return out


def compact(x):
    return "".join(c for c in x.lower() if c.isascii() and c.isalnum() or "가" <= c <= "힣")


def relevance(e, query, cur, branching, rscore):
    s = rscore.get(e[0], 0.0)
    for v, w in ((e[2], 0.35), (e[6], 0.35), (e[4], 0.25)):
        v = compact(v)
        s += w * (min(1.0, len(v) / 10) if len(v) >= 2 and v in compact(query) else 0.0)
    s += min(0.2, math.log1p(e[7]) / 20) - min(0.22, math.log1p(max(0, branching - 1)) / 18)
    if any(c in query for c in paths.ACTOR_CUES) and cur == e[5]:
        s += 0.15
    if any(c in query for c in paths.TARGET_CUES) and cur == e[1]:
        s += 0.15
    return round(s, 9)


def beam_model(edges, seeds, query, b, rscore):
    states = [((e,), (n,), (), s) for e, n, s in sorted(seeds, key=lambda x: (-x[2], x[0]))[: b.beam]]
    out = []
    for hop in range(1, b.hops + 1):
        front = sorted({s[0][-1] for s in states})
        near = {}
        for f in front:
            inc = sorted((e for e in edges if f in (e[1], e[5])), key=lambda e: (e[0] not in rscore, -e[7], e[0]))[: b.per_entity]
            near |= {e[0]: e for e in inc}
        got = sorted(near.values(), key=lambda e: (e[0] not in rscore, -e[7], e[0]))[: max(1, min(5000, len(front) * b.per_entity * 2))]
        adj = collections.defaultdict(list)
        for e in got:
            for end in (e[1], e[5]):
                if end in front:
                    adj[end].append(e)
        nxt = []
        for ids, names, rels, score in states:
            cur = ids[-1]
            ranked = sorted(adj[cur], key=lambda e: (-relevance(e, query, cur, len(adj[cur]), rscore), e[0]))[: b.per_entity]
            for e in ranked:
                o, name = (e[5], e[6]) if e[1] == cur else (e[1], e[2])
                if o not in ids:
                    nxt.append(((*ids, o), (*names, name), (*rels, e[0]), round(score + relevance(e, query, cur, len(adj[cur]), rscore) / hop, 9)))
        out += nxt
        states = sorted(nxt, key=lambda s: (-s[3], s[0], s[2]))[: b.beam]
        if not states:
            break
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_beam_search_against_a_plain_walk(spark, seed):
    rng = random.Random(seed)
    edges = random_edges(rng)
    query = "누가 이름3 그리고 이름7을 거쳐 정한다"
    seeds = [("e0", "이름0", 1.0), ("e5", "이름5", 0.5)]
    rscore = {"r03": 1.0, "r11": 0.4}
    b = paths.SearchBounds(hops=3, per_entity=3, beam=6)
    found = paths.find_paths(spark.createDataFrame(seeds, "entity_id string, name string, score double"), spark.createDataFrame(edges, EDGES), query, b, spark.createDataFrame(list(rscore.items()), "relation_id string, rscore double"))
    got = {(tuple(r.entity_ids), tuple(r.relation_ids)): r.score for r in found.collect()}
    want = {(s[0], s[2]): s[3] for s in beam_model(edges, seeds, query, b, rscore)}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-6 for k in got)


def test_a_spent_budget_ends_the_search(spark):
    edges = spark.createDataFrame(random_edges(random.Random(3)), EDGES)
    now = [0.0]
    b = paths.TimeBudget(10, lambda: now[0])
    assert paths.find_paths([("e0", "이름0", 1.0)], edges, "q", paths.SearchBounds(hops=1), budget=b).count() > 0
    now[0] = 10
    assert paths.find_paths([("e0", "이름0", 1.0)], edges, "q", paths.SearchBounds(hops=1), budget=b).count() == 0


def store(spark):
    edges = [("r1", "a", "가람원", "t", "보낸다", "b", "나라청", 2), ("r2", "b", "나라청", "t", "받는다", "c", "다온원", 1), ("r3", "c", "다온원", "t", "알린다", "d", "라온청", 1)]
    ev = spark.createDataFrame([(f"m{i}", f"r{i}", f"u{i}", "s", "p", "o") for i in (1, 2, 3)] + [("m1", "r1", "u1", "s", "p", "o"), ("m9", "r1", None, "s", "p", "o")], "relation_mention_id string, relation_id string, semantic_unit_id string, raw_subject string, raw_predicate string, raw_object string")
    units = spark.createDataFrame([(f"u{i}", f"d{i}", ("제1조", i, []), "맥락", f"본문 {i}") for i in (1, 2, 3)], f"semantic_unit_id string, document_id string, source_ref {REF}, context_text string, unit_text string")
    docs = spark.createDataFrame([(f"d{i}", f"문서{i}") for i in (1, 2, 3)], "document_id string, document_title string")
    ents = spark.createDataFrame([("a", "가람원"), ("b", "나라청"), ("c", "다온원"), ("d", "라온청")], "entity_id string, canonical_name string")
    return GraphStore(ents, spark.createDataFrame(edges, EDGES), ev, units, docs, embed(ents, "entity_id", "canonical_name", HashEmbedding))


def test_search_of_a_chain(spark, tmp_path):
    s = prepare(replace(store(spark), entity_vectors=None))
    r = search(spark, s, "가람원은 라온청과 어떻게 연결되는가?", paths.SearchBounds(paths=20))
    rows = r["paths"].orderBy("rank").collect()
    whole = [x for x in rows if x.entity_names == ["가람원", "나라청", "다온원", "라온청"]]
    assert whole and whole[0].document_ids == ["d1", "d2", "d3"] and [x["rank"] for x in rows] == list(range(1, len(rows) + 1))
    text, cited = grounded_answer(r)
    assert cited[0]["key"] == "E1" and "[E1]" in text
    assert written_answer(spark, "q", r, StubCompletion(lambda p: "답 [E1]"))[1] == "written"
    assert written_answer(spark, "q", r, StubCompletion(lambda p: "답 [E99]"))[1] == "invalid_citations"
    nodes, links = paths.graph_payload(r["paths"], r["candidates"])
    assert {n.id for n in nodes.collect()} == {"a", "b", "c", "d"} and links.count() == 3
    m = sinks.write_search(r, "질문", text, nodes, links, str(tmp_path / "run"))
    assert len(m["files"]) == 6 and len(json.loads((tmp_path / "run/graph.json").read_text())["edges"]) == 3
    notes: dict = {}
    late = search(spark, s, "가람원은 라온청과 어떻게 연결되는가?", paths.SearchBounds(), budget=paths.TimeBudget(0.0), diagnostics=notes)
    assert notes["status"] == "timeout" and late["paths"].count() == 0 and late["candidates"].count() > 0
    rows = [{"question_id": "crossdoc-01-x", "question": "질문", "answer": text, "found_by": "exact_relations"}, {"question_id": "crossdoc-02-y", "question": "둘", "answer": "", "found_by": None}]
    made = sinks.write_questions(spark, rows, str(tmp_path / "qa"))
    assert [f["path"] for f in made["files"]] == ["answers/crossdoc-01-x.md", "answers/crossdoc-02-y.md", "questions.jsonl"] and not made["passed"]
    assert sinks.verify_manifest(spark, str(tmp_path / "qa")) == []
    with pytest.raises(ValueError):
        paths.SearchBounds(hops=4)


def test_cross_document_questions(spark):
    s = store(spark)
    docs = s.evidence.join(s.units, "semantic_unit_id").select("relation_id", "document_id")
    found = paths.cross_document_candidates(s.edges, docs)
    assert {(r.left_relation_id, r.right_relation_id) for r in found.collect()} == {("r1", "r2"), ("r2", "r3")}
    assert len(paths.select_questions(found, 10)) == 2
    assert paths.select_questions(found, 10)[0]["question_id"].startswith("crossdoc-01-")
    # the two documents come from different edges
    mixed = spark.createDataFrame([("r1", "A"), ("r1", "Z"), ("r2", "M"), ("r2", None), ("r3", "M"), ("r3", "N")], "relation_id string, document_id string")
    pairs = {(r.left_relation_id, r.right_relation_id): (r.doc_a, r.doc_b) for r in paths.cross_document_candidates(s.edges, mixed).collect()}
    assert pairs == {("r1", "r2"): ("A", "M"), ("r2", "r3"): ("M", "N")}
    same = docs.withColumn("document_id", F.lit("d"))
    assert paths.cross_document_candidates(s.edges, same).count() == 0


def test_bm25_and_neighbours(spark):
    docs = spark.createDataFrame([("a", "가 나 나"), ("b", "가 가 다 라"), ("c", None), ("d", "")], "id string, t string")
    q = spark.createDataFrame([(1, "나 가 없음"), (2, "없음")], "query_id long, text string")
    assert [(r.query_id, r.doc, r["rank"]) for r in retrieval.bm25(docs, "id", "t", q, 5).orderBy("rank").collect()] == [(1, "a", 1), (1, "b", 2)]
    assert retrieval.bm25(docs.limit(0), "id", "t", q, 5).count() == 0
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [0.5, 0.5]), (4, None), (5, [1.0, 0.0]), (6, [1.0])], "id long, v array<double>")
    got = retrieval.nearest(v, "id", "v", v.filter("id = 1").withColumnRenamed("id", "query_id"), 2).orderBy("rank").collect()
    assert [r.doc for r in got] == [1, 5]
    assert [r[0] for r in v.select(retrieval.normalise(F.col("v"))).collect()][:2] == [[1.0, 0.0], None]


def test_questions_with_particles_find_relations(spark):
    s = store(spark)
    edges = s.edges.unionByName(s.edges.limit(1))
    q = spark.createDataFrame([(1, "가람원은 다온원과 어떻게 연결되는가?"), (2, "나라청 받는다"), (3, "없음")], "query_id long, text string")
    got = {(r.query_id, r.doc): (r.score, r["rank"]) for r in retrieval.keyword_relations(edges, q, 9).collect()}
    # no word of the first question is a name; every name is a term of it
    assert {k: v for k, v in got.items() if k[0] == 1} == {(1, "r1"): (12.0, 1), (1, "r2"): (12.0, 2), (1, "r3"): (12.0, 3)}
    assert got[2, "r2"][1] == 1 and got[2, "r2"][0] > 24 > got[2, "r1"][0] > 12 and {k[1] for k in got if k[0] == 2} == {"r1", "r2"}
    found = search(spark, replace(s, entity_vectors=None), "가람원은 라온청과 어떻게 연결되는가?", paths.SearchBounds())["relations"]
    assert {r.relation_id for r in found.collect()} == {"r1", "r3"}


def test_aliases_and_relation_vectors_find_candidates(spark):
    s = store(spark)
    e = s.entities.withColumn("aliases", F.when(F.col("entity_id") == "a", F.array(F.struct(F.lit("하람실").alias("name")), F.struct(F.lit("하람실험").alias("name")))))
    q = spark.createDataFrame([(1, "하람실은 나라청과?")], "query_id long, text string")
    got = retrieval.keyword_names(retrieval.entity_names(e), "entity_id", "name", q, 9).collect()
    assert [(r.doc, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [("a", 12.0), ("b", 12.0)]
    r = search(spark, replace(s, entities=e, entity_vectors=None), "하람실은?", paths.SearchBounds())
    assert [x.entity_id for x in r["candidates"].collect()] == ["a"]
    text = s.edges.select("relation_id", F.concat_ws(" ", "source_name", "relation_type_name", "target_name").alias("t"))
    vectors = embed(text, "relation_id", "t", HashEmbedding)
    r = search(spark, replace(s, relation_vectors=vectors), "다온원 알린다 라온청", paths.SearchBounds(), top_relations=1, embedder=HashEmbedding)
    assert [x.relation_id for x in r["relations"].collect()] == ["r3"]
    r = search(spark, replace(s, relation_vectors=vectors), "모름", paths.SearchBounds(), embedder=HashEmbedding)
    assert {x.relation_id for x in r["relations"].collect()} == {"r1", "r2", "r3"}


def test_registered_question_yields_relation_candidates(spark):
    from sparkloom.plans.graph_queries import QUESTION, run_search

    assert run_search(spark, "/root/testdata/sf0.01", QUESTION, paths.SearchBounds(hops=1))["relations"].count() == 20


def test_readers_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, 'b "q"\n줄', None), (1, "a", ["x"])], "id long, name string, tags array<string>")
    sinks.write_jsonl(df, str(tmp_path / "j"), ["name"])
    assert all(x.startswith('{"name"') for p in (tmp_path / "j").glob("part*.json") for x in p.read_text().splitlines())
    back = readers.read_jsonl(spark, str(tmp_path / "j"), df.schema)
    assert sorted(map(str, back.select(*df.columns).collect())) == sorted(map(str, df.collect()))
    with pytest.raises(Exception, match="exists"):
        sinks.write_jsonl(df, str(tmp_path / "j"))
    (tmp_path / "bad.jsonl").write_text("{nope\n")
    with pytest.raises(Exception):  # noqa: B017
        readers.read_jsonl(spark, str(tmp_path / "bad.jsonl"), "id long").collect()
    ents = spark.createDataFrame([("e1", '가 "나"\n다', "CONCEPT", 1, [("가", 1, True)])], "entity_id string, canonical_name string, entity_type string, mention_count long, aliases array<struct<name:string,mention_count:long,is_canonical:boolean>>")
    assert sinks.write_rdb({"entity": ents}, str(tmp_path / "rdb")) == ["entity"]
    assert [r[0] for r in readers.csv_ids(spark, str(tmp_path / "rdb/entity"), "canonical_name").collect()] == ['가 "나"\n다']
    assert "ON CONFLICT (entity_id)" in (tmp_path / "rdb/load.sql").read_text()
    sinks.write_bulk(ents, "entity_id", "entities", str(tmp_path / "bulk"))
    lines = "".join(p.read_text() for p in (tmp_path / "bulk").glob("part*.txt")).splitlines()
    assert json.loads(lines[0]) == {"index": {"_index": "entities", "_id": "e1"}} and json.loads(lines[1])["canonical_name"] == '가 "나"\n다'
    assert [r.id for r in readers.bulk_ids(spark, str(tmp_path / "bulk")).collect()] == ["e1"]
    n = spark.range(1000).withColumn("g", F.col("id") % 3)
    assert [r[0] for r in sinks.numbered(n, ["g", "id"], parts=7).orderBy("g", "id").select("node_number").collect()] == list(range(1, 1001))
    big = spark.range(400_000, numPartitions=64).select(F.xxhash64("id").alias("h"), "id")  # more rows than the sampler of ranges takes
    many = sinks.numbered(big, ["h"])
    for _ in range(2):
        assert many.agg(F.count_distinct("node_number"), F.min("node_number"), F.max("node_number")).first()[:] == (400_000, 1, 400_000)
    assert many.join(many.withColumnRenamed("h", "h2").withColumn("node_number", F.col("node_number") - 1), "node_number").filter("h >= h2").count() == 0
    assert sinks.index_mapping(["name"], ["id"], 8)["mappings"]["dynamic"] == "strict"
    (tmp_path / "s.toml").write_text('[run]\nhops = 3\nin_path = "x"\n')
    assert readers.read_settings(str(tmp_path / "s.toml"))["run"]["in_path"] == str(tmp_path / "x")
    with pytest.raises(ValueError):
        readers.read_settings(str(tmp_path / "s.toml"), {"run.hops": (1, 2)})
    with pytest.raises(ValueError):
        readers.load_prompt(str(tmp_path), "../x")
    (tmp_path / "o.jsonl").write_text('{"canonical_name":"A","aliases":["x"]}\n{"canonical_name":"B","aliases":["x"]}\n')
    with pytest.raises(ValueError):
        readers.read_overrides(spark, str(tmp_path / "o.jsonl"))


def test_published_versions(spark, tmp_path):
    for v in ("v1", "v2"):
        (tmp_path / v).mkdir()
        (tmp_path / v / "a.txt").write_text(v)
        sinks.write_manifest(spark, str(tmp_path / v))
    assert sinks.publish(spark, str(tmp_path), "v1") == sinks.current(spark, str(tmp_path))
    (tmp_path / "v2/a.txt").write_text("changed")
    (tmp_path / "v2/b.txt").write_text("new")
    assert sinks.verify_manifest(spark, str(tmp_path / "v2")) == ["changed a.txt", "unlisted b.txt"]
    with pytest.raises(ValueError):
        sinks.publish(spark, str(tmp_path), "v2")
    assert sinks.current(spark, str(tmp_path)).endswith("v1")


def test_merging_and_evidence_samples(spark):
    a = spark.createDataFrame([("k", 1, 1), ("k", 2, 2), ("l", 5, 1)], "k string, v int, seq int")
    b = spark.createDataFrame([("k", 9, 0), (None, 1, 1)], a.schema)
    assert sorted((r.k, r.v) for r in dictionary.merge_last_wins(a, b, "k", ["seq"]).collect()) == [("k", 9), ("l", 5)]
    ends = endpoints(mentions(raw(spark, [[("가", "p", "나")]] * 5)))
    units = spark.createDataFrame([(f"u{i}", f"본문 {i} " * 300, None) for i in range(4)], "semantic_unit_id string, unit_text string, context_text string")
    got = {r["name"]: r.samples for r in dictionary.evidence_samples(ends, units, 2).collect()}
    assert [(s.semantic_unit_id, len(s.unit_text), s.context_text) for s in got["가"]] == [("u0", 500, ""), ("u1", 500, "")]


def test_clients(spark):
    units = spark.createDataFrame([("u1", "맥락", "본문", "paragraph"), ("u2", "맥락", "깨짐", "terminal_item"), ("u3", None, "오류", "terminal_item")], "semantic_unit_id string, context_text string, unit_text string, unit_kind string")

    def answer(prompt):
        if "오류" in prompt:
            raise RuntimeError("down")
        return "no json" if "깨짐" in prompt else '{"relations":[{"subject":"a","predicate":"b","object":"c"}]}'

    good, bad = extract_relations(units, lambda: StubCompletion(answer))
    assert [r.semantic_unit_id for r in good.collect()] == ["u1"]
    assert {r.semantic_unit_id: r.error for r in bad.collect()} == {"u2": "no relations object", "u3": "RuntimeError: down"}
    r = resolve_contexts(units, lambda: StubCompletion(lambda p: '{"resolved_text":"x","resolution_type":"CONTEXT_INHERITED"}'))
    assert {x.semantic_unit_id: x.resolution_type for x in r.collect()} == {"u1": "COPIED", "u2": "CONTEXT_INHERITED", "u3": "CONTEXT_INHERITED"}
    assert check_loopback("http://127.0.0.1:8/v1") and check_loopback("http://localhost/")
    with pytest.raises(ValueError):
        check_loopback("https://models.example/")


def test_contexts_of_all_units_are_resolved(spark):
    rows = [("u1", "c", "본문", None), ("u2", "c", "둘째", "terminal_item"), ("u2", "c", "둘째", "terminal_item"), ("u3", None, "셋째", "terminal_item"), ("u4", "c", "넷째", "terminal_item"), ("u5", "c", None, None)]
    units = spark.createDataFrame(rows, "semantic_unit_id string, context_text string, unit_text string, unit_kind string")
    answers = {"둘째": '```json\n{"resolved_text":" c 둘째 ","resolution_type":"COPIED"}\n```', "셋째": '{"resolved_text":"셋째"}', "넷째": '{"resolved_text":" ","resolution_type":"COPIED"}'}
    got = resolve_contexts(units, lambda: StubCompletion(lambda p: answers[p[-2:]])).collect()
    assert sorted((r.semantic_unit_id, r.resolved_text, r.resolution_type) for r in got) == [
        ("u1", "본문", "COPIED"), ("u2", "c 둘째", "CONTEXT_INHERITED"), ("u3", "셋째", "COPIED"), ("u4", None, "UNRESOLVED"), ("u5", None, "COPIED")]


def test_ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.md").write_text("# 규정\n##### 제1조(목적)\n가람원은 보고서 및 장부를 제출한다.\n")
    rt = spark.createDataFrame([("r1", "제출한다", "POSITIVE")], "relation_type_id string, canonical_name string, polarity string")
    ix = spark.createDataFrame([("가람원", "e1", "가람원")], "name string, id string, canonical_name string")
    stub = lambda: StubCompletion(lambda p: '{"relations":[{"subject":"가람원","predicate":"제출한다","object":"보고서 및 장부"}]}')
    b = ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), stub, ix, rt)
    assert {r.target_name for r in b.relations.collect()} == {"보고서", "장부"}
    files = {f["path"].split("/")[1] for f in json.loads((tmp_path / "out/manifest.json").read_text())["files"] if f["path"].startswith("rdb/")}
    assert {"document", "semantic_unit", "entity", "relation", "relation_evidence", "schema.sql", "load.sql"} <= files


def test_streamed_ingest_adds_nothing_twice(spark, tmp_path):
    src, out = tmp_path / "json", tmp_path / "out"
    src.mkdir()

    def run():
        good_bad = lambda df: (df.filter("v > 0"), df.filter("v <= 0"))
        q = ingest_stream(spark, str(src), "k string, v int", str(out), str(tmp_path / "cp"), good_bad, "k", 1)
        q.awaitTermination()

    (src / "1.json").write_text('{"k":"a","v":1}\n{"k":"b","v":0}\n')
    run()
    (src / "2.json").write_text('{"k":"a","v":1}\n{"k":"c","v":2}\n{"k":"c","v":2}\n')
    run()
    assert sorted(r.k for r in spark.read.parquet(str(out / "records")).collect()) == ["a", "c"]
    (src / "3.json").write_text('{"k":"b","v":5}\n{"k":"c","v":9}\n')
    run()
    assert sorted((r.k, r.v) for r in spark.read.parquet(str(out / "records")).collect()) == [("a", 1), ("b", 5), ("c", 2)]
    assert [r.k for r in spark.read.parquet(str(out / "errors")).collect()] == ["b"]
    # a target that cannot be read fails the batch; it is not taken for an empty one
    for p in (out / "keys").rglob("*.parquet"):
        p.write_bytes(b"broken")
        (p.parent / f".{p.name}.crc").unlink(missing_ok=True)
    (src / "4.json").write_text('{"k":"a","v":1}\n')
    with pytest.raises(Exception):
        run()
