import collections

import pytest
from pyspark.sql import functions as F

from sparkloom.llm.canonical_map import Dictionary
from sparkloom.llm.lookalikes import table_form
from sparkloom.llm.queries import QUERIES, SQL
from sparkloom.runtime import table
from tests.compare import oracle, same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    equal, *_, diff = same(QUERIES[name](spark, SF), oracle(SF), SQL[name])
    assert equal, diff


def mentions(spark):
    return [r.r for r in table(spark, SF, "raw_svo").select(F.explode("relations").alias("r")).collect()]


def test_lookalikes_against_comparing_all_forms(spark):
    ents = {(r.entity_id, r.canonical_name) for r in table(spark, SF, "entity").select("entity_id", "canonical_name").collect()}
    by = collections.defaultdict(set)
    for e, n in ents:
        by[table_form(n)].add((e, n))
    want = {("canonical_name", a, b) for g in by.values() for a, _ in g for b, _ in g if a < b}
    for m in mentions(spark):
        for f in ("subject", "object"):
            want |= {(f, m.relation_mention_id, e) for e, n in by.get(table_form(m[f]), ()) if n != m[f]} if m[f] is not None else set()
    got = [tuple(r) for r in QUERIES["p3_found"](spark, SF).select("field_name", "row_id", "entity_id").collect()]
    assert set(got) == want and len(got) == len(want) > 0


def test_mapping_against_one_dictionary(spark):
    lists = {
        "predicate": [(r.relation_type_id, r.canonical_name) for r in table(spark, SF, "relation_type").collect()],
        "subject": [(r.ref_id, r.canonical_name) for r in table(spark, SF, "entity_reference").collect()],
    }
    lists["object"] = lists["subject"]
    used = collections.Counter(m[f] for m in mentions(spark) for f in ("subject", "object"))
    want = set()
    for f, rows in lists.items():
        freq = collections.Counter(m[f] for m in mentions(spark)) if f == "predicate" else used
        d = Dictionary.build([(i, n, freq[n]) for i, n in rows], "verb" if f == "predicate" else "name", 2 if f == "predicate" else 3)
        own = {n for _, n in rows}
        want |= {(m.relation_mention_id, f, hit[0]) for m in mentions(spark) if m[f] not in own and (hit := d.lookup(m[f]))}
    got = [tuple(r) for r in QUERIES["p4_found"](spark, SF).select("relation_mention_id", "field_name", "ref_id").collect()]
    assert set(got) == want and len(got) == len(want) > 0


def test_every_problem_has_its_query():
    assert {"p2_found", "p3_found", "p4_found", "p6_found", "p7_found", "p8_ids", "p9_found", "p10_found"} <= set(QUERIES)
    assert list(SQL) and set(SQL) <= set(QUERIES)
