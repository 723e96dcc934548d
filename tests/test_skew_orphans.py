import collections
import random

import pytest
from pyspark.sql import functions as F

from sparkloom.operators.bloom import filter_sizes, with_membership
from sparkloom.operators.orphans import orphan_references
from sparkloom.operators.skew import hot_key_totals, hot_keys, hot_salts, salted_join

REL = "relation_id string, source_entity_id string, target_entity_id string, evidence_count long, n_all string, _w int, entity_id string"


def rel(rows):
    return [(*r, "x", 1, "clash") for r in rows]


def test_hot_key_totals_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(f"r{i}", "hub" if rng.random() < 0.4 else f"s{rng.randrange(50)}", None if i % 17 == 0 else f"t{rng.randrange(9)}", None if i % 11 == 0 else rng.randrange(5)) for i in range(800)]
    doubled = rows + rows[:60] + [(None, "hub", "t1", 9)]
    n, w = collections.Counter(), collections.Counter()
    for _, s, t, c in rows:
        for f, e in (("source_entity_id", s), ("target_entity_id", t)):
            if e is not None:
                n[f, e] += 1
                w[f, e] += c or 0
    got = hot_key_totals(spark.createDataFrame(rel(doubled), REL), "relation_id", ["source_entity_id", "target_entity_id"], "evidence_count")
    assert {(r.field_name, r.entity_id): (r.n_records, r.sum_weight, r.n_all) for r in got.collect()} == {k: (n[k], w[k], 800) for k in n}
    assert {(r.field_name, r.entity_id) for r in hot_keys(got).collect()} == {k for k in n if n[k] * 40 > 800}


def test_hot_key_totals_of_nothing_and_of_nulls(spark):
    fields = ["source_entity_id", "target_entity_id"]
    assert hot_key_totals(spark.createDataFrame([], REL), "relation_id", fields, "evidence_count").count() == 0
    only_null = spark.createDataFrame(rel([("r1", None, None, None), ("r2", "a", None, None)]), REL)
    assert [tuple(r) for r in hot_key_totals(only_null, "relation_id", fields, "evidence_count").collect()] == [("source_entity_id", "a", 1, 0, 2, 0)]


def test_records_and_totals_are_read_once(spark):
    """The totals come from the exchange of the keys, and records are removed by hash, not by sort."""
    df = spark.createDataFrame(rel([(f"r{i}", f"s{i % 7}", f"t{i % 5}", 1) for i in range(100)]), REL).repartition(4)
    for q in (hot_key_totals(df, "relation_id", ["source_entity_id", "target_entity_id"], "evidence_count"),):
        for plan in (q, hot_keys(q).select("field_name", "entity_id")):
            plan.collect()
            text = plan._jdf.queryExecution().executedPlan().toString()
            assert "ReusedExchange" in text and "SortAggregate" not in text


def test_only_hot_keys_get_salts(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, "a").when(F.col("id") < 500, "b").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"))
    assert sorted(hot_salts(df, ["k"], tasks=20)) == [("a", 8), ("b", 2)]
    assert hot_salts(df.filter("k like 'k%'"), ["k"], tasks=20) == []
    assert hot_salts(df.limit(0), ["k"], tasks=20) == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    big = spark.createDataFrame([(i, "hot" if i % 3 else (None if i % 2 else f"k{i % 7}"), "s") for i in range(200)], "id long, k string, _salt string")
    small = spark.createDataFrame([("hot", 1), ("k3", 2), ("k3", 3), ("zz", 4)], "k string, v int")
    a = salted_join(big, small, ["k"], F.col("id"), how)
    b = big.join(small, "k", how)
    assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))


def test_salted_outer_joins_are_refused(spark):
    with pytest.raises(ValueError):
        salted_join(spark.range(1), spark.range(1), ["id"], F.col("id"), "full_outer")


REFS = "rid string, ref string, made timestamp_ntz, reason string, _spans int"
PARENTS = "pid string, created timestamp_ntz, deleted timestamp_ntz, ref string"


def day(n):
    import datetime

    return None if n is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n)


def brute(refs, parents):
    out = set()
    for rid, ref, made in refs:
        if rid is None or ref is None:
            continue
        own = [(c, d) for p, c, d in parents if p == ref]
        if not own:
            why = "missing"
        elif made is None or any((c is None or c <= made) and (d is None or d > made) for c, d in own):
            continue
        else:
            why = "deleted" if any(c is None or c <= made for c, d in own) else "later"
        out.add((rid, ref, why))
    return out


@pytest.mark.parametrize("spans_per_row", [1, 64])
def test_orphans_against_brute_force(spark, spans_per_row):
    rng = random.Random(3)
    parents = [(f"p{i % 40}", rng.choice([0, 10, 20, None]), rng.choice([None, None, 15, 30])) for i in range(60)]
    parents = [(p, day(c), day(d)) for p, c, d in parents] + [(None, day(1), None)]
    refs = [(f"r{i}", "p1" if i % 3 == 0 else f"p{rng.randrange(60)}", day(rng.choice([5, 10, 15, 25, 30, 35, None]))) for i in range(300)] + [("rn", None, day(1)), (None, "p99", day(1))]
    refs += refs[:20]
    r = spark.createDataFrame([(*x, "c", 1) for x in refs], REFS)
    p = spark.createDataFrame([(*x, "c") for x in parents] * 2, PARENTS)
    got = orphan_references(r, "rid", "ref", "made", p, "pid", "created", "deleted", spans_per_row=spans_per_row)
    rows = got.collect()
    assert {(x.row_id, x.ref, x.reason) for x in rows} == brute(refs, parents)
    assert len(rows) == len({(x.row_id, x.ref, x.period) for x in rows})
    assert {x.period for x in rows} <= {"2024-01", "2024-02", None}


def test_orphans_of_empty_tables(spark):
    r = spark.createDataFrame([("r", "a", day(1), "c", 1)], REFS)
    none, parents = spark.createDataFrame([], REFS), spark.createDataFrame([], PARENTS)
    args = ("rid", "ref", "made"), ("pid", "created", "deleted")
    assert [x.reason for x in orphan_references(r, *args[0], parents, *args[1]).collect()] == ["missing"]
    assert orphan_references(none, *args[0], parents, *args[1]).count() == 0


def test_a_small_filter_is_sliced_and_loses_nothing(spark):
    parents = [(f"p{i}", day(0), None, "c") for i in range(4000)]
    refs = [(f"r{i}", f"p{i * 2}", day(1), "c", 1) for i in range(4000)]
    p, r = spark.createDataFrame(parents, PARENTS), spark.createDataFrame(refs, REFS)
    bits, slices = filter_sizes(4000, filter_bytes=1 << 10)
    assert (bits, slices) == (1 << 13, 6)
    probed = with_membership(r, ["ref"], p, ["pid"], 4000, "maybe", filter_bytes=1 << 10)
    assert probed.count() == 4000 and probed.filter("maybe").count() < 2100
    got = orphan_references(r, "rid", "ref", "made", p, "pid", "created", "deleted", filter_bytes=1 << 10)
    assert got.count() == 2000


def test_the_rate_of_false_positives_does_not_grow():
    for n in (10**5, 10**8, 10**10):
        bits, slices = filter_sizes(n)
        assert bits // 8 <= 64 << 20 and bits * slices >= 12 * n
