import collections
import json
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkloom.llm.format_dupes import Ledger, canonical_key, copies, duplicate_ledger, with_single_relation
from sparkloom.llm.split_text import LIMIT, OVERLAP, boundaries, cuts, pieces, split_texts
from sparkloom.llm.term_counts import term_counts

TERMS = "k string, a array<string>, b array<string>, term string, first int, n_all long"


def test_term_counts_against_brute_force(spark):
    rng = random.Random(1)
    words = ["", "hot", "hot", "hot", None, " ", "w1", "w2", "긴 낱말 " * 200]
    rows = [(f"u{i}", [rng.choice(words + [f"r{rng.randrange(40)}"]) for _ in range(rng.randrange(6))], rng.choice([None, [], ["x", "x"]])) for i in range(120)]
    n, u = collections.Counter(), collections.defaultdict(set)
    for k, a, b in rows:
        for f, arr in (("a", a), ("b", b)):
            for t in arr or []:
                if t is not None:
                    n[f, t] += 1
                    u[f, t].add(k)
    df = spark.createDataFrame([(*r, "c", 1, 2) for r in rows + rows[:30] + [(None, ["hot"], None)]], TERMS)
    got = term_counts(df, "k", {"a": F.col("a"), "b": F.col("b")}, 3, 25).collect()
    mark = lambda c: "rare" if c < 3 else "common" if c * 25 > 120 else None
    assert {(r.field_name, r.term): (r.n_mentions, r.n_records, r.mark) for r in got} == {k: (n[k], len(u[k]), mark(len(u[k]))) for k in n}


def test_term_counts_of_nothing(spark):
    assert term_counts(spark.createDataFrame([], TERMS), "k", {"a": F.col("a")}).count() == 0
    bare = spark.createDataFrame([("u", None, [], "c", 1, 2)], TERMS)
    assert term_counts(bare, "k", {"a": F.col("a"), "b": F.col("b")}).count() == 0


def holds(text, limit=LIMIT, overlap=OVERLAP):
    p = pieces(text, limit, overlap)
    assert all(len(x) <= limit for _, x in p)
    if len(text) <= limit:
        assert p == [(0, text)]
        return p
    joined = p[0][1]
    for (a, x), (b, y) in zip(p, p[1:]):
        assert y[:overlap] == x[-overlap:] and b > a
        joined += y[overlap:]
    assert joined == text
    return p


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("가나다 \n.,;각́‍🧾-1\\"), max_size=900), st.integers(20, 120))
def test_pieces_keep_the_whole_text(text, limit):
    holds(text, limit, 8)


def test_long_texts():
    assert len(holds("가" * 100_000)) == -(-(100_000 - 80) // 720)
    sentences = "".join(f"이 문장은 제{i}번 문장이다. " for i in range(800))
    assert all(c in boundaries(sentences) and boundaries(sentences)[c] == 4.0 for c in cuts(sentences))
    holds("e" + "́" * 5000)
    holds("문단이다.\n\n" * 700)


def test_paragraphs_are_preferred_to_sentences():
    text = ("문장 하나다. " * 40 + "\n\n") * 4
    assert all(text[c - 2 : c] == "\n\n" for c in cuts(text))


def test_outer_items_are_preferred_to_inner_ones():
    text = "머리\n" + "".join(f"{i}. " + "항목 글 " * 20 + "\n" + "".join(f"  {c}. " + "속 항목 " * 8 + "\n" for c in "가나다") for i in range(1, 20))
    found = cuts(text)
    outer = [c for c in found if re.match(r"\d+\. ", text[c:])]
    assert all(text[c - 1] == "\n" for c in found) and len(outer) > len(found) / 2


UNITS = "uid string, x string, y string, at int, row_id int, piece string"


def test_split_texts(spark):
    long = "낱말 " * 900
    rows = [("a", long, "short", 1, 0, "c"), ("a", long, "newer", 2, 0, "c"), ("b", None, "", 1, 0, "c"), (None, long, None, 1, 0, "c")]
    got = split_texts(spark.createDataFrame(rows, UNITS), "uid", ["x", "y"], "at").collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.row_id, r.field_name].append((r.piece_no, r.n_pieces, r.start_at, r.piece))
    want = pieces(long)
    assert sorted(by["a", "x"]) == [(i + 1, len(want), a, p) for i, (a, p) in enumerate(want)]
    assert by["a", "y"] == [(1, 1, 0, "newer")] and by["b", "y"] == [(1, 1, 0, "")]
    assert set(by) == {("a", "x"), ("a", "y"), ("b", "y")}
    assert split_texts(spark.createDataFrame([], UNITS), "uid", ["x", "y"]).count() == 0
    with pytest.raises(ValueError):
        split_texts(spark.createDataFrame([], UNITS), "uid", ["x"], limit=80, overlap=80)


ANSWERS = [
    '{"relations":[{"subject":"가 나","predicate":"Do-It","object":"x1"}]}',
    '```json\n{"relations": [ {"object":"(X1)", "predicate":"do it", "subject":"가나."} ]}\n```',
    '{"relations":[{"subject":"\\uac00나","predicate":"DOIT","object":"x·1"}]}',
    '{"relations":[{"subject":"가나","predicate":"doit","object":"1x"}]}',
    '{"relations":[{"subject":"가나","predicate":"doit","object":"x1"}]} extra',
    '{"relations":[{"subject":"가나","predicate":"doit","object":"x1"}]}{}',
    '{"relations":[{"subject":"가나","predicate":"doit","object":"x1"},{"subject":"a","predicate":"b","object":"c"}]}',
    '{"relations":[]}', "", None, "prose", "{", "{'relations':[]}", '{"relations":[{"subject":"가나","predicate":"doit"}]}', '[1]', '{"relations":5}',
    '{"relations":[{"subject":"!!","predicate":"doit","object":"x1"}]}', '{"relations":[{"subject":"","predicate":"doit","object":"x1"}]}',
]
RESP = "response_id long, unit string, response_text string, batch int, key string, copies int"


def keyed(spark, rows):
    df = spark.createDataFrame([(*r, 0, "c", 1) for r in rows], RESP)
    return with_single_relation(df, "response_text", "r").select("response_id", canonical_key(F.col("unit"), [F.col(f"r.{c}") for c in ("subject", "predicate", "object")]).alias("key"))


def test_canonical_keys(spark):
    k = {r.response_id: r.key for r in keyed(spark, [(i, "u", a) for i, a in enumerate(ANSWERS)]).collect()}
    assert k[0] == k[1] == k[2] is not None and k[3] not in (None, k[0])
    assert all(k[i] is None for i in (4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15))
    assert k[16] == k[17] is not None  # nothing but signs equals nothing


def model(rows):
    groups = collections.defaultdict(list)
    for i, u, t in rows:
        try:
            o = json.loads(re.sub(r"(?s)\A\s*```\w*\s*(.*?)\s*```\s*\Z", r"\1", t or ""))
            (r,) = o["relations"]
            key = tuple("".join(c for c in r[f].lower() if c.isalnum()) for f in ("subject", "predicate", "object"))
        except (ValueError, KeyError, TypeError):
            continue
        groups[u, key].append(i)
    return {(min(g), i) for g in groups.values() for i in g if i != min(g)}


def test_ledger_over_batches_equals_one_grouping(spark):
    rng = random.Random(2)
    rows = [(i, f"u{rng.randrange(4) if i % 3 else 0}", rng.choice(ANSWERS)) for i in range(300)]
    df = keyed(spark, rows + rows[:5])
    one = copies(*duplicate_ledger(df, "key", "response_id", F.lit(1)))
    many = copies(*duplicate_ledger(df, "key", "response_id", F.when(F.col("response_id") % 5 == 4, None).otherwise(F.col("response_id") % 5)))
    assert {tuple(r) for r in one.collect()} == {tuple(r) for r in many.collect()} == model(rows)


def test_ledger_of_nothing_and_its_joins(spark):
    empty = spark.createDataFrame([], "key string, response_id long")
    ledger, members = duplicate_ledger(empty, "key", "response_id", F.lit(1))
    assert ledger.count() == 0 and copies(ledger, members).count() == 0
    led = Ledger(spark, "joins", 4)
    led.add(spark.createDataFrame([("a", 5), ("a", 3), (None, 1)], "key string, row_id long"))
    led.add(spark.createDataFrame([("a", 2), ("b", 9)], "key string, row_id long"))
    assert sorted(map(tuple, led.read().collect())) == [("a", 3, 2), ("b", 1, 9)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = led.read().join(led.read().withColumnRenamed("copies", "c2").drop("first_id"), "key", "full_outer")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan  # buckets meet without a shuffle
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    led.remove()


def test_a_ledger_is_opened_again_by_its_name(spark, tmp_path):
    """A second session counts on; only touched buckets are written; broken-off moves are finished."""
    folder = f"file://{tmp_path}"
    first = Ledger(spark, "kept", 16, folder)
    first.add(spark.createDataFrame([(f"k{i}", i) for i in range(300)], "key string, row_id long"))
    other = spark.newSession()
    again = Ledger(other, "kept", folder=folder)
    assert again.buckets == 16 and again.version == 1
    written = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "ledgers/kept/v1").glob("part-*")}
    again.add(other.createDataFrame([("k7", 3), ("k7", 400), ("new", 5)], "key string, row_id long"))
    now = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "ledgers/kept/v2").glob("part-*")}
    assert len(set(written.items()) & set(now.items())) >= 14 and not (tmp_path / "ledgers/kept/v1").exists()
    want = {f"k{i}": (1, i) for i in range(300)} | {"k7": (3, 3), "new": (1, 5)}
    third = Ledger(spark.newSession(), "kept", folder=folder)
    assert {r.key: (r.copies, r.first_id) for r in third.read().collect()} == want
    # a failure between the pointer and the moves
    state = {"version": 3, "buckets": 16, "from": 2, "touched": list(range(1, 16))}
    (tmp_path / "ledgers/kept/v3").mkdir()
    for p in (tmp_path / "ledgers/kept/v2").glob("part-*"):
        if "_00000" not in p.name:
            p.rename(tmp_path / "ledgers/kept/v3" / p.name)
    third._save(state)
    assert {r.key: (r.copies, r.first_id) for r in Ledger(spark.newSession(), "kept", folder=folder).read().collect()} == want


def test_times_of_long_texts_grow_with_their_length():
    import time

    def seconds(n):
        text = ("문장 하나다. " * 3000)[: n // 2] + "가" * 2500 + ("문장 하나다. " * 400_000)[: n // 2]
        began = time.process_time()
        holds(text) if n < 100_000 else cuts(text)
        return time.process_time() - began

    seconds(50_000)
    assert seconds(800_000) < 12 * max(seconds(200_000), 0.05)
