import itertools
import random
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from sparkloom.llm.canonical_map import Dictionary, edits, look_up_values, map_to_list, plain
from sparkloom.llm.lookalikes import LookTrie, classes, look_matches, match_vocabulary, table_form

ALPHABET = "가각AАΑＡa еé​﻿ 　-－1１"


def test_look_classes():
    same = ["Noël Р1", "Noël　P1", "​Ｎoël P１﻿", "Νοël Ρ1"]
    assert len({table_form(s) for s in same}) == 1
    apart = ["Noël", "Noel", "noël", "Noël ", "Noël.", "No ël"]
    assert len({table_form(s) for s in apart}) == len(apart)
    assert table_form(unicodedata.normalize("NFD", "가람​원")) == "가람원"
    assert table_form("") == "" and table_form("​⁠") == ""


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(ALPHABET), max_size=5), max_size=12), st.text(st.sampled_from(ALPHABET), max_size=5))
def test_trie_equals_comparing_forms(words, text):
    got = LookTrie(sorted(set(words))).matches(text)
    assert got == sorted((w, 0) for w in set(words) if table_form(w) == table_form(text))


def levenshtein(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y)))
        prev = row
    return prev[-1]


def test_automaton_with_a_budget():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abАc") for _ in range(rng.randrange(1, 6))) for _ in range(40)})
    trie = LookTrie(words)
    for _ in range(60):
        t = "".join(rng.choice("abAc​") for _ in range(rng.randrange(6)))
        want = {w: levenshtein(classes(w), classes(t)) for w in words}
        assert dict(trie.matches(t, 2)) == {w: d for w, d in want.items() if d <= 2}


def test_marks_change_places_past_invisible_characters():
    a, b = "a\u0301\u200b\u0323", "a\u0323\u0301"
    assert table_form(a) == table_form(b) and LookTrie([a]).matches(b) == [(a, 0)] and LookTrie([b]).matches(a) == [(b, 0)]
    assert table_form("\U0001d400\ufb01\u2163") == "AfiIV" and table_form("\u2026\u00bd") == "\u2026\u00bd"


NAMES = "name string, n_vocab long, form string, shard int"


def test_a_budget_finds_the_same_across_shards(spark):
    rng = random.Random(9)
    names = sorted({"".join(rng.choice("abА́c​") for _ in range(rng.randrange(7))) for _ in range(120)})
    rows = [(n, rng.choice([0, 1, 4]), "c", 1) for n in names]
    for budget, per in ((1, 5), (2, 40)):
        got = look_matches(spark.createDataFrame(rows, NAMES), budget, per).collect()
        want = {(n, v[0], levenshtein(classes(n), classes(v[0]))) for n in names for v in rows if v[1]}
        assert {(r.name, r.spelling, r.cost) for r in got} == {x for x in want if x[2] <= budget} and len(got) == len({(r.name, r.spelling) for r in got})
        assert all(levenshtein(classes(r.name), classes(r.canonical)) == min(c.cost for c in got if c.name == r.name) for r in got)


def test_match_vocabulary(spark):
    rows = [("가람", 3), ("가​람", 9), ("가람 ", 1), ("가람⁠", 0), ("", 0), (None, 5), ("홀로", 0), ("긴" * 20_000, 2), ("긴" * 20_000 + "﻿", 0)]
    got = {(r.name, r.spelling): r.canonical for r in match_vocabulary(spark.createDataFrame([(*r, "c", 1) for r in rows], NAMES), 3).collect()}
    assert set(got) == {
        *itertools.product(["가람", "가​람", "가람⁠"], ["가람", "가​람"]), ("가람 ", "가람 "), ("", None), ("홀로", None),
        ("긴" * 20_000, "긴" * 20_000), ("긴" * 20_000 + "﻿", "긴" * 20_000),
    }
    assert got["가람⁠", "가람"] == "가람" and got["홀로", None] == "홀로"
    assert match_vocabulary(spark.createDataFrame([], NAMES)).count() == 0


def nearest_edits(a, b):
    """Fewest single edits (insert, delete, replace, swap neighbours) by search over texts, each place edited freely."""
    import functools

    @functools.cache
    def go(x, y):
        if not x or not y:
            return len(x) + len(y)
        if x[-1] == y[-1]:
            return go(x[:-1], y[:-1])
        best = 1 + min(go(x[:-1], y), go(x, y[:-1]), go(x[:-1], y[:-1]))
        i, j = x[:-1].rfind(y[-1]), y[:-1].rfind(x[-1])
        if i >= 0 and j >= 0:  # x[i] and x[-1] change places, what lies between goes and comes
            best = min(best, go(x[:i], y[:j]) + (len(x) - i - 2) + 1 + (len(y) - j - 2))
        return best

    return go(a, b)


@settings(max_examples=300, deadline=None)
@given(st.text("가각나다", max_size=7), st.text("가각나다", max_size=7), st.integers(0, 3))
def test_edits_equal_the_full_table(a, b, most):
    got = edits(a, b, most)
    want = nearest_edits(a, b)
    assert (got is None) == (want > most) and (got is None or got[0] == want)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("가각나다라마", min_size=5, max_size=9), min_size=1, max_size=8, unique=True), st.text("가각나다라마", max_size=10))
def test_lookup_finds_every_entry_in_reach(entries, value):
    d = Dictionary.build([(e, e, 0) for e in entries], "name", 3)
    best = min(((nearest_edits(value, e), e) for e in entries if nearest_edits(value, e) <= (3 if len(e) >= 8 else 2)), default=None)
    got = d.lookup(value)
    assert (got is None) == (best is None) and (got is None or got[1] <= best[0])


VERBS = [("p", "업무이관하다", 5), ("n", "업무이관하지 않다", 1), ("q", "요율고시하다", 0), ("r", "요율고시하지 않다", 0)]


def test_verbs():
    d = Dictionary.build(VERBS, "verb", 2)
    for value, want in {
        "업무이관한다": "p", "업무이관함": "p", "업무 이관해야 한다": "p", "업무를 이관하다": "p", "업무이관하지 않는다": "n", "업무이관하지 아니한다": "n", "업무이관하지않음": "n",
        "'요고율시하다'": "q", "요율을 고시하지 않음": "r", "업무 관하지 않다": "n", "수질정비하다": None, "": None, "  ": None, "!!": None, None: None, "하다": None,
    }.items():
        got = d.lookup(value)
        assert (got and got[0]) == want, value


def test_swaps_with_a_deletion_between():
    assert edits("업무이관하지", "업무하이지", 2)[0] == 2
    assert edits("재고실사", "실재사", 2)[0] == 2


def test_names_and_ties():
    d = Dictionary.build([("b", "가나다라마바사아", 1), ("a", "가나다라마바사자", 1), ("c", "하나둘셋넷", 0)], "name", 3)
    assert d.lookup("가나다라마바사차")[0] == "a"  # equal edits and frequency: smaller id
    assert d.lookup("「가나다라·마바사아」의")[0] == "b"
    assert d.lookup("하나둘셋넷이") [0] == "c"
    assert d.lookup("가" * 100_000) is None
    more = Dictionary.build([("b", "가나다라마바사아", 9), ("a", "가나다라마바사자", 1)], "name", 3)
    assert more.lookup("가나다라마바사하")[0] == "b"  # higher frequency


def test_map_to_list_in_blocks(spark):
    values = spark.createDataFrame([(i, v, "c") for i, v in enumerate(["가나다라마바사", "가나다라마바", None, "", "없는 값이다", "가나다라마바사"] * 3)], "id long, v string, ref_id string")
    entries = spark.createDataFrame([("1", "가나다라마바사"), ("2", "카타파하거너더"), ("1", "가나다라마바사"), (None, "x"), ("3", None)], "ref_id string, canonical_name string")
    for block in (1, 100):
        got = {(r.id, r.ref_id, r.edits) for r in map_to_list(values, "v", "id", entries, entries_per_block=block).collect()}
        assert got == {(i, "1", e) for i in range(18) for k, e in ((0, 0), (1, 1), (5, 0)) if i % 6 == k}
    all_values = look_up_values(values.select(values.v.alias("name")), entries).collect()
    assert {r.name for r in all_values if r.ref_id is None} == {"", "없는 값이다"}
    assert map_to_list(values, "v", "id", entries.limit(0)).count() == 0
    assert plain("Ａ-b 1") == "ab1"
