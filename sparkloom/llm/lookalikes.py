"""Visually identical text with different characters: vocabulary tries walked by a weighted edit automaton."""

from __future__ import annotations

import functools
import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Letters of other scripts that look like a Latin letter, each pair written as other, Latin.
LOOKALIKE_PAIRS = (
    "АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT УY ХX ԚQ ԜW ҮY "
    "аa еe оo рp сc уy хx ѕs іi јj ԛq ԝw һh ԁd ӏl ёë ЁË їï ЇÏ "
    "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX οo νv αa ιi ρp υu κk γy"
)
LOOKALIKES = {p[0]: p[1] for p in LOOKALIKE_PAIRS.split()}

#: Names per trie shard, as an average: a shard's names and trie are held by one task.
NAMES_PER_SHARD = 20_000

IGNORABLE = ""


#: Kinds of compatibility forms that are the same letter in another dress, whatever the character is; other kinds
#: only where the character is a letter (ligatures, presentation forms, letters of Roman numbers).
_DRESS = ("<wide>", "<narrow>", "<font>")
_LETTER_DRESS = ("<compat>", "<initial>", "<medial>", "<final>", "<isolated>")


@functools.lru_cache(maxsize=65_536)
def look(ch: str) -> str:
    """The class of one code point: what it looks like, in decomposed code points. '' for an invisible one.

    Rules, not a list: wide, narrow and styled forms give their plain form, ligatures and presentation forms their
    letters, every kind of white space gives the space, format and control characters, variation selectors and
    fillers give nothing, and letters of LOOKALIKE_PAIRS give the Latin letter. Case, punctuation and digits
    stay as they are."""
    if ch.isspace():
        return " "
    cat = unicodedata.category(ch)
    o = ord(ch)
    if cat in ("Cf", "Cc") or o == 0x034F or 0xFE00 <= o <= 0xFE0F or 0xE0100 <= o <= 0xE01EF or o in (0x115F, 0x1160, 0x3164, 0xFFA0):
        return IGNORABLE
    kind, _, codes = unicodedata.decomposition(ch).partition(" ")
    if codes and (kind in _DRESS or (kind in _LETTER_DRESS and (cat[0] == "L" or cat == "Nl"))):
        return unicodedata.normalize("NFD", "".join(look(chr(int(c, 16))) for c in codes.split()))
    return unicodedata.normalize("NFD", LOOKALIKES.get(ch, ch))


#: Texts of these are their own form, without marks.
_PLAIN = re.compile(r"[\x20-\x7e가-힣]*")


def steps(text: str) -> list[tuple[str, str]]:
    """(code point as stored, class) of the decomposed text, marks in canonical order by their class.

    An invisible character within a run of marks stands after the run, so that it cannot keep marks apart that
    otherwise would change places."""
    if _PLAIN.fullmatch(text):
        plain = unicodedata.normalize("NFD", text)
        return list(zip(plain, plain))
    out: list[tuple[str, str]] = []
    marks: list[tuple[str, str]] = []
    unseen: list[tuple[str, str]] = []

    def flush() -> None:
        if marks or unseen:
            marks.sort(key=lambda m: unicodedata.combining(m[1]))
            out.extend(marks)
            out.extend(unseen)
            marks.clear()
            unseen.clear()

    for ch in unicodedata.normalize("NFD", text):
        k = look(ch)
        if k == IGNORABLE:
            unseen.append((ch, k))
        for c in k:
            if unicodedata.combining(c):
                marks.append((ch, c))
            else:
                flush()
                out.append((ch, c))
    flush()
    return out


def classes(text: str) -> str:
    """The classes of a text in order: texts that look the same have the same ones."""
    return "".join(k for _, k in steps(text))


def table_form(text: str) -> str:
    """The one consistent form by table alone: the classes, composed again."""
    return unicodedata.normalize("NFC", classes(text))


class LookTrie:
    """Trie over vocabulary spellings whose edges are decomposed code points as stored, each with its look class.

    ``matches`` runs a weighted edit automaton over it: a state is a node with the cost spent so far.
    Zero cost: an edge of the same look class as the input, an invisible input character (stay) and an
    invisible edge (go down without input). Any other substitution, insertion or deletion costs 1 and is
    allowed within ``budget``; 0 finds exactly the spellings that look the same.
    """

    __slots__ = ("kids", "words")

    def __init__(self, words):
        self.kids: list[dict[str, list[tuple[str, int]]]] = [{}]
        self.words: list[list[str]] = [[]]
        edge: dict[tuple[int, str, str], int] = {}
        for w in words:
            at = 0
            for ch, k in steps(w):
                to = edge.get((at, ch, k))
                if to is None:
                    to = edge[at, ch, k] = len(self.kids)
                    self.kids.append({})
                    self.words.append([])
                    self.kids[at].setdefault(k, []).append((ch, to))
                at = to
            self.words[at].append(w)

    def _close(self, states: dict[int, int]) -> dict[int, int]:
        """Adds what invisible edges reach at no cost."""
        stack = list(states)
        while stack:
            n = stack.pop()
            for _, to in self.kids[n].get(IGNORABLE, ()):
                if to not in states or states[to] > states[n]:
                    states[to] = states[n]
                    stack.append(to)
        return states

    def matches(self, text: str, budget: int = 0) -> list[tuple[str, int]]:
        """(spelling, cost) of every vocabulary spelling within the budget."""
        states = {0: 0}
        if budget:
            self._skip(states, budget)
        states = self._close(states)
        for _, k in steps(text):
            if k == IGNORABLE:
                continue
            nxt: dict[int, int] = {}
            for n, cost in states.items():
                for _, to in self.kids[n].get(k, ()):
                    if nxt.get(to, budget + 1) > cost:
                        nxt[to] = cost
                if cost < budget:
                    if nxt.get(n, budget + 1) > cost + 1:  # the input character is extra
                        nxt[n] = cost + 1
                    for kk, tos in self.kids[n].items():
                        if kk not in (k, IGNORABLE):
                            for _, to in tos:
                                if nxt.get(to, budget + 1) > cost + 1:
                                    nxt[to] = cost + 1
            if budget:
                self._skip(nxt, budget)
            states = self._close(nxt)
            if not states:
                return []
        return sorted((w, c) for n, c in states.items() for w in self.words[n])

    def _skip(self, states: dict[int, int], budget: int) -> None:
        """Adds what missing input characters reach at cost 1 each."""
        stack = list(states)
        while stack:
            n = stack.pop()
            for kk, tos in self.kids[n].items():
                step = states[n] + (kk != IGNORABLE)
                for _, to in tos:
                    if step <= budget and states.get(to, budget + 1) > step:
                        states[to] = step
                        stack.append(to)


def with_table_form(df: DataFrame, name: str, out: str) -> DataFrame:
    """Adds the table form. Names of ASCII and whole Hangul syllables are their own form and skip Python's work."""

    @F.pandas_udf("string")
    def odd_form(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else table_form(x), na_action="ignore")

    odd = F.when(~F.col(name).rlike(r"\A[\x20-\x7e가-힣]*\z"), F.col(name))
    return df.withColumn(out, F.coalesce(odd_form(odd), F.col(name)))


def segment_keys(k: str, budget: int) -> list[str]:
    """Keys of a vocabulary spelling with classes ``k``: budget + 1 segments of it, each with the length and its number.

    Whatever is within ``budget`` edits leaves one of the segments whole, at most ``budget`` places off."""
    n = len(k)
    return [f"{n} {i} {k[n * i // (budget + 1) : n * (i + 1) // (budget + 1)]}" for i in range(budget + 1)]


def probe_keys(k: str, budget: int) -> list[str]:
    """Every key that a spelling within ``budget`` edits of the classes ``k`` may share."""
    out = set()
    for n in range(max(0, len(k) - budget), len(k) + budget + 1):
        for i in range(budget + 1):
            a, b = n * i // (budget + 1), n * (i + 1) // (budget + 1)
            for shift in range(-budget, budget + 1):
                if a + shift >= 0 and b + shift <= len(k):
                    out.add(f"{n} {i} {k[a + shift : b + shift]}")
    return sorted(out)


def _with_keys(formed: DataFrame, budget: int, vocabulary: bool) -> DataFrame:
    """One row per key of every name. Without a budget the key is the form, which needs no Python."""
    if not budget:
        return formed.withColumn("key", F.col("form"))
    make = segment_keys if vocabulary else probe_keys

    @F.pandas_udf("array<string>")
    def keys(s: pd.Series) -> pd.Series:
        return s.map(lambda x: make(classes(x), budget))

    return formed.withColumn("key", F.explode(keys("name")))


def look_matches(names: DataFrame, budget: int = 0, names_per_shard: int = NAMES_PER_SHARD) -> DataFrame:
    """Vocabulary spellings that look the same as each name, or differ from it by at most ``budget`` edits.

    ``names``: rows (name STRING, n_vocab LONG): distinct texts, n_vocab > 0 for vocabulary spellings
    (their weight). Result: rows (name, spelling, cost, canonical), one per spelling found; cost is the number of
    edits between what is seen of both, 0 where they look the same. ``canonical`` is the one consistent form: of the
    spellings found the one of least cost, then one that is its own table form, then the heaviest, then the smallest.

    Spellings and names are dealt to shards by keys that every pair within the budget shares (the table form, or
    segments of it), so every trie holds about ``names_per_shard`` names however large the vocabulary is, and none is
    broadcast. With a budget a key may be shared by very many; its spellings and its names are then dealt to parts of
    ``names_per_shard`` each, and every part of the ones meets every part of the others. Null names give no row; the
    empty text is a name. No names give no rows. The names are read several times.
    """
    names = names.select("name", "n_vocab").filter(F.col("name").isNotNull())
    shards = max(12, -(-names.count() // names_per_shard)) * (budget + 1)
    formed = with_table_form(names, "name", "form")
    spellings = _with_keys(formed.filter("n_vocab > 0"), budget, True).select("key", "name", "n_vocab", F.lit(True).alias("listed"))
    asked = _with_keys(formed, budget, False).select("key", "name", "n_vocab", F.lit(False).alias("listed"))
    rows = spellings.unionByName(asked)
    if budget:
        per = rows.groupBy("key").agg(F.sum(F.col("listed").cast("int")).alias("_v"), F.sum((~F.col("listed")).cast("int")).alias("_n"))
        hot = per.filter((F.col("_v") > names_per_shard) | (F.col("_n") > names_per_shard)).select(
            "key", F.ceil(F.col("_v") / names_per_shard).alias("_vs"), F.ceil(F.col("_n") / names_per_shard).alias("_ns"))
        rows = rows.join(hot, "key", "left")
        vs, ns = F.coalesce("_vs", F.lit(1)), F.coalesce("_ns", F.lit(1))
        own = F.pmod(F.xxhash64("name"), F.when(F.col("listed"), vs).otherwise(ns))
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("listed"), ns).otherwise(vs) - 1))
        rows = rows.withColumn("_own", own).withColumn("_other", other)
        v, n = F.when(F.col("listed"), F.col("_own")).otherwise(F.col("_other")), F.when(F.col("listed"), F.col("_other")).otherwise(F.col("_own"))
        rows = rows.withColumn("shard", F.when(vs * ns > 1, -1 - F.abs(F.xxhash64("key", v, n) % (1 << 40))).otherwise(F.pmod(F.xxhash64("key"), F.lit(shards))))
    else:
        rows = rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        listed = pdf["listed"].to_numpy(dtype=bool)
        weight = {a: int(b) for a, b in zip(pdf["name"][listed], pdf["n_vocab"][listed])}
        trie = LookTrie(sorted(weight))
        out = [
            (name, w, cost, table_form(w) != w, -weight[w])
            for name in dict.fromkeys(pdf["name"][~listed]) for w, cost in trie.matches(name, budget)
        ]
        return pd.DataFrame(out, columns=["name", "spelling", "cost", "_dressed", "_light"])

    # few bytes but much work a name: the number of tasks is given, not coalesced by size
    dealt = rows.select("shard", "name", "n_vocab", "listed").repartition(min(shards, 3 * names.sparkSession.sparkContext.defaultParallelism), "shard")
    found = dealt.groupBy("shard").applyInPandas(
        walk, "name string, spelling string, cost int, _dressed boolean, _light long"
    )
    if budget:
        found = found.distinct()  # a pair may share several keys
    best = F.first("spelling").over(W.partitionBy("name").orderBy("cost", "_dressed", "_light", "spelling"))
    return found.withColumn("canonical", best).select("name", "spelling", "cost", "canonical")


def match_vocabulary(names: DataFrame, names_per_shard: int = NAMES_PER_SHARD, budget: int = 0) -> DataFrame:
    """Rows (name, form, spelling, canonical): ``look_matches`` of every name, and those without any, whose spelling is null
    and whose consistent form is the table form."""
    found = look_matches(names, budget, names_per_shard).drop("cost")
    formed = with_table_form(names.select("name").filter(F.col("name").isNotNull()), "name", "form")
    return formed.join(found, "name", "left").select("name", "form", "spelling", F.coalesce("canonical", "form").alias("canonical"))
