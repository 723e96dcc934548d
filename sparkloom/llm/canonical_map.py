"""Freely typed values mapped to the closest entry of a reference list by symmetric deletion."""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.bloom import with_membership
from sparkloom.operators.skew import hot_salts, salted_join
from sparkloom.runtime import materialise

#: Entries of the list that one broadcast dictionary may hold (by estimate 100 MB); a longer list is used in blocks.
ENTRIES_PER_BLOCK = {"name": 2_000, "verb": 300}
# Endings of a Korean verb in -하다, positive and negated, without spaces.
POSITIVE_ENDINGS = (
    "하다 한다 함 합니다 하였다 했다 하며 하고 하는 하여야한다 하여야하다 해야한다 해야하다 할수있다 하여야함 해야함 할수있음 하도록한다 하게한다"
).split()
NEGATIVE_ENDINGS = (
    "하지않다 하지않는다 하지않음 하지않습니다 하지않았다 하지않아야한다 하지않을수있다 하지아니하다 하지아니한다 하지아니함 "
    "하지아니하였다 하지아니하여야한다 하지못하다 하지못한다 하지못함 안하다 안한다 안함 할수없다 하여서는아니된다 하면안된다"
).split()
# Particles that may follow a name.
PARTICLES = "에서는 으로는 에서 에게 으로 까지 부터 은 는 이 가 을 를 의 와 과 도 만 로 에 측 등".split()

_L, _V, _T = 19, 21, 28


def jamo(ch: str) -> tuple:
    """Initial, vowel and final of a Hangul syllable; the character alone for any other."""
    o = ord(ch) - 0xAC00
    if 0 <= o < _L * _V * _T:
        return o // (_V * _T), o // _T % _V, o % _T
    return (ch,)


def plain(text: str) -> str:
    """What is compared: compatibility form, letters and digits only, lower case."""
    return "".join(c for c in unicodedata.normalize("NFKC", text).lower() if c.isalnum())


@functools.lru_cache(maxsize=65_536)
def substitution(a: str, b: str) -> float:
    """0.4 for one differing letter of a syllable, 0.7 for two, 1 for all."""
    x, y = jamo(a), jamo(b)
    if len(x) == 3 and len(y) == 3:
        return (0.0, 0.4, 0.7, 1.0)[sum(p != q for p, q in zip(x, y))]
    return 1.0 if x != y else 0.0


def edits(a: str, b: str, most: int) -> tuple[int, float] | None:
    """(edits, weighted edits) of the Damerau-Levenshtein distance, or None beyond ``most``.

    The unrestricted distance: characters may be inserted or deleted between two that change places. A
    transposition is one edit of weight 0.6; inserting or deleting a repetition of the neighbour weighs 0.5, any
    other insertion or deletion 1. The weight breaks ties among equal edits."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return None
    gap_a = [0.5 if i > 1 and a[i - 1] == a[i - 2] else 1.0 for i in range(n + 1)]
    gap_b = [0.5 if j > 1 and b[j - 1] == b[j - 2] else 1.0 for j in range(m + 1)]
    rows = [[(0, 0.0)]]
    for j in range(1, m + 1):
        rows[0].append((j, rows[0][-1][1] + gap_b[j]))
    last_row: dict[str, int] = {}  # last row whose character is that one
    for i in range(1, n + 1):
        prev = rows[-1]
        row = [(i, prev[0][1] + gap_a[i])]
        last_col = 0  # last column of this row whose character is a's
        for j in range(1, m + 1):
            d, w = prev[j - 1]
            s = substitution(a[i - 1], b[j - 1])
            best = (d + (s > 0), w + s)
            d, w = prev[j]
            best = min(best, (d + 1, w + gap_a[i]))
            d, w = row[j - 1]
            best = min(best, (d + 1, w + gap_b[j]))
            k, at = last_row.get(b[j - 1], 0), last_col
            if k and at:
                d, w = rows[k - 1][at - 1]
                between = (i - k - 1) + (j - at - 1)
                best = min(best, (d + between + 1, w + between + 0.6))
            if a[i - 1] == b[j - 1]:
                last_col = j
            row.append(best)
        last_row[a[i - 1]] = i
        rows.append(row)
    return rows[n][m] if rows[n][m][0] <= most else None


#: Characters of a text from which deletions are made. Two texts within k edits share one of the forms that their beginnings of
#: this length have with up to k characters taken out, so nothing is lost and a long text has no more forms than a short one.
BEGINNING = 12


def deletions(word: str, most: int) -> set[str]:
    """The word's beginning with up to ``most`` characters taken out."""
    word = word[:BEGINNING]
    out = {word}
    level = {word}
    for _ in range(most):
        level = {w[:i] + w[i + 1 :] for w in level for i in range(len(w))}
        out |= level
    return out


def name_aliases(canonical: str) -> list[str]:
    return [plain(canonical)]


def verb_aliases(canonical: str) -> list[str]:
    """A verb entry with every ending of its polarity, and with an object particle inside its stem."""
    p = plain(canonical)
    for ends in (NEGATIVE_ENDINGS, POSITIVE_ENDINGS):
        if p.endswith(ends[0]) and len(p) > len(ends[0]):
            stem = p[: -len(ends[0])]
            stems = [stem]
            if len(stem) == 4:
                stems.append(stem[:2] + ("을" if jamo(stem[1])[-1] else "를") + stem[2:])
            return [s + e for s in stems for e in ends]
    return [p]


def name_variants(value: str) -> list[tuple[str, float]]:
    """The compared text and, at a small extra weight, the text without a particle at its end."""
    p = plain(value)
    out = [(p, 0.0)]
    out.extend((p[: -len(t)], 0.1) for t in PARTICLES if p.endswith(t) and len(p) - len(t) >= 4)
    return out


def verb_variants(value: str) -> list[tuple[str, float]]:
    p = plain(value)
    return [(p, 0.0), (re.sub(r"(?<=..)[을를](?=..)", "", p, count=1), 0.1)] if re.search(r"(?<=..)[을를](?=..)", p) else [(p, 0.0)]


#: Edits that a name and a verb stand at most; a verb's ending makes it longer, not clearer.
MOST_EDITS = {"name": 3, "verb": 2}
_NEGATED = re.compile("않|아니|못|안[하한함]|하지")


def allowed(length: int, most: int) -> int:
    """Edits allowed against an alias of that many characters: long ones stand more of them."""
    if length >= 8:
        return most
    return min(most, 2 if length >= 5 else 1 if length >= 3 else 0)


@dataclass
class Dictionary:
    """Symmetric-delete dictionary of one block of entries.

    ``aliases``: (text, entry number); ``index``: beginning of a text with characters taken out -> alias numbers.
    Rank of a hit: edits, weighted edits, higher reference frequency, entry id."""

    ids: list[str]
    freq: list[int]
    aliases: list[tuple[str, int]]
    index: dict[str, tuple[int, ...]]
    kind: str
    most: int
    longest: int
    chars: dict[str, tuple[int, ...]]
    needed: list[int]

    @classmethod
    def build(cls, entries: list[tuple[str, str, int]], kind: str, most: int) -> Dictionary:
        make = verb_aliases if kind == "verb" else name_aliases
        ids, freq, aliases, index = [], [], [], {}
        chars: dict[str, list[int]] = {}
        needed = []
        for e, (ref_id, canonical, n) in enumerate(entries):
            ids.append(ref_id)
            freq.append(n)
            texts = [t for t in dict.fromkeys(make(canonical)) if t]
            core = set.intersection(*map(set, texts)) if texts else set()
            needed.append(len(core) - most)
            for ch in core:
                chars.setdefault(ch, []).append(e)
            for text in texts:
                aliases.append((text, e))
                for d in deletions(text, allowed(len(text), most)):
                    index.setdefault(d, []).append(len(aliases) - 1)
        return cls(ids, freq, aliases, {k: tuple(v) for k, v in index.items()}, kind, most, max((len(a) for a, _ in aliases), default=0), {k: tuple(v) for k, v in chars.items()}, needed)

    def possible(self, text: str) -> bool:
        """Whether some entry can be within the edits at all: an edit takes at most one of the distinct characters
        that all aliases of an entry share, so ``most`` edits leave the rest of them in the text."""
        if min(self.needed, default=1) <= 0:
            return True
        seen: dict[int, int] = {}
        for ch in set(text):
            for e in self.chars.get(ch, ()):
                n = seen[e] = seen.get(e, 0) + 1
                if n >= self.needed[e]:
                    return True
        return False

    def lookup(self, value: str | None) -> tuple[str, int, float] | None:
        """(entry id, edits, weight) of the best entry, or None for a value that means none."""
        if value is None:
            return None
        best = None
        for text, extra in (verb_variants if self.kind == "verb" else name_variants)(value):
            if not text or len(text) > self.longest + self.most or not self.possible(text):
                continue
            negated = bool(_NEGATED.search(text))
            tried: set[int] = set()
            for d in deletions(text, self.most):
                for a in self.index.get(d, ()):
                    if a in tried:
                        continue
                    tried.add(a)
                    alias, e = self.aliases[a]
                    # a verb's polarity is no spelling: text and alias must both show a negation or both none
                    apart = self.kind == "verb" and negated != bool(_NEGATED.search(alias))
                    limit = allowed(len(alias), self.most) - apart
                    far = edits(text, alias, limit) if limit >= 0 else None
                    if far:
                        rank = (far[0] + apart, round(far[1] + extra + apart, 3), -self.freq[e], self.ids[e])
                        if best is None or rank < best:
                            best = rank
        return None if best is None else (best[3], best[0], best[1])


def _look_up(shared):
    @F.pandas_udf("struct<edits:int,weight:double,nfreq:long,ref_id:string>")
    def look_up(s: pd.Series) -> pd.DataFrame:
        d = shared.value
        freq = dict(zip(d.ids, d.freq))
        got = [(h[1], h[2], -freq[h[0]], h[0]) if (h := d.lookup(v)) else (None, None, None, None) for v in s]
        return pd.DataFrame(got, columns=["edits", "weight", "nfreq", "ref_id"]).astype(
            {"edits": "Int32", "weight": "float64", "nfreq": "Int64", "ref_id": "object"}
        )

    # named non-deterministic so that no filter on its result is moved below the distinct, nor the call repeated
    return look_up.asNondeterministic()


def look_up_values(
    names: DataFrame, entries: DataFrame, kind: str = "name", most_edits: int | None = None, entries_per_block: int | None = None
) -> DataFrame:
    """Rows (name, ref_id, edits, weight) of the distinct ``names.name``, null where a name means no entry.

    ``entries``: rows (ref_id, canonical_name[, frequency]). ``kind`` is ``name`` or ``verb`` (endings of a
    verb are set aside, its negation is not). A symmetric-delete dictionary of the list is broadcast, in
    blocks of at most ``entries_per_block`` entries: one block is looked up at a time, the best rank so far is written to
    the shared folder and the block's dictionary given up before the next, so a worker never holds more than
    one, whatever the list. Every distinct name is looked up once a block.

    Null, blank and sign-only names mean no entry. Ties go to fewer edits, less weight, the entry with
    the higher reference frequency, then the smaller id. An empty list maps nothing. Other columns are not read.
    """
    spark = names.sparkSession
    entries_per_block = entries_per_block or ENTRIES_PER_BLOCK[kind]
    most = MOST_EDITS[kind] if most_edits is None else most_edits
    has_freq = "frequency" in entries.columns
    listed = (
        entries.select(
            F.col("ref_id").cast("string"), F.col("canonical_name").cast("string"),
            (F.coalesce(F.col("frequency"), F.lit(0)).cast("long") if has_freq else F.lit(0).cast("long")).alias("n"),
        )
        .dropna(subset=["ref_id", "canonical_name"])
        .groupBy("ref_id", "canonical_name").agg(F.max("n").alias("n"))
        .orderBy("ref_id", "canonical_name")
    )
    # few bytes but much work a name: a number of tasks by the cores, dealt by a hash that no other exchange has,
    # as a repartition by the name itself would give way to the exchange of the distinct and be coalesced by size
    tasks = 3 * spark.sparkContext.defaultParallelism
    best = names.select("name").filter(F.col("name").isNotNull()).distinct()
    rank = F.lit(None).cast("struct<edits:int,weight:double,nfreq:long,ref_id:string>")
    best = best.withColumn("_best", rank)
    rows = listed.toLocalIterator()
    block = list(itertools.islice(rows, entries_per_block))
    while block:
        shared = spark.sparkContext.broadcast(Dictionary.build([(r[0], r[1], r[2]) for r in block], kind, most))
        hit = best.repartition(tasks, F.xxhash64("name")).withColumn("_hit", _look_up(shared)(F.col("name")))
        both = F.filter(F.array("_best", "_hit"), lambda h: h["ref_id"].isNotNull())
        best = hit.select("name", F.get(F.array_sort(both), F.lit(0)).alias("_best"))
        block = list(itertools.islice(rows, entries_per_block))
        if block:
            best = materialise(best, "best-entries")
            shared.destroy()
    return best.select("name", "_best.ref_id", "_best.edits", "_best.weight")


def map_to_list(
    values: DataFrame, value: str, spread: str, entries: DataFrame, kind: str = "name", most_edits: int | None = None,
    entries_per_block: int | None = None, counts: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``values`` that mean an entry, with its (ref_id, edits, weight); see ``look_up_values``.

    ``counts``: rows (name, n) of the distinct values with their numbers of rows, if they are at hand. Hits are few rows a
    name. Only rows whose value may be among them, by a Bloom filter of the hits, are shuffled to meet them, hot
    values split by ``spread``. Columns of ``values`` pass through; one named like an added column is given back as
    ``<name>_input``."""
    for c in ("ref_id", "edits", "weight"):
        if c in values.columns and c != value:
            values = values.withColumnRenamed(c, c + "_input")
            spread = c + "_input" if spread == c else spread
    if counts is None:
        counts = materialise(values.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("name")).agg(F.count(F.lit(1)).alias("n")), "value-counts")
    found = materialise(look_up_values(counts, entries, kind, most_edits, entries_per_block).filter(F.col("ref_id").isNotNull()), "mapped-values")
    maybe = "_maybe"
    while maybe in values.columns:
        maybe += "_"
    near = with_membership(values, [value], found, ["name"], found.count(), maybe).filter(maybe).drop(maybe)
    hot = hot_salts(counts.join(found.select("name"), "name", "left_semi"), ["name"], rows=F.col("n"))
    return salted_join(near, found.withColumnRenamed("name", value), [value], F.col(spread), hot=hot)
