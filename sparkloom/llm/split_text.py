"""Oversized items cut at natural boundaries into balanced pieces with an overlap."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.bloom import with_membership
from sparkloom.runtime import materialise

LIMIT = 800
OVERLAP = 80

# Strength of a cut right before the character at the match's end, strongest first.
_PATTERNS = (
    (9.0, re.compile(r"\n[ \t]*\n\s*")),
    (8.0, re.compile(r"\n(?=#{1,6} |제\d+조)")),
    (7.0, re.compile(r"\n(?=\*\*[①-⑳]|[①-⑳]|Article \d)")),
    (5.0, re.compile(r"\r?\n")),
    (4.0, re.compile(r"[.!?。！？…][\"'”’)\]」』]*\s+")),
    (3.0, re.compile(r"[;；]\s*|\s(?=[\U0001F300-\U0001FAFF☀-➿•●■◆▶※])")),
    (2.0, re.compile(r"[,，、:：|·]\s+|(?<=[^\d])[,，、](?=[^\d\s])")),
    (1.0, re.compile(r"\s+")),
)
_ITEM = re.compile(r"\n([ \t]*)(?=(?:\d{1,3}|[가나다라마바사아자차카타파하])(?:\\?[.)])|[-*•] )")


def boundaries(text: str) -> dict[int, float]:
    """Cut positions with their strength. An item of a list is the stronger the less deep it is nested."""
    out: dict[int, float] = {}
    for strength, pattern in reversed(_PATTERNS):
        for m in pattern.finditer(text):
            out[m.end()] = strength
    for m in _ITEM.finditer(text):
        depth = len(m.group(1).expandtabs(2)) // 2
        at = m.start() + 1
        out[at] = max(out.get(at, 0.0), 6.9 - 0.2 * min(depth, 8))
    out.pop(0, None)
    out.pop(len(text), None)
    return out


def _joined(text: str, at: int) -> bool:
    """Whether the character at that place belongs to the one before."""
    c, b = text[at], text[at - 1]
    if unicodedata.combining(c) or "ᅠ" <= c <= "ᇿ" or "︀" <= c <= "️" or c == "‍" or b == "‍":
        return True
    return c in "\U0001f3fb\U0001f3fc\U0001f3fd\U0001f3fe\U0001f3ff" or (c == "\n" and b == "\r")


#: Further pieces that are tried for a stretch whose cuts find no natural boundary.
MORE_PIECES = 2
#: Cuts of less strength fall inside a clause or word.
NATURAL = 2.0


def cuts(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[int]:
    """Cut positions so that pieces [cut - overlap, next cut) hold at most ``limit`` characters.

    The least number of pieces is computed; equal-length targets are placed and each is snapped to the
    strongest boundary near it (nearest at equal strength). A stretch of cuts without a natural boundary is placed again
    between the natural cuts around it with up to MORE_PIECES further pieces, and the placing with the fewest such cuts is kept;
    without boundaries the cut falls on the target, not inside a character with its accents. Time grows linearly with
    the text: every stretch is placed a fixed number of times."""
    n_chars = len(text)
    if n_chars <= limit:
        return []
    step = limit - overlap
    marks = boundaries(text)
    where = sorted(marks)

    def weak(cut: int) -> bool:
        return marks.get(cut, 0.0) < NATURAL

    got = _place(text, marks, where, None, n_chars, -(-(n_chars - overlap) // step), limit, overlap)
    if got is None:
        raise AssertionError("the least number of pieces always has room")
    out: list[int] = []
    k = 0
    while k < len(got):
        if not weak(got[k]):
            out.append(got[k])
            k += 1
            continue
        j = k
        while j < len(got) and weak(got[j]):
            j += 1
        best, fewest = got[k:j], j - k
        for more in range(1, MORE_PIECES + 1):
            again = _place(text, marks, where, out[-1] if out else None, got[j] if j < len(got) else n_chars, j - k + 1 + more, limit, overlap)
            if again is None:
                break
            n = sum(map(weak, again))
            if n < fewest:
                best, fewest = again, n
            if not n:
                break
        out.extend(best)
        k = j
    return out


def _place(text: str, marks: dict[int, float], where: list[int], before: int | None, end: int, n: int, limit: int, overlap: int) -> list[int] | None:
    """n - 1 cuts between the cut ``before`` (None: the text's beginning) and ``end``, or None if so many pieces have no room."""
    step = limit - overlap
    begin = overlap if before is None else before
    share = (end - begin) / n
    room = max(40, int(share // 3))
    got: list[int] = []
    last = before
    for k in range(1, n):
        low = max(overlap, 1) if last is None else last + 1
        high = limit if last is None else last + step
        low = max(low, end - (n - k) * step)  # the rest must fit
        high = min(high, end - 1)
        if low > high:
            return None
        target = min(max(round(begin + share * k), low), high)
        a, b = max(low, target - room), min(high, target + room)
        near = [(-marks[p], abs(p - target), p) for p in where[bisect_left(where, a) : bisect_right(where, b)]]
        if near:
            at = min(near)[2]
        else:
            at = target
            while at > low and _joined(text, at):
                at -= 1
            if _joined(text, at):
                at = target
        got.append(at)
        last = at
    return got


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, str]]:
    """(start, text) of each piece; one piece for a text within the limit."""
    c = cuts(text, limit, overlap)
    starts = [0, *[max(0, x - overlap) for x in c]]
    ends = [*c, len(text)]
    return [(a, text[a:b]) for a, b in zip(starts, ends)]


def latest_rows(df: DataFrame, key: str, fields: list[str], order: str | None) -> DataFrame:
    """One row (row_id, fields) per key: the one with the greatest ``order``, ties to the greatest fields.

    Only keys are shuffled to find those written more than once; a Bloom filter of these is broadcast, and what it denies is
    a single row and stays where it is. Only rows that may be repeated are shuffled with their texts."""
    keyed = df.filter(F.col(key).isNotNull())
    slim = keyed.select(F.col(key).alias("row_id"), *([F.col(order).alias("_order")] if order else []), *fields)
    again = materialise(slim.groupBy("row_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("row_id"), "repeated-keys")
    marked = with_membership(slim, ["row_id"], again, ["row_id"], again.count(), "_again")
    rank = F.struct(*(["_order"] if order else []), *fields)
    folded = marked.filter("_again").groupBy("row_id").agg(F.max(rank).alias("_r")).select("row_id", *[f"_r.{f}" for f in fields])
    return marked.filter(~F.col("_again")).select("row_id", *fields).unionByName(folded)


def split_texts(df: DataFrame, key: str, fields: list[str], order: str | None = None, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Rows (row_id, field_name, piece_no, n_pieces, start_at, piece): the pieces of every text.

    Pieces are numbered from 1, hold at most ``limit`` characters (Unicode code points) and each but the first
    begins with the last ``overlap`` characters of the one before. Texts within the limit are one piece and
    never leave the JVM; only oversized texts go through Python, in Arrow batches. Null texts give no piece,
    the empty text one empty piece. Of repeated rows of a key the one with the greatest ``order`` is kept, ties
    to the greatest text. Rows without a key give none.
    """
    if limit <= overlap:
        raise ValueError("limit must exceed overlap")
    names = {f: f"_f{i}" for i, f in enumerate(fields)}
    one = latest_rows(df.select(key, *({order} - {key, None}), *[F.col(f).alias(n) for f, n in names.items()]), key, list(names.values()), order)
    long = one.select(
        "row_id",
        F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(n).alias("t")) for f, n in names.items()])).alias("x"),
    ).select("row_id", "x.field_name", "x.t").filter(F.col("t").isNotNull())

    @F.pandas_udf("array<struct<start_at:int,piece:string>>")
    def cut(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [{"start_at": a, "piece": p} for a, p in pieces(t, limit, overlap)])

    big = F.length("t") > limit
    short = long.filter(~big).select(
        "row_id", "field_name", F.lit(1).alias("piece_no"), F.lit(1).alias("n_pieces"), F.lit(0).alias("start_at"), F.col("t").alias("piece")
    )
    cut_up = (
        long.filter(big)
        .withColumn("p", cut("t"))
        .select("row_id", "field_name", F.posexplode("p"), F.size("p").alias("n_pieces"))
        .select("row_id", "field_name", (F.col("pos") + 1).alias("piece_no"), "n_pieces", "col.start_at", "col.piece")
    )
    return short.unionByName(cut_up)
