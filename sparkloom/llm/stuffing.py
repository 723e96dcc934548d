"""Keyword-stuffed and link-list pages: a hidden Markov model over lines, fitted to the collection."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATES = ("prose", "links", "tags", "menu")
#: Words of one line at most; a longer line is cut into lines of like length.
LINE_WORDS = 14
#: A page is flagged when more than this share of its words is not prose.
SHARE = 0.5
#: Pages to which the model is fitted, about.
SAMPLE_PAGES = 2_000
#: Rounds of the fit.
ROUNDS = 4
#: A word comes again and again if it makes up one in so many words of its page (and comes three times).
AGAIN_ONE_IN = 25

_LINK = re.compile(r"!?\[[^\]\n]*\]\([^)\s]*\)|(?:https?://|www\.)\S+", re.I)
_ANCHOR = re.compile(r"!?\[([^\]\n]*)\]")
_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[^\\\d\s][.!?。])\s+(?!\[|https?:|www\.)")
_STRUCTURE = re.compile(r"\s*(?:#{1,6}\s|[-*•]?\s*제\s*\d+\s*(?:조|장|절|편)|\S{1,12}\s*:\s|-{3,}\s*$)")
_HEADS = frozenset("#-*•제")
_ITEM = re.compile(r"\s*(?:[-*•]|\d{1,3}\\?[.)]|\w\\?[.)])\s+")
_TAG_LABEL = re.compile(r"태그\s*:|\btags?\s*:", re.I)
_TAG = re.compile(r"(?<!\S)#[^\W_][\w-]*")


def lines(text: str) -> list[str]:
    """The lines of a page; sentences count as lines, and long runs of words are cut."""
    out = []
    for line in text.splitlines():
        if not line.strip():
            continue
        for part in [line] if _heading(line) else _SENTENCE.split(line):
            words = part.split()
            if len(words) <= LINE_WORDS:
                if words:
                    out.append(part)
            else:  # lines of like length: a short rest would say little
                n = -(-len(words) // LINE_WORDS)
                out.extend(" ".join(words[len(words) * i // n : len(words) * (i + 1) // n]) for i in range(n))
    return out


def ending(low: str) -> str:
    """By what a word is known as one of running text or of lists: a short alphabetic word itself, the last three letters of a
    longer one, the last character in scripts of syllables."""
    if low[-1] >= "⺀":
        return low[-1] if len(low) > 1 else "=" + low
    return "=" + low if len(low) <= 4 else low[-3:]


class _Words(dict):
    """Word as written -> (ending, the word in lower case or None), a bounded memory. Short alphabetic words, which any text
    repeats, are not counted as repetitions: None."""

    def __missing__(self, word: str) -> tuple[str, str | None]:
        low = word.lower()
        if len(self) >= 200_000:
            self.clear()
        got = self[word] = (ending(low), low if low[-1] >= "⺀" or len(low) > 3 else None)
        return got


_KNOWN = _Words()


def _unlinked(text: str) -> str:
    """The text with links replaced by their anchor texts."""
    if "://" not in text and "](" not in text and "www." not in text.lower():
        return text
    return _LINK.sub(lambda m: " " + " ".join(_ANCHOR.findall(m.group())) + " ", text)


@dataclass(slots=True)
class Line:
    """What is seen of a line: words (a link counts as two), levels of link, tag, repeated and doubled, whether it is a
    heading, and the endings of its words but the last.

    link: 0 none, 1 beside words, 2 hardly anything but links. tag: 0 none, 1 some, 2 mostly tags. repeated: share of words
    that come again and again in the page, 0 few, 1 many, 2 nearly all. doubled: share of words that the line itself
    repeats, 0 few, 1 some, 2 many."""

    words: int
    link: int
    tag: int
    repeated: int
    doubled: int
    heading: bool
    ends: list[str]


def _heading(line: str) -> bool:
    return (":" in line or line.lstrip()[:1] in _HEADS) and _STRUCTURE.match(line) is not None


def see_page(text: str | None) -> list[Line]:
    if not text:
        return []
    split = []
    every: list[str] = []
    for line in lines(text):
        linked = "://" in line or "](" in line or "www." in line.lower()
        known = [_KNOWN[w] for w in _WORD.findall(_unlinked(line) if linked else line)]
        content = [s for _, s in known if s is not None]
        every += content
        split.append((line, linked, known, content))
    least = max(3, len(every) // AGAIN_ONE_IN)
    again = {s for s, n in Counter(every).items() if n >= least}
    return [_see(*x, again) for x in split]


def _see(line: str, linked: bool, known: list[tuple[str, str | None]], content: list[str], again: set[str]) -> Line:
    urls = len(_LINK.findall(line)) if linked else 0
    link = 0
    if urls:
        outside = _WORD.findall(_ITEM.sub("", _LINK.sub(" ", line)))
        link = 2 if len(outside) <= 2 * urls else 1
    tags = len(_TAG.findall(line)) if "#" in line else 0
    if ":" in line and _TAG_LABEL.search(line):
        tags = max(tags, len(known) // 2 + 1)
    tag = 0 if not tags else 2 if tags * 2 >= len(known) else 1
    repeated = doubled = 0
    n = len(content)
    if n:
        if again:
            rep = sum([s in again for s in content]) / n
            repeated = 0 if rep < 0.4 else 1 if rep < 0.75 else 2
        twice = 1 - len(set(content)) / n
        doubled = 0 if twice < 0.2 else 1 if twice < 0.4 else 2
    return Line(max(1, len(known) + 2 * urls), link, tag, repeated, doubled, _heading(line), [e for e, _ in known[:-1]])


def weak_label(x: Line, ends: int) -> int | None:
    """The state that a line has by definition, where it leaves no doubt: hardly anything but links or tags, words of which nearly
    all come again in the page and some in the line itself, or nothing of all that. Running text without a word twice is prose
    however often the page repeats its words, and beside a link if it doesn't: else a sample with few such pages takes them for links."""
    if x.link == 2:
        return 1
    if x.tag == 2:
        return 2
    if x.link or x.tag:
        return 0 if not x.tag and not x.repeated and not x.doubled and ends == 2 else None
    if x.repeated == 2 and x.doubled >= 1:
        return 3
    return 0 if not x.doubled and (not x.repeated or ends == 2) else None


#: Levels of the link and tag features, and of the words: repeated, doubled and endings together.
LEVELS = (3, 3, 36)


def _words_level(repeated: int, doubled: int, ends: int) -> int:
    return (repeated * 3 + doubled) * 4 + ends


#: Lines by definition that the counts begin with, so that a state no sampled page shows still has chances.
_DEFINED = {0: (0, 0, _words_level(0, 0, 2)), 1: (2, 0, _words_level(0, 0, 0)), 2: (0, 2, _words_level(0, 0, 0)), 3: (0, 0, _words_level(2, 2, 0))}


@dataclass
class Model:
    """Log chances counted from the sample: ``ends`` of word endings (running text over lists), ``start``, ``move`` and
    ``emit``, the last one for every level of link, tag and words in every state."""

    ends: dict[str, float]
    start: np.ndarray
    move: np.ndarray
    emit: list[np.ndarray]

    def of_ends(self, x: Line) -> int:
        """Level of a line's endings: 0 as in lists, 2 as in running text, 3 a heading or a lone word; 1 says nothing, as half of
        them or more are unknown (a language the sample hardly holds) or they stand against each other."""
        if x.heading or not x.ends:
            return 3
        get = self.ends.get
        known = [v for w in x.ends if (v := get(w)) is not None]
        score = sum(known) / len(x.ends) if len(known) * 2 > len(x.ends) else 0.0
        return 0 if score < -0.3 else 1 if score < 0.3 else 2

    def levels(self, x: Line) -> tuple[int, int, int]:
        return x.link, x.tag, _words_level(x.repeated, x.doubled, self.of_ends(x))

    def label(self, page: list[Line]) -> list[str]:
        """The likeliest states of the lines; ties go to the state named first."""
        if not page:
            return []
        # the chances of a step to each state, its emission included, by what is seen
        known: dict[tuple[int, ...], list[tuple[float, ...]]] = {}
        a = b = c = d = 0.0
        back: list[tuple[int, int, int, int]] = []
        first = True
        for x in page:
            o = self.levels(x)
            rows = known.get(o)
            if rows is None:
                e = sum(t[:, v] for t, v in zip(self.emit, o))
                rows = known[o] = [tuple(r) for r in (self.move + e).T.tolist()] + [tuple((self.start + e).tolist())]
            if first:
                (a, b, c, d), first = rows[4], False
                continue
            best, come = [], []
            for ma, mb, mc, md in rows[:4]:
                top, k = a + ma, 0
                if b + mb > top:
                    top, k = b + mb, 1
                if c + mc > top:
                    top, k = c + mc, 2
                if d + md > top:
                    top, k = d + md, 3
                best.append(top)
                come.append(k)
            a, b, c, d = best
            back.append(tuple(come))
        score = (a, b, c, d)
        k = score.index(max(score))
        path = [k]
        for come in reversed(back):
            k = come[k]
            path.append(k)
        return [STATES[k] for k in reversed(path)]


def _chances(counts: list[np.ndarray]) -> list[np.ndarray]:
    """Counts of levels as chances; endings that say nothing have the chance of whatever endings with the other words' levels."""
    link, tag, text = counts
    cells = text.reshape(len(text), -1, 4)
    cells[:, :, 1] = 0
    out = [t / t.sum(axis=1, keepdims=True) for t in (link, tag, text)]
    cells = out[-1].reshape(len(text), -1, 4)
    cells[:, :, 1] = cells.sum(axis=2)
    return out


def fit(texts: list[str]) -> Model:
    """The model of a sample of pages, without any labels given.

    1. Lines that are prose, links, tags or a menu beyond doubt by their definition are counted: word endings of running text
       against those of lists, and the levels in each state. 2. The Baum-Welch algorithm fits the chances to all lines, begun
       from these counts; lines beyond doubt keep their state in it, so that states keep their meaning while the lines in doubt
       and the moves between states are learned. The order of texts does not matter."""
    pages = [p for t in texts if (p := see_page(t))]
    plain, listed = Counter(), Counter()
    for p in pages:
        for x in p:
            w = weak_label(x, 0)
            if w is not None and not x.heading:
                (listed if w else plain).update(x.ends)
    a, b = max(1, sum(plain.values())), max(1, sum(listed.values()))
    scale = 3.0  # counts below this say little
    ends = {
        e: math.log((plain[e] / a * min(a, b) + scale) / (listed[e] / b * min(a, b) + scale)) for e in {*plain, *listed} if plain[e] + listed[e] >= scale
    }
    s = len(STATES)
    prior = [np.full((s, n), 0.5 if n < 10 else 0.1) for n in LEVELS]
    model = Model(ends, np.zeros(s), np.zeros((s, s)), [])
    for k, levels in _DEFINED.items():
        for t, v in zip(prior, levels):
            t[k, v] += 10
    seen = [np.array([model.levels(x) for x in p]) for p in pages]
    weak = [[weak_label(x, v[2] % 4) for x, v in zip(p, o)] for p, o in zip(pages, seen)]
    begun = [t.copy() for t in prior]
    for o, ws in zip(seen, weak):
        for row, w in zip(o, ws):
            if w is not None:
                for t, v in zip(begun, row):
                    t[w, v] += 1
    emit = _chances(begun)
    move = np.full((s, s), 0.05) + np.eye(s) * 0.8
    start = np.full(s, 1 / s)
    # pages of like length are stacked, the shorter ones filled up with lines that say nothing
    groups: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for o, ws in zip(seen, weak):
        # a line without a link is of no link list, one without a tag of no tag list
        may = np.array([[w == k or (w is None and (k != 1 or row[0] > 0) and (k != 2 or row[1] > 0)) for k in range(s)] for w, row in zip(ws, o)], dtype=float)
        groups.setdefault(1 << (len(o) - 1).bit_length(), []).append((o, may))
    stacked = []
    for length, g in sorted(groups.items()):
        there = np.array([[j < len(o) for j in range(length)] for o, _ in g])
        stacked.append((*[np.stack([np.pad(x[i], ((0, length - len(x[i])), (0, 0)), constant_values=i) for x in g]) for i in (0, 1)], there))
    for _ in range(ROUNDS):
        n_emit, n_move, n_start = [t.copy() for t in prior], np.full((s, s), 1.0) + np.eye(s) * 8, np.ones(s)
        for o, may, there in stacked:
            like = may.copy()
            for i, t in enumerate(emit):
                like *= t.T[o[:, :, i]]
            like[~there] = 1
            length = o.shape[1]
            fore = np.empty_like(like)
            fore[:, 0] = start * like[:, 0]
            fore[:, 0] /= fore[:, 0].sum(axis=1, keepdims=True)
            for j in range(1, length):
                fore[:, j] = (fore[:, j - 1] @ move) * like[:, j]
                fore[:, j] /= fore[:, j].sum(axis=1, keepdims=True)
            rear = np.ones_like(like[:, 0])
            for j in range(length - 1, -1, -1):
                post = fore[:, j] * rear
                post /= post.sum(axis=1, keepdims=True)
                post[~there[:, j]] = 0
                for i, t in enumerate(n_emit):
                    for v in np.unique(o[:, j, i]):
                        t[:, v] += post[o[:, j, i] == v].sum(axis=0)
                if j:
                    ahead = like[:, j] * rear
                    pair = fore[:, j - 1][:, :, None] * move[None] * ahead[:, None, :]
                    pair /= pair.sum(axis=(1, 2), keepdims=True)
                    pair[~there[:, j]] = 0
                    n_move += pair.sum(axis=0)
                    rear = ahead @ move.T
                    rear /= rear.sum(axis=1, keepdims=True)
                else:
                    n_start += post.sum(axis=0)
        emit = _chances(n_emit)
        move, start = n_move / n_move.sum(axis=1, keepdims=True), n_start / n_start.sum()
    return Model(ends, np.log(start), np.log(move), [np.log(t) for t in emit])


def label_page(text: str | None, model: Model) -> list[tuple[str, int]]:
    """(state, words) of every line of the page, a link counting as two words."""
    page = see_page(text)
    return [(s, x.words) for s, x in zip(model.label(page), page)]


def stuffed_share(text: str | None, model: Model) -> dict[str, float]:
    """Share of the page's words in each state other than prose; zeros for a page without words."""
    words: Counter = Counter()
    for state, n in label_page(text, model):
        words[state] += n
    total = sum(words.values())
    return {s: (words[s] / total if total else 0.0) for s in STATES[1:]}


def sample_pages(documents: DataFrame, key: str, text: str, pages: int = SAMPLE_PAGES) -> list[str]:
    """The texts of about ``pages`` pages (never more than twice as many) for the fit, chosen by the hash of their key from all the
    collection, however many files hold it, each shorter than 100,000 characters: a bound on what the driver gets. Only the
    fit uses a sample."""
    slim = documents.select(F.col(key).alias("k"), F.col(text).alias("t")).filter(F.length("t").between(1, 100_000))
    n = documents.count()
    if n > pages:
        # pages with a low hash, about ``pages`` of them: no task sends more than its share to the driver
        slim = slim.filter(F.xxhash64("k") < -(1 << 63) + (1 << 64) * pages // n)
    return [r["t"] for r in slim.orderBy(F.xxhash64("k"), "k", "t").limit(2 * pages).collect()]


def _pages(shared):
    @F.pandas_udf("struct<links:double,tags:double,menu:double>")
    def shares(s: pd.Series) -> pd.DataFrame:
        model = shared.value
        return pd.DataFrame([tuple(stuffed_share(t, model).values()) for t in s], columns=["links", "tags", "menu"])

    return shares


def stuffed_pages(documents: DataFrame, key: str, text: str, model: Model | None = None) -> DataFrame:
    """Rows (doc_id, links, tags, menu, stuffed): shares of non-prose words and whether they exceed SHARE together.

    Lines are labelled prose, link list, tag list or menu (lists of keywords) by the likeliest path of a hidden
    Markov model, so a heading inside a list or a link inside prose takes the label of its surroundings. Unless a
    ``model`` is given, it is fitted to a bounded sample of the documents (``fit``); labelling covers all of them and their
    whole texts, in one Arrow pass without a shuffle. No list of words of any language goes into it.

    Null, empty and blank texts have shares 0 and are not flagged. Repeated rows give repeated results; other
    columns are not read.
    """
    if model is None:
        model = fit(sample_pages(documents, key, text))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    slim = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("_t"))
    scored = slim.withColumn("s", _pages(shared)("_t"))
    share = F.col("s.links") + F.col("s.tags") + F.col("s.menu")
    return scored.select("doc_id", "s.links", "s.tags", "s.menu", (share > SHARE).alias("stuffed"))
