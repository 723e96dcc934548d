import re
import uuid

from pyspark.sql import functions as F

from sparkloom.functions.ids import NAMESPACE
from sparkloom.operators.segment import ARTICLE, CIRCLED, ITEM, PARAGRAPH, SUPPLEMENT, segment
from sparkloom.runtime import table

NS = uuid.UUID(NAMESPACE)


def py(pattern):
    return re.compile(pattern.replace("(?U)", "").replace(r"\z", r"\Z"))


A, S, P, I = map(py, (ARTICLE, SUPPLEMENT, PARAGRAPH, ITEM))


def joined(lines):
    return "\n".join(x.strip() for x in lines if x.strip())


def model(doc_id, text):
    """A plain walk over the lines with a stack of open items."""
    rows, title, meta = text.splitlines(), None, {}
    start = 0
    if rows and rows[0].strip() == "---" and any(x.strip() == "---" for x in rows[1:]):
        start = next(i for i, x in enumerate(rows) if i and x.strip() == "---") + 1
        for x in rows[1 : start - 1]:
            if ":" in x and x[:1] not in (" ", "-"):
                k, v = x.split(":", 1)
                meta[k.strip()] = v.strip().strip("'\"")
        title = meta.get("제목")
    else:
        title = next((x[2:].strip() for x in rows if x.startswith("# ")), None)
    title = str(doc_id) if title is None else title
    official = meta.get("법령MST") or meta.get("법령ID")
    ident = f"official:{official}:{title}" if official else f"source:{meta['출처']}" if meta.get("출처") else f"path:{doc_id}:{title}"
    did = str(uuid.uuid5(NS, f"document|{ident}"))
    articles = []
    for x in rows[start:]:
        if S.match(x):
            break
        if m := A.match(x):
            articles.append((re.sub(r"\s+", "", m[1]), x.strip(), [[None, []]]))
        elif not x.startswith("#") and articles:
            parts = articles[-1][2]
            if m := P.match(x):
                parts.append([CIRCLED.index(m[1]) + 1, [m[2]]])
            else:
                parts[-1][1].append(x)
    out = []
    for label, heading, parts in articles:
        for number, lines in parts:
            intro, items = [], []  # items: indent, marker, lines
            for k, x in enumerate(lines):
                m = I.match(x) if not (k == 0 and number) else None
                if m:
                    items.append((len(m[1].expandtabs(2)), m[2], [m[3]]))
                else:
                    (items[-1][2] if items else intro).append(x)
            base = [heading] + ([f"{label} 제{number}항"] if number else [])
            head = joined(intro)

            def emit(path, kind, body, context, governing):
                name = "|".join(["semantic_unit", did, label, str(number or "article_body"), "/".join(path), kind, body])
                out.append((str(uuid.uuid5(NS, name)), label, number, tuple(path), "\n".join(context), body, kind, governing))

            if not items and head:
                emit([], "paragraph", head, base, "")
            open_items = []
            for k, (indent, marker, body) in enumerate(items):
                while open_items and open_items[-1][0] >= indent:
                    open_items.pop()
                if (k + 1 == len(items) or items[k + 1][0] <= indent) and joined(body):
                    above = [t for t in (joined(o[2]) for o in open_items) if t]
                    gov = ([head] if head else []) + above
                    emit([o[1] for o in open_items] + [marker], "terminal_item", joined(body), base + gov, "\n".join(gov))
                open_items.append((indent, marker, body))
    return out


def units(df):
    return sorted(
        ((r.semantic_unit_id, r.source_ref.article, r.source_ref.paragraph, tuple(r.source_ref.item_path), r.context_text, r.unit_text, r.unit_kind, r.governing_text) for r in df.collect()),
        key=repr,
    )


SMALL = """---
제목: '시험 규정'
법령ID: 7
---
# 시험 규정
머리말
##### 제1조(목적)
본문이다.

##### 제2조의 2(항목)
**①** 다음과 같다.
  1\\. 첫째
    가\\. 잎
    이어지는 줄
    나\\.  
  2\\. 둘째
**②**
**③** 끝.
## 장 제목
##### 부칙 이야기
##### 부칙
##### 제9조(없음)
없다.
"""


def test_small_document(spark):
    docs = spark.createDataFrame([(1, SMALL), (2, None), (3, ""), (4, "# 제목만\n")], "doc_id long, text string")
    got = units(segment(docs, "doc_id", "text"))
    assert got == sorted(model(1, SMALL), key=repr)
    assert [(g[1], g[2], g[3]) for g in sorted(got, key=lambda g: (g[1], g[2] or 0, g[3]))] == [
        ("제1조", None, ()), ("제2조의2", 1, ("1", "가")), ("제2조의2", 1, ("2",)), ("제2조의2", 3, ()),
    ]


def test_whole_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    want = [u for r in docs.filter(F.col("text").isNotNull()).collect() for u in model(r.doc_id, r.text)]
    assert units(segment(docs, "doc_id", "text")) == sorted(want, key=repr)
    assert len(want) > 500
