"""Scalar text functions as column expressions; all but the compatibility form stay in the JVM."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Terms by which a document names itself.
SELF_REFERENCES = ["이 법", "이 영", "이 규칙", "이 규정", "본 법", "본 영", "본 규칙", "본 규정"]
# Endpoints too general to stand alone.
GENERIC_ENDPOINTS = ["각 호", "각호", "사항", "내용", "대상", "업무", "행위", "것", "경우", "금액", "기간", "비율", "횟수", "범위"]
# Names too general as a canonical name.
GENERIC_NAMES = ["자", "사람", "사항", "내용", "대상", "업무", "행위", "것", "경우", "금액", "기간", "비율", "횟수", "범위"]
# Units of quantities, and a quantity with its bound.
_UNIT = r"(?:조원|억원|만원|천원|원|년|개월|일|시간|회|명|인|세|등급|급|촌|점|통|주|부|건|개|퍼센트|%)"
QUANTITY = rf"\d[\d,]*(?:\.\d+)?\s*{_UNIT}\s*(?:이상|이하|초과|미만|이내|간|동안)?"
# Patterns of endpoints.
PURE_CONDITION = rf"(?U)\A(?:약\s*)?{QUANTITY}(?:\s*(?:부터|까지))?\z"
LEADING_CONDITION = rf"(?U)\A(?:약\s*)?{QUANTITY}\s*(?:의\s*)?(.+)$"
INLINE_CONDITION = rf"(?U)\s*(?:제\s*)?{QUANTITY}(?=\s|$|의|에|이|가|을|를|은|는)\s*(?:의\s*|(?:이|가|을|를|은|는)\s*)?"
PURE_RANGE = rf"(?U)\A(?:{QUANTITY}\s*)?부터\s*{QUANTITY}\s*까지(?:의\s*(?:구분|범위))?\z"
ENUMERATION = r"(?U)\s*(?:,|ㆍ|·)\s*|\s+(?:또는|및)\s+"
# What a raw mention is warned of, a quantity anywhere, a citation as qualifier, an enumeration, and actions listed.
NUMERIC_CONSTRAINT = r"(?U)\d[\d,]*(?:\.\d+)?\s*(?:억원|만원|천원|원|년|개월|일|시간|회|명|인|세|급|등급|촌|퍼센트|%)\s*(?:이상|이하|초과|미만|이내|간|동안)?|\d+\s*분의\s*\d+"
LEGAL_QUALIFIER = r"(?U)(?:「[^」]+」|[가-힣A-Za-z0-9·ㆍ\s]+법)\s*(?:제\d+조(?:제\d+항)?)?\s*(?:에\s*)?(?:따른|따라)"
LISTING = r"(?U)\s(?:및|또는|내지)\s|[ㆍ,]"
LISTED_ACTIONS = "거나"
LEGAL_SUFFIX = r"(?:법|법률|시행령|시행규칙|규정)$"
EXPLICIT_ENUMERATION = r"(?U),|ㆍ|·|\s+(?:또는|및)\s+"
QUALIFIED_PERSON = r"(?U)(?:경력이\s*있는|자격이\s*있는|재직한|근무한|담당한|종사한).*(?:사람|자)$"
PERIOD_PERSON = r"(?U)\d[\d,]*(?:\.\d+)?\s*(?:년|개월).*?지나지\s*(?:아니한|않은).*(?:사람|자)$"
SHARED_GENITIVE = r"(?U)\A(.+의)\s+(\S+)\z"
# Cues of conditions and citations in a name.
CONTEXT_CUE = r"(?U)\d|[「」『』]|에\s*따른|에\s*따라|으로\s*정하는|이내|이하|이상|초과|미만|동안|부터|까지"
LAW_SECTION = r"(?U)\A(.+?(?:법률|법|시행령|시행규칙|규정|기준))\s+제\d+조(?:의\d+)?"
_SECTION_PARTS = r"제\d+조(?:의\d+)?(?:제\d+항)?(?:제\d+호)?(?:[가-하]목)?(?:\s*(?:전단|후단|단서|본문))?"
BARE_LOCAL_SECTION = rf"(?U)\A(?:법\s*)?{_SECTION_PARTS}(?:\s*(?:・|및|부터|까지|제|\d|항|호|목|의|\s|규정))*\z"
BARE_NAMED_SECTION = rf"(?U)\A[「『]?(?:.+?(?:법률|법|시행령|시행규칙|규정|기준))[」』]?\s+{_SECTION_PARTS}\z"
QUALIFIED_TAIL = r"(?U)에\s*(?:따른|따라)\s*(.+)$"
QUALIFIER_ONLY = r"""(?U)에\s*해당하는|각\s*호의\s*어느\s*하나에|에서\s*[「『"'“”]?"""
LEADING_PARTICIPLE = r"(?U)\A(?:지정된|설립된|등록된|작성된|제출된|발행된|인가받은|허가받은)\s+"
# Punctuation and spaces left out of a lexical key.
LEXICAL_PUNCTUATION = " \t\r\n\"'“”‘’「」『』·ㆍ・,.()[]{}"
NEGATIVE_CUE = r"(?:않|아니|못|없(?:다|는|어|었|을|고|으))"
# Particles, stop words and sizes of the retrieval terms, then of the ranking terms.
QUERY_PARTICLES = (
    "으로부터 에서부터 에게서는 에서는 에게서 으로는 로부터 까지는 과의 와의 에게 에서 으로 부터 까지 처럼 보다 에는 로는 은 는 이 가 을 를 와 과 의 에 로"
).split()
QUERY_STOP_WORDS = "어떻게 연결 연결되는가 무엇인가 무엇 근거 법령 각".split()
SEARCH_PARTICLES = "에서는 으로부터 에게서 에서 으로 에게 까지 부터 에는 과는 와는 이란 란 은 는 이 가 을 를 에 의 과 와 로".split()
SEARCH_STOP_WORDS = "관한 관련 어떻게 무엇 무엇이며 되는가 있는가 규정 사항".split()
QUERY_TERMS, SEARCH_TERMS = 8, 12
_WORDS = r"[0-9A-Za-z가-힣]+"


def _re(pattern: str) -> Column:
    return F.lit(pattern)


def trim_all(x: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(x, r"(?U)\A\s+|\s+\z", "")


def clean_name(x: Column) -> Column:
    """White space collapsed and trimmed, one pair of equal quotes removed."""
    flat = trim_all(F.regexp_replace(x, r"(?U)\s+", " "))
    return trim_all(F.regexp_replace(flat, r"""\A(["'])(.*)\1\z""", "$2"))


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def lexical_key(x: Column) -> Column:
    """Compatibility form without punctuation and spaces; only texts with other characters than ASCII and
    whole Hangul syllables are handed to Python."""
    odd = F.when(~x.rlike(r"\A[\x00-\x7f가-힣]*\z"), x)
    return F.translate(F.coalesce(_nfkc(odd), x), LEXICAL_PUNCTUATION, "")


def resolve_self_reference(name: Column, document_title: Column) -> Column:
    """STRUCT<name, method>: a term by which the document names itself gives the document's title."""
    n = trim_all(name)
    own = n.isin(SELF_REFERENCES)
    return F.struct(
        F.when(own, trim_all(document_title)).otherwise(n).alias("name"),
        F.when(own, "current_document_self_reference").otherwise("exact_surface").alias("method"),
    )


def infer_polarity(x: Column) -> Column:
    return F.when(x.rlike(NEGATIVE_CUE), "NEGATIVE").otherwise("POSITIVE")


def polarity_consistent(name: Column, polarity: Column) -> Column:
    return infer_polarity(name) == polarity


def is_discardable(x: Column) -> Column:
    """Empty, a general word alone, or nothing but a quantity."""
    return (x == "") | x.isin(GENERIC_ENDPOINTS) | x.rlike(PURE_CONDITION)


def strip_leading_condition(x: Column) -> Column:
    return trim_all(F.when(x.rlike(LEADING_CONDITION), F.regexp_extract(x, LEADING_CONDITION, 1)).otherwise(x))


def is_protected_name(x: Column) -> Column:
    """Wholly quoted, or ending as a legal text does without listing several."""
    quoted = x.rlike(r"(?s)\A(?:「.*」|『.*』)\z")
    return quoted | (x.rlike(LEGAL_SUFFIX) & ~x.rlike(EXPLICIT_ENUMERATION))


def split_enumeration(x: Column) -> Column:
    """Parts of a clear enumeration; a genitive prefix of the first part is shared by the others."""
    parts = F.transform(F.split(x, ENUMERATION), trim_all)
    first = F.get(parts, F.lit(0))
    prefix = F.regexp_extract(first, SHARED_GENITIVE, 1)
    shared = F.transform(
        parts,
        lambda p, i: F.when((i == 0) | p.contains("의 ") | p.startswith(prefix), p).otherwise(F.concat(prefix, F.lit(" "), p)),
    )
    return F.when((F.size(parts) > 1) & (prefix != ""), shared).otherwise(parts)


def sanitize_endpoint(x: Column) -> Column:
    """Endpoints (ARRAY<STRING>, maybe empty) of a raw subject or object; null for null.

    Leading and inline quantities go, general words and mere quantities are dropped, qualified persons become a
    person, names of legal texts stay whole, and clear enumerations are split."""
    none = F.array().cast("array<string>")
    v = trim_all(x)
    led = strip_leading_condition(v)
    inner = trim_all(F.regexp_replace(F.regexp_replace(led, INLINE_CONDITION, " "), r"(?U)\s+", " "))
    inner = F.regexp_replace(inner, r"(?U)도\s+에\s+", "도 ")
    inner = F.regexp_replace(inner, r"(?U)\s+(?=(?:에|에서|으로|로)\s)", "")
    inner = trim_all(F.regexp_replace(inner, r"(?U)\A(?:및|또는)\s+|\s+(?:및|또는)\z", ""))
    parts = split_enumeration(inner)
    kept = F.array_distinct(F.filter(F.transform(parts, strip_leading_condition), lambda p: ~is_discardable(p)))
    return (
        F.when(x.isNull(), F.lit(None).cast("array<string>"))
        .when(is_discardable(v), none)
        .when(is_discardable(led), none)
        .when(led.rlike(PERIOD_PERSON), F.array(led))
        .when(led.rlike(QUALIFIED_PERSON), F.array(F.lit("사람")))
        .when(is_protected_name(led), F.array(led))
        .when(led.rlike(PURE_RANGE), none)
        .when(is_discardable(inner), none)
        .when(F.size(parts) > 1, kept)
        .otherwise(F.array(inner))
    )


def needs_context(name: Column) -> Column:
    """Names likely to hold conditions, citations or clauses."""
    return (F.length(name) >= 12) | name.rlike(CONTEXT_CUE)


def qualified_tail(name: Column) -> Column:
    """What a citation qualifies, or null."""
    tail = F.regexp_replace(trim_all(F.regexp_extract(name, QUALIFIED_TAIL, 1)), LEADING_PARTICIPLE, "")
    return F.when((tail != "") & ~tail.isin(GENERIC_NAMES), tail)


def is_bare_citation(name: Column) -> Column:
    return name.rlike(BARE_LOCAL_SECTION) | name.rlike(BARE_NAMED_SECTION)


def acceptable_canonical(source: Column, canonical: Column) -> Column:
    s, c = trim_all(F.coalesce(source, F.lit(""))), trim_all(F.coalesce(canonical, F.lit("")))
    return (s != "") & (c != "") & ~(c.isin(GENERIC_NAMES) & (s != c))


def guard_contextual(source: Column, canonical: Column, status: Column) -> Column:
    """STRUCT<canonical_name, normalization_status> of a proposed canonical name after the four guards."""
    s, c = trim_all(source), trim_all(canonical)
    law = c.rlike(LAW_SECTION)
    tail = qualified_tail(s)
    title = F.regexp_replace(F.regexp_extract(c, LAW_SECTION, 1), r"\A[「」『』 ]+|[「」『』 ]+\z", "")
    generic = c.isin(GENERIC_NAMES) & (s != c)

    def out(name: Column, st: Column) -> Column:
        return F.struct(name.alias("canonical_name"), st.alias("normalization_status"))

    return (
        F.when(generic, out(s, F.lit("guarded_generic_only_result")))
        .when(law & tail.isNotNull(), out(tail, F.lit("rule_qualified_endpoint_not_law")))
        .when(law & s.rlike(QUALIFIER_ONLY), out(s, F.lit("guarded_qualified_endpoint_not_law")))
        .when(law & is_bare_citation(s), out(title, F.lit("rule_bare_citation_to_law_name")))
        .otherwise(out(canonical, status))
    )


def _strip_first_particle(word: Column, particles: list[str]) -> Column:
    """Without the first listed particle that leaves two characters. The list names longer particles before their own
    ends, so the alternation of the pattern, tried from the left of the word, takes the same one."""
    return F.regexp_replace(word, rf"\A(.{{2,}}?)(?:{'|'.join(particles)})\z", "$1")


def _terms(text: Column, particles: list[str], stop: list[str], most: int) -> Column:
    bare = F.transform(F.regexp_extract_all(text, F.lit(_WORDS), F.lit(0)), lambda w: _strip_first_particle(w, particles))
    return F.slice(F.array_distinct(F.filter(bare, lambda w: (F.length(w) >= 2) & ~w.isin(stop))), 1, most)


def query_terms(text: Column) -> Column:
    """Terms of retrieval, case kept."""
    return _terms(text, QUERY_PARTICLES, QUERY_STOP_WORDS, QUERY_TERMS)


def search_terms(text: Column) -> Column:
    """Terms of ranking, lower case; other particles and stop words than those of retrieval."""
    return _terms(F.lower(text), SEARCH_PARTICLES, SEARCH_STOP_WORDS, SEARCH_TERMS)


def search_terms_of(text: str) -> list[str]:
    """``search_terms`` of a text known on the driver."""
    out: list[str] = []
    for w in re.findall(_WORDS, text.lower()):
        w = next((w[: -len(p)] for p in SEARCH_PARTICLES if w.endswith(p) and len(w) - len(p) >= 2), w)
        if len(w) >= 2 and w not in SEARCH_STOP_WORDS and w not in out:
            out.append(w)
    return out[:SEARCH_TERMS]


def query_terms_of(text: str) -> list[str]:
    """``query_terms`` of a text known on the driver."""
    out: list[str] = []
    for w in re.findall(_WORDS, text):
        w = next((w[: -len(p)] for p in QUERY_PARTICLES if w.endswith(p) and len(w) - len(p) >= 2), w)
        if len(w) >= 2 and w not in QUERY_STOP_WORDS and w not in out:
            out.append(w)
    return out[:QUERY_TERMS]


def compact_of(text: str) -> str:
    """``compact`` of a text known on the driver."""
    return re.sub("[^0-9a-z가-힣]", "", text.lower())


def strength_of(value: str | None, compact_query: str) -> float:
    """``match_strength`` of a value known on the driver."""
    v = compact_of(value or "")
    return min(1.0, len(v) / 10.0) if len(v) >= 2 and v in compact_query else 0.0


def compact(x: Column) -> Column:
    return F.regexp_replace(F.lower(x), "[^0-9a-z가-힣]", "")


def match_strength(value: Column, query: Column) -> Column:
    """0 unless the compact value (2 characters or more) is in the compact query, else its length by 10, at most 1."""
    v = compact(value)
    return F.when((F.length(v) >= 2) & (F.instr(compact(query), v) > 0), F.least(F.lit(1.0), F.length(v) / F.lit(10.0))).otherwise(F.lit(0.0))


def source_ref_text(ref: Column) -> Column:
    items = F.when(F.size(ref["item_path"]) > 0, F.array_join(ref["item_path"], "-"))
    article = F.when(ref["article"] != "", ref["article"])
    return F.concat_ws(" ", article, F.concat(F.lit("제"), ref["paragraph"].cast("string"), F.lit("항")), items)


def path_text(edges: Column, titles: Column) -> Column:
    """``edges``: ARRAY<STRUCT<source_name, relation_type_name, target_name>>."""
    body = F.array_join(
        F.transform(edges, lambda e: F.concat(e["source_name"], F.lit(" - "), e["relation_type_name"], F.lit(" → "), e["target_name"])), " / "
    )
    return F.when(F.size(titles) > 0, F.concat(body, F.lit(" (근거 문서: "), F.array_join(titles, ", "), F.lit(")"))).otherwise(body)


def slug(x: Column) -> Column:
    """Index name: lower case, other characters than letters and digits as '-', none at the ends, 180 at most."""
    s = F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "-"), r"\A-+|-+\z", "")
    return F.nullif(F.substring(s, 1, 180), F.lit(""))


def sql_literal(x: Column) -> Column:
    return F.when(x.isNull(), "NULL").otherwise(F.concat(F.lit("'"), F.replace(x, F.lit("'"), F.lit("''")), F.lit("'")))


def resolution_type(unit_text: Column, resolved: Column) -> Column:
    """COPIED where the resolved text equals the unit's, else CONTEXT_INHERITED; null where it is empty."""
    r = trim_all(resolved)
    return F.when(r == "", None).when(r == trim_all(unit_text), "COPIED").otherwise("CONTEXT_INHERITED")


RELATIONS_SCHEMA = "STRUCT<relations: ARRAY<STRUCT<subject: STRING, predicate: STRING, object: STRING>>>"


def strip_fence(x: Column) -> Column:
    return F.regexp_replace(trim_all(x), r"(?s)\A```[A-Za-z]*\s*(.*?)\s*```\z", "$1")


def parse_relations(response: Column) -> Column:
    """Relations of a model's answer; null for an answer that is no such object. Incomplete triples are left out."""
    got = F.from_json(strip_fence(response), RELATIONS_SCHEMA)["relations"]
    full = lambda r: (trim_all(F.coalesce(r["subject"], F.lit(""))) != "") & (trim_all(F.coalesce(r["predicate"], F.lit(""))) != "") & (trim_all(F.coalesce(r["object"], F.lit(""))) != "")
    return F.filter(got, full)


def citation_keys(answer: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(answer, F.lit(r"\[(E\d+)\]"), F.lit(1)))


def invalid_citations(answer: Column, allowed: Column) -> Column:
    return F.array_except(citation_keys(answer), allowed)


def entity_embedding_text(canonical: Column, aliases: Column, most: int = 20) -> Column:
    """Canonical name with up to ``most`` distinct other names."""
    others = F.slice(F.array_except(F.array_distinct(F.filter(aliases, lambda a: a.isNotNull())), F.array(canonical)), 1, most)
    return F.concat_ws("\n", canonical, F.nullif(F.array_join(others, ", "), F.lit("")))


def relation_embedding_text(source: Column, relation_type: Column, target: Column) -> Column:
    return F.concat_ws(" ", source, relation_type, target)


# Fixed value: characters by which a wrongly decoded name is suspected.
MOJIBAKE = "[\u00c0-\u024f\ufffd]"


def looks_mojibake(x: Column) -> Column:
    return x.rlike(MOJIBAKE)


def run_id(stamp: Column, query: Column) -> Column:
    return F.concat(F.lit("query-"), stamp, F.lit("-"), F.substring(F.sha2(query, 256), 1, 10))


UUID = r"\A[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}\z"


def is_uuid(x: Column) -> Column:
    return x.rlike(UUID)
