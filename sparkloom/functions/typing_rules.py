"""Rule cascades: entity types by the end of a name, and the direction guard of relation families."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENTITY_TYPES = ["ORGANIZATION", "PERSON", "LEGAL_INSTRUMENT", "CONCEPT", "OTHER"]

# Name endings of each type, in the order in which the types are tried.
LEGAL_ENDS = "법 법률 법령 시행령 시행규칙 규칙 규정 규약 조례 정관 고시 예규 훈령 대통령령 총리령 부령".split()
ORGANIZATION_ENDS = (
    "위원회 이사회 주주총회 협의회 금융감독원 감독원 회사 법인 기관 공공기관 금융기관 은행 저축은행 금고 대리점 지점 "
    "거래소 협회 조합 연합회 재단 공단 공사 정부 법원 검찰청 행정청 사무국 본부 센터 부서 사업자 업자 투자기구 "
    "감사기구 기업집단 지방자치단체 단체 결제원 총회 국가"
).split()
PERSON_ENDS = (
    "준법감시인 감사위원 위원장 대표이사 사외이사 상근이사 비상근이사 임원 직원 공무원 위원 이사 감사인 "
    "담당자 책임자 대표자 신청인 신청자 소비자 고객 본인 대리인 관계인 소유자 사용자 이용자 가입자 수익자 의뢰인 "
    "근로자 종업원 채무자 채권자 투자자 주주 사원 조합원 회계사 변호사 건축사 검사인 원장 기관장 부서장 팀장 실장 "
    "본부장 회장 사장 행장 장관 총재 대통령 의장 청산인 공직자 발행인 발기인 지배인 관리인 사용인 동일인 청구인 "
    "보험중개사 손해사정사 보험계약자 채권추심자 공개매수자 직무대행자 수탁자 위탁자 당사자 예탁자 질권자 회원 개인 누구든지 "
    "담당관 감시인 단장 자 사람"
).split()
CONCEPT_ENDS = (
    "벌금 과태료 과징금 부담금 수수료 보험료 대금 금액 개인정보 정보 자료 문서 서류 보고서 확인서 신청서 계획서 계약서 "
    "의무 권리 책임 권한 업무 행위 조치 절차 방법 내용 목적 필요성 지원 기준 요건 사유 기간 비율 범위 승인 허가 신고 보고 공시 공고 "
    "감사 검사 심사 조사 제재 처분 경고 주의 정지 취소 해임 지정 등록 신청 제출 작성 보관 예금 보험 대출 거래 계약 사업 주식 증권 "
    "자산 채무 채권 손해 위험 통제 제도 정책 보호 관리 운영 교육 평가 검증 결제 감리 기록 명령 결정 의결 통지 통보 "
    "징역 벌금형 사실 서면 의견 결과 의결권 요구 인가 요청 사항 이익 재산 비용 장부 조건 인력 명칭 금전 비밀 등기 설비 "
    "상호 회의 자금 자본금 기금 보증금 포상금 보상금 구조금 번호 상태표 금품 성명 보수 감봉 시정 "
    "신탁 견책 민원 면직 신용 주소 청약 담보 어음 한도 합병 권고 이의 재심의 체계 확인 기한 모집 변경 열람 직무 "
    "증표 세부사항 방지체계 상품 출석 해산 사무 보완 지급 부동산 사채 체결 계획 투자업 홈페이지 정직 수익권 "
    "시기 시험 결의 가격 매매 심의 제공 서 금"
).split()
CONCEPT_SPACED_END = "세부 사항"
ACTIVITIES = ["투자", "출자", "융자"]


def _ends(words: list[str]) -> str:
    return "(?:" + "|".join(words) + r")\z"


def surface_type(name: Column) -> Column:
    """Type of one surface by its end, null where no rule holds."""
    flat = F.regexp_replace(F.regexp_replace(name, r"(?U)\s+", " "), r"""\A[ ,.;:()\[\]{}"']+|[ ,.;:()\[\]{}"']+\z""", "")
    base = F.regexp_replace(F.regexp_replace(flat, r"(?U)\s*등\z", ""), r"(?U)\A\s+|\s+\z", "")
    return (
        F.when(flat == "", None)
        .when(base.isin(ACTIVITIES), "CONCEPT")
        .when(base.rlike(_ends(LEGAL_ENDS)), "LEGAL_INSTRUMENT")
        .when(base.rlike(_ends(ORGANIZATION_ENDS)), "ORGANIZATION")
        .when(base.rlike(r"(?U)의\s*장\z") | base.rlike(_ends(PERSON_ENDS)), "PERSON")
        .when(base.rlike(_ends([*CONCEPT_ENDS, CONCEPT_SPACED_END])), "CONCEPT")
    )


def entity_type(canonical: Column, aliases: Column) -> Column:
    """STRUCT<entity_type, method>: the canonical name's type, else the first alias's with one, else OTHER.

    ``aliases``: ARRAY<STRING> in order; null and blank aliases are passed over."""
    own = surface_type(canonical)
    by_alias = F.get(F.filter(F.transform(F.coalesce(aliases, F.array().cast("array<string>")), surface_type), lambda t: t.isNotNull()), F.lit(0))
    return F.struct(
        F.coalesce(own, by_alias, F.lit("OTHER")).alias("entity_type"),
        F.when(own.isNotNull(), "canonical_rule").when(by_alias.isNotNull(), "alias_rule").otherwise("fallback_other").alias("method"),
    )


#: White space in DuckDB's patterns, as (?U)\s has it here.
_SPACE_SQL = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def surface_type_sql(name: str) -> str:
    """``surface_type`` in DuckDB's SQL."""
    sp = _SPACE_SQL
    flat = f"trim(regexp_replace({name}, '{sp}+', ' ', 'g'), ' ,.;:()[]{{}}\"''')"
    base = f"regexp_replace(regexp_replace({flat}, '{sp}*등$', ''), '^{sp}+|{sp}+$', '', 'g')"
    return (
        f"CASE WHEN {flat} = '' THEN NULL WHEN {base} IN ({', '.join(repr(a) for a in ACTIVITIES)}) THEN 'CONCEPT' "
        f"WHEN regexp_matches({base}, '(?:{'|'.join(LEGAL_ENDS)})$') THEN 'LEGAL_INSTRUMENT' "
        f"WHEN regexp_matches({base}, '(?:{'|'.join(ORGANIZATION_ENDS)})$') THEN 'ORGANIZATION' "
        f"WHEN regexp_matches({base}, '의{sp}*장$') OR regexp_matches({base}, '(?:{'|'.join(PERSON_ENDS)})$') THEN 'PERSON' "
        f"WHEN regexp_matches({base}, '(?:{'|'.join([*CONCEPT_ENDS, CONCEPT_SPACED_END])})$') THEN 'CONCEPT' END"
    )


# Predicates whose family is set by rule, with the family's positive name, in order.
DIRECTION_RULES = [
    (r"\A.+등기(?:하다|하지않다)\z", "등록하다"),
    (r"\A(?:지정해제|철회|취소|해제)(?:하다|하지않다)\z", "취소하다"),
    (r"\A(?:해임|해지|폐지|삭제|상실|소멸|종료)(?:하다|하지않다)\z", "종료하다"),
    (r"\A반려(?:하다|하지않다)\z", "반환하다"),
    (r"\A누설(?:하다|하지않다)\z", "공개하다"),
    (r"\A(?:거절|거부|배제|제외|차단|금지)(?:하다|하지않다)\z", "제한하다"),
    (r"\A(?:선임|임명|위촉)(?:하다|하지않다)\z", "임명하다"),
]


def guard_direction(mapping: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Sets the family of predicates a direction rule names, where the taxonomy has it and it differs.

    mapping: source_canonical_name, source_polarity, target_family_id, target_canonical_name, mapping_status and
    any others; taxonomy: family_id, positive_name, negative_name (a small table by nature)."""
    wanted = F.lit(None).cast("string")
    for pattern, positive in reversed(DIRECTION_RULES):
        wanted = F.when(F.col("source_canonical_name").rlike(pattern), positive).otherwise(wanted)
    families = taxonomy.select(
        F.col("positive_name").alias("_wanted"), F.col("family_id").alias("_family"),
        F.col("positive_name").alias("_pos"), F.col("negative_name").alias("_neg"),
    )
    j = mapping.withColumn("_wanted", wanted).join(families, "_wanted", "left")
    change = F.col("_family").isNotNull() & ~F.col("target_family_id").eqNullSafe(F.col("_family"))
    target = F.when(F.col("source_polarity") == "POSITIVE", F.col("_pos")).otherwise(F.col("_neg"))
    return (
        j.withColumn("target_canonical_name", F.when(change, target).otherwise(F.col("target_canonical_name")))
        .withColumn("mapping_status", F.when(change, "rule_semantic_direction_guard").otherwise(F.col("mapping_status")))
        .withColumn("target_family_id", F.when(change, F.col("_family")).otherwise(F.col("target_family_id")))
        .drop("_wanted", "_family", "_pos", "_neg")
    )
