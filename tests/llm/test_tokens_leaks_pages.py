import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkloom.llm.leaks import RUN, ItemIndex, find_leaks, letters
from sparkloom.llm.stuffing import fit, label_page, sample_pages, stuffed_pages, stuffed_share
from sparkloom.llm.tokenize import PATTERN, VOCABULARY, Encoder, PerfectHash, encode, read_ranks

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def table():
    return PerfectHash(read_ranks(VOCABULARY))


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(VOCABULARY), special_tokens={})


def ids(enc, text):
    return np.frombuffer(enc.encode(text), dtype=np.int32).tolist()


def test_perfect_hash_is_minimal_and_exact(table):
    ranks = read_ranks(VOCABULARY)
    assert table.n == len(ranks) and all(k is not None for k in table.keys)
    assert all(table.get(k) == v for k, v in ranks.items())
    rng = random.Random(1)
    strange = {bytes(rng.randrange(256) for _ in range(rng.randrange(12))) for _ in range(3000)} - set(ranks)
    assert all(table.get(k) is None for k in strange)
    assert PerfectHash({}).get(b"a") is None


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_encoding_equals_the_library(table, reference, text):
    text = text.encode("utf-8", "ignore").decode()
    assert ids(Encoder(table), text) == reference.encode_ordinary(text)


def test_hard_texts(table, reference):
    enc = Encoder(table)
    for text in ["가" * 5000, "a" * 3000, "   \n\n \t x", "<|endoftext|> it's 123", "각각 🧾‍ ", " " * 500, "'ll've'S"]:
        assert ids(enc, text) == reference.encode_ordinary(text)


def test_encode(spark, reference):
    rows = [(1, "가나 abc", [9]), (2, "", None), (3, None, None), (4, "  ", None), (4, "  ", None)]
    got = sorted((r.doc_id, r.ids) for r in encode(spark.createDataFrame(rows, "doc_id long, text string, ids array<int>"), "doc_id", "text").collect())
    assert got == [(1, reference.encode_ordinary("가나 abc")), (2, []), (3, []), (4, reference.encode_ordinary("  ")), (4, reference.encode_ordinary("  "))]
    assert encode(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text").count() == 0


def shares_run(a, b):
    a, b = letters(a), letters(b)
    runs = {a[i : i + RUN] for i in range(len(a) - RUN + 1)}
    return any(b[i : i + RUN] in runs for i in range(len(b) - RUN + 1))


def random_text(rng, n, alphabet="가나다라마바사아자차카타파하abcdefgh0123"):
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_leaks_against_brute_force():
    rng = random.Random(6)
    opening = random_text(rng, 70)  # worded alike in many items
    items = [(i, (opening if i % 3 == 0 else "") + random_text(rng, rng.randrange(20, 300))) for i in range(90)]
    items.append((90, "가" * 200))  # one term again and again
    docs = []
    for _ in range(400):
        t = random_text(rng, rng.randrange(500))
        k = rng.randrange(50, 75)
        src = rng.choice(items)[1]
        at = rng.randrange(max(1, len(src) - k))
        cut = " ".join(src[at : at + k]).upper() if rng.random() < 0.5 else src[at : at + k]
        docs.append(t[:100] + cut + t[100:])
    docs += ["", "가" * 59, "가" * 60, opening, opening[:59] + "!" + opening[59:]]
    index = ItemIndex([(i, letters(t)) for i, t in items])
    for d, got in zip(docs, index.leaked([*docs, None])):
        assert got == [i for i, t in items if shares_run(t, d)]


def test_find_leaks(spark):
    rng = random.Random(8)
    items = [(i, random_text(rng, 120)) for i in range(6)]
    docs = [(1, items[2][1][10:75], "c"), (1, items[2][1][10:75], "c"), (2, None, "c"), (3, "", "c"), (4, "prose " * 3000 + items[5][1] + " x" * 3000 + items[0][1], "c"), (None, items[1][1], "c")]
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    it = spark.createDataFrame([*items, items[0], (None, "x"), (9, None), (10, "short")], "item_id long, text string")
    for chars in (1, 10_000):
        assert {tuple(r) for r in find_leaks(d, "doc_id", "text", it, "item_id", "text", chars).collect()} == {(1, 2), (4, 0), (4, 5)}
    assert find_leaks(d, "doc_id", "text", it.limit(0), "item_id", "text").count() == 0
    assert find_leaks(d.limit(0), "doc_id", "text", it, "item_id", "text").count() == 0


PROSE = "모든 기관은 제출된 서류를 받은 날부터 서른 날 안에 검토한 뒤 그 결과를 신청인에게 알려야 한다. "
ENGLISH = "The board may withhold the report if the applicant does not return the ledger within thirty days of the notice. "
GLOSSARY = "\n".join(f"- 용어{i}: 담당자가 자료를 확인하는 데 필요한 서식을 이르는 말이다." for i in range(12))
CONTENTS = "# 규정\n\n## 차례\n" + "\n".join(f"- 제{i}조 항목{i}" for i in range(1, 25))
ITEMS = "##### 제1조(목적)\n**①** 기관은 다음 각 호의 자료를 갖추어 두어야 한다.\n" + "\n".join(f"  {i}\\. 부서가 마련한 제{i}호 서식에 관한 사항" for i in range(1, 15))
SPAM = {
    "words": "대출 상담 대출 이자 상담 대출 금리 " * 30,
    "dressed": "서식 양식 서식 신청한다. 양식 대출 서식 조회합니다. " * 20,
    "particles": "서식은 서식을 서식 추천 " * 40,
    "links": "\n".join(f"- [자료 {i}](http://a{i}.test/x{i})" for i in range(30)),
    "sentences as links": "\n".join(f"{i}. [자료를 확인하여야 한다.](http://a{i}.test/x)" for i in range(30)),
    "tags": " ".join(f"#서식{i} #양식{i}" for i in range(40)),
    "labels": "\n".join(f"상품코드 K{i} / 태그: 서식{i},양식{i},대출{i} / http://s{i}.test/q" for i in range(30)),
    "english": " | ".join(["buy cheap ledger", "best ledger", "online ledger", "top 10 ledger"] * 20),
    "mixed": PROSE * 2 + "\n" + "대출 상담 이자 대출 상담 " * 60,
}
FINE = {
    "prose": PROSE * 8, "english": ENGLISH * 6, "glossary": GLOSSARY, "contents": CONTENTS, "items": ITEMS, "one line": "짧은 글이다.",
    "prose with links": "\n".join(PROSE + f"[원문](https://a.test/{i})" for i in range(8)) + "\n\n#서식 #양식",
    "prose with some stuffing": PROSE * 12 + "\n" + "대출 상담 이자 대출 " * 8,
}


TONGUES = {
    "es": "El consejo se reunió ayer por la tarde en la sala principal del edificio. Los vecinos presentaron sus quejas sobre el ruido de las obras. La presidenta explicó que el contrato termina en el mes de marzo. Después de la votación se aprobó el nuevo presupuesto de la ciudad. Un grupo de jóvenes pidió más espacio para las bicicletas en las calles del centro. El alcalde respondió que el plan de movilidad se publicará antes del verano. La biblioteca abrirá los sábados a partir de la próxima semana. Varios comerciantes se mostraron preocupados por el precio de la luz. El informe de los técnicos se puede consultar en la página del ayuntamiento. La reunión terminó a las nueve de la noche con un aplauso. Los niños del barrio cantaron una canción en el patio de la escuela. El arquitecto mostró los planos de la plaza con mucho detalle. En el parque se plantarán doce árboles antes de la primavera. La policía informó de que no hubo incidentes durante la fiesta. El próximo encuentro será el primer lunes de mayo.",
    "ru": "Вчера вечером совет собрался в главном зале здания. Жители пожаловались на шум от строительных работ. Председатель объяснила, что договор заканчивается в марте. После голосования был принят новый бюджет города. Группа молодых людей попросила больше места для велосипедов. Мэр ответил, что план будет опубликован до начала лета. Библиотека будет открыта по субботам со следующей недели. Некоторые торговцы обеспокоены ценой на электричество. Отчёт специалистов можно прочитать на сайте администрации. Встреча закончилась в девять часов вечера.",
    "de": "Der Rat tagte gestern Abend im großen Saal des Rathauses. Die Anwohner beschwerten sich über den Lärm der Bauarbeiten. Die Vorsitzende erklärte, dass der Vertrag im März endet. Nach der Abstimmung wurde der neue Haushalt der Stadt beschlossen. Eine Gruppe junger Leute bat um mehr Platz für Fahrräder. Der Bürgermeister antwortete, dass der Plan vor dem Sommer veröffentlicht wird. Die Bücherei ist ab der nächsten Woche auch am Samstag offen. Der Bericht der Fachleute kann auf der Seite der Verwaltung gelesen werden.",
    "zh": "委员会昨天晚上在大楼的主会议厅开会。居民们对施工噪音表示不满。主席解释说合同将于三月到期。投票之后通过了城市的新预算。一群年轻人要求为自行车提供更多空间。市长回答说该计划将在夏天之前公布。图书馆从下周起星期六也开放。一些商人对电价感到担忧。",
    "ja": "委員会は昨日の夕方、建物の大広間で開かれた。住民は工事の騒音について不満を述べた。議長は契約が三月に終わると説明した。投票の後、市の新しい予算が承認された。若者のグループは自転車のための場所を増やすよう求めた。",
    "ar": "اجتمع المجلس مساء أمس في القاعة الرئيسية للمبنى. اشتكى السكان من ضوضاء أعمال البناء. أوضحت الرئيسة أن العقد ينتهي في شهر مارس. بعد التصويت تمت الموافقة على الميزانية الجديدة للمدينة. طلبت مجموعة من الشباب مساحة أكبر للدراجات.",
    "fr": "Le conseil s'est réuni hier soir dans la grande salle de la mairie. Les habitants se sont plaints du bruit des travaux dans la rue. La présidente a expliqué que le contrat se termine au mois de mars. Après le vote, le nouveau budget de la ville a été adopté. Un groupe de jeunes a demandé plus de place pour les vélos. Le maire a répondu que le plan sera publié avant l'été. La bibliothèque sera ouverte le samedi à partir de la semaine prochaine. Le rapport des experts peut être consulté sur la page de la mairie.",
    "hi": "कल शाम भवन के मुख्य हॉल में परिषद की बैठक हुई। निवासियों ने निर्माण कार्य के शोर की शिकायत की। अध्यक्ष ने बताया कि अनुबंध मार्च में समाप्त होगा। मतदान के बाद शहर का नया बजट स्वीकृत हुआ।",
}


@pytest.fixture(scope="module")
def model(spark):
    return fit(sample_pages(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), "doc_id", "text"))


def test_pages(spark, model):
    rows = [(i, t, "c") for i, t in enumerate([*SPAM.values(), *FINE.values(), None, "", " \n ", "말" * 50_000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, stuffed string")
    got = {r.doc_id: r.stuffed for r in stuffed_pages(docs, "doc_id", "text", model).collect()}
    names = [*SPAM, *FINE, "null", "empty", "blank", "one long word"]
    assert [names[i] for i in sorted(got) if got[i]] == list(SPAM)
    assert len(got) == len(rows)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert stuffed_pages(none, "doc_id", "text").count() == 0
    assert stuffed_pages(docs.filter("text is null or text = ''"), "doc_id", "text").filter("stuffed").count() == 0


def test_the_sample_and_the_result_do_not_depend_on_the_number_of_files(spark, tmp_path):
    whole = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    whole.repartition(40, "doc_id").write.parquet(str(tmp_path / "in 40 files"))
    parts = spark.read.parquet(str(tmp_path / "in 40 files"))
    assert len(parts.inputFiles()) > 16
    for pages in (100, 2_000):
        sample = sample_pages(parts, "doc_id", "text", pages)
        assert sample and sample == sample_pages(whole, "doc_id", "text", pages)
    found = [{r.doc_id for r in stuffed_pages(d, "doc_id", "text").filter("stuffed").collect()} for d in (whole, parts)]
    assert found[0] and found[0] == found[1]


@pytest.mark.parametrize("tongue", list(TONGUES))
@pytest.mark.parametrize("between", [". ", ".\n", "\n\n"])
def test_prose_of_any_language_is_prose(model, tongue, between):
    assert sum(stuffed_share(TONGUES[tongue].replace(". ", between), model).values()) < 0.2


def test_lists_of_keywords_of_other_languages(model):
    for words in ("comprar zapatos baratos zapatos online comprar zapatos oferta ", "купить окна дешево окна цена купить окна скидка окна ", "schuhe kaufen schuhe billig schuhe online "):
        assert sum(stuffed_share(words * 20, model).values()) > 0.9


def test_prose_with_links_is_prose_though_the_sample_holds_few_such_pages():
    plain = [
        "위원회는 신청을 받은 때에는 지체 없이 그 사실을 당사자에게 통지하여야 한다.", "담당자는 보고서를 매년 작성하여 누리집에 게시한다.",
        "이 규정은 공포한 날부터 시행한다.", "기관은 정당한 이유 없이 자료를 다른 용도로 사용할 수 없다.",
    ]
    linked = "\n\n".join(f"{s} [원문](https://act{i}.test/a{i})" for i, s in enumerate(plain)) + "\n\n#서식 #양식 #자료"
    few = fit([*[PROSE * 8, *plain] * 40, *[linked] * 4, SPAM["links"]])
    assert sum(stuffed_share(linked, few).values()) < 0.2 and stuffed_share(SPAM["links"], few)["links"] > 0.9


def test_the_fit_does_not_depend_on_order_and_starts_from_nothing():
    texts = [*SPAM.values(), *FINE.values()]
    a, b = fit(texts), fit(texts[::-1])
    assert a.ends == b.ends and all(abs(x - y).max() < 1e-9 for x, y in zip([a.move, a.start, *a.emit], [b.move, b.start, *b.emit]))
    assert label_page("", fit([])) == [] and stuffed_share(SPAM["links"], fit([]))["links"] > 0.9


def test_the_path_smooths_single_lines(model):
    assert [s for s, _ in label_page("\n".join([*["[a b](http://x.test/1)"] * 5, "see also http://y.test/2 and more words", *["[a b](http://x.test/1)"] * 5]), model)] == ["links"] * 11
    assert label_page(None, model) == [] and label_page("  ", model) == []
