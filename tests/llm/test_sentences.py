import pytest

from tesserae.llm import sentences as m

# Each text with the beginnings of its units marked by |.
TEXTS = [
    ("de", "|Zu den Aufgaben gehörten u. a. die Züge. |Prof. A. B. Pakali leitete bis 1963 die Abteilung Nr. 3. |Das Buch „Wohin?“ erschien 1931."),
    ("de", "|Am 1. April 1824 und im 13. Jahrhundert kamen Höfe usw. hinzu. |Der Bestand umfasst Höfe u. Ä. |Später zog er nach X … und kehrte nie zurück."),
    ("de", "|„Wir behalten\ndie Lieder!“, sagte sie. |3 < 5 galt.\n \n|Ein Titel\n\n|Ende"),
    ("en", "|Mr. G. H. Dab led the office on St. X Street until 8 p.m. on a Sunday. |The owner is Savibal Jr. |It cost £163. |53 visitors came, i.e. only few remained... |See fig. 6 and vol. 12, pp. 14–140."),
    ("en", "|“Why so many?” appeared in 1910. |The club “Hello X!” received 4.5 marks. |See www.a.example or C:\\x.y today."),
    ("fr", "|« Nous garderons les orgues ! » déclara M. Vo en 1846. |L’art. 8 et le n° 3 restaient, c.-à-d. les cloches… |Mme B. vint."),
    ("es", "|¡Los registros ardieron! |¿Quién vino? |El Sr. Loho dirigió (véase pág. 2). |El folleto «¿Por qué?» apareció."),
    ("ru", "|Доти родился в г. Билого и описал песни и т. д. |Общество основано 13 марта 1853 г. и содержало мосты. |«Мы сохраним мосты!» — сказал проф. Е. В. Негапа."),
    ("el", "|Ο κ. Σεμα έγραψε για πίνακες, δάση κ.λπ. |Ποιος έχτισε τα κτίρια; |Η Νιξακα είναι οικισμός."),
    ("ja", "|古い歌は誰が建てたのか？|「庭園を守ろう。」とオヘは述べた。|その後、クロテへ移った……戻ることはなかった。"),
    ("zh", "|“我们要保留塔楼！”風林宮在1726年这样说。|人口123.4人。|谁建造的？"),
    ("hi", "|डॉ. तारा ने लिखा। |क्या पुल थे? |हिस्सा 22.3 प्रतिशत बढ़ा।"),
    ("ar", "|كتب د. نجم عن الجسور. |هل كانت الخرائط؟ |ارتفعت النسبة بمقدار 60.1 في المئة!"),
    ("th", "|ในปี 1911 ชาวเมืองได้สร้างสวน |ระยะทางประมาณ 40.6 กิโลเมตร"),
    ("it", "|Il sig. Rossi e la dott.ssa Bini vivono a pag. 3. |Nel 44 a.C. morì Cesare. |Comprò mele, pere ecc. |Poi partì."),
    ("pt", "|O Sr. Silva e a Dra. Lima viram a pág. 4. |Vieram no séc. XV. |Havia pontes, torres etc. |Depois partiu."),
    ("pl", "|Prof. dr hab. Nowak mieszka przy ul. Długiej. |Zmarł w 1990 r. |Potem był m.in. Jan itd. |Koniec."),
    ("nl", "|Dhr. Jansen en mevr. Smit zagen o.a. Kees. |Er waren bruggen, torens enz. |Daarna kwam drs. Bos."),
    ("ko", "|학교는 1990. 3. 5. 문을 열었다. |학생이 많았다! |Dr. 김은 떠났다."),
    ("my", "|ကျောင်းသည်ကြီးသည်။ |မြို့သည်ဟောင်းသည်။|သူသွားသည်။"),
    ("km", "|សាលាធំ។ |ទីក្រុងចាស់។ |គាត់ទៅ។"),
    ("bo", "|སློབ་གྲྭ་ཆེན་པོ་ཡིན། |གྲོང་ཁྱེར་རྙིང་པ་ཡིན། |ཁོ་ཕྱིན་སོང་།"),
    ("am", "|ትምህርት ቤቱ ትልቅ ነው። |ማን ሄደ፧ |እሱ ሄደ።"),
    ("hy", "|Դպրոցը մեծ է։ |Քաղաքը հին է։ |Նա գնաց։"),
]


@pytest.mark.parametrize("lang, marked", TEXTS)
@pytest.mark.parametrize("known", [True, False])
def test_units(lang, marked, known):
    want, at = [], 0
    for part in marked.split("|")[1:]:
        want.append(at)
        at += len(part)
    assert m.boundaries(marked.replace("|", ""), lang if known else None) == want


def test_leading_blanks_titles_and_empties():
    assert m.boundaries("  \n Ab. Cd.", "de") == [4, 8]
    assert m.boundaries("", "de") == m.boundaries(" \n\n ", None) == []
    assert m.boundaries("Mein Titel\nein Satz geht. Weiter.", "de", "Mein_Titel") == [0, 11, 26]
    assert m.boundaries("x", None) == [0]


@pytest.mark.parametrize("tokens, want", [
    (["La", "lettre", "(", "cf.", "p.", "13", ")", ".", "_", "Le", "site", "www", ".", "a", ".", "example", "."], [0, 9]),
    (["z", ".", "B", ".", "in", "X", ".", "„", "Wir", "!", "“", ",", "sagte", "er", "."], [0, 7]),
    (["新し", "い学", "校は", "誰が", "か", "？", "「", "歌を", "守ろう", "。", "」", "と", "X", "。"], [0, 6]),
    (["เมือง", "นี้", "_", "12", "_", "คน", "_", "ในปี", "_", "19", "_", "ชาว"], [0, 7]),
    (["_", "A", "."], [1]), ([], []), (["_"], [0]),
])
def test_token_units(tokens, want):
    assert m.token_units(tokens) == want if tokens != ["_"] else m.token_units(tokens) in ([], [0])


def test_long_text_is_cut_whole():
    assert len(m.boundaries("Ein Satz. " * 50_000, "de")) == 50_000


def test_tables(spark):
    page = spark.createDataFrame([(1, "de", "text", "x"), (1, "de", "text", "y"), (2, None, "wikitext", "x"), (3, "xx", "text", "x")], "page_id long, page_lang string, page_content_model string, src string")
    text = spark.createDataFrame([(0, 1, "T", "A b. C d."), (1, 1, "T", "A b. C d."), (0, 2, "T", "Ab. Bc."), (0, 3, "T", None), (0, 3, "T", " "), (0, 9, "T", "A."), (0, None, "T", "A.")], "id long, page_id long, title string, text string")
    tagged = spark.createDataFrame([(1, '[["Ab", "."], ["B"]]', 1), (1, '[["Ab", "."], ["B"]]', 2), (5, '[["x"]]', 1), (6, "kaputt", 1), (7, None, 1), (8, "[]", 1)], "page_id long, text string, unit_start int")
    got = {(r["src"], r["page_id"], r["unit_start"], r["unit_end"]) for r in m.sentence_units(text, tagged, page).collect()}
    assert got == {("text", 1, 0, 5), ("text", 1, 5, 9), ("tagged", 1, 0, 2), ("tagged", 1, 2, 3), ("tagged", 5, 0, 1)}
    assert m.sentence_units(text.limit(0), tagged.limit(0), page.limit(0)).collect() == []
    assert m.text_units(text, page, plain_only=False).where("page_id = 2").count() == 2


@pytest.mark.parametrize("lang, text, want", [
    ("en", "I drank some c. Then more.", [0, 16]), ("fr", "Il cite c. Puis il part.", [0]), ("en", "It was o. Then u. Then z. Then d.", [0, 10, 18, 26]), ("de", "Höfe o. Ä. gab es u. a. dort.", [0]),
    (None, "Il cite c. Puis il part.", [0]), ("ru", "Группа пришла. Mr. Dab came.", [0, 15]), ("en", "Prof. A. D. Dab led it. In 40 A.D. Then it fell.", [0, 24, 35]),
])
def test_only_the_pages_language_is_asked(lang, text, want):
    assert m.boundaries(text, lang) == want


def test_decisions_do_not_hang_on_lengths():
    blanks = " " * 300
    assert m.boundaries(f"Er kam z.{blanks}B.{blanks}Heute. Dann ging er.", "de") == [0, 618]
    for n in (10, 1000):
        name = "X" + "a" * n
        assert m.boundaries(f"Ποιος έχτισε {name}; Η πόλη.", "el") == [0, 15 + len(name)]
        assert m.boundaries("ชาวเมืองได้สร้าง " + name + " สวน", "th") == [0]
        assert m.boundaries("「庭園を守ろう。」" + "x" * n + "と述べた。次。", "ja") == [0, 14 + n]
    assert m.boundaries("1" + " " * 200 + "B. Ab. Cd.", "de")[0] == 0


def test_many_places_that_do_not_break_take_time_in_proportion():
    import time

    spent = []
    for n in (5_000, 20_000):
        text = "Er kam vgl. " * n
        began = time.perf_counter()
        assert m.boundaries(text, "de") == [0]
        spent.append(time.perf_counter() - began)
    assert spent[1] < 8 * spent[0] + 0.5
