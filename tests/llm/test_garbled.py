import random

import pyarrow as pa
import pytest

from tesserae.llm import garbled as m

WORDS = "Die Fläche beträgt dort über größere Höfe während Straßen für Gärten öffentlichen Türme später zurück".split()
RUS = "Общество основано и содержало новые мосты Кто построил старые здания Позже переехал больше не возвращался".split()


def sentence(rng, words):
    return " ".join(rng.choice(words) for _ in range(8)) + "."


def corpus(rng, n=400):
    rows = []
    for i in range(n):
        words = RUS if i % 4 == 0 else WORDS
        rows.append((i, " ".join(sentence(rng, words) for _ in range(3)), "x"))
    return rows


def test_codecs():
    assert m.misread("Fläche", "utf-8", "cp1252*") == "FlÃ¤che"
    assert m.undo_utf8("FlÃ¤che “x”", "cp1252*") == "Fläche “x”"
    assert m.undo_utf8("SÃO", "cp1252*") is None and m.undo_utf8("é", "cp1252*") is None
    assert m.undo_utf8("Зачем", "cp866") is None
    assert m.to_bytes("Ïîçæå", "cp1252*").decode("cp1251") == "Позже"


@pytest.mark.parametrize("chain", [("utf-8", "cp1252*"), ("utf-8", "mac-roman"), ("utf-8", "cp437"), ("utf-8", "iso8859-15"), ("cp1251", "koi8-r"), ("koi8-r", "cp1251*"), ("utf-8", "cp1251*")])
def test_round_trip(chain):
    text = "Позже переехал" if chain[0] != "utf-8" or chain[1].startswith("cp1251") else "Über größere Höfe"
    odd = m.misread(text, *chain)
    back = m.undo_utf8(odd, chain[1]) if chain[0] == "utf-8" and chain[1] not in m.LETTERS else m.to_bytes(odd, chain[1]).decode(chain[0])
    assert back == text


def test_alignment():
    assert m._aligned("Fläche 12 größer", "FlÃ¤che 345 grÃ¶ÃŸer") == [("ä", "Ã¤"), ("öß", "Ã¶ÃŸ")]
    assert m._aligned("ä", "\ufffd") == []


def test_finds_and_restores(spark):
    rng = random.Random(3)
    rows = corpus(rng)
    clean = {i: t for i, t, _ in rows}
    bad = {}
    for i in range(0, 400, 20):
        text = clean[i + 1]
        bad[i + 1] = m.misread(text, "utf-8", "cp1252*") if i % 40 else text.replace("Fläche", "FlÃ¤che").replace("Höfe", "HÃ¶fe")
    for i in range(0, 400, 80):
        bad[i] = m.misread(clean[i], "cp1251", "cp1252*")
    bad = {i: t for i, t in bad.items() if t != clean[i]}
    rows = [(i, bad.get(i, t), x) for i, t, x in rows] + [(900, "Das Wort \ufffdber fehlt.", "x"), (901, None, "x"), (902, "", "x"), (903, "plain", "x"), (904, "A FREGUESIA DE SÃO JOÃO", "x"), (905, clean[1] * 300, "x")]
    rows += [(1000 + i, clean[i], "x") for i in bad]  # the clean twins
    df = spark.createDataFrame(rows, "doc_id long, text string, restored string")
    got = {r["doc_id"]: r for r in m.restore(df).collect()}
    assert set(got) == set(bad) | {900}
    assert not got[900]["restorable"]
    assert all(got[i]["restored"] == clean[i] for i in bad if ("cp1251" not in got[i]["chain"]))
    assert {(w, r) for w, r, _ in m.learned_mappings(m.scanned(df))} >= {("utf-8", "cp1252*")}


def test_empty(spark):
    assert m.restore(spark.createDataFrame([], "doc_id long, text string")).collect() == []


LOSSES = {
    "gb18030": "湖北大学成立于1815年十二月，负责管理塔楼、花园等。东梅点雨于1928年出生，研究木造的市场。古老的桥位于寺石以北67.3公里处，人口9167人。",
    "cp932": "バットは1644年9月に設立された。ババスチバは1739年に生まれ、小さな絵画を研究した。「水車を守ろう。」と新しい学校は述べた。",
    "cp1251": "Исторія города. Иван и Ирина построили старые здания. Их не было.",
}


@pytest.mark.parametrize("read", LOSSES)
def test_beside_lost_characters(spark, read):
    text = LOSSES[read]
    odd = text.encode().decode(read, "replace")
    assert odd.count("\ufffd") >= 3
    mixed = text[:9] + " " + odd
    # twins of this text and of another one teach the mapping
    other = text[::-1] + "1234567890"
    rows = [(1000 + i, text[i % 7 :]) for i in range(300)] + [(100, odd), (101, mixed), (102, text[:20] + "\ufffd" + text[21:])]
    rows += [(200 + i, t) for i, t in enumerate((other, other, text + "。1234567890。", text + "。1234567890。"))] + [(300 + i, t.encode().decode(read, "replace")) for i, t in enumerate((other, text + "。1234567890。"))]
    got = {r["doc_id"]: r for r in m.restore(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got) == {100, 101, 102, 300, 301}
    back = got[100]["restored"]
    assert f"utf-8 read as {read}" in got[100]["chain"] and not got[100]["restorable"]
    assert back.count("\ufffd") == odd.count("\ufffd") and got[100]["n_lost"] == odd.count("\ufffd")
    at = 0
    for part in back.split("\ufffd"):  # what stands between losses is the text's, in its order
        assert part in text[at:]
        at = text.index(part, at) + len(part)
    # all but the characters that lost a byte, and their neighbours where two stood side by side
    assert len(back.replace("\ufffd", "")) >= len(text) - 2 * odd.count("\ufffd")
    assert got[101]["restored"] == text[:9] + " " + back
    assert got[102]["restored"] == text[:20] + "\ufffd" + text[21:]


def test_stray_bytes():
    assert m.undo_beside_lost("繧ｬ繧ｰ繝", "cp932", False, True) == [(0, 5, "ガグ")]
    assert m.undo_beside_lost("繝", "cp932", True, True) == [(0, 1, "")] and m.undo_beside_lost("繝", "cp932", True, False) == []
    assert m.undo_beside_lost("学校。繧ｬ繧ｰ繝", "cp932", False, True) == [(3, 8, "ガグ")]


KOR = "서울특별시는 대한민국의 수도이며 오래된 건물과 새로운 다리가 있는 아름다운 도시이다 학교에서 도서관으로 옮겼다".split()
JPN = "東京都は日本の首都である 新しい学校が建てられた 古い橋を研究した 有名な小川は美しい 図書館へ移った".split()
ENG = "The museum keeps letters from harbour workers about bridges schools gardens towers maps".split()


@pytest.mark.parametrize("written, read, words", [("euc-kr", "cp437", KOR), ("euc-kr", "koi8-r", KOR), ("euc-kr", "gb18030", KOR), ("euc-jp", "cp1251*", JPN), ("euc-jp", "gb18030", JPN)])
def test_learned_east_asian_mappings(spark, written, read, words):
    rng = random.Random(5)
    long = [w for w in words if len(w) >= 5]
    sentences = [f"{' '.join(rng.sample(ENG, 5))} {rng.choice(long)} {rng.choice(ENG)} {rng.choice(words)} {i}." for i in range(900)]
    bad = {i: m.misread(sentences[i], written, read) for i in range(0, 900, 60)}
    assert all(m.LOST not in t for t in bad.values())
    rows = [(i, t) for i, t in enumerate(sentences)] + [(5000 + i, sentences[i]) for i in bad] + [(1000 + i, t) for i, t in bad.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert (written, read) in {(w, r) for w, r, _ in m.learned_mappings(m.scanned(df))}
    got = {r["doc_id"]: r["restored"] for r in m.restore(df).collect()}
    whole = sum(got.get(1000 + i) == sentences[i] for i in bad)
    assert set(got) <= {1000 + i for i in bad} and whole >= 0.9 * len(bad)


def test_long_clauses_teach(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(JPN) for _ in range(60)) + "。" for _ in range(4)]
    assert all(len(t) > 400 for t in texts)
    rows = [(i, texts[i % 4]) for i in range(12)] + [(100 + i, m.misread(t, "utf-8", "cp437")) for i, t in enumerate(texts)]
    rows = [(i, f"Museum and harbour {t}") for i, t in rows]
    clauses = {c for part in m._scan(iter([pa.RecordBatch.from_pydict({"text": [t for _, t in rows]})])) for c in part.column("clause").to_pylist() if c}
    assert clauses == {t for _, t in rows}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [(w, r) for w, r, _ in m.learned_mappings(m.scanned(df))] == [("utf-8", "cp437")]


def test_nothing_learned_nothing_found(spark):
    rng = random.Random(3)
    clean = [t for _, t, _ in corpus(rng)]
    odd = [m.misread(t, "utf-8", "cp1252*") for t in clean[1:200:4]] + [m.misread(t, "cp1251", "cp1252*") for t in clean[0:200:4]]
    # without twins nothing is learned, and what is garbled all the same stays unfound; losses are a kind of their own
    rows = list(enumerate(clean[200:] + odd)) + [(900, "Das Wort \ufffdber fehlt.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    scan = m.scanned(df)
    undo = m.Undo(m.character_model(scan), set())
    import pandas as pd

    got = pd.concat(undo(iter([pd.DataFrame(rows, columns=["doc_id", "text"])])))
    assert got[["doc_id", "chain"]].values.tolist() == [[900, "lost characters"]]
    taught = spark.createDataFrame(rows + [(1000 + i, t) for i, t in enumerate(clean[1:200:4])], "doc_id long, text string")
    assert {r["doc_id"] for r in m.restore(taught).collect()} >= {200 + i for i, t in enumerate(odd[:50]) if not t.isascii()}


def test_twins_by_digits_and_byte_lengths():
    text = "湖北大学成立于1815年十二月，人口9167人。"
    assert set(m._keys(text)) & set(m._keys(m.misread(text, "utf-8", "gb18030")))
    text = "北京市有许多古老的建筑"
    assert set(m._keys(text)) & set(m._keys(m.misread(text, "gb18030", "latin-1")))
    assert m._aligned("x年", "x\ufffd") == []


def test_words_met_are_kept_within_a_slice():
    import pandas as pd

    text = LOSSES["gb18030"]
    odd = text.encode().decode("gb18030", "replace")
    counts = pd.concat(p.to_pandas() for p in m._scan(iter([pa.RecordBatch.from_pydict({"text": [text[i % 7 :] for i in range(300)]})]))).dropna(subset=["slot"]).astype({"slot": int})
    model = m.Model(counts["slot"].to_numpy(), counts["n"].to_numpy())
    rows = pd.DataFrame([(1, odd), (2, "Livres c\u00e9l\u00e8bres"), (3, odd), (4, "Die Fl\u00e4che \ufffd")], columns=["doc_id", "text"])
    fresh, full = (m.Undo(model, {("utf-8", "gb18030")}) for _ in range(2))
    want = pd.concat(fresh(iter([rows])))
    assert want["doc_id"].tolist() == [1, 3, 4] and "gb18030" in want["chain"].iloc[0]
    full.known = dict.fromkeys(map(str, range(100_000)))  # this slice's words go past the bound
    pd.testing.assert_frame_equal(pd.concat(full(iter([rows]))), want)
    assert len(full.known) > 100_000
    pd.testing.assert_frame_equal(pd.concat(full(iter([rows]))), want)
    assert len(full.known) < 1000  # and the next slice forgets
