import unicodedata

import pyarrow as pa
from hypothesis import given, settings, strategies as st

from tesserae.llm import lookalike as m

MARKS = "".join(map(chr, (0x301, 0x302, 0x323, 0x307, 0x327)))


def form(*values):
    return m.one_form_arrow(pa.array(values, pa.string())).to_pylist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aeonc" + MARKS + "éçộ", max_size=10), min_size=1, max_size=6))
def test_composes_as_canonical_form(texts):
    assert form(*texts) == [unicodedata.normalize("NFC", t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=12)), min_size=1, max_size=8))
def test_any_text_keeps_its_row_and_is_stable(texts):
    once = form(*texts)
    assert len(once) == len(texts) and [o is None for o in once] == [t is None for t in texts]
    assert form(*once) == once
    assert [form(t)[0] for t in texts] == once


def test_alike_and_different():
    assert len(set(form("Saint_Ba", "Saint Ba", "Ｓaint_Ba", "Sаint_Bа", "Sa\u200bint\u3000Ba"))) == 1
    assert form("ｶﾞ")[0] == form("ガ")[0] == form("ガ")[0]
    assert form("Ⅳ", "ﬁ", "⽊") == ["IV", "fi", "木"]
    assert len(set(form("Cafe", "Café", "CAFE", "Cafe²", "Cafe2", "Cafe–", "Cafe-"))) == 7
    assert form("Mevarо̂")[0] == form("Mevarô")[0]


def test_percent_decoding():
    got = m._percent_decode(pa.array(["A%C3%B6", "100%zz", "%", "%C3", "%C3%28", "a%2B+b", None, "", "%E3%83%90x%"]))
    assert got.to_pylist() == ["Aö", "100%zz", "%", "%C3", "%C3%28", "a++b", None, "", "バx%"]


def test_pairs(spark):
    rows = [(1, "Ab C", "https://de/wiki/X%C3%A4", "q"), (2, "Ab_C", "https://de/wiki/Xä", "q"), (3, "Ab_C", "https://de/wiki/Xa%CC%88", "q"), (4, None, None, "q"), (5, "", "https://fr/wiki/Xa%CC%88", "q"), (6, "\u200b", "kein Link", "q"), (2, "Ab_C", None, "q")]
    df = spark.createDataFrame(rows, "ent_id long, page_title string, sitelink string, form string")
    assert {tuple(r) for r in m.alike_pairs(df).collect()} == {("page_title", 1, 2), ("page_title", 1, 3), ("sitelink", 1, 3), ("sitelink", 2, 3)}
    assert m.alike_pairs(df.limit(0)).collect() == []
    groups = {(r["field_name"], r["form"]): (r["n_writings"], r["n_rows"]) for r in m.form_groups(df).where("form = 'Ab_C'").collect()}
    assert groups == {("page_title", "Ab_C"): (2, 4)}


def test_long_values(spark):
    df = spark.createDataFrame([(1, "\u00e4" * 100_000, None), (2, "a\u0308" * 100_000, None)], "ent_id long, page_title string, sitelink string")
    assert [tuple(r) for r in m.alike_pairs(df).collect()] == [("page_title", 1, 2)]


ALIKE = "ρp ոn հh ցg ѵv үy ᎪA ᎡR ᏟC ꓮA ⲞO ᴏo аa ΑA ВB օo ɡg".split()


def test_pairs_of_letters_that_look_alike():
    for a, b in ALIKE:
        assert form(a) == form(b), (a, b)
    for a, b in ("ßβ", "AΔ", "nη", "wω", "xχ", "Ll", "O0"):
        assert form(a) != form(b), (a, b)
    from tesserae.llm import queries

    looks = {a: b for row in queries.LOOKS for a, b in zip(*row, strict=True)}
    assert looks == {a: b for a, b in m.ALIKE.items() if b != "_"}  # the SQL's own list


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(max_size=8), min_size=1, max_size=6))
def test_broken_bytes(parts):
    def valid(b):
        try:
            return bool(b.decode("utf-8")) or True
        except UnicodeDecodeError:
            return False

    import numpy as np

    raw = np.frombuffer(b"".join(parts), np.uint8)
    row = np.repeat(np.arange(len(parts)), [len(b) for b in parts])
    assert m._broken(raw, row).tolist() == [i for i, b in enumerate(parts) if not valid(b)]


def test_hot_forms(spark):
    rows = [(i, "Ab C" if i < 3_000 else "Ab_C", None) for i in range(3_003)] + [(5_000, "Xy", None), (None, "Ab\u00a0C", None)]
    df = spark.createDataFrame(rows, "ent_id long, page_title string, sitelink string")
    got = m.alike_pairs(df, share=100)
    assert got.count() == 3 * 3_000 and got.where("ent_a >= ent_b or ent_a >= 3000 or ent_b < 3000").count() == 0
