from collections import Counter

import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from tesserae.llm import markup as m

CASES = [
    ("== A ==\nText.\n\n=== B (1)===", {"heading": 2}), ("# Eins\n\nText.\n\n## Zwei ##", {"heading": 2}), ("Lage\n----\n\nText.\n\nMehr\n====", {"heading": 2}),
    ("<h2>A</h2>\n<H3 id='x'><span>B</span></H3>", {"heading": 2}), ("\\section{A}\n\\subsubsection*{B}", {"heading": 2}),
    ("* a\n** b\n*Ein Satz.", {"list_item": 3}), ("# Ein Satz steht hier.\n#Noch einer.\n## Und einer.", {"list_item": 3}), ("- a\n  + b\n\n1. Eins\n2. Zwei", {"list_item": 4}),
    ("<ul>\n<li>a\n<li>b</li></ul>", {"list_item": 2}), ("\\begin{itemize}\n\\item a\n\\item b\n\\end{itemize}", {"list_item": 2}),
    ("<pre>\n* x\n== y ==\n</pre>", {"code_block": 1}), ("```\n# a\n- b\n```\nText", {"code_block": 1}), ("~~~text\nx\n~~~", {"code_block": 1}), ("Text.\n\n    # a\n    - b\n\nText.", {"code_block": 1}),
    ("\\begin{lstlisting}[language=C]\n\\item\n\\end{lstlisting}", {"code_block": 1}), ('<source lang="c">\n$x = $y\n</source>', {"code_block": 1}), ("<pre><code>a</code></pre>", {"code_block": 1}),
    (":<math>a</math> und $x_1 < y$ und \\(z\\)", {"formula": 3}), ("$$\na^2\n$$\n\\[ b \\]\n\\begin{equation}\nc\\label{e}\n\\end{equation}", {"formula": 3}),
    ("<!-- == a == * b -->Text", {}), ("<script>var q = '<li>';</script>", {}), ("<nowiki>== a ==</nowiki>", {}), ("In `- $x$` steht", {}), ("Text. % \\section{offen}\nText", {}), ("&lt;li&gt;", {}),
    ("Der&nbsp;Erlös", {}), ("am<br />13.", {}), ("[[zählt]]", {}), ("''y''", {}), ("\\textit{x}", {}), ("**x** y", {}), ("[a](https://x.y)", {}), ("{\\it x}", {}), ("__NOTOC__", {}), ("a\n\n***\n\nb", {}), ("> Zitat", {}),
]
PLAIN = [
    "Im Versuch galt stets 3 < 5 und a\n* b = 12.", "Der Preis lag zwischen $5 und $12 je Stück, dann $7.", "Der Ordner C:\\texte\\neu enthielt {1, 2} als A_1.", "Auf der Tafel stand\n#7, dahinter [sic].",
    "Er (* 14. März 1861 in X) war bei\n2001. Danach nicht.", "Wola & Fire – 57,6 %. Nach § 3.", "a = b - c", "Das kam von ihm\n- und von ihr.", "", "L’art. 5 ~ 6 | 7",
]


@pytest.mark.parametrize("text, want", CASES)
def test_elements(text, want):
    found, marked, _, _ = m.parse(text)
    assert marked and Counter(k for k, _ in found) == Counter(want)


@pytest.mark.parametrize("text", PLAIN)
def test_plain_prose_is_no_markup(text):
    found, marked, _, _ = m.parse(text)
    assert not found and not marked
    assert m.clean(text)[2] == text.strip()


def test_clean_text_keeps_structure():
    text = "== Lage ==\nDer '''Ort''' [[Berg|am Berg]] hat {{Höhe|{{#expr:2+3}}|m}} viel.<ref>{{Q}}</ref>\n* ein <b>Punkt</b>\n<pre>\nx &lt; 3\n</pre>\n<math>E = m</math>\n{| class=x\n|-\n| a\n|}\n"
    body = m.clean(text)[2]
    assert body.split("\n") == ["# Lage", "Der Ort am Berg hat viel.", "- ein Punkt", "", "```", "x < 3", "```", "", "$E = m$"]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab.=*#-<>/$\\[]{}`&;\n 1lipre", max_size=60))
def test_any_text_is_read(text):
    found, marked, shown, held = m.parse(text)
    assert marked or not found
    m.clean(text)


def test_tables(spark):
    text = spark.createDataFrame([(1, "A", "== x ==\n* y", 5), (1, "A", "== x ==\n* y", 6), (2, "B", None, 5), (3, "C", " ", 5), (4, "D", "<b>x</b>", 5), (5, "E", "* a", 5), (None, "F", "* a", 5)], "page_id long, title string, text string, unit_seq int")
    got = {tuple(r) for r in m.markup_elements(text).collect()}
    assert got == {(4, "any", 0), (1, "any", 0), (1, "heading", 1), (1, "list_item", 1), (5, "any", 0), (5, "list_item", 1), (None, "any", 0), (None, "list_item", 1)}
    assert m.markup_elements(text.limit(0)).collect() == []
    rows = {r["page_id"]: r for r in m.cleaned_texts(text).collect()}
    assert rows[2]["clean_text"] == "" and rows[1]["clean_text"] == "# x\n- y" and m.cleaned_texts(text).count() == 6


def test_elements_come_from_the_distribution(monkeypatch):
    seen, kept = [], m.kept
    monkeypatch.setattr(m, "kept", lambda text: seen.append(text) or kept(text))
    texts = [t for t, _ in CASES] + PLAIN
    rows = next(m._elements(iter([pd.DataFrame({"page_id": range(len(texts)), "text": texts})])))
    assert seen == texts
    for i, (_, want) in enumerate(CASES):
        assert Counter(rows[rows["page_id"] == i]["unit_kind"]) == Counter(want) + Counter(["any"])


PROSE = "The survey of the old harbour was finished in the autumn of 1903, when the last of the warehouses had been measured."
NAVIGATION = ["Home", "About us", "Log in", "Contact", "Sitemap"]


@pytest.mark.parametrize("join", ["\n", "\n\n"])
@pytest.mark.parametrize("prose", [PROSE, "旧港的调查于一九〇三年秋天结束，当时最后一批仓库已经测量完毕，码头也已经修好。"])
def test_boilerplate_goes_and_prose_stays(join, prose):
    text = join.join(NAVIGATION) + "\n\n== History ==\n" + "\n".join([prose] * 4) + "\nIt was sold.\n\n" + prose + "\n\nShort one.\n\n" + prose + "\n\n" + join.join(["Imprint", "Privacy", "Top"]) + "\n\n* " + "item"
    found, marked, body = m.clean(text)
    assert [k for k, _ in found] == ["heading", "list_item"] and marked
    for gone in (*NAVIGATION, "Imprint", "Privacy", "Top"):
        assert gone not in body.split("\n"), gone
    for stays in ("# History", prose, "It was sold.", "Short one.", "- item"):
        assert stays in body.split("\n"), stays
    assert body.split("\n").count(prose) == 6


def test_even_texts_are_kept_whole():
    for text in ("Eins\nZwei\nDrei", "Ein Satz.\n\nNoch ein Satz steht hier.", "x"):
        assert m.clean(text)[2] == text


def test_elements_within_templates_and_tables_count():
    found, _, body = m.clean("{{Box|\n* Eins\n* Zwei\n}}\n{| class=x\n|-\n|\n* Drei\n|}\nEin Satz.")
    assert [k for k, _ in found] == ["list_item"] * 3 and body.endswith("Ein Satz.")


@pytest.mark.parametrize("unit", ["\\[ ", "\\( ", "<code> ", "<tt> ", "<pre ", "\\verb|", "`", "$$ ", "$x ", "{{", "[[", "<!"])
def test_unclosed_openings_take_time_in_proportion(unit):
    import time

    m.clean(unit * 10)
    spent = []
    for n in (1_000, 4_000):
        text = "\n".join(["Ein Wort " + unit] * n)
        began = time.perf_counter()
        m.clean(text)
        spent.append(time.perf_counter() - began)
    assert spent[1] < 9 * spent[0] + 0.5, spent
