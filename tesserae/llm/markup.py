r"""P3: markup residue in articles, to clean text that keeps its structure.

HTML, Markdown, wiki and LaTeX markup may meet in one text. What is shown
literally (code, comments, scripts, formulas) is taken out first; the rest is
read line by line, and every heading, list item, code block and formula leaves
a mark on its line. Then the line-block distribution decides what is kept: the
markup is stripped, the lengths of the bare lines are summed over a sliding
window, a surge of the sums opens a block of text and a dive closes it; what
counts as one comes from the text's own distribution of sums. A line with a
mark is a surge by itself. Clean text and elements are read off the kept lines.
"""

from __future__ import annotations

import html
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex as re
from pyspark.sql import DataFrame, functions as F

KINDS = ("heading", "list_item", "code_block", "formula")

# Names of environments and tags.
CODE_ENVIRONMENTS = "lstlisting|verbatim|Verbatim|minted|alltt"
MATH_ENVIRONMENTS = "equation|align|gather|multline|eqnarray|displaymath|math|flalign|alignat"
CODE_TAGS = "source|syntaxhighlight"
TAGS = "a|abbr|b|big|blockquote|body|br|caption|center|cite|code|col|colgroup|dd|del|dfn|div|dl|dt|em|font|footer|gallery|h[1-6]|head|header|hr|html|i|imagemap|img|includeonly|ins|kbd|li|link|main|mark|math|meta|nav|noinclude|nowiki|ol|onlyinclude|p|poem|pre|q|ref|references|s|samp|script|section|small|source|span|strike|strong|style|sub|sup|syntaxhighlight|table|tbody|td|tfoot|th|thead|timeline|title|tr|tt|u|ul|var|wbr"

CODE, MATH, LITERAL, END, ELEMENT, APART = "\ue001", "\ue002", "\ue003", "\ue004", "\ue005", "\ue006"
HELD = re.compile(f"([{CODE}{MATH}{LITERAL}])(\\d+){END}")
MARKED = re.compile(f"{ELEMENT}(\\d+){END}")

SHIELD = re.compile(
    rf"""(?P<none><!--.*?(?:-->|\Z)|<(?P<hid>script|style)\b[^<>]*>.*?(?:</(?P=hid)\s*>|\Z))
    |(?P<literal><nowiki\s*>.*?(?:</nowiki\s*>|\Z)|<nowiki\s*/>)
    |(?P<code><pre\b[^<>]*>.*?(?:</pre\s*>|\Z)
      |<(?P<ctag>{CODE_TAGS})\b[^<>]*>.*?(?:</(?P=ctag)\s*>|\Z)
      |^[ ]{{0,3}}(?P<fence>`{{3,}}|~{{3,}})[^\n`]*\n.*?(?:^[ ]{{0,3}}(?P=fence)[`~]*[ \t]*$|\Z)
      |\\begin\{{(?P<cenv>{CODE_ENVIRONMENTS})\*?\}}.*?(?:\\end\{{(?P=cenv)\*?\}}|\Z))
    |(?P<inline><code\b[^<>]*>.*?</code\s*>|<(?P<mono>tt|kbd|samp)\b[^<>]*>.*?</(?P=mono)\s*>|(?<!`)(?P<tick>`{{1,2}})(?!`)[^`\n]+(?P=tick)(?!`)|\\(?:verb|lstinline)\*?(?P<bar>[|!+@])[^\n]*?(?P=bar))
    |(?P<math><math\b[^<>/]*>.*?(?:</math\s*>|\Z)
      |\\begin\{{(?P<menv>{MATH_ENVIRONMENTS})\*?\}}.*?(?:\\end\{{(?P=menv)\*?\}}|\Z)
      |(?<!\\)\$\$(?!\$).+?\$\$
      |(?<!\\)\\\[.+?\\\]
      |(?<!\\)\\\(.+?\\\)
      |(?<![\\$\w])\$(?![\s$])(?:[^$\n\\]|\\.|\n(?![ \t]*\n))*?(?<![\s\\])\$(?![\d$]))
    |(?P<remark>(?<![\\\d])(?<!\d[ \u00a0\u202f])%[^\n%]*\\[a-zA-Z][^\n]*|^[ \t]*%[^\n]*)""",
    re.X | re.S | re.M | re.I,
)

WIKI_HEADING = re.compile(r"^(={1,6})[ \t]*(?P<t>[^=\s](?:.*?[^=\s])?)[ \t]*={1,6}[ \t]*$")
ATX = re.compile(r"^ {0,3}#{1,6}[ \t]+(?P<t>\S.*?)(?P<close>[ \t]+#+)?[ \t]*$")
UNDERLINE = re.compile(r"^ {0,3}(?:={3,}|-{3,})[ \t]*$")
WIKI_ITEM = re.compile(r"^(?P<m>[:;]*[*#][*#:;]*)(?P<s>[ \t]*)(?P<t>\S.*)$")
MARKDOWN_ITEM = re.compile(r"^(?P<i>[ \t]*)(?:[-+*•]|(?P<n>\d{1,3})[.)])[ \t]+(?P<t>\S.*)$")
RULE = re.compile(r"^ {0,3}(?:(?:\*[ \t]*){3,}|(?:-[ \t]*){3,}|(?:_[ \t]*){3,})$")
HTML_HEADING = re.compile(r"<h([1-6])\b[^>]*>(?P<t>.*?)(?:</h\1\s*>|(?=\n\n)|\Z)", re.S | re.I)
HTML_ITEM = re.compile(r"<li\b[^>]*>", re.I)
TEX_HEADING = re.compile(r"(?<![\w\\:])\\(?:part|chapter|(?:sub){0,2}section|(?:sub)?paragraph)\*?(?:\[[^\]]*\])?\{(?P<t>(?:[^{}]|\{[^{}]*\})*)\}")
TEX_ITEM = re.compile(r"(?<![\w\\:])\\item(?![a-zA-Z])(?:\[[^\]]*\])?")
EMPHASIS = re.compile(r"^(?P<m>\*{1,3})(?=[^\s*])[^*\n]*?(?<=[^\s*(])(?P=m)(?!\*)")
GOES_ON, NUMBER, THAI = re.compile(r"[\p{Ll}\d=]"), re.compile(r"\d+\b"), re.compile(r"\p{Thai}")
INDENTED = re.compile(r"(?: {4}|\t)\s*\S")
SENTENCE_END = re.compile(r"[.!?…。！？।؟;:][\"'”’“»)\]』」]*\s*$")

ANY = re.compile(
    rf"""</?(?:{TAGS})(?:\s[^<>]*|/)?\s*/?>|<!--|-->
    |&(?:[a-zA-Z][a-zA-Z0-9]{{1,30}}|\#\d{{1,7}}|\#[xX][0-9a-fA-F]{{1,6}});
    |\[\[|\]\]|\{{\{{|\}}\}}|''|\{{\||^[ \t]*\|[}}\-|]|\[(?:https?:)?//[^\s\]]+[^\]]*\]|__[A-Z]{{3,}}__|~{{3,5}}
    |!?\[[^\[\]\n]*\]\([^()\s]*(?:\([^()\s]*\))?[^()\s]*(?:\s+"[^"\n]*")?\)|^\[[^\]\n]+\]:\s*\S+|!?\[[^\]\n]+\]\[[^\]\n]*\]
    |(?<![\w*\\])(?P<e>\*{{1,3}})(?=[^\s*])[^*\n]*?(?<=[^\s*(])(?P=e)(?![\w*])|(?<![\w_\\])(?P<u>_{{1,3}})(?=[^\s_])[^_\n]*?(?<=[^\s_])(?P=u)(?![\w_])|~~[^\s~][^~\n]*~~
    |(?<!`)`[^`\n]+`|^[ ]{{0,3}}>[ \t]+\S|^[ ]{{0,3}}\|.*\|[ \t]*$|^\|?[ \t]*:?-{{3,}}:?[ \t]*\|
    |(?<![\w\\:])\\[a-zA-Z]+\*?(?:\s*[\[{{]|(?![\w\\])) |\{{\\[a-z]+\s|\\\\[ \t]*$|\\[%&_\#$][^\w]|\\begin\b|\\end\b""",
    re.X | re.M,
)


# What is shielded only where it is closed: openings behind the last closing would each be sought to the text's end.
CLOSED = [(sign, re.compile(o, re.I), re.compile(c, re.I)) for sign, o, c in (("<", "<(?=code\\b)", "(?r)</code"), ("<", "<(?=(?:tt|kbd|samp)\\b)", "(?r)</(?:tt|kbd|samp)"), ("\\[", r"\\(?=\[)", r"(?r)\\\]"), ("\\(", r"\\(?=\()", r"(?r)\\\)"))]


def _open_ends(text: str) -> str:
    """Openings that nothing closes, set apart from what they open."""
    for sign, opening, closing in CLOSED:
        if sign not in text:
            continue
        last = closing.search(text)
        at = last.end() if last else 0
        text = text[:at] + opening.sub(lambda m: m[0] + APART, text[at:])
    return text


def _item(line: str, before: str, numbers: dict[int, int]) -> str | None:
    """The text of a list item, if the line is one; before is the line above it."""
    tail = before.strip()
    # a line that goes on in the middle of a sentence is prose, whatever sign it starts with
    closed = not tail or tail[-1] in ">}]" + END or SENTENCE_END.search(tail) or WIKI_HEADING.match(before) or ATX.match(before)
    goes_on = not closed and not WIKI_ITEM.match(before) and not MARKDOWN_ITEM.match(before)
    if (m := WIKI_ITEM.match(line)) and not EMPHASIS.match(line) and not RULE.match(line):
        if goes_on and GOES_ON.match(m["t"]):
            return None
        if m["m"].strip("#") == "" and NUMBER.match(m["t"]) and not m["s"]:  # a number sign
            return None
        if "#" in m["m"] and m["m"].strip("#") == "" and m["s"] and _titled(line):
            return None
        return m["t"]
    if m := MARKDOWN_ITEM.match(line):
        if RULE.match(line) or goes_on and GOES_ON.match(m["t"]):
            return None
        depth = len(m["i"].expandtabs(4)) // 2
        if m["n"]:
            n = int(m["n"])
            follows = numbers.get(depth) == n - 1
            if not (follows or n <= 1 and not goes_on):
                return None
            numbers[depth] = n
        return m["t"]
    return None


def _titled(line: str) -> bool:
    """Whether a line of number signs is a heading; else it is an item of a numbered list."""
    if not (m := ATX.match(line)):
        return False
    if m["close"]:
        return True
    t = m["t"]
    return len(t) <= 48 and not SENTENCE_END.search(t) and not (len(t) > 26 and THAI.search(t))


def parse(text: str) -> tuple[list[tuple[str, str]], bool, str, list[str]]:
    """Elements (kind, text) in reading order, whether there is any markup, and the text in one markup.

    In that text headings begin with `# ` and items with `- `, on lines of
    their own; what is shown literally stands in the list at the end, and a
    mark with its number holds its place. A line begins with a mark for each
    element on it.
    """
    held: list[str] = []
    gone = False

    def shield(m: re.Match) -> str:
        nonlocal gone
        if m["none"] is not None or m["remark"] is not None:
            gone = True
            return ""
        mark = CODE if m["code"] is not None else MATH if m["math"] is not None else LITERAL
        held.append(m[0])
        return f"{mark}{len(held) - 1}{END}"

    text = text.replace("\r\n", "\n").replace("\r", "\n")
    for mark in (CODE, MATH, LITERAL, END, ELEMENT, APART):
        text = text.replace(mark, " ")
    masked = SHIELD.sub(shield, _open_ends(text)).replace(APART, "")
    held = [h.replace(APART, "") for h in held]
    found: list[tuple[str, str]] = []
    out: list[str] = []
    lines = masked.split("\n")
    numbers: dict[int, int] = {}
    block: list[str] | None = None

    def close() -> None:
        nonlocal block
        if block is not None:
            whole = HELD.sub(lambda m: held[int(m[2])], "\n".join(block))
            found.append(("code_block", whole))
            held.append(whole)
            out.append(f"{ELEMENT}{len(found) - 1}{END}{CODE}{len(held) - 1}{END}")
            block = None

    for i, line in enumerate(lines):
        before = lines[i - 1] if i else ""
        bare = line.strip()
        if INDENTED.match(line) and (not before.strip() or block is not None):
            block = [*(block or []), line]
            continue
        if block is not None and not bare and i + 1 < len(lines) and INDENTED.match(lines[i + 1]):
            continue
        close()
        kind, inner, before_line = None, line, len(found)
        if not bare:
            pass
        elif m := WIKI_HEADING.match(line):
            kind, inner = "heading", m["t"]
        elif i + 1 < len(lines) and UNDERLINE.match(lines[i + 1]) and not UNDERLINE.match(line) and not MARKDOWN_ITEM.match(line) and not WIKI_ITEM.match(line) and not before.strip() and len(bare) <= 120:
            kind, inner = "heading", bare
            lines[i + 1] = ""
        elif ATX.match(line) and _titled(line):
            kind, inner = "heading", ATX.match(line)["t"]
        elif (t := _item(line, before, numbers)) is not None:
            kind, inner = "list_item", t
        if kind != "list_item" and bare and not line.startswith((" ", "\t")):
            numbers.clear()
        if kind:
            found.append((kind, inner))
        # elements within the line, in the order of their places
        headings = (HTML_HEADING,) * ("<" in line) + (TEX_HEADING,) * ("\\" in line)
        items = (HTML_ITEM,) * ("<" in line) + (TEX_ITEM,) * ("\\" in line)
        if headings or END in line:
            inline = [(m.start(), "heading", m["t"]) for r in headings for m in r.finditer(line)]
            inline += [(m.start(), "list_item", line[m.end() :]) for r in items for m in r.finditer(line)]
            inline += [(m.start(), {CODE: "code_block", MATH: "formula"}.get(m[1], ""), held[int(m[2])]) for m in HELD.finditer(line)]
            found += [(k, t) for _, k, t in sorted(inline) if k]
            for r in headings:
                inner = r.sub(lambda m: f"\n# {m['t']}\n", inner)
            for r in items:
                inner = r.sub("\n- ", inner)
        marks = "".join(f"{ELEMENT}{k}{END}" for k in range(before_line, len(found)))
        out.append(marks + {"heading": "# ", "list_item": "- "}.get(kind, "") + inner)
    close()
    marked = gone or bool(found) or bool(held) or bool(ANY.search(masked)) or any(RULE.match(x) for x in lines)
    return found, marked, "\n".join(out), held


def _marks(m: re.Match) -> str:
    return "".join(x[0] for x in MARKED.finditer(m[0]))


# Patterns of the markup that strip takes off, each with what takes its place and a sign without which it cannot match.
_NAMES = "Datei|Bild|Fichier|File|Image|Archivo|Файл|Αρχείο|Kategorie|Category|Catégorie|Categoría|Категория"
NESTED = re.compile(r"\{\{[^{}]*\}\}|\{\|(?:(?!\{\|).)*?^[ \t]*\|\}", re.S | re.M)
COMMAND = re.compile(r"(?<![\w\\:])\\[a-zA-Z]+\*?(?:\[[^\]]*\])?\{([^{}]*)\}|\{\\[a-z]+\s+([^{}]*)\}")
TAKEN = [
    (sign, re.compile(pattern, flags), to)
    for sign, pattern, to, flags in (
        ("[[", rf"\[\[(?:{_NAMES}):[^\[\]]*(?:\[\[[^\[\]]*\]\][^\[\]]*)*\]\]", _marks, re.I),
        ("<", r"<ref\b[^>]*/>|<ref\b[^>]*>.*?</ref\s*>|<gallery\b[^>]*>.*?</gallery\s*>", _marks, re.S | re.I),
        ("[[", r"\[\[(?:[^|\[\]]*\|)?([^|\[\]]*)\]\]", r"\1", 0),
        ("//", r"\[(?:https?:)?//[^\s\]]+[ \t]*([^\]\n]*)\]", r"\1", 0),
        ("](", r"!\[[^\[\]\n]*\]\([^)\s]*\)", "", 0),
        ("](", r"\[([^\[\]\n]*)\]\([^()\s]*(?:\([^()\s]*\))?[^()\s]*\)", r"\1", 0),
        ("<", r"<br\s*/?>", " ", re.I),
        ("<", rf"</?(?:{TAGS})(?:\s[^<>]*|/)?\s*/?>", "", re.I),
        ("''", r"'{2,5}", "", 0),
        ("__", r"__[A-Z]{3,}__", "", 0),
        ("*", r"(?<![\w*\\])(\*{1,3})(?=[^\s*])([^*\n]*?)(?<=[^\s*(])\1(?![\w*])", r"\2", 0),
        ("~~", r"~~([^\s~][^~\n]*)~~", r"\1", 0),
        ("\\begin", r"\\begin\{tabular\}.*?\\end\{tabular\}", _marks, re.S),
        ("\\", r"\\(?:includegraphics|label|ref|cite|pageref|documentclass|usepackage|begin|end|newpage|clearpage|vspace|hspace)(?![a-zA-Z])\*?(?:\[[^\]]*\])*(?:\{[^{}]*\})*", "", 0),
        ("\\href", r"\\href\{[^{}]*\}\{([^{}]*)\}", r"\1", 0),
    )
]
LINES = re.compile(r"^[ ]{0,3}>[ \t]?|^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*\|.*$|^[ ]{0,3}(?:(?:[*][ \t]*){3,}|(?:-[ \t]*){3,}|(?:_[ \t]*){3,})$|^:+(?=\s*\ue002)", re.M)
ESCAPED = re.compile(r"\\\\[ \t]*$|\\([%&_#$])", re.M)
SPACES, LINE_ENDS = re.compile(r"[ \t\u00a0]+"), re.compile(r"^ | $", re.M)


def strip(t: str) -> str:
    """A text in the form that parse gives, without markup of words and without tables and templates, whose marks stay."""
    for _ in range(8):
        new = NESTED.sub(_marks, t) if "{{" in t or "{|" in t else t
        if new == t:
            break
        t = new
    for sign, pattern, to in TAKEN:
        if sign in t:
            t = pattern.sub(to, t)
    for _ in range(4):
        new = COMMAND.sub(lambda m: m[1] or m[2] or "", t) if "\\" in t else t
        if new == t:
            break
        t = new
    t = LINES.sub("", t)
    if "\\" in t:
        t = ESCAPED.sub(r"\1", t)
    t = SPACES.sub(" ", html.unescape(t) if "&" in t else t)
    return LINE_ENDS.sub("", t)


def _shown(mark: str, raw: str) -> str:
    """Code fenced, formulas between dollars, and other literal text bare."""
    if mark == MATH:
        inner = re.sub(rf"^(?:<math\b[^>]*>|\$\$?|\\[\[(]|\\begin\{{\w+\*?\}})\s*|\s*(?:</math\s*>|\$\$?|\\[\])]|\\end\{{\w+\*?\}})$", "", raw, flags=re.I)
        return f"${inner.strip()}$"
    if mark == CODE:
        inner = re.sub(rf"^(?:(?:<(?:pre|code|{CODE_TAGS})\b[^>]*>)+|[ ]*(?:`{{3,}}|~{{3,}})[^\n]*\n|\\begin\{{\w+\*?\}}(?:\[[^\]]*\])?)|(?:(?:</(?:pre|code|{CODE_TAGS})\s*>)+|\n?[ ]*(?:`{{3,}}|~{{3,}})[ \t]*|\\end\{{\w+\*?\}})$", "", raw, flags=re.I)
        return "\n```\n" + (html.unescape(inner) if raw.lstrip().startswith("<") else inner).strip("\n") + "\n```\n"
    return html.unescape(re.sub(r"^<[a-z]+\b[^>]*>|</[a-z]+\s*>$|^`+|`+$|^\\(?:verb|lstinline)\*?.|[|!+@]$", "", raw, flags=re.I))


WIDE = re.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}]")


def turning_point(sums: list[int]) -> float:
    """The sum that parts the short from the long ones: the cut of their logarithms with the greatest variance between its sides.

    0, so that nothing is short, where the sides are not at least four times apart.
    """
    logs = np.sort(np.log([x for x in sums if x > 0]))
    if len(logs) < 2:
        return 0.0
    n = np.arange(1, len(logs))
    low = np.cumsum(logs)[:-1]
    gap = (logs.sum() - low) / (len(logs) - n) - low / n
    at = int(np.argmax(n * (len(logs) - n) * gap**2))
    return float(np.exp((logs[at] + logs[at + 1]) / 2)) if gap[at] >= np.log(4) else 0.0


def blocks(lines: list[str], anchors: list[bool], window: int = 3) -> list[bool]:
    """Which bare lines are kept by the distribution of their lengths.

    A block surges at a line that carries its share of a window's sum above
    the turning point, or ends as a sentence does, and dives where the sum
    falls under half of that; lines on which the last one goes on without a
    blank line are its own. A single line between two blocks is no dive.
    Anchors are kept and, as parts of the text, no short lines.
    """
    sizes = [len(x.strip()) + len(WIDE.findall(x)) for x in lines]
    sums = [sum(sizes[i : i + window]) for i in range(len(sizes))]
    least = turning_point([s for s, x, a in zip(sums, sizes, anchors) if x and not a])
    keep = list(anchors)
    i = 0
    while i < len(sums):
        tells = sizes[i] > 0 and (sums[i] > least and sizes[i] * window > least or SENTENCE_END.search(lines[i]))
        if not tells:
            i += 1
            continue
        keep[i] = True
        i += 1
        while i < len(sums) and (sums[i] > least / 2 and (sizes[i] == 0 or sizes[i] * window > least) or sizes[i] and sizes[i - 1]):
            keep[i] = True
            i += 1
    text = [k for k, x in enumerate(sizes) if x or anchors[k]]
    for a, b, c in zip(text, text[1:], text[2:]):
        if keep[a] and keep[c] and not (anchors[a] and anchors[c]):
            keep[b] = True
    return keep if any(keep) else [True] * len(lines)


def kept(text: str, window: int = 3) -> tuple[list[tuple[str, str]], bool, list[str], list[str]]:
    """Elements and lines that the distribution keeps, whether there is any markup, and what the lines show literally."""
    found, marked, shown, held = parse(text)
    lines = strip(shown).split("\n")
    elements = [[int(m[1]) for m in MARKED.finditer(x)] if ELEMENT in x else [] for x in lines]
    lines = [MARKED.sub("", x) if e else x for x, e in zip(lines, elements)]
    keep = blocks([HELD.sub("", x) if END in x else x for x in lines], [bool(e) or x.startswith(("# ", "- ")) or END in x for e, x in zip(elements, lines)], window)
    return [found[i] for e, k in zip(elements, keep) if k for i in e], marked, [x for x, k in zip(lines, keep) if k or not x], held


def clean(text: str, window: int = 3) -> tuple[list[tuple[str, str]], bool, str]:
    """What is kept, with the lines as one clean text."""
    found, marked, lines, held = kept(text, window)
    body = HELD.sub(lambda m: _shown(m[1], held[int(m[2])]), "\n".join(lines))
    return found, marked, re.sub(r"\n{3,}", "\n\n", body).strip()


ELEMENTS = "page_id long, unit_kind string, unit_seq long"
CLEANED = "page_id long, title string, has_markup boolean, n_heading int, n_list_item int, n_code_block int, n_formula int, clean_text string"


def _elements(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        rows = []
        for page, text in zip(part["page_id"], part["text"]):
            found, marked, _, _ = kept(text)
            if marked:
                rows.append((page, "any", 0))
            count = dict.fromkeys(KINDS, 0)
            for kind, _ in found:
                count[kind] += 1
                rows.append((page, kind, count[kind]))
        yield pd.DataFrame(rows, columns=["page_id", "unit_kind", "unit_seq"])


def _cleaned(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        rows = []
        for page, title, text in zip(part["page_id"], part["title"], part["text"]):
            found, marked, body = clean(text or "")
            count = dict.fromkeys(KINDS, 0)
            for kind, _ in found:
                count[kind] += 1
            rows.append((page, title, marked, *(count[k] for k in KINDS), body))
        yield pd.DataFrame(rows, columns=["page_id", "title", "has_markup", *(f"n_{k}" for k in KINDS), "clean_text"])


def markup_elements(text: DataFrame) -> DataFrame:
    """page_id, unit_kind, unit_seq: (`any`, 0) for texts with markup, and each element of the kept blocks.

    Null and blank texts have no markup; repeated rows count once.
    """
    rows = text.select("page_id", "text").where("trim(text) <> ''").distinct()
    return rows.mapInPandas(_elements, ELEMENTS).distinct()


def cleaned_texts(text: DataFrame) -> DataFrame:
    """Clean text with headings as `# `, items as `- `, code and formulas as they were.

    Null and empty texts give an empty clean text; repeated rows give one row.
    """
    return text.select("page_id", "title", "text").distinct().mapInPandas(_cleaned, CLEANED)
