"""P2: sentence boundaries across languages and scripts.

Every place where a sentence may end is decided by tables of ordered rules: a
rule has a pattern for the text before the place, one for the text after it,
and breaks or does not; the first that matches decides. Tables cascade: the
rules of the writing first, then those of the language, then those that hold
everywhere. Only the places that a terminator, a blank line or a Thai blank
offers are ever looked at. What stands before a place is read backwards from it,
at most to the beginning of its unit, and what stands after it at most to the
next terminator or blank line; so a decision never hangs on a length.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import regex as re
from pyspark.sql import DataFrame, functions as F

BREAK, STAY = True, False

CLOSE = "\"'”’»)\\]』」›"
QUOTES = "\"”“’»』」›"
OPEN = "„“‚‘«‹¿¡(\\[「『\"'"
EAST = r"\p{Han}\p{Hiragana}\p{Katakana}ー々〆"

# Burmese, Khmer, Tibetan, Ethiopic and Armenian full stops and question marks.
SCRIPT_STOPS = "။។៕།༎።፧։"

PLACE = re.compile(
    rf"(?:[.!?…]+|[。．！？｡]+|[।॥؟۔]+|[{SCRIPT_STOPS}]+|[;;](?=\s|$))(?:[“{CLOSE}]|[\s]»)*(?P<gap>\s*)"  # a terminator with what closes after it
    r"|(?P<para>[ \t\r]*\n(?:[ \t\r ]*\n)+\s*)"  # a blank line
    r"|(?<=[\p{Thai}])(?P<thai>[ \t\r\n ]+)(?=[\p{Thai}\p{Lu}\d„“«])"
    rf"|(?<=\p{{L}}[!?…]|[.!?]”)(?=[{EAST}])"
)

# Abbreviations, written as patterns. NEVER ends no sentence; MAY
# may end one, if what follows looks like a beginning.
NEVER = {
    "de": r"Dr|Prof|Nr|Abs|Abb|Art|Bd|Hr|Fr|Frl|St|S|Z|vgl|ca|bzw|bspw|ggf|evtl|inkl|exkl|geb|gest|verh|sog|Tab|Kap|Anm|Hrsg|Ing|Dipl|Mag|Str|z\.\s?B|d\.\s?h|u\.\s?a|o\.\s?g|i\.\s?d\.\s?R|v\.\s?a|z\.\s?T|u|z|d|v|o",
    "en": r"Mr|Mrs|Ms|Dr|Prof|St|Rev|Hon|Gen|Col|Capt|Lt|Sgt|Gov|Sen|Rep|No|Nos|fig|figs|Fig|vol|Vol|p|pp|sec|Sec|approx|ca|cf|vs|e\.\s?g|i\.\s?e|i|viz|Mt|Ft",
    "fr": r"M|MM|Mgr|Dr|Pr|St|Ste|art|Art|env|av|cf|p|pp|n|no|vol|chap|éd|fig|c\.-à-d|c\.\s?-à-d|c|c\.\s?-\s?à\s?-\s?d|ap|J\.-C|Me",
    "es": r"Sr|Sra|Srta|Dr|Dra|D|Dña|Ud|Uds|pág|págs|pag|núm|vol|cap|fig|art|Ing|Lic|Gral|Sto|Sta|Av|p\.\s?ej|aprox",
    "ru": r"проф|акад|доц|им|ул|стр|с|рис|табл|гл|т\.\s?е|т\.\s?к|тыс|млн|млрд|св|пл|просп|д-р|ср|см|напр|гр|т|и",
    "el": r"κ|κα|κκ|Δρ|καθ|σελ|αρ|βλ|π\.\s?χ|δηλ|αγ|π|λ",
    "hi": r"डॉ|श्री|श्रीमती|प्रो|सु|पं|मो|क्र|सं",
    "it": r"Sig|Dott|Prof|Avv|Ing|Mons|sig|sigg|sig\.\s?ra|dott|dott\.\s?ssa|prof|ing|avv|on|mons|card|arch|geom|pag|pagg|art|cap|vol|fig|tab|n|nn|cfr|ca|es|p\.\s?es|S|St|spett|egr",
    "pt": r"Sr|Sra|Srta|Dr|Dra|Prof|Profa|Eng|Arq|Exmo|Exma|D|pág|págs|p|n|núm|vol|cap|fig|art|ex|p\.\s?ex|Av|R|Sto|Sta|S|séc|aprox|cf|tel",
    "pl": r"Prof|Dr|Ks|Gen|prof|dr|hab|inż|mgr|ul|al|pl|os|nr|str|s|tzw|tzn|np|m\.\s?in|św|ks|gen|płk|kpt|por|ok|im|red|tab|rys|godz|tys|mln|mld",
    "nl": r"Dhr|Mevr|Mw|Dr|Prof|Drs|Ir|dhr|mevr|mw|dr|prof|drs|ir|mr|ing|nr|blz|p|bijv|bv|d\.\s?w\.\s?z|o\.\s?a|m\.\s?b\.\s?t|t\.\s?o\.\s?v|i\.\s?p\.\s?v|z\.\s?g\.\s?n|ca|vgl|jl|resp|art|afb|fig|hfst|St",
    "ko": r"No|Dr|Mr|Mrs|St|vs",
    "ar": r"د|أ|م|ص|ج|أ\.\s?د|ه|ق\.\s?م",
}
MAY = r"etc|usw|usf|u\.\s?Ä|u\.\s?ä|u\.\s?dgl|ff|f|jun|sen|Jr|Sr|Inc|Ltd|Co|Corp|Bros|a\.\s?m|p\.\s?m|κ\.\s?λ\s?π|κ\.\s?ά|κ\.\s?ο\.\s?κ|т\.\s?д|т\.\s?п|др|пр|гг|руб|коп|га|ha|ft|km|Jh|v\.\s?Chr|n\.\s?Chr|jr|al|Cie"
MONTHS = "Januar|Jänner|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember"

BEGIN = rf"[\p{{Lu}}\p{{Lt}}\p{{Lo}}\d{OPEN}£$€§*–—…-]"
LATIN_STOP = rf"[.!?…]+[“{CLOSE}\s]*$"


def _word(names: str) -> str:
    return rf"(?<![^\s{OPEN}’'\-/。！？」』])(?:{names})\.$"


Rule = tuple[bool, str, str]
HEAD_OF_UNIT = "head of unit: "  # before a pattern for all that stands before the place

# Rules by writing, by language and for all, in the order in which they are asked.
TABLES: dict[str, list[Rule]] = {
    "east": [
        (STAY, rf"[。．！？｡.!?…]+[{QUOTES}]+$", rf"(?![「『“\"„«])(?:[^\p{{Lu}}\s]|(?:[^.!?。！？\n]|\b\p{{Lu}}\.)+?[{EAST}])"),  # quoted speech goes on
        (STAY, r"(?:…+|\.{2,})$", rf"[{EAST}\p{{Ll}}、，]"),
        (BREAK, rf"[。．！？｡]+[{CLOSE}]*$", r"\S"),
        (BREAK, rf"[.!?]+[”{CLOSE}]*$", rf"[{EAST}「『“]"),
    ],
    "indic": [(BREAK, rf"[।॥]+[{CLOSE}]*$", r"\S")],
    "arabic": [(STAY, rf"[.؟!]+[{QUOTES}]*$", r"[،؛:,)\]»]"), (BREAK, rf"[؟۔]+[{CLOSE}]*$", r"\S")],
    "stops": [(BREAK, rf"[{SCRIPT_STOPS}]+[{CLOSE}]*$", r"\S")],
    "thai": [
        (STAY, r"\d[)]?$", r"\p{Thai}"),
        (STAY, r"\p{Thai}$", r"\d"),
        (STAY, r"\p{Thai}$", r"\p{Lu}[^.!?\n\p{Thai}]*\p{Thai}"),  # a name within Thai
        (BREAK, r"\p{Thai}$", r"\S"),
    ],
    "greek": [(BREAK, r"\p{Greek}[^;;]*[;;]$", rf"[\p{{Lu}}{OPEN}\d]"), (STAY, r"[;;]$", r"")],
    "de": [
        (BREAK, _word(r"u\.\s?Ä|usw|usf|jun|sen|ha"), r"(?=[\p{Lu}„\d])"),
        (STAY, r"(?<!\S)[0-3]?\d\.$", rf"(?:{MONTHS}|Jahrhundert|Jh|Jahrtausend|Kapitel|Auflage|Klasse|Stock|Band|Reihe)"),
        (STAY, _word(NEVER["de"]), r""),
    ],
    "en": [(BREAK, _word(r"Jr|Inc|a\.\s?m|p\.\s?m"), rf"(?=[\p{{Lu}}{OPEN}£$\d])"), (STAY, _word(NEVER["en"]), r"")],
    "fr": [(STAY, _word(NEVER["fr"]), r"")],
    "es": [(STAY, _word(NEVER["es"]), r"")],
    "ru": [
        (STAY, r"(?<!\S)(?:в|из|под|у|до|от|около|из-под)\s(?:г|с|пос|д)\.$", r"\p{Lu}"),
        (BREAK, r"\d\s?г\.$", r"[\p{Lu}«]"),
        (BREAK, _word(r"т\.\s?д|т\.\s?п|др|пр|гг|руб|коп|га"), r"[\p{Lu}«\d]"),
        (STAY, _word(NEVER["ru"]), r""),
        (STAY, r"(?<!\S)г\.$", r"\p{Lu}"),
    ],
    "el": [(BREAK, _word(r"κ\.\s?λ\s?π|κ\.\s?ά|κ\.\s?ο\.\s?κ"), r"[\p{Lu}«]"), (STAY, _word(NEVER["el"]), r"")],
    "it": [(BREAK, _word(r"ecc|a\.\s?C|d\.\s?C"), rf"(?={BEGIN})"), (STAY, _word(NEVER["it"]), r"")],
    "pt": [(BREAK, _word(r"etc|a\.\s?C|d\.\s?C|Ltda"), rf"(?={BEGIN})"), (STAY, _word(NEVER["pt"]), r"")],
    "pl": [(BREAK, r"\d\s?r\.$|" + _word(r"itd|itp|w|zł"), rf"(?={BEGIN})"), (STAY, _word(NEVER["pl"]), r"")],
    "nl": [(BREAK, _word(r"enz|e\.\s?d"), rf"(?={BEGIN})"), (STAY, _word(NEVER["nl"]), r"")],
    "ko": [(STAY, r"(?<!\d)\d{1,4}\.$", r"\d{1,2}\.(?:\s|$)"), (STAY, r"(?<!\d)\d{4}\.\s?\d{1,2}\.\s?\d{1,2}\.$", r"\S"), (STAY, _word(NEVER["ko"]), r"")],  # dates
    "hi": [(STAY, _word(NEVER["hi"]), r"")],
    "ar": [(STAY, _word(NEVER["ar"]), r"")],
    "any": [
        (STAY, r"", r"[\p{Ll},;:%)\]»”]"),
        (STAY, rf"[{QUOTES}]$", r"[–—-]\s"),
        (STAY, r"\.$", r"[–—-]\s*\p{Ll}"),
        (BREAK, _word(MAY), rf"(?={BEGIN})"),
        (BREAK, r"\d\s?(?:A\.\s?D|B\.\s?C)\.$", rf"(?={BEGIN})"),
        (STAY, rf"(?<![^\s{OPEN}.\-])\p{{Lu}}\.$", r"[\p{Lu}]"),  # an initial
        (STAY, HEAD_OF_UNIT + r"\(?\d{1,3}\.", r"\S"),  # a number at the head of its unit
        (STAY, r"(?<!\S)(?:n°|№|§)\s?\d*\.?$", r"\d"),
        (BREAK, LATIN_STOP, BEGIN),
        (STAY, r"", r""),
    ],
}



def _backwards(pattern: str) -> Callable[[str, int, int], object]:
    """A pattern for what ends at a place, read backwards from there."""
    if pattern.startswith(HEAD_OF_UNIT):
        return re.compile(pattern[len(HEAD_OF_UNIT) :]).fullmatch
    return re.compile("(?r)(?:" + pattern + ")").match


COMPILED = {name: [(b, _backwards(before), re.compile(after).match) for b, before, after in rules] for name, rules in TABLES.items()}

# Languages whose tables are asked for Latin letters: the page's own, or all in this order where it is not known or none of these.
LATIN = ("de", "en", "fr", "es", "it", "pt", "pl", "nl")


SCRIPTS = [(re.compile(rf"[{EAST}]"), ("east", "any")), (re.compile(r"\p{Cyrillic}"), ("ru", "any")), (re.compile(r"\p{Greek}"), ("greek", "el", "any")), (re.compile(r"\p{Devanagari}"), ("indic", "hi", "any")), (re.compile(r"\p{Arabic}"), ("arabic", "ar", "any")), (re.compile(r"\p{Thai}"), ("thai", "any")), (re.compile(r"\p{Hangul}"), ("ko", "any"))]


@lru_cache(maxsize=20_000)
def _cascade(last: str, lang: str | None) -> tuple[str, ...]:
    """The tables for a place, by the last letter before it and the language of the text."""
    for script, tables in SCRIPTS:
        if script.match(last):
            return tables
    if lang in LATIN or lang == "ko":
        return (lang, "any")
    return (*LATIN, "any")  # of a passage in Latin letters on a page of another writing, too, the language is not known


EAST_NEXT = re.compile(rf"[{EAST}「『]")


def _decide(text: str, begin: int, stop: int, at: int, last: str, lang: str | None, at_end: str) -> bool:
    """Whether a unit that begins at `begin` ends with the terminator before `stop`, the next one beginning at `at`."""
    if at_end in "。！？｡．":
        tables: tuple[str, ...] = ("east", "any")
    elif at_end in "।॥":
        tables = ("indic", "any")
    elif at_end in "؟۔":
        tables = ("arabic", "any")
    elif at_end in SCRIPT_STOPS:
        tables = ("stops", "any")
    elif at_end in ";;":
        tables = ("greek",)
    else:
        tables = _cascade(last, lang)
        if EAST_NEXT.match(text, at) and tables[0] not in ("east", "thai"):
            tables = ("east", *tables)
    for name in tables:
        for breaks, before, after in COMPILED[name]:
            if after(text, at) and before(text, begin, stop):
                return breaks
    return STAY


HEAD = re.compile(r"\s*")
LAST_LETTER = re.compile(r"(?r)[\p{L}\p{M}]")
BLANK_LINE = re.compile(r"\n[ \t\r\u00a0]*\n")
UNEVEN = re.compile(r" \s+|[^\S ]\s*")  # blanks other than a single one
INNER = re.compile(rf"[{EAST}「『“\p{{Thai}}]")


def _flat(text: str) -> tuple[str, list[int], list[int]]:
    """text with each run of blanks as one, or as a blank line; where it was changed, and there the offset in text less that in it."""
    parts, places, shifts, at, size = [], [0], [0], 0, 0
    for m in UNEVEN.finditer(text):
        to = "\n\n" if BLANK_LINE.search(m[0]) else " "
        parts += [text[at : m.start()], to]
        size += m.start() - at + len(to)
        at = m.end()
        places.append(size)
        shifts.append(at - size)
    return "".join(parts) + text[at:], places, shifts


def boundaries(text: str, lang: str | None = None, title: str | None = None) -> list[int]:
    """Offsets, in code points, of the first character of each unit that is not blank."""
    head = HEAD.match(text).end()
    if head == len(text):
        return []
    flat, places, shifts = _flat(text)
    begin = HEAD.match(flat).end()
    starts = [begin]
    if title:  # a first line that is the title, and no more, is a unit though no blank line follows
        line = text[head:].split("\n", 1)
        if len(line) == 2 and line[0].strip() == title.replace("_", " ").strip() and line[1].strip():
            second = head + len(line[0]) + 1 + HEAD.match(line[1]).end()
            begin = second - next(s for p, s in zip(places, shifts) if p + s == second)  # blanks that were made one end there
            starts.append(begin)
    for m in PLACE.finditer(flat, begin):
        at = m.end()
        if at >= len(flat):
            break
        if at <= begin:
            continue
        if m["para"] is not None or (m["gap"] and BLANK_LINE.search(m["gap"])):
            starts.append(at)
            begin = at
            continue
        gap = m["gap"] if m["gap"] is not None else (m["thai"] or "")
        stop = at - len(gap)
        end = flat[m.start()] if stop > m.start() else ""
        if not gap and end and end in ".!?…;;" and not INNER.match(flat, at):
            continue  # inside a word or an address
        letter = LAST_LETTER.search(flat, begin, stop)
        if _decide(flat, begin, stop, at, letter[0] if letter else "", lang, end or " "):
            starts.append(at)
            begin = at
    if len(places) == 1:
        return starts
    return [s + shifts[bisect_right(places, s) - 1] for s in starts]


NO_BLANK_BEFORE = re.compile(rf"^[.,;:!?…%{CLOSE}。！？、，।؟،；：）]+$")
NO_BLANK_AFTER = re.compile(r"^[„«‹¿¡(\[「『（‚£$§]$")
JOINED = re.compile(rf"[{EAST}\p{{Thai}}、。！？，「」『』（）・…]")


@lru_cache(maxsize=50_000)
def _shape(token: str) -> tuple[bool, bool, bool, bool]:
    """Whether no blank goes before and after a token, and whether its ends are of writings without blanks."""
    return bool(NO_BLANK_BEFORE.match(token)), bool(NO_BLANK_AFTER.match(token)), bool(JOINED.match(token[0])), bool(JOINED.match(token[-1]))


def joined(tokens: list[str]) -> tuple[str, list[int]]:
    """The text that tokens were cut from, as far as it matters, and each token's offset."""
    parts, at, offsets, quote = [], 0, [], 0
    last: tuple[bool, bool, bool, bool] | None = None
    for t in tokens:
        if t in ("_", ""):
            offsets.append(at)
            parts.append(" ")
            at += 1
            last = None
            continue
        shape = _shape(t)
        closing = t == "“" and quote > 0
        quote += t.count("„") - closing
        if last and not (shape[0] or closing or last[1] or (last[3] and shape[2])):
            parts.append(" ")
            at += 1
        offsets.append(at)
        parts.append(t)
        at += len(t)
        last = shape
    return "".join(parts), offsets


def token_units(tokens: list[str], lang: str | None = None) -> list[int]:
    """Index of the first token of each unit."""
    text, offsets = joined(tokens)
    starts = boundaries(text, lang)
    out, i = [], 0
    for s in starts:
        while i + 1 < len(offsets) and offsets[i + 1] <= s:
            i += 1
        while tokens[i] in ("_", "") and i + 1 < len(tokens):  # a blank belongs to the unit before
            i += 1
        if not out or out[-1] != i:
            out.append(i)
    return out


def _tokens(value: str | None) -> list[str]:
    try:
        lists = json.loads(value) if value else []
    except ValueError:
        return []
    return [t if isinstance(t, str) else "" for s in lists if isinstance(s, list) for t in s] if isinstance(lists, list) else []


UNITS = "src string, page_id long, unit_start long, unit_end long"


def _split_text(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        rows = []
        for page, text, title, lang in zip(part["page_id"], part["text"], part["title"], part["page_lang"]):
            starts = boundaries(text, lang, title) if text else []
            rows += [("text", page, s, e) for s, e in zip(starts, [*starts[1:], len(text or "")])]
        yield pd.DataFrame(rows, columns=["src", "page_id", "unit_start", "unit_end"])


def _split_tokens(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        rows = []
        for page, value, lang in zip(part["page_id"], part["text"], part["page_lang"]):
            tokens = _tokens(value)
            starts = token_units(tokens, lang) if tokens else []
            rows += [("tagged", page, s, e) for s, e in zip(starts, [*starts[1:], len(tokens)])]
        yield pd.DataFrame(rows, columns=["src", "page_id", "unit_start", "unit_end"])


def _pages(page: DataFrame) -> DataFrame:
    return page.where("page_id is not null").groupBy("page_id").agg(F.max("page_lang").alias("page_lang"), F.max("page_content_model").alias("page_content_model"))


def text_units(text: DataFrame, page: DataFrame, plain_only: bool = True) -> DataFrame:
    """src, page_id, unit_start, unit_end of the units of article texts, in code points.

    plain_only: pages whose content model is `text`. Null and blank texts have
    no units; repeated rows count once; a text of any length is cut as a whole.
    """
    pages = _pages(page)
    if plain_only:
        pages = pages.where("page_content_model = 'text'")
    rows = text.select("page_id", "title", "text").where("text is not null").join(pages.select("page_id", "page_lang"), "page_id", "inner" if plain_only else "left").dropDuplicates(["page_id", "text"])
    return rows.mapInPandas(_split_text, UNITS).distinct()


def token_list_units(tagged: DataFrame, page: DataFrame) -> DataFrame:
    """The same for token lists; offsets are token indexes over all lists, which count as one.

    Null, unreadable and empty lists have no units; repeated rows count once.
    """
    rows = tagged.select("page_id", "text").where("text is not null").distinct().join(_pages(page).select("page_id", "page_lang"), "page_id", "left")
    return rows.mapInPandas(_split_tokens, UNITS).distinct()


def sentence_units(text: DataFrame, tagged: DataFrame, page: DataFrame) -> DataFrame:
    return text_units(text, page).unionByName(token_list_units(tagged, page))
