"""P1: visually identical text with different characters, in one form.

Arrow text is copied to numpy code-point arrays; lookup-table gathers expand
and fold the characters, expansion offsets place the results, and combining
marks are reordered and composed by array operations. No call is made per row.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tesserae.operators.skew import skew_lookup
from tesserae.session import materialize, written_sums

# Letters of other scripts that look like a Latin letter in
# common typefaces, each written before the Latin letter it looks like.
ALIKE = {
    # Cyrillic
    "а": "a", "е": "e", "і": "i", "ј": "j", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    "А": "A", "В": "B", "Е": "E", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ѕ": "S", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y",
    "ѵ": "v", "ү": "y", "Ѵ": "V", "Ӏ": "I", "Ԍ": "G",
    # Greek
    "ο": "o", "ν": "v", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ϲ": "c", "Ϲ": "C", "ϳ": "j", "ρ": "p", "Ϳ": "J",
    # Latin and Armenian
    "ɡ": "g", "ɑ": "a", "ı": "i", "օ": "o", "ս": "u", "ո": "n", "հ": "h", "ց": "g", "յ": "j", "զ": "q", "Օ": "O", "Տ": "S", "Ս": "U", "Լ": "L",
    # Cherokee
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭵ": "i", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M", "Ꮋ": "H", "Ꮍ": "y", "Ꮐ": "G", "Ꮒ": "h", "Ꮓ": "Z", "Ꮟ": "b", "Ꮢ": "R", "Ꮤ": "W", "Ꮥ": "S", "Ꮩ": "V", "Ꮪ": "S", "Ꮮ": "L", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ꮷ": "d", "Ᏼ": "B",
    # Lisu
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N", "ꓡ": "L", "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
    # Coptic
    "Ⲃ": "B", "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "Ⲣ": "P", "Ⲥ": "C", "Ⲧ": "T", "Ⲩ": "Y", "Ⲭ": "X", "ⲟ": "o", "ⲣ": "p", "ⲥ": "c", "ⲭ": "x",
    # signs
    "‐": "-", "‑": "-", " ": "_",
}

# Small capitals whose letter has the same shape in both cases, by their names.
ALIKE |= {unicodedata.lookup(f"LATIN LETTER SMALL CAPITAL {c}"): c.lower() for c in "COSUVWZ"}

# Characters without a shape of their own besides those of the
# categories Cf and Cc, and the variation selectors.
SHAPELESS = "͏ᅟᅠ឴឵᠋᠌᠍ㅤﾠ"

# Decompositions that keep the look of the letters.
SAME_LOOK = ("<wide>", "<narrow>", "<noBreak>", "<compat>", "<initial>", "<medial>", "<final>", "<isolated>")


@lru_cache(maxsize=1)
def _tables() -> dict[str, np.ndarray]:
    """Expansion of every code point, combining classes, and the composition pairs."""
    top = sys.maxunicode + 1
    start, size = np.zeros(top, np.int64), np.ones(top, np.int16)
    flat: list[int] = []
    ccc = np.zeros(top, np.uint8)
    single = np.arange(top, dtype=np.uint32)

    def expand(ch: str) -> str:
        cat = unicodedata.category(ch)
        if ch in SHAPELESS or cat == "Cf" or (cat == "Cc") or 0xFE00 <= ord(ch) <= 0xFE0F or 0xE0100 <= ord(ch) <= 0xE01EF:
            return ""
        if cat in ("Zs", "Zl", "Zp"):
            return "_"
        if ch in ALIKE:
            return ALIKE[ch]
        dec = unicodedata.decomposition(ch)
        if not dec and not 0xAC00 <= ord(ch) <= 0xD7A3:
            return ch
        if dec.startswith("<") and not dec.startswith(SAME_LOOK):
            return ch
        if 0xAC00 <= ord(ch) <= 0xD7A3:  # Hangul syllables stay whole
            return ch
        parts = "".join(chr(int(x, 16)) for x in dec.split() if not x.startswith("<"))
        if dec.startswith("<compat>") and parts.startswith(" "):  # a spacing mark is a sign of its own
            return ch
        return "".join(map(expand, parts)) if parts != ch else ch

    pairs: dict[int, int] = {}
    for cp in range(top):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        if cp > 0x7F or cp < 0x21 or cp == 0x7F:
            out = expand(ch)
            if out != ch:
                if len(out) == 1:
                    single[cp] = ord(out)
                else:
                    start[cp], size[cp] = len(flat), len(out)
                    flat.extend(map(ord, out))
            ccc[cp] = unicodedata.combining(ch)
            dec = unicodedata.decomposition(ch)
            if dec and not dec.startswith("<"):
                d = [int(x, 16) for x in dec.split()]
                if len(d) == 2 and unicodedata.normalize("NFC", ch) == ch:
                    pairs[d[0] << 21 | d[1]] = cp
    # letters are folded before they meet their marks, so a folded base composes too
    keys = np.array(sorted(pairs), dtype=np.int64)
    return {"start": start, "size": size, "flat": np.array(flat, np.uint32), "single": single, "ccc": ccc, "keys": keys, "made": np.array([pairs[k] for k in keys.tolist()], np.uint32)}


def _code_points(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all rows, and each row's length; null rows are empty."""
    arr = arr.cast(pa.large_string()).fill_null("")
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(arr) else np.empty(0, np.uint8)
    heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    ends = heads[offsets - offsets[0]]
    cps = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le", "surrogatepass"), np.uint32)
    return cps, np.diff(ends)


def _to_arrow(cps: np.ndarray, lengths: np.ndarray, null: np.ndarray) -> pa.Array:
    data = cps.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
    raw = np.frombuffer(data, np.uint8)
    at = np.concatenate([np.flatnonzero((raw & 0xC0) != 0x80), [len(raw)]])
    offsets = at[np.concatenate([[0], np.cumsum(lengths)])].astype(np.int64)
    out = pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data))
    if not null.any():
        return out.cast(pa.string())
    return pa.compute.if_else(pa.array(~null), out, pa.scalar(None, pa.large_string())).cast(pa.string())


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... for each of sizes, in one array."""
    total = int(sizes.sum())
    if not total:
        return np.empty(0, np.int64)
    begin = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    return begin + np.arange(total)


def fold(cps: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expand, reorder the marks, fold the letters and compose; row: the row of each code point."""
    t = _tables()
    # a composed letter may hide a look-alike: first take marks off, then fold, then put them on again
    size = t["size"][cps].astype(np.int64)
    simple = size == 1
    out_row = np.repeat(row, size)
    out = np.empty(int(size.sum()), np.uint32)
    where = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else size
    out[where[simple]] = t["single"][cps[simple]]
    many = ~simple & (size > 0)
    if many.any():
        out[_ranges(where[many], size[many])] = t["flat"][_ranges(t["start"][cps[many]], size[many])]
    cc = t["ccc"][out]
    if cc.any():
        group = np.cumsum((cc == 0) | np.concatenate([[True], out_row[1:] != out_row[:-1]]))
        order = np.lexsort((cc, group))
        out, out_row, cc = out[order], out_row[order], cc[order]
    while cc.any() or len(t["keys"]):
        # the mark right behind a base, or behind marks of a lower class that stayed
        after = np.flatnonzero(cc[1:] > 0) + 1 if len(cc) > 1 else np.empty(0, np.int64)
        if not len(after):
            break
        base_at = np.maximum.accumulate(np.where(cc == 0, np.arange(len(cc)), -1))
        b = base_at[after]
        clear = (b >= 0) & ((after - 1 == b) | (cc[after - 1] < cc[after]))
        after, b = after[clear], b[clear]
        keep = out_row[after] == out_row[b]
        after, b = after[keep], b[keep]
        key = out[b].astype(np.int64) << 21 | out[after].astype(np.int64)
        at = np.searchsorted(t["keys"], key)
        hit = (at < len(t["keys"])) & (t["keys"][np.minimum(at, len(t["keys"]) - 1)] == key)
        after, b, at = after[hit], b[hit], at[hit]
        if not len(after):
            break
        _, first = np.unique(b, return_index=True)  # one mark a base and round, the nearest first
        out[b[first]] = t["made"][at[first]]
        gone = np.ones(len(out), bool)
        gone[after[first]] = False
        out, out_row, cc = out[gone], out_row[gone], cc[gone]
    return out, out_row


def _percent_decode(arr: pa.Array) -> pa.Array:
    """Undo percent-encoding; `+` stays, broken escapes stay, rows that would not be UTF-8 stay whole."""
    arr = arr.cast(pa.large_string())
    null = np.asarray(arr.is_null())
    full = arr.fill_null("")
    _, off, data = full.buffers()
    offsets = np.frombuffer(off, np.int64)[full.offset : full.offset + len(full) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(full) else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    hexes = np.full(256, 255, np.uint8)
    for i, c in enumerate(b"0123456789"):
        hexes[c] = i
    for i in range(6):
        hexes[ord("A") + i] = hexes[ord("a") + i] = 10 + i
    row = np.repeat(np.arange(len(full)), np.diff(offsets))
    pct = np.flatnonzero(raw == ord("%"))
    pct = pct[pct + 2 < len(raw) + 0] if len(raw) else pct
    ok = (hexes[raw[pct + 1]] < 16) & (hexes[raw[pct + 2]] < 16) & (row[pct] == row[pct + 2]) if len(pct) else np.empty(0, bool)
    pct = pct[ok]
    if not len(pct):
        return arr.cast(pa.string())
    new = raw.copy()
    new[pct] = hexes[raw[pct + 1]] << 4 | hexes[raw[pct + 2]]
    keep = np.ones(len(raw), bool)
    keep[pct + 1] = keep[pct + 2] = False
    lengths = np.bincount(row[keep], minlength=len(full))

    def build(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
        o = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(o.tobytes()), pa.py_buffer(data.tobytes()))

    bad = np.zeros(len(full), bool)
    bad[_broken(new[keep], row[keep])] = True
    if bad.any():
        broken = bad[row]
        keep |= broken
        new = np.where(broken, raw, new)
        lengths = np.bincount(row[keep], minlength=len(full))
    made = build(new[keep], lengths)
    if null.any():
        made = pa.compute.if_else(pa.array(~null), made, pa.scalar(None, pa.large_string()))
    return made.cast(pa.string())


def _broken(raw: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The rows whose bytes are not UTF-8."""
    size = np.ones(256, np.int8)
    size[0x80:0xC0], size[0xC2:0xE0], size[0xE0:0xF0], size[0xF0:0xF5] = 0, 2, 3, 4
    size[0xC0:0xC2] = size[0xF5:] = -1
    own = size[raw]
    wrong = own < 0
    due = np.zeros(len(raw) + 4, np.int8)  # how many sequences want a later byte here
    for k in (1, 2, 3):
        lead = np.flatnonzero(own > k)
        own_row = (lead + k < len(raw)) & (row[np.minimum(lead + k, len(raw) - 1)] == row[lead])
        wrong[lead[~own_row]] = True
        due[lead[own_row] + k] += 1
    wrong |= (own == 0) != (due[: len(raw)] == 1)
    second = raw[np.minimum(np.arange(len(raw)) + 1, len(raw) - 1)] if len(raw) else raw
    for lead, low, high in ((0xE0, 0xA0, 0xBF), (0xED, 0x80, 0x9F), (0xF0, 0x90, 0xBF), (0xF4, 0x80, 0x8F)):
        wrong |= (raw == lead) & ((second < low) | (second > high))
    return np.unique(row[wrong])


def one_form_arrow(arr: pa.Array) -> pa.Array:
    """The one form of every string of an Arrow array; null stays null."""
    null = np.asarray(arr.is_null())
    cps, lengths = _code_points(arr)
    out, row = fold(cps, np.repeat(np.arange(len(lengths)), lengths))
    return _to_arrow(out, np.bincount(row, minlength=len(lengths)), null)


@F.arrow_udf(T.StringType())
def one_form(values: pa.Array) -> pa.Array:
    """Column function: the form in which alike titles are equal and others differ.

    Letter width, ligatures, invisible characters, the kind of blank (`_`
    stands for it), composed or single accents and look-alike letters of other
    scripts do not count; accents, case and other letters or signs do. Null
    gives null, an empty text the empty text.
    """
    return one_form_arrow(values)


@F.arrow_udf(T.StringType())
def percent_decoded(values: pa.Array) -> pa.Array:
    """Column function: percent-encoding undone; values that would not be UTF-8 stay whole."""
    return _percent_decode(values)


def title_values(entities: DataFrame) -> DataFrame:
    """field_name, ent_id, site, value: page titles, and titles in sitelinks with their site."""
    titles = entities.where("page_title is not null").select(F.lit("page_title").alias("field_name"), "ent_id", F.lit("").alias("site"), F.col("page_title").alias("value"))
    at = F.locate("/wiki/", F.col("sitelink"))
    links = entities.where("sitelink is not null").where(at > 0).select(F.lit("sitelink").alias("field_name"), "ent_id", F.expr("substring(sitelink, 1, locate('/wiki/', sitelink) - 1)").alias("site"), percent_decoded(F.expr("substring(sitelink, locate('/wiki/', sitelink) + 6)")).alias("value"))
    return titles.unionByName(links)


def one_form_titles(entities: DataFrame) -> DataFrame:
    """field_name, ent_id, site, value, form for every value that is not null."""
    return title_values(entities).withColumn("form", one_form("value"))


def alike_pairs(entities: DataFrame, share: int = 20_000) -> DataFrame:
    """Pairs of rows whose values look alike but differ: field_name, ent_a < ent_b.

    Forms are made once and written. Which writings share a form is found among
    the distinct writings, so a form written in one way only, however often,
    joins nothing. Of two writings the rows of the more frequent one are cut
    into salts of about `share` rows, which the other's rows meet one by one.
    Equal values give no pair, null values and empty forms none. Repeated ids
    give distinct pairs.
    """
    keys = ["field_name", "site", "form"]
    made = materialize(one_form_titles(entities).where("form <> ''").withColumn("writing", F.md5(F.concat_ws("\u0000", "field_name", "site", "value"))), "forms", n=F.lit(1))
    rows = made.select("field_name", "writing", "ent_id")
    writings = materialize(made.groupBy(*keys, "writing").agg(F.count(F.lit(1)).alias("n")), "writings")
    a, b = (writings.select(*keys, F.col("writing").alias(f"of_{x}"), F.col("n").alias(f"n_{x}")) for x in "ab")
    pairs = a.join(b, keys).where("of_a <> of_b and (n_a > n_b or n_a = n_b and of_a < of_b)")
    pairs = materialize(pairs.select("of_a", "of_b", F.ceil(F.col("n_a") / share).cast("int").alias("salts")), "alike")
    taking = pairs.select(F.explode(F.array("of_a", "of_b")).alias("writing")).distinct()
    rows = materialize(skew_lookup(rows, taking, ["writing"], "inner", rows=written_sums(made)["n"]), "taking", n=F.lit(1))
    total = written_sums(rows)["n"]

    def side(own: str, other: str) -> DataFrame:
        partners = pairs.groupBy(F.col(own).alias("writing")).agg(F.collect_list(F.struct(other, "salts")).alias("partners"))
        met = skew_lookup(rows, partners, ["writing"], "inner", rows=total).select("field_name", F.col("writing").alias(own), "ent_id", F.explode("partners").alias("p"))
        return met.select("field_name", own, f"p.{other}", "ent_id", "p.salts")

    left = side("of_a", "of_b").withColumn("salt", F.pmod(F.xxhash64("ent_id"), F.col("salts")).cast("int")).withColumnRenamed("ent_id", "id_a")
    right = side("of_b", "of_a").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).select("of_a", "of_b", "salt", F.col("ent_id").alias("id_b"))
    return left.join(right, ["of_a", "of_b", "salt"]).where("id_a <> id_b").select("field_name", F.least("id_a", "id_b").alias("ent_a"), F.greatest("id_a", "id_b").alias("ent_b")).distinct()


def form_groups(entities: DataFrame) -> DataFrame:
    """field_name, site, form, n_writings, n_rows of each form: the classes, without their pairs."""
    return one_form_titles(entities).groupBy("field_name", "site", "form").agg(F.countDistinct("value").alias("n_writings"), F.count(F.lit(1)).alias("n_rows"))
