"""P9: text decoded with the wrong character encoding, found and restored.

Three steps, each over all documents; the first two share one reading:

1. Near-twins. Clauses are cut at ASCII punctuation and joined on their text
   stripped of non-ASCII characters, with digits masked and, where there are
   many, as they are. Scripts that leave nothing but blanks meet on the lengths
   of the non-ASCII runs, as characters, as UTF-8 and as double bytes: what is
   read byte by byte has as many characters as its twin has bytes. Each key's
   most frequent clause is its twin; every other clause is compared with that
   one only, so a key of any size costs in proportion to its rows. Runs are
   aligned at their place in the stripped text, and each aligned pair votes
   for the encodings that turn the one into the other. The votes are the
   learned mappings.
2. A character model: hashed counts of one, two and three characters in
   arrays of fixed size, which every document feeds.
3. The learned mappings, and no others, are undone in every document, word by
   word; what decodes and reads better by the model is garbled, and its
   decoding is the restored text. Texts with replacement characters are a kind
   of their own, `lost characters`: they are found without any mapping.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tesserae.operators.skew import skew_lookup
from tesserae.session import materialize

# The encodings texts are written in and wrongly read in. Names
# ending in * read bytes that the encoding leaves open as control characters.
WRITTEN = ("utf-8", "cp1251", "koi8-r", "cp866", "iso8859-5", "mac-cyrillic", "cp1253", "iso8859-7", "cp932", "euc-jp", "gb18030", "big5", "euc-kr", "cp1256", "iso8859-6", "cp874", "cp1252", "cp850", "cp437", "mac-roman", "cp1250")
READ = ("cp1252*", "latin-1", "iso8859-15", "mac-roman", "cp437", "cp850", "cp1250*", "cp1251*", "koi8-r", "cp866", "cp1253*", "cp1254*", "cp932", "gb18030", "big5", "utf-8")
WESTERN = ("cp1252", "cp850", "cp437", "mac-roman", "cp1250")
MANY = ("cp932", "gb18030", "big5", "utf-8", "euc-jp", "euc-kr")

LETTERS = ("cp1251*", "koi8-r", "cp866", "cp1253*")

LOST = "�"
SIZES = (1 << 16, 1 << 17, 1 << 19)  # buckets for one, two and three characters
NON_ASCII = re.compile(r"[^\x00-\x7f]+")
DIGITS = re.compile("[0-9]+")
EAST = re.compile("[\u2e80-\U0010ffff]")
NO_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())
NO_DIGITS = bytes(b for b in range(128) if not chr(b).isdigit())
CLAUSE = re.compile(r"[.!?,;:]+[\x00-\x20]+|[\n\r]+")
# Pieces of a word: East Asian characters apart from the rest, without lost ones.
PIECE = re.compile(r"[⺀-鿿豈-﫿＀-￯]+|[^⺀-鿿豈-﫿＀-￯�]+")

_BLANKS = dict.fromkeys(map(ord, "\u00a0\u202f\u3000\u00ad"))
_CONTROLS = dict.fromkeys(range(0x80, 0xA1))

RESULT = "doc_id long, chain string, n_restored int, n_lost int, restorable boolean, restored string"


@lru_cache(maxsize=None)
def _table(codec: str) -> tuple[str, dict[int, int]]:
    """A one-byte encoding as a string of 256 characters, and its inverse."""
    name, sloppy = codec.rstrip("*"), codec.endswith("*")
    chars = []
    for b in range(256):
        try:
            chars.append(bytes([b]).decode(name))
        except UnicodeDecodeError:
            chars.append(chr(b) if sloppy else LOST)
    return "".join(chars), {ord(c): b for b, c in reversed(list(enumerate(chars))) if c != LOST}


def misread(text: str, written: str, read: str) -> str | None:
    """What text, written in one encoding, looks like when read in the other."""
    try:
        raw = text.encode(written)
    except UnicodeEncodeError:
        return None
    if read in MANY:
        return raw.decode(read, "replace")
    return raw.decode("latin-1").translate(_table(read)[0])


def to_bytes(text: str, read: str) -> bytes | None:
    """The bytes that read as text in the given encoding; None if there are none."""
    try:
        if read.endswith("*"):
            return text.translate(_table(read)[1]).encode("latin-1")
        return text.encode(read)
    except UnicodeEncodeError:
        return None


UTF8_SEQUENCE = re.compile("[\u00c2-\u00df][\u0080-\u00bf]|[\u00e0-\u00ef][\u0080-\u00bf]{2}|[\u00f0-\u00f4][\u0080-\u00bf]{3}")


@lru_cache(maxsize=None)
def _lead(read: str) -> re.Pattern:
    """A character that a one-byte encoding shows for the first byte of a UTF-8 sequence, and one for a later byte."""
    chars = _table(read)[0]
    return re.compile(f"[{re.escape(chars[0xC2:0xF5])}][{re.escape(chars[0x80:0xC0])}]")


def undo_utf8(text: str, read: str) -> str | None:
    """text with every UTF-8 sequence in it, read in the given encoding, decoded; None if there is none.

    Other characters stay, so a word may be garbled in part; not so where the
    encoding reads bytes as letters of words, which must decode as a whole.
    """
    if read in MANY or read in LETTERS:
        raw = to_bytes(text, read)
        try:
            return raw.decode("utf-8") if raw is not None and not raw.isascii() else None
        except UnicodeDecodeError:
            return None
    if not _lead(read).search(text):
        return None
    inverse = _table(read)[1]
    # characters outside the encoding move up, out of the bytes' way
    shown = "".join(chr(inverse[ord(c)]) if ord(c) in inverse else chr(ord(c) + 0x110000 // 2) if ord(c) < 0x80000 else c for c in text)

    def decode(m: re.Match) -> str:
        try:
            return "\x00" + m[0].encode("latin-1").decode("utf-8") + "\x00"
        except UnicodeDecodeError:
            return m[0]

    parts = UTF8_SEQUENCE.sub(decode, shown).split("\x00")
    if len(parts) == 1:
        return None
    chars = _table(read)[0]
    back = lambda c: chars[ord(c)] if ord(c) < 256 else chr(ord(c) - 0x110000 // 2) if ord(c) >= 0x110000 // 2 else c
    return "".join(x if i % 2 else "".join(map(back, x)) for i, x in enumerate(parts))


SEQUENCE = re.compile("[\x00-\x7f]|" + UTF8_SEQUENCE.pattern)
HEAD = re.compile("[\u0080-\u00bf]{0,3}")  # what a loss leaves of a sequence after it, and before it
TAIL = re.compile("(?:[\u00c2-\u00df]|[\u00e0-\u00ef][\u0080-\u00bf]?|[\u00f0-\u00f4][\u0080-\u00bf]{0,2})?")


def undo_beside_lost(part: str, read: str, left: bool, right: bool) -> list[tuple[int, int, str]]:
    """(start, end, decoded) of the stretches of part whose bytes, as read in the given encoding, are UTF-8.

    left and right tell at which ends of part a lost character stands: stray
    bytes there, of the character that lost some, go with the lost one.
    """
    own = to_bytes if read in MANY else lambda c, r: bytes([_table(r)[1][ord(c)]]) if ord(c) in _table(r)[1] else None
    each = [own(c, read) or b"\xff" for c in part]
    raw = b"".join(each).decode("latin-1")
    place, at = {0: 0}, 0  # of characters by bytes
    for i, b in enumerate(each):
        at += len(b)
        place[at] = i + 1
    runs: list[list[tuple[int, int]]] = []
    for m in SEQUENCE.finditer(raw):
        if not runs or runs[-1][-1][1] != m.start():
            runs.append([])
        runs[-1].append(m.span())
    if not runs and (left or right):
        head = HEAD.match(raw).end() if left else 0
        return [(0, len(part), "")] if raw and (TAIL.fullmatch(raw, head) if right else head == len(raw)) else []
    out = []
    for run in runs:
        head, tail = left and HEAD.fullmatch(raw, 0, run[0][0]), right and TAIL.fullmatch(raw, run[-1][1])
        while run and not head and run[0][0] not in place:
            run = run[1:]
        while run and not tail and run[-1][1] not in place:
            run = run[:-1]
        if run:
            start, end = run[0][0], run[-1][1]
            first, last = 0 if head else place[start], len(part) if tail else place[end]
            try:
                back = raw[start:end].encode("latin-1").decode("utf-8")
            except UnicodeDecodeError:  # surrogates and the like
                continue
            if back != part[first:last]:
                out.append((first, last, back))
    return out


def _cut(part: str, stretches: list[tuple[int, int, str]]) -> list[tuple[str, str]]:
    """What of part stands before each stretch, and the stretch decoded; at the end, what is left."""
    ends = [0, *(b for _, b, _ in stretches)]
    return [(part[at:a], t) for at, (a, _, t) in zip(ends, stretches)] + [(part[ends[-1] :], "")]


def _readable(text: str) -> bool:
    return text.translate(_BLANKS).isprintable()


def _learnable() -> list[tuple[str, str]]:
    return [(w, r) for w in WRITTEN for r in READ if w != r.rstrip("*") and not (w in MANY and r == "utf-8")]


# ---- step 1: near-twins -------------------------------------------------------


def _hash(key: str) -> int:
    return int.from_bytes(hashlib.blake2b(key.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _keys(clause: str) -> list[int]:
    """What twins share, as hashes: the stripped text, its digits masked or not, and the text with the lengths of its runs."""
    bare = NON_ASCII.sub("", clause)
    raw = bare.encode()
    out = []
    if len(raw.translate(None, NO_LETTERS)) >= 6:
        out.append("s" + DIGITS.sub("0", bare))
    if len(raw.translate(None, NO_DIGITS)) >= 6:
        out.append("d" + bare)
    runs = NON_ASCII.findall(clause)
    if sum(map(len, runs)) >= 8:
        masked = DIGITS.sub("0", clause)
        sizes = [len, lambda r: len(r.encode("utf-8", "replace")), lambda r: len(r) + len(EAST.findall(r))]
        out += dict.fromkeys("l" + NON_ASCII.sub(lambda m: f"\x01{size(m[0])}\x02", masked) for size in sizes)
    return [_hash(k) for k in out]


def _slices(parts: Iterator[pd.DataFrame], rows: int = 500) -> Iterator[pd.DataFrame]:
    """The same rows, fewer at a time: a worker's memory must not follow the batch size."""
    for part in parts:
        for i in range(0, len(part), rows):
            yield part.iloc[i : i + rows]


def _scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One reading of the texts: their clauses with keys and numbers, and the character model's counts, of the same size for any input."""
    sums = [np.zeros(n, np.int64) for n in SIZES]
    for part in parts:
        texts = part.column(0)
        for at in range(0, len(texts), 100):
            own = [t for t in texts.slice(at, 100).to_pylist() if t]
            _add(sums, own)
            seen: Counter[str] = Counter()
            for text in own:
                if not text.isascii():
                    seen.update(c for c in CLAUSE.split(text) if c and not c.isascii())
            rows = [(k, c, n) for c, n in seen.items() if (k := _keys(c))]
            columns = [pa.nulls(len(rows), pa.int64()), *(pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.list_(pa.int64()), pa.string(), pa.int64())))]
            yield pa.RecordBatch.from_arrays(columns, ["slot", "keys", "clause", "n"])
    for order, total in enumerate(sums):
        at = np.flatnonzero(total)
        columns = [pa.array(order << 20 | at), pa.nulls(len(at), pa.list_(pa.int64())), pa.nulls(len(at), pa.string()), pa.array(total[at])]
        yield pa.RecordBatch.from_arrays(columns, ["slot", "keys", "clause", "n"])


def scanned(docs: DataFrame) -> DataFrame:
    """slot, keys, clause, n: what the first two steps need of all documents, written once."""
    return materialize(docs.where("text is not null").select("text").mapInArrow(_scan, "slot long, keys array<long>, clause string, n long"), "scan")


def _aligned(clean: str, odd: str) -> list[tuple[str, str]]:
    """Runs of non-ASCII characters at the same place of the stripped texts.

    Where characters are lost, only runs that hold others enough tell a mapping.
    """

    def places(s: str) -> dict[int, str]:
        out, shift = {}, 0
        for m in NON_ASCII.finditer(s):
            out[m.start() - shift] = m[0]
            shift += len(m[0])
        return out

    a, b = places(DIGITS.sub("0", clean)), places(DIGITS.sub("0", odd))
    return [(run, b[at]) for at, run in a.items() if at in b and b[at] != run and LOST not in run and (LOST not in b[at] or sum(c != LOST for c in b[at]) >= 8)]


class _Fits:
    """Which mappings turn one run into another; most are ruled out by the first characters."""

    def __init__(self) -> None:
        self.chains = _learnable()
        self.narrow = [i for i, (_, r) in enumerate(self.chains) if r not in MANY]
        self.wide = [i for i, (_, r) in enumerate(self.chains) if r in MANY]
        self.firsts: dict[str, dict[str, list[int]]] = {}
        self.known: dict[tuple[str, str], tuple[int, ...]] = {}

    def _shown(self, char: str) -> dict[str, list[int]]:
        """The mappings that show a character by each first character."""
        if char not in self.firsts:
            own = self.firsts[char] = {}
            for i in self.narrow:
                if m := misread(char, *self.chains[i]):
                    own.setdefault(m[0], []).append(i)
        return self.firsts[char]

    def __call__(self, clean: str, odd: str) -> tuple[int, ...]:
        got = self.known.get((clean, odd))
        if got is None:
            # one-byte encodings show a character's bytes one by one, so the first must agree
            narrow = self.narrow if odd[0] == LOST else self._shown(clean[0]).get(odd[0], [])
            maybe = narrow + (self.wide if any(c > "\u2e7f" for c in odd) else [])
            got = tuple(i for i in maybe if (made := misread(clean, *self.chains[i])) == odd or LOST in odd and made and len(made) == len(odd) and all(b in (a, LOST) for a, b in zip(made, odd)))
            if len(self.known) > 50_000:
                self.known.clear()
            if len(clean) + len(odd) <= 1000:  # memory must not follow the length of paragraphs
                self.known[(clean, odd)] = got
        return got


def _vote(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    fits = _Fits()
    chains = fits.chains
    for part in _slices(parts):
        rows = []
        for twin, clause in zip(part["twin"], part["clause"]):
            for clean, odd in ((twin, clause), (clause, twin)):  # of twins equally frequent either may be the clean one
                pairs = _aligned(clean, odd)
                common: set[int] | None = None
                for a, b in pairs:  # one mapping must explain a clause's pairs
                    got = {i for i in fits(a, b) if chains[i][0] == "utf-8" or not _shows_utf8(a)}
                    common = got if common is None else common & got
                    if not common:
                        break
                if common:
                    a, b = max(pairs, key=lambda p: len(p[0]))
                    rows.append((",".join(map(str, sorted(common))), a, b))
        yield pd.DataFrame(rows, columns=["mappings", "clean", "odd"])


def _shows_utf8(run: str) -> bool:
    """Whether a run shows UTF-8 sequences itself, so is no clean twin."""
    return any(_lead(r).search(run) for r in READ if r not in MANY and r not in LETTERS)


def learned_mappings(scan: DataFrame, least: int = 2) -> list[tuple[str, str, int]]:
    """(written, was_read, pairs) of the mappings that explain the aligned runs of `scanned` texts.

    Distinct pairs of runs are counted by the set of mappings that explain
    them; the mapping that explains most is taken, then the one that explains
    most of what is left, until none explains `least` pairs more. So of
    encodings that agree on the letters seen only one is learned. Keys meet by
    the hashes of clauses; texts are fetched for twins only. What comes to the
    driver is one number for each set of mappings that agree.
    """
    clauses = scan.where("clause is not null").groupBy("clause").agg(F.sum("n").alias("n"), F.first("keys").alias("keys"))
    clauses = materialize(clauses.withColumn("cid", F.xxhash64("clause")), "clauses")
    keyed = clauses.select("cid", "n", F.explode("keys").alias("key"))
    twin = keyed.groupBy("key").agg(F.max(F.struct("n", "cid")).alias("top"), F.count(F.lit(1)).alias("ways")).where("ways > 1").select("key", F.col("top.cid").alias("twin_id"))
    pairs = skew_lookup(keyed.select("cid", "key"), twin, ["key"], "inner").where("cid <> twin_id").select("cid", "twin_id").distinct()
    pairs = materialize(pairs.join(clauses.select("cid", "clause"), "cid"), "pairs")
    pairs = skew_lookup(pairs, clauses.select(F.col("cid").alias("twin_id"), F.col("clause").alias("twin")), ["twin_id"], "inner")
    votes = pairs.select("twin", "clause").mapInPandas(_vote, "mappings string, clean string, odd string").distinct().groupBy("mappings").agg(F.count(F.lit(1)).alias("n")).collect()
    chains = _learnable()
    left = [({int(i) for i in r["mappings"].split(",")}, r["n"]) for r in votes]
    out = []
    while left:
        score: Counter[int] = Counter()
        for own, n in left:
            for i in own:
                score[i] += n
        best = min(score, key=lambda i: (-score[i], i))
        if score[best] < least:
            break
        out.append((*chains[best], score[best]))
        left = [(own, n) for own, n in left if best not in own]
    return out


# ---- step 2: the character model --------------------------------------------


def _hashed(cps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of each character alone, with one and with two before it."""
    c = cps.astype(np.uint64)
    c = np.where((c >= 48) & (c <= 57), np.uint64(48), c)
    one = np.zeros(len(c) + 2, np.uint64) + np.uint64(32)
    one[2:] = c
    mix = lambda x: (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    two = mix(one[1:-1] * np.uint64(1 << 21) + one[2:])
    three = mix((one[:-2] * np.uint64(1 << 21) + one[1:-1]) * np.uint64(0x2545F4914F6CDD1D) + one[2:])
    return (c % np.uint64(SIZES[0])).astype(np.int64), (two % np.uint64(SIZES[1])).astype(np.int64), (three % np.uint64(SIZES[2])).astype(np.int64)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _add(sums: list[np.ndarray], texts: list[str]) -> None:
    text = re.sub(r"[\x00-\x20]+", " ", "  ".join(texts))
    for i in range(0, len(text), 200_000):
        for total, h in zip(sums, _hashed(_points(text[i : i + 200_000]))):
            np.add.at(total, h, 1)


class Model:
    """Log-probabilities of characters given the two before them."""

    def __init__(self, slots: np.ndarray, counts: np.ndarray) -> None:
        order = slots >> 20
        arrays = []
        for i, size in enumerate(SIZES):
            a = np.zeros(size, np.float32)
            own = order == i
            a[slots[own] & ((1 << 20) - 1)] = counts[own]
            arrays.append(a)
        self.one, self.two, self.three = arrays
        self.total = float(self.one.sum())

    def scores(self, texts: list[str], joint: bool = False) -> np.ndarray:
        """The log-probability of each text as a word, with a blank at its end.

        joint: the log-frequency of its threes of characters instead, which
        compares texts of equal length only, but is not misled by threes that
        occur in garbled text alone and there follow from each other.
        """
        if not texts:
            return np.empty(0)
        if len(texts) > 2000:
            return np.concatenate([self.scores(texts[i : i + 2000], joint) for i in range(0, len(texts), 2000)])
        joined = "".join(f" {t} " for t in texts)
        cps = _points(joined)
        h1, h2, h3 = _hashed(cps)
        n1, n2, n3 = self.one[h1], self.two[h2], self.three[h3]
        before1 = np.concatenate([[1.0], n1[:-1]])
        before2 = np.concatenate([[1.0], n2[:-1]])
        n2 = np.minimum(n2, n1)  # against characters that share a bucket
        before2[1:] = n2[:-1]
        n3 = np.minimum(np.minimum(n3, n2), before2)
        lengths = np.array([len(t) + 2 for t in texts])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        first = starts + 1
        if joint:
            logs = np.log((n3 + 0.5) / (self.total + 100))
            logs[first] = np.log((n2[first] + 0.5) / (self.total + 100))
        else:
            p = 0.75 * np.minimum(n3 / (before2 + 2), 1) + 0.2 * np.minimum(n2 / (before1 + 5), 1) + 0.05 * (n1 + 0.01) / (self.total + 100)
            # what stood before the blank is not known, so a word's first character has the blank before it only
            p[first] = 0.95 * np.minimum(n2[first] / (before1[first] + 5), 1) + 0.05 * (n1[first] + 0.01) / (self.total + 100)
            logs = np.log(p)
        logs[starts] = 0
        return np.add.reduceat(logs, starts)


def character_model(scan: DataFrame) -> Model:
    """Counted over all `scanned` documents; what comes to the driver is at most one number a bucket."""
    counts = scan.where("slot is not null").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    return Model(counts["slot"].to_numpy(), counts["n"].to_numpy())


# ---- step 3: undoing the mappings ---------------------------------------------


def _case_breaks(word: str) -> int:
    """Small letters before capitals, and whether all letters are capitals."""
    letters = [c for c in word if c.isalpha()]
    return sum(a.islower() and b.isupper() for a, b in zip(word, word[1:])) + (len(letters) > 3 and all(c.isupper() for c in letters))


class Undo:
    """Finds and restores garbled words; learned: the mappings that twins have shown."""

    def __init__(self, model: Model, learned: set[tuple[str, str]]) -> None:
        self.model, self.learned = model, learned
        by_read: dict[str, list[str]] = defaultdict(list)
        for w, r in _learnable():
            if r != "utf-8" and (w, r) in learned:
                by_read[r].append(w)
        self.by_read = dict(by_read)
        self.utf8_reads = [r for r in by_read if "utf-8" in by_read[r] and r not in MANY]
        self.whole_reads = [r for r in by_read if "utf-8" in by_read[r] and (r in MANY or r in LETTERS)]
        self.known: dict[str, tuple[str, str, float, float] | None] = {}

    @staticmethod
    def _needed(written: str) -> float:
        """The gain in log-probability that tells a garbled word from a rare one; bytes that form UTF-8 by chance are rare."""
        return 0.7 if written == "utf-8" else 6.5

    def pieces(self, words: list[str]) -> dict[str, tuple[str, str, float, float]]:
        """word -> (restored, chain, gain over what is needed, gain), for those that read better."""
        texts, owner, how = [], [], []

        def offer(back: str | None, word: str, written: str, read: str, chain: str) -> bool:
            if not back or back == word or LOST in back or not _readable(back):
                return False
            texts.append(back)
            owner.append(word)
            how.append((written, read, chain))
            return True

        for w in words:
            for read, writers in self.by_read.items():
                raw = None
                for written in writers:
                    chain = f"{written} read as {read}"
                    if written == "utf-8":
                        back = undo_utf8(w, read)
                        # what was garbled twice shows between the steps as garbled once
                        if back and not back.isascii() and (offer(back, w, written, read, chain) or back.translate(_CONTROLS).isprintable()):
                            for again in self.utf8_reads:
                                offer(undo_utf8(back, again), w, written, read, f"{chain}, {written} read as {again}")
                        else:
                            offer(back, w, written, read, chain)
                        continue
                    raw = to_bytes(w, read) if raw is None else raw
                    if raw is None or raw.isascii():
                        break
                    try:
                        offer(raw.decode(written), w, written, read, chain)
                    except UnicodeDecodeError:
                        continue
        if not texts:
            return {}
        place = {w: i for i, w in enumerate(words)}
        at = np.array([place[w] for w in owner])
        own, size = self.model.scores(words)[at], np.array([len(t) for t in texts])
        new, own_size = self.model.scores(texts), np.array([len(w) for w in words])[at]
        raw = new - own
        one_byte = np.array([h[0] != "utf-8" for h in how]) & (size == own_size)
        if one_byte.any():
            joint = self.model.scores(words, True)[at][one_byte]
            raw[one_byte] = (raw[one_byte] + self.model.scores([texts[i] for i in np.flatnonzero(one_byte)], True) - joint) / 2
        best: dict[str, tuple[str, str, float, float]] = {}
        for i in np.flatnonzero(raw > 0.5):
            t, w, (written, read, chain) = texts[i], owner[i], how[i]
            legacy = written in MANY and written != "utf-8"
            if legacy and new[i] / (len(t) + 1) <= own[i] / (len(w) + 1):
                continue  # fewer characters only; each must read better as well
            if written != "utf-8" and _case_breaks(t) > _case_breaks(w):
                continue  # encodings that swap the cases make such words; undoing doesn't
            gain = float(raw[i]) - self._needed(written)
            if written != "utf-8" and sum(a != b for a, b in zip(t, w)) < 3 or legacy and len(t) < 4:
                gain = min(gain, -1.0)  # too short to tell from a rare letter, but restored where its document is garbled so
            if w not in best or gain > best[w][2]:
                best[w] = (t, chain, gain, float(raw[i]))
        return best

    def forget(self, words: set[str]) -> None:
        """Bound the memory of words met; words: those of the documents still to be judged, which are kept."""
        if len(self.known) > 100_000:
            self.known = {w: self.known[w] for w in words if w in self.known}

    def learn(self, words: set[str]) -> None:
        """Judge the words not met before."""
        new = [w for w in words if w not in self.known]
        for i in range(0, len(new), 2000):
            some = new[i : i + 2000]
            got = self.pieces(some)
            self.known.update((w, got.get(w)) for w in some)

    def _agrees(self, text: str, chain: tuple[str, str]) -> bool:
        """Whether the words of some clause, taken together, read much better with the mapping undone."""
        written, read = chain
        for clause in CLAUSE.split(text):
            before, after = [], []
            for p in PIECE.findall(clause):
                for w in p.split():
                    if w.isascii():
                        continue
                    try:
                        raw = to_bytes(w, read)
                        back = undo_utf8(w, read) if written == "utf-8" else raw.decode(written) if raw else None
                    except UnicodeDecodeError:
                        back = None
                    if back:
                        before.append(w)
                        after.append(back)
            if before and sum(float((self.model.scores(after, j) - self.model.scores(before, j)).sum()) for j in ((False, True) if written != "utf-8" else (False, False))) >= 32:
                return True
        return False

    def beside_lost(self, words: list[str]) -> tuple[str, dict[tuple[str, int], list[tuple[int, int, str]]]]:
        """The encoding in which a text's words with losses were read, and the stretches of their parts to undo.

        Only for encodings whose bytes must decode as a whole: there a loss
        leaves parts that begin and end within a UTF-8 sequence.
        """
        best, found, most = "", {}, 0.0
        for read in self.whole_reads:
            spans = []
            for w in words:
                parts = w.split(LOST)
                for i, p in enumerate(parts):
                    spans += [(w, i, p[a:b], a, b, t) for a, b, t in undo_beside_lost(p, read, i > 0, i + 1 < len(parts)) if LOST not in t and _readable(t)]
            told = [x for x in spans if not x[5].isascii()]
            if not told:
                continue
            gain = self.model.scores([x[5] for x in told]) - self.model.scores([x[2] for x in told])
            need = self._needed("utf-8")
            if gain.max() > need and (total := float(gain[gain > need].sum())) > most:
                best, found, most = read, defaultdict(list), total
                for (w, i, _, a, b, t), g in zip(told, gain):
                    # bytes that form two long sequences by chance hardly occur
                    if g > 0.5 or sum(c > "\u07ff" for c in t) >= 2:
                        found[w, i].append((a, b, t))
                undone = set(found)
                for w, i, _, a, b, t in spans:  # stray bytes with ASCII or nothing else: only beside what was undone
                    if t.isascii() and (w, i) not in undone and any((w, k) in undone for k in range(i - 3, i + 4)):
                        found[w, i].append((a, b, t))
        return best, dict(found)

    def __call__(self, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        word = re.compile(r"[^\x00-\x20]*[^\x00-\x7f][^\x00-\x20]*")
        for part in _slices(parts):
            split = [[p for w in word.findall(t) for p in PIECE.findall(w) if not p.isascii()] if t and not t.isascii() else [] for t in part["text"]]
            words_here = {p for ps in split for p in ps}
            self.forget(words_here)  # between slices only: a slice's later documents need its words
            self.learn(words_here)
            out = []
            for doc, text, ps in zip(part["doc_id"], part["text"], split):
                if not ps and not (text and LOST in text):
                    continue
                lost = text.count(LOST)
                words = word.findall(text) if lost else []
                read, beside = self.beside_lost([w for w in words if LOST in w])
                if beside:  # what is undone there isn't judged by its pieces
                    ps = [p for w in words for i, part in enumerate(w.split(LOST)) for shown, _ in _cut(part, beside.get((w, i), [])) for p in PIECE.findall(shown) if not p.isascii()]
                    self.learn(set(ps))
                sums: Counter[str] = Counter()
                for p in ps:
                    if k := self.known[p]:
                        sums[k[1].split(",")[0]] += k[3]
                # many small gains by one mapping tell as much as a large one, if a whole clause agrees
                spread = {c for c, g in sums.items() if g >= 16 and self._agrees(text, tuple(c.split(" read as ")))}
                chains = {k[1] for p in ps if (k := self.known[p]) and (k[2] > 0 or k[1].split(",")[0] in spread)}
                if read:
                    chains.add(f"utf-8 read as {read}")
                if not chains and not lost:
                    continue
                first = {c.split(",")[0] for c in chains}
                n = 0

                def restore(m: re.Match) -> str:
                    nonlocal n
                    k = self.known.get(m[0])
                    # in a document with a known fault, smaller gains count as well
                    if k and (k[2] > 0 or k[1].split(",")[0] in first):
                        n += 1
                        return k[0]
                    return m[0]

                def restore_word(m: re.Match) -> str:
                    nonlocal n
                    done = []
                    for i, part in enumerate(m[0].split(LOST)):
                        own = beside.get((m[0], i), [])
                        n += sum(t != "" for _, _, t in own)
                        done.append("".join(PIECE.sub(restore, shown) + back for shown, back in _cut(part, own)))
                    return LOST.join(done)

                done = word.sub(restore_word, text)
                out.append((doc, "; ".join(sorted(chains)) or "lost characters", n, lost, not lost, done))
            yield pd.DataFrame(out, columns=["doc_id", "chain", "n_restored", "n_lost", "restorable", "restored"]).astype({"doc_id": "Int64", "restorable": bool})


def restore(docs: DataFrame, least: int = 2) -> DataFrame:
    """doc_id, chain, n_restored, n_lost, restorable, restored of each garbled document.

    Text with replacement characters has lost what stood there; the rest of
    it is restored all the same and restorable is false. A character of which
    a part was lost shows as the replacement character alone. Null, empty and
    ASCII texts are never garbled; repeated rows are judged alike; an empty
    table gives no rows. Other columns than doc_id and text are not read.
    """
    docs = docs.select("doc_id", "text")
    scan = scanned(docs)
    learned = {(w, r) for w, r, _ in learned_mappings(scan, least)}
    undo = Undo(character_model(scan), learned)
    shared = docs.sparkSession.sparkContext.broadcast(undo)
    return docs.where("text is not null").mapInPandas(lambda parts: shared.value(parts), RESULT)


def garbled_documents(docs: DataFrame) -> DataFrame:
    return restore(docs).select("doc_id").distinct()
