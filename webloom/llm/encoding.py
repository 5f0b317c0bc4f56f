"""Problem 2: text that was decoded with the wrong character table.

Three steps.  Adjacent character pairs are counted over the whole corpus (pre-aggregated in each
batch).  In every text, maximum-scoring segments of improbable pairs are isolated.  Only inside
those segments inverse mappings are tried: text is encoded with a table it may have been misread
through and decoded with the one it may have been written in, and the mapping is kept when the
restored characters are far more probable than the ones that stand there.

The pair score is pointwise mutual information, from the joint counts and the two marginals of the
pair table.  Marginals are floored at COMMON_CHARACTER: bare mutual information is high inside garbled
runs, whose characters are rare and occur only beside each other, and with the floor a rare character
is no excuse for a rare pair.  A pair below 0, rarer than chance, is improbable.  Whether a mapping is
kept is a second test, on the joint log probability of what stands there and of what it becomes.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.arrow import map_rows, text_column

#: Alphabet: Latin to Cyrillic, general punctuation to symbols, and 64 classes for all the rest.
LOW, SYMBOLS_FROM, SYMBOLS_TO, REST = 0x530, 0x2000, 0x2700, 64
SIZE = LOW + (SYMBOLS_TO - SYMBOLS_FROM) + REST
#: Floor of the marginals: no character counts as rarer than this share.
COMMON_CHARACTER = 0.0245
BRIDGE = -0.4
#: Hashes of texts that a task holds to count each text once.
KNOWN_TEXTS = 500_000
#: Least gain in mean log probability that makes a mapping believable.
GAIN = 1.5

#: Tables through which UTF-8 is misread, and pairs (misread as, written in) of one-byte tables.
UTF8_READ_AS = ["cp1252", "latin-1", "cp850", "cp437", "mac_roman", "cp1251", "koi8_r", "cp866", "cp1250", "iso8859_15", "cp1254", "iso8859_5"]
ONE_BYTE = [
    ("cp866", "cp1251"), ("koi8_r", "cp1251"), ("cp1252", "cp1251"), ("latin-1", "cp1251"), ("mac_roman", "cp1251"), ("cp850", "cp1251"),
    ("cp1251", "koi8_r"), ("cp866", "koi8_r"), ("cp1252", "koi8_r"), ("latin-1", "koi8_r"), ("mac_roman", "koi8_r"),
    ("cp1251", "cp866"), ("koi8_r", "cp866"), ("cp1252", "cp866"), ("latin-1", "cp866"),
    ("cp1251", "iso8859_5"), ("cp1252", "iso8859_5"), ("latin-1", "iso8859_5"), ("iso8859_5", "cp1251"), ("iso8859_5", "koi8_r"),
    ("cp1251", "mac_cyrillic"), ("mac_cyrillic", "cp1251"),
    ("cp850", "cp1252"), ("cp437", "cp1252"), ("mac_roman", "cp1252"), ("cp1251", "cp1252"), ("koi8_r", "cp1252"), ("cp866", "cp1252"), ("cp1250", "cp1252"), ("iso8859_5", "cp1252"),
    ("cp1252", "cp850"), ("latin-1", "cp850"), ("cp1252", "mac_roman"), ("latin-1", "mac_roman"), ("cp1252", "cp437"),
]
CYRILLIC = {"cp1251", "koi8_r", "cp866", "iso8859_5"}
CONTROL = re.compile("[\x80-\x9f]")
#: A capital after a small letter inside one word: not what a right reading looks like.
HUMP = re.compile("[a-zà-öø-ÿа-яё][A-ZÀ-ÖØ-ÞА-ЯЁ]")
BEYOND = re.compile("[^\x00-\x7f]")
PIECE = re.compile("[^\n>]*[\n>]|[^\n>]+$")
#: Long pieces are taken for UTF-8 only if so many characters at their head are: the whole is not where its head is not.
PROBE = 60
QUOTES = "“”\"'‘’«»„‹›"


@lru_cache(1)
def _alphabet() -> np.ndarray:
    codes = np.arange(0x110000)
    out = np.where(codes < LOW, codes, SIZE - REST + (codes >> 4) % REST)
    mid = (codes >= SYMBOLS_FROM) & (codes < SYMBOLS_TO)
    return np.where(mid, LOW + codes - SYMBOLS_FROM, out).astype(np.int64)


def symbols(codes: np.ndarray) -> np.ndarray:
    """Code points as numbers of the fixed alphabet."""
    return _alphabet()[codes]


def code_points(text: str) -> np.ndarray:
    """Code points of the text in lower case, one for each character, so that capitals are no rarer than small letters."""
    lowered = text.lower()
    if len(lowered) != len(text):
        lowered = "".join(low if len(low := c.lower()) == 1 else c for c in text)
    return np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


@lru_cache(100_000)
def _readings(run: str) -> tuple[tuple[str, str], ...]:
    """(table, text): what a whole run says when it is UTF-8 misread through a listed table."""
    out = []
    for table in UTF8_READ_AS:
        raw = _encode(run, table)
        try:
            made = raw.decode("utf-8") if raw is not None else run
        except UnicodeDecodeError:
            continue
        if len(made) < len(run):
            out.append((table, made))
    return tuple(out)


@lru_cache(1)
def _run_pattern() -> re.Pattern:
    """Whole runs beyond ASCII that begin as misread UTF-8 does."""
    kinds = [{c for table in UTF8_READ_AS for b in codes if (c := bytes([b]).decode(table, "ignore") or chr(b)) > "\x7f"} for codes in (range(0xC2, 0xF5), range(0x80, 0xC0))]
    lead, rest = ("".join(map(re.escape, sorted(k))) for k in kinds)
    return re.compile(f"(?<![^\x00-\x7f])[{lead}][{rest}][^\x00-\x7f]*")


def _spans(text: str, chosen) -> np.ndarray:
    """Marks the characters of the runs that can be misread UTF-8 and that ``chosen`` (before, run, after) takes."""
    marks = np.zeros(len(text), bool)
    for m in _run_pattern().finditer(text):
        a, b = m.span()
        if _readings(m.group()) and chosen(text[a - 1 : a] if a else "", m.group(), text[b : b + 1]):
            marks[a:b] = True
    return marks


def pair_counts(texts: DataFrame, model: PairModel | None = None) -> DataFrame:
    """(pair long, n long): counts over all texts of a one-column frame, each distinct text once in a task.

    Runs that can be misread UTF-8 are left out, so damaged text is no measure of what is normal, however
    much of it there is.  With a model of the rest, the pairs of those runs that it finds rightly read are
    counted, and no others.  At most SIZE squared pairs exist whatever the corpus, and only those with a
    character beyond ASCII are counted; each batch sends its distinct pairs once.
    """
    shared = texts.sparkSession.sparkContext.broadcast((model.keys, model.counts)) if model else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        garbled = lru_cache(100_000)(Restorer(PairModel(*shared.value)).garbled) if shared else None
        known: set[int] = set()
        for batch in batches:
            total: dict[int, int] = {}
            held, size = [], 0
            values = batch.column(0).to_pylist()
            for i, text in enumerate(values):
                if text and not text.isascii() and (h := hash(text)) not in known:
                    if len(known) >= KNOWN_TEXTS:
                        known.clear()
                    known.add(h)
                    held.append(text)
                    size += len(text)
                if held and (size > 1_000_000 or i + 1 == len(values)):
                    joined = "\n".join(held)
                    codes = symbols(code_points(joined))
                    at = np.flatnonzero(codes > 127)
                    left = np.unique(np.concatenate([at - 1, at]))
                    left = left[(left >= 0) & (left + 1 < len(codes))]
                    if garbled:
                        marks = _spans(joined, lambda *around: not garbled(*around))
                        left = left[marks[left] | marks[left + 1]]
                    else:
                        marks = _spans(joined, lambda *around: True)
                        left = left[~(marks[left] | marks[left + 1])]
                    keys, n = np.unique(codes[left] * SIZE + codes[left + 1], return_counts=True)
                    for k, c in zip(keys.tolist(), n.tolist()):
                        total[k] = total.get(k, 0) + c
                    held, size = [], 0
            yield pa.RecordBatch.from_pydict({"pair": pa.array(list(total), pa.int64()), "n": pa.array(list(total.values()), pa.int64())})

    return texts.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


class PairModel:
    """Joint counts of adjacent pairs and the marginals of their left and right characters; unseen pairs count as half an occurrence."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order].astype(np.float64)
        self.total = max(1.0, float(self.counts.sum()))
        self.left, self.right = (np.log(np.maximum(np.bincount(side, self.counts, SIZE) / self.total, COMMON_CHARACTER)) for side in np.divmod(self.keys, SIZE))

    def information(self) -> np.ndarray:
        """Pointwise mutual information of the pairs of the table."""
        a, b = np.divmod(self.keys, SIZE)
        return np.log(self.counts / self.total) - self.left[a] - self.right[b]

    def _pack(self) -> tuple[dict[int, float], float]:
        return dict(zip(self.keys.tolist(), np.log(self.counts / self.total).tolist())), math.log(0.5 / self.total)


def fit_pairs(texts: DataFrame) -> PairModel:
    """Collects the bounded pair table (never more than SIZE squared rows): first without the runs that can be misread, then with those that are not."""
    table = pair_counts(texts).toArrow()
    first = PairModel(table["pair"].to_numpy(), table["n"].to_numpy())
    more = pair_counts(texts, first).toArrow()
    keys, place = np.unique(np.concatenate([first.keys, more["pair"].to_numpy()]), return_inverse=True)
    return PairModel(keys, np.bincount(place, np.concatenate([first.counts, more["n"].to_numpy()]), len(keys)))


def _encode(text: str, table: str) -> bytes | None:
    """Bytes of text in a table; the five unassigned places of cp1252 pass as control characters."""
    try:
        return text.encode(table)
    except UnicodeError:
        if table not in ("cp1252", "cp1251", "cp1250", "cp1254"):
            return None
    out = bytearray()
    for c in text:
        try:
            out += c.encode(table)
        except UnicodeError:
            if not 0x80 <= ord(c) <= 0x9F:
                return None
            out.append(ord(c))
    return bytes(out)


def _starts_utf8(raw: bytes | None) -> bool:
    """Whether bytes are UTF-8 up to a character cut off at their end."""
    if raw is None:
        return False
    try:
        raw.decode("utf-8")
    except UnicodeDecodeError as error:
        return error.start >= len(raw) - 3
    return True


class Restorer:
    def __init__(self, model: PairModel):
        self.logp, self.floor = model._pack()
        self.left, self.right = model.left, model.right
        #: What a text without such pairs counts as, so that a restored piece of pure ASCII can be compared.
        self.limit = max(2 * math.log(COMMON_CHARACTER), self.floor + 1e-9)
        likely = model.keys[model.information() >= 0]
        self.common = likely if len(likely) else np.array([-1], np.int64)
        self.fix = lru_cache(100_000)(self._fix)
        self.line = lru_cache(20_000)(self._line)

    def pairs(self, text: str) -> tuple[list[int], list[float]]:
        """Places and mutual information of the adjacent pairs with a character beyond ASCII."""
        codes = symbols(code_points(text))
        left, right = codes[:-1], codes[1:]
        get, floor = self.logp.get, self.floor
        at = np.flatnonzero((left > 127) | (right > 127))
        left, right = left[at], right[at]
        joint = np.array([get(key, floor) for key in (left * SIZE + right).tolist()])
        return at.tolist(), (joint - self.left[left] - self.right[right]).tolist()

    def mean(self, text: str) -> float:
        codes = symbols(code_points(text))
        left, right = codes[:-1], codes[1:]
        at = np.flatnonzero((left > 127) | (right > 127))
        if not len(at):
            return self.limit
        get, floor = self.logp.get, self.floor
        return sum(get(k, floor) for k in (left[at] * SIZE + right[at]).tolist()) / len(at)

    def segments(self, text: str) -> list[tuple[int, int]]:
        """Maximum-scoring segments (all of them, by the linear-time method) as character ranges."""
        places, found = self.pairs(text)
        if not found or min(found) >= 0:
            return []
        stack: list[list[float]] = []  # start, end, sum before, sum after
        total, past = 0.0, -1
        for i, p in zip(places, found):
            total += BRIDGE * (i - past - 1)  # the ASCII pairs in between
            past = i
            s = max(-3.0, min(3.0, -p))
            if s <= 0:
                total += s
                continue
            part = [i, i + 1, total, total + s]
            total += s
            while True:
                j = len(stack) - 1
                while j >= 0 and stack[j][2] >= part[2]:
                    j -= 1
                if j < 0 or stack[j][3] >= part[3]:
                    stack.append(part)
                    break
                part = [stack[j][0], part[1], stack[j][2], part[3]]
                del stack[j:]
        out: list[tuple[int, int]] = []
        for a, b, *_ in stack:
            a, b = int(a), int(b) + 1
            while a < b and ord(text[a]) < 128:
                a += 1
            while b > a and ord(text[b - 1]) < 128:
                b -= 1
            while a and ord(text[a - 1]) > 127:
                a -= 1
            while b < len(text) and ord(text[b]) > 127:
                b += 1
            if out and a - out[-1][1] <= 1:
                out[-1] = (out[-1][0], b)
            elif b > a:
                out.append((a, b))
        return out

    def garbled(self, before: str, run: str, after: str) -> bool:
        """Whether a run that can be misread UTF-8 is.

        Three characters or more do not decode by chance, but for Cyrillic words that make three-byte ones;
        the others must read better than what stands there, which counts as seen.
        """
        readings = _readings(run)
        if any(len(made) >= 3 and (table not in CYRILLIC or max(made) < "\u0800") for table, made in readings):
            return True
        now = max(self.mean(before + run + after), self.floor + math.log(2))
        return any(self.mean(before + made + after) + 2.0 > now + GAIN for _, made in readings)

    def _fix(self, before: str, piece: str, after: str) -> str | None:
        """The restored piece, or None where no mapping is believable."""
        now, text = self.mean(before + piece + after), None
        best = now + GAIN
        for table in UTF8_READ_AS:
            if len(piece) > 2 * PROBE and not _starts_utf8(_encode(piece[:PROBE], table)):
                continue
            raw = _encode(piece, table)
            if raw is None:
                continue
            try:
                made = raw.decode("utf-8")
            except UnicodeDecodeError:
                continue
            if made != piece and len(made) < len(piece):
                deeper = self._fix(before, made, after) if not made.isascii() else None
                made = deeper or made
                score = self.mean(before + made + after) + 2.0  # valid UTF-8 by chance is rare
                if score > best:
                    best, text = score, made
        if text is None and len(BEYOND.findall(piece)) >= 2:
            characters = "".join(set(piece))  # one-byte tables map each by itself
            for read, written in ONE_BYTE:
                raw = _encode(characters, read)
                try:
                    mapped = raw.decode(written) if raw is not None else characters
                except UnicodeDecodeError:
                    continue
                if mapped == characters or CONTROL.search(mapped):
                    continue
                made = piece.translate(str.maketrans(characters, mapped))
                if HUMP.search(made):
                    continue
                if (score := self.mean(before + made + after)) > best:
                    best, text = score, made
        return text

    def _line(self, text: str) -> tuple[str, int, int]:
        """(restored line, pieces restored, pieces that cannot be restored)."""
        if text.isascii():
            return text, 0, 0
        fixed = lost = at = 0
        out: list[str] = []
        for a, b in self.segments(text):
            if a < at:
                continue
            piece = text[a:b]
            made = self.fix(text[a - 1 : a] if a else "", piece, text[b : b + 1])
            if made is None:
                for part in re.finditer(r"[^\x00-\x7f]+", piece):
                    x, y = a + part.start(), a + part.end()
                    made = self.fix(text[x - 1 : x] if x else "", part.group(), text[y : y + 1])
                    if made is not None and not self.quoted(text, x, y):
                        out += [text[at:x], made]
                        at, fixed = y, fixed + 1
                continue
            if self.quoted(text, a, b):
                continue
            out += [text[at:a], made]
            at, fixed = b, fixed + 1
        out.append(text[at:])
        made = "".join(out)
        lost += len(re.findall(r"(?<![“\"'])�+|�+(?![”\"'])", made)) + len(re.findall(r"[\x80-\x84\x86-\x9f]+", made))
        return made, fixed, lost

    @staticmethod
    def quoted(text: str, a: int, b: int) -> bool:
        """A few garbled characters alone between quotes are quoted, not read wrongly."""
        piece = text[a:b]
        core = piece.strip(QUOTES)
        left = piece[:1] in QUOTES and len(core) < len(piece) or (a and text[a - 1] in QUOTES)
        right = piece[-1:] in QUOTES and len(core) < len(piece) or text[b : b + 1] in tuple(QUOTES)
        opened, closed = text.rfind("“", 0, b), text.find("”", a)
        alone = 0 <= opened < closed and closed - opened <= 6 and " " not in text[opened:closed]
        return bool(alone or (left and right and len(core) <= 4))

    def text(self, value: str) -> tuple[str, int, int]:
        """Whole text, piece by piece: pieces end at line ends and tags, and repeated ones are looked up.

        Only pieces with an improbable pair can hold a positive segment; the others pass unread.
        """
        codes = symbols(code_points(value))
        left, right = codes[:-1], codes[1:]
        at = np.flatnonzero((left > 127) | (right > 127))
        if "\ufffd" in value or CONTROL.search(value):
            rare = None
        else:
            keys = left[at] * SIZE + right[at]
            place = np.minimum(np.searchsorted(self.common, keys), len(self.common) - 1)
            rare = at[self.common[place] != keys].tolist()
            if not rare:
                return value, 0, 0
        out: list[str] = []
        fixed = lost = 0
        for m in PIECE.finditer(value):
            piece = m.group()
            if rare is not None and bisect_left(rare, m.start() - 1) == bisect_left(rare, m.end()):
                out.append(piece)
                continue
            made, f, n = self.line(piece)
            out.append(made)
            fixed += f
            lost += n
        return "".join(out), fixed, lost


def misread_test(df: DataFrame, model: PairModel):
    """A factory of tests whether a text holds a misread passage, for use inside other operators' tasks."""
    shared = df.sparkSession.sparkContext.broadcast((model.keys, model.counts))

    def make():
        restorer = Restorer(PairModel(*shared.value))

        def test(value: str) -> bool:
            return not value.isascii() and any(restorer.text(value)[1:])

        return test

    return make


def restore(df: DataFrame, key: str, text: str, model: PairModel) -> DataFrame:
    """(key, restored, fixed, lost): every text with at least one misread passage.

    ``fixed`` counts restored pieces and ``lost`` those left unreadable.  Null, empty and pure ASCII
    texts have none; repeated rows each count; texts are read whole; other columns are ignored.
    """
    shared = df.sparkSession.sparkContext.broadcast((model.keys, model.counts))
    kind = dict(df.dtypes)[key]

    def make():
        restorer = Restorer(PairModel(*shared.value))

        def expand(k, value):
            if not value or value.isascii():
                return []
            made, fixed, lost = restorer.text(value)
            return [(k, made, fixed, lost)] if fixed or lost else []

        return expand

    return map_rows(df.select(df[key], text_column(df, text)), f"{key} {kind}, restored string, fixed int, lost int", make)
