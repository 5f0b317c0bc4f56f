"""Problem 10: reading level, by a linear pairwise ranker calibrated with isotonic regression.

The ranker learns from pairs of graded texts which of two is harder, on features of vocabulary and
syntax that are rates, so length and layout weigh nothing.  Pool-adjacent-violators regression of
the grades on the scores turns a score into a level.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.arrow import map_rows
from webloom.llm.residue import is_code

#: Bound of the graded texts read for training.
MAX_GRADED = 5_000
LEVELS = (1, 5)
TOKEN = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
ENGLISH_WORD = re.compile(r"[a-z]+(?:['’-][a-z]+)*")
VOWELS = re.compile("[aeiouy]+")
CLAUSE = re.compile(r"[.!?;:,]+|\b(?:and then|and|but|while|or)\b")
#: Latinate and Greek endings of English words.
LEARNED = re.compile(r"(?:tion|sion|ity|ical|ment|ology|ism|ative|ous|ance|ence|ization|isation|ises|izes|ctive|able|ible|ular|uous|logical|ural|icity|osis|graphy|metric|ation)s?$")
#: Words that open dependent clauses.
DEPENDENT = frozenset("because although whereby which whose insofar unless whenever notwithstanding irrespective provided while when if since whereas that".split())
#: Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the and of to a in is was that for with this our his her it they on at by from as had has all my after before because which also while".split(),
    "de": "der die das und ist ein eine einen dem den nicht mit für im von zu auf sich auch hat wird bei nach des einem".split(),
    "fr": "le la les des du et un une de pour dans avec sur est au que qui en par plus aux ses son".split(),
    "es": "el la los las del y un una de para en con por es que se su más al sus lo".split(),
    "pt": "o a os as do da e um uma de para em com por não dos das no na mais ao que".split(),
    "it": "il lo la gli le di e una un del per con nella della che non i ha più al dei".split(),
    "nl": "de het een en van in op met voor niet is aan dat te zijn heeft ook bij naar".split(),
    "ru": "и в на не с по из для за от что как к до о у без после уже".split(),
}
LINE_LANGUAGES: dict[str, list[str]] = {}
for _lang, _words in FUNCTION_WORDS.items():
    for _w in _words:
        LINE_LANGUAGES.setdefault(_w, []).append(_lang)
GRADE_BINS = 5


def english_prose(text: str) -> tuple[bool, list[str]]:
    """(whether most words of the text are English, its English prose lines)."""
    english = other = 0
    lines: list[tuple[str, bool]] = []
    for line in text.split("\n"):
        words = TOKEN.findall(line.lower())
        if not words or is_code(line):
            continue
        hits: dict[str, int] = {}
        for w in words:
            for lang in LINE_LANGUAGES.get(w, ()):
                hits[lang] = hits.get(lang, 0) + 1
        best = max(hits.values(), default=0)
        own = best > 0 and hits.get("en", 0) == best and all(v < best for k, v in hits.items() if k != "en")
        if own:
            english += len(words)
            lines.append((line, len(words) >= 6 and line.rstrip()[-1:] in ".!?…”\"’:;)"))
        elif best >= 1:
            other += len(words)
    prose = [x for x, ok in lines if ok] or [x for x, _ in lines]
    return english > other, prose


@lru_cache(200_000)
def _word(w: str) -> tuple[int, int, bool, bool]:
    return len(w), len(VOWELS.findall(w)) or 1, bool(len(w) > 6 and LEARNED.search(w)), w in DEPENDENT


def features(prose: list[str], grades: dict[str, list[float]], own: frozenset[str] | None = None, own_level: float = 0.0) -> np.ndarray:
    """Rates of vocabulary and syntax; ``grades`` maps words to the levels of the graded texts that use them.

    For a text that is itself graded, ``own`` and ``own_level`` take its own part out of the grades.
    """
    text = "\n".join(prose).lower()
    counts = Counter(ENGLISH_WORD.findall(text))
    n = max(1, sum(counts.values()))
    sums = np.zeros(9 + GRADE_BINS + 1)
    for w, c in counts.items():
        size, syllables, learned, dependent = _word(w)
        sums[0] += c * min(size, 16)
        sums[1] += c * (size <= 3)
        sums[2] += c * (size >= 7)
        sums[3] += c * (size >= 10)
        sums[4] += c * (size >= 13)
        sums[5] += c * syllables
        sums[6] += c * learned
        sums[7] += c * dependent
        sums[8] += c * (w == "of")
        known = grades.get(w)
        if known is not None and size > 2:
            total, times = known
            if own is not None and w in own:
                total, times = total - own_level, times - 1
            if times > 0:
                k = min(GRADE_BINS - 1, max(0, round(total / times) - LEVELS[0]))
                sums[9 + k] += c
                sums[-1] += c
    out = sums / n
    if sums[-1]:
        out[9 : 9 + GRADE_BINS] = sums[9 : 9 + GRADE_BINS] / sums[-1]
    clauses = [len(ENGLISH_WORD.findall(x)) for x in CLAUSE.split(text)]
    clauses = [x for x in clauses if x]
    return np.append(out[:-1], np.mean(np.minimum(clauses, 30)) if clauses else 0.0)


class ReadingModel:
    def __init__(self, weights: np.ndarray, mean: np.ndarray, scale: np.ndarray, knots: np.ndarray, levels: np.ndarray, grades: dict[str, list[float]]):
        self.weights, self.mean, self.scale, self.knots, self.levels, self.grades = weights, mean, scale, knots, levels, grades

    def score(self, prose: list[str]) -> float:
        return float(((features(prose, self.grades) - self.mean) / self.scale) @ self.weights)

    def level(self, score: float) -> float:
        return float(np.interp(score, self.knots, self.levels))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: non-decreasing fit of y on x, as knots for linear interpolation."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # sum, count, first x, last x
    for a, b in zip(x[order], y[order]):
        blocks.append([float(b), 1, float(a), float(a)])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, c, _, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + c, blocks[-1][2], last]
    knots, values = [], []
    for s, c, first, last in blocks:
        knots += [first, last] if last > first else [first]
        values += [s / c] * (2 if last > first else 1)
    return np.array(knots), np.array(values)


def train(graded: list[tuple[int, str]], rounds: int = 400, ridge: float = 1e-3) -> ReadingModel:
    """Logistic loss on the differences of all pairs of texts of different level."""
    texts = [(level, english_prose(text)[1] or [text]) for level, text in graded]
    grades: dict[str, list[float]] = {}
    owned = []
    for level, prose in texts:
        words = frozenset(ENGLISH_WORD.findall("\n".join(prose).lower()))
        owned.append(words)
        for w in words:
            g = grades.setdefault(w, [0.0, 0])
            g[0] += level
            g[1] += 1
    x = np.array([features(prose, grades, own, level) for (level, prose), own in zip(texts, owned)])
    y = np.array([level for level, _ in texts], float)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    x = (x - mean) / scale
    pairs = max(1, int((y[:, None] > y[None, :]).sum()))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        score, pull = x @ w, np.zeros(len(x))
        for at in range(0, len(x), 512):  # all pairs, in blocks: the difference of two texts enters by their scores alone
            p = (y[at : at + 512, None] > y[None, :]) / (1 + np.exp(np.clip(score[at : at + 512, None] - score[None, :], -30, 30)))
            pull[at : at + 512] += p.sum(1)
            pull -= p.sum(0)
        w += 0.5 * (x.T @ pull / pairs - ridge * w)
    knots, levels = isotonic(x @ w, y)
    return ReadingModel(w, mean, scale, knots, levels, grades)


def fit_reading(graded: DataFrame, level: str, text: str, bound: int = MAX_GRADED) -> ReadingModel:
    """Trains on at most ``bound`` graded texts, those of smallest hash; null levels and texts are passed over."""
    rows = graded.select(level, text).where(f"{level} is not null and {text} is not null").orderBy(F.xxhash64(text), text, level).limit(bound).collect()
    return train(sorted((r[0], r[1]) for r in rows))


def reading_levels(df: DataFrame, key: str, text: str, model: ReadingModel, min_words: int = 100) -> DataFrame:
    """(key, reading_level, level_exact, score) of every English text of at least ``min_words`` words.

    Null, empty, short and other-language texts have no row; copies count each; texts are read
    whole; other columns are ignored.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = dict(df.dtypes)[key]

    def make():
        m = shared.value

        def expand(k, value):
            if not value or len(value.split()) < min_words:
                return []
            english, prose = english_prose(value)
            if not english or not prose:
                return []
            score = m.score(prose)
            exact = m.level(score)
            return [(k, int(np.floor(exact + 0.5)), exact, score)]

        return expand

    return map_rows(df.select(key, text), f"{key} {kind}, reading_level int, level_exact double, score double", make)
