"""Problem 4: document and line languages by a byte convolutional network.

Multi-width filters over byte embeddings, max pooling and softmax, trained in numpy on a bounded
sample of labelled rows and applied to batches of fixed-length windows that cover whole texts.
"""

from __future__ import annotations

import re
from collections import Counter, OrderedDict
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.arrow import map_rows
from webloom.llm.residue import is_code

LANGUAGES = ("en", "de", "fr", "es", "pt", "it", "nl", "ru")
WINDOW = 64
WIDTHS = (2, 3, 4, 5)
FILTERS, DIMENSIONS = 32, 8
#: Bound of the training sample: rows for each language and table, windows for each row.
TRAIN_ROWS, TRAIN_WINDOWS = 200, 10
EPOCHS, BATCH = 6, 128
#: A line is taken to be in the language of its text unless another is so much likelier.
PRIOR = 0.7
#: A line needs so many words with a letter to have a language of its own.
LINE_WORDS = 8
WORD = re.compile(r"\S*[^\W\d_]\S*")
QUOTED = re.compile("“[^“”]{1,100}”")
#: Words that open a byline.
BYLINE = re.compile(r"^\s*(?:By|Von|Par|Por|Di|Door|Автор:)\s+(?:[A-ZÀ-ÞА-ЯЁ][\w’'-]+\s*){1,4}(?:[,|(·–—-].{0,60})?$")


def label_code(label: str | None) -> str | None:
    """The two-letter code before any ``-`` or ``_``; None where the label gives no language."""
    m = re.fullmatch(r"\s*([A-Za-z]{2})(?:[-_].*)?\s*", label or "")
    return m.group(1).lower() if m else None


def plain_line(line: str) -> bytes:
    """A line as the network reads it: lower case, without quotations of under LINE_WORDS words unless little else is left."""
    bare = QUOTED.sub(lambda m: " " if len(m.group().split()) < LINE_WORDS else m.group(), line) if "“" in line else line
    return (bare if len(bare) >= 0.4 * len(line) else line).lower().encode("utf-8", "replace")


def windows(raw: bytes) -> np.ndarray:
    """Consecutive windows over all bytes; the last is moved back to end with the text, a short text is padded."""
    n = len(raw)
    data = np.frombuffer(raw, np.uint8)
    if n <= WINDOW:
        return np.pad(data, (0, WINDOW - n))[None, :]
    starts = np.arange(0, n - WINDOW + 1, WINDOW)
    if starts[-1] != n - WINDOW:
        starts = np.append(starts, n - WINDOW)
    return data[starts[:, None] + np.arange(WINDOW)]


class ByteNet:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        g = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
        self.p = {"e": g(256, DIMENSIONS) * 0.5}
        self.p["e"][0] = 0
        for w in WIDTHS:
            self.p[f"w{w}"] = g(w * DIMENSIONS, FILTERS) * np.float32(np.sqrt(2 / (w * DIMENSIONS)))
            self.p[f"b{w}"] = np.zeros(FILTERS, np.float32)
        self.p["o"] = g(FILTERS * len(WIDTHS), len(LANGUAGES)) * np.float32(0.1)
        self.p["c"] = np.zeros(len(LANGUAGES), np.float32)

    def _pool(self, x: np.ndarray, keep: bool = False):
        e = self.p["e"][x]
        n, size, d = e.shape
        flat = np.ascontiguousarray(e).reshape(n, size * d)
        pooled, kept = [], []
        for w in WIDTHS:
            view = np.lib.stride_tricks.as_strided(flat, (n, size - w + 1, w * d), (flat.strides[0], d * 4, 4))
            act = view.reshape(-1, w * d) @ self.p[f"w{w}"]
            act = act.reshape(n, size - w + 1, FILTERS)
            if keep:
                top = act.argmax(1)
                best = np.take_along_axis(act, top[:, None, :], 1)[:, 0]
                kept.append((top, best))
            else:
                best = act.max(1)
            pooled.append(np.maximum(best + self.p[f"b{w}"], 0))
        return np.concatenate(pooled, 1), flat, kept

    def log_probabilities(self, x: np.ndarray, batch: int = 64) -> np.ndarray:
        out = []
        for i in range(0, len(x), batch):
            z = self._pool(x[i : i + batch])[0] @ self.p["o"] + self.p["c"]
            z -= z.max(1, keepdims=True)
            out.append(z - np.log(np.exp(z).sum(1, keepdims=True)))
        return np.concatenate(out) if out else np.zeros((0, len(LANGUAGES)), np.float32)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> ByteNet:
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, total = 0, epochs * (len(x) // BATCH + 1)
        d = DIMENSIONS
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), BATCH):
                rows = order[i : i + BATCH]
                xb, yb = x[rows], y[rows]
                h, flat, kept = self._pool(xb, keep=True)
                z = h @ self.p["o"] + self.p["c"]
                z = np.exp(z - z.max(1, keepdims=True))
                z /= z.sum(1, keepdims=True)
                z[np.arange(len(yb)), yb] -= 1
                z /= len(yb)
                grad = {"o": h.T @ z, "c": z.sum(0), "e": np.zeros_like(self.p["e"])}
                dh = (z @ self.p["o"].T) * (h > 0)
                for j, w in enumerate(WIDTHS):
                    g = dh[:, j * FILTERS : (j + 1) * FILTERS]
                    top = kept[j][0]
                    at = (top[:, :, None] * d + np.arange(w * d)).astype(np.int64)  # n, filters, w*d
                    seen = flat[np.arange(len(xb))[:, None, None], at]
                    grad[f"w{w}"] = np.einsum("nfk,nf->kf", seen, g, optimize=True)
                    grad[f"b{w}"] = g.sum(0)
                    de = g[:, :, None] * self.p[f"w{w}"].T[None]
                    spots = xb[np.arange(len(xb))[:, None, None], top[:, :, None] + np.arange(w)]
                    live = g != 0
                    where, values = spots[live].reshape(-1), de[live].reshape(-1, d)
                    for k in range(d):
                        grad["e"][:, k] += np.bincount(where, values[:, k], 256)
                step += 1
                rate = 0.006 * (1 - step / (total + 1)) + 1e-4
                for k, value in grad.items():
                    m[k] += 0.1 * (value - m[k])
                    v2[k] += 0.01 * (value * value - v2[k])
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
                self.p["e"][0] = 0
        return self


def training_windows(rows: list[tuple[str, str]], seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Windows and labels of (label code, text) rows; windows may start anywhere in a text, and some are cut short.

    Rows of rarer languages give more windows, up to four times as many.
    """
    rng = np.random.default_rng(seed)
    xs, ys = [], []
    held = Counter(code for code, _ in rows)
    most = max(held.values(), default=0)
    for code, text in rows:
        lines = [x for x in text.split("\n") if len(x) >= 20 and not is_code(x)]
        if not lines:
            continue
        wanted = int(TRAIN_WINDOWS * min(4.0, most / held[code]))
        for line in rng.choice(np.array(lines, object), wanted if wanted > TRAIN_WINDOWS else min(len(lines), wanted), replace=wanted > TRAIN_WINDOWS):
            raw = plain_line(line)
            at = int(rng.integers(0, max(1, len(raw) - WINDOW + 1)))
            piece = raw[at : at + (WINDOW if rng.random() < 0.7 else int(rng.integers(24, WINDOW)))]
            xs.append(windows(piece)[0])
            ys.append(LANGUAGES.index(code))
    return np.array(xs, np.uint8).reshape(-1, WINDOW), np.array(ys, np.int64)


def fit_network(labelled: list[tuple[DataFrame, str, str, str]], rows: int = TRAIN_ROWS) -> ByteNet:
    """Trains on about ``rows`` rows of each language from each (frame, key, label, text), and never on more than twice that.

    A row is picked by the hash of its key against rows / rows of that language, so no order or size
    of the table matters; texts under 200 characters teach nothing and are passed over.
    """
    found: list[tuple[str, str]] = []
    for df, key, label, text in labelled:
        code = F.lower(F.regexp_extract(F.col(label), r"^\s*([A-Za-z]{2})(?:[-_].*)?\s*$", 1))
        rowset = df.select(F.col(key).alias("k"), code.alias("code"), F.col(text).alias("t")).where(F.col("code").isin(*LANGUAGES) & (F.length("t") >= 200))
        counts = {r["code"]: r["count"] for r in rowset.groupBy("code").count().collect()}
        if not counts:
            continue
        share = F.coalesce(*[F.when(F.col("code") == c, F.lit(int(1_000_000 * min(1.0, rows / n)) + 1)) for c, n in counts.items()])
        taken = rowset.where(F.pmod(F.xxhash64("k"), F.lit(1_000_000)) < share).orderBy(F.xxhash64("k"), "k").limit(2 * rows * len(LANGUAGES)).collect()
        held: Counter[str] = Counter()
        kept = []
        for r in taken:
            held[r["code"]] += 1
            if held[r["code"]] <= 2 * rows:
                kept.append(r)
        found += [(r["code"], r["t"]) for r in sorted(kept, key=lambda r: r["k"])]
    return train(found)


def train(rows: list[tuple[str, str]]) -> ByteNet:
    """Labels are partly false: a first network, trained on all rows, keeps those it agrees with for the second."""
    x, y = training_windows(rows)
    if not len(x):
        return ByteNet()
    labeller = Labeller(ByteNet().fit(x, y, epochs=max(2, 300 * BATCH // len(x))))
    agreed = [(code, text) for code, text in rows if labeller.document(text)[0] == code]
    kept, given = Counter(c for c, _ in agreed), Counter(c for c, _ in rows)
    agreed += [(c, text) for c, text in rows if kept[c] < 0.5 * given[c]]  # too few of a language agree: the network is at fault
    lines = [(code, "\n".join(part for part in text.split("\n") if labeller.agrees(part, code))) for code, text in agreed]
    x, y = training_windows(lines)
    return ByteNet().fit(x, y, epochs=max(EPOCHS, 800 * BATCH // max(1, len(x)))) if len(x) else labeller.net


def is_code_or_byline(line: str) -> bool:
    return bool(is_code(line) or BYLINE.match(line))


class Labeller:
    """Languages of the lines of whole texts; equal lines of one task are classified once."""

    def __init__(self, net: ByteNet, held: int = 20_000):
        self.net, self.held = net, held
        self.seen: OrderedDict[str, tuple[int, float, np.ndarray]] = OrderedDict()

    def lines(self, texts: list[str]) -> dict[str, tuple[int, float, np.ndarray]]:
        """(language number, confidence, probabilities) of each distinct line."""
        fresh = [x for x in dict.fromkeys(texts) if x not in self.seen]
        spans, parts = [], []
        for line in fresh:
            w = windows(plain_line(line))
            parts.append(w)
            spans.append(len(w))
        if parts:
            logs = self.net.log_probabilities(np.concatenate(parts))
            at = 0
            for line, n in zip(fresh, spans):
                # each window votes with its probabilities; a short quotation cannot outvote the rest of its line
                mean = np.exp(logs[at : at + n]).mean(0)
                self.seen[line] = (int(mean.argmax()), float(mean.max()), mean)
                at += n
        out = {x: self.seen[x] for x in dict.fromkeys(texts)}
        while len(self.seen) > self.held:
            self.seen.popitem(last=False)
        return out

    def agrees(self, line: str, code: str) -> bool:
        """Whether a line is not clearly in another language."""
        lang, sure, _ = self.lines([line])[line]
        return LANGUAGES[lang] == code or sure < 0.8

    def document(self, text: str) -> tuple[str | None, float, list[tuple[int, str, float, int]]]:
        """(language that most words are in, share of those words, [(line_no, language, confidence, words)])."""
        rows = [(i, x, len(WORD.findall(x))) for i, x in enumerate(text.split("\n"))]
        rows = [r for r in rows if r[2] and not is_code_or_byline(r[1])]
        if not rows:
            return None, 0.0, []
        known = self.lines([x for _, x, _ in rows])
        weight = [0.0] * len(LANGUAGES)
        for _, x, n in rows:
            weight[known[x][0]] += n * (known[x][1] if n < LINE_WORDS else 1.0)
        best = int(np.argmax(weight))
        prior = np.full(len(LANGUAGES), (1 - PRIOR) / (len(LANGUAGES) - 1))
        prior[best] = PRIOR
        out = []
        for i, x, n in rows:
            p = known[x][2] * prior
            p /= p.sum()
            out.append((i, LANGUAGES[int(p.argmax())], float(p.max()), n))
        return LANGUAGES[best], weight[best] / sum(weight), out


def label_languages(df: DataFrame, key: str, label: str, text: str, net: ByteNet, skip: Callable[[], Callable[[str], bool]] | None = None) -> DataFrame:
    """(key, lang, confidence, label_wrong, segments array<struct<line_no, lang, confidence>>) of every text.

    ``segments`` are the lines of at least LINE_WORDS words in another language than the text's.
    ``label_wrong`` also holds where the label gives no language.  Null, empty and wordless texts come
    out with null language and no segments; code and bylines have no language; repeated rows each
    come out; texts are read whole; other columns are ignored.
    """
    shared = df.sparkSession.sparkContext.broadcast(net.p)
    kind = dict(df.dtypes)[key]
    schema = f"{key} {kind}, lang string, confidence double, label_wrong boolean, segments array<struct<line_no: long, lang: string, confidence: double>>"

    def make():
        model = ByteNet()
        model.p = shared.value
        labeller = Labeller(model)
        left_out = skip() if skip else None

        def expand(k, given, value):
            if value and left_out and left_out(value):
                return []
            lang, share, rows = labeller.document(value) if value else (None, 0.0, [])
            others = [{"line_no": i, "lang": c, "confidence": p} for i, c, p, n in rows if n >= LINE_WORDS and c != lang]
            return [(k, lang, share, lang is not None and label_code(given) != lang, others)]

        return expand

    return map_rows(df.select(key, F.col(label).cast("string"), F.col(text).cast("string")), schema, make)
