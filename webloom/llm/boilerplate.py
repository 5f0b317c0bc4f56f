"""Problem 7: the main body of a page, by a linear-chain conditional random field over its blocks.

The blocks of a page are the lines of its extracted text, in order; each is joined to the DOM leaf
block of the fetched page that it came from, whose ancestor tags and containers become features
beside those of the text.  Weights are trained in numpy on a bounded sample of pages whose markup
itself labels the body, each page once with and once without the features of that markup, every
fourth also by its text alone, and decoded by Viterbi.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from bisect import bisect_left, bisect_right
from functools import lru_cache
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.arrow import map_rows
from webloom.llm.residue import inspect

#: Bounds of the training sample: labelled pages, and bytes of their text and markup.
TRAIN_PAGES, TRAIN_BYTES = 3000, 1 << 27
EPOCHS = 8
WIDTH = 1 << 17
CONTAINERS = frozenset("div td article main section nav aside footer header form body ul ol table".split())
LEAVES = frozenset("p li span h1 h2 h3 h4 h5 h6 pre code b blockquote dt dd figcaption strong em i a td div label button summary".split())
INLINE = frozenset("a b strong em i code u small sup sub mark".split())
#: Tags, ids and classes by which markup names the body of a page; else the container of its h1 does.
BODY_TAGS = frozenset(["article", "main"])
BODY_NAMES = frozenset("story article content main post entry post-content entry-content article-body".split())
TOKEN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<!--.*?-->|([^<]+)|<", re.S)
SKIP = re.compile(r"(?is)<head\b.*?</head>|<(script|style)\b.*?</\1\s*>")
NAME = re.compile(r"(?:class|id)=[\"']?([^\"'>]+)")
DIGITS = re.compile("[0-9]+")
WORD = re.compile(r"\w+", re.U)
CODE_SIGN = re.compile(r"[;{}=]|\(\)|^\s*[$#]|  # ")
SITE_END = re.compile(r"\([\w.-]+\.[a-z]{2,}\)\s*$")
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())


@lru_cache(1 << 17)
def feature(name: str) -> int:
    return zlib.crc32(name.encode()) % WIDTH


def fold(text: str) -> str:
    return " ".join(text.split()).lower()


def text_key(text: str) -> int:
    raw = fold(text).encode()
    return zlib.crc32(raw) << 31 ^ zlib.adler32(raw)


class _Node:
    __slots__ = ("tag", "names", "parent", "prose", "heading", "links", "blocks", "depth")

    def __init__(self, tag, names, parent):
        self.tag, self.names, self.parent = tag, names, parent
        self.prose = self.links = self.blocks = 0
        self.heading = False
        self.depth = parent.depth + 1 if parent else 0


def leaf_blocks(markup: str) -> list[tuple[str, str, list[_Node], bool]]:
    """(text, tag, containers from the outside, inside a link) of each leaf block, in document order."""
    at = markup.lower().find("<body")
    markup = SKIP.sub(" ", markup[max(at, 0) :])
    root = _Node("root", (), None)
    stack: list[tuple[str, _Node]] = [("root", root)]
    out: list[tuple[str, str, list[_Node], bool]] = []
    text: list[str] = []
    state = ["", False]  # tag of the open leaf, link seen

    def flush() -> None:
        value = " ".join(entities.unescape("".join(text)).split())
        text.clear()
        if value:
            node, chain = stack[-1][1], []
            while node.parent is not None:
                chain.append(node)
                node = node.parent
            out.append((value, state[0] or stack[-1][0], chain[::-1], state[1]))
        state[0], state[1] = "", False

    for m in TOKEN.finditer(markup):
        if (piece := m.group(4)) is not None:
            text.append(piece)
            if not state[1] and piece.strip() and any(t == "a" for t, _ in stack):
                state[1] = True
            continue
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        closing = m.group(1) == "/"
        if tag in INLINE and any(t in LEAVES and t not in CONTAINERS and t not in INLINE for t, _ in stack[-3:]):
            if not closing:
                stack.append((tag, stack[-1][1]))
            elif stack[-1][0] == tag:
                stack.pop()
            continue
        if not (tag == "a" and not closing):
            flush()
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
        elif tag not in VOID and not m.group(3).rstrip().endswith("/"):
            node = stack[-1][1]
            if tag in CONTAINERS:
                found = NAME.findall(m.group(3))
                node = _Node(tag, tuple(w for x in found for w in x.split()), node)
            stack.append((tag, node))
            state[0] = tag if tag in LEAVES else ""
    flush()
    return out


def page_blocks(markup: str | None) -> list[tuple[int, list[int], list[int], int, str]]:
    """(text key, plain features, markup features, label, text) of each leaf block.

    The label is 1 for the body, 2 for what is set apart inside it, 0 for the rest and -1 where the markup names no body.
    """
    if not markup:
        return []
    blocks = leaf_blocks(markup)
    prose_of: dict[int, int] = {}
    heads: list[_Node] = []
    for text, tag, chain, link in blocks:
        if not chain:
            continue
        size = len(text) if not link and (text[-1:] in ".!?”\"" or len(text) > 120) and tag in ("p", "li", "pre", "div", "td") else 0
        chain[-1].prose += size
        chain[-1].blocks += 1
        chain[-1].links += link
        if tag == "h1":
            heads.append(chain[-1])
            chain[-1].heading = True
    every = {id(c): c for _, _, chain, _ in blocks for c in chain}.values()
    body = heads[0] if heads else max(every, key=lambda c: c.prose, default=None)
    named = next((c for c in every if c.tag in BODY_TAGS or c.tag == "div" and BODY_NAMES & set(c.names)), heads[0] if heads else None)
    widest = max((c.prose for c in every), default=0)
    seen_body, out = False, []
    last = max((i for i, b in enumerate(blocks) if body in b[2]), default=-1)
    for i, (text, tag, chain, link) in enumerate(blocks):
        inside = body is not None and body in chain
        seen_body |= inside
        own = chain[-1] if chain else None
        relation = "same" if own is body else "below" if inside else "before" if not seen_body else "after" if i > last else "between"
        plain = [f"tag={tag}", f"rel={relation}", f"rel={relation},tag={tag},a={link}", f"a={link}", f"rel={relation},a={link}"]
        marked: list[str] = []
        if own is not None:
            share = 0 if not widest else min(4, 4 * own.prose // widest)
            plain += [f"share={share}", f"share={share},tag={tag}", f"head={own.heading}", f"few={min(own.blocks, 5)}", f"links={min(4, 4 * own.links // max(1, own.blocks))}"]
            marked += {f"in={c.tag}" for c in chain} | {f"name={n}" for c in chain for n in c.names if not DIGITS.search(n)}
            marked += [f"chain={'/'.join(c.tag for c in chain)},{tag}"]
        label = -1
        if named is not None:
            label = (1 if own is named else 2) if named in chain else 0
        out.append((text_key(text), [feature(x) for x in plain], [feature(x) for x in marked], label, text))
    return out


def text_features(line: str, place: int, count: int) -> list[int]:
    folded = DIGITS.sub("0", fold(line))
    words = WORD.findall(folded)
    end = line.rstrip()[-1:]
    out = [f"whole={zlib.crc32(folded.encode())}", f"end={end if not end.isalnum() else 'w'}", f"len={min(7, len(folded) // 40)}", f"n={min(len(words), 12)}"]
    out += [f"end={end if not end.isalnum() else 'w'},n={min(len(words), 12) // 2}", f"pos={min(4, 5 * place // max(1, count))}", f"first={place == 0}", f"last={place == count - 1}"]
    out += [f"w={w}" for w in set(words)]
    out += [f"b={a}_{b}" for a, b in pairwise(words[:4])] + [f"start={words[0] if words else ''}", f"tail={' '.join(words[-2:])}"]
    for mark in "›»|·©:–":
        n = line.count(mark)
        if n:
            out.append(f"mark={mark}{min(n, 3)}")
    if CODE_SIGN.search(line):
        out.append("code")
    if ":" in line[:30]:
        out.append(f"lead={fold(line.split(':')[0])}")
    if SITE_END.search(line):
        out.append("site")
    upper = sum(w[:1].isupper() for w in line.split())
    out.append(f"caps={min(4, 5 * upper // max(1, len(line.split())))}")
    return [feature(x) for x in out]


class ChainField:
    """Two labels, a weight for each feature, and transitions; Adagrad on the log-likelihood."""

    def __init__(self):
        self.w, self.t = np.zeros(WIDTH, np.float32), np.zeros((3, 3), np.float32)  # row 2: start; column 2: end

    def scores(self, page: list[list[int]]) -> np.ndarray:
        if not page:
            return np.zeros(0)
        starts = np.cumsum([0, *(len(f) for f in page[:-1])])
        return np.add.reduceat(self.w[np.concatenate(page).astype(np.int64)], starts).astype(np.float64)

    def viterbi(self, s: list[float]) -> list[int]:
        """The best labels for the blocks of a page, given their scores for the body."""
        if not s:
            return []
        t = self.t
        a, b = float(t[2, 0]), float(t[2, 1]) + s[0]
        t00, t01, t10, t11 = float(t[0, 0]), float(t[0, 1]), float(t[1, 0]), float(t[1, 1])
        back = []
        for x in s[1:]:
            from0, from1 = a + t00 < b + t10, a + t01 < b + t11
            back.append((int(from0), int(from1)))
            a, b = max(a + t00, b + t10), max(a + t01, b + t11) + x
        y = int(a + float(t[0, 2]) < b + float(t[1, 2]))
        out = [y]
        for pair in reversed(back):
            y = pair[y]
            out.append(y)
        return out[::-1]

    def fit(self, pages: list[tuple[list[list[int]], list[int]]], seed: int = 7) -> ChainField:
        rng = np.random.default_rng(seed)
        gw, gt = np.full(WIDTH, 1e-6, np.float32), np.full((3, 3), 1e-6, np.float32)
        for _ in range(EPOCHS):
            for i in rng.permutation(len(pages)):
                feats, labels = pages[i]
                p, trans = self._marginals(feats)
                for f, y, q in zip(feats, labels, p):
                    d = np.float32(y - q)
                    if abs(d) > 1e-3:
                        gw[f] += d * d
                        self.w[f] += 0.3 * d / np.sqrt(gw[f])
                true = np.zeros((3, 3), np.float32)
                true[2, labels[0]] += 1
                for x, y in pairwise(labels):
                    true[x, y] += 1
                true[labels[-1], 2] += 1
                d = true - trans
                gt += d * d
                self.t += 0.1 * d / np.sqrt(gt)
        return self

    def _marginals(self, feats: list[list[int]]) -> tuple[list[float], np.ndarray]:
        n = len(feats)
        s = np.stack([np.zeros(n), self.scores(feats)], 1)
        t = self.t[:2, :2].astype(np.float64)
        fwd, bwd = np.zeros((n, 2)), np.zeros((n, 2))
        fwd[0] = self.t[2, :2] + s[0]
        for i in range(1, n):
            fwd[i] = np.logaddexp(fwd[i - 1, 0] + t[0], fwd[i - 1, 1] + t[1]) + s[i]
        bwd[-1] = self.t[:2, 2]
        for i in range(n - 2, -1, -1):
            m = t + s[i + 1] + bwd[i + 1]
            bwd[i] = np.logaddexp(m[:, 0], m[:, 1])
        z = np.logaddexp(*(fwd[-1] + self.t[:2, 2]))
        trans = np.zeros((3, 3), np.float32)
        marg = np.exp(fwd + bwd - z)
        trans[2, :2], trans[:2, 2] = marg[0], marg[-1]
        for i in range(n - 1):
            trans[:2, :2] += np.exp(fwd[i][:, None] + t + s[i + 1] + bwd[i + 1] - z)
        return marg[:, 1].tolist(), trans


def _strip_site(line: str) -> str:
    return re.sub(r"\s*(?:\([^()]*\)|–[^–]*)\s*$", "", re.sub(r"[0-9]+", "0", fold(line))).rstrip(". ")


def training_pages(rows: list[tuple[str, str]]) -> list[tuple[list[list[int]], list[int]]]:
    """Feature lists and labels from (content, html) of pages whose markup names the body.

    Blocks that sites also set apart inside the body (teasers, advertising marks) are told by the
    lines found there: the same line, or the same words before a colon, is no body elsewhere either.
    """
    parsed = [(content.split("\n"), page_blocks(markup)) for content, markup in rows]
    parsed = [(lines, blocks) for lines, blocks in parsed if any(b[3] == 1 for b in blocks)]
    apart: dict[str, int] = {}
    body: dict[str, int] = {}
    for _, blocks in parsed:
        for *_, label, text in blocks:
            lead = _strip_site(text.split(":")[0]) if ":" in text[:40] else _strip_site(text)
            side = {1: body, 2: apart}.get(label)
            if side is not None:
                side[lead] = side.get(lead, 0) + 1
    outside = {lead for lead, n in apart.items() if n >= 2 and len(lead) < 60 and n > 0.5 * body.get(lead, 0)}
    out = []
    for number, (lines, blocks) in enumerate(parsed):
        known = [b[0] for b in blocks]
        places = set(known)
        full, bare, text_only, labels = [], [], [], []
        kept = [x for x in lines if x.strip()]
        if any(len(x) > 100 and text_key(x) not in places for x in kept):
            continue  # text and markup were damaged differently: its labels cannot be told
        for i, (line, at) in enumerate(zip(kept, same_text(kept, known))):
            b = blocks[at] if at >= 0 else None
            words = text_features(line, i, len(kept))
            lead = _strip_site(line.split(":")[0]) if ":" in line[:40] else _strip_site(line)
            labels.append(int(b is not None and lead not in outside and b[3] == 1))
            full.append(words + (b[1] + b[2] if b else [feature("nodom")]))
            bare.append(words + (b[1] if b else [feature("nodom")]))
            text_only.append([*words, feature("nodom")])
        if labels:
            out += [(full, labels), (bare, labels)]
            if number % 4 == 0:
                out.append((text_only, labels))
    return out


def dom_table(fetched: DataFrame, key: str, markup: str, weights) -> DataFrame:
    """(key, dom_keys, dom_scores, dom_sizes): all leaf blocks of each page, in order, as text keys and the sums of their DOM weights.

    ``weights`` is the broadcast weight vector.  The field is linear in its features, so the markup
    side of a block is one number, and the html itself is never shuffled.
    """
    kind = dict(fetched.dtypes)[key]

    def make():
        w = weights.value[0]

        def expand(k, value):
            blocks = page_blocks(value)
            scores = [float(w[b[1]].sum() + (w[b[2]].sum() if b[2] else 0.0)) for b in blocks]
            return [(k, [b[0] for b in blocks], scores, [len(b[4]) for b in blocks])] if blocks else []

        return expand

    return map_rows(fetched.select(key, markup), f"{key} {kind}, dom_keys array<long>, dom_scores array<float>, dom_sizes array<int>", make)


def same_text(lines: list[str], keys: list[int]) -> list[int]:
    """The block of the same text of each line, or -1.

    Where several blocks have the text, the line takes the free one that lies next to the blocks of
    the lines around it; the last lines of more lines than blocks share one.
    """
    wanted = [text_key(x) for x in lines]
    places: dict[int, list[int]] = {}
    for i, k in enumerate(keys):
        places.setdefault(k, []).append(i)
    out = [p[0] if (p := places.get(k)) and len(p) == 1 else -1 for k in wanted]
    follow, ahead = [(len(keys), 0)] * len(lines), None
    for i in range(len(lines) - 1, -1, -1):
        if out[i] >= 0:
            ahead = (out[i], i)
        elif ahead:
            follow[i] = ahead
    last, seen = -1, {k: 0 for k in places}
    for i, k in enumerate(wanted):
        if len(p := places.get(k, ())) > 1:
            limit, line = follow[i]
            first = bisect_right(p, last)
            until = max(first, bisect_left(p, limit)) if limit > last else len(p)
            free = p[first:until] or p[first:]
            if not free:
                free = p[seen[k] :] or p[-1:]
            best = free[0]
            if line and limit > last and len(free) > 1:
                near = bisect_left(free, limit - (line - i))
                best = min([free[0], *free[max(0, near - 1) : near + 1]], key=lambda at: (min(at - last - 1 if last >= 0 else len(keys), abs(limit - (line - i) - at)), at))
            out[i] = best
            seen[k] = bisect_right(p, best)
        if out[i] >= 0:
            last = out[i]
    return out


def align(lines: list[str], keys: list[int], sizes: list[int]) -> list[int]:
    """The block of each line, or -1: the one of the same text, else the next free one after the line before if it is about as long.

    The second way serves lines whose text was damaged on one side only.
    """
    out = same_text(lines, keys)
    taken, last = set(out), -1
    for i, at in enumerate(out):
        if at < 0 and last + 1 < len(keys) and last + 1 not in taken and 0.5 <= sizes[last + 1] / max(1, len(lines[i])) <= 2:
            out[i] = at = last + 1
            taken.add(at)
        if at >= 0:
            last = at
    return out


def fit_field(pages: DataFrame, fetched: DataFrame, page_key: str, key: str, text: str, markup: str, bound: int = TRAIN_PAGES) -> ChainField:
    """Trains on at most ``bound`` pages of together TRAIN_BYTES, those of smallest hash among pages with text and markup."""
    ids = pages.where(F.col(text).isNotNull()).select(page_key, key).orderBy(F.xxhash64(page_key), page_key).limit(bound)
    few = F.broadcast(ids.select(F.col(page_key).alias("_p"), F.col(key).alias("_k")))
    picked = pages.join(few, F.col(page_key) == F.col("_p"), "left_semi").select(F.col(key).alias("_f"), F.col(text).alias("_t"), F.col(page_key).alias("_o"))
    markups = fetched.join(few, F.col(key) == F.col("_k"), "left_semi").select(key, markup).where(F.col(markup).isNotNull())
    both = picked.join(markups, F.col("_f") == F.col(key)).select("_o", "_t", markup)
    sizes = both.select("_o", (F.octet_length("_t") + F.octet_length(markup)).alias("n"), F.xxhash64("_o").alias("h")).toPandas().sort_values(["h", "_o"])
    small = sizes["_o"][sizes["n"].cumsum() <= TRAIN_BYTES].tolist()
    rows = both.where(F.col("_o").isin(small)).toPandas().sort_values("_o")
    rows = [(a, b) for a, b in zip(rows["_t"], rows[markup]) if inspect(a)[0] is None]
    return ChainField().fit(training_pages(rows))


def find_boilerplate(
    pages: DataFrame, fetched: DataFrame, page_key: str, key: str, text: str = "content", markup: str = "html", field: ChainField | None = None, skip_residue: bool = True
) -> DataFrame:
    """(page_key, line_no): lines of ``text`` that are not main body; blank lines never come out.

    Null texts have no lines; a page without markup is decoded from its text alone; repeated rows
    all come out; texts are read whole; an empty input gives no rows.  ``skip_residue`` leaves out
    texts that are template residue.
    """
    kind = dict(pages.dtypes)[page_key]

    def lines(k, value, gone):
        return [(k, i) for i in gone]

    return _decoded(pages.where(F.col(text).isNotNull()), fetched, page_key, key, text, markup, field, skip_residue, f"{page_key} {kind}, line_no long", lines)


def main_body(
    pages: DataFrame, fetched: DataFrame, page_key: str, key: str, text: str = "content", markup: str = "html", field: ChainField | None = None, skip_residue: bool = True
) -> DataFrame:
    """(page_key, text): every page with the lines of ``find_boilerplate`` taken out of its text.

    Blank lines stay where they stand; null texts stay null, and with ``skip_residue`` texts that are
    template residue stay whole; repeated rows all come out.
    """
    kind = dict(pages.dtypes)[page_key]

    def rest(k, value, gone):
        left = set(gone)
        return [(k, value if value is None or not left else "\n".join(x for i, x in enumerate(value.split("\n")) if i not in left))]

    return _decoded(pages, fetched, page_key, key, text, markup, field, skip_residue, f"{page_key} {kind}, {text} string", rest)


def _decoded(pages: DataFrame, fetched: DataFrame, page_key: str, key: str, text: str, markup: str, field: ChainField | None, skip_residue: bool, schema: str, emit) -> DataFrame:
    """The rows that ``emit`` (page, text, numbers of the boilerplate lines) makes of each page."""
    pages, fetched = pages.select(page_key, key, text), fetched.select(key, markup)
    field = field or fit_field(pages, fetched, page_key, key, text, markup)
    shared = pages.sparkSession.sparkContext.broadcast((field.w, field.t))
    dom = dom_table(fetched.where(F.col(markup).isNotNull()), key, markup, shared)
    columns = [page_key, text, "dom_keys", "dom_scores", "dom_sizes"]
    joined = pages.where(F.col(key).isNotNull()).join(dom, key, "left").select(*columns)
    # pages that name no fetch stay out of the join, where they would all meet in one partition
    alone = pages.where(F.col(key).isNull()).select(page_key, text, *[F.lit(None).cast(dom.schema[c].dataType).alias(c) for c in columns[2:]])
    joined = joined.unionByName(alone)

    def make():
        model = ChainField()
        model.w, model.t = shared.value
        none = float(model.w[feature("nodom")])

        def expand(k, value, keys, scores, sizes):
            if value is None or skip_residue and inspect(value)[0] is not None:
                return emit(k, value, [])
            lines = [(i, x) for i, x in enumerate(value.split("\n")) if x.strip()]
            sums = model.scores([text_features(x, j, len(lines)) for j, (_, x) in enumerate(lines)]).tolist()
            at = align([x for _, x in lines], keys or [], sizes or [])
            sums = [a + (scores[j] if j >= 0 else none) for a, j in zip(sums, at)]
            return emit(k, value, [i for (i, _), y in zip(lines, model.viterbi(sums)) if y == 0])

        return expand

    return map_rows(joined, schema, make)
