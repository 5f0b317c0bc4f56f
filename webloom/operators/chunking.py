"""Sentence-window chunks under a token budget, with heading blocks and offsets.

The rule is sequential in the sentences of a block.  It runs as one linear pass over Arrow batches:
a fold with array columns copies its result at every step, which is quadratic in long texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions.text import WS, trim_space
from webloom.operators.rows import map_rows

#: Fixed value: the white space class again, for Python's expressions.
SPACE = "[\\t\\n\\x0b\\f\\r \\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]"
EDGES = re.compile(f"^{SPACE}+|{SPACE}+\\Z")
HEADING = re.compile(f"[A-Z]|#+{SPACE}")
MARKS = re.compile(f"^#+{SPACE}*")
BREAK = re.compile(f"(?<=[.!?]){SPACE}+(?=[A-Z\"'(])")
WORDS = re.compile(f"{SPACE}+")
ASTRAL = re.compile("[\U00010000-\U0010ffff]")
HEADING_UNITS = 120


def _units(text: str) -> int:
    return len(text) if text.isascii() else len(text) + len(ASTRAL.findall(text))


def _tokens(text: str) -> int:
    return -(-_units(text) // 4)


def iter_blocks(text: str) -> Iterator[tuple[str | None, str]]:
    """(heading, body): lines under their latest heading; headings themselves are no body.

    A heading is a line under 120 units that does not end in a full stop and starts with a capital
    or number signs.
    """
    heading: str | None = None
    held: list[str] = []
    for raw in text.split("\n"):
        line = EDGES.sub("", raw)
        if not line:
            continue
        if HEADING.match(line) and line[-1] != "." and _units(line) < HEADING_UNITS:
            if held:
                yield heading, " ".join(held)
                held = []
            heading = MARKS.sub("", line)
        else:
            held.append(line)
    if held:
        yield heading, " ".join(held)


def iter_sentences(text: str) -> Iterator[str]:
    return filter(None, (EDGES.sub("", x) for x in BREAK.split(text)))


def iter_windows(parts: Iterator[str], target: int, overlap: int) -> Iterator[str]:
    """Windows of one block; each repeats the last ``overlap`` new sentences of the one before.

    A window closes when the next sentence would pass ``target`` tokens and it holds more than
    ``overlap`` sentences.
    """
    window: list[str] = []
    used = carried = 0
    for part in parts:
        size = _tokens(part)
        if used + size > target and len(window) > overlap:
            yield EDGES.sub("", " ".join(window))
            fresh = window[carried:]
            window = fresh[len(fresh) - overlap :] if 0 < overlap < len(fresh) else fresh if overlap else []
            carried = len(window)
            used = _tokens(" ".join(window))
        window.append(part)
        used += size
    if window:
        yield EDGES.sub("", " ".join(window))


def chunks_of(text: str, target: int, overlap: int, minimum: int) -> list[tuple]:
    """(index, total, text, tokens, start, end, heading, words) of each chunk.

    Offsets run over all windows, dropped ones too, with one unit between; windows under ``minimum``
    tokens are dropped and not numbered.  With no overlap nothing is repeated.
    """
    kept, at = [], 0
    for heading, body in iter_blocks(text):
        for window in iter_windows(iter_sentences(body), target, overlap):
            size = _units(window)
            if -(-size // 4) >= minimum:
                kept.append((window, -(-size // 4), at, at + size, heading, sum(1 for w in WORDS.split(window) if w)))
            at += size + 1
    return [(i, len(kept), *c) for i, c in enumerate(kept)]


def _carried(docs: DataFrame, carried: tuple[str, ...]) -> str:
    return "".join(f"{c} {dict(docs.dtypes)[c]}, " for c in carried)


def chunk_texts(docs: DataFrame, text: str, *carried: str, target: int = 512, overlap: int = 2, minimum: int = 50) -> DataFrame:
    """A row for each chunk, with the carried columns; null texts have none.  No shuffle."""
    schema = _carried(docs, carried) + "chunk_index int, total_chunks int, text string, token_estimate int, char_start int, char_end int, section_heading string, word_count int"

    def make():
        return lambda *values: [(*values[:-1], *c) for c in chunks_of(values[-1], target, overlap, minimum)]

    return map_rows(docs.where(F.col(text).isNotNull()).select(*carried, text), schema, make)


def paragraph_blocks(docs: DataFrame, text: str, *carried: str) -> DataFrame:
    """(carried, n, heading, body): the heading blocks of each text; null texts have none."""

    def make():
        return lambda *values: [(*values[:-1], n, heading, body) for n, (heading, body) in enumerate(iter_blocks(values[-1]))]

    return map_rows(docs.where(F.col(text).isNotNull()).select(*carried, text), _carried(docs, carried) + "n int, heading string, body string", make)


def sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, rf"(?<=[.!?]){WS}+(?=[A-Z\"'(])"), trim_space), lambda x: x != "")


def embedding_input(text: Column, section: Column, title: Column | None = None) -> Column:
    """What is embedded: title and section, where there are any, above the text."""
    parts = [F.when(section != "", F.concat(F.lit("Section: "), section)), text]
    if title is not None:
        parts.insert(0, F.when(title != "", F.concat(F.lit("Title: "), title)))
    return F.concat_ws("\n\n", *parts)


def rag_document(chunk: DataFrame) -> DataFrame:
    """(chunk_id, document): a chunk as a JSON document for retrieval frameworks."""
    meta = F.struct(
        F.col("url").alias("source"), "domain", "title", F.col("chunk_index").alias("chunkIndex"), F.col("total_chunks").alias("totalChunks"),
        F.col("section_heading").alias("section"), F.col("word_count").alias("wordCount"), F.col("token_estimate").alias("tokenEstimate"),
    )
    return chunk.select("chunk_id", F.to_json(F.struct(F.col("text").alias("pageContent"), meta.alias("metadata")), {"ignoreNullFields": "false"}).alias("document"))
