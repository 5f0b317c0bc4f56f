import math
import re

import pytest
from pyspark.sql import functions as F

from webloom.operators import chunking

WS = "[\\t\\n\\x0b\\f\\r \\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]"


def trim(s):
    return re.sub(f"^{WS}+|{WS}+$", "", s)


def units(s):
    return len(s.encode("utf-16-le")) // 2


def plain(text, target, overlap, minimum):
    """The rule as a plain loop."""
    blocks, heading, held = [], None, []
    for line in (trim(x) for x in text.split("\n")):
        if not line:
            continue
        if units(line) < 120 and not line.endswith(".") and re.match(f"[A-Z]|#+{WS}", line):
            if held:
                blocks.append((heading, " ".join(held)))
                held = []
            heading = re.sub(f"^#+{WS}*", "", line)
        else:
            held.append(line)
    if held:
        blocks.append((heading, " ".join(held)))
    out, at = [], 0
    for heading, body in blocks:
        parts = [p for p in (trim(x) for x in re.split(f"(?<=[.!?]){WS}+(?=[A-Z\"'(])", body)) if p]
        i, before = 0, []
        while i < len(parts):
            cur, tokens = list(before), math.ceil(units(" ".join(before)) / 4)
            while i < len(parts):
                n = math.ceil(units(parts[i]) / 4)
                if tokens + n > target and len(cur) > overlap:
                    break
                cur.append(parts[i])
                tokens += n
                i += 1
            joined = trim(" ".join(cur))
            if math.ceil(units(joined) / 4) >= minimum:
                out.append((joined, math.ceil(units(joined) / 4), at, at + units(joined), heading))
            at += units(joined) + 1
            new = cur[len(before) :]
            before = new[-overlap:] if overlap else []
    return [(i, len(out), *c) for i, c in enumerate(out)]


FIELDS = ("chunk_index", "total_chunks", "text", "token_estimate", "char_start", "char_end", "section_heading")


def test_hand_derived(spark):
    df = spark.createDataFrame([("Intro\nAaaa bbbb. Cccc dddd. Eeee ffff.",)], "t string")
    rows = chunking.chunk_texts(df, "t", target=5, overlap=1, minimum=1).collect()
    assert [tuple(r[f] for f in FIELDS) + (r.word_count,) for r in rows] == [
        (0, 2, "Aaaa bbbb. Cccc dddd.", 6, 0, 21, "Intro", 4),
        (1, 2, "Cccc dddd. Eeee ffff.", 6, 22, 43, "Intro", 4),
    ]
    assert chunking.chunk_texts(df, "t", target=5, overlap=1, minimum=50).count() == 0


@pytest.mark.parametrize(("target", "overlap", "minimum"), [(512, 2, 50), (40, 1, 5), (20, 0, 1), (3, 2, 1)])
def test_against_the_plain_loop(spark, data, target, overlap, minimum):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    extra = [(-1, ""), (-2, None), (-3, " \n \n"), (-4, "# Head\n\n## Other\nBody one. Body two! (Three) four?\nEnd"), (-5, "😀😀😀😀. " * 30), (-6, "A. " * 3000)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    texts = {r.doc_id: r.text for r in docs.collect()}
    found: dict = {}
    for r in chunking.chunk_texts(docs, "text", "doc_id", target=target, overlap=overlap, minimum=minimum).collect():
        found.setdefault(r.doc_id, []).append(tuple(r[f] for f in FIELDS))
    want = {k: plain(t, target, overlap, minimum) for k, t in texts.items() if t}
    assert {k: sorted(v) for k, v in found.items()} == {k: v for k, v in want.items() if v}


def test_embedding_input(spark):
    df = spark.createDataFrame([("t", "s", "T"), ("t", None, ""), ("t", "", None)], "x string, s string, h string")
    found = df.select(chunking.embedding_input(F.col("x"), F.col("s"), F.col("h"))).collect()
    assert [r[0] for r in found] == ["Title: T\n\nSection: s\n\nt", "t", "t"]
