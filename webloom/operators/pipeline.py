"""From html to page rows and chunk rows: extraction, scores, gate and chunks from one parse."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions.text import reading_time, trim_space
from webloom.operators import chunking, quality
from webloom.operators.extraction import document_meta, main_text, page_heading, page_title
from webloom.schemas import PAGES

EXTRACTED = ("description", "author", "published", "modified", "og_image", "lang")


def extract(fetched: DataFrame, key: str = "fetch_id", html: str = "html") -> DataFrame:
    """``fetched`` without its html, plus the extracted content, excerpt, metadata, title, h1 and the markup features.

    Each html is read once by the column functions and once by the parser; rows without html are left
    out, and one without main text has null content.
    """
    rows = fetched.where(F.col(html).isNotNull())
    h = F.col(html)
    seen = rows.withColumns({"title": F.nullif(page_title(h), F.lit("")), "h1": page_heading(h)} | quality.Q.markup_features(h))
    kept = [c for c in seen.columns if c != html]
    schema = ", ".join(f"{c} {t}" for c, t in seen.dtypes if c != html) + ", content string, excerpt string, " + ", ".join(f"{n} string" for n in EXTRACTED)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts, metas = [main_text(x) for x in frame[html]], [document_meta(x) for x in frame[html]]
            yield frame[kept].assign(content=texts, excerpt=[t.split("\n")[0] if t else None for t in texts], **{n: [m[n] for m in metas] for n in EXTRACTED})

    return seen.mapInPandas(run, schema)


def page_rows(extracted: DataFrame, page_id: Column, content: str = "content") -> DataFrame:
    """Rows of the pages table from extracted rows with markup features: scores, type, flags, gate, counts and reading time.

    Missing values take the defaults of the table (score 0, no flags, no pass); an empty string is kept
    as it is and only null counts as missing.  What ``extracted`` lacks is null.
    """
    have = set(extracted.columns)
    text = trim_space(F.col(content)) if content in have else F.lit(None).cast("string")
    rows = extracted.withColumn(content, text)
    published = F.to_timestamp_ntz("published") if "published" in have else F.col("published_at") if "published_at" in have else F.lit(None).cast("timestamp_ntz")
    modified = F.to_timestamp_ntz("modified") if "modified" in have else F.col("modified_at") if "modified_at" in have else F.lit(None).cast("timestamp_ntz")
    rows = rows.withColumns({"published_at": published, "modified_at": modified, "page_id": page_id})
    scored = quality.score_content(rows, F.col(content), None, F.col("published_at"))
    words = F.coalesce("word_count", F.lit(0))
    made = {
        "content": F.col(content), "word_count": words, "reading_time": reading_time(words), "quality_score": F.col("total"), "quality_flags": F.col("flags"), "passes_quality_gate": F.col("passes"),
        **{f"quality_{p}": F.col(p) for p in quality.Q.PARTS}, "content_type": F.col("content_type"),
    }
    have = set(scored.columns)
    value = lambda f: made.get(f.name, F.col(f.name) if f.name in have else F.lit(None))
    return scored.select(*[value(f).cast(f.dataType).alias(f.name) for f in PAGES.fields])


def chunk_rows(pages: DataFrame, *carried: str, target: int = 512, overlap: int = 2, minimum: int = 50) -> DataFrame:
    """Chunks of the pages that pass the gate, with page_id, url_id and the ``carried`` columns."""
    rows = pages.where("passes_quality_gate").select("page_id", "url_id", *carried, "content")
    return chunking.chunk_texts(rows, "content", "page_id", "url_id", *carried, target=target, overlap=overlap, minimum=minimum)
