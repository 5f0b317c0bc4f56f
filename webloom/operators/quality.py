"""Content quality of fetched pages: features, six scores, total, type, flags and gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions import quality as Q


#: Columns of the markup features.
MARKUP = ("body_units", "page_units", "h1_count", "h2_count", "h3_count", "p_count", "li_count", "has_meta_date", "has_date", "has_price")


def score_content(pages: DataFrame, text: Column, html: Column | None, published: Column) -> DataFrame:
    """``pages`` plus features, scores, ``total``, ``content_type``, ``flags`` and ``passes``; a narrow plan without shuffle.

    The features of the html are columns of ``pages`` already (``with_markup``) or are taken from
    ``html`` where it is given; null ones count as those of empty html.  A null or empty text is not scored: total 0, no
    flags, no pass, the rest null.
    """
    has = text.isNotNull() & (text != "")
    markup = {k: F.col(k) for k in MARKUP} if html is None else Q.markup_features(F.coalesce(html, F.lit("")))
    # taken without condition, as the optimizer shares subexpressions only then
    out = pages.withColumns(Q.text_features(F.coalesce(text, F.lit(""))) | {k: F.coalesce(v, F.lit(False) if k.startswith("has_") else F.lit(0)) for k, v in markup.items()})
    out = out.withColumns({"word_count": F.when(has, F.col("word_count")), "has_any_date": published.isNotNull() | F.col("has_date")})
    out = out.withColumns(Q.scores())
    for step in Q.verdict():
        out = out.withColumns(step)
    unscored = F.col("word_count").isNull()
    return out.withColumns(
        {
            **{p: F.when(~unscored, F.col(p)) for p in (*Q.PARTS, "content_type", "avg_words_per_sentence", "density_ratio")},
            "sentence_count": F.when(~unscored, F.col("sentence_count")),
            "total": F.when(unscored, 0).otherwise(F.col("total")),
            "flags": F.when(unscored, F.array().cast("array<string>")).otherwise(F.col("flags")),
            "passes": F.when(unscored, False).otherwise(F.col("passes")),
        }
    )


def with_markup(pages: DataFrame, fetched: DataFrame) -> DataFrame:
    """Pages joined to the features of the html they came from, which is read in a narrow pass and never shuffled."""
    few = fetched.where(F.col("html").isNotNull()).select("fetch_id", *[v.alias(k) for k, v in Q.markup_features(F.col("html")).items()])
    return pages.join(few, "fetch_id", "left")
