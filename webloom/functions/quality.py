"""Six-part content quality as columns of a text, its html and its publication date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webloom.functions.text import sentence_count, units, without_space, word_count

#: Phrases that tell boilerplate.
BOILERPLATE = [
    "cookie policy", "privacy policy", "terms of service", "all rights reserved", "subscribe to our newsletter", "follow us on", "share this",
    "read more", "click here", "learn more", "contact us", "about us", "home page", "skip to content", "back to top", "copyright",
]
#: Patterns of dates, prices and error pages.
DATE = r"20[0-9]{2}[-/][0-9]{2}[-/][0-9]{2}"
PRICE = r"(?i)\$[0-9,]+|€[0-9,]+|£[0-9,]+|add to cart|buy now"
ERROR = r"(?i)404|page not found|error 5[0-9][0-9]"
PUBLISHED = 'property="article:published_time"'
THRESHOLD = 25


def _steps(value: Column, steps: list[tuple[float, int]], last: int, inclusive: bool = False) -> Column:
    out = F.lit(last)
    for bound, points in reversed(steps):
        out = F.when(value <= bound if inclusive else value < bound, F.lit(points)).otherwise(out)
    return out


def body_markup(html: Column) -> Column:
    """The html without its first head and without scripts and styles."""
    low = F.lower(html)
    start = F.locate("<head", low)
    end = F.instr(F.substr(low, start), F.lit("</head>"))
    cut = F.concat(F.left(html, start - 1), F.substr(html, start + end + F.lit(len("</head>") - 1)))
    # where small letters take more room than capitals, places differ, and the pattern is used
    out = F.when(F.length(low) != F.length(html), F.regexp_replace(html, r"(?is)\A(.*?)<head.*?</head>", "$1")).when((start > 0) & (end > 0), cut).otherwise(html)
    out = F.regexp_replace(out, r"(?is)<script.*?</script>", "")
    return F.regexp_replace(out, r"(?is)<style.*?</style>", "")


def tag_count(html: Column, tag: str) -> Column:
    return F.regexp_count(html, F.lit(rf"(?i)<{tag}[\s>]"))


def markup_features(html: Column) -> dict[str, Column]:
    """What the scores take from the html: a dozen numbers, so that the html itself need not travel."""
    return {
        "body_units": units(body_markup(html)),
        "page_units": units(html),
        **{f"{tag}_count": tag_count(html, tag) for tag in ("h1", "h2", "h3", "p", "li")},
        "has_meta_date": F.contains(html, F.lit(PUBLISHED)) | F.contains(html, F.lit("datePublished")),
        "has_date": html.rlike(DATE),
        "has_price": html.rlike(PRICE),
    }


def text_features(text: Column) -> dict[str, Column]:
    """What the scores take from the text."""
    hits = F.lit(0)
    for phrase in BOILERPLATE:
        hits = hits + F.when(F.contains(F.lower(text), F.lit(phrase)), 1).otherwise(0)
    return {
        "word_count": word_count(text),
        "sentence_count": sentence_count(text),
        "letters": units(without_space(text)),
        "text_units": units(text),
        "boilerplate_hits": hits,
        "says_error": text.rlike(ERROR),
    }


def scores() -> dict[str, Column]:
    """The six parts, from the feature columns."""
    c = F.col
    size = F.when(c("body_units") > 0, c("body_units")).otherwise(c("page_units"))
    ratio = F.when(size > 0, c("text_units") / size).otherwise(F.lit(0.0))
    per_sentence = c("word_count") / c("sentence_count")
    ari = F.when(c("word_count") == 0, F.lit(0.0)).otherwise(F.lit(4.71) * (c("letters") / c("word_count")) + F.lit(0.5) * per_sentence - F.lit(21.43))
    readable = F.when(ari < 1, F.lit(4)).otherwise(_steps(ari, [(6, 12), (14, 20), (18, 15)], 8, inclusive=True))
    structure = (
        F.when(c("h1_count") >= 1, 6).otherwise(0)
        + F.when(c("h2_count") >= 2, 6).when(c("h2_count") == 1, 3).otherwise(0)
        + F.when(c("h3_count") >= 1, 3).otherwise(0)
        + F.when(c("p_count") >= 3, 3).when(c("p_count") >= 1, 1).otherwise(0)
        + F.when(c("li_count") >= 3, 2).otherwise(0)
    )
    return {
        "avg_words_per_sentence": F.floor(per_sentence * 10 + 0.5) / 10,
        "density_ratio": ratio,
        "length_score": _steps(c("word_count"), [(50, 2), (150, 8), (500, 14), (2000, 18)], 20),
        "density_score": F.when(ratio < 0.03, F.when(c("word_count") < 200, 2).otherwise(8)).otherwise(_steps(ratio, [(0.15, 10), (0.30, 15)], 20)),
        "readability_score": F.when(per_sentence > 40, F.greatest(F.lit(0), readable - 5)).otherwise(readable),
        "structure_score": F.least(F.lit(20), structure),
        "uniqueness_score": F.when(c("boilerplate_hits") >= 5, 2).when(c("boilerplate_hits") >= 3, 5).otherwise(10),
        "freshness_score": F.when(c("has_meta_date"), 10).when(c("has_any_date"), 6).otherwise(2),
    }


PARTS = ("length_score", "density_score", "readability_score", "structure_score", "uniqueness_score", "freshness_score")


def verdict() -> list[dict[str, Column]]:
    """Total, then type, then flags, then gate, each from the columns before it."""
    c = F.col
    total = sum((c(p) for p in PARTS[1:]), c(PARTS[0])).cast("int")
    error = c("says_error") & (c("word_count") < 100)
    navigation = (c("p_count") < 2) & (c("li_count") > 10) & (c("word_count") < 300)
    docs = (c("h2_count") + c("h3_count") >= 3) & (c("li_count") >= 5) & (c("word_count") >= 200)
    kind = (
        F.when(error, "error").when(c("has_price"), "product").when(navigation, "navigation").when(docs, "docs")
        .when(c("total") < 30, "thin").when(c("total") >= 70, "rich").otherwise("article")
    )
    flag = lambda name, when: F.when(when, F.lit(name))
    flags = F.array_compact(
        F.array(
            flag("STUB_CONTENT", c("word_count") < 50),
            flag("LOW_TEXT_DENSITY", (c("density_ratio") < 0.03) & (c("word_count") < 200)),
            flag("WALL_OF_TEXT", c("word_count") / c("sentence_count") > 40),
            flag("NO_HEADINGS", c("h1_count") < 1),
            flag("BOILERPLATE_HEAVY", c("boilerplate_hits") >= 5),
            flag("ERROR_PAGE", c("content_type") == "error"),
            flag("NAVIGATION_PAGE", c("content_type") == "navigation"),
        )
    )
    gate = (c("total") >= THRESHOLD) & ~F.array_contains("flags", "ERROR_PAGE") & (c("content_type") != "navigation")
    return [{"total": total}, {"content_type": kind}, {"flags": flags}, {"passes": gate}]
