"""Problem 3: lines repeated across the documents of one source.

PrefixSpan over the line identifiers of each document, by source.  Support is the number of distinct
documents.  Level 1 finds the frequent lines; every further level grows each frequent sequence by a
line that follows it within MAX_GAP frequent lines in its projected documents.  A sequence that skips
the same line wherever it occurs says no more than the one with that line in it, and is not grown
(the backward check of closed patterns): that keeps frames of many lines from growing every subset.
The lines marked are those of all mined sequences, single lines included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.session import materialize

MIN_DOCUMENTS = 4
SHARE = 0.1
#: Occurrences of a source are spread over so many salts when they meet the frequent lines.
SALTS = 64
#: The next line of a sequence stands at most so many frequent lines further on.
MAX_GAP = 3
#: So many sequences of one length (8 bytes each) are broadcast to the documents; more are joined by source.
FEW = 500_000


def fold_line(line: Column) -> Column:
    """The form in which lines are compared."""
    return F.regexp_replace(F.lower(F.regexp_replace(F.regexp_replace(line, "[ \t]+", " "), "^ +| +$", "")), "[0-9]+", "0")


def line_sequences(docs: DataFrame, source: str, document: str, key: str, text: str) -> DataFrame:
    """(key, document, source, lines array<struct<no, a, b>>): 128 bits for each non-blank line.

    Rows with null source, document or text take no part.
    """
    lines = F.filter(
        F.transform(F.split(F.col(text), "\n", -1), lambda x, i: F.struct(i.cast("long").alias("no"), fold_line(x).alias("t"))),
        lambda s: s["t"] != "",
    )
    ids = F.transform(lines, lambda s: F.struct(s["no"].alias("no"), F.xxhash64(s["t"]).alias("a"), F.xxhash64(s["t"], F.lit(7)).alias("b")))
    return docs.where(F.col(text).isNotNull() & F.col(source).isNotNull() & F.col(document).isNotNull()).select(
        F.col(key).alias("key"), F.col(document).alias("document"), F.col(source).alias("source"), ids.alias("lines")
    )


def support_needed(sequences: DataFrame, min_documents: int, share: float) -> DataFrame:
    """(source, needed): distinct documents that make a sequence frequent; partial sums before the shuffle."""
    return (
        sequences.groupBy("document", "source").agg(F.lit(1).alias("one")).groupBy("source").agg(F.count("one").alias("documents"))
        .select("source", F.greatest(F.lit(min_documents).cast("long"), F.ceil(F.round(F.col("documents") * F.lit(share), 6))).alias("needed"))
    )


def frequent_lines(sequences: DataFrame, needed: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(source, a, b, support): level 1 of the growth."""
    seen = sequences.select("document", "source", F.explode(F.array_distinct(F.transform("lines", lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b"))))).alias("s"))
    each = seen.select("document", "source", "s.a", "s.b").groupBy("document", "source", "a", "b").agg(F.lit(1).alias("one"))
    counted = each.groupBy("source", "a", "b").agg(F.count("one").alias("support")).where(F.col("support") >= min_documents)
    return counted.join(needed, "source").where(F.col("support") >= F.col("needed")).drop("needed")


def mark(sequences: DataFrame, frequent: DataFrame) -> DataFrame:
    """(key, document, source, no, a, b): occurrences of frequent lines.  Both sides are salted, so a large source spreads.

    Spark takes the size of the salted side for that of ``frequent``, SALTS times too small, and would
    send it to all tasks through the driver; the hint has both sides meet in a shuffle at any size.
    """
    rows = sequences.select("key", "document", "source", F.explode("lines").alias("s")).select("key", "document", "source", "s.no", "s.a", "s.b")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)))
    side = frequent.select("source", "a", "b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    return rows.join(side.hint("merge"), ["source", "a", "b", "salt"], "left_semi").drop("salt")


def find_repeated_lines(
    docs: DataFrame, source: str, document: str, key: str, text: str = "content", min_documents: int = MIN_DOCUMENTS, share: float = SHARE, max_gap: int = MAX_GAP
) -> DataFrame:
    """(key, line_no): every occurrence of a line that belongs to a frequent sequence of its source.

    Null texts, sources and documents take no part, blank lines never count, repeated rows all come
    out, and several rows of one document count once.  Other columns of ``docs`` are ignored.
    """
    sequences = materialize(line_sequences(docs, source, document, key, text), "lines")
    mined = mine(sequences, min_documents, share, max_gap)
    lines = mined[0].select("source", "a", "b", F.col("id").alias("w"))
    used = mined[0].select("source", F.col("id").alias("w"))
    for level in mined[1:]:
        used = used.unionByName(level.select("source", "w"))
    found = mark(sequences, lines.join(used.distinct(), ["source", "w"], "left_semi"))
    return found.select(F.col("key").alias(key), F.col("no").alias("line_no"))


def remove_repeated_lines(docs: DataFrame, found: DataFrame, key: str, text: str = "content") -> DataFrame:
    """``docs`` with the found lines taken out of ``text``; rows without any stay as they are.

    ``key`` must be unique in ``docs``.
    """
    gone = found.groupBy(F.col(key).alias("_gone_key")).agg(F.collect_set("line_no").alias("_gone"))
    kept = F.array_join(F.filter(F.split(F.col(text), "\n", -1), lambda x, i: ~F.array_contains("_gone", i.cast("long"))), "\n")
    return docs.join(gone, docs[key] == F.col("_gone_key"), "left").withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(kept)).drop("_gone", "_gone_key")


def mine(sequences: DataFrame, min_documents: int, share: float, max_gap: int) -> list[DataFrame]:
    """The levels of the growth: (source, a, b, id, support), then (source, id, parent, w, support) for each further length.

    A document is one row with its frequent lines and the ends of the sequences that occur in it, so
    growing is a narrow step and only counts by (source, sequence), summed in each task first, are
    shuffled.  Each level is written before the next: the plan stays short and a lost executor costs
    one level.
    """
    needed = materialize(support_needed(sequences, min_documents, share), "needed")
    first = frequent_lines(sequences, needed, min_documents).withColumn("id", F.xxhash64("source", "a", "b"))
    first = materialize(first, "level1")
    occurrences = mark(sequences, first).select("key", "document", "source", "no", F.xxhash64("source", "a", "b").alias("w"))
    held = occurrences.groupBy("document", "source").agg(F.array_sort(F.collect_list(F.struct("key", "no", "w"))).alias("o"))
    # the rows of one document follow each other with a gap that no sequence can cross
    breaks = F.array_repeat(F.lit(None).cast("long"), max_gap)
    apart = F.flatten(F.transform("o", lambda x, i: F.when((i > 0) & (F.get("o", i - 1)["key"] != x["key"]), F.concat(breaks, F.array(x["w"]))).otherwise(F.array(x["w"]))))
    rows = held.select("source", apart.alias("items"))
    ends = F.filter(F.transform("items", lambda w, i: F.struct(i.cast("int").alias("at"), w.alias("id"))), lambda e: e["id"].isNotNull())
    rows = materialize(rows.withColumn("ends", ends), "grown1")
    levels = [first]
    while True:
        longer = rows.select("source", "items", _grow(max_gap).alias("longer")).where(F.size("longer") > 0)
        each = F.concat(
            F.array_distinct(F.transform("longer", lambda x: _count(x, "document"))),
            F.transform("longer", lambda x: _count(x, "place")),
            F.flatten(F.transform("longer", lambda x: F.transform(F.array_distinct(x["skipped"]), lambda w: _count(x, "skipped", w)))),
        )
        counted = longer.select("source", F.explode(each).alias("c")).select("source", "c.*").groupBy("source", "id", "kind", "line").agg(F.count("*").alias("n"), F.first("parent").alias("parent"), F.first("w").alias("w"))
        most = lambda kind: F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))
        judged = counted.groupBy("source", "id").agg(F.first("parent").alias("parent"), F.first("w").alias("w"), most("document").alias("support"), most("place").alias("places"), most("skipped").alias("skipped"))
        kept = judged.join(needed, "source").where((F.col("support") >= F.col("needed")) & (F.col("skipped") < F.col("places")))
        kept = materialize(kept.select("source", "id", "parent", "w", "support"), f"level{len(levels) + 1}")
        size = kept.count()
        if not size:
            return levels
        levels.append(kept)
        known = kept.groupBy("source").agg(F.collect_list("id").alias("known"))
        # the documents are never the side that is sent to all tasks, the sequences only while they are few
        known = F.broadcast(known) if size <= FEW else known.hint("merge")
        going = longer.join(known, "source").select(
            "source", "items", F.array_distinct(F.transform(F.filter("longer", lambda x: F.array_contains("known", x["id"])), lambda x: F.struct(x["at"].alias("at"), x["id"].alias("id")))).alias("ends")
        )
        rows = materialize(going.where(F.size("ends") > 0), f"grown{len(levels)}")


def _grow(max_gap: int) -> Column:
    """All extensions of the ends of a row: (at, id, parent, w, skipped lines)."""
    step = lambda e, g: F.struct(
        (e["at"] + g).alias("at"), F.xxhash64(e["id"], F.get("items", e["at"] + g)).alias("id"), e["id"].alias("parent"), F.get("items", e["at"] + g).alias("w"),
        F.slice("items", e["at"] + 2, g - 1).alias("skipped"),
    )
    return F.flatten(F.transform("ends", lambda e: F.filter(F.transform(F.sequence(F.lit(1), F.lit(max_gap)), lambda g: step(e, g)), lambda x: x["w"].isNotNull())))


def _count(x: Column, kind: str, line: Column | None = None) -> Column:
    return F.struct(x["id"].alias("id"), F.lit(kind).alias("kind"), (F.lit(None).cast("long") if line is None else line).alias("line"), x["parent"].alias("parent"), x["w"].alias("w"))


def frequent_sequences(
    docs: DataFrame, source: str, document: str, key: str, text: str = "content", min_documents: int = MIN_DOCUMENTS, share: float = SHARE, max_gap: int = MAX_GAP
) -> DataFrame:
    """(source, pattern array<struct<a, b>>, support) of the frequent sequences of all lengths.

    A line follows the one before within ``max_gap`` lines, counted without blank and infrequent
    ones.  Left out are sequences that skip the same line wherever they occur.
    """
    mined = mine(materialize(line_sequences(docs, source, document, key, text), "lines"), min_documents, share, max_gap)
    item = F.struct("a", "b")
    lines = mined[0].select("source", F.col("id").alias("w"), item.alias("item"))
    last = mined[0].select("source", "id", F.array(item).alias("pattern"), "support")
    results = [last]
    for level, grown in enumerate(mined[1:], 2):
        before = last.select("source", F.col("id").alias("parent"), F.col("pattern").alias("head"))
        last = grown.join(before, ["source", "parent"]).join(lines, ["source", "w"]).select("source", "id", F.concat("head", F.array("item")).alias("pattern"), "support")
        last = materialize(last, f"patterns{level}")
        results.append(last)
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out.select("source", "pattern", "support")
