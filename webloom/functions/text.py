"""Text column functions with the string semantics of the browser language: its white space and its lengths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space class, as read by Java and RE2 alike, and its characters.
SPACE = r"\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"
WS = f"[{SPACE}]"
SPACES = "\t\n\x0b\f\r \xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"


def units(text: Column) -> Column:
    """Length in UTF-16 units."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.length(text)).otherwise(F.floor(F.octet_length(F.encode(text, "UTF-16BE")) / 2)).cast("int")


def without_space(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def trim_space(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{WS}+|{WS}+\z", "")


def collapse_space(text: Column) -> Column:
    return F.regexp_replace(text, f"{WS}+", " ")


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"{WS}+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def sentence_count(text: Column) -> Column:
    """Ends of sentences, at least one."""
    return F.greatest(F.regexp_count(text, F.lit(rf"[.!?]+[{SPACE}\"')]+|[.!?]+\z")), F.lit(1))


def strip_tags(markup: Column) -> Column:
    return F.regexp_replace(markup, "<[^>]+>", " ")


def reading_time(count: Column) -> Column:
    """Minutes at 200 words each, at least one."""
    return F.greatest(F.lit(1), F.ceil(count / 200)).cast("int")


def token_estimate(text: Column) -> Column:
    return F.ceil(units(text) / 4).cast("int")


def preview(text: Column, size: int = 120) -> Column:
    return F.left(text, F.lit(size))


def pad_right(text: Column, size: int) -> Column:
    """Pads; never cuts a longer text."""
    return F.when(F.length(text) < size, F.rpad(text, size, " ")).otherwise(text)


def decode_lossy(raw: Column) -> Column:
    """Bytes as text; broken sequences become replacement characters."""
    return F.make_valid_utf8(raw.cast("string"))
