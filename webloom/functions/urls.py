"""URL column functions: parts, normal form, fingerprint, class, resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Query names that never tell pages apart.
BLOCKED = ["utm_source", "utm_medium", "utm_campaign", "fbclid", "gclid", "ref", "source", "session"]
#: Ports that go without saying.
DEFAULT_PORTS = {"http": "80", "https": "443", "ftp": "21", "ws": "80", "wss": "443"}
#: Words in a URL that tell its class, in the order of their precedence.
CLASSES = [("detail", r"(?i)/product|item|detail"), ("listing", r"(?i)page=|category|list"), ("article", r"(?i)blog|news|article")]
SHAPE = r"^[ ]*([A-Za-z][A-Za-z0-9+.-]*)://([^/?#\\]*)([^?#]*)(\?[^#]*)?(#.*)?$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(F.trim(url), SHAPE, group)


def is_url(url: Column) -> Column:
    """A URL with scheme and non-empty host without spaces."""
    return F.coalesce(F.trim(url).rlike(SHAPE) & _raw_host(url).rlike(r"^[^\s<>^|%\[\]]+$|^\[[0-9A-Fa-f:.]+\]$"), F.lit(False))


def protocol(url: Column) -> Column:
    return F.lower(_part(url, 1))


def _raw_host(url: Column) -> Column:
    authority = F.regexp_replace(_part(url, 2), r"^.*@", "")
    return F.regexp_replace(authority, r":[0-9]*$", "")


def hostname(url: Column) -> Column:
    return F.lower(_raw_host(url))


def port(url: Column) -> Column:
    """The port that is written and not the default one, else empty."""
    written = F.regexp_extract(_part(url, 2), r":([0-9]+)$", 1)
    default = F.coalesce(*[F.when(protocol(url) == s, F.lit(p)) for s, p in DEFAULT_PORTS.items()], F.lit(""))
    return F.when(written == default, F.lit("")).otherwise(written)


def user_info(url: Column) -> Column:
    return F.regexp_extract(_part(url, 2), r"^(.*@)", 1)


def clean_path(raw: Column) -> Column:
    """A path with dot segments resolved, at least ``/``."""
    raw = F.regexp_replace(raw, r"\\", "/")
    parts = F.split(F.substring(raw, F.lit(2), F.length(raw)), "/", -1)
    dots = lambda s: F.lower(F.regexp_replace(s, "(?i)%2e", "."))
    folded = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, s: F.when(dots(s) == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(dots(s) == ".", done).otherwise(F.concat(done, F.array(s))),
    )
    ends = dots(F.element_at(parts, -1)).isin(".", "..")
    resolved = F.concat(F.lit("/"), F.array_join(folded, "/"), F.when(ends & (F.size(folded) > 0), F.lit("/")).otherwise(F.lit("")))
    return F.when(raw == "", F.lit("/")).when(F.lower(raw).rlike(r"/(\.|%2e){1,2}(/|$)"), resolved).otherwise(F.regexp_replace(raw, " ", "%20"))


def pathname(url: Column) -> Column:
    return clean_path(_part(url, 3))


def search(url: Column) -> Column:
    """The query with its question mark; a bare mark counts as none."""
    found = _part(url, 4)
    return F.when(found == "?", F.lit("")).otherwise(found)


def fragment(url: Column) -> Column:
    found = _part(url, 5)
    return F.when(found == "#", F.lit("")).otherwise(found)


def clean_query(query: Column) -> Column:
    """A query (without its mark) without blocked names, sorted by name, stable, and encoded anew as a form."""
    decode = lambda s: F.coalesce(F.try_url_decode(s), F.regexp_replace(s, r"\+", " "))
    pairs = F.transform(
        F.filter(F.split(query, "&", -1), lambda p: p != ""),
        lambda p, i: F.struct(decode(F.substring_index(p, "=", 1)).alias("k"), decode(F.regexp_replace(p, r"^[^=]*=?", "")).alias("v"), i.alias("i")),
    )
    kept = F.filter(pairs, lambda p: ~p["k"].isin(BLOCKED))
    swapped = lambda s: F.translate(s, UPPER + LOWER, LOWER + UPPER)  # noqa: E731  small letters sort before capitals
    ordered = F.array_sort(F.transform(kept, lambda p: F.struct(F.lower(p["k"]).alias("a"), swapped(p["k"]).alias("b"), p["i"].alias("i"), p["k"].alias("k"), p["v"].alias("v"))))
    return F.array_join(F.transform(ordered, lambda p: F.concat(F.url_encode(p["k"]), F.lit("="), F.url_encode(p["v"]))), "&")


def normalize(url: Column) -> Column:
    """The form in which URLs are compared; null for what is no URL.

    Host and scheme in small letters, no default port, no fragment, dot segments resolved, blocked
    query names dropped, the rest sorted, and one slash taken off the end of the whole.
    """
    query = clean_query(F.regexp_replace(_part(url, 4), r"^\?", ""))
    port_ = port(url)
    whole = F.concat(
        protocol(url), F.lit("://"), user_info(url), hostname(url), F.when(port_ == "", F.lit("")).otherwise(F.concat(F.lit(":"), port_)),
        pathname(url), F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)),
    )
    return F.when(is_url(url), F.regexp_replace(whole, "/$", ""))


def with_normal(rows: DataFrame, url: str, name: str = "normal") -> DataFrame:
    """``rows`` plus the normal form; as ``normalize``, but each pattern runs once for a row."""
    parts = with_parts(rows, url, "_n")
    c = lambda k: F.col(f"_n_{k}")
    query = clean_query(F.regexp_replace(c("search"), r"^\?", ""))
    whole = F.regexp_replace(F.concat(join_parts("_n", "path"), F.lit("?"), query), r"\?$", "")
    usable = (c("scheme") != "") & c("host").rlike(r"^[^\s<>^|%\[\]]+$|^\[[0-9a-f:.]+\]$")
    return drop_parts(parts.withColumn(name, F.when(usable, F.regexp_replace(whole, "/$", ""))), "_n")


def fingerprint(url: Column) -> Column:
    return F.sha2(url, 256)


def classify(url: Column) -> Column:
    out = F.lit("unknown")
    for name, pattern in reversed(CLASSES):
        out = F.when(url.rlike(pattern), F.lit(name)).otherwise(out)
    return F.when(url.isNotNull(), out)


def extension(url: Column) -> Column:
    """What follows the last dot of the path, in small letters; the whole path where there is no dot."""
    return F.lower(F.element_at(F.split(pathname(url), r"\.", -1), -1))


#: Columns that with_parts adds, behind a prefix.
PARTS = ("scheme", "user", "host", "port", "path", "search", "hash")


def with_parts(rows: DataFrame, url: str, prefix: str) -> DataFrame:
    """``rows`` plus the parts of ``url`` as columns.

    Both steps go through a generator of one row: the optimizer does not copy expressions across it,
    so each pattern runs once for a row however often a part is used later.
    """
    raw = {"s": _part(F.col(url), 1), "a": _part(F.col(url), 2), "p": _part(F.col(url), 3), "q": _part(F.col(url), 4), "h": _part(F.col(url), 5)}
    rows = rows.select("*", F.inline(F.array(F.struct(*[v.alias(f"{prefix}_{k}") for k, v in raw.items()]))))
    c = lambda k: F.col(f"{prefix}_{k}")
    scheme = F.lower(c("s"))
    written = F.regexp_extract(c("a"), r":([0-9]+)$", 1)
    default = F.coalesce(*[F.when(scheme == s, F.lit(p)) for s, p in DEFAULT_PORTS.items()], F.lit(""))
    out = {
        "scheme": scheme,
        "user": F.regexp_extract(c("a"), r"^(.*@)", 1),
        "host": F.lower(F.regexp_replace(F.regexp_replace(c("a"), r"^.*@", ""), r":[0-9]*$", "")),
        "port": F.when(written == default, F.lit("")).otherwise(written),
        "path": clean_path(c("p")),
        "search": F.when(c("q") == "?", F.lit("")).otherwise(c("q")),
        "hash": F.when(c("h") == "#", F.lit("")).otherwise(c("h")),
    }
    return rows.select("*", F.inline(F.array(F.struct(*[v.alias(f"{prefix}_{k}") for k, v in out.items()])))).drop(*[f"{prefix}_{k}" for k in raw])


def drop_parts(rows: DataFrame, *prefixes: str) -> DataFrame:
    return rows.drop(*[f"{p}_{k}" for p in prefixes for k in PARTS])


def join_parts(prefix: str, *parts: str) -> Column:
    """Scheme, host and the given parts put together again."""
    c = lambda k: F.col(f"{prefix}_{k}")
    port_ = F.when(c("port") == "", F.lit("")).otherwise(F.concat(F.lit(":"), c("port")))
    return F.concat(c("scheme"), F.lit("://"), c("user"), c("host"), port_, *map(c, parts))


def resolve(href: Column, prefix: str) -> Column:
    """``href`` against the page whose parts stand behind ``prefix``: absolute, scheme-relative, root-relative, query, fragment and path-relative."""
    href = F.trim(href)
    origin = join_parts(prefix)
    c = lambda k: F.col(f"{prefix}_{k}")
    folder = F.regexp_replace(c("path"), "[^/]*$", "")
    return (
        F.when(href == "", F.concat(origin, c("path"), c("search")))
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(c("scheme"), F.lit(":"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(origin, href))
        .when(F.startswith(href, F.lit("?")), F.concat(origin, c("path"), href))
        .when(F.startswith(href, F.lit("#")), F.concat(origin, c("path"), c("search"), href))
        .otherwise(F.concat(origin, folder, href))
    )


def proxy_parts(url: Column) -> Column:
    """A proxy's URL as server, user and password, percent-decoded."""
    raw = F.regexp_replace(user_info(url), "@$", "")
    decode = lambda c: F.when(c != "", F.coalesce(F.try_url_decode(F.regexp_replace(c, r"\+", "%2B")), c))
    port_ = port(url)
    server = F.concat(protocol(url), F.lit("://"), hostname(url), F.when(port_ == "", F.lit("")).otherwise(F.concat(F.lit(":"), port_)))
    return F.struct(server.alias("server"), decode(F.substring_index(raw, ":", 1)).alias("username"), decode(F.regexp_extract(raw, "^[^:]*:(.*)$", 1)).alias("password"))
