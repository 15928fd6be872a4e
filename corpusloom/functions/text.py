"""String, date and URL scalars as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import bound

#: Unicode white space, as a regular expression class of Java and RE2.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
PARAGRAPH_BREAK = r"\n" + SPACE + r"*\n+"
UNSAFE = r'[\\/:*?"<>|]'


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def words(c: Column, space: str = SPACE) -> Column:
    """Words between white space; no empty ones."""
    return F.filter(F.split(c, space + "+"), lambda w: w != "")


def paragraphs(c: Column, breaks: str = PARAGRAPH_BREAK) -> Column:
    """Word arrays of the non-blank paragraphs."""
    return F.filter(F.transform(F.split(c, breaks), lambda p: words(p)), lambda p: F.size(p) > 0)


def record_id(prefix: str, year: Column, serial: Column) -> Column:
    return F.concat(F.lit(prefix + "_"), year.cast("string"), F.lit("_"), serial)


def normalized_date(c: Column) -> Column:
    """ISO date of day-first or ISO input; NULL if empty or awaited; the stripped input if it is no date."""
    s = F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")
    parsed = F.coalesce(*(F.try_to_date(s, fmt) for fmt in ("d/M/yyyy", "d-M-yyyy", "yyyy-M-d", "d.M.yyyy")))
    return F.when(c.isNull() | (c == "") | F.lower(c).contains("awaited"), None).otherwise(F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), s))


def typed_date(c: Column) -> Column:
    """The normalized date where it is one, else NULL."""
    return F.try_to_date(normalized_date(c), "yyyy-MM-dd")


def total_hint(c: Column) -> Column:
    """n of the first "of n entries", commas removed."""
    return F.try_to_number(F.nullif(F.replace(F.regexp_extract(c, r"(?i)of\s+([\d,]+)\s+entries", 1), F.lit(","), F.lit("")), F.lit("")), F.lit("9999999999")).cast("long")


def snippet(c: Column, chars: int = 280) -> Column:
    return F.when(F.length(c) > chars, F.concat(F.left(c, F.lit(chars)), F.lit("..."))).otherwise(c)


def url_path(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*", ""), r"[?#].*$", "")


def unquoted(c: Column) -> Column:
    """Percent escapes decoded; plus signs and malformed escapes stay."""
    kept = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(kept), c)


def safe_filename(url: Column, default: str = "unnamed.pdf") -> Column:
    """Basename of the URL's path, decoded, without characters that file systems refuse; 200 characters, then .pdf."""
    name = F.coalesce(blank_to_null(unquoted(F.substring_index(url_path(url), "/", -1))), F.lit(default))
    name = F.left(F.regexp_replace(name, UNSAFE, "_"), F.lit(200))
    return F.when(F.lower(name).endswith(".pdf"), name).otherwise(F.concat(name, F.lit(".pdf")))


def basename(path: Column) -> Column:
    """Last segment of a path with either separator."""
    return F.substring_index(F.replace(path, F.lit("\\"), F.lit("/")), "/", -1)


#: Schemes that resolve references, of which some keep parameters apart from the last segment (fixed values).
WITH_PARAMETERS = ("", "http", "https", "ftp", "sftp")
HIERARCHICAL = (*WITH_PARAMETERS, "file", "ws", "wss")
#: Scheme, authority, path, query, fragment; and of a path what precedes the parameters of the last segment, and these.
_URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_PATH = r"(?s)^((?:.*/)?[^/;]*)(?:;([^/]*))?$"


def _url_parts(c: Column, scheme: Column | None = None) -> Column:
    """A URL as a struct; scheme: what it is if none is given."""
    clean = F.regexp_replace(F.regexp_replace(c, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")

    def parts(u: Column) -> Column:
        own = F.lower(F.regexp_extract(u, _URL, 1))
        own = own if scheme is None else F.when(own == "", scheme).otherwise(own)
        path = F.regexp_extract(u, _URL, 3)
        apart = own.isin(*WITH_PARAMETERS)
        return F.struct(
            own.alias("scheme"),
            F.regexp_extract(u, _URL, 2).alias("netloc"),
            F.when(apart, F.regexp_extract(path, _PATH, 1)).otherwise(path).alias("path"),
            F.when(apart, F.regexp_extract(path, _PATH, 2)).otherwise("").alias("params"),
            F.regexp_extract(u, _URL, 4).alias("query"),
            F.regexp_extract(u, _URL, 5).alias("fragment"),
        )

    return bound(clean, parts)


def _merged_path(base: Column, path: Column) -> Column:
    """A reference's path against the base's: joined, then dot segments taken away by a stack of segments."""
    above = bound(F.split(base, "/"), lambda b: F.when(b[F.size(b) - 1] != "", F.slice(b, 1, F.size(b) - 1)).otherwise(b))
    joined = bound(
        F.concat(above, F.split(path, "/")),
        lambda j: F.concat(F.slice(j, 1, 1), F.filter(F.slice(j, 2, F.greatest(F.size(j) - 2, F.lit(0))), lambda x: x != ""), F.when(F.size(j) > 1, F.slice(j, -1, 1)).otherwise(F.array().cast("array<string>"))),
    )
    segments = F.when(path.startswith("/"), F.split(path, "/")).otherwise(joined)

    def resolved(parts: Column) -> Column:
        none = F.array().cast("array<string>")
        pop = lambda stack: F.slice(stack, 1, F.greatest(F.size(stack) - 1, F.lit(0)))
        stack = F.aggregate(parts, none, lambda s, x: F.when(x == "..", pop(s)).when(x == ".", s).otherwise(F.concat(s, F.array(x))))
        last = F.element_at(parts, -1)
        return F.array_join(F.concat(stack, F.when(last.isin(".", ".."), F.array(F.lit(""))).otherwise(none)), "/")

    return F.coalesce(blank_to_null(bound(segments, resolved)), F.lit("/"))


def _url_text(scheme: Column, netloc: Column, path: Column, params: Column, query: Column, fragment: Column) -> Column:
    def text(url: Column) -> Column:
        rooted = F.concat(F.lit("//"), netloc, F.when((url != "") & ~url.startswith("/"), F.concat(F.lit("/"), url)).otherwise(url))
        bare = F.when(url.startswith("//") | ((scheme != "") & ((url == "") | url.startswith("/"))), F.concat(F.lit("//"), url)).otherwise(url)
        after = lambda sign, c: F.when(c != "", F.concat(F.lit(sign), c)).otherwise("")
        return F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""), F.when(netloc != "", rooted).otherwise(bare), after("?", query), after("#", fragment))

    return bound(F.when(params != "", F.concat(path, F.lit(";"), params)).otherwise(path), text)


def resolved_url(base: Column, href: Column) -> Column:
    """A reference against its base, as RFC 3986 says it and browsers' libraries do it; NULL if one is NULL. Expressions only.

    A reference of another scheme, or of one that is not hierarchical, is itself; an empty one is the base.
    """
    def resolve(pair: Column) -> Column:
        return bound(F.struct(pair["b"].alias("b"), _url_parts(pair["h"], pair["b"]["scheme"]).alias("u"), pair["h"].alias("h")), joined)

    def joined(x: Column) -> Column:
        b, u = x["b"], x["u"]
        same = u["path"].eqNullSafe("") & u["params"].eqNullSafe("")
        netloc = b["netloc"]
        whole = _url_text(u["scheme"], u["netloc"], u["path"], u["params"], u["query"], u["fragment"])
        here = _url_text(u["scheme"], netloc, b["path"], b["params"], F.when(u["query"] != "", u["query"]).otherwise(b["query"]), u["fragment"])
        moved = _url_text(u["scheme"], netloc, _merged_path(b["path"], u["path"]), u["params"], u["query"], u["fragment"])
        foreign = (u["scheme"] != b["scheme"]) | ~u["scheme"].isin(*HIERARCHICAL)
        return F.when(foreign, x["h"]).when(u["netloc"] != "", whole).when(same, here).otherwise(moved)

    h = F.regexp_replace(href, f"^{SPACE}+|{SPACE}+$", "")
    pair = F.struct(_url_parts(base).alias("b"), h.alias("h"))
    return F.when(base.isNull() | href.isNull(), None).when(base == "", h).when(h == "", base).otherwise(bound(pair, resolve))


def metadata_card(case_info: Column, year: Column, category: Column, decision_date: Column, neutral_citation: Column, other_citation: Column, sc_status: Column, remarks: Column) -> Column:
    """Eight labelled lines, each with its fallback for NULL or empty (fixed values)."""
    lines = (
        ("Case: ", case_info, "Unknown"),
        ("Year: ", year, "None"),
        ("Category: ", category, "Unspecified"),
        ("Decision date: ", decision_date, "Awaited/unknown"),
        ("Neutral citation: ", neutral_citation, "None"),
        ("Other citation: ", other_citation, "None"),
        ("Supreme Court status: ", sc_status, "Not appealed to the Supreme Court"),
        ("Summary/remarks: ", remarks, "None recorded"),
    )
    return F.concat_ws("\n", *(F.concat(F.lit(label), F.coalesce(blank_to_null(c.cast("string")), F.lit(default))) for label, c, default in lines))


def looks_like_pdf(content: Column) -> Column:
    """The PDF magic within the first 1024 bytes (content: binary or string)."""
    return F.coalesce(F.instr(F.substring(content.cast("binary"), 1, 1024).cast("string"), "%PDF-") > 0, F.lit(False))
