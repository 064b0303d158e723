"""URLs: domains, canonical forms, extensions, and lists of links in cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Formats that can be fetched, and file extensions by content type (fixed values).
SUPPORTED = ("pdf", "docx", "xml", "html", "pptx", "csv", "md")
CONTENT_TYPES = {
    "application/pdf": "pdf",
    "text/html": "html",
    "application/xhtml+xml": "html",
    "application/xml": "xml",
    "text/xml": "xml",
    "text/csv": "csv",
    "text/markdown": "md",
    "application/msword": "doc",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "docx",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation": "pptx",
}


def _schemed(url: Column) -> Column:
    return F.when(F.rlike(url, F.lit("^https?://")), url).otherwise(F.concat(F.lit("https://"), url))


def base_domain(url: Column) -> Column:
    """Scheme and lower-case authority, with https where no scheme is given; empty if there is no authority."""
    authority = F.lower(F.regexp_extract(_schemed(url), r"^https?://([^/?#]*)", 1))
    return F.when(F.coalesce(authority, F.lit("")) == "", "").otherwise(F.concat(F.regexp_extract(_schemed(url), "^https?://", 0), authority))


def canonical_url(url: Column) -> Column:
    """The form under which URLs count as equal: lower-case host, single slashes, sorted query, no fragment.

    Query values are compared as written: an escape sequence and the character it stands for are told apart.
    """
    full = _schemed(url)
    scheme = F.lower(F.regexp_extract(full, "^[A-Za-z]+", 0))
    authority = F.lower(F.regexp_extract(full, r"^[A-Za-z]+://([^/?#]*)", 1))
    path = F.regexp_replace(F.regexp_extract(full, r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1), "/+", "/")
    query = F.regexp_extract(full, r"^[^?#]*\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    keyed = F.transform(pairs, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.when(F.instr(p, "=") > 0, F.regexp_extract(p, "=(.*)$", 1)).otherwise("").alias("v")))
    ordered = F.array_join(F.transform(F.array_sort(keyed), lambda p: F.concat(p["k"], F.lit("="), p["v"])), "&")
    out = F.concat(scheme, F.lit("://"), authority, path, F.when(ordered != "", F.concat(F.lit("?"), ordered)).otherwise(""))
    return F.when(F.coalesce(F.trim(url), F.lit("")) == "", "").otherwise(out)


def url_extension(url: Column) -> Column:
    """The path's extension in lower case; bin where there is none."""
    path = F.regexp_extract(_schemed(url), r"^https?://[^/?#]*([^?#]*)", 1)
    found = F.lower(F.regexp_extract(path, r"[^/.][^/]*\.([^./]+)$", 1))
    return F.when(F.coalesce(found, F.lit("")) == "", "bin").otherwise(found)


def is_supported(extension: Column) -> Column:
    return extension.isin(*SUPPORTED)


def disposition_extension(header: Column) -> Column:
    """The extension of the file name in a Content-Disposition header, the extended notation first."""
    extended = F.regexp_extract(header, r"(?i)filename\*\s*=\s*[^']*'[^']*'([^;]+)", 1)
    plain = F.regexp_extract(header, r"(?i)filename\s*=\s*\"?([^\";]+)", 1)
    name = F.when(extended != "", F.try_url_decode(extended)).otherwise(plain)
    found = F.lower(F.regexp_extract(F.trim(name), r"\.([A-Za-z0-9]+)$", 1))
    return F.when(found != "", found)


def type_extension(content_type: Column) -> Column:
    kind = F.lower(F.trim(F.substring_index(content_type, ";", 1)))
    return F.element_at(F.create_map(*[F.lit(x) for kv in CONTENT_TYPES.items() for x in kv]), kind)


def magic_extension(head: Column) -> Column:
    """The extension that a file's first bytes (a binary column) tell."""
    text = F.decode(F.substring(head, 1, 256), "ISO-8859-1")
    start = F.lower(F.ltrim(text))
    office = F.when(F.instr(text, "word/") > 0, "docx").when(F.instr(text, "ppt/") > 0, "pptx")
    return (
        F.when(F.startswith(text, F.lit("%PDF-")), "pdf")
        .when(F.startswith(start, F.lit("<!doctype html")) | F.startswith(start, F.lit("<html")), "html")
        .when(F.startswith(start, F.lit("<?xml")), "xml")
        .when(F.startswith(text, F.lit("PK")), office)
    )


def inferred_extension(url: Column, disposition: Column, content_type: Column, head: Column) -> Column:
    """A supported extension of the URL, else the headers', else the content's, else whatever the URL has."""
    own = url_extension(url)
    typed = type_extension(content_type)
    typed = F.when(typed.isin("htm", "xhtml"), "html").otherwise(typed)
    fits = lambda e: F.when(is_supported(e), e)
    return F.coalesce(fits(own), fits(disposition_extension(disposition)), fits(typed), magic_extension(head), own)


def links_of(cell: Column) -> Column:
    """The links in a cell: a JSON list or object, several URLs in a text, or one."""
    text = F.trim(cell)
    listed = F.from_json(text, "array<string>")
    objects = F.from_json(text, "array<struct<url:string,href:string,link:string>>")
    named = F.transform(objects, lambda o: F.coalesce(o["url"], o["href"], o["link"]))
    single = F.from_json(text, "struct<url:string,href:string,link:string>")
    found = F.transform(F.regexp_extract_all(text, F.lit(r"https?://\S+"), 0), lambda u: F.regexp_replace(u, r"[.,)]+$", ""))
    parts = F.filter(F.transform(F.split(text, "[;\\n]"), lambda p: F.trim(p)), lambda p: p != "")
    plain = (
        F.when(F.rlike(text, F.lit("[;\\n]")) & F.contains(text, F.lit("http")), parts)
        .when(F.size(found) > 1, found).when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array(text))
    )
    many = F.when(F.startswith(F.ltrim(F.substring(text, 2, 100)), F.lit("{")), named).otherwise(listed)
    out = F.when(F.startswith(text, F.lit("[")), F.coalesce(many, plain)).when(F.startswith(text, F.lit("{")), F.coalesce(F.array(F.coalesce(single["url"], single["href"], single["link"])), plain)).otherwise(plain)
    return F.filter(out, lambda u: F.coalesce(F.trim(u), F.lit("")) != "")
