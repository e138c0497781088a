"""Text functions on columns: white space, lines, hashes, formulas, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Line ends besides CR LF: LF, VT, FF, CR, FS, GS, RS, NEL, LS, PS.
LINE_END = "\\r\\n|[\\n\\x0B\\f\\r\\x1C\\x1D\\x1E\\x85\\u2028\\u2029]"


def text_or_empty(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit(""))


def strip(x: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+\z", "")


def squash(x: Column) -> Column:
    """Without any Unicode white space."""
    return F.regexp_replace(x, r"(?U)\s+", "")


def collapse(x: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return strip(F.regexp_replace(x, r"(?U)\s+", " "))


def is_blank(x: Column) -> Column:
    return F.length(strip(text_or_empty(x))) == 0


def blank_to_null(x: Column) -> Column:
    kept = strip(text_or_empty(x))
    return F.when(F.length(kept) > 0, kept)


def lines(x: Column) -> Column:
    """Lines of a text, at every kind of line end; a last empty line is none."""
    parts = F.split(text_or_empty(x), LINE_END)
    return F.when(F.length(text_or_empty(x)) == 0, F.array().cast("array<string>")).when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def short_hash(x: Column) -> Column:
    """First 16 hex digits of SHA-256, of text or bytes."""
    return F.substring(F.sha2(x.cast("binary"), 256), 1, 16)


def hash_or_empty(x: Column) -> Column:
    """``short_hash``, and nothing for nothing."""
    return F.when(F.length(x) > 0, short_hash(x)).otherwise("")


def text_fingerprint(x: Column) -> Column:
    return hash_or_empty(squash(text_or_empty(x)))


def formulas(x: Column) -> Column:
    """Contents of ``$...$``, shortest first match on, in order."""
    return F.regexp_extract_all(text_or_empty(x), F.lit(r"\$(.+?)\$"), F.lit(1))


def formula_fingerprint(x: Column, squashed: bool = False) -> Column:
    """Hash of a text's sorted formulas, repeats kept; with ``squashed``, without their white space."""
    found = formulas(x)
    if squashed:
        found = F.filter(F.transform(found, squash), lambda f: F.length(f) > 0)
    return hash_or_empty(F.array_join(F.array_sort(found), " | "))


def joined_fingerprint(parts: Column) -> Column:
    """Hash of the sorted distinct parts."""
    return hash_or_empty(F.array_join(F.array_sort(F.array_distinct(F.filter(parts, lambda p: F.length(p) > 0))), " | "))


def unbalanced_dollars(x: Column) -> Column:
    """True for an odd number of ``$`` that no backslash escapes."""
    plain = F.regexp_replace(text_or_empty(x), r"(?s)\\.", "")
    return F.pmod(F.length(plain) - F.length(F.replace(plain, F.lit("$"), F.lit(""))), F.lit(2)) == 1


def source_position(paper: Column, path: Column, number: Column) -> Column:
    return F.concat_ws("#", paper, F.array_join(path, "/"), number)


def safe_file_name(title: Column) -> Column:
    """Characters that file systems refuse as ``_``, 80 characters at most, a name for no title."""
    kept = F.substring(F.regexp_replace(strip(text_or_empty(title)), r'[\\/:*?"<>|\s]+', "_"), 1, 80)
    return F.when(F.length(kept) > 0, kept).otherwise("paper")


def preview(x: Column, most: int = 70) -> Column:
    flat = collapse(text_or_empty(x))
    return F.when(F.length(flat) > most, F.concat(F.substring(flat, 1, most), F.lit("..."))).otherwise(flat)


def first_heading(x: Column) -> Column:
    """Text of the first ``#`` line."""
    return strip(F.regexp_extract(text_or_empty(x), r"(?m)^#+[ \t]*(.+)$", 1))


def split_numbered_id(x: Column, fallback: str) -> Column:
    """``name_0007`` as struct(prefix, number); other ids as (fallback, 0)."""
    number = F.regexp_extract(x, r"^(.*)_([0-9]+)$", 2)
    return F.when(F.length(number) > 0, F.struct(F.regexp_extract(x, r"^(.*)_([0-9]+)$", 1).alias("prefix"), number.cast("int").alias("number"))).otherwise(F.struct(F.lit(fallback).alias("prefix"), F.lit(0).alias("number")))


def truthy(x: Column) -> Column:
    return F.lower(strip(text_or_empty(x))).isin("1", "true", "yes", "on")


def content_type(path: Column) -> Column:
    """MIME type by file ending."""
    end = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    known = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "pdf": "application/pdf", "json": "application/json", "md": "text/markdown", "txt": "text/plain"}
    return F.coalesce(F.element_at(F.create_map(*[F.lit(v) for kv in known.items() for v in kv]), end), F.lit("application/octet-stream"))


def natural_key(x: Column) -> Column:
    """Sort key that puts numbers by value and other text at zero."""
    number = F.when(x.rlike(r"^[0-9]{1,9}$"), x.cast("int"))
    return F.struct(F.coalesce(number, F.lit(0)).alias("n"), F.when(number.isNull(), x).otherwise("").alias("s"))


def pdf_pages(content: Column) -> Column:
    """Page objects that a PDF's bytes name."""
    return F.regexp_count(F.decode(content, "ISO-8859-1"), F.lit(r"/Type\s*/\s*Page[^s]"))
