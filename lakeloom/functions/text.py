"""Expressions over tag strings, file names, URLs and JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: File endings and their media types, frozen so that results do not follow the Python version.
MIMETYPES = {
    "jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png", "gif": "image/gif", "webp": "image/webp", "bmp": "image/bmp", "svg": "image/svg+xml",
    "mp4": "video/mp4", "webm": "video/webm", "mov": "video/quicktime", "avi": "video/x-msvideo", "mp3": "audio/mpeg", "wav": "audio/x-wav", "ogg": "audio/ogg",
    "txt": "text/plain", "html": "text/html", "css": "text/css", "csv": "text/csv", "json": "application/json", "pdf": "application/pdf", "psd": "image/vnd.adobe.photoshop",
    "zip": "application/zip", "tar": "application/x-tar", "swf": "application/x-shockwave-flash",
}
ARCHIVE_SUFFIXES = ("zip", "rar", "7z", "tar", "tar.gz", "tgz", "tar.bz2", "tar.xz")


def split_ws(text: Column) -> Column:
    """Words of ``text``, Unicode blanks between them, empty ones dropped."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda x: x != "")


def unique_ordered(words: Column) -> Column:
    return F.array_distinct(words)


def wrap_tags(words: Column) -> Column:
    """`` a b `` with a blank before and after each word; an empty array is one blank."""
    return F.array_join(F.concat(F.array(F.lit("")), words, F.array(F.lit(""))), " ")


def has_tag(wrapped: Column, tag: str) -> Column:
    """Whether a wrapped tag string has the whole ``tag``."""
    return wrapped.contains(f" {tag} ")


def blank_to_null(text: Column) -> Column:
    trimmed = F.trim(text)
    return F.when(trimmed != "", trimmed)


def file_name(path_or_url: Column) -> Column:
    """Last path segment, without query and fragment."""
    return F.regexp_extract(path_or_url, r"([^/?#]*)(?:[?#].*)?$", 1)


def extension(path_or_url: Column) -> Column:
    """Lower-cased ending of the file name, null without one."""
    found = F.lower(F.regexp_extract(file_name(path_or_url), r"[^.]\.([^.]+)$", 1))
    return F.when(found != "", found)


def guess_mimetype(path_or_url: Column) -> Column:
    pairs = [x for ending, kind in MIMETYPES.items() for x in (F.lit(ending), F.lit(kind))]
    return F.try_element_at(F.create_map(*pairs), extension(path_or_url))


def file_type(path_or_url: Column) -> Column:
    """Coarse kind of a file, null for other endings."""
    kind, name = guess_mimetype(path_or_url), F.lower(file_name(path_or_url))
    found = F.when(kind.contains("photoshop"), "photoshop")
    for family in ("image", "audio", "video", "text"):
        found = found.when(kind.startswith(f"{family}/"), family)
    archive = name.endswith(f".{ARCHIVE_SUFFIXES[0]}")
    for ending in ARCHIVE_SUFFIXES[1:]:
        archive = archive | name.endswith(f".{ending}")
    return found.when(archive, "archive")


def url_query(url: Column, key: str) -> Column:
    return F.expr("null").cast("string") if not key else F.try_parse_url(url, F.lit("QUERY"), F.lit(key))


def url_segments(url: Column) -> Column:
    return F.filter(F.split(F.try_parse_url(url, F.lit("PATH")), "/"), lambda x: x != "")


def hex_color(rgb: Column) -> Column:
    """``#rrggbb`` from exactly three whole numbers 0 to 255, else null."""
    part = lambda i: F.lpad(F.lower(F.hex(F.try_element_at(rgb, F.lit(i)).cast("long"))), 2, "0")
    return F.when((F.size(rgb) == 3) & F.forall(rgb, lambda x: x.isNotNull() & x.between(0, 255)), F.concat(F.lit("#"), part(1), part(2), part(3)))


def natural_key(text: Column, width: int = 20) -> Column:
    """A sort key in which runs of digits compare as numbers."""
    parts = F.regexp_extract_all(text, F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), F.lpad(p, width, "0")).otherwise(p)), "")


def html_ids(body: Column) -> Column:
    """All numbers that stand as ``"id": N,`` in a body."""
    return F.transform(F.regexp_extract_all(body, F.lit(r'"id":\s*(\d+)\s*,'), F.lit(1)), lambda x: x.cast("long"))


def json_array_text(values: Column) -> Column:
    return F.to_json(values)


def plural(count: Column, noun: str) -> Column:
    return F.concat(count.cast("string"), F.lit(f" {noun}"), F.when(count == 1, "").otherwise("s"))


def size_bucket(count: Column, last: str = "1T", beyond: str | None = None) -> Column:
    """Public size labels of dataset hubs up to ``last``; what is beyond has a label of its own, ``n>last`` if not given."""
    found, low = None, None
    for label, limit in (("1K", 10**3), ("10K", 10**4), ("100K", 10**5), ("1M", 10**6), ("10M", 10**7), ("100M", 10**8), ("1B", 10**9), ("10B", 10**10), ("100B", 10**11), ("1T", 10**12)):
        name = f"n<{label}" if low is None else f"{low}<n<{label}"
        found = F.when(count < limit, name) if found is None else found.when(count < limit, name)
        low = label
        if label == last:
            break
    return found.otherwise(beyond or f"n>{low}")


def bucket_mod(number: Column, buckets: int = 1000, width: int = 4) -> Column:
    return F.lpad((number % buckets).cast("string"), width, "0")


def volume_path(number: Column) -> Column:
    return F.format_string("images/%d/%03d.tar", F.floor(number / 1000), number % 1000)


def shard_number(name: Column) -> Column:
    """Trailing number of a shard's file name, -1 without one."""
    return F.coalesce(F.regexp_extract(name, r"(\d+)\.[A-Za-z0-9]+$", 1).try_cast("int"), F.lit(-1))


def category_name(kind: Column, names: dict[int, str], unknown: str = "unknown") -> Column:
    """The label of a numeric type; sites number theirs differently, so the map is a parameter."""
    pairs = [x for number, name in names.items() for x in (F.lit(number), F.lit(name))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), kind), F.lit(unknown))
