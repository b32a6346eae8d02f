"""Column functions of ids, names, markdown, dates and JSON properties.

Java patterns get (?U) where classes are meant for all of Unicode, and (?d)
where only a line feed ends a line.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Caps of slugs inside ids, in bytes (slugs are ASCII).
SLUG_CAP, TITLE_CAP, SPEAKER_CAP = 60, 45, 30
_LINK, _EMPHASIS = r"\[([^\]]+)\]\([^)]+\)", r"\*{1,3}([^*]+)\*{1,3}"


def trim_ws(text: Column) -> Column:
    """The text without white space of any kind at its ends; Spark's trim takes spaces only."""
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def normalize_name(text: Column) -> Column:
    """Lower case, runs of anything but a-z and 0-9 as one hyphen, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), F.lit("-"))


def slugify(text: Column, cap: int = SLUG_CAP) -> Column:
    """normalize_name(), cut to `cap` and without a hyphen at the cut."""
    slug = F.rtrim(F.substring(normalize_name(text), 1, SLUG_CAP), F.lit("-"))
    return slug if cap >= SLUG_CAP else F.rtrim(F.substring(slug, 1, cap), F.lit("-"))


def make_talk_id(date: Column, title: Column, speaker: Column, prefix: str = "talk") -> Column:
    """prefix-yyyymmdd-title-speaker; a null speaker leaves its part out."""
    return F.concat_ws("-", F.lit(prefix), F.date_format(date, "yyyyMMdd"), slugify(title, TITLE_CAP), slugify(speaker, SPEAKER_CAP))


def node_id(kind: str, *parts: Column) -> Column:
    """kind:part-part."""
    return F.concat(F.lit(f"{kind}:"), F.concat_ws("-", *parts))


def markdown_to_text(text: Column) -> Column:
    """Markdown as plain text: link texts, no emphasis, headings, bullets or escapes, at most one blank line."""
    for pattern, new in (
        (_LINK, "$1"),
        (_EMPHASIS, "$1"),
        (r"(?mdU)^#{1,6}\s+", ""),
        (r"(?mdU)^[*\-\u2022]\s+", ""),
        (r"(?d)\\(.)", "$1"),
        (r"\n{3,}", "\n\n"),
    ):
        text = F.regexp_replace(text, pattern, new)
    return trim_ws(text)


def clean_md(text: Column) -> Column:
    """Link texts, no emphasis, no backslashes."""
    return trim_ws(F.translate(F.regexp_replace(F.regexp_replace(text, _LINK, "$1"), _EMPHASIS, "$1"), "\\", ""))


def preclean(text: Column) -> Column:
    """The text without zero-width characters and without the backslash before # - * and full stops."""
    return F.regexp_replace(F.translate(text, "\u200b\ufeff", ""), r"\\([#\-*.])", "$1")


def normalize_title(title: Column) -> Column:
    """The title without a leading "Tech Talk 2:" and its like."""
    prefix = r"(?iU)\A(?:tech\s+talk|talk|topic|presentation)\s*\d+\s*[:.\-]\s*"
    return trim_ws(F.regexp_replace(trim_ws(title), prefix, ""))


def event_id_of(url: Column) -> Column:
    """The number after /events/, or null."""
    return F.nullif(F.regexp_extract(url, r"/events/(\d+)", 1), F.lit(""))


def utc_timestamp(text: Column) -> Column:
    """The instant of an RFC 3339 text; null if it is none, or has no zone. Seconds may be left out."""
    zoned = text.rlike(r"\A\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?([Zz]|[+-]\d{2}:\d{2})\z")
    seconds = F.regexp_replace(F.upper(text), r"\A(.{10}[T ]\d{2}:\d{2})(?=[Z+-])", "$1:00")
    return F.when(zoned, seconds.try_cast("timestamp"))


def rfc3339(instant: Column) -> Column:
    """An instant as text, in UTC (the session's zone must be UTC)."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def group_display_name(slug: Column, names: dict[str, str]) -> Column:
    """The name of a group in a small table of names, else its slug."""
    if not names:
        return slug
    pairs = [F.lit(x) for pair in sorted(names.items()) for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), slug), slug)


def single_talk_abstract(text: Column) -> Column:
    """The first 1000 bytes (whole characters) of a text of at least 30 bytes, else null."""
    body = trim_ws(text)
    head = F.substring(body.cast("binary"), 1, 1000).cast("string")
    whole = F.when(F.is_valid_utf8(head), head).otherwise(F.regexp_replace(F.make_valid_utf8(head), "\ufffd+\\z", ""))
    cut = F.when(F.octet_length(body) <= 1000, body).otherwise(whole)
    return F.when(F.octet_length(body) >= 30, trim_ws(cut))


def source_path(group: Column, event_id: Column) -> Column:
    return F.concat(F.lit("source/"), group, F.lit("/"), event_id, F.lit(".html"))


def file_stem(path: Column) -> Column:
    """The last part of a path without its extension, or null."""
    return F.nullif(F.regexp_extract(path, r"([^/]+)\.[^./]*\z", 1), F.lit(""))


def group_url(slug: Column, base: str) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), slug)


def str_prop(props: Column, key: str) -> Column:
    """A string property of a JSON bag; anything else is ""."""
    value = F.try_variant_get(F.try_parse_json(props), f"$.{key}", "variant")
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string")).otherwise("")


def int_prop(props: Column, key: str) -> Column:
    """An integer property of a JSON bag; anything else is 0."""
    value = F.try_variant_get(F.try_parse_json(props), f"$.{key}", "variant")
    return F.when(F.schema_of_variant(value) == "BIGINT", F.try_variant_get(value, "$", "bigint")).otherwise(F.lit(0).cast("bigint"))


def match_score(name: Column, repo: Column, full_name: Column, description: Column) -> tuple[Column, Column]:
    """(one holds the other, token overlap of at least half) of a project name and a repository.

    Names without a letter or digit match nothing, unlike a plain substring test,
    which would find the empty name in everything.
    """
    needle, repo, full = normalize_name(name), normalize_name(repo), normalize_name(full_name)
    desc = F.coalesce(normalize_name(description), F.lit(""))
    known = (needle != "") & (repo != "")
    contains = known & (repo.contains(needle) | needle.contains(repo) | full.contains(needle) | desc.contains(needle))
    mine, theirs = F.split(needle, "-"), F.split(repo, "-")
    overlap = known & (F.size(F.array_intersect(mine, theirs)) * 2 >= F.size(F.array_union(mine, theirs)))
    return F.coalesce(contains, F.lit(False)), F.coalesce(overlap, F.lit(False))
