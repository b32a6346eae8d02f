"""What a line of an announcement is, as Columns: the rules of prose.py for whole tables of lines.

Words are parted by white space; lengths are UTF-8 bytes. A null line counts as empty.
Everything is built in and compiled; word lists and patterns are those of prose.py.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import prose

_WHITE = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in prose._SPACE) + "]"
_NAME = r"\p{IsUppercase}\p{IsLowercase}*"


def _trim(text: Column) -> Column:
    return F.btrim(text, F.lit(prose._SPACE))


def _any(texts, test) -> Column:
    found = F.lit(False)
    for t in texts:
        found = found | test(t)
    return found


def _words(text: Column) -> tuple[Column, Column]:
    """The words, and how many; the array of a text without words has one empty one."""
    bare = _trim(text)
    parts = F.split(bare, f"{_WHITE}+")
    return parts, F.when(bare == "", 0).otherwise(F.size(parts))


def _ends(text: Column, *ends: str) -> Column:
    return _any(ends, text.endswith)


def could_be_name(text: Column) -> Column:
    """No digit, and neither a first word nor a last one that names a thing."""
    parts, n = _words(text)
    first, last = F.lower(F.get(parts, F.lit(0))), F.lower(F.element_at(parts, -1))
    return (n > 0) & ~text.rlike("[0-9]") & ~first.isin(*sorted(prose._NOT_FIRST_NAMES)) & ~last.isin(*sorted(prose._NOT_SURNAMES))


def is_person(text: Column) -> Column:
    """Two or three capitalised words of up to 15 bytes that could be a name, and nothing else."""
    parts, _ = _words(text)
    short = [F.coalesce(F.octet_length(F.get(parts, F.lit(i))) <= 15, F.lit(True)) for i in range(3)]
    named = _trim(text).rlike(rf"\A{_NAME}(?:{_WHITE}+{_NAME}){{1,2}}\z")
    return named & short[0] & short[1] & short[2] & ~_any(("and", "of", "with", "for", "in"), lambda w: text.contains(f" {w} ")) & could_be_name(text)


def is_generic(text: Column) -> Column:
    """Boilerplate, a heading, or a bare name."""
    low = _trim(F.lower(text))
    return (F.octet_length(low) < 6) | low.isin(*sorted(prose._GENERIC)) | _any(prose._GENERIC_STARTS, low.startswith) | _trim(text).endswith(":") | is_person(text)


def is_title(text: Column) -> Column:
    """Whether a fragment can be a talk's title, rather than prose, a notice or a heading."""
    _, n = _words(text)
    least, most = prose._TITLE_BYTES.start, prose._TITLE_BYTES.stop - 1
    stops = F.size(F.split(text, re.escape(". "), -1)) - 1
    told = (stops >= 2) | ((stops > 0) & (n > 14)) | (_ends(text, ".", "!", "?") & (n > 12))
    fits = F.octet_length(text).between(least, most) & ~text.endswith(":") & ~_any(prose._NOT_BEFORE_TITLES, text.startswith)
    prosaic = _any(prose._NOT_IN_TITLES, text.contains) | _any((p.pattern for p in prose._PROSE), lambda p: text.rlike(rf"(?U)\A(?:{p})"))
    return fits & ~prosaic & ~told & ~is_generic(text)


def is_job_title(text: Column) -> Column:
    """A known title, or up to three words without a comma that name one."""
    _, n = _words(text)
    return _trim(F.lower(text)).isin(*sorted(prose._JOB_TITLES)) | (~text.contains(",") & (n <= 3) & _any(("Engineer", "Director", "Manager"), text.contains))


def is_speaker_field(text: Column) -> Column:
    """A short capitalised line with a comma, an "at" or an "@"."""
    bare, (_, n) = _trim(text), _words(text)
    return _any((",", " at ", "@"), bare.contains) & ~bare.contains("http") & (F.octet_length(bare) < 120) & (n < 12) & ~bare.endswith(":") & bare.rlike(r"\A\p{IsUppercase}")


def is_speaker_line(text: Column) -> Column:
    """A speaker field, or an emphasised line with a comma."""
    bare = _trim(text)
    emphasised = (bare.startswith("**") | (bare.startswith("*") & bare.endswith("*"))) & bare.contains(",")
    return F.when(emphasised, F.octet_length(bare) < 120).otherwise(is_speaker_field(text))


def is_title_remainder(text: Column) -> Column:
    """Four or more words after a name that are not a role or an affiliation."""
    parts, n = _words(text)
    return (n >= 4) & ~F.lower(F.get(parts, F.lit(0))).isin(*sorted(prose._ROLE_STARTS)) & ~F.lower(text).contains(" at the ")


KINDS = {
    "title": is_title,
    "generic": is_generic,
    "person": is_person,
    "possible_name": could_be_name,
    "job_title": is_job_title,
    "speaker_line": is_speaker_line,
    "speaker_field": is_speaker_field,
    "title_remainder": is_title_remainder,
}


def line_kinds(line: Column) -> Column:
    """A struct of booleans: what a line can be."""
    text = F.coalesce(line, F.lit(""))
    return F.struct(*[is_kind(text).alias(name) for name, is_kind in KINDS.items()])
