"""Who a credit line names, as Columns: the rules of prose.py for whole tables of lines. A null line counts as empty."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import prose
from .lines import _any, _trim, _words, could_be_name, is_job_title, is_person


def _strip(text: Column, marks: str) -> Column:
    return F.btrim(text, F.lit(marks))


def _after(text: Column, at: Column) -> Column:
    """The text from a place (from 1) on."""
    return F.substring(text, at, F.length(text))


def _without_ends(text: Column, ends: set[str]) -> Column:
    """Words joined by single spaces without the known ones at their end, but for the first word."""
    known = "|".join(re.escape(e) for e in sorted(ends, key=len, reverse=True))
    return F.regexp_replace(text, rf"(?iu)(?: ,*\.*(?:{known})\.*,*)+\z", "")


def clean_company(text: Column) -> Column:
    """The company in a field without roles before or after it; null if only a role is left, or it reads as prose."""
    bare = _trim(_strip(F.rtrim(_trim(text), F.lit(",")), "*"))
    joined = F.array_join(_words(bare)[0], " ")
    company = _without_ends(_without_ends(joined, prose._ROLE_ENDS), prose._MODIFIER_ENDS)
    low = F.lower(company)
    prosaic = (F.size(F.split(company, " ")) > 5) | _any((" for ", " of ", " with "), low.contains)
    return F.when((bare != "") & ~F.lower(bare).isin(*sorted(prose._ROLES)) & ~prosaic, company)


def company_of(field: Column) -> Column:
    """The company of the field after a name: what follows " at ", else the part after the last comma, else all of it."""
    bare = _trim(F.rtrim(_trim(field), F.lit("*")))
    at = F.instr(F.lower(bare), " at ")
    employer = F.when(at > 0, _trim(_after(bare, at + 4)))
    last = F.when(bare.contains(","), _trim(_strip(_trim(F.element_at(F.split(bare, ",", -1), -1)), "*")))
    return F.when(employer != "", clean_company(employer)).when(bare != "", clean_company(F.when(last != "", last).otherwise(bare)))


def _person(name: Column, company: Column) -> Column:
    return F.struct(name.alias("name"), company.cast("string").alias("company"))


def split_person(raw: Column) -> Column:
    """Name and company of one credit, by its first separator: "@", "(", commas, " at "."""
    bare = _trim(F.rtrim(_strip(_trim(raw), "*"), F.lit(".")))
    parted = lambda mark: (_trim(F.substring_index(bare, mark, 1)), _after(bare, F.instr(bare, mark) + 1))
    fields = F.transform(F.split(bare, ",", -1), _trim)
    first, second, n = F.get(fields, F.lit(0)), F.get(fields, F.lit(1)), F.size(fields)
    at = F.instr(F.lower(bare), " at ")
    employer = F.nullif(_trim(_after(bare, at + 4)), F.lit(""))
    (user, host), (outer, inner) = parted("@"), parted("(")
    return (
        F.when(bare.contains("@"), _person(user, company_of(host)))
        .when(bare.contains("("), _person(outer, company_of(F.rtrim(inner, F.lit(")")))))
        .when((n == 1) & (at == 0), _person(bare, F.lit(None)))
        .when(n == 1, _person(_trim(F.substring(bare, F.lit(1), at - 1)), employer))
        .when((n == 2) & is_person(second) & ~is_person(first), _person(second, first))
        .otherwise(_person(first, company_of(F.when(n == 2, second).otherwise(_trim(_strip(F.element_at(fields, -1), "*"))))))
    )


def speakers_of(line: Column) -> Column:
    """The people in a credit line, with their companies."""
    bare = _trim(line)
    for label in prose._SPEAKER_LABELS:
        bare = F.regexp_replace(bare, rf"\A(?:{re.escape(label)})+", "")
    bare = _trim(bare)
    comma = F.instr(bare, ",")

    def parted(credits: Column, mark: str) -> Column:
        return F.flatten(F.transform(credits, lambda c: F.split(c, re.escape(mark), -1)))

    # after a comma a conjunction stands inside somebody's role
    joins = lambda mark: (comma == 0) | (F.instr(bare, mark) == 0) | (F.instr(bare, mark) < comma)
    credits = F.array(bare)
    credits = F.when(joins(" and "), parted(credits, " and ")).otherwise(credits)
    credits = parted(credits, ";")
    credits = F.when(joins(" & "), parted(credits, " & ")).otherwise(credits)
    told = F.filter(F.transform(credits, _trim), lambda c: (F.octet_length(c) >= 5) & ~is_job_title(c))

    def is_named(person: Column) -> Column:
        name = person["name"]
        parts, n = _words(name)
        capitals = F.forall(parts, lambda w: w.rlike(r"\A\p{IsUppercase}"))
        return n.between(2, 4) & capitals & ~name.contains("http") & ~name.contains(":") & could_be_name(name)

    nothing = F.lit(None).cast("string")
    people = F.filter(F.transform(told, split_person), is_named)
    return F.transform(people, lambda p: F.struct(p["name"].alias("name"), p["company"].alias("company"), nothing.alias("role"), nothing.alias("bio")))


def credit(line: Column) -> Column:
    """A struct of a credit line: all its speakers; read as one person; read as the field after a name; read as a company."""
    text = F.coalesce(line, F.lit(""))
    return F.struct(
        speakers_of(text).alias("speakers"), split_person(text).alias("person"), company_of(text).alias("company_of"), clean_company(text).alias("company")
    )
