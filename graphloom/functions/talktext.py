"""Talks in the text of an announcement.

Announcements come in a few layouts. A layout is a function from lines to
talks; the first layout that yields a talk with a speaker is taken.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

from .prose import (
    Speaker,
    is_generic,
    is_person,
    is_speaker_field,
    is_speaker_line,
    is_title,
    is_title_remainder,
    plain,
    size,
    speakers_of,
    starts_upper,
    trim,
    without_start,
    words,
)

# How titles, speakers and sections are marked.
_BOLD_LINE = re.compile(r"[\s\u200B\uFEFF]*\*\*([^*\n]{4,}?)\*\*\s*\Z")
_NUMBERED = re.compile(r"\s*\(?\d+[\)\.]\s+(.+)\Z")
_QUOTED = re.compile(r'["\u201C\u2018](.+?)["\u201D\u2019]\s*\Z')
_QUOTED_BY = re.compile(r'["\u201C](.+?)["\u201D]\s+by\s+(.+?)\.?\Z', re.I)
_BULLET = re.compile(r"\s*[*\-\u2022]\s+(.+)\Z")
_BULLET_BOLD = re.compile(r"\s*[*\-\u2022]\s+\*\*(.+?)\*\*\s*(?:[-–—]\s*\*?(.+?)\*?)?\Z")
_BULLET_DASH = re.compile(r"\s*[*\-\u2022]\s+([^*\n]{10,}?)\s+[-–—]\s+(.+)\Z")
_SLOT = re.compile(r"\s*\d+:\d+\s*[-–]\s*(?:\d+:\d+\s*[-–]\s*)?(.+)\Z")
_TITLE_LABEL = re.compile(r"\s*\**(?:presentation|talk|topic|title)\**\s*:\**\s*(.+?)\**\s*\Z", re.I)
_SPEAKER_LABEL = re.compile(r"\s*\**(?:speakers?|presenters?|by|presented\s+by)\**\s*:\**\s*(.+?)\**\s*\Z", re.I)
_HEADING = re.compile(r"\s*#{1,3}\s+(.+?)\s*#*\s*\Z")
_NAME_DOES = re.compile(r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,2})\s+(?:will\b|is\b|has\b|was\b|presented\b|gave\b|spoke\b|works\b|joins\b)")
_AT_COMPANY = re.compile(r"\bat\s+([A-Z][A-Za-z0-9]+(?:\s+[A-Z][A-Za-z0-9]+){0,3})")
_NAME_COMMA = re.compile(r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,2}),\s+(.+)\Z")
_NAME_COMMA_QUOTED = re.compile(r"([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,2}),\s+[\"'\u201C]?(.+?)[\"'\u201D]?\Z")
_EMPHASIS = re.compile(r"\*{1,3}([^*]+)\*{1,3}")
_NUMBERED_PREFIX = re.compile(r"(?:tech\s+talk|talk|topic|presentation)\s*\d+\s*[:.\-]\s*", re.I)
_SECTION_MARKS = ("*", "-", "#")
_ABSTRACT_BYTES = range(30, 1001)


class Talk(NamedTuple):
    title: str
    abstract: str | None
    speakers: list[Speaker]


class Lines:
    """The trimmed lines of a text, and what follows a line."""

    def __init__(self, text: str):
        raw = text.split("\n")
        if raw and raw[-1] == "":
            raw.pop()
        self.raw = [line.removesuffix("\r") for line in raw]
        self.all = [trim(line) for line in self.raw]

    def __len__(self) -> int:
        return len(self.all)

    def filled(self, at: int) -> int:
        """The first line from `at` on that is not blank, or the end."""
        while at < len(self) and not self.all[at]:
            at += 1
        return at

    def prose(self, at: int) -> tuple[str | None, int]:
        """The paragraph text from `at` up to a bullet, heading, numbered or bold line, and where to read on.

        Blank lines before the text don't move that place.
        """
        taken: list[str] = []
        for line in self.all[at:]:
            if line.startswith(_SECTION_MARKS) or _NUMBERED.match(line) or _BOLD_LINE.match(line):
                break
            if line or taken:
                taken.append(line)
        return as_abstract(taken), at + len(taken)

    def credited(self, at: int, ends: Callable[[str], object], late: bool) -> tuple[list[Speaker], str | None, int]:
        """Labelled speakers and the other lines from `at` up to a line that ends the section; late: only lines after a speaker."""
        people: list[Speaker] = []
        rest: list[str] = []
        while at < len(self) and not (self.all[at] and ends(self.all[at])):
            line = self.all[at]
            if label := _SPEAKER_LABEL.match(line) if line else None:
                people += speakers_of(plain(trim(label[1])))
            elif line and (people or not late):
                rest.append(line)
            at += 1
        return people, as_abstract(rest), at


def as_abstract(lines: list[str]) -> str | None:
    while lines and not lines[-1]:
        lines = lines[:-1]
    return plain("\n".join(lines)) or None


Layout = Callable[[Lines], Iterator[Talk]]


def bold_titles(lines: Lines) -> Iterator[Talk]:
    """**Title**, then a line with the speaker, then the abstract."""
    at = 0
    while at < len(lines):
        found, at = _BOLD_LINE.match(lines.all[at]), at + 1
        if not found or not is_title(title := plain(found[1])):
            continue
        credit = lines.filled(at)
        if credit < len(lines) and is_speaker_line(lines.all[credit]) and (people := speakers_of(plain(lines.all[credit]))):
            abstract, at = lines.prose(credit + 1)
            yield Talk(title, abstract, people)


def _person_in_prose(lines: list[str]) -> list[Speaker]:
    """The first credit among lines: a short "Name, Company" line, or "Name will ..."."""
    for line in lines:
        if not line or line.startswith(("#", "*", "-")):
            continue
        if size(line) < 80 and ". " not in line and is_speaker_line(line) and (people := speakers_of(plain(line))):
            return people
        if does := _NAME_DOES.match(line):
            company = _AT_COMPANY.search(line)
            return [Speaker(does[1], company and trim(company[1]))]
    return []


def numbered_sections(lines: Lines) -> Iterator[Talk]:
    """At least two of "(1) Title" or "1. Name, Title", each with its prose."""
    sections: list[tuple[int, str, str | None]] = []
    for i, line in enumerate(lines.raw):
        if found := _NUMBERED.match(line):
            title, name = plain(trim(found[1])), None
            both = _NAME_COMMA.match(title)
            if both and is_person(both[1]) and is_title(both[2]):
                name, title = both[1], both[2]
            if is_title(title):
                sections.append((i, title, name))
    if len(sections) < 2:
        return
    ends = [i for i, _, _ in sections[1:]] + [len(lines)]
    for (begin, title, name), end in zip(sections, ends, strict=True):
        body = lines.all[begin + 1 : end]
        if people := speakers_of(name) if name else _person_in_prose(body):
            yield Talk(title, as_abstract([line for line in body if line]), people)


def labelled(lines: Lines) -> Iterator[Talk]:
    """"Presentation: Title" and "Speaker: Name" lines."""
    at = 0
    while at < len(lines):
        found, at = _TITLE_LABEL.match(lines.all[at]), at + 1
        if found and is_title(title := plain(trim(found[1]))):
            people, abstract, at = lines.credited(at, _TITLE_LABEL.match, late=False)
            if people:
                yield Talk(title, abstract, people)


def headings(lines: Lines) -> Iterator[Talk]:
    """A heading or bold line whose next filled line is a speaker label."""

    def heading(line: str) -> str | None:
        found = _HEADING.match(line) or _BOLD_LINE.match(line)
        return plain(trim(found[1])) if found else None

    def ends(line: str) -> bool:
        return heading(line) is not None

    at = 0
    while at < len(lines):
        title, at = heading(lines.all[at]), at + 1
        label = lines.filled(at)
        if title is None or not is_title(title) or label >= len(lines) or not _SPEAKER_LABEL.match(lines.all[label]):
            continue
        people, abstract, at = lines.credited(at, ends, late=True)
        if people:
            yield Talk(title, abstract, people)


def quoted_titles(lines: Lines) -> Iterator[Talk]:
    """"Title" by Name, or "Title" with the name on the next filled line."""
    at = 0
    while at < len(lines):
        line, at = lines.all[at], at + 1
        by = _QUOTED_BY.match(line)
        if by and is_title(title := plain(by[1])) and (people := speakers_of(plain(by[2]))):
            abstract, at = lines.prose(at)
            yield Talk(title, abstract, people)
            continue
        alone, credit = _QUOTED.match(line), lines.filled(at)
        if alone and is_title(title := plain(alone[1])) and credit < len(lines) and (people := speakers_of(plain(lines.all[credit]))):
            abstract, at = lines.prose(credit + 1)
            yield Talk(title, abstract, people)


def _title_and_credit(text: str, separator: str, least_words: int, last: bool = False) -> Talk | None:
    """A title of enough words before a separator, and people after it."""
    title, found, credit = text.rpartition(separator) if last else text.partition(separator)
    title = trim(title)
    if found and is_title(title) and len(words(title)) >= least_words and (people := speakers_of(trim(credit))):
        return Talk(title, None, people)
    return None


def bullet_sentences(lines: Lines) -> Iterator[Talk]:
    """One bullet a talk: its title, a full stop or long dash, its people. A bold name before a comma is somebody on a panel, not a title."""
    for line in lines.all:
        found = _BULLET.match(line)
        if not found:
            continue
        bold = _EMPHASIS.search(found[1])
        if bold and bold.start() == 0 and trim(found[1][bold.end() :]).startswith(",") and is_person(trim(bold[1])):
            continue
        text = plain(found[1])
        talks = (_title_and_credit(text, separator, 4) for separator in (". ", " – ", " — "))
        if talk := next(filter(None, talks), None):
            yield talk


def bullet_agenda(lines: Lines) -> Iterator[Talk]:
    """Bulleted titles whose people follow a dash, or stand on the next filled line if the title is bold."""
    at = 0
    while at < len(lines):
        line, at = lines.all[at], at + 1
        if is_generic(line):
            continue
        for pattern, is_credit in ((_BULLET_BOLD, bool), (_BULLET_DASH, is_speaker_field)):
            found = pattern.match(line)
            credit = plain(found[2]) if found and found[2] else ""
            if found and is_title(title := plain(found[1])) and is_credit(credit) and (people := speakers_of(credit)):
                abstract, at = lines.prose(at)
                yield Talk(title, abstract, people)
                break
        else:
            credit = lines.filled(at)
            if not line.startswith(("* **", "- **", "• **")) or not line.endswith("**") or credit >= len(lines):
                continue
            inner = line
            for mark in ("• ", "* ", "- ", "**"):
                inner = without_start(inner, mark)
            while inner.endswith("**"):
                inner = inner[:-2]
            title, named = plain(trim(inner)), lines.all[credit]
            if is_title(title) and not named.startswith(_SECTION_MARKS) and is_speaker_field(named) and (people := speakers_of(plain(named))):
                abstract, end = lines.prose(credit + 1)
                at += end - credit  # blank lines before the name are not counted
                yield Talk(title, abstract, people)


def time_slots(lines: Lines) -> Iterator[Talk]:
    """A clock time, then "Title - Name" or "Name, Title", parted by dashes."""
    for line in lines.all:
        found = _SLOT.match(line)
        if not found:
            continue
        text = plain(trim(found[1]))
        if talk := _title_and_credit(text, " - ", 3, last=True):
            yield talk
            continue
        name, comma, title = (trim(x) for x in text.partition(","))
        if comma and starts_upper(name) and is_title_remainder(title) and is_title(title) and (people := speakers_of(name)):
            yield Talk(title, None, people)


#: Layouts in the order in which they are tried.
LAYOUTS: tuple[Layout, ...] = (
    bold_titles, numbered_sections, labelled, headings, quoted_titles, bullet_sentences, bullet_agenda, time_slots,
)


def event_title_talks(title: str, text: str) -> list[Talk]:
    """Talks in an event's own title: "Name: Title" or "Name, Title", several parted by ";"."""
    body = trim(text)
    abstract = None
    if size(body) >= _ABSTRACT_BYTES.start:
        abstract = trim(body.encode("utf-8", "surrogatepass")[: _ABSTRACT_BYTES.stop - 1].decode("utf-8", "ignore"))
    talks = []
    for part in map(trim, title.split(";")):
        name, colon, rest = part.partition(": ")
        rest = trim(rest).strip('"').strip("\u201c").strip("\u201d")
        pair = (trim(name), rest) if colon and is_person(trim(name)) and is_title(rest) and speakers_of(trim(name)) else None
        if pair is None and (found := _NAME_COMMA_QUOTED.match(part)) and is_person(found[1]) and is_title(trim(found[2])):
            pair = (found[1], trim(found[2]))
        if pair and (people := speakers_of(pair[0])):
            talks.append(Talk(pair[1], abstract, people))
    return talks


def talk_title(title: str) -> str:
    """A title without a leading "Talk 2:" and its like."""
    title = trim(title)
    prefix = _NUMBERED_PREFIX.match(title)
    return trim(title[prefix.end() :]) if prefix else title


def extract(description: str | None, event_title: str | None = None, text: str | None = None) -> list[Talk]:
    """The talks of a description, each with a speaker; failing that, those in the event's title, if one is given."""
    body = (description or "").replace("\u200b", "").replace("\ufeff", "")
    lines = Lines(re.sub(r"\\([#\-*.])", r"\1", body))
    for layout in LAYOUTS:
        if talks := list(layout(lines)):
            break
    else:
        talks = event_title_talks(event_title, text or "") if event_title is not None else []
    return [t._replace(title=talk_title(t.title)) for t in talks]
