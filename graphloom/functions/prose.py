"""What a line of an announcement is: a title, a person, a company, boilerplate.

Small pure functions, used per text inside vectorised jobs. Lengths are UTF-8
bytes. The word lists and patterns are fixed values that results depend on.
"""

from __future__ import annotations

import re
from typing import NamedTuple

_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_GAP = re.compile(f"[{_SPACE}]+")
_LINK, _EMPHASIS = re.compile(r"\[([^\]]+)\]\([^)]+\)"), re.compile(r"\*{1,3}([^*]+)\*{1,3}")

# --- fixed values: titles -----------------------------------------------------
_TITLE_BYTES = range(8, 201)
_NOT_IN_TITLES = ("http", "://", "MUST BE REGISTERED", "RSVP")
_NOT_BEFORE_TITLES = (
    "!", "Please ", "Note:", "NOTE:",
    "Come learn ", "Come hear ", "Come see ",
    "Some considerations ", "Some thoughts ", "Some tips ",
    "What would ", "What if ", "What does ",
    "How would ", "How will ",
    "In this talk", "This talk ",
)
_PROSE = tuple(
    map(re.compile, (
        r"[\d:]+\s*(?:[aApP][mM])?[:\s–\-]",
        r"[A-Z][a-z]+ (?:[A-Z][a-z]+ )?(?:will\b|is\b|has\b|was\b|shows?\b|describes?\b|presents?\b|gave\b|joins?\b|talks?\b|explains?\b)",
        r"(?:Built|Powered|Backed|Driven|Implemented|Hosted|Sponsored)\s+(?:using|by|with|on)\b",
        r"[A-Z][a-z]+ [A-Z][a-z]+, an? \w+",
    ))
)
_GENERIC = {
    "networking", "food", "pizza", "beer", "checkin", "check-in",
    "doors open", "welcome", "registration", "refreshments", "social",
    "break", "q&a", "q & a", "intro", "agenda", "schedule",
    "announcements", "sponsor", "sponsors", "closing", "overview",
    "summary", "introduction", "description", "about", "join the community",
    "what to expect", "why join?", "why join", "sunset social",
    "welcome remarks", "speaker bio",
}
_GENERIC_STARTS = (
    "about the ", "about your ", "about our ", "featured talks",
    "join the ", "any questions", "everyone who", "google build",
    "register now", "sign up", "click here", "learn more",
    "you must be", "please note", "please contact", "for more info",
    "hands-on technical", "hands on technical",
    "lightning talk", "speaker 1 bio", "speaker 2 bio",
    "note: ", "our friends at", "registration is",
    "networking with", "great networking", "you have to",
    "live demos ", "ml and infra", "ways to get",
    "welcome remarks", "sunset social",
    "the on-going", "the mission of",
    "laptop to follow", "a photo id",
)

# --- fixed values: people -----------------------------------------------------
_NOT_FIRST_NAMES = {
    "machine", "big", "deep", "applied", "open", "free", "cloud", "data",
    "community", "shapeless", "software", "enterprise", "distributed",
    "real", "advanced", "new", "fast", "reactive", "functional",
    "mobile", "web", "tech", "ai", "ml", "iot", "devops", "agile",
    "scala", "spark", "kafka", "hadoop", "akka", "play", "flink",
    "joint", "lightning", "keynote", "workshop", "panel", "session",
    "solving", "building", "using", "leveraging", "exploring", "introducing",
    "understanding", "scaling", "managing", "designing", "deploying",
    "getting", "making", "running", "powering", "enabling", "winning",
    "ask", "welcome", "apache", "exabytes", "four", "splice", "large",
    "small", "natural", "graph", "vector", "knowledge", "neural",
}
_NOT_SURNAMES = {
    "learning", "data", "day", "materialization", "workshop", "science",
    "engineering", "computing", "intelligence", "analytics", "systems",
    "platform", "framework", "technologies", "services", "solutions",
    "conference", "summit", "meetup", "group", "team", "labs", "research",
    "security", "privacy", "compliance", "management", "governance",
    "processing", "storage", "pipeline", "architecture", "infrastructure",
    "anything", "spark", "engines", "mates", "network", "machine",
    "daily", "models", "graph", "graphs", "search", "retrieval",
}
_JOB_TITLES = {
    "ceo", "cto", "coo", "cfo", "vp", "director", "manager", "engineer",
    "architect", "researcher", "developer", "scientist", "consultant",
    "founder", "co-founder", "partner", "senior engineer", "software engineer",
    "ml engineer", "principal engineer", "staff engineer",
}
_ROLE_STARTS = {
    "vp", "evp", "svp", "director", "ceo", "cto", "coo", "cfo",
    "head", "senior", "principal", "staff", "founder", "co-founder",
    "engineer", "manager", "architect", "lead", "president",
    "partner", "chair", "chief", "developer", "advocate", "consultant",
    "specialist", "researcher", "scientist", "professor", "oss",
}
_SPEAKER_LABELS = ("Speaker:", "Presenter:", "Presenters:", "By:")

# --- fixed values: companies --------------------------------------------------
_ROLES = {
    "founder", "co-founder", "cofounder", "ceo", "cto", "coo", "cfo",
    "cio", "cmo", "vp", "evp", "svp", "phd", "ph.d.", "ph.d", "md",
    "professor", "asst. professor", "assistant professor",
    "associate professor", "engineer", "software engineer",
    "developer", "architect", "manager", "director",
}
_ROLE_ENDS = {
    "ceo", "cto", "coo", "cfo", "cio", "cmo", "vp", "evp", "svp",
    "founder", "co-founder", "cofounder", "president", "director",
    "manager", "engineer", "developer", "architect", "lead",
    "scientist", "researcher", "advocate", "evangelist", "consultant",
    "officer", "specialist", "phd", "ph.d", "md",
}
_MODIFIER_ENDS = {"software", "senior", "principal", "staff", "junior", "lead"}


class Speaker(NamedTuple):
    name: str
    company: str | None


def trim(text: str, more: str = "") -> str:
    return text.strip(_SPACE + more)


def words(text: str) -> list[str]:
    return [w for w in _GAP.split(text) if w]


def size(text: str) -> int:
    return len(text.encode("utf-8", "surrogatepass"))


def without_start(text: str, start: str) -> str:
    """The text without any number of `start` before it."""
    while start and text.startswith(start):
        text = text[len(start) :]
    return text


def plain(text: str) -> str:
    """Markdown of a single field as text: link texts, no emphasis, no backslashes."""
    return trim(_EMPHASIS.sub(r"\1", _LINK.sub(r"\1", text)).replace("\\", ""))


def could_be_name(text: str) -> bool:
    """No digit, and neither a first word nor a last one that names a thing."""
    parts = words(text)
    if not parts or re.search("[0-9]", text):
        return False
    return parts[0].lower() not in _NOT_FIRST_NAMES and parts[-1].lower() not in _NOT_SURNAMES


def is_person(text: str) -> bool:
    """Two or three capitalised words that could be a name, and nothing else."""
    parts = words(text)
    if len(parts) not in (2, 3) or any(f" {w} " in text for w in ("and", "of", "with", "for", "in")):
        return False
    return all(w[0].isupper() and all(c.islower() for c in w[1:]) and size(w) <= 15 for w in parts) and could_be_name(text)


def is_generic(text: str) -> bool:
    """Boilerplate, a heading, or a bare name."""
    low = trim(text.lower())
    return size(low) < 6 or low in _GENERIC or low.startswith(_GENERIC_STARTS) or trim(text).endswith(":") or is_person(text)


def is_title(text: str) -> bool:
    """Whether a fragment can be a talk's title, rather than prose, a notice or a heading."""
    if size(text) not in _TITLE_BYTES or text.endswith(":") or text.startswith(_NOT_BEFORE_TITLES):
        return False
    if any(part in text for part in _NOT_IN_TITLES) or any(p.match(text) for p in _PROSE):
        return False
    stops, count = text.count(". "), len(words(text))
    if stops >= 2 or (stops and count > 14) or (text.endswith((".", "!", "?")) and count > 12):
        return False
    return not is_generic(text)


def starts_upper(text: str) -> bool:
    return text[:1].isupper()


def is_job_title(text: str) -> bool:
    if trim(text.lower()) in _JOB_TITLES:
        return True
    return "," not in text and len(words(text)) <= 3 and any(w in text for w in ("Engineer", "Director", "Manager"))


def is_speaker_field(text: str) -> bool:
    """A short capitalised line with a comma, an "at" or an "@"."""
    text = trim(text)
    marked = "," in text or " at " in text or "@" in text
    return marked and "http" not in text and size(text) < 120 and len(words(text)) < 12 and not text.endswith(":") and starts_upper(text)


def is_speaker_line(text: str) -> bool:
    text = trim(text)
    emphasised = text.startswith("**") or (text.startswith("*") and text.endswith("*"))
    return size(text) < 120 if emphasised and "," in text else is_speaker_field(text)


def is_title_remainder(text: str) -> bool:
    """Four or more words after a name that are not a role or an affiliation."""
    parts = words(text)
    return len(parts) >= 4 and parts[0].lower() not in _ROLE_STARTS and " at the " not in text.lower()


def _without_ends(parts: list[str], ends: set[str]) -> list[str]:
    while len(parts) > 1 and parts[-1].strip(",").strip(".").lower() in ends:
        parts = parts[:-1]
    return parts


def clean_company(text: str) -> str | None:
    """The company in a field without roles before or after it; None if only a role is left, or it reads as prose."""
    text = trim(trim(text).rstrip(",").strip("*"))
    if not text or text.lower() in _ROLES:
        return None
    parts = _without_ends(_without_ends(words(text), _ROLE_ENDS), _MODIFIER_ENDS)
    company = " ".join(parts)
    low = company.lower()
    return None if len(parts) > 5 or any(w in low for w in (" for ", " of ", " with ")) else company


def company_of(field: str) -> str | None:
    """The company of the field after a name: what follows " at ", else the part after the last comma, else all of it."""
    field = trim(trim(field).rstrip("*"))
    at = field.lower().find(" at ")
    if at >= 0 and trim(field[at + 4 :]):
        return clean_company(trim(field[at + 4 :]))
    last = trim(trim(field.rsplit(",", 1)[-1]).strip("*")) if "," in field else ""
    return clean_company(last or field) if field else None


def split_person(raw: str) -> Speaker:
    """Name and company of one credit, by its first separator: "@", "(", commas, " at "."""
    raw = trim(trim(raw).strip("*").rstrip("."))
    for mark in "@(":
        name, found, rest = raw.partition(mark)
        if found:
            return Speaker(trim(name), company_of(rest.rstrip(")") if mark == "(" else rest))
    fields = [trim(p) for p in raw.split(",")]
    if len(fields) == 1:
        at = raw.lower().find(" at ")
        return Speaker(raw, None) if at < 0 else Speaker(trim(raw[:at]), trim(raw[at + 4 :]) or None)
    if len(fields) == 2 and is_person(fields[1]) and not is_person(fields[0]):
        return Speaker(fields[1], fields[0])
    return Speaker(fields[0], company_of(fields[1] if len(fields) == 2 else trim(fields[-1].strip("*"))))


def _joins(raw: str, word: str) -> bool:
    """Whether a conjunction joins people. After a comma it stands inside somebody's role."""
    comma, at = raw.find(","), raw.find(word)
    return comma < 0 or at < 0 or at < comma


def speakers_of(raw: str) -> list[Speaker]:
    """The people in a credit line, with their companies."""
    raw = trim(raw)
    for label in _SPEAKER_LABELS:
        raw = without_start(raw, label)
    raw = trim(raw)
    credits = [raw]
    for mark in (" and ", ";", " & "):
        if mark == ";" or _joins(raw, mark):
            credits = [p for c in credits for p in c.split(mark)]
    found = []
    for part in map(trim, credits):
        if size(part) < 5 or is_job_title(part):
            continue
        person = split_person(part)
        parts = words(person.name)
        named = 2 <= len(parts) <= 4 and all(starts_upper(w) for w in parts) and "http" not in person.name and ":" not in person.name
        if named and could_be_name(person.name):
            found.append(person)
    return found
