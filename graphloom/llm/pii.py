"""Personal data in whole texts: patterns propose, checksums confirm, context words adjust.

Positions are code points, ends exclusive. Matching is per text and needs no
shuffle; texts without the marks of a kind ("@", a digit, "+") skip its pattern.
IBANs are found with spaces or none between their groups, not with hyphens.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Kinds in output order; those after "phone" are added to the base kinds.
KINDS = ("email", "ip", "card", "phone", "iban")
BASE_KINDS = KINDS[:4]

#: A span whose score is lower is reported, but not acted upon.
ACT_AT = 0.5
#: Code points before and after a span in which context words count.
CONTEXT = 48
#: What a word for the kind adds; what a word against it takes, where no word for it is near.
MORE, LESS = 0.15, 0.25

# A run is matched whole, with or without what must follow it, so that a long
# run is read once and not once from each of its characters.
_DIGIT = re.compile("[0-9]")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)?")
_IP = re.compile(r"([0-9]++)(?:\.([0-9]++)(?:\.([0-9]++)(?:\.([0-9]++))?)?)?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{2}[0-9]{2}(?:\x20?[A-Za-z0-9]){11,30}(?![A-Za-z0-9])")
_WORD = re.compile(r"[a-z]+")
_NOT_DIGIT = re.compile("[^0-9]")

#: Start score of a confirmed span, and words near it that raise or lower it.
_START = {"email": 0.8, "ip": 0.55, "card": 0.75, "phone": 0.65, "iban": 0.8}
_FOR = {
    "email": {"mail", "email", "contact", "write", "reach"},
    "ip": {"ip", "address", "host", "server", "client"},
    "card": {"card", "credit", "debit", "visa", "mastercard", "amex", "payment"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "fax", "cell"},
    "iban": {"iban", "account", "bank", "transfer", "konto"},
}
_AGAINST = {
    "email": {"example", "noreply"},
    "ip": {"version", "release", "section", "build"},
    "card": {"order", "invoice", "tracking", "isbn", "serial"},
    "phone": {"order", "invoice", "serial"},
    "iban": {"order", "serial", "part", "sku"},
}


#: Characters of an IBAN by country.
_IBAN_LENGTHS = {
    code: n
    for n, codes in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for code in codes.split()
}


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Whether a digit string passes the Luhn check."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = ord(d) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an IBAN without spaces leaves 1 modulo 97."""
    moved = iban[4:] + iban[:4]  # letters count from 10 on, in either case
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Confirmed (start, end). A run may go on into the words after an IBAN, so an end before is looked for.

    The length of the country counts first, then the whole run; where the country is
    unknown, each word end from the last. In lower or mixed case only a country's own
    length counts. What follows a kept span, or a head without one, is looked at anew.
    """
    at = 0
    while m := _IBAN.search(text, at):
        run = m[0]
        ends = [i for i in range(len(run), 0, -1) if run[i - 1] != " " and (i == len(run) or run[i] == " ")]
        known = _IBAN_LENGTHS.get(run[:2].upper())
        if known or not run.isupper():
            ends = [i for i in ends if i - run.count(" ", 0, i) == known] + [len(run)] * run.isupper()
        bare = ((i, run[:i].replace(" ", "")) for i in ends)
        end = next((i for i, b in bare if len(b) >= 15 and mod97(b)), None)
        if end:
            yield m.start(), m.start() + end
        at = m.start() + (end or 1)


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed (kind, start, end), by kind as listed, then start."""
    if "@" in text:
        for m in _EMAIL.finditer(text):
            if m.start(1) >= 0:
                yield "email", m.start(), m.end()
    if not _DIGIT.search(text):
        return
    if "." in text:
        for m in _IP.finditer(text):
            if m.start(4) >= 0:
                parts = (p.lstrip("0") for p in m.groups())
                if all(len(p) < 4 and int(p or "0") <= 255 for p in parts):
                    yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                yield "phone", m.start(), m.end()
    for start, end in _ibans(text):
        yield "iban", start, end


def find_spans(text: str | None) -> list[Span]:
    """All spans of a text (null: empty), by kind as listed, then start; words on either side adjust their scores."""
    spans, text = [], text or ""
    for kind, start, end in _proposed(text):
        near = set(_WORD.findall(text[max(0, start - CONTEXT) : start].lower())) | set(_WORD.findall(text[end : end + CONTEXT].lower()))
        score = _START[kind] + (MORE if near & _FOR[kind] else -LESS if near & _AGAINST[kind] else 0)
        spans.append(Span(kind, start, end, round(min(score, 1.0), 2)))
    return spans


def redacted(text: str) -> str:
    """The text with every span of a score of ACT_AT or more replaced by its kind in brackets; overlapping spans become one."""
    spans = sorted((s for s in find_spans(text) if s.score >= ACT_AT), key=lambda s: (s.start, -s.end))
    out, at, i = [], 0, 0
    while i < len(spans):
        first = best = spans[i]
        end = first.end
        i += 1
        while i < len(spans) and spans[i].start < end:
            end = max(end, spans[i].end)
            best = max(best, spans[i], key=lambda s: s.score)
            i += 1
        out += [text[at : first.start], f"[{best.kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]]) if out else text


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


_NONE = hashlib.sha256(b"").hexdigest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: dict[str, list] = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "scores")}
        for text in batch.column("text").to_pylist():
            spans = find_spans(text)
            base = [s for s in spans if s.kind in BASE_KINDS]
            for kind in BASE_KINDS:
                columns[f"n_{kind}"].append(sum(s.kind == kind for s in base))
            columns["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest() if base else _NONE)
            columns["spans"].append(_joined(spans))
            columns["scores"].append(",".join(f"{s.score:.2f}" for s in spans))
        kinds = [pa.int64()] * 4 + [pa.string()] * 3
        arrays = [pa.array(v, type=t) for v, t in zip(columns.values(), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", *columns])


def _id_type(docs: DataFrame) -> T.DataType:
    return docs.schema["doc_id"].dataType


def pii_digests(docs: DataFrame) -> DataFrame:
    """One row per document: counts of base kinds, the digest of the base spans, and all spans with their scores.

    A null text counts as empty, and has no span; null ids and repeated rows pass
    through. Other columns are not read.
    """
    schema = T.StructType([T.StructField("doc_id", _id_type(docs))])
    for kind in BASE_KINDS:
        schema.add(f"n_{kind}", T.LongType())
    for name in ("base_sha256", "spans", "scores"):
        schema.add(name, T.StringType())
    return docs.select("doc_id", "text").mapInArrow(_digests, schema)


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts = [t if t is None else redacted(t) for t in batch.column(at).to_pylist()]
        yield batch.set_column(at, batch.schema.field(at), pa.array(texts, type=batch.schema.field(at).type))


def redact_documents(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced in `text`, and `n_chars`, where there is one, brought in line.

    All rows and columns stay; a null text stays null with its n_chars.
    """
    out = docs.mapInArrow(_redact, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))
    return out
