import hashlib
import re

from graphloom.llm.queries import queries
from graphloom.llm.pii import find_spans, luhn, pii_digests, redact_documents, redacted

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """The contract's base patterns, as written there."""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


CASES = [
    "", "a@b.c_d@e.f x", "a@b@c.d", "..@a.b-", "1.2.3 1.2.3.4.5.6.7.8", "256.1.1.1 1.2.3.0004 1.2..3.4",
    "4111 1111-1111 1111 2", "4111-1111-1111-1111", "+1 (202) 555-0175.", "+1+12025550175", "é 10.0.0.1 mail x@y.zz",
    "+49 30 1234567 8.8.8.8", "9" * 5000, "a" * 5000, "1." * 3000, "GB82 WEST 1234 5698 7654 32",
]


def test_base_spans_equal_the_plain_patterns():
    import random

    rng = random.Random(5)
    made = ["".join(rng.choice("ab@..--_+12340 ()é\n") for _ in range(60)) for _ in range(3000)]
    for text in CASES + made:
        got = [s[:3] for s in find_spans(text) if s.kind != "iban"]
        assert got == plain(text), text


def test_checksums_and_context():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    (iban,) = [s for s in find_spans("bank account GB82 WEST 1234 5698 7654 32 now") if s.kind == "iban"]
    assert iban.score > 0.9
    assert not [s for s in find_spans("GB83 WEST 1234 5698 7654 32") if s.kind == "iban"]
    with_word = find_spans("card 4111111111111111")[0].score
    assert with_word > find_spans("thing 4111111111111111")[0].score > find_spans("order 4111111111111111")[0].score
    assert find_spans("4111111111111111 is my card")[0].score == with_word
    # what a score does: a version number stays unless a word for an address is near, on either side
    assert redacted("release 1.2.3.4") == "release 1.2.3.4" and redacted("release 1.2.3.4 of the server") == "release [IP] of the server"
    assert redacted("see 1.2.3.4") == "see [IP]" and redacted("invoice +49 30 1234567") == "invoice +49 30 1234567"


def test_ibans_in_lower_case():
    for text in ("gb82 west 1234 5698 7654 32 is my account", "de89 3704 0044 0532 0130 00 and more words", "Gb82WEST12345698765432"):
        (iban,) = [s for s in find_spans(text) if s.kind == "iban"]
        assert iban.start == 0 and len(text[: iban.end].replace(" ", "")) == 22
    assert not [s for s in find_spans("xx12 any words that stand in a row 1234 of lower case") if s.kind == "iban"]


def test_query_on_a_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries()["op7_pii"](spark, sf_dir).collect()}
    assert got.keys() == docs.keys()
    for d, text in docs.items():
        base = plain(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        r = got[d]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, _, _ in base) for kind in ("email", "ip", "card", "phone"))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))
    assert any(r.n_email for r in got.values()) and any(r.n_card for r in got.values())


def test_ibans_before_upper_case_words_and_digits():
    de, gb, no = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "NO9386011117947"
    unknown = "XX12 ABCD 1234 5678 9012"
    check = 98 - int("".join(str(int(c, 36)) for c in unknown[4:].replace(" ", "") + "XX00")) % 97
    unknown = f"XX{check:02d}{unknown[4:]}"
    for text, wanted in {
        f"IBAN {de} BIC COBADEFFXXX": [de],
        f"{gb} EUR 500": [gb],
        f"{de} 12 {gb} {no} A1": [de, gb, no],
        f"REF AB12 {de} X": [de],
        f"{unknown} EUR 500": [unknown],
        f"x{de} {de}x {de}": [de],
        f"{de[:-1]}1 BIC COBADEFFXXX": [],
    }.items():
        assert [text[s.start : s.end] for s in find_spans(text) if s.kind == "iban"] == wanted, text
    assert redacted(f"IBAN {de} BIC COBADEFFXXX") == "IBAN [IBAN] BIC COBADEFFXXX"


def test_redaction():
    assert redacted("to a@b.cc, at 10.1.2.3") == "to [EMAIL], at [IP]"
    assert redacted("none") == "none"


def test_digests_and_documents(spark):
    rows = [(1, "x a@b.cc 10.1.2.3", "en", 17), (None, None, None, None), (2, "", "en", 0), (2, "", "en", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    got = sorted(pii_digests(docs).collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    assert len(got) == 4
    assert got[1].n_email == 1 and got[1].n_ip == 1 and got[1].spans == "email:2:8,ip:9:17"
    assert got[1].base_sha256 == hashlib.sha256(b"email:2:8,ip:9:17").hexdigest()
    assert got[0].base_sha256 == hashlib.sha256(b"").hexdigest() and got[0].spans == ""
    out = redact_documents(docs)
    assert out.schema == docs.schema
    assert {(r.doc_id, r.text, r.n_chars) for r in out.collect()} == {(1, "x [EMAIL] [IP]", 14), (None, None, None), (2, "", 0)}
    assert pii_digests(docs.limit(0)).count() == 0
