"""The line rules as Columns against the small functions, and their plans."""

import random

import pytest
from pyspark.sql import functions as F

from graphloom import queries as Q
from graphloom.functions import credits, lines, prose

PLAIN = {
    "title": prose.is_title, "generic": prose.is_generic, "person": prose.is_person, "possible_name": prose.could_be_name, "job_title": prose.is_job_title,
    "speaker_line": prose.is_speaker_line, "speaker_field": prose.is_speaker_field, "title_remainder": prose.is_title_remainder,
}
PARTS = [
    "Ann", "Émile", "von", "O'Neil", "MacDonald", "Łukasz", "ÀÉ", "é", "Ünïcödelongername", "Engineer", "Director", "CTO", "at", "the", "of", "and", "with", "for", "in", "Data", "Learning", "spark",
    "Machine", "will", "is", "joins", "Built", "with", "6:30", "pm", "-", "–", ",", ", a friend", ".", ". ", "!", "?", ":", "@", "http://x", "*", "**", " ", " ", "\t", " ", "  ", "Networking", "agenda",
    "Please ", "In this talk", "RSVP", "About the ", "Head", "VP", "1", "日本", "ß", "ΑΒΓ", "Σίσυφος", "x" * 60, "Word " * 5,
]


def test_columns_equal_the_functions(spark):
    rng = random.Random(5)
    texts = {"", " ", " ", "Ann Bobson", "ann bobson", "A B C", "A B C D", "CEO", " CEO\t", "x" * 8, "x" * 200, "x" * 201, "é" * 100, "é" * 101, "a:", "One. Two. Three of them", "Abcdefghijklmno Bob", "Abcdefghijklmnop Bob"}
    for _ in range(6000):
        texts.add(rng.choice(["", " "]).join(rng.choice(PARTS) for _ in range(rng.randint(1, 9))))
    texts |= {w for name in ("_GENERIC", "_JOB_TITLES", "_GENERIC_STARTS", "_NOT_BEFORE_TITLES") for w in getattr(prose, name)}
    rows = spark.createDataFrame([(t,) for t in sorted(texts)], "line string").select("line", lines.line_kinds(F.col("line")).alias("k"))
    wrong = [(r.line, kind, r.k[kind]) for r in rows.collect() for kind, plain in PLAIN.items() if r.k[kind] != bool(plain(r.line))]
    assert wrong == []
    none = spark.createDataFrame([(None,)], "line string").select(lines.line_kinds(F.col("line")).alias("k")).first().k
    assert none.asDict() == {kind: bool(plain("")) for kind, plain in PLAIN.items()}


CREDITS = [
    "Ann", "Bob", "Émile", "Bobson", "Łukasz", "Engineer", "Director", "CTO", "CEO", "Founder", " at ", " and ", " & ", "; ", ",", ",", "@", " @ ", " (", ")", "(", "*", "**", ".", "Data", "Acme", "acmecorp", "Labs",
    "Software", "Senior", "VP,", "Ph.D.", "of", "with", " for ", "Speaker:", "By:", "Speaker: ", "http://x", ":", " ", "  ", "\t", "Machine", "Learning", "x", "", "Lead", "partner", "One Two Three Four Five Six",
]


def test_credit_columns_equal_the_functions(spark):
    rng = random.Random(3)
    texts = {"", ",", "*", "(", "@", " at ", "Ann Bobson at ", "Speaker:Speaker:Ann Bobson"}
    while len(texts) < 4000:
        texts.add(rng.choice(["", " "]).join(rng.choice(CREDITS) for _ in range(rng.randint(1, 8))))
    rows = spark.createDataFrame([(t,) for t in sorted(texts)], "line string").select("line", credits.credit(F.col("line")).alias("c"))
    for r in rows.collect():
        told = ([(s.name, s.company) for s in r.c.speakers], tuple(r.c.person), r.c.company_of, r.c.company)
        assert told == ([tuple(s) for s in prose.speakers_of(r.line)], tuple(prose.split_person(r.line)), prose.company_of(r.line), prose.clean_company(r.line)), r.line


@pytest.mark.parametrize("name", [n for n in Q.QUERIES if n.startswith(("h12", "h13", "h14", "h15", "b16", "b17", "b18", "b19", "b20", "b21", "b22"))])
def test_line_queries_have_no_python(spark, name):
    plan = Q.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
