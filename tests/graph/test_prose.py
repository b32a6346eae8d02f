"""Hand-worked cases of the text heuristics."""

import pytest

from graphloom.functions import prose as P
from graphloom.functions.talktext import event_title_talks, extract, talk_title


def talks(text, title=None):
    return [(t.title, [tuple(s) for s in t.speakers], t.abstract) for t in extract(text, title, text)]


LAYOUTS = {
    "bold title": (
        "**Streaming Joins at Scale**\n\n***Jane Roe*, Acme Corp**\n\nWe show how.\nIt works.\n\n* next bullet",
        [("Streaming Joins at Scale", [("Jane Roe", "Acme Corp")], "We show how.\nIt works.")],
    ),
    "numbered with prose": (
        "(1) Fast Parsers in Practice\nJane Roe will be talking at Acme about parsers.\n(2) John Doe, Typed Pipelines for Everyone\nSome words.",
        [
            ("Fast Parsers in Practice", [("Jane Roe", "Acme")], "Jane Roe will be talking at Acme about parsers."),
            ("Typed Pipelines for Everyone", [("John Doe", None)], "Some words."),
        ],
    ),
    "labels": (
        "Presentation: Columnar Formats Compared Again\nSpeaker: Jane Roe, Engineer at Acme\nIt is about files.\n\n**Talk:** Better Shuffles for Today\nBy: John Doe and Ann Poe",
        [
            ("Columnar Formats Compared Again", [("Jane Roe", "Acme")], "It is about files."),
            ("Better Shuffles for Today", [("John Doe", None), ("Ann Poe", None)], None),
        ],
    ),
    "heading with label": (
        "# Query Planning Explained Once\n\n**Speaker:** Jane Roe, Acme\n**Bio:** Jane plans.\n# Unrelated Heading Here\ntext",
        [("Query Planning Explained Once", [("Jane Roe", "Acme")], "Bio: Jane plans.")],
    ),
    "quoted": (
        '"Caches with No Tears" by Jane Roe (Acme)\nAbstract here.\n\n“Sorting Far Away”\nJohn Doe, Initech\nMore.',
        [("Caches with No Tears", [("Jane Roe", "Acme")], "Abstract here.\n\n“Sorting Far Away”\nJohn Doe, Initech\nMore.")],
    ),
    "bullets with sentences": (
        "* Building Small Indexes Quickly. Jane Roe, Acme\n- Reading Large Files Slowly – John Doe, Initech\n* **Ann Poe**, chair, Acme",
        [("Building Small Indexes Quickly", [("Jane Roe", "Acme")], None), ("Reading Large Files Slowly", [("John Doe", "Initech")], None)],
    ),
    "bullet agenda": (
        "* **Lazy Evaluation in Practice** - *Jane Roe, Acme*\nWhy lazy.\n* Eager Evaluation in Practice - John Doe, Initech\n* **Third Thing to See**\n\nAnn Poe, Umbrella\nBody.",
        [
            ("Lazy Evaluation in Practice", [("Jane Roe", "Acme")], "Why lazy."),
            ("Eager Evaluation in Practice", [("John Doe", "Initech")], None),
            ("Third Thing to See", [("Ann Poe", "Umbrella")], "Body."),
        ],
    ),
    "time slots": (
        "6:30 - 7:00 - Networking\n7:00 - Tuning Joins For Speed - Jane Roe, CTO at Acme\n7:40 – John Doe, Why Tables Need Good Keys",
        [("Tuning Joins For Speed", [("Jane Roe", "Acme")], None), ("Why Tables Need Good Keys", [("John Doe", None)], None)],
    ),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    text, wanted = LAYOUTS[name]
    assert talks(text) == wanted


def test_event_titles_and_fallback():
    assert talks("nothing here", "Jane Roe: Graphs in Anger") == [("Graphs in Anger", [("Jane Roe", None)], None)]
    two = event_title_talks("Jane Roe, 'Graphs in Anger'; John Doe, \"Trees at Rest\"", "x" * 40)
    assert [(t.title, t.speakers[0].name, t.abstract) for t in two] == [("Graphs in Anger", "Jane Roe", "x" * 40), ("Trees at Rest", "John Doe", "x" * 40)]
    long = event_title_talks("Jane Roe: Graphs in Anger", "é" * 600)[0].abstract
    assert long == "é" * 500
    assert talks("nothing", None) == [] and talks(None) == [] and talks("") == []
    assert talk_title(" Tech Talk 2: Keys ") == "Keys" and talk_title("Talk about keys") == "Talk about keys"


def test_escapes_and_zero_width_characters():
    assert talks("​\\*\\*Streaming Joins at Scale\\*\\*\nJane Roe, Acme")[0][0] == "Streaming Joins at Scale"


@pytest.mark.parametrize(
    "title",
    [
        "short", "x" * 201, "see http://a.b now", "The agenda is:", "!Wow what a talk", "All MUST BE REGISTERED now", "RSVP for this talk",
        "Please come early", "Note: bring a laptop", "6:30 pm doors and food", "Jane will show us joins", "Jane Roe is an expert here",
        "Built using many small parts", "One. Two words. Three more", "A b c. d e f g h i j k l m n o", "One two three four five six seven eight nine ten eleven twelve thirteen.",
        "Do one two three four five six seven eight nine ten eleven twelve?", "Jane Roe, a maker of things", "What if it rains", "networking", "about the venue", "Jane Roe",
    ],
)
def test_not_titles(title):
    assert not P.is_title(title)


def test_titles():
    assert all(map(P.is_title, ["ducktape for tests", "A Short Title Indeed", "Why Tables Need Good Keys?", "x" * 200, "v2. of the thing"]))


def test_people_and_companies():
    assert P.is_person("Jane Roe") and P.is_person("Jane Ann Roe")
    assert not any(map(P.is_person, ["Jane", "jane roe", "Jane ROE", "Big Data", "Jane Systems", "Jane Roe Poe Doe", "Jane Roe2", "Jane Abcdefghijklmnopq"]))
    assert P.speakers_of("Speaker: Jane Roe (Acme) and John Doe @ Initech; Ann Poe") == [("Jane Roe", "Acme"), ("John Doe", "Initech"), ("Ann Poe", None)]
    assert P.speakers_of("Jane Roe, Head of Data with Joins and Keys") == [("Jane Roe", None)]
    assert P.speakers_of("Topaz Labs, Jane Roe") == [("Jane Roe", "Topaz Labs")]
    assert P.speakers_of("Software Engineer") == [] and P.speakers_of("Jane Roe2") == [] and P.speakers_of("of Acme Corp") == []
    assert P.clean_company("Voyage AI CEO") == "Voyage AI" and P.clean_company("Zilliz Cloud Software Engineer") == "Zilliz Cloud"
    assert P.clean_company("Founder") is None and P.clean_company("Head of Data") is None and P.clean_company("one two three four five six") is None
    assert P.company_of("VP Engineering at Zilliz") == "Zilliz" and P.company_of("Engineer, Core, Acme") == "Acme" and P.company_of("") is None
    assert P.is_job_title("ML Engineer") and P.is_job_title("Data Director") and not P.is_job_title("Jane Roe")
    assert P.is_speaker_line("**Jane Roe, Acme**") and not P.is_speaker_line("**" + "x" * 130 + ", y**") and not P.is_speaker_field("see http://x, y")
    assert P.is_title_remainder("how we made it") and not P.is_title_remainder("CTO of the whole thing") and not P.is_title_remainder("head at the big co")
