import hashlib
import random
import time

import public_tokenizers
import pytest
import sentencepiece

from graphloom.llm import sentencepiece_bpe as S
from graphloom.llm.queries import queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
FIXED = [
    "", " ", "  a  b ", "a\nb\t\r\n c", "é é ﬁ ½", "\x00x", "▁a ▁ b", "<s> <0x41> </s> <unk>", "　x\xa0y", "日本語𠀀😀" * 50,
    "﻿x​y", "½ ﬀ Å  ", "a" * 3000, " " * 2000, "ab" * 700 + " " * 40 + "x", None, "aaa aaaa baaab", "!!!!????====----____" * 20,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_equal_to_the_library(library):
    rng = random.Random(1)
    texts = FIXED + ["".join(rng.choice("abet inhso\n.ñé日 ▁'") for _ in range(rng.randint(1, 300))) for _ in range(500)]
    ids, starts = S.encode_texts(texts, PATH)
    decoded = S.decode_ids(ids, starts, PATH)
    for i, text in enumerate(texts):
        wanted = library.encode(text or "")
        assert ids[starts[i] : starts[i + 1]].tolist() == wanted, text
        assert decoded[i] == library.decode(wanted), text


def test_long_words_merge_in_the_library_s_order(library):
    rng = random.Random(7)
    texts = ["a" * 20_001, "ab" * 9000, "=-" * 5000] + ["".join(rng.choice(letters) for _ in range(6000)) for letters in ("ab", "etaoinshr", "aaab", "-=_", "the ")]
    ids, starts = S.encode_texts(texts, PATH)
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == library.encode(text), text[:40]


def test_long_runs_of_spaces(library):
    """Equal to the library, in time that follows the length."""
    rng = random.Random(3)
    texts = [" " * 200_000, " " * 100_000 + "word", "a" + " " * 99_999 + "b   "]
    texts += [" " * n + w for n in range(70) for w in ("", "x", "\n", " the")]
    texts += ["".join(" " * rng.randint(0, 60) + rng.choice(["a", "the", "é", "\n", "▁▁▁"]) for _ in range(40)) for _ in range(100)]
    began = time.process_time()
    ids, starts = S.encode_texts(texts, PATH)
    assert time.process_time() - began < 4
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == library.encode(text), (len(text), text[-20:])


def test_runs_are_cut_only_where_that_is_safe():
    even = {" " * n: 9 for n in (2, 4, 8)} | {" ": 0, " a": 1}
    assert S.Vocabulary._space_run(even) == 8
    assert S.Vocabulary._space_run(even | {"    ": 8}) == S.Vocabulary._space_run(even | {"  a": 3}) == S.Vocabulary._space_run({" ": 0, " " * 3: 9}) == 0


def test_models_that_words_alone_cannot_encode_are_refused(monkeypatch):
    class Model(sentencepiece.SentencePieceProcessor):
        def id_to_piece(self, i):
            return "a▁b" if i == 5000 else super().id_to_piece(i)

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Model)
    with pytest.raises(ValueError):
        S.Vocabulary(PATH)


def test_decode_of_broken_bytes(library):
    vocab = S.vocabulary(PATH)
    for raw in ([0xE3, 0x81], [0xE3, 0x81, 0x41], [0xFF, 0xC3, 0xA9], [0x80], [0xF0, 0x9F, 0x98]):
        ids = [int(vocab.byte_ids[b]) for b in raw] + [library.encode("house")[0]]
        assert vocab.decode(ids) == library.decode(ids)


def test_query_on_a_whole_table(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries()["op2_sentencepiece"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text)
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_odd_rows(spark):
    rows = [(None, None, [1]), (1, "", [1]), (1, "", [1]), (2, "a house", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>")
    got = S.encode_decode(docs, PATH)
    assert got.columns == ["doc_id", "text", "ids", "decoded"]
    assert sorted(len(r.ids) for r in got.collect())[:3] == [0, 0, 0]
    assert S.encode_decode(docs.limit(0), PATH).count() == 0
