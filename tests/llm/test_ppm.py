import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from graphloom.llm import ppm as P
from graphloom.llm.queries import queries


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def symbols(text):
    return " ".join(words(text)).encode() + b"\n"


class Plain:
    """Contexts as dictionaries, one symbol after the other."""

    def __init__(self, texts, order):
        self.order, self.after = order, defaultdict(Counter)
        for s in map(symbols, texts):
            for i, b in enumerate(s):
                for k in range(order + 1):
                    self.after[self.context(s, i, k)][b] += 1

    def context(self, s, i, k):
        return (bytes(order_pad := max(0, k - i)) + s[max(0, i - k) : i])[: k if order_pad >= 0 else 0]

    def odds(self, s, i, b):
        gone, told = set(), 1.0
        for k in range(self.order, -1, -1):
            met = self.after.get(self.context(s, i, k))
            if not met:
                continue
            own = {x: n for x, n in met.items() if x not in gone}
            total = sum(own.values())
            if b in own:
                return told * (own[b] - 0.5) / total
            if total:
                told *= 0.5 * len(own) / total
            gone = set(met)
        return told / (P.BYTES - len(gone))

    def score(self, text):
        s = symbols(text)
        return sum(math.log10(self.odds(s, i, b)) for i, b in enumerate(s))


def wanted(docs, held):
    trains = [t for (d, t), h in zip(docs, held, strict=True) if not h]
    plain, c = Plain(trains, P.ORDER), Counter(w for t in trains for w in (*words(t), None))
    n, v = sum(c.values()), len(c)
    out = []
    for (d, t), h in zip(docs, held, strict=True):
        tokens = [*words(t), None]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        out.append((d, h, len(tokens), sum(c[w] > 0 for w in tokens), n, base, plain.score(t)))
    return out


def check(frame, told):
    got = [tuple(r) for r in frame.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:5], round(r[5], 6))
    assert len(got) == len(told)
    for a, b in zip(sorted(got, key=key), sorted(told, key=key), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


def test_query_against_the_contract(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    held = [zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in docs]
    check(queries()["op12_ppm"](spark, "/root/testdata/sf0.001"), wanted(docs, held))


def test_probabilities_sum_to_one():
    plain = Plain(["abab abra cadabra", "aé b"], P.ORDER)
    for s, i in ((b"abra\n", 3), (b"zzz\n", 2), ("aé\n".encode(), 2), (b"\n", 0)):
        assert sum(plain.odds(s, i, b) for b in range(256) if b not in (9, 11, 12, 13)) == pytest.approx(1)


def test_gram_values_sum_to_one(spark):
    """Every byte after every context of some texts, known or not."""
    grams = Counter()
    for text in ("abab abra cadabra", "abracadabra abba", "aé b"):
        s = bytes(P.ORDER) + symbols(text)
        for i in range(P.ORDER, len(s)):
            grams[int.from_bytes(s[i - P.ORDER : i + 1], "big")] += 1
    contexts = {g >> 8 for g in grams} | {int.from_bytes(c.encode(), "big") for c in ("qabra", "zzzzz", "qqqab")}
    rows = [(c << 8 | b, grams.get(c << 8 | b, 0)) for c in contexts for b in range(256) if b not in (9, 11, 12, 13)]
    every = spark.createDataFrame(rows, "key long, n long")
    levels, nodes = P.trie(every.filter("n > 0"))
    values = P.known_values(every.filter("n > 0"), nodes).unionByName(P.escaped_values(every.filter("n = 0"), levels, nodes))
    sums = values.groupBy(F.shiftright("key", 8).alias("c")).agg(F.sum(F.pow(F.lit(10.0), F.col("value"))).alias("p"), F.count("*").alias("n")).collect()
    assert len(sums) == len(contexts) and all(r.n == 252 and r.p == pytest.approx(1) for r in sums)


@pytest.mark.parametrize("often", [1 << 20, 300, 0])
def test_odd_rows(spark, monkeypatch, often):
    """Nulls, white and long texts, repeated ids and rows, many parts, other columns; held out as asked."""
    monkeypatch.setattr(P, "PART_BYTES", 3000)
    monkeypatch.setattr(P, "OFTEN", often)
    rng = np.random.default_rng(2)
    bag = [f"w{i}" for i in range(50)] + ["É", "straße", "\x00", "x" * 300]
    docs = [(None, None), (None, "a b"), (1, ""), (1, ""), (2, " \x0b\n\t "), (3, "  a  B\n\nc "), (3, "  a  B\n\nc ")]
    docs += [(10 + i, " ".join(rng.choice(bag, int(rng.integers(0, 80))))) for i in range(200)] + [(5000 + i, "copy of one text") for i in range(150)]
    frame = spark.createDataFrame([(*d, "p", 1.5) for d in docs], "doc_id long, text string, part string, score double").repartition(3)
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in docs]
    check(P.score_documents(frame), wanted(docs, held))
    check(P.score_documents(frame, F.col("doc_id") > 100), wanted(docs, [d is not None and d > 100 for d, _ in docs]))
    check(P.score_documents(frame, F.lit(True)), wanted(docs, [True] * len(docs)))


@pytest.mark.parametrize("text", [" a" * 700_000, "b" * 2_500_000, " " * 1_500_000 + "Ab\t" + "c " * 700_000 + "d", "\n" * 2_200_000, "e" * 1_100_000 + " f"])
def test_long_texts_are_read_in_pieces(text):
    """The same grams and words as in one piece."""
    one = symbols(text)
    grams, told = [], []
    for first, end, gram, begins, word, heads in P._pieces(pa.array([text])):
        assert (first, end, begins[-1], heads[-1]) == (0, 1, len(gram), len(word))
        grams.append(gram)
        told.append(word)
    padded = np.frombuffer(bytes(P.ORDER) + one, dtype=np.uint8).astype(np.int64)
    assert np.array_equal(np.concatenate(grams), sum(padded[P.ORDER - k : len(padded) - k] << (8 * k) for k in range(P.ORDER + 1)))
    assert len(np.concatenate(told)) == len(words(text))


def test_lookup():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 5000))
    at = P._lookup(keys)
    asked = np.random.default_rng(2).choice(keys, 20000)
    assert np.array_equal(keys[at(asked)], asked)
    assert at(np.array([-5])).tolist() == P._lookup(keys[:0])(np.array([3])).tolist() == [-1]
    values = lambda k: P.Values(pa.table({"key": pa.array(k), "value": k.astype(float), "known": k > 9}))
    assert [x.tolist() for x in values(np.array([5])).of(np.array([5, 20, 7]), values(np.array([7, 20])))] == [[5, 20, 7], [False, True, False]]
    with pytest.raises(KeyError):
        values(np.array([5])).of(np.array([6]), values(np.array([7])))


def test_empty_table(spark):
    assert P.score_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
