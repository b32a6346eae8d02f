"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier.

Candidate terms (words and word beginnings) are chosen on labelled rows. The most
telling ones become one-term voters, the others are pooled into lexicon voters,
and pattern voters watch the way a text is written. All of them vote on labelled
and unlabelled rows. The label model is generative: labels are hidden, and by
expectation and maximisation it finds their share, how often each voter fires under
either label, and which voters fire together, starting from whether any lexicon voter
fires. The given labels are one more voter, silent on unlabelled rows, whose accuracy
is estimated against what the others say. A linear classifier is trained on the
posterior labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .samples import bounded_sample, id_remainder
from .session import checkpointed
from .textkernels import mix64, span_hashes, text_slices

#: Rows held out from learning: those of remainder HELD by HELD_DIVISOR.
HELD_DIVISOR, HELD = 3, 1
#: The fit's bounds: labelled rows of a label, unlabelled rows, candidate terms, one-term voters and pooled voters.
SAMPLE_PER_LABEL = 2500
SAMPLE_UNLABELLED = 2500
CANDIDATES = 512
TERM_VOTERS = 48
POOLS = 8
#: Lengths of word beginnings, in bytes.
BEGINNINGS = range(3, 9)
#: What a candidate must reach: log-odds of label 1, and evidence (likelihood-ratio statistic) for them.
LEAST_ODDS, LEAST_EVIDENCE = 4.0, 28.0
#: A one-term voter reaches at least this part of the sample's label-1 rows that no two others reach.
LEAST_GAIN = 0.005
#: What a label-0 row costs a term in rows of label 1, and the part of its rows that makes it the same word as another.
WRONG_COST, SAME_WORD = 3.0, 0.9
#: A row without a given label.
UNLABELLED = -1
#: Rows seen in advance: of the given labels, right and wrong ones, and of each other voter, at its usual rate.
GIVEN_RIGHT, GIVEN_WRONG = 8.0, 2.0
VOTER_ROWS = 2.0
#: Kinds of rows of label 1, at most.
KINDS = 8
#: A voter fires on less than this part of the rows of label 0.
MOST_FALSE = 0.45
#: Probability of label 1 before the first round, where no lexicon voter fires and where one does.
START_SILENT, START_FIRED = 0.05, 0.9
ROUNDS = 25
CORRELATED = 0.7
PREDICT_AT = 0.7
ROWS_AT_ONCE = 4096

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(128, 256)]] = True
_WHOLE = np.uint64(0x632BE59BD9B4E019)

PATTERNS = ("shouting", "exclaiming", "second_person", "repeating")
_YOU = [b"you", b"your", b"du", b"dich", b"tu", b"toi", b"vous", b"usted"]


def letter_runs(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of letters (ASCII letters and all beyond ASCII), and the row of each."""
    letter = _LETTER[buf]
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[offsets] = True
    before, after = np.zeros(len(buf), dtype=bool), np.zeros(len(buf), dtype=bool)
    before[1:], after[:-1] = letter[:-1], letter[1:]
    starts = np.flatnonzero(letter & (~before | edge[:-1]))
    ends = np.flatnonzero(letter & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def term_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(index of word, end of term, hash) of every word as a whole, then of the words' beginnings, by length."""
    everything = np.arange(len(starts))
    yield everything, ends, mix64(span_hashes(buf, starts, ends) ^ _WHOLE)
    for length in BEGINNINGS:
        long = everything[ends - starts > length]
        yield long, starts[long] + length, span_hashes(buf, starts[long], starts[long] + length)


def row_terms(buf: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, bytes, int]]:
    """(row, term, surroundings) of distinct (row, term); a word beginning ends in "*".

    Surroundings are a hash of the words before and after the term's first place:
    rows that copy each other share them.
    """
    starts, ends, row = letter_runs(buf, offsets)
    raw = buf.tobytes().lower()
    words = np.concatenate([[np.uint64(0)], span_hashes(buf, starts, ends), [np.uint64(0)]])
    around = mix64(words[:-2] * np.uint64(3) + words[2:]).view(np.int64)
    for number, (word, stop, hashes) in enumerate(term_hashes(buf, starts, ends)):
        key = np.stack([row[word].astype(np.uint64), hashes])
        _, first = np.unique(key, axis=1, return_index=True)
        mark = b"*" if number else b""
        for i in first:
            yield int(row[word[i]]), raw[starts[word[i]] : stop[i]] + mark, int(around[word[i]])


@dataclass
class Lexicon:
    """Terms and the voter of each; lookups go by hash."""

    terms: list[bytes]
    voter: np.ndarray
    voters: int

    def __post_init__(self) -> None:
        hashes = np.zeros(len(self.terms), dtype=np.uint64)
        for i, t in enumerate(self.terms):
            body = np.frombuffer(t.rstrip(b"*"), dtype=np.uint8)
            h = span_hashes(body, np.array([0]), np.array([len(body)]))
            hashes[i] = h[0] if t.endswith(b"*") else mix64(h ^ _WHOLE)[0]
        order = np.argsort(hashes)
        self.hashes, self.number = hashes[order], order
        self.seen = np.zeros(1 << 16, dtype=bool)
        self.seen[(hashes & np.uint64(0xFFFF)).astype(np.int64)] = True

    def hits(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, term) of every place where a term stands."""
        starts, ends, row = letter_runs(buf, offsets)
        rows, terms = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for word, _, hashes in term_hashes(buf, starts, ends) if self.terms else ():
            near = np.flatnonzero(self.seen[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.hashes, hashes[near]), len(self.hashes) - 1)
            same = self.hashes[at] == hashes[near]
            rows.append(row[word[near[same]]])
            terms.append(self.number[at[same]])
        return np.concatenate(rows), np.concatenate(terms)


def _votes(lexicon: Lexicon, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which lexicon voters fire (rows x voters)."""
    rows, terms = lexicon.hits(buf, offsets)
    out = np.zeros((len(offsets) - 1, lexicon.voters), dtype=bool)
    out[rows, lexicon.voter[terms]] = True
    return out


def _patterns(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which pattern voters fire (rows x PATTERNS)."""
    starts, ends, row = letter_runs(buf, offsets)
    n = len(offsets) - 1
    words = np.maximum(np.bincount(row, minlength=n), 1)
    upper = (buf >= 65) & (buf <= 90)
    edges = np.concatenate([[0], np.cumsum(upper)])
    shouted = np.bincount(row, (edges[ends] - edges[starts] == ends - starts) & (ends - starts > 2), n)
    marks = np.concatenate([[0], np.cumsum(buf == ord("!"))])
    hashes = span_hashes(buf, starts, ends)
    you = np.frombuffer(b"".join(_YOU), dtype=np.uint8)
    stops = np.cumsum([len(y) for y in _YOU])
    spoken = np.bincount(row, np.isin(hashes, span_hashes(you, stops - [len(y) for y in _YOU], stops)), n)
    again = np.zeros(len(starts), dtype=bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    return np.stack([
        shouted > 0.3 * words, marks[offsets[1:]] - marks[offsets[:-1]] > 0.1 * words, spoken > 0.02 * words,
        np.bincount(row, again, n) > 0.3 * words,
    ], axis=1)


# --- label model ----------------------------------------------------------------


@dataclass
class LabelModel:
    """Shares of label 0 and of the kinds of label 1, how often each voter fires in each of them, the weight left to each
    voter by its correlations, and how often a given label is right where label 1 or label 0 holds."""

    shares: np.ndarray
    rates: np.ndarray
    weight: np.ndarray
    right1: float
    right0: float

    @property
    def prior(self) -> float:
        return float(self.shares[1:].sum())

    @property
    def false(self) -> np.ndarray:
        return self.rates[0]

    @property
    def hit(self) -> np.ndarray:
        return self.shares[1:] @ self.rates[1:] / self.prior

    def joint(self, votes: np.ndarray) -> np.ndarray:
        """Log-likelihood of the votes with each kind (rows x kinds); the voter of silence stands last, as for fit_label_model()."""
        votes, silent = votes[:, :-1], np.log(1 - self.rates)
        return np.log(self.shares) + (votes * self.weight) @ (np.log(self.rates) - silent).T + silent @ self.weight

    def odds(self, votes: np.ndarray) -> np.ndarray:
        """Log-odds of label 1 by the votes alone."""
        joint = self.joint(votes)
        return np.logaddexp.reduce(joint[:, 1:], axis=1) - joint[:, 0]

    def posterior(self, votes: np.ndarray, given: np.ndarray | None = None) -> np.ndarray:
        """Probability of label 1; given labels (1, 0 or UNLABELLED) vote too."""
        odds = self.odds(votes)
        if given is not None:
            odds = odds + np.log(self.right1 / (1 - self.right0)) * (given == 1) + np.log((1 - self.right1) / self.right0) * (given == 0)
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def _odds(p: np.ndarray | float) -> np.ndarray:
    return np.log(p / (1 - p))


def _correlation_weights(votes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Each voter's weight: less, the more it fires together with others within a kind of rows (rows x kinds)."""
    cov = np.zeros((votes.shape[1], votes.shape[1]))
    for belief in kinds.T:
        centred = (votes - belief @ votes / max(belief.sum(), 1e-9)) * np.sqrt(belief)[:, None]
        cov += centred.T @ centred / len(votes)
    scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    correlation = cov / scale[:, None] / scale
    np.fill_diagonal(correlation, 0)
    return 1 / (1 + np.where(correlation > CORRELATED, correlation, 0).sum(axis=1))


def fit_label_model(votes: np.ndarray, given: np.ndarray) -> LabelModel:
    """The generative model of votes (rows x voters; the last column, the voter of silence, only starts it) and given labels.

    Rows of label 1 are of one or more kinds, in each of which voters fire at rates of
    their own: voters that go together, or shut each other out, as those of different
    languages do, are told apart so. Of up to KINDS kinds as
    many are taken as give the best likelihood for their rates (Bayes' criterion).
    """
    best, cost = None, np.inf
    for kinds in range(1, KINDS + 1):
        model, likelihood = _fit_kinds(votes, given, kinds)
        if (now := kinds * votes.shape[1] * np.log(len(votes)) / 2 - likelihood) < cost:
            best, cost = model, now
    return best


def _first_kinds(cast: np.ndarray, fired: np.ndarray, kinds: int) -> np.ndarray:
    """Rows x kinds of label 1: each led by the voter that fires on most rows where no earlier leader does."""
    out, free = np.full((len(cast), kinds), 1 / kinds), fired.copy()
    for k in range(kinds):
        led = free & (cast[:, int(np.argmax(free @ cast))] == 1)
        out[led] = np.eye(kinds)[k] * 0.9 + 0.1 / kinds
        free &= ~led
    return out


def _fit_kinds(votes: np.ndarray, given: np.ndarray, kinds: int) -> tuple[LabelModel, float]:
    """A model of so many kinds of label 1, and its log-likelihood with all weights whole.

    Labels and kinds are hidden: by expectation and maximisation over all rows,
    labelled or not, their shares and the voters' rates are found, starting from
    whether any lexicon voter fires. A rate under label 0 stays below MOST_FALSE, so
    the labels keep their names. Given labels are one more voter; it is judged by the
    posterior of the others, so it never confirms itself. Voters that fire together
    within a kind share their weight.
    """
    cast, fired, n, known = votes[:, :-1].astype(np.float64), votes[:, -1] == 0, len(given), given != UNLABELLED
    alone = np.where(fired, START_FIRED, START_SILENT)
    belief = np.column_stack([1 - alone, alone[:, None] * _first_kinds(cast, fired, kinds)])
    weight, usual = np.ones(cast.shape[1]), (cast.sum(axis=0) + 1) / (n + 2)
    for round_ in range(ROUNDS):
        sums = belief.sum(axis=0)
        rates = np.clip((belief.T @ cast + VOTER_ROWS * usual) / (sums + VOTER_ROWS)[:, None], 1e-5, 1 - 1e-5)
        rates[0] = np.minimum(rates[0], MOST_FALSE)
        right1 = (alone[given == 1].sum() + GIVEN_RIGHT) / (alone[known].sum() + GIVEN_RIGHT + GIVEN_WRONG)
        right0 = ((1 - alone)[given == 0].sum() + GIVEN_RIGHT) / ((1 - alone)[known].sum() + GIVEN_RIGHT + GIVEN_WRONG)
        if round_ % 5 == 4:
            weight = _correlation_weights(cast, belief)
        model = LabelModel((sums + 1) / (n + kinds + 1), rates, weight, float(right1), float(right0))
        alone = 1 / (1 + np.exp(-np.clip(model.odds(votes), -40, 40)))
        one, zero = (given == 1)[:, None], (given == 0)[:, None]
        of0, of1 = np.array([1.0] + [0.0] * kinds), np.array([0.0] + [1.0] * kinds)
        named = one * np.log(of1 * right1 + of0 * (1 - right0)) + zero * np.log(of1 * (1 - right1) + of0 * right0)
        joint = model.joint(votes) + named
        belief = np.exp(joint - np.logaddexp.reduce(joint, axis=1)[:, None])
    whole = replace(model, weight=np.ones(len(weight))).joint(votes) + named
    return model, float(np.logaddexp.reduce(whole, axis=1).sum())


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic weights (bias last) for labels between 0 and 1, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    labels: LabelModel
    linear: np.ndarray

    def features(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Votes, how many one-term voters fired, and patterns."""
        votes, patterns = _votes(self.lexicon, buf, offsets), _patterns(buf, offsets)
        return linear_features(votes, patterns)

    def scores(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        x = self.features(buf, offsets)
        return 1 / (1 + np.exp(-np.clip(x @ self.linear[:-1] + self.linear[-1], -30, 30)))


def linear_features(votes: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    single = votes[:, : max(0, votes.shape[1] - POOLS)].sum(axis=1)
    return np.column_stack([votes, single > 0, np.minimum(single, 4) / 2, patterns]).astype(np.float64)


def _covering(fired: np.ndarray, toxic: np.ndarray, odds: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Terms that in turn reach most label-1 rows that no two earlier ones reach, and which terms say nothing beyond these.

    A term goes unused when the rows where it fires are, but for a few, rows of a
    chosen one: it is the same word cut elsewhere.
    """
    fired = fired.astype(np.float64)
    reached, chosen, free, n = np.zeros(len(toxic)), [], np.ones(fired.shape[1], dtype=bool), fired.sum(axis=0)
    wrong = fired[~toxic].sum(axis=0)
    for _ in range(min(TERM_VOTERS, fired.shape[1])):
        gain = ((reached[toxic] < 2).astype(float) @ fired[toxic]) * (odds / odds.max()) - WRONG_COST * wrong
        gain[~free] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] < max(2.0, LEAST_GAIN * toxic.sum()):
            break
        chosen.append(best)
        free[best] = False
        free &= fired[:, best] @ fired < SAME_WORD * n
        reached += fired[:, best]
    return chosen, ~free


def _sampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, text) of a bounded sample of rows that are not held out: labelled ones, and unlabelled ones as UNLABELLED.

    Rows of equal label and text count once. The sample is kept, as several passes read it.
    """
    told = labels.select("doc_id", F.col("toxic").cast("int").alias("label")).filter("label IN (0, 1) AND doc_id IS NOT NULL")
    told = told.filter(id_remainder(F.col("doc_id"), HELD_DIVISOR) != HELD)
    sample = bounded_sample(told, "label", SAMPLE_PER_LABEL, 2 * SAMPLE_PER_LABEL)
    own = docs.select("doc_id", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    labelled = own.join(F.broadcast(sample), "doc_id").select("label", "text")  # at most about 2 * SAMPLE_PER_LABEL ids
    free = own.filter(id_remainder(F.col("doc_id"), HELD_DIVISOR) != HELD)
    near = bounded_sample(free.select("doc_id", F.lit(UNLABELLED).alias("label")), "label", SAMPLE_UNLABELLED, SAMPLE_UNLABELLED)
    near = near.join(labels.select("doc_id"), "doc_id", "left_anti")
    unlabelled = free.join(F.broadcast(near), "doc_id").select("label", "text")
    return checkpointed(labelled.unionByName(unlabelled).dropDuplicates(["text", "label"]))


def fit_documents(docs: DataFrame, labels: DataFrame) -> ToxicityModel | None:
    """The model of a bounded sample of the rows that are not held out; None without both labels or any term.

    Terms are counted in Spark; the driver gets CANDIDATES terms and the sample's votes.
    """
    rows = _sampled(docs, labels)
    known = rows.filter(F.col("label") != UNLABELLED)

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, buf, offsets in text_slices(batch.column("text"), rows=ROWS_AT_ONCE):
                label = batch.column("label").slice(first, end - first).to_pylist()
                found = list(row_terms(buf, offsets))
                columns = [
                    pa.array([t for _, t, _ in found], pa.binary()),
                    pa.array([label[r] for r, _, _ in found], pa.int32()),
                    pa.array([c for _, _, c in found], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["term", "label", "around"])

    totals = dict(known.groupBy("label").count().collect())
    if len(totals) < 2:
        return None
    # copies of a row of label 1 count once: by distinct surroundings
    counted = known.mapInArrow(terms, "term binary, label int, around long").groupBy("term").agg(
        F.count_distinct(F.when(F.col("label") == 1, F.col("around"))).alias("n1"), F.count_if(F.col("label") == 0).alias("n0")
    )
    odds = F.log((F.col("n1") + 0.5) / (totals[1] + 1)) - F.log((F.col("n0") + 0.5) / (totals[0] + 1))
    share = totals[1] / (totals[0] + totals[1])
    both = F.col("n1") + F.col("n0")
    evidence = 2 * (F.col("n1") * F.log(F.col("n1") / (both * share)) + F.when(F.col("n0") > 0, F.col("n0") * F.log(F.col("n0") / (both * (1 - share)))).otherwise(0))
    told = counted.filter("n1 > 0").withColumn("odds", odds).withColumn("evidence", evidence)
    told = told.filter((F.col("odds") > LEAST_ODDS) & (F.col("evidence") > LEAST_EVIDENCE))
    best = told.orderBy(F.desc("evidence"), "term").limit(CANDIDATES).collect()
    if not best:
        return None
    every = Lexicon([bytes(r["term"]) for r in best], np.arange(len(best)), len(best))

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, buf, offsets in text_slices(batch.column("text"), rows=ROWS_AT_ONCE):
                bits = np.packbits(np.column_stack([_votes(every, buf, offsets), _patterns(buf, offsets)]), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").slice(first, end - first), pa.array([b.tobytes() for b in bits], pa.binary())], names=["label", "bits"]
                )

    cast = sorted((r["label"], bytes(r["bits"])) for r in rows.mapInArrow(votes, "label int, bits binary").collect())
    given = np.array([k for k, _ in cast])
    bits = np.unpackbits(np.frombuffer(b"".join(b for _, b in cast), dtype=np.uint8).reshape(len(cast), -1), axis=1)
    return fit_votes(every.terms, np.array([r["odds"] for r in best]), bits[:, : len(best)], bits[:, len(best) : len(best) + len(PATTERNS)], given)


def fit_votes(terms: list[bytes], odds: np.ndarray, fired: np.ndarray, patterns: np.ndarray, given: np.ndarray) -> ToxicityModel:
    """The model of which candidate terms and patterns stand in the sampled rows, and the rows' given labels."""
    known = given != UNLABELLED
    chosen, told = _covering(fired[known], given[known] == 1, odds)
    kept = [*chosen, *np.flatnonzero(~told).tolist()]
    terms, fired = [terms[i] for i in kept], fired[:, kept]
    chosen, rest = list(range(len(chosen))), list(range(len(chosen), len(kept)))
    voter = np.zeros(len(terms), dtype=np.int64)
    voter[chosen] = np.arange(len(chosen))
    voter[rest] = len(chosen) + np.arange(len(rest)) % POOLS
    voters = len(chosen) + POOLS
    votes = np.zeros((len(fired), voters), dtype=bool)
    for i in range(len(terms)):
        votes[:, voter[i]] |= fired[:, i].astype(bool)
    cast = np.column_stack([votes, patterns, ~votes.any(axis=1)]).astype(np.float64)
    labels = fit_label_model(cast, given)
    return ToxicityModel(Lexicon(terms, voter, voters), labels, fit_linear(linear_features(votes, patterns), labels.posterior(cast, given)))


def score_documents(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """All rows with `toxic_score` added (0 to 1), from the whole text.

    Null texts count as empty, and these have a score too. Without a model every
    score is 0. Null ids, repeated rows and other columns pass through.
    """
    kept = [c for c in docs.columns if c != "toxic_score"]
    told = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, buf, offsets in text_slices(batch.column("text"), rows=ROWS_AT_ONCE):
                part = batch.slice(first, end - first)
                scores = np.zeros(end - first) if told.value is None else told.value.scores(buf, offsets)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(scores, pa.float64())], names=[*kept, "toxic_score"])

    return docs.select(*kept).mapInArrow(run, T.StructType([*(docs.schema[c] for c in kept), T.StructField("toxic_score", T.DoubleType())]))
