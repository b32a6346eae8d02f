"""SentencePiece BPE with byte fallback, by vectorised merge rounds over flat symbol arrays.

All distinct words of a batch stand in one flat array of symbols. In each round
the least pair rank of every segment is found by one segmented minimum, the places
of that rank are merged at once, from the left, and the array is compacted, until
no pair is left. A segment's round ends at the first merge that makes a pair of the
same or a lesser rank, so merges come in the library's own order, and results are
equal to its results, whatever a segment's length. A run of spaces, in which each
merge would end a round, is cut where it cannot merge across. No piece joins a space to the
left of another character, so words, with their leading spaces, merge on their own.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .textkernels import text_slices

#: The word separator of the pieces, and of texts that contain it themselves.
SPACE_MARK = "▁"
#: Distinct words kept from batch to batch; the store is emptied when it is full.
KEPT_WORDS = 200_000
#: UTF-8 bytes of text that are encoded at once.
PASS_BYTES = 4 << 20

_WORDS = re.compile(" +[^ ]*|[^ ]+")
_NO_PAIR = np.iinfo(np.int32).max
_UNKNOWN = -1

codecs.register_error("one_byte", lambda e: ("�", e.start + 1))


class Vocabulary:
    """Pieces, pair ranks and piece bytes of a model file.

    Words merge on their own only if no piece has a space after another character,
    and if no piece is taken before merging. A model with such a piece is refused.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        ids: dict[str, int] = {}
        self.byte_ids = np.zeros(256, dtype=np.int32)
        self.bytes: list[bytes] = []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value] = i
                self.bytes.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes.append(b"" if model.is_control(i) else " ⁇ ".encode())
            else:
                piece = piece.replace(SPACE_MARK, " ")
                if " " in piece.lstrip(" "):
                    raise ValueError(f"piece {piece!r} has a space after another character")
                ids[piece] = i
                self.bytes.append(piece.encode())
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.flat = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)

        # equal scores are equal ranks: the leftmost pair wins among them
        scores = {p: model.get_score(i) for p, i in ids.items()}
        if sum(s == 0 for p, s in scores.items() if len(p) > 1) > 1:  # only the first merge has score 0; user-defined pieces have no other
            raise ValueError("user-defined pieces of several characters are not read")
        rank_of = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs = {}
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = (rank_of[scores[piece]], i)
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        found = [pairs[k] for k in self.keys.tolist()]
        self.ranks = np.array([r for r, _ in found] + [_NO_PAIR], dtype=np.int32)
        self.merged = np.array([m for _, m in found] + [_UNKNOWN], dtype=np.int32)
        self.keys = np.append(self.keys, np.int64(-1 << 62))  # never equal to a key that is looked up

        single = {p: i for p, i in ids.items() if len(p) == 1}
        self.char_id = np.full(0x110000, _UNKNOWN, dtype=np.int32)
        self.char_id[[ord(c) for c in single]] = list(single.values())
        # neighbours inside some piece; between any other two characters no merge can ever reach across
        inside = {ord(p[j]) << 21 | ord(p[j + 1]) for p in ids for j in range(len(p) - 1)}
        self.neighbours = np.array(sorted(inside), dtype=np.int64)
        self.space_run = self._space_run({p: rank_of[s] for p, s in scores.items()})

    @staticmethod
    def _space_run(ranks: dict[str, int]) -> int:
        """Spaces after each of which a longer run of spaces can be cut, or 0 for never.

        If all pieces of several spaces have one rank, and none has another character
        after several, a run merges from its left: so many spaces become the longest
        such piece, which merges with nothing, whatever stands behind them.
        """
        kinds = {len(p): r for p, r in ranks.items() if not p.strip(" ")}
        several = {r for n, r in kinds.items() if n > 1}
        if len(several) != 1 or any(p.startswith("  ") and p.strip(" ") for p in ranks):
            return 0
        run = [1] * max(kinds)
        while (at := next((i for i in range(len(run) - 1) if run[i] + run[i + 1] in kinds), None)) is not None:
            run[at : at + 2] = [run[at] + run[at + 1]]
        return run[0] if len(run) == 1 else 0

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair in ranks and merged; the last entry stands for no pair."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.searchsorted(self.keys[:-1], key)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), at, len(self.keys) - 1)

    def merge_segments(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge every segment to the end: final symbols, and the segment of each."""
        none = len(self.keys) - 1
        segment = np.zeros(len(symbols), dtype=np.int64)
        segment[starts[1:]] = 1
        np.cumsum(segment, out=segment)
        pair = np.full(len(symbols), none, dtype=np.int64)
        inside = np.flatnonzero(segment[1:] == segment[:-1])
        pair[inside] = self.pairs(symbols[inside], symbols[inside + 1])
        done_symbols, done_segments = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        while len(symbols):
            rank = self.ranks[pair]
            first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            sizes = np.diff(np.append(first, len(symbols)))
            least = np.minimum.reduceat(rank, first)
            if (least == _NO_PAIR).any():
                keep = np.repeat(least != _NO_PAIR, sizes)
                done_symbols.append(symbols[~keep])
                done_segments.append(segment[~keep])
                symbols, segment, pair, rank = symbols[keep], segment[keep], pair[keep], rank[keep]
                sizes, least = sizes[least != _NO_PAIR], least[least != _NO_PAIR]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(least, sizes))
            order = np.arange(len(at))
            run = np.concatenate([[True], at[1:] != at[:-1] + 1])  # of places that overlap, every second one, from the left
            at = at[(order - np.maximum.accumulate(np.where(run, order, 0))) % 2 == 0]
            own, of, last = self.merged[pair[at]], segment[at], len(symbols) - 1
            new = np.concatenate([[True], of[1:] != of[:-1]])
            joined = ~new & np.concatenate([[False], at[1:] == at[:-1] + 2])  # begins where the merge before it ends
            has_left, has_right = (at > 0) & (segment[at - 1] == of), (at + 1 < last) & (segment[np.minimum(at + 2, last)] == of)
            left_symbol = np.where(joined, np.concatenate([own[:1], own[:-1]]), symbols[at - 1])
            left = np.where(has_left, self.pairs(left_symbol, own), none)
            right = np.where(has_right, self.pairs(own, symbols[np.minimum(at + 2, last)]), none)
            overtaken = np.minimum(self.ranks[left], self.ranks[right]) <= rank[at]
            earlier = np.cumsum(overtaken) - overtaken
            order = np.arange(len(at))
            keep = earlier == earlier[np.maximum.accumulate(np.where(new, order, 0))]
            at, own, left, right, joined, has_left = (x[keep] for x in (at, own, left, right, joined, has_left))
            symbols[at], pair[at] = own, right
            pair[(at - 1 - joined)[has_left]] = left[has_left]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            symbols, segment, pair = symbols[keep], segment[keep], pair[keep]
        symbols, segment = np.concatenate(done_symbols), np.concatenate(done_segments)
        order = np.argsort(segment, kind="stable")
        return symbols[order], segment[order]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words (spaces for marks), flat, and where each word's ids begin (one more at the end)."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        word_starts = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum([len(w) for w in words], out=word_starts[1:])
        cut = np.zeros(len(points) + 1, dtype=bool)
        cut[word_starts] = True
        if len(points) > 1:
            both = points[:-1] << 21 | points[1:]
            at = np.minimum(np.searchsorted(self.neighbours, both), len(self.neighbours) - 1)
            cut[1:-1] |= self.neighbours[at] != both
            if self.space_run:
                space = points == ord(" ")
                before = np.arange(len(points)) - np.maximum.accumulate(np.where(space & ~cut[:-1], -1, np.arange(len(points))))  # spaces of the run before each
                cut[1:-1] |= (space[1:] & space[:-1] & (before[1:] % self.space_run == 0))
        starts = np.flatnonzero(cut[:-1])
        symbols = self.char_id[points]
        symbols = np.where(symbols == _UNKNOWN, -2 - points, symbols)  # an unknown character keeps its code point
        ids, owner = self.merge_segments(symbols, starts)
        word_of = np.searchsorted(word_starts, starts, side="right") - 1
        owner = word_of[owner]
        unknown = np.flatnonzero(ids < 0)
        if len(unknown):
            counts = np.ones(len(ids), dtype=np.int64)
            spelled = [chr(-2 - int(ids[u])).encode("utf-8", "surrogatepass") for u in unknown]
            counts[unknown] = [len(b) for b in spelled]
            is_byte = np.repeat(ids < 0, counts)
            ids, owner = np.repeat(ids, counts), np.repeat(owner, counts)
            ids[is_byte] = self.byte_ids[np.frombuffer(b"".join(spelled), dtype=np.uint8)]
        return ids.astype(np.int32), np.searchsorted(owner, np.arange(len(words) + 1))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, as the library's decode(ids): the first space goes, bytes that are not UTF-8 become U+FFFD."""
        joined = b"".join([self.bytes[i] for i in ids])
        return joined.removeprefix(b" ").decode("utf-8", "one_byte")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[starts[i] : starts[i] + lengths[i]] for all i, one after the other."""
    ends = np.cumsum(lengths)
    shift = np.repeat(starts - (ends - lengths), lengths)
    return flat[np.arange(len(shift)) + shift]


class _Words:
    """Ids and decoded bytes of distinct words, kept from batch to batch."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(0, dtype=np.int32)
        self.starts = np.zeros(1, dtype=np.int64)

    def numbers(self, words: list[str]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self.number]
        if new:
            if len(self.number) + len(new) > KEPT_WORDS:
                self.clear()
                new = list(dict.fromkeys(words))
            ids, starts = self.vocab.encode_words(new)
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
            self.starts = np.concatenate([self.starts, starts[1:] + len(self.ids)])
            self.ids = np.concatenate([self.ids, ids])
        return np.fromiter(map(self.number.__getitem__, words), dtype=np.int64, count=len(words))


@lru_cache(maxsize=2)
def _store(path: str) -> _Words:
    return _Words(vocabulary(path))


def encode_texts(texts: list[str | None], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, flat, and where each text's begin (one more at the end); null counts as empty."""
    words: list[str] = []
    counts = np.zeros(len(texts) + 1, dtype=np.int64)
    for i, text in enumerate(texts):
        if text:
            words += _WORDS.findall(" " + text.replace(SPACE_MARK, " "))
        counts[i + 1] = len(words)
    store = _store(path)
    number = store.numbers(words)
    lengths = store.starts[number + 1] - store.starts[number]
    ids = ragged(store.ids, store.starts[number], lengths)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return ids, ends[counts]


def decode_ids(ids: np.ndarray, starts: np.ndarray, path: str) -> list[str]:
    """The text of each run of ids, as the library's decode(ids)."""
    vocab = vocabulary(path)
    lengths = vocab.lengths[ids]
    flat = ragged(vocab.flat, vocab.starts[ids], lengths).tobytes()
    ends = np.concatenate([[0], np.cumsum(lengths)])[starts].tolist()
    return [flat[a:b].removeprefix(b" ").decode("utf-8", "one_byte") for a, b in zip(ends[:-1], ends[1:], strict=True)]


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """All rows with `ids` (array of int) and `decoded` (the text of the ids) added, without begin or end ids.

    A null or empty text has no id and decodes to the empty text. Every column
    passes through, but an own `ids` or `decoded`, which are replaced.
    """
    kept = [c for c in docs.columns if c not in ("ids", "decoded")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, _, _ in text_slices(batch.column("text"), PASS_BYTES):
                part = batch.slice(first, end - first)
                ids, starts = encode_texts(part.column("text").to_pylist(), path)
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))
                decoded = pa.array(decode_ids(ids, starts, path), pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), lists, decoded], names=[*kept, "ids", "decoded"])

    schema = T.StructType([docs.schema[c] for c in kept])
    schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.StringType())
    return docs.select(*kept).mapInArrow(run, schema)
