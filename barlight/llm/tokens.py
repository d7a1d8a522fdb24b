"""Exact encoding by backtracking over longest matches, for merge-type models with byte fallback, and decoding.

A model of this type merges the two neighbours whose union scores highest, leftmost first, until no
union of neighbours is a piece. That is the only sequence in which each piece and each pair of
neighbours comes out again when their text is merged by itself. So a text is taken from left to right
by the longest match that goes with the piece before it; where none does, the piece before it is
taken back and shortened, and the position is marked so that it is not tried again.
"""

from __future__ import annotations

import functools
import itertools
import re
import struct
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as protobuf

from barlight.llm.words import buffer, chunks

# The sign that stands for a space, and the kinds of pieces and models of the file format.
SPACE = "▁"
NORMAL, BYTE, BPE = 1, 6, 2

#: Units and pairs that a worker remembers; longer units are not worth it.
REMEMBERED, LONGEST_UNIT = 1 << 18, 48

#: Bytes of texts that are handed on at a time, and characters of one text that are cut into units at a time.
CHUNK_BYTES, PART = 1 << 20, 1 << 20


class Remembered(dict):
    """Results by key, but for long keys. When there are too many, those not asked for since the last time are forgotten."""

    def __init__(self, find):
        super().__init__()
        self.find = find
        self.before: dict = {}

    def __missing__(self, key):
        found = self.before.get(key)
        if found is None:
            found = self.find(key)
            if len(key) > LONGEST_UNIT:
                return found
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        self[key] = found
        return found


class Model:
    """Pieces of a model file, and encoding and decoding by them."""

    def __init__(self, path: str):
        proto = protobuf.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        rules, trained = proto.normalizer_spec, proto.trainer_spec
        kinds = {p.type for p in proto.pieces}
        if trained.model_type != BPE or not trained.byte_fallback or rules.precompiled_charsmap or rules.remove_extra_whitespaces or not (rules.add_dummy_prefix and rules.escape_whitespaces) or trained.treat_whitespace_as_suffix or kinds & {4, 5}:
            raise ValueError("not a merge-type model with byte fallback that takes texts as they are")
        self.id: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.bytes: list[bytes] = []
        self.of_byte = [0] * 256
        for i, p in enumerate(proto.pieces):
            self.bytes.append(b"")  # begin, end and unknown give no text
            if p.type == NORMAL:
                self.id[p.piece], self.score[p.piece] = i, p.score
                self.bytes[i] = p.piece.replace(SPACE, " ").encode()
            elif p.type == BYTE:
                value = int(p.piece[1:-1], 16)
                self.of_byte[value], self.bytes[i] = i, bytes([value])
        names = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.begin, self.end = names.bos_id(), names.eos_id()
        self.matches = ahocorasick.Automaton()
        for piece in self.id:
            self.matches.add_word(piece, (len(piece) - 1, piece))
        self.matches.make_automaton()
        # No piece reaches over a line feed, or over the begin of spaces: so units between them are independent.
        alone = not any("\n" in p for p in self.id) and not any(SPACE in p.lstrip(SPACE) for p in self.id)
        self.unit = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n" if alone else "(?s:.+)")
        self.border = re.compile(f"[^{SPACE}]{SPACE}") if alone else None
        self.units = Remembered(lambda unit: self.packed(self.encoded(unit)))
        self.scores = Counter(self.score.values())
        self.made = Remembered(self.last_merge)
        self.fits = Remembered(self.goes_together)
        self.shorter = Remembered(self.next_shorter)

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def merged(self, text: str) -> tuple[list[str], tuple[str, str]]:
        """The pieces of a short text, by merging, and the two that were merged last."""
        parts, score, last = list(text), self.score, ("", "")
        unions = [score.get(a + b) for a, b in itertools.pairwise(parts)]
        while True:
            best = max((s for s in unions if s is not None), default=None)
            if best is None:
                return parts, last
            k = unions.index(best)
            last = (parts[k], parts[k + 1])
            parts[k : k + 2] = [last[0] + last[1]]
            del unions[k]
            if k:
                unions[k - 1] = score.get(parts[k - 1] + parts[k])
            if k < len(unions):
                unions[k] = score.get(parts[k] + parts[k + 1])

    def last_merge(self, piece: str) -> tuple[str, str, float] | None:
        """What a piece is merged of and its score; ("", "", 0) of a single character, None where merging doesn't give it.

        A score that isn't below those of the parts is nan: such pieces aren't made in the order of scores.
        """
        if len(piece) == 1:
            return "", "", 0.0
        parts, (left, right) = self.merged(piece)
        if parts != [piece]:
            return None
        score = self.score[piece]
        late = any(len(p) > 1 and not self.score[p] > score for p in (left, right))
        return left, right, float("nan") if late or self.scores[score] > 1 else score

    def goes_together(self, pair: tuple[str, str]) -> bool:
        """Whether merging the text of both gives them again; "" stands for the begin.

        Merges at the border are undone, the latest first. Where a union over the border would have come
        before the merge undone last, the pieces don't stand beside each other.
        """
        x, y = pair
        made = self.made
        if made[y] is None or x and made[x] is None:
            return False
        if not x:
            return True
        limit, equal = float("-inf"), False
        while True:
            union = self.score.get(x + y)
            if union is not None and (union > limit or equal and union == limit):
                return False
            (_, x_right, x_score), (y_left, _, y_score) = made[x], made[y]
            if x_score != x_score or y_score != y_score:
                return self.merged(pair[0] + pair[1])[0] == list(pair)
            if not x_right and not y_left:
                return True
            if x_right and (not y_left or x_score < y_score):
                x, limit, equal = x_right, x_score, False
            else:
                y, limit, equal = y_left, y_score, True

    def next_shorter(self, piece: str) -> str:
        """The longest piece that begins this one, or ""."""
        return next((piece[:k] for k in range(len(piece) - 1, 0, -1) if piece[:k] in self.id), "")

    def encoded(self, unit: str) -> list[int]:
        """Ids of a unit. Characters that are no piece stand alone and give their bytes."""
        if unit in self.id and self.made[unit]:
            return [self.id[unit]]
        n = len(unit)
        longest: list[str] = [""] * n
        for last, (k, piece) in self.matches.iter(unit):
            longest[last - k] = piece  # those that end later are longer
        if "" not in longest:
            return self.backtracked(longest, 0, n)
        ids: list[int] = []
        at = 0
        while at < n:
            if not longest[at]:
                ids += [self.of_byte[b] for b in unit[at].encode()]
                at += 1
                continue
            stop = at
            while stop < n and longest[stop]:
                stop += 1
            ids += self.backtracked(longest, at, stop)
            at = stop
        return ids

    def backtracked(self, longest: list[str], begin: int, end: int) -> list[int]:
        """Ids of the characters from begin to end, all of which are pieces."""
        failed = bytearray((end - begin >> 3) + 1)
        fits, taken, before = self.fits, [], ""
        at, piece = begin, longest[begin]
        while True:
            to = at + len(piece)
            while piece and (to > end or failed[to - begin >> 3] & 1 << (to - begin & 7) or not fits[before, piece]):
                piece = self.shorter[piece]
                to = at + len(piece)
            if piece:
                taken.append(piece)
                if to == end:
                    return [self.id[p] for p in taken]
                at, before, piece = to, piece, longest[to]
            else:
                if not taken:
                    raise ValueError("the model's pieces don't come out of their own merging")
                failed[at - begin >> 3] |= 1 << (at - begin & 7)
                piece = taken.pop()
                at -= len(piece)
                before = taken[-1] if taken else ""

    def encode(self, text: str) -> bytes:
        """Ids of a text with begin and end, packed."""
        parts = [self.packed([self.begin])]
        if text:
            text = SPACE + text.replace(" ", SPACE)
            at = 0
            while at < len(text):
                cut = self.border.search(text, at + PART) if self.border and at + PART < len(text) else None
                to = cut.end() - 1 if cut else len(text)
                parts += map(self.units.__getitem__, self.unit.findall(text, at, to))
                at = to
        parts.append(self.packed([self.end]))
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        """The text of packed ids, without the space before it. Bytes that are no UTF-8 become U+FFFD."""
        of = self.bytes
        view = struct.unpack(f"<{len(ids) // 4}I", ids)
        text = b"".join([of[i] for i in view])
        first = next((i for i in view if of[i]), None)
        return (text[1:] if first is not None and of[first][:1] == b" " and first not in self.of_byte else text).decode("utf-8", "replace")


@functools.cache
def model(path: str) -> Model:
    """The model of a file, read once a worker."""
    return Model(path)


def encode(docs: DataFrame, path: str, column: str = "text", out: str = "ids") -> DataFrame:
    """docs with the ids of a text column, as little-endian unsigned 32-bit numbers in one binary value.

    path: a model file that every executor has. Null and empty texts give begin and end alone; bytes
    that are no UTF-8 are taken as U+FFFD. A column that is already called `out` is replaced; other
    columns, null keys and repeated rows stay as they are. Nothing is shuffled, and memory follows the
    longest text. Results of units between spaces are remembered by each worker, up to a number.
    """
    own = [c for c in docs.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in chunks(batches, column, CHUNK_BYTES):
            data, at = buffer(batch.column(column))
            data = data.tobytes()
            ids = [m.encode(data[a:b].decode("utf-8", "replace")) for a, b in itertools.pairwise(at.tolist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(ids, pa.binary())], names=[*own, out])

    schema = T.StructType([docs.schema[c] for c in own] + [T.StructField(out, T.BinaryType())])
    return docs.select(*own).mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, column: str = "ids", out: str = "decoded") -> DataFrame:
    """rows with the text of packed ids as encode() gives them. Null ids give a null text. `out` is replaced if it is there."""
    own = [c for c in rows.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            step = max(1, CHUNK_BYTES * 8 * max(batch.num_rows, 1) // max(batch.column(column).nbytes, 1))
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                texts = [None if x is None else m.decode(x) for x in part.column(column).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own), pa.array(texts, pa.string())], names=[*own, out])

    schema = T.StructType([rows.schema[c] for c in own] + [T.StructField(out, T.StringType())])
    return rows.select(*own).mapInArrow(run, schema)
