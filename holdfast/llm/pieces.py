"""SentencePiece encoding and decoding by a streaming Viterbi search.

Every position of a text keeps one backpointer: the last piece of the encoding of the text
up to there. A position looks back over one window, the longest piece. Ids are committed
as soon as the backpointer paths of all positions in the window meet at one boundary, so
memory is bounded by the window and the uncommitted part, not by the text.

* In a unigram model the backpointer is the piece with the best total score.
* In a BPE model the encoding of a prefix is the one whose neighbouring pieces are all
  compatible: merging their joint text alone gives the two back. The path kept is the one
  with compatible pieces only, which is what the merges produce.

No piece of the usual vocabularies holds a space sign after another character, so all paths
meet before each run of space signs. Such units are encoded once and remembered.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm import words

SPACE = "▁"
_UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
UNKNOWN = -1


class PieceModel:
    """Pieces, scores and settings of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.piece_size()
        self.pieces = [model.id_to_piece(k) for k in range(size)]
        self.scores = [model.get_score(k) for k in range(size)]
        self.bytes = {self.pieces[k]: k for k in range(size) if model.is_byte(k)}
        self.silent = {k for k in range(size) if model.is_control(k)}
        self.unknown = model.unk_id()
        kept = [k for k in range(size) if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k) or model.is_unused(k))]
        self._read_settings(model.serialized_model_proto())
        self._finish({self.pieces[k]: k for k in kept})

    def _read_settings(self, proto: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2

        settings = sentencepiece_model_pb2.ModelProto()
        settings.ParseFromString(proto)
        kinds = settings.trainer_spec.ModelType
        if settings.trainer_spec.model_type not in (kinds.Value("BPE"), kinds.Value("UNIGRAM")):
            raise ValueError("only BPE and unigram models are supported")
        if settings.normalizer_spec.precompiled_charsmap or settings.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("models that rewrite characters are not supported")
        self.merges = settings.trainer_spec.model_type == kinds.Value("BPE")
        self.prefix = settings.normalizer_spec.add_dummy_prefix

    def _finish(self, ids: dict[str, int]) -> None:
        self.ids = ids
        self.longest = max(map(len, ids))
        # Place of each piece among the merges; single characters are there from the start.
        falling = sorted({self.scores[k] for k in ids.values()}, reverse=True)
        place = {score: n for n, score in enumerate(falling)}
        self.rank = [place.get(score, 0) for score in self.scores] + [len(falling) - 1]
        for piece, k in ids.items():
            if len(piece) == 1:
                self.rank[k] = -1
        # Every ending of a piece, with the piece it is, or -2: a search backwards from a
        # position stops at the first text that ends no piece.
        self.ends = {p[k:]: -2 for p in ids for k in range(1, len(p))}
        self.ends.update(ids)
        self.unknown_score = min((self.scores[k] for k in ids.values()), default=0.0) - 10.0
        self.by_unit = not any(SPACE in p.lstrip(SPACE) for p in ids)


class StreamingEncoder(dict):
    """Ids of texts; as a dict, the remembered units: the first ``most`` of them, among which
    are all frequent ones."""

    def __init__(self, model: PieceModel, most: int = 250_000):
        self.model = model
        self.most = most
        self.pairs: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.byte_ids = [model.bytes.get(f"<0x{b:02X}>") for b in range(256)]

    def merged(self, text: str, parts_left: int = 1) -> list[str]:
        """Parts of a short text by plain merging: best score first, then leftmost."""
        ids, scores = self.model.ids, self.model.scores
        parts = list(text)
        while len(parts) > parts_left:
            best, at = None, -1
            for k in range(len(parts) - 1):
                own = ids.get(parts[k] + parts[k + 1])
                if own is not None and (best is None or scores[own] > best):
                    best, at = scores[own], k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _halves(self, piece: int) -> tuple[int, int] | None:
        """The two pieces whose merge is the piece; None if merging its text gives others."""
        known = self.halves.get(piece, False)
        if known is False:
            text = self.model.pieces[piece]
            parts = self.merged(text, 2)
            known = None
            if len(parts) == 2 and self.merged(text) == [text] and all(p in self.model.ids for p in parts):
                known = self.model.ids[parts[0]], self.model.ids[parts[1]]
            self.halves[piece] = known
        return known

    def _compatible(self, left: int, right: int) -> bool:
        """Whether two neighbours stay as they are; an unknown character never merges.

        The merges that made the two are undone from the last one on. They stay apart unless
        some parts that touch would have merged before the merge that is being undone.
        """
        key = left * len(self.model.pieces) + right
        if len(self.pairs) > 500_000:
            self.pairs.clear()
        known = len(self.model.pieces[right]) == 1 or self._halves(right) is not None
        self.pairs[key] = known = known and (left == UNKNOWN or self._stay_apart(left, right))
        return known

    def _stay_apart(self, a: int, b: int) -> bool:
        ids, pieces, rank = self.model.ids, self.model.pieces, self.model.rank
        if rank[a] == rank[-1] or rank[b] == rank[-1]:
            # Pieces that share the lowest score merge by place only.
            return self.merged(pieces[a] + pieces[b]) == [pieces[a], pieces[b]]
        limit = len(pieces)
        while True:
            joined = ids.get(pieces[a] + pieces[b])
            if joined is not None and rank[joined] < limit:
                return False
            undo_left = rank[a] > rank[b]
            for _ in range(2):
                # At equal rank the left merge goes first.
                if undo_left and len(pieces[a]) > 1:
                    limit, a = rank[a], self._halves(a)[1]
                    break
                if not undo_left and len(pieces[b]) > 1:
                    limit, b = rank[b] + 1, self._halves(b)[0]
                    break
                undo_left = not undo_left
            else:
                return True

    def _extend_merges(self, text: str, last: list[int], back: list[int]) -> None:
        """Backpointers of the positions of ``text`` that have none yet."""
        ends, pairs, size = self.model.ends, self.pairs, len(self.model.pieces)
        for i in range(len(last), len(text) + 1):
            found, start = UNKNOWN, i - 1
            for j in range(i - 1, -1, -1):
                piece = ends.get(text[j:i])
                if piece is None:
                    break
                if piece >= 0:
                    known = pairs.get(last[j] * size + piece)
                    if known or (known is None and self._compatible(last[j], piece)):
                        found, start = piece, j
                        break
            last.append(found)
            back.append(start)

    def _extend_scores(self, text: str, last: list[int], back: list[int], best: list[float]) -> None:
        ends, scores = self.model.ends, self.model.scores
        for i in range(len(last), len(text) + 1):
            found, start, most = UNKNOWN, i - 1, best[i - 1] + self.model.unknown_score
            for j in range(i - 1, -1, -1):
                piece = ends.get(text[j:i])
                if piece is None:
                    break
                if piece >= 0 and (best[j] + scores[piece] > most or found == UNKNOWN and j == i - 1):
                    found, start, most = piece, j, best[j] + scores[piece]
            last.append(found)
            back.append(start)
            best.append(most)

    def stream(self, text: str, every: int = 64) -> Iterator[list[tuple[int, int, int]]]:
        """Committed runs of (piece, start, end), each ending where all paths meet."""
        last, back, best = [UNKNOWN], [0], [0.0]
        # Positions count from the last committed boundary.
        base = 0
        while True:
            window = text[base : base + len(last) - 1 + every]
            if self.model.merges:
                self._extend_merges(window, last, back)
            else:
                self._extend_scores(window, last, back, best)
            if base + len(window) == len(text):
                break
            meet = self._meeting(back, max(0, len(back) - self.model.longest))
            if meet:
                yield self._path(last, back, meet, base)
                last[: meet + 1] = [last[meet]]
                back = [0] + [b - meet for b in back[meet + 1 :]]
                best = [b - best[meet] for b in best[meet:]]
                base += meet
        yield self._path(last, back, len(text) - base, base)

    @staticmethod
    def _meeting(back: list[int], low: int) -> int:
        """The last boundary on the paths of all positions from ``low`` on."""
        ends = set(range(low, len(back)))
        while len(ends) > 1:
            top = max(ends)
            ends.remove(top)
            ends.add(back[top])
        return ends.pop()

    @staticmethod
    def _path(last: list[int], back: list[int], end: int, base: int) -> list[tuple[int, int, int]]:
        found = []
        while end:
            found.append((last[end], base + back[end], base + end))
            end = back[end]
        return found[::-1]

    def _ids(self, text: str) -> list[int]:
        ids: list[int] = []
        for run in self.stream(text):
            for piece, a, b in run:
                if piece != UNKNOWN:
                    ids.append(piece)
                elif None not in (spelled := [self.byte_ids[x] for x in text[a:b].encode()]):
                    ids.extend(spelled)
                else:
                    ids.append(self.model.unknown)
        return ids

    def __missing__(self, unit: str) -> bytes:
        if len(unit) > 64:
            return array("i", self._ids(unit)).tobytes()
        ids = self._short(unit) if self.model.merges else self._ids(unit)
        own = array("i", ids).tobytes()
        if len(self) < self.most:
            self[unit] = own
        return own

    def _short(self, unit: str) -> list[int]:
        """As :meth:`_ids`, for a unit that ends before anything would be committed."""
        last, back = [UNKNOWN], [0]
        self._extend_merges(unit, last, back)
        end, ids = len(unit), []
        while end:
            if last[end] == UNKNOWN:
                return self._ids(unit)
            ids.append(last[end])
            end = back[end]
        ids.reverse()
        return ids

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, "<i4")
        text = (SPACE if self.model.prefix else "") + text.replace(" ", SPACE)
        if not self.model.by_unit:
            return np.array(self._ids(text), "<i4")
        return np.frombuffer(b"".join(map(self.__getitem__, _UNIT.findall(text))), "<i4")


class Decoder:
    """Texts of ids: pieces joined, byte pieces as UTF-8, space signs as spaces."""

    def __init__(self, model: PieceModel):
        self.prefix = model.prefix
        spelled = {k: bytes([int(p[3:5], 16)]) for p, k in model.bytes.items()}
        parts = [
            spelled.get(k, b"" if k in model.silent else p.replace(SPACE, " ").encode())
            for k, p in enumerate(model.pieces)
        ]
        parts[model.unknown] = " ⁇ ".encode()
        self.sizes = np.array([len(p) for p in parts])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(parts), np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        """All pieces are copied in one gather over the joined bytes of the vocabulary."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(total)
        text = self.letters[at].tobytes().decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def _encoder(path: str) -> StreamingEncoder:
    """Kept by a worker from task to task, with the units it remembers."""
    return StreamingEncoder(PieceModel(path))


def _replaced(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    at = batch.schema.get_field_index(name)
    columns = [column if k == at else c for k, c in enumerate(batch.columns)]
    return pa.RecordBatch.from_arrays(columns, batch.schema.names)


def _encoding(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for part in words.row_slices(batches):
            found = [encoder.encode(t) if t is not None else None for t in part.column("text").to_pylist()]
            yield _replaced(part, "ids", pa.array(found, pa.list_(pa.int32())))

    return run


def _decoding(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(_encoder(path).model)
        for part in words.row_slices(batches):
            lists = part.column("ids")
            flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
            found = [
                decoder.decode(flat[a:b]) if known else None
                for known, a, b in zip(lists.is_valid().to_pylist(), ends, ends[1:])
            ]
            yield _replaced(part, "decoded", pa.array(found, pa.string()))

    return run


def encode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids`` (array of int) of ``text`` by the model file at ``path``, which
    every executor must have. A null text has null ids, an empty one none. A column named
    ``ids`` is replaced; every row is encoded, without a shuffle."""
    docs = docs.withColumn("ids", F.lit(None).cast("array<int>"))
    return docs.mapInArrow(_encoding(path), docs.schema)


def decode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``decoded``, the text of ``ids``; a column of that name is replaced.

    Decoding gives the encoded text back, but for space signs in the text itself, which
    become spaces. Null ids give null, an empty array the empty text."""
    docs = docs.withColumn("decoded", F.lit(None).cast("string"))
    return docs.mapInArrow(_decoding(path), docs.schema)
