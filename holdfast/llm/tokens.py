"""Token files: ids of all documents in doc_id order, in flat files that can be memory-mapped.

A token folder holds, for each part k,

* ``part-k.bin``: the ids as little-endian unsigned integers, 16 bits wide where the
  vocabulary allows it, else 32,
* ``part-k.idx``: per document two little-endian 64-bit integers, its doc_id (0 for null) and
  the place in the part at which it begins,

and ``manifest.json`` with the width, the end id and each part's counts. Documents without an
id come first, so a count of them in each part tells them from the others. Parts follow each
other in doc_id order; their bases are the prefix sums of the counts, so each part is
written without waiting for another and the driver sees one row per part.

The folder must be on storage that all executors share, named by a URI that pyarrow opens.
A task writes under a name of its own attempt and renames at the end, so a repeated task
leaves whole files only.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Spans that a byte-level tokenizer's own splitting never reaches across: runs of white
# space but for the last one, a run of letters before ASCII punctuation or white space, any
# other run without white space.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_SPANS = re.compile(rf"\s+(?!\S)| ?[{_LETTERS}]++(?![^\s!-/:-@\[-`{{-~])| ?\S+|\s")
# Spans that are one word of the tokenizer's own splitting: letters, digits or punctuation.
_WORD = re.compile(rf" ?(?:[{_LETTERS}]+|[0-9]+|[!-/:-@\[-`{{-~]+)")
# Characters that Python's and the tokenizer's idea of white space disagree about.
_UNSURE = re.compile("[\x1c-\x1f]")


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    letters.update({b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in letters)})
    return [letters[b] for b in range(256)]


def _splits_as_known(tokenizer) -> bool:
    """Whether this is a byte-level BPE whose spans ``_SPANS`` describes."""
    told = json.loads(tokenizer.to_str())
    split, model = told["pre_tokenizer"] or {}, told["model"]
    return (
        told["normalizer"] is None
        and split.get("type") == "ByteLevel"
        and not split.get("add_prefix_space")
        and split.get("use_regex", True)
        and model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
    )


class SpanEncoder(dict):
    """Ids of texts by a tokenizer of the tokenizers library.

    Texts for a byte-level BPE are cut into spans, which are encoded once and remembered, up
    to ``most`` of them. Tokenizers that split otherwise, or normalise, get whole texts.
    """

    def __init__(self, path: str, most: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.most = most
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(_byte_letters())})
        self.known = _splits_as_known(self.tokenizer)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.width == '<u2' else 'I'}", *ids)

    def whole(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, span: str) -> bytes:
        if _WORD.fullmatch(span):
            shown = span.encode().decode("latin-1").translate(self.letters)
            ids = self.packed([t.id for t in self.model.tokenize(shown)])
        else:
            ids = self.whole(span)
        if len(span) <= 64:
            self[span] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if not self.known or _UNSURE.search(text) or any(a in text for a in self.added):
            return self.whole(text)
        if len(self) > self.most:
            self.clear()
        return b"".join(map(self.__getitem__, _SPANS.findall(text)))


@lru_cache(maxsize=1)
def _encoder(path: str) -> SpanEncoder:
    """A worker's encoder, which keeps what it has encoded from task to task."""
    return SpanEncoder(path)


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    uri = re.sub("^file:/+", "/", uri)
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def _writer(folder: str, tokenizer: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId()
        files, root = _opened(folder)
        names = [f"{root}/part-{part:06d}.{kind}" for kind in ("bin", "idx")]
        drafts = [f"{n}.{context.taskAttemptId()}" for n in names]
        docs, tokens, nulls = 0, 0, 0
        with files.open_output_stream(drafts[0]) as out, files.open_output_stream(drafts[1]) as index:
            for batch in batches:
                encoder = _encoder(tokenizer)
                end = np.array([end_id], encoder.width).tobytes()
                nulls += batch.column(0).null_count
                ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                rows = np.empty((len(ids), 2), "<i8")
                rows[:, 0] = ids
                for k, text in enumerate(batch.column(1).to_pylist()):
                    own = encoder.ids(text) if text else b""
                    out.write(own + end)
                    rows[k, 1] = tokens
                    tokens += (len(own) + len(end)) // len(end)
                index.write(rows.tobytes())
                docs += len(ids)
        for draft, name in zip(drafts, names):
            files.move(draft, name)
        yield pa.RecordBatch.from_pydict({"part": [part], "docs": [docs], "tokens": [tokens], "nulls": [nulls]})

    return write


@dataclass(frozen=True)
class TokenFolder:
    """A written token folder: width of an id, end id, and (part, docs, tokens, base, nulls) rows."""

    folder: str
    width: str
    end_id: int
    parts: list = field(default_factory=list)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> TokenFolder:
    """Encode ``text`` of ``docs`` and write the ids, each document's followed by ``end_id``.

    Documents are in ascending doc_id order, null ids first; equal ids in the order of a
    hash of their texts. A null text is an empty one: just the end id. Other columns are
    ignored. An empty table makes a folder without tokens. ``tokenizer`` is any file of the
    tokenizers library; special tokens' strings in a text are taken as it takes them.
    """
    spark = docs.sparkSession
    files, root = _opened(folder)
    files.create_dir(root, recursive=True)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    # The last key deals out equal rows, whose order does not matter.
    keyed = keyed.withColumn("row", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange("doc_id", "h", "row").sortWithinPartitions("doc_id", "h", "row")
    counts = ordered.select("doc_id", "text").mapInArrow(
        _writer(folder, tokenizer, end_id), "part long, docs long, tokens long, nulls long"
    )
    from tokenizers import Tokenizer

    size = Tokenizer.from_file(tokenizer).get_vocab_size()
    parts, base = [], 0
    for row in sorted(counts.collect()):
        parts.append((row.part, row.docs, row.tokens, base, row.nulls))
        base += row.tokens
    made = TokenFolder(folder, "<u2" if size <= 1 << 16 else "<u4", end_id, parts)
    with files.open_output_stream(f"{root}/manifest.json") as out:
        out.write(json.dumps({"width": made.width, "end_id": end_id, "parts": parts}).encode())
    return made


def open_tokens(folder: str) -> TokenFolder:
    files, root = _opened(folder)
    with files.open_input_stream(f"{root}/manifest.json") as source:
        found = json.loads(source.read())
    return TokenFolder(folder, found["width"], found["end_id"], [tuple(p) for p in found["parts"]])


def _mapped(files: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    if not files.get_file_info(path).size:
        return np.zeros(0, kind)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with files.open_input_stream(path) as source:
        return np.frombuffer(source.read(), kind)


def documents_of(tokens: TokenFolder, part: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start in the whole sequence, ids with the end id) of a part's documents."""
    files, root = _opened(tokens.folder)
    base, nulls = next(p[3:] for p in tokens.parts if p[0] == part)
    ids = _mapped(files, f"{root}/part-{part:06d}.bin", tokens.width)
    index = _mapped(files, f"{root}/part-{part:06d}.idx", "<i8").reshape(-1, 2)
    stops = np.append(index[1:, 1], len(ids))
    for row, ((doc, start), stop) in enumerate(zip(index.tolist(), stops.tolist())):
        yield None if row < nulls else doc, base + start, ids[start:stop]


def _reader(tokens: TokenFolder, digest: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column(0).to_pylist():
                held: dict[str, list] = {"doc_id": [], "start": [], "n_tokens": [], "last": []}
                for doc, start, ids in documents_of(tokens, tokens.parts[at][0]):
                    own = zlib.crc32(ids.astype("<u4").tobytes()) if digest else ids.astype(np.int64)
                    for name, value in zip(held, (doc, start, len(ids), own)):
                        held[name].append(value)
                    if len(held["last"]) >= 512:
                        yield _rows(held, digest)
                        held = {name: [] for name in held}
                yield _rows(held, digest)

    return read


def _rows(held: dict[str, list], digest: bool) -> pa.RecordBatch:
    last = pa.int64() if digest else pa.list_(pa.int64())
    kinds = (pa.int64(), pa.int64(), pa.int64(), last)
    return pa.RecordBatch.from_arrays(
        [pa.array(v, k) for v, k in zip(held.values(), kinds)],
        ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"],
    )


def read_tokens(spark: SparkSession, tokens: TokenFolder, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all documents, read back from the files; with
    ``digest`` the crc32 of the ids as 32-bit integers in the place of ``ids``."""
    last = "ids_crc32 long" if digest else "ids array<long>"
    parts = spark.range(0, len(tokens.parts), 1, max(1, len(tokens.parts)))
    return parts.mapInArrow(_reader(tokens, digest), f"doc_id long, start long, n_tokens long, {last}")
