"""Repeated passages: content-defined chunks found by digest, extended to their true ends.

A text is cut where its rolling gear hash is the smallest of its surroundings, so the cuts
inside a passage are the same in every text that holds it, whatever was inserted before it.
Chunks are deduplicated by digest: one that a document with a smaller id has, too, is a
repeat, aligned with its place in the first such document. Neighbouring repeats on one
alignment are a run; beyond its ends both texts are compared byte by byte, as far as they agree.
What is then ``run_words`` words or more is removed, so short shared phrases stay.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm import words
from holdfast.sources.staging import stage


@dataclass(frozen=True)
class ChunkSpec:
    """A cut falls where the rolling hash, which depends on the last 16 bytes, is the smallest
    within ``reach`` bytes on both sides, and wherever a chunk would pass ``most`` bytes; so
    chunks have about 2 ``reach`` bytes. A shared passage has a common chunk where two cuts
    fall between its first ``reach`` + 16 and its last ``reach`` bytes: of passages of 51 words
    all but about one in a hundred where words are as short as three letters, and practically
    all where they are longer."""

    reach: int = 16
    most: int = 128
    run_words: int = 51

    @property
    def beyond(self) -> int:
        """How far two texts can agree beyond the chunk after the last repeat: the bytes on
        which its cut depends."""
        return self.reach + MEMORY


MEMORY = 16
# The last entry stands for the space between two texts.
GEAR = np.append(words.constants(256, 31), np.uint64(0)).astype(np.uint16)
_GAP = 256


def rolled(codes: np.ndarray) -> np.ndarray:
    """Gear hash at each byte: h = 2 h + GEAR[byte], so bit k depends on the last k + 1 bytes."""
    total = GEAR[codes]
    step = 1
    while step < MEMORY:
        total[step:] = total[step:] + (total[:-step] << np.uint16(step))
        step *= 2
    return total


def _smallest_ahead(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of ``size`` values from each position on; beyond the end nothing counts."""
    least = np.append(values, np.full(size, np.iinfo(values.dtype).max, values.dtype))
    step = 1
    while 2 * step <= size:
        least = np.minimum(least[: len(least) - step], least[step:])
        step *= 2
    n = len(values)
    return np.minimum(least[:n], least[size - step : size - step + n])


def chunk_bounds(data: np.ndarray, offsets: np.ndarray, spec: ChunkSpec) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the chunks of all texts of a piece; none crosses two texts."""
    sizes = np.diff(offsets)
    gap = max(MEMORY, spec.reach)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    codes = np.full(len(data) + gap * (len(sizes) + 1), _GAP, np.int16)
    place = np.arange(len(data)) + gap * (owner + 1)
    codes[place] = data
    own = rolled(codes).astype(np.uint32)
    none = np.uint32(np.iinfo(np.uint32).max)
    own[codes == _GAP] = none
    # Of equal values the leftmost is the smallest, so that a plateau makes one cut.
    after = np.append(_smallest_ahead(own, spec.reach)[1:], none)
    before = np.append(_smallest_ahead(own[::-1], spec.reach)[1:], none)[::-1]
    cut = ((own < before) & (own <= after))[place]
    ends = np.union1d(np.flatnonzero(cut) + 1, offsets[1:][sizes > 0]).astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    long = np.flatnonzero(ends - starts > spec.most)
    if len(long):
        more = [np.arange(a + spec.most, b, spec.most) for a, b in zip(starts[long], ends[long])]
        ends = np.sort(np.concatenate([ends, *more]))
        starts = np.concatenate([[0], ends[:-1]])
    return starts, ends


def _digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return words.span_digests(data, starts, ends)[0].view(np.int64)


def _chunker(spec: ChunkSpec):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in words.text_pieces(batch.column(1)):
                ids = batch.column(0)[row : row + len(offsets) - 1].cast(pa.int64())
                starts, ends = chunk_bounds(data, offsets, spec)
                sizes = np.concatenate([[0], ends - starts, [0]])
                # Only the first and last chunk of a text are as short: too common to tell anything.
                telling = np.flatnonzero(ends - starts >= spec.reach)
                starts, ends = starts[telling], ends[telling]
                owner = np.searchsorted(offsets, starts, "right") - 1
                local = starts - offsets[:-1][owner]
                columns = [
                    ids.take(pa.array(owner)),
                    pa.array(local.astype(np.int32)),
                    pa.array((ends - starts).astype(np.int32)),
                    pa.array(sizes[telling].astype(np.int16)),
                    pa.array(sizes[telling + 2].astype(np.int16)),
                    pa.array(_digests(data, starts, ends)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "size", "left", "right", "digest"])

    return cut


def chunk_table(docs: DataFrame, spec: ChunkSpec = ChunkSpec()) -> DataFrame:
    """(doc_id, start, size, left, right, digest): the chunks of every text, with the sizes of
    the chunks beside them and 64-bit digests."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _chunker(spec), "doc_id long, start int, size int, left short, right short, digest long"
    )


# A broadcast part of a join has at most this many rows, whatever the tables' sizes.
HOT_ROWS = 4096


def spread_join(rows: DataFrame, table: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` with their match in ``table``, one row per key, whose column ``n`` says how
    many of ``rows`` a key has; together no more than ``total``. Keys with over
    total / HOT_ROWS rows, of which there are fewer than HOT_ROWS, do not shuffle."""
    limit = max(1024, total // HOT_ROWS)
    hot = stage(table.where(F.col("n") > limit), "hot")
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    rest = rest.join(table.where(F.col("n") <= limit).drop("n"), keys)
    return rest.unionByName(rows.join(F.broadcast(hot.drop("n")), keys).select(*rest.columns))


def repeated_chunks(docs: DataFrame, spec: ChunkSpec = ChunkSpec()) -> DataFrame:
    """The rows of :func:`chunk_table` with (first_doc_id, first_start): chunks that a document with a
    smaller id has, with their first place in the first such document."""
    # Cut twice rather than written: the chunks are half as large as the texts.
    chunks = chunk_table(docs.where("doc_id IS NOT NULL"), spec)
    place = F.struct(F.col("doc_id").alias("first_doc_id"), F.col("start").alias("first_start"))
    found = chunks.groupBy("digest").agg(
        F.min(place).alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n")
    )
    shared = stage(found.where("first.first_doc_id < last").select("digest", "first.*", "n"), "shared")
    total = shared.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return spread_join(chunks, shared, ["digest"], total).where("doc_id > first_doc_id")


def runs_of(marks: list[dict], spec: ChunkSpec) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(start, end, first_doc_id, first_start, left, right): neighbouring marks on one
    alignment, and how many bytes before and after the run are to be compared.

    What two texts share beyond a run has chunks that are repeats, too, if of yet earlier
    documents. So it ends in or soon after the first chunk beyond the neighbouring repeats of any
    document, or where the next run on the same alignment begins."""
    bounds: list[list[int]] = []
    starts: list[int] = []
    last = None
    for start, end, left, right in sorted({(m["start"], m["start"] + m["size"], m["left"], m["right"]) for m in marks}):
        if start == last:
            bounds[-1][1] = end + right + spec.beyond
        else:
            starts.append(start)
            bounds.append([start - left - spec.beyond, end + right + spec.beyond])
        last = end
    runs: list[list[int]] = []
    for source, shift, start, size in sorted(
        (m["first_doc_id"], m["start"] - m["first_start"], m["start"], m["size"]) for m in marks
    ):
        if runs and runs[-1][2:] == [source, shift] and runs[-1][1] == start:
            runs[-1][1] = start + size
        else:
            runs.append([start, start + size, source, shift])
    for k, (start, end, source, shift) in enumerate(runs):
        low, high = bounds[bisect_right(starts, start) - 1]
        if k and runs[k - 1][2:] == [source, shift]:
            low = max(low, runs[k - 1][1])
        if k + 1 < len(runs) and runs[k + 1][2:] == [source, shift]:
            high = min(high, runs[k + 1][0])
        yield start, end, source, start - shift, start - low, high - end


RUNS = "doc_id long, start int, stop int, first_doc_id long, first_start int, first_stop int, left int, right int"


def _run_finder(spec: ChunkSpec):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RUNS.split(", ")]
        kinds = [pa.int64() if f.endswith("long") else pa.int32() for f in RUNS.split(", ")]
        for batch in words.row_slices(batches):
            out: list[tuple] = []
            for doc, marks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for start, end, source, first, left, right in runs_of(marks, spec):
                    out.append((doc, start, end, source, first, first + end - start, left, right))
            columns = list(zip(*out)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return find


# The run, then the bytes before and after it and the hash of what it holds.
SLICES = RUNS + ", before binary, after binary, check long"


def _slicer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around runs of a text, those before them the nearest first."""
    names = [f.split()[0] for f in SLICES.split(", ")]
    of = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    kinds = [of[f.split()[1]] for f in SLICES.split(", ")]
    for batch in words.row_slices(batches):
        out = []
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        for doc, text, runs in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist()):
            for r in runs:
                a, b = r["start"], r["stop"]
                before, after = text[max(a - r["left"], 0) : a][::-1], text[b : b + r["right"]]
                out.append((doc, *r.values(), before, after, crc32(text[a:b])))
        columns = list(zip(*out)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


_BLANKS = b" \t\n\v\f\r"


def _agreement(own: bytes, other: bytes, most: int) -> tuple[int, bool]:
    """How many of up to ``most`` bytes both begin with, and whether the other's word goes on."""
    n = min(len(own), len(other), most)
    m = n
    if own[:n] != other[:n]:
        m = int(np.argmax(np.frombuffer(own, np.uint8, n) != np.frombuffer(other, np.uint8, n)))
    return m, m < len(other) and other[m] not in _BLANKS


FOUND = (
    "doc_id long, first_doc_id long, shift int, start int, stop int, before int, after int, cut_before boolean, "
    "cut_after boolean, check long, check_before long, check_after long"
)


def _comparer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs whose bytes agree, with how many more do before and after them."""
    names = [f.split()[0] for f in FOUND.split(", ")]
    of = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    kinds = [of[f.split()[1]] for f in FOUND.split(", ")]
    for batch in words.row_slices(batches):
        out = []
        columns = (batch.column(k).to_pylist() for k in range(batch.num_columns))
        for doc, start, stop, source, first, left, right, own_b, own_a, check, oth_b, oth_a, other in zip(*columns):
            if check == other:
                before, cut_b = _agreement(own_b, oth_b, left)
                after, cut_a = _agreement(own_a, oth_a, right)
                checks = check, crc32(own_b[:before]), crc32(own_a[:after])
                out.append((doc, source, start - first, start, stop, before, after, cut_b, cut_a, *checks))
        found = list(zip(*out)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, kinds)], names)


def compared_runs(docs: DataFrame, runs: DataFrame, spec: ChunkSpec) -> DataFrame:
    """The runs of ``runs`` compared with the first document's text; those alignments are left
    out that have too few bytes for ``run_words`` words."""
    place = ["first_doc_id", "first_start", "first_stop"]
    columns = ["start", "stop", "first_doc_id", "first_start", "first_stop", "left", "right"]
    none = [F.lit(None).cast(k).alias(c) for c, k in zip(place, ("long", "int", "int"))]
    wanted = runs.groupBy(*place).agg(
        F.max("left").alias("left"), F.max("right").alias("right"), F.count(F.lit(1)).alias("n")
    )
    first = wanted.select(
        F.col("first_doc_id").alias("doc_id"), F.col("first_start").alias("start"), F.col("first_stop").alias("stop"),
        *none, "left", "right",
    )
    # A text's own runs, and those for which it is the first: a few for each of its chunks.
    asked = runs.select("doc_id", *columns).union(first).groupBy("doc_id")
    asked = stage(asked.agg(F.collect_list(F.struct(*columns)).alias("runs")), "asked")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    texts = texts.join(asked, "doc_id").select("doc_id", "text", "runs")
    slices = stage(texts.mapInArrow(_slicer, SLICES), "slices")
    own = slices.where("first_doc_id IS NOT NULL")
    others = slices.where("first_doc_id IS NULL").select(
        *[F.col(c).alias(f"first_{c}") for c in ("doc_id", "start", "stop")],
        F.col("before").alias("other_before"), F.col("after").alias("other_after"), F.col("check").alias("other_check"),
    )
    others = others.repartition(*place).distinct().join(wanted.select(*place, "n"), place)
    both = spread_join(own, others, place, runs.count()).select(
        "doc_id", "start", "stop", "first_doc_id", "first_start", "left", "right",
        "before", "after", "check", "other_before", "other_after", "other_check",
    )
    found = both.mapInArrow(_comparer, FOUND)
    # A row that is repeated gives the same runs again.
    by_alignment = found.distinct().groupBy("doc_id", "first_doc_id", "shift")
    run = F.struct("start", "stop", "before", "after", "cut_before", "cut_after", "check", "check_before", "check_after")
    held = F.sum(F.col("stop") - F.col("start") + F.col("before") + F.col("after"))
    whole = by_alignment.agg(F.collect_list(run).alias("runs"), held.alias("held"))
    return whole.where(F.col("held") >= 2 * spec.run_words - 1).drop("held")


def _last_blank(text: bytes, a: int, b: int) -> int:
    return max(text.rfind(bytes([c]), a, b) for c in _BLANKS)


def _first_blank(text: bytes, a: int, b: int) -> int:
    return min((k for c in _BLANKS if (k := text.find(bytes([c]), a, b)) >= 0), default=-1)


def _whole_words(text: bytes, a: int, b: int, cut_a: bool, cut_b: bool) -> tuple[int, int]:
    """The span without a word that it cuts, or that the other text does, and without the
    blanks at its ends inside the text."""
    if a < b and (cut_a or a > 0 and text[a - 1] not in _BLANKS) and text[a] not in _BLANKS:
        at = _first_blank(text, a, b)
        a = b if at < 0 else at
    if a < b and (cut_b or b < len(text) and text[b] not in _BLANKS) and text[b - 1] not in _BLANKS:
        b = max(_last_blank(text, a, b), a)
    while a > 0 and a < b and text[a] in _BLANKS:
        a += 1
    while b < len(text) and b > a and text[b - 1] in _BLANKS:
        b -= 1
    return a, b


def _agreed(text: bytes, run: dict) -> bool:
    """Whether the run is one of this text: another row of the same doc_id may hold another."""
    a, b = run["start"], run["stop"]
    before, after = text[max(a - run["before"], 0) : a][::-1], text[b : b + run["after"]]
    own = (crc32(text[a:b]), crc32(before), crc32(after))
    return b <= len(text) and own == (run["check"], run["check_before"], run["check_after"])


def _spans(text: bytes | None, found: list[dict], spec: ChunkSpec) -> list[tuple[int, int, int]]:
    """(start, end, first_doc_id) of the passages to remove, not overlapping."""
    spans: list[tuple[int, int, int]] = []
    for alignment in found if text else []:
        own: list[list] = []
        for r in sorted((r for r in alignment["runs"] if _agreed(text, r)), key=lambda r: r["start"]):
            a, b = r["start"] - r["before"], r["stop"] + r["after"]
            if own and a <= own[-1][1]:
                if b >= own[-1][1]:
                    own[-1][1], own[-1][3] = b, r["cut_after"]
            else:
                own.append([a, b, r["cut_before"], r["cut_after"]])
        for a, b, cut_a, cut_b in own:
            a, b = _whole_words(text, a, b, cut_a, cut_b)
            if len(text[a:b].split()) >= spec.run_words:
                spans.append((a, b, alignment["first_doc_id"]))
    joined: list[tuple[int, int, int]] = []
    for a, b, source in sorted(spans):
        if joined and a <= joined[-1][1]:
            joined[-1] = joined[-1][0], max(b, joined[-1][1]), min(source, joined[-1][2])
        else:
            joined.append((a, b, source))
    return joined


SPANS = "array<struct<start:int,length:int,first_doc_id:bigint>>"
_SPAN_TYPE = pa.list_(
    pa.struct([("start", pa.int32()), ("length", pa.int32()), ("first_doc_id", pa.int64())])
)


def _cleaner(spec: ChunkSpec):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.row_slices(batches):
            texts = batch.column("__text").cast(pa.binary()).to_pylist()
            kept, spans = [], []
            for text, runs in zip(texts, batch.column("__spans").to_pylist()):
                found, parts, at = [], [], 0
                for a, b, source in _spans(text, runs or [], spec):
                    found.append({"start": a, "length": b - a, "first_doc_id": source})
                    parts.append(text[at:a])
                    at = b
                if found:
                    text = b"".join([*parts, text[at:]])
                kept.append(None if text is None else text.decode("utf-8"))
                spans.append(found)
            own = {"__text": pa.array(kept, pa.string()), "__spans": pa.array(spans, _SPAN_TYPE)}
            columns = [own.get(n, batch.column(n)) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return clean


def deduplicate_passages(docs: DataFrame, spec: ChunkSpec = ChunkSpec()) -> DataFrame:
    """``docs`` with repeated passages cut from ``text`` and their places in ``removed_spans``.

    A span gives start and length in bytes of the old text, and the smallest first document of
    its chunks. It covers whole words up to where the texts differ, and has ``run_words`` words
    or more on one alignment with one document, the first that has the chunk; where that one
    goes on in an end word, the word stays. The first holder keeps a passage; repeats inside
    one document stay. A null text stays null, an empty one empty; a wholly repeated text
    becomes empty. Rows with a null doc_id are neither sources nor cut. Rows sharing a
    doc_id are one document, not repeats of each other. A column named ``removed_spans`` is
    replaced.
    """
    docs = docs.drop("removed_spans")
    mark = F.struct("start", "size", "left", "right", "first_doc_id", "first_start")
    # No more than the chunks of one text.
    marks = repeated_chunks(docs, spec).groupBy("doc_id").agg(F.collect_set(mark).alias("marks"))
    runs = stage(marks.mapInArrow(_run_finder(spec), RUNS), "runs")
    found = compared_runs(docs, runs, spec).groupBy(F.col("doc_id").alias("__doc"))
    found = found.agg(F.collect_list(F.struct("first_doc_id", "runs")).alias("__spans"))
    found = stage(found, "found")
    others = [c for c in docs.columns if c != "text"]
    joined = docs.join(found, F.col("doc_id").cast("long") == F.col("__doc"), "left").select(
        *[F.col(f"`{c}`") for c in others], F.col("text").alias("__text"), "__spans"
    )
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others]
    cleaned = joined.mapInArrow(_cleaner(spec), ", ".join([*fields, "__text string", f"__spans {SPANS}"]))
    text = F.col("__text").alias("text")
    return cleaned.select(
        *[text if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.col("__spans").alias("removed_spans"),
    )
