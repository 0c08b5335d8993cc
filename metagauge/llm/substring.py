"""Substring deduplication by level-wise doubling of word windows.

A window of ``min_words`` words that occurs more than once in the corpus is
kept at its first place, by (doc_id, text hash, word position), and cut
everywhere else. Lengths double, and each level looks only at what the level
before left:

* ``min_words / 2``: of these windows a minimizer for each window of
  ``min_words`` words is counted, so each repeated passage of ``min_words``
  words has one that repeats at the same place in each of its copies;
* ``min_words``: around minimizers that repeat, and nowhere else, every window
  is compared. What repeats is cut but for its first place;
* twice, four times ... that: a window is hashed only if both of its halves
  repeat, until no candidate survives. They tell how long a document's longest
  repeat is (``longest_repeat``, the longest of ``min_words``, twice, four
  times ... that repeats; null where none does). Without a report these levels
  are not run. The plan has as many as the farthest repeated minimizer allows;
  a document without survivors goes through the rest without its text.

Equal texts are one document for all of this: the first of them stands for the
others, which are cut whole. Windows of a level are shuffled in lists, by the
hash of the minimizer of their first ``min_words`` words, one row for each place
of a minimizer. A minimizer with more than HOT places is hot: its windows are
shuffled one by one, by their own hashes, and of those that are equal within a
task only the first is (the others are neither the first in the corpus nor
unique, whatever else there is). So no task gets a group that grows with a
passage's copies. Tables between steps hold hashes, never texts; documents are
shuffled once.

Defined results: null or empty text, and text of fewer than ``min_words``
words, stays as it is. A passage that repeats within one document is cut from
its second place on. Rows with the same doc_id and text are one document: they
are cut alike and all stay. doc_ids are integers (ValueError otherwise); a null
one sorts first, as -2**63 does. Words are separated by
ASCII white space and compared byte for byte (by 64-bit hashes of windows with
the same minimizer). Extra columns pass through; the names that are added are
prefixed where they clash with input columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import free, key
from .scratch import written
from .textcore import Words, mix, signed, slices

#: A minimizer at more places than this is hot.
HOT = 20_000
#: Windows that a task compares at a time, but for groups that are larger.
BLOCK = 300_000


def minimizers(words: Words, half: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows of 2 * half words, the minimizer's start for each, and hashes of half-length windows."""
    m = len(words.hash) - half + 1
    at = words.fits(2 * half)
    if not len(at):
        return at, at, np.zeros(0, np.uint64)
    h = words.windows(np.arange(m), half, sums)
    view = np.lib.stride_tricks.sliding_window_view(h, half + 1)
    low = np.empty(len(at), np.int64)
    for i in range(0, len(at), 1 << 16):
        low[i : i + (1 << 16)] = view[at[i : i + (1 << 16)]].argmin(axis=1)
    return at, at + low, h


class Names:
    """Columns that the steps add to documents, named so that they clash with none of theirs."""

    def __init__(self, docs: DataFrame):
        self.key, self.hash, self.text = (free(docs, f"_sd_{x}") for x in ("key", "hash", "text"))
        self.spots, self.marks, self.level, self.whole = (free(docs, f"_sd_{x}") for x in ("spots", "marks", "level", "whole"))


def _anchors(half: int, text: str, hashed: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                words = Words.of(part.column(text))
                _, low, h = minimizers(words, half, words.sums())
                low = np.unique(low)
                doc = words.doc[low]
                yield pa.RecordBatch.from_arrays([pa.array(signed(h[low])), part.column(hashed).take(pa.array(doc)), pa.array((low - words.first[doc]).astype(np.int32))], ["anchor", hashed, "at"])

    return run


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


#: Windows of one place of a minimizer: bit i of mask is for word lo + i, values are their hashes in order. Rows without values are settled, those
#: without a mask have a document's last level in lo; known ones are known to repeat.
ROWS = pa.schema([("bucket", pa.int64()), ("k", pa.int64()), ("h", pa.int64()), ("lo", pa.int32()), ("mask", pa.int64()), ("hot", pa.bool_()), ("known", pa.bool_()), ("values", pa.list_(pa.int64()))])
ROWS_SQL = "bucket long, k long, h long, lo int, mask long, hot boolean, known boolean, values array<long>"
MARKS = ("bucket", "lo", "hot", "again", "dead")
MARKS_SQL = "k long, h long, bucket long, lo int, hot boolean, again long, dead long"


def _compared(group: tuple[np.ndarray, ...], k: np.ndarray, h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each window whether its group has another place, and whether it has an earlier one."""
    order = np.lexsort((at, h, k, *group))
    new = np.ones(len(order), bool)
    new[1:] = np.any([g[order[1:]] != g[order[:-1]] for g in group], axis=0)
    begin = np.flatnonzero(new)
    which = np.cumsum(new) - 1
    first, last = order[begin], order[np.append(begin[1:], len(order)) - 1]
    other = lambda a, b: (k[a] != k[b]) | (h[a] != h[b]) | (at[a] != at[b])
    again, dead = np.empty(len(order), bool), np.empty(len(order), bool)
    again[order], dead[order] = other(first, last)[which], other(order, first[which])
    return again, dead


class _Hot:
    """Windows of hot minimizers, of which equal ones are settled within the task but for the first."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.n = 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.n += len(columns[0])

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        value, k, h, at = (np.concatenate(c) for c in zip(*self.parts))
        self.parts, self.n = [], 0
        again, dead = _compared((value,), k, h, at)
        one = np.ones(len(k), bool)
        bucket = np.where(dead, signed(mix((k ^ h).view(np.uint64))), signed(value))
        lists = _lists(signed(value)[~dead], (~dead).astype(np.int64), pa.int64())
        yield from _parts([bucket, k, h, at.astype(np.int32), one.astype(np.int64), one, again & ~dead], lists)


def _parts(columns: list[np.ndarray], lists: pa.Array, most: int = 20_000) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(lists), most):
        yield pa.RecordBatch.from_arrays([*(pa.array(c[i : i + most]) for c in columns), lists.slice(i, most)], schema=ROWS)


def _listed(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """What lists hold, and the row of each."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten(), np.repeat(np.arange(len(column)), pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False))


def _bits(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of each bit that is set, in order."""
    return np.nonzero(np.unpackbits(np.ascontiguousarray(mask, "<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))


def _spots(column: pa.Array, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Words at which repeated minimizers begin, ascending, and whether each is hot."""
    code, doc = _listed(column)
    code = np.unique(code.to_numpy(zero_copy_only=False) + 2 * words.first[doc])
    return code >> 1, (code & 1).astype(bool)


def _around_spots(part: pa.RecordBatch, words: Words, half: int, sums: np.ndarray, names: Names) -> tuple[np.ndarray, ...]:
    """Windows of 2 * half words around spots: words at which they begin, ascending, minimizers' hashes and whether they are hot, and a number for each minimizer's place."""
    at, low, h = minimizers(words, half, sums)
    start, hot = _spots(part.column(names.spots), words)
    if not len(start) or not len(at):
        return at[:0], h[:0].view(np.int64), np.zeros(0, bool), at[:0]
    place = np.minimum(np.searchsorted(start, low), len(start) - 1)
    chosen = np.flatnonzero(start[place] == low)
    return at[chosen], signed(h[low[chosen]]), hot[place[chosen]], low[chosen]


def _with_both_halves(part: pa.RecordBatch, words: Words, length: int, names: Names) -> tuple[np.ndarray, ...]:
    """The same of windows of which both halves are marked."""
    marks, doc = _listed(part.column(names.marks))
    bucket, lo, hot, again = (marks.field(f).to_numpy(zero_copy_only=False) for f in range(4))
    row, bit = _bits(again)
    start, at = np.unique(lo[row] + bit + words.first[doc[row]], return_index=True)
    row = row[at]
    if not len(start):
        return start, bucket[:0], np.zeros(0, bool), row
    place = np.minimum(np.searchsorted(start, start + length // 2), len(start) - 1)
    chosen = np.flatnonzero((start[place] == start + length // 2) & (words.doc[start[place]] == words.doc[start]))
    row = row[chosen]
    return start[chosen], bucket[row], hot[row].astype(bool), row


def _windows(half: int, length: int, names: Names):
    """Rows of candidates of this length: around spots if it is 2 * half words, else windows whose halves are both marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_ones = _Hot()
        for batch in batches:
            for part in slices(batch, names.text):
                words = Words.of(part.column(names.text))
                sums = words.sums()
                if length == 2 * half:
                    at, bucket, hot, place = _around_spots(part, words, half, sums, names)
                else:
                    yield _carried(part, names)
                    at, bucket, hot, place = _with_both_halves(part, words, length, names)
                if not len(at):
                    continue
                value, doc = words.windows(at, length, sums), words.doc[at]
                k, th = part.column(names.key).to_numpy(), part.column(names.hash).to_numpy()
                if hot.any():
                    hot_ones.add(value[hot], k[doc[hot]], th[doc[hot]], at[hot] - words.first[doc[hot]])
                    if hot_ones.n > BLOCK:
                        yield from hot_ones.flush()
                    at, bucket, place, value, doc = at[~hot], bucket[~hot], place[~hot], value[~hot], doc[~hot]
                    if not len(at):
                        continue
                begin = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
                counts = np.diff(np.append(begin, len(place)))
                mask = np.add.reduceat(np.int64(1) << (at - np.repeat(at[begin], counts)), begin)
                doc, no = doc[begin], np.zeros(len(begin), bool)
                yield from _parts([bucket[begin], k[doc], th[doc], (at[begin] - words.first[doc]).astype(np.int32), mask, no, no], _lists(signed(value), counts, pa.int64()))
        yield from hot_ones.flush()

    return run


def _carried(part: pa.RecordBatch, names: Names) -> pa.RecordBatch:
    k, h = part.column(names.key).to_numpy(), part.column(names.hash).to_numpy()
    no = np.zeros(len(k), bool)
    return next(_parts([signed(mix((k ^ h).view(np.uint64))), k, h, part.column(names.level).to_numpy(), no.astype(np.int64), no, no], _lists(k[:0], no.astype(np.int64), pa.int64()), len(k)))


def _survive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks of rows, sorted by bucket, that have windows that repeat."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket = batch.column("bucket").to_numpy()
        if n > BLOCK:  # up to the batch's last bucket, which may go on in the next batch
            cut = int(np.searchsorted(bucket, bucket[-1]))
            if cut or held[-1].column("bucket")[-1].as_py() != bucket[0]:
                yield _marks([*held, batch.slice(0, cut)])
                held, n, batch = [], 0, batch.slice(cut)
        held.append(batch)
        n += batch.num_rows + len(batch.column("values").flatten())
    if held:
        yield _marks(held)


def _marks(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
    bucket, k, h, lo, mask, hot, known = (rows.column(c).to_numpy(zero_copy_only=False) for c in ROWS.names[:-1])
    value, row = _listed(rows.column("values"))
    value = value.to_numpy(zero_copy_only=False)
    listed = np.zeros(len(k), bool)
    listed[row] = True
    again_bits, dead_bits = np.where(listed, 0, mask), np.where(listed, 0, mask)
    if len(row):
        bit = _bits(mask * listed)[1]
        again, dead = _compared((value, bucket[row]), k[row], h[row], lo[row] + bit)
        again |= known[row]
        begin = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        again_bits[row[begin]] = np.add.reduceat(again.astype(np.int64) << bit, begin)
        dead_bits[row[begin]] = np.add.reduceat(dead.astype(np.int64) << bit, begin)
    left = np.flatnonzero((again_bits != 0) | (mask == 0))
    return pa.RecordBatch.from_arrays([pa.array(c[left]) for c in (k, h, bucket, lo, hot.astype(bool), again_bits, dead_bits)], ["k", "h", *MARKS])


def _cut(full: int, columns: list[str], text: str, cuts: str, longest: str, whole: str, n_chars: str | None):
    """Texts without the words that dead windows cover; cuts becomes the spans of words that went, longest is completed for texts that occur more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                marks = part.column(cuts)
                marks = marks.combine_chunks() if isinstance(marks, pa.ChunkedArray) else marks
                twice = part.column(whole).to_numpy(zero_copy_only=False)
                rows = np.flatnonzero(np.asarray(marks.is_valid()) | (twice > 0))
                gone, most, cut, left = [None] * part.num_rows, part.column(longest).to_pylist(), [], []
                words = Words.of(part.column(text).take(pa.array(rows)))
                for i in np.flatnonzero((twice[rows] > 0) & (words.counts >= full)).tolist():
                    most[rows[i]] = max(most[rows[i]] or 0, full << (int(words.counts[i]) // full).bit_length() - 1)
                begin, end = _spans(marks.take(pa.array(rows)), twice[rows] == 2, words, full)
                data = words.data.tobytes()
                edge = np.searchsorted(begin, words.first)
                for i in np.flatnonzero(np.diff(edge)).tolist():
                    r, to, pieces = int(rows[i]), int(words.first[i + 1]), []
                    spans = list(zip(begin[edge[i] : edge[i + 1]].tolist(), end[edge[i] : edge[i + 1]].tolist()))
                    at = int(words.offsets[i])
                    for a, b in spans:
                        pieces.append(data[at : int(words.start[a])])
                        at = int(words.start[b]) if b < to else int(words.offsets[i + 1])
                    pieces.append(data[at : int(words.offsets[i + 1])])
                    cut.append(r)
                    left.append(b"".join(pieces).decode())
                    if spans[-1][1] == to:
                        left[-1] = left[-1].rstrip(" \t\n\r\x0b\x0c")
                    first = int(words.first[i])
                    gone[r] = [{"start": a - first, "end": b - first} for a, b in spans]
                which = np.zeros(part.num_rows, bool)
                which[cut] = True
                arrays = []
                for name in columns:
                    c = part.column(name)
                    if name == text and cut:
                        c = pa.compute.replace_with_mask(c, pa.array(which), pa.array(left, c.type))
                    elif name == cuts:
                        c = pa.array(gone, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
                    elif name == longest:
                        c = pa.array(most, pa.int32())
                    elif name == n_chars and cut:
                        c = pa.compute.replace_with_mask(c, pa.array(which), pa.array(map(len, left), c.type))
                    arrays.append(c)
                yield pa.RecordBatch.from_arrays(arrays, columns)

    return run


def _spans(marks: pa.Array, whole: np.ndarray, words: Words, full: int) -> tuple[np.ndarray, np.ndarray]:
    """Words at which runs of words begin and end, within their text, that dead windows cover, or whole texts of at least full words."""
    flat, doc = _listed(marks)
    lo, dead = (flat.field(MARKS.index(c)).to_numpy(zero_copy_only=False) for c in ("lo", "dead"))
    row, bit = _bits(dead)
    start = lo[row] + bit + words.first[doc[row]]
    n = len(words.hash)
    depth = np.cumsum(np.bincount(start, minlength=n + 1) - np.bincount(start + full, minlength=n + 1))[:n]
    covered = (depth > 0) | (whole & (words.counts >= full))[words.doc]
    other = np.concatenate(([True], words.doc[1:] != words.doc[:-1], [True])) if n else np.zeros(1, bool)  # texts' edges
    before, after = np.concatenate(([False], covered)), np.concatenate((covered, [False]))
    return np.flatnonzero(after & (~before | other)), np.flatnonzero(before & (~after | other))


def _level(found: DataFrame, half: int, length: int, names: Names) -> DataFrame:
    """(key, hash, marks, level) of documents: marks of windows of this length that repeat, and the last level at which some did."""
    rows = found.mapInArrow(_windows(half, length, names), ROWS_SQL).repartition("bucket").sortWithinPartitions("bucket")
    marks = rows.mapInArrow(_survive, MARKS_SQL)
    live = F.col("again") != 0
    return marks.groupBy(F.col("k").alias(names.key), F.col("h").alias(names.hash)).agg(
        F.collect_list(F.when(live, F.struct(*MARKS))).alias(names.marks), F.max(F.when(live, F.lit(length)).otherwise(F.col("lo"))).alias(names.level)
    )


def repeats(docs: DataFrame, names: Names, min_words: int, report: bool, hot: int) -> DataFrame:
    """(key, hash, marks, level, whole) of documents with repeats; whole is 2 for later copies of an equal text, 1 for the first of several."""
    half = min_words // 2
    if min_words % 2 or not 4 <= half <= 62:
        raise ValueError("min_words must be even, from 8 to 124")
    k, h = names.key, names.hash
    anchors = docs.select(h, names.text).mapInArrow(_anchors(half, names.text, h), f"anchor long, `{h}` long, at int")
    place = F.xxhash64(h, "at")
    counted = anchors.groupBy("anchor").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.count(F.lit(1)).alias("n"), F.max("at").alias("far"))
    repeated = written(counted.where("a != b").select("anchor", (F.col("n") > hot).cast("int").alias("hot"), "far"), "sd-minimizers")
    spots = anchors.join(repeated.select("anchor", "hot"), "anchor").groupBy(h).agg(F.collect_set(F.col("at").cast("long") * 2 + F.col("hot")).alias(names.spots))

    ids = docs.select(k, h, F.xxhash64(F.coalesce(names.text, F.lit("")), F.lit(1)).alias("more"))
    heads = ids.groupBy(h, "more").agg(F.min(k).alias("head"), F.max(k).alias("last"))
    found = docs.join(heads.select(h, F.col("head").alias(k)).join(spots, h), [k, h])
    first = last = _level(found, half, min_words, names)
    if report:
        longest = (repeated.select(F.max("far")).first()[0] or 0) + min_words  # the last window of a repeat has a minimizer that repeats
        length = 2 * min_words
        while length <= longest:
            found = docs.join(last, [k, h]).withColumn(names.text, F.when(F.size(names.marks) > 0, F.col(names.text)))
            last = _level(found, half, length, names)
            length *= 2
    copies = ids.join(heads.where("head != last"), [h, "more"]).select(k, h, F.when(F.col(k) == F.col("head"), 1).otherwise(2).alias(names.whole))
    parts = [first.select(k, h, names.marks, names.level), copies]
    out, *rest = [*parts, last.select(k, h, names.level)] if report else parts
    for more in rest:
        out = out.unionByName(more, allowMissingColumns=True)
    return out.groupBy(k, h).agg(F.first(names.marks, ignorenulls=True).alias(names.marks), F.max(names.level).alias(names.level), F.max(names.whole).alias(names.whole))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50, report: bool = True, hot: int = HOT) -> DataFrame:
    """Documents without the later copies of repeated passages.

    All input columns, with the text cut and n_chars, where there is one, set
    anew for texts that were; with report also ``cuts`` (start, end word of
    each span that went; null where none did) and ``longest_repeat``.
    """
    columns = docs.columns
    names = Names(docs)
    text = F.col(f"`{text_col}`")
    known = F.coalesce(text, F.lit(""))
    # Both joins with documents take all of these columns, so that Spark shuffles them once.
    keyed = docs.withColumns({names.key: key(docs, id_col), names.hash: F.xxhash64(known), names.text: text})
    keyed = keyed.select(names.key, names.hash, names.text, *[f"`{c}`" for c in columns if c != text_col])
    found = repeats(keyed, names, min_words, report, hot)
    cuts, longest = free(docs, "cuts"), free(docs, "longest_repeat")
    own = [F.col(names.text).alias(text_col) if c == text_col else F.col(f"`{c}`") for c in columns]
    joined = keyed.join(found, [names.key, names.hash], "left").select(*own, F.col(names.marks).alias(cuts), F.col(names.level).alias(longest), F.coalesce(names.whole, F.lit(0)).alias(names.whole))
    n_chars = "n_chars" if "n_chars" in columns and "n_chars" not in (id_col, text_col) and dict(docs.dtypes)["n_chars"] in ("bigint", "int") else None
    spans = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([*joined.schema.fields[:-3], T.StructField(cuts, spans), T.StructField(longest, T.IntegerType())])
    out = joined.mapInArrow(_cut(min_words, [*columns, cuts, longest], text_col, cuts, longest, names.whole, n_chars), schema)
    return out if report else out.select(*[f"`{c}`" for c in columns])
