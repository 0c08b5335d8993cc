"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The encoder keeps an agenda of adjacent symbol pairs ordered by score: the pair
whose concatenation has the best score merges first, the leftmost among equals,
until no pair is a piece. It does so for many strings at a time: each round
merges the best pair of every string in numpy arrays. A string of more than
LONG symbols has an agenda of its own, a heap, so that its cost stays n log n.

No piece of the vocabularies served has a space mark inside or after other
characters, nor a line feed, so texts fall into chunks (spaces and what
follows up to the next space or line feed) that encode independently. The
distinct chunks of an Arrow batch are encoded once; those that a worker has
not met before are checked against the sentencepiece library. Each text's ids are
decoded and compared with it. Both outcomes are columns of the result.

Defined results: a null text has null ids and n_tokens 0; an empty one has no
ids. Characters without a piece become byte pieces. doc_ids are integers
(ValueError otherwise), or null. Extra columns are ignored.
A vocabulary that breaks the assumptions above (unigram, no byte fallback, a
normaliser other than identity) raises ValueError on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import integer
from .textcore import flat, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Chunks that a worker remembers, and symbols from which on a string has a heap of its own: for memory and speed; results don't depend on them.
CACHE, LONG = 250_000, 200
SLICE = 1_000_000
_NONE = np.iinfo(np.int32).max


def load(path: str = MODEL) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Bpe:
    """Tables of one vocabulary."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.lib = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        try:
            from sentencepiece import sentencepiece_model_pb2 as pb

            proto = pb.ModelProto.FromString(model)
            spec = proto.normalizer_spec
            if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback or proto.trainer_spec.treat_whitespace_as_suffix:
                raise ValueError("only BPE vocabularies with byte fallback are served")
            if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
                raise ValueError("only the identity normaliser with a dummy prefix is served")
        except ImportError:
            if lib.encode("  a  ") != [*lib.encode("  a"), *lib.encode(" ")[1:]]:
                raise ValueError("only the identity normaliser with a dummy prefix is served") from None
        self.size = n = lib.get_piece_size()
        pieces = [lib.id_to_piece(i) for i in range(n)]
        normal = [not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i)) for i in range(n)]
        self.byte_ids = np.array([lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        ids = {p: i for i, p in enumerate(pieces) if normal[i]}
        if any("\n" in p and len(p) > 1 or MARK in p.lstrip(MARK) for p in ids):
            raise ValueError("pieces must not span spaces or line feeds")
        #: Symbols: ids of pieces, and for other characters size + code point.
        self.symbol = np.arange(0x110000, dtype=np.int32) + n
        for p, i in ids.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        scores = np.array([lib.get_score(i) for i in range(n)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        keys, values = [], []
        one = lambda s: ids[s] if s in ids else n + ord(s) if len(s) == 1 else None
        for p, i in ids.items():
            for k in range(1, len(p)):
                a, b = one(p[:k]), one(p[k:])
                if a is not None and b is not None:
                    keys.append(a << 22 | b)
                    values.append(i)
        self.keys, self.values = np.array(keys, np.int64), np.array(values, np.int32)
        self._place()
        self.table: dict[int, int] = {}  # of long strings alone
        texts = []
        for i, p in enumerate(pieces):
            if lib.is_byte(i):
                texts.append(bytes([int(p[3:5], 16)]))
            elif lib.is_control(i):
                texts.append(b"")
            elif lib.is_unknown(i):
                texts.append(" ⁇ ".encode())
            else:
                texts.append(p.replace(MARK, " ").encode())
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.at = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)

    def _place(self) -> None:
        """A hash table of pairs, with linear probing, at most an eighth full."""
        size = 1 << max(4, (8 * len(self.keys)).bit_length())
        self.shift = np.uint64(65 - size.bit_length())
        self.slots, self.made = np.full(size, -1, np.int64), np.full(size, -1, np.int32)
        left, at = np.arange(len(self.keys)), self._slot(self.keys)
        while len(left):
            empty = np.flatnonzero(self.slots[at] < 0)
            _, first = np.unique(at[empty], return_index=True)
            put = empty[first]
            self.slots[at[put]], self.made[at[put]] = self.keys[left[put]], self.values[left[put]]
            left, at = np.delete(left, put), np.delete(at, put) + 1 & size - 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Pieces that these pairs make; -1 for none."""
        key = left.astype(np.int64) << 22 | right
        at = self._slot(key)
        found = self.slots[at]
        out = np.where(found == key, self.made[at], -1)
        more = np.flatnonzero((found != key) & (found >= 0))
        at = at[more]
        while len(more):
            at = at + 1 & len(self.slots) - 1
            found = self.slots[at]
            hit = found == key[more]
            out[more[hit]] = self.made[at[hit]]
            on = ~hit & (found >= 0)
            more, at = more[on], at[on]
        return out

    def agenda(self, sym: np.ndarray) -> np.ndarray:
        """Symbols of one string after all merges."""
        if not self.table:
            self.table = dict(zip(self.keys.tolist(), self.values.tolist()))
        table, rank = self.table, self.rank
        new = self.merged(sym[:-1], sym[1:])
        at = np.flatnonzero(new >= 0)
        own = sym.tolist()
        n = len(own)
        heap = list(zip(rank[new[at]].tolist(), at.tolist(), sym[at].tolist(), sym[at + 1].tolist(), new[at].tolist()))
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            _, i, a, b, made = heappop(heap)
            j = after[i]
            if own[i] != a or j >= n or own[j] != b:
                continue  # one of the two has merged since
            own[i], own[j] = made, -1
            after[i] = j = after[j]
            if j < n:
                before[j] = i
                if (m := table.get(made << 22 | own[j], -1)) >= 0:
                    heappush(heap, (int(rank[m]), i, made, own[j], m))
            if (h := before[i]) >= 0 and (m := table.get(own[h] << 22 | made, -1)) >= 0:
                heappush(heap, (int(rank[m]), h, own[h], made, m))
        return np.array([x for x in own if x >= 0], np.int32)

    def encode(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty strings and their n + 1 offsets. Spaces are space marks; no prefix is added."""
        code = np.frombuffer("".join(strings).replace(" ", MARK).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        sym = self.symbol[code]
        word = np.repeat(np.arange(len(strings), dtype=np.int32), sizes)
        done_sym, done_word = [], []
        if len(sizes) and sizes.max() > LONG:
            ends = np.cumsum(sizes)
            for k in np.flatnonzero(sizes > LONG).tolist():
                done_sym.append(self.agenda(sym[ends[k] - sizes[k] : ends[k]]))
                done_word.append(np.full(len(done_sym[-1]), k, np.int32))
            short = np.repeat(sizes <= LONG, sizes)
            sym, word = sym[short], word[short]
        new = np.full(len(sym), -1, np.int32)
        inner = np.flatnonzero(word[:-1] == word[1:])
        new[inner] = self.merged(sym[inner], sym[inner + 1])
        ranks = np.where(new >= 0, self.rank[new], _NONE)
        while len(sym):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            best = np.minimum.reduceat(ranks, starts)
            lengths = np.diff(np.append(starts, len(sym)))
            live = best < _NONE
            if not live.all():
                keep = np.repeat(live, lengths)
                done_sym.append(sym[~keep])
                done_word.append(word[~keep])
                sym, word, new, ranks = sym[keep], word[keep], new[keep], ranks[keep]
                best, lengths = best[live], lengths[live]
                if not len(sym):
                    break
            hit = np.flatnonzero(ranks == np.repeat(best, lengths))
            hit = hit[np.concatenate(([True], word[hit[1:]] != word[hit[:-1]]))]
            sym[hit] = new[hit]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            at = hit - np.arange(len(hit))  # where the merged symbols are then
            sym, word, new, ranks = sym[keep], word[keep], new[keep], ranks[keep]
            for pos in (at, at[at > 0] - 1):
                pos = pos[pos + 1 < len(sym)]
                same = word[pos] == word[pos + 1]
                m = np.where(same, self.merged(sym[pos], sym[pos + 1]), -1)
                new[pos], ranks[pos] = m, np.where(m >= 0, self.rank[m], _NONE)
            if len(at) and at[-1] == len(sym) - 1:
                new[-1], ranks[-1] = -1, _NONE
        sym, word = np.concatenate(done_sym or [np.zeros(0, np.int32)]), np.concatenate(done_word or [np.zeros(0, np.int32)])
        order = np.argsort(word, kind="stable")
        sym, word = sym[order], word[order]
        odd = np.flatnonzero(sym >= self.size)
        if len(odd):  # byte fallback
            bytes_of = [chr(c).encode("utf-8", "surrogatepass") for c in (sym[odd] - self.size).tolist()]
            reps = np.ones(len(sym), np.int64)
            reps[odd] = [len(b) for b in bytes_of]
            is_odd = np.repeat(sym >= self.size, reps)
            sym, word = np.repeat(sym, reps), np.repeat(word, reps)
            sym[is_odd] = self.byte_ids[np.frombuffer(b"".join(bytes_of), np.uint8)]
        return sym, np.concatenate(([0], np.cumsum(np.bincount(word, minlength=len(strings)))))

    def raw(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that ids stand for, and the offsets of each id's."""
        size = self.at[ids + 1] - self.at[ids]
        out = np.concatenate(([0], np.cumsum(size)))
        where = np.repeat(self.at[ids] - out[:-1], size) + np.arange(out[-1])
        return self.bytes[where], out

    def library(self, chunks: list[str]) -> list[list[int]]:
        """What the library makes of chunks where they stand in a text."""
        plain = [c[0] == " " and c.strip(" ") != "" for c in chunks]
        got = self.lib.encode([c[1:] if p else "\n" + c for c, p in zip(chunks, plain)], num_threads=1)
        return [g if p else g[2:] for g, p in zip(got, plain)]


class Encoder:
    """Encodes Arrow arrays of texts; remembers chunks. One to a worker."""

    def __init__(self, model: bytes, check: bool = False):
        self.bpe, self.check = Bpe(model), check
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.pool = np.zeros(0, np.int32)
        self.start, self.count, self.same = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def learn(self, chunks: list[str]) -> None:
        ids, offsets = self.bpe.encode(chunks)
        base = len(self.known)
        counts = np.diff(offsets)
        same = np.ones(len(chunks), bool)
        if self.check:
            theirs = self.bpe.library(chunks)
            lens = np.fromiter(map(len, theirs), np.int64, len(theirs))
            if not np.array_equal(lens, counts) or not np.array_equal(np.fromiter(chain.from_iterable(theirs), np.int32, int(lens.sum())), ids):
                same = np.array([t == ids[a:b].tolist() for t, a, b in zip(theirs, offsets[:-1].tolist(), offsets[1:].tolist())])
        self.known.update(zip(chunks, range(base, base + len(chunks))))
        self.start = np.concatenate((self.start, len(self.pool) + offsets[:-1]))
        self.pool = np.concatenate((self.pool, ids))
        self.count = np.concatenate((self.count, counts))
        self.same = np.concatenate((self.same, same))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, n + 1 offsets, and per text, with check, whether the library agrees and whether decoding gives it back."""
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        n = len(texts)
        before = texts
        if pc.any(pc.match_substring(texts, MARK)).as_py():  # the library takes a mark for a space
            texts = pc.replace_substring(texts, MARK, " ")
        some = pc.not_equal(pc.binary_length(texts), 0)
        data, offsets = flat(pc.if_else(some, pc.binary_join_element_wise(pa.scalar(" ", texts.type), texts, pa.scalar("", texts.type)), texts))
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64), np.ones(n, bool), np.ones(n, bool)
        cut = np.zeros(len(data) + 1, bool)
        space, feed = data == 32, data == 10
        cut[1:-1] = (space[1:] & ~space[:-1]) | feed[1:] | feed[:-1]
        cut[offsets] = True
        cut[-1] = True
        at = np.flatnonzero(cut)
        chunks = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)) if len(data) < 2**31 else pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data))
        coded = chunks.dictionary_encode()
        own = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > CACHE:
            self.clear()
        where = np.fromiter(map(self.known.get, own, [-1] * len(own)), np.int64, len(own))
        missing = np.flatnonzero(where < 0)
        if len(missing):
            base = len(self.known)
            self.learn([own[i] for i in missing.tolist()])
            where[missing] = base + np.arange(len(missing))
        which = where[coded.indices.to_numpy()]
        counts = self.count[which]
        ends = np.concatenate(([0], np.cumsum(counts)))
        ids = self.pool[np.repeat(self.start[which] - ends[:-1], counts) + np.arange(ends[-1])]
        first = np.searchsorted(at[:-1], offsets)
        offsets = ends[first]
        if not self.check:
            return ids, offsets, np.ones(n, bool), np.ones(n, bool)
        wrong = np.concatenate(([0], np.cumsum(~self.same[which])))
        return ids, offsets, wrong[first[1:]] == wrong[first[:-1]], self.decodes(ids, offsets, before)

    def decodes(self, ids: np.ndarray, offsets: np.ndarray, texts: pa.Array) -> np.ndarray:
        """Of each text whether it is what its ids decode to."""
        data, at = flat(texts)
        got, ends = self.bpe.raw(ids)
        ends = ends[offsets]
        some = np.diff(ends) > 0
        size = np.diff(ends) - some  # but for the space put before
        out = size == np.diff(at)
        keep = np.ones(len(got), bool)
        keep[ends[:-1][some]] = False
        got = got[keep]
        if out.all():
            off = np.concatenate(([0], np.cumsum(got != data)))
            return off[at[1:]] == off[at[:-1]]
        to = np.cumsum(size)
        return np.array([o and np.array_equal(got[e - s : e], data[a:b]) for o, s, e, a, b in zip(out.tolist(), size.tolist(), to.tolist(), at[:-1].tolist(), at[1:].tolist())], bool)


_encoders: dict[tuple[int, bool], Encoder] = {}


def encoder(model: bytes, check: bool = False) -> Encoder:
    """The worker's encoder, kept from task to task."""
    key = hash(model), check
    if key not in _encoders:
        _encoders[key] = Encoder(model, check)
    return _encoders[key]


def id_lists(ids: np.ndarray, offsets: np.ndarray, valid: np.ndarray) -> pa.Array:
    mask = None if valid.all() else pa.array(~valid)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()), mask=mask)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: bytes | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids, library_equal, decoded_equal) of every row.

    decoded_equal is whether the ids, decoded, are the text, byte for byte. The library takes U+2581 for a
    space, so it is false for texts that have this mark.
    """
    model = model or load()
    Bpe(model)  # fails here rather than in a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model, True)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids, offsets, same, back = own.encode(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(offsets).astype(np.int32)), id_lists(ids, offsets, np.asarray(part.column("text").is_valid())), pa.array(same), pa.array(back)],
                    ["doc_id", "n_tokens", "ids", "library_equal", "decoded_equal"],
                )

    rows = docs.select(integer(docs, id_col).alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens int, ids array<int>, library_equal boolean, decoded_equal boolean")


def decode(tokens: DataFrame, ids_col: str = "ids", out_col: str = "text", model: bytes | None = None) -> DataFrame:
    """All columns and out_col, in place of one of that name: the text of ids. Null ids give null; bytes that aren't UTF-8 give U+FFFD; an id out of the vocabulary fails."""
    model = model or load()

    @F.arrow_udf("string")
    def text(lists: pa.Array) -> pa.Array:
        bpe = encoder(model).bpe
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        ids = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= bpe.size):
            raise ValueError("an id is not in the vocabulary")
        data, ends = bpe.raw(ids)
        at = ends[np.concatenate(([0], np.cumsum(counts)))].tolist()
        raw = data.tobytes()
        out = [raw[a:b].removeprefix(b" ").decode("utf-8", "replace") for a, b in zip(at, at[1:])]
        return pc.if_else(lists.is_valid(), pa.array(out, pa.string()), pa.scalar(None, pa.string()))

    return tokens.withColumn(out_col, text(f"`{ids_col}`"))
