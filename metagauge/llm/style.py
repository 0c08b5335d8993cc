"""Form of a text in numbers, from one vectorised pass over its bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import integer
from .textcore import WHITE, Words, flat, mix, slices

#: Every share is of words but for symbols, capitals and digits (of characters, of ASCII letters, of characters) and lines.
NAMES = ("n_words", "word_chars", "symbols", "capitals", "digits", "bare_words", "stop_words", "same_as_last", "repeated_grams", "repeated_lines")
GRAM = 5

_STOP = (
    "the of and to in is that it for was on are as with be by at this from or an not but a la le de les des et un une du en que qui dans est pour pas sur au par "
    "avec se der die das und ist in den von zu mit sich auf für im dem ein eine nicht als auch el los las y por con su para una del al es"
).split()
_letters = np.zeros(256, bool)
_letters[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_capital = np.zeros(256, bool)
_capital[65:91] = True
_ascii = np.zeros(256, bool)
_ascii[[*range(65, 91), *range(97, 123)]] = True
_digit = np.zeros(256, bool)
_digit[48:58] = True
_symbol = np.zeros(256, bool)
_symbol[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = True
_LINE = np.zeros(256, bool)
_LINE[[10, 13]] = True


def _stop_hashes() -> np.ndarray:
    return np.sort(Words.of(pa.array([" ".join(sorted(set(_STOP)))]), fold=True).hash)


_stops: list[np.ndarray] = []


def _sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[at]


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of each text's flags are set."""
    out = np.zeros(len(offsets) - 1)
    some = np.flatnonzero(np.diff(offsets))
    if len(some):
        out[some] = np.add.reduceat(flags, offsets[some], dtype=np.int64)
    return out


def _repeats(doc: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """For each text, how many of its values occurred in it before."""
    if not len(hashes):
        return np.zeros(n)
    own = np.sort(mix(hashes + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20) | (doc.astype(np.uint64) << np.uint64(44)))
    again = own[1:] == own[:-1]
    return np.bincount((own[1:][again] >> np.uint64(44)).astype(np.int64), minlength=n).astype(float)


Grams = tuple[np.ndarray, np.ndarray]


def grams(words: Words) -> Grams:
    """Words at which runs of GRAM words begin, and the runs' hashes."""
    at = words.fits(GRAM)
    return at, words.windows(at, GRAM, words.sums()) if len(at) else np.zeros(0, np.uint64)


def families(words: Words, runs: Grams) -> np.ndarray:
    """The least hash of a text's runs of GRAM words, which copies share and near copies mostly do; of all words where there are fewer, 0 without words."""
    at, hashes = runs
    out = np.zeros(words.n, np.uint64)
    if len(at):
        begin = np.flatnonzero(np.concatenate(([True], words.doc[at[1:]] != words.doc[at[:-1]])))
        out[words.doc[at[begin]]] = np.minimum.reduceat(hashes, begin)
    short = np.flatnonzero((words.counts > 0) & (words.counts < GRAM))
    out[short] = words.windows(words.first[short], words.counts[short], words.sums())
    return out.view(np.int64)


def measure(texts: pa.Array) -> np.ndarray:
    """Texts x NAMES; a null or empty text is all 0."""
    data, offsets = flat(texts)
    words = Words(data, offsets, fold=True)
    return measures(words, grams(words))


def measures(words: Words, runs: Grams) -> np.ndarray:
    """measure() of texts whose words are folded."""
    data, offsets, n = words.data, words.offsets, words.n
    if not _stops:
        _stops.append(_stop_hashes())
    count = words.counts.astype(float)
    some = np.maximum(count, 1)
    of = lambda table: _per_text(table[data], offsets)
    chars = _per_text((data & 0xC0) != 0x80, offsets)
    solid = np.maximum(chars - of(WHITE), 1)
    bare = np.add.reduceat(_letters[data], words.start, dtype=np.int32) == 0 if len(words.start) else np.zeros(0, bool)  # white space has no letters
    stops = _stops[0]
    near = np.minimum(np.searchsorted(stops, words.hash), len(stops) - 1)
    stop = stops[near] == words.hash
    same = np.zeros(len(words.hash), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    lines = Words(data, offsets, white=_LINE)
    per = lambda flags: np.diff(_sums(flags, words.first)) / some
    return np.stack([
        count, np.where(count > 0, solid / some, 0), of(_symbol) / solid, of(_capital) / np.maximum(of(_ascii), 1), of(_digit) / solid, per(bare), per(stop), per(same),
        _repeats(words.doc[runs[0]], runs[1], n) / np.maximum(count - GRAM + 1, 1), _repeats(lines.doc, lines.hash, n) / np.maximum(lines.counts, 1),
    ]).T


def table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), family: bool = False) -> DataFrame:
    """doc_id, family if asked for, the columns of keep as strings k0, k1 ..., and NAMES, for each row."""
    kept = [f"k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words.of(part.column("text"), fold=True)
                runs = grams(words)
                x = measures(words, runs)
                own = [pa.array(families(words, runs))] if family else []
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *own, *(part.column(k) for k in kept), *(pa.array(np.ascontiguousarray(c)) for c in x.T)], ["doc_id", *["family"] * family, *kept, *NAMES])

    rows = docs.select(integer(docs, id_col).alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), *[F.col(f"`{c}`").cast("string").alias(k) for c, k in zip(keep, kept)])
    return rows.mapInArrow(run, "doc_id long, " + "family long, " * family + "".join(f"{k} string, " for k in kept) + ", ".join(f"{c} double" for c in NAMES))
