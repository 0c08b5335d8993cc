"""Tokens of texts, their attributes and frequencies."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metagauge.functions.expr import col

STOP_WORDS = frozenset("a about after all an and are as at be been but by for from had has have he her his i if in into is it its me my no not of on or our she so that the their them there they this to up was we were what when which who will with you your".split())


def words(c: Column) -> Column:
    """array<string>: runs of word characters and single other signs."""
    return F.regexp_extract_all(c, F.lit(r"(?U)\w+|[^\w\s]"), F.lit(0))


def whitespace_tokens(c: Column) -> Column:
    """array<string>: pieces between single spaces; an empty piece is a space, but not at the end."""
    pieces = F.transform(F.split(c, " ", -1), lambda x: F.when(x == "", F.lit(" ")).otherwise(x))
    return F.when(F.element_at(pieces, -1) == " ", F.slice(pieces, F.lit(1), F.size(pieces) - 1)).otherwise(pieces)


def whitespace_flags(c: Column) -> Column:
    """array<boolean>: whether a space follows each of whitespace_tokens."""
    tokens = whitespace_tokens(c)
    ends = F.element_at(F.split(c, " ", -1), -1) == ""
    return F.transform(tokens, lambda x, i: (x != " ") & (ends | (i < F.size(tokens) - 1)))


def join_words(tokens: Column, flags: Column) -> Column:
    """The text of words and of flags for a space after each."""
    return F.array_join(F.zip_with(tokens, flags, lambda w, s: F.concat(w, F.when(s, " ").otherwise(""))), "")


def special_cases(tokens: Column, cases: Mapping[str, Iterable[str]]) -> Column:
    """Tokens with those that are cases replaced by their parts."""

    def parts(x: Column) -> Column:
        out = F.array(x)
        for word, own in cases.items():
            out = F.when(x == word, F.array(*map(F.lit, own))).otherwise(out)
        return out

    return F.flatten(F.transform(tokens, parts))


def shape(token: Column) -> Column:
    """X for capitals, x for other letters, d for digits, runs cut to 4."""
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(token, r"\p{Lu}", "X"), r"[\p{L}&&[^X]]", "x"), r"\p{Nd}", "d")
    return F.regexp_replace(s, r"(X{4}|x{4}|d{4})(?:(?<=X)X+|(?<=x)x+|(?<=d)d+)", "$1")


def token_attributes(df: DataFrame, text_col: str = "text", keep: Iterable[str] = (), stop_words: Iterable[str] = STOP_WORDS) -> DataFrame:
    """(keep ..., i, text, shape, is_alpha, is_stop) of each token. Lemmas, tags and dependencies need a model: see annotate()."""
    rows = df.select(*[col(k) for k in keep], F.posexplode(words(col(text_col).cast("string"))).alias("i", "text"))
    return rows.select(*[col(k) for k in keep], "i", "text", shape(F.col("text")).alias("shape"), F.col("text").rlike(r"^\p{L}+$").alias("is_alpha"), F.lower("text").isin(*sorted(stop_words)).alias("is_stop"))


def annotate(df: DataFrame, model, schema: str, text_col: str = "text", out_col: str = "annotations") -> DataFrame:
    """out_col: what model(Series of texts) gives, lists of the structs in schema ("lemma string, pos string" ...); run in Arrow batches."""

    @F.pandas_udf(f"array<struct<{re.sub(r'(\w+) ', r'\1:', schema).replace(': ', ':')}>>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(list(model(texts.fillna(""))), index=texts.index)

    return df.withColumn(out_col, run(col(text_col).cast("string")))


def word_frequencies(df: DataFrame, text_col: str = "text", top: int | None = None, stop_words: Iterable[str] = (), fold: bool = True) -> DataFrame:
    """(word, n), most frequent first, ties by word. Counted with map-side combine; no text is gathered anywhere."""
    text = col(text_col).cast("string")
    rows = df.select(F.explode(F.regexp_extract_all(F.lower(text) if fold else text, F.lit(r"(?U)\w[\w']+"), F.lit(0))).alias("word"))
    stops = sorted(stop_words)
    rows = rows.where(~F.col("word").isin(*stops)) if stops else rows
    counts = rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word")
    return counts.limit(top) if top is not None else counts


@dataclass(frozen=True)
class RuleTokenizer:
    """Pieces between white space, from which prefixes and suffixes are peeled and which infixes split.

    A piece that is a special case, or matches url, is left whole, at the start and whenever something was peeled.
    """

    prefix: str | None = r"""[\[("']"""
    suffix: str | None = None
    infix: str | None = r"[-~]"
    url: str | None = r"https?://"
    cases: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: {":)": (":)",)})

    def with_suffixes(self, *more: str) -> RuleTokenizer:
        return RuleTokenizer(self.prefix, "|".join(f"(?:{s})" for s in ([self.suffix] if self.suffix else []) + list(more)), self.infix, self.url, self.cases)

    def without_suffix(self, gone: str) -> RuleTokenizer:
        left = [s for s in re.findall(r"\(\?:(.*?)\)(?=\||$)", self.suffix or "") if s != gone]
        return RuleTokenizer(self.prefix, "|".join(f"(?:{s})" for s in left) or None, self.infix, self.url, self.cases)

    def with_infix(self, infix: str | None) -> RuleTokenizer:
        return RuleTokenizer(self.prefix, self.suffix, infix, self.url, self.cases)

    def pieces(self) -> Callable[[str], list[tuple[str, str]]]:
        """A function from a piece without white space to its (rule, token) pairs."""
        compiled = lambda p, form: re.compile(form.format(p)) if p else None
        prefix, suffix, infix, url = compiled(self.prefix, "^(?:{})"), compiled(self.suffix, "(?:{})$"), compiled(self.infix, "{}"), compiled(self.url, "^(?:{})")
        cases = {k: [(f"SPECIAL-{i}", t) for i, t in enumerate(v, 1)] for k, v in self.cases.items()}

        def split(piece: str) -> list[tuple[str, str]]:
            out: list[tuple[str, str]] = []
            ends: list[tuple[str, str]] = []
            while piece:
                if piece in cases:
                    out += cases[piece]
                    piece = ""
                elif url and url.match(piece):
                    out.append(("URL_MATCH", piece))
                    piece = ""
                elif prefix and (m := prefix.match(piece)) and m.end():
                    out.append(("PREFIX", m[0]))
                    piece = piece[m.end() :]
                elif suffix and (m := suffix.search(piece)) and m.start() < len(piece):
                    ends.append(("SUFFIX", m[0]))
                    piece = piece[: m.start()]
                else:
                    at = 0
                    for m in infix.finditer(piece) if infix else ():
                        if m.end() == m.start():
                            continue
                        if m.start() > at:
                            out.append(("TOKEN", piece[at : m.start()]))
                        out.append(("INFIX", m[0]))
                        at = m.end()
                    if at < len(piece):
                        out.append(("TOKEN", piece[at:]))
                    piece = ""
            return out + ends[::-1]

        return split

    def explain(self, text: str) -> list[tuple[str, str]]:
        """(rule, token) pairs in order."""
        split = self.pieces()
        return [pair for piece in text.split() for pair in split(piece)]


#: Splits on signs between letters and digits but leaves hyphens inside words.
KEEP_HYPHENS = r"(?<=\d)[+\-*^](?=[\d-])|(?<=[a-z\"'])\.(?=[A-Z\"'])|(?<=[^\W\d_]),(?=[^\W\d_])|(?<=[^\W_])[:<>=/](?=[^\W\d_])|\.\.+|…"


#: Bytes of texts that are split at a time, and pieces that a task remembers and their MB with their rows: for memory; results don't depend on them.
_SLICE, _KNOWN, _KNOWN_MB = 1_000_000, 200_000, 16


class _Pieces:
    """Splits each distinct piece once and puts lists together by gathering from a pool. split gives a piece's rows, tuples of strings."""

    def __init__(self, split: Callable[[str], list[tuple[str, ...]]], fields: tuple[str, ...]):
        self.split, self.fields = split, fields
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.signs = 0
        self.start, self.arrays = np.zeros(1, np.int64), [pa.array([], pa.string()) for _ in self.fields]

    def lists(self, pieces: list[list[str] | None]) -> pa.Array:
        """For each list of pieces the rows of all of them; null for None."""
        if len(self.known) > _KNOWN or self.signs + sum(a.nbytes for a in self.arrays) > _KNOWN_MB * 1e6:
            self.clear()
        flat = pa.array([x for own in pieces if own for x in own], pa.string()).dictionary_encode()
        distinct = flat.dictionary.to_pylist()
        if missing := [x for x in distinct if x not in self.known]:
            pool: list[tuple[str, ...]] = []
            more = []
            for x in missing:
                self.known[x] = len(self.known)
                pool += self.split(x)
                more.append(len(pool))
            self.signs += sum(map(len, missing))
            self.start = np.concatenate((self.start, self.start[-1] + np.array(more)))
            self.arrays = [pa.concat_arrays([a, pa.array([r[i] for r in pool], pa.string())]) for i, a in enumerate(self.arrays)]
        start, which = self.start, np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[flat.indices.to_numpy()]
        sizes = np.diff(start)[which]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        rows = pa.array(np.repeat(start[which] - ends[:-1], sizes) + np.arange(ends[-1]))
        values = [a.take(rows) for a in self.arrays]
        counts = np.fromiter((len(own or ()) for own in pieces), np.int64, len(pieces))
        offsets = ends[np.concatenate(([0], np.cumsum(counts)))].astype(np.int32)
        null = np.fromiter((own is None for own in pieces), bool, len(pieces))
        return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(values, list(self.fields)) if len(self.fields) > 1 else values[0], mask=pa.array(null) if null.any() else None)


def _ends(values: pa.Array) -> np.ndarray:
    """Bytes of strings, or of lists of strings, up to the end of each value."""
    if pa.types.is_list(values.type) or pa.types.is_large_list(values.type):
        inner = np.concatenate(([0], _ends(values.flatten())))
        return inner[np.cumsum(pc.list_value_length(values).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)]
    return np.cumsum(pc.binary_length(values).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)


def _slices(batches: Iterator[pa.Array]) -> Iterator[list]:
    """Values of Arrow arrays, some bytes at a time; a value that has more stands alone."""
    for values in batches:
        ends, at = _ends(values), 0
        while at < len(values):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _SLICE, "right")))
            yield values.slice(at, to - at).to_pylist()
            at = to


def rule_tokens(df: DataFrame, tokenizer: RuleTokenizer, text_col: str = "text", out_col: str = "tokens") -> DataFrame:
    """out_col: array of (rule, token) of each text; null for null. Arrow batches are read and returned a slice at a time, so a worker's memory follows neither their rows nor the table."""

    @F.arrow_udf("array<struct<rule:string,token:string>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = _Pieces(tokenizer.pieces(), ("rule", "token"))
        for part in _slices(batches):
            yield own.lists([None if t is None else t.split() for t in part])

    return df.withColumn(out_col, run(col(text_col).cast("string")))


def wordpieces(df: DataFrame, vocabulary: Iterable[str], text_col: str = "text", out_col: str = "pieces", unknown: str = "[UNK]", fold: bool = True) -> DataFrame:
    """out_col: greedy longest-match pieces of each word, with ## inside words."""
    known = frozenset(vocabulary)
    longest = max(map(len, known), default=0)

    def split(word: str) -> list[tuple[str]]:
        out, at = [], 0
        while at < len(word):
            for to in range(min(len(word), at + longest), at, -1):
                piece = ("##" if at else "") + word[at:to]
                if piece in known:
                    out.append((piece,))
                    at = to
                    break
            else:
                return [(unknown,)]
        return out

    @F.arrow_udf("array<string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = _Pieces(split, ("piece",))
        for part in _slices(batches):
            yield own.lists(part)

    text = col(text_col).cast("string")
    return df.withColumn(out_col, run(words(F.lower(text) if fold else text)))
