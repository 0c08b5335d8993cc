"""Personal data in texts: spans, counts and redaction.

Pattern recognizers run as native expressions; a recognizer that needs a model
is a function from a Series of texts to a Series of lists of spans, run in
Arrow batches. Offsets are code points.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metagauge.functions.expr import col

SPAN = "entity string, score double, start int, end int, matched_text string"
SPANS = f"array<struct<{SPAN.replace(' ', ':').replace(',:', ',')}>>"


@dataclass(frozen=True)
class Recognizer:
    """A pattern in Java's syntax and the entity and score that its matches get."""

    entity: str
    pattern: str
    score: float = 0.9
    ignore_case: bool = False

    @property
    def regex(self) -> str:
        return ("(?Ui)" if self.ignore_case else "(?U)") + self.pattern


@dataclass(frozen=True)
class ModelRecognizer:
    """A model behind ``spans(texts) -> lists of (entity, start, end)``; others than its entities are dropped."""

    spans: Callable[[pd.Series], Iterable[Iterable[tuple[str, int, int]]]]
    entities: tuple[str, ...] = ("PERSON", "ORG", "GPE")
    score: float = 0.65


_FOUR = r"\d{4}"
AADHAAR = Recognizer("AADHAAR_NUMBER", rf"\b{_FOUR}(?:[\s-]?{_FOUR}){{2}}\b")
PAN = Recognizer("PAN_CARD", r"\b[A-Z]{5}[0-9]{4}[A-Z]\b")
PHONE = Recognizer("INDIAN_PHONE_NUMBER", r"\b[6-9]\d{9}\b")
DEFAULT = (AADHAAR, PAN, PHONE)


def gazetteer(names: dict[str, str]) -> ModelRecognizer:
    """A stand-in for a model: exact names and their entities, found in order of place."""
    import re

    pattern = re.compile("|".join(rf"\b{re.escape(n)}\b" for n in sorted(names, key=len, reverse=True)) or r"(?!)")
    return ModelRecognizer(lambda s: s.map(lambda t: [(names[m[0]], m.start(), m.end()) for m in pattern.finditer(t)]), tuple(sorted(set(names.values()))))


def match_spans(text: Column, r: Recognizer) -> Column:
    """array<struct>: the recognizer's matches in order of place, by one left-to-right pass over gaps and matches."""
    pattern = F.lit(r.regex)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.transform(F.split(text, r.regex, -1), lambda g: F.length(g))
    pieces = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(matches)).alias("gap"), matches.alias("m"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def step(acc: Column, piece: Column) -> Column:
        start = acc["at"] + piece["gap"]
        end = start + F.length(piece["m"])
        span = F.struct(F.lit(r.entity).alias("entity"), F.lit(r.score).cast("double").alias("score"), start.cast("int").alias("start"), end.cast("int").alias("end"), piece["m"].alias("matched_text"))
        return F.struct(end.cast("int").alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    return F.when(F.size(matches) > 0, F.aggregate(pieces, empty, step, lambda acc: acc["spans"])).otherwise(F.array().cast(SPANS))


def _chosen(recognizers: Iterable[Recognizer | ModelRecognizer], entities: Iterable[str] | None) -> list:
    """Recognizers that can find one of the entities: others don't run."""
    wanted = None if entities is None else set(entities)
    return [r for r in recognizers if wanted is None or wanted & ({r.entity} if isinstance(r, Recognizer) else set(r.entities))]


def _model(r: ModelRecognizer, keep: set[str]) -> Callable[[Column], Column]:
    """struct<spans, error>. If the model fails on a batch, its texts are tried one by one, and a text on which it fails has no spans but an error."""

    def found(text: str, own: Iterable[tuple[str, int, int]]) -> list[dict]:
        return [{"entity": e, "score": r.score, "start": a, "end": b, "matched_text": text[a:b]} for e, a, b in own if e in keep]

    def one(text: str) -> tuple[list[dict], str | None]:
        try:
            return found(text, next(iter(r.spans(pd.Series([text]))))), None
        except Exception as e:  # a text's failure is its result
            return [], f"{type(e).__name__}: {e}"

    @F.pandas_udf(f"struct<spans:{SPANS},error:string>")
    def model(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            plain = texts.fillna("")
            try:
                rows = [(found(t, own), None) for t, own in zip(plain, r.spans(plain), strict=True)]
            except Exception:
                rows = [one(t) for t in plain]
            yield pd.DataFrame(rows, columns=["spans", "error"], index=texts.index)

    return model


def spans(
    df: DataFrame, text_col: str = "text", recognizers: Iterable[Recognizer | ModelRecognizer] = DEFAULT, entities: Iterable[str] | None = None, out_col: str = "spans", error_col: str | None = None
) -> DataFrame:
    """All columns and out_col: the spans of the text, by start, end and entity. A null text has none.

    Where a model fails on a text, its spans are missing and the others' stay; error_col, if given, says why (null where none failed).
    """
    wanted = None if entities is None else set(entities)
    text = col(text_col).cast("string")
    found: list[Column] = []
    models: list[str] = []
    for r in _chosen(recognizers, entities):
        if isinstance(r, Recognizer):
            found.append(match_spans(text, r))
        else:
            models.append(f"_model_{len(models)}_{out_col}")
            df = df.withColumn(models[-1], _model(r, set(r.entities) if wanted is None else wanted & set(r.entities))(text))
            found.append(col(models[-1])["spans"])
    every = F.concat(*[F.coalesce(f, F.array().cast(SPANS)) for f in found]) if found else F.array().cast(SPANS)
    order = F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["entity"].alias("entity"), s["score"].alias("score"), s["matched_text"].alias("matched_text")))
    back = F.transform(F.array_sort(order), lambda s: F.struct(s["entity"].alias("entity"), s["score"].alias("score"), s["start"].alias("start"), s["end"].alias("end"), s["matched_text"].alias("matched_text")))
    out = df.withColumn(out_col, back)
    if error_col:
        errors = F.array_compact(F.array(*[col(m)["error"] for m in models])) if models else F.array().cast("array<string>")
        out = out.withColumn(error_col, F.when(F.size(errors) > 0, F.array_join(errors, "; ")))
    return out.drop(*models)


def analyze(df: DataFrame, text_col: str = "text", recognizers: Iterable[Recognizer | ModelRecognizer] = DEFAULT, entities: Iterable[str] | None = None, keep: Iterable[str] = ()) -> DataFrame:
    """(keep ..., text, entity, score, start, end, matched_text): a row for each span of texts that aren't null. No spans, no rows."""
    rows = df.where(col(text_col).isNotNull()).select(*[col(k) for k in keep], col(text_col).cast("string").alias("text"))
    return spans(rows, "text", recognizers, entities, "_spans").select(*[col(k) for k in keep], "text", F.inline("_spans"))


def failures(df: DataFrame, text_col: str = "text", recognizers: Iterable[Recognizer | ModelRecognizer] = DEFAULT, entities: Iterable[str] | None = None, keep: Iterable[str] = ()) -> DataFrame:
    """(keep ..., text, error): texts on which a model fails, which analyze() gives the other recognizers' spans of."""
    rows = df.where(col(text_col).isNotNull()).select(*[col(k) for k in keep], col(text_col).cast("string").alias("text"))
    return spans(rows, "text", recognizers, entities, "_spans", "error").where("error is not null").drop("_spans")


def entity_counts(found: DataFrame) -> DataFrame:
    """(entity, count), most frequent first, ties by entity."""
    return found.groupBy("entity").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "entity")


def anonymize(df: DataFrame, text_col: str = "text", recognizers: Iterable[Recognizer | ModelRecognizer] = DEFAULT, entities: Iterable[str] | None = None, out_col: str = "anonymized") -> DataFrame:
    """All columns and out_col: the text with each span replaced by its entity in angle brackets.

    Of spans that overlap the first counts, and of those that start together the longest, then the one with the higher score.
    """
    text = col(text_col).cast("string")
    rows = spans(df, text_col, recognizers, entities, "_an_spans")
    order = F.array_sort(F.transform("_an_spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("less"), (-s["score"]).alias("worse"), s["entity"].alias("entity"))))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        done = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("<"), s["entity"], F.lit(">"))
        return F.when(s["start"] < acc["at"], acc).otherwise(F.struct(done.alias("out"), (-s["less"]).cast("int").alias("at")))

    folded = F.aggregate(order, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return rows.withColumn(out_col, F.when(F.size("_an_spans") > 0, folded).otherwise(text)).drop("_an_spans")
