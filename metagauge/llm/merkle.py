"""Merkle trees over paragraphs and sections.

Leaves are paragraphs (lines that aren't blank), stripped of white space at the
ends; a section runs up to a blank line or up to a line that begins with ``#``.
A leaf's digest is SHA-256 of "p" and the paragraph, a section's of "s" and its
leaves' digests, the root's of "d" and the sections' digests. So equal roots
mean equal texts but for blank lines' number and spaces at line ends, and
where roots differ, differing sections and in them differing leaves tell where.

All of it is native column expressions; nothing is shuffled for the trees.

Defined results: a null text has a null tree; an empty one has no sections and
the root of none. Rows that repeat are equal. doc_ids are integers (ValueError
otherwise); of equal texts the null ones are named by another's. Extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import integer
from .scratch import written

_EDGE = r"^[ \t\r\x0b\f]+|[ \t\r\x0b\f]+$"


def sections(text: Column) -> Column:
    """array<array<string>>: the paragraphs of each section."""
    lines = F.transform(F.split(text, "\n", -1), lambda x: F.regexp_replace(x, _EDGE, ""))
    marked = F.transform(lines, lambda x: F.when(x.startswith("#"), F.concat(F.lit("\n\n"), x)).otherwise(x))
    blocks = F.split(F.array_join(marked, "\n"), "\n\n+", -1)
    paragraphs = F.transform(blocks, lambda b: F.filter(F.split(b, "\n", -1), lambda x: x != ""))
    return F.filter(paragraphs, lambda s: F.size(s) > 0)


def leaves(paragraphs: Column) -> Column:
    return F.transform(paragraphs, lambda s: F.transform(s, lambda p: F.sha2(F.concat(F.lit("p"), p), 256)))


def tree(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, root, sections, leaves): hex digests; leaves is a list for each section."""
    rows = docs.select(integer(docs, id_col).alias("doc_id"), leaves(sections(F.col(f"`{text_col}`"))).alias("leaves"))
    rows = rows.withColumn("sections", F.transform("leaves", lambda s: F.sha2(F.concat(F.lit("s"), F.array_join(s, "")), 256)))
    return rows.select("doc_id", F.sha2(F.concat(F.lit("d"), F.array_join("sections", "")), 256).alias("root"), "sections", "leaves")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The tree of each row, and equal_to: the least doc_id with this root (its own where there is no other; null for null text).

    Trees are made once and written. Of them roots and ids alone are aggregated, with map-side combine; roots of several rows
    are joined back, which shuffles each tree once. Both sides of that join are tables, so that adaptive
    execution may split a root of very many rows; null roots stay out of it.
    """
    rows = written(tree(docs, id_col, text_col), "merkle-trees")
    same = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("root", "least")
    same = written(same, "merkle-equal").hint("merge")  # never broadcast, as its size has no bound
    whole = rows.where("root is not null").join(same, "root", "left").withColumn("equal_to", F.coalesce("least", "doc_id"))
    out = whole.select(*rows.columns, "equal_to").union(rows.where("root is null").withColumn("equal_to", F.lit(None).cast("long")))
    return out.select("doc_id", "root", F.size("sections").alias("n_sections"), F.when(F.col("leaves").isNotNull(), F.size(F.flatten("leaves"))).alias("n_paragraphs"), "sections", "leaves", "equal_to")


def differences(old: DataFrame, new: DataFrame, on: str = "doc_id") -> DataFrame:
    """(doc_id, change, section, paragraph): where trees of two versions differ.

    old and new have ``on``, root, sections and leaves, and one row for each document. change is added or
    removed for a document that only one has, else edited with a row for each place: a differing section,
    by its place in new, and in it each differing paragraph; sections are compared place by place after
    the equal ones at the start and at the end are set aside, paragraphs likewise, and equal ones between are left out. Equal
    roots give no rows, and their branches aren't looked at.
    """
    a = old.select(F.col(on).alias("doc_id"), *[F.col(c).alias(f"old_{c}") for c in ("root", "sections", "leaves")], F.lit(True).alias("in_old"))
    b = new.select(F.col(on).alias("doc_id"), *[F.col(c).alias(f"new_{c}") for c in ("root", "sections", "leaves")], F.lit(True).alias("in_new"))
    both = a.join(b, "doc_id", "full").where(F.col("in_old").isNull() | F.col("in_new").isNull() | ~F.col("old_root").eqNullSafe(F.col("new_root")))
    change = F.when(F.col("in_old").isNull(), "added").when(F.col("in_new").isNull(), "removed").otherwise("edited").alias("change")
    rows = both.select("doc_id", change, "old_sections", "new_sections", "old_leaves", "new_leaves")
    whole = rows.where("change != 'edited'").select("doc_id", "change", F.lit(None).cast("int").alias("section"), F.lit(None).cast("int").alias("paragraph"))
    edited = _spread(rows.where("change = 'edited'").select("doc_id", "change", "old_leaves", "new_leaves", F.explode(_places("old_sections", "new_sections")).alias("p")), "section")
    inner = edited.withColumn("o", F.coalesce(F.get("old_leaves", F.col("p.o")), F.array().cast("array<string>"))).withColumn("n", F.coalesce(F.get("new_leaves", F.col("p.n")), F.array().cast("array<string>")))
    inner = inner.select("doc_id", "change", "section", F.explode(_places("o", "n")).alias("p"))
    return whole.union(_spread(inner, "paragraph").select("doc_id", "change", "section", "paragraph"))


def _spread(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.coalesce("p.n", "p.o").cast("int"))


def _places(old: str, new: str) -> Column:
    """array<struct<o, n>>: places of the middles of two lists, from 0; null where a side has none."""
    o, n = (F.coalesce(F.col(c), F.array().cast("array<string>")) for c in (old, new))
    least = F.least(F.size(o), F.size(n))

    def run(a: Column, b: Column, most: Column) -> Column:
        """How many values agree from the start on."""
        return F.aggregate(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda s, q: F.struct(F.when(s["on"] & q, s["n"] + 1).otherwise(s["n"]).alias("n"), (s["on"] & q).alias("on")), lambda s: F.least(s["n"], most))

    head = run(o, n, least)
    tail = run(F.reverse(o), F.reverse(n), least - head)
    more = F.greatest(F.size(o), F.size(n)) - head - tail
    i = F.when(more > 0, F.sequence(F.lit(0), more - 1)).otherwise(F.array().cast("array<int>"))
    places = F.transform(i, lambda k: F.struct(F.when(head + k < F.size(o) - tail, head + k).alias("o"), F.when(head + k < F.size(n) - tail, head + k).alias("n")))
    return F.filter(places, lambda p: ~F.get(o, p["o"]).eqNullSafe(F.get(n, p["n"])))


def _tree_sql(name: str, text: str) -> str:
    """CTEs that end in name (doc_id, root, sections, leaves)."""
    return rf"""{name}_lines as (
  select doc_id, list_transform(string_split({text}, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(11) || chr(12))) as l from documents
), {name}_blocks as (
  select doc_id, regexp_split_to_array(array_to_string(list_transform(l, lambda x: case when starts_with(x, '#') then chr(10) || chr(10) || x else x end), chr(10)), '\n\n+') as b from {name}_lines
), {name}_parts as (
  select doc_id, list_filter(list_transform(b, lambda y: list_filter(string_split(y, chr(10)), lambda x: x <> '')), lambda s: len(s) > 0) as s from {name}_blocks
), {name}_leaf as (
  select doc_id, list_transform(s, lambda y: list_transform(y, lambda p: sha256('p' || p))) as leaves from {name}_parts
), {name}_sect as (
  select doc_id, leaves, list_transform(leaves, lambda y: sha256('s' || array_to_string(y, ''))) as sections from {name}_leaf
), {name} as (
  select doc_id, sha256('d' || array_to_string(sections, '')) as root, sections, leaves from {name}_sect
)"""


SQL = f"""
with {_tree_sql("tree", "text")}
select doc_id, root, cast(len(sections) as integer) as n_sections, cast(len(flatten(leaves)) as integer) as n_paragraphs, sections, leaves,
  case when root is not null then min(doc_id) over (partition by root) end as equal_to
from tree
"""


def edited(docs: DataFrame) -> DataFrame:
    """docs of integers doc_id with words in their texts replaced: a second version to compare with."""
    return docs.select("doc_id", F.replace("text", F.lit(" the "), F.lit(" THE ")).alias("text"))


#: Edits of edited(), which neither add nor remove paragraphs, place by place.
EDITS_SQL = f"""
with {_tree_sql("old", "text")}, {_tree_sql("new", "replace(text, ' the ', ' THE ')")},
s as (select doc_id, unnest(range(len(old.leaves))) as i, old.leaves as a, new.leaves as b from old join new using (doc_id) where old.root <> new.root),
p as (select doc_id, i, unnest(range(len(a[i + 1]))) as j, a, b from s)
select doc_id, 'edited' as change, cast(i as integer) as section, cast(j as integer) as paragraph from p where a[i + 1][j + 1] <> b[i + 1][j + 1]
"""
