"""Queries of the metadata operators and the SQL they are checked against."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metagauge.functions import expr
from metagauge.operators import kpi, links, mapping, pii, relational, text, transform
from metagauge.plans.inputs import CATALOGS, LETTERS, MAPPINGS, RESOURCES, derived, duck
from metagauge.sources import files
from metagauge.streaming import streams

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _resources(spark, sf_dir):
    return derived(spark, sf_dir, RESOURCES, "orders")


def _catalogs(spark, sf_dir):
    return derived(spark, sf_dir, CATALOGS, "customer")


def _mappings(spark, sf_dir):
    return derived(spark, sf_dir, MAPPINGS, "part")


def _letters(spark, sf_dir):
    return derived(spark, sf_dir, LETTERS, "customer")


# Indicators.

_NB = "coalesce(trim({0}) <> '', false)"
_nb = lambda c: _NB.format(f'"{c}"')
_int = lambda p: f"cast(coalesce({p}, false) as integer)"
_HTTP = "(starts_with({0}, 'http://') or starts_with({0}, 'https://'))"
_ASCII = "regexp_matches({0}, '[^\\x00-\\x7F]')"
_R_LINK = "(datafile is not null or datafile_url is not null)"
_R_WHOLE = f"{_nb('title')} and {_nb('file_format')} and {_R_LINK}"
_R_FLAGS = {
    "FieldCoverage": _R_WHOLE,
    "DCATCompliance": _R_WHOLE,
    "ControlledVocab": f"contains(file_format, '/') and {_nb('resource_category')}",
    "JurisdictionComplete": f"{_nb('govt_type')} and (lower(trim(govt_type)) <> 'state' or {_nb('state_department')})",
    "LegislationCoverage": "false",
    "DistributionIntegrity": f"{_nb('file_format')} and {_R_LINK}",
    "Multilingual": f"coalesce({_ASCII.format('title')}, false) or coalesce({_ASCII.format('note')}, false)",
    "Harvestability": "lower(trim(coalesce(external_api_reference, 'nan'))) not in ('', 'nan') or coalesce(contains(lower(file_format), 'json'), false)",
    "LinkValidity": _HTTP.format("coalesce(datafile_url, datafile)"),
    "DublinCoreCoverage": f"{_nb('title')} and {_nb('file_format')}",
    "SectorAccuracy": "lower(trim(coalesce(sector, 'nan'))) not in ('', 'all')",
}
_R_SQL = f"with r as ({duck(RESOURCES)}), f as (select title as ResourceTitle, {', '.join(f'{_int(_R_FLAGS[k])} as {k}' for k in kpi.RESOURCE_KPIS)} from r)"
_R_SUM = " + ".join(kpi.RESOURCE_KPIS)


@_query(f"{_R_SQL} select *, {_R_SUM} as TotalScore from f")
def kpi_resource_flags(spark, sf_dir):
    return kpi.resource_kpis(_resources(spark, sf_dir))


_C_FLAGS = {
    "FieldCoverage": " and ".join(_nb(c) for c in ("title", "body:value", "published_date", "field_ministry_department:name", "node_alias")),
    "ControlledVocab": " and ".join(_nb(c) for c in ("field_asset_jurisdiction:name", "field_ds_govt_type", "field_ministry_department:name", "field_sector:name")),
    "JurisdictionComplete": _nb("field_asset_jurisdiction:name"),
    "LegislationCoverage": "false",
    "Multilingual": f"coalesce({_ASCII.format('title')}, false) or coalesce({_ASCII.format('\"body:value\"')}, false)",
    "LinkValidity": "links_ok",
    "DublinCoreCoverage": " and ".join(_nb(c) for c in ("title", "body:value", "published_date", "field_ministry_department:name", "keywords")),
    "SectorAccuracy": "lower(trim(coalesce(\"field_sector:name\", 'nan'))) not in ('', 'all')",
}
_C_FLAGS["DCATCompliance"] = f"{_C_FLAGS['FieldCoverage']} and kid is not null"
_C_SQL = f"""
with r as ({duck(RESOURCES)}), c as ({duck(CATALOGS)}),
kids as (
  select catalog_title as kid, bool_and(coalesce({_HTTP.format('coalesce(datafile_url, datafile)')}, false)) as links_ok,
    arg_min({_R_LINK} and {_nb('file_format')}, ord) as first_valid, bool_or({_R_LINK} and {_nb('file_format')}) as any_valid
  from r group by 1
), f as (
  select title as CatalogTitle, {', '.join(f'{_int(_C_FLAGS[k])} as {k}' if k != 'DistributionIntegrity' else 'case when coalesce(first_valid, false) then null else 0 end as DistributionIntegrity' for k in kpi.CATALOG_KPIS)},
    {_int('any_valid')} as DistributionIntegrityAny
  from c left join kids on title = kid
)"""


@_query(f"{_C_SQL} select *, {' + '.join(f'coalesce({k}, 0)' for k in kpi.CATALOG_KPIS)} as TotalScore from f")
def kpi_catalog_flags(spark, sf_dir):
    return kpi.catalog_kpis(_catalogs(spark, sf_dir), _resources(spark, sf_dir))


@_query(f"{_C_SQL} select CatalogTitle, DistributionIntegrity, DistributionIntegrityAny from f")
def kpi_distribution_integrity_compat(spark, sf_dir):
    return kpi.catalog_kpis(_catalogs(spark, sf_dir), _resources(spark, sf_dir)).select("CatalogTitle", "DistributionIntegrity", "DistributionIntegrityAny")


def _summary_sql(level: str, names: Iterable[str]) -> str:
    return " union all ".join(f"select '{level}' as Type, '{k}' as KPI, cast(sum(coalesce({k}, 0)) as bigint) as Fulfilled, count(*) as Total, round_even(100.0 * sum(coalesce({k}, 0)) / count(*), 1)::double as Percent from f" for k in names)


@_query(f"{_R_SQL} {_summary_sql('Resource', kpi.RESOURCE_KPIS)}")
def kpi_fulfilment_summary(spark, sf_dir):
    return kpi.fulfilment_summary(kpi.resource_kpis(_resources(spark, sf_dir)), "Resource")


@_query(f"{_C_SQL} select 'Catalog' as Type, 'CatalogTitle' as KPI, 0::bigint as Fulfilled, count(*) as Total, 0.0::double as Percent from f union all {_summary_sql('Catalog', kpi.CATALOG_KPIS)}")
def kpi_catalog_summary(spark, sf_dir):
    return kpi.fulfilment_summary(kpi.catalog_kpis(_catalogs(spark, sf_dir), _resources(spark, sf_dir)), "Catalog")


@_query(f"{_R_SQL} select avg({_R_SUM}) as avg_score, count(*) as n from f")
def kpi_average_score(spark, sf_dir):
    return kpi.average_score(kpi.resource_kpis(_resources(spark, sf_dir)))


@_query(f"with r as ({duck(RESOURCES)}) select 100.0::double * count(*) filter (where title is not null and file_format is not null and govt_type is not null and resource_category is not null) / count(*) as pct from r")
def kpi_completeness(spark, sf_dir):
    return kpi.completeness(_resources(spark, sf_dir), ["title", "file_format", "govt_type", "resource_category"])


@_query(
    f"with r as ({duck(RESOURCES)}) select 'govt_type' as field, 100.0::double * count(*) filter (where trim(govt_type) in ('Central', 'State')) / count(*) as pct from r"
    " union all select 'resource_category', 100.0::double * count(*) filter (where trim(resource_category) = 'open') / count(*) from r union all select 'frequency', 0.0 union all select 'sector', null"
)
def kpi_vocab(spark, sf_dir):
    vocabularies = kpi.VOCABULARIES | {"resource_category": ("open",)}
    return kpi.vocabulary_compliance(_resources(spark, sf_dir), ["govt_type", "resource_category", "frequency", "sector", "govt_type"], vocabularies)


@_query("select o_orderstatus in ('O', 'F') as ok, count(*) as n from orders group by 1")
def in_vocabulary_counts(spark, sf_dir):
    return _table(spark, sf_dir, "orders").groupBy(expr.in_vocabulary(F.col("o_orderstatus"), ["O", "F"]).alias("ok")).agg(F.count(F.lit(1)).alias("n"))


@_query("select lang, cast(avg(cast(regexp_matches(text, '[^\\x00-\\x7F]') as integer)) as double) as share, count(*) as n from documents group by 1")
def multilingual(spark, sf_dir):
    return _table(spark, sf_dir, "documents").groupBy("lang").agg(F.avg(expr.flag(expr.non_ascii(F.col("text")))).alias("share"), F.count(F.lit(1)).alias("n"))


# Mapping.

_M = f"with m as ({duck(MAPPINGS)})"
_KIND = {"exact": "contains(lower(mapping_type), 'exact')", "partial": "regexp_matches(lower(mapping_type), 'partial|closest')", "unmapped": "regexp_matches(lower(mapping_type), 'no match|no direct')"}
_COUNTS = f"{_M}, k as (select level, {', '.join(f'count(*) filter (where {p}) as {k}' for k, p in _KIND.items())}, count(*) filter (where {' or '.join(_KIND.values())}) as total from m group by 1)"
_MISS = "(source_field is null or trim(source_field) = '')"
_PROPOSED = f"""{_M}, p as (
  select level, 'DCAT v3' as std, trim(dcat_field) as f, mapping_type, action from m where {_MISS} and trim(coalesce(dcat_field, '')) <> ''
  union all select level, 'Dublin Core', trim(dc_field), mapping_type, action from m where {_MISS} and trim(coalesce(dc_field, '')) <> ''
)"""
_LISTS = f"{_PROPOSED}, l as (select level, coalesce(list(distinct f) filter (where std = 'DCAT v3'), []) as dcat, coalesce(list(distinct f) filter (where std = 'Dublin Core'), []) as dublin from p group by 1)"


@_query(f"{_M} select * from m where mapping_type is not null")
def mapping_sheets(spark, sf_dir):
    """One sheet for each level with headings as workbooks have them, united to one table."""
    table = _mappings(spark, sf_dir)
    heads = {"source_field": "Equivalent own metadata", "dcat_field": "DCAT v3 mapping", "dc_field": "Dublin Core Element", "mapping_type": "Mapping Type", "action": "Action for own schema"}
    return mapping.sheets({x: table.where(F.col("level") == x).drop("level").withColumnsRenamed(heads) for x in mapping.LEVELS})


@_query(f"{_COUNTS} select * from k")
def mapping_counts(spark, sf_dir):
    return mapping.bucket_counts(_mappings(spark, sf_dir))


@_query(f"{_COUNTS} select level, {', '.join(f'case when total > 0 then 100.0::double * {k} / total else 0 end as {k}' for k in _KIND)} from k")
def mapping_coverage(spark, sf_dir):
    return mapping.coverage(mapping.bucket_counts(_mappings(spark, sf_dir)))


@_query(f'{_COUNTS} select level, (partial + 3 * unmapped)::double / greatest(total, 1) as "TES" from k')
def mapping_tes(spark, sf_dir):
    return mapping.effort_score(mapping.bucket_counts(_mappings(spark, sf_dir)))


@_query(f"{_M}, b as (select level, case when {_KIND['exact']} then 'exact' when {_KIND['partial']} then 'partial' when {_KIND['unmapped']} then 'unmapped' end as bucket, coalesce(trim(source_field), '(None)') as f from m) select level, bucket, f as field, count(*) as n from b where bucket is not null group by 1, 2, 3")
def mapping_buckets(spark, sf_dir):
    return mapping.bucketed_fields(_mappings(spark, sf_dir))


@_query(f"{_PROPOSED} select level as \"Metadata Level\", std as \"Standard\", f as \"Standard Field\", '(None)' as \"Source Equivalent\", trim(mapping_type) as \"Mapping Type\", coalesce(action, '') as \"Notes/Action\" from p")
def proposed_fields(spark, sf_dir):
    return mapping.proposed_fields(_mappings(spark, sf_dir))


@_query(f"{_LISTS} select level, list_sort(dcat) as dcat, list_sort(dublin) as dublin from l")
def proposed_lists(spark, sf_dir):
    return mapping.proposed_lists(mapping.proposed_fields(_mappings(spark, sf_dir)))


@_query(f'{_LISTS} select level, len(dcat)::bigint as "DCAT v3", len(dublin)::bigint as "Dublin Core" from l')
def proposed_counts(spark, sf_dir):
    return mapping.proposed_counts(mapping.proposed_lists(mapping.proposed_fields(_mappings(spark, sf_dir))))


@_query(f'{_LISTS} select level, len(list_intersect(dcat, dublin))::bigint as "Intersection", greatest(len(list_distinct(list_concat(dcat, dublin))), 1)::bigint as "Union", len(list_intersect(dcat, dublin))::double / greatest(len(list_distinct(list_concat(dcat, dublin))), 1) as "Jaccard" from l')
def jaccard(spark, sf_dir):
    return mapping.overlap(mapping.proposed_lists(mapping.proposed_fields(_mappings(spark, sf_dir))))


@_query(f"{_M}, d as (select level, source_field, count(*) as n from m where not {_MISS} group by 1, 2 having count(*) > 1) select level, cast(sum(n) as bigint) as rows, count(*) as fields from d group by 1")
def dup_stats(spark, sf_dir):
    return mapping.duplicates(_mappings(spark, sf_dir))


# Projections.


@_query(f'with r as ({duck(RESOURCES)}) select datafile as "dcat:downloadURL", datafile_url as "dcat:endpointURL", file_format as "dcat:mediaType", cast(null as varchar) as "dcat:ByteSize", cast(null as varchar) as "dcat:endpointDescription", cast(null as varchar) as "dcat:landingpage", cast(null as varchar) as "dcterms:title" from r')
def to_dcat(spark, sf_dir):
    return transform.to_dcat(_resources(spark, sf_dir))


@_query('select cast(page_id as varchar) as "Title", url as "Relation [datafile_url]", cast(null as varchar) as "Relation [datafile]", \'text/html\' as "Format/Media Size", cast(length(html) as varchar) as "Extent" from pages')
def to_dublin_core(spark, sf_dir):
    rows = _table(spark, sf_dir, "pages").select(F.col("page_id").alias("title"), F.col("url").alias("datafile_url"), F.lit("text/html").alias("file_format"), F.length("html").alias("file_size"))
    return transform.to_dublin_core(rows)


# Personal data.

_PATTERNS = {"AADHAAR_NUMBER": r"\b\d{4}[ -]?\d{4}[ -]?\d{4}\b", "PAN_CARD": r"\b[A-Z]{5}[0-9]{4}[A-Z]\b", "INDIAN_PHONE_NUMBER": r"\b[6-9]\d{9}\b"}
_MATCHES = " union all ".join(f"select id, text, '{e}' as entity, unnest(regexp_extract_all(text, '{p}')) as m from t where text is not null" for e, p in _PATTERNS.items())
# Each match occurs once in its text there, so its place is that of its first occurrence.
_SPAN_SQL = f"with t as ({duck(LETTERS)}), x as ({_MATCHES}) select id, text, entity, 0.9::double as score, cast(instr(text, m) - 1 as integer) as start, cast(instr(text, m) - 1 + length(m) as integer) as \"end\", m as matched_text from x"


@_query(_SPAN_SQL)
def pii_spans(spark, sf_dir):
    return pii.analyze(_letters(spark, sf_dir), keep=["id"])


@_query(f"select entity, count(*) as count from ({_SPAN_SQL}) group by 1")
def pii_counts(spark, sf_dir):
    return pii.entity_counts(pii.analyze(_letters(spark, sf_dir)))


@_query(f"select id, start, \"end\" from ({_SPAN_SQL}) where entity = 'PAN_CARD'")
def pii_entity_filter(spark, sf_dir):
    return pii.analyze(_letters(spark, sf_dir), entities=["PAN_CARD"], keep=["id"]).select("id", "start", "end")


_REDACTED = "text"
for _e, _p in _PATTERNS.items():
    _REDACTED = f"regexp_replace({_REDACTED}, '{_p}', '<{_e}>', 'g')"


@_query(f"with t as ({duck(LETTERS)}) select id, {_REDACTED} as anonymized from t")
def pii_anonymize(spark, sf_dir):
    return pii.anonymize(_letters(spark, sf_dir)).select("id", "anonymized")


_EMAIL, _IP = r"[A-Za-z0-9._]+@[A-Za-z0-9-]+\.[a-z]+", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"


@_query(f"with x as (select doc_id, 'EMAIL' as entity, unnest(regexp_extract_all(text, '{_EMAIL}')) as matched_text from documents union all select doc_id, 'IP', unnest(regexp_extract_all(text, '{_IP}')) from documents) select doc_id, entity, matched_text from x")
def pii_documents(spark, sf_dir):
    own = [pii.Recognizer("EMAIL", _EMAIL), pii.Recognizer("IP", _IP)]
    return pii.analyze(_table(spark, sf_dir, "documents").select("doc_id", "text"), recognizers=own, keep=["doc_id"]).select("doc_id", "entity", "matched_text")


@_query("select n_nationkey as id, 'GPE' as entity, 0.65::double as score, 3 as start, cast(3 + length(n_name) as integer) as \"end\", n_name as matched_text from nation")
def pii_model_recognizer(spark, sf_dir):
    """A pluggable model; here a list of names stands in for one."""
    nations = _table(spark, sf_dir, "nation")
    names = {r.n_name: "GPE" for r in nations.select("n_name").collect()}  # a dimension of 25 rows
    rows = nations.select(F.col("n_nationkey").cast("int").alias("id"), F.concat(F.lit("in "), "n_name", F.lit(".")).alias("text"))
    return pii.analyze(rows, recognizers=[pii.gazetteer(names)], keep=["id"]).drop("text")


# Text.

_WS = "list_transform(string_split(text, ' '), lambda x: case when x = '' then ' ' else x end)"


@_query(f"with t as (select doc_id, {_WS} as w from documents) select doc_id, case when w[-1] = ' ' then w[:-2] else w end as tokens from t")
def ws_tokens(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", text.whitespace_tokens(F.col("text")).alias("tokens"))


@_query("select item_id, text from benchmark")
def doc_from_words(spark, sf_dir):
    rows = _table(spark, sf_dir, "benchmark").select("item_id", text.whitespace_tokens(F.col("text")).alias("w"), text.whitespace_flags(F.col("text")).alias("s"))
    return rows.select("item_id", text.join_words(F.col("w"), F.col("s")).alias("text"))


@_query("with w as (select unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_\\p{M}][\\p{L}\\p{N}_\\p{M}'']+')) as word from documents) select word, count(*) as n from w group by 1")
def word_freq(spark, sf_dir):
    return text.word_frequencies(_table(spark, sf_dir, "documents"))


@_query("with w as (select unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_\\p{M}][\\p{L}\\p{N}_\\p{M}'']+')) as word from documents) select word, count(*) as n from w group by 1 order by 2 desc, 1 limit 200")
def word_freq_topk(spark, sf_dir):
    return text.word_frequencies(_table(spark, sf_dir, "documents"), top=200)


_SHAPE = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '\p{{Lu}}', 'X', 'g'), '[\p{{Ll}}\p{{Lm}}\p{{Lo}}\p{{Lt}}]', 'x', 'g'), '\p{{Nd}}', 'd', 'g'), 'XXXX+', 'XXXX', 'g'), 'xxxx+', 'xxxx', 'g'), 'dddd+', 'dddd', 'g')"
_STOPS = ", ".join(f"'{w}'" for w in sorted(text.STOP_WORDS))


@_query(f"with t as (select item_id, regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_\\p{{M}}]+|[^\\p{{L}}\\p{{N}}_\\p{{M}}\\s]') as w from benchmark), x as (select item_id, unnest(range(len(w))) as i, unnest(w) as text from t) select item_id, i::integer as i, text, {_SHAPE.format('text')} as shape, regexp_matches(text, '^\\p{{L}}+$') as is_alpha, lower(text) in ({_STOPS}) as is_stop from x")
def token_attributes(spark, sf_dir):
    return text.token_attributes(_table(spark, sf_dir, "benchmark"), keep=["item_id"])


@_query("select item_id, flatten(list_transform(string_split(text, ' '), lambda x: case when x = 'the' then ['t', 'he'] else [x] end)) as tokens from benchmark")
def special_case_tokens(spark, sf_dir):
    return _table(spark, sf_dir, "benchmark").select("item_id", text.special_cases(F.split("text", " ", -1), {"the": ["t", "he"]}).alias("tokens"))


_WHITE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_ENDS = r"""[.,;!?)\]"'']"""
_PAIR = "{{'rule': {0}, 'token': {1}}}".format
_MANY = lambda c, rule: f"list_transform({c}, lambda y: {_PAIR(rule, 'y')})"
#: Of a piece the run of prefixes, and of what follows it a whole URL, a special case before suffixes, or what stands between infixes before suffixes.
_RULES_SQL = rf"""
with w as (
  select doc_id, list_filter(regexp_split_to_array(text, '{_WHITE}'), lambda x: x <> '') as pieces from documents
), p as (
  select doc_id, list_transform(pieces, lambda x: {{'pre': regexp_extract(x, '^[\[("'']*'), 'rest': regexp_replace(x, '^[\[("'']*', '')}}) as pieces from w
), t as (
  select doc_id, flatten(list_transform(pieces, lambda x: list_concat(
    {_MANY("regexp_extract_all(x.pre, '.')", "'PREFIX'")},
    case when regexp_matches(x.rest, '^https?://') then [{_PAIR("'URL_MATCH'", 'x.rest')}]
      when regexp_matches(x.rest, '^:\){_ENDS}*$') then list_concat([{_PAIR("'SPECIAL-1'", "':)'")}], {_MANY("regexp_extract_all(substr(x.rest, 3), '.')", "'SUFFIX'")})
      else list_concat({_MANY(f"regexp_extract_all(regexp_replace(x.rest, '{_ENDS}*$', ''), '[-~]|[^-~]+')", "case when y in ('-', '~') then 'INFIX' else 'TOKEN' end")}, {_MANY(f"regexp_extract_all(regexp_extract(x.rest, '{_ENDS}*$'), '.')", "'SUFFIX'")}) end
  ))) as t from p
)
select doc_id, list_transform(t, lambda x: x.rule) as rules, list_transform(t, lambda x: x.token) as tokens from t
"""


@_query(_RULES_SQL)
def rule_tokens(spark, sf_dir):
    rows = text.rule_tokens(_table(spark, sf_dir, "documents").select("doc_id", "text"), text.RuleTokenizer().with_suffixes(r"[.,;!?]", r"[)\]\"']"), out_col="t")
    return rows.select("doc_id", F.col("t.rule").alias("rules"), F.col("t.token").alias("tokens"))


@_query("with w as (select item_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_\\p{M}]+|[^\\p{L}\\p{N}_\\p{M}\\s]')) as w from benchmark) select item_id, w as word, case when w in ('the', 'of', 'and') then w else '[UNK]' end as piece, count(*) as n from w group by all")
def wordpiece_counts(spark, sf_dir):
    """With a vocabulary of three words."""
    rows = _table(spark, sf_dir, "benchmark").select("item_id", F.explode(text.words(F.lower("text"))).alias("word"))
    return text.wordpieces(rows, ["the", "of", "and"], "word").groupBy("item_id", "word", F.col("pieces")[0].alias("piece")).agg(F.count(F.lit(1)).alias("n"))


@_query("select item_id, [length(text)] as lengths, ['chars'] as labels from benchmark")
def annotations(spark, sf_dir):
    """With a model that gives each text one annotation, its length."""
    rows = text.annotate(_table(spark, sf_dir, "benchmark"), lambda texts: ([{"n": len(t), "label": "chars"}] for t in texts), "n bigint, label string")
    return rows.select("item_id", F.col("annotations.n").alias("lengths"), F.col("annotations.label").alias("labels"))


# Links.

_SCHEME = "case when starts_with(url, 'https://') then '200' when starts_with(url, 'http://') then '500' else 'Error: no scheme' end"


def _fake_status(url: str) -> str:
    return "200" if url.startswith("https://") else "500" if url.startswith("http://") else "Error: no scheme"


@_query(f"select page_id, {_HTTP.format('url')} as ok from pages")
def link_validity(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", expr.http_link(F.col("url")).alias("ok"))


@_query(f"select {_SCHEME} as status, count(*) as count from pages where url is not null group by 1")
def link_status_histogram(spark, sf_dir):
    """With a client that answers by scheme, as there may be no network."""
    return links.status_histogram(links.link_status(links.links(_table(spark, sf_dir, "pages"), ["url"]), _fake_status))


@_query("select page_id, coalesce(nullif(split_part(url, '/', -1), ''), 'downloaded_file_' || page_id) as filename from pages")
def url_filename(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", links.file_name(F.col("url"), F.col("page_id")).alias("filename"))


@_query("select page_id as index, 'downloaded' as status, strlen(url) as bytes from pages")
def link_download(spark, sf_dir):
    """With a client that gives the address itself; files go to the shared folder."""
    folder = f"{files.shared_folder(spark)}/downloads-{uuid.uuid4().hex}"
    return links.download(_table(spark, sf_dir, "pages"), "url", "page_id", folder, lambda url: [url.encode()]).select("index", "status", "bytes")


@_query("select p_partkey, p_name from part order by p_partkey limit 1")
def first_row(spark, sf_dir):
    row = relational.first_row(_table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey")
    return spark.createDataFrame([(row["p_partkey"], row["p_name"])] if row else [], "p_partkey long, p_name string")


@_query("select p_partkey, p_size, p_retailprice from part")
def numeric_columns(spark, sf_dir):
    part = _table(spark, sf_dir, "part")
    return part.select(*relational.numeric_columns(part))


@_query("select cast(s_suppkey as bigint) as s_suppkey, s_name, cast(s_nationkey as bigint) as s_nationkey, cast(s_acctbal as double) as s_acctbal from supplier")
def csv_inferred(spark, sf_dir):
    """Written as CSV, and read with the types that its values have."""
    path = f"{files.shared_folder(spark)}/supplier-csv-{uuid.uuid4().hex}"
    files.write_csv(_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal"), path)
    return files.read_csv(spark, path, infer=True)


# Basics.


@_query("select c_mktsegment as value, count(*) as n from customer group by 1")
def value_counts(spark, sf_dir):
    return relational.value_counts(_table(spark, sf_dir, "customer"), "c_mktsegment")


@_query("select p_name as value, count(*) as n from part group by 1 having count(*) > 1")
def repeated_values(spark, sf_dir):
    return relational.repeated_values(_table(spark, sf_dir, "part"), "p_name")


@_query("select distinct p_brand as value from part where p_brand is not null")
def sorted_unique(spark, sf_dir):
    return relational.sorted_unique(_table(spark, sf_dir, "part"), "p_brand")


@_query("select c_name as name, 'customer' as kind from customer union all select s_name, 'supplier' from supplier")
def union_all(spark, sf_dir):
    a = _table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.lit("customer").alias("kind"))
    return relational.union_all([a, _table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.lit("supplier").alias("kind"))])


@_query("select o_orderkey, o_totalprice from orders order by o_orderkey limit 5")
def head_rows(spark, sf_dir):
    return relational.first_rows(_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 5, "o_orderkey")


@_query("select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey)")
def semi_join(spark, sf_dir):
    return relational.exists_in(_table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", _table(spark, sf_dir, "orders"), "o_custkey")


@_query("select c_custkey, exists (select 1 from orders where o_custkey = c_custkey) as has_orders from customer")
def exists_flag(spark, sf_dir):
    return relational.exists_in(_table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", _table(spark, sf_dir, "orders"), "o_custkey", "has_orders")


@_query("select 'supplier' as kind, s_suppkey, s_name from supplier")
def insert_and_exclude(spark, sf_dir):
    return relational.insert_first(relational.without(_table(spark, sf_dir, "supplier"), ["s_nationkey", "s_acctbal"]), "kind", F.lit("supplier"))


@_query("select p_partkey, coalesce(cast(try_cast(p_type as double) as bigint), 0) as p_type, cast(p_size as bigint) as p_size from part")
def to_int(spark, sf_dir):
    return relational.to_int(relational.to_int(_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size"), "p_type"), "p_size")


@_query("select cast(n_nationkey as varchar) as n_nationkey, n_name, cast(n_regionkey as varchar) as n_regionkey from nation")
def select_star(spark, sf_dir):
    """Written as CSV, and read in place by SQL."""
    path = f"{files.shared_folder(spark)}/nation-csv-{uuid.uuid4().hex}"
    files.write_csv(_table(spark, sf_dir, "nation"), path)
    return files.sql_over_csv(spark, path)


# Streams.


def _drained(stream: DataFrame, name: str, mode: str) -> DataFrame:
    """All that a stream gives of what is there now. Results go to files: those that are final once, complete ones anew with each batch."""
    spark = stream.sparkSession
    folder = f"{files.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    if mode == "append":
        writer.format("parquet").start(f"{folder}/rows").awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{folder}/rows")

    def keep(rows: DataFrame, _: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/rows")

    writer.foreachBatch(keep).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


@_query(f"{_R_SQL} select *, {_R_SUM} as TotalScore from f")
def stream_resource_flags(spark, sf_dir):
    schema = _table(spark, sf_dir, "orders").schema
    orders = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(sf_dir)
    return _drained(streams.resource_scores(spark.sql(RESOURCES.replace("from orders", "from {source}"), source=orders)), "stream_resource_flags", "append")


@_query("select time_bucket(interval '1 day', ts) as start, time_bucket(interval '1 day', ts) + interval '1 day' as \"end\", event_type as entity, count(*) as count from events group by 1, 2, 3")
def stream_event_windows(spark, sf_dir):
    schema = _table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).withColumnRenamed("event_type", "entity").withColumn("ts", F.col("ts").cast("timestamp"))
    return _drained(streams.entity_windows(events, "ts", "1 day", "30 days"), "stream_event_windows", "complete")
