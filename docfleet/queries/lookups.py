"""Queries on lookups, the conversion catalogue and conversions."""

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from docfleet.functions import constants as K
from docfleet.functions import markdown as M
from docfleet.operators import catalogue, convert
from docfleet.operators import lookup as L
from docfleet.queries import query
from docfleet.queries.documents import HTML
from docfleet.queries.files import EXT, _case, _typed

ORDER = "list_position([" + ", ".join(f"'{e}'" for e in K.LOOKUP_EXTENSIONS) + "], e)"
VARIANTS = rf"""
with s as (select *, regexp_extract(path, '\.[^./]*$') as e from v_stored),
r as (select *, row_number() over (partition by file_id order by {ORDER}, path) as rn from s where {ORDER} > 0),
hit as (select file_id, path, size, mtime from r where rn = 1),
pdf as (select file_id, path, size, mtime from (select *, row_number() over (partition by file_id order by case e when '' then 0 else 1 end, path) as k
        from s where e in ('', '.pdf')) where k = 1)"""


CREATED = "strftime(mtime, '%Y-%m-%d %H:%M:%S') as created_at"


def _created(found):
    return found.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))


@query("J1", VARIANTS + f" select request_id, l.file_id, path, size, {CREATED}, case when path is null then '{K.MSG_NO_FILE}' end as error from v_lookups l left join hit h on h.file_id = l.file_id")
def resolve_files(v):
    return _created(L.resolve_files(v("v_lookups"), v("v_stored")))


@query(
    "J2",
    VARIANTS
    + """
, m as (select merge_id, unnest(generate_series(0, len(file_ids) - 1)) as pos, unnest(file_ids) as file_id from v_merge_requests)
select merge_id, pos, m.file_id, path from m join hit h on h.file_id = m.file_id""",
)
def merge_inputs(v):
    return L.merge_inputs(v("v_merge_requests"), v("v_stored"))


@query("J3", VARIANTS + f" select request_id, l.file_id, path, size, {CREATED}, case when path is null then '{K.MSG_NO_PDF}' end as error from v_lookups l left join pdf h on h.file_id = l.file_id")
def require_files(v):
    return _created(L.require_files(v("v_lookups"), v("v_stored")))


@query(
    "J4",
    VARIANTS
    + f"""
, w as (select distinct user_id * 3 as file_id from events)
select 'deleted' as outcome, file_id, path from s where {ORDER} > 0 and file_id in (select file_id from w)
union all select 'kept', file_id, path from s where coalesce({ORDER}, 0) = 0 or file_id not in (select file_id from w)
union all select '{K.MSG_NO_FILE}', file_id, null from w where file_id not in (select file_id from s where {ORDER} > 0)""",
)
def delete_files(v):
    ids = v("events").select((F.col("user_id") * 3).alias("file_id"))
    out = L.delete_files(v("v_stored"), ids)
    tagged = lambda name: out[name].select(F.lit(name).alias("outcome"), "file_id", "path")
    missing = out["missing"].select(F.col("error").alias("outcome"), "file_id", F.lit(None).cast("string").alias("path"))
    return tagged("deleted").union(tagged("kept")).union(missing)


OFFERED = ", ".join(f"({i}, '{a}', '{b}', '{c}')" for i, (a, b, c) in enumerate(K.OFFERED_CONVERSIONS))
CATALOGUE = f"with c(i, source, target, label) as (values {OFFERED}), f as (select *, {EXT} as ext from v_files)"


@query(
    "J5",
    CATALOGUE + " select file_id, ext, row_number() over (partition by file_id order by i) - 1 as pos, target, label from f join c on source = ext",
)
def available_conversions(v):
    return L.available_conversions(_typed(v))


@query("J5", CATALOGUE + " select file_id, coalesce((select min_by(target, i) from c where source = ext), 'pdf') as target from f")
def default_target(v):
    return _typed(v).select("file_id", L.default_target(F.col("ext")).alias("target"))


def _names(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


@query(
    "J6",
    f"""select request_id, conversion_type, case when conversion_type not in ({_names(K.SINGLE_CONVERSIONS)})
    then concat('{K.MSG_UNSUPPORTED}', conversion_type) end as error from v_conversions""",
)
def check_supported(v):
    return L.check_supported(v("v_conversions"))


@query(
    "J7",
    """
with r as (select project_id, name, min_by(status, pos) as status, min_by({'e': error}, pos).e as error from v_results group by all)
select f.project_id, f.pos, f.description, f.passes, f.priority, r.status as test_status, r.error as test_error
from v_features f left join r on r.project_id = f.project_id and r.name = f.description""",
)
def apply_test_results(v):
    return L.apply_test_results(v("v_features"), v("v_results"))


@query(
    "J8",
    """
with u as (select distinct project_id, description from v_features where priority = 3),
f as (select *, row_number() over (partition by project_id, description order by pos) as rn from v_features)
select f.project_id, f.pos, f.description, case when rn = 1 and u.project_id is not null then true else passes end as passes, priority
from f left join u on u.project_id = f.project_id and u.description = f.description""",
)
def mark_feature(v):
    features = v("v_features")
    updates = features.filter(F.col("priority") == 3).select("project_id", "description").distinct()
    return L.mark_feature(features, updates.withColumn("passes", F.lit(True)))


OFFERED_KEYS = (
    f"select distinct concat({_case('source', K.KEY_FROM, 'source')}, '_to_', {_case('target', K.KEY_TO, 'target')}) as conversion_type, "
    "'offered' as list from c"
)


def _list_rows(name: str, kinds) -> str:
    return f"select unnest([{_names(kinds)}]) as conversion_type, '{name}' as list"


@query(
    "U1",
    f"""
with c(i, source, target, label) as (values {OFFERED}),
l as ({OFFERED_KEYS} union all {_list_rows('declared', K.DECLARED_CONVERSIONS)} union all {_list_rows('single', K.SINGLE_CONVERSIONS)}
      union all {_list_rows('batch', K.BATCH_CONVERSIONS)} union all {_list_rows('advertised', K.ADVERTISED_CONVERSIONS)}),
a as (select conversion_type, count(*) as n from v_conversions group by conversion_type)
select conversion_type, coalesce(any_value(n), 0) as requests, coalesce(bool_or(list = 'declared'), false) as declared,
    coalesce(bool_or(list = 'single'), false) as single, coalesce(bool_or(list = 'batch'), false) as batch,
    coalesce(bool_or(list = 'advertised'), false) as advertised, coalesce(bool_or(list = 'offered'), false) as offered
from a full join l using (conversion_type) group by conversion_type""",
)
def catalogue_coverage(v):
    return catalogue.catalogue_coverage(v("v_conversions"))


# ---------------------------------------------------------------- conversions


def _conversion_input(v):
    """Markdown texts, page lists, sheets and unsupported files, built from the given tables."""
    block = lambda m: (
        F.when(F.startswith(m, F.lit("<h")), F.concat(F.repeat(F.lit("#"), F.substring(m, 3, 1).cast("int")), F.lit(" "), F.substring(m, 5, 1_000_000)))
        .when(F.startswith(m, F.lit("<li>")), F.concat(F.lit("- "), F.substring(m, 5, 1_000_000)))
        .otherwise(F.substring(m, 4, 1_000_000))
    )
    found = F.regexp_extract_all("html", F.lit("<(?:h[1-6]|li|p)>[^<]*"), F.lit(0))
    lines = F.transform(found, lambda m, i: F.concat(F.when(i % 11 == 3, M.FENCE).otherwise(""), F.lit("\n"), block(m)))
    md = v("pages").select(
        F.concat(F.lit("md-"), F.col("page_id").cast("string")).alias("file_id"),
        F.lit("markdown_to_html").alias("conversion_type"),
        F.array_join(lines, "\n").alias("content"),
    )
    pages = v("documents").select(
        F.concat(F.lit("pdf-"), F.col("doc_id").cast("string")), F.lit("pdf_to_html"), F.to_json(F.split("text", "\n", -1))
    )
    # sheets of a hundred rows; a missing value is the JSON null
    row = F.expr(
        "concat('[', c_custkey, ',\"', c_name, '\",', case when c_nationkey = 1 then 'null' else cast(c_nationkey as string) end, ',\"', "
        "case when c_custkey % 11 = 0 then '' else c_mktsegment end, '\"]')"
    )
    sheets = (
        v("customer")
        .groupBy(F.expr("c_custkey div 100").alias("sheet"))
        .agg(F.sort_array(F.collect_list(F.struct("c_custkey", row.alias("t")))).alias("r"))
        .select(
            F.concat(F.lit("xls-"), F.col("sheet").cast("string")),
            F.lit("excel_to_csv"),
            F.concat(F.lit("["), F.array_join(F.transform("r", lambda x: x["t"]), ","), F.lit("]")),
        )
    )
    other = v("pages").select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string")),
        F.when(F.col("page_id") % 2 == 0, "pdf_to_excel").otherwise("word_to_markdown"),
        F.col("html"),
    )
    text = lambda m: F.when(F.startswith(m, F.lit("<p>")), F.substring(m, 4, 1_000_000)).otherwise(F.substring(m, 5, 1_000_000))
    blocks = F.transform(found, lambda m: F.struct(F.lit("Normal").alias("style"), text(m).alias("text")))
    word = v("pages").select(F.concat(F.lit("doc-"), F.col("page_id").cast("string")), F.lit("word_to_pdf"), F.to_json(blocks))
    return md.union(pages).union(sheets).union(other).union(word)


CONVERTED = (
    HTML.replace("select doc_id, cast(0 as bigint) as part, string_agg", ", html as (select doc_id, string_agg").strip()
    + f""")
, rows as (select c_custkey // 100 as sheet, c_custkey, concat(case when c_custkey = 0 then '' else cast(c_custkey as varchar) end, ',', c_name, ',',
      case when c_nationkey in (0, 1) then '' else cast(c_nationkey as varchar) end, ',', case when c_custkey % 11 = 0 then '' else c_mktsegment end) as line from customer),
out as (
  select concat('md-', doc_id) as file_id, 'markdown_to_html' as conversion_type, html as data, null as error from html
  union all select concat('pdf-', doc_id), 'pdf_to_html', replace(text, chr(10), '<hr/>'), null from documents
  union all select concat('xls-', sheet), 'excel_to_csv', string_agg(line, chr(10) order by c_custkey), null from rows group by sheet
  union all select concat('doc-', doc_id), 'word_to_pdf', cast(to_json(list(t order by pos) filter (regexp_matches(t, '[^\\s]'))) as varchar), null
      from (select doc_id, pos, case when m like '<p>%' then substr(m, 4) else substr(m, 5) end as t from v_html_blocks) group by doc_id
  union all select concat('page-', page_id), case when page_id % 2 = 0 then 'pdf_to_excel' else 'word_to_markdown' end, null,
      case when page_id % 2 = 0 then '{K.MSG_UNSUPPORTED}pdf_to_excel' else 'content is not a list of blocks' end from pages)
select file_id, conversion_type, case when error is null then 'success' else 'failure' end as status, nullif(data, '') as data,
    case when data <> '' then case conversion_type when 'excel_to_csv' then 'text/csv' when 'markdown_to_html' then 'text/html' when 'pdf_to_html' then 'text/html' when 'word_to_pdf' then 'application/json' end end as content_type, error
from out"""
)


@query("F1", CONVERTED)
def convert_batch(v):
    return convert.convert_batch(_conversion_input(v))


@query(
    "F1",
    """
select doc_id as file_id, 'text_to_plain' as conversion_type, case when length(text) < 300 then 'failure' else 'success' end as status,
    case when length(text) >= 300 then strip_accents(text) end as data, case when length(text) >= 300 then 'text/plain' end as content_type,
    case when length(text) < 300 then 'too short' end as error from documents""",
)
def convert_batch_with_python(v):
    """Texts without their accents: Unicode normal forms are no column function."""

    def without_accents(texts: pa.Array) -> pa.Array:
        if pc.min(pc.utf8_length(texts)).as_py() < 300:
            raise ValueError("too short")
        return pc.replace_substring_regex(pc.utf8_normalize(texts, form="NFD"), r"\p{Mn}+", "")

    registry = convert.native_registry()
    registry.register("text_to_plain", batch=without_accents, content_type="text/plain")
    files = v("documents").select(F.col("doc_id").alias("file_id"), F.lit("text_to_plain").alias("conversion_type"), F.col("text").alias("content"))
    return convert.convert_batch(files, registry)


@query("F2", "select event_id, coalesce(case when json_valid(doc) then doc ->> '$.k' end, doc) as value, not json_valid(doc) as used_fallback from v_state_json")
def with_fallback(v):
    parsed = F.get_json_object("doc", "$.k")
    return v("v_state_json").select("event_id", convert.with_fallback(parsed, F.col("doc")).alias("r")).select("event_id", "r.*")
