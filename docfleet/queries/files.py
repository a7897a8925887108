"""Queries on file names, sizes, types and on sources and sinks."""

import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfleet.functions import constants as K
from docfleet.functions import scalars as P
from docfleet.operators import hygiene as H
from docfleet.plans.runtime import scratch_path, spread_out
from docfleet.plans.views import NOW
from docfleet.queries import query
from docfleet.queries.hygiene import PLAN
from docfleet.sources import files as S
from docfleet.sources import state


def _now():
    return F.lit(NOW).cast("timestamp")



def _case(key: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"when '{k}' then '{v}'" for k, v in mapping.items())
    return f"case {key} {whens} else {default} end"


NAME = "split_part(path, '/', -1)"
EXT = "case when contains(path, '.') then lower(split_part(path, '.', -1)) else '' end"
# the target a conversion is asked for; runs through all targets
TARGET = "case file_id % 7 when 0 then 'word' when 1 then 'images' when 2 then 'pdf' when 3 then 'jpg' when 4 then 'md' when 5 then 'html' else 'xls' end"
KEY = f"concat({_case('ext', K.KEY_FROM, 'ext')}, '_to_', {_case('target', K.KEY_TO, 'target')})"
TYPED = f"with f as (select *, {EXT} as ext, {TARGET} as target from v_files), k as (select *, {KEY} as key from f)"


def _typed(v):
    files = v("v_files").withColumn("ext", P.file_extension("path")).withColumn("target", F.expr(TARGET))
    return files.withColumn("key", P.conversion_key(F.col("ext"), F.col("target")))


@query("P1", f"select file_id, {EXT} as ext from v_files")
def file_extension(v):
    return v("v_files").select("file_id", P.file_extension("path").alias("ext"))


@query(
    "P2",
    """
with s as (select l_orderkey, l_linenumber, l_partkey * l_suppkey * (l_partkey % 5) * (1 + l_linenumber) as size from lineitem),
u as (select *, case when size < 1048576 then 1024 when size < 1073741824 then 1048576 else 1073741824 end as unit from s),
h as (select *, (size * 200 + unit) // (2 * unit) as c from u)
select l_orderkey, l_linenumber, size, case when size < 1024 then concat(size, ' B') else concat(c // 100,
    case when c % 100 = 0 then '' when c % 10 = 0 then concat('.', c % 100 // 10) else concat('.', lpad(cast(c % 100 as varchar), 2, '0')) end,
    case unit when 1024 then ' KB' when 1048576 then ' MB' else ' GB' end) end as shown
from h""",
)
def human_size(v):
    size = F.expr("l_partkey * l_suppkey * (l_partkey % 5) * (1 + l_linenumber)")
    sized = v("lineitem").select("l_orderkey", "l_linenumber", size.alias("size"))
    return sized.withColumn("shown", P.human_size(F.col("size")))


@query("P3", f"with f as (select file_id, {EXT} as ext from v_files) select file_id, {_case('ext', K.TYPE_LABELS, 'upper(ext)')} as label from f")
def type_label(v):
    return _typed(v).select("file_id", P.type_label(F.col("ext")).alias("label"))


@query("P3", f"{TYPED} select file_id, {_case('target', K.TARGET_LABELS, 'target')} as label from k")
def target_label(v):
    return _typed(v).select("file_id", P.target_label(F.col("target")).alias("label"))


@query("P4", f"{TYPED} select file_id, key from k")
def conversion_key(v):
    return _typed(v).select("file_id", "key")


@query("P5", f"{TYPED} select file_id, split_part(key, '_', -1) as fmt from k")
def output_format(v):
    return _typed(v).select("file_id", P.output_format(F.col("key")).alias("fmt"))


CONTENT_TYPE = _case("split_part(key, '_', -1)", K.CONTENT_TYPES, f"'{K.DEFAULT_CONTENT_TYPE}'")
STRICT_TYPE = _case(
    _case("split_part(key, '_', -1)", K.FORMAT_OF_TOKEN, "split_part(key, '_', -1)"),
    K.CONTENT_TYPES,
    f"'{K.DEFAULT_CONTENT_TYPE}'",
)


@query("P6", f"{TYPED} select file_id, {CONTENT_TYPE} as loose, {STRICT_TYPE} as strict from k")
def content_type(v):
    fmt = P.output_format(F.col("key"))
    return _typed(v).select(
        "file_id", P.content_type(fmt, strict=False).alias("loose"), P.content_type(fmt).alias("strict")
    )


ALL_DOWNLOADS = K.DOWNLOAD_EXTENSIONS | K.MORE_DOWNLOAD_EXTENSIONS


@query(
    "P7",
    f"""
{TYPED} select file_id, concat('converted.', {_case(CONTENT_TYPE, K.DOWNLOAD_EXTENSIONS, "'pdf'")}) as loose,
       concat('converted.', {_case(STRICT_TYPE, ALL_DOWNLOADS, "'pdf'")}) as strict from k""",
)
def download_name(v):
    fmt = P.output_format(F.col("key"))
    return _typed(v).select(
        "file_id",
        P.download_name(P.content_type(fmt, strict=False), strict=False).alias("loose"),
        P.download_name(P.content_type(fmt)).alias("strict"),
    )


@query(
    "P8",
    rf"""{TYPED} select file_id, concat(regexp_replace({NAME}, '\.[^.]+$', ''), '_converted.',
       {_case('target', K.RESULT_EXTENSIONS, 'target')}) as name from k""",
)
def result_name(v):
    return _typed(v).select("file_id", P.result_name(P.base_name(F.col("path")), F.col("target")).alias("name"))


@query(
    "P9",
    rf"""
with f as (select file_id, {EXT} as ext, case when size = 0 then '' when file_id % 4 = 0 then 'PK' || chr(3) || chr(4) || content else content end as c from v_files)
select file_id, c <> '' and (ext not in ('docx', 'xlsx', 'pptx', 'png') or (ext <> 'png' and starts_with(c, 'PK' || chr(3) || chr(4)))) as valid from f""",
)
def sniff_signature(v):
    marked = F.when(F.col("file_id") % 4 == 0, F.concat(F.unhex(F.lit("504B0304")), F.encode("content", "utf-8"))).otherwise(
        F.encode("content", "utf-8")
    )
    content = F.when(F.col("size") > 0, marked).otherwise(F.encode(F.lit(""), "utf-8"))
    return _typed(v).select("file_id", P.sniff_signature(content, F.col("ext")).alias("valid"))


@query(
    "P10",
    """
select doc_id, case when contains(t, 'api') or contains(t, 'endpoint') then 'api' when contains(t, 'form') then 'form'
    when contains(t, 'auth') or contains(t, 'login') then 'auth' else 'generic' end as category
from (select doc_id, lower(text) as t from documents)""",
)
def task_category(v):
    return v("documents").select("doc_id", P.task_category(F.col("text")).alias("category"))


OPERATION = "case user_id % 8 when 0 then 'convert' when 1 then 'batch' when 2 then 'merge' when 3 then 'split' when 4 then 'extract' when 5 then 'to_images' when 6 then 'from_images' else 'other' end"


@query("P11", f"select event_id, {_case(OPERATION, K.QUEUES, 'null')} as queue from events")
def queue_for(v):
    return v("events").select("event_id", P.queue_for(F.expr(OPERATION)).alias("queue"))


@query("P12", "select file_id, concat('99-archive/duplicates/', replace(path, '/', '__')) as moved_to from v_files")
def archive_path(v):
    return v("v_files").select("file_id", P.archive_path(F.col("path"), "duplicates").alias("moved_to"))


@query(
    "P13",
    f"""
with a as (select event_id, epoch_us(timestamp '{NOW}') - epoch_us(ts) as us from events), s as (select *, us // 1000000 as s from a)
select event_id, case when s < 60 then 'just now' when s < 3600 then concat(s // 60, ' minutes ago')
    when s < 86400 then concat(s // 3600, ' hours ago') when s < 172800 then 'yesterday' else concat(s // 86400, ' days ago') end as ago,
    us >= 7 * 86400000000 as stale
from s""",
)
def time_ago(v):
    return v("events").select(
        "event_id", P.time_ago(F.col("ts"), _now()).alias("ago"), P.is_stale(F.col("ts"), _now()).alias("stale")
    )


@query(
    "P14",
    rf"select file_id, regexp_matches(n, '^[0-9]{{2}}[a-z]?-[a-z0-9]+(-[a-z0-9]+)*\.[a-z0-9]+$') as valid from (select file_id, case when file_id % 3 = 0 then {NAME} else concat('0', file_id % 9, 'a-', replace(path, '/', '-')) end as n from v_files)",
)
def valid_artifact_name(v):
    name = F.when(F.col("file_id") % 3 == 0, P.base_name(F.col("path"))).otherwise(
        F.concat(F.lit("0"), (F.col("file_id") % 9).cast("string"), F.lit("a-"), F.replace("path", F.lit("/"), F.lit("-")))
    )
    return v("v_files").select("file_id", P.valid_artifact_name(name).alias("valid"))


@query("P15", "select doc_id, substr(text, 1, 500) as preview from documents")
def preview(v):
    return v("documents").select("doc_id", P.preview(F.col("text")).alias("preview"))


@query("P16", f"select file_id, (epoch_us(timestamp '{NOW}') - epoch_us(mtime)) / 3.6e9 as age_hours from v_files")
def age_hours(v):
    return v("v_files").select("file_id", P.age_hours(F.col("mtime"), _now()).alias("age_hours"))


# ---------------------------------------------------------------- sources and sinks


def _tree(v):
    """Every document as a file of its own, in folders by source; the inventory without unfinished files.

    Rows are numbered, since several may have one doc_id. A missing text is a file without bytes, every other
    file ends its last line. Names of more than 200 bytes go on in a folder below, marked so that none is
    left out of the inventory by its name.
    """
    source = F.regexp_replace(F.concat(F.lit("source="), F.url_encode("source")), "(.{200})", "$1/_")
    name = F.concat(F.monotonically_increasing_id(), F.lit("_"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    texts = v("documents").select(
        F.concat(F.coalesce(source, F.lit("source")), F.lit("/"), name).alias("path"),
        F.concat("text", F.lit("\n")).cast("binary").alias("content"),
    )
    root = scratch_path(texts.sparkSession, "tree")
    S.write_files(spread_out(texts), root)
    found = S.scan_files(texts.sparkSession, root)
    folder = F.replace(F.regexp_replace("path", "/[^/]*$", ""), F.lit("/_"), F.lit(""))
    return root, found.filter(~F.startswith(P.base_name(F.col("path")), F.lit("."))).withColumns({
        "source": F.when(F.contains(folder, F.lit("=")), F.url_decode(F.substring_index(folder, "=", -1))),
        "doc_id": F.nullif(F.substring_index("path", "_", -1), F.lit("")).cast("bigint"),
    })


@query("S1", "select source, doc_id, octet_length(encode(text)) + 1 as size, true as fresh from documents")
def scan_files(v):
    started = F.lit(datetime.datetime.now(datetime.timezone.utc) - datetime.timedelta(seconds=2))
    _, files = _tree(v)
    return files.select("source", "doc_id", F.nullif("size", F.lit(0)).alias("size"), (F.col("mtime") >= started).alias("fresh"))


@query(
    "S1",
    """
with f as (select doc_id, octet_length(encode(text)) + 1 as size, sha256(text || chr(10)) as hash from documents)
select doc_id, size, hash from f where size in (select size from f group by size having count(*) > 1)""",
)
def hash_files(v):
    """Hashes of the files whose size occurs more than once; no other file is opened."""
    root, files = _tree(v)
    return S.hash_files(files, root).select("doc_id", "size", "hash")


MEDIA = _case("ext", S._MEDIA_BY_EXTENSION, f"'{K.DEFAULT_CONTENT_TYPE}'")


@query(
    "S2",
    f"""
select sha256(path) as file_id, {NAME} as filename, ext, size, {MEDIA} as content_type, strftime(mtime, '%Y-%m-%d %H:%M:%S') as upload_time
from (select *, {EXT} as ext from v_files)""",
)
def ingest_manifest(v):
    manifest = S.ingest_manifest(v("v_files"))
    path = scratch_path(manifest.sparkSession, "manifest")
    S.append_manifest(manifest, path)
    rows = manifest.sparkSession.read.parquet(path).drop("upload_date")
    return rows.withColumn("upload_time", F.date_format("upload_time", "yyyy-MM-dd HH:mm:ss"))


REQUIREMENT_TEXT = """case doc_id % 6
    when 0 then concat('{"name": "', source, '", "description": "', lang, '", "priority": ', cast(doc_id % 7 as string), '}')
    when 1 then concat('[{"name": "', source, '", "priority": "', cast(doc_id % 5 as string), '"}, {"description": "only text", "priority": "2.5"}, {"priority": 2.9}, {"name": "", "priority": true}, {"priority": null}]')
    when 2 then '[]' when 3 then concat('{"name": "', source) else text end"""


@query(
    "S3",
    f"""
with t as (select concat('in/', source, '.', cast(doc_id as string), '.txt') as path, {REQUIREMENT_TEXT} as c from documents),
j as (select path, c, json_valid(c) and c[1] in ('[', '{{') as ok from t),
items as (
  select path, unnest(generate_series(0, len(l) - 1)) as pos, unnest(l) as r
  from (select path, case when c[1] = '[' then cast(c as json[]) else [cast(c as json)] end as l from j where ok)),
typed as (select *, json_type(r -> '$.priority') as k, r ->> '$.priority' as p, r ->> '$.name' as n from items)
select path, pos, case when json_exists(r, '$.name') then n else 'Unnamed Project' end as name,
    case when json_exists(r, '$.description') then r ->> '$.description' when json_exists(r, '$.name') then n else '' end as description,
    coalesce(case when k = 'VARCHAR' then case when regexp_matches(p, '^\\s*[+-]?[0-9]+\\s*$') then cast(p as bigint) end
        when k = 'BOOLEAN' then cast(cast(p as boolean) as bigint) when k in ('BIGINT', 'UBIGINT', 'DOUBLE') then cast(trunc(cast(p as double)) as bigint) end, 1) as priority
from typed
union all
select path, 0, regexp_replace(split_part(path, '/', -1), '\\.txt$', ''), c, 1 from j where not ok""",
)
def read_requirements(v):
    path = F.expr("concat('in/', source, '.', cast(doc_id as string), '.txt')")
    return state.read_requirements(v("documents").select(path.alias("path"), F.expr(REQUIREMENT_TEXT).alias("content")))


@query(
    "S4",
    """
select event_id, not json_valid(doc) as broken, case when json_valid(doc) then cast(doc ->> '$.k' as bigint) end as k
from v_state_json""",
)
def read_state_json(v):
    schema = T.StructType([T.StructField("k", T.LongType())])
    return state.read_state_json(v("v_state_json"), schema).select("event_id", "broken", F.col("state.k").alias("k"))


@query(
    "S4",
    """
with j as (select event_id, json_valid(doc) as ok, case when json_valid(doc) then doc end as doc from v_handoff_docs)
select event_id, not ok as broken, doc ->> '$."from-phase"' as from_phase, doc ->> '$."executive-summary"' as summary,
    cast(json_array_length(doc, '$."key-deliverables"') as int) as deliverables, doc ->> '$."open-issues"[0]."suggested-action"' as action
from j""",
)
def read_handoffs(v):
    """Handoff files by their own schema, the broken ones marked."""
    read = state.read_state_json(v("v_handoff_docs"), "handoff")
    return read.select(
        "event_id", "broken", F.col("state.`from-phase`").alias("from_phase"), F.col("state.`executive-summary`").alias("summary"),
        F.size("state.`key-deliverables`").alias("deliverables"), F.get("state.`open-issues`", F.lit(0))["suggested-action"].alias("action"),
    )


@query(
    "S5",
    """
select doc_id, rw, string_agg(case when value is null or value = '' or (is_num and try_cast(value as double) = 0) then '' else value end, ',' order by col) as line
from v_cells group by doc_id, rw""",
)
def csv_lines(v):
    return S.csv_lines(v("v_cells"))


@query(
    "S6",
    PLAN
    + """
select section, count(*) as entries from (
  select 'summary' as section union all
  select 'temp_file' from temp union all
  select 'zero_size' from v_files where size = 0 union all
  select 'duplicate' from d union all
  select 'action' from plan) group by section""",
)
def write_report(v):
    """Writes the hygiene report and counts the entries of each section as read back."""
    files = v("v_files")
    path = scratch_path(files.sparkSession, "report")
    report = H.scan_report(files, _now())
    S.write_report(report, path)
    return files.sparkSession.read.json(path).groupBy("section").agg(F.count(F.lit(1)).alias("entries"))


@query(
    "S7",
    f"""
select seq, task_id, lower(state) as status from v_task_events
where state in ('SUCCESS', 'FAILURE') and ts >= timestamp '{NOW}' - interval 72 hours""",
)
def write_results(v):
    done = v("v_task_events").filter(F.col("state").isin("SUCCESS", "FAILURE"))
    rows = done.select("seq", "task_id", F.lower("state").alias("status"), F.col("ts").alias("created_at"))
    path = scratch_path(rows.sparkSession, "results")
    S.write_results(rows, path)
    return S.read_results(rows.sparkSession, path, _now(), ttl_hours=72).select("seq", "task_id", "status")
