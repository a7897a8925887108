"""Queries on duplicates, clean-up, similarity and health."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfleet.functions import constants as K
from docfleet.operators import hygiene as H
from docfleet.operators import similarity as N
from docfleet.plans.views import NOW
from docfleet.queries import query
from docfleet.sources import state


def _now():
    return F.lit(NOW).cast("timestamp")

AGE = f"(epoch_us(timestamp '{NOW}') - epoch_us(mtime)) / 3.6e9"

COPIES = """
with h as (select *, sha256(content) as hash from v_files where size > 0),
c as (select *, count(*) over (partition by hash) as copies,
             first_value(path) over (partition by hash order by mtime desc, path) as keeper from h),
d as (select * from c where copies > 1)"""


@query("A8", COPIES + " select hash, path, copies from d")
def duplicate_groups(v):
    return H.duplicate_groups(H.file_digests(v("v_files")))


@query("W5", COPIES + " select hash, path, keeper, path = keeper as kept from d")
def duplicate_keeper(v):
    return H.duplicate_keeper(H.file_digests(v("v_files")))


TEMP = f"""
temp as (
  select path, mtime, {AGE} as age, '*.' || split_part(path, '.', -1) as pattern,
         row_number() over (partition by split_part(path, '.', -1) order by mtime desc, path) as rn
  from v_files where regexp_matches(path, '\\.(tmp|draft|bak)$')),
expired as (select * from temp where rn > 3 and age > 24)"""


@query("W4", f"with {TEMP} select pattern, path, strftime(mtime, '%Y-%m-%d %H:%M:%S') as mtime from expired")
def expired_temp(v):
    return H.expired_temp(v("v_files"), _now()).withColumn("mtime", F.date_format("mtime", "yyyy-MM-dd HH:mm:ss"))


PLAN = (
    COPIES
    + f""", {TEMP},
plan as (
  select 'delete_temp' as action, path as file, null as moved_to, null as kept from expired
  union all select 'move_zero', path, '99-archive/tombstones/' || replace(path, '/', '__'), null from v_files where size = 0
  union all select 'move_dup', path, '99-archive/duplicates/' || replace(path, '/', '__'), keeper from d where path <> keeper)"""
)


@query("H6", PLAN + " select *, 'dry-run' as status from plan")
def action_plan(v):
    files = v("v_files")
    return H.action_plan(files, H.file_digests(files), _now())


@query(
    "A9",
    COPIES
    + """
select (select count(*) from v_files) as scanned,
       (select count(*) from v_files where regexp_matches(path, '\\.(tmp|draft|bak)$')) as temp_count,
       (select count(*) from v_files where size = 0) as zero_count,
       (select count(distinct hash) from d) as duplicate_groups,
       (select count(*) from d) as duplicate_files, false as apply_mode""",
)
def scan_summary(v):
    files = v("v_files")
    return H.scan_summary(files, H.file_digests(files))


@query(
    "A9",
    PLAN
    + """
select 'summary' as section, null as path, null as what, cast(null as bigint) as copies
union all select 'temp_file', path, null, null from temp
union all select 'zero_size', path, null, null from v_files where size = 0
union all select 'duplicate', path, hash, copies from d
union all select 'action', file, action || ' ' || coalesce(moved_to, '-') || ' ' || coalesce(kept, '-'), null from plan""",
)
def scan_report(v):
    """The report rows, with the JSON detail of duplicates and actions taken apart again."""
    field = lambda name: F.get_json_object("detail", f"$.{name}")
    action = F.concat_ws(" ", field("action"), F.coalesce(field("moved_to"), F.lit("-")), F.coalesce(field("kept"), F.lit("-")))
    return H.scan_report(v("v_files"), _now()).select(
        "section",
        "path",
        F.when(F.col("section") == "action", action).when(F.col("section") == "duplicate", field("hash")).alias("what"),
        F.when(F.col("section") == "duplicate", field("copies").cast("bigint")).alias("copies"),
    )


@query("H1", "select path from v_files where size = 0 and split_part(path, '/', -1) <> '__init__.py'")
def zero_size(v):
    return H.zero_size(v("v_files"))


@query("H2", "select path from v_placeholders where file_id % 61 in (0, 1)")
def placeholders(v):
    return H.placeholders(v("v_placeholders"))


@query("H3", f"with {TEMP} select path, age as age_hours from temp")
def temp_listing(v):
    return H.temp_listing(v("v_files"), _now()).select("path", "age_hours")


NEAR_PAIRS = f"""
with recursive w as (
  select doc_id, string_split(regexp_replace(regexp_replace(lower(text), '[{K.BLANKS}]+', ' ', 'g'), '^ | $', '', 'g'), ' ') as w from documents),
s as (select distinct doc_id, array_to_string(list_slice(w, i, i + 4), ' ') as g
      from (select doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) as i from w where w <> [''])),
n as (select doc_id, count(*) as n from s group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
pairs as (select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where c / (x.n + y.n - c) > 0.8),
reach as (
  select a as doc_id, b as other from (select a, b from pairs union select b, a from pairs)
  union
  select r.doc_id, p.y from reach r join (select a as x, b as y from pairs union select b, a from pairs) p on p.x = r.other),
clusters as (select doc_id, least(doc_id, min(other)) as cluster_id from reach group by doc_id)"""


@query("H4", NEAR_PAIRS + " select doc_id, cluster_id, count(*) over (partition by cluster_id) as size from clusters")
def near_duplicates(v):
    return N.near_duplicates(v("documents"))


@query(
    "H4",
    NEAR_PAIRS
    + """
, k as (select doc_id, cluster_id, first_value(doc_id) over (partition by cluster_id order by mtime desc, doc_id) as keeper
        from clusters join v_files on file_id = doc_id)
select doc_id, cluster_id, keeper, doc_id = keeper as kept from k""",
)
def near_duplicate_keepers(v):
    times = v("v_files").select(F.col("file_id").alias("doc_id"), "mtime")
    return N.near_duplicate_keepers(v("documents").join(times, "doc_id"))


@query(
    "H5",
    """
with n as (select distinct path, regexp_replace(path, '/?[^/]*$', '') as folder, lower(split_part(path, '/', -1)) as name from v_names),
e as (select *, case when contains(name, '.') then split_part(name, '.', -1) else '' end as ext from n),
s as (select folder, ext, path, case when ext = '' then name else substr(name, 1, length(name) - length(ext) - 1) end as name from e)
select a.folder, a.ext, a.path as path_a, b.path as path_b, cast(levenshtein(a.name, b.name) as int) as distance
from s a join s b on a.folder = b.folder and a.ext = b.ext and a.path < b.path and levenshtein(a.name, b.name) <= 2""",
)
def similar_names(v):
    """Names up to two edits apart, and those that differ in case only."""
    return N.similar_names(v("v_names"), distance=2)


@query(
    "H7",
    f"select seq, (epoch_us(timestamp '{NOW}') - epoch_us(ts)) / 3.6e9 > 240 as expired from v_task_events",
)
def expired_results(v):
    results = v("v_task_events").withColumn("created_at", F.col("ts"))
    gone = H.expired_results(results, _now(), 240).select("seq", F.lit(True).alias("expired"))
    return gone.union(H.live_results(results, _now(), 240).select("seq", F.lit(False)))


@query("H8", "select path, size from v_files where (path like '%.md' or path like '%.docx') and size > 4096")
def large_logs(v):
    return H.large_logs(v("v_files"), 4096, (".md", ".docx"))


CHECKS = f"""
with t as (
  select project_id, {AGE} as age, row_number() over (partition by project_id, split_part(path, '.', -1) order by mtime desc, path) as rn
  from v_project_files where regexp_matches(path, '\\.(tmp|draft|bak)$')),
bad(check_name, project_id) as (
  select 'state_parses', project_id from v_project_state where not json_valid(doc)
  union all select 'references_exist', project_id from (select project_id, path from v_project_refs except select project_id, path from v_project_files)
  union all select 'no_orphans', project_id from (select project_id, path from v_project_files except select project_id, path from v_project_refs)
  union all select 'no_empty_files', project_id from v_project_files where size = 0
  union all select 'no_placeholders', project_id from v_project_files where trim(lower(content), ' :.') in ('todo', 'coming  soon')
  union all select 'temp_cleaned', project_id from t where rn > 3 and age > 24
  union all select 'names_valid', project_id from v_project_files where not regexp_matches(split_part(path, '/', -1), '^[0-9]{{2}}[a-z]?-[a-z0-9]+(-[a-z0-9]+)*\\.[a-z0-9]+$')
  union all select 'decisions_recorded', project_id from (select project_id, phase from v_project_phases except select project_id, phase from v_project_decisions)),
p as (select project_id from v_project_files union select project_id from v_project_refs union select project_id from v_project_state
      union select project_id from v_project_phases union select project_id from v_project_decisions),
k as (select unnest([{', '.join(f"'{c}'" for c in H.HEALTH_CHECKS)}]) as check_name),
c as (select p.project_id, k.check_name, count(bad.check_name) as violations from p cross join k left join bad using (project_id, check_name) group by all),
a as (select 'project' as scope, project_id, check_name, violations from c
      union all select 'total', null, check_name, cast(sum(violations) as bigint) from c group by check_name)"""


def _checks(v):
    docs = state.read_state_json(v("v_project_state"), T.StructType([T.StructField("k", T.LongType())]))
    return H.health_checks(docs, v("v_project_refs"), v("v_project_files"), v("v_project_decisions"), v("v_project_phases"), _now())


@query("H9", CHECKS + ' select scope, project_id, check_name as "check", violations, violations = 0 as passed from a')
def health_checks(v):
    return _checks(v)


@query(
    "H10",
    CHECKS
    + """,
s as (select scope, project_id, cast(sum(violations) as bigint) as violations, count(*) filter (violations > 0) as failed_checks from a group by scope, project_id),
r as (select *, greatest(0, 100 - 5 * violations) as score from s)
select *, case when score >= 90 then 'excellent' when score >= 70 then 'good' when score >= 50 then 'fair' else 'poor' end as band from r""",
)
def health_band(v):
    """Score and band of every project from its own checks."""
    return H.health_report(_checks(v))


@query(
    "H11",
    "select project_id, phase, concat('99-archive/', project_id, '/', phase) as target from v_phases where status = 'completed'",
)
def archive_completed(v):
    return H.archive_completed(v("v_phases"))


@query(
    "H12",
    """
select event_id, concat_ws('; ',
    case when to_phase = '' then 'missing to_phase' end,
    case when summary is null or trim(summary) = '' then 'missing executive_summary' end,
    case when deliverables = 0 then 'missing key_deliverables' end,
    case when len(regexp_extract_all(summary, '[.!?]+')) > 2 then 'executive_summary longer than two sentences' end,
    case when suggested = '' then 'open issue without suggested action' end) as gaps
from v_handoffs""",
)
def handoff_gaps(v):
    some = F.array(F.lit("x"))
    handoffs = v("v_handoffs").select(
        "event_id",
        "from_phase",
        "to_phase",
        F.col("summary").alias("executive_summary"),
        F.when(F.col("deliverables") == 0, F.array().cast("array<string>")).otherwise(some).alias("key_deliverables"),
        some.alias("critical_decisions"),
        some.alias("constraints_next_phase"),
        F.array(F.struct(F.lit("slow").alias("issue"), F.col("suggested").alias("suggested_action"))).alias("open_issues"),
    )
    return H.handoff_gaps(handoffs).select("event_id", F.array_join("gaps", "; ").alias("gaps"))


@query(
    "H13",
    r"""
with a as (
  select project_id, phase, bool_or(path like '%handoff-out.json') as handoff, bool_or(path like '%report.json') as report,
      count(*) filter (not path like '%handoff-out.json' and not path like '%report.json' and not path like '%.tmp'
        and not regexp_matches(split_part(path, '/', -1), '^[0-9]{2}[a-z]?-[a-z0-9]+(-[a-z0-9]+)*\.[a-z0-9]+$')) as bad,
      count(*) filter (path like '%.tmp') as temp
  from v_artifacts group by all),
g as (
  select p.project_id, p.phase, concat_ws('; ',
      case when not coalesce(handoff, false) then 'missing handoff-out.json' end,
      case when not coalesce(report, false) then 'missing report.json' end,
      case when bad > 0 then 'invalid artifact names' end, case when temp > 0 then 'temporary files left' end,
      case when not exists (select 1 from v_decisions d where d.project_id = p.project_id and d.phase = p.phase and d.status <> 'rejected') then 'no decision recorded' end,
      case when exists (select 1 from v_issues i where i.project_id = p.project_id and i.phase = p.phase and severity = 'critical' and status in ('open', 'in-progress')) then 'critical issue unresolved' end) as gaps
  from v_phases p left join a on a.project_id = p.project_id and a.phase = p.phase)
select *, gaps = '' as may_complete from g""",
)
def phase_gate(v):
    decided = v("v_decisions").filter(F.col("status") != "rejected")
    gate = H.phase_gate(v("v_phases"), v("v_artifacts"), v("v_issues"), decided)
    return gate.withColumn("gaps", F.array_join("gaps", "; "))
