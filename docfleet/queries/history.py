"""Queries on history, decisions, issues and references."""

from pyspark.sql import functions as F

from docfleet.functions import constants as K
from docfleet.operators import history as H
from docfleet.operators import hygiene
from docfleet.operators import snapshots as SN
from docfleet.plans.runtime import scratch_path
from docfleet.queries import query

FMT = "yyyy-MM-dd HH:mm:ss"
DUCK_FMT = "'%Y-%m-%d %H:%M:%S'"


def _times(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.date_format(c, FMT))
    return df


def _t(column: str, name: str | None = None) -> str:
    return f"strftime({column}, {DUCK_FMT}) as {name or column}"


@query(
    "A10",
    """
select project_id, count(*) filter (status = 'completed') as completed, count(*) as total,
    cast(count(*) filter (status = 'completed') as double) / count(*) * 100 as progress
from v_phases group by project_id""",
)
def phase_progress(v):
    # a manifest holds its phases as one array, which the phase catalogue bounds
    manifests = v("v_phases").groupBy("project_id").agg(F.collect_list(F.struct("phase", "status")).alias("phases"))
    return H.phase_progress(manifests)


@query(
    "A11",
    f"""
with l as (select project_id, max(ts) as last_activity, arg_max(phase, event_id) as phase from v_history group by project_id),
i as (select project_id, count(*) filter (status in ('open', 'in-progress')) as open_issues from v_issues group by project_id),
d as (select project_id, count(*) filter (status = 'proposed') as pending_decisions from v_decisions group by project_id),
p as (select project_id, cast(count(*) filter (status = 'completed') as double) / count(*) * 100 as progress,
        case when count(*) filter (status = 'completed') = count(*) then 'completed' when count(*) filter (status = 'completed') = 0 then 'initialized' else 'in-progress' end as status,
        min(phase) filter (status = 'pending') as next_milestone from v_phases group by project_id)
select project_id, {_t('last_activity')}, phase, coalesce(open_issues, 0) as open_issues, coalesce(pending_decisions, 0) as pending_decisions,
    progress, status, next_milestone
from l full join i using (project_id) full join d using (project_id) full join p using (project_id)""",
)
def current_status(v):
    out = H.current_status(v("v_history"), v("v_issues"), v("v_decisions"), v("v_phases"))
    return _times(out, "last_activity")


@query(
    "A12",
    f"""
select project_id, phase, {_t('min(ts)', 'started')}, {_t('max(ts)', 'completed')}, (epoch_us(max(ts)) - epoch_us(min(ts))) / 3.6e9 as duration_hours,
    count(distinct artifact) as artifacts, count(distinct decision_id) as decisions
from v_history group by project_id, phase""",
)
def phase_history(v):
    return _times(H.phase_history(v("v_history")), "started", "completed")


@query(
    "A12",
    """
select distinct project_id, phase, 'artifact' as kind, artifact as item from v_history
union select project_id, phase, 'decision', cast(decision_id as varchar) from v_history where decision_id is not null""",
)
def phase_items(v):
    return H.phase_items(v("v_history"))


METRIC = {m: f"l_{c} % {k}" for m, (c, k) in zip(
    K.PHASE_METRICS,
    [("partkey", 7), ("suppkey", 5), ("partkey", 1000), ("suppkey", 90), ("linenumber", 4), ("linenumber", 3), ("partkey", 3), ("suppkey", 2), ("partkey", 2)],
)}
CHECK = {c: f"l_{k}" for c, k in zip(K.PHASE_CHECKS, ["partkey % 50 <> 0", "suppkey % 20 <> 0", "linenumber < 7", "returnflag <> 'R'"])}


@query(
    "A13",
    "select l_orderkey as project_id, "
    + ", ".join(f"cast(sum({e}) as bigint) as {m}" for m, e in METRIC.items())
    + ", "
    + ", ".join(f"bool_and({e}) as {c}" for c, e in CHECK.items())
    + " from lineitem group by l_orderkey",
)
def metric_totals(v):
    reports = v("lineitem").select(
        F.col("l_orderkey").alias("project_id"),
        F.struct(*[F.expr(e).cast("bigint").alias(m) for m, e in METRIC.items()]).alias("metrics"),
        F.struct(*[F.expr(e).alias(c) for c, e in CHECK.items()]).alias("quality"),
    )
    return H.metric_totals(reports)


@query(
    "A14",
    f"""
with h as (select 'f' || file_id as path, sha256(content) as hash from v_files where size > 0),
w as (select distinct event_id, unnest(files_affected) as path from v_entries)
select event_id as entry_id, sha256(coalesce(string_agg(hash, '' order by hash), '')) as context_hash,
    coalesce(string_agg(path, ',' order by path) filter (hash is null), '') as without_hash
from w left join h using (path) group by event_id""",
)
def context_hash(v):
    files = v("v_files").withColumn("path", F.concat(F.lit("f"), F.col("file_id").cast("string")))
    out = H.context_hash(v("v_entries").withColumnRenamed("event_id", "entry_id"), hygiene.file_digests(files))
    return out.withColumn("without_hash", F.array_join("without_hash", ","))


@query(
    "A15",
    f"""
select project_id, {_t('min(ts)', 'created_at')}, {_t('max(ts)', 'last_updated')}, arg_max(phase, event_id) as current_phase,
    arg_max(type, event_id) as last_type, count(*) as entries
from v_history group by project_id""",
)
def rebuild_manifest(v):
    return _times(H.rebuild_manifest(v("v_history")), "created_at", "last_updated")


@query(
    "A16",
    f"""
with t as (select distinct event_id, ts, phase, unnest(files_affected) as path from v_entries)
select path, {_t('min(ts)', 'first_ts')}, {_t('max(ts)', 'last_ts')}, count(*) as entries, array_to_string(list_sort(list_distinct(list(phase))), ',') as phases
from t group by path""",
)
def artifact_index(v):
    return _times(H.artifact_index(v("v_entries")), "first_ts", "last_ts").withColumn("phases", F.array_join("phases", ","))


@query("J9", "select distinct path from v_refs where path not in (select path from v_files)")
def dangling_references(v):
    return H.dangling_references(v("v_refs"), v("v_files"))


@query("J10", "select path from v_files where path not in (select path from v_refs)")
def orphan_files(v):
    return H.orphan_files(v("v_files"), v("v_refs"))


@query(
    "J11",
    f"""
with p as (select o_custkey % 200 as project_id, timestamp '2024-01-01' + (o_orderkey % 43200) * interval 1 minute as t, o_orderkey from orders),
h as (select * from v_history)
select p.project_id, {_t('p.t', '"at"')}, phase, type from p asof left join h on h.project_id = p.project_id and h.ts <= p.t""",
)
def state_as_of(v):
    points = v("orders").select(
        (F.col("o_custkey") % 200).alias("project_id"),
        F.expr("cast('2024-01-01' as timestamp) + (o_orderkey % 43200) * interval 1 minute").alias("at"),
    )
    history = v("v_history").withColumnRenamed("event_id", "seq")
    return _times(H.state_as_of(points, history, ["phase", "type"]), "at")


SNAPSHOT = "select path, arg_max(hash, event_id) as hash from v_snapshots where {} group by path"
EARLY, LATE = "ts < timestamp '2024-01-15'", "true"


DIFF = f"""
with a as ({SNAPSHOT.format(EARLY)}), b as ({SNAPSHOT.format(LATE)})
select path, case when a.hash is null then 'added' when b.hash is null then 'removed' else 'modified' end as change
from a full join b using (path) where a.hash is distinct from b.hash"""


@query("J12", DIFF)
def snapshot_diff(v):
    return H.snapshot_diff(_snapshot(v, EARLY), _snapshot(v, LATE))


def _snapshot(v, when: str):
    return v("v_snapshots").filter(F.expr(when)).groupBy("path").agg(F.max_by("hash", "event_id").alias("hash"))


@query("J12", DIFF)
def stored_snapshot_diff(v):
    """The same from stored snapshots, by their folder digests."""
    paths = []
    for when in (EARLY, LATE):
        snapshot = _snapshot(v, when)
        paths.append(scratch_path(snapshot.sparkSession, "snapshot"))
        SN.write_snapshot(snapshot, paths[-1])
    return SN.stored_snapshot_diff(snapshot.sparkSession, *paths)


@query(
    "J13",
    """
with recursive r as (
  select supersedes as id from v_decision_chains where status = 'accepted' and supersedes is not null
  union select d.supersedes from r join v_decision_chains d on d.decision_id = r.id where d.supersedes is not null)
select decision_id, project_id, phase from v_decision_chains where status = 'accepted' and decision_id not in (select id from r)""",
)
def effective_decisions(v):
    return H.effective_decisions(v("v_decision_chains")).select("decision_id", "project_id", "phase")


@query("U2", "select decision_id, phase, category, status from v_decisions where phase = '02' and category = 'technical'")
def decision_log(v):
    return H.decision_log(v("v_decisions"), "02", "technical").select("decision_id", "phase", "category", "status")


@query("U2", "select decision_id, phase, category, status from v_decisions where status = 'proposed'")
def pending_decisions(v):
    return H.decision_log(v("v_decisions"), pending=True).select("decision_id", "phase", "category", "status")


@query("U3", f"select issue_id, project_id, severity, {_t('created_at')} from v_issues where status = 'in-progress'")
def issue_list(v):
    return _times(H.issue_list(v("v_issues"), "in-progress"), "created_at").select("issue_id", "project_id", "severity", "created_at")


@query(
    "U3",
    """
select issue_id, case when l_orderkey is null then status else 'resolved' end as status, 'fixed in ' || l_orderkey as resolution
from (select issue_id, status, l_orderkey from v_issues left join (select distinct l_orderkey from lineitem where l_quantity > 45) on l_orderkey = issue_id)""",
)
def resolve_issues(v):
    updates = (
        v("lineitem").filter(F.col("l_quantity") > 45).select(F.col("l_orderkey").alias("issue_id")).distinct()
        .withColumn("resolved_at", F.lit("2024-02-01").cast("timestamp"))
        .withColumn("resolution", F.concat(F.lit("fixed in "), F.col("issue_id").cast("string")))
    )
    return H.resolve_issues(v("v_issues"), updates).select("issue_id", "status", "resolution")


@query(
    "U4",
    f"""
select project_id, event_id, from_phase, to_phase, {_t('ts')} from (
  select *, row_number() over (partition by project_id order by ts desc) as rn from v_handoffs where from_phase = '02') where rn = 1""",
)
def latest_handoff(v):
    out = H.latest_handoff(v("v_handoffs"), "02")
    return _times(out, "ts").select("project_id", "event_id", "from_phase", "to_phase", "ts")


@query("U4", f"select project_id, event_id, from_phase, to_phase, {_t('ts')} from v_handoffs")
def handoff_history(v):
    out = H.handoff_history(v("v_handoffs"))
    return _times(out, "ts").select("project_id", "event_id", "from_phase", "to_phase", "ts")


@query(
    "W6",
    """
select project_id, event_id, rank from (
  select project_id, event_id, row_number() over (partition by project_id order by ts desc, event_id desc) as rank from v_history) where rank <= 10""",
)
def recent_history(v):
    return H.recent_history(v("v_history")).select("project_id", "event_id", F.col("rank").cast("bigint").alias("rank"))


@query(
    "W7",
    """
with e as (select project_id, count(*) as have from v_history where ts < timestamp '2024-01-10' group by project_id),
n as (select project_id, event_id, row_number() over (partition by project_id order by ts) as k from v_history where ts >= timestamp '2024-01-10')
select project_id, event_id, k + coalesce(have, 0) as sequence from n left join e using (project_id)""",
)
def append_history(v):
    history, cut = v("v_history"), F.lit("2024-01-10").cast("timestamp")
    out = H.append_history(history.filter(F.col("ts") < cut), history.filter(F.col("ts") >= cut))
    return out.select("project_id", "event_id", "sequence")


def _labels(table: str, prefix: str, key: str) -> str:
    return f"""
select {key}, concat('{prefix}-', phase, '-', case when n < 1000 then lpad(cast(n as varchar), 3, '0') else cast(n as varchar) end) as label
from (select {key}, phase, row_number() over (partition by phase order by created_at, {key}) as n from {table})"""


@query("W8", _labels("v_issues", "I", "issue_id"))
def issue_ids(v):
    order = [F.col("created_at"), F.col("issue_id")]
    return H.assign_ids(v("v_issues"), "I", order).select("issue_id", "label")


@query(
    "W8",
    """
with e as (select phase, count(*) as have from v_issues where created_at < timestamp '1998-04-25' group by phase),
n as (select issue_id, phase, row_number() over (partition by phase order by created_at, issue_id) as k from v_issues where created_at >= timestamp '1998-04-25')
select issue_id, concat('I-', phase, '-', case when k + coalesce(have, 0) < 1000 then lpad(cast(k + coalesce(have, 0) as varchar), 3, '0') else cast(k + coalesce(have, 0) as varchar) end) as label
from n left join e using (phase)""",
)
def more_issue_ids(v):
    """New issues go on from the numbers of the stored ones."""
    issues, cut = v("v_issues"), F.lit("1998-04-25").cast("timestamp")
    order = [F.col("created_at"), F.col("issue_id")]
    known = H.assign_ids(issues.filter(F.col("created_at") < cut), "I", order)
    return H.assign_ids(issues.filter(F.col("created_at") >= cut), "I", order, stored_rows=known).select("issue_id", "label")


@query(
    "A10",
    f"""
with u as (select o_custkey as project_id, concat('0', o_orderkey % 5 + 1) as phase, max({{'at': o_orderdate, 's': case o_orderstatus when 'F' then 'completed' when 'O' then 'in-progress' else 'blocked' end}}) as u
  from orders where o_orderkey % 3 = 0 group by all),
p as (select v.project_id, v.phase, coalesce(u.s, status) as status, case when u.s = 'completed' then u.at end as completed_at from v_phases v left join u using (project_id, phase))
select project_id, phase, status, strftime(completed_at, {DUCK_FMT}) as completed_at, count(*) filter (status = 'completed') over w as completed_phases, count(*) over w as total_phases,
    cast(count(*) filter (status = 'completed') over w as double) / count(*) over w * 100 as progress
from p window w as (partition by project_id)""",
)
def set_phase_status(v):
    updates = v("orders").filter("o_orderkey % 3 = 0").select(
        F.col("o_custkey").alias("project_id"), F.expr("concat('0', cast(o_orderkey % 5 + 1 as string))").alias("phase"),
        F.expr("case o_orderstatus when 'F' then 'completed' when 'O' then 'in-progress' else 'blocked' end").alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("at"),
    )
    phases = v("v_phases").withColumn("completed_at", F.lit(None).cast("timestamp"))
    return _times(H.set_phase_status(phases, updates), "completed_at")


@query("W8", _labels("v_decisions", "D", "decision_id"))
def decision_ids(v):
    order = [F.col("created_at"), F.col("decision_id")]
    return H.assign_ids(v("v_decisions"), "D", order).select("decision_id", "label")


@query(
    "W9",
    f"""
select issue_id, severity, {_t('created_at')}, cast(list_position(['critical', 'high', 'medium', 'low'], severity) as bigint) as rank
from v_issues where status in ('open', 'in-progress')""",
)
def open_issues(v):
    return _times(H.open_issues(v("v_issues")), "created_at").select("issue_id", "severity", "created_at", "rank")


@query(
    "W10",
    f"""
select project_id, {_t('max(ts)', 'last_activity')}, max(ts) = (select max(ts) from v_history) as active from v_history group by project_id""",
)
def projects_by_activity(v):
    return _times(H.projects_by_activity(v("v_history")), "last_activity")


@query(
    "W11",
    f"""
with c as (select *, case when hash is distinct from lag(hash) over (partition by path order by ts, hash) then 1 else 0 end as changed from v_snapshots)
select path, event_id, hash, cast(sum(changed) over (partition by path order by ts, hash) as bigint) as version from c""",
)
def content_versions(v):
    return H.content_versions(v("v_snapshots")).select("path", "event_id", "hash", "version")
