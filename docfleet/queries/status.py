"""Queries on batches, tasks, projects and features."""

from pyspark.sql import functions as F

from docfleet.operators import status as S
from docfleet.plans.views import NOW
from docfleet.queries import query


def _now():
    return F.lit(NOW).cast("timestamp")



@query(
    "A1",
    """
select batch_id, count(*) as total, count(*) filter (status = 'success') as completed, count(*) filter (status = 'failure') as failed
from v_batch_items group by batch_id""",
)
def batch_summary(v):
    return S.batch_summary(v("v_batch_items"))


@query(
    "A1",
    """
select doc_id as batch_id, page // 10000 as part,
    string_agg(concat('{"index":', page, ',"status":"', case when length(text) > 300 then 'success"}' else 'failure","error":"short"}' end), chr(10) order by page) as results
from v_pages group by all""",
)
def batch_results(v):
    long = F.length("text") > 300
    items = v("v_pages").select(
        F.col("doc_id").alias("batch_id"),
        F.col("page").alias("idx"),
        F.when(long, "success").otherwise("failure").alias("status"),
        F.when(~long, "short").alias("error"),
    )
    return S.batch_results(items)


@query(
    "W1",
    """
with p as (select *, row_number() over (partition by batch_id order by idx, item, status, error) as position,
                  count(*) over (partition by batch_id) as total from v_batch_items)
select batch_id, idx, item, status, error, position, total, cast(floor(cast(position as double) / total * 100) as bigint) as progress from p""",
)
def batch_progress(v):
    return S.batch_progress(v("v_batch_items"), ("idx", "item", "status", "error"))


@query(
    "A2",
    """
with l as (select *, row_number() over (partition by task_id order by ts desc, seq desc) as rn from v_task_events),
ids as (select event_id as ask, event_id % 200 as task_id from events)
select ask, i.task_id, case when state is null or state = 'PENDING' then 'pending' else state end as status,
    case when state = 'SUCCESS' then concat('r', seq) end as result, case when state = 'FAILURE' then concat('e', seq) end as error,
    case when state in ('STARTED', 'PROGRESS') then progress end as progress
from ids i left join l on l.task_id = i.task_id and rn = 1""",
)
def task_status(v):
    seq = F.col("seq").cast("string")
    events = v("v_task_events").withColumn("result", F.concat(F.lit("r"), seq)).withColumn("error", F.concat(F.lit("e"), seq))
    ids = v("events").select(F.col("event_id").alias("ask"), (F.col("event_id") % 200).alias("task_id"))
    return S.task_status(ids, events)


@query(
    "A3",
    """
select *, case when state = 'SUCCESS' and result_status is distinct from 'success' then 'failure' when state = 'SUCCESS' then 'success'
        when state = 'FAILURE' then 'failure' else lower(state) end as effective,
    case when state <> 'SUCCESS' then 'Result not found' when result_status is null then 'Result is empty'
        when result_status <> 'success' then 'Conversion failed' when not has_data then 'No converted file data' else 'ok' end as download
from v_tasks""",
)
def effective_status(v):
    return S.effective_status(v("v_tasks"))


@query(
    "A4",
    """
select task_id, count(*) as total, count(*) filter (state = 'PENDING') as pending, count(*) filter (state in ('STARTED', 'PROGRESS')) as running,
    count(*) filter (state in ('SUCCESS', 'FAILURE')) as completed
from v_task_events group by task_id""",
)
def state_counts(v):
    states = {"pending": ("PENDING",), "running": ("STARTED", "PROGRESS"), "completed": ("SUCCESS", "FAILURE")}
    return S.state_counts(v("v_task_events"), ("task_id",), states)


@query(
    "A5",
    """
select owner, count(*) as total, count(*) filter (status = 'completed') as completed, count(*) filter (status = 'failed') as failed,
    count(*) filter (status in ('developing', 'testing')) as in_progress, count(*) filter (status = 'waiting_approval') as waiting_approval
from v_projects group by owner""",
)
def project_counts(v):
    return S.project_counts(v("v_projects"), ("owner",))


@query(
    "A6",
    """
select project_id, count(*) as total, count(*) filter (passes) as completed, count(*) filter (passes is not true) as remaining,
    cast(count(*) filter (passes) as double) / count(*) * 100 as progress
from v_features group by project_id""",
)
def feature_progress(v):
    return S.feature_progress(v("v_features"))


@query(
    "A6",
    """
with p as (select project_id, cast(count(*) filter (passes) as double) / count(*) * 100 as progress from v_features group by project_id)
select o_orderkey as project_id, coalesce(progress, cast(o_orderkey % 100 as double)) as progress from orders left join p on project_id = o_orderkey""",
)
def update_progress(v):
    projects = v("orders").select(
        F.col("o_orderkey").alias("project_id"), (F.col("o_orderkey") % 100).cast("double").alias("progress")
    )
    return S.update_progress(projects, v("v_features"))


def _tested(v):
    return v("v_features").select(
        "project_id", "pos", F.col("description").alias("name"), F.col("passes").alias("passed"),
        F.concat(F.lit("failed: "), "description").alias("error"),
    )


@query(
    "A7",
    """
select project_id, count(*) as total, count(*) filter (passes) as passed, count(*) filter (passes is not true) as failed,
    bool_and(coalesce(passes, false)) as all_passed
from v_features group by project_id""",
)
def test_summary(v):
    return S.test_summary(_tested(v))


@query("A7", "select project_id, pos, description as name, concat('failed: ', description) as error from v_features where passes is not true")
def test_errors(v):
    return S.test_errors(_tested(v))


@query(
    "W2",
    """
select project_id, seq, priority, status from (
  select *, row_number() over (partition by project_id order by priority desc, seq) as rn from v_requirements where status = 'pending') where rn = 1""",
)
def next_pending(v):
    return S.next_pending(v("v_requirements"))


@query(
    "W3",
    """
select project_id, pos, description, passes, priority from (
  select *, row_number() over (partition by project_id order by coalesce(priority, 5), pos) as rn from v_features where passes is not true) where rn = 1""",
)
def next_feature(v):
    return S.next_feature(v("v_features"))


STUCK = """
with t as (
  select task_id, max({'ts': ts, 'seq': seq}) filter (state = 'STARTED') as s, max({'ts': ts, 'seq': seq}) filter (state in ('SUCCESS', 'FAILURE')) as e
  from v_task_events group by task_id),
o as (select task_id, (epoch_us(timestamp '2024-01-30 12:00:00') - epoch_us(s.ts)) / 1e6 as seconds from t where s is not null and (e is null or s > e))
select task_id, seconds, case when seconds > 3600 then 'hard' else 'soft' end as "limit" from o where seconds > 3000"""


@query("ST4", STUCK)
def stuck_tasks(v):
    return S.stuck_tasks(v("v_task_events"), F.lit("2024-01-30 12:00:00").cast("timestamp"))
