"""Derived test views over the given tables, as SQL text for Spark and for DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# The point in time every retention or staleness query is asked for.
NOW = "2024-02-01 00:00:00"

# name -> SQL for both engines, or (SQL for Spark, SQL for DuckDB)
VIEWS: dict[str, str | tuple[str, str]] = {
    "v_files": """
select doc_id as file_id,
       concat(source, '/', lang, '/', cast(doc_id as string),
         case doc_id % 10 when 0 then '.pdf' when 1 then '.docx' when 2 then '.xlsx'
           when 3 then '.pptx' when 4 then '.PNG' when 5 then '.md' when 6 then '.tmp'
           when 7 then '.draft' when 8 then '.bak' else '' end) as path,
       case when doc_id % 97 = 0 then 0 else n_chars end as size,
       case when doc_id % 97 = 0 then '' else text end as content,
       cast('2024-01-01 00:00:00' as timestamp) + (doc_id * 7) % 44640 * interval 1 minute as mtime
from documents""",
    "v_pages": "select conv_id as doc_id, turn + 1 as page, text from conversations",
    "v_page_requests": (
        """
select conv_id * 10 + conv_id % 8 as request_id, conv_id as doc_id, split(case conv_id % 8
    when 0 then '3-4,1,1' when 1 then '2-99' when 2 then '5-2' when 3 then '0' when 4 then '1,a'
    when 5 then '1-2-3' when 6 then ' 2 , 1 - 2' else '1-3,2' end, ',') as ranges
from conversations where turn = 0""",
        """
select conv_id * 10 + conv_id % 8 as request_id, conv_id as doc_id, string_split(case conv_id % 8
    when 0 then '3-4,1,1' when 1 then '2-99' when 2 then '5-2' when 3 then '0' when 4 then '1,a'
    when 5 then '1-2-3' when 6 then ' 2 , 1 - 2' else '1-3,2' end, ',') as ranges
from conversations where turn = 0""",
    ),
    # every conversation is merged with the one three before it and then once more with itself
    "v_merges": """
select conv_id as merge_id, cast(0 as bigint) as pos, conv_id as doc_id from conversations where turn = 0
union all select conv_id, cast(1 as bigint), conv_id - 3 from conversations where turn = 0
union all select conv_id, cast(2 as bigint), conv_id from conversations where turn = 0""",
    "v_lines": (
        """
select doc_id, cast(pos as bigint) as pos, line from documents
lateral view posexplode(split(text, '\\n', -1)) t as pos, line""",
        """
select doc_id, unnest(generate_series(0, len(l) - 1)) as pos, unnest(l) as line
from (select doc_id, string_split(text, chr(10)) as l from documents)""",
    ),
    "v_batch_items": """
select l_orderkey as batch_id, cast(l_linenumber - 1 as bigint) as idx,
       l_partkey * 100000000 + l_suppkey as item,
       case when l_returnflag = 'R' then 'failure' else 'success' end as status,
       case when l_returnflag = 'R' then concat('Unsupported conversion type: ', l_linestatus) end as error
from lineitem""",
    # the items in the order they were shipped
    "v_batch_arrivals": """
select l_orderkey as batch_id, case when l_returnflag = 'R' then 'failure' else 'success' end as status, cast(l_shipdate as timestamp) as ts
from lineitem""",
    "v_task_events": """
select event_id as seq, user_id as task_id, cast(ts as timestamp) as ts,
       case event_type when 'signup' then 'PENDING' when 'view' then 'STARTED'
         when 'click' then 'PROGRESS' when 'purchase' then 'SUCCESS' else 'FAILURE' end as state,
       value as progress
from events""",
    "v_issues": """
select o_orderkey as issue_id, o_custkey as project_id, cast(o_orderdate as timestamp) as created_at,
       case substr(o_orderpriority, 1, 1) when '1' then 'critical' when '2' then 'high'
         when '3' then 'medium' else 'low' end as severity,
       case o_orderstatus when 'F' then 'resolved' when 'P' then 'in-progress' else 'open' end as status,
       concat('0', cast(o_orderkey % 5 + 1 as string)) as phase
from orders""",
    "v_decisions": """
select o_orderkey as decision_id, o_custkey as project_id, cast(o_orderdate as timestamp) as created_at,
       concat('0', cast(o_orderkey % 5 + 1 as string)) as phase,
       case o_orderkey % 4 when 0 then 'scope' when 1 then 'technical' when 2 then 'design' else 'process' end as category,
       case o_orderstatus when 'F' then 'accepted' when 'O' then 'proposed' else 'rejected' end as status,
       case when o_orderkey % 6 = 0 then o_orderkey - 3 end as supersedes
from orders""",
    # blocks of eight decisions, each superseding the one before it; every tenth block is a circle
    "v_decision_chains": """
select decision_id, project_id, phase, status,
       case when decision_id % 8 <> 0 then decision_id - 1 when decision_id % 80 = 0 then decision_id + 7 end as supersedes
from v_decisions""",
    "v_history": """
select user_id as project_id, cast(ts as timestamp) as ts, event_id, event_type as type,
       concat('0', cast(event_id % 5 + 1 as string)) as phase,
       concat('0', cast(event_id % 5 + 1 as string), '-', event_type, '-', cast(event_id % 40 as string), '.md') as artifact,
       case when event_type = 'purchase' then event_id % 30 end as decision_id
from events""",
    "v_features": """
select l_orderkey as project_id,
       l_linenumber * 10000000000000 + l_suppkey * 1000000000 + l_partkey as pos,
       concat('feature ', cast(l_partkey % 50 as string)) as description,
       case when l_linestatus = 'F' then true when l_returnflag = 'N' then null else false end as passes,
       case when l_suppkey % 7 = 0 then null else l_suppkey % 5 + 1 end as priority
from lineitem""",
    "v_cells": """
select c_custkey % 10 as doc_id, cast(floor(c_custkey / 10) as bigint) as rw, 0 as col,
       cast(c_custkey as string) as value, true as is_num from customer
union all select c_custkey % 10, cast(floor(c_custkey / 10) as bigint), 1, c_name, false from customer
union all select c_custkey % 10, cast(floor(c_custkey / 10) as bigint), 2,
       case when c_nationkey = 1 then null else cast(c_nationkey as string) end, true from customer
union all select c_custkey % 10, cast(floor(c_custkey / 10) as bigint), 3,
       case when c_custkey % 11 = 0 then '' else c_mktsegment end, false from customer""",
    "v_widths": """
select doc_id, col, cast((doc_id + col) % 9 as double) as width from v_cells group by doc_id, col""",
    "v_text_requests": """
select doc_id as project_id, case when doc_id % 3 = 0 then 'api' else 'webapp' end as type, text as description
from documents""",
    "v_placeholders": """
select file_id, path, size, case file_id % 61 when 0 then ' TODO: ' when 1 then 'Coming  soon...' when 2 then 'to do it' else content end as content
from v_files""",
    "v_artifacts": """
select user_id as project_id, concat('0', cast(event_id % 5 + 1 as string)) as phase,
       concat('out/0', cast(event_id % 5 + 1 as string),
         case event_id % 23 when 0 then '-handoff-out.json' when 1 then '-report.json' when 2 then '-notes.tmp'
           when 3 then '-Bad Name.md' else concat('-', event_type, '.md') end) as path,
       event_id
from events""",
    "v_handoffs": """
select event_id, user_id as project_id, concat('0', cast(event_id % 5 + 1 as string)) as from_phase,
       case when event_id % 17 = 0 then '' else concat('0', cast(event_id % 5 + 2 as string)) end as to_phase,
       case event_id % 13 when 0 then null when 1 then 'One. Two. Three.' when 2 then '   ' else concat('Did ', event_type, '. Next is review.') end as summary,
       case when event_id % 11 = 0 then 0 else 2 end as deliverables,
       case when event_id % 7 = 0 then '' else 'retry' end as suggested,
       cast(ts as timestamp) as ts
from events""",
    # each file is referenced under its own path or, for every ninth, under one that does not exist
    "v_refs": """
select path as ref_source, case when file_id % 9 = 0 then concat(path, '.old') when file_id % 4 = 0 then 'src0/en/1.docx' else path end as path
from v_files""",
    "v_phases": """
select o_custkey as project_id, concat('0', cast(o_orderkey % 5 + 1 as string)) as phase,
       case when sum(case when o_orderstatus = 'F' then 1 else 0 end) > 0 then 'completed'
            when sum(case when o_orderstatus = 'P' then 1 else 0 end) > 0 then 'in-progress' else 'pending' end as status
from orders group by o_custkey, concat('0', cast(o_orderkey % 5 + 1 as string))""",
    # up to three stored variants per id
    "v_stored": """
select cast(floor(file_id / 3) as bigint) as file_id, path, size, mtime from v_files""",
    # files and numbered reports, some in two spellings
    "v_names": """
select path from v_files
union select concat(source, '/', lang, '/', case when doc_id % 2 = 0 then 'Report-' else 'report-' end, cast(doc_id % 50 as string), '.md') from documents""",
    "v_project_files": """
select file_id % 25 as project_id, path, size, mtime, content from v_placeholders join (select file_id as id, mtime from v_files) t on id = file_id""",
    "v_project_refs": """
select file_id % 25 as project_id, case when file_id % 9 = 0 then concat(path, '.old') else path end as path from v_files where file_id % 7 <> 0""",
    "v_project_phases": "select distinct project_id % 25 as project_id, phase from v_phases where project_id % 3 = 0",
    "v_project_decisions": "select project_id % 25 as project_id, phase from v_decisions where status <> 'rejected' and decision_id % 200 < 20",
    "v_handoff_docs": """
select event_id, concat('{"version": "1.0", "from-phase": "', from_phase, '", "executive-summary": "', coalesce(summary, ''), '", "key-deliverables": ["a", "b"], ',
       '"open-issues": [{"issue": "slow", "suggested-action": "', suggested, '"}]', case when event_id % 50 = 0 then '' else '}' end) as doc
from v_handoffs""",
    "v_lookups": "select event_id as request_id, event_id % 500 as file_id from events",
    "v_merge_requests": (
        """
select event_id as merge_id, array(event_id % 500, user_id, 999999, event_id % 500) as file_ids from events""",
        """
select event_id as merge_id, [event_id % 500, user_id, 999999, event_id % 500] as file_ids from events""",
    ),
    "v_conversions": """
select event_id as request_id, case event_id % 13 when 0 then 'pdf_to_excel' when 1 then 'word_to_html' when 2 then 'jpg_to_pdf'
    when 3 then 'pptx_to_images' when 4 then 'png_to_pdf' when 5 then 'markdown_to_html' when 6 then 'pdf_to_word'
    when 7 then 'md_to_doc' else 'word_to_pdf' end as conversion_type
from events""",
    "v_results": """
select project_id, pos, description as name, case when pos % 3 = 0 then 'pass' else 'fail' end as status,
       case when pos % 3 <> 0 then 'broken' end as error
from v_features where passes is not null""",
    "v_tasks": """
select seq, task_id, state, case seq % 5 when 0 then 'failure' when 1 then null else 'success' end as result_status, seq % 7 <> 0 as has_data
from v_task_events""",
    "v_projects": """
select o_orderkey as project_id, o_custkey % 25 as owner, case o_orderkey % 7 when 0 then 'developing' when 1 then 'testing'
    when 2 then 'completed' when 3 then 'failed' when 4 then 'waiting_approval' when 5 then 'initializing' else 'deploying' end as status
from orders""",
    "v_requirements": """
select o_custkey as project_id, o_orderkey as seq, cast(floor(o_totalprice) as bigint) % 5 as priority,
       case when o_orderstatus = 'F' then 'processing' else 'pending' end as status
from orders""",
    # every event snapshots one of forty paths of its user; contents change now and then
    "v_snapshots": """
select concat(cast(user_id as string), '/', cast(event_id % 3 as string), '.md') as path, cast(ts as timestamp) as ts,
       concat('h', cast(cast(floor(value / 20) as bigint) as string)) as hash, event_id
from events""",
    "v_entries": (
        """
select event_id, user_id as project_id, cast(ts as timestamp) as ts, concat('0', cast(event_id % 5 + 1 as string)) as phase,
       array(concat('f', cast(event_id % 40 as string)), 'f0', concat('f', cast(user_id as string))) as files_affected
from events""",
        """
select event_id, user_id as project_id, ts, concat('0', cast(event_id % 5 + 1 as string)) as phase,
       [concat('f', cast(event_id % 40 as string)), 'f0', concat('f', cast(user_id as string))] as files_affected
from events""",
    ),
    "v_state_json": """
select event_id, case when event_id % 50 = 0 then replace(props, ':', '') else props end as doc from events""",
    "v_project_state": "select event_id % 25 as project_id, doc from v_state_json",
    "v_html_blocks": (
        """
select page_id as doc_id, cast(pos as bigint) as pos, m
from pages lateral view posexplode(regexp_extract_all(html, '<(?:h[1-6]|li|p)>[^<]*', 0)) t as pos, m""",
        """
select page_id as doc_id, unnest(generate_series(0, len(l) - 1)) as pos, unnest(l) as m
from (select page_id, regexp_extract_all(html, '<(?:h[1-6]|li|p)>[^<]*', 0) as l from pages)""",
    ),
    # every block with pos % 11 = 3 gets a fence line before it; even positions are fences or unused
    "v_md_lines": """
select doc_id, pos * 2 + 1 as pos,
       case when m like '<h%' then concat(repeat('#', cast(substr(m, 3, 1) as int)), ' ', substr(m, 5))
            when m like '<li>%' then concat('- ', substr(m, 5)) else substr(m, 4) end as line
from v_html_blocks
union all select doc_id, pos * 2, case when pos % 11 = 3 then '```' else '' end from v_html_blocks""",
    "v_blocks": """
select doc_id, pos, case when m like '<h%' then concat('Heading ', substr(m, 3, 1))
            when m like '<li>%' then 'List Bullet' when doc_id % 50 = 7 and pos = 2 then 'TOC Heading' else 'Normal' end as style,
       case when m like '<h%' then substr(m, 5) when m like '<li>%' then substr(m, 5) else substr(m, 4) end as text
from v_html_blocks""",
}


def register_table(spark: SparkSession, sf_dir: str, table: str, stream: bool = False) -> None:
    """Register one given parquet table as a temporary view, to be read at once or as a stream."""
    path = f"{sf_dir}/{table}.parquet"
    df = spark.read.parquet(path)
    if stream:
        # as a pattern, because a stream takes a plain path for a folder only
        df = spark.readStream.schema(df.schema).parquet(f"{sf_dir}/{table}.parque[t]")
    df.createOrReplaceTempView(table)


def _text(name: str, engine: int) -> str:
    sql = VIEWS[name]
    return sql if isinstance(sql, str) else sql[engine]


def _used(sql: str, engine: int) -> list[str]:
    """Derived views a statement needs, in order of definition."""
    wanted: set[str] = set()
    queue = [sql]
    while queue:
        for name in re.findall(r"\bv_\w+", queue.pop()):
            if name in VIEWS and name not in wanted:
                wanted.add(name)
                queue.append(_text(name, engine))
    return [name for name in VIEWS if name in wanted]


def view(spark: SparkSession, sf_dir: str, name: str, stream: bool = False) -> DataFrame:
    """A given table or a derived view as a DataFrame; times are read in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    needed = _used(name, 0)
    texts = [_text(n, 0) for n in needed] or [name]
    for table in TABLES:
        if any(re.search(rf"\b{table}\b", text) for text in texts):
            register_table(spark, sf_dir, table, stream)
    for n in needed:
        spark.sql(_text(n, 0)).createOrReplaceTempView(n)
    return spark.table(name)


class Source:
    """``source(name)`` is a table or view of one folder; ``source.stream(name)`` the same as a stream."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)

    def stream(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name, stream=True)


def duck_sql(sql: str) -> str:
    """Complete a DuckDB statement with the derived views it uses."""
    names = _used(sql, 1)
    if not names:
        return sql
    ctes = ",\n".join(f"{name} as ({_text(name, 1)})" for name in names)
    sql = sql.strip()
    if sql.lower().startswith("with recursive"):
        return f"with recursive {ctes},\n{sql[len('with recursive'):]}"
    if sql.lower().startswith("with "):
        return f"with {ctes},\n{sql[len('with '):]}"
    return f"with {ctes}\n{sql}"
