"""Queries on pages, blocks, lines and cells."""

from pyspark.sql import functions as F

from docfleet.functions import constants as K
from docfleet.functions import markdown as M
from docfleet.operators import documents as D
from docfleet.operators import search as X
from docfleet.plans.runtime import scratch_path
from docfleet.queries import query

WS = K.BLANKS
NONBLANK_LINES = f"""
select doc_id, row_number() over (partition by doc_id order by pos) as page, line as text
from v_lines where regexp_matches(line, '[^{WS}]')"""


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{WS}]+|[{WS}]+$', '', 'g')"


@query("T1", NONBLANK_LINES)
def paginate_nonblank(v):
    return D.paginate_nonblank(v("documents"))


@query(
    "T2",
    """
select doc_id, page // 10000 as part,
       string_agg(concat('--- Page ', page, ' ---', chr(10), chr(10), text), chr(10) order by page) as text
from v_pages group by all""",
)
def assemble_pages(v):
    return D.assemble_pages(v("v_pages"))


@query(
    "T3",
    "select doc_id, page // 10000 as part, string_agg(text, '<hr/>' order by page) as text from v_pages group by all",
)
def join_pages(v):
    return D.join_pages(v("v_pages"))


RANGES = f"""
with items as (
  select request_id, doc_id, unnest(generate_series(0, len(ranges) - 1)) as range_pos, unnest(ranges) as item
  from v_page_requests),
parsed as (
  select *, case
      when regexp_matches(item, '^[{WS}]*[+]?[0-9]+[{WS}]*$') then [cast(trim(item) as bigint), cast(trim(item) as bigint)]
      when regexp_matches(item, '^[{WS}]*[+]?[0-9]+[{WS}]*-[{WS}]*[+]?[0-9]+[{WS}]*$')
        then [cast(trim(split_part(item, '-', 1)) as bigint), cast(trim(split_part(item, '-', 2)) as bigint)] end as b
  from items)"""


@query(
    "T4",
    RANGES
    + """
, failed as (select distinct request_id from parsed where b is null)
select p.request_id, row_number() over (partition by p.request_id order by range_pos, page) as out_page,
       p.doc_id, page, text
from parsed p join v_pages g on g.doc_id = p.doc_id and g.page between p.b[1] and p.b[2]
where p.request_id not in (select request_id from failed)""",
)
def select_pages(v):
    return D.select_pages(v("v_pages"), v("v_page_requests"))


@query(
    "T4",
    RANGES
    + """
select request_id, case when count(*) filter (b is null) > 0 then 'failure' else 'success' end as status,
       'invalid page range: ' || min_by(item, range_pos) filter (b is null) as error
from parsed group by request_id""",
)
def check_page_ranges(v):
    return D.check_page_ranges(v("v_page_requests"))


@query(
    "T5",
    """
select merge_id, row_number() over (partition by merge_id order by pos, page) as out_page, m.doc_id, page, text
from v_merges m join v_pages p on p.doc_id = m.doc_id""",
)
def merge_documents(v):
    return D.merge_documents(v("v_pages"), v("v_merges"))


@query(
    "T6",
    """
select page_id, unnest(generate_series(0, len(l) - 1)) as index, unnest(l) as target
from (select page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) as l from pages)""",
)
def extract_embedded(v):
    return D.extract_embedded(v("pages"))


BLOCKS = f"""
with counted as (
  select *, line like '```%' as fence,
         sum(case when line like '```%' then 1 else 0 end) over (partition by doc_id order by pos) % 2 = 1 as inside
  from v_md_lines),
kinds as (
  select *, case when fence then case when inside then 'open' else 'close' end when inside then 'code'
      when line like '#%' then 'heading' when line like '- %' or line like '* %' then 'bullet'
      else 'paragraph' end as kind
  from counted),
blocks as (
  select doc_id, pos, kind,
      case when kind = 'heading' then cast(least(length(regexp_extract(line, '^#+')), 6) as int) end as level,
      case when kind = 'heading' then {_strip("regexp_replace(line, '^#+', '')")} else line end as text
  from kinds)"""


@query("T7", BLOCKS + " select * from blocks where kind not in ('open', 'close')")
def classify_markdown(v):
    return D.classify_markdown(v("v_md_lines"))


@query(
    "T8",
    f"""
with styled as (
  select *, contains(lower(style), 'heading') as h, {_strip("replace(lower(style), 'heading', '')")} as rest from v_blocks),
levels as (
  select *, case when h and rest = '' then 1 when h then try_cast(rest as int) end as level from styled),
docs as (
  select doc_id, min(rest) filter (h and level is null) as bad,
      string_agg(case when h then repeat('#', level) || ' ' || text else text end || chr(10), chr(10) order by pos) as md
  from levels group by doc_id)
select doc_id, cast(0 as bigint) as part, case when bad is null then md end as markdown,
       'invalid heading level: ' || bad as error
from docs""",
)
def render_markdown(v):
    return D.render_markdown(v("v_blocks"))


HTML = (
    BLOCKS
    + """
, near as (
  select *, lag(kind) over w as before, lead(kind) over w as after,
      replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') as t
  from blocks window w as (partition by doc_id order by pos)),
pieces as (
  select doc_id, pos, case
      when kind = 'heading' then concat('<h', level, '>', t, '</h', level, '>')
      when kind = 'bullet' then concat(case when before is distinct from 'bullet' then '<ul>' || chr(10) else '' end,
           '<li>', substr(t, 3), '</li>', case when after is distinct from 'bullet' then chr(10) || '</ul>' else '' end)
      when kind = 'open' then concat('<pre><code>', case when after is null then chr(10) || '</code></pre>' else '' end)
      when kind = 'close' then '</code></pre>'
      when kind = 'code' then concat(t, case when after is null then chr(10) || '</code></pre>' else '' end)
      when t <> '' then concat('<p>', t, '</p>') end as piece
  from near)
select doc_id, cast(0 as bigint) as part, string_agg(piece, chr(10) order by pos) as html
from pieces where piece is not null group by doc_id"""
)


@query("T9", HTML)
def render_html(v):
    return D.render_html(v("v_md_lines"))


@query("T9", HTML.replace("cast(0 as bigint) as part, ", ""))
def render_html_of_texts(v):
    """The same HTML from whole texts, inside one row each."""
    lines = v("v_md_lines").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("l"))
    text = F.array_join(F.transform("l", lambda x: x["line"]), "\n")
    return lines.select("doc_id", M.text_to_html(text).alias("html"))


@query(
    "T10",
    """
select doc_id, rw, string_agg(coalesce(value, ''), '|' order by col) as cells
from v_cells where rw > 0 group by doc_id, rw""",
)
def sheet_rows(v):
    return D.sheet_rows(v("v_cells")).select("doc_id", "rw", F.array_join("values", "|").alias("cells"))


@query(
    "T11",
    """
with used as (
  select doc_id, min(rw) + 1 as min_row, max(rw) + 1 as max_row, min(col) + 1 as min_col, max(col) + 1 as max_col
  from v_cells where value is not null group by doc_id)
select u.doc_id, min_row, max_row, cast(min_col as bigint) as min_col, cast(max_col as bigint) as max_col,
       (select sum(case when w.width is null or w.width = 0 then 8.0 else w.width end)
        from generate_series(0, u.max_col - 1) g(c) left join v_widths w on w.col = g.c and w.doc_id = u.doc_id) as total_width
from used u""",
)
def sheet_used_range(v):
    return D.sheet_used_range(v("v_cells"), v("v_widths"))


QUALITY = f"""
with p as ({NONBLANK_LINES}),
c as (select doc_id, page, length({_strip("text")}) as text_length, page % 3 as images from p)"""


def _pages_with_images(v):
    return D.paginate_nonblank(v("documents")).withColumn("images", F.col("page") % 3)


@query(
    "T12",
    QUALITY
    + f"""
select doc_id, page, text_length, images, concat_ws('; ',
       case when text_length < 10 then '{K.MSG_LITTLE_TEXT}' end,
       case when images = 0 and text_length < 50 then '{K.MSG_MAYBE_EMPTY}' end) as issues
from c""",
)
def page_quality(v):
    return D.page_quality(_pages_with_images(v)).withColumn("issues", F.array_join("issues", "; "))


@query(
    "T12",
    QUALITY
    + """
select doc_id, count(*) as pages, count(*) filter (text_length < 10 or (images = 0 and text_length < 50)) as pages_with_issues,
       count(*) filter (text_length < 10) as little_text,
       count(*) filter (images = 0 and text_length < 50) as maybe_empty
from c group by doc_id""",
)
def document_quality(v):
    return D.document_quality(_pages_with_images(v))


@query(
    "T13",
    "select path from v_files where contains(path, '/en/') and contains(content, 'the')",
)
def search_content(v):
    return D.search_content(v("v_files"), "the", "/en/")


PATTERNS = ("the", "que les", "tion. ", "é", "on", "zzzzzz", "public license")


@query(
    "T13",
    f"""
select pattern, path from v_files join (select unnest([{', '.join(f"'{p}'" for p in PATTERNS)}]) as pattern) p on contains(content, pattern)""",
)
def search_index(v):
    """An index of all files is written once and asked for patterns, two of them too short for it."""
    files = v("v_files").select("path", "content")
    spark = files.sparkSession
    path = scratch_path(spark, "index")
    X.write_search_index(files, path)
    out = None
    for pattern in PATTERNS:
        hits = X.search_index(spark, path, pattern).select(F.lit(pattern).alias("pattern"), "path")
        out = hits if out is None else out.union(hits)
    return out


@query("T14", r"select path from v_files where regexp_matches(path, '/[^/]*1[^/]*\.[^/]$|/[^/]*1[^/]*\.md$')")
def list_matching(v):
    return D.list_matching(v("v_files"), "*1*.md")


@query(
    "T15",
    """
select count(*) as checked, count(*) filter (n > 20) as complex, count(*) filter (n > 20) < 5 as passed
from (select len(string_split(content, chr(10))) as n from v_files
      where path like '%.md' or path like '%.docx')""",
)
def complex_files(v):
    return D.complex_files(v("v_files"), ("md", "docx"), max_lines=20)


def _fixed_features(items, first: int, condition: str) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    return " union all ".join(
        f"select project_id, cast({first} + {i} + {condition} as bigint) as pos, {quote(c)} as category, {quote(d)} as description, "
        f"{quote('; '.join(s))} as steps, {p} as priority from v_text_requests"
        + (" where type = 'api'" if items is K.API_FEATURES else "")
        for i, (c, d, s, p) in enumerate(items)
    )


_SHIFT = "case when type = 'api' then 3 else 0 end"


@query(
    "T16",
    f"""
with own as (
  select doc_id, {_strip("line")} as description, row_number() over (partition by doc_id order by pos) as n
  from v_lines where regexp_matches(line, '[^{WS}]'))
select *, false as passes from (
  {_fixed_features(K.API_FEATURES, 0, "0")} union all {_fixed_features(K.BASE_FEATURES, 0, _SHIFT)}
  union all select project_id, 9 + n + {_SHIFT}, 'functional', own.description, '', 1
  from own join v_text_requests on project_id = doc_id)""",
)
def explode_features(v):
    return D.explode_features(v("v_text_requests")).withColumn("steps", F.array_join("steps", "; "))
