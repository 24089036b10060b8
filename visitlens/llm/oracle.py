"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

_OP3 = """with d as (select doc_id, sha256(coalesce(text, '')) as h from documents)
select doc_id, max(doc_id) over (partition by h) as keep_id, count(*) over (partition by h) as group_size,
  doc_id = max(doc_id) over (partition by h) as kept, h as text_sha256 from d"""

# The three lines themselves stand for a window; a repeated window's first place stays.
_OP10 = r"""with d as (select doc_id, text, string_split(text, chr(10)) as ls from documents),
l as (select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as i from d),
w as (select doc_id, i, [line, lead(line) over g, lead(line, 2) over g] as w, lead(i, 2) over g as has
  from l window g as (partition by doc_id order by i)),
later as (select doc_id, i from (select doc_id, i, row_number() over (partition by w order by doc_id, i) as n
  from w where has is not null and trim(array_to_string(w, '')) <> '') where n > 1),
cut as (select distinct doc_id, i + k as i from later, (values (0), (1), (2)) as t(k)),
kept as (select l.doc_id, string_agg(case when cut.i is null then l.line end, chr(10) order by l.i) as text,
  count(*) as n_lines, count(cut.i) as n_removed
  from l left join cut on l.doc_id = cut.doc_id and l.i = cut.i group by l.doc_id)
select doc_id, case when n_removed = n_lines then '' else text end as text, n_lines, n_removed,
  sha256(case when n_removed = n_lines then '' else text end) as text_sha256 from kept"""

ORACLE_SQL = {"op3_exact_duplicates": _OP3, "op10_line_windows": _OP10}
