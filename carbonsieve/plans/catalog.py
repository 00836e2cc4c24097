"""Registered queries over the given tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import checks, entities, extract, review, runs, tables
from ..sources import schemas
from ..sources import tables as io
from .fixtures import frame, oracle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
YEAR = 2024


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = oracle(sql)
        return f

    return add


# ---- pieces of SQL that several oracles share ----------------------------------------------

NUM = "format('{{:,.0f}}', {0})"


def _sql_negative(label: str, col: str) -> str:
    return f"case when {col} < 0 then '{label} is negative (' || cast({col} as varchar) || ')' end"


def _sql_high(label: str, col: str, most: int) -> str:
    return f"case when {col} > {most} then '{label} implausibly high (' || {NUM.format(col)} || ')' end"


SQL_RANGE = (
    "nullif(concat_ws('; ', "
    + ", ".join(
        [
            _sql_negative("Scope 1", "scope_1"),
            _sql_high("Scope 1", "scope_1", 500000000),
            _sql_negative("Scope 2 (location)", "scope_2_location"),
            _sql_negative("Scope 2 (market)", "scope_2_market"),
            _sql_negative("Scope 3", "scope_3"),
            _sql_high("Scope 3", "scope_3", 2000000000),
            f"case when reporting_year < 2000 or reporting_year > {YEAR} then 'Reporting year out of range (' || reporting_year || ')' end",
        ]
    )
    + "), '')"
)
SQL_UNIT = "case when lower(unit) in ('kt co2e','kt','mt co2e','mt') then 'Unit is ''' || unit || ''' — values may not be in tonnes CO2e' end"
SQL_LOW = "case when confidence_score < 50 then 'Low confidence score (' || confidence_score || '/100)' end"
SQL_MISSING = (
    "'Missing: ' || nullif(concat_ws(', ', case when scope_1 is null then 'Scope 1' end, case when scope_2_location is null and scope_2_market is null then 'Scope 2' end, case when scope_3 is null then 'Scope 3' end), '')"
)


def _sql_yoy(label: str, col: str) -> str:
    prev = f"p_{col}"
    change = f"abs({col} - {prev}) / {prev}"
    return (
        f"case when reporting_year = p_year + 1 and {prev} > 0 and {col} <> 0 then case when {change} > 0.5 then '{label}: ' || format('{{:.0f}}%', ({change}) * 100) || "
        f"case when {col} > {prev} then ' increase' else ' decrease' end || ' vs ' || p_year || ' (' || {NUM.format(prev)} || ' -> ' || {NUM.format(col)} || ')' end end"
    )


SQL_SUITE = f"""with lagged as (
  select *, lag(reporting_year) over w p_year, lag(scope_1) over w p_scope_1, lag(scope_2_location) over w p_scope_2_location, lag(scope_3) over w p_scope_3
  from fx_records window w as (partition by company_id order by reporting_year, extraction_date, id)
), y as (
  select *, list_filter([{_sql_yoy("Scope 1", "scope_1")}, {_sql_yoy("Scope 2 (location)", "scope_2_location")}, {_sql_yoy("Scope 3", "scope_3")}], lambda x: x is not null) yoy from lagged
), a as (select *, case when review_status='pending' then {SQL_RANGE} end r1 from y),
b as (select *, case when review_status='pending' and r1 is null then {SQL_UNIT} end r2 from a),
c as (select *, case when review_status='pending' and r1 is null and r2 is null and len(yoy)=0 then {SQL_LOW} end r4 from b),
d as (select *, case when review_status='pending' and r1 is null and r2 is null and len(yoy)=0 and r4 is null then {SQL_MISSING} end r5 from c),
e as (select *, nullif(concat_ws('; ', r1, r2, nullif(array_to_string(yoy, '; '), ''), r4, r5), '') reason from d)
"""


def _single(reason: str) -> str:
    return f"""with r as (select *, case when review_status='pending' then {reason} end x from fx_records)
select id, case when x is not null then 'flagged' else review_status end as review_status,
 case when x is not null then concat_ws('; ', nullif(flag_reason, ''), x) else flag_reason end as flag_reason from r"""


def _records(spark: SparkSession, d: str) -> DataFrame:
    return frame(spark, d, "fx_records")


def _status(df: DataFrame) -> DataFrame:
    return df.select("id", "review_status", "flag_reason")


# ---- checks --------------------------------------------------------------------------------


@query(
    "check_suite",
    SQL_SUITE
    + "select id, company_id, reporting_year, case when reason is not null then 'flagged' else review_status end as review_status, case when reason is not null then concat_ws('; ', nullif(flag_reason,''), reason) else flag_reason end as flag_reason from e",
)
def check_suite(spark, d):
    """Q0-Q6, W1, T1-T7."""
    return checks.run_all_checks(_records(spark, d), YEAR).select("id", "company_id", "reporting_year", "review_status", "flag_reason")


@query(
    "check_counts",
    SQL_SUITE
    + """select count(r1) as range_flags, count(r2) as unit_flags, cast(sum(len(yoy)) as bigint) as yoy_flags, count(r4) as confidence_flags, count(r5) as missing_flags,
 count(*) filter (where reason is not null or review_status='flagged') as flagged, count(*) filter (where reason is null and review_status='pending') as pending from e""",
)
def check_counts(spark, d):
    """A3."""
    return checks.check_counts(_records(spark, d), YEAR)


@query("range_check", _single(SQL_RANGE))
def range_check(spark, d):
    """Q1 alone."""
    return _status(checks.single_check(_records(spark, d), checks.range_reason(YEAR)))


@query("unit_check", _single(SQL_UNIT))
def unit_check(spark, d):
    """Q2 alone."""
    return _status(checks.single_check(_records(spark, d), checks.unit_reason()))


@query(
    "yoy_check",
    SQL_SUITE
    + "select id, case when len(yoy)>0 then 'flagged' else review_status end as review_status, case when len(yoy)>0 then concat_ws('; ', nullif(flag_reason,''), array_to_string(yoy,'; ')) else flag_reason end as flag_reason from y",
)
def yoy_check(spark, d):
    """Q3 alone, W1."""
    return _status(checks.yoy_check(_records(spark, d)))


@query("low_confidence_check", _single(SQL_LOW))
def low_confidence_check(spark, d):
    """Q4, P6."""
    return _status(checks.single_check(_records(spark, d), checks.confidence_reason()))


@query("missing_check", _single(SQL_MISSING))
def missing_check(spark, d):
    """Q5."""
    return _status(checks.single_check(_records(spark, d), checks.missing_reason()))


# ---- names and entities --------------------------------------------------------------------

STOP_SQL = "['plc','ltd','limited','group','holdings','inc','corp','corporation','sa','se','nv','ag','the','of','and','&']"
ALLOWED_SQL = "('GB','IE','JE','GG','CH','ZA','AU','NL','LU')"


def _sql_words(col: str) -> str:
    return f"list_distinct(list_filter(list_transform(regexp_extract_all({col}, '[a-zA-Z0-9]+'), lambda w: lower(w)), lambda w: length(w) > 1 and not list_contains({STOP_SQL}, w)))"


SQL_CLEAN = "trim(case when regexp_extract(name, '\\(([^)]+)\\)', 1) <> '' then regexp_extract(name, '\\(([^)]+)\\)', 1) else name end)"
SQL_SCORED = f"""s1 as (select *, {_sql_words("search_name")} wa, {_sql_words("legal_name")} wb from cand),
s2 as (select *, case when len(wa)>0 and len(wb)>0 then len(list_intersect(wa,wb)) / greatest(len(wa),len(wb))::double else 0.0::double end similarity, coalesce(country in {ALLOWED_SQL}, false) ok from s1),
s3 as (select *, case when not ok then 'rejected' when similarity>=0.5 then 'high' when similarity>=0.3 then 'medium' else 'low' end confidence,
 nullif(concat_ws('; ', case when similarity<0.5 then 'Low name similarity (' || format('{{:.0f}}%', similarity*100) || '): searched ''' || search_name || ''', found ''' || legal_name || '''' end,
  case when not ok then 'Country ''' || country || ''' not in expected list for FTSE 100' end), '') flag_reason from s2),
best as (select * from s3 qualify row_number() over (partition by company_id order by case confidence when 'high' then 0 when 'medium' then 1 when 'low' then 2 else 3 end, similarity desc, query_no, pos, lei)=1)"""
SQL_GIVEN = f"with cand as (select company_id, search_name, query_no, pos, lei, legal_name, country from fx_candidates qualify row_number() over (partition by company_id, lei order by query_no, pos)=1), {SQL_SCORED}"
MATCH_COLS = ["company_id", "lei", "legal_name", "country", "similarity", "confidence", "flag_reason"]


@query(
    "name_queries",
    f"with c as (select id, name, {SQL_CLEAN} cleaned from fx_seed), v as (select id, cleaned, case when cleaned<>name then [name, name||' plc', cleaned, cleaned||' plc'] else [name, name||' plc'] end q from c) select id as company_id, cleaned, cast(unnest(range(len(q))) as int) as query_no, unnest(q) as query from v",
)
def name_queries(spark, d):
    """C1, C2."""
    seed = frame(spark, d, "fx_seed")
    return entities.queries_for(seed).select("company_id", t.clean_name(F.col("name")).alias("cleaned"), "query_no", "query")


@query("name_words", f"select id, array_to_string(list_sort({_sql_words('name')}), ' ') as words from fx_seed")
def name_words(spark, d):
    """C4."""
    return frame(spark, d, "fx_seed").select("id", F.array_join(F.array_sort(t.significant_words(F.col("name"))), " ").alias("words"))


@query(
    "candidates_scored",
    f"with cand as (select company_id, search_name, query_no, pos, lei, legal_name, country from fx_candidates), {SQL_SCORED} select company_id, query_no, pos, lei, similarity, confidence, flag_reason from s3",
)
def candidates_scored(spark, d):
    """C5-C7, P8, U1, U2, T1."""
    return entities.scored(frame(spark, d, "fx_candidates")).select("company_id", "query_no", "pos", "lei", "similarity", "confidence", "flag_reason")


@query("candidates_first", "select company_id, lei, query_no, pos from fx_candidates qualify row_number() over (partition by company_id, lei order by query_no, pos)=1")
def candidates_first(spark, d):
    """A7."""
    return entities.first_per_lei(frame(spark, d, "fx_candidates")).select("company_id", "lei", "query_no", "pos")


@query("active_hits", "select company_id, query_no, pos, lei from fx_candidates where status='ACTIVE' qualify row_number() over (partition by company_id, query_no order by pos)<=2")
def active_hits(spark, d):
    """P7, with two hits per query as these have three at most."""
    return entities.active_hits(frame(spark, d, "fx_candidates"), most=2).select("company_id", "query_no", "pos", "lei")


@query("active_hits_five", "select company_id, query_no, pos, lei from fx_hits where status='ACTIVE' qualify row_number() over (partition by company_id, query_no order by pos)<=5")
def active_hits_five(spark, d):
    """P7 as it is: ten hits per query, of which the first five active ones count."""
    return entities.active_hits(frame(spark, d, "fx_hits")).select("company_id", "query_no", "pos", "lei")


@query("best_lei", SQL_GIVEN + " select company_id, lei, legal_name, country, similarity, confidence, flag_reason from best where confidence<>'rejected'")
def best_lei(spark, d):
    """K4 over A7, given candidates."""
    return entities.resolve(frame(spark, d, "fx_candidates")).select(*MATCH_COLS)


@query(
    "best_lei_registry",
    f"""with st as (select id, name, unnest({_sql_words("name")}) tok from fx_seed), rt as (select lei, unnest({_sql_words("legal_name")}) tok from fx_registry where status='ACTIVE'),
pr as (select distinct st.id, rt.lei from st join rt using (tok)),
cand as (select pr.id company_id, s.name search_name, 0 query_no, 0 pos, r.lei, r.legal_name, r.country from pr join fx_seed s on s.id=pr.id join fx_registry r on r.lei=pr.lei), {SQL_SCORED}
select company_id, lei, legal_name, country, similarity, confidence, flag_reason from best where confidence<>'rejected'""",
)
def best_lei_registry(spark, d):
    """J5, K4 with ties by LEI."""
    return entities.resolve_by_registry(frame(spark, d, "fx_seed"), frame(spark, d, "fx_registry")).select(*MATCH_COLS)


@query("unseen_companies", "select name, id from fx_seed where name not in (select distinct p_name from part)")
def unseen_companies(spark, d):
    """J1."""
    known = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_name").alias("name"))
    return entities.unseen(frame(spark, d, "fx_seed"), known).select("name", "id")


SQL_COMPANIES = """co as (select id, name, case when id%3=0 then 'LEI-OLD' || id end as lei, case when id%3=0 then 'old' end as lei_legal_name, null::varchar as lei_country, null::varchar as lei_confidence, null::varchar as lei_flag_reason, 'pending' as lei_review_status from fx_seed)"""


def _companies_with_lei(spark: SparkSession, d: str) -> DataFrame:
    seed = frame(spark, d, "fx_seed").select("id", "name")
    old = F.col("id") % 3 == 0
    given = seed.withColumns({"lei": F.when(old, F.concat(F.lit("LEI-OLD"), F.col("id").cast("string"))), "lei_legal_name": F.when(old, "old")})
    return schemas.with_missing_columns(given, schemas.COMPANIES, schemas.DEFAULTS["companies"])


@query(
    "lei_backfill",
    SQL_GIVEN
    + f""", m as (select * from best where confidence<>'rejected'), {SQL_COMPANIES}
select co.id, case when f then m.lei else co.lei end as lei, case when f then m.legal_name else co.lei_legal_name end as lei_legal_name, case when f then m.country else co.lei_country end as lei_country,
 case when f then m.confidence else co.lei_confidence end as lei_confidence, case when f then m.flag_reason else co.lei_flag_reason end as lei_flag_reason,
 case when f then case when m.confidence='high' then 'approved' else 'pending' end else co.lei_review_status end as lei_review_status
from (select co.*, m.company_id is not null and co.lei is null f from co left join m on m.company_id=co.id) co left join m on m.company_id=co.id""",
)
def lei_backfill(spark, d):
    """J6, C17, S9."""
    companies = _companies_with_lei(spark, d)
    return entities.backfill(companies, entities.resolve(frame(spark, d, "fx_candidates"))).select("id", *entities.MATCH)


@query("lei_lacking", f"with {SQL_COMPANIES} select id, name from co where lei is null")
def lei_lacking(spark, d):
    """P4."""
    return entities.lacking_lei(_companies_with_lei(spark, d)).select("id", "name")


@query(
    "lei_display",
    f"with {SQL_COMPANIES} select id, name, case when lei is null then 'Not found' else 'red' end as lei_band, 'unknown' as lei_tier, coalesce(lei_legal_name, '—') as legal_name_text, '—' as country_text, 'pending' as lei_status from co",
)
def lei_display(spark, d):
    """P10."""
    return review.company_display(_companies_with_lei(spark, d))


@query(
    "lei_display_resolved",
    """select id, case when coalesce(lei,'')='' then 'Not found' else case lei_confidence when 'high' then 'green' when 'medium' then 'yellow' else 'red' end end as lei_band,
 coalesce(nullif(lei_confidence,''),'unknown') as lei_tier, coalesce(nullif(lei_legal_name,''),'—') as legal_name_text, coalesce(nullif(lei_country,''),'—') as country_text, lei_review_status as lei_status
from (LEI_BACKFILL)""".replace("LEI_BACKFILL", SQL["lei_backfill"]),
)
def lei_display_resolved(spark, d):
    """P10 after resolution: all of its bands."""
    companies = _companies_with_lei(spark, d)
    return review.company_display(entities.backfill(companies, entities.resolve(frame(spark, d, "fx_candidates")))).drop("name")


@query(
    "registry_flatten",
    """select k, lei, legal_name, case when country<>'' then country else case when k%2=0 then 'JE' else '' end end as country from fx_registry""",
)
def registry_flatten(spark, d):
    """Registry answers as JSON, with a head office where the seat is unknown."""
    r = frame(spark, d, "fx_registry")
    head = F.when(F.col("k") % 2 == 0, F.struct(F.lit("JE").alias("country")))
    entity = F.struct(F.struct(F.col("legal_name").alias("name")).alias("legalName"), F.struct("country").alias("legalAddress"), head.alias("headquartersAddress"))
    record = F.to_json(F.struct(F.col("lei").alias("id"), F.struct(entity.alias("entity")).alias("attributes")))
    return entities.flatten_registry(r.select("k", record.alias("record"))).select("k", "lei", "legal_name", "country")


# ---- sources and search --------------------------------------------------------------------

SQL_TYPE = "case when ends_with(split_part(lower(url),'?',1),'.pdf') then 'pdf' when ends_with(split_part(lower(url),'?',1),'.xlsx') or ends_with(split_part(lower(url),'?',1),'.xls') then 'excel' else 'html' end"
SQL_RANKED = f"with ty as (select *, {SQL_TYPE} source_type from fx_search), rk as (select *, cast(row_number() over (partition by company_id order by case when source_type='pdf' then 0 else 1 end, pos) as int) as rank from ty)"


@query("source_types", f"select id, {SQL_TYPE} as source_type from fx_sources")
def source_types(spark, d):
    """P1, C18."""
    return frame(spark, d, "fx_sources").select("id", t.source_type(F.col("url")).alias("source_type"))


@query("search_ranked", SQL_RANKED + " select company_id, pos, rank, source_type from rk")
def search_ranked(spark, d):
    """K1."""
    return extract.ranked_results(frame(spark, d, "fx_search")).select("company_id", "pos", "rank", "source_type")


@query("search_chosen", SQL_RANKED + " select company_id, url, source_type from rk where rank=1")
def search_chosen(spark, d):
    """K5."""
    return extract.chosen_source(frame(spark, d, "fx_search")).select("company_id", "url", "source_type")


@query(
    "search_errors", "select id as company_id, name, 'No search results found for ''' || name || '''.' as error from fx_companies where id not in (select company_id from fx_search)"
)
def search_errors(spark, d):
    """K5's failures."""
    return extract.source_errors(frame(spark, d, "fx_companies"), frame(spark, d, "fx_search"))


@query(
    "search_prompts",
    SQL_RANKED + " select company_id, string_agg(rank || '. Title: ' || coalesce(nullif(title,''),'(no title)') || chr(10) || '   URL: ' || url, chr(10) order by rank) as prompt from rk group by 1",
)
def search_prompts(spark, d):
    """E8."""
    return extract.search_prompts(frame(spark, d, "fx_search"))


@query("search_queries", "select id as company_id, name || ' greenhouse gas emissions scope 1 2 3 sustainability report annual report ESG' as query from fx_companies")
def search_queries(spark, d):
    """C11."""
    return extract.search_queries(frame(spark, d, "fx_companies"))


@query(
    "archive_keys",
    "with n as (select id, replace(replace(lower(name),' ','_'),'&','and') n from fx_seed) select id, 'sources/'||n||'/report.pdf' as report, 'sources/'||n||'/2023_report.pdf' as dated, 'screenshots/'||n||'/page_7.png' as screenshot from n",
)
def archive_keys(spark, d):
    """C3, S8."""
    n = F.col("name")
    return frame(spark, d, "fx_seed").select("id", t.report_key(n).alias("report"), t.report_key(n, F.lit(2023)).alias("dated"), t.screenshot_key(n, F.lit(7)).alias("screenshot"))


@query("companies_chosen", "select id, name from fx_companies where id in (1, 5, 9, 57)")
def companies_chosen(spark, d):
    """By a list of ids, of which one is unknown."""
    return extract.chosen_companies(frame(spark, d, "fx_companies"), [1, 5, 9, 57]).select("id", "name")


# ---- documents -----------------------------------------------------------------------------

SQL_TABLES = r"""with l as (select doc_id, unnest(string_split(text,chr(10))) line, generate_subscripts(string_split(text,chr(10)),1) n from fx_doc_pages),
p as (select *, n - row_number() over(partition by doc_id order by n) g from l where starts_with(ltrim(line),'|')),
b as (select doc_id,g,min(n) n, string_agg(line,chr(10) order by n) md from p group by 1,2),
tb as (select doc_id, cast(row_number() over(partition by doc_id order by n)-1 as int) table_index, md from b where regexp_matches(md,'\|[\s\-:]+\|'))"""


@query("markdown_tables", SQL_TABLES + " select doc_id, table_index, md as markdown from tb")
def markdown_tables(spark, d):
    """E1, E2, S5."""
    return tables.markdown_tables(frame(spark, d, "fx_doc_pages"))


@query(
    "table_prompts",
    SQL_TABLES + " select doc_id, string_agg('TABLE ' || table_index || ':' || chr(10) || substr(md,1,600) || case when length(md)>600 then '...' else '' end, chr(10)||chr(10) order by table_index) as prompt from tb group by 1",
)
def table_prompts(spark, d):
    """E8, C9."""
    return extract.table_prompts(tables.markdown_tables(frame(spark, d, "fx_doc_pages")))


@query(
    "sheet_tables",
    """with r as (select doc_id, sheet_no, row_no, '| ' || string_agg(coalesce(value,''), ' | ' order by col_no) || ' |' line, count(*) w from fx_cells group by 1,2,3),
n as (select *, row_number() over (partition by doc_id, sheet_no order by row_no) k, count(*) over (partition by doc_id, sheet_no) c from r)
select doc_id, sheet_no, string_agg(case when k=1 then line || chr(10) || '| --- | --- | --- |' else line end, chr(10) order by k) as markdown from n where c>1 group by 1,2""",
)
def sheet_tables(spark, d):
    """E4, S6."""
    return tables.sheet_tables(frame(spark, d, "fx_cells"))


@query(
    "html_text_lines",
    r"""with bare as (select page_id, regexp_replace(html, '(?is)<!--.*?-->|<style.*?</style>|<script.*?</script>|<nav.*?</nav>|<footer.*?</footer>|<header.*?</header>', '<br>', 'g') as h from pages),
parts as (select page_id, list_transform(regexp_split_to_array(h, '<[^>]*>'), lambda s: trim(regexp_replace(replace(replace(replace(s, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), ' ' || chr(9) || chr(10) || chr(13))) as p from bare)
select page_id, substring(array_to_string(list_filter(p, lambda s: s <> ''), chr(10)), 1, 50000) as text from parts""",
)
def html_text_lines(spark, d):
    """The text of whole pages, capped as the feature has it. The SQL splits at tags and
    decodes the character references that these pages have in their text."""
    return spark.read.parquet(f"{d}/pages.parquet").select("page_id", tables.html_text(F.col("html")).alias("text"))


@query(
    "html_text_fragments",
    "select p_partkey as page_id, p_name || chr(10) || p_type || ' & ' || p_brand || chr(10) || 'Size' || chr(10) || p_size || chr(10) || 'end' as text from part",
)
def html_text_fragments(spark, d):
    """E5: the text of pages with what is dropped (scripts, styles, menus, heads and feet)."""
    p = spark.read.parquet(f"{d}/part.parquet")
    html = F.concat(
        F.lit("<html><body><header>top <b>x</b></header><nav><a href='#'>menu</a></nav><h1> "), "p_name", F.lit(" </h1><script>var a = '<p>no</p>';</script><p>"), "p_type", F.lit(" &amp; "), "p_brand",
        F.lit("</p><style>p {}</style><ul><li>Size<li> "), F.col("p_size").cast("string"), F.lit("</ul>\n<div>end</div><footer>foot</footer></body></html>"),
    )
    return p.select(F.col("p_partkey").alias("page_id"), tables.html_text(html).alias("text"))


@query(
    "sheet_tables_sparse",
    """with g as (select distinct doc_id, sheet_no, row_no, c.i as col_no from fx_cells cross join (select 0 i union all select 1 union all select 2) c),
f as (select g.*, x.value from g left join fx_cells x on x.doc_id=g.doc_id and x.sheet_no=g.sheet_no and x.row_no=g.row_no and x.col_no=g.col_no and (g.row_no+g.col_no+g.doc_id)%3<>0),
r as (select doc_id, sheet_no, row_no, '| ' || string_agg(coalesce(value,''), ' | ' order by col_no) || ' |' line from f group by 1,2,3),
k as (select doc_id, sheet_no, row_no from fx_cells where (row_no+col_no+doc_id)%3<>0 group by 1,2,3),
n as (select r.*, row_number() over (partition by r.doc_id, r.sheet_no order by r.row_no) k, count(*) over (partition by r.doc_id, r.sheet_no) c from r join k on k.doc_id=r.doc_id and k.sheet_no=r.sheet_no and k.row_no=r.row_no)
select doc_id, sheet_no, string_agg(case when k=1 then line || chr(10) || '| --- | --- | --- |' else line end, chr(10) order by k) as markdown from n where c>1 group by 1,2""",
)
def sheet_tables_sparse(spark, d):
    """E4 where a third of all cells, in the header, the middle and at the end, are not stored."""
    return tables.sheet_tables(frame(spark, d, "fx_cells").where("(row_no + col_no + doc_id) % 3 <> 0"))


@query(
    "html_tables",
    "select p_partkey as page_id, 0 as table_index, '| Item | Value |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || p_name || ' | ' || p_size || ' |' || chr(10) || '| ' || p_type || ' |  |' as markdown from part",
)
def html_tables(spark, d):
    """E3, on pages with one table each: an empty row, a short row and a long one."""
    p = spark.read.parquet(f"{d}/part.parquet")
    html = F.concat(
        F.lit("<html><body><p>x</p><table><tr><th>Item</th><th>Value</th></tr><tr><td></td><td> </td></tr><tr><td>"), "p_name", F.lit("</td><td>"), F.col("p_size").cast("string"),
        F.lit("</td><td>cut</td></tr><tr><td> "), "p_type", F.lit("<tr></table><table><tr><td></td></tr></table></body>"),
    )
    return tables.html_tables(p.select(F.col("p_partkey").alias("page_id"), html.alias("html")))


# ---- responses to records ------------------------------------------------------------------

SQL_TOP = SQL_TABLES + """, cnt as (select doc_id, cast(count(*) as int) n from tb group by 1),
rr as (select doc_id, cast(unnest(range(4)) as int) pos, unnest(cast(json_extract(response, '$.ranked') as json[])) r from fx_rank_responses),
rk as (select doc_id, pos, cast(r->>'index' as int) as idx, cast(r->>'score' as int) as score from rr),
tp as (select *, cast(row_number() over (partition by doc_id order by pos) as int) tr from (select * from rk where score>=30) qualify tr<=3),
pk as (select tp.*, case when a>=0 and a<n then a end as table_index from (select tp.*, n, case when idx<0 then idx+n else idx end a from tp left join cnt using (doc_id)) tp),
er as (select doc_id, table_index, case when response='not json' then null else response end rsp from fx_extract_responses),
ps as (select doc_id, table_index, rsp, cast(json_extract(rsp,'$.emissions') as json[]) em from er),
fr as (select pk.doc_id, pk.table_index, ps.em, ps.rsp from pk join ps on ps.doc_id=pk.doc_id and ps.table_index=pk.table_index where len(ps.em)>0 qualify row_number() over (partition by pk.doc_id order by pk.tr)=1)"""


def _picked(spark: SparkSession, d: str) -> DataFrame:
    found = tables.markdown_tables(frame(spark, d, "fx_doc_pages"))
    top = extract.top_tables(extract.rankings(frame(spark, d, "fx_rank_responses")))
    return extract.pick_tables(top, extract.table_counts(found))


def _results(spark: SparkSession, d: str) -> DataFrame:
    return extract.first_result(_picked(spark, d), extract.parsed_responses(frame(spark, d, "fx_extract_responses")))


@query("rankings", SQL_TOP + " select doc_id, pos, idx as index, score from rk")
def rankings(spark, d):
    """C12."""
    return extract.rankings(frame(spark, d, "fx_rank_responses"))


@query("top_tables", SQL_TOP + " select doc_id, pos, tr as try, table_index from pk")
def top_tables(spark, d):
    """P5, K2, J7."""
    return _picked(spark, d).select("doc_id", "pos", "try", "table_index")


@query("first_results", SQL_TOP + " select doc_id, table_index, cast(len(em) as int) as entries from fr")
def first_results(spark, d):
    """K3, C13."""
    return _results(spark, d).select("doc_id", "table_index", F.size("result.emissions").alias("entries"))


SQL_ENTRIES = """, en as (select doc_id, unnest(em) e, rsp from fr where len(list_filter(em, lambda e: e->>'reporting_year' is null))=0)"""


@query(
    "extracted_records",
    SQL_TOP
    + SQL_ENTRIES
    + """ select doc_id, cast(e->>'reporting_year' as int) as reporting_year, cast(e->>'scope_1' as double) as scope_1, cast(e->>'scope_3' as double) as scope_3, coalesce(e->>'unit','tonnes CO2e') as unit,
 rsp->>'methodology_notes' as methodology_notes, cast(rsp->>'confidence_score' as int) as confidence_score, 'pending' as review_status from en""",
)
def extracted_records(spark, d):
    """E6, C14."""
    flat = extract.flatten_results(_results(spark, d).select("doc_id", "result"))
    return flat.select("doc_id", "reporting_year", "scope_1", "scope_3", "unit", "methodology_notes", "confidence_score", "review_status")


@query("incomplete_documents", SQL_TOP + " select doc_id from fr where len(list_filter(em, lambda e: e->>'reporting_year' is null))>0")
def incomplete_documents(spark, d):
    """E6's failures."""
    return extract.incomplete_results(_results(spark, d)).select("doc_id")


@query(
    "results_or_errors",
    SQL_TOP
    + """, tx as (select doc_id, em from ps where table_index=0 and len(em)>0 and doc_id%4=0), dc as (select p_partkey doc_id, p_name nm from part)
select dc.doc_id, case when fr.doc_id is not null then cast(len(fr.em) as int) else cast(len(tx.em) as int) end as entries,
 case when fr.doc_id is null and tx.doc_id is null then 'No emissions data found for ' || nm end as error from dc left join fr using (doc_id) left join tx using (doc_id)""",
)
def results_or_errors(spark, d):
    """A table's result, else for html pages that of the text, else an error."""
    docs = spark.read.parquet(f"{d}/part.parquet").select(
        F.col("p_partkey").alias("doc_id"), F.col("p_name").alias("name"), F.when(F.col("p_partkey") % 4 == 0, "html").otherwise("pdf").alias("source_type")
    )
    text = extract.parsed_responses(frame(spark, d, "fx_extract_responses").where("table_index = 0"))
    both = extract.with_text_fallback(docs, _results(spark, d), text)
    return both.select("doc_id", F.when(F.col("result").isNotNull(), F.size("result.emissions")).alias("entries"), "error")


@query(
    "units_to_tonnes",
    """with f as (select *, case when lower(unit) in ('kt','kt co2e') then 1000.0::double when lower(unit) in ('mt','mt co2e') then 1000000.0::double end k from fx_records)
select id, case when k is not null then scope_1*k else scope_1 end as scope_1, case when k is not null then scope_2_location*k else scope_2_location end as scope_2_location,
 case when k is not null then scope_2_market*k else scope_2_market end as scope_2_market, case when k is not null then scope_3*k else scope_3 end as scope_3, case when k is not null then 'tonnes CO2e' else unit end as unit from f""",
)
def units_to_tonnes(spark, d):
    """C15."""
    return extract.to_tonnes(_records(spark, d)).select("id", "scope_1", "scope_2_location", "scope_2_market", "scope_3", "unit")


# ---- review --------------------------------------------------------------------------------


@query(
    "review_listing",
    "select r.id, c.name as company, r.reporting_year, s.url from fx_records r join fx_companies c on c.id=r.company_id left join fx_sources s on s.id=r.source_id where r.review_status='pending'",
)
def review_listing(spark, d):
    """J2, P2, K6."""
    all_rows = review.listing(review.with_status(_records(spark, d), "pending"), frame(spark, d, "fx_companies"), frame(spark, d, "fx_sources"))
    return review.in_listing_order(all_rows).select("id", "company", "reporting_year", "url")


@query(
    "review_export",
    """select c.name as "Company", reporting_year as "Year", scope_1 as "Scope 1", scope_2_location as "Scope 2 (loc)", scope_3 as "Scope 3", confidence_score as "Confidence", review_status as "Status" from fx_records r join fx_companies c on c.id=r.company_id""",
)
def review_export(spark, d):
    """The rows of the CSV export."""
    return io.export_frame(review.overview(_records(spark, d), frame(spark, d, "fx_companies")))


@query(
    "prior_years",
    """with pr as (select a.id, b.id bid, b.reporting_year, row_number() over (partition by a.id order by b.reporting_year desc, b.extraction_date desc, b.id desc) n from fx_records a join fx_records b on a.company_id=b.company_id and b.reporting_year<a.reporting_year)
select r.id, coalesce(string_agg(pr.reporting_year || ':' || pr.bid, ',' order by pr.n desc), '') as prior from fx_records r left join pr on pr.id=r.id and pr.n<=3 group by r.id""",
)
def prior_years(spark, d):
    """J4, W2."""
    shown = F.transform("prior", lambda p: F.concat(p["reporting_year"].cast("string"), F.lit(":"), p["id"].cast("string")))
    return review.prior_years(_records(spark, d)).select("id", F.array_join(shown, ",").alias("prior"))


@query(
    "prior_display",
    f"""with pr as (select a.id, b.id bid, b.reporting_year, b.scope_1, b.scope_2_location, b.scope_3, row_number() over (partition by a.id order by b.reporting_year desc, b.extraction_date desc, b.id desc) n from fx_records a join fx_records b on a.company_id=b.company_id and b.reporting_year<a.reporting_year)
select id, bid as prior_id, reporting_year as prior_year, {", ".join(f"case when {c} <> 0 then {NUM.format(c)} else '—' end as {c}_text" for c in ("scope_1", "scope_2_location", "scope_3"))} from pr where n<=3""",
)
def prior_display(spark, d):
    """Prior years as they are listed, where a zero shows as a dash."""
    return review.prior_display(review.prior_years(_records(spark, d)))


@query("lei_key_clashes", "select lei, count(*)::bigint as n from fx_resolved where lei is not null group by 1 having count(*)>1")
def lei_key_clashes(spark, d):
    """A LEI is one company's. Here several names may have found the same entity."""
    return schemas.key_violations(frame(spark, d, "fx_resolved"), ["lei"])


@query("record_key_clashes", "select company_id, reporting_year, extraction_date, count(*)::bigint as n from fx_extracted group by 1,2,3 having count(*)>1")
def record_key_clashes(spark, d):
    """The key of a record, with all three of its columns."""
    rows = frame(spark, d, "fx_extracted").withColumn("extraction_date", F.col("extraction_date").cast("timestamp_ntz"))
    return schemas.key_violations(rows, ["company_id", "reporting_year", "extraction_date"])


@query("run_failures", "select ord, name || ': ' || error as line from fx_runs where error is not null")
def run_failures(spark, d):
    """A4: the log of a run as rows."""
    return runs.failures(frame(spark, d, "fx_runs"))


def _sql_shown(col: str) -> str:
    return f"case when {col} is not null then {NUM.format(col)} else '—' end"


@query(
    "record_display",
    f"""select id, {_sql_shown("scope_1")} as scope_1_text, {_sql_shown("scope_2_location")} as scope_2_location_text, {_sql_shown("scope_2_market")} as scope_2_market_text, {_sql_shown("scope_3")} as scope_3_text,
 case when confidence_score is null then null when confidence_score>=70 then 'green' when confidence_score>=40 then 'yellow' else 'red' end as confidence_band from fx_records""",
)
def record_display(spark, d):
    """C16, P9, T2."""
    return review.display(_records(spark, d)).select("id", *[f"{c}_text" for c in review.SCOPE_LABELS], "confidence_band")


@query(
    "scopes_long",
    """select id, 'Scope 1' as scope, scope_1 as value, coalesce(nullif(unit,''),'—') as unit from fx_records union all select id, 'Scope 2 (location)', scope_2_location, coalesce(nullif(unit,''),'—') from fx_records
union all select id, 'Scope 2 (market)', scope_2_market, coalesce(nullif(unit,''),'—') from fx_records union all select id, 'Scope 3', scope_3, coalesce(nullif(unit,''),'—') from fx_records""",
)
def scopes_long(spark, d):
    """E7."""
    return review.scopes_long(_records(spark, d))


@query(
    "status_counts",
    "with s as (select unnest(['pending','approved','rejected','flagged']) status) select status, count(r.id) as n from s left join fx_records r on r.review_status=status group by 1 union all select 'total', count(*) from fx_records",
)
def status_counts(spark, d):
    """A1."""
    return review.status_counts(_records(spark, d))


@query(
    "status_report",
    "select (select count(*) from fx_companies) as n_companies, count(*) as n_records, count(*) filter (where review_status='pending') as pending, count(*) filter (where review_status='flagged') as flagged, count(*) filter (where review_status='approved') as approved from fx_records",
)
def status_report(spark, d):
    """A2."""
    return review.status_report(frame(spark, d, "fx_companies"), _records(spark, d))


def _sql_edit(col: str) -> str:
    return f"case when ed.record_id is not null then case when ed.new_{col}>0 then ed.new_{col} end else r.{col} end as {col}"


@query(
    "review_decisions",
    f"""with st as (select record_id, action from fx_decisions where action<>'edit' qualify row_number() over (partition by record_id order by decided_at desc, decision_id desc)=1),
rv as (select record_id, max(decided_at) last_at from fx_decisions where action in ('approve','reject') group by 1),
ed as (select * from fx_decisions where action='edit' qualify row_number() over (partition by record_id order by decided_at desc, decision_id desc)=1),
nt as (select record_id, string_agg('; Review note: ' || note, '' order by decided_at, decision_id) notes from fx_decisions where action='edit' and note<>'' group by 1)
select r.id, {", ".join(_sql_edit(c) for c in ("scope_1", "scope_2_location", "scope_2_market", "scope_3"))},
 coalesce(case st.action when 'approve' then 'approved' when 'reject' then 'rejected' when 'flag' then 'flagged' end, r.review_status) as review_status,
 case when rv.last_at is not null then 'reviewer' end as reviewed_by, rv.last_at as reviewed_at,
 case when nt.notes is not null then coalesce(r.flag_reason,'') || nt.notes else r.flag_reason end as flag_reason
from fx_records r left join st on st.record_id=r.id left join rv on rv.record_id=r.id left join ed on ed.record_id=r.id left join nt on nt.record_id=r.id""",
)
def review_decisions(spark, d):
    """R1-R3, J8."""
    rows = schemas.with_missing_columns(_records(spark, d), schemas.RECORDS, schemas.DEFAULTS["records"])
    out = review.apply_decisions(rows, frame(spark, d, "fx_decisions"))
    return out.select("id", *review.SCOPE_LABELS, "review_status", "reviewed_by", "reviewed_at", "flag_reason")


# ---- keys, runs, schemas -------------------------------------------------------------------


@query("record_key_violations", "select company_id, reporting_year, count(*) as n from fx_records group by 1,2 having count(*)>1")
def record_key_violations(spark, d):
    """A6, on two of the three columns of the key, which clash here."""
    return schemas.key_violations(_records(spark, d), ["company_id", "reporting_year"])


@query(
    "run_account",
    "select count(*) as total_companies, count(*) filter (where error is null) as successful, count(error) as failed, cast(0 as bigint) as skipped, 'completed' as status, string_agg(name || ': ' || error, chr(10) order by ord) as error_log from fx_runs",
)
def run_account(spark, d):
    """A4."""
    return runs.account(frame(spark, d, "fx_runs"))


@query(
    "company_outcomes",
    """with sv as (select r.company_id, count(*) n, max(s.url) u, max(confidence_score) c from fx_records r left join fx_sources s on s.id=r.source_id group by 1)
select co.id as company_id, coalesce(n,0) as records, u as source_url, c as confidence, case when n is null then 'No emissions data found for ' || name end as error, case when n is null then 'failed' else 'success' end as status from fx_companies co left join sv on sv.company_id=co.id""",
)
def company_outcomes(spark, d):
    """A5."""
    companies, records = frame(spark, d, "fx_companies"), _records(spark, d)
    urls = frame(spark, d, "fx_sources").select(F.col("id").alias("source_id"), F.col("url").alias("source_url"))
    saved = records.select("company_id", "source_id", "confidence_score").join(urls, "source_id", "left")
    none = companies.join(records.select(F.col("company_id").alias("id")), "id", "left_anti")
    errors = none.select(F.col("id").alias("company_id"), F.concat(F.lit("No emissions data found for "), "name").alias("error"))
    return runs.outcomes(companies, saved, errors).select("company_id", "records", "source_url", "confidence", "error", "status")


@query("latest_run", "select c_custkey as id, o_orderdate as started_at from (select o_custkey c_custkey, o_orderdate, o_orderkey from orders order by o_orderdate desc, o_orderkey desc limit 1)")
def latest_run(spark, d):
    """K7: every order as a run; of the latest day the one with the largest key."""
    starts = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("started_at"), "o_orderkey")
    return review.latest_run(starts, "o_orderkey").select("id", "started_at")


@query(
    "schema_evolution",
    "select id, name, ticker, null::varchar as lei, null::varchar as lei_legal_name, null::varchar as lei_country, null::varchar as lei_confidence, null::varchar as lei_flag_reason, 'pending' as lei_review_status from fx_companies",
)
def schema_evolution(spark, d):
    """S9, S2."""
    full = schemas.conform(frame(spark, d, "fx_companies"), schemas.COMPANIES, schemas.DEFAULTS["companies"])
    return full.select("id", "name", "ticker", *entities.MATCH)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


from . import catalog_storage  # noqa: E402, F401  (registers its queries)
