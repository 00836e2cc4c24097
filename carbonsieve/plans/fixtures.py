"""Tables of the disclosure jobs, derived from the given tables by SQL.

Every view is written once, in a dialect that ``duck`` turns into DuckDB's by spelling.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "fx_companies": "select c_custkey as id, c_name as name, concat('C',cast(c_custkey as string)) as ticker from customer where c_custkey%50<>7",
    "fx_sources": """select page_id as id, page_id div 5 as company_id, concat(url, case when page_id%5=1 then '/report.PDF?x=1' when page_id%5=2 then '/d.xlsx' when page_id%5=3 then '/r.pdf#p=2' else '' end) as url,
 concat('Source ',cast(page_id as string)) as title from pages""",
    "fx_search": "select company_id, id as pos, url, title from fx_sources",
    "fx_records": """select o_orderkey as id, o_custkey as company_id, cast(year(o_orderdate)+20 as int) as reporting_year,
 case when o_orderkey%13=0 then null when o_orderkey%97=1 then -o_totalprice*100 when o_orderkey%101=2 then o_totalprice*10000 else o_totalprice end as scope_1,
 case when o_orderkey%7=0 then null when o_orderkey%89=3 then -5.0D else o_totalprice*0.5D end as scope_2_location,
 case when o_orderkey%5=0 then null else o_totalprice*0.25D end as scope_2_market,
 case when o_orderkey%11=0 then null else o_totalprice*(case when o_orderkey%53=4 then 100000 else 8 end) end as scope_3,
 case when o_orderkey%17=5 then 'kt CO2e' when o_orderkey%19=6 then 'Mt' when o_orderkey%23=7 then null else 'tonnes CO2e' end as unit,
 case when o_orderkey%29=8 then null else cast(o_orderkey*37%101 as int) end as confidence_score,
 case when o_orderkey%10=0 then 'approved' when o_orderkey%10=1 then 'rejected' when o_orderkey%20=2 then 'flagged' else 'pending' end as review_status,
 case when o_orderkey%20=2 then 'manual' end as flag_reason,
 o_orderkey%250 as source_id, o_orderdate as extraction_date from orders""",
    "fx_seed": """select name, min(k) as id from (select p_partkey k, case when p_partkey%9=0 then concat('X (',p_name,')') when p_partkey%9=1 then concat(p_name,' Group')
 when p_partkey%9=2 then concat(p_name,' ',p_brand) else p_name end as name from part) t group by name""",
    "fx_registry": """select p_partkey as k, concat('LEI',lpad(cast(p_partkey as string),17,'0')) as lei,
 concat(p_name,' ',p_type,case when p_partkey%3=0 then ' Holdings plc' when p_partkey%3=1 then ' Ltd' else '' end) as legal_name,
 case p_size%6 when 0 then 'GB' when 1 then 'IE' when 2 then 'CH' when 3 then 'US' when 4 then '' else 'NL' end as country,
 case when p_partkey%10=9 then 'INACTIVE' else 'ACTIVE' end as status from part""",
    "fx_candidates": """select s.id as company_id, s.name as search_name, q.query_no, q.pos, r.lei, r.legal_name, r.country, r.status from fx_seed s cross join
 (select 0 query_no,0 pos,1 m,0 o union all select 0,1,7,13 union all select 0,2,3,4 union all select 1,0,1,0 union all select 1,1,11,5) q
 join fx_registry r on r.k=(s.id*q.m+q.o)%(select count(*) from part)""",
    "fx_hits": """select s.id as company_id, cast(q.pos%2 as int) as query_no, cast(q.pos div 2 as int) as pos, r.lei, r.status from fx_seed s cross join
 (select a.i*4+b.i as pos from (select 0 i union all select 1 union all select 2 union all select 3 union all select 4) a cross join (select 0 i union all select 1 union all select 2 union all select 3) b) q
 join fx_registry r on r.k=(s.id*3+q.pos*7)%(select count(*) from part)""",
    "fx_doc_pages": """select p_partkey as doc_id, 0 as page_no, concat('About ',p_name,chr(10),'| item | ',p_type,' |',chr(10),'| --- | --- |',chr(10),'| ',p_brand,' | ',cast(p_size as string),' |',chr(10),
 'Middle',chr(10),'| lone | line |',chr(10),'Outro',
 case when p_partkey%2=0 then concat(chr(10),'  | a | b |',chr(10),'  | c | d |') else '' end,
 case when p_partkey%3=0 then concat(chr(10),'| x | ',p_name,chr(10),'| y | z',chr(10),'end') else '' end) as text from part""",
    "fx_rank_responses": """select p_partkey as doc_id, concat('{"ranked":[{"index":1,"score":',cast(p_size*2 as string),'},{"index":0,"score":',cast(100-p_size*2 as string),'},{"index":5,"score":40},{"index":-1,"score":30}]}') as response from part""",
    "fx_extract_responses": """select p_partkey as doc_id, t.i as table_index, case when (p_partkey+t.i)%5=0 then '{"emissions":[],"methodology_notes":"","confidence_score":10}'
 when (p_partkey+t.i)%41=7 then 'not json'
 else concat('{"emissions":[{"reporting_year":',cast(2015+p_partkey%8 as string),',"scope_1":',cast(p_retailprice as string),',"scope_3":null,"unit":"kt CO2e"},{',
 case when p_partkey%17=3 then '' else concat('"reporting_year":',cast(2016+p_partkey%8 as string),',') end,'"scope_1":',cast(p_size as string),'}],"methodology_notes":"note","confidence_score":',cast(p_size*2 as string),'}') end as response
 from part cross join (select 0 i union all select 1 union all select 2) t""",
    "fx_cells": """select p_partkey div 100 as doc_id, 0 as sheet_no, cast(p_partkey%100 as int) as row_no, c.i as col_no,
 case c.i when 0 then p_name when 1 then p_brand else case when p_partkey%7=0 then null else cast(p_size as string) end end as value
 from part cross join (select 0 i union all select 1 union all select 2) c""",
    "fx_resolved": "select p_partkey as id, p_name as name, case when p_partkey%11<>0 then concat('LEI',lpad(cast(p_partkey div 3 * (p_partkey%2) + p_partkey * (1-p_partkey%2) as string),17,'0')) end as lei from part",
    "fx_extracted": "select o_orderkey as id, o_custkey div 10 as company_id, cast(year(o_orderdate)+20 as int) as reporting_year, date_trunc('month', o_orderdate) as extraction_date from orders",
    "fx_decisions": """select event_id as decision_id, event_id%3000 as record_id, ts as decided_at,
 case event_type when 'click' then 'approve' when 'error' then 'reject' when 'view' then 'flag' else 'edit' end as action,
 value-20 as new_scope_1, value*2 as new_scope_2_location, value*3 as new_scope_2_market, value-200 as new_scope_3,
 case when event_type='signup' then concat('note ',cast(event_id as string)) else '' end as note from events""",
    "fx_runs": """select c_custkey as ord, c_name as name, case when c_custkey%10=3 then concat('No search results found for ', c_name, '.') end as error from customer""",
}


def needed(text: str) -> list[str]:
    """The views that a query uses, those they use first."""
    found: list[str] = []

    def visit(name: str) -> None:
        for other in VIEWS:
            if other != name and re.search(rf"\b{other}\b", VIEWS[name]):
                visit(other)
        if name not in found:
            found.append(name)

    for name in VIEWS:
        if re.search(rf"\b{name}\b", text):
            visit(name)
    return found


def duck(text: str) -> str:
    out = re.sub(r"(\d+\.\d+)D\b", r"\1::double", text)
    return re.sub(r"\bas string\)", "as varchar)", out).replace(" div ", " // ")


def oracle(body: str) -> str:
    """A DuckDB statement: the views it needs, then ``body`` (which may open with its own WITH)."""
    views = ",\n".join(f"{n} as ({duck(VIEWS[n])})" for n in needed(body))
    own = body.strip()
    if re.match(r"(?i)with\b", own):
        return f"with {views}, {own[4:].strip()}" if views else own
    return f"with {views}\n{own}" if views else own


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame over the tables in a folder.

    The tables go in as paths: ``parquet.`path` ``. Nothing is registered in the session."""
    sql = "with " + ",\n".join(f"{n} as ({VIEWS[n]})" for n in needed(name)) + f" select * from {name}"
    at = lambda m: f"{m[1]} parquet.`{sf_dir}/{m[2]}.parquet`"
    return spark.sql(re.sub(r"\b(from|join) (part|customer|orders|pages|events)\b", at, sql))
