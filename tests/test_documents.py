import pytest

from carbonsieve.operators import extract, tables
from carbonsieve.sources import schemas
from carbonsieve.sources import tables as io
from carbonsieve.streaming import rowlevel


def test_piped_runs():
    assert tables.piped_runs("x\n| a |\n| b |\ny") == ["| a |\n| b |"]
    assert tables.piped_runs("| a | b |") == []
    assert tables.piped_runs("| a |  | b |") == ["| a |  | b |"]
    assert tables.piped_runs("| a\n| b") == []
    assert tables.piped_runs("t\n  | a |\n | b |") == ["  | a |\n | b |"]
    assert tables.piped_runs(None) == []


def test_tables_are_numbered_over_pages(spark):
    pages = spark.createDataFrame([(1, 1, "| c |\n| d |"), (1, 0, "| a |\n| b |\n\n| e |\n| f |"), (2, 0, None)], schemas.DOC_PAGES)
    got = [tuple(r) for r in tables.markdown_tables(pages).orderBy("doc_id", "table_index").collect()]
    assert got == [(1, 0, "| a |\n| b |"), (1, 1, "| e |\n| f |"), (1, 2, "| c |\n| d |")]


HTML = "<table><tr><th>A</th><th>B</th></tr><tr><td></td><td> </td></tr><tr><td>1</td></tr><tr><td>2</td><td>3</td><td>4</td></tr></table>"


def test_html_tables(spark):
    def one(html):
        rows = tables.html_tables(spark.createDataFrame([(1, html)], "page_id long, html string")).orderBy("table_index").collect()
        return [r["markdown"] for r in rows]

    assert one(HTML) == ["| A | B |\n| --- | --- |\n| 1 |  |\n| 2 | 3 |"]
    assert one("<table></table>") == [] == one(None)
    assert one("<table><tr><td>a<td>b &amp; c<tr><td>d</table>") == ["| a | b & c |\n| --- | --- |\n| d |  |"]
    nested = one("<table><tr><td>x<table><tr><td>y</td></tr></table></td></tr></table>")
    assert nested[1] == "| y |\n| --- |" and "y" in nested[0]


def test_html_text(spark):
    html = "<html><head><style>s</style></head><body><nav>n</nav><p> a <b>b</b></p><script>x</script><p>c</p><footer>f</footer></body></html>"
    df = spark.createDataFrame([(1, html), (2, None), (3, "<p>" + "x" * 60000)], "page_id long, html string")
    got = {r[0]: r[1] for r in df.select("page_id", tables.html_text(df.html)).collect()}
    assert got[1] == "a\nb\nc" and got[2] == "" and len(got[3]) == 50000


def test_sheets(spark):
    cells = [(1, 0, r, c, v) for r, row in enumerate([["h1", "h2"], ["a", None], [None, "d"]]) for c, v in enumerate(row)] + [(1, 1, 0, 0, "only a header")]
    got = [tuple(r) for r in tables.sheet_tables(spark.createDataFrame(cells, schemas.CELLS)).collect()]
    assert got == [(1, 0, "| h1 | h2 |\n| --- | --- |\n| a |  |\n|  | d |")]


def test_sparse_sheets(spark):
    cells = [(1, 0, 0, 0, "A"), (1, 0, 0, 2, "C"), (1, 0, 1, 0, "x"), (1, 0, 1, 2, "z"), (1, 0, 2, 1, "y"), (1, 0, 5, 3, "last")]
    got = [tuple(r) for r in tables.sheet_tables(spark.createDataFrame(cells, schemas.CELLS)).collect()]
    assert got == [(1, 0, "| A |  | C |  |\n| --- | --- | --- | --- |\n| x |  | z |  |\n|  | y |  |  |\n|  |  |  | last |")]


def test_seed_pages_and_appended_records(spark, tmp_path):
    (tmp_path / "seed.csv").write_text(",".join(f.name for f in schemas.SEED) + "\n" + ",".join("1" for _ in schemas.SEED) + "\n")
    assert io.read_seed(spark, str(tmp_path / "seed.csv")).count() == 1
    (tmp_path / "page.html").write_text(HTML)
    assert [r["html"] for r in io.read_html(spark, str(tmp_path / "page.html")).collect()] == [HTML]
    rows = spark.createDataFrame([(1, 7, 2020), (2, 7, 2021)], "id long, company_id long, reporting_year int")
    for _ in range(2):
        io.append_records(rows, str(tmp_path / "records"))
    assert sorted((r["id"], r["reporting_year"]) for r in spark.read.parquet(str(tmp_path / "records")).collect()) == [(1, 2020), (1, 2020), (2, 2021), (2, 2021)]


def test_ranked_results_are_stable(spark):
    rows = [(1, 0, "h/a", "A"), (1, 1, "h/b.pdf", ""), (1, 2, "h/c", None), (1, 3, "h/d.PDF", "D")]
    df = spark.createDataFrame(rows, schemas.SEARCH_RESULTS)
    assert [r["pos"] for r in extract.ranked_results(df).orderBy("rank").collect()] == [1, 3, 0, 2]
    assert extract.search_prompts(df).first()["prompt"].split("\n")[:2] == ["1. Title: (no title)", "   URL: h/b.pdf"]


def test_tries_and_first_result(spark):
    ranked = '{"ranked":[{"index":9,"score":90},{"index":1,"score":20},{"index":-1,"score":50},{"index":0,"score":40},{"index":1,"score":99}]}'
    top = extract.top_tables(extract.rankings(spark.createDataFrame([(1, ranked), (2, "{}"), (3, "oops")], schemas.RANK_RESPONSES)))
    picked = extract.pick_tables(top, spark.createDataFrame([(1, 3)], "doc_id long, n int"))
    assert [(r["try"], r["table_index"]) for r in picked.orderBy("try").collect()] == [(1, None), (2, 2), (3, 0)]
    full = '{"emissions":[{"reporting_year":2020,"scope_1":1.5,"unit":null}],"methodology_notes":"m","confidence_score":80}'
    empty = '{"emissions":[],"methodology_notes":"","confidence_score":1}'
    parsed = extract.parsed_responses(spark.createDataFrame([(1, 2, empty), (1, 0, full), (1, 1, "bad")], schemas.EXTRACT_RESPONSES))
    first = extract.first_result(picked, parsed)
    assert [r["table_index"] for r in first.collect()] == [0]
    flat = extract.flatten_results(first.select("doc_id", "result")).first()
    assert (flat["reporting_year"], flat["scope_1"], flat["unit"], flat["methodology_notes"], flat["review_status"]) == (2020, 1.5, "tonnes CO2e", "m", "pending")


def test_companies_are_saved_all_or_not_at_all(spark):
    part = '{"emissions":[{"reporting_year":2020},{"scope_1":1}],"methodology_notes":"","confidence_score":1}'
    parsed = extract.parsed_responses(spark.createDataFrame([(1, 0, part)], schemas.EXTRACT_RESPONSES)).select("doc_id", "result")
    assert extract.flatten_results(parsed).count() == 0 and extract.incomplete_results(parsed).count() == 1


def test_errors_of_search_and_of_documents(spark):
    companies = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "id long, name string")
    results = spark.createDataFrame([(1, 0, "h/x", "t"), (2, 0, "", "t")], schemas.SEARCH_RESULTS)
    assert {r["company_id"]: r["error"] for r in extract.source_errors(companies, results).collect()} == {2: "Could not identify a suitable source for 'B'.", 3: "No search results found for 'C'."}
    assert extract.chosen_companies(companies, []).count() == 3 and extract.chosen_companies(companies, [2]).count() == 1


def test_tonnes(spark):
    df = spark.createDataFrame([(1.0, None, 2.0, 3.0, "KT"), (1.0, 1.0, 1.0, 1.0, "Mt CO2e"), (1.0, 1.0, 1.0, 1.0, None)], "scope_1 double, scope_2_location double, scope_2_market double, scope_3 double, unit string")
    assert [tuple(r) for r in extract.to_tonnes(df).collect()] == [(1e3, None, 2e3, 3e3, "tonnes CO2e"), (1e6, 1e6, 1e6, 1e6, "tonnes CO2e"), (1.0, 1.0, 1.0, 1.0, None)]


BAD = "<p>before</p><![foo[x]]><table><tr><td>q</td></tr></table>"


def test_pages_that_cannot_be_read_stand_aside(spark):
    pages = spark.createDataFrame([(1, HTML), (2, BAD), (3, None), (4, "<![CDATA[x]]>" + HTML)], "page_id long, html string")
    assert sorted((r["page_id"], r["table_index"]) for r in tables.html_tables(pages).collect()) == [(1, 0), (4, 0)]
    assert [tuple(r) for r in tables.unreadable(pages).collect()] == [(2, "Page cannot be parsed: unknown status keyword 'foo' in marked section")]
    assert {r["page_id"]: r["text"] for r in pages.select("page_id", tables.html_text(pages.html).alias("text")).collect()}[2] is None


def test_wide_sheets_and_cells_in_one_place(spark):
    wide = [(1, 0, r, c, "v") for r in range(3) for c in (0, 9_999)] + [(1, 0, 1, c, "x") for c in range(1, 9_999)]
    lines = tables.sheet_tables(spark.createDataFrame(wide, schemas.CELLS)).first()["markdown"].split("\n")
    assert lines[0] == "| v" + " | " * 9_999 + "v |" and lines[2] == "| v" + " | x" * 9_998 + " | v |" and len(lines) == 4
    twice = [(1, 0, 0, 0, "h"), (1, 0, 2500, 0, "x"), (1, 0, 2500, 0, "y"), (1, 0, 2500, 0, None), (1, 0, 1200, 0, "m")]
    assert tables.sheet_tables(spark.createDataFrame(twice, schemas.CELLS)).first()["markdown"] == "| h |\n| --- |\n| m |\n| y |"


@pytest.mark.parametrize("kind", ["html", "pages"])
def test_documents_on_a_stream_that_dies(spark, tmp_path, kind):
    """A batch whose writer dies after writing is written again under its number, once."""
    rows = {"html": [(k, "u", HTML if k % 2 else BAD) for k in range(6)], "pages": [(k // 2, k % 2, "| a |\n| b |\n\n| --- |\nx") for k in range(6)]}[kind]
    schema = {"html": schemas.HTML_PAGES, "pages": schemas.DOC_PAGES}[kind]
    for k in range(3):
        spark.createDataFrame(rows[2 * k : 2 * k + 2], schema).coalesce(1).write.parquet(str(tmp_path / f"in{k}"))
    steps = {"html": tables.html_tables, "pages": tables.page_tables}
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    died = []

    def work(batch):
        done = steps[kind](batch)
        if (tmp_path / "out" / "batch=0").exists() and not died:
            died.append(done.write.parquet(f"{out}/batch=1"))
            raise RuntimeError("lost")
        return done

    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in*"))
    q = rowlevel.write_once(stream(), out, check, work)
    with pytest.raises(Exception, match="lost"):
        q.processAllAvailable()
    q.stop()
    q = rowlevel.write_once(stream(), out, check, work)
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(out)
    want = steps[kind](spark.createDataFrame(rows, schema))
    key = lambda df: sorted(map(str, df.select(*want.columns).collect()))
    assert died and key(got) == key(want) and got.select("batch").distinct().count() >= 2


def test_streams_take_the_document_steps_as_they_are(spark, tmp_path):
    spark.createDataFrame([(1, "u", HTML), (2, "u", BAD)], schemas.HTML_PAGES).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schemas.HTML_PAGES).parquet(str(tmp_path / "in"))
    for name, frame in (("tables", tables.html_tables(stream)), ("errors", tables.unreadable(stream)), ("text", stream.select("page_id", tables.html_text(stream.html).alias("text")))):
        q = rowlevel.write(frame, str(tmp_path / name), str(tmp_path / f"{name}-check"))
        q.processAllAvailable()
        q.stop()
        assert spark.read.parquet(str(tmp_path / name)).count() == (2 if name == "text" else 1)
