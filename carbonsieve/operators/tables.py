"""Tables out of documents: markdown blocks, HTML tables, sheets; and text out of HTML.

Splitting markdown and parsing HTML are loops over one document each, done in Arrow batches
without a shuffle; all the rest is built-in.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType

from ..functions.text import capped

# Fixed value: what makes a run of piped lines a table.
SEPARATOR = re.compile(r"\|[\s\-:]+\|")
DROPPED = {"script", "style", "nav", "footer", "header"}
STRINGS = ArrayType(StringType())
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


def piped_runs(text: str | None) -> list[str]:
    """Maximal runs of lines that begin with a pipe, of those that hold a separator."""
    runs, run = [], []
    for line in [*(text or "").split("\n"), ""]:
        if line.strip().startswith("|"):
            run.append(line)
        elif run:
            block = "\n".join(run)
            if SEPARATOR.search(block):
                runs.append(block)
            run = []
    return runs


@pandas_udf(STRINGS)
def markdown_blocks(text: pd.Series) -> pd.Series:
    return text.map(piped_runs)


def page_tables(pages: DataFrame) -> DataFrame:
    """doc_id, page_no, pos, markdown: the tables of each page, numbered within the page; keeps no
    state, so it runs on streams."""
    return pages.select("doc_id", "page_no", F.posexplode(markdown_blocks(F.col("text"))).alias("pos", "markdown"))


def markdown_tables(pages: DataFrame) -> DataFrame:
    """doc_id, table_index, markdown: the tables of all pages of a document in order."""
    w = Window.partitionBy("doc_id").orderBy("page_no", "pos")
    return page_tables(pages).select("doc_id", (F.row_number().over(w) - 1).alias("table_index"), "markdown")


class _Tree(HTMLParser):
    """A light tree: nodes are [tag, children], text is str. Rows and cells that are not closed
    end where the next one of their kind begins."""

    ENDS = {"tr": ({"tr", "td", "th"}, "table"), "td": ({"td", "th"}, "tr"), "th": ({"td", "th"}, "tr"), "li": ({"li"}, "ul"), "p": ({"p"}, "body")}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = ["", []]
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in self.ENDS:
            closes, within = self.ENDS[tag]
            cut = len(self.open)
            for k in range(len(self.open) - 1, 0, -1):
                name = self.open[k][0]
                if name == within or name == "table":
                    break
                if name in closes:
                    cut = k
            del self.open[cut:]
        node = [tag, []]
        self.open[-1][1].append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1][1].append([tag, []])

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        self.open[-1][1].append(data)


def parse(html: str | None) -> list:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


def read(html: str | None) -> tuple[list | None, str | None]:
    """The tree of a page, or what the parser says against it: one page that cannot be read
    must not fail the job for all others."""
    try:
        return parse(html), None
    except (AssertionError, ValueError) as e:
        return None, f"Page cannot be parsed: {e}"


def _nodes(node: list, tags: set[str]) -> list:
    """All nodes of these tags in document order, nested ones too."""
    found, stack = [], [node]
    while stack:
        at = stack.pop()
        if at[0] in tags:
            found.append(at)
        stack.extend(x for x in reversed(at[1]) if not isinstance(x, str))
    return found


def _strings(node: list, skip: frozenset | set = frozenset()) -> list[str]:
    found, stack = [], [node]
    while stack:
        at = stack.pop()
        if isinstance(at, str):
            if s := at.strip():
                found.append(s)
        elif at[0] not in skip:
            stack.extend(reversed(at[1]))
    return found


def table_grid(table: list) -> list[list[str]]:
    """The texts of a table's cells, without rows that have none."""
    rows = (["".join(_strings(cell)) for cell in _nodes(row, {"td", "th"})] for row in _nodes(table, {"tr"}))
    return [row for row in rows if any(row)]


def grid_to_markdown(grid: Column) -> Column:
    """Rows of cells as a markdown table as wide as its first row, which is the header: short
    rows are filled up with empty cells, long ones cut."""
    width = F.size(F.get(grid, F.lit(0)))
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    fitted = F.transform(grid, lambda row: line(F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.coalesce(F.get(row, i), F.lit("")))))
    rule = line(F.array_repeat(F.lit("---"), width))
    return F.array_join(F.concat(F.slice(fitted, 1, 1), F.array(rule), F.slice(fitted, 2, F.size(grid))), "\n")


@pandas_udf(ArrayType(ArrayType(STRINGS)))
def html_table_grids(html: pd.Series) -> pd.Series:
    """The grids of a page's tables; null where the page cannot be read."""
    trees = html.map(lambda h: read(h)[0])
    return trees.map(lambda tree: None if tree is None else [grid for t in _nodes(tree, {"table"}) if (grid := table_grid(t))])


@pandas_udf(StringType())
def _text_lines(html: pd.Series) -> pd.Series:
    trees = html.map(lambda h: read(h)[0])
    return trees.map(lambda tree: None if tree is None else "\n".join(_strings(tree, DROPPED)))


@pandas_udf(StringType())
def parse_error(html: pd.Series) -> pd.Series:
    """Why a page cannot be read; null for all others."""
    return html.map(lambda h: read(h)[1])


def html_text(html: Column, size: int = 50_000) -> Column:
    """The text fragments of a page, one to a line, capped; null where it cannot be read."""
    return capped(_text_lines(html), size)


def html_tables(pages: DataFrame, tasks: int | None = None) -> DataFrame:
    """page_id, table_index, markdown. Pages differ much in size: with ``tasks`` they are dealt
    out anew before parsing. Rows and cells that a page leaves open are closed, not nested. Pages
    that cannot be read have no tables; ``unreadable`` lists them."""
    dealt = pages.repartition(tasks) if tasks else pages
    grids = dealt.select("page_id", F.posexplode(html_table_grids(F.col("html"))).alias("table_index", "grid"))
    return grids.select("page_id", "table_index", grid_to_markdown(F.col("grid")).alias("markdown"))


def unreadable(pages: DataFrame) -> DataFrame:
    """page_id, error of the pages that cannot be read."""
    return pages.select("page_id", parse_error(F.col("html")).alias("error")).where("error is not null")


#: rows of a sheet that are put together before the sheet is
RANGE_ROWS = 1000


def row_line(cells: Column) -> Column:
    """The line of a row from its cells (col_no, value) in order of their columns, without the
    bar at its end. Columns that are not there are empty: each cell brings the bars between it and
    the one before, so the work grows with the cells that are there."""
    before = lambda i: F.coalesce(F.get(cells, i - 1)["col_no"], F.lit(0))
    piece = F.transform(cells, lambda x, i: F.concat(F.repeat(F.lit(" | "), x["col_no"] - before(i)), F.coalesce(x["value"], F.lit(""))))
    return F.concat(F.lit("| "), F.array_join(piece, ""))


def sheet_tables(cells: DataFrame) -> DataFrame:
    """Grids of cells (doc_id, sheet_no, row_no, col_no, value) to markdown; the first row is
    the header, sheets without further rows are left out. Cells that are not there are empty: a
    sheet is as wide as its last column. Of several cells in one place the greatest value counts.

    A large sheet is dealt out by ranges of rows, whose lines are in order when the sheet is put
    together from them."""
    sheet, part = ["doc_id", "sheet_no"], F.floor(F.col("row_no") / RANGE_ROWS).alias("part")
    dealt = cells.select(*sheet, part, "row_no", "col_no", "value").repartition(*sheet, "part")
    rows = dealt.groupBy(*sheet, "part", "row_no").agg(F.array_sort(F.collect_list(F.struct("col_no", "value"))).alias("all"))
    last_in_place = lambda x, i: F.coalesce(F.get("all", i + 1)["col_no"] != x["col_no"], F.lit(True))
    rows = rows.withColumn("cells", F.filter("all", last_in_place))
    lines = rows.select(*sheet, "part", "row_no", row_line(F.col("cells")).alias("line"), F.element_at("cells", -1)["col_no"].alias("last"))
    parts = lines.groupBy(*sheet, "part").agg(F.array_sort(F.collect_list(F.struct("row_no", "line", "last"))).alias("lines"), F.max("last").alias("last"))
    sheets = parts.groupBy(*sheet).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "lines"))), lambda p: p["lines"])).alias("lines"), F.max("last").alias("last"))
    full = F.transform("lines", lambda x: F.concat(x["line"], F.repeat(F.lit(" | "), F.col("last") - x["last"]), F.lit(" |")))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), F.col("last") + 1), " | "), F.lit(" |"))
    sheets = sheets.where("size(lines) > 1").select(*sheet, full.alias("full"), rule.alias("rule"))
    whole = F.concat(F.slice("full", 1, 1), F.array("rule"), F.slice("full", F.lit(2), F.size("full")))
    return sheets.select(*sheet, F.array_join(whole, "\n").alias("markdown"))
