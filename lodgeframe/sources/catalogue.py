"""Dataset catalogue extraction from web pages (S6), as a Spark job over a page table.

The original downloaded one page and walked its HTML table with a parser on
one machine. Here a table of pages (page_id, html) becomes a table of tag events, and
rows, cells and links are spans between events found with running sums, so any number
of pages is handled in parallel. ``page_links`` needs no nesting and stays one pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

ANCHOR_RE = r"""(?s)<a\s[^>]*?href=["']([^"']*)["'][^>]*>(.*?)</a>"""
TAG_RE = r"<[^>]*>"

# One token of a page: a comment, a script or style with its content, a declaration, a
# tag, or text. Every run is read once: nothing here scans the same text twice.
_ATTRIBUTES = r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+"""
TOKEN_RE = (r"(?is)<!--.*?(?:-->|\z)"
            rf"|<(script|style)(?![a-z0-9-]){_ATTRIBUTES}>.*?(?:</\1\s*>|\z)"
            r"|<[!?][^<>]*+>"
            rf"|</?[a-z](?:[^\s/<>\"']*+)(?:{_ATTRIBUTES})>"
            r"|<|[^<]++")
NAME_RE = r"(?i)\A</?([a-z][^\s/<>]*)"
ATTRIBUTE_RE = r"""([^\s"'=<>/]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'<>]++))?"""

# The tags that open, close or cut short rows and cells, and the named
# characters that texts and links may hold (the ampersand last).
SECTIONS = ("thead", "tbody", "tfoot")
CELLS = ("td", "th")
STRUCTURE = ("table", "tr", "a", *SECTIONS, *CELLS)
CHARACTERS = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"),
              ("&nbsp;", " "), ("&amp;", "&"))


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, pos, link, text, segment) for every ``<a href>`` anchor of every page.

    ``segment`` is the third-from-last ``/`` part of the link (NULL when the link
    has fewer parts), the part the catalogue file names are built from.
    """
    pat = F.lit(ANCHOR_RE)
    links = F.regexp_extract_all("html", pat, 1)
    texts = F.regexp_extract_all("html", pat, 2)
    z = pages.select("page_id", F.posexplode(F.arrays_zip(links.alias("link"),
                                                         texts.alias("text"))).alias("pos", "a"))
    link = F.col("a.link")
    return z.select("page_id", "pos", link.alias("link"),
                    F.trim(F.regexp_replace("a.text", TAG_RE, "")).alias("text"), _segment(link))


def _segment(link: Column) -> Column:
    return F.try_element_at(F.split(link, "/", -1), F.lit(-3)).alias("segment")


def _decoded(c: Column) -> Column:
    for name, char in CHARACTERS:
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\A\s++|(?<!\s)\s++\z", "")


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, the last one of that name; NULL without one."""
    body = F.regexp_replace(tag, r"(?i)\A<[a-z][^\s/<>]*+", "")
    pairs = F.arrays_zip(F.regexp_extract_all(body, F.lit(ATTRIBUTE_RE), 1).alias("k"),
                         F.regexp_extract_all(body, F.lit(ATTRIBUTE_RE), 2).alias("v"))
    got = F.filter(pairs, lambda p: F.lower(p["k"]) == name)
    return _decoded(F.regexp_replace(F.try_element_at(got, F.lit(-1))["v"],
                                     r"""(?s)\A(["'])(.*)\1\z""", "$2"))


def keyed_pages(pages: DataFrame) -> DataFrame:
    """(key, html): the pages with a table, dealt by key to all ``spark.sql.shuffle.partitions``.

    ``key`` (id and digest) tells pages apart; equal pages of one id share it. The number is
    given, as a page's tags need far more memory than its bytes in the shuffle, by which
    Spark would merge the parts to one for each core.
    """
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pages.where(F.lower("html").contains("<table")).select(
        F.struct(F.col("page_id").alias("id"), F.md5("html").alias("digest")).alias("key"),
        "html").repartition(parts, "key")


def page_tokens() -> Column:
    """``html`` cut into comments, tags and texts that follow one another without a gap."""
    return F.regexp_extract_all("html", F.lit(TOKEN_RE), 0)


def tag_events(pages: DataFrame, city: str) -> DataFrame:
    """One row per tag that bears on tables and links, with its nesting; no text of the page.

    (key, pos, name, closing, is_wanted, is_link, tds, links, depth, inner): ``tds`` and ``links``
    are the cells and links before the event, ``depth`` is the number of tables open
    around the event (its own included), a running sum of +1 and -1 from which closings
    without an opening are taken out; ``inner`` is the position of the innermost table's
    opening, NULL outside tables.
    """
    wanted = f"table table-hover table-striped {city.lower()}"
    tags = pages.dropDuplicates(["key"]).select("key", F.posexplode(page_tokens()).alias("pos", "tag")).where(
        F.col("tag").startswith("<")).withColumn(
        "name", F.lower(F.regexp_extract("tag", NAME_RE, 1))).where(F.col("name").isin(*STRUCTURE))
    closing = F.col("tag").startswith("</")
    tags = tags.select(
        "key", "pos", "name", closing.alias("closing"),
        F.when(~closing & (F.col("name") == "table"), F.array_join(F.split(_stripped(
            _attribute(F.col("tag"), "class")), r"\s+"), " ") == wanted).alias("is_wanted"),
        F.when(~closing & (F.col("name") == "a"),
               _attribute(F.col("tag"), "href").isNotNull()).alias("is_link"))
    opening, is_table = ~F.col("closing"), F.col("name") == "table"
    step = F.when(is_table, F.when(F.col("closing"), -1).otherwise(1)).otherwise(0)
    in_order = W.partitionBy("key").orderBy("pos")
    w, seen = (in_order.rowsBetween(W.unboundedPreceding, n) for n in (0, -1))
    level = tags.withColumns({
        "_sum": F.sum(step).over(w),
        "tds": F.coalesce(F.count_if(opening & (F.col("name") == "td")).over(seen), F.lit(0)),
        "links": F.coalesce(F.count_if("is_link").over(seen), F.lit(0))})
    level = level.withColumn("_depth", F.col("_sum") - F.least(F.lit(0), F.min("_sum").over(w)))
    # A closing belongs to the table that it closes; a closing of nothing to none.
    before = F.coalesce(F.lag("_depth").over(in_order), F.lit(0))
    level = level.withColumn("depth", F.when(is_table & F.col("closing"), before).otherwise(
        F.col("_depth")).cast("int"))
    opened = F.when(is_table & opening, F.col("pos"))
    inner = F.last(opened, True).over(W.partitionBy("key", "depth").orderBy("pos").rowsBetween(
        W.unboundedPreceding, 0))
    return level.select("key", "pos", "name", "closing", "is_wanted", "is_link", "tds", "links",
                        "depth", F.when(F.col("depth") > 0, inner).alias("inner"))


def _spans(events: DataFrame) -> DataFrame:
    """(key, rows): rows of the wanted table as arrays of (four cell spans, position of the link)."""
    opening = ~F.col("closing")
    td = opening & (F.col("name") == "td")
    # The next event of the same table that ends a row, a cell, the table itself.
    back = W.partitionBy("key", "inner").orderBy(F.desc("pos")).rowsBetween(
        W.unboundedPreceding, -1)
    ends_table = F.col("closing") & (F.col("name") == "table")
    ends_row = ends_table | F.col("name").isin("tr", *SECTIONS)
    ends_cell = ends_row | F.col("name").isin(*CELLS)
    # An element that nothing ends runs to the end of the page, behind every event of it.
    e = events.withColumns({
        into: F.coalesce(F.last(F.when(c, F.col(of)), True).over(back), F.lit(2**62 if n else 2**31 - 1))
        for into, c, of, n in (("table_end", ends_table, "pos", False), ("row_tds", ends_row, "tds", True),
                               ("cell_end", ends_cell, "pos", False),
                               ("cell_links", ends_cell, "links", True))})
    tr = opening & (F.col("name") == "tr")
    # A page's cells and links by number, so that rows and cells find theirs by place.
    page = e.groupBy("key").agg(
        F.min_by(F.struct("pos", F.col("table_end").alias("end")),
                 F.when(F.col("is_wanted"), F.col("pos"))).alias("target"),
        F.array_sort(F.collect_list(F.when(tr, F.struct("pos", "tds", "row_tds")))).alias("trs"),
        F.array_sort(F.collect_list(F.when(td, F.struct("pos", F.col("cell_end").alias("end"), "links",
                                                        "cell_links")))).alias("cells"),
        F.array_sort(F.collect_list(F.when(F.col("is_link"), F.col("pos")))).alias("anchors"))
    four = F.filter("trs", lambda r: (r["pos"] > F.col("target.pos")) & (r["pos"] < F.col("target.end"))
                    & (F.least(r["row_tds"], F.size("cells").cast("long")) - r["tds"] == 4))

    def row(r: Column) -> Column:
        first = r["tds"].cast("int")
        third = F.get("cells", first + 2)
        # The third cell's link is the first one between its ends: the one of that number.
        link = F.when(third["links"] < third["cell_links"], F.get("anchors", third["links"].cast("int")))
        return F.struct(F.slice("cells", first + 1, F.lit(4)).alias("cells"), link.alias("link"))

    return page.where("target IS NOT NULL").select("key", F.transform(four, row).alias("rows")).where(
        F.size("rows") > 0)


def catalogue_rows(pages: DataFrame, city: str) -> DataFrame:
    """(page_id, date_compiled, country_city, file_name, description, link).

    Only the first table whose class is ``table table-hover table-striped <city>``
    is read; of its rows, those of tables inside it included, the ones with exactly 4
    cells (``td``, at any depth) are kept. A row or cell left open ends where the next
    one of its table starts. Tag and attribute names in any case, unquoted values and
    named characters are read; comments, scripts and styles are not.
    ``file_name = country_city + '_' + link.split('/')[-3] + '_' + third cell text``,
    NULL where the link is missing or has fewer than three parts.
    Defined cases: a null or empty page has no rows; a repeated page gives its rows again.
    """
    pages = keyed_pages(pages)
    joined = pages.join(_spans(tag_events(pages, city)), "key").select(
        F.col("key.id").alias("page_id"), "rows", page_tokens().alias("tokens"))
    texts = F.transform("tokens", lambda t: F.when(
        t.startswith("<") & (F.length(t) > 1), F.lit("")).otherwise(t))

    def text(row: Column, texts: Column, i: int) -> Column:
        cell = row["cells"][i]
        part = F.slice(texts, cell["pos"] + 1, F.least(cell["end"], F.size(texts)) - cell["pos"])
        return _stripped(_decoded(F.array_join(part, "")))

    def link(row: Column) -> Column:
        return F.nullif(_attribute(F.get("tokens", row["link"]), "href"), F.lit(""))

    rows = joined.withColumn("texts", texts).select("page_id", F.explode(F.transform(
        "rows", lambda r: F.struct(*[text(r, F.col("texts"), i).alias(f"c{i}") for i in range(4)],
                                   link(r).alias("link")))).alias("r"))
    return rows.select(
        "page_id",
        F.col("r.c0").alias("date_compiled"),
        F.col("r.c1").alias("country_city"),
        F.concat(F.col("r.c1"), F.lit("_"), _segment(F.col("r.link")), F.lit("_"),
                 F.col("r.c2")).alias("file_name"),
        F.col("r.c3").alias("description"),
        F.col("r.link").alias("link"),
    )
