"""Visible content of web pages: chunks, anchors and table cells, as a table function; listings and feeds."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import hide_escapes, show_escapes, squash

_SKIPPED = {"script", "style", "noscript", "template"}
_BLOCKS = {"p", "div", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "td", "th", "table", "section", "article", "header", "footer", "nav", "main", "br", "title", "body"}
VISIBLE = "kind string, pos int, tag string, text string, href string, table_no int, row_no int, cell_no int"


class VisibleParser(HTMLParser):
    """Collects (kind, pos, tag, text, href, table, row, cell) of chunks between block tags, of anchors and of cells."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple] = []
        self.skip, self.held, self.tag = 0, [], "body"
        self.href: str | None = None
        self.anchor: list[str] = []
        self.tables, self.table, self.row, self.cell, self.cell_text = 0, -1, -1, -1, None
        self.outer: list[tuple] = []

    def _flush(self) -> None:
        text = " ".join("".join(self.held).split())
        if text:
            self.rows.append(("chunk", len(self.rows), self.tag, text, None, None, None, None))
        self.held = []

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in _SKIPPED:
            self.skip += 1
        if tag in _BLOCKS:
            self._flush()
            self.tag = tag
        if tag == "table":
            # A table inside a cell has its own numbers; the outer table goes on where it was.
            self.outer.append((self.table, self.row, self.cell, self.cell_text))
            self.table, self.row, self.cell, self.cell_text = self.tables, -1, -1, None
            self.tables += 1
        elif tag == "tr":
            self.row, self.cell = self.row + 1, -1
        elif tag in ("td", "th"):
            self.cell, self.cell_text = self.cell + 1, []
        elif tag == "a" and not self.skip:
            self.href, self.anchor = dict(attrs).get("href"), []

    def handle_endtag(self, tag: str) -> None:
        if tag in _SKIPPED and self.skip:
            self.skip -= 1
        if tag in ("td", "th") and self.cell_text is not None:
            self.rows.append(("cell", len(self.rows), tag, " ".join("".join(self.cell_text).split()), None, self.table, self.row, self.cell))
            self.cell_text = None
        if tag == "table" and self.outer:
            self.table, self.row, self.cell, self.cell_text = self.outer.pop()
        if tag == "a" and self.href is not None:
            self.rows.append(("anchor", len(self.rows), "a", " ".join("".join(self.anchor).split()), self.href, None, None, None))
            self.href = None
        if tag in _BLOCKS:
            self._flush()
            self.tag = "body"

    def handle_data(self, data: str) -> None:
        if self.skip:
            return
        self.held.append(data)
        if self.cell_text is not None:
            self.cell_text.append(data)
        if self.href is not None:
            self.anchor.append(data)

    def close(self) -> None:
        super().close()
        self._flush()


def visible_rows(html: str | None) -> list[tuple]:
    p = VisibleParser()
    p.feed(html or "")
    p.close()
    return p.rows


@F.udtf(returnType=VISIBLE, useArrow=True)
class HtmlVisible:
    """Table function over a page's source."""

    def eval(self, html: str) -> Iterator[tuple]:
        yield from visible_rows(html)


def visible(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per visible piece of each page, with the page's id."""
    spark = pages.sparkSession
    spark.udtf.register("html_visible", HtmlVisible)
    return pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html")).lateralJoin(HtmlVisible(F.col("html").outer())).drop("html")


def listing(pages: DataFrame, hosts: Sequence[str], number: str, limit: int = 25) -> DataFrame:
    """Rows of listing pages: anchors on an allowed host whose link has a number, the first of each number, ``limit`` per page."""
    from pyspark.sql.window import Window as W

    from ..functions.text import field_after, host_allowed

    a = visible(pages).filter("kind = 'anchor'").withColumn("sn", field_after(F.col("href"), number, "bigint"))
    relative = ~F.col("href").rlike("^[a-z]+:")
    a = a.filter(F.col("sn").isNotNull() & (relative | host_allowed(F.col("href"), hosts)))
    first = a.groupBy("page_id", "sn").agg(F.min(F.struct("pos", "text", "href")).alias("r")).select("page_id", "sn", "r.*")
    return first.withColumn("rn", F.row_number().over(W.partitionBy("page_id").orderBy("pos"))).filter(F.col("rn") <= limit).drop("rn")


#: The least characters of a body in structured data, of a description and of a paragraph.
LEAST_JSON, LEAST_META, LEAST_PARAGRAPH = 450, 120, 25


def article_bodies(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, body, basis) of each page; the whole body, however long.

    STRUCTURED is the first ``articleBody`` of LEAST_JSON characters or more at any depth of the page's JSON-LD. Without one the longest counts of PARAGRAPHS (of
    LEAST_PARAGRAPH characters or more), TEXT (all blocks outside of navigation, header, footer and title) and DESCRIPTION (the page's own or the one for
    sharing, of LEAST_META characters or more), the first of these if they are equally long. A page without any has a null body. Only the pieces of a page come
    from a parser; they are put together by aggregates.
    """
    scripts = F.regexp_extract_all(F.coalesce(html_col, F.lit("")), F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    named = F.regexp_extract_all(hide_escapes(F.array_join(scripts, "\n")), F.lit(r'"articleBody"\s*:\s*("[^"]*")'), F.lit(1))
    bodies = F.transform(named, lambda v: squash(F.get(F.from_json(F.concat(F.lit("["), show_escapes(v), F.lit("]")), "array<string>"), F.lit(0))))
    which = r"""(?:property|name)=["'](?:og:description|description)["']"""
    metas = F.concat(*[F.regexp_extract_all(F.coalesce(html_col, F.lit("")), F.lit(rf"""(?is)<meta[^>]+{p}"""), F.lit(1)) for p in (rf"""{which}[^>]+content=["'](.*?)["']""", rf"""content=["'](.*?)["'][^>]+{which}""")])
    longest = lambda xs: F.get(F.reverse(F.array_sort(F.transform(xs, lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))), F.lit(0))["t"]
    said = longest(F.filter(F.transform(metas, squash), lambda t: F.length(t) >= LEAST_META))
    told = pages.select(F.col(id_col).alias("page_id"), F.get(F.filter(bodies, lambda t: F.length(t) >= LEAST_JSON), F.lit(0)).alias("structured"), said.alias("description"))
    joined = lambda keep: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(keep, F.struct("pos", "text")))), lambda x: x["text"]), " ")
    pieces = visible(pages, id_col, html_col).filter("kind = 'chunk'")
    read = pieces.groupBy(F.col("page_id").alias("of")).agg(joined(~F.col("tag").isin("nav", "header", "footer", "title")).alias("whole"), joined((F.col("tag") == "p") & (F.length("text") >= LEAST_PARAGRAPH)).alias("paragraphs"))
    ranked = F.array(*[F.struct(F.length(F.coalesce(c, F.lit(""))).alias("n"), F.lit(-i).alias("i"), F.lit(b).alias("basis"), F.col(c).alias("body")) for i, (c, b) in enumerate((("paragraphs", "PARAGRAPHS"), ("whole", "TEXT"), ("description", "DESCRIPTION")))])
    best = F.array_max(ranked)
    both = told.join(read, F.col("page_id").eqNullSafe(F.col("of")), "left").withColumn("best", best)
    chosen = F.when(F.col("structured").isNotNull(), F.struct(F.lit("STRUCTURED").alias("basis"), F.col("structured").alias("body"))).when(F.col("best.n") > 0, F.struct("best.basis", "best.body"))
    return both.select("page_id", chosen.alias("c")).select("page_id", "c.body", "c.basis")


FEED = "entry array<struct<id:string,title:string,published:string,link:string>>"


def feed_status(feeds: DataFrame, id_col: str, xml_col: str, expected_channel: str, most: int = 20) -> DataFrame:
    """Entries of feeds given as XML text, with validity: per feed the status OK, PARTIAL_INVALID_ENTRIES, EMPTY or WRONG_CHANNEL."""
    parsed = feeds.select(F.col(id_col), F.from_xml(F.col(xml_col), f"channel string, {FEED}", {"rowTag": "feed"}).alias("x"))
    entries = F.slice(F.coalesce(F.col("x.entry"), F.array().cast("array<struct<id:string,title:string,published:string,link:string>>")), 1, most)
    good = F.filter(entries, lambda e: e["id"].isNotNull() & (F.length(F.trim(F.coalesce(e["title"], F.lit("")))) > 0))
    unique = F.array_distinct(F.transform(good, lambda e: e["id"]))
    out = parsed.select(F.col(id_col), F.col("x.channel").alias("channel"), F.size(entries).alias("n_entries"), F.size(unique).alias("n_valid"))
    status = F.when(F.coalesce(F.col("channel"), F.lit("")) != expected_channel, "WRONG_CHANNEL").when(F.col("n_entries") == 0, "EMPTY").when(F.col("n_valid") < F.col("n_entries"), "PARTIAL_INVALID_ENTRIES").otherwise("OK")
    return out.withColumn("status", status)
