"""Page facts: title and infobox pairs from raw HTML pages.

Parsing HTML needs a real tokenizer, so it is the one Python step: a
``mapInPandas`` over Arrow batches of pages with the standard-library
``html.parser``.  It only tokenizes; cleaning, key de-duplication and the
failure split are Spark expressions and aggregations.
"""

from __future__ import annotations

from functools import partial
from html.parser import HTMLParser
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import text

PARSED_SCHEMA = ("page_id long, title string, has_title boolean, "
                 "pairs array<struct<pos:int,key:string,value:string>>")


class _TitleRead(Exception):
    """Raised to stop reading a page once all that is wanted has been seen."""


class _PageParser(HTMLParser):
    """Title text and (th, td) text pairs of rows inside ``<table class="... infobox ...">``.

    Every row under an infobox table (nested ones too), in document order,
    yields the text of its first ``th`` and first ``td`` when both exist.  A
    row or cell that is not closed ends where the next one of its table starts
    or where the table ends, so nothing crosses into another table.
    """

    def __init__(self, titles_only: bool = False):
        super().__init__(convert_charrefs=True)
        self.title: list[str] | None = None
        self._in_title = False
        self._titles_only = titles_only
        self._tables: list[dict] = []  # open tables: whether rows count, and the open row
        self._rows: list[dict] = []    # all rows that count, in document order

    def _end_row(self):
        self._tables[-1]["row"] = None

    def handle_starttag(self, tag, attrs):
        if tag == "title" and self.title is None:
            self.title, self._in_title = [], True
        elif tag == "table":
            classes = (dict(attrs).get("class") or "").split()
            inside = bool(self._tables) and self._tables[-1]["box"]
            self._tables.append({"box": inside or "infobox" in classes, "row": None})
        elif tag == "tr" and self._tables:
            self._end_row()
            if self._tables[-1]["box"]:
                row = {"th": None, "td": None, "open": None}
                self._tables[-1]["row"] = row
                self._rows.append(row)
        elif tag in ("th", "td") and self._tables and (row := self._tables[-1]["row"]):
            row["open"] = tag if row[tag] is None else None
            if row["open"]:
                row[tag] = []

    def handle_endtag(self, tag):
        if tag == "title" and self._in_title:
            self._in_title = False
            if self._titles_only:
                raise _TitleRead
        elif tag in ("th", "td") and self._tables and (row := self._tables[-1]["row"]):
            row["open"] = None
        elif tag == "tr" and self._tables:
            self._end_row()
        elif tag == "table" and self._tables:
            self._tables.pop()

    def handle_data(self, data):
        if self._in_title:
            self.title.append(data)
        for table in self._tables:
            if (row := table["row"]) and row["open"]:
                row[row["open"]].append(data)

    @property
    def pairs(self) -> list[tuple[str, str]]:
        return [("".join(r["th"]).strip(), "".join(r["td"]).strip()) for r in self._rows
                if r["th"] is not None and r["td"] is not None]


def parse_page(html: str | None, titles_only: bool = False) -> tuple[str | None, bool, list[tuple[str, str]]]:
    """(title text, whether the page has a title that is not empty, infobox pairs in document order).

    The whole page is read; with ``titles_only`` reading stops where the title has closed.
    """
    if not html:
        return None, False, []
    p = _PageParser(titles_only)
    try:
        p.feed(html)
        p.close()
    except _TitleRead:
        pass
    title = None if p.title is None else "".join(p.title)
    return title, bool(title and title.strip()), p.pairs


def _parse_batches(batches: Iterator[pd.DataFrame], titles_only: bool = False) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = {"page_id": [], "title": [], "has_title": [], "pairs": []}
        for pid, html in zip(pdf["page_id"], pdf["html"]):
            title, has_title, pairs = parse_page(html, titles_only)
            out["page_id"].append(pid)
            out["title"].append(title)
            out["has_title"].append(has_title)
            out["pairs"].append([{"pos": i, "key": k, "value": v} for i, (k, v) in enumerate(pairs)])
        yield pd.DataFrame(out)


def parse_pages(pages: DataFrame, spread: int | None = None, titles_only: bool = False) -> DataFrame:
    """H1 tokenizing step: one output row per page, Arrow-batched in the Python workers.

    Pages are parsed where they are read (one task per input split, no
    shuffle).  ``spread`` redistributes them round-robin over that many tasks
    first, for inputs stored as a few very large splits.
    """
    src = pages.select("page_id", "html")
    if spread:
        src = src.repartition(spread)
    return src.mapInPandas(partial(_parse_batches, titles_only=titles_only), PARSED_SCHEMA)


def page_titles(parsed: DataFrame) -> DataFrame:
    """cleaned title per page that has one."""
    return parsed.where("has_title").select("page_id", text.clean_title(F.col("title")).alias("title"))


def page_failures(parsed: DataFrame) -> DataFrame:
    """H3: (page_id, message) for pages that cannot be turned into a record."""
    return parsed.where(~F.col("has_title")).select("page_id", F.lit("no title in page").alias("error_message"))


def infobox_facts(parsed: DataFrame) -> DataFrame:
    """H1 + F10 + F11: one row per (page, cleaned key) with the value a dict build keeps.

    Raw keys keep their last value and their first position; after the
    bullet strip, colliding keys resolve to the raw key seen latest (by first
    position).  Both steps are aggregations by key, so no page is collected.
    """
    pairs = parsed.where("has_title").select("page_id", F.explode("pairs").alias("p")).select(
        "page_id", "p.pos", "p.key", "p.value")
    raw = pairs.groupBy("page_id", "key").agg(F.min("pos").alias("first_pos"),
                                              F.max_by("value", "pos").alias("value"))
    cleaned = raw.select("page_id", text.strip_bullet(F.col("key")).alias("meta_key"), "first_pos", "value")
    return (cleaned.groupBy("page_id", "meta_key")
            .agg(F.max_by("value", "first_pos").alias("value"))
            .select("page_id", "meta_key", text.clean_text(F.col("value")).alias("meta_value")))


def translation_records(parsed: DataFrame, ids: DataFrame, key: str = "ship_to_city_cd") -> DataFrame:
    """Records ``(key, key_eng, metadata)`` for pages whose id maps to an identifier.

    ``ids`` is (page_id, key).  The metadata map of one page is built from
    its (bounded) infobox rows.  Titles and facts both read ``parsed``: pass a
    stored parse, so that pages are parsed once.
    """
    facts = infobox_facts(parsed)
    meta = facts.groupBy("page_id").agg(F.map_from_entries(F.collect_list(F.struct("meta_key", "meta_value")))
                                        .alias("metadata"))
    titles = page_titles(parsed)
    return (ids.join(titles, "page_id").join(meta, "page_id", "left")
            .select(key, F.col("title").alias(f"{key}_eng"),
                    F.coalesce("metadata", F.create_map().cast("map<string,string>")).alias("metadata")))
