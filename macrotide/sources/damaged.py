"""Documents that cannot be read, set aside with the rule they break instead of vanishing.

Each function takes the documents a parser takes and gives the ones that parser finds nothing usable in, as (table, rule, row) like
rows that a table refuses: the feed, what is wrong, and the address and text of the document as JSON. Empty answers (a page
without records, a sheet without lines) are not damaged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.functions.parsing import csv_cells
from macrotide.sources.xml_feed import NO_ELEMENTS, TAG


def _set_aside(documents: DataFrame, feed: str, rules: dict[str, Column], text: str) -> DataFrame:
    first = F.coalesce(*[F.when(rule, F.lit(name)) for name, rule in rules.items()])
    address = F.col("source") if "source" in documents.columns else F.lit(None).cast("string")
    return documents.select(F.lit(feed).alias("table"), first.alias("rule"), F.to_json(
        F.struct(address.alias("source"), F.col(text).alias("text"))).alias("row")).filter(F.col("rule").isNotNull())


def damaged_pages(documents: DataFrame, feed: str = "inflation feed", text: str = "value") -> DataFrame:
    """JSON pages that are not a list, or whose second element is there and holds no records."""
    value = F.col(text)
    records = F.get_json_object(value, "$[1]")
    return _set_aside(documents, feed, {
        "not a JSON list": value.isNull() | F.json_array_length(value).isNull(),
        "no list of records": (records != "null") & F.json_array_length(records).isNull(),
    }, text)


def damaged_sheets(documents: DataFrame, feed: str = "commodity feed", text: str = "value", header_line: int = 4) -> DataFrame:
    """Sheets with lines but without a header line, or with an open quote in it, or without a commodity column."""
    lines = F.split(F.col(text), r"\r?\n")
    header = F.coalesce(F.get(lines, F.lit(header_line - 1)), F.lit(""))
    quotes = F.length(header) - F.length(F.replace(header, F.lit('"'), F.lit("")))
    named = F.size(F.filter(csv_cells(header), lambda c: (F.trim(c) != "") & ~c.startswith("Unnamed")))
    return _set_aside(documents, feed, {
        "no text": F.col(text).isNull(),
        "no header line": (F.trim(F.col(text)) != "") & (F.trim(header) == ""),
        "open quote in the header": quotes % 2 == 1,
        "no commodity column": (F.trim(header) != "") & (named < 2),
    }, text)


def damaged_xml(documents: DataFrame, feed: str = "wage feed", text: str = "value") -> DataFrame:
    """XML documents without an element, or whose elements are not all closed."""
    value = F.regexp_replace(F.col(text), NO_ELEMENTS, "")
    opened = F.regexp_extract_all(value, F.lit(TAG), F.lit(0))
    empty = F.size(F.filter(opened, lambda e: e.endswith("/>")))
    closed = F.regexp_count(value, F.lit(r"</[^<>]+>"))
    signs = F.length(value) - F.length(F.replace(value, F.lit("<"), F.lit("")))
    return _set_aside(documents, feed, {
        "no element": F.col(text).isNull() | (F.size(opened) == 0),
        "elements that are not closed": F.size(opened) - empty != closed,
        "a tag that does not end": signs != F.size(opened) + closed,
    }, text)
