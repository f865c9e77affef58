"""XML and HTML held in string columns."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

PRODUCT_XML = """
    product ARRAY<STRUCT<
        _id: BIGINT, name: STRING, category: STRING,
        price: STRUCT<_VALUE: DECIMAL(10,2), _currency: STRING>, stock: INT>>
"""


def xml_rows(df: DataFrame, column: str, schema: str, element: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per repeated element; attributes arrive as ``_name``, types follow the schema."""
    parsed = df.select(*keep, F.from_xml(F.col(column), schema, {"mode": "FAILFAST"}).alias("_doc"))
    return parsed.select(*keep, F.explode(f"_doc.{element}").alias("_item")).select(*keep, "_item.*")


def xpath_values(column: str, path: str) -> Column:
    """All text or attribute values a path selects, as an array."""
    return F.xpath(F.col(column), F.lit(path))


def xpath_number(column: str, path: str) -> Column:
    return F.xpath_number(F.col(column), F.lit(path))


def to_xml_rows(df: DataFrame, row_tag: str) -> DataFrame:
    """Every row as one XML element; columns named ``_x`` become attributes."""
    return df.select(F.to_xml(F.struct(*df.columns), {"rowTag": row_tag}).alias("xml"))


def xml_document(rows: Column, root_tag: str) -> Column:
    """An array of XML elements inside one root element."""
    return F.concat(F.lit(f"<{root_tag}>"), F.array_join(rows, ""), F.lit(f"</{root_tag}>"))


class _PageReader(HTMLParser):
    """Texts of interest and element counts of one page; tolerates unclosed tags."""

    # Elements without an end tag, and the elements a start tag implicitly closes.
    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
    CLOSED_BY = {"li": ("li", "p"), "p": ("p",), "div": ("p",), "ul": ("p",), "h1": ("p",)}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # Open elements with the place their text goes to: a field, the number of an item, or none.
        self.open: list[tuple[str, str | int | None]] = []
        self.counts = {"div": 0, "p": 0, "li": 0}
        self.fields: dict[str, str] = {}
        self.items: list[str] = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        while self.open and self.open[-1][0] in self.CLOSED_BY.get(tag, ()):
            self.open.pop()
        if tag in self.counts:
            self.counts[tag] += 1
        if tag in self.VOID:
            return
        field = tag
        if tag == "p" and "intro" in (dict(attrs).get("class") or "").split():
            field = "intro"
        place: str | int | None = None
        if field in ("title", "h1", "intro") and field not in self.fields:
            self.fields[field] = ""
            place = field
        elif tag == "li" and next((name for name, _ in reversed(self.open) if name in ("ul", "ol")), "") == "ul":
            place = len(self.items)
            self.items.append("")
        self.open.append((tag, place))

    def handle_endtag(self, tag: str) -> None:
        if any(name == tag for name, _ in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data: str) -> None:
        if not self.open:
            return
        place = self.open[-1][1]
        if isinstance(place, str):
            self.fields[place] += data
        item = next((place for name, place in reversed(self.open) if name == "li"), None)
        if isinstance(item, int):
            self.items[item] += data


HTML_FIELDS = "title string, h1 string, intro string, items array<string>, n_div int, n_p int, n_li int"


def read_page(html: str | None) -> tuple:
    reader = _PageReader()
    reader.feed(html or "")
    reader.close()
    counts = reader.counts
    items = [" ".join(item.split()) for item in reader.items]
    field = reader.fields.get
    return field("title"), field("h1"), field("intro"), items, counts["div"], counts["p"], counts["li"]


def html_extract(df: DataFrame, column: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Title, first h1, p.intro, list items and element counts of every page.

    Real pages are not well-formed, which the built-in XPath functions reject, so each Arrow
    batch goes through the standard library's tolerant HTML parser. Pages are independent: no
    shuffle, any partitioning.
    """
    names = [f.split()[0] for f in HTML_FIELDS.split(", ")]
    kept = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame([read_page(h) for h in batch[column]], columns=names, index=batch.index)
            yield pd.concat([batch[list(keep)], found], axis=1)

    schema = f"{kept}, {HTML_FIELDS}" if kept else HTML_FIELDS
    return df.select(*keep, column).mapInPandas(pages, schema)
