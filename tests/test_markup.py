"""XML and HTML on small documents with known results."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import markup
from tests.conftest import SPARK_ERRORS, rows

CATALOG = (
    '<catalog><product id="7"><name>Kettle</name><category>Kitchen</category><price currency="EUR">34.50</price>'
    '<stock>12</stock></product><product id="8"><name>Lamp &amp; shade</name><category>Light</category>'
    '<price currency="CHF">80.00</price><stock>3</stock></product><product id="9"><name>Pan</name>'
    '<category>Kitchen</category><price currency="EUR">61.25</price><stock>40</stock></product></catalog>'
)
PAGE = """<html><title>Tea &lt; coffee</title><h1>First <em>and</em> foremost</h1><h1>Second</h1>
<p class="lead intro">Hot <b>water</b>!<p class="intro">More.<ul><li>Pot<ul><li>Lid</ul> of clay<li>Cup</ul>
<ol><li>Boil<li>Pour</ol><div><div class="intro">No</div><p>End<!-- <p> --><script>"<div>"</script></div></html>"""


@pytest.fixture
def document(spark):
    return spark.createDataFrame([(1, CATALOG)], "id int, xml string")


def test_xml_rows(document):
    got = markup.xml_rows(document, "xml", markup.PRODUCT_XML, "product", keep=("id",))
    flat = got.select("id", "_id", "name", "price._VALUE", "price._currency", "stock")
    assert rows(flat)[0] == (1, 7, "Kettle", Decimal("34.50"), "EUR", 12)
    assert got.count() == 3


def test_broken_xml_is_an_error(spark):
    broken = spark.createDataFrame([("<catalog><product>",)], "xml string")
    with pytest.raises(SPARK_ERRORS):
        markup.xml_rows(broken, "xml", markup.PRODUCT_XML, "product").collect()


def test_xpath(document):
    values = lambda path: document.select(markup.xpath_values("xml", path)).first()[0]
    assert values("//product/name/text()") == ["Kettle", "Lamp & shade", "Pan"]
    assert values("//product[category='Kitchen']/stock/text()") == ["12", "40"]
    assert values("//product[price>60]/name/text()") == ["Lamp & shade", "Pan"]
    assert values("//price/@currency") == ["EUR", "CHF", "EUR"]
    assert document.select(markup.xpath_number("xml", "sum(//product/stock)")).first()[0] == 55


def test_html(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "")], "id int, html string")
    got = {r.id: r for r in markup.html_extract(pages, "html", keep=("id",)).collect()}
    page = got[1]
    assert (page.title, page.h1, page.intro) == ("Tea < coffee", "First  foremost", "Hot !")
    assert page["items"] == ["Pot of clay", "Lid", "Cup"]
    assert (page.n_div, page.n_p, page.n_li) == (2, 3, 5)
    for empty in (got[2], got[3]):
        assert (empty.title, empty["items"], empty.n_div) == (None, [], 0)


def test_xml_out_and_back(spark):
    people = spark.createDataFrame(
        [(1, "John <Doe>", "j@x"), (2, "Jane", "k@x")], "_id bigint, name string, email string"
    )
    elements = markup.to_xml_rows(people, "customer")
    whole = elements.agg(markup.xml_document(F.collect_list("xml"), "customers").alias("xml"))
    schema = "customer ARRAY<STRUCT<_id: BIGINT, name: STRING, email: STRING>>"
    assert rows(markup.xml_rows(whole, "xml", schema, "customer")) == rows(people)
