"""XML and HTML columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.catalog.base import query
from tallyhouse.operators import markup
from tallyhouse.sources.retail import Retail


def product_elements() -> Column:
    """The product columns as one XML element."""
    price = F.struct(F.col("price").alias("_VALUE"), F.lit("USD").alias("_currency"))
    row = F.struct(
        F.col("product_id").alias("_id"), F.col("product_name").alias("name"), "category",
        price.alias("price"), F.col("stock_quantity").alias("stock"),
    )
    return F.to_xml(row, {"rowTag": "product"})


def catalogs(r: Retail) -> DataFrame:
    """One XML catalog per four consecutive products."""
    return (
        r.products.withColumn("catalog", F.floor(F.col("product_id") / 4))
        .groupBy("catalog")
        .agg(F.sort_array(F.collect_list(F.struct("product_id", product_elements().alias("x")))).alias("e"))
        .select("catalog", markup.xml_document(F.col("e.x"), "catalog").alias("xml"))
    )


@query(
    "x01_xml_rows",
    """select product_id // 4 as catalog, product_id, product_name as name, category,
              cast(price as double) as price, 'USD' as currency, stock_quantity::bigint as stock from prod""",
    "prod",
)
def x01(r: Retail) -> DataFrame:
    rows = markup.xml_rows(catalogs(r), "xml", markup.PRODUCT_XML, "product", keep=("catalog",))
    return rows.select(
        "catalog", F.col("_id").alias("product_id"), "name", "category",
        F.col("price._VALUE").alias("price"), F.col("price._currency").alias("currency"), "stock",
    )


@query(
    "x02_xpath",
    """select product_id // 4 as catalog, string_agg(product_name, '|' order by product_id) as names,
              coalesce(string_agg(product_name, '|' order by product_id)
                       filter (category = 'ECONOMY'), '') as economy,
              coalesce(string_agg(product_name, '|' order by product_id) filter (price > 1000), '')
                  as expensive,
              string_agg(product_id, '|' order by product_id) as ids,
              cast(sum(stock_quantity) as double) as stock from prod group by 1""",
    "prod",
)
def x02(r: Retail) -> DataFrame:
    joined = lambda path: F.array_join(markup.xpath_values("xml", path), "|")
    return catalogs(r).select(
        "catalog",
        joined("//product/name/text()").alias("names"),
        joined("//product[category='ECONOMY']/name/text()").alias("economy"),
        joined("//product[price>1000]/name/text()").alias("expensive"),
        joined("//product/@id").alias("ids"),
        markup.xpath_number("xml", "sum(//product/stock)").alias("stock"),
    )


def text_sql(html: str) -> str:
    """Plain text of an HTML fragment; the test pages use four named characters."""
    text = f"regexp_replace({html}, '<[^>]*>', '', 'g')"
    for name, sign in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        text = f"regexp_replace({text}, '&{name};?', '{sign}', 'g')"
    return text


def count_sql(tag: str) -> str:
    return f"len(regexp_extract_all(body, '<{tag}[ >]'))"


@query(
    "x03_html_extract",
    f"""select page_id, {text_sql("nullif(regexp_extract(body, '<title>(.*?)</title>', 1), '')")} as title,
               {text_sql("nullif(regexp_extract(body, '<h1>(.*?)</h1>', 1), '')")} as h1,
               nullif(regexp_extract(body, '<p class="intro">([^<]*)', 1), '') as intro,
               array_to_string(list_transform(regexp_extract_all(body, '<li>(.*?)</li>', 1),
                   lambda item: trim(regexp_replace({text_sql("item")}, '\\s+', ' ', 'g'))), ' | ') as items,
               {count_sql("div")} as n_div, {count_sql("p")} as n_p, {count_sql("li")} as n_li
        from (select page_id, regexp_replace(html, '<script>.*?</script>|<!--.*?-->', '', 'g') as body
              from pages)""",
)
def x03(r: Retail) -> DataFrame:
    pages = markup.html_extract(r.raw("pages"), "html", keep=("page_id",))
    return pages.withColumn("items", F.array_join("items", " | "))


@query(
    "x04_rows_to_xml",
    """select '<customer id="' || customer_id || '">' || chr(10) || '    <name>' || name || '</name>' ||
              chr(10) || '    <tier>' || loyalty_tier || '</tier>' || chr(10) || '</customer>' as xml
       from cust""",
    "cust",
)
def x04(r: Retail) -> DataFrame:
    rows = r.customers.select(F.col("customer_id").alias("_id"), "name", F.col("loyalty_tier").alias("tier"))
    return markup.to_xml_rows(rows, "customer")
