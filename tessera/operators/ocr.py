"""Tables in the Markdown of scanned pages: lines, cells, numbers, carried headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import is_subtotal, number_error, parse_number

#: Words of header rows.
HEADER_WORDS = "ABITANTI|COMPLESSO|SAPEVANO|ETÀ"


def page_lines(pages: DataFrame, region: str = "region", markdown: str = "markdown", page: str = "page") -> DataFrame:
    """(region, page, line, text): trimmed lines of every page."""
    return pages.select(region, page, F.posexplode(F.split(markdown, "\n")).alias("line", "_t")).select(region, page, "line", F.trim(F.regexp_replace("_t", "^\\s+|\\s+$", "")).alias("text"))


def carry_header(lines: DataFrame, group: str, order: list[str], header: str, out: str) -> DataFrame:
    """``out``: the last header at or before each line of its group."""
    so_far = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn(out, F.last(header, ignorenulls=True).over(so_far))


def circondario(text: str = "text"):
    """The name in a header line outside tables, or null."""
    name = F.trim(F.regexp_extract(text, "(?i)^CIRCONDARIO\\s+DI\\s+(.+?)[\\.\\s]*$", 1))
    return F.when(~F.col(text).startswith("|") & (name != ""), name)


def cells_of(text: str = "text"):
    """Cells of a table row, trimmed, empty ones dropped (so later ones move left)."""
    return F.filter(F.transform(F.split(text, "\\|"), lambda c: F.regexp_replace(c, "^\\s+|\\s+$", "")), lambda c: c != "")


def parse_rows(lines: DataFrame) -> DataFrame:
    """Table rows with name, popres_1921_tot, popres_1921_f, analfabeti_1921 and mf_literate.

    Separators, short rows, headers, subtotals and rows with a spoilt number go, as do rows with neither both parts nor a printed total.
    """
    rows = lines.where(F.col("text").startswith("|") & ~F.col("text").rlike("^\\|\\s*-+")).withColumn("cells", cells_of())
    rows = rows.where(F.size("cells") >= 7).withColumn("comune_raw", F.get("cells", F.lit(0)))
    rows = rows.where((F.col("comune_raw") != "COMUNI") & ~F.upper("comune_raw").rlike(HEADER_WORDS) & ~is_subtotal(F.col("comune_raw")))
    printed, men, women, literate = (F.get("cells", F.lit(k)) for k in range(1, 5))
    good = ~(number_error(printed) | number_error(men) | number_error(women) | number_error(literate))
    total = F.coalesce(parse_number(men) + parse_number(women), parse_number(printed))
    out = rows.where(good).withColumn("popres_1921_tot", total).where("popres_1921_tot is not null")
    return out.withColumn("popres_1921_f", parse_number(women)).withColumn("mf_literate", parse_number(literate)).withColumn("analfabeti_1921", F.col("popres_1921_tot") - F.col("mf_literate")).drop("cells")


def parse_region_pages(pages: DataFrame) -> DataFrame:
    """The municipalities of (region, page, markdown) pages, each with the last ``circondario`` header of its region before it."""
    lines = page_lines(pages).withColumn("_head", circondario())
    carried = carry_header(lines, "region", ["page", "line"], "_head", "circondario")
    return parse_rows(carried.where("text <> ''")).drop("_head", "text")
