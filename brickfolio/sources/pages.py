"""Fund pages: fields and links out of HTML text, kept in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brickfolio.functions import columns as X

# where an object after the name ``meta`` begins, any letter case
META = r'(?is)\bmeta"?\s*[:=]\s*(\{.*)'
# a string with escapes counts as one unit; the rest is cut at braces
_UNITS = r'(?s)"(?:[^"\\]|\\.)*+"|[{}]|[^"{}]++|"'
# fixed value: what a ticker looks like
TICKER = r"^[A-Z0-9]{4,8}\d{1,2}[A-Z]?$"


def field(block: Column, name: str) -> Column:
    """Value of ``"name": "value"``, any letter case; null when absent."""
    found = F.regexp_extract_all(block, F.lit(rf'(?i)"{name}"\s*:\s*"([^"]*)"'), F.lit(1))
    return F.trim(F.replace(F.try_element_at(found, F.lit(1)), F.lit(r"\/"), F.lit("/")))


def first_object(text: Column) -> Column:
    """The object that ``text`` begins with, up to its closing brace at any depth; null when it is not closed."""
    units = F.regexp_extract_all(text, F.lit(_UNITS), F.lit(0))

    def step(state: Column, unit: Column) -> Column:
        depth = state["depth"] + F.when(unit == "{", 1).when(unit == "}", -1).otherwise(0)
        open_ = ~state["closed"]
        return F.struct(
            F.when(open_, depth).otherwise(state["depth"]).alias("depth"), (state["closed"] | (depth <= 0)).alias("closed"),
            F.when(open_, state["length"] + F.length(unit)).otherwise(state["length"]).alias("length"))

    begin = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("closed"), F.lit(0).alias("length"))
    end = F.aggregate(units, begin, step)
    return F.when(end["closed"], F.substring(text, F.lit(1), end["length"]))


def page_fields(pages: DataFrame) -> DataFrame:
    """One row per page with its fields and, where it cannot be used, the reason."""
    rows = pages.withColumn("meta", F.nullif(F.regexp_extract("html", META, 1), F.lit(""))).withColumn("meta", first_object(F.col("meta")))
    meta = F.col("meta")
    parsed = rows.withColumns({
        "ticker": F.upper(field(meta, "codigo")), "cnpj": X.tax_id(field(meta, "cnpj")),
        "fund_name": field(meta, "name"), "category_status": field(meta, "categorystatus"),
    })
    reason = (F.when(meta.isNull(), "META_NOT_FOUND").when(F.col("ticker").isNull(), "TICKER_NOT_FOUND")
              .when(F.col("cnpj").isNull(), "CNPJ_NOT_FOUND"))
    return parsed.withColumn("reject_reason", reason).drop("meta")


def good_and_rejected(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = page_fields(pages)
    return (rows.filter("reject_reason is null").drop("reject_reason"), rows.filter("reject_reason is not null"))


def page_links(pages: DataFrame, folder: str = "funds", pattern: str = TICKER) -> DataFrame:
    """Distinct tickers named by anchors under ``/folder/``."""
    hrefs = F.regexp_extract_all("html", F.lit(r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']+)["']"""), F.lit(1))
    names = pages.select(F.explode(hrefs).alias("href")).select(
        F.upper(F.regexp_extract("href", rf"/{folder}/([a-zA-Z0-9]+)", 1)).alias("ticker"))
    return names.filter(F.col("ticker").rlike(pattern)).distinct()
