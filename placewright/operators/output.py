"""Result sheets: projections in fixed layouts, and checks that they keep them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placewright.functions.address import STATUS_LABELS, status_label
from placewright.functions.text import strip, text
from placewright.functions.urls import source_reference, source_url

# Headers of the sheets.
ADDRESS_HEADERS = ["地址", "地址获取方式", "地图匹配状态", "信息来源"]
ADDRESS_WIDTHS = [42, 14, 16, 50]


@dataclass(frozen=True)
class SheetSpec:
    """The layout of a result workbook."""

    domain_headers: tuple[str, ...]
    domain_widths: tuple[int, ...] = ()
    official_label: str = "官方来源"
    map_label: str = "地图"
    query_date: str = ""

    def __post_init__(self):
        if self.domain_widths and len(self.domain_widths) != len(self.domain_headers):
            raise ValueError("列宽数量与领域表头不一致")

    @property
    def day(self) -> str:
        return self.query_date.strip() or date.today().isoformat()

    @property
    def main_headers(self) -> list[str]:
        return ["序号", *self.domain_headers, "查询日期", *ADDRESS_HEADERS]

    @property
    def abnormal_headers(self) -> list[str]:
        return ["序号", *self.domain_headers, "异常原因", "信息来源", "查询日期"]

    @property
    def main_widths(self) -> list[int]:
        return [8, *(self.domain_widths or (20,) * len(self.domain_headers)), 14, *ADDRESS_WIDTHS]

    @property
    def abnormal_widths(self) -> list[int]:
        return [8, *(self.domain_widths or (20,) * len(self.domain_headers)), 40, 50, 14]


def address_values(spec: SheetSpec) -> list[Column]:
    """final address, how it was found, match label and source of a resolved record."""
    how = F.when(F.coalesce(F.col("final_address_source"), F.lit("")) == "map", spec.map_label).otherwise(spec.official_label)
    return [strip("final_address"), how, status_label("map_match_status"), source_reference("source_reference")]


def _sequence(order: str, sheet: str | None) -> Column:
    own = Window.partitionBy(sheet) if sheet else Window.partitionBy(F.lit(1))
    return F.row_number().over(own.orderBy(order)).cast("long")


def main_sheet(df: DataFrame, spec: SheetSpec, domain_columns: list[str], order: str, sheet: str | None = None) -> DataFrame:
    """Rows of main sheets, numbered in the order of a column; with ``sheet``, a column that names each row's sheet.

    A sheet is a document for readers (a workbook holds about a million rows in each), so one is numbered in one pass.
    """
    values = [_sequence(order, sheet), *[F.col(c) for c in domain_columns], F.lit(spec.day), *address_values(spec)]
    return df.select(*([F.col(sheet)] if sheet else []), *[v.alias(h) for v, h in zip(values, spec.main_headers, strict=True)])


def abnormal_sheet(df: DataFrame, spec: SheetSpec, domain_columns: list[str], reason: str, order: str, sheet: str | None = None) -> DataFrame:
    values = [_sequence(order, sheet), *[F.col(c) for c in domain_columns], strip(reason), source_reference("source_reference"), F.lit(spec.day)]
    return df.select(*([F.col(sheet)] if sheet else []), *[v.alias(h) for v, h in zip(values, spec.abnormal_headers, strict=True)])


def is_day(c: Column) -> Column:
    """Whether a date cell has the form YYYY-MM-DD."""
    return F.rlike(strip(c), F.lit(r"^\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2}$"))


def main_violations(sheet: DataFrame, spec: SheetSpec) -> DataFrame:
    """(violation, n) of a main sheet in one pass; nothing in it where n is 0."""
    c = F.col
    rules = {
        "日期格式": ~is_day(c("查询日期")), "空地址": strip("地址") == "", "地址获取方式": ~strip("地址获取方式").isin(spec.official_label, spec.map_label), "地图匹配状态": ~strip("地图匹配状态").isin(*STATUS_LABELS.values()), "空信息来源": strip("信息来源") == "",
    }
    return _violations(sheet, rules)


def abnormal_violations(sheet: DataFrame) -> DataFrame:
    return _violations(sheet, {"空异常原因": strip("异常原因") == "", "空信息来源": strip("信息来源") == "", "日期格式": ~is_day(F.col("查询日期"))})


def _violations(sheet: DataFrame, rules: dict[str, Column]) -> DataFrame:
    number = F.col("序号")
    gap = (F.count("*") > 0) & ((F.min(number) != 1) | (F.max(number) != F.count("*")) | (F.count_distinct(number) != F.count("*")))
    one = sheet.agg(F.when(gap, 1).otherwise(0).cast("long").alias("序号不连续"), *[F.count_if(F.coalesce(r, F.lit(True))).alias(n) for n, r in rules.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("violation"), F.col(n).alias("n")) for n in ("序号不连续", *rules)])).alias("v")).select("v.violation", "v.n")


def has_link(c: Column | str) -> Column:
    return source_url(text(c)) != ""
