"""Inputs for the queries: address records made from table keys by the same arithmetic in both SQL dialects."""

from __future__ import annotations

CATALOG: dict[str, str | None] = {
    "北京市": None, "上海市": None, "重庆市": None, "杭州市": "浙江省", "宁波市": "浙江省", "南京市": "江苏省", "苏州市": "江苏省", "成都市": "四川省", "武汉市": "湖北省", "恩施土家族苗族自治州": "湖北省", "桂林市": "广西壮族自治区", "兴安盟": "内蒙古自治区", "阿里地区": "西藏自治区",
}
CITY, PROVINCE = "杭州市", "浙江省"
UNITS = ["西湖区", "拱墅区", "滨江区", "桐庐县"]

PREFIXES = ["", "浙江省", "浙江", "中国浙江省", "地址：", "位于", "江苏省", "联系地址: 浙江省", "学校简介：浙江省", "● "]
CITIES = ["杭州市", "杭州", "", "宁波市", "南京", "杭州市杭州市"]
DISTRICTS = ["西湖区", "滨江区", "", "桐庐县", "江宁区", "高新区", "西湖 ", "文三街道"]
ROADS = ["文三路", "江南大道", "解放街", "", "新城花园", "桐君街道圆通路"]
NUMBERS = ["12号", "90-1号", "", "三号", "108号院"]
TAILS = ["", "（地铁2号线旁）", " 电话：0571-88880000", "，公交15路可达", "（310000）", "东校区", "）"]
SEARCHED = ["", "西湖区", "滨江区", ""]
PLACES = ["第一小学", "宁波校区", "杭州校区", "实验中学（新校区）", "南京校园分部", "图书馆"]
NATURES = ["web_search", "government_information", "map_search"]


def pick(values: list[str], key: str, spark: bool) -> str:
    """SQL for values[key % n]."""
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"element_at(array({listed}), cast(({key}) % {len(values)} as int) + 1)" if spark else f"list_extract([{listed}], CAST(({key}) % {len(values)} AS INT) + 1)"


def address(key: str, spark: bool) -> str:
    half = "div" if spark else "//"
    parts = [(PREFIXES, key), (CITIES, f"{key} {half} 10"), (DISTRICTS, f"{key} {half} 7"), (ROADS, f"{key} * 7"), (NUMBERS, f"{key} * 11 {half} 3"), (TAILS, f"{key} * 13 {half} 5")]
    return "concat(" + ", ".join(pick(v, k, spark) for v, k in parts) + ")"


def records(spark: bool) -> str:
    """SELECT of address records out of customer."""
    k = "c_custkey"
    half = "div" if spark else "//"
    return (
        f"SELECT {k} AS record_id, '{CITY}' AS city_name, {pick(PLACES, k + ' * 3 ' + half + ' 2', spark)} AS place_name, {address(k, spark)} AS original_address, "
        f"{pick(NATURES, k + ' ' + half + ' 2', spark)} AS source_nature, concat('https://example.org/list/', CAST({k} AS VARCHAR({20})), ' | list.csv | row ', CAST({k} % 50 + 1 AS VARCHAR({20}))) AS source_reference, "
        f"{pick(SEARCHED, k + ' ' + half + ' 4', spark)} AS unit FROM customer"
    )
