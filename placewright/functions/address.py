"""Address columns: cleaning, administrative parts, comparison keys, roads, numbers, anchors.

Patterns are written for Java and RE2 alike (no look-ahead, Han characters as a range).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placewright.functions.text import NAME_MARKS, WS, after, compact, drop_prefix, last_index, let, stage, strip, text, without_space

HAN = "一-鿿"
# Vocabularies and patterns that results depend on.
CITY_SUFFIXES = ["市", "地区", "自治州", "盟"]
UNIT_SUFFIXES = ["街道", "苏木", "区", "县", "旗", "镇", "乡", "市"]
LOWER_SUFFIXES = ["街道", "镇", "乡", "苏木"]
DIVISION_SUFFIXES = ["特别行政区", "自治区", "自治州", "地区", "盟", "区", "县", "旗"]
PLACE_SUFFIXES = ["校区", "校园", "分院", "分行", "支行", "分部"]
MUNICIPALITIES = ["北京市", "天津市", "上海市", "重庆市"]
MODES = {"web_search": "web_search", "government_information": "government_list", "map_search": "map_search"}
STATUS_LABELS = {"consistent": "一致", "partial": "部分匹配", "conflict": "冲突", "poi_match": "POI匹配", "not_found": "未找到", "ambiguous": "多个候选", "error": "查询错误", "skipped": "未查询", "needs_review": "部分匹配·待复核"}
NO_UNIT = "地址缺少下级行政区"
NO_PLACE = "地址缺少行政区之后的具体位置"
LABEL = rf"(?:通讯地址|联系地址|邮寄地址|办公地址|学校地址|校址|地址){WS}*[：:]{WS}*"
NARRATIVE = rf"^(?:(?:地处|位于|坐落于|位置){WS}*[：:，,]?{WS}*)+"
ANY_LABEL = rf"^[^：:]{{1,40}}[：:]{WS}*"
ADMIN_START = rf"^(?:中国|中华人民共和国)?(?:[{HAN}]{{1,15}}?(?:省|市|自治区|自治州|地区|盟|特别行政区)|[{HAN}]{{1,15}}?[区县旗])"
BULLETS = "[•●◆■□·]"
CITY_RUN = rf"([{HAN}]{{1,12}}市)"
TAIL_WORDS = "公交|地铁|学校门口|学费|收费标准|元/|学年|电话|邮编|TEL|联系人|报名|宿舍|食堂|后勤"
CONTACT = rf"(?i){WS}*(?:[，,；;、|｜]{WS}*)?(?:邮政编码|邮编|联系电话|电话|传真|电子邮箱|邮箱|E-?mail){WS}*[：:]?[^\n]*$"
POSTCODE = rf"{WS}*[（(]{WS}*\p{{Nd}}{{6}}{WS}*[）)]{WS}*$"
PROVINCE = rf"^([^{WS[1:-1]}省市县区旗盟]{{2,30}}?(?:特别行政区|维吾尔自治区|壮族自治区|回族自治区|自治区|省))"
CITY = rf"^([{HAN}]{{2,30}}?(?:自治州|地区|盟|市))"
SHORT_CITY = rf"^([{HAN}]{{2,20}}?)([{HAN}]{{1,15}}?(?:区|县|旗))"
DISTRICT = "^(.{1,15}?(?:区|县|旗))"
UNIT = "^(.{1,20}?(?:街道|苏木|区|县|旗|镇|乡|市))"
ZONE = "^.*(?:经济技术开发区|高新技术产业开发区|开发区|高新区|产业园区)$"
ZONE_MARKS = "街道?|镇|乡|苏木|大道|公路|路|街|巷|村|社区|小区|商住|工业|园|校"
LOWER_UNITS = "^(?:.{1,20}?(?:街道|镇|乡|苏木))+"
PLACE_ONLY = "^.{0,30}(?:校区|校园|分院|分行|支行|分部)$"
SPECIFIC = r"大道|道路|公路|路|街|巷|弄|段|村|大院|\p{Nd}+号|\p{Nd}+栋|\p{Nd}+座|\p{Nd}+楼"
ROAD = rf"([{HAN}A-Za-z0-9·\-]{{1,30}}?(?:大道|公路|街道|胡同|路|街|巷|道)[东南西北中]?)"
NUMBER = r"([0-9A-Za-z一二三四五六七八九十百千万甲乙丙丁\-之]+号(?:院)?)"
PARKS = "大学城|职教园|大学园|高教园区|高校园区|教育园区|科教城"
NAMED_PLACE = rf"([{HAN}A-Za-z0-9·\-]{{1,20}}(?:校区|校园|分院|分行|支行|分部))"
ADMIN_END = "(?:特别行政区|维吾尔自治区|壮族自治区|回族自治区|自治区|自治州|地区|盟|省|市|区|县|旗)$"
AUXILIARY_TYPE = "公交车站|地铁站|停车场|出入口|通行设施|收费站|服务区"
AUXILIARY_TEXT = "公交站|公交车站|地铁站|驿站|停车场|出入口|通行设施|收费站|服务区"
STATUS_WORDS = "[（(][^（）()]*?(?:建设中|在建|拟建|筹设|筹办)[^（）()]*?[）)]"
TOWN = rf"^[{HAN}]{{1,8}}(?:镇|街道|街|乡)"
GUIDES = "[（(][^（）()]*(?:地铁|公交|交叉口|出口|步行|停车场)[^（）()]*[）)]"
LIST_PLACE = "小区|花园|花苑|苑|新村|社区|村|里|路|街|巷|大道|公路|弄|段|号|栋|座|楼|园|校区|院区|工业区|产业园"
KEY_PROVINCE = rf"^[^{WS[1:-1]}省市县区旗盟]{{1,12}}省"
KEY_CITY = "^[^省市区县]{1,12}市"
KEY_ZONE = rf"^[{HAN}]{{2,6}}(大学城|高教园区|高校园区|大学园|职教园|教育园区|科教城)"
NARROW, WIDE = "(),;:", "（），；："


def group(c: Column, pattern: str, n: int = 1) -> Column:
    return F.regexp_extract(c, pattern, n)


def has(c: Column, pattern: str) -> Column:
    return F.rlike(c, F.lit(pattern))


def clean(c: Column | str) -> Column:
    """Address text without labels, contacts, postcodes, bullets, narration, repeats of the city and odd brackets."""
    v = F.replace(text(c), F.lit("　"), F.lit(" "))
    for pattern in (LABEL, CONTACT, POSTCODE, BULLETS, NARRATIVE):
        v = F.regexp_replace(v, pattern, "")
    return v


def clean_label(v: Column) -> Column:
    """Second step: a leading label goes if what follows it starts like an address."""
    rest = after(v, F.length(group(v, ANY_LABEL, 0)))
    return F.when(has(v, ANY_LABEL) & has(rest, ADMIN_START), rest).otherwise(v)


def clean_repeat(v: Column) -> Column:
    """Third step: of several cities the last starts the address, unless a road or number stands before it."""
    runs = lambda found: let(last_index(v, F.try_element_at(found, F.lit(-1))), lambda start: F.when((F.size(found) >= 2) & ~has(F.substring(v, F.lit(1), start), "[路街大道巷号栋座]"), after(v, start)).otherwise(v))
    return let(F.regexp_extract_all(v, F.lit(CITY_RUN), F.lit(1)), runs)


def clean_tail(v: Column) -> Column:
    """Fourth step: what follows a number and a comma goes if it tells of something else."""
    pattern = r"(?s)^(.*?\p{Nd}+号[^，,；;、]*)[，,；;、](.*)$"
    return F.when(has(group(v, pattern, 2), TAIL_WORDS), group(v, pattern, 1)).otherwise(v)


def clean_marks(v: Column) -> Column:
    """Fifth step: no white space, wide marks, none at the ends."""
    v = F.translate(without_space(v), NARROW, WIDE)
    return F.regexp_replace(v, "^[，,；;：:|｜ ]+|[，,；;：:|｜ ]+$", "")


def clean_brackets(v: Column) -> Column:
    """Last step: brackets at the ends that have no partner."""
    count = lambda c, mark: F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))
    extra = F.greatest(F.lit(0), F.least(F.length(group(v, "(）*)$")), count(v, "）") - count(v, "（")))
    return F.substring(v, F.lit(1), F.length(v) - extra)


def clean_open(v: Column) -> Column:
    count = lambda c, mark: F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))
    extra = F.greatest(F.lit(0), F.least(F.length(group(v, "^(（*)")), count(v, "（") - count(v, "）")))
    return after(v, extra)


CLEAN_STEPS = (clean, clean_label, clean_repeat, clean_tail, clean_marks, clean_brackets, clean_open)


def cleaned(df, column: str, out: str):
    """``df`` with the cleaned address."""
    value = F.col(column)
    for step in CLEAN_STEPS:
        value = let(value, step)
    return stage(df, **{out: value})


def unit_of(detail: Column) -> Column:
    """The administrative unit that a text starts with."""
    return group(detail, UNIT)


def place_of(detail: Column) -> Column:
    """What follows the administrative unit."""
    return let(detail, lambda x: after(x, F.length(unit_of(x))))


def is_zone(name: Column) -> Column:
    """Whether a district's name is that of a development zone or of a place."""
    short = F.substring(name, F.lit(1), F.greatest(F.length(name) - 1, F.lit(0)))
    return has(name, ZONE) | has(short, ZONE_MARKS) | (F.endswith(name, F.lit("旗")) & (F.length(name) <= 2))


def is_specific(place: Column) -> Column:
    """Whether something specific follows the units."""
    return let(F.regexp_replace(text(place), LOWER_UNITS, ""), lambda rest: has(rest, SPECIFIC) | ((F.length(rest) >= 2) & ~has(rest, PLACE_ONLY)))


def detail_key(c: Column | str) -> Column:
    """Last road and house number of an address, or all of it if it has none."""
    rfind = lambda v, s: F.when(F.contains(v, F.lit(s)), F.length(v) - F.instr(F.reverse(v), s[::-1]) + 1 - len(s)).otherwise(F.lit(-1))

    def key(v: Column, number: Column) -> Column:
        def of_head(head: Column) -> Column:
            road = F.greatest(*[rfind(head, s) for s in ("大道", "大街", "路", "街", "巷", "弄", "道")])
            return let(road, lambda at: F.when(at < 0, v).otherwise(let(F.substring(head, F.lit(1), at), lambda before: of_road(head, before))))

        def of_road(head: Column, before: Column) -> Column:
            # separators are visited in this order, each moves the start forward only
            marks = F.array(*[F.struct(rfind(before, s).alias("at"), F.lit(len(s)).alias("n")) for s in ("省", "市", "区", "县", "街道", "街", "镇", "乡")])
            begin = F.aggregate(marks, F.lit(0), lambda a, m: F.when(m["at"] >= a, m["at"] + m["n"]).otherwise(a))
            return F.concat(after(head, begin), number)

        return let(F.substring(v, F.lit(1), last_index(v, number)), of_head)

    last = lambda v: F.try_element_at(F.regexp_extract_all(v, F.lit(r"(\p{Nd}+(?:[-－]\p{Nd}+)?号)"), F.lit(1)), F.lit(-1))
    return let(without_space(c), lambda v: let(last(v), lambda number: F.when(number.isNull(), v).otherwise(key(v, number))))


def equivalence_key(c: Column | str) -> Column:
    """What equal places have in common: road and number, without country, province, city and zone."""
    v = F.regexp_replace(without_space(c), "^中国", "")
    v = F.regexp_replace(F.regexp_replace(v, KEY_PROVINCE, ""), KEY_CITY, "")
    return detail_key(F.regexp_replace(v, KEY_ZONE, "$1"))


def city_core(name: Column) -> Column:
    return F.regexp_replace(name, "(?:" + "|".join(CITY_SUFFIXES) + ")$", "")


def short_city(name: Column) -> Column:
    """The shortest usual name of a city."""
    core = city_core(name)
    at = F.instr(core, "族")
    return F.when(at > 1, F.substring(core, F.lit(1), at - 1)).otherwise(core)


def mode_of(mode: Column, nature: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in MODES.items() for x in pair])
    return F.coalesce(F.nullif(strip(mode), F.lit("")), F.try_element_at(known, strip(nature)), F.lit(""))


def status_label(c: Column | str) -> Column:
    known = F.create_map(*[F.lit(x) for pair in STATUS_LABELS.items() for x in pair])
    status = strip(c)
    return F.coalesce(F.try_element_at(known, status), F.nullif(status, F.lit("")), F.lit("未查询"))


def target_unit(attributes: Column) -> Column:
    """The unit that a record was searched in, '' if it was the whole city."""
    whole = F.coalesce(F.try_element_at(attributes, F.lit("subdivision_scope")) == "city", F.lit(False))
    return F.when(whole, "").otherwise(strip(F.try_element_at(attributes, F.lit("administrative_unit"))))


def road_of(c: Column | str) -> Column:
    """The last road that a text names."""
    return F.coalesce(F.try_element_at(F.regexp_extract_all(compact(c), F.lit(ROAD), F.lit(1)), F.lit(-1)), F.lit(""))


def number_of(c: Column | str) -> Column:
    """The first house number of a text."""
    return group(compact(c), NUMBER)


def anchors_of(c: Column | str) -> Column:
    """Parks, then the first named place after the last number."""
    last = lambda v: F.try_element_at(F.regexp_extract_all(v, F.lit(NUMBER), F.lit(1)), F.lit(-1))
    scope = lambda v: let(last(v), lambda n: F.when(n.isNull(), v).otherwise(after(v, last_index(v, n) + F.length(n))))
    found = lambda v: F.concat(F.regexp_extract_all(v, F.lit(f"({PARKS})"), F.lit(1)), F.array(group(scope(v), NAMED_PLACE)))
    return F.array_distinct(F.filter(let(compact(c), found), lambda x: x != ""))


def number_key(c: Column | str) -> Column:
    return F.regexp_replace(compact(c), "(?:号院|号|院)$", "")


def admin_key(c: Column | str) -> Column:
    return F.regexp_replace(compact(c), ADMIN_END, "")


def name_key(c: Column | str) -> Column:
    return F.regexp_replace(text(c), NAME_MARKS, "")


def campus_key(c: Column | str) -> Column:
    """A name for comparison; 新 right before a campus word doesn't count."""
    return F.regexp_replace(name_key(c), "新(校区|校园)", "$1")


def tolerant_key(c: Column, city: Column, unit: Column) -> Column:
    """A name without status words and without the city, unit and town names before it, however many there are.

    Every turn but the last takes a prefix off, so there are no more turns than characters; the rest are skipped.
    """

    def step(v: Column) -> Column:
        town = group(v, f"({TOWN})")
        return (
            F.when((city != "") & F.startswith(v, city), after(v, F.length(city)))
            .when((unit != "") & F.startswith(v, unit), after(v, F.length(unit)))
            .when((town != "") & (F.length(v) > F.length(town)), after(v, F.length(town)))
            .otherwise(v)
        )

    def turn(state: Column, _: Column) -> Column:
        stripped = lambda new: F.struct(new.alias("v"), (new != state["v"]).alias("goes_on"))
        return F.when(state["goes_on"], let(step(state["v"]), stripped)).otherwise(state)

    first = name_key(F.regexp_replace(text(c), STATUS_WORDS, ""))
    turns = lambda begin: F.sequence(F.lit(1), F.length(begin) + 1)
    return let(first, lambda begin: F.aggregate(turns(begin), F.struct(begin.alias("v"), F.lit(True).alias("goes_on")), turn)["v"])


def names_match(a: Column, b: Column, city: Column, unit: Column) -> Column:
    return (campus_key(a) == campus_key(b)) | let(tolerant_key(a, city, unit), lambda loose: (loose != "") & (loose == tolerant_key(b, city, unit)))


def without_guides(c: Column | str) -> Column:
    return without_space(F.regexp_replace(text(c), GUIDES, ""))


def detail_score(address: Column, city: Column) -> Column:
    """How detailed an address is: struct of road, number, length, to be compared."""
    score = lambda place: F.struct((road_of(place) != "").alias("road"), (number_of(place) != "").alias("number"), F.length(place).alias("size"))
    return let(place_of(drop_prefix(compact(address), city)), score)


def road_relation(a: Column, b: Column) -> Column:
    base = lambda c: F.regexp_replace(c, "(?:辅路|[东南西北中])$", "")
    relation = lambda x, y: F.when(x == y, "equal").when(base(x) == base(y), "partial").when(F.endswith(x, y) | F.endswith(y, x), "suffix").otherwise("conflict")
    return let(F.struct(compact(a).alias("x"), compact(b).alias("y")), lambda p: relation(p["x"], p["y"]))
