"""Text columns: white space, lines, cells, headers.  Every builder takes and gives a Column; null counts as ''."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The 29 characters that Python counts as white space, written for Java and RE2 alike.
WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
#: Where a text breaks into lines.
BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
#: Marks without meaning in headers and labels.
LABEL_MARKS = WS[:-1] + r"（）():：、/\\_\-]+"
#: Marks without meaning when addresses are compared.
ADDRESS_MARKS = WS[:-1] + r"，,。；;：:（）()]+"
#: Marks without meaning when names are compared.
NAME_MARKS = WS[:-1] + r"()（）\[\]【】{}《》<>·\-—–_]"


def let(value: Column, body) -> Column:
    """``body(value)``, with the value worked out once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def stage(df: DataFrame, **columns: Column) -> DataFrame:
    """``withColumns`` whose results are worked out here, once.

    The optimizer folds the expressions of a projection into what refers to them, and pushes filters down by folding;
    through long chains that grows without bound.  A generator of one row is where it stops.
    """
    kept = [c for c in df.columns if c not in columns]
    made = df.select("*", F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("__stage"))
    return made.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"__stage.{n}").alias(n) for n in columns])


def text(c: Column | str) -> Column:
    """The column as text, '' for null."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def squeeze(c: Column | str) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text(c), WS + "+", " "))


def strip(c: Column | str) -> Column:
    """No white space at the ends."""
    return F.regexp_replace(text(c), f"^{WS}+|{WS}+$", "")


def without_space(c: Column | str) -> Column:
    return F.regexp_replace(text(c), WS + "+", "")


def compact(c: Column | str) -> Column:
    """No white space or common marks: what addresses are compared by."""
    return F.regexp_replace(text(c), ADDRESS_MARKS, "")


def header_key(c: Column | str) -> Column:
    """A table header without marks, in lower case."""
    return F.lower(F.regexp_replace(squeeze(c), LABEL_MARKS, ""))


def label_key(c: Column | str) -> Column:
    """A field label without marks; its case stays."""
    return F.regexp_replace(squeeze(c), LABEL_MARKS, "")


def cell_text(c: Column | str) -> Column:
    """Lines squeezed, blank ones dropped, the others kept apart."""
    lines = F.transform(F.split(text(c), BREAK), squeeze)
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def page_lines(c: Column | str) -> Column:
    """As ``cell_text``, and a line that repeats the one before it goes."""
    lines = F.filter(F.transform(F.split(F.regexp_replace(text(c), r"[\x{a0}\x{3000}]", " "), BREAK), lambda x: strip(F.regexp_replace(x, r"[ \t]+", " "))), lambda x: x != "")
    return let(lines, lambda a: F.array_join(F.filter(a, lambda x, i: (i == 0) | (x != F.get(a, i - 1))), "\n"))


def error_line(c: Column | str) -> Column:
    """A page error as one line."""
    return F.concat(F.lit("页面访问失败："), F.replace(page_lines(c), F.lit("\n"), F.lit(" | ")))


def contains_any(c: Column, keywords: Column) -> Column:
    return F.exists(keywords, lambda k: F.contains(c, k))


def after(c: Column, n: Column | int) -> Column:
    """The text without its first n characters."""
    return F.substring(c, (F.lit(n) if isinstance(n, int) else n) + 1, F.length(c))


def drop_prefix(c: Column, prefix: Column) -> Column:
    """The text without the prefix, where it has it."""
    return let(F.struct(c.alias("c"), prefix.alias("p")), lambda x: F.when((x["p"] != "") & F.startswith(x["c"], x["p"]), after(x["c"], F.length(x["p"]))).otherwise(x["c"]))


def last_index(c: Column, needle: Column | str) -> Column:
    """Offset from 0 of the last occurrence, -1 if there is none."""
    needle = F.lit(needle) if isinstance(needle, str) else needle
    return let(F.instr(F.reverse(c), F.reverse(needle)), lambda found: F.when(found > 0, F.length(c) - found + 1 - F.length(needle)).otherwise(F.lit(-1)))
