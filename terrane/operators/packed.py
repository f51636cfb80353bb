"""Several values packed in one text field, one row each with its position.

Method: every text gets a *delimiter skeleton* (runs of digits and of ordinary characters masked,
delimiters, quotes and brackets kept, repeated units kept once). A splitting rule is resolved once per
distinct skeleton: which delimiters split, which quotes close, whether quoted values may hold
delimiters. The rules are broadcast (behind a check of their number and size), and the values are cut
out of the text at the delimiters of its rule, with JVM expressions only.

Defined results
- null, empty and blank fields, ``[]`` and words such as ``nan`` or ``none`` give no rows;
- empty places (``1||2``) do not count as positions;
- ``1008577.0`` is the whole number ``1008577``; ``1.5``, ``12e3`` and ``2024-01-05`` are one item each;
- a quoted value with anything but whole numbers in it is one item, without its quotes, doubled quotes
  read as one; quotes round several whole numbers do not join them;
- several delimiters in one text all split; a blank splits only where it stands between two numbers;
- an apostrophe within a word is no quote; a quote that is never closed is left out;
- unquoted values without any digit are no ids; repeated ids count again; repeated rows count once;
- a null row id is kept as null.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrane.session import Scratch

#: Kinds of rule: nothing to take; cut at every mark; quoted values may hold marks.
NOTHING, CUT, QUOTED = 0, 1, 2
#: More skeletons, or more characters in them, are joined by shuffle instead of broadcast.
MAX_BROADCAST_SKELETONS, MAX_BROADCAST_CHARS = 100_000, 8_000_000
#: Words that stand for "nothing" where they are quoted.
NOTHING_WORDS = ("nan", "none", "null", "nil", "n/a", "na", "nothing", "-", "--", "?", "unknown", "empty")

HARD, BLANKS, BRACKETS, QUOTES = "|;,/&", " \t\n\r\u00a0", "[](){}", "\"'"
#: Stands for every mark that splits.
_SEP = "\u0001"
_BETWEEN = r"[^9a.\"']{1,4}"
_RULE = T.StructType([T.StructField("kind", T.IntegerType())] + [T.StructField(n, T.StringType()) for n in ("marks", "seps", "token")])


def skeleton(text: Column) -> Column:
    """Digits become 9, other ordinary characters a. Where there are quotes, marks stay in their order and a repeated unit of
    value and delimiter is kept once; where there are none, each delimiter is kept once, in the order of HARD, for then order
    does not matter: ``9|9;9 9``."""
    masked = F.regexp_replace(text, r"[0-9]+", "9")
    masked = F.regexp_replace(masked, "[^9\\s\\u00A0\"'|,;/&.\\[\\](){}]+", "a")
    masked = F.regexp_replace(masked, r"[\s\u00A0]+", " ")
    masked = F.regexp_replace(masked, rf"([\"']?9(?:\.9)?[\"']?{_BETWEEN})\1+(?=[\"']?[9a])", "$1")
    quoted = F.regexp_replace(masked, rf"(\"[^\"]*\"{_BETWEEN}|'[^']*'{_BETWEEN})\1+(?=[\"']?[9a])", "$1")
    marks = [F.when(F.contains(text, F.lit(d)), f"9{d}").otherwise("") for d in HARD]
    bare = F.concat(*marks, F.when(text.rlike(r"[0-9][\s\u00A0]+[0-9]"), "9 ").otherwise(""), F.when(text.rlike("[0-9]"), "9").otherwise("a"))
    return F.when(F.contains(text, F.lit('"')) | F.contains(text, F.lit("'")), quoted).otherwise(bare)


def rule_of(shape: str | None) -> tuple[int, str, str, str]:
    """(kind, marks that split, what they become, pattern of a token) of one skeleton."""
    if not shape or not re.search("[9a]", shape):
        return NOTHING, "", "", ""
    edge = "[" + re.escape(HARD + BRACKETS) + r"\s]"
    quotes, regions, outside = "", [], shape
    for q in QUOTES:
        region = rf"(?:(?<=^)|(?<={edge})){q}((?:[^{q}]|{q}{q})*){q}(?=$|{edge})"
        found = re.findall(region, outside)
        if found:
            quotes, regions, outside = quotes + q, regions + found, re.sub(region, "9", outside)
    plain = [r for r in regions if re.fullmatch("[9." + re.escape(HARD + BRACKETS) + r"\s]*", r)]
    seen = outside + "".join(" ; " + r for r in plain)
    marks = "".join(d for d in HARD if d in outside or any(d in r for r in plain))
    blank = bool(re.search(r"9 (?=9)", seen))
    marks += BRACKETS + (BLANKS if blank else "")
    if len(plain) < len(regions):
        held = re.escape(marks + quotes)
        token = "|".join([rf"{q}(?:[^{q}]|{q}{q})*{q}" for q in quotes] + [f"[^{held}]+"])
        return QUOTED, marks, _SEP * len(marks), token
    if "9" not in shape:
        return NOTHING, "", "", ""
    marks += quotes
    seps = _SEP * len(marks)
    return CUT, marks + ("" if blank else BLANKS), seps + ("" if blank else " " * len(BLANKS)), ""


@F.pandas_udf(_RULE)
def _rule(shapes: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([rule_of(s) for s in shapes], columns=_RULE.fieldNames()).astype({"kind": "int32"})


def _bare(item: Column) -> Column:
    """Without blanks and stray quotes round it; a whole number as its digits."""
    item = F.btrim(item, F.lit(QUOTES + BLANKS))
    return F.when(item.rlike(r"^[0-9]+\.0+$"), F.substring_index(item, ".", 1)).otherwise(item)


def items_by_rule(text: Column, rule: Column) -> Column:
    """array<string> of the bare ids of a text, in order."""

    def cut(t: Column) -> Column:
        return F.transform(F.filter(F.split(F.call_function("translate", t, rule["marks"], rule["seps"]), _SEP), lambda x: x.rlike("[0-9]")), _bare)

    def token(t: Column) -> Column:
        q = F.substring(t, 1, 1)
        closed = q.isin(*QUOTES) & (F.length(t) > 1) & (F.substring(t, -1, 1) == q)
        inner = F.btrim(F.replace(F.substr(t, F.lit(2), F.length(t) - 2), F.concat(q, q), q), F.lit(BLANKS))
        several = inner.rlike(r"^[\s\u00A0|,;/&.\[\](){}0-9]*$")
        return F.when(~closed | several, F.when(closed, cut_all(inner)).otherwise(F.filter(F.array(_bare(t)), lambda x: x.rlike("[0-9]")))).when(
            F.lower(inner).isin(*NOTHING_WORDS), F.array().cast("array<string>")
        ).otherwise(F.array(inner))

    def cut_all(t: Column) -> Column:
        every = HARD + BRACKETS + BLANKS
        return F.transform(F.filter(F.split(F.translate(t, every, _SEP * len(every)), _SEP), lambda x: x.rlike("[0-9]")), _bare)

    quoted = F.flatten(F.transform(F.regexp_extract_all(text, rule["token"], F.lit(0)), token))
    return F.when(rule["kind"] == CUT, cut(text)).when(rule["kind"] == QUOTED, quoted)


def split_packed(df: DataFrame, field: str, out: str = "items") -> DataFrame:
    """``df`` with ``out`` = array<string> of the ids in ``field``; rows without any id get null.

    Other columns of ``df`` are kept as they are, whatever their names.
    """
    key = _free(df, "_skeleton")
    rules = _free(df, "_rule")
    shaped = df.withColumn(key, skeleton(F.col(f"`{field}`")))
    distinct = (
        shaped.select(F.col(f"`{key}`").alias("_s")).where(F.col("_s").isNotNull()).distinct()
        .withColumn("_r", _rule("_s")).where(F.col("_r.kind") != NOTHING)
    )
    book = Scratch(df.sparkSession, "skeletons").put(distinct.select(F.col("_s").alias(key), F.col("_r").alias(rules)), "book")
    size = book.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length(F.col(f"`{key}`"))), F.lit(0)).alias("chars")).first()
    few = size["n"] <= MAX_BROADCAST_SKELETONS and size["chars"] <= MAX_BROADCAST_CHARS
    joined = shaped.join(F.broadcast(book) if few else book, key, "left")
    return joined.withColumn(out, items_by_rule(F.col(f"`{field}`"), F.col(f"`{rules}`"))).drop(key, rules)


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def unpack(df: DataFrame) -> DataFrame:
    """(src, row_id, packed) to distinct (src, row_id, pos, item)."""
    return (
        split_packed(df.select("src", "row_id", "packed"), "packed", "items")
        .select("src", "row_id", F.posexplode("items").alias("p", "item"))
        .select("src", "row_id", (F.col("p") + 1).cast("int").alias("pos"), "item")
        .distinct()
    )
