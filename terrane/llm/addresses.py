"""Postal addresses of one place written differently.

Method: a gazetteer built from the records themselves. Each record is cut into unit, number,
premise, postcode and phrases. Spellings of streets are clustered within their locality (spellings
that share a single-letter deletion belong to the most frequent one), every cluster gets a street
identifier, and each record is resolved by beam search over gazetteer entries: candidates by
spelling, kept to the BEAM best, then weighed by street type and postcode. Records meet on street
identifier, number and unit (or named premise).

Streets are looked up per distinct spelling, not per record, and only by equi-joins on locality and
spelling key; neither side is broadcast or collected.

Defined results
- a record without number and named premise, or without street, denotes no place and has no pairs;
- flat, apartment and unit with the same number are the same unit; ``2/48`` is unit 2 of number 48;
- a house letter, another range or another premise is another place;
- where the locality is missing, the street counts only if one locality alone has that street, or if
  a resolved record of the same street name, number and unit lies within NEAR metres;
- where the type of street is missing and the locality has several, the postcode or a near record decides;
- repeated rows count once; null fields and empty texts are missing parts; the newest row of a
  ``point_fid`` counts.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.internal import InternalFunction

from terrane.session import Scratch

BEAM, NEAR = 6, 30.0
FIELDS = ("address_premise", "address_number", "address_road", "address_locality", "postcode")

#: Kinds of street with their short forms, and further words of addresses.
STREET_TYPES = {
    "avenue": "avenue av ave aven avn", "grove": "grove gr grv gro", "close": "close cl clo cls", "court": "court ct crt cout",
    "street": "street st str strt", "lane": "lane la ln lne", "crescent": "crescent cr cres cresc crsnt", "terrace": "terrace ter terr tce",
    "road": "road rd", "gardens": "gardens gdn gdns gard garden gdens", "drive": "drive dr drv drve", "place": "place pl plc",
    "way": "way wy", "square": "square sq", "hill": "hill hl", "mews": "mews mws", "row": "row", "walk": "walk wlk", "park": "park pk",
    "rise": "rise", "green": "green grn", "view": "view vw", "parade": "parade pde", "fold": "fold", "yard": "yard yd", "path": "path",
}
PREFIXES = {
    "north": "north n nth no'th", "south": "south s sth", "east": "east e", "west": "west w", "upper": "upper up uppr upr u",
    "lower": "lower lwr low", "old": "old ol", "new": "new", "great": "great gt grt", "little": "little lt ltl", "saint": "saint st snt",
}
PREMISES = {
    "house": "house hse ho", "cottage": "cottage cott cot ctg", "lodge": "lodge ldg ldge", "villa": "villa vla", "barn": "barn brn",
    "mill": "mill ml", "farm": "farm fm", "hall": "hall hl", "tower": "tower twr", "building": "building bldg bld", "works": "works wks",
}


def _forms(table: dict[str, str]) -> dict[str, str]:
    return {form: name for name, forms in table.items() for form in forms.split()}


_TYPE, _PREFIX, _PREMISE = _forms(STREET_TYPES), _forms(PREFIXES), _forms(PREMISES)
_POSTCODE = re.compile(r"\b([a-z]{1,2}[0-9il][0-9ilo]?[a-z]?)[\s-]*([0-9oils][a-z]{2})\s*$")
_OUTCODE = re.compile(r"\b([a-z]{1,2}[0-9il][0-9ilo]?)\s*$")
_UNIT = re.compile(r"\(?\b(?:flat|flt|apartment|apt|appt|unit|suite|fl)\b\.?\s*(?:no\.?\s*)?([0-9]+\s*[a-z]?|[a-z])\b\)?")
_SLASH = re.compile(r"\b([0-9]+[a-z]?)\s*/\s*([0-9]+[a-z]?)\b")
_RANGE = re.compile(r"\b(?:nos?\.?\s*)?([0-9]+)\s*(?:-|–|—|\bto\b)\s*([0-9]+)\b")
_NUMBER = re.compile(
    r"(?:\bno\.?\s*|\bnumber\s*)?\b([0-9]+)"
    r"(?:\s*-\s*([a-z])\b|([a-z])\b|\s+([a-df-mo-rtvx-z])\b|\s+([nsewu])\b(?=\.?\s*(?:$|[,)])))?\.?"
)
_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")


def edits_one(a: str, b: str) -> bool:
    """Whether two words differ by one letter (put in, left out, exchanged or swapped with its neighbour)."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    return (a[i + 1 :] == b[i:]) if len(a) > len(b) else (a[i:] == b[i + 1 :])


@lru_cache(maxsize=100_000)
def _street_type(word: str) -> str | None:
    found = _TYPE.get(word)
    if found or len(word) < 5:
        return found
    return next((name for name in STREET_TYPES if len(name) > 4 and edits_one(word, name)), None)


@lru_cache(maxsize=100_000)
def _prefix(word: str) -> str | None:
    return _PREFIX.get(word) or next((p for p in PREFIXES if len(p) > 3 and edits_one(word, p)), None)


def split_postcode(text: str) -> tuple[str, str, str]:
    """(rest, area, inward part); letters read for digits are put right."""

    def area(s: str) -> str:
        head = re.match(r"[a-z]{1,2}(?=[0-9il])", s)
        n = head.end() if head else 1
        return s[:n] + s[n:].translate(str.maketrans("ilo", "110"))

    m = _POSTCODE.search(text)
    if m and re.search(r"[0-9]", m.group()):
        inward = m.group(2)
        return text[: m.start()], area(m.group(1)), inward[0].translate(str.maketrans("oils", "0115")) + inward[1:]
    m = _OUTCODE.search(text)
    if m and re.search(r"[0-9]", m.group()):
        return text[: m.start()], area(m.group(1)), ""
    return text, "", ""


def phrase(words: list[str]) -> tuple[str, str]:
    """(name, street type) of a phrase; the type is empty where its last word is none."""
    kind = _street_type(words[-1]) if len(words) > 1 else None
    if kind:
        words = words[:-1]
    prefix = _prefix(words[0]) if len(words) > 1 else None
    if prefix:
        words = [prefix + " ", *words[1:]]
    return "".join(words), kind or ""


def parse(premise: str | None, number: str | None, road: str | None, locality: str | None, postcode: str | None) -> tuple:
    """(unit, number, premise, area, inward, streets, places) of one record; streets are (name, type) pairs."""
    fields = [re.sub(r"\s+", " ", (f or "").casefold()).strip() for f in (premise, number, road, locality)]
    _, area, inward = split_postcode(re.sub(r"\s+", " ", (postcode or "").casefold()).strip())
    for i in (3, 2):
        found = _POSTCODE.search(fields[i])
        rest, a, b = split_postcode(fields[i]) if i == 3 or (found and re.search(r"[0-9]", found.group(1))) else (fields[i], "", "")
        if a:
            fields[i], area, inward = rest, area or a, inward or b
    unit = num = named = ""
    for i in range(4):
        m = _UNIT.search(fields[i])
        if m and not unit:
            unit = m.group(1).replace(" ", "")
            fields[i] = (fields[i][: m.start()] + " , " + fields[i][m.end() :]).strip(" ,")
    for i in (1, 0, 2, 3):
        if num:
            break
        text = fields[i]
        m = _SLASH.search(text)
        if m:
            unit, num = unit or m.group(1), m.group(2)
        else:
            m = _RANGE.search(text)
            if m:
                num = f"{int(m.group(1))}-{int(m.group(2))}"
            else:
                m = _NUMBER.search(text)
                if m:
                    num = str(int(m.group(1))) + next((g for g in m.groups()[1:] if g), "")
        if m:
            fields[i] = text[: m.start()] + " , " + text[m.end() :]
    streets, untyped, places = [], [], []
    for i in (0, 1, 2, 3):
        for part in re.split(r"[,;()]+", fields[i]):
            words = [w for w in _WORD.findall(part) if not w.isdigit()]
            if not words:
                continue
            if len(words) > 1 and words[-1] in _PREMISE and not named and not (i > 1 and _street_type(words[-1])):
                named = "".join(words[:-1]) + " " + _PREMISE[words[-1]]
            elif i == 0 and not named:
                named = "".join(words)
            else:
                name, kind = phrase(words)
                if kind:
                    streets.append((name, kind))
                else:
                    untyped.append((i, name))
    if streets:
        places = [n for _, n in untyped]
    else:
        streets = [(n, "") for _, n in untyped]
        places = [n for i, n in untyped if i == 3] + [n for i, n in untyped if i != 3][1:]
    if named and num and not unit:
        named = ""
    return unit, num, named, area, inward, list(dict.fromkeys(streets)), list(dict.fromkeys(places))


_STREET = T.StructType([T.StructField("name", T.StringType()), T.StructField("kind", T.StringType())])
_PARSED = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("unit", "number", "premise", "area", "inward")]
    + [T.StructField("streets", T.ArrayType(_STREET)), T.StructField("places", T.ArrayType(T.StringType()))]
)


def parsed(*fields: Column) -> Column:
    @F.pandas_udf(_PARSED)
    def run(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series, e: pd.Series) -> pd.DataFrame:
        rows = [parse(*r) for r in zip(a, b, c, d, e, strict=True)]
        rows = [(*r[:5], [dict(name=n, kind=k) for n, k in r[5]], r[6]) for r in rows]
        return pd.DataFrame(rows, columns=_PARSED.fieldNames())

    return run(*fields)


def spelling_keys(name: Column) -> Column:
    """The word itself and each form of it with one letter left out: two words that differ by one letter share one."""
    cut = F.transform(F.sequence(F.lit(1), F.length(name)), lambda i: F.concat(F.substring(name, F.lit(1), i - 1), F.substr(name, i + 1)))
    return F.array_distinct(F.concat(F.array(name), F.when(F.length(name) > 4, cut).otherwise(F.array().cast("array<string>"))))


def cluster_spellings(spellings: DataFrame, within: list[str], name: str, n: str) -> DataFrame:
    """(within..., name, canon): the most frequent spelling that shares a key and is at least twice as frequent."""
    keyed = spellings.withColumn("k", F.explode(spelling_keys(F.col(name))))
    other = keyed.select(*within, "k", F.col(name).alias("other"), F.col(n).alias("m"))
    better = (
        keyed.join(other, [*within, "k"]).where((F.col("m") >= 2 * F.col(n)) & (F.col("m") >= 2))
        .groupBy(*within, name).agg(F.max(F.struct("m", "other")).alias("b")).select(*within, name, F.col("b.other").alias("better"))
    )
    return spellings.join(better, [*within, name], "left").select(*within, name, F.coalesce("better", name).alias("canon"))


def same_place(records: DataFrame, scratch: Scratch) -> DataFrame:
    """(left_fid, right_fid), left < right, of records (point_fid, FIELDS..., x_27700, y_27700, edited_at) of one place."""
    newest = records.where("point_fid is not null").groupBy("point_fid").agg(
        F.max(F.struct("edited_at", *FIELDS, "x_27700", "y_27700")).alias("r")
    )
    base = scratch.put(
        newest.select("point_fid", F.col("r.x_27700").alias("x"), F.col("r.y_27700").alias("y"), parsed(*[F.col(f"r.{f}") for f in FIELDS]).alias("p"))
        .select("point_fid", "x", "y", "p.*").where("number <> '' or premise <> ''"),
        "parsed",
    )

    # Localities: names of places, their spellings, and the postcode area each belongs to.
    named = base.where("area <> '' and size(places) > 0").groupBy(F.col("places")[0].alias("place"), "area").agg(F.count("*").alias("n"))
    per_place = named.groupBy("place").agg(F.sum("n").alias("total"), F.max(F.struct("n", "area")).alias("top"))
    loose = base.where("area = '' and size(places) > 0").select(F.explode("places").alias("place")).groupBy("place").agg(F.count("*").alias("n0"))
    every = loose.join(per_place, "place", "full").select(
        "place", F.coalesce("total", F.lit(0)).alias("total"), F.when(F.col("top.n") * 2 >= F.col("total"), F.col("top.area")).alias("home")
    )
    every = scratch.put(every, "places")
    canon = _place_canon(every)
    homes = scratch.put(
        canon.join(every.select(F.col("place").alias("canon"), F.col("home")), "canon", "left").where("home is not null").select("place", "home"), "homes"
    )
    missing = base.where("area = ''").select("point_fid", F.posexplode_outer("places").alias("i", "place"))
    found = missing.join(homes, "place").groupBy("point_fid").agg(F.min_by("home", "i").alias("home"))
    placed = scratch.put(
        base.join(found, "point_fid", "left").withColumn("area", F.when(F.col("area") == "", F.coalesce("home", F.lit(""))).otherwise(F.col("area"))).drop("home", "places"),
        "placed",
    )

    # Gazetteer: clusters of spellings within each locality and kind of street.
    asked = placed.select("point_fid", "area", "inward", F.explode("streets").alias("s")).select("point_fid", "area", "inward", "s.name", "s.kind")
    asked = asked.where("name <> ''")
    spelt = asked.where("area <> '' and kind <> ''").groupBy("area", "kind", "name").agg(F.count("*").alias("n"))
    spelt = scratch.put(spelt, "spelt")
    canon = scratch.put(cluster_spellings(spelt, ["area", "kind"], "name", "n"), "canon")
    by_code = scratch.put(
        asked.where("area <> '' and kind <> '' and inward <> ''").join(canon, ["area", "kind", "name"])
        .groupBy("area", "inward", "canon", "kind").agg(F.count("*").alias("coded")),
        "by_code",
    )
    entries = scratch.put(
        canon.join(spelt, ["area", "kind", "name"]).groupBy("area", "kind", "canon").agg(F.sum("n").alias("n")), "entries"
    )

    # Beam search, once per distinct way of asking.
    ways = scratch.put(asked.select("area", "inward", "name", "kind").distinct(), "ways")
    keyed = entries.withColumn("k", F.explode(spelling_keys(F.col("canon")))).select(
        "area", "k", "canon", F.col("kind").alias("ekind"), "n"
    )
    probe = ways.where("area <> ''").withColumn("k", F.explode(spelling_keys(F.col("name"))))
    by_name = probe.join(keyed, ["area", "k"]).where("kind = '' or kind = ekind").select("area", "inward", "name", "kind", "canon", "ekind", "n")
    told = canon.join(entries.select("area", "kind", "canon", "n"), ["area", "kind", "canon"])
    by_spelling = ways.where("area <> '' and kind <> ''").join(told, ["area", "kind", "name"]).select("area", "inward", "name", "kind", "canon", F.col("kind").alias("ekind"), "n")
    by_postcode = ways.where("area <> '' and inward <> ''").join(
        by_code.select("area", "inward", "canon", F.col("kind").alias("ekind"), F.col("coded").alias("n")), ["area", "inward"]
    ).where("levenshtein(name, canon) <= 3 and (kind = '' or kind = ekind)").select("area", "inward", "name", "kind", "canon", "ekind", "n")
    # Without a locality: streets whose name and kind only one locality has.
    alone = entries.groupBy("canon", "kind").agg(F.count("*").alias("c"), F.first("area").alias("only"), F.sum("n").alias("n")).where("c = 1")
    alone_keyed = alone.withColumn("k", F.explode(spelling_keys(F.col("canon")))).select("k", "kind", "canon", "only", "n")
    unplaced = (
        ways.where("area = '' and kind <> ''").withColumn("k", F.explode(spelling_keys(F.col("name")))).join(alone_keyed, ["k", "kind"])
        .select("area", "inward", "name", "kind", "canon", F.col("kind").alias("ekind"), "n", "only")
    )
    hypotheses = by_name.unionByName(by_spelling).unionByName(by_postcode).withColumn("only", F.col("area")).unionByName(unplaced)
    way = ["area", "inward", "name", "kind"]
    hypotheses = hypotheses.groupBy(*way, "canon", "ekind", "only").agg(F.max("n").alias("n"))
    near = (F.lit(0) - F.levenshtein("name", "canon")).cast("double")
    first = hypotheses.groupBy(*way).agg(
        InternalFunction.collect_top_k(F.struct(near.alias("near"), "n", "canon", "ekind", "only"), BEAM, False).alias("beam")
    )
    second = first.select(*way, F.explode("beam").alias("h")).select(*way, "h.near", "h.n", "h.canon", "h.ekind", "h.only")
    evidence = by_code.select(F.col("area").alias("only"), "inward", "canon", F.col("kind").alias("ekind"), "coded")
    weighed = second.join(evidence, ["only", "inward", "canon", "ekind"], "left").withColumn(
        "score", F.col("near") + F.when(F.col("coded").isNotNull(), 1.5).otherwise(0.0) + F.when(F.col("kind") == F.col("ekind"), 1.0).otherwise(0.0)
    )
    best = weighed.groupBy(*way).agg(
        InternalFunction.collect_top_k(F.struct("score", "n", "canon", "ekind", "only"), 2, False).alias("b")
    ).select(*way, F.array_sort("b").alias("b"))
    top, next_ = F.element_at("b", -1), F.col("b")[0]
    sure = (F.size("b") < 2) | (top["score"] > next_["score"] + 0.4) | (F.col("kind") != "")
    resolved = scratch.put(
        best.select(*way, top["score"].alias("score"), top["canon"].alias("canon"), top["ekind"].alias("ekind"), top["only"].alias("home"), sure.alias("sure")),
        "resolved",
    )

    # Each record takes its best street; what stays unresolved keeps its own spelling.
    chosen = asked.join(resolved, way, "left").groupBy("point_fid").agg(
        F.max(F.struct(F.coalesce("score", F.lit(-99.0)).alias("score"), "sure", "home", "canon", "ekind", "name", "kind")).alias("c")
    )
    full = placed.join(chosen, "point_fid").select(
        "point_fid", "unit", "number", "premise", "x", "y",
        F.when(F.col("c.sure"), F.concat_ws("|", "c.home", "c.canon", "c.ekind"))
        .when((F.col("area") != "") & (F.col("c.kind") != ""), F.concat_ws("|", "area", "c.name", "c.kind")).alias("street"),
        F.coalesce("c.canon", "c.name").alias("canon"),
    )
    full = scratch.put(full, "full")
    # Records without a certain street take that of a near record with the same street name, number and unit.
    x, y = F.col("x"), F.col("y")
    spot = ["canon", "number", "unit", "premise"]
    known = full.where("street is not null and x is not null and y is not null")
    open_ = full.where("street is null and x is not null and y is not null")
    around = F.explode(F.array(*[F.struct((F.floor(x / NEAR) + i).alias("cx"), (F.floor(y / NEAR) + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    homes2 = known.select(*spot, "street", x.alias("kx"), y.alias("ky"), F.floor(x / NEAR).alias("cx"), F.floor(y / NEAR).alias("cy")).distinct()
    closest = (
        open_.select("point_fid", *spot, "x", "y", around.alias("c")).select("point_fid", *spot, "x", "y", "c.cx", "c.cy")
        .join(homes2, [*spot, "cx", "cy"])
        .withColumn("d", (F.col("x") - F.col("kx")) ** 2 + (F.col("y") - F.col("ky")) ** 2).where(F.col("d") <= NEAR * NEAR)
        .groupBy("point_fid").agg(F.min_by("street", F.struct("d", "street")).alias("street"))
    )
    final = full.where("street is not null").select("point_fid", "street", "number", "unit", "premise").unionByName(
        full.drop("street").join(closest, "point_fid").select("point_fid", "street", "number", "unit", "premise")
    )
    final = scratch.put(final, "final")
    key = ["street", "number", "unit", "premise"]
    left, right = final.withColumnRenamed("point_fid", "left_fid"), final.withColumnRenamed("point_fid", "right_fid")
    return left.join(right, key).where("left_fid < right_fid").select("left_fid", "right_fid").distinct()


def _place_canon(every: DataFrame) -> DataFrame:
    """(place, canon) of place names: the most frequent spelling that shares a key and is twice as frequent."""
    keyed = every.select("place", "total", F.explode(spelling_keys(F.col("place"))).alias("k"))
    other = keyed.select("k", F.col("place").alias("other"), F.col("total").alias("m"))
    better = (
        keyed.join(other, "k").where((F.col("m") >= 2 * F.col("total")) & (F.col("m") >= 3))
        .groupBy("place").agg(F.max(F.struct("m", "other")).alias("b")).select("place", F.col("b.other").alias("better"))
    )
    return every.select("place").join(better, "place", "left").select("place", F.coalesce("better", "place").alias("canon"))
