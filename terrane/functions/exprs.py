"""Column expressions of the parcel pipeline: keys, ratios, themes, roles, flags, id sets and angles.

All stay inside whole-stage code generation. Null themes read as empty text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical_key(c: Column) -> Column:
    """Null becomes '', a whole number written as decimal its integer text, other text trimmed."""
    text = F.trim(c.cast("string"))
    read = text.try_cast("double")
    number = F.when(F.abs(read) < 9e15, read)
    whole = number.isNotNull() & (number == F.floor(number))
    return F.when(c.isNull(), "").when(whole, number.cast("bigint").cast("string")).otherwise(text)


def safe_number(c: Column, default: float = 0.0) -> Column:
    """A finite number or the default."""
    n = c.cast("string").try_cast("double")
    return F.when(n.isNull() | F.isnan(n) | (F.abs(n) == float("inf")), F.lit(default)).otherwise(n)


def safe_ratio(num: Column, den: Column) -> Column:
    """A zero denominator counts as 1 (the result is not null)."""
    return num / F.when(den == 0, 1.0).otherwise(den)


def ratio_or_zero(num: Column, den: Column) -> Column:
    """A zero or null denominator gives 0."""
    return F.when(F.coalesce(den, F.lit(0.0)) == 0, 0.0).otherwise(num / den)


def lowered(*parts: Column) -> Column:
    return F.lower(F.concat_ws(" ", *parts))


def any_term(text: Column, terms: list[str], when_empty: bool) -> Column:
    """Any of the literal terms, case-insensitive; without terms all rows or none."""
    found = [F.coalesce(F.contains(F.lower(text), F.lit(t.lower())), F.lit(False)) for t in terms if t.strip()]
    return reduce(lambda a, b: a | b, found) if found else F.lit(when_empty)


def _role(text: Column, order: list[tuple[str, tuple[str, ...]]]) -> Column:
    t = F.coalesce(F.lower(text), F.lit(""))
    out = None
    for name, terms in order:
        hit = reduce(lambda a, b: a | b, [F.contains(t, F.lit(w)) for w in terms])
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("other")


_ROAD = ("road", ("road", "track", "path"))
#: The order of roles differs between the stages on purpose.
ROLE_ORDERS = {
    "preprocess": [("building", ("building",)), _ROAD, ("land", ("land",))],
    "anchor": [("building", ("building",)), ("land", ("land",)), _ROAD, ("gapfill", ("gap", "hole"))],
    "edge": [("building", ("building",)), ("land", ("land",))],
}


def role(text: Column, variant: str) -> Column:
    return _role(text, ROLE_ORDERS[variant])


def point_role(theme: Column, group: Column, term: Column) -> Column:
    """Eight roles from theme, descriptive group and term, hard roads first."""
    th, gr, te = (F.coalesce(F.lower(c), F.lit("")) for c in (theme, group, term))
    has = lambda c, *w: reduce(lambda a, b: a | b, [F.contains(c, F.lit(x)) for x in w])
    return (
        F.when(has(gr, "road or track") | has(te, "track"), "hard_road").when(has(th, "building") | has(gr, "building"), "building")
        .when(has(gr, "roadside"), "roadside").when(has(gr, "path") | has(te, "path"), "path")
        .when(has(th, "water") | has(gr, "watercourse") | has(te, "watercourse"), "water").when(has(th, "land"), "land")
        .when(has(th, "structure") | has(gr, "structure"), "structure").otherwise("other")
    )


def plot_eligible(theme: Column, exclude_roads: bool) -> Column:
    """Land or building; the anchor workflow leaves out roads, tracks and paths."""
    t = F.coalesce(F.lower(theme), F.lit(""))
    plot = F.contains(t, F.lit("land")) | F.contains(t, F.lit("building"))
    road = reduce(lambda a, b: a | b, [F.contains(t, F.lit(w)) for w in _ROAD[1]])
    return plot & ~road if exclude_roads else plot


def road_kept(text: Column, area: Column, perimeter: Column, width: float, most: float) -> Column:
    """Non-roads are kept; roads only if narrow (2 area / perimeter) and small."""
    is_road = F.coalesce(F.lower(text), F.lit("")).rlike("road|track|path")
    narrow = safe_ratio(area * 2.0, perimeter) <= F.lit(width)
    return ~is_road | (narrow & (area <= F.lit(most)))


def shape_warning(mrr: Column, hull_gap: Column, compactness: Column, least_mrr: float, most_gap: float, least_compact: float) -> Column:
    """Pipe-joined warnings in fixed order."""
    return F.concat_ws(
        "|", F.when(mrr < least_mrr, "low_mrr_ratio"), F.when(hull_gap > most_gap, "high_hull_gap"), F.when(compactness < least_compact, "low_compactness")
    )


def exclude_reason(rules: list[tuple[str, Column]]) -> Column:
    """First rule that holds; null where none does."""
    out = None
    for name, hit in rules:
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out if out is not None else F.lit(None).cast("string")


decide = exclude_reason


def truthy(c: Column) -> Column:
    """Numeric 1 or a word for yes."""
    t = F.lower(F.trim(c.cast("string")))
    return F.coalesce((t.try_cast("double") == 1.0) | t.isin("true", "yes", "y", "t"), F.lit(False))


def feature_columns(df: DataFrame, forbidden: list[str]) -> tuple[list[str], list[str]]:
    """(numeric, categorical) columns without ids, labels and model outputs; raises if a forbidden one slips in."""
    kept = [(n, t) for n, t in df.dtypes if n not in forbidden and not n.endswith(("_fid", "_id", "_fids", "_ids", "_proba"))]
    numeric = [n for n, t in kept if t in ("int", "bigint", "double", "float", "smallint", "tinyint", "boolean")]
    categorical = [n for n, t in kept if t == "string"]
    leaked = set(forbidden) & set(numeric + categorical)
    if leaked:
        raise ValueError(f"forbidden features: {sorted(leaked)}")
    return numeric, categorical


def prefixed(struct: str, names: list[str], prefix: str) -> list[Column]:
    """Fields of a struct as columns with a prefix."""
    return [F.col(f"{struct}.{n}").alias(prefix + n) for n in names]


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Missing columns are added, nulls of present ones replaced."""
    return df.select(
        *[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c) for c in df.columns],
        *[F.lit(v).alias(c) for c, v in defaults.items() if c not in df.columns],
    )


def ids_to_text(ids: Column) -> Column:
    """Sorted distinct ids joined by a pipe."""
    return F.array_join(F.array_sort(F.array_distinct(ids)), "|")


def text_to_ids(text: Column) -> Column:
    """Sorted distinct ids of a pipe text; junk is skipped, null gives an empty array."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), r"\|"), lambda p: F.trim(p).try_cast("double").try_cast("bigint"))
    return F.array_sort(F.array_distinct(F.filter(parts, lambda i: i.isNotNull())))


def axis_deviation(angle: Column, axis: Column) -> Column:
    """Deviation from an axis folded to 0..45 degrees."""
    return F.abs(F.pmod(angle - axis + 45.0, F.lit(90.0)) - 45.0)


def axis_delta(a: Column, b: Column) -> Column:
    """Difference of two directions with period 90 degrees."""
    d = F.pmod(a - b, F.lit(90.0))
    return F.least(d, F.lit(90.0) - d)


def half_even_bin(value: Column, width: Column) -> Column:
    """Histogram bin with ties to the even neighbour."""
    return F.bround(value / width).cast("bigint")
