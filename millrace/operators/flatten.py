"""Nested records as flat columns: a walk over the schema, with a table of names."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], T.DataType]]:
    """The path and type of all that is no struct, in order; an array or a map is a leaf."""
    for f in schema.fields:
        here = (*path, f.name)
        if isinstance(f.dataType, T.StructType):
            yield from leaves(f.dataType, here)
        else:
            yield here, f.dataType


def _at(path: tuple[str, ...]) -> Column:
    return F.col(".".join(f"`{p}`" for p in path))


def flatten(df: DataFrame, names: dict[str, str | None] | None = None, deepest: int | None = None, arrays: str = "keep", sep: str = "_") -> DataFrame:
    """Every leaf as a column of its own, named by its path joined with sep.

    names maps dotted paths to column names; None leaves a path out.  A path that is a
    prefix renames all that lies below it (the longest prefix counts, and what is
    below it is added to its name).  Of two paths with one name the first that is not
    null counts, in the order of the schema, or of names where both stand there.
    deepest: structs below that depth stay whole.  arrays: "keep", "drop", or
    "flatten", which gives arrays of structs one array for each of their leaves.
    Missing branches of a path in names give no column.
    """
    names, order = names or {}, {}
    for k, path in enumerate(names):
        order[path] = k

    def named(path: tuple[str, ...]) -> str | None:
        for n in range(len(path), 0, -1):
            head = ".".join(path[:n])
            if head in names:
                new = names[head]
                return None if new is None else sep.join([new, *path[n:]])
        return sep.join(path)

    out: dict[str, list[tuple[tuple[int, int], Column]]] = {}

    def add(path: tuple[str, ...], c: Column) -> None:
        name = named(path)
        if name is not None:
            place = (order.get(".".join(path), len(order)), sum(map(len, out.values())))
            out.setdefault(name, []).append((place, c))

    def walk(schema: T.StructType, path: tuple[str, ...]) -> None:
        for f in schema.fields:
            here, kind = (*path, f.name), f.dataType
            if isinstance(kind, T.StructType) and (deepest is None or len(here) < deepest):
                walk(kind, here)
            elif isinstance(kind, T.ArrayType) and arrays == "drop":
                continue
            elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) and arrays == "flatten":
                for inner, _ in leaves(kind.elementType):
                    add((*here, *inner), F.transform(_at(here), _get(inner)))
            else:
                add(here, _at(here))

    walk(df.schema, ())
    return df.select(*[F.coalesce(*[c for _, c in sorted(cs, key=lambda x: x[0])]).alias(name) for name, cs in out.items()])


def _get(path: tuple[str, ...]):
    def one(x: Column) -> Column:
        for p in path:
            x = x[p]
        return x

    return one


#: The names that nested parts of an award get; other parts of agency, recipient and period go.
AWARD_NAMES = {
    "awarding_agency.toptier_agency.name": "awarding_agency_name",
    "awarding_agency.toptier_agency.toptier_code": "awarding_agency_code",
    "awarding_agency.subtier_agency.name": "awarding_sub_agency_name",
    "awarding_agency.subtier_agency.subtier_code": "awarding_sub_agency_code",
    "awarding_agency": None,
    "funding_agency.toptier_agency.name": "funding_agency_name",
    "funding_agency.toptier_agency.toptier_code": "funding_agency_code",
    "funding_agency.subtier_agency.name": "funding_sub_agency_name",
    "funding_agency.subtier_agency.subtier_code": "funding_sub_agency_code",
    "funding_agency": None,
    "recipient.recipient_name": "recipient_name",
    "recipient.location.state_code": "recipient_location_state",
    "recipient.location.country_code": "recipient_location_country",
    "recipient": None,
    "period_of_performance.start_date": "period_start_date",
    "period_of_performance.end_date": "period_end_date",
    "period_of_performance.current_end_date": "period_end_date",
    "period_of_performance": None,
    "period_of_performance_start_date": "period_start_date",
    "period_of_performance_current_end_date": "period_end_date",
    "generated_unique_award_id": "award_id",
    "total_obligation": "total_obligated_amount",
    "type": "award_type",
    "type_description": "award_type_description",
}
CONTRACT_TYPES, ASSISTANCE_TYPES = ("A", "B", "C", "D", "IDV"), tuple(f"{k:02d}" for k in range(2, 12))


def award_of(df: DataFrame, names: dict[str, str | None] = AWARD_NAMES) -> DataFrame:
    """A landed award as one flat row: parts renamed, blanks as null, the recipient in capitals and for the index in lower case, and category, fiscal year and kind of help from what is there."""
    flat = flatten(df, names, arrays="drop")
    texts = [f.name for f in flat.schema.fields if isinstance(f.dataType, T.StringType)]
    flat = flat.select(*[F.nullif(F.trim(c), F.lit("")).alias(c) if c in texts else F.col(c) for c in flat.columns])
    have = set(flat.columns)
    if "recipient_name" in have:
        flat = flat.withColumn("recipient_name", F.upper("recipient_name"))
    name = F.lower("recipient_name") if "recipient_name" in have else F.lit(None)
    flat = flat.withColumn("recipient_name_normalized", F.coalesce(name, F.lit("unknown")))
    if "period_start_date" in have:
        day = F.try_to_date(F.substring_index("period_start_date", "T", 1), "yyyy-MM-dd")
        flat = flat.withColumn("fiscal_year", F.year(day) + (F.month(day) >= 10).cast("int"))
    if "award_type" in have:
        flat = flat.withColumn("category", F.when(F.col("award_type").isin(*CONTRACT_TYPES), "contract").when(F.col("award_type").isin(*ASSISTANCE_TYPES), "assistance").otherwise("other"))
    return flat
