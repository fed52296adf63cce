"""Nested documents: unnest, flatten, re-nest, long -> wide.

Landed API files hold ``data: [page..]``, each page ``{container: {Flights:
{Flight: [..]}, Meta: {...}}}``.  Positions are carried explicitly
(``posexplode``) so file order survives distribution.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaykit import schemas
from delaykit.operators.profile import range_checksum
from delaykit.session import scratch_path


def pages_of(landing: DataFrame, api_name: str = "flightstatus", keep: Sequence[str] = ()) -> DataFrame:
    """One row per API page with its position in the file (P2 chooses the container)."""
    container = schemas.container_for(api_name)
    return (landing.select(*keep, F.posexplode("data").alias("page_pos", "__page"))
                   .select(*keep, "page_pos", F.col(f"__page.`{container}`").alias("page")))


def repair_lone(text_col: str, element: T.StructType) -> Column:
    """Parse a node read as text as an array: a lone object is wrapped into a
    one-element array first (the API sends an object when there is one element)."""
    txt = F.trim(F.col(text_col))
    as_array = F.when(txt.startswith("{"), F.concat(F.lit("["), txt, F.lit("]"))).otherwise(txt)
    return F.from_json(as_array, T.ArrayType(element))


def repair_lone_flight(pages: DataFrame, text_col: str = "page.Flights.Flight", element: T.StructType | None = None) -> Column:
    """The ``Flight`` node of pages read as text, as an array of ``element`` (default: the known flight leaves;
    see ``infer_flight`` to keep every leaf that occurs)."""
    return repair_lone(text_col, schemas.FLIGHT if element is None else element)


def page_links(pages: DataFrame) -> Column:
    """The ``Link`` array of pages, parsed when it was read as text."""
    link = pages.select("page.Meta.Link").schema[0].dataType
    return F.col("page.Meta.Link") if isinstance(link, T.ArrayType) else repair_lone("page.Meta.Link", schemas.META["Link"].dataType.elementType)


def repaired_page(pages: DataFrame) -> Column:
    """A page read as text with its lone objects repaired (the document the page store keeps)."""
    flights = F.struct(repair_lone_flight(pages).alias("Flight"))
    meta = F.struct(F.col("page.Meta.TotalCount").alias("TotalCount"), page_links(pages).alias("Link"))
    return F.struct(flights.alias("Flights"), F.when(F.col("page.Meta").isNotNull(), meta).alias("Meta"))


def infer_flight(pages: DataFrame, text_col: str = "page.Flights.Flight") -> T.StructType:
    """Union of the keys of all ``Flight`` objects (read as text): the known leaves and every other that occurs.

    The objects are written as text to the shared scratch folder and read back for their schema; only the merged schema reaches the driver."""
    txt = F.trim(F.col(text_col))
    as_array = F.when(txt.startswith("{"), F.concat(F.lit("["), txt, F.lit("]"))).otherwise(txt)
    texts = pages.filter(txt.isNotNull()).select(as_array.alias("t"))
    path = scratch_path(pages.sparkSession, f"delaykit-leaves-{uuid.uuid4().hex}")
    texts.select(F.concat(F.lit('{"f":'), F.translate("t", "\r\n", "  "), F.lit("}")).alias("value")).write.text(path)  # one object a line
    seen = pages.sparkSession.read.option("primitivesAsString", True).json(path).schema
    found = seen["f"].dataType if "f" in seen.fieldNames() else None
    element = found.elementType if isinstance(found, T.ArrayType) else None
    return _union_fields(schemas.FLIGHT, element if isinstance(element, T.StructType) else T.StructType())


def _union_fields(known: T.StructType, seen: T.StructType) -> T.StructType:
    """``known`` in its order, nested structs widened, then the fields only ``seen`` has."""
    by_name = {f.name: f for f in seen.fields}
    out = []
    for f in known.fields:
        other = by_name.pop(f.name, None)
        if isinstance(f.dataType, T.StructType) and other is not None and isinstance(other.dataType, T.StructType):
            f = T.StructField(f.name, _union_fields(f.dataType, other.dataType))
        out.append(f)
    return T.StructType(out + list(by_name.values()))


def flights_of(pages: DataFrame, keep: Sequence[str] = ("page_pos",), flights: Column | None = None) -> DataFrame:
    """Unnest ``Flights.Flight`` to one row per flight, order kept."""
    arr = F.col("page.Flights.Flight") if flights is None else flights
    return pages.select(*keep, F.posexplode(arr).alias("flight_pos", "flight"))


def _flatten_fields(dtype: T.DataType, path: list[str], array_slots: int):
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            yield from _flatten_fields(f.dataType, path + [f.name], array_slots)
    elif isinstance(dtype, T.ArrayType) and array_slots > 0:
        for i in range(array_slots):
            yield from _flatten_fields(dtype.elementType, path + [str(i)], 0)
    else:
        yield path


def flatten_paths(dtype: T.DataType) -> list[list[str]]:
    """Paths of the leaves of a schema; an array counts as a leaf."""
    return list(_flatten_fields(dtype, [], 0))


def flatten(df: DataFrame, column: str | None = None, sep: str = "_", array_slots: int = 0) -> DataFrame:
    """Flatten nested structs to leaf columns named by the path joined with ``sep``.

    ``Arrival.ScheduledTimeUTC.DateTime`` becomes ``Arrival_ScheduledTimeUTC_DateTime``.
    With ``array_slots`` > 0, the first N array elements become ``name_0 .. name_{N-1}``.
    Schema driven at plan time: the result is one projection.
    """
    schema = df.schema if column is None else df.schema[column].dataType
    cols = []
    for path in _flatten_fields(schema, [] if column is None else [column], array_slots):
        expr = None
        for part in path:
            if expr is None:
                expr = F.col(f"`{part}`")
            elif part.isdigit():
                expr = F.get(expr, F.lit(int(part)))  # NULL past the end
            else:
                expr = expr.getField(part)
        name_path = path if column is None else path[1:]
        cols.append(expr.alias(sep.join(name_path)))
    return df.select(*cols)


def collect_nested(df: DataFrame, key_cols: Sequence[str], pos_col: str, item_cols: Sequence[str],
                   name: str = "items") -> DataFrame:
    """Re-nest rows into one array per key, ordered by ``pos_col``.

    A group is one landed document (a file's flights), so the array is bounded
    by a document's size.
    """
    items = F.sort_array(F.collect_list(F.struct(F.col(pos_col).alias("__pos"), *[F.col(c) for c in item_cols])))
    stripped = F.transform(F.col("__items"), lambda x: F.struct(*[x[c].alias(c) for c in item_cols]))
    return df.groupBy(*key_cols).agg(items.alias("__items")).select(*key_cols, stripped.alias(name))


def long_to_wide(df: DataFrame, key_cols: Sequence[str], var_col: str, value_col: str,
                 variables: Sequence[str], agg: str = "first") -> DataFrame:
    """Long -> wide with the variable list given up front (N4), so no extra job
    discovers the pivot values.  ``agg`` is ``first`` (one value per cell),
    ``sum``, ``max``, ``min`` or ``count``."""
    fn = {"first": lambda c: F.first(c, ignorenulls=True), "sum": F.sum, "max": F.max,
          "min": F.min, "count": F.count}[agg]
    return df.groupBy(*key_cols).pivot(var_col, list(variables)).agg(fn(F.col(value_col)))


def endpoint_checksums(pages: DataFrame, flights: Column | None = None) -> DataFrame:
    """Per endpoint (URL before ``?`` of the page's first link): flights received
    vs the declared ``TotalCount`` (A11).  Every endpoint is checked; pages without a link share the NULL endpoint."""
    endpoint = F.substring_index(F.get(page_links(pages), F.lit(0))["@Href"], "?", 1)
    arr = F.col("page.Flights.Flight") if flights is None else flights
    n = F.greatest(F.coalesce(F.size(arr), F.lit(0)), F.lit(0))
    return range_checksum(pages, endpoint, n, F.col("page.Meta.TotalCount"))
