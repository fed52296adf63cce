"""Whole documents as VARIANT (S1, S4, N1, N2): every leaf a landed page holds is kept, whatever its name or type.

Pages stay semi-structured from the landed text to the store; leaves become columns only where flat rows are asked for, and
then by a schema that one aggregate finds over all documents (``schema_of_variant_agg``, merged map-side).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaykit import schemas
from delaykit.operators.nested import flatten_paths
from delaykit.session import materialize

Path = tuple[str | int, ...]
_QUOTED_OR_OBJECT = re.compile(r"`(?:[^`]|``)*`|OBJECT<")


def variant_path(path: Path) -> str:
    """The path expression of a leaf; an integer is an array index."""
    return "$" + "".join(f"[{p}]" if isinstance(p, int) else '["' + p + '"]' for p in path)


def pages_of_documents(landing: DataFrame, api_name: str = "flightstatus", keep: Sequence[str] = ()) -> DataFrame:
    """One row per page of landed documents (``sources.files.read_documents``): its position and the page as VARIANT.

    ``page`` is the container's content; a page that isn't JSON, or lacks the container, has a NULL ``page`` and its text
    in ``page_text``."""
    pages = landing.select(*keep, F.posexplode("data").alias("page_pos", "page_text"))
    container = variant_path((schemas.container_for(api_name),))
    page = F.try_variant_get(F.try_parse_json("page_text"), container, "variant")
    return pages.select(*keep, "page_pos", page.alias("page"), "page_text")


def elements(node: Column, path: str) -> Column:
    """The elements of an array node; a lone object counts as an array of one, a missing or null node has none."""
    lone = F.try_variant_get(node, path, "variant")
    return F.coalesce(F.try_variant_get(node, path, "array<variant>"), F.when(lone.isNotNull() & ~F.is_variant_null(lone), F.array(lone)))


def document_flights(pages: DataFrame, keep: Sequence[str] = ("page_pos",), page: str = "page") -> DataFrame:
    """One row per flight, order kept (N1): ``flight_pos`` and the flight as VARIANT."""
    return pages.select(*keep, F.posexplode(elements(F.col(page), "$.Flights.Flight")).alias("flight_pos", "flight"))


def seen_schema(df: DataFrame, column: str) -> T.DataType:
    """The merged schema of a VARIANT column: one aggregate; the schema, not the data, reaches the driver.  Leaves whose
    types differ between documents are VARIANT."""
    text = df.agg(F.schema_of_variant_agg(column)).first()[0]
    return T.DataType.fromDDL(_QUOTED_OR_OBJECT.sub(lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], text))


def _array_paths(dtype: T.DataType, path: Path = ()):
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            yield from _array_paths(f.dataType, (*path, f.name))
    elif isinstance(dtype, T.ArrayType):
        yield path, dtype.elementType


def leaf_paths(df: DataFrame, column: str) -> list[Path]:
    """Paths of all leaves of a VARIANT column, by name; array elements by index, up to the longest array seen.

    One pass finds the schema, one more a level of arrays the lengths.  Arrays of mixed types are kept whole."""
    leaves: list[Path] = []
    todo: list[tuple[Path, T.DataType]] = [((), seen_schema(df, column))]
    while todo:
        arrays: list[tuple[Path, T.DataType]] = []
        for base, dtype in todo:
            leaves += [(*base, *p) for p in flatten_paths(dtype)] if not isinstance(dtype, T.ArrayType) else []
            arrays += [((*base, *p), element) for p, element in _array_paths(dtype)]
        inner = {p for p, _ in arrays}
        leaves = [p for p in leaves if p not in inner]
        todo = []
        if arrays:
            sizes = [F.max(F.size(F.try_variant_get(column, variant_path(p), "array<variant>"))).alias(f"n{i}")
                     for i, (p, _) in enumerate(arrays)]
            longest = df.agg(*sizes).first()
            for (p, element), n in zip(arrays, longest):
                for k in range(max(n or 0, 0)):
                    todo.append(((*p, k), element))
        scalar = [(p, t) for p, t in todo if not isinstance(t, T.StructType | T.ArrayType)]
        leaves += [p for p, _ in scalar]
        todo = [(p, t) for p, t in todo if isinstance(t, T.StructType | T.ArrayType)]
    return sorted(leaves, key=lambda p: [str(x) for x in p])


def flatten_documents(df: DataFrame, column: str, keep: Sequence[str] = (), known: Sequence[Path] = (), sep: str = "_",
                      paths: Sequence[Path] | None = None) -> DataFrame:
    """Leaves of a VARIANT column as text columns named by their path joined with ``sep`` (N2): the ``known`` paths in their
    order, whether they occur or not, then all others that occur (or the given ``paths``).

    Two leaves of one name share its column where only one has a value; names that differ only in case, which a table
    can't hold, get ``__2``, ``__3`` and so on."""
    found = leaf_paths(df, column) if paths is None else list(paths)
    by_name: dict[str, list[Path]] = {}
    for p in [*known, *[p for p in found if p not in set(known)]]:
        by_name.setdefault(sep.join(map(str, p)) or column, []).append(p)
    columns, taken = [], {k.lower() for k in keep}
    for name, same in by_name.items():
        unique, k = name, 2
        while unique.lower() in taken:
            unique, k = f"{name}__{k}", k + 1
        taken.add(unique.lower())
        columns.append(F.coalesce(*[F.try_variant_get(column, variant_path(p), "string") for p in same]).alias(unique))
    return df.select(*keep, *columns)


KNOWN_FLIGHT_PATHS: list[Path] = [tuple(p) for p in flatten_paths(schemas.FLIGHT)]


def materialized_flights(pages: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``document_flights`` written once, for jobs that read them several times (schema, documents, flat rows)."""
    return materialize(document_flights(pages, keep=keep), "flights")
