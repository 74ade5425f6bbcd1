"""Regions, rings and matrices of labels.

Regions and matrices are plain column expressions. Rings come in four nested encodings, which SQL cannot take apart, so
what needs them runs in Arrow batches, on the Python values of marlspark.kernels.shapes.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlspark.kernels.shapes import Matrix, box_share, clipped, moved_rings, ring_area, rings_of

__all__ = ["Matrix", "affine", "box_metric", "box_share", "clipped", "composed", "matrix_rows", "moved", "moved_rings", "reconciled_roi", "ring_area", "rings_of", "roi_bounds", "rotation"]


def roi_bounds(value: Column, width: Column, height: Column) -> Column:
    """struct(l, t, r, b, error) of a region in JSON: [w, h], [l, t, r, b], {x, y, width, height} or {width, height}.

    error is '' for a region inside the frame and with an area; otherwise the corners are null. What is not a number is
    malformed, never a fault of the job; x and y count only where both are there; a null region is missing.
    """
    text = lambda p: F.get_json_object(value, p)
    at = lambda p: text(p).try_cast("double")
    n = F.json_array_length(value)
    keyed = n.isNull() & text("$.width").isNotNull() & text("$.height").isNotNull()
    placed = text("$.x").isNotNull() & text("$.y").isNotNull()
    zero = F.lit(0.0)
    x, y = (F.when(placed, at(p)).otherwise(zero) for p in ("$.x", "$.y"))
    corners = {
        "l": F.when(n == 2, zero).when(n == 4, at("$[0]")).when(keyed, x),
        "t": F.when(n == 2, zero).when(n == 4, at("$[1]")).when(keyed, y),
        "r": F.when(n == 2, at("$[0]")).when(n == 4, at("$[2]")).when(keyed, x + at("$.width")),
        "b": F.when(n == 2, at("$[1]")).when(n == 4, at("$[3]")).when(keyed, y + at("$.height")),
    }
    left, top, right, bottom = corners.values()
    known = left.isNotNull() & top.isNotNull() & right.isNotNull() & bottom.isNotNull()
    inside = (left >= 0) & (top >= 0) & (right <= width) & (bottom <= height) & (left < right) & (top < bottom)
    error = F.when(value.isNull(), "missing").when(~known, "malformed").when(~inside, "out of bounds").otherwise("")
    return F.struct(*[F.when(error == "", c).alias(k) for k, c in corners.items()], error.alias("error"))


def reconciled_roi(first: Column, second: Column) -> Column:
    """Of two regions as given by roi_bounds the one that is there; an error if both are and differ, or neither is."""
    both = (first["error"] == "") & (second["error"] == "")
    corners = ["l", "t", "r", "b"]
    differ = F.lit(False)
    for k in corners:
        differ = differ | ~first[k].eqNullSafe(second[k])
    bad = F.when(~first["error"].isin("", "missing"), first["error"]).when(~second["error"].isin("", "missing"), second["error"])
    error = F.coalesce(bad, F.when(both & differ, "conflict").when((first["error"] != "") & (second["error"] != ""), "missing").otherwise(""))
    return F.struct(*[F.when(error == "", F.coalesce(first[k], second[k])).alias(k) for k in corners], error.alias("error"))


def affine(a: float | Column, b: float | Column, d: float | Column, e: float | Column, x: float | Column, y: float | Column) -> Column:
    """The matrix that takes (u, v) to (a u + b v + x, d u + e v + y)."""
    names = ("a", "b", "d", "e", "x", "y")
    return F.struct(*[(c if isinstance(c, Column) else F.lit(float(c))).alias(n) for n, c in zip(names, (a, b, d, e, x, y), strict=True)])


def composed(first: Column, then: Column) -> Column:
    """The matrix of first and then the other."""
    m, n = first, then
    return affine(
        n["a"] * m["a"] + n["b"] * m["d"], n["a"] * m["b"] + n["b"] * m["e"],
        n["d"] * m["a"] + n["e"] * m["d"], n["d"] * m["b"] + n["e"] * m["e"],
        n["a"] * m["x"] + n["b"] * m["y"] + n["x"], n["d"] * m["x"] + n["e"] * m["y"] + n["y"],
    )


def moved(m: Column, u: Column, v: Column) -> Column:
    """struct(x, y): the point (u, v) under the matrix."""
    return F.struct((m["a"] * u + m["b"] * v + m["x"]).alias("x"), (m["d"] * u + m["e"] * v + m["y"]).alias("y"))


def rotation(degrees: Column, u: Column, v: Column) -> Column:
    """The matrix that turns about the point (u, v)."""
    c, s = F.cos(F.radians(degrees)), F.sin(F.radians(degrees))
    return affine(c, -s, s, c, u - c * u + s * v, v - s * u - c * v)


def matrix_rows(m: Column) -> Column:
    """The matrix as three rows of three numbers."""
    row = lambda *cells: F.array(*cells)
    return F.array(row(m["a"], m["b"], m["x"]), row(m["d"], m["e"], m["y"]), row(F.lit(0.0), F.lit(0.0), F.lit(1.0)))


METRIC = T.StructType([T.StructField("share", T.DoubleType()), T.StructField("parts", T.IntegerType()), T.StructField("error", T.StringType())])


@F.pandas_udf(METRIC)
def box_metric(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
    """box_share of points in JSON and struct(l, t, r, b); the reason is in error where the points cannot be read."""
    for points, box in batches:
        rows = []
        for text, *corners in zip(points, box["l"], box["t"], box["r"], box["b"], strict=True):
            try:
                rows.append((*box_share(None if text is None else json.loads(text), tuple(corners)), ""))
            except (ValueError, TypeError) as fault:
                rows.append((None, None, f"{type(fault).__name__}: {fault}"))
        out = pd.DataFrame(rows, columns=["share", "parts", "error"])
        yield out.astype({"share": "float64", "parts": "Int32"})
