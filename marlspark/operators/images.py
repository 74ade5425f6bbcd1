"""Operators over tables of images: pixels as bytes with height, width and channels, a kernel for each row in Arrow batches."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marlspark.functions.seeds import stable_seed
from marlspark.kernels import cases, gates
from marlspark.kernels import raster as R
from marlspark.kernels.shapes import Matrix, box_share, moved_rings, rewritten

IMAGE = ["height", "width", "channels", "data"]


def pixels_of(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    a = np.frombuffer(data, np.uint8)
    return a.reshape(height, width) if channels == 1 else a.reshape(height, width, channels)


def each(df: DataFrame, keep: list[str], read: list[str], schema: str, kernel: Callable[..., dict[str, Any]]) -> DataFrame:
    """The columns of keep and what the kernel gives for the columns of read, with an error column where it raises."""
    types = ", ".join(f"`{c}` {t}" for c, t in df.select(*keep).dtypes)
    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    kinds = {"string": pa.string(), "double": pa.float64(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    told = [kinds[part.strip().split(" ")[1]] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for values in zip(*(c.to_pylist() for c in batch.columns[len(keep) :]), strict=True):
                try:
                    rows.append({**kernel(*values), "error": ""})
                except Exception as fault:
                    rows.append({"error": f"{type(fault).__name__}: {fault}"})
            made = [pa.array([r.get(n) for r in rows], t) for n, t in zip(names, told, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made, pa.array([r["error"] for r in rows], pa.string())], names=[*keep, *names, "error"])

    return df.select(*keep, *[df[c].alias(f"_{k}_{c}") for k, c in enumerate(read)]).mapInArrow(run, f"{types}, {schema}, error string")


def measured(df: DataFrame, keep: list[str]) -> DataFrame:
    """M9 to M18 in numbers: what each raster operator makes of the image of a row."""

    def kernel(h, w, c, data):
        image = pixels_of(h, w, c, data)
        light = R.grey(image)
        moved = R.translate(light, 2, 1, 7)
        return {
            "background": int(R.background(image, "RGB")[0]), "air": int(R.background(light, "CT")), "moved": int(moved.sum()), "gamma": int(R.gamma(light, 0.5).sum()),
            "dimmed": int(R.brightness(light, 0.5).sum()), "linear": int((R.to_linear(light) >= 0.2).sum()), "added": int(R.add_field(light, np.full(light.shape, 30.0, np.float32)).sum()),
            "bright": int((light >= 128).sum()), "first": int(R.mask_points(light >= 128)[:1].sum()), "blurred": int(R.motion_blur(light, 3, 0)[0].sum()),
        }

    return each(df, keep, IMAGE, "background long, air long, moved long, gamma long, dimmed long, linear long, added long, bright long, first long, blurred long", kernel)


def gated(df: DataFrame, keep: list[str], records: str = "records") -> DataFrame:
    """G1 to G20: '' or the text of the first gate that does not hold, for an image with records in JSON and no original; parameter gates included."""

    def kernel(h, w, c, data, told):
        image, records_ = pixels_of(h, w, c, data), json.loads(told)
        gates.check_sample(image, "RGB", records_, original=image)
        return {"passed": True}

    return each(df, keep, [*IMAGE, records], "passed boolean", kernel)


def synthesised(df: DataFrame, keep: list[str], modality: str, case: str, seed: int) -> DataFrame:
    """The case in column case applied to the image, with a seed of the row's first kept column; types of the records, and the pixels."""

    def kernel(key, h, w, c, data, name):
        image = pixels_of(h, w, c, data)
        fault = None
        for retry in range(8):  # M7
            try:
                job = cases.apply_case(image, modality, name, stable_seed(seed, key, "retry", retry))
            except ValueError as caught:
                fault = caught
                continue
            return {"types": "|".join(r["type"] for r in job.records), "records": json.dumps(job.records, ensure_ascii=False, default=float), "made": job.image.tobytes()}
        raise ValueError(f"augmentation retries exhausted: {fault}")

    return each(df, keep, [keep[0], *IMAGE, case], "types string, records string, made binary", kernel)


def ring_shares(df: DataFrame, keep: list[str], points: str, box: str) -> DataFrame:
    """Share and parts of points in JSON within a box in JSON."""
    kernel = lambda p, b: dict(zip(("share", "parts"), box_share(None if p is None else json.loads(p), tuple(map(float, json.loads(b)))), strict=True))
    return each(df, keep, [points, box], "share double, parts long", kernel)


def transformed_rings(df: DataFrame, keep: list[str], points: str, matrix: str, size: tuple[int, int]) -> DataFrame:
    """number, and area of the largest, of the polygons of points under a matrix [a, b, d, e, x, y] in a frame."""
    from marlspark.kernels.shapes import ring_area

    def kernel(p, m):
        rings = moved_rings(json.loads(p), Matrix(*map(float, json.loads(m))), (0.0, 0.0, float(size[0]), float(size[1])))
        return {"rings": len(rings), "area": round(ring_area(rings[0]), 6) if rings else 0.0}

    return each(df, keep, [points, matrix], "rings long, area double", kernel)


def rewritten_labels(df: DataFrame, keep: list[str], label: str, matrix: str, size: tuple[int, int], modality: str, quality: str, battery: str, image: str, name: str) -> DataFrame:
    """Labels in JSON rewritten for the image that the matrix makes, in canonical form."""

    def kernel(text, m, q, b, i, n):
        made = rewritten(json.loads(text), Matrix(*map(float, json.loads(m))), size, modality, q, int(b), int(i), n)
        return {"label": json.dumps(made, ensure_ascii=False, sort_keys=True, separators=(",", ":"))}

    return each(df, keep, [label, matrix, quality, battery, image, name], "label string", kernel)
