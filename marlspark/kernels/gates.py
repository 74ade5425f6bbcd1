"""Quality gates of a changed image: each is a rule over its pixels, its records and the image it was made from.

G1 to G7 hold for every sample; the others for the records they name, and only where the original is given. The first
rule that fails raises, in the order of the list, with the text that the error tables carry.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import Any

import numpy as np

from marlspark.kernels import raster as R


class Sample:
    """What the rules look at. light and base: luminance of the image and of the original at the image's size."""

    def __init__(self, image, modality, records, original, original_mask, mask):
        self.image, self.modality, self.records = image, modality, records
        self.original_mask, self.mask = original_mask, mask
        self.kinds = {r["type"] for r in records}
        self.light = R.grey(image).astype(np.float32)
        h, w = image.shape[:2]
        self.base = None if original is None else R.resize(R.grey(original), w, h).astype(np.float32)

    def parameters(self, kind: str) -> dict[str, Any]:
        return next(r["parameters"] for r in self.records if r["type"] == kind)

    def region(self) -> np.ndarray:
        return self.mask > 0 if self.mask is not None else np.ones(self.light.shape, bool)


def _fail(text: str) -> None:
    raise ValueError(text)


def _gate(text: str) -> None:
    _fail(f"quality_gate: {text}")


def edge_energy(light: np.ndarray) -> float:
    return float(sum(np.abs(np.diff(light, axis=k)).mean() for k in (1, 0)))


def _dimmed(s: Sample) -> None:
    """G8."""
    if float(s.light.mean()) > max(float(s.base.mean()), 1.0) * 0.72:
        _gate("underexposure is not strong enough")


def _exposure(s: Sample) -> None:
    """G9, G10."""
    region = s.region()
    now, before = s.light[region], s.base[region]
    if not 0.40 <= float(now.mean()) / max(float(before.mean()), 1.0) <= 0.70:
        _gate("underexposure outline luminance reduction is outside 30%..60%")
    if float(before.std()) >= 1.0:
        like = float(np.corrcoef(before.ravel(), now.ravel())[0, 1])
        if not like >= 0.95:  # also where it is not a number
            _gate("underexposure changed the spatial lighting order")


def _over(s: Sample) -> None:
    """G11, G12."""
    if float(s.light.mean()) <= max(float(s.base.mean()), 1.0):
        _gate("overexposure did not increase luminance")
    if s.mask is not None and not 0.15 <= float((s.light[s.mask > 0] >= 250).mean()) <= 0.75:
        _gate("overexposure object saturation is outside 15%..75%")


def _edges(s: Sample) -> None:
    """G13."""
    ratio = edge_energy(s.light) / max(edge_energy(s.base), 1e-6)
    low, high = (0.25, 0.75) if "defocus_blur" in s.kinds else (0.0, 0.85)
    if not low <= ratio <= high:
        _gate("required edge-energy reduction was not reached")


def tails(values: np.ndarray, axis: np.ndarray) -> float:
    """How far the means of the two outer fifths along the axis lie apart, in means of all."""
    low, high = (values[axis <= float(np.quantile(axis, 0.20))], values[axis >= float(np.quantile(axis, 0.80))])
    return abs(float(high.mean()) - float(low.mean())) / max(float(values.mean()), 1.0)


def _lighting(s: Sample) -> None:
    """G14."""
    turn = math.radians(float(s.parameters("lighting_gradient").get("angle_deg", 0.0)))
    y, x = np.mgrid[0 : s.light.shape[0], 0 : s.light.shape[1]]
    region = s.mask > 0 if s.mask is not None and (s.mask > 0).any() else np.ones(s.light.shape, bool)
    axis = (x * math.cos(turn) + y * math.sin(turn))[region]
    now = tails(s.light[region], axis)
    if not 0.25 <= now <= 0.60:
        _gate("uneven lighting contrast is too small")
    if now - tails(s.base[region], axis) < 0.15:
        _gate("uneven lighting did not add enough asymmetry")


def _dust(s: Sample) -> None:
    """G15."""
    told = s.parameters("lens_dust_shadow")
    if not 1 <= int(told.get("shadow_count", 0)) <= 4:
        _gate("lens dust shadow count is outside 1..4")
    if not 0.001 <= float(told.get("frame_affected_ratio", 0)) <= 0.35:
        _gate("lens dust frame coverage is outside range")


def _glare(s: Sample) -> None:
    """G16."""
    told = s.records[0]["parameters"]
    value = lambda k: float(told.get(k, 0))
    if value("outline_overlap_ratio") < 0.90:
        _gate("glare outline overlap is below 90%")
    if not 0.01 <= value("core_object_area_ratio") <= 0.12:
        _gate("glare core area is outside 1%..12% of object")
    if value("defect_coverage_ratio") > 0.70:
        _gate("glare covers more than 70% of defect mask")
    if told.get("defect_present") and value("defect_coverage_ratio") < 0.30:
        _gate("glare covers less than 30% of defect mask")
    if value("object_saturation_ratio") > 0.12:
        _gate("glare saturates more than 12% of object")


def _rays(s: Sample) -> None:
    """G17."""
    told = s.parameters("metal_anchored_streaks")
    if int(told.get("dense_intersection_pixels", 0)) <= 0:
        _gate("photon-starvation streak does not cross dense region")
    quarters = told.get("quadrant_counts", [])
    if len(quarters) != 4 or min(map(int, quarters)) < 4:
        _gate("metal streak rays do not cover all four quadrants")
    if float(told.get("max_angular_gap_deg", 360)) > 35:
        _gate("metal streak maximum angular gap exceeds 35 degrees")


def _fibres(s: Sample) -> None:
    """G18."""
    curves, long = s.records[0]["parameters"].get("curves", []), max(s.light.shape)
    if not 1 <= len(curves) <= 2:
        _gate("hair curve count is outside 1..2")
    most = max(1, math.ceil(long * 0.006))
    if not all(1 <= int(c["thickness_px"]) <= most for c in curves):
        _gate("hair thickness is outside v1.7 range")
    if not all(0.15 * long <= float(c["length_px"]) <= 0.60 * long for c in curves):
        _gate("hair length is outside 15%..60% of long side")


# Of each crop the least and the most of the outline that stays, and what is said beyond the most.
RETAINED = {
    "porosity_targeted_fov_crop": (0.10, 0.95, "alignment failure did not remove enough required structure"),
    "timing_edge_crop": (0.50, 0.90, "the crop did not clip the battery"),
}


def _retention(s: Sample) -> None:
    """G19, G20."""
    if s.original_mask is None or s.mask is None:
        return
    kept = int((s.mask > 0).sum()) / max(int((s.original_mask > 0).sum()), 1)
    for kind, (least, most, text) in RETAINED.items():
        if kind in s.kinds:
            if kept < least:
                _gate(f"outline retention {kept:.3f} is below {least:.2f}")
            if kept > most:
                _gate(f"outline retention {kept:.3f} is above {most:.2f}; {text}")


#: Record types, and the rule that holds where one of them is there.
RULES: list[tuple[set[str], Callable[[Sample], None]]] = [
    ({"signal_to_transmission", "linear_exposure_reduction"}, _dimmed),
    ({"linear_exposure_reduction"}, _exposure),
    ({"overexposure"}, _over),
    ({"directional_motion_blur", "defocus_blur"}, _edges),
    ({"lighting_gradient"}, _lighting),
    ({"lens_dust_shadow"}, _dust),
    ({"surface_aware_specular_reflection"}, _glare),
    ({"metal_anchored_streaks"}, _rays),
    ({"lens_fiber_shadow"}, _fibres),
    (set(RETAINED), _retention),
]


def check_sample(image: np.ndarray, modality: str, records: list[dict[str, Any]], original: np.ndarray | None = None, original_mask: np.ndarray | None = None, mask: np.ndarray | None = None) -> None:
    """Raise ValueError with the text of the first rule that does not hold."""
    if not image.size:
        _fail("augmentation produced an empty image")  # G1
    if not np.isfinite(image).all():
        _fail("augmentation produced NaN/Inf pixels")  # G2
    if float(image.std()) < 0.25:
        _fail("augmentation produced a near-constant image")  # G3
    if not records:
        _fail("FAIL sample has no augmentation records")  # G4
    s = Sample(image, modality, records, original, original_mask, mask)
    if modality == "CT" and "occlusion_box" in s.kinds:
        _fail("occlusion_box is forbidden for CT")  # G5
    if float((s.light <= 5).mean()) >= 0.98:
        _gate("98% or more pixels are near black")  # G6
    if float((s.light >= 250).mean()) >= 0.98:
        _gate("98% or more pixels are saturated")  # G7
    if original is None:
        return
    for kinds, rule in RULES:
        if kinds & s.kinds:
            rule(s)
