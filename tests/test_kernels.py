"""Rasters, cases and gates against plain versions; every case passes its gates, every gate has an image that fails it."""

import math

import numpy as np
import pytest

from marlspark.kernels import cases, codec, gates
from marlspark.kernels import raster as R


def frame():
    """A frame with a bright square, as the cases' own check has it."""
    image = np.empty((96, 96, 3), np.uint8)
    image[:] = (80, 100, 120)
    ring = image[12:85, 12:85]
    ring[:4], ring[-4:], ring[:, :4], ring[:, -4:] = 230, 230, 230, 230
    image[40:56, 40:56] = 250
    return image


@pytest.mark.parametrize("name", [*cases.CT_CASES, *cases.RGB_CASES])
def test_every_case_passes_its_gates_in_sixteen_seeds(name):
    modality = "CT" if name.startswith("ct_") else "RGB"
    k = [*cases.CT_CASES, *cases.RGB_CASES].index(name)
    for retry in range(16):
        try:
            job = cases.apply_case(frame(), modality, name, 1000 + 100 * k + retry)
            break
        except ValueError as fault:
            last = fault
    else:
        raise AssertionError(last)
    again = cases.apply_case(frame(), modality, name, 1000 + 100 * k + retry)
    assert job.records and (job.image == again.image).all() and job.records == again.records and job.image.dtype == np.uint8
    assert [r["order"] for r in job.records] == list(range(1, len(job.records) + 1)) and 0.62 <= job.records[0]["severity"] <= 1


def test_cases_with_masks():
    image = np.empty((96, 128, 3), np.uint8)
    image[:] = (90, 120, 160)
    mask, defect = np.zeros((96, 128), np.uint8), np.zeros((96, 128), np.uint8)
    mask[8:89, 36:93], defect[38:59, 55:71] = 255, 255
    for k, (name, kind) in enumerate({"rgb_surface_dust": "lens_dust_shadow", "rgb_hair_contamination": "lens_fiber_shadow", "rgb_reflection_glare": "surface_aware_specular_reflection", "rgb_underexposure": "linear_exposure_reduction"}.items()):
        made = []
        for seed in range(6000 + k, 6400 + k, 16):
            try:
                made.append(cases.apply_case(image, "RGB", name, seed, mask, defect))
            except ValueError:
                continue
        assert made and all(kind in {r["type"] for r in job.records} for job in made)


def test_trigger_crop_keeps_the_aspect_and_moves_polygons():
    image = np.empty((90, 160, 3), np.uint8)
    image[:] = (120, 140, 160)
    image[::3] = 90
    mask = np.zeros((90, 160), np.uint8)
    mask[10:81, 55:106] = 255
    for options in ({}, {"conveyor_axis": "vertical"}, {"forward_direction": "negative"}):
        job = cases.apply_case(image, "RGB", "rgb_trigger_timing_failure", 20260729, mask, options=options)
        assert abs(job.size[0] / job.size[1] - 160 / 90) < 0.02 and 0.5 <= (job.mask > 0).sum() / (mask > 0).sum() <= 0.9
        box = job.records[0]["parameters"]["crop_box"]
        assert job.matrix.point(box[0], box[1]) == (0, 0)
    with pytest.raises(ValueError, match="conveyor_axis"):
        cases.apply_case(image, "RGB", "rgb_trigger_timing_failure", 1, mask, options={"conveyor_axis": "up"})
    with pytest.raises(ValueError, match="not valid for CT"):
        cases.apply_case(image, "CT", "rgb_surface_dust", 1)


def test_group_seed_sets_the_direction_of_a_scan():
    sides = set()
    for seed in range(1000, 1040):
        try:
            sides.add(cases.apply_case(frame(), "CT", "ct_acquisition_motion", seed, group_seed=5).records[0]["parameters"]["angle_deg"])
        except ValueError:
            continue
    assert len(sides) == 1


def test_draws_are_those_of_one_stream():
    a, b = cases.Draws(9), np.random.Generator(np.random.PCG64(9))
    assert (a.random(), a.uniform(1, 3), a.randint(2, 4), a.randrange(5, 18, 2), a.choice("abc")) == (b.random(), b.uniform(1, 3), int(b.integers(2, 5)), range(5, 18, 2)[int(b.integers(0, 7))], "abc"[int(b.integers(0, 3))])
    with pytest.raises(ValueError):
        a.randrange(3, 3)


def flat(value, shape=(40, 60)):
    return np.full((*shape, 3), value, np.uint8)


def textured(low=60, high=140, shape=(40, 60)):
    rng = np.random.default_rng(0)
    return np.repeat(rng.integers(low, high, shape).astype(np.uint8)[..., None], 3, 2)


def record(kind, **parameters):
    return {"order": 1, "type": kind, "severity": 1.0, "parameters": parameters}


GLARE = {"outline_overlap_ratio": 0.95, "core_object_area_ratio": 0.05, "defect_coverage_ratio": 0.5, "defect_present": True, "object_saturation_ratio": 0.0}
RAYS = {"dense_intersection_pixels": 5, "quadrant_counts": [5, 5, 5, 5], "max_angular_gap_deg": 20}
CURVE = {"thickness_px": 1, "length_px": 20}
FULL, HALF = np.full((40, 60), 255, np.uint8), np.repeat(np.array([[255] * 30 + [0] * 30], np.uint8), 40, 0)


@pytest.mark.parametrize(
    ("text", "image", "records", "original", "masks", "modality"),
    [
        ("empty image", np.zeros((0, 5, 3), np.uint8), [record("x")], None, (None, None), "RGB"),
        ("near-constant", flat(9), [record("x")], None, (None, None), "RGB"),
        ("no augmentation records", textured(), [], None, (None, None), "RGB"),
        ("occlusion_box", textured(), [record("occlusion_box")], None, (None, None), "CT"),
        ("near black", np.where(np.arange(60)[None, :, None] == 0, 90, 0).astype(np.uint8) + flat(0), [record("x")], None, (None, None), "RGB"),
        ("are saturated", np.where(np.arange(60)[None, :, None] == 0, 90, 255).astype(np.uint8) + flat(0), [record("x")], None, (None, None), "RGB"),
        ("underexposure is not strong enough", textured(), [record("signal_to_transmission")], textured(), (None, None), "CT"),
        ("outline luminance reduction", textured(10, 30), [record("linear_exposure_reduction")], textured(100, 200), (None, None), "RGB"),
        ("spatial lighting order", textured(30, 90)[::-1], [record("linear_exposure_reduction")], textured(60, 180), (None, None), "RGB"),
        ("did not increase", textured(), [record("overexposure")], textured(80, 160), (None, None), "RGB"),
        ("object saturation", textured(80, 160), [record("overexposure")], textured(), (FULL, FULL), "RGB"),
        ("edge-energy", textured(), [record("defocus_blur")], textured(), (None, None), "RGB"),
        ("contrast is too small", textured(), [record("lighting_gradient", angle_deg=0.0)], textured(), (None, None), "RGB"),
        ("shadow count", textured(), [record("lens_dust_shadow", shadow_count=5, frame_affected_ratio=0.1)], textured(), (None, None), "RGB"),
        ("frame coverage", textured(), [record("lens_dust_shadow", shadow_count=1, frame_affected_ratio=0.5)], textured(), (None, None), "RGB"),
        ("overlap is below", textured(), [record("surface_aware_specular_reflection", **GLARE | {"outline_overlap_ratio": 0.8})], textured(), (None, None), "RGB"),
        ("core area", textured(), [record("surface_aware_specular_reflection", **GLARE | {"core_object_area_ratio": 0.2})], textured(), (None, None), "RGB"),
        ("more than 70%", textured(), [record("surface_aware_specular_reflection", **GLARE | {"defect_coverage_ratio": 0.8})], textured(), (None, None), "RGB"),
        ("less than 30%", textured(), [record("surface_aware_specular_reflection", **GLARE | {"defect_coverage_ratio": 0.2})], textured(), (None, None), "RGB"),
        ("saturates more", textured(), [record("surface_aware_specular_reflection", **GLARE | {"object_saturation_ratio": 0.2})], textured(), (None, None), "RGB"),
        ("does not cross dense", textured(), [record("metal_anchored_streaks", **RAYS | {"dense_intersection_pixels": 0})], textured(), (None, None), "CT"),
        ("all four quadrants", textured(), [record("metal_anchored_streaks", **RAYS | {"quadrant_counts": [9, 9, 9, 3]})], textured(), (None, None), "CT"),
        ("exceeds 35", textured(), [record("metal_anchored_streaks", **RAYS | {"max_angular_gap_deg": 40})], textured(), (None, None), "CT"),
        ("curve count", textured(), [record("lens_fiber_shadow", curves=[])], textured(), (None, None), "RGB"),
        ("hair thickness", textured(), [record("lens_fiber_shadow", curves=[CURVE | {"thickness_px": 3}])], textured(), (None, None), "RGB"),
        ("hair length", textured(), [record("lens_fiber_shadow", curves=[CURVE | {"length_px": 50}])], textured(), (None, None), "RGB"),
        ("below 0.10", textured(), [record("porosity_targeted_fov_crop")], textured(), (FULL, FULL * 0), "CT"),
        ("above 0.95", textured(), [record("porosity_targeted_fov_crop")], textured(), (FULL, FULL), "CT"),
        ("above 0.90", textured(), [record("timing_edge_crop")], textured(), (FULL, FULL), "RGB"),
    ],
)
def test_every_gate_has_an_image_that_fails_it(text, image, records, original, masks, modality):
    with pytest.raises(ValueError, match=text):
        gates.check_sample(image, modality, records, original, *masks)


def test_gates_let_good_ones_pass():
    for records in ([record("surface_aware_specular_reflection", **GLARE)], [record("metal_anchored_streaks", **RAYS)], [record("lens_fiber_shadow", curves=[CURVE])], [record("lens_dust_shadow", shadow_count=4, frame_affected_ratio=0.3)]):
        gates.check_sample(textured(), "RGB", records, textured())
    gates.check_sample(textured(), "RGB", [record("timing_edge_crop")], textured(), FULL, np.where(np.arange(60) < 40, FULL, 0).astype(np.uint8))
    with pytest.raises(ValueError, match="below 0.50"):
        gates.check_sample(textured(), "RGB", [record("timing_edge_crop")], textured(), FULL, np.where(np.arange(60) < 20, FULL, 0).astype(np.uint8))
    assert HALF.shape == FULL.shape


def test_largest_component_against_flood_fill():
    rng = np.random.default_rng(3)
    for k in range(40):
        mask = rng.random((17, 23)) < (0.2, 0.4, 0.6)[k % 3]
        seen, best = np.zeros(mask.shape, bool), []
        for y, x in zip(*np.nonzero(mask), strict=True):
            if seen[y, x]:
                continue
            part, stack = [], [(y, x)]
            seen[y, x] = True
            while stack:
                i, j = stack.pop()
                part.append((i, j))
                for a in range(max(i - 1, 0), min(i + 2, 17)):
                    for b in range(max(j - 1, 0), min(j + 2, 23)):
                        if mask[a, b] and not seen[a, b]:
                            seen[a, b] = True
                            stack.append((a, b))
            if len(part) > len(best):
                best = part
        want = np.zeros(mask.shape, bool)
        for i, j in best:
            want[i, j] = True
        assert (R.largest_component(mask) == want).all()


def test_raster_operators_against_plain_loops():
    rng = np.random.default_rng(5)
    image = rng.integers(0, 256, (9, 13, 3)).astype(np.uint8)
    assert R.grey(image)[2, 3] == (int(image[2, 3, 0]) * 19595 + int(image[2, 3, 1]) * 38470 + int(image[2, 3, 2]) * 7471 + 32768) >> 16
    moved = R.translate(image, 4, -2, (1, 2, 3))
    for y in range(9):
        for x in range(13):
            inside = 0 <= x - 4 < 13 and 0 <= y + 2 < 9
            assert moved[y, x].tolist() == (image[y + 2, x - 4].tolist() if inside else [1, 2, 3])
    assert (R.translate(image, 99, 0, 0) == 0).all()
    blur = R.motion_blur(R.grey(image), 5, 0)
    row = np.pad(R.grey(image)[4].astype(float), 2, mode="edge")
    assert blur[4].tolist() == [int(np.float32(row[k : k + 5].sum()) / np.float32(5)) for k in range(13)]
    assert (R.resize(image, 13, 9) == image).all() and R.resize(flat(77), 7, 5).min() == R.resize(flat(77), 7, 5).max() == 77
    light = R.resize(np.linspace(0, 255, 64).astype(np.uint8)[None].repeat(8, 0), 32, 8)
    assert np.abs(light[0].astype(int) - (np.linspace(0, 255, 64)[::2] + 2)).max() <= 4
    spot = np.zeros((61, 61), np.uint8)
    spot[30, 30] = 255
    wide = R.gaussian(spot, 3)
    y, x = np.mgrid[:61, :61] - 30
    assert np.abs(wide - 255 * np.exp(-(x * x + y * y) / 18) / (18 * math.pi)).max() < 2 and (R.gaussian(flat(9), 4) == 9).all()
    assert np.allclose(R.from_linear(R.to_linear(image)).astype(int), image, atol=1)
    assert R.background(np.tile(np.arange(50, 63, dtype=np.uint8), (9, 1)), "CT") == 50
    assert (R.rotate(R.grey(image), 0) == R.grey(image)).all()
    half = R.rotate(np.pad(np.full((3, 3), 200, np.uint8), 8), 180)
    assert half[8:11, 8:11].min() >= 199
    assert R.contrast(flat(100), 0.5).max() == 100 and R.brightness(flat(100), 0.5).max() == 50
    layer = np.zeros((40, 60, 4), np.uint8)
    layer[..., :3], layer[10, 10, 3], layer[20, 20, 3] = 250, 255, 128
    top = R.over(flat(50), layer)
    assert top[10, 10, 0] == 250 and top[0, 0, 0] == 50 and abs(int(top[20, 20, 0]) - 150) <= 1
    mask = np.zeros((30, 30), np.uint8)
    R.fill_polygon(mask, [(5, 5), (20, 5), (20, 15), (5, 15)], 255)
    assert R.bbox(mask) == (5, 5, 21, 16) and (mask[5:16, 5:21] == 255).all() and len(R.mask_points(mask)) == 11 * 16
    assert R.gamma(flat(64), 0.5)[0, 0, 0] == 128 and R.noise(flat(100), np.random.default_rng(1), 5, True).std() > 3
    assert R.signed_lines(flat(100), cases.Draws(3), 5, (1, 3), (10, 40)).std() > 0 and cases.max_gap([10, 350, 180]) == 170


def test_png_round_trip_and_digest(spark, tmp_path):
    from marlspark.sources import tree

    rng = np.random.default_rng(6)
    image = rng.integers(0, 256, (21, 34, 3)).astype(np.uint8)
    smooth = np.repeat(np.linspace(0, 250, 34).astype(np.uint8)[None], 21, 0)
    (tmp_path / "a.png").write_bytes(codec.png_bytes(image))
    (tmp_path / "g.png").write_bytes(codec.png_bytes(R.grey(image)))
    (tmp_path / "s.jpg").write_bytes(codec.jpeg_bytes(smooth, 95))
    (tmp_path / "n.jpg").write_bytes(codec.jpeg_bytes(image, 90))
    got = {r["path"].rsplit("/", 1)[1]: r for r in tree.pixels(spark, str(tmp_path)).collect()}
    read = lambda name, modality: codec.normalised(got[name]["data"], got[name]["width"], got[name]["height"], got[name]["channels"], modality)
    assert (read("a.png", "RGB") == image).all() and (read("g.png", "CT") == R.grey(image)).all() and read("g.png", "RGB").shape == (21, 34, 3)
    assert np.abs(read("s.jpg", "CT").astype(int) - smooth).max() <= 3 and np.abs(read("n.jpg", "RGB").astype(int) - image).mean() < 25
    assert codec.pixel_digest(read("a.png", "CT")) == codec.pixel_digest(image) != codec.pixel_digest(R.grey(image))
