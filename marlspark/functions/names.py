"""Stems, paths and fixed texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of stems of the two modalities, image suffixes, and folder names of images and labels.
CT_STEM = r"^CT_cell_(.+)_(\d+)_([^_]+)_(\d+)$"
RGB_STEM = r"^RGB_cell_(.+)_(\d+)_(\d+)$"
IMAGE_SUFFIXES = ("png", "jpg", "jpeg", "tif", "tiff", "bmp", "webp")
IMAGE_FOLDERS = ("01.원천데이터", "원천데이터")
LABEL_FOLDERS = ("02.라벨링데이터", "라벨링데이터")
#: Digits of any script count, as in the stems' own definition; a line break never belongs to a stem.
_UNICODE = "(?U)"


def parse_stem(stem: Column) -> Column:
    """STRUCT of modality, form, battery_id, axis and image_id; all null where neither pattern matches (or for null).

    The form is as long as it can be; an RGB stem has no axis (null).
    """
    ct, rgb = stem.rlike(_UNICODE + CT_STEM), stem.rlike(_UNICODE + RGB_STEM)
    part = lambda c, r: F.when(ct, F.regexp_extract(stem, _UNICODE + CT_STEM, c)).when(rgb, F.regexp_extract(stem, _UNICODE + RGB_STEM, r) if r else F.lit(None))
    return F.struct(F.when(ct, "CT").when(rgb, "RGB").alias("modality"), part(1, 1).alias("form"), part(2, 2).alias("battery_id"), part(3, 0).alias("axis"), part(4, 3).alias("image_id"))


def new_stem(parsed: Column, battery_id: Column, image_id: Column) -> Column:
    """The stem of a parsed name with issued ids; null where it did not parse."""
    told = F.concat_ws("_", parsed["modality"], F.lit("cell"), parsed["form"], battery_id.cast("string"), parsed["axis"], image_id.cast("string"))
    return F.when(parsed["modality"].isNotNull(), told)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem_of(path: Column) -> Column:
    """The name of a file without its last suffix; a name that only begins with a dot has none."""
    name = file_name(path)
    return F.when(name.rlike(r"^.+\.[^.]+$"), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(name)


def suffix(path: Column) -> Column:
    """P5: the last suffix in lower case, '' for none."""
    return F.lower(F.regexp_extract(file_name(path), r"^.+\.([^.]+)$", 1))


def is_image(path: Column) -> Column:
    return suffix(path).isin(*IMAGE_SUFFIXES)


def split_of(path: Column) -> Column:
    """The first component of a path that is training or validation, whatever its case; null without one."""
    return F.get(F.filter(F.split(F.lower(path), "/"), lambda p: p.isin("training", "validation")), F.lit(0))


def kind_of(path: Column) -> Column:
    """Image or json by the folders that a path lies in, null for neither; an image folder wins over a label folder."""
    parts = F.split(F.lower(path), "/")
    has = lambda names: F.arrays_overlap(parts, F.array(*map(F.lit, names)))
    return F.when(has(IMAGE_FOLDERS), "image").when(has(LABEL_FOLDERS), "json")


def contained(path: Column, root: Column) -> Column:
    """The path relative to the root; null for a path that is not below it or climbs out of a folder."""
    base = F.concat(F.regexp_replace(root, r"/+$", ""), F.lit("/"))
    rest = F.substring(path, F.length(base) + 1, F.length(path))
    climbs = F.exists(F.split(rest, "/"), lambda p: p.isin("..", ""))
    return F.when(path.startswith(base) & ~climbs, rest)


def reason_prefix(reason: Column) -> Column:
    """F8: what stands before the first colon."""
    return F.substring_index(reason, ":", 1)
