"""The raw tree: files of images and labels, found by folder and name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlspark.functions import names as N


def plain_path(path: Column) -> Column:
    """Paths of the local file system come with one slash or three; they are compared as plain ones."""
    return F.regexp_replace(path, "^file:/+", "/")


def listing(spark: SparkSession, root: str) -> DataFrame:
    """Path, relative path, size and modification time (in milliseconds) of every file below root; no content is read.

    Files and folders whose names begin with a dot or an underscore are not seen.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    path = plain_path(F.col("path"))
    base = plain_path(F.lit(str(root)))
    sized = files.select(path.alias("path"), N.contained(path, base).alias("relative"), F.col("length").cast("string").alias("size"), F.unix_millis("modificationTime").cast("string").alias("mtime"))
    return sized.where("relative IS NOT NULL")


def indexed(files: DataFrame) -> DataFrame:
    """The files that belong to the data set, with split, modality, folded (the stem in lower case) and side."""
    parsed = files.withColumns({"stem": N.stem_of(F.col("relative")), "split": N.split_of(F.col("relative")), "kind": N.kind_of(F.col("relative")), "suffix": N.suffix(F.col("relative"))})
    parsed = parsed.withColumn("parsed", N.parse_stem(F.col("stem"))).withColumn("modality", F.col("parsed.modality"))
    image = F.col("suffix").isin(*N.IMAGE_SUFFIXES) & ~F.col("kind").eqNullSafe(F.lit("json"))
    label = (F.col("suffix") == "json") & ~F.col("kind").eqNullSafe(F.lit("image"))
    side = F.when(image, "image").when(label, "json")
    return parsed.withColumns({"folded": F.lower("stem"), "side": side}).where("split IS NOT NULL AND modality IS NOT NULL AND side IS NOT NULL")


def paired(files: DataFrame) -> DataFrame:
    """One row for each key, with the files of either side as arrays, and status: pair, ambiguous, image_only or json_only."""
    file = F.struct("relative", "path", "stem", "size", "mtime")
    sides = files.groupBy("split", "modality", "folded").agg(
        F.array_sort(F.collect_list(F.when(F.col("side") == "image", file))).alias("images"),
        F.array_sort(F.collect_list(F.when(F.col("side") == "json", file))).alias("jsons"),
    )
    n, m = F.size("images"), F.size("jsons")
    status = F.when((n > 1) | (m > 1), "ambiguous").when(m == 0, "image_only").when(n == 0, "json_only").otherwise("pair")
    first = F.coalesce(F.get("images", F.lit(0)), F.get("jsons", F.lit(0)))
    return sides.withColumns({"status": status, "stem": first["stem"]}).withColumn("parsed", N.parse_stem(F.col("stem")))


def _below(paths: DataFrame, column: str) -> list[str]:
    """Paths as a list; for selections whose size the configuration bounds."""
    return [r[0] for r in paths.select(column).distinct().toLocalIterator()]


def contents(spark: SparkSession, where: str | list[str]) -> DataFrame:
    """path, content and sha256 of files: all below a root, or those of a list."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(where)
    return files.select(plain_path(F.col("path")).alias("path"), "content", F.sha2("content", 256).alias("sha256"))  # F2


def pixels(spark: SparkSession, where: str | list[str]) -> DataFrame:
    """path, height, width, channels and data (blue first) of images; height is -1 where a file is none.

    Decoding is that of the JVM, so pixels of lossy files can differ by a step from those of other decoders.
    """
    images = spark.read.format("image").option("recursiveFileLookup", "true").load(where).select("image.*")
    return images.select(plain_path(F.col("origin")).alias("path"), "height", "width", F.col("nChannels").alias("channels"), "data")
