"""Names for files that are collated into one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.functions.paths import basename, extension, numbered_name, stem
from papyrine.operators.ordering import number_rows, rank_in_groups
from papyrine.sources.tables import materialize

NUMBERED_STEM = r"(?s)\A(\.*[^.].*)_([1-9][0-9]{0,17})\z"  # longer numbers fit no bigint, and no file gets one


def collision_safe_names(files: DataFrame, path: str = "path", name: str = "name") -> DataFrame:
    """Add a file name that no other row has; rows without a path have none.

    The first path of each base name keeps it. The others are numbered `stem_1.ext`, `stem_2.ext`, ... in path order,
    passing over numbers that some file already bears as its own name. Numbered names of different base names never meet:
    a name can be read back into its stem and number in one way only. So all that can be taken are the base names in the
    input, and the n-th copy gets the n-th number free of them.

    The number is found by ranking. Give the n-th copy the value n, and the i-th taken number t the value t - i, which is
    how many free numbers lie below it. Sorted by value, copies first, a copy's rank is its number.
    """
    pathless = files.filter(F.col(path).isNull()).withColumn(name, F.lit(None).cast("string"))
    files = files.filter(F.col(path).isNotNull())
    ranked = rank_in_groups(files.withColumn("_base", basename(F.col(path))), "_base", [path], "_copy")
    ranked = materialize(ranked, "ranked")  # read several times below
    heads = ranked.filter("_copy = 1").select("_base")
    parts = heads.select(
        F.regexp_extract(stem(F.col("_base")), NUMBERED_STEM, 1).alias("_stem"),
        F.regexp_extract(stem(F.col("_base")), NUMBERED_STEM, 2).alias("_number"),
        extension(F.col("_base")).alias("_ext"),
    ).filter("_number <> ''")
    taken = parts.select(F.concat("_stem", "_ext").alias("_base"), F.col("_number").cast("long").alias("_number"))

    # Base names with both copies and taken numbers; one row each.
    copied = ranked.filter("_copy = 2").select("_base")
    contested = materialize(taken.select("_base").distinct().join(copied, "_base", "left_semi"), "contested")
    columns = files.columns
    taken = rank_in_groups(taken.join(contested, "_base", "left_semi"), "_base", ["_number"], "_place_taken")
    copies = ranked.filter("_copy > 1").withColumn("_value", F.col("_copy") - 1)
    plain = copies.join(contested, "_base", "left_anti").withColumn("_number", F.col("_value"))
    merged = (
        copies.join(contested, "_base", "left_semi")
        .withColumn("_kind", F.lit(0))
        .unionByName(
            taken.select("_base", (F.col("_number") - F.col("_place_taken")).alias("_value"), F.lit(1).alias("_kind")),
            allowMissingColumns=True,
        )
    )
    shifted = rank_in_groups(merged, "_base", ["_value", "_kind"], "_number").filter("_kind = 0")
    return (
        ranked.filter("_copy = 1")
        .select(*columns, F.col("_base").alias(name))
        .unionByName(plain.select(*columns, numbered_name(F.col("_base"), F.col("_number")).alias(name)))
        .unionByName(shifted.select(*columns, numbered_name(F.col("_base"), F.col("_number")).alias(name)))
        .unionByName(pathless)
    )


def cap_candidates(files: DataFrame, max_files: int | None, path: str = "path") -> DataFrame:
    """The first `max_files` files by path, before any check of their content; all of them for None or 0."""
    if not max_files:
        return files
    return number_rows(files, [path], "_index").filter(F.col("_index") < max_files).drop("_index")
