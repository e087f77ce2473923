"""Labels taken from file names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.operators.scale import checked_broadcast


def file_name(path: str):
    return F.element_at(F.split(F.col(path), "/"), -1)


def label_from_path(
    df: DataFrame,
    label_map: dict[str, str] | None,
    default: str = "unknown",
    path: str = "source_file",
    out: str = "label",
) -> DataFrame:
    """First entry of ``label_map`` whose key occurs in the file name, any case."""
    name = F.lower(file_name(path))
    result = None
    for part, label in (label_map or {}).items():
        hit = name.contains(part.lower())
        result = F.when(hit, label) if result is None else result.when(hit, label)
    return df.withColumn(
        out, F.lit(default) if result is None else result.otherwise(F.lit(default))
    )


def label_from_table(
    df: DataFrame,
    mapping: DataFrame,
    default: str = "unknown",
    path: str = "source_file",
    out: str = "label",
) -> DataFrame:
    """The same with the map as a table ``(ordinal, pattern, label)``.

    Only the distinct file names meet the map, so the substring comparison
    grows with the number of files and not with the rows; the matched names
    then join back on equality.
    """
    names = df.select(path).distinct()
    hits = (
        names.join(mapping, F.lower(file_name(path)).contains(F.lower("pattern")), "inner")
        .groupBy(path)
        .agg(F.min_by("label", "ordinal").alias(out))
    )
    return df.join(checked_broadcast(hits), path, "left").withColumn(out, F.coalesce(out, F.lit(default)))
