"""JSON inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from cardlens.schemas import DATASETS, RAW_SCHEMAS


def read_dataset(
    spark: SparkSession,
    dataset: str,
    path: str | list[str],
    schema: T.StructType | None = None,
    infer: bool = False,
    multi_line: bool = False,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """A raw dataset from JSON lines, or from files that hold JSON arrays.

    A declared schema saves the extra pass that inference makes over the input. Loan applications have
    none, so that no column is lost, and are inferred unless ``schema`` is given; ``infer=True`` does
    the same for the others. ``multi_line`` is for pretty-printed documents; such a file cannot be
    split, so a large dataset should come as many files or as lines.
    """
    if dataset not in DATASETS:
        raise ValueError(f"unknown dataset {dataset!r}; known: {', '.join(DATASETS)}")
    if schema is None and not infer:
        schema = RAW_SCHEMAS.get(dataset)
    reader = spark.read.option("multiLine", multi_line).option("mode", mode)
    return (reader if schema is None else reader.schema(schema)).json(path)
