"""Readers of delimited measurement files, predictions, class lists and metrics."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cytospark.functions.names import STATISTICS, col, cols, nan_to_null_all

# Suffix that is cut from image names, and the one cut from sample names.
IMAGE_SUFFIX = ".ome.tiff"
SAMPLE_SUFFIX = ".ome.tif"
HEADER_READERS = 32


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The frame itself, or an error if it has no row."""
    if df.isEmpty():
        raise ValueError(f"{what}: empty table")
    return df


def measure_schema(header: Sequence[str], numeric: Sequence[str] = ()) -> T.StructType:
    """Schema from the column names: measures and centroids are double, the rest text."""
    marks = [f": {s}" for s in [*STATISTICS, "Std Dev."]]
    known = set(numeric)

    def kind(name: str) -> T.DataType:
        if name in known or "Centroid" in name or any(name.endswith(m) for m in marks):
            return T.DoubleType()
        return T.StringType()

    return T.StructType([T.StructField(n, kind(n)) for n in header])


def list_files(spark: SparkSession, folders: Sequence[str], extension: str) -> list[str]:
    """Paths of the files with the extension; reads the listing, not the content."""
    if not folders:
        raise ValueError("no input folder given")
    rows = (
        spark.read.format("binaryFile").option("pathGlobFilter", f"*{extension}")
        .load(list(folders)).select("path").orderBy("path").toLocalIterator()
    )
    return [r["path"] for r in rows]


def read_header(spark: SparkSession, path: str, delimiter: str) -> list[str]:
    """Column names of one file, from its first line."""
    first = spark.read.option("header", True).option("sep", delimiter).csv(path)
    return first.columns


def scan_batches(
    spark: SparkSession,
    folders: Sequence[str],
    extension: str = ".tsv",
    delimiter: str = "\t",
    exclude: str = "",
    slide_by_prefix: bool = False,
    folder_is_slide: bool = False,
    numeric: Sequence[str] = (),
) -> DataFrame:
    """All batches as one table with ``Slide`` and ``Batch``; a batch is a folder.

    Files are grouped by header. Each distinct header is one scan with an
    explicit schema; the scans are united by column name. Columns that match
    ``exclude`` (anywhere in the name, any case) are never parsed. NaN becomes
    null.
    """
    import re

    delimiter = "\t" if delimiter == "\\t" else delimiter
    files = list_files(spark, folders, extension)
    if not files:
        raise ValueError(f"no file ending in {extension} in {', '.join(folders)}")
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        headers = list(pool.map(lambda p: tuple(read_header(spark, p, delimiter)), files))
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path, header in zip(files, headers):
        by_header.setdefault(header, []).append(path)
    rx = re.compile(exclude, re.IGNORECASE) if exclude else None
    out = None
    for header, paths in by_header.items():
        raw = (
            spark.read.schema(measure_schema(header, numeric))
            .options(header=True, sep=delimiter, nanValue="NaN", enforceSchema=True)
            .csv(paths)
        )
        keep = [c for c in header if rx is None or not rx.search(c)]
        part = with_slide(
            raw.select(*cols(keep), F.col("_metadata.file_path").alias("_path")),
            slide_by_prefix, folder_is_slide,
        )
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return nan_to_null_all(out)


def with_slide(df: DataFrame, slide_by_prefix: bool = False, folder_is_slide: bool = False,
               path: str = "_path") -> DataFrame:
    """Derive ``Slide`` and ``Batch`` from the path and drop it.

    Slide is the image prefix before ``_``, else the folder, else the file
    name. With one slide per folder the image name gets the folder as prefix.
    """
    parts = F.split(col(path), "/")
    folder, file = F.element_at(parts, -2), F.element_at(parts, -1)
    if slide_by_prefix:
        slide = F.split_part(F.col("Image"), F.lit("_"), F.lit(1))
    else:
        slide = folder if folder_is_slide else file
    image = F.concat(folder, F.lit("-"), F.col("Image")) if folder_is_slide else F.col("Image")
    named = [
        image.alias("Image") if c == "Image" else col(c) for c in df.columns if c != path
    ]
    return df.select(*named, slide.alias("Slide"), folder.alias("Batch"))


def clean_images(df: DataFrame, image: str = "Image", suffix: str = IMAGE_SUFFIX) -> DataFrame:
    """Cut the file suffix from image names, as plain text."""
    return df.withColumn(image, F.replace(col(image), F.lit(suffix), F.lit("")))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table: tab text by its name, otherwise Parquet."""
    if path.rstrip("/").endswith((".tsv", ".csv")):
        sep = "\t" if path.rstrip("/").endswith(".tsv") else ","
        header = spark.read.options(header=True, sep=sep).csv(path).columns
        return spark.read.schema(measure_schema(header)).options(header=True, sep=sep).csv(path)
    return spark.read.parquet(path)


def read_tables(spark: SparkSession, paths: Sequence[str]) -> dict[str, DataFrame]:
    """Tables by method: the part of the name before ``_``; merged input is ``original``."""
    out = {}
    for path in paths:
        name = path.rstrip("/").split("/")[-1]
        key = "original" if name.startswith("merged") else name.split("_")[0].split(".")[0]
        out[key] = read_table(spark, path)
    return out


def union_tables(frames: Mapping[str, DataFrame], batch: str = "Batch") -> DataFrame:
    """Tables of several batches under each other, aligned by name, with the batch id."""
    out = None
    for name, df in frames.items():
        part = df.withColumn(batch, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no table given")
    return out


def scan_predictions(spark: SparkSession, folder: str, pattern: str = "*.tsv",
                     schema: T.StructType | str | None = None, skip_corrupt: bool = False) -> DataFrame:
    """Prediction files under a folder with ``Sample`` from the image name.

    An unreadable file is an error. With ``skip_corrupt`` it is left out, and a
    warning says how many files gave no row. It is an error if nothing matches.
    """
    reader = spark.read.options(header=True, sep="\t", ignoreCorruptFiles=skip_corrupt, recursiveFileLookup=False)
    reader = reader.option("pathGlobFilter", pattern)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(folder)
    if not df.columns or df.isEmpty():
        raise ValueError(f"no prediction rows matching {pattern} in {folder}")
    if skip_corrupt:
        listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
        read = df.select(F.col("_metadata.file_path").alias("path")).distinct()
        skipped = listed.join(read, "path", "left_anti").count()
        if skipped:
            warnings.warn(f"{skipped} file(s) in {folder} gave no row and were left out", stacklevel=2)
    return df.withColumn("Sample", F.replace(F.col("Image"), F.lit(SAMPLE_SUFFIX), F.lit("")))


def read_class_list(spark: SparkSession, path: str, label: str = "celltype") -> DataFrame:
    """Class names from a headerless file, one per row."""
    return spark.read.schema(f"`{label}` string").csv(path)


def read_rows(spark: SparkSession, path: str, max_rows: int | None = None) -> DataFrame:
    """A small CSV with header as text rows, at most ``max_rows`` if given."""
    df = spark.read.option("header", True).csv(path)
    return df.limit(max_rows) if max_rows else df


def read_metrics(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Metric documents of one step, keys aligned by name, with the file name."""
    return (
        spark.read.options(multiLine=True, pathGlobFilter=pattern).json(path)
        .withColumn("source_file", F.col("_metadata.file_name"))
    )


def merge_fragments(frames: Sequence[DataFrame]) -> DataFrame:
    """Score fragments under each other, aligned by name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
