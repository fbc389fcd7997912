"""Sources and sinks: Bronze text files, sorted exports, landing manifests; published tables are in ``tables``."""

from __future__ import annotations

import csv
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import digest as D
from strata.session import checkpoint_dir
from strata.sources.schemas import all_text
from strata.sources.tables import discard, publish, read_table, stage, switch  # noqa: F401


@dataclass
class BronzeRead:
    """A Bronze text file read by column name.

    ``frame`` has exactly the expected columns, in order (a missing one is NULL text);
    ``header`` is what the file actually declares; ``missing`` what it lacks.
    """

    frame: DataFrame
    header: list[str]
    missing: list[str] = field(default_factory=list)


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names declared by a CSV file's header (reads the first line only)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def _by_name(spark: SparkSession, paths, header: Sequence[str], expected: Sequence[str]) -> DataFrame:
    # enforceSchema=false: Spark compares every part file's own header with the schema and
    # fails on a difference, instead of binding columns by position.
    raw = (spark.read.option("header", True).option("enforceSchema", False)
           .schema(all_text(header)).csv(paths))
    return raw.select(*[F.col(f"`{c}`") if c in header else F.lit(None).cast("string").alias(c)
                        for c in expected])


def read_csv_by_name(spark: SparkSession, path: str, expected: Sequence[str],
                     header: list[str] | None = None) -> BronzeRead:
    """Read a CSV with a header, every column as text, binding columns by *name*.

    The schema is the file's own header (all strings, nothing inferred, one pass); the
    expected columns are then selected by name. Empty fields are NULL. All part files
    must share one header: a part with another one fails the read; ``read_csv_variants``
    reads such folders.
    """
    header = header if header is not None else csv_header(spark, path)
    return BronzeRead(_by_name(spark, path, header, expected), header,
                      [c for c in expected if c not in header])


def csv_headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Part files by the header they declare; reads the lines of each file's first block.

    Collects one path a file: a listing, like the one the scan itself makes on the driver.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    first = lines.filter("at = 0").groupBy("file").agg(F.first("value").alias("line"))
    found: dict[tuple[str, ...], list[str]] = {}
    for r in first.collect():
        found.setdefault(tuple(next(csv.reader([r["line"]]))), []).append(r["file"])
    return {k: sorted(v) for k, v in sorted(found.items())}


def read_csv_variants(spark: SparkSession, path: str, expected: Sequence[str]) -> BronzeRead:
    """Like ``read_csv_by_name`` for folders whose part files declare different headers: each is read by its own."""
    variants = csv_headers(spark, path)
    if not variants:
        raise ValueError(f"no CSV header under {path}")
    frame = None
    for header, paths in variants.items():
        part = _by_name(spark, paths, list(header), expected)
        frame = part if frame is None else frame.unionByName(part)
    names = list(dict.fromkeys(c for h in variants for c in h))
    return BronzeRead(frame, names, [c for c in expected if any(c not in h for h in variants)])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Text extract with a header row (what Bronze receives)."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def export_sorted(df: DataFrame, dest: str, keys: Sequence[str],
                  formats: Sequence[str] = ("parquet", "csv")) -> dict[str, str]:
    """Globally ordered export: range-partitioned sort, part files in key order.

    Returns ``{format: path}``; paths are ``{dest}.{format}`` directories whose part
    files, read in name order, are sorted by ``keys``.
    """
    unknown = [f for f in formats if f not in ("parquet", "csv")]
    if unknown:
        raise ValueError(f"unsupported export format {unknown[0]!r}")
    out = {}
    ordered = sorted_once(df, keys) if len(formats) > 1 else df.orderBy(*keys)
    for fmt in formats:
        path = f"{dest.rstrip('/')}.{fmt}"
        w = ordered.write.mode("overwrite")
        w.parquet(path) if fmt == "parquet" else w.option("header", True).csv(path)
        out[fmt] = path
    return out


def sorted_once(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` in the order of ``keys``, sampled, shuffled and sorted once, its partitions written to the checkpoint folder.

    What is derived from it reads those partitions in their order, each by one task, without a shuffle.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.orderBy(*keys).checkpoint()


def manifest(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """One row per file under ``root``: dataset (parent folder), file_name, bytes.

    Only file metadata is read (the binaryFile source prunes the content column), so
    listing a large landing zone costs no data read.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", glob).load(root))
    parts = F.split(F.col("path"), "/")
    return files.select(F.element_at(parts, -2).alias("dataset"), F.element_at(parts, -1).alias("file_name"),
                        F.col("length").alias("bytes"))


def content_manifest(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One row per dataset with the digest of its rows by column name (see ``operators.digest``).

    Read as splittable CSV and folded map-side: a file is never loaded whole, and one changed value changes the digest.
    """
    out = None
    for name, path in paths.items():
        raw = spark.read.option("header", True).option("enforceSchema", False)
        frame = raw.schema(all_text(csv_header(spark, path))).csv(path)
        part = D.digest(frame).select(F.lit(name).alias("dataset"), *D.MEASURES)
        out = part if out is None else out.unionByName(part)
    return out


def line_manifest(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """One row per file under ``root``: dataset, file_name, bytes and the digest of its lines, header included.

    Lines are digested split by split and merged by file, whatever the files hold; the size in bytes tells
    what lines do not show (line ends). Spark's sources skip files of no bytes, so those are not listed.
    """
    lines = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root)
             .select("value", F.col("_metadata.file_path").alias("file")))
    digests = lines.groupBy("file").agg(*D.measures(F.col("value"), F.length("value")))
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
              .select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes")))
    parts = F.split("file", "/")
    return listed.join(digests, "file", "left").select(
        F.element_at(parts, -2).alias("dataset"), F.element_at(parts, -1).alias("file_name"), "bytes",
        *[F.coalesce(c, F.lit(0).cast(digests.schema[c].dataType)).alias(c) for c in D.MEASURES])


#: How a dataset or file of one manifest stands to the other.
STATUSES = ("same", "changed", "missing", "unexpected")


def compare_manifests(expected: DataFrame, landed: DataFrame,
                      keys: Sequence[str] = ("dataset", "file_name")) -> DataFrame:
    """Full outer join of two manifests: missing / unexpected / changed / same per key."""
    keys = list(keys)
    measures = [c for c in expected.columns if c not in keys]
    e = expected.select(*keys, *[F.col(c).alias(f"expected_{c}") for c in measures], F.lit(True).alias("in_e"))
    l = landed.select(*keys, *[F.col(c).alias(f"landed_{c}") for c in measures], F.lit(True).alias("in_l"))
    j = e.join(l, keys, "full")
    same = F.lit(True)
    for c in measures:
        same = same & F.col(f"expected_{c}").eqNullSafe(F.col(f"landed_{c}"))
    status = (F.when(F.col("in_l").isNull(), F.lit("missing")).when(F.col("in_e").isNull(), F.lit("unexpected"))
              .when(same, F.lit("same")).otherwise(F.lit("changed")))
    return j.withColumn("status", status).drop("in_e", "in_l")


def dataset_totals(files: DataFrame) -> DataFrame:
    """Files and bytes per dataset (the landing report)."""
    return files.groupBy("dataset").agg(F.count(F.lit(1)).alias("files"),
                                        F.sum("bytes").alias("bytes"))
