"""Writers: keyed tables, compressed JSON with a manifest, sorted text, stubs, quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes up to which a row goes into a keyed table whole.
ITEM_BYTES = 400 * 1024 * 85 // 100


def put(df: DataFrame, path: str, key: list[str], order: list[Column]) -> None:
    """A table of one row for each key, the last by order; the whole table is replaced."""
    from .ordered import pick

    pick(df, key, order).write.mode("overwrite").parquet(path)


def write_json_gz(df: DataFrame, path: str, sort: list[str]) -> DataFrame:
    """Compressed JSON lines, and a manifest row: row_count, byte_size, sha256 and when.

    The digest is over the sorted digests of the rows, so it does not depend on
    how the rows lie in files, and no row needs to leave its partition.
    """
    df.write.mode("overwrite").option("compression", "gzip").json(path)
    return manifest(df).withColumn("indexed_at", F.current_timestamp())


def manifest(df: DataFrame) -> DataFrame:
    doc = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    rows = df.select(doc.alias("doc")).select(F.octet_length("doc").alias("n"), F.conv(F.substring(F.sha2("doc", 256), 1, 15), 16, 10).cast("decimal(38,0)").alias("h"))
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum("n"), F.lit(0)).alias("byte_size"), F.sha2(F.coalesce(F.sum("h"), F.lit(0)).cast("string"), 256).alias("sha256"))


def file_manifest(spark, path: str) -> DataFrame:
    """One row for each written file: file, byte_size, sha256 of its bytes, indexed_at; files are digested where they are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(name.alias("file"), F.col("length").alias("byte_size"), F.sha2("content", 256).alias("sha256"), F.current_timestamp().alias("indexed_at"))


def write_sorted_text(df: DataFrame, col: str, path: str) -> None:
    """Distinct values, one to a line, sorted without regard to case; range-partitioned, so the files follow each other."""
    df.select(F.col(col).cast("string").alias("value")).filter("value is not null").distinct().orderBy(F.lower("value"), "value").write.mode("overwrite").text(path)


def gather(spark, folders: list[str], into: str) -> None:
    """The files of written folders in one folder, each named after the folder that it was in."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(into).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(into))
    for folder in folders:
        for f in fs.listStatus(path(folder)):
            name = f.getPath().getName()
            if not name.startswith(("_", ".")):
                fs.rename(f.getPath(), path(f"{into}/{folder.rsplit('/', 1)[-1]}-{name}"))


def split_stubs(df: DataFrame, keys: list[str], most: int = ITEM_BYTES) -> tuple[DataFrame, DataFrame]:
    """(rows for the table: whole, or only keys where too large; the too large rows whole)."""
    sized = df.withColumn("is_oversized", F.octet_length(F.to_json(F.struct(*df.columns))) > most)
    whole = [c for c in df.columns if c not in keys]
    stub = sized.select(*keys, *[F.when(~F.col("is_oversized"), F.col(c)).alias(c) for c in whole], "is_oversized")
    return stub, sized.filter("is_oversized").drop("is_oversized")


def quarantine(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, failed rows with the names of the checks they fail)."""
    failed = F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in checks.items()]), lambda x: x.isNotNull())
    marked = df.withColumn("errors", failed)
    return marked.filter(F.size("errors") == 0).drop("errors"), marked.filter(F.size("errors") > 0)
