"""Readers of landed files: CSV, JSON, XML, HTML, pipe-delimited and free text, zip archives."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import markup
from ..functions.strings import norm


def read_csv(spark: SparkSession, path, columns: list[str], **options) -> DataFrame:
    """All columns as text, blanks as null; lines that do not fit are in `_corrupt_record`."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "_corrupt_record"]])
    raw = spark.read.csv(path, schema=schema, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record", multiLine=False, escape='"', **options)
    return raw.select(*[norm(c).alias(c) for c in columns], "_corrupt_record")


def read_awards(spark: SparkSession, path, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(award rows, sub-award rows): a file is one of sub-awards if its name says so."""
    df = read_csv(spark, path, columns).withColumn("is_sub", F.contains(F.lower(F.element_at(F.split(F.input_file_name(), "/"), -1)), F.lit("subaward")))
    return df.filter(~F.col("is_sub")).drop("is_sub"), df.filter("is_sub").drop("is_sub")


def legislators(df: DataFrame) -> DataFrame:
    """Name, party letter, state, position, other names and id of each legislator."""
    full = F.coalesce(norm("full_name"), F.concat_ws(" ", norm("first_name"), norm("middle_name"), norm("last_name"), norm("suffix")))
    others = F.array_compact(F.array(F.when(norm("nickname").isNotNull(), F.concat_ws(" ", norm("nickname"), norm("last_name"))), F.concat_ws(" ", norm("first_name"), norm("last_name"))))
    return df.select(full.alias("name"), F.upper(F.left("party", F.lit(1))).alias("party"), F.upper("state").alias("state"), F.when(F.col("type") == "sen", "Senator").when(F.col("type") == "rep", "Representative").alias("position"), "district", F.array_distinct(others).alias("alt_names"), F.upper(norm("bioguide_id")).alias("bioguide_id"))


def symbols(tiers: dict[str, DataFrame], column: str) -> DataFrame:
    """(symbol, tier) of several lists; a symbol is letters and digits once its dots are gone."""
    out = None
    for tier, df in tiers.items():
        part = df.select(F.upper(norm(column)).alias("symbol"), F.lit(tier).alias("tier")).filter(F.replace("symbol", F.lit("."), F.lit("")).rlike("^[A-Za-z0-9]+$"))
        out = part if out is None else out.unionByName(part)
    return out


def read_pipe_index(spark: SparkSession, path, forms: list[str]) -> DataFrame:
    """Rows of daily form indexes: the header and what stands before it goes, five fields are needed, only the forms named."""
    p = F.split("value", r"\|")
    rows = spark.read.text(path).select(p.alias("p")).filter((F.size("p") >= 5) & F.element_at("p", 1).rlike(r"^\s*\d+\s*$"))
    f = lambda k: F.trim(F.element_at("p", k))
    out = rows.select(f(1).alias("cik"), f(2).alias("company"), f(3).alias("form"), F.try_to_date(f(4), "yyyyMMdd").alias("filed"), f(5).alias("file"))
    return out.filter(F.col("form").isin(*forms)).withColumn("accession", F.nullif(F.regexp_extract("file", r"(\d{10}-\d{2}-\d{6})", 1), F.lit("")))


HISTORY = "symbol string, company_name string, sector string, history array<struct<date:string,open:double,high:double,low:double,close:double,volume:bigint,market_cap:bigint>>"


def read_history(spark: SparkSession, path) -> DataFrame:
    """Price points of per-symbol documents; the tier is the folder's name."""
    d = spark.read.schema(HISTORY).json(path).withColumn("tier", F.element_at(F.split(F.input_file_name(), "/"), -2))
    return d.select("symbol", "tier", F.explode("history").alias("p")).select("symbol", "tier", "p.*")


def read_pages(spark: SparkSession, path, item: str) -> DataFrame:
    """Items of landed API pages `{"results": [...]}`, one on a line; item is the DDL of one."""
    return spark.read.schema(f"results array<struct<{item}>>").json(path).select(F.explode("results").alias("r")).select("r.*")


def untag(c: Column) -> Column:
    """The text of `{"S": ..}`, `{"N": ..}` or a bare value in JSON."""
    v = F.coalesce(F.get_json_object(c, "$.S"), F.get_json_object(c, "$.N"))
    return F.coalesce(v, F.when(~F.startswith(F.ltrim(c), F.lit("{")), F.trim(c, F.lit('"'))))


def html_rows(c: Column) -> Column:
    """array<array<string>>: texts of the cells of all table bodies' rows, entities decoded; without a body, of all rows."""
    return markup.rows_of(c)


def html_field(c: Column, patterns: list[str]) -> Column:
    """The first group of the first pattern that matches, without markup."""
    found = [F.nullif(F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract(c, p, 1), "<[^>]*>", " "), r"\s+", " ")), F.lit("")) for p in patterns]
    return F.coalesce(*found)


def html_links(c: Column, patterns: list[str]) -> Column:
    """Addresses by the first pattern that finds any."""
    found = [F.regexp_extract_all(c, F.lit(p), F.lit(1)) for p in patterns]
    return F.coalesce(*[F.when(F.size(f) > 0, f) for f in found], F.array().cast("array<string>"))


def footnoted(cell: Column, notes: Column) -> Column:
    """struct<value, footnote<number, explanation>> of a cell text like `12 (3)`; a missing explanation is empty."""
    n = F.regexp_extract(cell, r"\((\d+)\)\s*$", 1).try_cast("int")
    value = F.trim(F.regexp_replace(cell, r"\(\d+\)\s*$", ""))
    return F.struct(value.alias("value"), F.when(n.isNotNull(), F.struct(n.alias("number"), F.coalesce(F.try_element_at(notes, n), F.lit("")).alias("explanation"))).alias("footnote"))


def zip_members(df: DataFrame, name: str, raw: str, suffix: str) -> DataFrame:
    """(archive, member, content) of each member with that ending; archives are opened where they lie."""
    kind = df.schema[name].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for archive, data in zip(part["name"], part["raw"], strict=True):
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    for m in z.namelist():
                        if m.lower().endswith(suffix):
                            yield pd.DataFrame({"archive": [archive], "member": [m], "content": [z.read(m).decode("utf-8", "replace")]})

    return df.select(F.col(name).alias("name"), F.col(raw).alias("raw")).mapInPandas(run, f"archive {kind}, member string, content string")


def read_zip(spark: SparkSession, path, suffix: str) -> DataFrame:
    """The members of archive files."""
    return zip_members(spark.read.format("binaryFile").load(path), "path", "content", suffix)


def code_list(spark: SparkSession, codes: dict) -> DataFrame:
    """A constant list of codes and names."""
    return spark.createDataFrame([(str(k), v) for k, v in codes.items()], "code string, name string")
