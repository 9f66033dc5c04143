"""Files landed as they are: binary payloads as base64, texts as UTF-8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskmill.functions.text import file_name, plain_base64


def encode_payloads(df: DataFrame, path: str, payload: str) -> DataFrame:
    """File name and payload as one line of base64 text."""
    return df.withColumn("file_name", file_name(F.col(path))).withColumn(
        "payload", plain_base64(F.col(payload))
    )


def decode_payloads(df: DataFrame) -> DataFrame:
    return df.withColumn("content", F.unbase64("payload"))


def land_binary(spark: SparkSession, folder: str, target: str, pattern: str = "*") -> None:
    """Store every file of a folder as ``(file_name, payload, n_bytes)``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    landed = encode_payloads(files, "path", "content")
    landed.select("file_name", "payload", F.col("length").alias("n_bytes")).write.mode(
        "overwrite"
    ).parquet(target)


def read_texts(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """One row per file with its base name and whole text."""
    texts = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True)
    return texts.select(file_name(F.col("_metadata.file_path")).alias("file_name"), F.col("value").alias("text"))
