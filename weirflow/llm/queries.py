"""Queries of the text and record operators, over the whole tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import addresses, components, encode, leaks, lookalike, names


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return names.same_entity(table(spark, folder, "client_documents")).toDF("record_id_a", "record_id_b")


def p2_entities(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: its entity (a form's id) and the number of other forms that it is linked with."""
    records, members, links = names.entities(table(spark, folder, "client_documents"))
    rows = records.join(members.select("form", "label"), "form", "left").join(components.degrees(links), "form", "left")
    return rows.select(F.col("key").alias("record_id"), F.coalesce("label", "form").alias("entity"), F.coalesce("links", F.lit(0)).alias("links"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return addresses.same_place(table(spark, folder, "client_documents")).toDF("record_id_a", "record_id_b")


def p4_places(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record with an address: its parts, its class of forms that are linked, and the number of other forms linked with its own."""
    parts = addresses.classes(table(spark, folder, "client_documents"))
    return parts.select(F.col("key").alias("record_id"), "number", "way", F.concat_ws(" ", "kinds").alias("kinds"), F.concat_ws(" ", "names").alias("names"), "town_name", "country", "place", "links")


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode.encode(table(spark, folder, "documents"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike.same_looking(table(spark, folder, "documents")).toDF("doc_id_a", "doc_id_b")


def p8_forms(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike.common_form(table(spark, folder, "documents"))


def p8_classes(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document that isn't blank: the class of all texts that look like its own, and how many other texts that class has."""
    return lookalike.classes(table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (p2_found, p2_entities, p4_found, p4_places, p6_ids, p7_found, p8_found, p8_forms, p8_classes)}
SQL = {}
