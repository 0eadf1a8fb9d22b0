"""Configuration as data: source registry, scheme master, taxonomy, month words."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from holdsift import rules as R
from holdsift.sources.tables import exists

SOURCE_SCHEMA = T.StructType([
    T.StructField("source_key", T.StringType(), False),
    T.StructField("amc_name", T.StringType(), False),
    T.StructField("base_url", T.StringType(), False),
    T.StructField("page_type", T.StringType()),
    T.StructField("strategy", T.StringType()),
    T.StructField("api_patterns", T.ArrayType(T.StringType())),
    T.StructField("file_types", T.ArrayType(T.StringType())),
    T.StructField("download_selectors", T.ArrayType(T.StringType())),
    T.StructField("enabled", T.BooleanType()),
])
SCHEME_SCHEMA = T.StructType([
    T.StructField("amc_key", T.StringType(), False),
    T.StructField("amc_name", T.StringType(), False),
    T.StructField("scheme_ord", T.IntegerType(), False),
    T.StructField("scheme_name", T.StringType(), False),
    T.StructField("category", T.StringType()),
    T.StructField("aliases", T.ArrayType(T.StringType())),
])


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Configuration as a table whose size Spark knows: a join with it is planned by that size, so that a small registry
    goes to the rows and the rows stay where they are."""
    columns = list(zip(*rows)) or [()] * len(schema)
    wanted = to_arrow_schema(schema)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, wanted)], schema=wanted), schema)


def sources(spark: SparkSession, rows: Sequence[Mapping] = R.SOURCES) -> DataFrame:
    """Registry rows with the defaults an entry may leave out; with ``source_id`` if the entries have it."""
    default = {"page_type": "JS_SPA", "strategy": "link_extraction", "api_patterns": [],
               "file_types": ["xlsx", "pdf"], "download_selectors": [], "enabled": True}
    filled = [{**default, **r} for r in rows]
    schema = T.StructType(SOURCE_SCHEMA.fields + ([T.StructField("source_id", T.IntegerType())] if filled and "source_id" in filled[0] else []))
    return local_table(spark, [tuple(r[f.name] for f in schema) for r in filled], schema)


def scheme_master(spark: SparkSession, master: Sequence[R.Scheme] = R.SCHEME_MASTER) -> DataFrame:
    rows = [(s.amc_key, s.amc_name, i, s.scheme_name, s.category, list(s.aliases)) for i, s in enumerate(master)]
    return spark.createDataFrame(rows, SCHEME_SCHEMA)


_ENTRY = ("struct<source_id:int,source_key:string,amc_name:string,base_url:string,page_type:string,strategy:string,"
          "api_patterns:array<string>,file_types:array<string>,download_selectors:array<string>,enabled:boolean>")
_MASTER = "amcs map<string,struct<name:string,schemes:array<struct<name:string,category:string,aliases:array<string>>>>>"


def _config(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON file under its schema; a missing file and a value of another type are errors."""
    if not exists(spark, path):
        raise FileNotFoundError(f"no configuration file {path}")
    return spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """Registry from a JSON file, ``{"sources": [...]}``, with source_id (given, or the place in the list from 1 on).

    Left-out values get their defaults, no list under the key gives no rows. An entry without key, name or address, or with
    a key or an id that another has, is an error: rows would be lost or counted twice by joins.
    """
    entries = [e.asDict() for r in _config(spark, path, f"sources array<{_ENTRY}>").collect() for e in r["sources"] or []]
    for e in entries:
        missing = [k for k in ("source_key", "amc_name", "base_url") if not e[k]]
        if missing:
            raise ValueError(f"{path}: an entry has no {', '.join(missing)}: {e}")
    ids = [i if e["source_id"] is None else e["source_id"] for i, e in enumerate(entries, 1)]
    for values, what in ((ids, "source_id"), ([e["source_key"] for e in entries], "source_key")):
        if len(set(values)) < len(values):
            raise ValueError(f"{path}: a {what} stands there twice")
    told = sources(spark, [{**{k: v for k, v in e.items() if v is not None}, "source_id": i} for e, i in zip(entries, ids)])
    return told if entries else told.withColumn("source_id", F.lit(None).cast("int"))


def read_scheme_master(spark: SparkSession, path: str) -> list[R.Scheme]:
    """Scheme master from a JSON file, ``{"amcs": {key: {"name": ..., "schemes": [...]}}}``, in the file's order; names are
    looked up from this list, so it is configuration and of its size. A missing file gives no schemes."""
    if not exists(spark, path):
        return []
    found = []
    for row in _config(spark, path, _MASTER).select(F.map_entries("amcs").alias("amcs")).collect():  # a dict has no such order
        for key, amc in row["amcs"] or []:
            for s in amc["schemes"] or []:
                found.append(R.Scheme(key, amc["name"], s["name"], s["category"], tuple(s["aliases"] or ())))
    return found


def scheme_candidates(master: DataFrame) -> DataFrame:
    """One row per candidate name: the scheme name at position 0, then its aliases."""
    names = F.concat(F.array("scheme_name"), F.coalesce("aliases", F.array().cast("array<string>")))
    return master.select(
        "amc_key", "scheme_ord", "scheme_name", "category", F.posexplode(names).alias("alias_ord", "candidate")
    )


def categories(spark: SparkSession, taxonomy: Mapping[str, Sequence[str]] = R.CATEGORY_TAXONOMY) -> DataFrame:
    one = spark.createDataFrame(
        [({k: list(v) for k, v in taxonomy.items()},)],
        T.StructType([T.StructField("m", T.MapType(T.StringType(), T.ArrayType(T.StringType())))]),
    )
    return one.select(F.explode("m").alias("category", "subs")).select(
        "category", F.explode("subs").alias("subcategory")
    )


def month_words(spark: SparkSession, words: Sequence[tuple[str, int]] = R.MONTH_WORDS) -> DataFrame:
    return spark.createDataFrame([(w, n) for w, n in words], "word string, month int")


def sync_sources(existing: DataFrame, registry: DataFrame) -> DataFrame:
    """Stored sources plus registry rows whose key is not there yet; stored rows are never changed."""
    missing = registry.join(existing.select("source_key").distinct(), "source_key", "left_anti")
    return existing.unionByName(missing, allowMissingColumns=True)
