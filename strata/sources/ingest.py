"""Landing and shaping raw sources (CSV history, JSON pages, variant records,
column sanitising, schema casting, column comments)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_history(spark: SparkSession, path: str, required: Sequence[str], rename: dict[str, str] | None = None,
                     date_cols: Sequence[str] = (), keep: Sequence[str] | None = None,
                     in_fmt: str = "M/d/yyyy", out_fmt: str = "yyyy-MM-dd") -> DataFrame:
    """S3: headered CSV (quote and escape ``"``), spaces in names -> ``_``, rows whose
    mandatory column is NULL/blank dropped, ``M/d/yyyy`` dates re-formatted, columns
    selected, ingest time stamped. Everything is read as string (no inference)."""
    df = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
          .option("inferSchema", False).csv(path))
    df = df.toDF(*[c.strip().replace(" ", "_") for c in df.columns])
    if rename:
        df = df.withColumnsRenamed(rename)
    for c in required:
        df = df.where(F.col(c).isNotNull() & (F.trim(F.col(c)) != ""))
    df = df.withColumns({c: F.date_format(F.to_date(F.col(c), in_fmt), out_fmt) for c in date_cols})
    if keep:
        df = df.select(*keep)
    return df.withColumn("datalake_ingestion_timestamp", F.current_timestamp())


def land_json_pages(spark: SparkSession, path: str, table_id: str, table_name: str, env: str = "dev",
                    whole_files: bool = True) -> DataFrame:
    """S4 (re-aimed from the HTTP client): one row per landed JSON page ->
    ``raw_data VARIANT`` plus metadata (table id/name, env, source path, row count of
    the page, ingest time). A page is a whole file, or a line of one without ``whole_files``."""
    df = spark.read.option("wholetext", whole_files).text(path).withColumn("_src", F.input_file_name())
    v = F.parse_json(F.col("value"))
    return df.select(F.lit(table_id).alias("table_id"), F.lit(table_name).alias("table_name"),
                     F.lit(env).alias("env"), F.col("_src").alias("url"), v.alias("raw_data"),
                     F.size(F.variant_get(v, "$.result", "array<variant>")).alias("page_rows"),
                     F.current_timestamp().alias("datalake_ingestion_timestamp"))


def unpack_variant_records(df: DataFrame, variant_col: str, array_path: str | None,
                           field_map: dict[str, str], meta_cols: Sequence[str] = (),
                           hash_exclude: Sequence[str] = ("datalake_ingestion_timestamp",)) -> DataFrame:
    """Explode an array inside a variant (or take the variant itself when
    ``array_path`` is None), project mapped fields as strings under clean names and
    add a SHA-256 row hash over them (NULLs skipped)."""
    if array_path:
        rec = df.select(*meta_cols, F.explode(F.variant_get(F.col(variant_col), array_path, "array<variant>")).alias("_r"))
    else:
        rec = df.select(*meta_cols, F.col(variant_col).alias("_r"))
    out = rec.select(*meta_cols, *[F.variant_get(F.col("_r"), path, "string").alias(name)
                                   for name, path in field_map.items()])
    hcols = [c for c in out.columns if c not in set(hash_exclude)]
    return out.withColumn("row_hash", F.sha2(F.concat_ws("||", *[F.col(c).cast("string") for c in hcols]), 256))


def explode_json_array(df: DataFrame, col: str, sample_json: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Parse a JSON array column, explode it and expand the struct. The schema is that of one sample document
    (``schema_of_json``) or, without one, merged over every row (one aggregate; an array of no objects raises)."""
    if sample_json is not None:
        schema = F.schema_of_json(F.lit(sample_json))
    else:
        found = df.agg(F.schema_of_variant_agg(F.parse_json(F.col(col))).alias("s")).first()["s"]
        if found is None or not found.startswith("ARRAY<OBJECT<"):
            raise ValueError(f"{col} holds no arrays of objects but {found}")
        schema = found.replace("OBJECT<", "STRUCT<")
    return df.select(*keep, F.explode(F.from_json(F.col(col), schema)).alias("_row")).select(*keep, "_row.*")


def infer_variant_schema(df: DataFrame, col: str) -> str:
    """Aggregate a schema over every row of a variant column (one aggregate
    action; returns the DDL string for ``from_json``). An empty or all-NULL column gives an
    empty struct; a payload that is no object raises."""
    found = df.agg(F.schema_of_variant_agg(F.col(col)).alias("s")).first()["s"]
    if found is None or found in ("VOID", "OBJECT<>"):
        return "STRUCT<>"
    if not found.startswith("OBJECT<"):
        raise ValueError(f"{col} holds no objects but {found}")
    return found.replace("OBJECT<", "STRUCT<")


def rename_from_lookup(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns by a case-insensitive id -> label map (the map is a small
    lookup collected once by the caller; unmapped columns keep their names)."""
    low = {k.lower(): v for k, v in mapping.items()}
    return df.select(*[F.col(f"`{c}`").alias(low.get(c.lower(), c)) for c in df.columns])


def sanitise_name(name: str) -> str:
    """S9 name rule: '(' ')' and space -> '_', '.', '~', ':' removed, '%' -> 'perc'."""
    n = re.sub(r"[() ]", "_", name)
    n = re.sub(r"[.~:]", "", n)
    return n.replace("%", "perc")


def sanitise_columns(df: DataFrame) -> DataFrame:
    """Sanitised column names, all-NULL rows dropped, ingest time stamped."""
    out = df.toDF(*[sanitise_name(c) for c in df.columns]).dropna(how="all")
    return out.withColumn("datalake_ingestion_timestamp", F.current_timestamp())


def cast_to_schema(df: DataFrame, defs: dict[str, str], ts_formats: dict[str, str] | None = None,
                   date_formats: dict[str, str] | None = None, on_error: str = "raise") -> DataFrame:
    """Cast raw (string) columns to declared types in one projection.

    Leading/trailing double quotes are stripped; TIMESTAMP with a format uses
    ``to_timestamp(col, fmt)``, without one the native ISO cast; DATE goes through a
    timestamp; everything else is ``cast``. Declared casing wins (case-insensitive
    match); undeclared columns pass through. A format given for a non-temporal column
    raises ``ValueError``. Bad values raise (ANSI) unless ``on_error='null'``."""
    ts_formats, date_formats = ts_formats or {}, date_formats or {}
    declared = {k.lower(): (k, v.upper()) for k, v in defs.items()}
    for c in list(ts_formats) + list(date_formats):
        if c.lower() in declared and declared[c.lower()][1] not in ("TIMESTAMP", "DATE"):
            raise ValueError(f"format given for non-temporal column {c}")
    fmt = {k.lower(): v for k, v in {**ts_formats, **date_formats}.items()}
    safe = on_error == "null"
    out: list[Column] = []
    for c in df.columns:
        if c.lower() not in declared:
            out.append(F.col(f"`{c}`"))
            continue
        name, typ = declared[c.lower()]
        raw = F.regexp_replace(F.col(f"`{c}`").cast("string"), r'^"|"$', "")
        f = fmt.get(c.lower())
        if typ == "TIMESTAMP":
            e = (F.try_to_timestamp(raw, F.lit(f)) if safe else F.to_timestamp(raw, f)) if f else \
                (raw.try_cast("timestamp") if safe else raw.cast("timestamp"))
        elif typ == "DATE":
            ts = (F.try_to_timestamp(raw, F.lit(f)) if safe else F.to_timestamp(raw, f)) if f else \
                (raw.try_cast("timestamp") if safe else raw.cast("timestamp"))
            e = ts.cast("date")
        else:
            e = raw.try_cast(typ.lower()) if safe else raw.cast(typ.lower())
        out.append(e.alias(name))
    return df.select(*out)


def attach_comments(df: DataFrame, defs: dict[str, dict]) -> DataFrame:
    """Column comments (and unit / long name) into the column metadata."""
    exprs = []
    for c in df.columns:
        meta = defs.get(c, {}).get("description")
        if meta:
            exprs.append(F.col(f"`{c}`").alias(c, metadata={"comment": meta.get("comment", ""), **meta}))
        else:
            exprs.append(F.col(f"`{c}`"))
    return df.select(*exprs)
