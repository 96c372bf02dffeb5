"""Land nested JSON payloads as flat, typed tables.

Payloads are read with a declared schema (never inferred: an all-NULL field
would change type between loads) and flattened with ``explode`` /
``inline`` on the executors.  Land payloads as one document per line or per
file: a single multi-line document is read by a single task, so explode it
first and let the parquet write restore parallelism.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlens.functions.columns import parsed_json
from pitchlens.sources.published import TAG


def read_documents(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Read JSON documents (JSON Lines by default) with a fixed schema."""
    return (spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST")
            .json(path))


def _as_struct(docs: DataFrame, doc_col: str, field: str, elem_schema: T.StructType | None) -> Column:
    dtype = docs.schema[doc_col].dataType
    if isinstance(dtype, T.StringType):
        if elem_schema is None:
            raise ValueError("a JSON text column needs elem_schema")
        doc_schema = T.StructType([T.StructField(field, T.ArrayType(elem_schema))])
        return parsed_json(doc_col, doc_schema).getField(field)
    return F.col(doc_col).getField(field)


def explode_payload(docs: DataFrame, field: str, elem_schema: T.StructType | None = None,
                    doc_col: str = "doc", keep: tuple[str, ...] = ()) -> DataFrame:
    """One record array of every document -> one row per record.

    ``doc_col`` is a parsed struct or JSON text (then ``elem_schema`` gives the
    record type).  NULL or empty arrays give no rows; a document that doesn't parse
    fails the load (a truncated one, a value of another type, blank text).
    """
    arr = _as_struct(docs, doc_col, field, elem_schema)
    return docs.select(*keep, F.inline(arr))


def load_array(spark: SparkSession, path: str, elem_schema: T.StructType, root: str | None = None,
               multi_line: bool = True) -> DataFrame:
    """Top-level JSON arrays (``root=None``) or the arrays under ``root``.

    Spark turns a top-level array into one row per element; an array under a
    key is read as a one-field document and exploded.  Documents are whole files,
    or lines with ``multi_line=False`` (then a large file splits over tasks).
    """
    if root is None:
        return read_documents(spark, path, elem_schema, multi_line)
    schema = T.StructType([T.StructField(root, T.ArrayType(elem_schema))])
    return read_documents(spark, path, schema, multi_line).select(F.inline(F.col(root)))


def typed_records(rows: DataFrame, schemas: Mapping[str, T.StructType], record: str = "_record") -> DataFrame:
    """Rows of a table name (``TAG``), a record's text and other columns as tagged rows: the text
    is parsed by its table's schema into the struct column of that name."""
    kept = [c for c in rows.columns if c not in (TAG, record)]
    own = {t: F.when(F.col(TAG) == t, F.col(record)) for t in schemas}  # null text isn't parsed
    rows = rows.withColumns({f"__pl_{t}": parsed_json(own[t], schema) for t, schema in schemas.items()})
    return rows.select(TAG, *[
        F.when(F.col(TAG) == t, F.struct(*[F.col(c) for c in kept], *[F.col(f"__pl_{t}.{f.name}") for f in schema.fields], F.col(record))).alias(t)
        for t, schema in schemas.items()])


def tagged_records(docs: DataFrame, arrays: Mapping[str, tuple[str, T.StructType]], doc_col: str = "value",
                   record: str = "_record") -> DataFrame:
    """S1 for several arrays at once: one pass over the documents, each parsed once.

    ``arrays`` maps a table to its array field (empty: the document is the array) and
    record schema.  A document becomes one variant; the elements of all its arrays
    become rows (table name in ``TAG``), and each record's text is parsed by its
    table's schema into the struct column of that name, which also keeps the whole
    record as text in ``record``.  Other columns of ``docs`` are kept in the structs.
    ``Load.write_tagged`` stores the rows as tables.
    A document, an array or a record of another type fails the load; null or missing
    arrays give no rows.
    """
    kept = [c for c in docs.columns if c != doc_col]
    whole = docs.select(*kept, F.parse_json(doc_col).alias("__pl_doc"))
    if any(field for field, _ in arrays.values()):  # a document that is no object fails here
        whole = whole.withColumn("__pl_fields", F.variant_get("__pl_doc", "$", "map<string,variant>"))
    element = f"array<struct<{TAG}:string,r:variant>>"

    def elements(table: str, field: str) -> Column:
        array = F.variant_get(F.try_element_at("__pl_fields", F.lit(field)) if field else "__pl_doc", "$", "array<variant>")
        return F.coalesce(F.transform(array, lambda r: F.struct(F.lit(table).alias(TAG), r.alias("r"))), F.array().cast(element))

    rows = whole.select(*kept, F.explode(F.concat(*[elements(t, field) for t, (field, _) in arrays.items()])).alias("x"))
    rows = rows.select(*kept, f"x.{TAG}", F.to_json("x.r").alias(record))

    return typed_records(rows, {t: schema for t, (_, schema) in arrays.items()}, record)


def flatten_history(entity_docs: DataFrame, entities: DataFrame, active: Column, entity_key: str,
                    doc_key: str, field: str = "history", elem_schema: T.StructType | None = None,
                    doc_col: str = "doc") -> DataFrame:
    """S3: per-entity documents -> one row per history record of active entities.

    The active set is a semi join (no per-entity loop, no driver round trip);
    an entity without a document, or with a missing/empty history, adds no rows.
    """
    active_ids = entities.where(active).select(F.col(entity_key).alias(doc_key))
    kept = entity_docs.join(active_ids, doc_key, "left_semi")
    return explode_payload(kept, field, elem_schema, doc_col=doc_col)


def flatten_carry(docs: DataFrame, outer: str, inner: str, carry: Mapping[str, str],
                  outer_schema: T.StructType | None = None, doc_col: str = "doc") -> DataFrame:
    """Two-level arrays; attributes of the outer record are copied onto
    every inner record (``{out_col: outer_attr}``)."""
    outer_rows = explode_payload(docs, outer, outer_schema, doc_col=doc_col)
    return outer_rows.select(
        F.inline(F.col(inner)),
        *[F.col(attr).alias(out) for out, attr in carry.items()],
    )


def nested_as_json(df: DataFrame, depth: int = 0) -> DataFrame:
    """Keep nested values as JSON text below ``depth``.

    depth 0: every struct/array/map column becomes JSON text.  depth 1:
    first-level struct fields become ``parent__child`` columns, and anything
    nested deeper becomes JSON text.
    """
    out: list[Column] = []
    for f in df.schema.fields:
        nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
        if not nested:
            out.append(F.col(f.name))
        elif depth >= 1 and isinstance(f.dataType, T.StructType):
            for sub in f.dataType.fields:
                c = F.col(f.name).getField(sub.name)
                if isinstance(sub.dataType, (T.StructType, T.ArrayType, T.MapType)):
                    c = F.to_json(c)
                out.append(c.alias(f"{f.name}__{sub.name}"))
        else:
            out.append(F.to_json(F.col(f.name)).alias(f.name))
    return df.select(*out)


_CAMEL_1 = re.compile(r"(.)([A-Z][a-z]+)")
_CAMEL_2 = re.compile(r"([a-z0-9])([A-Z])")


def snake_case(name: str) -> str:
    return _CAMEL_2.sub(r"\1_\2", _CAMEL_1.sub(r"\1_\2", name)).lower()


def normalize_columns(df: DataFrame) -> DataFrame:
    """camelCase -> snake_case on top-level names (nested keys unchanged)."""
    return df.toDF(*[snake_case(c) for c in df.columns])
