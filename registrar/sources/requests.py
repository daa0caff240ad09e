"""JSON in and out: request bodies as JSON text -> typed request tables, and result
rows -> JSON objects (the reference's API speaks JSON both ways).

Parsing and rendering are ``from_json`` / ``to_json`` column expressions, so they
run inside the scan's task like any projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrar.schema import REQUEST_SCHEMAS

# Nested body of a grade submission: {"period": ..., "grades": [[student, grade], ...]}. A long list
# comes in parts, bodies of their own: "first" is the place of a part's first entry in the whole list
# and "total" the length of that (absent: the body is the whole list).
GRADE_BODY = T.StructType([T.StructField("period", T.StringType()),
                           T.StructField("grades", T.ArrayType(T.ArrayType(T.StringType()))),
                           T.StructField("first", T.LongType()), T.StructField("total", T.LongType())])
PART_ROWS = 4096

_BODY_FIELDS = {
    "registration": ("username", "email", "password", "is_coordinator"),
    "degree_request": ("student_id", "date"),
    "activity_request": (),
    "admission_request": ("classes",),
}


def readable(body: Column) -> Column:
    """Whether a text is one JSON object and nothing else. A null or empty text, a value of another
    kind, text after the object, and an object that names a field twice aren't."""
    listed = F.try_parse_json(F.concat(F.lit("["), body, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"b":'), body, F.lit("}")))  # with both, no text can close a bracket of ours
    kind = F.schema_of_variant(F.try_variant_get(named, "$.b", "variant"))
    return F.coalesce(listed.isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull() & kind.startswith("OBJECT<"), F.lit(False))


def split_bodies(df: DataFrame, kind: str, body_col: str = "body") -> tuple[DataFrame, DataFrame]:
    """(requests, rejects): the request table of the readable bodies, and the rows whose body isn't
    readable as they came, with the status ``bad_json``. A readable body that lacks a field is a
    request; the operators report the field as missing."""
    ok = readable(F.col(body_col))
    return parse_bodies(df.where(ok), kind, body_col), df.where(~ok).withColumn("status", F.lit("bad_json"))


def grade_bodies(headers: DataFrame, rows: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Grade batches as JSON bodies of at most ``part_rows`` entries each: (batch_id, edition_id,
    submitter_id, body), no row for a batch without entries. Neither a task nor a text holds a batch."""
    first = (F.col("pos") - F.pmod(F.col("pos"), F.lit(part_rows))).alias("first")
    parts = rows.groupBy("batch_id", first).agg(F.array_sort(F.collect_list(F.struct("pos", "pair"))).alias("rows"))
    totals = rows.groupBy("batch_id").agg(F.count("*").alias("total"))
    body = F.to_json(F.struct("period", F.transform("rows", lambda r: r["pair"]).alias("grades"), "first", "total"))
    return parts.join(totals.join(headers, "batch_id"), "batch_id").select("batch_id", "edition_id", "submitter_id", body.alias("body"))


def parse_bodies(df: DataFrame, kind: str, body_col: str = "body") -> DataFrame:
    """Parse the JSON ``body_col`` of each request row into the request table of
    ``kind``. Other columns of ``df`` (``seq``, path parameters) are kept; fields the
    body lacks are null (the operators report them as missing).

    ``registration`` turns the password into ``password_present`` (the password
    itself is never kept); ``grade_batch`` yields a nested batch table for
    ``grading.split_batches``.
    """
    if kind == "grade_batch":
        b = F.from_json(F.col(body_col), GRADE_BODY)
        return df.withColumn("__b", b).select(
            *[c for c in df.columns if c != body_col], F.col("__b.period").alias("period"),
            F.col("__b.grades").alias("grades"), F.col("__b.first").alias("first"), F.col("__b.total").alias("total"))
    schema = REQUEST_SCHEMAS[kind]
    fields = []
    for name in _BODY_FIELDS[kind]:
        if name == "password":
            fields.append(T.StructField("password", T.StringType()))
        elif name == "date":
            fields.append(T.StructField("date", T.StringType()))
        else:
            fields.append(schema[name])
    parsed = df.withColumn("__b", F.from_json(F.col(body_col), T.StructType(fields)))
    out = []
    for name in _BODY_FIELDS[kind]:
        if name == "password":
            out.append((F.length(F.col("__b.password")) > 0).alias("password_present"))
        elif name == "date":
            out.append(F.try_to_date(F.col("__b.date")).alias("date"))
        else:
            out.append(F.col(f"__b.{name}").alias(name))
    keep = [c for c in df.columns if c != body_col and c not in _BODY_FIELDS[kind]]
    return parsed.select(*keep, *out)


def to_json_rows(df: DataFrame, col: str = "json") -> DataFrame:
    """Each row as one JSON object; null fields are written as ``null`` (not dropped),
    nested arrays of structs become JSON lists of objects."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]),
                               {"ignoreNullFields": "false"}).alias(col))


def write_json_result(df: DataFrame, path: str) -> None:
    """JSON-lines sink for a result table (one object per row, nulls kept)."""
    to_json_rows(df, "value").write.mode("overwrite").text(path)
