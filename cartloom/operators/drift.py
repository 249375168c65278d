"""Drift of landed documents against the fixed schema (PRJ1, PRJ5).

Flattening keeps the columns of a fixed list, so a key that the service adds or retypes would
vanish without trace. Here landed documents are scanned as VARIANT values, whatever they hold,
and all their keys are counted and compared with the schema: the first, dynamic phase of the
reference's schema system as a report.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def read_variants(spark: SparkSession, path: str) -> DataFrame:
    """The documents of landed responses as they are: ``data`` (VARIANT), ``source_file``."""
    schema = T.StructType([T.StructField("hits", T.ArrayType(T.StructType([T.StructField("data", T.VariantType())])))])
    return (spark.read.schema(schema).json(path).withColumn("source_file", F.col("_metadata.file_path"))
            .select("source_file", F.explode("hits.data").alias("data")))


def schema_paths(text: str) -> list[tuple[str, str, str, str]]:
    """(parent, within, path, found) of every key in the text of a VARIANT schema, such as
    ``OBJECT<a: STRING, b: ARRAY<OBJECT<`c.d`: BIGINT>>>``."""
    out: list[tuple[str, str, str, str]] = []

    def name(at: int) -> tuple[str, int]:
        if text[at] != "`":
            end = text.index(":", at)
            return text[at:end], end
        end = at + 1
        while text[end] != "`" or text[end + 1] == "`":
            end += 2 if text[end] == "`" else 1
        return text[at + 1:end].replace("``", "`"), end + 1

    def walk(at: int, path: str) -> tuple[str, int]:
        """The kind of the type at a place, and where its text ends; keys below it are listed."""
        end = at
        while end < len(text) and (text[end].isalpha() or text[end] == "_"):
            end += 1
        kind = text[at:end]
        if kind == "OBJECT" and text[end:end + 1] == "<":
            end += 1
            while text[end] != ">":
                key, end = name(end)
                below = f"{path}.{key}" if path else key
                found, end = walk(end + 2, below)
                out.append((path, "OBJECT", below, found))
                end += 2 if text[end] == "," else 0
            return kind, end + 1
        if kind == "ARRAY" and text[end:end + 1] == "<":
            below = f"{path}.[]" if path else "[]"
            found, end = walk(end + 1, below)
            out.append((path, "ARRAY", below, found))
            return kind, end + 1
        if text[end:end + 1] == "(":
            end = text.index(")", end) + 1
        return kind, end

    walk(0, "")
    return out


def document_keys(docs: DataFrame, by: Sequence[str] = (), data: str = "data") -> DataFrame:
    """Keys of all documents: ``by..., parent, within, path, found, n``.

    ``path`` joins keys by dots, the elements of an array are ``[]``; ``parent`` is the path of
    the value that holds the key and ``within`` its kind (OBJECT or ARRAY); ``found`` is the kind of
    value (OBJECT, ARRAY, STRING, BIGINT, DOUBLE, DECIMAL, BOOLEAN, VOID for JSON nulls alone,
    VARIANT for elements of several kinds) and ``n`` the number of documents.

    One pass: each document's schema is a text (``schema_of_variant``), equal texts are counted,
    pre-aggregated before the shuffle, and only the different ones are taken apart into keys.
    """
    keep = [F.col(f"`{c}`") for c in by]
    shapes = docs.groupBy(*keep, F.schema_of_variant(data).alias("shape")).agg(F.count(F.lit(1)).alias("n"))
    taken = F.udf(lambda shape: [] if shape is None else schema_paths(shape),
                  "array<struct<parent:string,within:string,path:string,found:string>>")
    keys = shapes.select(*keep, "n", F.explode(taken("shape")).alias("k")).select(*keep, "k.*", "n")
    return keys.groupBy(*keep, "parent", "within", "path", "found").agg(F.sum("n").alias("n"))


NUMBERS = ["BIGINT", "DOUBLE", "DECIMAL", "FLOAT"]


def schema_keys(schema: T.StructType) -> list[tuple[str, list[str]]]:
    """(path, kinds of value that fit) of a document schema, as :func:`document_keys` names them."""
    out: list[tuple[str, list[str]]] = []

    def walk(path: str, dtype: T.DataType) -> None:
        if isinstance(dtype, T.StructType):
            kinds = ["OBJECT"]
            for f in dtype.fields:
                walk(f"{path}.{f.name}" if path else f.name, f.dataType)
        elif isinstance(dtype, T.ArrayType):
            kinds = ["ARRAY"]
            walk(f"{path}.[]", dtype.elementType)
        elif isinstance(dtype, T.BooleanType):
            kinds = ["BOOLEAN"]
        elif isinstance(dtype, T.IntegralType):
            kinds = ["BIGINT"]
        elif isinstance(dtype, T.NumericType):
            kinds = NUMBERS
        else:
            kinds = ["STRING"]
        if path:
            out.append((path, [*kinds, "VOID"]))

    walk("", schema)
    return out


def key_drift(keys: DataFrame, schema: T.StructType) -> DataFrame:
    """Keys that the schema does not expect: ``by..., path, problem, found, n``.

    ``unknown``: the key is not in the schema though its parent is (keys below an unknown or
    retyped one are not listed again); ``retyped``: its values are of another kind. A JSON null
    fits everything. The schema's side is a constant of one row per column.
    """
    spark = keys.sparkSession
    expected = spark.createDataFrame(schema_keys(schema), "path string, kinds array<string>")
    holders = spark.createDataFrame([("", "OBJECT", True)] + [(p, k[0], True) for p, k in schema_keys(schema) if k[0] in ("OBJECT", "ARRAY")],
                                    "parent string, within string, holder boolean")
    checked = keys.join(expected, "path", "left").join(holders, ["parent", "within"], "left")
    problem = (F.when(F.col("kinds").isNull() & F.col("holder"), F.lit("unknown"))
               .when(F.col("kinds").isNotNull() & F.col("holder") & ~F.array_contains("kinds", F.col("found")), F.lit("retyped")))
    return (checked.withColumn("problem", problem).filter(F.col("problem").isNotNull())
            .select(*[c for c in keys.columns if c not in ("parent", "within", "path", "found", "n")], "path", "problem", "found", "n"))
