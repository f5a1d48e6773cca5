"""Functions declared in SQL, for the expressions of mappings and for queries.

A function of ours is a name for an expression: Spark puts the expression in its place, so it is optimised and compiled with the
query around it, and no value leaves the JVM as with a function written in Python.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from feedkit.functions.names import quoted, reject_duplicates
from feedkit.functions.types import date_text, spark_type
from feedkit.sources.config import load_json


def declare_functions(spark: SparkSession, declarations: str | dict, *, date_dialect: str = "warehouse") -> list[str]:
    """Declare for this session the functions of a document, or of one at a path, and return their names.

    It is ``{"functions": [{"name", "parameters": [{"name", "type"}], "returns", "body"}]}``. Type names may be the
    warehouse's, and so may date patterns in the body, an expression of the parameters. A function may use those declared
    before it; one of the same name is replaced. Bodies are run as given: take them from trusted places only.
    """
    document = load_json(spark, declarations)
    names = [f["name"] for f in document["functions"]]
    reject_duplicates(names, "function declarations")
    for function in document["functions"]:
        parameters = function.get("parameters", [])
        reject_duplicates([p["name"] for p in parameters], f"parameters of {function['name']}")
        listed = ", ".join(f"{quoted(p['name'])} {spark_type(p['type'])[0]}" for p in parameters)
        body = date_text(function["body"], date_dialect)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {quoted(function['name'])}({listed}) RETURNS {spark_type(function['returns'])[0]} RETURN {body}")
    return names
