"""JSON values of any type: arguments and results of tools, as VARIANT columns.

All functions take texts as well, so that columns of texts and of typed values
can be handled alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Arguments keep the order in which they were given.
ARGS = "map<string,variant>"
STEP = f"struct<step:int,thought:string,tool:string,args:{ARGS},expected_result:variant,actual_result:variant,status:string,error_message:string>"
RESULT = "struct<success:boolean,output:variant,error:string,step_results:array<struct<step:int,success:boolean,output:variant,error:string>>>"


def from_text(text: Column) -> Column:
    """The JSON value that a text holds, or else the text itself."""
    return F.coalesce(F.try_parse_json(text), text.cast("variant"))


def as_json(value: Column) -> Column:
    """A value as JSON text, texts in quotes."""
    return F.to_json(value.cast("variant"))


def plain(value: Column) -> Column:
    """A text as it is, any other value as JSON text."""
    return value.cast("variant").cast("string")


def quoted(text: Column) -> Column:
    """A text as Python writes it: in single quotes unless it has those and no double ones, with line feeds, tabs and backslashes escaped."""
    body = text
    for given, written_ in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(given), F.lit(written_))
    double = F.contains(text, F.lit("'")) & ~F.contains(text, F.lit('"'))
    single = F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(text.isNull(), "None").when(double, F.concat(F.lit('"'), body, F.lit('"'))).otherwise(single)


def written(value: Column) -> Column:
    """A value as Python writes it: the words of its JSON text, each put in Python's way."""
    words = F.regexp_extract_all(as_json(value), F.lit(r'("(?:[^"\\]|\\.)*"|true|false|null|[^"])'), F.lit(1))
    word = lambda w: (
        F.when(F.startswith(w, F.lit('"')), quoted(F.try_variant_get(F.try_parse_json(w), "$", "string")))
        .when(w == "true", "True").when(w == "false", "False").when(w == "null", "None").when(w == ",", ", ").when(w == ":", ": ").otherwise(w)
    )
    return F.coalesce(F.array_join(F.transform(words, word), ""), F.lit("None"))
