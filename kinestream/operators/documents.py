"""Contracts of JSON documents: every failure of every document as rows."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinestream.operators.contract import enforce

_NUMBER = r"(TINYINT|SMALLINT|INT|BIGINT|DECIMAL\(\d+,\d+\)|DOUBLE|FLOAT)"
#: What Spark calls the type of a document's value, by kind.
_KINDS = {
    "string": "STRING",
    "integer": r"(TINYINT|SMALLINT|INT|BIGINT|DECIMAL\(\d+,0\))",
    "number": _NUMBER,
    "boolean": "BOOLEAN",
    "object": "OBJECT<.*>",
    "array": "ARRAY<.*>",
}
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)*")


@dataclass(frozen=True)
class Field:
    """What a document must hold at ``path`` (names with dots between).

    kind: string, integer, number, boolean, object or array. one_of: the values that are allowed. low, high: bounds, both included. shape: the lengths of
    nested arrays of numbers, from the outside in; it makes the kind an array.
    """

    path: str
    kind: str = "array"
    required: bool = True
    one_of: tuple = ()
    low: float | None = None
    high: float | None = None
    shape: tuple[int, ...] = ()

    def __post_init__(self) -> None:
        if self.kind not in _KINDS or not _NAME.fullmatch(self.path):
            raise ValueError(f"not a field: {self.path} {self.kind}")


def _shaped(value: Column, shape: tuple[int, ...]) -> Column:
    """Whether nested arrays have these lengths everywhere."""
    if len(shape) == 1:
        return F.size(value) == shape[0]
    return (F.size(value) == shape[0]) & F.forall(value, lambda v: _shaped(v, shape[1:]))


def _broken(doc: Column, f: Field) -> Column:
    """The rule that a field of a document breaks; null if none."""
    at = F.try_variant_get(doc, f"$.{f.path}", "variant")
    kind = F.schema_of_variant(at)
    rules = [(at.isNull(), "missing" if f.required else None), (~F.regexp_like(kind, F.lit(f"^{_KINDS[f.kind]}$")), f"not {'an' if f.kind[0] in 'aio' else 'a'} {f.kind}")]
    if f.one_of:
        rules.append((~F.try_variant_get(doc, f"$.{f.path}", "string").isin([str(x).lower() if isinstance(x, bool) else str(x) for x in f.one_of]), "not an allowed value"))
    number = F.try_variant_get(doc, f"$.{f.path}", "double")
    for bound, off in ((f.low, lambda x: number < x), (f.high, lambda x: number > x)):
        if bound is not None:
            rules.append((off(float(bound)), "out of bounds"))
    if f.shape:
        n = len(f.shape)
        rules.append((~F.regexp_like(kind, F.lit(f"^{'ARRAY<' * n}{_NUMBER}{'>' * n}$")), "not all numbers"))
        cast = F.try_variant_get(doc, f"$.{f.path}", "array<" * n + "double" + ">" * n)
        rules.append((~F.coalesce(_shaped(cast, f.shape), F.lit(False)), f"not of shape {'x'.join(map(str, f.shape))}"))
    made = F.when(rules[0][0], rules[0][1])
    for broken, rule in rules[1:]:
        made = made.when(broken, rule)
    return made


def _unknown(prefix: str) -> Callable[[Column], Column]:
    return lambda name: F.struct(F.concat(F.lit(prefix), name).alias("path"), F.lit("unknown").alias("rule"))


def failures(df: DataFrame, keys: list[str], column: str, fields: list[Field], closed: bool = True) -> DataFrame:
    """keys, path and rule of all that breaks the contract, any number for a document; a document without failures has no row.

    A text that is no JSON object, or null, breaks one rule at '$'. A field breaks one rule at most: missing, of another kind, not an allowed value, out of bounds, not all numbers or not
    of the shape. ``closed``: a name that no field has, in the document or in an object of it, is 'unknown'. A JSON null is a value of no kind.
    Built-in functions on the parsed value only: a document is parsed once for its fields, no row is gathered, and text columns of any table will do.
    """
    doc, text = F.col("_doc"), F.col("_text")
    rows = df.select(*keys, F.col(column).cast("string").alias("_text")).withColumn("_doc", F.try_parse_json("_text"))
    whole = doc.isNotNull() & F.regexp_like(F.schema_of_variant(doc), F.lit("^OBJECT<"))
    found = [F.struct(F.lit(f.path).alias("path"), _broken(doc, f).alias("rule")) for f in fields]
    each = F.filter(F.array(*found), lambda x: x["rule"].isNotNull())
    if closed:
        parents = {"": [f.path.split(".")[0] for f in fields]}
        for f in fields:
            parts = f.path.split(".")
            if f.kind == "object":
                parents.setdefault(f.path, [])
            for i in range(1, len(parts)):
                parents.setdefault(".".join(parts[:i]), []).append(parts[i])
        for parent, names in parents.items():
            inner = F.get_json_object(text, f"$.{parent}") if parent else text
            extra = F.array_except(F.coalesce(F.json_object_keys(inner), F.array().cast("array<string>")), F.array(*[F.lit(n) for n in dict.fromkeys(names)]).cast("array<string>"))
            each = F.concat(each, F.transform(extra, _unknown(f"{parent}." if parent else "")))
    nothing = F.array(F.struct(F.lit("$").alias("path"), F.lit("not a JSON object").alias("rule")))
    return rows.select(*keys, F.inline(F.when(F.coalesce(whole, F.lit(False)), each).otherwise(nothing)))


def read(df: DataFrame, keys: list[str], column: str, fields: list[Field], closed: bool = True) -> DataFrame:
    """keys and a column for each field of one value: doubles for numbers, nested arrays of doubles for shapes. Any failure is a ContractError."""
    enforce(failures(df, keys, column, fields, closed), f"{column} breaks its contract")
    kinds = {"string": "string", "integer": "bigint", "number": "double", "boolean": "boolean"}
    doc = F.parse_json(F.col(column).cast("string"))
    made = []
    for f in fields:
        kind = "array<" * len(f.shape) + "double" + ">" * len(f.shape) if f.shape else kinds.get(f.kind)
        if kind:
            made.append(F.try_variant_get(doc, f"$.{f.path}", kind).alias(f.path.replace(".", "_")))
    return df.select(*keys, *made)
