"""S6 + F3-F6: strict validation of model payloads (JSON text).

Strict means no coercion: ``"90"`` is not an integer, ``9.0`` is not an
integer, the number 5 is not a string. Types are read with
``schema_of_variant`` on a parsed variant (NULL for malformed text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C

INT_TYPES = ["TINYINT", "SMALLINT", "INT", "BIGINT"]

# field -> expected kind, in the order the checks run
PAGE_FIELDS = [("file_name", "string"), ("rotation_degrees", "int"), ("role", "string"),
               ("confidence_score", "int")]


def _kind(v, field: str) -> F.Column:
    return F.schema_of_variant(F.variant_get(v, f"$.{field}", "variant"))


def validate_payloads(payloads: DataFrame, body_col: str = "body", fields=PAGE_FIELDS) -> DataFrame:
    """Adds ``valid`` and ``reason`` (first failed rule, NULL when valid) and the
    typed fields. Rule order: malformed, type:<field> per field, rotation,
    role, confidence."""
    v = F.try_parse_json(F.col(body_col))
    d = payloads.withColumn("_v", v)
    is_obj = F.schema_of_variant(F.col("_v")).startswith("OBJECT")
    checks = [(F.col("_v").isNull() | ~is_obj, "malformed")]
    for name, kind in fields:
        k = _kind(F.col("_v"), name)
        ok = (k == "STRING") if kind == "string" else k.isin(*INT_TYPES)
        checks.append((~F.coalesce(ok, F.lit(False)), f"type:{name}"))
    rot = F.try_variant_get(F.col("_v"), "$.rotation_degrees", "bigint")
    role = F.try_variant_get(F.col("_v"), "$.role", "string")
    conf = F.try_variant_get(F.col("_v"), "$.confidence_score", "bigint")
    checks += [(~rot.isin(*C.ROTATIONS), "rotation"),
               (~role.isin(*C.ROLES), "role"),
               (~conf.between(0, 100), "confidence")]
    reason = F.lit(None).cast("string")
    for cond, name in reversed(checks):
        reason = F.when(cond, F.lit(name)).otherwise(reason)
    d = d.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())
    typed = {"file_name": F.try_variant_get(F.col("_v"), "$.file_name", "string"),
             "rotation_degrees": rot.cast("int"), "role": role, "confidence_score": conf.cast("int")}
    for name, expr in typed.items():  # typed values only for valid payloads
        d = d.withColumn(name, F.when(F.col("valid"), expr))
    return d.drop("_v")


# --- nested payloads -----------------------------------------------------------
# A spec is a list of (field, kind, required, rule): kind "string", "int", or
# ("array", kind or spec of the items); rule a function of the typed value.

def _in_range(x):
    return x.between(0, 100)


PAGE_ROLE = [("file_name", "string", True, None), ("role", "string", True, lambda x: x.isin(*C.ROLES)),
             ("evidence", "string", True, None)]
EXTRACTED_DOCUMENT = [
    ("folios", ("array", "string"), True, None), ("page_roles", ("array", PAGE_ROLE), True, None),
    ("ordered_file_names", ("array", "string"), True, None), ("document_type", "string", True, None),
    ("client_name", "string", False, None), ("confidence_score", "int", True, _in_range),
    ("reasoning", "string", True, None)]
PAGE_ORIENTATION = [("file_name", "string", True, None), ("rotation_degrees", "int", True, lambda x: x.isin(*C.ROTATIONS)),
                    ("reasoning", "string", True, None)]
EXTRACTION = [("documents", ("array", EXTRACTED_DOCUMENT), True, None)]
ORIENTATION = [("orientations", ("array", PAGE_ORIENTATION), True, None)]

EXTRACTION_TYPE = ("documents array<struct<folios:array<string>,page_roles:array<struct<file_name:string,role:string,"
                   "evidence:string>>,ordered_file_names:array<string>,document_type:string,client_name:string,"
                   "confidence_score:int,reasoning:string>>")
ORIENTATION_TYPE = "orientations array<struct<file_name:string,rotation_degrees:int,reasoning:string>>"


def _one(problem: F.Column) -> F.Column:
    """An array of the problem text, empty when it is null."""
    return F.when(problem.isNull(), F.array().cast("array<string>")).otherwise(F.array(problem))


def _value_problems(x, path, kind, required, rule) -> F.Column:
    """Problems (array<string>) of a variant value that should be of ``kind``."""
    told = F.coalesce(F.schema_of_variant(x), F.lit("MISSING"))
    absent = told.isin("MISSING", "VOID")
    wrong = F.concat(path, F.when(told == "MISSING", F.lit(":missing")).otherwise(F.lit(":type")))
    if kind in ("string", "int"):
        ok = told == "STRING" if kind == "string" else told.isin(*INT_TYPES)
        problem = F.when(absent if required else F.lit(False), wrong).when(~ok & ~absent, wrong)
        if rule is not None:
            typed = F.try_variant_get(x, "$", "string" if kind == "string" else "bigint")
            problem = problem.when(ok & ~rule(typed), F.concat(path, F.lit(":value")))
        return _one(problem)
    item = kind[1]

    def one_item(v, i):
        at = F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
        return _object_problems(v, at, item) if isinstance(item, list) else _value_problems(v, at, item, True, None)
    items = F.try_variant_get(x, "$", "array<variant>")
    return F.when(~told.startswith("ARRAY"), _one(wrong)).otherwise(F.flatten(F.transform(items, one_item)))


def _object_problems(v, path, spec) -> F.Column:
    told = F.coalesce(F.schema_of_variant(v), F.lit("MISSING"))
    parts = [_value_problems(F.try_variant_get(v, f"$.{name}", "variant"),
                             F.concat(path, F.lit("." + name)) if path is not None else F.lit(name), kind, required, rule)
             for name, kind, required, rule in spec]
    whole = F.concat(path if path is not None else F.lit("payload"), F.lit(":type"))
    return F.when(~told.startswith("OBJECT"), F.array(whole)).otherwise(F.concat(*parts))


def validate_response(payloads: DataFrame, spec=EXTRACTION, schema: str = EXTRACTION_TYPE, body_col: str = "body") -> DataFrame:
    """S6 on a whole nested response: adds ``problems`` (path:missing, path:type or
    path:value for every violation, ascending; "payload:malformed" for text that
    is no JSON), ``valid`` and ``parsed`` (the typed response, null unless valid)."""
    d = payloads.withColumn("_v", F.try_parse_json(F.col(body_col)))
    problems = F.when(F.col("_v").isNull(), F.array(F.lit("payload:malformed"))).otherwise(
        F.array_sort(_object_problems(F.col("_v"), None, spec)))
    d = d.withColumn("problems", problems).withColumn("valid", F.size("problems") == 0)
    return d.withColumn("parsed", F.when(F.col("valid"), F.from_json(body_col, schema))).drop("_v")


def response_rejects(validated: DataFrame, key_col: str, stage: str) -> DataFrame:
    """One reject row per problem of a response."""
    return validated.select(F.lit(stage).alias("stage"), F.col(key_col).cast("string").alias("key"),
                            F.explode("problems").alias("_p")).select(
        "stage", "key", F.lit("bad_payload").alias("reason"), F.col("_p").alias("detail"))
