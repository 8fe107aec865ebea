"""Declarative table validation against a rule catalogue.

Type rules (F4, F5) are checked on the schema, with no data scan.  Enum and
range rules (F6, F7) are evaluated for all columns in ONE aggregate pass;
the first failing rule per column wins (F8), giving a (column_name, status)
table that is computed lazily like any other DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared logical type -> accepted Spark types (the storage
# types the reference accepted, expressed as Spark SQL type names).
ALLOWED_TYPES = {
    "string": ["string"],
    "integer": ["int", "bigint", "smallint", "tinyint"],
    "number": ["float", "double"],
    "float": ["float", "double"],
    "boolean": ["boolean"],
    "datetime": ["timestamp", "timestamp_ntz", "date"],
}

# Status messages.
MSG_VALID = "Valid"
MSG_MISSING_IN_SCHEMA = "Column missing in schema"
MSG_MISSING_IN_DATA = "Column missing in data"


def _fmt_bound(v) -> str:
    return repr(v) if isinstance(v, float) else str(v)


def _quoted_set(values: Column, has_null: Column) -> Column:
    """Python-set-like text: {'a', 'b', None}, values sorted."""
    items = F.transform(F.array_sort(values), lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    items = F.when(has_null, F.concat(items, F.array(F.lit("None")))).otherwise(items)
    return F.concat(F.lit("{"), F.array_join(items, ", "), F.lit("}"))


def validation_status(df: DataFrame, rules: Mapping[str, Mapping],
                      report_absent: bool = False) -> DataFrame:
    """(column_name, status) for every column of ``df``.

    Enum rule: a value outside the set, or NULL, is invalid; the message
    lists the distinct offending values.  Range rule: applies when both
    bounds are given; NULL or a value outside [min, max] fails.
    """
    static: dict[str, str] = {}
    checks: dict[str, dict[str, Column]] = {}
    aggs = []
    for f in df.schema.fields:
        c = f.name
        rule = rules.get(c)
        if not rule:
            static[c] = MSG_MISSING_IN_SCHEMA
            continue
        actual = f.dataType.simpleString()
        expected = rule["type"]
        if actual not in ALLOWED_TYPES.get(expected, []):
            static[c] = f"Incorrect dtype: expected {expected}, got {actual}"
            continue
        checks[c] = {}
        x = F.col(c)
        if "enum" in rule:
            bad = x.isNull() | ~x.isin(list(rule["enum"]))
            aggs += [F.count_if(bad).alias(f"e_{c}"),
                     F.collect_set(F.when(bad, x.cast("string"))).alias(f"ev_{c}"),
                     F.max(x.isNull().cast("int")).alias(f"en_{c}")]
            checks[c]["enum"] = F.col(f"e_{c}") > 0
        if "minimum" in rule and "maximum" in rule:
            lo, hi = rule["minimum"], rule["maximum"]
            ok = F.coalesce((x >= F.lit(lo)) & (x <= F.lit(hi)), F.lit(False))
            aggs.append(F.count_if(~ok).alias(f"r_{c}"))
            checks[c]["range"] = F.col(f"r_{c}") > 0
    row = df.agg(*aggs) if aggs else df.sparkSession.range(1)
    structs = []
    for f in df.schema.fields:
        c = f.name
        if c in static:
            status = F.lit(static[c])
        else:
            rule = rules[c]
            status = F.lit(MSG_VALID)
            if "range" in checks[c]:
                msg = (f"Out of range: [{_fmt_bound(rule['minimum'])}, "
                       f"{_fmt_bound(rule['maximum'])}]")
                status = F.when(checks[c]["range"], F.lit(msg)).otherwise(status)
            if "enum" in checks[c]:
                msg = F.concat(F.lit("Invalid categorical values: "),
                               _quoted_set(F.col(f"ev_{c}"), F.col(f"en_{c}") == 1))
                status = F.when(checks[c]["enum"], msg).otherwise(status)
        structs.append(F.struct(F.lit(c).alias("column_name"), status.alias("status")))
    if report_absent:
        for c in rules:
            if c not in df.columns:
                structs.append(F.struct(F.lit(c).alias("column_name"),
                                        F.lit(MSG_MISSING_IN_DATA).alias("status")))
    return row.select(F.inline(F.array(*structs)))


def invalid_values(df: DataFrame, rules: Mapping[str, Mapping]) -> DataFrame:
    """J3/U2 long form: (column_name, value, n) of values outside each enum
    (NULL included), as a set difference computed by aggregation."""
    parts = []
    for c, rule in rules.items():
        if c in df.columns and "enum" in rule:
            x = F.col(c)
            parts.append(df.where(x.isNull() | ~x.isin(list(rule["enum"])))
                         .groupBy(x.cast("string").alias("value")).agg(
                             F.count(F.lit(1)).alias("n"))
                         .select(F.lit(c).alias("column_name"), "value", "n"))
    if not parts:
        return df.sparkSession.createDataFrame([], "column_name string, value string, n long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def all_valid(status: DataFrame) -> bool:
    """table gate; True when every column is Valid."""
    return status.where(F.col("status") != MSG_VALID).isEmpty()


def write_if_valid(df: DataFrame, status: DataFrame, path: str) -> bool:
    """write the validated table only when every rule passes."""
    ok = all_valid(status)
    if ok:
        df.write.mode("overwrite").parquet(path)
    return ok


def rules_from_catalogue(catalogue: Mapping[str, Mapping]) -> dict[str, dict]:
    """Read a schema catalogue in the reference's layout
    ``{column: {type: t, constraints: {enum: [...] | minimum: a, maximum: b}}}``
    (e.g. loaded from its YAML file) into the flat rule dict used here."""
    out: dict[str, dict] = {}
    for col, spec in catalogue.items():
        rule = {"type": spec["type"]}
        rule.update(spec.get("constraints") or {})
        out[col] = rule
    return out


def rules_from_yaml(path: str) -> dict[str, dict]:
    """Load a YAML schema catalogue (driver-side config, not data)."""
    import yaml
    with open(path) as f:
        return rules_from_catalogue(yaml.safe_load(f))


def save_status(status: DataFrame, path: str) -> str:
    """(column_name, status) table as JSON lines, written pass or fail."""
    status.coalesce(1).write.mode("overwrite").json(path)
    return path


def spark_schema(rules: Mapping[str, Mapping]) -> T.StructType:
    """Catalogue -> StructType (string/integer/float/boolean/datetime)."""
    m = {"string": T.StringType(), "integer": T.LongType(), "number": T.DoubleType(),
         "float": T.DoubleType(), "boolean": T.BooleanType(),
         "datetime": T.TimestampType()}
    return T.StructType([T.StructField(c, m[r["type"]], True) for c, r in rules.items()])
