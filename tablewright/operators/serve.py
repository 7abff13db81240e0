"""Input checks, scoring and serving-side features."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.fixed_values import INPUT_RULES
from tablewright.functions.columns import col
from tablewright.operators.profile import missing_table

log = logging.getLogger(__name__)
ISSUE_SCHEMA = "level string, check string, detail string"


def check_schema(df: DataFrame, expected: list[str]) -> tuple[bool, DataFrame, list[tuple]]:
    """(valid, table in expected column order, issues). Missing columns make it invalid."""
    issues = []
    if len(df.columns) != len(expected):
        issues.append(("warning", "feature_count", f"expected {len(expected)}, got "
                                                   f"{len(df.columns)}"))
    absent = [c for c in expected if c not in df.columns]
    if absent:
        issues.append(("issue", "missing_features", ",".join(absent)))
    extra = [c for c in df.columns if c not in expected]
    if extra:
        issues.append(("warning", "extra_features", ",".join(extra)))
    out = df.select(*[col(c) for c in expected if c in df.columns])
    for f in out.schema:
        if not isinstance(f.dataType, T.NumericType):
            issues.append(("warning", "not_numeric", f.name))
    return not absent, out, issues


def issue_table(df: DataFrame, issues: list[tuple]) -> DataFrame:
    return df.sparkSession.createDataFrame(issues, ISSUE_SCHEMA)


def batch_report(df: DataFrame, expected: list[str]) -> DataFrame:
    """Issues of a batch with the cells they concern: level, check, detail, cells.

    Names and types are compared first; missing, non-finite and rule-breaking cells of the expected
    columns and the rows that schema issues concern are counted in one pass over the batch.
    """
    _, table, issues = check_schema(df, expected)
    n = F.count(F.lit(1))
    found = [(level, check, detail, n) for level, check, detail in issues]
    for f in table.schema:
        value = col(f.name)
        found.append(("warning", "missing_cells", f.name, F.count_if(value.isNull())))
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            found.append(("issue", "non_finite_cells", f.name, F.count_if(F.isnan(value) | (F.abs(value) == float("inf")))))
        if f.name in INPUT_RULES:
            broken = value.isNotNull() & _rule(f.name, INPUT_RULES[f.name])
            found.append(("issue", "rule_broken", f.name, F.count_if(broken)))
    wide = df.agg(*[c.alias(f"cells_{i}") for i, (*_, c) in enumerate(found)])
    rows = [F.struct(F.lit(level).alias("level"), F.lit(check).alias("check"), F.lit(detail).alias("detail"),
                     F.col(f"cells_{i}").alias("cells")) for i, (level, check, detail, _) in enumerate(found)]
    schema = f"array<struct<{ISSUE_SCHEMA.replace(' string', ':string')},cells:bigint>>"
    return wide.select(F.inline(F.array(*rows).cast(schema.replace(", ", ",")))).where("cells > 0")


def null_report(df: DataFrame) -> DataFrame:
    """Columns of a batch with missing values."""
    return missing_table(df)


def score(df: DataFrame, model, expected: list[str], validate: bool = True,
          output: str = "prediction", keep: list[str] | None = None) -> DataFrame:
    """Predictions for a batch; an invalid one is refused, warnings are logged."""
    if model is None:
        raise ValueError("no model loaded")
    if validate:
        valid, _, issues = check_schema(df.drop(*(keep or [])), expected)
        if not valid:
            raise ValueError(f"input check failed: {[i for i in issues if i[0] == 'issue']}")
        for _, check, detail in issues:
            log.warning("%s: %s", check, detail)
    rows = df.select(*[col(c) for c in expected], *[col(c) for c in keep or []])
    return model.transform(rows, output)


def _rule(name: str, rule: dict) -> Column:
    value = col(name).try_cast("double")
    bad = value.isNull()
    low = F.lit(float(rule["low"]))
    bad = bad | ((value <= low) if rule.get("low_open") else (value < low))
    if "high" in rule:
        bad = bad | (value > F.lit(float(rule["high"])))
    return F.coalesce(bad, F.lit(True))


def check_rows(df: DataFrame, rules: dict[str, dict] | None = None) -> DataFrame:
    """Add the names of violated rules and whether the row passes all of them."""
    rules = {c: r for c, r in (rules or INPUT_RULES).items() if c in df.columns}
    failed = F.array_compact(F.array(*[F.when(_rule(c, r), F.lit(c)) for c, r in rules.items()]))
    return df.withColumn("violations", failed) \
        .withColumn("is_valid", F.size("violations") == 0)


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.filter("is_valid").drop("violations", "is_valid")


def bad_rows(checked: DataFrame) -> DataFrame:
    return checked.filter("not is_valid")


def price_per_area(df: DataFrame, prediction: str = "prediction", area: str = "sqft_living",
                   ) -> DataFrame:
    return df.withColumn("price_per_sqft", F.try_divide(col(prediction), col(area)))


# fixed values: serving-side size limits, and width and last bin of each serving-side bin
SERVING_SIZE_LIMITS = [1500, 2500, 4000]
SERVING_BINS = {
    "sqft_living_binned": ("sqft_living", 500, 9),
    "floors_binned": ("floors", 1, 3),
    "grade_binned": ("grade", 3, 4),
    "total_sqft_binned": ("total_sqft", 1000, 15),
    "quality_score_binned": ("quality_score", 5, 12),
    "sqft_per_bedroom_binned": ("sqft_per_bedroom", 200, 10),
}
# fixed values: feature order of the serving side
SERVING_FEATURES = ["sqft_living", "floors", "condition", "grade", "total_sqft", "quality_score",
                    "size_category_encoded", "sqft_per_bedroom", "sqft_living_binned",
                    "floors_binned", "grade_binned", "total_sqft_binned", "quality_score_binned",
                    "size_category_encoded_binned", "sqft_per_bedroom_binned"]


def serving_features(df: DataFrame) -> DataFrame:
    """Features as the entry form computes them, which differ from the training features."""
    size = F.lit(0)
    for limit in SERVING_SIZE_LIMITS:
        size = size + F.when(col("sqft_living") >= limit, 1).otherwise(0)
    base = df.withColumns({
        "total_sqft": col("sqft_living") + col("sqft_lot"),
        "quality_score": col("grade") * col("condition"),
        "sqft_per_bedroom": col("sqft_living") / F.greatest(col("bedrooms"), F.lit(1.0)),
        "size_category_encoded": size.cast("bigint"),
    })
    # conversion to a whole number cuts towards zero
    binned = {name: F.least((col(c) / F.lit(float(width))).cast("bigint"),
                            F.lit(last).cast("bigint"))
              for name, (c, width, last) in SERVING_BINS.items()}
    out = base.withColumns({**binned, "size_category_encoded_binned": F.col(
        "size_category_encoded")})
    return out.select(*[col(c) for c in SERVING_FEATURES])
