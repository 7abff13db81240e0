"""Tables derived from the given ones, defined once as SQL text that both engines read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.fixed_values import RAW_COLUMNS
from tablewright.operators import linear
from tablewright.session import stage


def _steps(h: str, values: list[float], limits: list[int]) -> str:
    """Value by the share of 100 that ``h`` falls into."""
    whens = " ".join(f"WHEN {h} < {c} THEN {v}" for v, c in zip(values[:-1], limits[:-1]))
    return f"CAST(CASE {whens} ELSE {values[-1]} END AS DOUBLE)"


_H = {
    "bedrooms": "(l_orderkey * 37 + l_linenumber * 11) % 100",
    "bathrooms": "(l_suppkey * 53 + l_linenumber * 29) % 100",
    "floors": "(l_partkey * 17 + p_size) % 100",
    "condition": "(l_orderkey * 61 + l_partkey) % 100",
    "grade": "(l_partkey * 73 + l_suppkey) % 100",
}
LISTING_COLUMNS = {
    "sqft_living": "CAST(least(greatest(floor(l_extendedprice / 20), 500), 5000) AS DOUBLE)",
    "bedrooms": _steps(_H["bedrooms"], [1, 2, 3, 4, 5, 6], [5, 20, 55, 85, 97, 100]),
    "bathrooms": _steps(_H["bathrooms"], [1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5],
                        [8, 20, 45, 65, 80, 90, 97, 100]),
    "age": "CAST(floor(CAST((l_partkey % 101) * (l_partkey % 101) * (l_partkey % 101) AS DOUBLE)"
           " / 10000) AS DOUBLE)",
    "sqft_lot": "CAST(1000 + (l_orderkey % 37) * (l_orderkey % 37) * (l_orderkey % 37) AS DOUBLE)",
    "floors": _steps(_H["floors"], [1, 1.5, 2, 2.5, 3], [40, 55, 85, 95, 100]),
    "condition": _steps(_H["condition"], [1, 2, 3, 4, 5], [5, 20, 70, 95, 100]),
    "grade": _steps(_H["grade"], list(range(1, 14)),
                    [2, 5, 10, 18, 30, 45, 65, 80, 90, 95, 98, 99, 100]),
}
KEYS = {
    "row_key": "(l_orderkey * 1000003 + l_partkey * 7919 + l_suppkey * 104729"
               " + l_linenumber * 15485863 + CAST(floor(l_extendedprice * 100) AS BIGINT)"
               " * 611953000003) % 4503599627370449",
    "mask_key": "l_orderkey * 7 + l_partkey * 13 + l_linenumber * 3",
    "copy_key": "l_orderkey % 25",
    "noise": "CAST((l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 1299709) % 200001"
             " - 100000 AS DOUBLE)",
}
PRICE = ("least(greatest(sqft_living * 150 + bedrooms * 15000 + bathrooms * 20000"
         " + (101 - age) * 2000 + sqft_lot * 2 + floors * 25000 + condition * 40000"
         " + grade * 30000 + noise, CAST(50000 AS DOUBLE)), CAST(2000000 AS DOUBLE))")


def _aliased(columns: dict[str, str]) -> list[str]:
    return [f"{e} AS {c}" for c, e in columns.items()]


def _holed(i: int, c: str) -> str:
    return f"CASE WHEN (mask_key + {7 * i}) % 20 < 3 THEN NULL ELSE {c} END AS {c}"


class Tables:
    """The given tables of one folder, and the derived ones as Spark DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def keyed(self) -> DataFrame:
        """Listings with their keys."""
        joined = self.read("lineitem").join(self.read("part"), F.expr("l_partkey = p_partkey"))
        parts = joined.selectExpr(*_aliased(KEYS), *_aliased(LISTING_COLUMNS))
        return parts.selectExpr("row_key", "mask_key", "copy_key", *LISTING_COLUMNS,
                                f"{PRICE} AS price")

    def listings(self, key: bool = False) -> DataFrame:
        return self.keyed().select(*(["row_key"] if key else []), *RAW_COLUMNS)

    def dirty(self, key: bool = False) -> DataFrame:
        """Listings with about 8 % copies, then about 15 % of the cells emptied."""
        rows = self.keyed()
        both = rows.unionByName(rows.filter("copy_key < 2"))
        return both.selectExpr(*(["row_key"] if key else []),
                               *[_holed(i, c) for i, c in enumerate(RAW_COLUMNS)])

    def predictions(self, feature: str = "sqft_living") -> DataFrame:
        """Price (``label``) and its whole-number estimate from one feature (``prediction``)."""
        rows = self.listings(key=True)
        model = linear.fit_linear(rows, [feature], "price")
        return rows.select("row_key", F.col("price").alias("label"),
                           F.round(model.expression(), 0).alias("prediction"))

    def scored(self) -> DataFrame:
        """The predictions as a stored table, for charts that read them several times."""
        return stage(self.predictions(), "scored")

    def scored_models(self) -> DataFrame:
        """Predictions of three one-feature models, told apart by ``model``."""
        parts = [self.predictions(f).withColumn("model", F.lit(f))
                 for f in ("sqft_living", "grade", "condition")]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])


COLUMN_LIST = ", ".join(RAW_COLUMNS)
_SQL = {
    "keyed": f"""SELECT row_key, mask_key, copy_key, {", ".join(LISTING_COLUMNS)}, {PRICE} AS price
        FROM (SELECT {", ".join(_aliased(KEYS))}, {", ".join(_aliased(LISTING_COLUMNS))}
              FROM lineitem JOIN part ON l_partkey = p_partkey)""",
    "listings": f"SELECT row_key, {COLUMN_LIST} FROM keyed",
    "dirty": f"""SELECT row_key, {", ".join(_holed(i, c) for i, c in enumerate(RAW_COLUMNS))}
        FROM (SELECT * FROM keyed UNION ALL SELECT * FROM keyed WHERE copy_key < 2)""",
    "predictions": """SELECT row_key, price AS label, round(i + s * sqft_living, 0) AS prediction
        FROM listings, (SELECT regr_slope(price, sqft_living) AS s,
                               regr_intercept(price, sqft_living) AS i FROM listings)""",
    "scored": " UNION ALL ".join(
        f"""SELECT row_key, price AS label, round(i + s * {c}, 0) AS prediction, '{c}' AS model
        FROM listings, (SELECT regr_slope(price, {c}) AS s,
                               regr_intercept(price, {c}) AS i FROM listings)"""
        for c in ("sqft_living", "grade", "condition")),
}
_NEEDS = {"keyed": [], "listings": ["keyed"], "dirty": ["keyed"],
          "predictions": ["keyed", "listings"], "scored": ["keyed", "listings"]}


def sql(body: str, *tables: str, extra: dict[str, str] | None = None) -> str:
    """``body`` with the derived tables it names, and further ones, in front of it."""
    wanted: list[str] = []
    for t in tables:
        for need in [*_NEEDS[t], t]:
            if need not in wanted:
                wanted.append(need)
    parts = [f"{t} AS MATERIALIZED ({_SQL[t]})" for t in wanted]
    parts += [f"{n} AS MATERIALIZED ({q})" for n, q in (extra or {}).items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
