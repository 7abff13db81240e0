"""Feature engineering and selection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.clean_queries import FEATURES, SEQUENCE
from catalog.fixtures import COLUMN_LIST, sql
from catalog.registry import query, rounded
from tablewright.fixed_values import (AGE_EDGES, AGE_LABELS, INTERACTION_COLUMNS, RAW_COLUMNS,
                                      SIZE_EDGES, SIZE_LABELS)
from tablewright.functions.encode import label_encode
from tablewright.operators import features, select, split
from tablewright.plans import jobs


def cut_sql(column: str, edges: list, labels: list[str]) -> str:
    whens = " ".join(f"WHEN {column} <= {e} THEN '{x}'" for e, x in zip(edges[1:], labels))
    return f"CASE WHEN {column} > {edges[0]} THEN CASE {whens} END END"


AGE = cut_sql("age", AGE_EDGES, AGE_LABELS)
SIZE = cut_sql("sqft_living", SIZE_EDGES, SIZE_LABELS)


def code_sql(label: str, table: str) -> str:
    """Rank of a label among the sorted labels in use."""
    return (f"(SELECT count(DISTINCT coalesce({label}, 'nan')) FROM {table} AS u WHERE"
            f" coalesce({label}, 'nan') < o.lab)")


EPS = "CAST(1e-8 AS DOUBLE)"
PLAIN = {
    "price_per_sqft": "price / NULLIF(sqft_living, 0)",
    "total_sqft": "sqft_living + sqft_lot",
    "bedrooms_to_bathrooms": f"bedrooms / (bathrooms + {EPS})",
    "living_lot_ratio": f"sqft_living / (sqft_lot + {EPS})",
    "quality_score": "condition * CAST(0.3 AS DOUBLE) + grade * CAST(0.7 AS DOUBLE)",
    "is_luxury": "CAST(CASE WHEN grade >= 10 AND condition >= 4 THEN 1 ELSE 0 END AS BIGINT)",
    "sqft_per_bedroom": f"sqft_living / (bedrooms + {EPS})",
}
NAMES = {"f_price_per_sqft": "price_per_sqft", "f_total": "total_sqft",
         "f_bed_bath": "bedrooms_to_bathrooms", "f_living_lot": "living_lot_ratio",
         "f_quality": "quality_score", "f_luxury": "is_luxury", "f_sqft_bed": "sqft_per_bedroom",
         "f_age_cat": "age_category", "f_size_cat": "size_category"}


def one_feature(column: str):
    def build(t):
        df = features.add_domain(t.dirty(key=True), {}, [column])
        return rounded(df.select("row_key", column))

    return build


for _name, _column in NAMES.items():
    _expr = {"age_category": AGE, "size_category": SIZE}.get(_column) or PLAIN[_column]
    _out = f"round({_expr}, 6)" if _column in PLAIN and _column != "is_luxury" else _expr
    query(_name, sql(f"SELECT row_key, {_out} AS {_column} FROM dirty", "dirty"))(
        one_feature(_column))


def coded_sql(label: str, output: str) -> str:
    return sql(
        f"SELECT o.row_key, o.{output}_label, r.code AS {output}_encoded FROM (SELECT row_key,"
        f" {label} AS {output}_label, coalesce({label}, 'nan') AS lab FROM dirty) AS o JOIN"
        f" (SELECT lab, dense_rank() OVER (ORDER BY lab) - 1 AS code FROM (SELECT DISTINCT"
        f" coalesce({label}, 'nan') AS lab FROM dirty)) AS r ON o.lab = r.lab", "dirty")


@query("f_age_code", coded_sql(AGE, "age_category"))
def _(t):
    dirty = t.dirty(key=True)
    codes = features.fit_categories(dirty)
    df = features.add_domain(dirty, codes, ["age_category", "age_category_encoded"])
    return df.select("row_key", F.col("age_category").alias("age_category_label"),
                     "age_category_encoded")


@query("f_size_code", coded_sql(SIZE, "size_category"))
def _(t):
    dirty = t.dirty(key=True)
    codes = features.fit_categories(dirty)
    df = features.add_domain(dirty, codes, ["size_category", "size_category_encoded"])
    return df.select("row_key", F.col("size_category").alias("size_category_label"),
                     "size_category_encoded")


@query("f_label_encode",
       "SELECT p_partkey, p_type, code AS p_type_encoded FROM (SELECT p_partkey, p_type, CASE WHEN"
       " p_partkey % 7 = 0 THEN 'nan' ELSE p_type END AS lab FROM part) JOIN (SELECT lab,"
       " dense_rank() OVER (ORDER BY lab) - 1 AS code FROM (SELECT DISTINCT CASE WHEN p_partkey"
       " % 7 = 0 THEN 'nan' ELSE p_type END AS lab FROM part)) USING (lab)")
def _(t):
    """Codes of a free text column; missing text is a label of its own."""
    part = t.read("part").selectExpr(
        "p_partkey", "p_type", "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type END AS lab")
    return label_encode(part, "lab", "p_type_encoded").drop("lab")


PAIRS = [(a, b) for i, a in enumerate(INTERACTION_COLUMNS) for b in INTERACTION_COLUMNS[i + 1:]][:5]


@query("f_interactions", sql("SELECT row_key, " + ", ".join(
    f"{a} * {b} AS {a}_x_{b}" for a, b in PAIRS) + " FROM dirty", "dirty"))
def _(t):
    df = features.add_interactions(t.dirty(key=True))
    return df.select("row_key", *[f"{a}_x_{b}" for a, b in PAIRS])


POLY = FEATURES[:5]


@query("f_poly", sql("SELECT row_key, " + ", ".join(
    f'round({a} * {b}, 6) AS "{a}^2"' if a == b else f'round({a} * {b}, 6) AS "{a} {b}"'
    for i, a in enumerate(POLY) for b in POLY[i:]) + " FROM dirty", "dirty"))
def _(t):
    dirty = t.dirty(key=True)
    df = features.add_polynomial(dirty.drop("row_key"), 2)
    added = [c for c in df.columns if c not in RAW_COLUMNS]
    df = features.add_polynomial(dirty.select(*RAW_COLUMNS, "row_key"), 2)
    return rounded(df.select("row_key", *[f"`{c}`" for c in added]))


def bins_stats_sql(table: str, columns: list[str]) -> str:
    return "SELECT " + ", ".join(
        f"min({c}) AS lo_{c}, max({c}) AS hi_{c}, least(5, count(DISTINCT {c})) AS n_{c}"
        for c in columns) + f" FROM {table}"


def bin_sql(c: str) -> str:
    hits = " + ".join(f"CASE WHEN {i} < n_{c} AND {c} > {i} * ((hi_{c} - lo_{c}) / n_{c}) + lo_{c}"
                      " THEN 1 ELSE 0 END" for i in range(1, 5))
    return f"CASE WHEN {c} IS NOT NULL THEN CAST({hits} AS BIGINT) END"


@query("f_binned", sql("SELECT row_key, " + ", ".join(
    f"{bin_sql(c)} AS {c}_binned" for c in FEATURES) + f" FROM dirty, ({bins_stats_sql('dirty', FEATURES)})",
    "dirty"))
def _(t):
    dirty = t.dirty(key=True).withColumn("steady", F.lit(5.0))
    df = features.add_bins(dirty, features.fit_bins(dirty, [*FEATURES, "steady"]))
    return df.select("row_key", *[c for c in df.columns if c.endswith("_binned")])


@query("f_numeric_only", sql(f"SELECT {', '.join(FEATURES)} FROM dirty", "dirty"))
def _(t):
    wide = t.dirty().withColumn("note", F.lit("text"))
    names, _ = features.split_target(wide, "price")
    return wide.select(*names)


AVERAGES = "(SELECT " + ", ".join(f"avg({c}) AS mean_{c}" for c in RAW_COLUMNS) + " FROM dirty)"


@query("f_fill", sql("SELECT row_key, " + ", ".join(
    f"round(coalesce({c}, mean_{c}), 6) AS {c}" for c in FEATURES)
    + f", price FROM dirty, {AVERAGES}", "dirty"))
def _(t):
    plan = features.fit_features(t.dirty(), domain=False, with_interactions=False, binned=False)
    return rounded(plan.transform(t.dirty(key=True), keep=["row_key"]))


# ---- scores on all plain engineered columns ---------------------------------------------------

WIDE = [*FEATURES, *PLAIN]
WIDE_SQL = {"wide": f"SELECT row_key, {COLUMN_LIST}, 5.0e0 AS steady, " + ", ".join(
    f"CAST({e} AS DOUBLE) AS {c}" for c, e in PLAIN.items()) + " FROM listings"}
SCORED = [*WIDE, "steady"]


def wide(t):
    df = features.add_domain(t.listings(key=True), {}, list(PLAIN)) \
        .withColumn("steady", F.lit(5.0))
    return df.select("row_key", *SCORED, "price")


def f_score_sql(c: str) -> str:
    r2 = f"(power(covar_pop({c}, price), 2) / NULLIF(var_pop({c}) * var_pop(price), 0))"
    return f"coalesce({r2} / (1 - {r2}) * (count(*) - 2), 0)"


SCORES_SQL = {**WIDE_SQL, "scores": " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({i} AS BIGINT) AS position, {f_score_sql(c)} AS score FROM wide"
    for i, c in enumerate(SCORED))}


@query("f_fscore", sql("SELECT feature, position, round(score, 3) AS score FROM scores",
                       "listings", extra=SCORES_SQL))
def _(t):
    return rounded(select.f_scores(wide(t), SCORED, "price"), 3)


@query("f_top10", sql("SELECT feature, position, round(score, 3) AS score FROM scores ORDER BY"
                      " scores.score DESC, position LIMIT 10", "listings", extra=SCORES_SQL))
def _(t):
    return rounded(select.top(select.f_scores(wide(t), SCORED, "price"), 10), 3)


@query("f_kbest", sql(
    "SELECT feature, position, round(score, 3) AS score FROM scores ORDER BY scores.score DESC,"
    " position DESC LIMIT 6", "listings", extra=SCORES_SQL))
def _(t):
    return rounded(select.k_best(select.f_scores(wide(t), SCORED, "price"), 6), 3)


@query("f_threshold", sql(
    "SELECT feature, position, round(score, 3) AS score FROM scores WHERE scores.score >="
    " (SELECT quantile_cont(s2.score, 0.7) FROM scores AS s2)", "listings", extra=SCORES_SQL))
def _(t):
    return rounded(select.above_percentile(select.f_scores(wide(t), SCORED, "price")), 3)


def mi_bin_sql(c: str, bins: int = 20) -> str:
    """Left-closed bin number; the guess is corrected against the edges it stands for."""
    step = f"((hi_{c} - lo_{c}) / {bins})"
    guess = (f"least(floor(({c} - lo_{c}) / (hi_{c} - lo_{c}) * {bins}), {bins - 1})")
    return (f"CASE WHEN hi_{c} = lo_{c} THEN 0 ELSE {guess}"
            f" - CASE WHEN {c} < {guess} * {step} + lo_{c} THEN 1 ELSE 0 END"
            f" + CASE WHEN {guess} < {bins - 1} AND {c} >= ({guess} + 1) * {step} + lo_{c}"
            " THEN 1 ELSE 0 END END")


MI_SQL = {
    **WIDE_SQL,
    "mib": "SELECT " + ", ".join(f"{mi_bin_sql(c)} AS b_{c}" for c in [*SCORED, "price"])
           + " FROM wide, (SELECT " + ", ".join(
               f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in [*SCORED, "price"])
           + " FROM wide)",
    "joint": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({i} AS BIGINT) AS position, b_{c} AS bx, b_price AS b_y,"
        f" count(*) AS n FROM mib GROUP BY b_{c}, b_price" for i, c in enumerate(SCORED)),
    "margins": "SELECT *, sum(n) OVER (PARTITION BY feature) AS total, sum(n) OVER (PARTITION BY"
               " feature, bx) AS nx, sum(n) OVER (PARTITION BY feature, b_y) AS ny FROM joint",
}


@query("f_mi", sql(
    "SELECT feature, position, round(greatest(sum(CAST(n AS DOUBLE) / total * ln(CAST(n AS DOUBLE)"
    " * total / (CAST(nx AS DOUBLE) * ny))), 0), 6) AS score FROM margins GROUP BY feature,"
    " position", "listings", extra=MI_SQL))
def _(t):
    return rounded(select.mutual_info(wide(t), SCORED, "price"))


@query("f_rf")
def _(t):
    return select.forest_scores(wide(t), SCORED, "price", trees=100, depth=10)


@query("f_rfe")
def _(t):
    left = select.eliminate(wide(t), FEATURES, "price", 5, trees=50)
    return wide(t).select("row_key", *left, "price")


PCA2 = ["sqft_living", "sqft_lot"]


@query("f_pca2", sql(
    "SELECT row_key, round(w1 * (sqft_living - m1) + w2 * (sqft_lot - m2), 3) AS \"PC_1\" FROM"
    " listings, (SELECT m1, m2, CASE WHEN abs(u1) >= abs(u2) THEN sign(u1) ELSE sign(u2) END * u1"
    " / sqrt(u1 * u1 + u2 * u2) AS w1, CASE WHEN abs(u1) >= abs(u2) THEN sign(u1) ELSE sign(u2) END"
    " * u2 / sqrt(u1 * u1 + u2 * u2) AS w2 FROM (SELECT m1, m2, lam - d AS u1, b AS u2 FROM (SELECT"
    " *, (a + d) / 2 + sqrt((a - d) * (a - d) / 4 + b * b) AS lam FROM (SELECT avg(sqft_living) AS"
    " m1, avg(sqft_lot) AS m2, var_samp(sqft_living) AS a, var_samp(sqft_lot) AS d,"
    " covar_samp(sqft_living, sqft_lot) AS b FROM listings))))", "listings"))
def _(t):
    """First of two components, whose direction has a closed form."""
    df = t.listings(key=True)
    return rounded(select.fit_components(df, PCA2, 1).transform(df, ["row_key"]), 3)


@query("f_pca")
def _(t):
    df = t.listings(key=True)
    return select.fit_components(df, FEATURES, 0.95).transform(df, ["row_key", "price"])


# ---- whole feature job ------------------------------------------------------------------------

CODED = {"age_category": AGE, "size_category": SIZE}
CODES = {f"codes_{c}": f"SELECT lab, dense_rank() OVER (ORDER BY lab) - 1 AS code FROM (SELECT"
                       f" DISTINCT coalesce({e}, 'nan') AS lab FROM {{src}})"
         for c, e in CODED.items()}
DOMAIN_ORDER = ["price_per_sqft", "total_sqft", "bedrooms_to_bathrooms", "living_lot_ratio",
                "age_category_encoded", "quality_score", "size_category_encoded", "is_luxury",
                "sqft_per_bedroom"]


def engineered_sql(source: str) -> dict[str, str]:
    """CTEs: codes, all unbinned columns, and the table with its binned columns."""
    out = {k: v.format(src=source) for k, v in CODES.items()}
    cells = []
    for c in DOMAIN_ORDER:
        if c in PLAIN:
            cells.append(f"{PLAIN[c]} AS {c}")
        else:
            base = c.removesuffix("_encoded")
            cells.append(f"(SELECT code FROM codes_{base} WHERE lab = coalesce({CODED[base]},"
                         f" 'nan')) AS {c}")
    pairs = [f"{a}_x_{b}" for a, b in PAIRS]
    out["unbinned"] = f"SELECT {COLUMN_LIST}, {', '.join(cells)}, " + ", ".join(
        f"{a} * {b} AS {a}_x_{b}" for a, b in PAIRS) + f" FROM {source}"
    names = [c for c in [*FEATURES, *DOMAIN_ORDER, *pairs]]
    out["engineered"] = f"SELECT {', '.join([*names, 'price'])}, " + ", ".join(
        f"{bin_sql(c)} AS {c}_binned" for c in names) \
        + f" FROM unbinned, ({bins_stats_sql('unbinned', names)})"
    return out


ALL = [*FEATURES, *DOMAIN_ORDER, *[f"{a}_x_{b}" for a, b in PAIRS]]
# the luxury flag may be constant after cleaning and then has no bins
ALL = [*ALL, *[f"{c}_binned" for c in ALL if c != "is_luxury"]]


# what a row without the target can have too
SAFE = [c for c in ALL if not c.startswith("price_per_sqft")]


@query("f_engineered", sql("SELECT " + ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}"
                                                for c in [*ALL, "price"]) + " FROM engineered",
                           "dirty", extra={**SEQUENCE, **engineered_sql("kept7")}))
def _(t):
    """All features of the cleaned table before selection."""
    done = jobs.feature_job(jobs.clean_job(t.dirty()).table, method=None, exclude_leaky=False)
    return rounded(done.table.select(*[F.col(c).cast("double") for c in ALL], "price"))


@query("f_pipeline")
def _(t):
    """Clean, engineer and keep the 15 best features."""
    return jobs.feature_job(jobs.clean_job(t.dirty()).table).table


@query("f_pipeline_selected", sql(
    "SELECT feature FROM (SELECT * FROM sc ORDER BY score DESC, position DESC LIMIT 15)", "dirty",
    extra={**SEQUENCE, **engineered_sql("kept7"), "sc": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {i} AS position, "
        + f_score_sql(f"CAST({c} AS DOUBLE)") + " AS score FROM engineered"
        for i, c in enumerate(SAFE))}))
def _(t):
    """Names of the selected features, scored over the engineered table."""
    done = jobs.feature_job(jobs.clean_job(t.dirty()).table)
    return t.spark.createDataFrame([(c,) for c in done.plan.features], "feature string")


@query("f_report", sql(
    "SELECT count(*) AS final_rows, CAST(8 AS BIGINT) AS raw_features, CAST(44 + least(2,"
    " count(DISTINCT is_luxury)) AS BIGINT) AS original_features, CAST(34 + least(2,"
    " count(DISTINCT is_luxury)) AS BIGINT) AS engineered_features_created, CAST(15 AS BIGINT) AS"
    " final_features, 'k_best' AS feature_selection_method, false AS pca_applied FROM unbinned",
    "dirty", extra={**SEQUENCE, **engineered_sql("kept7")}))
def _(t):
    done = jobs.feature_job(jobs.clean_job(t.dirty()).table, exclude_leaky=False)
    return done.report.drop("selected_features", "top_features")


@query("m_prepare", sql("SELECT " + ", ".join(
    f"round(coalesce({c}, mean_{c}), 6) AS {c}" for c in RAW_COLUMNS)
    + f" FROM dirty, {AVERAGES}", "dirty"))
def _(t):
    return rounded(split.prepare(t.dirty().withColumn("note", F.lit("text"))))
