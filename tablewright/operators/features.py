"""Feature engineering: fitted on one table, applied to any other as column expressions."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from itertools import combinations, combinations_with_replacement, islice
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.fixed_values import (AGE_EDGES, AGE_LABELS, BIN_WIDENING, CONDITION_WEIGHT,
                                      GRADE_WEIGHT, INTERACTION_COLUMNS, LUXURY_CONDITION,
                                      LUXURY_GRADE, MAX_BINS, RATIO_EPSILON, SIZE_EDGES,
                                      SIZE_LABELS)
from tablewright.functions.binning import equal_edges, labelled, numbered, right_closed
from tablewright.functions.columns import col, numeric_columns, one_row
from tablewright.functions.encode import fit_codes
from tablewright.session import compiled

CATEGORIES = {
    "age_category": ("age", AGE_EDGES, AGE_LABELS),
    "size_category": ("sqft_living", SIZE_EDGES, SIZE_LABELS),
}


def _per(top: str, bottom: str) -> Column:
    return F.try_divide(col(top), col(bottom) + F.lit(RATIO_EPSILON))


def _luxury() -> Column:
    both = (col("grade") >= LUXURY_GRADE) & (col("condition") >= LUXURY_CONDITION)
    return F.coalesce(both, F.lit(False)).cast("bigint")


def category(name: str) -> Column:
    source, edges, labels = CATEGORIES[name]
    return labelled(col(source), edges, labels)


def _coded(name: str):
    """Code of the category, straight from the cut points; a label not seen in fitting is NULL."""
    source, edges, labels = CATEGORIES[name]

    def build(codes: dict[str, list[str]]) -> Column:
        rank = {label: i for i, label in enumerate(codes[name])}

        def literal(label: str) -> Column:
            return F.lit(rank.get(label)).cast("bigint")

        inside = (col(source) > edges[0]) & (col(source) <= edges[-1])
        return F.when(inside, right_closed(col(source), edges, [literal(x) for x in labels])) \
            .otherwise(literal("nan"))

    return build


# new column -> columns it needs, expression given the fitted label codes
DOMAIN = {
    "price_per_sqft": (["price", "sqft_living"],
                       lambda _: F.try_divide(col("price"), col("sqft_living"))),
    "total_sqft": (["sqft_living", "sqft_lot"], lambda _: col("sqft_living") + col("sqft_lot")),
    "bedrooms_to_bathrooms": (["bedrooms", "bathrooms"], lambda _: _per("bedrooms", "bathrooms")),
    "living_lot_ratio": (["sqft_living", "sqft_lot"], lambda _: _per("sqft_living", "sqft_lot")),
    "age_category": (["age"], lambda _: category("age_category")),
    "age_category_encoded": (["age"], _coded("age_category")),
    "quality_score": (["condition", "grade"],
                      lambda _: col("condition") * F.lit(CONDITION_WEIGHT)
                      + col("grade") * F.lit(GRADE_WEIGHT)),
    "size_category": (["sqft_living"], lambda _: category("size_category")),
    "size_category_encoded": (["sqft_living"], _coded("size_category")),
    "is_luxury": (["grade", "condition"], lambda _: _luxury()),
    "sqft_per_bedroom": (["sqft_living", "bedrooms"], lambda _: _per("sqft_living", "bedrooms")),
}


def leaky(target: str) -> list[str]:
    """Domain columns made from the target; a row to score has none of them."""
    return [c for c, (needs, _) in DOMAIN.items() if target in needs]


def fit_categories(df: DataFrame) -> dict[str, list[str]]:
    """Labels in use per category; their sorted order gives the codes."""
    names = [c for c, (source, _, _) in CATEGORIES.items() if source in df.columns]
    if not names:
        return {}
    return fit_codes(df, {c: category(c) for c in names}, {c: CATEGORIES[c][2] for c in names})


def add_domain(df: DataFrame, codes: dict[str, list[str]], only: list[str] | None = None,
               without: str | None = None) -> DataFrame:
    """Domain columns whose inputs the table has, in one projection; none made from ``without``."""
    new = {c: build(codes) for c, (needs, build) in DOMAIN.items()
           if set(needs) <= set(df.columns) and (only is None or c in only)
           and without not in needs}
    return df.withColumns(new)


def interactions(columns: list[str], limit: int = 5, without: str | None = None,
                 ) -> dict[str, Column]:
    present = [c for c in INTERACTION_COLUMNS if c in columns and c != without]
    return {f"{a}_x_{b}": col(a) * col(b) for a, b in islice(combinations(present, 2), limit)}


def add_interactions(df: DataFrame, limit: int = 5, without: str | None = None) -> DataFrame:
    return df.withColumns(interactions(df.columns, limit, without))


def add_polynomial(df: DataFrame, degree: int = 2, target: str = "price", limit: int = 5,
                   ) -> DataFrame:
    """All products of 2..degree of the first numeric columns, named ``a^2`` and ``a b``."""
    base = numeric_columns(df, [target])[:limit]
    new = {}
    for size in range(2, degree + 1):
        for term in combinations_with_replacement(base, size):
            powers = {c: term.count(c) for c in term}
            name = " ".join(c if p == 1 else f"{c}^{p}" for c, p in powers.items())
            new[name] = prod([col(c).cast("double") for c in term[1:]],
                             start=col(term[0]).cast("double"))
    return df.withColumns(new)


def fit_bins(df: DataFrame, columns: list[str], max_bins: int = MAX_BINS) -> dict[str, list[float]]:
    """Equal-width, right-closed edges per column; the lowest edge is widened a little.

    The bin count is at most the number of distinct values. A few rows usually show enough of
    them, or all of them; the pass that finds the extremes also looks for a value not seen yet,
    and is repeated only for columns where a new one turned up and is still one of few.
    """
    rows = df.select(*[col(c) for c in columns]).take(200)
    known = {c: {r[i] for r in rows} - {None} for i, c in enumerate(columns)}

    def unseen(c: str) -> Column:
        value = col(c)
        return F.min(F.when(~value.isin(list(known[c])), value) if known[c] else value)

    open_ = [c for c in columns if len(known[c]) < max_bins]
    flat = one_row(df, [*[f(col(c).cast("double")) for c in columns for f in (F.min, F.max)],
                        *[unseen(c) for c in open_]])
    ends = {c: (flat[2 * i], flat[2 * i + 1]) for i, c in enumerate(columns)}
    found = flat[2 * len(columns):]
    while open_:
        for c, value in zip(open_, found):
            known[c].add(value)
        open_ = [c for c, v in zip(open_, found) if v is not None and len(known[c]) < max_bins]
        found = one_row(df, [unseen(c) for c in open_])
    edges = {}
    for c, (low, high) in ends.items():
        bins = min(max_bins, len(known[c] - {None}))
        if bins > 1:
            cuts = equal_edges(low, high, bins)
            edges[c] = [cuts[0] - (high - low) * BIN_WIDENING, *cuts[1:]]
    return edges


def add_bins(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    return df.withColumns({f"{c}_binned": numbered(col(c), e) for c, e in edges.items()})


def split_target(df: DataFrame, target: str) -> tuple[list[str], str]:
    """Numeric feature names and the target; an absent target is an error."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} is not in the table")
    return numeric_columns(df, [target]), target


@dataclass
class FeaturePlan:
    """Everything learned from the training table; serving uses the same numbers."""

    target: str = "price"
    domain: bool = True
    interactions: bool = True
    polynomial: bool = False
    binned: bool = True
    degree: int = 2
    exclude_leaky: bool = True
    codes: dict[str, list[str]] = field(default_factory=dict)
    bins: dict[str, list[float]] = field(default_factory=dict)
    fills: dict[str, float] = field(default_factory=dict)
    features: list[str] = field(default_factory=list)
    candidates: int = 0
    engineered: int = 0

    def widen(self, df: DataFrame) -> DataFrame:
        """All columns before filling and selection, as far as ``df`` has what they need."""
        compiled(df.sparkSession)
        without = self.target if self.exclude_leaky else None
        if self.domain:
            df = add_domain(df, self.codes, without=without)
        if self.interactions:
            df = add_interactions(df, without=without)
        if self.polynomial:
            df = add_polynomial(df, self.degree, self.target)
        return add_bins(df, {c: e for c, e in self.bins.items() if c in df.columns})

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Selected features with gaps filled, plus the target and ``keep`` where present."""
        wide = self.widen(df)
        absent = [c for c in self.features if c not in wide.columns]
        if absent:
            raise ValueError(f"the table lacks what these features are made of: {absent}")
        extra = [c for c in [*(keep or []), self.target] if c in df.columns]
        filled = [F.coalesce(col(c).cast("double"), F.lit(self.fills.get(c))).alias(c)
                  for c in self.features]
        return wide.select(*filled, *[col(c) for c in extra if c not in self.features])

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> FeaturePlan:
        return cls(**json.loads(text))


def fit_features(df: DataFrame, target: str = "price", domain: bool = True,
                 with_interactions: bool = True, polynomial: bool = False, binned: bool = True,
                 degree: int = 2, exclude: list[str] | tuple[str, ...] = (),
                 exclude_leaky: bool = True) -> FeaturePlan:
    """Learn codes, bin edges and fill values; all numeric columns are features at first.

    Columns made from the target, and bins of them, are left out unless ``exclude_leaky`` is off;
    a plan that selects such a column cannot score rows without the target.
    """
    plan = FeaturePlan(target, domain, with_interactions, polynomial, binned, degree, exclude_leaky)
    plan.codes = fit_categories(df) if domain else {}
    wide = plan.widen(df)
    names, _ = split_target(wide, target)
    if binned:
        plan.bins = fit_bins(wide, names)
        wide = plan.widen(df)
        names, _ = split_target(wide, target)
    plan.engineered = len([c for c in wide.columns if c not in df.columns
                           and c not in CATEGORIES])
    plan.candidates = len(wide.columns) - 1
    plan.features = [c for c in names if c not in exclude]
    means = one_row(wide, [F.avg(col(c).cast("double")) for c in plan.features])
    plan.fills = dict(zip(plan.features, means))
    return plan


def feature_report(plan: FeaturePlan, df: DataFrame, raw_columns: int, method: str | None,
                   top: list[str], pca: bool = False, final: int | None = None) -> DataFrame:
    """One row that sums up a feature job run on ``df``."""
    return df.agg(F.count(F.lit(1)).alias("final_rows")).withColumns({
        "raw_features": F.lit(raw_columns).cast("bigint"),
        "original_features": F.lit(plan.candidates).cast("bigint"),
        "engineered_features_created": F.lit(plan.engineered).cast("bigint"),
        "final_features": F.lit(len(plan.features) if final is None else final).cast("bigint"),
        "feature_selection_method": F.lit(method).cast("string"),
        "selected_features": F.lit(",".join(plan.features)),
        "top_features": F.lit(",".join(top)),
        "pca_applied": F.lit(pca),
    })
