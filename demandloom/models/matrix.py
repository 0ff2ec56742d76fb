"""The model matrix as persistable pipeline stages, the same for training and scoring."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.categories import apply_categories, fit_categories
from ..operators.clean import model_columns
from ..spec import WEEKLY

FEATURES, CODE = "features", "_code"
# Stands in for a missing number; a flag column marks where it was put.
SENTINEL = -1.0
# Measures of the predicted week itself: only left out on request.
SAME_WEEK = (
    "gross_value", "net_value", "gross_profit", "discount", "taxes",
    "unit_price", "profit_margin", "discount_ratio",
)


@dataclass(frozen=True)
class MatrixPlan:
    """Input columns by the way they enter the feature vector."""

    plain: list[str] = field(default_factory=list)
    nullable: list[str] = field(default_factory=list)
    coded: list[str] = field(default_factory=list)

    @property
    def inputs(self) -> list[str]:
        return (self.plain + [f"{c}_filled" for c in self.nullable]
                + [f"{c}_missing" for c in self.nullable] + [f"{c}{CODE}" for c in self.coded])


def plan_matrix(df: DataFrame, target: str = WEEKLY.target, strict_features: bool = False) -> MatrixPlan:
    """Decide from one aggregate which numbers have gaps; every text is coded."""
    names = model_columns(df, target)
    if strict_features:
        names = [c for c in names if c not in SAME_WEEK]
    types = {f.name: f.dataType for f in df.schema.fields}
    numbers = [c for c in names if isinstance(types[c], T.NumericType)]
    texts = [c for c in names if isinstance(types[c], T.StringType)]
    found = {}
    if numbers:
        found = df.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c)
                         for c in numbers]).first().asDict()
    # Lags are absent at the start of any new series, whatever this frame holds.
    gaps = [c for c in numbers if found[c] or "_lag_" in c]
    return MatrixPlan(plain=[c for c in numbers if c not in gaps], nullable=gaps, coded=texts)


def fit_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """The dictionary of text columns: a code for every value, however many there are."""
    if columns:
        return fit_categories(df, columns)
    return df.sparkSession.createDataFrame([], "column_name string, value string, code int")


def add_codes(df: DataFrame, dictionary: DataFrame, columns: list[str]) -> DataFrame:
    """``<column>_code`` from the dictionary; the columns themselves stay as they are.

    Codes keep the order of the values; unseen values share the code of missing ones, or -1.
    """
    named = df.withColumns({f"_{c}": F.col(c) for c in columns}) if columns else df
    renamed = dictionary.withColumn("column_name", F.concat(F.lit("_"), "column_name"))
    coded = apply_categories(named, renamed, [f"_{c}" for c in columns], replace_unseen=False)
    return coded.withColumnsRenamed({f"_{c}_encoded": f"{c}{CODE}" for c in columns}).drop(
        *[f"_{c}" for c in columns])


def matrix_stages(plan: MatrixPlan) -> Pipeline:
    """Unfitted stages: flag and fill gaps, assemble the vector."""
    computed = []
    for c in plan.nullable:
        missing = f"(`{c}` is null or isnan(`{c}`))"
        computed.append(f"case when {missing} then {SENTINEL}D else double(`{c}`) end "
                        f"as `{c}_filled`")
        computed.append(f"double(int({missing})) as `{c}_missing`")
    stages = [SQLTransformer(statement=f"select *, {', '.join(computed)} from __THIS__")] \
        if computed else []
    stages.append(VectorAssembler(inputCols=plan.inputs, outputCol=FEATURES,
                                  handleInvalid="error"))
    return Pipeline(stages=stages)
