"""Lazy stage frames over a test-data folder, shared by the registered queries."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rounding import half_away
from ..operators.clean import clean
from ..operators.features import CARD_AGG_COLUMNS, engineer_features, row_features
from ..operators.marts import drop_sentinel, rename_projection, stg_fraud
from ..operators.merge import merge_identity
from ..operators.model import fill_features, select_features, stratified_split
from ..schemas import AMOUNT, LABEL, MODEL_FEATURES, STG_RENAMES
from ..session import compile_wide_rows
from ..sources.adapter import load_sources
from .etl import card_statistics, identity_ids_unique

CARD_COLUMNS = {*CARD_AGG_COLUMNS, "amt_deviation_from_card_mean"}

class Stages:
    """Stage frames, each built when it is first asked for: a query builds only
    what it needs.  ``tx`` to ``narrow`` run no job; ``card_agg`` and what stands
    on it store the per-card statistics once for this object."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        compile_wide_rows(spark)
        self.spark, self.sf_dir = spark, sf_dir
        self.tx, self.idn = load_sources(spark, sf_dir)

    @cached_property
    def merged(self) -> DataFrame:
        return merge_identity(self.tx, self.idn)

    @cached_property
    def cleaned(self) -> DataFrame:
        return clean(self.merged)

    @cached_property
    def narrow(self) -> DataFrame:
        """The staging view without the per-card columns, for marts that read
        none: no statistics, no join on the card."""
        return rename_projection(drop_sentinel(row_features(self.cleaned), AMOUNT),
                                 [(a, b) for a, b in STG_RENAMES if a not in CARD_COLUMNS])

    @cached_property
    def card_agg(self) -> DataFrame:
        return card_statistics(self.tx, self.cleaned, self.idn, identity_unique=identity_ids_unique(self.idn))

    @cached_property
    def staging(self) -> DataFrame:
        return engineer_features(self.cleaned, self.card_agg)

    @cached_property
    def stg(self) -> DataFrame:
        return stg_fraud(self.staging)


def stages(spark: SparkSession, sf_dir: str) -> Stages:
    return Stages(spark, sf_dir)


def round6(df: DataFrame, *cols: str) -> DataFrame:
    """Transcendental results rounded to 6 dp for cross-engine comparison."""
    return df.withColumns({c: half_away(c, 6) for c in cols if c in df.columns})


def model_frame(staging: DataFrame, features: list[str] = MODEL_FEATURES) -> tuple[DataFrame, list[str]]:
    """Staging rows with the present features filled and a stratified split column."""
    present, _missing = select_features(staging, features)
    df = fill_features(staging.select("TransactionID", LABEL, *present), present)
    return stratified_split(df), present


def split_parts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col("split") == "train"), df.where(F.col("split") == "test")
