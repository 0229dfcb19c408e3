"""Shared Spark building blocks of the registered queries, plus the registry."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.features import FeatureFit, main_clean
from ..operators.fitting import fit_repair_and_features
from ..operators.repair import OutlierFit, handle_outliers, repair_by_address, repair_by_district
from ..session import checkpoint_dir, prepare
from ..sources.incidents import incidents, test_rows, train_rows


@dataclass
class QuerySpec:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


REGISTRY: dict[str, QuerySpec] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = QuerySpec(name, fn, sql)
        return fn
    return deco


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns (the oracle rounds the same columns the same way)."""
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def staging_dir(spark: SparkSession, what: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp dir)."""
    return os.path.join(checkpoint_dir(spark), "staging", f"{what}-{uuid.uuid4().hex[:12]}")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return incidents(spark, sf_dir)


def repaired(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, OutlierFit]:
    """Train rows (Descript/Resolution dropped) and test rows, both repaired; means fitted on train."""
    df = raw(spark, sf_dir)
    tr, ofit = handle_outliers(train_rows(df).drop("Descript", "Resolution"))
    te, _ = handle_outliers(test_rows(df), ofit)
    return tr, te, ofit


def featured(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, FeatureFit]:
    """Train (Id, Category, 37 features) and test (Id, 37 features); fits on train only.

    The repair and feature fits come from one fused aggregate over pass-1 output.
    """
    df = raw(spark, sf_dir)
    passed = repair_by_address(train_rows(df).drop("Descript", "Resolution"))
    ofit, ffit = fit_repair_and_features(passed)
    tr = repair_by_district(passed, ofit)
    te, _ = handle_outliers(test_rows(df), ofit)
    ftr, _ = main_clean(tr, ffit)
    fte, _ = main_clean(te, ffit)
    return ftr, fte, ffit
