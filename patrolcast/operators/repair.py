"""Coordinate repair (bounds mask, repair by address, repair by district mean).

Plan shape, chosen for very large inputs:

* pass 1 only moves the out-of-bounds rows through a shuffle. The per-address
  replacement table is a partial+final hash aggregate over in-bounds rows
  (map-side combine, so a hot address costs one row per map task), and only the
  outlier rows are joined to it; in-bounds rows bypass the join and are
  unioned back. AQE picks broadcast vs sort-merge at runtime from the real
  size of the replacement table and splits skewed outlier partitions.
* pass 2 is a pure projection: the district means are a fitted, collected
  (size-checked) map literal, so no join and no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import MAX_X, MAX_Y, MIN_X, MIN_Y

# Upper bound on distinct districts collected as fitted state.
MAX_DISTRICTS = 100_000
# Largest set of outlier addresses that is broadcast to filter rows map-side.
MAX_BROADCAST_ADDRESSES = 2_000_000


def out_of_bounds(x="X", y="Y") -> Column:
    """True when a coordinate lies outside the city box (bounds inclusive = inside).

    NULL (or NaN turned NULL at read) is not an outlier.
    """
    x, y = F.col(x), F.col(y)
    outside = (x < MIN_X) | (x > MAX_X) | (y < MIN_Y) | (y > MAX_Y)
    return F.coalesce(outside, F.lit(False))


def conditional_update(df: DataFrame, mask: Column, values: dict[str, Column]) -> DataFrame:
    """Overwrite columns where ``mask`` holds."""
    return df.withColumns({c: F.when(mask, v).otherwise(F.col(c)) for c, v in values.items()})


def address_replacements(df: DataFrame) -> DataFrame:
    """Per address, the coordinates of its in-bounds row with the lowest ``Id`` (D2 intent).

    When the distinct outlier addresses are few (counted first, bounded by
    ``MAX_BROADCAST_ADDRESSES``) they are broadcast and the optimizer applies
    the semi join map-side, before the aggregate, so only rows of those
    addresses are aggregated. Otherwise the aggregate runs over every in-bounds
    address (map-side combine: one row per address per task) and the later
    left join keeps only what outliers need; in-bounds rows are never shuffled
    raw.
    """
    inb = df.filter(~out_of_bounds() & F.col("Address").isNotNull())
    outlier_addr = df.filter(out_of_bounds() & F.col("Address").isNotNull()).select("Address").distinct()
    n_addr = outlier_addr.limit(MAX_BROADCAST_ADDRESSES + 1).count()
    if n_addr <= MAX_BROADCAST_ADDRESSES:
        inb = inb.join(F.broadcast(outlier_addr), "Address", "left_semi")
    # two scalar min_by keep fixed-width buffers -> partial/final HashAggregate
    # (a struct buffer would force a sort-based aggregate); Id is unique, so
    # both pick the same row.
    return inb.groupBy("Address").agg(F.min_by("X", "Id").alias("_fx"), F.min_by("Y", "Id").alias("_fy"))


def repair_by_address(df: DataFrame) -> DataFrame:
    """Pass 1: an outlier takes the coordinates of an in-bounds row with the same address."""
    cols = df.columns
    fix = address_replacements(df)
    outliers = df.filter(out_of_bounds()).join(fix, "Address", "left")
    fixed = outliers.select(*[
        F.coalesce(F.col("_fx"), F.col("X")).alias("X") if c == "X" else
        F.coalesce(F.col("_fy"), F.col("Y")).alias("Y") if c == "Y" else F.col(c)
        for c in cols])
    return df.filter(~out_of_bounds()).unionByName(fixed)


def district_means(df: DataFrame) -> DataFrame:
    """Mean X, Y per district over in-bounds rows; NULL district dropped."""
    return (df.filter(~out_of_bounds() & F.col("PdDistrict").isNotNull())
            .groupBy("PdDistrict").agg(F.avg("X").alias("X"), F.avg("Y").alias("Y")))


@dataclass
class OutlierFit:
    """Fitted state of the repair: district -> (mean X, mean Y), from train rows only."""
    means: dict = field(default_factory=dict)

    @classmethod
    def fit(cls, repaired_train: DataFrame) -> "OutlierFit":
        rows = district_means(repaired_train).limit(MAX_DISTRICTS + 1).collect()
        if len(rows) > MAX_DISTRICTS:
            raise ValueError("too many districts to hold as fitted state")
        return cls({r["PdDistrict"]: (r["X"], r["Y"]) for r in rows})

    def as_dataframe(self, spark) -> DataFrame:
        data = [(k, v[0], v[1]) for k, v in sorted(self.means.items())]
        return spark.createDataFrame(data, "PdDistrict string, X double, Y double")


def _map_literal(d: dict) -> Column:
    if not d:
        return F.create_map().cast("map<string,double>")
    kv = []
    for k, v in sorted(d.items()):
        kv += [F.lit(k), F.lit(float(v))]
    return F.create_map(*kv)


def repair_by_district(df: DataFrame, fit: OutlierFit) -> DataFrame:
    """Pass 2: remaining outliers take their district mean; no mean -> value kept (T2 intent)."""
    mx = _map_literal({k: v[0] for k, v in fit.means.items()})
    my = _map_literal({k: v[1] for k, v in fit.means.items()})
    mask = out_of_bounds()
    key = F.col("PdDistrict")
    return df.withColumns({
        "X": F.when(mask, F.coalesce(mx[key], F.col("X"))).otherwise(F.col("X")),
        "Y": F.when(mask, F.coalesce(my[key], F.col("Y"))).otherwise(F.col("Y")),
    })


def handle_outliers(df: DataFrame, fit: OutlierFit | None = None) -> tuple[DataFrame, OutlierFit]:
    """Pass 1 (within ``df``), then pass 2 with means fitted on ``df`` unless given."""
    passed = repair_by_address(df)
    if fit is None:
        fit = OutlierFit.fit(passed)
    return repair_by_district(passed, fit), fit
