"""B1 ``describe``: count, mean, sample std, min, 25/50/75 %, max per numeric column.

Quantiles are exact (linear interpolation between order statistics, as
pandas does) but never gather a column into one task: each order statistic is
found by histogram refinement. Every pass is one partial+final aggregate that
returns at most ``ranges x buckets`` rows; the range holding the wanted rank
shrinks by ~``buckets`` per pass, and once it holds at most ``collect_limit``
values those few values are fetched and sorted. Passes ~ log_buckets(n / limit).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _order_statistics(df: DataFrame, targets: dict[str, list[int]], stats: dict[str, tuple],
                      buckets: int = 1024, collect_limit: int = 50_000, max_passes: int = 64) -> dict:
    """k-th smallest non-null value (0-based) for each (column, k) in ``targets``."""
    # state per target: (column, k) -> [lo, hi, below]
    state = {}
    answers: dict = {}
    for c, ks in targets.items():
        n, vmin, vmax = stats[c]
        for k in ks:
            state[(c, k)] = [float(vmin), float(vmax), 0]
            if k == 0:
                answers[(c, k)] = float(vmin)
            elif k == n - 1:
                answers[(c, k)] = float(vmax)
    for _ in range(max_passes):
        active = {t: s for t, s in state.items() if t not in answers}
        for t, (lo, hi, _) in active.items():
            if lo == hi:
                answers[t] = lo
        active = {t: s for t, s in active.items() if t not in answers}
        if not active:
            break
        ranges = sorted({(t[0], s[0], s[1]) for t, s in active.items()})
        rid = {r: i for i, r in enumerate(ranges)}
        items = [F.when(F.col(c).between(lo, hi),
                        F.struct(F.lit(i).alias("r"), F.col(c).cast("double").alias("v"),
                                 F.lit(lo).alias("lo"), F.lit((hi - lo) / buckets).alias("w")))
                 for (c, lo, hi), i in rid.items()]
        rows = (df.select(F.explode(F.filter(F.array(*items), lambda s: s.isNotNull())).alias("s"))
                .select("s.r", "s.v", F.least(F.floor((F.col("s.v") - F.col("s.lo")) / F.col("s.w")),
                                              F.lit(buckets - 1)).alias("b"))
                .groupBy("r", "b").agg(F.count("*").alias("n"), F.min("v").alias("vmin"), F.max("v").alias("vmax"))
                .collect())
        hist: dict[int, list] = {}
        for r in rows:
            hist.setdefault(r["r"], []).append((r["b"], r["n"], r["vmin"], r["vmax"]))
        small = {}
        for t, (lo, hi, below) in active.items():
            cum = below
            for b, n, bmin, bmax in sorted(hist.get(rid[(t[0], lo, hi)], [])):
                if cum + n > t[1]:
                    state[t] = [bmin, bmax, cum]
                    if bmin != bmax and n <= collect_limit:
                        small[t] = (bmin, bmax, cum)
                    break
                cum += n
        if small:
            keys = sorted({(t[0], s[0], s[1]) for t, s in small.items()})
            kid = {k: i for i, k in enumerate(keys)}
            items = [F.when(F.col(c).between(lo, hi), F.struct(F.lit(i).alias("r"), F.col(c).cast("double").alias("v")))
                     for (c, lo, hi), i in kid.items()]
            vals: dict[int, list] = {}
            for r in (df.select(F.explode(F.filter(F.array(*items), lambda s: s.isNotNull())).alias("s"))
                      .select("s.r", "s.v").collect()):
                vals.setdefault(r["r"], []).append(r["v"])
            for t, (lo, hi, below) in small.items():
                v = sorted(vals[kid[(t[0], lo, hi)]])
                answers[t] = v[t[1] - below]
    missing = [t for t in state if t not in answers]
    if missing:
        raise RuntimeError(f"quantile search did not converge for {missing}")
    return answers


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], stats: dict | None = None,
                    **kw) -> dict[str, list]:
    """Linear-interpolated quantiles (pandas/numpy default) per column.

    ``stats`` (column -> (count, min, max)) skips the first aggregate when known."""
    if stats is None:
        aggs = []
        for c in cols:
            aggs += [F.count(c), F.min(c), F.max(c)]
        row = df.agg(*aggs).first()
        stats = {c: (row[3 * i], row[3 * i + 1], row[3 * i + 2]) for i, c in enumerate(cols)}
    targets: dict[str, list[int]] = {}
    for c in cols:
        n = stats[c][0]
        if n == 0:
            continue
        ks = set()
        for p in probs:
            pos = p * (n - 1)
            ks.add(int(math.floor(pos)))
            ks.add(min(int(math.floor(pos)) + 1, n - 1))
        targets[c] = sorted(ks)
    order = _order_statistics(df, targets, stats, **kw) if targets else {}
    out = {}
    for c in cols:
        n = stats[c][0]
        vals = []
        for p in probs:
            if n == 0:
                vals.append(None)
                continue
            pos = p * (n - 1)
            k = int(math.floor(pos))
            a, b = order[(c, k)], order[(c, min(k + 1, n - 1))]
            vals.append(a + (b - a) * (pos - k))
        out[c] = vals
    return out


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """B1 as a long table: one row per column with count, mean, std, min, 25%, 50%, 75%, max."""
    from ..models.base import cached

    spark = df.sparkSession
    if cols is None:
        cols = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float", "integer", "long")]
    # the profiled columns are materialised once: the summary and every
    # refinement pass read them instead of re-running the upstream plan
    narrow = cached(df.select(*[F.col(c).cast("double").alias(c) for c in cols]))
    try:
        aggs = []
        for c in cols:
            x = F.col(c)
            aggs += [F.count(x), F.avg(x), F.stddev_samp(x), F.min(x), F.max(x)]
        row = narrow.agg(*aggs).first()
        stats = {c: (row[5 * i], row[5 * i + 3], row[5 * i + 4]) for i, c in enumerate(cols)}
        qs = exact_quantiles(narrow, cols, [0.0, 0.25, 0.5, 0.75, 1.0], stats=stats)
    finally:
        narrow.unpersist()
    row = [v for i in range(len(cols)) for v in (row[5 * i], row[5 * i + 1], row[5 * i + 2])]
    data = []
    for i, c in enumerate(cols):
        q0, q25, q50, q75, q100 = qs[c]
        data.append((c, int(row[3 * i]), row[3 * i + 1], row[3 * i + 2], q0, q25, q50, q75, q100))
    return spark.createDataFrame(
        data, "column string, count long, mean double, std double, min double, p25 double, p50 double, "
              "p75 double, max double")
