"""Model-selection operators: stratified folds (F2), hold-out split (J6),
log loss (J1), fold-score summaries (E3, E4), trial ranking (F1).

Folds and hold-out rows follow the order of (key hash, key) inside a stratum: the row with
rank r of n belongs to fold ``floor(r * n_splits / n)``. No row is ranked for it. The few
(hash, key) pairs at which a fold begins are found by histogram refinement (each pass is an
aggregate that returns at most ranges x buckets rows; hashes are uniform, so a range shrinks
by the number of buckets per pass), and a row's fold is a projection against them. There is
no shuffle of rows, no window and no other rule for large strata; the result does not depend
on the number of buckets. Rows that share a key share a fold; a NULL key is refused.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import SEED

P31 = 2147483647  # 2^31 - 1; x -> x^5 is a permutation modulo P31 (5 does not divide P31 - 1)
_A, _B, _C = 48271, 69621, 40692
MAX_CUTS = 200_000  # strata x folds x seeds whose cut points the driver holds


def _offsets(seed: int) -> tuple[int, int]:
    return (seed * _A + 11) % P31, (seed * _B + 7) % P31


def _bound(x: Column, f) -> Column:
    """``f(x)`` with ``x`` computed once per row, however often ``f`` names it (a plain expression would be copied
    for every use, and copies of copies multiply)."""
    return F.transform(F.array(x), f)[0]


def key_hash(key: str = "Id", seed: int = SEED) -> Column:
    """Seeded hash in [0, 2^31-1): two rounds of shift and fifth power, a permutation of the keys below
    2^31-1 for every seed; larger keys enter with their high part. BIGINT arithmetic only, same in SQL."""
    def fifth(x: Column) -> Column:
        return _bound(x, lambda x: _bound(x * x % P31, lambda two: two * two % P31 * x % P31))

    a, b = _offsets(seed)
    low = F.pmod(F.col(key), F.lit(P31))
    high = F.pmod(F.call_function("div", F.col(key) - low, F.lit(P31)), F.lit(P31))
    return fifth((fifth((low + a) % P31) + b + high * _C % P31) % P31)


def with_key_hashes(df: DataFrame, key: str, seeds: dict[str, int]) -> DataFrame:
    """Adds ``key_hash`` under each name for its seed, a column for each step: compiled code, every step computed once."""
    steps = ("l", "g", "x", "t", "y", "u")
    if not seeds:
        return df
    at = lambda n, step: F.col(f"_{n}_{step}")
    off = {n: _offsets(seed) for n, seed in seeds.items()}
    for make in (
            lambda n: {"l": F.pmod(F.col(key), F.lit(P31))},
            lambda n: {"g": F.pmod(F.call_function("div", F.col(key) - at(n, "l"), F.lit(P31)), F.lit(P31)), "x": (at(n, "l") + off[n][0]) % P31},
            lambda n: {"t": at(n, "x") * at(n, "x") % P31},
            lambda n: {"y": (at(n, "t") * at(n, "t") % P31 * at(n, "x") % P31 + off[n][1] + at(n, "g") * _C % P31) % P31},
            lambda n: {"u": at(n, "y") * at(n, "y") % P31}):
        df = df.withColumns({f"_{n}_{step}": c for n in seeds for step, c in make(n).items()})
    df = df.withColumns({n: at(n, "u") * at(n, "u") % P31 * at(n, "y") % P31 for n in seeds})
    return df.drop(*[f"_{n}_{step}" for n in seeds for step in steps])


def key_hash_sql(key: str = "Id", seed: int | str = SEED) -> str:
    """The same hash for DuckDB (non-negative keys below 2^62); ``seed`` may be an SQL expression."""
    a, b = (f"{x}" for x in _offsets(seed)) if isinstance(seed, int) else (
        f"((CAST({seed} AS BIGINT) * {_A} + 11) % {P31})", f"((CAST({seed} AS BIGINT) * {_B} + 7) % {P31})")
    fifth = lambda x: (f"list_transform([{x}], lambda x: ((((x * x % {P31}) * (x * x % {P31})) % {P31}) * x) % {P31})[1]")
    first = fifth(f"CAST(({key} % {P31} + {a}) % {P31} AS BIGINT)")
    return fifth(f"CAST(({first} + {b} + ({key} // {P31}) % {P31} * {_C} % {P31}) % {P31} AS BIGINT)")


def key_hash_np(ids: np.ndarray, seed: int = SEED) -> np.ndarray:
    """The same hash of an integer array."""
    p = np.int64(P31)

    def fifth(x):
        two = x * x % p
        return two * two % p * x % p

    a, b = _offsets(seed)
    ids = ids.astype(np.int64)
    low = ids % p
    return fifth((fifth((low + a) % p) + b + (ids - low) // p % p * _C % p) % p)


def _cut_points(df: DataFrame, strata: list[str], key: str, seeds: list[int], ranks, buckets: int,
                collect_limit: int) -> dict:
    """{(seed number, stratum): [(hash, key) at each of the ``ranks(n)``, in their order]}."""
    spark = df.sparkSession
    counts = df.groupBy(*strata).agg(F.count("*").alias("n"), F.count(key).alias("keys")).limit(MAX_CUTS + 1).collect()
    if len(counts) > MAX_CUTS:  # strata of one row have no cut point, but they count
        raise ValueError("too many strata")
    if any(r["n"] != r["keys"] for r in counts):
        raise ValueError(f"NULL {key}: rows need a key before they can be split")
    state, answers, rank = {}, {}, {}
    for r in counts:
        for s in range(len(seeds)):
            for j, at in enumerate(ranks(r["n"]) if r["n"] else []):
                state[s, tuple(r[c] for c in strata), j] = (0, P31, 0)
                rank[s, tuple(r[c] for c in strata), j] = at
    if len(state) > MAX_CUTS:
        raise ValueError("too many strata")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType([T.StructField("_rid", T.LongType()), T.StructField("_s", T.IntegerType()),
                           *[T.StructField(f"_k{i}", kinds[c]) for i, c in enumerate(strata)],
                           T.StructField("_lo", T.LongType()), T.StructField("_hi", T.LongType())])
    hashed = with_key_hashes(df.select(*strata, F.col(key).alias("_key")), "_key", {f"_h{i}": s for i, s in enumerate(seeds)})
    hashes = F.explode(F.array(*[F.struct(F.lit(i).alias("s"), F.col(f"_h{i}").alias("h")) for i in range(len(seeds))]))
    rows = hashed.select(*strata, F.col("_key").cast("long").alias("_key"), hashes.alias("_e")).select("*", "_e.s", "_e.h").drop("_e")

    def inside(ranges: list) -> DataFrame:
        table = spark.createDataFrame([(i, s, *k, lo, hi) for i, (s, k, lo, hi) in enumerate(ranges)], schema)
        on = (F.col("s") == F.col("_s")) & (F.col("h") >= F.col("_lo")) & (F.col("h") < F.col("_hi"))
        for i, c in enumerate(strata):
            on = on & F.col(c).eqNullSafe(F.col(f"_k{i}"))
        return rows.join(F.broadcast(table), on)  # at most MAX_CUTS rows

    while len(answers) < len(state):
        active = {t: v for t, v in state.items() if t not in answers}
        ranges = sorted({(t[0], t[1], v[0], v[1]) for t, v in active.items()}, key=repr)
        rid = {r: i for i, r in enumerate(ranges)}
        width = F.col("_hi") - F.col("_lo")
        hist: dict[int, list] = {}
        for r in inside(ranges).groupBy("_rid", F.floor((F.col("h") - F.col("_lo")) * buckets / width).cast("long").alias("b")) \
                .agg(F.count("*").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")).collect():
            hist.setdefault(r["_rid"], []).append((r["b"], r["n"], r["lo"], r["hi"]))
        small = {}
        for t, (lo, hi, below) in active.items():
            for _, n, first, last in sorted(hist[rid[t[0], t[1], lo, hi]]):
                if below + n > rank[t]:
                    state[t] = (first, last + 1, below)
                    if n <= collect_limit or first == last:
                        small[t] = state[t]
                    break
                below += n
        if small:
            ranges = sorted({(t[0], t[1], v[0], v[1]) for t, v in small.items()}, key=repr)
            rid = {r: i for i, r in enumerate(ranges)}
            found: dict[int, list] = {}
            for r in inside(ranges).groupBy("_rid", "h", "_key").count().collect():
                found.setdefault(r["_rid"], []).append((r["h"], r["_key"], r["count"]))
            for t, (lo, hi, below) in small.items():
                for h, k, n in sorted(found[rid[t[0], t[1], lo, hi]]):
                    if below + n > rank[t]:
                        answers[t] = (h, k)
                        break
                    below += n
    out: dict = {}
    for t in sorted(state, key=lambda t: t[2]):
        out.setdefault((t[0], t[1]), []).append(answers[t])
    return out


def _with_folds(df: DataFrame, strata: list[str], key: str, seeds: list[int], names: list[str], n_splits: int,
                buckets: int, collect_limit: int) -> DataFrame:
    """One fold column per seed."""
    begins = lambda n: [-(-j * n // n_splits) for j in range(1, n_splits) if -(-j * n // n_splits) < n]
    cuts = _cut_points(df, strata, key, seeds, begins, buckets, collect_limit)
    by: dict = {}
    for (s, k), points in cuts.items():
        by.setdefault(k, {})[s] = points
    kinds = {f.name: f.dataType for f in df.schema.fields}
    pair = T.ArrayType(T.StructType([T.StructField("h", T.LongType()), T.StructField("k", T.LongType())]))
    schema = T.StructType([*[T.StructField(f"_k{i}", kinds[c]) for i, c in enumerate(strata)],
                           *[T.StructField(f"_c{s}", pair) for s in range(len(seeds))]])
    table = df.sparkSession.createDataFrame([(*k, *[v.get(s, []) for s in range(len(seeds))]) for k, v in by.items()], schema)
    on = F.lit(True)
    for i, c in enumerate(strata):
        on = on & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    hashed = with_key_hashes(df, key, {f"_h{s}": seed for s, seed in enumerate(seeds)})
    joined = hashed.join(F.broadcast(table), on, "left")  # one row per stratum, at most MAX_CUTS cut points
    own = F.col(key).cast("long")

    def fold(s: int) -> Column:
        h = F.col(f"_h{s}")
        begun = F.filter(F.coalesce(F.col(f"_c{s}"), F.array().cast(pair)),
                         lambda c: (c["h"] < h) | ((c["h"] == h) & (c["k"] <= own)))
        return F.size(begun)

    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[fold(s).alias(name) for s, name in enumerate(names)])


def stratified_folds(df: DataFrame, n_splits: int = 2, seed: int = SEED, label: str = "Category",
                     extra_strata: list[str] | None = None, key: str = "Id", out: str = "fold",
                     buckets: int = 1024, collect_limit: int = 4096) -> DataFrame:
    """fold id balanced within each class (sizes differ by at most one)."""
    return _with_folds(df, [label] + list(extra_strata or []), key, [seed], [out], n_splits, buckets, collect_limit)


def repeated_folds(df: DataFrame, n_splits: int, n_repeats: int, seed: int = SEED, label: str = "Category",
                   key: str = "Id") -> DataFrame:
    """One fold column ``fold_r`` per repeat, each with its own seed; all repeats share the passes."""
    return _with_folds(df, [label], key, [seed + 7919 * r for r in range(n_repeats)],
                       [f"fold_{r}" for r in range(n_repeats)], n_splits, 1024, 4096)


def train_test_split(df: DataFrame, test_size: float = 0.2, seed: int = SEED, key: str = "Id",
                     out: str = "is_holdout", buckets: int = 1024, collect_limit: int = 4096) -> DataFrame:
    """Exactly ceil(test_size * n) rows flagged as hold-out, those with the smallest (hash, key)."""
    last = lambda n: [max(0, math.ceil(test_size * n) - 1)]
    cuts = list(_cut_points(df, [], key, [seed], last, buckets, collect_limit).values())
    if not cuts:
        return df.withColumn(out, F.lit(False))
    ((h0, k0),) = cuts[0]
    h = F.col("_h")
    hashed = with_key_hashes(df, key, {"_h": seed}).withColumn(out, (h < h0) | ((h == h0) & (F.col(key) <= k0)))
    return hashed.select(*[F.col(f"`{c}`") for c in df.columns if c != out], out)


def log_loss_col(prob: str = "probability", label: str = "label", eps: float = 1e-15) -> Column:
    """-ln p(true class), with p clipped to [eps, 1 - eps]; NULL for a row without a class (label NULL or -1)."""
    known = F.col(label) >= 0
    p = F.element_at(F.col(prob), F.when(known, F.col(label) + 1).otherwise(1))
    return F.when(known, -F.log(F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))))


def log_loss(df: DataFrame, prob: str = "probability", label: str = "label", eps: float = 1e-15) -> float:
    """Mean log loss (one aggregate)."""
    return df.agg(F.avg(log_loss_col(prob, label, eps))).first()[0]


def rank_trials(trials: DataFrame, score: str = "mean_test_score") -> DataFrame:
    """F1: rank parameter sets by mean score, ties share the lowest rank (tiny table)."""
    return trials.withColumn("rank_test_score", F.rank().over(Window.orderBy(F.desc(score))).cast("int"))


def best_round(round_loss: DataFrame) -> DataFrame:
    """Best (lowest) fold-mean loss and its 1-based round number."""
    per_round = round_loss.groupBy("round").agg(F.avg("loss").alias("mean_loss"))
    return per_round.agg(F.min("mean_loss").alias("best_loss"),
                         (F.min_by("round", "mean_loss") + 1).alias("best_round"))
