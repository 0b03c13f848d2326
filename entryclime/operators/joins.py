"""Join helpers: lookups, anti join, proximity (distance) join.

No side is hinted. Scanned code books are small files, which Spark's own
statistics put under ``spark.sql.autoBroadcastJoinThreshold``; computed
dimensions are converted by adaptive execution once their size is known, with
the shuffle join as the fallback. Building a plan launches no job.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entryclime.functions import geo

def lookup(df: DataFrame, table: DataFrame, left_key: str, right_key: str, how: str = "inner") -> DataFrame:
    """Code -> attributes lookup with differently named keys; the right key is dropped."""
    out = df.join(table, df[left_key] == table[right_key], how)
    return out.drop(table[right_key]) if left_key != right_key else out


def role_lookup(df: DataFrame, table: DataFrame, key: str, left_key: str, prefix: str,
                how: str = "inner") -> DataFrame:
    """Join the same dimension in one role: its columns get ``prefix`` and its key is dropped."""
    renamed = table.select(*[F.col(c).alias(f"{prefix}{c}") for c in table.columns])
    return lookup(df, renamed, left_key, f"{prefix}{key}", how)


def unmatched(df: DataFrame, reference: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``reference`` (NOT EXISTS).

    The reference keys are made distinct first: the fold is partial inside
    each task, so a key that holds a third of the reference is one row before
    the exchange.
    """
    keys = reference.select(F.col(right_key).alias("_reference_key")).distinct()
    return df.join(keys, df[left_key] == keys["_reference_key"], "left_anti")


def proximity_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[tuple[str, str]],
    left_latlon: tuple[str, str],
    right_latlon: tuple[str, str],
    max_km: float,
    method: str = "lambert",
    distance_col: str = "distance_km",
) -> DataFrame:
    """Inner join of rows with equal ``keys`` lying less than ``max_km`` apart.

    Exact and output-sensitive: both sides are bucketed into 3-D grid cells on
    the unit sphere whose edge is longer than any pair within ``max_km``; the
    ``right`` side (pass the smaller one) is replicated into the 27
    neighbouring cells, so the equi-join on ``keys + cell`` only meets pairs in
    adjacent cells and the exact distance runs as the residual inside the join.
    No pole or antimeridian special case is needed. Many rows sharing one key
    cost candidate pairs only among nearby points, never all pairs of the key.
    """
    size = geo.cell_size_for(max_km)

    reduced = method == "lambert"
    if method not in ("lambert", "haversine"):
        raise ValueError(f"unknown distance method {method!r}")

    def prep(df: DataFrame, lat: str, lon: str, tag: str) -> DataFrame:
        x, y, z = geo.unit_vector(lat, lon)
        terms = geo.point_terms(lat, lon, reduced)
        return df.withColumns({
            f"_{tag}cx": F.floor(x / size).cast("long"),
            f"_{tag}cy": F.floor(y / size).cast("long"),
            f"_{tag}cz": F.floor(z / size).cast("long"),
            **{f"_{tag}{k}": v for k, v in terms.items()},
        })

    lp = prep(left.where(F.col(left_latlon[0]).isNotNull() & F.col(left_latlon[1]).isNotNull()),
              *left_latlon, "L")
    rp = prep(right.where(F.col(right_latlon[0]).isNotNull() & F.col(right_latlon[1]).isNotNull()),
              *right_latlon, "R")
    offsets = F.array(*[
        F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy"), F.lit(c).alias("dz"))
        for a, b, c in itertools.product((-1, 0, 1), repeat=3)
    ])
    rp = (rp.withColumn("_off", F.explode(offsets))
            .withColumns({"_Rcx": F.col("_Rcx") + F.col("_off.dx"),
                          "_Rcy": F.col("_Rcy") + F.col("_off.dy"),
                          "_Rcz": F.col("_Rcz") + F.col("_off.dz")})
            .drop("_off"))
    cond: list[Column] = [lp[lk] == rp[rk] for lk, rk in keys]
    cond += [lp[f"_Lc{a}"] == rp[f"_Rc{a}"] for a in "xyz"]
    t1 = {k: lp[f"_L{k}"] for k in geo.POINT_TERMS}
    t2 = {k: rp[f"_R{k}"] for k in geo.POINT_TERMS}
    dist = geo.lambert_from_terms(t1, t2) if reduced else geo.haversine_from_terms(t1, t2)
    joined = lp.join(rp, [*cond, dist < F.lit(max_km)], "inner").withColumn(distance_col, dist)
    helpers = [c for c in joined.columns if c.startswith("_L") or c.startswith("_R")]
    return joined.drop(*helpers)
