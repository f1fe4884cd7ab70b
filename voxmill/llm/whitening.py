"""Whitening of embeddings by an exact scatter matrix, summed in residue numbers.

Entries become integers x, and each distinct vector counts once (the fit list).

1. One pass counts the fit list, and sums and bounds every dimension (exact).
2. A second pass centres before it multiplies: y = n x - S is an integer, and each task multiplies residues of y by themselves for several
   primes under 2^21.  Residues lie within half a prime of zero, so blocks of 8,192 rows sum to less than 2^53 and the double product is
   exact.  As many primes are taken as the bound of the whole sum asks for.
3. Residue sums add up by (prime, entry) in Spark; Chinese remaindering makes them the exact scatter, n^3 times the covariance, and
   a double eigen-decomposition of the correctly rounded covariance gives the components.
4. Every row is projected; the whitened fit list's own covariance is summed the same way, in doubles, for `identity_error`.

The driver holds matrices of dimensions by dimensions, whatever the number of rows.

Edge cases: rows whose vector is null, or holds null or non-finite entries, or entries that no long can hold (64 c beyond 2^62), are dropped; so are
vectors of another length than most (of equally common lengths the greatest counts), and empty ones; null ids stay; repeated rows are rows of their own and count once in the fit
list; a component without variance has whitened null, and takes no part in `identity_error`; explained is null where no dimension varies; there are at
most as many components as dimensions; a deviation beyond a long is null (`deviation_exact` of `whiten` holds it); empty tables give no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, durable, table

COMPONENTS = 16
#: Primes are the greatest ones under this; rows that one exact product takes.
PRIME_UNDER, BLOCK_ROWS = 1 << 21, 1 << 13
#: The greatest |64 c| that counts as a number here.
LARGEST = float(1 << 62)
SCALE, SHIFT = 64, 1_000_000


def primes(product_over: int) -> list[int]:
    """The greatest primes under PRIME_UNDER, until their product exceeds a bound."""
    sieve = np.ones(PRIME_UNDER, bool)
    sieve[:2] = False
    for k in range(2, int(PRIME_UNDER**0.5) + 1):
        if sieve[k]:
            sieve[k * k :: k] = False
    out, product = [], 1
    for p in np.flatnonzero(sieve)[::-1]:
        if product > product_over:
            break
        out.append(int(p))
        product *= int(p)
    return out


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def quantised(rows: DataFrame, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, x) of the rows that can be whitened."""
    fits = F.forall("_v", lambda c: F.coalesce(F.abs(c * SCALE) < LARGEST, F.lit(False)) & ~F.isnan(c))
    good = rows.select(F.col(id_).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("_v")).where(F.col("_v").isNotNull() & (F.size("_v") > 0) & fits)
    x = good.select("vec_id", F.transform("_v", lambda c: F.floor(c * SCALE) + F.lit(SHIFT).cast("long")).alias("x"))
    widths = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return x.where(F.size("x") == (widths[0].d if widths else 0))


def moments(fit: DataFrame) -> tuple[int, list[int], int]:
    """(n, sums of the dimensions, the greatest |n x - S|) of the fit list, exact."""

    def part(batches):
        for b in batches:
            x = matrix(b.column(0))
            if len(x):
                wide = x if int(np.abs(x).max()) < 2**62 // len(x) else x.astype(object)
                sums = [str(int(s)) for s in wide.sum(axis=0)]
                yield pa.RecordBatch.from_pydict({"i": pa.array(range(x.shape[1]), pa.int32()), "n": pa.array([len(x)] * x.shape[1], pa.int64()), "s": sums, "lo": x.min(axis=0), "hi": x.max(axis=0)})

    parts = fit.select("x").mapInArrow(part, "i int, n long, s string, lo long, hi long")
    found = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("i").collect()
    if not found:
        return 0, [], 0
    n = found[0].n
    return n, [int(r.s) for r in found], max(max(n * r.hi - int(r.s), int(r.s) - n * r.lo) for r in found)


def residue_scatter(x: np.ndarray, n: int, sums: list[int], p: int) -> np.ndarray:
    """The residues modulo p of the sum of y y' over the rows, y = n x - S."""
    out = np.zeros((x.shape[1], x.shape[1]), np.int64)
    lows = np.array([s % p for s in sums], np.int64)
    for at in range(0, len(x), BLOCK_ROWS):
        y = (x[at : at + BLOCK_ROWS] % p * (n % p) - lows) % p
        r = np.where(y > p // 2, y - p, y).astype(np.float64)
        out = (out + (r.T @ r).astype(np.int64)) % p
    return out


def scatter(fit: DataFrame, n: int, sums: list[int], greatest: int) -> np.ndarray:
    """The exact sum of y y' over the fit list, as Python integers."""
    d = len(sums)
    moduli = primes(2 * n * greatest**2 + 1)
    upper = np.triu_indices(d)

    def part(batches):
        held = {}
        for b in batches:
            x = matrix(b.column(0))
            for k, p in enumerate(moduli):
                held[k] = (held.get(k, 0) + residue_scatter(x, n, sums, p)) % p
        for k, r in held.items():
            v = r[upper]
            yield pa.RecordBatch.from_pydict({"k": pa.array(np.full(len(v), k), pa.int32()), "e": pa.array(np.arange(len(v)), pa.int32()), "v": v})

    totals = fit.select("x").mapInArrow(part, "k int, e int, v long").groupBy("k", "e").agg(F.sum("v").alias("v")).toArrow()
    residues = np.zeros((len(moduli), len(upper[0])), object)
    residues[totals["k"].to_numpy(), totals["e"].to_numpy()] = totals["v"].to_pylist()
    product = reduce(lambda a, b: a * b, moduli)
    whole = sum(residues[k] % p * (product // p * pow(product // p, -1, p)) for k, p in enumerate(moduli)) % product
    whole = np.array([v - product if v > product // 2 else v for v in whole], object)
    out = np.empty((d, d), object)
    out[upper] = whole
    out.T[upper] = whole
    return out


def principal(exact: np.ndarray, n: int, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(unit components as rows, their variances, the trace) of the covariance, an exact scatter over n^3."""
    cube = n**3
    v = np.array([[e / cube for e in row] for row in exact], np.float64)
    e, q = np.linalg.eigh(v)
    trace = sum(exact[i, i] for i in range(len(exact))) / cube
    first = np.argsort(-e, kind="stable")[:count]
    # what rounding leaves of a direction without variance
    flat = e[first] <= len(v) * np.finfo(float).eps * max(float(e.max()), 0.0)
    return q.T[first], np.where(flat, 0.0, e[first]), trace


def deviations(x: np.ndarray, n: int, sums: list[int], greatest: int) -> tuple[np.ndarray, list[int]]:
    """(y / n in doubles, sums of y^2 as exact integers), y = n x - S."""
    small = x.shape[1] * greatest**2 < 2**63 and n * int(np.abs(x).max(initial=1)) < 2**62
    y = (x if small else x.astype(object)) * n - np.array(sums, np.int64 if small else object)
    return (y / n).astype(np.float64), [int(s) for s in (y * y).sum(axis=1)]


def whiten(rows: DataFrame, id_: str = "vec_id", vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """(vec_id, n, deviation_exact decimal, whitened array, explained array, identity_error) of every row that has a whitened form."""
    spark = rows.sparkSession
    every = durable(quantised(rows, id_, vector), "whitening-rows")
    fit = durable(every.select("x").distinct(), "whitening-fit")
    n, sums, greatest = moments(fit)
    shape = "vec_id long, n long, deviation_exact string, whitened array<double>"
    names = [f.split()[0] for f in shape.split(", ")]
    if not n:
        return spark.createDataFrame([], shape + ", explained array<double>, identity_error double").withColumn("deviation_exact", F.col("deviation_exact").cast("decimal(38,0)"))
    parts, e, trace = principal(scatter(fit, n, sums, greatest), n, count)
    turn = (parts / np.sqrt(np.where(e > 0, e, np.nan))[:, None]).T
    live = np.flatnonzero(e > 0)

    def project(batches):
        for b in batches:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(at, BLOCK_ROWS)
                centred, exact = deviations(matrix(part.column(1)), n, sums, greatest)
                w = centred @ turn
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel(), from_pandas=True))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([n] * len(w), pa.int64()), pa.array(map(str, exact), pa.string()), lists], names=names)

    def covariance(batches):
        total = np.zeros((len(live), len(live)))
        for b in batches:
            w = deviations(matrix(b.column(0)), n, sums, greatest)[0] @ turn[:, live]
            total += w.T @ w
        yield pa.RecordBatch.from_pydict({"e": pa.array(np.arange(total.size), pa.int32()), "v": total.ravel()})

    error = None
    if len(live):
        # the whitened fit list has mean 0, as its rows are centred exactly
        found = fit.mapInArrow(covariance, "e int, v double").groupBy("e").agg(F.sum("v").alias("v")).orderBy("e").toArrow()["v"].to_numpy()
        error = float(np.abs(found.reshape(len(live), -1) / n - np.eye(len(live))).max())
    discard(fit)
    explained = F.lit([float(x) / trace for x in e]) if trace else F.lit(None).cast("array<double>")
    out = every.mapInArrow(project, shape)
    return out.withColumn("deviation_exact", F.col("deviation_exact").cast("decimal(38,0)")).withColumns({"explained": explained, "identity_error": F.lit(error).cast("double")})


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whiten(table(spark, sf_dir, "embeddings"))
    each = rows.select("*", F.posexplode("whitened").alias("_k", "value"))
    return each.select("vec_id", (F.col("_k") + 1).alias("component"), "n", F.expr("try_cast(deviation_exact AS bigint)").alias("deviation"), F.col("value").alias("whitened"), F.get("explained", F.col("_k")).alias("explained"), "identity_error")
