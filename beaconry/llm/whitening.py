"""Whitening of embeddings by spectral divide and conquer.

Entries become integers, so sums over the distinct vectors are exact and the covariance is centred before it is multiplied, in partial
matrices of d x d a task. The covariance is then split without an eigenvalue solver: the polar factor of the shifted covariance (dynamically
weighted Halley iteration, QDWH) is the matrix sign, half of it plus the identity projects onto the eigenvectors beyond the shift, and
the two invariant subspaces are split in turn until single components are left. Only subspaces that hold wanted components are
followed. What whitens a vector, the mean and the wanted components, goes to every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import prepare, stored

SCALE = 256
COMPONENTS = 4
EPS = np.finfo(float).eps
SHIFTS = (0.0, 0.1, -0.1, 0.25, -0.25, 0.5, -0.5, 0.03, -0.03)  # spreads around the mean eigenvalue
LONGEST = (1 << 63) - 1


def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by the QDWH iteration."""
    eye = np.eye(len(a))
    x = a / np.linalg.norm(a)
    low = 1e-16  # a bound below the least singular value; a smaller one costs a step, no accuracy
    for _ in range(40):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square ** 2)
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * root)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:  # by QR while badly conditioned
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:len(a)] @ q[len(a):].T
        else:
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(eye + wc * x.T @ x, x.T).T
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x = new
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        if moved < EPS ** (1 / 3) and 1 - low < 1e-12:
            break
    return x


def _split(a: np.ndarray, scale: float) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first columns span the eigenvectors beyond a shift near the mean eigenvalue, and their number."""
    n = len(a)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n)) / np.sqrt(n)
    best = None
    for shift in SHIFTS:
        projector = (polar(a - (mean + shift * spread) * np.eye(n)) + np.eye(n)) / 2
        size = int(round(np.trace(projector)))
        if not 0 < size < n:
            continue
        start = np.random.default_rng(n).standard_normal((n, size))
        span, _ = np.linalg.qr(projector @ start)
        basis, _ = np.linalg.qr(projector @ span, mode="complete")
        left = np.linalg.norm(basis[:, size:].T @ a @ basis[:, :size])
        if best is None or left < best[0]:
            best = left, basis, size
        if left <= 20 * EPS * scale:  # a shift on an eigenvalue leaves more
            break
    return best and best[1:]


def spectrum(a: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` greatest eigenvalues (all by default), falling, and unit eigenvectors as columns."""
    n = len(a)
    most = n if most is None else min(most, n)
    scale = np.linalg.norm(a)

    def divide(block: np.ndarray, basis: np.ndarray, wanted: int) -> list[tuple[float, np.ndarray]]:
        parts = None
        if len(block) > 1 and np.linalg.norm(block - np.diag(np.diag(block))) > 4 * EPS * scale:
            parts = _split(block, scale)
        if parts is None:
            return sorted(((block[i, i], basis[:, i]) for i in range(len(block))), key=lambda e: -e[0])[:wanted]
        turn, size = parts
        inner = turn.T @ block @ turn
        inner = (inner + inner.T) / 2
        out = divide(inner[:size, :size], basis @ turn[:, :size], wanted)
        if wanted > size:  # the upper subspace does not hold all that is asked for
            out += divide(inner[size:, size:], basis @ turn[:, size:], wanted - size)
        return out

    found = sorted(divide(a, np.eye(n), most), key=lambda e: -e[0]) if n else []
    return np.array([v for v, _ in found]), np.array([x for _, x in found]).T.reshape(n, len(found))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    rows = batch.column("x")
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: as longs where they fit, else as Python's integers."""
    if n * int(np.abs(x.astype(float)).max(initial=0)) + max(map(abs, sums)) < 1 << 62:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count, total = 0, None
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch)
            wide = float(np.abs(x.astype(float)).max(initial=0)) * len(x) >= 1 << 62
            own = (x.astype(object) if wide else x).sum(axis=0)
            total = [a + int(b) for a, b in zip(total or [0] * len(own), own, strict=True)]
            count += batch.num_rows
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64()), pa.array([[str(t) for t in total]], pa.list_(pa.string()))], names=["n", "s"])


def _products(n: int, sums: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(sums), len(sums)))
        for batch in batches:
            if batch.num_rows:
                centred = (_offsets(_matrix(batch), n, sums) / n).astype(float)
                total += centred.T @ centred
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"])

    return run


def _whiten(n: int, sums: list[int], axes: np.ndarray):
    """Per row its whitened coordinates and its exact squared distance from the mean, n^2 times (null beyond a long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            off = _offsets(_matrix(batch), n, sums)
            if off.dtype != object and float((off.astype(float) ** 2).sum(axis=1).max()) < 1 << 62:
                far = pa.array((off * off).sum(axis=1), pa.int64())
            else:
                exact = [sum(int(v) ** 2 for v in row) for row in off]
                far = pa.array([v if v <= LONGEST else None for v in exact], pa.int64())
            at = (off / n).astype(float) @ axes
            names = [c for c in batch.schema.names if c != "x"]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [far, pa.array(list(at), pa.list_(pa.float64()))], names=[*names, "deviation", "w"])

    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Per row and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    Entries become x = floor(scale * entry). Mean and covariance are those of the n distinct x. ``deviation`` is the sum of
    (n * x - S)^2 over the dimensions, null beyond a long; ``whitened`` the coordinate on the component's unit eigenvector over the root
    of its eigenvalue, null where the eigenvalue is nothing beside the greatest; ``explained`` the eigenvalue's share of the trace;
    ``identity_error`` the largest entry of the covariance of what was whitened, less the identity.

    Vectors that are null, empty or hold null or non-finite entries are dropped; so are vectors of another length than the commonest (of
    equally common ones the longest), which have no coordinates in its space. Entries beyond a long are cut to its limits. Rows that repeat
    an id, and rows without id, each get their rows; other columns are ignored. An empty table gives no rows.
    """
    spark = prepare(vectors.sparkSession)
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where((F.size("embedding") > 0) & finite).select(
        "vec_id", F.transform("embedding", lambda v: F.floor(scale * v.cast("double")).cast("long")).alias("x"))
    common = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if common is None:
        return spark.createDataFrame([], out)
    rows = rows.where(F.size("x") == common["d"])
    fit = stored(rows.select("x").distinct(), "distinct")
    # exact sums, one row a task, then one row a dimension
    parts = fit.mapInArrow(_sums, "n long, s array<string>")
    n = parts.agg(F.sum("n")).first()[0]
    added = parts.select(F.posexplode("s").alias("i", "s")).groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    sums = [int(r["s"]) for r in added.orderBy("i").collect()]
    products = (fit.mapInArrow(_products(n, sums), "i int, v array<double>").select("i", F.posexplode("v").alias("j", "v"))
                .where("j >= i").groupBy("i", "j").agg(F.sum("v").alias("v")).collect())  # d * (d + 1) / 2 entries
    v = np.zeros((len(sums), len(sums)))
    for r in products:
        v[r["i"], r["j"]] = v[r["j"], r["i"]] = r["v"] / n
    values, axes = spectrum(v, components)
    real = values > EPS * len(values) * len(sums) * max(values[0], 0)
    axes = np.where(real, axes / np.sqrt(np.where(real, values, 1.0)), 0.0)
    run = _whiten(n, sums, axes)
    some = [i for i in range(len(values)) if real[i]]
    entries = [F.abs(F.covar_pop(F.get("w", i), F.get("w", j)) - (1.0 if i == j else 0.0)) for i in some for j in some if i <= j]
    whitened = fit.mapInArrow(run, "deviation long, w array<double>")
    error = whitened.agg(F.array_max(F.array(*entries))).first()[0] if entries else None
    share = [float(x / np.trace(v)) if np.trace(v) > 0 else None for x in values]
    each = F.array(*(F.struct(F.lit(i + 1).alias("component"), (F.get("w", i) if real[i] else F.lit(None).cast("double")).alias("whitened"),
                              F.lit(share[i]).cast("double").alias("explained")) for i in range(len(values))))
    return (rows.mapInArrow(run, "vec_id long, deviation long, w array<double>")
            .select("vec_id", "deviation", F.explode(each).alias("e"))
            .select("vec_id", "e.component", F.lit(n).cast("long").alias("n"), "deviation", "e.whitened", "e.explained",
                    F.lit(error).cast("double").alias("identity_error")))
