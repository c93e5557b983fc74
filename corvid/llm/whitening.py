"""Embedding whitening by incremental eigendecomposition.

1. One pass sums the integer vectors ``x = floor(1024 c) + 100000``, so the
   mean ``S / n`` is exact; from then on every vector is centred before it is
   multiplied with anything.
2. Every task keeps the eigendecomposition of the scatter of its rows and
   applies a rank-one update for each (equal rows of a batch are one update of
   their joint weight): the vector is rotated into the eigenbasis, tiny
   components and equal eigenvalues are deflated, the secular equation gives
   the new eigenvalues, and eigenvectors come from a weight vector refitted to
   them, which keeps them orthogonal (``rank_one``).
3. Spectra are combined by successive rank-one updates, one for each
   eigenpair of the other, ``FAN`` at a time in a tree of Spark jobs.
4. Rayleigh-Ritz: one more pass multiplies the covariance with the basis
   found, and its eigenproblem inside the basis gives the components. A basis
   of full rank is exact after one pass; a basis cut to ``rank`` directions
   is refined until the residual is down to ``TOLERANCE``.

Only sums of the size of one vector and matrices of vector length times
``rank`` reach the driver or are shipped to tasks, however many rows there are.

Defined results: rows whose vector is null, empty or holds null or non-finite
entries are dropped, as are entries of 2^42 and beyond, which no exact integer
stands for; the vector length is the one most rows have (the larger of equals)
and other rows are dropped; null and repeated ids are rows like any other;
directions without variance (at most ``n - 1`` have some) give no component, so
constant vectors or a single row give no rows; so does an empty table. A
``deviation`` beyond 64 bits is null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import partials, tree

RANK = 256
ROUNDS = 50
TOLERANCE = 1e-13
FAN = 16
LARGEST = float(1 << 42)
EPS = 2.220446049250313e-16
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double"


# ------------------------------------------------------------ rank-one updates


def secular_roots(d, z2):
    """Roots of 1 + sum(z2 / (d - m)) = 0 for ascending distinct ``d`` and
    positive ``z2``, one right of every ``d``: (difference ``d[j] - root[i]``
    as a matrix [i, j], roots). Each root is kept as its distance to the nearer
    pole, so the differences have full relative accuracy."""
    import numpy as np

    k = len(d)
    at = np.arange(k)
    gap = np.append(d[1:] - d[:-1], z2.sum())
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        f = 1 + (z2 / (d[None, :] - (d + gap / 2)[:, None])).sum(1)
        left = f >= 0
        low = np.where(left, 0.0, -gap / 2)
        high = np.where(left, gap / 2, 0.0)
        if not left[-1]:  # right of the last pole there is only that pole
            left[-1], low[-1], high[-1] = True, gap[-1] / 2, gap[-1]
        origin = np.where(left, at, np.minimum(at + 1, k - 1))
        delta = d[None, :] - d[origin][:, None]
        upper = np.where(left, gap, 0.0)  # the pole (or bound) on the right
        below = np.tri(k)
        eta = (low + high) / 2
        for _ in range(100):
            diff = delta - eta[:, None]
            part = z2 / diff
            f = 1 + part.sum(1)
            done = np.abs(f) <= 4 * EPS * (1 + np.abs(part).sum(1))
            if done.all():
                break
            low, high = np.where(f < 0, eta, low), np.where(f < 0, high, eta)
            slope = part / diff
            dl = (slope * below).sum(1)
            du = slope.sum(1) - dl
            a1, a2 = diff[at, at], upper - eta
            c = f - a1 * dl - a2 * du
            a = (a1 + a2) * f - a1 * a2 * (dl + du)
            b = a1 * a2 * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = eta + step
            inside = (new > low) & (new < high)
            new = np.where(inside, new, (low + high) / 2)
            done |= (new == eta) | (new <= low) & (new >= high)
            eta = np.where(done, eta, new)
            if done.all():
                break
        diff = delta - eta[:, None]
    # a root on its pole to the last bit keeps the least distance there is
    diff[at, at] = np.minimum(diff[at, at], -np.finfo(float).tiny)
    return diff, d[origin] + eta


def rank_one(d, q, z):
    """Eigenpairs (ascending ``d``, columns of ``q``) of
    ``q diag(d) q' + (q z)(q z)'``."""
    import numpy as np

    d, q, z = d.copy(), q.copy(), z.copy()
    size = float(np.sqrt(z @ z))
    if size == 0:
        return d, q
    tol = 8 * EPS * max(float(np.abs(d).max()), size * size)
    z[np.abs(z) * size <= tol] = 0.0
    live = np.flatnonzero(z)
    if len(live) > 1:
        dist, zz = np.diff(d[live]), z[live] ** 2
        close = dist * np.abs(z[live][:-1] * z[live][1:]) <= tol * (zz[:-1] + zz[1:])
        if close.any():
            last = live[0]
            for i in live[1:]:
                tau = np.hypot(z[last], z[i])
                c, s = z[i] / tau, z[last] / tau
                if (d[i] - d[last]) * abs(c * s) <= tol:
                    # rotate the pair so that one of them has no weight
                    z[i], z[last] = tau, 0.0
                    q[:, last], q[:, i] = c * q[:, last] - s * q[:, i], s * q[:, last] + c * q[:, i]
                    d[last], d[i] = (d[last] * c * c + d[i] * s * s,
                                     d[last] * s * s + d[i] * c * c)
                last = i
            live = np.flatnonzero(z)
            live = live[np.argsort(d[live], kind="stable")]
    if len(live) == 0:
        return _sorted(d, q)
    dl, zl = d[live], z[live]
    diff, roots = secular_roots(dl, zl * zl)
    # weights that have exactly these roots, then orthogonal vectors from them
    apart = dl[:, None] - dl[None, :]
    np.fill_diagonal(apart, 1.0)
    fitted = np.copysign(np.sqrt(np.abs(np.prod(-diff / apart, axis=0))), zl)
    u = (fitted[None, :] / diff).T
    u /= np.sqrt((u * u).sum(0))
    d[live] = roots
    q[:, live] = q[:, live] @ u
    return _sorted(d, q)


def _sorted(d, q):
    import numpy as np

    order = np.argsort(d, kind="stable")
    return d[order], q[:, order]


class Spectrum:
    """Running eigendecomposition of a sum of ``y y'``: the ``rank`` largest
    eigenvalues (ascending) and their vectors as columns."""

    def __init__(self, size: int, rank: int = RANK, d=None, q=None):
        import numpy as np

        self.rank = min(rank, size)
        self.d = np.empty(0) if d is None else d
        self.q = np.empty((size, 0)) if q is None else q

    def add(self, y, weight: float = 1.0) -> None:
        import numpy as np

        y = y * np.sqrt(weight)
        length = float(np.sqrt(y @ y))
        if length == 0:
            return
        z = self.q.T @ y
        d, q = self.d, self.q
        if len(d) < q.shape[0]:  # y may have a part outside the basis
            rest = y - q @ z
            again = q.T @ rest
            rest -= q @ again
            z = z + again
            out = float(np.sqrt(rest @ rest))
            if out > 1e-14 * length:
                rest /= out
                rest -= q @ (q.T @ rest)
                q = np.column_stack([rest / np.sqrt(rest @ rest), q])
                d, z = np.append(0.0, d), np.append(out, z)
        d, q = rank_one(d, q, z)
        self.d, self.q = d[-self.rank:], q[:, -self.rank:]

    def merge(self, other: "Spectrum") -> None:
        """A rank-one update for each eigenpair of ``other``."""
        for value, vector in zip(other.d, other.q.T):
            if value > 0:
                self.add(vector, value)

    def pack(self) -> bytes:
        import numpy as np

        return np.concatenate([[len(self.d), self.q.shape[0]], self.d,
                               self.q.ravel()]).tobytes()

    @classmethod
    def unpack(cls, data: bytes, rank: int) -> "Spectrum":
        import numpy as np

        x = np.frombuffer(data)
        k, size = int(x[0]), int(x[1])
        return cls(size, rank, x[2:2 + k].copy(), x[2 + k:].reshape(size, k).copy())


# ------------------------------------------------------------ rows


def _matrix(batch, size: int):
    """(places of the rows that stay, their x as an integer matrix)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    column = batch.column("vector")
    fits = pc.fill_null(pc.equal(pc.list_value_length(column), size), False)
    at = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
    flat = column.take(pa.array(at)).flatten().cast(pa.float64())
    c = flat.to_numpy(zero_copy_only=False).reshape(-1, size)  # nulls become NaN
    with np.errstate(invalid="ignore"):
        good = (np.abs(c) < LARGEST).all(1)
    return at[good], np.floor(c[good] * 1024).astype(np.int64) + 100_000


def _frame(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return rows.select(F.col(id_col).cast("long").alias("vec_id"),
                       F.col(vector_col).cast("array<double>").alias("vector"))


def vector_sums(frame: DataFrame):
    """(length, n, sums as integers) of the fit list, or None."""
    found = (frame.where(F.size("vector") > 0).groupBy(F.size("vector").alias("k")).count()
             .orderBy(F.desc("count"), F.desc("k")).head(1))
    if not found:
        return None
    size = found[0]["k"]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        n, sums = 0, np.zeros(size, np.int64)
        for batch in batches:
            _, x = _matrix(batch, size)
            n += len(x)
            sums += x.sum(0)
        at = np.arange(-1, size)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()),
                                          pa.array(np.append(n, sums), pa.int64())], ["at", "s"])

    rows = (frame.mapInArrow(run, "at long, s long").groupBy("at")
            .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())  # length + 1 rows
    sums = {r["at"]: int(r["s"]) for r in rows}
    n = sums.get(-1, 0)
    return (size, n, [sums[i] for i in range(size)]) if n else None


class Centre:
    """Integer vectors minus the exact mean: ``x - S/n = u - r/n`` with the
    integers ``u = x - S // n`` and ``r = S mod n``."""

    def __init__(self, n: int, sums: list[int]):
        import numpy as np

        self.n = n
        self.base = np.array([s // n for s in sums], np.int64)
        self.rest = [s % n for s in sums]
        self.part = np.array([r / n for r in self.rest])

    def of(self, x):
        return (x - self.base) - self.part

    def deviations(self, x) -> list:
        """sum((n x - S)^2) of each row, exactly; None beyond 64 bits."""
        import numpy as np

        u, n = x - self.base, self.n
        largest = max((abs(int(v)) for v in (u.max(initial=0), u.min(initial=0))), default=0)
        wide = max(largest, 1) * max(largest, n) * len(self.base) >= 1 << 62
        u = u.astype(object) if wide else u
        rest = np.array(self.rest, object if wide else np.int64)
        squares, crossed = (u * u).sum(1), (u * rest).sum(1)
        fixed = sum(r * r for r in self.rest)
        out = [n * n * int(a) - 2 * n * int(b) + fixed for a, b in zip(squares, crossed)]
        return [v if v < 1 << 63 else None for v in out]


def _slices(batches, rows: int = 1024):
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


# ------------------------------------------------------------ eigenpairs


def spectrum(frame: DataFrame, size: int, centre: Centre, rank: int = RANK) -> Spectrum:
    """Steps 2 and 3: the combined spectrum of all rows."""

    def run(batches):
        import numpy as np

        own = Spectrum(size, rank)
        for batch in _slices(batches):
            _, x = _matrix(batch, size)
            if len(x):
                distinct, copies = np.unique(x, axis=0, return_counts=True)
                for y, weight in zip(centre.of(distinct), copies.tolist()):
                    own.add(y, weight)
        yield own.pack()

    def merge(payloads):
        all_ = Spectrum.unpack(payloads[0], rank)
        for other in payloads[1:]:
            all_.merge(Spectrum.unpack(other, rank))
        return all_.pack()

    return Spectrum.unpack(tree(partials(frame, run), merge, FAN), rank)


def covariance_times(frame: DataFrame, size: int, centre: Centre, basis):
    """(covariance @ basis, trace) in one pass."""
    import numpy as np

    def run(batches):
        total, trace = np.zeros(basis.shape), 0.0
        for batch in _slices(batches):
            _, x = _matrix(batch, size)
            y = centre.of(x)
            total += y.T @ (y @ basis)
            trace += float((y * y).sum())
        yield np.append(total.ravel(), trace).tobytes()

    found = np.frombuffer(tree(partials(frame, run), _summed, FAN)) / centre.n
    return found[:-1].reshape(basis.shape), float(found[-1])


def _summed(payloads) -> bytes:
    import numpy as np

    return np.sum([np.frombuffer(x) for x in payloads], axis=0).tobytes()


def components(frame: DataFrame, size: int, centre: Centre, wanted: int, rank: int = RANK):
    """(eigenvalues falling, eigenvectors as columns, trace) of the covariance:
    step 4 on the spectrum of steps 2 and 3."""
    import numpy as np

    basis = np.linalg.qr(spectrum(frame, size, centre, rank).q)[0]
    if not basis.shape[1]:
        return np.empty(0), np.empty((size, 0)), 0.0
    for _ in range(ROUNDS):
        image, trace = covariance_times(frame, size, centre, basis)
        inner = basis.T @ image
        e, w = np.linalg.eigh((inner + inner.T) / 2)
        e, w = e[::-1], w[:, ::-1]
        vectors = basis @ w
        residual = np.abs(image @ w - vectors * e)[:, :wanted].max(initial=0.0)
        if basis.shape[1] == size or residual <= TOLERANCE * e[0]:
            break
        basis = np.linalg.qr(image @ w)[0]
    keep = np.flatnonzero(e[:wanted] > size * EPS * max(e[0], 0.0) * 16)
    vectors = vectors[:, keep]
    top = np.abs(vectors).argmax(0)
    vectors = vectors * np.sign(vectors[top, np.arange(vectors.shape[1])])
    return e[keep], vectors, trace


# ------------------------------------------------------------ whitening


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           wanted: int = 8, rank: int = RANK) -> DataFrame:
    """A row per usable row and component: vec_id, component, n, deviation,
    whitened, explained, identity_error."""
    import numpy as np

    frame = _frame(rows, id_col, vector_col)
    empty = frame.sparkSession.createDataFrame([], OUT + ", identity_error double")
    sums = vector_sums(frame)
    if sums is None:
        return empty
    size, n, totals = sums
    centre = Centre(n, totals)
    e, vectors, trace = components(frame, size, centre, wanted, rank)
    if not len(e):
        return empty
    scaled = vectors / np.sqrt(e)
    explained = e / trace
    error = identity_error(frame, size, centre, scaled)

    def run(batches):
        import pyarrow as pa

        k = len(explained)
        for batch in _slices(batches):
            at, x = _matrix(batch, size)
            if not len(at):
                continue
            ids = batch.column("vec_id").take(pa.array(np.repeat(at, k)))
            whitened = centre.of(x) @ scaled
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1), len(at)), pa.int32()),
                 pa.array(np.full(len(at) * k, n), pa.int64()),
                 pa.array([v for v in centre.deviations(x) for _ in range(k)], pa.int64()),
                 pa.array(whitened.ravel()), pa.array(np.tile(explained, len(at)))],
                [x.split()[0] for x in OUT.split(", ")])

    return frame.mapInArrow(run, OUT).withColumn("identity_error", F.lit(error))


def identity_error(frame: DataFrame, size: int, centre: Centre, scaled) -> float:
    """Largest entry of the whitened rows' covariance minus the identity,
    measured over all rows."""
    import numpy as np

    k = scaled.shape[1]

    def total(centred):
        def run(batches):
            sums = np.zeros((k, 1) if centred is None else (k, k))
            for batch in _slices(batches):
                _, x = _matrix(batch, size)
                w = centre.of(x) @ scaled
                if centred is None:
                    sums += w.sum(0)[:, None]
                else:
                    w = w - centred
                    sums += w.T @ w
            yield sums.tobytes()

        return np.frombuffer(tree(partials(frame, run), _summed, FAN)) / centre.n

    mean = total(None)
    covariance = total(mean).reshape(k, k)
    return float(np.abs(covariance - np.eye(k)).max())
