"""Quality classifier by positive-unlabelled learning.

Trusted positives (label 1) and unlabelled documents of the learning fold are
described by shares of character classes, repetition and shape of their lines;
a small network minimises the non-negative unbiased risk

    prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1))

so no negative example is needed: labels other than 1 are not read. The class
prior is estimated from positives against unlabelled rows (``estimate_prior``),
or given. When the bracket turns negative in a batch, the step goes against
it, as the method prescribes.

Fitting uses at most ``sample`` positives and about ``sample`` unlabelled rows
(picked by a hash of the id over all rows; the bound is a parameter); only
their feature vectors reach the driver. Scoring is one scan of whole texts.

Defined results: null, empty and word-less texts are scored like any other
text (of zero features); a null id is scored and is neither learnt from nor
held out (``held_out`` false); repeated rows are scored each; without any
positive every score is the prior given (0.5 if none).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import (WordIds, fold, gram_hashes, raw_bytes, slices, small_batches,
                               text_frame)
from corvid.llm.textstats import CLASSES, byte_counts, class_matrix, class_of_byte, repeat_cover

SAMPLE = 20_000
HIDDEN = 24


def describe(data: bytes, ids: WordIds, of_byte, matrix) -> list[float]:
    """Features of one whole text."""
    import numpy as np

    words = data.split()
    n = len(words)
    hist = byte_counts(data)
    classes = hist @ matrix
    size = max(1.0, classes.sum())
    shares = classes / size
    hashed = ids.of(words)
    distinct = len(np.unique(hashed)) / max(1, n)
    tri = repeat_cover(gram_hashes(hashed, 3), 3, n).mean() if n else 0.0
    same = float((hashed[1:] == hashed[:-1]).mean()) if n > 1 else 0.0
    lines = [x for x in data.split(b"\n") if x.strip()]
    dup = 1 - len(set(lines)) / max(1, len(lines))
    worst = [0.0, 0.0, 0.0]
    if data:
        flat = of_byte[np.frombuffer(data, np.uint8)]
        starts = np.concatenate([[0], np.flatnonzero(flat == CLASSES.index("newline")) + 1])
        starts = starts[starts < len(flat)]
        if len(starts):
            length = np.diff(np.append(starts, len(flat)))
            for i, names in enumerate((("upper",), ("symbol", "exclaim"), ("digit",))):
                mask = np.isin(flat, [CLASSES.index(x) for x in names])
                hits = np.add.reduceat(mask.astype(np.int64), starts)
                # share of the text in lines where the class is unusually dense
                worst[i] = float(length[hits > 0.2 * length].sum() / len(flat))
    p = hist[hist > 0] / max(1, len(data))
    return [*map(float, np.sqrt(shares)), math.log1p(n) / 5, distinct, float(tri), same, dup,
            size / max(1, n) / 10, math.log1p(len(lines)) / 5,
            float(-(p * np.log2(p)).sum()) / 5, *worst, *map(float, shares)]


N_FEATURES = 2 * len(CLASSES) + 11


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, label, x) of a frame (doc_id, text, label)."""

    def run(batches):
        import pyarrow as pa

        ids, of_byte, matrix = WordIds(), class_of_byte(), class_matrix()
        for batch in slices(batches):
            x = [describe(data or b"", ids, of_byte, matrix) for data in raw_bytes(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(x, pa.list_(pa.float64()))],
                ["doc_id", "label", "x"])

    return docs.mapInArrow(run, "doc_id long, label int, x array<double>")


def sigmoid(z):
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def pu_step(w: dict, xp, xu, prior: float, decay: float = 1e-4):
    """(objective, gradient) of one batch of positives and unlabelled rows:
    prior * R_p(+1) + R_u(-1) - prior * R_p(-1) while the difference is not
    negative, else the negated difference; plus the weights' decay."""
    import numpy as np

    x, n, nu = np.concatenate([xp, xu]), len(xp), len(xu)
    h = np.tanh(x @ w["a"] + w["b"])
    z = h @ w["c"] + w["d"]
    s = sigmoid(z)
    # softplus losses: l(+1) = log(1 + e^-z), l(-1) = log(1 + e^z)
    minus = np.logaddexp(0, z[n:]).mean() - prior * np.logaddexp(0, z[:n]).mean()
    g = np.empty(len(x))
    if minus >= 0:
        value = prior * np.logaddexp(0, -z[:n]).mean() + minus
        g[:n] = prior * (s[:n] - 1) / n - prior * s[:n] / n
        g[n:] = s[n:] / nu
    else:
        value = -minus
        g[:n] = prior * s[:n] / n
        g[n:] = -s[n:] / nu
    back = np.outer(g, w["c"]) * (1 - h * h)
    value += decay / 2 * ((w["a"] ** 2).sum() + (w["c"] ** 2).sum())
    return value, {"a": x.T @ back + decay * w["a"], "b": back.sum(0),
                   "c": h.T @ g + decay * w["c"], "d": np.array([g.sum()])}


def estimate_prior(positive, unlabelled, sure: float = 0.1, seed: int = 11) -> float:
    """Share of positives among the unlabelled rows, from the two samples alone.

    Scores tell positives from unlabelled rows. Among those above a threshold
    the share of unlabelled rows over the share of positives bounds the prior
    from above, and comes close to it where hardly a negative is above. The
    threshold is the one with the least bound when both shares are only known
    up to their deviation (Hoeffding, probability ``sure``). The scores come
    from a logistic model first, then, since a sharper model leaves fewer
    negatives above, from networks of least risk under the prior found. Two
    folds: each is scored by the model of the other.
    """
    import numpy as np

    rng = np.random.default_rng(seed)
    halves = [[x[f] for f in np.array_split(rng.permutation(len(x)), 2)]
              for x in (positive, unlabelled)]
    if not all(len(f) for x in halves for f in x):
        return 0.5
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3

    def flat(x):
        return np.clip((x - mean) / scale, -8, 8)

    def logistic_scores(p, u):
        w = _logistic(np.concatenate([flat(p), flat(u)]), np.repeat([1.0, 0.0], [len(p), len(u)]))
        return lambda x: flat(x) @ w[:-1] + w[-1]

    def network_scores(p, u):
        model = nonnegative_pu(p, u, prior)
        return lambda x: network_score(model, x)

    for fit in (logistic_scores, network_scores):
        bounds = [_least_bound(*map(fit(halves[0][k], halves[1][k]), (halves[0][1 - k], halves[1][1 - k])),
                               sure) for k in (0, 1)]
        prior = float(np.clip(np.mean(bounds), 0.001, 0.999))
    return prior


def _least_bound(p, u, sure: float) -> float:
    """The least bound of the prior from scores of positives and unlabelled rows."""
    import numpy as np

    cuts = np.unique(np.concatenate([p, u]))
    above_p, above_u = (1 - np.searchsorted(np.sort(x), cuts) / len(x) for x in (p, u))
    spread = sum(np.sqrt(np.log(4 / sure) / (2 * len(x))) for x in (p, u))
    some = above_p > 0
    at = int(np.argmin((above_u[some] + spread) / above_p[some]))
    return float(above_u[some][at] / above_p[some][at])


def _logistic(x, y, rounds: int = 25):
    """Weights (the last is the constant) by Newton steps, classes weighed
    alike, with a ridge."""
    import numpy as np

    x = np.column_stack([x, np.ones(len(x))])
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w = np.zeros(x.shape[1])
    ridge = 1e-3 * len(x) * np.eye(len(w))
    for _ in range(rounds):
        p = sigmoid(x @ w)
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(h, x.T @ (weight * (p - y)) + ridge @ w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def nonnegative_pu(positive, unlabelled, prior: float, epochs: int = 60, step: float = 0.01,
                   seed: int = 7) -> dict:
    """Weights of a one-hidden-layer network minimising the non-negative risk
    (logistic loss, Adam)."""
    import numpy as np

    rng = np.random.default_rng(seed)
    mean = unlabelled.mean(0)
    scale = unlabelled.std(0) + 1e-3
    xp, xu = (positive - mean) / scale, (unlabelled - mean) / scale
    xp, xu = np.clip(xp, -8, 8), np.clip(xu, -8, 8)
    w = {"a": rng.normal(0, 1 / math.sqrt(xp.shape[1]), (xp.shape[1], HIDDEN)),
         "b": np.zeros(HIDDEN), "c": rng.normal(0, 1 / math.sqrt(HIDDEN), HIDDEN), "d": np.zeros(1)}
    m, v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    t, parts = 0, max(1, min(len(xp), len(xu)) // 512)

    for _ in range(epochs):
        for bp, bu in zip(np.array_split(rng.permutation(len(xp)), parts),
                          np.array_split(rng.permutation(len(xu)), parts)):
            grad = pu_step(w, xp[bp], xu[bu], prior)[1]
            t += 1
            for k in w:
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
                w[k] = w[k] - step * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    return w | {"mean": mean, "scale": scale}


def network_score(model: dict, x):
    import numpy as np

    z = np.clip((x - model["mean"]) / model["scale"], -8, 8)
    z = np.tanh(z @ model["a"] + model["b"]) @ model["c"] + model["d"]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", mod: int = 5, held: int = 0, sample: int = SAMPLE,
                prior: float | None = None) -> dict:
    import numpy as np

    frame = text_frame(docs, id_col, text_col)
    learn = fold("doc_id", mod) != held
    marks = (labels.select(F.col(id_col).cast("long").alias("doc_id"),
                           F.col(label_col).cast("int").alias("label"))
             .where(learn & (F.col("label") == 1)))
    picked = (marks.select("doc_id").distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
              .withColumn("label", F.lit(1)))
    total = max(1, frame.count())
    rows = (frame.where(learn)
            .where(F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(1 << 30))
                   < F.lit(int(min(1.0, sample / total) * (1 << 30))))
            .withColumn("label", F.lit(0))
            .unionByName(frame.join(F.broadcast(picked), "doc_id")))  # at most `sample` ids
    # of rows that share an id one is learnt from: 2 * sample rows, about
    rows = rows.groupBy("doc_id", "label").agg(F.max("text").alias("text"))
    found = sorted(features(rows.select("doc_id", "text", "label")).collect(),
                   key=lambda r: r["doc_id"])
    x = {k: np.array([r["x"] for r in found if r["label"] == k]).reshape(-1, N_FEATURES)
         for k in (0, 1)}
    if not len(x[0]) or not len(x[1]):
        return {"constant": 0.5 if prior is None else float(prior)}
    prior = estimate_prior(x[1], x[0]) if prior is None else prior
    return nonnegative_pu(x[1], x[0], min(0.999, max(0.001, float(prior))))


def score_quality(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
                  mod: int = 5, held: int = 0, threshold: float = 0.3) -> DataFrame:
    def run(batches):
        import numpy as np
        import pyarrow as pa

        ids, of_byte, matrix = WordIds(), class_of_byte(), class_matrix()
        for batch in slices(batches):
            x = [describe(data or b"", ids, of_byte, matrix) for data in raw_bytes(batch)]
            if "constant" in model:
                scores = np.full(len(x), model["constant"])
            else:
                scores = network_score(model, np.array(x).reshape(-1, N_FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array((scores >= threshold).astype("int32"), pa.int32())],
                ["doc_id", "held_out", "score", "predicted"])

    frame = text_frame(docs, id_col, text_col)
    frame = frame.withColumn("held_out", F.coalesce(fold("doc_id", mod) == held, F.lit(False)))
    return frame.select("doc_id", "held_out", "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")


def keep_quality(docs: DataFrame, model: dict, text_col: str = "text",
                 threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` (all its columns) that the classifier accepts."""
    @F.arrow_udf("double", F.ArrowUDFType.SCALAR)
    def score(texts):
        import numpy as np
        import pyarrow as pa

        if "constant" in model:
            return pa.array(np.full(len(texts), model["constant"]))
        ids, of_byte, matrix = WordIds(), class_of_byte(), class_matrix()
        out = [np.empty(0)]
        for i in range(0, len(texts), 256):
            x = [describe((t or "").encode(), ids, of_byte, matrix)
                 for t in texts.slice(i, 256).to_pylist()]
            out.append(network_score(model, np.array(x).reshape(-1, N_FEATURES)))
        return pa.array(np.concatenate(out), pa.float64())

    return small_batches(docs).where(score(F.col(text_col).cast("string")) >= threshold)
