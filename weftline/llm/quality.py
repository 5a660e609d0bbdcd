"""Quality scores by Bradley-Terry ranking of labelled documents."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, map_batches, stored, with_results, with_text

#: Where there are at most so many preference pairs, so many are drawn with replacement; beyond, all count alike.
TRAIN_PAIRS = 120_000
N_FEATURES = 20
#: Tasks whose sums the driver adds up itself.
PARTS = 64
_CLASSES = np.zeros(256, np.int64)
for _c in range(256):
    _CLASSES[_c] = (0 if chr(_c) in " \t\n\r\v\f" else 1 if 97 <= _c <= 122 else 2 if 65 <= _c <= 90 else 3 if 48 <= _c <= 57 else 4 if _c >= 128
                    else 5 if chr(_c) in ".,;:'\"-?()" else 6 if chr(_c) == "!" else 7)
#: Scores are spread over Chebyshev nodes of bins of this width. The logistic function's poles are pi off the real line, so 16 nodes leave an error near 1e-13.
WIDTH, NODES = 2.0, 16
_AT = np.cos((2 * np.arange(NODES) + 1) * np.pi / (2 * NODES))
_BASIS = np.polynomial.chebyshev.chebvander(_AT, NODES - 1).T * np.where(np.arange(NODES) > 0, 2, 1)[:, None] / NODES


def features(text: str | None) -> list[float]:
    """What a score may depend on: shapes and repetition of the whole text, ``N_FEATURES`` numbers."""
    data = (text or "").encode("utf-8", "surrogatepass")
    n = len(data)
    counts = np.zeros(8)
    for i in range(0, n, 1 << 20):
        counts += np.bincount(_CLASSES[np.frombuffer(data[i:i + (1 << 20)], np.uint8)], minlength=8)
    words = data.split()
    k = len(words)
    seen = Counter(words)
    lines = [x for x in data.split(b"\n") if x]
    blank, low, up, digit, high, mark, bang, odd = counts / max(1, n)
    distinct = len(seen)
    top = max(seen.values(), default=0)
    adjacent = sum(a == b for a, b in zip(words, words[1:]))
    pairs = Counter(zip(words, words[1:]))
    bare = sum(c for w, c in seen.items() if not any(x >= 128 or 65 <= x <= 90 or 97 <= x <= 122 for x in w))
    stops = sum(c for w, c in seen.items() if w[-1:] in b".?!")
    return [
        np.log1p(n), np.log1p(k), np.log1p(len(lines)), low, up, digit, high, mark, np.sqrt(bang), np.sqrt(odd), blank,
        (n - blank * n) / max(1, k) / 10, distinct / max(1, k), np.log1p(distinct) / np.log1p(max(1, k)), top / max(1, k),
        adjacent / max(1, k - 1), len(pairs) / max(1, k - 1), bare / max(1, k), stops / max(1, k), len(set(lines)) / max(1, len(lines)),
    ]


def fit(x: np.ndarray, y: np.ndarray, n_pairs: int = TRAIN_PAIRS, ridge: float = 1e-3, seed: int = 9) -> dict:
    """Weights from preference pairs (a label 1 over a label 0): logistic loss on feature differences.

    Newton steps on the mean of log(1 + exp(-w (xi - xj))). Up to ``n_pairs`` pairs weigh as often as a draw of
    ``n_pairs`` takes them, once at least; more than that are :func:`fit_sums`'s. The score's zero is the quantile of the
    learning documents' scores at the share of label 0. With one label only, that label's share
    (smoothed) is everybody's score.
    """
    good, bad = np.nonzero(y == 1)[0], np.nonzero(y == 0)[0]
    if not 0 < len(good) * len(bad) <= n_pairs:
        return fit_sums(lambda f: f(x, y), ridge)
    mean, sd = x.mean(0), x.std(0) + 1e-6
    rng = np.random.default_rng(seed)
    z = (x - mean) / sd
    first = np.searchsorted(good, rng.choice(good, n_pairs))
    times = np.bincount(first * len(bad) + np.searchsorted(bad, rng.choice(bad, n_pairs)), minlength=len(good) * len(bad))
    times = np.maximum(times, 1)
    share = times / times.sum()
    d = np.repeat(z[good], len(bad), axis=0) - np.tile(z[bad], (len(good), 1))
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        g = -(d.T @ (p * share)) + ridge * w
        h = (d * (p * (1 - p) * share)[:, None]).T @ d + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    scores = np.sort(_dot(z, w))
    i = min(max(len(bad), 1), len(scores) - 1)
    return {"mean": mean, "sd": sd, "w": w, "zero": float((scores[i - 1] + scores[i]) / 2)}


def fit_sums(total: Callable[[Callable], dict], ridge: float = 1e-3) -> dict:
    """:func:`fit` on all pairs of a label 1 and a label 0, from sums over the documents alone.

    ``total(f)`` adds up ``f(x, y)``, arrays by number, over all parts of the documents. The sum over pairs is one
    over the nodes that scores are spread to, so the work grows with the documents and no part is held
    together with another. Weights are rounded, so that the order of sums doesn't show.
    """
    n, n_good, *x = total(lambda x, y: {0: np.array([len(y), (y == 1).sum(), *x.sum(0)], float)}).get(0, np.zeros(2 + N_FEATURES))
    n_bad = n - n_good
    mean = np.round(np.array(x) / max(n, 1), 12)
    sd = np.round(np.sqrt(total(lambda x, y: {0: ((x - mean) ** 2).sum(0)}).get(0, np.zeros(N_FEATURES)) / max(n, 1)), 12) + 1e-6
    w = np.zeros(len(mean))
    if not n_good or not n_bad:
        rate = (n_good + 0.5) / (n + 1)
        return {"mean": mean, "sd": sd, "w": w, "zero": -float(np.log(rate / (1 - rate)))}
    last, least, step = w, np.inf, np.ones(1)
    for _ in range(100):
        loss, g, curve, cross = pair_sums(total(lambda x, y: spread((x - mean) / sd, y, w)))  # noqa: B023
        loss = loss / n_good / n_bad + ridge / 2 * (w @ w)
        if loss > least + 1e-9:  # too far
            w = (w + last) / 2
            continue
        last, least = w, loss
        if np.abs(step).max() < 1e-6:
            break
        h = total(lambda x, y: {0: curved((x - mean) / sd, y, w, curve)})[0] - cross - cross.T  # noqa: B023
        step = np.linalg.solve(h / n_good / n_bad + ridge * np.eye(len(w)), g / n_good / n_bad + ridge * w)
        w = w - step
    w = np.round(last, 9)
    i = int(min(n_bad, n - 1))
    return {"mean": mean, "sd": sd, "w": w, "zero": sum(at_ranks(total, lambda x: _dot((x - mean) / sd, w), [i - 1, i])) / 2}


def _dot(z: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``z @ w``; a row's value doesn't depend on the rows around it."""
    return (np.ascontiguousarray(z) * w).sum(1)


def _nodes(z: np.ndarray, y: np.ndarray, w: np.ndarray):
    """(key, rows, their weights on the nodes) of every bin and label that occurs; a key is twice the bin, plus the label."""
    s = _dot(z, w) / WIDTH
    low = np.floor(s)
    basis = np.polynomial.chebyshev.chebvander(2 * (s - low) - 1, NODES - 1) @ _BASIS
    keys = 2 * low.astype(np.int64) + (y == 1)
    for key in np.unique(keys):
        at = np.nonzero(keys == key)[0]
        yield int(key), at, basis[at]


def spread(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> dict:
    """By key, for every node: the documents' weight and the weighted sum of their features."""
    return {key: basis.T @ np.column_stack([np.ones(len(at)), z[at]]) for key, at, basis in _nodes(z, y, w)}


def pair_sums(parts: dict):
    """Over all pairs: (loss, gradient, second derivatives by key and node, the mixed part of the second derivatives), from :func:`spread`."""
    keys = {label: sorted(k for k in parts if k % 2 == label) for label in (0, 1)}
    places = {label: np.concatenate([WIDTH * (k // 2 + (_AT + 1) / 2) for k in keys[label]]) for label in keys}
    sums = {label: np.concatenate([parts[k] for k in keys[label]]) for label in keys}
    n0, x0 = sums[0][:, 0], sums[0][:, 1:]
    loss, g, cross = 0.0, np.zeros(x0.shape[1]), np.zeros((x0.shape[1],) * 2)
    curve, curve0 = {}, np.zeros(len(n0))
    for j, key in enumerate(keys[1]):  # a bin of label 1 against all of label 0
        one = slice(j * NODES, (j + 1) * NODES)
        n1, x1 = sums[1][one, 0], sums[1][one, 1:]
        gap = places[0][None, :] - places[1][one, None]
        p = 1 / (1 + np.exp(-np.clip(gap, -700, 700)))
        v = p * (1 - p)
        loss += n1 @ np.logaddexp(0, gap) @ n0
        g += x0.T @ (p.T @ n1) - x1.T @ (p @ n0)
        cross += x1.T @ v @ x0
        curve[key] = v @ n0
        curve0 += v.T @ n1
    return loss, g, curve | {key: curve0[j * NODES:(j + 1) * NODES] for j, key in enumerate(keys[0])}, cross


def curved(z: np.ndarray, y: np.ndarray, w: np.ndarray, curve: dict) -> np.ndarray:
    """The sum of the documents' squares, each by its second derivative."""
    v = np.zeros(len(z))
    for key, at, basis in _nodes(z, y, w):
        v[at] = basis @ curve[key]
    return (z * v[:, None]).T @ z


def at_ranks(total: Callable[[Callable], dict], scored: Callable[[np.ndarray], np.ndarray], ranks: list[int]) -> list[float]:
    """The scores at ``ranks`` (from 0) of all, exact: their bits are found from the highest down by counting."""
    found, done = [(0, r) for r in ranks], 0
    for width in (13, 13, 13, 13, 12):
        def count(x, y, found=found, done=done, width=width):
            bits = (scored(x) + 0.0).view(np.uint64)
            keys = bits ^ np.where(bits >> np.uint64(63), np.uint64(2**64 - 1), np.uint64(1 << 63))  # in the order of the numbers
            digits = ((keys >> np.uint64(64 - done - width)) & np.uint64((1 << width) - 1)).astype(np.int64)
            inside = [keys >> np.uint64(64 - done) == np.uint64(head) if done else np.full(len(keys), True) for head, _ in found]
            return {j: np.bincount(digits[at], minlength=1 << width).astype(float) for j, at in enumerate(inside)}

        counts = total(count)
        for j, (head, rank) in enumerate(found):
            upto = np.cumsum(counts[j])
            digit = int(np.searchsorted(upto, rank, side="right"))
            found = [*found[:j], (head << width | digit, rank - int(upto[digit] - counts[j][digit])), *found[j + 1:]]
        done += width
    keys = np.array([head for head, _ in found], np.uint64)
    return (keys ^ np.where(keys >> np.uint64(63), np.uint64(1 << 63), np.uint64(2**64 - 1))).view(np.float64).tolist()


def score(model: dict, x: np.ndarray) -> np.ndarray:
    """In (0, 1); 0.5 at the quantile."""
    s = _dot((x - model["mean"]) / model["sd"], model["w"]) - model["zero"]
    return 1 / (1 + np.exp(-np.clip(s, -30, 30)))


def labelled_features(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``id``, label ``y`` and features ``x`` of all labelled documents; of rows of one id that with the least features.

    Features meet labels, not texts: what moves is 160 bytes a document, and no table has to fit in memory.
    """
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            got = [features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.list_(pa.float64()))], names=["id", "x"])

    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("id is not null and y in (0, 1)")
    known = known.groupBy("id").agg(F.max("y").alias("y"), F.min("y").alias("y0")).filter("y = y0").select("id", "y")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null")
    schema = T.StructType([T.StructField("id", texts.schema["id"].dataType), T.StructField("x", T.ArrayType(T.DoubleType()))])
    rows = map_batches(texts, run, schema).join(known, "id")
    return rows.groupBy(F.col("id").cast("string").alias("id"), "y").agg(F.min("x").alias("x"))  # one of the rows of an id


def summed(rows: DataFrame, f: Callable) -> dict:
    """``f(x, y)``, arrays by number, added up over all of ``rows`` (``y``, ``x``)."""
    def run(batches):
        import pyarrow as pa

        out = {}
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, N_FEATURES)
            _add(out, f(x, batch.column(0).to_numpy(zero_copy_only=False)).items())
        if out:
            shapes = pa.array([list(v.shape) for v in out.values()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), shapes, pa.array([v.tobytes() for v in out.values()], pa.binary())], names=["key", "shape", "value"])

    def merge(batches):
        import pyarrow as pa

        out, shapes = {}, {}
        for batch in batches:
            for key, shape, value in zip(*(c.to_pylist() for c in batch.columns)):
                _add(out, [(key, np.frombuffer(value))])
                shapes[key] = shape
        yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array([shapes[k] for k in out], pa.list_(pa.int32())), pa.array([v.tobytes() for v in out.values()], pa.binary())], names=["key", "shape", "value"])

    schema = "key long, shape array<int>, value binary"
    got = map_batches(rows.select("y", "x"), run, schema)
    if rows.rdd.getNumPartitions() > PARTS:
        got = map_batches(got.repartition("key"), merge, schema)
    return _add({}, ((r["key"], np.frombuffer(bytes(r["value"])).reshape(r["shape"])) for r in got.collect()))


def _add(out: dict, more) -> dict:
    for key, value in more:
        out[key] = out[key] + value if key in out else value
    return out


def learned(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> dict:
    """The model of all labelled documents, whose features are kept in the checkpoint folder meanwhile."""
    rows = stored(labelled_features(docs, labels, id_col, text_col, label_col))
    n = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if 0 < n.get(0, 0) * n.get(1, 0) <= TRAIN_PAIRS:
        got = sorted(rows.collect(), key=lambda r: r["id"])
        model = fit(np.array([r["x"] for r in got]), np.array([r["y"] for r in got], int))
    else:
        model = fit_sums(lambda f: summed(rows, f))
    discard(rows)
    return model


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Every row of ``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (score >= 0.5).

    Learns from ``labels`` (id, label 0 or 1) by :func:`fit` on all labelled documents; labels that contradict each other or are null are not used. Null and empty
    texts are scored as texts of length 0, very long ones as a whole. A null id is no matter. Repeated rows are kept and score alike. An empty table gives no rows,
    and without labels every score is 0.5. All columns of ``docs`` are kept; those named like the
    two results are replaced.
    """
    model = learned(docs, labels, id_col, text_col, label_col)
    kept = [f for f in docs.schema.fields if f.name.lower() not in ("score", "predicted")]

    given, text_at = with_text(docs, kept, text_col)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            s = score(model, np.array([features(t) for t in texts]).reshape(len(texts), N_FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], names=[*(f.name for f in kept), "score", "predicted"])

    return map_batches(given, run, with_results(kept, ("score", T.DoubleType()), ("predicted", T.IntegerType())))
