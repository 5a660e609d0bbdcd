"""Language identification by a bidirectional gated recurrent network over bytes, in numpy."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, with_results, with_text

#: Labelled documents that training reads at most; each is read whole.
TRAIN_DOCS = 1200
#: Documents of each language in the sample at least, where it has them.
LEAST_DOCS = 50
#: Steps of training, and segments in each; segments are drawn from all of the sample's.
TRAIN_STEPS, TRAIN_BATCH = 500, 192
HIDDEN = 8
#: Bytes of a segment at most: what the network reads in one go. Segments end between characters.
SEGMENT = 96
#: Segments that run through the network together, and bytes that a worker gathers before it runs it.
TOGETHER, GATHERED = 1024, 1 << 20
UNKNOWN = "und"
DIRECTIONS = ("f", "b")


def has_letter(text: str | None) -> bool:
    """Whether any character is a letter (Unicode category L)."""
    return any(map(str.isalpha, text or ""))


def segment_ends(data: np.ndarray, size: int = SEGMENT) -> np.ndarray:
    """Where the segments of a text's UTF-8 bytes end: at most ``size`` bytes each, no character cut."""
    inside = (data & 0xC0) == 0x80
    if not inside.any():
        return np.append(np.arange(size, len(data), size), len(data)) if len(data) else np.zeros(0, np.int64)
    ends, at = [], 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and inside[end] and end > at + 1:
            end -= 1
        ends.append(end)
        at = end
    return np.array(ends, np.int64)


def segments_of(data: bytes, size: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
    """(bytes (segments, size), padded by 0; lengths) of a text's bytes, blanks and case as they are."""
    flat = np.frombuffer(data, np.uint8)
    ends = segment_ends(flat, size)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    sizes = ends - starts
    out = np.zeros((len(ends), size), np.uint8)
    at = np.arange(size)
    real = at < sizes[:, None]
    out[real] = flat
    return out, sizes


def new_model(n_classes: int, hidden: int = HIDDEN, seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    model = {}
    for d in DIRECTIONS:
        model["w" + d] = rng.normal(0, 0.3, (256, 3 * hidden))  # one-hot bytes times input weights
        model["u" + d] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
        model["c" + d] = np.zeros(hidden)
    model["v"] = rng.normal(0, 0.2, (2 * hidden, n_classes))
    model["o"] = np.zeros(n_classes)
    return {k: v.astype(np.float32) for k, v in model.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _direction(model: dict, d: str, x: np.ndarray, sizes: np.ndarray, keep: bool = False):
    """Hidden states (steps, batch, hidden) of one direction over bytes ``x`` (batch, steps); past a segment's size a state stays as it is."""
    batch, steps = x.shape
    u, w, c = model["u" + d], model["w" + d], model["c" + d]
    n, least = u.shape[0], int(sizes.min(initial=steps))
    h, states, saved = np.zeros((batch, n), u.dtype), np.empty((steps, batch, n), u.dtype), []
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        a, g = w[x[:, t]], h @ u
        gates = _sigmoid(a[:, :2 * n] + g[:, :2 * n])
        if t >= least:
            gates[sizes <= t, :n] = 1
        z, r = gates[:, :n], gates[:, n:]
        inner = g[:, 2 * n:] + c
        new = np.tanh(a[:, 2 * n:] + r * inner)
        if keep:
            saved.append((t, h, z, r, inner, new))
        h = new + z * (h - new)
        states[t] = h
    return states, saved


def position_probs(model: dict, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Probabilities of the classes at every position: (steps, batch, classes); 0 past a segment's size."""
    both = np.concatenate([_direction(model, d, x, sizes)[0] for d in DIRECTIONS], axis=2)
    return _softmax(both @ model["v"] + model["o"]) * (np.arange(x.shape[1])[:, None] < sizes)[:, :, None]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def gradients(model: dict, x: np.ndarray, sizes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
    """Mean loss over positions and its gradients, by backpropagation through time."""
    batch, steps = x.shape
    runs = {d: _direction(model, d, x, sizes, True) for d in DIRECTIONS}
    both = np.concatenate([runs[d][0] for d in DIRECTIONS], axis=2)
    p = _softmax(both @ model["v"] + model["o"])
    at, real = np.arange(batch), np.arange(steps)[:, None] < sizes
    share = (real * weight / max(1, int(sizes.sum()))).astype(p.dtype)
    loss = float(-(np.log(p[:, at, y] + 1e-9) * share).sum())
    dl = p.copy()
    dl[:, at, y] -= 1
    dl *= share[:, :, None]
    grad = {"v": np.tensordot(both, dl, ((0, 1), (0, 1))), "o": dl.sum((0, 1))}
    dboth = dl @ model["v"].T
    n = model["uf"].shape[0]
    for k, d in enumerate(DIRECTIONS):
        u, dstates = model["u" + d], dboth[:, :, k * n:(k + 1) * n]
        das, gu, gc, dh = np.empty((steps, batch, 3 * n), u.dtype), np.zeros_like(u), np.zeros(n, u.dtype), np.zeros((batch, n), u.dtype)
        for t, h, z, r, inner, new in reversed(runs[d][1]):
            dh = dh + dstates[t]
            dnew = dh * (1 - z) * (1 - new * new)
            dz = dh * (h - new) * z * (1 - z)  # 0 where the gate was held open
            dr = dnew * inner * r * (1 - r)
            das[t] = np.concatenate([dz, dr, dnew], axis=1)
            dg = np.concatenate([dz, dr, dnew * r], axis=1)
            gu += h.T @ dg
            gc += (dnew * r).sum(0)
            dh = dh * z + dg @ u.T
        bytes_, flat = x.T.ravel(), das.reshape(-1, 3 * n)
        gw = np.stack([np.bincount(bytes_, flat[:, j], 256) for j in range(3 * n)], axis=1).astype(u.dtype)
        grad |= {"w" + d: gw, "u" + d: gu, "c" + d: gc}
    return loss, grad


def train(texts: list[bytes], labels: list[int], n_classes: int, steps: int = TRAIN_STEPS, batch: int = TRAIN_BATCH, seed: int = 5) -> dict:
    """A model fitted by Adam on segments of whole texts and the texts' classes; a text's segments are drawn alike."""
    model, rng = new_model(n_classes, seed=seed), np.random.default_rng(seed)
    parts = [segments_of(t) for t in texts]
    x_all, sizes = np.concatenate([x for x, _ in parts]), np.concatenate([n for _, n in parts])
    y_all = np.repeat(np.array(labels), [len(n) for _, n in parts])
    share = np.bincount(y_all, minlength=n_classes) / max(1, len(y_all))
    weights = 1 / np.maximum(share, 1e-3) ** 0.5
    weights = (weights / (weights * share).sum()).astype(np.float32)
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    for step in range(1, steps + 1) if len(y_all) else ():
        at = rng.integers(0, len(y_all), batch)
        _, grad = gradients(model, x_all[at], sizes[at], y_all[at], weights[y_all[at]])
        rate = 0.02 * (1 - 0.95 * step / steps)
        for name, g in grad.items():
            first[name] += 0.1 * (g - first[name])
            second[name] += 0.005 * (g * g - second[name])
            fix = np.sqrt(1 - 0.995 ** step) / (1 - 0.9 ** step)
            model[name] -= (rate * fix * first[name] / (np.sqrt(second[name]) + 1e-7)).astype(np.float32)
    return model


def document_probs(texts: list[str | None], model: dict, n_classes: int) -> Iterator[np.ndarray | None]:
    """Mean position probabilities of each whole text, a gathering of texts at a time; None where it has no letter."""
    waiting: list[tuple[bool, bytes]] = []
    size = 0
    for text in texts:
        some = has_letter(text)
        waiting.append((some, text.encode("utf-8", "surrogatepass") if some else b""))
        size += len(waiting[-1][1])
        if size >= GATHERED:
            yield from _pooled(waiting, model, n_classes)
            waiting, size = [], 0
    yield from _pooled(waiting, model, n_classes)


def _pooled(texts: list[tuple[bool, bytes]], model: dict, n_classes: int) -> Iterator[np.ndarray | None]:
    parts = [segments_of(data) for _, data in texts]
    x, sizes = np.concatenate([x for x, _ in parts] or [np.zeros((0, SEGMENT), np.uint8)]), np.concatenate([n for _, n in parts] or [np.zeros(0, np.int64)])
    sums = np.zeros((len(sizes), n_classes))
    by_size = np.argsort(sizes, kind="stable")
    for i in range(0, len(by_size), TOGETHER):
        at = by_size[i:i + TOGETHER]
        sums[at] = position_probs(model, x[at, :int(sizes[at].max())], sizes[at]).sum(0, dtype=np.float64)
    done = 0
    for (some, _), (_, own) in zip(texts, parts):
        total = sums[done:done + len(own)].sum(0)
        done += len(own)
        yield total / max(total.sum(), 1e-12) if some else None


def training_texts(docs: DataFrame, id_col: str, text_col: str, lang_col: str, n_docs: int = TRAIN_DOCS) -> list[tuple[str, bytes]]:
    """(language, text) of at most ``n_docs`` labelled documents, those of least hash.

    A language with fewer than ``LEAST_DOCS`` of them (less with many languages) gets its own documents of least hash
    in place of others, so every language of the table is in the sample; ``n_docs`` is passed only by more languages than that.
    """
    labelled = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.lit(3), F.col(id_col).cast("string")).alias("key")).filter("lang is not null and text is not null")
    order = ["key", "lang", F.xxhash64("text")]
    rows = labelled.select("key").orderBy("key").limit(n_docs)
    bound = rows.agg(F.max("key")).first()[0]
    if bound is None:
        return []
    rows = labelled.filter(F.col("key") <= F.lit(bound)).orderBy(*order).limit(n_docs).collect()
    if len(rows) == n_docs:
        counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
        least = max(1, min(LEAST_DOCS, n_docs // len(counts)))
        have = Counter(r["lang"] for r in rows)
        rare = [lang for lang, n in counts.items() if have[lang] < min(least, n)]
        if rare:
            own = least_keys(labelled.filter(F.col("lang").isin(rare)), least)
            extra = labelled.join(F.broadcast(own), (F.col("lang") == F.col("_l")) & (F.col("key") == F.col("_k"))).select("text", "lang", "key").orderBy(*order).limit(least * len(rare)).collect()
            rows = [r for r in rows if r["lang"] not in rare]
            spare, over = Counter(r["lang"] for r in rows), len(rows) + len(extra) - n_docs
            for i in range(len(rows) - 1, -1, -1):
                if over > 0 and spare[rows[i]["lang"]] > least:
                    spare[rows[i]["lang"]] -= 1
                    over -= 1
                    del rows[i]
            rows = sorted([*rows, *extra], key=lambda r: (r["key"], r["lang"], r["text"]))
    return [(r["lang"], r["text"].encode("utf-8", "surrogatepass")) for r in rows]


def least_keys(labelled: DataFrame, n: int) -> DataFrame:
    """The ``n`` least keys of each language as ``_l``, ``_k``; of each task's rows only so many are moved."""
    def run(batches):
        import pyarrow as pa

        found: dict[str, set[int]] = {}
        for batch in batches:
            for lang, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.setdefault(lang, set()).add(key)
            found = {lang: set(sorted(keys)[:n]) for lang, keys in found.items()}
        pairs = [(lang, key) for lang, keys in found.items() for key in keys]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.string()), pa.array([x for _, x in pairs], pa.int64())], names=["lang", "key"])

    firsts = map_batches(labelled.select("lang", "key"), run, "lang string, key long").groupBy(F.col("lang").alias("_l")).agg(F.sort_array(F.collect_set("key")).alias("keys"))
    return firsts.select("_l", F.explode(F.slice("keys", 1, n)).alias("_k"))


def identify(docs: DataFrame, learn: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """Every row of ``docs`` with ``lang_pred`` and ``score``, the pooled probability of that language.

    The network is trained on the driver from a sample of ``learn`` of at most ``TRAIN_DOCS`` rows, which it reads
    whole; ``docs`` gives only texts. A text's bytes are read as they are, blanks and case included, in segments of up to
    ``SEGMENT`` bytes that end between characters; every position of a whole text, however long, is labelled, and the document's
    probabilities are the mean over them. Null, empty and blank texts and texts without a letter are ``und`` with score 0, as is everything when nothing
    can be learnt; ties take the first language by code point. Repeated rows are kept and get equal results; an empty table gives no rows. A null id is no matter.
    All columns of ``docs`` are kept; those named like the two results are replaced.
    """
    sample = training_texts(learn, id_col, text_col, lang_col)
    langs = sorted({lang for lang, _ in sample})
    known = [(t, langs.index(lang)) for lang, t in sample if t]
    model = train([t for t, _ in known], [y for _, y in known], len(langs)) if known else None
    kept = [f for f in docs.schema.fields if f.name.lower() not in (pred_col.lower(), score_col.lower())]

    given, text_at = with_text(docs, kept, text_col)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            probs = list(document_probs(texts, model, len(langs))) if model else [None] * len(texts)
            names = [UNKNOWN if p is None else langs[int(np.argmax(p))] for p in probs]
            scores = [0.0 if p is None else min(1.0, float(p.max())) for p in probs]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(names), pa.array(scores, pa.float64())], names=[*(f.name for f in kept), pred_col, score_col])

    return map_batches(given, run, with_results(kept, (pred_col, T.StringType()), (score_col, T.DoubleType())))
