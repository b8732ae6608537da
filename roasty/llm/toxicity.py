"""Toxicity scores from a bidirectional gated recurrent network.

A text is read in overlapping windows of words. A word's input is an embedding
of the word beside the mean embedding of its character trigrams; two gated
recurrent passes, one each way, give a state per word; attention pools the
states of a window into one vector and that into a score. A document's score
is that of its worst window. The network is trained here, in numpy, on a
bounded sample of labelled documents; the loss of a document goes through its
worst window alone, since a label says that some part is toxic, not which.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roasty.llm.common import text_key

WINDOW = 64
STRIDE = 48
WORD_BUCKETS = 1 << 15
CHAR_BUCKETS = 1 << 13
EMBED = 12
HIDDEN = 10
ATTENTION = 10

#: Training sample: so many documents of each label at most, whole ones, of at
#: most so many characters each on average: 4.5 million characters a label.
TRAIN_DOCS = 1500
TRAIN_CHARS = 3000
EPOCHS = 6
BATCH_DOCS = 48
RATE = 0.01

#: Words whose inputs a scoring task keeps.
CACHED_WORDS = 120_000
#: Windows scored at once.
BATCH_WINDOWS = 1024
THRESHOLD = 0.3

WORD = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def windows(n: int) -> list[int]:
    """Starts of the windows that cover ``n`` words."""
    return list(range(0, max(1, n - (WINDOW - STRIDE)), STRIDE)) if n else []


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte trigrams of the marked words, and where each
    word's begin."""
    raw = [b"<" + w.encode("utf-8", "surrogatepass") + b">" for w in words]
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    sizes = np.array([len(r) for r in raw])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    with np.errstate(over="ignore"):
        h = data[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ data[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) ^ data[2:] * np.uint64(0x165667B19E3779F9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    bucket = (h >> np.uint64(40)).astype(np.int64) % CHAR_BUCKETS
    inside = np.ones(len(data), bool)  # a trigram lies within one word
    ends = starts + sizes
    inside[ends - 1] = inside[ends - 2] = False
    kept = bucket[inside[: len(bucket)]]
    counts = sizes - 2
    return kept, np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)


def word_buckets(words: list[str]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORD_BUCKETS for w in words), np.int64, len(words))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        f = lambda *shape, s=0.1: (r.standard_normal(shape) * s).astype(np.float32)
        self.p = {"words": f(WORD_BUCKETS, EMBED), "chars": f(CHAR_BUCKETS, EMBED)}
        for d in "fb":
            self.p |= {f"W{d}": f(2 * EMBED, 3 * HIDDEN, s=0.3), f"U{d}": f(HIDDEN, 3 * HIDDEN, s=0.3), f"b{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"A": f(2 * HIDDEN, ATTENTION, s=0.3), "a": np.zeros(ATTENTION, np.float32), "v": f(ATTENTION, s=0.3),
                   "w": f(2 * HIDDEN, s=0.3), "c": np.zeros(1, np.float32)}
        self.bias = 0.0

    def inputs(self, words: list[str]) -> np.ndarray:
        """Word and character embedding of each word, side by side."""
        grams, at = trigrams(words)
        sums = np.add.reduceat(self.p["chars"][grams], at, axis=0)
        counts = np.diff(np.append(at, len(grams)))
        return np.concatenate([self.p["words"][word_buckets(words)], sums / counts[:, None]], axis=1)

    def projected(self, x: np.ndarray) -> np.ndarray:
        """What the gates of both directions get from each input."""
        return np.concatenate([x @ self.p["Wf"] + self.p["bf"], x @ self.p["Wb"] + self.p["bb"]], axis=1)

    def _pass(self, gates: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        n, length, _ = gates.shape
        u, h = self.p[f"U{d}"], np.zeros((n, HIDDEN), np.float32)
        out = np.empty((n, length, HIDDEN), np.float32)
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            g, hu, m = gates[:, t], h @ u, mask[:, t, None]
            zr = sigmoid(g[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(g[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            new = np.where(m, c + z * (h - c), h)
            if keep is not None:
                keep.append((t, h, z, r, c, hu[:, 2 * HIDDEN :]))
            out[:, t] = h = new
        return out

    def forward(self, gates: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of each window; ``gates`` (windows, words, 6 * HIDDEN)."""
        steps = ([], []) if keep is not None else (None, None)
        half = 3 * HIDDEN
        s = np.concatenate([self._pass(gates[..., :half], mask, "f", steps[0]), self._pass(gates[..., half:], mask, "b", steps[1])], axis=2)
        e = np.tanh(s @ self.p["A"] + self.p["a"])
        score = np.where(mask, e @ self.p["v"], -1e9)
        weight = np.exp(score - score.max(axis=1, keepdims=True))
        weight /= weight.sum(axis=1, keepdims=True)
        pooled = (weight[..., None] * s).sum(axis=1)
        if keep is not None:
            keep |= {"steps": steps, "s": s, "e": e, "weight": weight, "pooled": pooled, "mask": mask}
        return pooled @ self.p["w"] + self.p["c"][0]

    def backward(self, keep: dict, dlogit: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the dense parameters, and of the gates' inputs."""
        g: dict[str, np.ndarray] = {"w": keep["pooled"].T @ dlogit, "c": dlogit.sum(keepdims=True)}
        s, e, weight, mask = keep["s"], keep["e"], keep["weight"], keep["mask"]
        dpool = dlogit[:, None] * self.p["w"]
        ds = weight[..., None] * dpool[:, None]
        dw = (s * dpool[:, None]).sum(axis=2)
        dscore = weight * (dw - (weight * dw).sum(axis=1, keepdims=True)) * mask
        g["v"] = np.einsum("nt,nta->a", dscore, e)
        dpre = dscore[..., None] * self.p["v"] * (1 - e * e)
        g["A"], g["a"] = np.einsum("nth,nta->ha", s, dpre), dpre.sum(axis=(0, 1))
        ds = ds + dpre @ self.p["A"].T
        dgates = np.zeros((*mask.shape, 6 * HIDDEN), np.float32)
        for k, d in enumerate("fb"):
            u, dh = self.p[f"U{d}"], np.zeros((len(mask), HIDDEN), np.float32)
            du = np.zeros_like(u)
            for t, h, z, r, c, hn in reversed(keep["steps"][k]):
                m = mask[:, t, None]
                dnew = dh + ds[:, t, k * HIDDEN : (k + 1) * HIDDEN]
                live = dnew * m
                dc = live * (1 - z) * (1 - c * c)
                dz = live * (h - c) * z * (1 - z)
                dr = dc * hn * r * (1 - r)
                dgate = np.concatenate([dz, dr, dc], axis=1)
                dgates[:, t, k * 3 * HIDDEN : (k + 1) * 3 * HIDDEN] = dgate
                dhu = np.concatenate([dz, dr, dc * r], axis=1)
                du += h.T @ dhu
                dh = live * z + dhu @ u.T + dnew * (1 - m)
            g[f"U{d}"] = du
        return g, dgates


def _windowed(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word indexes (windows, WINDOW), mask, and the text of each window."""
    rows, owner = [], []
    for i, a in enumerate(ids):
        for s in windows(len(a)):
            rows.append(a[s : s + WINDOW])
            owner.append(i)
    sizes = np.array([len(r) for r in rows], np.int64)
    index = np.zeros((len(rows), WINDOW), np.int64)
    mask = np.arange(WINDOW) < sizes[:, None]
    if rows:
        index[mask] = np.concatenate(rows)
    return index, mask, np.array(owner, np.int64)


def train(texts: list[str], labels: list[int], seed: int = 7, epochs: int = EPOCHS) -> Network:
    """A network fitted to whole texts; the same for the same arguments. One
    label alone gives a network that always returns it."""
    net = Network(seed)
    words = [tokens(t) for t in texts]
    used = [i for i, w in enumerate(words) if w]
    y = np.array(labels, np.float32)
    if len({int(y[i]) for i in used}) < 2:
        net.p["w"][:] = 0
        net.p["c"][0] = 10 if used and y[used[0]] else -10
        return net
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    order, step = np.random.default_rng(seed), 0
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        order.shuffle(used)
        for k in range(0, len(used), BATCH_DOCS):
            step += 1
            docs = used[k : k + BATCH_DOCS]
            vocab = {w: j for j, w in enumerate(dict.fromkeys(w for i in docs for w in words[i]))}
            index, mask, owner = _windowed([np.fromiter(map(vocab.__getitem__, words[i]), np.int64) for i in docs])
            names = list(vocab)
            x = net.inputs(names)
            gates = net.projected(x)
            logits = np.concatenate([
                net.forward(gates[index[j : j + BATCH_WINDOWS]], mask[j : j + BATCH_WINDOWS]) for j in range(0, len(index), BATCH_WINDOWS)
            ])
            worst = np.array([np.flatnonzero(owner == j)[logits[owner == j].argmax()] for j in range(len(docs))])
            keep: dict = {}
            logits = net.forward(gates[index[worst]], mask[worst], keep)
            grads, dgates = net.backward(keep, ((sigmoid(logits) - y[docs]) / len(docs)).astype(np.float32))
            dproj = np.zeros_like(gates)
            np.add.at(dproj, index[worst][mask[worst]], dgates[mask[worst]])
            half = 3 * HIDDEN
            for d, part in (("f", dproj[:, :half]), ("b", dproj[:, half:])):
                grads[f"W{d}"], grads[f"b{d}"] = x.T @ part, part.sum(axis=0)
            dx = dproj[:, :half] @ net.p["Wf"].T + dproj[:, half:] @ net.p["Wb"].T
            live = np.abs(dx).sum(axis=1) > 0
            some = [n for n, on in zip(names, live, strict=True) if on]
            sparse = {}
            if some:
                dx = dx[live]
                grams, at = trigrams(some)
                counts = np.diff(np.append(at, len(grams)))
                sparse = {"words": (word_buckets(some), dx[:, :EMBED]), "chars": (grams, np.repeat(dx[:, EMBED:] / counts[:, None], counts, axis=0))}
            # Adam; embeddings only where words were seen.
            for name, grad in grads.items():
                _adam(net.p[name], *moments[name], grad, rate, step)
            for name, (rows, grad) in sparse.items():
                where, back = np.unique(rows, return_inverse=True)
                total = np.zeros((len(where), EMBED), np.float32)
                np.add.at(total, back, grad)
                m, v = moments[name][0][where], moments[name][1][where]
                value = net.p[name][where]
                _adam(value, m, v, total, rate, step)
                net.p[name][where], moments[name][0][where], moments[name][1][where] = value, m, v
    return net


def _adam(value: np.ndarray, m: np.ndarray, v: np.ndarray, grad: np.ndarray, rate: float, step: int) -> None:
    m += 0.1 * (grad - m)
    v += 0.01 * (grad * grad - v)
    value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)


class Scorer:
    """Scores texts with a trained network; keeps the inputs of words seen."""

    def __init__(self, net: Network):
        self.net = net
        self._reset()

    def _reset(self) -> None:
        self.row: dict[str, int] = {}
        self.gates = np.zeros((0, 6 * HIDDEN), np.float32)

    def _rows(self, words: list[list[str]]) -> list[np.ndarray]:
        new = set().union(*words).difference(self.row)
        if len(self.row) + len(new) > CACHED_WORDS:
            self._reset()
            new = set().union(*words)
        if new:
            names = sorted(new)
            self.gates = np.concatenate([self.gates, self.net.projected(self.net.inputs(names)).astype(np.float32)])
            self.row.update(zip(names, range(len(self.row), len(self.row) + len(names)), strict=True))
        return [np.fromiter(map(self.row.__getitem__, w), np.int64, len(w)) for w in words]

    def __call__(self, texts: list[str | None]) -> list[float]:
        out = np.zeros(len(texts))
        words = [tokens(t) for t in texts]
        index, mask, owner = _windowed(self._rows(words))
        for k in range(0, len(index), BATCH_WINDOWS):
            part = slice(k, k + BATCH_WINDOWS)
            s = sigmoid(self.net.forward(self.gates[index[part]], mask[part]).astype(np.float64))
            np.maximum.at(out, owner[part], s)
        return out.tolist()


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null id is not one."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[list[str], list[int]]:
    """The training texts and labels: of each label, of the documents that
    have it and a text, TRAIN_DOCS at most in the order of their hashes, as
    whole texts, without those that the rest of the label's TRAIN_DOCS *
    TRAIN_CHARS characters does not hold (the shortest text if it holds none).
    Only those bounded lists reach the driver. A label that no document with a
    word has is not learned: the network then knows the other one alone."""
    known = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("_lid")).agg(F.max(label_col).cast("int").alias("_label"))
    )
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).filter(F.length("_text") > 0)
    # Ids and lengths alone meet the labels; repeated rows count once.
    usable = (
        own.select("_id", text_key(F.col("_text")).alias("_key"), F.length("_text").alias("_n"))
        .join(known, F.col("_id") == F.col("_lid")).groupBy("_id", "_key").agg(F.max("_n").alias("_n"), F.max("_label").alias("_label"))
    )
    chosen = []
    for label in (0, 1):
        has = usable.filter(F.col("_label") == label)
        room, taken = TRAIN_DOCS * TRAIN_CHARS, []
        for r in has.orderBy(F.xxhash64("_id"), "_id", "_key").limit(TRAIN_DOCS * 4).collect():
            if r["_n"] <= room and len(taken) < TRAIN_DOCS:
                taken.append((r["_id"], r["_key"], label))
                room -= r["_n"]
        chosen += taken or [(r["_id"], r["_key"], label) for r in has.orderBy("_n", "_id", "_key").limit(1).collect()]
    texts, marks = [], []
    if chosen:
        wanted = docs.sparkSession.createDataFrame(chosen, f"_wid {dict(docs.dtypes)[id_col]}, _wkey long, _label int")
        same = (F.col("_id") == F.col("_wid")) & (text_key(F.col("_text")) == F.col("_wkey"))
        rows = own.join(F.broadcast(wanted), same).dropDuplicates(["_id", "_wkey"])
        for r in rows.orderBy("_label", F.xxhash64("_id"), "_id", "_wkey").select("_text", "_label").collect():
            texts.append(r["_text"])
            marks.append(r["_label"])
    return texts, marks


#: The scorer of the network a worker process used last.
_LAST: list[Scorer] = []


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Per row of ``docs``: ``id_col, held_out, score, predicted``.

    A null or empty text, or one without words, scores 0. Null ids and labels
    are not learned from; of repeated labels of an id the largest counts;
    without labels, or with one label only (also one that documents with words
    have, beside one that none has), all texts with words get the same score.
    Repeated rows score alike. Other columns are ignored."""
    net = train(*sample(docs, labels, id_col, text_col, label_col))
    model = docs.sparkSession.sparkContext.broadcast(net)  # 2 MB, fixed by the parameters above
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _LAST or _LAST[0].net is not model.value:
            _LAST[:] = [Scorer(model.value)]
        scorer = _LAST[0]
        for b in batches:
            texts = b.column(1).to_pylist()
            start = size = 0
            for i, t in enumerate(texts):
                size += len(t or "")
                if size >= 1_000_000 or i == len(texts) - 1:
                    got = scorer(texts[start : i + 1])
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(start, i + 1 - start), pa.array(got, pa.float64())], ["_id", "score"])
                    start, size = i + 1, 0

    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    got = own.mapInArrow(run, f"_id {id_type}, score double")
    return got.select(
        F.col("_id").alias(id_col), held_out(F.col("_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
