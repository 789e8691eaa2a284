"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of a text in windows, forward and backward, and
gives every position a distribution over the learned languages. A document's
probability is the mean over all its positions. Weights are learned here, in numpy,
by backpropagation through time over a sample of labelled windows whose size is
bounded by parameters (documents per language, windows per document); prediction
covers every byte of every text, row by row, without a shuffle.

The sample is drawn by a hash of the id, per language, so no language is missed and
the same rows give the same network. Null texts and texts without a letter are
``und`` with score 0, and so is everything when there is nothing to learn from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HIDDEN, WINDOW = 12, 64
DOCS_PER_LANGUAGE, WINDOWS_PER_DOC, MAX_LANGUAGES = 400, 16, 500
BATCH, STEPS, RATE = 512, 240, 0.012
LANES = 2048
UNKNOWN = "und"


def _squash(x: np.ndarray) -> np.ndarray:
    """In place; a rational curve from -1 to 1 close to the hyperbolic tangent, flat beyond 3."""
    np.clip(x, -3, 3, out=x)
    square = x * x
    x *= square + np.float32(27)
    square *= np.float32(9)
    square += np.float32(27)
    x /= square
    return x


def _slope(x: np.ndarray) -> np.ndarray:
    """Derivative of :func:`_squash` at x."""
    square = np.clip(x, -3, 3) ** 2
    return (square - 9) ** 2 / (9 * (square + 3) ** 2)


def _gate(x: np.ndarray) -> np.ndarray:
    """In place; from 0 to 1, the logistic shape of the same curve."""
    x *= np.float32(0.5)
    _squash(x)
    x += np.float32(1)
    x *= np.float32(0.5)
    return x


@dataclass
class Network:
    """Weights by direction (forward, backward): input rows per byte, recurrent, candidate bias; and the output."""

    languages: list[str]
    inputs: list[np.ndarray]      # (256, 3 * hidden): update, reset and candidate parts
    recurrent: list[np.ndarray]   # (3 * hidden, hidden)
    bias: list[np.ndarray]        # (hidden, 1)
    output: np.ndarray            # (languages, 2 * hidden)
    level: np.ndarray             # (languages, 1)

    @staticmethod
    def fresh(languages: list[str], hidden: int, seed: int) -> "Network":
        rng, c = np.random.default_rng(seed), len(languages)
        normal = lambda *shape: rng.standard_normal(shape).astype(np.float32)
        return Network(languages, [normal(256, 3 * hidden) * 0.3 for _ in "fb"],
                       [normal(3 * hidden, hidden) * np.float32(0.6 / hidden ** 0.5) for _ in "fb"],
                       [np.zeros((hidden, 1), np.float32) for _ in "fb"],
                       normal(c, 2 * hidden) * 0.1, np.zeros((c, 1), np.float32))

    def parts(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, *self.bias, self.output, self.level]


def _walk(net: Network, d: int, data: np.ndarray, mask: np.ndarray | None, keep: list | None) -> np.ndarray:
    """States (steps, hidden, lanes) of one direction over bytes (steps, lanes); ``keep`` gathers what learning needs."""
    steps, lanes = data.shape
    hidden = net.bias[d].shape[0]
    table = np.ascontiguousarray(net.inputs[d].T)
    u, bias = net.recurrent[d], net.bias[d]
    states = np.empty((steps, hidden, lanes), np.float32)
    h = np.zeros((hidden, lanes), np.float32)
    x = np.empty((3 * hidden, lanes), np.float32)
    g = np.empty((3 * hidden, lanes), np.float32)
    for t in (range(steps) if d == 0 else range(steps - 1, -1, -1)):
        np.take(table, data[t], axis=1, out=x, mode="clip")
        np.matmul(u, h, out=g)
        gates = x[:2 * hidden]
        gates += g[:2 * hidden]
        before = gates.copy() if keep is not None else None
        _gate(gates)
        z, r, q = gates[:hidden], gates[hidden:], g[2 * hidden:]
        q += bias
        n = r * q
        n += x[2 * hidden:]
        slopes = (_slope(before / 2) / 4, _slope(n)) if keep is not None else None
        _squash(n)
        if keep is not None:
            keep.append((t, h.copy(), z.copy(), r.copy(), n.copy(), q.copy(), *slopes))
        h = states[t]
        previous = states[t + 1 if d else t - 1] if t != (steps - 1 if d else 0) else np.zeros_like(n)
        np.subtract(previous, n, out=h)
        h *= z
        h += n
        if mask is not None:
            h *= mask[t]
    return states


def position_probabilities(net: Network, data: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
    """(steps, languages, lanes): the distribution at every position."""
    steps, lanes = data.shape
    both = np.concatenate([_walk(net, 0, data, None, None), _walk(net, 1, data, mask, None)], axis=1)
    p = np.matmul(net.output, both)
    p += net.level
    p -= p.max(axis=1, keepdims=True)
    np.exp(p, out=p)
    p /= p.sum(axis=1, keepdims=True)
    return p


def _gradients(net: Network, data: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over all positions of full windows, and its gradient, through time."""
    steps, lanes = data.shape
    hidden = net.bias[0].shape[0]
    kept: list[list] = [[], []]
    both = np.concatenate([_walk(net, d, data, None, kept[d]) for d in (0, 1)], axis=1)
    p = np.matmul(net.output, both) + net.level
    p -= p.max(axis=1, keepdims=True)
    np.exp(p, out=p)
    p /= p.sum(axis=1, keepdims=True)
    lane = np.arange(lanes)
    loss = -float(np.log(p[:, labels, lane] + 1e-9).mean())
    p[:, labels, lane] -= 1
    p /= steps * lanes
    g_output = np.einsum("tcn,thn->ch", p, both, optimize=True)
    g_level = p.sum(axis=(0, 2))[:, None]
    back = np.matmul(net.output.T, p)
    g_inputs, g_recurrent, g_bias = [], [], []
    for d in (0, 1):
        u = net.recurrent[d]
        gu, gb = np.zeros_like(u), np.zeros_like(net.bias[d])
        into = np.empty((steps, 3 * hidden, lanes), np.float32)
        flow = np.zeros((hidden, lanes), np.float32)
        for t, h, z, r, n, q, of_gates, of_n in reversed(kept[d]):
            flow = flow + back[t, d * hidden:(d + 1) * hidden]
            dn = flow * (1 - z) * of_n
            dq = dn * r
            gates = np.concatenate([flow * (h - n) * of_gates[:hidden], dn * q * of_gates[hidden:], dq])
            into[t, :2 * hidden], into[t, 2 * hidden:] = gates[:2 * hidden], dn
            gu += gates @ h.T
            gb += dq.sum(axis=1, keepdims=True)
            flow = flow * z + u.T @ gates
        flat = data.ravel()
        g_inputs.append(np.stack([np.bincount(flat, into[:, k].ravel(), 256) for k in range(3 * hidden)], axis=1))
        g_recurrent.append(gu)
        g_bias.append(gb)
    return loss, [*g_inputs, *g_recurrent, *g_bias, g_output, g_level]


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str], hidden: int = HIDDEN, steps: int = STEPS,
        batch: int = BATCH, rate: float = RATE, seed: int = 20) -> Network:
    """Learn from windows of bytes (n, window) and the number of the language of each."""
    net, rng = Network.fresh(languages, hidden, seed), np.random.default_rng(seed)
    parts = net.parts()
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    share = 1 / np.bincount(labels, minlength=len(languages))[labels]  # every language equally often
    share /= share.sum()
    for step in range(1, steps + 1):
        pick = rng.choice(len(windows), batch, p=share)
        _, grads = _gradients(net, np.ascontiguousarray(windows[pick].T), labels[pick])
        size = np.sqrt(sum(float((g * g).sum()) for g in grads))
        now = rate * min(1.0, 2 * (1 - (step - 1) / steps))
        for p, g, m, v in zip(parts, grads, first, second):
            g = (g * min(1.0, 1.0 / (size + 1e-9))).astype(np.float32)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return net


def _windows(raw: bytes, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text as rows of windows, and where each starts to count; the last reaches back to be full."""
    data = np.frombuffer(raw, np.uint8)
    whole = len(data) // window
    if len(data) == whole * window:
        return data.reshape(whole, window), np.zeros(whole, np.int64)
    if whole == 0:
        return np.pad(data, (0, window - len(data)))[None, :], np.zeros(1, np.int64)
    last = data[-window:][None, :]
    return (np.concatenate([data[:whole * window].reshape(whole, window), last]),
            np.append(np.zeros(whole, np.int64), window - (len(data) - whole * window)))


def predict(net: Network, texts: list[str], window: int = WINDOW, lanes: int = LANES,
            labels: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
    """Mean probabilities (texts, languages) over all bytes, and the best language of every byte if wanted."""
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    cut = [_windows(r, window) for r in raws]
    rows = np.concatenate([c[0] for c in cut])
    starts = np.concatenate([c[1] for c in cut])
    owner = np.repeat(np.arange(len(texts)), [len(c[0]) for c in cut])
    ends = np.full(len(rows), window)
    for i, (r, c) in enumerate(zip(raws, cut)):
        if len(r) < window:
            ends[np.searchsorted(owner, i)] = len(r)
    sums = np.zeros((len(rows), len(net.languages)))
    best = np.empty((len(rows), window), np.int32) if labels else None
    for at in range(0, len(rows), lanes):
        some = slice(at, at + lanes)
        data = np.ascontiguousarray(rows[some].T)
        mask = None
        if (ends[some] < window).any():
            mask = (np.arange(window)[:, None] < ends[some][None, :]).astype(np.float32)
        p = position_probabilities(net, data, mask)
        odd = np.flatnonzero((starts[some] > 0) | (ends[some] < window))
        sums[some] = p.sum(axis=0, dtype=np.float64).T
        for i in odd.tolist():
            sums[at + i] = p[starts[at + i]:ends[at + i], :, i].sum(axis=0, dtype=np.float64)
        if labels:
            best[some] = p.argmax(axis=1).T
    total = np.zeros((len(texts), len(net.languages)))
    np.add.at(total, owner, sums)
    sizes = np.array([max(1, len(r)) for r in raws])
    marks = []
    if labels:
        cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
        marks = [np.concatenate([best[k, starts[k]:ends[k]] for k in range(a, b)]) for a, b in zip(cuts, cuts[1:])]
    return total / sizes[:, None], marks


# ---------------------------------------------------------------- over tables

def learn(docs: DataFrame, usable: Column, text: str = "text", lang: str = "lang", id_column: str = "doc_id",
          per_language: int = DOCS_PER_LANGUAGE, per_doc: int = WINDOWS_PER_DOC, max_languages: int = MAX_LANGUAGES,
          window: int = WINDOW, seed: int = 20, **settings) -> Network:
    """Network fitted on windows of at most ``per_language`` documents of each language among the usable rows."""
    rows = docs.where(usable & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.pmod(F.xxhash64(F.lit(seed), id_column), F.lit(1 << 40)).alias("h"))
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().limit(max_languages + 1).collect()}
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not sizes:
        return Network.fresh([], HIDDEN, seed)
    languages = sorted(sizes)
    # half as many again as wanted on average, so that the cut below is rarely short
    below = F.create_map(*[F.lit(x) for l in languages
                           for x in (l, min(1 << 40, int((1 << 40) * 1.5 * per_language / sizes[l]) + 1))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, hashes, rows = [], [], []
            for l, t, h in zip(*(batch.column(c).to_pylist() for c in ("lang", "text", "h"))):
                raw = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)
                if len(raw) < window:
                    raw = np.resize(raw, window) if len(raw) else np.full(window, 32, np.uint8)
                starts = np.random.default_rng(h).integers(0, len(raw) - window + 1, per_doc)
                langs.append(l)
                hashes.append(h)
                rows.append(b"".join(raw[s:s + window].tobytes() for s in starts))
            yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()), "h": pa.array(hashes, pa.int64()),
                                              "windows": pa.array(rows, pa.binary())})

    drawn = rows.where(F.col("h") < below[F.col("lang")]).mapInArrow(cut, "lang string, h long, windows binary").collect()
    by: dict[str, list] = {l: [] for l in languages}
    for r in drawn:
        by[r.lang].append((r.h, bytes(r.windows)))
    data, labels = [], []
    for k, l in enumerate(languages):
        chosen = sorted(by[l])[:per_language]
        data += [np.frombuffer(w, np.uint8).reshape(-1, window) for _, w in chosen]
        labels += [np.full(per_doc * len(chosen), k)]
    return fit(np.concatenate(data), np.concatenate(labels), languages, seed=seed, **settings)


def identify(docs: DataFrame, net: Network, text: str = "text", id_column: str = "doc_id",
             spans: bool = True) -> DataFrame:
    """Per row: doc_id, lang_pred, score and, if wanted, ``spans``: runs (start byte, end byte, language) of a text."""
    picked = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            runs: list[list | None] = [[] for _ in texts]
            known = [i for i, t in enumerate(texts) if net.languages and t and any(map(str.isalpha, t))]
            at = 0
            while at < len(known):
                stop, chars = at, 0
                while stop < len(known) and (chars == 0 or chars + len(texts[known[stop]]) <= 1_000_000):
                    chars += len(texts[known[stop]])
                    stop += 1
                some = known[at:stop]
                p, marks = predict(net, [texts[i] for i in some], labels=spans)
                for k, i in enumerate(some):
                    best = int(p[k].argmax())
                    names[i], scores[i] = net.languages[best], min(1.0, float(p[k, best]))
                    if spans:
                        cuts = [0, *(np.flatnonzero(np.diff(marks[k])) + 1).tolist(), len(marks[k])]
                        runs[i] = [{"start": a, "end": b, "lang": net.languages[marks[k][a]]} for a, b in zip(cuts, cuts[1:])]
                at = stop
            made = {"doc_id": batch.column("doc_id"), "lang_pred": pa.array(names, pa.string()),
                    "score": pa.array(scores, pa.float64())}
            if spans:
                made["spans"] = pa.array(runs, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])))
            yield pa.RecordBatch.from_pydict(made)

    schema = "doc_id long, lang_pred string, score double" + ", spans array<struct<start:int,end:int,lang:string>>" * spans
    return picked.mapInArrow(run, schema)
