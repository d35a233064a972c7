"""Language identification with a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes (the last one ends with the text and
overlaps its neighbour; only new positions count). Two gated recurrent layers read a window, one
from each end; from both states every position gets a probability per language. A document's
probabilities are the mean over its positions. Windows do not share state, so a text of any length
needs the memory of a few thousand windows, and every byte of it is read.

The network is trained in numpy by backpropagation through time, on the driver, from windows of a
bounded sample: ``SAMPLE_DOCS`` documents shared by all languages, up to ``TRAIN_DOCS`` of each, in hash
order, and of each document up to ``DOC_WINDOWS`` windows drawn over its whole text. Every language is
learned; with their number grow the hidden units and the training steps. Only text and language are read;
identifiers choose the sample and nothing else.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import documents, prepare, slices, utf8

WINDOW = 64
HIDDEN = 8
TRAIN_DOCS = 400
DOC_WINDOWS = 12
SAMPLE_DOCS = 51_200  # documents of the sample, at least one of each language
STEPS = 400
BATCH = 256
CHUNK = 4096  # windows that are read at once
UNKNOWN = "und"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


class Network:
    """Weights of both directions and of the output layer; float32 throughout."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.langs, self.hidden = langs, hidden
        self.weights: dict[str, np.ndarray] = {}
        for d in "fb":
            self.weights[f"{d}_in"] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
            self.weights[f"{d}_rec"] = rng.normal(0, hidden ** -0.5, (hidden, 3 * hidden)).astype(np.float32)
            self.weights[f"{d}_out"] = rng.normal(0, hidden ** -0.5, (hidden, len(langs))).astype(np.float32)
        self.weights["bias"] = np.zeros(len(langs), np.float32)

    def _read(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States (steps, rows, hidden) of one direction over bytes ``x`` (steps, rows)."""
        table, rec, n = self.weights[f"{d}_in"], self.weights[f"{d}_rec"], self.hidden
        steps, rows = x.shape
        states = np.empty((steps, rows, n), np.float32)
        h = np.zeros((rows, n), np.float32)
        u, gates = np.empty((rows, 3 * n), np.float32), np.empty((rows, 2 * n), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            a = table[x[t]]
            np.matmul(h, rec, out=u)
            np.add(a[:, :2 * n], u[:, :2 * n], out=gates)
            z, r = _sigmoid(gates)[:, :n], gates[:, n:]
            new = r * u[:, 2 * n:]
            new += a[:, 2 * n:]
            np.tanh(new, out=new)
            if keep is not None:
                keep.append((t, h.copy(), z.copy(), r.copy(), new.copy(), u[:, 2 * n:].copy()))
            h = states[t]
            prev = states[t - 1 if d == "f" else t + 1] if 0 <= (t - 1 if d == "f" else t + 1) < steps else 0
            np.subtract(prev, new, out=h)
            h *= z
            h += new
        return states

    def probabilities(self, x: np.ndarray, kept: dict | None = None) -> np.ndarray:
        """(steps, rows, languages) for bytes (steps, rows): a label for every position."""
        w = self.weights
        total = w["bias"]
        for d in "fb":
            trail: list | None = [] if kept is not None else None
            states = self._read(x, d, trail)
            if kept is not None:
                kept[d] = (states, trail)
            total = states @ w[f"{d}_out"] + total
        total -= total.max(axis=2, keepdims=True)
        np.exp(total, out=total)
        total /= total.sum(axis=2, keepdims=True)
        return total

    def gradients(self, x: np.ndarray, labels: np.ndarray, mask: np.ndarray) -> tuple[dict, float]:
        """Of the mean cross-entropy over the positions in ``mask``, through time."""
        w, n, kept = self.weights, self.hidden, {}
        p = self.probabilities(x, kept)
        rows = np.arange(x.shape[1])
        count = max(float(mask.sum()), 1.0)
        loss = float(-(np.log(p[:, rows, labels] + 1e-9) * mask).sum() / count)
        dp = p
        dp[:, rows, labels] -= 1
        dp *= (mask / count)[:, :, None]
        grads = {"bias": dp.sum(axis=(0, 1))}
        for d in "fb":
            states, trail = kept[d]
            out, rec = w[f"{d}_out"], w[f"{d}_rec"]
            grads[f"{d}_out"] = np.einsum("trh,trl->hl", states, dp, optimize=True)
            from_out = dp @ out.T
            d_in, d_rec = np.zeros_like(w[f"{d}_in"]), np.zeros_like(rec)
            carry = np.zeros((x.shape[1], n), np.float32)
            da = np.empty((x.shape[1], 3 * n), np.float32)
            du = np.empty_like(da)
            for t, h, z, r, new, q in reversed(trail):
                dh = from_out[t] + carry
                dn = dh * (1 - z) * (1 - new * new)
                da[:, :n] = dh * (h - new) * z * (1 - z)
                da[:, n:2 * n] = dn * q * r * (1 - r)
                da[:, 2 * n:] = dn
                du[:, :2 * n] = da[:, :2 * n]
                du[:, 2 * n:] = dn * r
                d_rec += h.T @ du
                carry = dh * z + du @ rec.T
                np.add.at(d_in, x[t], da)
            grads[f"{d}_in"], grads[f"{d}_rec"] = d_in, d_rec
        return grads, loss

    def train(self, windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, steps: int = STEPS,
              batch: int = BATCH, rate: float = 0.02, seed: int = 11) -> float:
        """Adam over batches in which every language is as frequent; returns the last loss."""
        rng = np.random.default_rng(seed)
        groups = [np.flatnonzero(labels == i) for i in range(len(self.langs))]
        m = {k: np.zeros_like(v) for k, v in self.weights.items()}
        v = {k: np.zeros_like(x) for k, x in self.weights.items()}
        loss = 0.0
        for step in range(1, steps + 1):
            pick = np.concatenate([rng.choice(g, max(1, batch // len(groups))) for g in groups])
            x = np.ascontiguousarray(windows[pick].T)
            mask = (np.arange(x.shape[0])[:, None] < lengths[pick][None, :]).astype(np.float32)
            grads, loss = self.gradients(x, labels[pick], mask)
            pace = rate * min(1.0, 3 * (1 - (step - 1) / steps))
            for k, g in grads.items():
                g = np.clip(g, -1, 1)
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                self.weights[k] -= (pace * (m[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
        return loss

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities over the positions of each (non-empty) text."""
        buffer, starts, fresh, owner, at = [], [], [], [], 0
        for i, text in enumerate(texts):
            n = len(text)
            buffer.append(text if n >= WINDOW else text + b"\0" * (WINDOW - n))
            for s in range(0, n - WINDOW + 1, WINDOW):
                starts.append(at + s)
                fresh.append((0, WINDOW))
            if n < WINDOW:
                starts.append(at)
                fresh.append((0, n))
            elif n % WINDOW:
                starts.append(at + n - WINDOW)
                fresh.append((WINDOW - n % WINDOW, WINDOW))
            owner.extend([i] * (len(starts) - len(owner)))
            at += max(n, WINDOW)
        data = np.frombuffer(b"".join(buffer), np.uint8)
        first, new, own = np.array(starts), np.array(fresh), np.array(owner)
        sums = np.zeros((len(texts), len(self.langs)))
        for c in range(0, len(first), CHUNK):
            part = slice(c, c + CHUNK)
            x = data[first[part][None, :] + np.arange(WINDOW)[:, None]]
            p = self.probabilities(x)
            odd = np.flatnonzero((new[part, 0] > 0) | (new[part, 1] < WINDOW))
            for j in odd.tolist():
                lo, hi = new[c + j]
                p[:lo, j] = 0
                p[hi:, j] = 0
            np.add.at(sums, own[part], p.sum(axis=0, dtype=np.float64))
        return sums / np.array([len(t) for t in texts])[:, None]

    def label_positions(self, text: bytes) -> list[str]:
        """The likeliest language of every byte of a short text."""
        x = np.frombuffer(text, np.uint8)[:, None]
        return [self.langs[i] for i in self.probabilities(x)[:, 0].argmax(axis=1)]


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id's text is 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_windows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, train_docs: int,
                     doc_windows: int, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(lang, window binary): windows from the bounded sample of labelled documents.

    The documents of each language are counted first. One passes if its hash is below the share of its language that is
    wanted, with a margin of a few deviations, so about as many as are wanted are ranked per language, however many
    there are. Equal rows are one document, for the counts, the ranks and the windows."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"),
                       utf8(F.col(text_col)).alias("body"))
    rows = rows.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id")))
    rows = rows.withColumn("hash", F.xxhash64("id", "body"))
    known = rows.select("lang", "id", "hash").distinct().checkpoint()
    counts = known.groupBy("lang").count()
    langs = counts.count()
    each = max(1, min(train_docs, sample_docs // max(1, langs)))
    part = F.pmod("hash", F.lit(1 << 32)).cast("double") / F.lit(float(1 << 32))
    order = Window.partitionBy("lang").orderBy("hash", "id")
    passing = each + 4 * each ** 0.5 + 8
    chosen = (known.join(counts, "lang").where(part < passing / F.col("count"))
              .withColumn("place", F.row_number().over(order)).where(F.col("place") <= each)
              .select("id", "hash"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "body"):
            langs, windows = [], []
            for doc_id, lang, body in zip(*(batch.column(c).to_pylist() for c in ("id", "lang", "body"))):
                if not body:
                    continue
                rng = np.random.default_rng(zlib.crc32(str(doc_id).encode()))
                spare = max(len(body) - WINDOW, 0)
                for s in sorted(set(rng.integers(0, spare + 1, doc_windows).tolist())):
                    langs.append(lang)
                    windows.append(body[s:s + WINDOW])
            yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()),
                                              "window": pa.array(windows, pa.binary())})

    # at most sample_docs ids, or one of each language
    found = rows.join(F.broadcast(chosen), ["id", "hash"], "left_semi").select("id", "lang", "body")
    return found.mapInArrow(cut, "lang string, window binary").distinct()


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        train_docs: int = TRAIN_DOCS, doc_windows: int = DOC_WINDOWS, sample_docs: int = SAMPLE_DOCS,
        steps: int | None = None, hidden: int | None = None) -> Network | None:
    """A network for the languages of ``docs``; None if there is nothing to learn from."""
    prepare(docs)
    rows = sorted((r[0], bytes(r[1])) for r in training_windows(
        docs, id_col, text_col, lang_col, train_docs, doc_windows, sample_docs).collect())
    if not rows:
        return None
    langs = sorted({r[0] for r in rows})
    # as for up to 8 languages, and with the root of their number, or with it, beyond
    more = max(1.0, len(langs) / 8)
    network = Network(langs, hidden or round(HIDDEN * more ** 0.5))
    steps = steps or round(STEPS * more)
    place = {lang: i for i, lang in enumerate(langs)}
    data = np.zeros((len(rows), WINDOW), np.uint8)
    for i, (_, window) in enumerate(rows):
        data[i, :len(window)] = np.frombuffer(window, np.uint8)
    network.train(data, np.array([len(r[1]) for r in rows]), np.array([place[r[0]] for r in rows]), steps)
    return network


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict(docs: DataFrame, network: Network | None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, probabilities) for every row.

    Texts that are null or hold no letter, and all texts without a network, are ``und`` with score
    0. Null ids and repeated rows are kept as they are; an empty table gives an empty result; other
    columns are ignored."""
    spark = prepare(docs)
    model = spark.sparkContext.broadcast(network)  # a few thousand weights
    schema = "doc_id long, held_out boolean, lang_pred string, score double, probabilities array<double>"

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = model.value
        for batch in slices(batches, "body", 4 << 20):
            bodies = batch.column("body").to_pylist()
            known = [i for i, b in enumerate(bodies) if net is not None and has_letter(b.decode())]
            langs, scores, probs = [UNKNOWN] * len(bodies), [0.0] * len(bodies), [None] * len(bodies)
            if known:
                pooled = net.pooled([bodies[i] for i in known])
                for i, p in zip(known, pooled):
                    best = int(p.argmax())
                    langs[i], scores[i], probs[i] = net.langs[best], min(1.0, float(p[best])), p.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(langs), pa.array(scores, pa.float64()),
                 pa.array(probs, pa.list_(pa.float64()))],
                names=["doc_id", "held_out", "lang_pred", "score", "probabilities"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out(F.col(id_col)).alias("held_out"),
                       utf8(F.col(text_col)).alias("body"))
    return rows.mapInArrow(work, schema)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict(docs, fit(docs)).drop("probabilities")
