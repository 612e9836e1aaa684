"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

Inputs of a word: a hashed word embedding and a character vector (hashed
4-character pieces of the framed word: the largest of the first component, the
mean of the others).  The first components start from smoothed log-odds of the
training labels, the others from fixed random numbers; word embeddings, character
vectors and all network weights are trained.  Two gated recurrent layers read a window of
words in both directions, attention weighs their states, and a logistic unit
scores the window.

A text is scored whole: overlapping windows of ``WINDOW`` words every
``STRIDE`` words cover it, and its score is that of its worst window.
Training uses the same rule: the gradient goes through each text's highest
window.

Training rows are a bounded sample of whole texts, whatever their length: those
with the smallest id hashes of each label, ``SAMPLE`` rows at most, and no
further row once they hold ``SAMPLE_BYTES`` bytes.  The trained weights (a few MB) travel to the tasks with the function; scoring is a
map over Arrow batches.  A word's input sums are computed once a task.

Defined results: a null or wordless text is one empty window; without labelled
rows of both kinds every score is 0.  A carried column named ``score`` is returned
as ``input_score``.  Labelled rows of both kinds of which the
sample has one only are an error.  Rows repeat as given.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import carried, release_memory, stage

SAMPLE = 2000
SAMPLE_BYTES = 8_000_000    # of the texts of a label
WINDOW = 24
STRIDE = 12
BUCKETS = 1 << 17
PRIOR = 20              # pseudo-count of the log-odds
DIM = 6                 # components of a word embedding and of a character vector
HIDDEN = 8
STEPS = 260
BATCH = 48
CHUNK_ROWS = 8192       # windows at once
SCORE_ROWS = 1024       # windows scored at once: their input sums take 5 MB
SCORE_BYTES = 1 << 20   # of the texts that a task splits into words at once
CHUNK_TEXTS = 256       # training texts whose word pieces are counted at once
FRESH = 4096            # words whose pieces are listed at once
CACHE = 1 << 17         # words whose input sums a task keeps (25 MB)
SPLIT = r"[^\p{L}\p{N}]+"


def _hash(b: bytes) -> int:
    return zlib.crc32(b) % BUCKETS


def _pieces(word: bytes) -> list[int]:
    b = b"^" + word + b"$"
    return [_hash(b[i:i + 4]) for i in range(max(1, len(b) - 3))]


def tokenize(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(lower-case words of all texts, offsets)."""
    low = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    lists = pc.split_pattern_regex(low, SPLIT)
    flat, offs = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    offs = offs - offs[0]
    full = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    kept = np.concatenate(([0], np.cumsum(full)))
    return flat.filter(pa.array(full)), kept[offs]


def windows_of(offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, end of text) of each window."""
    n = np.diff(offs)
    k = np.where(n > WINDOW, 1 + -(-(n - WINDOW) // STRIDE), 1)
    text = np.repeat(np.arange(len(n)), k)
    i = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
    return text, offs[:-1][text] + STRIDE * i, offs[1:][text]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Weights, the forward pass and the gradient of window logits."""

    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        f = np.float32
        self.words = (r.normal(0, .1, (BUCKETS, DIM))).astype(f)
        self.chars = (r.normal(0, .1, (BUCKETS, DIM))).astype(f)
        self.p = {}
        for d in "fb":
            self.p["W" + d] = r.normal(0, .35, (2 * DIM, 3 * HIDDEN)).astype(f)
            self.p["U" + d] = r.normal(0, .25, (HIDDEN, 3 * HIDDEN)).astype(f)
            self.p["b" + d] = np.zeros(3 * HIDDEN, f)
            self.p["b" + d][:HIDDEN] = -1
        self.p["a"] = r.normal(0, .3, 2 * HIDDEN).astype(f)
        self.p["o"] = r.normal(0, .3, 2 * HIDDEN).astype(f)
        self.p["c"] = np.zeros(1, f)

    def inputs(self, words: list[bytes]) -> np.ndarray:
        """Input vectors of distinct words."""
        pieces = [_pieces(w) for w in words]
        n = np.array([len(x) for x in pieces])
        at = np.concatenate(([0], np.cumsum(n)))[:-1]
        e = self.chars[np.concatenate(pieces)] if pieces else np.zeros((0, DIM), np.float32)
        out = np.empty((len(words), 2 * DIM), np.float32)
        out[:, :DIM] = self.words[[_hash(w) for w in words]] if words else 0
        if words:
            out[:, DIM:] = np.add.reduceat(e, at, axis=0) / n[:, None]
            out[:, DIM] = np.maximum.reduceat(e[:, 0], at)
        return out

    def _scan(self, d: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        """States (T, B, H) of one direction from input sums x (T, B, 3H)."""
        u, h = self.p["U" + d], np.zeros((x.shape[1], HIDDEN), np.float32)
        states, saved = np.empty((*x.shape[:2], HIDDEN), np.float32), []
        H = HIDDEN
        for t in range(x.shape[0]) if d == "f" else range(x.shape[0] - 1, -1, -1):
            hu = h @ u
            g = 1 / (1 + np.exp(-(x[t, :, :2 * H] + hu[:, :2 * H])))
            z, r = g[:, :H], g[:, H:]
            n = np.tanh(x[t, :, 2 * H:] + r * hu[:, 2 * H:])
            new = (n + z * (h - n)) * mask[t] + h * (1 - mask[t])
            if keep:
                saved.append((t, h, z, r, n, hu[:, 2 * H:]))
            h = new
            states[t] = h
        return states, saved

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Window logits; x: input sums (T, B, 6H), mask (T, B)."""
        m = mask[:, :, None].astype(np.float32)
        hf, sf = self._scan("f", x[:, :, :3 * HIDDEN], m, keep)
        hb, sb = self._scan("b", x[:, :, 3 * HIDDEN:], m, keep)
        h = np.concatenate((hf, hb), axis=2)
        e = np.where(mask, h @ self.p["a"], -1e9)
        w = np.exp(e - e.max(0))
        w *= mask
        w /= np.maximum(w.sum(0), 1e-9)
        ctx = np.einsum("tb,tbh->bh", w, h)
        logit = ctx @ self.p["o"] + self.p["c"]
        return (logit, (h, w, ctx, sf, sb, m)) if keep else logit

    def sums(self, vectors: np.ndarray) -> np.ndarray:
        return np.concatenate([vectors @ self.p["W" + d] + self.p["b" + d] for d in "fb"], axis=1)

    def gradient(self, vec: np.ndarray, mask: np.ndarray, target: np.ndarray, weight: np.ndarray):
        """(loss, weight gradients, input gradients) for windows vec (T, B, 2 DIM)."""
        T, B, _ = vec.shape
        x = self.sums(vec.reshape(T * B, -1)).reshape(T, B, -1)
        logit, (h, w, ctx, sf, sb, m) = self.forward(x, mask, True)
        prob = _sigmoid(logit)
        loss = float((weight * -(target * np.log(prob + 1e-7) + (1 - target) * np.log(1 - prob + 1e-7))).mean())
        dl = (weight * (prob - target) / B).astype(np.float32)
        g = {"o": ctx.T @ dl, "c": np.array([dl.sum()])}
        dctx = dl[:, None] * self.p["o"]
        dh = w[:, :, None] * dctx
        dw = np.einsum("tbh,bh->tb", h, dctx)
        de = w * (dw - (w * dw).sum(0))
        g["a"] = np.einsum("tb,tbh->h", de, h)
        dh += de[:, :, None] * self.p["a"]
        dvec = np.zeros_like(vec)
        H = HIDDEN
        for d, saved, part in (("f", sf, dh[:, :, :H]), ("b", sb, dh[:, :, H:])):
            u, gu, gw, gb = self.p["U" + d], 0, 0, 0
            back = np.zeros((B, H), np.float32)
            for t, hp, z, r, n, hn in reversed(saved):
                dn = back + part[t]
                through = dn * (1 - m[t])
                dn = dn * m[t]
                dz = dn * (hp - n) * z * (1 - z)
                dnn = dn * (1 - z) * (1 - n * n)
                dr = dnn * hn * r * (1 - r)
                dx = np.concatenate((dz, dr, dnn), axis=1)
                dhu = np.concatenate((dz, dr, dnn * r), axis=1)
                gu = gu + hp.T @ dhu
                gw = gw + vec[t].T @ dx
                gb = gb + dx.sum(0)
                dvec[t] += dx @ self.p["W" + d].T
                back = dn * z + dhu @ u.T + through
            g["U" + d], g["W" + d], g["b" + d] = gu, gw, gb
        return loss, g, dvec


def _fill(codes: np.ndarray, first: np.ndarray, end: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers (T, B), mask)."""
    at = first[None, :] + np.arange(WINDOW)[:, None]
    mask = at < end[None, :]
    return np.where(mask, codes[np.minimum(at, max(len(codes) - 1, 0))] if len(codes) else pad, pad), mask


def train(texts: list[str], labels: np.ndarray, steps: int = STEPS, seed: int = 11) -> Network | None:
    """Network trained on whole texts by the highest window of each."""
    if not len(labels) or labels.min() == labels.max():
        return None
    net, rng = Network(seed), np.random.default_rng(seed)
    flat, offs = tokenize(pa.array(texts, pa.large_string()))
    enc = flat.dictionary_encode()
    words = [w.encode() for w in enc.dictionary.to_pylist()]
    codes = enc.indices.to_numpy().astype(np.int64)
    bucket = np.fromiter(map(_hash, words), np.int64, len(words))
    size = np.empty(len(words), np.int32)
    flat_p = np.empty(sum(map(len, words)) + 2 * len(words), np.int32)
    end = 0
    for i, w in enumerate(words):
        own = _pieces(w)
        size[i] = len(own)
        flat_p[end:end + len(own)] = own
        end += len(own)
    flat_p = flat_p[:end]

    # smoothed log-odds of presence: words, and the pieces of words
    doc = np.repeat(np.arange(len(labels)), np.diff(offs))
    n1, n0 = labels.sum(), (1 - labels).sum()
    prior1, prior0 = PRIOR * n1 / len(labels), PRIOR * n0 / len(labels)     # an unseen unit has no odds

    def odds(parts):
        c1, c0 = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for units in parts:
            units = np.unique(units)
            d, b = units // BUCKETS, units % BUCKETS
            one = np.bincount(b, labels[d], BUCKETS)
            c1 += one
            c0 += np.bincount(b, minlength=BUCKETS) - one
        return np.log((c1 + prior1) / (n1 + prior1)) - np.log((c0 + prior0) / (n0 + prior0))

    pairs = np.unique(doc * len(words) + codes) if len(codes) else np.zeros(0, np.int64)
    pd_, pw = (pairs // len(words), pairs % len(words)) if len(words) else (pairs, pairs)
    cuts = np.searchsorted(pd_, np.arange(0, len(labels) + CHUNK_TEXTS, CHUNK_TEXTS))
    blocks = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:]) if a < b]
    net.words[:, 0] = odds(pd_[k] * BUCKETS + bucket[pw[k]] for k in blocks) / 2
    at = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))[:-1]

    def piece_units(k):
        take = size[pw[k]]
        place = np.repeat(at[pw[k]] - (np.cumsum(take) - take), take) + np.arange(take.sum())
        return np.repeat(pd_[k], take) * BUCKETS + flat_p[place].astype(np.int64)

    net.chars[:, 0] = odds(map(piece_units, blocks)) / 2

    def vectors(who: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Input vectors of word numbers (the pad's are zeros), and the places and owners of their pieces."""
        real = who[who < len(words)]
        n = size[real].astype(np.int64)
        start = np.cumsum(n) - n
        place = np.repeat(at[real] - start, n) + np.arange(n.sum())
        out = np.zeros((len(who), 2 * DIM), np.float32)
        if len(real):
            e = net.chars[flat_p[place]]
            mine = out[:len(real)]      # the pad has the largest number
            mine[:, :DIM] = net.words[bucket[real]]
            mine[:, DIM:] = np.add.reduceat(e, start, axis=0) / n[:, None]
            mine[:, DIM] = np.maximum.reduceat(e[:, 0], start)
        return out, flat_p[place], np.repeat(np.arange(len(real)), n)

    pad = len(words)
    text, first, end = windows_of(offs)
    start = np.searchsorted(text, np.arange(len(labels) + 1))
    weight = np.where(labels == 1, np.sqrt(n0 / n1), 1.0)
    mom = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(labels), BATCH)
        own = np.concatenate([np.arange(start[i], start[i + 1]) for i in pick])
        whose = np.repeat(np.arange(BATCH), start[pick + 1] - start[pick])
        logit = np.empty(len(own), np.float32)
        for lo in range(0, len(own), CHUNK_ROWS):
            some = own[lo:lo + CHUNK_ROWS]
            c, mask = _fill(codes, first[some], end[some], pad)
            used, inv = np.unique(c, return_inverse=True)
            logit[lo:lo + CHUNK_ROWS] = net.forward(net.sums(vectors(used)[0])[inv.reshape(c.shape)], mask)
        order = np.lexsort((-logit, whose))
        best = own[order[np.searchsorted(whose[order], np.arange(BATCH))]]
        cb, mb = _fill(codes, first[best], end[best], pad)
        used, inv = np.unique(cb, return_inverse=True)
        vec, piece, owner = vectors(used)
        _, g, dvec = net.gradient(vec[inv.reshape(cb.shape)], mb, labels[pick].astype(np.float32), weight[pick].astype(np.float32))
        rate = .02 * min(1, step / 20) * (1 - .9 * step / steps)
        for k, v in net.p.items():
            a, b = mom[k]
            a[:] = .9 * a + .1 * g[k]
            b[:] = .99 * b + .01 * g[k] ** 2
            v -= (rate * (a / (1 - .9 ** step)) / (np.sqrt(b / (1 - .99 ** step)) + 1e-6)).astype(np.float32)
        # a word's gradient goes to its embedding and to its pieces: the largest first component, the mean of the others
        dword = np.zeros((len(used), 2 * DIM), np.float32)
        np.add.at(dword, inv.reshape(cb.shape)[mb], dvec[mb])
        real = used < len(words)
        np.add.at(net.words, bucket[used[real]], -.05 * rate * dword[real, :DIM])
        part = dword[owner, DIM:]
        top = net.chars[piece, 0] == vec[owner, DIM]
        part[:, 0] *= top
        part[:, 1:] /= size[used[owner]][:, None]
        np.add.at(net.chars, piece, -.05 * rate * part)
    return net


class Scorer:
    """Scores texts with a trained network; keeps the input sums of words it has seen."""

    def __init__(self, net: Network):
        self.net = net
        self.index: dict[str, int] = {}
        self.table = np.concatenate([net.p["bf"], net.p["bb"]])[None]   # the pad, then words; grows in steps

    def scores(self, texts: pa.Array) -> np.ndarray:
        flat, offs = tokenize(texts)
        enc = flat.dictionary_encode()
        words = enc.dictionary.to_pylist()
        if len(self.index) > CACHE:
            self.__init__(self.net)
        fresh = [w for w in words if w not in self.index]
        if fresh:
            at = len(self.index) + 1
            self.index.update(zip(fresh, range(at, at + len(fresh))))
            if at + len(fresh) > len(self.table):
                room = np.empty((max(at + len(fresh), len(self.table) * 3 // 2), self.table.shape[1]), self.table.dtype)
                room[:at] = self.table[:at]
                self.table = room
            for lo in range(0, len(fresh), FRESH):
                some = [w.encode() for w in fresh[lo:lo + FRESH]]
                self.table[at + lo:at + lo + len(some)] = self.net.sums(self.net.inputs(some))
        slot = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        codes = slot[enc.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
        text, first, end = windows_of(offs)
        best = np.full(len(offs) - 1, -np.inf)
        for lo in range(0, len(text), SCORE_ROWS):
            c, mask = _fill(codes, first[lo:lo + SCORE_ROWS], end[lo:lo + SCORE_ROWS], 0)
            np.maximum.at(best, text[lo:lo + SCORE_ROWS], self.net.forward(self.table[c], mask))
        return _sigmoid(best)


def choose(labels: DataFrame, key: str = "doc_id", label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """k, y of the ``sample`` smallest id hashes of each label, from the narrow label table alone (repeated rows once)."""
    rows = labels.select(F.col(f"`{key}`").alias("k"), F.col(f"`{label}`").cast("int").alias("y")).where("y IN (0, 1) AND k IS NOT NULL").distinct()
    rows = rows.withColumn("h", F.xxhash64("k"))
    mine = [rows.where(F.col("y") == y).orderBy("h", "k").limit(sample) for y in (0, 1)]
    return mine[0].unionByName(mine[1]).select("k", "y")


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Network | None:
    """Train on a bounded sample of labelled rows (see the module's text).

    Ids are chosen in the label table, 2 x ``sample`` at most, and broadcast: ``docs`` is scanned once and no text
    is shuffled but those of the chosen ids, which are staged.  Rows without a text teach nothing.
    """
    ids = choose(labels, key, label, sample)
    src = docs.select(F.col(f"`{key}`").alias("dk"), F.col(f"`{text}`").alias("t")).where("t IS NOT NULL")
    got = stage(src.join(F.broadcast(ids), F.col("dk") == F.col("k")).select("k", "y", "t"))
    sized = got.select("y", F.xxhash64("k").alias("h"), "k", F.xxhash64("t").alias("u"), F.octet_length("t").alias("b"))
    order = ["h", "k", "u"]
    sized = [sized.where(F.col("y") == y).orderBy(*order).limit(sample) for y in (0, 1)]
    sized = sized[0].unionByName(sized[1]).collect()
    texts, labelled = [], []
    for y in (0, 1):
        own = sorted((r for r in sized if r["y"] == y), key=lambda r: (r["h"], r["k"], r["u"]))
        before = np.cumsum([0, *(r["b"] for r in own)])[:-1]
        n = int((before < sample_bytes).sum())
        if n:
            near = got.where((F.col("y") == y) & (F.xxhash64("k") <= own[n - 1]["h"]))
            near = near.orderBy(F.xxhash64("k"), "k", F.xxhash64("t")).limit(n).select("t").collect()
            texts += [r["t"] for r in near]
            labelled += [y] * len(near)
    if len(set(labelled)) < 2:
        kinds = {r["y"] for r in ids.select("y").distinct().collect()}
        if kinds == {0, 1} and texts:
            raise ValueError(f"labelled rows of both kinds, but the sample ({sample} rows, {sample_bytes} bytes a label) has texts of one only")
        return None
    net = train(texts, np.array(labelled))
    del texts
    release_memory()
    return net


def score(docs: DataFrame, net: Network | None, carry: list[Column | str], text: str = "text") -> DataFrame:
    """carry..., score of every whole text."""
    own = docs.select(*carried(docs, carry, ["score"]))
    kept = own.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields)
    # a text that is carried as it is travels to the task once
    given = text if text in [c for c in carry if isinstance(c, str)] and text != "score" else "__text"
    src = own if given == text else docs.select(*carried(docs, carry, ["score"]), F.col(f"`{text}`").alias(given))

    def run(batches):
        scorer = Scorer(net) if net is not None else None
        for batch in batches:
            yield from scored(scorer, batch)
            del batch                   # before the next one is read
        del scorer
        release_memory()

    def scored(scorer, batch):
        column = batch.column(given)
        size = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy().astype(np.int64))))
        lo = 0
        while lo < batch.num_rows:
            hi = min(batch.num_rows, max(lo + 1, int(np.searchsorted(size, size[lo] + SCORE_BYTES, side="right")) - 1))
            part = batch.slice(lo, hi - lo)
            s = scorer.scores(part.column(given)) if scorer else np.zeros(hi - lo)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(s.astype(np.float64))], [*kept, "score"])
            lo = hi

    return src.mapInArrow(run, f"{schema}, score double")
