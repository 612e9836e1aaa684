"""Language identification by rank-order n-gram profiles.

Training counts the character n-grams (1 to 3 letters, words padded with one
blank) of every labelled text, per language, and keeps each language's
``TOP`` most frequent ones in rank order.  A document's own most frequent
n-grams are compared with each profile by out-of-place distance: the sum of
rank differences, ``TOP`` for an n-gram that the profile lacks.  The nearest
profile wins.

Counting runs on Arrow batches inside the tasks: code points become dense ids,
an n-gram is one 64-bit key and one sort per run of texts counts them.  Tasks
add up their counts before the shuffle, whose rows are bounded by distinct
n-grams.  The profiles (``TOP`` rows per language) are the only thing that the
driver sees; ``MAX_LANGS`` bounds them.

Defined results: null text or text without a letter is ``und`` with score 0;
ties in frequency go to the smaller n-gram (code point order), ties in
distance to the language that sorts first; without labelled rows everything is
``und``.  Texts are used whole, and rows repeat as given.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import text_chunks

TOP = 300               # n-grams in a profile
ORDERS = (1, 2, 3)
MAX_LANGS = 1000        # more learned languages are refused
CHUNK = 1 << 21         # bytes of text handled at once
FLUSH = 400_000         # n-grams that a task holds before it hands them on
UND = "und"


def _letter_table() -> np.ndarray:
    """Letter flag of each code point."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _fold_table() -> np.ndarray:
    """Lower-case of each code point, where that is one code point."""
    low = (chr(c).lower() for c in range(0x110000))
    return np.fromiter((ord(x) if len(x) == 1 else i for i, x in enumerate(low)), dtype=np.int32, count=0x110000)


_TABLES: list = []


def _tables():
    if not _TABLES:
        letter, fold = _letter_table(), _fold_table()
        _TABLES.append(np.where(letter, fold, 32).astype(np.int32))  # letters folded, the rest blank
    return _TABLES[0]


def _code_points(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points of all texts, each text framed by blanks, and the text of each."""
    cps = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.int32)
    if len(raw) and raw.max() < 128:
        ends = offs[1:]
    else:
        lead = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
        ends = lead[offs[1:]]
        if ends[-1] != len(cps):  # malformed UTF-8: decode text by text
            parts = [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offs[:-1], offs[1:])]
            cps = np.frombuffer("".join(parts).encode("utf-32-le"), dtype=np.int32)
            ends = np.cumsum([len(p) for p in parts])
    n = len(ends)
    starts = np.concatenate(([0], ends[:-1]))
    out = np.full(len(cps) + 2 * n, 32, dtype=np.int32)
    doc = np.repeat(np.arange(n, dtype=np.int64), ends - starts)
    out[np.arange(len(cps)) + 2 * doc + 1] = _tables()[cps]
    return out, np.repeat(np.arange(n, dtype=np.int64), ends - starts + 2)


def count_ngrams(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, n-gram, count), sorted by text and n-gram.

    An n-gram is three code points of 21 bits, the first highest, 0 where it is
    shorter; n-grams of blanks only, and those that span words, don't count.
    """
    cps, owner = _code_points(raw, offs)
    keep = np.ones(len(cps), dtype=bool)
    keep[1:] = (cps[1:] != 32) | (cps[:-1] != 32) | (owner[1:] != owner[:-1])
    cps, owner = cps[keep], owner[keep]
    used = np.zeros(0x110000, dtype=bool)
    used[cps] = True
    alphabet = np.flatnonzero(used)
    bits = max(1, int(len(alphabet)).bit_length())
    dense = np.zeros(0x110000, dtype=np.int32)
    dense[alphabet] = np.arange(1, len(alphabet) + 1)
    ids = dense[cps].astype(np.int64)
    blank = cps == 32
    keys = []
    for n in ORDERS:
        m = len(ids) - n + 1
        if m <= 0:
            continue
        code = np.zeros(m, dtype=np.int64)
        ok = owner[:m] == owner[n - 1:]
        for j in range(3):
            code <<= bits
            if j < n:
                code |= ids[j:m + j]
                if 0 < j < n - 1:
                    ok &= ~blank[j:m + j]
        if n == 1:
            ok &= ~blank
        elif n == 2:
            ok &= ~(blank[:m] & blank[1:])
        keys.append((owner[:m][ok] << (3 * bits)) | code[ok])
    key = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    if not len(key):
        z = np.zeros(0, np.int64)
        return z, z, z
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    count = np.diff(np.concatenate((first, [len(key)])))
    key = key[first]
    back = np.concatenate(([0], alphabet)).astype(np.int64)
    mask = (1 << bits) - 1
    gram = (back[(key >> (2 * bits)) & mask] << 42) | (back[(key >> bits) & mask] << 21) | back[key & mask]
    return key >> (3 * bits), gram, count


def _runs(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Chunks of texts small enough that text number and n-gram share 64 bits."""
    for lo, _, raw, offs in text_chunks(column, CHUNK):
        for a in range(0, len(offs) - 1, 512):
            part = offs[a:a + 513]
            yield lo + a, raw[part[0]:part[-1]], part - part[0]


def _profile_counts(batches):
    """Per task: (lang, gram, n), added up and handed on when many are held."""
    held: dict[str, list] = {}
    size = 0

    def flush():
        for lang, parts in held.items():
            grams = np.concatenate([p[0] for p in parts])
            counts = np.concatenate([p[1] for p in parts])
            g, inv = np.unique(grams, return_inverse=True)
            yield pa.record_batch({"lang": pa.array([lang] * len(g), pa.string()), "gram": pa.array(g),
                                   "n": pa.array(np.bincount(inv, counts, len(g)).astype(np.int64))})
        held.clear()

    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for lang in sorted(set(langs)):
            sub = batch.column("text").filter(pa.array(langs == lang))
            for _, raw, offs in _runs(sub):
                _, gram, count = count_ngrams(raw, offs)
                order = np.argsort(gram, kind="stable")
                gram, count = gram[order], count[order]
                if not len(gram):
                    continue
                first = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
                held.setdefault(lang, []).append((gram[first], np.add.reduceat(count, first)))
                size += len(first)
                if size > FLUSH:
                    yield from flush()
                    size = 0
    yield from flush()


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> dict[str, np.ndarray]:
    """Profiles: language -> its ``top`` most frequent n-grams in rank order."""
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).where(
        "text IS NOT NULL AND lang IS NOT NULL")
    counts = (rows.mapInArrow(_profile_counts, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    w = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    got = best.limit(MAX_LANGS * top + 1).collect()
    if len(got) > MAX_LANGS * top:
        raise ValueError("too many languages")
    out: dict[str, np.ndarray] = {}
    for lang_ in sorted({r["lang"] for r in got}):
        own = sorted((r["rank"], r["gram"]) for r in got if r["lang"] == lang_)
        out[lang_] = np.array([g for _, g in own], dtype=np.int64)
    return out


def nearest(doc: np.ndarray, gram: np.ndarray, count: np.ndarray, n_docs: int, grams: np.ndarray,
            ranks: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language index or -1, score, distances) per text from its n-gram counts.

    ``grams``: sorted n-grams of all profiles; ``ranks``: their 0-based rank in
    each profile, ``top`` where absent.  Score: 1 - distance / worst distance.
    """
    order = np.lexsort((gram, -count, doc))
    doc, gram = doc[order], gram[order]
    start = np.searchsorted(doc, np.arange(n_docs + 1))
    rank = np.arange(len(doc)) - start[doc]
    keep = rank < top
    doc, gram, rank = doc[keep], gram[keep], rank[keep]
    at = np.minimum(np.searchsorted(grams, gram), max(len(grams) - 1, 0))
    known = grams[at] == gram if len(grams) else np.zeros(len(gram), bool)
    dist = np.zeros((n_docs, ranks.shape[1]))
    for k in range(ranks.shape[1]):
        there = np.where(known, ranks[at, k], top)
        off = np.where(there < top, np.abs(there - rank), top)
        dist[:, k] = np.bincount(doc, off, n_docs)
    n = np.bincount(doc, minlength=n_docs)
    best = np.where(n > 0, dist.argmin(axis=1), -1)
    score = np.where(n > 0, 1 - dist.min(axis=1) / np.maximum(1, n * top), 0.0)
    return best, np.clip(score, 0, 1), dist


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], carry: list[Column | str], text: str = "text",
            top: int = TOP) -> DataFrame:
    """carry..., lang_pred, score of every whole text."""
    names = sorted(profiles)
    grams = np.unique(np.concatenate([profiles[x] for x in names])) if names else np.zeros(0, np.int64)
    ranks = np.full((len(grams), len(names)), top, dtype=np.int64)
    for k, x in enumerate(names):
        ranks[np.searchsorted(grams, profiles[x]), k] = np.arange(len(profiles[x]))

    src = docs.select(*carry, F.col(f"`{text}`").alias("__text"))
    fields = src.drop("__text").schema.fields
    kept = [f.name for f in fields]
    out_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def score(batches):
        for batch in batches:
            n = batch.num_rows
            lang, val = np.full(n, -1), np.zeros(n)
            if names:
                for lo, raw, offs in _runs(batch.column("__text")):
                    m = len(offs) - 1
                    best, s, _ = nearest(*count_ngrams(raw, offs), m, grams, ranks, top)
                    lang[lo:lo + m], val[lo:lo + m] = best, s
            pred = pa.array([names[i] if i >= 0 else UND for i in lang], pa.string())
            cols = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*cols, pred, pa.array(val)], [*kept, "lang_pred", "score"])

    return src.mapInArrow(score, f"{out_schema}, lang_pred string, score double")
