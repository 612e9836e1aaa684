"""Exact-substring dedup: remove bytes of passages that a smaller document id also holds.

A byte goes if a ``LENGTH``-byte string that covers it also starts in a
document with a smaller id.  Strings are judged on the input, never across
documents, and matches of any length from LENGTH on are found.

How the passages meet, without moving the text of unique passages:

1. Each text is scanned for anchors: of every LENGTH-byte window the
   ``GRAM``-byte string with the smallest hash.  Equal windows choose the same
   anchor, so equal windows share an anchor with the same bytes around it.
   The *neighbourhood* of an anchor holds every window that may choose it.
2. Anchors are grouped by hash.  If a smaller id has an equal neighbourhood,
   all of it is covered.  Tasks send each distinct neighbourhood once, with
   its smallest id, so a passage in a third of all documents is one entry a
   task; the answers are one bit an entry.
3. An anchor whose neighbourhoods differ (near an edit) may be covered in
   part.  A window that two of them share reaches half of what it has beside
   the anchor, or more, to the left or to the right, so neighbourhoods are
   compared by a short hash of either side first.  The bytes of those that
   agree on a side are gathered by anchor, and a two-stage suffix array with
   adjacent common prefixes (``suffix``) finds which of their windows a smaller
   id holds.
4. Anchors with very many different neighbourhoods (the edge of a very common
   line) would be one large group; their windows are settled one by one
   instead, each sent once by a group of documents with its smallest id.

Defined results: null text is empty; texts shorter than LENGTH stay; rows with
the same id don't remove each other's bytes; rows with a null id stay whole and
remove nothing.  Rows repeat as given.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import buckets_for, freed, mix64, text_chunks
from tillcast.llm.suffix import adjacent_equal, suffix_array

LENGTH = 50
GRAM = 16
GROUP_BYTES = 12 << 20      # text in one group of documents
BUCKET_BYTES = 8 << 20      # text whose anchors share a bucket
LOCAL_HOT = 64              # neighbourhoods of one anchor that a group of documents sends
HOT = 4096                  # neighbourhoods of one anchor that are sorted together
SORT_BYTES = 1 << 19        # bytes in one suffix array; whole anchors, so one alone may hold more
PAD = 0xFF                  # never a byte of UTF-8
BITS = 48
BLOCK = 1 << 15             # places scanned at once: their hashes stay in the cache
SIDE = np.uint64((1 << 16) - 1)         # hash of one side of an anchor
WINDOW = np.int64(-1)       # mask that answers a single window
MARKER = np.uint64((1 << BITS) - 1)     # neighbourhood of a marker
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over x[i:i+width] for each i that has a full window."""
    span = 1
    while span * 2 <= width:
        x = op(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return op(x[:len(x) - rest], x[rest:]) if rest else x


def padded(texts: pa.Array, gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, begin, end of each text): texts kept apart, and framed, by ``gap`` pad bytes."""
    parts, begins, ends, at = [], [], [], gap
    for _, _, raw, offs in text_chunks(texts, 1 << 40):
        n = len(offs) - 1
        begins.append(offs[:-1] + at + gap * np.arange(n))
        ends.append(offs[1:] + at + gap * np.arange(n))
        out = np.full(len(raw) + gap * n, PAD, np.uint8)
        for a, b, to in zip(offs[:-1].tolist(), offs[1:].tolist(), (offs[:-1] + gap * np.arange(n)).tolist()):
            out[to:to + b - a] = raw[a:b]
        parts.append(out)
        at += len(out)
    buf = np.concatenate([np.full(gap, PAD, np.uint8), *parts, np.full(gap + 16, PAD, np.uint8)])
    none = np.zeros(0, np.int64)
    return buf, np.concatenate([none, *begins]), np.concatenate([none, *ends])


def anchors(buf: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Places of all anchors in a padded buffer."""
    width = length - gram + 1
    n = len(buf) - gram - 8         # the frame's end holds no anchor
    words = np.ndarray(shape=(len(buf) - 7,), dtype="<u8", buffer=buf.data, strides=(1,))
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = []
    for a in range(0, n, BLOCK):
        lo, hi = max(0, a - width), min(n, a + BLOCK + width)
        h = mix64(words[lo:hi] * _C[0] ^ mix64(words[lo + gram - 8:hi + gram - 8] * _C[1]))
        pad = np.cumsum(np.concatenate(([0], buf[lo:hi + gram] == PAD)))
        h[(pad[gram:][:len(h)] - pad[:len(h)]) > 0] = top
        frame = np.full(width - 1, top)
        least = _slide(np.concatenate((frame, h, frame)), width, np.minimum)
        best = _slide(np.where(least == top, np.uint64(0), least), width, np.maximum)
        chosen = (best == h) & (h != top)
        own = np.flatnonzero(chosen[a - lo:min(a + BLOCK, n) - lo]) + a
        out.append(own)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _hash_at(buf: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """48-bit hash of the ``length`` (8 or more) bytes at each place."""
    words = np.ndarray(shape=(len(buf) - 7,), dtype="<u8", buffer=buf.data, strides=(1,))
    x = np.full(len(at), _C[2])
    for s in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        x = (x ^ words[at + s]) * _C[0]
        x ^= x >> np.uint64(29)
    return mix64(x) >> np.uint64(64 - BITS)


class Group:
    """Anchors of a group of documents and its distinct (anchor, neighbourhood) entries."""

    def __init__(self, ids: pa.ChunkedArray, texts, length: int, gram: int, buckets: int, local_hot: int):
        self.length, self.margin = length, length - gram
        self.span = length + self.margin
        known = np.array(ids.is_valid())
        self.ids = ids.fill_null(0).to_numpy().astype(np.int64)
        self.buf, self.begin, self.end = padded(texts, length)
        # places and numbers take 4 bytes where they fit, as a group has some for every few bytes of text
        number = np.int32 if len(self.buf) < 1 << 31 else np.int64
        at = anchors(self.buf, length, gram).astype(number)
        doc = (np.searchsorted(self.begin, at, side="right") - 1).astype(number)
        keep = known[doc] & (self.end[doc] - self.begin[doc] >= length)
        at, doc = at[keep], doc[keep]
        anchor = _hash_at(self.buf, at, gram)
        around = _hash_at(self.buf, at - self.margin, self.span)
        # buckets are ranges of anchors, and places come in order, so two keys sort all
        order = np.lexsort((around, anchor)).astype(number)
        self.at, self.doc = at[order], doc[order]
        anchor, around = anchor[order], around[order]
        del at, doc, order
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (around[1:] != around[:-1])
        self.first = np.flatnonzero(new).astype(number)
        self.entry = _numbered(new, number)             # of each anchor place
        self.anchor, self.around = anchor[self.first], around[self.first]
        del anchor, around
        self.bucket = _range_of(self.anchor, buckets).astype(np.int32)
        mine = self.ids[self.doc]                       # smallest id of each entry
        self.least = np.minimum.reduceat(mine, self.first) if len(mine) else mine
        # what is sent: all entries, or one marker where an anchor has too many
        a = np.ones(len(self.first), bool)
        a[1:] = self.anchor[1:] != self.anchor[:-1]
        self.head = np.flatnonzero(a).astype(number)
        self.of = _numbered(a, number)                  # anchor number of each entry
        many = np.diff(np.concatenate((self.head, [len(self.first)]))) > local_hot
        self.many = many[self.of] if len(self.first) else np.zeros(0, bool)
        self.sent = np.flatnonzero(~self.many | a).astype(number)
        self.cut = np.searchsorted(self.bucket[self.sent], np.arange(buckets + 1))

    def messages(self, g: int) -> pa.Table:
        rows = []
        least = self.least.copy()
        if len(self.head):
            least_a = np.minimum.reduceat(self.least, self.head)
            least = np.where(self.many, least_a[self.of], least)
        half = -(-self.margin // 2)
        at = self.at[self.first[self.sent]]
        left, right = (_hash_at(self.buf, p, self.length - self.margin + half) & SIDE for p in (at - half, at))
        for b in range(len(self.cut) - 1):
            lo, hi = self.cut[b], self.cut[b + 1]
            e = self.sent[lo:hi]
            if len(e):
                around = np.where(self.many[e], MARKER, np.minimum(self.around[e], MARKER - np.uint64(1)))
                rows.append((b, g, len(e), _pack(self.anchor[e], around, left[lo:hi], right[lo:hi], least[e], self.many[e])))
        cols = list(zip(*rows)) if rows else [[], [], [], []]
        return pa.table({"bucket": pa.array(cols[0], pa.int32()), "g": pa.array(cols[1], pa.int32()),
                         "n": pa.array(cols[2], pa.int32()), "data": pa.array(cols[3], pa.binary())})

    def answers(self, replies: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(covered, wanted, hot) flag of each entry."""
        flags = np.zeros((3, len(self.first)), bool)
        for b, data in zip(replies.column("bucket").to_pylist(), replies.column("data").to_pylist()):
            e = self.sent[self.cut[b]:self.cut[b + 1]]
            got = np.unpackbits(np.frombuffer(data, np.uint8).reshape(3, -1), axis=1)[:, :len(e)].astype(bool)
            flags[:, e] = got
        hot_anchor = np.zeros(len(self.head) + 1, bool)
        if len(self.first):
            np.logical_or.at(hot_anchor, self.of, flags[2])
            flags[2] = hot_anchor[self.of]
        return flags[0], flags[1], flags[2]

    def windows(self, hot: np.ndarray):
        """Windows of the entries flagged ``hot``: (entry, offset, window number), and per window two
        hashes and the smallest id."""
        h = np.flatnonzero(hot)
        if not len(h):
            return (np.zeros(0, np.int64),) * 6
        begin = self.at[self.first[h]] - self.margin
        doc = self.doc[self.first[h]]
        low, high = self.begin[doc], self.end[doc]
        own, off, at = [], [], []
        for o in range(self.margin + 1):
            ok = (begin + o >= low) & (begin + o + self.length <= high)     # no window spans texts
            own.append(h[ok])
            at.append(begin[ok] + o)
            off.append(np.full(int(ok.sum()), o))
        own, off, at = np.concatenate(own), np.concatenate(off), np.concatenate(at)
        w1 = _hash_at(self.buf, at, self.length).astype(np.int64)
        w2 = _hash_at(self.buf, at + 1, self.length - 2).astype(np.int64)
        order = np.lexsort((self.least[own], w2, w1))
        own, off, w1, w2 = own[order], off[order], w1[order], w2[order]
        new = np.ones(len(own), bool)
        new[1:] = (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
        head = np.flatnonzero(new)
        return own, off, np.cumsum(new) - 1, w1[head], w2[head], self.least[own[head]]

    def bytes_of(self, entries: np.ndarray) -> np.ndarray:
        """Neighbourhood bytes of entries, one row each."""
        at = self.at[self.first[entries]] - self.margin
        return self.buf[at[:, None] + np.arange(self.span)]


def _numbered(new: np.ndarray, number: type) -> np.ndarray:
    """Number of the run of each place, where ``new`` marks the first of a run."""
    out = np.cumsum(new, dtype=number)
    out -= 1
    return out


def _range_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each 48-bit hash: equal ranges of them, in order."""
    return ((hashes >> np.uint64(BITS - 32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


PLANES = (6, 6, 2, 2, 8, 1)     # bytes of a packed column's values


def _pack(*columns: np.ndarray) -> bytes:
    """Columns as byte planes, so that equal high bytes compress away."""
    return b"".join(x.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :k].T.tobytes() for x, k in zip(columns, PLANES))


def _unpack(data: bytes, n: int):
    """anchor, around, left, right (unsigned), least and many of a message."""
    raw, lo, cols = np.frombuffer(data, np.uint8), 0, []
    for k in PLANES:
        x = np.zeros((n, 8), np.uint8)
        x[:, :k] = raw[lo:lo + k * n].reshape(k, n).T
        cols.append(x.view("<i8").ravel())
        lo += k * n
    return *(c.view("<u8") for c in cols[:4]), cols[4], cols[5].astype(bool)


def _resolve(messages: pa.Table, most: int) -> pa.Table:
    """Flags for each group's entries of one bucket: covered, wanted (its bytes), hot."""
    gs, ns = messages.column("g").to_numpy(), messages.column("n").to_numpy()
    parts = [_unpack(d, n) for d, n in zip(messages.column("data").to_pylist(), ns.tolist())]
    anchor, around, left, right, least, many = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((around, anchor))
    a, r, m, y = anchor[order], around[order], least[order], many[order]
    new_a = np.concatenate(([True], a[1:] != a[:-1]))
    new_r = new_a | np.concatenate(([True], r[1:] != r[:-1]))
    seg, anc = np.cumsum(new_r) - 1, np.cumsum(new_a) - 1
    one = np.flatnonzero(new_r)                             # an entry of each neighbourhood
    seg_least = np.minimum.reduceat(m, one)
    head = np.flatnonzero(new_a)
    n_seg = np.add.reduceat(new_r.astype(np.int64), head)
    hot = np.logical_or.reduceat(y, head) | (n_seg > most)
    covered = (seg_least[seg] < m) & ~y
    # neighbourhoods that agree on a side with one of another id may share a window
    shares = np.zeros(len(one), bool)
    live = np.flatnonzero(((n_seg > 1) & ~hot)[anc[one]])
    for side in (left, right) if len(live) else ():
        key = anc[one[live]] << 16 | side[order[one[live]]].astype(np.int64)
        by = np.argsort(key, kind="stable")
        key, low = key[by], seg_least[live][by]
        new = np.concatenate(([True], key[1:] != key[:-1]))
        at = np.flatnonzero(new)
        shares[live[by]] |= (np.maximum.reduceat(low, at) > np.minimum.reduceat(low, at))[np.cumsum(new) - 1]
    wanted = shares[seg] & (m == seg_least[seg])
    flags = np.zeros((3, len(order)), bool)
    flags[:, order] = np.stack((covered, wanted, hot[anc]))
    ends = np.cumsum(ns)
    rows = [(int(g), int(b), np.packbits(flags[:, e - n:e], axis=1).tobytes())
            for g, b, n, e in zip(gs, messages.column("bucket").to_pylist(), ns, ends) if flags[:, e - n:e].any()]
    cols = list(zip(*rows)) if rows else [[], [], []]
    return pa.table({"g": pa.array(cols[0], pa.int32()), "bucket": pa.array(cols[1], pa.int32()),
                     "data": pa.array(cols[2], pa.binary())})


def _windows_held(rows: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """Bit mask, per neighbourhood, of the windows that a smaller id among them holds."""
    n, span = rows.shape
    text = np.ascontiguousarray(rows).ravel()
    sa = suffix_array(text, length)
    off = sa % span
    pads = np.cumsum(np.concatenate((np.zeros((n, 1), bool), rows == PAD), axis=1), axis=1, dtype=np.int16)
    whole = np.zeros((n, span), bool)
    whole[:, :span - length + 1] = (pads[:, length:] - pads[:, :span - length + 1]) == 0
    sa = sa[whole.ravel()[sa]]
    if not len(sa):
        return np.zeros(n, np.int64)
    group = np.cumsum(~adjacent_equal(text, sa, length)) - 1
    head = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    owner, off = sa // span, sa % span
    least = np.minimum.reduceat(ids[owner], head)
    held = ids[owner] > least[group]
    mask = np.zeros(n, np.int64)
    np.bitwise_or.at(mask, owner[held], np.int64(1) << off[held])
    return mask


def _sorted_out(asked: pa.Table, length: int, span: int) -> pa.Table:
    """Masks of the wanted neighbourhoods of one bucket, suffix arrays of whole anchors at a time."""
    anchor = asked.column("anchor").to_numpy()
    order = np.argsort(anchor, kind="stable")
    anchor, ids = anchor[order], asked.column("id").to_numpy()[order]
    rows = np.frombuffer(b"".join(asked.column("around").to_pylist()), np.uint8).reshape(-1, span)[order]
    heads = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    mask = np.zeros(len(anchor), np.int64)
    lo = 0
    while lo < len(anchor):
        k = int(np.searchsorted(heads, lo + SORT_BYTES // span, side="right")) - 1
        hi = int(heads[k]) if k < len(heads) and heads[k] > lo else None
        if lo + SORT_BYTES // span >= len(anchor):
            hi = len(anchor)
        elif hi is None:
            nxt = int(np.searchsorted(heads, lo, side="right"))
            hi = int(heads[nxt]) if nxt < len(heads) else len(anchor)
        mask[lo:hi] = _windows_held(rows[lo:hi], ids[lo:hi], length)
        lo = hi
    some = mask != 0
    return pa.table({"g": asked.column("g").to_numpy()[order][some], "entry": asked.column("entry").to_numpy()[order][some],
                     "mask": mask[some]})


def _covered(group: Group, covered: np.ndarray, entries: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Flag of each byte of the padded buffer."""
    # a byte is in length + margin neighbourhoods and length x (margin + 1) windows at most, some thousands
    step = np.zeros(len(group.buf) + 1, np.int16)

    def add(a, b):
        ok = b - a >= group.length
        np.add.at(step, a[ok], 1)
        np.add.at(step, b[ok], -1)

    full = covered[group.entry] | (group.ids[group.doc] > group.least[group.entry]) if len(group.at) else np.zeros(0, bool)
    at, doc = group.at[full], group.doc[full]
    add(np.maximum(at - group.margin, group.begin[doc]), np.minimum(at + group.length, group.end[doc]))
    if len(entries):
        held = np.zeros(len(group.first), np.int64)
        np.bitwise_or.at(held, entries, masks)
        some = np.flatnonzero((held[group.entry] != 0) & ~full)
        for o in range(group.margin + 1):
            p = some[(held[group.entry[some]] >> o) & 1 == 1]
            a = group.at[p] - group.margin + o
            add(a, a + group.length)
    return np.cumsum(step, dtype=np.int16, out=step)[:-1] > 0


def dedup_substrings(docs: DataFrame, doc: str = "doc_id", text: str = "text", length: int = LENGTH,
                     gram: int = GRAM, local_hot: int = LOCAL_HOT, hot: int = HOT, as_text: str | None = None) -> DataFrame:
    """Input columns of ``docs`` plus n_bytes, n_removed, n_spans, spans (array of begin, end) and kept (binary).

    ``as_text`` names one more column: the kept bytes as text, without the remains of characters that a cut
    split; a text that lost nothing as it was given.
    """
    if not 16 <= gram <= length - 8 or 2 * length - gram > 126 or length - gram > 62:
        raise ValueError("length and gram are out of range")
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(f"`{text}`"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups, buckets = buckets_for(total, GROUP_BYTES, least), buckets_for(total, BUCKET_BYTES, least)
    span = 2 * length - gram
    added = ("n_bytes", "n_removed", "n_spans", "spans", "kept", *([as_text] if as_text else []))
    kept = [c for c in docs.columns if c not in added]
    base = docs.select(*[F.col(f"`{c}`") for c in kept],
                       F.pmod(F.xxhash64(f"`{doc}`", f"`{text}`"), F.lit(groups)).cast("int").alias("__g"))

    def load(t: pa.Table) -> tuple[pa.Table, Group]:
        # one order in every pass: entries are named by their place
        t = t.sort_by([(doc, "ascending"), (text, "ascending")])
        return t, Group(t.column(doc).cast(pa.int64()), t.column(text), length, gram, buckets, local_hot)

    def send(t: pa.Table) -> pa.Table:
        return load(t)[1].messages(t.column("__g")[0].as_py())

    replies = (base.groupBy("__g").applyInArrow(lambda t: freed(send, t), "bucket int, g int, n int, data binary")
               .groupBy("bucket").applyInArrow(lambda m: freed(_resolve, m, hot), "g int, bucket int, data binary"))

    ask_schema = "bucket int, g int, entry int, id long, anchor long, around binary, w2 long"
    arrow = pa.schema([("bucket", pa.int32()), ("g", pa.int32()), ("entry", pa.int32()), ("id", pa.int64()),
                       ("anchor", pa.int64()), ("around", pa.binary()), ("w2", pa.int64())])

    def ask(t: pa.Table, r: pa.Table) -> pa.Table:
        if not t.num_rows or not r.num_rows:
            return arrow.empty_table()
        g = t.column("__g")[0].as_py()
        _, group = load(t)
        _, wanted, many = group.answers(r)
        e = np.flatnonzero(wanted & ~many)
        n = len(e)
        cold = pa.table([pa.array(group.bucket[e].astype(np.int32)), pa.array(np.full(n, g, np.int32)),
                         pa.array(e.astype(np.int32)), pa.array(group.least[e]), pa.array(group.anchor[e].astype(np.int64)),
                         pa.array([x.tobytes() for x in group.bytes_of(e)], pa.binary()), pa.nulls(n, pa.int64())], schema=arrow)
        _, _, _, w1, w2, low = group.windows(many)
        m = len(w1)
        single = pa.table([pa.array((w1 % buckets).astype(np.int32)), pa.array(np.full(m, g, np.int32)),
                           pa.array(np.arange(m, dtype=np.int32)), pa.array(low), pa.array(w1), pa.nulls(m, pa.binary()),
                           pa.array(w2)], schema=arrow)
        return pa.concat_tables([cold, single])

    def settle(t: pa.Table) -> pa.Table:
        cold = t.filter(t.column("around").is_valid())
        single = t.filter(t.column("w2").is_valid())
        out = []
        if cold.num_rows:
            out.append(_sorted_out(cold, length, span))
        if single.num_rows:
            w1, w2, low = (single.column(c).to_numpy() for c in ("anchor", "w2", "id"))
            order = np.lexsort((low, w2, w1))
            new = np.ones(len(order), bool)
            new[1:] = (w1[order][1:] != w1[order][:-1]) | (w2[order][1:] != w2[order][:-1])
            first = low[order][np.flatnonzero(new)][np.cumsum(new) - 1]
            some = order[low[order] > first]
            out.append(pa.table({"g": single.column("g").to_numpy()[some], "entry": single.column("entry").to_numpy()[some],
                                 "mask": np.full(len(some), WINDOW)}))
        return pa.concat_tables(out)

    # a window is sent once by each group of documents, so a very common one is a few rows
    part = (base.groupBy("__g").cogroup(replies.groupBy("g")).applyInArrow(lambda t, r: freed(ask, t, r), ask_schema)
            .groupBy("bucket").applyInArrow(lambda t: freed(settle, t), "g int, entry int, mask long"))
    none = F.lit(None)
    answers = (replies.select("g", "bucket", "data", none.cast("int").alias("entry"), none.cast("long").alias("mask"))
               .unionByName(part.select("g", none.cast("int").alias("bucket"),
                                        none.cast("binary").alias("data"), "entry", "mask")))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[F.col(f"`{c}`") for c in kept]).schema.fields)
    out_schema = (f"{fields}, n_bytes long, n_removed long, n_spans long, "
                  "spans array<struct<begin: long, end: long>>, kept binary") + (f", `{as_text}` string" if as_text else "")

    def remove(t: pa.Table, r: pa.Table) -> pa.Table:
        t, group = load(t)
        flags = r.filter(r.column("data").is_valid())
        part = r.filter(r.column("mask").is_valid())
        covered, _, many = group.answers(flags)
        entry, mask = part.column("entry").to_numpy().astype(np.int64), part.column("mask").to_numpy()
        alone = mask == WINDOW
        own, off, number, w1, _, low = group.windows(many)
        held = np.zeros(len(w1), bool)
        held[entry[alone]] = True
        ok = held[number] | (group.least[own] > low[number])
        gone = _covered(group, covered, np.concatenate((entry[~alone], own[ok])),
                        np.concatenate((mask[~alone], np.int64(1) << off[ok])))
        edges = np.flatnonzero(gone[1:] != gone[:-1]) + 1       # the frame stays
        begins, ends = edges[::2], edges[1::2]
        owner = np.searchsorted(group.begin, begins, side="right") - 1
        n_spans = np.bincount(owner, minlength=t.num_rows)
        n_removed = np.zeros(t.num_rows, np.int64)
        np.add.at(n_removed, owner, ends - begins)
        offs = np.concatenate(([0], np.cumsum(n_spans))).astype(np.int32)
        spans = pa.ListArray.from_arrays(pa.array(offs), pa.StructArray.from_arrays(
            [pa.array(begins - group.begin[owner]), pa.array(ends - group.begin[owner])], names=["begin", "end"]))
        left = [group.buf[a:b][~gone[a:b]].tobytes() if x else group.buf[a:b].tobytes()
                for a, b, x in zip(group.begin, group.end, n_removed)]
        more = []
        if as_text:
            cut = np.flatnonzero(n_removed)
            whole = pa.array([left[i].decode("utf-8", "ignore") for i in cut.tolist()], t.schema.field(text).type)
            given = t.column(text).combine_chunks() if t.num_rows else pa.array([], t.schema.field(text).type)
            more = [pc.replace_with_mask(given, pa.array(n_removed > 0), whole)]
        return pa.table([*[t.column(c) for c in kept], pa.array(group.end - group.begin), pa.array(n_removed),
                         pa.array(n_spans.astype(np.int64)), spans, pa.array(left, pa.binary()), *more], names=[*kept, *added])

    def removed(t: pa.Table, r: pa.Table) -> pa.Table:
        return remove(t, r) if t.num_rows else remove(t.slice(0, 0), r.slice(0, 0))

    return base.groupBy("__g").cogroup(answers.groupBy("g")).applyInArrow(lambda t, r: freed(removed, t, r), out_schema)
