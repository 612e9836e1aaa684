"""SentencePiece encoding and decoding by suffix-array matching.

A batch's distinct segments are concatenated and indexed by a suffix array;
every piece of the vocabulary is binary-searched in it, which gives all its
occurrences as one range.  The occurrences are edges (begin, end, piece),
sorted by position, and a relaxation over them picks the segmentation:

* unigram models: the best sum of scores, relaxed left to right;
* BPE models: edges are taken in order of merge rank, leftmost first, wherever
  an edge joins two neighbouring symbols, which is what BPE merging does.

What no piece covers becomes byte pieces (or the unknown id).  A text is cut
into segments only where no piece can span the cut (before a space mark that
follows another symbol, when no piece holds a mark inside), so each distinct
segment is encoded once a batch and whole texts are used.

Defined results: null and empty text have no ids and decode to an empty text;
decoding an id sequence restores the text, but for U+2581, which the model
itself reads as a space.  Rows repeat as given.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import release_memory
from tillcast.llm.suffix import suffix_array, words8

MARK = "▁"
MARK_B = MARK.encode()
#: fixed values: piece types of the model file
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: fixed values: model types of the trainer settings
UNIGRAM, BPE = 1, 2
CHUNK = 1 << 20             # bytes of distinct segments indexed at once
SLICE = 2 << 20             # bytes of the texts that a task encodes at once
CACHE = 1 << 18             # segments kept from slice to slice
MAX_PIECE_DEPTH = 64        # longest piece in bytes that the index orders by


def _fields(data: bytes):
    """(field number, value) pairs of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        shift = value = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            yield tag >> 3, data[at:at + n]
            at += n
        elif kind == 5:
            yield tag >> 3, data[at:at + 4]
            at += 4
        else:
            yield tag >> 3, data[at:at + 8]
            at += 8


@dataclass
class Model:
    pieces: list[bytes]
    scores: np.ndarray
    kinds: np.ndarray
    kind: int = UNIGRAM
    dummy_prefix: bool = True
    squeeze: bool = True
    byte_ids: np.ndarray | None = None
    unk: int = 0
    #: searchable pieces in byte order: ids
    order: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    splits: bool = True
    #: of the searchable pieces: lengths, bytes as rows of 8-byte words, bits after the first word's end
    plen: np.ndarray | None = None
    want: np.ndarray | None = None
    tail: np.ndarray | None = None

    def __post_init__(self):
        ids = [i for i, k in enumerate(self.kinds) if k in (NORMAL, USER) and self.pieces[i]]
        self.order = np.array(sorted(ids, key=lambda i: self.pieces[i]), dtype=np.int64)
        if max((len(self.pieces[i]) for i in ids), default=0) > MAX_PIECE_DEPTH:
            raise ValueError("a piece is longer than the index orders by")
        self.plen = np.array([len(self.pieces[i]) for i in self.order], np.int64)
        packed = np.zeros((len(self.order), MAX_PIECE_DEPTH), np.uint8)
        for k, i in enumerate(self.order):
            packed[k, :self.plen[k]] = np.frombuffer(self.pieces[i], np.uint8)
        self.want = packed.view(">u8").astype(np.uint64)
        gap = np.uint64(8) * np.minimum(self.plen, 8).astype(np.uint64)
        self.tail = np.where(gap < 64, np.uint64(0xFFFFFFFFFFFFFFFF) >> (gap % np.uint64(64)), np.uint64(0))
        # a cut before a mark is safe if no piece has a mark after another symbol
        def spans(p):
            return MARK_B in p.lstrip(MARK_B) if p.startswith(MARK_B) else MARK_B in p
        self.splits = not any(spans(_strip_marks(self.pieces[i])) for i in ids)


def _strip_marks(p: bytes) -> bytes:
    while p.startswith(MARK_B):
        p = p[len(MARK_B):]
    return p


def load_model(path: str) -> Model:
    """Read a SentencePiece model file."""
    with open(path, "rb") as f:
        data = f.read()
    pieces, scores, kinds = [], [], []
    model = {"kind": UNIGRAM, "dummy_prefix": True, "squeeze": True}
    for num, value in _fields(data):
        if num == 1:
            piece, score, kind = b"", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            pieces.append(piece)
            scores.append(score)
            kinds.append(kind)
        elif num == 2:
            model["kind"] = next((v for n, v in _fields(value) if n == 3), UNIGRAM)
        elif num == 3:
            for n, v in _fields(value):
                if n == 3:
                    model["dummy_prefix"] = bool(v)
                elif n == 4:
                    model["squeeze"] = bool(v)
                elif n == 2 and v:
                    raise ValueError("models with a character map are not read")
    if model["squeeze"]:
        raise ValueError("models that squeeze spaces are not read")
    kinds_a = np.array(kinds)
    byte_ids = None
    if (kinds_a == BYTE).sum() == 256:
        byte_ids = np.zeros(256, np.int64)
        for i in np.flatnonzero(kinds_a == BYTE):
            byte_ids[int(pieces[i][3:5], 16)] = i
    unk = int(np.flatnonzero(kinds_a == UNKNOWN)[0])
    return Model(pieces, np.array(scores, np.float64), kinds_a, byte_ids=byte_ids, unk=unk, **model)


def find_edges(model: Model, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, piece id) of every occurrence of every piece in ``text``, sorted by begin and end."""
    n = len(text)
    sa = suffix_array(text, MAX_PIECE_DEPTH)
    buf = np.concatenate((text, np.zeros(MAX_PIECE_DEPTH + 16, np.uint8)))
    words = words8(buf, n + MAX_PIECE_DEPTH)
    plen, want, tail = model.plen, model.want, model.tail
    first = words[sa]
    # the first 8 bytes: all pieces at once; the rest of longer pieces: narrow each range
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    lo = np.searchsorted(first, want[:, 0], side="left")
    hi = np.searchsorted(first, want[:, 0] | tail, side="right")
    for k in np.flatnonzero((plen > 8) & (hi > lo)):
        a, b = lo[k], hi[k]
        for j in range(1, -(-plen[k] // 8)):
            part = words[sa[a:b] + 8 * j]
            rest = min(8, plen[k] - 8 * j)
            up = want[k, j] | (full >> np.uint64(8 * rest) if rest < 8 else np.uint64(0))
            a, b = a + np.searchsorted(part, want[k, j], side="left"), a + np.searchsorted(part, up, side="right")
            if a >= b:
                break
        lo[k], hi[k] = a, max(a, b)
    count = hi - lo
    total = int(count.sum())
    rank = np.repeat(lo - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(total)
    begins = sa[rank]
    lens = np.repeat(plen, count)
    ids = np.repeat(model.order, count)
    order = np.argsort(begins * (MAX_PIECE_DEPTH + 1) + lens, kind="stable")
    return begins[order], (begins + lens)[order], ids[order]


def _bpe(model: Model, text: np.ndarray, starts: np.ndarray, edges) -> tuple[np.ndarray, np.ndarray]:
    """(begin, piece id or -1) of the final symbols of all segments."""
    begin, end, pid = edges
    n = len(text)
    key = begin * np.int64(MAX_PIECE_DEPTH + 1) + (end - begin)

    def lookup(b, e):
        length = e - b
        k = b * np.int64(MAX_PIECE_DEPTH + 1) + length
        at = np.minimum(np.searchsorted(key, k), max(len(key) - 1, 0))
        ok = (key[at] == k) & (length <= MAX_PIECE_DEPTH) if len(key) else np.zeros(len(k), bool)
        return np.where(ok, pid[at] if len(key) else 0, -1)

    # symbols: characters at first
    sym = np.flatnonzero((text & 0xC0) != 0x80)
    seg = np.searchsorted(starts, sym, side="right") - 1
    stop = np.concatenate((starts[1:], [n]))
    rank_of = -model.scores                                # smaller merges first
    big = np.inf

    nxt = np.concatenate((sym[1:], [n]))
    # pair of each symbol with its right neighbour in the segment
    def pair_rank(b, second_end, s):
        inside = second_end <= stop[s]
        p = lookup(b, np.where(inside, second_end, b + 1))
        return np.where(inside & (p >= 0), rank_of[np.maximum(p, 0)], big)

    end_of = nxt
    second = np.concatenate((end_of[1:], [n + 1]))
    rank = pair_rank(sym, second, seg)
    live_sym, live_end, live_seg, live_rank = sym, end_of, seg, rank
    done_b: list[np.ndarray] = []
    done_e: list[np.ndarray] = []
    while len(live_sym):
        head = np.flatnonzero(np.concatenate(([True], live_seg[1:] != live_seg[:-1])))
        best = np.minimum.reduceat(live_rank, head)
        size = np.diff(np.concatenate((head, [len(live_sym)])))
        going = np.repeat(np.isfinite(best), size)
        if not going.all():
            done_b.append(live_sym[~going])
            done_e.append(live_end[~going])
            live_sym, live_end, live_seg, live_rank = (x[going] for x in (live_sym, live_end, live_seg, live_rank))
            if not len(live_sym):
                break
            size, best = size[np.isfinite(best)], best[np.isfinite(best)]
            head = np.concatenate(([0], np.cumsum(size)[:-1]))
        hit = np.flatnonzero(live_rank == np.repeat(best, size))
        # leftmost of each segment
        s = live_seg[hit]
        hit = hit[np.concatenate(([True], s[1:] != s[:-1]))]
        live_end[hit] = live_end[hit + 1]
        keep = np.ones(len(live_sym), bool)
        keep[hit + 1] = False
        moved = hit - np.arange(len(hit))                  # where the merged symbols are afterwards
        live_sym, live_end, live_seg, live_rank = (x[keep] for x in (live_sym, live_end, live_seg, live_rank))
        m = len(live_sym)
        for at in (moved, moved[moved > 0] - 1):
            right = np.minimum(at + 1, m - 1)
            same = (at + 1 < m) & (live_seg[right] == live_seg[at])
            live_rank[at] = np.where(same, pair_rank(live_sym[at], live_end[right], live_seg[at]), big)
    b = np.concatenate(done_b) if done_b else np.zeros(0, np.int64)
    e = np.concatenate(done_e) if done_e else np.zeros(0, np.int64)
    order = np.argsort(b)
    b, e = b[order], e[order]
    return np.concatenate((b, [n])), lookup(b, e)


def _unigram(model: Model, text: np.ndarray, starts: np.ndarray, edges) -> tuple[np.ndarray, np.ndarray]:
    """Best sum of scores by relaxing the sorted edges; an uncovered character costs more than any piece."""
    begin, end, pid = edges
    n = len(text)
    penalty = float(model.scores[(model.kinds == NORMAL)].min(initial=0.0)) - 10.0
    heads = np.concatenate((np.flatnonzero((text & 0xC0) != 0x80), [n]))
    best = np.full(n + 1, -np.inf)
    best[0] = 0.0
    back = np.full(n + 1, -1, np.int64)
    how = np.full(n + 1, -1, np.int64)
    first = np.searchsorted(begin, np.arange(n + 1))
    stops = set(starts.tolist())
    for j in range(len(heads) - 1):
        a, z = int(heads[j]), int(heads[j + 1])
        base = 0.0 if a in stops else best[a]
        if a in stops:
            best[a] = 0.0
        for k in range(first[a], first[a + 1]):
            v = base + model.scores[pid[k]]
            if v > best[end[k]]:
                best[end[k]], back[end[k]], how[end[k]] = v, a, pid[k]
        if base + penalty > best[z]:
            best[z], back[z], how[z] = base + penalty, a, -1
    b, ids, at = [], [], n
    while at > 0:
        b.append(int(back[at]))
        ids.append(int(how[at]))
        at = int(back[at])
    return np.array([*b[::-1], n], np.int64), np.array(ids[::-1], np.int64)


def encode_segments(model: Model, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all segments one after another, offsets)."""
    sep = b"\x00" if not any(b"\x00" in model.pieces[i] for i in model.order) else b""
    # segments are kept apart by a zero byte, which no searched piece holds
    sizes = np.array([len(s) for s in segments], np.int64)
    text = np.frombuffer(sep.join(segments) + sep, np.uint8)
    begins = np.concatenate(([0], np.cumsum(sizes + len(sep))))[:-1]
    edges = find_edges(model, text)
    inside = np.searchsorted(begins, edges[0], side="right") - 1
    ok = edges[1] <= (begins + sizes)[inside]
    edges = tuple(x[ok] for x in edges)
    # the separators are segments of their own for the relaxation
    cuts = np.sort(np.concatenate((begins, begins + sizes))) if len(sep) else begins
    cuts = cuts[cuts < len(text)]
    relax = _bpe if model.kind == BPE else _unigram
    bounds, ids = relax(model, text, np.unique(cuts), edges)
    b, e = bounds[:-1], bounds[1:]
    owner = np.searchsorted(begins, b, side="right") - 1
    own = b < (begins + sizes)[owner]                       # not a separator
    b, e, ids, owner = b[own], e[own], ids[own], owner[own]
    miss = ids < 0
    if model.byte_ids is None:
        out, n_of = np.where(miss, model.unk, ids), np.ones(len(ids), np.int64)
    else:
        n_of = np.where(miss, e - b, 1)
        out = np.repeat(ids, n_of)
        place = np.repeat(b - np.concatenate(([0], np.cumsum(n_of)[:-1])), n_of) + np.arange(len(out))
        spelled = np.repeat(miss, n_of)
        out[spelled] = model.byte_ids[text[place[spelled]]]
    offs = np.concatenate(([0], np.cumsum(np.bincount(owner, n_of, len(segments)).astype(np.int64))))
    return out, offs


def segments_of(model: Model, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Marked segments of all texts, one after another, and the offsets of each text."""
    t = pc.replace_substring(pc.fill_null(texts, ""), " ", MARK)
    if model.dummy_prefix:
        t = pc.if_else(pc.equal(pc.binary_length(t), 0), t, pc.binary_join_element_wise(pa.scalar(MARK, pa.large_string()), t, pa.scalar("", pa.large_string())))
    if model.splits:
        # cut before a mark that follows another symbol
        t = pc.replace_substring_regex(t, f"([^{MARK}])({MARK})", "\\1\x00\\2")
        clash = pc.any(pc.match_substring(texts, "\x00")).as_py()
        if clash:   # a text that holds the cut character is one segment
            t = pc.if_else(pc.fill_null(pc.match_substring(texts, "\x00"), False),
                           pc.replace_substring_regex(t, f"([^{MARK}])\x00({MARK})", "\\1\\2"), t)
            parts = [[x.as_py()] if b else x.as_py().split("\x00")
                     for x, b in zip(t, pc.fill_null(pc.match_substring(texts, "\x00"), False).to_pylist())]
            t = pa.array(parts, pa.large_list(pa.large_string()))
        else:
            t = pc.split_pattern(t, "\x00")
    else:
        t = pa.array([[x] for x in t.to_pylist()], pa.large_list(pa.large_string()))
    flat = t.flatten()
    offs = t.offsets.to_numpy().astype(np.int64)
    return flat, offs - offs[0]


def _encode_words(model: Model, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all segments, number of each).  A zero byte is its own symbol: no piece holds one."""
    parts = [p for w in words for p in w.split(b"\x00")]
    ids_of, n_of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    sizes = np.cumsum([0, *map(len, parts)])
    lo = 0
    while lo < len(parts):
        hi = max(lo + 1, int(np.searchsorted(sizes, sizes[lo] + CHUNK, side="right")) - 1)
        ids, offs = encode_segments(model, parts[lo:hi])
        ids_of.append(ids)
        n_of.append(np.diff(offs))
        lo = hi
    ids, n = np.concatenate(ids_of), np.concatenate(n_of)
    if len(parts) == len(words):
        return ids, n
    zero = model.byte_ids[0] if model.byte_ids is not None else model.unk
    k = np.array([w.count(b"\x00") + 1 for w in words])
    last = np.cumsum(k) - 1
    inner = np.ones(len(parts), bool)
    inner[last] = False                                     # a zero follows each part but a segment's last
    ends = np.cumsum(n)
    return np.insert(ids, ends[inner], zero), np.add.reduceat(n + inner, last - k + 1)


class Segments:
    """Ids of the distinct segments seen by a task, up to ``CACHE`` of them."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.ends = np.zeros(1, np.int64)

    def add(self, words: list[str], ids: np.ndarray, n: np.ndarray) -> None:
        at, size = len(self.index), int(self.ends[-1])
        self.index.update(zip(words, range(at, at + len(words))))
        if size + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids[:size], np.zeros(max(len(self.ids), len(ids)), np.int32)))
        self.ids[size:size + len(ids)] = ids
        self.ends = np.concatenate((self.ends, size + np.cumsum(n)))


def encode_batch(model: Model, texts: pa.Array, seen: Segments | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, offsets); each distinct segment is encoded once, ``seen`` ones not again."""
    seen = Segments() if seen is None else seen
    flat, offs = segments_of(model, texts)
    enc = flat.dictionary_encode()
    words = enc.dictionary.to_pylist()
    code = enc.indices.to_numpy().astype(np.int64)
    if len(seen.index) > CACHE:
        seen.__init__()
    fresh = [w for w in words if w not in seen.index]
    if fresh:
        seen.add(fresh, *_encode_words(model, [w.encode() for w in fresh]))
    slot = np.fromiter(map(seen.index.__getitem__, words), np.int64, len(words))[code]
    take = (seen.ends[1:] - seen.ends[:-1])[slot]
    ends = np.concatenate(([0], np.cumsum(take)))
    place = np.repeat(seen.ends[slot] - ends[:-1], take) + np.arange(ends[-1])
    return seen.ids[place], ends[offs]


def decode_ids(model: Model, ids: np.ndarray, offs: np.ndarray) -> list[bytes]:
    """UTF-8 text of each id sequence."""
    spelled = [b"" if k in (CONTROL,) else p for p, k in zip(model.pieces, model.kinds)]
    if model.byte_ids is not None:
        for b, i in enumerate(model.byte_ids):
            spelled[i] = bytes([b])
    size = np.array([len(s) for s in spelled], np.int64)
    table = np.frombuffer(b"".join(spelled), np.uint8)
    start = np.concatenate(([0], np.cumsum(size)))[:-1]
    n = size[ids]
    ends = np.concatenate(([0], np.cumsum(n)))
    raw = table[np.repeat(start[ids] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
    out = []
    for a, b in zip(ends[offs[:-1]], ends[offs[1:]]):
        t = raw[a:b].replace(MARK_B, b" ")
        out.append(t[1:] if model.dummy_prefix and t[:1] == b" " else t)
    return out


def encode(docs: DataFrame, model_path: str, text: str = "text", check: bool = True) -> DataFrame:
    """Input columns plus ids (array<int>) and decoded (the text restored from ids).

    The model is read on the driver (its size is the vocabulary's) and sent to
    the tasks with the function; texts are handled in Arrow batches.
    """
    model = load_model(model_path)
    kept = [c for c in docs.columns if c not in ("ids", "decoded")]
    src = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields)

    def run(batches):
        seen = Segments()
        for batch in batches:
            yield from encoded(seen, batch)
            del batch                   # before the next one is read
        del seen
        release_memory()

    def encoded(seen, batch):
        column = batch.column(text).cast(pa.large_string())
        size = pc.binary_length(pc.fill_null(column, "")).to_numpy()
        cum = np.concatenate(([0], np.cumsum(size)))
        lo = 0
        while lo < batch.num_rows:
            hi = min(batch.num_rows, max(lo + 1, int(np.searchsorted(cum, cum[lo] + SLICE, side="right")) - 1))
            part = batch.slice(lo, hi - lo)
            ids, offs = encode_batch(model, part.column(text).cast(pa.large_string()), seen)
            back = decode_ids(model, ids, offs)
            arr = pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(ids.astype(np.int32)))
            dec = pa.array(back, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], arr, dec], [*kept, "ids", "decoded"])
            lo = hi

    return src.mapInArrow(run, f"{schema}, ids array<int>, decoded string")
