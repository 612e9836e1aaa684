"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Base spans (email, ip, card, phone) are exact patterns with a check and are always
returned.  The method adds spans of further kinds:

1. *Labelers.*  Every candidate (a match of a kind's pattern, base matches and those
   that fail their check included) gets a vote of 1, 0 (none) or -1 of each of five
   labelers: form (a token of its own), check (checksum or range), gazetteer (known
   names, countries, issuers, top domains), context (cue words before it) and company
   (a base span nearby).
2. *Expectation-maximisation* over the counts of (kind, votes) of all documents
   estimates how often each labeler's votes are right and each kind's share of true
   candidates.  The counts are aggregated by Spark; what EM
   reads is bounded by kinds x 3^5.
3. *Span classifier.*  A logistic model on votes, shape and neighbouring words of a
   candidate learns EM's posteriors from a bounded sample: of each kind the distinct
   candidates with the ``SAMPLE`` smallest hashes.  Candidates of the added kinds that
   it scores at 0.5 or more become spans; a failed base match never does.

Texts are read twice, by maps without a shuffle of texts; patterns take linear time.
A span's start and end count code points, the end is exclusive.

Defined results: null texts are empty and have no spans; rows repeat as given; an
empty table gives no rows; without candidates there is no classifier and only base
spans are found.  Carried columns named like a result are returned as ``input_<name>``.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import carried, stage

BASE = ("email", "ip", "card", "phone")
ADDED = ("hidden_email", "iban", "local_phone", "national_id", "person")
KINDS = BASE + ADDED
LABELERS = ("form", "check", "gazetteer", "context", "company")
NEAR = 160              # code points within which a base span is company
BEFORE = 48             # code points in which cue words count
SAMPLE = 4000           # distinct candidates of a kind that the classifier learns from
FEATURES = 1 << 12
BELIEF = {"form": 0.6, "check": 0.95, "gazetteer": 0.7, "context": 0.85, "company": 0.55}    # that a vote is right, before any data
STEPS = 300

# Cue words, names and codes that labelers know.
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Señor Señora".split()
GIVEN = ("James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph Jessica "
         "Thomas Sarah Charles Karen Daniel Nancy Matthew Lisa Anthony Margaret Mark Sandra Paul Ashley Steven Kimberly Andrew "
         "Emily Kenneth Donna Hans Greta Jürgen Ursula Pierre Juliette Jacques Amélie José Carmen Carlos Lucía").split()
TOP_DOMAINS = "com org net edu gov info io co uk de fr es eu us ca au ch at it nl se".split()
IBAN_LENGTH = {"AT": 20, "BE": 16, "CH": 21, "DE": 22, "ES": 24, "FR": 27, "GB": 22, "IE": 22, "IT": 27, "NL": 18, "PL": 28, "PT": 25, "SE": 24}
CUES = {
    "email": "email mail contact write correo courriel address", "hidden_email": "email mail contact write correo courriel address",
    "ip": "ip host server address login client", "card": "card visa mastercard credit payment karte carte tarjeta",
    "phone": "phone call tel telephone mobile cell fax telefon téléphone teléfono", "local_phone": "phone call tel telephone mobile cell fax telefon téléphone teléfono",
    "national_id": "ssn social security national id", "iban": "iban account bank konto compte cuenta",
    "person": "name contact dear by signed regards sincerely",
}
ANTI = set("order invoice version isbn page section serial ref build sku chapter item part total figure table".split())
CUE_SETS = {k: set(v.split()) for k, v in CUES.items()}

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_HIDDEN = re.compile(r" ?[\[(] ?(?:at|AT) ?[\])] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[(] ?(?:dot|DOT) ?[\])]) ?[A-Za-z0-9-]{1,63}){1,8}")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.(-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_PERSON = re.compile(r"\b(?:(?:%s)\.? |(?:%s) )[A-ZÀ-Þ][a-zß-ÿ]{1,30}(?: [A-ZÀ-Þ][a-zß-ÿ]{1,30})?" % ("|".join(TITLES), "|".join(GIVEN)))
_WORD = re.compile(r"\w+")
_GIVEN, _TOP = frozenset(GIVEN), frozenset(TOP_DOMAINS)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(t: str):
    last = 0
    for m in _DOMAIN.finditer(t):
        s = m.start()
        while s > last and t[s - 1] in _LOCAL:
            s -= 1
        if s < m.start():
            last = m.end()
            yield s, m.end()


def base_matches(t: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, passes its check) of the base patterns' leftmost matches."""
    out = [("email", s, e, True) for s, e in _emails(t)] if "@" in t else []
    if _DIGIT.search(t) is None:
        return out
    if "." in t:
        for m in _IP.finditer(t):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            out.append(("ip", *m.span(), all(len(p) < 4 and int(p or "0") < 256 for p in parts)))
    for m in _CARD.finditer(t):
        if m.end() - m.start() >= 14:
            d = _digits(m.group())
            out.append(("card", *m.span(), 14 <= len(d) <= 19 and luhn(d)))
    if "+" in t:
        out += [("phone", *m.span(), 10 <= len(_digits(m.group())) <= 15) for m in _PHONE.finditer(t)]
    return out


def added_matches(t: str, taken: list[tuple[str, int, int, bool]]) -> list[tuple[str, int, int]]:
    """Candidates of the added kinds that don't overlap a base span."""
    out = []
    if "at" in t or "AT" in t:
        for m in _HIDDEN.finditer(t):
            s = m.start()
            while s > 0 and m.start() - s < 64 and t[s - 1] in _LOCAL:
                s -= 1
            if s < m.start():
                out.append(("hidden_email", s, m.end()))
    if _DIGIT.search(t) is not None:
        for kind, p in (("iban", _IBAN), ("local_phone", _LOCAL_PHONE), ("national_id", _NATIONAL)):
            out += [(kind, *m.span()) for m in p.finditer(t)]
    out += [("person", *m.span()) for m in _PERSON.finditer(t)]
    if not taken or not out:
        return out
    spans = sorted((s, e) for _, s, e, ok in taken if ok)
    starts = [s for s, _ in spans]
    # base spans of different kinds can overlap: the furthest end so far decides
    reach = np.maximum.accumulate([e for _, e in spans]) if spans else np.zeros(0, int)
    at = np.searchsorted(starts, [e for _, _, e in out], side="left")
    return [c for c, i in zip(out, at) if not i or reach[i - 1] <= c[1]]


def _check(kind: str, s: str, ok: bool) -> int:
    if kind in BASE and kind != "email":
        return 1 if ok else -1
    if kind == "email":
        return 1 if s.rsplit(".", 1)[-1].isalpha() else -1
    if kind == "iban":
        b = s.replace(" ", "")
        return 1 if int("".join(str(int(c, 36)) for c in b[4:] + b[:4])) % 97 == 1 else -1
    if kind == "national_id":
        return -1 if s[:3] in ("000", "666") or s[0] == "9" or s[4:6] == "00" or s[7:] == "0000" else 1
    if kind == "local_phone":
        d = _digits(s)
        return 1 if d[0] in "23456789" and d[3] in "23456789" else -1
    return 0


def _known(kind: str, s: str) -> int:
    if kind in ("email", "hidden_email"):
        return 1 if re.split(r"[^A-Za-z]+", s)[-1].lower() in _TOP else 0
    if kind == "card":
        return 1 if s[0] in "3456" else -1
    if kind == "ip":
        return -1 if s.split(".")[0].lstrip("0") in ("", "127", "255") else 0
    if kind == "iban":
        return 1 if IBAN_LENGTH.get(s[:2]) == len(s.replace(" ", "")) else -1
    if kind == "person":
        return 1 if any(w in _GIVEN for w in s.split()) else 0
    return 0


def votes(t: str, kind: str, s: int, e: int, ok: bool, base: np.ndarray) -> tuple[int, ...]:
    """One vote of each labeler; base: sorted starts and ends of the text's base spans (2, n)."""
    alone = (s == 0 or not t[s - 1].isalnum()) and (e == len(t) or not t[e].isalnum())
    words = [w.lower() for w in _WORD.findall(t[max(0, s - BEFORE):s])]
    cue = CUE_SETS[kind].intersection(words)
    context = 1 if cue else -1 if ANTI.intersection(words[-3:]) else 0
    lo, hi = np.searchsorted(base[1], s - NEAR), np.searchsorted(base[0], e + NEAR, side="right")
    others = int(hi - lo) - (kind in BASE and ok)
    return (1 if alone else -1, _check(kind, t[s:e], ok), _known(kind, t[s:e]), context, 1 if others > 0 else 0)


def _shape(s: str) -> str:
    out = []
    for c in s[:64]:
        k = "9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out)[:24]


def features(t: str, kind: str, s: int, e: int, given: tuple[int, ...]) -> list[int]:
    before, after = _WORD.findall(t[max(0, s - BEFORE):s]), _WORD.findall(t[e:e + BEFORE])
    names = [f"{kind}|{name}|{v}" for name, v in zip(LABELERS, given)]
    names += [f"{kind}|shape|{_shape(t[s:e])}", f"{kind}|before|{before[-1].lower() if before else ''}", f"{kind}|after|{after[0].lower() if after else ''}"]
    return sorted({zlib.crc32(x.encode()) % FEATURES for x in names})


def candidates(t: str) -> list[tuple[str, int, int, bool, tuple[int, ...]]]:
    """(kind, start, end, base match that passes, votes) of every candidate of a text."""
    base = base_matches(t)
    more = added_matches(t, base)
    if not base and not more:
        return []
    good = [(s, e) for _, s, e, ok in base if ok]
    edges = np.array([sorted(s for s, _ in good), sorted(e for _, e in good)], np.int64).reshape(2, -1)
    rows = base + [(k, s, e, False) for k, s, e in more]
    return [(k, s, e, ok, votes(t, k, s, e, ok, edges)) for k, s, e, ok in rows]


# --- expectation-maximisation ----------------------------------------------

@dataclass
class Model:
    """Labeler reliabilities, shares of true candidates and the classifier's weights."""

    right: np.ndarray       # of each labeler: chance that a vote of 1 or -1 is right
    share: dict[str, float]
    weights: np.ndarray

    def posterior(self, kind: str, v: tuple[int, ...]) -> float:
        odds = np.log(self.share.get(kind, 0.5)) - np.log1p(-self.share.get(kind, 0.5)) + float(np.dot(v, _weight(self.right)))
        return float(1 / (1 + np.exp(-odds)))

    def score(self, feats: list[int]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[feats].sum() + self.weights[-1], -30, 30))))


def _weight(right: np.ndarray) -> np.ndarray:
    """Log-odds that a vote adds."""
    return np.log(right) - np.log1p(-right)


def reliabilities(counts: list[tuple[str, tuple[int, ...], int]], rounds: int = 500) -> tuple[np.ndarray, dict[str, float]]:
    """EM over (kind, votes, count): how often each labeler's votes are right, and each kind's share of true candidates.

    A labeler that abstains tells nothing.  Pseudo-counts (``BELIEF``, a tenth of all candidates) say that
    labelers are right more often than wrong, which tells true from false.
    """
    right = np.array([BELIEF[name] for name in LABELERS])
    kinds = sorted({k for k, _, _ in counts})
    share = np.full(len(kinds), 0.5)
    if not counts:
        return right, {}
    kind = np.array([kinds.index(k) for k, _, _ in counts])
    v = np.array([x for _, x, _ in counts], float).reshape(-1, len(LABELERS))
    n = np.array([c for _, _, c in counts], float)
    belief, scale = right.copy(), 0.1 * n.sum() + 1
    for _ in range(rounds):
        odds = np.log(share[kind]) - np.log1p(-share[kind]) + v @ _weight(right)
        p = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        hit = (n[:, None] * np.where(v > 0, p[:, None], np.where(v < 0, 1 - p[:, None], 0))).sum(0)
        new = np.clip((hit + belief * scale) / ((n[:, None] * (v != 0)).sum(0) + scale), 0.5, 0.99)
        share = (np.bincount(kind, p * n, len(kinds)) + 1) / (np.bincount(kind, n, len(kinds)) + 2)
        moved = np.abs(new - right).max()
        right = new
        if moved < 1e-9:
            break
    return right, dict(zip(kinds, share.tolist()))


def train(rows: list[tuple[list[int], float]], steps: int = STEPS) -> np.ndarray:
    """Logistic weights (the last is the bias) of feature lists with soft labels, by gradient steps with a small penalty."""
    w = np.zeros(FEATURES + 1)
    if not rows:
        return w
    size = np.array([len(f) for f, _ in rows])
    flat = np.concatenate([np.asarray(f, int) for f, _ in rows])
    own = np.repeat(np.arange(len(rows)), size)
    y = np.array([p for _, p in rows])
    speed = np.zeros_like(w)
    for _ in range(steps):
        z = np.bincount(own, w[flat], len(rows)) + w[-1]
        gap = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(rows)
        g = np.append(np.bincount(flat, gap[own], FEATURES), gap.sum()) + 1e-5 * w
        speed += g * g
        w -= 0.3 * g / (np.sqrt(speed) + 1e-9)
    return w


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Model:
    """Reliabilities from the votes on all documents; classifier from a bounded sample of distinct candidates."""
    def run(batches):
        for batch in batches:
            kind, vote, feats = [], [], []
            for t in batch.column(0).to_pylist():
                for k, s, e, _, v in candidates(t) if t else ():
                    kind.append(k)
                    vote.append(v)
                    feats.append(features(t, k, s, e, v))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind, pa.string()), pa.array(vote, pa.list_(pa.int32())), pa.array(feats, pa.list_(pa.int32()))], ["kind", "votes", "feats"])

    seen = docs.select(F.col(f"`{text}`")).mapInArrow(run, "kind string, votes array<int>, feats array<int>")
    seen = stage(seen.groupBy("kind", "votes", "feats").agg(F.count("*").alias("n")))
    counts = seen.groupBy("kind", "votes").agg(F.sum("n").alias("n")).orderBy("kind", "votes").collect()
    right, share = reliabilities([(r["kind"], tuple(r["votes"]), r["n"]) for r in counts])
    model = Model(right, share, np.zeros(FEATURES + 1))
    rows = []
    for k in sorted(share):
        h = F.xxhash64("votes", "feats")
        got = seen.where(F.col("kind") == k).select("votes", "feats", h.alias("h")).orderBy("h", "votes", "feats").limit(sample).collect()
        rows += [(r["feats"], model.posterior(k, tuple(r["votes"]))) for r in got]
    model.weights = train(rows)
    return model


RESULT = "spans"


def find(docs: DataFrame, model: Model | None, carry: list[Column | str], text: str = "text") -> DataFrame:
    """carry..., spans array<struct<kind, start, end, base, score>> by start, then kind, of every whole text."""
    src = docs.select(*carried(docs, carry, [RESULT]), F.col(f"`{text}`").alias("__text"))
    kept = src.columns[:-1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    kinds = {k: i for i, k in enumerate(KINDS)}
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())])

    def spans_of(t: str | None) -> list[tuple]:
        out = []
        for k, s, e, ok, v in candidates(t) if t else ():
            if ok:
                out.append((s, kinds[k], k, e, True, 1.0))
            elif k in ADDED and model is not None and (p := model.score(features(t, k, s, e, v))) >= 0.5:
                out.append((s, kinds[k], k, e, False, p))
        return [{"kind": k, "start": s, "end": e, "base": b, "score": p} for s, _, k, e, b, p in sorted(out)]

    def run(batches):
        for batch in batches:
            found = [spans_of(t) for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(found, pa.list_(span))], [*kept, RESULT])

    lead = f"{schema}, " if kept else ""
    return src.mapInArrow(run, f"{lead}{RESULT} array<struct<kind: string, start: int, end: int, base: boolean, score: double>>")
