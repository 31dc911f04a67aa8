"""Personal data: patterns plus a character-level BiLSTM-CRF.

Patterns give the base spans. The model reads windows of characters around
every place that may belong to personal data (a digit, ``@`` or ``+``; a
window without one is outside by definition). Overlapping windows are decoded
together: each character's scores are averaged over the windows that hold it,
and one Viterbi pass over each joined stretch gives its tags, so two windows
can never disagree. What the model adds must still have the form of its kind
(a card number passes Luhn, an address has four parts up to 255, a phone
number 8 to 15 digits, an email an ``@`` or "at" and a dot or "dot") and must
not touch a base span.

The model is trained here, in numpy, from labelled spans: base spans of a
bounded, seeded sample of documents, and the same spans written in other ways
("name (at) host dot org", "(017) 555 7713"). It has some 6,000 weights and
travels to the executors as one small broadcast of fixed size.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewash.llm.common import only, staged, table

# Fixed values of the result contract.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@+]|\b(?:at|AT)\b(?=\s?[\])}])")
#: What an item can go on with: a run of name characters, with a "dot" or a bracketed dot and more of them.
_TAIL = re.compile(r"[A-Za-z0-9._%+@-]*+(?:\s?[\[({]?\s?(?:\.|dot\b|DOT\b)\s?[\])}]?\s?[A-Za-z0-9-]++)*+")

#: What a text with a base span matches, for Spark.
_MAY_HOLD = (r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]+\.[A-Za-z0-9-]|[0-9]\.[0-9]+\.[0-9]+\.[0-9]"
             r"|[0-9](?:[\x20-]?[0-9]){15}|\+[0-9][\x20().0-9-]+[0-9]")

#: Documents that the model is trained on at most, and its seed.
TRAIN_DOCS = 400
SEED = 7
WINDOW, STRIDE, CONTEXT = 64, 32, 24
STEPS, BATCH, RATE = 500, 96, 0.03
EMBED, HIDDEN = 12, 16
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
#: Mean margin per character by which a span's emissions must beat "outside"; the
#: form check follows, so the transitions' own decision stands.
MARGIN = 0.0


# --------------------------------------------------------------- base spans

def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start: leftmost
    non-overlapping matches of each kind without those that fail its check."""
    out = []
    done, at = 0, text.find("@")
    while at >= 0:  # only the run of name characters before an @ can start a match
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            out.append(("email", start, match.end()))
            done = match.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(int(p) <= 255 if len(p) < 10 else int(p.lstrip("0") or "0") <= 255 for p in _parts(m[0])):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0]) if m.end() - m.start() < 64 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def _parts(ip: str) -> list[str]:
    """The parts without leading zeros, a long one cut to what exceeds any limit."""
    return [(p.lstrip("0") or "0")[:9] for p in ip.split(".")]


# -------------------------------------------------------------------- model

def encode(text: str) -> np.ndarray:
    """Character classes 0..127: ASCII as itself, other letters 1, other
    upper-case letters 2, other digits 3, the rest 4."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    for i in np.flatnonzero(codes > 127):
        c = text[i]
        codes[i] = 2 if c.isupper() else 1 if c.isalpha() else 3 if c.isdigit() else 4
    return codes


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """Bidirectional LSTM over characters with CRF transitions, in numpy."""

    def __init__(self, seed: int = SEED):
        r = np.random.default_rng(seed)
        def init(*s):
            return r.normal(0, 1 / np.sqrt(s[0]), s)
        self.p = {"emb": r.normal(0, 0.3, (128, EMBED)), "out": init(2 * HIDDEN, TAGS), "ob": np.zeros(TAGS),
                  "trans": np.zeros((TAGS, TAGS))}
        # both directions side by side: entry 0 reads forwards, entry 1 backwards
        self.p["x"] = r.normal(0, 1 / np.sqrt(EMBED), (2, EMBED, 4 * HIDDEN))
        self.p["h"] = r.normal(0, 1 / np.sqrt(HIDDEN), (2, HIDDEN, 4 * HIDDEN))
        self.p["c"] = np.tile(np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)], (2, 1, 1))

    def _run(self, x):
        """Hidden states (2, batch, time, hidden) of the two directions, each
        in its own reading order, for (batch, time, embed) characters."""
        b, t, _ = x.shape
        both = np.stack([x, x[:, ::-1]])
        h, c = np.zeros((2, b, HIDDEN)), np.zeros((2, b, HIDDEN))
        pre = (both.reshape(2, b * t, EMBED) @ self.p["x"] + self.p["c"]).reshape(2, b, t, 4 * HIDDEN)
        hs, keep = np.zeros((2, b, t, HIDDEN)), []
        for i in range(t):
            z = pre[:, :, i] + h @ self.p["h"]
            g = _sigmoid(z[..., :3 * HIDDEN])
            i_, f_, o_ = g[..., :HIDDEN], g[..., HIDDEN:2 * HIDDEN], g[..., 2 * HIDDEN:]
            u = np.tanh(z[..., 3 * HIDDEN:])
            before, h_before = c, h
            c = f_ * c + i_ * u
            tc = np.tanh(c)
            h = o_ * tc
            hs[:, :, i] = h
            keep.append((i_, f_, o_, u, before, tc, h_before))
        return both, hs, keep

    def _back(self, both, keep, dhs, grads):
        _, b, t, _ = both.shape
        dh, dc = np.zeros((2, b, HIDDEN)), np.zeros((2, b, HIDDEN))
        dpre = np.zeros((2, b, t, 4 * HIDDEN))
        wh = self.p["h"].transpose(0, 2, 1)
        for i in range(t - 1, -1, -1):
            i_, f_, o_, u, before, tc, h_before = keep[i]
            dh = dh + dhs[:, :, i]
            dc = dc + dh * o_ * (1 - tc * tc)
            dz = dpre[:, :, i]
            dz[..., :HIDDEN] = dc * u * i_ * (1 - i_)
            dz[..., HIDDEN:2 * HIDDEN] = dc * before * f_ * (1 - f_)
            dz[..., 2 * HIDDEN:3 * HIDDEN] = dh * tc * o_ * (1 - o_)
            dz[..., 3 * HIDDEN:] = dc * i_ * (1 - u * u)
            grads["h"] += h_before.transpose(0, 2, 1) @ dz
            dh, dc = dz @ wh, dc * f_
        flat = dpre.reshape(2, b * t, 4 * HIDDEN)
        grads["x"] += both.reshape(2, b * t, EMBED).transpose(0, 2, 1) @ flat
        grads["c"] += flat.sum(1, keepdims=True)
        dx = (flat @ self.p["x"].transpose(0, 2, 1)).reshape(2, b, t, EMBED)
        return dx[0] + dx[1][:, ::-1]

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """(batch, time, tag) emission scores of (batch, time) codes."""
        _, hs, _ = self._run(self.p["emb"][codes])
        return np.concatenate([hs[0], hs[1][:, ::-1]], axis=2) @ self.p["out"] + self.p["ob"]

    def step(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean CRF loss of a batch and its gradients."""
        p, (b, t) = self.p, codes.shape
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        x = p["emb"][codes]
        read, hs, keep = self._run(x)
        both = np.concatenate([hs[0], hs[1][:, ::-1]], axis=2)
        e = both @ p["out"] + p["ob"]
        # forward-backward over the chain
        alpha, beta = np.zeros((t, b, TAGS)), np.zeros((t, b, TAGS))
        alpha[0] = e[:, 0]
        for i in range(1, t):
            alpha[i] = _lse(alpha[i - 1][:, :, None] + p["trans"], 1) + e[:, i]
        for i in range(t - 2, -1, -1):
            beta[i] = _lse(p["trans"] + (e[:, i + 1] + beta[i + 1])[:, None, :], 2)
        log_z = _lse(alpha[-1], 1)
        rows = np.arange(b)
        gold = e[rows[:, None], np.arange(t), tags].sum(1) + p["trans"][tags[:, :-1], tags[:, 1:]].sum(1)
        de = np.exp(alpha + beta - log_z[None, :, None]).transpose(1, 0, 2)
        de[rows[:, None], np.arange(t), tags] -= 1
        for i in range(1, t):
            pair = np.exp(alpha[i - 1][:, :, None] + p["trans"] + (e[:, i] + beta[i])[:, None, :] - log_z[:, None, None])
            grads["trans"] += pair.sum(0)
        np.add.at(grads["trans"], (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1)
        grads["out"] += both.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, TAGS)
        grads["ob"] += de.sum((0, 1))
        dboth = de @ p["out"].T
        dx = self._back(read, keep, np.stack([dboth[..., :HIDDEN], dboth[:, ::-1, HIDDEN:]]), grads)
        np.add.at(grads["emb"], codes.ravel(), dx.reshape(-1, EMBED))
        return float((log_z - gold).mean()), {k: g / b for k, g in grads.items()}

    def fit(self, codes: np.ndarray, tags: np.ndarray, steps: int = STEPS, seed: int = SEED) -> "Tagger":
        """``steps`` batches with Adam, the rate falling to zero."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for n in range(1, steps + 1):
            pick = r.integers(0, len(codes), BATCH)
            _, grads = self.step(codes[pick], tags[pick])
            rate = RATE * (1 - (n - 1) / steps)
            for k, g in grads.items():
                g = np.clip(g, -5, 5)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.p[k] -= rate * (m[k] / (1 - 0.9 ** n)) / (np.sqrt(v[k] / (1 - 0.99 ** n)) + 1e-8)
        return self

    def decode(self, e: np.ndarray) -> np.ndarray:
        """Viterbi tags of one stretch of emission scores (time, tag)."""
        score, back = e[0], []
        for row in e[1:]:
            every = score[:, None] + self.p["trans"]
            back.append(every.argmax(0))
            score = every.max(0) + row
        tags = [int(score.argmax())]
        for row in reversed(back):
            tags.append(int(row[tags[-1]]))
        return np.array(tags[::-1])


def _lse(x, axis):
    top = x.max(axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)


# ------------------------------------------------------------------ windows

def _candidate(text: str, start: int, end: int, done: int) -> tuple[int, int]:
    """The whole run around a trigger that an item can take: the name
    characters before it, across one opening bracket with white space, and
    after it the same with any "dot" parts. Nothing before ``done`` is read."""
    lo = start
    while lo > done and (text[lo - 1].isspace() or text[lo - 1] in "[({") and start - lo < 3:
        lo -= 1
    while lo > done and text[lo - 1] in _LOCAL:
        lo -= 1
    hi = end
    while hi < len(text) and (text[hi].isspace() or text[hi] in "])}") and hi - end < 3:
        hi += 1
    return lo, _TAIL.match(text, hi).end()


def stretches(text: str) -> list[tuple[int, int]]:
    """Joined character ranges around the triggers: the whole run that an item
    can take, and ``CONTEXT`` characters around the trigger and the run."""
    out: list[list[int]] = []
    read = 0  # a run is read once, however many triggers it holds
    for m in _TRIGGER.finditer(text):
        if m.start() < read and text[m.start()] not in "aA":
            a, b = m.start(), m.end()
        else:
            a, b = _candidate(text, m.start(), m.end(), out[-1][1] if out else 0)
            read = b
        lo, hi = max(0, a - CONTEXT), min(len(text), b + CONTEXT)
        if out and lo <= out[-1][1]:
            out[-1][1] = max(hi, out[-1][1])
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


def _starts(length: int) -> list[int]:
    """Overlapping windows over a stretch; the last one ends with it."""
    return [0] if length <= WINDOW else [*range(0, length - WINDOW, STRIDE), length - WINDOW]


def averaged_scores(model: Tagger, parts: list[np.ndarray], batch: int = 512) -> list[np.ndarray]:
    """Emission scores of each stretch, averaged over its windows."""
    where = [(k, s) for k, codes in enumerate(parts) for s in _starts(len(codes))]
    total = [np.zeros((len(c), TAGS)) for c in parts]
    seen = [np.zeros((len(c), 1)) for c in parts]
    for at in range(0, len(where), batch):
        some = where[at:at + batch]
        codes = np.zeros((len(some), WINDOW), np.int64)
        for i, (k, s) in enumerate(some):
            piece = parts[k][s:s + WINDOW]
            codes[i, :len(piece)] = piece
        e = model.scores(codes)
        for i, (k, s) in enumerate(some):
            n = min(WINDOW, len(parts[k]) - s)
            total[k][s:s + n] += e[i, :n]
            seen[k][s:s + n] += 1
    return [t / s for t, s in zip(total, seen)]


def _formed(kind: str, text: str) -> bool:
    digits = re.sub("[^0-9]", "", text)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 8 <= len(digits) <= 15 and re.fullmatch(r"[+(]?[0-9][\x20()./0-9-]*[0-9]", text) is not None \
            and re.search(r"[\x20()./-]", text) is not None and not re.fullmatch(r"\d+\.\d+\.\d+\.\d+", text)
    if kind == "ip":
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts) \
            and re.fullmatch(r"[0-9]+(?:[\[(]?\.[\])]?[0-9]+){3}", text) is not None
    return re.fullmatch(r"[A-Za-z0-9._%+-]+\s?[\[({]?\s?(?:@|at|AT)\s?[\])}]?\s?[A-Za-z0-9-]+(?:\s?[\[({]?\s?(?:\.|dot|DOT)\s?[\])}]?\s?"
                        r"[A-Za-z0-9-]+)+", text) is not None and re.search(r"@|[\[({]\s?(?:at|AT)\s?[\])}]", text) is not None


def model_spans(model: Tagger, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """The model's spans (kind, start, end) of each text, before any check."""
    where = [(i, lo, hi) for i, t in enumerate(texts) for lo, hi in stretches(t)]
    scores = averaged_scores(model, [encode(texts[i][lo:hi]) for i, lo, hi in where])
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for (i, lo, _), e in zip(where, scores):
        tags = model.decode(e)
        at = 0
        while at < len(tags):
            if tags[at] % 2 == 1:  # a begin tag
                kind, end = (tags[at] - 1) // 2, at + 1
                while end < len(tags) and tags[end] == 2 * kind + 2:
                    end += 1
                own = e[np.arange(at, end), tags[at:end]] - e[at:end, 0]
                if own.mean() >= MARGIN:
                    out[i].append((KINDS[kind], lo + at, lo + end))
                at = end
            else:
                at += 1
    return out


def added_spans(model: Tagger, texts: list[str], bases: list[list[tuple[str, int, int]]]) -> list[list[tuple[str, int, int]]]:
    """The model's spans that have their kind's form and touch no base span."""
    out = []
    for text, base, found in zip(texts, bases, model_spans(model, texts)):
        out.append([(k, s, e) for k, s, e in found if _formed(k, text[s:e])
                    and not any(bs < e and s < be for _, bs, be in base)])
    return out


# ----------------------------------------------------------------- training

def _variants(kind: str, text: str, r: np.random.Generator) -> str:
    """The same item written in another way."""
    if kind == "email":
        return text.replace("@", [" (at) ", "[at]", " [at] ", "{at}"][r.integers(4)]).replace(".", [".", " dot ", "[.]"][r.integers(3)])
    if kind == "phone":
        digits = re.sub("[^0-9]", "", text)[-10:].rjust(10, "5")
        return [f"({digits[:3]}) {digits[3:6]}-{digits[6:]}", f"{digits[:3]}-{digits[3:6]}-{digits[6:]}",
                f"({digits[:3]}) {digits[3:6]} {digits[6:]}", f"{digits[:3]}.{digits[3:6]}.{digits[6:]}"][r.integers(4)]
    if kind == "card":
        digits = re.sub("[^0-9]", "", text)
        return [" ", "-", ""][r.integers(3)].join(digits[i:i + 4] for i in range(0, len(digits), 4))
    return text.replace(".", ["[.]", "(.)"][r.integers(2)])


def training_windows(texts: list[str], seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(codes, tags) windows around the base spans of ``texts`` and of variants
    of them, and around triggers without a span."""
    r = np.random.default_rng(seed)
    codes, tags = [], []

    def window(text: str, spans: list[tuple[str, int, int]], centre: int) -> None:
        lo = max(0, min(centre - int(r.integers(8, WINDOW - 8)), len(text) - WINDOW))
        piece = text[lo:lo + WINDOW]
        c, y = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, np.int64)
        c[:len(piece)] = encode(piece)
        for kind, s, e in spans:
            k = 2 * KINDS.index(kind)
            a, b = max(s, lo) - lo, min(e, lo + WINDOW) - lo
            if a < b:
                y[a:b] = k + 2
                if s >= lo:
                    y[a] = k + 1
        codes.append(c)
        tags.append(y)

    for text in texts:
        spans = base_spans(text)
        taken, clear = [], -1
        for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):  # one label for each character
            if s >= clear:
                taken.append((kind, s, e))
                clear = e
        for kind, s, e in taken:
            window(text, taken, (s + e) // 2)
            other = _variants(kind, text[s:e], r)
            lo, hi = max(0, s - WINDOW), min(len(text), e + WINDOW)
            around = text[lo:s] + other + text[e:hi]
            window(around, [(kind, s - lo, s - lo + len(other))], s - lo + len(other) // 2)
        lone = [m.start() for m in _TRIGGER.finditer(text) if not any(s - 4 <= m.start() < e + 4 for _, s, e in taken)]
        for at in lone[:4]:
            window(text, taken, at)
    if not codes:
        return np.zeros((0, WINDOW), np.int64), np.zeros((0, WINDOW), np.int64)
    return np.stack(codes), np.stack(tags)


def _span_texts(rows: DataFrame, each: int, seed: int) -> list[tuple[str, int, str]]:
    """(kind, hash, text): for each kind the surroundings of the spans in the
    ``each`` documents of least hash that hold one."""
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for h, text in zip(batch.column("h").to_pylist(), (t.as_py() for t in batch.column("text"))):
                spans = base_spans(text)
                for kind in {k for k, _, _ in spans}:
                    own = [(s, e) for k, s, e in spans if k == kind and e - s <= 4 * WINDOW][:20]
                    if own:
                        out.append((kind, h, " ".join(text[max(0, s - 80):e + 80] for s, e in own)))
            kinds, hs, texts = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(hs, pa.int64()),
                                              pa.array(texts, pa.string())], ["kind", "h", "text"])

    held = rows.where(F.col("text").rlike(_MAY_HOLD)).select("text", F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"))
    found = held.mapInArrow(per_batch, "kind string, h long, text string")
    found = staged(found, "pii-samples")
    return [tuple(r) for kind in KINDS for r in
            found.where(F.col("kind") == kind).orderBy("h", "text").limit(each).collect()]  # a documented bound


def training_texts(docs: DataFrame, limit: int = TRAIN_DOCS, seed: int = SEED) -> list[str]:
    """A bounded, seeded sample of texts: half of them hold base spans, as many
    of each kind, and half any digit or ``@``; of a long text only the
    surroundings of its spans or triggers are needed to train. Rows are drawn
    by their hash first, fifty for each one wanted; kinds too rare for that
    draw are looked for in all documents."""
    each = limit // (2 * len(KINDS))
    share = min(1.0, 50 * limit / max(1, docs.count()))
    drawn = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "text"), F.lit(1_000_000)) < int(share * 1_000_000) + 1
    every = only(docs, "doc_id", "text")
    rows = every.where(drawn)
    held = _span_texts(rows, each, seed)
    if share < 1 and any(sum(k == kind for k, _, _ in held) < each for kind in KINDS):
        held = _span_texts(every, each, seed)
    around = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"(?s).{0,80}[0-9@+].{0,80}"), F.lit(0)), 1, 20), " ")
    picked = rows.where(F.col("text").rlike("[0-9@]")).select(
        around.alias("text"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"))
    some = picked.orderBy("h", "text").limit(limit - len(held)).collect()  # limit is a documented bound
    return [*(t for _, _, t in held), *(r.text for r in some)]


def train(docs: DataFrame, limit: int = TRAIN_DOCS, seed: int = SEED) -> Tagger | None:
    """The model fitted to a bounded sample, None where nothing is labelled."""
    codes, tags = training_windows(training_texts(docs, limit, seed), seed)
    if not len(codes) or not tags.any():
        return None
    return Tagger(seed).fit(codes, tags, seed=seed)


# ----------------------------------------------------------------- operator

def find_pii(docs: DataFrame, model: Tagger | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every
    row of ``docs``; positions in code points.

    Edge cases: a null or empty text has no span. If no document holds a base
    span, nothing is labelled and the base spans stand alone. Null doc_ids and
    repeated rows keep their rows; an empty table gives no rows; extra columns
    are ignored. Spans of different kinds may overlap; within a kind they never do.
    """
    model = model or train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(None if model is None else model.p)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = None
        if shared.value is not None:
            tagger = Tagger()
            tagger.p = shared.value
        order = {k: i for i, k in enumerate(KINDS)}
        names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]
        for batch in batches:
            ids, column = batch.column("doc_id"), batch.column("text")
            for at in range(0, batch.num_rows, 500):
                texts = [t.as_py() or "" for t in column.slice(at, 500)]
                bases = [base_spans(t) for t in texts]
                more = added_spans(tagger, texts, bases) if tagger else [[] for _ in texts]
                counts = [[sum(s[0] == k for s in b) for b in bases] for k in KINDS]
                line = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
                shas = [hashlib.sha256(line(b).encode()).hexdigest() for b in bases]
                lines = [line(sorted({*b, *m}, key=lambda x: (order[x[0]], x[1]))) for b, m in zip(bases, more)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, 500), *[pa.array(c, pa.int64()) for c in counts], pa.array(shas), pa.array(lines)], names)

    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(per_batch, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS)
                           + ", base_sha256 string, spans string")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))
