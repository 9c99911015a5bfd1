"""Personal data by fixed patterns and a character-level bidirectional LSTM with a CRF on top.

The patterns give the base spans. The network is trained in numpy, on windows of a bounded sample of
texts, from spans labelled by the patterns' formats (a card number counts whether or not its check
digit is right, a phone number also without its country code), so it adds look-alikes that the
strict patterns drop. A span of any kind holds a digit or an @, so windows without either can hold
none and aren't run through the network. All other windows of a text, which overlap, are; where
they overlap their emission scores are averaged by how central a character is, and runs of
overlapping windows are decoded as one chain.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import releasing

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
BARE_PHONE = re.compile(r"(?<![0-9+])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])")
MARK = re.compile(r"[0-9@]")

WINDOW, STRIDE = 96, 64
TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind
SYMBOLS = " abcdefghijklmnopqrstuvwxyz0@.-_+()%,:;/\"'\n|"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses. Only the run of local characters before an @ can begin
    one, so the text is searched for @ and its domain."""
    found, end = [], 0
    if "@" not in text:
        return found
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > end and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        if start < m.start():
            found.append((start, m.end()))
            end = m.end()
    return found


def formats(text: str) -> tuple[list, list, list, list]:
    """Matches of each kind before the checks that drop some of them."""
    mails = emails(text)
    some = MARK.search(text) is not None
    ips = [m.span() for m in IP.finditer(text)] if some else []
    cards = [m.span() for m in CARD.finditer(text)] if some else []
    phones = [m.span() for m in PHONE.finditer(text)] if "+" in text else []
    return mails, ips, cards, phones


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base spans, by start, then kind."""
    mails, ips, cards, phones = formats(text)
    found = [(s, e, 0) for s, e in mails]
    found += [(s, e, 1) for s, e in ips if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in text[s:e].split("."))]
    for s, e in cards:
        digits = text[s:e].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((s, e, 2))
    for s, e in phones:
        if 9 <= sum(c.isdigit() for c in text[s:e]) <= 15:
            found.append((s, e, 3))
    return sorted(found, key=lambda x: (x[0], x[2]))


def labelled_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans to learn from: the formats, check digits aside, one kind for each character."""
    mails, ips, cards, phones = formats(text)
    taken = [(s, e, 0) for s, e in mails] + [(s, e, 3) for s, e in phones if 9 <= sum(c.isdigit() for c in text[s:e]) <= 15]
    taken += [(m.start(), m.end(), 3) for m in BARE_PHONE.finditer(text)]
    taken += [(s, e, 1) for s, e in ips if all(len(p) <= 3 and int(p) <= 255 for p in text[s:e].split("."))]
    taken += [(s, e, 2) for s, e in cards if 12 <= sum(c.isdigit() for c in text[s:e]) <= 19]
    out, end = [], 0
    for s, e, k in sorted(taken):
        if s >= end:
            out.append((s, e, k))
            end = e
    return out


# ---------------------------------------------------------------- the network

_CODE = np.full(128, len(SYMBOLS) + 1, np.int64)
for _i, _c in enumerate(SYMBOLS):
    _CODE[ord(_c)] = _i + 1
for _i in range(26):
    _CODE[65 + _i] = _CODE[97 + _i]
for _i in range(10):
    _CODE[48 + _i] = _CODE[48]
ALPHABET = len(SYMBOLS) + 3  # padding, the symbols, other ASCII, beyond ASCII


def encoded(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _CODE[np.minimum(points, 127)], ALPHABET - 1)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    """Embedding, one LSTM in each direction, a linear layer, and CRF transitions."""

    def __init__(self, size: int = 20, width: int = 12, seed: int = 0):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.size = size
        self.p = {"embed": draw(ALPHABET, width), "out": draw(2 * size, TAGS), "bias": np.zeros(TAGS, np.float32), "move": np.zeros((TAGS, TAGS), np.float32)}
        for d in "fb":
            self.p[f"w{d}"] = draw(width + size, 4 * size)
            self.p[f"b{d}"] = np.zeros(4 * size, np.float32)
            self.p[f"b{d}"][size : 2 * size] = 1.0

    def _run(self, x: np.ndarray, d: str, keep: bool):
        """Hidden states [T, B, H] of embedded windows [T, B, D] in one direction."""
        h = self.size
        steps, batch, width = x.shape
        w, b = self.p[f"w{d}"], self.p[f"b{d}"]
        pre = x @ w[:width] + b
        hidden, cell = np.zeros((batch, h), np.float32), np.zeros((batch, h), np.float32)
        out = np.empty((steps, batch, h), np.float32)
        trace = []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = pre[t] + hidden @ w[width:]
            g = _sigmoid(z[:, : 3 * h])
            i, f, o, c = g[:, :h], g[:, h : 2 * h], g[:, 2 * h :], np.tanh(z[:, 3 * h :])
            before, last = cell, hidden
            cell = f * cell + i * c
            tc = np.tanh(cell)
            hidden = o * tc
            out[t] = hidden
            if keep:
                trace.append((t, i, f, o, c, before, tc, last))
        return out, trace

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        """[T, B, TAGS] for windows [B, T]."""
        x = self.p["embed"][codes.T]
        return np.concatenate([self._run(x, "f", False)[0], self._run(x, "b", False)[0]], axis=2) @ self.p["out"] + self.p["bias"]

    def gradients(self, codes: np.ndarray, tags: np.ndarray):
        """Negative log-likelihood of windows and its gradients, by forward-backward and by
        back-propagation through time."""
        p, h = self.p, self.size
        x = p["embed"][codes.T]
        steps, batch, width = x.shape
        f_out, f_trace = self._run(x, "f", True)
        b_out, b_trace = self._run(x, "b", True)
        both = np.concatenate([f_out, b_out], axis=2)
        e = both @ p["out"] + p["bias"]
        tags = tags.T
        loss, de, dmove = crf_gradients(e, p["move"], tags)
        scale = 1.0 / batch
        de, dmove = de * scale, dmove * scale
        grads = {"out": np.einsum("tbh,tbk->hk", both, de), "bias": de.sum(axis=(0, 1)), "move": dmove}
        dboth = de @ p["out"].T
        dx = np.zeros_like(x)
        for d, trace, dh_all in (("f", f_trace, dboth[:, :, :h]), ("b", b_trace, dboth[:, :, h:])):
            w = p[f"w{d}"]
            dw, db = np.zeros_like(w), np.zeros_like(p[f"b{d}"])
            dh, dc = np.zeros((batch, h), np.float32), np.zeros((batch, h), np.float32)
            for t, i, f, o, c, before, tc, last in reversed(trace):
                dh = dh + dh_all[t]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * c * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - c * c)], axis=1)
                dw[:width] += x[t].T @ dz
                dw[width:] += last.T @ dz
                db += dz.sum(axis=0)
                dx[t] += dz @ w[:width].T
                dh, dc = dz @ w[width:].T, dc * f
            grads[f"w{d}"], grads[f"b{d}"] = dw, db
        grads["embed"] = np.zeros_like(p["embed"])
        np.add.at(grads["embed"], codes.T.ravel(), dx.reshape(-1, width))
        return loss * scale, grads


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def crf_gradients(e: np.ndarray, move: np.ndarray, tags: np.ndarray):
    """Negative log-likelihood of tag chains [T, B] under emissions [T, B, K]; its gradients."""
    steps, batch, k = e.shape
    forward, backward = np.empty_like(e), np.zeros_like(e)
    forward[0] = e[0]
    for t in range(1, steps):
        forward[t] = _logsum(forward[t - 1][:, :, None] + move, 1) + e[t]
    for t in range(steps - 2, -1, -1):
        backward[t] = _logsum(move + (e[t + 1] + backward[t + 1])[:, None, :], 2)
    z = _logsum(forward[-1], 1)
    de = np.exp(forward + backward - z[None, :, None])
    dmove = np.zeros_like(move)
    for t in range(steps - 1):
        dmove += np.exp(forward[t][:, :, None] + move + (e[t + 1] + backward[t + 1])[:, None, :] - z[:, None, None]).sum(axis=0)
    rows = np.arange(batch)
    gold = np.zeros(batch)
    for t in range(steps):
        gold += e[t, rows, tags[t]]
        de[t, rows, tags[t]] -= 1
        if t:
            gold += move[tags[t - 1], tags[t]]
            np.add.at(dmove, (tags[t - 1], tags[t]), -1)
    return float((z - gold).sum()), de, dmove


def viterbi(e: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The best tag chain of emissions [T, K], inside tags following their own kind only."""
    legal = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        legal[:, 2 + 2 * k] = -1e4
        legal[1 + 2 * k, 2 + 2 * k] = legal[2 + 2 * k, 2 + 2 * k] = 0
    step = (move + legal).T  # [to, from]
    score = e[0].astype(np.float64).copy()
    score[2::2] -= 1e4
    back = np.zeros((len(e), TAGS), np.int64)
    for t in range(1, len(e)):
        through = step + score
        back[t] = through.argmax(axis=1)
        score = through[np.arange(TAGS), back[t]] + e[t]
    tags = np.empty(len(e), np.int64)
    tags[-1] = score.argmax()
    for t in range(len(e) - 1, 0, -1):
        tags[t - 1] = back[t, tags[t]]
    return tags


def window_starts(text: str, rng: np.random.Generator) -> np.ndarray:
    """Where windows to learn from begin: two about each digit or @ that the last two don't reach."""
    out, last = [], -WINDOW
    for m in MARK.finditer(text):
        if m.start() >= last + WINDOW // 2:
            last = m.start()
            out += [max(0, last - int(rng.integers(0, WINDOW))) for _ in range(2)]
    return np.array(out, np.int64)


def shares(counts: np.ndarray, most: int) -> np.ndarray:
    """How many of its windows each text gives, ``most`` in all: texts with few give all, the
    others the same number each, which is one at least."""
    level, left = int(counts.max(initial=0)), most
    ordered = np.sort(counts[counts > 0])
    for n, count in enumerate(ordered.tolist()):
        fair = left // (len(ordered) - n)
        if count > fair:
            level = max(1, fair)
            break
        left -= count
    return np.minimum(counts, level)


def learning_windows(texts: list[str], rng: np.random.Generator, most: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Codes and gold tags of at most ``most`` windows (or one a text) over all of ``texts``. A text
    that has more windows than its share gives a random choice of them."""
    starts = [window_starts(t, rng) for t in texts]
    give = shares(np.array([len(s) for s in starts], np.int64), most)
    choice = np.random.default_rng(len(texts))
    codes, tags = [], []
    for text, own, n in zip(texts, starts, give.tolist(), strict=True):
        if not n:
            continue
        full = encoded(text)
        gold = np.zeros(len(full), np.int64)
        for s, e, k in labelled_spans(text):
            gold[s] = 1 + 2 * k
            gold[s + 1 : e] = 2 + 2 * k
        for start in (own if n == len(own) else np.sort(choice.choice(own, n, replace=False))).tolist():
            body = full[start : start + WINDOW]
            pad = WINDOW - len(body)
            codes.append(np.pad(body, (0, pad)))
            tags.append(np.pad(gold[start : start + WINDOW], (0, pad)))
            # a window may cut a span: what is left begins without its first character
            if tags[-1][0] and tags[-1][0] % 2 == 0:
                tags[-1][0] -= 1
    return codes, tags


def train(texts: list[str], batches: int = 120, batch: int = 96, seed: int = 0, windows: int = 6000) -> Tagger | None:
    """Fits a tagger on at most ``windows`` windows (or one a text) around the digits and @ of
    ``texts``, of which every text gets its share; None without any."""
    rng = np.random.default_rng(seed)
    codes, tags = learning_windows(texts, rng, windows)
    if not codes:
        return None
    x, y = np.array(codes), np.array(tags)
    model = Tagger(seed=seed)
    one = {k: np.zeros_like(v) for k, v in model.p.items()}
    two = {k: np.zeros_like(v) for k, v in model.p.items()}
    for n in range(1, batches + 1):
        pick = rng.integers(0, len(x), batch)
        _, grads = model.gradients(x[pick], y[pick])
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
        rate = 0.02 * (1 - 0.9 * n / batches)
        for k, g in grads.items():
            g = g * min(1.0, 5.0 / max(norm, 1e-9))
            one[k] = 0.9 * one[k] + 0.1 * g
            two[k] = 0.99 * two[k] + 0.01 * g * g
            model.p[k] = (model.p[k] - rate * (one[k] / (1 - 0.9**n)) / (np.sqrt(two[k] / (1 - 0.99**n)) + 1e-7)).astype(np.float32)
    return model


CENTRAL = (1.0 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])).astype(np.float32)


def tagged_spans(model: Tagger, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """(start, end, kind) that the network tags, for each text. Windows of all texts run together;
    a text's runs of overlapping windows are decoded as one chain each."""
    where, codes = [], []
    whole = []
    for i, text in enumerate(texts):
        whole.append(None)
        if MARK.search(text) is None:
            continue
        full = whole[i] = encoded(text)
        starts = sorted({s for m in MARK.finditer(text) for s in range(max(0, -(-(m.start() - WINDOW + 1) // STRIDE)) * STRIDE, m.start() + 1, STRIDE)})
        for s in starts:
            body = full[s : s + WINDOW]
            where.append((i, s))
            codes.append(np.pad(body, (0, WINDOW - len(body))))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not codes:
        return found
    x = np.array(codes)
    scores = np.concatenate([model.emissions(x[b : b + 512]) for b in range(0, len(x), 512)], axis=1)
    begin = 0
    while begin < len(where):
        end = begin + 1
        while end < len(where) and where[end][0] == where[begin][0] and where[end][1] < where[end - 1][1] + WINDOW:
            end += 1
        i, first = where[begin]
        size = min(where[end - 1][1] + WINDOW, len(whole[i])) - first
        total, weight = np.zeros((size, TAGS), np.float32), np.zeros((size, 1), np.float32)
        for n in range(begin, end):
            at = where[n][1] - first
            m = min(WINDOW, size - at)
            total[at : at + m] += scores[:m, n] * CENTRAL[:m, None]
            weight[at : at + m, 0] += CENTRAL[:m]
        tags = viterbi(total / weight, model.p["move"])
        at = 0
        for b in np.flatnonzero(tags % 2 == 1).tolist():
            kind, e = (int(tags[b]) - 1) // 2, b + 1
            while e < size and tags[e] == 2 + 2 * kind:
                e += 1
            found[i].append((first + b, first + e, kind))
        begin = end
    return found


def plausible(text: str, kind: int) -> bool:
    """Whether a tagged span can be of its kind at all."""
    digits = sum(c in "0123456789" for c in text)
    if kind == 0:
        return re.fullmatch(r"\S+@\S+\.\S+", text) is not None
    if kind == 1:
        return re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", text) is not None and all(int(p) <= 255 for p in text.split("."))
    if kind == 2:
        return 13 <= digits <= 19 and re.fullmatch(r"[0-9 -]+", text) is not None
    return 9 <= digits <= 15 and re.fullmatch(r"[+(]?[0-9 ().-]+", text) is not None


def all_spans(model: Tagger | None, texts: list[str]) -> list[tuple[list, list]]:
    """For each text its base spans, and base and added spans, by start, then kind."""
    base = [base_spans(t) for t in texts]
    more = tagged_spans(model, texts) if model is not None else [[] for _ in texts]
    out = []
    for text, own, tagged in zip(texts, base, more, strict=True):
        tagged = [(s + len(text[s:e]) - len(text[s:e].lstrip()), e - len(text[s:e]) + len(text[s:e].rstrip()), k) for s, e, k in tagged]
        added = [(s, e, k) for s, e, k in tagged if plausible(text[s:e], k) and not any(s < y and x < e for x, y, _ in own)] if tagged else []
        out.append((own, sorted(own + added, key=lambda x: (x[0], x[2]))))
    return out


# ---------------------------------------------------------------- the dataflow


def sample_ids(docs: DataFrame, most: int) -> DataFrame:
    """At most ``most`` ids of texts that hold a digit or an @: of each of so many hash buckets the
    id of least second hash, so that any part of the ids is met."""
    marked = docs.where(F.col("text").rlike("[0-9@]") & F.col("doc_id").isNotNull())
    first = F.min(F.struct(F.xxhash64(F.lit(1), "doc_id").alias("h"), "doc_id"))
    return marked.groupBy(F.pmod(F.xxhash64("doc_id"), F.lit(most)).alias("bucket")).agg(first.alias("m")).select("m.doc_id")


def fit(docs: DataFrame, most: int = 600, windows: int = 6000, most_bytes: int = 1 << 20) -> Tagger | None:
    """Learns from at most ``most`` texts that hold a digit or an @ and have ``most_bytes`` at most,
    those of ``sample_ids``, and ``windows`` windows of them, or one a text. Ids alone are compared; the texts
    follow by a join, of several texts of one id the first in order."""
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.octet_length("text") <= most_bytes))
    rows = texts.join(F.broadcast(sample_ids(texts, most)), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).collect()
    return train([r.text for r in sorted(rows, key=lambda r: r.doc_id)], windows=windows)


def _parts(column) -> Iterator[tuple[int, list[str]]]:
    step = max(1, min(1000, int(4e6 / max(1.0, column.nbytes / max(1, len(column))))))
    for i in range(0, len(column), step):
        yield i, [t or "" for t in column.slice(i, step).to_pylist()]


def pii_report(docs: DataFrame, model: Tagger | None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of ``docs``
    (doc_id, text). A null text counts as empty; repeated rows come back each; further columns are
    ignored; without a model (no text to learn from) there are base spans only."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    told = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for _, texts in _parts(batch.column(1)):
                for own, every in all_spans(shared.value, texts):
                    out.append((*[sum(k == kind for _, _, k in own) for kind in range(len(KINDS))], hashlib.sha256(told(own).encode()).hexdigest(), told(every)))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.string()] * 2, strict=True)], ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(releasing(scan), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame, model: Tagger | None) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets, as <EMAIL>; spans that
    overlap are replaced together under the first one's kind. Rows and columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def clean(text: str, spans: list[tuple[int, int, int]]) -> str:
        parts, done = [], 0
        for s, e, k in spans:
            if s >= done:
                parts += [text[done:s], f"<{KINDS[k].upper()}>"]
            done = max(done, e)
        return "".join(parts) + text[done:]

    @F.arrow_udf("string")
    def redacted(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            texts = column.to_pylist()
            for i, some in _parts(column):
                for n, (text, (_, spans)) in enumerate(zip(some, all_spans(shared.value, some), strict=True)):
                    if spans:
                        texts[i + n] = clean(text, spans)
            yield pa.array(texts, pa.string())

    return docs.withColumn("text", redacted("text"))
