"""Toxicity by a linear-chain conditional random field over words.

Tokens of a bounded sample of labelled documents get weak tags: a word is marked toxic in a toxic
document if it (or its stem) stands in toxic documents far more often than in clean ones. The field
has two tags, emission weights for hashed features of a token (the word, prefixes, suffix) and transition
weights; it is trained by gradient steps on the log-likelihood, by forward-backward, in numpy. The
marginals of a text's tokens give the offending offsets and, through a logistic layer fitted on the
same sample, the document's score.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import held
from .common import crc_fold, release, releasing

WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 16
KINDS = 5
STEMS = (4, 5, 6)
#: A word or stem marks toxic texts if it is so many times (as a logarithm) likelier there.
RATIO = 3.0


def features(word: str) -> tuple[int, ...]:
    """Feature buckets of a word, lower-cased: itself, three prefixes and its suffix."""
    word = word.lower()
    parts = [f"w{word}", *(f"{n}{word[:n]}" for n in STEMS), f"s{word[-3:]}"]
    return tuple(zlib.crc32(p.encode("utf-8", "surrogatepass")) & (BUCKETS - 1) for p in parts)


@dataclass
class Field:
    emission: np.ndarray  # BUCKETS: weight of tag 1 over tag 0
    bias: float
    transition: np.ndarray  # 2 x 2
    layer: np.ndarray  # bias and weights of the document layer

    def __post_init__(self):
        self.key = uuid.uuid4().hex

    def evidence(self, words: list[str]) -> np.ndarray:
        """Emission weight of each word, by a table of the words seen so far, which the worker
        process drops for the next step's."""
        cache: dict[str, float] = held(("toxicity", self.key), dict)
        if len(cache) > 200_000:
            cache.clear()
        new = [w for w in set(words) if w not in cache]
        if new:
            rows = np.array([features(w) for w in new], np.int64)
            cache.update(zip(new, (self.emission[rows].sum(axis=1)).tolist(), strict=True))
        return np.fromiter(map(cache.__getitem__, words), np.float64, len(words))


def messages(potentials: np.ndarray, lengths: np.ndarray, transition: np.ndarray):
    """Forward-backward over many chains laid end to end, in ratios: with two tags, each message is
    one number (tag 1 over tag 0). Chains run side by side, longest first. Returns the emission
    ratios, the forward ratios (emission included) and the backward ratios of all tokens."""
    e = np.exp(np.clip(potentials, -30, 30))
    forward, backward = np.ones(len(e)), np.ones(len(e))
    if not len(e):
        return e, forward, backward
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order]
    start = (np.cumsum(lengths) - lengths)[order]
    t = np.exp(transition)
    steps = int(size[0])
    active = np.searchsorted(-size, -np.arange(steps), side="left")  # chains longer than each step
    for k in range(steps):
        at = start[: active[k]] + k
        r = forward[at - 1] if k else None
        forward[at] = e[at] * ((t[0, 1] + r * t[1, 1]) / (t[0, 0] + r * t[1, 0]) if k else 1.0)
    for k in range(steps - 2, -1, -1):
        at = start[: active[k + 1]] + k + 1
        r = e[at] * backward[at]
        backward[at - 1] = (t[1, 0] + r * t[1, 1]) / (t[0, 0] + r * t[0, 1])
    return e, forward, backward


def marginals(potentials: np.ndarray, lengths: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """P(tag 1) of each token."""
    _, forward, backward = messages(potentials, lengths, transition)
    odds = forward * backward
    return odds / (1 + odds)


def _train_step(potentials, lengths, transition, left):
    """Marginals, and the expected number of each pair of neighbouring tags."""
    e, forward, backward = messages(potentials, lengths, transition)
    odds = forward * backward
    ones = np.ones(len(left))
    a = np.stack([ones, forward[left]])
    b = np.stack([ones, e[left + 1] * backward[left + 1]])
    joint = a[:, None, :] * b[None, :, :] * np.exp(transition)[:, :, None]
    return odds / (1 + odds), (joint / joint.sum(axis=(0, 1))).sum(axis=2)


def _keys(words: list[str]) -> np.ndarray:
    """For each word a number for itself and for each of its stems, 0 where it has none."""

    def number(key: str) -> int:
        raw = key.encode("utf-8", "surrogatepass")
        return zlib.crc32(raw) << 32 | zlib.crc32(b"2" + raw) | 1

    parts = (number(f"w{w}") if n == 0 else number(f"{n}{w[:n]}") if len(w) > n else 0 for w in words for n in (0, *STEMS))
    return np.fromiter(parts, np.uint64, len(words) * (1 + len(STEMS))).reshape(len(words), -1)


def _tags(docs: list[np.ndarray], toxic: np.ndarray, words: list[str]) -> np.ndarray:
    """Weak tags of all tokens: those of toxic documents whose word or stem marks toxic ones."""
    names, where = np.unique(_keys(words), return_inverse=True)
    where = where.reshape(len(words), -1).astype(np.int32)
    times = np.zeros((2, len(names)))
    for ids, y in zip(docs, toxic, strict=True):
        times[int(y), np.unique(where[np.unique(ids)])] += 1
    n1, n0 = toxic.sum() + 1.0, (1 - toxic).sum() + 1.0
    strong = (times[1] >= max(4, 0.01 * n1)) & (np.log((times[1] + 0.5) / n1) - np.log((times[0] + 0.5) / n0) > RATIO) & (names > 0)
    marks = strong[where].any(axis=1)
    return np.concatenate([marks[ids] & bool(y) for ids, y in zip(docs, toxic, strict=True)])


def _document_features(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each chain: log of the expected number of toxic tokens, the largest marginal, and the
    log of their rate."""
    ends = np.cumsum(lengths)
    sums = np.concatenate([[0], np.cumsum(p)])
    total = np.maximum(0, sums[ends] - sums[ends - lengths])
    top = np.zeros(len(lengths))
    full = lengths > 0
    if full.any():
        top[full] = np.maximum.reduceat(p, (ends - lengths)[full])
    strong = np.concatenate([[0], np.cumsum(p > 0.5)])
    count = strong[ends] - strong[ends - lengths]
    return np.stack([np.ones(len(lengths)), np.log1p(total), top, (count >= 2).astype(float), 10 * np.minimum(0.1, total / np.maximum(lengths, 1))], axis=1)


def _unlike(docs: list[np.ndarray], toxic: list[int], least: int = 24) -> list[int]:
    """Documents that share less than a third of a sketch (the four-word shingles of least hash)
    with each one before of their label: copies of one toxic text would make its every word a
    mark."""
    seen: dict[tuple[int, int], list[int]] = {}
    kept = []
    for n, (ids, y) in enumerate(zip(docs, toxic, strict=True)):
        k = min(4, max(1, len(ids)))
        hashed = np.zeros(max(0, len(ids) - k + 1), np.uint64)
        for i in range(k):
            hashed = (hashed + ids[i : len(ids) - k + 1 + i].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        sketch = np.unique(hashed ^ (hashed >> np.uint64(29)))[:least].tolist()
        met = Counter(m for h in sketch for m in seen.get((y, h), ()))
        if not met or max(met.values()) < max(2, len(sketch) / 3):
            kept.append(n)
            for h in sketch:
                seen.setdefault((y, h), []).append(n)
    return kept


#: Tokens that a training step looks at together, so that its memory doesn't grow with the sample.
STEP = 300_000


def train(texts: list[str], toxic: list[int], rounds: int = 20) -> Field:
    """Fits the field and the document layer. The gradient of a round is summed over blocks of
    whole documents."""
    vocabulary: dict[str, int] = {}
    docs = []  # as word numbers: the words themselves would fill the driver
    for t in texts:
        docs.append(np.array([vocabulary.setdefault(w.lower(), len(vocabulary)) for w in WORD.findall(t or "")], np.int32))
    # longest first: chains of one block run side by side, as many steps as its longest has
    kept = sorted(_unlike(docs, toxic), key=lambda n: -len(docs[n]))
    docs, y = [docs[n] for n in kept], np.array(toxic, float)[kept]
    table = np.array([features(w) for w in vocabulary] or np.zeros((0, KINDS)), np.int32).reshape(-1, KINDS)
    lengths = np.array([len(d) for d in docs], np.int64)
    tokens = np.concatenate(docs) if docs else np.empty(0, np.int32)
    gold = _tags(docs, y, list(vocabulary)) if docs else np.empty(0, bool)
    del docs, vocabulary
    ends = np.cumsum(lengths)
    cuts = np.unique([0, *np.searchsorted(ends, np.arange(STEP, len(tokens), STEP)), len(lengths)])
    blocks = []  # (first and end token, lengths, tokens with a neighbour to the right)
    for first, last in zip(cuts, cuts[1:], strict=False):
        own = lengths[first:last]
        begin, end = int(ends[first] - lengths[first]), int(ends[last - 1])
        left = np.ones(end - begin, bool)
        left[(np.cumsum(own) - 1)[own > 0]] = False
        blocks.append((begin, end, own, np.flatnonzero(left)))
    field = Field(np.zeros(BUCKETS), -4.0, np.array([[0.0, -0.5], [0.0, 0.5]]), np.array([-3.0, 2.0, 2.0, 1.0, 0.0]))
    if len(tokens):
        heavy = min(50.0, max(1.0, (~gold).sum() / max(1.0, gold.sum()) / 20))
        squares = np.full(BUCKETS, 1e-8)
        bias_square, trans_square = 1e-8, np.full((2, 2), 1e-8)
        seen = np.zeros((2, 2))
        for begin, end, _, i in blocks:
            own = gold[begin:end].astype(int)
            seen += np.bincount(2 * own[i] + own[i + 1], minlength=4).reshape(2, 2)
        scale = 1.0 / max(1.0, gold.sum())
        for _ in range(rounds):
            weight = field.emission[table].sum(axis=1) + field.bias
            word, total, joint = np.zeros(len(table)), 0.0, np.zeros((2, 2))
            for begin, end, own, i in blocks:
                p, pairs = _train_step(weight[tokens[begin:end]], own, field.transition, i)
                miss = (gold[begin:end] - p) * np.where(gold[begin:end], heavy, 1.0) * scale
                word += np.bincount(tokens[begin:end], miss, len(table))
                total, joint = total + miss.sum(), joint + pairs
            grad = np.zeros(BUCKETS)
            for k in range(KINDS):
                grad += np.bincount(table[:, k], word, BUCKETS)
            grad -= 1e-4 * field.emission
            squares += grad**2
            field.emission += 0.8 * grad / np.sqrt(squares)
            bias_square += total**2
            field.bias += 0.3 * total / np.sqrt(bias_square)
            step = (seen - joint) * scale
            trans_square += step**2
            field.transition += np.clip(0.05 * step / np.sqrt(trans_square), -0.05, 0.05)
            field.transition[0, 0] = 0.0
    weight = field.emission[table].sum(axis=1) + field.bias
    x = [_document_features(marginals(weight[tokens[begin:end]], own, field.transition), own) for begin, end, own, _ in blocks]
    x = np.concatenate(x) if x else np.zeros((0, len(field.layer)))
    w = field.layer
    if len(y):
        for _ in range(300):  # Newton steps with a small ridge
            q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            hess = (x * (q * (1 - q))[:, None]).T @ x + 0.5 * np.eye(len(w))
            move = np.linalg.solve(hess, x.T @ (y - q) - 0.5 * w)
            w = w + np.clip(move, -1, 1)
            if np.abs(move).max() < 1e-6:
                break
    field.layer = w
    return field


def score_texts(field: Field, texts: list[str | None], spans: bool = False):
    """Scores of texts in [0, 1]; with ``spans`` also each text's offending (start, end) offsets,
    those of words more likely toxic than not, in code points of the text as it is."""
    docs = [WORD.findall(t or "") for t in texts]
    lengths = np.array([len(d) for d in docs], np.int64)
    u = (np.concatenate([field.evidence(d) for d in docs]) if len(docs) else np.empty(0)) + field.bias
    p = marginals(u, lengths, field.transition)
    x = _document_features(p, lengths)
    scores = 1 / (1 + np.exp(-np.clip(x @ field.layer, -30, 30)))
    if not spans:
        return scores
    marks: list[list[tuple[int, int]]] = [[] for _ in texts]
    hits = np.flatnonzero(p > 0.5)
    owner = np.searchsorted(np.cumsum(lengths), hits, side="right")
    for i in np.unique(owner).tolist():
        inside = set((hits[owner == i] - int(lengths[:i].sum())).tolist())
        marks[i] = [m.span() for n, m in enumerate(WORD.finditer(texts[i])) if n in inside]
    return scores, marks


def fit(docs: DataFrame, labels: DataFrame, most: int = 1200, held_out: int | None = 1, folds: int = 3, most_bytes: int = 1 << 17) -> Field:
    """Learns from at most ``most`` toxic and ``most`` other labelled documents, those of least
    hash, outside fold ``held_out``. Documents with a null label or text, or a text of more than
    ``most_bytes``, aren't learned from; of several labels of one document the largest counts, of
    several texts the first in order."""
    known = labels.where("doc_id is not null and toxic in (0, 1)")
    if held_out is not None:
        known = known.where(crc_fold(F.col("doc_id"), folds) != held_out)
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    ranked = known.withColumn("h", F.xxhash64("doc_id"))
    chosen = None
    for y in (0, 1):
        part = ranked.where(F.col("toxic") == y).orderBy("h").limit(most).select("doc_id", "toxic")
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull() & (F.octet_length("text") <= most_bytes))
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")).collect()
    rows = sorted((r.doc_id, r.toxic, r.text) for r in rows)
    return train([r[2] for r in rows], [int(r[1]) for r in rows])


def _in_parts(field: Field, column, spans: bool = False) -> Iterator:
    """Scores, with ``spans`` also offsets, of some thousand texts or megabytes at a time."""
    size = column.nbytes / max(1, len(column))
    step = max(1, min(2000, int(4e6 / max(1.0, size))))
    return (score_texts(field, column.slice(i, step).to_pylist(), spans) for i in range(0, len(column), step))


def score_documents(docs: DataFrame, field: Field, held_out: int = 1, folds: int = 3) -> DataFrame:
    """(doc_id, held_out, score, spans) for every row of ``docs`` (doc_id, text); spans are the
    offending offsets as start:end, end exclusive, comma-joined. Null and empty texts get the score
    of a text without words; repeated rows come back each; a null doc_id is in the fold of the
    empty text; other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, told = [np.empty(0)], []
            for part, marks in _in_parts(shared.value, batch.column(1), True):
                scores.append(part)
                told += [",".join(f"{s}:{e}" for s, e in own) for own in marks]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(np.concatenate(scores), pa.float64()), pa.array(told, pa.string())], ["doc_id", "held_out", "score", "spans"])

    every = docs.select(F.col("doc_id").cast("long"), "text", (crc_fold(F.col("doc_id"), folds) == held_out).alias("held_out"))
    return every.mapInArrow(releasing(scan), "doc_id long, held_out boolean, score double, spans string")


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted, spans) for every document."""
    out = score_documents(docs, fit(docs, labels))
    return out.select("doc_id", "held_out", "score", F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"), "spans")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``docs`` without those that score ``threshold`` or more; columns and other rows stay. Only
    texts go to Python and only scores come back."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    @F.arrow_udf("double")
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array(np.concatenate([np.empty(0), *_in_parts(shared.value, column)]), pa.float64())
        release()

    return docs.where(score("text") < threshold)
