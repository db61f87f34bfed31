"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Tokens are runs of letters and digits; a sentence is a chain. Documents are labelled as wholes, so token labels are
derived first: a word, or a beginning of words, that occurs in toxic documents far more often than their share explains marks
a toxic token in a toxic document, all other tokens are clean. The field has a score per mark and one per pair of
neighbouring tags, fitted by maximum likelihood with forward-backward. A document's score is a logistic function of the
sum, the largest and the mean of its tokens' marginals; tokens likelier toxic than not are its offending spans.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm import wordarrays as wa

TRAIN_ROWS = 20_000  # labelled documents that models are fitted on, the smallest by a seeded hash
CHAINS = 20_000  # sentences that the field is fitted on
CLEAN_CHAINS, CLEAN_TOKENS = 3, 500  # sentences without marks that a labelled document gives, and their longest
PREFIXES = (8, 7, 6, 5, 4)  # bytes of beginnings, in the order of preference behind whole words
WORDS = 20_000  # marked words at most, the most telling ones
LEAST_DOCS, CHANCE = 4, 1e-5

_SOLID = np.zeros(256, bool)
_SOLID[0x30:0x3A] = _SOLID[0x41:0x5B] = _SOLID[0x61:0x7B] = _SOLID[0x80:] = True
_STOP = np.zeros(256, bool)
_STOP[[10, 13, 33, 46, 63]] = True  # line ends and the signs that close a sentence

Batches = Iterator[pa.RecordBatch]


@dataclass
class Tokens:
    starts: np.ndarray
    ends: np.ndarray
    keys: np.ndarray  # of whole words
    prefixes: list[np.ndarray]  # of their beginnings by PREFIXES; 0 where a word is shorter
    first: np.ndarray  # by text
    chain: np.ndarray  # number of the sentence of each token


def tokens_of(data: np.ndarray, offsets: np.ndarray, prefixes: tuple[int, ...] | None = None) -> Tokens:
    solid = _SOLID[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begins, finishes = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | cut[1:-1]
    finishes[:-1] &= ~solid[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    stops = np.r_[0, np.cumsum(_STOP[data])]
    new = np.ones(len(starts), bool)
    first = np.searchsorted(starts, offsets)
    if len(starts):
        new[1:] = stops[starts[1:]] > stops[ends[:-1]]
        new[first[:-1][first[:-1] < len(starts)]] = True
    whole = wa.span_hashes(data, starts, ends, fold=True)
    beginnings = []
    for n in PREFIXES if prefixes is None else prefixes:
        long = ends - starts >= n
        keys = np.zeros(len(starts), np.uint64)
        keys[long] = wa.mix(wa.span_hashes(data, starts[long], starts[long] + n, fold=True) + np.uint64(n))
        beginnings.append(keys)
    return Tokens(starts, ends, whole, beginnings, first, np.cumsum(new) - 1)


def document_words(batches: Batches) -> Batches:
    """Distinct words of each labelled document, counted per task: (word, toxic, n)."""
    for batch in batches:
        toxic = np.array(batch.column(1).to_pylist(), np.int64)
        for low, high, data, offsets in wa.slices(batch.column(0)):
            found = tokens_of(data, offsets)
            words, labels = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for k in range(high - low):
                own = slice(found.first[k], found.first[k + 1])
                marks = np.unique(np.concatenate([x[own] for x in (found.keys, *found.prefixes)]))
                words.append(marks[marks > 0])
                labels.append(np.full(len(words[-1]), toxic[low + k]))
            words, labels = np.concatenate(words), np.concatenate(labels)
            kinds, inverse = np.unique(words, return_inverse=True)
            n = np.stack([np.bincount(inverse[labels == t], minlength=len(kinds)) for t in (0, 1)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds.view(np.int64)), pa.array(n[0].astype(np.int64)), pa.array(n[1].astype(np.int64))],
                ["word", "clean", "toxic"],
            )


def surely_marked(clean: np.ndarray, toxic: np.ndarray, share: float) -> np.ndarray:
    """Whether so many toxic documents among those with a word have a chance below ``CHANCE`` at the usual share."""
    out = np.zeros(len(clean), bool)
    for k, (c, t) in enumerate(zip(clean.tolist(), toxic.tolist(), strict=True)):
        n = c + t
        if t < LEAST_DOCS or t / n < 2 * share:
            continue
        tail = 0.0
        for x in range(t, n + 1):
            log = math.lgamma(n + 1) - math.lgamma(x + 1) - math.lgamma(n - x + 1)
            step = math.exp(log + x * math.log(share) + (n - x) * math.log1p(-share))
            tail += step
            if step < tail * 1e-9:
                break
        out[k] = tail < CHANCE
    return out


@dataclass
class Field:
    """``words`` sorted; ``scores[0]`` is that of all other words. ``pairs[a, b]`` scores tag b behind tag a."""

    words: np.ndarray
    scores: np.ndarray
    pairs: np.ndarray
    logistic: np.ndarray

    def number(self, tokens: Tokens) -> np.ndarray:
        """Number of the score of each token's mark: its word, or its longest marked beginning."""
        out = np.zeros(len(tokens.keys), np.int64)
        if len(self.words):
            for keys in (tokens.keys, *tokens.prefixes):
                at = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
                out = np.where((out == 0) & (self.words[at] == keys), at + 1, out)
        return out

    def document_score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.logistic, -30, 30)))


FEATURES = 4


def features(total: np.ndarray, most: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of documents with ``n`` tokens."""
    return np.stack([np.ones(len(total)), np.log1p(total), most, 10 * total / (n + 10)], axis=1)


def marginals(score: np.ndarray, chain: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(P(toxic) of each token, expected pairs 2 x 2, log partition sum) for tokens grouped by ``chain`` in order.

    All chains advance by one token at a time together, longest first, so a step is one array operation.
    """
    n = len(score)
    if n == 0:
        return np.empty(0), np.zeros((2, 2)), 0.0
    starts = np.flatnonzero(np.r_[True, chain[1:] != chain[:-1]])
    lengths = np.diff(np.r_[starts, n])
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # chains longer than step t
    step = np.exp(pairs)
    emit = np.stack([np.ones(n), np.exp(score)], axis=1)
    forward, scale = np.empty((n, 2)), np.empty(n)
    for t in range(lengths[0]):
        at = starts[: active[t]] + t
        value = emit[at] if t == 0 else (forward[at - 1] @ step) * emit[at]
        scale[at] = value.sum(axis=1)
        forward[at] = value / scale[at][:, None]
    backward = np.ones((n, 2))
    expected = np.zeros((2, 2))
    for t in range(lengths[0] - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        ahead = emit[at + 1] * backward[at + 1] / scale[at + 1][:, None]
        backward[at] = ahead @ step.T
        expected += (forward[at].T @ ahead) * step
    return forward[:, 1] * backward[:, 1], expected, float(np.log(scale).sum())


def fit_field(number: np.ndarray, chain: np.ndarray, tag: np.ndarray, words: np.ndarray, rounds: int = 50) -> Field:
    """Maximum likelihood with a Gaussian prior by gradient steps of adaptive size (Adam)."""
    k = len(words) + 1
    scores, pairs = np.full(k, 0.0), np.zeros((2, 2))
    scores[0] = -4.0
    seen = np.bincount(number, weights=tag, minlength=k)
    joined = chain[1:] == chain[:-1]
    true_pairs = np.zeros((2, 2))
    np.add.at(true_pairs, (tag[:-1][joined].astype(int), tag[1:][joined].astype(int)), 1)
    flat = np.r_[scores, pairs.ravel()]
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    for r in range(1, rounds + 1):
        p, expected, _ = marginals(flat[:k][number], chain, flat[k:].reshape(2, 2))
        slope = np.r_[seen - np.bincount(number, weights=p, minlength=k), (true_pairs - expected).ravel()] - 0.1 * flat
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        flat += 0.3 * (first / (1 - 0.9**r)) / (np.sqrt(second / (1 - 0.99**r)) + 1e-8)
    return Field(words, flat[:k], flat[k:].reshape(2, 2), np.zeros(FEATURES))


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        beta += np.linalg.solve(curve, x.T @ (y - p) - 0.1 * beta)
    return beta


def chosen_chains(number: np.ndarray, chain: np.ndarray, doc: np.ndarray, seed: int) -> np.ndarray:
    """Whether each token's sentence goes into the fit: all with marks, and a few others of each document by a seeded hash."""
    if not len(chain):
        return np.zeros(0, bool)
    size = np.bincount(chain)
    begins = np.r_[0, np.cumsum(size)[:-1]]
    marked = np.bincount(chain[number > 0], minlength=len(size)) > 0
    fit = np.flatnonzero(~marked & (size <= CLEAN_TOKENS))
    nth = fit - chain[np.searchsorted(doc, doc[begins[fit]])]  # in its document
    draw = wa.mix(nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    fit = fit[np.lexsort((draw, doc[begins[fit]]))]
    owner = doc[begins[fit]]
    nth = np.arange(len(fit)) - np.searchsorted(owner, owner)
    marked[fit[nth < CLEAN_CHAINS]] = True
    return marked[chain]


def chains_of(words: np.ndarray, seed: int) -> Callable[[Batches], Batches]:
    """Word numbers and sentence numbers of labelled documents, as runs of bytes: (toxic, size, numbers, chains).

    Tokens of sentences that the fit can do without stay in the task: without marks they add nothing to a score.
    """

    def run(batches: Batches) -> Batches:
        field = Field(words, np.zeros(0), np.zeros((2, 2)), np.zeros(FEATURES))
        for batch in batches:
            toxic = batch.column(1)
            for low, high, data, offsets in wa.slices(batch.column(0)):
                found = tokens_of(data, offsets)
                number = field.number(found).astype(np.int32)
                size = np.diff(found.first)
                doc = np.repeat(np.arange(high - low), size)
                chosen = chosen_chains(number, found.chain, doc, seed)
                chain = found.chain - found.chain[np.searchsorted(doc, doc)] if len(doc) else found.chain
                number, chain = number[chosen], chain[chosen].astype(np.int32)
                first = np.searchsorted(doc[chosen], np.arange(high - low + 1))
                cut = [slice(first[k], first[k + 1]) for k in range(high - low)]
                yield pa.RecordBatch.from_arrays(
                    [toxic.slice(low, high - low), pa.array(size.astype(np.int64)),
                     pa.array([number[c].tobytes() for c in cut], pa.binary()),
                     pa.array([chain[c].tobytes() for c in cut], pa.binary())],
                    ["toxic", "size", "numbers", "chains"],
                )

    return run


def document_sums(field: Field, number: np.ndarray, chain: np.ndarray, doc: np.ndarray, n: int):
    """(marginal of each token, sums by document, largest by document). Sentences without any marked word are clean."""
    p = np.zeros(len(number))
    if len(number):
        marked = np.bincount(chain[number > 0], minlength=chain[-1] + 1) > 0
        open_ = marked[chain]
        p[open_] = marginals(field.scores[number[open_]], chain[open_], field.pairs)[0]
    most = np.zeros(n)
    np.maximum.at(most, doc, p)
    return p, np.bincount(doc, weights=p, minlength=n), most


def score_texts(shared, threshold: float) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        field: Field = shared.value
        for batch in batches:
            rest = [batch.column(k) for k in range(batch.num_columns - 1)]
            for low, high, data, offsets in wa.slices(batch.column(batch.num_columns - 1)):
                n = high - low
                found = tokens_of(data, offsets)
                doc = np.repeat(np.arange(n), np.diff(found.first))
                p, total, most = document_sums(field, field.number(found), found.chain, doc, n)
                score = field.document_score(features(total, most, np.diff(found.first)))
                spans: list[list] = [[] for _ in range(n)]
                hit = np.flatnonzero(p >= 0.5)
                if len(hit):
                    chars = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]  # offsets count characters
                    base = chars[offsets[doc[hit]]]
                    for d, a, b, x in zip(doc[hit].tolist(), (chars[found.starts[hit]] - base).tolist(),
                                          (chars[found.ends[hit]] - base).tolist(), p[hit].tolist(), strict=True):
                        spans[d].append({"start": a, "end": b, "marginal": x})
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(low, n) for c in rest], pa.array(score), pa.array((score >= threshold).astype(np.int32)),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())])))],
                    [*batch.schema.names[:-1], "score", "predicted", "spans"],
                )

    return run


def held_out(doc_id: Column) -> Column:
    """The fold that labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, seed: int = 29) -> Field:
    """``docs`` (doc_id, text), ``labels`` (doc_id, toxic 0 or 1): fits words, field and document score on a bounded sample."""
    usable = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = usable.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(TRAIN_ROWS)
    sample = docs.join(F.broadcast(rows), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))
    sample = sample.dropDuplicates()  # many copies of one text are no more evidence than one
    sizes = dict(sample.groupBy("toxic").count().collect())
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    none = Field(np.empty(0, np.uint64), np.zeros(1), np.zeros((2, 2)), np.array([-3.0, 0.0, 0.0, 0.0]))
    if not 0 < share < 1:
        return none
    counts = sample.mapInArrow(document_words, "word long, clean long, toxic long").groupBy("word").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    telling = counts.filter((F.col("toxic") >= LEAST_DOCS) & (F.col("toxic") > 2 * share * (F.col("clean") + F.col("toxic"))))
    top = telling.orderBy(F.desc("toxic"), "word").limit(WORDS).toArrow()
    keys, clean, toxic = (top[c].to_numpy() for c in ("word", "clean", "toxic"))
    words = np.sort(keys[surely_marked(clean, toxic, share)].view(np.uint64))
    found = sample.mapInArrow(chains_of(words, seed), "toxic int, size long, numbers binary, chains binary")
    found = found.orderBy("toxic", "size", F.xxhash64("numbers", "chains")).toArrow()
    label = found["toxic"].to_numpy()
    number = [np.frombuffer(x, np.int32) for x in found["numbers"].to_pylist()]
    chain, base = [], 0
    for x in found["chains"].to_pylist():
        own = np.frombuffer(x, np.int32)
        own = np.cumsum(np.r_[False, own[1:] != own[:-1]]) + base if len(own) else own
        base = int(own[-1]) + 1 if len(own) else base
        chain.append(own)
    doc = np.repeat(np.arange(len(label)), [len(x) for x in number])
    number, chain = (np.concatenate([np.empty(0, np.int32), *x]).astype(np.int64) for x in (number, chain))
    if not len(words) or not len(number):
        return none
    tag = ((number > 0) & (label[doc] == 1)).astype(float)
    marked = np.bincount(chain[number > 0], minlength=base) > 0
    rank = wa.mix(np.arange(base, dtype=np.uint64) + np.uint64(seed)).astype(float) - marked * 2.0**65
    chosen = np.zeros(base, bool)
    chosen[np.argsort(rank, kind="stable")[:CHAINS]] = True
    some = chosen[chain]
    field = fit_field(number[some], chain[some], tag[some], words)
    _, total, most = document_sums(field, number, chain, doc, len(label))
    size = found["size"].to_numpy()
    field.logistic = fit_logistic(features(total, most, size), (label == 1).astype(float))
    return field


def score_documents(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3,
    id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, spans.

    The models see labels of documents outside the held-out fold only, and nothing but texts as input. ``spans`` are
    character offsets of tokens likelier toxic than not. Null and empty texts have no tokens and get the score of
    such. Rows without id are scored, their labels are not used. Without labels of both kinds all scores are the same.
    No rows give no rows.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    named = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    known = labels.select(F.col(id_column).alias("doc_id"), F.col(label_column).alias("toxic"))
    field = train(named, known.filter(~held_out(F.col("doc_id"))))
    shared = docs.sparkSession.sparkContext.broadcast(field)
    return named.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        score_texts(shared, threshold),
        f"doc_id {id_type}, held_out boolean, score double, predicted int, "
        "spans array<struct<start:long,end:long,marginal:double>>",
    )
