"""Line quality by a linear-chain conditional random field, document quality from its marginals.

Every line of a text gets a state, good or bad. Features are numbers seen in the line and in its
neighbours; transition weights tie neighbouring lines. Labels are given per document, so while
learning each line carries the label of its document. A document's quality is the mean over its
lines of the forward-backward marginal of the good state, weighted by the lines' lengths.

The field is fitted on a bounded sample (``sample`` labelled documents, those with the lowest hash of
their id, and of their texts as many as have ``sample_chars`` characters together); everything is scored.
Scoring maps documents where they lie, without a shuffle.

Null and empty texts are one empty line. Lines beyond any number are all scored: chains are put side by side
only while their matrix has few cells, so a text with very many lines is worked off alone, in memory
proportional to its own lines. Repeated rows are scored
each. Unlabelled, null-labelled and null-id rows are never learned from; a ``doc_id`` labelled both
ways is learned from both ways. Without labelled rows every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brookmark.llm.text import carried, map_batches, raw, restored, sliced

_UPPER, _MARKS = bytes(range(65, 91)), b"#*$%&|<>!"
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_DIGITS = b"0123456789"
OWN = 13  # numbers per line before its neighbours' are added


def _numbers(line: bytes, seen: set[bytes]) -> tuple[float, ...]:
    words = line.split()
    n = len(words)
    if not n:
        return (1.0,) + (0.0,) * (OWN - 1)
    size = len(line)
    letters = size - len(line.translate(None, _LETTERS))
    upper = (size - len(line.translate(None, _UPPER))) / max(1, letters)
    marks = (size - len(line.translate(None, _MARKS))) / n
    digits = (size - len(line.translate(None, _DIGITS))) / size
    again = sum(map(bytes.__eq__, words[1:], words)) / n
    variety = len(set(words)) / n
    held = line.strip()
    known = held in seen
    seen.add(held)
    return (
        0.0, min(np.log1p(n) / 5, 2.0), min(marks, 2.0), float(marks > 0.1), float(upper > 0.3), upper,
        min(digits * 5, 1.0), again, float(again > 0.1), 1 - variety if n > 8 else 0.0,
        float(held[-1:] in b".!?"), float(known), abs(letters / n - 5.5) / 5.5,
    )


def line_features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines, features) matrix and the lines' lengths; neighbours' numbers stand beside the line's own."""
    lines = (text or b"").split(b"\n")
    seen: set[bytes] = set()
    own = np.array([_numbers(line, seen) for line in lines], np.float32)
    edge = np.zeros((1, OWN), np.float32)
    before, behind = np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge])
    ends = np.zeros((len(lines), 3), np.float32)
    ends[0, 0] = ends[-1, 1] = ends[:, 2] = 1
    return np.hstack([own, before, behind, ends]), np.array([max(1, len(x)) for x in lines], float)


@dataclass(frozen=True)
class Field:
    """Weights of the good state's emission, of the four transitions (from, to), and the scale.

    ``scale`` maps the log odds of a document's mean marginal to those of its label.
    """

    emission: np.ndarray
    transition: np.ndarray
    scale: tuple[float, float] = (1.0, 0.0)

    @classmethod
    def blank(cls) -> Field:
        return cls(np.zeros(3 * OWN + 3), np.zeros((2, 2)))


def _padded(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chains as columns of a (longest, chains) matrix, longest chain first, with a mask and that order."""
    sizes = np.diff(starts)
    order = np.argsort(-sizes, kind="stable")
    longest = int(sizes.max(initial=0))
    out = np.zeros((longest, len(sizes)))
    inside = np.arange(longest)[:, None] < sizes[order][None, :]
    out.T[inside.T] = np.concatenate([flat[starts[i] : starts[i + 1]] for i in order]) if len(order) else []
    return out, inside, order


def _forward_backward(emit: np.ndarray, inside: np.ndarray, t: np.ndarray):
    """Marginals of the good state, expected transitions and log partition of each chain.

    ``emit`` is the good state's score, the bad state's is 0. Works in log space, a step for all
    chains at once.
    """
    longest, chains = emit.shape
    score = np.stack([np.zeros_like(emit), emit], -1)
    alpha = np.full((longest, chains, 2), -np.inf)
    alpha[0] = score[0]
    for i in range(1, longest):
        live = int(inside[i].sum())
        step = alpha[i - 1, :live, :, None] + t
        alpha[i, :live] = np.logaddexp(step[:, 0], step[:, 1]) + score[i, :live]
    beta = np.zeros((longest, chains, 2))
    pairs = np.zeros((2, 2))
    last = inside.sum(0) - 1
    ends = alpha[last, np.arange(chains)]
    logz = np.logaddexp(ends[:, 0], ends[:, 1])
    for i in range(longest - 2, -1, -1):
        live = int(inside[i + 1].sum())
        ahead = (score[i + 1, :live] + beta[i + 1, :live])[:, None, :] + t
        beta[i, :live] = np.logaddexp(ahead[:, :, 0], ahead[:, :, 1])
        pairs += np.exp(alpha[i, :live, :, None] + ahead - logz[:live, None, None]).sum(0)
    good = np.exp(np.where(inside, alpha[:, :, 1] + beta[:, :, 1] - logz, -np.inf))
    return good, pairs, logz


def _flat(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    made = [line_features(t) for t in texts]
    starts = np.cumsum([0, *(len(w) for _, w in made)])
    return np.vstack([f for f, _ in made]), np.concatenate([w for _, w in made]), starts


def fit(texts: list[bytes | None], labels: list[int], rounds: int = 150, rate: float = 0.1, decay: float = 1e-3) -> Field:
    """Maximise the regularised likelihood of the labelled chains by Adam steps on all of them.

    A document weighs in by its lines. Without both labels there is nothing to tell apart and the
    field is blank. At last the documents' mean marginals are scaled to their labels.
    """
    field = Field.blank()
    if len(set(labels)) < 2:
        return field
    features, _, starts = _flat(texts)
    features = features.astype(float)
    sizes = np.diff(starts)
    truth = np.repeat(np.asarray(labels, float), sizes)
    padded_truth, inside, order = _padded(truth, starts)
    index, _, _ = _padded(np.arange(len(truth), dtype=float), starts)
    index = index.astype(int)
    weights = np.concatenate([field.emission, field.transition.ravel()])
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    seen_pairs = np.zeros((2, 2))
    for a in (0, 1):
        seen_pairs[a, a] = sum(max(0, s - 1) for s, y in zip(sizes, labels) if int(y) == a)
    n_lines = len(truth)
    for step in range(1, rounds + 1):
        emission, transition = weights[:-4], weights[-4:].reshape(2, 2)
        emit = np.where(inside, (features @ emission)[index], 0.0)
        good, pairs, _ = _forward_backward(emit, inside, transition)
        off = np.zeros(n_lines)
        off[index[inside]] = (padded_truth - good)[inside]
        gradient = np.concatenate([features.T @ off, (seen_pairs - pairs).ravel()]) / n_lines - decay * weights
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights = weights + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    field = Field(weights[:-4], weights[-4:].reshape(2, 2))
    means, _ = quality(texts, field)
    return replace(field, scale=_scale(_logit(means), np.asarray(labels, float)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _scale(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Logistic regression of the labels on one number, by Newton steps."""
    design = np.stack([x, np.ones_like(x)], 1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        pull = design.T @ (y - p) - ridge * len(x) * (w - [1.0, 0.0])
        bend = (design * (p * (1 - p))[:, None]).T @ design + ridge * len(x) * np.eye(2)
        w = w + np.clip(np.linalg.solve(bend, pull), -2, 2)
    return float(max(w[0], 0.05)), float(w[1])


def _bytes(texts: Sequence[bytes | str | None]) -> list[bytes | None]:
    return [t.encode() if isinstance(t, str) else t for t in texts]


def side_by_side(texts: list[bytes | None], cells: int) -> list[np.ndarray]:
    """Texts in groups whose padded matrices have at most so many cells each, or hold one text."""
    lines = np.array([1 if t is None else t.count(b"\n") + 1 for t in texts], np.int64)
    order = np.argsort(-lines, kind="stable")
    groups, start = [], 0
    for at in range(1, len(order) + 1):
        if at == len(order) or lines[order[start]] * (at - start + 1) > cells:
            groups.append(order[start:at])
            start = at
    return groups


def quality(texts: Sequence[bytes | str | None], field: Field, cells: int = 200_000) -> tuple[np.ndarray, list[np.ndarray]]:
    """Documents' scores and their lines' marginals; texts are UTF-8 bytes or strings."""
    texts = _bytes(texts)
    scores, lines = np.zeros(len(texts)), [np.zeros(0)] * len(texts)
    for group in side_by_side(texts, cells):
        found, own = _quality([texts[i] for i in group], field)
        scores[group] = found
        for i, marginals in zip(group, own):
            lines[i] = marginals
    return scores, lines


def _quality(texts: list[bytes | None], field: Field) -> tuple[np.ndarray, list[np.ndarray]]:
    features, weights, starts = _flat(texts)
    emit, inside, order = _padded(features @ field.emission, starts)
    good, _, _ = _forward_backward(emit, inside, field.transition)
    scores, lines = np.zeros(len(texts)), [np.zeros(0)] * len(texts)
    for column, doc in enumerate(order):
        own = good[: starts[doc + 1] - starts[doc], column]
        lines[doc] = own
        scores[doc] = np.average(own, weights=weights[starts[doc] : starts[doc + 1]])
    a, b = field.scale
    return 1 / (1 + np.exp(-np.clip(a * _logit(scores) + b, -30, 30))), lines


def learn(docs: DataFrame, labels: DataFrame, sample: int = 4000, sample_chars: int = 100_000_000) -> Field:
    """Fit on at most ``sample`` labelled documents; ``labels`` has doc_id and quality (0 or 1).

    Texts are taken in the order of their ids' hashes while they have at most ``sample_chars`` characters together.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").select("doc_id", "quality").distinct()
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    texts = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    rows = texts.join(F.broadcast(chosen), "doc_id").orderBy("doc_id", "quality", F.xxhash64("text")).limit(2 * sample)
    by_hash = Window.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, 0)
    size = F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long")).over(by_hash)  # of at most 2 * sample rows
    taken = rows.withColumn("__size", size).where(F.col("__size") <= sample_chars).orderBy("doc_id", "quality", F.xxhash64("text"))
    held = taken.select("text", "quality").toArrow()  # at most 2 * sample texts
    return fit(raw(held.column("text").combine_chunks()) if held.num_rows else [], held.column("quality").to_pylist())


def score(docs: DataFrame, field: Field, rows: int = 1000) -> DataFrame:
    """All rows and columns with ``score`` and ``line_scores``, which replace columns of those names."""
    plain = docs.drop("score", "line_scores")

    def run(batch: pa.RecordBatch):
        for part in sliced([batch], rows):
            scores, lines = quality(raw(part.column("text")), field)
            columns = [*part.columns, pa.array(scores), pa.array(lines, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "score", "line_scores"])

    schema = ", ".join(f"`{n}` {t}" for n, t in plain.dtypes) + ", score double, line_scores array<double>"
    return map_batches(plain, run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = 4000) -> DataFrame:
    """Documents whose quality reaches the threshold, with the columns they came with."""
    judged = score(carried(docs, "text"), learn(docs, labels, sample))
    return restored(judged.where(F.col("score") >= threshold), docs, "text")
