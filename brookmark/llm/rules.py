"""Quality rules as weak supervision: rules vote or abstain, and expectation maximisation weighs them.

Each rule votes good (1), bad (-1) or abstains (0) on the counts of a text. The votes of all
documents are reduced to a table of vote patterns (at most 3 to the number of rules, whatever the
input), from which expectation maximisation estimates how often each rule is right on good and on
bad documents and how many documents are good. A document's posterior probability replaces the
usual filter that every rule must pass.

Null and empty texts have no words, every count is 0 and no rule votes: their posterior is the
prior. Repeated rows are documents of their own. Columns of the input other than those named
are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmark.llm.text import SPACE, batch_of, map_batches, raw, staged

SYMBOLS = b"#*$%&|<>"
#: Characters that running prose hardly uses.
MARKS = b"#*$%&|<>!=+@^_~{}[]\\/"
_UPPER = bytes(range(65, 91))
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_letters", "n_distinct", "n_same_as_last", "n_closed", "n_marks", "n_marked",
)
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])


def text_counts(text: bytes | None) -> tuple[int, ...]:
    """The numbers of COUNTS for one text."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.split()
    n = len(words)
    bare = text.translate(None, SPACE)
    first: dict[bytes, int] = {}
    ids = np.fromiter((first.setdefault(w, len(first)) for w in words), np.int64, n)
    seen: set[bytes] = set()
    lines = dup = closed = 0
    for line in text.split(b"\n"):
        held = line.strip()
        if held:
            lines += 1
            dup += line in seen
            seen.add(line)
            closed += held[-1:] in b".!?:;" or held.endswith(b'"')
    return (
        n, len(bare.decode("utf-8", "replace")), len(bare) - len(bare.translate(None, SYMBOLS)), dup,
        _repeated(ids, len(first)), lines, len(bare) - len(bare.translate(None, _UPPER)),
        len(bare) - len(bare.translate(None, _LETTERS)), len(first),
        int((ids[1:] == ids[:-1]).sum()) if n > 1 else 0, closed,
        len(bare) - len(bare.translate(None, MARKS)), sum(w[-1] in MARKS for w in words),
    )


def _repeated(ids: np.ndarray, distinct: int) -> int:
    """Words covered by a window of three words that the text holds twice or more."""
    n = len(ids)
    if n < 4:
        return 0
    pair = ids[:-1] * distinct + ids[1:]
    if distinct > 1_000_000:
        pair = np.unique(pair, return_inverse=True)[1]
    code = pair[:-1] * distinct + ids[2:]
    _, inverse, times = np.unique(code, return_inverse=True, return_counts=True)
    hit = times[inverse] > 1
    covered = np.zeros(n, bool)
    for j in range(3):
        covered[j : n - 2 + j] |= hit
    return int(covered.sum())


def with_counts(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row per document with its counts."""
    kind = dict(docs.dtypes)[id_column]

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.array([text_counts(t) for t in raw(batch.column("text"))], np.int64).reshape(-1, len(COUNTS))
        return batch_of(id=batch.column(id_column), **{c: rows[:, k] for k, c in enumerate(COUNTS)})

    schema = f"id {kind}, " + ", ".join(f"{c} long" for c in COUNTS)
    return map_batches(docs.select(id_column, "text"), count, schema).withColumnRenamed("id", id_column)


@dataclass(frozen=True)
class Rule:
    """Votes good up to ``good``, bad from ``bad`` on and abstains between, where ``low``; or mirrored."""

    name: str
    value: Column
    good: float
    bad: float

    def vote(self) -> Column:
        up = self.bad > self.good
        is_good = self.value <= self.good if up else self.value >= self.good
        is_bad = self.value >= self.bad if up else self.value <= self.bad
        return F.when(is_good, 1).when(is_bad, -1).otherwise(0).cast("int")


def default_rules() -> list[Rule]:
    """Rules over the counts; a ratio over nothing is null, on which a rule abstains."""
    def per(a: str, b: str) -> Column:
        return F.col(a) / F.nullif(F.col(b), F.lit(0))

    return [
        Rule("symbols", per("n_symbols", "n_words"), 0.02, 0.10),
        Rule("same_lines", per("n_dup_lines", "n_lines"), 0.05, 0.25),
        Rule("same_phrases", per("n_repeat_words", "n_words"), 0.10, 0.30),
        Rule("shouting", per("n_upper", "n_letters"), 0.10, 0.30),
        Rule("variety", per("n_distinct", "n_words"), 0.40, 0.25),
        Rule("stutter", per("n_same_as_last", "n_words"), 0.02, 0.10),
        Rule("closed_lines", per("n_closed", "n_lines"), 0.60, 0.30),
        Rule("marks", per("n_marks", "n_words"), 0.04, 0.12),
        Rule("marked_words", per("n_marked", "n_words"), 0.03, 0.10),
        Rule("word_length", F.abs(per("word_chars", "n_words") - 5.5), 2.5, 4.5),
    ]


@dataclass(frozen=True)
class VoteModel:
    """Share of good documents and, per rule, how often its vote is right on good and on bad ones."""

    prior: float
    right_on_good: tuple[float, ...]
    right_on_bad: tuple[float, ...]
    rounds: int

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        g, b = np.array(self.right_on_good), np.array(self.right_on_bad)
        return (
            np.log(self.prior / (1 - self.prior))
            + (votes == 1) @ np.log(g / (1 - b)) + (votes == -1) @ np.log((1 - g) / b)
        )

    def posterior(self, votes: list[Column]) -> Column:
        """The same as a column expression over vote columns."""
        total = F.lit(float(np.log(self.prior / (1 - self.prior))))
        for vote, g, b in zip(votes, self.right_on_good, self.right_on_bad):
            total = total + F.when(vote == 1, float(np.log(g / (1 - b)))).when(
                vote == -1, float(np.log((1 - g) / b))
            ).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def fit_votes(
    patterns: np.ndarray, weights: np.ndarray, rounds: int = 200, tolerance: float = 1e-9,
    start: float = 0.8, least: float = 0.55, most: float = 0.995, better: float = 0.05,
    most_on_bad: float = 0.4,
) -> VoteModel:
    """Expectation maximisation over weighted vote patterns.

    On good documents every rule is taken to be right more often than not (``least``), which settles
    which class is the good one. Bad documents fail in different ways, so that one rule is taken to be
    right on at most ``most_on_bad`` of those it votes on, and only has to beat chance by ``better``:
    no kind of fault, however common, makes the others' votes proof of goodness. Nothing to learn from gives the starting values.
    """
    k = patterns.shape[1]
    model = VoteModel(start, (start,) * k, (start,) * k, 0)
    if not weights.sum():
        return model
    good, bad = (patterns == 1).astype(float), (patterns == -1).astype(float)
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-model.log_odds(patterns)))
        on_good, on_bad = weights * p, weights * (1 - p)
        g = (on_good @ good + 1) / (on_good @ (good + bad) + 2)
        b = (on_bad @ bad + 1) / (on_bad @ (good + bad) + 2)
        prior = np.clip((on_good.sum() + 1) / (weights.sum() + 2), 0.01, 0.99)
        g = np.clip(g, least, most)
        b = np.clip(b, np.minimum(1 - g + better, most_on_bad), most_on_bad)
        moved = max(abs(prior - model.prior), np.abs(g - model.right_on_good).max(), np.abs(b - model.right_on_bad).max())
        model = VoteModel(float(prior), tuple(map(float, g)), tuple(map(float, b)), step)
        if moved < tolerance:
            break
    return model


def weigh(counts: DataFrame, rules: list[Rule] | None = None) -> tuple[DataFrame, VoteModel]:
    """Add ``vote_<rule>`` and ``quality`` (posterior probability) to a frame of counts.

    ``counts`` is read twice, so it should be stored.
    """
    rules = rules or default_rules()
    names = [f"vote_{r.name}" for r in rules]
    voted = counts.withColumns({n: r.vote() for n, r in zip(names, rules)})
    # at most 3 ** len(rules) rows
    table = sorted(tuple(r) for r in voted.where("n_words > 0").groupBy(*names).count().collect())
    votes = np.array([r[:-1] for r in table], int).reshape(-1, len(rules))
    model = fit_votes(votes, np.array([r[-1] for r in table], float))
    return voted.withColumn("quality", model.posterior([F.col(n) for n in names])), model


def judge(docs: DataFrame, min_words: int = 50, most_repeated: int = 50, keep_from: float = 0.5) -> DataFrame:
    """Counts, votes and verdict of every document.

    ``base_failed``: fewer than ``min_words`` words, or more than ``most_repeated`` per cent of them
    in repeated windows. ``kept``: not failed, and a posterior of ``keep_from`` or more.
    """
    judged, _ = weigh(staged(with_counts(docs)))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= keep_from)
    )
