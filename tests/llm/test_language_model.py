"""Classes and scores of the class-based model against brute force, with one block and with many."""

import random
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from brookmark.llm import brown

SCHEMA = "doc_id long, text string"
SHARE, CLASSES = 0.02, 4


def learn():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1


def learned(i) -> bool:
    return zlib.crc32(str(i).encode()) % 5 != 1


@pytest.fixture(scope="module")
def rows():
    """Alternating kinds of frequent words with rare ones between them, whose neighbours differ by document."""
    draw = random.Random(3)
    kinds = [[f"{k}{i}" for i in range(6)] for k in "abcd"]
    texts = [None, "", "only"]
    for i in range(120):
        words = []
        for _ in range(draw.randint(5, 60)):
            words += [draw.choice(kinds[0]), draw.choice(kinds[1])] if i % 3 else [draw.choice(kinds[2]), draw.choice(kinds[3])]
            if draw.random() < 0.4:
                words.append(f"r{draw.randint(0, 60)}")
        texts.append(" ".join(words))
    texts += [f"r{i} a0 " * 4 for i in range(5)] + ["never seen"]
    return list(enumerate(texts))


def hashes(rows):
    return {i: brown.tokens_of(None if t is None else t.encode()).tolist() for i, t in rows}


def brute_model(rows):
    """Counts, frequent words with their classes, and the class of every training word."""
    tokens = hashes(rows)
    training = [t for i, t in tokens.items() if learned(i)]
    counts = Counter(w for t in training for w in t)
    total = sum(counts.values())
    often = [w for w, n in counts.items() if n >= SHARE * total]
    often.sort(key=lambda w: (counts[w], np.uint64(w).astype(np.int64)), reverse=True)
    place = {w: k for k, w in enumerate(often)}
    pairs = Counter()
    for t in training:
        pairs.update((place[x], place[y]) for x, y in zip([0, *t], t) if x in place and y in place)
    a, b = (np.array(x) for x in zip(*sorted(pairs)))
    cls, table = brown.exchange(len(often), a, b, np.array([pairs[p] for p in sorted(pairs)]), CLASSES)
    smooth = table + 0.5
    before = np.log(smooth / smooth.sum(1, keepdims=True))
    behind = np.log(smooth.T / smooth.sum(0)[:, None])
    evidence = {}
    for t in training:
        t = [0, *t]
        for left, right in zip(t, t[1:]):
            if left in place and right not in place:
                evidence[right] = evidence.get(right, 0) + before[cls[place[left]]]
            if right in place and left not in place:
                evidence[left] = evidence.get(left, 0) + behind[cls[place[right]]]
    kind = {}
    for w, n in counts.items():
        if w in place:
            kind[w] = int(cls[place[w]])
        elif n == 1:
            kind[w] = 2 * CLASSES + 1
        else:
            kind[w] = CLASSES + int(np.argmax(evidence[w].round(6))) if w in evidence else 2 * CLASSES
    return tokens, counts, kind, (place, cls, table)


def test_scores_do_not_depend_on_blocks(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    one, many = ({r["doc_id"]: r["score"] for r in brown.score(docs, learn(), CLASSES, SHARE, n).collect()} for n in (10**9, 900))
    assert one.keys() == many.keys() == dict(rows).keys()
    assert all(np.isclose(one[i], many[i], rtol=1e-9) for i in one)


@pytest.mark.parametrize("n_blocks", [1, 17])
def test_classes_of_all_words(spark, rows, n_blocks):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    _, counts, kind, (place, cls, table) = brute_model(rows)
    names = np.array(sorted(place), np.uint64)
    frequent = names, np.array([cls[place[int(w)]] for w in names]), table
    dealt = brown._blocked(docs, n_blocks, learn()).repartition("block").sortWithinPartitions("block")
    made = brown.word_classes(brown.block_words(dealt, frequent, CLASSES), table, CLASSES).collect()
    found = {np.int64(r["word"]).astype(np.uint64).item(): (r["n"], r["kind"]) for r in made if r["n"]}
    found.pop(0)  # the end has a class of its own
    assert found == {w: (counts[w], k) for w, k in kind.items() if w}
    assert Counter(r["word"] for r in made if r["first"]) == Counter(np.uint64(w).astype(np.int64).item() for w in counts)


def brute_scores(rows):
    tokens, counts, kind, _ = brute_model(rows)
    once, end = 2 * CLASSES + 1, 2 * CLASSES + 2
    coded = {i: [end, *[kind.get(w, once) for w in t[:-1]], end] for i, t in tokens.items()}
    moves = np.zeros((end + 1, end + 1))
    for i, c in coded.items():
        if learned(i):
            np.add.at(moves, (c[:-1], c[1:]), 1)
    law, unknown = brown.transition_law(moves, CLASSES)
    scores = {}
    for i, t in tokens.items():
        c = coded[i]
        s = sum(law[x, y] for x, y in zip(c, c[1:]))
        for w in t[:-1]:
            n = counts[w]
            s += np.log10(n) if n > 1 else unknown  # a word never met is as improbable as one met once
        scores[i] = s
    return scores


@pytest.mark.parametrize("block_chars", [10**9, 900])
def test_scores(spark, rows, block_chars):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {r["doc_id"]: r["score"] for r in brown.score(docs, learn(), CLASSES, SHARE, block_chars).collect()}
    wanted = brute_scores(rows)
    assert found.keys() == wanted.keys()
    assert all(np.isclose(found[i], wanted[i], rtol=1e-9) for i in wanted)


def test_unevenly_spread_words_are_counted_whole(spark):
    """A word over the share in all, but under half of it in seven of ten tasks, and its bigrams."""
    texts = ["hot x " * (4 if i < 7 else 32) + f"a{i} b " * (196 if i < 7 else 168) for i in range(10)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(list(enumerate(texts)), 10), SCHEMA)
    names, _, table = brown.cluster(docs, 0.03, 2)
    tokens = [brown.tokens_of(t.encode()) for t in texts]
    counts = Counter(w for t in tokens for w in t.tolist())
    often = {w for w, n in counts.items() if n >= 0.03 * sum(counts.values())}
    assert set(names.tolist()) == often
    assert brown.tokens_of(b"hot")[0].item() in often
    assert table.sum() == sum(x in often and y in often for t in tokens for x, y in zip([0, *t.tolist()], t.tolist()))


def test_gibberish_is_worse_than_text(spark):
    """Invented words score below known ones, a word, and below the text of the same length that the model knows."""
    rng = random.Random(9)
    words = [f"v{i}" for i in range(300)]
    real = [" ".join(rng.choice(words[: 20 + 10 * (k % 20)]) for _ in range(60)) for k in range(200)]
    once = [f"{t} rare{k}" for k, t in enumerate(real)]
    odd = {9000 + k: " ".join(f"zz{k}q{i}" for i in range(60)) for k in range(20)}
    docs = [*enumerate(once), *odd.items()]
    scored = brown.score(spark.createDataFrame(docs, SCHEMA), F.col("doc_id") < 9000, CLASSES, SHARE).collect()
    rate = {r["doc_id"]: r["score"] / r["n_tokens"] for r in scored}
    assert max(rate[i] for i in odd) < min(v for i, v in rate.items() if i not in odd)


def test_the_model_is_a_distribution(spark, rows):
    """All words, met or not, get a mass of one behind every class; written anew from the counts."""
    tokens, counts, kind, _ = brute_model(rows)
    once, end = 2 * CLASSES + 1, 2 * CLASSES + 2
    moves = np.zeros((end + 1, end + 1))
    for i, t in tokens.items():
        if learned(i):
            c = [end, *[kind.get(w, once) for w in t[:-1]], end]
            np.add.at(moves, (c[:-1], c[1:]), 1)
    law, rare = brown.transition_law(moves, CLASSES)
    met_once = sum(1 for w, n in counts.items() if n == 1 and w)
    for before in range(end + 1):
        mass = 10 ** law[before, end] + 2 * met_once * 10 ** (law[before, once] + rare)
        mass += sum(n * 10 ** law[before, kind[w]] for w, n in counts.items() if n > 1 and w and kind[w] <= 2 * CLASSES)
        assert mass <= 1 + 1e-9
        if all(moves[:, k].sum() for k in range(end + 1)):
            assert np.isclose(mass, 1)


class Plain:
    """Stands for blocks whose function is run here, where its memory can be seen."""

    sparkSession = sparkContext = property(lambda self: self)

    def broadcast(self, value):
        return SimpleNamespace(value=value)

    def mapInArrow(self, run, schema):
        return run


def test_a_block_is_counted_in_little_memory():
    """Few distinct words: what is held does not grow with the tokens, and no batch holds all words."""
    draw = np.random.default_rng(5)
    names = np.array([f"w{i}" for i in range(3000)])
    texts = [" ".join(names[draw.integers(0, 3000, 2000)]).encode() for _ in range(600)]
    squeeze = zstandard.ZstdCompressor().compress
    batch = pa.record_batch({
        "block": np.zeros(600, np.int32), "learn": pa.array([i % 5 != 0 for i in range(600)]),
        "packed": pa.array([squeeze(t) for t in texts], pa.binary()),
    })
    often = np.sort(brown.word_hashes([f"w{i}".encode() for i in range(64)]))
    frequent = (often, np.arange(64) % 4)
    tracemalloc.start()
    made = list(brown.block_words(Plain(), frequent, 4)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * 1_200_600
    words = pa.Table.from_batches(made).to_pydict()
    counts = Counter(w for i, t in enumerate(texts) for w in brown.tokens_of(t).tolist() if i % 5)
    assert {np.int64(w).astype(np.uint64).item(): n for w, n in zip(words["word"], words["n"])} == counts
    where = dict(zip(often.tolist(), frequent[1].tolist()))
    near = Counter()
    for i, t in enumerate(texts):
        if i % 5:
            tokens = brown.tokens_of(t).tolist()
            for x, y in zip(tokens, tokens[1:]):
                if x in where and y not in where and y:
                    near[y, where[x]] += 1
                if y in where and x not in where:
                    near[x, where[y] + 64] += 1
    found = {(np.int64(w).astype(np.uint64).item(), c % 128): c // 128 for w, cs in zip(words["word"], words["near"]) for c in cs}
    assert found == near
    small = pa.Table.from_batches(brown.block_words(Plain(), frequent, 4, chunk=5000, rows=100)(iter([batch])))
    assert small.to_pydict() == words and max(b.num_rows for b in small.to_batches()) <= 100
