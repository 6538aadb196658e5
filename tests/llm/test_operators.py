"""Operators on texts against brute force, edge cases included."""

import base64
import json
import random
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import Row
from pyspark.sql import functions as F

import brute
from brookmark.llm import automata, bpe, brown, crf, decontaminate, lineindex, linkgraph, prefixtree, rules, toolcalls
from brookmark.llm.queries import ORACLE, QUERIES, rank_file

SCHEMA = "doc_id long, text string"
random.seed(7)
VOCABULARY = [f"w{i}" for i in range(60)] + ["Été", "naïve", "x|y", "##"]


def some(n, lo=0, hi=120):
    return " ".join(random.choice(VOCABULARY) for _ in range(random.randint(lo, hi)))


@pytest.fixture(scope="module")
def rows():
    """Null, empty and blank texts, copies, near copies, shared passages and lines, long and periodic texts."""
    passage = " ".join(f"p{i}" for i in range(50))
    line = "This is a Line that many of the documents hold in common, whole."
    base = [f"b{i}" for i in range(200)]
    texts = [None, "", " \n\t", "one", "one", "a b c", "A B  C", "to " * 300, passage, "x " * 40 + "y"]
    texts += [some(12) for _ in range(15)] + [some(5, 60, 90) + "\n" + passage + "\n" + some(5, 60, 90) for _ in range(8)]
    texts += [f"{some(4, 3, 9)}\n  {line if i % 2 else line.upper()}\t\n{some(4, 3, 9)}\n{line}" for i in range(7)]
    for i in range(12):
        near = list(base)
        for j in random.sample(range(200), i % 5):
            near[j] = f"n{i}x{j}"
        texts.append(" ".join(near))
    texts += [texts[-1]] * 5 + [some(9, 3000, 3000)]
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_rule_counts(docs, rows, none):
    found = {r["doc_id"]: tuple(r[c] for c in rules.COUNTS[:5]) for r in rules.judge(docs).collect()}
    assert found == {i: brute.counts(t) for i, t in rows}
    assert rules.judge(none).count() == 0


def test_votes_tell_the_odd_ones_out():
    good, bad = [1, 1, 1, 1], [-1, -1, 1, 1]
    model = rules.fit_votes(np.array([good, bad, [0, 0, 0, 0]]), np.array([900.0, 100.0, 5.0]))
    odds = model.log_odds(np.array([good, bad]))
    assert odds[0] > 0 > odds[1]
    assert rules.fit_votes(np.zeros((0, 4), int), np.zeros(0)).prior == 0.8


def test_line_field_matches_enumeration():
    rng = np.random.default_rng(1)
    emit, t = rng.normal(size=(4, 1)), rng.normal(size=(2, 2))
    good, _, logz = crf._forward_backward(emit, np.ones((4, 1), bool), t)
    mass, total = np.zeros(4), 0.0
    for code in range(16):
        y = [(code >> i) & 1 for i in range(4)]
        w = np.exp(sum(emit[i, 0] * y[i] for i in range(4)) + sum(t[y[i], y[i + 1]] for i in range(3)))
        total += w
        mass += w * np.array(y)
    assert np.allclose(good[:, 0], mass / total) and np.isclose(logz[0], np.log(total))


def test_line_field_learns(spark, none):
    sf = "/root/testdata/sf0.01"
    scored = QUERIES["op2_quality_classifier"](spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    good = scored.quality == 1
    assert (scored.score.rank()[good].mean() - (good.sum() + 1) / 2) / (~good).sum() > 0.97
    assert scored.score.between(0, 1).all()
    assert crf.score(none, crf.Field.blank()).count() == 0
    assert crf.quality([None, ""], crf.Field.blank())[0].tolist() == [0.5, 0.5]


def test_verdicts_follow_links(spark):
    pages = spark.createDataFrame([
        (1, "http://a.net/fr/1", '<a href="/x">'), (2, "https://b.org/p?q", "<A HREF='http://a.net/fr/1'>"), (3, "ftp://B.ORG", None),
        (4, None, "<a href=http://b.org>"), (5, "nothing", ""), (6, "http://www.example.com/en/x#y", ""), (7, "http://example.com/en/", ""),
        (8, "http://x.com/", '<a href="//b.org/">'), (9, "http://c.org/", ""),
    ], "page_id long, url string, html string")
    found = {r["page_id"]: r for r in linkgraph.judge(pages).collect()}
    assert [found[i]["verdict"] for i in (1, 4, 5, 6, 7, 8, 9)] == ["block", "allow", "allow", "allow", "block", "allow", "allow"]
    assert (found[3]["host"], found[3]["path"], found[7]["rule"]) == ("b.org", "", "example.com/en/")
    assert found[2]["distrust"] > 0 and found[2]["trust"] > 0  # a blocked host is linked, a trusted one links
    assert linkgraph.judge(pages.limit(0)).count() == 0


def test_a_host_is_judged_by_what_its_mass_is_made_of(spark):
    farm = [(i, f"http://farm{i}.org/", '<a href="http://spam.net/fr/">') for i in range(40)]
    pages = spark.createDataFrame([
        *farm, (50, "http://spam.net/fr/1", ""), (51, "http://spam.net/de/1", ""), (52, "http://good.com/", '<a href="http://mixed.org/">'),
        (53, "http://mixed.org/", '<a href="http://other.net/fr/1">'), (57, "http://other.net/es/", ""), (58, "http://other.net/de/", ""), (54, "http://alone.org/", ""), (55, "http://far.org/", '<a href="http://farm3.org/">'),
        (56, "http://half.net/es/", ""), *[(60 + i, "http://half.net/de/", "") for i in range(9)],
    ], "page_id long, url string, html string").withColumn("verdict", F.lit("clash")).withColumn("host", F.lit(None).cast("string"))
    found = {r["page_id"]: r["verdict"] for r in linkgraph.judge(pages).collect()}
    assert {found[i] for i in range(40)} == {"block"}  # however many share a blocked host's distrust
    assert found[51] == found[55] == found[60] == "block"  # by its own host, behind a linker, by one page of ten
    assert found[52] == found[53] == found[54] == "allow"  # a rule, trust above distrust, no mass at all


def test_tool_calls(spark):
    calls = spark.createDataFrame([
        (1, "a", "f", '{"n": 1, "b": [2.5]}', None, 0), (1, "a", "f", '{"n": 9}', None, 1), (1, "b", "f", '{"n": "x"}', "a", 2),
        (1, "c", "g", "{", "b", 3), (1, "d", "f", None, "e", 4), (1, "e", "f", '{"n": 2}', "d", 5), (2, "a", "f", '{"n": 3}', "zz", 0),
        (None, "a", "f", "{}", None, 0),
    ], "conv_id long, call_id string, name string, arguments string, after string, at int")
    results = spark.createDataFrame([(1, "a", "é\n", 1), (1, "a", "late", 2), (1, "q", "orphan", 1)], "conv_id long, call_id string, content string, at int")
    schemas = {"f": {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer"}}}}
    found = {(r["conv_id"], r["call_id"]): r for r in toolcalls.link(calls, results, schemas).collect()}
    assert {k: r["depth"] for k, r in found.items()} == {(1, "a"): 0, (1, "b"): 1, (1, "c"): 2, (1, "d"): None, (1, "e"): None, (2, "a"): 0}
    assert [found[1, c]["valid"] for c in "abcde"] == [True, False, False, False, True]
    assert found[1, "a"]["json"] == '{"arguments":{"b":[2.5],"n":1},"id":"a","name":"f","result":"é\\n"}'
    assert toolcalls.orphans(calls, results).count() == 1
    assert toolcalls.link(calls.limit(0), results, schemas).count() == 0
    unanswered = toolcalls.link(calls.withColumn("depth", F.lit("own")).withColumn("valid", F.lit(7)), results.limit(0), schemas)
    assert {r["answered"] for r in unanswered.collect()} == {False}


def test_odd_arguments(spark):
    deep = '{"n":' * 99 + "{}" + "}" * 99
    given = [
        '{"n": null}', '{"n": 3.0}', '{"n": 3.5}', '{"n": true}', '{"n": NaN}', '{"n": 1e400}', '{"n": -Infinity}', '{"n": 1, "s": "\\ud800"}',
        '{"n": 1, "s": "\\ud83d\\ude00"}', '{"n": 1, "s": ""}', '{"n": 99}', deep, '{"n": ' + deep + "}", '{"n": ' * 100_000, '{"n": ' + "9" * 5000 + "}",
        '{"n": 1, "k": 1}', '{"n": 1, "k": true}', "[1]", "",
    ]
    schema = {"required": ["n"], "properties": {
        "n": {"type": ["integer", "null", "object"], "maximum": 50}, "s": {"type": "string", "minLength": 1}, "k": {"enum": [True, "x"]},
    }}
    calls = spark.createDataFrame([(1, f"{i:02}", "f", g, None, 0) for i, g in enumerate(given)], "conv_id long, call_id string, name string, arguments string, after string, at int")
    none = spark.createDataFrame([], "conv_id long, call_id string, content string, at int")
    found = sorted(toolcalls.link(calls, none, {"f": schema}).collect(), key=lambda r: r["call_id"])
    assert [i for i, r in enumerate(found) if r["valid"]] == [0, 1, 8, 11, 16]
    for row, text in zip(found, given):
        held = json.loads(row["json"], parse_constant=lambda _: pytest.fail("not JSON"))["arguments"]
        assert held == text or held == json.loads(text)


@pytest.mark.parametrize("shard", [40_000, 1000, 2])
def test_substrings(docs, rows, none, shard):
    found = {r["doc_id"]: r for r in automata.remove_repeats(docs, 35, shard).collect()}
    for i, kept in brute.without_repeats(rows, 35):
        assert found[i]["text"] == " ".join(kept), i
        assert found[i]["n_words"] - len(kept) == sum(s["end"] - s["start"] for s in found[i]["removed"])
    assert automata.remove_repeats(none).count() == 0


def test_periodic_text_is_one_passage():
    h = automata.word_hashes([b"x"] * 5000 + [f"w{i}".encode() for i in range(100)])
    anchors, starts, windows, again = automata.cut(h, 35)
    assert windows.sum() == len(h) - 34 and len(starts) < 40
    assert again.tolist().count(True) == 1 and windows[again.argmax()] > 4900


@pytest.mark.parametrize("shard", [40_000, 500])
def test_long_periodic_texts(spark, shard):
    """One periodic text alone, one of two words, and an anchor that stands in many different passages."""
    shared = " ".join(f"s{i}" for i in range(40))
    rows = [(0, "x " * 3000), (1, "a b " * 1500 + "c"), (2, " ".join(f"u{i}" for i in range(3000)))]
    rows += [(10 + k, f"{some(1, 50, 50)} k{k} {shared} e{k} {some(1, 50, 50)}") for k in range(60)]
    found = {r["doc_id"]: r["text"] for r in automata.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3), 35, shard).collect()}
    assert found == {i: " ".join(kept) for i, kept in brute.without_repeats(rows, 35)}


def test_automaton_counts():
    rng = random.Random(3)
    for _ in range(60):
        texts = [[rng.choice("ab") for _ in range(rng.randint(1, 14))] for _ in range(rng.randint(1, 5))]
        made = automata.SuffixAutomaton()
        for t in texts:
            made.add(t)
        made.close()
        seen = Counter(tuple(t[i : i + 3]) for t in texts for i in range(len(t) - 2))
        for t in texts:
            assert made.repeats(t, 3) == [i for i in range(len(t) - 2) if seen[tuple(t[i : i + 3])] > 1]


def test_lines(docs, rows, none):
    found = {r["doc_id"]: r["text"] for r in lineindex.dedup_lines(docs).collect()}
    assert found == dict(brute.without_lines(rows))
    assert lineindex.dedup_lines(none).count() == 0


def test_line_index_is_reversible(spark, docs, rows):
    part = docs.where("doc_id % 2 = 0")
    index = lineindex.LineIndex.of(part).insert(docs).insert(part)
    assert index.counts.exceptAll(lineindex.LineIndex.of(docs).counts).isEmpty()
    back = index.delete(docs.where("doc_id % 2 = 1"))
    assert sorted(back.counts.collect()) == sorted(lineindex.LineIndex.of(part).counts.collect())


def test_updates_cross_the_threshold_both_ways(spark):
    line = "a line of at least forty code points, number "
    told = spark.createDataFrame([(i, "\n".join(f"{line}{j}" for j in range(i % 4, 12))) for i in range(12)], SCHEMA)
    index = lineindex.LineIndex.of(told.where("doc_id < 3"), min_docs=5)
    for ids in ((3, 4, 5), (6,), (7, 8, 9, 10, 11)):
        index = index.insert(told.where(F.col("doc_id").isin(list(ids))))
    for gone in (range(8, 12), [0, 5, 99]):
        index = index.delete(spark.createDataFrame([(i,) for i in gone] + [(None,)], "doc_id long"))
    left = told.where("doc_id in (1, 2, 3, 4, 6, 7)")
    whole = lineindex.LineIndex.of(left, min_docs=5)
    assert sorted(index.counts.collect()) == sorted(whole.counts.collect())
    held = np.array([r["lo"] for r in index.counts.collect()], np.int64).view(np.uint64)
    filters = [lineindex.CuckooFilter.from_bytes(r["filter"]) for r in index.filters.collect()]
    assert len(filters) == 1 and filters[0].contains(held).all()
    assert (filters[0].table > 0).sum() == len(held) > 0  # those that fell below the threshold are out
    assert sorted(lineindex.drop_lines(left, index).collect()) == sorted(lineindex.drop_lines(left, whole).collect())


def test_cuckoo_filter():
    keys = np.random.default_rng(5).integers(0, 1 << 63, 3000).astype(np.uint64)
    held = lineindex.CuckooFilter.from_bytes(lineindex.CuckooFilter.of(keys).to_bytes())
    assert held.contains(keys).all()
    assert held.contains(np.random.default_rng(6).integers(0, 1 << 63, 3000).astype(np.uint64)).mean() < 0.05
    assert held.delete(keys[0]) and held.contains(keys[1:]).all()


def test_tokens(spark, docs, rows, none):
    data = rank_file()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = [(900, "\x1c\x85 　 a'S 's  \r\n\n12٣ 😀é"), (901, "ab" * 3000), (902, "<|endoftext|>")]
    both = docs.unionByName(spark.createDataFrame(odd, SCHEMA)).withColumn("ids", F.lit("clash"))
    found = {r["doc_id"]: r for r in bpe.encode(both, data, public_tokenizers.PATTERN).collect()}
    for i, t in rows + odd:
        assert found[i]["ids"] == other.encode_ordinary(t or "") and found[i]["decoded"].decode() == (t or ""), i
    assert bpe.encode(none, data, public_tokenizers.PATTERN).count() == 0


def test_remembered_tokens_take_bounded_memory():
    """Many distinct pre-tokens, all met again, leave an encoder of at most two generations of 24 MB."""
    data = rank_file()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder, letters = bpe.Encoder(bpe.Vocabulary.parse(data), public_tokenizers.PATTERN), random.Random(3)
    for at in range(25):
        text = " ".join("".join(letters.choices("abcdefghijklmnopqrstuvwxyzé", k=12)) for _ in range(20_000)) + " z" * at
        for _ in range(2):
            ids = encoder.encode(text)
        assert at % 8 or ids == other.encode_ordinary(text)
        held = sum(sys.getsizeof(k) + sys.getsizeof(v) for d in (encoder.young, encoder.old) for k, v in d.items())
        assert 0 < held <= 48_000_000, at
    short = bpe.Encoder(encoder.vocabulary, public_tokenizers.PATTERN, remember=4000)
    for text in [text[:900], text[500:3000], text[:900], "é" * 9000, "é" * 9000, ""] * 3:
        assert short.encode(text) == other.encode_ordinary(text) and short.size <= 4000


def test_language_model(docs, rows, none):
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    found = {r["doc_id"]: r for r in brown.score(docs, learn, block_chars=5000).collect()}
    tokens = {i: [w.lower() if w.isascii() else w.translate(brute.LOW) for w in brute.words(t)] + [None] for i, t in rows}
    seen = Counter(w for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in t)
    total, distinct = sum(seen.values()), len(seen)
    for i, t in tokens.items():
        base = sum(np.log10((seen[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in t)
        r = found[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(seen[w] > 0 for w in t), total)
        assert np.isclose(r["base_score"], base) and r["score"] < 0
    assert brown.score(none, learn).count() == 0


def test_exchange_finds_alternating_classes():
    a = np.array([0, 0, 2, 2, 1, 1, 3, 3])
    b = np.array([1, 3, 1, 3, 0, 2, 0, 2])
    cls, _ = brown.exchange(4, a, b, np.full(8, 50), 2)
    assert cls[0] == cls[2] != cls[1] == cls[3]


@pytest.mark.parametrize("most", [2_000_000, 900])
def test_classes(docs, rows, none, most):
    found = {r["doc_id"]: r for r in prefixtree.classes(docs, task_grams=most).collect()}
    wanted = brute.classes(rows)
    assert {i: r["component_id"] for i, r in found.items()} == wanted
    assert {i: r["n_shingles"] for i, r in found.items()} == {i: len(brute.grams(t)) for i, t in rows}
    kept = {r["doc_id"] for r in prefixtree.keep_one(docs).collect()}
    assert kept == set(wanted.values())
    assert prefixtree.classes(none).count() == 0


def test_prefix_runs_over_batches():
    gram = np.repeat([1, 2, 3], [3, 40, 2])
    pairs = prefixtree._pairs(gram, np.arange(45), np.full(45, 10 << 32), np.repeat([False, True, False], [3, 40, 2]), 32)
    assert len(pairs[0]) == 3 + 39 + 1 and pairs[4].sum() == 39


def test_decontamination(spark, rows, docs, none):
    items = [(1, "P0, p1 p2; p3 p4 p5 p6 p7 p8 p9 P10"), (2, None), (3, ""), (4, "one"), (5, "B7 b8 b9 b10 b11 b12 b13 b14 b15 b16"), (6, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    extra = docs.withColumn("items", F.lit("clash"))
    found = {r["doc_id"]: (r["n_words"], r["hit_words"], r["items"]) for r in decontaminate.contamination(extra, bench).collect()}
    wanted = brute.contaminated(rows, items)
    assert found == {i: (n, hit, ids) for i, n, hit, ids in wanted}
    clean = {r["doc_id"] for r in decontaminate.remove_contaminated(docs, bench).collect()}
    assert clean == {i for i, _, hit, _ in wanted if not hit}
    cut = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(docs, bench).collect()}
    assert all((cut[i] == t) == (i in clean) for i, t in rows)
    assert decontaminate.contamination(none, bench).count() == 0 == decontaminate.contamination(none, bench.limit(0)).count()


def test_null_ids_and_repeated_rows(spark):
    text = " ".join(f"r{i}" for i in range(60))
    twice = spark.createDataFrame([Row(doc_id=None, text=text), Row(doc_id=5, text=text), Row(doc_id=5, text=text)], SCHEMA)
    assert [r["text"] for r in automata.remove_repeats(twice).collect()] == [""] * 3
    assert {r["component_id"] for r in prefixtree.classes(twice).collect()} == {5}
    assert [r["n_dropped"] for r in lineindex.dedup_lines(twice, min_docs=1).collect()] == [0, 0, 0]
    assert rules.judge(twice).count() == 3
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert [len(r["hit_words"]) for r in decontaminate.contamination(twice, bench).collect()] == [60] * 3


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracles(spark, name):
    from oracle import connect, difference

    sf = "/root/testdata/sf0.001"
    assert difference(QUERIES[name](spark, sf), connect(sf), ORACLE[name]) is None


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf}/documents.parquet")
    from brookmark.llm.text import staged

    docs = staged(corpus_pipeline.STAGES[0][1](spark, source, sf))
    assert docs.columns == source.columns
    held = [(r["doc_id"], r["text"]) for r in docs.collect()]
    cut = brute.without_lines(held)
    one = brute.classes(cut)
    left = [(i, t) for i, t in cut if one[i] == i]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = {i for i, _, hit, _ in brute.contaminated(left, items) if not hit}
    found = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(found) == clean
    encoder = bpe.encoder_for(rank_file(), public_tokenizers.PATTERN)
    assert all(found[i] == len(encoder.encode(t)) for i, t in left if i in clean)


def test_very_long_text_is_scored_alone(spark):
    """One text of 100,000 lines among short ones does not widen their matrix."""
    long = b"\n".join(b"some words of line %d here." % i for i in range(100_000))
    texts = [b"a b c\nd", long, None] * 2
    groups = crf.side_by_side(texts, 200_000)
    assert sorted(i for g in groups for i in g) == list(range(6)) and [len(g) for g in groups] == [2, 4]
    assert [len(g) for g in crf.side_by_side([long, b"a", None], 50_000)] == [1, 2]
    field = crf.Field(np.linspace(-1, 1, 3 * crf.OWN + 3), np.array([[0.5, -0.2], [0.1, 0.3]]))
    together, lines = crf.quality(texts, field)
    assert len(lines[1]) == 100_000 and together[0] == together[3] and together[1] == together[4]
    alone = [crf.quality([t], field)[0][0] for t in texts[:3]]
    assert np.allclose(together[:3], alone)
    assert crf.quality([], field)[0].tolist() == []


def test_fit_takes_a_bounded_number_of_characters(spark):
    docs = spark.createDataFrame([(i, f"line {i}\n" * (1 + i % 7)) for i in range(60)], SCHEMA)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    whole, same = crf.learn(docs, labels), crf.learn(docs, labels, sample_chars=10**6)
    assert np.array_equal(whole.emission, same.emission)
    assert not np.array_equal(whole.emission, crf.learn(docs, labels, sample_chars=500).emission)
    assert np.array_equal(crf.learn(docs, labels, sample_chars=0).emission, crf.Field.blank().emission)


def test_many_rows_without_an_id(spark):
    """Hits of rows without an id, and of one id, are not gathered in one place."""
    item = " ".join(f"q{i}" for i in range(12))
    rows = [(None, f"{item} own{i}" if i % 100 == 0 else f"nothing here {i}") for i in range(10_000)] + [(1, f"x{i} {item}") for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    grams = decontaminate.benchmark_grams(bench)
    assert decontaminate._hits(docs, grams, [10], True).count() == 400
    found = decontaminate.contamination(docs, bench)
    assert found.where(F.size("hit_words") == 12).count() == 400 and found.count() == len(rows)
    assert decontaminate.contamination(docs, bench, broadcast_bytes=0).where(F.size("hit_words") == 12).count() == 400


def test_columns_with_the_operators_own_names(spark):
    """The pipeline's filters give all columns back as they came, whatever they are called."""
    names = "doc_id long, text string, score double, line_scores int, n_lines int, n_dropped int, n_words int, hit_words int, items int, carried int, words int, claims int, row_key int, of int, n_chars long"
    rows = [(i, "A line of text.\nAnother line of it.", 7.0, *range(1, 12), 3) for i in range(4)] + [(None, None, *[None] * 13)]
    docs = spark.createDataFrame(rows, names)
    bench = spark.createDataFrame([(1, "not in any of these texts")], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    import corpus_pipeline

    same = sorted(map(tuple, docs.collect()), key=repr)
    assert sorted(map(tuple, crf.keep_good(docs, labels).collect()), key=repr) == same
    assert sorted(map(tuple, decontaminate.remove_contaminated(docs, bench).collect()), key=repr) == same
    assert sorted(map(tuple, decontaminate.remove_spans(docs, bench).collect()), key=repr) == same
    cut = corpus_pipeline.shared_lines(spark, docs, "")
    assert cut.columns == docs.columns
    assert sorted(map(tuple, cut.drop("n_chars", "text").collect()), key=repr) == sorted(map(tuple, docs.drop("n_chars", "text").collect()), key=repr)


def test_pipeline_stages_on_empty_tables(spark, none):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES:
        empty = none.selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "0L as n_chars")
        assert stage(spark, empty, "/root/testdata/sf0.001").count() == 0, name
