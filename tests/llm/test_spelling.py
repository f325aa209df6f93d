"""Spelling variants against a comparison of all words, and the defined edge cases."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sellerbooks.llm import spelling
from sellerbooks.session import materialise

COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def found(docs):
    return sorted((tuple(r[c] for c in COLUMNS) for r in spelling.variants(docs).collect()), key=repr)


def typos(rng, word):
    i = rng.randrange(len(word))
    c = rng.choice("aeinrtsÀé")
    return rng.choice([word[:i] + c + word[i:], word[:i] + word[i + 1 :], word[:i] + c + word[i + 1 :]])


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    base = ["".join(rng.choice("aeinrtslé") for _ in range(rng.randrange(7, 12))) for _ in range(40)]
    said = []
    for w in base:
        said += [w] * rng.choice([2, 5, 30, 400])
        for _ in range(6):
            t = typos(rng, w)
            said += [t] * rng.choice([1, 2, 3]) + [typos(rng, t)] * 2
    rng.shuffle(said)
    return [(i, " ".join(said[i::50]).title() if i % 3 else "-".join(said[i::50]), "s") for i in range(50)]


def test_equals_brute_force(documents, corpus):
    rows = corpus + [(None, "Wording wording WORDING ÀÉÎÕÜÝÞ àéîõüýþ ÀÉÎÕÜÝÞ", "s"), (None, None, None), (7, "", "s"), corpus[0], corpus[0]]
    expected = sorted(spelling.brute_force([(i, t) for i, t, _ in rows]), key=repr)
    assert found(documents(rows).withColumn("word", F.lit(1)).withColumn("n", F.lit(2))) == expected
    assert sum(r[2] > 0 for r in expected) > 100 and any(r[3] for r in expected)


def test_blocks_of_any_size_and_depth_give_the_same(documents, corpus, monkeypatch):
    docs = documents(corpus)
    whole = found(docs)
    for members, queries, frontier, per_branch in ((3, 5, 7, 1), (1, 1000, 1 << 20, 10**6)):
        for name, value in (("MEMBERS", members), ("QUERIES", queries), ("FRONTIER", frontier), ("PER_BRANCH", per_branch)):
            monkeypatch.setattr(spelling, name, value)
        assert found(docs) == whole


def test_no_join_sends_words_to_the_driver(spark, documents, corpus):
    table = materialise(spelling.words(documents(corpus)))
    for frame in (spelling.near_pairs(table), spelling.variants(documents(corpus))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_ways_of_several_steps_lead_to_the_root(documents):
    # abcdefgh (2) -> abcdefgi (20) -> abcdefji (200): each ten times as frequent as the one before.
    said = ["abcdefgh"] * 2 + ["abcdefgi"] * 20 + ["abcdefji"] * 200
    rows = [(1000 + i, w, "s") for i, w in enumerate(said)]
    assert found(documents(rows)) == sorted(spelling.brute_force([(i, t) for i, t, _ in rows]), key=repr)


def test_no_words(documents):
    assert found(documents([])) == [] and found(documents([(1, None, "s"), (2, "12 short", None)])) == []


def test_search_reaches_every_neighbour_once():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abcq") for _ in range(rng.randrange(7, 10))) for _ in range(900)})
    words += ["x" * 5000, "x" * 5001, "x" * 4000 + "y" + "x" * 1000]
    n = len(words)
    both = pa.table({"block": [1] * 2 * n, "role": [0] * n + [1] * n, "word": words * 2, "n": [1] * 2 * n})
    pairs = [p for b in spelling._near_in(both) for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    kept = set(words)
    expected = set()
    for w in words:
        for i in range(len(w) if len(w) < 100 else 1):
            shorter = w[:i] + w[i + 1 :]
            expected |= {(w, shorter), (shorter, w)} if shorter in kept else set()
            expected |= {(w, v) for c in "abcq" if (v := w[:i] + c + w[i + 1 :]) in kept and v != w}
    # The three long words are all one apart; the loop above finds one pair of them.
    expected |= {(a, b) for a in words[-3:] for b in words[-3:] if a != b}
    assert len(set(pairs)) == len(pairs) and set(pairs) == expected
