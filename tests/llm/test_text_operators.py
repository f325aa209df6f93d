"""License scan, line dedup, classifier and SimHash on small tables, with the defined edge cases."""

import random
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sellerbooks.llm import licenses, lines, quality, simhash


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def same_as_sql(spark_df, sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return rows_of(spark_df, *names), sorted(cursor.fetchall(), key=repr)


# License scan


def test_license_scan_equals_sql(documents):
    long = "Permission is hereby granted, free of charge, to any person obtaining one copy of this software and associated " \
        "documentation files (the Software), to deal in the Software without restriction"
    rows = [
        (1, "Released UNDER the MIT license. cc by nc, cc by nc", "a"),
        (2, "intro " + long + " outro", "a"),
        (3, None, "a"), (4, "", None), (5, "cc by", "a"), (6, "Apache License, Version 2.0 x under the mit licenses", "a"),
        (7, "word " * 4000 + "licensed under a creative commons attribution noncommercial 4.0 international license", "b"),
        (8, "All Rights\nReserved", "b"),
    ]
    df = documents(rows)
    ours, check = same_as_sql(licenses.label_documents(df), licenses.CHECK_SQL, documents=df.toPandas())
    assert ours == check
    found = {r["doc_id"]: r for r in licenses.label_documents(df).collect()}
    assert (found[1]["n_base"], found[1]["first_word"], found[1]["last_word"]) == (3, 1, 8)
    assert found[1]["base_labels"] == "cc-by-nc,mit" and found[2]["labels"] == "mit" and found[2]["base_labels"] == ""
    assert found[7]["labels"] == "cc-by-nc" and found[8]["labels"] == "all-rights-reserved"
    assert found[3]["n_words"] == 0 and found[3]["score"] == 0 and found[4]["labels"] == ""
    assert 0.8 <= found[2]["score"] < 1


def test_license_scan_of_repeated_rows_and_of_none(documents):
    df = documents([(1, "cc by nc", "a"), (1, "cc by nc", "a"), (None, "cc by nc", "a")])
    assert rows_of(licenses.label_documents(df), "doc_id", "n_base") == [(1, 1), (1, 1), (None, 1)]
    assert licenses.label_documents(df.filter("false")).count() == 0


# Line dedup


def test_line_dedup_equals_sql(documents):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        own = [f"own line {i} {k}" for k in range(rng.randrange(4))]
        spread = [f"common {k}" for k in range(6) if rng.random() < 0.1 * (k + 2)]
        body = own + spread + [" ", "common 5 \r"][: rng.randrange(3)]
        rng.shuffle(body)
        rows.append((i, "\n".join(body), rng.choice(["s%d" % (i % 14), "s1", None])))
    rows += [(500, None, "s1"), (501, "", "s2"), (502, "\n\n", "s3"), (503, "x" * 100_000, "s4")]
    df = documents(rows)
    kept = lines.dedup_lines(df)
    assert kept.columns == [*df.columns, "n_lines", "n_removed"]
    text = F.coalesce("text", F.lit(""))
    shown = kept.select("doc_id", "n_lines", "n_removed", F.length(text).cast("long").alias("kept_chars"), F.md5(text).alias("kept_md5"))
    ours, check = same_as_sql(shown, lines.CHECK_SQL, documents=df.toPandas())
    assert ours == check
    assert sum(r[2] for r in ours) > 20
    assert kept.filter("doc_id = 500").first()["text"] is None
    assert lines.dedup_lines(df.filter("false")).count() == 0


def test_boilerplate_keeps_its_first_place(documents):
    df = documents([(i, f"menu\nstory {i}", f"s{i}") for i in range(12)] + [(3, "menu\nstory 3", "s3")])
    left = [r["text"] for r in lines.dedup_lines(df, min_sites=12).orderBy("doc_id").collect()]
    assert left[0] == "menu\nstory 0" and all("menu" not in t for t in left[1:])
    assert lines.dedup_lines(df, min_sites=13).filter("n_removed > 0").count() == 0


@pytest.mark.parametrize("sites", [1, 2, 4, 5, 19, 20, 30])
def test_line_threshold_follows_the_sites(documents, sites):
    """Each line stands on as many sites as its number says; half of few sites is enough, for lines of some length."""
    rows = []
    for i in range(sites):
        said = [f"short {n}" for n in range(1, sites + 1) if i < n] + [f"a line of the usual length {n}" for n in range(1, sites + 1) if i < n]
        rows.append((i, "\n".join([*said, f"own line of document number {i}"]), f"s{i}"))
    df = documents(rows)
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = {r[0]: r[2] for r in con.execute(lines.CHECK_SQL).fetchall()}
    assert {r["doc_id"]: r["n_removed"] for r in lines.dedup_lines(df).collect()} == want
    long = min(10, max(3, (sites + 1) // 2))
    assert sum(want.values()) == sum(n - 1 for n in range(long, sites + 1)) + sum(n - 1 for n in range(10, sites + 1))


# Classifier


def labelled(spark, documents, n=600):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        words = ["".join(rng.choice("abcdeimnorst") for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(20, 200))]
        rows.append((i, " ".join(words) if good else "*** ".join(words) + "!!", "s"))
        labels.append((i, int(good), 0))
    return documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifier_on_held_out_rows(spark, documents):
    docs, labels = labelled(spark, documents)
    edge = documents([(None, "some words", None), (10_000, None, "s"), (10_001, "", "s"), (10_002, "plain words " * 30_000, "s")])
    out = quality.classify(docs.unionByName(edge), labels)
    rows = out.join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 80 and sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.95
    scores = {r["doc_id"]: r["score"] for r in out.collect()}
    assert len(scores) == 604 and all(0 <= s <= 1 for s in scores.values()) and scores[10_000] == scores[10_001]
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and 380 <= kept.count() <= 440


def test_classifier_without_labels_and_without_rows(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = documents([(1, "a b c", "s")])
    assert [r["score"] for r in quality.classify(df, none).collect()] == [0.5]
    assert quality.classify(df.filter("false"), none).count() == 0


def test_scores_do_not_depend_on_the_slice(monkeypatch):
    rng = np.random.default_rng(4)
    net = quality.Network.empty()
    net.table[:] = rng.normal(0, 1, net.table.shape)
    net.weight[:] = rng.normal(0, 1, net.weight.shape)
    texts = [bytes(rng.integers(32, 127, n, dtype=np.uint8)) for n in (0, 1, 127, 128, 129, 1000, 5000)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    together = quality.scores(net, data, offsets)
    monkeypatch.setattr(quality, "SLICE", 256)
    alone = [quality.scores(net, np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(together, alone)


# SimHash


def fingerprint(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_simhash_equals_brute_force(documents):
    rng = random.Random(3)
    words = ["Ünder", "the", "a", "of", "moon", "river", "stone", "x" * 40, "日本", "Tree"]
    base = [[rng.choice(words) + str(rng.randrange(30)) for _ in range(150)] for _ in range(12)]
    texts = []
    for b in base:
        for _ in range(6):
            c = list(b)
            for _ in range(rng.randrange(3)):
                c[rng.randrange(150)] = "edit"
            texts.append(rng.choice([" ", "\n", "  "]).join(c))
    texts += [None, "", " \t\n", "one", "one two", "One  two", "a b c", "w " * 20_000]
    df = documents([(100 + i, t, "s") for i, t in enumerate(texts)])
    out = {r["doc_id"]: r for r in simhash.near_duplicates(df).collect()}
    prints = [fingerprint(t) for t in texts]
    assert [out[100 + i]["fp"] & (1 << 64) - 1 for i in range(len(texts))] == prints
    roots = brute_components(prints)
    assert len(set(roots)) < len(set(prints))
    assert [out[100 + i]["component_id"] for i in range(len(texts))] == [100 + r for r in roots]
    kept = simhash.one_of_each_group(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(100 + r for r in set(roots))


def test_simhash_of_repeated_rows_null_ids_and_none(documents):
    df = documents([(7, "a b c d", "s"), (7, "a b c d", "s"), (None, "a b c d", "s"), (None, "q r s t u v", "s")])
    assert rows_of(simhash.near_duplicates(df), "doc_id", "component_id") == [(7, 7), (7, 7), (None, 7), (None, None)]
    assert sorted(map(repr, (r["doc_id"] for r in simhash.one_of_each_group(df).collect()))) == ["7", "None"]
    assert simhash.near_duplicates(df.filter("false")).count() == 0


@pytest.mark.parametrize("pairwise", [0, 4, 10_000])
def test_posting_links_agree_whatever_the_size(monkeypatch, pairwise):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 1 << 40))
    values = {base}
    for _ in range(60):
        bits = rng.integers(24, 64, rng.integers(1, 6))
        values.add(base ^ sum({1 << int(b) for b in bits}))
    values = np.unique(np.array(list(values), dtype=np.uint64))
    a, b = simhash.posting_links(values, (0, 1, 2))
    place = {int(v): i for i, v in enumerate(values)}
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in zip(a.tolist(), b.tolist()):
        x, y = find(place[u]), find(place[v])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(values))] == brute_components([int(v) for v in values])


def test_a_text_of_very_many_lines_loses_only_its_boilerplate(documents):
    """One line goes out of 30,000; the text is split once, so this takes no longer than keeping all of them."""
    long = "\n".join(["menu", *[f"line {k}" for k in range(30_000)], ""])
    rows = [(i, f"menu\nown {i}", f"s{i}") for i in range(12)] + [(100, long, "s1")]
    kept = {r["doc_id"]: r for r in lines.dedup_lines(documents(rows)).filter("doc_id IN (0, 100)").collect()}
    assert kept[100]["text"] == long.removeprefix("menu\n") and kept[100]["n_removed"] == 1
    assert kept[0]["text"] == "menu\nown 0"


def plain_score(net, text):
    """The network as loops over the text's bytes: windows, halves, chunks, mean and maximum, one logistic."""
    halves = [range(a, min(a + quality.HALF, len(text))) for a in range(0, max(len(text), 1), quality.HALF)]
    vector = []
    for f in range(quality.FILTERS):
        most = []
        for half in halves:
            best = 0.0
            for at in half:
                window = text[at : at + quality.WIDTH]
                best = max(best, net.bias[f] + sum(net.table[w, byte, f] for w, byte in enumerate(window)))
            most.append(best)
        vector.append([max(pair) for pair in zip(most, most[1:])] or most)
    pooled = [sum(chunks) / len(chunks) for chunks in vector] + [max(chunks) for chunks in vector]
    return 1 / (1 + np.exp(-(sum(w * v for w, v in zip(net.weight, pooled)) + net.offset)))


def test_scores_equal_a_plain_loop():
    rng = np.random.default_rng(4)
    net = quality.Network.empty()
    net.table[:] = rng.normal(0, 0.3, net.table.shape)
    net.bias[:], net.weight[:], net.offset = rng.normal(0, 0.3, 8), rng.normal(0, 0.3, 16), 0.1
    texts = [rng.integers(0, 256, n).astype(np.uint8).tobytes() for n in (0, 1, 4, 127, 128, 129, 256, 300, 1000)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = quality.scores(net, np.frombuffer(b"".join(texts), np.uint8), offsets)
    assert np.allclose(got, [plain_score(net, t) for t in texts], atol=1e-5)


def test_long_labelled_texts_teach(documents, monkeypatch):
    """Every labelled text is longer than a window: without them nothing would be learned."""
    monkeypatch.setattr(quality, "SAMPLE_CHARS", 300)
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(60):
        good = i % 2
        words = rng.choice(["plain", "prose", "reads", "well"] if good else ["$$$", "!!1", "zzq", "###"], 200)
        rows.append((i, " ".join(words), "s"))
        labels.append((i, good, 0))
    df = documents(rows)
    assert min(len(r[1]) for r in rows) > quality.SAMPLE_CHARS
    known = df.sparkSession.createDataFrame(labels, "doc_id long, quality int, toxic int")
    held = quality.classify(df, known).filter("held_out").collect()
    assert held and all(r["predicted"] == r["doc_id"] % 2 for r in held)
