"""WARC, mixing, packing, repeat removal, search, nearest neighbours and the pipeline, with the defined edge cases."""

import hashlib
import io
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sellerbooks.llm import ann, mixing, packing, repeats, search, warc

WORD = "[^\x20\x09-\x0d]+"


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def prose(rng, n, kinds=400):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


# WARC


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, size int, digest string")


def test_warc_round_trip_and_revisits(spark):
    long, other = "é" * 600, "y" * 1000
    rows = [
        (1, "http://a", long), (2, "http://b\r\nX: 1", long), (3, None, "short"), (4, "http://d", "short"), (5, "u", None),
        (6, "u", ""), (7, "u", other), (7, "u", other), (None, "u", long), (8, "u", "line\r\n\r\nWARC/1.1\r\n" * 50_000),
    ]
    out = warc.round_trip(pages(spark, rows), with_payload=True)
    assert out.filter("kind = 'gap'").count() == 0
    found = out.select("page_id", "record_type", "refers_to", "payload_bytes").collect()
    kinds = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in found), key=repr)
    assert kinds == sorted(
        [
            (1, "revisit", 2), (2, "response", None), (3, "response", None), (4, "response", None), (5, "response", None),
            (6, "response", None), (7, "response", None), (7, "revisit", 7), (8, "response", None), (None, "revisit", 2),
        ],
        key=repr,
    )
    sizes = {r["page_id"]: r["payload_bytes"] for r in found}
    assert sizes[1] == 1200 and sizes[5] == 0
    texts = {r["page_id"]: bytes(r["payload"]) for r in out.filter("record_type = 'response'").collect()}
    assert texts[8].decode() == rows[-1][2] and texts[2].decode() == long
    digests = {r["page_id"]: r["payload_digest"] for r in out.collect()}
    assert digests[1] == hashlib.sha1(long.encode()).hexdigest()
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_warc_equals_sql(spark):
    rng = random.Random(6)
    texts = [prose(rng, rng.randrange(1, 400)) for _ in range(10)]
    df = pages(spark, [(i, "u", rng.choice(texts)) for i in range(60)])
    con = duckdb.connect()
    con.register("pages", df.toPandas())
    cursor = con.execute(warc.CHECK_SQL)
    names = [d[0] for d in cursor.description]
    assert rows_of(warc.round_trip(df), *names) == sorted(cursor.fetchall(), key=repr)


def records(n):
    return [
        warc.build_record(i, i, f"http://x/{i}", p := f"payload {i} ".encode() * (20 + i), len(p), hashlib.sha1(p).hexdigest(), None)
        for i in range(n)
    ]


def read_back(content):
    archive = warc.Archive(pa.PythonFile(io.BytesIO(content), mode="r"))
    parts = list(warc.salvage(archive))
    assert [p[1] for p in parts[1:]] == [p[2] for p in parts[:-1]] and parts[0][1] == 0 and parts[-1][2] == len(content)
    return [warc._page_of(p[3][0]["warc-record-id"]) for p in parts if p[0] == "record"], [p[1:3] for p in parts if p[0] == "gap"]


@pytest.mark.parametrize("squeezed", [True, False])
def test_salvage_after_damage(squeezed):
    parts = [warc._member(r) for r in records(8)] if squeezed else records(8)
    starts = np.cumsum([0, *map(len, parts)]).tolist()
    whole = b"".join(parts)
    assert read_back(whole) == (list(range(8)), [])
    middle = starts[3] - 30  # in the payload, which the digest covers
    flipped = whole[:middle] + bytes([whole[middle] ^ 0x55]) + whole[middle + 1 :]
    assert read_back(flipped) == ([0, 1, 3, 4, 5, 6, 7], [(starts[2], starts[3])])
    cut = whole[: starts[6] + 40]
    assert read_back(cut) == ([0, 1, 2, 3, 4, 5], [(starts[6], starts[6] + 40)])
    noise = b"\x1f\x8b\x08WARC/1.1 noise" * 3
    broken = whole[: starts[1]] + noise + whole[starts[1] : starts[4]] + noise + whole[starts[5] :]
    ids, gaps = read_back(broken)
    assert ids == [0, 1, 2, 3, 5, 6, 7] and len(gaps) == 2 and gaps[0] == (starts[1], starts[1] + len(noise))


def test_plain_record_with_a_very_long_header():
    url = "http://x/" + "a" * (3 << 20)
    payload = b"payload"
    long = warc.build_record(1, 1, url, payload, len(payload), hashlib.sha1(payload).hexdigest(), None)
    assert read_back(records(1)[0] + long + records(3)[2]) == ([0, 1, 2], [])


def test_headers_that_never_end_are_searched_once():
    """Many version lines without an end of header: one gap, in time that follows the bytes."""
    whole = records(1)[0] + b"WARC/1.1\r\nno end " * 100_000
    archive = warc.Archive(pa.PythonFile(io.BytesIO(whole), mode="r"))
    reads = []
    at = archive.at
    archive.at = lambda offset, size: reads.append(size) or at(offset, size)
    parts = list(warc.salvage(archive))
    assert [p[0] for p in parts] == ["record", "gap"] and parts[1][2] == len(whole)
    assert sum(size for size in reads if size > 100) < 4 * len(whole) + 20 * warc.WINDOW


def test_lost_records_are_noticed(spark):
    written = warc.write_archives(pages(spark, [(i, "u", f"page {i}") for i in range(40)]))
    folder = warc.stage_folder(spark)
    manifest = written.withColumn("records", F.col("records") + 1)
    shorts = warc.read_archives(manifest, folder).filter("kind = 'short'").collect()
    assert len(shorts) == written.count() and all(r["reason"].endswith("records") for r in shorts)
    with pytest.raises(Exception, match="of [0-9]+ records"):
        warc.read_archives(manifest, folder, whole=True).count()
    assert warc.read_archives(written, folder, whole=True).count() == 40
    assert warc.read_archives(written.select("path"), folder).count() == 40


# Mixing


def brute_targets(sizes):
    """Share by weight, cap at twice the source, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, target, open_names = 1.5 * sum(sizes.values()), {}, list(names)
    while True:
        total = sum(weight[s] for s in open_names)
        over = [s for s in open_names if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in open_names}
        for s in over:
            target[s] = 2 * sizes[s]
            left -= 2 * sizes[s]
            open_names.remove(s)


def mixing_rows():
    rng = random.Random(7)
    sources = ["b", "a", None, "é", "z", "B"]
    rows = [(i, prose(rng, rng.choice([1, 5, 60, 900])), rng.choice([*sources, "a", "a", "a"])) for i in range(150)]
    return rows + [(1000, None, "a"), (1001, "", "z"), (1002, "one  two\tthree", "tiny"), (1003, prose(rng, 30_000), "z"), (5, "again twice", "a")]


def test_mix_meets_its_targets(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 64)
    rows = mixing_rows()
    df = documents(rows)
    out = mixing.taken(df).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(WORD, t or ""))
    want = brute_targets(sizes)
    assert len(out) == len(rows)
    for s in sizes:
        own = [r for r in out if r["source"] == s]
        assert all(r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 for r in own)
        assert abs(sum(r["taken"] for r in own) - want[s]) <= 0.51
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in out)
    columns = ("doc_id", "source", "size", "taken")
    assert rows_of(mixing.taken(df), *columns) == rows_of(mixing.taken(df), *columns)
    once = df.dropDuplicates(["doc_id"])
    assert rows_of(mixing.taken(once.repartition(3)), *columns) == rows_of(mixing.taken(once.orderBy("text")), *columns)
    assert mixing.taken(df.filter("false")).count() == 0 and mixing.taken(df.filter("text is null")).collect()[0]["taken"] == 0


def test_mixed_documents_hold_the_words_taken(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 64)
    df = documents(mixing_rows())
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    got = {}
    for r in mixed.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(re.findall(WORD, r["text"]))
    want = {}
    for r in mixing.taken(df).collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["taken"]
    assert got == {k: v for k, v in want.items() if v}


def test_splitting_tree_is_exact_and_shards_are_disjoint(documents):
    counts = mixing.split_draws(np.array([0, 7, 1000, 3]), 13)
    assert counts.sum(axis=0).tolist() == [0, 7, 1000, 3] and (counts >= 0).all()
    assert max(counts.sum(axis=1)) - min(counts.sum(axis=1)) <= 4
    rows, pieces = mixing.mix(documents(mixing_rows()), shards=5)
    words = pieces.groupBy("_row", "turn").agg(F.sum("n").alias("n")).join(rows, "_row")
    assert words.filter("n > size").count() == 0
    assert pieces.select("_row", "turn", "first").distinct().count() == pieces.count()


# Packing


def test_pieces_equal_the_tokenizer(documents):
    rng = random.Random(8)
    texts = [None, "", "  ", "Hello, World's <|endoftext|> x", "<|endoftext|<|startoftext|>", "é É  ß ſ İ 日本語 12,5", prose(rng, 9000), "a" * 5000]
    tokenizer = Tokenizer.from_file(packing._tokenizer_path(packing.TOKENIZER))
    out = {(r["doc_id"], r["piece"]): r for r in packing.token_pieces(documents([(i, t, "s") for i, t in enumerate(texts)])).collect()}
    n = 0
    for i, t in enumerate(texts):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], dtype="<u4")
            r = out[(i, k)]
            assert (r["start"], r["length"], r["ids_crc32"]) == (at, len(part), zlib.crc32(part.tobytes()))
            n += 1
    assert n == len(out)


def test_a_full_table_is_begun_anew(monkeypatch):
    table = packing.ChunkTokens(packing._tokenizer_path(packing.TOKENIZER))
    first = [table.ids([t.encode()])[0].tolist() for t in ("alpha beta", "beta <| gamma", "alpha")]
    monkeypatch.setattr(packing, "MOST_CHUNKS", 0)
    again = [table.ids([t.encode()])[0].tolist() for t in ("alpha beta", "beta <| gamma", "alpha")]
    assert first == again


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for x in sorted(lengths, reverse=True):
        fits = [i for i, g in enumerate(gaps) if g >= x]
        if fits:
            gaps[min(fits, key=lambda i: gaps[i])] -= x
        else:
            gaps.append(capacity - x)
    return len(gaps)


@pytest.mark.parametrize("capacity", [10, 64])
def test_runs_place_as_best_fit_does_one_by_one(capacity):
    rng = random.Random(capacity)
    for _ in range(30):
        lengths = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 120))]
        counts = {x: lengths.count(x) for x in set(lengths)}
        plan = packing.place_runs(counts, capacity)
        used = {}
        for i, (length, first, sequence, offset, stack) in enumerate(plan):
            following = [p[1] for p in plan[i + 1 :] if p[0] == length]
            for r in range(first, following[0] if following else counts[length]):
                place = used.setdefault(sequence + (r - first) // stack, [])
                place.append((offset + (r - first) % stack * length, length))
        assert sum(map(len, used.values())) == len(lengths)
        for pieces in used.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(used) == best_fit_decreasing(lengths, capacity)


def test_pack_is_gapless(documents):
    rng = random.Random(9)
    df = documents([(i % 150, prose(rng, rng.choice([1, 30, 400, 3000])), "s") for i in range(200)] + [(None, None, None)])
    out = packing.pack(df).toPandas().sort_values(["sequence_id", "offset"])
    ends = out.offset + out.length
    assert (out.offset == ends.groupby(out.sequence_id).shift(1).fillna(0)).all() and ends.max() <= 4096
    assert out.sequence_id.nunique() == best_fit_decreasing(out.length.tolist(), 4096)
    assert packing.pack(df.filter("false")).count() == 0


# Repeats


def brute_repeats(texts, least):
    seen = {}
    for t in texts:
        for i in range(len(t) - least + 1):
            seen[t[i : i + least]] = seen.get(t[i : i + least], 0) + 1
    out = []
    for t in texts:
        covered = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - least + 1):
            if seen[t[i : i + least]] > 1:
                covered[i : i + least] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~covered])
        spans = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        out.append((len(t), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeat_texts():
    rng = random.Random(10)
    passage, edge = prose(rng, 200), prose(rng, 100)[:400]
    copy = prose(rng, 300)
    edited = copy[:700] + "#" + copy[701:]
    texts = [prose(rng, 50) + passage + prose(rng, 40) for _ in range(12)]
    texts += [edge + prose(rng, 20), prose(rng, 30) + edge, edge[1:] + "x", copy, copy, edited, "é" * 900, "abc" * 500]
    texts += [None, "", "short", prose(rng, 3) * 60, "z" * 399, "q" * 400, "r" * 401, passage[:500], prose(rng, 6000)]
    return texts


@pytest.mark.parametrize("hot", [False, True])
def test_repeats_equal_brute_force(documents, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(repeats, "HOT_BYTES", 0)
    texts = repeat_texts()
    out = {r["doc_id"]: r for r in repeats.remove_repeats(documents([(i, t, "s") for i, t in enumerate(texts)])).collect()}
    want = brute_repeats([(t or "").encode() for t in texts], repeats.LONG)
    got = [(r["n_bytes"], r["n_removed"], len(r["removed"]), r["kept_sha256"]) for _, r in sorted(out.items())]
    assert got == want
    assert sum(w[1] for w in want) > 10_000


def test_repeats_of_none_and_of_null_ids(documents):
    df = documents([(None, "k" * 500, "s"), (None, prose(random.Random(1), 200), "s")])
    assert sorted(r["n_removed"] for r in repeats.remove_repeats(df).collect()) == [0, 500]
    assert repeats.remove_repeats(df.filter("false")).count() == 0


def test_run_index_statistics():
    rng = random.Random(11)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 60))).encode() for _ in range(12)]
    groups = [i % 3 for i in range(12)]
    index = repeats.RunIndex(texts, groups)
    got, at = index.matching_statistics().tolist(), 0
    for i, t in enumerate(texts):
        for p in range(len(t)):
            want = 0
            for j, u in enumerate(texts):
                if groups[i] == groups[j]:
                    for q in range(len(u)):
                        if (i, p) != (j, q):
                            n = 0
                            while p + n < len(t) and q + n < len(u) and t[p + n] == u[q + n]:
                                n += 1
                            want = max(want, n)
            assert got[at] == want
            at += 1
    assert len(index.run_heads[0]) < sum(map(len, texts))


def test_long_texts_are_cut_into_segments(monkeypatch):
    rng = random.Random(12)
    text = prose(rng, 2000).encode()
    whole = {(a, b, h) for _, a, b, h, _ in zip(*repeats.winnow(np.frombuffer(text, np.uint8), np.array([0, len(text)])))}
    monkeypatch.setattr(repeats, "SEGMENT", 1000)
    windows = set()
    for _, base, data, offsets in repeats._segments(pa.array([text.decode()])):
        for _, a, b, h, _ in zip(*repeats.winnow(data, offsets)):
            windows |= {(w + base[0], h) for w in range(a, b + 1)}
    assert windows == {(w, h) for a, b, h in whole for w in range(a, b + 1)}


# Search


@pytest.mark.parametrize("postings", [200, 6_000_000])
def test_search_equals_sql(documents, monkeypatch, postings):
    monkeypatch.setattr(search, "SHARD_POSTINGS", postings)
    rng = random.Random(13)
    rows = [(i, prose(rng, rng.choice([3, 40, 200]), 600 if i % 3 else 30), "s") for i in range(220)]
    rows += [(400, rows[50][1], "s"), (450, None, "s"), (500, "", "s"), (601, "W1 w2 " * 5000, "s"), (650, "nothing here is shared", "s")]
    df = documents(rows)
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    cursor = con.execute(search.CHECK_SQL)
    names = [d[0] for d in cursor.description]
    assert rows_of(search.search(df), *names) == sorted(cursor.fetchall(), key=repr)


def test_search_skips_blocks_and_loses_none():
    rng = np.random.default_rng(5)
    terms = [np.unique(np.concatenate([rng.integers(1, 60, 12), 1000 * (d // 20) + 100 + rng.integers(0, 40, 15)])) for d in range(2000)]
    terms = [t.astype("<u8") for t in terms]
    counts = [rng.integers(1, 4, len(t)).astype("<u4") for t in terms]
    sizes = np.array([c.sum() for c in counts], dtype=float)
    index = search.ShardIndex(terms, counts, sizes, sizes.mean())
    kinds, df = np.unique(np.concatenate(terms), return_counts=True)
    for q in range(0, 2000, 50):
        weights = np.log(2000 / df[np.searchsorted(kinds, terms[q])]) * counts[q]
        every = np.array([index.exact(d, terms[q], weights) for d in range(2000)])
        best = sorted(index.best(terms[q], weights, 10), reverse=True)[:10]
        assert [s for s, _ in best] == sorted(every.tolist(), reverse=True)[:10]
        assert all(every[d] == s for s, d in best)
    assert 0 < index.scored < index.reached / 4


@pytest.mark.parametrize("dense", [0, 7, 1024])
def test_queries_together_read_few_postings_and_lose_none(monkeypatch, dense):
    monkeypatch.setattr(search, "HEAD_TERMS", dense)
    monkeypatch.setattr(search, "CHUNK", 3)
    rng = np.random.default_rng(6)
    common, rare = 1 + rng.zipf(1.3, (1500, 60)) % 400, 1000 + rng.integers(0, 3000, (1500, 20))
    terms = [np.unique(np.concatenate([c, r])).astype("<u8") for c, r in zip(common, rare)]
    terms[7:9] = [terms[6], terms[6]]
    counts = [rng.integers(1, 4, len(t)).astype("<u4") for t in terms]
    sizes = np.array([c.sum() for c in counts], dtype=float)
    index = search.ShardIndex(terms, counts, sizes, sizes.mean())
    kinds, df = np.unique(np.concatenate(terms), return_counts=True)
    asked = list(range(0, 1500, 30))
    queries = [(terms[q], np.log(1 + (1500.5 - df[np.searchsorted(kinds, terms[q])]) / 3) * counts[q]) for q in asked]
    queries.append((np.array([999_999], "<u8"), np.array([1.0])))
    found = index.best_of(queries, 10)
    assert found.pop() == []
    for (t, w), best in zip(queries, found):
        every = sorted(((index.exact(d, t, w), d) for d in range(1500)), reverse=True)
        assert sorted(best, reverse=True)[:10] == every[:10]
    matched = sum(int(df[np.searchsorted(kinds, t)].sum()) for t, _ in queries[:-1])
    if dense > 7:
        assert index.read < matched / 4


def test_search_of_none(documents):
    assert search.search(documents([])).count() == 0
    assert search.search(documents([(50, None, "s")])).count() == 0
    assert rows_of(search.search(documents([(None, "a b", "s"), (50, "b c", "s")])), "query_id", "rank") == [(50, 1), (50, 2)]


# Nearest neighbours


def test_nearest_neighbours_recall_and_scores(spark):
    rng = np.random.default_rng(14)
    x = rng.normal(size=(1500, 32)).astype(np.float32) * rng.uniform(0.5, 2, (1500, 1)).astype(np.float32)
    x[100:160] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(3000, None), (3020, [0.0] * 32), (3040, [float("nan")] * 32), (3060, [1.0, None] * 16), (3080, [float("inf")] * 32), (None, [1.0] * 32), (3100, [1.0])]
    df = spark.createDataFrame([(*r, 0) for r in rows + rows[:30] + bad], "vec_id long, embedding array<float>, k1 int")
    out = ann.nearest(df).toPandas()
    d = x.astype(np.float64)
    hit = 0
    for q in range(0, 1500, 20):
        score = (d * d[q]).sum(axis=1)
        order = np.lexsort((np.arange(1500), -score))
        best = order[order != q][:20]
        own = out[out.query_id == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21)) and q not in set(own.id)
        assert np.allclose(own.score, score[own.id], rtol=0, atol=1e-12)
        assert own.sort_values(["score", "id"], ascending=[False, True]).id.tolist() == own.id.tolist()
        hit += len(set(own.id) & set(best))
    assert hit / (75 * 20) >= 0.9
    assert set(out.query_id) == set(range(0, 1500, 20))


@pytest.mark.parametrize("norms", ["outlier", "lognormal"])
def test_nearest_neighbours_where_norms_vary(spark, norms):
    rng = np.random.default_rng(15)
    x = rng.normal(size=(1200, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if norms == "outlier":
        x[7] *= 100
    else:
        x *= rng.lognormal(0, 1, (1200, 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    out = ann.nearest(df).toPandas()
    hit = 0
    for q in range(0, 1200, 20):
        score = x @ x[q]
        order = np.argsort(-score, kind="stable")
        own = out[out.query_id == q]
        assert sorted(own["rank"]) == list(range(1, 21))
        hit += len(set(own.id) & set(order[order != q][:20]))
    assert hit / (60 * 20) >= 0.9


def test_the_bound_estimates_what_the_probes_meet():
    rng = np.random.default_rng(16)
    x = rng.normal(size=(400, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    shard = ann.Shard(x)
    met, expected = 0, 0.0
    unit = rng.normal(size=(60, 48))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    slots, inside = ann._project(np.concatenate([unit, np.zeros((60, 1))], axis=1))
    for i in range(60):
        probe = ann.Probe(inside[i], (slots[i] * shard.weights).sum(axis=1), shard.weights)
        met += shard.ranges[0].met(probe, 0, 200)[:25].sum()
        expected += sum(probe.success(np.linalg.norm(x[j] - unit[i]), 200) for j in range(25))
    assert abs(met - expected) <= 0.05 * 60 * 25


def test_nearest_neighbours_of_several_dimensions(spark):
    rng = np.random.default_rng(17)
    sizes = [8] * 300 + [9] + [5] * 41 + [6] * 3
    x = [rng.normal(size=n) for n in sizes]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    out = ann.nearest(df).toPandas()
    for q in range(0, len(x), 20):
        same = [i for i, v in enumerate(x) if len(v) == len(x[q]) and i != q]
        own = out[out.query_id == q].sort_values("rank")
        best = sorted(same, key=lambda i: -(x[i] @ x[q]))[:20]
        assert len(own) == len(best) and set(own.id) <= set(same)
        assert len(set(own.id) & set(best)) >= 0.9 * len(best)
    assert {0, 280, 320, 340} <= set(out.query_id) and 300 not in set(out.query_id)


def test_nearest_of_few_and_of_none(spark):
    kind = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [1.0, 0.0])], kind)
    assert [(r["rank"], r["id"]) for r in ann.nearest(few).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert ann.nearest(spark.createDataFrame([], kind)).count() == 0


# Pipeline


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5
    columns, counts = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] >= counts[1] == counts[2] >= counts[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert packed.select("doc_id", "piece").count() >= counts[4]
    good = {r["doc_id"] for r in spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 1").collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.quality_classifier(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).collect()}
    assert len(good - kept) <= 0.02 * len(good)
