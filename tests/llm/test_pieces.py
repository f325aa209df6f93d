"""SentencePiece encoding against the library, and the defined edge cases."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")

from sellerbooks.llm import pieces  # noqa: E402

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def tables():
    return pieces.PieceTables(MODEL)


def same(tables, library, texts):
    ids, at = pieces.encode_block(tables, texts)
    expected = library.encode(texts, add_eos=True, num_threads=1)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == expected
    assert pieces.decode_block(tables, ids.astype(np.int64), at) == [library.decode(e) for e in expected]


def test_plain_and_odd_texts(tables, library):
    same(tables, library, ["", " ", "  ", "a", " a", "a ", "▁x", "ﬁ é", "\x00 a", "</s>a", "<0x41>", "<unk>", "\n\n\n", "😀😀a", "日本語 梦", "a" * 999])
    same(tables, library, ["x" + " " * k + "y" for k in range(70)] + [" " * 5000, "ab" * 700, "=" * 333])


def test_random_texts(tables, library):
    rng = random.Random(5)
    known = [library.id_to_piece(i) for i in range(259, 32000)]
    letters = "ab e▁the\nió梦,.01"
    same(tables, library, ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)])
    # Pieces side by side, without blanks between them, merge across their borders.
    same(tables, library, ["".join(rng.choice(known) for _ in range(rng.randrange(12))) for _ in range(3000)])
    anything = [chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(9000)]
    same(tables, library, ["".join(anything[i : i + 9]) for i in range(0, 9000, 9)])


def test_rounds_keep_the_order_of_single_merges(tables):
    """The vectorised rounds equal merging one pair at a time, segment by segment."""
    rng = random.Random(6)
    for _ in range(60):
        points = np.array([ord(rng.choice("thentaoier▁")) for _ in range(rng.randrange(1, 90))])
        symbols = tables.of_points(points)
        places, merged = pieces.merge(tables, symbols, np.zeros(1, np.int64))
        assert list(zip(places.tolist(), merged.tolist())) == pieces._one_at_a_time(tables, symbols.tolist())


def test_decoding_of_any_ids(tables, library):
    rng = random.Random(7)
    rows = [[rng.randrange(32000) for _ in range(rng.randrange(30))] for _ in range(500)]
    rows += [[rng.randrange(300) for _ in range(rng.randrange(30))] for _ in range(2000)] + [[], [2], [1, 2, 0]]
    flat = np.array([i for r in rows for i in r], np.int64)
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    assert pieces.decode_block(tables, flat, at) == [library.decode(r) for r in rows]


def test_blocks_hold_all_texts(monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK", 10)
    texts = ["a" * 7, None, "b" * 50, "", "c" * 4, "d" * 4, "e" * 4]
    blocks = list(pieces._blocks(pa.array(texts)))
    assert [t for b in blocks for t in b] == [t or "" for t in texts] and max(map(len, blocks)) < len(texts)


def test_on_spark_with_edge_cases(spark, documents, library):
    rows = [(1, "one two", "s"), (1, "one two", "s"), (None, None, None), (4, "", "s"), (5, "long word " * 60_000, "s")]
    docs = documents(rows).withColumn("ids", F.lit("clash")).withColumn("doc", F.lit(1)).withColumn("decoded", F.lit(2))
    found = pieces.round_trip(docs, MODEL).collect()
    assert sorted(((r["doc"]["doc_id"], list(r["ids"]), r["decoded"]) for r in found), key=repr) == sorted(
        ((i, library.encode(t or "", add_eos=True), t or "") for i, t, _ in rows), key=repr
    )
    assert all(r["doc"]["ids"] == "clash" and r["doc"]["decoded"] == 2 for r in found)
    encoded = pieces.encode(docs, MODEL).select("doc.doc_id", "ids")
    back = pieces.decode(encoded.unionByName(spark.createDataFrame([(9, None)], encoded.schema)), MODEL)
    assert sorted((r["doc"]["doc_id"] or 0, r["decoded"]) for r in back.collect()) == sorted(
        [(i or 0, t or "") for i, t, _ in rows] + [(9, "")]
    )
    assert pieces.round_trip(documents([]), MODEL).count() == 0
