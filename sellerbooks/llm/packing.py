"""Best-fit packing of token pieces into sequences of a fixed capacity, planned on the driver by counts of equal lengths.

Documents become token pieces in Arrow batches: blank-separated chunks are looked up in
a table of chunks already tokenized, which equals tokenizing the whole text because the
tokenizer cuts at white space first. Only pieces of ``capacity`` tokens are cut.

Pieces are then placed in one pass on the driver, which replaces distributed sweeps.
Piece lengths and gaps are whole numbers up to the capacity, so both sorted lists are
held as runs of equal size; a step of the pass takes the
largest unplaced run, gives its members to the successor run of gaps (the smallest
that holds them) in rank order, updates those gaps and goes on; where no gap is large
enough, sequences are opened. Equal pieces that compete for the same gaps are told
apart by rank alone. The state is at most one run of pieces for each length and the
runs of sequences they leave, whatever the corpus size: one small count by length goes
to the driver. What grows with the corpus, numbering the pieces within their length and
giving each its sequence and place, is distributed, with hot lengths cut into chunks.

Defined cases: a NULL or empty text is the end token alone; equal rows are packed
separately; an empty table gives no pieces.
"""

from __future__ import annotations

import bisect
import math
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerbooks.llm.common import ROW, before_in_group, text_blocks, with_row
from sellerbooks.session import materialise

CAPACITY = 4096
END = 1
TOKENIZER = "word_bpe_49k.json"
#: Chunks kept in a worker's table before it starts anew.
MOST_CHUNKS = 200_000
#: Parts of chunks kept, likewise.
MOST_PARTS = 500_000
#: Latin letters, all precomposed and of one lower-case letter each, then ASCII marks but the apostrophe.
LETTERS_AND_MARKS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")
#: A special token of the vocabulary.
MARK = "<|endoftext|>"
#: How the vocabulary writes the last token of a word.
WORD_END = "</w>"
CHUNK_ROWS = 200_000

PIECES = f"{ROW} long, doc_id long, piece int, start long, length long, ids_crc32 long"


class _Codes(dict):
    """Numbers chunks as they appear and lists the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        code = self[chunk] = len(self)
        self.new.append(chunk)
        return code


class ChunkTokens:
    """Token ids of blank-separated chunks, tokenized once each."""

    def __init__(self, path: str):
        # Spark deals out the cores; threads of the tokenizer's own would only compete for them.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self.tokenizer.token_to_id(MARK)
        self.ends_word = np.array(
            [self.tokenizer.id_to_token(i).endswith(WORD_END) for i in range(self.tokenizer.get_vocab_size())]
        )
        self.parts: dict[str, bytes] = {"": b""}
        self._clear()

    def _clear(self) -> None:
        self.codes = _Codes()
        self.flat = np.zeros(1 << 16, dtype="<u4")
        self.places = np.zeros(1 << 12, dtype=np.int64)
        self.known = 0

    def _chunk_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new chunks, one after another, and each one's number of ids.

        Letters with marks after them, which most chunks are, are two parts to the
        tokenizer, the letters in lower case; parts are tokenized once each.
        """
        shapes = [LETTERS_AND_MARKS.fullmatch(w) for w in words]
        cut = [(m[1].lower(), m[2]) if m else (w, "") for m, w in zip(shapes, words)]
        if len(self.parts) > MOST_PARTS:
            self.parts = {"": b""}
        parts = self.parts
        simple = dict.fromkeys(p for m, pair in zip(shapes, cut) if m for p in pair if p not in parts)
        other = dict.fromkeys(pair[0] for m, pair in zip(shapes, cut) if not m and pair[0] not in parts)
        for fresh, encode in ((list(simple), self._encode_parts), (list(other), self._encode)):
            if fresh:
                ids, count = encode(fresh)
                raw = ids.tobytes()
                ends = (4 * np.cumsum(count)).tolist()
                parts.update((x, raw[b - 4 * n : b]) for x, b, n in zip(fresh, ends, count.tolist()))
        found = [parts[a] + parts[b] for a, b in cut]
        return np.frombuffer(b"".join(found), dtype="<u4"), np.array([len(x) // 4 for x in found], dtype=np.int64)

    def _encode_parts(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_encode`` for parts that are one word to the tokenizer each: its last token tells where one ends."""
        texts = [" ".join(words[at : at + 2000]) for at in range(0, len(words), 2000)]
        ids = np.concatenate([np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.flatnonzero(self.ends_word[ids])
        return ids, np.diff(ends, prepend=-1)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks one after another, and each chunk's number of ids.

        Chunks go through the tokenizer as long texts with a special token between them;
        it is split off before anything else, so neighbours do not touch. A chunk that
        could hold such a token itself goes alone.
        """
        words = list(words)
        alone = [i for i, w in enumerate(words) if "<|" in w]
        own = [e.ids for e in self.tokenizer.encode_batch([words[i] for i in alone], add_special_tokens=False)]
        for i in alone:
            words[i] = ""
        texts = [MARK.join(words[at : at + 2000]) for at in range(0, len(words), 2000)]
        parts, counts = [], []
        for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            found = np.array(e.ids, dtype="<u4")
            cuts = np.flatnonzero(found == self.mark)
            parts.append(np.delete(found, cuts))
            counts.append(np.diff(np.concatenate([[-1], cuts, [len(found)]])) - 1)
        ids = np.concatenate(parts)
        count = np.concatenate(counts)
        if alone:
            pieces = np.split(ids, np.cumsum(count)[:-1])
            for i, x in zip(alone, own):
                pieces[i], count[i] = np.array(x, dtype="<u4"), len(x)
            ids = np.concatenate(pieces)
        return ids, count

    def _learn(self) -> None:
        """Tokenize the chunks seen for the first time."""
        new, self.codes.new = self.codes.new, []
        if not new:
            return
        ids, count = self._chunk_ids([c.decode("utf-8", "replace") for c in new])
        total = self.known + len(new)
        if total + 1 > len(self.places):
            self.places = np.concatenate([self.places, np.zeros(max(total + 1, len(self.places)), np.int64)])
        start = self.places[self.known]
        ends = start + np.cumsum(count)
        self.places[self.known + 1 : total + 1] = ends
        if ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(int(ends[-1]), len(self.flat)), "<u4")])
        self.flat[start : ends[-1]] = ids
        self.known = total

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and the number of each text's ids."""
        code = self.codes.__getitem__
        found: list[int] = []
        heads = [0]
        for t in texts:
            found.extend(map(code, t.split()))
            heads.append(len(found))
        codes = np.array(found, dtype=np.int64)
        self._learn()
        starts = self.places[codes]
        lengths = self.places[codes + 1] - starts
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]
        edges = np.concatenate([[0], ends]).astype(np.int64)[heads]
        if self.known > MOST_CHUNKS or len(self.flat) > 16 * MOST_CHUNKS:
            self._clear()
        return ids, np.diff(edges)


def _tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_TABLES: dict[str, ChunkTokens] = {}


def _piece_batches(tokenizer: str, capacity: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _TABLES.get(tokenizer)
        if table is None:
            table = _TABLES[tokenizer] = ChunkTokens(_tokenizer_path(tokenizer))
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column("text")):
                raw = data.tobytes()
                ids, counts = table.ids([raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
                owner, piece, lengths, crcs, kept = [], [], [], [], []
                place = 0
                for doc, n in enumerate(counts.tolist()):
                    own = np.empty(n + 1, dtype="<u4")
                    own[:n], own[n] = ids[place : place + n], END
                    place += n
                    content = own.tobytes()
                    for k, at in enumerate(range(0, n + 1, capacity)):
                        part = content[4 * at : 4 * (at + capacity)]
                        owner.append(doc)
                        piece.append(k)
                        lengths.append(len(part) // 4)
                        crcs.append(zlib.crc32(part))
                        if with_ids:
                            kept.append(part)
                take = pa.array(np.array(owner, dtype=np.int64) + first)
                k = pa.array(piece, pa.int32())
                columns = [
                    batch.column(ROW).take(take),
                    batch.column("doc_id").take(take),
                    k,
                    pa.array(np.array(piece, np.int64) * capacity),
                    pa.array(lengths, pa.int64()),
                    pa.array(crcs, pa.int64()),
                ]
                names = [ROW, "doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(kept, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return cut


def token_pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(_row, doc_id, piece, start, length, ids_crc32) and, if asked for, the ids as little-endian 32-bit numbers."""
    rows = with_row(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_piece_batches(tokenizer, capacity, with_ids), PIECES + (", ids binary" if with_ids else ""))


def place_runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best fit of all pieces, given their number by length, as (length, first rank, sequence, offset, stack).

    The member of rank r goes to sequence + (r - first) // stack at offset + (r - first) % stack * length.
    """
    plan: list[tuple[int, int, int, int, int]] = []
    gaps: list[int] = []  # the distinct gaps, sorted
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> (first sequence, number)
    opened = 0

    def add(gap: int, first: int, number: int) -> None:
        if gap and number:
            if not runs[gap]:
                bisect.insort(gaps, gap)
            runs[gap].append((first, number))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(gaps, length)
            if at == len(gaps):
                stack = capacity // length
                whole, rest = divmod(left, stack)
                plan.append((length, rank, opened, 0, stack))
                add(capacity - stack * length, opened, whole)
                if rest:
                    add(capacity - rest * length, opened + whole, 1)
                opened += whole + bool(rest)
                break
            gap = gaps[at]
            first, number = runs[gap].pop()
            used = min(left, number)
            if used < number:
                runs[gap].append((first + used, number - used))
            if not runs[gap]:
                gaps.pop(at)
            plan.append((length, rank, first, capacity - gap, 1))
            add(gap - length, first, used)
            rank += used
            left -= used
    return plan


def _place_batches(plan):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, firsts, sequences, offsets, stacks = plan.value
        # Plan rows lie in runs of one length, sorted by first rank.
        heads = {int(x): i for i, x in reversed(list(enumerate(lengths.tolist())))}
        sizes = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            row = np.zeros(len(length), dtype=np.int64)
            for x in np.unique(length).tolist():
                own = np.flatnonzero(length == x)
                a = heads[x]
                row[own] = a + np.searchsorted(firsts[a : a + sizes[x]], rank[own], side="right") - 1
            inside = rank - firsts[row]
            keep = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in keep],
                    pa.array(sequences[row] + inside // stacks[row]),
                    pa.array(offsets[row] + inside % stacks[row] * length),
                ],
                names=[*keep, "sequence_id", "offset"],
            )

    return place


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Each token piece with its sequence_id and its offset there."""
    spark = docs.sparkSession
    pieces = materialise(token_pieces(docs, tokenizer, capacity, with_ids))
    # At most ``capacity`` rows, whatever the corpus.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = np.array(place_runs(counts, capacity), dtype=np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(tuple(np.ascontiguousarray(c) for c in plan.T))
    chunks = max(1, math.ceil(sum(counts.values()) / CHUNK_ROWS))
    order = [F.col(ROW), F.col("piece")]
    slim = before_in_group(pieces, ["length"], F.lit(1), order, chunks, [ROW, "piece"], "rank").drop(ROW)
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in slim.schema if f.name != "rank")
    return slim.mapInArrow(_place_batches(shared), f"{kind}, sequence_id long, offset long")
