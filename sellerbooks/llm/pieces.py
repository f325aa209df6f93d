"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The model file gives pieces and scores; encoding itself is numpy. A batch of texts is cut
into words in front of every blank that follows another character, where no piece reaches
across; equal words of a batch are merged once. Symbols of all distinct words lie in one flat
array. A pair of neighbours is *linked* while some piece contains both side by side; unlinked
neighbours never meet again, so linked runs are independent segments. A round takes the
smallest pair rank of each segment, merges its leftmost non-overlapping occurrences at once
and compacts; segments without a pair that merges leave. An occurrence whose merged piece
would start a better pair is the last one of its segment in that round, as the next best pair
is then found there: the order of merges is that of one merge at a time. Pieces that share a
score (runs of blanks do) have no order by rank alone; their segments are merged one pair at a time.

The tables follow the vocabulary, never the data (some 10 MB for 32,000 pieces), and are
broadcast; the model file is read on the driver only. Only BPE models with byte pieces and
without normalisation rules beyond the leading blank are taken; others raise ValueError.

Defined cases: a NULL text is encoded like an empty one: the end id alone, decoded to empty
text; very long texts are encoded whole, one text at a time where they pass a block; equal
rows are encoded each; an empty table gives an empty result; other columns pass through as
they are, also where their names are those of helper columns. ``ids`` and ``decoded`` come
beside a struct ``doc`` of the input row, so no input column can clash with them.
"""

from __future__ import annotations

import codecs
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sellerbooks.llm.common import as_bytes

BLANK = "▁"
BLANK_BYTES = BLANK.encode()
#: Bytes of text encoded at a time; a longer text is a block of its own.
BLOCK = 4 << 20
NEVER = np.int32(2**31 - 1)  # rank of a pair that is linked but is no piece
UNKNOWN = 1 << 21  # symbols of characters no piece contains: this plus the code point


class PieceTables:
    """Arrays made from a model: symbols of characters, linked pairs with rank and result, bytes of pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(n)]
        pieces = {model.id_to_piece(i): i for i in range(n) if not special[i]}
        scores = {p: model.get_score(i) for p, i in pieces.items()}
        self.end = model.eos_id()
        self.byte_ids = np.zeros(256, np.int32)
        found = 0
        for i in range(n):
            if model.is_byte(i):
                self.byte_ids[int(model.id_to_piece(i)[1:-1], 16)] = i
                found += 1
        if found != 256 or any(model.is_unused(i) for i in range(n)):
            raise ValueError("only BPE models with byte pieces and without unused pieces are supported")
        if model.encode("ﬁ  é ", out_type=str) != model.encode("ﬁ  é ".replace(" ", BLANK), out_type=str) or (
            model.decode(model.encode("ﬁ  é ")) != "ﬁ  é "
        ):
            raise ValueError("only models that leave the text as it is, but for the leading blank, are supported")
        self._symbols(pieces, n)
        self._pairs(pieces, scores)
        said = [b"" if model.is_control(i) else model.id_to_piece(i).replace(BLANK, " ").encode() for i in range(n)]
        for i in range(n):
            if model.is_unknown(i):
                said[i] = model.decode([model.piece_to_id("a"), i])[1:].encode() if "a" in pieces else " ⁇ ".encode()
        for byte, i in enumerate(self.byte_ids):
            said[i] = bytes([byte])
        self.said = np.frombuffer(b"".join(said), np.uint8)
        self.said_at = np.concatenate([[0], np.cumsum([len(s) for s in said])]).astype(np.int64)
        self.leading = np.array([not special[i] and s.startswith(b" ") for i, s in enumerate(said)])
        self.silent = np.array([model.is_control(i) for i in range(n)])

    def _symbols(self, pieces: dict[str, int], n: int) -> None:
        chars = sorted({c for p in pieces for c in p})
        self.symbol = dict(pieces)
        for c in chars:
            self.symbol.setdefault(c, n + len(self.symbol))
        self.char_points = np.array([ord(c) for c in chars], np.int64)
        self.char_symbols = np.array([self.symbol[c] for c in chars], np.int64)
        points = np.zeros(max(self.symbol.values()) + 1, np.int64)
        points[self.char_symbols] = self.char_points
        self.points, self.size = points, n
        self.is_piece = np.zeros(len(points), bool)
        self.is_piece[list(pieces.values())] = True

    def _pairs(self, pieces: dict[str, int], scores: dict[str, float]) -> None:
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        counts: dict[float, int] = {}
        for s in scores.values():
            counts[s] = counts.get(s, 0) + 1
        tied = sorted(order[s] for s, k in counts.items() if k > 1)
        self.tied = np.zeros(len(order) + 1, bool)
        self.tied[tied] = True
        found: dict[int, tuple[int, int]] = {}
        symbol = self.symbol
        for piece in pieces:
            for i in range(len(piece)):
                for j in range(i + 2, len(piece) + 1):
                    whole = piece[i:j]
                    rank, made = (order[scores[whole]], pieces[whole]) if whole in pieces else (int(NEVER), -1)
                    for k in range(i + 1, j):
                        left, right = symbol.get(piece[i:k]), symbol.get(piece[k:j])
                        if left is not None and right is not None:
                            found[(left << 32) | right] = (rank, made)
        keys = np.fromiter(found.keys(), np.int64, len(found))
        values = np.array(list(found.values()), np.int32).reshape(-1, 2)
        by = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[by], values[by, 0].copy(), values[by, 1].copy()
        # Words begin at a blank only where no piece has a blank after another character.
        self.cut_at_blanks = not any(BLANK in p.lstrip(BLANK) for p in pieces)
        del self.symbol

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(linked, rank, merged symbol) of pairs of symbols."""
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), max(len(self.keys) - 1, 0))
        if not len(self.keys):
            return np.zeros(len(left), bool), np.full(len(left), NEVER), np.full(len(left), -1, np.int32)
        linked = self.keys[at] == wanted
        return linked, np.where(linked, self.ranks[at], NEVER), np.where(linked, self.made[at], -1)

    def of_points(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.char_points, points), len(self.char_points) - 1)
        return np.where(self.char_points[at] == points, self.char_symbols[at], points + UNKNOWN)


def _one_at_a_time(tables: PieceTables, symbols: list[int]) -> list[tuple[int, int]]:
    """(place, symbol) of a segment merged pair by pair, best rank first, then leftmost."""
    n = len(symbols)
    after, before, held = list(range(1, n + 1)), list(range(-1, n - 1)), list(symbols)
    known: dict[tuple[int, int], tuple[int, int]] = {}

    def pair(a: int, b: int) -> tuple[int, int]:
        if (a, b) not in known:
            _, rank, made = tables.pairs(np.array([a], np.int64), np.array([b], np.int64))
            known[a, b] = int(rank[0]), int(made[0])
        return known[a, b]

    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            rank, _ = pair(held[i], held[j])
            if rank != NEVER:
                heapq.heappush(heap, (rank, i, held[i], held[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i] if i < n else n
        if held[i] != a or j >= n or held[j] != b:
            continue
        held[i], held[j] = pair(a, b)[1], -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [(i, s) for i, s in enumerate(held) if s >= 0]


def _compact(keep: np.ndarray, *arrays: np.ndarray) -> list[np.ndarray]:
    return [a[keep] for a in arrays]


def merge(tables: PieceTables, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, symbols) left after all merges; ``starts`` are the places where words begin."""
    n = len(symbols)
    final = np.full(n, -1, np.int64)
    if not n:
        return np.zeros(0, np.int64), final
    place, held = np.arange(n), symbols.astype(np.int64)
    link, rank, made = np.zeros(n, bool), np.full(n, NEVER, np.int32), np.full(n, -1, np.int32)
    link[:-1], rank[:-1], made[:-1] = tables.pairs(held[:-1], held[1:])
    ends = starts[starts > 0] - 1
    link[ends], rank[ends] = False, NEVER
    while len(held):
        begins = np.ones(len(held), bool)
        begins[1:] = ~link[:-1]
        segment = np.cumsum(begins) - 1
        least = np.minimum.reduceat(rank, np.flatnonzero(begins))
        done = least == NEVER
        tie = ~done & tables.tied[np.where(done, 0, least)]
        if tie.any():
            firsts = np.append(np.flatnonzero(begins), len(held))
            for s in np.flatnonzero(tie):
                a, b = firsts[s], firsts[s + 1]
                for i, symbol in _one_at_a_time(tables, held[a:b].tolist()):
                    final[place[a + i]] = symbol
        over = done[segment]
        final[place[over]] = held[over]
        stay = ~(over | tie[segment])
        if not stay.all():
            place, held, link, rank, made, segment = _compact(stay, place, held, link, rank, made, segment)
            if not len(held):
                break
        best = least[segment]
        hit = rank == best
        chosen = _leftmost(hit)
        chosen = _until_better(tables, chosen, held, link, made, best, segment)
        place, held, link, rank, made = _apply(tables, chosen, place, held, link, rank, made)
    places = np.flatnonzero(final >= 0)
    return places, final[places]


def _leftmost(hit: np.ndarray) -> np.ndarray:
    """Of each run of overlapping occurrences the first, third, fifth and so on."""
    index = np.arange(len(hit))
    before = np.zeros(len(hit), bool)
    before[1:] = hit[:-1]
    run = np.maximum.accumulate(np.where(hit & ~before, index, 0))
    return hit & ((index - run) % 2 == 0)


def _until_better(tables, chosen, held, link, made, best, segment) -> np.ndarray:
    """Drop the occurrences of a segment after the first whose piece makes a better pair with a neighbour."""
    at = np.flatnonzero(chosen)
    piece = made[at].astype(np.int64)
    better = np.zeros(len(at), bool)
    right = np.flatnonzero(link[at + 1])  # at + 1 exists, as the pair does
    if len(right):
        better[right] |= tables.pairs(piece[right], held[at[right] + 2])[1] < best[at[right]]
    left = np.flatnonzero((at > 0) & link[at - 1])
    if len(left):
        i = at[left]
        merged = (i > 1) & chosen[i - 2]
        neighbour = np.where(merged, made[i - 2], held[i - 1]).astype(np.int64)
        better[left] |= tables.pairs(neighbour, piece[left])[1] < best[i]
    if not better.any():
        return chosen
    own = segment[at]
    seen = np.cumsum(better) - better  # better ones before this one, in all segments
    begins = np.ones(len(at), bool)
    begins[1:] = own[1:] != own[:-1]
    base = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
    kept = chosen.copy()
    kept[at[seen > seen[base]]] = False
    return kept


def _apply(tables, chosen, place, held, link, rank, made):
    at = np.flatnonzero(chosen)
    held[at] = made[at]
    link[at], rank[at], made[at] = link[at + 1], NEVER, -1
    keep = np.ones(len(held), bool)
    keep[at + 1] = False
    fresh = np.zeros(len(held), bool)
    fresh[at] = True
    place, held, link, rank, made, fresh = _compact(keep, place, held, link, rank, made, fresh)
    ask = link & fresh
    ask[:-1] |= link[:-1] & fresh[1:]
    i = np.flatnonzero(ask)
    if len(i):
        link[i], rank[i], made[i] = tables.pairs(held[i], held[i + 1])
    return place, held, link, rank, made


def _utf8(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of characters and how many each has."""
    text = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "replace")
    data = np.frombuffer(text, np.uint8)
    return data, np.diff(np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data)))


def word_ids(tables: PieceTables, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words one after the other and the n + 1 offsets of the words in them."""
    data, offsets = as_bytes(words)
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4").astype(np.int64)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    starts = lead[offsets]
    if len(points) != starts[-1]:  # bytes that are no UTF-8: count characters word by word
        each = [len(bytes(data[a:b]).decode("utf-8", "replace")) for a, b in zip(offsets[:-1], offsets[1:])]
        points = np.array([ord(c) for a, b in zip(offsets[:-1], offsets[1:]) for c in bytes(data[a:b]).decode("utf-8", "replace")], np.int64)
        starts = np.concatenate([[0], np.cumsum(each)]).astype(np.int64)
    places, symbols = merge(tables, tables.of_points(points), starts[:-1])
    begins = np.searchsorted(places, starts)
    known = symbols < UNKNOWN
    known[known] = tables.is_piece[symbols[known]]
    if known.all():
        return symbols.astype(np.int32), begins
    odd = symbols[~known]
    chars = np.where(odd >= UNKNOWN, odd - UNKNOWN, tables.points[np.minimum(odd, len(tables.points) - 1)])
    raw, sizes = _utf8(chars)
    lengths = np.ones(len(symbols), np.int64)
    lengths[~known] = sizes
    out_at = np.concatenate([[0], np.cumsum(lengths)])
    ids = np.zeros(out_at[-1], np.int32)
    ids[out_at[:-1][known]] = symbols[known]
    from_bytes = np.ones(len(ids), bool)
    from_bytes[out_at[:-1][known]] = False
    ids[from_bytes] = tables.byte_ids[raw]
    return ids, out_at[begins]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Every place of the given ranges, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(before - starts, lengths)


def encode_block(tables: PieceTables, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts, each closed by the end id, and their n + 1 offsets."""
    shown = [(BLANK + t).replace(" ", BLANK).encode("utf-8", "replace") if t else b"" for t in texts]
    data = np.frombuffer(b"".join(shown), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in shown])]).astype(np.int64)
    begins = np.zeros(len(data) + 1, bool)
    if tables.cut_at_blanks and len(data) > 2:
        a, b, c = BLANK_BYTES
        blank = np.zeros(len(data) + 3, bool)
        blank[3:][: len(data) - 2] = (data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c)
        begins[:-1] = blank[3:] & ~blank[:-3]
    begins[offsets] = True
    starts = np.flatnonzero(begins)
    buffers = [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, buffers).dictionary_encode()
    per_doc = np.searchsorted(starts, offsets)
    ids, at = word_ids(tables, words.dictionary) if len(words) else (np.zeros(0, np.int32), np.zeros(1, np.int64))
    which = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = np.diff(at)[which] if len(which) else np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(lengths)])[per_doc] + np.arange(len(per_doc))
    out = np.full(ends[-1], tables.end, np.int32)
    body = np.ones(len(out), bool)
    body[ends[1:] - 1] = False
    if len(which):
        out[body] = ids[_ranges(at[which], lengths)]
    return out, ends


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("one-each", _each_byte)


def decode_block(tables: PieceTables, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The texts that ids stand for; bytes that are no UTF-8 become one replacement character each."""
    lengths = np.diff(tables.said_at)[ids]
    # The first piece that says anything loses its leading blank.
    skip = np.zeros(len(ids), bool)
    speaking = np.flatnonzero(~tables.silent[ids])
    first = np.searchsorted(speaking, offsets[:-1])
    firsts = speaking[first[first < len(speaking)]]
    mine = firsts < offsets[1:][first < len(speaking)]
    firsts = firsts[mine]
    skip[firsts] = tables.leading[ids[firsts]]
    data = tables.said[_ranges(tables.said_at[ids] + skip, lengths - skip)].tobytes()
    ends = np.concatenate([[0], np.cumsum(lengths - skip)])
    # Bytes on both sides of a piece without text belong to two characters, so the text is decoded in parts there.
    inner = np.setdiff1d(np.flatnonzero(tables.silent[ids]), np.concatenate([offsets[1:] - 1, offsets[:-1]]))
    cuts = np.union1d(offsets, inner)
    parts = [data[a:b].decode("utf-8", "one-each") for a, b in zip(ends[cuts[:-1]], ends[cuts[1:]])]
    at = np.searchsorted(cuts, offsets)
    return ["".join(parts[a:b]) for a, b in zip(at[:-1], at[1:])]


def _blocks(column: pa.Array) -> Iterator[list[str]]:
    block, size = [], 0
    for value in column:
        text = value.as_py() or ""
        if block and size + len(text) > BLOCK:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text)
    if block:
        yield block


def _id_lists(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))


_TABLES: dict[str, object] = {}


def _shared_tables(spark, path: str):
    """The tables as a broadcast, made once per application and model."""
    key = f"{spark.sparkContext.applicationId}:{path}"
    if key not in _TABLES:
        _TABLES[key] = spark.sparkContext.broadcast(PieceTables(path))
    return _TABLES[key]


def _run(docs: DataFrame, work: DataFrame, result: T.StructType, step) -> DataFrame:
    """Apply ``step``, from one column of a batch to arrays, beside the whole input row."""
    schema = T.StructType([T.StructField("doc", docs.schema), *result.fields])

    def each(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            doc = batch.column(0)
            yield pa.RecordBatch.from_arrays([doc, *step(batch.column(1))], ["doc", *[f.name for f in result.fields]])

    return work.mapInArrow(each, schema)


def _beside(docs: DataFrame, name: str):
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return docs.select(whole, F.col(f"`{name}`").alias("given"))


def encode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """(doc, ids): each input row as a struct and the ids of its text, the end id last."""
    shared = _shared_tables(docs.sparkSession, model)

    def step(column):
        parts = [_id_lists(*encode_block(shared.value, b)) for b in _blocks(column)]
        return [pa.concat_arrays(parts)]

    return _run(docs, _beside(docs, text), T.StructType().add("ids", T.ArrayType(T.IntegerType())), step)


def decode(rows: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """(doc, decoded): each input row as a struct and the text of its ids; NULL ids give empty text."""
    shared = _shared_tables(rows.sparkSession, model)

    def step(column):
        column = column.fill_null([]) if column.null_count else column
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        return [pa.array(decode_block(shared.value, flat, offsets), pa.string())]

    return _run(rows, _beside(rows, ids), T.StructType().add("decoded", "string"), step)


def round_trip(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """(doc, ids, decoded): encoding and the decoding of those ids, in one pass over the texts."""
    shared = _shared_tables(docs.sparkSession, model)

    def step(column):
        lists, texts = [], []
        for block in _blocks(column):
            ids, offsets = encode_block(shared.value, block)
            lists.append(_id_lists(ids, offsets))
            texts.extend(decode_block(shared.value, ids.astype(np.int64), offsets))
        return [pa.concat_arrays(lists), pa.array(texts, pa.string())]

    result = T.StructType().add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string")
    return _run(docs, _beside(docs, text), result, step)
