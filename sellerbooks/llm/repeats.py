"""Removal of long repeated byte strings with run-length indexes.

A byte goes if it lies in a string of ``LONG`` bytes that starts anywhere else in the
corpus too. The work narrows in steps.

1. Anchors. Every window of LONG bytes has a least 64-byte hash among those inside it;
   equal windows have equal anchors at equal offsets. Neighbouring windows share their
   anchor, so a text has about one anchor per 170 bytes. Only anchors that occur twice
   can lie in repeated windows; the rest of the corpus is done with.
2. Regions. For a repeated anchor, the bytes of all windows that chose it are a region
   of its text; overlapping regions of one text and anchor are joined, so a group of
   equal anchors holds each place of the corpus once. Equal regions form a class: a
   class of two or more is repeated throughout and never moves its bytes again.
3. Run-length index. Groups with several classes, or with a region that holds its
   anchor more than once, are indexed: the suffixes of a group are sorted, the Burrows-Wheeler transform is kept as runs, and at each run's two ends
   the text position and the length of the match with the neighbouring suffix are
   sampled. Matching statistics of the whole text are then streamed in text order: from
   one sampled place to the next the longest match gets shorter by one with each byte,
   as neighbours inside a run stay neighbours. Places whose match reaches LONG bytes are
   marked.
4. Groups of more than ``HOT_BYTES`` bytes, such as what stands around a passage common
   to a third of all texts, are not indexed in one task. Their windows are cut into zones
   of 56, then 8, then 1 starts; a zone goes on only if the bytes common to its windows
   occur twice, and is settled if all its bytes do. A window alone is decided by
   a count. This is exact and takes a few rows a class.

Defined cases: NULL and empty texts have 0 bytes and lose nothing; equal rows repeat
each other; matches never cross texts; overlapping places of one text count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerbooks.llm.common import ROW, U64, as_bytes, mix, prefix_sums, text_blocks, with_row
from sellerbooks.session import materialise

LONG = 400
GRAM = 64
STARTS = LONG - GRAM + 1  # hashes in a window
#: Bytes of a group that one index may hold.
HOT_BYTES = 4 << 20
#: Bytes after which an index is closed at the end of its group.
INDEX_BYTES = 1 << 20
ZONES = (56, 8, 1)
#: The low bits of an ordering key hold the place, the rest the hash.
PLACE_BITS = U64(24)
SEGMENT = 1 << 22


def winnow(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, first window, last window, hash, place) of each anchor; windows that share an anchor are consecutive."""
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    n = len(data) - GRAM + 1
    if n < STARTS:
        return none
    sums, inverse = prefix_sums(data)
    h = mix((sums[GRAM:] - sums[:-GRAM]) * inverse[:n])
    key = (h & ~((U64(1) << PLACE_BITS) - U64(1))) | np.arange(n, dtype=U64)
    size = -(-n // STARTS) * STARTS
    grid = np.full(size, np.iinfo(np.uint64).max, dtype=U64)
    grid[:n] = key
    grid = grid.reshape(-1, STARTS)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - STARTS + 1
    least = np.minimum(behind[:windows], ahead[STARTS - 1 : STARTS - 1 + windows])
    start = np.arange(windows)
    text = np.searchsorted(offsets, start, side="right") - 1
    inside = start + LONG <= offsets[text + 1]
    start, least, text = start[inside], least[inside], text[inside]
    if not len(start):
        return none
    heads = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (text[1:] != text[:-1])]))
    place = (least[heads] & ((U64(1) << PLACE_BITS) - U64(1))).astype(np.int64)
    last = np.append(heads[1:], len(start)) - 1
    return text[heads], start[heads], start[last], h[place].view(np.int64), place


def _segments(array: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of texts; one longer than SEGMENT bytes comes in pieces that together hold each window once."""
    for first, last, data, offsets in text_blocks(array):
        if len(data) <= SEGMENT:
            yield np.arange(first, last), np.zeros(last - first, np.int64), data, offsets
            continue
        for at in range(0, len(data), SEGMENT):
            piece = data[at : at + SEGMENT + LONG - 1]
            yield np.array([first]), np.array([at]), piece, np.array([0, len(piece)])


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column(ROW).to_numpy()
        for index, base, data, offsets in _segments(batch.column("text")):
            text, low, high, h, _ = winnow(data, offsets)
            move = base[text] - offsets[text] if len(text) else text
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(rows[index[text]]) if len(text) else pa.array([], pa.int64()), pa.array(low + move), pa.array(high + move)],
                names=["h", ROW, "low", "high"],
            )


REGIONS = f"h long, {ROW} long, start long, length long, c1 long, c2 long, anchors long, said binary"


def join_spans(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of the spans [low, high), as maximal spans; touching spans are joined."""
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    heads = np.flatnonzero(np.concatenate([[True], low[1:] > high[:-1]]))
    return low[heads], high[np.append(heads[1:], len(low)) - 1]


def _region_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Regions by anchor. The bytes come with the first of a class that a task meets."""
    seen: set[bytes] = set()
    for batch in batches:
        data, offsets = as_bytes(batch.column("text"))
        rows = batch.column(ROW).to_numpy()
        lists = batch.column("anchors")
        edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        flat = lists.flatten()
        h, low, high = (flat.field(n).to_numpy() for n in ("h", "low", "high"))
        out: list[tuple] = []
        held = 0
        for i in range(batch.num_rows):
            a, b = edges[i], edges[i + 1]
            own = data[offsets[i] : offsets[i + 1]].tobytes()
            order = a + np.lexsort((low[a:b], h[a:b]))
            heads = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1], [True]]))
            for x, y in zip(heads[:-1].tolist(), heads[1:].tolist()):
                part = order[x:y]
                for s, e in zip(*join_spans(low[part], high[part] + LONG)):
                    said = own[s:e]
                    digest = xxhash.xxh3_128_digest(said)
                    mark = digest + int(h[part[0]]).to_bytes(8, "little", signed=True)
                    fresh = mark not in seen
                    if fresh:
                        seen.add(mark)
                    c1, c2 = np.frombuffer(digest, dtype="<i8").tolist()
                    inside = int(np.searchsorted(low[part], e) - np.searchsorted(low[part], s))
                    out.append((int(h[part[0]]), int(rows[i]), int(s), int(e - s), c1, c2, inside, said if fresh else None))
                    held += len(said) * fresh
            if held > SEGMENT or len(out) > 50_000:
                yield _region_batch(out)
                out, held = [], 0
                if len(seen) > 500_000:  # what is sent twice is merged later
                    seen.clear()
        if out:
            yield _region_batch(out)


def _region_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.binary()]
    names = ["h", ROW, "start", "length", "c1", "c2", "anchors", "said"]
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=k) for c, k in zip(zip(*rows), kinds)], names=names)


class RunIndex:
    """Run-compressed transform of texts in groups: suffixes are compared within a group only."""

    def __init__(self, texts: list[bytes], groups: list[int]):
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        n = len(data)
        owner = np.repeat(np.arange(len(texts)), self.lengths)
        end = (self.starts + self.lengths)[owner]
        here = np.arange(n)
        self.data, self.end = data, end
        # The first seven symbols, 0 beyond the end; then doubling until the longest text is covered.
        padded = np.concatenate([data.astype(U64) + U64(1), np.zeros(7, U64)])
        key = np.zeros(n, dtype=U64)
        for i in range(7):
            key = (key << U64(9)) | np.where(here + i < end, padded[i : i + n], U64(0))
        rank = np.unique(key, return_inverse=True)[1]
        group = np.asarray(groups, dtype=np.int64)[owner]
        rank = np.unique(group * (n + 1) + rank, return_inverse=True)[1]
        self.levels, width = [(7, rank.astype(np.int32))], 7
        texts_n = len(texts)
        while width < self.lengths.max(initial=0):
            beyond = here + width >= end
            following = np.where(beyond, owner, texts_n + rank[np.minimum(here + width, n - 1)])
            rank = np.unique(rank * np.int64(n + texts_n + 1) + following, return_inverse=True)[1]
            width *= 2
            self.levels.append((width, rank.astype(np.int32)))
        suffix = np.argsort(rank, kind="stable")
        before = np.where(suffix == self.starts[owner[suffix]], 256 + owner[suffix], data[suffix - 1])
        same_group = group[suffix[1:]] == group[suffix[:-1]]
        turn = np.flatnonzero((before[1:] != before[:-1]) | ~same_group)  # a run ends at turn, the next begins after it
        # Samples: text places at run ends, with the match to the neighbour across the end.
        above, below = suffix[turn], suffix[turn + 1]
        match = np.where(same_group[turn], self._common(above, below), 0)
        self.run_ends = np.append(above, suffix[-1:]), np.append(match, 0)
        self.run_heads = np.append(below, suffix[:1]), np.append(match, 0)

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``a`` and ``b``."""
        n = len(self.data)
        a, b = a.copy(), b.copy()
        first, end_a, end_b = a.copy(), self.end[a], self.end[b]
        for width, rank in reversed(self.levels):
            alive = (a < end_a) & (b < end_b)
            equal = alive & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
            a[equal] += width
            b[equal] += width
        for _ in range(6):
            alive = (a < end_a) & (b < end_b)
            equal = alive & (self.data[np.minimum(a, n - 1)] == self.data[np.minimum(b, n - 1)])
            a[equal] += 1
            b[equal] += 1
        return np.minimum(a, end_a) - first

    def matching_statistics(self) -> np.ndarray:
        """For each place, the longest match with a suffix of its group that starts elsewhere."""
        n = len(self.data)
        best = np.zeros(n, dtype=np.int64)
        for places, lengths in (self.run_heads, self.run_ends):
            value = np.zeros(n, dtype=np.int64)
            value[places] = lengths
            sampled = np.zeros(n, dtype=np.int64)
            sampled[places] = places
            last = np.maximum.accumulate(sampled)
            best = np.maximum(best, value[last] - (np.arange(n) - last))
        return best


def long_matches(texts: list[bytes], groups: list[int], least: int = LONG) -> list[list[tuple[int, int]]]:
    """For each text, the spans covered by strings of ``least`` bytes that start elsewhere in its group too."""
    index = RunIndex(texts, groups)
    at = np.flatnonzero(index.matching_statistics() >= least)
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    if len(at):
        owner = np.searchsorted(index.starts, at, side="right") - 1
        for t in np.unique(owner).tolist():
            low = at[owner == t] - index.starts[t]
            spans[t] = list(zip(*(x.tolist() for x in join_spans(low, low + least))))
    return spans


SPANS = "h long, c1 long, c2 long, low long, high long"


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["h", "c1", "c2", "low", "high"])


def _index_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans found by index. Regions come sorted by anchor and class; several whole groups share an index.

    A group of one class that holds its anchor once has nothing to find. A group of more
    than HOT_BYTES is let go as it grows, and told by a row with spans below zero.
    """
    marks: list[tuple] = []
    texts: list[bytes] = []
    size = 0
    group: list[tuple[tuple, bytes]] = []  # the group that is being read
    held, repeats, hot, last = 0, False, False, None

    def settle() -> pa.RecordBatch:
        numbers: dict[int, int] = {}
        found = long_matches(texts, [numbers.setdefault(m[0], len(numbers)) for m in marks])
        return _span_batch([(*marks[i], a, b) for i, own in enumerate(found) for a, b in own])

    def close() -> Iterator[pa.RecordBatch]:
        nonlocal marks, texts, size, group, held, repeats, hot
        if hot:
            yield _span_batch([(last[0], 0, 0, -1, -1)])
        elif len(group) > 1 or repeats:
            marks += [m for m, _ in group]
            texts += [t for _, t in group]
            size += held
        group, held, repeats, hot = [], 0, False, False
        if size > INDEX_BYTES:
            yield settle()
            marks, texts, size = [], [], 0

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("h", "c1", "c2", "anchors", "said")]
        for h, c1, c2, anchors, said in zip(*columns):
            mark = (h, c1, c2)
            if mark == last:
                repeats = repeats or anchors > 1
                continue
            if last is not None and h != last[0]:
                yield from close()
            last = mark
            repeats = repeats or anchors > 1
            held += len(said)
            hot = hot or held > HOT_BYTES
            if hot:
                group = []
            else:
                group.append((mark, said))
    if last is not None:
        yield from close()
    if marks:
        yield settle()


ZONE_ROWS = "h long, c1 long, c2 long, low long, high long, zone int, core1 long, core2 long, whole1 long, whole2 long"


def _windows(said: bytes) -> Iterator[tuple[int, int, int, int]]:
    """(first window, last window, hash, place) of each anchor of a region of any length."""
    for at in range(0, len(said), SEGMENT):
        data = np.frombuffer(said[at : at + SEGMENT + LONG - 1], dtype=np.uint8)
        _, low, high, h, place = winnow(data, np.array([0, len(data)]))
        yield from zip((low + at).tolist(), (high + at).tolist(), h.tolist(), (place + at).tolist())


def _zone_batches(size: int):
    """Zones of ``size`` window starts. The region's windows are found again; ``low`` and ``high`` bound the starts asked for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            names = ("h", "c1", "c2", "asked_low", "asked_high", "said")
            for h, c1, c2, asked_low, asked_high, said in zip(*[batch.column(n).to_pylist() for n in names]):
                for a, b, own, p in _windows(said):
                    a, b = max(a, asked_low), min(b, asked_high)
                    if own != h or a > b:
                        continue
                    # Zones lie on one grid around the anchor, so that classes can be compared.
                    origin = p - (STARTS - 1)
                    for z in range((a - origin) // size, (b - origin) // size + 1):
                        zl, zh = origin + z * size, origin + z * size + size - 1
                        x, y = max(a, zl), min(b, zh)
                        core = xxhash.xxh3_128_digest(said[zh : zl + LONG])
                        # All the zone's bytes, where this region has all of them.
                        full = x == zl and y == zh
                        whole = xxhash.xxh3_128_digest(said[zl : zh + LONG]) if full else b""
                        k1, k2 = np.frombuffer(core, "<i8").tolist()
                        w1, w2 = np.frombuffer(whole, "<i8").tolist() if full else (None, None)
                        out.append((h, c1, c2, x, y, z, k1, k2, w1, w2))
            kinds = [pa.int64()] * 5 + [pa.int32()] + [pa.int64()] * 4
            columns = zip(*out) if out else [[]] * 10
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                names=["h", "c1", "c2", "low", "high", "zone", "core1", "core2", "whole1", "whole2"],
            )

    return cut


def hot_spans(classes: DataFrame) -> DataFrame:
    """Covered spans of the classes (h, c1, c2, said) of hot groups, by zones."""
    asked = classes.withColumn("asked_low", F.lit(0).cast("long")).withColumn("asked_high", F.length("said").cast("long") - LONG)
    settled = None
    for size in ZONES:
        zones = materialise(
            asked.select("h", "c1", "c2", "asked_low", "asked_high", "said").mapInArrow(_zone_batches(size), ZONE_ROWS)
        )
        core = ["h", "zone", "core1", "core2"]
        shared = zones.groupBy(*core).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        left = zones.join(shared, core, "left_semi")
        whole = ["h", "zone", "whole1", "whole2"]
        equal = left.filter("whole1 is not null").groupBy(*whole).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        done = left.join(equal, whole, "left_semi").select("h", "c1", "c2", "low", (F.col("high") + LONG).alias("high"))
        settled = done if settled is None else settled.unionByName(done)
        if size > 1:
            # Settled zones go on too: parts of them may equal parts of zones that are not.
            open_zones = left.select("h", "c1", "c2", F.col("low").alias("asked_low"), F.col("high").alias("asked_high"))
            asked = classes.join(open_zones, ["h", "c1", "c2"])
    return settled


def _final_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = as_bytes(batch.column("text"))
        lists = batch.column("spans")
        edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        flat = lists.flatten()
        low, high = flat.field("low").to_numpy(), flat.field("high").to_numpy()
        removed, spans, digests, kept = [], [], [], []
        for i in range(batch.num_rows):
            own = data[offsets[i] : offsets[i + 1]].tobytes()
            a, b = join_spans(low[edges[i] : edges[i + 1]], high[edges[i] : edges[i + 1]])
            parts = [own[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(own)])]
            rest = b"".join(parts)
            removed.append(len(own) - len(rest))
            spans.append(list(map(list, zip(a.tolist(), b.tolist()))))
            digests.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(batch.column(ROW)), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                pa.array(digests, pa.string()), pa.array(kept, pa.binary()),
            ],
            names=["_r", "n_removed", "removed", "sha", "kept"],
        )


def repeated_spans(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts, spans) of written rows (_row, text): _row and text of the documents with repeated anchors, and _row, low, high of covered bytes."""
    rows = rows.select(ROW, "text").filter(F.octet_length("text") >= LONG)
    anchors = materialise(rows.mapInArrow(_anchor_batches, f"h long, {ROW} long, low long, high long"))
    twice = anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    hits = anchors.join(twice, "h", "left_semi")
    own = hits.groupBy(F.col(ROW).alias("_r")).agg(F.collect_list(F.struct("h", "low", "high")).alias("anchors"))
    texts = materialise(rows.join(own, F.col(ROW) == F.col("_r")).drop("_r"))
    regions = materialise(texts.mapInArrow(_region_batches, REGIONS))

    key = ["h", "c1", "c2"]
    several = regions.filter("said is not null").select(*key, "anchors", "said")
    indexed = several.repartition("h").sortWithinPartitions(*key).mapInArrow(_index_batches, SPANS)
    found = materialise(indexed)
    if found.filter("low < 0").limit(1).count():
        hot = several.join(found.filter("low < 0").select("h").distinct(), "h", "left_semi")
        hot = materialise(hot.groupBy(*key).agg(F.max("said").alias("said")))
        found = found.filter("low >= 0").unionByName(hot_spans(hot))

    counts = regions.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    slim = regions.select(*key, ROW, "start", "length")
    single = slim.join(found, key).select(ROW, (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high"))
    copied = counts.filter("copies > 1").select(*key)
    whole = slim.join(copied, key, "left_semi").select(ROW, F.col("start").alias("low"), (F.col("start") + F.col("length")).alias("high"))
    return texts.select(ROW, "text"), single.unionByName(whole)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(_row, doc_id, n_bytes, n_removed, removed, kept_sha256, kept) for every document.

    ``removed`` lists the maximal removed spans; ``kept`` holds the remaining bytes where
    any were removed, else NULL.
    """
    # Written once: another scan of the documents may number them otherwise.
    rows = materialise(with_row(docs, "doc_id", F.col("text").cast("string").alias("text")))
    texts, spans = repeated_spans(rows)
    own = spans.groupBy(F.col(ROW).alias("_s")).agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    changed = texts.join(own, F.col(ROW) == F.col("_s")).select(ROW, "text", "spans")
    changed = changed.mapInArrow(
        _final_batches, "_r long, n_removed long, removed array<array<long>>, sha string, kept binary"
    )
    text = F.coalesce("text", F.lit(""))
    plain = rows.select(ROW, "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("full"))
    joined = plain.join(changed, F.col(ROW) == F.col("_r"), "left")
    return joined.select(
        ROW, "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<array<long>>")).alias("removed"),
        F.coalesce("sha", "full").alias("kept_sha256"), "kept",
    )
