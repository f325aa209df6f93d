"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Fingerprints that differ in at most 3 bits differ in at most 3 of their 8 bytes, so
they share at least 5 positional bytes: that is the guaranteed minimum of the count
filter. An index on single bytes would list a 256th of all fingerprints under one
posting, so a posting holds three bytes of one half: of 5 shared bytes at least 3
stand in the first or in the last four positions, and 8 postings (4 choices of three
bytes in each half) meet every such pair. Within a posting the shared positional
bytes of each pair are tallied, pairs with 5 or more are kept and their bits compared.

Only distinct fingerprints are indexed, so copies never meet each other. A posting
gives one link for each member that is connected, to the least member it reaches
there, never all its pairs. A posting
with more members than ``PAIRWISE`` is not compared pair by pair: each member looks up
every fingerprint within 3 bits that shares the posting's bytes, so the work is in
proportion to the members. Links become components by alternating star contraction,
with each round written to the shared folder.

Rows whose text is NULL or empty have fingerprint zero and are linked like any other.
Equal rows get equal fingerprints and share a component. A component whose doc_ids are
all NULL has a NULL id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerbooks.llm.common import LOWER, ROW, SOLID, U64, numbered, numbered_in_files, one_blank_apart, spread, text_blocks, with_row, word_spans
from sellerbooks.session import materialise

SEED = 42
SHINGLE = 3
BITS = 3
LEAST_SHARED = 5
#: The three byte positions of each posting: all choices within a half.
POSTINGS = tuple(c for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for c in combinations(half, 3))
#: Postings up to this size are compared pair by pair, larger ones by looking up neighbours.
PAIRWISE = 2048
#: The primes of XXH64.
P1, P2, P3, P4, P5 = (
    U64(11400714785074694791),
    U64(14029467366897019727),
    U64(1609587929392839161),
    U64(9650029242287828579),
    U64(2870177450012600261),
)


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << U64(r)) | (x >> U64(64 - r))


def xxh64_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of each span of bytes; spans under 32 bytes all at once."""
    lengths = ends - starts
    out = np.empty(len(starts), dtype=U64)
    long = np.flatnonzero(lengths >= 32)
    raw = memoryview(np.ascontiguousarray(data))
    for i in long.tolist():
        out[i] = xxhash.xxh64_intdigest(raw[starts[i] : ends[i]], seed)
    short = np.flatnonzero(lengths < 32)
    if not len(short):
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    fours = np.ndarray((len(data) + 1,), dtype="<u4", buffer=padded, strides=(1,))
    at, left = starts[short], lengths[short]
    h = left.astype(U64) + (U64(seed) + P5)
    for _ in range(3):
        on = np.flatnonzero(left >= 8)
        if not len(on):
            break
        k = _rotl(eights[at[on]] * P2, 31) * P1
        h[on] = _rotl(h[on] ^ k, 27) * P1 + P4
        at[on] += 8
        left[on] -= 8
    on = np.flatnonzero(left >= 4)
    h[on] = _rotl(h[on] ^ (fours[at[on]].astype(U64) * P1), 23) * P2 + P3
    at[on] += 4
    left[on] -= 4
    for _ in range(3):
        on = np.flatnonzero(left >= 1)
        h[on] = _rotl(h[on] ^ (padded[at[on]].astype(U64) * P5), 11) * P1
        at[on] += 1
        left[on] -= 1
    h = (h ^ (h >> U64(33))) * P2
    h = (h ^ (h >> U64(29))) * P3
    out[short] = h ^ (h >> U64(32))
    return out


def fingerprints(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """The 64-bit fingerprint of each text of a block."""
    docs = len(offsets) - 1
    result = np.zeros(docs, dtype=U64)
    lowered = LOWER[data]
    starts, ends, owner = word_spans(lowered, offsets, SOLID)
    if not len(starts):
        return result
    packed, starts, last = one_blank_apart(lowered, starts, ends, SOLID)
    words = np.bincount(owner, minlength=docs)
    first_word = np.concatenate([[0], np.cumsum(words)[:-1]])
    # A shingle for each word that has enough words after it, or the whole of a shorter text.
    rank = np.arange(len(owner)) - first_word[owner]
    width = np.minimum(size, words[owner])
    heads = np.flatnonzero(rank + width <= words[owner])
    heads = heads[(words[owner[heads]] >= size) | (rank[heads] == 0)]
    hashes = xxh64_spans(packed, starts[heads], last[heads + width[heads] - 1])
    count = np.bincount(owner[heads], minlength=docs)
    present = np.flatnonzero(count)
    firsts = np.concatenate([[0], np.cumsum(count[present])[:-1]])
    for low in range(0, len(present), 512):  # bounds the unpacked bits
        own = present[low : low + 512]
        a, b = firsts[low], firsts[low] + count[own].sum()
        part = firsts[low : low + 512] - a
        ones = np.zeros((len(own), 64), dtype=np.int64)
        for cut in range(a, b, 1 << 16):
            piece = hashes[cut : min(cut + (1 << 16), b)]
            bits = np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            lo = np.searchsorted(part, cut - a, side="right") - 1
            hi = np.searchsorted(part, cut - a + len(piece), side="left")
            heads_here = np.maximum(part[lo:hi] - (cut - a), 0)
            ones[lo:hi] += np.add.reduceat(bits, heads_here, axis=0, dtype=np.int32)
        set_bits = (2 * ones > count[own][:, None]).astype(np.uint8)
        result[own] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return result


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprints(data, offsets) for _, _, data, offsets in text_blocks(batch.column("text"))]
        values = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(ROW), batch.column("doc_id"), pa.array(values, pa.int64())], names=[ROW, "doc_id", "fp"]
        )


def fingerprint_rows(docs: DataFrame) -> DataFrame:
    """(_row, doc_id, fp): one fingerprint for each document, as a signed 64-bit number."""
    return _fingerprints(with_row(docs, *_hashed()))


def _hashed(own: str = "") -> list[Column]:
    return [F.col(f"{own}doc_id").cast("long").alias("doc_id"), F.col(f"{own}text").cast("string").alias("text")]


def _fingerprints(rows: DataFrame) -> DataFrame:
    return rows.mapInArrow(_fingerprint_batches, f"{ROW} long, doc_id long, fp long")


@lru_cache(maxsize=4)
def _flips(free: tuple[int, ...], most: int) -> np.ndarray:
    """All masks of one to ``most`` bits inside the given byte positions."""
    bits = [8 * p + i for p in free for i in range(8)]
    masks = [sum(1 << b for b in c) for n in range(1, most + 1) for c in combinations(bits, n)]
    return np.array(masks, dtype=U64)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each one's component among n members linked by (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def posting_links(values: np.ndarray, shared: tuple[int, ...], most: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links from each of a posting's distinct, sorted fingerprints to the least one it is connected with there."""
    n = len(values)
    left, right = [], []
    if n <= PAIRWISE:
        octets = values.view(np.uint8).reshape(n, 8)
        step = max(1, (1 << 20) // n)
        for low in range(0, n, step):
            part = values[low : low + step]
            tally = np.zeros((len(part), n), dtype=np.uint8)
            for p in range(8):
                tally += octets[low : low + step, p][:, None] == octets[:, p][None, :]
            i, j = np.nonzero(tally >= LEAST_SHARED)
            i += low
            near = (i < j) & (np.bitwise_count(values[i] ^ values[j]) <= most)
            left.append(i[near])
            right.append(j[near])
    else:
        free = tuple(p for p in range(8) if p not in shared)
        for mask in _flips(free, most):
            wanted = values ^ mask
            place = np.searchsorted(values, wanted)
            place[place == n] = 0
            i = np.flatnonzero((values[place] == wanted) & (wanted > values))
            left.append(i)
            right.append(place[i])
    a, b = np.concatenate(left), np.concatenate(right)
    root = _roots(n, a, b)
    own = np.flatnonzero(root != np.arange(n))
    return values[own], values[root[own]]


def _posting_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by posting; a posting may go on in the next batch."""
    kept_slot = kept_key = kept_fp = None

    def links(slot, key, fp):
        cuts = np.flatnonzero((slot[1:] != slot[:-1]) | (key[1:] != key[:-1])) + 1
        heads = np.concatenate([[0], cuts, [len(slot)]])
        many = np.flatnonzero(np.diff(heads) > 1)
        left, right = [], []
        for m in many.tolist():
            a, b = posting_links(np.unique(fp[heads[m] : heads[m + 1]]), POSTINGS[slot[heads[m]]])
            left.append(a)
            right.append(b)
        if left:
            a, b = np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["u", "v"])

    for batch in batches:
        slot = batch.column("slot").to_numpy(zero_copy_only=False)
        key = batch.column("key").to_numpy(zero_copy_only=False)
        fp = batch.column("fp").to_numpy(zero_copy_only=False).view(U64)
        if kept_slot is not None:
            slot, key, fp = np.concatenate([kept_slot, slot]), np.concatenate([kept_key, key]), np.concatenate([kept_fp, fp])
        if not len(slot):
            continue
        same = (slot == slot[-1]) & (key == key[-1])
        cut = len(slot) - int(np.argmin(same[::-1])) if not same.all() else 0
        yield from links(slot[:cut], key[:cut], fp[:cut]) if cut else ()
        kept_slot, kept_key, kept_fp = slot[cut:].copy(), key[cut:].copy(), fp[cut:].copy()
    if kept_slot is not None and len(kept_slot):
        yield from links(kept_slot, kept_key, kept_fp)


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """(u, v): links that connect every two distinct fingerprints (column fp) within 3 bits of each other."""
    fp = F.col("fp")
    # One number for the posting's three bytes, the bytes at POSTINGS[slot].
    keys = [
        sum((F.shiftrightunsigned(fp, 8 * p).bitwiseAND(F.lit(255)) * (1 << (8 * i)) for i, p in enumerate(places)), F.lit(0))
        for places in POSTINGS
    ]
    slots = F.array(*[F.struct(F.lit(i).alias("slot"), k.cast("long").alias("key")) for i, k in enumerate(keys)])
    postings = distinct.select("fp", F.explode(slots).alias("p")).select("p.slot", "p.key", "fp")
    spread = postings.repartition("slot", "key").sortWithinPartitions("slot", "key")
    return spread.mapInArrow(_posting_batches, "u long, v long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links``: alternating large and small stars until nothing changes."""
    edges = materialise(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).withColumnRenamed("u", "c")
        large = both.join(least, F.col("u") == F.col("c")).filter("v > c").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "c")
        small = large.join(below, F.col("u") == F.col("c"))
        small = small.select(F.greatest("v", "m").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = materialise(small.unionByName(below.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
        if now == state:
            break
        state = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(_row, doc_id, fp, root, component_id) for every document; root is the component's least fingerprint."""
    return _grouped(materialise(fingerprint_rows(docs)))


def _grouped(rows: DataFrame) -> DataFrame:
    """Each of the rows (_row, doc_id, fp) with its root and component_id."""
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(fingerprint_links(distinct))
    named = distinct.join(roots, F.col("fp") == F.col("node"), "left")
    named = named.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    member = named.join(ids, "root").select(F.col("fp").alias("_fp"), "root", "component_id")
    return rows.join(member, F.col("fp") == F.col("_fp")).drop("_fp")


def one_of_each_group(docs: DataFrame, in_files: bool = False) -> DataFrame:
    """The documents with the smallest doc_id of their component; of equal doc_ids, the first row.

    ``in_files``: the documents are read from Parquet files as they lie there.
    """
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", ROW)
    rows = numbered_in_files(docs) if in_files else materialise(numbered(docs))
    marked = materialise(_fingerprints(rows.select(ROW, *_hashed("doc."))))
    first = _grouped(marked).groupBy("root").agg(F.min(order).alias("f"))
    kept = first.select(F.col(f"f.{ROW}").alias("_kept"))
    rows = rows.join(kept, F.col(ROW) == F.col("_kept"), "left_semi")
    return rows.select(*spread(rows, docs.columns))
