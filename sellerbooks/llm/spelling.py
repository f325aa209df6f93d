"""Spelling variants: words one code point apart, and the frequent form each rare one goes back to.

Words are runs of Latin letters, counted over the whole corpus by built-in functions. Two
words one insertion, deletion or replacement apart differ little in how many letters of each
group they have: an insertion adds one to one group, a replacement moves one from a group to
another or none. A trie holds the words by length and then by the counts of ``GROUPS`` letter
groups, level by level; a word is looked up by depth-first search that may spend one surplus
and one deficit on the way down, and the words of the leaves it reaches are compared with it
letter by letter.

The trie's top (length and the first ``depth`` counts) is the shuffle key: a word goes to its
own branch as a member and to every branch its budget can reach as a query. Each pair is
searched from one side only: the shorter word, or the one with fewer letters in the first
group that differs, or the smaller word of two with equal counts. Branches with more than
``MEMBERS`` words or ``QUERIES`` look-ups are dealt in blocks, every query block against every
member block, so a task holds one block, whatever branch holds most words. ``depth`` follows
the number of words, so that branches stay about as large; results do not depend on it.

Defined cases: a NULL text has no words; a NULL id counts as empty text in the hash; very
long texts and words are taken whole; equal rows are documents of their own, with the same
hashes; of near words with equal counts the smallest in code-point order is the form; an
empty table gives an empty result; only the id and the text are read, so columns of any name
cannot clash.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerbooks.llm.common import MIX_A, U64, as_bytes, mix
from sellerbooks.session import materialise

# What a word is, which of its occurrences lose a letter, and when a word is rare beside a near one.
LETTERS = "[A-Za-zÀ-ÿ]+"
EVERY, LEAST_LETTERS, LEAST_COUNT, RATIO = 31, 7, 2, 10
GROUPS = 16
#: Order of the levels: groups (code point modulo 16) with frequent letters first.
LEVELS = (5, 1, 4, 9, 14, 15, 2, 3, 12, 0, 13, 7, 8, 6, 10, 11)
MEMBERS, QUERIES = 100_000, 400_000
#: Words a branch has on average before the key takes in another level.
PER_BRANCH = 2_000
#: Bounds of memory: open paths of a search, candidate pairs of its leaves, and letters of padded pairs at a time.
FRONTIER = 1 << 18
PAIR_BYTES = 1 << 21
#: Doublings of the way from a word to its root: counts grow tenfold a step, so 2 ** 5 steps are more than 64 bits hold.
DOUBLINGS = 5


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the words of the corpus with their number of occurrences."""
    runs = docs.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(LETTERS), F.lit(0))).alias("run"),
    )
    upper = "".join(map(chr, range(65, 91)))
    lowered = runs.filter(F.length("run") >= LEAST_LETTERS).select("id", F.translate("run", upper, upper.lower()).alias("run"))
    hashed = lowered.select("run", F.crc32(F.concat_ws(":", "id", "run")).alias("h"))
    gone = F.pmod("h", F.length("run").cast("bigint")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), gone), F.substring("run", gone + 2, F.length("run")))
    said = hashed.select(F.when(F.col("h") % EVERY == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = said.filter(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words as one byte per code point, and their n + 1 offsets; all letters are below 256."""
    data, offsets = as_bytes(column)
    data = data[offsets[0] : offsets[-1]]
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)]).astype(np.int64)
    return np.frombuffer(data.tobytes().decode("utf-8").encode("latin-1"), np.uint8), lead[offsets - offsets[0]]


def profiles(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row a word: its length, then its letters in each group, in the order of the levels."""
    n, lengths = len(offsets) - 1, np.diff(offsets)
    level_of = np.empty(GROUPS, np.int64)
    level_of[list(LEVELS)] = np.arange(GROUPS)
    cells = np.repeat(np.arange(n) * GROUPS, lengths) + level_of[data % GROUPS]
    counts = np.bincount(cells, minlength=n * GROUPS).reshape(n, GROUPS)
    return np.concatenate([lengths[:, None], counts], axis=1).astype(np.int64)


def _branch(prefix: np.ndarray) -> np.ndarray:
    """A 64-bit number of a top of the trie; tops that share one only share a task."""
    h = np.zeros(len(prefix), U64)
    for column in prefix.T:
        h = mix(h * U64(MIX_A | 1) + column.astype(U64) + U64(1))
    return h.view(np.int64)


def _steps(depth: int) -> list[tuple[int, np.ndarray]]:
    """(extra length, changes of the first counts) of every top a query may have to look into."""
    found = []
    for up in (None, *range(depth)):
        change = np.zeros(depth, np.int64)
        if up is not None:
            change[up] += 1
        found.append((1, change))
        for down in range(depth):
            if up is None or down < up:
                other = change.copy()
                other[down] -= 1
                found.append((0, other))
    found.append((0, np.zeros(depth, np.int64)))
    return found


def routes(table: DataFrame, depth: int, with_words: bool) -> DataFrame:
    """(branch, role, word, n): role 0 for the member, 1 for a query; without the words only what is counted."""
    steps = _steps(depth)
    schema = "branch bigint, role int" + (", word string, n bigint" if with_words else "")

    def each(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            top = profiles(*_letters(batch.column(0)))[:, : depth + 1]
            index = np.arange(len(top))
            for role, extra, change in [(0, 0, None), *[(1, e, c) for e, c in steps]]:
                wanted, rows = top, index
                if change is not None:
                    wanted = top + np.concatenate([[extra], change])
                    able = (wanted >= 0).all(axis=1)
                    wanted, rows = wanted[able], index[able]
                columns = [pa.array(_branch(wanted), pa.int64()), pa.array(np.full(len(rows), role, np.int32))]
                if with_words:
                    columns += [batch.column(c).take(pa.array(rows)) for c in range(2)]
                yield pa.RecordBatch.from_arrays(columns, ["branch", "role", "word", "n"][: len(columns)])

    return table.select("word", "n").mapInArrow(each, schema)


class Trie:
    """Words by block, length and letter-group counts; a level is the sorted array of (parent, count) of its nodes."""

    def __init__(self, block: np.ndarray, vectors: np.ndarray):
        self.blocks, block = np.unique(block, return_inverse=True)
        columns = [block, *vectors.T]
        self.order = np.lexsort(columns[::-1])
        node = np.zeros(len(block), np.int64)
        self.levels = []
        for column in columns:
            key = (node << 32) | column[self.order]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            self.levels.append(key[new])
            node = np.cumsum(new) - 1
        self.leaf_at = np.append(np.flatnonzero(new), len(key)) if len(key) else np.zeros(1, np.int64)

    def _child(self, level: int, node: np.ndarray, count: np.ndarray) -> np.ndarray:
        keys, wanted = self.levels[level], (node << 32) | count
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where((keys[at] == wanted) & (count >= 0), at, -1)

    def search(self, block: np.ndarray, vectors: np.ndarray, longer: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, member) pairs of the leaves in reach, in bounded chunks; ``longer`` members have one letter more."""
        at = np.minimum(np.searchsorted(self.blocks, block), len(self.blocks) - 1)
        known = np.flatnonzero(self.blocks[at] == block)
        root = self._child(0, np.zeros(len(known), np.int64), at[known])
        node = self._child(1, root, vectors[known, 0] + longer[known])
        there = node >= 0
        query, node = known[there], node[there]
        free = np.zeros(len(query), np.int8)
        stack = [(2, query, node, free, free.copy())]
        while stack:
            level, query, node, up, down = stack.pop()
            if len(query) > FRONTIER:
                half = len(query) // 2
                stack.append((level, query[half:], node[half:], up[half:], down[half:]))
                stack.append((level, query[:half], node[:half], up[:half], down[:half]))
                continue
            if level == len(self.levels):
                ended = up == np.where(longer[query], 1, down)
                yield from self._leaves(query[ended], node[ended])
                continue
            count = vectors[query, level - 1]
            parts = []
            for change, may in (
                (0, np.ones(len(query), bool)),
                (-1, ~longer[query] & (down == 0) & (up == 0)),
                (1, (up == 0) & (longer[query] | (down == 1))),
            ):
                i = np.flatnonzero(may)
                child = self._child(level, node[i], count[i] + change)
                hit = child >= 0
                i = i[hit]
                parts.append((query[i], child[hit], up[i] + np.int8(change > 0), down[i] + np.int8(change < 0)))
            grown = [np.concatenate(c) for c in zip(*parts)]
            if len(grown[0]):
                stack.append((level + 1, *grown))

    def _leaves(self, query: np.ndarray, leaf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        sizes = np.diff(self.leaf_at)[leaf]
        done = 0
        while done < len(query):
            most = np.searchsorted(np.cumsum(sizes[done:]), FRONTIER, side="right")
            last = done + max(int(most), 1)
            some, first = sizes[done:last], self.leaf_at[leaf[done:last]]
            before = np.cumsum(some) - some
            member = np.arange(int(some.sum())) - np.repeat(before - first, some)
            yield np.repeat(query[done:last], some), self.order[member]
            done = last


def one_apart(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of words are one letter apart; ``b`` is as long as ``a`` or one longer."""
    right = np.zeros(len(a), bool)
    order = np.argsort(lengths[b], kind="stable")
    done = 0
    while done < len(order):
        # As many pairs as fit, all padded to the longest of them.
        widths = lengths[b[order[done : done + PAIR_BYTES // 8]]]
        fit = np.searchsorted(widths * np.arange(1, len(widths) + 1), PAIR_BYTES, side="right")
        some = order[done : done + max(int(fit), 1)]
        done += len(some)
        right[some] = _one_apart(data, starts, lengths, a[some], b[some])
    return right


def _one_apart(data, starts, lengths, a, b):
    width = int(lengths[b].max())
    columns = np.arange(width)
    padded = lambda w: np.where(
        columns < lengths[w][:, None], data[np.minimum(starts[w][:, None] + columns, len(data) - 1)], 0
    )
    x, y = padded(a), padded(b)
    differ = x != y
    replaced = (lengths[a] == lengths[b]) & (differ.sum(axis=1) == 1)
    # One letter more: equal up to the first difference, and shifted by one from there on.
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    after = x[:, :-1] != y[:, 1:]
    after &= columns[:-1] >= first[:, None]
    return replaced | ((lengths[b] == lengths[a] + 1) & ~after.any(axis=1))


def _near_in(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Near pairs, in both directions, of the members and queries of whole blocks."""
    role = table.column("role").to_numpy()
    block = table.column("block").to_numpy()
    is_member = np.flatnonzero(role == 0)
    is_query = np.flatnonzero(role == 1)
    if not len(is_member) or not len(is_query):
        return
    said, n = table.column("word").combine_chunks(), table.column("n").combine_chunks()
    data, offsets = _letters(said)
    vectors, starts, lengths = profiles(data, offsets), offsets[:-1], np.diff(offsets)
    trie = Trie(block[is_member], vectors[is_member])
    # A query row is for one branch; which of the two lengths that is shows in the branch, so both are tried.
    for extra in (False, True):
        longer = np.full(len(is_query), extra)
        for q, m in trie.search(block[is_query], vectors[is_query], longer):
            q, m = is_query[q], is_member[m]
            if not extra:
                # Words with equal counts meet from both sides: the smaller row of letters looks up the larger.
                same = (vectors[q] == vectors[m]).all(axis=1)
                keep = ~same
                if same.any():
                    i = np.flatnonzero(same)
                    left, right = said.take(pa.array(q[i])).to_pylist(), said.take(pa.array(m[i])).to_pylist()
                    keep[i] = [x < y for x, y in zip(left, right)]
                q, m = q[keep], m[keep]
            good = one_apart(data, starts, lengths, q, m) if len(q) else np.zeros(0, bool)
            q, m = q[good], m[good]
            for a, b in ((q, m), (m, q)):
                if len(a):
                    columns = [said.take(pa.array(a)), said.take(pa.array(b)), n.take(pa.array(b))]
                    yield pa.RecordBatch.from_arrays(columns, ["word", "near", "near_n"])


def near_pairs(table: DataFrame) -> DataFrame:
    """(word, near, near_n): every word with every word one letter apart. ``table`` is read more than once: write it first."""
    # One row: how many words there are decides how far down the trie the key goes.
    count = table.count()
    depth = 1
    while count > PER_BRANCH * 20 * 4**depth and depth < GROUPS:
        depth += 1
    sizes = routes(table, depth, False).groupBy("branch").agg(
        F.count_if(F.col("role") == 0).alias("members"), F.count_if(F.col("role") == 1).alias("queries")
    )
    shares = sizes.filter("members > 0").select(
        F.col("branch").alias("_b"),
        F.ceil(F.col("members") / MEMBERS).cast("int").alias("_members"),
        F.ceil(F.col("queries") / QUERIES).cast("int").alias("_queries"),
    )
    # Spark sizes the routes as the words they come from, of which each gives dozens: never broadcast them.
    rows = routes(table, depth, True).hint("merge").join(shares, F.col("branch") == F.col("_b"))
    member = F.col("role") == 0
    own = F.when(member, F.pmod(F.xxhash64("word"), F.col("_members"))).otherwise(F.pmod(F.xxhash64("word"), F.col("_queries")))
    others = F.when(member, F.col("_queries")).otherwise(F.col("_members"))
    dealt = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.greatest(others, F.lit(1)) - 1)))
    pair = F.when(member, F.struct(own.cast("int").alias("m"), F.col("_other").alias("q"))).otherwise(
        F.struct(F.col("_other").alias("m"), own.cast("int").alias("q"))
    )
    blocks = dealt.select(F.xxhash64("branch", pair).alias("block"), "role", "word", "n")
    sorted_blocks = blocks.repartition("block").sortWithinPartitions("block")

    def each(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < MEMBERS:
                continue
            # Whole blocks go on; the last one may continue in the next batch.
            table = pa.Table.from_batches(held)
            keys = table.column("block").to_numpy()
            last = int(np.searchsorted(keys, keys[-1]))
            if last:
                yield from _near_in(table.slice(0, last))
            rest = table.slice(last)
            held, size = rest.to_batches(), 0 if last else size // 2
        if held:
            yield from _near_in(pa.Table.from_batches(held))

    return sorted_blocks.mapInArrow(each, "word string, near string, near_n bigint")


def forms(table: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n): each word with its near words' number and the most frequent if ten times as frequent."""
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    found = near_pairs(table).groupBy(F.col("word").alias("_w")).agg(F.count(F.lit(1)).alias("_near"), best.alias("_best"))
    rows = table.join(found, F.col("word") == F.col("_w"), "left")
    often = -F.col("_best.less") >= F.col("n") * RATIO
    return rows.select(
        "word",
        "n",
        F.coalesce("_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(often, F.col("_best.form")).alias("form"),
        F.when(often, -F.col("_best.less")).cast("bigint").alias("form_n"),
    )


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root): one row per word; ``root`` is where the forms lead, itself without a form."""
    found = materialise(forms(materialise(words(docs, doc_id, text))))
    # Counts grow tenfold a step, so ways are short; each round doubles the part of the way that is known.
    way = materialise(found.filter("form is not null").select("word", F.col("form").alias("root")))
    for _ in range(DOUBLINGS):
        on = way.select(F.col("word").alias("_w"), F.col("root").alias("_next"))
        # Packed words are several times larger in memory, and each round would leave a broadcast behind.
        longer = way.join(on.hint("merge"), F.col("root") == F.col("_w"), "left")
        moved = materialise(longer.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")))
        if moved.filter("moved").isEmpty():
            break
        way = moved.select("word", "root")
    ends = way.select(F.col("word").alias("_w"), F.col("root").alias("_root"))
    rows = found.join(ends.hint("merge"), F.col("word") == F.col("_w"), "left")
    return rows.select(*found.columns, F.coalesce("_root", "word").alias("root"))


def brute_force(documents: list[tuple]) -> list[tuple]:
    """(word, n, n_near, form, form_n, root) by comparing all words, for the tests."""
    import re

    counts: Counter = Counter()
    for doc_id, text in documents:
        for run in re.findall(LETTERS, text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % EVERY == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    kept = {w: n for w, n in counts.items() if len(w) >= LEAST_LETTERS and n >= LEAST_COUNT}

    def apart(a: str, b: str) -> bool:
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near = {w: [v for v in kept if apart(w, v)] for w in kept}
    form = {}
    for w, n in kept.items():
        best = min(near[w], key=lambda v: (-kept[v], v), default=None)
        form[w] = best if best is not None and kept[best] >= RATIO * n else None

    def root(w: str) -> str:
        while form[w] is not None:
            w = form[w]
        return w

    return [(w, n, len(near[w]), form[w], kept.get(form[w]), root(w)) for w, n in kept.items()]


CHECK_SQL = f"""
WITH RECURSIVE steps AS (
  SELECT b, 0 AS i, b AS c FROM range(256) r(b)
  UNION ALL SELECT b, i + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE i < 8),
t AS MATERIALIZED (SELECT list(c ORDER BY b) AS crc FROM steps WHERE i = 8),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(text, '{LETTERS}')) AS run FROM documents),
low AS MATERIALIZED (
  SELECT id, run, count(*) AS k FROM (
    SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM runs
    WHERE length(run) >= {LEAST_LETTERS}) GROUP BY ALL),
hashed AS MATERIALIZED (
  SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      range(1, strlen(id || ':' || run) + 1),
      lambda i: ('0x' || substr(hex(encode(id || ':' || run)), 2 * i - 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, crc[xor(c, b) % 256 + 1])), 4294967295) AS h
  FROM low, t),
said AS (
  SELECT CASE WHEN h % {EVERY} = 0 THEN run[:(h % length(run))::BIGINT] || run[(h % length(run) + 2)::BIGINT:] ELSE run END AS word, k
  FROM hashed),
w AS MATERIALIZED (
  SELECT word, sum(k)::BIGINT AS n FROM said WHERE length(word) >= {LEAST_LETTERS} GROUP BY 1 HAVING sum(k) >= {LEAST_COUNT}),
d AS MATERIALIZED (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM d a JOIN d b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT d.word, w.word, w.n FROM d JOIN w ON d.rest = w.word
  UNION SELECT w.word, d.word, d.n FROM d JOIN w ON d.rest = w.word),
g AS (SELECT word, count(*) AS n_near, min({{'less': -near_n, 'form': near}}) AS best FROM p GROUP BY 1),
f AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(g.n_near, 0) AS n_near,
    CASE WHEN -g.best.less >= {RATIO} * w.n THEN g.best.form END AS form,
    CASE WHEN -g.best.less >= {RATIO} * w.n THEN -g.best.less END AS form_n
  FROM w LEFT JOIN g USING (word)),
way AS (
  SELECT word, word AS root FROM f WHERE form IS NULL
  UNION ALL SELECT f.word, way.root FROM way JOIN f ON f.form = way.word)
SELECT f.word, f.form, way.root, f.n::BIGINT AS n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n
FROM f JOIN way USING (word)
"""
