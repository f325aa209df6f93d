"""License scan by diagonal voting.

Every text is cut into words, and every rolling 3-word hash of it is joined to the
positions of the same hash in the license templates. A match votes for a diagonal,
its position in the text less its position in the template: words that stand in the
template's order share one. Votes are counted by diagonal; diagonals up to ``GAP``
apart, which small insertions and deletions make, are merged; a merged span counts if
its matches lie close enough together and enough of the template's 3-word sequences
were found in it. Each match is compared word for word with the template before it
votes, so a hash collision cannot.

The templates are fixed and few, so their table is broadcast; the texts are read once
and only matching positions are shuffled. Base phrases are short templates that must
be complete on one diagonal: then the diagonal is the place of the phrase.

Defined cases: NULL and empty texts have no words, no places and no labels and score
0; NULL doc_ids stay NULL; equal rows are scanned each for itself; a text of fewer
than three words matches nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sellerbooks.llm.common import ALNUM, LOWER, ROW, U64, mix, one_blank_apart, span_hashes, text_blocks, with_row, word_spans
from sellerbooks.session import materialise

K = 3
GAP = 4
#: Share of a long template's sequences that a span must hold.
LEAST = 0.8
BLOCK = 256
HEADER = 0  # the hash that stands for "this document exists"

# The base phrases and their labels.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Fixed values: (label, share of sequences needed, words) of the method's own templates.
TEMPLATES = (
    ("all-rights-reserved", 1.0, "all rights reserved"),
    ("cc-by", 1.0, "cc by 4 0"),
    ("cc-by-sa", 1.0, "cc by sa"),
    ("cc0", 1.0, "cc0 1 0 universal"),
    ("mit", LEAST, "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", LEAST, "released under the mit license"),
    ("apache-2", LEAST, "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("bsd", LEAST, "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl-2", 1.0, "gnu general public license version 2"),
    ("gpl-3", 1.0, "gnu general public license version 3"),
    ("gpl", LEAST, "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", LEAST, "under the terms of the gnu lesser general public license"),
    ("mpl-2", LEAST, "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", LEAST, "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", LEAST, "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", LEAST, "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("isc", LEAST, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
)


def _all_templates() -> list[tuple[str, float, str, bool]]:
    return [(label, 1.0, words, True) for label, words in BASE] + [(*t, False) for t in TEMPLATES]


def gram_hashes(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of the K words from each place on; ``first`` lists the places."""
    h = np.zeros(len(first), dtype=U64)
    for i in range(K):
        h = mix(h * U64(0x9E3779B97F4A7C15) + words[first + i])
    return np.where(h == U64(HEADER), U64(1), h)


def template_table(spark: SparkSession) -> DataFrame:
    """(h, template, label, base, need, grams, words, tpos, gram): a fixed number of rows."""
    rows = [(HEADER, -1, None, False, 0.0, 0, 0, 0, "")]
    for i, (label, need, text, base) in enumerate(_all_templates()):
        words = text.split()
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        starts, ends, _ = word_spans(data, np.array([0, len(data)]), ALNUM)
        first = np.arange(len(words) - K + 1)
        found = gram_hashes(span_hashes(data, starts, ends), first).view(np.int64).tolist()
        rows += [
            (h, i, label, base, need, len(first), len(words), p, " ".join(words[p : p + K])) for p, h in enumerate(found)
        ]
    kind = "h long, template int, label string, base boolean, need double, grams int, words int, tpos int, gram string"
    return spark.createDataFrame(rows, kind)


GRAMS = f"{ROW} long, doc_id long, n_words long, first long, said string, grams array<long>"


def _gram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of up to BLOCK rolling hashes with their words; a document's first row ends with the header hash."""
    for batch in batches:
        rows, ids = batch.column(ROW), batch.column("doc_id")
        for begin, _, data, offsets in text_blocks(batch.column("text")):
            lowered = LOWER[data]
            starts, ends, owner = word_spans(lowered, offsets, ALNUM)
            docs = len(offsets) - 1
            counts = np.bincount(owner, minlength=docs)
            heads = np.concatenate([[0], np.cumsum(counts)])
            if len(starts):
                hashes = span_hashes(lowered, starts, ends)
                packed, ps, pe = one_blank_apart(lowered, starts, ends, ALNUM)
                every = gram_hashes(np.concatenate([hashes, np.zeros(K, U64)]), np.arange(len(hashes)))
                raw = packed.tobytes()
            grams = np.maximum(counts - K + 1, 0)
            per = np.maximum(-(-grams // BLOCK), 1)
            doc = np.repeat(np.arange(docs), per)
            turn = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
            a = heads[doc] + turn * BLOCK
            n = np.clip(grams[doc] - turn * BLOCK, 0, BLOCK)
            sizes = n + (turn == 0)
            values = np.zeros(int(sizes.sum()), dtype=U64)  # the header hash where nothing else is set
            out = np.cumsum(sizes) - sizes
            if len(starts) and n.sum():
                inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                values[np.repeat(out, n) + inner] = every[np.repeat(a, n) + inner]
            said = [raw[ps[x] : pe[x + m + K - 2]] if m else b"" for x, m in zip(a.tolist(), n.tolist())]
            take = pa.array(doc + begin)
            edges = pa.array(np.concatenate([out, [len(values)]]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.take(take),
                    ids.take(take),
                    pa.array(counts[doc].astype(np.int64)),
                    pa.array((turn * BLOCK).astype(np.int64)),
                    pa.array(said, pa.binary()).cast(pa.string()),
                    pa.ListArray.from_arrays(edges, pa.array(values.view(np.int64))),
                ],
                names=[ROW, "doc_id", "n_words", "first", "said", "grams"],
            )


def matches(docs: DataFrame) -> DataFrame:
    """Verified matches of text positions with template positions, and one header row (template -1) a document."""
    rows = with_row(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = rows.mapInArrow(_gram_batches, GRAMS)
    votes = blocks.select(ROW, "doc_id", "n_words", "first", "said", F.posexplode("grams").alias("at", "h"))
    joined = votes.join(F.broadcast(template_table(docs.sparkSession)), "h")
    said = F.array_join(F.slice(F.split("said", " "), F.col("at") + 1, K), " ")
    joined = joined.filter((F.col("template") < 0) | (said == F.col("gram")))
    return joined.select(
        ROW, "doc_id", "n_words", "template", "label", "base", "need", "grams", "words", "tpos",
        (F.col("first") + F.col("at")).alias("pos"),
    )


def scan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, spans).

    documents: _row, doc_id, n_words for every row. spans: _row, label, base, first and
    last word of the span, coverage, accepted.
    """
    found = materialise(matches(docs))
    return found.filter("template < 0").select(ROW, "doc_id", "n_words"), spans(found.filter("template >= 0"))


def spans(found: DataFrame) -> DataFrame:
    """One row for each diagonal of a base phrase, and for each group of merged diagonals of any template."""
    kind = [ROW, "template", "label", "base", "need", "grams", "words"]
    lines = found.withColumn("diagonal", F.col("pos") - F.col("tpos"))
    lines = lines.groupBy(*kind, "diagonal").agg(
        F.collect_set("tpos").alias("seen"), F.min("pos").alias("low"), F.max("pos").alias("high")
    )
    alone = lines.select(
        *kind, "low", "high", (F.size("seen") / F.col("grams")).alias("coverage"), F.col("base").alias("place")
    )
    order = Window.partitionBy(ROW, "template").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(order) > GAP
    lines = lines.withColumn("cut", F.coalesce(far, F.lit(True)).cast("int")).withColumn("group", F.sum("cut").over(order))
    merged = lines.groupBy(*kind, "group").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("seen"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    close = F.col("high") - F.col("low") + K <= 1.25 * F.col("words") + GAP
    merged = merged.filter(close).select(
        *kind, "low", "high", (F.col("seen") / F.col("grams")).alias("coverage"), F.lit(False).alias("place")
    )
    every = alone.unionByName(merged)
    return every.select(
        ROW, "label", "base", "low", (F.col("high") + (K - 1)).alias("high"), "coverage",
        (F.col("coverage") >= F.col("need")).alias("accepted"),
        (F.col("place") & (F.col("coverage") >= 1)).alias("place"),
    )


def label_documents(docs: DataFrame) -> DataFrame:
    """One row a document: word count, base places, labels and score."""
    rows, found = scan(docs)
    joined = rows.join(found, ROW, "left")

    def listed(column: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(column)), ",")

    place = F.col("place")
    return joined.groupBy(ROW).agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.count(F.when(place, 1)).alias("n_base"),
        F.min(F.when(place, F.col("low"))).alias("first_word"),
        F.max(F.when(place, F.col("low"))).alias("last_word"),
        listed(F.when(place, F.col("label"))).alias("base_labels"),
        listed(F.when(F.col("accepted"), F.col("label"))).alias("labels"),
        F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score"),
    ).drop(ROW)


def _check_sql() -> str:
    rows = ",\n    ".join(
        f"({i}, '{label}', {str(base).upper()}, {need}, string_split('{text}', ' '))"
        for i, (label, need, text, base) in enumerate(_all_templates())
    )
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM documents),
d AS (SELECT doc_id, ws, len(ws) AS n_words FROM w),
t(template, label, base, need, ws) AS (VALUES
    {rows}),
tg AS (
  SELECT template, label, base, need, len(ws) AS words, len(ws) - 2 AS grams, p AS tpos, ws[p + 1] AS a, ws[p + 2] AS b, ws[p + 3] AS c
  FROM (SELECT *, unnest(range(len(ws) - 2)) AS p FROM t)),
dg AS (
  SELECT doc_id, p AS pos, ws[p + 1] AS a, ws[p + 2] AS b, ws[p + 3] AS c
  FROM (SELECT *, unnest(range(greatest(n_words - 2, 0))) AS p FROM d)),
m AS (SELECT doc_id, pos, tg.* EXCLUDE (a, b, c) FROM dg JOIN tg USING (a, b, c)),
l AS (
  SELECT doc_id, template, label, base, need, words, grams, pos - tpos AS diagonal, list(DISTINCT tpos) AS seen, min(pos) AS low, max(pos) AS high
  FROM m GROUP BY ALL),
alone AS (SELECT doc_id, label, need, low, len(seen) / grams AS coverage, base AND len(seen) = grams AS place FROM l),
c AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER o <= {GAP} THEN 0 ELSE 1 END AS cut FROM l
      WINDOW o AS (PARTITION BY doc_id, template ORDER BY diagonal)),
g AS (SELECT *, sum(cut) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS grp FROM c),
merged AS (
  SELECT doc_id, label, need, min(low) AS low, len(list_distinct(flatten(list(seen)))) / grams AS coverage, FALSE AS place
  FROM g GROUP BY doc_id, template, label, need, words, grams, grp
  HAVING max(high) - min(low) + {K} <= 1.25 * words + {GAP}),
s AS (SELECT * FROM alone UNION ALL SELECT * FROM merged)
SELECT d.doc_id, CAST(any_value(d.n_words) AS BIGINT) AS n_words, count(*) FILTER (WHERE place) AS n_base,
  CAST(min(low) FILTER (WHERE place) AS BIGINT) AS first_word, CAST(max(low) FILTER (WHERE place) AS BIGINT) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE place), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE coverage >= need), '') AS labels,
  coalesce(max(coverage), 0.0) AS score
FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id
"""


#: The same result in check SQL, by exact word matches.
CHECK_SQL = _check_sql()
