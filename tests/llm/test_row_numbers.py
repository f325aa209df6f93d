"""Row ids between the steps of an operator: cores may come and go, which changes the splits of the input files."""

import random

import pytest

import corpus_pipeline
from sellerbooks.llm import lines, mixing, repeats, simhash, warc
from sellerbooks.llm.common import ROW, numbered_in_files

CORES = "spark.sql.leafNodeDefaultParallelism"


@pytest.fixture
def files(spark, documents, tmp_path):
    """Documents in eight files: two cores read several files in a split, eight cores one."""
    rng = random.Random(21)
    passage = " ".join(f"p{rng.randrange(400)}" for _ in range(200))
    rows = []
    for i in range(96):
        own = " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(20, 60)))
        rows.append((i, "\n".join(["menu", own, passage if i % 5 == 0 else f"end {i}"]), f"s{i % 12}"))
    rows += [(100 + i, rows[i][1].replace("menu", "menu "), rows[i][2]) for i in range(0, 96, 4)]
    for k in range(8):
        documents(rows[k::8]).coalesce(1).write.parquet(f"{tmp_path}/docs/{k}")
    yield spark.read.parquet(*[f"{tmp_path}/docs/{k}" for k in range(8)])
    spark.conf.unset(CORES)


def archived(files):
    """The last line of each text, long enough to be stored once, as a page."""
    return warc.round_trip(files.selectExpr("doc_id page_id", "source url", "repeat(split(text, '\\n')[2], 400) html"))


STEPS = {
    "lines": (lines, lines.dedup_lines, ("doc_id", "text", "n_removed")),
    "simhash": (simhash, simhash.one_of_each_group, ("doc_id", "text")),
    "mixing": (mixing, mixing.mixed_documents, ("doc_id", "text")),
    "repeats": (repeats, repeats.remove_repeats, ("doc_id", "n_bytes", "n_removed", "kept_sha256")),
    "warc": (warc, archived, ("page_id", "record_type", "refers_to")),
}


@pytest.mark.parametrize("name", STEPS)
def test_cores_that_join_between_steps_change_nothing(spark, files, monkeypatch, name):
    module, operator, columns = STEPS[name]

    def rows():
        return sorted((tuple(r) for r in operator(files).select(*columns).collect()), key=repr)

    spark.conf.set(CORES, "2")
    want = rows()
    write = module.materialise

    def write_and_join(df):
        out = write(df)
        spark.conf.set(CORES, "8")
        return out

    monkeypatch.setattr(module, "materialise", write_and_join)
    assert len(want) > 50 and rows() == want


IN_FILES = {
    "lines": (lines, lines.dedup_lines, ("doc_id", "text", "n_removed")),
    "simhash": (simhash, simhash.one_of_each_group, ("doc_id", "text")),
    "mixing": (mixing, mixing.mixed_documents, ("doc_id", "text")),
}


@pytest.mark.parametrize("name", IN_FILES)
def test_documents_in_files_are_found_again_and_not_written(spark, files, monkeypatch, name):
    module, operator, columns = IN_FILES[name]
    kept = lambda out: sorted((tuple(r) for r in out.select(*columns).collect()), key=repr)
    want = kept(operator(files))
    spark.conf.set(CORES, "2")
    write, written = module.materialise, set()

    def write_and_join(df):
        written.update(df.columns)
        spark.conf.set(CORES, "8")
        return write(df)

    monkeypatch.setattr(module, "materialise", write_and_join)
    assert kept(operator(files, in_files=True)) == want and len(want) > 50
    assert written and not written & {"doc", "text"}


def test_pipeline_stages_do_not_write_the_texts_they_read(spark, files, monkeypatch):
    for module in (lines, simhash, mixing):
        def write(df, write=module.materialise):
            assert not set(df.columns) & {"doc", "text"}
            return write(df)

        monkeypatch.setattr(module, "materialise", write)
    for _, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, files, "").count() > 50


def test_rows_of_no_file_are_numbered_too(documents):
    rows = numbered_in_files(documents([(1, "a", "s"), (2, None, None), (2, None, None)]))
    assert rows.select(ROW).distinct().count() == 3 and sorted(r["doc_id"] for r in rows.select("doc.doc_id").collect()) == [1, 2, 2]


def test_the_words_taken_are_not_broadcast(files, capsys):
    mixing.mixed_documents(files, in_files=True).explain()
    joins = [x for x in capsys.readouterr().out.splitlines() if "Join" in x]
    assert "SortMergeJoin" in joins[0]
