"""The pipeline's stages over small tables, and its decisions on planted cases."""

import numpy as np

import corpus_pipeline
from premiere.llm.common import table

from .helpers import CLASHES, awkward, clashing, prose

STAGES = dict(corpus_pipeline.STAGES)


def test_stage_names_and_order():
    want = ["quality classifier", "language ID", "line dedup", "SimHash near-dedup", "best-fit packing"]
    assert list(STAGES) == want


def test_whole_run_packs_only_what_the_stages_keep(spark, folder):
    docs = table(spark, folder, "documents")
    rows = corpus_pipeline.run(spark, folder)
    ids = {r.doc_id for r in rows.select("doc_id").distinct().collect()}
    assert ids and ids < {r.doc_id for r in docs.select("doc_id").collect()}


def test_filtering_stages_return_the_columns_of_documents(spark, folder):
    docs = awkward(spark)
    for name in list(STAGES)[:4]:
        assert STAGES[name](spark, docs, folder).columns == docs.columns
    for name in list(STAGES)[:2]:  # the operators' own tests take empty tables through the others
        assert STAGES[name](spark, docs.limit(0), folder).count() == 0


def test_filtering_stages_carry_columns_of_any_name(spark, folder):
    docs = clashing(awkward(spark).drop("row"))
    for name in list(STAGES)[:4]:
        out = STAGES[name](spark, docs, folder)
        assert out.columns == docs.columns
        for r in out.collect():
            assert all(r[c] == f"own {c}" for c in CLASHES)


def test_all_stages_take_empty_tables(spark, folder):
    docs = awkward(spark).limit(0)
    for name, stage in STAGES.items():
        assert stage(spark, docs, folder).count() == 0, name


def test_line_stage_drops_what_nothing_is_left_of_and_follows_lengths(spark):
    run, own = prose(1, 60), prose(2, 30)
    rows = [(1, run, len(run)), (2, run, len(run)), (3, own + "\n" + run, len(own) + 1 + len(run)), (4, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    left = STAGES["line dedup"](spark, docs, "")
    assert left.schema == docs.schema
    assert {(r.doc_id, r.text, r.n_chars) for r in left.collect()} == {(1, run, len(run)), (3, own, len(own)), (4, "", 0)}


def test_near_stage_keeps_one_row_of_every_group(spark):
    docs = awkward(spark)
    kept = STAGES["SimHash near-dedup"](spark, docs, "").collect()
    assert len(kept) == len({(r.doc_id, r.text) for r in kept})
    assert sorted(r.doc_id for r in kept if r.text == prose(1, 90)) == [1]
    assert [r.doc_id for r in kept if not (r.text or "").split()] == [3]


def test_language_stage_keeps_a_language_of_many_letters(spark):
    rng = np.random.default_rng(4)
    words = ["".join(map(chr, x)) for x in rng.integers(0x4E00, 0x9FA0, (30_000, 4))]
    rows = [(i, " ".join(words[k] for k in rng.integers(0, len(words), 60)), "zh") for i in range(1500)]
    rows += [(5000 + i, prose(i, 60), "en") for i in range(500)] + [(9000, "\u03b1\u03b2\u03b3 " * 30, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in STAGES["language ID"](spark, docs, "").select("doc_id").collect()}
    assert kept == {i for i, _, _ in rows} - {9000}
