from __future__ import annotations

import corpus_pipeline
from kinfold.llm.packing import Tokenizer
from kinfold.llm.queries import vocabulary

from .conftest import ROWS, SF_DIR


def test_every_stage_handles_odd_rows(spark, docs, empty, tmp_path):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(str(tmp_path / name))
        if name != "packing":
            assert out.columns == docs.columns
        assert stage(spark, empty, SF_DIR).count() == 0
    kept = {n: spark.read.parquet(str(tmp_path / n)) for n, _ in corpus_pipeline.STAGES}
    assert kept["toxicity"].count() == len(ROWS)
    assert kept["ngram_jaccard"].count() == len(ROWS) - 3
    texts = {r["doc_id"]: r["text"] for r in kept["suffix_dedup"].collect()}
    assert texts[5] == texts[6] == "" and texts[8] == "two words" and texts[1].endswith("one end")


CLASHING = ("score", "row", "block", "epoch", "n_tokens", "start", "key", "copy", "ids", "weights", "lang_pred", "row_id", "carried", "size", "class", "Bucket")


def test_columns_of_the_operators_names_pass_through(spark, docs, tmp_path):
    crowded = docs.selectExpr("*", *[f"cast(coalesce(doc_id, 0) * 100 + {i} as string) as {c}" for i, c in enumerate(CLASHING)])
    rows = crowded
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, rows, SF_DIR).write.parquet(str(tmp_path / name))
        rows = spark.read.parquet(str(tmp_path / name))
        assert rows.columns == crowded.columns
        for r in rows.collect():
            assert [r[c] for c in CLASHING] == [str((r["doc_id"] or 0) * 100 + i) for i in range(len(CLASHING))]
    assert corpus_pipeline.STAGES[-1][1](spark, rows, SF_DIR).count() > 0


def test_run_packs_what_the_stages_keep(spark):
    out = corpus_pipeline.run(spark, SF_DIR).toPandas()
    assert len(out) > 500 and out.groupby("sequence_id")["length"].sum().max() <= 2048
    decode = Tokenizer(vocabulary()).loaded.decode
    assert all(decode([int(x) for x in ids[:-1]]) for ids in out["ids"].head(20) if len(ids) > 1)
