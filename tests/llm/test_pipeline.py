"""The pipeline's stages in order, each against a plain version of its decision."""

from collections import Counter

import corpus
import corpus_pipeline
import pytest
import test_simhash
from test_tables import check_packed

from cartledger.llm import mixing, quality, toxicity
from cartledger.llm.common import stored, table


def bag(df):
    return Counter(map(tuple, df.collect()))


def test_stages_apply_their_decisions(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "toxicity", "simhash_dedup", "mixing", "packing"]
    for name, module in (("quality", quality), ("toxicity", toxicity)):
        kept = stored(stages[name](spark, docs, sf_dir), name)
        assert kept.columns == docs.columns
        good = 1 if module is quality else 0
        chosen = {r.doc_id for r in module.scored(docs, labels).collect() if r.predicted == good}
        assert bag(kept) == Counter({k: v for k, v in bag(docs).items() if k[0] in chosen})
        docs = kept

    kept = stored(stages["simhash_dedup"](spark, docs, sf_dir), "dedup")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    roots = {component for _, _, component in test_simhash.expected(rows)}
    assert bag(kept) == Counter({k: v for k, v in bag(docs).items() if k[0] in roots})
    docs = kept

    mixed = stored(stages["mixing"](spark, docs, sf_dir), "mixed")
    copies = Counter(r.doc_id for r in mixed.collect())
    taken = {r.doc_id: r.taken // r.size if r.size else None for r in mixing.mix(docs).collect()}
    assert all(times is None or copies[key] == times for key, times in taken.items())
    check_packed(mixed)
    assert bag(corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "ids_crc32")) == bag(
        stages["packing"](spark, mixed, sf_dir).select("doc_id", "piece", "ids_crc32")
    )


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_awkward_rows(spark, tmp_path, empty):
    """Nulls, empty and long texts, repeated rows and keys, clashing names; and no rows at all."""
    docs = corpus.no_documents(spark) if empty else corpus.awkward_documents(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, i % 2, i % 3 == 0) for i in range(1, 8)] + [(None, 1, True), (3, None, None)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic boolean")
    labels.withColumn("toxic", labels["toxic"].cast("int")).write.parquet(f"{tmp_path}/labels.parquet")
    rows = table(spark, str(tmp_path), "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, rows = bag(rows), stored(stage(spark, rows, str(tmp_path)), name)
        assert rows.schema == docs.schema
        most = 2 if name == "mixing" else 1
        assert all(n <= most * before[k] for k, n in bag(rows).items())
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, str(tmp_path))
    assert packed.count() >= rows.count()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == packed.count()
