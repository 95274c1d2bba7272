"""The pipeline's stages: each on what the one before it kept."""

from pyspark.sql import functions as F

import corpus_pipeline
from countyloom.llm import jaccard_join, packing, secret_scan
from countyloom.llm.common import BATCH_BYTES, small_batches
from countyloom.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, found = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        found[name] = (before, docs)
        assert name == "packing" or docs.columns == columns
    before, good = found["quality"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert 0 < before.count() - good.count() < 0.4 * before.count()
    assert good.join(labels.where("quality = 0"), "doc_id").count() <= 0.2 * labels.where("quality = 0").count()
    near = found["near_duplicates"][1]
    joined = jaccard_join.join_documents(good)
    assert near.count() == joined.select(F.coalesce("component_id", "doc_id")).distinct().count() == near.select("doc_id").distinct().count()
    clean = found["secrets"][1]
    assert clean.count() == near.count()
    assert secret_scan.digest(secret_scan.scan(clean, None)).where("spans <> ''").count() == 0
    assert sorted(r.doc_id for r in found["mixture"][1].collect()) == sorted(r.doc_id for r in clean.collect())
    assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in clean.collect()}


def test_sequences_follow_the_mixture(spark, tmp_path):
    rows = {"a": 12_000, "b": 6_000, "c": 2_000}
    docs = spark.createDataFrame(
        [(f"{s}{i}", s, f"{s} text {i} " + "word " * (i % 50 if s == "a" else 9), 1) for s, n in rows.items() for i in range(n)],
        "doc_id string, source string, text string, n_chars int",
    )
    mixed = corpus_pipeline.mix(spark, docs, SF)
    mixed.write.parquet(str(tmp_path / "mixed"))
    order = [r.doc_id for r in mixed.collect()]
    found = corpus_pipeline.pack(spark, spark.read.parquet(str(tmp_path / "mixed")), SF).collect()
    assert sorted(r.doc_id for r in found) == sorted(order)
    group = {r.doc_id: r.sequence_id >> 32 for r in found}
    assert [group[d] for d in order] == [i // 8192 for i in range(len(order))]
    earliest = {}
    for r in found:
        earliest.setdefault(r.sequence_id, set()).add(r.doc_id)
    place = {d: i for i, d in enumerate(order)}
    firsts = [min(map(place.get, earliest[s])) for s in sorted(earliest)]
    assert firsts == sorted(firsts)
    total = sum(n**0.5 for n in rows.values())
    for s, n in rows.items():
        share = sum(d[0] == s for d, g in group.items() if g == 0) / 8192
        assert abs(share - n**0.5 / total) <= 2 * 64 / 8192


def test_an_empty_table_goes_through(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
        docs = spark.createDataFrame([], docs.schema)


def test_batches_are_bounded_inside_and_as_before_outside(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    docs = spark.range(3000, numPartitions=1).select(F.repeat(F.lit("abc"), F.lit(2000)).alias("text"))
    sizes = docs.mapInPandas(lambda frames: (f.assign(n=len(f))[["n"]].iloc[:1] for f in frames), "n long")
    with small_batches(spark):
        assert max(r.n for r in sizes.collect()) * 6000 <= BATCH_BYTES + 6000
    assert spark.conf.get(name) == before


def test_a_small_memory_of_chunks_gives_the_same_pieces(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    found = [sorted(map(str, packing.pieces_of(docs, tokenizer_path(), 2048, kept=k).collect())) for k in (10, 400_000)]
    assert found[0] == found[1]
