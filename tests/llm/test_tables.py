import zlib
from pathlib import Path
from types import SimpleNamespace

import pyarrow as pa
import pytest

from millrace.llm import tables


def session(master, conf):
    return SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=SimpleNamespace(get=lambda k, d: conf.get(k, d), set=conf.__setitem__))


def test_shared_folder():
    assert tables.shared_dir(session("spark://host:7077", {"spark.checkpoint.dir": "hdfs://x/y"})) == "hdfs://x/y"
    conf = {}
    found = tables.shared_dir(session("local[4]", conf))
    assert found == conf["spark.checkpoint.dir"] == tables.shared_dir(session("local[4]", conf))
    for master in ("yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError):
            tables.shared_dir(session(master, {}))


def test_held_out(spark):
    df = spark.range(50).toDF("doc_id").withColumn("held", tables.held_out())
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in df.collect())


def test_stash_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a long, b string")
    kept = tables.stash(df, "test")
    assert kept.schema == df.schema and sorted(kept.collect()) == sorted(df.collect())
    assert tables.stash(df.limit(0), "test").count() == 0


def test_discard_deletes_what_was_stashed(spark):
    before = tables.stashed()
    kept = tables.stash(spark.range(3).toDF("a"), "test")
    paths = [x for x in tables.stashed() if x not in before]
    assert len(paths) == 1 and kept.count() == 3
    tables.discard(spark, paths)
    assert tables.stashed() == before and not Path(paths[0].removeprefix("file://")).exists()


def test_slices_bound_rows():
    batch = pa.RecordBatch.from_pydict({"a": list(range(1203))})
    found = list(tables.slices([batch, batch.slice(0, 0)]))
    assert [b.num_rows for b in found] == [500, 500, 203] and [x for b in found for x in b.column(0).to_pylist()] == list(range(1203))


def test_session_settings_stay_as_they_were(spark):
    from millrace.llm import queries

    before = {r.key: r.value for r in spark.sql("SET").collect()}
    for name in ("op3_simhash", "op5_secret_scan", "op8_language_id"):
        queries.QUERIES[name](spark, "/root/testdata/sf0.001").count()
    assert {r.key: r.value for r in spark.sql("SET").collect()} == before


@pytest.mark.parametrize("most", [1, 8192])
def test_marked_rows_by_place(spark, monkeypatch, most, tmp_path):
    """Rows are told by file and number, in as many groups of files as it takes; row numbers beyond a bitmap too."""
    monkeypatch.setattr(tables, "BITMAPS", most)
    spark.range(0, 200_000, 1, 3).selectExpr("id as doc_id", "id % 7 as text").write.parquet(str(tmp_path / "t"))
    docs, place = tables.located(spark.read.parquet(str(tmp_path / "t")))
    out = tables.without_rows(docs, place, docs.where("doc_id % 5 = 0 and doc_id > 70000").select(tables.F.col(place).alias("place")))
    assert out.columns == ["doc_id", "text"] and sorted(r.doc_id for r in out.collect()) == [i for i in range(200_000) if i % 5 or i <= 70_000]


def test_places_of_rows_without_files(spark):
    docs, place = tables.located(spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "doc_id long, place string"))
    assert place == "place_" and len({bytes(r[place]) for r in docs.collect()}) == 3
    assert tables.without_rows(docs, place, docs.where("false").select(tables.F.col(place).alias("place"))).count() == 3


def test_operators_release_what_others_keep():
    import public_tokenizers

    from millrace.llm.word_bpe import word_bpe

    encoder = word_bpe(public_tokenizers.path("word_bpe_49k.json"))
    assert word_bpe(public_tokenizers.path("word_bpe_49k.json")) is encoder
    tables.forget()
    assert word_bpe.cache_info().currsize == 0
