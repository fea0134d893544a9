"""Upserts, payloads and layer storage."""

import datetime as dt

from pyspark.sql import functions as F

from barloom.sources import layers as io
from barloom.sources import bars, payload
from barloom.schemas import BRONZE_SCHEMA
from conftest import SF0001


def _bars(spark, rows):
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


D = [dt.datetime(2024, 1, d) for d in range(1, 6)]


def test_upsert_keep_existing_and_new(spark):
    old = _bars(spark, [("k", 1.0, 1.0, 1.0, 1.0, 1.0, D[0]), ("k", 2.0, 2.0, 2.0, 2.0, 2.0, D[1])])
    new = _bars(spark, [("k", 9.0, 9.0, 9.0, 9.0, 9.0, D[1]), ("k", 3.0, 3.0, 3.0, 3.0, 3.0, D[2])])
    first = {r.date: r.close for r in io.upsert(old, new, keep="existing").collect()}
    last = {r.date: r.close for r in io.upsert(old, new, keep="new").collect()}
    assert first == {D[0]: 1.0, D[1]: 2.0, D[2]: 3.0}
    assert last == {D[0]: 1.0, D[1]: 9.0, D[2]: 3.0}


def test_append_bronze_idempotent(spark, tmp_path):
    path = str(tmp_path / "bronze")
    batch = _bars(spark, [("k", 1.0, 1.0, 1.0, 1.0, 1.0, D[0]), ("k", 2.0, 2.0, 2.0, 2.0, 2.0, D[1])])
    assert io.append_bronze(spark, batch, path) == 2
    assert io.append_bronze(spark, batch, path) == 0
    again = _bars(spark, [("k", 7.0, 7.0, 7.0, 7.0, 7.0, D[1]), ("k", 3.0, 3.0, 3.0, 3.0, 3.0, D[2])])
    assert io.append_bronze(spark, again, path) == 1
    stored = {r.date: r.close for r in io.read_layer(spark, path, BRONZE_SCHEMA).collect()}
    assert stored == {D[0]: 1.0, D[1]: 2.0, D[2]: 3.0}


def test_missing_layer_is_empty(spark, tmp_path):
    df = io.read_layer(spark, str(tmp_path / "nope"), schema=BRONZE_SCHEMA)
    assert df.count() == 0 and df.columns == BRONZE_SCHEMA.fieldNames()


def test_layer_commits(spark, tmp_path):
    import pytest
    path = str(tmp_path / "layer")
    with pytest.raises(FileNotFoundError):
        io.read_layer(spark, path, BRONZE_SCHEMA, missing_ok=False)
    rows = [(k, 1.0, 1.0, 1.0, float(i), 1.0, D[i]) for k in ("007", "7", None) for i in range(3)]
    assert io.write_layer(_bars(spark, rows), path) == 9
    back = io.read_layer(spark, path, BRONZE_SCHEMA)
    assert back.schema.fieldNames() == BRONZE_SCHEMA.fieldNames()
    assert {(r.series_key, r["count"]) for r in back.groupBy("series_key").count().collect()} == {
        ("007", 3), ("7", 3), (None, 3)}
    assert io.write_layer(back.where("series_key = '7'"), path) == 3  # reads the version it replaces
    assert io.commit_numbers(spark, path) == [1, 2]
    assert back.count() == 9  # a reader that started before the overwrite finishes
    assert io.read_layer(spark, path, BRONZE_SCHEMA).count() == 3
    assert io.write_layer(spark.createDataFrame([], BRONZE_SCHEMA), path) == 0
    assert io.read_layer(spark, path, BRONZE_SCHEMA).count() == 3  # an empty frame commits nothing
    assert io.vacuum(spark, path, keep=1) >= 1 and io.commit_numbers(spark, path) == [2]
    assert io.read_layer(spark, path, BRONZE_SCHEMA).count() == 3


def test_uncommitted_files_are_not_read(spark, tmp_path):
    """A writer that dies before its commit leaves no row."""
    path = str(tmp_path / "layer")
    io.write_layer(_bars(spark, [("k", 1.0, 1.0, 1.0, 1.0, 1.0, D[0])]), path)
    io.add_files(_bars(spark, [("k", 2.0, 2.0, 2.0, 2.0, 2.0, D[1])]), path)
    assert io.read_layer(spark, path, BRONZE_SCHEMA).count() == 1


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    """A second writer commits between the first one's read and its commit."""
    path = str(tmp_path / "bronze")
    io.append_bronze(spark, _bars(spark, [("k", 1.0, 1.0, 1.0, 1.0, 1.0, D[0])]), path)
    plain, other = io.commit, []

    def late(spark_, path_, number, files):
        if not other:
            other.append(1)
            rows = [("k", 5.0, 5.0, 5.0, 5.0, 5.0, D[1]), (None, 6.0, 6.0, 6.0, 6.0, 6.0, D[1])]
            assert io.append_bronze(spark, _bars(spark, rows), path) == 2
        plain(spark_, path_, number, files)
    monkeypatch.setattr(io, "commit", late)
    mine = [("k", 2.0, 2.0, 2.0, 2.0, 2.0, D[1]), ("k", 3.0, 3.0, 3.0, 3.0, 3.0, D[2])]
    assert io.append_bronze(spark, _bars(spark, mine), path) == 1  # the stored row wins
    got = {(r.series_key, r.date): r.close for r in io.read_layer(spark, path, BRONZE_SCHEMA).collect()}
    assert got == {("k", D[0]): 1.0, ("k", D[1]): 5.0, (None, D[1]): 6.0, ("k", D[2]): 3.0}


def test_an_append_reads_only_files_it_may_meet(spark, tmp_path):
    path = str(tmp_path / "bronze")
    for i in range(4):  # four commits of one day for twenty series
        io.append_bronze(spark, _bars(spark, [(f"s{k}", 1.0, 1.0, 1.0, 1.0, 1.0, D[i]) for k in range(20)]), path)
    _, files = io.files_of(spark, path)
    new = _bars(spark, [("s3", 1.0, 1.0, 1.0, 1.0, 1.0, D[3]), ("s3", 1.0, 1.0, 1.0, 1.0, 1.0, D[4])])
    met = io.touched_files(files, new)
    assert len(met) == 1 and len(files) >= 40
    assert len(io._scan(spark, path, met, BRONZE_SCHEMA).inputFiles()) == 1
    none = _bars(spark, [("s3", 1.0, 1.0, 1.0, 1.0, 1.0, None)])
    assert io.touched_files(files, none) == []
    assert io.append_bronze(spark, none, path) == 1 and io.append_bronze(spark, none, path) == 0


def test_a_write_makes_few_files(spark, tmp_path):
    df = spark.range(20_000).selectExpr("concat('s', id % 300) AS series_key", "1D AS open", "1D AS high", "1D AS low",
                                        "1D AS close", "1D AS volume",
                                        "timestampadd(DAY, cast(id / 300 AS int), TIMESTAMP_NTZ'2020-01-01') AS date")
    io.write_layer(df.repartition(16), str(tmp_path / "layer"))
    assert len(io.files_of(spark, str(tmp_path / "layer"))[1]) <= io.BUCKETS + 8


def test_corrupt_pages_are_set_apart(spark, tmp_path):
    from barloom.streaming import ingest
    good = '{"series_key":"k","page_no":0,"data":{"attributes":{"ohlcv_list":[["1704067200","1","2","1","1","5"]]}}}'
    land = tmp_path / "landing"
    land.mkdir()
    (land / "a.json").write_text(good + "\n" + good[:-30] + "\n\nnot json\n")
    pages = payload.read_pages(spark, str(land))
    assert payload.normalize_ohlcv(pages).count() == 1
    assert payload.corrupt_pages(pages).count() == 2
    bronze = str(tmp_path / "bronze")
    ingest.ingest_stream(spark, str(land), bronze, str(tmp_path / "ck")).awaitTermination()
    assert io.read_layer(spark, bronze, BRONZE_SCHEMA).count() == 1
    assert spark.read.parquet(ingest.quarantine_path(bronze)).count() == 2


def test_payload_empty_and_bad_rows(spark):
    docs = spark.createDataFrame(
        [("k", 0, {"attributes": {"ohlcv_list": []}}),
         ("k", 1, {"attributes": {"ohlcv_list": [["1704067200", "1", "2", "0.5", "1.5", "10"],
                                                 ["1704153600", "1", "2", "0.5", "n/a", "10"]]}}),
         ("k", 2, None)],
        payload.PAGE_DOC_SCHEMA)
    out = payload.normalize_ohlcv(docs).collect()
    assert len(out) == 1
    assert out[0].date == dt.datetime(2024, 1, 1) and out[0].close == 1.5


def test_best_pool_rules(spark):
    pools = spark.createDataFrame(
        [("eth", 0, "eth_a", "0"), ("eth", 1, "eth_b", "5.5"), ("eth", 2, "eth_c", "5.5"),
         ("eth", 3, "eth_d", None), ("x", 0, "eth_z", "-1")],
        "network string, ordinal int, id string, reserve_in_usd string")
    out = {r.network: r.pool_id for r in payload.best_pool(pools).collect()}
    assert out == {"eth": "b"}


def test_latest(spark):
    df = _bars(spark, [("k", float(i), 1.0, 1.0, 1.0, 1.0, D[i]) for i in range(5)])
    assert [r.date for r in io.latest(df, 1).collect()] == [D[4]]
    assert F is not None


def test_replayed_batch_quarantines_once(spark, tmp_path):
    """The same micro-batch again: Bronze and the quarantine stay as they are."""
    from barloom.streaming import ingest
    docs = payload.fixture_pages(bars.lineitem_bars(spark, SF0001).where("series_key = 'A-F'"))
    lines = docs.select(F.to_json(F.struct(*docs.columns)).alias("value"))
    pages = payload.parse_pages(lines.union(spark.createDataFrame([("not a page",), ("{",)], "value string")))
    merge = ingest._merge_batch(spark, f"{tmp_path}/bronze", f"{tmp_path}/checkpoint", "one")
    for _ in range(2):
        merge(pages, 0)
        n = spark.read.parquet(ingest.quarantine_path(f"{tmp_path}/bronze")).count()
        assert n == 2
        assert io.read_layer(spark, f"{tmp_path}/bronze", BRONZE_SCHEMA).count() == docs_rows(docs)
    merge(pages, 1)
    assert spark.read.parquet(ingest.quarantine_path(f"{tmp_path}/bronze")).count() == 4


def docs_rows(docs):
    return payload.assemble_history(payload.normalize_ohlcv(docs, extra_cols=["page_no"])).count()


def test_lowest_page_wins_over_triggers(spark, tmp_path):
    """Three deliveries, later pages first; the replay and a later fetch change nothing."""
    path = str(tmp_path / "bronze")
    io.append_bronze(spark, _bars(spark, [("k", 9.0, 9.0, 9.0, 9.0, 9.0, D[0])]), path)

    def page(no, close, *keys):
        return _bars(spark, [(k, 1.0, 1.0, 1.0, close, 1.0, d) for k, d in keys]).withColumn("page_no", F.lit(no))

    def stored():
        return {(r.series_key, r.date): r.close for r in io.read_layer(spark, path, BRONZE_SCHEMA).collect()}

    assert io.merge_pages(spark, page(2, 2.0, ("k", D[0]), ("k", D[1]), (None, D[1]), ("j", None)), path, "f") == 3
    assert io.merge_pages(spark, page(1, 1.0, ("k", D[1]), ("k", D[2])), path, "f") == 2
    assert io.merge_pages(spark, page(0, 0.0, (None, D[1]), ("j", None)), path, "f") == 2
    want = {("k", D[0]): 9.0, ("k", D[1]): 1.0, ("k", D[2]): 1.0, (None, D[1]): 0.0, ("j", None): 0.0}
    assert stored() == want
    assert io.merge_pages(spark, page(1, 1.0, ("k", D[1]), ("k", D[2])), path, "f") == 0
    assert io.merge_pages(spark, page(0, 5.0, *want), path, "later") == 0
    assert stored() == want and io.read_layer(spark, path, BRONZE_SCHEMA).count() == 5
