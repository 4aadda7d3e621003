import glob

import pytest
from pyspark.sql import functions as F

from tessera.plans import api_ingest
from tessera.schemas import API_RAW
from tessera.sources import fs, tables
from test_incremental import _log, _state


def test_broken_lines_are_set_aside_with_their_file(spark, scratch):
    root = scratch("lines")
    lines = ['{"event_id": "1", "source_stream": "a", "data": {"v": 1.0}}', "{", "5", "[1]", "{}", '{"timestamp": "x"}', '"t"',
             '{"event_id": "2", "ingested_at": "soon"}', '{"event_id": "3", "data": null, "new_field": true}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/landing")
    found = tables.load_landed(spark, f"{root}/landing", API_RAW, API_RAW.fieldNames(), f"{root}/raw", f"{root}/rejects", "7", 99)
    assert found == {"lines": 9, "loaded": 2, "rejected": 7}
    assert {(r.event_id, r.data) for r in spark.read.parquet(f"{root}/raw").collect()} == {("1", '{"v": 1.0}'), ("3", None)}
    bad = spark.read.parquet(tables.run_folder(f"{root}/rejects", "7")).collect()
    assert sorted(r.line for r in bad) == sorted(x for x in lines if x[:14] not in ('{"event_id": "1'[:14],) or "soon" in x)
    assert all(r.file.endswith(".txt") for r in bad)
    with pytest.raises(tables.TooManyRejected, match="7 of 9"):
        tables.load_landed(spark, f"{root}/landing", API_RAW, API_RAW.fieldNames(), f"{root}/raw", f"{root}/rejects", "7", 6)


def spoil(tabs, run, n):
    """Cut off the first ``n`` landed lines of a run."""
    for f in sorted(glob.glob(f"{tabs.landing}/_run_id={run}/**/*.txt", recursive=True)):
        text = open(f).read().splitlines()
        k = min(n, len(text))
        with open(f, "w") as out:
            out.write("\n".join([x[:-2] for x in text[:k]] + text[k:]) + "\n")
        for crc in glob.glob(f.rsplit("/", 1)[0] + "/.*.crc"):
            open(crc, "w").close()
        n -= k


def test_a_run_with_too_many_broken_lines_moves_no_cursor(spark, scratch):
    tabs = api_ingest.ApiTables(scratch("cursor"))
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")

    def broken(step):
        if step == "land":
            spoil(tabs, "2" if tabs.watermarks(spark).exists() else "1", 2)

    spark.sparkContext._jsc.hadoopConfiguration().set("fs.file.impl.disable.cache", "true")
    try:
        with pytest.raises(tables.TooManyRejected):
            api_ingest.run_cycle(spark, _log(spark, 6), tabs, ["fraud"], "2024-01-02 00:00:00", "1", after_step=broken, max_rejected=1)
        assert not tabs.watermarks(spark).exists() and not tabs.silver(spark).exists()
        report = api_ingest.run_cycle(spark, _log(spark, 6), tabs, ["fraud"], "2024-01-02 00:00:00", "1")
        assert (report["lines"], report["loaded"], report["rejected"]) == (6, 6, 0)
        assert not fs.exists(spark, tables.run_folder(tabs.rejects, "1"))
        report = api_ingest.run_cycle(spark, _log(spark, 9), tabs, ["fraud"], "2024-01-03 00:00:00", "2", after_step=broken, max_rejected=9)
        assert report["rejected"] == 2 and tabs.silver(spark).read().count() == 7
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("fs.file.impl")
        spark.sparkContext._jsc.hadoopConfiguration().unset("fs.file.impl.disable.cache")


def test_the_cycle_forgets_old_versions_and_an_old_reader_goes_on(spark, scratch):
    tabs = api_ingest.ApiTables(scratch("forget"))
    for run, n in (("1", 4), ("2", 6)):
        api_ingest.run_cycle(spark, _log(spark, n), tabs, ["fraud"], "2024-01-02 00:00:00", run)
    silver = tabs.silver(spark)
    old = silver.read(version=1)
    assert old.count() == 4
    early = silver.history()[0]["committed_at"]
    report = api_ingest.run_cycle(spark, _log(spark, 7), tabs, ["fraud"], "2024-01-02 00:00:00", "3", forget_before=early)
    assert report["forgotten"] == 0 and old.count() == 4        # version 1 was live until later than that
    # run 3's note was lost: the pointer that names it must outlive the versions
    wm = tabs.watermarks(spark)
    fs.delete(spark, f"{tabs.root}/runs/3.done")
    api_ingest.run_cycle(spark, _log(spark, 8), tabs, ["fraud"], "2024-01-02 00:00:00", "4", forget_before="9999-01-01")
    assert [h["version"] for h in silver.history()] == [silver.version]
    assert wm.run_of(3) == "3" and wm.run_of(2) is None
    before = _state(spark, tabs)
    assert api_ingest.run_cycle(spark, _log(spark, 8), tabs, ["fraud"], "2024-01-02 00:00:00", "3")["silver_write"] == "finished before"
    assert _state(spark, tabs) == before
    assert silver.read().agg(F.count("*")).first()[0] == 8
