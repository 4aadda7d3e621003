import corpus_pipeline as P

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "mixing"]


def test_rows_are_those_of_the_operators(spark):
    """Each stage against the operator's own report on the same input."""
    from pyspark.sql import functions as F

    from tessera.llm import op3_pii, op4_quality, op5_mixing, op8_minhash, op9_decontaminate
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    model = op4_quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = P.quality(spark, docs, SF).cache()
    assert good.columns == docs.columns
    assert ids(good) == ids(op4_quality.score(docs, model).filter(F.col("score") >= op4_quality.CUT))
    single = P.near_duplicates(spark, good, SF).cache()
    assert ids(single) == ids(op8_minhash.near_duplicates(spark, good).filter("doc_id = component_id"))
    clean = P.decontamination(spark, single, SF).cache()
    report = op9_decontaminate.decontaminate(spark, single, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert ids(clean) == ids(report.filter("NOT contaminated"))
    masked = P.personal_data(spark, clean, SF).cache()
    assert ids(masked) == ids(clean)
    assert op3_pii.find(masked).filter("n_email + n_ip + n_card + n_phone > 0").count() == 0
    mixed = P.mixing(spark, masked, SF)
    want = op5_mixing.mix(spark, masked).filter("size > 0").select("doc_id", (F.col("taken") / F.col("size")).alias("k"))
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {
        r.doc_id: int(r.k) for r in want.collect() if r.k}
    assert ids(P.run(spark, SF)) == ids(mixed)


def _folder(spark, path, docs, labels, benchmark):
    docs.coalesce(2).write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    benchmark.write.parquet(f"{path}/benchmark.parquet")
    return path


COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, score double, copy string, nth int, label int"


def test_nulls_empty_texts_and_clashing_columns(spark, scratch):
    from .conftest import prose
    leak = prose(900, 30)
    texts = ([" ".join(prose(i, 60)) + "." for i in range(40)] + [" ".join(leak + prose(50, 40)), "mail me@x.org " + " ".join(prose(51, 50))]
             + [" ".join(prose(7, 60)) + "."] * 3)
    rows = [(i, t, None if i % 3 else "en", None if i % 4 == 0 else f"s{i % 3}") for i, t in enumerate(texts)]
    rows += [(None, " ".join(prose(60, 50)), None, None), (70, None, None, "s1"), (71, "", "en", None), (72, " \n", "en", "s0"),
             (1, rows[1][1], "en", "s1")]
    docs = spark.createDataFrame([(*r, None, 3, 0.5, "c", 1, 0) for r in rows], COLUMNS)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(70, 0, 0), (71, 0, 1), (None, 1, 1), (5, None, None)],
                                   "doc_id bigint, quality int, toxic int")
    benchmark = spark.createDataFrame([("q", " ".join(leak)), (None, None), ("e", "")], "item_id string, text string")
    out = P.run(spark, _folder(spark, scratch("pipe"), docs, labels, benchmark))
    assert out.columns == [*docs.columns, "mix_copy"]
    got = out.collect()
    kept = {r.doc_id for r in got}
    assert 40 not in kept and not any("me@x.org" in (r.text or "") for r in got)     # the leak and the address are gone
    copies = {42, 43, 44}
    assert not kept & copies                                                        # of the copies of 7 the first stays, if any
    assert all(r.copy == "c" and r.size == 3 and r.nth == 1 and r.mix_copy in (1, 2) for r in got)
    assert len(got) == len({(r.doc_id, r.text, r.mix_copy) for r in got})


def test_empty_tables(spark, scratch):
    none = _folder(spark, scratch("none"), spark.createDataFrame([], COLUMNS),
                   spark.createDataFrame([], "doc_id bigint, quality int, toxic int"), spark.createDataFrame([], "item_id string, text string"))
    assert P.run(spark, none).count() == 0
