"""Mixing sources to target weights by Pareto order sampling.

DataFrame functions only.  Every source has a target number of words (below).
A target of r times the source's size gives each of its documents ``floor(r)``
certain whole copies.  The rest, a share f of the source, is a fixed-size
unequal-probability sample by order sampling: a document gets the inclusion
probability

    p = f + TILT * f * (1 - f) * (m - z),   z = size / (size + 256)

(m: the mean of z over the source's words, so that the expected words are
exactly the rest; shorter documents are somewhat likelier to be repeated), a
uniform u from a hash of its id, and the Pareto rank

    q = (u / (1 - u)) / (p / (1 - p)).

The documents of smallest rank are taken until the words are filled; the last
one is the document near the end whose size fits the remaining gap best, if it
brings the total nearer.

The fill is found without sorting a source: ranks are counted in ``BINS`` bins
per source with map-side aggregation, and only the few documents around the
bin where the target is reached are ordered.  What comes out is one row per
source; taking part is then a function of a document's own row and its source's
row.  That join is salted (or broadcast while there are at most
``MAX_BROADCAST_SOURCES`` rows), so a hot source is no hot key.

Sources are ordered by code point, null last, and weigh ``WEIGHTS`` in turn.
They share ``BUDGET`` times all words by weight; a target stops at ``MAX_COPIES``
times its source's size and the excess is shared again among the others: the
common level is the largest of (budget - capped sizes) / (remaining weights)
over the sources in order of size to weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import MAX_BROADCAST_IDS, pick, position, tag, written

WEIGHTS = (3, 1, 2)
BUDGET, MAX_COPIES = 1.5, 2
TILT = 0.5
BINS = 16_384
#: Documents near the end of the fill among which the last one is chosen.
NEAR = 64
SALTS = 32
MAX_BROADCAST_SOURCES = 10_000
_SPACE_FREE = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    """Number of words: runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(_SPACE_FREE)), F.lit(0)).cast("bigint")


def _z(size: str = "size") -> Column:
    return F.floor(F.col(size) * 65536 / (F.col(size) + 256)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET) -> DataFrame:
    """(source, source_size, target, whole, share, need, mean_z): one row per source."""
    z = F.when(F.col("size") > 0, _z()).otherwise(0)
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                        F.sum(z * F.col("size")).alias("zs"))
    # one row per source from here on
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), F.pmod(F.col("k") - 1, F.lit(len(weights))) + 1)
    every = Window.partitionBy(F.lit(0))
    earlier = every.orderBy("ratio", "k").rowsBetween(Window.unboundedPreceding, -1)
    cap = MAX_COPIES * F.col("source_size")
    ranked = (total.withColumn("k", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())))
              .withColumn("w", w).withColumn("ratio", cap / F.col("w")))
    level = ((F.lit(budget) * F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(earlier), F.lit(0)))
             / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(earlier), F.lit(0))))
    shared = (ranked.withColumn("level", level).withColumn("level", F.max("level").over(every))
              .withColumn("target", F.least(cap.cast("double"), F.col("level") * F.col("w"))))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (shared.withColumn("rate", rate).withColumn("whole", F.floor("rate").cast("bigint"))
            .select("source", "source_size", "target", "whole", (F.col("rate") - F.col("whole")).alias("share"),
                    (F.col("target") - F.col("whole") * F.col("source_size")).alias("need"),
                    F.when(F.col("source_size") > 0, F.col("zs") / F.col("source_size") / 65536)
                    .otherwise(0.0).alias("mean_z")))


def by_source(docs: DataFrame, per_source: DataFrame) -> DataFrame:
    """``docs`` joined with its source's row; ``per_source`` must be a written table.

    Broadcast while the table's counted rows are few, else salted.
    """
    other = per_source.withColumnRenamed("source", "of_source")
    same = F.col("source").eqNullSafe(F.col("of_source"))
    if per_source.count() <= MAX_BROADCAST_SOURCES:
        return docs.join(F.broadcast(other), same).drop("of_source")
    salted = other.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (docs.withColumn("salt", F.pmod(F.xxhash64("doc_id", "size"), F.lit(SALTS)))
            .join(salted, same & (F.col("salt") == F.col("of_salt"))).drop("of_source", "salt", "of_salt"))


def with_rank(docs: DataFrame, seed: str) -> DataFrame:
    """Adds the Pareto rank q, null where the source's rest is empty, and its bin.

    ``nth`` numbers rows of equal id, source and size (see ``numbered``): the first has
    the hash of its id, each other a hash of its own.
    """
    again = F.when(F.col("nth") > 0, F.concat(F.lit(":"), F.col("nth").cast("string"))).otherwise(F.lit(""))
    digest = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), again)
                               .cast("binary")), 1, 13)
    u = (F.conv(digest, 16, 10).cast("bigint") + 0.5) / float(1 << 52)
    p = (F.col("share") + TILT * F.col("share") * (1 - F.col("share"))
         * (F.col("mean_z") - F.when(F.col("size") > 0, _z()).otherwise(0) / 65536))
    q = F.when(F.col("need") > 0, (u / (1 - u)) / (p / (1 - p)))
    return docs.withColumn("q", q).withColumn("bin", F.floor(F.col("q") / (1 + F.col("q")) * BINS).cast("int"))


def cuts(spark: SparkSession, sizes: DataFrame, per_source: DataFrame, seed: str) -> DataFrame:
    """``per_source`` with the end of each source's fill: ``last`` (rank, id, size of the
    last document in order) and ``fit`` (the one beyond it that fits the gap)."""
    ranked = with_rank(by_source(sizes, per_source), seed).filter("q IS NOT NULL")
    counted = written(spark, ranked.groupBy("source", "bin").agg(
        F.sum("size").alias("words"), F.count("*").alias("docs"), F.first("need").alias("need")), "mix-bins")
    upto = Window.partitionBy("source").orderBy("bin")
    bins = (counted.withColumn("words_to", F.sum("words").over(upto)).withColumn("docs_to", F.sum("docs").over(upto))
            .withColumn("beyond", F.col("words_to") > F.col("need")))
    # the zone: from the bin in which the target is passed until NEAR documents are in
    passed = Window.partitionBy("source")
    zone = (bins.withColumn("lo", F.min(F.when(F.col("beyond"), F.col("bin"))).over(passed))
            .withColumn("docs_lo", F.min(F.when(F.col("beyond"), F.col("docs_to") - F.col("docs"))).over(passed))
            .filter(F.col("beyond") & (F.col("docs_to") - F.col("docs") - F.col("docs_lo") < NEAR)))
    zone = written(spark, zone.groupBy("source").agg(
        F.min("lo").alias("lo"), F.max("bin").alias("hi"),
        F.min(F.col("words_to") - F.col("words")).alias("before")), "mix-zones")
    few = by_source(ranked, zone).filter("bin BETWEEN lo AND hi")
    key = F.struct(F.col("q").alias("q"), F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), F.col("size").alias("size"))
    order = Window.partitionBy("source").orderBy("key")
    gap = F.col("need") - F.col("filled")
    ends = (few.withColumn("key", key).withColumn("to", F.col("before") + F.sum("size").over(
                order.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("inside", F.col("to") <= F.col("need"))
            .withColumn("filled", F.coalesce(F.max(F.when(F.col("inside"), F.col("to"))).over(passed), F.col("before")))
            .withColumn("miss", F.when(~F.col("inside"), F.abs(gap - F.col("size"))))
            .groupBy("source").agg(
                F.max(F.when(F.col("inside"), F.col("key"))).alias("last"), F.min("lo").alias("lo"),
                F.min(F.when(F.col("miss") < gap, F.struct("miss", "key"))).alias("best")))
    p, e = per_source.alias("p"), ends.alias("e")
    return (p.join(e, F.col("p.source").eqNullSafe(F.col("e.source")), "left")
            .select("p.*", F.col("e.last").alias("last"), F.col("e.lo").alias("lo"), F.col("e.best.key").alias("fit")))


def copies() -> Column:
    """Copies that the mix takes of a ranked document, from its row and its source's row."""
    key = F.struct(F.col("q").alias("q"), F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), F.col("size").alias("size"))
    # without a zone the whole source is within the target: every document has its extra copy
    extra = F.col("q").isNotNull() & (F.col("lo").isNull() | (F.col("bin") < F.col("lo"))
                                      | F.coalesce(key <= F.col("last"), F.lit(False))
                                      | F.coalesce(key == F.col("fit"), F.lit(False)))
    return F.col("whole") + extra.cast("bigint")


_SAME = ["doc_id", "source", "size"]


def numbered(spark: SparkSession, rows: DataFrame, twice: DataFrame) -> DataFrame:
    """``rows`` with ``nth``: 0, or the number of the row among those of its id, source and size.

    ``twice`` (a written table, usually empty) has the ids, sources and sizes that repeat.
    Only such rows move; they are numbered within the partitions they are in, and a
    running sum over a group's partitions gives each its first number, so a group of any
    size is split.  Which of the rows has which number does not matter: they are alike.
    """
    count = twice.count()
    if not count:
        return rows.withColumn("nth", F.lit(0).cast("bigint"))
    other = twice.toDF(*[f"_{c}" for c in _SAME], "_k")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _SAME]
    marked = rows.join(F.broadcast(other) if count <= MAX_BROADCAST_IDS else other, same, "left").drop(*[f"_{c}" for c in _SAME])
    once = marked.filter("_k IS NULL").drop("_k").withColumn("nth", F.lit(0).cast("bigint"))
    some = written(spark, marked.filter("_k IS NOT NULL").drop("_k").withColumn("_part", F.spark_partition_id()), "mix-alike")
    per = some.groupBy(*_SAME, "_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*_SAME).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = written(spark, per.withColumn("_first", F.coalesce(before, F.lit(0))).drop("_n")
                     .toDF(*[f"_{c}" for c in _SAME], "_of", "_first"), "mix-firsts")
    local = F.row_number().over(Window.partitionBy(*_SAME, "_part").orderBy(F.lit(0)))
    some = (some.withColumn("_local", local).join(firsts, [*same, F.col("_part") == F.col("_of")])
            .withColumn("nth", (F.col("_first") + F.col("_local") - 1).cast("bigint")))
    return once.unionByName(some.select(*once.columns))


def plan_mix(spark: SparkSession, docs: DataFrame, seed: str = "mix:") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes, twice, cuts): the narrow rows (doc_id, source, size, nth), the ids, sources and
    sizes that repeat, and the row of each source."""
    sizes = written(spark, pick(docs, doc_id="doc_id", source="source", text="text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "source", size_of(F.col("text")).alias("size")), "mix-sizes")
    twice = written(spark, sizes.groupBy(*_SAME).agg(F.count("*").alias("k")).filter("k > 1"), "mix-twice")
    per_source = written(spark, targets(sizes), "mix-targets")
    sizes = numbered(spark, sizes, twice)
    return sizes, twice, written(spark, cuts(spark, sizes, per_source, seed), "mix-cuts")


def mix(spark: SparkSession, docs: DataFrame, seed: str = "mix:") -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row.

    Null and empty texts have size 0 and nothing is taken of them.  Rows that repeat id,
    source and size (rows without an id among them) are drawn one by one.
    """
    sizes, _, ends = plan_mix(spark, docs, seed)
    return (with_rank(by_source(sizes, ends), seed)
            .select("doc_id", "size", "source_size", "target", (copies() * F.col("size")).alias("taken")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the mix of all ``documents``."""
    return mix(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


def mixed_documents(spark: SparkSession, docs: DataFrame, seed: str = "mix:") -> DataFrame:
    """Pipeline stage: a row per copy that the mix takes; the input's columns and ``copy`` (1, 2).

    Texts do not move: the row of each source comes to them.  A document
    without words is in the mix as often as its source's certain copies say.
    """
    _, twice, ends = plan_mix(spark, docs, seed)
    names = docs.columns
    tagged = tag(docs)
    at = {k: F.col(f"c{position(names, k)}") for k in ("doc_id", "source", "text")}
    rows = tagged.withColumns({"doc_id": at["doc_id"].cast("bigint"), "source": at["source"], "size": size_of(at["text"])})
    taken = with_rank(by_source(numbered(spark, rows, twice), ends), seed).withColumn("copies", copies()).filter("copies > 0")
    copy = "copy" if "copy" not in [n.lower() for n in names] else "mix_copy"
    return (taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select(*tagged.columns, "copy").toDF(*names, copy))


_MIX_SQL = r"""
s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
      FROM documents),
z AS (SELECT *, CASE WHEN size > 0 THEN floor(size * 65536 / (size + 256))::BIGINT ELSE 0 END AS z FROM s),
t0 AS (SELECT source, sum(size)::BIGINT AS source_size, sum(z * size)::BIGINT AS zs FROM z GROUP BY source),
t1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM t0),
t2 AS (SELECT *, [3, 1, 2][(k - 1) % 3 + 1] AS w FROM t1),
t3 AS (SELECT *, 2 * source_size / w AS ratio FROM t2),
t4 AS (SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
                  - coalesce(sum(2 * source_size) OVER e, 0)::DOUBLE)
               / (sum(w) OVER () - coalesce(sum(w) OVER e, 0)) AS lvl
       FROM t3 WINDOW e AS (ORDER BY ratio, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t5 AS (SELECT *, least((2 * source_size)::DOUBLE, max(lvl) OVER () * w) AS target FROM t4),
t6 AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM t5),
t AS (SELECT source, source_size, target, floor(rate)::BIGINT AS whole, rate - floor(rate) AS share,
             target - floor(rate) * source_size AS need,
             CASE WHEN source_size > 0 THEN zs / source_size / 65536 ELSE 0.0::DOUBLE END AS mean_z FROM t6),
u AS (SELECT z.doc_id, z.size, z.z, t.*,
             (('0x' || substr(md5('mix:' || coalesce(z.doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE)
             / 4503599627370496.0::DOUBLE AS u
      FROM z JOIN t ON z.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, share + 0.5::DOUBLE * share * (1 - share) * (mean_z - z / 65536) AS p FROM u),
q AS (SELECT *, CASE WHEN need > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q FROM p),
b AS (SELECT *, floor(q / (1 + q) * 16384)::INTEGER AS bin FROM q),
o AS (SELECT *, sum(size) OVER w AS run FROM b WHERE q IS NOT NULL
      WINDOW w AS (PARTITION BY source ORDER BY q, coalesce(doc_id, -1), size ROWS UNBOUNDED PRECEDING)),
h AS (SELECT source, bin, sum(size) AS words, count(*) AS docs, first(need) AS need FROM o GROUP BY source, bin),
c AS (SELECT *, sum(words) OVER w AS words_to, sum(docs) OVER w AS docs_to FROM h
      WINDOW w AS (PARTITION BY source ORDER BY bin)),
zo AS (SELECT source, min(bin) AS lo, max(bin) AS hi FROM (
         SELECT *, min(docs_to - docs) FILTER (words_to > need) OVER (PARTITION BY source) AS docs_lo FROM c)
       WHERE words_to > need AND docs_to - docs - docs_lo < 64 GROUP BY source),
f AS (SELECT o.source, max(run) FILTER (run <= need) AS filled FROM o GROUP BY o.source),
g AS (SELECT o.*, coalesce(f.filled, 0) AS filled, zo.lo, zo.hi
      FROM o JOIN f ON f.source IS NOT DISTINCT FROM o.source
      LEFT JOIN zo ON zo.source IS NOT DISTINCT FROM o.source),
fit AS (SELECT source, doc_id, size, q FROM g
        WHERE run > need AND bin BETWEEN lo AND hi AND abs(need - filled - size) < need - filled
        QUALIFY row_number() OVER (PARTITION BY source
                ORDER BY abs(need - filled - size), q, coalesce(doc_id, -1), size) = 1),
mix AS (SELECT b.doc_id, b.source, b.size, b.source_size, b.target,
               b.whole + (coalesce(g.run <= g.need, false) OR fit.doc_id IS NOT NULL)::BIGINT AS copies
        FROM b LEFT JOIN g ON g.doc_id = b.doc_id LEFT JOIN fit ON fit.doc_id = b.doc_id)"""

ORACLE = f"""WITH {_MIX_SQL.strip()}
SELECT doc_id, size, source_size, target, copies * size AS taken FROM mix"""
