"""A table with a key, kept in hash buckets, so that a merge touches only the buckets
that hold a redelivered key (A7, A8).

Every commit writes a *segment*: parquet files below ``_bucket=<b>`` folders, one file for
each bucket.  The pointer of a version lists the live (segment, bucket) entries with their
rows and key range, so it is bounded by the number of buckets and of files in one.  Beside
its data a segment keeps a Bloom filter of its keys for each bucket, as a table of blocks
of 256 bits that is probed by a join.

A merge asks, from cheap to dear:

1. which entries' key ranges overlap the source's keys of their bucket (pointer only);
2. which of those may hold a source key (one block of the filter for each source key);
3. which really do (the key column of those entries alone).

Buckets with a match are written anew, the others only gain the source's rows as a file.
A bucket of ``max_files`` files is merged into one on the way, and when buckets hold more
than ``rows_per_bucket`` rows on average their number doubles.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.sizing import DEFAULT_BROADCAST_MAX_ROWS
from tessera.sources.tables import StaleVersion, VersionedTable

BUCKET = "_bucket"
#: Bloom filter: blocks of four longs, two bits in each are set by a key; bits for each
#: key on average (false hits: about one key in ten thousand).
BLOCK_BITS, BITS_PER_KEY, WORDS = 256, 24, 4
#: A source of more than this part of the rows in question skips the filter, as nearly every entry would be hit.
BLOOM_SHARE = 8
_BLOOM = "seg string, bucket int, block bigint, " + ", ".join(f"w{i} bigint" for i in range(WORDS))


@dataclass
class Merge:
    """What a merge did: append, rewrite or noop; which buckets were written anew and why."""

    mode: str
    rewritten: list[int] = field(default_factory=list)
    compacted: list[int] = field(default_factory=list)
    probed: int = 0
    version: int = 0


class KeyedTable(VersionedTable):
    """``filter_rows``: entries of fewer rows have no filter, as reading their keys costs no more."""

    def __init__(self, spark: SparkSession, path: str, key: str | list[str], buckets: int = 8,
                 rows_per_bucket: int = 4_000_000, max_files: int = 8, filter_rows: int = 100_000):
        super().__init__(spark, path)
        self.key = [key] if isinstance(key, str) else list(key)
        self.buckets, self.rows_per_bucket, self.max_files = buckets, rows_per_bucket, max_files
        self.filter_rows = filter_rows

    # ------------------------------------------------------------------ layout
    def entries(self, state: dict | None = None) -> list[dict]:
        """Live (segment, bucket) entries: seg, bucket, rows, blocks (of the filter), lo, hi."""
        return (state or self._state()).get("entries", [])

    def _dirs(self, state: dict) -> list[str]:
        return [self._dir(e) for e in self.entries(state)]

    @staticmethod
    def _dir(entry: dict) -> str:
        return f"{entry['seg']}/{BUCKET}={entry['bucket']}"

    def bucket_count(self, state: dict | None = None) -> int:
        return int((state or self._state()).get("buckets") or self.buckets)

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(buckets)).cast("int")

    def _read_entries(self, entries: list[dict], schema: T.StructType) -> DataFrame:
        if not entries:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{self._dir(e)}" for e in entries])

    def _stage_buckets(self, df: DataFrame, buckets: int, metrics: list | None = None) -> tuple[str, dict]:
        """Stage ``df`` with one file for each bucket that has rows."""
        dealt = df.withColumn(BUCKET, self._bucket(buckets)).repartitionById(buckets, F.col(BUCKET))
        return self.stage_observed(dealt, metrics, partition_by=[BUCKET])

    def _staged(self, seg: str, schema: T.StructType) -> DataFrame:
        whole = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(whole).parquet(f"{self.path}/{seg}")

    def _describe(self, seg: str, staged: DataFrame) -> tuple[list[dict], int]:
        """Entries of a staged segment and the most rows of one key; at most a row a bucket."""
        ranged = staged.schema[self.key[0]].dataType
        ends = [F.min(self.key[0]), F.max(self.key[0])] if isinstance(ranged, (T.IntegralType, T.StringType)) else [F.lit(None)] * 2
        rows = (staged.groupBy(BUCKET, *self.key).agg(F.count(F.lit(1)).alias("n")).groupBy(BUCKET)
                .agg(F.sum("n").alias("rows"), F.max("n").alias("most"), ends[0].alias("lo"), ends[1].alias("hi")).collect())
        entries = [{"seg": seg, "bucket": r[BUCKET], "rows": r["rows"], "blocks": -(-r["rows"] * BITS_PER_KEY // BLOCK_BITS) if r["rows"] >= self.filter_rows else 0,
                    "lo": r["lo"], "hi": r["hi"]} for r in sorted(rows, key=lambda r: r[BUCKET])]
        return entries, max((r["most"] for r in rows), default=0)

    # ------------------------------------------------------------ Bloom filters
    def _marked(self, keys: DataFrame) -> DataFrame:
        """``keys`` (bucket, blocks, key columns) with their block and the bits they set in it."""
        h = F.xxhash64(*self.key, F.lit(1))
        bit = lambda i: F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        one = lambda i: F.call_function("shiftleft", F.lit(1).cast("bigint"), bit(i))
        return (keys.withColumn("block", F.pmod(F.xxhash64(*self.key, F.lit(2)), F.col("blocks")))
                .withColumns({f"m{i}": one(2 * i).bitwiseOR(one(2 * i + 1)) for i in range(WORDS)}))

    def _small(self, entries: list[dict]) -> DataFrame:
        """Entries as a frame to broadcast: at most buckets * max_files rows."""
        return F.broadcast(self.spark.createDataFrame([(e["seg"], e["bucket"], e["blocks"]) for e in entries],
                                                      "seg string, bucket int, blocks bigint"))

    def _write_bloom(self, seg: str, staged: DataFrame, entries: list[dict]) -> None:
        entries = [e for e in entries if e["blocks"]]
        if not entries:
            return
        keys = staged.select(F.col(BUCKET).alias("bucket"), *self.key).join(self._small(entries), "bucket")
        (self._marked(keys).groupBy("seg", "bucket", "block")
         .agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(WORDS)])
         .write.mode("overwrite").parquet(f"{self.path}/{seg}/_bloom"))

    def may_match(self, keys: DataFrame, entries: list[dict]) -> set[tuple[str, int]]:
        """(seg, bucket) of entries whose filter holds a key of ``keys`` (_bucket, key columns), and
        of those without a filter."""
        open_ = {(e["seg"], e["bucket"]) for e in entries if not e["blocks"]}
        entries = [e for e in entries if e["blocks"]]
        if not entries:
            return open_
        segs = sorted({e["seg"] for e in entries})
        bloom = self.spark.read.schema(_BLOOM).parquet(*[f"{self.path}/{s}/_bloom" for s in segs])
        asked = self._marked(keys.withColumnRenamed(BUCKET, "bucket").join(self._small(entries), "bucket"))
        hit = asked.join(bloom, ["seg", "bucket", "block"])
        for i in range(WORDS):
            hit = hit.filter(F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}"))
        return open_ | {(r["seg"], r["bucket"]) for r in hit.select("seg", "bucket").distinct().collect()}

    # ---------------------------------------------------------------- the merge
    def merge(self, source: DataFrame, on_duplicate: str = "error", marks=lambda observed, old: old,
              metrics: list | None = None, broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS,
              attempts: int = 5) -> Merge:
        """Rows of ``source`` replace rows of equal key and are added otherwise.

        The source is computed once, while it is staged with the observed ``metrics``;
        ``marks(observed, marks so far)`` gives the marks to commit.  A null key equals no
        key.  If another writer commits first, the merge is decided again on its version;
        the staged rows stay.
        """
        state = self._state()
        buckets = self._grown(state)
        seg, observed = self._stage_buckets(source, buckets, metrics)
        staged = self._staged(seg, source.schema)
        new, most = self._describe(seg, staged)
        if not new:
            return Merge("noop", version=state["version"])
        if most > 1 and on_duplicate == "error":
            raise ValueError(f"source holds a key more than once (max {most} rows)")
        self._write_bloom(seg, staged, new)
        small = broadcast_max_rows is not None and sum(e["rows"] for e in new) <= broadcast_max_rows
        for attempt in range(attempts):
            state = self._state()
            if state.get("entries") and buckets != self._grown(state):  # another writer dealt the table anew
                buckets = self._grown(state)
                seg, observed = self._stage_buckets(source, buckets, metrics)
                staged = self._staged(seg, source.schema)
                new, _ = self._describe(seg, staged)
                self._write_bloom(seg, staged, new)
            try:
                return self._commit(state, buckets, staged, new, small, source.schema, marks(observed, state.get("marks")))
            except StaleVersion:
                if attempt + 1 == attempts:
                    raise
        raise AssertionError("not reached")

    def _grown(self, state: dict) -> int:
        """Buckets for the rows that the table has: doubled until they hold few enough on average."""
        buckets, rows = self.bucket_count(state), sum(e["rows"] for e in self.entries(state))
        while rows > buckets * self.rows_per_bucket:
            buckets *= 2
        return buckets

    def _commit(self, state: dict, buckets: int, staged: DataFrame, new: list[dict], small: bool,
                schema: T.StructType, marks: dict | None) -> Merge:
        old, by_bucket = self.entries(state), {e["bucket"]: e for e in new}
        regrouped = bool(old) and buckets != self.bucket_count(state)
        keys = staged.select(BUCKET, *self.key)
        table_schema = T.StructType.fromJson(json.loads(state["schema"])) if state.get("schema") else schema
        done = Merge("append")
        if regrouped:
            rewrite = set(range(buckets))
        else:
            near = [e for e in old if e["bucket"] in by_bucket and _overlap(e, by_bucket[e["bucket"]])]
            if near and sum(e["rows"] for e in new) * BLOOM_SHARE < sum(e["rows"] for e in near):
                hit = self.may_match(keys, near)
                near = [e for e in near if (e["seg"], e["bucket"]) in hit]
            done.probed = len(near)
            rewrite = self._matched(near, keys, small, table_schema, buckets) if near else set()
            files: dict[int, int] = {}
            for e in old:
                files[e["bucket"]] = files.get(e["bucket"], 0) + 1
            done.compacted = sorted(b for b in by_bucket if b not in rewrite and files.get(b, 0) + 1 > self.max_files)
        done.rewritten = sorted(rewrite)
        rewrite |= set(done.compacted)
        entries = [e for e in old if e["bucket"] not in rewrite and not regrouped]
        entries += [e for e in new if e["bucket"] not in rewrite]
        if rewrite:
            done.mode = "rewrite" if done.rewritten else "append"
            some = [e for e in old if regrouped or e["bucket"] in rewrite]
            mine = staged if regrouped else staged.filter(F.col(BUCKET).isin(*rewrite))
            probe = F.broadcast(mine.select(*self.key)) if small else mine.select(*self.key)
            kept = self._read_entries(some, table_schema).join(probe, self.key, "left_anti")
            rows = kept.select(*table_schema.names).unionByName(mine.drop(BUCKET), allowMissingColumns=False)
            seg, _ = self._stage_buckets(rows, buckets)
            whole = self._staged(seg, rows.schema)
            fresh, _ = self._describe(seg, whole)
            self._write_bloom(seg, whole, fresh)
            entries += fresh
        self._publish([], schema, marks, state["version"], extra={"entries": entries, "buckets": buckets, "key": self.key},
                      appends=not rewrite)
        done.version = state["version"] + 1
        return done

    def _matched(self, near: list[dict], keys: DataFrame, small: bool, schema: T.StructType, buckets: int) -> set[int]:
        """Buckets in which an entry of ``near`` holds a source key; reads their key columns only."""
        have = self._read_entries(near, T.StructType([schema[k] for k in self.key]))
        asked = keys.select(*self.key)
        hits = have.join(F.broadcast(asked) if small else asked, self.key, "left_semi")
        return {r[BUCKET] for r in hits.select(self._bucket(buckets).alias(BUCKET)).distinct().collect()}


def _overlap(a: dict, b: dict) -> bool:
    """Whether two entries' key ranges meet; an unknown range meets all."""
    if a["lo"] is None or b["lo"] is None:
        return True
    return a["lo"] <= b["hi"] and b["lo"] <= a["hi"]
