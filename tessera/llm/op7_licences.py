"""Licence scan: Dice coefficient over word bigrams against licence templates.

DataFrame functions only.  The units of a text are its sentences and lines and,
in case it is nothing but a notice, the whole text.  Units and templates are
normalised (A-Z lower-cased, words of letters, digits and non-ASCII characters)
and become sets of word bigrams.  A unit is a notice of a template if

    2 * common / (unit's bigrams + template's bigrams) >= THRESHOLD.

Size bounds prune first: a unit of n words can only reach the threshold with a
template of between ``t / (2 - t)`` and ``(2 - t) / t`` times its bigrams, so units
outside the range of all templates never leave their row, nor do units that share
no bigram with any template (while the templates have at most ``MAX_SET`` bigrams,
which are then part of the plan). An equi-join on bigrams counts what is common;
both sides' sizes are compared again per pair before.

Notices that are no unit of their own (wrapped over lines, or with other words around)
are found by windows of words across all line and sentence ends.  A window begins and
ends with a bigram of a template, as the best one does, and has no more bigrams than
the bounds allow.  It counts if it touches no unit that matches and no window with a
better score.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import pick, written
from tessera.llm.op9_decontaminate import _words

THRESHOLD = 0.8
#: Template bigrams that may be part of the plan.
MAX_SET = 100_000

#: Short notices by licence; any table (licence, text) may take their place.
TEMPLATES = (
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use are permitted under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This work is subject to the Mozilla Public License, version 2.0."),
)


def _bigrams(words: str) -> str:
    return (f"array_distinct(transform(sequence(1, size({words}) - 1), "
            f"i -> concat(element_at({words}, i), ' ', element_at({words}, i + 1))))")


def _windows(grams: list[str], listed: str, least: int, most: int) -> str:
    """Windows (ws, at, touched) of the words ``all`` of the pieces ``us``.

    ``least``: template bigrams that a window has, ``most``: bigrams it may have;
    ``touched``: hashes of the pieces it has words of, and of the whole text.
    """
    known = ", ".join(f"'{w}'" for w in sorted({w for g in grams for w in g.split(" ")})) or "NULL"
    hits = ("filter(if(size(all) > 1, sequence(1, size(all) - 1), array()), i -> "
            f"all[i - 1] IN ({known}) AND all[i] IN ({known}) AND concat(all[i - 1], ' ', all[i]) IN ({listed}))")
    pairs = (f"flatten(transform(hs, (i, a) -> transform(filter(slice(hs, a + {least}, {most}), j -> j - i < {most}), "
             "j -> struct(i, j))))")
    window = ("struct(slice(all, p.i, p.j - p.i + 2) AS ws, p.i AS at, "
              "concat(transform(sequence(z.piece[p.i - 1], z.piece[p.j]), k -> z.hash[k]), array(z.whole)) AS touched)")
    around = ("struct(flatten(transform(us, (u, k) -> array_repeat(k, size(u)))) AS piece, "
              "transform(us, u -> xxhash64(u)) AS hash, xxhash64(all) AS whole)")
    return (f"flatten(transform(filter(array({hits}), hs -> size(hs) >= {least}), hs -> "
            f"transform(array({around}), z -> transform({pairs}, p -> {window}))[0]))")


def templates(spark: SparkSession, rows=TEMPLATES) -> DataFrame:
    """(licence, size, bigrams) of the templates that have two words or more."""
    df = spark.createDataFrame(list(rows), "licence string, text string")
    return (df.filter("licence IS NOT NULL AND text IS NOT NULL")
            .select("licence", F.expr(_words("text")).alias("ws")).filter("size(ws) > 1")
            .select("licence", F.expr(_bigrams("ws")).alias("bigrams"))
            .select("licence", F.size("bigrams").alias("size"), "bigrams"))


def scan(spark: SparkSession, docs: DataFrame, rows=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_matches, licences, best_licence, best_score) of every row.

    ``n_matches``: units that match, equal ones counted once; ``licences``: the ids of
    all matching templates, sorted and comma-joined; the best has the highest
    score, ties by the smaller id.  Null and empty texts match nothing.
    """
    known = written(spark, templates(spark, rows), "lic-templates")
    lo, hi = known.agg(F.min("size"), F.max("size")).first()
    ratio = (2 - threshold) / threshold + 1e-9  # the bounds may keep more, never less
    least, most = (2, 1) if lo is None else (math.ceil(lo / ratio) + 1, math.floor(hi * ratio))
    texts = pick(docs, doc_id="doc_id", text="text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    pieces = r"split(regexp_replace(text, '([.!?])[\\x20\\x09-\\x0D]+', '$1\n'), '[\\x0A-\\x0D]+')"
    cut = f"transform({pieces}, u -> {_words('u')})"
    # sentence ends and line breaks are no word characters: the pieces' words are the text's.
    # n words make at most n - 1 bigrams, and at least as many as they have distinct words less one
    fits = (f"size(ws) >= {least} AND (size(ws) <= {most + 1} OR size(array_distinct(ws)) <= {most + 1} "
            f"AND size({_bigrams('ws')}) <= {most})")
    grams = sorted(r.g for r in known.select(F.explode("bigrams").alias("g")).distinct().collect())
    listed = ", ".join(f"'{g}'" for g in grams) or "NULL"   # of word characters and blanks only
    if (known.agg(F.sum("size")).first()[0] or 0) <= MAX_SET:
        fits += f" AND exists({_bigrams('ws')}, g -> g IN ({listed}))"
    units = (f"transform(filter(array_distinct(concat(us, array(all))), ws -> {fits}), "
             "ws -> struct(ws, 0 AS at, array(xxhash64(ws)) AS touched))")
    wide = _windows(grams, listed, max(1, math.ceil((lo or 1) / ratio)), most)
    scanned = written(spark, texts.select("doc_id", F.xxhash64("text").alias("digest"), F.expr(
        f"transform(array({cut}), us -> transform(array(flatten(us)), all -> concat({units}, {wide}))[0])[0]"
    ).alias("units")), "lic-units")
    unit = (scanned.filter("size(units) > 0").groupBy("doc_id", "digest").agg(F.first("units").alias("units"))
            .select("doc_id", "digest", F.posexplode("units").alias("unit", "u"))
            .select("doc_id", "digest", "unit", "u.at", F.size("u.ws").alias("len"), "u.touched",
                    F.xxhash64("u.ws").alias("words"), F.expr(_bigrams("u.ws")).alias("bigrams")))
    place = ["doc_id", "digest", "unit", "at", "len", "touched", "words"]
    bigrams = unit.select(*place, F.size("bigrams").alias("n"), F.explode("bigrams").alias("bigram"))
    common = (bigrams.join(known.select("licence", "size", F.explode("bigrams").alias("bigram")), "bigram")
              .filter((F.col("n") <= ratio * F.col("size")) & (F.col("size") <= ratio * F.col("n")))
              .groupBy(*place, "licence", "n", "size").agg(F.count("*").alias("c"))
              .withColumn("score", 2 * F.col("c") / (F.col("n") + F.col("size"))).filter(F.col("score") >= threshold))
    matches = common.groupBy(*place).agg(
        F.min(F.struct((-F.col("score")).alias("minus"), "licence")).alias("best"), F.collect_set("licence").alias("licences"))
    # a window's order: the better score, then the earlier, then the shorter
    found = (matches.groupBy("doc_id", "digest").agg(F.collect_list(F.struct(
                 F.col("best.minus").alias("minus"), "at", "len", "words", "touched", "licences", "best")).alias("ms"))
             .withColumn("us", F.expr("filter(ms, m -> m.at = 0)"))
             .withColumn("taken", F.expr("flatten(transform(us, m -> m.touched))"))
             .withColumn("ws", F.expr("array_sort(filter(ms, m -> m.at > 0 AND NOT arrays_overlap(m.touched, taken)))"))
             .withColumn("ws", F.expr(
                 "aggregate(ws, filter(ws, w -> false), (kept, w) -> if(exists(kept, k -> k.at < w.at + w.len "
                 "AND w.at < k.at + k.len), kept, concat(kept, array(w))))"))
             .withColumn("ms", F.concat("us", "ws"))
             .select("doc_id", "digest", F.expr("size(array_distinct(transform(ms, m -> m.words)))").cast("bigint").alias("n_matches"),
                     F.expr("array_join(array_sort(array_distinct(flatten(transform(ms, m -> m.licences)))), ',')").alias("licences"),
                     F.expr("array_min(transform(ms, m -> m.best))").alias("best")))
    t, f = scanned.select("doc_id", "digest").alias("t"), found.alias("f")
    both = t.join(f, F.col("t.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("t.digest") == F.col("f.digest")), "left")
    return both.select("t.doc_id", F.coalesce("n_matches", F.lit(0)).cast("bigint").alias("n_matches"),
                       F.coalesce("licences", F.lit("")).alias("licences"), F.col("best.licence").alias("best_licence"),
                       F.coalesce(-F.col("best.minus"), F.lit(0.0)).alias("best_score"))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every text of ``documents``."""
    return scan(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


_ROWS = ", ".join(f"('{a}', '{b}')" for a, b in TEMPLATES)
_CUT = ("regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
_PAIRS = "list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))"
ORACLE = f"""
WITH t AS (SELECT licence, {_PAIRS} AS g FROM (SELECT licence, {_CUT.format('text')} AS ws
           FROM (VALUES {_ROWS}) v(licence, text))),
u AS (SELECT DISTINCT doc_id, unit FROM (
        SELECT doc_id, unnest(regexp_split_to_array(regexp_replace(coalesce(text, ''),
               '([.!?])[\\x20\\x09-\\x0D]+', '\\1\n', 'g'), '[\\x0A-\\x0D]+')) AS unit FROM documents
        UNION ALL SELECT doc_id, coalesce(text, '') FROM documents)),
w AS (SELECT DISTINCT doc_id, {_CUT.format('unit')} AS ws FROM u),
g AS (SELECT doc_id, ws AS unit, {_PAIRS} AS g FROM w WHERE len(ws) > 1),
m AS (SELECT doc_id, unit, licence, 2 * len(list_intersect(g.g, t.g)) / (len(g.g) + len(t.g)) AS score
      FROM g JOIN t ON len(g.g) <= 1.5 * len(t.g) AND len(t.g) <= 1.5 * len(g.g)),
f AS (SELECT doc_id, count(DISTINCT unit) AS n_matches, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences,
             first(licence ORDER BY score DESC, licence) AS best_licence, max(score) AS best_score
      FROM m WHERE score >= {THRESHOLD} GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_matches, 0)::BIGINT AS n_matches, coalesce(licences, '') AS licences, best_licence,
       coalesce(best_score, 0.0::DOUBLE) AS best_score
FROM documents d LEFT JOIN f USING (doc_id)"""
