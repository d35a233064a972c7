"""Mixing sources to target weights by Pareto order sampling, on DataFrame functions only.

A source's target is its weight's share of all words, at most ``max_repeat`` times its own words;
what it cannot take is shared again by weight. A document of a source with target / size = r is
taken whole ``floor(r)`` times. The words that then remain are filled with one further copy of some documents. Their
inclusion probabilities follow their sizes, capped at 1, and add up to the remaining words; or they are the
fraction of r times a ``factor`` of the caller's. Documents are ranked by their random odds divided by the odds of that
probability and taken in this Pareto order, smallest first, while they fit into the words that remain: one that
is too long is passed over, and the order goes on behind it, until no document left would fit. The last place goes to
the document whose size is nearest to the words still missing, if that brings the source nearer to its target. So a source
misses its target by less than the shortest document that it leaves out.

The random number of a document is a hash of its id and the seed, so reruns agree; for a row
without an id, of its source, text and place among its copies. No source is ever sorted: ranks are cut into bins per source,
the words of whole bins are summed, and only the bin in which the words run out is put in order; behind the
first document that does not fit only the next ``NEXT`` that may are looked at, one step of the loop after another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import SPACE_CHARS, documents, prepare, stored
from tessera.operators.streams import free_name

BIN_ROWS = 16_384  # rows of the largest source that a bin should hold, about
BINS = 1024        # bins of a source at least
NEXT = 1024        # documents that are looked at together behind the first that does not fit
MAX_REPEAT = 3
SEED = "mix-1"


def word_count(text: Column) -> Column:
    """Words (runs without blanks) of a text; 0 for null."""
    flat = F.translate(F.coalesce(text, F.lit("")), SPACE_CHARS, " " * len(SPACE_CHARS))
    flat = F.trim(flat)
    return F.when(flat == "", 0).otherwise(F.size(F.split(flat, " +"))).cast("long")


def cyclic_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """``sources`` with ``weight`` 1..cycle, repeating, by source in code point order, null last.
    One row per source: the only thing that is numbered in one task."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    return sources.withColumn("weight", ((F.row_number().over(order) - 1) % cycle + 1).cast("double"))


def targets(sources: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, weight) -> with ``target``.

    Filling to a level: a source stops at its cap if the cap lies below its weight's part of what
    the sources with no smaller cap per weight still share. In order of cap per weight the stopped
    ones come first, so one running sum finds the level."""
    cap = (max_repeat * F.col("source_size")).cast("double")
    full = Window.partitionBy()
    per_weight = F.when(F.col("weight") > 0, F.col("cap") / F.col("weight"))
    order = Window.orderBy(per_weight.asc_nulls_last(), F.col("source").asc_nulls_last())
    rows = sources.withColumn("cap", cap).withColumn("pos", F.row_number().over(order))
    before = Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumn("left", F.sum("source_size").over(full) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            .withColumn("share", F.sum("weight").over(full) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
            .withColumn("stops", F.col("cap") * F.col("share") < F.col("left") * F.col("weight")))
    # what is left once all that stop have stopped: at the first source that does not
    level = F.min(F.when(~F.col("stops") & (F.col("share") > 0), F.struct("pos", "left", "share"))).over(full)
    part = F.col("level.left") * F.col("weight") / F.col("level.share")
    return (rows.withColumn("level", level)
            .withColumn("target", F.when(F.col("stops"), F.col("cap")).when(
                F.col("weight") > 0, F.least(F.col("cap"), part)).otherwise(0.0))
            .drop("cap", "pos", "left", "share", "stops", "level"))


def uniform(key: Column, seed: str) -> Column:
    """A number inside (0, 1) from a hash of ``key``."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def identity(*columns: Column) -> Column:
    """128 bits (hex) that stand for the values of ``columns``; null differs from the empty text."""
    return F.md5(F.concat(*[F.coalesce(F.md5(c.cast("string")), F.lit("-")) for c in columns]))


def numbered(rows: DataFrame, key: str, row: str, place: str) -> DataFrame:
    """``rows`` with a row's ``place`` from 0 among those of equal ``key``, by ``row`` (made by
    monotonically_increasing_id and written since). Rows are numbered within each partition of that
    writing and the partitions' counts added up, so that a hot key is not numbered in one task."""
    part = free_name("part", rows.columns, [place])
    rows = rows.withColumn(part, F.shiftright(row, 33))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(F.col(key).alias("key"), F.col(part).alias("part")).agg(F.count("*").alias("n")).select(
        "key", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    local = F.row_number().over(Window.partitionBy(key, part).orderBy(row)) - 1
    same = (F.col(f"l.{key}") == F.col("r.key")) & (F.col(f"l.{part}") == F.col("r.part"))
    return (rows.withColumn(place, local).alias("l").join(parts.alias("r"), same)
            .select(*[F.col(f"l.`{c}`").alias(c) for c in rows.columns if c != part],
                    (F.col(f"l.{place}") + F.col("r.before")).alias(place)))


def mix(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) of every row of ``docs``; ``options`` are
    those of ``decide``."""
    return decide(docs, **options).drop("same")


def decide(docs: DataFrame, max_repeat: int = MAX_REPEAT, seed: str = SEED, bins: int | None = None,
           id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights: DataFrame | None = None, factor: Column | None = None) -> DataFrame:
    """``mix`` with ``same``, the ``identity`` of a row's id, source, text and factor.

    ``weights`` (source, weight) replaces the cyclic weights; a source that it lacks weighs 0.
    ``factor`` times the fraction of r replaces the inclusion probabilities by size. Null texts have size 0, null ids and
    null sources are values like any other; a document without words is never taken. Rows that
    share an id share a random number and are ordered by size and text hash; each row without an id
    has its own; repeated rows are ordered arbitrarily among themselves, which gives the same result
    rows. An empty table gives an empty result. Other columns are ignored."""
    prepare(docs)
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        word_count(text).alias("size"), _same(id_col, source_col, text_col, factor).alias("same"),
        uniform(F.col(id_col).cast("string"), seed).alias("u"),
        (F.lit(None) if factor is None else factor).cast("double").alias("factor"),
        F.monotonically_increasing_id().alias("row")).checkpoint()
    nameless = rows.where("doc_id IS NULL")
    if not nameless.isEmpty():
        place = F.concat(F.lit("-"), F.col("same"), F.lit(":"), F.col("at").cast("string"))
        own = numbered(nameless, "same", "row", "at").withColumn("u", uniform(place, seed)).drop("at")
        rows = rows.where("doc_id IS NOT NULL").unionByName(own).checkpoint()
    known = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    if weights is None:
        known = cyclic_weights(known)
    else:
        known = known.join(weights.select(F.col("source").alias("_s"), "weight"),
                           F.col("source").eqNullSafe(F.col("_s")), "left").select(
            "source", "source_size", "rows", F.coalesce("weight", F.lit(0.0)).cast("double").alias("weight"))
    plan = targets(known, max_repeat)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = (plan.withColumn("whole", F.floor(ratio)).withColumn("chance", ratio - F.col("whole"))
            .withColumn("words", F.col("target") - F.col("whole") * F.col("source_size")))
    plan = plan.withColumnRenamed("source", "_s").checkpoint()
    if bins is None:
        bins = max(BINS, (plan.agg(F.max("rows")).first()[0] or 0) // BIN_ROWS)
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "rows", "weight")
    if factor is None:
        by_size = _by_size(rows).select(F.col("source").alias("_s"), "per_word")
        rows = rows.join(by_size, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
        p = F.coalesce("per_word", F.lit(0.0)) * F.col("size")
    else:
        p = F.col("chance") * F.col("factor")
    p = F.least(p, F.lit(1.0 - 1e-9))
    odds = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
    open_ = (F.col("size") > 0) & (p > 0) & (F.col("words") > 0)
    # rank in (0, 1): the same order as the odds
    rank = F.when(open_, odds / (1 + odds))
    place = F.struct(F.col("rank"), "doc_id", "size", "same", "row")
    rows = (rows.withColumn("rank", rank)
            .withColumn("bin", F.least(F.floor(F.col("rank") * bins), F.lit(bins - 1)).cast("int"))
            .withColumn("at", F.when(F.col("rank").isNotNull(), place))
            .select("doc_id", "source", "size", "source_size", "target", "whole", "words", "same", "row", "bin", "at").checkpoint())

    stretch, behind = _first_fit(rows.where("at IS NOT NULL").select("source", "size", "words", "bin", "at"))
    both = (rows.join(stretch, F.col("source").eqNullSafe(F.col("_s")), "left")
            .join(behind.withColumn("fits", F.lit(True)), "row", "left"))
    before = (F.col("size") <= F.col("gap")) & (F.col("end").isNull() | (F.col("at") < F.col("end")))
    extra = F.col("at").isNotNull() & (F.coalesce(before, F.lit(False)) | F.coalesce("fits", F.lit(False)))
    both = both.withColumn("extra", extra.cast("int")).drop("_s", "gap", "end", "fits")

    gaps = (both.where("at IS NOT NULL").groupBy("source").agg(
        (F.first("words") - F.sum(F.col("size") * F.col("extra"))).alias("gap"))
        .select(F.col("source").alias("_s"), "gap"))
    both = both.join(gaps, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    fills = (both.where("extra = 0 AND at IS NOT NULL AND size < 2 * gap").groupBy("source")
             .agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")), "at")).alias("best"))
             .select(F.col("best.at.row").alias("row"), F.lit(1).alias("fill")))
    both = both.join(fills, "row", "left")
    extra = F.col("extra") + F.coalesce("fill", F.lit(0))
    copies = F.when(F.col("size") > 0, F.col("whole") + extra).otherwise(0).cast("long")
    return both.select("doc_id", "size", "source_size", "target", copies.alias("copies"),
                       (copies * F.col("size")).alias("taken"), "same")


def _by_size(rows: DataFrame) -> DataFrame:
    """(source, per_word): the inclusion probability of a word, so that ``min(1, per_word * size)`` copies of all documents
    hold the source's remaining words. In order of size, largest first, the documents that are certain come first:
    the first size that is not shows the number. Only one row per (source, size) is put in order."""
    sizes = rows.where("size > 0 AND words > 0").groupBy("source", "size").agg(
        F.count("*").alias("n"), F.first("words").alias("words"))
    longer = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    shorter = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(0, Window.unboundedFollowing)
    wide = F.col("size").cast("decimal(19,0)")
    held = F.col("words") - F.coalesce(F.sum(F.col("n") * F.col("size")).over(longer), F.lit(0)).cast("double")
    per_word = held / F.sum((wide * wide * F.col("n")).cast("decimal(38,0)")).over(shorter).cast("double")
    found = sizes.withColumn("per_word", per_word).where(F.col("per_word") * F.col("size") <= 1)
    return found.groupBy("source").agg(F.greatest(F.max_by("per_word", "size"), F.lit(0.0)).alias("per_word"))


def _first_fit(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Which documents fit, in Pareto order (``at``): (_s, gap, end) per source -- all of up to ``gap`` words in front of ``end``
    (null: all) -- and (row) of those that fit behind it.

    The first document that does not fit ends the stretch that bins find. What is behind it and fits is found from
    the next ``NEXT`` documents that may, in order, and again from where these end while words are left."""
    state = rows.groupBy(F.col("source").alias("_s")).agg(F.first("words").alias("words"))
    fitting = rows.where(F.col("size") <= F.col("words"))
    by_bin = fitting.groupBy(F.col("source").alias("_s"), "bin").agg(F.sum("size").alias("bin_size"), F.first("words").alias("words"))
    run = Window.partitionBy("_s").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    edge = (by_bin.withColumn("upto", F.sum("bin_size").over(run)).where("upto > words").groupBy("_s")
            .agg(F.min(F.struct("bin", (F.col("upto") - F.col("bin_size")).alias("done"))).alias("e"))
            .select("_s", F.col("e.bin").alias("edge"), F.col("e.done").alias("done")))
    # only in the bin where the words run out are documents put in order
    order = Window.partitionBy("source").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    inside = (fitting.join(edge, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bin") == F.col("edge")))
              .withColumn("upto", F.col("done") + F.sum("size").over(order)).where("upto > words"))
    ends = inside.groupBy(F.col("source").alias("_e")).agg(
        F.min("at").alias("end"), F.min_by(F.col("upto") - F.col("size"), "at").alias("taken"))
    first = state.join(ends, F.col("_s").eqNullSafe(F.col("_e")), "left").select("_s", "words", "end", "taken").checkpoint()

    state = first.where("end IS NOT NULL").select("_s", "words", "taken", F.col("end").alias("start"))
    chosen = first.select(F.col("end.row").alias("row")).limit(0)
    while True:
        state = state.where("words - taken >= 1")
        if state.isEmpty():
            return first.select("_s", F.col("words").alias("gap"), "end"), chosen
        left = F.col("words") - F.col("taken")
        fitting = (rows.drop("words").join(state, F.col("source").eqNullSafe(F.col("_s")))
                   .where((F.col("size") <= left) & (F.col("at") > F.col("start"))))
        place = F.row_number().over(Window.partitionBy("_s").orderBy("at"))
        following = (fitting.withColumn("place", place).where(F.col("place") <= NEXT).groupBy("_s")
                     .agg(F.first("words").alias("words"), F.first("taken").alias("taken"),
                          F.sort_array(F.collect_list(F.struct("at", "size"))).alias("docs")))

        def take(acc: Column, x: Column) -> Column:
            fits = x["size"] <= acc["words"] - acc["taken"]
            return F.when(fits, F.struct(acc["words"].alias("words"), (acc["taken"] + x["size"]).alias("taken"),
                                         F.concat(acc["rows"], F.array(x["at"]["row"])).alias("rows"))).otherwise(acc)

        begin = F.struct(F.col("words").alias("words"), F.col("taken").alias("taken"),
                         F.array().cast("array<bigint>").alias("rows"))
        done = following.select("_s", F.size("docs").alias("n"), F.element_at("docs", -1)["at"].alias("last"),
                                F.aggregate("docs", begin, take).alias("got")).checkpoint()
        chosen = chosen.union(done.select(F.explode("got.rows").alias("row")))
        state = done.where(F.col("n") == NEXT).select("_s", F.col("got.words").alias("words"),
                                                      F.col("got.taken").alias("taken"), F.col("last").alias("start"))


def _same(id_col: str, source_col: str, text_col: str, factor: Column | None) -> Column:
    return identity(F.col(id_col), F.col(source_col), F.col(text_col), *([] if factor is None else [factor]))


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             factor: Column | None = None, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``mix`` takes it, with its own columns.

    A row's copies are found by the identity of its id, source, text and factor. Rows that are equal
    in all of these are one document to the mix: where it takes some of them once more than the
    others, as many of them are taken once more. Columns are those of ``docs``, whatever their names."""
    columns = {"id_col": id_col, "text_col": text_col, "source_col": source_col, "factor": factor}
    same, row, at, least, most, more, copies, copy = (
        free_name(n, docs.columns) for n in ("_same", "_row", "_at", "_least", "_most", "_more", "_copies", "_copy"))
    per_key = stored(decide(docs, **columns, **options).groupBy(F.col("same").alias(same)).agg(
        F.min("copies").alias(least), F.max("copies").alias(most),
        (F.sum("copies") - F.count("*") * F.min("copies")).alias(more)).where(F.col(most) > 0), "copies")
    joined = docs.withColumn(same, _same(id_col, source_col, text_col, factor)).join(per_key, same)
    copied = joined.where(F.col(least) == F.col(most)).withColumn(copies, F.col(least))
    if not per_key.where(F.col(least) < F.col(most)).isEmpty():
        some = stored(joined.where(F.col(least) < F.col(most)).withColumn(row, F.monotonically_increasing_id()), "shared")
        some = numbered(some, same, row, at).withColumn(copies, F.col(least) + (F.col(at) < F.col(more)).cast("long"))
        copied = copied.unionByName(some.drop(row, at))
    return (copied.where(F.col(copies) > 0)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


OP10_SQL = r"""
WITH d AS (
    SELECT doc_id, source,
           len([x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''])::BIGINT AS size,
           (('0x' || substr(md5('mix-1:' || doc_id), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
    FROM documents),
s AS (
    SELECT source, sum(size)::BIGINT AS source_size, 3.0::DOUBLE * sum(size)::DOUBLE AS cap,
           ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
    FROM d GROUP BY source),
o AS (
    SELECT *, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS pos FROM s),
l AS (
    SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0) AS rest,
           sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS share
    FROM o WINDOW w AS (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
    SELECT *, CASE WHEN cap * share < rest * weight THEN cap ELSE least(cap,
               (SELECT rest FROM l WHERE NOT cap * share < rest * weight ORDER BY pos LIMIT 1) * weight
               / (SELECT share FROM l WHERE NOT cap * share < rest * weight ORDER BY pos LIMIT 1)) END AS target
    FROM l),
p AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
           CASE WHEN source_size > 0 THEN target / source_size - floor(target / source_size) ELSE 0 END AS chance
    FROM t),
h AS (
    SELECT d.source AS source, size, count(*) AS n, any_value(target - whole * source_size) AS words
    FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
    WHERE size > 0 AND target - whole * source_size > 0 GROUP BY d.source, size),
k AS (
    SELECT source, size,
           (words - coalesce(sum(n * size) OVER (PARTITION BY source ORDER BY size DESC
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
           / (sum(n * size * size) OVER (PARTITION BY source ORDER BY size DESC
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS per_word
    FROM h),
c AS (
    SELECT source, greatest(arg_max(per_word, size), 0.0::DOUBLE) AS per_word FROM k WHERE per_word * size <= 1 GROUP BY source),
q AS (
    SELECT doc_id, size, u, source_size, target, whole, target - whole * source_size AS words, d.source AS source,
           least(coalesce(per_word, 0.0::DOUBLE) * size, (1.0 - 1e-9)::DOUBLE) AS chance
    FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN c ON d.source IS NOT DISTINCT FROM c.source),
j AS (
    SELECT *, CASE WHEN size > 0 AND chance > 0 AND words > 0
                   THEN (u / (1 - u)) / (chance / (1 - chance)) END AS odds
    FROM q),
f AS (
    SELECT source AS fit_source, any_value(words) AS fit_words, list_reduce(
        list({'doc': doc_id, 'size': size} ORDER BY odds / (1 + odds), doc_id),
        lambda a, x: CASE WHEN x.size <= any_words - a.sum
                          THEN {'sum': a.sum + x.size, 'docs': list_append(a.docs, x.doc)} ELSE a END,
        {'sum': 0::BIGINT, 'docs': []::BIGINT[]}) AS fit
    FROM (SELECT *, words AS any_words FROM j WHERE odds IS NOT NULL) GROUP BY source, any_words),
e AS (
    SELECT j.*, coalesce(list_contains(fit.docs, doc_id), false) AS taken_once, fit_words - fit.sum AS gap
    FROM j LEFT JOIN f ON source IS NOT DISTINCT FROM fit_source),
b AS (
    SELECT source AS best_source, arg_min(doc_id, (abs(size - gap), odds / (1 + odds), doc_id)) AS best
    FROM e WHERE odds IS NOT NULL AND NOT taken_once AND size < 2 * gap GROUP BY source)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0
            ELSE (whole + CASE WHEN taken_once OR coalesce(doc_id = best, false) THEN 1 ELSE 0 END)::BIGINT * size END AS taken
FROM e LEFT JOIN b ON source IS NOT DISTINCT FROM best_source
"""
