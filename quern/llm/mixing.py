"""Mixing sources to target weights by systematic sampling.

Sources in code point order (null last) weigh 5, 2, 1, 5, 2, 1, ... and share
150 % of all sizes; no target exceeds twice its source's size, and what a capped
source cannot take is shared again by weight. A document's expected copies are
its source's target over its source's size. Within a source the documents stand
in one fixed order; the expected copies are summed along it, one random offset
(fixed by the seed) is added, and a document is emitted once per integer that
its stretch of the sum crosses.

Half of a source's documents (by digest) stand first, in rising size classes, the
others after them in falling ones. Neighbours so have about the same size, what one
gains by rounding the next one loses, and the offset's own part cancels between the
halves. Texts are read once; rows are then numbered by sorting in ranges, a row's number in the input
last, so no task sorts a whole source and rows that are alike in everything are spread too.

Defined cases: a null text has size 0; a null source is a source of its own,
the last one; a source without words has target 0 and its documents zero expected
copies; repeated rows each have a place of their own in the order; an empty
table gives an empty result; columns that are not asked for are ignored; ``mixed`` keeps all columns,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.operators.explore import with_index
from quern.plans.scratch import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
#: The one random offset, drawn once for this seed: random.Random(20).random() to four digits.
OFFSET = 0.9056
RISING = 1_000_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """sizes: one row per source (source, source_size). Adds target; water filling in closed form.

    In the order of cap over weight the capped sources come first, so one pass of prefix sums finds the level.
    The input has a row per source, so the windows without a partition are over few rows.
    """
    k = len(weights)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(k)) + 1).cast("int")).cast("long")
    everything = Window.partitionBy()
    ranked = sizes.withColumn("w", w).withColumn("top", F.col("source_size") * cap)
    order = Window.orderBy((F.col("top") / F.col("w")).asc(), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        ranked.withColumn("budget", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("w_all", F.sum("w").over(everything))
        .withColumn("rest", F.col("budget") - F.coalesce(F.sum("top").over(order), F.lit(0)))
        .withColumn("w_rest", F.col("w_all") - F.coalesce(F.sum("w").over(order), F.lit(0)))
        .withColumn("open", F.col("top") * F.col("w_rest") >= F.col("w") * F.col("rest"))
    )
    level = F.min(F.when(F.col("open"), F.struct(F.col("top") / F.col("w"), F.col("source").isNull(), F.col("source"), F.col("rest"), F.col("w_rest")))).over(everything)
    out = filled.withColumn("level", level)
    share_of = F.col("w") * F.col("level.rest") / F.col("level.w_rest")
    return out.select("source", "source_size", F.when(F.col("open"), share_of).otherwise(F.col("top").cast("double")).alias("target"))


def placed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", keep_rows: bool = False) -> DataFrame:
    """(doc_id, source, size, class, part, turn, digest, tie, m[, row]): a document's size and its place in its source's order.

    class grows with the size, sixteen steps an octave from 32 words on, in integer arithmetic; it is
    shifted below zero in the rising half and negated in the falling one, so that it orders both.
    """
    id_, body, own = (F.col(f"`{c}`") for c in (id_col, text, source))
    digest = F.md5(F.concat_ws("|", F.coalesce(id_.cast("string"), F.lit("?")), F.lit("mix")))
    body = body.cast("string")
    rows = docs.select(
        id_.alias("doc_id"), own.cast("string").alias("source"), word_count(body).alias("size"), digest.alias("digest"), F.xxhash64(body).alias("tie"), F.monotonically_increasing_id().alias("m"),
        *([F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns))).alias("row")] if keep_rows else []),
    )
    bits = F.length(F.bin("size"))
    step = F.expr("shiftright(size, length(bin(size)) - 5)")
    grade = F.when(F.col("size") < 32, F.col("size")).otherwise((bits - 6) * 16 + step + 16).cast("int")
    falls = F.col("digest") >= "8"
    return rows.select(
        "*",
        F.when(falls, -grade).otherwise(grade - RISING).alias("class"),
        F.when(falls, -F.col("size")).otherwise(F.col("size")).alias("turn"),
        F.substring("digest", 1, 2).alias("part"),
    )


def copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", offset: float = OFFSET, keep_rows: bool = False, **kind) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies (and its row, if asked for)."""
    rows = placed(docs, id_col, text, source, keep_rows).withColumn("unnamed", F.col("source").isNull())
    ranked = with_index(rows, "unnamed", "source", "class", "part", "turn", "digest", "doc_id", "tie", "m", name="at")
    sums = ranked.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("at").alias("start"))
    sums = stored(sums, "sources")
    aimed = targets(sums.select("source", "source_size"), **kind).toDF("a_source", "source_size", "target")
    plan = aimed.join(sums.select(F.col("source").alias("p_source"), "start"), F.col("a_source").eqNullSafe(F.col("p_source"))).drop("p_source")
    plan = stored(plan, "plan")  # of known size: Spark takes a join's for the product of its sides and would shuffle all rows, texts included
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = F.col("at") - F.col("start")
    crossed = F.floor(F.lit(offset) + (at + 1) * F.col("e")) - F.floor(F.lit(offset) + at * F.col("e"))
    return ranked.join(plan, F.col("source").eqNullSafe(F.col("a_source"))).withColumn("e", expected).select("doc_id", "source", "size", "source_size", "target", crossed.alias("copies"), *(["row"] if keep_rows else []))


def mixed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents with all their columns, each as often as the mix takes it (not at all, once or twice)."""
    took = copies(docs, id_col, text, source, keep_rows=True).where("copies > 0")
    return took.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*").toDF(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    from quern.sources.tables import table

    mix = copies(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


SQL = rf"""
WITH d AS (
  SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '?') || '|mix') AS digest
  FROM documents
), p AS (
  SELECT *, CASE WHEN digest >= '8' THEN -grade ELSE grade - {RISING} END AS class, CASE WHEN digest >= '8' THEN -size ELSE size END AS turn
  FROM (SELECT *, CASE WHEN size < 32 THEN size ELSE (length(bin(size)) - 6) * 16 + (size >> (length(bin(size)) - 5)::BIGINT) + 16 END AS grade FROM d) g
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS w, 2 * source_size AS top FROM s
), f AS (
  SELECT *, sum(source_size) OVER ()::BIGINT * 1.5::DOUBLE - coalesce(sum(top) OVER o, 0)::BIGINT AS rest,
         sum(w) OVER ()::BIGINT - coalesce(sum(w) OVER o, 0)::BIGINT AS w_rest,
         row_number() OVER (ORDER BY top::DOUBLE / w, source NULLS LAST) AS pos
  FROM w WINDOW o AS (ORDER BY top::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT rest, w_rest FROM f WHERE top * w_rest >= w * rest ORDER BY pos LIMIT 1
), t AS (
  SELECT source, source_size, CASE WHEN top * f.w_rest >= w * f.rest THEN (w * l.rest) / l.w_rest ELSE top::DOUBLE END AS target FROM f, l
), r AS (
  SELECT p.*, row_number() OVER (PARTITION BY source ORDER BY class, substring(digest, 1, 2), turn, digest, doc_id NULLS LAST) - 1 AS place FROM p
), e AS (
  SELECT r.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS e
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor({OFFSET}::DOUBLE + (place + 1) * e) - floor({OFFSET}::DOUBLE + place * e)))::BIGINT AS taken
FROM e
"""
