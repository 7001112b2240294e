"""Queries for the curation and exploration operators, each with its SQL twin where SQL can express it.

``documents`` plays the captions: text is the caption, lang the declared language and md5 of doc_id the uid. No table has
image sizes; width and height are derived from n_chars and doc_id, and paired vectors from vec_id offsets, as stated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import geometry, text, vectors
from quern.operators import explore, filters, metrics, models
from quern.plans import scales
from quern.plans.pipeline import FilterPipeline, uid_of
from quern.plans.steps import FilterStep
from quern.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

W_ = text.WS_RE2


def query(sql: str | None = None):
    """Register a query under its function's name, with its DuckDB statement."""

    def put(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return put


def captions(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, uid, txt, lang, source, n_chars, width, height)."""
    docs = table(spark, d, "documents")
    return docs.select("doc_id", uid_of("doc_id").alias("uid"), F.col("text").alias("txt"), "lang", "source", "n_chars", (F.pmod("n_chars", F.lit(1000)) + 1).cast("int").alias("width"), (F.pmod("doc_id", F.lit(700)) + 1).cast("int").alias("height"))


# --- pieces of SQL that several statements share -------------------------------------------------
_STRIP = rf"regexp_replace(txt, '^[{W_}]+|[{W_}]+$', '', 'g')"
_WORDS = rf"(CASE WHEN {_STRIP} = '' THEN CAST([] AS VARCHAR[]) ELSE string_split_regex({_STRIP}, '[{W_}]+') END)"
_CAPTIONS = "(SELECT doc_id, md5(doc_id::VARCHAR) AS uid, text AS txt, lang, source, n_chars, (n_chars % 1000 + 1)::INT AS width, (doc_id % 700 + 1)::INT AS height FROM documents)"
_LONG = lambda words, chars, op=">=": f"(len({_WORDS}) {op} {words} AND length({_STRIP}) {op} {chars})"
_RATIO = "(width::DOUBLE / height > 0.8::DOUBLE AND width::DOUBLE / height < 1.8::DOUBLE)"


def _sql_tag() -> str:
    cases = " ".join(f"WHEN regexp_matches(w, '{rule}') THEN '{name}'" for name, rule in models.TAG_RULES[:-1])
    return f"CASE {cases} ELSE '{models.TAG_RULES[-1][0]}' END"


_TAGS = f"list_transform({_WORDS}, lambda w: {_sql_tag()})"
_TAGGED = f"(SELECT *, {_TAGS} AS tags FROM {_CAPTIONS} c)"
_SIGNATURE = "array_to_string(list_sort(list_distinct(tags)), '_')"


def _sql_language() -> str:
    lists = {k: "[" + ", ".join(f"'{w}'" for w in v) + "]" for k, v in models.STOP_WORDS.items()}
    lower = _WORDS.replace("txt", "lower(txt)")
    hits = ", ".join(f"len(list_filter({lower}, lambda w: list_contains({v}, w))) AS h_{k}" for k, v in lists.items())
    best = "greatest(" + ", ".join(f"h_{k}" for k in lists) + ")"
    label = "CASE " + " ".join(f"WHEN h_{k} = {best} THEN '__label__{k}'" for k in lists) + " END"
    total = " + ".join(f"h_{k}" for k in lists)
    return f"(SELECT *, {label} AS label, CASE WHEN {total} = 0 THEN 0.0::DOUBLE ELSE {best}::DOUBLE / ({total}) END AS score FROM (SELECT *, {hits} FROM {_CAPTIONS} c) h)"


_LABELLED = _sql_language()


def tagged(spark: SparkSession, d: str, distinct: bool = False) -> DataFrame:
    return captions(spark, d).withColumn("tags", models.stand_in_tags(F.col("txt"), distinct))


def labelled(spark: SparkSession, d: str) -> DataFrame:
    return with_language(captions(spark, d))


def with_language(df: DataFrame, caption: str = "txt") -> DataFrame:
    """df with label and score."""
    return df.withColumn("q_lang", models.stand_in_language(F.col(caption))).select(*df.columns, "q_lang.label", "q_lang.score")


# --- filters -------------------------------------------------------------------------------------
@query(f"SELECT uid FROM {_CAPTIONS} c WHERE {_LONG(2, 5)}")
def caption_length_filter(spark, d):
    return captions(spark, d).where(filters.caption_length(F.col("txt"))).select("uid")


@query(f"SELECT uid FROM {_CAPTIONS} c WHERE {_LONG(200, 1500)}")
def caption_length_discriminating(spark, d):
    return captions(spark, d).where(filters.caption_length(F.col("txt"), 200, 1500)).select("uid")


@query(f"SELECT uid FROM {_CAPTIONS} c WHERE {_LONG(2, 5, '>')}")
def caption_length_strict(spark, d):
    return captions(spark, d).where(filters.caption_length(F.col("txt"), strict=True)).select("uid")


@query(f"SELECT uid FROM {_LABELLED} c WHERE label = '__label__en' AND score > 0.7::DOUBLE")
def language_filter(spark, d):
    return labelled(spark, d).where(filters.caption_language(F.col("label"), F.col("score"))).select("uid")


@query(f"SELECT uid, label = '__label__en' AS is_english, label AS lang_detected, round(score, 6) AS score FROM {_LABELLED} c")
def language_struct(spark, d):
    lang = F.col("label")
    s = F.struct(filters.is_language(lang).alias("is_english"), lang.alias("lang_detected"), F.round("score", 6).alias("score"))
    return labelled(spark, d).select("uid", s.alias("s")).select("uid", "s.*")


@query(f"SELECT uid FROM {_LABELLED} c WHERE label = '__label__en' AND score > 0.9::DOUBLE AND {_LONG(2, 5, '>')}")
def confident_caption_filter(spark, d):
    return labelled(spark, d).where(filters.confident_caption(F.col("label"), F.col("score"), F.col("txt"))).select("uid")


@query(f"SELECT uid FROM {_CAPTIONS} c WHERE {_RATIO}")
def aspect_ratio_filter(spark, d):
    return captions(spark, d).where(filters.aspect_ratio(F.col("width"), F.col("height"))).select("uid")


@query(f"SELECT uid FROM {_CAPTIONS} c WHERE least(width, height) >= 200 AND greatest(width::DOUBLE / height, height::DOUBLE / width) < 3")
def image_dims_filter(spark, d):
    return captions(spark, d).where(filters.image_dims(F.col("width"), F.col("height"))).select("uid")


_KNOWN = f"(SELECT DISTINCT {_SIGNATURE} AS pattern FROM {_TAGGED} t WHERE lang = 'en' AND n_chars > 1000)"


@query(f"SELECT uid FROM {_TAGGED} t WHERE {_SIGNATURE} IN (SELECT pattern FROM {_KNOWN} k)")
def pos_pattern_filter(spark, d):
    rows = captions(spark, d)
    df, some = (x.withColumn("signature", text.signature(models.stand_in_tags(F.col("txt"), distinct=True))) for x in (rows, rows.where("lang = 'en' AND n_chars > 1000")))
    known = some.select(F.col("signature").alias("pattern"))
    return filters.with_pattern_flag(df, "signature", known).where("known_pattern").select("uid")


@query(f"SELECT uid FROM {_TAGGED} t WHERE list_contains(tags, 'ADJ') AND list_contains(tags, 'NOUN') AND NOT list_contains(tags, 'NUM')")
def descriptive_filter(spark, d):
    return tagged(spark, d, distinct=True).where(filters.descriptive(text.tag_counts(F.col("tags")))).select("uid")


@query(f"SELECT uid, {_LONG(200, 1500)} AS kept FROM {_CAPTIONS} c")
def kept_and_rejected(spark, d):
    step = FilterStep("t").add("long", lambda df: filters.caption_length(F.col("txt"), 200, 1500))
    df = captions(spark, d)
    rejected = step.rejected(df).select("uid", F.lit(False).alias("kept"))
    return step.kept(df).select("uid", F.lit(True).alias("kept")).union(rejected)


# --- scalar functions ----------------------------------------------------------------------------
@query(rf"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(lower(text), '[^a-z_\t-\r\x1c-\x20]', '', 'g'), '[\t-\r\x1c-\x20]+', ' ', 'g'))) AS digest FROM documents")
def clean_text_digest(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(text.clean_text(F.col("text"))).alias("digest"))


@query(f"SELECT doc_id, len({_WORDS})::INT AS n_words, length({_STRIP})::INT AS n_code_points FROM {_CAPTIONS} c")
def python_counts(spark, d):
    c = F.col("txt")
    return captions(spark, d).select("doc_id", text.word_count(c).alias("n_words"), F.length(text.py_strip(c)).alias("n_code_points"))


@query("SELECT doc_id, md5(rtrim(text, ' .')) AS digest FROM documents")
def strip_chars_end(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(text.strip_end(F.col("text"))).alias("digest"))


@query("SELECT doc_id, lang AS code, '' AS no_match FROM documents")
def regex_label_extract(spark, d):
    made = F.concat(F.lit("__label__"), F.col("lang"))
    return table(spark, d, "documents").select("doc_id", text.label_of(made).alias("code"), text.label_of(F.col("lang")).alias("no_match"))


@query(f"SELECT uid, CASE WHEN len(tags) = 0 THEN '' ELSE md5(array_to_string(tags, '_') || '_') END AS joined, {_SIGNATURE} AS signature, greatest(len(list_distinct(tags)), 1)::INT AS n_kinds FROM {_TAGGED} t")
def pos_signature(spark, d):
    t = F.col("tags")
    joined = text.tag_string(t)
    return tagged(spark, d).select("uid", F.when(joined == "", "").otherwise(F.md5(joined)).alias("joined"), text.signature(text.tags_of(joined)).alias("signature"), text.n_kinds(t).alias("n_kinds"))


@query("SELECT uid, " + ", ".join(f"len(list_filter(tags, lambda x: x = '{t}'))::INT AS {t}" for t in text.TAGS) + f" FROM {_TAGGED} t")
def pos_counts(spark, d):
    return tagged(spark, d).select("uid", *text.tag_counts(F.col("tags")).values())


@query("SELECT uid, ('0x' || uid[1:16])::UBIGINT::VARCHAR AS f0, ('0x' || uid[17:32])::UBIGINT::VARCHAR AS f1 FROM (SELECT md5(doc_id::VARCHAR) AS uid FROM documents)")
def uid_split_sorted(spark, d):
    a, b = text.uid_halves(F.col("uid"))
    return captions(spark, d).select("uid", a.alias("f0"), b.alias("f1")).orderBy("f0", "f1").select("uid", F.col("f0").cast("string").alias("f0"), F.col("f1").cast("string").alias("f1"))


def _sql_resized(mode: str) -> str:
    if mode == "no":
        return "width, height"
    if mode in ("border", "center_crop"):
        return "512, 512"
    side = "least(width, height)" if mode == "keep_ratio" else "greatest(width, height)"
    return ", ".join(f"greatest(round({x} * (512::DOUBLE / {side}::DOUBLE)), 1)::INT" for x in ("width", "height"))


@query(" UNION ALL ".join(f"SELECT uid, '{m}' AS mode, {_sql_resized(m).replace(', ', ' AS new_width, ', 1) if m in ('no', 'border', 'center_crop') else _sql_resized(m).replace('::INT, ', '::INT AS new_width, ')} AS new_height FROM {_CAPTIONS} c" for m in geometry.RESIZE_MODES))
def resize_modes(spark, d):
    w, h = F.col("width"), F.col("height")
    each = F.array(*(F.struct(F.lit(m).alias("mode"), geometry.resized(w, h, m).alias("size")) for m in geometry.RESIZE_MODES))
    return captions(spark, d).select("uid", F.inline(each)).select("uid", "mode", F.col("size.width").alias("new_width"), F.col("size.height").alias("new_height"))


@query("SELECT i, i * i AS square FROM range(4) t(i)")
def squares(spark, d):
    return spark.range(4).select(F.col("id").alias("i"), (F.col("id") * F.col("id")).alias("square"))


# --- duplicates, sets ----------------------------------------------------------------------------
@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def dedup_keep_first(spark, d):
    return explore.keep_first(table(spark, d, "documents").select("doc_id", "text"), "text", "doc_id").select("doc_id")


@query("SELECT doc_id FROM (SELECT doc_id, count(*) OVER (PARTITION BY text) AS n FROM documents) WHERE n = 1")
def dedup_drop_all(spark, d):
    return explore.drop_all_copies(table(spark, d, "documents").select("doc_id", "text"), "text").select("doc_id")


@query("SELECT doc_id FROM (SELECT doc_id, count(*) OVER (PARTITION BY text) AS n FROM documents) WHERE n > 1")
def duplicated_rows(spark, d):
    return explore.duplicated(table(spark, d, "documents").select("doc_id", "text"), "text").select("doc_id")


@query("SELECT 'doc_id' AS \"column\", count(DISTINCT doc_id) = count(doc_id) AS is_unique FROM documents UNION ALL SELECT 'text', count(DISTINCT text) = count(text) FROM documents")
def uniqueness_checks(spark, d):
    return explore.unique_test(table(spark, d, "documents"), "doc_id", "text")


@query(f"SELECT uid FROM {_CAPTIONS} c WHERE {_LONG(200, 1500)} AND {_RATIO}")
def merge_intersection(spark, d):
    df = captions(spark, d)
    return explore.merged([df.where(filters.caption_length(F.col("txt"), 200, 1500)).select("uid"), df.where(filters.aspect_ratio(F.col("width"), F.col("height"))).select("uid")])


@query(f"SELECT uid FROM {_CAPTIONS} c WHERE {_LONG(200, 1500)} OR {_RATIO}")
def merge_union(spark, d):
    df = captions(spark, d)
    return explore.merged([df.where(filters.caption_length(F.col("txt"), 200, 1500)).select("uid"), df.where(filters.aspect_ratio(F.col("width"), F.col("height"))).select("uid")], "union")


@query("SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AND text NOT IN (SELECT text FROM benchmark)")
def semi_and_anti(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    good = table(spark, d, "labels").where("quality = 1").select("doc_id")
    return docs.join(good, "doc_id", "left_semi").join(table(spark, d, "benchmark").select("text"), "text", "left_anti").select("doc_id", "text")


def _signatures(part: str) -> str:
    return f"SELECT DISTINCT {_SIGNATURE} AS pattern FROM {_TAGGED} t WHERE {part}"


@query(f"SELECT * FROM ({_signatures('doc_id % 2 = 0')} INTERSECT {_signatures('doc_id % 2 = 1')})")
def pattern_mining(spark, d):
    df = tagged(spark, d, distinct=True).select("doc_id", text.signature(F.col("tags")).alias("pattern"))
    return explore.value_sides(df, "pattern", even="doc_id % 2 = 0", odd="doc_id % 2 = 1").where("even AND odd").select("pattern")


@query(f"SELECT 'only_even' AS side, count(*) AS n FROM ({_signatures('doc_id % 2 = 0')} EXCEPT {_signatures('doc_id % 2 = 1')}) UNION ALL SELECT 'only_odd', count(*) FROM ({_signatures('doc_id % 2 = 1')} EXCEPT {_signatures('doc_id % 2 = 0')})")
def pattern_differences(spark, d):
    df = tagged(spark, d, distinct=True).select("doc_id", text.signature(F.col("tags")).alias("pattern"))
    sides = explore.value_sides(df, "pattern", even="doc_id % 2 = 0", odd="doc_id % 2 = 1")
    counts = sides.agg(F.count_if(F.expr("even AND NOT odd")).alias("only_even"), F.count_if(F.expr("odd AND NOT even")).alias("only_odd"))
    return counts.select(F.inline(F.array(*(F.struct(F.lit(c).alias("side"), F.col(c).alias("n")) for c in counts.columns))))


# --- counts, histograms --------------------------------------------------------------------------
@query("SELECT lang, count(*) AS count FROM documents GROUP BY lang")
def value_counts(spark, d):
    return explore.value_counts(table(spark, d, "documents"), "lang").orderBy(F.desc("count"), "lang")


@query("SELECT source, round(count(*) / sum(count(*)) OVER (), 9) AS proportion FROM documents GROUP BY source")
def value_counts_normalized(spark, d):
    return explore.value_counts(table(spark, d, "documents"), "source", normalize=True).select("source", F.round("proportion", 9).alias("proportion"))


@query("SELECT lang, quality, toxic, count(*) AS count FROM documents JOIN labels USING (doc_id) GROUP BY ALL")
def multi_value_counts(spark, d):
    df = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id")
    return explore.value_counts(df, "lang", "quality", "toxic").orderBy("lang", "quality", "toxic")


@query("SELECT 'quality' AS \"column\", quality::VARCHAR AS value, count(*) AS count FROM labels GROUP BY quality UNION ALL SELECT 'toxic', toxic::VARCHAR, count(*) FROM labels GROUP BY toxic")
def column_value_counts(spark, d):
    return explore.column_value_counts(table(spark, d, "labels"), ["quality", "toxic"])


def _sql_histogram(bins: int) -> str:
    return f"""WITH e AS (SELECT min(n_chars)::DOUBLE AS lo, max(n_chars)::DOUBLE AS hi, count(n_chars) AS n FROM documents),
      c AS (SELECT least(floor((n_chars - lo) / ((hi - lo) / {bins}))::INT + 1, {bins}) AS bin, count(*) AS k FROM documents, e GROUP BY 1)
      SELECT b.bin::INT AS bin, coalesce(k, 0) AS count, round(coalesce(k, 0) * 100.0::DOUBLE / n, 6) AS percent FROM (SELECT unnest(range(1, {bins + 1})) AS bin) b CROSS JOIN e LEFT JOIN c ON b.bin = c.bin"""


@query(_sql_histogram(30))
def histogram_30(spark, d):
    return explore.histogram(table(spark, d, "documents"), "n_chars", 30, percent=True).select("bin", "count", F.round("percent", 6).alias("percent"))


@query(_sql_histogram(20))
def histogram_20(spark, d):
    return explore.histogram(table(spark, d, "documents"), "n_chars", 20, percent=True).select("bin", "count", F.round("percent", 6).alias("percent"))


_DESCRIBED = {"documents": "n_chars", "events": "value"}


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS min, round(quantile_cont({c}::DOUBLE, 0.25), 6) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS p50, round(quantile_cont({c}::DOUBLE, 0.75), 6) AS p75, max({c})::DOUBLE AS max FROM {t}" for t, c in _DESCRIBED.items()))
def describe(spark, d):
    a, b = (explore.describe(table(spark, d, t), [c]) for t, c in _DESCRIBED.items())
    out = a.union(b)
    return out.select("column", "count", *(F.round(c, 6).alias(c) if c not in ("min", "max") else c for c in ("mean", "std", "min", "p25", "p50", "p75", "max")))


@query("SELECT c.\"column\", non_null FROM (SELECT count(doc_id) AS doc_id, count(quality) AS quality, count(toxic) AS toxic FROM labels) UNPIVOT (non_null FOR \"column\" IN (doc_id, quality, toxic)) c")
def info(spark, d):
    return explore.info(table(spark, d, "labels")).select("column", "non_null")


@query(f"SELECT lang AS declared, label AS detected, count(*) AS count FROM {_LABELLED} c GROUP BY ALL")
def language_crosstab(spark, d):
    df = labelled(spark, d).select(F.col("lang").alias("declared"), F.col("label").alias("detected"))
    return explore.crosstab(df, "declared", "detected")


_AGREE = {"agree": "d = l", "differ": "d <> l", "en_confirmed": "d = '__label__en' AND l = '__label__en'", "en_missed": "d = '__label__en' AND l <> '__label__en'", "en_false": "d <> '__label__en' AND l = '__label__en'", "confident_differ": "d <> l AND score > 0.5", "unsure": "score <= 0.5"}


@query(" UNION ALL ".join(f"SELECT '{k}' AS view, count(*) AS n FROM (SELECT '__label__' || lang AS d, label AS l, score FROM {_LABELLED} x) c WHERE {v}" for k, v in _AGREE.items()))
def language_views(spark, d):
    df = labelled(spark, d).select(F.concat(F.lit("__label__"), "lang").alias("d"), F.col("label").alias("l"), "score")
    counts = df.agg(*(F.count_if(F.expr(v)).alias(k) for k, v in _AGREE.items()))
    return counts.select(F.inline(F.array(*(F.struct(F.lit(k).alias("view"), F.col(k).alias("n")) for k in _AGREE))))


# --- numbering, order, limits --------------------------------------------------------------------
@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS \"index\" FROM documents")
def row_index(spark, d):
    return explore.with_index(table(spark, d, "documents").select("doc_id"), "doc_id")


@query("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20")
def head_n(spark, d):
    return table(spark, d, "documents").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(20)


@query("SELECT source, ((row_number() OVER (ORDER BY source) - 1) % 4)::INT AS worker FROM (SELECT DISTINCT source FROM documents)")
def round_robin_split(spark, d):
    sources = explore.with_index(table(spark, d, "documents").select("source").distinct(), "source")
    return sources.select("source", explore.round_robin(F.col("index"), 4).alias("worker"))


@query("SELECT doc_id, floor((row_number() OVER (PARTITION BY doc_id % 4 ORDER BY doc_id) - 1) / 50)::INT + 1 AS batch_id FROM documents")
def batch_numbering(spark, d):
    df = table(spark, d, "documents").select("doc_id", F.pmod("doc_id", F.lit(4)).alias("worker"))
    return explore.numbered_batches(df, 50, "worker", "doc_id").select("doc_id", "batch_id")


@query("SELECT doc_id, floor((row_number() OVER (ORDER BY doc_id) - 1) * 4 / count(*) OVER ())::INT AS split FROM documents")
def equal_split(spark, d):
    return explore.equal_split(table(spark, d, "documents").select("doc_id"), 4, "doc_id")


# --- metrics, steps, pipeline --------------------------------------------------------------------
_FLAGS = f"(SELECT floor((row_number() OVER (ORDER BY doc_id) - 1) / 100)::INT + 1 AS batch_id, {_LONG(200, 1500)} AS a, {_RATIO} AS b FROM {_CAPTIONS} c)"


def _sql_batches(cascade: bool) -> str:
    second = "a" if cascade else "true"
    return f"""SELECT filter, batch_id, i AS input_count, o AS output_count, i - o AS filtered_count, round(CASE WHEN i = 0 THEN 0 ELSE (i - o)::DOUBLE / i END, 5) AS filter_rate FROM (
      SELECT 'caption_length' AS filter, batch_id, count(*) AS i, count(*) FILTER (a) AS o FROM {_FLAGS} f GROUP BY batch_id UNION ALL
      SELECT 'aspect_ratio', batch_id, count(*) FILTER ({second}), count(*) FILTER ({second} AND b) FROM {_FLAGS} f GROUP BY batch_id)"""


def _measured(spark: SparkSession, d: str, mode: bool | str) -> DataFrame:
    step = FilterStep("both", mode=mode)
    step.add("caption_length", lambda df: filters.caption_length(F.col("txt"), 200, 1500)).add("aspect_ratio", lambda df: filters.aspect_ratio(F.col("width"), F.col("height")))
    return step.measured_in_order(captions(spark, d), "doc_id", 100)


@query(_sql_batches(True))
def batch_metrics(spark, d):
    return _measured(spark, d, True)


@query(_sql_batches(False))
def same_input_metrics(spark, d):
    return _measured(spark, d, "same_input")


@query(f"""SELECT filter, sum(input_count)::BIGINT AS total_input, sum(output_count)::BIGINT AS total_output, count(*) AS batches_processed, sum(filtered_count)::BIGINT AS total_filtered,
  round(avg(filter_rate), 5) AS avg_filter_rate, round(coalesce(stddev_samp(filter_rate), 0), 5) AS stddev_filter_rate, round(min(filter_rate), 5) AS min_filter_rate, round(max(filter_rate), 5) AS max_filter_rate, count(*) AS calls
  FROM ({_sql_batches(True)}) m GROUP BY filter""")
def metrics_summary(spark, d):
    return metrics.summary(_measured(spark, d, True))


@query("SELECT workers, avg(s) AS mean_time, stddev_pop(s) AS std_dev FROM (VALUES ('16', 2.0::DOUBLE), ('16', 4.0::DOUBLE), ('32', 1.5::DOUBLE)) v(workers, s) GROUP BY workers")
def bench_results(spark, d):
    text_ = '{"16": {"execution_times": [2.0, 4.0]}, "32": {"execution_times": [1.5]}}'
    return metrics.bench_summary(metrics.bench_rows(spark.createDataFrame([(text_,)], "value string")))


_PAIRED = "(SELECT a.vec_id, md5(a.vec_id::VARCHAR) AS uid, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS c FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)"


@query(f"""WITH s0 AS (SELECT uid, doc_id FROM {_CAPTIONS} c WHERE {_LONG(20, 100)} AND label_en AND {_RATIO})
SELECT s0.uid FROM s0 JOIN {_PAIRED} p ON p.vec_id = s0.doc_id WHERE c * 100 > 0.3::DOUBLE""".replace("AND label_en ", f"AND doc_id IN (SELECT doc_id FROM {_LABELLED} x WHERE label = '__label__en' AND score > 0.5::DOUBLE) "))
def pipeline_flagship(spark, d):
    """Text filters and an image filter intersected, then a pair filter over vectors; the pair of vector i is vector i + 1."""
    text_part = FilterStep("text").add("length", lambda df: filters.caption_length(F.col("txt"), 20, 100))
    text_part.add("language", lambda df: filters.caption_language(F.col("label"), F.col("score"), threshold=0.5), with_language)
    vision = FilterStep("vision").add("ratio", lambda df: filters.aspect_ratio(F.col("width"), F.col("height")))
    pairs = FilterStep("pairs").add("similar", lambda df: filters.pair_score(F.col("q_score")), lambda df: df.join(_paired(spark, d).select(F.col("vec_id").alias("doc_id"), vectors.logit(F.col("a"), F.col("b")).alias("q_score")), "doc_id"))
    pipeline = FilterPipeline().step("intersection").add(text_part).add(vision).step("union").add(pairs)
    return pipeline.survivors(captions(spark, d))


@query(f"SELECT uid FROM {_LABELLED} c WHERE {_LONG(200, 1500)} AND label = '__label__en' AND score > 0.5::DOUBLE")
def text_step_cascade(spark, d):
    step = FilterStep("text").add("length", lambda df: filters.caption_length(F.col("txt"), 200, 1500))
    step.add("language", lambda df: filters.caption_language(F.col("label"), F.col("score"), threshold=0.5), with_language)
    return step.plan(captions(spark, d))


# --- vectors -------------------------------------------------------------------------------------
def _paired(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings")
    return v.select("vec_id", F.col("embedding").alias("a")).join(v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b")), "vec_id")


@query(f"SELECT vec_id, round(c, 4) AS similarity FROM {_PAIRED} p")
def clip_cosine(spark, d):
    return _paired(spark, d).select("vec_id", F.round(vectors.cosine(F.col("a"), F.col("b")), 4).alias("similarity"))


@query(f"SELECT vec_id FROM {_PAIRED} p WHERE c * 100 > 0.3::DOUBLE")
def clip_logit_filter(spark, d):
    return _paired(spark, d).where(filters.embedding_score(F.col("a"), F.col("b"))).select("vec_id")


_LIFTED = """(SELECT vec_id, label, list_transform(v, lambda x: x * f) AS s, sqrt(1 + f * f * n * n) AS t FROM
  (SELECT vec_id, label, v, n, sinh(least(greatest(n, 1e-8::DOUBLE), asinh(32768::DOUBLE))) / greatest(n, 1e-8::DOUBLE) AS f FROM
    (SELECT vec_id, label, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings)))"""
#: The mean vector of each label over the whole table stands for the reference set.
_CENTRES = """(SELECT label, list(m ORDER BY i) AS embedding FROM (SELECT label, i, avg(x::DOUBLE) AS m FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY label, i) GROUP BY label)"""
_LIFTED_CENTRES = _LIFTED.replace("vec_id, label", "label").replace("FROM embeddings", f"FROM {_CENTRES} e")


@query(f"SELECT vec_id, round(t, 6) AS time, round(list_sum(s), 6) AS space_sum FROM {_LIFTED} l")
def lorentz_expm(spark, d):
    e = vectors.expm(F.col("embedding"))
    total = F.aggregate("e.space", F.lit(0.0), lambda s, x: s + x)
    return table(spark, d, "embeddings").select("vec_id", e.alias("e")).select("vec_id", F.round("e.time", 6).alias("time"), F.round(total, 6).alias("space_sum"))


def _sql_specificity() -> str:
    return f"""(SELECT y.vec_id, avg(acos(greatest(least((y.t + x.t * i) / (x.n * sqrt(greatest(i * i - 1, 1e-8::DOUBLE)) + 1e-8::DOUBLE), 1 - 1e-8::DOUBLE), -1 + 1e-8::DOUBLE))
        - asin(greatest(least(0.2::DOUBLE / (x.n + 1e-8::DOUBLE), 1 - 1e-8::DOUBLE), -1 + 1e-8::DOUBLE))) AS score
      FROM (SELECT y.vec_id AS yi, x.label AS xi, list_dot_product(x.s, y.s) - x.t * y.t AS i FROM {_LIFTED} y, {_LIFTED_CENTRES} x) p
      JOIN {_LIFTED} y ON y.vec_id = yi JOIN (SELECT *, sqrt(list_dot_product(s, s)) AS n FROM {_LIFTED_CENTRES} z) x ON x.label = xi GROUP BY y.vec_id)"""


def _specificity(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings")
    means = v.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    centres = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda p: p["m"]).alias("embedding"))
    return vectors.specificity(v.select("vec_id", "embedding"), "embedding", centres, "embedding")


@query(f"SELECT vec_id, round(score, 6) AS specificity FROM {_sql_specificity()} q")
def specificity_score(spark, d):
    return _specificity(spark, d).select("vec_id", F.round("specificity", 6).alias("specificity"))


@query(f"SELECT vec_id FROM {_sql_specificity()} q WHERE score > 0.17::DOUBLE")
def specificity_filter(spark, d):
    return _specificity(spark, d).where(filters.specific(F.col("specificity"), 0.17)).select("vec_id")


# --- tables, plans -------------------------------------------------------------------------------
@query("SELECT * FROM (VALUES " + ", ".join(f"('{n}', {b}, {lr}::DOUBLE, {s}::BIGINT, {w}, '{m}', {'NULL' if b2 is None else b2}::DOUBLE)" for n, b, lr, s, w, m, b2 in scales.SCALES) + ") v(name, batch_size, learning_rate, train_num_samples, warmup, model, beta2)")
def scale_configs(spark, d):
    return scales.table(spark)


@query("SELECT md5(doc_id::VARCHAR) AS uid, floor(i / 300)::BIGINT AS shard_id, lpad(i::VARCHAR, 12, '0') AS key FROM (SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id::VARCHAR)) - 1 AS i FROM documents)")
def download_plan(spark, d):
    from quern.sources.download import planned

    return planned(captions(spark, d).select("uid"), "uid", 300).select("uid", "shard_id", "key")


@query("SELECT doc_id, text AS caption, NULL::INT AS NUM, coalesce(NULL, 0)::INT AS ADJ FROM documents")
def missing_columns(spark, d):
    df = table(spark, d, "documents").select("doc_id", F.col("text").alias("caption"))
    return explore.with_missing(df, ["NUM", "ADJ", "caption"]).fillna(0, ["ADJ"])


# Registers the queries for sources, sinks, adapters and settings beside these.
from quern import catalog_files  # noqa: E402, F401
