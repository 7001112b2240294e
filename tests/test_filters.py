import statistics

import pytest
from pyspark.sql import functions as F

from quern.operators import explore, filters, metrics, models
from quern.plans import config, scales
from quern.plans.pipeline import FilterPipeline, block, registered
from quern.plans.steps import FilterStep, pair_step, text_step, vision_step


def kept(df, predicate):
    return [r["i"] for r in df.where(F.coalesce(predicate, F.lit(False))).orderBy("i").collect()]


def test_bounds(spark):
    df = spark.createDataFrame([(0, "ab cd"), (1, "ab c"), (2, "abcdef"), (3, " \n"), (4, None), (5, "ab cde")], "i int, c string")
    assert kept(df, filters.caption_length(F.col("c"))) == [0, 5]
    assert kept(df, filters.caption_length(F.col("c"), strict=True)) == []
    wh = spark.createDataFrame([(0, 8, 10), (1, 18, 10), (2, 81, 100), (3, 179, 100), (4, 5, 0), (5, None, 3)], "i int, w int, h int")
    assert kept(wh, filters.aspect_ratio(F.col("w"), F.col("h"))) == [2, 3]
    wh = spark.createDataFrame([(0, 200, 599), (1, 200, 600), (2, 199, 200), (3, 599, 200)], "i int, w int, h int")
    assert kept(wh, filters.image_dims(F.col("w"), F.col("h"))) == [0, 3]
    s = spark.createDataFrame([(0, "__label__en", 0.7), (1, "__label__en", 0.71), (2, "__label__fr", 0.9), (3, None, None)], "i int, l string, s double")
    assert kept(s, filters.caption_language(F.col("l"), F.col("s"))) == [1]
    with pytest.raises(ValueError):
        filters.embedding_score(F.col("a"), F.col("b"), kind="x")


def samples(spark):
    rows = [(f"{i:032x}", f"word{i} " * (i % 7), 80 + i, 100, i // 10) for i in range(60)]
    return spark.createDataFrame(rows, "uid string, txt string, width int, height int, batch_id int")


def test_kept_and_rejected_are_all(spark):
    df = samples(spark)
    step = FilterStep("s").add("length", lambda d: filters.caption_length(F.col("txt"), 3, 5)).add("ratio", lambda d: filters.aspect_ratio(F.col("width"), F.col("height"), 0.9))
    ok, no = step.kept(df), step.rejected(df)
    assert ok.columns == df.columns and ok.count() + no.count() == 60
    assert {r["rejected_by"] for r in no.collect()} == {"length", "ratio"}
    dry = FilterStep("s", step.filters, mode="same_input")
    assert dry.kept(df).count() == 60
    both = {(r["filter"], r["batch_id"]): r for r in step.measured(df).collect()}
    one = {(r["filter"], r["batch_id"]): r for r in dry.measured(df).collect()}
    for b in range(6):
        assert both["ratio", b]["input_count"] == both["length", b]["output_count"]
        assert one["ratio", b]["input_count"] == 10
    for r in metrics.summary(step.measured(df)).collect():
        rates = [both[r["filter"], b]["filter_rate"] for b in range(6)]
        assert r["avg_filter_rate"] == pytest.approx(statistics.mean(rates), abs=1e-5)
        assert r["stddev_filter_rate"] == pytest.approx(statistics.stdev(rates), abs=1e-5)
        assert r["total_filtered"] == r["total_input"] - r["total_output"]
    single = metrics.summary(step.measured(df.where("batch_id = 0")))
    assert {r["stddev_filter_rate"] for r in single.collect()} == {0.0}


def test_pipeline(spark):
    df = samples(spark)
    a = FilterStep("a").add("x", lambda d: F.col("width") > 90)
    b = FilterStep("b").add("x", lambda d: F.length("txt") > 0)
    none = FilterStep("none").add("x", lambda d: F.lit(False))
    both = {r[0] for r in FilterPipeline().step().add(a).add(b).survivors(df).collect()}
    either = {r[0] for r in FilterPipeline().step("union").add(a).add(b).survivors(df).collect()}
    sets = [{r[0] for r in x.plan(df).collect()} for x in (a, b)]
    assert both == sets[0] & sets[1] and either == sets[0] | sets[1]
    later = FilterPipeline().step().add(a).step("union").add(b)
    assert {r[0] for r in later.survivors(df).collect()} == both
    assert later.subset(df).columns == ["uid", "txt", "width", "height", "batch_id"]
    assert FilterPipeline().step().add(none).step().add(b).survivors(df).count() == 0
    assert FilterPipeline(empty_means_all=True).step().add(none).step().add(b).survivors(df).count() == len(sets[1])
    with pytest.raises(ValueError, match="Step index 3 not found"):
        later.add(a, 3)
    with pytest.raises(ValueError):
        FilterPipeline().step("xor")
    assert "step 1 (union): b" in later.pretty()
    registered("kind")(lambda: a)
    assert block("kind") is a
    with pytest.raises(ValueError):
        block("other")


def test_models_see_survivors_only(spark):
    df = samples(spark)
    conf = config.config_of({"unimodal": {"caption_min_words": 3}})

    def language():
        return lambda captions: [("__label__en", 0.9) for _ in captions]

    def tagger():
        return lambda captions: [["NOUN"] * (len(c.split()) > 4) + ["ADJ"] for c in captions]

    patterns = spark.createDataFrame([("ADJ_NOUN",), ("ADJ_NOUN",)], "pattern string")
    step = text_step(conf, lambda c: models.language_column(c, "lang", language), lambda c: models.tags_column(c, "tags", tagger), patterns)
    got = step.plan(df)
    assert sorted(r[0] for r in got.collect()) == sorted(f"{i:032x}" for i in range(60) if i % 7 > 4)
    plan = got._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in plan.splitlines() if "ArrowEvalPython" in x]
    assert len(lines) >= 2  # the tagger is a stage of its own, above the language filter
    assert "EvalPython" not in vision_step(conf).plan(df)._jdf.queryExecution().executedPlan().toString()
    scored = pair_step(conf, lambda d: models.pair_column(F.col("txt"), F.col("uid"), "pair", lambda: lambda a, b: [len(x) / 40 for x in a]))
    assert 0 < scored.plan(df).count() < 60
    after = FilterPipeline().step().add(vision_step(conf)).step().add(scored).survivors(df)
    text = after._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("EvalPython") < text.index("LeftSemi")  # the semi join is below the model
    mask = models.mask_column(lambda xs, least: [len(x) > least for x in xs], F.col("txt"), least=30)
    assert df.where(mask).count() == df.where(F.length("txt") > 30).count()


def test_generated(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, c string")
    made = models.generated_column(F.col("c"), "upper", lambda: lambda xs: [x.upper() for x in xs])
    assert [r["g"] for r in df.withColumn("g", made).orderBy("i").collect()] == ["A", None]


def test_stand_in_language_is_accurate_on_the_captions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars > 150")
    s = docs.select("lang", models.stand_in_language(F.col("text")).alias("s"))
    n = s.count()
    assert s.where(F.concat(F.lit("__label__"), "lang") == F.col("s.label")).count() >= 0.8 * n
    empty = spark.createDataFrame([(None,), ("",)], "c string").select(models.stand_in_language(F.col("c")).alias("s")).collect()
    assert [tuple(r["s"]) for r in empty] == [(None, None), ("__label__de", 0.0)]


def test_config():
    c = config.Config()
    assert c.infrastructure.filtering and not config.Infrastructure(apply_filters="same_input").filtering
    assert config.Infrastructure(apply_filters=False).filtering
    for bad in ({"lang_detection_language": "fr"}, {"lang_detection_score_threshold": 0.05}, {"batch_size": 0}, {"lang_detection_model_path": None}, {"image_min_aspect_ratio": 1.5}, {"specificity_threshold": 2.0}, {"curvature": 0.0}, {"typo": 1}):
        with pytest.raises(ValueError):
            config.config_of({"unimodal": bad})
    with pytest.raises(ValueError):
        config.config_of({"multimodal": {"clip_score_threshold": 1.5}})
    assert config.config_of({"unimodal": {"image_max_aspect_ratio": 9.0}}).unimodal.image_max_aspect_ratio == 9.0


def test_scales(spark):
    assert scales.names()[0] == "debug" and scales.scale("xlarge")["beta2"] == 0.95 and scales.scale("small")["model"] == "ViT-B-32"
    with pytest.raises(ValueError):
        scales.scale("huge")
    assert scales.table(spark).count() == 5


def test_explore_edges(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, None), (5, "b")], "k int, c string")
    ids = lambda d: sorted(r["k"] for r in d.collect())
    assert ids(explore.keep_first(df, "c", "k")) == [1, 2, 5]
    assert ids(explore.drop_all_copies(df, "c")) == [5] and ids(explore.duplicated(df, "c")) == [1, 2, 3, 4]
    assert [(r["k"], r["index"]) for r in explore.with_index(df, "k").orderBy("k").collect()] == [(k, k - 1) for k in range(1, 6)]
    assert explore.with_index(df.limit(0), "k").collect() == []
    with pytest.raises(ValueError):
        explore.merged([df.select("k")], "xor")
    flat = explore.histogram(spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double"), "x", 5).collect()
    assert [r["count"] for r in sorted(flat, key=lambda r: r["bin"])] == [0, 0, 2, 0, 0]
    assert explore.random_rows(df, 2, 1).count() == 2
    assert explore.with_missing(df, ["c", "n"]).columns == ["k", "c", "n"]
