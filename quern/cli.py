"""Filter shards from the command line: python -m quern.cli --shards-path DIR --output-folder DIR [--config-path FILE]."""

from __future__ import annotations

import argparse
import importlib
import logging
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators import metrics
from quern.operators.models import pair_column, stand_in_language, stand_in_tags
from quern.plans import config as settings
from quern.plans.pipeline import FilterPipeline
from quern.plans.scratch import release, stored
from quern.plans.steps import pair_step, text_step, vision_step
from quern.sinks import files, uids
from quern.sources.images import size_column
from quern.sources.shards import read_shards
from quern.sources.tabular import read_lines


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="quern", description=__doc__)
    p.add_argument("--shards-path", "--shards_path", nargs="+", required=True)
    p.add_argument("--master", default=None, help="Spark master; the session's own if not given")
    p.add_argument("--log-folder", default="logs")
    p.add_argument("--output-folder", default="output")
    p.add_argument("--config-path", default=None)
    p.add_argument("--patterns-path", default=None, help="part-of-speech patterns, one a line; without it that filter is left out")
    p.add_argument("--pair-model", default=None, help="module:function that makes an image-text scorer (images, captions) -> scores; without it the multimodal step is left out")
    return p.parse_args(given)


def pair_model_of(name: str) -> Callable[[Column, Column], Column]:
    """The column function of a scorer given as module:function; the module is imported where the scorer is made."""
    module, _, attribute = name.partition(":")

    def make():
        return getattr(importlib.import_module(module), attribute)()

    return lambda image, caption: pair_column(image, caption, name, make)


def samples_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """uid, txt, width and height of all samples, stored once; image bytes are dropped right after their header is read."""
    df = read_shards(spark, paths)
    return stored(df.withColumn("size", size_column(df["jpg"])).select("key", "shard", "uid", "txt", "size.width", "size.height"), "samples")


def with_images(spark: SparkSession, paths: list[str], score: Callable[[Column, Column], Column]) -> Callable[[DataFrame], DataFrame]:
    """What adds a pair score to samples: their images are read again, of these samples only."""

    def derive(samples: DataFrame) -> DataFrame:
        pairs = read_shards(spark, paths, uids=samples.select("uid")).select("uid", score(F.col("jpg"), F.col("txt")).alias("q_score"))
        return samples.join(pairs.groupBy("uid").agg(F.max("q_score").alias("q_score")), "uid", "left")

    return derive


def run(
    spark: SparkSession,
    shards: list[str],
    config: settings.Config,
    log_folder: str,
    output_folder: str,
    patterns: str | None = None,
    language: Callable[[Column], Column] = stand_in_language,
    tags: Callable[[Column], Column] = stand_in_tags,
    pair: Callable[[DataFrame], Column] | None = None,
    pair_model: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Text and vision filters over the shards, their survivors intersected, then image-text pairs; files are written as the settings say.

    Language and tags come from the offline stand-ins unless models are given. The pair step needs a score: ``pair`` makes it from a
    sample's columns, ``pair_model`` from (image, caption), whose images are read for the survivors of the first step only.
    """
    samples = samples_of(spark, shards)
    steps = [[text_step(config, language, tags, read_lines(spark, patterns) if patterns else None), vision_step(config)]]
    if pair is not None or pair_model is not None:
        steps.append([pair_step(config, pair, with_images(spark, shards, pair_model) if pair_model else None)])
    pipeline = FilterPipeline()
    for blocks in steps:
        pipeline.step("intersection")
        for s in blocks:
            pipeline.add(s)
    logging.info("%s", pipeline.pretty())
    if config.infrastructure.enable_metrics:
        for s in (s for blocks in steps for s in blocks):
            began = time.perf_counter()
            found = stored(s.measured(samples, "shard"), "metrics")
            share = (time.perf_counter() - began) / max(1, len(s.filters))
            for path in files.save_metrics(found, metrics.summary(found), log_folder, s.name, apply_filters=str(config.infrastructure.apply_filters), elapsed=dict.fromkeys(s.filters, share)):
                logging.info("wrote %s", path)
            release(found)
    survivors = pipeline.survivors(samples)
    if config.infrastructure.save_npy:
        uids.save_uids(survivors, output_folder)
    return survivors


def main(given: list[str] | None = None) -> None:
    args = arguments(given)
    config = settings.read_config(args.config_path) if args.config_path else settings.Config()
    logging.basicConfig(level=config.infrastructure.logging_level, force=True)
    logging.getLogger("py4j").setLevel(logging.WARNING)
    builder = SparkSession.builder.appName("quern")
    spark = (builder.master(args.master) if args.master else builder).getOrCreate()
    model = pair_model_of(args.pair_model) if args.pair_model else None
    run(spark, args.shards_path, config, args.log_folder, args.output_folder, args.patterns_path, pair_model=model)


if __name__ == "__main__":
    main()
