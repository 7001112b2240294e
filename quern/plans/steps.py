"""A filter step: named filters applied in order to samples, with kept and rejected rows and metrics."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators import filters, metrics
from quern.plans.config import SAME_INPUT, Config

Predicate = Callable[[DataFrame], Column]


@dataclass
class FilterStep:
    """Filters in order. ``derive`` adds the columns that later filters read; it runs right before its filter,
    so that a model sees only what the filters before it kept."""

    name: str
    filters: dict[str, Predicate] = field(default_factory=dict)
    derive: dict[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)
    uid: str = "uid"
    mode: bool | str = True

    def add(self, name: str, predicate: Predicate, derive: Callable[[DataFrame], DataFrame] | None = None) -> FilterStep:
        self.filters[name] = predicate
        if derive:
            self.derive[name] = derive
        return self

    def kept(self, samples: DataFrame) -> DataFrame:
        """The samples that all filters keep; all samples in the same-input mode."""
        if self.mode == SAME_INPUT:
            return samples
        columns = samples.columns
        for name, predicate in self.filters.items():
            if name in self.derive:
                samples = self.derive[name](samples)
            samples = samples.where(F.coalesce(predicate(samples), F.lit(False)))
        return samples.select(*columns)

    def flagged(self, samples: DataFrame) -> DataFrame:
        """The samples with a boolean column ok_<filter> for every filter, each judged on all rows."""
        for name, predicate in self.filters.items():
            if name in self.derive:
                samples = self.derive[name](samples)
            samples = samples.withColumn(f"ok_{name}", F.coalesce(predicate(samples), F.lit(False)))
        return samples

    def rejected(self, samples: DataFrame) -> DataFrame:
        """The samples that some filter rejects, with the first one that does."""
        out = self.flagged(samples)
        first = F.coalesce(*(F.when(~F.col(f"ok_{n}"), F.lit(n)) for n in self.filters))
        return out.withColumn("rejected_by", first).where(F.col("rejected_by").isNotNull()).select(*samples.columns, "rejected_by")

    def measured(self, samples: DataFrame, batch: str = "batch_id") -> DataFrame:
        """Counts by filter and batch, as metrics.per_batch()."""
        return self._counted(self.flagged(samples), batch)

    def measured_in_order(self, samples: DataFrame, order: str, size: int) -> DataFrame:
        """measured() in batches of ``size`` rows in order, from 1. Rows are judged where they are; only verdicts are sorted and numbered."""
        from quern.operators.explore import with_index

        light = self.flagged(samples).select(order, *(f"ok_{n}" for n in self.filters))
        return self._counted(with_index(light, order, name="q_index").withColumn("batch_id", F.floor(F.col("q_index") / size).cast("int") + 1), "batch_id")

    def _counted(self, flagged: DataFrame, batch: str) -> DataFrame:
        return metrics.per_batch(flagged, {n: f"ok_{n}" for n in self.filters}, batch, cascade=self.mode != SAME_INPUT)

    def plan(self, samples: DataFrame) -> DataFrame:
        """The uids that are left."""
        return self.kept(samples).select(self.uid)


def text_step(config: Config, language: Callable[[Column], Column], tags: Callable[[Column], Column], patterns: DataFrame | None = None, caption: str = "txt") -> FilterStep:
    """Length, then language, then part-of-speech signature. language: caption to struct(label, score); tags: caption to array."""
    from quern.functions.text import signature

    u = config.unimodal
    step = FilterStep("text", mode=config.infrastructure.apply_filters)
    step.add("caption_length", lambda df: filters.caption_length(F.col(caption), u.caption_min_words, u.caption_min_chars))
    step.add("caption_language", lambda df: filters.caption_language(F.col("q_lang.label"), F.col("q_lang.score"), u.lang_detection_language, u.lang_detection_score_threshold), lambda df: df.withColumn("q_lang", language(F.col(caption))))
    if patterns is not None:
        step.add("caption_pos", lambda df: F.col("known_pattern"), lambda df: filters.with_pattern_flag(df.withColumn("q_signature", signature(tags(F.col(caption)))), "q_signature", patterns))
    return step


def vision_step(config: Config, width: str = "width", height: str = "height") -> FilterStep:
    u = config.unimodal
    return FilterStep("vision", mode=config.infrastructure.apply_filters).add("aspect_ratio", lambda df: filters.aspect_ratio(F.col(width), F.col(height), u.image_min_aspect_ratio, u.image_max_aspect_ratio))


def pair_step(config: Config, score: Callable[[DataFrame], Column] | None = None, derive: Callable[[DataFrame], DataFrame] | None = None) -> FilterStep:
    """Image and caption agree. score: samples to a score column; or derive: samples to samples with a column q_score."""
    t = config.multimodal.clip_score_threshold
    return FilterStep("multimodal", mode=config.infrastructure.apply_filters).add("clip_score", lambda df: filters.pair_score(F.col("q_score"), t), derive or (lambda df: df.withColumn("q_score", score(df))))


def parameters(values: Mapping[str, object]) -> str:
    """Parameters of a filter as the text that metrics carry."""
    return str(dict(values))
