"""Quality filters as boolean columns. A null verdict counts as rejected wherever a filter is applied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import geometry, text, vectors


def caption_length(caption: Column, min_words: int = 2, min_chars: int = 5, strict: bool = False) -> Column:
    """At least (``strict``: more than) so many words and code points once stripped."""
    n, size = text.word_count(caption), F.length(text.py_strip(caption))
    return (n > min_words) & (size > min_chars) if strict else (n >= min_words) & (size >= min_chars)


def caption_language(label: Column, score: Column, language: str = "en", threshold: float = 0.7) -> Column:
    """The top label is the wanted one and its score is above the threshold."""
    return (label == f"__label__{language}") & (score > threshold)


def is_language(label: Column, language: str = "en") -> Column:
    """The top label alone decides."""
    return label == f"__label__{language}"


def caption_pos(tags: Column, patterns: list[str]) -> Column:
    """The signature of a caption's tags is one of a short list of patterns; for long lists see with_pattern_flag()."""
    return text.signature(tags).isin(*patterns)


def with_pattern_flag(df: DataFrame, signature: str, patterns: DataFrame, pattern: str = "pattern", name: str = "known_pattern") -> DataFrame:
    """df with a flag: its signature is among the patterns. A left join, planned by Spark on the table's size."""
    known = patterns.select(F.col(pattern).alias("q_pattern")).distinct()
    return df.join(known, F.col(signature) == F.col("q_pattern"), "left").withColumn(name, F.col("q_pattern").isNotNull()).drop("q_pattern")


def aspect_ratio(w: Column, h: Column, least: float = 0.8, most: float = 1.8) -> Column:
    """Strictly between the bounds."""
    r = geometry.ratio(w, h)
    return (r > least) & (r < most)


def image_dims(w: Column, h: Column, min_dim: int = 200, max_ratio: float = 3) -> Column:
    """The smaller side is long enough and the sides' ratio, larger over smaller, below the bound."""
    return (F.least(w, h) >= min_dim) & (geometry.worst_ratio(w, h) < max_ratio)


def pair_score(score: Column, threshold: float = 0.3) -> Column:
    return score > threshold


def embedding_score(image: Column, caption: Column, threshold: float = 0.3, kind: str = "logit", scale: float = 100.0) -> Column:
    """The similarity of two embeddings is above the threshold; ``kind``: 'logit' (scaled) or 'cosine'."""
    if kind not in ("logit", "cosine"):
        raise ValueError("kind is 'logit' or 'cosine'")
    return pair_score(vectors.logit(image, caption, scale) if kind == "logit" else vectors.cosine(image, caption), threshold)


def specific(score: Column, threshold: float = 0.5) -> Column:
    return score > threshold


def confident_caption(label: Column, score: Column, caption: Column, language: str = "en", threshold: float = 0.9) -> Column:
    """The wanted language with a high score, and long enough in the strict sense."""
    return is_language(label, language) & (score > threshold) & caption_length(caption, strict=True)


def descriptive(counts: dict[str, Column]) -> Column:
    """Some adjective, some noun, no number."""
    return (counts["ADJ"] != 0) & (counts["NOUN"] != 0) & (counts["NUM"] == 0)
