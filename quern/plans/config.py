"""Settings of a filter pipeline, with their checks."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from typing import Any

LANGUAGES = ("en", "it", "es")
SAME_INPUT = "same_input"


def _need(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


@dataclass(frozen=True)
class Infrastructure:
    num_workers: int = 8
    enable_metrics: bool = True
    logging_level: str = "DEBUG"
    save_npy: bool = True
    #: Only "same_input" makes filters report without rejecting; both booleans filter.
    apply_filters: bool | str = True

    @property
    def filtering(self) -> bool:
        return self.apply_filters != SAME_INPUT


@dataclass(frozen=True)
class Unimodal:
    batch_size: int = 4000
    caption_min_words: int = 2
    caption_min_chars: int = 5
    lang_detection_model_path: str | None = "models/lid.176.bin"
    lang_detection_score_threshold: float = 0.7
    lang_detection_language: str = "en"
    tagging_model_name: str = "en_core_web_trf"
    good_captions_pos_distribution_path: str | None = "models/common_pos_patterns.txt"
    image_min_aspect_ratio: float = 0.8
    image_max_aspect_ratio: float = 1.8
    specificity_threshold: float = 0.5
    curvature: float = 1.0
    apply_filters: bool | str = True

    def __post_init__(self):
        _need(self.lang_detection_language in LANGUAGES, f"lang_detection_language must be one of {LANGUAGES}")
        _need(0.1 <= self.lang_detection_score_threshold <= 1.0, "lang_detection_score_threshold must be from 0.1 to 1.0")
        _need(self.batch_size > 0, "batch_size must be positive")
        _need(self.lang_detection_model_path is not None, "lang_detection_model_path must be set")
        _need(0.0 <= self.image_min_aspect_ratio <= 1.0, "image_min_aspect_ratio must be from 0 to 1")
        _need(0.0 <= self.specificity_threshold <= 1.0, "specificity_threshold must be from 0 to 1")
        _need(self.curvature > 0.0, "curvature must be positive")


@dataclass(frozen=True)
class Multimodal:
    batch_size: int = 32
    clip_model: str = "openai/clip-vit-base-patch32"
    clip_score_threshold: float = 0.3

    def __post_init__(self):
        _need(0.0 <= self.clip_score_threshold <= 1.0, "clip_score_threshold must be from 0 to 1")
        _need(self.batch_size > 0, "batch_size must be positive")


@dataclass(frozen=True)
class Config:
    infrastructure: Infrastructure = field(default_factory=Infrastructure)
    unimodal: Unimodal = field(default_factory=Unimodal)
    multimodal: Multimodal = field(default_factory=Multimodal)


def _section(kind: type, given: dict[str, Any] | None):
    given = given or {}
    unknown = given.keys() - {f.name for f in fields(kind)}
    _need(not unknown, f"unknown settings: {sorted(unknown)}")
    return kind(**given)


def config_of(given: dict[str, Any]) -> Config:
    """A Config from nested dictionaries; what is missing has its default."""
    unknown = given.keys() - {"infrastructure", "unimodal", "multimodal"}
    _need(not unknown, f"unknown sections: {sorted(unknown)}")
    return Config(_section(Infrastructure, given.get("infrastructure")), _section(Unimodal, given.get("unimodal")), _section(Multimodal, given.get("multimodal")))


def read_config(path: str) -> Config:
    """A Config from a YAML file (needs PyYAML) or, by its ending, a JSON file."""
    with open(path, encoding="utf-8") as f:
        if path.endswith(".json"):
            import json

            return config_of(json.load(f))
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("PyYAML is not installed; give the settings as a .json file") from e
        return config_of(yaml.safe_load(f) or {})
