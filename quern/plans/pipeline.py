"""Steps of parallel filter blocks whose surviving uids are merged and handed on."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.explore import MERGES, merged

_KINDS: dict[str, Callable[..., Block]] = {}


class Block(Protocol):
    """Anything that turns samples into a frame of surviving uids."""

    name: str

    def plan(self, samples: DataFrame) -> DataFrame: ...


def registered(name: str) -> Callable[[Callable[..., Block]], Callable[..., Block]]:
    """Make a block factory known by name."""

    def put(make: Callable[..., Block]) -> Callable[..., Block]:
        _KINDS[name] = make
        return make

    return put


def block(name: str, *args, **kwargs) -> Block:
    if name not in _KINDS:
        raise ValueError(f"unknown block {name!r}; one of {sorted(_KINDS)}")
    return _KINDS[name](*args, **kwargs)


class FilterPipeline:
    """One lazy plan: the blocks of a step run over the same samples, a step over what the step before left.

    Between steps only uids pass, by a left semi join below the next step's expressions, so models see survivors
    only. With ``empty_means_all`` a step without survivors hands on everything, as some tools do.
    """

    def __init__(self, uid: str = "uid", empty_means_all: bool = False):
        self.uid, self.empty_means_all = uid, empty_means_all
        self.steps: list[tuple[str, list[Block]]] = []

    def step(self, merge: str = "intersection") -> FilterPipeline:
        if merge not in MERGES:
            raise ValueError(f"unknown merge strategy {merge!r}; one of {MERGES}")
        self.steps.append((merge, []))
        return self

    def add(self, block: Block, at: int = -1) -> FilterPipeline:
        if not -len(self.steps) <= at < len(self.steps):
            raise ValueError(f"Step index {at} not found in the pipeline")
        self.steps[at][1].append(block)
        return self

    def pretty(self) -> str:
        return "\n".join(f"step {i} ({merge}): {', '.join(b.name for b in blocks) or 'empty'}" for i, (merge, blocks) in enumerate(self.steps))

    def survivors(self, samples: DataFrame, uids: DataFrame | None = None) -> DataFrame:
        """Distinct uids after the last step. ``uids``: only these samples take part."""
        for merge, blocks in self.steps:
            if not blocks:
                continue
            own = samples
            if uids is not None and not (self.empty_means_all and uids.isEmpty()):
                own = samples.join(uids, self.uid, "left_semi")
            uids = merged([b.plan(own).select(self.uid) for b in blocks], merge)
        return samples.select(self.uid).distinct() if uids is None else uids

    def subset(self, samples: DataFrame) -> DataFrame:
        """The surviving samples with all their columns."""
        return samples.join(self.survivors(samples), self.uid, "left_semi")


def uid_of(column: str) -> Column:
    """A 32-digit uid from any column."""
    return F.md5(F.col(column).cast("string"))
