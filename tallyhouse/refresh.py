"""The four-phase batch job: extract, clean, build, load."""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.operators.cleaning import CleaningLog, clean_all
from tallyhouse.operators.modelling import build_star, hold_orders
from tallyhouse.sinks.snapshot import publish, published_sources, read_star
from tallyhouse.sources.raw import load_all_raw, needs_refresh, source_files


class PhaseError(Exception):
    """A phase failed; ``phase`` names it and the cause is chained."""

    def __init__(self, phase: str, cause: Exception) -> None:
        super().__init__(f"{phase}: {cause}")
        self.phase = phase


@contextmanager
def phase(name: str):
    try:
        yield
    except PhaseError:
        raise
    except Exception as error:
        raise PhaseError(name, error) from error


@dataclass
class Report:
    snapshot: str
    cleaning: dict[str, int] = field(default_factory=dict)
    unresolved: dict[str, int] = field(default_factory=dict)


KEYS = ("customer_key", "seller_key", "product_key")


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Shuffle files go when their query has ended, not when the driver next collects its garbage, unless the session says which."""
    if spark.conf.get(FREED, None) is not None:
        yield
        return
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREED)


def unresolved_keys(star: Mapping[str, DataFrame]) -> dict[str, int]:
    """Items of the published fact whose key found no dimension row."""
    return star["fact_orders"].agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in KEYS]).first().asDict()


def build_and_publish(spark: SparkSession, raw: Mapping[str, DataFrame], root: str, sources: DataFrame | None = None) -> Report:
    """Plans stay lazy until load, apart from the staged inputs of medians and keys and the look for repeated rows.

    The fact is computed once, also where a snapshot is published.
    """
    log = CleaningLog()
    with freed_shuffles(spark):
        with phase("clean"):
            clean = clean_all(raw, log)
        with phase("build"):
            star = build_star(hold_orders(clean))
        with phase("load"):
            snapshot = publish(spark, star, root, sources, once=True)
            return Report(snapshot, log.counts(), unresolved_keys(read_star(spark, root)))


def run(spark: SparkSession, folder: str, root: str, files: Mapping[str, str] | None = None) -> Report:
    """The sources are listed before they are read: what lands meanwhile counts as new next time."""
    with phase("extract"):
        sources = source_files(spark, folder, files)
        raw = load_all_raw(spark, folder, files)
    return build_and_publish(spark, raw, root, sources)


def run_if_stale(
    spark: SparkSession, folder: str, root: str, files: Mapping[str, str] | None = None, force: bool = False
) -> Report | None:
    """Rebuild only when forced or when the source files are not those of the published snapshot."""
    with phase("extract"):
        stale = force or needs_refresh(source_files(spark, folder, files), published_sources(spark, root))
    return run(spark, folder, root, files) if stale else None
