"""Tables built from one another, each stored under a version made of its inputs.

A model is a plain function that returns a frame; its parameters name its
inputs, which are sources or other models. The version of a source comes from
its files, the version of a model from its name, its settings and the versions
of its inputs. A table is built if its version is not stored, so a changed
source rebuilds what depends on it and nothing else, and a reader never gets a
table that is older than the inputs it asked for.
"""

from __future__ import annotations

import hashlib
import inspect
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import gold, recommend
from .silver import silver_plays

Frame = Callable[[], DataFrame]


@dataclass(frozen=True)
class Source:
    """An input from outside: how to read it, and the version it is in."""

    read: Frame
    version: str


@dataclass(frozen=True)
class Model:
    """A table: the function that makes it, what its version depends on besides, how it is written and read."""

    name: str
    make: Callable[..., DataFrame]
    settings: Mapping[str, object] = field(default_factory=dict)
    write: Callable[[DataFrame, str], None] = lambda df, path: df.write.mode("overwrite").parquet(path)
    read: Callable[[SparkSession, str], DataFrame] = lambda spark, path: spark.read.parquet(path)

    @property
    def inputs(self) -> tuple[str, ...]:
        return tuple(inspect.signature(self.make).parameters)


def files_version(spark: SparkSession, *paths: str) -> str:
    """Names, sizes and times of all files below the paths, as one value; no file is opened.

    The listing is a Spark job, and only its sums come to the driver.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    marks = [F.xxhash64(F.lit(salt), "path", "modificationTime", "length").cast("decimal(38,0)") for salt in (1, 2)]
    row = files.agg(F.count("*"), *[F.sum(m) for m in marks]).first()
    return "-".join(str(v) for v in row)


class Models:
    """Stored tables below ``root``, one folder for each model and version."""

    def __init__(self, spark: SparkSession, root: str, models: Sequence[Model], sources: Mapping[str, Source]) -> None:
        self.spark, self.root, self.sources = spark, root.rstrip("/"), dict(sources)
        self.models = {m.name: m for m in models}
        if len(self.models) < len(models) or self.models.keys() & self.sources.keys():
            raise ValueError("every model and source needs a name of its own")
        for model in models:
            missing = [i for i in model.inputs if i not in self.models and i not in self.sources]
            if missing:
                raise ValueError(f"{model.name} needs {', '.join(missing)}, which nothing provides")
        self.order = self._in_order()
        self.versions = {name: source.version for name, source in self.sources.items()}
        for name in self.order:
            model = self.models[name]
            parts = [name, repr(sorted(model.settings.items())), *(self.versions[i] for i in model.inputs)]
            self.versions[name] = hashlib.sha256("\n".join(parts).encode()).hexdigest()[:24]

    def _in_order(self) -> list[str]:
        """Every model after its inputs."""
        done: list[str] = []
        left = dict(self.models)
        while left:
            ready = [n for n, m in left.items() if not any(i in left for i in m.inputs)]
            if not ready:
                raise ValueError(f"models need each other: {', '.join(left)}")
            done += ready
            for name in ready:
                del left[name]
        return done

    def path(self, name: str) -> str:
        return f"{self.root}/{name}/{self.versions[name]}"

    def is_current(self, name: str) -> bool:
        """The version that the inputs call for is stored; a write that did not end does not count."""
        mark = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(name)}/_SUCCESS")
        return mark.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(mark)

    def build(self, *names: str) -> list[str]:
        """Stores the named models (all, if none is named) and what they need; returns what had to be built, in order."""
        wanted = set(names or self.order)
        for name in reversed(self.order):
            if name in wanted and not self.is_current(name):
                wanted |= {i for i in self.models[name].inputs if i in self.models}
        built = [name for name in self.order if name in wanted and not self.is_current(name)]
        for name in built:
            model = self.models[name]
            frames = [self.sources[i].read() if i in self.sources else self._stored(i) for i in model.inputs]
            model.write(model.make(*frames), self.path(name))
        return built

    def _stored(self, name: str) -> DataFrame:
        return self.models[name].read(self.spark, self.path(name))

    def table(self, name: str) -> DataFrame:
        """The stored table in its current version, built first where that is missing."""
        self.build(name)
        return self._stored(name)

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in names}

    def newest(self, name: str) -> DataFrame | None:
        """The table as it was stored last, whatever its version; None if it never was."""
        fs_path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        fs = fs_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(fs_path):
            return None
        # One folder for each version; superseded ones are dropped by `prune`.
        kept = [s for s in fs.listStatus(fs_path) if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        newest = max(kept, key=lambda s: s.getModificationTime(), default=None)
        return None if newest is None else self.models[name].read(self.spark, newest.getPath().toString())

    def status(self, *names: str) -> DataFrame:
        """``model, current, row_count``: whether the stored table is that of the inputs, and the rows it has; no row is built."""
        out = None
        for name in names or self.order:
            stored = self.newest(name)
            rows = F.lit(0).cast("long") if stored is None else stored.agg(F.count("*").alias("n")).scalar()
            row = self.spark.range(1).select(F.lit(name).alias("model"), F.lit(self.is_current(name)).alias("current"), rows.alias("row_count"))
            out = row if out is None else out.unionByName(row)
        return out

    def prune(self) -> list[str]:
        """Deletes the superseded versions of every model whose current version is stored; returns their paths."""
        gone = []
        for name in self.order:
            if not self.is_current(name):
                continue
            fs_path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            fs = fs_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            for status in fs.listStatus(fs_path):
                if status.getPath().getName() != self.versions[name]:
                    fs.delete(status.getPath(), True)
                    gone.append(status.getPath().toString())
        return gone


def _write_scored(df: DataFrame, path: str) -> None:
    recommend.store_scored(df, path)


def listening_models(as_of: str | None = None, gap_minutes: int = 30) -> list[Model]:
    """Silver, the aggregated tables and the recommendations, from a source called ``bronze``.

    ``as_of`` and ``gap_minutes`` are part of the versions they matter to.
    Without ``as_of`` the day's affinity does not change until an input does.
    """
    dated, spaced = {"as_of": as_of}, {"gap_minutes": gap_minutes}

    def silver(bronze):
        return silver_plays(bronze, as_of)

    def daily(silver_plays):
        return gold.daily_user_stats(silver_plays)

    def tracks(silver_plays):
        return gold.top_tracks(silver_plays)

    def artists(silver_plays):
        return gold.top_artists(silver_plays)

    def devices(silver_plays):
        return gold.device_usage(silver_plays)

    def cooccurrence(silver_plays):
        return recommend.track_cooccurrence(silver_plays, gap_minutes)

    def affinity(silver_plays):
        return recommend.artist_affinity(silver_plays, as_of)

    def scored(silver_plays, artist_affinity):
        items = materialize(recommend.session_items(silver_plays, gap_minutes), "items")
        return recommend.scored_pairs(items, artist_affinity)

    def recommendations(scored_pairs):
        return recommend.best_per_user(scored_pairs)

    return [
        Model("silver_plays", silver, dated),
        Model("daily_user_stats", daily),
        Model("top_tracks", tracks),
        Model("top_artists", artists),
        Model("device_usage", devices),
        Model("track_cooccurrence", cooccurrence, spaced),
        Model("artist_affinity", affinity, dated),
        Model("scored_pairs", scored, spaced, write=_write_scored, read=recommend.stored_scored),
        Model("track_recommendations", recommendations),
    ]
