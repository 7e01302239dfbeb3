"""Version files: what is live in a table, and the watermarks that go with it.

A version is one small JSON file that appears under its final name complete or not at all. The
highest number counts.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import SparkSession

from tablesync import files
from tablesync.sinks.layers import Layer
from tablesync.sinks.report import Mark

# A folder below the table and its number of rows; the live ones of each bucket.
Part = tuple[str, int]
Live = dict[int, list[Part]]


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _moment(text: str | None) -> dt.datetime | None:
    return dt.datetime.fromisoformat(text) if text else None


@dataclass(frozen=True)
class Version:
    """The live folders of each bucket, the layers of later changes that hide rows below them, oldest first,
    the slots by source and target, and the last micro-batch of each stream."""

    number: int = 0
    live: Live = field(default_factory=dict)
    layers: tuple[Layer, ...] = ()
    marks: dict[str, dict[str, dict[str, Any]]] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)

    @property
    def bucket_rows(self) -> int:
        return sum(rows for parts in self.live.values() for _, rows in parts)

    @property
    def layer_rows(self) -> int:
        """Rows in the layers; a key may be in several."""
        return sum(layer.rows for layer in self.layers)

    @property
    def runs(self) -> set[str]:
        folders = [folder for parts in self.live.values() for folder, _ in parts]
        return {folder.split("/")[0] for folder in [*folders, *[layer.folder for layer in self.layers]]}

    def mark(self, source: str, target: str) -> Mark:
        slots = self.marks.get(source, {}).get(target, {})
        return Mark(_moment(slots.get("last_value")), slots.get("last_rowver"))

    def with_mark(self, source: str, target: str, mark: Mark) -> Version:
        slots = {
            "last_value": mark.last_value.isoformat() if mark.last_value else None,
            "last_rowver": mark.last_rowver,
            "updated_at": utc_now().isoformat(),
        }
        return replace(self, marks={**self.marks, source: {**self.marks.get(source, {}), target: slots}})

    def with_live(self, live: Live) -> Version:
        """All rows in buckets: nothing is left in layers."""
        return replace(self, live={b: parts for b, parts in live.items() if parts}, layers=())

    def with_layer(self, layer: Layer, instead_of: int = 0) -> Version:
        """Add a layer on top, in place of some of the newest ones."""
        return replace(self, layers=(*self.layers[: len(self.layers) - instead_of], layer))

    def with_batch(self, stream: str, batch: int) -> Version:
        return replace(self, streams={**self.streams, stream: batch})

    def mark_rows(self) -> list[tuple[Any, ...]]:
        return [
            (source, target, _moment(s["last_value"]), s["last_rowver"], _moment(s["updated_at"]))
            for source, targets in self.marks.items()
            for target, s in targets.items()
        ]

    def to_json(self) -> str:
        live = {str(b): parts for b, parts in sorted(self.live.items())}
        layers = [layer.to_json() for layer in self.layers]
        value = {"number": self.number, "live": live, "layers": layers, "marks": self.marks, "streams": self.streams}
        return json.dumps(value)

    @classmethod
    def from_json(cls, text: str) -> Version:
        value = json.loads(text)
        live = {int(b): [(folder, rows) for folder, rows in parts] for b, parts in value["live"].items()}
        layers = value["layers"] if "layers" in value else [part for part in [value.get("recent")] if part]
        return cls(value["number"], live, tuple(map(Layer.from_json, layers)), value["marks"], value.get("streams", {}))


def published(spark: SparkSession, path: str) -> list[str]:
    """Names of the version files, oldest first."""
    return [n for n in files.names(spark, f"{path}/_versions") if n.endswith(".json")]


def load(spark: SparkSession, path: str, name: str) -> Version:
    return Version.from_json(files.read_text(spark, f"{path}/_versions/{name}"))


def latest(spark: SparkSession, path: str) -> Version:
    found = published(spark, path)
    return load(spark, path, found[-1]) if found else Version()


def publish(spark: SparkSession, path: str, version: Version) -> None:
    """Make a version the next one. Fails if another writer was first."""
    following = replace(version, number=version.number + 1)
    files.publish_text(spark, f"{path}/_versions/{following.number:012d}.json", following.to_json())
