"""The catalog's requests as methods: plain dicts in and out, KeyError for what is missing, ValueError for bad requests (§2.12)."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import catalog as op
from .operators.stages import TASKS


def as_row(row) -> dict[str, Any]:
    """Dates and times as text."""
    return {k: v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else v for k, v in row.asDict().items()}


class Catalog:
    """Requests over the four tables; lists are limited, since they go to the caller as a whole."""

    def __init__(self, scenes: DataFrame, casts: DataFrame, levels: DataFrame, runs: DataFrame, limit: int = 1_000):
        self.tables, self.limit = {"scenes": scenes, "casts": casts, "levels": levels, "runs": runs}, limit

    def _list(self, df: DataFrame) -> list[dict]:
        return [as_row(r) for r in df.limit(self.limit).collect()]

    def _one(self, table: str, key: str, value: str) -> dict:
        rows = op.by_key(self.tables[table], key, value).collect()
        if not rows:
            raise KeyError(f"no row with {key} {value!r}")
        return as_row(rows[0])

    def health(self) -> dict:
        return {"status": "ok"}

    def tasks(self) -> list[str]:
        return sorted(TASKS)

    def scenes(self, **request) -> list[dict]:
        return self._list(op.find_scenes(self.tables["scenes"], **request))

    def scene(self, scene_id: str) -> dict:
        return self._one("scenes", "scene_id", scene_id)

    def scene_products(self, scene_id: str) -> list[dict]:
        self.scene(scene_id)
        return self._list(op.scene_products(self.tables["runs"], scene_id))

    def profiles(self, **request) -> list[dict]:
        return self._list(op.find_casts(self.tables["casts"], **request))

    def profile(self, cast_id: str) -> dict:
        return self._one("casts", "cast_id", cast_id)

    def depth(self, cast_id: str) -> list[dict]:
        self.profile(cast_id)
        return self._list(op.depth_profile(self.tables["levels"], cast_id))

    def imagery(self, cast_id: str, radius_km: float = 50.0, days_window: int = 30) -> list[dict]:
        """Scenes near a cast, with the status and files that a scene row has."""
        self.profile(cast_id)
        near = op.scenes_near_cast(self.tables["scenes"], self.tables["casts"], cast_id, radius_km, days_window).select("scene_id", F.round("distance_km", 6).alias("distance_km"))
        return self._list(self.tables["scenes"].join(near, "scene_id").orderBy("acquisition_date", "scene_id"))

    def runs(self, **request) -> list[dict]:
        return self._list(op.find_runs(self.tables["runs"], **request))

    def run(self, product_id: str) -> dict:
        return self._one("runs", "product_id", product_id)
