"""What the corpus operators share: table access, cutting lineage, text splitting."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import linked
from ..sources.shared import shared_path, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(df: DataFrame, size: str = "4m") -> None:
    """Have Arrow hand texts over in batches of bounded bytes, unless the session says otherwise: texts can be long, and a batch is held on both sides."""
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch") in ("64MB", "67108864b", "67108864"):
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def column(name: str) -> Column:
    """The column of this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def saved(df: DataFrame, kind: str = "cut") -> DataFrame:
    """df, written as Parquet to the shared folder and read again: the lineage is cut and lost executors cost nothing."""
    return written(df, kind)


def local_path(uri: str) -> str | None:
    """The path of a file:// URI or plain path; None for any other store."""
    parsed = urlparse(uri)
    return parsed.path if parsed.scheme in ("", "file") else None


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, runs of anything but ASCII white space, with A-Z lower-cased, in UTF-8; None counts as empty.

    Bytes lower-case and split by exactly those rules.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def runs(batches: Iterator, keys: list[str]) -> Iterator:
    """Pandas frames that each hold all rows of one key, from batches sorted by it.

    Only the rows of the current key are held; callers bound them by splitting large keys beforehand.
    """
    import pandas as pd

    held: list = []
    last = None
    for pdf in batches:
        if not len(pdf):
            continue
        k = pdf[keys].to_numpy()
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        edges = [0, *cuts.tolist(), len(pdf)]
        for a, b in zip(edges, edges[1:], strict=False):
            key = tuple(k[a])
            if held and key != last:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(pdf.iloc[a:b])
            last = key
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def components(edges: DataFrame) -> DataFrame:
    """Connected components: edges (u, v long) to (node, root long) of the nodes that have edges, root being the smallest node reachable. No edges: no rows."""
    found = linked(edges.select(F.col("u").alias("a"), F.col("v").alias("b")))
    return found.select("node", F.col("component").alias("root"))
