"""Connected components of an edge table, in rounds of shuffles; nothing is gathered in one place.

Each round: every task replaces its edges by stars of the groups that they connect (a union-find over its own partition);
nodes hook to the smallest centre they have, centres of one node to each other; then pointers are doubled. Rounds end when
each node has one centre and no centre is a node, or as soon as the edges left, which are counted, are few enough for one
task's union-find to tell the same. Every round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.llm.common import materialise


class Groups:
    """Union-find over 0..n-1; the root of a group is its smallest member."""

    def __init__(self, n: int):
        self.of = list(range(n))
        self.size = [1] * n

    def find(self, x: int) -> int:
        of = self.of
        while of[x] != x:
            of[x] = x = of[of[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.of[b] = a
        self.size[a] += self.size[b]
        return True


def stars(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, centre) of the groups that edges connect; a centre is the smallest id and has no row of its own."""
    ids, at = np.unique(np.concatenate([src, dst]), return_inverse=True)
    groups = Groups(len(ids))
    half = len(src)
    for a, b in zip(at[:half].tolist(), at[half:].tolist(), strict=True):
        groups.join(a, b)
    roots = np.array([groups.find(i) for i in range(len(ids))], np.int64)
    rest = np.flatnonzero(roots != np.arange(len(ids)))
    return ids[rest], ids[roots[rest]]


#: Edges of a task that are joined at a time; a partition of more is handed on in several stars.
TASK_EDGES = 1_000_000
#: Edges that one task finishes; below TASK_EDGES, so that it holds all of them.
ONE_TASK = 400_000


def _local_stars(edges: DataFrame) -> DataFrame:
    def run(batches):
        held, n = [], 0

        def done():
            a, b = stars(np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held]))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["node", "centre"])

        for batch in batches:
            held.append((batch.column("node").to_numpy(zero_copy_only=False), batch.column("centre").to_numpy(zero_copy_only=False)))
            n += batch.num_rows
            if n > TASK_EDGES:
                yield done()
                held, n = [], 0
        if n:
            yield done()

    return edges.mapInArrow(run, "node long, centre long")


def components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, centre): the smallest id of each node's component; components' smallest nodes have no row. Nulls connect nothing."""
    now = edges.select(F.col(src).cast("long").alias("node"), F.col(dst).cast("long").alias("centre")).where("node <> centre")
    while True:
        now = materialise(_local_stars(now), "stars")
        if now.count() <= ONE_TASK:
            return materialise(_local_stars(now.coalesce(1)), "stars")
        least = materialise(now.groupBy("node").agg(F.min("centre").alias("least"), F.count("*").alias("n")), "least")
        centres = now.select(F.col("centre").alias("node")).distinct()
        hooked = now.groupBy("node", "centre").agg(F.lit(1)).select("node", "centre")
        unsettled = least.where("n > 1").limit(1).count() or least.join(centres, "node", "left_semi").limit(1).count()
        if not unsettled:
            return now
        small = least.select("node", "least")
        # centres of one node hook to its smallest; nodes then point to what their centre points to
        hook = hooked.join(small, "node").where("centre <> least").select(F.col("centre").alias("node"), F.col("least").alias("centre"))
        point = small.alias("a").join(small.alias("b"), F.col("a.least") == F.col("b.node"), "left").select(F.col("a.node").alias("node"), F.coalesce(F.col("b.least"), F.col("a.least")).alias("centre"))
        kept = small.select("node", F.col("least").alias("centre"))
        now = materialise(hook.unionByName(point).unionByName(kept).where("node <> centre").distinct(), "edges")
