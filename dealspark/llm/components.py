"""Connected components of a links table, by alternating stars.

Each task first replaces the links that it reads by a star around the smallest
node of each of its local components, so a node has one link per task at most.
A turn links each node with the parent of the node it hangs on (large star),
then gathers the links of each node and hangs all on the smallest (small star);
it writes one row per node. Nothing is gathered on the driver and no lineage
grows. Links are gathered by the node that hangs, never by what it hangs on, so
a node with very many links does not fill a task; only the join meets it, whose
right side is a stored table, so Spark may split its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealspark.llm.common import stored

#: Links that a task gathers, at least, before it contracts them.
HELD = 1 << 20

LINKS = "u long, v long"
LINKS_ARROW = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def contract(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, roots): each node of these links but the smallest ones of their components, with that smallest one."""
    nodes, number = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = number[:len(u)], number[len(u):]
    root = np.arange(len(nodes))
    while True:
        a, b = root[a], root[b]
        apart = a != b
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(upper := root[root], root):
            root = upper
    below = root != np.arange(len(nodes))
    return nodes[below], nodes[root[below]]


def _contracted(links: DataFrame) -> DataFrame:
    """(u, v): the links (u, v) of each task as stars, u > v."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = v = np.zeros(0, np.int64)
        more, count = [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return contract(*(np.concatenate([held, *[b.column(k).to_numpy() for b in more]]) for k, held in enumerate((u, v))))

        for batch in batches:
            more.append(batch)
            count += batch.num_rows
            if count > max(HELD, len(u)):
                u, v = merged()
                more, count = [], 0
        u, v = merged()
        yield from pa.table([u, v], schema=LINKS_ARROW).to_batches(1 << 16)

    return links.mapInArrow(run, LINKS)


def parents(links: DataFrame) -> DataFrame:
    """(node, component), stored, for each node of ``links`` (a, b: long) but
    the smallest of each component, which names it. Loops and repeated links do not matter."""
    dealt = _contracted(links.where("a is not null and b is not null and a <> b").select(
        F.col("a").alias("u"), F.col("b").alias("v")))
    while True:
        hung = dealt.groupBy("u").agg(F.min("v").alias("v"), F.collect_set("v").alias("all"))
        hung = stored(hung.select("u", "v", F.array_remove("all", F.col("v")).alias("others")), "links")
        above = hung.select(F.col("u").alias("v"), F.col("v").alias("upper"))
        # done when no node has hung on several, and what others hang on hangs on none
        if not any(hung.join(above, "v", "left").agg(F.count_if(F.size("others") > 0), F.count("upper")).first()):
            return hung.select(F.col("u").alias("node"), F.col("v").alias("component"))
        both = hung.select(F.explode(F.concat(F.array("u"), "others")).alias("u"), "v").where("u <> v")
        dealt = _contracted(both).join(above, "v", "left").select("u", F.coalesce("upper", "v").alias("v"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links`` (a, b: long); the component
    is its smallest node. Loops and repeated links do not matter."""
    found = parents(links)
    return found.union(found.select(F.col("component").alias("node"), "component").distinct())
