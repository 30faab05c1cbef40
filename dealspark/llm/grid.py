"""Members and visitors of tree leaves, dealt to cells of bounded size.

A leaf's members are compared with each other and with its visitors. A leaf with
more than ``MEMBERS`` members or ``VISITORS`` visitors is cut into a grid: each
part of the members meets each part of the visitors in one cell, and members
visit the parts before their own, so every pair still meets exactly once.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealspark.llm.common import stored

MEMBERS, VISITORS = 65_536, 1 << 20

#: Roles in a cell: a member in its part's first cell, in its other cells, and a visitor.
FIRST, AGAIN, VISIT = 0, 1, 2


def dealt(routed: DataFrame, leaf: list[str], key: str, members: int | None = None, visitors: int | None = None) -> DataFrame:
    """``routed`` (the ``leaf`` columns, ``key``, member: boolean, and others)
    with member_part, visitor_part and role, a row for each cell it belongs to."""
    members, visitors = members or MEMBERS, visitors or VISITORS
    sizes = routed.groupBy(*leaf).agg(F.count_if("member").alias("_m"), F.count_if(~F.col("member")).alias("_v"))
    down = F.ceil(F.col("_m") / members).cast("int")
    # members of later parts are visitors too
    across = F.ceil((F.col("_v") + F.when(F.col("_m") > members, F.col("_m")).otherwise(0)) / visitors).cast("int")
    large = stored(sizes.where((F.col("_m") > members) | (F.col("_v") > visitors)).select(
        *leaf, F.greatest(down, F.lit(1)).alias("_down"), F.greatest(across, F.lit(1)).alias("_across")), "grid_large")
    if large.isEmpty():
        return routed.withColumns({"member_part": F.lit(0), "visitor_part": F.lit(0),
                                   "role": F.when(F.col("member"), FIRST).otherwise(VISIT)}).drop("member")
    cut = routed.join(large, leaf, "left").withColumns(
        {"_down": F.coalesce("_down", F.lit(1)), "_across": F.coalesce("_across", F.lit(1))})
    part = F.pmod(F.xxhash64(key), F.col("_down")).cast("int")
    column = F.pmod(F.xxhash64(key, F.lit(1)), F.col("_across")).cast("int")
    cell = lambda p, q, role: F.struct(p.alias("member_part"), q.alias("visitor_part"), role.alias("role"))
    own = F.transform(F.sequence(F.lit(0), F.col("_across") - 1),
                      lambda q: cell(part, q, F.when(q == 0, FIRST).otherwise(AGAIN)))
    below = lambda n: F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")),
                                  lambda p: cell(p, column, F.lit(VISIT)))
    cells = F.when(F.col("member"), F.concat(own, below(part))).otherwise(below(F.col("_down")))
    return cut.withColumn("_cell", F.explode(cells)).select(
        *[c for c in routed.columns if c != "member"], "_cell.member_part", "_cell.visitor_part", "_cell.role")


def links_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A forest (member, smallest member) with the same components as the links a-b."""
    nodes, number = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = number[:len(a)], number[len(a):]
    low = np.arange(len(nodes))
    while True:
        least = np.minimum(low[x], low[y])
        new = low.copy()
        for end in (x, y, low[x], low[y]):
            np.minimum.at(new, end, least)
        new = new[new]
        if (new == low).all():
            break
        low = new
    child = np.flatnonzero(low != np.arange(len(low)))
    return nodes[child], nodes[low[child]]
