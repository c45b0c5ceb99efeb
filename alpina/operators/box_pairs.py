"""Which groups of points come within ``eps`` of each other, by refining grid cells.

Both sides are trees of grid cells: level 0 has side ``eps``, every level halves
it, and a cell carries its number of positions, its summed weight and the
bounding box of its positions. A pair of cells is

  inside   the farthest corners of the boxes are within eps: every point of one
           is a neighbour of every point of the other, and one row says so;
  outside  the nearest corners are farther than eps: dropped;
  test     at most ``LEAF`` pairs of positions are left: tested point by point;
  refine   anything else goes on as pairs of its child cells.

Only cells on the rim of the eps-disc are ever refined, so a dense cell costs
its occupied sub-cells and not the square of its positions. Box distances are
made of the same floating-point steps as point distances; these are monotonic,
so "inside" and "outside" decide exactly as the tests would.

Each level is one written table (a count of pairs to refine is observed while
writing), and nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import shared_path, store

#: Cells are a hair wider than eps so that floating rounding of ``x / side``
#: can never separate two points at distance exactly eps by two cells.
CELL_SLACK = 1.0 + 1e-9
#: pairs of positions that are tested one by one
LEAF = 1024
#: at this level cells have 2^-30 of eps: all that is left is tested
MAX_LEVEL = 30
#: cells of level 0 meet in blocks of 2^BLOCK_BITS cells a side: a cell goes to the blocks around it and not to each cell
BLOCK_BITS = 2

INSIDE, TEST, REFINE = 0, 1, 2


def squared(pairs: list[tuple[Column, Column]]) -> Column:
    """Sum of squared differences, in the order of the dimensions."""
    total = None
    for a, b in pairs:
        t = (a - b) * (a - b)
        total = t if total is None else total + t
    return total


def block_names(k: int) -> list[str]:
    return [f"_t{i}" for i in range(k)]


def in_block(df: DataFrame, cells: list[str], bits: int) -> DataFrame:
    """``df`` with the block (``2^bits`` cells a side) of its cell in ``block_names``."""
    return df.select("*", *[F.shiftright(F.col(c), bits).alias(t) for c, t in zip(cells, block_names(len(cells)))])


def in_blocks_around(df: DataFrame, cells: list[str], bits: int) -> DataFrame:
    """``df`` once for each block that holds its cell or one next to it (two in a dimension at most)."""
    for c, t in zip(cells, block_names(len(cells))):
        around = F.array_distinct(F.array(F.shiftright(F.col(c) - 1, bits), F.shiftright(F.col(c) + 1, bits)))
        df = df.select("*", F.explode(around).alias(t))
    return df


@dataclass
class Near:
    """What ``near_cells`` found: (level, pairs of cells) wholly inside, and those to be tested point by point."""

    inside: list[tuple[int, DataFrame]]
    tested: list[tuple[int, DataFrame]]


class CellTree:
    """Cells of positions ``part, dims..., groups..., w`` at any level."""

    def __init__(self, positions: DataFrame, eps: float, part: str, dims: list[str], groups: list[str]):
        self.part, self.dims, self.groups = part, dims, groups
        self.names = [f"c{i}" for i in range(len(dims))]
        self.side = float(eps) * CELL_SLACK
        self.positions = positions

    def cell(self, level: int) -> list[Column]:
        # scaling by a power of two is exact, so cells of one level nest in those of the level before
        return [F.floor(F.col(d) / F.lit(self.side) * F.lit(float(2 ** level))).cast("long").alias(n)
                for d, n in zip(self.dims, self.names)]

    def at(self, level: int, within: DataFrame | None = None) -> DataFrame:
        """``part, groups, c.., n, w, lo.., hi..`` of one level; only children of the cells ``within`` (``part, groups, c..``)."""
        rows = self.positions.select(self.part, *self.groups, "w", *self.dims, *self.cell(level))
        if within is not None:
            parents = [F.shiftright(F.col(n), 1).alias(f"p{i}") for i, n in enumerate(self.names)]
            keys = within.select(self.part, *self.groups, *[F.col(n).alias(f"p{i}") for i, n in enumerate(self.names)])
            rows = rows.select("*", *parents).join(keys, keys.columns, "left_semi")
        box = [F.min(d).alias(f"lo{i}") for i, d in enumerate(self.dims)] + [F.max(d).alias(f"hi{i}") for i, d in enumerate(self.dims)]
        return rows.groupBy(self.part, *self.groups, *self.names).agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"), *box)


def _prefixed(df: DataFrame, prefix: str, part: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c == part else prefix + c) for c in df.columns])


def near_cells(a: CellTree, b: CellTree, eps: float, differ: tuple[str, str] | None = None,
               leaf: int = LEAF) -> Near:
    """Pairs of cells of ``a`` and ``b`` (same part) that are within ``eps``, in whole or to be tested.

    Columns are those of the trees prefixed ``a_`` and ``b_``. ``differ`` names a
    group column of each side of which the first must be the smaller one; a
    pair of groups is not followed any further once one pair of cells is inside.
    """
    part, k, e2 = a.part, len(a.dims), F.lit(float(eps) * float(eps))
    far = squared([(F.greatest(F.col(f"a_hi{i}") - F.col(f"b_lo{i}"), F.col(f"b_hi{i}") - F.col(f"a_lo{i}")), F.lit(0.0)) for i in range(k)])
    near = squared([(F.greatest(F.lit(0.0), F.col(f"b_lo{i}") - F.col(f"a_hi{i}"), F.col(f"a_lo{i}") - F.col(f"b_hi{i}")), F.lit(0.0)) for i in range(k)])

    def classified(pairs: DataFrame, level: int) -> tuple[DataFrame, dict]:
        kind = (F.when(far <= e2, F.lit(INSIDE))
                 .when((F.col("a_n") * F.col("b_n") <= leaf) | F.lit(level >= MAX_LEVEL), F.lit(TEST)).otherwise(F.lit(REFINE)))
        seen = Observation()
        out = pairs.where(near <= e2).withColumn("kind", kind)
        out = out.drop(*[f"{s}_{x}{i}" for s in "ab" for x in ("lo", "hi") for i in range(k)])
        out = out.observe(seen, *[F.count(F.when(F.col("kind") == x, 1)).alias(f"k{x}") for x in (INSIDE, TEST, REFINE)])
        out = store(out, "cell-pairs", path=shared_path(out.sparkSession, "cell-pairs"))
        return out, seen.get

    A0 = a.at(0)
    B0 = A0 if b is a else b.at(0)
    left, right = in_blocks_around(_prefixed(A0, "a_", part), [f"a_{n}" for n in a.names], BLOCK_BITS), \
        in_block(_prefixed(B0, "b_", part), [f"b_{n}" for n in b.names], BLOCK_BITS)
    pairs = left.join(right, [part] + block_names(k)).drop(*block_names(k))
    for n in a.names:
        pairs = pairs.where(F.abs(F.col(f"a_{n}") - F.col(f"b_{n}")) <= 1)
    if differ:
        pairs = pairs.where(F.col("a_" + differ[0]) < F.col("b_" + differ[1]))
    inside, tested, level = [], [], 0
    linked = None
    while True:
        found, kinds = classified(pairs, level)
        if kinds.get(f"k{INSIDE}"):
            inside.append((level, found.where(F.col("kind") == INSIDE)))
        if kinds.get(f"k{TEST}"):
            tested.append((level, found.where(F.col("kind") == TEST)))
        if not kinds.get(f"k{REFINE}"):
            return Near(inside, tested)
        rest = found.where(F.col("kind") == REFINE).select(part, *[f"a_{g}" for g in a.groups], *[f"a_{n}" for n in a.names],
                                                          *[f"b_{g}" for g in b.groups], *[f"b_{n}" for n in b.names])
        if differ and kinds.get(f"k{INSIDE}"):
            now = inside[-1][1].select(part, "a_" + differ[0], "b_" + differ[1])
            linked = now if linked is None else linked.unionByName(now)
        if linked is not None:
            rest = rest.join(linked.distinct(), linked.columns, "left_anti")
        level += 1

        def children(tree: CellTree, prefix: str) -> DataFrame:
            keys = rest.select(part, *[F.col(prefix + c).alias(c) for c in tree.groups + tree.names]).distinct()
            below = _prefixed(tree.at(level, keys), prefix, part)
            return below.select("*", *[F.shiftright(F.col(prefix + n), 1).alias(f"{prefix}p{i}") for i, n in enumerate(tree.names)])

        up = {f"{s}_{n}": f"{s}_p{i}" for s, t in (("a", a), ("b", b)) for i, n in enumerate(t.names)}
        below_a, below_b = children(a, "a_"), children(b, "b_")
        pairs = (rest.withColumnsRenamed(up).join(below_a, [part] + [f"a_{g}" for g in a.groups] + [f"a_p{i}" for i in range(k)])
                     .join(below_b, [part] + [f"b_{g}" for g in b.groups] + [f"b_p{i}" for i in range(k)])
                     .drop(*up.values()))


def tested_pairs(found: list[tuple[int, DataFrame]], a: CellTree, b: CellTree, eps: float) -> DataFrame | None:
    """Point pairs within ``eps`` of the cell pairs to test, columns of the positions prefixed ``a_`` and ``b_``."""
    part, out = a.part, None
    for level, pairs in found:
        # a level's own n and w of the cells are not those of positions
        keys = pairs.select(part, *[f"a_{c}" for c in a.groups + a.names], *[f"b_{c}" for c in b.groups + b.names])
        A = _prefixed(a.positions.select("*", *a.cell(level)), "a_", part)
        B = _prefixed(b.positions.select("*", *b.cell(level)), "b_", part)
        rows = (keys.join(A, [part] + [f"a_{c}" for c in a.groups + a.names])
                    .join(B, [part] + [f"b_{c}" for c in b.groups + b.names])
                    .where(squared([(F.col("a_" + d), F.col("b_" + d)) for d in a.dims]) <= F.lit(float(eps) * float(eps)))
                    .drop(*[f"a_{n}" for n in a.names], *[f"b_{n}" for n in b.names]))
        out = rows if out is None else out.unionByName(rows)
    return out


def near_aggregate(a: DataFrame, b: DataFrame, eps: float, part: str, dims: list[str], how: str,
                   by: str | None = None, out: str = "value") -> DataFrame:
    """``part, dims..., out`` of the positions of ``a`` with a neighbour in ``b``.

    ``how`` is ``"sum"`` of the neighbours' weight ``w``, or ``"min"`` of their
    column ``by``. ``a`` and ``b`` hold distinct positions (``part, dims..., w``).
    """
    groups = [by] if by else []
    cols = [part, *dims, "w"]
    ta = CellTree(a.select(*cols), eps, part, dims, [])
    tb = CellTree(b.select(*cols, *groups), eps, part, dims, groups)
    found = near_cells(ta, tb, eps)
    value, combine = (F.col("b_" + by), F.min) if by else (F.col("b_w"), F.sum)
    shares = []
    for level, pairs in found.inside:
        names = [f"c{i}" for i in range(len(dims))]
        per_cell = pairs.groupBy(part, *[F.col("a_" + n).alias(n) for n in ta.names]).agg(combine(value).alias("value"))
        shares.append(ta.positions.select(part, *dims, *ta.cell(level)).join(per_cell, [part, *names]).select(part, *dims, "value"))
    tested = tested_pairs(found.tested, ta, tb, eps)
    if tested is not None:
        shares.append(tested.select(part, *[F.col("a_" + d).alias(d) for d in dims], value.alias("value")))
    if not shares:
        return a.select(part, *dims, (F.lit(None).cast(b.schema[by].dataType) if by else F.lit(None).cast("long")).alias(out)).limit(0)
    rows = shares[0]
    for s in shares[1:]:
        rows = rows.unionByName(s)
    return rows.groupBy(part, *dims).agg(combine("value").alias(out))


def near_groups(points: DataFrame, eps: float, part: str, dims: list[str], group: str) -> DataFrame | None:
    """``part, src, dst`` (``src < dst``): groups with a point of each within ``eps`` of one another; None if surely none.

    Pairs of groups found inside at one level are not followed further, so
    groups that touch everywhere cost no more than groups that touch once.
    """
    tree = CellTree(points.select(part, *dims, group, F.lit(1).alias("w")), eps, part, dims, [group])
    found = near_cells(tree, tree, eps, differ=(group, group))
    link = [F.col(part), F.col("a_" + group).alias("src"), F.col("b_" + group).alias("dst")]
    rows = None
    for _, pairs in found.inside:
        new = pairs.select(*link).distinct()
        rows = new if rows is None else rows.unionByName(new)
    tested = tested_pairs(found.tested, tree, tree, eps)
    if tested is not None:
        new = tested.select(*link).distinct()
        rows = new if rows is None else rows.unionByName(new)
    return None if rows is None else rows.distinct()
