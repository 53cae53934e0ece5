"""Embedding near-dedup by dual traversal of cover trees."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tickloom.llm.common import table
from tickloom.llm.components import components
from tickloom.llm.files import new_name, opened
from tickloom.session import scratch, written

COSINE = 0.9
SAMPLE = 1000  # about so many vectors, picked by a hash, make the upper levels
BLOCK = 4096  # vectors of a block, at most
STRIPE_BYTES = 64 << 20  # of a stripe of blocks in double precision; a task compares two stripes
STRIPES = 12  # at least, where there are as many blocks
RADII = (1.0, 0.5, 0.25, 0.125)  # of the levels, on the unit sphere
MARGIN = 1e-7  # bounds on distances are trusted beyond it
SLACK = 1e-9  # cosines within it of the limit are summed exactly
TILE = 1024
OPEN = 1 << 17  # pairs of nodes opened at once
REACH = math.sqrt(2 - 2 * COSINE)


def units(column: pd.Series) -> np.ndarray:
    """Vectors as rows of length 1, in double precision."""
    return scaled(np.stack(column.to_numpy()))


def scaled(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # else squares may over- or underflow
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def stacked(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows, as they are."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, lengths = whole.flatten().to_numpy(zero_copy_only=False), np.diff(whole.offsets.to_numpy())
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError("vectors of different lengths")
    return flat.reshape(len(lengths), -1)


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    x, y = a.astype(np.float64), b.astype(np.float64)
    x, y = x / np.abs(x).max(), y / np.abs(y).max()
    return math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y))


def rounding(width: int) -> float:
    """Twice what a cosine of so many terms may be off in single precision."""
    return (width + 8) * 1.2e-7


def tree(rows: np.ndarray, radii: tuple[float, ...] = RADII) -> np.ndarray:
    """Node numbers of the rows on each level; a node's children lie in it and have half its radius.

    A node is known by the place of its centre, and a centre is the centre of one child too,
    so the levels are nested. Centres of one parent are more than the radius apart, but for rounding.
    """
    low = rows.astype(np.float32)
    cosine = low @ low.T
    levels, parent = [], np.zeros(len(rows), np.int64)
    for radius in radii:
        limit = np.float32(1 - radius * radius / 2 + rounding(rows.shape[1]))
        own = np.arange(len(rows))
        order = np.argsort(parent, kind="stable")
        cuts = np.flatnonzero(np.diff(parent[order])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rows)]):
            if b - a < 2:
                continue
            node = parent[order[a]]
            # the parent's centre comes first, so that it stays a centre
            at = np.concatenate([[node], order[a:b][order[a:b] != node]])
            near = (cosine if b - a == len(rows) and node == 0 else cosine[np.ix_(at, at)]) >= limit
            free = np.ones(b - a, bool)
            for k in range(b - a):
                if free[k]:
                    own[at[k]] = at[k]
                    free[k] = False
                    taken = np.flatnonzero(near[k] & free)
                    own[at[taken]] = at[k]
                    free[taken] = False
        levels.append(own)
        parent = own
    return np.stack(levels, axis=1) if levels else np.zeros((len(rows), 0), np.int64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def leading(sample: np.ndarray) -> np.ndarray | None:
    """Orthonormal directions, as columns, in which few terms tell most vectors apart; None: all terms do it sooner.

    The cosine of two vectors is at most that of their parts along the directions plus the
    product of the lengths of what is left. The number of directions is the one that costs
    least on the pairs of one half of the sample, with directions of the other, and has no
    part in the result.
    """
    if len(sample) < 4:
        return None
    fit, sample = sample[::2], sample[1::2]
    cosine = (sample @ sample.T)[np.triu_indices(len(sample), 1)]
    _, _, axes = np.linalg.svd(fit - fit.mean(axis=0), full_matrices=False)

    def cost(width: int, open_share: float) -> float:  # nanoseconds a pair, as measured
        return 1.2 + 0.02 * width + 0.6 * min(1.0, open_share * TILE * TILE / 4) + 200 * open_share

    best, least = None, cost(sample.shape[1], 0)
    for width in (8, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512):
        if width < sample.shape[1] and width - 1 <= len(axes):
            low = shortened(sample, axes[: width - 1].T)
            bound = (low @ low.T)[np.triu_indices(len(sample), 1)]
            now = cost(width, float(((bound >= COSINE) & (cosine < COSINE)).mean()))
            if now < least:
                best, least = np.ascontiguousarray(axes[: width - 1].T), now
    return best


def shortened(rows: np.ndarray, axes: np.ndarray | None) -> np.ndarray:
    """Rows whose products are no less than the cosines, but for rounding, in single precision."""
    if axes is None:
        return rows.astype(np.float32)
    low = rows @ axes
    rest = rows - low @ axes.T
    return np.column_stack([low, np.sqrt((rest * rest).sum(axis=1))]).astype(np.float32)


class Level(NamedTuple):
    """The nodes of one level of a block's tree; on the lowest, every vector is one."""

    centres: np.ndarray
    owner: np.ndarray  # node of each vector
    sizes: np.ndarray
    radius: np.ndarray  # that covers the node
    children: np.ndarray  # on the next level, by node
    starts: np.ndarray


class Side:
    """One block's vectors and its tree, with the members and covering radius of every node."""

    def __init__(self, raw: np.ndarray, nodes: np.ndarray, axes: np.ndarray | None):
        self.raw, self.rows = raw, scaled(raw)
        self.low = shortened(self.rows, axes)
        every = np.arange(len(raw))
        self.levels = [Level(every, every, np.ones(len(raw), np.int64), np.zeros(len(raw)), every, np.arange(len(raw) + 1))]
        for level in reversed(range(nodes.shape[1])):
            below = self.levels[0]
            centres, owner = np.unique(nodes[:, level], return_inverse=True)
            if 2 * len(centres) > len(below.centres):  # hardly fewer nodes, with wider radii, would keep less apart
                self.levels.insert(0, below._replace(children=np.arange(len(below.centres)), starts=np.arange(len(below.centres) + 1)))
                continue
            off = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", self.rows, self.rows[centres[owner]]), 0))
            radius = np.zeros(len(centres))
            np.maximum.at(radius, owner, np.where(every == centres[owner], 0, off))
            up = owner[below.centres]
            children = np.argsort(up, kind="stable")
            starts = np.searchsorted(up[children], np.arange(len(centres) + 1))
            self.levels.insert(0, Level(centres, owner, np.bincount(owner), radius, children, starts))
        # the first level on which every node is one vector
        self.depth = next(k for k, level in enumerate(self.levels) if len(level.centres) == len(raw))


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number joined with each of 0 to n - 1 by the links of a and b."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(nearer := root[root], root):
            root = nearer


class Found:
    """Numbers of links of the vectors of two sides, and links that join what all links join.

    Right vectors are numbered after the left ones, unless both sides are the same.
    """

    def __init__(self, left: Side, right: Side, same: bool):
        self.left, self.right, self.same = left, right, same
        self.offset = 0 if same else len(left.raw)
        self.n = self.offset + len(right.raw)
        self.last = max(left.depth, right.depth)
        self.added = [[np.zeros(len(x.centres), np.int64) for x in side.levels] for side in (left, right)]
        self.partner = [[np.full(len(x.centres), -1) for x in side.levels] for side in (left, right)]
        self.ends: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def whole(self, level: int, i: np.ndarray, j: np.ndarray) -> None:
        """All vectors of left nodes link with all of right nodes; the bounds say so, and no pair is looked at."""
        a, b = self.left.levels[level], self.right.levels[level]
        alone = (i == j) if self.same else np.zeros(len(i), bool)
        for side, mine, to, size in ((0, i, j, b.sizes), (0 if self.same else 1, j, i, a.sizes)):
            self.added[side][level] += np.bincount(mine[~alone], size[to[~alone]], len(self.added[side][level])).astype(np.int64)
        self.added[0][level][i[alone]] += a.sizes[i[alone]] - 1
        one, two = a.centres[i], b.centres[j] + self.offset
        self.partner[0][level][i] = two
        self.partner[0 if self.same else 1][level][j] = one
        self.note(one[~alone], two[~alone])

    def matrix(self, i: np.ndarray, j: np.ndarray, hit: np.ndarray) -> None:
        """Links of left vectors (rows) and right ones (columns)."""
        self.added[0][self.last][i] += hit.sum(axis=1)
        self.added[0 if self.same else 1][self.last][j] += hit.sum(axis=0)
        for _ in range(8):
            # one row's columns, and all rows that share one of them, make a star
            row = hit.sum(axis=1).argmax()
            cols = np.flatnonzero(hit[row])
            if not len(cols):
                return
            met = np.flatnonzero(hit[:, cols].any(axis=1))
            self.note(np.full(len(cols), i[row]), j[cols] + self.offset)
            self.note(i[met], j[cols[hit[np.ix_(met, cols)].argmax(axis=1)]] + self.offset)
            # of those rows, other columns are joined by one link each
            other = np.flatnonzero(hit[met].any(axis=0))
            self.note(i[met[hit[np.ix_(met, other)].argmax(axis=0)]], j[other] + self.offset)
            hit[met] = False
        r, c = np.nonzero(hit)
        self.note(i[r], j[c] + self.offset)

    def note(self, a: np.ndarray, b: np.ndarray) -> None:
        self.ends.append((a, b))
        self.held += len(a)
        if self.held > 8 * OPEN:
            self.ends = [self.forest()]
            self.held = len(self.ends[0][0])

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        """Links of a star for each component."""
        a, b = (np.concatenate(x) for x in zip((np.zeros(0, np.int64),) * 2, *self.ends))
        root = roots(self.n, a, b)
        at = np.flatnonzero(root != np.arange(self.n))
        return at, root[at]

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of links of all vectors of the left side, and of the right one."""
        return tuple(
            sum(n[level.owner] for n, level in zip(added, side.levels)) for side, added in zip((self.left, self.right), self.added)
        )

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        for k, side in enumerate((self.left,) if self.same else (self.left, self.right)):
            for partner, level in zip(self.partner[k], side.levels):
                to = partner[level.owner]
                at = np.flatnonzero((to >= 0) & (level.sizes[level.owner] > 1))
                self.note(at + (self.offset if k else 0), to[at])
        return self.forest()


def traverse(left: Side, right: Side, same: bool) -> Found:
    """Exact links between two blocks, from the top level down.

    A pair of nodes whose centres are further apart than the reach and both covering radii is
    dropped; one whose every pair must be within reach is taken whole; the others go on to
    their children, and on the lowest level the nodes are vectors. Where many pairs of children
    are open, short products of all of them drop most before any distance is taken.
    """
    found = Found(left, right, same)
    _dense(found, 0, np.arange(len(left.levels[0].centres)), np.arange(len(right.levels[0].centres)), None)
    return found


def _dense(found: Found, level: int, rows: np.ndarray, cols: np.ndarray, above: np.ndarray | None) -> None:
    """Pairs of the nodes whose parents' pair is open, by products of all of them."""
    a, b = found.left.levels[level], found.right.levels[level]
    slack = rounding(found.left.low.shape[1]) + MARGIN
    # nodes of like radius together, so that one limit a row serves a tile
    rows, cols = rows[np.argsort(a.radius[rows], kind="stable")], cols[np.argsort(b.radius[cols], kind="stable")]
    if above is not None:
        up_a, up_b = found.left.levels[level - 1].owner[a.centres], found.right.levels[level - 1].owner[b.centres]
    some: list[tuple[np.ndarray, ...]] = []
    low_a, low_b = found.left.low[a.centres[rows]], found.right.low[b.centres[cols]]
    product, over = np.empty(TILE * TILE // 4, np.float32), np.zeros(TILE * TILE // 4, bool)
    for p in range(0, len(rows), TILE // 4):
        i = rows[p : p + TILE // 4]
        for q in range(0, len(cols), TILE):
            j = cols[q : q + TILE]
            reach = REACH + a.radius[i] + b.radius[j[-1]]
            limit = (1 - reach * reach / 2 - slack).astype(np.float32)
            shape, n = (len(i), len(j)), len(i) * len(j)
            np.matmul(low_a[p : p + len(i)], low_b[q : q + len(j)].T, out=product[:n].reshape(shape))
            if product[:n].max() < limit.min():
                continue
            np.greater_equal(product[:n].reshape(shape), limit[:, None], out=over[:n].reshape(shape))
            over[n : n + -n % 8] = False
            hit = _true(over[: n + -n % 8])
            many = len(hit) * 16 > n
            if many:
                cosine = found.left.rows[a.centres[i]] @ found.right.rows[b.centres[j]].T
            if many and level == found.last:
                for r, c in zip(*np.nonzero(np.abs(cosine - COSINE) < SLACK)):
                    cosine[r, c] = exact_cosine(found.left.raw[i[r]], found.right.raw[j[c]])
                ok = cosine >= COSINE
                if above is not None:
                    ok &= above[up_a[i]][:, up_b[j]]
                if found.same:
                    ordered = i[:, None] < j
                    ok &= ordered if above is None else (up_a[i][:, None] != up_b[j]) & (i[:, None] != j) | ordered
                found.matrix(i, j, ok)
                continue
            r, c = np.divmod(hit, len(j))
            x, y = i[r], j[c]
            cosine = cosine[r, c] if many else _cosines(found, level, x, y)
            if found.same:
                ok = x <= y if above is None else above[up_a[x], up_b[y]] & ((up_a[x] != up_b[y]) | (x <= y))
            else:
                ok = np.ones(len(x), bool) if above is None else above[up_a[x], up_b[y]]
            some.append((x[ok], y[ok], cosine[ok]))
            if sum(len(x) for x, _, _ in some) > OPEN:
                _settle(found, level, *(np.concatenate(x) for x in zip(*some)))
                some = []
    if some:
        _settle(found, level, *(np.concatenate(x) for x in zip(*some)))


def _true(flags: np.ndarray) -> np.ndarray:
    """Places that are true, eight passed over at once where few are."""
    words = np.flatnonzero(flags.view(np.uint64) != 0)
    if len(words) * 16 > len(flags):
        return np.flatnonzero(flags)
    at = (words[:, None] * 8 + np.arange(8)).ravel()
    return at[flags[at]]


def _cosines(found: Found, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    x, y = found.left.levels[level].centres[i], found.right.levels[level].centres[j]
    out = np.empty(len(i))
    for begin in range(0, len(i), 1 << 13):
        part = slice(begin, begin + (1 << 13))
        out[part] = np.einsum("ij,ij->i", found.left.rows[x[part]], found.right.rows[y[part]])
    return out


def _settle(found: Found, level: int, i: np.ndarray, j: np.ndarray, cosine: np.ndarray) -> None:
    """Drops pairs of nodes, takes those that link whole, and opens the rest."""
    left, right, same = found.left, found.right, found.same
    a, b = left.levels[level], right.levels[level]
    if level == found.last:
        for k in np.flatnonzero(np.abs(cosine - COSINE) < SLACK).tolist():
            cosine[k] = exact_cosine(left.raw[i[k]], right.raw[j[k]])
        hit = cosine >= COSINE
        if same:
            hit &= i != j
        if hit.any():
            found.whole(level, i[hit], j[hit])
        return
    apart = np.sqrt(np.maximum(2 - 2 * cosine, 0))
    if same:
        apart[i == j] = 0
    both = a.radius[i] + b.radius[j]
    whole = apart + both <= REACH - 1e-6
    if whole.any():
        found.whole(level, i[whole], j[whole])
    rest = ~whole & (apart <= REACH + both + MARGIN)
    if not rest.any():
        return
    i, j = i[rest], j[rest]
    count_a, count_b = np.diff(a.starts)[i], np.diff(b.starts)[j]
    total = count_a * count_b
    rows, cols = _below(a, np.unique(i)), _below(b, np.unique(j))
    if total.sum() * 64 > len(rows) * len(cols):
        above = np.zeros((len(a.centres), len(b.centres)), bool)
        above[i, j] = True
        _dense(found, level + 1, rows, cols, above)
        return
    ends = np.cumsum(total)
    cuts = np.unique(np.searchsorted(ends, np.arange(OPEN, ends[-1], OPEN)))
    for part in np.split(np.arange(len(i)), cuts):
        if not len(part):
            continue
        pair = np.repeat(part, total[part])
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(total[part]) - total[part], total[part])
        x = a.children[a.starts[i[pair]] + nth // count_b[pair]]
        y = b.children[b.starts[j[pair]] + nth % count_b[pair]]
        if same:  # of a node with itself, each pair of children once
            ok = (i[pair] != j[pair]) | (x <= y)
            x, y = x[ok], y[ok]
        _settle(found, level + 1, x, y, _cosines(found, level + 1, x, y))


def _below(level: Level, nodes: np.ndarray) -> np.ndarray:
    inside = np.zeros(len(level.centres), bool)
    inside[nodes] = True
    return level.children[np.repeat(inside, np.diff(level.starts))]


class Stored(NamedTuple):
    """Where a block lies in the shared folder, its first place, and the cells of its vectors with their radii."""

    pos: int
    name: str
    start: int
    count: int
    width: int
    cells: np.ndarray
    off: np.ndarray


def loaded(folder: str, block: Stored, dtype: str, axes: np.ndarray | None) -> Side:
    store, path = opened(folder)
    with store.open_input_file(f"{path}/{block.name}") as source:
        size = block.count * block.width * np.dtype(dtype).itemsize
        source.seek(block.start)
        raw = source.read(size + 4 * block.count * len(RADII))
    rows = np.frombuffer(raw[:size], dtype).reshape(block.count, block.width)
    return Side(rows, np.frombuffer(raw[size:], "<i4").reshape(block.count, -1).astype(np.int64), axes)


def usable(vector: Column) -> Column:
    """Vectors that can link: finite, without nulls, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def upper_levels(rows: DataFrame, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Centres of the finest level of a tree over a bounded sample, their top-level nodes, and leading directions."""
    sample = rows.filter(F.pmod(F.xxhash64("embedding"), F.lit(count)) < SAMPLE).select("embedding")
    vectors = sample.toPandas()["embedding"]
    if not len(vectors):
        vectors = rows.select("embedding").limit(1).toPandas()["embedding"]
    made = units(vectors)
    nodes = tree(made)
    centres = np.unique(nodes[:, -1])
    return made[centres], nodes[centres, 0], leading(made[centres])


def cut(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Tables of so many rows, in order; the last two are halves of what is left, if it is more."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= 2 * size:
            rest = pa.Table.from_batches(held)
            while rest.num_rows >= 2 * size:
                yield rest.slice(0, size)
                rest = rest.slice(size)
            held = rest.to_batches()
    if held and (rest := pa.Table.from_batches(held)).num_rows:
        half = rest.num_rows // 2 if rest.num_rows > size else rest.num_rows
        yield rest.slice(0, half)
        if half < rest.num_rows:
            yield rest.slice(half)


def near_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every vector.

    Links are all pairs with a cosine of 0.9 or more, in double precision. Vectors that are
    null, empty or zero or hold null or non-finite components link with nothing; vectors of
    different lengths must not be mixed. Repeated vectors link with each other. A null key is
    compared like others and gets the component's smallest key.

    The upper levels of the cover tree are fitted on a bounded sample. All vectors go to their
    nearest centre and are ordered by it, so that each block of BLOCK vectors holds
    neighbouring cells; the task that builds the lower levels of a block writes it to the shared
    folder. A task compares two stripes of blocks and reads them there, so that a vector is
    shuffled and written once whatever the number of pairs of blocks. Two blocks are compared
    unless the covering radii of all their cells keep them apart. Where vectors have no
    neighbours at all in many dimensions no bound can part them, and the time grows with
    the square of the number of blocks; disk and the memory of a task do not, and
    no pair of vectors is sent anywhere.
    """
    spark = vectors.sparkSession
    every = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("embedding"))
    item, dtype = ("float", "<f4") if isinstance(every.schema["embedding"].dataType.elementType, FloatType) else ("double", "<f8")
    every = every.withColumn("embedding", F.col("embedding").cast(f"array<{item}>"))
    good = every.filter(usable(F.col("embedding")))
    loose = every.filter(~F.coalesce(usable(F.col("embedding")), F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    count = good.count()
    if not count:
        return loose
    centres, tops, axes = upper_levels(good, count)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = centres.astype(np.float32).T
        for batch in batches:
            rows = stacked(batch.column("embedding"))
            cell, off = np.zeros(len(rows), np.int64), np.zeros(len(rows))
            for begin in range(0, len(rows), TILE):
                part = slice(begin, begin + TILE)
                made = scaled(rows[part])
                cell[part] = (made.astype(np.float32) @ low).argmax(axis=1)
                off[part] = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", made, centres[cell[part]]), 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("embedding"), pa.array(tops[cell]), pa.array(cell), pa.array(off)],
                ["vec_id", "embedding", "top", "cell", "off"],
            )

    celled = good.mapInArrow(assign, f"vec_id long, embedding array<{item}>, top long, cell long, off double")
    order, size = ["top", "cell", "off", "vec_id"], BLOCK
    parts = max(math.ceil(count / (8 * size)), min(STRIPES, math.ceil(count / size)))
    folder = scratch(spark, "op2-blocks")

    whole, wholes = pa.int64(), pa.list_(pa.int64())
    about = pa.struct({"name": pa.string(), "start": whole, "count": whole, "width": whole, "cells": wholes, "off": pa.list_(pa.float64())})

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, name = new_name(".vec")
        pos, start, out = part << 40, 0, None
        for block in cut(batches, size):
            rows = np.ascontiguousarray(stacked(block.column("embedding")), dtype)
            if out is None:
                store, path = opened(folder)
                store.create_dir(path, recursive=True)
                out = store.open_output_stream(f"{path}/{name}", compression=None)
            out.write(rows.tobytes())
            out.write(tree(scaled(rows)).astype("<i4").tobytes())
            cells, owner = np.unique(block.column("cell").to_numpy(), return_inverse=True)
            off = np.zeros(len(cells))
            np.maximum.at(off, owner, block.column("off").to_numpy())
            n = len(rows)
            first = {"name": name, "start": start, "count": n, "width": rows.shape[1], "cells": cells.tolist(), "off": off.tolist()}
            start = out.tell()
            at = pa.array(np.arange(pos, pos + n))
            ids = pa.concat_arrays(block.column("vec_id").chunks)
            yield pa.RecordBatch.from_arrays([at, ids, pa.array([first] + [None] * (n - 1), about)], ["pos", "vec_id", "block"])
            pos += n
        if out is not None:
            out.close()

    described = "struct<name:string,start:long,count:long,width:long,cells:array<long>,off:array<double>>"
    sent = celled.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    slim = written(sent.mapInArrow(plant, f"pos long, vec_id long, block {described}"), "op2-placed")
    # one row for each block, with the cells in it: at most those of the sample and one for each block
    found = slim.filter("block is not null").select("pos", "block.*").orderBy("pos").collect()
    blocks = [Stored(*r[:5], np.array(r.cells), np.array(r.off)) for r in found]
    stripe = max(1, min(STRIPE_BYTES // (size * blocks[0].width * 8), len(blocks) // STRIPES))
    ends = math.ceil(len(blocks) / stripe)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps = distances(centres, centres)
        for batch in batches:
            for unit in batch.column(0).to_pylist():
                # row by row of the triangle of pairs of stripes
                second = (math.isqrt(8 * unit + 1) - 1) // 2
                first = unit - second * (second + 1) // 2
                sides = [blocks[k * stripe : (k + 1) * stripe] for k in (first, second)]
                for pos, n, other in _stripes(sides, first == second, gaps, lambda b: loaded(folder, b, dtype, axes)):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (pos, n, other)], ["pos", "n", "other"])

    pairs = ends * (ends + 1) // 2
    parts = written(
        spark.range(0, pairs, 1, min(pairs, 1 << 14)).mapInArrow(compare, "pos long, n long, other long"), "op2-links"
    )
    counts = parts.filter("other < 0").groupBy("pos").agg(F.sum("n").alias("n_links"))
    groups = components(parts.filter("other >= 0").select(F.col("pos").alias("a"), F.col("other").alias("b")), "op2")
    rows = slim.select("vec_id", "pos").join(counts, "pos", "left").join(
        groups.withColumnRenamed("id", "pos"), "pos", "left"
    )
    rows = rows.withColumn("component", F.coalesce("component", "pos"))
    least = rows.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    done = rows.join(least, "component").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"),
    )
    return done.unionByName(loose)


def _stripes(sides: list[list[Stored]], same: bool, gaps: np.ndarray, load) -> Iterator[tuple[np.ndarray, ...]]:
    """Places with their numbers of links, and places with others that they are joined with, of two stripes.

    The left stripe is held, blocks of the right one are read in turn.
    """
    left, right = sides
    near = [[k for k, a in enumerate(left[: j + 1] if same else left) if _near(a, b, gaps)] for j, b in enumerate(right)]
    # a block is always compared with itself
    near = [sorted({*ks, j}) if same else ks for j, ks in enumerate(near)]
    held = {k: load(left[k]) for k in sorted({k for ks in near for k in ks})}
    at = np.cumsum([0, *(b.count for b in left), *(() if same else (b.count for b in right))])
    places = np.concatenate([np.arange(b.pos, b.pos + b.count) for b in (left if same else left + right)])
    counts, a, b = np.zeros(len(places), np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for j, ks in enumerate(near):
        other = held[j] if same else load(right[j]) if ks else None
        to = at[j if same else len(left) + j]
        for k in ks:
            itself = same and k == j
            found = traverse(held[k], other, itself)
            mine, theirs = found.totals()
            counts[at[k] : at[k] + len(mine)] += mine
            if not itself:
                counts[to : to + len(theirs)] += theirs
            one, two = found.links()
            for out, x in ((a, one), (b, two)):
                out.append(np.where(x < len(mine), x + at[k], x - len(mine) + to))
        if sum(map(len, a)) > 8 * OPEN:
            root = roots(len(places), np.concatenate(a), np.concatenate(b))
            a = [np.flatnonzero(root != np.arange(len(root)))]
            b = [root[a[0]]]
    root = roots(len(places), np.concatenate(a), np.concatenate(b))
    joined, linked = np.flatnonzero(root != np.arange(len(root))), np.flatnonzero(counts)
    yield places[linked], counts[linked], np.full(len(linked), -1)
    yield places[joined], np.zeros(len(joined), np.int64), places[root[joined]]


def _near(a: Stored, b: Stored, gaps: np.ndarray) -> bool:
    return bool((gaps[np.ix_(a.cells, b.cells)] <= REACH + a.off[:, None] + b.off[None, :] + MARGIN).any())


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return near_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
