"""MinHash near-dedup by a chosen-path set similarity join."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import running, table
from tickloom.llm.components import components
from tickloom.llm.words import Words, encoded, mixed, scan, slices, spread
from tickloom.session import written

SHINGLE = 2
SIMILARITY = (80, 100)  # 100 * intersection >= 80 * union
TREES = 16  # a pair of similarity 0.8 that k branchings must not part is missed by all with (1 - 0.8^k)^16
COORDINATES = 128
LEAF = 1024  # nodes up to this many sets are compared exhaustively
FIRST, FIRST_LOOSE = 32, 14  # coordinates looked at first, and how many must agree: at 0.8, 5 deviations below
LOOSE = 82  # agreeing coordinates, of 128, of a pair that goes on to the exact test: at 0.8, 4.5 deviations below
SALTS = 64  # places in which a large node meets its pivot
TIGHT = 116  # agreeing coordinates that let a large node leave a set to its pivot
GROUP_SETS, GROUP_SHINGLES = 4096, 4_000_000  # a group within both is settled by one task
BLOCK_SETS, BLOCK_SHINGLES = 1024, 1_000_000  # of larger groups, a task compares two blocks of about so much

_rng = np.random.default_rng(20240131)
_MULTIPLY = _rng.integers(1, 1 << 32, COORDINATES, dtype=np.uint32) | np.uint32(1)
_MASK = _rng.integers(0, 1 << 32, COORDINATES, dtype=np.uint32)


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the runs of ``size`` words of each text.

    A text of fewer words has one run, all of them in order; one without words has none.
    """
    h = words.hash
    runs = h.copy()
    for k in range(1, size):
        runs = runs[:-1] if len(runs) else runs
        runs = mixed(runs * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(runs)])
    out = []
    for a, b in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(runs[a : b - size + 1]))
        elif b > a:
            whole = h[a]
            for x in h[a + 1 : b]:
                whole = mixed(whole * np.uint64(0xC2B2AE3D27D4EB4F) + x)
            out.append(np.atleast_1d(mixed(np.atleast_1d(whole) + np.uint64(b - a))))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minwise value of a set under each coordinate's hash."""
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for begin in range(0, len(high), 4096):
        part = (high[begin : begin + 4096] ^ _MASK[:, None]) * _MULTIPLY[:, None]
        best = np.minimum(best, part.min(axis=1))
    return best


def sketch(values: np.ndarray) -> np.ndarray:
    """One byte of each minwise value; unequal values agree by chance once in 256."""
    return ((values * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def set_class(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    if not len(shingles):
        return b""
    a = np.bitwise_xor.reduce(mixed(shingles))
    b = np.add.reduce(mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    return np.array([a, b], "<u8").tobytes()


def profiles(documents: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``id``, ``n_shingles``, ``class`` (equal for equal sets, empty for none), and the minwise values."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = encoded(batch.column(1).to_pylist())
            for begin, end in slices(texts):
                sets = shingle_sets(scan(texts[begin:end], lower=True), size)
                values = [signature(s) if len(s) else np.zeros(0, np.uint32) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_class(s) for s in sets], pa.binary()),
                        pa.array([v.astype("<u4").tobytes() for v in values], pa.binary()),
                        pa.array([sketch(v).tobytes() for v in values], pa.binary()),
                    ],
                    names=["id", "n_shingles", "class", "values", "sketch"],
                )

    rows = documents.select(F.col(key).cast("long").alias("id"), F.col(text))
    return rows.mapInArrow(work, "id long, n_shingles long, class binary, values binary, sketch binary")


def grouped(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Frames of the rows with one key, from batches that are sorted by it."""
    rest: pd.DataFrame | None = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        keys = batch[key].to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist()):
            yield batch.iloc[a:b]
        rest = batch.iloc[cuts[-1] if len(cuts) else 0 :]
    if rest is not None and len(rest):
        yield rest


def _stacked(column: pd.Series, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype).reshape(len(column), -1)


def agreeing(rows: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Number of equal bytes in rows of a multiple of 8 bytes."""
    same = np.ascontiguousarray(rows == other).view(np.uint64)
    return np.bitwise_count(same).sum(axis=1, dtype=np.int64)


def loose_links(ids: np.ndarray, sizes: np.ndarray, sketches: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that join what loose pairs join, from comparing all pairs of a small node.

    In order of size, the sets whose sizes allow a link follow each other. Links go to the
    smallest id of what is joined, which other trees find too.
    """
    part, whole = SIMILARITY
    order = np.argsort(sizes, kind="stable")
    ids, sizes, sketches = ids[order], sizes[order], sketches[order]
    first = np.ascontiguousarray(sketches[:, :FIRST])
    upto = np.searchsorted(sizes, sizes * whole // part, side="right").tolist()
    root = np.arange(len(ids))
    for i, end in enumerate(upto):
        if end <= i + 1:
            continue
        at = i + 1 + np.flatnonzero(agreeing(first[i + 1 : end], first[i]) >= FIRST_LOOSE)
        if len(at):
            at = at[agreeing(sketches[at], sketches[i]) >= LOOSE]
            for r in set(root[at].tolist()) - {int(root[i])}:
                root[root == r] = root[i]
    least = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(least, root, ids)
    for a, b in zip(least[root].tolist(), ids.tolist()):
        if a != b:
            yield a, b


def _pairs(rows: Iterator[tuple[int, int]]) -> pd.DataFrame:
    found = list(rows)
    return pd.DataFrame({"a": [a for a, _ in found], "b": [b for _, b in found]}, dtype=np.int64)


def compare_leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in grouped(batches, "node"):
        if len(frame) > 1:
            links = loose_links(frame["id"].to_numpy(), frame["n_shingles"].to_numpy(), _stacked(frame["sketch"], np.uint8))
            yield _pairs(links)


def next_node(node: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The child of a node that a set goes to, by its minwise value at the coordinate the node draws."""
    spread_ = mixed(node.astype(np.int64).view(np.uint64))
    chosen = values[np.arange(len(node)), (spread_ % np.uint64(COORDINATES)).astype(np.int64)]
    return mixed(spread_ ^ chosen.astype(np.uint64)).view(np.int64)


def plant(reps: DataFrame) -> DataFrame:
    """``node`` and ``id``: every set goes to one child of the root of each tree."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            if not len(frame):
                continue
            values, ids = _stacked(frame["values"], "<u4"), frame["id"].to_numpy()
            for tree in range(TREES):
                node = next_node(np.full(len(ids), tree), values)
                yield pd.DataFrame({"node": node, "id": ids})

    return reps.select("id", "values").mapInPandas(work, "node long, id long")


def branch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sets of large nodes against their pivots: links to it, and the children that all but tight ones go to.

    A set that agrees with one left to the pivot in LOOSE coordinates agrees with the pivot in
    LOOSE + TIGHT - COORDINATES of them at least, whatever their sizes are; so these are linked.
    """
    for frame in batches:
        if not len(frame):
            continue
        sizes, other = frame["n_shingles"].to_numpy(), frame["pivot_n"].to_numpy()
        agree = agreeing(_stacked(frame["sketch"], np.uint8), _stacked(frame["pivot_sketch"], np.uint8))
        part, whole = SIMILARITY
        fits = whole * np.minimum(sizes, other) >= part * np.maximum(sizes, other)
        own = frame["id"].to_numpy() == frame["pivot"].to_numpy()
        child = next_node(frame["node"].to_numpy(), _stacked(frame["values"], "<u4"))
        yield pd.DataFrame(
            {
                "node": frame["node"],
                "child": child,
                "id": frame["id"].to_numpy(),
                "pivot": frame["pivot"].to_numpy(),
                "linked": (agree >= LOOSE + TIGHT - COORDINATES) & ~own,
                "stays": own | ~(fits & (agree >= TIGHT)),
            }
        )


def tiled(made: DataFrame, rest: DataFrame) -> DataFrame:
    """Leaves (``node``, ``id``) of large nodes of which all but a leaf's worth of sets are linked to the pivot.

    Linked sets are in one component already. They are dealt to tiles of about LEAF, and the
    others, ``rest``, stand in every tile, so these meet all sets of the node and the work
    grows with the node's size, not with its square.
    """
    number = F.pmod(F.xxhash64("id", "node"), F.col("tiles"))
    near = made.filter("linked or id = pivot").join(rest, "node").select("node", number.alias("tile"), "id")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    far = made.filter("not linked and id <> pivot").join(rest, "node").select("node", every.alias("tile"), "id")
    return near.unionByName(far).select(F.xxhash64("node", "tile").alias("node"), "id")


def chosen_paths(reps: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Grows the trees: leaves (``node``, ``id``), links of leaves, and links to pivots.

    A node draws a coordinate and parts its sets by their minwise value there. Nodes of up to
    LEAF sets are leaves. A larger node first compares all its sets with one pivot, its least
    id, which other trees often have too. If no more than LEAF sets are not linked to it,
    loosely, the node ends in tiles. Otherwise its sets go on to its children, but for those
    all but equal to the pivot (TIGHT), since whatever is similar to them is linked to the
    pivot too. So a node of near copies ends in one round, and no task ever holds a large node.
    """
    spark = reps.sparkSession
    front = written(plant(reps), "op8-front")
    leaves: list[DataFrame] = []
    pivots: list[DataFrame] = []
    level = 0
    while True:
        counts = front.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("pivot"))
        placed = written(front.join(counts.filter("n > 1"), "node"), f"op8-nodes{level}")
        leaves.append(placed.filter(F.col("n") <= LEAF).select("node", "id"))
        large = placed.filter(F.col("n") > LEAF)
        if large.isEmpty():
            break
        sets = reps.select("id", "n_shingles", "values", "sketch")
        pivot = reps.select(
            F.col("id").alias("pivot"), F.col("n_shingles").alias("pivot_n"), F.col("sketch").alias("pivot_sketch")
        )
        # a node's sets meet its pivot in several places, so that a node of any size is spread
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        chosen = large.select("node", "pivot").distinct().join(pivot, "pivot").select("*", salts)
        salted = large.select("node", "id", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
        rows = salted.join(sets, "id").join(chosen, ["node", "salt"]).drop("salt")
        made = written(
            rows.mapInPandas(branch, "node long, child long, id long, pivot long, linked boolean, stays boolean"),
            f"op8-large{level}",
        )
        pivots.append(made.filter("linked").select(F.col("pivot").alias("a"), F.col("id").alias("b")))
        far = F.count(F.when(~F.col("linked") & (F.col("id") != F.col("pivot")), 1))
        sized = made.groupBy("node").agg(far.alias("far"), F.count(F.lit(1)).alias("n"))
        tiles = F.ceil((F.col("n") - F.col("far")) / LEAF).alias("tiles")
        sized = written(sized.select("node", tiles, (F.col("far") <= LEAF).alias("ends")), f"op8-ends{level}")
        leaves.append(tiled(made, sized.filter("ends").select("node", "tiles")))
        on = made.filter("stays").join(sized.filter("not ends").select("node"), "node")
        front = on.select(F.col("child").alias("node"), "id")
        level += 1
    found = leaves[0]
    for more in leaves[1:]:
        found = found.unionByName(more)
    sketches = reps.select("id", "n_shingles", "sketch")
    compared = found.join(sketches, "id").repartition("node").sortWithinPartitions("node")
    links = compared.mapInPandas(compare_leaves, "a long, b long")
    to_pivots = spark.createDataFrame([], "a long, b long")
    for more in pivots:
        to_pivots = to_pivots.unionByName(more)
    return found, written(links.distinct(), "op8-leaf-links"), written(to_pivots.distinct(), "op8-pivot-links")


def confirmed(ids: np.ndarray, sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links that join what exact links join among the sets of one group.

    Each set is counted against all that no link has reached yet, in one pass over their
    shingles: no pair is left out.
    """
    part, whole = SIMILARITY
    numbers = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    present = np.zeros(int(numbers.max()) + 1, bool)
    left, held, begins = np.arange(len(sets)), numbers, starts
    while len(left) > 1:
        todo = [left[0]]
        keep = np.arange(1, len(left))
        while todo:
            if len(keep) < len(left):
                left = left[keep]
                held = numbers[spread(starts[left], sizes[left])]
                begins = np.cumsum(sizes[left]) - sizes[left]
            if not len(left):
                return
            i = todo.pop()
            own = numbers[starts[i] : starts[i] + sizes[i]]
            present[own] = True
            both = np.add.reduceat(present[held].view(np.int8), begins, dtype=np.int64)
            present[own] = False
            hit = whole * both >= part * (sizes[i] + sizes[left] - both)
            for j in left[hit]:
                yield int(ids[i]), int(ids[j])
            todo += left[hit].tolist()
            keep = np.flatnonzero(~hit)
        if len(keep) < len(left):
            left = left[keep]
            held = numbers[spread(starts[left], sizes[left])]
            begins = np.cumsum(sizes[left]) - sizes[left]


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    part, whole = SIMILARITY
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return whole * both >= part * (len(a) + len(b) - both)


def full_sets(documents: DataFrame, key: str, text: str, size: int, wanted: DataFrame) -> DataFrame:
    """Adds ``shingles`` (the full set, 64-bit hashes) to the rows ``wanted`` (``id``, ``class`` and more)."""
    rows = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("_text")).join(wanted, "id")
    names = wanted.columns
    schema = wanted.schema.add("shingles", "binary")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            texts = encoded(frame["_text"])
            for begin, end in slices(texts):
                part = frame.iloc[begin:end]
                sets = shingle_sets(scan(texts[begin:end], lower=True), size)
                # another row of the same id may have another text
                same = np.array([set_class(s) == bytes(c) for s, c in zip(sets, part["class"])], bool)
                out = part.loc[same, names].assign(shingles=[s.tobytes() for s, ok in zip(sets, same) if ok])
                yield out

    return rows.mapInPandas(work, schema)


def _sets(frame: pd.DataFrame) -> list[np.ndarray]:
    return [np.frombuffer(s, np.uint64) for s in frame["shingles"]]


def by_group(key: str) -> Callable:
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in grouped(batches, key):
            frame = frame.drop_duplicates("id").sort_values("id")
            yield _pairs(confirmed(frame["id"].to_numpy(), _sets(frame)))

    return work


def settled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Components of groups that a task holds whole."""
    for frame in grouped(batches, "component"):
        frame = frame.drop_duplicates("id").sort_values("id")
        home: dict[int, int] = {}
        for a, b in confirmed(frame["id"].to_numpy(), _sets(frame)):
            home[b] = home.setdefault(a, a)
        yield pd.DataFrame({"id": list(home), "component": list(home.values())}, dtype=np.int64)


def large_group_links(sets: DataFrame, leaves: DataFrame, pivots: DataFrame) -> DataFrame:
    """Exact links among sets of groups that no task may hold whole, as far as the trees show
    them: those inside the leaves of all trees, and those to the pivots of large nodes."""
    inside = leaves.join(sets, "id").repartition("node").sortWithinPartitions("node")
    links = inside.mapInPandas(by_group("node"), "a long, b long")
    first = sets.select(F.col("id").alias("a"), "shingles")
    second = sets.select(F.col("id").alias("b"), F.col("shingles").alias("other"))
    tested = pivots.join(first, "a").join(second, "b").mapInPandas(pairs_linked, "a long, b long")
    return links.unionByName(tested)


def pairs_linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        mine = [np.frombuffer(s, np.uint64) for s in frame["shingles"]]
        other = [np.frombuffer(s, np.uint64) for s in frame["other"]]
        ok = np.array([linked(x, y) for x, y in zip(mine, other)], bool)
        yield frame.loc[ok, ["a", "b"]]


def compare_apart(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links that join sets of one block (``apart``) with those of another, on full sets.

    Each set is counted against all whose sizes allow a link, in one pass over their shingles,
    unless all of them are joined with it already.
    """
    part, whole = SIMILARITY
    for frame in grouped(batches, "pair"):
        frame = frame.drop_duplicates(["apart", "id"]).sort_values(["apart", "n_shingles", "id"])
        ids, sizes, label = frame["id"].to_numpy(), frame["n_shingles"].to_numpy(), frame["label"].to_numpy().copy()
        n = int((~frame["apart"].to_numpy()).sum())  # these come first, in order of size
        numbers = np.unique(np.concatenate(_sets(frame)), return_inverse=True)[1].astype(np.int32)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        present = np.zeros(int(numbers.max()) + 1, bool)
        links = []
        for i in range(n, len(ids)):
            a = int(np.searchsorted(sizes[:n], -(-sizes[i] * part // whole)))
            b = int(np.searchsorted(sizes[:n], sizes[i] * whole // part, side="right"))
            if not (label[a:b] != label[i]).any():
                continue
            own = numbers[starts[i] : starts[i + 1]]
            present[own] = True
            both = np.add.reduceat(present[numbers[starts[a] : starts[b]]].view(np.int8), starts[a:b] - starts[a], dtype=np.int64)
            present[own] = False
            for j in a + np.flatnonzero(whole * both >= part * (sizes[i] + sizes[a:b] - both)):
                if label[j] != label[i]:
                    links.append((int(ids[i]), int(ids[j])))
                    label[label == label[j]] = label[i]
        yield _pairs(iter(links))


def apart_links(sets: DataFrame, known: DataFrame) -> DataFrame:
    """Exact links that the trees left out in groups that no task may hold whole.

    ``known`` has the components of the exact links found so far. Of two sets of a group that
    are not joined by them, one at least is outside of the group's largest component; so the
    sets outside, in blocks, are compared with all sets of the group, in blocks, on full sets.
    No pair is left out but those whose sizes rule out a link. Sets that the trees joined as
    they should cost nothing; where many are apart, work grows with their number times that of
    the group, and a task's memory does not.
    """
    part, whole = SIMILARITY
    slim = sets.select("id", "component", "n_shingles").dropDuplicates(["id"])
    slim = slim.join(known.select("id", F.col("component").alias("label")), "id", "left")
    slim = written(slim.withColumn("label", F.coalesce("label", "id")), "op8-labels")
    sized = slim.groupBy("component", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = sized.groupBy("component").agg(F.max(F.struct("n", "label"))["label"].alias("main"))
    # one row for each of the large groups
    marked = slim.join(F.broadcast(largest), "component")
    outside = marked.filter("label <> main").drop("main")

    def in_blocks(rows: DataFrame, name: str, apart: bool) -> tuple[DataFrame, DataFrame]:
        placed = running(rows, ["component", "n_shingles", "id"], {"_nth": F.lit(1), "_sum": F.col("n_shingles")}, name)
        block = F.concat_ws("-", F.floor(F.col("_nth") / BLOCK_SETS), F.floor(F.col("_sum") / BLOCK_SHINGLES))
        placed = written(placed.withColumns({"block": block, "apart": F.lit(apart)}).drop("_nth", "_sum"), f"{name}-blocks")
        return placed, placed.groupBy("component", "block").agg(F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high"))

    ours, first = in_blocks(outside, "op8-outside", True)
    every, second = in_blocks(slim, "op8-inside", False)
    a, b = first.alias("a"), second.alias("b")
    fits = (F.col("a.low") * part <= F.col("b.high") * whole) & (F.col("b.low") * part <= F.col("a.high") * whole)
    pairs = a.join(b, (F.col("a.component") == F.col("b.component")) & fits).select(
        "a.component",
        F.col("a.block").alias("one"),
        F.col("b.block").alias("other"),
        F.concat_ws(" ", "a.component", "a.block", "b.block").alias("pair"),
    )
    pairs = written(pairs, "op8-blocks")
    ours = ours.join(pairs.withColumnRenamed("one", "block").drop("other"), ["component", "block"])
    every = every.join(pairs.withColumnRenamed("other", "block").drop("one"), ["component", "block"])
    sent = ours.unionByName(every).select("pair", "apart", "id", "n_shingles", "label").join(sets.select("id", "shingles"), "id")
    return sent.repartition("pair").sortWithinPartitions("pair").mapInPandas(compare_apart, "a long, b long")


def large_groups(sets: DataFrame, leaves: DataFrame, pivots: DataFrame) -> DataFrame:
    """``id`` and ``component`` of sets of groups that no task may hold whole."""
    known = written(components(large_group_links(sets.select("id", "shingles"), leaves, pivots), "op8-exact"), "op8-known")
    more = written(apart_links(sets, known), "op8-apart")
    if more.isEmpty():
        return known
    return components(known.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more), "op8-joined")


def near_components(documents: DataFrame, key: str, text: str, size: int = SHINGLE) -> DataFrame:
    """``id``, ``n_shingles``, ``component_id`` and ``kept`` for every document.

    Documents are linked if their sets of shingles have a Jaccard similarity of 0.8 or more,
    confirmed on full sets. Equal sets are taken together first. The trees give loose links,
    whose components hold the true links; a component of bounded size is settled by one task
    on full sets, a larger one leaf by leaf and pivot by pivot, and what these leave apart
    block by block, so all its links count and no task holds it whole.
    Repeated rows share their component. A null id is in no component: ``component_id`` is
    null and the row is kept. Texts without words link with nothing.
    """
    rows = written(profiles(documents, key, text, size), "op8-profiles")
    some = rows.filter("id is not null and n_shingles > 0")
    classes = written(some.groupBy("class").agg(F.min("id").alias("rep")), "op8-classes")
    reps = some.join(classes, (some["class"] == classes["class"]) & (some["id"] == classes["rep"])).select(
        some["*"]
    )
    # an id may stand for several classes if it occurs with several texts; then each gets a number
    reps = reps.dropDuplicates(["class"]).withColumn("doc", F.col("id")).withColumn("id", F.xxhash64("class"))
    reps = written(reps, "op8-sets")
    leaves, leaf_links, pivot_links = chosen_paths(reps)
    loose = written(components(leaf_links.unionByName(pivot_links), "op8-loose"), "op8-groups")
    sized = reps.select("id", "n_shingles", "class", "doc").join(loose, "id")
    totals = sized.groupBy("component").agg(F.count(F.lit(1)).alias("sets"), F.sum("n_shingles").alias("shingles"))
    fits = (F.col("sets") <= GROUP_SETS) & (F.col("shingles") <= GROUP_SHINGLES)
    wanted = sized.join(totals.select("component", fits.alias("fits")), "component").select(
        F.col("doc").alias("id"), F.col("id").alias("set_id"), "class", "component", "n_shingles", "fits"
    )
    sets = written(
        full_sets(documents, key, text, size, wanted).drop("id", "class").withColumnRenamed("set_id", "id"), "op8-full"
    )
    small = sets.filter("fits").drop("fits", "n_shingles").repartition("component").sortWithinPartitions("component")
    groups = small.mapInPandas(settled, "id long, component long")
    rest = sets.filter("not fits").drop("fits")
    if not rest.isEmpty():
        groups = groups.unionByName(large_groups(rest, leaves, pivot_links))
    homes = reps.select("id", "class", "doc").join(groups, "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    least = homes.groupBy("component").agg(F.min("doc").alias("component_id"))
    found = written(homes.join(least, "component").select("class", "component_id"), "op8-found")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return rows.select("id", "n_shingles", "class").join(found, "class", "left").select(
        "id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-equal documents over all documents, by shingles of two words."""
    documents = table(spark, sf_dir, "documents")
    return near_components(documents, "doc_id", "text").withColumnRenamed("id", "doc_id")
