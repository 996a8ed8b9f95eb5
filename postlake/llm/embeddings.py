"""Near-duplicate vectors by a pigeonhole join on blocks of rotated coordinates."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import components, forest, whole_groups
from postlake.session import staged

THRESHOLD = 0.98
BLOCKS = 8
# Coordinates of a block that are cut into cells, and a cell's side in radiuses.
GRID, SIDE = 4, 4.0
# Rows of one side that are compared at once.
TILE = 2048


def _rotation(dim: int) -> np.ndarray:
    """A fixed random rotation, so that no block of coordinates is favoured."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _blocks(dim: int) -> list[np.ndarray]:
    return np.array_split(np.arange(dim), min(BLOCKS, dim))


def _budgets(dim: int, threshold: float) -> list[float]:
    """A block's share of the squared distance, in proportion to its coordinates. If every block were over, so would be
    the whole; the tiny surplus covers rounding."""
    whole = max(0.0, 2 - 2 * threshold)
    return [whole * len(block) / dim * (1 + 1e-9) + 1e-12 for block in _blocks(dim)]


def _rotated(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and their rotated coordinates, summed in a fixed order so that equal vectors agree everywhere."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    square = np.zeros(len(scaled))
    for k in range(scaled.shape[1]):
        square += scaled[:, k] ** 2
    unit = scaled / np.sqrt(square)[:, None]
    turned, rotation = np.zeros_like(unit), _rotation(unit.shape[1])
    for k in range(unit.shape[1]):
        turned += unit[:, k, None] * rotation[k]
    return unit, turned


def _file(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """A row per vector, block and cell that the vector's ball of the block's radius reaches; ``home`` marks its own cell."""
    for batch in batches:
        vectors = batch["embedding"].to_pylist()
        dims = np.array([len(v) for v in vectors])
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            _, turned = _rotated(np.array([vectors[k] for k in at], np.float64))
            for number, (block, budget) in enumerate(zip(_blocks(dim), _budgets(dim, threshold))):
                part = turned[:, block]
                grid = part[:, :GRID]
                radius = np.sqrt(budget) * (1 + 1e-6)
                side = max(SIDE * radius, 1 / 16000)
                low, high, own = (np.floor(x / side).astype(np.int64) for x in (grid - radius, grid + radius, grid))
                for ends in itertools.product((0, 1), repeat=grid.shape[1]):
                    ends = np.array(ends)
                    # The upper end counts only where it is another cell.
                    new = ((low != high) | (ends == 0)).all(axis=1)
                    cell = np.where(ends == 0, low, high)[new]
                    if not len(cell):
                        continue
                    key = np.zeros(len(cell), np.int64)
                    for k in range(cell.shape[1]):
                        key = key * 65536 + (cell[:, k] + 32768) if k < 3 else key * 32768 + (cell[:, k] + 16384)
                    chosen = at[new]
                    columns = {
                        "label": batch["label"].take(pa.array(chosen)), "dim": pa.array(np.full(len(cell), dim, np.int32)), "block": pa.array(np.full(len(cell), number, np.int32)),
                        "cell": pa.array(key), "rep": batch["rep"].take(pa.array(chosen)), "home": pa.array((cell == own[new]).all(axis=1)),
                        "part": pa.array([row.tobytes() for row in part[new].astype("<f4")], pa.binary()),
                    }
                    yield pa.RecordBatch.from_pydict(columns)


def _near(batches: Iterator[pa.RecordBatch], group: list[str], threshold: float) -> Iterator[pa.RecordBatch]:
    """Members of a tile pair that are within the block's budget of another one."""
    for table, cuts in whole_groups(batches, group):
        dims, blocks, mine, rep = (table[c].to_numpy(zero_copy_only=False) for c in ("dim", "block", "as_home", "rep"))
        parts, near = table["part"].to_pylist(), np.zeros(table.num_rows, bool)
        for low, high in zip(cuts[:-1], cuts[1:]):
            home, other = low + np.flatnonzero(mine[low:high]), low + np.flatnonzero(~mine[low:high])
            if not len(home) or not len(other):
                continue
            a, b = (np.frombuffer(b"".join([parts[k] for k in at]), "<f4").reshape(len(at), -1).astype(np.float64) for at in (home, other))
            budget = _budgets(int(dims[low]), threshold)[int(blocks[low])] + 1e-5  # coordinates are single precision here
            for step in range(0, len(home), 256):
                square = np.zeros((len(a[step : step + 256]), len(b)))
                for k in range(a.shape[1]):
                    square += (a[step : step + 256, k, None] - b[None, :, k]) ** 2
                hit = (square <= budget) & (rep[home[step : step + 256], None] != rep[None, other])
                near[home[step : step + 256]] |= hit.any(axis=1)
                near[other] |= hit.any(axis=0)
        kept = table.select([*group, "rep", "as_home"]).filter(pa.array(near))
        yield from kept.combine_chunks().to_batches()


def _verify(batches: Iterator[pa.RecordBatch], group: list[str], threshold: float) -> Iterator[pa.RecordBatch]:
    """Exact links of the home side of a tile pair, and the fewest links that connect what was found.

    A pair may meet in several blocks; it counts in the first block whose budget it keeps.
    """
    for table, cuts in whole_groups(batches, group):
        dims, blocks, mine, rep, copies = (table[c].to_numpy(zero_copy_only=False) for c in ("dim", "block", "as_home", "rep", "copies"))
        vectors, found = table["embedding"].to_pylist(), []
        for low, high in zip(cuts[:-1], cuts[1:]):
            unit, turned = _rotated(np.array(vectors[low:high], np.float64))
            one = mine[low:high]
            links, p, q = _links(unit, turned, np.flatnonzero(one), np.flatnonzero(~one), rep[low:high], copies[low:high], int(blocks[low]), int(dims[low]), threshold)
            names, codes = np.unique(rep[low:high], return_inverse=True)
            root = names[forest(codes[p], codes[q], len(names))][codes]
            keep = (links > 0) | (root != rep[low:high])
            found.append((rep[low:high][keep], root[keep], links[keep]))
        if found:
            columns = [pa.array(np.concatenate(c)) for c in zip(*found)]
            columns = [columns[0].cast(table.schema.field("rep").type), columns[1].cast(table.schema.field("rep").type), columns[2]]
            yield pa.RecordBatch.from_arrays(columns, names=["src", "dst", "links"])


def _links(unit, turned, home, other, rep, copies, block: int, dim: int, threshold: float):
    """Links per row that this block counts, and the pairs themselves."""
    budgets, columns = _budgets(dim, threshold)[: block + 1], _blocks(dim)[: block + 1]
    links, left, right = np.zeros(len(rep), np.int64), [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for low in range(0, len(home), 256):
        some = home[low : low + 256]
        p, q = np.nonzero(unit[some] @ unit[other].T >= threshold - 1e-9)
        p, q = some[p], other[q]
        for step in range(0, len(p), 1 << 16):
            i, j = p[step : step + (1 << 16)], q[step : step + (1 << 16)]
            keep = (rep[i] != rep[j]) & (np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold)
            for number, budget in enumerate(budgets):
                square = np.zeros(len(i))
                for k in columns[number]:
                    square += (turned[i, k] - turned[j, k]) ** 2
                keep &= square <= budget if number == block else square > budget
            np.add.at(links, i[keep], copies[j[keep]])
            left.append(i[keep])
            right.append(j[keep])
    return links, np.concatenate(left), np.concatenate(right)


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """Link vectors of equal label whose cosine is at least ``threshold``.

    The project has no vectors, so this is kept general: ``vectors`` has ``vec_id``, ``embedding`` (array of float or double) and
    ``label``. Vectors with a null id or label, null, zero, or with null or non-finite components, link with nothing; vectors of
    different lengths never link.

    Equal vectors of a label are one class, so copies never meet in pairs. Unit vectors are rotated and their coordinates
    split into BLOCKS low-dimensional blocks. A cosine of ``threshold`` is a squared distance of 2 - 2 x threshold; if two
    vectors keep it, some block keeps its proportional share. Each block is range-joined on a grid over its first GRID
    coordinates, with cells of SIDE radiuses: a class goes to every cell its ball reaches, carrying only the block's coordinates.
    What comes within a block's budget of another is joined with its full vector and checked exactly, in double precision;
    a pair counts in the first block whose budget it keeps, so nothing is counted twice and no pairs are shuffled. Cells
    are cut into tiles of about ``tile`` classes, every pair of tiles is a task of its own.

    Returns one row per row of ``vectors``: ``vec_id``, ``n_links`` (other vectors linked directly, copies included),
    ``component_id`` (smallest id reachable, its own included; null for a null id) and ``kept`` (``vec_id`` = ``component_id``).
    Repeated rows count as separate vectors. An empty table gives an empty result.
    """
    value = F.col("embedding")
    sound = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(value, lambda x: x != 0)
    valid = vectors.select("vec_id", "embedding", "label").filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull()).filter(sound)
    classes = valid.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = staged(classes, "vector-classes")
    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    filed = classes.select("label", "embedding", "rep").mapInArrow(
        lambda b: _file(b, threshold),
        f"label {kinds['label']}, dim int, block int, cell long, rep {kinds['rep']}, home boolean, part binary",
    )
    place = ["label", "dim", "block", "cell"]
    filed = staged(filed, "vector-cells")
    sizes = filed.groupBy(*place).agg(F.count("*").alias("n")).filter("n > 1")
    sizes = staged(sizes.select(*[F.col(c).alias(f"p_{c}") for c in place], F.ceil(F.col("n") / tile).cast("int").alias("tiles")), "cell-sizes")
    filed = filed.join(sizes, [F.col(c) == F.col(f"p_{c}") for c in place]).drop(*[f"p_{c}" for c in place])
    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    own = F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int")
    homes = filed.filter("home").withColumn("as_home", F.lit(True)).withColumn("t_home", own).withColumn("t_other", F.explode(every))
    others = filed.withColumn("as_home", F.lit(False)).withColumn("t_home", F.explode(every)).withColumn("t_other", own)
    keys = [*place, "t_home", "t_other", "rep", "as_home"]
    met = homes.select(*keys, "part").union(others.select(*keys, "part"))
    group = [*place, "t_home", "t_other"]
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = f"label {kinds['label']}, dim int, block int, cell long, t_home int, t_other int, rep {kinds['rep']}, as_home boolean"
    met = met.repartition(tasks, *group).sortWithinPartitions(*group)
    near = staged(met.mapInArrow(lambda b: _near(b, group, threshold), schema), "vector-candidates")
    full = near.join(classes.select(F.col("rep").alias("r"), "embedding", "copies"), F.col("rep") == F.col("r")).drop("r")
    full = full.repartition(tasks, *group).sortWithinPartitions(*group)
    links = full.mapInArrow(lambda b: _verify(b, group, threshold), f"src {kinds['rep']}, dst {kinds['rep']}, links long")
    links = staged(links, "vector-links")
    counts = links.groupBy(F.col("src").alias("c_rep")).agg(F.sum("links").alias("links"))
    groups = components(links.select("src", "dst"), "vector-components")
    result = classes.join(counts, F.col("rep") == F.col("c_rep"), "left").join(groups, F.col("rep") == F.col("node"), "left")
    result = result.select(
        F.col("label").alias("g_label"), F.col("embedding").alias("g_embedding"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"),
        F.coalesce("component", "rep").alias("g_component"),
    )
    result = staged(result, "vector-groups")
    rows = vectors.select("vec_id", "embedding", "label")
    joined = rows.join(
        result, (F.col("label") == F.col("g_label")) & (F.col("embedding") == F.col("g_embedding")) & F.col("vec_id").isNotNull(), "left"
    )
    component = F.coalesce("g_component", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
