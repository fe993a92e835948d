"""Operator 2, near duplicates of embeddings: sorted projection passes.

Vectors are scaled to length 1 in double precision; equal ones are one class from then
on. In each pass a vector gets a key of concatenated random hashes: a hash rotates it
at random and names the axis, and its direction, it then lies nearest to. Classes are
ordered by key, lexicographically, over range partitions, and each is compared with a
bounded window of those behind it. The last rows of a partition and the first of the
next are compared as well, so a pass has no seams. Verified pairs of all passes are
united into components; a partition hands on one link a vector at most.

Windows bound who is compared in a pass, so what they leave out is made up for by exact
comparisons, and no link is missed at any table size:

- Between components, classes are written once, ordered by the nearest of a few pivots,
  and each file is held against every other by blocks, which is read only if the least and
  greatest angles of both files to the pivots leave room for a link. A row is left out of a block
  only if the angle inequality rules out that it links there: its angle to a pivot is
  beyond those of the block's rows by more than the threshold's angle. Rounded products
  only choose the pairs that are then computed in double precision, and nothing is
  emitted but links that unite components. This work grows with the square of the
  classes where pivots do not tell them apart, as with evenly spread vectors.
- Within a component all pairs are compared in blocks of vectors, which counts the
  links. That work grows with the square of a component, as its links do, and is spread
  over block pairs; nothing is emitted but a count for each vector and block.

One function decides whether a pair within rounding of the threshold links, in passes,
between components and in counts alike; so a vector has no link if and only if it is alone.

Defined results: a vector that is null, empty, zero, or holds null or non-finite
components links with nothing; vectors of different lengths do not link; a row without
``vec_id`` takes part, and its component is null if no other row has an id; repeated
rows are vectors of their own that link; an empty table gives no rows; other columns,
the label too, are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm.common import open_store, parts_for, table
from martflow.llm.components import components
from martflow.plans.staging import stage

THRESHOLD = 0.9
PASSES = 12
HASHES = 5
WINDOW = 32
SEED = 20
_PART_ROWS = 20_000
_BLOCK = 1024
_PIVOTS = 64
_FILE_ROWS = 8192
_SETTLED = 65536


def unit_vectors(column) -> list[bytes | None]:
    """Bytes of each vector of an Arrow list array, scaled to length 1; None if it links not."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = column.cast(pa.large_list(pa.float64()))
    values = column.flatten()
    numbers = values.fill_null(float("nan")).to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    found = []
    for size, end in zip(sizes.tolist(), ends.tolist(), strict=True):
        own = numbers[end - size : end]
        most = np.abs(own).max() if size else 0.0
        if not np.isfinite(own).all() or not most:
            found.append(None)
            continue
        own = own / most  # no overflow in the squares
        found.append((own / np.sqrt(np.dot(own, own))).astype("<f8").tobytes())
    return found


def _scaled(batches):
    import pyarrow as pa
    import xxhash

    for batch in batches:
        units = unit_vectors(batch.column("embedding"))
        keys = [None if u is None else xxhash.xxh3_128_digest(u) for u in units]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(units, pa.binary())],
            names=["vec_id", "key", "unit"],
        )


def rotations(size: int, passes: int, hashes: int, seed: int = SEED) -> np.ndarray:
    """Random matrices (passes, hashes, size, size) for vectors of one length."""
    draw = np.random.default_rng([seed, size])
    return draw.standard_normal((passes, hashes, size, size))


def hash_keys(vectors: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """One hash of each vector: the nearest axis after turning, 2 * axis + direction."""
    turned = vectors @ turns.T
    axis = np.abs(turned).argmax(axis=1)
    side = turned[np.arange(len(vectors)), axis] > 0
    return 2 * axis + side


def _keyed(passes: int, hashes: int, seed: int):
    """For ``mapInArrow``: a row (id, unit, place) for each vector and pass."""
    known: dict[int, np.ndarray] = {}

    def key(batches):
        import pyarrow as pa

        for batch in batches:
            units = batch.column("unit").to_pylist()
            lengths = np.array([len(u) for u in units])
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                vectors = np.frombuffer(b"".join(units[i] for i in at), "<f8")
                vectors = vectors.reshape(len(at), -1)
                if length not in known:
                    known[length] = rotations(vectors.shape[1], passes, hashes, seed)
                own = batch.take(pa.array(at))
                for number in range(passes):
                    digits = [hash_keys(vectors, t) for t in known[length][number]]
                    place = np.stack(
                        [np.full(len(at), number), np.full(len(at), length // 8), *digits], 1
                    )
                    place = place.astype(">u4").tobytes()
                    width = 4 * (hashes + 2)
                    places = [place[k : k + width] for k in range(0, len(place), width)]
                    yield pa.RecordBatch.from_arrays(
                        [own.column("id"), own.column("unit"), pa.array(places, pa.binary())],
                        names=["id", "unit", "place"],
                    )

    return key


def local_roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least reachable number of each of 0 to ``count`` over the links (a, b)."""
    root = np.arange(count)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        root = root[root[root]]
        if (root == before).all():
            break
    return root


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with that of ``b``: what alone decides near the threshold.

    It is the same for a pair in either order, whatever rows stand beside it.
    """
    return np.ascontiguousarray(a * b).sum(axis=1)


def settled(products: np.ndarray, a, b, threshold: float) -> np.ndarray:
    """Whether pairs link, by products of rows of ``a`` and ``b`` (alike or crosswise).

    Products decide where rounding cannot matter, ``cosines`` where it can. So each step
    of the operator, whichever way it multiplies, takes the same pairs for links.
    """
    near = products >= threshold
    unsure = np.nonzero(np.abs(products - threshold) <= 1e-12 + 1e-15 * a.shape[1])
    for k in range(0, len(unsure[0]), _SETTLED):
        at = tuple(u[k : k + _SETTLED] for u in unsure)
        near[at] = cosines(a[at[0]], b[at[-1]]) >= threshold
    return near


def window_links(vectors, groups, window: int, threshold: float):
    """Positions (i, j) of near vectors at most ``window`` apart, in one group."""
    one, two = [], []
    for step in range(1, min(window, len(vectors) - 1) + 1):
        a, b = vectors[:-step], vectors[step:]
        near = settled(np.einsum("ij,ij->i", a, b), a, b, threshold)
        near &= groups[:-step] == groups[step:]
        at = np.flatnonzero(near)
        one.append(at)
        two.append(at + step)
    none = np.empty(0, np.int64)
    return np.concatenate([none, *one]), np.concatenate([none, *two])


def _stars(ids, units, places, window, threshold):
    """Links (id, least id of its local component) among rows in their order."""
    groups = np.array([p[:8] for p in places], "S8") if len(places) else np.empty(0, "S8")
    lengths = np.array([len(u) for u in units])
    stars = []
    for length in np.unique(lengths):  # vectors of one length stand together in a pass
        at = np.flatnonzero(lengths == length)
        vectors = np.frombuffer(b"".join(units[i] for i in at), "<f8").reshape(len(at), -1)
        one, two = window_links(vectors, groups[at], window, threshold)
        root = local_roots(len(at), one, two)
        linked = np.flatnonzero(root != np.arange(len(at)))
        stars += zip(ids[at[linked]].tolist(), ids[at[root[linked]]].tolist(), strict=True)
    return list(dict.fromkeys(stars))


_PASSED = "a long, b long, seam int, side int, nr int, id long, unit binary, place binary"


def _passed(window: int, threshold: float):
    """For ``mapInArrow``: links of a sorted partition, and the rows at its seams."""

    def compare(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        ids = rows["id"].to_numpy()
        units, places = rows["unit"].to_pylist(), rows["place"].to_pylist()
        stars = _stars(ids, units, places, window, threshold)
        count, out = len(ids), []
        out += [(a, b, None, None, None, None, None, None) for a, b in stars]
        for i in range(min(window, count)):
            out.append((None, None, part, 1, i, int(ids[i]), units[i], places[i]))
        for i in range(max(0, count - window), count):
            out.append((None, None, part + 1, 0, i, int(ids[i]), units[i], places[i]))
        yield pa.RecordBatch.from_pylist(
            [dict(zip(names, r, strict=True)) for r in out], schema=schema
        )

    names = [c.split()[0] for c in _PASSED.split(", ")]
    import pyarrow as pa

    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _PASSED.split(", ")])
    return compare


def _seamed(window: int, threshold: float):
    """For ``applyInPandas``: links over the seam of two partitions."""

    def compare(frame):
        import pandas as pd

        frame = frame.sort_values(["side", "nr"])
        stars = _stars(
            frame.id.to_numpy(), frame.unit.tolist(), frame.place.tolist(), window, threshold
        )
        return pd.DataFrame(stars, columns=["a", "b"]).astype("int64")

    return compare


def _counted(threshold: float):
    """For ``applyInPandas``: links of the vectors of two blocks of a component."""

    def count(key, frame):
        import pandas as pd

        _, low, high = key
        found = []
        for _, own in frame.groupby(["component", frame.unit.str.len()], sort=False):
            one, two = own[own.block == low], own[own.block == high]
            a, b = (
                np.frombuffer(b"".join(x.unit), "<f8").reshape(len(x), -1) for x in (one, two)
            )
            if not len(a) or not len(b):
                continue
            near = settled(a @ b.T, a, b, threshold)
            if low == high:
                np.fill_diagonal(near, False)
            found.append((one.id.to_numpy(), near @ two.copies.to_numpy()))
            if low != high:
                found.append((two.id.to_numpy(), one.copies.to_numpy() @ near))
        ids = np.concatenate([np.empty(0, np.int64), *[i for i, _ in found]])
        links = np.concatenate([np.empty(0, np.int64), *[n for _, n in found]])
        return pd.DataFrame({"id": ids.astype(np.int64), "links": links.astype(np.int64)})

    return count


def pass_links(
    classes: DataFrame,
    passes: int = PASSES,
    hashes: int = HASHES,
    window: int = WINDOW,
    threshold: float = THRESHOLD,
    seed: int = SEED,
) -> DataFrame:
    """Links (a, b) the passes over (id, unit) find, enough to connect what they found."""
    parts = parts_for(classes.count() * passes, _PART_ROWS)
    keyed = classes.select("id", "unit").mapInArrow(
        _keyed(passes, hashes, seed), "id long, unit binary, place binary"
    )
    ordered = keyed.repartitionByRange(parts, "place", "id").sortWithinPartitions("place", "id")
    found = stage(ordered.mapInArrow(_passed(window, threshold), _PASSED), "vector-passes")
    seams = found.filter("id is not null").groupBy("seam")
    seams = seams.applyInPandas(_seamed(window, threshold), "a long, b long")
    return found.filter("a is not null").select("a", "b").union(seams)


def _angles(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ pivots.T, -1, 1))


def _pivoted(pivots: dict[int, np.ndarray]):
    """For ``mapInArrow``: put the bytes of a vector and its nearest pivot behind a row."""

    def nearest(batches):
        import pyarrow as pa

        for batch in batches:
            units = batch.column("unit").to_pylist()
            lengths = np.array([len(u) for u in units], np.int64)
            place = np.zeros(len(units), np.int32)
            for length in np.unique(lengths):
                if length in pivots:
                    at = np.flatnonzero(lengths == length)
                    vectors = np.frombuffer(b"".join(units[i] for i in at), "<f8")
                    products = vectors.reshape(len(at), -1) @ pivots[length].T
                    place[at] = products.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lengths.astype(np.int32)), pa.array(place)],
                names=[*batch.schema.names, "size", "pivot"],
            )

    return nearest


def across_links(a, b, held_a, held_b, pivots, threshold: float) -> list[tuple[int, int]]:
    """Links between components that rows of ``a`` have with rows of ``b``.

    They are (component, least component it reaches over the links of both blocks).
    """
    if pivots is not None:
        limit = np.arccos(threshold) + 1e-6
        one, two = _angles(a, pivots), _angles(b, pivots)
        some = ((one >= two.min(axis=0) - limit) & (one <= two.max(axis=0) + limit)).all(axis=1)
        a, held_a, one = a[some], held_a[some], one[some]
        if not len(a):
            return []
        some = ((two >= one.min(axis=0) - limit) & (two <= one.max(axis=0) + limit)).all(axis=1)
        b, held_b = b[some], held_b[some]
    if not len(a) or not len(b):
        return []
    known, codes = np.unique(np.concatenate([held_a, held_b]), return_inverse=True)
    code_a, code_b = codes[: len(a)], codes[len(a) :]
    root = np.arange(len(known))
    least = np.float32(threshold - 2e-7 * (a.shape[1] + 2))  # beyond what rounding takes
    a4, b4 = a.astype(np.float32), b.astype(np.float32)
    lows, highs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for at in range(0, len(a), 512):
        near = a4[at : at + 512] @ b4.T >= least
        if not near.any():
            continue
        near &= root[code_a[at : at + 512], None] != root[code_b][None, :]
        i, j = np.nonzero(near)
        for k in range(0, len(i), 65536):
            x, y = i[k : k + 65536] + at, j[k : k + 65536]
            true = cosines(a[x], b[y]) >= threshold
            pairs = np.unique(np.stack([code_a[x[true]], code_b[y[true]]], 1), axis=0)
            lows.append(pairs[:, 0])
            highs.append(pairs[:, 1])
        low, high = np.concatenate(lows), np.concatenate(highs)
        root = local_roots(len(known), low, high)
        moved = np.flatnonzero(root != np.arange(len(known)))  # links as good as those so far
        lows, highs = [moved], [root[moved]]
    moved = np.flatnonzero(root != np.arange(len(known)))
    return list(zip(known[moved].tolist(), known[root[moved]].tolist(), strict=True))


def angle_bounds(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The least and the greatest angle of the rows to each pivot."""
    angles = _angles(vectors, pivots)
    return np.stack([angles.min(axis=0), angles.max(axis=0)])


def may_link(one: np.ndarray, two: np.ndarray, threshold: float) -> bool:
    """Whether the angle inequality leaves room for a link of rows within these bounds."""
    limit = np.arccos(threshold) + 1e-6
    return bool(((one[0] <= two[1] + limit) & (two[0] <= one[1] + limit)).all())


def _file_blocks(file: str):
    """(length, vectors, components) of a file of vectors, by blocks."""
    import pyarrow.parquet as pq

    store, path = open_store(file)
    with store.open_input_file(path) as source:
        rows = pq.read_table(source, columns=["component", "size", "unit"])
    sizes = rows["size"].to_numpy()
    held, units = rows["component"].to_numpy(), rows["unit"].to_pylist()
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        vectors = np.frombuffer(b"".join(units[i] for i in at), "<f8").reshape(len(at), -1)
        for k in range(0, len(at), _FILE_ROWS):
            yield int(size), vectors[k : k + _FILE_ROWS], held[at[k : k + _FILE_ROWS]]


def _bounded(files: list[str], pivots: dict[int, np.ndarray]):
    """For ``mapInArrow`` over numbers of files: the angle bounds of each length in a file.

    Vectors of a length without pivots have no bounds.
    """

    def bound(batches):
        import pyarrow as pa

        for batch in batches:
            for number in batch.column("id").to_pylist():
                found: dict[int, np.ndarray | None] = {}
                for size, vectors, _ in _file_blocks(files[number]):
                    if size not in pivots:
                        found[size] = None
                        continue
                    own = angle_bounds(vectors, pivots[size])
                    if size in found:
                        known = found[size]
                        own = np.stack([np.minimum(known[0], own[0]), np.maximum(known[1], own[1])])
                    found[size] = own
                packed = [None if x is None else x.tobytes() for x in found.values()]
                columns = [
                    pa.array([number] * len(found), pa.int64()),
                    pa.array(list(found), pa.int32()),
                    pa.array(packed, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "size", "bounds"])

    return bound


def _crossed(files: list[str], bounds: list[str], pivots: dict[int, np.ndarray], threshold: float):
    """For ``mapInArrow`` over numbers of files: links of a file with itself and half the rest.

    The halves go round, so each two files meet in one task, and tasks are alike. A file is
    read only if its bounds leave room for a link.
    """

    def known_bounds():
        import pyarrow.parquet as pq

        found: dict[int, dict[int, np.ndarray | None]] = {}
        for file in bounds:
            store, path = open_store(file)
            with store.open_input_file(path) as source:
                rows = pq.read_table(source, columns=["id", "size", "bounds"]).to_pylist()
            for row in rows:
                packed = row["bounds"]
                own = None if packed is None else np.frombuffer(packed, "<f8").reshape(2, -1)
                found.setdefault(row["id"], {})[row["size"]] = own
        return found

    def compare(batches):
        import pyarrow as pa

        known = known_bounds()

        def meet(own: int, other: int) -> bool:
            one, two = known.get(own, {}), known.get(other, {})
            return any(
                one[size] is None or may_link(one[size], two[size], threshold)
                for size in one.keys() & two.keys()
            )

        for batch in batches:
            for own in batch.column("id").to_pylist():
                mine = list(_file_blocks(files[own]))
                for step in range(len(files) // 2 + 1):
                    if 2 * step == len(files) and 2 * own >= len(files):
                        continue  # the opposite file's task has this pair
                    other = (own + step) % len(files)
                    if not meet(own, other):
                        continue
                    found = []
                    for size, b, held_b in _file_blocks(files[other]):
                        for length, a, held_a in mine:
                            if length == size:
                                near = pivots.get(size)
                                found += across_links(a, b, held_a, held_b, near, threshold)
                    a, b = zip(*dict.fromkeys(found), strict=True) if found else ((), ())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
                    )

    return compare


def between(classes: DataFrame, label: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links (a, b) between components, all that the components of ``label`` leave out."""
    spark = classes.sparkSession
    drawn = classes.orderBy(F.xxhash64("id"), "id").limit(_PIVOTS).select("unit").collect()
    pivots: dict[int, list] = {}
    for (unit,) in drawn:
        pivots.setdefault(len(unit), []).append(np.frombuffer(bytes(unit), "<f8"))
    pivots = {length: np.stack(own) for length, own in pivots.items()}
    label = label.select(F.col("node").alias("id"), "component")
    held = classes.select("id", "unit").join(label, "id", "left")
    held = held.select("id", F.coalesce("component", "id").alias("component"), "unit")
    held = held.mapInArrow(
        _pivoted(pivots), "id long, component long, unit binary, size int, pivot int"
    )
    order = ["size", "pivot", "id"]
    parts = parts_for(classes.count(), _FILE_ROWS)
    held = stage(held.repartitionByRange(parts, *order).sortWithinPartitions(*order), "vector-files")
    files = sorted(held.inputFiles())
    numbers = spark.range(0, len(files), 1, max(1, len(files)))
    # A row of a kilobyte for each file: all of them are read by each task, of few files.
    bounds = numbers.mapInArrow(_bounded(files, pivots), "id long, size int, bounds binary")
    bounds = stage(bounds.repartition(parts_for(len(files), _PART_ROWS)), "vector-bounds")
    crossed = numbers.mapInArrow(
        _crossed(files, sorted(bounds.inputFiles()), pivots, threshold), "a long, b long"
    )
    return stage(crossed, "vector-between")


def merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) after ``links`` between components of ``label``."""
    moved = stage(components(links), "vector-moved")
    roots = moved.select("node", F.col("node").alias("component"))  # those without a link too
    moved = moved.select(F.col("node").alias("old"), F.col("component").alias("new"))
    found = label.union(roots).distinct().join(moved, F.col("component") == F.col("old"), "left")
    return found.select("node", F.coalesce("new", "component").alias("component"))


def link_counts(classes: DataFrame, label: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(id, links) within the components of ``label``; classes have id, unit, copies."""
    label = label.select(F.col("node").alias("id"), "component")
    sizes = label.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    members = label.join(sizes, "component").join(classes.select("id", "unit", "copies"), "id")
    members = stage(members, "vector-members")
    # Small components share a task; a large one is a task for each pair of its blocks.
    shared = parts_for(members.count(), 2 * _BLOCK)
    blocks = F.ceil(F.col("size") / _BLOCK).cast("int")
    members = members.withColumn("blocks", blocks)
    members = members.withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    alone = F.col("blocks") > 1
    task = F.when(alone, F.col("component")).otherwise(
        -1 - F.pmod(F.xxhash64("component"), F.lit(shared))
    )
    dealt = members.select(
        task.alias("task"), F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"), "block", "component", "id", "unit", "copies",
    )
    found = dealt.groupBy("task", "low", "high").applyInPandas(
        _counted(threshold), "id long, links long"
    )
    return found.groupBy("id").agg(F.sum("links").alias("links"))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, **passes) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row (``vec_id``, ``embedding``)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = stage(
        rows.mapInArrow(_scaled, "vec_id long, key binary, unit binary"), "vector-units"
    )
    valid = rows.filter("key is not null")
    classes = valid.groupBy("key").agg(
        F.first("unit").alias("unit"),
        F.count(F.lit(1)).alias("copies"),
        F.min("vec_id").alias("least"),
    )
    classes = stage(classes.withColumn("id", F.monotonically_increasing_id()), "vector-classes")
    links = pass_links(classes, threshold=threshold, **passes)
    label = stage(components(links), "vector-labels")
    missed = between(classes, label, threshold)
    if not missed.isEmpty():
        label = stage(merged(label, missed), "vector-labels")
    counts = link_counts(classes, label, threshold)

    label = label.select(F.col("node").alias("id"), "component")
    placed = classes.drop("unit").join(label, "id", "left").join(counts, "id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "id"))
    placed = stage(placed, "vector-placed")
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    placed = placed.join(least, "component").select(
        "key",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "component_id",
    )
    same = F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    linked = valid.select("vec_id", "key").join(placed, "key")
    linked = linked.select("vec_id", "n_links", "component_id", same)
    alone = rows.filter("key is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"),
    )
    return linked.union(alone)


def op2_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
