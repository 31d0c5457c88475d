"""Hard negatives by windows of scores, over blocks of rows in Hilbert order with per-dimension bounds.

Rows are ordered by label and by their place on a Hilbert curve, and cut into blocks of one label. A block is one row of
a Parquet table: ids, the vectors as one matrix, and the least and greatest number of each dimension (its zone). From a
zone and an anchor, interval arithmetic gives the least and the greatest score the block can hold. The anchors' windows
choose the blocks to read by these: for positives, blocks that may hold a score among the first; for negatives, blocks
that may hold a score inside a window. Chosen blocks are scored exactly, as integers, block by anchor group.

Vectors are integers, floor(scale * x). A number so large that a score could leave 63 bits counts as the largest that
cannot (2**28 - 1 for 64 dimensions). Vectors of another length than most take no part (of two equally common
lengths, the shorter counts), nor do rows without an id. Equal ids are ordered by where their rows are stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfseek.functions.vectors import dense_rows
from shelfseek.scratch import stored

#: Rows of a block, blocks that are weighed and scored together (two to this power), anchors of a group, groups that meet
#: all blocks in one place.
BLOCK_ROWS = 256
SLAB_BITS = 6
GROUP_ANCHORS = 256
MEETING_GROUPS = 8
#: Bits of a coordinate on the Hilbert curve; coordinates span two standard deviations of an even unit vector.
CURVE_BITS = 3

BLOCKS = "block bigint, label int, ids array<bigint>, vectors binary, low binary, high binary"
GROUPS = "group bigint, label int, anchors array<bigint>, ids array<bigint>, vectors binary, floors array<bigint>"
#: Below every score.
NOTHING = -(1 << 62)


def hilbert_order(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of ``points`` (numbers below 2**bits) on the Hilbert curve, as bytes that sort like it.

    Skilling's transform ("Programming the Hilbert curve", 2004), for all rows at once: axes are turned from the
    coarsest bit down, then Gray-decoded, and the bits of all axes interleaved.
    """
    x = points.T.astype(np.int64).copy()
    bit = 1 << (bits - 1)
    while bit > 1:
        below = bit - 1
        for axis in x:
            set_ = (axis & bit) != 0
            swapped = np.where(set_, 0, (x[0] ^ axis) & below)
            x[0] ^= np.where(set_, below, swapped)
            axis ^= swapped
        bit >>= 1
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    turn = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where((x[-1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= turn
    planes = [(axis >> b) & 1 for b in range(bits - 1, -1, -1) for axis in x]
    packed = np.packbits(np.array(planes, np.uint8), axis=0)
    return np.ascontiguousarray(packed.T)


def curve_places(vectors: np.ndarray) -> np.ndarray:
    """Hilbert places of vectors by their direction."""
    norms = np.sqrt((vectors.astype(float) ** 2).sum(axis=1, keepdims=True))
    even = vectors / np.where(norms > 0, norms, 1) * np.sqrt(vectors.shape[1])
    cells = np.clip((even / 4 + 0.5) * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1)
    return hilbert_order(cells.astype(np.int64), CURVE_BITS)


def largest_number(dims: int) -> int:
    """Numbers up to this give inner products below 2**62."""
    return (1 << ((62 - max(dims - 1, 1).bit_length()) // 2)) - 1


def matrix(blob: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(blob, np.int32).reshape(-1, dims)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices: in doubles where those hold them, else in integers."""
    most = left.shape[1] * int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0))
    if most < 1 << 53:
        return (left.astype(float) @ right.T.astype(float)).astype(np.int64)
    return left.astype(np.int64) @ right.T.astype(np.int64)


def bounds(vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each vector with anything between ``low`` and ``high`` of each zone."""
    up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


def usable(rows: DataFrame, dims: int | None = None) -> tuple[DataFrame, int]:
    """(vec_id, label, embedding) of rows that take part, and their number of dimensions."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    typed = rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("int").alias("label"), vector.alias("embedding")
    )
    whole = typed.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & (F.size("embedding") > 0))
    if dims is None:
        lengths = whole.groupBy(F.size("embedding").alias("dims")).count()
        found = lengths.orderBy(F.desc("count"), "dims").limit(1).first()
        dims = found["dims"] if found else 1
    return whole.filter(F.size("embedding") == dims), dims


def blocks_of(rows: DataFrame, dims: int, scale: int) -> DataFrame:
    """``BLOCKS``: usable rows as integers, in Hilbert order within their label, cut into blocks, stored."""
    most = largest_number(dims)

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, values = dense_rows(batch["embedding"], dims)
            whole = np.clip(np.floor(values * float(scale)), -most, most).astype(np.int32)
            places = curve_places(whole)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"],
                    batch["label"],
                    pa.array([x.tobytes() for x in places], pa.binary()),
                    pa.array([x.tobytes() for x in whole], pa.binary()),
                ],
                names=["vec_id", "label", "place", "vector"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, labels = batch["vec_id"].to_numpy(), batch["label"].to_numpy()
            vectors = matrix(b"".join(batch["vector"].to_pylist()), dims)
            changes = np.flatnonzero(np.diff(labels)) + 1
            edges = np.concatenate([[0], changes, [len(ids)]])
            starts = np.concatenate([np.arange(a, b, BLOCK_ROWS) for a, b in zip(edges[:-1], edges[1:], strict=True)])
            ends = np.append(starts[1:], len(ids))
            spans = list(zip(starts.tolist(), ends.tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(labels[starts], pa.int32()),
                    pa.array([ids[a:b] for a, b in spans], pa.list_(pa.int64())),
                    pa.array([vectors[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([vectors[a:b].min(axis=0).tobytes() for a, b in spans], pa.binary()),
                    pa.array([vectors[a:b].max(axis=0).tobytes() for a, b in spans], pa.binary()),
                ],
                names=["label", "ids", "vectors", "low", "high"],
            )

    whole = rows.mapInArrow(numbers, "vec_id bigint, label int, place binary, vector binary")
    order = ("label", "place", "vec_id", "vector")
    held = stored(whole, "numbers")
    # As many parts as rows fill slabs, however many partitions they came in.
    parts = max(1, -(-held.count() // (BLOCK_ROWS << SLAB_BITS)))
    ordered = held.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    blocks = ordered.mapInArrow(cut, BLOCKS.split(", ", 1)[1])
    return stored(blocks.select(F.monotonically_increasing_id().alias("block"), "*"), "blocks")


def anchor_groups(blocks: DataFrame, dims: int, every: int, positives: int) -> DataFrame:
    """``GROUPS``: the anchors (rows whose id ``every`` divides) in groups of one label, stored.

    ``anchors`` are the anchors' rows, as block and place in it; ``floors`` is the score of the last positive that the
    anchor's own block offers: no block whose scores all stay below it needs to be read.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[tuple] = []
            for block, label, ids, blob in zip(*[batch[c].to_pylist() for c in ("block", "label", "ids", "vectors")], strict=True):
                vectors, numbers = matrix(blob, dims), np.array(ids, np.int64)
                at = np.flatnonzero(numbers % every == 0)
                if not len(at):
                    continue
                scores = products(vectors[at], vectors)
                scores[np.arange(len(at)), at] = NOTHING
                floors = np.sort(scores, axis=1)[:, -positives] if scores.shape[1] > positives else np.full(len(at), NOTHING)
                for k, place in enumerate(at.tolist()):
                    made.append((block * BLOCK_ROWS + place, label, ids[place], vectors[place].tobytes(), int(floors[k])))
            columns = list(zip(*made, strict=True)) if made else [[]] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64())
            names = ["anchor", "label", "id", "vector", "floor"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    schema = "anchor bigint, label int, id bigint, vector binary, floor bigint"
    anchors = stored(blocks.select("block", "label", "ids", "vectors").mapInArrow(found, schema), "anchors")
    # Anchors are numbered in the order of their blocks, so that a group's anchors lie near each other on the curve.
    sections = max(1, anchors.count() // (16 * GROUP_ANCHORS))
    near = anchors.repartitionByRange(sections, "label", "anchor").sortWithinPartitions("label", "anchor")

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch["label"].to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(np.diff(labels)) + 1, [len(labels)]])
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                for a in range(lo, hi, GROUP_ANCHORS):
                    part = batch.slice(a, min(GROUP_ANCHORS, hi - a))
                    columns = [[part[c].to_pylist()] for c in ("anchor", "id", "floor")]
                    lists = [pa.array(c, pa.list_(pa.int64())) for c in columns]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([int(labels[a])], pa.int32()),
                            lists[0],
                            lists[1],
                            pa.array([b"".join(part["vector"].to_pylist())], pa.binary()),
                            lists[2],
                        ],
                        names=["label", "anchors", "ids", "vectors", "floors"],
                    )

    groups = near.mapInArrow(grouped, GROUPS.split(", ", 1)[1])
    return stored(groups.select(F.monotonically_increasing_id().alias("group"), "*"), "groups")


def slab() -> Column:
    """Blocks of one slab were written by one task one after another, so they lie near each other on the curve."""
    return F.shiftright("block", SLAB_BITS).alias("slab")


def chosen_blocks(blocks: DataFrame, groups: DataFrame, dims: int, same_label: bool) -> DataFrame:
    """(group, block, slab): the blocks of the groups' label, or of the others, whose zones may hold a wanted score.

    ``groups`` has, for each of its anchors, the least and the greatest wanted score in ``least`` and ``greatest``. Each
    slab's zones meet each group once: the anchors are the questions that are asked of all rows.
    """
    zones = blocks.groupBy(slab()).agg(
        F.sort_array(F.collect_list(F.struct("block", "label", "low", "high"))).alias("zones")
    )
    sections = max(1, groups.count() // MEETING_GROUPS)
    section = F.pmod(F.xxhash64("group"), F.lit(sections)).cast("int")
    everywhere = zones.withColumn("section", F.explode(F.sequence(F.lit(0), F.lit(sections - 1))))
    asked = groups.select("group", F.col("label").alias("wanted"), "vectors", "least", "greatest", section.alias("section"))
    met = everywhere.join(asked, "section").select("slab", "zones", "group", "wanted", "vectors", "least", "greatest")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int, int]] = []
            for row in batch.to_pylist():
                zones = [z for z in row["zones"] if (z["label"] == row["wanted"]) == same_label]
                if not zones:
                    continue
                low, high = (matrix(b"".join(z[side] for z in zones), dims) for side in ("low", "high"))
                bottom, top = bounds(matrix(row["vectors"], dims), low, high)
                least, greatest = (np.array(row[x], np.int64)[:, None] for x in ("least", "greatest"))
                needed = ((top >= least) & (bottom <= greatest)).any(axis=0)
                found += [(row["group"], zones[k]["block"], row["slab"]) for k in np.flatnonzero(needed).tolist()]
            columns = list(zip(*found, strict=True)) if found else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["group", "block", "slab"])

    return stored(met.mapInArrow(weigh, "group bigint, block bigint, slab bigint"), "chosen")


def scored(blocks: DataFrame, groups: DataFrame, chosen: DataFrame, kernel, schema: str) -> DataFrame:
    """``kernel(group row, ids, rows, vectors)`` for each group and the chosen blocks of each slab."""
    read = chosen.join(blocks.select("block", "ids", "vectors"), "block")
    pairs = chosen.select(F.col("group").alias("to_group"), F.col("slab").alias("to_slab")).distinct()
    asked = pairs.join(groups, F.col("to_group") == F.col("group")).drop("group")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return kernel(None, None, None, None)
        ids = left["ids"].combine_chunks()
        counts = np.diff(ids.offsets.to_numpy())
        inside = np.arange(len(ids.flatten())) - np.repeat(np.cumsum(counts) - counts, counts)
        rows = np.repeat(left["block"].to_numpy(), counts) * BLOCK_ROWS + inside
        vectors = b"".join(left["vectors"].to_pylist())
        return kernel(right.to_pylist()[0], ids.flatten().to_numpy(), rows, vectors)

    return read.groupBy("group", "slab").cogroup(asked.groupBy("to_group", "to_slab")).applyInArrow(score, schema)


POSITIVES = "anchor bigint, anchor_id bigint, positive_id bigint, positive bigint, positive_score bigint"
NEGATIVES = (
    "anchor bigint, anchor_id bigint, place int, positive_id bigint, positive_score bigint, "
    "negative_id bigint, negative bigint, negative_score bigint"
)


def table_of(schema: str, parts: list[tuple]) -> pa.Table:
    """A table of the given columns from parts that hold an array or a number for each column."""
    names = [c.split(" ")[0] for c in schema.split(", ")]
    types = [{"bigint": pa.int64(), "int": pa.int32()}[c.split(" ")[1]] for c in schema.split(", ")]
    columns = []
    for k, kind in enumerate(types):
        pieces = [np.broadcast_to(part[k], len(part[-1])) for part in parts]
        columns.append(pa.array(np.concatenate(pieces) if pieces else [], kind))
    return pa.table(columns, names=names)


def positives_of(blocks: DataFrame, groups: DataFrame, dims: int, limit: int) -> DataFrame:
    """Per anchor, its first ``limit`` other rows of the same label, with their ``place`` from 1."""
    asked = groups.withColumns(
        {"least": F.col("floors"), "greatest": F.transform("floors", lambda x: F.lit(-NOTHING).cast("bigint"))}
    )
    chosen = chosen_blocks(blocks, asked, dims, same_label=True)

    def kernel(group, ids, rows, blob) -> pa.Table:
        if group is None:
            return table_of(POSITIVES, [])
        vectors, parts = matrix(blob, dims), []
        scores = products(matrix(group["vectors"], dims), vectors)
        for k, anchor in enumerate(group["anchors"]):
            mine = scores[k]
            other = np.flatnonzero((rows != anchor) & (mine >= group["floors"][k]))
            if len(other) > limit:
                last = np.partition(mine[other], -limit)[-limit]
                other = other[mine[other] >= last]
            first = other[np.lexsort((rows[other], ids[other], -mine[other]))][:limit]
            parts.append((anchor, group["ids"][k], ids[first], rows[first], mine[first]))
        return table_of(POSITIVES, parts)

    found = scored(blocks, groups, chosen, kernel, POSITIVES)
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id", "positive")
    ranked = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= limit)
    return stored(ranked, "positives")


def with_windows(groups: DataFrame, positives: DataFrame, low: int, high: int) -> DataFrame:
    """``groups`` with each anchor's positives and, of their windows, the least and the greatest score."""
    own = positives.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives")
    )
    lists = groups.select("group", F.posexplode("anchors").alias("k", "anchor")).join(own, "anchor", "left")
    gathered = lists.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("k", "positives"))).alias("listed"))
    whole = groups.join(gathered, "group").withColumn("listed", F.col("listed.positives"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least, greatest = [], []
            for listed in batch["listed"].to_pylist():
                spans = [[window(p["positive_score"], low, high) for p in positives or []] for positives in listed]
                kept = [[s for s in some if s[0] <= s[1]] for some in spans]
                least.append([min((s[0] for s in some), default=-NOTHING) for some in kept])
                greatest.append([max((s[1] for s in some), default=NOTHING) for some in kept])
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (least, greatest)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=[*batch.schema.names, "least", "greatest"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.schema)
    return stored(whole.mapInArrow(windows, f"{schema}, least array<bigint>, greatest array<bigint>"), "windows")


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The scores n with low * score <= 100 * n <= high * score."""
    return max(-(-low * score // 100), NOTHING), min(high * score // 100, -NOTHING)


def hard_negatives(
    rows: DataFrame,
    dims: int | None = None,
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
) -> DataFrame:
    """Per anchor and positive of ``rows`` (vec_id, label, embedding), the first ``negatives`` rows of other labels whose
    score is between ``low`` and ``high`` percent of the positive's.

    Anchors are rows whose vec_id ``every`` divides; an anchor's positives are its first ``positives`` other rows of the
    same label. Higher scores come first, ties by smaller vec_id. Rows with a null id, label or vector, or a null or
    non-finite number, take no part; other columns are not read.
    """
    kept, dims = usable(rows, dims)
    blocks = blocks_of(kept, dims, scale)
    groups = anchor_groups(blocks, dims, every, positives)
    best = positives_of(blocks, groups, dims, positives)
    asked = with_windows(groups, best, low, high)
    chosen = chosen_blocks(blocks, asked, dims, same_label=False)

    def kernel(group, ids, rows, blob) -> pa.Table:
        if group is None:
            return table_of(NEGATIVES, [])
        parts = []
        scores = products(matrix(group["vectors"], dims), matrix(blob, dims))
        for k, anchor in enumerate(group["anchors"]):
            inside = np.flatnonzero((scores[k] >= group["least"][k]) & (scores[k] <= group["greatest"][k]))
            if not len(inside):
                continue
            ordered = inside[np.lexsort((rows[inside], ids[inside], -scores[k][inside]))]
            falling = -scores[k][ordered]
            for p in group["listed"][k] or []:
                least, greatest = window(p["positive_score"], low, high)
                a, b = np.searchsorted(falling, -greatest), np.searchsorted(falling, -least, side="right")
                first = ordered[a : min(b, a + negatives)]
                head = (anchor, group["ids"][k], p["place"], p["positive_id"], p["positive_score"])
                parts.append((*head, ids[first], rows[first], scores[k][first]))
        return table_of(NEGATIVES, parts)

    found = scored(blocks, asked.drop("floors"), chosen, kernel, NEGATIVES)
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id", "negative")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of all embeddings, every seventh label moved on by one."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", moved.alias("label"), "embedding"))


#: The same result in SQL. Component products and their sums are whole numbers, which doubles hold exactly here.
OP11_SQL = """WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""
