"""Near-duplicates by MinHash with tensored banding, links confirmed on full shingle sets.

A text is the set of its distinct five-word shingles. Two collections, A and B, of ``GROUPS`` short keys, each of
``HASHES`` minhashes, are made for every distinct set; table (i, j) is keyed by A's key i and B's key j. So
GROUPS * GROUPS tables cost only 2 * GROUPS * HASHES minhashes. At a similarity of 0.75 a pair shares a key of A with
probability 1 - (1 - 0.75**3)**20, above 0.99998, and likewise of B; it is a candidate if both hold.

The tables are not written out at once:

1. Equal sets are one node, whatever their number.
2. In the tables (i, i) each node is paired with the smallest of its bucket. Links confirmed there join most copies; a
   node's text is sent to one centre first, and to another only if that is in another component still.
3. Only buckets of A that still hold several components are looked at again, nodes of different components with each
   other: those that share a key of B, and so a table (i, j), and agree in enough of the signature have their full sets
   compared inside the bucket, which gives only the links that join its components. A bucket with more than ``MAX_PAIRS``
   such pairs or ``MAX_SHINGLES`` shingles is cut into blocks, the nodes of its largest component apart from the others,
   and every two blocks that may hold a pair of different components meet in one place. Nothing is dropped for its
   bucket's size, and a node's copies grow with the number of blocks only.

Defined results: texts without words, empty and null texts have an empty set and are linked with nothing; a text of
one to four words is one shingle; rows with equal ids are told apart by their sets; a component's id is the smallest id
in it that is not null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfseek.llm.components import components
from shelfseek.llm.text_arrays import LOWER, NOT_WHITE, Words, batch_map, distinct, mixed, row_keys, text_bytes, unused, window_hashes
from shelfseek.scratch import stored

SHINGLE = 5
PERCENT = 75
GROUPS = 20
HASHES = 3
SIGNATURE = 2 * GROUPS * HASHES
#: Of the signature's bytes, so many must agree before a pair is confirmed on full sets: at a similarity of 0.75 the
#: expected number is 90 with a deviation of 4.7, so one true pair in 100,000 at that similarity has fewer.
AGREEING = 70
#: Most pairs of different components that a bucket may hold and not be cut.
MAX_PAIRS = 1 << 24
#: Most shingles that the nodes of one bucket have together and it is not cut, about.
MAX_SHINGLES = 4 << 20
#: Most keys, of a few numbers each, that are sent to all tasks to find their rows; with more the rows are shuffled.
MAX_SENT = 1 << 19
#: Members that one task confirms against one centre.
MEMBERS = 64
#: Shingles minhashed at a time.
BLOCK = 1 << 15

MULTIPLIERS = mixed(np.arange(1, SIGNATURE + 1, dtype=np.uint64)) | np.uint64(1)
ADDENDS = mixed(np.arange(10_001, SIGNATURE + 10_001, dtype=np.uint64))


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles: first[i] to first[i + 1] of the hashes are those of text i."""
    data, offsets = text_bytes(column)
    words = Words(LOWER[data], offsets, NOT_WHITE)
    hashes, at = words.windows(SHINGLE)
    rows = words.rows[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    if len(short):
        whole = [window_hashes(words.hashes[words.first[r] : words.first[r + 1]], int(words.counts[r]))[0] for r in short]
        hashes = np.concatenate([hashes, np.array(whole, np.uint64)])
        rows = np.concatenate([rows, short])
        order = np.argsort(rows, kind="stable")
        hashes, rows = hashes[order], rows[order]
    chosen = distinct(row_keys(hashes, rows))
    hashes, rows = hashes[chosen], rows[chosen]
    return hashes, np.searchsorted(rows, np.arange(len(column) + 1))


def set_hashes(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A number for each set that does not depend on the order of its shingles."""
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)))])
        return mixed(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64)


def minhashes(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SIGNATURE minhashes for each set that is not empty."""
    filled = np.flatnonzero(np.diff(first))
    found = np.full((len(filled), SIGNATURE), np.iinfo(np.uint64).max, np.uint64)
    begins = first[filled]
    with np.errstate(over="ignore"):
        for lo in range(0, len(hashes), BLOCK):
            block = hashes[lo : lo + BLOCK]
            a = np.searchsorted(begins, lo, side="right") - 1
            b = np.searchsorted(begins, lo + len(block))
            starts = np.maximum(begins[a:b] - lo, 0)
            for k in range(SIGNATURE):
                least = np.minimum.reduceat((block ^ ADDENDS[k]) * MULTIPLIERS[k], starts)
                np.minimum(found[a:b, k], least, out=found[a:b, k])
    return found


def sketch(batch: pa.RecordBatch) -> pa.Table:
    """doc_id, n_shingles and, for sets that are not empty, node (the set's number), keys of A and B, signature."""
    hashes, first = shingle_sets(batch["text"])
    sizes = np.diff(first)
    filled = np.flatnonzero(sizes)
    least = minhashes(hashes, first)
    grouped = mixed(least).reshape(len(filled), 2 * GROUPS, HASHES)
    keys = np.zeros(grouped.shape[:2], np.uint64)
    with np.errstate(over="ignore"):
        for k in range(HASHES):
            keys = mixed(keys * np.uint64(3) + grouped[:, :, k])
    place = np.full(batch.num_rows, -1)
    place[filled] = np.arange(len(filled))
    empty = place < 0

    def lists(part: np.ndarray) -> pa.Array:
        values = pa.array(part.view(np.int64).reshape(-1))
        offsets = np.concatenate([[0], np.cumsum(np.where(empty, 0, part.shape[1]))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array(empty))

    signature = (least >> np.uint64(56)).astype(np.uint8)
    return pa.table(
        {
            "doc_id": batch["doc_id"],
            "text_hash": batch["text_hash"],
            "n_shingles": pa.array(sizes, pa.int64()),
            "node": pa.array(set_hashes(hashes, first), pa.int64(), mask=empty),
            "a": lists(np.ascontiguousarray(keys[:, :GROUPS])),
            "b": lists(np.ascontiguousarray(keys[:, GROUPS:])),
            "signature": pa.array([None if p < 0 else signature[p].tobytes() for p in place.tolist()], pa.binary()),
        }
    )


def text_hash(text: Column) -> Column:
    """Tells the texts of rows with equal ids, or without ids, apart when a text is looked up."""
    return F.xxhash64(text.cast("string")).alias("text_hash")


def sketches(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), text_hash(F.col(text)))
    schema = (
        f"doc_id {docs.schema[doc_id].dataType.simpleString()}, text_hash bigint, n_shingles bigint, node bigint, a array<bigint>, "
        "b array<bigint>, signature binary"
    )
    return batch_map(narrow, sketch, schema)


def node_table(rows: DataFrame) -> DataFrame:
    """One row per distinct set, with the smallest id that has it and the hash of that row's text."""
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    return (
        rows.filter("node IS NOT NULL")
        .groupBy("node")
        .agg(
            smallest.alias("_row"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("a").alias("a"),
            F.first("b").alias("b"),
            F.first("signature").alias("signature"),
        )
        .select("node", "_row.doc_id", "_row.text_hash", "n_shingles", "a", "b", "signature")
    )


def star_pairs(buckets: DataFrame) -> DataFrame:
    """Each node of a bucket (``key``) with the smallest one in it."""
    centres = buckets.groupBy("key").agg(F.min("node").alias("u"), F.max("node").alias("last")).filter("u < last")
    centres = sent(stored(centres.select("key", "u"), "minhash-centres"))
    return buckets.join(centres, "key").filter("node <> u").select("u", F.col("node").alias("v")).distinct()


def sent(few: DataFrame) -> DataFrame:
    """A stored table of a few numbers a row, marked to be broadcast unless it has too many rows."""
    return F.broadcast(few) if few.count() <= MAX_SENT else few


def agreeing(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose signatures agree in enough places, and in how many (``same``)."""
    known = nodes.select("node", "signature", "n_shingles")
    left = known.select(F.col("node").alias("u"), F.col("signature").alias("s"), F.col("n_shingles").alias("m"))
    right = known.select(F.col("node").alias("v"), F.col("signature").alias("t"), F.col("n_shingles").alias("n"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        s, t = matrix(batch["s"]), matrix(batch["t"])
        m, n = batch["m"].to_numpy(), batch["n"].to_numpy()
        same = (s == t).sum(axis=1)
        near = pa.array((same >= AGREEING) & (100 * np.minimum(m, n) >= PERCENT * np.maximum(m, n)))
        columns = [batch["u"], batch["v"], pa.array(same.astype(np.int32))]
        return pa.RecordBatch.from_arrays([c.filter(near) for c in columns], names=["u", "v", "same"])

    return batch_map(pairs.join(left, "u").join(right, "v"), work, "u bigint, v bigint, same int", None)


def matrix(column: pa.Array) -> np.ndarray:
    """Signatures as rows of bytes."""
    data, _ = text_bytes_of_binary(column)
    return data.reshape(len(column), SIGNATURE)


def text_bytes_of_binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    large = column.cast(pa.large_binary())
    offsets = np.frombuffer(large.buffers()[1], np.int64)[large.offset : large.offset + len(large) + 1]
    data = np.frombuffer(large.buffers()[2], np.uint8) if len(large) else np.empty(0, np.uint8)
    return (data[offsets[0] : offsets[-1]] if len(large) else data), offsets


def by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each key, from batches sorted by key."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.table(batch)
        keys = table["key"].to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            if held and held[0]["key"][0].as_py() != keys[lo]:
                yield pa.concat_tables(held).combine_chunks()
                held = []
            held.append(table.slice(lo, hi - lo))
    if held:
        yield pa.concat_tables(held).combine_chunks()


def near_members(buckets: DataFrame) -> DataFrame:
    """Of each bucket the nodes that may be linked with one of another component: a key of B agrees and so does enough
    of the signature. A pair counts in the first of the buckets of A that it shares.

    ``buckets``: key, i, node, label, n_shingles, a, b, signature."""
    dealt = buckets.repartition("key").sortWithinPartitions("key", "label", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_key(batches):
            n = table.num_rows
            labels, sizes, nodes = (table[c].to_numpy() for c in ("label", "n_shingles", "node"))
            a, b = (table[c].combine_chunks().flatten().to_numpy().reshape(n, GROUPS) for c in ("a", "b"))
            signatures = matrix(table["signature"].combine_chunks())
            own = table["i"][0].as_py()
            found = np.zeros(n, bool)
            after = np.searchsorted(labels, labels, side="right")
            for k, j in enumerate(after.tolist()):
                # Sorted by label: the other components' rows come after this component's last.
                if j == n:
                    break
                # Of two that are both known to have a partner nothing is left to find.
                at = np.flatnonzero(~found[j:]) + j if found[k] else np.arange(j, n)
                at = at[100 * np.minimum(sizes[at], sizes[k]) >= PERCENT * np.maximum(sizes[at], sizes[k])]
                at = at[(b[at] == b[k]).any(axis=1)]
                at = at[np.count_nonzero(signatures[at] == signatures[k], axis=1) >= AGREEING]
                at = at[~(a[at, :own] == a[k, :own]).any(axis=1)]
                if len(at):
                    found[at] = True
                    found[k] = True
            if found.any():
                chosen = np.flatnonzero(found)
                yield pa.RecordBatch.from_pydict({"key": table["key"].to_numpy()[chosen], "node": nodes[chosen]})

    columns = ("key", "i", "node", "label", "n_shingles", "a", "b", "signature")
    return dealt.select(*columns).mapInArrow(run, "key bigint, node bigint")


def bucket_links(members: DataFrame) -> DataFrame:
    """Links between components, confirmed on full sets inside each bucket: as many as join what the bucket joins.

    ``members``: key, node, label, text."""
    dealt = members.repartition("key").sortWithinPartitions("key", "label", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_key(batches):
            hashes, first = shingle_sets(table["text"].combine_chunks())
            nodes, labels = table["node"].to_numpy(), table["label"].to_numpy()
            # Rows with the same id and another text are not this node; a node may have come with several copies.
            own = np.flatnonzero(set_hashes(hashes, first) == nodes)
            _, one = np.unique(nodes[own], return_index=True)
            one = own[np.sort(one)]
            yield pairs_batch(joining(nodes[one], labels[one], [hashes[first[k] : first[k + 1]] for k in one]))

    return dealt.select("key", "node", "label", "text").mapInArrow(run, "u bigint, v bigint").distinct()


def pairs_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["u", "v"]
    )


def joining(nodes: np.ndarray, labels: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Confirmed links that join the components of one bucket, none superfluous. All pairs of different components are
    looked at that can be linked: two sets of which PERCENT are common share one of the rarest shingles of each, as many as
    are left when the share that must be common is taken off, and one more. Pairs that links found have joined are passed over."""
    if len(nodes) < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Shingles numbered by how often they occur: those of one set alone come first.
    rank = np.empty(len(times), np.int64)
    rank[np.argsort(times, kind="stable")] = np.arange(len(times))
    alone = int((times == 1).sum())
    ordered = np.sort(np.repeat(np.arange(len(sets)), sizes) * len(times) + rank[place])
    owner, column = ordered // len(times), ordered % len(times) - alone
    inside = np.arange(len(ordered)) - (np.cumsum(sizes) - sizes)[owner]
    common = column >= 0
    leading = common & (inside < (sizes - (PERCENT * sizes + 99) // 100 + 1)[owner])
    lead_owner, lead_column = owner[leading], column[leading]
    owner, column = owner[common], column[common]
    first = np.searchsorted(owner, np.arange(len(sets) + 1))
    lead_first = np.searchsorted(lead_owner, np.arange(len(sets) + 1))
    by_column = np.argsort(lead_column, kind="stable")
    holders = lead_owner[by_column]
    held = np.searchsorted(lead_column[by_column], np.arange(len(times) - alone + 1))
    names, component, counts = np.unique(labels, return_inverse=True, return_counts=True)
    outside = component != np.argmax(counts)
    marked = np.zeros(len(times) - alone, np.uint8)
    links = []
    for x in np.flatnonzero(outside).tolist():
        near = np.zeros(len(nodes), bool)
        for c in lead_column[lead_first[x] : lead_first[x + 1]].tolist():
            near[holders[held[c] : held[c + 1]]] = True
        # A pair of two outside the largest component is looked at by the first of them.
        at = np.flatnonzero(near & (component != component[x]))
        at = at[~outside[at] | (at > x)]
        at = at[100 * np.minimum(sizes[at], sizes[x]) >= PERCENT * np.maximum(sizes[at], sizes[x])]
        if not len(at):
            continue
        own = column[first[x] : first[x + 1]]
        marked[own] = 1
        both = np.array([np.count_nonzero(marked[column[first[y] : first[y + 1]]]) for y in at.tolist()])
        marked[own] = 0
        for y in at[100 * both >= PERCENT * (sizes[x] + sizes[at] - both)].tolist():
            if component[x] != component[y]:
                component[component == component[y]] = component[x]
                u, v = int(nodes[x]), int(nodes[y])
                links.append((min(u, v), max(u, v)))
    return links


def unresolved(buckets: DataFrame) -> DataFrame:
    """Rows of buckets that hold several components, with the number of pairs of different ones (``pairs``), the label of
    the largest, whether a row is of it (``main``), and nodes and shingles of it and of the others."""
    several = buckets.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least < most")
    rows = stored(buckets.join(sent(stored(several.select("key"), "minhash-several")), "key"), "minhash-open")
    per_label = rows.groupBy("key", "label").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
    n, square = F.sum("n"), F.sum(F.col("n") * F.col("n"))
    counted = per_label.groupBy("key").agg(
        ((n * n - square) / 2).alias("pairs"),
        n.alias("n"),
        F.sum("shingles").alias("shingles"),
        F.max_by("label", "n").alias("top"),
        F.max("n").alias("top_n"),
        F.max_by("shingles", "n").alias("top_shingles"),
    )
    return rows.join(counted, "key").withColumn("main", F.col("label") == F.col("top")).drop("top")


def cut(opened: DataFrame) -> DataFrame:
    """The rows of ``unresolved`` buckets, a large bucket as several: its largest component and its other nodes are each cut
    into blocks, and every two blocks that hold different components meet under a key of their own. A node comes once for each
    block that its own meets, and every pair of different components is together somewhere."""

    def blocks(n: Column, shingles: Column) -> Column:
        of_pairs, of_shingles = F.ceil(n / MAX_PAIRS**0.5), F.ceil(2 * shingles / MAX_SHINGLES)
        return F.greatest(F.lit(1), of_pairs, of_shingles).cast("int")

    small = (F.col("pairs") <= MAX_PAIRS) & (F.col("shingles") <= MAX_SHINGLES)
    columns = ["key", "i", "node", "label", "n_shingles"]
    large = opened.filter(~small).select(
        *columns,
        "main",
        blocks(F.col("top_n"), F.col("top_shingles")).alias("mains"),
        blocks(F.col("n") - F.col("top_n"), F.col("shingles") - F.col("top_shingles")).alias("others"),
    )
    own = F.when(F.col("main"), F.pmod(F.xxhash64("node"), F.col("mains"))).otherwise(
        F.col("mains") + F.pmod(F.xxhash64("node"), F.col("others"))
    )
    met = F.sequence(F.when(F.col("main"), F.col("mains")).otherwise(0), F.col("mains") + F.col("others") - 1)
    large = large.select(*columns, own.cast("int").alias("own"), F.explode(met).alias("met")).filter("own <> met")
    key = F.xxhash64("key", F.least("own", "met"), F.greatest("own", "met")).alias("key")
    return opened.filter(small).select(*columns).unionByName(large.select(key, *columns[1:]))


def tensor_links(nodes: DataFrame, labels: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Confirmed links between different components over all tables (i, j)."""
    labels = sent(labels.select(F.col("v").alias("node"), "label"))
    labelled = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    of_a = labelled.select("node", "label", "n_shingles", F.posexplode("a").alias("i", "value"))
    rows = of_a.select("node", "label", "n_shingles", "i", F.xxhash64("i", "value").alias("key"))
    met = stored(cut(unresolved(rows)), "minhash-met")
    known = nodes.select("node", "a", "b", "signature")
    near = stored(near_members(met_once(met, known)), "minhash-near")
    members = near.join(met.select("key", "node", "label"), ["key", "node"])
    texts = texts_of(near.select("node").distinct(), nodes, docs, doc_id, text)
    return stored(bucket_links(met_once(members, texts)), "minhash-found")


def met_once(places: DataFrame, known: DataFrame) -> DataFrame:
    """``places`` (node and more, a row for each bucket a node is in) joined with ``known`` by node. A node is in a
    bounded number of buckets, so these are listed first, and what is known meets each node once, not each of its rows."""
    columns = [c for c in places.columns if c != "node"]
    listed = places.groupBy("node").agg(F.collect_list(F.struct(*columns)).alias("_places"))
    return listed.join(known, "node").select(F.inline("_places"), "node", *[c for c in known.columns if c != "node"])


def texts_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(node, text) for the given nodes, several times where rows are repeated."""
    ids = nodes.join(wanted, "node").select("node", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), text_hash(F.col(text)))
    same = (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    ids = stored(ids, "minhash-ids")
    if ids.count() <= MAX_SENT:
        # Only texts that are asked for are shuffled.
        own = own.join(F.broadcast(ids.select(F.col("_hash").alias("text_hash")).distinct()), "text_hash", "left_semi")
    return own.join(ids, same).select("node", "text")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (u, v) with 100 * intersection >= PERCENT * union of their full sets. ``texts`` (node, text) has those of all.

    The texts of a centre u's partners meet u's text in tasks of about MEMBERS partners each."""
    parts = pairs.groupBy("u").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("v"), F.col("parts")).cast("int")
    members = pairs.join(parts, "u").select("u", part.alias("part"), F.col("v").alias("node")).join(texts, "node")
    centres = parts.withColumnRenamed("u", "node").join(texts, "node")
    centres = centres.select(
        F.col("node").alias("u"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "node", "text"
    )
    rows = centres.withColumn("member", F.lit(0)).unionByName(members.withColumn("member", F.lit(1)))
    dealt = rows.repartition("u", "part").sortWithinPartitions("u", "part", "member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, centre_set = None, None
        for batch in batches:
            hashes, first = shingle_sets(batch["text"])
            numbers = set_hashes(hashes, first).tolist()
            us, nodes_, part_, member = (batch[c].to_pylist() for c in ("u", "node", "part", "member"))
            linked_u, linked_v = [], []
            for k, (u, node, p, is_member) in enumerate(zip(us, nodes_, part_, member, strict=True)):
                # Rows with the same id and another text are not this node.
                if numbers[k] != node:
                    continue
                own_set = np.sort(hashes[first[k] : first[k + 1]])
                if not is_member:
                    centre, centre_set = (u, p), own_set
                elif centre == (u, p):
                    common = len(np.intersect1d(centre_set, own_set, assume_unique=True))
                    if 100 * common >= PERCENT * (len(centre_set) + len(own_set) - common):
                        linked_u.append(u)
                        linked_v.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(linked_u, pa.int64()), pa.array(linked_v, pa.int64())], names=["u", "v"])

    return dealt.select("u", "part", "node", "text", "member").mapInArrow(run, "u bigint, v bigint").distinct()


def star_links(stars: DataFrame, nodes: DataFrame, docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Confirmed links of the star pairs, as many as join what they join, and the labels of their components.

    A node of a large group is in the stars of many centres, but one link joins it. So each node's best pair is confirmed
    first, then the best pair of any two components, and what is still between two components last.
    """
    ids = stars.select(F.col("u").alias("node")).union(stars.select(F.col("v").alias("node"))).distinct()
    texts = stored(texts_of(ids, nodes, docs, doc_id, text), "minhash-texts")
    links, labels, left = None, None, stars
    best = F.max_by(F.struct("u", "v"), F.struct("same", -F.col("u"), -F.col("v"))).alias("pair")
    for by in (["v"], ["label_u", "label_v"], None):
        if labels is not None:
            of_u = labels.select(F.col("v").alias("u"), F.col("label").alias("_u"))
            of_v = labels.select("v", F.col("label").alias("_v"))
            label_u, label_v = F.coalesce("_u", "u"), F.coalesce("_v", "v")
            ends = left.select("u", "v", "same").join(of_u, "u", "left").join(of_v, "v", "left").select(
                "u", "v", "same", F.least(label_u, label_v).alias("label_u"), F.greatest(label_u, label_v).alias("label_v")
            )
            left = stored(ends.filter("label_u <> label_v"), "minhash-left")
            if left.isEmpty():
                break
        chosen = left.groupBy(*by).agg(best).select("pair.u", "pair.v") if by else left.select("u", "v")
        chosen = stored(chosen, "minhash-chosen")
        found = stored(confirmed(chosen, texts), "minhash-links")
        links = found if links is None else links.union(found)
        labels = components(links)
        left = left.join(chosen, ["u", "v"], "left_anti")
    return links, labels


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept, for each row of ``docs``."""
    rows = stored(sketches(docs, doc_id, text), "minhash-sketches")
    nodes = stored(node_table(rows), "minhash-nodes")

    diagonal = nodes.select("node", F.posexplode(F.arrays_zip("a", "b")).alias("i", "keys"))
    diagonal = diagonal.select("node", F.xxhash64("i", "keys.a", "keys.b").alias("key"))
    stars = stored(agreeing(star_pairs(diagonal), nodes), "minhash-stars")
    links, labels = star_links(stars, nodes, docs, doc_id, text)

    more = tensor_links(nodes, labels, docs, doc_id, text)
    if not more.isEmpty():
        # Components are nodes now: the links found later join them.
        labels = components(links.union(more))

    labelled = nodes.select("node", "doc_id").join(labels.withColumnRenamed("v", "node"), "node", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "node"))
    smallest = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    found = labelled.join(smallest, "label").select("node", "component_id")
    joined = rows.select("doc_id", "n_shingles", "node").join(found, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def op8(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, of which one of each group of near-duplicates stays, the one with the
    smallest id. Rows with equal ids are told apart by their texts, and of rows with equal ids and texts one stays; rows
    without words are in no group and all stay."""
    key = unused("_key", docs.columns)
    keyed = docs.withColumn(key, F.struct(F.col(doc_id).alias("id"), F.xxhash64(F.col(text).cast("string")).alias("text")))
    found = near_duplicates(keyed.select(F.col(key).alias("doc_id"), F.col(text).alias("text")))
    counted = found.groupBy(F.col("doc_id").alias(key)).agg(
        F.sum(F.col("kept").cast("int")).alias("n"), F.max("n_shingles").alias("n_shingles")
    )
    # Most keys are of one row that stays, so the others are listed, and texts are not shuffled to find theirs.
    other = counted.select(key, "n", ((F.col("n") > 1) & (F.col("n_shingles") > 0)).alias("again")).filter("n = 0 OR again")
    other = stored(other, "minhash-other")
    single = keyed.join(sent(other.select(key)), key, "left_anti")
    again = other.filter("again").select(key)
    if not again.isEmpty():
        single = single.unionByName(keyed.join(again, key, "left_semi").dropDuplicates([key]))
    return single.drop(key)
