"""Near copies by an LSH forest, confirmed on whole shingle sets.

Every text becomes its set of distinct shingles of some words and a signature of ``HASHES`` minima.
Texts with the same set are one node. Each of ``TREES`` trees reads the signature from another
place, and nodes that agree in its first numbers lie side by side in its order. A region is a run
of nodes that agree in ``DEPTH`` numbers; where that is more than ``REGION`` nodes, its nodes are
compared by one more number, and so on, so depth follows how crowded a region is. Regions that
agree to ``DEEPEST`` numbers and are still larger hold near equal texts: they are dealt into blocks,
by hash, and each node is also paired with the least of its region. More depth only says which nodes
are compared first: once components are known, the nodes outside the commonest component of a region
of ``DEPTH`` numbers, of whatever size, are compared with all its nodes, tile by tile.

In a region, the part of equal numbers in two signatures estimates their likeness. Nodes that are
surely alike are joined by a spanning tree; between the groups this gives, each node is paired with
the ``NEAREST`` likeliest nodes of others. These pairs are confirmed on the full sets, and linked
nodes are followed to components. Then the regions are looked at once more: a node is open if a node
of another component is likely to be alike and was not among its pairs. The sets of open nodes are
brought to their regions, and all pairs between components are confirmed there, so no link depends
on which pairs were chosen first; what is sent are the links alone.

Cases: texts of fewer words are one shingle; null and empty texts and texts of blanks have
no shingles and are linked with nothing; equal texts share a class through their node; a row
without id takes part, and a class without any id has a null one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.base import keep, map_batches, small, store
from tillroll.llm.components import components
from tillroll.llm.kernels import Words, chunks, distinct

#: Words in a shingle unless told otherwise.
SHINGLE = 5
PERCENT = 80
HASHES = 128
TREES = 20
STEP = 6
DEPTH = 4
DEEPEST = 16
REGION = 1024
NEAREST = 8
#: Estimates of 128 numbers err by 0.035 at a likeness of 0.8. Below the first, pairs are not
#: confirmed; from the second on, two nodes are taken to be in one group when pairs are chosen.
UNLIKELY = 0.66
SURE = 0.92
#: Members compared with one set at a time.
MEMBERS = 256

_random = np.random.Generator(np.random.PCG64(4242))
_TIMES = _random.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _random.integers(0, 2**63, HASHES, dtype=np.uint64)


def sets_of(texts: pa.Array, shingle: int = SHINGLE) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(first row, row after the last, sorted distinct shingles of each text)."""
    for lo, hi, data, offsets in chunks(texts):
        yield lo, hi, distinct(*Words(data, offsets).shingles(shingle))


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Signature and 128-bit digest of each set; zeros for an empty one."""
    sizes = np.array([len(s) for s in sets])
    has = np.flatnonzero(sizes)
    numbers, digest = np.zeros((len(sets), HASHES), np.uint32), np.zeros((len(sets), 2), np.uint64)
    if len(has):
        values = np.concatenate([sets[i] for i in has])
        starts = np.cumsum(sizes[has]) - sizes[has]
        for i in range(HASHES):
            numbers[has, i] = np.minimum.reduceat(values * _TIMES[i] + _PLUS[i], starts) >> np.uint64(32)
        digest[has, 0] = np.add.reduceat(values * (values >> np.uint64(7) | np.uint64(1)), starts)
        digest[has, 1] = np.add.reduceat(values ^ (values >> np.uint64(29)) * _TIMES[0], starts) + sizes[has].astype(np.uint64)
    return numbers, digest


def sketched(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, key, n_shingles, node, signature); node and signature null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, sets in sets_of(batch.column(2), shingle):
                numbers, digest = signatures(sets)
                kept = [len(s) > 0 for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(1).slice(lo, hi - lo),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([row.tobytes() if ok else None for row, ok in zip(digest, kept)], pa.binary()),
                        pa.array([row.tobytes() if ok else None for row, ok in zip(numbers, kept)], pa.binary()),
                    ],
                    ["doc_id", "key", "n_shingles", "node", "signature"],
                )

    return map_batches(keyed(docs), run, "doc_id long, key string, n_shingles long, node binary, signature binary")


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, a digest of the text and the text, which together name a row."""
    return docs.select(F.col("doc_id").cast("long"), F.md5("text").alias("key"), F.col("text").cast("string"))


def regions(nodes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(region, node) of every region with two or more nodes, from rows (node, signature).

    A region is a tree, a depth and the hash of that many numbers. Where blocks were made, the least
    node of the region is in each. The second frame has (tree, region, node) of the regions of DEPTH
    numbers that were split, None without any.
    """
    ring = F.concat("signature", F.substring("signature", 1, 4 * DEEPEST))
    found, crowd, depth = None, None, DEPTH
    trees = F.array(*map(F.lit, range(TREES)))
    level = nodes.select("node", ring.alias("ring"), F.explode(trees).alias("tree"))
    while True:
        begin = F.col("tree") * (4 * STEP) + 1
        level = level.withColumn("region", F.xxhash64("tree", F.lit(depth), F.col("ring").substr(begin, F.lit(4 * depth))))
        sizes = keep(level.groupBy("region").agg(F.count("*").alias("n"), F.min("node").alias("least")).filter("n > 1"))
        crowded = sizes.filter(F.col("n") > REGION)
        some, many = sizes.count(), crowded.count()
        fit = level.join(small(sizes.filter(F.col("n") <= REGION), some), "region").select("region", "node")
        if depth == DEEPEST and many:
            blocked = level.join(small(crowded, many), "region").withColumn(
                "block", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / (REGION // 2)))
            )
            members = blocked.select(F.xxhash64("region", "block").alias("region"), "node")
            leads = blocked.select(F.xxhash64("region", "block").alias("region"), F.col("least").alias("node"))
            fit = fit.unionByName(members).unionByName(leads).distinct()
        found = fit if found is None else found.unionByName(fit)
        if depth == DEPTH and many:
            crowd = keep(level.join(small(crowded, many), "region").select("tree", "region", "node"))
        if not many or depth == DEEPEST:
            return found, crowd
        level, depth = level.join(small(crowded, many), "region", "left_semi"), depth + 1


def likely(numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Estimated likeness of a region's nodes, 0 where their sizes forbid a link."""
    alike = np.empty((len(sizes), len(sizes)), np.float32)
    for i in range(len(sizes)):
        alike[i] = (numbers == numbers[i]).mean(1)
    alike[100 * np.minimum.outer(sizes, sizes) < PERCENT * np.maximum.outer(sizes, sizes)] = 0
    np.fill_diagonal(alike, 0)
    return alike


def chosen(alike: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of a region's nodes to confirm first."""
    n = len(alike)
    group, pairs = np.full(n, -1), []
    for first in np.argsort(-(alike >= SURE).sum(1), kind="stable"):
        if group[first] >= 0:
            continue
        group[first], queue = first, [first]
        while queue:
            i = queue.pop()
            for j in np.flatnonzero((alike[i] >= SURE) & (group < 0)):
                group[j] = first
                pairs.append((i, j))
                queue.append(j)
    between = np.where((alike < UNLIKELY) | (group[:, None] == group), 0, alike)
    if between.any():
        # Of two groups, the nodes of the smaller look for partners in the larger.
        rank = np.bincount(group, minlength=n)[group] * n + group
        between[rank[:, None] > rank] = 0
        best = np.argsort(-between, axis=1, kind="stable")[:, :NEAREST]
        pairs += [(j, i) for i in range(n) for j in best[i] if between[i, j] > 0]
    return pairs


def by_region(rows: DataFrame, handle: Callable[[pa.Table], pa.RecordBatch], schema: str) -> DataFrame:
    """What ``handle`` makes of the rows of each region, at most REGION + 1 of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            own = pa.Table.from_batches([batch])
            own = own if rest is None else pa.concat_tables([rest, own]).combine_chunks()
            region = own.column("region").to_numpy()
            cuts = [0, *(np.flatnonzero(region[1:] != region[:-1]) + 1).tolist(), len(region)]
            for lo, hi in zip(cuts[:-2], cuts[1:-1]):
                yield handle(own.slice(lo, hi - lo))
            rest = own.slice(cuts[-2])
        if rest is not None and rest.num_rows:
            yield handle(rest)

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "region").sortWithinPartitions("region", "node").mapInArrow(run, schema)


def _likely(rows: pa.Table) -> np.ndarray:
    numbers = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint32)
    return likely(numbers.reshape(-1, HASHES), rows.column("n_shingles").to_numpy())


def _links(names: list[bytes], pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = [pa.array([names[pair[k]] for pair in pairs], pa.binary()) for k in (0, 1)]
    return pa.RecordBatch.from_arrays(ends, ["a", "b"])


def candidates(members: DataFrame) -> DataFrame:
    """Pairs (a, b) to confirm first, from rows (region, node, n_shingles, signature)."""

    def handle(rows: pa.Table) -> pa.RecordBatch:
        return _links(rows.column("node").to_pylist(), chosen(_likely(rows)))

    found = by_region(members, handle, "a binary, b binary")
    ends = found.withColumn("low", F.least("a", "b")).withColumn("high", F.greatest("a", "b"))
    return ends.dropDuplicates(["low", "high"]).select("a", "b")


def open_nodes(members: DataFrame) -> DataFrame:
    """(region, node) with a likely partner in another component that was not chosen there.

    From rows (region, node, n_shingles, signature, root).
    """

    def handle(rows: pa.Table) -> pa.RecordBatch:
        alike = _likely(rows)
        root = np.unique(rows.column("root").to_pylist(), return_inverse=True)[1]
        left = (alike >= UNLIKELY) & (root[:, None] != root)
        if left.any():
            for i, j in chosen(alike):
                left[i, j] = left[j, i] = False
        found = pa.array(left.any(1))
        return pa.RecordBatch.from_arrays(
            [rows.column(name).combine_chunks().filter(found) for name in ("region", "node")], ["region", "node"]
        )

    return by_region(members, handle, "region long, node binary")


def tiles(crowd: DataFrame) -> DataFrame:
    """(tree, region, node, root) of tiles in which all nodes of different components meet.

    From rows (tree, region, node, root) of regions of any size. Of two components at least one is not
    the commonest of the region: blocks of nodes outside that are laid against blocks of all nodes,
    where sizes, in classes a quarter apart, allow a link. A tile has about REGION nodes.
    """
    names = ["tree", "region", "root"]
    roots = crowd.groupBy("region", "root").agg(F.count("*").alias("n"))
    main = keep(roots.groupBy("region").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots")))
    main = keep(main.filter("roots > 1").drop("roots"))
    size = F.floor(F.log("n_shingles") / F.log(F.lit(100 / PERCENT))).alias("size")
    every = keep(crowd.join(small(main), "region").select(*names, "node", size, (F.col("root") != F.col("main")).alias("rest")))
    blocks = lambda n: F.ceil(n / (REGION // 2))
    counts = every.groupBy("region", "size").agg(
        blocks(F.count("*")).alias("n_all"), blocks(F.sum(F.col("rest").cast("long"))).alias("n_rest")
    )
    counts = keep(counts)
    own, other = counts, counts.select("region", *(F.col(c).alias(f"other_{c}") for c in ("size", "n_all", "n_rest")))
    near = keep(own.join(other, "region").filter(F.abs(F.col("size") - F.col("other_size")) <= 1))
    hashed = F.xxhash64("node", F.lit(1))

    def dealt(rows: DataFrame, blocks_of: str, against: str, place: Callable) -> DataFrame:
        met = rows.join(small(near.filter(F.col(blocks_of) * F.col(against) > 0)), ["region", "size"])
        met = met.withColumn("mine", F.pmod(hashed, F.col(blocks_of)))
        met = met.withColumn("theirs", F.explode(F.sequence(F.lit(0).cast("long"), F.col(against) - 1)))
        return met.select("tree", F.xxhash64("region", *place).alias("region"), "node", "root")

    rest = dealt(every.filter("rest"), "n_rest", "other_n_all", ("size", "mine", "other_size", "theirs"))
    return rest.unionByName(dealt(every, "n_all", "other_n_rest", ("other_size", "theirs", "size", "mine")))


def met_before(numbers: np.ndarray, i: int, others: np.ndarray, tree: int) -> np.ndarray:
    """Whether node i and each of the others also agree in the numbers of an earlier tree."""
    same = numbers[others] == numbers[i]
    out = np.zeros(len(others), bool)
    for t in range(tree):
        out |= same[:, (t * STEP + np.arange(DEPTH)) % HASHES].all(1)
    return out


def open_across(members: DataFrame) -> DataFrame:
    """(region, node) with a likely partner in another component, in the first tree where they agree.

    From rows (tree, region, node, n_shingles, signature, root) of tiles. The lowest bytes of equal
    numbers are equal, so counting those first loses no pair.
    """
    bytewise = np.uint64(0x0101010101010101)

    def handle(rows: pa.Table) -> pa.RecordBatch:
        raw, sizes = b"".join(rows.column("signature").to_pylist()), rows.column("n_shingles").to_numpy()
        numbers = np.frombuffer(raw, np.uint32).reshape(-1, HASHES)
        low = np.ascontiguousarray(numbers.astype(np.uint8))
        tree = rows.column("tree")[0].as_py()
        root = np.unique(rows.column("root").to_pylist(), return_inverse=True)[1].ravel()
        found = np.zeros(len(root), bool)
        for i in np.flatnonzero(root != np.bincount(root).argmax()):
            alike = ((low == low[i]).view(np.uint64).sum(1) * bytewise) >> np.uint64(56)
            fits = 100 * np.minimum(sizes, sizes[i]) >= PERCENT * np.maximum(sizes, sizes[i])
            others = np.flatnonzero((alike >= UNLIKELY * HASHES) & fits & (root != root[i]))
            others = others[(numbers[others] == numbers[i]).mean(1, dtype=np.float32) >= UNLIKELY]
            others = others[~met_before(numbers, i, others, tree)]
            if len(others):
                found[i] = found[others] = True
        kept = pa.array(found)
        return pa.RecordBatch.from_arrays(
            [rows.column(name).combine_chunks().filter(kept) for name in ("region", "node")], ["region", "node"]
        )

    return by_region(members, handle, "region long, node binary")


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets, the first not empty."""
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    return int(np.count_nonzero(a[at] == b))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = common(a, b)
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def settled(members: DataFrame) -> DataFrame:
    """Links (a, b) between components, from rows (region, node, n_shingles, signature, root, shingles)."""

    def handle(rows: pa.Table) -> pa.RecordBatch:
        alike, names = _likely(rows), rows.column("node").to_pylist()
        root = np.unique(rows.column("root").to_pylist(), return_inverse=True)[1].ravel()
        sets = [np.frombuffer(raw, np.uint64) for raw in rows.column("shingles").to_pylist()]
        pairs = []
        for i in range(len(names)):
            for j in np.flatnonzero(alike[i, :i] >= UNLIKELY):
                if root[i] != root[j] and linked(sets[i], sets[j]):
                    pairs.append((i, j))
                    root[root == root[j]] = root[i]
        return _links(names, pairs)

    return by_region(members, handle, "a binary, b binary")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are alike enough, from rows (node, shingles).

    A set travels once per pair as ``b`` and once per MEMBERS pairs as ``a``. They are compared as
    they stream by, one set ``a`` held at a time.
    """
    dealt = F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / MEMBERS)).cast("int")
    counted = pairs.join(pairs.groupBy("a").agg(F.count("*").alias("n")), "a").withColumn("part", dealt)
    asked = counted.select("a", "part", F.col("b").alias("node"), F.lit(1).alias("role")).unionByName(
        counted.select("a", "part", F.col("a").alias("node"), F.lit(0).alias("role")).distinct()
    )
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.uint64)
        for batch in batches:
            links = []
            for a, node, role, raw in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                own = np.frombuffer(raw, np.uint64)
                if role == 0:
                    held = own
                    continue
                if linked(held, own):
                    links.append((a, node))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in links], pa.binary()), pa.array([x for _, x in links], pa.binary())], ["a", "b"]
            )

    return (
        asked.join(sets, "node")
        .select("a", "part", "node", "role", "shingles")
        .repartition(tasks, "a", "part")
        .sortWithinPartitions("a", "part", "role")
        .mapInArrow(run, "a binary, b binary")
    )


def shingle_sets(docs: DataFrame, wanted: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(node, shingles) of the rows (node, doc_id, key) wanted, read from the texts once more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, sets in sets_of(batch.column(1), shingle):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["node", "shingles"],
                )

    texts = keyed(docs)
    named = wanted.select("node", F.col("doc_id").alias("__id"), F.col("key").alias("__key"))
    found = texts.join(named, texts["doc_id"].eqNullSafe(F.col("__id")) & (texts["key"] == F.col("__key")))
    return map_batches(found.select("node", "text"), run, "node binary, shingles binary")


def sets_by_node(docs: DataFrame, nodes: DataFrame, asked: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(node, shingles) of the nodes asked for, from rows (node, doc_id, key)."""
    wanted = keep(nodes.join(small(keep(asked.distinct())), "node", "left_semi"))
    return shingle_sets(docs, small(wanted), shingle).dropDuplicates(["node"])


def classes(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, key, n_shingles, component_id, the least id of its class, and kept."""
    rows = store(sketched(docs, shingle), "shingles")
    heads = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "n_shingles")).alias("head")
    nodes = keep(rows.filter("node is not null").groupBy("node").agg(heads).select("node", "head.*"))
    one = rows.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"), "signature")
    signed = store(
        nodes.join(one, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")))
        .select("node", "n_shingles", "signature")
        .dropDuplicates(["node"]),
        "signatures",
    )
    found, crowd = regions(signed)
    found = keep(found)
    members = found.join(signed, "node").select("region", "node", "n_shingles", "signature")
    pairs = keep(candidates(members))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    first = keep(confirmed(pairs, sets_by_node(docs, nodes, ends, shingle)))
    known = keep(components(first))
    rooted = found.join(small(known), "node", "left").withColumn("root", F.coalesce("root", "node"))
    numbers = ["region", "node", "n_shingles", "signature", "root"]
    # Of two nodes alone in a region, the pair was confirmed if it was likely.
    mixed = rooted.groupBy("region").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = keep(mixed.filter("n > 2 AND low != high").select("region"))
    some = keep(rooted.join(small(mixed), "region", "left_semi"))
    left = open_nodes(some.join(signed, "node").select(numbers))
    if crowd is not None:
        sized = crowd.join(signed.select("node", "n_shingles"), "node").join(small(known), "node", "left")
        laid = tiles(sized.withColumn("root", F.coalesce("root", "node")))
        left = left.unionByName(open_across(laid.join(signed, "node").select("tree", *numbers))).distinct()
    left = keep(left)
    rest = left.join(small(known), "node", "left").withColumn("root", F.coalesce("root", "node")).join(signed, "node")
    rest = rest.join(sets_by_node(docs, nodes, left.select("node"), shingle), "node")
    links = keep(settled(rest.select(*numbers, "shingles")).distinct())
    if not links.isEmpty():
        known = keep(components(links.unionByName(known.select(F.col("root").alias("a"), F.col("node").alias("b")))))
    roots = known
    least = roots.join(nodes, "node").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    joined = keep(roots.join(least, "root").select("node", "component_id"))
    alone = nodes.join(small(joined), "node", "left_anti").select("node", F.col("doc_id").alias("component_id"))
    ids = rows.drop("signature").join(joined.unionByName(alone), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return ids.select(
        "doc_id", "key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def near_copies(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id and kept."""
    return classes(docs, shingle).select("doc_id", "n_shingles", "component_id", "kept")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The documents without those whose class has a smaller id, with the columns they came with."""
    gone = keep(classes(docs, shingle).filter("NOT kept").select(F.col("doc_id").alias("__gone"), F.col("key").alias("__key")).distinct())
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__gone")) & F.md5("text").eqNullSafe(F.col("__key"))
    return docs.join(small(gone), same, "left_anti")
