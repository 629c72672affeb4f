"""Jaccard self-join of texts on word shingles, by a MinHash LSH forest and exact verification.

Texts of equal shingle sets form a class; classes are what is joined. Each class has, for
every tree, a whole label of DEPTH min-hashes: two classes meet in a tree as deep as their
labels agree. Starting from whole labels, the matched prefix is shortened level by level until
a pair at the threshold meets in at least one tree with the target probability, and until as
large a share of the links of a query set has met: its texts are compared with all classes by
brute force while these are signed. Classes that share a prefix of that length in a tree are
candidates; they are found by grouping on the prefix, which gives the same candidates as a walk
over sorted labels. A pair that meets in no tree is lost; README states how likely that is.

Candidates are gathered into clusters. Classes that share a prefix are joined into one cluster only
where the sketches of their whole labels, and their sizes, leave a similarity near the threshold
possible, so that chance prefixes do not chain unrelated texts; where more than SMALL classes
share a prefix, all of them are. A cluster's shingle sets
are read again, once per block of the cluster, and all pairs of a block, or of two blocks of
the cluster, are verified exactly in one task by counting common shingles. No pair
leaves the task: only the number of links per class and the links of a spanning forest do,
which connect classes to groups.

Defined results: a text of fewer than SIZE words is one shingle of all its words; a null
text, or one without words, is a class of its own for each row, without links; repeated rows
and ids are copies; a null id is grouped as any other, and the group's id is the smallest
id that is not null; an empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_through
from .common import SPACE, least_row, row_key, text_or_empty
from .words import combine, mix, word_hashes

SIZE = 5  # words of a shingle
THRESHOLD = 0.8
TREES = 32
DEPTH = 8  # min-hashes of a whole label
TARGET = 0.99999  # probability to meet for a pair at the threshold, and share of the query set's links to meet
QUERIES = 512  # texts that are compared with all classes to measure which links meet
QUERY_POINTS = 1 << 16  # only texts of up to so many characters are queries, so that the set is bounded
SMALL = 256  # classes with a common prefix that are all compared by sketch, at most
DOUBT = 0.2  # a pair is ruled out only if its sketch is so far below the threshold: over 7 standard errors at 0.8
BLOCK_SHINGLES = 1 << 18  # shingles of a block, about
BLOCK_CLASSES = 512  # classes of a block, about
_COLUMNS = 4096  # shingles compared at once
_MULTIPLIERS = np.random.default_rng(8).integers(1, 1 << 62, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def meeting_probability(similarity: float, depth: int, trees: int = TREES) -> float:
    return 1 - (1 - similarity**depth) ** trees


def matched_depth(threshold: float = THRESHOLD, target: float = TARGET) -> int:
    """Shorten the matched prefix from the whole label until a pair at the threshold meets often enough."""
    depth = DEPTH
    while depth > 1 and meeting_probability(threshold, depth) < target:
        depth -= 1
    return depth


def shingle_sets(texts: list[str | None], size: int = SIZE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, counts = word_hashes(texts)
    out, at = [], 0
    for n in counts.tolist():
        w = words[at : at + n]
        at += n
        out.append(w)
    return [
        np.unique(combine(*[w[j : len(w) - size + 1 + j] for j in range(size)])) if len(w) >= size
        else combine(*[w[j : j + 1] for j in range(len(w))], np.array([len(w)], np.uint64)) if len(w) else w
        for w in out]


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that stand for the set: two sums of mixed hashes, sizes included."""
    with np.errstate(over="ignore"):
        a = mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))
        b = mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return np.array([a, b], ">u8").tobytes()


def label_of(shingles: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """The first ``depth`` min-hashes of each tree's label: (TREES, depth) of 32 bits."""
    out = np.empty(TREES * depth, np.uint32)
    step = max(1, (1 << 16) // max(len(shingles), 1))
    for at in range(0, len(out), step):
        m = _MULTIPLIERS[at : min(at + step, len(out))]
        h = shingles[None, :] * m[:, None]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        out[at : at + step] = (h >> np.uint64(32)).min(axis=1)
    return out.reshape(depth, TREES).T


def sketch_of(label: np.ndarray) -> bytes:
    """Four bits of each min-hash, two min-hashes a byte."""
    low = (label.ravel() & np.uint32(15)).astype(np.uint8)
    return (low[::2] | low[1::2] << 4).tobytes()


def alike(sketches: np.ndarray) -> np.ndarray:
    """Estimated similarity of all pairs of sketches (rows of bytes). Unequal min-hashes agree in their four bits in one of 16 cases."""
    differ = sketches[:, None] ^ sketches[None]
    same = ((differ & 15) == 0).sum(axis=2) + ((differ >> 4) == 0).sum(axis=2)
    return (same / (TREES * DEPTH) - 1 / 16) / (1 - 1 / 16)


class QuerySet:
    """Some shingle sets, to compare any other set with all of them by brute force."""

    def __init__(self, sets: list[np.ndarray], threshold: float):
        self.threshold = threshold
        self.keys = [set_key(s) for s in sets]
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.labels = np.array([label_of(s) for s in sets]).reshape(len(sets), TREES, DEPTH)
        shingles, owner = np.concatenate([*sets, np.empty(0, np.uint64)]), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(shingles, kind="stable")
        self.shingles, self.owner = shingles[order], owner[order]
        self.maybe = np.zeros(1 << 20, bool)  # by the low bits: most shingles are in no query
        self.maybe[self.shingles & np.uint64((1 << 20) - 1)] = True

    def levels(self, shingles: np.ndarray, key: bytes, label: np.ndarray) -> list[int]:
        """For each query that the set is linked to: the deepest level at which they meet in a tree."""
        some = shingles[self.maybe[shingles & np.uint64((1 << 20) - 1)]]
        low, high = np.searchsorted(self.shingles, some), np.searchsorted(self.shingles, some, "right")
        times = high - low
        at = np.repeat(low - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum()) if len(some) else low
        common = np.bincount(self.owner[at], minlength=len(self.keys))
        linked = np.flatnonzero(common >= self.threshold * (len(shingles) + self.sizes - common) - 1e-9)
        return [int(np.logical_and.accumulate(self.labels[q] == label, axis=1).sum(axis=1).max()) for q in linked if self.keys[q] != key]


def query_set(docs: DataFrame, threshold: float) -> QuerySet:
    """The texts of the smallest hashes, copies once."""
    texts = docs.filter(F.char_length("text") <= QUERY_POINTS).select("text", F.xxhash64("text").alias("hash"))
    first = [r.hash for r in texts.select("hash").distinct().orderBy("hash").limit(QUERIES).collect()]
    found = texts.filter(F.col("hash").isin(first)).groupBy("hash").agg(F.min("text").alias("text")).collect() if first else []
    sets = {set_key(s): s for s in shingle_sets([r.text for r in found]) if len(s)}
    return QuerySet([sets[k] for k in sorted(sets)], threshold)


def settled_depth(met: dict[int, int], threshold: float = THRESHOLD, target: float = TARGET) -> int:
    """Shorten the prefix of ``matched_depth`` further until the target share of the links of the query set has met.

    ``met`` has the number of links by the deepest level at which they meet.
    """
    depth = matched_depth(threshold, target)
    while depth > 1 and sum(n for level, n in met.items() if level >= depth) < target * sum(met.values()):
        depth -= 1
    return depth


def signed(docs: DataFrame, queries: QuerySet) -> DataFrame:
    """doc_id, row (see ``row_key``), key of the shingle set, its size, the whole labels of all trees, their sketch, and where the set meets the queries it is linked to."""
    kind = dict(docs.dtypes)["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(queries)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries = shared.value
        seen: dict[bytes, tuple[bytes, bytes, list[int]]] = {}  # copies in a task are signed once
        for batch in batches:
            keys, sizes, labels, sketches, levels = [], [], [], [], []
            for s in shingle_sets(list(batch["text"])):
                if not len(s):
                    keys.append(None)
                    sizes.append(0)
                    labels.append(None)
                    sketches.append(None)
                    levels.append([])
                    continue
                key = set_key(s)
                if key not in seen:
                    if len(seen) > 20_000:
                        seen.clear()
                    label = label_of(s)
                    seen[key] = label.astype(">u4").tobytes(), sketch_of(label), queries.levels(s, key, label)
                keys.append(key)
                sizes.append(len(s))
                labels.append(seen[key][0])
                sketches.append(seen[key][1])
                levels.append(seen[key][2])
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "row": batch["row"], "key": keys, "size": sizes, "label": labels, "sketch": sketches, "levels": levels})

    return docs.select("doc_id", "text", row_key().alias("row")).mapInPandas(
        sign, f"doc_id {kind}, row string, key binary, size int, label binary, sketch binary, levels array<int>")


def prefixes_of(depth: int) -> Column:
    """Per tree, a hash of the tree and the first ``depth`` min-hashes of its label."""
    return F.expr(f"transform(sequence(0, {TREES - 1}), t -> xxhash64(t, substring(label, t * {DEPTH * 4} + 1, {depth * 4})))")


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable over ``edges`` (a, b). Every node has a row in ``edges``, maybe to itself.

    In each round every node points to its smallest neighbour, if that is smaller; pointers are
    followed to their ends, and the edges are carried over to these ends. Loops and repeats among them
    go, so what is left shrinks with every round, whatever the degrees are.
    """

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))

    nodes = ends(edges).select(F.col("a").alias("node")).distinct()
    left, moves = write_through(ordered(edges), "edges"), []
    while left.limit(1).count():
        # Of an edge only the greater end has a smaller neighbour; each has one row in the sum.
        move = write_through(left.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), "moves")
        while True:
            after = move.select(F.col("node").alias("root"), F.col("root").alias("next"))
            move = write_through(move.join(after, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "moves")
            moved = move.filter("moved").limit(1).count()
            move = move.select("node", "root")
            if not moved:
                break
        moves.append(move)
        for end, other in (("a", "b"), ("b", "a")):
            target = move.select(F.col("node").alias(end), F.col("root").alias("_to"))
            left = left.join(target, end, "left").select(F.coalesce("_to", end).alias(end), other)
        left = write_through(ordered(left), "edges")
    found = None
    for move in reversed(moves):
        if found is not None:
            later = found.select(F.col("node").alias("root"), F.col("root").alias("next"))
            move = move.join(later, "root", "left").select("node", F.coalesce("next", "root").alias("root")).unionAll(found)
        found = move
    if found is None:
        return nodes.select("node", F.col("node").alias("root"))
    found = write_through(found, "roots")
    return nodes.join(found, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def likely_edges(members: DataFrame, threshold: float) -> DataFrame:
    """a, b: edges that connect, within each row of ``members`` (key, size, sketch), those pairs that may reach the threshold."""
    least = threshold - DOUBT

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("members")
            ends, flat = column.offsets.to_numpy(), column.values
            keys = flat.field("key").to_pylist()
            sizes = flat.field("size").to_numpy().astype(np.float64)
            sketches = np.frombuffer(b"".join(flat.field("sketch").to_pylist()), np.uint8).reshape(-1, TREES * DEPTH // 2)
            a, b = [], []
            for low, high in zip(ends, ends[1:]):
                some, size = sketches[low:high], sizes[low:high]
                near = (alike(some) >= least) & (np.minimum.outer(size, size) >= threshold * np.maximum.outer(size, size) - 1e-9)
                for x, y in enumerate(forest(near, 0)):
                    if x != y:
                        a.append(keys[low + x])
                        b.append(keys[low + y])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return members.select("members").mapInArrow(connect, "a binary, b binary")


def candidate_edges(classes: DataFrame, depth: int, threshold: float) -> DataFrame:
    """a, b: edges over which all classes are connected that share a prefix and may be linked."""
    # Dealt once: the count of a prefix and its join both read this exchange, as they are in one plan.
    prefixes = classes.select("key", F.explode(prefixes_of(depth)).alias("prefix")).repartition("prefix")
    hubs = prefixes.groupBy("prefix").agg(
        F.min("key").alias("hub"), F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("key")).alias("print")).filter("n > 1")
    # Near copies share most of their prefixes: the same classes are met once, not once per tree.
    once = hubs.groupBy("hub", "n", "print").agg(F.min("prefix").alias("prefix"))
    shared = write_through(prefixes.join(once.select("prefix", "hub", "n"), "prefix"), "shared")
    few = shared.filter(F.col("n") <= SMALL).select("prefix", "key").join(classes.select("key", "size", "sketch"), "key")
    members = few.groupBy("prefix").agg(F.collect_list(F.struct("key", "size", "sketch")).alias("members"))
    # Of a class in large buckets: an edge to its smallest hub, and one from each other hub of it to that one.
    many = shared.filter(F.col("n") > SMALL).groupBy("key").agg(F.min("hub").alias("b"), F.collect_set("hub").alias("hubs"))
    stars = many.select(F.explode(F.array_union("hubs", F.array("key"))).alias("a"), "b").filter("a <> b").distinct()
    return likely_edges(members, threshold).unionAll(stars)


def candidate_blocks(classes: DataFrame, depth: int, threshold: float) -> DataFrame:
    """key, size, cluster, block, blocks: classes that may be linked with another, and the blocks of their cluster."""
    edges = write_through(candidate_edges(classes, depth, threshold), "edges")
    found = components(edges).join(classes.select(F.col("key").alias("node"), "size"), "node")
    found = write_through(found.select(F.col("node").alias("key"), F.col("root").alias("cluster"), "size"), "clusters")
    width = found.groupBy(F.col("cluster")).agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    return found.join(write_through(width, "widths"), "cluster").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))


def links_of(sets: list[np.ndarray], sizes: np.ndarray, split: int, threshold: float) -> np.ndarray:
    """Matrix of links between the sets before ``split`` and those from it on (all of them if ``split`` is 0)."""
    n = len(sets)
    shingle, at = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    often = np.bincount(at, minlength=len(shingle)) > 1  # a shingle of one set is in no common part
    keep = often[at]
    place = np.cumsum(often) - 1
    owner, at = owner[keep], place[at[keep]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    a, b = (np.arange(n), np.arange(n)) if not split else (np.arange(split), np.arange(split, n))
    common = np.zeros((len(a), len(b)), np.float32)
    for low in range(0, int(often.sum()), _COLUMNS):
        span = slice(*np.searchsorted(at, (low, low + _COLUMNS)))
        has = np.zeros((n, _COLUMNS), np.float32)
        has[owner[span], at[span] - low] = 1
        rows = has.any(axis=1)
        left, right = np.flatnonzero(rows[a]), np.flatnonzero(rows[b])
        if len(left) and len(right):
            common[np.ix_(left, right)] += has[a[left]] @ has[b[right]].T
    union = sizes[a][:, None] + sizes[b][None, :] - common
    linked = common.astype(np.float64) >= threshold * union - 1e-9
    if not split:
        np.fill_diagonal(linked, False)
    return linked


def forest(linked: np.ndarray, split: int) -> list[int]:
    """For each of the rows (and columns after them, if split): the one that it is connected to, itself for a root."""
    n = linked.shape[0] + (linked.shape[1] if split else 0)
    full = [np.flatnonzero(r) + split for r in linked]
    if split:
        full += [np.flatnonzero(c) for c in linked.T]
    root = [-1] * n
    for i in range(n):
        if root[i] < 0:
            root[i], stack = i, [i]
            while stack:
                for j in full[stack.pop()].tolist():
                    if root[j] < 0:
                        root[j] = i
                        stack.append(j)
    return root


def verified(docs: DataFrame, blocks: DataFrame, threshold: float) -> DataFrame:
    """key, links, root: partial numbers of links, and connections, from all blocks and pairs of blocks."""
    ids = blocks.select("doc_id").distinct().withColumnRenamed("doc_id", "_id")
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select("text")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [s for s in shingle_sets(list(batch["text"])) if len(s)]
            yield pd.DataFrame({"key": [set_key(s) for s in sets], "shingles": [s.tobytes() for s in sets]})

    sets = texts.mapInPandas(read, "key binary, shingles binary").join(blocks.drop("doc_id"), "key").dropDuplicates(["key"])
    # A block meets itself and every other block of its cluster once.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    meetings = sets.select("key", "shingles", "cluster", "block", other).select(
        "key", "shingles", "cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block")

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["block", "key"], ignore_index=True)
        sets = [np.frombuffer(s, "<u8") for s in rows["shingles"]]
        split = int((rows["block"] == key[1]).sum()) if key[1] != key[2] else 0
        if key[1] != key[2] and split in (0, len(sets)):  # one of the two blocks is empty
            return pd.DataFrame({"key": [], "links": [], "root": []})
        linked = links_of(sets, np.array([len(s) for s in sets]), split, threshold)
        links = np.concatenate([linked.sum(axis=1), linked.sum(axis=0)]) if split else linked.sum(axis=1)
        some = np.flatnonzero(links)
        root = np.array(forest(linked, split))
        names = rows["key"].to_numpy()
        return pd.DataFrame({"key": names[some], "links": links[some], "root": names[root[some]]})

    return meetings.groupBy("cluster", "low", "high").applyInPandas(compare, "key binary, links long, root binary")


def signed_groups(docs: DataFrame, threshold: float, target: float) -> tuple[DataFrame, DataFrame]:
    """(the signed rows; key, class_id, copies, links, root of every class: the smallest key of its group)."""
    rows = write_through(signed(docs, query_set(docs, threshold)), "signed")
    first = [F.first(name).alias(name) for name in ("size", "label", "sketch", "levels")]
    classes = write_through(
        rows.filter("size > 0").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), *first), "classes")
    met = {r.level: r["count"] for r in classes.select(F.explode("levels").alias("level")).groupBy("level").count().collect()}
    blocks = candidate_blocks(classes, settled_depth(met, threshold, target), threshold)
    blocks = write_through(blocks.join(classes.select("key", "doc_id"), "key"), "blocks")
    found = write_through(verified(docs, blocks, threshold), "links")
    counts = found.groupBy("key").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    linked = groups.withColumnRenamed("node", "key").join(counts, "key")
    named = classes.select("key", F.col("doc_id").alias("class_id"), "copies").join(linked, "key", "left").withColumn("root", F.coalesce("root", "key"))
    return rows, write_through(named, "named")


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of equal shingle sets), links, group_id, group_size.

    ``links`` counts the other classes whose similarity is at least ``threshold``;
    ``group_id`` is the smallest id of all classes connected by links.
    """
    rows, named = signed_groups(docs, threshold, target)
    sizes = named.groupBy("root").agg(F.min("class_id").alias("group_id"), F.sum("copies").alias("group_size"))
    classed = write_through(named.join(write_through(sizes, "sizes"), "root").select("key", "class_id", F.coalesce("links", F.lit(0).cast("long")).alias("links"), "group_id", "group_size"), "classed")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    empty = rows.filter("size = 0").select("doc_id", F.col("doc_id").alias("class_id"), none.alias("links"), F.col("doc_id").alias("group_id"), one.alias("group_size"))
    return rows.filter("size > 0").select("doc_id", "key").join(classed, "key").drop("key").unionByName(empty)


def one_of_each_group(docs: DataFrame, threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """One document of every group, with the columns they came with: that of the smallest id (a missing one last).

    Of rows of that id in the group the one with the smallest hash of its text stays, of rows equal
    in id and text the smallest row. Documents without words are groups of their own and all stay.
    """
    rows, named = signed_groups(docs, threshold, target)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    best = rows.filter("size > 0").select("doc_id", "row", "key").join(named.select("key", "root"), "key").groupBy("root").agg(F.min(order).alias("best"))
    wanted = write_through(best.select(F.col("best.row").alias("_key")), "kept")
    whole = docs.select(F.struct("*").alias("_row"), row_key().alias("_key"), text_or_empty().rlike(f"[^{SPACE[1:]}").alias("_words"))
    kept = least_row(whole.filter("_words").join(wanted, "_key").select("_key", "_row"))
    return kept.unionAll(whole.filter("NOT _words").select("_row")).select("_row.*")
