"""Similarity join of texts on word n-grams by prefix trees.

A text's set is its distinct five-word shingles (64-bit fingerprints, ASCII lower case; with fewer words the whole
sequence is one shingle). Two texts link when 100 |A and B| >= 75 |A or B|. The result is the connected component of each
text: one row per row of the table, never the pairs of a group.

1. Texts with equal sets are one node. A linked node shares at least `need` of its first shingles (in the order of their
   fingerprints) with one other node, so nodes with too few repeated ones are dropped; four in ten of the shingles travel.
2. The sets of the nodes left are ordered by global frequency, rarest first; shingles of one node only are counted,
   not kept. A node with too few shared shingles is dropped.
3. The first common shingle of two linked nodes stands so early in both that enough shingles follow: in the smaller one's
   index prefix (a partner is as large or larger) and in the larger one's prefix. Nodes that share such a shingle fall into
   one candidate cluster (components of star edges, so no pairs are made); a shingle that very many texts have, but none
   of them in its index prefix, makes no cluster. Clusters of up to `BLOCK` nodes are one task; larger ones are dealt in
   blocks: every block against a first hub block, then every node outside the cluster's main component against all blocks.
   A block has at most a few hundred nodes.
4. A task holds its ordered sets in a prefix tree (sequences in lexicographic order with the lengths of common prefixes). A
   query walks the leaves it shares a prefix shingle with; the overlap of a common path is counted once, a subtree is
   left when overlap and remaining length cannot reach what is needed, and leaves already connected are passed by.
   Tasks return spanning edges.

Defined results: a null text, or one without words, has an empty set, n_shingles 0, and is its own component; rows with
equal sets are linked; a null id never names a component unless all ids of it are null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernels as K
from .components import components
from .key_filter import Bitmap, bitmap_of
from .spark_io import discard, ids_and_texts, map_batches, stored

#: Two sets link from this many hundredths on.
LEAST = 75
#: Share of a set that step 1 sends beyond the plain prefix, so that one common passage is not enough to stay.
EXTRA = 0.15
#: Nodes of a candidate cluster in one block.
BLOCK = 96


def least_overlap(n, least: int = LEAST):
    """Elements of a set of n that a linked partner has at least."""
    return (least * n + 99) // 100


def sets_of(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row after the last, n, bounds, shingles sorted within each text, node) of runs of texts."""
    for lo, hi, buf, off in K.text_chunks(column):
        doc, h = K.shingles(buf, off, size)
        n = np.bincount(doc, minlength=hi - lo)
        at = np.concatenate([[0], np.cumsum(n)])
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(K.mix(h ^ np.uint64(0x5DEECE66D1234567)))])
            node = K.mix(sums[at[1:]] - sums[at[:-1]] + n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        yield lo, hi, n, at, h, node


def nodes_of_rows(rows: DataFrame, size: int) -> DataFrame:
    """doc_id, n, node of every row; node is null for an empty set."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi, n, _, _, node in sets_of(batch.column("text"), size):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(n), pa.array(node.view(np.int64), mask=n == 0)], ["doc_id", "n", "node"])

    return map_batches(rows, run, "doc_id long, n long, node long")


def extended(n, least: int, extra: float):
    """How many shingles step 1 sends of a set of n, and how many of them must be repeated for the set to stay."""
    low = least_overlap(n, least)
    send = np.minimum(n, n - low + 1 + np.floor(extra * n).astype(np.int64))
    need = 1 + np.floor(extra * low).astype(np.int64)  # a partner has at least `low` elements and sends as many extra as that gives
    return send, np.minimum(need, send)


def first_shingles(rows: DataFrame, size: int, least: int, extra: float) -> DataFrame:
    """(token, node, w): the smallest fingerprints of every set; w rows of the batch have the set."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for _, _, n, at, h, node in sets_of(batch.column("text"), size):
            _, first, times = np.unique(node, return_index=True, return_counts=True)
            live = n[first] > 0
            first, times = first[live], times[live]
            send, _ = extended(n[first], least, extra)
            yield pa.RecordBatch.from_arrays([pa.array(K.gather(h, at[first], send).view(np.int64)), pa.array(np.repeat(node[first], send).view(np.int64)), pa.array(np.repeat(times, send).astype(np.int32))], ["token", "node", "w"])

    return map_batches(rows, run, "token long, node long, w int")


def full_sets(rows: DataFrame, alive: DataFrame, size: int) -> DataFrame:
    """node, n, tokens of the nodes in alive (node, rep), each once.

    Texts are told by a bitmap of nodes; where that would be too large, those whose id names a node are joined first.
    """
    bitmap = rows.sparkSession.sparkContext.broadcast(bitmap_of(alive.select(F.col("node").alias("key")), alive.count()))
    if bitmap.value is None:
        rows = rows.join(alive, rows["doc_id"].eqNullSafe(alive["rep"]), "left_semi")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column("doc_id")
        for lo, _, n, at, h, node in sets_of(batch.column("text"), size):
            maybe = np.flatnonzero((bitmap.value.has(node) if bitmap.value else True) & (n > 0))
            if len(maybe):
                ends = np.concatenate([[0], np.cumsum(n[maybe])])
                tokens = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(K.gather(h, at[maybe], n[maybe]).view(np.int64)))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(lo + maybe)), pa.array(node[maybe].view(np.int64)), pa.array(n[maybe]), tokens], ["rep", "node", "n", "tokens"])

    found = map_batches(rows, run, "rep long, node long, n long, tokens array<long>")
    same = (found["node"] == alive["node"]) & found["rep"].eqNullSafe(alive["rep"])
    return stored(found.join(alive, same, "left_semi").groupBy("node").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens")), "ngram-sets")


def frequency_order(sets: DataFrame, least: int) -> DataFrame:
    """node, n, tokens, ranks: the shared shingles of each set, rarest first, of nodes that have enough of them."""
    each = sets.select("node", "n", F.explode("tokens").alias("token"))
    often = stored(each.groupBy("token").agg(F.count("*").alias("f")).where("f > 1"), "ngram-frequency")
    lists = each.join(often, "token").groupBy("node").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("f", "token"))).alias("all"))
    ordered = stored(lists.where(F.size("all") >= least_overlap_column(F.col("n"), least)).select("node", "n", F.col("all.token").alias("tokens"), F.col("all.f").alias("ranks")), "ngram-ordered")
    discard(often)
    return ordered


def least_overlap_column(n: Column, least: int) -> Column:
    return F.ceil((n * F.lit(least)) / F.lit(100.0) - F.lit(1e-9))


def prefix_length(size: int, n: int, least: int) -> int:
    """Shared shingles in the prefix of a set of n of which `size` are shared: the others come first."""
    return max(0, n - least_overlap(n, least) + 1 - (n - size))


def clusters(ordered: DataFrame, least: int) -> DataFrame:
    """node, cluster: nodes that share a shingle which may be the first common one of a linked pair, directly or through others."""
    n, size = F.col("n"), F.size("tokens")
    of_equals = F.ceil((n * F.lit(2 * least)) / F.lit(100.0 + least) - F.lit(1e-9))  # the overlap that two sets of n need
    early = lambda need: ordered.select("node", F.explode(F.slice("tokens", F.lit(1), F.greatest(F.lit(0), size - need + 1).cast("int"))).alias("token"))
    hubs = stored(early(of_equals).groupBy("token").agg(F.min("node").alias("hub")), "ngram-hubs")
    edges = early(least_overlap_column(n, least)).join(hubs, "token").select(F.col("node").alias("u"), F.col("hub").alias("v")).where("u <> v").distinct()
    placed = components(edges).select("node", F.col("root").alias("cluster"))
    discard(hubs)
    return placed


class PrefixTree:
    """Ordered sets as root-to-leaf paths: the paths in lexicographic order, with the common prefix of neighbours."""

    def __init__(self, nodes: np.ndarray, n: np.ndarray, tokens: list[np.ndarray], ranks: list[np.ndarray], least: int):
        self.least = least
        flat = np.concatenate(tokens)
        distinct, first, back = np.unique(flat, return_index=True, return_inverse=True)
        order = np.lexsort((distinct, np.concatenate(ranks)[first]))
        local = np.empty(len(distinct), np.int32)
        local[order] = np.arange(len(distinct))
        paths = np.split(local[back], np.cumsum([len(t) for t in tokens])[:-1])
        leaf = sorted(range(len(paths)), key=lambda k: paths[k].astype(">i4").tobytes())
        self.nodes, self.n, self.path, self.leaf = nodes[leaf], n[leaf], [paths[k] for k in leaf], np.array(leaf)
        self.common = np.zeros(len(leaf), np.int64)
        for k in range(1, len(leaf)):
            a, b = self.path[k - 1], self.path[k]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            self.common[k] = differ[0] if len(differ) else m
        self.prefix = [prefix_length(len(p), int(s), least) for p, s in zip(self.path, self.n, strict=True)]
        self.member = np.zeros(len(distinct), bool)
        at = np.concatenate([p[:k] for p, k in zip(self.path, self.prefix, strict=True)])
        own = np.repeat(np.arange(len(self.path)), self.prefix)
        by = np.argsort(at, kind="stable")
        self.posted, self.bounds = own[by], np.searchsorted(at[by], np.arange(len(distinct) + 1))
        self.parent = list(range(len(self.path)))

    def root(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = k = self.parent[self.parent[k]]
        return k

    def partners(self, q: int) -> np.ndarray:
        t = self.path[q][: self.prefix[q]]
        found = np.unique(K.gather(self.posted, self.bounds[t], self.bounds[t + 1] - self.bounds[t]))
        n = self.n[q]
        return found[(100 * self.n[found] >= self.least * n) & (100 * n >= self.least * self.n[found]) & (found != q)]

    def join(self, asks: np.ndarray, given: np.ndarray, labels: np.ndarray | None = None) -> list[tuple[int, int]]:
        """Spanning edges of the links between a leaf that asks and one that is given; equal labels are connected already."""
        if labels is not None:
            first: dict[int, int] = {}
            for k, x in enumerate(labels.tolist()):
                self.parent[self.root(k)] = self.root(first.setdefault(x, k))
        edges = []
        for q in np.flatnonzero(asks).tolist():
            path, size, n = self.path[q], len(self.path[q]), int(self.n[q])
            self.member[path] = True
            last, depth, run = 0, 0, np.zeros(1, np.int64)  # overlaps along the path to the leaf that was walked last
            for c in self.partners(q).tolist():
                if not given[c] or asks[c] and given[q] and c > q or self.root(c) == self.root(q):
                    continue
                need = -(-self.least * (n + int(self.n[c])) // (100 + self.least))
                depth = min([depth, *self.common[last + 1 : c + 1].tolist()]) if depth else 0
                last, have = c, int(run[depth])
                run = run[: depth + 1]
                if have + min(len(self.path[c]) - depth, size - have) < need:
                    continue  # the subtree below `depth` cannot reach what is needed
                run = np.concatenate([run, have + np.cumsum(self.member[self.path[c][depth:]])])
                depth = len(run) - 1
                if run[-1] >= need:
                    self.parent[self.root(c)] = self.root(q)
                    edges.append((int(self.nodes[q]), int(self.nodes[c])))
            self.member[path] = False
        return edges


EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def tree_task(least: int):
    def run(table: pa.Table) -> pa.Table:
        """One block, or two of a large cluster. role: 0 both asks and is given, 1 asks, 2 is given."""
        table = table.combine_chunks()
        arrays = lambda c: [x.values.to_numpy() for x in table.column(c)]
        tree = PrefixTree(table.column("node").to_numpy(), table.column("n").to_numpy(), arrays("tokens"), arrays("ranks"), least)
        role, label = table.column("role").to_numpy()[tree.leaf], table.column("label").to_numpy()[tree.leaf]
        edges = tree.join(role != 2, role != 1, label)
        return pa.table({"u": [a for a, _ in edges], "v": [b for _, b in edges]}, EDGES)

    return run


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, least: int = LEAST, extra: float = EXTRA) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs."""
    listed, copies = components_of_rows(ids_and_texts(docs, id_col, text_col), size, least, extra)
    return listed.join(copies, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def components_of_rows(rows: DataFrame, size: int = 5, least: int = LEAST, extra: float = EXTRA) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, node) of every row, and (node, component, root) of every node; nodes of one component share their root."""
    listed = stored(nodes_of_rows(rows, size), "ngram-nodes")
    labels = link_nodes(rows, listed, size, least, extra)
    named = listed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"))
    linked = labels.join(named, "node")
    least_id = linked.groupBy("root").agg(F.min("rep").alias("component"))
    component = stored(linked.join(least_id, "root").select("node", "component", "root"), "ngram-components")
    discard(labels)
    copies = stored(named.join(component, "node", "left").select("node", F.coalesce("component", "rep").alias("component"), F.coalesce("root", "node").alias("root")), "ngram-named")
    discard(component)
    return listed, copies


def link_nodes(rows: DataFrame, listed: DataFrame, size: int, least: int, extra: float) -> DataFrame:
    """(node, root) of every node that links to another one."""
    first = first_shingles(rows, size, least, extra)
    repeated = stored(first.groupBy("token").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("token"), "ngram-repeated")
    counts = first.join(repeated, "token").groupBy("node").agg(F.sum("w").alias("hits"))
    nodes = listed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.count("*").alias("copies"))
    need = F.lit(1) + F.floor(F.lit(extra) * least_overlap_column(F.col("n"), least))
    alive = stored(nodes.join(counts, "node").where(F.col("hits") >= F.col("copies") * need).select("node", "rep"), "ngram-alive")
    sets = full_sets(rows, alive, size)
    ordered = frequency_order(sets, least)
    discard(sets, repeated, alive)
    placed = stored(clusters(ordered, least), "ngram-clusters")
    sizes = stored(placed.groupBy("cluster").agg(F.count("*").alias("members")).withColumn("blocks", F.ceil(F.col("members") / F.lit(BLOCK))), "ngram-sizes")
    block = F.pmod(F.xxhash64("node", "cluster"), F.col("blocks"))
    members = stored(placed.join(sizes, "cluster").select("node", "cluster", "blocks", block.alias("block")).join(ordered, "node"), "ngram-members")
    discard(ordered, placed, sizes)

    zero, hub = F.array(F.lit(0).cast("long")), (F.col("blocks") > 1) & (F.col("block") == 0)
    dealt = members.withColumn("task", F.explode(F.when(hub, F.sequence(F.lit(1).cast("long"), F.col("blocks") - 1)).otherwise(F.array(F.col("block")))))
    dealt = dealt.withColumns({"role": F.lit(0), "label": F.col("node")}).repartition("cluster", "task")
    edges = stored(dealt.groupBy("cluster", "task").applyInArrow(tree_task(least), "u long, v long"), "ngram-edges")
    roots = stored(components(edges), "ngram-roots")
    discard(edges)

    # large clusters: who is outside the main component is held against all
    labelled = stored(members.where("blocks > 1").join(roots, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root"), "ngram-large")
    discard(members)
    main = stored(labelled.groupBy("cluster", "label").agg(F.count("*").alias("c")).groupBy("cluster").agg(F.max_by("label", "c").alias("main")), "ngram-main")
    large = labelled.join(main, "cluster")
    outside = large.where("label <> main")
    ask_blocks = F.ceil(F.count("*") / F.lit(BLOCK))
    asked = stored(outside.groupBy("cluster").agg(ask_blocks.alias("ask_blocks")), "ngram-asked")
    if asked.isEmpty():
        discard(labelled, main, asked)
        return roots
    ask = outside.join(asked, "cluster").withColumn("i", F.pmod(F.xxhash64("node", "label"), F.col("ask_blocks"))).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn("role", F.lit(1))
    given = large.join(asked, "cluster").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ask_blocks") - 1))).withColumn("j", F.col("block")).withColumn("role", F.lit(2))
    columns = ["cluster", "i", "j", "node", "n", "tokens", "ranks", "role", "label"]
    both = ask.select(columns).unionByName(given.select(columns)).repartition("cluster", "i", "j")
    more = stored(both.groupBy("cluster", "i", "j").applyInArrow(tree_task(least), "u long, v long"), "ngram-more")
    discard(labelled, main, asked)
    if more.isEmpty():
        discard(more)
        return roots
    joined = stored(components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more)), "ngram-roots")
    discard(roots, more)
    return joined


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of docs, all columns as they are: that of the least id, of equal ids that of the least set.

    Rows go by id and text, so a repeated id takes no other text of its with it. A row without an id stays only if no row
    of its component has one. Rows without words are kept, of those with equal id and text one. Only rows that may go, by a
    bitmap of their nodes, are shuffled; where that would be too large, all are.
    """
    rows = ids_and_texts(docs, id_col, text_col)
    listed, copies = components_of_rows(rows)
    placed = listed.join(copies, "node").select("doc_id", "node", "root")
    first = placed.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "node")).alias("first"), F.count("*").alias("c")).where("c > 1")
    other = ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("node") == F.col("first.node")))
    gone = stored(placed.join(first, "root").where(other).select(F.col("doc_id").alias("gone_id"), F.col("node").alias("gone_node")).distinct(), "ngram-gone")
    twice = listed.where("node is not null").groupBy("doc_id", "node").agg(F.count("*").alias("c")).where("c > 1")
    doubtful = stored(gone.select(F.col("gone_node").alias("key")).unionByName(twice.select(F.col("node").alias("key"))).distinct(), "ngram-doubtful")
    bitmap = bitmap_of(doubtful, doubtful.count())
    discard(listed, copies, doubtful)
    marked = with_node(docs, id_col, text_col, bitmap, True)
    kept = marked.join(gone, marked["id"].eqNullSafe(gone["gone_id"]) & (marked["node"] == gone["gone_node"]), "left_anti")
    kept = kept.dropDuplicates(["id", "same"]).select("row.*")
    return kept.union(with_node(docs, id_col, text_col, bitmap, False).select("row.*")) if bitmap else kept


def with_node(docs: DataFrame, id_col: str, text_col: str, bitmap: Bitmap | None, doubtful: bool, size: int = 5) -> DataFrame:
    """row (all columns of docs), id, node (the fingerprint of the row's set, null for an empty one) and same (the node or, of an empty set, the text's hash).

    With a bitmap, of the rows whose set is empty or has its node there (doubtful) or of all others.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("same"), text.alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        nodes = pa.concat_arrays([pa.array(node.view(np.int64), mask=n == 0) for _, _, n, _, _, node in sets_of(batch.column("text"), size)])
        out = pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), nodes, pc.coalesce(nodes, batch.column("same"))], ["row", "id", "node", "same"])
        if shared.value:
            maybe = nodes.is_null().to_numpy(False) | shared.value.has(nodes.fill_null(0).to_numpy())
            out = out.filter(pa.array(maybe == doubtful))
        if out.num_rows:
            yield out

    long = lambda name: T.StructField(name, T.LongType())
    return map_batches(rows, run, T.StructType([T.StructField("row", docs.schema), long("id"), long("node"), long("same")]))
