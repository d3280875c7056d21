"""N-gram Jaccard join with PartEnum signatures.

A document is the set of its distinct 5-word shingles; two link when 100 times the
intersection is at least 80 times the union. Then they differ in at most
(|r| + |s|) / 9 shingles. Sets are handled by bands of size (a set close to a
band's end also in the next). A band cuts the domain of shingles into somewhat
more partitions than the greatest difference, so that similar sets agree in some:
each set orders its partitions (more shingles first) and gives out as signatures
the first ones, one more than its own greatest difference. By the pigeonhole principle
similar sets share one. A signature of fewer than two shingles selects little; a
set that has one goes through the same again with other partitions instead,
as every set that shares this signature does, and only in the last of
``DEPTHS`` rounds such signatures are given out.

Signatures are packed and dealt out by hash; equal sets of a task go out once. Each
task joins the sets that share one by a spanning forest, so a group of any size
costs as many edges as it has sets. The connected sets form candidate clusters, in which
components are formed from verified links only: sets are compared where they share a shingle
of their prefixes (rarest in the cluster first), by counting shared shingles, and a
link with one set of a component is enough. Small clusters are joined in one task. Large
ones are first cut into the parts that prefixes connect; a part that is still large is
joined against a few centres first, then what is still apart against bounded slices.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+``, A-Z in lower case; fewer than
five words are one shingle; texts of any length are read whole; a null, empty or blank text has none and links with
nothing; equal rows link; the component's id is its smallest id that is not
null (null if there is none); an empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmart.llm.common import (
    U64, Words, dealt_anew, distinct_name, mix, ngrams, ranges, row_number, shuffle_partitions, stage, text_arrays)
from quillmart.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5
PERCENT = 80            # of the union
SLACK = 1.3             # partitions to greatest difference
STRONG = 2              # shingles of a signature that selects
DEPTHS = 4
CLUSTER_SHINGLES = 2_000_000   # of a cluster that one task joins, and of a slice of a larger one
CENTRES = 16            # of a larger cluster
MANY = 64               # members from which a set is compared with all at once
TEXT_BYTES = 8 << 20     # of text handled at once in a task
KEYS_SENT = 1_000_000   # row keys (8 bytes each) that are broadcast at most

ENTRY = np.dtype([("low", "<u4"), ("node", "<i8")])
SET = np.dtype([("row", "<i8"), ("doc", "<i8"), ("null", "u1"), ("n", "<i4"), ("node", "<i8"), ("check", "<i8")])


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, first of each text): the distinct shingles of each text, in ascending order."""
    words = Words(texts, lower=True)
    n = len(texts)
    if not len(words):
        return np.zeros(0, U64), np.zeros(n + 1, np.int64)
    hashes = words.hashes()[0]
    counts = np.diff(words.docs)
    runs = ngrams(hashes, SHINGLE)
    doc = np.repeat(np.arange(n), counts)
    left = np.repeat(words.docs[1:], counts) - np.arange(len(words))
    full = np.flatnonzero(left[: len(runs)] >= SHINGLE)
    owner, value = [doc[full]], [runs[full]]
    for size in range(1, SHINGLE):  # whole texts of fewer words
        few = np.flatnonzero(counts == size)
        if len(few):
            owner.append(few)
            value.append(ngrams(hashes, size)[words.docs[:-1][few]] + U64(size))
    owner, value = np.concatenate(owner), np.concatenate(value)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, value = owner[new], value[new]
    return value, np.searchsorted(owner, np.arange(n + 1))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, U64), np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def difference(sizes: np.ndarray, largest: np.ndarray) -> np.ndarray:
    """Greatest size of the symmetric difference with a similar set of at most ``largest``."""
    other = np.minimum(largest, sizes * 100 // PERCENT)
    return (sizes + other) * (100 - PERCENT) // (100 + PERCENT)


def signatures(shingles: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(set, 64-bit signature) for all sets; sets without shingles have none."""
    sizes = np.diff(first)
    own = np.floor(np.log2(np.maximum(sizes, 1))).astype(np.int64)
    cross = sizes * 100 // PERCENT >= 2 << own
    out = []
    for step in (0, 1):  # the set's own band, and the next one for sets close to its end
        todo = np.flatnonzero((sizes > 0) if step == 0 else (sizes > 0) & cross)
        for depth in range(DEPTHS):
            if not len(todo):
                break
            sets, value, weak = _band_signatures(shingles, first, todo, own[todo] + step, depth)
            out.append((sets, value))
            todo = weak
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    return np.concatenate([s for s, _ in out]), np.concatenate([v for _, v in out])


def _band_signatures(shingles, first, sets, band, depth):
    """Signatures of ``sets`` in their ``band`` in round ``depth``, and the sets that go to the next round."""
    sizes = np.diff(first)[sets]
    top = (2 << band) - 1
    parts = np.maximum(1, ((2 * top * (100 - PERCENT) // (100 + PERCENT) + 1) * SLACK).astype(np.int64))
    give = np.minimum(difference(sizes, top) + 1, parts)
    at = ranges(first[sets], sizes)
    k = np.repeat(np.arange(len(sets)), sizes)
    value = shingles[at]
    seed = mix(band.astype(U64) * U64(DEPTHS) + U64(depth) + U64(1))
    place = (mix(value ^ seed[k]) % parts[k].astype(U64)).astype(np.int64)
    lead = np.concatenate([[0], np.cumsum(parts)])
    slot = lead[k] + place
    order = np.argsort(slot, kind="stable")
    slot, value = slot[order], mix(value[order])
    cut = np.searchsorted(slot, np.arange(lead[-1] + 1))
    content, count = _sums(value, cut), np.diff(cut)
    owner = np.repeat(np.arange(len(sets)), parts)
    number = np.arange(lead[-1]) - lead[owner]
    token = mix(content ^ mix(seed[owner] + number.astype(U64)))
    order = np.lexsort((token, -count, owner))
    chosen = order[np.arange(len(order)) - lead[owner[order]] < give[owner[order]]]
    weak = count[chosen] < STRONG
    if depth == DEPTHS - 1:
        return sets[owner[chosen]], token[chosen], np.zeros(0, np.int64)
    return sets[owner[chosen[~weak]]], token[chosen[~weak]], sets[np.unique(owner[chosen[weak]])]


def _forest(groups: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """A spanning forest (child, root) of the nodes joined by equal group numbers (sorted by group)."""
    names, code = np.unique(nodes, return_inverse=True)
    parent = np.arange(len(names))
    new = np.ones(len(groups), bool)
    new[1:] = groups[1:] != groups[:-1]
    head = code[np.flatnonzero(new)][np.cumsum(new) - 1]
    a, b = head, code
    while True:  # hook roots to smaller roots and halve the paths until every edge is inside a tree
        ra, rb = parent[a], parent[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        apart = low < high
        if not apart.any():
            break
        np.minimum.at(parent, high[apart], low[apart])
        while True:
            jump = parent[parent]
            if np.array_equal(jump, parent):
                break
            parent = jump
        a, b = a[apart], b[apart]
    child = np.flatnonzero(parent != np.arange(len(names)))
    return np.stack([names[child], names[parent[child]]])


PACKED = "bucket int, payload binary"
FOUND = "kind int, row long, doc_id long, n int, node long, check long, other long"


def _found(kind, row=None, doc=None, n=None, node=None, check=None, other=None, size=0):
    columns = [np.full(size, kind, np.int32), row, doc, n, node, check, other]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.nulls(size, t) if c is None else (c if isinstance(c, pa.Array) else pa.array(c, t))
         for c, t in zip(columns, types)], names=["kind", "row", "doc_id", "n", "node", "check", "other"])


def sets_and_candidates(rows: DataFrame, buckets: int) -> DataFrame:
    """From (row, doc_id, text): rows of kind 0, one per document (row, doc_id, n, node, check: a
    set's 128-bit hash in two halves), and of kind 1, candidate edges (node, other)."""

    def emit(batches):
        for table, texts in text_arrays(batches, limit=TEXT_BYTES):
            shingles, first = shingle_sets(texts)
            node = _sums(mix(shingles), first).view(np.int64)
            check = _sums(mix(shingles ^ U64(0xA5A5A5A5A5A5A5A5)), first).view(np.int64)
            ids = table["doc_id"].combine_chunks()
            docs = np.zeros(len(texts), SET)
            docs["row"], docs["null"] = table["row"].to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
            docs["doc"], docs["n"] = ids.fill_null(0).to_numpy(), np.diff(first)
            docs["node"], docs["check"] = node, check
            _, once = np.unique(docs[["node", "check"]], return_index=True)  # equal sets go out once
            keep = np.sort(once)
            spans = np.diff(first)[keep]
            some = shingles[ranges(first[keep], spans)]
            own, value = signatures(some, np.concatenate([[0], np.cumsum(spans)]))
            bucket = ((value & U64(0xFFFFFFFF)) % U64(buckets)).astype(np.int64)
            entry = np.zeros(len(value), ENTRY)
            entry["low"], entry["node"] = value >> U64(32), node[keep][own]
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            entry = entry[order]
            full = np.flatnonzero(np.diff(cuts))
            home = -1 - int(docs["row"][0]) % buckets
            yield pa.RecordBatch.from_arrays([
                pa.array([*full.tolist(), home], pa.int32()),
                pa.array([entry[cuts[b]: cuts[b + 1]].tobytes() for b in full] + [docs.tobytes()], pa.binary())],
                names=["bucket", "payload"])

    def group(batches):
        parts = []
        for batch in batches:
            for b, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if b >= 0:
                    parts.append(np.frombuffer(p, ENTRY))
                    continue
                docs = np.frombuffer(p, SET)
                yield _found(0, docs["row"], pa.array(docs["doc"], mask=docs["null"] != 0), docs["n"], docs["node"],
                             docs["check"], None, len(docs))
        if not parts:
            return
        entries = np.concatenate(parts)
        order = np.argsort(entries["low"], kind="stable")
        low, node = entries["low"][order], entries["node"][order]
        same = low[1:] == low[:-1]
        again = np.zeros(len(low), bool)
        again[1:] |= same
        again[:-1] |= same
        edges = _forest(low[again], node[again])
        yield _found(1, node=edges[0], other=edges[1], size=edges.shape[1])

    packed = rows.mapInArrow(emit, PACKED)
    where = F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(-1 - F.col("bucket"))
    return packed.repartitionById(buckets, where.cast("int")).mapInArrow(group, FOUND)


def links(n: np.ndarray, size: int, shared: np.ndarray) -> np.ndarray:
    """Which sets of sizes ``n`` link with one of ``size`` given the sizes of the intersections."""
    return (shared > 0) & (100 * shared >= PERCENT * (n + size - shared))


class Postings:
    """The sets of some members by shingle."""

    def __init__(self, blobs: list[np.ndarray]):
        self.sizes = np.array([len(b) for b in blobs], np.int64)
        flat = np.concatenate(blobs) if blobs else np.zeros(0, U64)
        owner = np.repeat(np.arange(len(blobs)), self.sizes)
        order = np.argsort(flat, kind="stable")
        self.owner = owner[order]
        self.names, self.first = np.unique(flat[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(flat)))

    def linked(self, blob: np.ndarray) -> np.ndarray:
        """Members that link with a set."""
        if not len(self.names):
            return np.zeros(0, np.int64)
        at = np.searchsorted(self.names, blob)
        at[at == len(self.names)] = 0
        at = at[self.names[at] == blob]
        shared = np.bincount(self.owner[ranges(self.first[at], self.count[at])], minlength=len(self.sizes))
        return np.flatnonzero(links(self.sizes, len(blob), shared))


def prefix_length(n):
    """Of a set's shingles, rarest first, the least number one of which every set that links with it has in
    its own such part: the intersection holds at least ``PERCENT`` of the set."""
    return n - -(-PERCENT * n // 100) + 1


def _cluster_labels(rows: np.ndarray, blobs: list[np.ndarray]) -> np.ndarray:
    """The smallest row of each member's component, by exact comparison.

    Only members that share a shingle of both their prefixes are compared (shingles that
    a whole cluster shares are the last ones and in few prefixes), and of these only
    members of other components so far.
    """
    order = np.argsort(rows, kind="stable")
    blobs = [blobs[i] for i in order]
    sizes = np.array([len(b) for b in blobs], np.int64)
    flat = np.concatenate(blobs)
    owner = np.repeat(np.arange(len(blobs)), sizes)
    _, code, uses = np.unique(flat, return_inverse=True, return_counts=True)
    rare = np.lexsort((code, uses[code], owner))  # each member's shingles, rarest first
    place = np.arange(len(flat)) - np.repeat(np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    kept = rare[(place < prefix_length(sizes)[owner]) & (uses[code[rare]] > 1)]
    first = np.searchsorted(owner[kept], np.arange(len(blobs) + 1))
    # the members listed under each prefix shingle, and the place of each entry in its list
    by = np.lexsort((owner[kept], code[kept]))
    members, codes = owner[kept][by], code[kept][by]
    place, begin = np.empty(len(by), np.int64), np.empty(len(by), np.int64)
    place[by], begin[by] = np.arange(len(by)), np.searchsorted(codes, codes)

    def linked(i: int, j: int) -> bool:
        if 100 * min(sizes[i], sizes[j]) < PERCENT * max(sizes[i], sizes[j]):
            return False
        return bool(links(sizes[j], sizes[i], len(np.intersect1d(blobs[i], blobs[j], assume_unique=True))))

    label = np.arange(len(blobs))  # each member's component: its smallest member

    def join(i: int, others: np.ndarray) -> None:
        met = np.unique(np.append(label[others], label[i]))
        if len(met) > 1:
            label[np.isin(label, met)] = met[0]

    postings = None
    if len(blobs) > MANY:  # groups of near copies come together by a few members
        postings = Postings(blobs)
        for i in range(MANY):
            if not label.any():
                break
            join(i, postings.linked(blobs[i]))
    for i in range(len(blobs)):
        if i % MANY == 0 and not label.any():  # all are one component
            break
        mine = slice(first[i], first[i + 1])
        before = members[ranges(begin[mine], place[mine] - begin[mine])]
        apart = before[label[before] != label[i]]
        if len(apart) > MANY:  # count the shingles shared with all members at once
            postings = postings or Postings(blobs)
            join(i, postings.linked(blobs[i]))
        else:
            for j in np.unique(apart).tolist():
                if label[j] != label[i] and linked(i, j):
                    join(i, np.array([j]))
    out = np.empty_like(rows)
    out[order] = rows[order][label]
    return out


def _join_small(batches):
    """Members in order of their cluster, each cluster whole in a partition: (row, label)."""
    cluster, rows, blobs = None, [], []

    def done():
        own = np.array(rows, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(own), pa.array(_cluster_labels(own, blobs))], names=["row", "label"])

    for batch in batches:
        for c, r, b in zip(*(batch.column(k).to_pylist() for k in ("cluster", "row", "shingles"))):
            if c != cluster and rows:
                yield done()
                rows, blobs = [], []
            cluster = c
            rows.append(r)
            blobs.append(np.frombuffer(b, U64))
    if rows:
        yield done()


def _large_edges(spark: SparkSession, members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the components of clusters too large for one task.

    First each member is compared with a few centres of its cluster. Members that
    are not in the cluster's largest component so far are then compared with all
    members, in slices and blocks of bounded size.
    """
    spread = Window.partitionBy("cluster").orderBy(F.xxhash64("row"), "row")
    centres = (members.join(sizes, "cluster").where(  # about 2 x CENTRES of each by hash, then exactly CENTRES
        F.pmod(F.xxhash64("row"), F.col("members")) < 2 * CENTRES + 8)
        .withColumn("k", F.row_number().over(spread)).where(F.col("k") <= CENTRES)
        .select("cluster", F.col("row").alias("c_row"), F.col("shingles").alias("c_shingles")))

    def near(batches):
        for batch in batches:
            a, b = [], []
            for r, c, own, other in zip(*(batch.column(k).to_pylist() for k in ("row", "c_row", "shingles", "c_shingles"))):
                x, y = np.frombuffer(own, U64), np.frombuffer(other, U64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if r != c and 100 * shared >= PERCENT * (len(x) + len(y) - shared):
                    a.append(r)
                    b.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    stars = stage(spark, members.join(centres, "cluster").mapInArrow(near, "a long, b long"), "centres")
    roots = components(spark, stars)
    labelled = members.join(roots, members["row"] == roots["node"], "left").select(
        "cluster", "row", "n", "shingles", F.coalesce("root", "row").alias("label"))
    labelled = stage(spark, labelled, "labelled")
    largest = (labelled.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("size"))
               .groupBy("cluster").agg(F.max_by("label", F.struct("size", "label")).alias("main")))
    cut = sizes.select("cluster", F.ceil(F.col("total") / CLUSTER_SHINGLES).cast("int").alias("slices"))
    held = labelled.join(cut, "cluster").withColumn("slice", F.pmod(F.xxhash64("row"), F.col("slices")).cast("int"))
    apart = (held.join(largest, "cluster").where(F.col("label") != F.col("main")).drop("main", "slice")
             .withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.col("slices")).cast("int"))
             .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))))
    blocks = apart.select("cluster", "block").distinct()
    key = ["cluster", "slice", "block"]
    slices = held.join(blocks, "cluster")

    def compare(key, left, right):
        rows, label = left["row"].to_numpy(), left["label"].to_numpy()
        postings = Postings([np.frombuffer(b, U64) for b in left["shingles"].to_pylist()])
        a, b = [], []
        for r, own, blob in zip(right["row"].to_pylist(), right["label"].to_pylist(), right["shingles"].to_pylist()):
            found = postings.linked(np.frombuffer(blob, U64))
            other = np.unique(label[found])
            other = other[other != own]
            a += [r] * len(other)
            b += other.tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    cols = [*key, "row", "label", "shingles"]
    right = apart.select(*(F.col(c).alias(c) for c in cols))  # names of its own: both come from one table
    rest = slices.select(*cols).groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(compare, "a long, b long")
    return stars.unionByName(stage(spark, rest, "apart"))


def finer_clusters(spark: SparkSession, members: DataFrame) -> DataFrame:
    """(row, part): members (cluster, row, n, shingles) of large clusters connected by a shingle that both
    have in their prefixes, rarest in the cluster first; members connected with no other are left out.

    Sets that only have a template in common share no such shingle, whatever signatures
    connected them.
    """

    def spread(batches):
        for batch in batches:
            blobs = batch.column("shingles").to_pylist()
            counts = np.array([len(b) // 8 for b in blobs], np.int64)
            take = np.repeat(np.arange(len(blobs)), counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(take)) for c in ("cluster", "row", "n")]
                + [pa.array(np.frombuffer(b"".join(blobs), np.int64))], names=["cluster", "row", "n", "shingle"])

    each = stage(spark, members.select("cluster", "row", "n", "shingles").mapInArrow(
        spread, "cluster long, row long, n int, shingle long"), "cluster-shingles")
    uses = (each.groupBy("cluster", "shingle").agg(F.count(F.lit(1)).alias("uses")).where("uses > 1")
            .select(dealt_anew("cluster"), dealt_anew("shingle"), "uses"))
    shared = each.join(uses, ["cluster", "shingle"]).groupBy("cluster", "row", "n").agg(
        F.array_sort(F.collect_list(F.struct("uses", "shingle"))).alias("by_use"))
    # a member's shingles that no other has come first
    left = F.expr(f"n - cast(ceil({PERCENT} * n / 100) as int) + 1 - (n - size(by_use))")
    listed = stage(spark, shared.where(left > 0).select(
        "cluster", "row", F.explode(F.slice("by_use", F.lit(1), left)).alias("s")).select("cluster", "row", "s.shingle"), "prefixes")
    least = (listed.groupBy("cluster", "shingle").agg(F.min("row").alias("b"), F.count(F.lit(1)).alias("k")).where("k > 1")
             .select(dealt_anew("cluster"), dealt_anew("shingle"), "b"))
    edges = listed.join(least, ["cluster", "shingle"]).where("row <> b").select(F.col("row").alias("a"), "b")
    return components(spark, edges).select(F.col("node").alias("row"), F.col("root").alias("part"))


def jaccard_rows(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(row, doc_id, n, label): the component of each row, null where the text has no words."""
    buckets = shuffle_partitions(spark)
    rows = documents.select(row_number(spark).alias("row"),
                            F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = stage(spark, sets_and_candidates(rows, buckets), "sets")
    docs = found.where("kind = 0 and n > 0").select("row", "doc_id", "n", "node", "check")
    edges = found.where("kind = 1").select(F.col("node").alias("a"), F.col("other").alias("b"))
    clusters = components(spark, edges).withColumnRenamed("root", "cluster")
    sets = stage(spark, docs.groupBy("node", "check", "n").agg(F.min("row").alias("row")), "distinct-sets")
    wanted = stage(spark, sets.join(clusters, "node").select("row", "cluster", "n"), "candidates")
    keys = wanted.select("row", "cluster")
    few = keys.limit(KEYS_SENT + 1).count() <= KEYS_SENT

    def as_sets(batches):
        for table, texts in text_arrays(batches, limit=TEXT_BYTES):
            shingles, first = shingle_sets(texts)
            blobs = [shingles[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays(
                [table["cluster"].combine_chunks(), table["row"].combine_chunks(),
                 pa.array(np.diff(first), pa.int32()), pa.array(blobs, pa.binary())],
                names=["cluster", "row", "n", "shingles"])

    members = rows.select("row", "text").join(F.broadcast(keys) if few else keys, "row").mapInArrow(
        as_sets, "cluster long, row long, n int, shingles binary")
    sizes = wanted.groupBy("cluster").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("members"))
    large = stage(spark, sizes.where(F.col("total") > CLUSTER_SHINGLES), "large")
    if large.isEmpty():
        labels = members.repartition(buckets, "cluster").sortWithinPartitions("cluster").mapInArrow(
            _join_small, "row long, label long")
    else:
        members = stage(spark, members, "members")
        of_large = members.join(large.select("cluster"), "cluster", "left_semi")
        parts = finer_clusters(spark, of_large)
        finer = of_large.join(parts, "row").select(F.col("part").alias("cluster"), "row", "n", "shingles")
        members = stage(spark, members.join(large, "cluster", "left_anti").select("cluster", "row", "n", "shingles")
                        .unionByName(finer), "finer")
        sizes = members.groupBy("cluster").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("members"))
        large = stage(spark, sizes.where(F.col("total") > CLUSTER_SHINGLES), "finer-large")
        labels = (members.join(large, "cluster", "left_anti").repartition(buckets, "cluster")
                  .sortWithinPartitions("cluster").mapInArrow(_join_small, "row long, label long"))
        of_large = members.join(large.select("cluster"), "cluster", "left_semi")
        joined = components(spark, _large_edges(spark, of_large, large))
        labels = labels.unionByName(joined.select(F.col("node").alias("row"), F.col("root").alias("label")))
    of_set = sets.join(stage(spark, labels, "labels"), "row", "left").select(
        "node", "check", F.coalesce("label", "row").alias("label"))
    linked = docs.join(of_set, ["node", "check"]).select("row", "doc_id", "n", "label")
    alone = found.where("kind = 0 and n = 0").select("row", "doc_id", "n", F.lit(None).cast("long").alias("label"))
    return linked.unionByName(alone)


def jaccard_join(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Per row: doc_id, size of its set, and the smallest id of its component."""
    rows = stage(spark, jaccard_rows(spark, documents), "joined")
    least = (rows.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
             .select(dealt_anew("label"), "least"))
    return rows.join(least, "label", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def keep_one(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each component, that with the smallest id (null ids last, then
    the first row); rows without words all stay. All columns stay."""
    rows = stage(spark, jaccard_rows(spark, documents), "joined").where("label is not null")
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("row"))
    first = rows.groupBy("label").agg(F.min(order)["row"].alias("row"))
    gone = stage(spark, rows.join(first, "row", "left_anti").select("row"), "duplicates")
    few = gone.limit(KEYS_SENT + 1).count() <= KEYS_SENT
    name = distinct_name(documents, "row")
    gone = gone.withColumnRenamed("row", name)
    return documents.withColumn(name, row_number(spark)).join(
        F.broadcast(gone) if few else gone, name, "left_anti").select(*documents.columns)
