"""SimHash near-dedup with vantage-point trees.

Every document gets a 64-bit SimHash of its word shingles. Only distinct fingerprints are compared. A
vantage-point tree over them splits the fingerprints by Hamming distance to a vantage fingerprint: those
within the radius go inside, the others outside, and what lies up to `LINK` bits beyond the radius goes
inside as well. By the triangle bound, two fingerprints at most LINK bits apart then share a leaf: if one is
inside and the other outside, the outer one is at most LINK beyond the radius. So leaves can be searched on
their own, in as many tasks as there are leaves, and no link is lost.

The upper tree is grown on a sample of about `SAMPLE` distinct fingerprints, drawn by hash, which only decides where the
borders run; all fingerprints are then routed and linked. A leaf is searched by the same bounds: a tree of
its own, down to `BLOCK` fingerprints, which are compared exactly. What a leaf sends out is not its pairs but
the smallest linked fingerprint of each fingerprint, at most one row per row it got. Components over leaves
are joined by label passing between the few fingerprints that several leaves hold.

Edge cases: a null, empty or blank text has the fingerprint zero and is linked like any other; repeated rows
stay rows of their own; a row without doc_id takes part in links but never names a component (unless nothing
in it has an id); other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plantflow.llm import blocks as b
from plantflow.session import durable

SHINGLE = 3
LINK = 3
SEED = 42
SAMPLE = 65_536
LEAF = 32_768
MAX_LEAVES = 16_384
BLOCK = 512


# ---- fingerprints ---------------------------------------------------------------------------------

_BITS = np.array([[(i >> j) & 1 for j in range(8)] for i in range(256)], np.uint8)
STEP = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in more than half of the shingles' digests; repeats count."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    count = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for low in range(0, count, STEP):
        pairs = zip(starts[low : low + STEP].tolist(), last[low : low + STEP].tolist())
        found = np.fromiter((digest(joined[i:j], SEED) for i, j in pairs), b.U64)
        votes += np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > count, bitorder="little").view(b.U64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, its fingerprint as a signed 64-bit number, and the MD5 of its text (of an empty one for a null)."""

    def run(batches):
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch["text"]), b.U64, batch.num_rows)
            columns = [batch["doc_id"], pa.array(b.signed(found)), batch["digest"]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fingerprint", "digest"])

    rows = b.text_rows(docs).withColumn("digest", text_digest(F.col("text")))
    return rows.mapInArrow(run, "doc_id long, fingerprint long, digest binary")


def text_digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


# ---- the tree -------------------------------------------------------------------------------------


class Tree:
    """Vantage fingerprints, radii and children; a child below zero is leaf number -1 - child."""

    def __init__(self, sample: np.ndarray, leaf: int, most: int, link: int):
        self.link = link
        self.vantage: list[int] = []
        self.radius: list[int] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        rng = np.random.default_rng(1)
        self.root = self._grow(sample, leaf, most, rng)

    def _grow(self, own: np.ndarray, leaf: int, most: int, rng: np.random.Generator) -> int:
        best = None
        if len(own) > leaf and most > 1:
            for vantage in rng.choice(own, 8):
                count = np.bincount(np.bitwise_count(own ^ vantage), minlength=65 + self.link)
                inside = np.cumsum(count)
                for radius in range(64):
                    # rows that go to either side; a split is as good as its larger side is small
                    larger = max(inside[radius + self.link], len(own) - inside[radius])
                    cost = larger + 0.3 * (inside[radius + self.link] - inside[radius])
                    if best is None or cost < best[0]:
                        best = (cost, larger, vantage, radius)
        if best is None or best[1] > 0.95 * len(own):
            self.leaves += 1
            return -self.leaves
        _, _, vantage, radius = best
        node = len(self.vantage)
        self.vantage.append(int(vantage))
        self.radius.append(radius)
        self.children.append([0, 0])
        far = np.bitwise_count(own ^ vantage)
        for side, rows in enumerate((own[far <= radius + self.link], own[far > radius])):
            self.children[node][side] = self._grow(rows, leaf, most // 2, rng)
        return node

    def route(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf and row of every fingerprint in every leaf it belongs to."""
        leaves, rows, todo = [], [], [(self.root, np.arange(len(own)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if node < 0:
                leaves.append(np.full(len(at), -1 - node, np.int64))
                rows.append(at)
                continue
            far = np.bitwise_count(own[at] ^ b.U64(self.vantage[node]))
            todo.append((self.children[node][0], at[far <= self.radius[node] + self.link]))
            todo.append((self.children[node][1], at[far > self.radius[node]]))
        return (np.concatenate(leaves), np.concatenate(rows)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))


class _Union:
    """Smallest member of each set, merged edge by edge in bulk."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def merge(self, left: np.ndarray, right: np.ndarray) -> None:
        while len(left):
            left, right = self.label[left], self.label[right]
            apart = left != right
            low, high = np.minimum(left, right)[apart], np.maximum(left, right)[apart]
            np.minimum.at(self.label, high, low)
            self._shorten()
            left, right = low, high

    def _shorten(self) -> None:
        while True:
            up = self.label[self.label]
            if np.array_equal(up, self.label):
                return
            self.label = up


def components(own: np.ndarray, link: int = LINK) -> np.ndarray:
    """For sorted distinct fingerprints: the place of the smallest one each is linked with."""
    union = _Union(len(own))
    tree = Tree(own if len(own) <= SAMPLE else np.random.default_rng(2).choice(own, SAMPLE, replace=False), BLOCK, 1 << 30, link)
    leaf, row = tree.route(own)
    order = np.argsort(leaf, kind="stable")
    _, bounds = b.slices(leaf[order])
    for low, high in zip(bounds, bounds[1:]):
        at = np.sort(row[order[low:high]])
        values = own[at]
        for i in range(0, len(at), BLOCK):
            for j in range(i, len(at), STEP):
                near = np.bitwise_count(values[i : i + BLOCK, None] ^ values[None, j : j + STEP]) <= link
                left, right = np.nonzero(near)
                left, right = at[i + left], at[j + right]
                keep = left < right
                union.merge(left[keep], right[keep])
    return union.label


def _leaf_links(link: int):
    def links(table: pa.Table) -> pa.Table:
        """Per leaf: each linked fingerprint and the smallest one it is linked with."""
        own = np.unique(np.asarray(table["fingerprint"]).view(b.U64))
        label = components(own, link)
        size = np.bincount(label, minlength=len(own))[label]
        keep = size > 1
        return pa.table({"fingerprint": pa.array(b.signed(own[keep])), "root": pa.array(b.signed(own[label[keep]]))})

    return links


# ---- components over leaves -----------------------------------------------------------------------


def join_components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (fingerprint, root): every fingerprint with the smallest number reachable.

    Alternates large-star and small-star steps, each a grouping by node with a partial minimum, until
    nothing changes.
    """
    edges = durable(edges.where("fingerprint <> root").distinct())

    def star(both: DataFrame, larger: bool) -> DataFrame:
        # a node's smallest neighbour, itself included, takes over the node's neighbours
        # (written first, so that the join below may split a node with very many neighbours)
        small = durable(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        joined = both.join(small, "u")
        if larger:
            return joined.where("v > u").select(F.col("v").alias("fingerprint"), F.col("m").alias("root"))
        return joined.select(F.col("v").alias("fingerprint"), F.col("m").alias("root")).union(small.select("u", "m"))

    before = None
    while True:
        flipped = edges.select(F.col("root").alias("u"), F.col("fingerprint").alias("v"))
        both = edges.select(F.col("fingerprint").alias("u"), F.col("root").alias("v")).union(flipped)
        edges = durable(star(both, True).where("fingerprint <> root").distinct())
        down = edges.select(
            F.greatest("fingerprint", "root").alias("u"), F.least("fingerprint", "root").alias("v")
        )
        edges = durable(star(down, False).where("fingerprint <> root").distinct())
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("fingerprint", "root")), F.countDistinct("root")).first()
        if now == before:
            return edges.groupBy("fingerprint").agg(F.min("root").alias("root"))
        before = now


def link_classes(spark: SparkSession, distinct: DataFrame, link: int = LINK, leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """Each distinct fingerprint that is linked with another, and the smallest (signed) one of its component."""
    total = distinct.count()
    share = min(1.0, sample / max(total, 1))
    chosen = distinct.where(F.pmod(F.xxhash64("fingerprint"), F.lit(1 << 30)) < int(share * (1 << 30)))
    drawn = np.array([row[0] for row in chosen.collect()], np.int64).view(b.U64)
    tree = Tree(drawn, max(1, int(leaf * share)), MAX_LEAVES, link)
    sent = spark.sparkContext.broadcast(tree)  # at most MAX_LEAVES vantage fingerprints

    def route(batches):
        for batch in batches:
            own = np.asarray(batch["fingerprint"])
            leaves, rows = sent.value.route(own.view(b.U64))
            yield pa.RecordBatch.from_arrays([pa.array(leaves), pa.array(own[rows])], ["leaf", "fingerprint"])

    routed = distinct.mapInArrow(route, "leaf long, fingerprint long")
    found = routed.groupBy("leaf").applyInArrow(_leaf_links(link), "fingerprint long, root long")
    return join_components(found)


def _grouped(docs: DataFrame, shingle: int, link: int) -> tuple[DataFrame, DataFrame]:
    """The marked documents, and each fingerprint with the root of its component."""
    marked = durable(fingerprints(docs, shingle))
    distinct = durable(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("smallest")))
    classes = link_classes(docs.sparkSession, distinct.select("fingerprint"), link)
    member = distinct.join(classes, "fingerprint", "left").select(
        "fingerprint", "smallest", F.coalesce("root", "fingerprint").alias("root")
    )
    return marked, durable(member)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, link: int = LINK) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id reachable over links."""
    marked, named = _grouped(docs, shingle, link)
    first = durable(named.groupBy("root").agg(F.min("smallest").alias("component_id")))
    by_print = durable(named.join(first, "root").select("fingerprint", "component_id"))
    return marked.join(by_print, "fingerprint").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, link: int = LINK) -> DataFrame:
    """The rows of `docs`, one of each component: that with the smallest doc_id, a row without id last.

    A row is known by its doc_id and its text, so rows of one doc_id with unlike texts are judged apart, and a
    row without an id stays only if nothing with an id is linked to it. Of rows alike in both, the smallest stays.
    """
    marked, named = _grouped(docs, shingle, link)
    own = F.struct(F.col("doc_id").isNull().alias("lacks"), "doc_id", "digest")
    rows = marked.groupBy("fingerprint", "doc_id", "digest").count()
    chosen = rows.join(named, "fingerprint").groupBy("root").agg(F.min_by(F.struct(own.alias("own"), "count"), own).alias("c"))
    keep = durable(chosen.select(F.col("c.own.doc_id").alias("kept_id"), F.col("c.own.digest").alias("kept_text"), F.col("c.count").alias("times")))

    names = [f"`{c}`" for c in docs.columns]
    held = docs.select(F.struct(*names).alias("row"), F.col("doc_id").cast("long").alias("own_id"), text_digest(F.col("text").cast("string")).alias("own_text"))
    met = (F.col("own_text") == F.col("kept_text")) & F.col("own_id").eqNullSafe(F.col("kept_id"))
    single = held.join(keep.where("times = 1"), met, "left_semi").select("row.*")
    several = held.join(keep.where("times > 1"), met, "left_semi").groupBy("own_id", "own_text").agg(F.min("row").alias("row"))
    return single.union(several.select("row.*"))
