"""N-gram Jaccard join: MinHash bands find candidates, full shingle sets decide."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsledger.llm.shingles import band_hashes, choose_bands, shingle_hashes, signature
from obsledger.llm.tables import Scratch, components, map_rows, texts_of

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
BLOCK_SHINGLES = 1 << 17
LEAST_ROWS, BLOCK_ROWS = 128, 1024
"""A group of candidates is cut into blocks of at most so many shingles, and of as many rows as the square root of the
group's, between these bounds. Every two blocks are compared in a task of their own, so a task's memory does not grow
with the group, and a row is copied about as often as a block has rows."""
COLUMNS = 2048

SETS = T.StructType(
    [
        T.StructField("_doc", T.LongType()),
        T.StructField("_hash", T.LongType()),
        T.StructField("_set", T.StringType()),
        T.StructField("_n", T.IntegerType()),
        T.StructField("_bands", T.ArrayType(T.LongType())),
    ]
)


def shingle_set(text: str, words: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, words))


def _sets(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> DataFrame:
    def make():
        def columns(batch: pa.RecordBatch) -> list:
            names, sizes, found = [], [], []
            for text in texts_of(batch, text_col):
                shingles = shingle_set(text, words)
                names.append(xxhash.xxh3_128_hexdigest(shingles.tobytes()))
                sizes.append(len(shingles))
                found.append(band_hashes(signature(shingles, bands * rows), bands, rows))
            ids = batch.column(batch.schema.get_field_index(id_col)).cast(pa.int64())
            flat = pa.array(np.concatenate(found), pa.int64())
            offsets = pa.array(np.arange(len(found) + 1) * bands, pa.int32())
            hashes = batch.column(batch.schema.get_field_index("_hash"))
            return [ids, hashes, pa.array(names), pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(offsets, flat)]

        return columns

    return map_rows(docs.select(id_col, text_col, F.xxhash64(text_col).alias("_hash")), SETS, make)


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of each set on the left with each on the right, by matrix products."""
    out = np.zeros((len(left), len(right)), np.float32)
    if not left or not right:
        return out
    a, b = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(a, b)
    ra, rb = (np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (left, right))
    ca, cb = np.searchsorted(both, a), np.searchsorted(both, b)
    if not len(both):
        return out
    ina, inb = (both[np.minimum(c, len(both) - 1)] == x for c, x in ((ca, a), (cb, b)))
    ra, ca, rb, cb = ra[ina], ca[ina], rb[inb], cb[inb]
    for at in range(0, len(both), COLUMNS):
        width = min(COLUMNS, len(both) - at)
        x, y = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        here = (ca >= at) & (ca < at + width)
        x[ra[here], ca[here] - at] = 1
        here = (cb >= at) & (cb < at + width)
        y[rb[here], cb[here] - at] = 1
        out += x @ y.T
    return out


def similarities(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    shared = shared_counts(left, right).astype(np.float64)
    na, nb = (np.array([len(x) for x in s], np.float64) for s in (left, right))
    return shared / np.maximum(na[:, None] + nb[None, :] - shared, 1)


def smallest_linked(ids: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """The smallest id that each one is connected with through the symmetric matrix ``linked``."""
    low = ids.copy()
    top = np.iinfo(np.int64).max
    while True:
        near = np.minimum(low, np.where(linked, low[None, :], top).min(axis=1))
        if (near == low).all():
            return low
        low = near


PAIRS = T.StructType(
    [T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("similarity", T.DoubleType())]
)
LINKS = T.StructType(
    [
        T.StructField("_set", T.StringType()),
        T.StructField("node", T.LongType()),
        T.StructField("low", T.LongType()),
        T.StructField("links", T.LongType()),
    ]
)


def _verify(threshold: float, words: int, pairs: bool):
    def run(table: pa.Table) -> pa.Table:
        i, j = table.column("_i")[0].as_py(), table.column("_j")[0].as_py()
        nodes = table.column("_node").to_numpy()
        copies = table.column("_copies").to_numpy()
        block = table.column("_block").to_numpy()
        sets = [shingle_set(t or "", words) for t in table.column("_text").to_pylist()]
        rows, cols = np.flatnonzero(block == i), np.flatnonzero(block == j)
        found = similarities([sets[x] for x in rows], [sets[x] for x in cols]) >= threshold
        if i == j:
            np.fill_diagonal(found, False)
        if pairs:
            x, y = np.nonzero(found)
            a, b = nodes[rows[x]], nodes[cols[y]]
            keep = (a < b) if i == j else (a != b)
            x, y, a, b = x[keep], y[keep], a[keep], b[keep]
            values = [
                float(similarities([sets[rows[p]]], [sets[cols[q]]])[0, 0]) for p, q in zip(x, y, strict=True)
            ]
            out = [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(values, pa.float64())]
            return pa.Table.from_arrays(out, names=PAIRS.fieldNames())
        linked = np.zeros((len(nodes), len(nodes)), bool)
        linked[np.ix_(rows, cols)] = found
        linked |= linked.T
        keep = linked.any(axis=1)
        low = smallest_linked(nodes, linked)
        links = linked @ copies
        names = table.column("_set").combine_chunks().filter(pa.array(keep))
        out = [names, pa.array(nodes[keep]), pa.array(low[keep]), pa.array(links[keep].astype(np.int64))]
        return pa.Table.from_arrays(out, names=LINKS.fieldNames())

    return run


def star_edges(edges: DataFrame, node: str, to: str) -> DataFrame:
    """(a, b): edges that connect what (``node``, ``to``) connect, about one for each node.

    Each node is held by the smallest that it leads to, and so are the others that it leads to. These are few and
    the same for many nodes (leads of buckets, smallest ids of blocks), so that a large group gives
    one edge a member instead of one for each of its members and bands or blocks.
    """
    held = edges.groupBy(node).agg(F.collect_set(to).alias("_to"))
    others = F.explode(F.array_append("_to", F.col(node))).alias("b")
    return held.select(F.array_min("_to").alias("a"), others).where("a <> b").distinct()


class _Join:
    """The steps up to verified links, shared by ``jaccard_join`` and ``jaccard_pairs``."""

    def __init__(self, docs, threshold, words, recall, id_col, text_col) -> None:
        self.docs, self.threshold, self.words = docs, threshold, words
        self.id_col, self.text_col = id_col, text_col
        self.scratch = Scratch(docs.sparkSession, "jaccard")
        bands, rows = choose_bands(threshold, recall)
        self.sets = self.scratch.keep(_sets(docs, id_col, text_col, words, bands, rows), "sets")
        self.reps = self.scratch.keep(
            self.sets.where(F.col("_doc").isNotNull())
            .groupBy("_set")
            .agg(
                F.min(F.struct("_doc", "_hash")).alias("_row"),
                F.count("*").alias("_copies"),
                F.first("_n").alias("_n"),
                F.first("_bands").alias("_bands"),  # equal sets have equal bands
            )
            # The id may stand for several sets; _hash tells which of its texts has this one.
            .select(
                "_set",
                F.xxhash64("_set").alias("_key"),
                F.col("_row._doc").alias("_node"),
                F.col("_row._hash").alias("_hash"),
                "_copies",
                "_n",
                "_bands",
            ),
            "representatives",
        )

    def candidates(self) -> DataFrame:
        """(_key, _group): representatives that share a band, directly or through others."""
        banded = self.reps.where("_n > 0").select("_node", "_key", F.explode("_bands").alias("_band"))
        buckets = (
            banded.groupBy("_band")
            .agg(F.min(F.struct("_node", "_key")).alias("_first"), F.count("*").alias("_held"))
            .where("_held > 1")
            .select("_band", F.col("_first._key").alias("_lead"))
        )
        # Written, so that each side of the join has an exchange of its own and a hot band can be split.
        buckets = self.scratch.keep(buckets, "buckets")
        # To the bucket's first member only: a bucket of n rows gives n - 1 edges.
        edges = star_edges(banded.join(buckets, "_band"), "_key", "_lead")
        found = components(edges, self.scratch, "candidates")
        return found.select(F.col("node").alias("_key"), F.col("component").alias("_group"))

    def verified(self, pairs: bool) -> DataFrame:
        members = self.scratch.keep(
            self.candidates().join(self.reps.drop("_bands"), "_key"), "members"
        )
        rows = F.least(F.lit(BLOCK_ROWS), F.greatest(F.lit(LEAST_ROWS), F.sqrt(F.count("*"))))
        sizes = members.groupBy("_group").agg(
            F.ceil(F.greatest(F.sum("_n") / BLOCK_SHINGLES, F.count("*") / rows)).cast("int").alias("_blocks")
        )
        placed = (
            members.join(sizes, "_group")
            .withColumn("_block", F.pmod(F.xxhash64("_key"), F.col("_blocks")).cast("int"))
            .drop("_n")
        )
        text = F.col(self.text_col)
        texts = self.docs.select(
            F.col(self.id_col).cast("bigint").alias("_node"), F.xxhash64(text).alias("_hash"), text.alias("_text")
        )
        # One text for each representative: repeated rows go before the shuffle.
        texts = texts.where("_node is not null").dropDuplicates(["_node", "_hash"])
        other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
        # Candidates grow with the texts, so their side is never broadcast.
        dealt = (
            placed.hint("merge").join(texts, ["_node", "_hash"])
            .withColumn("_other", other)
            .withColumn("_i", F.least("_block", "_other"))
            .withColumn("_j", F.greatest("_block", "_other"))
            .select("_group", "_i", "_j", "_block", "_set", "_node", "_copies", "_text")
        )
        check = _verify(self.threshold, self.words, pairs)
        return dealt.groupBy("_group", "_i", "_j").applyInArrow(check, PAIRS if pairs else LINKS)


    def of_one_id(self) -> DataFrame:
        """(a, b): ids that hold several sets, each with the representatives of these."""
        held = self.sets.where("_doc is not null").select("_doc", "_set", F.xxhash64("_set").alias("_key"))
        several = held.groupBy("_doc").agg(F.min("_key").alias("_low"), F.max("_key").alias("_high"))
        several = several.where("_low <> _high").select("_doc")
        return (
            held.join(several, "_doc", "left_semi")
            .select("_doc", "_set")
            .distinct()
            .join(self.reps.select("_set", "_node"), "_set")
            .select(F.col("_doc").alias("a"), F.col("_node").alias("b"))
        )


def jaccard_pairs(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    words: int = WORDS,
    recall: float = RECALL,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(a, b, similarity): every pair of representatives found at ``threshold`` or more, a < b.

    The representative of equal shingle sets is their smallest id. Nulls, empty
    and short texts and repeated ids as in ``jaccard_join``.
    """
    join = _Join(docs, threshold, words, recall, id_col, text_col)
    return join.verified(pairs=True).distinct()


def jaccard_join(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    words: int = WORDS,
    recall: float = RECALL,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, class_id, n_links), one row for each row of ``docs``.

    Two documents are linked if the Jaccard similarity of their sets of
    ``words``-word shingles is ``threshold`` or more. n_links counts a document's
    linked documents, copies and repeated rows included; class_id is the smallest id that links lead to.

    Equal sets are one representative with a count. Bands and rows are chosen so that a pair at the
    threshold shares a band with probability ``recall``. Band
    buckets give groups of candidates, held together by edges to each bucket's
    first member. A group is verified in full: every two of its documents are compared by their whole sets, in
    blocks beyond a size, and a task gives out one row for each
    document with its count and its smallest partner, never the pairs.

    A null or empty text has no shingles: all such are equal to each other and to
    nothing else. A text of fewer words is one shingle. Rows of one id share a
    class. Rows without id are no partners and get the class of an equal set, else null, and 0
    links. An empty table gives no rows. Columns besides id and text are not used.
    """
    join = _Join(docs, threshold, words, recall, id_col, text_col)
    links = join.scratch.keep(join.verified(pairs=False), "links")
    edges = star_edges(links, "node", "low").unionByName(join.of_one_id())
    classes = components(edges, join.scratch, "classes").select(F.col("node").alias("_node"), "component")
    counts = links.groupBy("_set").agg(F.sum("links").alias("_links"))
    reps = (
        join.reps.select("_set", "_node", "_copies")
        .join(classes, "_node", "left")
        .join(counts, "_set", "left")
        .select(
            "_set",
            F.coalesce("component", "_node").alias("class_id"),
            (F.coalesce("_links", F.lit(0)) + F.col("_copies") - 1).alias("n_links"),
        )
    )
    return (
        join.sets.select("_doc", "_set")
        .join(reps, "_set", "left")
        .select(
            F.col("_doc").alias(id_col),
            "class_id",
            F.when(F.col("_doc").isNull(), 0).otherwise(F.col("n_links")).cast("bigint").alias("n_links"),
        )
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class: that with the class's smallest id.

    Rows without id stay, and repeated rows of the id that stays stay too.
    """
    joined = jaccard_join(docs, id_col=id_col, text_col=text_col, **options)
    gone = joined.where(F.col("class_id") != F.col(id_col)).select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, F.col(id_col) == F.col("_gone"), "left_anti")
