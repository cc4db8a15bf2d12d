"""N-gram Jaccard join by grouped prefixes.

1. A sketch of fixed size counts every shingle of every document; it only orders shingles, rare ones first.
2. Each document's set is put in that order. Two sets with enough overlap share a shingle of their prefixes.
   Documents with the same size and prefix form one group; equal sets count once.
3. Groups are posted under their prefix shingles; size and position of a shared shingle filter group pairs.
4. First, each list of groups is chained and tied to its first group, a number of pairs in proportion to the list.
   These are verified and components formed. Long lists that still hold many components (near copies that differ
   in other places each) are shuffled, each member meets its next neighbours, and components are formed again.
   Only then are the remaining pairs of a list made, and only between members of different components, so a large
   group of near copies never yields all of its pairs.
   Parity sketches drop pairs whose sets certainly differ in too many shingles.
5. Every link stems from an exact comparison of two whole sets.

``near_components`` gives the classes alone and so may skip pairs within a component; ``near_links`` gives every link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import bounded_batches, cut, node_id, real_id, stash, text_of
from millrace.llm.components import components
from millrace.llm.shingles import shingle_set

#: Counters of the sketch: four per document, between 2**16 and 2**22 (16 MB); it decides an order, no result.
LEAST_BITS, MOST_BITS, BLOCK_BITS = 16, 22, 12
#: Lists of more groups are chained in slots of about this size, and the slots' first groups among each other.
SLOT = 4096
#: Where all pairs of a list are made, it is cut into blocks of about so many groups.
BLOCK = 512
#: Lists with more members outside their commonest component are shuffled before their remaining pairs are made, and
#: each member meets so many of the next ones.
LONG_MIXED, NEIGHBOURS = 32, 2
#: A set's parity sketch: for each of 64 * PARITY_LONGS cells, whether it holds an odd number of the set's shingles.
PARITY_LONGS = 8
#: Cells of the filter that tells which texts verification needs; other texts may pass, none that is needed fails.
NEED_CELLS = 1 << 20


@dataclass(frozen=True)
class Params:
    #: Words in a shingle.
    width: int = 5
    #: Two sets link when 100 * intersection >= percent * union.
    percent: int = 80


def _texts(column: pa.Array) -> Iterator[bytes]:
    for x in column.cast(pa.large_binary()):
        yield x.as_py() or b""


def count_sketch(docs: DataFrame, p: Params, bits: int) -> np.ndarray:
    """Counts of all documents' shingles by the low bits of their hash, summed over tasks block by block."""
    block = 1 << min(BLOCK_BITS, bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting, held = np.zeros(1 << bits, np.int64), [], 0
        mask = np.uint64((1 << bits) - 1)
        for batch in batches:
            for text in _texts(batch.column(0)):
                waiting.append((shingle_set(text, p.width) & mask).astype(np.int64))
                held += len(waiting[-1])
                if held > 1 << 21:
                    total += np.bincount(np.concatenate(waiting), minlength=1 << bits)
                    waiting, held = [], 0
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=1 << bits)
        rows = np.minimum(total, 2**31 - 1).astype(np.int32).reshape(-1, block)
        at = np.flatnonzero(rows.any(axis=1))
        for part in np.array_split(at, max(1, len(at) // 64)):
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([rows[i].tobytes() for i in part], pa.binary())], ["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, name = np.zeros(block, np.int64), None
        for batch in batches:
            for at, counts in zip(batch.column(0), batch.column(1), strict=True):
                name, total = at.as_py(), total + np.frombuffer(counts.as_py(), np.int32)
        if name is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([np.minimum(total, 2**31 - 1).astype(np.int32).tobytes()], pa.binary())], ["block", "counts"])

    add.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    schema = "block long, counts binary"
    sums = docs.select("text").mapInArrow(count, schema).groupBy("block").applyInArrow(add, schema).toArrow()
    out = np.zeros((1 << bits, 1), np.int32).reshape(-1, block)
    for at, counts in zip(sums.column("block").to_pylist(), sums.column("counts").to_pylist(), strict=True):
        out[at] = np.frombuffer(counts, np.int32)
    return out.reshape(-1)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def heads(docs: DataFrame, shared: Broadcast, p: Params) -> DataFrame:
    """(doc_id, n, s1, s2, pkey, parity, prefix): size, digest of the set, hash of size and prefix, parity sketch, the prefix itself."""
    names = [f"p{i}" for i in range(PARITY_LONGS)]

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        mask = np.uint64(len(counts) - 1)
        for batch in batches:
            n, s1, s2, pkey, prefix, parity = [], [], [], [], [], []
            for text in _texts(batch.column(1)):
                tokens = shingle_set(text, p.width)
                size = len(tokens)
                # by count, then hash: a stable sort of sorted hashes
                first = tokens[np.argsort(counts[tokens & mask], kind="stable")[: prefix_length(size, p.percent)]] if size else tokens
                whole = np.frombuffer(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest(), np.int64)
                n.append(size)
                s1.append(whole[0])
                s2.append(whole[1])
                pkey.append(np.frombuffer(hashlib.blake2b(first.tobytes() + size.to_bytes(8, "little"), digest_size=8).digest(), np.int64)[0])
                prefix.append(first.astype(np.int64))
                parity.append(parity_sketch(tokens))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in prefix])]).astype(np.int32))
            values = pa.array(np.concatenate([np.zeros(0, np.int64), *prefix]))
            columns = [batch.column(0), *(pa.array(np.array(x, np.int64)) for x in (n, s1, s2, pkey)), pa.ListArray.from_arrays(offsets, values)]
            cells = np.array(parity, np.int64).reshape(-1, PARITY_LONGS)
            columns.append(pa.StructArray.from_arrays([pa.array(cells[:, i]) for i in range(PARITY_LONGS)], names))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "s1", "s2", "pkey", "prefix", "parity"])

    return docs.select("doc_id", "text").mapInArrow(head, f"doc_id long, n long, s1 long, s2 long, pkey long, prefix array<long>, parity struct<{', '.join(f'{x}: long' for x in names)}>")


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    bits = 64 * PARITY_LONGS
    odd = np.bincount((tokens >> np.uint64(32)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def may_agree(p: Params, n1: Column, one: Column, n2: Column, two: Column) -> Column:
    """Two sets differ in at least as many shingles as their parity sketches in cells; true where a sketch is null."""
    differ = sum((F.bit_count(one[f"p{i}"].bitwiseXOR(two[f"p{i}"])) for i in range(1, PARITY_LONGS)), F.bit_count(one["p0"].bitwiseXOR(two["p0"])))
    return F.coalesce((100 + p.percent) * differ <= (100 - p.percent) * (n1 + n2), F.lit(True))


def may_link(p: Params, n1: Column, p1: Column, n2: Column, p2: Column) -> Column:
    """Sizes and places (from 0) of a shared shingle leave room for enough overlap."""
    left = F.least(n1 - p1, n2 - p2)
    return (100 * F.least(n1, n2) >= p.percent * F.greatest(n1, n2)) & ((100 + p.percent) * left >= p.percent * (n1 + n2))


def shared_postings(groups: DataFrame) -> DataFrame:
    """(token, gid, n, pos, held): the postings of shingles that several groups hold, with their number."""
    each = groups.select("gid", "n", F.posexplode("prefix").alias("pos", "token"))
    held = each.groupBy("token").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    return each.join(held, "token")


def first_pairs(postings: DataFrame, p: Params) -> DataFrame:
    """(a, b): each group of a list with its neighbour by size, and with the first group of its slot."""
    slot = F.pmod(F.xxhash64("gid"), F.ceil(F.col("held") / F.lit(float(SLOT)))).cast("long")
    rows = postings.withColumn("slot", slot)
    by_size = Window.partitionBy("token", "slot").orderBy("n", "gid")
    me = F.struct("gid", "n", "pos")
    rows = rows.select("token", "slot", "held", me.alias("me"), F.lag(me).over(by_size).alias("before"), F.first(me).over(by_size).alias("lead"))
    pairs = rows.select("me", F.explode(F.array("before", "lead")).alias("other"))
    leads = rows.filter(F.col("before").isNull() & (F.col("held") > SLOT))
    over = Window.partitionBy("token").orderBy("me.n", "me.gid")
    pairs = pairs.union(leads.select("me", F.lag("me").over(over).alias("other")))
    pairs = pairs.filter(
        F.col("other").isNotNull() & (F.col("me.gid") != F.col("other.gid"))
        & may_link(p, F.col("me.n"), F.col("me.pos"), F.col("other.n"), F.col("other.pos"))
    )
    return _ordered(pairs.select(F.col("me.gid").alias("a"), F.col("other.gid").alias("b")))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def mixed_lists(postings: DataFrame, members: DataFrame) -> DataFrame:
    """(token, gid, n, pos, component, rep, parity, common, outside): the lists that hold several components, whole.

    members: (rep, gid, n, parity, component). Members of one group and component are one row with its smallest rep,
    and with the parity sketch if it is the only one; common is the list's commonest component, outside the number of members that are not in it. A group is also a list of
    its own, as its members share all of their prefix.
    """
    parts = cut(members.groupBy("gid", "n", "component").agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("rep"), F.first("parity").alias("parity")))
    parts = parts.withColumn("parity", F.when(F.col("size") == 1, F.col("parity")))
    within = parts.select(
        F.xxhash64(F.lit("group"), F.col("gid")).alias("token"), "gid", "n", F.lit(0).cast("long").alias("pos"), "component", "size", "rep", "parity",
    )
    rows = (
        postings.select("token", "gid", F.col("pos").cast("long").alias("pos")).join(parts, "gid")
        .select("token", "gid", "n", "pos", "component", "size", "rep", "parity").union(within)
    )
    tally = rows.groupBy("token", "component").agg(F.sum("size").alias("size"))
    mixed = tally.groupBy("token").agg(
        F.count(F.lit(1)).alias("kinds"), F.max_by("component", F.struct("size", "component")).alias("common"),
        (F.sum("size") - F.max("size")).alias("outside"),
    ).filter("kinds > 1")
    return stash(rows.join(mixed.select("token", "common", "outside"), "token").drop("size"), "mixed-lists")


def spread_pairs(postings: DataFrame, members: DataFrame, p: Params) -> DataFrame:
    """(a, b): in long lists of many components, each member with its next neighbours in an order of its list's own."""
    rows = mixed_lists(postings, members).filter(F.col("outside") > LONG_MIXED)
    slot = F.pmod(F.xxhash64("gid"), F.ceil(F.col("outside") / F.lit(float(SLOT)))).cast("long")
    shuffled = Window.partitionBy("token", "slot").orderBy("turn", "rep")
    me = F.struct("rep", "n", "pos", "component", "parity")
    rows = rows.select("token", slot.alias("slot"), F.xxhash64("rep", "token").alias("turn"), "rep", me.alias("me"))
    ahead = F.array(*[F.lag("me", i).over(shuffled) for i in range(1, NEIGHBOURS + 1)])
    pairs = rows.select("me", ahead.alias("ahead")).select("me", F.explode("ahead").alias("other"))
    pairs = pairs.filter((F.col("me.component") != F.col("other.component")) & may_link(p, F.col("me.n"), F.col("me.pos"), F.col("other.n"), F.col("other.pos")))
    pairs = pairs.filter(may_agree(p, F.col("me.n"), F.col("me.parity"), F.col("other.n"), F.col("other.parity")))
    return _ordered(pairs.select(F.col("me.rep").alias("a"), F.col("other.rep").alias("b")))


def rest_pairs(postings: DataFrame, members: DataFrame, p: Params) -> DataFrame:
    """(a, b): members of different components whose groups share a prefix shingle and may link.

    members: (rep, gid, n, parity, component). A list is paired between the part outside its commonest component and all
    of it, within bands of size; lists of one component are left out before any pair is made.
    """
    rows = mixed_lists(postings, members)
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / p.percent)))).cast("long")
    right = rows.select(
        "token", band.alias("band"),
        F.struct("gid", "n", "pos", "component", "parity", (F.col("component") == F.col("common")).alias("in_common")).alias("r"),
    )
    left = rows.filter("component <> common").select(
        "token", F.explode(F.array(band - 1, band, band + 1)).alias("band"), F.struct("gid", "n", "pos", "component", "parity").alias("l"),
    )
    once = (
        F.col("r.in_common") | (F.col("l.gid") < F.col("r.gid"))
        | ((F.col("l.gid") == F.col("r.gid")) & (F.col("l.component") < F.col("r.component")))
    )
    pairs = left.join(right, ["token", "band"]).filter(
        (F.col("l.component") != F.col("r.component")) & once & may_link(p, F.col("l.n"), F.col("l.pos"), F.col("r.n"), F.col("r.pos"))
    )
    pairs = pairs.filter(may_agree(p, F.col("l.n"), F.col("l.parity"), F.col("r.n"), F.col("r.parity")))
    pairs = pairs.select(F.col("l.gid").alias("g1"), F.col("l.component").alias("c1"), F.col("r.gid").alias("g2"), F.col("r.component").alias("c2")).distinct()
    one, two = (
        members.select(
            F.col("gid").alias(f"g{i}"), F.col("component").alias(f"c{i}"), F.col("rep").alias(x), F.col("n").alias(f"n{i}"), F.col("parity").alias(f"parity{i}"),
        )
        for i, x in ((1, "a"), (2, "b"))
    )
    pairs = pairs.join(one, ["g1", "c1"]).join(two, ["g2", "c2"]).filter(may_agree(p, F.col("n1"), F.col("parity1"), F.col("n2"), F.col("parity2")))
    return _ordered(pairs.select("a", "b"))


def needed_texts(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, text) of the documents that pairs(a, b) name. Most others stop at a filter of fixed size; the few that
    pass it too find no pair."""
    need = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(NEED_CELLS))
    cells = need.select(F.pmod(F.xxhash64("id"), F.lit(NEED_CELLS)).alias("cell")).distinct().toArrow().column("cell").to_numpy()
    wanted = np.zeros(NEED_CELLS, bool)
    wanted[cells] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_cells = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(open_cells[batch.column(2).to_numpy()])).select([0, 1])

    texts = stash(docs.select(F.col("doc_id").alias("id"), "text", cell.alias("cell")).mapInArrow(pick, "id long, text string"), "texts")
    shared.destroy()
    return texts


def verified(pairs: DataFrame, docs: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b) whose whole sets overlap enough."""
    pairs = cut(pairs)
    texts = needed_texts(docs, pairs)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in batches:
            ok = []
            for a, one, two in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if a != last:
                    last, left = a, shingle_set(one.as_py().encode(), p.width)
                right = shingle_set(two.as_py().encode(), p.width)
                both = len(np.intersect1d(left, right, assume_unique=True))
                ok.append(100 * both >= p.percent * (len(left) + len(right) - both))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    rows = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("two")), "b")
    rows = rows.join(texts.select(F.col("id").alias("a"), F.col("text").alias("one")), "a")
    return rows.select("a", "b", "one", "two").mapInArrow(compare, "a long, b long")


def prepared(docs: DataFrame, id_col: str, text_col: str, p: Params) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """(doc_id, text), the heads of all rows, those that are not empty, the postings of groups and the distinct sets."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(node_id(id_col, text_col).alias("doc_id"), text_of(text_col).alias("text"))
    bits = min(MOST_BITS, max(LEAST_BITS, int(docs.count()).bit_length() + 2))
    sketch = docs.sparkSession.sparkContext.broadcast(count_sketch(docs, p, bits))
    rows = stash(heads(docs, sketch, p), "heads")
    sketch.destroy()

    some = rows.filter("n > 0")
    groups = some.groupBy("n", "pkey").agg(F.min("doc_id").alias("gid"), F.first("prefix").alias("prefix"))
    postings = stash(shared_postings(groups), "postings")
    reps = some.groupBy("n", "pkey", "s1", "s2").agg(F.min("doc_id").alias("rep"), F.first("parity").alias("parity"))
    reps = reps.groupBy("n", "pkey").agg(F.min("rep").alias("gid")).join(reps, ["n", "pkey"])
    return docs, rows, some, postings, stash(reps.select("rep", "gid", "n", "pkey", "s1", "s2", "parity"), "reps")


def all_pairs(postings: DataFrame, reps: DataFrame, p: Params) -> DataFrame:
    """(a, b): all pairs of distinct sets whose groups share a prefix shingle and may link, whatever their components.

    A list is cut into blocks of about BLOCK groups; each two blocks of a list and band of size are one key of the join.
    """
    blocks = F.ceil(F.col("held") / F.lit(float(BLOCK))).cast("long")
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / p.percent)))).cast("long")
    rows = postings.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("gid"), F.col("blocks"))).withColumn("band", band)
    me = F.struct("gid", "n", "pos")
    left = rows.withColumn("hi", F.explode(F.sequence("block", F.col("blocks") - 1))).select(
        "token", F.col("block").alias("lo"), "hi", F.explode(F.array(*[F.col("band") + i for i in (-1, 0, 1)])).alias("band"), me.alias("l"),
    )
    right = rows.withColumn("lo", F.explode(F.sequence(F.lit(0).cast("long"), "block"))).select("token", "lo", F.col("block").alias("hi"), "band", me.alias("r"))
    met = left.join(right, ["token", "lo", "hi", "band"]).filter((F.col("lo") < F.col("hi")) | (F.col("l.gid") < F.col("r.gid")))
    met = met.filter(may_link(p, F.col("l.n"), F.col("l.pos"), F.col("r.n"), F.col("r.pos")))
    met = _ordered(met.select(F.col("l.gid").alias("a"), F.col("r.gid").alias("b")))
    one, two = (
        reps.select(F.col("gid").alias(f"g{i}"), F.col("rep").alias(x), F.col("n").alias(f"n{i}"), F.col("parity").alias(f"parity{i}"))
        for i, x in ((1, "a"), (2, "b"))
    )
    across = met.select(F.col("a").alias("g1"), F.col("b").alias("g2")).join(one, "g1").join(two, "g2")
    within = one.join(two, (F.col("g1") == F.col("g2")) & (F.col("a") < F.col("b")))
    columns = ["a", "b", "n1", "parity1", "n2", "parity2"]
    pairs = across.select(*columns).union(within.select(*columns)).filter(may_agree(p, F.col("n1"), F.col("parity1"), F.col("n2"), F.col("parity2")))
    return _ordered(pairs.filter("a <> b").select("a", "b"))


def near_links(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", params: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """Every link: (a, b), a < b, between the representatives of distinct sets, and (doc_id, n_shingles, rep_id, n_links).

    Rows of equal sets are one class, its representative the smallest id in it; each two of them link too, and so does
    each with all rows of a linked class. n_links counts these other documents, 0 for empty sets. No pair is left out
    for its component; the output grows with the square of a group of near copies. Rows with the same id and equal
    sets are one document; null ids are read as in ``near_components`` and come back as null.
    """
    p = params
    docs, rows, some, postings, reps = prepared(docs, id_col, text_col, p)
    links = stash(verified(all_pairs(postings, reps, p), docs, p).distinct(), "links")
    key = ["n", "pkey", "s1", "s2"]
    classes = some.groupBy(*key).agg(F.min("doc_id").alias("rep_id"), F.countDistinct("doc_id").alias("size"))
    both = links.union(links.select("b", "a")).toDF("rep_id", "other")
    far = both.join(classes.groupBy(F.col("rep_id").alias("other")).agg(F.sum("size").alias("size")), "other").groupBy("rep_id").agg(F.sum("size").alias("far"))
    counted = classes.join(far, "rep_id", "left").select(*key, "rep_id", (F.col("size") - 1 + F.coalesce("far", F.lit(0))).cast("long").alias("n_links"))
    out = rows.select("doc_id", *key).join(counted, key, "left")
    members = out.select(
        real_id("doc_id").alias("doc_id"), F.col("n").alias("n_shingles"), real_id(F.coalesce("rep_id", "doc_id")).alias("rep_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )
    return links.select(real_id("a").alias("a"), real_id("b").alias("b")), members


def near_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", params: Params = Params(), keep_node: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest id reachable by links, itself included), and
    kept: whether the row's document is that one. ``keep_node`` adds node, the id by which rows are told apart (see
    ``node_id``).

    A document's set holds the hashes (64 bits) of its distinct shingles of ``width`` words, A-Z lowered; with fewer
    words the whole sequence counts as one; without words the set is empty and links with nothing. Null text counts
    as empty. Rows with the same id are one document for links (each with its own set). A row without an id is a
    document of its own (rows without an id and with equal texts are one) that sorts before all others; its id, and
    the component_id where it is the smallest, are null. An empty table gives no rows; other columns are ignored;
    texts are read whole. Equal sets are joined before any pair is made.
    """
    p = params
    docs, rows, some, postings, reps = prepared(docs, id_col, text_col, p)

    inside = reps.filter("rep <> gid").select(F.col("gid").alias("a"), F.col("rep").alias("b"))
    open_groups = postings.select("gid").union(inside.select("a")).distinct()
    live = cut(reps.join(open_groups, "gid", "left_semi").select("rep", "gid", "n", "parity"))

    def placed(links: DataFrame) -> DataFrame:
        """The live members with their component by the links."""
        return cut(live.join(components(links).withColumnRenamed("id", "rep"), "rep", "left").select("rep", "gid", "n", "parity", F.coalesce("component", "rep").alias("component")))

    links = cut(verified(_ordered(inside.union(first_pairs(postings, p))), docs, p))
    members = placed(links)
    spread = cut(spread_pairs(postings, members, p))
    if spread.head(1):
        links = cut(links.union(verified(spread, docs, p)))
        members = placed(links)
    more = cut(verified(rest_pairs(postings, members, p), docs, p))
    equal = (
        some.join(reps.select("n", "pkey", "s1", "s2", "rep"), ["n", "pkey", "s1", "s2"]).filter("doc_id <> rep")
        .select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    )
    whole = components(links.union(more).union(equal))
    out = rows.select("doc_id", "n").join(whole.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    node = [F.col("doc_id").alias("node")] if keep_node else []
    return out.select(
        real_id("doc_id").alias("doc_id"), F.col("n").alias("n_shingles"), real_id(component).alias("component_id"),
        (F.col("doc_id") == component).alias("kept"), *node,
    )
