"""Exact self-join of documents by the Jaccard similarity of their word shingles.

Links are found by vertical partitioning: the n-gram space is cut into fragments, a
pair's overlap is counted in each fragment apart, and the counts are summed per pair.
Which pairs are counted follows from the global order of n-grams, rarest first:

1. Documents with equal shingle sets collapse to one node.
2. A sketch counts all shingles of the corpus. The order by (sketched count, hash) is the
   same everywhere, which is all that correctness asks of it; the counts only keep common
   passages out of the prefixes.
3. Two sets that link share a shingle within their first ``n - ceil(0.8 n) + 1`` ones, and
   at the first such shingle enough others are still to come. So only prefixes are dealt
   out, by shingle; those of one node alone go at once.
4. Each node is first checked against one neighbour, the one it shares most prefix
   shingles with. That joins nearly all of a group of near copies with as many
   checks as it has members.
5. All further candidate pairs are those of *different* components. First the likeliest
   pair of each two components is checked, which joins what step 4 left in parts, and then
   each pair whose components are still different. Pairs within a component are never made,
   and a group of copies never unfolds into its pairs.

No list is held by one task: lists of a shingle meet in aggregates that are begun before
the shuffle, or in joins on salted keys, and a node with many partners is copied to the tasks
among which those are dealt.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import cut, scratch, stored
from loomline.llm.graphs import connected_components

SKETCH_BITS, BLOCK_BITS = 18, 12
FRAGMENTS = 8
#: Up to so many rows (of some 50 bytes) the nodes to be checked are broadcast to the scan of the texts; beyond, both sides are shuffled. Either way gives the same rows.
BROADCAST_ROWS = 500_000
#: A node's partners are dealt among tasks in lots of about so many, and the nodes of one shingle's list likewise.
PARTNERS, LIST = 64, 1000
#: A scan forgets which sets it has given beyond so many; repeats are dropped later in any case.
SEEN = 1_000_000
#: Bytes of shingles that a task puts into one batch.
BATCH_BYTES = 4_000_000
MULTIPLIER, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * MULTIPLIER
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's k-word shingles, A-Z lowered; of all its words if they are fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(k, len(h))
    rolled = np.full(len(h) - width + 1, np.uint64(width))
    for i in range(width):
        rolled = rolled * MULTIPLIER + h[i : len(h) - width + 1 + i]
    return np.unique(mixed(rolled))


def set_node(s: np.ndarray) -> int:
    """A 64-bit id of a shingle set, as a signed long; sets of equal ids are taken as equal."""
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def cells(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def needed_overlap(n1: Column, n2: Column, percent: int) -> Column:
    """Least intersection for 100 * intersection >= percent * union."""
    return F.ceil((n1 + n2) * percent / F.lit(100 + percent))


def digest_and_sketch(docs: DataFrame, k: int) -> tuple[DataFrame, np.ndarray]:
    """((doc_id, text_hash, node, n) per document, counts of shingles per sketch cell over all documents)."""
    size = 1 << BLOCK_BITS

    def scan(batches):
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        names = ["doc_id", "text_hash", "node", "n", "block", "counts"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        for batch in batches:
            nodes, sizes = [], []
            for text in batch.column("text"):
                s = shingles(text.as_py(), k)
                np.add.at(counts, cells(s), 1)
                nodes.append(set_node(s) if len(s) else None)
                sizes.append(len(s))
            nothing = pa.nulls(len(nodes))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(nodes, kinds[2]), pa.array(sizes, kinds[3]), nothing.cast(kinds[4]), nothing.cast(kinds[5])], names)
        full = [b for b in range(len(counts) // size) if counts[b * size : (b + 1) * size].any()]
        nothing = pa.nulls(len(full), pa.int64())
        yield pa.RecordBatch.from_arrays([nothing, nothing, nothing, nothing, pa.array(full, kinds[4]), pa.array([counts[b * size : (b + 1) * size].tobytes() for b in full], kinds[5])], names)

    def add_up(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, c in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[b] = sums.get(b, 0) + np.frombuffer(c, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["block", "counts"])

    path = scratch(docs.sparkSession, "digests")
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash"))
    rows.mapInArrow(scan, "doc_id long, text_hash long, node long, n long, block int, counts binary").write.parquet(path)
    both = docs.sparkSession.read.parquet(path)
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    summed = both.where("block is not null").select("block", "counts").repartition("block").mapInArrow(add_up, "block int, counts binary")
    for r in summed.collect():  # a fixed 2 MB in all
        counts[r["block"] * size : (r["block"] + 1) * size] = np.frombuffer(r["counts"], np.int64)
    return both.where("block is null").select("doc_id", "text_hash", "node", "n"), counts


def prefix_postings(docs: DataFrame, counts: np.ndarray, k: int, percent: int) -> DataFrame:
    """(shingle, node, n, pos) for the rarest shingles of each set; a task gives a set once."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def scan(batches):
        rank, seen = shared.value, set()
        for batch in batches:
            out, nodes, sizes = [], [], []
            for text in batch.column("text"):
                s = shingles(text.as_py(), k)
                if not len(s) or (node := set_node(s)) in seen:
                    continue
                if len(seen) < SEEN:
                    seen.add(node)
                prefix = len(s) - -(-percent * len(s) // 100) + 1
                order = np.lexsort((s, rank[cells(s)]))[:prefix]
                out.append(s[order])
                nodes.append(node)
                sizes.append(len(s))
            if out:
                lengths = np.fromiter(map(len, out), np.int64, len(out))
                at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                columns = [np.concatenate(out).view(np.int64), np.repeat(np.array(nodes, np.int64), lengths), np.repeat(np.array(sizes, np.int64), lengths) << 32 | at]
                for a in range(0, len(at), 200_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[a : a + 200_000]) for c in columns], ["shingle", "node", "n_pos"])

    return docs.select("text").mapInArrow(scan, "shingle long, node long, n_pos long")


def possible(n1: Column, p1: Column, n2: Column, p2: Column, percent: int) -> Column:
    """Whether sizes, and what is left after a shared shingle at these positions, allow a link."""
    fits = (F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent) & (F.least(n1 - p1, n2 - p2) >= needed_overlap(n1, n2, percent))
    return fits


def size_band(n: Column) -> Column:
    """Sets that can link at 0.8 or more are of one band or of neighbouring ones."""
    return F.floor(F.log(n) / F.lit(float(np.log(1.25))) + 1e-9).cast("int")


def shared_postings(docs: DataFrame, counts: np.ndarray, k: int, percent: int) -> DataFrame:
    """(shingle, node, n, pos, band) of the shingles that two nodes or more have in their prefixes, each once."""
    prefixes = stored(prefix_postings(docs, counts, k, percent), "prefixes")
    ends = prefixes.groupBy("shingle").agg(F.min("node").alias("_least"), F.max("node").alias("_most"))
    several = stored(ends.where("_least <> _most").select("shingle"), "shared")
    # Tasks of the scan repeat the sets that they have in common.
    shared = prefixes.join(several, "shingle").distinct()
    n, pos = F.shiftright("n_pos", 32), F.col("n_pos").bitwiseAND(F.lit((1 << 32) - 1))
    return stored(shared.select("shingle", "node", n.alias("n"), pos.alias("pos"), size_band(n).alias("band")), "postings")


def prefix_size(n: Column, percent: int) -> Column:
    """How many of a set's rarest shingles were dealt out."""
    return n - F.ceil(n * percent / F.lit(100)) + 1


def sharing_enough(pairs: DataFrame, postings: DataFrame, percent: int) -> DataFrame:
    """The pairs whose prefixes share so many shingles that the rest can make up for what is missing.

    Shingles up to the end of the prefix that ends first are in both prefixes if common; of
    that set, only the part behind its prefix can be common beyond them.
    """
    at = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    sets = postings.join(at, "node", "left_semi").groupBy("node").agg(F.collect_list("shingle").alias("s"), F.first("n").alias("n"))
    sets = stored(sets, "prefixes")  # a prefix is as bounded as a document
    u, v = sets.toDF("u", "su", "nu"), sets.toDF("v", "sv", "nv")
    shared = F.size(F.array_intersect("su", "sv"))
    behind = F.greatest(F.col("nu") - prefix_size(F.col("nu"), percent), F.col("nv") - prefix_size(F.col("nv"), percent))
    return pairs.join(u, "u").join(v, "v").where(shared + behind >= needed_overlap(F.col("nu"), F.col("nv"), percent)).select("u", "v")


def dealt_roles(pairs: DataFrame) -> DataFrame:
    """(node, part, places): to which (key, salt) each node of the pairs goes.

    The end with more partners is a pair's key. Its partners are dealt among salts, and the
    key itself goes to each of them. A node with many places has several rows.
    """
    degree = pairs.select(F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("d"))
    both = pairs.join(degree.toDF("u", "du"), "u").join(degree.toDF("v", "dv"), "v")
    key, other = F.struct(F.col("du").alias("d"), F.col("u").alias("id")), F.struct(F.col("dv").alias("d"), F.col("v").alias("id"))
    turned = both.select(F.greatest(key, other).alias("k"), F.least(key, other).alias("o"))
    salts = F.ceil(F.col("k.d") / PARTNERS)
    placed = turned.select(F.col("o.id").alias("node"), F.col("o.d").alias("d"), F.col("k.id").alias("key"), F.pmod(F.xxhash64("o.id"), salts).alias("salt"), F.col("k.d").alias("_kd"))
    placed = stored(placed, "placed")
    keys = placed.select(F.col("key").alias("node"), F.col("_kd").alias("d"), "key", "salt").distinct()
    roles = placed.select("node", "d", "key", "salt").unionByName(keys)
    part = F.pmod(F.xxhash64("key", "salt"), F.ceil(F.col("d") / PARTNERS)).alias("part")
    return roles.groupBy("node", part).agg(F.collect_list(F.struct("key", "salt")).alias("places"))


def check_pairs(docs: DataFrame, firsts: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the pairs (u, v) that link: overlaps counted fragment by fragment, summed per pair.

    ``firsts`` names one text of each node, by doc_id and hash. It is cut into fragments by shingle, which
    travel to the tasks of the node's pairs. A pair is given up once what its fragments
    have in common and what is left of them cannot reach the bound together.
    """
    wanted = stored(dealt_roles(pairs).join(firsts.select("node", "_id", "_hash"), "node"), "wanted")
    right = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS and pairs.count() <= BROADCAST_ROWS else wanted
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_text_hash"))
    # Either a bounded list of nodes goes to every scan, or texts and nodes meet by a shuffle.
    found = texts.join(right, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))).select("text", "node", "part", "places")
    names, kinds = ["key", "salt", "node", "n", "parts"], [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.binary())]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def fragments(batches):
        shift = np.uint64(64 - FRAGMENTS.bit_length() + 1)
        seen = set()
        for batch in batches:
            rows, held = [], 0
            for text, node, part, places in zip(batch.column("text"), *[batch.column(c).to_pylist() for c in ("node", "part", "places")], strict=True):
                if (node, part) in seen:
                    continue
                s = shingles(text.as_py(), k)
                if not len(s) or set_node(s) != node:
                    continue
                if len(seen) < SEEN:
                    seen.add((node, part))
                cuts = np.searchsorted(s >> shift, np.arange(FRAGMENTS + 1, dtype=np.uint64))
                parts = [s[cuts[f] : cuts[f + 1]].tobytes() for f in range(FRAGMENTS)]
                for place in places:
                    rows.append((place["key"], place["salt"], node, len(s), parts))
                    held += s.nbytes
                    if held >= BATCH_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
            if rows:
                yield batch_of(rows)

    def shared_of(n, parts, n_other, others) -> bool:
        need, shared, left, left_other = -(-percent * (n + n_other) // (100 + percent)), 0, n, n_other
        for a, b in zip(parts, others, strict=True):
            shared += len(np.intersect1d(a, b, assume_unique=True))
            left, left_other = left - len(a), left_other - len(b)
            if shared + min(left, left_other) < need:
                return False
        return True

    def count(batches):
        hub, last = None, None
        for batch in batches:
            out = []
            for i, (key, salt, node, n) in enumerate(zip(*[batch.column(c).to_pylist() for c in names[:4]], strict=True)):
                # Rows of one node can stand in several tasks of the scan; here they follow each other.
                if (key, salt, node) == last:
                    continue
                last = (key, salt, node)
                if node != key and (hub is None or hub[0] != (key, salt)):
                    continue
                parts = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("parts")[i].values]
                if node == key:
                    hub = ((key, salt), n, parts)
                elif shared_of(n, parts, hub[1], hub[2]):
                    out.append((key, node))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["u", "v"])

    cut_up = found.mapInArrow(fragments, "key long, salt long, node long, n long, parts array<binary>")
    # Within a (key, salt), the key's own parts come first and those of its partners stream past them.
    dealt = cut_up.repartition("key", "salt").sortWithinPartitions("key", "salt", F.col("node") != F.col("key"), "node")
    return dealt.mapInArrow(count, "u long, v long")


def first_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """For each node, the one of its lists' heads with which it shares most prefix shingles.

    A list's head is the node that has the shingle at the least position: a node with few
    rarer shingles of its own is what the others of a group of near copies vary. Where the
    head of the whole list cannot link, the head of the node's size band stands in.
    """
    by_band = postings.groupBy("shingle", "band").agg(F.min(F.struct("pos", "node", "n")).alias("near"))
    by_band = stored(by_band, "heads")
    heads = stored(by_band.join(by_band.groupBy("shingle").agg(F.min("near").alias("first")), "shingle"), "heads")

    def good(other: str) -> Column:
        o = F.col(other)
        return (o["node"] != F.col("node")) & possible(F.col("n"), F.col("pos"), o["n"], o["pos"], percent)

    before = F.when(good("first"), F.col("first.node")).when(good("near"), F.col("near.node"))
    votes = postings.join(heads, ["shingle", "band"]).select("node", before.alias("before")).where("before is not null")
    votes = votes.groupBy("node", "before").agg(F.count(F.lit(1)).alias("votes"))
    return votes.groupBy(F.col("node").alias("v")).agg(F.max_by("before", F.struct("votes", "before")).alias("u")).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def pairs_across(postings: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(u, v, lu, lv, votes): all candidate pairs whose nodes have different labels.

    In each shingle's list, nodes outside the commonest label are paired with all others;
    a pair of different labels has such a node. Lists of one label make nothing. A node
    meets only nodes of its size band and of the neighbouring ones, and long lists are salted.
    """
    named = postings.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    per_label = named.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("_c"))
    lists = per_label.groupBy("shingle").agg(F.max(F.struct("_c", "label"))["label"].alias("_top"), F.min("label").alias("_a"), F.max("label").alias("_b"), F.sum("_c").alias("_size"))
    several = stored(lists.where("_a <> _b").select("shingle", "_top", F.ceil(F.col("_size") / LIST).alias("salts")), "several")
    marked = stored(named.join(several, "shingle").select("shingle", "node", "n", "pos", "band", "label", (F.col("label") == F.col("_top")).alias("top"), "salts"), "lists")
    a = marked.where("not top").withColumn("salt", F.pmod(F.xxhash64("node"), "salts")).alias("a")
    b = marked.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).withColumn("band", F.explode(F.array(*[F.col("band") + i for i in (-1, 0, 1)]))).alias("b")
    meet = (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.band") == F.col("b.band")) & (F.col("a.salt") == F.col("b.salt"))
    apart = (F.col("a.label") != F.col("b.label")) & (F.col("b.top") | (F.col("a.node") < F.col("b.node")))
    fits = possible(F.col("a.n"), F.col("a.pos"), F.col("b.n"), F.col("b.pos"), percent)
    side = lambda x: F.struct(F.col(f"{x}.node").alias("node"), F.col(f"{x}.label").alias("label"))
    met = a.join(b, meet & apart & fits).select(F.least(side("a"), side("b")).alias("x"), F.greatest(side("a"), side("b")).alias("y"))
    return met.groupBy(F.col("x.node").alias("u"), F.col("y.node").alias("v"), F.col("x.label").alias("lu"), F.col("y.label").alias("lv")).agg(F.count(F.lit(1)).alias("votes"))


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) once nodes of labels that links (u, v, lu, lv) join have one label; nodes without a label are their own."""
    links = stored(links, "bridges")
    if links.isEmpty():
        return labels
    merged = connected_components(links.select(F.col("lu").alias("u"), F.col("lv").alias("v"))).toDF("_old", "_new")
    ends = links.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("lu").alias("label")), F.struct(F.col("v").alias("node"), F.col("lv").alias("label")))).alias("e")).select("e.*")
    known = labels.unionByName(ends).distinct()
    return stored(known.join(merged, known["label"] == merged["_old"], "left").select("node", F.coalesce("_new", "label").alias("label")), "labels")


def components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, text_hash, n, label, component_id) of every row; label is null for rows without shingles."""
    if percent < 80:
        raise ValueError("size bands are made for similarities of 80 percent or more")
    digests, counts = digest_and_sketch(docs, k)
    place = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("_p")
    firsts = digests.where("node is not null").groupBy("node").agg(place).select("node", F.col("_p.doc_id").alias("_id"), F.col("_p.text_hash").alias("_hash"))
    firsts = stored(firsts, "firsts")
    postings = shared_postings(docs, counts, k, percent)

    def linked(pairs: DataFrame) -> DataFrame:
        if pairs.isEmpty():
            return pairs.select("u", "v")
        likely = stored(sharing_enough(pairs.select("u", "v"), postings, percent), "pairs")
        return likely if likely.isEmpty() else stored(check_pairs(docs, firsts, likely, k, percent).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")), "links")

    labels = connected_components(linked(stored(first_pairs(postings, percent), "first")))
    across = stored(pairs_across(postings, labels, percent), "across")
    best = across.groupBy(F.least("lu", "lv").alias("_1"), F.greatest("lu", "lv").alias("_2")).agg(F.max_by(F.struct("u", "v"), F.struct("votes", "u", "v")).alias("p"))
    best = stored(best.select("p.u", "p.v"), "best")
    joined = linked(best)
    labels = relabelled(labels, across.join(joined, ["u", "v"]))
    left = across.join(best, ["u", "v"], "left_anti").drop("lu", "lv")
    left = left.join(labels.toDF("u", "_lu"), "u", "left").join(labels.toDF("v", "_lv"), "v", "left")
    left = left.select("u", "v", F.coalesce("_lu", "u").alias("lu"), F.coalesce("_lv", "v").alias("lv")).where("lu <> lv")
    left = stored(left, "left")
    labels = relabelled(labels, left.join(linked(left), ["u", "v"]))
    named = firsts.join(labels, "node", "left").select("node", "_id", F.coalesce("label", "node").alias("label"))
    least = stored(named.groupBy("label").agg(F.min("_id").alias("component_id")), "least")
    component = stored(named.select("node", "label").join(least, "label").select("node", "label", "component_id"), "components")
    out = digests.join(component, "node", "left")
    return out.select("doc_id", "text_hash", "n", "label", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def link_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    component_id is the smallest doc_id that links reach; rows of equal shingle sets link.
    A text without words, or null, has no shingles and its component is its own doc_id. Null
    doc_ids take part but are never a component_id unless all of a component's are null.
    Only doc_id and text are read; an empty table gives an empty result.
    """
    return components(docs, k, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one row left of each component; rows without shingles all stay.

    The row of the smallest doc_id stays, null last, and of equal ones that of the smallest
    text hash; of rows equal in both, one. All columns are kept.
    """
    rows = cut(components(docs, k, percent).where("label is not null"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    best = cut(rows.groupBy("label").agg(F.min(place).alias("_best")))
    judged = rows.join(best, "label").withColumn("_stays", (F.col("_best.text_hash") == F.col("text_hash")) & F.col("_best.doc_id").eqNullSafe(F.col("doc_id")))
    per_row = cut(judged.groupBy("doc_id", "text_hash").agg(F.bool_or("_stays").alias("_stays"), F.count(F.lit(1)).alias("_rows")))
    gone = cut(per_row.where("not _stays").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")))
    repeated = cut(per_row.where("_stays and _rows > 1").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")))
    text_hash = F.xxhash64(docs["text"])
    same = lambda other: docs["doc_id"].cast("long").eqNullSafe(other["_id"]) & (text_hash == other["_hash"])
    small = gone.count() <= BROADCAST_ROWS
    # Either a bounded list goes to every scan, or documents and list meet by a shuffle.
    left = docs.join(F.broadcast(gone) if small else gone, same(gone), "left_anti")
    if repeated.isEmpty():
        return left
    once = left.join(repeated, same(repeated), "left_anti")
    return once.unionByName(left.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", "text"]))
