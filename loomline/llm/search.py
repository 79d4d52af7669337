"""Exact BM25 top-k: an inverted index in shards, block-max pruning inside each, and an exact merge.

The index is a table of chunks. A chunk holds the postings of a few thousand documents,
ordered so that documents of one language and of similar length stand together, in blocks
of 64. Document frequencies, the number of documents and their mean length are counted
over the whole index, so scores do not depend on how documents fell into shards.

A shard is a run of chunks that one task walks, with the best k scores of every query of
a block of queries so far. Queries that share common words, as those of one language do, are
scored together, in groups that each have their commonest terms kept aside: these are a
dense table of a chunk's documents, the rarer ones postings. The rarer terms' postings are scored
first. A block of documents is skipped where its best rarer score and its maxima of the common terms
cannot together reach the query's k-th score, as in block-max WAND; a task does so for a step of queries
and all blocks of a chunk at a time, not for one document after the other. For the
other blocks the common terms are added, by a product of matrices. Where it pays, blocks are
bounded by the maxima of all terms before any posting is scored.
Survivors of a slack single-precision filter get their exact score in double precision, each
sum in the same order, so that equal documents tie. The shards' lists are merged by score and
doc_id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import scratch, setting

K1, B = 1.2, 0.75
CHUNK_DOCS, CHUNK_WORDS, BLOCK = 4096, 3_000_000, 64
#: Documents of so many words are held in a task, to be put in order and cut into chunks; files of so many chunks are dealt among the shards.
HELD_WORDS, FILE_CHUNKS, FILE_BYTES = 16_000_000, 4, "16m"
#: A group of so many queries that share common words at most has its own common terms: those that so many of its (query, document) pairs have,
#: the commonest so many at most. Their scores are added only where bounds allow.
GROUP, COMMON_PART, COMMON = 1024, 0.002, 1536
#: Queries are grouped by the signs of so many principal components over so many of the commonest terms.
SIGNS, LEAD = 3, 256
#: Tasks among which the chunks are dealt, at least; each gives k rows per query. A shard has about so many words at most.
SHARDS, SHARD_WORDS = 12, 200_000_000
#: A block of queries holds so many queries and distinct (query, term) pairs at most; it is broadcast.
BLOCK_QUERIES, BLOCK_PAIRS = 16384, 4_000_000
#: Queries are scored together, so many with so many (query, posting) pairs at most, or one alone.
STEP_QUERIES, STEP_POSTINGS, STEP_EXACT = 512, 3_000_000, 2048
#: Of those, so many are added at once, as many as a processor's cache holds.
ADDED_POSTINGS = 50_000
#: Blocks are bounded by all terms' maxima before their postings are scored every so many chunks, and in those between while that skips such a part of the postings.
PROBE, PAYS = 8, 0.25
#: Single precision filters with so much to spare, absolute and as a part of the score.
SLACK, SLACK_PART = 1e-3, 1e-4
NO_ID = -(1 << 63)
CHUNK = "docs int, words long, doc_ids binary, lengths binary, terms binary, counts binary, places binary, tfs binary"
#: Every byte that is no ASCII letter or digit, and below 128, parts words; A-Z become a-z.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def term_hashes(text: str | None) -> np.ndarray:
    words = (text or "").encode("utf-8", "surrogatepass").translate(TABLE).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def build_index(docs: DataFrame, path: str) -> DataFrame:
    """Write the chunks of all documents to ``path`` and return them. A null text is an empty document."""

    def chunk_of(part: list[tuple]):
        doc_ids, lengths = np.array([p[0] for p in part], np.int64), np.array([p[1] for p in part], np.int64)
        sizes = np.array([len(p[2]) for p in part])
        terms, tfs = np.concatenate([p[2] for p in part]), np.concatenate([p[3] for p in part])
        places = np.repeat(np.arange(len(part), dtype=np.uint16), sizes)
        order = np.argsort(terms, kind="stable")
        names, counts = np.unique(terms[order], return_counts=True)
        values = [doc_ids, lengths.astype(np.int32), names, counts.astype(np.uint16), places[order], tfs[order]]
        columns = [pa.array([len(part)], pa.int32()), pa.array([int(lengths.sum())], pa.int64()), *[pa.array([v.tobytes()], pa.binary()) for v in values]]
        return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in CHUNK.split(", ")])

    def chunks(part: list[tuple]):
        part.sort(key=lambda p: p[4])
        even = -(-len(part) // max(1, -(-len(part) // CHUNK_DOCS)))  # no small rest
        begin, words = 0, 0
        for i, p in enumerate(part):
            if i > begin and (i - begin >= even or words + p[1] > CHUNK_WORDS):
                yield chunk_of(part[begin:i])
                begin, words = i, 0
            words += p[1]
        if part:
            yield chunk_of(part[begin:])

    def scan(batches):
        part, held = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                h = term_hashes(text.as_py())
                names, tfs = np.unique(h, return_counts=True)
                if held + len(h) > HELD_WORDS:
                    yield from chunks(part)
                    part, held = [], 0
                held += len(h) + 1
                often = np.argsort(-tfs, kind="stable")[:2]
                part.append((NO_ID if doc_id is None else doc_id, len(h), names, np.minimum(tfs, 2**32 - 1).astype(np.uint32), (*names[often].tolist(), *[-1] * (2 - len(often)), len(h))))
        yield from chunks(part)

    docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, CHUNK).write.option("maxRecordsPerFile", FILE_CHUNKS).parquet(path)
    return docs.sparkSession.read.parquet(path)


class Chunk:
    """A chunk's arrays, which share the memory of the row's values."""

    READ = ("doc_ids", "lengths", "terms", "counts", "places", "tfs")

    def __init__(self, row: dict):
        read = lambda name, kind: np.frombuffer(row[name].as_buffer(), kind)
        self.doc_ids, self.lengths, self.terms = read("doc_ids", np.int64), read("lengths", np.int32), read("terms", np.uint64)
        counts = read("counts", np.uint16).astype(np.int64)
        counts[counts == 0] = 1 << 16  # cannot occur with CHUNK_DOCS below 65536; kept for larger settings
        self.counts, self.ends = counts, np.cumsum(counts)
        self.places, self.tfs = read("places", np.uint16), read("tfs", np.uint32)

    def among(self, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indices of own terms, indices in the vocabulary) of the shared terms; both are sorted."""
        at = np.searchsorted(vocabulary, self.terms)
        at[at == len(vocabulary)] = 0
        mine = np.flatnonzero(vocabulary[at] == self.terms) if len(vocabulary) else np.zeros(0, np.int64)
        return mine, at[mine]


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each start and size, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def chunks_of(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield Chunk({name: batch.column(name)[i] for name in Chunk.READ})


class QueryBlock:
    """Queries and their terms; the i-th pair says that the query ``rows[i]`` has the term ``terms[of[i]]``. Pairs stand query by query."""

    def __init__(self, ids: list[int], found: list[np.ndarray]):
        self.ids, self.rows = np.array(ids, np.int64), np.repeat(np.arange(len(ids), dtype=np.int32), [len(x) for x in found])
        self.terms, of = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_inverse=True)
        self.of = of.astype(np.int32)

    def weigh(self, df: np.ndarray, n_docs: int) -> None:
        """Set idf, put queries that share common words together, and part each group's terms into common and rarer ones; only the rarer ones' pairs stay."""
        self.idf = np.log1p((n_docs - df + 0.5) / (df + 0.5))
        self.arrange(df)
        self.groups, rare = [], np.ones(len(self.rows), bool)
        for a in range(0, len(self.ids), GROUP):
            b = min(a + GROUP, len(self.ids))
            lo, hi = np.searchsorted(self.rows, [a, b])
            row, of = self.rows[lo:hi] - a, self.of[lo:hi]
            pairs = np.bincount(of, minlength=len(df)) * df
            common = np.flatnonzero(pairs > COMMON_PART * (b - a) * n_docs)
            common = np.sort(common[np.argsort(-pairs[common], kind="stable")[:COMMON]])
            slot = np.full(len(df), -1)
            slot[common] = np.arange(len(common))
            rare[lo:hi] = slot[of] < 0
            has = np.zeros((b - a, len(common)), bool)
            has[row[~rare[lo:hi]], slot[of[~rare[lo:hi]]]] = True
            self.groups.append((a, b, common, has))
        self.rows, self.of = self.rows[rare], self.of[rare]

    def arrange(self, df: np.ndarray) -> None:
        """Order the queries by the signs of their first principal components over the commonest words, which tell languages apart."""
        lead = np.argsort(-np.bincount(self.of, minlength=len(df)) * df, kind="stable")[:LEAD]
        slot = np.full(len(df), -1)
        slot[lead] = np.arange(len(lead))
        at = slot[self.of]
        has = np.zeros((len(self.ids), len(lead)), np.float32)
        has[self.rows[at >= 0], at[at >= 0]] = 1
        has -= has.mean(0)
        axes = np.linalg.eigh(has.T @ has)[1][:, -SIGNS:]
        order = np.argsort((has @ axes > 0) @ (1 << np.arange(axes.shape[1])), kind="stable")
        place = np.argsort(order).astype(np.int32)[self.rows]
        pairs = np.argsort(place, kind="stable")
        self.ids, self.rows, self.of = self.ids[order], place[pairs], self.of[pairs]


def document_frequencies(index: DataFrame, block: QueryBlock, shards: int) -> np.ndarray:
    """In how many documents of the whole index each of the block's terms occurs."""
    spark, size = index.sparkSession, 1 << 14
    terms = spark.sparkContext.broadcast(block.terms)

    def count(batches):
        df = np.zeros(len(terms.value), np.int64)
        for chunk in chunks_of(batches):
            mine, theirs = chunk.among(terms.value)
            df[theirs] += chunk.counts[mine]
        for at in range(0, len(df), size):
            if df[at : at + size].any():
                yield pa.RecordBatch.from_arrays([pa.array([at // size], pa.int32()), pa.array([df[at : at + size].tobytes()], pa.binary())], ["block", "counts"])

    def add_up(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, c in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[b] = sums.get(b, 0) + np.frombuffer(c, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["block", "counts"])

    parts = index.select(*Chunk.READ).coalesce(shards).mapInArrow(count, "block int, counts binary")
    df = np.zeros(len(block.terms), np.int64)
    for r in parts.repartition("block").mapInArrow(add_up, "block int, counts binary").collect():  # one number per term of the block
        df[r["block"] * size : r["block"] * size + len(r["counts"]) // 8] = np.frombuffer(r["counts"], np.int64)
    return df


class TopK:
    """The best k of each query so far, by score and then by doc_id, null last; a score of minus infinity stands for none."""

    def __init__(self, queries: int, k: int):
        self.k, self.score, self.doc = k, np.full((queries, k), -np.inf), np.full((queries, k), NO_ID)
        self.least = np.full(queries, -np.inf)
        self.chunks = self.postings = self.skipped = 0  # chunks seen; postings of rarer terms that queries met where blocks were bounded, and those skipped

    def bounds(self) -> bool:
        """Whether to bound the next chunk's blocks before their postings are scored: every PROBE chunks, and always while that skips enough."""
        self.chunks += 1
        if self.chunks % PROBE == 2 % PROBE:
            self.postings = self.skipped = 0
            return True
        return self.skipped > PAYS * self.postings

    def add(self, row: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        met = np.unique(row)
        row = np.concatenate([np.repeat(met, self.k), row])
        score, doc = np.concatenate([self.score[met].ravel(), score]), np.concatenate([self.doc[met].ravel(), doc])
        after = (doc.view(np.uint64) ^ np.uint64(1 << 63)) - np.uint64(1)  # NO_ID comes last
        order = np.lexsort((after, -score, row))
        row = row[order]
        order = order[np.arange(len(row)) - np.searchsorted(row, row) < self.k]
        self.score[met], self.doc[met] = score[order].reshape(-1, self.k), doc[order].reshape(-1, self.k)
        self.least[met] = self.score[met, -1]


def steps(q_row: np.ndarray, sizes: np.ndarray, queries: int, most: int):
    """(first query, last, first pair, last) of runs of queries that are scored together; ends are exclusive."""
    begins = np.searchsorted(q_row, np.arange(queries + 1))
    until = np.r_[0, np.cumsum(sizes)][begins]
    a = 0
    while a < queries:
        b = max(a + 1, min(a + STEP_QUERIES, int(np.searchsorted(until, until[a] + most, "right")) - 1))
        yield a, b, begins[a], begins[b]
        a = b


class Postings:
    """A chunk's postings of a block's terms, term by term, with the chunk's documents in blocks."""

    def __init__(self, chunk: Chunk, block: QueryBlock, mean_length: float):
        self.n_docs, self.blocks = len(chunk.doc_ids), -(-len(chunk.doc_ids) // BLOCK)
        mine, theirs = chunk.among(block.terms)
        self.sizes = chunk.counts[mine]
        self.begins = np.cumsum(self.sizes) - self.sizes
        where = ranges(chunk.ends[mine] - self.sizes, self.sizes)
        self.place = chunk.places[where].astype(np.int64)
        tf, damp = chunk.tfs[where].astype(float), K1 * (1 - B + B * chunk.lengths / mean_length)
        self.gain = tf * (K1 + 1) / (tf + damp[self.place])
        self.value = self.gain * np.repeat(block.idf[theirs], self.sizes)
        self.at = np.full(len(block.terms), -1, np.int32)
        self.at[theirs] = np.arange(len(mine), dtype=np.int32)

    def entries(self) -> None:
        """Where a term has postings of one block after the other, these runs are its entries: their block, size and greatest value."""
        run = np.repeat(np.arange(len(self.sizes)), self.sizes) * self.blocks + self.place // BLOCK
        self.starts = np.flatnonzero(np.diff(run, prepend=-1))
        self.in_block, self.size_of = run[self.starts] % self.blocks, np.diff(self.starts, append=len(run))
        self.most = np.maximum.reduceat(self.value, self.starts) if len(self.starts) else np.zeros(0)
        self.entry_at = np.searchsorted(self.starts, self.begins)
        self.n_entries = np.searchsorted(self.starts, self.begins + self.sizes) - self.entry_at

    def table(self, common: np.ndarray) -> np.ndarray:
        """The gain of each document of the chunk, padded to whole blocks, for each of some terms."""
        at = self.at[common]
        slot = np.flatnonzero(at >= 0)
        at = at[slot]
        where = ranges(self.begins[at], self.sizes[at])
        found = np.zeros((self.blocks * BLOCK, len(common)))
        found[self.place[where], np.repeat(slot, self.sizes[at])] = self.gain[where]
        return found


def score_chunk(chunk: Chunk, block: QueryBlock, mean_length: float, best: TopK) -> None:
    """Bring the documents of a chunk that can be among the best k of any query into ``best``."""
    postings = Postings(chunk, block, mean_length)
    bounding = best.bounds()
    if bounding:
        postings.entries()
    for first, last, terms, has in block.groups:
        lo, hi = np.searchsorted(block.rows, [first, last])
        at = postings.at[block.of[lo:hi]]
        rows, at = block.rows[lo:hi][at >= 0].astype(np.int64) - first, at[at >= 0]
        common, weights = postings.table(terms), block.idf[terms]
        about_common = common.astype(np.float32)
        block_max = about_common.reshape(postings.blocks, BLOCK, len(terms)).max(1)
        for a, b, begin, end in steps(rows, postings.sizes[at], last - first, STEP_POSTINGS):
            row, col, score = score_step(postings, rows[begin:end] - a, at[begin:end], has[a:b], weights, common, about_common, block_max, best, first + a, bounding)
            if len(row):
                best.add(first + a + row, score, chunk.doc_ids[col])


def score_step(postings: Postings, rows: np.ndarray, at: np.ndarray, has: np.ndarray, weights: np.ndarray, common: np.ndarray, about_common: np.ndarray, block_max: np.ndarray, best: TopK, first: int, bounding: bool):
    """(query, document of the chunk, score) of all that can be among the best k of some queries, the first of which is ``first``.

    ``rows`` and ``at`` are their pairs of query and rarer term, ``has`` tells which common terms each has.
    """
    queries, n_docs, blocks = len(has), postings.n_docs, postings.blocks
    least = best.least[first : first + queries]
    floor = least * (1 - SLACK_PART) - SLACK
    dense = (has * weights).astype(np.float32)
    common_bound = dense @ block_max.T
    begins, sizes, alive = postings.begins[at], postings.sizes[at], None
    if bounding:
        per_pair = postings.n_entries[at]
        entry, rows = ranges(postings.entry_at[at], per_pair), np.repeat(rows, per_pair)
        bound = np.bincount(rows * blocks + postings.in_block[entry], postings.most[entry], queries * blocks).reshape(queries, blocks)
        alive = bound + common_bound > np.maximum(floor, 0)[:, None]
        kept = alive[rows, postings.in_block[entry]]
        entry, rows = entry[kept], rows[kept]
        best.postings, best.skipped = best.postings + int(sizes.sum()), best.skipped + int(sizes.sum())
        begins, sizes = postings.starts[entry], postings.size_of[entry]
        best.skipped -= int(sizes.sum())
    rarer = np.empty((queries, blocks * BLOCK))
    for a, b, begin, end in steps(rows, sizes, queries, ADDED_POSTINGS):
        where = ranges(begins[begin:end], sizes[begin:end])
        cell = postings.place.take(where, mode="clip")
        cell += np.repeat((rows[begin:end] - a) * (blocks * BLOCK), sizes[begin:end])
        rarer[a:b] = np.bincount(cell, postings.value.take(where, mode="clip"), (b - a) * blocks * BLOCK).reshape(b - a, -1)
    unset = np.flatnonzero(~np.isfinite(floor))
    if n_docs >= best.k and len(unset):  # no k documents yet: this chunk's own k-th score is a bound
        every = rarer[unset, :n_docs] + dense[unset] @ about_common[:n_docs].T
        floor[unset] = np.partition(every, n_docs - best.k, axis=1)[:, n_docs - best.k] * (1 - SLACK_PART) - SLACK
        del every
    need = np.maximum(floor, 0).astype(np.float32)
    hopeful = rarer.reshape(queries, blocks, BLOCK).max(2) + common_bound > need[:, None]
    if alive is not None:
        hopeful &= alive
    found = []
    for j, live in enumerate(map(np.flatnonzero, np.ascontiguousarray(hopeful.T))):
        if not len(live):
            continue
        docs = slice(j * BLOCK, (j + 1) * BLOCK)
        about = dense[live] @ about_common[docs].T
        about += rarer[live, docs]
        hit = np.flatnonzero(about > need[live, None])
        if len(hit):
            found.append((live[hit // BLOCK], hit % BLOCK + docs.start, about.ravel()[hit]))
    row, col, about = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    if len(row) > best.k:  # those found here bound each other
        order = np.lexsort((-about, row))
        row, col, about = row[order], col[order], about[order]
        begin = np.searchsorted(row, row)
        last = np.minimum(begin + best.k, np.searchsorted(row, row, "right")) - 1
        kept = (np.arange(len(row)) - begin < best.k) | (about >= about[last] * (1 - SLACK_PART) - SLACK)
        row, col = row[kept], col[kept]
    score = rarer[row, col]
    for i in range(0, len(row), STEP_EXACT):
        part = slice(i, i + STEP_EXACT)
        score[part] += np.einsum("ij,ij->i", has[row[part]] * weights, common[col[part]])
    return row, col, np.round(score, 6)


def query_blocks(queries: DataFrame):
    """Blocks of queries, each bounded in queries and in distinct (query, term) pairs.

    Texts become sorted term hashes where they are read; of those, a block at a time
    passes through the driver, on its way to be broadcast. A query of more terms than a block has
    is a block of its own.
    """

    def hashed(batches):
        for batch in batches:
            terms = [np.unique(term_hashes(t.as_py())).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(terms, pa.binary())], ["doc_id", "terms"])

    rows = queries.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(hashed, "doc_id long, terms binary")
    path = scratch(queries.sparkSession, "queries")
    rows.write.parquet(path)
    ids, found, pairs = [], [], 0
    for r in queries.sparkSession.read.parquet(path).orderBy("doc_id", "terms").toLocalIterator():
        terms = np.frombuffer(r["terms"], np.uint64)
        if ids and (len(ids) >= BLOCK_QUERIES or pairs + len(terms) > BLOCK_PAIRS):
            yield QueryBlock(ids, found)
            ids, found, pairs = [], [], 0
        ids.append(r["doc_id"])
        found.append(terms)
        pairs += len(terms)
    if ids:
        yield QueryBlock(ids, found)


def search_block(index: DataFrame, block: QueryBlock, n_docs: int, mean_length: float, k: int, shards: int) -> DataFrame:
    """(query_row, query_id, doc_id, score): the best k of each shard for each query of the block."""
    block.weigh(document_frequencies(index, block, shards), n_docs)
    shared = index.sparkSession.sparkContext.broadcast(block)

    def walk(batches):
        best = TopK(len(shared.value.ids), k)
        for chunk in chunks_of(batches):
            score_chunk(chunk, shared.value, mean_length, best)
        row, rank = np.nonzero(best.score > -np.inf)
        doc, score = best.doc[row, rank], best.score[row, rank]
        yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(shared.value.ids[row]), pa.array(doc, mask=doc == NO_ID), pa.array(score)], ["query_row", "query_id", "doc_id", "score"])

    return index.select(*Chunk.READ).coalesce(shards).mapInArrow(walk, "query_row long, query_id long, doc_id long, score double")


def top_k(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, doc_id, score, rank) of the k best documents for each query; only scores above 0 count.

    Queries are rows (doc_id, text); a query is the set of its distinct words. Scores are
    BM25 with k1 = 1.2 and b = 0.75, rounded to six digits; ties go to the smaller doc_id, null
    last. A query without words finds nothing. Repeated documents are found each;
    repeated queries are answered each. Words are runs of ASCII letters and digits, A-Z
    lowered, and of all other characters above U+007F.
    """
    spark = docs.sparkSession
    index = build_index(docs, scratch(spark, "index"))
    totals = index.agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
    n_docs, mean_length = int(totals["docs"] or 0), max(1e-9, float(totals["words"] or 0) / max(1, totals["docs"] or 0))
    shards, cores = max(SHARDS, -(-int(totals["words"] or 0) // SHARD_WORDS)), spark.sparkContext.defaultParallelism
    shards = -(-shards // cores) * cores if shards > cores else shards  # no last round of few tasks
    path = scratch(spark, "found")
    schema = "query_row long, query_id long, doc_id long, score double"
    spark.createDataFrame([], schema).write.parquet(f"{path}/block=-1")
    for number, block in enumerate(query_blocks(queries.where("doc_id is not null"))):
        with setting(spark, "spark.sql.files.maxPartitionBytes", FILE_BYTES):  # a file each, so that shards get as many
            search_block(index, block, n_docs, mean_length, k, shards).write.parquet(f"{path}/block={number}")
    over = Window.partitionBy("block", "query_row").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    found = spark.read.schema(f"{schema}, block int").parquet(path).withColumn("rank", F.row_number().over(over))
    return found.where(F.col("rank") <= k).select("query_id", "doc_id", "score", "rank")


def every_fiftieth(doc_id: Column) -> Column:
    return doc_id % 50 == 0
