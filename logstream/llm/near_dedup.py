"""Near-duplicate documents by Order MinHash and banded alignment.

* Texts become sequences of lower-case words (letters, digits and their combining marks);
  texts with equal sequences are one node, of texts without words only those equal up to
  white space.  The k-mers of a node are its runs of five words, the j-th occurrence of a run
  labelled j, so all labelled k-mers of a text differ.
* Order MinHash (Marcais et al., 2019): each of ROWS * BANDS hash functions picks the two
  labelled k-mers with the smallest hashes and keeps them in text order.  Two texts share a
  sketch only if the same k-mers are smallest and stand in the same order, so sharing is
  sensitive to edits and to order.  ROWS sketches make a band; nodes that share a band are a
  bucket.  With similarity 0.8 a band is shared with probability about 0.8^4, so all 20
  bands are missed with probability below 0.0001.
* Candidates are verified.  First the bags of k-mers bound what an alignment can reach;
  then a banded alignment finds the longest chain of equal k-mers in order, among pairs near
  enough to the diagonal to occur in an alignment that reaches the threshold.  Similarity is
  m / (a + b - m): m aligned k-mers of a and b.  It equals the Jaccard similarity of the
  k-mer bags when the common ones stand in the same order.  Linked: 0.8 or more.
* Linked nodes form classes (connected components by star contraction on tables).

Classes need every text linked to its class, not every pair compared.  A bucket of up to
BLOCK nodes goes to one task whole.  Larger ones go in blocks of about BLOCK members, each with
the same few leaders of the bucket; a node meets PICKS of its large buckets so, which all nodes
choose alike.  The links found, of any band, make classes.  In a group of near copies few stay
outside the class of most of a bucket; those are compared with all others of the bucket, block by
block, and members of one class not with one another: once for all buckets with the same main
class, unless that takes more rows than bucket by bucket.  So no link between different classes
is lost to the size of a bucket, and a group of near copies costs a few times its size.  (Members
of a large bucket that are *not* similar to most of it, which four shared smallest k-mers make
rare, cost their number times its size / (4 * BLOCK) rows.)

Texts travel compressed to the tasks that compare them.

Defined results: NULL text counts as empty; texts without words are alike only if equal up
to white space; a text of one to four words has itself as its only k-mer; NULL and repeated
ids are rows like others; of a class the row with the smallest id stays (NULL last), and of
rows that tie there one; an empty table gives no rows; other columns are not read (the stage
passes them).
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, materialise, per_batch, read_table, text_or_empty

WORDS, SIMILARITY = 5, 0.8
ROWS, BANDS = 2, 20
BLOCK = 128            # nodes of a bucket that one task compares
LEADERS = 6            # nodes of a bucket above BLOCK that all its blocks meet
PICKS = 2              # buckets above BLOCK in whose blocks a node is
TEXTS = 256            # texts of a batch that are Python strings at a time
FILE_ROWS = 25_000     # rows per file of the tables between steps
CELLS = 1 << 16        # hashes that a task holds at a time for one text
RECENT_BYTES = 1 << 24 # of k-mers that a worker keeps between groups
KNOWN_WORDS = 1 << 16  # hashes of words that a worker remembers
SEED = 20_240_601

# vowel signs and the like are part of a word, but not of \w
_MARKS = frozenset(c for c in map(chr, range(sys.maxunicode + 1))
                   if unicodedata.category(c)[0] == "M")
_AS_LETTER = dict.fromkeys(map(ord, _MARKS), "a")
_word = re.compile(r"\w+")
_beyond = re.compile(f"[{min(_MARKS)}-{chr(sys.maxunicode)}]").search   # could be a mark
_MASK = (1 << 64) - 1


def _words(text: str) -> list[str]:
    if _beyond(text) and not _MARKS.isdisjoint(text):
        # same places with each mark a letter, read from the text itself
        return [text[m.start():m.end()] for m in _word.finditer(text.translate(_AS_LETTER))]
    return _word.findall(text)


class _WordHash(dict):
    """64-bit hash of a word, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = int.from_bytes(
            hashlib.blake2b(word.encode("utf-8"), digest_size=8).digest(), "little")
        return value


_hash_of = _WordHash()


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit (the splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def kmers(text: str) -> tuple[bytes, np.ndarray]:
    """Digest of the word sequence (of the text if it has no words), and the labelled k-mers
    in text order (uint64)."""
    words = _words(text.lower())
    hashes = np.fromiter(map(_hash_of.__getitem__, words), np.uint64, len(words))
    n = len(hashes)
    if not n:
        data = " ".join(text.split()).encode("utf-8")
        return hashlib.blake2b(data, digest_size=16, person=b"text").digest(), hashes
    digest = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
    span = min(WORDS, n)
    out = np.zeros(n - span + 1, np.uint64)
    for i in range(span):
        out = _mixed(out + hashes[i:n - span + 1 + i] + np.uint64(i + 1))
    unique, inverse, counts = np.unique(out, return_inverse=True, return_counts=True)
    if len(unique) < len(out):
        order = np.argsort(inverse, kind="stable")
        starts = np.cumsum(counts) - counts
        label = np.empty(len(out), np.int64)
        label[order] = np.arange(len(out)) - np.repeat(starts, counts)
        out = np.where(label > 0, _mixed(out + label.astype(np.uint64)), out)
    return digest, out


_rng = np.random.default_rng(SEED)
_SALT = _rng.integers(0, 1 << 64, ROWS * BANDS, np.uint64, endpoint=False)
_ODD = _rng.integers(0, 1 << 63, ROWS * BANDS, np.uint64) * np.uint64(2) + np.uint64(1)


def bands(grams: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    picked = np.zeros((2, ROWS * BANDS), np.int64)       # a single k-mer stands twice
    step = max(1, CELLS // len(grams))                   # hash functions at a time
    for i in range(0, ROWS * BANDS, step):
        h = (grams ^ _SALT[i:i + step, None]) * _ODD[i:i + step, None]
        first = picked[0, i:i + step] = h.argmin(axis=1)
        h[np.arange(len(h)), first] = _MASK
        picked[1, i:i + step] = h.argmin(axis=1)
    picked.sort(axis=0)                                  # text order
    sketches = grams[picked[0]] * np.uint64(0x9E3779B97F4A7C15) + grams[picked[1]]
    keys = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        keys = _mixed(keys + sketches[r::ROWS])
    return keys


def bag_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two arrays of distinct k-mers, sorted."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    at = np.searchsorted(a, b)
    common = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    return common / (len(a) + len(b) - common)


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Similarity by banded alignment; values below ``least`` may come out lower still."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    need = int(np.ceil(least * (len(a) + len(b)) / (1 + least) - 1e-9))
    band = max(len(a), len(b)) - need
    if band < 0 or min(len(a), len(b)) < need:
        return 0.0
    order = np.argsort(a, kind="stable")
    at = np.searchsorted(a[order], b)
    at = order[np.minimum(at, len(a) - 1)]
    here = np.flatnonzero((a[at] == b) & (np.abs(at - np.arange(len(b))) <= band))
    ends: list[int] = []          # longest increasing chain: smallest end by length
    for i in at[here].tolist():
        k = bisect_left(ends, i)
        if k == len(ends):
            ends.append(i)
        else:
            ends[k] = i
    return len(ends) / (len(a) + len(b) - len(ends))


def _texts(column: pa.Array) -> Iterator[str]:
    """Texts of a batch; few are Python strings at a time."""
    for i in range(0, len(column), TEXTS):
        yield from column.slice(i, TEXTS).to_pylist()


def _sketched(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """__id, __node (digest of the words), __sha (of the text), __keys (bands)."""
    rows = docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("__text"))
    kind = rows.schema["__id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, keys, shas = [], [], []
            for text in _texts(batch.column(1)):
                digest, grams = kmers(text)
                nodes.append(digest)
                keys.append(bands(grams).view(np.int64) if len(grams) else [])
                shas.append(hashlib.sha256(text.encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nodes, pa.binary()), pa.array(shas, pa.string()),
                 pa.array(keys, pa.list_(pa.int64()))], ["__id", "__node", "__sha", "__keys"])

    return per_batch(rows, run, f"__id {kind}, __node binary, __sha string, __keys array<long>")


def _packed(docs: DataFrame, text_col: str) -> DataFrame:
    """__t (SHA-256 of the text), __packed (the text, compressed) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shas, packed = [], []
            for text in _texts(batch.column(0)):
                data = text.encode("utf-8")
                shas.append(hashlib.sha256(data).hexdigest())
                packed.append(zlib.compress(data, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shas, pa.string()), pa.array(packed, pa.binary())],
                ["__t", "__packed"])

    return per_batch(docs.select(text_or_empty(text_col).alias("__text")), run,
                     "__t string, __packed binary")


def _unpacked(data: bytes) -> np.ndarray:
    return kmers(zlib.decompress(data).decode("utf-8"))[1]


class _Recent(dict):
    """K-mers of nodes that a worker met last, bounded in bytes."""

    size = 0

    def of(self, node: bytes, text: bytes) -> np.ndarray:
        grams = self.get(node)
        if grams is None:
            grams = _unpacked(text)
            if self.size + grams.nbytes > RECENT_BYTES:
                self.clear()
                self.size = 0
            if grams.nbytes <= RECENT_BYTES:
                self[node] = grams
                self.size += grams.nbytes
        return grams


_recent = _Recent()


def _alike(bags: list[np.ndarray], ask: list[int]) -> list[tuple[int, int]]:
    """Pairs (one of ``ask``, any other), each once, whose bags of k-mers have a Jaccard
    similarity of SIMILARITY or more."""
    sizes = np.array([len(b) for b in bags], np.int64)
    ask = np.array(ask, np.int64)
    common = np.zeros((len(ask), len(bags)), np.float32)
    flat = np.concatenate(bags)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], np.repeat(np.arange(len(bags)), sizes)[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])[:len(flat)]
    column = np.cumsum(new) - 1
    shared = np.bincount(column, minlength=1)[column] > 1 if len(flat) else new
    owner, column = owner[shared], column[shared]
    if len(column):
        column = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]]))
        # counts of common k-mers as a product of 0/1 matrices, some columns at a time
        step = min(int(column[-1]) + 1, max(1, CELLS * 16 // len(bags)))
        for low in range(0, int(column[-1]) + 1, step):
            a, b = np.searchsorted(column, [low, low + step])
            holds = np.zeros((len(bags), step), np.float32)
            holds[owner[a:b], column[a:b] - low] = 1
            common += holds[ask] @ holds.T
    either = sizes[ask][:, None] + sizes[None, :] - common
    i, j = np.nonzero((common >= SIMILARITY * either - 1e-6)
                      & (np.arange(len(bags))[None, :] != ask[:, None]))
    pairs = {(min(x, y), max(x, y)) for x, y in zip(ask[i].tolist(), j.tolist())}
    return sorted(pairs)


def _table(df: DataFrame, name: str, rows: int) -> DataFrame:
    """``materialise`` a table of up to about ``rows`` rows in files of FILE_ROWS, but one per
    core at least: a file per shuffle partition costs more than its few rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return materialise(df.coalesce(max(cores, -(-rows // FILE_ROWS))), name)


def _blocks(members: DataFrame) -> DataFrame:
    """Rows of the first comparison: buckets of up to BLOCK nodes whole, of larger ones blocks of
    the nodes that pick the bucket, each with its leaders."""
    large = members.where(F.col("__size") > BLOCK)
    bucket = F.struct("__bucket", "__size")
    picks = large.groupBy("__node").agg(F.array_distinct(F.array(*[
        F.min_by(bucket, F.xxhash64("__bucket", F.lit(salt))) for salt in range(PICKS)])).alias("p"))
    blocks = F.ceil(F.col("__size") / BLOCK).cast("int")
    picks = picks.select("__node", F.explode("p").alias("p")).select("p.*", "__node").select(
        "__bucket", F.pmod(F.xxhash64("__node", F.lit(7)), blocks).cast("int").alias("__i"), "__node")
    leads = large.groupBy("__bucket", "__size").agg(F.array_distinct(F.array(*[
        F.min_by("__node", F.xxhash64("__node", F.lit(salt))) for salt in range(LEADERS)])).alias("l"))
    leads = leads.select("__bucket", "__size", F.explode("l").alias("__node")).select(
        "__bucket", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("__i"), "__node")
    whole = members.where(F.col("__size") <= BLOCK).select(
        "__bucket", F.lit(0).alias("__i"), "__node")
    return whole.unionByName(picks).unionByName(leads).select(
        "*", F.col("__node").alias("__label"), F.lit(True).alias("__query"))


def _large(members: DataFrame, texts: DataFrame, classes: DataFrame) -> DataFrame:
    """Classes after the links between members of large buckets outside the class of most of the
    bucket and all others of it."""
    n = members.count()
    labelled = _table(members.join(classes, F.col("__node") == F.col("__n"), "left").select(
        "__bucket", "__node", F.coalesce("__class", "__node").alias("__label")),
        "near-labelled", n)
    main = labelled.groupBy("__bucket", "__label").agg(F.count(F.lit(1)).alias("n")).groupBy(
        F.col("__bucket").alias("__b")).agg(
        F.max_by("__label", F.struct("n", "__label")).alias("__main"),
        (F.sum("n") - F.max("n")).alias("__out"), F.sum("n").alias("__all"))
    placed = _table(labelled.join(main.where("__out > 0"), F.col("__bucket") == F.col("__b"))
                    .drop("__b"), "near-members-placed", n)
    if placed.isEmpty():
        return classes
    found = materialise(_compared(_outside(placed), texts, ["__main", "__bucket", "__i", "__j"]),
                        "near-found")
    if found.isEmpty():
        return classes
    return components(classes.withColumnsRenamed({"__n": "__node", "__class": "__other"})
                      .unionByName(found))


def _outside(placed: DataFrame) -> DataFrame:
    """Blocks of members outside the main class of large buckets with blocks of all members, of
    the buckets with the same main class together where that takes no more rows."""
    parts = lambda n: F.ceil(F.col(n) / (4 * BLOCK)).cast("int")
    cost = F.col("__all") * parts("__out") + F.col("__out") * parts("__all")
    apart = placed.groupBy("__bucket", "__main", "__out", "__all").agg(F.lit(0)).groupBy(
        F.col("__main").alias("__m")).agg(F.sum(cost).alias("__apart"))
    joint = placed.select("__main", "__node", "__label").distinct().groupBy("__main").agg(
        F.count_if(F.col("__label") != F.col("__main")).alias("__out"),
        F.count(F.lit(1)).alias("__all"))
    joint = joint.join(apart, F.col("__main") == F.col("__m")).select(
        "__m", (cost <= F.col("__apart")).alias("__joint"), F.col("__out").alias("__o"),
        F.col("__all").alias("__a"))
    pick = lambda a, b: F.when(F.col("__joint"), F.col(a)).otherwise(F.col(b))
    # a row per main class of buckets above BLOCK; dealt by class, large ones would meet in a task
    sized = placed.join(F.broadcast(joint), F.col("__main") == F.col("__m")).select(
        "__main", F.when(~F.col("__joint"), F.col("__bucket")).alias("__bucket"), "__node", "__label",
        (F.col("__label") != F.col("__main")).alias("__query"),
        pick("__o", "__out").alias("__out"), pick("__a", "__all").alias("__all")).distinct()
    part = lambda n: F.pmod(F.xxhash64("__node", F.lit(7)), parts(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), parts(n) - 1))
    keep = ["__main", "__bucket", "__node", "__label"]
    left = sized.where("__query").select(*keep, part("__out").alias("__i"),
                                         every("__all").alias("__j"), "__query")
    right = sized.select(*keep, every("__out").alias("__i"), part("__all").alias("__j"),
                         F.lit(False).alias("__query"))
    return left.unionByName(right)


def _compared(rows: DataFrame, texts: DataFrame, group: list[str]) -> DataFrame:
    """Links in each group between a node marked __query and any node of another label, as the
    labels that they connect and the smallest of these; nodes that the links found already
    connect are not compared."""
    def compare(table):
        sequences: dict[bytes, np.ndarray] = {}
        labels, asked = {}, set()
        for node, label, query, text in zip(*(table[c].to_pylist() for c in (
                "__node", "__label", "__query", "__packed"))):
            if node not in sequences:
                sequences[node] = _recent.of(node, text)
                labels[node] = label
            if query:
                asked.add(node)
        nodes = sorted(sequences)
        root = {label: label for label in labels.values()}

        def top(x: bytes) -> bytes:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        ask = [i for i, n in enumerate(nodes) if n in asked]
        for i, j in _alike([sequences[n] for n in nodes], ask):
            a, b = nodes[i], nodes[j]
            low, high = sorted((top(labels[a]), top(labels[b])))
            if low != high and aligned(sequences[a], sequences[b]) >= SIMILARITY:
                root[high] = low
        found = [(label, top(label)) for label in root if root[label] != label]
        return pa.table({"__node": pa.array([f[0] for f in found], pa.binary()),
                         "__other": pa.array([f[1] for f in found], pa.binary())})

    joined = rows.join(texts, F.col("__node") == F.col("__n")).select(
        *group, "__node", "__label", "__query", "__packed")
    return joined.groupBy(*group).applyInArrow(compare, "__node binary, __other binary")


def components(links: DataFrame) -> DataFrame:
    """__n, __class: the smallest node connected to each linked node.

    Alternating large-star and small-star steps (Kiveris et al., 2014); every step is
    joins and aggregates over a table, until the edges are stars.
    """
    n = links.count()
    edges = _table(links.select(F.greatest("__node", "__other").alias("u"),
                                F.least("__node", "__other").alias("v"))
                   .where("u != v").distinct(), "near-edges", n)
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")).select(
            "k", F.least("k", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("k")).where(
            "v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = _table(large, "near-large", n)
        low = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        small = large.join(low, F.col("u") == F.col("k")).select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
            F.col("m").alias("v")).where("u != v").distinct()
        edges = _table(small, "near-edges", n)
    return edges.select(F.col("u").alias("__n"), F.col("v").alias("__class"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node that points to another one points to one only, to which none points
    that is pointed to itself."""
    ends = edges.select(F.col("u").alias("k"), F.lit(1).alias("out"), F.lit(0).alias("to")) \
        .unionByName(edges.select(F.col("v").alias("k"), F.lit(0).alias("out"),
                                  F.lit(1).alias("to")))
    return ends.groupBy("k").agg(F.sum("out").alias("out"), F.max("to").alias("to")).where(
        "out > 1 OR (out > 0 AND to > 0)").isEmpty()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: __id, __class_id (smallest id of the class), __class_size,
    __kept, __sha (of the text)."""
    rows = materialise(_sketched(docs, id_col, text_col).withColumn(
        "__row", F.monotonically_increasing_id()), "near-rows")
    n = rows.count()
    nodes = _table(rows.groupBy("__node").agg(
        F.min("__sha").alias("__s"), F.first("__keys").alias("__keys")), "near-nodes", n)
    keyed = nodes.select("__node", F.explode("__keys").alias("__bucket"))
    shared = keyed.groupBy(F.col("__bucket").alias("__b")).agg(
        F.count(F.lit(1)).alias("__size"), F.bit_xor(F.xxhash64("__node")).alias("__set"))
    # bands with the same members would do the same work: one of them stays
    shared = shared.where("__size > 1").groupBy("__size", "__set").agg(
        F.min("__b").alias("__b"))
    shared = _table(shared, "near-buckets", n)
    members = _table(keyed.join(shared, F.col("__bucket") == F.col("__b")).select(
        "__bucket", "__node", "__size"), "near-members", n)

    wanted = members.select(F.col("__node").alias("__w")).distinct()
    first = _table(nodes.join(wanted, F.col("__node") == F.col("__w"), "left_semi").select(
        F.col("__node").alias("__n"), "__s"), "near-wanted", n)
    # merge: both sides grow with the corpus, so the join is the same at every size
    texts = _packed(docs, text_col).join(first.hint("merge"), F.col("__t") == F.col("__s")).select(
        "__n", "__packed").dropDuplicates(["__n"])
    texts = _table(texts, "near-texts", n)

    links = materialise(_compared(_blocks(members), texts, ["__bucket", "__i"]), "near-links")
    classes = components(links)
    large = members.where(F.col("__size") > BLOCK).drop("__size")
    if not large.isEmpty():
        classes = _large(large, texts, classes)

    placed = rows.join(classes, F.col("__node") == F.col("__n"), "left").select(
        "__id", "__sha", "__row", F.coalesce("__class", "__node").alias("__class"))
    placed = _table(placed, "near-placed", n)
    stays = placed.groupBy(F.col("__class").alias("__c")).agg(
        F.min(F.struct(F.col("__id").isNull(), F.col("__id").alias("id"),
                       F.col("__row").alias("row"))).alias("__first"),
        F.count(F.lit(1)).alias("__class_size"))
    stays = _table(stays, "near-stays", n)
    return placed.join(stays, F.col("__class") == F.col("__c")).select(
        "__id", F.col("__first.id").alias("__class_id"), "__class_size",
        (F.col("__row") == F.col("__first.row")).alias("__kept"), "__sha")


def op5_near_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, class_id, class_size, kept of every document."""
    out = near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select(F.col("__id").alias("doc_id"), F.col("__class_id").alias("class_id"),
                      F.col("__class_size").alias("class_size"), F.col("__kept").alias("kept"))


def near_dedup_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, all input columns."""
    decided = materialise(near_duplicates(docs), "near-decided")
    kept = decided.where("__kept")
    again = decided.groupBy("__id", "__sha").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("__kept").cast("int")).alias("k")) \
        .where("k > 0 AND n > k")
    return keep_rows(docs, kept, repeated=not again.isEmpty())
