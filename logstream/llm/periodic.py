r"""Periodic runs of words, found in a grammar of the texts.

A run is a stretch of consecutive words with smallest period q (words q apart are equal)
and a length of at least ``max(least, repeats * q)`` that no neighbouring word extends.

* Re-Pair: the word ids of a block of documents are compressed together.  In each pass a
  pair of neighbouring symbols becomes a nonterminal wherever it is more frequent than the
  pairs that it overlaps (the greedy order of Re-Pair, decided place by place) and that
  happens at least twice.  A pass that replaces under one pair in STALL ends it; over the
  symbols that are left in a document stands a balanced tree.
* Each nonterminal and each node of these trees has one boundary between its two parts.  A
  run lies inside a part or crosses the boundary, so the runs that cross it are computed once
  per nonterminal, in one of its expansions: one half of such a run has length >= 12 and >=
  1.5 q, so (for the default bounds) the four words at the boundary occur again q words on.
  These later places, nearest first, are the candidates; the common stretches on both sides
  of a candidate give its run.  A run with period q0 from the boundary to e settles all
  candidates from 2 q0 up to 2/3 of the way to e: a run of such a period overlaps it by the
  sum of both periods, so (Fine and Wilf) it is the same run.  The mirrored texts give the
  runs that lie mostly before the boundary.
* The runs of a nonterminal are translated to all its places in the derivation.  Those cut
  off by the end of an expansion lie inside the whole run, which a larger node has: intervals
  inside another one of the same period are merged away, of equal ones the smallest period
  stays.

A task works through its documents in blocks of BLOCK_BYTES of text (a longer text is a block
of its own), so its memory is bounded by that and the longest text.  Nothing is shuffled.

Defined results: NULL and empty texts have no words and no runs; words are split at the ASCII
white space 0x20, 0x09-0x0D only; texts are read whole; repeated rows and NULL ids are rows
like others; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_batch, read_table, text_or_empty

LEAST, REPEATS = 24, 3      # a run has LEAST words and REPEATS periods at least
BLOCK_BYTES = 1 << 20       # of text that share a grammar
STALL = 500
_CELLS = 1 << 19            # words compared at a time


class Grammar:
    """Re-Pair of ``words`` (ids 0 .. terminals - 1); pairs never span two documents.

    Nonterminal i stands for ``left[i] right[i]``, has ``length[i]`` words and one of its
    places in the text at ``place[i]``; terminals come first in these arrays.  ``symbols``
    and ``starts`` are what is left of the text, ``passes`` where each pass's rules begin.
    """

    def __init__(self, words: np.ndarray, document: np.ndarray, terminals: int):
        left, right = [np.full(terminals, -1)], [np.full(terminals, -1)]
        length, place = np.ones(terminals, np.int64), [np.zeros(terminals, np.int64)]
        symbols, starts = words, np.arange(len(words))
        self.passes, many = [], terminals
        while len(symbols) > 1:
            at = self._chosen(symbols, document[starts], many)
            if len(at) * STALL < len(symbols) or not len(at):
                break
            pairs, first, rule = np.unique(symbols[at] * many + symbols[at + 1],
                                           return_index=True, return_inverse=True)
            left.append(pairs // many)
            right.append(pairs % many)
            place.append(starts[at[first]])
            length = np.concatenate([length, length[left[-1]] + length[right[-1]]])
            symbols = symbols.copy()
            symbols[at] = many + rule
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            symbols, starts = symbols[stay], starts[stay]
            self.passes.append(many)
            many += len(pairs)
        self.left, self.right = np.concatenate(left), np.concatenate(right)
        self.length, self.place = length, np.concatenate(place)
        self.terminals, self.symbols, self.starts = terminals, symbols, starts

    @staticmethod
    def _chosen(symbols: np.ndarray, document: np.ndarray, many: int) -> np.ndarray:
        """Where this pass replaces a pair."""
        pair = symbols[:-1] * many + symbols[1:]
        # occurrences per slot of a hash table: a bound that only orders the pairs
        bits = max(8, len(pair).bit_length() + 2)
        slot = (pair.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
        count = np.bincount(slot.astype(np.int64), minlength=1 << bits)[slot.astype(np.int64)]
        count[document[:-1] != document[1:]] = 0
        new = np.flatnonzero(np.concatenate(
            [[True], (pair[1:] != pair[:-1]) | (count[1:] != count[:-1])]))
        # a stretch of one pair (a a a a) is one candidate, replaced at every second place
        c, p = count[new], pair[new]
        before = np.concatenate([[True], (c[1:] > c[:-1]) | ((c[1:] == c[:-1]) & (p[1:] > p[:-1]))])
        after = np.concatenate([~before[1:], [True]])
        wins = before & after & (c > 1)
        sizes = np.diff(np.concatenate([new, [len(pair)]]))[wins]
        offset = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = (np.repeat(new[wins], sizes) + offset)[offset % 2 == 0]
        if not len(at):
            return at
        _, which, often = np.unique(pair[at], return_inverse=True, return_counts=True)
        return at[often[which] > 1]


def _tree(starts: np.ndarray, ends: np.ndarray, first: np.ndarray, last: np.ndarray,
          least: int) -> list[np.ndarray]:
    """(from, boundary, to) of the nodes over the symbols first .. last - 1 of each document
    that have ``least`` words."""
    nodes = []
    while len(first):
        wide = (last - first > 1) & (ends[np.maximum(last - 1, 0)] - starts[
            np.minimum(first, len(starts) - 1)] >= least)
        first, last = first[wide], last[wide]
        if not len(first):
            break
        middle = (first + last) // 2
        nodes.append(np.stack([starts[first], starts[middle], ends[last - 1]]))
        first, last = np.concatenate([first, middle]), np.concatenate([middle, last])
    return nodes


def _common(words: np.ndarray, x: np.ndarray, y: np.ndarray, room: np.ndarray) -> np.ndarray:
    """How many words from x on equal those from y on, up to ``room``."""
    out, act, step = np.zeros(len(x), np.int64), np.arange(len(x)), 16
    end = len(words) - 1
    while len(act):
        for part in np.array_split(act, max(1, len(act) * step // _CELLS)):
            done = out[part]
            col = np.arange(step)
            a = np.minimum((x[part] + done)[:, None] + col, end)
            b = np.minimum((y[part] + done)[:, None] + col, end)
            equal = (words[a] == words[b]) & (col < (room[part] - done)[:, None])
            out[part] += np.where(equal.all(1), step, equal.argmin(1))
            room[part] = np.where(equal.all(1), room[part], -1)
        act = act[room[act] >= 0]
        step = min(step * 2, _CELLS)
    return out


def _after(words: np.ndarray, mirrored: np.ndarray, nodes: np.ndarray, least: int,
           repeats: int) -> np.ndarray:
    """Runs across the boundaries of ``nodes`` that have at least half of max(least, repeats
    * period) words after the boundary: rows (node, start, end, period)."""
    n = len(words)
    gram = max(1, min(4, least // 6))         # words that are certain to occur again
    low, at, high = nodes
    found = []
    node = np.flatnonzero(at + gram <= high)
    if not len(node) or n < gram + 1:
        return np.zeros((4, 0), np.int64)
    key = words[:n - gram + 1].astype(np.uint64)
    for i in range(1, gram):
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) \
            + words[i:n - gram + 1 + i].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    kind = np.cumsum(np.concatenate([[0], (ordered[1:] != ordered[:-1]).astype(np.int64)]))
    sought = kind * n + order                 # ascending: places by gram, then position
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))

    here = rank[at[node]]
    widest = at + (high - low) // repeats
    skip_from, skip_to = np.full(len(at), 1 << 60), np.zeros(len(at), np.int64)
    while True:
        here = here + 1
        inside = here < len(order)
        node, here = node[inside], here[inside]
        place = order[here]
        ok = (kind[here] == kind[rank[at[node]]]) & (place <= np.minimum(
            widest[node], high[node] - gram))
        node, here, place = node[ok], here[ok], place[ok]
        if not len(node):
            break
        period = place - at[node]
        jump = (period >= skip_from[node]) & (period <= skip_to[node])
        if jump.any():
            far = node[jump]
            here[jump] = np.searchsorted(
                sought, kind[here[jump]] * n + at[far] + skip_to[far], "right") - 1
        do = ~jump
        if do.any():
            k, q = node[do], period[do]
            x = at[k]
            right = _common(words, x, x + q, high[k] - x - q)
            back = _common(mirrored, n - x, n - x - q, x - low[k])
            start, end = x - back, x + q + right
            skip_from[k], skip_to[k] = 2 * q, np.maximum((end - x) * 2 // 3, 2 * q - 1)
            run = (end - start >= np.maximum(least, repeats * q))
            found.append(np.stack([k, start, end, q])[:, run])
    return np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)


def _crossing(words: np.ndarray, nodes: np.ndarray, least: int, repeats: int) -> np.ndarray:
    """Runs across the boundaries of ``nodes`` (low, boundary, high)."""
    n, mirrored = len(words), np.ascontiguousarray(words[::-1])
    a = _after(words, mirrored, nodes, least, repeats)
    b = _after(mirrored, words, n - nodes[::-1], least, repeats)
    return np.concatenate([a, np.stack([b[0], n - b[2], n - b[1], b[3]])], axis=1)


def _translated(g: Grammar, rule: np.ndarray, runs: np.ndarray) -> list[np.ndarray]:
    """Runs (start, end, period) relative to their nonterminals ``rule``, at all places of
    these in the derivation."""
    own = np.zeros(len(g.length), np.int64)
    np.add.at(own, rule, 1)
    by_rule = np.argsort(rule, kind="stable")
    runs, begin = runs[:, by_rule], np.cumsum(own) - own
    holds = own > 0
    for a, b in zip(g.passes, [*g.passes[1:], len(g.length)]):
        holds[a:b] |= holds[g.left[a:b]] | holds[g.right[a:b]]
    out, symbol, start = [], g.symbols, g.starts
    while True:
        there = holds[symbol]
        symbol, start = symbol[there], start[there]
        if not len(symbol):
            return out
        many = own[symbol]
        which = np.repeat(begin[symbol], many) + np.arange(many.sum()) \
            - np.repeat(np.cumsum(many) - many, many)
        shift = np.repeat(start, many)
        out.append(np.stack([runs[0, which] + shift, runs[1, which] + shift, runs[2, which]]))
        left, right = g.left[symbol], g.right[symbol]
        symbol = np.concatenate([left, right])
        start = np.concatenate([start, start + g.length[left]])


def _merged(found: np.ndarray) -> np.ndarray:
    """Maximal intervals (start, end, period), each once with its smallest period."""
    start, end, period = found[:, np.lexsort((found[2], found[1], found[0]))]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    if len(start):
        group = np.cumsum(np.concatenate([[0], (period[1:] != period[:-1]).astype(np.int64)]))
        reach = group * (end.max() + 1) + end
        covered = np.concatenate([[False], np.maximum.accumulate(reach)[:-1] >= reach[1:]])
        start, end, period = start[~covered], end[~covered], period[~covered]
    order = np.lexsort((period, start))
    return np.stack([start[order], end[order], period[order]])


def runs_of(documents: list[np.ndarray], terminals: int, least: int = LEAST,
            repeats: int = REPEATS) -> np.ndarray:
    """Runs (start, end, period) in the concatenation of documents of word ids below
    ``terminals``, sorted by start, then period; no run spans two documents."""
    if repeats < 3:
        raise ValueError("repeats must be 3 or more")
    sizes = np.array([len(d) for d in documents], np.int64)
    none = np.zeros((3, 0), np.int64)
    if not sizes.sum():
        return none
    words = np.concatenate(documents)
    g = Grammar(words, np.repeat(np.arange(len(sizes)), sizes), terminals)
    edges = np.searchsorted(g.starts, np.concatenate([[0], np.cumsum(sizes)]))
    nodes = _tree(g.starts, g.starts + g.length[g.symbols], edges[:-1], edges[1:], least)
    rules = np.flatnonzero(g.length >= least)
    low = g.place[rules]
    nodes = np.concatenate([np.stack([low, low + g.length[g.left[rules]], low + g.length[rules]]),
                            *nodes], axis=1)
    node, *runs = _crossing(words, nodes, least, repeats)
    runs = np.stack(runs)
    inner = node < len(rules)
    rule = rules[node[inner]]
    relative = runs[:, inner].copy()
    relative[:2] -= g.place[rule]
    return _merged(np.concatenate([runs[:, ~inner], *_translated(g, rule, relative)], axis=1))


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _blocks(texts: pa.Array, ids: list) -> Iterator[tuple[list, list[bytes]]]:
    """Rows of a batch in blocks of about BLOCK_BYTES."""
    block, size = ([], []), 0
    for i, text in zip(ids, texts):
        data = text.as_py().encode("utf-8")
        if block[0] and size + len(data) > BLOCK_BYTES:
            yield block
            block, size = ([], []), 0
        block[0].append(i)
        block[1].append(data)
        size += len(data)
    if block[0]:
        yield block


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  least: int = LEAST, repeats: int = REPEATS,
                  change: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per document: __id, __runs (start, length, period of each run, sorted by start,
    then period) and __collapsed, the words joined by one space without those that some run
    holds after its first period.  ``change`` may replace the words of a document first."""
    rows = docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("__text"))
    kind = rows.schema["__id"].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                                   ("period", pa.int64())]))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_type = batch.schema.field(0).type
            for ids, texts in _blocks(batch.column(1), batch.column(0).to_pylist()):
                known, words, documents = _Ids(), [], []
                for i, data in zip(ids, texts):
                    # bytes.split() splits at 0x20 and 0x09-0x0D
                    own = data.split()
                    if change:
                        own = change(i, own)
                    words.append(own)
                    documents.append(np.fromiter(map(known.__getitem__, own), np.int64, len(own)))
                start, end, period = runs_of(documents, len(known), least, repeats)
                edges = np.cumsum([0, *map(len, documents)])
                owner = np.searchsorted(start, edges)
                mark = np.zeros(edges[-1] + 1, np.int64)
                np.add.at(mark, start + period, 1)
                np.add.at(mark, end, -1)
                keep = np.cumsum(mark) == 0
                lists, texts_out = [], []
                for d, own in enumerate(words):
                    a, b = owner[d], owner[d + 1]
                    lists.append([{"start": s, "length": n, "period": p} for s, n, p in zip(
                        (start[a:b] - edges[d]).tolist(), (end[a:b] - start[a:b]).tolist(),
                        period[a:b].tolist())])
                    if b > a:
                        own = compress(own, keep[edges[d]:edges[d + 1]].tolist())
                    texts_out.append(b" ".join(own))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, id_type), pa.array(lists, run_type),
                     pa.array(texts_out, pa.binary()).cast(pa.string())],
                    ["__id", "__runs", "__collapsed"])

    return per_batch(rows, solve, f"__id {kind}, "
                     "__runs array<struct<start:bigint,length:bigint,period:bigint>>, "
                     "__collapsed string")


def planted(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The contract's change: in documents with h % 10 = 0 (h the CRC-32 of the decimal id)
    the words from a on repeat p original words.  No id: no change."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli of the run with the greatest
    exponent, runs_sha256, collapsed_sha256 of every document."""
    out = periodic_runs(read_table(spark, sf_dir, "documents"), change=planted)
    best = F.aggregate(
        "__runs", F.get("__runs", F.lit(0)),
        lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    lines = F.concat_ws("", F.transform("__runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n"))))
    return out.withColumn("__best", best).select(
        F.col("__id").alias("doc_id"), F.size("__runs").cast("long").alias("n_runs"),
        F.col("__best.start").alias("start"), F.col("__best.length").alias("length"),
        F.col("__best.period").alias("period"),
        F.expr("1000 * __best.length div __best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("__collapsed", 256).alias("collapsed_sha256"))


# A run of 24 words and three periods matches itself one period on at 16 places in a row or
# more, so runs are islands of equal 16-word stretches at one distance.
OP11_SQL = r"""
WITH RECURSIVE tab AS (
  SELECT i::BIGINT AS i, i::BIGINT AS v, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM tab WHERE k < 8),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         doc_id::VARCHAR AS s
  FROM documents),
crc AS (
  SELECT r, s, 0 AS p, 4294967295::BIGINT AS c FROM d WHERE s IS NOT NULL
  UNION ALL
  SELECT r, s, p + 1, xor(c >> 8, t.v) FROM crc JOIN tab t ON t.k = 8 AND t.i = (xor(c, ascii(s[p + 1])) & 255)
  WHERE p < length(s)),
h AS (SELECT r, xor(c, 4294967295) AS h FROM crc WHERE p = length(s)),
a AS (
  SELECT d.r, doc_id, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 AS g
  FROM d LEFT JOIN h ON h.r = d.r),
b AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
tok AS (
  SELECT r, i, w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] AS word
  FROM (SELECT r, w, a, p, unnest(range(n)) AS i FROM b)),
m AS (SELECT r, list(word ORDER BY i) AS w FROM tok GROUP BY r),
gram AS (
  SELECT r, i, n, array_to_string(w[i + 1:i + 16], ' ') AS g
  FROM (SELECT r, w, len(w) AS n, unnest(range(len(w) - 15)) AS i FROM m WHERE len(w) >= 24)),
pairs AS (
  SELECT x.r, x.i, y.i - x.i AS q
  FROM gram x JOIN gram y ON x.r = y.r AND x.g = y.g AND y.i > x.i AND y.i - x.i <= x.n // 3),
island AS (
  SELECT r, q, min(i) AS s, max(i) + 16 + q AS e
  FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM pairs)
  GROUP BY r, q, k),
run AS (SELECT r, s, e - s AS l, min(q) AS q FROM island WHERE e - s >= greatest(24, 3 * q) GROUP BY r, s, e),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM run),
left_over AS (
  SELECT tok.r, string_agg(word, ' ' ORDER BY tok.i) AS t
  FROM tok LEFT JOIN gone ON gone.r = tok.r AND gone.i = tok.i WHERE gone.r IS NULL GROUP BY tok.r),
best AS (
  SELECT x.r, x.s, x.l, x.q FROM run x
  WHERE NOT EXISTS (
    SELECT 1 FROM run y
    WHERE y.r = x.r AND (y.l * x.q > x.l * y.q OR (y.l * x.q = x.l * y.q AND (y.s, y.q) < (x.s, x.q))))),
listed AS (
  SELECT r, count(*) AS k, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM run GROUP BY r)
SELECT b.doc_id, coalesce(listed.k, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.l::BIGINT AS length,
       best.q::BIGINT AS period, (1000 * best.l // best.q)::BIGINT AS exponent_milli,
       sha256(coalesce(listed.t, '')) AS runs_sha256, sha256(coalesce(left_over.t, '')) AS collapsed_sha256
FROM b LEFT JOIN listed ON listed.r = b.r LEFT JOIN best ON best.r = b.r LEFT JOIN left_over ON left_over.r = b.r
"""
