"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For a piece of bytes b the table ``last`` holds, for every prefix b[:i], the last
token of that prefix's encoding.  A sequence of tokens is what BPE produces exactly
when every adjacent pair is (neither token's formation is crossed by an earlier merge
over their boundary), so the last token of b[:i] is the one vocabulary entry t that
ends at i and forms a valid pair with ``last`` of b[:i - len(t)]; it is unique.  The
encoding of any prefix is read off backwards.  Hence

* ``append`` extends the table and never revisits a prefix, and
* ``replace`` recomputes from the edit until the table agrees with the old one over as
  many positions as the longest token has bytes; from there on it is the old table.

Texts are split with the vocabulary's public pattern first and each match is encoded
separately; no special tokens.  Defined results: a NULL text counts as empty, an empty
text has no ids; a text or a single match may have any length (memory: one integer per
byte of the match); repeated rows give repeated results; other columns pass unread.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import per_batch, text_or_empty

# The public split pattern, and the same pattern for texts whose characters
# are all below U+0100 (there \p{L}, \p{N} and \s are these characters).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
LATIN_PATTERN = (f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+"
                 f"|[{_S}]+(?![^{_S}])|[{_S}]+")

CACHE_PIECES = 700_000     # encoded pieces remembered per worker
CACHE_PAIRS = 1_000_000    # pair verdicts remembered per worker
STAGE_PIECES = STAGE_PAIRS = 1 << 16   # by a task of a stage, whose workers other stages reuse
LONGEST_CACHED = 48        # characters; longer matches are encoded afresh

_split_any = regex.compile(PATTERN).findall
_split_latin = re.compile(LATIN_PATTERN).findall


def split_text(text: str) -> list[str]:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _split_any(text)
    return _split_latin(text)


def read_ranks(path: str) -> dict[bytes, int]:
    """A public rank file: one ``base64(token) rank`` per line."""
    with open(path, "rb") as f:
        return parse_ranks(f.read())


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


class Vocabulary:
    """Ranks with the formation tree of each token and the pair verdicts."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self._left: dict[int, list[int]] = {}
        self._right: dict[int, list[int]] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self.most_pairs = CACHE_PAIRS

    def halves(self, tid: int) -> tuple[int, int] | None:
        """The two tokens whose merge forms ``tid`` (None: a single byte)."""
        data = self.token[tid]
        if len(data) == 1:
            return None
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 2:
            best = min((self.ranks.get(parts[i] + parts[i + 1], tid), i)
                       for i in range(len(parts) - 1))
            if best[0] >= tid:
                raise ValueError(f"token {tid} is not formed by merges of lower rank")
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def _edge(self, tid: int, side: int, memo: dict[int, list[int]]) -> list[int]:
        """Tokens that lie at one edge of ``tid`` while it forms, first to last."""
        found = memo.get(tid)
        if found is None:
            two = self.halves(tid)
            found = memo[tid] = ([] if two is None else self._edge(two[side], side, memo)) + [tid]
        return found

    def forget(self) -> None:
        self._pairs.clear()
        self._left.clear()
        self._right.clear()

    def valid_pair(self, a: int, b: int) -> bool:
        """Whether no merge crosses the boundary when the bytes of a, b are encoded.

        Merges happen in rank order, at equal rank from the left.  While a and b form,
        the tokens beside the boundary are a's right-edge and b's left-edge tokens; a
        merge of the two present crosses it if its turn comes before either grows.
        """
        if len(self._pairs) >= self.most_pairs:
            self._pairs.clear()
        verdict = self._pairs[a, b] = self._uncrossed(self._edge(a, 1, self._right),
                                                      self._edge(b, 0, self._left))
        return verdict

    def extend(self, data: bytes, last: list[int], stop: int | None = None) -> None:
        """Fill ``last`` (the table of ``data``) up to prefix length ``stop``."""
        rank, known, longest = self.ranks.get, self._pairs.get, self.longest
        for end in range(len(last), (len(data) if stop is None else stop) + 1):
            for start in range(end - longest if end > longest else 0, end):
                tid = rank(data[start:end])
                if tid is not None:
                    if not start:
                        break
                    before = last[start]
                    verdict = known((before, tid))
                    if verdict or verdict is None and self.valid_pair(before, tid):
                        break
            else:
                raise ValueError("the ranks lack a single byte")
            last.append(tid)

    def _uncrossed(self, left: list[int], right: list[int]) -> bool:
        token, ranks = self.token, self.ranks
        never = len(ranks) + (1 << 32)
        i = j = 0
        while True:
            grows_left = left[i + 1] if i + 1 < len(left) else never
            grows_right = right[j + 1] if j + 1 < len(right) else never
            joined = ranks.get(token[left[i]] + token[right[j]])
            if joined is not None and joined < grows_left and joined <= grows_right:
                return False
            if grows_left == never and grows_right == never:
                return True
            if grows_left <= grows_right:
                i += 1
            else:
                j += 1


class PrefixTable:
    """``last`` token of every prefix of one piece of bytes."""

    def __init__(self, vocab: Vocabulary, data: bytes = b""):
        self.vocab, self.data, self.last = vocab, b"", [-1]
        self.append(data)

    def append(self, data: bytes) -> "PrefixTable":
        self.data += data
        self.vocab.extend(self.data, self.last)
        return self

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Replace data[start:stop] by ``new``; returns the number of positions recomputed."""
        old_last, shift = self.last, len(new) - (stop - start)
        data = self.data[:start] + new + self.data[stop:]
        last, agreed = old_last[:start + 1], 0
        for end in range(start + 1, len(data) + 1):
            self.vocab.extend(data, last, end)
            if end >= start + len(new):
                agreed = agreed + 1 if last[end] == old_last[end - shift] else 0
                if agreed >= self.vocab.longest:
                    last += old_last[end - shift + 1:]
                    break
        done = min(end, len(data)) - start if len(data) > start else 0
        self.data, self.last = data, last
        return done

    def ids(self, end: int | None = None) -> list[int]:
        """Encoding of the prefix of length ``end`` (default: all)."""
        out, at = [], len(self.data) if end is None else end
        token, last = self.vocab.token, self.last
        while at:
            tid = last[at]
            out.append(tid)
            at -= len(token[tid])
        out.reverse()
        return out


class Encoder(dict):
    """Piece -> tuple of ids, remembered; ``encode`` and ``decode`` of whole texts."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.vocab = Vocabulary(ranks)

    def piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode("utf-8")
        whole = self.vocab.ranks.get(data)
        return (whole,) if whole is not None else tuple(PrefixTable(self.vocab, data).ids())

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.piece(piece)
        if len(piece) <= LONGEST_CACHED:
            if len(self) >= self.most_pieces:
                self.clear()
            self[piece] = ids
        return ids

    most_pieces = CACHE_PIECES

    def remember(self, pieces: int, pairs: int) -> None:
        self.most_pieces, self.vocab.most_pairs = pieces, pairs

    def forget(self) -> None:
        """Drop what was remembered: workers outlive tasks, and other stages need the memory."""
        self.clear()
        self.vocab.forget()

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, split_text(text))))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocab.token.__getitem__, ids))


def _encoder_of(ranks, cache={}) -> Encoder:
    """One encoder per worker process and rank file (a broadcast of about 1 MB)."""
    data = ranks.value
    key = hashlib.sha256(data).digest()
    if key not in cache:
        cache.clear()
        cache[key] = Encoder(parse_ranks(data))
    return cache[key]


def _ranks_broadcast(df: DataFrame, ranks_path: str):
    with open(ranks_path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, ranks_path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """Every column of ``docs`` plus ``out`` (array<int>): the ids of the whole text.

    A column already named ``out`` is replaced."""
    ranks = _ranks_broadcast(docs, ranks_path)
    docs = docs.drop(out)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder_of(ranks)
        enc.remember(STAGE_PIECES, STAGE_PAIRS)
        for batch in batches:
            for part in _slices(batch, at):
                ids = pa.array([enc.encode(t or "") for t in part.column(at).to_pylist()],
                               pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], [*part.schema.names, out])
        enc.forget()

    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    return per_batch(docs, run, schema)


def _slices(batch: pa.RecordBatch, at: int, most: int = 2 << 20):
    """Parts of a batch that hold about ``most`` bytes of column ``at`` each."""
    rows = max(1, min(batch.num_rows, batch.num_rows * most // max(1, batch.column(at).nbytes)))
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def digests(docs: DataFrame, ranks_path: str) -> DataFrame:
    """Query form: per document the number of ids, SHA-256 of the decimal ids joined by one
    space, and SHA-256 of the bytes decoded from those ids.  Encoding, decoding and hashing
    happen in one pass, so no id array leaves the task."""
    ranks = _ranks_broadcast(docs, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder_of(ranks)
        enc.remember(CACHE_PIECES, CACHE_PAIRS)
        decimal = {i: str(i) for i in enc.vocab.token}.__getitem__
        for batch in batches:
            n, shas, back = [], [], []
            for text in batch.column(1):
                ids = enc.encode(text.as_py())
                n.append(len(ids))
                shas.append(hashlib.sha256(" ".join(map(decimal, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(enc.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(shas), pa.array(back)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col("doc_id"), text_or_empty().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return per_batch(rows, run, f"doc_id {kind}, n_tokens long, ids_sha256 string, "
                                "decoded_sha256 string")


def bpe_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All input columns, ``ids`` and ``n_tokens``."""
    import public_tokenizers
    out = encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return out.withColumn("n_tokens", F.size("ids").cast("long"))
