"""Removal of lines that many documents share, by a sharded minimal perfect hash.

The key of a line is its text without white space at its ends, A-Z lower-cased,
known by a hash of 128 bits. Keys are counted over all documents, one count per
document and key, pre-aggregated before the shuffle. The distinct hashes that stand
in two documents or more are dealt into shards of about ``SHARD_KEYS``; each
shard builds a minimal perfect hash over its own (levels of bits: keys that meet no
other key on a level get their place there, the rest go to the next level), which
points into arrays of fingerprints, counts and greatest ids. A line whose
fingerprint is not the one at its place stands in one document only.

Documents never join lines: the hash of each line is sent to its shard, where the
arrays answer it, and only answers that remove a line come back, as line numbers.
Shards with many probes get copies of their arrays, one for each ``SLICE_PROBES``, so
a line with a third of all rows does not end in one task.

Cases: a null or empty text is one empty line; a text of which every line goes is
empty; null texts stay null; repeated rows are documents like others; null ids are
below all ids, and if no document of a key has an id it stays in all of them;
documents with the greatest id of a key all keep it. Further columns stay; those named
like a result are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from oreline.llm.common import SPACES, discard, kept, require, scratch, stored

LEAST_CHARS = 20
LEAST_DOCUMENTS = 3
SHARD_KEYS = 1 << 16
SLICE_PROBES = 1 << 17
ROOM = 2  # bits a key on each level of a perfect hash
BATCH_LINES = 50_000

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SPACE_BYTES = SPACES.encode()


def line_key(line: bytes) -> bytes:
    return line.strip(_SPACE_BYTES).translate(_LOWER)


def long_enough(key: bytes, least: int) -> bool:
    """Whether a key has ``least`` code points or more."""
    if len(key) < least or len(key) >= 4 * least or key.isascii():
        return len(key) >= least
    return sum((b & 0xC0) != 0x80 for b in key) >= least


def _hash(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _halves(digests: list[bytes]) -> np.ndarray:
    """Rows of two signed numbers, the halves of each digest."""
    return np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)


class LineIndex:
    """A minimal perfect hash of distinct 128-bit hashes, with an array row for each."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, keepers: np.ndarray, named: np.ndarray):
        self.levels: list[np.ndarray] = []
        place = np.empty(len(hashes), np.int64)
        rest, taken = np.arange(len(hashes)), 0
        while len(rest):
            bits = np.zeros(max(64, ROOM * len(rest)), bool)
            at = self._at(hashes[rest], len(self.levels), len(bits))
            alone = np.bincount(at, minlength=len(bits))[at] == 1
            bits[at[alone]] = True
            rank = np.cumsum(bits) - 1
            place[rest[alone]] = taken + rank[at[alone]]
            taken += int(alone.sum())
            self.levels.append(np.packbits(bits))
            rest = rest[~alone]
        order = np.argsort(place)
        self.fingerprints = hashes[order, 1].copy()
        self.counts = counts[order].astype(np.min_scalar_type(int(counts.max(initial=0))))
        self.keepers, self.named = keepers[order], named[order]
        self._ready()

    @staticmethod
    def _at(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        x = hashes[:, 0].view(np.uint64) ^ (hashes[:, 1].view(np.uint64) >> np.uint64(7))
        x = (x + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)

    def _ready(self) -> None:
        """Bits and ranks as arrays, for many look-ups."""
        self.bits, self.ranks, taken = [], [], 0
        rest = len(self.fingerprints)
        for packed in self.levels:
            bits = np.unpackbits(packed, count=max(64, ROOM * rest)).astype(bool)
            ranks = np.cumsum(bits) - 1 + taken
            found = int(bits.sum())
            taken, rest = taken + found, rest - found
            self.bits.append(bits)
            self.ranks.append(ranks)

    def __getstate__(self) -> dict:
        names = ("levels", "fingerprints", "counts", "keepers", "named")
        return {n: getattr(self, n) for n in names}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._ready()

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash in the arrays, -1 for one that is not in the index."""
        out = np.full(len(hashes), -1, np.int64)
        rest = np.arange(len(hashes))
        for level, (bits, ranks) in enumerate(zip(self.bits, self.ranks)):
            at = self._at(hashes[rest], level, len(bits))
            hit = bits[at]
            out[rest[hit]] = ranks[at[hit]]
            rest = rest[~hit]
        known = out >= 0
        known[known] = self.fingerprints[out[known]] == hashes[known, 1]
        return np.where(known, out, -1)


def _line_hashes(data: bytes, least: int) -> tuple[list[int], list[bytes]]:
    """Numbers and hashes of the lines of a text that are long enough."""
    places, out = [], []
    for k, line in enumerate(data.split(b"\n")):
        if len(line) >= least:
            key = line_key(line)
            if long_enough(key, least):
                places.append(k)
                out.append(_hash(key))
    return places, out


def line_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_CHARS) -> DataFrame:
    """``(hi, lo, n, lines, keeper)`` of each distinct line: documents, lines, greatest id."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests, times, owners = batch.column("doc_id"), [], [], []

            def table() -> pa.RecordBatch:
                halves = _halves(digests)
                columns = [
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    pa.array(times, pa.int64()),
                    ids.take(pa.array(owners, pa.int64())),
                ]
                return pa.RecordBatch.from_arrays(columns, names=["hi", "lo", "times", "doc_id"])

            for k, data in enumerate(batch.column("body").to_pylist()):
                seen: dict[bytes, int] = {}
                for digest in _line_hashes(data or b"", least)[1]:
                    seen[digest] = seen.get(digest, 0) + 1
                digests.extend(seen)
                times.extend(seen.values())
                owners.extend([k] * len(seen))
                if len(digests) > BATCH_LINES:
                    yield table()
                    digests, times, owners = [], [], []
            if digests:
                yield table()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("body"))
    lines = rows.mapInArrow(emit, "hi long, lo long, times long, doc_id long")
    return lines.groupBy("hi", "lo").agg(
        F.count(F.lit(1)).alias("n"), F.sum("times").alias("lines"), F.max("doc_id").alias("keeper")
    )


def index(counted: DataFrame) -> tuple[DataFrame, int]:
    """``(shard, slices, n_keys, packed)`` of ``line_counts``, and the number of shards."""
    again = stored(counted.where("n > 1"), "lines")
    shards = max(1, -(-again.count() // SHARD_KEYS))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["hi", "lo"])
        made = LineIndex(*[group[c].to_numpy() for c in (["hi", "lo"], "n", "keeper", "named")])
        slices = max(1, -(-int(group["lines"].sum()) // SLICE_PROBES))
        packed = pickle.dumps(made, protocol=5)
        return pd.DataFrame(
            {"shard": group["shard"].iloc[:1], "slices": slices, "n_keys": len(group), "packed": [packed]}
        )

    dealt = again.withColumns(
        {
            "shard": F.expr(f"pmod(hi, {shards}L)"),
            "named": F.col("keeper").isNotNull(),
            "keeper": F.coalesce("keeper", F.lit(0)),
        }
    )
    packed = dealt.groupBy("shard").applyInPandas(
        pack, "shard long, slices long, n_keys long, packed binary"
    )
    packed = stored(packed, "index")
    discard(again)
    return packed, shards


def probes(
    docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_CHARS
) -> DataFrame:
    """``(shard, hi, lo, doc_id, mark, line)`` of every line that is long enough."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, lines, owners = [], [], []

            def table() -> pa.RecordBatch:
                halves, rows = _halves(digests), pa.array(owners, pa.int64())
                columns = [
                    pa.array(halves[:, 0] % shards),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    batch.column("doc_id").take(rows),
                    batch.column("mark").take(rows),
                    pa.array(lines, pa.int32()),
                ]
                names = ["shard", "hi", "lo", "doc_id", "mark", "line"]
                return pa.RecordBatch.from_arrays(columns, names=names)

            for k, data in enumerate(batch.column("body").to_pylist()):
                places, found = _line_hashes(data or b"", least)
                digests.extend(found)
                lines.extend(places)
                owners.extend([k] * len(found))
                if len(digests) > BATCH_LINES:
                    yield table()
                    digests, lines, owners = [], [], []
            if digests:
                yield table()

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        _mark(F.col(text)).alias("mark"),
        F.col(text).cast("binary").alias("body"),
    )
    return rows.mapInArrow(emit, "shard long, hi long, lo long, doc_id long, mark long, line int")


def _mark(text: F.Column) -> F.Column:
    """Tells texts of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def answers(asked: DataFrame, packed: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``(doc_id, mark, line)`` of the probed lines that go.

    Probes and arrays meet by shard and slice, the arrays first; a task holds one
    shard's arrays and one batch of probes at a time.
    """
    # At most one row a shard; Spark broadcasts it if it is small.
    slices = packed.where("slices > 1").select(F.col("shard").alias("of"), "slices")
    dealt = asked.join(slices, F.col("shard") == F.col("of"), "left")
    spread = F.expr("pmod(xxhash64(mark, doc_id), coalesce(slices, 1L))")
    none = F.lit(None).cast("binary").alias("packed")
    dealt = dealt.select("shard", spread.alias("slice"), "hi", "lo", "doc_id", "mark", "line", none)
    copies = packed.select(
        "shard",
        F.explode(F.expr("sequence(0L, slices - 1L)")).alias("slice"),
        *[F.lit(None).cast(kind).alias(c) for c, kind in dealt.dtypes[2:-1]],
        "packed",
    )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = None, None
        for batch in batches:
            shard, part = (batch.column(c).to_numpy() for c in ("shard", "slice"))
            heads = np.flatnonzero(batch.column("packed").is_valid().to_numpy(zero_copy_only=False))
            edges = [0, *heads.tolist(), len(batch)]
            for k, (begin, end) in enumerate(zip(edges, edges[1:])):
                if k:
                    held = pickle.loads(batch.column("packed")[begin].as_py())
                    at, begin = (shard[begin], part[begin]), begin + 1
                # Probes of a shard without a repeated line have no arrays.
                begin_, own = begin, (0, 0)
                if held is not None:
                    own = np.flatnonzero((shard[begin:end] == at[0]) & (part[begin:end] == at[1]))
                    own = (own[0], own[-1] + 1) if len(own) else (0, 0)
                if own[1] > own[0]:
                    some = batch.slice(begin_ + own[0], own[1] - own[0])
                    yield judged(held, some)

    def judged(held: LineIndex, some: pa.RecordBatch) -> pa.RecordBatch:
        hashes = np.stack([some.column(c).to_numpy() for c in ("hi", "lo")], axis=1)
        row = held.find(hashes)
        ids = some.column("doc_id")
        given = ids.is_valid().to_numpy(zero_copy_only=False)
        numbers = ids.fill_null(0).to_numpy()
        keeps = np.where(held.named[row], given & (numbers == held.keepers[row]), ~given)
        gone = (row >= 0) & (held.counts[row] >= least_documents) & ~keeps
        return some.select(["doc_id", "mark", "line"]).filter(pa.array(gone))

    met = dealt.union(copies).repartition("shard", "slice")
    met = met.sortWithinPartitions("shard", "slice", F.col("packed").isNull())
    return met.mapInArrow(look, "doc_id long, mark long, line int")


def drop_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_chars: int = LEAST_CHARS,
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """``docs`` with shortened texts, ``n_lines`` (before), ``n_dropped`` and ``kept_sha256``."""
    require(docs, doc_id, text)
    if least_documents < 2:
        raise ValueError("a line of one document is never dropped")
    added = ["n_lines", "n_dropped", "kept_sha256"]
    columns = [c for c in docs.columns if c not in added or c in (doc_id, text)]
    with scratch(docs.sparkSession):
        packed, shards = index(line_counts(docs, doc_id, text, least_chars))
        gone = answers(probes(docs, shards, doc_id, text, least_chars), packed, least_documents)
        lines = gone.groupBy("doc_id", "mark").agg(F.collect_set("line").alias("lines"))
        lines = kept(lines.toDF("of", "with", "lines"), "answers")
    own = F.struct(*[F.col(f"`{c}`") for c in columns if c != text]).alias("own")
    rows = docs.select(
        own,
        F.col(doc_id).cast("long").alias("key"),
        _mark(F.col(text)).alias("mark"),
        F.col(text).cast("binary").alias("body"),
    )
    both = rows.join(lines, F.expr("key <=> of and mark = with"), "left").select("own", "body", "lines")

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, lost, digests = [], [], [], []
            for data, drop in zip(batch.column("body").to_pylist(), batch.column("lines").to_pylist()):
                n, out = (data or b"").count(b"\n") + 1, data
                if drop:
                    drop = set(drop)
                    out = b"\n".join([x for k, x in enumerate(data.split(b"\n")) if k not in drop])
                texts.append(out)
                counts.append(n)
                lost.append(len(drop or ()))
                digests.append(hashlib.sha256(out or b"").hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("own"),
                    pa.array(texts, pa.binary()),
                    pa.array(counts, pa.int64()),
                    pa.array(lost, pa.int64()),
                    pa.array(digests, pa.string()),
                ],
                names=["own", "body", *added],
            )

    kinds = (BinaryType(), LongType(), LongType(), StringType())
    new = [StructField(c, kind) for c, kind in zip(["body", *added], kinds)]
    out = both.mapInArrow(shorten, StructType([rows.schema["own"], *new]))
    shown = [F.col("body").cast("string").alias(c) if c == text else F.col(f"own.`{c}`") for c in columns]
    return out.select(*shown, *added)
