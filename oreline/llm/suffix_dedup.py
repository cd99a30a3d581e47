"""Removal of long byte strings that repeat anywhere in a corpus.

A corpus has no place for one suffix array, so its windows are first brought
together by content. The least hash of the first three quarters of a window's places
is its anchor; equal windows have equal anchors, at the same place, and share
the ``core`` that every window of that anchor covers, and the ``span`` is what they
cover together. Only cores that occur twice go on; all windows of a repeated span
repeat. Where spans of a core differ, one of each is cut into pieces of ``PIECE``
windows; a piece becomes a short string (left flank, one symbol for the core of these
windows, right flank) and a suffix array over those strings finds which windows repeat.

The suffix array is built by linear grouping: suffixes are grouped by their
Lyndon prefix, groups are processed in descending order with pointers to the
previous smaller suffix, and the order inside the groups follows from one pass.

Groups are counted before anything is joined, and copies of a span that lie together are
packed into one row. A core with more than
``SPLIT_ABOVE`` surroundings, as around a passage that many documents quote, is
split: each half of its windows has bytes of one flank in common, which join the core.
Halves are counted and split again until they fit the array or are one window, which
is its core.

Cases: null texts are empty; texts shorter than the length lose nothing; repeated
rows are copies of each other; null and repeated ids are told apart by the text's
hash; removed bytes may cut a character, of which the rest is dropped from the
text (the bytes are kept as they are in the digest). Further columns stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from oreline.llm.common import discard, kept, meet_totals, require, scratch, stored

GRAM = 16  # bytes hashed at a place
PIECE = 25
SPLIT_ABOVE = 128
SEGMENT = 1 << 18
SYMBOLS = 1 << 16  # of one suffix array, unless one group has more
PIECES_PER_TASK = 4096
PACK_ROWS = 128

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_HASH = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def suffix_array(text: list[int]) -> list[int]:
    """Suffix order of ``text``, built by linear grouping of Lyndon prefixes."""
    n = len(text)
    if n == 0:
        return []
    text = [*text, min(text) - 1]  # a least symbol ends it
    n += 1
    symbols = {symbol: g for g, symbol in enumerate(sorted(set(text)))}
    group = [symbols[symbol] for symbol in text]
    members: list[list[int]] = [[] for _ in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    lower = list(range(-1, len(symbols) - 1))
    upper = list(range(1, len(symbols) + 1))
    previous, done, descending = [-1] * n, [False] * n, []
    current = len(symbols) - 1
    while current >= 0:
        inside = [i for i in members[current] if group[i] == current]
        members[current] = inside
        if inside:
            descending.append(current)
        for i in inside:
            done[i] = True
        times: dict[int, int] = {}
        for i in inside:  # in text order, so pointers of this group are ready
            p = i - 1
            while p >= 0 and done[p]:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        # What a suffix of this group follows rises above the rest of its own group,
        # the higher the more often it is followed.
        raised: dict[tuple[int, int], list[int]] = {}
        for p in sorted(times):
            raised.setdefault((times[p], group[p]), []).append(p)
        for many, old in sorted(raised, reverse=True):
            new = len(members)
            members.append(raised[many, old])
            lower.append(old)
            upper.append(upper[old])
            lower[upper[old]] = new
            upper[old] = new
            for p in raised[many, old]:
                group[p] = new
        current = lower[current]
    start, total = {}, 0
    for g in reversed(descending):
        start[g] = total
        total += len(members[g])
    order, placed = [-1] * n, [False] * n
    order[0], placed[n - 1] = n - 1, True
    for k in range(n):
        j = order[k] - 1
        while j >= 0 and not placed[j]:
            place = start[group[j]]
            order[place] = j
            start[group[j]] = place + 1
            placed[j] = True
            j = previous[j]
    return order[1:]


class _Hashes:
    """Hash of any part of a byte string: polynomial, modulo 2**64, mixed."""

    _powers = np.ones(1, np.uint64)
    _inverses = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(_Hashes._powers) < n:
            size = max(n, SEGMENT * 2)
            for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
                grown = np.full(size, base, np.uint64)
                grown[0] = 1
                setattr(_Hashes, name, np.cumprod(grown))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(_BYTE_HASH[data] * self._powers[: n - 1], out=self.sums[1:])

    def grams(self, width: int, n: int) -> np.ndarray:
        """Hashes of the first ``n`` strings of ``width`` bytes."""
        x = self.sums[width : width + n] - self.sums[:n]
        x *= self._inverses[:n]
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (self.sums[end] - self.sums[start]) * self._inverses[start]
        x = x + (end - start).astype(np.uint64) * np.uint64(_ODD)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


_ODD = 0xC2B2AE3D27D4EB4F


def anchors(data: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Anchors of the windows of ``length`` bytes of one text.

    ``at`` is the place of the anchor, ``low`` and ``high`` the first and last
    start of its windows, ``core`` and ``span`` the hashes of what each of these
    windows has and of what they have together.
    """
    search = 3 * length // 4
    gram = min(GRAM, length - search)
    parts = []
    for first in range(0, len(data) - length + 1, SEGMENT):
        piece = data[first : first + SEGMENT + length - 1]
        windows = len(piece) - length + 1
        hashes = _Hashes(piece)
        rank = hashes.grams(gram, windows + search - 1)
        rank &= np.uint64(0xFFFFFFFF00000000)
        rank |= np.arange(len(rank), dtype=np.uint64)
        table = np.full(-(-len(rank) // search) * search, 2**64 - 1, np.uint64)
        table[: len(rank)] = rank
        table = table.reshape(-1, search)
        ahead = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()[:windows]
        behind = np.minimum.accumulate(table, axis=1).ravel()[search - 1 : search - 1 + windows]
        at = (np.minimum(ahead, behind) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        low = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        high = np.r_[low[1:], windows] - 1
        at = at[low]
        core = hashes.of(at, at + length - search + 1)
        span = hashes.of(low, high + length) + _BYTE_HASH[0] * (at - low).astype(np.uint64)
        parts.append((at + first, low + first, high + first, core, span))
    joined = [np.concatenate(x) for x in zip(*parts)] if parts else [np.empty(0, np.int64)] * 5
    at, low, high, core, span = joined
    # An anchor whose windows lie on both sides of a segment's edge is one row.
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]][: len(at)])
    last = np.r_[first[1:], len(at)][: len(first)] - 1
    at, low, high, core, span = at[first], low[first], high[last], core[first], span[first]
    for k in np.flatnonzero(first != last):
        piece = data[low[k] : high[k] + length]
        whole = _Hashes(piece).of(np.array([0]), np.array([len(piece)]))
        span[k] = (whole + _BYTE_HASH[0] * (at[k : k + 1] - low[k]).astype(np.uint64))[0]
    names = ("at", "low", "high", "core", "span")
    hashes = [x.astype(np.uint64).view(np.int64) for x in (core, span)]
    return dict(zip(names, [at, low, high, *hashes]))


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _anchor_rows(rows: DataFrame, length: int) -> DataFrame:
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, owner, n = [], [], 0
            keys = batch["key"].astype("Int64")

            def table() -> pd.DataFrame:
                rows = np.repeat(owner, [len(x["at"]) for x in out])
                joined = {c: np.concatenate([x[c] for x in out]) for c in out[0]}
                heads = {"key": keys.to_numpy()[rows], "mark": batch["mark"].to_numpy()[rows]}
                return pd.DataFrame(heads | joined).astype({"key": "Int64"})

            for k, text in enumerate(batch["text"]):
                data = _bytes(text)
                if len(data) < length:
                    continue
                out.append(anchors(np.frombuffer(data, np.uint8), length))
                owner.append(k)
                n += len(out[-1]["at"])
                if n > 100_000:
                    yield table()
                    out, owner, n = [], [], 0
            if out:
                yield table()

    schema = "key long, mark long, at long, low long, high long, core long, span long"
    return rows.mapInPandas(find, schema)


def _piece_rows(wanted: DataFrame, length: int) -> DataFrame:
    """Pieces of the windows of chosen anchors: flanks and the hash of the core."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["key", "mark", "at", "core", "near", "far", "first", "last", "left", "right"]
        for batch in batches:
            out: list[tuple] = []
            for key, mark, text, chosen in zip(
                batch["key"].astype("Int64"), batch["mark"], batch["text"], batch["chosen"]
            ):
                if len(out) > 50_000:
                    yield pd.DataFrame(out, columns=columns).astype({"key": "Int64"})
                    out = []
                data = _bytes(text)
                for row in chosen:
                    at, low, high = row["at"], row["low"], row["high"]
                    for piece in range((at - high) // PIECE, (at - low) // PIECE + 1):
                        near, far = piece * PIECE, piece * PIECE + PIECE - 1
                        begin, end = at - near, at - far + length
                        core = xxhash.xxh3_64_intdigest(data[begin:end], seed=piece)
                        out.append(
                            (
                                key,
                                mark,
                                at,
                                core - (1 << 63),
                                near,
                                far,
                                max(near, at - high),
                                min(far, at - low),
                                data[max(0, at - far) : begin],
                                data[end : at - near + length],
                            )
                        )
            if out:
                yield pd.DataFrame(out, columns=columns).astype({"key": "Int64"})

    schema = (
        "key long, mark long, at long, core long, near long, far long, first long, last long, "
        "left binary, right binary"
    )
    return wanted.mapInPandas(cut, schema)


def _halves(pieces: DataFrame) -> DataFrame:
    """Each piece as two, of half its windows, with cores that are longer by what these share.

    A window ``offset`` bytes before its anchor covers the piece's core, the last
    ``offset - near`` bytes of the left flank and the first ``far - offset`` of the right.
    """
    low = pieces.withColumns(
        {
            "mid": F.expr("cast((near + far + 1) div 2 as int)"),
            "near": F.col("near").cast("int"),
            "far": F.col("far").cast("int"),
        }
    )
    # Bytes that a half adds to its core; a text's end may leave less, but then it has
    # no window that needs them.
    after = low.select(
        "key", "mark", "at",
        F.expr("xxhash64(core, 1, substring(right, 1, far - mid + 1))").alias("core"),
        "near", F.expr("mid - 1").alias("far"), "first", F.expr("least(last, mid - 1)").alias("last"),
        F.expr("substring(left, near + 1 - mid, mid - 1 - near)").alias("left"),
        F.expr("substring(right, far - mid + 2, mid - 1 - near)").alias("right"),
    )
    before = low.select(
        "key", "mark", "at",
        F.expr("xxhash64(core, 2, substring(left, near - mid, mid - near))").alias("core"),
        F.col("mid").alias("near"), "far", F.expr("greatest(first, mid)").alias("first"), "last",
        F.expr("substring(left, 1, greatest(length(left) - (mid - near), 0))").alias("left"),
        F.expr("substring(right, 1, far - mid)").alias("right"),
    )
    kinds = dict(pieces.dtypes)
    return after.union(before).where("first <= last").select(
        *[F.col(c).cast(kinds[c]).alias(c) for c in pieces.columns]
    )


def _repeats_in(block: pd.DataFrame, width: int) -> np.ndarray:
    """Per piece of ``width`` windows at most, flags: which of them occur twice in the block."""
    text: list[int] = []
    cores: dict[int, int] = {}
    stop = -2
    begins, ends = [], []
    for core, left, right in zip(block["core"], block["left"], block["right"]):
        begins.append(len(text) + len(left))
        text.extend(left)
        text.append(256 + cores.setdefault(core, len(cores)))
        text.extend(right)
        text.append(stop)
        stop -= 1
        ends.append(len(text))
    order = np.array(suffix_array(text))
    symbols = np.array(text + [-1] * width)
    # A window is as many symbols as its piece has windows, the core one of them.
    wide = (block["far"] - block["near"] + 1).to_numpy()
    wide = np.repeat(wide, np.diff(ends, prepend=0))
    one, two = order[:-1], order[1:]
    alike, same = np.ones(len(one), bool), np.zeros(len(one), bool)
    for k in range(width):
        alike &= symbols[one + k] == symbols[two + k]
        same |= alike & (wide[one] == k + 1)
    twice = np.zeros(len(text) + 1, bool)
    twice[one[same]] = True
    twice[two[same]] = True
    place = np.array(begins)[:, None] - np.arange(width)[None, :]
    inside = (block["near"].to_numpy()[:, None] + np.arange(width)[None, :])
    inside = (inside >= block["first"].to_numpy()[:, None]) & (
        inside <= block["last"].to_numpy()[:, None]
    )
    return twice[np.maximum(place, 0)] & (place >= 0) & inside


def _suffix_sorted(pieces: DataFrame, length: int, width: int) -> DataFrame:
    """Runs of repeated windows of pieces that lie together by core, as byte ranges."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = pd.DataFrame()
        for batch in batches:
            rest = pd.concat([rest, batch], ignore_index=True)
            while len(rest) > SYMBOLS // (2 * PIECE):
                # Up to the last core that is surely complete.
                cut = int((rest["core"] != rest["core"].iloc[-1]).to_numpy().nonzero()[0].max(initial=-1)) + 1
                ends = np.flatnonzero(np.diff(rest["core"].to_numpy()[:cut])) + 1
                cut = next((int(e) for e in ends if e >= SYMBOLS // (4 * PIECE)), cut)
                if cut == 0:
                    break
                yield ranges(rest.iloc[:cut])
                rest = rest.iloc[cut:].reset_index(drop=True)
        if len(rest):
            yield ranges(rest)

    def ranges(block: pd.DataFrame) -> pd.DataFrame:
        flags = _repeats_in(block, width)
        row, step = np.nonzero(flags)
        # Windows that follow each other are one range; a step further is a byte earlier.
        new = np.r_[True, (row[1:] != row[:-1]) | (step[1:] != step[:-1] + 1)][: len(row)]
        last = step[np.r_[new[1:], True][: len(row)]]
        found = block.iloc[row[new]]
        base = found["at"].to_numpy() - found["near"].to_numpy()
        out = found[["key", "mark"]].astype({"key": "Int64"})
        return out.assign(start=base - last, end=base - step[new] + length)

    return pieces.mapInPandas(search, "key long, mark long, start long, end long")


def repeated_ranges(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400
) -> DataFrame:
    """Byte ranges ``(key, mark, start, end)`` whose every byte repeats.

    ``key`` is the id, ``mark`` the hash of the text; ranges may overlap. A byte
    is in one if it is covered by a string of ``length`` bytes that also starts
    elsewhere in the corpus, in the same text included.
    """
    if length < 4 * PIECE:
        raise ValueError(f"length must be at least {4 * PIECE}")
    rows = _keyed(docs, doc_id, text)
    found = stored(_anchor_rows(rows, length), "anchors")
    cores = found.groupBy("core").agg(
        F.count(F.lit(1)).alias("n"), F.min("span").alias("least"), F.max("span").alias("most")
    )
    cores = cores.where("n > 1").select("core", (F.col("least") != F.col("most")).alias("mixed"))
    again = meet_totals(found, cores, "core").sortWithinPartitions("core", "span")
    again = stored(again, "again")
    discard(found)
    packed = stored(_packed(again), "packed")
    discard(again)
    spans = packed.groupBy("core", "span").agg(
        F.sum(F.size("places")).alias("n"), F.max("mixed").alias("mixed"), F.min("one").alias("one")
    )
    spans = stored(spans, "spans")
    # A span that a pack holds twice repeats; only lone ones ask whether another pack has it.
    many = _unpacked(packed.where(F.size("places") > 1))
    alone = packed.where(F.size("places") == 1).select("core", "span", F.col("places")[0].alias("place"))
    alone = meet_totals(alone, spans.where("n > 1").select("core", "span"), "core", "span")
    whole = many.union(alone.select("place")).select(
        "place.key", "place.mark", F.col("place.low").alias("start"), (F.col("place.high") + length).alias("end")
    )

    chosen = spans.where("mixed").select("one.*").groupBy("key", "mark").agg(
        F.collect_list(F.struct("at", "low", "high")).alias("chosen")
    )
    wanted = rows.join(
        chosen.select(F.col("key").alias("of"), F.col("mark").alias("with"), "chosen"),
        F.expr("key <=> of and mark = with"),
    ).select("key", "mark", "text", "chosen")
    pieces = stored(_piece_rows(wanted, length).dropDuplicates(["key", "mark", "at", "near"]), "pieces")
    return reduce(DataFrame.union, [whole, *_repeated_pieces(pieces, length)])


def _packed(again: DataFrame) -> DataFrame:
    """``(core, span, pack, mixed, one, places)``: anchors of a span that lie near each other.

    A pack holds at most ``PACK_ROWS`` anchors, so a span that most texts have is packed
    where it lies, before anything is shuffled, and never gathered in one row.
    """
    pack = F.floor(F.monotonically_increasing_id() / PACK_ROWS)
    one = F.struct(F.col("key").isNull().alias("none"), "key", "mark", "at", "low", "high")
    return again.withColumn("pack", pack).groupBy("core", "span", "pack").agg(
        F.max("mixed").alias("mixed"),
        F.min(one).alias("one"),
        F.collect_list(F.struct("key", "mark", "low", "high")).alias("places"),
    )


def _unpacked(packed: DataFrame) -> DataFrame:
    """``(place)``: the places of packs, one a row.

    Packs are dealt out anew first, as those of a passage that many texts quote lie
    together; so every task unpacks about as many.
    """
    return packed.select("places").hint("rebalance").select(F.explode("places").alias("place"))


def _repeated_pieces(pieces: DataFrame, length: int) -> list[DataFrame]:
    """Repeated windows of ``pieces`` as byte ranges, a frame for each width of pieces."""
    out, width = [], PIECE
    while True:
        crowd = pieces.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        met = stored(meet_totals(pieces, crowd, "core"), "crowded")
        discard(pieces)
        if width == 1:  # a window is its core
            start = F.col("at") - F.col("near")
            out.append(met.select("key", "mark", start.alias("start"), (start + length).alias("end")))
            return out
        ordinary = met.where(F.col("n") <= SPLIT_ABOVE)
        # Few bytes but much work a row, so the number of tasks follows the rows.
        tasks = max(1, -(-ordinary.count() // PIECES_PER_TASK))
        dealt = ordinary.repartition(tasks, "core").sortWithinPartitions("core")
        out.append(_suffix_sorted(dealt, length, width))
        rest = met.where(F.col("n") > SPLIT_ABOVE).drop("n")
        if rest.isEmpty():
            return out
        width = -(-width // 2)
        pieces = stored(_halves(rest), "halves")


def _keyed(docs: DataFrame, doc_id: str, text: str, *more: F.Column) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    body_of = [F.col(text).alias("raw")] if more else [body.alias("text")]
    return docs.select(
        *more, F.col(doc_id).cast("long").alias("key"), F.xxhash64(body).alias("mark"), *body_of
    )


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 400
) -> DataFrame:
    """``docs`` with shortened texts, and what was removed.

    Adds ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and
    ``kept_sha256`` (of the remaining bytes); columns of those names are replaced.
    A null text stays null.
    """
    require(docs, doc_id, text)
    added = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    docs = docs.drop(*[c for c in added if c not in (doc_id, text)])
    columns = docs.columns
    with scratch(docs.sparkSession):
        ranges = repeated_ranges(docs, doc_id, text, length)
        each = ranges.distinct().groupBy("key", "mark").agg(
            F.collect_list(F.struct("start", "end")).alias("ranges")
        )
        each = kept(each.toDF("of", "with", "ranges"), "ranges")
    # The caller's columns travel in one, whatever their names.
    own = F.struct(*[F.col(f"`{c}`") for c in columns if c != text]).alias("own")
    rows = _keyed(docs, doc_id, text, own).withColumnRenamed("raw", "body")
    joined = rows.join(each, F.expr("key <=> of and mark = with"), "left")
    joined = joined.select("own", "body", "ranges")
    kinds = (LongType(), LongType(), LongType(), StringType())
    new = [StructField(name, kind) for name, kind in zip(added, kinds)]
    schema = StructType([rows.schema["own"], StructField("body", StringType()), *new])

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows = [], []
            for body, cut in zip(batch.column("body").to_pylist(), batch.column("ranges").to_pylist()):
                data = _bytes(body)
                kept, n_spans = data, 0
                if cut is not None and len(cut):
                    edges = np.zeros(len(data) + 1, np.int64)
                    np.add.at(edges, [r["start"] for r in cut], 1)
                    np.add.at(edges, [r["end"] for r in cut], -1)
                    gone = np.cumsum(edges[:-1]) > 0
                    n_spans = int(np.count_nonzero(np.diff(np.r_[False, gone].astype(np.int8)) == 1))
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                    body = kept.decode("utf-8", "ignore")
                texts.append(body)
                rows.append(
                    (len(data), len(data) - len(kept), n_spans, hashlib.sha256(kept).hexdigest())
                )
            columns = [[r[k] for r in rows] for k in range(len(added))]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            results = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("own"), pa.array(texts, pa.string()), *results],
                names=["own", "body", *added],
            )

    out = joined.mapInArrow(shorten, schema)
    shown = [F.col("body").alias(c) if c == text else F.col(f"own.`{c}`") for c in columns]
    return out.select(*shown, *added)
