"""Near-duplicate documents by HyperMinHash sketches.

Each shingle falls into one of 128 buckets by the first bits of its hash. A
bucket keeps its least hash as a register of 16 bits: the number of leading
zeros and ten mantissa bits. Buckets without a shingle borrow the register of
another one, in an order fixed for each bucket, so short texts are compared as
well as long ones. Four registers make one band of 64 bits; texts that share a
band are candidates, the share of equal registers, corrected for chance
collisions, estimates their similarity, and full shingle sets decide.

Cases: null and blank texts have no shingles and link with nothing; texts of
fewer than ``width`` words are one shingle; rows with equal sets are one class,
known by the set and not by an id, so ids may repeat or be null; a component is named
by its least id, and has no name if no row of it has an id. Ids must be numbers or
castable to them. Further columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.llm.common import components, discard, kept, meet_totals, require, scratch, stored

BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
BAND_REGISTERS = 4  # 16 bits each: a band is one long
BANDS = BUCKETS // BAND_REGISTERS
# Pairs whose estimate is this far below the threshold are not verified: more than
# six standard deviations of 128 registers.
MARGIN = 0.25
WORDS_KEPT = 1 << 20
# Of a block of a neighbourhood, and of a block of sketches of a bucket.
BLOCK_TEXTS = 96
BLOCK_SKETCHES = 1024
BLOCK_CHARS = 4 << 20

_TAIL = 64 - BUCKET_BITS
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64
)


class _WordHashes(dict):
    """Hash of each word seen; forgets all when full, so memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - width + 1)
    out = np.full(n, np.uint64(len(h) if len(h) < width else width), np.uint64)
    for k in range(min(width, len(h))):
        out = _mixed(out * _ODD[k % 4] + h[k : k + n])
    return np.unique(out)


@lru_cache(1)
def _borrow_order() -> np.ndarray:
    """For each bucket, the order in which it looks for another one's register."""
    rng = np.random.default_rng(20240229)
    order = np.array([rng.permutation(BUCKETS) for _ in range(BUCKETS)])
    return np.concatenate([np.arange(BUCKETS)[:, None], order], axis=1)


def registers(shingles: np.ndarray) -> np.ndarray:
    """The sketch of a non-empty sorted set: 128 registers of 16 bits."""
    bucket = (shingles >> np.uint64(_TAIL)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    least = shingles[first] & np.uint64((1 << _TAIL) - 1) | np.uint64(1)
    high = np.frexp((least >> np.uint64(10)).astype(np.float64))[1].astype(np.int64) + 9
    low = (least >> np.uint64(10)) == 0
    high[low] = np.frexp(least[low].astype(np.float64))[1] - 1
    up, down = np.maximum(MANTISSA_BITS - high, 0), np.maximum(high - MANTISSA_BITS, 0)
    mantissa = ((least << up.astype(np.uint64)) >> down.astype(np.uint64)) & np.uint64(
        (1 << MANTISSA_BITS) - 1
    )
    zeros = (_TAIL - 1 - high).astype(np.uint64)
    found = np.zeros(BUCKETS, np.uint16)
    found[bucket[first]] = ((zeros << np.uint64(MANTISSA_BITS)) | mantissa).astype(np.uint16)
    if len(first) < BUCKETS:
        filled = np.zeros(BUCKETS, bool)
        filled[bucket[first]] = True
        order = _borrow_order()
        found = found[order[np.arange(BUCKETS), filled[order].argmax(axis=1)]]
    return found


def sketches(docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """``(doc_id, mark, n_shingles, set_id, bands)``; set and bands are null without a word.

    ``mark`` is the hash of the text, which tells rows of one id apart.
    """

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes()
        for batch in batches:
            counts, sets, bands = [], [], []
            for body in batch["text"]:
                s = shingle_set(body, width, hashes)
                counts.append(len(s))
                if len(s):
                    sets.append(xxhash.xxh3_128_digest(s.tobytes()))
                    bands.append(registers(s).view(np.int64).tolist())
                else:
                    sets.append(None)
                    bands.append(None)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "mark": batch["mark"],
                    "n_shingles": counts,
                    "set_id": sets,
                    "bands": bands,
                }
            )

    # Ids travel as text: pandas would round great ones beside nulls.
    rows = docs.select(
        F.col(doc_id).cast("long").cast("string").alias("doc_id"),
        mark(F.col(text)).alias("mark"),
        F.col(text).alias("text"),
    )
    schema = "doc_id string, mark long, n_shingles long, set_id binary, bands array<long>"
    found = rows.mapInPandas(sketch, schema)
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def mark(text: F.Column) -> F.Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _equal_registers() -> F.Column:
    def equal(x: F.Column, y: F.Column) -> F.Column:
        differ = x.bitwiseXOR(y)
        lanes = [
            (F.shiftrightunsigned(differ, 16 * k).bitwiseAND(F.lit(65535)) == 0).cast("int")
            for k in range(BAND_REGISTERS)
        ]
        return lanes[0] + lanes[1] + lanes[2] + lanes[3]

    matches = F.zip_with("bands_a", "bands_b", equal)
    return F.aggregate(matches, F.lit(0), lambda total, x: total + x)


def estimate() -> F.Column:
    """Similarity of ``bands_a`` and ``bands_b``, corrected for chance collisions.

    Two unrelated registers agree if both the zeros (odds of one third at equal
    set sizes) and all mantissa bits agree.
    """
    chance = 1 / (3 * 2**MANTISSA_BITS)
    return (_equal_registers() / BUCKETS - chance) / (1 - chance)


def _screened(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` whose sizes and estimates allow the wanted similarity."""
    side = {c: classes.select(*[F.col(n).alias(f"{n}_{c}") for n in classes.columns]) for c in "ab"}
    near = pairs.join(side["a"], F.col("a") == F.col("class_a")).join(
        side["b"], F.col("b") == F.col("class_b")
    )
    fits = F.least("n_shingles_a", "n_shingles_b") * 100 >= F.greatest(
        "n_shingles_a", "n_shingles_b"
    ) * F.lit(percent)
    return near.where(fits & (estimate() >= percent / 100 - MARGIN)).select("a", "b")


def _stars_across(
    shared: DataFrame, hoods: DataFrame, classes: DataFrame, percent: int
) -> DataFrame:
    """Pairs ``(a, b)`` of one bucket that the screen lets pass, between neighbourhoods.

    Members that the screen parts from their head may still resemble each other.
    A bucket with members of several neighbourhoods is compared in full by size and
    sketch, whatever its size, in blocks of which every two meet; buckets of the same
    members are one. As few pairs are returned as join what a block joins.
    """
    many = shared.where("n > 2").join(hoods, F.col("class") == F.col("node"), "left")
    many = many.select("band", "key", "class", F.coalesce("hood", "class").alias("hood"))
    digests = [F.sum(F.xxhash64("class", F.lit(k)).cast("decimal(38,0)")).alias(f"d{k}") for k in (1, 2)]
    split = many.groupBy("band", "key").agg(
        F.min("hood").alias("low"), F.max("hood").alias("high"), F.count(F.lit(1)).alias("size"), *digests
    )
    once = split.where("low < high").groupBy("size", "d1", "d2").agg(
        F.min(F.struct("band", "key")).alias("bucket")
    )
    blocks = F.ceil(F.col("size") / BLOCK_SKETCHES).cast("int").alias("blocks")
    once = stored(once.select("bucket.*", blocks), "split")
    dealt = meet_totals(many, once, "band", "key").join(classes, "class")
    dealt = dealt.withColumn("block", F.expr("pmod(xxhash64(class), blocks)"))
    met = dealt.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1L)"))).select(
        "band",
        "key",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block",
        "class",
        "hood",
        "n_shingles",
        "bands",
    )
    chance = 1 / (3 * 2**MANTISSA_BITS)

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("n_shingles", kind="stable")
        bands = np.stack(group["bands"].to_list()).astype(np.int64).view(np.uint16)
        size, name = group["n_shingles"].to_numpy(), group["class"].to_numpy()
        part, block = pd.factorize(group["hood"].map(bytes))[0], group["block"].to_numpy()
        # Where two blocks meet, what lies within one is left to its own group.
        within = group["low"].iloc[0] == group["high"].iloc[0]
        ends, links = np.searchsorted(size * percent, size * 100, side="right"), []
        for i, end in enumerate(ends):
            near = part[i + 1 : end] != part[i]
            if not within:
                near &= block[i + 1 : end] != block[i]
            near = np.flatnonzero(near) + i + 1
            equal = (bands[near] == bands[i]).sum(axis=1)
            close = (equal / BUCKETS - chance) / (1 - chance) >= percent / 100 - MARGIN
            for j in near[close]:
                if part[i] != part[j]:
                    links.append((min(name[i], name[j]), max(name[i], name[j])))
                    part[part == part[j]] = part[i]
        return pd.DataFrame(links, columns=["a", "b"])

    return met.groupBy("band", "key", "low", "high").applyInPandas(compare, "a binary, b binary")


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough. ``texts`` is ``(class, text)``."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, known = _WordHashes(), {}

        def full(key: bytes, body: str) -> np.ndarray:
            if key not in known:
                if len(known) >= 64:
                    known.clear()
                known[key] = shingle_set(body, width, hashes)
            return known[key]

        for batch in batches:
            keep = []
            for a, b, x, y in zip(batch["a"], batch["b"], batch["text_a"], batch["text_b"]):
                s, t = full(a, x), full(b, y)
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= percent * (len(s) + len(t) - both))
            yield batch.loc[keep, ["a", "b"]]

    side = {c: texts.select(F.col("class").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab"}
    full_pairs = pairs.join(side["b"], "b").join(side["a"], "a")
    return full_pairs.select("a", "b", "text_a", "text_b").mapInPandas(check, "a binary, b binary")


def _common(groups: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    n = len(groups)
    all_, owner = np.concatenate(groups), np.repeat(np.arange(n), [len(g) for g in groups])
    order = np.argsort(all_, kind="stable")
    new = np.r_[True, all_[order][1:] != all_[order][:-1]] if len(order) else np.empty(0, bool)
    column = np.empty(len(order), np.int64)
    column[order] = np.cumsum(new) - 1
    shared = np.bincount(column, minlength=1)[column] > 1
    column, owner = np.unique(column[shared], return_inverse=True)[1], owner[shared]
    out, width = np.zeros((n, n)), 8192
    for start in range(0, int(column.max(initial=-1)) + 1, width):
        here = (column >= start) & (column < start + width)
        table = np.zeros((n, width), np.float32)
        table[owner[here], column[here] - start] = 1
        out += table @ table.T
    return out


def _links_across(open_: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between components, block by block within a neighbourhood.

    ``open_`` is ``(class, hood, component, text)``. A neighbourhood is dealt
    into blocks of a bounded number of texts and bytes, every two blocks meet in
    one group, and only links that join two components leave it.
    """
    room = open_.groupBy("hood").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum(F.length("text")) / BLOCK_CHARS)
        ).cast("int").alias("blocks")
    )
    dealt = meet_totals(open_, room, "hood").withColumn("block", F.expr("pmod(xxhash64(class), blocks)"))
    met = dealt.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1L)"))).select(
        "hood",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "class",
        "component",
        "text",
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        hashes = _WordHashes()
        sets = [shingle_set(body, width, hashes) for body in group["text"]]
        size = np.array([len(s) for s in sets], float)
        both = _common(sets)
        linked = np.triu(100 * both >= percent * (size[:, None] + size[None, :] - both), 1)
        part, name = pd.factorize(group["component"].map(bytes))[0], group["class"].to_numpy()
        links = []
        for i, j in zip(*np.nonzero(linked & (part[:, None] != part[None, :]))):
            if part[i] != part[j]:
                links.append((min(name[i], name[j]), max(name[i], name[j])))
                part = np.where(part == part[j], part[i], part)
        return pd.DataFrame(links, columns=["a", "b"])

    return met.groupBy("hood", "low", "high").applyInPandas(compare, "a binary, b binary")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``(doc_id, mark, n_shingles, set_id, group, component_id, kept)``, one row per document.

    Two documents are linked if 100 * intersection >= ``percent`` * union of
    their sets of ``width``-word shingles (A-Z lower-cased); ``group`` names what is
    reachable, null for texts without a word, and ``component_id`` is the least id in it.
    Every bucket of a band is first checked against one
    member, another one in each band, so a group of copies never expands into all
    its pairs; a bucket that this leaves in several neighbourhoods is compared in
    full by its sketches. Texts that candidate pairs of fitting size and estimate
    connect form a neighbourhood; one that still holds several components is compared
    in full, in blocks of bounded size.
    """
    require(docs, doc_id, text)
    with scratch(docs.sparkSession):
        found = stored(sketches(docs, doc_id, text, width), "sketches")
        groups = _groups(docs, found, doc_id, text, width, percent)
        rows = found.select("doc_id", "mark", "n_shingles", "set_id")
        rows = rows.join(groups.toDF("of_set", "group"), F.col("set_id") == F.col("of_set"), "left")
        rows = stored(rows.drop("of_set"), "rows")
        least = rows.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("least"))
        named = meet_totals(rows, least, "group", how="left")
        component = F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("least"))
        out = named.select(
            "doc_id",
            "mark",
            "n_shingles",
            "set_id",
            "group",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
        )
        return kept(out, "near_duplicates")


def _groups(
    docs: DataFrame, found: DataFrame, doc_id: str, text: str, width: int, percent: int
) -> DataFrame:
    """``(set_id, group)`` of all distinct sets of ``found``, the sketches of ``docs``."""
    # A class is a distinct set; one row that has it stands for it.
    one = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    classes = found.where("set_id is not null").groupBy(F.col("set_id").alias("class")).agg(
        F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.min(one).alias("one")
    )
    classes = stored(classes, "classes")
    sketched = classes.select("class", "n_shingles", "bands")
    members = classes.select("class", F.posexplode("bands").alias("band", "key"))
    order = F.struct(F.xxhash64("class", "band").alias("rank"), F.col("class").alias("head"))
    heads = members.groupBy("band", "key").agg(
        F.min(order).alias("least"), F.count(F.lit(1)).alias("n")
    )
    heads = heads.where("n > 1").select("band", "key", F.col("least.head").alias("head"), "n")
    shared = stored(meet_totals(members, heads, "band", "key"), "shared")

    pair = [F.least("class", "head").alias("a"), F.greatest("class", "head").alias("b")]
    stars = shared.where("class <> head").select(*pair).distinct()
    screened = stored(_screened(stars, sketched, percent), "stars")
    hoods = stored(components(screened).withColumnsRenamed({"component": "hood"}), "hoods")
    across = stored(_stars_across(shared, hoods, sketched, percent).distinct(), "across")
    discard(shared)
    if not across.isEmpty():
        joined = hoods.select(F.col("node").alias("a"), F.col("hood").alias("b")).union(across)
        hoods = components(joined).withColumnsRenamed({"component": "hood"})
        screened = screened.union(across)
    needed = screened.selectExpr("a as class").union(screened.selectExpr("b as class")).distinct()
    needed = classes.select("class", "one.doc_id", F.col("one.mark").alias("of_mark")).join(needed, "class")
    needed = needed.withColumnRenamed("doc_id", "of")
    rows = docs.select(
        F.col(doc_id).cast("long").alias("key"), mark(F.col(text)).alias("mark"), F.col(text).alias("text")
    )
    texts = rows.join(needed, F.expr("key <=> of and mark = of_mark")).select("class", "text")
    texts = stored(texts.dropDuplicates(["class"]), "texts")
    links = stored(_verified(screened, texts, width, percent), "links")

    # Neighbourhoods that still hold several components: compare across them.
    linked = stored(components(links), "linked")
    parts = hoods.join(linked, "node", "left").select(
        "hood", F.col("node").alias("class"), F.coalesce("component", "node").alias("component")
    )
    parts = stored(parts, "parts")
    mixed = parts.groupBy("hood").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    open_ = meet_totals(parts, mixed.where("low < high").select("hood"), "hood").join(texts, "class")
    late = stored(_links_across(open_, width, percent), "late")
    final = linked if late.isEmpty() else components(links.union(late))
    return classes.join(final, F.col("class") == F.col("node"), "left").select(
        "class", F.coalesce("component", "class").alias("group")
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the least id.

    Rows without a word are no copies of each other and stay, but of rows that are
    equal in id and text one is left.
    """
    found = near_duplicates(docs, doc_id, text, **options)
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), name.alias("name"), F.col("mark")))
    heads = found.where("group is not null").groupBy("group").agg(first.alias("first"))
    heads = heads.select("first.name", "first.mark")
    heads = heads.union(found.where("group is null").select(name.alias("name"), "mark").distinct())
    with scratch(docs.sparkSession):
        heads = kept(heads, "heads")
    discard(found)
    # The caller's columns travel in one, whatever their names.
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"),
        F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit("-")).alias("name"),
        mark(F.col(text)).alias("mark"),
    )
    left = own.join(heads, ["name", "mark"]).dropDuplicates(["name", "mark"])
    return left.select(*[F.col(f"own.`{c}`") for c in docs.columns])
