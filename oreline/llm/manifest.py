"""A Merkle tree over a dataset, with a proof for every document.

A leaf is the hash of a document's fields. The leaves of a source, in order of their
ids, are hashed in runs of ``ARITY`` until one node is left, its subroot; the
subroots, in order of their sources, are hashed likewise to the root.

Proofs are made by octopus multiproofs. A partition holds up to ``BLOCK_LEAVES``
neighbouring leaves of a source. It first works out which node coordinates its proofs
need that it cannot derive from its own leaves (shared ones once), fetches these in
one join, derives the interior nodes that its proofs share, and only then expands
the proof of each leaf, locally.

Places are given out in two levels (ranges of the sorted leaves, then rows within a
range), so a source with most of the documents is not gathered in one task.

Cases: null fields are hashed as ``-``; a null source is a source, the first; null
ids come first in their source and are never tampered with; documents with one id
are ordered by their leaf, repeated rows are leaves like others; one document alone
is leaf, subroot and root at once, with an empty proof; an empty table has no leaf
and an empty result. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreline.llm.common import discard, kept, require, scratch, stored

ARITY_BITS = 4
ARITY = 1 << ARITY_BITS
BLOCK_LEAVES = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# monotonically_increasing_id: the partition is above these bits, the row below.
ROW_BITS = 33

_NODE = "tree long, level int, place long, digest string"


def _encoded(value: Column) -> Column:
    plain = value.cast("string")
    length = F.octet_length(plain).cast("string")
    return F.coalesce(F.concat(length, F.lit(":"), plain), F.lit("-"))


def leaf_hash(**changed: Column) -> Column:
    """Hash of the fields of a document; ``changed`` fields are taken from there."""
    return F.sha2(F.concat(*[_encoded(changed.get(f, F.col(f))) for f in FIELDS]), 256)


def leaves(docs: DataFrame, tampered: Column | None = None, **changed: Column) -> DataFrame:
    """``(doc_id, source, leaf, altered)``; ``altered`` is the leaf after tampering, or null.

    ``changed`` says what tampering does to fields of the rows where ``tampered`` holds.
    """
    require(docs, *FIELDS)
    other = F.when(tampered, leaf_hash(**changed)) if tampered is not None else F.lit(None)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        leaf_hash().alias("leaf"),
        other.cast("string").alias("altered"),
    )


@dataclass
class Manifest:
    """Placed leaves, all nodes (tree -1: of subroots), and the number of sources.

    ``leaves`` is ``(tree, place, n, doc_id, source, leaf, altered)``, where ``tree``
    numbers the sources and ``n`` is the number of leaves of the source; ``nodes`` is
    ``(tree, level, place, digest)``.
    """

    leaves: DataFrame
    nodes: DataFrame
    trees: int


def _ranged(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` in order, stored, with ``at``: ids that ascend along it.

    Rows that are equal in all of ``order`` may lie in several ranges.
    """
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(*order, "tie").sortWithinPartitions(*order, "tie")
    return stored(ranged.drop("tie").withColumn("at", F.monotonically_increasing_id()), "ranged")


def _firsts(ranged: DataFrame, *group: str) -> DataFrame:
    """Per group and range: first id, rows of the group ahead of it, rows of the group."""
    each = ranged.groupBy(*group, F.shiftright("at", ROW_BITS).alias("range")).agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("held")
    )
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    ahead = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return each.select(
        *[F.col(c).alias(f"of_{c}") for c in group],
        F.col("range").alias("of_range"),
        "first",
        F.coalesce(F.sum("held").over(ahead), F.lit(0)).alias("base"),
        F.sum("held").over(whole).alias("n"),
    )


def _in_range() -> Column:
    return F.shiftright("at", ROW_BITS) == F.col("of_range")


def _place(name: str) -> Column:
    return (F.col("at") - F.col("first") + F.col("base")).cast("long").alias(name)


def _levels(level: DataFrame, most: int) -> list[DataFrame]:
    """All levels above ``level(tree, place, n, digest)``; ``most`` is the greatest ``n``."""
    out = [level]
    while most > 1:
        digests = F.array_join(F.transform(F.sort_array("run"), lambda x: x.digest), "")
        level = (
            out[-1]
            .where("n > 1")
            .groupBy("tree", F.shiftright("place", ARITY_BITS).alias("place"))
            .agg(F.collect_list(F.struct("place", "digest")).alias("run"), F.first("n").alias("n"))
            .select(
                "tree",
                "place",
                F.shiftright(F.col("n") + (ARITY - 1), ARITY_BITS).alias("n"),
                F.sha2(digests, 256).alias("digest"),
            )
        )
        out.append(stored(level, "level"))
        most = -(-most // ARITY)
    return out


def build(leaf_rows: DataFrame) -> Manifest:
    """The manifest of ``leaf_rows``, as ``leaves`` returns them."""
    hashed = stored(leaf_rows, "leaves")
    ranged = _ranged(hashed, "source", "doc_id", "leaf")
    discard(hashed)
    firsts = stored(_firsts(ranged, "source"), "firsts")
    sources = _ranged(firsts.select(F.col("of_source").alias("source")).distinct(), "source")
    trees = sources.join(_firsts(sources), _in_range()).select("source", _place("tree"), "n")
    named = firsts.join(
        trees.select(F.col("source").alias("named"), "tree"), F.expr("of_source <=> named")
    )
    placed = ranged.join(named, _in_range() & F.expr("source <=> of_source"))
    placed = placed.select("tree", _place("place"), "n", "doc_id", "source", "leaf", "altered")
    placed = stored(placed, "placed")
    most = firsts.agg(F.max("n"), F.countDistinct(F.struct("of_source"))).first()
    levels = _levels(placed.select("tree", "place", "n", F.col("leaf").alias("digest")), most[0] or 0)
    subroots = reduce(DataFrame.union, [x.where("n = 1") for x in levels])
    top = subroots.select(
        F.lit(-1).cast("long").alias("tree"),
        F.col("tree").alias("place"),
        F.lit(most[1]).cast("long").alias("n"),
        "digest",
    )
    tops = _levels(stored(top, "subroots"), most[1])
    every = [
        x.select("tree", F.lit(k).alias("level"), "place", "digest")
        for line in (levels, tops)
        for k, x in enumerate(line)
    ]
    return Manifest(placed, reduce(DataFrame.union, every), most[1])


def _missing(places: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per level of a tree of ``n`` leaves: the nodes that proofs of the leaves at
    ``places`` need and that do not follow from these leaves."""
    known, level = np.unique(places), 0
    while n > 1:
        runs = np.unique(known >> ARITY_BITS)
        needed = ((runs << ARITY_BITS)[:, None] + np.arange(ARITY)).ravel()
        yield level, np.setdiff1d(needed[needed < n], known, assume_unique=True)
        known, n, level = runs, -(-n // ARITY), level + 1


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _around(known: dict[tuple[int, int], str], places: np.ndarray, n: int) -> tuple[list[dict], str]:
    """Per level: what stands left and right of each derived node in its run, and the root.

    ``known`` holds digests by (level, place): the leaves at ``places`` and the fetched
    nodes. Interior nodes are derived once, whatever number of proofs they serve.
    """
    own, level, sides = np.unique(places), 0, []
    while n > 1:
        runs, here = np.unique(own >> ARITY_BITS), {}
        for run in runs.tolist():
            first = run << ARITY_BITS
            held = [known[level, p] for p in range(first, min(first + ARITY, n))]
            for k in range(len(held)):
                here[first + k] = ("".join(held[:k]), "".join(held[k + 1 :]))
            known[level + 1, run] = _sha("".join(held))
        sides.append(here)
        own, n, level = runs, -(-n // ARITY), level + 1
    return sides, known[level, 0]


def fold(leaf: str, sides: list[tuple[str, str]]) -> str:
    """The root that follows from a leaf and what stands left and right of its path."""
    for left, right in sides:
        leaf = _sha(left + leaf + right)
    return leaf


def prove(manifest: Manifest, wanted: DataFrame | None = None, whole: bool = False) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``.

    ``wanted`` are the rows of ``manifest.leaves`` to prove, all by default.
    ``proof_sha256`` is the hash of the siblings from leaf to root, level by level and
    left to right; with ``whole`` they are returned too, as ``proof``, a list of what
    stands ``left`` and ``right`` at each level. ``folded_root`` is recomputed from the
    altered leaf, where there is one, and the original siblings.
    """
    rows = manifest.leaves if wanted is None else wanted
    # Ids travel as text: pandas would round great ones beside nulls.
    rows = rows.withColumns(
        {
            "block": F.floor(F.col("place") / BLOCK_LEAVES).cast("long"),
            "doc_id": F.col("doc_id").cast("string"),
        }
    )
    trees = manifest.trees

    def coordinates(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree, block = key
        ways = ((tree, group["place"].to_numpy(), int(group["n"].iloc[0])), (-1, np.array([tree]), trees))
        found = [
            pd.DataFrame({"of_tree": of, "at_level": level, "at_place": places})
            for of, at, n in ways
            for level, places in _missing(at, n)
        ]
        names = ["of_tree", "at_level", "at_place"]
        out = pd.concat(found) if found else pd.DataFrame(columns=names)
        return out.astype("int64").assign(tree=int(tree), block=int(block))

    asked = rows.select("tree", "block", "place", "n").groupBy("tree", "block").applyInPandas(
        coordinates, "tree long, block long, of_tree long, at_level long, at_place long"
    )
    nodes = manifest.nodes.toDF("node_tree", "level", "place", "digest")
    fetched = asked.join(
        nodes, F.expr("of_tree = node_tree and at_level = level and at_place = place")
    ).select("tree", "block", "of_tree", "level", "place", "digest")

    def expand(key: tuple, group: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "proof"]
        if not len(group):
            return pd.DataFrame(columns=columns)
        tree = int(key[0])
        known: dict[bool, dict] = {False: {}, True: {}}
        for of, level, place, digest in zip(held["of_tree"], held["level"], held["place"], held["digest"]):
            known[of == -1][level, place] = digest
        places = group["place"].to_numpy()
        known[False].update(((0, p), leaf) for p, leaf in zip(places.tolist(), group["leaf"]))
        sides, subroot = _around(known[False], places, int(group["n"].iloc[0]))
        known[True][0, tree] = subroot
        above, root = _around(known[True], np.array([tree]), trees)
        above = [here[tree >> (ARITY_BITS * k)] for k, here in enumerate(above)]
        out = []
        for place, doc_id, leaf, altered in zip(
            places.tolist(), group["doc_id"], group["leaf"], group["altered"]
        ):
            path = [here[place >> (ARITY_BITS * k)] for k, here in enumerate(sides)] + above
            folded = fold(altered or leaf, path)
            digest = _sha("".join([left + right for left, right in path]))
            proof = [{"left": left, "right": right} for left, right in path] if whole else None
            out.append((doc_id, leaf, subroot, root, digest, folded, folded == root, proof))
        return pd.DataFrame(out, columns=columns)

    schema = (
        "doc_id string, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean, proof array<struct<left string, right string>>"
    )
    keys = ["tree", "block"]
    proofs = rows.groupBy(*keys).cogroup(fetched.groupBy(*keys)).applyInPandas(expand, schema)
    proofs = proofs.withColumn("doc_id", F.col("doc_id").cast("long"))
    return proofs if whole else proofs.drop("proof")


def proofs_of(docs: DataFrame, tampered: Column | None = None, **changed: Column) -> DataFrame:
    """Leaf, subroot, root and proof of every document; see ``leaves`` and ``prove``."""
    with scratch(docs.sparkSession):
        return kept(prove(build(leaves(docs, tampered, **changed))), "proofs")
