"""Near-duplicate documents: SuperMinHash signatures, banding, verification and union of the links.

A document's set is its distinct shingles. Each shingle draws one permutation of the signature's places,
place by place: its rank there is the number of the draw plus a random part. Level by level all shingles
make their next draw, until every place of a document is taken, so large sets stop after the first. The
ranks of one shingle are correlated, which gives the estimate a lower variance than independent ones.

Documents with equal sets are one class from the start. Classes that agree in a band of places share a
bucket; in a bucket, pairs whose signatures are alike and whose classes are not connected yet are tried on
their full sets: first the most central class with all others; then, with the links of that, all that is left.

At scale: texts are read twice and shuffled once. What is shuffled in between are signatures of classes in
shared buckets, and texts of classes that are tried. In a large group of copies the first pairs connect nearly
all; what is left is compared with the group through an index of shingles, a block of classes at a time. A
large bucket is dealt to blocks, those of its largest component and the others apart; blocks meet pairwise in
tasks of their own, but not two of the largest component. No pairs are listed but links that connect.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedkit.llm.common import located, locator, stored
from feedkit.llm.quality import lean, parts_of, texts_of

BANDS, ROWS = 24, 4
PLACES = BANDS * ROWS
#: How far below the limit the share of equal places may lie for a pair to be tried: five times its deviation.
MARGIN = 0.2
#: Bands that are tried one after the other.
PHASES = ((0, 3), (3, BANDS))
#: Classes in a block of a bucket.
BLOCK = 512
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
UPPER = bytes(range(65, 91))
LOWERED = bytes.maketrans(UPPER, UPPER.lower())


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64 bits (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWERED).split()


def shingles(words: list[bytes], size: int) -> set[bytes]:
    """The set itself: runs of ``size`` words, or all words if there are fewer; empty without words."""
    if len(words) <= size:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*(words[k:] for k in range(size)), strict=False)))


def sets_of(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct shingles of all texts, in order."""
    ids = defaultdict(count().__next__)
    split = [words_of(t) for t in texts]
    n = np.array([len(w) for w in split], np.int64)
    index = np.fromiter((ids[w] for words in split for w in words), np.int64, int(n.sum()))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in ids), np.uint64, len(ids))[index]
    begin = np.cumsum(n) - n
    per = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(texts)), per)
    at = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per) + np.repeat(begin, per)
    end = np.repeat(begin + n, per)
    value = mixed(hashes[at] + GOLDEN)
    for k in range(1, size):
        there = at + k < end
        after = np.where(there, hashes[np.minimum(at + k, max(len(hashes) - 1, 0))] + np.uint64(k), np.uint64(0))
        value = mixed(value * GOLDEN + after)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


def signatures(doc: np.ndarray, value: np.ndarray, n_docs: int, together: int = 60_000) -> np.ndarray:
    """(documents, PLACES): rank of the draw in the high half, its random part in the low half."""
    full = np.uint64(2**64 - 1)
    out = np.full(n_docs * PLACES, full, np.uint64)
    draw = mixed(value + GOLDEN)
    place = (draw & np.uint64(0xFFFFFFFF)) % np.uint64(PLACES)
    np.minimum.at(out, doc * PLACES + place.astype(np.int64), draw >> np.uint64(32))
    unfinished = (out.reshape(n_docs, PLACES) == full).any(axis=1)
    rest = np.flatnonzero(unfinished[doc])
    cuts = np.flatnonzero(np.diff(doc[rest])) + 1 if len(rest) else np.array([], int)
    bounds, last = [0], 0
    for c in [*cuts.tolist(), len(rest)]:  # whole documents together
        if c - bounds[-1] > together and last > bounds[-1]:
            bounds.append(last)
        last = c
    bounds.append(len(rest))
    for a, b in zip(bounds, bounds[1:], strict=False):
        some = rest[a:b]
        d, v, first = doc[some], value[some], place[some].astype(np.int64)
        order = np.tile(np.arange(PLACES, dtype=np.uint8), (len(some), 1))
        lane = np.arange(len(some))
        order[lane, first], order[lane, 0] = order[lane, 0], order[lane, first].copy()
        for level in range(1, PLACES):
            open_ = (out.reshape(n_docs, PLACES)[d] == full).any(axis=1) if len(d) else np.array([], bool)
            if not open_.any():
                break
            d, v, order = d[open_], v[open_], order[open_]
            lane = np.arange(len(d))
            draw = mixed(v + np.uint64(int(GOLDEN) * (level + 1) % 2**64))
            at = (level + (draw & np.uint64(0xFFFFFFFF)) % np.uint64(PLACES - level)).astype(np.int64)
            won = order[lane, at].astype(np.int64)
            order[lane, at] = order[:, level]
            order[:, level] = won
            np.minimum.at(out, d * PLACES + won, np.uint64(level << 32) | (draw >> np.uint64(32)))
    return out.reshape(n_docs, PLACES)


FEATURES = "doc_id {}, file long, row long, n long, digest binary, bands array<long>, sig binary"


def featured(docs: DataFrame, size: int) -> DataFrame:
    """Of each row: size of its set, a digest of it, a key for each band, one byte for each place. Empty sets have no digest."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            for part, some in parts_of(batch, "text"):
                doc, value = sets_of(some, size)
                n = np.bincount(doc, minlength=len(some))
                sig = signatures(doc, value, len(some))
                keys = np.zeros((len(some), BANDS), np.uint64)
                for k in range(ROWS):
                    keys = mixed(keys * GOLDEN + sig.reshape(-1, BANDS, ROWS)[:, :, k] + np.arange(BANDS, dtype=np.uint64))
                small = (mixed(sig + GOLDEN) >> np.uint64(56)).astype(np.uint8)
                raw = value.astype("<u8").tobytes()
                stop = np.cumsum(n)
                digests = [hashlib.blake2b(raw[8 * (e - k) : 8 * e], digest_size=16).digest() if k else None for e, k in zip(stop.tolist(), n.tolist(), strict=True)]
                bands = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * BANDS, pa.int32()), pa.array(keys.view(np.int64).ravel(), pa.int64()))
                columns = [part.column(0), part.column(1), part.column(2), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), bands, pa.array([s.tobytes() for s in small], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "file", "row", "n", "digest", "bands", "sig"])

    return docs.select("doc_id", *locator("file", "row"), "text").mapInArrow(run, FEATURES.format(kind))


def groups_of(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Whole groups of rows, which come sorted by ``key``; several groups may come as one table."""
    held = None
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        last = table.slice(len(table) - 1)
        names = [table.column(k).to_numpy() != last.column(k)[0].as_py() for k in key]
        other = np.flatnonzero(np.logical_or.reduce(names))
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).combine_chunks()
    if held is not None and len(held):
        yield held


def alike_pairs(comp: np.ndarray, n: np.ndarray, sig: np.ndarray, cross: np.ndarray, alike: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a block, as two rows of indices, of different components with alike signatures, and their equal places.

    ``cross`` tells the two blocks apart when two meet.
    """
    found, score = [np.empty((2, 0), np.int64)], [np.empty(0, np.int64)]
    two = bool(cross.any()) and not bool(cross.all())
    for i in range(len(comp) - 1):
        near = (comp[i + 1 :] != comp[i]) & (100 * np.minimum(n[i + 1 :], n[i]) >= least * np.maximum(n[i + 1 :], n[i]))
        if two:
            near &= cross[i + 1 :] != cross[i]
        j = np.flatnonzero(near) + i + 1
        if len(j):
            same = (sig[j] == sig[i]).sum(axis=1)
            good = same >= alike * PLACES
            found.append(np.stack([np.full(int(good.sum()), i), j[good]]))
            score.append(same[good])
    return np.concatenate(found, axis=1), np.concatenate(score)


class Union:
    """Components of some names, which are joined pair by pair."""

    def __init__(self, names):
        self.parent = {name: name for name in names}

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart."""
        a, b = self.root(a), self.root(b)
        self.parent[b] = a
        return a != b


def central_pairs(comp: np.ndarray, pairs: np.ndarray, score: np.ndarray) -> list[tuple[int, int]]:
    """The most central class with all that are like it, then the most central of the others, and so on; no pair closes a circle."""
    central = np.bincount(pairs[0], score, len(comp)) + np.bincount(pairs[1], score, len(comp))
    rank = np.empty(len(comp), int)
    rank[np.argsort(-central, kind="stable")] = np.arange(len(comp))
    hub = np.where(rank[pairs[0]] < rank[pairs[1]], pairs[0], pairs[1])
    other = pairs.sum(axis=0) - hub
    order = np.lexsort((-score, rank[hub]))
    union = Union(set(comp.tolist()))
    return [(h, o) for h, o in zip(hub[order].tolist(), other[order].tolist(), strict=True) if union.join(int(comp[h]), int(comp[o]))]


KEY = ["key", "i", "j"]
EDGE = "a long, b long, ca long, cb long"


def in_blocks(rows: DataFrame, columns: list[str], kinds: str, found) -> DataFrame:
    """``found`` of each block of ``rows``: a function of the block's table that gives rows of ``kinds``."""
    names = [k.split()[0] for k in kinds.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for table in groups_of(batches, KEY):
            key, i, j = (table.column(c).to_numpy() for c in KEY)
            new = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            out = []
            for s, e in zip([0, *new.tolist()], [*new.tolist(), len(key)], strict=True):
                out += found(table.slice(s, e - s))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=names)

    keyed = rows.repartition(*KEY).sortWithinPartitions(*KEY, "id")
    return keyed.select(*KEY, *columns).mapInArrow(run, kinds)


def alike_of(block: pa.Table, alike: float, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids, comp, n, side = (block.column(c).to_numpy() for c in ("id", "comp", "n", "side"))
    sig = np.frombuffer(b"".join(block.column("sig").to_pylist()), np.uint8).reshape(-1, PLACES)
    return ids, comp, *alike_pairs(comp, n, sig, side, alike, least)


def tried_first(rows: DataFrame, alike: float, least: int) -> DataFrame:
    """Of each block, a pair at most for each class, from the most central classes outwards."""

    def found(block: pa.Table) -> list[tuple]:
        ids, comp, pairs, score = alike_of(block, alike, least)
        return [(ids[x], ids[y], comp[x], comp[y]) for x, y in central_pairs(comp, pairs, score)]

    return in_blocks(rows, ["id", "comp", "n", "sig", "side"], EDGE, found)


def left_over(rows: DataFrame, alike: float, least: int) -> DataFrame:
    """``key``, ``i``, ``j``, ``id`` of the classes that are like one of another component in their block."""

    def found(block: pa.Table) -> list[tuple]:
        ids, _, pairs, _ = alike_of(block, alike, least)
        key, i, j = (block.column(c)[0].as_py() for c in KEY)
        return [(key, i, j, ids[x]) for x in np.unique(pairs).tolist()]

    return in_blocks(rows, ["id", "comp", "n", "sig", "side"], "key long, i long, j long, id long", found)


def all_links(rows: DataFrame, least: int, size: int) -> DataFrame:
    """Links of each block (rows with ``text``) between different components, as far as they connect; by full sets.

    The sets of all but the largest component are looked up in an index of all sets of the block.
    """

    def found(block: pa.Table) -> list[tuple]:
        ids, comp = (block.column(c).to_numpy() for c in ("id", "comp"))
        number = defaultdict(count().__next__)
        sets = [np.fromiter((number[x] for x in shingles(words_of(t), size)), np.int64) for t in texts_of(block, "text")]
        n = np.array([len(x) for x in sets])
        owner = np.repeat(np.arange(len(sets)), n)
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        owner, begin = owner[order], np.searchsorted(flat[order], np.arange(len(number) + 1))
        names, sizes = np.unique(comp, return_counts=True)
        main = names[np.argmax(sizes)]
        union, links = Union(names.tolist()), []
        for u in np.flatnonzero(comp != main).tolist():
            both = np.bincount(np.concatenate([owner[begin[x] : begin[x + 1]] for x in sets[u].tolist()]), minlength=len(sets))
            linked = (100 * both >= least * (n + n[u] - both)) & (comp != comp[u])
            links += [(ids[u], ids[v], comp[u], comp[v]) for v in np.flatnonzero(linked).tolist() if union.join(int(comp[u]), int(comp[v]))]
        return links

    return in_blocks(rows, ["id", "comp", "text"], EDGE, found)


def verified(edges: DataFrame, texts: DataFrame, least: int, size: int) -> DataFrame:
    """``edges`` with ``linked``: 100 times the shared shingles of the full sets are at least ``least`` times all.

    A class with many edges has its text sent once for each 64 of them.
    """
    edges = edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(1 << 20)) % F.greatest(F.lit(1), F.ceil(F.col("of_a") / 64)))
    others = edges.join(texts.withColumnRenamed("id", "b"), "b").select("a", "salt", "b", "ca", "cb", "text")
    heads = edges.select("a", "salt").distinct().join(texts.withColumnRenamed("id", "a"), "a")
    nobody = F.lit(None).cast("long")
    rows = others.unionByName(heads.select("a", "salt", nobody.alias("b"), nobody.alias("ca"), nobody.alias("cb"), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        head, owner = set(), None
        for part, texts in (x for batch in batches for x in parts_of(batch, "text")):
            out = []
            names = [part.column(k).to_pylist() for k in range(5)]
            for a, salt, b, ca, cb, text in zip(*names, texts, strict=True):
                own = shingles(words_of(text), size)
                if b is None:
                    head, owner = own, (a, salt)
                    continue
                assert owner == (a, salt)
                both = len(head & own)
                out.append((a, b, ca, cb, 100 * both >= least * (len(head) + len(own) - both)))
            if out:
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.bool_())], names=["a", "b", "ca", "cb", "linked"])

    keyed = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return keyed.select("a", "salt", "b", "ca", "cb", "text").mapInArrow(run, "a long, b long, ca long, cb long, linked boolean")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) for all nodes of the edges (``x``, ``y``).

    Each round takes the smallest label among the neighbours and then that label's own label.
    """
    both = stored(edges.union(edges.select("y", "x")).where("x <> y").distinct(), "edges")
    labels = stored(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.first("x")).alias("root")), "labels")
    while True:
        near = both.join(labels, both["y"] == labels["node"]).groupBy("x").agg(F.min("root").alias("near"))
        lower = labels.join(near, labels["node"] == near["x"]).select("node", F.least("root", "near").alias("low"), "root")
        lower = stored(lower, "lower")
        heads = lower.select(F.col("node").alias("head"), F.col("low").alias("head_low"))
        new = lower.join(heads, lower["low"] == heads["head"], "left").select("node", F.coalesce("head_low", "low").alias("new"), "root")
        new = stored(new, "labels")
        changed = new.where("new <> root").limit(1).count()
        labels = new.select("node", F.col("new").alias("root"))
        if not changed:
            return labels


def in_apart_buckets(members: DataFrame, sets: DataFrame, comp: DataFrame | None) -> DataFrame:
    """Classes of buckets with several components, dealt to blocks that meet: ``key``, ``i``, ``j``, ``side`` and what ``sets`` has."""
    now = members.withColumn("comp", F.col("id")) if comp is None else members.join(comp, "id", "left").select("key", "id", F.coalesce("comp", "id").alias("comp"))
    counts = now.groupBy("key", "comp").agg(F.count("*").alias("m"))
    apart = counts.groupBy("key").agg(F.sum("m").alias("size"), F.count("*").alias("comps"), F.max(F.struct("m", "comp")).alias("main")).where("comps > 1")
    whole = F.col("size") <= BLOCK
    apart = apart.select(
        "key", F.col("main.comp").alias("main"),
        F.when(whole, 0).otherwise(F.ceil(F.col("main.m") / BLOCK)).alias("mains"),  # blocks of the largest component
        F.when(whole, 1).otherwise(F.ceil((F.col("size") - F.col("main.m")) / BLOCK)).alias("others"),
    )
    rows = now.join(apart, "key").join(sets, "id")
    mark, in_main = F.xxhash64("id"), (F.col("mains") > 0) & (F.col("comp") == F.col("main"))
    rows = rows.withColumn("at", F.when(in_main, F.pmod(mark, F.col("mains"))).otherwise(F.col("mains") + F.pmod(mark, F.col("others"))))
    first = F.when(in_main, F.col("mains")).otherwise(F.lit(0).cast("long"))
    meets = F.transform(
        F.sequence(first, F.col("mains") + F.col("others") - 1),
        lambda o: F.struct(F.least("at", o).alias("i"), F.greatest("at", o).alias("j"), (F.col("at") > o).alias("side")),
    )
    return rows.withColumn("meet", F.explode(meets)).select("key", "meet.i", "meet.j", "meet.side", "id", "comp", *[c for c in sets.columns if c != "id"])


def joined(comp: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """``comp`` (``id``, ``comp`` of classes that have been linked) after ``links``."""
    if not links.take(1):
        return comp
    roots = components(links.select(F.col("ca").alias("x"), F.col("cb").alias("y")))
    ends = F.array(F.struct(F.col("a").alias("id"), F.col("ca").alias("comp")), F.struct(F.col("b").alias("id"), F.col("cb").alias("comp")))
    known = links.select(F.explode(ends).alias("end")).select("end.*").distinct()
    known = known if comp is None else comp.unionByName(known).distinct()
    return stored(known.join(roots, known["comp"] == roots["node"], "left").select("id", F.coalesce("root", "comp").alias("comp")), "comp")


def linked(members: DataFrame, sets: DataFrame, texts: DataFrame, alike: float, least: int, size: int) -> DataFrame | None:
    """``id`` and ``comp`` of classes that are connected to others.

    ``members``: ``band``, ``key``, ``id`` of classes in shared buckets. ``sets``: ``id``, ``n``, ``sig`` of them.
    """
    comp = None
    for low, high in PHASES:
        here = members.where((F.col("band") >= low) & (F.col("band") < high)).select("key", "id")
        pairs = tried_first(in_apart_buckets(here, sets, comp), alike, least)
        # of pairs that several buckets have, one; the ends of all in one order
        turned = F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("cb").alias("ca"), F.col("ca").alias("cb"))
        pairs = pairs.select(F.when(F.col("a") < F.col("b"), F.struct("a", "b", "ca", "cb")).otherwise(turned).alias("p")).select("p.*")
        pairs = stored(pairs.distinct(), "pairs")
        degree = pairs.groupBy("a").agg(F.count("*").alias("of_a"))
        comp = joined(comp, stored(verified(pairs.join(degree, "a"), texts, least, size), "verified").where("linked"))

    blocks = in_apart_buckets(members.select("key", "id"), sets, comp)
    rest = stored(left_over(blocks, alike, least), "rest")
    # of blocks with the same classes, one
    own = rest.groupBy(*KEY).agg(F.xxhash64(F.sort_array(F.collect_list("id"))).alias("same"), F.count("*").alias("m"))
    one = own.groupBy("same", "m").agg(F.min(F.struct(*KEY)).alias("k")).select("k.*")
    rest = rest.join(one, KEY, "left_semi").join(texts, "id")
    rest = rest.withColumn("comp", F.col("id")) if comp is None else rest.join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    return joined(comp, stored(all_links(rest, least, size), "links"))


def near_duplicates(docs: DataFrame, *, size: int = 5, least: int = 80) -> DataFrame:
    """Each row of ``docs`` (``doc_id``, ``text``) with the component it is connected to.

    A row's set are its distinct runs of ``size`` words, A-Z lower-cased, or all its words if it has fewer. Rows are linked if their sets share ``least`` hundredths of all their shingles. Returns ``doc_id``,
    ``n_shingles``, ``component_id`` (the smallest ``doc_id`` of the component), ``kept`` (``doc_id`` is
    that), ``file`` and ``row`` that name the row, and ``first`` (it is the component's first row).

    Null or empty text, or one without words, has an empty set and is a component of its own, also among
    its like. Repeated rows are linked. A null identifier comes after all others. No rows give none.
    """
    docs = located(docs)
    # the id names a class of equal sets; it is stored with the rows, so that it stays
    rows = stored(featured(docs, size).withColumn("id", F.monotonically_increasing_id()), "features")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "file", "row", "id")
    rep = rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min(order).alias("rep"))
    classes = stored(rep.select("digest", "rep", F.col("rep.id").alias("id")), "classes")
    reps = rows.select("id", "n", "sig", "bands", "file", "row").join(classes.select("id"), "id", "left_semi")

    keyed = stored(reps.select("id", F.posexplode("bands").alias("band", "key")), "bands")
    shared = keyed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
    members = stored(keyed.join(shared, "key", "left_semi"), "members")
    ids = stored(members.select("id").distinct(), "ids")
    needed = stored(reps.join(ids, "id", "left_semi").select("id", "n", "sig", "file", "row"), "needed")
    places = needed.select("id", F.col("file").alias("f"), F.col("row").alias("r"))
    texts = docs.select("text", *locator("file", "row")).join(places.hint("merge"), (F.col("file") == F.col("f")) & (F.col("row") == F.col("r")))
    texts = stored(texts.select("id", "text"), "texts")
    comp = linked(members, needed.select("id", "n", "sig"), texts, least / 100 - MARGIN, least, size)

    if comp is None:
        owned = classes.select("digest", F.col("rep").alias("head"))
    else:
        joined = classes.join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        heads = joined.groupBy("comp").agg(F.min("rep").alias("head"))
        owned = joined.join(heads, "comp").select("digest", "head")
    whole = rows.select("doc_id", "n", "digest", "file", "row").join(stored(owned, "owned"), "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id"))
    leads = F.col("digest").isNull() | ((F.col("head.file") == F.col("file")) & (F.col("head.row") == F.col("row")))
    return whole.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "file", "row", leads.alias("first"))


def without_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The first row of each component of ``docs``, with all its columns and no others."""
    docs = located(docs)
    gone = near_duplicates(docs, **options).where("not first").select(F.col("file").alias("gone_file"), F.col("row").alias("gone_row"))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *locator("file", "row"))
    return named.join(gone.hint("merge"), (F.col("file") == F.col("gone_file")) & (F.col("row") == F.col("gone_row")), "left_anti").select("doc.*")
