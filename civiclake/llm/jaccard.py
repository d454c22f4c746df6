"""Near-duplicate join on word shingles with token-combination prefixes.

A text's set is its distinct ``width``-word shingles (64-bit hashes; A-Z in
lower case).  Two sets link when their Jaccard similarity is at least
``percent``; a document's component is what links reach.

1. One scan takes the size and a 64-bit signature of every set, and counts
   shingles in a fixed table of cells.  Equal sets count as one from here on.
2. Shingles are ordered rare to frequent (by cell count, then hash).  Two
   similar sets differ in at most e = n - ceil(t n) tokens of either, so a
   prefix with e + 1 signatures that no single token can break twice is
   enough.  A rare token is a signature by itself.  Frequent tokens (cells
   over ``FREQUENT`` of the documents) fall into groups and index the pairs
   of one group: a group of k prefix tokens counts k - 1, and the prefix is
   extended until rare tokens and groups add up to e + 1.  The number of
   groups follows the size of the set (powers of two; a set that can match
   the next power takes part in both).  Sets so small that groups cannot add
   up also index their plain prefix.
3. Signatures of one set alone are dropped; the rest pass length and
   positional bounds, first against one hub a signature (the member with the
   fewest tokens before it), which joins large groups of copies without
   their pairs; after that, all pairs that are not yet in one component.
4. Parity sketches give a lower bound of the symmetric difference; pairs
   that survive it are verified on the shingles of their whole texts.  A hub
   with more than ``HOT_PAIRS`` pairs meets them in parts, each in a task of
   its own with one copy of the hub's text, so its text is not shuffled with
   the pairs and no task holds all of them.

No bucket, candidate list or partner list has a cap.  Null and empty texts,
and texts without words, have the empty set and link with nothing; shorter
texts have one shingle, their whole sequence.  Repeated rows are linked like
other equal sets; rows with one id and different texts stay separate sets.
An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiclake.llm.common import GOLDEN, chunks, distinct_in_rows, mix, plain, prepare, shingles, shuffle_partitions, split_words, text_key
from civiclake.session import Scratch, materialize

#: Cells of the frequency table (a power of two; the table that tasks get has one byte a cell).
CELL_BITS = 17
#: A shingle is frequent if its cell exceeds the mean by this share of the documents.
FREQUENT = 1 / 64
#: Least number of groups of frequent tokens; a set of 2**l tokens has 2**l / 32 at least.
GROUPS = 4
FREQUENT_CLASS = 64
#: Text bytes that one numpy step works on: shingle arrays take some thirty times that.
STEP_BYTES = 2 << 20
#: Pairs of one set that meet its row in one task; a set with more has its row once for each part of them.
HOT_PAIRS = 256


def allowance(n, percent: int):
    """Tokens of a set of n that a similar set may lack: n - ceil(percent n / 100)."""
    return n - -(-percent * n // 100)


def small_limit(percent: int) -> int:
    """Sets up to this size index a plain prefix too: those whose groups may not add up, and their partners."""
    weak = max(n for n in range(1, 64) if n - GROUPS <= allowance(n, percent))
    return weak * 100 // percent


def groups_at(level: int) -> int:
    return max(GROUPS, (1 << level) // 32)


def set_signature(h: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and order-free 64-bit hash of each row's distinct shingles."""
    n = np.bincount(rows, minlength=n_rows)
    total = np.zeros(n_rows, np.uint64)
    if len(h):
        start = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        total[rows[start]] = np.add.reduceat(mix(h ^ GOLDEN), start)
    return n, mix(total + n.astype(np.uint64) * GOLDEN).view(np.int64)


def sets_of(b: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    h, rows = shingles(split_words(plain(b.column("text")), lower_ascii=True), width)
    return distinct_in_rows(h, rows)


def measure(docs: DataFrame, width: int) -> DataFrame:
    """kind 0: doc_id, doc_key, a = set size, b = signature; kind 1: a = cell, b = its count in one task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.int64)
        names = ["kind", "doc_id", "doc_key", "a", "b"]
        for b in chunks(batches, "text", STEP_BYTES):
            h, rows = sets_of(b, width)
            n, sig = set_signature(h, rows, b.num_rows)
            cells += np.bincount((h >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=len(cells))
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(n), np.int32)), b.column("doc_id"), b.column("doc_key"), pa.array(n.astype(np.int64)), pa.array(sig)], names=names)
        used = np.flatnonzero(cells)
        for part in np.array_split(used, max(1, len(used) // 20000)):
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(part), np.int32)), pa.nulls(len(part), pa.int64()), pa.nulls(len(part), pa.int64()), pa.array(part), pa.array(cells[part])], names=names)

    return docs.mapInArrow(work, "kind int, doc_id long, doc_key long, a long, b long")


def frequency_classes(measured: DataFrame) -> np.ndarray:
    """Class of each cell, rare to frequent; one row a cell reaches the driver (2**CELL_BITS at most)."""
    docs = measured.where("kind = 0").count()
    got = measured.where("kind = 1").groupBy("a").agg(F.sum("b").alias("n")).toArrow()
    cells = np.zeros(1 << CELL_BITS, np.int64)
    cells[got["a"].to_numpy()] = got["n"].to_numpy()
    mean = cells.mean()
    excess = cells - mean
    level = np.where(excess > 6 * math.sqrt(mean), 1 + np.log2(np.maximum(excess, 1)).astype(np.int64), 0)
    return (level + FREQUENT_CLASS * (excess > max(FREQUENT * docs, 6 * math.sqrt(mean)))).astype(np.uint8)


def combinations(h: np.ndarray, cls: np.ndarray, percent: int) -> tuple[list[int], list[int]]:
    """Signatures and positions of the frequent pairs in a set's extended prefix (tokens in global order)."""
    n = len(h)
    need = allowance(n, percent) + 1
    rare = int(np.searchsorted(cls >= FREQUENT_CLASS, True))
    toks, poss = [], []
    low = n.bit_length() - 1
    for level in (low, low + 1):
        if level > low and 100 * n < percent << level:
            continue
        groups = groups_at(level)
        credit, member = rare, {}
        for p in range(rare, n):
            g = member.setdefault(int(h[p] >> np.uint64(7)) % groups, [])
            if g:
                credit += 1
                for q in g:
                    key = (int(h[q]) * 0x9E3779B97F4A7C15 + int(h[p]) * 0xD1342543DE82EF95 + level) & (2**64 - 1)
                    toks.append(key | 1)
                    # common tokens before these two lie in other groups, one in each at most
                    poss.append(p - groups)
            g.append(p)
            if credit >= need:
                break
    return toks, poss


def prefix_rows(docs: DataFrame, classes: np.ndarray, width: int, percent: int) -> DataFrame:
    """tok, sig, n, pos: the signatures of every set (a set once a task).  Odd tok: a combination."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)
    small = small_limit(percent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = shared.value
        seen: set[int] = set()
        for b in chunks(batches, "text", STEP_BYTES):
            h, rows = sets_of(b, width)
            n, sig = set_signature(h, rows, b.num_rows)
            fresh = np.zeros(len(n), bool)
            for i, s in enumerate(sig.tolist()):
                if n[i] and s not in seen:
                    seen.add(s)
                    fresh[i] = True
            keep = fresh[rows]
            h, rows = h[keep], rows[keep]
            if not len(h):
                continue
            cls = classes[(h >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
            order = np.lexsort((h, cls, rows))
            h, cls, rows = h[order], cls[order], rows[order]
            start = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(n)))))
            pos = np.arange(len(h)) - start[rows]
            reach = allowance(n, percent)
            frequent = cls >= FREQUENT_CLASS
            single = (pos <= reach[rows]) & (~frequent | (n[rows] <= small))
            toks, srows, poss = [h[single] & ~np.uint64(1)], [rows[single]], [pos[single]]
            deep = np.unique(rows[(pos <= reach[rows]) & frequent])
            for i in deep.tolist():
                t, p = combinations(h[start[i] : start[i + 1]], cls[start[i] : start[i + 1]], percent)
                toks.append(np.array(t, np.uint64))
                srows.append(np.full(len(t), i))
                poss.append(np.array(p, np.int64))
            row = np.concatenate(srows)
            for at in range(0, len(row), 100_000):
                r = row[at : at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(toks)[at : at + 100_000].view(np.int64)), pa.array(sig[r]), pa.array(n[r], pa.int32()), pa.array(np.concatenate(poss)[at : at + 100_000], pa.int32())],
                    names=["tok", "sig", "n", "pos"],
                )

    return docs.mapInArrow(work, "tok long, sig long, n int, pos int")


def may_link(nx, px, ny, py, percent: int):
    """Length bound, and the positional bound at a pair's first common signature."""
    n1, n2 = nx.cast("long"), ny.cast("long")
    rest = F.least(n1 - px, n2 - py)
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & ((100 + percent) * rest >= percent * (n1 + n2))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, comp (its smallest node) of undirected edges (u, v), by alternating large and small stars.

    Every round is written to the shared folder, so lineage stays short and a
    lost executor costs one round.
    """
    edges = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", scratch)
    while True:
        n, parents = edges.agg(F.count("*"), F.count_distinct("u")).collect()[0]
        # a forest of stars: each node has one parent, and no parent has one
        if n == parents and edges.select(F.col("v").alias("u")).join(edges, "u", "left_semi").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        stars = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = materialize(stars, "edges", scratch)


def sketch_bits(n: int) -> int:
    """Bits of a set's parity sketch: a power of two, 2 n at least."""
    return max(256, 1 << (2 * n - 1).bit_length())


def sketches(h: np.ndarray, start: np.ndarray) -> list[bytes]:
    out = []
    for a, z in zip(start[:-1], start[1:]):
        bits = sketch_bits(int(z - a))
        odd = np.bincount((h[a:z] & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
        out.append(np.packbits(odd.astype(np.uint8), bitorder="little").tobytes())
    return out


def sketch_difference(x: bytes, y: bytes) -> int:
    """A lower bound of the symmetric difference of two sets, from their parity sketches."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


class SetTable:
    """Size, sketch and text of the sets that have candidates, bucketed by signature:
    joins on it shuffle only their other side."""

    def __init__(self, docs: DataFrame, wanted: DataFrame, width: int, scratch: Scratch):
        self.spark, self.width, self.scratch = docs.sparkSession, width, scratch
        self.name = f"near_sets_{uuid.uuid4().hex}"
        parts = shuffle_partitions(self.spark)
        found = self._sets(docs).join(wanted.select("sig").distinct(), "sig", "left_semi").dropDuplicates(["sig"])
        found.write.bucketBy(parts, "sig").sortBy("sig").option("path", scratch.folder("near-sets")).format("parquet").saveAsTable(self.name)
        self.table = self.spark.table(self.name)

    def _sets(self, docs: DataFrame) -> DataFrame:
        width = self.width

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for b in chunks(batches, "text", STEP_BYTES):
                h, rows = sets_of(b, width)
                n, sig = set_signature(h, rows, b.num_rows)
                fresh = [i for i, s in enumerate(sig.tolist()) if n[i] and not (s in seen or seen.add(s))]
                start = np.concatenate(([0], np.cumsum(n)))
                got = sketches(h, start)
                pick = pa.array(fresh, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(sig[fresh]), pa.array(n[fresh], pa.int32()), pa.array([got[i] for i in fresh], pa.binary()), b.column("text").take(pick)], names=["sig", "n", "sketch", "text"])

        return docs.mapInArrow(work, "sig long, n int, sketch binary, text string")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def verified(self, pairs: DataFrame, percent: int) -> DataFrame:
        """The pairs (x, y) whose sets reach the similarity."""
        width = self.width

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                total = b.column("nx").to_numpy().astype(np.int64) + b.column("ny").to_numpy()
                apart = np.array([sketch_difference(p, q) for p, q in zip(b.column("sx").to_pylist(), b.column("sy").to_pylist())], np.int64)
                # overlap = (total - difference) / 2
                yield b.filter(pa.array((100 + percent) * (total - apart) >= 2 * percent * total)).select(["x", "y", "xparts", "yparts"])

        def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in chunks(chunks(batches, "tx", STEP_BYTES), "ty", STEP_BYTES):
                both = []
                for side in ("tx", "ty"):
                    both.append(distinct_in_rows(*shingles(split_words(plain(b.column(side)), lower_ascii=True), width)))
                (hx, rx), (hy, ry) = both
                h, rows = np.concatenate((hx, hy)), np.concatenate((rx, ry))
                order = np.lexsort((h, rows))
                h, rows = h[order], rows[order]
                same = (h[1:] == h[:-1]) & (rows[1:] == rows[:-1])
                common = np.bincount(rows[1:][same], minlength=b.num_rows)
                union = np.bincount(rows, minlength=b.num_rows) - common
                yield b.filter(pa.array(100 * common >= percent * union)).select(["x", "y"])

        ends = pairs.select(F.col("x").alias("sig")).unionByName(pairs.select(F.col("y").alias("sig")))
        busy = ends.groupBy("sig").agg(F.ceil(F.count("*") / HOT_PAIRS).cast("int").alias("parts")).where("parts > 1")
        # at most one hub for HOT_PAIRS / 2 pairs; written, so Catalyst broadcasts it only if it is small
        busy = materialize(busy, "near-busy", self.scratch)
        if busy.isEmpty():
            hubs, dealt = None, pairs.select("x", "y", F.lit(1).alias("xparts"), F.lit(1).alias("yparts"))
        else:
            hubs = materialize(self.table.join(busy, "sig"), "near-hubs", self.scratch)
            dealt = pairs
            for s in ("x", "y"):
                dealt = dealt.join(busy.select(F.col("sig").alias(s), F.col("parts").alias(f"{s}parts")), s, "left")
            dealt = dealt.select("x", "y", F.coalesce("xparts", F.lit(1)).alias("xparts"), F.coalesce("yparts", F.lit(1)).alias("yparts"))
            # the busier end is y, met last: its text is not shuffled with its pairs
            turn = lambda a, b: F.when(F.col("xparts") > F.col("yparts"), F.col(b)).otherwise(F.col(a))
            dealt = dealt.select(turn("x", "y").alias("x"), turn("y", "x").alias("y"), turn("xparts", "yparts").alias("xparts"), turn("yparts", "xparts").alias("yparts"))
            dealt = materialize(dealt, "near-dealt", self.scratch)

        def side(p: DataFrame, s: str, other: str, hot: bool, cols: tuple[str, ...]) -> DataFrame:
            named = [F.col("sig").alias(s), *[F.col(c).alias(c[0] + s) for c in cols]]
            if not hot:
                return p.join(self.table.select(*named), s)
            # a hub's row once for each part of its pairs
            rows = hubs.select(*named, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
            return p.withColumn("part", F.pmod(F.xxhash64(other), F.col(f"{s}parts")).cast("int")).join(rows, [s, "part"]).drop("part")

        def with_sides(p: DataFrame, *cols: str) -> DataFrame:
            kinds = [(False, False)] if hubs is None else [(False, False), (False, True), (True, True)]
            out = None
            for hot_x, hot_y in kinds:
                mine = p.where(((F.col("xparts") > 1) == F.lit(hot_x)) & ((F.col("yparts") > 1) == F.lit(hot_y)))
                met = side(side(mine, "x", "y", hot_x, cols), "y", "x", hot_y, cols)
                met = met.select("x", "y", "xparts", "yparts", *[c[0] + s for c in cols for s in ("x", "y")])
                out = met if out is None else out.unionByName(met)
            return out

        close = materialize(with_sides(dealt, "n", "sketch").mapInArrow(near, "x long, y long, xparts int, yparts int"), "near-close", self.scratch)
        found = with_sides(close, "text").select("x", "y", "tx", "ty").mapInArrow(exact, "x long, y long")
        return found.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, doc_key (of its text), n_shingles, component_id (smallest id its links reach)
    and group_key, which is the same for the rows of one component (null for the empty set)."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must be between 50 and 100")
    spark: SparkSession = docs.sparkSession
    prepare(spark)
    scratch = Scratch(spark)
    keep = lambda df, label: materialize(df, label, scratch)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("doc_key"), F.col(text_col).alias("text"))
    measured = materialize(measure(rows, width), "near-measured")
    members = measured.where("kind = 0").select("doc_id", "doc_key", F.col("a").alias("n_shingles"), F.col("b").alias("sig"))
    texts = rows.select("text")

    # signatures that two sets share, and the hub of each
    of_tok = Window.partitionBy("tok")
    signed = prefix_rows(texts, frequency_classes(measured), width, percent)
    shared = signed.select("*", F.min("sig").over(of_tok).alias("lo"), F.max("sig").over(of_tok).alias("hi"), F.min(F.struct("pos", "sig", "n")).over(of_tok).alias("hub"))
    buckets = keep(shared.where("lo <> hi").drop("lo", "hi"), "near-buckets")

    sets = SetTable(texts, buckets, width, scratch)
    hub_ok = (F.col("sig") != F.col("hub.sig")) & may_link(F.col("n"), F.col("pos"), F.col("hub.n"), F.col("hub.pos"), percent)
    stars = buckets.where(hub_ok).select(F.least("sig", "hub.sig").alias("x"), F.greatest("sig", "hub.sig").alias("y")).distinct()
    stars = keep(stars, "near-stars")
    star_links = keep(sets.verified(stars, percent), "near-links")
    comp = components(star_links.select(F.col("x").alias("u"), F.col("y").alias("v")), scratch)

    # what is left: pairs of a bucket in different components
    known = buckets.drop("hub").join(comp, F.col("sig") == F.col("node"), "left").select("tok", "sig", "n", "pos", F.coalesce("comp", "sig").alias("comp"))
    open_ = known.select("*", F.min("comp").over(of_tok).alias("lo"), F.max("comp").over(of_tok).alias("hi")).where("lo <> hi").select("tok", "sig", "n", "pos", "comp")
    open_ = keep(open_, "near-open")
    a, b = open_.alias("a"), open_.alias("b")
    cond = (F.col("a.tok") == F.col("b.tok")) & (F.col("a.sig") < F.col("b.sig")) & (F.col("a.comp") != F.col("b.comp"))
    cond = cond & may_link(F.col("a.n"), F.col("a.pos"), F.col("b.n"), F.col("b.pos"), percent)
    seen = a.join(b, cond).groupBy(F.col("a.sig").alias("x"), F.col("b.sig").alias("y")).agg(
        F.count("*").alias("c"), F.max(F.col("a.tok").bitwiseAND(1)).alias("combined"), F.first("a.n").alias("nx"), F.first("b.n").alias("ny"), F.max("a.pos").alias("px"), F.max("b.pos").alias("py")
    )
    # common signatures so far, and at most the rest of either set
    bound = F.col("c") + F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py")) - 1
    left = seen.where((F.col("combined") == 1) | ((100 + percent) * bound >= percent * (F.col("nx") + F.col("ny")))).select("x", "y")
    left = keep(left.join(stars, ["x", "y"], "left_anti"), "near-left")
    links = star_links.unionByName(keep(sets.verified(left, percent), "near-links"))
    comp = components(links.select(F.col("x").alias("u"), F.col("y").alias("v")), scratch)

    reps = members.where("n_shingles > 0").groupBy("sig").agg(F.min("doc_id").alias("least_id"))
    labelled = reps.join(comp, F.col("sig") == F.col("node"), "left").select("sig", "least_id", F.coalesce("comp", "sig").alias("group_key"))
    least = labelled.groupBy("group_key").agg(F.min("least_id").alias("component_id"))
    by_sig = materialize(labelled.join(least, "group_key").select("sig", "group_key", "component_id"), "near-classes")
    sets.drop()
    scratch.clear()
    empty = members.where("n_shingles = 0").select("doc_id", "doc_key", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("group_key"))
    out = members.where("n_shingles > 0").join(by_sig, "sig").select("doc_id", "doc_key", "n_shingles", "component_id", "group_key").unionByName(empty)
    return out.withColumnRenamed("doc_id", id_col)


def one_of_each(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group of ``found`` the row of its smallest id
    (then key) stays, once; rows with the empty set all stay.  Columns of any name keep their values."""
    first = found.where("group_key is not null").groupBy("group_key").agg(F.min(F.struct("doc_id", "doc_key")).alias("k"))
    first = first.select(F.col("k.doc_id").alias("__id"), F.col("k.doc_key").alias("__key"))
    empty = found.where("group_key is null").select(F.col("doc_id").alias("__id"), F.col("doc_key").alias("__key")).distinct()
    # one join for both, so the texts are shuffled to it once
    keepers = first.withColumn("__once", F.lit(True)).unionByName(empty.withColumn("__once", F.lit(False)))
    # the rows' own columns are renamed meanwhile, whatever their names
    names = [f"__keep_{k}" for k in range(len(docs.columns))]
    mine, text = (names[docs.columns.index(c)] for c in (id_col, text_col))
    given = docs.toDF(*names).withColumn("__own", text_key(text)).withColumn("__mine", F.col(mine).cast("long"))
    met = (F.col("__own") == F.col("__key")) & F.col("__mine").eqNullSafe(F.col("__id"))
    # equal rows of a group are told apart by a number
    nth = Window.partitionBy("__own", "__mine").orderBy(F.lit(0))
    kept = given.join(keepers, met).withColumn("__nth", F.row_number().over(nth))
    return kept.where("__nth = 1 or not __once").select(*names).toDF(*docs.columns)
