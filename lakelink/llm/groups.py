"""Connected groups of near-duplicates from candidate buckets, without listing all pairs of a bucket.

First every item proposes one pair: itself and the best-connected member of its buckets. Verified pairs merge groups. In buckets that
still hold several groups, rounds of hashed picks pair every item outside the largest group with a member of it and of the others, and the
last step tests such items against every member of another group, first by a cheap bound:
so each candidate pair is either within a group or has been tested, and the groups are exact for the candidates.

Payloads that are sets have a bound that spares the rounds most near copies just below the threshold: elements that no other
candidate holds cannot be shared, so an item goes on only if its bucket has a set of a size with which the others can suffice.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.buckets import BLOCK, Common
from .scratch import drop, release, save
from .wordhash import tidy_group


def components(links: DataFrame) -> DataFrame:
    """(id, root): the smallest id reachable over links (a, b), for ids that have a link. Smallest labels spread and jump until none changes."""
    edges = save(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct())
    label = save(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("root")))
    while True:
        seen = edges.join(label.select(F.col("id").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("m"))
        low = label.join(seen, label["id"] == seen["a"]).select("id", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        low = save(low)
        jump = low.select(F.col("id").alias("root"), F.col("root").alias("far"))
        new = save(low.join(jump, "root", "left").select("id", F.least("root", F.coalesce("far", "root")).alias("root"), "old"))
        moved = new.filter("root <> old").limit(1).count()
        drop(label, low)
        label = new.select("id", "root")
        label._lakelink_path = new._lakelink_path
        if not moved:
            drop(edges)
            return label


def relabel(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """comp after merging what links connect."""
    if comp is None:
        return components(links)
    a, b = (comp.select(F.col("id").alias(x), F.col("root").alias(f"r{x}")) for x in "ab")
    lifted = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).filter("a <> b").distinct()
    top = components(lifted)
    every = comp.unionByName(lifted.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(comp.select("id"), "id", "left_anti").select("id", F.col("id").alias("root")))
    return save(every.join(top.select(F.col("id").alias("root"), F.col("root").alias("up")), "root", "left").select("id", F.coalesce("up", "root").alias("root")))


def sizes(payload: DataFrame, live: DataFrame) -> DataFrame:
    """(id, n, most) of the items of live: the size of the set x and how many of its elements another of these sets holds."""
    held = payload.join(live.select("id").distinct(), "id", "left_semi")
    alone = held.select("id", F.explode("x").alias("e")).groupBy("e").agg(F.count("*").alias("c"), F.min("id").alias("id")).filter("c = 1")
    alone = alone.groupBy("id").agg(F.count("*").alias("own"))
    return held.select("id", F.size("x").alias("n")).join(alone, "id", "left").select("id", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("most"))


def promising(minor: DataFrame, marked: DataFrame, fits: Callable[[Column, Column, Column, Column], Column]) -> DataFrame:
    """Rows of minor that fit some size of another group's sets in their bucket. A bucket has one row for each size, not for each item."""
    there = marked.groupBy(F.col("key").alias("k2"), F.col("n").alias("n2")).agg(F.max("most").alias("most2"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    other = (F.col("lo") != F.col("root")) | (F.col("hi") != F.col("root"))
    return minor.join(there, (F.col("key") == F.col("k2")) & other & fits(F.col("n"), F.col("most"), F.col("n2"), F.col("most2")), "left_semi")


def hub_pairs(buckets: DataFrame, near: Callable[[Column, Column], Column], sift: bool) -> DataFrame:
    """First pairs (a, b): each item and the best-connected member that it meets, the centre of a group of copies if it is there."""
    degree = buckets.join(buckets.groupBy("key").agg(F.count("*").alias("n")), "key").groupBy("id").agg(F.sum("n").alias("deg"))
    hub = buckets.join(degree, "id").groupBy("key").agg(F.max(F.struct("deg", (-F.col("id")).alias("m"), *(["sig"] if sift else []))).alias("x"))
    met = buckets.join(hub, "key").filter(F.col("id") != -F.col("x.m")).filter(near(F.col("sig"), F.col("x.sig")) if sift else F.lit(True)).groupBy("id").agg(F.max("x").alias("x"))
    return met.select(F.least("id", -F.col("x.m")).alias("a"), F.greatest("id", -F.col("x.m")).alias("b")).distinct()


def set_links(percent: int):
    """(key, id, root, minor, x) of one part -> (a, b): one link for each two groups of a bucket that are linked, if a minor item has it. All pairs of a bucket are counted."""

    def run(keys, table):
        table = table.take(pc.sort_indices(table.select(["key", "minor", "id"]), sort_keys=[("key", "ascending"), ("minor", "descending"), ("id", "ascending")])).combine_chunks()
        key, ids, root = (table.column(c).to_numpy() for c in ("key", "id", "root"))
        minor, x = table.column("minor").to_numpy().astype(np.int64), table.column("x").combine_chunks()
        off, val = np.concatenate([[0], np.cumsum(x.value_lengths().to_numpy())]), x.flatten().to_numpy()
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        ends = np.append(starts[1:], len(key))
        links = [np.zeros((0, 2), np.int64)]
        for s, m, e in zip(starts.tolist(), (starts + np.add.reduceat(minor, starts)).tolist(), ends.tolist()):
            if s == m or e - s < 2:
                continue
            # minor items against all of the bucket
            both = Common(np.concatenate([off[s : m + 1] - off[s], off[s + 1 : e + 1] - off[s] + off[m] - off[s]]), np.concatenate([val[off[s] : off[m]], val[off[s] : off[e]]]), 0, m - s, m - s + e - s)
            size = np.diff(off[s : e + 1])
            for a in range(0, m - s, BLOCK):
                b = min(a + BLOCK, m - s)
                like = (100 + percent) * both.of(a, b).astype(np.int64) >= percent * (size[a:b, None] + size)
                i, j = np.nonzero(like & (root[s + a : s + b, None] != root[s:e]))
                if len(i):
                    two = np.sort(np.stack([root[s + a + i], root[s + j]], 1), axis=1)
                    one = np.unique(two, axis=0, return_index=True)[1]
                    links.append(np.sort(np.stack([ids[s + a + i[one]], ids[s + j[one]]], 1), axis=1))
        every = np.unique(np.concatenate(links), axis=0)
        return pa.table({"a": every[:, 0], "b": every[:, 1]})

    return run


def connect(buckets: DataFrame, payload: DataFrame | None, linked: Callable[[Column, Column], Column] | None, near: Callable[[Column, Column], Column], rounds: int = 3, fits: Callable[[Column, Column, Column, Column], Column] | None = None, sift: bool = False, first: DataFrame | None = None, verify: Callable[[DataFrame], DataFrame] | None = None, every: Callable[[DataFrame], DataFrame] | None = None, percent: int | None = None) -> DataFrame | None:
    """(id, root) of all items in groups of at least two.

    buckets: (key, id, sig), keys shared by at least two items, written. payload: (id, x) of these items.
    linked: whether two payloads are linked, exactly. near: whether two sigs may belong to linked items; both tests stand inside the last step's join,
    which so makes a row for a link only. fits, for payloads that are sets: whether sets of sizes n and n2, of which most and most2 elements are
    shared with anyone, can be linked; it must allow more for larger most2. sift: drop pairs that are not near before their payloads are read.
    first: pairs (a, b) to begin with, which may hold other ids too. verify: the links among pairs (a, b), in place of payload and linked; rounds then go
    on as long as at least 1 of 10 of a round's pairs is a link. every, with verify: the last step, links that join what is linked among the rows
    (key, id, sig, root, main) of the buckets that still hold several groups.
    percent: payloads are sets, linked if 100 * intersection >= percent * union (what linked says too); the last step then counts the common elements
    of a bucket's sets at once.
    """
    spark = buckets.sparkSession

    def worth(pairs: DataFrame) -> DataFrame:
        a, b = (payload.select(F.col("id").alias(k), F.col("x").alias(f"x{k}")) for k in "ab")
        return pairs.join(a, "a").join(b, "b").filter(linked(F.col("xa"), F.col("xb"))).select("a", "b")

    pairs = save(first) if first is not None else save(hub_pairs(buckets, near, sift))
    comp, tried, live, sized, bounded = None, None, buckets, None, None
    for r in range(1, rounds + 2):
        links = save(worth(pairs) if verify is None else verify(pairs))
        release(spark)
        n_links = links.count()
        if n_links:
            old, comp = comp, relabel(comp, links)
            drop(old)
        drop(links)
        last = r > rounds or verify is not None and r > 1 and 10 * n_links < pairs.count()
        tried = pairs if tried is None else tried.unionByName(pairs)
        held = live.select("key", "id", "sig")
        held = held.join(comp, "id", "left").select("key", "id", "sig", F.coalesce("root", "id").alias("root")) if comp is not None else held.withColumn("root", F.col("id"))
        mixed = held.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key")
        new = save(held.join(mixed, "key"))
        drop(live if live is not buckets else None)
        live = new
        if not live.limit(1).count():
            break
        main = live.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key").agg(F.max(F.struct("n", "root")).alias("x")).select("key", F.col("x.root").alias("main"))
        marked = live.join(main, "key")
        minor = marked.filter("root <> main")
        if fits is not None:
            sized = sized or save(sizes(payload, live))  # those of more candidates than are left, so the bound holds
            marked = marked.join(sized, "id")
            drop(bounded)
            minor = bounded = save(promising(marked.filter("root <> main"), marked, fits))
            if not minor.limit(1).count():
                break
            marked = marked.join(minor.select("key").distinct(), "key", "left_semi")
        if not last:
            # each item outside its bucket's largest group meets one member of that group and one of the others, both picked by a hash of round and bucket
            pick = F.min(F.struct(F.xxhash64("id", "key", F.lit(r)).alias("h"), F.col("id").alias("p"), F.col("root").alias("pr"), *(["sig"] if sift else [])))
            picked = marked.groupBy("key", (F.col("root") == F.col("main")).alias("big")).agg(pick.alias("x"))
            if verify is not None:  # three buckets of an item, by a hash of the round: one pair of an item is tested
                lots = [F.min(F.struct(F.xxhash64("key", F.lit(r), F.lit(k)).alias("h"), "key", "sig", "root")).alias(f"l{k}") for k in range(3)]
                minor = minor.groupBy("id").agg(*lots).select("id", F.explode(F.array_distinct(F.array("l0.key", "l1.key", "l2.key"))).alias("key"), F.array("l0", "l1", "l2").alias("l"))
                minor = minor.withColumn("l", F.get(F.filter("l", lambda x: x["key"] == F.col("key")), 0)).select("id", "key", "l.sig", "l.root")
            two = minor.join(picked, "key").filter("root <> x.pr").filter(near(F.col("sig"), F.col("x.sig")) if sift else F.lit(True))
            if verify is not None:  # one of its picks for each item
                two = two.groupBy("id").agg(F.min("x").alias("x"))
            pairs = two.select(F.least("id", "x.p").alias("a"), F.greatest("id", "x.p").alias("b")).distinct()
        elif every is not None:
            links = save(every(marked))
            release(spark)
            if links.limit(1).count():
                comp = relabel(comp, links)
            drop(links)
            break
        elif percent is not None:
            flag = minor.select("key", "id").distinct().withColumn("minor", F.lit(True))
            rows = marked.select("key", "id", "root", "main").join(flag, ["key", "id"], "left").fillna(False, ["minor"]).filter("minor or root = main")
            parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
            rows = rows.join(payload.select("id", "x"), "id").select("key", "id", "root", "minor", "x", F.pmod(F.xxhash64("key"), F.lit(parts)).alias("part"))
            links = save(rows.groupBy("part").applyInArrow(tidy_group(set_links(percent)), "a long, b long").distinct())
            if links.limit(1).count():
                comp = relabel(comp, links)
            drop(links)
            break
        else:
            own, extra = payload.select("id", "x"), ["n", "most"] if fits is not None else []
            test = near(F.col("si"), F.col("sj")) & linked(F.col("xi"), F.col("xj"))
            if fits is not None:
                test = fits(F.col("ni"), F.col("mosti"), F.col("nj"), F.col("mostj")) & test
            i = minor.join(own, "id").select("key", F.col("id").alias("i"), F.col("root").alias("ri"), F.col("sig").alias("si"), F.col("x").alias("xi"), *(F.col(c).alias(c + "i") for c in extra))
            j = marked.join(own, "id").select("key", F.col("id").alias("j"), F.col("root").alias("rj"), F.col("sig").alias("sj"), F.col("x").alias("xj"), (F.col("root") == F.col("main")).alias("big"), *(F.col(c).alias(c + "j") for c in extra))
            both = i.join(j, (i["key"] == j["key"]) & (F.col("ri") != F.col("rj")) & (F.col("big") | (F.col("i") < F.col("j"))) & test)
            links = save(both.select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b")).distinct())
            if links.limit(1).count():
                comp = relabel(comp, links)
            drop(links)
            break
        pairs = save(pairs.join(tried, ["a", "b"], "left_anti"))
    drop(live if live is not buckets else None, sized, bounded)
    return comp
