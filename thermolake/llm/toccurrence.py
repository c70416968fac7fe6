"""Set-similarity search by T-occurrence: which sets of an index share so many tokens with a query set.

A set that reaches the threshold occurs at least T times in the inverted lists of the query's tokens. Up to T - 1
of the lists, the long ones, can be left out of the merge (DivideSkip): what is sought occurs in the short ones
T - L times at least. Their lists are merged and counted, and each candidate is then looked up in the long lists
by binary search.

Sets come in clusters outside of which nothing is linked. Small clusters share an index, several to a task. In a
large one all sets first meet one block of it, which joins most of what belongs together; what is still open is
routed through its rarest tokens alone: the short lists are then one join, bounded by size and position, and the
long ones are probed by comparing the sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermolake.llm import textkit
from thermolake.llm.components import components
from thermolake.session import Scratch

#: Sets of one index, and tokens in them, at most; small clusters are put together up to half of that.
BLOCK, BLOCK_TOKENS = 2048, 1 << 20
#: Lists from so many entries on are long: probing one for some candidates costs less than merging it.
LONG_LIST = 256


class Index:
    """Inverted lists over sets of distinct 64-bit tokens; set i lies from firsts[i] to firsts[i + 1]."""

    def __init__(self, tokens: np.ndarray, firsts: np.ndarray) -> None:
        self.sizes = np.diff(firsts)
        order = np.argsort(tokens, kind="stable")  # within a list, owners ascend
        tokens = tokens[order]
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)[order]
        new = np.concatenate([[True], tokens[1:] != tokens[:-1]]) if len(tokens) else np.zeros(0, bool)
        self.vocabulary = tokens[new]
        self.bounds = np.append(np.flatnonzero(new), len(tokens))

    def search(self, query: np.ndarray, percent: int) -> np.ndarray:
        """The sets whose Jaccard similarity with the query is percent / 100 or more."""
        n = len(query)
        none = np.zeros(0, np.int64)
        if not n or not len(self.vocabulary):
            return none
        at = np.minimum(np.searchsorted(self.vocabulary, query), len(self.vocabulary) - 1)
        at = at[self.vocabulary[at] == query]
        least = -(-percent * n // 100)  # what is shared is at least so much of the larger set, so of this one
        if len(at) < least:
            return none
        lo, hi = self.bounds[at], self.bounds[at + 1]
        length = hi - lo
        order = np.argsort(length, kind="stable")
        lo, hi, length = lo[order], hi[order], length[order]
        long = min(int((length >= LONG_LIST).sum()), least - 1)
        short = len(at) - long
        total = int(length[:short].sum())
        before = np.cumsum(length[:short]) - length[:short]
        merged = np.sort(self.owner[np.repeat(lo[:short] - before, length[:short]) + np.arange(total)])
        first = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]])) if total else none
        found, count = merged[first], np.diff(np.append(first, total))
        m = self.sizes[found]
        fits = (count >= least - long) & (100 * m >= percent * n) & (100 * n >= percent * m)
        found, count, m = found[fits], count[fits], m[fits]
        for k in range(short, len(at)):
            if not len(found):
                return none
            own = self.owner[lo[k] : hi[k]]
            place = np.minimum(np.searchsorted(own, found), len(own) - 1)
            count = count + (own[place] == found)
            going = 100 * (count + len(at) - k - 1) >= percent * (n + m - count - (len(at) - k - 1))
            if not going.all():
                found, count, m = found[going], count[going], m[going]
        return found[100 * count >= percent * (n + m - count)]


def _lists(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    tokens = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    return tokens, np.append(0, np.cumsum(np.diff(column.offsets.to_numpy()))).astype(np.int64)


def _forest(pairs: Iterator[tuple[int, int]]) -> pa.Table:
    """The stars (a, b) of what pairs join; b is the smallest node."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    stars = [(x, find(x)) for x in root]
    return pa.table({k: pa.array([s[i] for s in stars if s[0] != s[1]], pa.int64()) for i, k in enumerate("ab")})


def _linked(query_comps, query_sets, index_comps, index_sets, percent: int) -> Iterator[tuple[int, int]]:
    index = Index(*index_sets)
    tokens, firsts = query_sets
    for i in range(len(firsts) - 1):
        own = tokens[firsts[i] : firsts[i + 1]]
        for other in np.unique(index_comps[index.search(own, percent)]).tolist():
            if other != query_comps[i]:
                yield int(query_comps[i]), other


def _within(percent: int):
    """All sets of a table against each other."""

    def run(rows: pa.Table) -> pa.Table:
        comps, sets = rows.column("comp").to_numpy(), _lists(rows.column("members"))
        found = _forest(_linked(comps, sets, comps, sets, percent))
        textkit.release()
        return found

    return run


def _across(percent: int):
    """The sets of one table against those of another."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _forest(iter(()))
        comps = [t.column("comp").to_numpy() for t in (left, right)]
        found = _forest(_linked(comps[0], _lists(left.column("members")), comps[1], _lists(right.column("members")), percent))
        textkit.release()
        return found

    return run


def joined_components(scratch: Scratch, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """node, component: what links between sets of a cluster join; None where nothing is open. Members: doc_id, comp, cluster; sets: doc_id, members.

    Members of one comp are joined already. A doc_id may have several sets.
    """
    members = scratch.table(members.join(_open_clusters(members), "cluster", "left_semi"), "open_members")
    if not members.limit(1).count():
        return None
    rows = scratch.table(members.join(sets, "doc_id"), "open_sets")
    sizes = rows.groupBy("cluster").agg(F.count("*").alias("n"), F.sum(F.size("members")).alias("tokens"))
    sizes = scratch.table(sizes.withColumn("small", F.expr(f"n <= {BLOCK} and tokens <= {BLOCK_TOKENS}")), "cluster_sizes")
    amount = sizes.where("small").agg(F.coalesce(F.sum(F.greatest(F.col("tokens"), F.col("n") * (BLOCK_TOKENS // BLOCK))), F.lit(0))).first()[0]
    bins = -(-2 * amount // BLOCK_TOKENS) + 1
    placed = rows.join(sizes, "cluster")
    packed = placed.where("small").select(F.pmod(F.xxhash64("cluster"), F.lit(bins)).alias("bin"), "comp", "members")
    links = packed.groupBy("bin").applyInArrow(_within(percent), "a long, b long")
    large = scratch.table(placed.where("not small").select("cluster", "doc_id", "comp", "members", "n", "tokens"), "large_sets")
    if large.limit(1).count():
        links = links.unionByName(_first_look(large, percent))
        links = scratch.table(links, "first_links")
        joined = scratch.table(components(scratch, links, "joined"), "joined_comps")
        left = large.join(joined, large["comp"] == joined["node"], "left").select("cluster", "doc_id", F.coalesce("component", "comp").alias("comp"), "members")
        links = links.unionByName(_routed(scratch, left, percent))
    links = scratch.table(links, "all_links")
    return scratch.table(components(scratch, links, "last"), "last_comps")


def _open_clusters(members: DataFrame) -> DataFrame:
    """The clusters that are in more than one component."""
    return members.groupBy("cluster").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("cluster")


def _first_look(large: DataFrame, percent: int) -> DataFrame:
    """Links between all sets of large clusters and one block of each."""
    block = lambda c: F.pmod(F.xxhash64("doc_id", F.lit(c)), F.ceil(F.greatest(F.col("n") / BLOCK, F.col("tokens") / BLOCK_TOKENS))).cast("int")
    index = large.withColumn("block", block(0)).where("block = 0")
    # the index goes to as many tasks as the cluster has blocks, and each takes the sets of one block
    index = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.ceil(F.greatest(F.col("n") / BLOCK, F.col("tokens") / BLOCK_TOKENS)).cast("int") - 1)))
    cell = ["cluster", "block"]
    columns = [*cell, "comp", "members"]
    return large.withColumn("block", block(1)).select(*columns).groupBy(*cell).cogroup(index.select(*columns).groupBy(*cell)).applyInArrow(_across(percent), "a long, b long")


def _routed(scratch: Scratch, rows: DataFrame, percent: int) -> DataFrame:
    """Links of sets outside of their cluster's largest component with any other set of the cluster: cluster, doc_id, comp, members.

    A pair that reaches the threshold shares one of the rarest tokens of both, at places from which enough
    tokens are left; a token that no other set of the cluster holds is shared with none.
    """
    by_comp = rows.groupBy("cluster", "comp").agg(F.count("*").alias("n"))
    top = by_comp.groupBy("cluster").agg(F.max(F.struct("n", "comp")).alias("top"), F.count("*").alias("comps")).where("comps > 1")
    rows = scratch.table(rows.join(top.select("cluster", F.col("top.comp").alias("top")), "cluster").withColumn("of", F.xxhash64("doc_id", "members")), "routed_sets")
    tokens = rows.select("cluster", "doc_id", "of", "comp", "top", F.size("members").alias("n"), F.explode("members").alias("token"))
    holders = tokens.groupBy("cluster", "token").agg(F.count("*").alias("holders")).where("holders > 1")
    shared = tokens.join(holders, ["cluster", "token"])
    # one row for each set: its shared tokens, the rarest first
    ranked = shared.groupBy("cluster", "doc_id", "of", "comp", "top", "n").agg(F.sort_array(F.collect_list(F.struct("holders", "token"))).alias("ranked"))
    least = F.ceil(F.col("n") * percent / 100.0 - 1e-9)
    prefix = ranked.withColumn("reach", F.size("ranked")).withColumn("keep", (F.col("reach") - least + 1).cast("int")).where("keep > 0")
    placed = prefix.select("cluster", "doc_id", "of", "comp", "top", "n", "reach", F.posexplode(F.slice("ranked", F.lit(1), F.col("keep"))).alias("at", "r"))
    placed = scratch.table(placed.select("cluster", "doc_id", "of", "comp", "top", "n", F.col("r.token").alias("token"), (F.col("reach") - F.col("at")).alias("left")), "placed")
    asks = placed.where("comp <> top").select("cluster", "token", *[F.col(c).alias(f"x_{c}") for c in ("of", "comp", "n", "left")])
    held = placed.select("cluster", "token", *[F.col(c).alias(f"y_{c}") for c in ("of", "comp", "n", "left")])
    fits = f"x_comp <> y_comp and 100 * x_n >= {percent} * y_n and 100 * y_n >= {percent} * x_n and least(x_left, y_left) * {100 + percent} >= {percent} * (x_n + y_n)"
    found = scratch.table(asks.join(held, ["cluster", "token"]).where(fits).select("cluster", "x_of", "x_comp", "y_of", "y_comp").distinct(), "candidates")
    whole = rows.select("cluster", "of", "members").dropDuplicates(["cluster", "of"])
    pairs = found.join(whole.toDF("cluster", "x_of", "x"), ["cluster", "x_of"]).join(whole.toDF("cluster", "y_of", "y"), ["cluster", "y_of"])
    both = F.size(F.array_intersect("x", "y"))
    return pairs.where(100 * both >= percent * (F.size("x") + F.size("y") - both)).select(F.col("x_comp").alias("a"), F.col("y_comp").alias("b")).distinct()
