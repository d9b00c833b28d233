"""Jaccard join of documents on word n-grams: prefix filters, then tries within groups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.batches import Runs, give_back, hash_words, items, map_slices, spans, split_words
from tastegrid.llm.components import components
from tastegrid.llm.exchange import answers_of, exchange, key_bits, map_blocks
from tastegrid.operators.joins import splittable_join
from tastegrid.session import Scratch, ship_package, stored

#: N-grams that one trie holds at most, about; beyond that a group is split.
TASK_GRAMS = 1 << 20
#: N-grams of the small groups that one task takes together, about.
BUNDLE_GRAMS = 1 << 17
#: By how much fewer the pairs by shared grams must be for a cluster to be taken apart.
LOOSER = 8
_BLOCKS = (
    "ids array<long>, sizes array<long>, prints array<string>, counts binary, keys binary, "
    "total long"
)
_CANDIDATES = "doc_id long, print string, keys array<long>"
_SETS = "print string, size long, grams binary"
_EDGES = "a string, b string"


def least_overlap(size, percent: int):
    """Grams that a set of this size shares at least with any set it is linked to."""
    return -(-percent * size // 100)


def mutual_overlap(size, percent: int):
    """Grams that a set of this size shares at least with a linked set that is no smaller."""
    return -(-2 * percent * size // (100 + percent))


def spare(size):
    """Grams by which a set's prefix goes beyond the shortest that would do.

    Two linked sets share at least so many grams of their prefixes, where ``size`` is the
    smaller set's: the commonest ones but that many need not be looked at.
    """
    return 1 + size // 8


def gram_sets(
    texts: pa.Array, length: int
) -> tuple[list[np.ndarray], list[str | None]]:
    """Each text's n-gram hashes, ascending and different, and a 128-bit print of the set.

    Words in lower case (A-Z) between ASCII white space; the whole sequence is the one
    gram of a text with fewer words than ``length``; no grams and no print without words.
    """
    starts, words = split_words(texts, lower=True)
    n_words = np.diff(starts)
    sizes = np.minimum(n_words, length)
    counts = np.where(n_words > 0, n_words - sizes + 1, 0)
    places = spans(starts[:-1], counts)
    hashes = Runs(hash_words(words)).at(places, np.repeat(sizes, counts))
    ends = np.cumsum(counts)
    sets = [np.unique(hashes[e - n : e]) for e, n in zip(ends, counts, strict=True)]
    return sets, [xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets]


def _blocks(docs: DataFrame, length: int, percent: int) -> DataFrame:
    def work(piece: pa.RecordBatch) -> dict:
        sets, prints = gram_sets(pc.fill_null(piece.column("text"), ""), length)
        sizes = np.array([len(s) for s in sets], np.int64)
        counts = np.minimum(sizes, sizes - least_overlap(sizes, percent) + spare(sizes))
        counts[100 * sizes < percent * (sizes + 1)] = 0  # no different set can be near enough
        keys = np.concatenate([s[:n] for s, n in zip(sets, counts.tolist(), strict=True)])
        return {
            "ids": [piece.column("doc_id").to_pylist()], "sizes": [sizes], "prints": [prints],
            "counts": [counts.astype(np.int32).tobytes()], "keys": [keys.tobytes()],
            "total": [len(keys)],
        }

    return map_slices(docs, ["doc_id", "text"], work, _BLOCKS).withColumn(
        "block", F.monotonically_increasing_id()
    )


def _ask(row: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(items(row.column("keys"), np.uint64)[0], return_counts=True)


def _total(keys: np.ndarray, extras: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """In how many sets each key is."""
    _, inverse = np.unique(keys, return_inverse=True)
    return np.bincount(inverse, extras)[inverse]


def _rare_prefix(percent: int):
    """Each set's rarest grams of its prefix that another set has in its prefix too."""
    def work(row: pa.RecordBatch) -> dict:
        keys = items(row.column("keys"), np.uint64)[0]
        counts = items(row.column("counts"), np.int32)[0].astype(np.int64)
        sizes = np.array(row.column("sizes")[0].as_py(), np.int64)
        _, inverse = np.unique(keys, return_inverse=True)
        sets_with = answers_of(row, np.uint32)[inverse]
        owner = np.repeat(np.arange(len(counts)), counts)
        order = np.lexsort((keys, sets_with, owner))
        rank = np.arange(len(keys)) - np.repeat(np.cumsum(counts) - counts, counts)
        looked_at = counts - spare(least_overlap(sizes, percent)) + 1
        chosen = order[(rank < looked_at[owner]) & (sets_with[order] > 1)]
        some, first = np.unique(owner[chosen], return_index=True)
        at = pa.array(some, pa.int64())
        offsets = pa.array(np.append(first, len(chosen)).astype(np.int32))
        return {
            "doc_id": row.column("ids")[0].values.take(at),
            "print": row.column("prints")[0].values.take(at),
            "keys": pa.ListArray.from_arrays(offsets, pa.array(keys[chosen].view(np.int64))),
        }

    return work


def jaccard_components(docs: DataFrame, length: int, percent: int) -> DataFrame:
    """(doc_id, n_grams, component_id) of every row of ``docs`` (doc_id, text).

    Two documents are linked when their sets of different word n-grams have at least
    ``percent`` hundredths of their union in common. The component is named by the smallest
    doc_id that links lead to.

    Equal sets are one class. A set's prefix is its smallest hashes, as many that linked
    sets must share several of them; of those the commonest, by a count over all prefixes,
    are dropped, as many that linked sets still share one of the rest. Sets whose rest has
    nothing in common with others are out. The others meet in groups: a gram sends all sets
    that have it to the group of its smallest set. In a group the whole sets, in the
    order of their hashes, form a trie; each set walks it once, sharing the overlap of
    common beginnings, and leaves a branch when the grams that are left cannot make a link,
    or when all below is connected to it already. A group of over ``TASK_GRAMS`` is split:
    first its parts, each with the group's first set, then the sets that this left
    unconnected against every part.

    Grams are 64-bit hashes, sets are told apart by 128 bits. A null or empty text has no
    grams and is linked with nothing; a null doc_id has a component of its own, null. Texts
    of any length are whole sets; one of more grams than ``TASK_GRAMS`` is a part by itself.
    Rows that share an id are one document for the links. Other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    scratch = Scratch(spark)
    blocks = scratch.stored(_blocks(docs, length, percent), "prefixes")
    rows = blocks.select(F.explode(F.arrays_zip("ids", "sizes", "prints")).alias("r"))
    rows = stored(rows.select(
        F.col("r.ids").alias("doc_id"), F.col("r.sizes").alias("n_grams"),
        F.col("r.prints").alias("print"),
    ), "rows")
    classes = rows.where("print IS NOT NULL AND doc_id IS NOT NULL").groupBy("print").agg(
        F.min("doc_id").alias("doc_id"), F.max("n_grams").alias("n_grams")
    )
    total = blocks.agg(F.sum("total")).first()[0] or 0
    counted = exchange(blocks, ["keys"], _ask, _total, np.uint32, np.uint32, key_bits(total))
    found = map_blocks(counted, _rare_prefix(percent), _CANDIDATES)
    members = scratch.stored(_members(found, classes, scratch), "members")
    sets = scratch.stored(_sets(docs, members, length), "gram-sets")
    links = _links(members, sets, percent, scratch)
    roots = components(links, scratch)
    named = (
        classes.join(roots, classes["print"] == roots["node"], "left")
        .select("print", "doc_id", F.coalesce("root", "print").alias("root"))
    )
    named = scratch.stored(named, "classes")
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = stored(named.join(least, "root").select("print", "component_id"), "components")
    scratch.clear()
    return _by_id(rows.join(named, "print", "left"))


def _by_id(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id", "n_grams", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _members(found: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(pivot, print, doc_id, n_grams): the classes of each group, one row each."""
    firsts = scratch.stored(
        found.join(classes, ["print", "doc_id"]).dropDuplicates(["print"]), "candidates"
    )
    pairs = firsts.select("print", F.explode("keys").alias("key"))
    pivots = pairs.groupBy("key").agg(
        F.min("print").alias("pivot"), F.max("print").alias("last")
    ).where("pivot < last").select("key", "pivot")
    groups = splittable_join(pairs, pivots, ["key"]).select("pivot", "print").distinct()
    return groups.join(firsts.select("print", "doc_id", "n_grams"), "print")


def _sets(docs: DataFrame, members: DataFrame, length: int) -> DataFrame:
    """(print, size, grams) of the classes that are in some group, from their first text."""
    wanted = members.groupBy("print").agg(F.first("doc_id").alias("doc_id"))
    by_id = wanted.groupBy("doc_id").agg(F.collect_set("print").alias("prints"))
    rows = docs.hint("merge").join(by_id, "doc_id")

    def work(piece: pa.RecordBatch) -> dict:
        sets, prints = gram_sets(pc.fill_null(piece.column("text"), ""), length)
        asked = [set(p) for p in piece.column("prints").to_pylist()]
        own = [i for i, p in enumerate(prints) if p in asked[i]]
        return {
            "print": [prints[i] for i in own], "size": [len(sets[i]) for i in own],
            "grams": pa.array([sets[i].tobytes() for i in own], pa.binary()),
        }

    return map_slices(rows, ["doc_id", "text", "prints"], work, _SETS).dropDuplicates(["print"])


def _links(members: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(a, b): links that connect what is linked within each group."""
    sizes = members.groupBy("pivot").agg(F.sum("n_grams").alias("grams"))
    parts = scratch.stored(sizes.select(
        "pivot", F.ceil(F.col("grams") / F.lit(TASK_GRAMS)).cast("bigint").alias("parts")
    ), "groups")
    total = sizes.agg(F.sum("grams")).first()[0] or 0
    bundles = 1 + total // BUNDLE_GRAMS
    placed = members.join(parts, "pivot").withColumn(
        "part", F.pmod(F.xxhash64("print"), F.col("parts"))
    )
    # the group's first set goes into every part
    spread = placed.withColumn("part", F.explode(
        F.when(F.col("print") == F.col("pivot"), F.sequence(F.lit(0).cast("bigint"),
                                                            F.col("parts") - 1))
        .otherwise(F.array("part"))
    )).withColumn("asks", F.lit(True))
    inside = scratch.stored(
        _joined(spread.withColumn("other", F.lit(0).cast("bigint")), sets, bundles, percent),
        "links",
    )
    hot = placed.where("parts > 1")
    if hot.isEmpty():
        return inside
    return inside.unionByName(_across(hot, sets, inside, percent, scratch))


def _across(
    hot: DataFrame, sets: DataFrame, inside: DataFrame, percent: int, scratch: Scratch
) -> DataFrame:
    """Links of split groups between sets that their parts have left unconnected."""
    roots = components(inside, scratch)
    known = hot.join(roots, hot["print"] == roots["node"], "left").select(
        *hot.columns, F.coalesce("root", "print").alias("root")
    )
    firsts = known.where("print = pivot").select("pivot", F.col("root").alias("main"))
    known = scratch.stored(known.join(firsts, "pivot"), "hot-members")
    left = known.where("root <> main")
    others = scratch.stored(left.groupBy("pivot").agg(
        F.ceil(F.sum("n_grams") / F.lit(TASK_GRAMS)).cast("bigint").alias("others")
    ), "hot-groups")
    asking = left.join(others, "pivot").withColumn(
        "other", F.pmod(F.xxhash64("print", F.lit(1)), F.col("others"))
    ).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    asked = known.join(others, "pivot").withColumn("other", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.col("others") - 1)
    ))
    columns = ["pivot", "print", "root", "part", "other", "parts"]
    rows = asking.select(*columns, F.lit(True).alias("asks")).unionByName(
        asked.select(*columns, F.lit(False).alias("asks"))
    ).groupBy("pivot", "print", "root", "part", "other", "parts").agg(
        F.max("asks").alias("asks")
    )
    return _joined(rows, sets, 1 << 20, percent)


def _joined(rows: DataFrame, sets: DataFrame, bundles: int, percent: int) -> DataFrame:
    """Links within each (pivot, part, other), many small groups to a task."""
    root = F.col("root") if "root" in rows.columns else F.col("print")
    tasks = rows.select(
        F.pmod(F.xxhash64("pivot"), F.lit(bundles)).alias("bundle"), "part", "other",
        "pivot", "print", root.alias("root"), "asks",
    ).join(sets, "print")

    def run(table: pa.Table) -> pa.Table:
        prints = np.array(table.column("print").to_pylist(), object)
        pivots = np.array(table.column("pivot").to_pylist(), object)
        roots = np.array(table.column("root").to_pylist(), object)
        asks = table.column("asks").to_numpy()
        grams = [np.frombuffer(g.as_buffer(), np.uint64) for g in table.column("grams")]
        a, b = [], []
        order = np.argsort(pivots, kind="stable")
        cut = np.flatnonzero(np.append(True, pivots[order][1:] != pivots[order][:-1]))
        for group in np.split(order, cut[1:]):
            if len(group) > 1:
                for x, y in link_group(
                    [grams[i] for i in group], roots[group], asks[group], percent
                ):
                    a.append(prints[group[x]])
                    b.append(prints[group[y]])
        del grams
        give_back()
        return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string())})

    return tasks.groupBy("bundle", "part", "other").applyInArrow(run, _EDGES)


class Trie:
    """Sets of ascending numbers, in lexicographic order, with runs of one child joined.

    Node k holds the numbers ``tokens[at[k] : at[k] + size[k]]``, the last of which is at
    ``depth[k]`` of its sets low[k]..high[k]-1; ``ends[k]`` tells whether set low[k] ends
    there. Its children are ``first[k]`` .. ``first[k] + children[k] - 1``. A run has at
    most ``RUN`` numbers, so that a branch can be left in the middle of a long one.
    """

    RUN = 32

    def __init__(self, sets: list[np.ndarray]):
        n = len(sets)
        sizes = np.array([len(s) for s in sets])
        common = np.zeros(max(n - 1, 0), np.int64)
        for i in range(n - 1):
            m = min(sizes[i], sizes[i + 1])
            differ = sets[i][:m] != sets[i + 1][:m]
            common[i] = differ.argmax() if differ.any() else m
        offsets = np.cumsum(sizes) - sizes
        self.tokens = np.concatenate(sets)
        nodes: list[tuple[int, int, int, int, int]] = []  # low, high, start, stop, parent
        level = [(0, n, 0, -1)]
        while level:  # children of one node follow each other
            below = []
            for low, high, start, parent in level:
                end = sizes[low] if high - low == 1 else common[low : high - 1].min()
                stop = min(int(end), start + self.RUN)
                node = len(nodes)
                nodes.append((low, high, start, stop, parent))
                if stop < end:
                    below.append((low, high, stop, node))
                elif high - low > 1:
                    cut = low + 1 + np.flatnonzero(common[low : high - 1] == stop)
                    edges = [low, *cut.tolist(), high]
                    edges = edges[1:] if sizes[low] == stop else edges
                    below += [(p, q, stop, node) for p, q in zip(edges, edges[1:], strict=False)]
            level = below
        self.low, self.high, start, self.depth, parent = np.array(nodes).T
        self.at, self.size = offsets[self.low] + start, self.depth - start
        self.children = np.bincount(parent[1:], minlength=len(nodes))
        self.first = 1 + np.cumsum(self.children) - self.children
        self.ends = sizes[self.low] == self.depth
        self.last = self.tokens[np.maximum(offsets[self.low] + self.depth - 1, 0)]
        self.longest = np.array([sizes[p:q].max() for p, q in zip(self.low, self.high, strict=True)])


def link_group(
    grams: list[np.ndarray], roots: np.ndarray, asks: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Pairs (x, y) of linked sets that connect all that is linked, given that sets of one
    root are connected already. Only pairs with a set that ``asks`` are looked at.

    The grams of a set in order of their rarity in the group: linked sets share one of the
    first few. Sets without a shared one among these are out; the others fall apart into
    clusters, and large clusters into the sets of each such gram, so that a gram that all
    sets of a group have brings none of them together that have nothing else in common.
    """
    different, flat, number = np.unique(
        np.concatenate(grams), return_inverse=True, return_counts=True
    )
    sizes = np.array([len(g) for g in grams], np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(grams)), sizes)
    by_rarity = np.lexsort((flat, number[flat], owner))
    rank = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
    looked_at = by_rarity[rank < (sizes - least_overlap(sizes, percent) + 1)[owner]]
    # of two linked sets the smaller one has a shared gram among still fewer
    first = by_rarity[rank < (sizes - mutual_overlap(sizes, percent) + 1)[owner]]
    sharing = np.bincount(flat[looked_at], minlength=len(different)) > 1
    sharing &= np.bincount(flat[first], minlength=len(different)) > 0
    looked_at = looked_at[sharing[flat[looked_at]]]
    members, tokens = owner[looked_at], flat[looked_at]
    sets = [flat[e - n : e].astype(np.uint32) for e, n in zip(ends, sizes, strict=True)]
    linker = _Linker(sets, len(different), roots, asks, percent)
    for some in _clusters(members, tokens):
        cluster = np.unique(members[some])
        sets_with = np.unique(tokens[some], return_counts=True)[1].astype(float)
        if LOOSER * (sets_with**2).sum() < float(len(cluster)) ** 2:
            linker.link_by_token(members[some], tokens[some])
        else:
            linker.link(cluster)
    return linker.links


def _clusters(members: np.ndarray, tokens: np.ndarray) -> list[np.ndarray]:
    """Places of the (set, token) entries of each cluster that shared tokens connect."""
    if not len(members):
        return []
    _, token = np.unique(tokens, return_inverse=True)
    label = np.arange(int(members.max()) + 1)
    while True:  # the smallest label of a token's sets, and of a set's tokens, until all agree
        least = np.full(int(token.max()) + 1, len(label))
        np.minimum.at(least, token, label[members])
        new = label.copy()
        np.minimum.at(new, members, least[token])
        new = new[new]
        if (new == label).all():
            break
        label = new
    entry = label[members]
    order = np.argsort(entry, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(entry[order])) + 1)


class _Linker:
    """Links among sets of one group; knows which are connected."""

    def __init__(self, sets, n_tokens, roots, asks, percent):
        self.sets, self.asks, self.percent = sets, asks, percent
        self.inside = np.zeros(n_tokens, bool)
        _, self.part = np.unique(roots, return_inverse=True)
        self.of_part: dict[int, list[int]] = {}
        for x, p in enumerate(self.part.tolist()):
            self.of_part.setdefault(p, []).append(x)
        self.links: list[tuple[int, int]] = []

    def link_by_token(self, members: np.ndarray, tokens: np.ndarray) -> None:
        """The sets of each token, the most first, but for those that met already."""
        order = np.argsort(tokens, kind="stable")
        groups = np.split(members[order], np.flatnonzero(np.diff(tokens[order])) + 1)
        met: dict[int, set[int]] = {}
        for number, group in enumerate(sorted(groups, key=len, reverse=True)):
            here = group.tolist()
            common = set(met.get(here[0], ()))
            for x in here:
                common &= met.get(x, set())
                if not common:
                    break
            if not common:
                self.link(np.sort(group))
                for x in here:
                    met.setdefault(x, set()).add(number)

    def link(self, some: np.ndarray) -> None:
        """All pairs of some sets, one of which asks, that are not connected yet."""
        if (self.part[some] == self.part[some[0]]).all() or not self.asks[some].any():
            return
        order = np.array(
            sorted(some.tolist(), key=lambda i: self.sets[i].astype(">u4").tobytes())
        )
        sets = [self.sets[i] for i in order]
        trie, asking = Trie(sets), self.asks[order]
        all_ask = bool(asking.all())
        part = self.part[order]
        changes, visited = _changes(part), 0
        for x in np.flatnonzero(asking).tolist():
            if visited >= len(order):  # older counts only leave fewer branches
                part, visited = self.part[order], 0
                changes = _changes(part)
            if not changes[-1]:
                break
            # where all ask, a pair is looked at from the first of its sets
            after = x + 1 if all_ask else 0
            self.inside[sets[x]] = True
            found, nodes = _walk(trie, sets[x], part[x], part, changes, after, self.inside,
                                 self.percent)
            self.inside[sets[x]] = False
            visited += nodes
            for y in found.tolist():
                if self._connect(order[x], order[y]):
                    self.links.append((int(order[x]), int(order[y])))
                    visited = len(order)

    def _connect(self, x: int, y: int) -> bool:
        p, q = int(self.part[x]), int(self.part[y])
        if p == q:
            return False
        if len(self.of_part[p]) < len(self.of_part[q]):
            p, q = q, p
        moved = self.of_part.pop(q)
        self.part[moved] = p
        self.of_part[p] += moved
        return True


def _changes(part: np.ndarray) -> np.ndarray:
    """Running count of neighbours that differ; equal at both ends of a run of one part."""
    return np.concatenate([[0], np.cumsum(part[1:] != part[:-1])])


def _walk(trie, own, mine, part, changes, after, inside, percent) -> tuple[np.ndarray, int]:
    """Sets linked with ``own`` and not connected to it, all nodes of a level at a time, and
    the number of nodes."""
    found, visited = [], 0
    nodes, shared = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(nodes):
        visited += len(nodes)
        low, high = trie.low[nodes], trie.high[nodes]
        known = (part[low] == mine) & (changes[low] == changes[high - 1])
        keep = ~known & (high > after)
        nodes, shared = nodes[keep], shared[keep]
        if not len(nodes):
            break
        size = trie.size[nodes]
        hits = inside[trie.tokens[spans(trie.at[nodes], size)]]
        sums = np.concatenate([[0], np.cumsum(hits)])
        ends = np.cumsum(size)
        shared = shared + sums[ends] - sums[ends - size]
        depth = trie.depth[nodes]
        passed = np.where(depth > 0, np.searchsorted(own, trie.last[nodes], "right"), 0)
        # all that is left on both sides may still be shared
        possible = np.minimum(shared + len(own) - passed, shared + trie.longest[nodes] - depth)
        alive = 100 * possible >= percent * (len(own) + depth - shared)
        nodes, shared, depth = nodes[alive], shared[alive], depth[alive]
        linked = trie.ends[nodes] & (100 * shared >= percent * (len(own) + depth - shared))
        ending = trie.low[nodes[linked]]
        found.append(ending[(part[ending] != mine) & (ending >= after)])
        count = trie.children[nodes]
        nodes, shared = spans(trie.first[nodes], count), np.repeat(shared, count)
    return (np.concatenate(found) if found else np.zeros(0, np.int64)), visited
