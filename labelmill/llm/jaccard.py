"""Documents linked by the Jaccard similarity of their word shingles, as a T-occurrence search.

A document of n shingles shares at least ``T = ceil(threshold * n)`` of them with any document it
links to. Tasks answer that search with inverted lists and DivideSkip: short lists are merged, long
lists are only probed, by binary search, for what the short ones leave.

Documents meet in three steps; none of them lists the pairs of a group.

1. Equal sets become one. Each set is known by its first shingles in hash order, so many that
   linked sets share at least ``common(n)`` of them.
2. Sets that share shingles with a hub (the first set that has the shingle) are searched in groups of
   bounded size that also hold the hub. Links found there give a first state of the components.
3. A shingle is done if all its sets lie in one component, or have all been searched in one group.
   Sets that still have ``common`` other shingles are open. They are known by more shingles now, so
   that most turn out to have too few in common; the rest are searched against all such sets, which
   is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.llm.batches import flat, shingle_sets, slices
from labelmill.llm.components import components
from labelmill.llm.lookup import only, with_row, without
from labelmill.sources.staging import Staging

# Sets that one group, or one shard of lists, holds.
GROUP_SETS = 256
# Sets that are searched in a shard by one task.
SEARCH_SETS = 2048
# Of n shingles, one in so many more is sent, so that a passage in common does not count.
EXTRA = 20
# The same for sets that are still open after the groups: half of their shingles must be common.
LAST_EXTRA = 2
# DivideSkip's weight of a probe against a merge step.
MU = 0.0085

RESULT = "doc_id long, n_shingles long, component_id long"


class Threshold:
    """Similarity ``num / den`` in integers."""

    def __init__(self, num: int, den: int, extra: int = EXTRA) -> None:
        if not 0 < num <= den:
            raise ValueError(f"the threshold must be in (0, 1], got {num}/{den}")
        self.num, self.den, self.extra = num, den, extra

    def least(self, n: int) -> int:
        """Shingles that a set of n shares with any set it links to, and the smallest such set."""
        return -(-self.num * n // self.den)

    def common(self, n: int) -> int:
        """Shingles that two linked sets of n or more share among those sent."""
        return min(1 + n // self.extra, self.least(n))

    def sent(self, n: int) -> int:
        return n - self.least(n) + self.common(n)

    def links(self, n: int, m: int, both: int) -> bool:
        return self.den * both >= self.num * (n + m - both)

    def least_column(self, n: Column) -> Column:
        return F.floor((n * self.num + (self.den - 1)) / F.lit(self.den)).cast("long")

    def common_column(self, n: Column) -> Column:
        return F.least(1 + F.floor(n / self.extra), self.least_column(n))


class InvertedLists:
    """Lists of the sets that have a shingle, each in ascending order."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = [len(s) for s in sets]
        rows = np.repeat(np.arange(len(sets)), self.sizes)
        shingles = np.concatenate([np.zeros(0, np.uint64), *sets])
        order = np.argsort(shingles, kind="stable")
        self._rows = rows[order]
        self._shingles, self._starts = np.unique(shingles[order], return_index=True)
        self._starts = np.append(self._starts, len(order))
        # List and set as one number, ascending: a binary search probes any list for any set.
        lists = np.repeat(np.arange(len(self._shingles)), np.diff(self._starts))
        self._keys = lists * (len(sets) + 1) + self._rows

    def candidates(self, query: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sets that may have ``need`` of the query's shingles.

        Returns the sets in order of the shingles found so far, descending, that number, and the
        long lists that have yet to be probed.
        """
        at = np.searchsorted(self._shingles, query)
        query, at = query[at < len(self._shingles)], at[at < len(self._shingles)]
        at = at[self._shingles[at] == query]
        if len(at) < need:
            return np.zeros(0, int), np.zeros(0, int), at
        sizes = self._starts[at + 1] - self._starts[at]
        order = np.argsort(sizes, kind="stable")
        at, sizes = at[order], sizes[order]
        longest = int(sizes[-1])
        n_long = min(need - 1, int(need / (MU * np.log2(longest + 1) + 1)))
        n_short = len(at) - n_long
        starts, sizes = self._starts[at[:n_short]], sizes[:n_short]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
        counts = np.bincount(self._rows[places], minlength=len(self.sizes))
        found = np.flatnonzero(counts >= need - n_long)
        found = found[np.argsort(-counts[found], kind="stable")]
        return found, counts[found], at[n_short:]

    def probe(self, lists: np.ndarray, row: int) -> int:
        """How many of the lists have the set."""
        if len(lists) == 0:
            return 0
        wanted = lists * (len(self.sizes) + 1) + row
        at = np.searchsorted(self._keys, wanted)
        at[at == len(self._keys)] = 0
        return int((self._keys[at] == wanted).sum())


class Forest:
    """Which of a task's sets are known to be linked."""

    def __init__(self, size: int) -> None:
        self._up = list(range(size))

    def root(self, i: int) -> int:
        while self._up[i] != i:
            self._up[i] = self._up[self._up[i]]
            i = self._up[i]
        return i

    def join(self, i: int, j: int) -> None:
        self._up[self.root(i)] = self.root(j)


def links_within(sets: list[np.ndarray], threshold: Threshold) -> list[tuple[int, int]]:
    """Links that join all that is linked among the sets, without those that join nothing new."""
    lists, forest, found = InvertedLists(sets), Forest(len(sets)), []
    for i, query in enumerate(sets):
        for j in search(lists, query, threshold, lambda j, i=i: forest.root(i) == forest.root(j)):
            forest.join(i, j)
            found.append((i, j))
    return found


def search(lists: InvertedLists, query: np.ndarray, threshold: Threshold, known) -> Iterator[int]:
    """The sets that link with the query, but for those that are known by the time of the probe."""
    n = len(query)
    rows, counts, long_lists = lists.candidates(query, threshold.least(n))
    for j, count in zip(rows.tolist(), counts.tolist(), strict=True):
        m = lists.sizes[j]
        if known(j) or not threshold.links(n, m, count + len(long_lists)):
            continue
        if threshold.links(n, m, count + lists.probe(long_lists, j)):
            yield j


def _key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def shingled(docs: DataFrame, words: int, threshold: Threshold, id_col: str, text_col: str):
    """``doc_id, n, key, sent``: size and digest of each document's set, and its first shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(*flat(part.column("text")), words)
                sent = [s[: threshold.sent(len(s))].view(np.int64) for s in sets]
                ends = np.cumsum([0, *map(len, sent)])
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "n": pa.array([len(s) for s in sets], pa.int64()),
                        "key": pa.array([_key(s) if len(s) else None for s in sets], pa.binary()),
                        "sent": pa.ListArray.from_arrays(
                            pa.array(ends, pa.int32()),
                            pa.array(np.concatenate([np.zeros(0, np.int64), *sent])),
                        ),
                    }
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, key binary, sent array<long>")


def _with_texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``wanted`` (with first_doc, grp, part, role, node, key, comp), dealt by group with texts."""
    texts = docs.select(F.col(id_col).cast("long").alias("first_doc"), F.col(text_col).alias("text"))
    return (
        only(texts, wanted, "first_doc")
        .join(wanted, "first_doc")
        .select("grp", "part", "role", "node", "key", "comp", "text")
        .repartition("grp", "part")
        .sortWithinPartitions("grp", "part", "role", "node")
    )


def _groups(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple]:
    """``(group, role, nodes, comps, sets)`` of successive rows of a group and role.

    A row whose text has another set than its key says (another text under the same id) is left
    out, and so is a node's repetition.
    """
    for batch in batches:
        for piece in slices(batch, "text"):
            sets = shingle_sets(*flat(piece.column("text")), words)
            held, at = [], None
            columns = (piece.column(c).to_pylist() for c in ("grp", "part", "role", "node", "comp"))
            for g, p, role, node, comp, key, s in zip(
                *columns, piece.column("key").to_pylist(), sets, strict=True
            ):
                if (g, p, role) != at:
                    if held:
                        yield *at, held
                    held, at = [], (g, p, role)
                if len(s) and _key(s) == key:
                    held.append((node, comp, s))
            if held:
                yield *at, held


def _distinct(rows: list[tuple]) -> list[tuple]:
    return list({node: (node, comp, s) for node, comp, s in rows}.values())


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def similar_components(
    docs: DataFrame,
    *,
    words: int = 5,
    num: int = 80,
    den: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row.

    Two documents link when the Jaccard similarity of their sets of ``words`` successive words
    (A-Z in lower case, split at ASCII white space) is ``num / den`` or more; ``component_id`` is
    the smallest id that links lead to. A document of fewer words has its whole sequence as its one
    shingle. A null text, or one without words, has no shingles and links with nothing, as does a
    row with a null id. Rows may share an id; each goes by its own text. An empty table gives no
    rows. Shingles are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    threshold = Threshold(num, den)
    staging = Staging(spark)
    sets = staging.table(shingled(docs, words, threshold, id_col, text_col), "sets")
    reps = staging.table(
        sets.where("n > 0 and doc_id is not null")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("first_doc"),
            F.first("n").alias("n"),
            F.first("sent").alias("sent"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "reps",
    )
    own = staging.table(sets.select("doc_id", "n", "key"), "own")
    staging.drop("sets")
    names = reps.select("node", "n", "key", "first_doc")
    least = threshold.common_column(threshold.least_column(F.col("n")))

    # Shingles that several sets have been sent by, kept in a row per set.
    sent = reps.select("node", F.explode("sent").alias("token"))
    hubs = (
        sent.groupBy("token")
        .agg(F.count("*").alias("c"), F.min("node").alias("hub"))
        .where("c > 1")
        .select("token", "hub")
    )
    shared = staging.table(
        sent.join(hubs, "token")
        .groupBy("node")
        .agg(F.collect_list(F.struct("token", "hub")).alias("met"))
        .join(names.select("node", "n"), "node")
        .where(F.size("met") >= least),
        "shared",
    )

    # Step 2: groups around hubs.
    n, hub_n = F.col("n"), F.col("hub_n")
    pairs = staging.table(
        shared.select("node", "n", F.explode("met.hub").alias("hub"))
        .where("node <> hub")
        .groupBy("node", "n", "hub")
        .agg(F.count("*").alias("c"))
        .where(F.col("c") >= least)
        .join(names.select(F.col("node").alias("hub"), F.col("n").alias("hub_n")), "hub")
        .where(
            (den * F.least(n, hub_n) >= num * F.greatest(n, hub_n))
            & (
                F.col("c")
                >= F.least(threshold.common_column(n), threshold.common_column(hub_n))
            )
        )
        .select("node", "hub"),
        "pairs",
    )
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count("*") / GROUP_SETS).cast("int").alias("parts"))
    placed = staging.table(
        pairs.join(sizes, "hub").select(
            F.col("hub").alias("grp"),
            F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"),
            "node",
        ),
        "placed",
    )
    members = placed.unionByName(
        sizes.select(
            F.col("hub").alias("grp"),
            F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
            F.col("hub").alias("node"),
        )
    )
    grouped = staging.table(
        members.join(names.select("node", "key", "first_doc"), "node").withColumns(
            {"role": F.lit(0), "comp": F.lit(None).cast("long")}
        ),
        "grouped",
    )

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(rows: list[tuple]) -> pa.RecordBatch:
            rows = _distinct(rows)
            links = links_within([r[2] for r in rows], threshold)
            return _edges([(rows[i][0], rows[j][0]) for i, j in links])

        at, held = None, []
        for g, p, _, rows in _groups(batches, words):
            if (g, p) != at:
                yield solved(held)
                at, held = (g, p), []
            held += rows
        yield solved(held)

    edges = staging.table(
        _with_texts(docs, grouped, id_col, text_col).mapInArrow(within, "a long, b long"), "edges"
    )
    roots = staging.table(components(edges, staging, "first"), "roots")

    # Step 3: what may still link over components.
    searched = placed.groupBy("node").agg(
        F.map_from_entries(F.collect_list(F.struct("grp", "part"))).alias("searched")
    )
    left = (
        shared.join(roots, "node", "left")
        .join(searched, "node", "left")
        .select(
            "node",
            "n",
            F.coalesce("root", "node").alias("comp"),
            "searched",
            F.explode("met").alias("m"),
        )
        .select("node", "n", "comp", "m.token", F.expr("searched[m.hub]").alias("part"), "m.hub")
    )
    open_tokens = (
        left.groupBy("token")
        .agg(
            F.count("*").alias("df"),
            F.min("comp").alias("lo"),
            F.max("comp").alias("hi"),
            F.count_if(F.col("part").isNull() & (F.col("node") != F.col("hub"))).alias("absent"),
            F.min("part").alias("part_lo"),
            F.max("part").alias("part_hi"),
        )
        .where("lo < hi and (absent > 0 or part_lo < part_hi)")
        .select("token", "df")
    )
    open_sets = _still_open(left, open_tokens, least).select("node", "comp")
    open_sets = staging.table(open_sets.join(names, "node"), "open")
    if not open_sets.isEmpty():
        last = Threshold(num, den, LAST_EXTRA)
        texts = docs.select(
            F.col(id_col).cast("long").alias("first_doc"), F.col(text_col).alias("text")
        )
        more = staging.table(
            only(texts, open_sets, "first_doc")
            .join(open_sets, "first_doc")
            .mapInArrow(_sent_by_node(words, last), "node long, comp long, n long, sent array<long>"),
            "more",
        )
        left = more.select("node", "comp", "n", F.explode("sent").alias("token"))
        open_tokens = (
            left.groupBy("token")
            .agg(F.count("*").alias("df"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            .where("lo < hi")
            .select("token", "df")
        )
        least = last.common_column(last.least_column(F.col("n")))
        open_sets = staging.table(_still_open(left, open_tokens, least), "last_open")
        n_open = open_sets.count()
        if n_open:
            roots = _cross_links(
                docs, open_sets, n_open, names, edges, staging, words, threshold, id_col, text_col
            )

    labels = names.join(roots, "node", "left").select(
        "key", "first_doc", F.coalesce("root", "node").alias("root")
    )
    smallest = labels.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    labels = labels.join(smallest, "root").select("key", "component_id")
    linked = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return own.join(labels, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), linked.alias("component_id")
    )


def _still_open(left: DataFrame, open_tokens: DataFrame, least: Column) -> DataFrame:
    """Sets with ``least`` open shingles, and the rarest of these, so many that linked sets still
    share one of them."""
    return (
        left.join(open_tokens, "token")
        .groupBy("node", "n", "comp")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("met"))
        .where(F.size("met") >= least)
        .select(
            "node",
            "comp",
            F.array_min(F.expr("transform(met, m -> struct(m.token, m.df))")).alias("first"),
            F.slice("met", 1, (F.size("met") - least + 1).cast("int")).alias("met"),
        )
    )


def _sent_by_node(words: int, threshold: Threshold):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                sets = shingle_sets(*flat(part.column("text")), words)
                columns = (part.column(c).to_pylist() for c in ("node", "comp", "key"))
                for s, node, comp, key in zip(sets, *columns, strict=True):
                    if len(s) and _key(s) == key:
                        out.append((node, comp, len(s), s[: threshold.sent(len(s))].view(np.int64)))
                node, comp, n, sent = zip(*out, strict=True) if out else ((), (), (), ())
                yield pa.record_batch(
                    {
                        "node": pa.array(node, pa.int64()),
                        "comp": pa.array(comp, pa.int64()),
                        "n": pa.array(n, pa.int64()),
                        "sent": pa.array(list(sent), pa.list_(pa.int64())),
                    }
                )

    return run


def _cross_links(
    docs, open_sets, n_open, names, edges, staging, words, threshold, id_col, text_col
) -> DataFrame:
    """Roots after an exact search of every open set among all open sets of other components."""
    shards = -(-n_open // GROUP_SETS)
    parts = -(-n_open // SEARCH_SETS)
    placed = open_sets.select(
        "node",
        "comp",
        # Sets with the same first shingle lie together, in several shards if there are many: those
        # that have much in common mostly share it, so a search goes to few shards.
        F.pmod(
            F.xxhash64(
                "first.token",
                F.pmod(F.xxhash64("node"), F.ceil(F.col("first.df") / GROUP_SETS)),
            ),
            F.lit(shards),
        )
        .cast("long")
        .alias("grp"),
        F.pmod(F.xxhash64("node"), F.lit(parts)).cast("int").alias("part"),
        F.col("met.token").alias("tokens"),
    )
    asked = placed.select("node", "comp", "part", F.explode("tokens").alias("token"))
    held = placed.select("grp", F.explode("tokens").alias("token")).distinct()
    searches = asked.join(held, "token").select("grp", "part", "node", "comp").distinct()
    index = placed.select(
        "grp", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "node", "comp"
    )
    wanted = staging.table(
        index.withColumn("role", F.lit(0))
        .unionByName(searches.withColumn("role", F.lit(1)))
        .join(names.select("node", "key", "first_doc"), "node"),
        "asked",
    )

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, members, lists = None, [], None
        for g, p, role, rows in _groups(batches, words):
            if (g, p) != at:
                at, members, lists = (g, p), [], None
            if role == 0:
                members += rows
                continue
            if lists is None:
                members = _distinct(members)
                lists = InvertedLists([m[2] for m in members])
            found = []
            for node, comp, query in rows:
                seen = {comp}
                for j in search(lists, query, threshold, lambda j: members[j][1] in seen):  # noqa: B023
                    seen.add(members[j][1])
                    found.append((node, members[j][0]))
            yield _edges(found)

    more = _with_texts(docs, wanted, id_col, text_col).mapInArrow(across, "a long, b long")
    every = staging.table(edges.unionByName(more), "all_edges")
    return components(every, staging, "second")


def one_of_each(
    docs: DataFrame,
    *,
    words: int = 5,
    num: int = 80,
    den: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows, all columns, with one row left of each component: that of the smallest id.

    Rows without words link with nothing, so they stay. Where ids repeat or are null, the first row
    in order of reading stays.
    """
    staging = Staging(docs.sparkSession)
    rows, row = with_row(docs, id_col, staging)
    linked = similar_components(
        rows.select(row, text_col), words=words, num=num, den=den, id_col=row, text_col=text_col
    )
    gone = linked.where("component_id <> doc_id").select(F.col("doc_id").alias(row))
    return without(rows, staging.table(gone, "gone"), row).select(*docs.columns)
