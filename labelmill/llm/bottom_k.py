"""Near duplicates by bottom-k sketches: the k smallest hashes of each document's word shingles.

One hash function serves for all. Sketches meet in the inverted lists of the values they retain; the
sketch of two sets' union, read off both sketches, estimates their similarity; pairs that may reach
the threshold are decided on the full sets.

Of two linked sets' union, the k smallest values hold at least ``shared`` that both sets have, but for
a probability below ``MISS`` (Chernoff's bound, which holds for draws without replacement as
well); sets that fit into their sketches are compared as they are. So a set needs that many of
its values in common with others, and it is enough to look it up by its rarest ones, so many that two
linked sets surely share one. A value that a third of all documents hold is seldom among these.

1. Equal sets become one.
2. All sets that a list holds go to the group of the list's first set, its hub. A group is cut into
   parts of bounded size, each with the hub, and each part is solved in one task.
3. Where a group had several parts, and a list still spans several components, its sets are open. They
   are known by all their shingles now, so the bound is exact: only sets that lie nearly whole in what
   others have meet again, in blocks of a group, two blocks in a task; blocks that lie in one
   component together do not meet. No pairs are listed but links that join two components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.llm.batches import flat, shingle_sets, slices
from labelmill.llm.components import components
from labelmill.llm.lookup import only
from labelmill.operators.skew import salted_join
from labelmill.sources.staging import Staging

# Values that a sketch retains.
K = 128
# Probability that a linked pair's sketches look unlinked.
MISS = 1e-9
# Sets, and shingles of all its sets together, that one part of a group holds on average.
PART_SETS = 256
PART_SHINGLES = 1 << 19


def shared_values(k: int, num: int, den: int) -> int:
    """The most of k values drawn from a union that are surely common to both of two linked sets."""

    def doubt(found: int) -> float:
        """Logarithm of a bound on the probability of ``found`` or fewer."""
        a, t = found / k, num / den
        return -k * ((a * log(a / t) if a else 0.0) + (1 - a) * log((1 - a) / (1 - t)))

    if num == den:
        return k
    least = 0
    while least / k < num / den and doubt(least) <= log(MISS):
        least += 1
    return least


class Sketching:
    """Similarity ``num / den`` in integers, and what it asks of sketches of k values."""

    def __init__(self, num: int, den: int, k: int) -> None:
        if not 0 < num <= den:
            raise ValueError(f"the threshold must be in (0, 1], got {num}/{den}")
        self.num, self.den, self.k = num, den, k
        self.shared = shared_values(k, num, den)
        if not self.shared:
            raise ValueError(f"{k} values do not tell whether sets reach {num}/{den}")

    def whole(self, n: Column) -> Column:
        """Values that a set of n has in common with any set it links to."""
        return F.floor((n * self.num + (self.den - 1)) / F.lit(self.den)).cast("int")

    def sketched(self, n: Column) -> Column:
        """Values that a set of n retains in common with any set it links to."""
        fits = n * self.den <= self.num * self.k
        return F.when(fits, self.whole(n)).otherwise(self.shared)

    def links(self, n: np.ndarray, m: np.ndarray, both: np.ndarray) -> np.ndarray:
        return self.den * both >= self.num * (n + m - both)


class Sets:
    """The sets of one task, their sketches' inverted lists, and which are known to be linked."""

    def __init__(self, sets: list[np.ndarray], known: np.ndarray, rule: Sketching) -> None:
        self.sets, self.rule, self.joined = sets, rule, known
        self.sizes = np.array([len(s) for s in sets])
        sketches = [s[: rule.k] for s in sets]
        lengths = [len(s) for s in sketches]
        values = np.concatenate([np.zeros(0, np.uint64), *sketches])
        order = np.argsort(values, kind="stable")
        self._owner = np.repeat(np.arange(len(sets)), lengths)[order]
        self._rank = np.concatenate([np.zeros(0, int), *map(np.arange, lengths)]).astype(int)[order]
        self._values, starts = np.unique(values[order], return_index=True)
        self._starts = np.append(starts, len(order))

    def estimated(self, i: int) -> np.ndarray:
        """Sets of other components whose similarity to set i may reach the threshold, best first."""
        k, n = self.rule.k, self.sizes[i]
        sketch = self.sets[i][:k]
        lists = np.searchsorted(self._values, sketch)
        begin = self._starts[lists]
        length = self._starts[lists + 1] - begin
        at = np.arange(length.sum()) + np.repeat(begin - np.cumsum(length) + length, length)
        own_rank = np.repeat(np.arange(len(sketch)), length)
        owner = self._owner[at]
        other = (self.joined[owner] != self.joined[i]) & (
            self.rule.den * np.minimum(self.sizes[owner], n)
            >= self.rule.num * np.maximum(self.sizes[owner], n)
        )
        at, owner, own_rank = at[other], owner[other], own_rank[other]
        order = np.argsort(owner, kind="stable")
        owner, ranks = owner[order], (own_rank + self._rank[at])[order]
        sets, first, overlap = np.unique(owner, return_index=True, return_counts=True)
        # A common value's place in the union: those of both sides less the common ones before it.
        place = ranks - (np.arange(len(owner)) - np.repeat(first, overlap))
        in_union = np.bincount(owner, place < k, minlength=len(self.sets))[sets]
        m = self.sizes[sets]
        # Where both sets are whole in their sketches and so is their union, this is exact.
        exact = (n <= k) & (m <= k) & (n + m - overlap <= k)
        likely = np.where(exact, self.rule.links(n, m, overlap), in_union >= self.rule.shared)
        sets, in_union = sets[likely], in_union[likely]
        return sets[np.argsort(-in_union, kind="stable")]

    def links(self) -> Iterator[tuple[int, int]]:
        """Links that join components, until no two linked sets are in different ones."""
        for i in range(len(self.sets)):
            if (self.joined == self.joined[i]).all():
                return
            for j in self.estimated(i).tolist():
                if self.joined[i] == self.joined[j]:
                    continue
                both = len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True))
                if self.rule.links(self.sizes[i], self.sizes[j], both):
                    self.joined[self.joined == self.joined[j]] = self.joined[i]
                    yield i, j


def _key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    values = np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def sketches(
    docs: DataFrame, *, words: int = 5, k: int = K, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n, key, sketch``: size and digest of each row's set, and its k smallest hashes.

    The key is null for a text without words. Hashes ascend as unsigned numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(*flat(part.column("text")), words)
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "n": pa.array([len(s) for s in sets], pa.int64()),
                        "key": pa.array([_key(s) if len(s) else None for s in sets], pa.binary()),
                        "sketch": _lists([s[:k] for s in sets]),
                    }
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, key binary, sketch array<long>")


def _looked_up(values: DataFrame, total: int, least: Column, staging: Staging, name: str, *extra: str):
    """``node, n, value, hub`` (and extra columns): the rarest values that each set is looked up by.

    ``values`` has node, n, value for each set and value; sets with fewer than ``least`` values that
    other sets have, too, are left out. Sets with ``least`` in common share one of the values kept.
    """
    span = [F.min("comp").alias("lo"), F.max("comp").alias("hi")] if "comp" in extra else []
    held = values.groupBy("value").agg(
        F.count("*").alias("n_sets"), F.min("node").alias("hub"), *span
    )
    # A value whose sets are joined already has nothing left to find.
    held = held.where("lo < hi" if span else "n_sets > 1").select("value", "n_sets", "hub")
    held = staging.table(held, f"{name}_values")
    counts = held.select("value", F.col("n_sets").alias("n"))
    return (
        salted_join(values, held, "value", "node", counts, total)
        .groupBy("node", "n", *extra)
        .agg(F.sort_array(F.collect_list(F.struct("n_sets", "value", "hub"))).alias("met"))
        .withColumn("least", least)
        .where("size(met) >= least")
        .select("node", "n", *extra, F.explode(F.expr("slice(met, 1, size(met) - least + 1)")).alias("m"))
        .select("node", "n", *extra, "m.value", "m.hub")
    )


def _solved(
    docs: DataFrame, members: DataFrame, rule: Sketching, words: int, id_col: str, text_col: str
) -> DataFrame:
    """Links ``a, b`` found within each ``grp`` of members (grp, node, comp, key, first_doc).

    They name the components of the sets where these are known, else the sets themselves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, {}

        def links() -> pa.RecordBatch:
            # A set stands for itself, or for the component that it is known to be in.
            names = np.array([node if comp is None else comp for node, (comp, _) in held.items()])
            solved = Sets([s for _, s in held.values()], names.copy(), rule)
            for _ in solved.links():
                pass
            # All that is joined now, linked with its smallest name.
            a, b = np.unique(np.stack([names, solved.joined]), axis=1)
            order = np.lexsort([a, b])
            a, b = a[order], b[order]
            first = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
            least = np.repeat(a[first], np.diff(np.append(first, len(a))))
            return pa.record_batch({"a": a[a != least], "b": least[a != least]})

        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(*flat(part.column("text")), words)
                columns = (part.column(c).to_pylist() for c in ("grp", "node", "comp", "key"))
                for grp, node, comp, key, s in zip(*columns, sets, strict=True):
                    if grp != at:
                        if len(held) > 1:
                            yield links()
                        at, held = grp, {}
                    # Another text under the same id has another key.
                    if len(s) and _key(s) == key:
                        held[node] = (comp, s)
        if len(held) > 1:
            yield links()

    texts = docs.select(F.col(id_col).cast("long").alias("first_doc"), F.col(text_col).alias("text"))
    return (
        only(texts, members, "first_doc")
        .join(members, "first_doc")
        .select("grp", "node", "comp", "key", "text")
        .repartition("grp")
        .sortWithinPartitions("grp")
        .mapInArrow(run, "a long, b long")
    )


def _parts(n_sets: Column, n_shingles: Column) -> Column:
    return F.ceil(
        F.greatest(n_sets / F.lit(PART_SETS), n_shingles / F.lit(PART_SHINGLES))
    ).cast("int")


def near_duplicates(
    docs: DataFrame,
    *,
    words: int = 5,
    num: int = 80,
    den: int = 100,
    k: int = K,
    id_col: str = "doc_id",
    text_col: str = "text",
    staging: Staging | None = None,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Two documents link when the Jaccard similarity of their sets of ``words`` successive words
    (A-Z in lower case, split at ASCII white space) is ``num / den`` or more; ``component_id`` is
    the smallest id that links lead to, and the document of that id is the one kept. A document of
    fewer words has its whole sequence as its one shingle.

    * A null text, or one without words, has no shingles and links with nothing.
    * A row with a null id links with nothing, has no component and is kept.
    * Rows may share an id; each goes by its own text. An empty table gives no rows.
    * Shingles are compared by 64-bit hashes. A link is missed with a probability below ``MISS``,
      which depends on the texts alone, not on the table's size or order.

    Staged tables lie in ``staging``: clear it when nothing reads the result any more.
    """
    rule = Sketching(num, den, k)
    staging = staging or Staging(docs.sparkSession)
    sets = staging.table(
        sketches(docs, words=words, k=k, id_col=id_col, text_col=text_col), "sketches"
    )
    nodes = staging.table(
        sets.where("n > 0 and doc_id is not null")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("first_doc"),
            F.first("n").alias("n"),
            F.first("sketch").alias("sketch"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    own = staging.table(sets.select("doc_id", "n", "key"), "own")
    staging.drop("sketches")
    names = nodes.select("node", "n", "key", "first_doc")

    # Groups around hubs.
    retained = nodes.select("node", "n", F.explode("sketch").alias("value"))
    total = nodes.agg(F.coalesce(F.sum(F.size("sketch")), F.lit(0))).first()[0]
    looked_up = staging.table(
        _looked_up(retained, total, rule.sketched(F.col("n")), staging, "retained"), "looked_up"
    )
    met = staging.table(looked_up.select("hub", "node", "n").distinct(), "met")
    groups = staging.table(
        met.groupBy("hub").agg(
            F.count("*").alias("n_sets"),
            F.sum("n").alias("n_shingles"),
            F.count_if(F.col("node") != F.col("hub")).alias("others"),
        )
        .where("others > 0")
        .select("hub", "n_sets", _parts(F.col("n_sets"), F.col("n_shingles")).alias("parts")),
        "groups",
    )
    n_met = groups.agg(F.coalesce(F.sum("n_sets"), F.lit(0))).first()[0]
    sizes = groups.select("hub", F.col("n_sets").alias("n"))
    placed = salted_join(
        met.select("hub", "node").where("node <> hub"), groups.select("hub", "parts"), "hub", "node", sizes, n_met
    ).select("hub", "node", F.pmod(F.xxhash64("node"), "parts").alias("part"))
    hubs = groups.select(
        "hub", F.col("hub").alias("node"), F.explode(F.expr("sequence(0, parts - 1)")).alias("part")
    )
    members = staging.table(
        placed.select("hub", "node", F.col("part").cast("int").alias("part"))
        .unionByName(hubs)
        .join(names, "node")
        .select(
            F.concat_ws(":", "hub", "part").alias("grp"),
            "node",
            F.lit(None).cast("long").alias("comp"),
            "key",
            "first_doc",
        ),
        "members",
    )
    edges = staging.table(_solved(docs, members, rule, words, id_col, text_col), "links")
    roots = staging.table(components(edges, staging, "first"), "roots")

    # What is left between the parts of a group.
    split = groups.where("parts > 1").select("hub")
    of_parts = salted_join(looked_up, split, "hub", "node", sizes, n_met)
    of_parts = staging.table(
        of_parts.join(roots, "node", "left").select(
            "node", "value", F.coalesce("root", "node").alias("comp")
        ),
        "of_parts",
    )
    spanning = staging.table(
        of_parts.groupBy("value")
        .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n"))
        .where("lo < hi")
        .select("value", "n"),
        "spanning",
    )
    opened = salted_join(of_parts, spanning.select("value"), "value", "node", spanning, total)
    opened = opened.select("node", "comp").distinct()
    opened = staging.table(opened.join(names, "node"), "open")
    if not opened.isEmpty():
        more = _between_parts(docs, opened, rule, words, id_col, text_col, staging)
        more = components(staging.table(more, "more_links"), staging, "second")
        # Components that were joined, and sets that were alone until then.
        joined = more.select(F.col("node").alias("comp"), F.col("root").alias("last"))
        every = names.select("node").join(roots, "node", "left")
        roots = staging.table(
            every.withColumn("comp", F.coalesce("root", "node"))
            .join(joined, "comp", "left")
            .select("node", F.coalesce("last", "comp").alias("root")),
            "last_roots",
        )

    labels = names.join(roots, "node", "left").select(
        "key", "first_doc", F.coalesce("root", "node").alias("root")
    )
    smallest = labels.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    labels = labels.join(smallest, "root").select("key", "component_id")
    linked = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (
        own.join(labels, "key", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), linked.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _all_shingles(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(*flat(part.column("text")), words)
                keys = part.column("key").to_pylist()
                right = [i for i, s in enumerate(sets) if len(s) and _key(s) == keys[i]]
                kept = part.take(pa.array(right, pa.int64()))
                yield pa.record_batch(
                    {
                        "node": kept.column("node"),
                        "comp": kept.column("comp"),
                        "n": pa.array([len(sets[i]) for i in right], pa.int64()),
                        "whole": _lists([sets[i] for i in right]),
                    }
                )

    return run


def _between_parts(
    docs: DataFrame,
    opened: DataFrame,
    rule: Sketching,
    words: int,
    id_col: str,
    text_col: str,
    staging: Staging,
) -> DataFrame:
    """Links among open sets of different components, which are known by all their shingles."""
    texts = docs.select(F.col(id_col).cast("long").alias("first_doc"), F.col(text_col).alias("text"))
    whole = staging.table(
        only(texts, opened, "first_doc")
        .join(opened, "first_doc")
        .mapInArrow(_all_shingles(words), "node long, comp long, n long, whole array<long>")
        .dropDuplicates(["node"]),
        "whole",
    )
    values = whole.select("node", "n", "comp", F.explode("whole").alias("value"))
    total = whole.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    looked_up = _looked_up(values, total, rule.whole(F.col("n")), staging, "whole", "comp")
    met = staging.table(looked_up.select("hub", "node", "n", "comp").distinct(), "last_met")

    # A component with many sets in a group has blocks of its own, the sets of all others are mixed.
    of_comp = met.groupBy("hub", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    of_comp = of_comp.withColumn(
        "name", F.when(F.col("c") >= PART_SETS, F.col("comp")).otherwise(F.lit(-1))
    )
    names = staging.table(
        of_comp.groupBy("hub", "name").agg(_parts(F.sum("c"), F.sum("s")).alias("blocks")), "names"
    )
    named = staging.table(
        of_comp.select("hub", "comp", "name", "c").join(names, ["hub", "name"]), "named"
    )
    n_met = named.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    key = F.concat_ws(":", "hub", "comp").alias("slot")
    placed = salted_join(
        met.select(key, "hub", "comp", "node"),
        named.select(key, "name", "blocks"),
        "slot",
        "node",
        named.select(key, F.col("c").alias("n")),
        n_met,
    ).select(
        F.concat_ws(":", "hub", "name", F.pmod(F.xxhash64("node"), "blocks")).alias("block"),
        "hub",
        "node",
        "comp",
    )
    placed = staging.table(placed, "placed")
    blocks = staging.table(
        names.select("hub", "name", F.explode(F.expr("sequence(0, blocks - 1)")).alias("b")).select(
            "hub", "name", F.concat_ws(":", "hub", "name", "b").alias("block")
        ),
        "blocks",
    )
    left = blocks.select("hub", F.col("name").alias("l_name"), F.col("block").alias("l"))
    right = blocks.select("hub", F.col("name").alias("r_name"), F.col("block").alias("r"))
    meetings = left.join(right, "hub").where("l <= r and (l_name = -1 or l_name <> r_name)")
    grp = F.concat_ws("|", "l", "r").alias("grp")
    sides = meetings.select(grp, F.col("l").alias("block")).unionByName(
        meetings.where("l <> r").select(grp, F.col("r").alias("block"))
    )
    members = staging.table(
        sides.join(placed, "block")
        .join(opened.select("node", "key", "first_doc"), "node")
        .select("grp", "node", "comp", "key", "first_doc"),
        "block_members",
    )
    return _solved(docs, members, rule, words, id_col, text_col)
