"""What each filter of a cleaning step removes, alone and in every order of the filters.

Every document becomes a mask of the filters it fails; masks are counted for each part. The counts of
a part make up a decision diagram: one level for each filter, pass and fail as the two ways down,
counts at the bottom, equal subgraphs shared. Two adjacent levels can be swapped without touching
the others, and a series of such swaps visits all orders of the filters. In each order the path
of passes from the top gives the steps: what goes at a step is the weight of the fail branch.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelmill.sources.staging import Staging

# More filters would make more orders than anyone reads: 7 already make 5,040.
MOST_FILTERS = 7
COUNTS = ("docs", "good", "toxic")
RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long,"
    " unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions on a text that is not null: short, repetitive, loud, with symbols."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * capitals > 5 * F.length(text),
        "D": F.rlike(text, F.lit("[#$%&*|]")),
    }


def plain_changes(n: int) -> Iterator[int]:
    """Places to swap with the next one, so that all orders of n things come up once."""
    if n < 2:
        return
    inner = plain_changes(n - 1)
    while True:
        yield from range(n - 2, -1, -1)
        place = next(inner, None)
        if place is None:
            return
        yield place + 1
        yield from range(n - 1)
        place = next(inner, None)
        if place is None:
            return
        yield place


class Diagram:
    """A decision diagram over ``order``, whose bottom holds counts by mask (bit i: order[i] fails).

    Nodes are numbers. A level maps its nodes to their (pass, fail) children, so that equal children
    make equal nodes; ``weight`` holds each node's counts, the sums of its children's.
    """

    def __init__(self, order: str, counts: Mapping[int, tuple[int, ...]], width: int) -> None:
        self.order = list(order)
        self.weight: list[np.ndarray] = []
        bottom: dict[tuple, int] = {}
        nothing = (0,) * width
        nodes = []
        for mask in range(1 << len(order)):
            # The first filter decides at the top, so it is the highest bit down here.
            bits = sum((mask >> (len(order) - 1 - i) & 1) << i for i in range(len(order)))
            leaf = tuple(counts.get(bits, nothing))
            if leaf not in bottom:
                bottom[leaf] = self._new(np.array(leaf, np.int64))
            nodes.append(bottom[leaf])
        self.levels: list[dict[int, tuple[int, int]]] = []
        while len(nodes) > 1:
            made: dict[tuple[int, int], int] = {}
            nodes = [self._node(made, *nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
            self.levels.insert(0, {node: children for children, node in made.items()})
        self.root = nodes[0]

    def _new(self, weight: np.ndarray) -> int:
        self.weight.append(weight)
        return len(self.weight) - 1

    def _node(self, made: dict[tuple[int, int], int], passed: int, failed: int) -> int:
        if (passed, failed) not in made:
            made[passed, failed] = self._new(self.weight[passed] + self.weight[failed])
        return made[passed, failed]

    def swap(self, i: int) -> None:
        """Exchange levels i and i + 1. Nodes of level i stay, so nothing above changes."""
        below, made = self.levels[i + 1], {}
        for node, (passed, failed) in self.levels[i].items():
            (pp, pf), (fp, ff) = below[passed], below[failed]
            self.levels[i][node] = (self._node(made, pp, fp), self._node(made, pf, ff))
        self.levels[i + 1] = {node: children for children, node in made.items()}
        self.order[i], self.order[i + 1] = self.order[i + 1], self.order[i]

    def steps(self) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """Filter, counts kept and counts removed, down the path of passes."""
        node = self.root
        for name, level in zip(self.order, self.levels, strict=True):
            node, failed = level[node]
            yield name, self.weight[node], self.weight[failed]


def steps_of_all_orders(names: str, counts: Mapping[int, tuple[int, int, int]]) -> list[tuple]:
    """Rows of RESULT without the part."""
    diagram = Diagram(names, counts, len(COUNTS))
    paths = {"".join(diagram.order): list(diagram.steps())}
    for place in plain_changes(len(names)):
        diagram.swap(place)
        paths["".join(diagram.order)] = list(diagram.steps())
        # Nodes that swaps have left behind would pile up.
        if len(diagram.weight) > 1 << 14:
            diagram = Diagram("".join(diagram.order), _renamed(names, diagram.order, counts), 3)
    failing, alone, shapley = {}, {}, dict.fromkeys(names, 0)
    for path in paths.values():
        failing[path[0][0]] = int(path[0][2][0])
        alone[path[-1][0]] = int(path[-1][2][0])
        for name, _, gone in path:
            shapley[name] += int(gone[0])
    return [
        (
            order,
            step,
            int(kept[0]),
            int(gone[0]),
            failing[name] - int(gone[0]),
            alone[name],
            int(gone[1]),
            int(gone[2]),
            shapley[name],
        )
        for order, path in paths.items()
        for step, (name, kept, gone) in enumerate(path, 1)
    ]


def _renamed(names: str, order: list[str], counts: Mapping[int, tuple]) -> dict[int, tuple]:
    bits = [names.index(name) for name in order]
    return {sum((mask >> b & 1) << i for i, b in enumerate(bits)): c for mask, c in counts.items()}


def masks(
    docs: DataFrame,
    labels: DataFrame,
    failures: Mapping[str, Column],
    *,
    copies: str | None,
    id_col: str,
    text_col: str,
    part_col: str,
    staging: Staging,
) -> DataFrame:
    """``part, mask, good, toxic`` of every document: bit i is set if it fails the i-th filter."""
    names = [*failures, *([copies] if copies else [])]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failures.values())), F.lit(0))
    rows = docs.select(
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.col(id_col).cast("long").alias("id"),
        own.alias("mask"),
        F.unhex(F.md5(text)).alias("digest"),
    )
    if copies:
        rows = staging.table(rows, "masks")
        # The digest with the smallest id is the key, so one text's many copies do not meet.
        first = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("id"))
        rows = rows.join(first.withColumn("first", F.lit(True)), ["digest", "id"], "left")
        later = F.col("first").isNull() & F.col("id").isNotNull()
        bit = 1 << names.index(copies)
        rows = rows.withColumn("mask", F.col("mask") + F.when(later, bit).otherwise(0))
    seen = (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    )
    return rows.join(seen, "id", "left").select("part", "mask", "good", "toxic")


def audit(
    docs: DataFrame,
    labels: DataFrame,
    failures: Mapping[str, Column] | None = None,
    *,
    copies: str | None = "E",
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
    staging: Staging | None = None,
) -> DataFrame:
    """One row for each part, order of the filters and step: what is kept, removed and lost.

    ``failures`` names filters by one letter each and says when a row fails (a null is a pass);
    by default those of ``text_filters``. ``copies`` names one more filter that fails every row whose
    text also stands under a smaller id anywhere in the table, whatever the other filters do.
    ``labels`` has doc_id, quality and toxic.

    * A null text counts as empty, a null part as the empty string.
    * Rows with a null id have no label, are no copies and make none; rows that share an id and a
      text are no copies of one another.
    * An id with several labels is good if one says so, toxic likewise; a missing label is neither.
    * No documents: no rows. Parts without removals have rows of zeros.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    failures = text_filters(text) if failures is None else failures
    names = "".join(failures) + (copies or "")
    if not 0 < len(names) <= MOST_FILTERS or len(set(names)) < len(names):
        raise ValueError(f"one to {MOST_FILTERS} filters of one letter each, got {names!r}")
    found = masks(
        docs,
        labels,
        failures,
        copies=copies,
        id_col=id_col,
        text_col=text_col,
        part_col=part_col,
        staging=staging or Staging(docs.sparkSession),
    )
    # At most 2 ** MOST_FILTERS rows for each part are left after this sum.
    cells = found.groupBy("part", "mask").agg(
        F.count("*").alias("docs"),
        F.count_if("good").alias("good"),
        F.count_if("toxic").alias("toxic"),
    )
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("cells"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in RESULT.split(", ")]
        for batch in batches:
            for part, held in zip(batch["part"], batch["cells"], strict=True):
                counts = {c["mask"]: tuple(c[name] for name in COUNTS) for c in held}
                steps = [(part, *row) for row in steps_of_all_orders(names, counts)]
                yield pd.DataFrame(steps, columns=columns)

    return parts.mapInPandas(rows, RESULT)
