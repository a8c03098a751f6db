"""Hard negatives of anchors, mined exactly through a multiway hyperplane tree."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchweave.llm.block_topk import quantised
from matchweave.llm.integers import matrix, products, width_of
from matchweave.operators.scale import top_per_key, union_all
from matchweave.session import durable

#: Split points of a node; rows that a leaf holds at most.
WAYS, LEAF = 8, 64
#: Rows that the upper tree is fitted on, and those that a leaf of it takes at least.
SAMPLE, SAMPLE_LEAF = 4_096, 32
#: Rows of one piece of the table, which has a tree of its own, and searches that meet it at once.
PIECE, SEARCHES = 8_192, 4_096
#: Positives of an anchor and negatives of a positive; a negative's score lies between these hundredths of the positive's.
POSITIVES, NEGATIVES, SHARE = 5, 10, (30, 90)

_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max
#: Distances are floats: bounds give way by so much of their size.
_SLACK = 1e-6


@dataclass
class Node:
    """A split point per child, and the least and largest distance from each split point to the rows of each child."""

    points: np.ndarray
    children: list = field(default_factory=list)
    least: np.ndarray | None = None
    most: np.ndarray | None = None
    number: int = 0


def lengths(vectors: np.ndarray) -> np.ndarray:
    """Squared lengths as floats."""
    floats = vectors.astype(np.float64)
    return (floats * floats).sum(axis=1)


def distances(points: np.ndarray, vectors: np.ndarray, longest: float) -> np.ndarray:
    """Distances between rows after one more component has made them all as long as the longest.

    Among vectors of one length, the inner product falls as the distance grows.
    """
    floats = points.astype(np.float64) @ vectors.T.astype(np.float64)
    lift = np.sqrt(np.maximum(longest - lengths(points), 0))[:, None] * np.sqrt(np.maximum(longest - lengths(vectors), 0))[None, :]
    return np.sqrt(np.maximum(2 * (longest - floats - lift), 0))


def split_points(vectors: np.ndarray, longest: float, ways: int = WAYS) -> np.ndarray:
    """Up to ``ways`` rows far from each other: the first, then always the one furthest from those taken."""
    taken, nearest = [0], distances(vectors[:1], vectors, longest)[0]
    while len(taken) < ways and nearest.max() > 0:
        taken.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(vectors[taken[-1:]], vectors, longest)[0])
    return vectors[taken]


def build(vectors: np.ndarray, rows: np.ndarray, longest: float, leaf: int, ways: int = WAYS) -> Node | np.ndarray:
    """A tree over ``rows`` of ``vectors``; a leaf is the array of its rows. Equal rows may make a leaf larger than ``leaf``."""
    if len(rows) <= leaf:
        return rows
    node = Node(split_points(vectors[rows], longest, ways))
    if len(node.points) == 1:
        return rows
    far = distances(node.points, vectors[rows], longest)
    side = far.argmin(axis=0)
    node.least, node.most = ranges(far, side, len(node.points))
    node.children = [build(vectors, rows[side == j], longest, leaf, ways) for j in range(len(node.points))]
    return node


def ranges(far: np.ndarray, side: np.ndarray, ways: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest distance of split point ``i`` (first index) to the rows on side ``j`` (second)."""
    least, most = np.full((len(far), ways), np.inf), np.full((len(far), ways), -np.inf)
    for j in range(ways):
        if (side == j).any():
            least[:, j], most[:, j] = far[:, side == j].min(axis=1), far[:, side == j].max(axis=1)
    return least, most


@dataclass
class Searches:
    """Searches for the ``k`` rows with the highest scores between ``low`` and ``high``; ``found`` and ``ids`` are the best so far."""

    vectors: np.ndarray
    anchor: np.ndarray
    label: np.ndarray
    same: np.ndarray
    low: np.ndarray
    high: np.ndarray
    k: np.ndarray
    ids: np.ndarray = field(init=False)
    found: np.ndarray = field(init=False)

    def __post_init__(self):
        width = int(self.k.max(initial=1))
        self.ids = np.full((len(self.k), width), _HIGH)
        self.found = np.full((len(self.k), width), _LOW)
        self.low = self.low.copy()

    def open_children(self, node: Node, chosen: np.ndarray, longest: float) -> tuple[np.ndarray, np.ndarray]:
        """Which children may hold a row for which of the ``chosen`` searches, and the distances to the split points.

        A search's rows lie in a ring around it. A child is left out if, seen from any split point, its
        range of distances does not meet the ring's.
        """
        queries = self.vectors[chosen]
        # queries are not lifted, so their distance to a row follows from the score alone
        score = queries.astype(np.float64) @ node.points.T.astype(np.float64)
        base = lengths(queries) + longest
        far = np.sqrt(np.maximum(base[:, None] - 2 * score, 0))
        slack = _SLACK * np.sqrt(base) + 1e-9
        outer = np.sqrt(np.maximum(base - 2 * np.maximum(self.low[chosen].astype(np.float64), -base), 0)) + slack
        inner = np.sqrt(np.maximum(base - 2 * np.minimum(self.high[chosen].astype(np.float64), base / 2), 0)) - slack
        ring_least, ring_most = far - outer[:, None], far + outer[:, None]
        meets = (node.least[None] <= ring_most[:, :, None]) & (node.most[None] >= ring_least[:, :, None])
        beyond = far[:, :, None] + node.most[None] >= inner[:, None, None]
        return (meets & beyond).all(axis=1), far

    def score_rows(self, chosen: np.ndarray, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        """Exact scores of a leaf's rows for the ``chosen`` searches."""
        scores = products(self.vectors[chosen], vectors)
        fits = (scores >= self.low[chosen, None]) & (scores <= self.high[chosen, None])
        fits &= (labels[None] == self.label[chosen, None]) == self.same[chosen, None]
        fits &= ids[None] != self.anchor[chosen, None]
        some = fits.any(axis=1)
        chosen, scores, fits = chosen[some], scores[some], fits[some]
        width = self.found.shape[1]
        all_scores = np.concatenate([self.found[chosen], np.where(fits, scores, _LOW)], axis=1)
        all_ids = np.concatenate([self.ids[chosen], np.where(fits, ids[None], _HIGH)], axis=1)
        # the smallest integer has no opposite, so scores are turned over bit by bit
        order = np.lexsort((all_ids, ~all_scores), axis=1)[:, :width]
        self.found[chosen], self.ids[chosen] = np.take_along_axis(all_scores, order, 1), np.take_along_axis(all_ids, order, 1)
        last = self.k[chosen] - 1
        full = self.ids[chosen, last] < _HIGH
        self.low[chosen[full]] = np.maximum(self.low[chosen[full]], self.found[chosen[full], last[full]])

    def run(self, tree: Node | np.ndarray, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, longest: float) -> int:
        """Answer all searches from a tree; returns how many rows were scored."""
        scored = 0

        def visit(node: Node | np.ndarray, chosen: np.ndarray) -> None:
            nonlocal scored
            if not len(chosen) or (isinstance(node, np.ndarray) and not len(node)):
                return
            if isinstance(node, np.ndarray):
                for i in range(0, len(node), 1024):
                    part = node[i : i + 1024]
                    scored += len(part) * len(chosen)
                    self.score_rows(chosen, vectors[part], ids[part], labels[part])
                return
            _, far = self.open_children(node, chosen, longest)
            for j in np.argsort(far.mean(axis=0)):
                # bounds have risen since the last child
                meets, _ = self.open_children(node, chosen, longest)
                visit(node.children[j], chosen[meets[:, j]])

        visit(tree, np.arange(len(self.k)))
        return scored


def searches_of(batch: pa.RecordBatch | pa.Table, width: int) -> Searches:
    names = ("_anchor", "_label", "_same", "_low", "_high", "_k")
    return Searches(matrix(batch.column("_v"), width), *[np.asarray(batch.column(n).to_pandas()) for n in names])


FOUND = "_search string, vec_id bigint, score bigint"
SEARCH = "_search string, _anchor bigint, _label int, _v array<bigint>, _same boolean, _low bigint, _high bigint, _k int"


def _answer(longest: float):
    kinds = pa.schema([("_search", pa.string()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def answer(searches: pa.Table, rows: pa.Table) -> pa.Table:
        if not searches.num_rows or not rows.num_rows:
            return kinds.empty_table()
        width = width_of(searches.column("_v"), rows.column("_v"))
        vectors, ids, labels = matrix(rows.column("_v"), width), rows.column("_id").to_numpy(), rows.column("_label").to_numpy()
        tree = build(vectors, np.arange(len(ids)), longest, LEAF)
        asked = searches_of(searches, width)
        asked.run(tree, vectors, ids, labels, longest)
        row, place = np.nonzero(asked.ids < _HIGH)
        chosen = place < asked.k[row]
        row, place = row[chosen], place[chosen]
        names = searches.column("_search").combine_chunks().take(pa.array(row))
        return pa.Table.from_arrays([names, pa.array(asked.ids[row, place]), pa.array(asked.found[row, place])], schema=kinds)

    return answer


def _number(tree: Node | np.ndarray, nodes: list[Node], leaves: list) -> None:
    """Number the nodes, and put numbers in place of the leaves."""
    if isinstance(tree, Node):
        tree.number = len(nodes)
        nodes.append(tree)
        for j, child in enumerate(tree.children):
            if isinstance(child, Node):
                _number(child, nodes, leaves)
            else:
                tree.children[j] = len(leaves)
                leaves.append(j)


@dataclass
class UpperTree:
    """A tree over a whole table whose leaves are numbers; ``pieces`` tells how many pieces each leaf has."""

    tree: Node | None
    nodes: list[Node]
    longest: float
    width: int
    pieces: dict[int, int] = field(default_factory=dict)

    def leaves(self, vectors: np.ndarray, seen=None) -> np.ndarray:
        """The leaf of each row, by the nearest split point at every node."""
        out = np.zeros(len(vectors), dtype=np.int32)

        def down(node: Node, rows: np.ndarray) -> None:
            far = distances(node.points, vectors[rows], self.longest)
            side = far.argmin(axis=0)
            if seen is not None:
                seen(node, far, side)
            for j, child in enumerate(node.children):
                part = rows[side == j]
                if not isinstance(child, Node):
                    out[part] = child
                elif len(part):
                    down(child, part)

        if self.tree and len(vectors):
            down(self.tree, np.arange(len(vectors)))
        return out

    def place(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with their leaf."""
        for batch in batches:
            leaves = self.leaves(matrix(batch.column("_v"), self.width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.int32())], names=[*batch.schema.names, "_leaf"])

    def observe(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Least and largest distances between the split points of each node and the rows of each child."""
        out = []

        def seen(node: Node, far: np.ndarray, side: np.ndarray) -> None:
            least, most = ranges(far, side, len(node.children))
            i, j = np.nonzero(np.isfinite(least))
            out.extend(zip([node.number] * len(i), i.tolist(), j.tolist(), least[i, j].tolist(), most[i, j].tolist()))

        for batch in batches:
            self.leaves(matrix(batch.column("_v"), self.width), seen)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["node", "i", "j", "least", "most"])
                out.clear()

    def meeting(self, asked: Searches) -> dict[int, np.ndarray]:
        """The searches that each leaf may hold a row for."""
        found: dict[int, np.ndarray] = {}

        def down(node: Node, chosen: np.ndarray) -> None:
            meets, _ = asked.open_children(node, chosen, self.longest)
            for j, child in enumerate(node.children):
                if not isinstance(child, Node):
                    found[child] = chosen[meets[:, j]]
                elif meets[:, j].any():
                    down(child, chosen[meets[:, j]])

        everyone = np.arange(len(asked.k))
        if not self.tree:
            return {0: everyone}
        down(self.tree, everyone)
        return found

    def visits(self, home: bool):
        """Each search once for every piece that may hold rows for it: the first piece of its own leaf, or all others."""

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                asked = searches_of(batch, self.width)
                own = self.leaves(asked.vectors)
                meets = {leaf: np.flatnonzero(own == leaf) for leaf in np.unique(own).tolist()} if home else self.meeting(asked)
                rows, leaves, pieces = [np.empty(0, np.int64)], [np.empty(0, np.int32)], [np.empty(0, np.int32)]
                for leaf, chosen in meets.items():
                    for number in range(min(self.pieces.get(leaf, 0), 1 if home else 1 << 31)):
                        other = chosen if home or number else chosen[own[chosen] != leaf]
                        rows.append(other)
                        leaves.append(np.full(len(other), leaf, np.int32))
                        pieces.append(np.full(len(other), number, np.int32))
                out = batch.take(pa.array(np.concatenate(rows)))
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, pa.array(np.concatenate(leaves)), pa.array(np.concatenate(pieces))], names=[*out.schema.names, "_leaf", "_piece"]
                )

        return visit


class Index:
    """All rows of a table (``_id, _label, _v``) in pieces, below the leaves of one upper tree.

    The split points are fitted on the ``sample`` rows with the smallest hash; the ranges between them are those of all rows.
    A leaf with more than ``piece`` rows is dealt into several pieces by a hash. At most about ``searches`` searches meet a piece at once.
    """

    def __init__(self, rows: DataFrame, sample: int = SAMPLE, piece: int = PIECE, searches: int = SEARCHES):
        self.searches = searches
        squares = F.aggregate("_v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
        size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(squares).alias("longest"), F.max(F.size("_v")).alias("width")).first()
        few = rows.orderBy(F.xxhash64("_id", "_v"), "_id").limit(sample).select("_v").toArrow()
        self.upper = self._fitted(matrix(few.column("_v"), size["width"] or 0), size, piece)
        placed = durable(rows.mapInArrow(self.upper.place, "_id bigint, _label int, _v array<bigint>, _leaf int"))
        self._fit_ranges(placed)
        pieces = placed.groupBy("_leaf").agg(F.ceil(F.count(F.lit(1)) / piece).cast("int").alias("_pieces"))
        self.upper.pieces = {r._leaf: r._pieces for r in pieces.collect()}
        of = F.pmod(F.xxhash64("_id", "_v"), F.col("_pieces")).cast("int")
        # at most one leaf for each row of the sample
        self.rows = placed.join(F.broadcast(pieces), "_leaf").select("_id", "_label", "_v", "_leaf", of.alias("_piece"))

    @staticmethod
    def _fitted(sample: np.ndarray, size, piece: int) -> UpperTree:
        longest, nodes = size["longest"] or 0.0, []
        wanted = max(SAMPLE_LEAF, -(-len(sample) * piece // max(size["n"], 1)))
        tree = build(sample, np.arange(len(sample)), longest, wanted)
        if not isinstance(tree, Node):
            return UpperTree(None, nodes, longest, size["width"] or 0)
        _number(tree, nodes, [])
        return UpperTree(tree, nodes, longest, size["width"])

    def _fit_ranges(self, rows: DataFrame) -> None:
        """Take the distances between split points and the rows of each child over all rows."""
        got = rows.select("_v").mapInArrow(self.upper.observe, "node bigint, i bigint, j bigint, least double, most double")
        for node in self.upper.nodes:
            node.least = np.full((len(node.children),) * 2, np.inf)
            node.most = np.full((len(node.children),) * 2, -np.inf)
        for r in got.groupBy("node", "i", "j").agg(F.min("least").alias("least"), F.max("most").alias("most")).collect():
            node = self.upper.nodes[r.node]
            node.least[r.i, r.j], node.most[r.i, r.j] = r.least, r.most

    def _meet(self, searches: DataFrame, home: bool) -> DataFrame:
        visits = durable(searches.mapInArrow(self.upper.visits(home), f"{SEARCH}, _leaf int, _piece int"))
        most = visits.groupBy("_leaf", "_piece").count().agg(F.max("count")).first()[0] or 0
        parts = max(1, -(-most // self.searches))
        place = ["_leaf", "_piece", "_part"]
        visits = visits.withColumn("_part", F.pmod(F.xxhash64("_search"), F.lit(parts)).cast("int"))
        met = visits.select(F.col("_leaf").alias("_l"), F.col("_piece").alias("_p"), F.col("_part").alias("_met")).distinct()
        rows = self.rows.join(met, (F.col("_leaf") == F.col("_l")) & (F.col("_piece") == F.col("_p")))
        rows = rows.select("_id", "_label", "_v", "_leaf", "_piece", F.col("_met").alias("_part"))
        return visits.groupBy(*place).cogroup(rows.groupBy(*place)).applyInArrow(_answer(self.upper.longest), FOUND)

    def search(self, searches: DataFrame, most: int) -> DataFrame:
        """``_search, rank, vec_id, score`` of the best rows of every search, in two steps.

        The first asks one piece of the leaf that the search itself would be in. Its kth score is the bound with which the
        second leaves out pieces. ``most`` is the largest ``_k``.
        """
        searches = durable(searches)
        near = durable(self._meet(searches, home=True))
        kth = top_per_key(near, "_search", [F.desc("score"), F.asc("vec_id")], most)
        kth = kth.join(searches.select("_search", "_k"), "_search").filter("rank = _k").select("_search", F.col("score").alias("_kth"))
        bounded = searches.join(kth, "_search", "left").withColumn("_low", F.greatest("_low", F.coalesce("_kth", "_low")))
        everything = union_all([near, self._meet(bounded.select(searches.columns), home=False)])
        return top_per_key(everything, "_search", [F.desc("score"), F.asc("vec_id")], most)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    share: tuple[int, int] = SHARE,
    **options: int,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components are ``floor(256 * x)`` and a score is the integer inner product with the anchor; higher scores come first, ties fall
    to the smaller ``vec_id``. Anchors are the rows for which ``is_anchor`` holds (a condition on ``vec_id``), ``label`` is the label to go by. The
    first ``positives`` other rows of its label are an anchor's positives; for each, the first ``negatives`` rows of other labels
    whose score is between ``share`` hundredths of the positive's are returned.

    Rows without an id or a label, null vectors and vectors with null or non-finite components take no part; shorter vectors count
    as ending in zeros. Rows that repeat an id count each; as anchors they are asked once, by the row with the smallest label and vector.
    A repeated positive has its negatives each time. Scores beyond 64 bits are held at the end of that range.
    A positive with a negative score has no negatives. An empty table gives no rows; other columns are not read.
    """
    ident = F.col("vec_id").cast("bigint")
    rows = vectors.select(ident.alias("_id"), label.cast("int").alias("_label"), quantised().alias("_v"), F.coalesce(is_anchor, F.lit(False)).alias("_asks"))
    rows = durable(rows.filter("_id is not null and _label is not null and _v is not null"))
    anchors = rows.filter("_asks").groupBy("_id").agg(F.min(F.struct("_label", "_v")).alias("_row"))
    anchors = durable(anchors.select(F.col("_id").alias("_anchor"), "_row.*"))
    index = Index(rows.select("_id", "_label", "_v"), **options)

    def asked(name: Column, same: bool, low: Column, high: Column, k: int) -> list[Column]:
        return [
            name.alias("_search"), F.col("_anchor"), F.col("_label"), F.col("_v"), F.lit(same).alias("_same"),
            low.cast("bigint").alias("_low"), high.cast("bigint").alias("_high"), F.lit(k).alias("_k"),
        ]

    name = F.col("_anchor").cast("string")
    first = index.search(anchors.select(*asked(name, True, F.lit(_LOW), F.lit(_HIGH), positives)), positives)
    first = durable(first.select(F.col("_search").cast("bigint").alias("_anchor"), F.col("rank").alias("_nth"), "vec_id", "score"))
    wanted = first.filter("score >= 0").join(anchors, "_anchor")
    name = F.concat_ws(":", "_anchor", "_nth")
    # in decimals, so that no product leaves the range: the least score from the share up, and the largest
    score = F.col("score").cast("decimal(20,0)")
    low, high = F.ceil(score * share[0] / 100), F.floor(score * share[1] / 100)
    second = index.search(wanted.select(*asked(name, False, low, high, negatives)), negatives)
    named = first.select(name.alias("_search"), F.col("_anchor").alias("anchor_id"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return second.join(named, "_search").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
