"""Exact Jaccard join of word n-grams in the Jaccard metric space.

A document is its set of distinct word shingles, and ``1 - intersection / union`` is a metric.
Documents of one set are one point. The join goes on in regions:

1. Regions begin where points share a rare shingle. A fixed order of all shingles (a quarter of
   them, chosen by hash and ordered by frequency, before the others) gives each point a
   prefix so long that linked points share a shingle of it. The points of a shingle's prefix list
   form a region around its smallest point; lists with one smallest point are one region. Points
   that share none have no link.
2. In a region some points are pivots. Exact distances to all pivots give links, and Voronoi cells
   by the nearest pivot. With r the largest linked distance, a point also goes into a
   cell if it is at most ``2 r`` further from the cell's pivot than from its own: by the triangle
   inequality no point linked to a member of the cell is left out. Cells are regions again, until
   they are small or hang together by links already known, as large groups of near copies do.

Regions that fit one task run this recursion in numpy. Larger ones run it as Spark jobs, pivots
against chunks of points, until their cells fit. If cells do not become smaller (points at nearly equal
distances), chunks of the region meet pairwise: exact, whatever the data. Shingles are compared by
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import pick, stored
from adlens.operators.components import connected_components
from adlens.operators.dimensions import is_broadcastable

SHINGLE = 4
PERCENT = 85
# Shingles of a region that one task takes; pivots of a region; points that are compared without pivots.
TASK_SHINGLES = 2_000_000
PIVOTS = 24
MOST_PIVOTS = 62
LEAF = 24
# Cells together larger than this multiple of their region are no progress.
BLOWUP = 4
_EVERY = 4
_SLACK = 1e-9


def shingles(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text (fewer words: the whole sequence)."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    grams = set(map(b" ".join, zip(*(words[i:] for i in range(k))))) or ({b" ".join(words)} if words else ())
    return np.unique(np.fromiter(map(xxh64_intdigest, grams), np.uint64, len(grams)).view(np.int64))


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """So many first shingles of a set of ``n`` hold one of any linked set's."""
    return n - -(-percent * n // 100) + 1


class _Region:
    """Sets of one task, and the components of the links found so far."""

    def __init__(self, sets: list[np.ndarray], percent: int, labels: list | None = None):
        self.percent, self.radius = percent, 1 - percent / 100
        self.sizes = np.array([len(s) for s in sets])
        names, flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.sets = np.split(flat, np.cumsum(self.sizes)[:-1])
        self.mark = np.zeros(len(names), bool)
        self.up = np.arange(len(sets))
        self.links: list[tuple[int, int]] = []
        first: dict = {}
        for i, label in enumerate(labels or []):
            if label is not None and (j := first.setdefault(label, i)) != i:
                self._join(i, j)

    def _root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def _join(self, i: int, j: int) -> bool:
        i, j = self._root(i), self._root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j

    def _roots(self, ids: np.ndarray) -> np.ndarray:
        while True:
            up = self.up[self.up]
            if (up == self.up).all():
                return up[ids]
            self.up = up

    def _shared(self, i: int, ids: np.ndarray) -> np.ndarray:
        """Intersection sizes of one set with others; new links are noted."""
        self.mark[self.sets[i]] = True
        flat = np.concatenate([self.sets[j] for j in ids])
        ends = np.cumsum(self.sizes[ids])
        both = np.add.reduceat(self.mark[flat].astype(np.int64), ends - self.sizes[ids])
        self.mark[self.sets[i]] = False
        union = self.sizes[ids] + self.sizes[i] - both
        for j in ids[100 * both >= self.percent * union].tolist():
            if self._join(i, j):
                self.links.append((i, j))
        return both / union

    def run(self, ids: np.ndarray) -> None:
        """Link all of ``ids`` that are linked, as far as components tell."""
        todo = [ids]
        while todo:
            ids = todo.pop()
            roots = self._roots(ids)
            if (roots == roots[0]).all():
                continue
            if len(ids) <= LEAF:
                self._sweep(ids, None)
                continue
            k = min(PIVOTS, len(ids) // 8 + 2)
            at = np.linspace(0, len(ids) - 1, k).astype(int)
            far = 1 - np.stack([self._shared(ids[p], ids) for p in at])
            own = far.min(axis=0)
            cells = far <= own + 2 * self.radius + _SLACK
            cells[:, at] = False
            sizes = cells.sum(axis=1)
            if sizes.sum() > BLOWUP * len(ids) or sizes.max() > 0.75 * len(ids):
                rest = np.ones(len(ids), bool)
                rest[at] = False
                self._sweep(ids[rest], far[:, rest])
            else:
                todo += [ids[c] for c, n in zip(cells, sizes) if n > 1]

    def _sweep(self, ids: np.ndarray, far: np.ndarray | None) -> None:
        """Each point outside the largest component meets all others that sizes and the
        triangle inequality leave."""
        roots = self._roots(ids)
        names, counts = np.unique(roots, return_counts=True)
        main = names[counts.argmax()]
        done = np.zeros(len(ids), bool)
        for k, i in enumerate(ids.tolist()):
            if self._root(i) == self._root(main):
                continue
            n = self.sizes[i]
            good = ~done & (100 * np.minimum(self.sizes[ids], n) >= self.percent * np.maximum(self.sizes[ids], n))
            if far is not None:
                good &= (np.abs(far - far[:, k:k + 1]) <= self.radius + _SLACK).all(axis=0)
            done[k] = True
            good[k] = False
            if good.any():
                self._shared(i, ids[good])


def region_links(sets: list[np.ndarray], percent: int = PERCENT, labels: list | None = None) -> list[tuple[int, int]]:
    """Links ``(i, j)`` that connect all sets of a similarity of ``percent`` or more. Sets of one
    non-null label count as connected."""
    region = _Region(sets, percent, labels)
    region.run(np.arange(len(sets)))
    return region.links


def _runs_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows of each distinct value of the first ``keys`` columns; batches are sorted by them."""
    held, key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_pylist() for i in range(keys)]
        at = 0
        for k, now in enumerate(zip(*columns)):
            if now != key:
                if k > at:
                    held.append(batch.slice(at, k - at))
                if held:
                    yield pa.Table.from_batches(held)
                held, key, at = [], now, k
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _sets(column: pa.ChunkedArray) -> list[np.ndarray]:
    out = []
    for chunk in column.chunks:
        values, ends = chunk.flatten().to_numpy(), chunk.value_lengths().to_numpy().cumsum()
        out += np.split(values, ends[:-1]) if len(ends) else []
    return out


def _in_tasks(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """``a, b``: links within the groups of ``keys`` of ``rows`` (``pt, label, grams``), a group a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs_of(batches, len(keys)):
            points = group.column("pt").to_pylist()
            links = region_links(_sets(group.column("grams")), percent, group.column("label").to_pylist())
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_pydict({"a": pa.array([points[i] for i in a], pa.int64()),
                                                  "b": pa.array([points[i] for i in b], pa.int64())})

    return rows.select(*keys, "pt", "label", "grams").repartition(*keys).sortWithinPartitions(*keys) \
        .mapInArrow(run, "a long, b long")


def _with(rows: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join that broadcasts ``small`` only if its measured size allows it."""
    return rows.join(F.broadcast(small) if is_broadcastable(small) else small.hint("merge"), on, how)


def _cells(large: DataFrame, percent: int, turn: int, task: int) -> DataFrame:
    """Rows of large regions with ``linked`` (pivots linked to the point), ``cells`` (numbers of
    the pivots in whose cell or window it lies) and ``pivot`` (whether it is one). ``large``:
    ``region, pt, n, label, grams, points, weight``."""
    slot = F.pmod(F.xxhash64("pt", F.lit(turn)), F.lit(1 << 20))
    salts = F.ceil(F.col("weight") / task).cast("int")
    pivots = large.filter(slot < F.lit(PIVOTS << 20) / F.col("points")).select(
        F.col("region").alias("region"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"),
        F.col("pt").alias("pt"), F.col("grams").alias("grams"))
    rows = large.select("region", F.pmod(F.xxhash64("pt", F.lit(turn + 0.5)), salts).cast("int").alias("salt"),
                        "pt", "n", "label", "grams")
    radius = 1 - percent / 100

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("pt").to_numpy())[:MOST_PIVOTS]
        names, sets = right.column("pt").to_numpy()[order], _sets(right.column("grams"))
        points, linked = left.column("pt").to_numpy(), [[] for _ in range(left.num_rows)]
        # Should chance name no pivot, the region stays as it is for another turn.
        cells = [[] if len(names) else [0] for _ in range(left.num_rows)]
        if left.num_rows and len(names):
            grams = _sets(left.column("grams"))
            sizes = np.array([len(g) for g in grams])
            flat, starts = np.concatenate(grams), np.cumsum(sizes) - sizes
            far = np.empty((len(names), len(points)))
            for k, p in enumerate(order):
                both = np.add.reduceat(np.isin(flat, sets[p]).astype(np.int64), starts)
                union = sizes + len(sets[p]) - both
                far[k] = 1 - both / union
                for j in np.flatnonzero(100 * both >= percent * union):
                    linked[j].append(int(names[k]))
            for k, near in enumerate(far <= far.min(axis=0) + 2 * radius + _SLACK):
                for j in np.flatnonzero(near):
                    cells[j].append(k)
        out = left.drop_columns(["salt"])
        return out.append_column("linked", pa.array(linked, pa.list_(pa.int64()))) \
                  .append_column("cells", pa.array(cells, pa.list_(pa.int32()))) \
                  .append_column("pivot", pa.array(np.isin(points, names)))

    return rows.groupBy("region", "salt").cogroup(pivots.groupBy("region", "salt")).applyInArrow(
        run, "region string, pt long, n int, label long, grams array<long>, linked array<long>, cells array<int>, pivot boolean")


def _sizes(rows: DataFrame) -> DataFrame:
    label = F.coalesce("label", "pt")
    return rows.groupBy("region").agg(F.count(F.lit(1)).alias("points"), F.sum("n").alias("weight"),
                                      (F.min(label) < F.max(label)).alias("open"))


def metric_links(rows: DataFrame, percent: int = PERCENT, task: int = TASK_SHINGLES) -> DataFrame:
    """``a, b``: links that connect all linked points of every region of ``rows`` (``region, pt, n, label,
    grams``; stored, or cheap to read twice)."""
    links, turn = [], 0
    while True:
        sizes = stored(_sizes(rows).filter(F.col("open") & (F.col("points") > 1)), "jaccard-regions")
        small = _with(rows, sizes.filter(F.col("weight") <= task).select("region"), "region", "left_semi")
        links.append(_in_tasks(small, ["region"], percent))
        if sizes.filter(F.col("weight") > task).isEmpty():
            break
        turn += 1
        large = _with(rows, sizes.filter(F.col("weight") > task).drop("open"), "region")
        dealt = stored(_cells(large, percent, turn, task), "jaccard-cells")
        found = stored(dealt.select(F.explode("linked").alias("a"), F.col("pt").alias("b")).filter("a != b")
                            .unionByName(dealt.filter("label IS NOT NULL").select(F.col("label").alias("a"), F.col("pt").alias("b"))
                                              .filter("a != b")), "jaccard-links")
        links.append(found)
        names = connected_components(found, None, "a", "b").select(F.col("id").alias("pt"), F.col("component").alias("name"))
        known = stored(dealt.join(names, "pt", "left").withColumn("label", F.coalesce("name", "label")).drop("name", "linked"),
                       "jaccard-known")
        # What one component of links holds is done; pivots have met all points of their region.
        still = stored(_sizes(known).filter("open").select("region", "weight"), "jaccard-open")
        rest = _with(known.filter(~F.col("pivot")), still, "region")
        growth = stored(rest.groupBy("region").agg(F.sum(F.col("n") * F.size("cells")).alias("cells_weight"),
                                                   F.max("weight").alias("weight"))
                            .select("region", (F.col("cells_weight") > BLOWUP * F.col("weight")).alias("stuck")), "jaccard-growth")
        rest = _with(rest, growth, "region")
        chunks = F.ceil(2 * F.col("weight") / task).cast("int")
        mine = F.pmod(F.xxhash64("pt", F.lit(-turn)), chunks).cast("int")
        swept = rest.filter("stuck").withColumn("mine", mine).withColumn(
            "other", F.explode(F.sequence(F.lit(0), chunks - 1))).select(
            "region", F.least("mine", "other").alias("c"), F.greatest("mine", "other").alias("d"), "pt", "label", "grams")
        links.append(_in_tasks(swept, ["region", "c", "d"], percent))
        rows = stored(rest.filter(~F.col("stuck")).withColumn("cell", F.explode("cells")).select(
            F.concat_ws("/", "region", F.col("cell").cast("string")).alias("region"), "pt", "n", "label", "grams"), "jaccard-rows")
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def _points(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, row, text, n, key, own, head``: the size and digest of each set, and the shingles that its
    prefix may need: those of the ordered quarter (``own`` of them), and others if they are too few."""
    base = pick(docs, doc_id=id_col, text=text_col).withColumn("row", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_hexdigest

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n, keys, own, heads = [], [], [], []
                for text in part.column(1).to_pylist():
                    s = shingles(text, k)
                    n.append(len(s))
                    keys.append(xxh3_128_hexdigest(s.tobytes()) if len(s) else None)
                    first = s[s % _EVERY == 0]
                    own.append(len(first))
                    room = prefix_size(len(s), percent) - len(first) if len(s) else 0
                    heads.append(np.concatenate([first, s[s % _EVERY != 0][:room]]) if room > 0 else first)
                ends = np.cumsum([0, *map(len, heads)]).astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column(0), "text": part.column(1), "row": part.column(2), "n": pa.array(n, pa.int32()),
                    "key": pa.array(keys, pa.string()), "own": pa.array(own, pa.int32()),
                    "head": pa.ListArray.from_arrays(ends, np.concatenate(heads))})

    id_type = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(run, f"doc_id {id_type}, text string, row long, n int, key string, own int, head array<long>")


def _regions(points: DataFrame, percent: int) -> DataFrame:
    """``region, pt``: the points (``pt, n, own, head``) of each region."""
    room = F.col("n") - F.expr(f"(n * {percent} + 99) div 100").cast("int") + 1 - F.col("own")
    grams = points.select("pt", room.alias("room"), F.explode("head").alias("gram"))
    shared = stored(grams.groupBy("gram").count().filter("count > 1"), "jaccard-shared")
    other = F.pmod("gram", F.lit(_EVERY)) != 0
    mine = grams.join(shared.hint("merge"), "gram").groupBy("pt").agg(
        F.max("room").alias("room"), F.count_if(~other).alias("own"),
        F.sort_array(F.collect_list(F.struct(other.alias("o"), F.col("count").alias("c"), "gram"))).alias("list"))
    # Shingles of one point alone come first and fill their places of the prefix.
    prefix = stored(mine.withColumn("left", (F.col("room") + F.col("own")).cast("int")).filter("left > 0").select(
        "pt", F.explode(F.slice("list", F.lit(1), F.col("left"))["gram"]).alias("gram")), "jaccard-prefix")
    heads = prefix.groupBy("gram").agg(F.min("pt").alias("region"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    return prefix.join(stored(heads, "jaccard-heads").hint("merge"), "gram").select("region", "pt").distinct()


def jaccard_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id",
                       text_col: str = "text", task: int = TASK_SHINGLES) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row: the size of its shingle set, and the smallest
    non-null id that links of at least ``percent`` similarity lead to (its own included).

    A text of fewer than ``k`` words is one shingle; a null, empty or all-space text has none and
    links with nothing, not even another such text. Equal sets link, repeated rows too. Null
    ids take part but name no component; one of null ids only has a null id. Texts of any length
    are read whole. An empty table gives no rows; extra columns are ignored.
    """
    table = stored(_points(docs, k, percent, id_col, text_col), "jaccard-points")
    classes = stored(table.filter("n > 0").groupBy("key").agg(F.min("row").alias("pt")), "jaccard-classes")
    firsts = classes.select(F.col("pt").alias("row"))
    # Sets as small as that link only with equal ones: no other size is near enough.
    least = next((n for n in range(1, 101) if 100 * n >= percent * (n + 1)), 101)
    points = _with(table.filter(F.col("n") >= least), firsts, "row", "left_semi").select(F.col("row").alias("pt"), "n", "own", "head")
    members = stored(_regions(points, percent), "jaccard-members")
    wanted = stored(members.select(F.col("pt").alias("row")).distinct(), "jaccard-wanted")

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingles(t, k) for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                yield pa.RecordBatch.from_pydict({"pt": part.column(0), "n": pa.array(np.diff(ends), pa.int32()),
                                                  "grams": pa.ListArray.from_arrays(ends, np.concatenate(sets))})

    sets = stored(_with(table.select("row", "text"), wanted, "row", "left_semi").mapInArrow(full, "pt long, n int, grams array<long>"),
                  "jaccard-sets")
    rows = _with(sets, members, "pt").select(F.col("region").cast("string").alias("region"), "pt", "n",
                                             F.lit(None).cast("long").alias("label"), "grams")
    links = stored(metric_links(rows, percent, task), "jaccard-all-links")
    names = connected_components(links, None, "a", "b").select(F.col("id").alias("pt"), "component")
    labels = stored(classes.join(names, "pt", "left").select("key", F.coalesce("component", "pt").alias("label")), "jaccard-labels")
    named = stored(table.filter("n > 0").select("doc_id", "n", "key").join(labels, "key"), "jaccard-named")
    # Stored, so that the join may split a large component's label.
    best = stored(named.groupBy("label").agg(F.min("doc_id").alias("component_id")), "jaccard-names")
    return named.join(best, "label").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id").unionByName(
        table.filter("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def op12(docs: DataFrame) -> DataFrame:
    return jaccard_components(docs)
