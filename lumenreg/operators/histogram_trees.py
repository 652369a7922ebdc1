"""Regression trees from histograms: all folds, candidates and the refit grow together.

One level of every tree costs one map-side aggregation over the kept rows, whatever the
number of folds and candidates. The rows are packed for these passes: a packed row holds
the values, labels, folds and range numbers of one Arrow batch of rows as arrays.

* **Cells.** A task adds up count and label sum for each (node, fold, feature, range of
  the feature's values) in arrays, and hands on the cells it met; Spark adds the tasks'
  cells up. The driver gets nodes x folds x features x ranges of them, whatever the rows.
* **Fold complement.** The model that leaves fold f out has the sum over all folds less
  fold f; the refit has the sum. Nodes that several models share (the same path of
  splits on the same target) are one node, counted once.
* **Candidates.** A tree of less depth or of a higher ``minInfoGain`` is the deepest one
  cut short, so one tree serves them. In boosting, candidates differ in their residuals:
  each different ensemble so far is a target of its own, counted in the same pass.

``binning="quantile"`` splits between ranges of equal frequency (``binning.rank_values``).
``binning="exact"`` splits between any two values of the training rows, without one task
that sees all values of a feature: the ranges' totals are offsets, and a range is looked
into only if no split inside it can be ruled out. The score of a split is convex in the
left side's count and sum, and those lie in a parallelogram given by the range's totals
and its least and largest label, so its corners bound the score from above. What is left
is grouped by value, spread by range, sorted, and read with running sums that start at
the offsets, in batches: a range's values need not fit a task's memory.

Ties: gains equal to rounding go to the first feature, then the lowest threshold. A
split needs a positive gain and rows on both sides. Thresholds lie midway to the next
value (or range) of the model's training rows, in the node or not, as in MLlib; between
adjacent doubles the lower one is the threshold.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenreg.operators import trees as trees_module
from lumenreg.operators.binning import rank_values
from lumenreg.operators.partitioning import merged
from lumenreg.operators.trees import Tree, TreeEnsemble, route

# tasks get these functions by value: executors need not have the package
for _module in (sys.modules[__name__], trees_module):
    cloudpickle.register_pickle_by_value(_module)

#: Ranges of a feature in the exact search. They steer it; the trees don't depend on them.
RANGES = 1024
#: Cells of one counting pass: a task and the driver hold about 50 bytes for each. A level
#: of more nodes takes several passes.
MOST_CELLS = 4_000_000
#: Rows, about, that the exact search draws its ranges from.
SAMPLE_ROWS = 50_000
#: Gains are equal if they differ by less than this part of the score.
TIE = 1e-12
#: Bytes of packed rows, about, that are handed to a task at once.
PACK_BYTES = 16 << 20
PACK_SCHEMA = "x binary, y binary, fold binary, at binary"
CELL_SCHEMA = "cell long, n double, s double, low double, high double, first double, last double"


# ---------------------------------------------------------------- the kept rows
@dataclass
class Rows:
    """Kept training rows, packed and persisted. ``cuts`` part each feature's values.

    ``passes`` counts the counting passes; finding the cuts is one.
    """

    df: DataFrame
    n: int
    mean: float
    cuts: list
    folds: list
    passes: int = 1

    @property
    def width(self) -> int:
        return len(self.cuts)

    @property
    def ranges(self) -> int:
        return max(len(c) for c in self.cuts) + 1

    def merged(self) -> DataFrame:
        """The packed rows for a counting pass."""
        return merged(self.df, self.n)

    def counted(self, run, schema: str, summary) -> object:
        """What ``summary`` collects of ``run`` over the packed rows, in batches of bounded bytes."""
        spark, name = self.df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
        before = spark.conf.get(name, None)
        self.passes += 1
        try:
            spark.conf.set(name, str(PACK_BYTES))
            return summary(self.merged().mapInArrow(run, schema))
        finally:
            spark.conf.unset(name) if before is None else spark.conf.set(name, before)

    def release(self) -> None:
        """Drop the packed rows."""
        self.df.unpersist()


def kept_rows(df: DataFrame, features: list[str], label: str, fold_col: str,
              ranges: int = RANGES, accuracy: int | None = None, exact: bool = False) -> Rows:
    """Count, mean, folds and cut points of the rows.

    Cut points are values at equal steps of rank (``binning.rank_values``: exact, so within
    n / ``accuracy`` ranks whatever accuracy is asked for). For the exact search, which they
    only steer, they come from about SAMPLE_ROWS rows drawn at random. NaN and null in a
    feature or label fail, with the columns' names.
    """
    if ranges < 2:
        raise ValueError(f"need at least 2 ranges, got {ranges}")
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)],
                     F.col(label).cast("double").alias("y"), F.col(fold_col).cast("int").alias("fold"))
    names = [f"x{i}" for i in range(len(features))] + ["y"]
    shares = [i / ranges for i in range(1, ranges)]
    row = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean"),
                   F.collect_set("fold").alias("folds"),
                   *[F.count_if(F.col(c).isNull() | F.isnan(c)).alias(f"bad_{c}") for c in names]).first()
    bad = [c for c, name in zip([*features, label], names) if row[f"bad_{name}"]]
    if bad:
        raise ValueError(f"NaN in column(s) {', '.join(bad)}; remove or mend these rows first")
    if not row["n"]:
        raise ValueError("no training rows")
    if exact:
        drawn = rows.select(*names[:-1]).sample(min(1.0, SAMPLE_ROWS / row["n"]), 1).toArrow()
        shares = np.arange(1, ranges) * drawn.num_rows // ranges
        cuts = [np.unique(np.sort(c.to_numpy())[shares]) if drawn.num_rows else np.zeros(1)
                for c in drawn.columns]
    else:
        cuts = [np.unique(np.array(v, float)) for v in rank_values(rows, names[:-1], shares, row["n"])]
    packed = rows.mapInArrow(_packer(cuts), PACK_SCHEMA).persist(StorageLevel.MEMORY_AND_DISK)
    return Rows(packed, row["n"], float(row["mean"]), cuts, sorted(row["folds"]))


def _packer(cuts: list):
    """Packs each batch of x0.., y, fold into one row: values, labels, folds, range numbers."""
    width, kind = len(cuts), _place_type(cuts)

    def pack(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            *x, y, fold = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(width + 2)]
            at = [np.searchsorted(c, v, side="right").astype(kind) for c, v in zip(cuts, x)]
            parts = (np.stack(x), y, fold.astype(np.int32), np.stack(at))
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts],
                                             names=["x", "y", "fold", "at"])

    return pack


def _place_type(cuts: list):
    return np.uint16 if max(map(len, cuts)) < 1 << 16 else np.int32


def _unpacked(batches, cuts: list):
    """(x, y, fold, range numbers) of each packed row; x and range numbers by (row, feature)."""
    width, kind = len(cuts), _place_type(cuts)
    for batch in batches:
        for x, y, fold, at in zip(*(c.cast(pa.binary()) for c in batch.columns)):
            get = lambda v, t: np.frombuffer(v.as_buffer(), t)
            yield (get(x, np.float64).reshape(width, -1).T, get(y, np.float64), get(fold, np.int32),
                   get(at, kind).reshape(width, -1).T)


def _target(base: list, mean: float, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The label less its mean, or twice the residual of an ensemble of (weight, arrays)."""
    if not base:
        return y - mean
    score = sum(w * arrays[4][route(arrays, x)] for w, arrays in base)
    return 2.0 * (y - score)


# ---------------------------------------------------------------- models and nodes
@dataclass(eq=False)
class Model:
    """One tree to grow: on which rows (all but a fold), on which target."""

    left_out: object
    limit: int
    base: list = field(default_factory=list)  # (weight, Tree) of the ensemble so far
    tree: Tree = field(default_factory=Tree)
    paths: dict = field(default_factory=dict)  # open node -> splits that lead there
    edges: dict = field(default_factory=dict)  # node -> (feature, value left of the split, range)

    def target(self) -> tuple:
        return tuple((w, t.key()) for w, t in self.base)


def _routings(rows: Rows, models: list[Model]):
    """(what tasks need to route rows to slots, users of each slot), for each counting pass.

    A slot is a (target, path). Models that share a path share its slot; the first tree
    that has it routes there. So many slots go into a pass as its cells allow.
    """
    at_once = max(1, MOST_CELLS // (len(rows.folds) * rows.width * rows.ranges))
    slots: dict = {}
    tables, users = [], []
    for m in models:
        target = m.target()
        table = np.full(len(m.tree.value), -1)
        for node, path in m.paths.items():
            if (target, path) not in slots:
                slots[target, path] = table[node] = len(users)
                users.append([])
            users[slots[target, path]].append((m, node))
        tables.append(table)
    for start in range(0, len(users), at_once):
        routers = []
        for m, table in zip(models, tables):
            part = np.where((table >= start) & (table < start + at_once), table - start, -1)
            if (part >= 0).any():
                routers.append(([(w, t.arrays()) for w, t in m.base], m.tree.arrays(), part))
        yield routers, dict(enumerate(users[start:start + at_once]))


def _count_cells(rows: Rows, routers: list, slots: int, exact: bool = True) -> dict:
    """Arrays (slot, fold, feature, range) of count, sum, least and largest label and value.

    Only the exact search asks for the least and largest.
    """
    width, ranges, folds = rows.width, rows.ranges, len(rows.folds)
    cuts, mean, fold_at = rows.cuts, rows.mean, np.array(rows.folds)
    shape = (slots, folds, width, ranges)
    size = int(np.prod(shape))

    def run(batches):
        n, s = np.zeros(size), np.zeros(size)
        low, high = np.full(size, np.inf), np.full(size, -np.inf)
        first, last = np.full(size, np.inf), np.full(size, -np.inf)
        for x, y, fold, at in _unpacked(batches, cuts):
            fold = np.searchsorted(fold_at, fold)
            for base, tree, table in routers:
                slot = table[route(tree, x)]
                mine = np.flatnonzero(slot >= 0)
                if not len(mine):
                    continue
                all_ = len(mine) == len(slot)
                of = (lambda a: a) if all_ else (lambda a: a[mine])
                t = _target(base, mean, x if base and all_ else x[mine] if base else x, of(y))
                begin = (of(slot) * folds + of(fold)) * width
                for f in range(width):
                    cell = (begin + f) * ranges + of(at[:, f])
                    np.add.at(n, cell, 1.0)
                    np.add.at(s, cell, t)
                    if not exact:
                        continue
                    v = of(x[:, f])
                    np.minimum.at(low, cell, t)
                    np.maximum.at(high, cell, t)
                    np.minimum.at(first, cell, v)
                    np.maximum.at(last, cell, v)
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int64()), *(pa.array(a[met]) for a in (n, s, low, high, first, last))],
            names=["cell", "n", "s", "low", "high", "first", "last"])

    found = rows.counted(run, CELL_SCHEMA, lambda cells: cells.groupBy("cell").agg(
        F.sum("n"), F.sum("s"), F.min("low"), F.max("high"), F.min("first"), F.max("last")).toArrow())
    cell = found.column(0).to_numpy()
    out = {}
    for i, (name, empty) in enumerate((("n", 0.0), ("s", 0.0), ("low", np.inf), ("high", -np.inf),
                                       ("first", np.inf), ("last", -np.inf)), 1):
        full = np.full(size, empty)
        full[cell] = found.column(i).to_numpy()
        out[name] = full.reshape(shape)
    return out


def _of_model(cells: dict, slot: int, out: int | None) -> dict:
    """A slot's arrays (feature, range) over the rows of all folds but ``out``."""
    some = [f for f in range(cells["n"].shape[1]) if f != out]
    get = {"n": np.sum, "s": np.sum, "low": np.min, "high": np.max, "first": np.min, "last": np.max}
    return {k: g(cells[k][slot][some], axis=0) for k, g in get.items()}


def _score(n, s, total_n, total_s):
    """n times the label variance that a split explains, plus the parent's s^2 / n."""
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(n > 0, s * s / n, 0.0)
        right = np.where(total_n - n > 0, (total_s - s) ** 2 / (total_n - n), 0.0)
    return left + right


def _bounds(c: dict, n0: np.ndarray, s0: np.ndarray, total_n: float, total_s: float) -> np.ndarray:
    """No split inside a range scores more than this (see the module)."""
    spread = c["high"] - c["low"]
    inside = (c["n"] > 1) & (c["first"] < c["last"])
    with np.errstate(divide="ignore", invalid="ignore"):
        many = np.where(spread > 0, (c["s"] - c["n"] * c["low"]) / spread, 0.0)
        low, high = np.where(inside, c["low"], 0.0), np.where(inside, c["high"], 0.0)
        over = _score(n0 + many, s0 + many * high, total_n, total_s)
        under = _score(n0 + c["n"] - many, s0 + (c["n"] - many) * low, total_n, total_s)
        ends = np.maximum(_score(n0, s0, total_n, total_s), _score(n0 + c["n"], s0 + c["s"], total_n, total_s))
    return np.where(inside, np.maximum(np.maximum(over, under), ends), -np.inf)


@dataclass
class Search:
    """What is known of one model's open node: totals, and its best split so far."""

    model: Model
    node: int
    n: float
    s: float
    #: (score, feature, value left of the split, value to route by, range or None, left n, left s)
    found: list = field(default_factory=list)

    def best(self):
        if not self.found:
            return None
        top = max(f[0] for f in self.found)
        near = [f for f in self.found if f[0] >= top - TIE * abs(top)]
        return min(near, key=lambda f: (f[1], f[2]))


def _search_ranges(rows: Rows, cells: dict, users: dict, exact: bool):
    """(searches, ranges to look into): splits between ranges, and bounds inside them."""
    searches, alive = [], {}
    for slot, using in users.items():
        everyone = _of_model(cells, slot, None)
        for model, node in using:
            out = rows.folds.index(model.left_out) if model.left_out is not None else None
            c = everyone if out is None else _of_model(cells, slot, out)
            total_n, total_s = c["n"][0].sum(), c["s"][0].sum()
            s = Search(model, node, total_n, total_s)
            searches.append(s)
            if total_n < 2:
                continue
            ends_n, ends_s = np.cumsum(c["n"], axis=1), np.cumsum(c["s"], axis=1)
            valid = (c["n"] > 0) & (ends_n < total_n)
            score = np.where(valid, _score(ends_n, ends_s, total_n, total_s), -np.inf)
            for f in range(rows.width):
                r = int(np.argmax(score[f] >= score[f].max() - TIE * abs(score[f].max())))
                if not valid[f, r]:
                    continue
                # rows of a fold left out may lie before the next range that the model has
                onward = np.flatnonzero(c["n"][f, r + 1:] > 0)
                until = r + 1 + (int(onward[0]) if len(onward) else 0)
                s.found.append((score[f, r], f, c["last"][f, r],
                                everyone["last"][f, r:max(until, r + 1)].max(), r, ends_n[f, r], ends_s[f, r]))
            if exact:
                top = max((x[0] for x in s.found), default=total_s ** 2 / total_n)
                bound = _bounds(c, ends_n - c["n"], ends_s - c["s"], total_n, total_s)
                for f, r in zip(*np.nonzero(bound >= top - 1e-9 * abs(top))):
                    alive.setdefault((slot, int(f), int(r)), []).append(
                        (len(searches) - 1, -1 if out is None else out, float(ends_n[f, r] - c["n"][f, r]),
                         float(ends_s[f, r] - c["s"][f, r]), float(total_n), float(total_s)))
    return searches, alive


FINE_SCHEMA = ("search int, feature int, score double, value double, route double, left_n double, "
               "left_s double")


def _look_inside(rows: Rows, routers: list, alive: dict, searches: list) -> None:
    """Add the best splits inside the ranges ``alive`` to the searches."""
    width, folds, cuts, mean = rows.width, len(rows.folds), rows.cuts, rows.mean
    fold_at, ranges = np.array(rows.folds), rows.ranges
    wanted = np.zeros((max(slot for slot, _, _ in alive) + 1) * width * ranges, bool)
    wanted[[(slot * width + f) * ranges + r for slot, f, r in alive]] = True
    using = {(slot * width + f) * ranges + r: v for (slot, f, r), v in alive.items()}

    def pick(batches):
        for x, y, fold, at in _unpacked(batches, cuts):
            fold = np.searchsorted(fold_at, fold)
            for base, tree, table in routers:
                slot = table[route(tree, x)]
                mine = np.flatnonzero((slot >= 0) & (slot < len(wanted) // (width * ranges)))
                for f in range(width) if len(mine) else ():
                    place = (slot[mine] * width + f) * ranges + at[mine, f]
                    met = wanted[place]
                    hit = mine[met]
                    if len(hit):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(place[met], pa.int64()), pa.array(x[hit, f]),
                             pa.array(fold[hit], pa.int32()),
                             pa.array(_target(base, mean, x[hit], y[hit]))],
                            names=["place", "value", "fold", "t"])

    def chunks(batches):
        """(place, values, folds, counts, sums) of a range, a batch at a time, values whole."""
        held = None
        for batch in batches:
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if held is not None:
                now = [np.concatenate(p) for p in zip(held, now)]
            if not len(now[0]):
                continue
            last = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
            end = int(last[-1]) + 1 if len(last) else 0
            held = [a[end:] for a in now]
            yield from _by_place([a[:end] for a in now])
        if held is not None:
            yield from _by_place(held)

    def read(batches):
        place, carry = None, None
        for at, value, fold, n, s in chunks(batches):
            if at != place:
                place, carry = at, np.zeros((2, folds))
            ends = np.flatnonzero(np.append(value[1:] != value[:-1], True))
            kinds = fold[:, None] == np.arange(folds)
            cn = np.cumsum(np.where(kinds, n[:, None], 0.0), axis=0)[ends] + carry[0]
            cs = np.cumsum(np.where(kinds, s[:, None], 0.0), axis=0)[ends] + carry[1]
            values = value[ends]
            before = np.vstack([carry[:1], cn[:-1]])
            out = []
            for search, left_out, n0, s0, total_n, total_s in using[at]:
                some = [k for k in range(folds) if k != left_out]
                left_n, left_s = n0 + cn[:, some].sum(1), s0 + cs[:, some].sum(1)
                own = (cn - before)[:, some].sum(1) > 0
                score = np.where(own & (left_n < total_n), _score(left_n, left_s, total_n, total_s), -np.inf)
                i = int(np.argmax(score >= score.max() - TIE * abs(score.max())))
                if np.isfinite(score[i]):
                    onward = np.flatnonzero(own[i + 1:])
                    until = i + 1 + int(onward[0]) if len(onward) else len(values)
                    out.append((search, (at // ranges) % width, score[i], values[i], values[until - 1],
                                left_n[i], left_s[i]))
            carry = np.stack([cn[-1], cs[-1]])
            if out:
                kinds = (pa.int32(), pa.int32(), *[pa.float64()] * 5)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                    names=["search", "feature", "score", "value", "route", "left_n", "left_s"])

    values = lambda picked: (picked.groupBy("place", "value", "fold")
                             .agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("t").alias("s"))
                             .repartition("place").sortWithinPartitions("place", "value")
                             .select("place", "value", "fold", "n", "s"))
    # a chunk's best is a row; only the best of a (search, feature) come to the driver
    best = rows.counted(pick, "place long, value double, fold int, t double", lambda picked: (
        values(picked).mapInArrow(read, FINE_SCHEMA).groupBy("search", "feature")
        .agg(F.max(F.struct("score", (-F.col("value")).alias("minus"), "route",
                             "left_n", "left_s")).alias("b")).select("search", "feature", "b.*").collect()))
    for r in best:
        searches[r["search"]].found.append((r["score"], r["feature"], -r["minus"], r["route"], None,
                                            r["left_n"], r["left_s"]))


def _by_place(columns: list):
    place = columns[0]
    edges = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.zeros(0, int)
    for a, b in zip(edges, np.append(edges[1:], len(place))):
        yield (int(place[a]), *(c[a:b] for c in columns[1:]))


# ---------------------------------------------------------------- growth
def _next_values(rows: Rows, edges: set) -> dict:
    """{(feature, value, fold left out): the next larger value of those training rows}."""
    cuts = rows.cuts
    groups: dict = {}
    for f, v, out in edges:
        groups.setdefault((f, out), []).append(v)
    groups = {k: np.unique(v) for k, v in groups.items()}

    def run(batches):
        nexts = {k: np.full(len(v), np.inf) for k, v in groups.items()}
        for x, _, fold, _ in _unpacked(batches, cuts):
            for (f, out), values in groups.items():
                v = x[fold != out, f] if out is not None else x[:, f]
                k = np.searchsorted(values, v, side="left")
                np.minimum.at(nexts[f, out], k[k > 0] - 1, v[k > 0])
        for i, (k, values) in enumerate(groups.items()):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), i), pa.int32()),
                                              pa.array(np.arange(len(values)), pa.int32()),
                                              pa.array(nexts[k])], names=["grp", "at", "v"])

    found = rows.counted(run, "grp int, at int, v double", lambda nexts: nexts.groupBy("grp", "at").agg(
        F.min("v").alias("v")).collect())
    table = {(r["grp"], r["at"]): r["v"] for r in found}
    out = {}
    for i, ((f, fold), values) in enumerate(groups.items()):
        nexts = np.array([table[i, k] for k in range(len(values))])
        nexts = np.minimum.accumulate(nexts[::-1])[::-1]  # of all larger values, the least
        out.update({(f, float(v), fold): float(x) for v, x in zip(values, nexts)})
    return out


def grow(rows: Rows, models: list[Model], exact: bool) -> None:
    """Grow every model's tree to its ``limit``: one counting pass a level for all of them."""
    present: dict = {}  # ranges that hold a model's training rows, in the whole table
    for m in models:
        m.tree.add(0.0, 0)
        m.paths = {0: ()}
    for level in range(max(m.limit for m in models)):
        for m in models:
            m.paths = m.paths if level < m.limit else {}
        searches = []
        for routers, users in _routings(rows, models):
            cells = _count_cells(rows, routers, len(users), exact)
            found, alive = _search_ranges(rows, cells, users, exact)
            if alive:
                _look_inside(rows, routers, alive, found)
            searches += found
            if not level:
                for slot, using in users.items():
                    for m, _ in using:
                        out = rows.folds.index(m.left_out) if m.left_out is not None else None
                        present[id(m)] = _of_model(cells, slot, out)["n"] > 0
        if not searches:
            break
        opened = {id(m): {} for m in models}
        for s in searches:
            m, centre = s.model, 0.0 if s.model.base else rows.mean
            if not level:
                m.tree.value[0] = centre + (s.s / s.n if s.n else 0.0)
            best = s.best()
            parent = s.s ** 2 / s.n if s.n else 0.0
            if best is None or best[0] - parent <= TIE * best[0]:
                continue
            score, f, value, by, r, n, part = best
            by = float(by) if exact else float(np.nextafter(rows.cuts[f][r], -np.inf))
            m.edges[s.node] = (f, float(value), r)
            children = m.tree.split(s.node, f, by, float((score - parent) / s.n), float(centre + part / n),
                                    float(centre + (s.s - part) / (s.n - n)))
            for side, child in enumerate(children):
                opened[id(m)][child] = m.paths[s.node] + ((f, by, side),)
        for m in models:
            m.paths = opened[id(m)]
    _place_thresholds(rows, models, present, exact)


def _place_thresholds(rows: Rows, models: list[Model], present: dict, exact: bool) -> None:
    """Move every threshold midway to the next value (or range) of the training rows."""
    if exact:
        wanted = {(f, float(v), m.left_out) for m in models for f, v, _ in m.edges.values()}
        nexts = _next_values(rows, wanted) if wanted else {}
    for m in models:
        for node, (f, value, r) in m.edges.items():
            if exact:
                onward = nexts[f, value, m.left_out]
                middle = (value + onward) / 2  # may round up to the next of two adjacent doubles
                m.tree.threshold[node] = middle if middle < onward else value
            else:
                onward = r + 1 + int(np.flatnonzero(present[id(m)][f, r + 1:])[0])
                m.tree.threshold[node] = float(np.nextafter(rows.cuts[f][(r + onward) // 2], -np.inf))


# ---------------------------------------------------------------- tuning
def _errors(rows: Rows, judged: dict) -> dict:
    """{key: (rows, squared error)} of ensembles, each on the rows of its fold."""
    cuts, items = rows.cuts, [(fold, [(w, t.arrays()) for w, t in parts])
                              for fold, parts in judged.values()]

    def run(batches):
        n, sse = np.zeros(len(items)), np.zeros(len(items))
        for x, y, fold, _ in _unpacked(batches, cuts):
            for i, (of, parts) in enumerate(items):
                mine = fold == of
                score = sum(w * a[4][route(a, x[mine])] for w, a in parts)
                n[i] += mine.sum()
                sse[i] += ((y[mine] - score) ** 2).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(items)), pa.int32()), pa.array(n),
                                          pa.array(sse)], names=["i", "n", "sse"])

    found = rows.counted(run, "i int, n double, sse double", lambda sums: sums.groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("sse").alias("sse")).collect())
    by = {r["i"]: (r["n"], r["sse"]) for r in found}
    return {k: by[i] for i, k in enumerate(judged)}


def tune(rows: Rows, candidates: list[dict], folds: list, *, exact: bool, boosted: bool,
         features: list[str]) -> tuple[list, list]:
    """(RMSE of each candidate and fold, refits): all folds, candidates and refits together.

    A candidate has maxDepth, minInfoGain, maxIter and stepSize; ``folds`` are left out in
    turn. Boosting adds trees on twice the residual, the first with weight 1.
    """
    outs = [*folds, None]
    missing = [f for f in folds if f not in rows.folds]
    if missing:
        raise ValueError(f"validation group {missing[0]!r} has no rows")
    if any(rows.folds == [f] for f in folds):
        raise ValueError("no training rows outside the validation group")
    so_far = {(c, out): [] for c in range(len(candidates)) for out in outs}
    for step in range(max(c["maxIter"] for c in candidates) if boosted else 1):
        models: dict = {}
        for (c, out), parts in so_far.items():
            if boosted and step >= candidates[c]["maxIter"]:
                continue
            key = (out, tuple((w, t.key()) for w, t in parts))
            m = models.setdefault(key, Model(out, 0, parts))
            m.limit = max(m.limit, candidates[c]["maxDepth"])
            so_far[c, out] = (m, parts)
        grow(rows, list(models.values()), exact)
        for (c, out), held in so_far.items():
            if isinstance(held, tuple):
                tree = held[0].tree.cut(candidates[c]["maxDepth"], candidates[c]["minInfoGain"])
                so_far[c, out] = [*held[1], (candidates[c]["stepSize"] if step else 1.0, tree)]
    judged = {}
    key = lambda c, out: (out, tuple((w, t.key()) for w, t in so_far[c, out]))
    for (c, out), parts in so_far.items():
        if out is not None:
            judged.setdefault(key(c, out), (out, parts))
    errors = _errors(rows, judged)
    rmse = [[float(np.sqrt(errors[key(c, out)][1] / errors[key(c, out)][0])) for out in folds]
            for c in range(len(candidates))]
    refits = [TreeEnsemble([t for _, t in so_far[c, None]], [w for w, _ in so_far[c, None]], list(features))
              for c in range(len(candidates))]
    return rmse, refits
