"""Boosted regression trees on absolute error, many fits at once: one task a fit.

A search asks for hundreds of fits, each a long chain of small steps. Chained as Spark jobs, each step
would cost a scheduling round; so Spark deals the *fits* to tasks instead. Every fit learns from all
rows: they are binned by a map, written as blocks of about 40 bytes a row, and every task reads all
blocks through Spark, so that the driver holds cut values and trees only. A task grows its trees on
these rows and ends as soon as ``patience`` trees brought nothing on the early-stopping rows. Cut
values come from one aggregation over the rows. What a fit returns, a few arrays, scores any number of
rows as a map.

Leaves hold the median residual of their rows, and splits maximise the gain of the error's signs:
``G**2 / (n + l2)`` with ``G`` shrunk by ``l1``, less ``min_gain``.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Settings:
    learning_rate: float = 0.03
    max_depth: int = 4
    subsample: float = 0.8
    colsample: float = 0.8
    min_child: int = 5
    l2: float = 1.0
    l1: float = 0.0
    min_gain: float = 0.0


@dataclass(frozen=True)
class Trees:
    """Kept trees end to end: node k sends rows with ``x[feature] <= cut`` to ``left``, others to
    ``left + 1``; a leaf has feature -1. ``roots`` holds the first node of each tree."""

    base: float
    roots: list[int]
    feature: list[int]
    cut: list[float]
    left: list[int]
    value: list[float]
    gain: list[float]

    @property
    def n_trees(self) -> int:
        return len(self.roots)

    def score(self, x: np.ndarray) -> np.ndarray:
        feature, left = np.array(self.feature, dtype=np.int64), np.array(self.left, dtype=np.int64)
        cut, value = np.array(self.cut), np.array(self.value)
        x = np.ascontiguousarray(x)
        total, flat, first = np.full(len(x), self.base), x.ravel(), np.arange(len(x)) * x.shape[1]
        for root in self.roots:
            leaf, todo, node = np.full(len(x), root), np.arange(len(x)), np.full(len(x), root)
            while len(todo):
                split = feature[node]
                inner = split >= 0
                if not inner.all():
                    leaf[todo[~inner]] = node[~inner]
                    todo, node, split = todo[inner], node[inner], split[inner]
                node = left[node] + (flat[first[todo] + split] > cut[node])
            total += value[leaf]
        return total

    def importance(self, n_features: int) -> np.ndarray:
        """Mean gain of a feature's splits, as shares of one."""
        feature, gain = np.array(self.feature, dtype=np.int64), np.array(self.gain)
        split = feature >= 0
        sums = np.bincount(feature[split], gain[split], n_features)
        mean = sums / np.maximum(np.bincount(feature[split], minlength=n_features), 1)
        return mean / mean.sum() if mean.sum() > 0 else mean


# Fold of a row without one: no fit leaves it out, -1 included.
NO_FOLD = -2


@dataclass(frozen=True)
class Binned:
    """Rows in memory: bins (row x feature), target, the flags fits choose rows by, cut values."""

    bins: np.ndarray
    target: np.ndarray
    fold: np.ndarray
    flags: dict[str, np.ndarray]
    cuts: list[np.ndarray]

    def stored(self, spark: SparkSession) -> Rows:
        keys = np.arange(len(self.target))
        blocks = _blocks(self.bins, self.target, self.fold, list(self.flags.values()), keys)
        frame = spark.createDataFrame([(b,) for b in blocks], "block binary")
        return Rows(frame, list(self.flags), self.cuts)


@dataclass(frozen=True)
class Rows:
    """All rows of a table as blocks of packed records, a frame of one column, and the cut values."""

    frame: DataFrame
    flags: list[str]
    cuts: list[np.ndarray]

    def stored(self, spark: SparkSession) -> Rows:
        return self

    def collected(self) -> Binned:
        """In this process's memory, for tables known to be small."""
        return _unpacked([r["block"] for r in self.frame.collect()], self.flags, self.cuts)


BLOCK_ROWS = 128  # rows of a block; 10,000 blocks make one Arrow batch


def _record(n_features: int, n_flags: int) -> np.dtype:
    return np.dtype([
        ("key", "<i8"), ("target", "<f8"), ("fold", "<i4"), ("bins", "u1", (n_features,)),
        ("flags", "?", (n_flags,)),
    ])


def _blocks(bins, target, fold, flags, keys) -> list[bytes]:
    records = np.empty(len(target), dtype=_record(bins.shape[1], len(flags)))
    records["key"], records["target"], records["fold"], records["bins"] = keys, target, fold, bins
    for k, flag in enumerate(flags):
        records["flags"][:, k] = flag
    return [records[k:k + BLOCK_ROWS].tobytes() for k in range(0, len(records), BLOCK_ROWS)]


def _unpacked(blocks: list[bytes], flags: list[str], cuts: list[np.ndarray]) -> Binned:
    """The rows of all blocks by key, so that their order does not depend on that of the blocks."""
    records = np.frombuffer(b"".join(blocks), dtype=_record(len(cuts), len(flags)))
    keys, bins = records["key"], records["bins"]
    order = np.argsort(keys, kind="stable")
    if (np.diff(keys.take(order)) == 0).any():
        order = np.lexsort((*bins.T, *records["flags"].T, records["fold"], records["target"], keys))
    return Binned(
        bins.take(order, axis=0), records["target"].take(order), records["fold"].take(order),
        {f: records["flags"][:, k].take(order) for k, f in enumerate(flags)}, cuts,
    )


def number(column: str) -> Column:
    return F.coalesce(F.col(column).cast("double"), F.lit(0.0))


def sampled(table: DataFrame, key: str, limit: int) -> DataFrame:
    """About ``limit`` rows chosen by the hash of their key; all rows of a table that has no more. For
    a look at a table: no fit, cut value or figure of a model comes from it."""
    n = table.count()
    if n <= limit:
        return table
    share = int(limit / n * (1 << 32))
    return table.filter(F.pmod(F.xxhash64(key), F.lit(1 << 32)) < share)


def binned(
    table: DataFrame, features: list[str], target: str, flags: list[str], max_bins: int
) -> Rows:
    """Bin all rows of a table by quantiles of each feature, as a map; the cut values reach the driver."""
    grid = [k / max_bins for k in range(1, max_bins)]
    found = table.agg(*(
        F.percentile_approx(number(f), grid, 100 * max_bins).alias(f) for f in features
    )).first()
    cuts = [np.unique(np.array(found[f] or [], dtype=np.float64)) for f in features]
    numbers = table.select(
        F.coalesce(F.col("household_key").cast("long"), F.lit((1 << 63) - 1)).alias("key"),
        F.array(*(number(f) for f in features)).alias("x"), number(target).alias("target"),
        F.coalesce(F.col("fold").cast("int"), F.lit(NO_FOLD)).alias("fold"),
        *(F.coalesce(F.col(f).cast("boolean"), F.lit(False)).alias(f"_{f}") for f in flags),
    )

    def work(batches):
        for batch in batches:
            key, x, wanted, fold, *chosen = batch.columns
            x = x.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            bins = np.stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)], axis=1)
            blocks = _blocks(
                bins.astype(np.uint8), wanted.to_numpy(zero_copy_only=False),
                fold.to_numpy(zero_copy_only=False),
                [f.to_numpy(zero_copy_only=False) for f in chosen], key.to_numpy(zero_copy_only=False),
            )
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], ["block"])

    return Rows(numbers.mapInArrow(work, "block binary"), flags, cuts)


# A histogram holds rows and signs in one sum: ``rows * BOTH + signs``, exact for fewer than 2**26 rows.
BOTH = float(1 << 27)


def _histograms(lines, weights, width: int, groups) -> np.ndarray:
    """Sums of the ``weights`` by bin for every group of members and every line: group x line x bin.

    The sums are whole numbers, so it does not matter how they are added: a group of many members counts
    two lines in one pass over the bins of both, the members of the smaller ones go through together.
    """
    found = np.empty((len(groups), len(lines), width))
    pairs = width * width
    small = [g for g, members in enumerate(groups) if len(members) < 4 * pairs]
    for g, members in enumerate(groups):
        if len(members) < 4 * pairs:
            continue
        own = weights.take(members)
        for k in range(0, len(lines) - 1, 2):
            cells = lines[k].take(members).astype(np.uint16 if pairs < 1 << 16 else np.intp)
            cells *= width
            cells += lines[k + 1].take(members)
            table = np.bincount(cells, own, pairs).reshape(width, width)
            found[g, k], found[g, k + 1] = table.sum(axis=1), table.sum(axis=0)
        if len(lines) % 2:
            found[g, -1] = np.bincount(lines[-1].take(members), own, width)
    if small:
        members = np.concatenate([groups[g] for g in small])
        own, n = weights.take(members), len(small)
        base = np.repeat(np.arange(n) * width, [len(groups[g]) for g in small])
        for k, line in enumerate(lines):
            found[small, k] = np.bincount(base + line.take(members), own, n * width).reshape(n, width)
    return found


def _grow(bins, picked, sign, rows, columns, s: Settings, width: int):
    """One tree by levels: (feature, cut bin, left child, gain) per node, and the leaf of every row.

    ``picked`` holds the bins of the ``rows`` that grow the tree, a line per column of ``columns``, and
    ``sign`` the signs of their errors. Only the smaller child of a split is counted; the other one is
    its parent less it. ``bins`` are read by column: rows may lie in any order of memory, columns that
    are contiguous are faster.
    """
    feature, at, left, gain = [-1], [0], [0], [0.0]
    place = np.zeros(len(bins), dtype=np.intp)
    both, least = BOTH + sign, max(s.min_child, 1)
    # Per open node: which of the ``rows`` it has, by their number there, and which of the others.
    rest = np.ones(len(bins), dtype=bool)
    rest[rows] = False
    inside, others = [np.arange(len(rows))], [np.flatnonzero(rest)]
    begin = 0

    def worth(total, n):
        shrunk = np.abs(total)
        shrunk -= s.l1
        np.maximum(shrunk, 0.0, out=shrunk)
        shrunk *= shrunk
        shrunk /= n + s.l2
        return shrunk

    def put(node, members, more):
        place[rows.take(members)] = node
        place[more] = node

    open_nodes = _histograms(picked, both, width, inside)
    for depth in range(s.max_depth):
        n_open = len(feature) - begin
        signs = open_nodes.cumsum(axis=2)
        counts = signs / BOTH
        counts += 0.5
        np.floor(counts, out=counts)
        signs -= counts * BOTH
        n_all, g_all = counts[:, :1, -1:], signs[:, :1, -1:]
        beside = n_all - counts
        with np.errstate(divide="ignore", invalid="ignore"):
            better = worth(signs, counts)
            better += worth(g_all - signs, beside)
            better -= worth(g_all, n_all)
        better[(counts < least) | (beside < least)] = -np.inf
        better = better.reshape(n_open, -1)
        best = better.argmax(axis=1)
        won = better[np.arange(n_open), best]
        split = won > max(s.min_gain, 1e-6)
        if not split.any():
            break
        last, next_begin, next_inside, next_others = depth + 1 == s.max_depth, len(feature), [], []
        for k, (flat_cut, worth_it, splits) in enumerate(zip(best.tolist(), won.tolist(), split.tolist())):
            node, members, more = begin + k, inside[k], others[k]
            if not splits:
                put(node, members, more)
                continue
            line, cut_bin = divmod(flat_cut, width)
            column, child = int(columns[line]), len(feature)
            feature[node], at[node], left[node], gain[node] = column, cut_bin, child, worth_it
            feature += [-1, -1]
            at += [0, 0]
            left += [0, 0]
            gain += [0.0, 0.0]
            right, right_more = picked[line].take(members) > cut_bin, bins[:, column].take(more) > cut_bin
            if last:
                place[rows.take(members)] = child + right
                place[more] = child + right_more
            else:
                # Numbers taken by place are faster than rows picked by a mask, whose bits no CPU foresees.
                next_inside += [members.take(side.nonzero()[0]) for side in (~right, right)]
                next_others += [more.take(side.nonzero()[0]) for side in (~right_more, right_more)]
        begin = next_begin
        if last:
            return feature, at, left, gain, place
        inside, others = next_inside, next_others
        right_is_small = [len(inside[k + 1]) < len(inside[k]) for k in range(0, len(inside), 2)]
        small = _histograms(
            picked, both, width, [inside[2 * k + r] for k, r in enumerate(right_is_small)]
        )
        large = open_nodes[split] - small
        swap = np.array(right_is_small)[:, None, None]
        open_nodes = np.stack(
            [np.where(swap, large, small), np.where(swap, small, large)], axis=1
        ).reshape(len(inside), len(columns), width)
    for k, (members, more) in enumerate(zip(inside, others)):
        put(begin + k, members, more)
    return feature, at, left, gain, place


def _leaf_medians(residual, place, n_nodes: int) -> np.ndarray:
    """Median residual per node; 0 where there is none."""
    # Short integers are sorted by radix.
    order = np.argsort(place.astype(np.min_scalar_type(n_nodes)), kind="stable")
    residual = residual.take(order)
    ends = np.cumsum(np.bincount(place, minlength=n_nodes)).tolist()
    out, start = np.zeros(n_nodes), 0
    for node, end in enumerate(ends):
        if end > start:
            half = (end - start) // 2
            ordered = np.partition(residual[start:end], half)
            low = ordered[half] if (end - start) % 2 else ordered[:half].max()
            out[node] = (low + ordered[half]) / 2
        start = end
    return out


def boost(
    data: Binned, train: np.ndarray, early: np.ndarray | None, s: Settings, max_trees: int,
    patience: int, seed: int,
) -> tuple[Trees, int]:
    """(kept trees, trees grown) on the ``train`` rows; with ``early`` rows, those that are best on them."""
    draw = np.random.default_rng(seed)
    at = np.flatnonzero(train if early is None else train | early)
    target, n_features = data.target[at], data.bins.shape[1]
    by_column = np.stack([data.bins[:, c].take(at) for c in range(n_features)])
    bins = by_column.T
    learn = np.flatnonzero(train[at])
    watch = np.array([], dtype=int) if early is None else np.flatnonzero(early[at])
    width = max((len(c) for c in data.cuts), default=0) + 1
    base = float(np.median(target[learn])) if len(learn) else 0.0
    score, grown = np.full(len(at), base), []
    best, best_loss = 0, np.inf
    for k in range(max_trees):
        rows = learn.take((draw.random(len(learn)) < s.subsample).nonzero()[0])
        n_columns = max(1, int(s.colsample * n_features))
        columns = np.sort(draw.choice(n_features, n_columns, replace=False))
        if not len(rows):
            rows = learn
        if not len(rows):
            break
        residual = target.take(rows) - score.take(rows)
        picked = [by_column[c].take(rows) for c in columns]
        feature, cut, left, gain, place = _grow(
            bins, picked, np.sign(residual), rows, columns, s, width
        )
        value = s.learning_rate * _leaf_medians(residual, place.take(rows), len(feature))
        score += value.take(place)
        grown.append((feature, cut, left, value, gain))
        if not len(watch):
            best = k + 1
            continue
        loss = float(np.abs(target.take(watch) - score.take(watch)).mean())
        if loss < best_loss:
            best, best_loss = k + 1, loss
        elif k + 1 - best >= patience:
            break
    return _joined(base, grown[:best], data.cuts), len(grown)


def _joined(base: float, grown: list, cuts: list[np.ndarray]) -> Trees:
    trees = Trees(base, [], [], [], [], [], [])
    for feature, at, left, value, gain in grown:
        first = len(trees.feature)
        trees.roots.append(first)
        trees.feature.extend(feature)
        trees.cut.extend(float(cuts[f][a]) if f >= 0 else 0.0 for f, a in zip(feature, at))
        trees.left.extend(first + x for x in left)
        trees.value.extend(map(float, value))
        trees.gain.extend(gain)
    return trees


@dataclass(frozen=True)
class Fit:
    """One fit to make: which rows it learns from is decided by fold, hold-out and early flags.

    ``fold`` -1 leaves no fold out; ``without`` and ``early`` name flags, '' for none.
    """

    number: int
    fold: int
    settings: Settings
    without: str = ""
    early: str = ""
    max_trees: int = 1000
    patience: int = 50
    seed: int = 42

    def rows(self, data: Binned) -> tuple[np.ndarray, np.ndarray | None]:
        seen = data.fold != self.fold
        if self.without:
            seen = seen & ~data.flags[self.without]
        if not self.early:
            return seen, None
        return seen & ~data.flags[self.early], seen & data.flags[self.early]


TREE_COLUMNS = "base double, roots array<int>, feature array<int>, cut array<double>," \
    " left array<int>, value array<double>, gain array<double>"
FIT_COLUMNS = f"number int, fold int, grown int, mae double, {TREE_COLUMNS}"


def run_fits(
    spark: SparkSession, data: Rows | Binned, fits: list[Fit], keep_trees: bool
) -> DataFrame:
    """A row per fit: error on all rows of its fold (null without a fold) and its trees."""
    # Exactly one fit a task, those of many small steps and deep trees first.
    fits = sorted(fits, key=lambda f: f.settings.learning_rate / f.settings.max_depth)
    rows = data.stored(spark)
    flags, cuts = rows.flags, rows.cuts
    ints, doubles = pa.list_(pa.int32()), pa.list_(pa.float64())
    schema = pa.schema([
        ("number", pa.int32()), ("fold", pa.int32()), ("grown", pa.int32()), ("mae", pa.float64()),
        ("base", pa.float64()), ("roots", ints), ("feature", ints), ("cut", doubles), ("left", ints),
        ("value", doubles), ("gain", doubles),
    ])

    def work(batches):
        numbers, blocks = set(), []
        for batch in batches:
            numbers.update(batch.column("id").unique().to_pylist())
            blocks += batch.column("block").to_pylist()
        if not numbers:
            return
        known = _unpacked(blocks, flags, cuts)
        del blocks
        for fit in (fits[k] for k in sorted(numbers)):
            trees, grown = boost(
                known, *fit.rows(known), fit.settings, fit.max_trees, fit.patience, fit.seed
            )
            test = known.fold == fit.fold
            mae = None
            if test.any():
                mae = float(np.abs(
                    trees.score(_representatives(known, test)) - known.target[test]
                ).mean())
            kept = asdict(trees) if keep_trees else {
                **{f.name: [] for f in fields(Trees)}, "base": trees.base, "roots": trees.roots,
            }
            row = {"number": fit.number, "fold": fit.fold, "grown": grown, "mae": mae, **kept}
            yield pa.RecordBatch.from_pylist([row], schema)

    # All blocks to every fit, by reading them in its task: neither an exchange nor the driver in between.
    # The empty block is there for a table without rows, whose fits still answer.
    none = spark.createDataFrame([(b"",)], "block binary")
    blocks = rows.frame.unionAll(none).coalesce(1).hint("shuffle_replicate_nl")
    return spark.range(0, len(fits), 1, len(fits)).crossJoin(blocks).mapInArrow(work, FIT_COLUMNS)


def _representatives(data: Binned, rows: np.ndarray) -> np.ndarray:
    """Feature values that fall on the same side of every cut as the rows' own."""
    out = np.empty((int(rows.sum()), len(data.cuts)))
    for f, cuts in enumerate(data.cuts):
        out[:, f] = np.append(cuts, np.inf)[data.bins[rows, f]]
    return out


def trees_of(row) -> Trees:
    return Trees(row["base"], *(list(row[f.name]) for f in fields(Trees)[1:]))


def score(
    table: DataFrame, features: list[str], trees: dict[int, Trees], fold: str | None, name: str
) -> DataFrame:
    """``table`` with the prediction of the trees of its fold, or of the only ones there are."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    width = len(table.columns)
    numbers = table.select(
        "*", F.array(*(number(f) for f in features)).alias("_x"),
        (F.col(fold) if fold else F.lit(0)).cast("int").alias("_fold"),
    )

    def work(batches):
        for batch in batches:
            x = batch.column(width).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            folds = batch.column(width + 1).to_numpy(zero_copy_only=False)
            out = np.zeros(len(batch))
            for k, found in trees.items():
                at = np.flatnonzero(folds == k)
                out[at] = found.score(x[at])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], pa.array(out)], [*batch.schema.names[:width], name]
            )

    return numbers.mapInArrow(work, f"{schema}, {name} double")
