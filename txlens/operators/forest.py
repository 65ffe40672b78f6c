"""Isolation forest (Liu, Ting and Zhou, ICDM 2008) on Spark.

Every tree sees a bounded sample, so trees are grown in parallel, one small group each.
The forest is a table of nodes: node 0 is the root, the children of node i are 2i+1 and
2i+2. It never holds more than trees × 2 × sample rows, whatever the data size. Rows are
scored where they are, in Arrow batches of the feature columns only, without a shuffle.
"""

import hashlib
import sys
from math import ceil, gcd, log2, prod

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Window
from pyspark.sql import functions as F

from txlens.operators.ordering import smallest_by_hash
from txlens.params import FOREST_FEATURES, FOREST_SAMPLE, FOREST_SEED, FOREST_TREES
from txlens.staging import stage

# Tasks get the helpers below by value: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE_SCHEMA = "tree int, node int, depth int, feature int, threshold double, size int"
LEAF = -1
#: A tree of a larger grid is walked level by level.
GRID_CELLS = 1 << 20


def _row_hash(seed, *columns):
    text = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in columns]
    return F.md5(F.concat_ws("|", *text, F.lit(str(seed))))


def _number(*words):
    """A whole number below 16**13 from the words' hash, and its share of that range."""
    digits = hashlib.md5("|".join(map(str, words)).encode()).hexdigest()[:13]
    return int(digits, 16), int(digits, 16) / 16.0**13


def _walk(seed, tree, rows):
    """Start and step of a tree's walk over ``rows`` places; the step shares no factor with them."""
    start, step = (_number(seed, tree, word)[0] % rows for word in ("start", "step"))
    while gcd(step, rows) != 1:
        step += 1
    return start, step


def draw_samples(df, features=FOREST_FEATURES, key=("RowKey",), trees=FOREST_TREES,
                 sample=FOREST_SAMPLE, seed=FOREST_SEED):
    """(tree, _hash, features): ``sample`` rows for each tree, chosen by a hash of the row key.

    The rows with the smallest hashes form a pool of trees × sample rows, numbered once in the
    order of their hashes, which is a random order. Every tree walks over the pool with a start
    and a step of its own: as the step shares no factor with the pool's size, no place comes
    twice. So trees × sample rows are made, not a pool for every tree.
    """
    complete = df.dropna(subset=list(features))
    hashed = complete.select(*dict.fromkeys([*features, *key])).withColumn("_hash", _row_hash(seed, *key))
    pool = stage(smallest_by_hash(hashed, "_hash", trees * sample, *key))
    rows = pool.count()
    # the pool is bounded, so one task may number it
    numbered = pool.withColumn("_place", F.row_number().over(Window.orderBy("_hash", *key)) - 1)
    walks = df.sparkSession.createDataFrame(
        [(tree, *_walk(seed, tree, rows)) for tree in range(trees if rows else 0)],
        "tree int, start long, step long")
    visits = F.explode(F.sequence(F.lit(0), F.lit(min(sample, rows) - 1 if rows else 0)))
    places = walks.select("tree", "start", "step", visits.alias("visit")).select(
        "tree", ((F.col("start") + F.col("visit") * F.col("step")) % max(rows, 1)).cast("int").alias("_place"))
    return places.join(numbered, "_place").select("tree", "_hash", *features)


def _grow(values, seed, tree):
    """Nodes (node, depth, feature, threshold, size) of one random tree.

    Feature and threshold of a node follow from a hash of seed, tree and node alone.
    """
    limit = ceil(log2(max(len(values), 2)))
    nodes, todo = [], [(0, 0, values)]
    while todo:
        node, depth, part = todo.pop()
        spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(part) > 1 else []
        if depth >= limit or len(spread) == 0:
            nodes.append((node, depth, LEAF, 0.0, len(part)))
            continue
        feature = int(spread[_number(seed, tree, node, "feature")[0] % len(spread)])
        column = part[:, feature]
        low, high = float(column.min()), float(column.max())
        threshold = low + _number(seed, tree, node, "threshold")[1] * (high - low)
        if not low <= threshold < high:
            threshold = low
        nodes.append((node, depth, feature, threshold, len(part)))
        left = column <= threshold
        todo += [(2 * node + 1, depth + 1, part[left]), (2 * node + 2, depth + 1, part[~left])]
    return nodes


def fit_isolation_forest(df, features=FOREST_FEATURES, key=("RowKey",), trees=FOREST_TREES,
                         sample=FOREST_SAMPLE, seed=FOREST_SEED):
    """Node table of a forest grown on ``df``; the same rows always give the same forest."""
    columns = list(features)

    def grow(group):
        tree = int(group["tree"].iloc[0])
        nodes = _grow(group[columns].to_numpy(float), seed, tree)
        table = pd.DataFrame(nodes, columns=["node", "depth", "feature", "threshold", "size"])
        return table.assign(tree=tree)[
            ["tree", "node", "depth", "feature", "threshold", "size"]
        ]

    samples = draw_samples(df, features, key, trees, sample, seed)
    return samples.groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


def average_path(size):
    """Mean depth of a failed search in a binary tree of that many rows."""
    n = np.asarray(size, float)
    more = np.maximum(n, 3)
    path = 2 * (np.log(more - 1) + np.euler_gamma) - 2 * (more - 1) / more
    return np.where(n > 2, path, np.where(n == 2, 1.0, 0.0))


def _complete_trees(nodes):
    """Fill every tree up to the deepest level: (features, thresholds, leaf paths).

    Below a leaf everything goes left, so all rows walk the same number of levels.
    """
    levels = int(nodes["depth"].max())
    inner, leaves = 2**levels - 1, 2**levels
    ids = sorted(nodes["tree"].unique())
    features = np.zeros((len(ids), inner), np.int64)
    thresholds = np.full((len(ids), inner), np.inf)
    paths = np.zeros((len(ids), leaves))
    for place, tree in enumerate(ids):
        for row in nodes[nodes["tree"] == tree].itertuples():
            if row.feature != LEAF:
                features[place, row.node] = row.feature
                thresholds[place, row.node] = row.threshold
            else:
                bottom = (row.node + 1) * 2 ** (levels - row.depth) - 1 - inner
                paths[place, bottom] = row.depth + average_path(row.size)
    return levels, features, thresholds, paths


def _cuts(features, thresholds, column):
    """Sorted thresholds on one feature; the places that fill a tree up have none."""
    return np.unique(thresholds[(features == column) & (thresholds < np.inf)])


def _grid(levels, features, thresholds, width):
    """The bottom place of every cell that a tree's thresholds cut the features into; None for too many cells.

    A value has as its number on a feature the count of the tree's thresholds below it, so it
    exceeds threshold k where its number is more than k.
    """
    cuts = [_cuts(features, thresholds, column) for column in range(width)]
    shape = [len(c) + 1 for c in cuts]
    if prod(shape) > GRID_CELLS:
        return None
    place = np.full(len(features), max(shape))
    for column, c in enumerate(cuts):
        held = (features == column) & (thresholds < np.inf)
        place[held] = np.searchsorted(c, thresholds[held])
    numbers = np.indices(shape).reshape(width, -1)
    cell, node = np.arange(numbers.shape[1]), np.zeros(numbers.shape[1], np.int64)
    for _ in range(levels):
        node = 2 * node + 1 + (numbers[features[node], cell] > place[node])
    return (node - (2**levels - 1)).astype(np.min_scalar_type(2**levels - 1))


def _steps(features, thresholds, cuts):
    """For each feature: what a value adds to the number of its cell, by its place among all ``cuts``."""
    own = [_cuts(features, thresholds, column) for column in range(len(cuts))]
    stride = np.cumprod([1, *[len(c) + 1 for c in own[:0:-1]]])[::-1]
    return [(np.concatenate([[0], np.searchsorted(o, c, side="right")]) * by).astype(np.int32)
            for o, c, by in zip(own, cuts, stride)]


def score_isolation_forest(df, forest, features=FOREST_FEATURES, name="score"):
    """Add the anomaly score in (−1, 0): the lower, the easier a row is to isolate.

    A value is looked up once among the thresholds of all trees. From there its place among the
    thresholds of one tree is known, and the places of all features name a cell of the tree's
    grid, which holds the leaf: two lookups a tree and one a feature, instead of a walk.
    """
    nodes = forest.toPandas()
    sample = int(nodes.loc[nodes["node"] == 0, "size"].max())
    scale = float(average_path(sample)) or 1.0
    levels, split_on, split_at, paths = _complete_trees(nodes)
    trees, width = len(paths), len(list(features))
    cuts = [_cuts(split_on, split_at, column) for column in range(width)]
    grids = [_grid(levels, split_on[tree], split_at[tree], width) for tree in range(trees)]
    steps = [None if grids[tree] is None else _steps(split_on[tree], split_at[tree], cuts) for tree in range(trees)]

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        rows = np.column_stack([column.to_numpy(float) for column in columns])
        flat, start = rows.ravel(), np.arange(len(rows)) * width
        at = [np.searchsorted(c, rows[:, column]) for column, c in enumerate(cuts)]
        total = np.zeros(len(rows))
        for tree in range(trees):
            if grids[tree] is not None:
                cell = sum(step.take(place) for step, place in zip(steps[tree], at))
                total += paths[tree].take(grids[tree].take(cell))
                continue
            node = np.zeros(len(rows), np.int64)
            for _ in range(levels):
                value = flat.take(start + split_on[tree].take(node))
                node = 2 * node + 1 + (value > split_at[tree].take(node))
            total += paths[tree].take(node - (2**levels - 1))
        return pd.Series(-np.exp2(-(total / trees) / scale))

    complete = df.dropna(subset=list(features))
    return complete.withColumn(name, score(*[F.col(f).cast("double") for f in features]))
