"""Boosted trees and deep forests on weighted cells.

All features of the incident models are discrete, so rows fall into cells: the
distinct feature values with their row and positive counts per fold. Spark
compresses the rows to cells in one aggregation (map-side combined) and sends
them, as codes, to as many tasks as there are (setting, fold) fits; a fit sees
each cell once, with its count as weight, which leaves the objective, the split
gains and the leaf values those of the rows. Trees grow a level at a time from
histograms of the cells: no depth limit, a least size of a split and of a leaf.
A cross-validated fit holds one tree at a time.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.session import importable, materialize

#: A fit holds all cells; beyond this many, trees are fitted on the rows by Spark ML.
MAX_CELLS = 2_000_000
#: Most joint bins of two features that are counted together.
BLOCK_BINS = 512
#: So many nodes have their splits weighed at a time.
NODES_AT_ONCE = 2048
#: Most sums (of 8 bytes) that a level's histograms hold.
MOST_SUMS = 4_000_000

_SCORES = "params string, _fold int, tp long, pp long, fit_time double, score_time double"
_TREES = "tree int, feature array<int>, bound array<double>, child array<int>, value array<double>"


# ---- cells ---------------------------------------------------------------------------
def feature_cells(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str = "target",
                  fold: str | None = None, folds: int = 1) -> DataFrame:
    """(features..., n, pos): rows and positive rows of each distinct feature
    combination, as arrays with an entry per fold. Written once to the shared
    folder. Null features are values of their own."""
    here = (lambda k: F.col(fold) == k) if fold else (lambda k: F.lit(True))
    counts = [F.count_if(here(k)).alias(f"n{k}") for k in range(folds)]
    positives = [F.count_if(here(k) & (F.col(label) == 1)).alias(f"p{k}") for k in range(folds)]
    features = [F.col(c).cast("string").alias(c) for c in categorical] + [F.col(c).cast("double").alias(c) for c in numeric]
    rows = df.select(*features, label, *([fold] if fold else []))
    cells = rows.groupBy(*categorical, *numeric).agg(*counts, *positives)
    return materialize(cells.select(*categorical, *numeric, F.array(*[f"n{k}" for k in range(folds)]).alias("n"),
                                    F.array(*[f"p{k}" for k in range(folds)]).alias("pos")), "cells")


class Design:
    """The cells of one fit: a code per feature and cell, sorted so that a fit
    doesn't depend on the order in which cells arrive."""

    def __init__(self, table: pa.Table, categorical: Sequence[str], numeric: Sequence[str]):
        names = [*categorical, *numeric]
        self.is_level = np.array([c in set(categorical) for c in names])
        self.values, codes, order = [], [], []
        for c in names:
            column = table[c] if pa.types.is_dictionary(table[c].type) else table[c].dictionary_encode()
            column = column.unify_dictionaries().combine_chunks()
            table = table.set_column(table.column_names.index(c), c, column)
            known = column.dictionary
            values = sorted(v for v in known.to_pylist() if v is not None and v == v)
            code = pc.index_in(known, pa.array(values, known.type)).fill_null(len(values))
            code = np.append(code.to_numpy(zero_copy_only=False), len(values)).astype(np.min_scalar_type(len(values) + 1))
            self.values.append(values)
            codes.append(code[column.indices.fill_null(len(known)).to_numpy(zero_copy_only=False)])     # a null is past all values
            order.append(codes[-1] + column.is_null().to_numpy(zero_copy_only=False))
        if names:
            sort = np.lexsort(order[::-1])
            table, codes = table.take(pa.array(sort)), [c[sort] for c in codes]
        self.table = table
        self.codes = np.array(codes).reshape(len(names), table.num_rows)
        # the splits: a level of a feature against the others, or a threshold of a number
        sizes = [len(v) for v in self.values]
        self.split_at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)     # the first split of each feature
        self.split_feature = np.repeat(np.arange(len(sizes)), sizes)
        self.split_value = np.concatenate([np.arange(n) for n in sizes] or [np.zeros(0)]).astype(np.int64)
        first_of_column = self.is_level[self.split_feature] | (self.split_value == 0)
        self.column = np.cumsum(first_of_column) - 1         # a level or a whole number feature
        self.column_at = np.flatnonzero(first_of_column)
        # the bins: the values of each feature and its nulls
        self.widths = [n + 1 for n in sizes]
        self.bin_at = np.concatenate([[0], np.cumsum(self.widths)]).astype(np.int64)
        self.blocks = self._blocks()

    def _blocks(self) -> list[tuple[list[int], int, np.ndarray]]:
        """Features counted together, a large one with a small one: their numbers,
        their joint bins and the joint code of each cell."""
        by_size, out = sorted(range(len(self.widths)), key=lambda f: self.widths[f]), []
        while by_size:
            own = [by_size.pop()]
            if by_size and self.widths[own[0]] * self.widths[by_size[0]] <= BLOCK_BINS:
                own.append(by_size.pop(0))
            bins, code = 1, np.zeros(self.codes.shape[1], np.uint32)
            for f in own:
                bins, code = bins * self.widths[f], code * self.widths[f] + self.codes[f]
            out.append((own, bins, code))
        return out

    def histogram(self, at: np.ndarray, cell: np.ndarray, x: np.ndarray, nodes: int) -> np.ndarray:
        """Per node the sums of x over each bin; row i is cell ``cell[i]`` in node ``at[i]``."""
        out = np.empty((nodes, self.bin_at[-1]))
        joint = nodes * sum(bins for _, bins, _ in self.blocks) <= len(cell)
        for own, bins, code in self.blocks if joint else [([f], w, self.codes[f]) for f, w in enumerate(self.widths)]:
            index = at * bins
            index += code.take(cell)
            sums = np.bincount(index, x, nodes * bins)
            sums = sums.reshape(nodes, *[self.widths[f] for f in own])
            for i, f in enumerate(own):
                out[:, self.bin_at[f]:self.bin_at[f + 1]] = sums if len(own) == 1 else sums.sum(2 - i)
        return out

    def right_of_splits(self, h: np.ndarray) -> np.ndarray:
        """Per node and split the sum of the cells that go right."""
        out = np.empty((len(h), self.split_at[-1]))
        for f in range(len(self.widths)):
            own, to = h[:, self.bin_at[f]:self.bin_at[f + 1]], out[:, self.split_at[f]:self.split_at[f + 1]]
            to[:] = own[:, :-1] if self.is_level[f] else own.sum(1)[:, None] - np.cumsum(own, 1)[:, :-1]
        return out

    def counts(self, column: str) -> np.ndarray:
        lists = self.table[column].combine_chunks()
        return lists.flatten().to_numpy().reshape(len(lists), -1).astype(np.float64)


@dataclass
class Tree:
    """Nodes as arrays: feature -1 is a leaf; a cell goes to ``child`` or, if its
    code equals ``bound`` (levels) or is above it (numbers), to ``child`` + 1."""
    feature: np.ndarray
    bound: np.ndarray
    child: np.ndarray
    value: np.ndarray | None = None


def _goes_right(is_level: np.ndarray, feature: np.ndarray, x: np.ndarray, bound: np.ndarray) -> np.ndarray:
    return np.where(is_level[feature], x == bound, x > bound)


def grow(design: Design, weight: np.ndarray, total: np.ndarray, square: np.ndarray, max_depth: int, min_split: int = 2,
         min_leaf: int = 1, columns: int | None = None, rng: np.random.Generator | None = None) -> tuple[Tree, np.ndarray]:
    """One tree that lowers the squared error of a target most (for 0/1 targets:
    the Gini impurity), and the leaf of each cell.

    Per cell: ``weight`` rows (whole numbers), the sums ``total`` of their targets and
    ``square`` of the squares. Cells without weight are carried to their leaves.
    A categorical level against all others or a threshold of a number is a split;
    both sides need ``min_leaf`` rows. ``columns``: so many non-constant columns (a
    level or a number is one) are drawn anew for every node."""
    leaf = np.zeros(design.codes.shape[1], np.int64)
    if not len(design.column):
        return Tree(np.array([-1]), np.array([0]), np.array([0])), leaf     # no feature has a value
    feature, bound, child = np.array([-1]), np.array([0]), np.array([0])
    sums = _Sums(weight, total)
    least = max(min_leaf, 1)
    # the open cells, those of a node side by side and in order: the first count[0] are in node live[0]
    cell, count, live = np.arange(len(leaf)), np.array([len(leaf)]), np.array([0])
    kept, depth, w, s = None, 0, weight.sum(keepdims=True), total.sum(keepdims=True)
    while len(live) and depth < max_depth:
        begin = np.cumsum(count) - count                    # no node is without cells
        s = s if sums.base else np.add.reduceat(total[cell], begin)
        q = s if square is total else np.add.reduceat(square[cell], begin)
        open_ = (w >= min_split) & (q - s * s / np.maximum(w, 1) > 1e-14 * np.maximum(w, 1))
        fits = open_ & (w >= 2 * least)                     # smaller nodes have no split with two such sides
        if not fits.any():
            break
        draws = None
        if columns is not None:                             # drawn in the order of the nodes' numbers
            draws = rng.random((int(open_.sum()), len(design.column_at)))
            draws = draws[np.argsort(np.argsort(live[open_]))[fits[open_]]]
        kept = sums.children(design, *kept, cell, count, fits) if kept is not None and sums.keeps(design, int(fits.sum())) else None
        stays = np.flatnonzero(fits)
        if kept is None:
            cell, count = _close(leaf, cell, count, live, fits)
            live, stays = live[fits], np.arange(len(stays))
        w, s = w[fits], s[fits]
        best, rw, rs = np.full(len(w), -1), np.empty(len(w)), np.empty(len(w))
        full = kept if kept is not None else sums.room(design, len(w))
        begin = np.concatenate([[0], np.cumsum(count)])
        at_once = max(1, min(NODES_AT_ONCE, MOST_SUMS // design.bin_at[-1]))
        for lo in range(0, len(w), at_once):
            part = slice(lo, min(lo + at_once, len(w)))
            if kept is not None:
                h = kept[part]
            else:
                at = np.repeat(np.arange(part.stop - lo), count[part])
                h = sums.histogram(design, at, cell[begin[lo]:begin[part.stop]], part.stop - lo)
                if full is not None:
                    full[part] = h
            best[part], rw[part], rs[part] = _best_splits(design, sums, h, w[part], s[part], least, columns, draws[part] if draws is not None else None)
        split = best >= 0
        if not split.any():
            break
        on = np.zeros(len(live), bool)
        on[stays[split]] = True
        cell, count = _close(leaf, cell, count, live, on)
        kept = (full, np.flatnonzero(split)) if full is not None else None
        live, best, w, s, rw, rs = (live[on], *(x[split] for x in (best, w, s, rw, rs)))
        w, s = np.concatenate([w - rw, rw]), np.concatenate([s - rs, rs])
        first = len(feature) + 2 * np.argsort(np.argsort(live))
        feature[live], bound[live], child[live] = design.split_feature[best], design.split_value[best], first
        feature, bound, child = (np.concatenate([x, np.full(2 * len(live), v)]) for x, v in ((feature, -1), (bound, 0), (child, 0)))
        right = _right_cells(design, feature[live], bound[live], cell, count)
        rights = np.add.reduceat(right, np.cumsum(count) - count, dtype=np.int64)
        cell, count = _sides(cell, right, int(rights.sum())), np.concatenate([count - rights, rights])
        live = np.concatenate([first, first + 1])
        depth += 1
    leaf[cell] = np.repeat(live, count)
    return Tree(feature, bound, child), leaf


def _right_cells(design: Design, feature: np.ndarray, bound: np.ndarray, cell: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Whether each cell goes right at its node."""
    at = np.repeat(feature * design.codes.shape[1], count)
    at += cell
    code = design.codes.ravel().take(at)
    # a level's right side is one code, a threshold's is all codes above it
    level = design.is_level[feature]
    low = bound + ~level
    span = np.where(level, bound, np.array(design.widths)[feature]) - low
    code -= np.repeat(low.astype(code.dtype), count)        # codes below wrap around
    return code <= np.repeat(span.astype(code.dtype), count)


def _sides(cell: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """The cells that go left and then the n that go right."""
    out = np.empty_like(cell)
    np.compress(~right, cell, out=out[:len(cell) - n])
    np.compress(right, cell, out=out[len(cell) - n:])
    return out


def _close(leaf: np.ndarray, cell: np.ndarray, count: np.ndarray, live: np.ndarray, stays: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cells of the nodes that stay; the others reach their leaves."""
    if stays.all():
        return cell, count
    on = np.repeat(stays, count)
    leaf[cell[~on]] = np.repeat(live[~stays], count[~stays])
    return cell[on], count[stays]


class _Sums:
    """Histograms of the cells' weights and target sums; where both are whole and
    small enough, one number holds the two."""

    def __init__(self, weight: np.ndarray, total: np.ndarray):
        self.base = 0.0
        if total.min(initial=0) >= 0 and (total == np.rint(total)).all():
            base = 2.0 ** int(total.sum() + 1).bit_length()
            self.base = base if (weight.sum() + 1) * base < 2.0 ** 53 else 0.0
        self.of = [weight * self.base + total] if self.base else [weight, total]

    def keeps(self, design: Design, nodes: int) -> bool:
        """Whether the histograms of a level are kept for its children: those of more
        nodes than are weighed at a time only if a difference of sums is exact."""
        return nodes <= (MOST_SUMS // design.bin_at[-1] if self.base else NODES_AT_ONCE)

    def room(self, design: Design, nodes: int) -> np.ndarray | None:
        return np.empty((nodes, design.bin_at[-1], len(self.of))) if self.keeps(design, nodes) else None

    def histogram(self, design: Design, at: np.ndarray, cell: np.ndarray, nodes: int) -> np.ndarray:
        """(node, bin, sum)"""
        out = [design.histogram(at, cell, x[cell], nodes) for x in self.of]
        return out[0][:, :, None] if len(out) == 1 else np.stack(out, axis=2)

    def children(self, design: Design, above: np.ndarray, parents: np.ndarray, cell: np.ndarray, count: np.ndarray,
                 fits: np.ndarray) -> np.ndarray:
        """Of the left and then the right children that may be split: the smaller one
        of a pair is counted, the other is what it leaves of the parent, which is a
        row of the level above."""
        left, right = count.reshape(2, -1)
        pairs = np.flatnonzero(fits.reshape(2, -1).any(0))
        smaller = pairs + len(left) * (left > right)[pairs]     # the counted child of each pair, and the other one
        larger = pairs + len(left) * (left <= right)[pairs]
        on, row = np.zeros(len(count), bool), np.empty(len(count), np.int64)
        on[smaller], row[smaller] = True, np.arange(len(pairs))
        h = self.histogram(design, np.repeat(row[on], count[on]), cell[np.repeat(on, count)], len(pairs))
        out, to = np.empty((int(fits.sum()), *h.shape[1:])), np.cumsum(fits) - 1
        out[to[smaller[fits[smaller]]]] = h[fits[smaller]]
        own = np.flatnonzero(fits[larger])
        rest = above[parents[pairs[own]]]
        rest -= h if len(own) == len(h) else h[own]
        out[to[larger[own]]] = rest
        return out

    def parts(self, *sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The weights and the target sums that such sums hold."""
        if not self.base:
            return sums
        w = np.floor(sums[0] / self.base)
        return w, sums[0] - w * self.base


def _best_splits(design: Design, sums: _Sums, h: np.ndarray, w: np.ndarray, s: np.ndarray, least: int,
                 columns: int | None, draws: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The split of each node, or -1, with the weight and target sum on its right.
    Splits of columns that aren't drawn are not weighed."""
    if columns is None:
        right = [design.right_of_splits(h[:, :, i]) for i in range(h.shape[2])]
        node, of = np.divmod(np.arange(right[0].size), right[0].shape[1])
        right = [x.ravel() for x in right]
    else:
        node, of, right = _drawn_splits(design, h, w * sums.base + s if sums.base else w, columns, draws)
    rw, rs = sums.parts(*right)
    lw = w[node] - rw
    on = (lw >= least) & (rw >= least)
    node, of, lw, rw, rs = (x[on] for x in (node, of, lw, rw, rs))
    gain = (s[node] - rs) ** 2 / lw + rs ** 2 / rw
    best, best_w, best_s = np.full(len(w), -1), np.zeros(len(w)), np.zeros(len(w))
    if len(node):
        # equal gains differ by rounding only: the first column of them is taken
        begin = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        top = np.maximum.reduceat(gain, begin)
        high = np.flatnonzero(gain >= np.repeat(top - 1e-9 * (1 + np.abs(top)), np.diff(np.append(begin, len(node)))))
        first = high[np.append(True, node[high][1:] != node[high][:-1])]
        own = node[first]
        best[own], best_w[own], best_s[own] = of[first], rw[first], rs[first]
    return best, best_w, best_s


def _drawn_splits(design: Design, h: np.ndarray, whole: np.ndarray, columns: int,
                  draws: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The splits of the drawn columns that vary: node, split and the sums on its
    right, in the order of nodes and splits. ``whole``: the first sum of each node."""
    first = h[:, :, 0]                                      # bins without weight have sums of 0
    some, part = first > 0, first < whole[:, None]
    levels = np.flatnonzero(design.is_level[design.split_feature[design.column_at]])      # before the numbers' columns
    split = design.column_at[levels]
    bins = split + design.split_feature[split]              # each feature before has a bin of nulls
    varies = np.empty(draws.shape, bool)
    varies[:, levels] = (some & part)[:, bins]
    numbers = [(f, np.searchsorted(design.column_at, design.split_at[f])) for f in np.flatnonzero(~design.is_level) if len(design.values[f])]
    for f, column in numbers:
        varies[:, column] = part[:, design.bin_at[f]:design.bin_at[f + 1]].all(1)
    key = np.where(varies, draws, np.inf)
    few = min(columns, key.shape[1]) - 1
    varies &= key <= np.partition(key, few, axis=1)[:, few:few + 1]
    node, level = np.nonzero(varies[:, levels])
    found = [(node, split[level], h[node, bins[level]])]
    for f, column in numbers:
        node = np.flatnonzero(varies[:, column])
        own = h[node, design.bin_at[f]:design.bin_at[f + 1]]
        right = own.sum(1)[:, None] - np.cumsum(own, 1)[:, :-1]
        splits = np.arange(design.split_at[f], design.split_at[f + 1])
        found.append((np.repeat(node, len(splits)), np.tile(splits, len(node)), right.reshape(-1, h.shape[2])))
    node, of, right = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(node, kind="stable")
    return node[order], of[order], list(right[order].T)


# ---- ensembles -----------------------------------------------------------------------
def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_boosted(design: Design, n: np.ndarray, pos: np.ndarray, n_estimators: int, learning_rate: float,
                max_depth: int, keep: bool = True) -> tuple[list[Tree], float, np.ndarray]:
    """Gradient boosting of the log loss: each tree fits the residuals, each leaf
    takes a Newton step. Returns the trees (none without ``keep``), the first
    log odds and the probability of each cell."""
    prior = np.clip(pos.sum() / max(n.sum(), 1), 1e-12, 1 - 1e-12)
    first = float(np.log(prior / (1 - prior)))
    raw, trees = np.full(len(n), first), []
    for _ in range(n_estimators):
        p = _sigmoid(raw)
        residual = pos - n * p
        tree, leaf = grow(design, n, residual, pos * (1 - p) ** 2 + (n - pos) * p ** 2, max_depth)
        up, down = (np.bincount(leaf, x, len(tree.feature)) for x in (residual, n * p * (1 - p)))
        tree.value = learning_rate * np.where(down > 1e-150, up / np.where(down > 1e-150, down, 1), 0)
        if keep:
            trees.append(tree)
        raw += tree.value[leaf]
    return trees, first, _sigmoid(raw)


def fit_forests(design: Design, n: np.ndarray, pos: np.ndarray, n_estimators: int, max_depths: Sequence[int],
                min_samples_split: int, min_samples_leaf: int, seed: int = 0,
                keep: bool = True) -> list[tuple[list[Tree], float, np.ndarray]]:
    """Random forests of several greatest depths: each tree takes as many rows as
    there are, drawn with repeats (by a multinomial draw over cells and labels,
    which is the same), and at each node the square root of the number of columns
    that vary. Trees grow by level, so a shallower tree is the top of a deeper
    one and is grown once. Without ``keep`` only the probabilities of the cells
    are kept of them."""
    rows = np.concatenate([pos, n - pos])
    share = rows / max(rows.sum(), 1)
    # a column for each level that occurs in training and for each number
    width = sum(len(np.setdiff1d(c[n > 0], [len(v)])) if lv else 1 for c, v, lv in zip(design.codes, design.values, design.is_level, strict=True))
    rates, trees = [np.zeros(len(n)) for _ in max_depths], [[] for _ in max_depths]
    for t in range(n_estimators):
        rng = np.random.default_rng([seed, t])
        drawn = rng.multinomial(int(rows.sum()), share).astype(float) if rows.sum() else rows
        own_pos, own = drawn[:len(n)], drawn[:len(n)] + drawn[len(n):]
        whole, leaves = grow(design, own, own_pos, own_pos, max(max_depths), min_samples_split, min_samples_leaf, max(1, int(np.sqrt(width))), rng)
        for i, depth in enumerate(max_depths):
            tree, node = top_of(whole, depth)
            leaf = leaves if tree is whole else node[leaves]
            if tree is not whole or whole.value is None:
                up, down = (np.bincount(leaf, x, len(tree.feature)) for x in (own_pos, own))
                tree.value = up / np.maximum(down, 1)
            if keep:
                trees[i].append(tree)
            rates[i] += tree.value[leaf]
    return [(own, 0.0, rate / max(n_estimators, 1)) for own, rate in zip(trees, rates, strict=True)]


def top_of(tree: Tree, max_depth: int) -> tuple[Tree, np.ndarray]:
    """The first ``max_depth`` levels of a tree, and the node of that top in which
    each node lies. Nodes are numbered level by level, the root first."""
    node, level, depth, end = np.arange(len(tree.feature)), np.array([0]), 0, 1
    while len(level):
        inner = level[tree.feature[level] >= 0]
        level = np.concatenate([tree.child[inner], tree.child[inner] + 1])
        if depth < max_depth:
            end += len(level)
        else:
            node[tree.child[inner]] = node[tree.child[inner] + 1] = node[inner]
        depth += 1
    if end == len(node):
        return tree, node
    inside = tree.child[:end] < end
    return Tree(np.where(inside, tree.feature[:end], -1), np.where(inside, tree.bound[:end], 0), np.where(inside, tree.child[:end], 0)), node


def fit_forest(design: Design, n: np.ndarray, pos: np.ndarray, n_estimators: int, max_depth: int, min_samples_split: int,
               min_samples_leaf: int, seed: int = 0, keep: bool = True) -> tuple[list[Tree], float, np.ndarray]:
    """A random forest of one greatest depth, as ``fit_forests`` grows it."""
    return fit_forests(design, n, pos, n_estimators, [max_depth], min_samples_split, min_samples_leaf, seed, keep)[0]


FITS = {"gbt": fit_boosted, "gbt_single": fit_boosted, "random_forest": fit_forest}


def tree_grid(kind: str) -> list[tuple[str, dict]]:
    """The grids of the models, by the names of their parameters (fixed values)."""
    if kind == "random_forest":
        settings = [dict(n_estimators=50, max_depth=d, min_samples_split=s, min_samples_leaf=m)
                    for d in (50, 100) for s in (10, 25) for m in (10, 20)]
    elif kind == "gbt":
        settings = [dict(n_estimators=100, learning_rate=0.25, max_depth=d) for d in (10, 15)]
    else:
        settings = [dict(n_estimators=1, learning_rate=0.25, max_depth=10)]
    return [(",".join(f"{k}={v}" for k, v in s.items()), s) for s in settings]


# ---- cross-validation ------------------------------------------------------------------
def _fits(kind: str, grid: list[tuple[str, dict]]) -> list[list[tuple[str, dict]]]:
    """The settings that one task fits: forests that differ only in their greatest
    depth share their trees. The longest fits, of deep trees with small leaves, come first."""
    shared: dict[str, list] = {}
    for name, setting in grid:
        rest = {k: v for k, v in setting.items() if k != "max_depth"} if kind == "random_forest" else setting
        shared.setdefault(json.dumps(rest, sort_keys=True), []).append((name, setting))
    return sorted(shared.values(), key=lambda own: (-max(s["max_depth"] for _, s in own), own[0][1].get("min_samples_leaf", 1)))


def _packed(categorical: Sequence[str], numeric: Sequence[str], folds: int):
    """Cells as Arrow streams with codes for their features, one for each batch and
    fold, with the counts that the fold's fits train on and those it holds out."""
    def run(batches):
        for b in (b for b in batches if b.num_rows):
            features = {c: b.column(c).dictionary_encode() for c in (*categorical, *numeric)}
            counts = {c: b.column(c).flatten().to_numpy().reshape(b.num_rows, folds) for c in ("n", "pos")}
            streams = []
            for k in range(folds):
                own = {c: v.sum(1) - v[:, k] for c, v in counts.items()} | {f"held_{c}": v[:, k] for c, v in counts.items()}
                part = pa.record_batch(features | {c: pa.array(v) for c, v in own.items()})
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, part.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as to:
                    to.write_batch(part)
                streams.append(out.getvalue().to_pybytes())
            yield pa.record_batch({"_fold": pa.array(range(folds), pa.int32()), "cells": pa.array(streams, pa.binary())})
    return run


def _unpacked(streams: pa.ChunkedArray, categorical: Sequence[str], numeric: Sequence[str]) -> tuple[Design, list[np.ndarray]]:
    """The design of the packed cells and their counts: n, pos, held_n, held_pos."""
    design = Design(pa.Table.from_batches([b for s in streams for b in pa.ipc.open_stream(s.as_buffer())]), categorical, numeric)
    counts = [design.table[c].to_numpy().astype(np.float64) for c in ("n", "pos", "held_n", "held_pos")]
    design.table = None                                     # a fit reads codes and counts only
    pa.default_memory_pool().release_unused()
    return design, counts


def _fold_fit(kind: str, fits: list[list[tuple[str, dict]]], folds: int, categorical: Sequence[str], numeric: Sequence[str]):
    def run(table: pa.Table) -> pa.Table:
        at, fold = divmod(table["fit"][0].as_py(), folds)
        design, (n, pos, held_n, held_pos) = _unpacked(table["cells"], categorical, numeric)
        names, settings = zip(*fits[at], strict=True)
        began = time.perf_counter()
        if kind == "random_forest":
            depths = [s["max_depth"] for s in settings]
            rest = {k: v for k, v in settings[0].items() if k != "max_depth"}
            models = fit_forests(design, n, pos, max_depths=depths, keep=False, **rest)
        else:
            models = [FITS[kind](design, n, pos, keep=False, **s) for s in settings]
        fitted = time.perf_counter() - began
        out = []
        for name, (_, _, p) in zip(names, models, strict=True):
            began, called = time.perf_counter(), p > 0.5
            tp, pp = int(held_pos[called].sum()), int(held_n[called].sum())
            out.append((name, fold, tp, pp, fitted, time.perf_counter() - began))
        columns = zip(("params", "_fold", "tp", "pp", "fit_time", "score_time"), zip(*out, strict=True), strict=True)
        return pa.table({c: pa.array(v, pa.int32()) if c == "_fold" else pa.array(v) for c, v in columns})
    return run


def cross_validate(cells: DataFrame, kind: str, categorical: Sequence[str], numeric: Sequence[str], folds: int,
                   grid: list[tuple[str, dict]] | None = None) -> DataFrame:
    """(params, _fold, tp, pp, fit_time, score_time) of every setting and fold: a
    group of cells per fit, each in a partition of its own, with the counts that
    this fit trains on and those it holds out; a lost executor costs only the
    fits that it held. Settings that share their trees have the time of both.
    Cells are packed before they are sent to the fits: the JVM handles a few
    blocks for each fit. ``cells`` holds at most MAX_CELLS rows."""
    importable(cells.sparkSession)
    fits = _fits(kind, grid or tree_grid(kind))
    packed = cells.mapInArrow(_packed(categorical, numeric, folds), "_fold int, cells binary")
    each = packed.select(F.explode(F.sequence("_fold", F.col("_fold") + F.lit((len(fits) - 1) * folds), F.lit(folds))).alias("fit"), "cells")
    own = each.repartitionById(len(fits) * folds, "fit")
    return own.groupBy("fit").applyInArrow(_fold_fit(kind, fits, folds, categorical, numeric), _SCORES)


# ---- fitted model --------------------------------------------------------------------
class CellModel:
    """A fitted ensemble: a table with a row per tree and its feature values."""

    def __init__(self, kind: str, first: float, categorical: Sequence[str], numeric: Sequence[str], values: list[list],
                 trees: list[Tree]):
        self.kind, self.first, self.categorical, self.numeric = kind, first, list(categorical), list(numeric)
        self.values, self.trees = values, trees

    @classmethod
    def fit(cls, df: DataFrame, kind: str, params: Mapping, categorical: Sequence[str], numeric: Sequence[str],
            label: str = "target") -> CellModel:
        """Fitted in one task on at most MAX_CELLS cells; the driver gets the trees,
        which have at most two nodes per cell."""
        spark = df.sparkSession
        importable(spark)
        cells = feature_cells(df, categorical, numeric, label)
        if cells.count() > MAX_CELLS:
            raise ValueError(f"more than {MAX_CELLS} cells; fit the rows with Spark ML")

        def run(table: pa.Table) -> pa.Table:
            design = Design(table, categorical, numeric)
            trees, first, _ = FITS[kind](design, design.counts("n")[:, 0], design.counts("pos")[:, 0], **params)
            out = {"tree": pa.array(range(len(trees)), pa.int32()), "feature": pa.array([t.feature for t in trees], pa.list_(pa.int32())),
                   "bound": pa.array([cls._bounds(t, design) for t in trees], pa.list_(pa.float64())),
                   "child": pa.array([t.child for t in trees], pa.list_(pa.int32())), "value": pa.array([t.value for t in trees], pa.list_(pa.float64()))}
            meta = json.dumps({"first": first, "values": [v if lv else [] for v, lv in zip(design.values, design.is_level, strict=True)]})
            return pa.table({**out, "meta": [meta] * len(trees)})

        rows = cells.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(run, _TREES + ", meta string").collect()
        meta = json.loads(rows[0]["meta"]) if rows else {"first": 0.0, "values": [[] for _ in (*categorical, *numeric)]}
        return cls(kind, meta["first"], categorical, numeric, meta["values"], cls._trees(rows))

    @staticmethod
    def _bounds(tree: Tree, design: Design) -> np.ndarray:
        """Levels by number, thresholds halfway to the next value."""
        out = tree.bound.astype(float)
        for f, values in enumerate(design.values):
            if not design.is_level[f]:
                own = tree.feature == f
                v = np.array(values, float)
                out[own] = ((v + np.append(v[1:], v[-1:])) / 2)[tree.bound[own]] if len(v) else 0
        return out

    @staticmethod
    def _trees(rows) -> list[Tree]:
        return [Tree(np.array(r["feature"]), np.array(r["bound"], float), np.array(r["child"]), np.array(r["value"], float))
                for r in sorted(rows, key=lambda r: r["tree"])]

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Of rows of codes: level numbers (-1: none of the fitted) and numbers."""
        is_level = np.array([True] * len(self.categorical) + [False] * len(self.numeric))
        raw = np.full(len(x), self.first)
        for t in self.trees:
            node = np.zeros(len(x), np.int64)
            while True:
                rows = np.flatnonzero(t.feature[node] >= 0)
                if not len(rows):
                    break
                at = node[rows]
                f = t.feature[at]
                node[rows] = t.child[at] + _goes_right(is_level, f, x[rows, f], t.bound[at])
            raw += t.value[node]
        return raw / max(len(self.trees), 1) if self.kind == "random_forest" else _sigmoid(raw)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds y_proba_0, y_proba_1 and y_etiqueta. Each batch is scored by its
        distinct cells."""
        importable(df.sparkSession)
        names, kept = [*self.categorical, *self.numeric], df.columns
        model = self

        def run(batches):
            for b in batches:
                x = np.empty((b.num_rows, len(names)))
                for i, c in enumerate(names):
                    column = b.column(f"_{c}")
                    if i < len(model.categorical):
                        x[:, i] = pc.index_in(column, pa.array(model.values[i], pa.string())).fill_null(-1).to_numpy(zero_copy_only=False)
                    else:                                   # a null number is above every threshold
                        x[:, i] = column.fill_null(np.inf).to_numpy(zero_copy_only=False)
                cells, back = np.unique(np.nan_to_num(x, nan=np.inf, posinf=np.inf), axis=0, return_inverse=True)
                p = model.probability(cells)[back.reshape(-1)]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(1 - p), pa.array(p), pa.array((p > 0.5).astype(np.int32))],
                                                 [*kept, "y_proba_0", "y_proba_1", "y_etiqueta"])

        coded = df.select("*", *[F.col(c).cast("string").alias(f"_{c}") for c in self.categorical],
                          *[F.col(c).cast("double").alias(f"_{c}") for c in self.numeric])
        scores = [T.StructField("y_proba_0", T.DoubleType()), T.StructField("y_proba_1", T.DoubleType()), T.StructField("y_etiqueta", T.IntegerType())]
        return coded.mapInArrow(run, T.StructType([*df.schema.fields, *scores]))

    def save(self, spark: SparkSession, path: str) -> None:
        meta = json.dumps({"kind": self.kind, "first": self.first, "categorical": self.categorical, "numeric": self.numeric, "values": self.values})
        rows = [(i, t.feature.tolist(), t.bound.tolist(), t.child.tolist(), t.value.tolist()) for i, t in enumerate(self.trees)]
        spark.createDataFrame(rows, _TREES).write.mode("overwrite").parquet(f"{path}/trees")
        spark.createDataFrame([(meta,)], "cell_model string").write.mode("overwrite").parquet(f"{path}/cell_model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CellModel:
        meta = json.loads(spark.read.parquet(f"{path}/cell_model").first()[0])
        trees = cls._trees(spark.read.parquet(f"{path}/trees").collect())
        return cls(meta["kind"], meta["first"], meta["categorical"], meta["numeric"], meta["values"], trees)
