"""Regression trees grown level by level from binned rows, in NumPy, inside one task.

The rules are those of Spark's trees: the bins and thresholds of ``findSplits``, bags drawn from a Poisson distribution,
a random subset of the features at each node, the gain in variance, and the same conditions for leaves.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from math import ceil, log2

import numpy as np

# Nodes whose histograms are made at once; their figures stay in a core's cache.
NODES = 256
# Gains below this share of a node's variance are rounding.
ROUNDING = 1e-12


def thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """Spark's candidate thresholds of one feature from a sample of its values."""
    found, counts = np.unique(values, return_counts=True)
    if len(found) <= bins:
        return (found[:-1] + found[1:]) / 2
    stride = len(values) / bins
    out, target, now = [], stride, int(counts[0])
    for at in range(1, len(found)):
        before, now = now, now + int(counts[at])
        if abs(before - target) < abs(now - target):
            out.append((found[at - 1] + found[at]) / 2)
            target += stride
    return np.array(out)


@dataclass(frozen=True)
class Layout:
    """Where the features' bins stand in the columns of the codes.

    A feature with one threshold is a member of a bundle: features of which no row has two above their thresholds, like
    the places of a one-hot vector, share a column, which holds the number of the member that is above its threshold,
    or 0. Any other feature has a column of its own with the number of its thresholds below the value.
    """

    features: int
    thresholds: tuple[np.ndarray, ...]
    #: For each column its features: one with several thresholds, or the members of a bundle.
    columns: tuple[tuple[int, ...], ...]

    def bundled(self, column: int) -> bool:
        return len(self.thresholds[self.columns[column][0]]) == 1

    def bins(self, column: int) -> int:
        return 1 + (len(self.columns[column]) if self.bundled(column) else len(self.thresholds[self.columns[column][0]]))

    def splits(self) -> np.ndarray:
        """A row for each split that a node can have: feature, column, the number of its threshold, first and number of
        the codes that go right."""
        rows = []
        for column, members in enumerate(self.columns):
            if self.bundled(column):
                rows += [(feature, column, 0, at, 1) for at, feature in enumerate(members, 1)]
            else:
                bins = self.bins(column)
                rows += [(members[0], column, at, at + 1, bins - at - 1) for at in range(bins - 1)]
        return np.array(rows, dtype=np.int64).reshape(-1, 5)


def bundles(together: np.ndarray, features: Sequence[int], most: int) -> list[tuple[int, ...]]:
    """Features that are never above their thresholds in the same row, gathered greedily."""
    out: list[list[int]] = []
    for at in range(len(features)):
        for members in out:
            if len(members) < most and not together[at, members].any():
                members.append(at)
                break
        else:
            out.append([at])
    return [tuple(features[at] for at in members) for members in out]


@dataclass(frozen=True)
class Rules:
    """What a forest's parameters say about each of its trees."""

    seed: int
    depth: int
    tried: int
    least: int
    gain: float
    rate: float
    replace: bool

    @property
    def draws(self) -> Rules:
        """What bags and subsets of features depend on; rules that agree in it can share nodes."""
        return replace(self, depth=0, least=0, gain=0.0)


def tried_features(strategy: str, trees: int, features: int) -> int:
    """The size of the subset of the features that a node tries, as Spark reads the strategy."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "onethird"
    named = {"all": features, "onethird": ceil(features / 3), "sqrt": ceil(features**0.5), "log2": max(1, ceil(log2(features)))}
    if strategy in named:
        return named[strategy]
    number = float(strategy)
    return min(features, int(number)) if "." not in strategy and number >= 1 else ceil(number * features)


@dataclass(frozen=True)
class Tree:
    """A tree's nodes, level after level; ``left`` is the place of the left child, beside which the right one stands,
    or the place of a leaf itself."""

    split: np.ndarray
    left: np.ndarray
    mean: np.ndarray
    impurity: np.ndarray
    gain: np.ndarray
    rows: np.ndarray
    #: Where each level begins, and the end.
    levels: np.ndarray


#: How a tree's arrays are kept.
KINDS = {"split": "i4", "left": "i4", "mean": "f8", "impurity": "f8", "gain": "f8", "rows": "f8", "levels": "i4"}


def _bag(rules: Rules, rng: np.random.Generator, rows: int) -> np.ndarray:
    if rules.replace:
        return rng.poisson(rules.rate, rows).astype(np.int16)
    if rules.rate == 1:
        return np.ones(rows, np.int16)
    return (rng.random(rows) < rules.rate).astype(np.int16)


def _subset(salt: np.uint64, path: np.ndarray, features: int, tried: int) -> np.ndarray:
    """For each node whether it tries each of the features: those with the lowest hashes (SplitMix64) of node and feature."""
    keys = (path[:, None] * np.uint64(features) + np.arange(features, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + salt
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        keys ^= keys >> np.uint64(shift)
        keys *= np.uint64(factor)
    keys ^= keys >> np.uint64(31)
    return keys <= np.partition(keys, tried - 1, axis=1)[:, tried - 1 : tried]


def _best(codes, weights, errors, node, nodes, allowed, totals, least, layout, splits):
    """For each least number of rows each node's largest gain and its split, or a gain of -1 if it has none."""
    counts, sums = np.empty((len(splits), nodes)), np.empty((len(splits), nodes))
    at = 0
    for column in range(len(layout.columns)):
        bins = layout.bins(column)
        place = codes[:, column] * np.intp(nodes)
        place += node
        n = np.bincount(place, weights, bins * nodes).reshape(bins, nodes)
        s = np.bincount(place, errors, bins * nodes).reshape(bins, nodes)
        end = at + bins - 1
        if layout.bundled(column):
            counts[at:end], sums[at:end] = n[1:], s[1:]
        else:
            np.cumsum(n[:-1], axis=0, out=counts[at:end])
            np.cumsum(s[:-1], axis=0, out=sums[at:end])
        at = end
    # The errors of a node add up to 0, so that one side says what the other is.
    other = totals - counts
    fewer = np.minimum(counts, other)
    np.square(sums, out=sums)
    counts *= other
    with np.errstate(divide="ignore", invalid="ignore"):
        sums /= counts
    fewer[~allowed] = -1
    gains, found, every = np.empty((len(least), nodes)), np.empty((len(least), nodes), np.intp), np.arange(nodes)
    before = None
    for at in np.argsort(least, kind="stable"):
        # A split that was the best of more of them stays the best.
        again = every if before is None else np.flatnonzero(fewer[found[before], every] < least[at])
        if before is not None:
            gains[at], found[at] = gains[before], found[before]
        if len(again):
            some = sums if before is None else sums[:, again]
            some = np.where((fewer if before is None else fewer[:, again]) >= least[at], some, -1.0)
            gains[at, again] = best = some.max(axis=0)
            found[at, again] = (some == best).argmax(axis=0)
        before = at
    return gains, found


def grow(codes: np.ndarray, labels: np.ndarray, layout: Layout, rules: Sequence[Rules], number: int) -> list[Tree]:
    """The tree of this number by each of the rules, which may differ in depth, least number of rows, and least gain.

    A node's features depend on the seed, the number and its place in the tree only, so a tree of a lower depth is the
    same tree cut off, and trees by other rules share their nodes as long as they split alike.
    """
    rng = np.random.default_rng([rules[0].seed & (2**63 - 1), number])
    salt = rng.integers(2**63, dtype=np.uint64)
    bag = _bag(rules[0], rng, len(labels))
    kept = np.flatnonzero(bag)
    codes, weights, labels = codes[kept], bag[kept].astype(np.float64), labels[kept]
    node, path = np.zeros(len(kept), np.intp), np.ones(1, np.uint64)
    member = np.ones((len(rules), 1), bool)
    splits, least = layout.splits(), np.array([rule.least for rule in rules])
    column, first, over = splits[:, 1], splits[:, 3].astype(codes.dtype), splits[:, 4].astype(codes.dtype)
    parts: list[list[tuple[np.ndarray, ...]]] = [[] for _ in rules]
    levels = [[0] for _ in rules]
    for level in range(max(rule.depth for rule in rules) + 1):
        nodes = len(path)
        total = np.bincount(node, weights, nodes)
        mean = np.bincount(node, weights * labels, nodes) / total
        weighted = labels - mean[node]
        errors = weighted * weights
        weighted *= errors
        impurity = np.bincount(node, weighted, nodes) / total
        split, gain = np.full((len(rules), nodes), -1), np.full((len(rules), nodes), -1.0)
        # A variance that comes from rounding only is none.
        live = member & (impurity > 2.0**-51 * np.maximum(1.0, mean * mean)) & (total >= 2 * least[:, None])
        live &= np.array([[level < rule.depth] for rule in rules])
        found = np.flatnonzero(live.any(axis=0)) if len(splits) else np.empty(0, np.intp)
        if 0 < len(found) < nodes:
            renamed = np.full(nodes, -1)
            renamed[found] = np.arange(len(found))
            node = renamed[node]
            kept = np.flatnonzero(node >= 0)
            codes, weights, labels, errors, node = codes[kept], weights[kept], labels[kept], errors[kept], node[kept]
        if len(found):
            subset = _subset(salt, path[found], layout.features, rules[0].tried).T[splits[:, 0]]
            bounds = np.searchsorted(node, np.arange(0, len(found) + NODES, NODES).clip(max=len(found)))
            for at, (begin, end) in enumerate(zip(bounds, bounds[1:])):
                some = slice(at * NODES, min(len(found), (at + 1) * NODES))
                if some.stop > some.start:
                    gain[:, found[some]], split[:, found[some]] = _best(
                        codes[begin:end], weights[begin:end], errors[begin:end], node[begin:end] - some.start,
                        some.stop - some.start, subset[:, some], total[found[some]], least, layout, splits,
                    )
        good = live & (gain > ROUNDING * impurity) & (gain >= np.array([[rule.gain] for rule in rules]))
        split[~good], gain[~good] = -1, -1.0
        for at in range(len(rules)):
            own = np.flatnonzero(member[at])
            left, inner = np.arange(len(own)) + levels[at][-1], good[at, own]
            levels[at].append(levels[at][-1] + len(own))
            left[inner] = levels[at][-1] + 2 * np.arange(inner.sum())
            parts[at].append((split[at, own], left, mean[own], impurity[own], gain[at, own], total[own]))
        if not good.any():
            break
        # Rules that split a node alike share its children; the first of them leads.
        leader = np.full(good.shape, -1)
        for at in range(len(rules)):
            for other in range(at, -1, -1):
                leader[at, good[at] & good[other] & (split[at] == split[other])] = other
        leads = leader == np.arange(len(rules))[:, None]
        pair = (np.cumsum(leads.T.ravel()) - 1).reshape(nodes, len(rules)).T
        pairs = np.flatnonzero(leads.T.ravel())
        parent, of = pairs // len(rules), pairs % len(rules)
        path = (2 * path[parent, None] + np.arange(2, dtype=np.uint64)).ravel()
        member = np.repeat(leader[:, parent] == of, 2, axis=1)
        # The rows in the order of their new nodes, without those of leaves.
        chosen, child = [], []
        for at in range(len(rules)):
            own = leads[at, found]
            rows = np.flatnonzero(own[node]) if not own.all() else np.arange(len(node))
            if len(rows):
                at_node = node[rows]
                right = _right(codes[rows], split[at, found][at_node], column, first, over)
                chosen.append(rows)
                child.append(2 * pair[at, found][at_node] + right)
        rows, child = np.concatenate(chosen), np.concatenate(child)
        order = np.argsort(child.astype(np.uint16) if len(path) <= 1 << 16 else child, kind="stable")
        node, rows = child[order], rows[order]
        codes, weights, labels = codes[rows], weights[rows], labels[rows]
    out = []
    for part, ends in zip(parts, levels):
        whole = [*(np.concatenate(values) for values in zip(*part)), np.array(ends)]
        out.append(Tree(*(values.astype(kind) for values, kind in zip(whole, KINDS.values()))))
    return out


def _right(codes, split, column, first, over) -> np.ndarray:
    """Whether each row goes right by its split."""
    value = codes.ravel().take(np.arange(0, codes.size, codes.shape[1]) + column.take(split))
    value -= first.take(split)
    return value < over.take(split)


def predictions(tree: Tree, codes: np.ndarray, layout: Layout, depths: Sequence[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(depth, predictions) of the rows by the tree cut off at each of the depths, from low to high."""
    splits = layout.splits()
    # A leaf sends all rows to the left, that is to itself.
    column, first, over = (np.append(splits[:, at], 0)[tree.split] for at in (1, 3, 4))
    first, over = first.astype(codes.dtype), over.astype(codes.dtype)
    flat, rows = codes.ravel(), np.arange(0, codes.size, codes.shape[1])
    node = np.zeros(len(codes), np.intp)
    for depth in range(max(depths) + 1):
        if depth in depths:
            yield depth, tree.mean.take(node)
        if depth + 2 < len(tree.levels):
            value = flat.take(rows + column.take(node))
            value -= first.take(node)
            node = tree.left.take(node) + (value < over.take(node))
