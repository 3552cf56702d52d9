"""Cover trees over the parts of a block of integer vectors.

A forest has a tree a part position. A node is a ball: its centre is one of its
points and its radius the distance of the farthest. Its children cover it with
balls of half the radius whose centres are more than half the radius apart; the
first child keeps the centre. A node becomes a leaf when it holds LEAF points or
its points are equal. Beyond SIBLINGS children the points not covered yet form
one leaf, so that building stays linear where many dimensions leave no structure.

Points are kept in tree order, so a node is a range of places and the sum of its
points is the difference of two cumulative sums.

To find nearest entries, a node carries the entries that may be nearest to one
of its points. By the triangle inequality an entry that is farther from the
centre than the nearest one by more than twice the radius is nearest to none. A
node left with one entry is settled whole; an ambiguous one hands its entries
to its children, and an ambiguous leaf is compared point by point. Distances are
exact integers, and roots of them decide with a margin, so results are those of
a full comparison, ties going to the lower index.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF = 8
SIBLINGS = 64
#: Relative room left to rounded roots.
MARGIN = 1e-9
#: Point-entry pairs compared at a time.
PAIRS = 1 << 18
#: Components beyond this leave no room for exact squared distances.
LARGEST = 1 << 26


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for sizes[0] numbers, then the same for the next."""
    shift = np.cumsum(sizes) - sizes
    return np.repeat(starts - shift, sizes) + np.arange(int(sizes.sum()))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    difference = a - b
    return np.einsum("ij,ij->i", difference, difference)


@dataclass
class Forest:
    """Nodes name places; ``order`` says which point, part * rows + row, is at a place."""

    order: np.ndarray
    start: np.ndarray
    size: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    first_child: np.ndarray
    children: np.ndarray
    parts: int

    FIELDS = ("order", "start", "size", "centre", "radius", "first_child", "children")

    @classmethod
    def build(cls, points: np.ndarray, parts: int) -> Forest:
        """``points`` are those of the first part, then of the second, and so on."""
        total = len(points)
        rows = total // parts
        order = np.arange(total)
        start, size = np.arange(parts) * rows, np.full(parts, rows)
        centre, rest = start.copy(), np.zeros(parts, bool)
        levels, made = [], 0
        while len(start):
            at = ranges(start, size)
            group = np.repeat(np.arange(len(start)), size)
            far = squared(points[order[at]], points[order[centre]][group])
            reach = np.maximum.reduceat(far, np.cumsum(size) - size)
            # Rounded up, as a radius must not be too small.
            level = {"start": start, "size": size, "centre": centre, "radius": np.sqrt(reach) * (1 + 1e-12)}
            made += len(start)
            split = (size > LEAF) & (reach > 0) & ~rest
            number, ordinal = cls._cover(points[order[at]], group, split, reach, centre[group] == at)
            counts = np.zeros(len(start), np.int64)
            inside = split[group]
            if not inside.any():
                level |= {"first_child": np.zeros(len(start), np.int64), "children": counts}
                levels.append(level)
                break
            at, group, number, ordinal = at[inside], group[inside], number[inside], ordinal[inside]
            # The centre of a child comes first among its points.
            sorting = np.lexsort((ordinal, number, group))
            order[at] = order[at[sorting]]
            group, number = group[sorting], number[sorting]
            new = np.ones(len(at), bool)
            new[1:] = (group[1:] != group[:-1]) | (number[1:] != number[:-1])
            heads = np.flatnonzero(new)
            start = at[heads]
            size = np.diff(np.append(heads, len(at)))
            centre = start.copy()
            rest = number[heads] == SIBLINGS
            np.add.at(counts, group[heads], 1)
            level |= {"first_child": made + np.cumsum(counts) - counts, "children": counts}
            levels.append(level)
        joined = {name: np.concatenate([lv[name] for lv in levels]) for name in cls.FIELDS[1:]}
        return cls(order=order, parts=parts, **joined)

    @staticmethod
    def _cover(points, group, split, reach, is_centre):
        """Per point the number of its child within its node, and 0 for the child's centre, 1 for the others."""
        number = np.zeros(len(points), np.int64)
        ordinal = np.ones(len(points), np.int64)
        left = np.flatnonzero(split[group])
        heads = np.flatnonzero(is_centre & split[group])
        for child in range(SIBLINGS):
            if not len(left):
                break
            owners = group[left]
            if child:
                heads = left[np.flatnonzero(np.append(True, owners[1:] != owners[:-1]))]
            ordinal[heads] = 0
            head_of = np.zeros(len(split), np.int64)
            head_of[group[heads]] = heads
            far = squared(points[left], points[head_of[owners]])
            covered = 4 * far <= reach[owners]
            number[left[covered]] = child
            left = left[~covered]
        number[left] = SIBLINGS
        return number, ordinal

    def arrays(self) -> dict[str, np.ndarray]:
        return {name: getattr(self, name) for name in self.FIELDS}

    def nearest(self, points: np.ndarray, books: np.ndarray) -> tuple[tuple, tuple]:
        """((nodes, their entries), (places, their entries)): subtrees settled whole, and points compared singly.

        ``points`` are in tree order; ``books`` are parts x entries x components.
        """
        parts, entries, _ = books.shape
        rows = len(points) // parts
        flat = books.reshape(parts * entries, -1)
        nodes = np.arange(parts) if rows else np.zeros(0, np.int64)
        mask = np.ones((len(nodes), entries), bool)
        whole, single = [], []
        while len(nodes):
            at, entry = np.nonzero(mask)
            node = nodes[at]
            base = (self.start[node] // rows) * entries
            far = squared(points[self.centre[node]], flat[base + entry])
            heads = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            least = np.minimum.reduceat(far, heads)
            root, radius = np.sqrt(far), self.radius[node]
            bound = np.sqrt(least)[at] + 2 * radius
            near = root <= bound + MARGIN * (root + bound + 1)
            # Equal points: what decides the centre decides them all, the first of the nearest.
            flat_ball = radius == 0
            near[flat_ball] = False
            tied = np.flatnonzero(far == least[at])
            near[tied[np.append(True, at[tied][1:] != at[tied][:-1])]] = True
            mask = np.zeros_like(mask)
            mask[at[near], entry[near]] = True
            many = mask.sum(axis=1) > 1
            whole.append((nodes[~many], mask[~many].argmax(axis=1)))
            leaf = many & (self.children[nodes] == 0)
            if leaf.any():
                single.append(self._compare(points, flat, entries, rows, nodes[leaf], mask[leaf]))
            inner = many & ~leaf
            counts = self.children[nodes[inner]]
            nodes, mask = ranges(self.first_child[nodes[inner]], counts), np.repeat(mask[inner], counts, axis=0)
        return _joined(whole), _joined(single)

    def _compare(self, points, flat, entries, rows, nodes, mask):
        """Places of ambiguous leaves and the nearest of the entries left for each."""
        places, found = [], []
        width = mask.sum(axis=1)
        edges = np.cumsum(self.size[nodes] * width)
        first = 0
        while first < len(nodes):
            last = max(first + 1, int(np.searchsorted(edges, (edges[first - 1] if first else 0) + PAIRS, "right")))
            block, allowed, size = nodes[first:last], mask[first:last], self.size[nodes[first:last]]
            place = ranges(self.start[block], size)
            owner = np.repeat(np.arange(len(block)), size)
            at, entry = np.nonzero(allowed[owner])
            far = squared(points[place[at]], flat[(place[at] // rows) * entries + entry])
            heads = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            tied = np.flatnonzero(far == np.minimum.reduceat(far, heads)[at])
            best = tied[np.append(True, at[tied][1:] != at[tied][:-1])]
            places.append(place)
            found.append(entry[best])
            first = last
        return np.concatenate(places), np.concatenate(found)

    def sums(self, points: np.ndarray, books: np.ndarray) -> np.ndarray:
        """parts x entries x (1 + components): how many points each entry is nearest to, and their sum."""
        parts, entries, width = books.shape
        rows = len(points) // parts
        (nodes, whole), (places, single) = self.nearest(points, books)
        cumulative = np.concatenate([np.zeros((1, width), np.int64), np.cumsum(points, axis=0)])
        out = np.zeros((parts * entries, 1 + width), np.int64)
        if len(nodes):
            begin, size = self.start[nodes], self.size[nodes]
            sub = np.column_stack([size, cumulative[begin + size] - cumulative[begin]])
            np.add.at(out, (begin // rows) * entries + whole, sub)
        if len(places):
            np.add.at(out, (places // rows) * entries + single, np.column_stack([np.ones(len(places), np.int64), points[places]]))
        return out.reshape(parts, entries, 1 + width)

    def assign(self, points: np.ndarray, books: np.ndarray) -> np.ndarray:
        """parts x rows: the nearest entry of every part of every row."""
        (nodes, whole), (places, single) = self.nearest(points, books)
        out = np.zeros(len(points), np.int64)
        size = self.size[nodes]
        out[self.order[ranges(self.start[nodes], size)]] = np.repeat(whole, size)
        out[self.order[places]] = single
        return out.reshape(self.parts, -1)


def _joined(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
