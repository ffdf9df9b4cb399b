"""Forward-backward over many label chains at once, in numpy.

Chains are cut into segments of ``SEGMENT`` positions. All segments advance
together, one position per step, so a step works on thousands of rows and a
long text takes no more steps than a short one. Values of positions are held a
row per state, in the order of the steps, so that a step reads and writes runs
of memory. What enters a segment from its neighbours is exact: the product of
a segment's transfer matrices carries the state across it.
"""

from __future__ import annotations

import numpy as np

SEGMENT = 256
#: Steps between rescalings of the running rows.
RESCALE = 8
#: Positions whose weights are looked up at a time.
GATHER = 65_536


class Chains:
    """Layout of chains of the given lengths, one after the other in a flat array."""

    def __init__(self, lengths: np.ndarray):
        lengths = np.asarray(lengths, np.int64)
        self.n = len(lengths)
        parts = -(-lengths // SEGMENT)
        chain = np.repeat(np.arange(self.n), parts)
        k = np.arange(len(chain)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = np.repeat(np.cumsum(lengths) - lengths, parts) + k * SEGMENT
        size = np.minimum(SEGMENT, np.repeat(lengths, parts) - k * SEGMENT)
        order = np.argsort(-size, kind="stable")
        self.begin, self.size, self.chain = begin[order], size[order], chain[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        last = k == np.repeat(parts, parts) - 1
        #: rows of consecutive segments (earlier, later) by rank of the earlier one
        self.links = [(place[at], place[at + 1]) for rank in range(int(parts.max(initial=0)) - 1)
                      for at in [np.flatnonzero((k == rank) & ~last)]]
        self.linked = place[~last]
        self.active = np.searchsorted(-self.size, -np.arange(SEGMENT + 1), side="left")
        self.steps = int(size.max(initial=0))
        self.total = int(lengths.sum())
        #: where the positions of step t begin in the order of the steps
        self.at = np.concatenate([[0], np.cumsum(self.active[:self.steps])])
        self._kept: np.ndarray | None = None

    def _positions(self, t: int, n: int) -> np.ndarray:
        return self.begin[:n] + t

    def _weights(self, emit, t: int, n: int) -> np.ndarray:
        """states x n weights of the first n segments at step t."""
        if self._kept is not None:
            return self._kept[:, self.at[t]:self.at[t] + n]
        return np.ascontiguousarray(emit(self._positions(t, n)).T)

    def _order(self) -> np.ndarray:
        """The flat positions in the order of the steps."""
        out = np.empty(self.total, np.int64)
        for t in range(self.steps):
            out[self.at[t]:self.at[t + 1]] = self._positions(t, self.active[t])
        return out

    def _transfers(self, emit, move: np.ndarray) -> np.ndarray | None:
        """For each segment diag(e1) A diag(e2) ... diag(en), up to a factor; None if no chain has two.

        Only segments of chains with several are worked out; they are the long ones and come first.
        """
        if not self.links:
            return None
        s, many = len(move), int(max(later.max() for _, later in self.links)) + 1
        many = max(many, int(max(earlier.max() for earlier, _ in self.links)) + 1)
        out = np.zeros((s, s, many))  # from, to, segment
        turned = np.ascontiguousarray(move.T)
        for t in range(self.steps):
            n = min(many, self.active[t])
            e = self._weights(emit, t, n)
            if t == 0:
                out[np.arange(s), np.arange(s)] = e
                continue
            m = np.matmul(turned, out[:, :, :n])
            m *= e
            if t % RESCALE == 0:
                m /= m.sum(axis=(0, 1))
            out[:, :, :n] = m
        out /= out.sum(axis=(0, 1))
        return out

    def forward(self, emit, first: np.ndarray, move: np.ndarray, keep: bool = False):
        """(ln likelihood of every chain, forward rows or None).

        ``emit(positions)`` gives the state weights at flat positions. With
        ``keep`` the forward rows of all positions are returned for
        :meth:`backward`, each up to a factor of its own: states x positions in
        the order of the steps.
        """
        s = len(move)
        state = np.repeat(first[:, None], len(self.begin), axis=1)
        self._kept = None
        if keep:
            order = self._order()
            self._kept = np.empty((s, self.total))
            for a in range(0, self.total, GATHER):
                self._kept[:, a:a + GATHER] = emit(order[a:a + GATHER]).T
        self.transfers = self._transfers(emit, move)
        turned = np.ascontiguousarray(move.T)
        for earlier, later in self.links:
            row = np.einsum("in,ijn->jn", state[:, earlier], self.transfers[:, :, earlier])
            state[:, later] = turned @ (row / row.sum(axis=0))
        rows = np.empty((s, self.total)) if keep else None
        logs, one = np.zeros(len(self.begin)), np.ones(s)
        for t in range(self.steps):
            n = self.active[t]
            a = state[:, :n] * self._weights(emit, t, n)
            ending = self.active[t + 1]
            if t % RESCALE == RESCALE - 1:
                c = one @ a
                a /= c
                logs[:n] += np.log(c)
            if keep:
                rows[:, self.at[t]:self.at[t + 1]] = a
            if ending < n:  # segments that end here; a rescaled row adds ln 1
                logs[ending:n] += np.log(one @ a[:, ending:])
            state[:, :ending] = turned @ a[:, :ending]
        likelihood = np.bincount(self.chain, logs, minlength=self.n) if len(logs) else np.zeros(self.n)
        return likelihood, rows

    def backward(self, emit, rows: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(marginals of all positions, expected transition counts) after a kept forward pass.

        ``rows`` is used up: the marginals take its place.
        """
        s = len(move)
        leave = np.ones((s, len(self.begin)))
        enter = np.ones((s, len(self.begin)))
        for earlier, later in reversed(self.links):
            v = np.einsum("ijn,jn->in", self.transfers[:, :, later], leave[:, later])
            enter[:, earlier] = v / v.sum(axis=0)
            leave[:, earlier] = move @ enter[:, earlier]
        pairs, one = np.zeros((s, s)), np.ones(s)
        if len(self.linked):
            last = rows[:, self.at[self.size[self.linked] - 1] + self.linked]
            after = enter[:, self.linked]
            weight = one @ (last * (move @ after))
            pairs += (last / weight) @ after.T
        back = leave
        for t in range(self.steps - 1, -1, -1):
            n, further = self.active[t], self.active[t + 1]
            if further:
                after = self._weights(emit, t + 1, further) * back[:, :further]
                b = move @ after
                if t % RESCALE == 0:
                    c = 1.0 / (one @ b)
                    b *= c
                    after *= c
                back[:, :further] = b
            before = rows[:, self.at[t]:self.at[t + 1]]
            g = before * back[:, :n]
            weight = 1.0 / (one @ g)
            if further:
                pairs += (before[:, :further] * weight[:further]) @ after.T
            g *= weight
            before[:] = g
        self._kept = None
        out = np.empty((self.total, s))
        for t in range(self.steps):
            out[self._positions(t, self.active[t])] = rows[:, self.at[t]:self.at[t + 1]].T
        return out, pairs * move
