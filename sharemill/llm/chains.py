"""Forward-backward over many chains at once.

Chains are laid out by time: first the first elements of all chains, then the second ones, and so on, longest chain
first, so that each step works on one contiguous block of all chains that reach it. A chain may be cut into pieces that
advance side by side: what a piece does to the states' probabilities is a matrix, and with the products of the matrices
before and after it a piece has the same result as in its whole chain.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np


class Chains:
    """The layout of chains with the given lengths (all over 0)."""

    def __init__(self, lengths: np.ndarray) -> None:
        order = np.argsort(-lengths, kind="stable")
        rank = np.empty(len(lengths), np.int64)
        rank[order] = np.arange(len(lengths))
        self.order = order
        #: How many chains reach each step, and where the step's block begins.
        self.active = len(lengths) - np.searchsorted(lengths[order][::-1], np.arange(lengths.max()), side="right")
        self.base = np.concatenate([[0], np.cumsum(self.active)])
        step = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        #: Where each element, in the order of the chains, goes.
        self.place = self.base[step] + np.repeat(rank, lengths)

    def by_time(self, values: np.ndarray) -> np.ndarray:
        out = np.empty_like(values)
        out[self.place] = values
        return out

    def smooth(
        self, local: np.ndarray, step: np.ndarray, start: np.ndarray, end: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
        """From each element's likelihoods by state (by time), the transition matrix and the start distribution: the
        states' probabilities given the whole chain (by time), expected numbers of transitions, the natural logarithm
        of the likelihood of all chains, and for the chains in the order given the likelihood by state of the first
        element and all after it, over that of the chain.

        ``start`` and ``end``, what follows the last element, may have a row per chain.
        """
        states, chains = local.shape[1], len(self.order)
        alpha, scale = np.empty_like(local), np.empty(len(local), local.dtype)
        ones = np.ones(states, local.dtype)
        now = np.broadcast_to(start, (chains, states))[self.order]
        for t, n in enumerate(self.active):
            here = slice(self.base[t], self.base[t + 1])
            now = local[here] * (now[:n] @ step if t else now)
            scale[here] = total = now @ ones
            now /= total[:, None]
            alpha[here] = now
        counts = np.zeros(step.shape)
        ends = np.ones((chains, states), local.dtype) if end is None else end[self.order].astype(local.dtype)
        if end is not None:
            # of every chain its last element's probabilities weigh what follows to one
            steps = np.repeat(np.arange(len(self.active)), -np.diff(np.r_[self.active, 0]))[::-1]
            ends /= (alpha[self.base[steps] + np.arange(chains)] * ends).sum(axis=1, keepdims=True)
        back = ends[: self.active[-1]].copy()
        for t in range(len(self.active) - 1, 0, -1):
            here, n = slice(self.base[t], self.base[t + 1]), self.active[t]
            seen = local[here] * back
            seen /= scale[here][:, None]
            counts += alpha[self.base[t - 1] : self.base[t - 1] + n].T @ seen
            alpha[here] *= back
            back = ends[: self.active[t - 1]].copy()
            back[:n] = seen @ step.T
        alpha[:chains] *= back
        first = np.empty((chains, states), local.dtype)
        first[self.order] = local[:chains] * back / scale[:chains][:, None]
        return alpha, counts * step, float(np.log(scale, dtype=np.float64).sum()), first

    def _leaving(self, t: int) -> slice:
        """The chains of step ``t`` that end there."""
        return slice(self.active[t + 1] if t + 1 < len(self.active) else 0, self.active[t])

    def transfer(self, local: np.ndarray, step: np.ndarray) -> np.ndarray:
        """For each chain, in the order given: from each state before it (row) the likelihood of the chain and each
        state at its end, all of a chain's numbers over one factor that makes their sum one."""
        states = local.shape[1]
        local = local / local.max(axis=1, keepdims=True)
        now = np.broadcast_to(np.eye(states, dtype=local.dtype), (len(self.order), states, states))
        last = np.empty((len(self.order), states, states), local.dtype)
        for t, n in enumerate(self.active):
            # one product of all rows of all chains
            now = (now[:n].reshape(-1, states) @ step).reshape(-1, states, states)
            now *= local[self.base[t] : self.base[t + 1], None, :]
            if t % 8 == 7:
                now /= now.sum(axis=(1, 2), keepdims=True)
            last[self._leaving(t)] = now[self._leaving(t)]
        last /= last.sum(axis=(1, 2), keepdims=True)
        out = np.empty_like(last)
        out[self.order] = last
        return out

    def likelihood(self, local: np.ndarray, step: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By chain, in the order given: the natural logarithm of its likelihood, and its last state's probabilities.
        ``start`` may have a row per chain."""
        chains = len(self.order)
        first = np.broadcast_to(start, (chains, local.shape[1]))[self.order]
        logs, last = np.zeros(chains), np.empty((chains, local.shape[1]))
        now = first
        for t, n in enumerate(self.active):
            now = (now[:n] @ step if t else first) * local[self.base[t] : self.base[t + 1]]
            total = now.sum(axis=1)
            now /= total[:, None]
            logs[:n] += np.log(total)
            last[self._leaving(t)] = now[self._leaving(t)]
        out, ends = np.empty(chains), np.empty_like(last)
        out[self.order], ends[self.order] = logs, last
        return out, ends


class Pieces:
    """Chains (arrays of elements, each over 0 of them) cut into pieces of ``piece`` elements, all of which advance side by
    side, so that a long chain takes no long recursion and no block of its own. Work is done in blocks of about ``room``
    elements. ``local`` gives the likelihoods by state of an array of elements.
    """

    def __init__(self, chains: list[np.ndarray], local: Callable[[np.ndarray], np.ndarray], step: np.ndarray, start: np.ndarray, piece: int, room: int) -> None:
        lengths = np.array([len(x) for x in chains], np.int64)
        self.local, self.step, self.start, self.room = local, step, start, room
        self.counts = -(-lengths // piece)
        #: Of each chain, its first piece; of each piece, its chain, number in the chain and size.
        self.firsts = np.cumsum(self.counts) - self.counts
        self.total = int(self.counts.sum())
        self.number = np.arange(self.total) - np.repeat(self.firsts, self.counts)
        self.owner = np.repeat(np.arange(len(chains)), self.counts)
        self.size = np.minimum(lengths[self.owner] - self.number * piece, piece)
        self.joined = np.concatenate(chains) if self.total else np.zeros(0, np.int64)
        self.begin = np.cumsum(self.size) - self.size

    def elements(self, pieces: np.ndarray) -> np.ndarray:
        own = self.size[pieces]
        return self.joined[np.arange(own.sum()) + np.repeat(self.begin[pieces] - np.cumsum(own) + own, own)]

    def blocks(self, pieces: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, Chains]]:
        if len(pieces):
            for block in np.split(pieces, np.flatnonzero(np.diff(np.cumsum(self.size[pieces]) // self.room)) + 1):
                yield block, self.elements(block), Chains(self.size[block])

    def borders(self, both: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each piece: the states' probabilities before it given what precedes it, the same one transition later, and
        (if ``both``) the likelihood, up to a factor, of what follows it."""
        states, step = len(self.step), self.step
        before = np.broadcast_to(self.start, (self.total, states)).astype(step.dtype)
        entered, after = np.zeros((self.total, states), step.dtype), np.ones((self.total, states), step.dtype)
        long = np.flatnonzero(self.counts > 1)
        if not len(long):
            return entered, before, after
        matrices = np.empty((self.total, states, states), step.dtype)
        # what a last piece does only matters to those before it
        ending = self.number == self.counts[self.owner] - 1
        for block, found, layout in self.blocks(np.flatnonzero((self.number > 0) & (both | ~ending))):
            matrices[block] = layout.transfer(self.local(layout.by_time(found)), step)
        for block, found, layout in self.blocks(self.firsts[long]):
            entered[block + 1] = layout.likelihood(self.local(layout.by_time(found)), step, self.start)[1]
        most = self.counts.max()
        for k in range(1, most):
            own = self.firsts[long[self.counts[long] > k]] + k
            before[own] = entered[own] @ step
            more = self.firsts[long[self.counts[long] > k + 1]] + k
            now = np.einsum("ns,nst->nt", entered[more], matrices[more])
            entered[more + 1] = now / now.sum(axis=1, keepdims=True)
        for k in range(most - 1, 0, -1) if both else ():
            own = self.firsts[long[self.counts[long] > k]] + k
            then = np.einsum("nst,nt->ns", matrices[own], after[own])
            after[own - 1] = then / then.sum(axis=1, keepdims=True)
        return entered, before, after

    def smooth(self, moves: np.ndarray, starts: np.ndarray, ordered: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The elements of all chains in order, and their states' probabilities given their whole chain, block by block.
        Expected transitions and first states are added to ``moves`` and ``starts``. If not ``ordered``, the elements of a
        block come by time, which takes fewer steps."""
        entered, before, after = self.borders(both=True)
        for block, found, layout in self.blocks(np.arange(self.total)):
            timed = layout.by_time(found)
            likely, inside, _, first = layout.smooth(self.local(timed), self.step, before[block], after[block])
            inner = self.number[block] > 0
            moves += inside + (entered[block][inner].T @ first[inner]) * self.step
            firsts = np.empty_like(first)
            firsts[layout.order] = likely[: len(block)]
            starts += firsts[~inner].sum(axis=0)
            yield (found, likely[layout.place]) if ordered else (timed, likely)

    def log_likelihoods(self) -> np.ndarray:
        """The natural logarithm of each chain's likelihood."""
        _, before, _ = self.borders(both=False)
        logs = np.zeros(self.total)
        for block, found, layout in self.blocks(np.arange(self.total)):
            logs[block] = layout.likelihood(self.local(layout.by_time(found)), self.step, before[block])[0]
        return np.bincount(self.owner, logs, len(self.counts))
