"""Cheapest edits that make a conversation's roles read ``(s?(ua)+)?``: banded alignment to every feasible length.

A target of the grammar is fixed by its length: "uaua..." or, if odd, "s" before it. Seen from their ends, all
targets of one parity are prefixes of one another, so one Wagner-Fischer table over (turn, symbols still
to come) aligns the turns to every length at once. Cells further from the diagonal than the best cost found so far could
pay for are left out (Ukkonen). Edits are read forwards: the alignments of all cheapest lengths go on together,
and at each step those whose next letter is not the least leave, so what remains is the ASCII-least audit.

Long conversations are aligned in blocks of turns. Between blocks only the phase counts (nothing used yet, after "s",
assistant expected, user expected): costs are chained over the phases from the last block to the first,
audits from the first to the last. Time and memory are linear in the number of turns.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SYSTEM, USER, ASSISTANT, OTHER = range(4)
CLEAN, TRUNCATED, BLANK, DUPLICATE = range(4)
DELETE, INSERT, REROLE, CUT = 4, 3, 3, 3  # CUT: an undeleted truncated turn
START, AFTER_SYSTEM, EXPECT_ASSISTANT, EXPECT_USER = range(4)
NEVER = 1 << 40
END = (0, NEVER, NEVER, 0)  # a conversation may end empty or after an assistant


class Block:
    """Costs of the cheapest ways through a block of turns, for every phase before and after it.

    ``step[i, lane, e]``: from turn ``i`` on with ``left[i] + e`` symbols to come, ``left`` being the turns that need not be
    deleted; lane 0 ends expecting an assistant, lane 1 a user. ``lead``: the same with "s" to come first.
    ``none``: no symbol any more, still at the start (0) or after "s" (1). ``only``: "s" alone to come.
    """

    def __init__(self, kind: np.ndarray, state: np.ndarray, after: tuple[int, ...], last: bool, low: int, high: int):
        self.kind, self.state, self.last = kind, state, last
        self.e = np.arange(-low, high + 1)
        n, self.left = len(kind), np.append(np.cumsum((state < BLANK)[::-1])[::-1], 0)
        self.step = np.full((n + 1, 2, len(self.e)), NEVER)
        self.lead = self.step.copy()
        self.none, self.only = np.full((n + 1, 2), NEVER), np.full(n + 1, NEVER)
        ahead = self.e >= 0 if last else self.e == 0
        self.step[n][:, ahead] = np.minimum(np.array(after[2:])[:, None] + INSERT * self.e[ahead], NEVER)
        self.none[n] = after[:2]
        for i in range(n - 1, -1, -1):
            self._turn(i)

    def users(self, i: int) -> np.ndarray:
        """Whether the next symbol is a user's, (lane, e)."""
        return (self.left[i] + self.e + np.arange(2)[:, None]) % 2 == 1

    def pending(self, i: int) -> np.ndarray:
        return self.left[i] + self.e >= 1

    def fits(self, i: int) -> np.ndarray:
        """Whether turn ``i`` has the role of the next symbol."""
        user = self.users(i)
        return self.pending(i) & np.where(user, self.kind[i] == USER, self.kind[i] == ASSISTANT)

    def _turn(self, i: int) -> None:
        step, lead = self.step[i + 1], self.lead[i + 1]
        self.none[i] = np.minimum(self.none[i + 1] + DELETE, NEVER)
        if self.state[i] >= BLANK:
            best, self.lead[i], self.only[i] = step + DELETE, lead + DELETE, self.only[i + 1] + DELETE
        else:
            keep = self.keep(i)
            best = np.where(self.pending(i), step + keep + np.where(self.fits(i), 0, REROLE), NEVER)
            best[:, :-1] = np.minimum(best[:, :-1], step[:, 1:] + DELETE)
            self.lead[i][:, :-1], self.only[i] = lead[:, 1:] + DELETE, self.only[i + 1] + DELETE
            if self.kind[i] == SYSTEM:
                opens = (self.pending(i) & self.users(i))[:, :-1]
                kept = np.where(opens, step[:, 1:] + keep, NEVER)
                self.lead[i][:, :-1] = np.minimum(self.lead[i][:, :-1], kept)
                self.only[i] = min(self.only[i], self.none[i + 1, 1] + keep)
        best = np.minimum.accumulate(best - INSERT * self.e, axis=1) + INSERT * self.e
        self.step[i] = np.minimum(best, NEVER)
        self.lead[i], self.only[i] = np.minimum(self.lead[i], NEVER), min(self.only[i], NEVER)

    def keep(self, i: int) -> int:
        return CUT if self.state[i] == TRUNCATED else 0

    def entries(self, phase: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
        """Which of ``step[0]``, ``lead[0]``, ``none[0]`` and ``only[0]`` a block can be entered by in this phase."""
        user, pending = self.users(0), self.pending(0)
        step = pending & (~user if phase == EXPECT_ASSISTANT else user)
        if phase >= EXPECT_ASSISTANT:  # nothing of the target in this block
            step[phase - EXPECT_ASSISTANT] |= self.left[0] + self.e == 0
        at_start = phase == START
        return step, np.full(step.shape, at_start), np.array([at_start, phase == AFTER_SYSTEM]), at_start

    def before(self) -> tuple[int, ...]:
        """The least cost from each phase before the block on."""
        out = []
        for phase in range(4):
            step, lead, none, only = self.entries(phase)
            costs = np.concatenate([self.step[0][step], self.lead[0][lead], self.none[0][none], self.only[:1][[only]]])
            out.append(int(costs.min(initial=NEVER)))
        return tuple(out)

    def audit(self, phases: set[int], costs: tuple[int, ...]) -> tuple[str, set[int]]:
        """The least letters of all cheapest ways from these phases on, and the phases that they end in."""
        step, lead = np.zeros((2, len(self.e)), bool), np.zeros((2, len(self.e)), bool)
        none, only = np.zeros(2, bool), False
        for p in phases:
            at, first, without, single = self.entries(p)
            step |= at & (self.step[0] == costs[p])
            lead |= first & (self.lead[0] == costs[p])
            none |= without & (self.none[0] == costs[p])
            only |= single and self.only[0] == costs[p]
        letters, i, n = [], 0, len(self.kind)
        done = self.e == 0
        while i < n or self.last and not (step[:, done].any() or none[0]):
            here = self.step[i]
            fewer = np.zeros_like(step)  # one symbol inserted
            fewer[:, :-1] = (step & np.concatenate([np.zeros((2, 1), bool), here[:, :-1] + INSERT == here[:, 1:]], axis=1))[:, 1:]
            if i == n:
                letters.append("I")
                step = fewer
                continue
            there, forced = self.step[i + 1], self.state[i] >= BLANK
            gone = step & self._same(here, there, DELETE, forced)
            gone_lead = lead & self._same(self.lead[i], self.lead[i + 1], DELETE, forced)
            gone_none = none & (self.none[i + 1] + DELETE == self.none[i])
            gone_only = bool(only and self.only[i + 1] + DELETE == self.only[i])
            if gone.any() or gone_lead.any() or gone_none.any() or gone_only:
                letters.append("D")
                step, lead = self._moved(gone, forced), self._moved(gone_lead, forced)
                none, only, i = gone_none, gone_only, i + 1
                continue
            if fewer.any():
                letters.append("I")
                step, lead, none, only = fewer, np.zeros_like(lead), np.zeros(2, bool), False
                continue
            keep, fits = self.keep(i), self.fits(i)
            kept = step & fits & (there + keep == here)
            kept_none = np.zeros(2, bool)
            if self.kind[i] == SYSTEM:
                opens = lead & self.pending(i) & self.users(i) & self._same(self.lead[i], there, keep, False)
                kept |= self._moved(opens, False)
                kept_none[1] = only and self.none[i + 1, 1] + keep == self.only[i]
            if kept.any() or kept_none.any():
                letters.append("K")
                step, none = kept, kept_none
            else:
                letters.append("R")
                step, none = step & ~fits & self.pending(i) & (there + keep + REROLE == here), np.zeros(2, bool)
            lead, only, i = np.zeros_like(lead), False, i + 1
        ends = {p for p in (EXPECT_ASSISTANT, EXPECT_USER) if step[p - EXPECT_ASSISTANT, done].any()}
        return "".join(letters), ends | {p for p in (START, AFTER_SYSTEM) if none[p]}

    @staticmethod
    def _same(here: np.ndarray, there: np.ndarray, cost: int, forced: bool) -> np.ndarray:
        """Where going on at this cost, with the same symbols to come, is a cheapest way."""
        if forced:
            return there + cost == here
        out = np.zeros(here.shape, bool)
        out[:, :-1] = there[:, 1:] + cost == here[:, :-1]
        return out

    @staticmethod
    def _moved(mask: np.ndarray, forced: bool) -> np.ndarray:
        if forced:
            return mask
        out = np.zeros_like(mask)
        out[:, 1:] = mask[:, :-1]
        return out


def banded(kind: np.ndarray, state: np.ndarray, after: tuple[int, ...], last: bool) -> Block:
    """The block in a band wide enough for every cheapest way.

    Whoever is ``x`` symbols ahead of the diagonal pays ``x`` insertions, whoever is behind ``x`` deletions, the cheaper
    ones of truncated turns first. What a narrow band finds is the incumbent; the second band holds all that it does not rule out.
    """
    free = int((state < BLANK).sum())
    cut = int((state == TRUNCATED).sum())
    base = DELETE * (len(state) - free) + CUT * cut + min(after)
    room = 2 * INSERT
    while True:
        behind = room // (DELETE - CUT) if room <= cut * (DELETE - CUT) else cut + (room - cut * (DELETE - CUT)) // DELETE
        # One more: "s" takes a turn that the symbols to come do not count.
        block = Block(kind, state, after, last, min(behind + 1, free), room // INSERT)
        need = max(block.before()) - base
        if need <= room:
            return block
        room = need if need < NEVER // 2 else 2 * room


@lru_cache(1 << 16)
def _short(codes: bytes, size: int) -> tuple[int, str]:
    return _align(codes, size)


def _align(codes: bytes, size: int) -> tuple[int, str]:
    code = np.frombuffer(codes, np.uint8)
    kind, state = (code & 3).astype(np.int64), (code >> 2).astype(np.int64)
    cuts = range(0, max(len(code), 1), size)
    costs = [END]
    for at in reversed(cuts):  # costs[0]: of what comes after, from each phase
        block = banded(kind[at : at + size], state[at : at + size], costs[0], at == cuts[-1])
        costs.insert(0, block.before())
    parts, phases = [], {START}
    for k, at in enumerate(cuts):
        if len(cuts) > 1:
            block = banded(kind[at : at + size], state[at : at + size], costs[k + 1], at == cuts[-1])
        letters, phases = block.audit(phases, costs[k])
        parts.append(letters)
    return costs[0][START], "".join(parts)


def cheapest(codes: bytes, size: int = 128) -> tuple[int, str]:
    """Cost and ASCII-least audit of a conversation; one byte for each turn: kind + 4 * state."""
    return _short(codes, size) if len(codes) <= 64 else _align(codes, size)


def target(audit: str) -> str:
    """The role initials that an audit leads to."""
    length = len(audit) - audit.count("D")
    return "s" * (length % 2) + "ua" * (length // 2)
