"""Rule patterns compiled into one deterministic automaton over bytes, as transition arrays.

Patterns are byte patterns with literals, ``\\``-escapes, classes ``[...]``, groups ``(...)``,
alternation, ``?``, ``*``, ``+`` and ``{n,}``; ``(?i)`` in front makes letters match in either case.
All rules share one automaton: subset construction over the classes of bytes that no rule tells
apart, then merging of states that behave alike.
"""

from __future__ import annotations

import numpy as np


class _Parser:
    """Builds states of a nondeterministic automaton: per state, moves (byte set, target) or empty moves."""

    def __init__(self, moves: list, backwards: bool):
        self.moves, self.backwards = moves, backwards

    def state(self) -> int:
        self.moves.append([])
        return len(self.moves) - 1

    def build(self, pattern: str) -> tuple[int, int]:
        self.fold = pattern.startswith("(?i)")
        self.text, self.at = pattern[4 * self.fold:], 0
        return self.choice()

    def peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def choice(self) -> tuple[int, int]:
        start, end = self.state(), self.state()
        while True:
            a, b = self.sequence()
            self.moves[start].append((None, a))
            self.moves[b].append((None, end))
            if self.peek() != "|":
                return start, end
            self.take()

    def sequence(self) -> tuple[int, int]:
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated())
        if self.backwards:
            parts.reverse()
        start = end = self.state()
        for a, b in parts:
            self.moves[end].append((None, a))
            end = b
        return start, end

    def repeated(self) -> tuple[int, int]:
        begun = self.at
        a, b = self.atom()
        sign = self.peek()
        if sign == "{":
            stop = self.text.index(",}", self.at)
            times, after = int(self.text[self.at + 1:stop]), stop + 2
            for _ in range(times - 1):
                self.at = begun
                c, d = self.atom()
                self.moves[b].append((None, c))
                last, b = c, d
            self.moves[b].append((None, last if times > 1 else a))
            self.at = after
            return a, b
        if sign not in ("?", "*", "+") or not sign:
            return a, b
        self.take()
        start, end = self.state(), self.state()
        self.moves[start].append((None, a))
        self.moves[b].append((None, end))
        if sign in "?*":
            self.moves[start].append((None, end))
        if sign in "*+":
            self.moves[b].append((None, a))
        return start, end

    def atom(self) -> tuple[int, int]:
        c = self.take()
        if c == "(":
            inner = self.choice()
            self.take()
            return inner
        members = self.members() if c == "[" else {self.escaped() if c == "\\" else ord(c)}
        if self.fold:
            members |= {ord(x) for m in members if m < 128 for x in (chr(m).lower() + chr(m).upper())}
        start, end = self.state(), self.state()
        self.moves[start].append((frozenset(members), end))
        return start, end

    def escaped(self) -> int:
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2:self.at], 16)
        return ord(c)

    def members(self) -> set[int]:
        found: set[int] = set()
        while self.peek() != "]":
            c = self.take()
            low = self.escaped() if c == "\\" else ord(c)
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                c = self.take()
                found |= set(range(low, (self.escaped() if c == "\\" else ord(c)) + 1))
            else:
                found.add(low)
        self.take()
        return found


class Automaton:
    """``table[state * width + classes[byte]]`` is the next state times ``width``.

    ``accepts[state]`` has bit k set where rule k ends. A searching automaton may start a match at
    every byte, an anchored one only at the first; its state 0 is dead.
    """

    def __init__(self, patterns: list[str], search: bool, backwards: bool = False):
        moves: list = []
        parser = _Parser(moves, backwards)
        ends: dict[int, int] = {}
        starts = []
        for k, pattern in enumerate(patterns):
            a, b = parser.build(pattern)
            starts.append(a)
            ends[b] = 1 << k

        def closed(state: int) -> int:
            """The states reached by empty moves that matter, as bits."""
            todo, seen = [state], {state}
            while todo:
                for members, to in moves[todo.pop()]:
                    if members is None and to not in seen:
                        seen.add(to)
                        todo.append(to)
            return sum(1 << s for s in seen if s in ends or any(m is not None for m, _ in moves[s]))

        sets = sorted({m for row in moves for m, _ in row if m is not None}, key=sorted)
        kinds: dict[tuple, int] = {}
        self.classes = np.array([
            kinds.setdefault(tuple(byte in m for m in sets), len(kinds)) for byte in range(256)
        ], dtype=np.uint8)
        width = len(kinds)
        sample = [int(np.flatnonzero(self.classes == k)[0]) for k in range(width)]
        # Per state the classes that lead on, each with the closed set it leads to.
        steps = [
            [(c, closed(to)) for m, to in row if m is not None for c in range(width) if sample[c] in m] for row in moves
        ]
        begin = 0
        for state in starts:
            begin |= closed(state)
        always = begin if search else 0
        numbers = {0: 0, begin: 1} if not search else {begin: 0}
        order, rows, accepted = list(numbers), [], []
        for current in order:
            reached, accept, rest = [always] * width, 0, current
            while rest:
                state = (rest & -rest).bit_length() - 1
                rest &= rest - 1
                accept |= ends.get(state, 0)
                for c, to in steps[state]:
                    reached[c] |= to
            for target in reached:
                if target not in numbers:
                    numbers[target] = len(order)
                    order.append(target)
            rows.append([numbers[target] for target in reached])
            accepted.append(accept)
        table, accepts = np.array(rows), np.array(accepted, dtype=np.int64)
        # Merge states that no continuation tells apart.
        part = np.unique(accepts, return_inverse=True)[1]
        while True:
            seen: dict[bytes, int] = {}
            finer = np.array([
                seen.setdefault(row.tobytes(), len(seen)) for row in np.column_stack([part, part[table]])
            ])
            if finer.max() == part.max():
                break
            part = finer
        # Keep the numbers of the first states, so that dead stays 0 and the start is known.
        first = np.unique(part, return_index=True)[1]
        rename = np.empty(len(first), dtype=int)
        rename[part[np.sort(first)]] = np.arange(len(first))
        part, chosen = rename[part], np.sort(first)
        self.width = width
        self.start = int(part[0 if search else 1]) * width
        self.table = (part[table[chosen]] * width).astype(np.int32).ravel()
        self.accepts = accepts[chosen]

    def run(self, data: np.ndarray, lanes: int = 4096) -> np.ndarray:
        """The state after every byte, from the start state, as ``state * width``.

        The buffer is cut into equal strips that advance together, a byte each per step. Strips
        but the first begin with a guess, the start state; one whose guess was wrong is run again
        from the true state until it falls in with what it had.
        """
        n = len(data)
        strip = max(1, -(-n // lanes))
        lanes = -(-n // strip)
        padded = np.zeros(strip * lanes, dtype=np.uint8)
        padded[:n] = data
        steps = np.ascontiguousarray(self.classes[padded].reshape(lanes, strip).T)
        states = np.empty((strip, lanes), dtype=np.int32)
        now = np.full(lanes, self.start, dtype=np.int32)
        for t in range(strip):
            now = self.table[now + steps[t]]
            states[t] = now
        entry = np.full(lanes, self.start, dtype=np.int32)
        while True:
            true = np.r_[np.int32(self.start), states[-1, :-1]]
            wrong = np.flatnonzero(true != entry)
            if not len(wrong):
                break
            entry[wrong] = true[wrong]
            now = true[wrong]
            for t in range(strip):
                now = self.table[now + steps[t, wrong]]
                apart = now != states[t, wrong]
                if not apart.all():
                    wrong, now = wrong[apart], now[apart]
                    if not len(wrong):
                        break
                states[t, wrong] = now
        return states.T.ravel()[:n]
