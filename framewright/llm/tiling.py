"""Greedy string tiling of two token sequences, with running Karp-Rabin hashes."""

from __future__ import annotations

import heapq

MODULUS = (1 << 61) - 1
FACTOR = 1_000_003
#: Length of the first windows that are compared; halved down to the minimum.
FIRST_WINDOW = 32


def rolling(tokens: list[int], free: list[bool], length: int) -> list[tuple[int, int]]:
    """(hash, start) of each window of ``length`` tokens that are all free, each hash from the one before it."""
    out, value, run = [], 0, 0
    top = pow(FACTOR, length - 1, MODULUS)
    for i, token in enumerate(tokens):
        if not free[i]:
            value = run = 0
            continue
        if run == length:
            value -= (tokens[i - length] + 1) * top
        else:
            run += 1
        value = (value * FACTOR + token + 1) % MODULUS
        if run == length:
            out.append((value, i - length + 1))
    return out


def tiles(pattern: list[int], text: list[int], minimum: int) -> list[tuple[int, int, int]]:
    """The greedy tiling of pattern by text: (place in pattern, place in text, length), in the order of marking.

    Of all matches between unmarked tokens the longest is marked, again and again, down
    to ``minimum`` tokens; of equally long ones the first in the pattern, then in the
    text. Tokens below 0 match nothing. Each round looks for matches of at
    least a window's length by the hashes of unmarked windows, extends them as far as
    they go, and marks them longest first; what earlier marks have left of a match
    queues again by its length. Then the window is halved.
    """
    if minimum < 1:
        raise ValueError("minimum must be positive")
    free_p, free_t = [x >= 0 for x in pattern], [x >= 0 for x in text]
    out: list[tuple[int, int, int]] = []
    window = max(minimum, min(FIRST_WINDOW, len(pattern), len(text)))
    while True:
        places: dict[int, list[int]] = {}
        for value, p in rolling(pattern, free_p, window):
            places.setdefault(value, []).append(p)
        queue: list[tuple[int, int, int]] = []
        for value, t in rolling(text, free_t, window):
            for p in places.get(value, ()):
                if p and t and free_p[p - 1] and free_t[t - 1] and pattern[p - 1] == text[t - 1]:
                    continue  # part of the match that starts a token earlier
                n = 0
                while p + n < len(pattern) and t + n < len(text) and free_p[p + n] and free_t[t + n] and pattern[p + n] == text[t + n]:
                    n += 1
                if n >= window:
                    queue.append((-n, p, t))
        heapq.heapify(queue)
        while queue:
            n, p, t = heapq.heappop(queue)
            n, start = -n, None
            whole = all(free_p[p : p + n]) and all(free_t[t : t + n])
            if whole:
                out.append((p, t, n))
                free_p[p : p + n] = [False] * n
                free_t[t : t + n] = [False] * n
                continue
            for i in range(n + 1):
                if i < n and free_p[p + i] and free_t[t + i]:
                    start = i if start is None else start
                elif start is not None:
                    if i - start >= window:
                        heapq.heappush(queue, (start - i, p + start, t + start))
                    start = None
        if window == minimum:
            return out
        window = max(minimum, window // 2)
