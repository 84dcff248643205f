"""Minimum cut between two terminals, for small graphs of labelled nodes."""

from __future__ import annotations

from collections import deque


def min_cut(source: list[int], sink: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay on the source side of a minimum cut.

    ``source[i]`` and ``sink[i]`` are the capacities of node i's terminal edges
    (what it costs to put i on the other side); an edge (i, j, c) costs c when
    its ends are parted.  Flow is pushed along shortest paths until none is left
    (Dinic); a node is on the source side when it can still be reached.
    """
    n = len(source)
    s, t = n, n + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def add(a: int, b: int, forth: int, back: int) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(forth)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i in range(n):
        through = min(source[i], sink[i])  # goes straight through the node
        if source[i] > through:
            add(s, i, source[i] - through, 0)
        if sink[i] > through:
            add(i, t, sink[i] - through, 0)
    for i, j, c in edges:
        if c > 0:
            add(i, j, c, c)

    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for e in out[u]:
                if room[e] > 0 and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [x >= 0 for x in level[:n]]
        nexts = [0] * (n + 2)
        path: list[int] = []
        u = s
        while True:
            if u == t:
                push = min(room[e] for e in path)
                for k, e in enumerate(path):
                    room[e] -= push
                    room[e ^ 1] += push
                cut = next(k for k, e in enumerate(path) if room[e] == 0)
                u = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while nexts[u] < len(out[u]):
                e = out[u][nexts[u]]
                if room[e] > 0 and level[to[e]] == level[u] + 1:
                    break
                nexts[u] += 1
            if nexts[u] < len(out[u]):
                path.append(e)
                u = to[e]
            elif u == s:
                break
            else:
                level[u] = -2
                e = path.pop()
                u = to[e ^ 1]
