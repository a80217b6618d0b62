"""Plain references that several tests share."""

from __future__ import annotations


def components(nodes, links):
    """For each node the smallest one it is connected to."""
    up = {x: x for x in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}
