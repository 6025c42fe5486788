import random

import pytest

from accountweave.llm.components import components, joined


def brute(links):
    head = {}

    def root(x):
        head.setdefault(x, x)
        while head[x] != x:
            x = head[x]
        return x

    for a, b in links:
        if a != b:
            x, y = root(a), root(b)
            head[max(x, y)] = min(x, y)
    return {n: root(n) for n in head}


@pytest.mark.parametrize(("nodes", "first", "then"), [(60, 25, 15), (200, 150, 40), (30, 0, 9), (30, 20, 0)])
def test_components_and_further_links(spark, nodes, first, then):
    r = random.Random(nodes + first)
    some, more = ([(r.randrange(nodes), r.randrange(nodes)) for _ in range(n)] for n in (first, then))
    found = components(spark.createDataFrame(some, "a int, b int"))
    assert {x.node: x.component for x in found.collect()} == brute(some)
    rows = joined(found, spark.createDataFrame([x for x in more if x[0] != x[1]], "a int, b int")).collect()
    assert len(rows) == len({x.node for x in rows})
    assert {x.node: x.component for x in rows} == brute(some + more)


def test_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 2000 + i) for i in range(300)] + [(5, 5)]
    found = components(spark.createDataFrame(links, "a int, b int"))
    assert {x.node: x.component for x in found.collect()} == brute(links)
