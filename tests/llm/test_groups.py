"""Groups against union-find on graphs of every awkward shape."""

import random

import pytest

from wayfold.llm.groups import consolidate


def union_find(pairs):
    up = {}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        for x in (a, b):
            if x is not None:
                up.setdefault(x, x)
        if a is not None and b is not None:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {x: root(x) for x in up}


rnd = random.Random(5)
perm = rnd.sample(range(1000, 9000), 4000)
path = [(perm[i], perm[i + 1]) for i in range(150)]
cycle = [(perm[200 + i], perm[200 + (i + 1) % 97]) for i in range(97)]
star = [(perm[400], perm[401 + i]) for i in range(300)]
tree = [(perm[800 + i], perm[800 + (i - 1) // 2]) for i in range(1, 120)]
core = [(perm[1000 + i], perm[1000 + j]) for i in range(9) for j in range(i)]
dumbbell = core + [(perm[1020 + i], perm[1020 + j]) for i in range(6) for j in range(i)] + [(perm[1000], perm[1100]), (perm[1100], perm[1101]), (perm[1101], perm[1020])]
wheel = [(perm[1300 + i], perm[1300 + (i + 1) % 40]) for i in range(40)] + [(perm[1350], perm[1300 + i]) for i in range(40)]
mess = [(rnd.choice(perm[2000:2300]), rnd.choice(perm[2000:2300])) for _ in range(260)]
odd = [(7, None), (None, 8), (None, None), (9, 9), (10, 11), (11, 10), (10, 11)]


@pytest.mark.parametrize("pairs", [path + cycle + star + tree + dumbbell + wheel + mess + odd, odd[:4], []], ids=["all", "no links", "empty"])
def test_groups(spark, pairs):
    df = spark.createDataFrame([(a, b, 1) for a, b in pairs], "x long, y long, group_id int")
    got = {r.vertex_id: r.group_id for r in consolidate(df, "x", "y").collect()}
    assert got == union_find(pairs)
