import random

from veilwork.llm.common import components


def brute(links):
    parent = {x: x for e in links for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components_in_one_task_and_in_rounds(spark):
    rng = random.Random(5)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + k, 1001 + k) for k in range(60)]
    links = [(a, b) for a, b in links if a != b]
    df = spark.createDataFrame([*links, (None, 3), (7, None)], "a long, b long").repartition(6)
    want = brute(links)
    for per_task in (500_000, 40):
        got = components(df, "a", "b", per_task)
        rows = [tuple(r) for r in got.collect()]
        assert len(rows) == len(set(rows)) == len(want) and dict(rows) == want


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
