import random

import pytest
from conftest import rows
from glossmill.llm.groups import components, title_groups
from pyspark.sql import functions as F


def _brute(pairs):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    return {(find(x), x) for x in up}


def _shapes():
    r = random.Random(5)
    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)]
    ring = [(f"r{i:02}", f"r{(i + 1) % 17:02}") for i in range(17)]
    star = [("hub", f"s{i}") for i in range(40)]
    clique = [(f"k{i}", f"k{j}") for i in range(6) for j in range(i)]
    odd = [("x", "x"), ("y", "y"), ("y", "z"), ("p", "q"), ("q", "p"), ("p", "q"), (None, "n"), ("n", None), ("é", "e"), ("", "blank"), ("c030", "k0"), ("k1", "hub")]
    rand = [(f"v{r.randrange(80)}", f"v{r.randrange(80)}") for _ in range(90)]
    dense = [(f"d{r.randrange(25)}", f"d{r.randrange(25)}") for _ in range(120)]
    return {"all": chain + ring + star + clique + odd, "random": rand + dense, "tiny": [("b", "a")], "loop": [("a", "a")]}


@pytest.mark.parametrize("name", ["all", "random", "tiny", "loop"])
def test_components(spark, name):
    pairs = _shapes()[name]
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("v", F.lit("clash"))
    got = rows(components(df))
    assert len(got) == len(set(got)) and set(got) == _brute(pairs)


def test_few_rounds_and_empty(spark):
    pairs = _shapes()["all"]
    assert set(rows(components(spark.createDataFrame(pairs, "a string, b string"), rounds=1))) == _brute(pairs)
    assert rows(components(spark.createDataFrame([], "a string, b string"))) == []
    assert rows(components(spark.createDataFrame([(None, None)], "a string, b string"))) == []


def test_titles(make):
    r = make("redirects", [{"source_title": "Ａ b", "target_title": "C_d#x"}, {"source_title": "q", "target_title": None}])
    e = make("entries", [{"pos": 1, "title": "c D", "redirect_aliases": ["Zed", None]}, {"pos": 2, "title": "alone", "redirect_aliases": None}])
    assert rows(title_groups(r, e)) == [("a b", "a b"), ("a b", "c d"), ("a b", "zed")]
