"""Structural joins against plain walks over random trees."""

import random

from pyspark.sql import functions as F

from folioframe.operators import nodes, structure

SCHEMA = "key long, node int, post int, parent int, depth int, pos int, tag string, attrs map<string,string>, text string, tail string"


def forest(rng, size):
    """Rows of a random forest in document order, as the node table has them."""
    parents = [-1] + [rng.choice([-1, *range(max(0, i - 4), i)]) for i in range(1, size)]
    children = {i: [j for j in range(size) if parents[j] == i] for i in range(-1, size)}
    rows, order, posts = {}, [], [0]

    def visit(i, parent, depth, pos):
        number = len(order)
        order.append(i)
        rows[number] = [number, 0, parent, depth, pos, rng.choice("abcs"), {"id": f"i{rng.randint(0, 6)}"} if rng.random() < 0.5 else {}, rng.choice(["", "Fig 1", "2", "Table 3", "x y z", " "]), ""]
        for k, c in enumerate(children[i]):
            visit(c, number, depth + 1, k)
        rows[number][1] = posts[0]
        posts[0] += 1

    for k, c in enumerate(children[-1]):
        visit(c, -1, 0, k)
    return [tuple(rows[n]) for n in sorted(rows)]


def forests():
    rng = random.Random(7)
    return {key: forest(rng, rng.randint(1, 60)) for key in [None, *range(12)]}


def test_nearest_container(spark):
    data = forests()
    df = spark.createDataFrame([(k, *r) for k, rows in data.items() for r in rows], SCHEMA).withColumn("extra", F.lit("x")).repartition(5)
    got = {(r.key, r.node): (r.holder, r.extra) for r in structure.enclosing(df, "key", F.when(F.col("tag") != "b", F.col("tag").isin("a", "s")), "holder").collect()}
    assert len(got) == sum(map(len, data.values()))
    for k, rows in data.items():
        for r in rows:
            up = r[2]
            while up >= 0 and rows[up][5] not in "as":
                up = rows[up][2]
            assert got[k, r[0]] == (up if up >= 0 else None, "x"), (k, r)


def test_last_descendant(spark):
    rows = forest(random.Random(3), 80)
    df = spark.createDataFrame([(1, *r) for r in rows], SCHEMA).select("node", structure.last_node().alias("last"))

    def last(n):
        return max([n, *(last(r[0]) for r in rows if r[2] == n)])

    assert {r.node: r.last for r in df.collect()} == {r[0]: last(r[0]) for r in rows}


def test_references_find_the_first_of_their_name(spark):
    data = forests()
    df = spark.createDataFrame([(k, *r) for k, rows in data.items() for r in rows], SCHEMA)
    got = {(r.key, r.node): (r.reference, r.target, r.target_tag) for r in structure.referred(df, "key", F.when(F.col("node") % 2 == 0, F.concat(F.lit("i"), F.col("node") % 9)), F.col("attrs")["id"]).collect()}
    wanted = {}
    for k, rows in data.items():
        for r in rows:
            if r[0] % 2 == 0:
                name = f"i{r[0] % 9}"
                hit = next((x for x in rows if x[6].get("id") == name), None)
                wanted[k, r[0]] = (name, hit and hit[0], hit and hit[5])
    assert got == wanted


def test_next_siblings(spark):
    data = forests()
    df = spark.createDataFrame([(k, *r) for k, rows in data.items() for r in rows], SCHEMA)
    got = {(r.key, r.node): r.found for r in structure.next_sibling(df, "key", F.col("tag") == "c", 2, "found").collect()}
    for k, rows in data.items():
        for r in rows:
            beside = [x for x in rows if x[2] == r[2] and r[4] < x[4] <= r[4] + 2 and x[5] == "c"]
            assert got[k, r[0]] == (beside[0][0] if beside else None)


def test_labels_are_carried_on(spark):
    data = forests()
    df = spark.createDataFrame([(k, *r) for k, rows in data.items() for r in rows], SCHEMA)
    got = {(r.key, r.node): r.label for r in structure.carried_labels(df, "key", F.col("tag").isin("a", "b"), F.col("text")).collect()}
    wanted = {}
    for k, rows in data.items():
        for parent in {r[2] for r in rows}:
            word = None
            for r in (r for r in rows if r[2] == parent and r[5] in "ab"):
                parts = r[7].split()
                if not parts:
                    wanted[k, r[0]] = None
                    continue
                number = parts[-1] if parts[-1][0].isdigit() and len(parts) <= 2 else None
                word = parts[0] if number is None or len(parts) == 2 else word
                wanted[k, r[0]] = " ".join(x for x in (word, number) if x)
    assert got == wanted


def test_empty_and_deep(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert structure.enclosing(empty, "key", F.lit(True), "x").count() == 0 and structure.referred(empty, "key", F.col("tag"), F.col("tag")).count() == 0
    html = "<div>" * 150 + "<a>x</a>" + "</div>" * 150
    table = nodes.node_table(spark.createDataFrame([(1, html), (2, None), (3, "")], "key long, html string"), "key", "html")
    rows = structure.enclosing(table, "key", F.col("tag") == "div", "up").collect()
    assert len(rows) == 151 and all(r.up == (r.parent if r.parent >= 0 else None) for r in rows)
