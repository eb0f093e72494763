import random
from fractions import Fraction

from tagshelf.llm import jaccard_join
from tests.llm.test_operators import brute_components, family, rows


def test_stars_move_entries_at_any_size_but_not_those_of_hot_keys(spark, monkeypatch):
    plans, write = {}, jaccard_join.write_step

    def written(df, label, *more):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, label, *more)

    monkeypatch.setattr(jaccard_join, "write_step", written)
    monkeypatch.setattr(jaccard_join, "MEMBERS", 10)
    rows = [(1, i) for i in range(20)] + [(2, i) for i in range(3, 6)] + [(3, 3), (3, 50), (4, 60)]
    entries = spark.createDataFrame(rows, "key long, id long")
    found = jaccard_join._stars(entries, jaccard_join.F.count("*") > 1)
    assert sorted(map(tuple, found.collect())) == sorted([(3, i) for i in range(20) if i != 3] + [(3, 50)])
    assert "SortMergeJoin" in plans["hubs"] and "Broadcast" not in plans["hubs"]
    assert "SortMergeJoin" in plans["stars"] and "BroadcastHashJoin" in plans["stars"]


def test_only_sets_of_large_stars_are_moved_for_them(spark, monkeypatch):
    given, at_hubs, at_rarest = {}, jaccard_join._linked_to_hub, jaccard_join._narrowed
    ids = lambda df: {r["id"] for r in df.select("id").collect()}

    def linked_to_hub(stars, sets, rule):
        given.setdefault("hubs", (ids(stars) | {r["hub"] for r in stars.collect()}, ids(sets)))
        return at_hubs(stars, sets, rule)

    def narrowed(compared, sets, rule):
        given["rarest"] = (ids(compared), ids(sets))
        return at_rarest(compared, sets, rule)

    monkeypatch.setattr(jaccard_join, "_linked_to_hub", linked_to_hub)
    monkeypatch.setattr(jaccard_join, "_narrowed", narrowed)
    monkeypatch.setattr(jaccard_join, "MEMBERS", 40)
    # A large star some of whose members do not link to its hub, one whose members all do, and 40 pairs.
    some = family(150, 9)
    random.seed(4)
    words = lambda n: [f"x{random.randint(0, 10**6)}" for _ in range(n)]
    one, alone = words(200), [words(60) for _ in range(40)]
    texts = some + [(1000 + i, " ".join([*one, f"end{i}"])) for i in range(50)]
    texts += [(2000 + 2 * i + k, " ".join([*t, *["end"] * k])) for i, t in enumerate(alone) for k in (0, 1)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = rows(jaccard_join.link_documents(docs, 4, Fraction(85, 100)), "doc_id", "n_shingles", "component_id")
    assert {(i, k): c for i, k, c in got} == brute_components(texts, 4, Fraction(85, 100))
    wanted, moved = given["hubs"]
    assert wanted == moved and moved & set(range(1000, 1050)) and max(moved) < 2000
    wanted, moved = given["rarest"]
    assert wanted == moved and moved and max(moved) < 1000
