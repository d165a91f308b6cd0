"""The dictionary index: what it lists and what its plan carries."""

from claimstream.operators import prepare


def listed(spark, rows, names):
    claims = spark.createDataFrame(rows, "id bigint, claim string")
    found = prepare.dictionary_entities(claims, spark.createDataFrame([(n,) for n in names], "entity string"), "id", "claim")
    return {r.id: sorted(r.entities) for r in found.collect()}


def test_names_are_found_wherever_they_stand(spark):
    rows = [
        (1, "New York, new york; New  York and York New"),
        (2, "York"),
        (3, "a b a b a"),
        (4, None),
        (5, ""),
        (6, "b a"),
    ]
    assert listed(spark, rows, ["New York", "a b a", "York New York", "", None]) == {
        1: ["New  York", "New York"],
        3: ["a b a"],
    }


def test_a_long_name(spark):
    name = " ".join(f"n{i}" for i in range(200))
    text = " ".join(["n0 n1 n2"] * 50 + [name, "tail"])
    assert listed(spark, [(1, text), (2, "n0 " * 300)], [name]) == {1: [name]}


def test_rarest_word_names_a_name(spark):
    names = spark.createDataFrame([("the old town",), ("the sea",)], "entity string")
    uses = spark.createDataFrame([("the", 9), ("old", 2), ("town", 3), ("sea", 1)], "word string, uses bigint")
    index = {r.word: (r.name, r["at"]) for r in prepare.name_index(names, uses).collect()}
    assert index == {"old": (["the", "old", "town"], 1), "sea": (["the", "sea"], 1)}


def test_no_span_per_position_in_the_plan(spark):
    """Only single words are exploded and joined, however long the names are."""
    claims = spark.createDataFrame([(1, "x y")], "id bigint, claim string")
    names = spark.createDataFrame([(" ".join(f"n{i}" for i in range(200)),)], "entity string")
    found = prepare.dictionary_entities(claims, names, "id", "claim")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20000 and "n199" not in plan.replace("LocalRelation", "")


def test_only_words_of_names_leave_their_text(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(prepare, "cut", lambda df: kept.append(df) or df)
    rows = [(1, "one Old two Town " + "many more words " * 50), (2, "Old Town"), (3, "none of them")]
    assert listed(spark, rows, ["Old Town"]) == {2: ["Old Town"]}
    assert sorted((r.id, r.word) for r in kept[0].collect()) == [(1, "Old"), (1, "Town"), (2, "Old"), (2, "Town")]
